"""The sample that the dictionary of the token files is trained on."""

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from orbitframe.llm import token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_sample_holds_whole_documents(spark, monkeypatch, tmp_path):
    seen, train = [], token_files.train_dictionary
    monkeypatch.setattr(token_files, "train_dictionary", lambda samples: seen.extend(samples) or train(samples))
    texts = [" ".join(f"word{i * k % 977} tion" for i in range(n)) for k, n in ((1, 9000), (3, 3000), (7, 20))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_files.write_files(spark, frame, WORDS, str(tmp_path / "files"))
    made = Tokenizer.from_file(WORDS)
    ids = [np.array([*made.encode(t, add_special_tokens=False).ids, token_files.END_ID], np.uint32) for t in texts]
    assert len(ids[0]) > 16_384 and 8192 < len(ids[1]) <= 16_384 and len(ids[2]) < 8192
    want = [d[k : k + 8192].tolist() for d in ids for k in range(0, len(d), 8192)]
    assert sorted(token_files.unpack_ids(s, 2).tolist() for s in seen) == sorted(want)
