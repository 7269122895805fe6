"""The corpus pipeline on the smallest tables, stage by stage."""

import re

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_their_promises(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, FOLDER)
        made.write.parquet(str(tmp_path / name))
        seen[name] = (docs, spark.read.parquet(str(tmp_path / name)))
        docs = seen[name][1]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    key = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    before, after = ([key(r.text) for r in f.collect()] for f in seen["exact_dedup"])
    assert len(after) == len(set(after)) and set(after) == set(before)
    before, after = ({r.doc_id for r in f.collect()} for f in seen["near_join"])
    assert after < before
    mixed, encoded = seen["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert encoded.count() == mixed.count()
    want = mixed.select("doc_id", "text").rdd.map(lambda r: (r.doc_id, r.text)).collectAsMap()
    assert all(r.n_tokens == len(library.encode(want[r.doc_id], add_special_tokens=False).ids) for r in encoded.collect())


def test_run_is_the_stages(spark):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.count() > 0 and rows.filter(F.col("ids_sha256").isNull()).count() == 0


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, taken int, _of_doc string"


def odd_documents():
    """Null, empty and very long texts, ties, repeated rows, null ids, columns whose names the operators use inside."""
    texts = ["one two three four five six seven", "one two three four five six seven", "", None, " \t", "word " * 40_000, "x" * 9000, "alpha beta gamma delta epsilon zeta eta theta", "alpha beta gamma delta epsilon zeta eta THETA"]
    rows = [(i, t, "en", "ab"[i % 2], len(t or ""), 7, "held") for i, t in enumerate(texts)]
    return rows + [rows[7], (None, "a text without an id", None, None, None, None, None), (-(2**63), "the least id of all", "en", "a", 1, 7, "held")]


def test_stages_take_odd_documents(spark, tmp_path):
    labels = f"{tmp_path}/labels.parquet"
    spark.createDataFrame([(0, 1, 0), (None, 1, 1), (7, 1, None)], "doc_id long, quality int, toxic int").write.parquet(labels)
    docs = spark.createDataFrame(odd_documents(), SCHEMA)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != "bpe":
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
            assert {r["_of_doc"] for r in kept[name] if r.doc_id is not None} == {"held"}
    ids = {name: sorted((r.doc_id for r in rows), key=lambda i: (i is None, i)) for name, rows in kept.items()}
    assert ids["toxicity"] == sorted((r[0] for r in odd_documents()), key=lambda i: (i is None, i))
    assert ids["exact_dedup"] == [-(2**63), 0, 4, 5, 6, 7, 8, None]  # of the texts without words the longest
    assert ids["near_join"] == [-(2**63), 0, 4, 5, 6, 7, None]
    assert set(ids["mixing"]) <= set(ids["near_join"]) - {4} and 5 in ids["mixing"]
    assert len(ids["bpe"]) == len(ids["mixing"]) and all(r.n_tokens > 0 for r in kept["bpe"])


def test_stages_take_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.schema(made.schema).parquet(str(tmp_path / name))
        assert docs.count() == 0
