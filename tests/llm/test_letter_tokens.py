"""Random tokens of letters alone, which hold no digit by chance."""

import random
import string

from orbitframe.llm import secrets


def test_letter_tokens_are_found(spark):
    rng = random.Random(5)
    tokens = ["".join(rng.choices(string.ascii_letters, k=k)) for k in (20, 24, 32) for _ in range(20)]
    words = ["internationalization", "counterrevolutionaries", "Uncharacteristically", "1234567890123456", "--------------------", "/usr/local/share/dictionaries", "x" * 5000]
    rows = [(i, f"key {t} end") for i, t in enumerate(tokens)] + [(1000 + i, w) for i, w in enumerate(words)]
    scanned = {r.doc_id: r for r in secrets.digest(secrets.scan(spark, spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    found = [scanned[i].spans == f"random:4:{4 + len(t)}" for i, t in enumerate(tokens)]
    assert sum(found[:20]) < sum(found[20:40]) < sum(found[40:]) and sum(found[40:]) >= 15  # length-aware
    assert all(scanned[1000 + i].spans == "" for i in range(len(words)))


def test_every_long_run_is_a_hypothesis():
    text = "AbCdEfGhIjKlMnOp internationalization 1234567890123456 short"
    assert secrets.tested(text) == [(0, 16), (17, 37), (38, 54)]
