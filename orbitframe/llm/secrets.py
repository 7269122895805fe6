"""Secret scans: patterns, and a battery of randomness tests with false-discovery control.

Base spans come from three patterns (assignments to secret-like names, access keys, long
hexadecimal runs). The battery looks at every run of MIN_CHARS or more characters of
[A-Za-z0-9+/_-], long words among them. Its encoding is inferred from the
characters it holds (hexadecimal, letters of one case or both, base 32, letters of one case
and digits, all letters and digits, base 64) and three tests ask whether it could be uniformly random in
that encoding: a chi-squared test that equal parts of the alphabet, cut in order of how common the
characters are in writing, are hit evenly, a runs test on changes between kinds of characters, and
a test of serial correlation between neighbours. Each gives a p-value of the randomness
hypothesis; tokens with a corrected p-value under ALPHA are not random.

What is wanted is the reverse, tokens that are not ordinary, so the battery's combined
statistic (Fisher's sum of log p-values) is judged against its distribution on ordinary tokens of the same
length: a first-order chain of characters, counted over all words of the whole corpus (runs
too long to be words left out, a fixed list of words given the same weight), makes words, and words joined as names and
paths are (STYLES) make tokens of each length class, on which the battery is run. A token's p-value is
its chance to look as random as it does if it were ordinary, the largest over the styles. Short
tokens, on which the battery has little power, so can't reach what long ones can. The p-values
of all tested tokens of the corpus go through the Benjamini-Hochberg step-up rule at level
LEVEL: with m tokens tested, those with p <= LEVEL * rank / m are reported. The threshold comes from a
histogram of -log2 p (at most some thousand rows at any size).

Null texts count as empty, with no spans; rows of a repeated or null doc_id are each
scanned; extra columns are ignored; an empty table gives an empty result. Letters of the
patterns match in ASCII case only.
"""

from __future__ import annotations

import bisect
import math
import operator
import random
import re
import statistics
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import clean_text, ship_texts, small, written

#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: Runs of 24 or more are the same spans as all runs with the shorter ones dropped.
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
KINDS = ("assign", "access", "hex")
#: Least characters: of an assigned value, an access key, a tested run.
ASSIGN_CHARS, ACCESS_CHARS, MIN_CHARS = 6, 20, 16
_RUN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
ALPHA, LEVEL = 0.001, 0.01
#: Histogram of -log2 p: all from 1000 on, more than any threshold, count as one step.
TOP_STEP = 4000
#: Null of ordinary tokens: lengths of its classes, and tokens of each class and style.
LENGTHS, DRAWS = (16, 18, 20, 22, 24, 28, 32, 36, 40, 48, 56, 64, 80, 96, 128, 192, 256), 200
#: How words are joined in a style of names and paths: (joint, how the words are written).
STYLES = (("", "title"), ("", "lower"), ("_", "lower"), ("-", "lower"), ("/", "lower"), ("_", "upper"), ("any", "any"))
#: Ordinary words, counted beside the corpus' own.
ORDINARY = (
    "the of and to in is that for it as with was on are be this by not from or have an they which one you were all her would there their will "
    "when who him been has more if no out do so can what up said about other into than its time only could new them man some these then two first "
    "may any like now my such make over our even most me state after also made many did must before back see through way where get much go well "
    "your know should down work year because come people just say each those take day good how long little own old great while never without "
    "get set value name user id key list item index count file path data type class method object string number array builder factory manager "
    "service handler controller request response client server config option default return test case true false null element node child parent"
).split()
#: Characters that runs are made of; state 0 of the chain stands for all others.
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"
_STATES = len(SYMBOLS) + 1
_STATE = np.zeros(256, np.int64)
_STATE[[ord(c) for c in SYMBOLS]] = np.arange(1, _STATES)
#: Encodings by the kinds of characters they hold, narrowest first.
ENCODINGS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("uppers", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("lowers", "abcdefghijklmnopqrstuvwxyz"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("upper", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("letters", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("other", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches, by start, then kind as listed."""
    spans = []
    low = text.lower()
    if any(name in low for name in NAMES):
        spans += [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    if "AKIA" in text:
        spans += [(*m.span(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    spans += [(*m.span(), 2) for m in HEX.finditer(text)]
    return [(a, b, KINDS[k]) for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1]))]


def encoding(token: str) -> tuple[str, str]:
    """Name and alphabet of the narrowest encoding that holds every character."""
    held = set(token)
    return next((n, a) for n, a in ENCODINGS if held <= set(a))


def chi_squared_tail(x: float, df: int) -> float:
    """P(chi-squared with df degrees > x), by the Wilson-Hilferty cube-root normal."""
    if df < 1:
        return 1.0
    z = ((max(x, 0.0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


#: Kinds of characters: lower, upper, digit, sign.
KIND_OF = {ord(c): "d" if c.isdigit() else "l" if c.islower() else "u" if c.isupper() else "s" for c in SYMBOLS}


class Battery:
    """The three tests; common: how often each of SYMBOLS stands in ordinary writing."""

    def __init__(self, common: np.ndarray):
        often = dict(zip(SYMBOLS, common.tolist()))
        often = {c: often[c.lower()] + often[c.upper()] for c in SYMBOLS}  # letters are common in either case
        self.place, self.kinds = {}, {}
        for name, alphabet in ENCODINGS:
            ranked = sorted(alphabet, key=lambda c: (-often[c], alphabet.index(c)))
            self.place[name] = {c: (i, ranked.index(c)) for i, c in enumerate(alphabet)}
            shares = [alphabet.translate(KIND_OF).count(k) / len(alphabet) for k in "luds"]
            self.kinds[name] = None if max(shares) == 1 else 1 - sum(s * s for s in shares)

    def tests(self, token: str) -> tuple[str, float, float, float]:
        """Inferred encoding and the p-values of uniformity, runs and serial correlation."""
        name, alphabet = encoding(token)
        place = self.place[name]
        at, rank = np.array([place[c] for c in token], float).T
        n, size = len(at), len(alphabet)
        parts = max(2, min(size, n // 5))  # five expected in each part
        edges = np.arange(size) * parts // size
        share = np.bincount(edges, minlength=parts) / size
        seen = np.bincount(edges[rank.astype(int)], minlength=parts)
        uniform = chi_squared_tail(float(((seen - n * share) ** 2 / (n * share)).sum()), parts - 1)
        change = self.kinds[name]
        marks = token.translate(KIND_OF) if change else (at >= size / 2).tolist()
        change = change or 0.5
        changes = sum(map(operator.ne, marks, marks[1:]))
        run_test = math.erfc(abs(changes - (n - 1) * change) / math.sqrt((n - 1) * change * (1 - change)) / math.sqrt(2))
        away = at - at.mean()
        power = float((away * away).sum())
        if power:
            rho = float((away[1:] * away[:-1]).sum()) / power
            serial = math.erfc(abs(rho + 1 / n) * math.sqrt(n) / math.sqrt(2))
        else:
            serial = 0.0
        return name, uniform, run_test, serial

    def statistic(self, token: str) -> float:
        """log of Fisher's sum: small for random tokens, infinite where the battery rejects randomness."""
        p = [max(x, 1e-300) for x in self.tests(token)[1:]]
        return math.inf if min(p) * len(p) < ALPHA else self.raw(p)

    @staticmethod
    def raw(p: list[float]) -> float:
        return math.log(1e-3 - 2 * sum(math.log(x) for x in p))


def letter_pairs(texts: list[str], left_out: list[str] = ()) -> np.ndarray:
    """Counts of (state, next state) over the characters of texts, without those of the tokens left out."""
    def count(data: bytes) -> np.ndarray:
        at = _STATE[np.frombuffer(data, "u1")]
        return np.bincount(at[:-1] * _STATES + at[1:], minlength=_STATES * _STATES)

    whole = count(("\n" + "\n".join(texts) + "\n").encode("utf-8", "surrogatepass"))
    return whole - count(("\n" + "\n".join(left_out) + "\n").encode()) if left_out else whole


class Null:
    """How random ordinary tokens look: for each length class and style the mean and deviation of the statistic."""

    def __init__(self, pairs: np.ndarray, seed: int = 7):
        pairs, ordinary = np.maximum(pairs, 0).astype(float), letter_pairs(ORDINARY).astype(float)
        pairs[0] = ordinary[0] = 0  # between words
        pairs = pairs / max(pairs.sum(), 1) + ordinary / ordinary.sum()  # the corpus and the list count alike
        pairs = pairs.reshape(_STATES, _STATES)
        self.battery = Battery(pairs[:, 1:].sum(axis=0))
        self.chain = np.cumsum(pairs / np.maximum(pairs.sum(axis=1, keepdims=True), 1e-300), axis=1).tolist()
        rng = random.Random(seed)
        self.facts = []
        for length in LENGTHS:
            drawn = [[self.battery.raw([max(x, 1e-300) for x in self.battery.tests(self.token(rng, length, *style))[1:]]) for _ in range(DRAWS)] for style in STYLES]
            self.facts.append([(statistics.fmean(d), statistics.stdev(d)) for d in drawn])

    def word(self, rng: random.Random) -> str:
        out, state = [], 0
        while len(out) < 12:
            state = bisect.bisect_left(self.chain[state], rng.random())
            if not 0 < state < _STATES:
                break
            out.append(SYMBOLS[state - 1])
        return "".join(out)

    def token(self, rng: random.Random, length: int, joint: str, written: str) -> str:
        """An ordinary token: words joined in a style, cut to its length."""
        out = self.word(rng)
        while len(out) < length:
            how = rng.choice(("title", "lower", "upper")) if written == "any" else written
            between = rng.choice(("", "_", "-", "/", str(rng.randrange(10)), str(rng.randrange(100)))) if joint == "any" else joint
            out += between + getattr(self.word(rng), how)()
        return out[:length]

    def score(self, length: int, statistic: float) -> float:
        """-log2 of the chance that an ordinary token of this length looks as random; 0 where the battery rejects randomness."""
        if statistic == math.inf:
            return 0.0
        facts = self.facts[max(0, bisect.bisect_right(LENGTHS, length) - 1)]
        chance = max(0.5 * math.erfc((mean - statistic) / deviation / math.sqrt(2)) for mean, deviation in facts)
        return -math.log2(max(chance, 2.0**-1000))


def tested(text: str) -> list[tuple[int, int]]:
    """(start, end) of every run the battery looks at."""
    return [m.span() for m in _RUN.finditer(text)]


def scan(spark: SparkSession, docs: DataFrame, level: float = LEVEL) -> DataFrame:
    """doc_id, base and found: arrays of (start, end, kind) and (start, end, -log2 p) of every whole text.

    found holds what the false-discovery rule lets through over the whole corpus.
    """
    ship_texts(spark)
    span = "struct<start:int,end:int,{}>"
    base_type, token_type, run_type = span.format("kind:string"), span.format("token:string"), span.format("score:double")
    span_arrow = lambda name, kind: pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), (name, kind)]))
    as_rows = lambda name, found, kind: pa.array([[dict(zip(("start", "end", name), s)) for s in f] for f in found], span_arrow(name, kind))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(_STATES * _STATES, np.int64)
        none = pa.array([None], pa.list_(pa.int64()))
        for batch in small(batches):
            texts = batch.column("_of_text").to_pylist()
            runs = [[(a, b, t[a:b]) for a, b in tested(t)] for t in texts]
            pairs += letter_pairs(texts, [r[2] for f in runs for r in f])
            columns = [batch.column("doc_id"), as_rows("kind", map(base_spans, texts), pa.string()), as_rows("token", runs, pa.string()), pa.nulls(len(batch), none.type)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "base", "runs", "pairs"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), as_rows("kind", [[]], pa.string()), as_rows("token", [[]], pa.string()), pa.array([pairs], none.type)], ["doc_id", "base", "runs", "pairs"])

    texts = docs.select("doc_id", clean_text().alias("_of_text"))
    rows = written(spark, texts.mapInArrow(find, f"doc_id long, base array<{base_type}>, runs array<{token_type}>, pairs array<long>"), "spans")
    # One row for each pair of states.
    counts = rows.filter("pairs is not null").select(F.posexplode("pairs").alias("at", "n")).filter("n <> 0").groupBy("at").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros(_STATES * _STATES, np.int64)
    for r in counts:
        pairs[r["at"]] = r["n"]
    null = spark.sparkContext.broadcast(Null(pairs))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [[(r["start"], r["end"], null.value.score(len(r["token"]), null.value.battery.statistic(r["token"]))) for r in f] for f in batch.column("runs").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("base"), as_rows("score", runs, pa.float64())], ["doc_id", "base", "runs"])

    judged = rows.filter("pairs is null").select("doc_id", "base", "runs").mapInArrow(judge, f"doc_id long, base array<{base_type}>, runs array<{run_type}>")
    judged = written(spark, judged, "judged")
    edge = threshold(judged, level)
    return judged.select("doc_id", "base", F.filter("runs", lambda r: r["score"] >= F.lit(edge)).alias("found"))


def threshold(judged: DataFrame, level: float) -> float:
    """Least -log2 p reported: p <= level * number reported / m, in steps of a quarter bit."""
    steps = judged.select(F.explode("runs.score").alias("e")).groupBy(F.least(F.floor(F.col("e") * 4), F.lit(TOP_STEP)).alias("step")).count().collect()
    total = sum(r["count"] for r in steps)
    reported, edge = 0, math.inf
    for row in sorted(steps, key=lambda r: -r["step"]):
        reported += row["count"]
        if row["step"] / 4 >= math.log2(total / (level * reported)):
            edge = row["step"] / 4
    return edge


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of scan()'s rows."""
    said = lambda s, kind: F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))
    base = F.transform("base", lambda s: said(s, s["kind"]))
    ranked = F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("a"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"), said(s, s["kind"]).alias("t"))),
        F.transform("found", lambda s: F.struct(s["start"].alias("a"), F.lit(len(KINDS) + 1).cast("long").alias("k"), said(s, F.lit("random")).alias("t"))),
    )
    of_kind = lambda kind: F.filter("base", lambda s: s["kind"] == F.lit(kind))
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return scanned.select(
        "doc_id",
        *counts,
        F.sha2(F.concat_ws(",", base).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform(F.array_sort(ranked), lambda s: s["t"])).alias("spans"),
    )
