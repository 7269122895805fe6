"""Mixing sources to target weights by a low-discrepancy schedule; DataFrame functions only.

Targets: sources share `share` times all words by weight; a source stops at `most`
times its own words and its excess is shared again by weight. The level at which
this settles comes from one pass over the sources in order of cap / weight.

Each source's documents, shuffled by a seeded hash, form a stream of words that runs
`most` times and is cut into blocks of equal size. The mix is cut into as many slots. The
points of the van der Corput sequence, mapped through the cumulative targets, give each
slot a source; slots are ranked per source, and the slot of rank r takes the source's block
r (the last slot only what the mix still lacks; a rank beyond the stream's end takes nothing).
So a source takes what the points give it, within a few slots of its target, and documents take the
words of their blocks, never more than `most` times their size.

The rank of a slot is arithmetic: of the first i points, those below a bound are counted
by the binary digits of the bound, so no slots are sorted or brought together. Running sums
of sizes go in two levels (buckets of a hash, then within a bucket), so no source, however large,
meets in one task; only rows per source, or per source and bucket, do. Null texts and texts without
words have size 0 and take 0; a null source is a source, last in order; repeated rows each
count; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import clean_text, packed, written

#: Words of a block; at least SLOTS slots are made, so small inputs get smaller blocks.
BLOCK_WORDS, SLOTS = 2048, 1 << 16
#: Binary digits of the points: slot i gets i with its POINT_BITS digits reversed.
POINT_BITS = 40
#: Cells in which a point's source is looked up, as a power of two.
CELL_BITS = 12
#: Binary digits of the hash that shuffles documents; its first ones are a document's bucket.
HASH_BITS = 60
WEIGHTS = (3, 1, 2)


def words(text: Column) -> Column:
    """Number of runs of characters outside [\\x20\\x09-\\x0D]."""
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """source, size, weight, target of rows (source, size): one row per source.

    Both windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("size") * F.lit(float(most)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "all": F.sum("size").over(whole) * F.lit(float(share)),
        "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    })
    # with the sources before it at their caps, this one's level; the first that stays below its cap has the highest such level and settles it
    rows = rows.withColumn("level", F.greatest((F.col("all") - F.col("capped")) / F.col("open"), F.lit(0.0)))
    settled = F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(whole)
    target = F.least(F.col("cap"), F.coalesce(settled * F.col("weight"), F.col("cap")))
    return rows.select("source", "size", "weight", target.alias("target"))


def mix(spark: SparkSession, docs: DataFrame, share: float = 1.5, most: int = 2, weights: tuple[float, ...] = WEIGHTS, seed: int = 17) -> DataFrame:
    """doc_id, size, source, source_size, target, taken, first_slots for every row of docs.

    first_slots: of each run through the stream that takes words of the row, the slot that takes the first.
    """
    rows = docs.select("doc_id", "source", words(clean_text()).alias("size"))
    digits = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), "source")), 1, HASH_BITS // 4)
    rows = written(spark, rows.withColumn("h", F.conv(digits, 16, 10).cast("long")), "sizes")
    sources = written(spark, targets(rows.groupBy("source").agg(F.sum("size").alias("size")), share, most, weights), "targets")
    total = sources.agg(F.floor(F.coalesce(F.sum("target"), F.lit(0.0)) + F.lit(1e-6)).cast("long")).first()[0]
    block = max(1, min(BLOCK_WORDS, total // SLOTS))
    made = -(-total // block)
    bounds = written(spark, intervals(sources), "bounds")

    # Place of each document in its source's shuffled stream: buckets of the hash, then within.
    n = rows.count()
    rows = rows.withColumn("bucket", F.shiftright("h", HASH_BITS - max(4, (n**0.5 / 4).__ceil__().bit_length())))
    by_bucket = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    by_bucket = by_bucket.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
    within = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "size")
    rows = rows.withColumns({
        "row": F.row_number().over(within),
        "inner": F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    })
    by_bucket = by_bucket.select(F.col("source").alias("s2"), F.col("bucket").alias("b2"), "bucket_start")
    rows = rows.join(by_bucket, F.col("source").eqNullSafe(F.col("s2")) & (F.col("bucket") == F.col("b2"))).drop("s2", "b2")
    given = _below(F.lit(made), F.col("high_terms")) - _below(F.lit(made), F.col("low_terms"))
    facts = sources.join(bounds.select(F.col("source").alias("s3"), given.alias("given")), F.col("source").eqNullSafe(F.col("s3")), "left")
    facts = facts.select(F.col("source").alias("s2"), F.col("size").alias("source_size"), "target", F.coalesce("given", F.lit(0)).alias("given"))
    rows = rows.join(facts, F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    start = F.col("bucket_start") + F.col("inner")

    # Pieces: where a document's words of each run through the stream fall into blocks that have a slot.
    runs = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: start + k * F.col("source_size"))
    rows = rows.select("*", F.posexplode(runs).alias("turn", "run")).withColumn("end", F.col("run") + F.col("size"))
    first = F.floor(F.col("run") / block)
    last = F.least(F.floor((F.col("end") - 1) / block), F.col("given") - 1)
    pieces = rows.withColumn("block", F.explode_outer(F.when((F.col("size") > 0) & (first <= last), F.sequence(first, last))))
    slots = schedule(spark, bounds, made).select(F.col("source").alias("s2"), F.col("rank").alias("r2"), "slot")
    pieces = pieces.join(slots, F.col("source").eqNullSafe(F.col("s2")) & (F.col("block") == F.col("r2")), "left")
    upto = F.col("block") * block + F.least(F.lit(block), F.lit(total) - F.col("slot") * block)
    got = F.least(F.col("end"), upto) - F.greatest(F.col("run"), F.col("block") * block)
    got = F.when(F.col("slot").isNotNull(), F.greatest(got, F.lit(0))).otherwise(0)
    keys = ["doc_id", "size", "source", "source_size", "target", "bucket", "row"]
    turns = [F.min(F.when((F.col("turn") == k) & (got > 0), F.col("slot"))) for k in range(most)]
    taken = pieces.groupBy(*keys).agg(F.sum(got).cast("long").alias("taken"), F.array_compact(F.array(*turns)).alias("first_slots"))
    return taken.drop("bucket", "row")


def intervals(sources: DataFrame) -> DataFrame:
    """source, low, high, low_terms, high_terms of rows (source, target): each source's part of the points.

    The terms of a bound say how many of the first points lie below it (see _below). The
    windows run over one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ends = sources.filter("target > 0").withColumn("upto", F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.withColumn("high", F.floor(F.col("upto") / F.max("upto").over(Window.partitionBy()) * F.lit(float(1 << POINT_BITS))).cast("long"))
    ends = ends.withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0)))
    return ends.select("source", "low", "high", _terms(F.col("low")).alias("low_terms"), _terms(F.col("high")).alias("high_terms"))


def _reversed(value: Column, digits: Column) -> Column:
    """value with its last binary digits in reverse order."""
    return F.when(digits == 0, F.lit(0)).otherwise(F.conv(F.reverse(F.lpad(F.bin(value), digits, "0")), 2, 10).cast("long"))


def _terms(bound: Column) -> Column:
    """Array of (first, step): for each 1 among the bound's digits, the points of one part below it.

    The points below the bound fall into parts that share their leading digits; as a point's
    leading digits are its slot's last ones reversed, a part holds the slots first, first + 2**step, ...
    """
    shifted = lambda b: F.call_function("shiftright", bound, b)
    ones = F.filter(F.sequence(F.lit(0), F.lit(POINT_BITS)), lambda b: shifted(b) % 2 == 1)
    return F.transform(ones, lambda b: F.struct(_reversed(shifted(b) - 1, F.lit(POINT_BITS) - b).alias("first"), (F.lit(POINT_BITS) - b).alias("step")))


def _below(slots: Column, terms: Column) -> Column:
    """How many of the first `slots` points lie below the bound of the terms."""
    more = lambda t: F.when(slots > t["first"], F.call_function("shiftright", slots - t["first"] - 1, t["step"]) + 1).otherwise(F.lit(0))
    return F.aggregate(terms, F.lit(0).cast("long"), lambda n, t: n + more(t))


def schedule(spark: SparkSession, bounds: DataFrame, made: int) -> DataFrame:
    """slot, source, rank (from 0) of the first `made` slots: the order in which the mix takes each source's blocks."""
    # A point finds its interval by the cell it lies in: an equal join, not a range join over all sources.
    cell = lambda c: F.shiftright(c, POINT_BITS - CELL_BITS)
    cells = bounds.filter("low < high").withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high") - 1))))
    points = spark.range(made).select(F.col("id").alias("slot"), _reversed(F.col("id"), F.lit(POINT_BITS)).alias("point"))
    points = points.withColumn("cell", cell(F.col("point"))).join(cells, "cell").filter("point >= low and point < high")
    return points.select("slot", "source", (_below(F.col("slot"), F.col("high_terms")) - _below(F.col("slot"), F.col("low_terms"))).alias("rank"))


def mixed_rows(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """docs as the mix takes them, in the order of its slots: each row as often as the mix takes its words, to the nearest whole time.

    The decisions join back on (doc_id, source); rows that agree in both take turns'
    mean, so a repeated doc_id within a source is repeated evenly. Null texts and texts without
    words have nothing to take and aren't part of the mix; an empty table stays empty.
    """
    most = options.get("most", 2)
    mixed = mix(spark, docs, **options).filter("taken > 0")
    slots = F.array_compact(F.array(*[F.min(F.get("first_slots", F.lit(k))) for k in range(most)]))
    times = mixed.groupBy(F.col("doc_id").alias("_of_i"), F.col("source").alias("_of_s")).agg(
        F.round(F.sum("taken") / F.sum("size")).cast("int").alias("_of_times"), slots.alias("_of_slots")
    )
    times = times.filter("_of_times > 0")
    rows = packed(docs, "doc_id", "source")
    taken = rows.join(times, F.col("_of_doc_id").eqNullSafe(F.col("_of_i")) & F.col("_of_source").eqNullSafe(F.col("_of_s")))
    turns = F.transform(F.sequence(F.lit(0), F.col("_of_times") - 1), lambda k: F.coalesce(F.get("_of_slots", k), F.get("_of_slots", F.lit(0))))
    return taken.select("_of_doc", F.explode(turns).alias("_of_slot")).orderBy("_of_slot").select("_of_doc.*")


#: The rows of mix() over `documents`, with each document's first slot, as DuckDB SQL.
SQL = f"""
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
               CAST('0x' || substr(md5(concat_ws('|', '17', CAST(doc_id AS VARCHAR), source)), 1, {HASH_BITS // 4}) AS BIGINT) AS h
        FROM documents),
    s AS (SELECT source, sum(size) AS size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
    w AS (SELECT source, CAST(size AS BIGINT) AS size, CAST([{", ".join(map(str, WEIGHTS))}][(k - 1) % {len(WEIGHTS)} + 1] AS DOUBLE) AS weight, size * 2.0::DOUBLE AS cap FROM s),
    l AS (SELECT *, sum(size) OVER () * 1.5::DOUBLE AS words, coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                 sum(weight) OVER () - coalesce(sum(weight) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over
          FROM w WINDOW f AS (ORDER BY cap / weight, source NULLS LAST)),
    v AS (SELECT *, greatest((words - capped) / left_over, 0) AS level FROM l),
    t AS (SELECT source, size, least(cap, coalesce(max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight, cap)) AS target FROM v),
    b AS (SELECT total, greatest(1, least({BLOCK_WORDS}, total // {SLOTS})) AS block FROM (SELECT CAST(floor(sum(target) + 1e-6) AS BIGINT) AS total FROM t)),
    i AS (SELECT source, CAST(floor(upto / max(upto) OVER () * {float(1 << POINT_BITS)!r}::DOUBLE) AS BIGINT) AS high
          FROM (SELECT source, sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) AS upto FROM t WHERE target > 0)),
    j AS (SELECT source, coalesce(lag(high) OVER (ORDER BY source NULLS LAST), 0) AS low, high FROM i),
    p AS (SELECT slot, CAST(list_sum(list_transform(range({POINT_BITS}), lambda x: ((slot >> x) & 1) << ({POINT_BITS - 1} - x))) AS BIGINT) AS point
          FROM (SELECT unnest(range((total + block - 1) // block)) AS slot FROM b)),
    q AS (SELECT slot, source, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS place FROM p JOIN j ON point >= low AND point < high),
    o AS (SELECT doc_id, source, size, row_number() OVER (ORDER BY h, doc_id, size) AS number,
                 sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM d),
    r AS (SELECT o.*, t.size AS source_size, target, CAST(start + turn * t.size AS BIGINT) AS run FROM o JOIN t ON o.source IS NOT DISTINCT FROM t.source, (SELECT unnest([0, 1]) AS turn)),
    x AS (SELECT number, source, run, size, unnest(range(run // block, (run + size - 1) // block + 1)) AS place FROM r, b WHERE size > 0),
    y AS (SELECT number, slot, least(run + size, x.place * block + least(block, total - slot * block)) - greatest(run, x.place * block) AS got
          FROM x JOIN q ON x.source IS NOT DISTINCT FROM q.source AND x.place = q.place, b),
    z AS (SELECT number, CAST(sum(got) AS BIGINT) AS taken, min(slot) AS first_slot FROM y WHERE got > 0 GROUP BY number)
    SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot FROM (SELECT DISTINCT doc_id, size, source_size, target, number FROM r) LEFT JOIN z USING (number)
"""
