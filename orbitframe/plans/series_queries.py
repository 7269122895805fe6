"""Queries on pixel time series and vectors."""

from __future__ import annotations

import math

from pyspark.sql import Window, functions as F

from ..functions import scalar
from ..operators import network, series
from .registry import query, table, vectors

#: Parameters of the proxies: a mean and a deviation for events.value.
MEAN, DEVIATION, SEED, DRAWN = 49.63, 28.79, 7, 40


def _observed(spark, d):
    """Events as observations: pixel, doy, mask, value."""
    return table(spark, d, "events").select(
        F.col("user_id").alias("pixel"), F.dayofyear("ts").alias("doy"), "event_id", "event_type", "ts",
        (F.col("event_type") != "error").cast("int").alias("mask"), F.when(F.col("event_id") % 4 == 0, 0.0).otherwise(F.col("value")).alias("value"),
    )


_OBSERVED = """
    SELECT user_id AS pixel, CAST(dayofyear(ts) AS INTEGER) AS doy, event_id, event_type, ts,
           CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END AS mask, CASE WHEN event_id % 4 = 0 THEN 0.0 ELSE value END AS value
    FROM events
"""


@query(f"WITH o AS ({_OBSERVED}) SELECT pixel, doy, arg_max(value, {{'s': value <> 0, 'e': event_id}}) AS value FROM o GROUP BY pixel, doy")
def doy_mosaic_last_nonzero(spark, d):
    return series.mosaic(_observed(spark, d), ["pixel", "doy"], "value", ["event_id"])


@query(f"WITH o AS ({_OBSERVED}) SELECT pixel, doy, arg_max(value, {{'m': mask, 'e': event_id}}) AS value, max(mask) AS mask FROM o GROUP BY pixel, doy")
def s2_merge_valid_first(spark, d):
    return series.merge_valid_first(_observed(spark, d), ["pixel", "doy"], "value", "mask", ["event_id"])


@query(f"WITH o AS ({_OBSERVED}) SELECT pixel, doy, arg_max(value, event_id) AS value FROM o WHERE event_type IN ('click', 'purchase') GROUP BY pixel, doy")
def s1_merge_last_wins(spark, d):
    rows = _observed(spark, d).filter(F.col("event_type").isin("click", "purchase"))
    return series.merge_last(rows, ["pixel", "doy"], "value", ["event_id"])


@query(f"""
    WITH o AS ({_OBSERVED}), m AS (
        SELECT pixel, doy, arg_max(CASE WHEN value > 0 THEN least(greatest((20 * log10(greatest(value, 1e-6)) + 50) * 200, 0), 30000) ELSE 0 END, {{'m': mask, 'e': event_id}}) AS db, max(mask) AS mask
        FROM o GROUP BY pixel, doy),
    s AS (SELECT pixel, bool_or(db <> 0) AS seen, sum(mask) AS optical_steps, count(*) AS days, round(avg(CAST(trunc(db) AS INTEGER)), 6) AS mean_db FROM m GROUP BY pixel),
    r AS (SELECT pixel, count(*) FILTER (value <> 0) AS radar_steps FROM o WHERE event_type IN ('click', 'purchase') GROUP BY pixel)
    SELECT s.pixel, CAST(optical_steps AS BIGINT) AS optical_steps, coalesce(radar_steps, 0) AS radar_steps, days, mean_db
    FROM s LEFT JOIN r ON s.pixel = r.pixel WHERE seen AND optical_steps >= 5 AND coalesce(radar_steps, 0) >= 5
""")
def valid_pixels(spark, d):
    """Scan, radar scaling, valid-first merge by pixel and day, pixel filter, per-pixel statistics."""
    rows = _observed(spark, d)
    scaled = F.when(F.col("value") > 0, scalar.sar_db(F.col("value")).cast("int")).otherwise(0)
    merged = series.merge_valid_first(rows.withColumn("db", scaled), ["pixel", "doy"], "db", "mask", ["event_id"])
    optical = merged.select("pixel", F.array("db").alias("bands"), "mask", "db")
    facts = F.count(F.lit(1)).alias("days"), F.round(F.avg("db"), 6).alias("mean_db")
    radar = rows.filter(F.col("event_type").isin("click", "purchase")).select("pixel", F.array("value").alias("bands"))
    return series.valid_pixels(optical, radar, ["pixel"], 5, facts)


@query(f"""
    WITH o AS ({_OBSERVED})
    SELECT pixel, string_agg(strftime(ts, '%Y-%m-%d %H:%M:%S') || '#' || CAST(event_id AS VARCHAR), ',' ORDER BY ts, event_id) AS steps, count(*) AS n FROM o GROUP BY pixel
""")
def pixel_series(spark, d):
    made = series.pixel_series(_observed(spark, d), ["pixel"], ["ts", "event_id"])
    said = F.transform("series", lambda s: F.concat_ws("#", F.date_format(s["ts"], "yyyy-MM-dd HH:mm:ss"), s["event_id"].cast("string")))
    return made.select("pixel", F.array_join(said, ",").alias("steps"), F.size("series").cast("long").alias("n"))


@query(f"""
    WITH o AS ({_OBSERVED}), u AS (
        SELECT pixel, event_id, 'A' AS orbit FROM o WHERE event_type = 'click' UNION ALL SELECT pixel, event_id, 'D' FROM o WHERE event_type = 'purchase')
    SELECT pixel, event_id, orbit, row_number() OVER (PARTITION BY pixel ORDER BY orbit, event_id) AS place FROM u
""")
def orbit_concat(spark, d):
    rows = _observed(spark, d).select("pixel", "event_id", "event_type")
    both = series.union_orbits(rows.filter("event_type = 'click'").drop("event_type"), rows.filter("event_type = 'purchase'").drop("event_type"))
    packed = series.pixel_series(both, ["pixel"], ["orbit", "event_id"])
    placed = packed.select("pixel", F.posexplode("series").alias("p", "s"))
    return placed.select("pixel", "s.event_id", "s.orbit", (F.col("p") + 1).cast("long").alias("place"))


_POOL = f"""
    WITH o AS ({_OBSERVED}), b AS (SELECT pixel, event_id, mask, max(mask) OVER (PARTITION BY pixel) AS best FROM o),
    p AS (SELECT pixel, event_id, row_number() OVER (PARTITION BY pixel ORDER BY md5(concat_ws('|', '{SEED}', CAST(pixel AS VARCHAR), CAST(event_id AS VARCHAR))), event_id) AS drawn FROM b WHERE mask = best),
    l AS (SELECT pixel, list(event_id ORDER BY event_id) AS pool, count(*) AS n FROM p WHERE drawn <= DRAWN GROUP BY pixel)
"""


@query(_POOL.replace("DRAWN", str(DRAWN)) + f"""
    , t AS (SELECT pixel, unnest(CASE WHEN n >= {DRAWN} THEN pool ELSE list_sort(list_transform(range({DRAWN}), lambda i:
            pool[1 + CAST('0x' || substr(md5(concat_ws('|', '{SEED}', CAST(pixel AS VARCHAR), CAST(i AS VARCHAR))), 1, 8) AS BIGINT) % n])) END) AS event_id FROM l)
    SELECT pixel, event_id, CAST(row_number() OVER (PARTITION BY pixel ORDER BY event_id) - 1 AS INTEGER) AS place FROM t
""")  # fmt: skip
def sample_steps(spark, d):
    """Pixels of 40 valid steps are sampled without replacement, the others with."""
    return series.sample_steps(_observed(spark, d), ["pixel"], "event_id", DRAWN, SEED, valid=F.col("mask") == 1)


@query(_POOL.replace("DRAWN", "3") + ", t AS (SELECT pixel, unnest(pool) AS event_id FROM l WHERE n >= 3) SELECT pixel, event_id, CAST(row_number() OVER (PARTITION BY pixel ORDER BY event_id) - 1 AS INTEGER) AS place FROM t")
def sample_k_without_replacement(spark, d):
    rows = _observed(spark, d)
    drawn = series.sample_steps(rows, ["pixel"], "event_id", 3, SEED, valid=F.col("mask") == 1)
    enough = rows.groupBy("pixel").agg(F.sum("mask").alias("valid"), F.count(F.lit(1)).alias("n"))
    return drawn.join(enough.filter("valid >= 3 or (valid = 0 and n >= 3)").select("pixel"), "pixel", "left_semi")


@query(_POOL.replace("DRAWN", str(DRAWN)) + f"""
    , t AS (SELECT pixel, n, unnest(list_sort(list_transform(range({DRAWN}), lambda i:
            pool[1 + CAST('0x' || substr(md5(concat_ws('|', '{SEED}', CAST(pixel AS VARCHAR), CAST(i AS VARCHAR))), 1, 8) AS BIGINT) % n]))) AS event_id FROM l WHERE n < {DRAWN})
    SELECT pixel, event_id, count(*) AS draws FROM t GROUP BY pixel, event_id
""")
def sample_k_with_replacement(spark, d):
    """How often each step of the pixels with fewer steps than draws is drawn."""
    rows = _observed(spark, d)
    drawn = series.sample_steps(rows, ["pixel"], "event_id", DRAWN, SEED, valid=F.col("mask") == 1)
    pools = rows.groupBy("pixel").agg(F.sum("mask").alias("valid"), F.count(F.lit(1)).alias("n"))
    few = pools.filter(F.when(F.col("valid") > 0, F.col("valid")).otherwise(F.col("n")) < DRAWN).select("pixel")
    return drawn.join(few, "pixel", "left_semi").groupBy("pixel", "event_id").agg(F.count(F.lit(1)).alias("draws"))


@query(f"SELECT event_id, round((value - {MEAN}::DOUBLE) / ({DEVIATION}::DOUBLE + 1e-9), 6) AS z, CAST(trunc(value) AS INTEGER) AS whole FROM events")
def standardize(spark, d):
    return table(spark, d, "events").select("event_id", F.round(scalar.standardise(F.col("value"), MEAN, DEVIATION), 6).alias("z"), F.col("value").cast("int").alias("whole"))


@query("""
    SELECT doy, CAST(k AS INTEGER) AS place, round(CASE WHEN k % 2 = 0 THEN sin(doy * exp(-(k // 2) * 2 * ln(10000) / 16)) ELSE cos(doy * exp(-(k // 2) * 2 * ln(10000) / 16)) END, 6) AS e
    FROM (SELECT DISTINCT CAST(dayofyear(ts) AS INTEGER) AS doy FROM events), (SELECT unnest(range(16)) AS k)
""")
def doy_encoding(spark, d):
    days = table(spark, d, "events").select(F.dayofyear("ts").alias("doy")).distinct()
    return days.select("doy", F.posexplode(scalar.doy_encoding(F.col("doy"), 16)).alias("place", "e")).withColumn("e", F.round("e", 6))


@query("""
    WITH e AS (SELECT user_id, value, exp(value / 10 - max(value / 10) OVER (PARTITION BY user_id)) AS w FROM events)
    SELECT user_id, round(sum(w * value) / sum(w), 6) AS pooled FROM e GROUP BY user_id
""")
def attention_pool(spark, d):
    rows = table(spark, d, "events").withColumn("score", F.col("value") / 10)
    return series.attention_pool(rows, ["user_id"], "score", "value").select("user_id", F.round("pooled", 6).alias("pooled"))


@query("""
    SELECT vec_id, o AS place, round(list_sum(list_transform(range(64), lambda i: sin(8 * i + o + 1) * embedding[i + 1]::DOUBLE)), 5) AS y
    FROM embeddings, (SELECT CAST(unnest(range(4)) AS INTEGER) AS o)
""")
def linear_reducer(spark, d):
    weights = [[math.sin(8 * i + o + 1) for i in range(64)] for o in range(4)]
    made = table(spark, d, "embeddings").select("vec_id", F.posexplode(series.reduce_vector(F.col("embedding"), weights)).alias("place", "y"))
    return made.withColumn("y", F.round("y", 5))


def _pairs(spark, d):
    """Each vector with the next one, the last with the first."""
    rows, n = table(spark, d, "embeddings").select("vec_id", "embedding"), vectors(spark, d)
    other = rows.select(F.pmod(F.col("vec_id") + (n - 1), F.lit(n)).alias("vec_id"), F.col("embedding").alias("other"))
    return rows.join(other, "vec_id")


_PAIRS = "SELECT a.vec_id, a.embedding AS x, b.embedding AS y FROM embeddings a JOIN embeddings b ON b.vec_id = (a.vec_id + 1) % (SELECT max(vec_id) + 1 FROM embeddings)"


@query(f"WITH p AS ({_PAIRS}) SELECT vec_id, CAST(len(x || y) AS INTEGER) AS n, round((x || y)[65]::DOUBLE, 6) AS first_of_second FROM p")
def fusion_concat(spark, d):
    fused = _pairs(spark, d).select("vec_id", series.fuse(F.col("embedding"), F.col("other")).alias("v"))
    return fused.select("vec_id", F.size("v").alias("n"), F.round(F.col("v")[64].cast("double"), 6).alias("first_of_second"))


@query(f"WITH p AS ({_PAIRS}) SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: (x[i]::DOUBLE + y[i]::DOUBLE) ** 2)), 5) AS norm FROM p")
def fusion_sum(spark, d):
    as_double = lambda c: F.transform(c, lambda x: x.cast("double"))
    fused = _pairs(spark, d).select("vec_id", series.fuse(as_double("embedding"), as_double("other"), "sum").alias("v"))
    return fused.select("vec_id", F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x), 5).alias("norm"))


@query("""
    WITH u AS (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS place FROM embeddings)
    SELECT label, CAST(place AS INTEGER) AS place, round(avg(x::DOUBLE), 6) AS mean FROM u GROUP BY label, place
""")
def repeat_mean(spark, d):
    return series.mean_vectors(table(spark, d, "embeddings"), "label", "embedding").withColumn("mean", F.round("mean", 6))


@query("SELECT event_type, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS deviation FROM events GROUP BY event_type")
def band_stats(spark, d):
    stats = series.band_statistics(table(spark, d, "events"), "event_type", "value")
    return stats.select("event_type", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"))


@query(f"""
    WITH o AS ({_OBSERVED}), w AS (SELECT pixel, doy, max(value) FILTER (event_type = 'click') AS a, max(value) FILTER (event_type = 'purchase') AS b FROM o GROUP BY pixel, doy)
    SELECT pixel, doy, coalesce(a, 0) AS a, coalesce(b, 0) AS b, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 1 ELSE 0 END AS mask FROM w
""")
def s2_stack(spark, d):
    both = F.col("click").isNotNull() & F.col("purchase").isNotNull()
    made = series.optical_stack(_observed(spark, d), ["pixel", "doy"], "event_type", "value", ["click", "purchase"], both)
    return made.select("pixel", "doy", F.col("bands")[0].alias("a"), F.col("bands")[1].alias("b"), F.col("mask").cast("int").alias("mask"))


#: A model small enough for SQL: two bands a sensor, width 4, two heads, one layer, three steps.
_TOY = network.Config(optical_bands=2, radar_bands=2, latent=1, heads=2, layers=1, hidden=4, steps=3)
_FACTS = ([MEAN, 6.5], [DEVIATION, 2.7])


def _linear(name: str, x: str) -> str:
    """SQL of a linear layer of a list."""
    w = network.random_weights(_TOY, 3)
    rows = ", ".join("[" + ", ".join(f"{v!r}::DOUBLE" for v in [*row.tolist(), float(b)]) + "]" for row, b in zip(w[f"{name}.weight"], w[f"{name}.bias"]))
    return f"list_transform([{rows}], lambda r: list_dot_product(r, list_append({x}, 1.0)))"


def _tower(t: str) -> str:
    """SQL of a tower: from {t}_x (pixel, k, b, doy) to {t} (pixel, v)."""
    plus = lambda a, b: f"list_transform(list_zip({a}, {b}), lambda z: z[1] + z[2])"
    relu = lambda a: f"list_transform({a}, lambda v: greatest(v, 0))"
    norm = "list_transform(y, lambda v: (v - list_avg(y)) / sqrt(list_var_pop(y) + 1e-5))"
    days = "[sin(doy * 1.0), cos(doy * 1.0), sin(doy * exp(-ln(10000) / 2)), cos(doy * exp(-ln(10000) / 2))]"
    gate = "(1 / (1 + exp(-(g[{0} + i] + c[{0} + i]))))"
    state = f"list_transform(range(1, 5), lambda i: (1 - {gate.format(4)}) * tanh(g[8 + i] + {gate.format(0)} * c[8 + i]) + {gate.format(4)} * s[i])"
    steps = [f"{t}_s0 AS (SELECT pixel, k, {state} AS s FROM (SELECT pixel, k, g, [0.0, 0.0, 0.0, 0.0] AS s, {_linear(f'{t}.gru_h', '[0.0, 0.0, 0.0, 0.0]')} AS c FROM {t}_g WHERE k = 0))"]
    for k in (1, 2):
        steps.append(f"{t}_s{k} AS (SELECT pixel, k, {state} AS s FROM (SELECT g.pixel, g.k, g.g, p.s, {_linear(f'{t}.gru_h', 'p.s')} AS c FROM {t}_g g JOIN {t}_s{k - 1} p ON p.pixel = g.pixel AND g.k = {k}))")
    return f"""
    {t}_e AS (SELECT pixel, k, {plus(_linear(f"{t}.embed1", relu(_linear(f"{t}.embed0", "b"))), days)} AS h FROM {t}_x),
    {t}_p AS (SELECT *, {_linear(f"{t}.layer0.in", "h")} AS p FROM {t}_e),
    {t}_a AS (SELECT a.pixel, a.k, j, list_dot_product(a.p[1 + 2 * j:2 + 2 * j], b.p[5 + 2 * j:6 + 2 * j]) / sqrt(2) AS s, b.p[9 + 2 * j] AS v1, b.p[10 + 2 * j] AS v2
              FROM {t}_p a JOIN {t}_p b ON a.pixel = b.pixel, (SELECT unnest([0, 1]) AS j)),
    {t}_w AS (SELECT *, exp(s - max(s) OVER (PARTITION BY pixel, k, j)) AS e FROM {t}_a),
    {t}_m AS (SELECT pixel, k, j, sum(e * v1) / sum(e) AS m1, sum(e * v2) / sum(e) AS m2 FROM {t}_w GROUP BY ALL),
    {t}_o AS (SELECT pixel, k, [max(m1) FILTER (j = 0), max(m2) FILTER (j = 0), max(m1) FILTER (j = 1), max(m2) FILTER (j = 1)] AS o FROM {t}_m GROUP BY ALL),
    {t}_n AS (SELECT pixel, k, {norm} AS h FROM (SELECT e.pixel, e.k, {plus("h", _linear(f"{t}.layer0.out", "o"))} AS y FROM {t}_e e JOIN {t}_o o ON e.pixel = o.pixel AND e.k = o.k)),
    {t}_h AS (SELECT pixel, k, {norm} AS h FROM (SELECT pixel, k, {plus("h", _linear(f"{t}.layer0.ff1", relu(_linear(f"{t}.layer0.ff0", "h"))))} AS y FROM {t}_n)),
    {t}_g AS (SELECT pixel, k, {_linear(f"{t}.gru_x", "h")} AS g FROM {t}_h), {", ".join(steps)},
    {t}_c AS (SELECT pixel, k, ({_linear(f"{t}.score", "s")})[1] AS c FROM (SELECT * FROM {t}_s0 UNION ALL SELECT * FROM {t}_s1 UNION ALL SELECT * FROM {t}_s2)),
    {t}_q AS (SELECT h.pixel, h, exp(c - max(c) OVER (PARTITION BY h.pixel)) AS e FROM {t}_c c JOIN {t}_h h ON c.pixel = h.pixel AND c.k = h.k),
    {t} AS (SELECT pixel, [sum(e * h[1]) / sum(e), sum(e * h[2]) / sum(e), sum(e * h[3]) / sum(e), sum(e * h[4]) / sum(e)] AS v FROM {t}_q GROUP BY pixel)"""


_SCALED = ", ".join(f"({x} - {m}::DOUBLE) / ({s}::DOUBLE + 1e-9)" for x, m, s in zip(("value", "sqrt(value)"), *_FACTS))


@query(f"""
    WITH o AS ({_OBSERVED}), first AS (
        SELECT 's2' AS sensor, *, row_number() OVER (PARTITION BY pixel ORDER BY event_id) - 1 AS k FROM o WHERE mask = 1
        UNION ALL SELECT 's1', *, row_number() OVER (PARTITION BY pixel ORDER BY event_id) - 1 FROM o WHERE event_type IN ('click', 'purchase')),
    s2_x AS (SELECT pixel, k, [{_SCALED}] AS b, doy FROM first WHERE sensor = 's2' AND k < 3 AND pixel IN (SELECT pixel FROM first WHERE sensor = 's2' AND k = 2)),
    s1_x AS (SELECT pixel, k, [{_SCALED}] AS b, doy FROM first WHERE sensor = 's1' AND k < 3 AND pixel IN (SELECT pixel FROM first WHERE sensor = 's1' AND k = 2)),
    {_tower("s2")}, {_tower("s1")},
    r AS (SELECT pixel, {_linear("reduce", "v")} AS y FROM (SELECT a.pixel, a.v || b.v AS v FROM s2 a JOIN s1 b ON a.pixel = b.pixel))
    SELECT pixel, CAST(generate_subscripts(y, 1) - 1 AS INTEGER) AS place, round(CAST(CAST(unnest(y) AS FLOAT) AS DOUBLE), 4) + 0.0::DOUBLE AS x FROM r
""")
def nn_forward_toy(spark, d):
    """Two towers over each pixel's first three steps of either sensor: embedding, attention, recurrence, pooling, reduction."""
    rows = _observed(spark, d).withColumn("bands", F.array("value", F.sqrt("value")))

    def inputs(name, kept):
        first = kept.withColumn("place", F.row_number().over(Window.partitionBy("pixel").orderBy("event_id")) - 1).filter(F.col("place") < _TOY.steps)
        return network.model_input(first, ["pixel"], *_FACTS, name).filter(F.size(name) == _TOY.steps)

    both = inputs("s2", rows.filter("mask = 1")).join(inputs("s1", rows.filter("event_type in ('click', 'purchase')")), "pixel")
    made = network.represent(both, ["pixel"], network.random_weights(_TOY, 3), _TOY, dtype="float64")
    return made.select("pixel", F.posexplode("vec").alias("place", "x")).select("pixel", "place", (F.round(F.col("x").cast("double"), 4) + F.lit(0.0)).alias("x"))


@query(None)
def nn_forward_tiny(spark, d):
    """Series, sampling, standardisation, two towers: the inference plan on events, with a tiny seeded model."""
    rows = _observed(spark, d).withColumn("bands", F.array("value", F.sqrt("value")))
    config = network.Config(optical_bands=2, radar_bands=2, latent=4, heads=2, layers=1, hidden=32, steps=4)

    def inputs(name, kept, seed):
        drawn = series.sample_steps(kept, ["pixel"], "event_id", config.steps, seed)
        return network.model_input(drawn.join(kept.select("pixel", "event_id", "bands", "doy"), ["pixel", "event_id"]), ["pixel"], [MEAN, 6.5], [DEVIATION, 2.7], name)

    both = inputs("s2", rows.filter("mask = 1"), 1).join(inputs("s1", rows.filter("event_type in ('click', 'purchase')"), 2), "pixel")
    made = network.represent(both, ["pixel"], network.random_weights(config, 3), config)
    return made.select("pixel", F.posexplode("vec").alias("place", "x")).select("pixel", "place", F.round(F.col("x").cast("double"), 4).alias("x"))
