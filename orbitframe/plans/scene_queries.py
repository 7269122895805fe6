"""Queries on scenes, listings, names and work lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import scenes
from . import lifecycle
from .registry import query, table


@query("""
    SELECT event_id, CAST(TRUNC(LEAST(GREATEST((20 * log10(GREATEST(value, 1e-6)) + 50) * 200, 0), 30000)) AS SMALLINT) AS db
    FROM events
""")
def sar_db_scale(spark, d):
    return table(spark, d, "events").select("event_id", scalar.sar_db(F.col("value")).alias("db"))


_NAMES = """
    SELECT o_orderkey, CASE o_orderstatus
        WHEN 'F' THEN 'S1A_IW_' || strftime(o_orderdate, '%Y%m%d') || 'T054500_x_descending.tif'
        WHEN 'O' THEN 'S1A_IW_' || strftime(o_orderdate, '%Y%m%d') || 'T174500_ASCENDING.tif'
        ELSE 'xDESy_' || CAST(o_orderkey AS VARCHAR) END AS name
    FROM orders
"""


def _names(spark, d):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    name = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("S1A_IW_"), day, F.lit("T054500_x_descending.tif")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit("S1A_IW_"), day, F.lit("T174500_ASCENDING.tif")))
        .otherwise(F.concat(F.lit("xDESy_"), F.col("o_orderkey").cast("string")))
    )
    return table(spark, d, "orders").select("o_orderkey", name.alias("name"))


@query(rf"""
    WITH n AS ({_NAMES})
    SELECT o_orderkey,
           CAST(coalesce(dayofyear(try_strptime(regexp_extract(name, '(\d{{8}})T\d{{6}}', 1), '%Y%m%d')), 1) AS INTEGER) AS doy,
           CASE WHEN contains(upper(name), '_DESCENDING') THEN 'D' WHEN contains(upper(name), '_ASCENDING') THEN 'A'
                WHEN contains(upper(name), 'DES') THEN 'D' ELSE 'A' END AS orbit
    FROM n
""")
def scene_doy_orbit(spark, d):
    name = F.col("name")
    return _names(spark, d).select("o_orderkey", scalar.doy_of_name(name).alias("doy"), scalar.orbit_of_name(name).alias("orbit"))


@query("""
    SELECT o_orderkey, 'S2' || CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'B' ELSE 'C' END || '_3VXG_' || CAST(o_orderkey AS VARCHAR) AS id
    FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderkey % 3 <> 0
      AND o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31'
      AND coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN floor(o_totalprice) % 100 END, 0) <= 60
""")
def scene_filter(spark, d):
    letter = F.when(F.col("o_orderstatus") == "F", "A").when(F.col("o_orderstatus") == "O", "B").otherwise("C")
    rows = table(spark, d, "orders").select(
        "o_orderkey",
        F.concat(F.lit("S2"), letter, F.lit("_3VXG_"), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderdate").cast("timestamp").alias("datetime"),
        F.when(F.col("o_orderkey") % 7 != 0, F.floor("o_totalprice") % 100).cast("double").alias("cloud_cover"),
        F.when(F.col("o_orderkey") % 3 != 0, "05.00").otherwise("04.00").alias("baseline"),
    )
    return scenes.filter_optical(rows, "03VXG", "1995-01-01", "1996-12-31", cloud=60).select("o_orderkey", "id")


@query("""
    SELECT o_orderkey FROM orders
    WHERE o_orderstatus IN ('F', 'O') AND o_orderkey % 5 <> 0 AND o_orderkey % 4 <> 0 AND o_totalprice >= 100000
      AND o_orderdate BETWEEN TIMESTAMP '1994-01-01' AND TIMESTAMP '1997-06-30'
""")
def radar_filter(spark, d):
    platform = F.when(F.col("o_orderstatus") == "F", "Sentinel-1A").when(F.col("o_orderstatus") == "O", "Sentinel-1B").otherwise("Sentinel-1C")
    vv, vh = F.lit("Intensity_VV"), F.lit("Intensity_VH")
    rows = table(spark, d, "orders").select(
        "o_orderkey", platform.alias("platform"), F.when(F.col("o_orderkey") % 5 != 0, "GRD_HD").otherwise("SLC").alias("level"),
        F.lit("VV+VH").alias("polarisation"), F.col("o_orderdate").cast("timestamp").alias("datetime"),
        F.when(F.col("o_orderkey") % 4 != 0, F.array(vh, vv)).otherwise(F.array(vv)).alias("bands"), F.col("o_totalprice").alias("bytes"),
    )
    return scenes.filter_radar(rows, "1994-01-01", "1997-06-30", least_bytes=100_000).select("o_orderkey")


_LONLAT = "SELECT c_custkey, (c_custkey * 7 % 3600) / 10.0 - 180 AS lon, (c_custkey * 13 % 1640) / 10.0 - 80 AS lat FROM customer"


def _lonlat(spark, d):
    key = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", ((key * 7 % 3600) / 10.0 - 180).alias("lon"), ((key * 13 % 1640) / 10.0 - 80).alias("lat"))


@query(f"""
    WITH p AS ({_LONLAT}), z AS (
        SELECT c_custkey, lat, CAST(CASE
            WHEN lat >= 56 AND lat < 64 AND lon >= 3 AND lon < 12 THEN 32
            WHEN lat >= 72 AND lat < 84 AND lon >= 0 AND lon < 9 THEN 31
            WHEN lat >= 72 AND lat < 84 AND lon >= 9 AND lon < 21 THEN 33
            WHEN lat >= 72 AND lat < 84 AND lon >= 21 AND lon < 33 THEN 35
            WHEN lat >= 72 AND lat < 84 AND lon >= 33 AND lon < 42 THEN 37
            ELSE CAST(trunc((lon + 180) / 6) AS INTEGER) + 1 END AS INTEGER) AS zone,
            CAST(trunc((lon + 180) / 6) AS INTEGER) + 1 AS plain_zone
        FROM p)
    SELECT c_custkey, CASE WHEN lat >= 0 THEN 32600 ELSE 32700 END + zone AS epsg, plain_zone FROM z
""")
def utm_epsg(spark, d):
    lon, lat = F.col("lon"), F.col("lat")
    return _lonlat(spark, d).select("c_custkey", scalar.utm_epsg(lon, lat).alias("epsg"), scalar.utm_zone(lon).alias("plain_zone"))


@query("""
    SELECT DISTINCT string_split(p_name, ' ')[2] AS tile FROM part WHERE len(string_split(p_name, ' ')) >= 2
""")
def tile_codes(spark, d):
    code = scalar.tile_code(F.replace("p_name", F.lit(" "), F.lit("_")))
    return table(spark, d, "part").select(code.alias("tile")).filter("tile is not null").distinct()


@query("""
    SELECT c_custkey, CASE
        WHEN count(DISTINCT o_orderpriority) = 5 AND count(DISTINCT o_orderstatus) >= 2 THEN 'ALL_DONE'
        WHEN count(DISTINCT o_orderpriority) = 5 THEN 'S2_DONE_ONLY' ELSE 'NOT_DONE' END AS status
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey
""")
def tile_status(spark, d):
    orders = table(spark, d, "orders")
    optical = F.element_at(F.array(*map(F.lit, scenes.OPTICAL_FILES)), F.substring("o_orderpriority", 1, 1).cast("int"))
    files = orders.select(F.col("o_custkey").alias("c_custkey"), optical.alias("file"))
    several = orders.groupBy("o_custkey").agg(F.count_distinct("o_orderstatus").alias("n")).filter("n >= 2")
    radar = several.select(F.col("o_custkey").alias("c_custkey"), F.explode(F.array(*map(F.lit, scenes.RADAR_FILES))).alias("file"))
    every = table(spark, d, "customer").select("c_custkey", F.lit(None).cast("string").alias("file"))
    return scenes.tile_status(files.unionByName(radar).unionByName(every), by="c_custkey")


@query("""
    SELECT c_custkey, coalesce(min(o_orderkey), -1) AS reference FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey
""")
def reference_lookup(spark, d):
    references = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("reference"))
    return scenes.reference_lookup(table(spark, d, "customer").select("c_custkey"), references, "c_custkey", "reference", F.lit(-1))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def pending_tiles(spark, d):
    done = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return scenes.pending(table(spark, d, "customer").select("c_custkey"), done, "c_custkey")


@query("""
    WITH r AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS place, count(*) OVER () AS n FROM customer),
         s AS (SELECT c_custkey, CASE WHEN place < floor(n * 1 / 3) THEN 'CPU' ELSE 'GPU' END AS device FROM r)
    SELECT c_custkey, device, CAST(CASE WHEN device = 'GPU' THEN ntile(3) OVER (PARTITION BY device ORDER BY c_custkey) ELSE 0 END AS INTEGER) AS part FROM s
""")
def work_split(spark, d):
    return scenes.split_work(table(spark, d, "customer").select("c_custkey"), "c_custkey", 1, 2, gpus=3)


@query("""
    WITH a AS (SELECT DISTINCT CAST(dayofyear(ts) AS INTEGER) AS day, user_id % 50 AS tile FROM events WHERE event_type = 'click'),
         b AS (SELECT DISTINCT CAST(dayofyear(ts) AS INTEGER) AS day, user_id % 50 AS tile FROM events WHERE event_type = 'purchase' AND value > 20)
    SELECT tile, day, 'missing' AS kind FROM a WHERE (tile, day) NOT IN (SELECT (tile, day) FROM b)
    UNION ALL SELECT tile, day, 'extra' FROM b WHERE (tile, day) NOT IN (SELECT (tile, day) FROM a)
""")
def doy_reconcile(spark, d):
    """Days of a tile that a stack lacks, or has beyond the others."""
    events = table(spark, d, "events").select("event_type", "value", F.dayofyear("ts").alias("day"), (F.col("user_id") % 50).alias("tile"))
    before, after = events.filter("event_type = 'click'"), events.filter("event_type = 'purchase' and value > 20")
    return scenes.reconcile(before.select("tile", "day"), after.select("tile", "day"))


@query("""
    WITH w AS (SELECT DISTINCT c_custkey AS k FROM customer), s AS (
        SELECT k, CASE WHEN bool_or(o_orderstatus = 'F') THEN 'done' WHEN bool_or(o_orderstatus = 'O') THEN 'failed' ELSE 'missing' END AS status FROM w LEFT JOIN orders ON o_custkey = k GROUP BY k),
    c AS (SELECT count(*) AS total, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'missing') AS missing FROM s)
    SELECT *, done * 1.0::DOUBLE AS per_hour, CASE WHEN done > 0 THEN CAST(floor(missing * 3600.0::DOUBLE / done) AS BIGINT) END AS seconds,
           (SELECT string_agg(CAST(k AS VARCHAR), ',' ORDER BY k) FROM (SELECT k FROM w ORDER BY k LIMIT 3)) AS first FROM c
""")
def run_progress(spark, d):
    """Counts of done, failed and missing keys of a run of an hour, its rate, the seconds left, and the first keys."""
    wanted = table(spark, d, "customer").select(F.col("c_custkey").alias("patch_id"))
    orders = table(spark, d, "orders").select(F.col("o_custkey").alias("patch_id"), "o_orderstatus")
    failed = orders.filter("o_orderstatus = 'O'").select("patch_id").distinct().withColumn("error", F.lit("x"))
    states = lifecycle.status(wanted, orders.filter("o_orderstatus = 'F'"), failed)
    first = lifecycle.first_keys(wanted, "patch_id", 3).agg(F.array_join(F.array_sort(F.collect_list("patch_id")), ",").alias("first"))
    left = F.floor(F.try_divide(F.col("missing") * F.lit(3600.0), F.col("per_hour"))).alias("seconds")
    return lifecycle.progress(states, 3600.0).select("total", "done", "failed", "missing", "per_hour", left).join(first, F.lit(True))


@query("""
    SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean,
           arg_min(o_orderkey, {'p': o_totalprice, 'k': o_orderkey}) AS fastest, arg_max(o_orderkey, {'p': o_totalprice, 'k': -o_orderkey}) AS slowest
    FROM orders GROUP BY o_orderstatus
""")
def run_stats(spark, d):
    low, high = F.struct("o_totalprice", "o_orderkey"), F.struct(F.col("o_totalprice"), (-F.col("o_orderkey")).alias("k"))
    return table(spark, d, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"),
        F.min_by("o_orderkey", low).alias("fastest"), F.max_by("o_orderkey", high).alias("slowest"),
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def props_json(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("SELECT doc_id, n_chars FROM documents WHERE n_chars >= 2000")
def size_filter(spark, d):
    return table(spark, d, "documents").filter(F.col("n_chars") >= 2000).select("doc_id", "n_chars")


@query("""
    SELECT user_id FROM events WHERE event_type IN ('click', 'purchase') GROUP BY user_id HAVING count(DISTINCT event_type) = 2
""")
def required_bands(spark, d):
    held = table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("bands"))
    return held.filter(scenes.holds_all("bands", ["click", "purchase"])).select("user_id")


@query("""
    WITH w AS (SELECT unnest(['click', 'purchase', 'nothing']) AS band), u AS (SELECT DISTINCT user_id FROM events),
         h AS (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY ALL)
    SELECT u.user_id, w.band, coalesce(h.first, -1) AS first FROM u CROSS JOIN w LEFT JOIN h ON h.user_id = u.user_id AND h.event_type = w.band
""")
def asset_fan_out(spark, d):
    first = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first"))
    items = first.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "first"))).alias("assets"))
    wanted = items.withColumn("band", F.explode(F.array(F.lit("click"), F.lit("purchase"), F.lit("nothing"))))
    return wanted.select("user_id", "band", F.coalesce(F.try_element_at("assets", F.col("band")), F.lit(-1)).alias("first"))


@query("""
    SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN 'SRTM' END, CASE WHEN o_orderkey % 3 = 0 THEN 'ACE30' END, 'GETASSE30') AS dem,
           coalesce(CASE WHEN o_orderstatus = 'F' THEN upper('descending') END, 'ASCENDING') AS direction,
           CASE WHEN o_orderkey % 5 = 0 THEN 4326 ELSE 32600 + CAST(o_orderkey % 60 + 1 AS INTEGER) END AS epsg
    FROM orders
""")
def priority_fallback(spark, d):
    key = F.col("o_orderkey")
    wkt = F.when(key % 5 != 0, F.concat(F.lit('PROJCS["x",AUTHORITY["EPSG","'), (key % 60 + 32601).cast("string"), F.lit('"]]'))).otherwise(F.lit('LOCAL_CS["y"]'))
    return table(spark, d, "orders").select(
        "o_orderkey",
        scenes.priority_value(F.when(key % 2 == 0, "SRTM"), F.when(key % 3 == 0, "ACE30"), F.lit("GETASSE30")).alias("dem"),
        scalar.pass_name(F.when(F.col("o_orderstatus") == "F", "descending")).alias("direction"),
        scalar.epsg_of_wkt(wkt).alias("epsg"),
    )


@query("""
    SELECT c_custkey, regexp_replace(lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || 'VXG', '^0', '') AS tile,
           regexp_replace('map_' || CAST(c_custkey AS VARCHAR) || '.npy', '\\.npy$', '.tif') AS output
    FROM customer
""")
def key_normalise(spark, d):
    key = F.col("c_custkey")
    return table(spark, d, "customer").select(
        "c_custkey",
        scalar.strip_zero(F.concat(F.lpad((key % 100).cast("string"), 2, "0"), F.lit("VXG"))).alias("tile"),
        F.regexp_replace(F.concat(F.lit("map_"), key.cast("string"), F.lit(".npy")), r"\.npy$", ".tif").alias("output"),
    )


@query("""
    SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1 AS keep,
           o_orderdate < TIMESTAMP '1997-01-01' AS old
    FROM orders
""")
def retention_plan(spark, d):
    files = scenes.retention(table(spark, d, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"])
    return files.select("o_orderkey", "keep", (F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")).alias("old"))


@query("""
    WITH f AS (SELECT user_id, event_type, CASE WHEN value > 50 THEN 1 ELSE 2 END AS priority, event_id FROM events),
         b AS (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY priority) AS r FROM f)
    SELECT user_id, count(DISTINCT event_type) AS kinds, count(*) AS files FROM b WHERE r = 1 GROUP BY user_id HAVING count(DISTINCT event_type) >= 2
""")
def listing_complete(spark, d):
    rows = table(spark, d, "events").withColumn("priority", F.when(F.col("value") > 50, 1).otherwise(2))
    best = scenes.first_source(rows, "user_id", "priority")
    return best.groupBy("user_id").agg(F.count_distinct("event_type").alias("kinds"), F.count(F.lit(1)).alias("files")).filter("kinds >= 2")


@query("""
    SELECT o_orderkey, CASE
        WHEN s >= 3600 THEN CAST(s // 3600 AS VARCHAR) || 'h ' || CAST(s % 3600 // 60 AS VARCHAR) || 'm ' || CAST(s % 60 AS VARCHAR) || 's'
        WHEN s >= 60 THEN CAST(s // 60 AS VARCHAR) || 'm ' || CAST(s % 60 AS VARCHAR) || 's' ELSE CAST(s AS VARCHAR) || 's' END AS took
    FROM (SELECT o_orderkey, o_orderkey * 37 % 9001 AS s FROM orders)
""")
def duration_text(spark, d):
    return table(spark, d, "orders").select("o_orderkey", scalar.duration_text(F.col("o_orderkey") * 37 % 9001).alias("took"))
