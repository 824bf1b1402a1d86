"""Projection, z-buffer and raster queries; order and line numbers stand for coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators import geometry as G

from .registry import query, table

#: Two camera poses, inverted, row by row.
CAMERAS = [("front", [1.0, 0.0, 0.0, -20.0, 0.0, 0.0, -1.0, 5.0, 0.0, 1.0, 0.0, 1.0]), ("left", [0.0, 1.0, 0.0, 0.5, 0.0, 0.0, -1.0, 4.0, -1.0, 0.0, 0.0, 60.0])]
_W, _H, _FOV = 64, 64, 90.0
_PTS = "SELECT l_orderkey * 10 + l_linenumber AS pid, l_quantity AS x, l_discount * 100 AS y, l_tax * 100 AS z FROM lineitem"
_CAM = """SELECT pid, 'front' AS image, x - 20.0 AS xc, -z + 5.0 AS yc, y + 1.0 AS zc FROM p UNION ALL SELECT pid, 'left', y + 0.5, -z + 4.0, -x + 60.0 FROM p"""
_PIX = f"""WITH p AS ({_PTS}), c AS (SELECT * FROM ({_CAM}) WHERE zc > 0), f AS (
  SELECT pid, image, round_even(xc * (64 / 2 / tan(radians(90.0 / 2))) / zc + 32, 0)::INT AS u, round_even(yc * (64 / 2 / tan(radians(90.0 / 2))) / zc + 32, 0)::INT AS v, xc * xc + yc * yc + zc * zc AS d2 FROM c),
pix AS (SELECT *, v * 64 + u AS pix FROM f WHERE u >= 0 AND u < 64 AND v >= 0 AND v < 64)"""


def _points(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return rows.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pid"), F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"), (F.col("l_tax") * 100).alias("z"))


def _pixels(spark: SparkSession, d: str) -> DataFrame:
    cameras = spark.createDataFrame(CAMERAS, "image string, inv array<double>")
    return G.to_pixels(G.project(_points(spark, d), cameras, ["pid"]), _W, _H, _FOV)


@query("p1_world_to_camera", f"WITH p AS ({_PTS}) SELECT pid, image, round(xc, 6) AS xc, round(yc, 6) AS yc, round(zc, 6) AS zc FROM ({_CAM}) WHERE zc > 0")
def p1(spark: SparkSession, d: str) -> DataFrame:
    cameras = spark.createDataFrame(CAMERAS, "image string, inv array<double>")
    return G.project(_points(spark, d), cameras, ["pid"]).select("pid", "image", *(F.round(c, 6).alias(c) for c in ("xc", "yc", "zc")))


@query("p3_pixel_projection", _PIX + " SELECT image, pix, count(*) AS n FROM pix GROUP BY 1, 2")
def p3(spark: SparkSession, d: str) -> DataFrame:
    return _pixels(spark, d).groupBy("image", "pix").agg(F.count(F.lit(1)).alias("n"))


@query("p4_z_buffer", _PIX + " SELECT image, pix, round(d2, 4) AS d2, pid FROM (SELECT *, row_number() OVER (PARTITION BY image, pix ORDER BY round(d2, 6), pid) AS k FROM pix) WHERE k = 1")
def p4(spark: SparkSession, d: str) -> DataFrame:
    rows = _pixels(spark, d).withColumn("d2", F.round("d2", 6))
    return G.z_buffer(rows, ["image", "pix"], "d2", "pid").withColumn("d2", F.round("d2", 4))


@query("p5_depth_band", _PIX + " SELECT image, pix, count(*) AS n FROM (SELECT *, min(round(d2, 6)) OVER (PARTITION BY image, pix) AS m FROM pix) WHERE round(d2, 6) - m < 4.0 GROUP BY 1, 2")
def p5(spark: SparkSession, d: str) -> DataFrame:
    rows = _pixels(spark, d).withColumn("d2", F.round("d2", 6))
    return G.depth_band(rows, ["image", "pix"], "d2", 4.0).groupBy("image", "pix").agg(F.count(F.lit(1)).alias("n"))


@query("p6_continuous_projection", f"""WITH p AS ({_PTS}), c AS (SELECT * FROM ({_CAM}) WHERE zc > 0), f AS (SELECT image, xc * (64 / 2 / tan(radians(90.0 / 2))) / zc + 32 AS u, yc * (64 / 2 / tan(radians(90.0 / 2))) / zc + 32 AS v FROM c)
SELECT image, count(*) AS n, round(avg(u), 4) AS mean_u, round(avg(v), 4) AS mean_v FROM f WHERE u BETWEEN -2 AND 66 AND v BETWEEN -2 AND 66 GROUP BY 1""")
def p6(spark: SparkSession, d: str) -> DataFrame:
    cameras = spark.createDataFrame(CAMERAS, "image string, inv array<double>")
    rows = G.to_pixels(G.project(_points(spark, d), cameras, ["pid"]), _W, _H, _FOV, margin=2.0)
    return rows.groupBy("image").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("u"), 4).alias("mean_u"), F.round(F.avg("v"), 4).alias("mean_v"))


@query(
    "p10_soft_splat",
    """WITH p AS (SELECT o_orderkey AS pid, o_custkey % 40 + 0.25 AS u, o_orderkey % 40 + 0.5 AS v, 1 + o_orderkey % 7 AS depth, o_totalprice AS val FROM orders),
    r AS (SELECT *, least(greatest(4.0 / depth, 0.75), 2.0) AS r FROM p),
    c AS (SELECT *, round_even(u, 0)::INT + dx AS px, round_even(v, 0)::INT + dy AS py FROM r, (SELECT unnest(range(-2, 3)) AS dx), (SELECT unnest(range(-2, 3)) AS dy)),
    k AS (SELECT *, (px - u) * (px - u) + (py - v) * (py - v) AS q FROM c WHERE px >= 0 AND px < 40 AND py >= 0 AND py < 40),
    f AS (SELECT *, min(depth) OVER (PARTITION BY px, py) AS front FROM k WHERE q <= r * r)
    SELECT px, py, round(sum(exp(-q / (2 * (r / 2) * (r / 2))) * val) / sum(exp(-q / (2 * (r / 2) * (r / 2)))), 2) AS val, min(front)::BIGINT AS front FROM f WHERE depth - front <= 1 GROUP BY 1, 2""",
)
def p10(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice").select(
        F.lit(0).alias("image"), (F.col("o_custkey") % 40 + 0.25).alias("u"), (F.col("o_orderkey") % 40 + 0.5).alias("v"), (1 + F.col("o_orderkey") % 7).alias("depth"), F.col("o_totalprice").alias("val")
    )
    found = G.splat(rows, ["image"], "u", "v", G.splat_radius(F.col("depth"), 4.0, 0.75, 2.0), "val", 40, 40, 2, 1.0, "depth")
    return found.select("px", "py", F.round("val", 2).alias("val"), "front")


@query(
    "p11_hole_patch",
    """WITH p AS (SELECT o_custkey % 30 AS x, o_orderkey % 30 AS y, min(o_totalprice) AS d FROM orders GROUP BY 1, 2)
    SELECT x + dx AS x, y + dy AS y, min(d) AS d FROM p, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy) GROUP BY 1, 2""",
)
def p11(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    rows = rows.groupBy((F.col("o_custkey") % 30).alias("x"), (F.col("o_orderkey") % 30).alias("y")).agg(F.min("o_totalprice").alias("d"))
    return G.dilate_min(rows, [], "x", "y", "d", 1)


@query(
    "p12_ortho_nearest",
    """WITH q AS (SELECT l_quantity::INT AS c, floor(l_discount * 100)::INT AS r, l_extendedprice AS depth, l_orderkey * 10 + l_linenumber AS pid FROM lineitem)
    SELECT c, r, depth, pid FROM (SELECT *, row_number() OVER (PARTITION BY c, r ORDER BY depth, pid) AS k FROM q) WHERE k = 1""",
)
def p12(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_quantity", "l_discount", "l_extendedprice", "l_orderkey", "l_linenumber").select(
        F.col("l_quantity").cast("int").alias("c"), F.floor(F.col("l_discount") * 100).cast("int").alias("r"), F.col("l_extendedprice").alias("depth"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pid")
    )
    return G.z_buffer(rows, ["c", "r"], "depth", "pid")


@query(
    "p13_bev_top",
    """WITH q AS (SELECT floor(l_quantity / 5)::BIGINT AS cx, floor(l_discount / 0.02)::BIGINT AS cy, l_extendedprice AS z, l_orderkey * 10 + l_linenumber AS pid, l_suppkey AS colour FROM lineitem)
    SELECT cx, cy, z, pid, colour FROM (SELECT *, row_number() OVER (PARTITION BY cx, cy ORDER BY z DESC, pid) AS k FROM q) WHERE k = 1""",
)
def p13(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_quantity", "l_discount", "l_extendedprice", "l_orderkey", "l_linenumber", "l_suppkey").select(
        G.cell("l_quantity", 0, 5).alias("cx"), G.cell("l_discount", 0, 0.02).alias("cy"), F.col("l_extendedprice").alias("z"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("pid"), F.col("l_suppkey").alias("colour")
    )
    return G.top_per_cell(rows, ["cx", "cy"], "z", "pid", ["colour"])


@query(
    "p15_range_split",
    """SELECT r.name, count(*) AS n FROM lineitem JOIN (VALUES ('a', 1.0, 20.0, 0.0, 0.05), ('b', 20.0, 40.0, 0.03, 0.1), ('c', 45.0, 50.0, 0.0, 0.1)) AS r(name, x1, x2, y1, y2)
    ON l_quantity BETWEEN x1 AND x2 AND l_discount BETWEEN y1 AND y2 GROUP BY 1""",
)
def p15(spark: SparkSession, d: str) -> DataFrame:
    """A point goes to every box that holds it, edges included; boxes are a short parameter list."""
    boxes = [("a", 1.0, 20.0, 0.0, 0.05), ("b", 20.0, 40.0, 0.03, 0.1), ("c", 45.0, 50.0, 0.0, 0.1)]
    inside = [F.when(F.col("l_quantity").between(x1, x2) & F.col("l_discount").between(y1, y2), F.lit(n)) for n, x1, x2, y1, y2 in boxes]
    rows = table(spark, d, "lineitem", "l_quantity", "l_discount").select(F.explode(F.array_compact(F.array(*inside))).alias("name"))
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


_BOX = "SELECT l_orderkey * 10 + l_linenumber AS id, l_quantity * 25 - 50 AS x1, l_discount * 9000 AS y1, 900 - l_quantity * 20 AS x2, l_tax * 12000 + 40 AS y2 FROM lineitem"


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax").selectExpr(
        "l_orderkey * 10 + l_linenumber AS id", "l_quantity * 25 - 50 AS x1", "l_discount * 9000 AS y1", "900 - l_quantity * 20 AS x2", "l_tax * 12000 + 40 AS y2"
    )


@query(
    "p16_normalise_box",
    f"""WITH b AS ({_BOX}), c AS (SELECT id, least(greatest(x1, 0), 1000) AS x1, least(greatest(y1, 0), 1000) AS y1, least(greatest(x2, 0), 1000) AS x2, least(greatest(y2, 0), 1000) AS y2 FROM b)
    SELECT id, round(least(x1, x2), 4) AS x1, round(least(y1, y2), 4) AS y1, round(greatest(x1, x2), 4) AS x2, round(greatest(y1, y2), 4) AS y2 FROM c""",
)
def p16(spark: SparkSession, d: str) -> DataFrame:
    names = ["x1", "y1", "x2", "y2"]
    return _boxes(spark, d).select("id", *(F.round(c, 4).alias(n) for n, c in zip(names, G.normalise_box(names), strict=True)))


@query("p17_box_formats", f"WITH b AS ({_BOX}) SELECT id, round((x1 + x2) / 2, 4) AS cx, round((y1 + y2) / 2, 4) AS cy, round(x2 - x1, 4) AS w, round(y2 - y1, 4) AS h FROM b")
def p17(spark: SparkSession, d: str) -> DataFrame:
    return _boxes(spark, d).selectExpr("id", "round((x1 + x2) / 2, 4) AS cx", "round((y1 + y2) / 2, 4) AS cy", "round(x2 - x1, 4) AS w", "round(y2 - y1, 4) AS h")


@query("p18_mask_to_box", "SELECT l_suppkey, min(l_linenumber) AS x1, min(l_quantity) AS y1, max(l_linenumber) AS x2, max(l_quantity) AS y2 FROM lineitem GROUP BY 1")
def p18(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_suppkey", "l_linenumber", "l_quantity").groupBy("l_suppkey").agg(
        F.min("l_linenumber").alias("x1"), F.min("l_quantity").alias("y1"), F.max("l_linenumber").alias("x2"), F.max("l_quantity").alias("y2")
    )


@query("p19_mask_to_world", "SELECT l_orderkey, l_linenumber, round(n_nationkey * 100 + l_quantity * 0.5, 4) AS x, round(n_regionkey * 100 - l_linenumber * 0.5, 4) AS y FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey")
def p19(spark: SparkSession, d: str) -> DataFrame:
    """Mask pixels of a tile in world coordinates, from the tile's left top corner."""
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    tiles = table(spark, d, "supplier", "s_suppkey", "s_nationkey").join(table(spark, d, "nation", "n_nationkey", "n_regionkey"), F.expr("s_nationkey = n_nationkey"))
    return rows.join(tiles, F.expr("l_suppkey = s_suppkey")).selectExpr("l_orderkey", "l_linenumber", "round(n_nationkey * 100 + l_quantity * 0.5, 4) AS x", "round(n_regionkey * 100 - l_linenumber * 0.5, 4) AS y")


@query("p20_black_ratio", "SELECT l_orderkey, round(avg((l_discount <= 0.05 AND l_tax <= 0.04)::INT), 6) AS ratio FROM lineitem GROUP BY 1 HAVING avg((l_discount <= 0.05 AND l_tax <= 0.04)::INT) <= 0.5")
def p20(spark: SparkSession, d: str) -> DataFrame:
    black = ((F.col("l_discount") <= 0.05) & (F.col("l_tax") <= 0.04)).cast("int")
    found = table(spark, d, "lineitem", "l_orderkey", "l_discount", "l_tax").groupBy("l_orderkey").agg(F.avg(black).alias("r"))
    return found.where("r <= 0.5").select("l_orderkey", F.round("r", 6).alias("ratio"))


@query(
    "p21_stations_on_path",
    """WITH s AS (SELECT user_id, event_id, value, coalesce(abs(value - lag(value) OVER w), 0) AS step FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    t AS (SELECT user_id, sum(step) AS total FROM s GROUP BY 1)
    SELECT user_id, floor(total / 50)::BIGINT + 1 AS stations FROM t""",
)
def p21(spark: SparkSession, d: str) -> DataFrame:
    """Stations every 50 units along each path; what a segment leaves carries over to the next."""
    rows = table(spark, d, "events", "user_id", "event_id", "ts", "value").withColumns({"_o": F.struct("ts", "event_id"), "_y": F.lit(0.0)})
    total = G.along(rows, "user_id", "_o", "value", "_y").groupBy("user_id").agg(F.max("length").alias("total"))
    return total.select("user_id", F.size(F.sequence(F.lit(0), F.floor(F.col("total") / 50))).cast("long").alias("stations"))


@query("p22_stretch", "SELECT event_id, round_even((least(greatest(value, 10.0), 60.0) - 10.0) / (60.0 - 10.0) * 255, 0) AS grey FROM events")
def p22(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events", "event_id", "value").select("event_id", G.stretch("value", 10.0, 60.0).alias("grey"))


@query("p23_centre", "SELECT c_custkey, round(c_acctbal - (SELECT (min(c_acctbal) + max(c_acctbal)) / 2 FROM customer), 4) AS x FROM customer")
def p23(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer", "c_custkey", "c_acctbal")
    middle = rows.agg(((F.min("c_acctbal") + F.max("c_acctbal")) / 2).alias("_m"))
    return rows.crossJoin(F.broadcast(middle)).select("c_custkey", F.round(F.col("c_acctbal") - F.col("_m"), 4).alias("x"))  # one row


@query("p25_box_area", f"WITH b AS ({_BOX}) SELECT id, round((x2 - x1) * (y2 - y1), 2) AS area, (x1 >= 0 AND y1 >= 0 AND x2 <= 1000 AND y2 <= 1000) AS inside FROM b WHERE x2 > x1 AND y2 > y1")
def p25(spark: SparkSession, d: str) -> DataFrame:
    return _boxes(spark, d).where("x2 > x1 AND y2 > y1").selectExpr("id", "round((x2 - x1) * (y2 - y1), 2) AS area", "(x1 >= 0 AND y1 >= 0 AND x2 <= 1000 AND y2 <= 1000) AS inside")


@query(
    "p26_resize_plan",
    """WITH s AS (SELECT o_orderkey, (o_orderkey % 1500 + 20)::DOUBLE AS h, (o_custkey % 1500 + 20)::DOUBLE AS w FROM orders), r AS (SELECT *, round_even(h / 28, 0) * 28 AS a, round_even(w / 28, 0) * 28 AS b FROM s)
    SELECT o_orderkey, (CASE WHEN a * b > 1003520 THEN greatest(28, floor(h / sqrt(h * w / 1003520) / 28) * 28) WHEN a * b < 3136 THEN ceil(h * sqrt(3136 / (h * w)) / 28) * 28 ELSE greatest(28, a) END)::BIGINT AS nh,
    (CASE WHEN a * b > 1003520 THEN greatest(28, floor(w / sqrt(h * w / 1003520) / 28) * 28) WHEN a * b < 3136 THEN ceil(w * sqrt(3136 / (h * w)) / 28) * 28 ELSE greatest(28, b) END)::BIGINT AS nw FROM r""",
)
def p26(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_orderkey", "o_custkey").selectExpr("o_orderkey", "CAST(o_orderkey % 1500 + 20 AS DOUBLE) AS h", "CAST(o_custkey % 1500 + 20 AS DOUBLE) AS w")
    nh, nw = G.resized(F.col("h"), F.col("w"), 28, 3136, 1003520)
    return rows.select("o_orderkey", nh.alias("nh"), nw.alias("nw"))


@query(
    "p27_frame_sampling",
    """WITH c AS (SELECT conv_id, count(*) * 7 AS total FROM conversations GROUP BY 1) SELECT conv_id, [round_even(i * (total - 1) / 3.0, 0)::BIGINT FOR i IN [0, 1, 2, 3]] AS frames FROM c""",
)
def p27(spark: SparkSession, d: str) -> DataFrame:
    """Four frames evenly over the clip."""
    rows = table(spark, d, "conversations", "conv_id").groupBy("conv_id").agg((F.count(F.lit(1)) * 7).alias("total"))
    return rows.select("conv_id", F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.rint(i * (F.col("total") - 1) / 3.0).cast("long")).alias("frames"))


@query("u5_stitch", "SELECT x, y, v FROM (SELECT l_linenumber AS x, (l_partkey % 50) AS y, (l_suppkey % 3) AS v, row_number() OVER (PARTITION BY l_linenumber, l_partkey % 50 ORDER BY l_orderkey DESC, (l_suppkey % 3) DESC) AS k FROM lineitem WHERE l_suppkey % 3 <> 0) WHERE k = 1")
def u5(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_linenumber", "l_partkey", "l_suppkey", "l_orderkey").selectExpr("l_linenumber AS x", "l_partkey % 50 AS y", "l_suppkey % 3 AS v", "l_orderkey AS tile")
    return G.paste_later(rows, ["x", "y"], "v", "tile")


@query(
    "u6_tile_split",
    """WITH s AS (SELECT o_orderkey, (o_orderkey % 900 + 50)::BIGINT AS full_size FROM orders), t AS (SELECT o_orderkey, unnest(list_distinct(list_append(range(0, greatest(full_size - 256, 0) + 1, 192), greatest(full_size - 256, 0)))) AS start FROM s)
    SELECT o_orderkey, start FROM t""",
)
def u6(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_orderkey").withColumn("full", F.col("o_orderkey") % 900 + 50)
    return rows.select("o_orderkey", F.explode(G.tile_starts(F.col("full"), 256, 192)).alias("start"))


@query("a26_union_mask", "SELECT DISTINCT l_suppkey AS prompt, l_partkey AS pix FROM lineitem")
def a26(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("prompt"), F.col("l_partkey").alias("pix")).distinct()


@query("a27_semantic_mask", "SELECT DISTINCT l_partkey AS pix, l_linenumber AS cls FROM lineitem")
def a27(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("pix"), F.col("l_linenumber").alias("cls")).distinct()
