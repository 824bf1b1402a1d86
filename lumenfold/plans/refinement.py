"""Refinement, filters and graph queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumenfold.operators import evaluation as E
from lumenfold.operators import refine as R
from lumenfold.operators import roads as Q

from .clustering import _mask
from .joins import _boxes, box_pairs
from .registry import query, table


@query("a14_circle_fit")
def a14(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_suppkey", "l_quantity", "l_tax").selectExpr("l_suppkey", "l_quantity AS x", "l_tax * 500 AS y")
    return R.fit_circles(rows, "l_suppkey", "x", "y").select("l_suppkey", *(F.round(c, 4).alias(c) for c in ("cx", "cy", "radius")))


@query("a17_terrain_guard")
def a17(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events", "user_id", "event_id", "value")
    return R.guarded_heights(rows, "user_id", "event_id", "value", 20.0)


@query("a29_distance_map")
def a29(spark: SparkSession, d: str) -> DataFrame:
    rows = _mask(spark, d).selectExpr("x DIV 30 AS k", "CAST(x AS BIGINT) AS x", "CAST(y AS BIGINT) AS y")
    return R.per_raster(rows, "k", "x", "y", "distance")


@query("g2_skeleton")
def g2(spark: SparkSession, d: str) -> DataFrame:
    rows = _mask(spark, d).selectExpr("x DIV 30 AS k", "CAST(x AS BIGINT) AS x", "CAST(y AS BIGINT) AS y")
    return R.per_raster(rows, "k", "x", "y", "thin")


@query("g6_road_edges")
def g6(spark: SparkSession, d: str) -> DataFrame:
    """Graph edges of each raster's skeleton, spurs below 2 pixels pruned."""
    return Q.road_edges(g2(spark, d).select("k", "x", "y"), "k", shortest=2.0)


@query(
    "a28_mean_iou",
    """WITH p AS (SELECT l_linenumber AS cls, l_returnflag = 'A' AS t, l_linestatus = 'F' AS p FROM lineitem) SELECT cls, round(sum((t AND p)::INT) / greatest(sum((t OR p)::INT), 1)::DOUBLE, 6) AS iou FROM p GROUP BY 1""",
)
def a28(spark: SparkSession, d: str) -> DataFrame:
    t, p = F.col("l_returnflag") == "A", F.col("l_linestatus") == "F"
    rows = table(spark, d, "lineitem", "l_linenumber", "l_returnflag", "l_linestatus").groupBy(F.col("l_linenumber").alias("cls"))
    return rows.agg(F.round(F.sum((t & p).cast("int")) / F.greatest(F.sum((t | p).cast("int")), F.lit(1)), 6).alias("iou"))


@query("e2_exhaustive_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def e2(spark: SparkSession, d: str) -> DataFrame:
    excluded = table(spark, d, "customer", "c_custkey", "c_acctbal").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderstatus").where("o_orderstatus = 'F'").join(excluded, "o_custkey", "left_anti").select("o_orderkey")


@query("e4_best_annotator", "SELECT l_orderkey, min_by(l_linenumber, (-l_extendedprice, l_linenumber)) AS best FROM lineitem GROUP BY 1")
def e4(spark: SparkSession, d: str) -> DataFrame:
    return R.best_annotator(table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice"), "l_orderkey", "l_linenumber", "l_extendedprice")


@query("e15_unnest_tracks", "SELECT vec_id, i - 1 AS frame, row_number() OVER (ORDER BY vec_id, i) AS ann FROM (SELECT vec_id, unnest(range(1, 4)) AS i FROM embeddings)")
def e15(spark: SparkSession, d: str) -> DataFrame:
    """One annotation a frame of each track, numbered in order."""
    rows = table(spark, d, "embeddings", "vec_id").select("vec_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("frame"))
    return rows.withColumn("ann", F.row_number().over(Window.orderBy("vec_id", "frame")).cast("long"))


@query("e22_category_merge", "SELECT CASE WHEN event_type IN ('click', 'view') THEN 'browse' ELSE event_type END AS category, list(event_id ORDER BY event_id)[1:3] AS first_ids, count(*) AS n FROM events GROUP BY 1")
def e22(spark: SparkSession, d: str) -> DataFrame:
    """Categories under a merge map, with the first ids of each."""
    merged = F.coalesce(F.try_element_at(F.create_map(F.lit("click"), F.lit("browse"), F.lit("view"), F.lit("browse")), F.col("event_type")), F.col("event_type"))
    rows = table(spark, d, "events", "event_id", "event_type").withColumn("category", merged)
    top = rows.withColumn("_r", F.row_number().over(Window.partitionBy("category").orderBy("event_id"))).where("_r <= 3")
    firsts = top.groupBy("category").agg(F.array_sort(F.collect_list("event_id")).alias("first_ids"))
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n")).join(firsts, "category")


@query("e24_metric_boxes", "SELECT l_orderkey, l_linenumber, l_quantity AS x, l_discount * 100 AS y, 10.0::DOUBLE AS w, 6.0::DOUBLE AS h FROM lineitem")
def e24(spark: SparkSession, d: str) -> DataFrame:
    return _boxes(spark, d).selectExpr("img AS l_orderkey", "id AS l_linenumber", "x1 AS x", "y1 AS y", "round(x2 - x1, 6) AS w", "round(y2 - y1, 6) AS h")


@query("e25_subset_report", "SELECT source, count(*) AS n, round(avg(n_chars), 3) AS score FROM documents GROUP BY 1")
def e25(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "source", "n_chars").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("n_chars"), 3).alias("score"))


@query("w5_fixpoint_merge")
def w5(spark: SparkSession, d: str) -> DataFrame:
    boxes = _boxes(spark, d).withColumn("score", F.col("x1") * 0.01)
    return R.merge_boxes_to_fixpoint(boxes, "img", ["x1", "y1", "x2", "y2"], "score", 0.3)


@query("j8_rotated_iou")
def j8(spark: SparkSession, d: str) -> DataFrame:
    rows = box_pairs(_boxes(spark, d)).selectExpr("img", "id", "id_b", "x1 AS a0", "y1 AS a1", "10D AS a2", "6D AS a3", "id * 15D AS a4", "x1_b AS b0", "y1_b AS b1", "10D AS b2", "6D AS b3", "id_b * 15D AS b4")
    found = R.rotated_iou(rows, [f"a{k}" for k in range(5)], [f"b{k}" for k in range(5)], ["img", "id", "id_b"])
    return found.where("iou > 0").withColumn("iou", F.round("iou", 6))


@query("j5_box_overlap", "SELECT a.l_orderkey AS img, a.l_linenumber AS id, b.l_linenumber AS id_b FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber WHERE abs(a.l_quantity - b.l_quantity) <= 10 AND abs(a.l_discount * 100 - b.l_discount * 100) <= 6")
def j5(spark: SparkSession, d: str) -> DataFrame:
    """Boxes that overlap or touch."""
    return box_pairs(_boxes(spark, d)).where("abs(x1 - x1_b) <= 10 AND abs(y1 - y1_b) <= 6").select("img", "id", "id_b")


@query("j18_association")
def j18(spark: SparkSession, d: str) -> DataFrame:
    """Matched detections and tracks, kept from an overlap of 0.1 on."""
    pairs = box_pairs(_boxes(spark, d)).where("id % 2 = 1 AND id_b % 2 = 0").groupBy("img", F.col("id").alias("det"), F.col("id_b").alias("trk")).agg(F.max("iou").alias("iou"))
    return E.hungarian(pairs, ["img"], "det", "trk", "iou").where("iou >= 0.1")


@query("f5_lane_direction", "SELECT o_orderkey, round(dx / sqrt(dx * dx + dy * dy), 6) AS ux, round(dy / sqrt(dx * dx + dy * dy), 6) AS uy FROM (SELECT o_orderkey, (o_orderkey % 17 - 8.5) AS dx, (o_custkey % 13 - 6.5) AS dy FROM orders)")
def f5(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_orderkey", "o_custkey").selectExpr("o_orderkey", "o_orderkey % 17 - 8.5D AS dx", "o_custkey % 13 - 6.5D AS dy")
    return rows.selectExpr("o_orderkey", "round(dx / sqrt(dx * dx + dy * dy), 6) AS ux", "round(dy / sqrt(dx * dx + dy * dy), 6) AS uy")


@query("f22_count_equality", "SELECT doc_id, quality = toxic AS equal FROM labels")
def f22(spark: SparkSession, d: str) -> DataFrame:
    """Whole numbers compared as such whatever stands around them."""
    number = lambda c: F.regexp_extract(c, r"-?\d+", 0).try_cast("long")
    rows = table(spark, d, "labels", "doc_id", "quality", "toxic").select("doc_id", F.concat(F.lit("there are "), "quality").alias("a"), F.concat("toxic", F.lit(" items")).alias("b"))
    return rows.select("doc_id", (number("a") == number("b")).alias("equal"))


@query("f28_answer_equality", "SELECT l_orderkey, l_linenumber, abs(l_discount - l_tax) <= 1e-6 AS equal FROM lineitem")
def f28(spark: SparkSession, d: str) -> DataFrame:
    a, b = (F.lower(F.trim(F.col(c).cast("string"))) for c in ("l_discount", "l_tax"))
    same = (a == b) | F.coalesce(F.abs(a.try_cast("double") - b.try_cast("double")) <= 1e-6, F.lit(False))
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax").select("l_orderkey", "l_linenumber", same.alias("equal"))


@query("d9_validity_filters", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 0 AND l_returnflag <> 'R' AND l_linestatus = 'O'")
def d9(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus").where("l_quantity > 0 AND l_returnflag != 'R' AND l_linestatus = 'O'").select("l_orderkey", "l_linenumber")


@query("s17_resume", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def s17(spark: SparkSession, d: str) -> DataFrame:
    from lumenfold.sources.text import not_done

    return not_done(table(spark, d, "documents", "doc_id"), table(spark, d, "labels", "doc_id"), "doc_id")


@query("s24_instance_boxes", "SELECT n_regionkey, 20::BIGINT AS lines FROM nation GROUP BY 1")
def s24(spark: SparkSession, d: str) -> DataFrame:
    from lumenfold.sources.text import instance_boxes

    points = table(spark, d, "nation", "n_nationkey", "n_regionkey").selectExpr("n_regionkey", "n_nationkey * 1.0D AS x", "n_nationkey * 2.0D AS y", "0.0D AS z")
    return instance_boxes(points, "n_regionkey").select("n_regionkey", F.size(F.split("obj", "\n")).cast("long").alias("lines"))


@query("s23_pack_rgb", "SELECT n_nationkey, (n_nationkey << 16) | (n_regionkey << 8) | 7 AS rgb FROM nation")
def s23(spark: SparkSession, d: str) -> DataFrame:
    from lumenfold.sources.text import pack_rgb

    rows = table(spark, d, "nation", "n_nationkey", "n_regionkey").withColumn("b", F.lit(7))
    return rows.select("n_nationkey", pack_rgb("n_nationkey", "n_regionkey", "b").alias("rgb"))


@query("g9_line_split", "SELECT o_orderkey, unnest(range(0, (o_custkey % 300)::BIGINT + 1, 40)) AS start FROM orders")
def g9(spark: SparkSession, d: str) -> DataFrame:
    """Starts of pieces of 50 that overlap by 10 along lines."""
    rows = table(spark, d, "orders", "o_orderkey", "o_custkey")
    return rows.select("o_orderkey", F.explode(F.sequence(F.lit(0).cast("long"), F.col("o_custkey") % 300, F.lit(40).cast("long"))).alias("start"))


@query("g10_slice_polygons", "SELECT s_suppkey, 'POLYGON((' || (s_suppkey - 2) || ' ' || (s_nationkey - 2) || ', ' || (s_suppkey + 2) || ' ' || (s_nationkey - 2) || ', ' || (s_suppkey + 2) || ' ' || (s_nationkey + 2) || ', ' || (s_suppkey - 2) || ' ' || (s_nationkey + 2) || ', ' || (s_suppkey - 2) || ' ' || (s_nationkey - 2) || '))' AS wkt FROM supplier")
def g10(spark: SparkSession, d: str) -> DataFrame:
    """Squares around junctions as WKT."""
    corner = lambda i, j: F.concat_ws(" ", F.col("s_suppkey") + i, F.col("s_nationkey") + j)
    ring = F.concat_ws(", ", corner(-2, -2), corner(2, -2), corner(2, 2), corner(-2, 2), corner(-2, -2))
    return table(spark, d, "supplier", "s_suppkey", "s_nationkey").select("s_suppkey", F.concat(F.lit("POLYGON(("), ring, F.lit("))")).alias("wkt"))
