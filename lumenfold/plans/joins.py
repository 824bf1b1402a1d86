"""Join queries: back-projection, overlaps, neighbours, intervals and pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators import geometry as G
from lumenfold.operators import spatial as S

from .registry import query, table


@query(
    "j1_back_projection",
    """WITH m AS (SELECT DISTINCT l_suppkey AS mask, l_partkey AS pix FROM lineitem WHERE l_discount > 0.05),
    p AS (SELECT l_partkey AS pix, l_orderkey AS pid, l_quantity - 5 AS depth FROM lineitem WHERE l_quantity > 5),
    f AS (SELECT mask, pid, depth, min(depth) OVER (PARTITION BY mask, pix) AS front FROM m JOIN p USING (pix))
    SELECT mask, count(DISTINCT pid) AS n_points FROM f WHERE depth <= front + 10 GROUP BY 1""",
)
def j1(spark: SparkSession, d: str) -> DataFrame:
    """Points behind a mask's pixels, up to a threshold beyond the front depth of each masked pixel."""
    rows = table(spark, d, "lineitem", "l_suppkey", "l_partkey", "l_orderkey", "l_quantity", "l_discount")
    masks = rows.where("l_discount > 0.05").select(F.col("l_suppkey").alias("mask"), F.col("l_partkey").alias("pix")).distinct()
    points = rows.where("l_quantity > 5").select(F.col("l_partkey").alias("pix"), F.col("l_orderkey").alias("pid"), (F.col("l_quantity") - 5).alias("depth"))
    hit = masks.join(points, "pix")
    kept = G.depth_band(hit, ["mask", "pix"], "depth", 10 + 1e-9)
    return kept.groupBy("mask").agg(F.countDistinct("pid").alias("n_points"))


@query(
    "j2_scene_candidates",
    """SELECT c.c_nationkey, count(o.o_orderkey) AS n_points, sum((o.o_orderkey IS NULL)::INT)::BIGINT AS missing, round(min(o.o_totalprice), 2) AS lo, round(max(o.o_totalprice), 2) AS hi
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY 1 HAVING count(o.o_orderkey) >= 10""",
)
def j2(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "customer", "c_custkey", "c_nationkey").join(table(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice"), F.expr("c_custkey = o_custkey"), "left")
    found = both.groupBy("c_nationkey").agg(
        F.count("o_orderkey").alias("n_points"), F.sum(F.col("o_orderkey").isNull().cast("int")).alias("missing"), F.round(F.min("o_totalprice"), 2).alias("lo"), F.round(F.max("o_totalprice"), 2).alias("hi")
    )
    return found.where("n_points >= 10")


@query(
    "j3_stem_extrinsic",
    """WITH s AS (SELECT o_orderkey, 'station_' || (o_custkey % 25) || '_cam_' || lower(substr(o_orderpriority, 3, 3)) AS stem FROM orders)
    SELECT o_orderkey, n_name FROM s JOIN nation ON regexp_extract(stem, 'station_(\\d+)_cam_(\\w+)', 1)::INT = n_nationkey AND regexp_extract(stem, 'station_(\\d+)_cam_(\\w+)', 2) <> ''""",
)
def j3(spark: SparkSession, d: str) -> DataFrame:
    stems = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority").select(
        "o_orderkey", F.concat(F.lit("station_"), F.col("o_custkey") % 25, F.lit("_cam_"), F.lower(F.substring("o_orderpriority", 3, 3))).alias("stem")
    )
    named = stems.select("o_orderkey", *(F.regexp_extract("stem", r"station_(\d+)_cam_(\w+)", k).alias(f"_{k}") for k in (1, 2))).where("_2 != ''")
    return named.join(table(spark, d, "nation", "n_nationkey", "n_name"), F.expr("CAST(_1 AS INT) = n_nationkey")).select("o_orderkey", "n_name")


_OVERLAP = """WITH m AS (SELECT DISTINCT l_suppkey AS g, l_partkey AS i FROM lineitem), n AS (SELECT g, count(*) AS n FROM m GROUP BY 1),
p AS (SELECT x.g AS a, y.g AS b, count(*) AS inter FROM m x JOIN m y ON x.i = y.i AND x.g < y.g GROUP BY 1, 2),
o AS (SELECT a, b, inter, n1.n AS size_a, n2.n AS size_b FROM p JOIN n n1 ON a = n1.g JOIN n n2 ON b = n2.g)"""


def _members(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_suppkey", "l_partkey")


@query(
    "j4_candidate_pairs",
    _OVERLAP + """ SELECT a, b FROM o JOIN supplier s1 ON a = s1.s_suppkey JOIN supplier s2 ON b = s2.s_suppkey
    WHERE (s1.s_nationkey = s2.s_nationkey AND inter / (size_a + size_b - inter)::DOUBLE >= 0.1) OR (s1.s_nationkey = s2.s_nationkey AND abs(s1.s_acctbal - s2.s_acctbal) <= 500)""",
)
def j4(spark: SparkSession, d: str) -> DataFrame:
    """Class gate as an equi-join key first; then overlap or closeness."""
    pairs = S.set_overlaps(_members(spark, d), "l_suppkey", "l_partkey")
    side = table(spark, d, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
    both = pairs.join(side.toDF("a", "class", "bal_a"), "a").join(side.toDF("b", "class", "bal_b"), ["b", "class"])
    return both.where((S.iou() >= 0.1) | (F.abs(F.col("bal_a") - F.col("bal_b")) <= 500)).select("a", "b")


@query("j6_point_iou", _OVERLAP + " SELECT a, b, round(inter / (size_a + size_b - inter)::DOUBLE, 6) AS iou FROM o")
def j6(spark: SparkSession, d: str) -> DataFrame:
    return S.set_overlaps(_members(spark, d), "l_suppkey", "l_partkey").select("a", "b", F.round(S.iou(), 6).alias("iou"))


@query("j9_mask_iom", _OVERLAP + " SELECT a, b, inter, round(inter / least(size_a, size_b)::DOUBLE, 6) AS iom FROM o WHERE inter / least(size_a, size_b)::DOUBLE > 0.3")
def j9(spark: SparkSession, d: str) -> DataFrame:
    return S.set_overlaps(_members(spark, d), "l_suppkey", "l_partkey").where(S.iom() > 0.3).select("a", "b", "inter", F.round(S.iom(), 6).alias("iom"))


_BOXES = "SELECT l_orderkey AS img, l_linenumber AS id, l_quantity AS x1, l_discount * 100 AS y1, l_quantity + 10 AS x2, l_discount * 100 + 6 AS y2 FROM lineitem"


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount").selectExpr(
        "l_orderkey AS img", "l_linenumber AS id", "l_quantity AS x1", "l_discount * 100 AS y1", "l_quantity + 10 AS x2", "l_discount * 100 + 6 AS y2"
    )


def box_pairs(boxes: DataFrame) -> DataFrame:
    """All pairs of an image's boxes, id < id2, with their IoU; an image's boxes are few."""
    other = boxes.select("img", *(F.col(c).alias(f"{c}_b") for c in boxes.columns if c != "img"))
    pairs = boxes.join(other, "img").where("id < id_b")
    sides = [[F.col(f"{c}{s}") for c in ("x1", "y1", "x2", "y2")] for s in ("", "_b")]
    return pairs.withColumn("iou", G.box_iou(*sides))


@query(
    "j7_box_iou",
    f"""WITH b AS ({_BOXES}), p AS (SELECT a.img, a.id, b.id AS id_b, greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0) AS i
    FROM b a JOIN b ON a.img = b.img AND a.id < b.id) SELECT img, id, id_b, round(i / (120 - i), 6) AS iou FROM p WHERE i > 0""",
)
def j7(spark: SparkSession, d: str) -> DataFrame:
    return box_pairs(_boxes(spark, d)).where("iou > 0").select("img", "id", "id_b", F.round("iou", 6).alias("iou"))


@query(
    "j10_centre_similarity",
    f"""WITH b AS ({_BOXES}) SELECT a.img, a.id, b.id AS id_b, round(greatest(0, 1 - sqrt((a.x1 - b.x1) ** 2 + (a.y1 - b.y1) ** 2) / 20), 6) AS sim FROM b a JOIN b ON a.img = b.img AND a.id < b.id""",
)
def j10(spark: SparkSession, d: str) -> DataFrame:
    gap = F.sqrt((F.col("x1") - F.col("x1_b")) ** 2 + (F.col("y1") - F.col("y1_b")) ** 2)
    return box_pairs(_boxes(spark, d)).select("img", "id", "id_b", F.round(F.greatest(F.lit(0.0), 1 - gap / 20), 6).alias("sim"))


_CUST = "SELECT c_custkey AS id, c_acctbal / 100 AS x, c_nationkey * 1.0 AS y FROM customer"
_SUPP = "SELECT s_suppkey AS id, s_acctbal / 100 AS x, s_nationkey * 1.0 AS y FROM supplier"


def _cust(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer", "c_custkey", "c_acctbal", "c_nationkey").selectExpr("c_custkey AS id", "c_acctbal / 100 AS x", "c_nationkey * 1.0D AS y")


def _supp(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier", "s_suppkey", "s_acctbal", "s_nationkey").selectExpr("s_suppkey AS id", "s_acctbal / 100 AS x", "s_nationkey * 1.0D AS y")


@query("j11_radius_count", f"WITH c AS ({_CUST}), s AS ({_SUPP}) SELECT c.id, count(*) AS n FROM c JOIN s ON (c.x - s.x) ** 2 + (c.y - s.y) ** 2 <= 9.0 GROUP BY 1")
def j11(spark: SparkSession, d: str) -> DataFrame:
    return S.within_radius(_cust(spark, d), _supp(spark, d), ["x", "y"], 3.0).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j12_nearest_bounded",
    f"""WITH c AS ({_CUST}), s AS ({_SUPP}), r AS (SELECT c.id, s.id AS supp, (c.x - s.x) ** 2 + (c.y - s.y) ** 2 AS d2 FROM c JOIN s ON (c.x - s.x) ** 2 + (c.y - s.y) ** 2 <= 25.0)
    SELECT id, supp, round(d2, 6) AS dist2 FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, supp) AS k FROM r) WHERE k = 1""",
)
def j12(spark: SparkSession, d: str) -> DataFrame:
    found = S.nearest(_cust(spark, d), _supp(spark, d).withColumnRenamed("id", "supp"), ["x", "y"], "id", "supp", 5.0)
    return found.withColumn("dist2", F.round("dist2", 6))


@query(
    "j13_nearest_anchor",
    f"""WITH c AS ({_CUST}), n AS (SELECT n_nationkey AS k, n_nationkey * 4.0 AS nx, n_regionkey * 5.0 AS ny FROM nation), r AS (SELECT id, k, (x - nx) ** 2 + (y - ny) ** 2 AS d2 FROM c, n)
    SELECT id, k FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d2, k) AS p FROM r) WHERE p = 1 AND d2 < 400.0""",
)
def j13(spark: SparkSession, d: str) -> DataFrame:
    """Nearest of a few anchors (the nations, a fixed list) by a grid join within the bound; exactly at it is too far."""
    anchors = table(spark, d, "nation", "n_nationkey", "n_regionkey").selectExpr("n_nationkey AS k", "n_nationkey * 4.0D AS x", "n_regionkey * 5.0D AS y")
    return S.nearest(_cust(spark, d), anchors, ["x", "y"], "id", "k", 20.0).where("dist2 < 400.0").select("id", "k")


@query(
    "j14_anti_join_pruning",
    """WITH s AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'), o AS (SELECT DISTINCT l_suppkey FROM lineitem WHERE l_returnflag = 'N' AND l_discount >= 0.1 AND l_quantity > 48)
    SELECT l_suppkey, count(*) AS n FROM s WHERE l_suppkey NOT IN (SELECT l_suppkey FROM o) GROUP BY 1""",
)
def j14(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_orderkey", "l_suppkey", "l_returnflag", "l_discount", "l_quantity")
    other = rows.where("l_returnflag = 'N' AND l_discount >= 0.1 AND l_quantity > 48").select("l_suppkey").distinct()
    own = rows.where("l_returnflag = 'A'").select("l_orderkey", "l_suppkey").distinct()
    return own.join(other, "l_suppkey", "left_anti").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@query("j15_prompt_positions", "SELECT d.lang, count(*) AS prompts, sum((l.doc_id IS NULL)::INT)::BIGINT AS missing FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def j15(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels", "doc_id").withColumn("_has", F.lit(True))
    both = table(spark, d, "documents", "doc_id", "lang").join(labels, "doc_id", "left")
    return both.groupBy("lang").agg(F.count(F.lit(1)).alias("prompts"), F.sum(F.col("_has").isNull().cast("int")).alias("missing"))


@query(
    "j16_subtitle_frames",
    """WITH i AS (SELECT o_orderkey, o_orderkey * 1.5 AS a, o_orderkey * 1.5 + o_custkey % 40 AS b FROM orders), t AS (SELECT DISTINCT c_custkey * 7.0 AS t FROM customer)
    SELECT o_orderkey FROM i WHERE EXISTS (SELECT 1 FROM t WHERE a < t AND t < b)""",
)
def j16(spark: SparkSession, d: str) -> DataFrame:
    subtitles = table(spark, d, "orders", "o_orderkey", "o_custkey").selectExpr("o_orderkey", "o_orderkey * 1.5D AS a", "o_orderkey * 1.5D + o_custkey % 40 AS b")
    frames = table(spark, d, "customer", "c_custkey").selectExpr("c_custkey * 7.0D AS t")
    return S.overlapping_intervals(subtitles, "a", "b", frames, "t", 20.0).select("o_orderkey")


@query(
    "j20_one_to_many",
    """WITH q AS (SELECT *, quantile_cont(l_extendedprice, 0.7) OVER (PARTITION BY l_orderkey) AS t FROM lineitem)
    SELECT l_orderkey, l_linenumber FROM q WHERE l_extendedprice > t AND l_extendedprice > 20000.0""",
)
def j20(spark: SparkSession, d: str) -> DataFrame:
    """Pairs whose score beats their target's quantile and a floor, strictly both."""
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    cuts = rows.groupBy("l_orderkey").agg(F.percentile("l_extendedprice", F.lit(0.7)).alias("t"))
    return rows.join(cuts, "l_orderkey").where("l_extendedprice > t AND l_extendedprice > 20000.0").select("l_orderkey", "l_linenumber")


@query(
    "j21_label_merge_rules",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'pole' WHEN l_returnflag = 'R' THEN 'sign' WHEN l_linestatus = 'O' AND l_quantity > 25 THEN 'tree' ELSE 'ground' END AS label FROM lineitem""",
)
def j21(spark: SparkSession, d: str) -> DataFrame:
    """Override rules in their order: the first that holds decides."""
    c = F.col
    label = F.when((c("l_returnflag") == "A") & (c("l_linestatus") == "F"), "pole").when(c("l_returnflag") == "R", "sign").when((c("l_linestatus") == "O") & (c("l_quantity") > 25), "tree")
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity").select("l_orderkey", "l_linenumber", label.otherwise("ground").alias("label"))


@query("j22_attach_labels", "SELECT vec_id, i - 1 AS position, embedding[i]::DOUBLE AS value FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)")
def j22(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "embeddings", "vec_id", "embedding").select("vec_id", F.posexplode("embedding").alias("position", "_v"))
    return rows.select("vec_id", F.col("position").cast("long").alias("position"), F.col("_v").cast("double").alias("value"))


@query(
    "a10_ground_band",
    """WITH q AS (SELECT c_nationkey, quantile_cont(c_acctbal, 0.05) AS lo, quantile_cont(c_acctbal, 0.95) AS hi FROM customer GROUP BY 1)
    SELECT c_custkey FROM customer JOIN q USING (c_nationkey) WHERE c_acctbal > lo + 0.1 * (hi - lo)""",
)
def a10(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    cuts = rows.groupBy("c_nationkey").agg(F.percentile("c_acctbal", F.lit(0.05)).alias("lo"), F.percentile("c_acctbal", F.lit(0.95)).alias("hi"))
    return rows.join(cuts, "c_nationkey").where("c_acctbal > lo + 0.1 * (hi - lo)").select("c_custkey")


@query("a15_robust_radius", "SELECT c_nationkey, round(quantile_cont(abs(c_acctbal), 0.9), 4) AS r90 FROM customer GROUP BY 1")
def a15(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer", "c_nationkey", "c_acctbal").groupBy("c_nationkey").agg(F.round(F.percentile(F.abs("c_acctbal"), F.lit(0.9)), 4).alias("r90"))


@query("a16_station_ground", "SELECT s_nationkey, round(quantile_cont(s_acctbal, 0.5) - 2, 4) AS ground FROM supplier GROUP BY 1")
def a16(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier", "s_nationkey", "s_acctbal").groupBy("s_nationkey").agg((F.round(F.percentile("s_acctbal", F.lit(0.5)) - 2, 4)).alias("ground"))


@query(
    "a18_idw",
    f"""WITH c AS ({_CUST}), s AS (SELECT s_suppkey, s_acctbal / 100 AS x, s_nationkey * 1.0 AS y, s_acctbal AS v FROM supplier),
    p AS (SELECT c.id, sqrt((c.x - s.x) ** 2 + (c.y - s.y) ** 2) AS dist, v FROM c JOIN s ON (c.x - s.x) ** 2 + (c.y - s.y) ** 2 <= 9.0)
    SELECT id, round(CASE WHEN min(dist) <= 1e-6 THEN avg(v) FILTER (dist <= 1e-6) ELSE sum(v / dist) FILTER (dist > 1e-6) / sum(1 / dist) FILTER (dist > 1e-6) END, 3) AS value FROM p GROUP BY 1""",
)
def a18(spark: SparkSession, d: str) -> DataFrame:
    """Inverse-distance mean of the neighbours; at a sample's own place the samples there alone."""
    samples = table(spark, d, "supplier", "s_suppkey", "s_acctbal", "s_nationkey").selectExpr("s_suppkey AS id", "s_acctbal / 100 AS x", "s_nationkey * 1.0D AS y", "s_acctbal AS v")
    dist, v, here = F.sqrt("dist2"), F.col("r_v"), F.sqrt("dist2") <= 1e-6
    found = S.within_radius(_cust(spark, d), samples, ["x", "y"], 3.0).groupBy("id").agg(
        F.avg(F.when(here, v)).alias("_at"), (F.sum(F.when(~here, v / dist)) / F.sum(F.when(~here, 1 / dist))).alias("_near")
    )
    return found.select("id", F.round(F.coalesce("_at", "_near"), 3).alias("value"))
