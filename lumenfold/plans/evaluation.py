"""Detection and tracking evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumenfold.operators import evaluation as E

from .joins import _boxes, box_pairs
from .registry import query, table


@query("j19_hungarian")
def j19(spark: SparkSession, d: str) -> DataFrame:
    """Odd and even lines of an order matched by box overlap."""
    pairs = box_pairs(_boxes(spark, d)).where("id % 2 != id_b % 2").select("img", F.when(F.col("id") % 2 == 1, F.col("id")).otherwise(F.col("id_b")).alias("gt"), F.when(F.col("id") % 2 == 1, F.col("id_b")).otherwise(F.col("id")).alias("det"), "iou")
    return E.hungarian(pairs.groupBy("img", "gt", "det").agg(F.max("iou").alias("iou")), ["img"], "gt", "det", "iou")


@query("w1_greedy_nms")
def w1(spark: SparkSession, d: str) -> DataFrame:
    boxes = _boxes(spark, d).withColumn("score", F.col("x1") * 0.01 + F.col("y1") * 0.001)
    return E.greedy_keep(boxes, ["img"], "id", "score", ["x1", "y1", "x2", "y2"], 0.5).select("img", "id")


@query("w4_overlap_removal")
def w4(spark: SparkSession, d: str) -> DataFrame:
    boxes = _boxes(spark, d).withColumn("score", F.col("x1") * 0.01 + F.col("y1") * 0.001)
    return E.greedy_keep(boxes, ["img"], "id", "score", ["x1", "y1", "x2", "y2"], 0.3, "iom").select("img", "id")


@query("w3_frame_nms")
def w3(spark: SparkSession, d: str) -> DataFrame:
    boxes = _boxes(spark, d).withColumn("score", F.col("x1") * 0.01 + F.col("y1") * 0.001)
    return E.greedy_keep(boxes, ["img"], "id", "score", ["x1", "y1", "x2", "y2"], 0.5, at_limit=True).select("img", "id")


_IL = """SELECT lang, sum((quality = 1 AND toxic = 1)::INT) AS il_tp, sum((quality = 0 AND toxic = 1)::INT) AS il_fp, sum((quality = 1 AND toxic = 0)::INT) AS il_fn, sum((quality = 0 AND toxic = 0)::INT) AS il_tn,
sum((quality = 1)::INT) * 3 AS tp, sum((toxic = 1)::INT) * 2 AS fp, sum((quality = 0)::INT) AS fn FROM labels JOIN documents USING (doc_id) GROUP BY 1"""


@query(
    "e5_cgf1",
    f"""WITH s AS (SELECT lang, tp::DOUBLE AS tp, fp::DOUBLE AS fp, fn::DOUBLE AS fn, il_tp::DOUBLE AS a, il_fp::DOUBLE AS b, il_fn::DOUBLE AS c, il_tn::DOUBLE AS t FROM ({_IL})),
    p AS (SELECT lang, tp / (tp + fp + 1e-4) AS p, tp / (tp + fn + 1e-4) AS r, (a * t - b * c) / (sqrt((a + b) * (a + c) * (t + b) * (t + c)) + 1e-6) AS mcc FROM s)
    SELECT lang, round(p, 6) AS "precision", round(r, 6) AS recall, round(2 * p * r / (p + r + 1e-4), 6) AS f1, round(mcc, 6) AS mcc, round(2 * p * r / (p + r + 1e-4) * mcc, 6) AS cgf1 FROM p""",
)
def e5(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels", "doc_id", "quality", "toxic").join(table(spark, d, "documents", "doc_id", "lang"), "doc_id")
    flag = lambda q, t: ((F.col("quality") == q) & (F.col("toxic") == t)).cast("int")
    counts = rows.select(
        "lang", flag(1, 1).alias("il_tp"), flag(0, 1).alias("il_fp"), flag(1, 0).alias("il_fn"), flag(0, 0).alias("il_tn"),
        ((F.col("quality") == 1).cast("int") * 3).alias("tp"), ((F.col("toxic") == 1).cast("int") * 2).alias("fp"), (F.col("quality") == 0).cast("int").alias("fn"),
    )
    found = E.classification_f1(counts, ["lang"])
    return found.select("lang", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "mcc", "cgf1")))


@query(
    "e3_threshold_counts",
    """WITH m AS (SELECT l_orderkey AS img, l_discount * 10 AS iou, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem), t AS (SELECT unnest([0.5, 0.6, 0.7, 0.8, 0.9]) AS threshold)
    SELECT img, threshold::DOUBLE AS threshold, sum((round(iou, 6) >= threshold)::INT)::BIGINT AS tp, max(n) + 1 - sum((round(iou, 6) >= threshold)::INT)::BIGINT AS fp, max(n) - sum((round(iou, 6) >= threshold)::INT)::BIGINT AS fn FROM m, t GROUP BY 1, 2""",
)
def e3(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_orderkey", "l_discount").withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey")))
    rows = rows.select(F.col("l_orderkey").alias("img"), F.round(F.col("l_discount") * 10, 6).alias("iou"), "n", (F.col("n") + 1).alias("m"))
    return E.threshold_counts(rows, ["img"], "iou", "n", "m", [0.5, 0.6, 0.7, 0.8, 0.9])


@query(
    "e7_average_precision",
    """WITH h AS (SELECT event_type, event_id, value, (event_id % 3 = 0)::INT AS hit FROM events), c AS (SELECT *, sum(hit) OVER w AS tp, row_number() OVER w AS n, sum(hit) OVER (PARTITION BY event_type) AS pos FROM h WINDOW w AS (PARTITION BY event_type ORDER BY value DESC, event_id)),
    p AS (SELECT event_type, tp / pos::DOUBLE AS r, max(tp / n::DOUBLE) OVER (PARTITION BY event_type ORDER BY value DESC, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS e FROM c),
    g AS (SELECT unnest(range(0, 101)) AS k), f AS (SELECT event_type, k, max(e) AS e FROM p JOIN g ON r * 100 + 1e-9 >= k GROUP BY 1, 2)
    SELECT event_type, round(sum(e) / 101, 6) AS ap FROM f GROUP BY 1""",
)
def e7(spark: SparkSession, d: str) -> DataFrame:
    hits = table(spark, d, "events", "event_type", "event_id", "value").withColumn("hit", (F.col("event_id") % 3 == 0).cast("int"))
    positives = hits.groupBy("event_type").agg(F.sum("hit").alias("n_pos"))
    return E.average_precision(hits, ["event_type"], "value", "event_id", "hit", positives).withColumn("ap", F.round("ap", 6))


@query("e8_top_per_image", "SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS k FROM lineitem) WHERE k <= 2")
def e8(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber", "l_partkey")
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey").withColumn("_k", F.row_number().over(w))
    return rows.where("_k <= 2").select("l_orderkey", "l_linenumber")


@query("e9_dedup_predictions", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS k FROM events) WHERE k <= 1")
def e9(spark: SparkSession, d: str) -> DataFrame:
    best = table(spark, d, "events", "user_id", "event_type", "value", "event_id").groupBy("user_id", "event_type").agg(F.max(F.struct("value", (-F.col("event_id")).alias("_m"))).alias("_b"))
    return best.select("user_id", "event_type", (-F.col("_b._m")).alias("event_id"))


@query("e10_first_rank_wins", "SELECT user_id, event_type, event_id FROM (SELECT *, rank() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 4) AS k FROM events) WHERE k = 1")
def e10(spark: SparkSession, d: str) -> DataFrame:
    """All rows of a (video, category) from the first shard that has any."""
    rows = table(spark, d, "events", "user_id", "event_type", "event_id").withColumn("_s", F.col("event_id") % 4)
    first = rows.groupBy("user_id", "event_type").agg(F.min("_s").alias("_s"))
    return rows.join(first, ["user_id", "event_type", "_s"]).select("user_id", "event_type", "event_id")


@query("e11_merge_shards", "SELECT DISTINCT user_id AS img FROM events ORDER BY 1")
def e11(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events", "user_id", "event_id")
    return rows.where("event_id % 2 = 0").unionByName(rows.where("event_id % 2 = 1")).select(F.col("user_id").alias("img")).distinct()


@query(
    "e12_remap_pairs",
    """WITH p AS (SELECT DISTINCT user_id, event_type FROM events WHERE value > 20), n AS (SELECT DISTINCT user_id, event_type FROM events EXCEPT SELECT * FROM p)
    SELECT user_id, event_type, row_number() OVER (ORDER BY neg, user_id, event_type)::BIGINT AS video FROM (SELECT *, 0 AS neg FROM p UNION ALL SELECT *, 1 FROM n)""",
)
def e12(spark: SparkSession, d: str) -> DataFrame:
    """New ids for (video, category): positives first, negatives after them."""
    rows = table(spark, d, "events", "user_id", "event_type", "value").groupBy("user_id", "event_type").agg((1 - F.max((F.col("value") > 20).cast("int"))).alias("neg"))
    w = Window.orderBy("neg", "user_id", "event_type")
    return rows.select("user_id", "event_type", F.row_number().over(w).cast("long").alias("video"))


@query("e13_track_ids", "SELECT l_orderkey, l_suppkey, (dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey))::INT AS track FROM lineitem")
def e13(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_orderkey", "l_suppkey").withColumn("track", F.dense_rank().over(Window.partitionBy("l_orderkey").orderBy("l_suppkey")))


@query("e14_reindex", "SELECT n_nationkey + (SELECT (min(n_nationkey) = 0)::INT FROM nation) AS id, n_name FROM nation")
def e14(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "nation", "n_nationkey", "n_name")
    shift = rows.agg((F.min("n_nationkey") == 0).cast("int").alias("_s"))
    return rows.crossJoin(F.broadcast(shift)).select((F.col("n_nationkey") + F.col("_s")).alias("id"), "n_name")  # one row


@query(
    "e16_track_iou",
    """WITH a AS (SELECT o_custkey % 50 AS k, o_orderkey % 30 AS f, sum(o_totalprice) AS s FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2), b AS (SELECT o_custkey % 50 AS k, o_orderkey % 30 AS f, sum(o_totalprice) AS s FROM orders WHERE o_orderstatus = 'O' GROUP BY 1, 2)
    SELECT coalesce(a.k, b.k) AS l, coalesce(a.k, b.k) AS r, round(sum(coalesce(least(a.s, b.s), 0) * (a.s IS NOT NULL AND b.s IS NOT NULL)::INT) / sum(coalesce(a.s, 0) + coalesce(b.s, 0) - coalesce(least(a.s, b.s), 0) * (a.s IS NOT NULL AND b.s IS NOT NULL)::INT), 6) AS iou
    FROM a FULL JOIN b ON a.k = b.k AND a.f = b.f GROUP BY 1""",
)
def e16(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    side = lambda s, n: rows.where(F.col("o_orderstatus") == s).groupBy((F.col("o_custkey") % 50).alias("l"), (F.col("o_custkey") % 50).alias("r"), (F.col("o_orderkey") % 30).alias("f")).agg(F.sum("o_totalprice").alias(n))
    a, b = side("F", "area_a"), side("O", "area_b")
    both = a.join(b, ["l", "r", "f"]).select("l", "r", "f", F.least("area_a", "area_b").alias("inter"))
    right = b.join(both, ["l", "r", "f"], "left")
    return E.track_iou(a, right, "f", "area_a", "area_b", "inter").withColumn("iou", F.round("iou", 6))


@query("e17_hota")
def e17(spark: SparkSession, d: str) -> DataFrame:
    """Customers' events as tracks: odd and even event ids are the two sides."""
    rows = table(spark, d, "events", "event_id", "user_id", "event_type", "value")
    tracks = rows.select(F.col("event_type").alias("seq"), (F.col("event_id") % 10).alias("t"), (F.col("user_id") % 7).alias("gt"), (F.col("event_id") % 6).alias("trk"), (F.col("value") % 1).alias("sim"))
    return E.hota(tracks.groupBy("seq", "t", "gt", "trk").agg(F.max("sim").alias("sim")), ["seq"])


@query("e18_hota_combined")
def e18(spark: SparkSession, d: str) -> DataFrame:
    return E.combine_hota(e17(spark, d))


@query("e20_counts", "SELECT l_returnflag, count(*) AS dets, count(DISTINCT l_suppkey) AS ids FROM lineitem GROUP BY 1")
def e20(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_returnflag", "l_suppkey").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("dets"), F.countDistinct("l_suppkey").alias("ids"))


@query("e23_postprocess", "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_discount > 0.03 GROUP BY 1")
def e23(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_orderkey", "l_discount").where("l_discount > 0.03").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
