"""Votes, aggregates and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumenfold.operators import votes as V

from .registry import query, table


@query(
    "a4_weighted_vote",
    """WITH v AS (SELECT l_partkey, l_suppkey, sum(l_extendedprice) AS s FROM lineitem WHERE l_extendedprice > 0 GROUP BY 1, 2),
    r AS (SELECT *, sum(s) OVER (PARTITION BY l_partkey) AS t, row_number() OVER (PARTITION BY l_partkey ORDER BY s DESC, l_suppkey) AS k FROM v)
    SELECT l_partkey, l_suppkey, round(s / t, 6) AS confidence FROM r WHERE k = 1""",
)
def a4(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_extendedprice")
    return V.weighted_vote(rows, "l_partkey", "l_suppkey", "l_extendedprice").withColumn("confidence", F.round("confidence", 6))


@query(
    "a2_merged_instances",
    """WITH p AS (SELECT l_suppkey, count(DISTINCT l_partkey) AS n_points FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_partkey) >= 5),
    s AS (SELECT l_suppkey, l_linenumber, sum(l_quantity) AS s FROM lineitem GROUP BY 1, 2),
    r AS (SELECT *, sum(s) OVER (PARTITION BY l_suppkey) AS t, row_number() OVER (PARTITION BY l_suppkey ORDER BY s DESC, l_linenumber) AS k FROM s)
    SELECT l_suppkey, n_points, l_linenumber, round(s / t, 6) AS confidence FROM r JOIN p USING (l_suppkey) WHERE k = 1""",
)
def a2(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity")
    found = V.merged_instances(rows, "l_suppkey", "l_partkey", "l_linenumber", "l_quantity", 5)
    return found.withColumn("confidence", F.round("confidence", 6))


@query(
    "a3_detection_merge",
    """WITH c AS (SELECT l_orderkey, l_returnflag, count(*) AS n, min(l_linenumber) AS p FROM lineitem GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, p, l_returnflag DESC) AS k FROM c),
    b AS (SELECT l_orderkey, min(l_quantity) AS x1, min(l_discount) AS y1, max(l_quantity) AS x2, max(l_discount) AS y2 FROM lineitem GROUP BY 1)
    SELECT l_orderkey, l_returnflag, x1, y1, x2, y2 FROM r JOIN b USING (l_orderkey) WHERE k = 1""",
)
def a3(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_orderkey", "l_returnflag", "l_linenumber", "l_quantity", "l_discount")
    box = rows.groupBy("l_orderkey").agg(F.min("l_quantity").alias("x1"), F.min("l_discount").alias("y1"), F.max("l_quantity").alias("x2"), F.max("l_discount").alias("y2"))
    return V.majority_label(rows, "l_orderkey", "l_returnflag", "l_linenumber").join(box, "l_orderkey")


@query("a6_point_counts", "SELECT count(*) AS total_points, count(DISTINCT l_partkey) AS distinct_points FROM lineitem")
def a6(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem", "l_partkey").agg(F.count(F.lit(1)).alias("total_points"), F.countDistinct("l_partkey").alias("distinct_points"))


@query(
    "a9_densify_ids",
    """SELECT o_custkey, n FROM (SELECT (dense_rank() OVER (ORDER BY o_custkey) - 1) AS o_custkey, n FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 5))""",
)
def a9(spark: SparkSession, d: str) -> DataFrame:
    kept = table(spark, d, "orders", "o_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n > 5")
    return V.densify(kept, "o_custkey").select(F.col("o_custkey").cast("long").alias("o_custkey"), "n")


@query(
    "a19_confusion",
    """SELECT quality, toxic, count(*) AS n, ceil(count(*) * 1000 / (SELECT count(*) FROM labels))::BIGINT AS permille FROM labels GROUP BY 1, 2""",
)
def a19(spark: SparkSession, d: str) -> DataFrame:
    return V.confusion(table(spark, d, "labels", "quality", "toxic"), "quality", "toxic")


@query(
    "a20_accuracy_rollup",
    """SELECT coalesce(lang, 'Overall') AS lang, count(*) AS n, round(avg((n_chars > 1000)::INT), 6) AS accuracy FROM documents GROUP BY ROLLUP (lang)""",
)
def a20(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents", "lang", "n_chars").withColumn("hit", (F.col("n_chars") > 1000).cast("int"))
    return V.accuracy_report(rows, "lang", "hit").withColumn("accuracy", F.round("accuracy", 6))


@query(
    "a21_benchmark_table",
    """SELECT coalesce(o_orderpriority, 'Overall') AS category, count(*) AS tot, sum((o_orderstatus <> 'O')::INT)::BIGINT AS prefetch, sum((o_totalprice > 100000)::INT)::BIGINT AS hit,
    round(100.0 * sum((o_orderstatus <> 'O')::INT) / count(*), 4) AS prefetch_rate, round(100.0 * sum((o_totalprice > 100000)::INT) / count(*), 4) AS acc
    FROM orders GROUP BY ROLLUP (o_orderpriority)""",
)
def a21(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_orderpriority", "o_orderstatus", "o_totalprice")
    share = lambda c: F.round(100.0 * F.sum(c.cast("int")) / F.count(F.lit(1)), 4)
    early, hit = F.col("o_orderstatus") != "O", F.col("o_totalprice") > 100000
    return rows.rollup("o_orderpriority").agg(
        F.count(F.lit(1)).alias("tot"), F.sum(early.cast("int")).alias("prefetch"), F.sum(hit.cast("int")).alias("hit"), share(early).alias("prefetch_rate"), share(hit).alias("acc")
    ).withColumn("category", F.coalesce("o_orderpriority", F.lit("Overall"))).drop("o_orderpriority")


@query(
    "a22_running_average",
    """SELECT event_id, user_id, (sum(round(value * 10000)::BIGINT) OVER w)::BIGINT AS total, count(value) OVER w AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def a22(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = table(spark, d, "events", "event_id", "user_id", "ts", "value")
    return rows.select("event_id", "user_id", F.sum(F.round(F.col("value") * 10000).cast("long")).over(w).alias("total"), F.count("value").over(w).alias("n"))


@query(
    "a23_category_mean",
    """WITH l AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events)
    SELECT event_type, round(avg(value), 6) AS mean FROM l WHERE k = 1 GROUP BY 1""",
)
def a23(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events", "event_id", "user_id", "event_type", "ts", "value")
    last = rows.groupBy("user_id", "event_type").agg(F.max(F.struct("ts", "event_id", "value")).alias("_l"))
    return last.groupBy("event_type").agg(F.round(F.avg("_l.value"), 6).alias("mean"))


@query(
    "a5_logit_backprojection",
    """WITH u AS (SELECT l_partkey, l_orderkey, l_linenumber, l_quantity / (l_discount + 1e-6) AS w, row_number() OVER (PARTITION BY l_partkey, l_orderkey ORDER BY l_linenumber DESC, l_quantity DESC, l_discount DESC) AS k FROM lineitem),
    s AS (SELECT l_partkey, l_linenumber AS cls, sum(w) AS s FROM u WHERE k = 1 GROUP BY 1, 2),
    r AS (SELECT *, sum(s) OVER (PARTITION BY l_partkey) AS t, row_number() OVER (PARTITION BY l_partkey ORDER BY s DESC, cls) AS k FROM s)
    SELECT l_partkey, cls, round(s / t, 6) AS confidence FROM r WHERE k = 1""",
)
def a5(spark: SparkSession, d: str) -> DataFrame:
    """A point counts once per image: the last of its rows there."""
    rows = table(spark, d, "lineitem", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    once = rows.groupBy("l_partkey", "l_orderkey").agg(F.max(F.struct("l_linenumber", "l_quantity", "l_discount")).alias("_r")).select(
        "l_partkey", F.col("_r.l_linenumber").alias("cls"), (F.col("_r.l_quantity") / (F.col("_r.l_discount") + 1e-6)).alias("_w")
    )
    return V.weighted_vote(once, "l_partkey", "cls", "_w").withColumn("confidence", F.round("confidence", 6))


@query("u1_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def u1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, d, "supplier").select("s_nationkey")).distinct()


@query("u2_intersect", "SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 5000")
def u2(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_custkey").alias("k")).intersect(table(spark, d, "customer").where("c_acctbal > 5000").select("c_custkey"))


@query("u3_except", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def u3(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("k")).subtract(table(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select("o_custkey"))


@query(
    "u4_union_clouds",
    "SELECT 0 AS scene, c_custkey AS pid, c_nationkey AS cls_id FROM customer UNION ALL SELECT 1, s_suppkey, coalesce(NULL, s_nationkey) FROM supplier",
)
def u4(spark: SparkSession, d: str) -> DataFrame:
    """Clouds one after the other; a cloud without cls_id takes its classification."""
    first = table(spark, d, "customer").select(F.lit(0).alias("scene"), F.col("c_custkey").alias("pid"), F.col("c_nationkey").alias("cls_id"))
    second = table(spark, d, "supplier").select(F.lit(1).alias("scene"), F.col("s_suppkey").alias("pid"), F.col("s_nationkey").alias("classification"))
    both = first.unionByName(second, allowMissingColumns=True)
    return both.select("scene", "pid", F.coalesce("cls_id", "classification").alias("cls_id"))


@query(
    "u7_sampling_rate",
    "SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(doc_id::VARCHAR), doc_id) AS r, count(*) OVER (PARTITION BY source) AS n FROM documents) WHERE r <= floor(n * 0.3)",
)
def u7(spark: SparkSession, d: str) -> DataFrame:
    """Each source is sampled at its rate: the first share of its rows in hash order."""
    w = Window.partitionBy("source")
    rows = table(spark, d, "documents", "doc_id", "source").withColumn("_n", F.count(F.lit(1)).over(w))
    ranked = rows.withColumn("_r", F.row_number().over(w.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")))
    return ranked.where(F.col("_r") <= F.floor(F.col("_n") * F.lit(0.3))).select("doc_id", "source")


@query(
    "w6_first_per_group",
    """SELECT event_type, round(max(value), 6) AS score FROM events GROUP BY 1""",
)
def w6(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events", "event_type", "value").groupBy("event_type").agg(F.round(F.max("value"), 6).alias("score"))


@query(
    "w7_positives_first",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderstatus <> 'F')::INT, md5(o_orderkey::VARCHAR), o_orderkey) AS r FROM orders) WHERE r <= 3""",
)
def w7(spark: SparkSession, d: str) -> DataFrame:
    """At most three queries a datapoint, positives first, in hash order."""
    w = Window.partitionBy("o_custkey").orderBy((F.col("o_orderstatus") != "F").cast("int"), F.md5(F.col("o_orderkey").cast("string")), "o_orderkey")
    rows = table(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus").withColumn("_r", F.row_number().over(w))
    return rows.where("_r <= 3").select("o_custkey", "o_orderkey")


@query(
    "w8_strided_stages",
    """WITH s AS (SELECT conv_id, turn, (dense_rank() OVER (PARTITION BY conv_id ORDER BY turn) - 1) AS k, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
    SELECT conv_id, turn, (k // least(2, greatest(1, (n - 1) // 2)))::BIGINT AS stage FROM s
    WHERE k % least(2, greatest(1, (n - 1) // 2)) = 0 AND k // least(2, greatest(1, (n - 1) // 2)) < 3""",
)
def w8(spark: SparkSession, d: str) -> DataFrame:
    """Three stages at stride 2, or at the largest stride that fits; kept stages are renumbered (W9)."""
    w = Window.partitionBy("conv_id")
    rows = table(spark, d, "conversations", "conv_id", "turn").withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_k", F.dense_rank().over(w.orderBy("turn")) - 1)
    stride = F.least(F.lit(2), F.greatest(F.lit(1), F.expr("(_n - 1) div 2")))
    rows = rows.withColumn("_s", stride)
    return rows.where("_k % _s = 0 AND _k div _s < 3").select("conv_id", "turn", F.expr("_k div _s").alias("stage"))


@query(
    "w9_remap_stages",
    """SELECT conv_id, turn, (dense_rank() OVER (PARTITION BY conv_id ORDER BY turn DESC) - 1)::INT AS stage FROM conversations WHERE role = 'assistant'""",
)
def w9(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy(F.desc("turn"))
    return table(spark, d, "conversations", "conv_id", "turn", "role").where("role = 'assistant'").select("conv_id", "turn", (F.dense_rank().over(w) - 1).alias("stage"))


@query("w10_seeded_shuffle", "SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR || '-7'), doc_id LIMIT 50")
def w10(spark: SparkSession, d: str) -> DataFrame:
    """A sample of 50, the same for one seed however the rows are partitioned."""
    return table(spark, d, "documents", "doc_id").orderBy(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit("-7"))), "doc_id").limit(50)


@query(
    "w11_cluster_order",
    """SELECT c_nationkey, row_number() OVER (ORDER BY n DESC, f) - 1 AS position FROM (SELECT c_nationkey, count(*) AS n, min(c_custkey) AS f FROM customer GROUP BY 1)""",
)
def w11(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "customer", "c_nationkey", "c_custkey").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("f"))
    return sizes.select("c_nationkey", V.cluster_order(sizes, "n", "f").cast("long").alias("position"))


@query(
    "w12_category_chunks",
    """SELECT n_nationkey, ((row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1) // 2)::BIGINT AS chunk, n_regionkey FROM nation""",
)
def w12(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("n_regionkey").orderBy("n_nationkey")
    return table(spark, d, "nation", "n_nationkey", "n_regionkey").select("n_nationkey", F.floor((F.row_number().over(w) - 1) / 2).alias("chunk"), "n_regionkey")


@query(
    "w13_least_loaded",
    """WITH n AS (SELECT o_custkey, count(*) AS c FROM orders GROUP BY 1) SELECT o_custkey, [(c + 3 - i) // 4 FOR i IN [0, 1, 2, 3]] AS load FROM n""",
)
def w13(spark: SparkSession, d: str) -> DataFrame:
    """Each new object goes to the least loaded of four slots, the first on ties."""
    counts = table(spark, d, "orders", "o_custkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("c"))
    place = lambda load, _: F.transform(load, lambda x, i: x + (i == F.array_position(load, F.array_min(load)) - 1).cast("long"))
    return counts.select("o_custkey", F.aggregate(F.sequence(F.lit(1), F.col("c")), F.array_repeat(F.lit(0).cast("long"), 4), place).alias("load"))


@query(
    "a8_largest_cluster",
    """WITH s AS (SELECT n_regionkey, c_nationkey, count(*) AS n, min(c_custkey) AS f FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n DESC, f) AS k FROM s)
    SELECT c.c_custkey, r.n_regionkey, r.c_nationkey FROM customer c JOIN r ON c.c_nationkey = r.c_nationkey WHERE k = 1 AND n >= 3""",
)
def a8(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer", "c_custkey", "c_nationkey").join(table(spark, d, "nation", "n_nationkey", "n_regionkey"), F.expr("c_nationkey = n_nationkey")).drop("n_nationkey")
    return V.largest_kept(rows, "n_regionkey", "c_nationkey", "c_custkey", 3)


@query(
    "p24_label_map",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 3 WHEN 'MACHINERY' THEN 5 ELSE 1 END AS label FROM customer""",
)
def p24(spark: SparkSession, d: str) -> DataFrame:
    labels = F.create_map(F.lit("BUILDING"), F.lit(3), F.lit("MACHINERY"), F.lit(5))
    return table(spark, d, "customer", "c_custkey", "c_mktsegment").select("c_custkey", F.coalesce(F.try_element_at(labels, F.col("c_mktsegment")), F.lit(1)).alias("label"))


@query(
    "j17_prediction_meta",
    """SELECT l.doc_id, d.lang, l.quality FROM labels l JOIN documents d USING (doc_id)""",
)
def j17(spark: SparkSession, d: str) -> DataFrame:
    """Predictions with their questions; a prediction without one is an error."""
    predictions, questions = table(spark, d, "labels", "doc_id", "quality"), table(spark, d, "documents", "doc_id", "lang")
    joined = predictions.join(questions.withColumn("_known", F.lit(True)), "doc_id", "left")
    checked = F.when(F.col("_known").isNull(), F.raise_error(F.lit("prediction without question"))).otherwise(F.col("lang"))
    return joined.select("doc_id", checked.alias("lang"), "quality")
