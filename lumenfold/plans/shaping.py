"""Training-data shaping queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lumenfold.operators import shaping as D

from .registry import query, table


@query("d1_bin_packing")
def d1(spark: SparkSession, d: str) -> DataFrame:
    """Conversations packed to a length in blocks of 256."""
    rows = table(spark, d, "conversations", "conv_id", "text").groupBy("conv_id").agg(F.sum(F.length("text")).alias("size"))
    return D.pack_blocks(rows.withColumn("block", F.floor(F.col("conv_id") / 256)), "block", "conv_id", "size", 4096)


@query("d2_token_estimate", "SELECT conv_id, sum(len(string_split_regex(trim(text), '\\s+')) + 128 * (turn % 2))::BIGINT AS tokens FROM conversations WHERE text IS NOT NULL GROUP BY 1")
def d2(spark: SparkSession, d: str) -> DataFrame:
    """Words, and 128 for each image (every odd turn has one here)."""
    rows = table(spark, d, "conversations", "conv_id", "turn", "text").where("text IS NOT NULL")
    return rows.groupBy("conv_id").agg(F.sum(F.size(F.split(F.trim("text"), r"\s+")) + 128 * (F.col("turn") % 2)).alias("tokens"))


@query("d3_messages", "SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS message FROM conversations GROUP BY 1")
def d3(spark: SparkSession, d: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", F.concat("role", F.lit(": "), "text").alias("m"))))
    return table(spark, d, "conversations", "conv_id", "turn", "role", "text").groupBy("conv_id").agg(F.array_join(turns["m"], "\n").alias("message"))


@query("d4_pad_to_longest", "WITH m AS (SELECT max(turns) AS n FROM (SELECT conv_id, count(*) AS turns FROM conversations GROUP BY 1)) SELECT conv_id, count(*) AS used, (SELECT n FROM m) - count(*) AS padded FROM conversations GROUP BY 1")
def d4(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations", "conv_id").groupBy("conv_id").agg(F.count(F.lit(1)).alias("used"))
    longest = rows.agg(F.max("used").alias("_n"))
    padded = rows.crossJoin(F.broadcast(longest)).withColumn("_ids", F.concat(F.array_repeat(F.lit(1), F.col("used").cast("int")), F.array_repeat(F.lit(0), (F.col("_n") - F.col("used")).cast("int"))))  # one row
    return padded.select("conv_id", "used", F.size(F.filter("_ids", lambda x: x == 0)).cast("long").alias("padded"))


@query("d5_media_validation", "SELECT page_id FROM pages WHERE (length(html) - length(replace(html, '<p', ''))) / 2 <> page_id % 5")
def d5(spark: SparkSession, d: str) -> DataFrame:
    """Items whose placeholder count is not their media count."""
    rows = table(spark, d, "pages", "page_id", "html").where("html IS NOT NULL")
    return rows.where(F.regexp_count("html", F.lit("<p")) != F.col("page_id") % 5).select("page_id")


@query("d7_text_filter", "SELECT doc_id FROM documents WHERE lang IN ('en', 'de') AND text LIKE '%the%'")
def d7(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "lang", "text").where("lang IN ('en', 'de') AND text LIKE '%the%'").select("doc_id")


@query("d8_zero_area", "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_discount * l_tax < 1e-6) AND l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) <= 5)")
def d8(spark: SparkSession, d: str) -> DataFrame:
    """Queries none of whose boxes is empty and that have at most five."""
    flags = table(spark, d, "lineitem", "l_orderkey", "l_discount", "l_tax").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("l_discount") * F.col("l_tax")).alias("least"))
    return flags.where("n <= 5 AND least >= 1e-6").select("l_orderkey")


@query(
    "d10_combined_filter",
    """WITH q AS (SELECT * FROM conversations WHERE role <> 'system' AND length(text) >= 20), ok AS (SELECT conv_id FROM q GROUP BY 1 HAVING min(turn) = (SELECT min(turn) FROM conversations))
    SELECT conv_id, turn, (dense_rank() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS stage FROM q WHERE conv_id IN (SELECT conv_id FROM ok)""",
)
def d10(spark: SparkSession, d: str) -> DataFrame:
    """Kept queries with stages renumbered, of datapoints that keep their first stage."""
    every = table(spark, d, "conversations", "conv_id", "turn", "role", "text")
    kept = every.where("role != 'system' AND length(text) >= 20")
    first = every.agg(F.min("turn").alias("_f"))
    has = kept.groupBy("conv_id").agg(F.min("turn").alias("_m")).crossJoin(F.broadcast(first)).where("_m = _f").select("conv_id")  # one row
    w = Window.partitionBy("conv_id").orderBy("turn")
    return kept.join(has, "conv_id", "left_semi").select("conv_id", "turn", (F.dense_rank().over(w) - 1).alias("stage"))


@query("d11_text_rewrite", "SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN 'visual' ELSE 'a photo of ' || lower(n_name) || '.' END AS phrase FROM nation")
def d11(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation", "n_nationkey", "n_name").select("n_nationkey", F.when(F.col("n_nationkey") % 4 == 0, "visual").otherwise(F.concat(F.lit("a photo of "), F.lower("n_name"), F.lit("."))).alias("phrase"))


@query("d12_query_expansion", "SELECT l_orderkey, l_linenumber, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1)::INT AS qid, round(l_quantity / 50, 4) AS x FROM lineitem")
def d12(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return rows.select("l_orderkey", "l_linenumber", (F.row_number().over(w) - 1).alias("qid"), F.round(F.col("l_quantity") / 50, 4).alias("x"))


@query("d13_static_video", "SELECT n_nationkey, t::INT AS t FROM nation, (SELECT unnest([0, 1, 2, 3]) AS t)")
def d13(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation", "n_nationkey").select("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("t"))


@query("x4_reward_batch", "WITH s AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN NULL ELSE value END AS v FROM events) SELECT event_id, round(coalesce(v, (SELECT min(v) FROM s), 0), 4) AS reward FROM s")
def x4(spark: SparkSession, d: str) -> DataFrame:
    """Rewards that a gate refused take the batch's least finite one, or 0."""
    rows = table(spark, d, "events", "event_id", "event_type", "value").select("event_id", F.when(F.col("event_type") != "purchase", F.col("value")).alias("v"))
    least = rows.agg(F.min("v").alias("_m"))
    return rows.crossJoin(F.broadcast(least)).select("event_id", F.round(F.coalesce("v", "_m", F.lit(0.0)), 4).alias("reward"))  # one row


@query("x8_concat_box", "SELECT o_orderkey, round((o_custkey % 640 + 640) / 1280.0, 4) AS cx, round((o_orderkey % 480) / 480.0, 6) AS cy FROM orders")
def x8(spark: SparkSession, d: str) -> DataFrame:
    """A box of the right image in the coordinates of both side by side."""
    return table(spark, d, "orders", "o_orderkey", "o_custkey").selectExpr("o_orderkey", "round((o_custkey % 640 + 640) / 1280D, 4) AS cx", "round((o_orderkey % 480) / 480D, 6) AS cy")
