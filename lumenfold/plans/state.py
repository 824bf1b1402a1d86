"""Frame-ordered stateful processing, as batch folds over ordered events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .registry import query, table

_ORDER = "PARTITION BY user_id ORDER BY ts, event_id"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value")


@query(
    "t1_hotstart",
    f"""WITH f AS (SELECT *, row_number() OVER ({_ORDER}) AS frame, event_type <> 'click' AS matched FROM events),
    s AS (SELECT user_id, min(frame) AS first_seen, sum((NOT matched AND frame <= 20)::INT) AS misses FROM f GROUP BY 1) SELECT user_id, first_seen, misses::BIGINT AS misses, misses >= 8 AS removed FROM s""",
)
def t1(spark: SparkSession, d: str) -> DataFrame:
    """Objects with too many unmatched frames within the delay window are removed."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = _events(spark, d).withColumns({"frame": F.row_number().over(w), "matched": F.col("event_type") != "click"})
    found = rows.groupBy("user_id").agg(F.min("frame").cast("long").alias("first_seen"), F.sum((~F.col("matched") & (F.col("frame") <= 20)).cast("long")).alias("misses"))
    return found.withColumn("removed", F.col("misses") >= 8)


@query(
    "t2_confirmation",
    f"""WITH f AS (SELECT *, (event_type <> 'click')::INT AS m, row_number() OVER w AS k FROM events WINDOW w AS ({_ORDER})), g AS (SELECT *, sum(1 - m) OVER ({_ORDER}) AS island FROM f),
    c AS (SELECT *, sum(m) OVER (PARTITION BY user_id, island ORDER BY k) AS streak FROM g) SELECT user_id, event_id, streak::BIGINT AS streak, max(streak) OVER (PARTITION BY user_id ORDER BY k) >= 3 AS confirmed FROM c""",
)
def t2(spark: SparkSession, d: str) -> DataFrame:
    """Streaks of matched frames; a streak of three confirms for good."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = _events(spark, d).withColumns({"m": (F.col("event_type") != "click").cast("long"), "k": F.row_number().over(w)})
    rows = rows.withColumn("island", F.sum(1 - F.col("m")).over(w))
    rows = rows.withColumn("streak", F.sum("m").over(Window.partitionBy("user_id", "island").orderBy("k")))
    return rows.select("user_id", "event_id", "streak", (F.max("streak").over(Window.partitionBy("user_id").orderBy("k")) >= 3).alias("confirmed"))


@query(
    "t3_recently_occluded",
    """WITH s AS (SELECT DISTINCT l_suppkey AS g, l_partkey AS i FROM lineitem), n AS (SELECT g, count(*) AS n FROM s GROUP BY 1), p AS (SELECT x.g AS a, y.g AS b, count(*) AS c FROM s x JOIN s y ON x.i = y.i AND x.g < y.g GROUP BY 1, 2),
    o AS (SELECT a, b, a % 6 - 1 AS la, b % 6 - 1 AS lb FROM p JOIN n n1 ON a = n1.g JOIN n n2 ON b = n2.g WHERE c / (n1.n + n2.n - c)::DOUBLE >= 0.17)
    SELECT DISTINCT CASE WHEN la > lb AND lb > -1 THEN a ELSE b END AS suppressed FROM o WHERE (la > lb AND lb > -1) OR (lb > la AND la > -1)""",
)
def t3(spark: SparkSession, d: str) -> DataFrame:
    """Of two overlapping objects the one occluded last goes, if the other was ever occluded."""
    from lumenfold.operators import spatial as S

    pairs = S.set_overlaps(table(spark, d, "lineitem", "l_suppkey", "l_partkey"), "l_suppkey", "l_partkey").where(S.iou() >= 0.17)
    la, lb = F.col("a") % 6 - 1, F.col("b") % 6 - 1
    gone = F.when((la > lb) & (lb > -1), F.col("a")).when((lb > la) & (la > -1), F.col("b"))
    return pairs.select(gone.alias("suppressed")).where("suppressed IS NOT NULL").distinct()


@query("t4_boundary_filter", "SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS k FROM lineitem WHERE l_quantity / 50 BETWEEN 0.025 AND 0.975) WHERE k <= 3")
def t4(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber", "l_partkey")
    rows = table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_partkey").where("l_quantity / 50 BETWEEN 0.025 AND 0.975")
    return rows.withColumn("_k", F.row_number().over(w)).where("_k <= 3").select("l_orderkey", "l_linenumber")


@query("t5_delayed_output", f"SELECT user_id, event_id FROM (SELECT *, row_number() OVER ({_ORDER}) AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE n - k >= 5")
def t5(spark: SparkSession, d: str) -> DataFrame:
    """Frames whose delay of five frames has passed."""
    w = Window.partitionBy("user_id")
    rows = _events(spark, d).withColumns({"k": F.row_number().over(w.orderBy("ts", "event_id")), "n": F.count(F.lit(1)).over(w)})
    return rows.where("n - k >= 5").select("user_id", "event_id")


@query("t6_session_registry", "SELECT user_id, count(*) AS requests, max_by(event_type, event_id) AS last_request FROM events GROUP BY 1")
def t6(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d).groupBy("user_id").agg(F.count(F.lit(1)).alias("requests"), F.max(F.struct("event_id", "event_type"))["event_type"].alias("last_request"))


@query(
    "t7_streaming_html",
    """WITH b AS (SELECT page_id, substr(html, 1, 50) AS head, html FROM pages WHERE html IS NOT NULL) SELECT page_id, regexp_matches(head, '(?is)^\\s*(<!doctype\\s+html|<html|<\\?xml)') AS html_at_prefix, length(html)::BIGINT AS n FROM b""",
)
def t7(spark: SparkSession, d: str) -> DataFrame:
    """Pages cut into chunks of ten and put together again: the decision falls on the first five."""
    pages = table(spark, d, "pages", "page_id", "html").where("html IS NOT NULL")
    chunks = pages.select("page_id", F.posexplode(F.expr("transform(sequence(1, greatest(length(html), 1), 10), i -> substring(html, i, 10))")).alias("k", "c"))
    head = F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") < 5, F.struct("k", "c"))))["c"], "")
    folded = chunks.groupBy("page_id").agg(head.alias("head"), F.sum(F.length("c")).alias("n"))
    return folded.select("page_id", F.regexp_like("head", F.lit(r"(?is)^\s*(<!doctype\s+html|<html|<\?xml)")).alias("html_at_prefix"), "n")


@query(
    "t8_conditioning_frames",
    """WITH f AS (SELECT conv_id, turn, abs(turn - 3) AS gap FROM conversations), r AS (SELECT conv_id, turn, (turn = max(turn) FILTER (turn < 3) OVER (PARTITION BY conv_id))::INT AS before, (turn = min(turn) FILTER (turn >= 3) OVER (PARTITION BY conv_id))::INT AS after, gap FROM f)
    SELECT conv_id, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY greatest(coalesce(before, 0), coalesce(after, 0)) DESC, gap, turn) AS k FROM r) WHERE k <= 3""",
)
def t8(spark: SparkSession, d: str) -> DataFrame:
    """Of each clip the nearest frame before, the nearest at or after, then by distance, three in all."""
    w = Window.partitionBy("conv_id")
    rows = table(spark, d, "conversations", "conv_id", "turn")
    before = F.col("turn") == F.max(F.when(F.col("turn") < 3, F.col("turn"))).over(w)
    after = F.col("turn") == F.min(F.when(F.col("turn") >= 3, F.col("turn"))).over(w)
    must = F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))
    rows = rows.withColumns({"_must": must, "_gap": F.abs(F.col("turn") - 3)})
    return rows.withColumn("_k", F.row_number().over(w.orderBy(F.desc("_must"), "_gap", "turn"))).where("_k <= 3").select("conv_id", "turn")


@query(
    "t9_message_pruning",
    """WITH m AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos FROM conversations), l AS (SELECT *, max(CASE WHEN role = 'assistant' THEN pos END) OVER (PARTITION BY conv_id) AS latest FROM m) SELECT conv_id, turn FROM l WHERE pos < 2 OR pos >= latest""",
)
def t9(spark: SparkSession, d: str) -> DataFrame:
    """The first two messages, and the latest assistant message with all that follow."""
    w = Window.partitionBy("conv_id")
    rows = table(spark, d, "conversations", "conv_id", "turn", "role").withColumn("pos", F.row_number().over(w.orderBy("turn")) - 1)
    rows = rows.withColumn("latest", F.max(F.when(F.col("role") == "assistant", F.col("pos"))).over(w))
    return rows.where("pos < 2 OR pos >= latest").select("conv_id", "turn")
