"""Text, response and verification queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.functions import answers as A
from lumenfold.operators.repetition import most_repeated

from .registry import query, table


@query("f1_normal_token", "SELECT p_partkey, lower(regexp_replace(trim(p_type), '[\\s_\\-]+', '', 'g')) AS token FROM part")
def f1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part", "p_partkey", "p_type").select("p_partkey", A.normal_token("p_type").alias("token"))


@query("f2_fenced_code", "SELECT event_id, trim(props) AS body FROM events")
def f2(spark: SparkSession, d: str) -> DataFrame:
    """Half the rows are fenced first; either way the body comes out."""
    rows = table(spark, d, "events", "event_id", "props")
    raw = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Sure:\n```json\n"), F.col("props"), F.lit("\n```"))).otherwise(F.col("props"))
    return rows.select("event_id", A.fenced(raw).alias("body"))


@query("f3_tolerant_json", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def f3(spark: SparkSession, d: str) -> DataFrame:
    """The first whole object of a truncated list."""
    rows = table(spark, d, "events", "event_id", "props")
    cut = F.concat(F.lit("["), F.col("props"), F.lit(', {"k": '))
    return rows.select("event_id", F.get_json_object(F.get(A.json_objects(cut), F.lit(0)), "$.k").cast("long").alias("k"))


@query("f4_score_clamp", "SELECT event_id, greatest(0.0, least(1.0, try_cast(event_id / 7000.0 AS DOUBLE))) AS score FROM events")
def f4(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events", "event_id").select("event_id", A.score_01((F.col("event_id") / 7000.0).cast("string")).alias("score"))


@query(
    "f6_attribute_parse",
    """SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '(\\w+)\\s*[:=]\\s*(\\w+)', 1))::BIGINT AS pairs FROM documents""",
)
def f6(spark: SparkSession, d: str) -> DataFrame:
    keys = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"(?U)(\w+)\s*[:=]\s*(\w+)"), 1)
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.size(keys).cast("long").alias("pairs"))


@query(
    "f7_answer_format",
    """WITH t AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN '<think>' || text || '</think><answer>x</answer>' WHEN 1 THEN '<think>' || text || '</think><answer>x</answer><answer>y</answer>' WHEN 2 THEN '<answer>' || text || '</answer>' ELSE text END AS t FROM conversations)
    SELECT conv_id, turn, coalesce(turn % 4 = 0, false) AS ok FROM t""",
)
def f7(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    kind = F.col("turn") % 4
    made = F.when(kind == 0, F.concat(F.lit("<think>"), t, F.lit("</think><answer>x</answer>"))).when(kind == 1, F.concat(F.lit("<think>"), t, F.lit("</think><answer>x</answer><answer>y</answer>")))
    made = made.when(kind == 2, F.concat(F.lit("<answer>"), t, F.lit("</answer>"))).otherwise(t)
    return table(spark, d, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", A.well_formed_answer(made).alias("ok"))


@query("f8_boxed", "SELECT item_id, 'a{' || item_id || '}b' AS answer FROM benchmark")
def f8(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("so \\boxed{1} or \\boxed{a{"), F.col("item_id"), F.lit("}b} holds"))
    return table(spark, d, "benchmark", "item_id").select("item_id", A.boxed(text).alias("answer"))


@query("f9_language_mix", "SELECT doc_id, doc_id % 3 = 0 AND len(regexp_extract_all(coalesce(text, ''), '[a-zA-Z]+')) >= 0 AND false AS mixed FROM documents")
def f9(spark: SparkSession, d: str) -> DataFrame:
    """The driver's texts hold no Chinese, so none is mixed."""
    return table(spark, d, "documents", "doc_id", "text").select("doc_id", F.coalesce(A.mixed_languages("text"), F.lit(False)).alias("mixed"))


@query(
    "f10_repetition",
    """WITH s AS (SELECT doc_id, text[i:i + 9] AS g FROM (SELECT doc_id, text, unnest(range(1, length(text) - 8)) AS i FROM documents))
    SELECT doc_id, max(c)::BIGINT AS most FROM (SELECT doc_id, g, count(*) AS c FROM s GROUP BY 1, 2) GROUP BY 1""",
)
def f10(spark: SparkSession, d: str) -> DataFrame:
    """How often a text's most frequent 10-character window occurs."""
    return most_repeated(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", 10)


@query("f11_template", "SELECT n_nationkey, replace(replace('Is {name} in region {region}? {other}', '{name}', n_name), '{region}', n_regionkey::VARCHAR) AS prompt FROM nation")
def f11(spark: SparkSession, d: str) -> DataFrame:
    """Only the allowed fields of a template are filled in."""
    made = F.replace(F.replace(F.lit("Is {name} in region {region}? {other}"), F.lit("{name}"), F.col("n_name")), F.lit("{region}"), F.col("n_regionkey").cast("string"))
    return table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey").select("n_nationkey", made.alias("prompt"))


@query("f12_edit_similarity", "SELECT a.p_partkey, round(1 - levenshtein(a.p_name, a.p_type) / greatest(length(a.p_name), length(a.p_type))::DOUBLE, 6) AS sim FROM part a")
def f12(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part", "p_partkey", "p_name", "p_type").select("p_partkey", F.round(A.edit_similarity("p_name", "p_type"), 6).alias("sim"))


@query("f13_lcs_ratio")
def f13(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part", "p_partkey", "p_name", "p_type").select("p_partkey", F.round(A.lcs_ratio("p_name", "p_type"), 6).alias("ratio"))


@query(
    "f14_bigram_jaccard",
    """WITH g AS (SELECT p_partkey, list_distinct([p_name[i:i + 1] FOR i IN range(1, length(p_name))]) AS a, list_distinct([p_type[i:i + 1] FOR i IN range(1, length(p_type))]) AS b FROM part)
    SELECT p_partkey, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::DOUBLE, 6) AS sim FROM g""",
)
def f14(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part", "p_partkey", "p_name", "p_type").select("p_partkey", F.round(A.bigram_jaccard(F.col("p_name"), F.col("p_type")), 6).alias("sim"))


@query(
    "f15_text_similarity",
    """WITH s AS (SELECT p_partkey, 1 - levenshtein(p_name, p_type) / greatest(length(p_name), length(p_type))::DOUBLE AS e, least(length(p_name), length(p_type)) / greatest(length(p_name), length(p_type))::DOUBLE AS l FROM part)
    SELECT p_partkey, round(e * CASE WHEN l < 0.5 THEN l ELSE 1.0 END, 6) AS sim FROM s""",
)
def f15(spark: SparkSession, d: str) -> DataFrame:
    """Edit similarity with a penalty for texts of very different length."""
    share = F.least(F.length("p_name"), F.length("p_type")) / F.greatest(F.length("p_name"), F.length("p_type"))
    return table(spark, d, "part", "p_partkey", "p_name", "p_type").select("p_partkey", F.round(A.edit_similarity("p_name", "p_type") * F.when(share < 0.5, share).otherwise(F.lit(1.0)), 6).alias("sim"))


@query(
    "f16_coordinate_similarity",
    """WITH g AS (SELECT l_orderkey, l_linenumber, sqrt((l_quantity - 25) ** 2 + (l_tax * 500 - 10) ** 2) AS g FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(CASE WHEN g <= 20 THEN 1 - 0.2 * g / 20 ELSE greatest(0.0, 1 - g / 50) END, 6) AS sim FROM g""",
)
def f16(spark: SparkSession, d: str) -> DataFrame:
    sim = A.coordinate_similarity(F.col("l_quantity"), F.col("l_tax") * 500, F.lit(25.0), F.lit(10.0))
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_tax").select("l_orderkey", "l_linenumber", F.round(sim, 6).alias("sim"))


@query(
    "f17_action_parse",
    """WITH a AS (SELECT event_id, upper(event_type) || '(box=[[' || (event_id % 1000) || ',' || (user_id % 1000) || ']], text="' || user_id || '")' AS t FROM events)
    SELECT event_id, regexp_extract(t, '^(\\w+)\\(', 1) AS action, regexp_extract(t, '\\[\\[(\\d+),(\\d+)', 1)::INT AS x, regexp_extract(t, '\\[\\[(\\d+),(\\d+)', 2)::INT AS y, regexp_extract(t, 'text="([^"]*)"', 1) AS content FROM a""",
)
def f17(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.upper("event_type"), F.lit("(box=[["), F.col("event_id") % 1000, F.lit(","), F.col("user_id") % 1000, F.lit(']], text="'), F.col("user_id"), F.lit('")'))
    at = r"\[\[(\d+),(\d+)"
    return table(spark, d, "events", "event_id", "event_type", "user_id").withColumn("t", raw).select(
        "event_id", F.regexp_extract("t", r"^(\w+)\(", 1).alias("action"), F.regexp_extract("t", at, 1).cast("int").alias("x"), F.regexp_extract("t", at, 2).cast("int").alias("y"), F.regexp_extract("t", r'text="([^"]*)"', 1).alias("content")
    )


@query("f19_number_equal", "SELECT l_orderkey, l_linenumber, abs(l_extendedprice - round(l_extendedprice, -1)) <= 1e-4 * greatest(abs(round(l_extendedprice, -1)), 1e-12) AS equal FROM lineitem")
def f19(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("l_extendedprice").cast("string"), F.round("l_extendedprice", -1).cast("string")
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice").select("l_orderkey", "l_linenumber", A.number_equal(a, b).alias("equal"))


@query(
    "f20_year_exact",
    """WITH y AS (SELECT o_orderkey, year(o_orderdate) AS y, year(o_orderdate) + (o_orderkey % 3) - 1 AS z FROM orders) SELECT o_orderkey, y = z AS equal FROM y""",
)
def f20(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_orderkey", "o_orderdate").withColumn("_y", F.year("o_orderdate"))
    return rows.select("o_orderkey", A.year_exact((F.col("_y") + F.col("o_orderkey") % 3 - 1).cast("string"), F.col("_y").cast("string")).alias("equal"))


@query("f21_percent_normalise", "SELECT l_orderkey, l_linenumber, round(l_discount * 100) = l_linenumber AS equal FROM lineitem")
def f21(spark: SparkSession, d: str) -> DataFrame:
    a = F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit(" %"))
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_discount").select("l_orderkey", "l_linenumber", A.number_equal(a, F.col("l_linenumber").cast("string")).alias("equal"))


@query("f23_list_equal", "SELECT n_nationkey, n_nationkey % 2 = 0 AS equal FROM nation")
def f23(spark: SparkSession, d: str) -> DataFrame:
    a = F.concat(F.lit("x, "), F.col("n_name"), F.lit(" and z"))
    b = F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("Z; X,"), F.lower("n_name"))).otherwise(F.lit("x; y"))
    return table(spark, d, "nation", "n_nationkey", "n_name").select("n_nationkey", A.list_equal(a, b).alias("equal"))


@query(
    "f27_choice_inference",
    """WITH t AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(coalesce(text, ''), '\\b([B-D])\\b', 1)) AS l FROM conversations) SELECT conv_id, turn, CASE WHEN len(l) = 1 THEN l[1] ELSE 'Z' END AS choice FROM t""",
)
def f27(spark: SparkSession, d: str) -> DataFrame:
    """The only option letter that stands alone in the text, else none."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"\b([B-D])\b"), 1))
    return table(spark, d, "conversations", "conv_id", "turn", "text").withColumn("_l", found).select("conv_id", "turn", F.when(F.size("_l") == 1, F.get("_l", F.lit(0))).otherwise("Z").alias("choice"))


@query("f29_open_to_choice", "SELECT doc_id, coalesce(CASE WHEN quality = 1 THEN 'good' END, 'answer') AS a, CASE WHEN quality = 1 THEN 'B' ELSE 'Other Answers' END AS b FROM labels")
def f29(spark: SparkSession, d: str) -> DataFrame:
    good = F.when(F.col("quality") == 1, "good")
    return table(spark, d, "labels", "doc_id", "quality").select("doc_id", F.coalesce(good, F.lit("answer")).alias("a"), F.when(good.isNull(), "Other Answers").otherwise("B").alias("b"))


@query("f30_view_weight", "SELECT l_orderkey, round(greatest(0.0, 1 - degrees(atan2(abs(avg(l_quantity) - 25), 25)) / 90), 6) AS weight FROM lineitem GROUP BY 1")
def f30(spark: SparkSession, d: str) -> DataFrame:
    off = F.degrees(F.atan2(F.abs(F.avg("l_quantity") - 25), F.lit(25.0)))
    return table(spark, d, "lineitem", "l_orderkey", "l_quantity").groupBy("l_orderkey").agg(F.round(F.greatest(F.lit(0.0), 1 - off / 90), 6).alias("weight"))


@query("f31_stable_colour", "SELECT n_nationkey, ('0x' || substr(md5(n_name), 1, 2))::INT AS b, ('0x' || substr(md5(n_name), 3, 2))::INT AS g, ('0x' || substr(md5(n_name), 5, 2))::INT AS r FROM nation")
def f31(spark: SparkSession, d: str) -> DataFrame:
    part = lambda k: F.conv(F.substring(F.md5("n_name"), k, 2), 16, 10).cast("int")
    return table(spark, d, "nation", "n_nationkey", "n_name").select("n_nationkey", part(1).alias("b"), part(3).alias("g"), part(5).alias("r"))


@query(
    "f32_html_detection",
    """SELECT page_id, coalesce(regexp_matches(html, '(?is)^\\s*(<!doctype\\s+html|<html|<\\?xml)') OR len(regexp_extract_all(html, '(?i)<(div|p|span|a|table|body|head|script|ul|li|h[1-6])\\b')) >= 3, false) AS is_html FROM pages""",
)
def f32(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages", "page_id", "html").select("page_id", A.looks_like_html("html").alias("is_html"))


@query("f33_rle_area", "SELECT o_orderkey, (o_custkey % 7 + o_orderkey % 5)::BIGINT AS area FROM orders")
def f33(spark: SparkSession, d: str) -> DataFrame:
    """Runs decoded to pixels and counted."""
    counts = F.array(F.lit(3), F.col("o_custkey") % 7, F.lit(2), F.col("o_orderkey") % 5)
    return table(spark, d, "orders", "o_orderkey", "o_custkey").select("o_orderkey", F.size(A.rle_pixels(counts)).cast("long").alias("area"))


@query("f34_polygon_area", "SELECT l_orderkey, l_linenumber, round(l_quantity * (l_tax * 100 + 1), 4) AS area FROM lineitem")
def f34(spark: SparkSession, d: str) -> DataFrame:
    w, h, o = F.col("l_quantity"), F.col("l_tax") * 100 + 1, F.lit(0.0)
    return table(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_tax").select("l_orderkey", "l_linenumber", F.round(A.polygon_area(F.array(o, w, w, o), F.array(o, o, h, h)), 4).alias("area"))


@query("f35_box_retarget", "SELECT o_orderkey, round_even((o_orderkey % 700) / 700.0 * 1000, 0)::BIGINT AS x FROM orders")
def f35(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders", "o_orderkey").select("o_orderkey", F.rint((F.col("o_orderkey") % 700) / 700.0 * 1000).cast("long").alias("x"))
