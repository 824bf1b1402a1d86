"""The opN_ queries: each applies one operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import find_contamination, n_hit
from .langid import held_out, identify_language, learn_dictionaries
from .line_templates import dedup_lines
from .order_minhash import near_duplicates
from .packing import pack
from .quality import quality_verdicts
from .store import Cuts
from .substring_dedup import substring_dedup
from .suffix_dedup import suffix_dedup
from .toxicity import fit, match_clauses, training_sample
from .url_filter import Rules, fit_url_model, judge_urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), window=50).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50
), keyed AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS k FROM win
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(50)) AS i
  FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS lo FROM keyed) WHERE lo < doc_id
), words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS word FROM d
), kept AS (
  SELECT w.doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY i) AS t
  FROM words w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


#: The URL rules.
URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, rules = table(spark, sf_dir, "pages"), Rules(URL_RULES)
    return judge_urls(pages, rules, fit_url_model(pages, rules))


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), capacity=2048, closing=0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    seen = labels.where(~held_out("doc_id", 5, 0))
    sample = Cuts(spark, "toxicity").put("sample", training_sample(documents, seen))
    scored = match_clauses(documents, fit(sample))
    return scored.select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "insult", "targeted", "threat", "negated", "reported"
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), m AS (
  SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS c FROM (SELECT doc_id, i + unnest(range(n)) AS p FROM m) GROUP BY doc_id
), it AS (
  SELECT doc_id, count(*) AS c, string_agg(s, ',' ORDER BY s) AS l FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM m) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(hit.c, 0)::BIGINT AS n_hit, coalesce(it.c, 0)::BIGINT AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(hit.c, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


#: The sketches hold up to 4096 values of a group exactly, as here.
OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS l FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, i + unnest(range(8)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1
  ) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(l) AS lines
  FROM d LEFT JOIN rep USING (doc_id)
), v AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         word_chars / nullif(n_words, 0)::DOUBLE AS a, n_symbols / nullif(word_chars, 0)::DOUBLE AS b, n_dup_lines / (lines + 5)::DOUBLE AS c FROM m
), s AS (
  SELECT lang, source, count(*) AS n, list_sort(list(a)) AS a, list_sort(list(b)) AS b, list_sort(list(c)) AS c FROM v WHERE NOT base_failed GROUP BY lang, source
), g AS (
  SELECT lang, list_sort(list(a)) AS a, list_sort(list(b)) AS b, list_sort(list(c)) AS c FROM v WHERE NOT base_failed GROUP BY lang
), u AS (
  SELECT s.lang, s.source, CASE WHEN n >= 30 THEN s.a ELSE g.a END AS a, CASE WHEN n >= 30 THEN s.b ELSE g.b END AS b, CASE WHEN n >= 30 THEN s.c ELSE g.c END AS c
  FROM s JOIN g ON s.lang IS NOT DISTINCT FROM g.lang
), q AS (
  SELECT lang, source, a[ceil(0.25 * len(a))::INT] AS a1, a[ceil(0.75 * len(a))::INT] AS a3, b[ceil(0.25 * len(b))::INT] AS b1,
         b[ceil(0.75 * len(b))::INT] AS b3, c[ceil(0.25 * len(c))::INT] AS c1, c[ceil(0.75 * len(c))::INT] AS c3 FROM u
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(a >= a1 - (3.0::DOUBLE * (a3 - a1) + 1.0::DOUBLE) AND a <= a3 + (3.0::DOUBLE * (a3 - a1) + 1.0::DOUBLE)
         AND b >= b1 - (3.0::DOUBLE * (b3 - b1) + 0.02::DOUBLE) AND b <= b3 + (3.0::DOUBLE * (b3 - b1) + 0.02::DOUBLE)
         AND c >= c1 - (3.0::DOUBLE * (c3 - c1) + 0.2::DOUBLE) AND c <= c3 + (3.0::DOUBLE * (c3 - c1) + 0.2::DOUBLE), false) AS kept
FROM v LEFT JOIN q ON v.lang IS NOT DISTINCT FROM q.lang AND v.source IS NOT DISTINCT FROM q.source
"""


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


OP9_SQL = r"""
WITH raw AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l0 AS (SELECT doc_id, md5(text) AS tkey, unnest(ls) AS s, generate_subscripts(ls, 1) AS pos FROM raw),
f AS (
  SELECT *, regexp_replace(flat, '[^ 0-9]*[0-9][^ ]*', '<*>', 'g') AS form
  FROM (SELECT *, trim(regexp_replace(s, '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS flat FROM l0)
), l1 AS (
  SELECT doc_id, tkey, pos, s, CASE WHEN 2 * len(regexp_extract_all(form, '<\*>')) <= len(string_split(form, ' ')) THEN form ELSE flat END AS line FROM f
), l AS (SELECT *, md5(line) AS id, string_split(line, ' ') AS w FROM l1 WHERE line <> ''),
n AS (SELECT *, len(w) || '|' || array_to_string(w[1:3], ' ') AS leaf FROM l),
leaves AS (SELECT leaf FROM n GROUP BY leaf HAVING count(*) >= 10 AND min(id) < max(id)),
forms AS (SELECT leaf, id, w, count(*) AS c FROM n JOIN leaves USING (leaf) GROUP BY leaf, id, w),
votes AS (SELECT leaf, p, x, sum(c) AS v FROM (SELECT leaf, c, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM forms) GROUP BY leaf, p, x),
top AS (
  SELECT leaf, p, CASE WHEN 2 * v >= total THEN x ELSE '<*>' END AS x
  FROM (SELECT *, sum(v) OVER (PARTITION BY leaf, p) AS total, row_number() OVER (PARTITION BY leaf, p ORDER BY v DESC, x DESC) AS r FROM votes) WHERE r = 1
), cons AS (SELECT leaf, list(x ORDER BY p) AS k FROM top GROUP BY leaf),
temp AS (
  SELECT id, md5(array_to_string(k, ' ')) AS t FROM forms JOIN cons USING (leaf)
  WHERE len(list_filter(range(1, len(w) + 1), lambda i: w[i] = k[i] AND w[i] <> '<*>')) >= 0.6 * len(k)
), known AS (SELECT doc_id, tkey, pos, coalesce(t, n.id) AS t FROM n LEFT JOIN temp ON n.id = temp.id),
held AS (SELECT DISTINCT tkey, t FROM known),
told AS (SELECT tkey, t, count(*) OVER (PARTITION BY t) >= 10 AS common FROM held),
around AS (
  SELECT tkey, count(*) AS n, count(*) FILTER (NOT common) AS few, min(t) FILTER (NOT common) AS own, min(t) FILTER (common) AS lo, max(t) FILTER (common) AS hi
  FROM told GROUP BY tkey
), sigs AS (
  SELECT DISTINCT t, CASE WHEN few > 0 AND 5 * few >= n THEN own WHEN t <> lo THEN lo ELSE hi END AS sig FROM told JOIN around USING (tkey) WHERE common
), often AS (SELECT t FROM sigs GROUP BY t HAVING count(*) >= 10),
gone AS (SELECT DISTINCT doc_id, pos FROM known JOIN often USING (t)),
kept AS (
  SELECT l0.doc_id, string_agg(s, chr(10) ORDER BY l0.pos) AS text FROM l0 ANTI JOIN gone ON l0.doc_id = gone.doc_id AND l0.pos = gone.pos GROUP BY l0.doc_id
), lost AS (SELECT doc_id, count(*) AS c FROM gone GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(lost.c, 0)::BIGINT AS n_dropped,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    dictionaries = learn_dictionaries(documents.where(~held_out("doc_id", 4, 2)))
    found = identify_language(documents, dictionaries)
    return found.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), F.col("best").alias("lang_pred"), "score", "margin", (F.col("lang") == "und").alias("rejected"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), length=100).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_url_filter": op2_url_filter,
        "op3_order_minhash": op3_order_minhash,
        "op4_best_fit_packing": op4_best_fit_packing,
        "op5_toxicity": op5_toxicity,
        "op6_decontamination": op6_decontamination,
        "op7_quality_rules": op7_quality_rules,
        "op8_suffix_dedup": op8_suffix_dedup,
        "op9_line_dedup": op9_line_dedup,
        "op10_language_id": op10_language_id,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1_SQL,
        "op6_decontamination": OP6_SQL,
        "op7_quality_rules": OP7_SQL,
        "op9_line_dedup": OP9_SQL,
    }
