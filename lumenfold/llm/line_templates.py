"""Line de-duplication with a log-template tree.

Everything here is DataFrame functions: no Python touches a row.

* **Masking.**  A line's words that hold a digit are variable fields, ``<*>``, if they
  are at most half of its words; a row of numbers is no template.
* **Tree.**  Lines descend by word count and their first ``depth`` masked words to a
  leaf.  A leaf's consensus template has, at each place, the word that at least half
  of the leaf's lines have there, and ``<*>`` elsewhere.  Lines that agree with it in
  at least ``similarity`` of their words take it as their template; others keep
  their own masked form.  Unlike in a sequential parser the result does not depend
  on the order of lines.
* **Recurrence.**  A template recurs if it stands in at least ``least_documents``
  different surroundings.  Templates that fewer texts hold are a text's own.  A text's
  surroundings are its smallest own template; where less than a fifth of its templates
  are its own, it is a near copy, and they are a template that it shares with others.
  So copies and near copies of one text have the same, and a page that was copied often
  is not mistaken for boilerplate, while a notice on unrelated pages is caught, however
  many lines it has and however many copies there are elsewhere.  Lines of recurring
  templates are dropped everywhere.

Scale: leaves and templates are counted by partial aggregation, distinct counts in
two steps; joins are equi-joins on hashes that AQE may split.  Only leaves that can
recur and hold several masked forms take part in the consensus.

Defined cases: a null text stays null; blank lines are always kept; a document of
only recurring lines becomes empty; a template is judged once per document, however
often it stands there; null ids are ids like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Cuts
from .substring_dedup import keyed

VARIABLE = "<*>"
#: Both sides of these joins grow with the corpus: one plan at every size, and no broadcast.
MERGE = "merge"
SPACE = "[\\x20\\x09-\\x0D]+"


def masked(line: Column) -> Column:
    """Words joined by one space, those with a digit as ``<*>`` unless they are most of the line."""
    flat = F.regexp_replace(F.regexp_replace(line, SPACE, " "), "^ | $", "")
    form = F.regexp_replace(flat, "[^ 0-9]*+[0-9][^ ]*+", VARIABLE)
    few = 2 * F.regexp_count(form, F.lit("<\\*>")) <= F.size(F.split(form, " "))
    return F.when(flat.rlike("[0-9]") & few, form).otherwise(flat)


def parsed_lines(docs: DataFrame, depth: int) -> DataFrame:
    """(_ord, _tkey, _pos, _line, _id, _leaf) of every line that is not blank."""
    lines = F.transform(F.split("_text", "\n"), lambda s, i: F.struct(i.alias("pos"), masked(s).alias("line")))
    one = docs.select("_ord", "_tkey", F.explode(F.filter(lines, lambda x: x["line"] != "")).alias("_x"))
    words = F.split("_line", " ")
    return one.select("_ord", "_tkey", F.col("_x.pos").alias("_pos"), F.col("_x.line").alias("_line")).select(
        "_ord", "_tkey", "_pos", "_line", F.md5("_line").alias("_id"), F.xxhash64(F.size(words), F.slice(words, 1, depth)).alias("_leaf")
    )


def leaf_templates(cuts: Cuts, lines: DataFrame, similarity: float, least: int) -> DataFrame:
    """(_id, _template) of masked forms that take their leaf's consensus template."""
    leaves = lines.groupBy("_leaf").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_a"), F.max("_id").alias("_b"))
    open_leaves = cuts.put("leaves", leaves.where((F.col("_n") >= least) & (F.col("_a") < F.col("_b"))).select("_leaf"))
    forms = cuts.put("forms", lines.join(open_leaves.hint(MERGE), "_leaf").groupBy("_leaf", "_id", "_line").agg(F.count(F.lit(1)).alias("_n")))
    places = forms.select("_leaf", "_n", F.posexplode(F.split("_line", " ")).alias("_p", "_w"))
    votes = places.groupBy("_leaf", "_p", "_w").agg(F.sum("_n").alias("_v"))
    top = votes.groupBy("_leaf", "_p").agg(F.max(F.struct("_v", "_w")).alias("_top"), F.sum("_v").alias("_all"))
    word = F.when(2 * F.col("_top._v") >= F.col("_all"), F.col("_top._w")).otherwise(F.lit(VARIABLE))
    consensus = top.groupBy("_leaf").agg(F.array_sort(F.collect_list(F.struct("_p", word.alias("_w")))).alias("_c"))
    joined = forms.join(cuts.put("consensus", consensus.select("_leaf", F.col("_c._w").alias("_c"))).hint(MERGE), "_leaf")
    own = F.split("_line", " ")
    same = F.size(F.filter(F.zip_with(own, "_c", lambda a, b: (a == b) & (a != VARIABLE)), lambda x: x))
    alike = joined.where(same >= similarity * F.size("_c"))
    return alike.select("_id", F.md5(F.array_join("_c", " ")).alias("_template"))


def recurring_lines(cuts: Cuts, docs: DataFrame, depth: int, similarity: float, least_documents: int) -> DataFrame:
    """(_ord, _tkey, _drop): the line numbers that each document loses."""
    lines = cuts.put("lines", parsed_lines(docs, depth))
    templates = cuts.put("templates", leaf_templates(cuts, lines, similarity, least_documents))
    known = lines.select("_ord", "_tkey", "_pos", "_id").join(templates.hint(MERGE), "_id", "left")
    known = cuts.put("known", known.select("_ord", "_tkey", "_pos", F.coalesce("_template", "_id").alias("_template")))
    cuts.drop("lines", "leaves", "forms", "consensus", "templates")
    held = cuts.put("held", known.select("_tkey", "_template").distinct())
    common = held.groupBy("_template").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least_documents)
    common = cuts.put("common", common.select("_template", F.lit(True).alias("_common")))
    told = cuts.put("told", held.join(common.hint(MERGE), "_template", "left").select("_tkey", "_template", F.coalesce("_common", F.lit(False)).alias("_common")))
    own, others = F.when(~F.col("_common"), F.col("_template")), F.when(F.col("_common"), F.col("_template"))
    around = told.groupBy("_tkey").agg(F.count(F.lit(1)).alias("_all"), F.count(own).alias("_few"), F.min(own).alias("_own"), F.min(others).alias("_least"), F.max(others).alias("_most"))
    around = cuts.put("around", around.where("_least IS NOT NULL"))
    sig = F.when((F.col("_few") > 0) & (5 * F.col("_few") >= F.col("_all")), F.col("_own")).when(F.col("_template") != F.col("_least"), F.col("_least")).otherwise(F.col("_most"))
    sigs = told.where("_common").join(around.hint(MERGE), "_tkey").select("_template", sig.alias("_sig")).distinct()
    counts = sigs.groupBy("_template").agg(F.count(F.lit(1)).alias("_sigs"))
    often = cuts.put("often", counts.where(F.col("_sigs") >= least_documents).select("_template"))
    cuts.drop("held", "common", "told", "around")
    found = cuts.put("drops", known.join(often.hint(MERGE), "_template").groupBy("_ord", "_tkey").agg(F.array_sort(F.collect_set("_pos")).alias("_drop")))
    cuts.drop("known", "often")
    return found


def dedup_lines(
    documents: DataFrame, depth: int = 3, similarity: float = 0.6, least_documents: int = 10, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``documents`` with recurring lines taken out of the text, and n_lines and n_dropped."""
    cuts = Cuts(documents.sparkSession, "lines")
    drops = recurring_lines(cuts, keyed(documents, id_col, text_col), depth, similarity, least_documents)
    names = [f"_c{k}" for k in range(len(documents.columns))]
    rows = documents.toDF(*names)
    text, ident = names[documents.columns.index(text_col)], names[documents.columns.index(id_col)]
    rows = keyed(rows, ident, text, *(F.col(c) for c in names)).drop("_text").join(drops.hint(MERGE), ["_ord", "_tkey"], "left")
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda s, i: ~F.array_contains("_drop", i))
    left = F.when(F.col("_drop").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    out = rows.select(
        *(left.alias(c) if c == text else F.col(c) for c in names),
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("_lines"),
        F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("_dropped"),
    )
    return out.toDF(*documents.columns, "n_lines", "n_dropped")
