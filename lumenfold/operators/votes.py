"""Votes, label aggregates and confusion tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def best_by(score: str | Column, ident: str | Column) -> Column:
    """Aggregate: the struct (score, -ident) of the largest score, lowest id on ties."""
    score = F.col(score) if isinstance(score, str) else score
    ident = F.col(ident) if isinstance(ident, str) else ident
    return F.max(F.struct(score.alias("score"), (-ident).alias("minus")))


def weighted_vote(rows: DataFrame, point: str, instance: str, score: str) -> DataFrame:
    """(point, instance, confidence): the instance of largest summed score; scores of 0 or less do not vote.

    Two partial aggregations; a hot point combines before either shuffle.
    """
    votes = rows.where(F.col(score) > 0).groupBy(point, instance).agg(F.sum(score).alias("_v"))
    best = votes.groupBy(point).agg(best_by("_v", instance).alias("_b"), F.sum("_v").alias("_t"))
    return best.select(point, (-F.col("_b.minus")).alias(instance), (F.col("_b.score") / F.col("_t")).alias("confidence"))


def merged_instances(members: DataFrame, group: str, point: str, label: str, score: str, least_points: int) -> DataFrame:
    """Distinct points, summed class scores, arg-max label (lowest on ties) and its share, of groups with enough points."""
    points = members.groupBy(group).agg(F.countDistinct(point).alias("n_points")).where(F.col("n_points") >= least_points)
    scores = members.groupBy(group, label).agg(F.sum(score).alias("_s"))
    best = scores.groupBy(group).agg(best_by("_s", label).alias("_b"), F.sum("_s").alias("_t"))
    return points.join(best, group).select(group, "n_points", (-F.col("_b.minus")).alias(label), (F.col("_b.score") / F.col("_t")).alias("confidence"))


def majority_label(rows: DataFrame, group: str, label: str, position: str) -> DataFrame:
    """(group, label): the most frequent label, the one seen first on ties."""
    counts = rows.groupBy(group, label).agg(F.count(F.lit(1)).alias("_n"), F.min(position).alias("_p"))
    best = counts.groupBy(group).agg(F.max(F.struct("_n", (-F.col("_p")).alias("_m"), label)).alias("_b"))
    return best.select(group, F.col(f"_b.{label}").alias(label))


def confusion(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, n, permille): cell counts and their share of all rows in thousandths, rounded up."""
    cells = rows.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n").alias("_t"))
    return cells.crossJoin(F.broadcast(total)).select(truth, predicted, "n", F.ceil(F.col("n") * 1000 / F.col("_t")).alias("permille"))  # one row


def accuracy_report(rows: DataFrame, group: str, hit: str) -> DataFrame:
    """(group, n, accuracy) with a row ``Overall``, from one scan."""
    found = rows.rollup(group).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(hit).cast("double")).alias("accuracy"), F.grouping(group).alias("_all"))
    return found.select(F.when(F.col("_all") == 1, "Overall").otherwise(F.col(group)).alias(group), "n", "accuracy")


def densify(rows: DataFrame, ident: str) -> DataFrame:
    """``rows`` with ids renumbered 0, 1, ... in their order; ids are ranked as a small distinct table."""
    ids = rows.select(ident).where(F.col(ident).isNotNull()).distinct()
    ranked = ids.withColumn("_dense", F.row_number().over(Window.orderBy(ident)) - 1)
    return rows.join(ranked, ident, "left").drop(ident).withColumnRenamed("_dense", ident)


def largest_kept(rows: DataFrame, group: str, cluster: str, point: str, least: int) -> DataFrame:
    """Each group's largest cluster (lowest first point on ties) if it has ``least`` points."""
    sizes = rows.groupBy(group, cluster).agg(F.count(F.lit(1)).alias("_n"), F.min(point).alias("_f"))
    best = sizes.groupBy(group).agg(F.max(F.struct("_n", (-F.col("_f")).alias("_m"), cluster)).alias("_b"))
    keep = best.where(F.col("_b._n") >= least).select(group, F.col(f"_b.{cluster}").alias(cluster))
    return rows.join(keep, [group, cluster], "left_semi")


def cluster_order(sizes: DataFrame, size: str, first: str) -> Column:
    """Rank of clusters from 0 by falling size, then rising first id."""
    return F.row_number().over(Window.orderBy(F.desc(size), F.asc(first))) - 1
