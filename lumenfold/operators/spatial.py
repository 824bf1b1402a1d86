"""Spatial joins on a grid, pair overlaps, components and density clusters."""

from __future__ import annotations

import math
import tempfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Places of a grid cell, on average over places, up to which ``nearest`` needs no finer one.
CELL = 8


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut in the folder of spark.checkpoint.dir, which executors share."""
    spark: SparkSession = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        found = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="lumenfold-")
        spark.sparkContext.setCheckpointDir(found)
    return df.checkpoint(eager=True)


def _cells(df: DataFrame, axes: list[str], size: float, spread: bool) -> DataFrame:
    """Adds _g0, _g1, ...: each row's grid cell or, spread, that and all cells around it."""
    for k, a in enumerate(axes):
        own = F.floor(F.col(a) / size)
        df = df.withColumn(f"_g{k}", F.explode(F.array(own - 1, own, own + 1)) if spread else own)
    return df


def within_radius(left: DataFrame, right: DataFrame, axes: list[str], radius: float, on: list[str] | None = None) -> DataFrame:
    """All (left, right) rows at most ``radius`` apart, with their squared distance ``dist2``.

    Both sides have the columns ``axes``; the right's come back with the prefix ``r_``.  An equi-join on grid cells of ``radius``: a left row
    meets the cells around its own, 3 ** len(axes) of them.
    """
    on = on or []
    a = _cells(left, axes, radius, spread=True)
    b = _cells(right, axes, radius, spread=False)
    b = b.select(*on, *(c for c in b.columns if c.startswith("_g")), *(F.col(c).alias(f"r_{c}") for c in right.columns if c not in on))
    joined = a.join(b, [*on, *(f"_g{k}" for k in range(len(axes)))])
    dist2 = sum(((F.col(x) - F.col(f"r_{x}")) ** 2 for x in axes), F.lit(0.0))
    return joined.withColumn("dist2", dist2).where(F.col("dist2") <= radius * radius).drop(*(f"_g{k}" for k in range(len(axes))))


def nearest(left: DataFrame, right: DataFrame, axes: list[str], ident: str, right_ident: str, bound: float) -> DataFrame:
    """(ident, right_ident, dist2): the nearest right row within ``bound``, lowest id on ties.

    Rows at the same place are one.  Where places are dense the reach starts at a fraction of ``bound``, so that a cell
    holds a few of them, and doubles for the places that have found none.
    """
    places = checkpointed(left.select(*axes).distinct())
    sites = checkpointed(right.groupBy(*axes).agg(F.min(right_ident).alias(right_ident)))
    filled = sites.groupBy(*(F.floor(F.col(a) / bound) for a in axes)).agg(F.count(F.lit(1)).alias("n"))
    crowd = filled.agg(F.sum(F.col("n") * F.col("n")) / F.sum("n")).first()[0] or 0
    halvings = max(0, math.ceil(math.log2(max(crowd, 1) / CELL) / len(axes)))
    found = []
    for k in range(halvings, -1, -1):
        reach = bound / 2**k
        best = within_radius(places, sites, axes, reach).groupBy(*axes).agg(F.min(F.struct("dist2", F.col(f"r_{right_ident}").alias("who"))).alias("_b"))
        if k:  # a rounded cell may hide what lies just at the reach
            best = best.where(F.col("_b.dist2") < reach * reach * (1 - 1e-9))
        best = checkpointed(best)
        found.append(best)
        if k:
            places = checkpointed(places.join(best, axes, "left_anti"))
    rows = left.select(ident, *axes).join(reduce(DataFrame.unionByName, found), axes)
    return rows.groupBy(ident).agg(F.min("_b").alias("_b")).select(ident, F.col("_b.who").alias(right_ident), F.col("_b.dist2").alias("dist2"))


def set_overlaps(members: DataFrame, group: str, item: str) -> DataFrame:
    """(a, b, inter, size_a, size_b) of all pairs a < b of groups that share an item.

    The equi-join on items makes a row for each shared item of each pair: it follows
    the overlaps, not the number of pairs.
    """
    rows = members.select(F.col(group).alias("a"), item).distinct()
    sizes = rows.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
    pairs = rows.join(rows.withColumnRenamed("a", "b"), item).where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("inter"))
    return pairs.join(sizes.withColumnRenamed("n", "size_a"), "a").join(sizes.select(F.col("a").alias("b"), F.col("n").alias("size_b")), "b")


def iou() -> Column:
    return F.col("inter") / (F.col("size_a") + F.col("size_b") - F.col("inter"))


def iom() -> Column:
    return F.col("inter") / F.least("size_a", "size_b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) is connected with.

    Labels flow to neighbours and then to the labels' own labels, which halves the
    paths left in every round.
    """
    both = checkpointed(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        moved = labels.join(seen, "node").select("node", "root", F.least("root", "near").alias("next"))
        jumped = moved.join(labels.select(F.col("node").alias("next"), F.col("root").alias("far")), "next").select("node", "root", F.least("next", "far").alias("next"))
        jumped = checkpointed(jumped)
        labels = jumped.select("node", F.col("next").alias("root"))
        if jumped.where("root != next").isEmpty():
            return labels


def dbscan(points: DataFrame, axes: list[str], ident: str, eps: float, least: int) -> DataFrame:
    """(ident, cluster): density clusters, the distance included and a point its own neighbour; noise is -1.

    A cluster is named by its smallest core point; a border point joins the cluster of
    smallest name among its core neighbours.
    """
    rows = points.select(ident, *axes)
    pairs = checkpointed(within_radius(rows, rows, axes, eps).select(ident, F.col(f"r_{ident}").alias("other")))
    core = checkpointed(pairs.groupBy(ident).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select(ident))
    from_core = pairs.join(core, ident)
    edges = from_core.join(core.select(F.col(ident).alias("other")), "other").where(F.col(ident) <= F.col("other")).select(F.col(ident).alias("a"), F.col("other").alias("b"))
    roots = components(edges).select(F.col("node").alias(ident), F.col("root").alias("cluster"))
    reached = from_core.join(roots, ident).groupBy(F.col("other").alias(ident)).agg(F.min("cluster").alias("border"))
    found = rows.select(ident).join(roots, ident, "left").join(reached, ident, "left")
    return found.select(ident, F.coalesce("cluster", "border", F.lit(-1)).alias("cluster"))


def ranked_clusters(clusters: DataFrame, ident: str) -> DataFrame:
    """(cluster, position, size): clusters by falling size, then first member; noise has none."""
    sizes = clusters.where("cluster != -1").groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), F.min(ident).alias("_f"))
    return sizes.select("cluster", (F.row_number().over(Window.orderBy(F.desc("size"), "_f")) - 1).alias("position"), "size")


def overlapping_intervals(intervals: DataFrame, start: str, end: str, moments: DataFrame, at: str, width: float) -> DataFrame:
    """Rows of ``intervals`` that hold a moment strictly inside, each once.

    Both sides are bucketed by ``width``; an interval meets the buckets that it spans.
    """
    spans = intervals.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    found = moments.select(F.col(at).alias("_t"), F.floor(F.col(at) / width).alias("_bucket")).distinct()
    joined = spans.join(found, "_bucket").where((F.col(start) < F.col("_t")) & (F.col("_t") < F.col(end)))
    return joined.select(*intervals.columns).distinct()
