"""Component and density-cluster queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.operators import geometry as G
from lumenfold.operators import spatial as S

from .registry import query, table

_EDGES = "SELECT o_custkey AS a, o_custkey // 10 * 10 + min(o_orderkey) % 12 AS b FROM orders GROUP BY o_custkey"
_LABELS = """both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e), reach(node, seen) AS (SELECT a, a FROM both_ways UNION SELECT r.node, b FROM reach r JOIN both_ways ON r.seen = a)"""


def _edges(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders", "o_orderkey", "o_custkey")
    return rows.groupBy(F.col("o_custkey").alias("a")).agg(F.min("o_orderkey").alias("_o")).selectExpr("a", "a div 10 * 10 + _o % 12 AS b")


@query("a1_components", f"WITH RECURSIVE e AS ({_EDGES}), {_LABELS} SELECT node, min(seen) AS root FROM reach GROUP BY 1")
def a1(spark: SparkSession, d: str) -> DataFrame:
    return S.components(_edges(spark, d))


@query(
    "g8_merge_junctions",
    f"""WITH RECURSIVE e AS ({_EDGES}), {_LABELS}, r AS (SELECT node, min(seen) AS root FROM reach GROUP BY 1)
    SELECT root, count(*) AS n_nodes, round(avg(c_acctbal), 6) AS position FROM r JOIN customer ON node = c_custkey GROUP BY 1""",
)
def g8(spark: SparkSession, d: str) -> DataFrame:
    """Near junctions as one, at their mean position."""
    merged = S.components(_edges(spark, d)).join(table(spark, d, "customer", "c_custkey", "c_acctbal"), F.expr("node = c_custkey"))
    return merged.groupBy("root").agg(F.count(F.lit(1)).alias("n_nodes"), F.round(F.avg("c_acctbal"), 6).alias("position"))


_PTS = "SELECT s_suppkey AS id, s_acctbal / 200 AS x, s_nationkey * 1.0 AS y FROM supplier"


def _points(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier", "s_suppkey", "s_acctbal", "s_nationkey").selectExpr("s_suppkey AS id", "s_acctbal / 200 AS x", "s_nationkey * 1.0D AS y")


_DBSCAN = f"""WITH RECURSIVE p AS ({_PTS}), n AS (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON (a.x - b.x) ** 2 + (a.y - b.y) ** 2 <= 9.0),
core AS (SELECT a FROM n GROUP BY a HAVING count(*) >= 4), ce AS (SELECT n.a, n.b FROM n JOIN core c1 ON n.a = c1.a JOIN core c2 ON n.b = c2.a),
reach(node, seen) AS (SELECT a, a FROM core UNION SELECT r.node, ce.b FROM reach r JOIN ce ON r.seen = ce.a), roots AS (SELECT node, min(seen) AS root FROM reach GROUP BY 1),
border AS (SELECT n.b AS id, min(root) AS root FROM n JOIN roots ON n.a = roots.node GROUP BY 1),
c AS (SELECT p.id, coalesce(roots.root, border.root, -1) AS cluster FROM p LEFT JOIN roots ON p.id = roots.node LEFT JOIN border ON p.id = border.id)"""


@query("a7_dbscan", _DBSCAN + " SELECT id, cluster FROM c")
def a7(spark: SparkSession, d: str) -> DataFrame:
    return S.dbscan(_points(spark, d), ["x", "y"], "id", 3.0, 4)


@query("a7_cluster_order", _DBSCAN + ", s AS (SELECT cluster, count(*) AS size, min(id) AS f FROM c WHERE cluster <> -1 GROUP BY 1) SELECT cluster, (row_number() OVER (ORDER BY size DESC, f) - 1)::INT AS position, size FROM s")
def a7_order(spark: SparkSession, d: str) -> DataFrame:
    return S.ranked_clusters(S.dbscan(_points(spark, d), ["x", "y"], "id", 3.0, 4), "id")


_PIX = "SELECT (l_partkey % 60)::INT AS x, (l_suppkey % 60)::INT AS y FROM lineitem GROUP BY 1, 2 HAVING sum(round(l_discount * 100)::BIGINT) * 10 > 56 * count(*)"


def _mask(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem", "l_partkey", "l_suppkey", "l_discount")
    cells = rows.groupBy((F.col("l_partkey") % 60).cast("int").alias("x"), (F.col("l_suppkey") % 60).cast("int").alias("y"))
    found = cells.agg(F.sum(F.round(F.col("l_discount") * 100).cast("long")).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    return found.where("_sum * 10 > 56 * _n").select("x", "y")


def neighbours(mask: DataFrame) -> DataFrame:
    """(x, y, nx, ny): mask pixels with each of their eight neighbours in the mask."""
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j))
    around = mask.select("x", "y", F.explode(steps).alias("s")).select("x", "y", (F.col("x") + F.col("s.i")).alias("nx"), (F.col("y") + F.col("s.j")).alias("ny"))
    return around.join(mask.toDF("nx", "ny"), ["nx", "ny"]).select("x", "y", "nx", "ny")


@query("g3_skeleton_degree", f"WITH m AS ({_PIX}) SELECT a.x, a.y, count(*) AS degree FROM m a JOIN m b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND (a.x <> b.x OR a.y <> b.y) GROUP BY 1, 2")
def g3(spark: SparkSession, d: str) -> DataFrame:
    return neighbours(_mask(spark, d)).groupBy("x", "y").agg(F.count(F.lit(1)).alias("degree"))


@query(
    "a24_raster_components",
    f"""WITH RECURSIVE m AS (SELECT x * 1000 + y AS id, x, y FROM ({_PIX})), e AS (SELECT a.id AS a, b.id AS b FROM m a JOIN m b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND a.id <> b.id),
    reach(node, seen) AS (SELECT id, id FROM m UNION SELECT r.node, e.b FROM reach r JOIN e ON r.seen = e.a), r AS (SELECT node, min(seen) AS root FROM reach GROUP BY 1)
    SELECT root, count(*) AS area FROM r GROUP BY 1 HAVING count(*) >= 3""",
)
def a24(spark: SparkSession, d: str) -> DataFrame:
    """Connected components of a mask; those below an area (A25's sprinkles) go."""
    ident = lambda x, y: (F.col(x) * 1000 + F.col(y))
    found = S.components(neighbours(_mask(spark, d)).select(ident("x", "y").alias("a"), ident("nx", "ny").alias("b")))
    return found.groupBy("root").agg(F.count(F.lit(1)).alias("area")).where("area >= 3")


@query(
    "g1_mask_closing",
    f"""WITH m AS ({_PIX}), d AS (SELECT DISTINCT x + i AS x, y + j AS y FROM m, (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j))
    SELECT x + i AS x, y + j AS y FROM d, (SELECT unnest([-1, 0, 1]) AS i), (SELECT unnest([-1, 0, 1]) AS j) GROUP BY 1, 2 HAVING count(*) = 9""",
)
def g1(spark: SparkSession, d: str) -> DataFrame:
    """Closing of a mask by one pixel: dilation, then erosion."""
    return G.eroded(G.dilated(_mask(spark, d)))
