"""Text-based inputs and outputs: OBJ, position tables, response files, COCO JSON, tracks, done-lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrays import NpzSource, PlySource
from .las import LasSource


def register(spark: SparkSession) -> None:
    """Make the formats las, ply and npz known to ``spark.read``."""
    for source in (LasSource, PlySource, NpzSource):
        spark.dataSource.register(source)


def read_obj(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(vertices x, y, z; edges a, b with vertex numbers from 0) of OBJ ``v`` and ``l`` lines, in file order."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line"), F.split(F.trim("value"), r"\s+").alias("w"))
    v = lines.where("w[0] = 'v'").select("line", *(F.col("w")[k + 1].cast("double").alias(c) for k, c in enumerate("xyz")))
    e = lines.where("w[0] = 'l' AND size(w) >= 3").select((F.col("w")[1].cast("int") - 1).alias("a"), (F.col("w")[2].cast("int") - 1).alias("b"))
    return v, e


def read_positions(spark: SparkSession, path: str) -> DataFrame:
    """(name, x, y, z) of a white-space table; a header and lines of fewer than four columns are skipped."""
    words = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("w")).where(F.size("w") >= 4)
    rows = words.select(F.col("w")[0].alias("name"), *(F.col("w")[k + 1].try_cast("double").alias(c) for k, c in enumerate("xyz")))
    return rows.where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """(image, class, score, position): one row a class, the highest score and the first place it has it."""
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]+$", 1).alias("image"), "value")
    lines = files.select("image", F.posexplode(F.split("value", "\n")).alias("position", "line"))
    parts = lines.select("image", "position", F.split(F.trim("line"), "\t").alias("w")).where("w[0] != ''")
    rows = parts.select("image", "position", F.col("w")[0].alias("class"), F.coalesce(F.get("w", F.size("w") - 1).try_cast("double"), F.lit(1.0)).alias("score"))
    best = rows.groupBy("image", "class").agg(F.max(F.struct("score", (-F.col("position")).alias("m"))).alias("b"))
    return best.select("image", "class", F.col("b.score").alias("score"), (-F.col("b.m")).alias("position"))


def read_coco(spark: SparkSession, path: str) -> DataFrame:
    """Images with their annotations, an empty list where there are none."""
    doc = spark.read.json(path, multiLine=True)
    images = doc.select(F.explode("images").alias("i")).select("i.*")
    anns = doc.select(F.explode("annotations").alias("a"))
    grouped = anns.groupBy(F.col("a.image_id").alias("id")).agg(F.array_sort(F.collect_list("a")).alias("annotations"))
    kind = grouped.schema["annotations"].dataType
    return images.join(grouped, "id", "left").withColumn("annotations", F.coalesce("annotations", F.array().cast(kind)))


def read_tracks(spark: SparkSession, path: str, keep_negative_ids: bool = False) -> DataFrame:
    """(t, id, x, y, w, h, score) of comma-separated tracking rows."""
    names = ["t", "id", "x", "y", "w", "h", "score"]
    rows = spark.read.csv(path).toDF(*(f"_c{k}" for k in range(len(spark.read.csv(path).columns))))
    rows = rows.select(*(F.col(f"_c{k}").cast("double" if k > 1 else "long").alias(n) for k, n in enumerate(names) if f"_c{k}" in rows.columns))
    return rows if keep_negative_ids else rows.where("id >= 0")


def not_done(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs whose output does not exist yet."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def instance_boxes(points: DataFrame, instance: str) -> DataFrame:
    """OBJ text of each instance's axis-aligned box, with vertex numbers that follow on from the instances before."""
    box = points.groupBy(instance).agg(*(f(c).alias(f"{c}{n}") for c in "xyz" for f, n in ((F.min, 0), (F.max, 1))))
    base = F.sum(F.lit(8)).over(Window.orderBy(instance).rowsBetween(Window.unboundedPreceding, -1))
    corners = [F.concat_ws(" ", F.lit("v"), *(F.col(f"{c}{(k >> b) & 1}") for b, c in enumerate("xyz"))) for k in range(8)]
    edges = [(a, a | 1 << b) for a in range(8) for b in range(3) if not a >> b & 1]
    lines = [F.concat_ws(" ", F.lit("l"), F.col("_at") + a + 1, F.col("_at") + b + 1) for a, b in edges]
    return box.withColumn("_at", F.coalesce(base, F.lit(0))).select(instance, F.concat_ws("\n", *corners, *lines).alias("obj"))


def pack_rgb(r: str, g: str, b: str) -> Column:
    """Three bytes in one integer."""
    return F.shiftleft(F.col(r).cast("int"), 16).bitwiseOR(F.shiftleft(F.col(g).cast("int"), 8)).bitwiseOR(F.col(b).cast("int"))
