"""Projection, depth and raster operators over point and pixel tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Poses that one pass over the points carries as literals.
POSES = 64


def project(points: DataFrame, cameras: DataFrame, keep: list[str]) -> DataFrame:
    """Camera coordinates xc, yc, zc > 0 of every point in every camera.

    ``cameras`` has ``image`` and the inverse pose as 12 numbers in ``inv``.  Each pass
    over the points makes a point's coordinates in ``POSES`` cameras once, in a
    generator, behind which filters stay; more cameras take more passes.
    """
    kind = cameras.schema["image"].dataType
    poses = [tuple(r) for r in cameras.select("image", "inv").collect()]  # a rig: one row per image

    def seen(image: object, inv: list[float]) -> Column:
        row = lambda r: sum((F.lit(inv[4 * r + k]) * F.col(c) for k, c in enumerate("xyz")), F.lit(inv[4 * r + 3]))
        return F.struct(F.lit(image).cast(kind).alias("image"), row(0).alias("xc"), row(1).alias("yc"), row(2).alias("zc"))

    passes = []
    for at in range(0, max(1, len(poses)), POSES):
        rows = F.array(*(seen(*p) for p in poses[at : at + POSES])) if poses else F.array(seen(None, [0.0] * 12))
        passes.append(points.select(*keep, F.inline(rows)).where("zc > 0"))
    return reduce(DataFrame.unionByName, passes)


def focal(width: float, fov_degrees: float) -> float:
    import math

    return width / 2 / math.tan(math.radians(fov_degrees / 2))


def to_pixels(projected: DataFrame, width: int, height: int, fov_degrees: float, margin: float | None = None) -> DataFrame:
    """Pixel coordinates u, v in view; rounded half to even with ``pix`` or, with a margin, continuous."""
    f = focal(width, fov_degrees)
    u, v = F.col("xc") * f / F.col("zc") + width / 2, F.col("yc") * f / F.col("zc") + height / 2
    d2 = F.col("xc") ** 2 + F.col("yc") ** 2 + F.col("zc") ** 2
    if margin is not None:
        found = projected.withColumns({"u": u, "v": v, "d2": d2})
        return found.where(F.col("u").between(-margin, width + margin) & F.col("v").between(-margin, height + margin))
    found = projected.withColumns({"u": F.rint(u).cast("int"), "v": F.rint(v).cast("int"), "d2": d2})
    return found.where((F.col("u") >= 0) & (F.col("u") < width) & (F.col("v") >= 0) & (F.col("v") < height)).withColumn("pix", F.col("v") * width + F.col("u"))


def z_buffer(pixels: DataFrame, keys: list[str], depth: str, ident: str) -> DataFrame:
    """The nearest point of each pixel, lowest id on ties: one aggregation, no sort."""
    best = pixels.groupBy(*keys).agg(F.min(F.struct(depth, ident)).alias("_b"))
    return best.select(*keys, F.col(f"_b.{depth}").alias(depth), F.col(f"_b.{ident}").alias(ident))


def depth_band(pixels: DataFrame, keys: list[str], depth: str, band: float) -> DataFrame:
    """All points of a pixel whose squared distance is less than ``band`` beyond the nearest's."""
    near = F.min(depth).over(Window.partitionBy(*keys))  # one pass: the pixels are not made twice
    return pixels.withColumn("_near", near).where(F.col(depth) - F.col("_near") < band).drop("_near")


def splat_radius(depth: Column, scale: float, least: float, most: float) -> Column:
    return F.least(F.greatest(F.lit(scale) / depth, F.lit(least)), F.lit(most))


def splat(points: DataFrame, keys: list[str], u: str, v: str, radius: Column, value: str, width: int, height: int, reach: int, gate: float, depth: str) -> DataFrame:
    """Soft splatting: Gaussian-weighted mean of ``value`` over all points within their radius of a pixel.

    ``reach`` bounds the radius in pixels, hence the rows made of a point; points
    deeper than the pixel's front by more than ``gate`` take no part.
    """
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    rows = points.withColumn("_r", radius).withColumn("_dx", F.explode(steps)).withColumn("_dy", F.explode(steps))
    px, py = F.rint(u) + F.col("_dx"), F.rint(v) + F.col("_dy")
    rows = rows.withColumns({"px": px.cast("int"), "py": py.cast("int")})
    rows = rows.withColumn("_q", (F.col("px") - F.col(u)) ** 2 + (F.col("py") - F.col(v)) ** 2).where("_q <= _r * _r")
    rows = rows.where((F.col("px") >= 0) & (F.col("px") < width) & (F.col("py") >= 0) & (F.col("py") < height))
    at = [*keys, "px", "py"]
    front = rows.groupBy(*at).agg(F.min(depth).alias("_front"))
    weight = F.exp(-F.col("_q") / (2 * (F.col("_r") / 2) ** 2))
    near = rows.join(front, at).where(F.col(depth) - F.col("_front") <= gate)
    return near.groupBy(*at).agg((F.sum(weight * F.col(value)) / F.sum(weight)).alias(value), F.min("_front").alias("front"))


def dilate_min(pixels: DataFrame, keys: list[str], x: str, y: str, value: str, half: int) -> DataFrame:
    """Minimum of ``value`` over the (2 * half + 1) squared neighbourhood of every pixel that has a neighbour."""
    steps = F.sequence(F.lit(-half), F.lit(half))
    rows = pixels.select(*keys, x, y, value, F.explode(steps).alias("_d")).withColumn(x, F.col(x) + F.col("_d")).drop("_d")
    rows = rows.groupBy(*keys, x, y).agg(F.min(value).alias(value))  # separable: rows first, then columns
    rows = rows.select(*keys, x, y, value, F.explode(steps).alias("_d")).withColumn(y, F.col(y) + F.col("_d")).drop("_d")
    return rows.groupBy(*keys, x, y).agg(F.min(value).alias(value))


def cell(column: str, origin: float, size: float) -> Column:
    return F.floor((F.col(column) - origin) / size)


def top_per_cell(points: DataFrame, keys: list[str], height: str, ident: str, payload: list[str]) -> DataFrame:
    """The highest point of each cell, lowest id on ties."""
    best = points.groupBy(*keys).agg(F.max(F.struct(height, (-F.col(ident)).alias("_m"), *payload)).alias("_b"))
    return best.select(*keys, F.col(f"_b.{height}").alias(height), (-F.col("_b._m")).alias(ident), *(F.col(f"_b.{p}").alias(p) for p in payload))


def stretch(column: str, low: float, high: float) -> Column:
    clamped = F.least(F.greatest(F.col(column), F.lit(low)), F.lit(high))
    return F.rint((clamped - low) / (high - low) * 255)


def normalise_box(box: list[str], top: float = 1000.0) -> list[Column]:
    """Clipped to [0, top], corners in order."""
    clip = lambda c: F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(top))
    x1, y1, x2, y2 = (clip(c) for c in box)
    return [F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2)]


def box_iou(a: list[Column], b: list[Column]) -> Column:
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    inter = w * h
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def tile_starts(full: Column, tile: int, stride: int) -> Column:
    """Starts of tiles that cover ``full``; the last one is moved back to end with it."""
    last = F.greatest(full - tile, F.lit(0))
    return F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(stride)), F.array(last)))


def resized(height: Column, width: Column, factor: int, least: int, most: int) -> tuple[Column, Column]:
    """Height and width rounded to multiples of ``factor`` with the pixel count in bounds and the aspect kept."""
    h, w = F.bround(height / factor) * factor, F.bround(width / factor) * factor
    shrink, grow = F.sqrt(height * width / most), F.sqrt(least / (height * width))
    pick = lambda side, plain: (
        F.when(h * w > most, F.greatest(F.lit(factor), F.floor(side / shrink / factor) * factor)).when(h * w < least, F.ceil(side * grow / factor) * factor).otherwise(F.greatest(F.lit(factor), plain))
    )
    return pick(height, h).cast("long"), pick(width, w).cast("long")


def paste_later(tiles: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Stitched raster: the non-zero value of the latest tile."""
    best = tiles.where(F.col(value) != 0).groupBy(*keys).agg(F.max(F.struct(order, value)).alias("_b"))
    return best.select(*keys, F.col(f"_b.{value}").alias(value))


def along(points: DataFrame, key: str, order: str, x: str, y: str) -> DataFrame:
    """Length of the path up to each point, within its key."""
    w = Window.partitionBy(key).orderBy(order)
    step = F.sqrt((F.col(x) - F.lag(x).over(w)) ** 2 + (F.col(y) - F.lag(y).over(w)) ** 2)
    return points.withColumn("_step", F.coalesce(step, F.lit(0.0))).withColumn("length", F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_step")


def dilated(mask: DataFrame, x: str = "x", y: str = "y", half: int = 1) -> DataFrame:
    """Pixels within ``half`` rows and columns of the mask."""
    steps = F.sequence(F.lit(-half), F.lit(half))
    wide = mask.select(x, y, F.explode(steps).alias("_d")).select((F.col(x) + F.col("_d")).alias(x), y).distinct()
    return wide.select(x, y, F.explode(steps).alias("_d")).select(x, (F.col(y) + F.col("_d")).alias(y)).distinct()


def eroded(mask: DataFrame, x: str = "x", y: str = "y", half: int = 1) -> DataFrame:
    """Pixels whose whole neighbourhood is in the mask."""
    steps = F.sequence(F.lit(-half), F.lit(half))
    full = 2 * half + 1
    wide = mask.select(x, y, F.explode(steps).alias("_d")).select((F.col(x) + F.col("_d")).alias(x), y)
    rows = wide.groupBy(x, y).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == full).select(x, y)
    tall = rows.select(x, y, F.explode(steps).alias("_d")).select(x, (F.col(y) + F.col("_d")).alias(y))
    return tall.groupBy(x, y).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == full).select(x, y)
