"""Cutting lineage with tables in the cluster's shared checkpoint folder.

Every multi-phase operator writes what a phase decided as a Parquet table and
reads it back.  A lost executor then costs one phase at most, a phase's shuffle
files can go once its table exists, and no phase is computed twice.
"""

from __future__ import annotations

import contextlib
import gc
import tempfile
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows are whole documents, so an Arrow batch of Spark's usual size takes much memory.
BATCH_BOUNDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 16 << 20}
#: A phase of this many seconds has left shuffle files that are worth collecting.
LONG_S = 1.0
#: Whether a query's shuffle files go when it ends; else when the driver's collector has found that nothing names them.
AT_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches, also for results that are read later; smaller bounds stay."""
    for key, most in BATCH_BOUNDS.items():
        have = int(spark.conf.get(key).rstrip("b"))
        if not 0 < have <= most:
            spark.conf.set(key, str(most))


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a session on one machine may leave it unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lumenfold-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


@contextlib.contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Queries inside leave no shuffle files: none may be the source of a later one but by its table."""
    before = spark.conf.get(AT_END, None)
    spark.conf.set(AT_END, "true")
    try:
        yield
    finally:
        spark.conf.unset(AT_END) if before is None else spark.conf.set(AT_END, before)


def likely_smallest(rows: DataFrame, column: str, wanted: int) -> DataFrame:
    """``rows`` whose hash of ``column`` is small enough to be among the ``wanted`` smallest, and some more.

    About four times ``wanted`` distinct values pass, so that what a following
    ``orderBy(hash).limit(wanted)`` sends to one place does not grow with the number of
    tasks.  A table of few values passes whole.
    """
    distinct = rows.agg(F.approx_count_distinct(column)).first()[0]
    return rows.where(F.pmod(F.xxhash64(column), F.lit(1 << 30)).cast("double") * distinct <= 4.0 * wanted * (1 << 30))


class Cuts:
    """The tables that one run of an operator leaves in the shared folder."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.paths: dict[str, str] = {}
        small_batches(spark)

    def put(self, tag: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and return the table read back; shuffles behind it go."""
        path = f"{self.root}/{tag}"
        began = time.monotonic()
        with shuffles_go(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        if time.monotonic() - began > LONG_S:
            self.release()
        self.paths[tag] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tags: str) -> None:
        """Delete tables that no later plan reads."""
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for tag in tags:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(tag))
            with contextlib.suppress(Exception):  # a leftover table costs disk, not results
                path.getFileSystem(conf).delete(path, True)

    def release(self) -> None:
        """Let Spark's cleaner delete the shuffle files of phases whose tables exist."""
        gc.collect()
        self.spark._jvm.System.gc()
        time.sleep(0.2)
