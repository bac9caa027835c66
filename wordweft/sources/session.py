"""Session helpers: the shared checkpoint folder and lineage cuts."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder in ``spark.checkpoint.dir``; only a local session may fall back to /tmp."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="wordweft-checkpoint-")
    context.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    Loops use it to keep plans short; rankings use it to freeze a sampled range partitioning.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _new_path(spark: SparkSession) -> tuple[str, str]:
    """(name, path) of a table in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    name = f"rows_{uuid.uuid4().hex}"
    return name, f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}"


def stored(df: DataFrame) -> DataFrame:
    """Like ``cut``, but compressed, by column: ids and counts take a fraction of the bytes. The table stays until the folder is
    emptied, or a ``Scratch`` that keeps it ends."""
    _, path = _new_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_at = path
    return found


def bucketed(df: DataFrame, buckets: int, *keys: str) -> DataFrame:
    """Write the rows into buckets by ``keys`` in the shared checkpoint folder: what groups by them later reads them where they are."""
    return _in_buckets(df, buckets, keys, *_new_path(df.sparkSession))


def _in_buckets(df: DataFrame, buckets: int, keys: tuple[str, ...], name: str, path: str) -> DataFrame:
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option("compression", "zstd").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files and checkpoints that nothing refers to any more: Spark removes them when the driver
    collects its garbage, which in a long loop may be after the disk is full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class Scratch:
    """Tables of one training in the shared checkpoint folder. They are removed when it ends, or dropped before."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.tables = spark, set(), []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for path in self.paths:
            self._remove(path)
        release(self.spark)

    def _remove(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def keep(self, found: DataFrame) -> DataFrame:
        """Take charge of a stored table."""
        self.paths.add(found.stored_at)
        return found

    def stored(self, df: DataFrame) -> DataFrame:
        return self.keep(stored(df))

    def bucketed(self, df: DataFrame, buckets: int, *keys: str) -> DataFrame:
        name, path = _new_path(self.spark)
        self.tables.append(name)
        self.paths.add(path)
        return _in_buckets(df, buckets, keys, name, path)

    def drop(self, found: DataFrame) -> None:
        """Remove a stored table that is not read again, and what made it."""
        self.paths.remove(found.stored_at)
        self._remove(found.stored_at)
        release(self.spark)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on a table of few files, which may be one unsplittable piece each.

    A table with at least one file per core is left as it is scanned.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if len(df.inputFiles()) < cores else df


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that a plan reads; 0 where it reads none or they are not known (checkpointed rows)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(k).stats().sizeInBytes()) for k in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)
