"""Helpers of the training-data operators: input columns, shared folders, driver-side constants."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.session import ensure_checkpoint_dir, stored_bytes


def doc_text(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null is empty) and the named columns; clashing extra columns never travel."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def first_hashed(rows: DataFrame, count: int, most_chars: int) -> list:
    """The ids of the ``count`` first rows (doc_id, n_chars) in hashed order of doc_id; longer texts come after all
    others, so they fill the sample where there is nothing else. Only ids reach the driver."""
    at = F.xxhash64(F.col("doc_id").cast("string"), F.lit(5))
    sized = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.col("n_chars") > most_chars).alias("is_long"))
    return [r[0] for r in sized.orderBy("is_long", at, "doc_id").limit(count).collect()]


def texts_by_id(docs: DataFrame, ids: list, most_chars: int) -> dict:
    """Texts of a bounded list of documents; of a text of more than ``most_chars`` code points, a window of that length
    at a hashed place. A doc_id that several rows share gives the smallest of its texts."""
    spark = docs.sparkSession
    wanted = spark.createDataFrame([(i,) for i in ids], docs.select("doc_id").schema)
    room = F.greatest(F.char_length("text") - most_chars + 1, F.lit(1))
    start = (F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(6)), room) + 1).cast("int")
    found = (
        doc_text(docs).join(F.broadcast(wanted), "doc_id")
        .withColumn("text", F.substring(F.col("text"), start, F.lit(most_chars)))
        .groupBy("doc_id").agg(F.min("text").alias("text"))
    )
    return {r["doc_id"]: r["text"] for r in found.collect()}


def text_lengths(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_chars counted from the text, and the named columns."""
    return docs.select("doc_id", F.char_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("n_chars"), *more)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder (``spark.checkpoint.dir``)."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write the rows as a table in the shared folder and read them back: lineage ends here, a lost
    executor costs nothing that was written, and a second reader does not compute the rows again."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_fresh(df: DataFrame, stem: str) -> str:
    """A column name that the table does not have."""
    taken, name = {c.lower() for c in df.columns}, stem
    while name.lower() in taken:
        name += "_"
    return name


def tasks_for(df: DataFrame, task_bytes: int = 32 << 20) -> int:
    """Tasks for one shuffle of a table: by the bytes of the files that it is read from, and at least as many as the
    session asks for."""
    asked = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(asked, -(-stored_bytes(df) // task_bytes))


def shared_file_system(uri: str):
    """(file system, path) of a place in the shared folder, for tasks that write or read files of their own format."""
    from pyarrow import fs
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)
