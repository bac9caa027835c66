"""Sinks. Outputs are partitioned tables; a rerun overwrites only the partitions it produces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, *partitions: str) -> None:
    """Parquet with dynamic partition overwrite (or whole overwrite without partitions)."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def write_vectors(vectors: DataFrame, path: str) -> None:
    """Models lie under algorithm=/lang=/size=; size -1 is the whole corpus."""
    write_table(vectors, path, "algorithm", "lang", "size")


def export_vectors_text(vectors: DataFrame, path: str) -> None:
    """Text vectors of one model: a part with the ``V D`` header, then parts of ``word f1 ... fD``."""
    header = vectors.agg(F.count("*").alias("v"), F.max(F.size("vector")).alias("d")).select(
        F.concat_ws(" ", "v", "d").alias("value"))
    rows = vectors.select(F.concat_ws(" ", "word", F.array_join(F.transform("vector", lambda x: x.cast("string")), " "))
                          .alias("value"))
    header.coalesce(1).union(rows).write.mode("overwrite").text(path)


def write_prepared(lines: DataFrame, path: str, *partitions: str, order: str = "ordinal") -> None:
    """Text of prepared lines below one folder per key, in corpus order.

    Range partitioning on keys and order keeps the files sorted and splits a key that holds most lines.
    """
    keys = [*partitions, order]
    (
        lines.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*partitions, F.col("line").alias("value"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).text(path)
    )


def write_tokenizer(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    write_table(vocab, f"{path}/vocab")
    write_table(merges, f"{path}/merges")


def write_trials(results: DataFrame, path: str) -> None:
    """Tab-separated trial table per (lang, algorithm)."""
    (
        results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("sep", "\t")
        .option("header", True).partitionBy("lang", "algorithm").csv(path)
    )


def append_best(runs: DataFrame, best: DataFrame, path: str) -> None:
    """Append the best trial of each run; a run without one gets N/A."""
    config = [c for c in best.columns if c not in ("lang", "algorithm")]
    text = F.to_json(F.struct(*config))
    rows = runs.select("lang", "algorithm").join(
        best.select("lang", "algorithm", text.alias("result")), ["lang", "algorithm"], "left")
    rows.withColumn("result", F.coalesce("result", F.lit("N/A"))).write.mode("append").option("sep", "\t").csv(path)
