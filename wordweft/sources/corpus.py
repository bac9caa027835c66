"""Text sources.

Canonical relation ``lines``:

    lang string, file <bigint or string>, slab bigint, seq bigint, line string

``file`` orders the files of a language, ``slab`` cuts one file into bounded runs of lines and
``seq`` orders the lines of a slab. A file of any length is therefore many slabs, and no step
needs all lines of a file or language in one task.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx

SLAB_LINES = 1 << 16
# Up to so many file splits, their table travels with the tasks; a larger one is joined.
BROADCAST_SPLITS = 200_000


def lines_from_texts(texts: DataFrame, lang: str = "lang", file: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per file and its whole text -> ``lines``; ``seq`` is the line number in the file."""
    return (
        texts.select(F.lower(F.col(lang)).alias("lang"), F.col(file).alias("file"),
                     F.posexplode(tx.split_lines(F.col(text))).alias("seq", "line"))
        .select("lang", "file", _slab(F.col("seq")).alias("slab"), F.col("seq").cast("bigint").alias("seq"), "line")
    )


def kept_lines_from_texts(texts: DataFrame, lang: str = "lang", file: str = "doc_id", text: str = "text",
                          corrupt_scope: str | None = "lead") -> DataFrame:
    """``lines`` after the line filter, plus ``kept_no`` (index in file) and ``pos`` (index in slab).

    The filter runs on the array of lines, so the index of a kept line costs no shuffle.
    """
    numbered = F.transform(tx.split_lines(F.col(text)), lambda x, i: F.struct(i.alias("seq"), x.alias("line")))
    kept = F.filter(numbered, lambda s: tx.is_kept(s["line"], corrupt_scope))
    return (
        texts.select(F.lower(F.col(lang)).alias("lang"), F.col(file).alias("file"),
                     F.posexplode(kept).alias("kept_no", "s"))
        .select("lang", "file", _slab(F.col("kept_no")).alias("slab"),
                F.col("s.seq").cast("bigint").alias("seq"),
                F.col("kept_no").cast("bigint").alias("kept_no"),
                (F.col("kept_no") % F.lit(SLAB_LINES)).cast("bigint").alias("pos"),
                F.col("s.line").alias("line"))
    )


def _slab(index: Column) -> Column:
    return F.floor(index / F.lit(SLAB_LINES)).cast("bigint")


def read_corpus(spark: SparkSession, input_dir: str, languages: list[str], glob: str = "*.txt") -> DataFrame:
    """``lines`` of all files below ``<input_dir>/<language>``.

    ``seq`` is the line's number in its file, whatever splits Spark read the file in, and slabs are runs of
    lines as everywhere.
    """
    parts = []
    for name in languages:
        raw = (
            spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
            .text(posixpath.join(input_dir, name))
        )
        parts.append(_numbered(raw, name.lower()))
    return union_corpora(*parts)


def _numbered(raw: DataFrame, lang: str) -> DataFrame:
    """Text rows -> ``lines``. No line is shuffled to be numbered.

    Row ids rise by one within a split, so a line's place in its split is its id less the split's first id.
    The table of splits (one row per file split) gives the lines before each split of a file.
    """
    rows = raw.select(
        F.lit(lang).alias("lang"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"),
        F.col("value").alias("line"))
    splits = rows.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    if splits.count() <= BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    numbered = rows.join(splits, ["file", "_block"]).withColumn(
        "seq", (F.col("_before") + F.col("_id") - F.col("_first")).cast("bigint"))
    return numbered.select("lang", "file", _slab(F.col("seq")).alias("slab"), "seq", "line")


def union_corpora(*corpora: DataFrame) -> DataFrame:
    """All lines of several corpora; columns matched by name."""
    whole = corpora[0]
    for other in corpora[1:]:
        whole = whole.unionByName(other)
    return whole


def select_language(lines: DataFrame, lang: str) -> DataFrame:
    return lines.where(F.col("lang") == lang.lower())


def read_vectors(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Text vectors ``word f1 ... fD`` under a ``V D`` header -> (word, vector array<float>).

    ``check`` compares rows and dimensions with the header, if there is one, and refuses other rows.
    """
    lines = _numbered(spark.read.text(path), "")
    parts = lines.select("file", "seq", F.split("line", " ", -1).alias("p"))
    is_header = (F.size("p") == 2) & (F.col("seq") == 0) & F.forall("p", lambda x: x.rlike(r"^\d+$"))
    headers = parts.where(is_header).select(F.col("p")[0].cast("bigint").alias("v"), F.col("p")[1].cast("bigint").alias("d"))
    numbers = F.filter(F.slice("p", 2, 1 << 30), lambda x: x != "")
    vectors = parts.where(~is_header).select(
        F.element_at("p", 1).alias("word"), F.transform(numbers, lambda x: x.cast("float")).alias("vector"))
    if check:
        header = headers.agg(F.count("*").alias("n"), F.sum("v").alias("v"), F.min("d").alias("low"), F.max("d").alias("high")).first()
        size = vectors.agg(F.count("*").alias("v"), F.min(F.size("vector")).alias("low"), F.max(F.size("vector")).alias("high")).first()
        if size["low"] != size["high"]:
            raise ValueError(f"{path}: vectors of {size['low']} to {size['high']} numbers")
        if header["n"] and (header["v"], header["low"], header["high"]) != (size["v"], size["low"], size["high"]):
            raise ValueError(f"{path}: header says {header['v']} x {header['high']}, file has {size['v']} x {size['high']}")
    return vectors


def read_tagged_lines(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Column files ``Token<TAB>Tag`` by split name -> ``lines`` with the split as ``lang``."""
    parts = []
    for split, path in paths.items():
        parts.append(_numbered(spark.read.text(path), split))
    return union_corpora(*parts)


def tagging_paths(tuning_dir: str, lang: str, tag_type: str = "pos") -> dict[str, str]:
    """Where the train and test files of the downstream task lie."""
    base = posixpath.join(tuning_dir, lang)
    return {
        "train": posixpath.join(base, f"Data.{tag_type}.full_train.{lang}.tsv"),
        "test": posixpath.join(base, f"Data.{tag_type}.test.{lang}.tsv"),
    }
