"""Row shaping: splits, shards, prefixes, learning-curve sizes, merged rows.

``i`` is the 0-based ordinal of a kept line in its language (``ordinal.with_ordinal``). All rules here
are closed forms of ``i``, so they cost no further shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .ordinal import exclusive_scan, with_slab_position

# Of every 101 kept lines 99 train, 1 tests, 1 validates; 31 lines make a merged row.
CYCLE, TRAIN_LINES = 101, 99
MERGE_LINES = 31


def _div(x: Column, n: int) -> Column:
    return F.floor(x / F.lit(n)).cast("bigint")


def split_of(i: Column) -> Column:
    place = i % F.lit(CYCLE)
    return (
        F.when(place < TRAIN_LINES, F.lit("train"))
        .when(place == TRAIN_LINES, F.lit("test"))
        .otherwise(F.lit("valid"))
    )


def train_ordinal(i: Column) -> Column:
    """Ordinal among training lines (null on test and validation lines)."""
    place = i % F.lit(CYCLE)
    return F.when(place < TRAIN_LINES, _div(i, CYCLE) * TRAIN_LINES + place)


def with_split(lines: DataFrame, i: str = "ordinal") -> DataFrame:
    return (
        lines.withColumn("split", split_of(F.col(i)))
        .withColumn("train_ordinal", train_ordinal(F.col(i)))
    )


def fixed_shard(i: Column, size: int) -> Column:
    """1-based shards of exactly ``size`` lines."""
    return _div(i, size) + 1


def counted_twice_shard(t: Column, limit: int) -> Column:
    """0-based shards of the counter that each line raises twice.

    The first shard takes ceil(limit/2) lines, each later one floor(limit/2)+1.
    """
    first, rest = (limit + 1) // 2, limit // 2 + 1
    return F.when(t < first, F.lit(0).cast("bigint")).otherwise(_div(t - first, rest) + 1)


def prefix(lines: DataFrame, n: int, i: str = "ordinal") -> DataFrame:
    """The first n kept lines of each language; n <= 0 keeps all."""
    return lines if n <= 0 else lines.where(F.col(i) < n)


def prefix_train(lines: DataFrame, n: int, i: str = "ordinal") -> DataFrame:
    """The lines read until n training lines are seen; n <= 0 keeps all."""
    if n <= 0:
        return lines
    last = CYCLE * ((n - 1) // TRAIN_LINES) + (n - 1) % TRAIN_LINES + 1
    return lines.where(F.col(i) < last)


def curve_step(i: Column, init: int) -> Column:
    """First run of the curve that reads line i: the bit length of i div init."""
    q = _div(i, init)
    return F.when(q == 0, F.lit(0)).otherwise(F.length(F.bin(q))).cast("bigint")


def curve_sizes(totals: DataFrame, init: int, n: str = "n_lines") -> DataFrame:
    """(lang, n) -> the runs init, 2*init, ... up to the first size that is larger than n."""
    if init < 1:
        raise ValueError("the first size must be positive")
    last = curve_step(F.col(n), init)
    runs = totals.select("lang", n, F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("run"))
    return (
        runs.withColumn("size", F.lit(init).cast("bigint") * F.pow(F.lit(2), F.col("run")).cast("bigint"))
        .withColumn("n_used", F.least("size", n))
        .withColumn("is_full", F.col("size") > F.col(n))
    )


def curve_line_stats(lines: DataFrame, init: int, i: str = "ordinal") -> DataFrame:
    """Lines and characters that each run of the curve reads.

    A line counts towards its first run only; the later runs add up at most 63 totals. No line is
    repeated per size.
    """
    steps = (
        lines.groupBy("lang", curve_step(F.col(i), init).alias("run"))
        .agg(F.count("*").alias("n"), F.sum(F.length("line")).cast("bigint").alias("c"))
    )
    sizes = curve_sizes(lines.groupBy("lang").agg(F.count("*").alias("n_lines")), init)
    upto = Window.partitionBy("lang").orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    return (
        sizes.join(steps, ["lang", "run"], "left")
        .select("lang", "run", "size",
                F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("n_lines"),
                F.coalesce(F.sum("c").over(upto), F.lit(0)).alias("n_chars"))
    )


def merged_rows(kept: DataFrame, across_files: bool = True) -> DataFrame:
    """Add ``doc_ord``: the merged row that a kept line belongs to (needs ``kept_no``).

    A row ends after each 31st kept line of a file. Across files, a row that is still open runs on into
    the next file, so its length has no bound: lines stay lines here, and windows over a merged row
    work on token positions (``pairs.position_chunks``).
    """
    closed = _div(F.col("kept_no"), MERGE_LINES)
    if not across_files:
        return kept.withColumn("doc_ord", closed)
    files = kept.groupBy("lang", "file").agg(F.count("*").alias("_lines"))
    files = files.withColumn("_rows", _div(F.col("_lines"), MERGE_LINES))
    starts = exclusive_scan(files, ["lang"], ["file"], "_rows", "_row_start").select("lang", "file", "_row_start")
    return (
        kept.join(starts, ["lang", "file"])
        .withColumn("doc_ord", F.col("_row_start") + closed)
        .drop("_row_start")
    )


def kept_lines(lines: DataFrame, corrupt_scope: str | None = "lead") -> DataFrame:
    """The line filter on ``lines`` of any source, with ``pos`` (index in slab) and ``kept_no`` (in file)."""
    kept = lines.where(tx.is_kept(F.col("line"), corrupt_scope))
    return with_kept_number(with_slab_position(kept))


def with_kept_number(kept: DataFrame) -> DataFrame:
    """Index of a kept line in its file, for sources that only know its place in a slab (``pos``)."""
    slabs = kept.groupBy("lang", "file", "slab").agg(F.count("*").alias("_n"))
    starts = exclusive_scan(slabs, ["lang", "file"], ["slab"], "_n", "_slab_start", levels=0).drop("_n")
    return (
        kept.join(starts, ["lang", "file", "slab"])
        .withColumn("kept_no", F.col("_slab_start") + F.col("pos"))
        .drop("_slab_start")
    )


def sequence_with_ends(tokens: Column, limit: int, start: str = "<S>", end: str = "</S>") -> Column:
    """At most ``limit`` tokens between the boundary tokens."""
    return F.concat(F.array(F.lit(start)), F.slice(tokens, 1, limit), F.array(F.lit(end)))


def with_words(lines: DataFrame) -> DataFrame:
    """Lines cut into ``words``, empty ones included, in place of their text: what reads them again need not cut them."""
    return lines.withColumn("words", tx.split_spaces(F.col("line"), True)).drop("line")


def words_of(lines: DataFrame, keep_empty: bool = False) -> Column:
    """The words of a line, from ``words`` where it is cut already."""
    if "words" not in lines.columns:
        return tx.split_spaces(F.col("line"), keep_empty)
    return F.col("words") if keep_empty else F.array_remove("words", "")


def tokens_of(lines: DataFrame, keep_empty: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per token: (lang, file, slab, seq, *carry, pos, word)."""
    return (
        lines.select("lang", "file", "slab", "seq", *carry, F.posexplode(words_of(lines, keep_empty)).alias("pos", "word"))
        .withColumn("pos", F.col("pos").cast("bigint"))
    )


def corpus_stats(lines: DataFrame, shard: Column | None = None) -> DataFrame:
    """Lines, files and (1-based) shards per language; counted per file first."""
    top = F.lit(0).cast("bigint") if shard is None else shard
    return (
        lines.groupBy("lang", "file").agg(F.count("*").alias("n"), F.max(top).alias("s"))
        .groupBy("lang").agg(F.sum("n").alias("n_lines"), F.count("*").alias("n_files"), F.max("s").alias("n_shards"))
    )


def sentences_of_tagged(lines: DataFrame) -> DataFrame:
    """``Token<TAB>Tag`` lines -> (split, file, sent_id, pos, token, tag).

    A blank line ends a sentence. Blank lines are counted per slab and scanned, so one long file is no
    single window; tokens are ranked inside their sentence.
    """
    blank = tx.is_blank(F.col("line"))
    starts = _blank_starts(lines, blank)
    w = Window.partitionBy("lang", "file", "slab").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    fields = F.split(F.col("line"), r"(?U)\s+", -1)
    rows = (
        lines.withColumn("_b", F.when(blank, 1).otherwise(0).cast("bigint"))
        .withColumn("_in", F.coalesce(F.sum("_b").over(w), F.lit(0)))
        .join(starts, ["lang", "file", "slab"])
        .withColumn("sent_id", F.col("_start") + F.col("_in"))
        .where(F.col("_b") == 0)
    )
    place = Window.partitionBy("lang", "file", "sent_id").orderBy("slab", "seq")
    return rows.select(
        F.col("lang").alias("split"), "file", "sent_id",
        (F.row_number().over(place) - 1).cast("bigint").alias("pos"),
        F.get(fields, F.lit(0)).alias("token"), F.get(fields, F.lit(1)).alias("tag"),
    )


def _tagged_places():
    """Arrow UDF: flags of blank lines -> per line its sentence (blank lines before) and place in it; -1 for blank lines."""
    @F.arrow_udf("sent array<int>, pos array<int>")
    def places(blank: pa.Array) -> pa.Array:
        lengths = blank.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        flags = blank.flatten().to_numpy(zero_copy_only=False).astype(bool)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("int32")
        at, start = np.arange(len(flags), dtype="int32"), np.repeat(offsets[:-1], lengths)
        seen = np.concatenate([[0], np.cumsum(flags, dtype="int32")]).astype("int32")
        last = np.maximum(np.maximum.accumulate(np.where(flags, at, np.int32(-1))), start - 1)
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (seen[1:] - seen[start], at - last - 1)],
            names=["sent", "pos"])

    return places


def sentences_of_tagged_texts(texts: DataFrame, lang: str = "lang", file: str = "doc_id", text: str = "text") -> DataFrame:
    """``sentences_of_tagged`` for files that are one row each: blank lines are counted on the array of lines, so that
    no line is shuffled."""
    placed = (
        texts.select(F.lower(F.col(lang)).alias("split"), F.col(file).alias("file"), tx.split_lines(F.col(text)).alias("_lines"))
        .withColumn("_at", _tagged_places()(F.transform("_lines", tx.is_blank)))
        .select("split", "file", F.explode(F.arrays_zip(
            F.col("_lines").alias("line"), F.col("_at.sent").alias("sent"), F.col("_at.pos").alias("pos"))).alias("t"))
        .where(F.col("t.pos") >= 0)
    )
    fields = F.split(F.col("t.line"), r"(?U)\s+", -1)
    return placed.select("split", "file", F.col("t.sent").cast("bigint").alias("sent_id"), F.col("t.pos").cast("bigint").alias("pos"),
                         F.get(fields, F.lit(0)).alias("token"), F.get(fields, F.lit(1)).alias("tag"))


def _blank_starts(lines: DataFrame, blank: Column) -> DataFrame:
    slabs = lines.groupBy("lang", "file", "slab").agg(F.sum(F.when(blank, 1).otherwise(0)).alias("_n"))
    return exclusive_scan(slabs, ["lang", "file"], ["slab"], "_n", "_start", levels=0).drop("_n")
