"""Inputs of language-model training: character streams, masked sequences, batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.hashing import hash_hex, hash_uniform
from .ordinal import with_running_sum

# Ids of <s>, <pad>, </s>, <unk>, <mask>; the first three are never masked.
START, PAD, END, UNKNOWN, MASK = 0, 1, 2, 3, 4
NEVER_MASKED = (START, PAD, END)


def next_char_counts(lines: DataFrame, forward: bool = True, i: str = "ordinal") -> DataFrame:
    """(lang, item, target, n): each character of the stream and the one that follows it.

    A backward model reads the stream from its end. Pairs inside a line are local; the pair across a line
    end joins each line with the first character of the next one, by ordinal.
    """
    text = F.concat("line", F.lit("\n"))
    chars = tx.characters(text)
    inner = F.arrays_zip(F.slice(chars, 1, F.size(chars) - 1).alias("a"), F.slice(chars, 2, F.size(chars)).alias("b"))
    within = (
        lines.select("lang", F.explode(inner).alias("p"))
        .groupBy("lang", F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("n"))
    )
    heads = lines.select("lang", (F.col(i) - 1).alias("_at"), F.substring("line", 1, 1).alias("b"))
    ends = lines.select("lang", F.col(i).alias("_at"))
    across = (
        ends.join(heads, ["lang", "_at"]).groupBy("lang", "b").agg(F.count("*").alias("n"))
        .select("lang", F.lit("\n").alias("a"), "b", "n")
    )
    pairs = within.unionByName(across).groupBy("lang", "a", "b").agg(F.sum("n").alias("n"))
    item, target = ("a", "b") if forward else ("b", "a")
    return pairs.select("lang", F.col(item).alias("item"), F.col(target).alias("target"), "n")


def char_sequences(lines: DataFrame, streams: int, length: int) -> DataFrame:
    """(lang, stream, window, input, target) of equal character streams cut into windows.

    The text of a language is cut into ``streams`` equal streams (the remainder goes), each read in
    windows of ``length`` characters with the next character as target. Lines are cut at window borders
    where they lie; only the pieces of one window meet.
    """
    text = F.concat("line", F.lit("\n"))
    placed = with_running_sum(lines, (F.length("line") + 1).cast("bigint"), "o").select(
        "lang", "o", text.alias("t"))
    totals = lines.groupBy("lang").agg(
        F.floor(F.sum((F.length("line") + 1).cast("bigint")) / F.lit(streams)).alias("L"))
    base = placed.join(totals, "lang").where(F.col("L") > 1)
    L, o, n = F.col("L"), F.col("o"), F.length("t").cast("bigint")
    per_stream = F.ceil(L / F.lit(length))

    def cell(at: Column) -> Column:
        return F.floor(at / L) * per_stream + F.floor((at % L) / F.lit(length))

    first = cell(F.greatest(o - 1, F.lit(0)))
    last = F.least(cell(o + n - 1), F.lit(streams) * per_stream - 1)
    spans = base.where(o < L * streams).select(
        "lang", "o", "t", "L", per_stream.alias("W"), F.explode(F.sequence(first, last)).alias("cell"))
    stream = F.floor(F.col("cell") / F.col("W"))
    window = F.col("cell") % F.col("W")
    start = stream * L + window * length
    stop = F.least(start + length + 1, (stream + 1) * L)
    lo, hi = F.greatest(start, o), F.least(stop, o + n)
    pieces = spans.where(hi > lo).select(
        "lang", stream.alias("stream"), window.alias("window"), "o",
        F.substring(F.col("t"), (lo - o + 1).cast("int"), (hi - lo).cast("int")).alias("piece"))
    joined = F.array_join(F.array_sort(F.collect_list(F.struct("o", "piece")))["piece"], "")
    whole = pieces.groupBy("lang", "stream", "window").agg(joined.alias("text")).where(F.length("text") > 1)
    return whole.select(
        "lang", "stream", "window",
        F.expr("substring(text, 1, length(text) - 1)").alias("input"),
        F.expr("substring(text, 2)").alias("target"),
    )


def padded(ids: Column, length: int) -> Column:
    """<s> ids </s>, cut to ``length`` and filled with <pad>."""
    body = F.slice(ids, 1, length - 2)
    seq = F.concat(F.array(F.lit(START)), body.cast("array<int>"), F.array(F.lit(END)))
    return F.concat(seq, F.array_repeat(F.lit(PAD), F.lit(length) - F.size(seq)))


def attention(ids: Column) -> Column:
    return F.transform(ids, lambda t: F.when(t == PAD, 0).otherwise(1))


def masked(ids: Column, share: float, seed: int, epoch: int, *row: Column) -> Column:
    """Replace each pick by <mask>. Any id but <s>, <pad>, </s> can be picked; labels stay whole."""
    def pick(t: Column, p: Column) -> Column:
        u = hash_uniform(seed, F.lit(epoch), *row, p)
        return F.when(~t.isin(*NEVER_MASKED) & (u < share), F.lit(MASK)).otherwise(t)

    return F.transform(ids, pick)


def mlm_rows(encoded: DataFrame, length: int, share: float, seed: int, epoch: int) -> DataFrame:
    """(lang, file, slab, seq, input_ids, attention_mask, labels) for one epoch."""
    rows = encoded.withColumn("labels", padded(F.col("ids"), length))
    return rows.select(
        "lang", "file", "slab", "seq",
        masked(F.col("labels"), share, seed, epoch, F.col("file"), F.col("seq")).alias("input_ids"),
        attention(F.col("labels")).alias("attention_mask"),
        "labels",
    )


def shuffled_batches(lines: DataFrame, batch: int, seed: int, epoch: int) -> DataFrame:
    """Add ``batch`` within (lang, shard) by hash order of the epoch; a short last batch is dropped.

    A shard is a bounded number of lines by definition, so it is one window.
    """
    rows = lines.withColumn("_h", hash_hex(seed, F.lit(epoch), F.col("file"), F.col("seq")))
    w = Window.partitionBy("lang", "shard")
    place = F.row_number().over(w.orderBy("_h", "file", "seq"))
    return (
        rows.withColumn("_r", place - 1).withColumn("_n", F.count("*").over(w))
        .where(F.col("_r") < F.floor(F.col("_n") / F.lit(batch)) * batch)
        .withColumn("batch", F.floor(F.col("_r") / F.lit(batch)).cast("bigint"))
        .drop("_h", "_r", "_n")
    )


def length_batches(lines: DataFrame, length: Column, batch: int = 32, i: str = "ordinal") -> DataFrame:
    """Add ``n_tokens`` and ``batch`` within (lang, shard): rows of like length together."""
    rows = lines.withColumn("n_tokens", length.cast("bigint"))
    place = F.row_number().over(Window.partitionBy("lang", "shard").orderBy("n_tokens", i))
    return rows.withColumn("batch", F.floor((place - 1) / F.lit(batch)).cast("bigint"))
