"""Word, character and tag dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .ordinal import exclusive_scan, range_rank

# Fixed value: the share below which the character dictionary stops.
CHAR_SHARE_FLOOR = 0.00001


def word_counts(tokens: DataFrame, min_count: int = 1) -> DataFrame:
    """(lang, word, n). The count is partial before the shuffle, so frequent words do not weigh."""
    counts = tokens.groupBy("lang", "word").agg(F.count("*").alias("n"))
    return counts if min_count <= 1 else counts.where(F.col("n") >= min_count)


def with_ids(vocab: DataFrame) -> DataFrame:
    """Add ``id``: 0-based rank per language by count, then word."""
    return range_rank(vocab, ["lang"], [F.desc("n"), F.asc("word")], "id")


def capped(vocab: DataFrame, limit: int) -> DataFrame:
    """The most frequent words, at most ``limit`` per language; ties at the cut all go.

    The cut is found on the histogram of counts: T tokens have fewer than sqrt(2T) distinct counts.
    """
    sizes = vocab.groupBy("lang", "n").agg(F.count("*").alias("_words"))
    down = Window.partitionBy("lang").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    cuts = (
        sizes.withColumn("_upto", F.sum("_words").over(down))
        .where(F.col("_upto") <= limit)
        .groupBy("lang").agg(F.min("n").alias("_cut"))
    )
    return vocab.join(cuts, "lang").where(F.col("n") >= F.col("_cut")).drop("_cut")


def char_counts(lines: DataFrame) -> DataFrame:
    """(lang, item, n) over all code points, with one line break per line."""
    chars = lines.select("lang", F.explode(tx.characters(F.concat("line", F.lit("\n")))).alias("item"))
    return chars.where(F.col("item") != "").groupBy("lang", "item").agg(F.count("*").alias("n"))


def char_dictionary(counts: DataFrame) -> DataFrame:
    """(lang, item, idx, n, cum_share): 1-based ids by count, then item; 0 stands for unknown.

    The stop at a small cumulative share can only fire on the first item, and then leaves nothing.
    One window per language is safe: its rows are distinct code points, at most 1,114,112.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("item"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    share = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) / total
    ranked = counts.select("lang", "item", F.row_number().over(order).cast("bigint").alias("idx"), "n",
                           share.alias("cum_share"))
    opens = F.min("cum_share").over(Window.partitionBy("lang"))
    return ranked.withColumn("_opens", opens).where(F.col("_opens") >= CHAR_SHARE_FLOOR).drop("_opens")


def tag_dictionary(tagged: DataFrame) -> DataFrame:
    """(tag, n, idx): distinct tags with 1-based ids by tag."""
    counts = tagged.groupBy("tag").agg(F.count("*").alias("n"))
    return counts.withColumn("idx", F.dense_rank().over(Window.orderBy("tag")).cast("bigint"))


def type_counts(words: DataFrame, chars: DataFrame) -> DataFrame:
    """Distinct words and characters per language, from the counted tables."""
    w = words.groupBy("lang").agg(F.count("*").alias("n_words"))
    c = chars.groupBy("lang").agg(F.count("*").alias("n_chars"))
    return w.join(c, "lang")


def noise_distribution(vocab: DataFrame, exponent: float = 0.75) -> DataFrame:
    """(lang, word, id, n, p, lo, hi): p = n**a / sum n**a and its interval, in order of id."""
    raised = vocab.withColumn("_m", F.pow(F.col("n").cast("double"), F.lit(float(exponent))))
    totals = raised.groupBy("lang").agg(F.sum("_m").alias("_sum"))
    shares = raised.join(totals, "lang").withColumn("p", F.col("_m") / F.col("_sum"))
    placed = exclusive_scan(shares.select("lang", "word", "id", "n", "p"), ["lang"], ["id"], "p", "lo")
    return placed.withColumn("lo", F.col("lo").cast("double")).withColumn("hi", F.col("lo") + F.col("p"))


def keep_probability(n: Column, total: Column, sample: float) -> Column:
    """Chance that one occurrence of a word survives subsampling."""
    f = n.cast("double") / total.cast("double")
    return F.sqrt(F.lit(float(sample)) / f) + F.lit(float(sample)) / f
