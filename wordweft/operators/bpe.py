"""Byte-level byte-pair encoding: pre-tokens, training on distinct words, encoding."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .merges import PASSES, learn_merges, merge_passes, merge_symbols, ranks_of

# The published pre-token pattern, and the special tokens in id order.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIALS = ["<s>", "<pad>", "</s>", "<unk>", "<mask>"]
MIN_FREQUENCY = 3
# Longest word that an encoding task remembers.
MEMO_CHARS = 64


def byte_alphabet() -> list[str]:
    """Printable stand-in of each byte: itself where Latin-1 prints it, else 256, 257, ... in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    stand_in, next_free = [], 256
    for byte in range(256):
        if byte in printable:
            stand_in.append(chr(byte))
        else:
            stand_in.append(chr(next_free))
            next_free += 1
    return stand_in


def to_symbols(pretoken: Column) -> Column:
    """UTF-8 bytes of a pre-token as one printable character each."""
    alphabet = byte_alphabet()
    hidden = [b for b in range(256) if alphabet[b] != chr(b)]
    latin = F.decode(F.encode(pretoken, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, "".join(map(chr, hidden)), "".join(alphabet[b] for b in hidden))


def pretokens(line: Column) -> Column:
    """Pieces of a line; a word keeps the space in front of it."""
    return F.regexp_extract_all(line, F.lit(f"(?U)({PRETOKEN})"), F.lit(1))


def pretoken_counts(lines: DataFrame) -> DataFrame:
    """(pretoken, n) over the whole corpus; this is the only pass over text that training makes."""
    pieces = lines.select(F.explode(pretokens(F.col("line"))).alias("pretoken"))
    return pieces.groupBy("pretoken").agg(F.count("*").alias("n"))


def symbol_table(counts: DataFrame) -> DataFrame:
    """(symbols, n): distinct pre-tokens as symbols with a space between them."""
    spaced = F.array_join(F.split(to_symbols(F.col("pretoken")), "", -1), " ")
    return counts.select(F.trim(spaced).alias("symbols"), "n")


def pair_counts(table: DataFrame) -> DataFrame:
    """(left, right, n): adjacent symbol pairs, weighted by the count of the word."""
    parts = table.select(F.split("symbols", " ", -1).alias("s"), "n").where(F.size("s") > 1)
    pairs = parts.select("n", F.explode(F.arrays_zip(
        F.slice("s", 1, F.size("s") - 1).alias("left"), F.slice("s", 2, F.size("s") - 1).alias("right"))).alias("p"))
    return pairs.groupBy("p.left", "p.right").agg(F.sum("n").alias("n"))


def train_bpe(counts: DataFrame, vocab_size: int, min_frequency: int = MIN_FREQUENCY, **limits) -> list[tuple[str, str]]:
    """Merges in rank order, until ``vocab_size`` or until no pair is frequent enough. Pairs rank by (count, left, right).

    ``limits``: see ``learn_merges``.
    """
    return learn_merges(counts, vocab_size - len(SPECIALS) - 256, min_frequency, byte_alphabet(), **limits)


def bpe_tables(spark: SparkSession, merges: list[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(token, id) with specials first, then bytes, then merges; and (rank, left, right)."""
    tokens = SPECIALS + sorted(byte_alphabet()) + [a + b for a, b in merges]
    ids = list(dict.fromkeys(tokens))
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(ids)], "token string, id bigint")
    ranks = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(merges)],
                                  "rank bigint, left string, right string")
    return vocab, ranks


def encoder(merges: list[tuple[str, str]], raw: bool = False):
    """Arrow UDF: array of pre-token symbol strings (``raw``: of pre-tokens) -> array of token ids.

    The merge list is bounded by the vocabulary size. Lines are encoded where they are, the distinct pieces of a batch
    once: few merges in one pass each over all of them, many word by word (a bounded memo spans batches). So no token is
    shuffled to a word table and back.
    """
    ranks, merged, alphabet = ranks_of(merges), [a + b for a, b in merges], byte_alphabet()
    tokens = SPECIALS + sorted(alphabet) + merged
    ids = {t: i for i, t in enumerate(dict.fromkeys(tokens))}
    of_byte = np.array([ids[c] for c in alphabet], np.int32)
    of_char = np.zeros(max(map(ord, alphabet)) + 1, np.int32)
    of_char[[ord(c) for c in alphabet]] = of_byte
    # A text that two merges make may be merged on by a rank that has passed.
    in_passes = len(merges) <= PASSES and len({*merged}) == len(merged)
    numbered = [(ids[a], ids[b]) for a, b in merges], [ids[t] for t in merged]

    def spell(word: str) -> tuple[int, ...]:
        parts = [alphabet[b] for b in word.encode()] if raw else list(word)
        return tuple([ids[p] for p in merge_symbols(parts, ranks, merged)])

    def encoded(words: pa.Array, short) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        if not in_passes:
            known = [short(w) if len(w) <= MEMO_CHARS else spell(w) for w in words.to_pylist()]
            sizes = np.fromiter(map(len, known), np.int64, len(known))
            return np.fromiter((i for k in known for i in k), np.int32, int(sizes.sum())), sizes
        if raw:
            symbols = of_byte[np.frombuffer(b"".join(words.cast(pa.binary()).to_pylist()), np.uint8)]
            sizes = pc.binary_length(words).to_numpy(zero_copy_only=False)
        else:
            symbols = of_char[np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)]
            sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False)
        flat, word = merge_passes(symbols, np.repeat(np.arange(len(words)), sizes), *numbered)
        return flat, np.bincount(word, minlength=len(words))

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        short = lru_cache(maxsize=1 << 16)(spell)
        for batch in batches:
            lengths = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            pieces = batch.flatten().dictionary_encode()
            at = pieces.indices.to_numpy(zero_copy_only=False)
            pool, sizes = encoded(pieces.dictionary, short)
            size = sizes[at]
            ends = np.cumsum(size)
            flat = pool[np.repeat((np.cumsum(sizes) - sizes)[at] - (ends - size), size) + np.arange(int(size.sum()))]
            stops = np.append(0, ends)[np.append(0, np.cumsum(lengths))]
            yield pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(flat.astype(np.int32)))

    return encode


def decoder(merges: list[tuple[str, str]]):
    """Arrow UDF: array of token ids -> text. Special tokens spell nothing."""
    tokens = list(dict.fromkeys(SPECIALS + sorted(byte_alphabet()) + [a + b for a, b in merges]))
    byte_of = {c: bytes([b]) for b, c in enumerate(byte_alphabet())}
    spelled = [b"" if t in SPECIALS else b"".join(byte_of[c] for c in t) for t in tokens]
    pool, sizes = np.frombuffer(b"".join(spelled), np.uint8), np.array([len(t) for t in spelled], np.int64)
    starts = np.cumsum(sizes) - sizes

    @F.arrow_udf("string")
    def decode(batch: pa.Array) -> pa.Array:
        lengths = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ids = batch.flatten().to_numpy(zero_copy_only=False)
        size = sizes[ids]
        ends = np.cumsum(size)
        raw = pool[np.repeat(starts[ids] - (ends - size), size) + np.arange(int(size.sum()))]
        stops = np.append(0, ends)[np.append(0, np.cumsum(lengths))]
        text = pa.StringArray.from_buffers(len(batch), pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(raw))
        try:
            text.validate(full=True)
        except pa.ArrowInvalid:  # ids that cut a character in two
            text = pa.array([raw[i:j].tobytes().decode("utf-8", "replace") for i, j in zip(stops[:-1], stops[1:])], pa.string())
        return text

    return decode


def encode_text(lines: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """(lang, file, slab, seq, ids): token ids of each whole line, without boundary ids."""
    return lines.select("lang", "file", "slab", "seq", encoder(merges, raw=True)(pretokens(F.col("line"))).alias("ids"))
