"""Document fingerprints from spot signatures.

A spot is a common word (anchor); its signature hashes the anchor with the next CHAIN content words, anchors
being skipped and every DISTANCE-th content word taken. The fingerprint is the sorted bag of a text's
signatures, eight hex digits each. Likeness is the Jaccard coefficient of two bags.

``fingerprints`` also compares each document with its successor in doc_id order and with an edited version of
itself. Documents are cut into blocks of consecutive ids and stream through their task in order; the first
document of a block travels to the block before it as well, so the text is shuffled once.

``similar_pairs`` joins fingerprints at a threshold: equal ones collapse, the others are partitioned by bag
size, so that only partitions that can reach the threshold meet, and are compared only where they share one
of their rarest signatures (the prefix that a pair at the threshold cannot avoid sharing).

Nulls: a null text is empty, its fingerprint is empty and equals other empty ones (likeness 1, else 0). A text
without a full chain gets one signature of its whole text. A null doc_id sorts first. Rows that share a
doc_id are ordered by text. One row is its own successor; an empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, keep, tasks_for
from .shingles import mix64, slices

#: Anchors: common words of the four languages (a parameter; any list of frequent words serves).
ANCHORS = frozenset(
    "the a an is was are be of and that to in it for der die das ist und ein eine von den zu nicht mit "
    "le la les des est et un une de du que pour el los es y una en por con del".split())
CHAIN, DISTANCE = 2, 1
THRESHOLD = 0.8
_NO_WORD = r"[^\pL\pN]+"


def bags(texts: pa.Array, anchors=ANCHORS, chain: int = CHAIN, distance: int = DISTANCE) -> list[np.ndarray]:
    """The sorted 32-bit signatures of each text, repeats included."""
    import xxhash
    # Trimmed first: the split kernel looks past the end of a batch whose last text ends in white space.
    words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), _NO_WORD, " ")))
    flat = words.flatten()
    ends = np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    coded = flat.dictionary_encode()
    distinct, index = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))
    kind = np.fromiter((0 if not w else 1 if w in anchors else 2 for w in distinct), np.int8, len(distinct))[index]
    hashes = hashed[index]
    content = np.flatnonzero(kind == 2)
    spots = np.flatnonzero(kind == 1)
    text_of = np.repeat(np.arange(len(texts)), np.diff(np.append(0, ends)))
    first = np.searchsorted(content, spots)
    last = first + (chain - 1) * distance
    whole = last < len(content)
    spots, first, last = spots[whole], first[whole], last[whole]
    whole = text_of[content[last]] == text_of[spots]  # the chain ends inside the text
    spots, first = spots[whole], first[whole]
    signature = hashes[spots]
    for k in range(chain):
        signature = mix64(signature * np.uint64(31) + hashes[content[first + k * distance]])
    signature = (signature >> np.uint64(32)).astype(np.uint32)
    bounds = np.searchsorted(text_of[spots], np.arange(len(texts) + 1))
    out = []
    for k, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if hi > lo:
            out.append(np.sort(signature[lo:hi]))
        else:
            text = texts[k].as_py()
            digest = hashlib.blake2b(text.encode(), digest_size=4).digest()
            out.append(np.frombuffer(digest, "<u4") if text else np.zeros(0, np.uint32))
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard coefficient of two sorted bags; two empty bags are alike."""
    if len(a) == len(b) and (a == b).all():
        return 1.0
    both, times = np.unique(np.concatenate([a, b]), return_counts=True)
    if len(both) == len(a) + len(b):
        return 0.0
    in_a = np.searchsorted(a, both, "right") - np.searchsorted(a, both, "left")
    least = np.minimum(in_a, times - in_a).sum()
    return float(least / (len(a) + len(b) - least))


def text_of_bag(bag: np.ndarray) -> str:
    return bag.astype(">u4").tobytes().hex()


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _in_order(docs: DataFrame) -> DataFrame:
    """block, tail, doc_id, text: blocks of consecutive ids, each followed by the document after it."""
    parts = tasks_for(docs)
    order = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("k")
    keys = docs.select(order)
    # The cuts and heads below are one number per block.
    cuts = keys.approxQuantile("k", [i / (4 * parts) for i in range(1, 4 * parts)], 0.1 / parts)
    cuts = np.unique(np.array(cuts, np.float64)).astype(np.int64)

    @F.pandas_udf("bigint")
    def block_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, k.to_numpy(np.int64), "right"))

    heads = {r["block"]: r["k"] for r in keys.groupBy(block_of("k").alias("block")).agg(F.min("k").alias("k")).collect()}
    names = sorted(heads)
    before = {b: names[i - 1] for i, b in enumerate(names)}

    @F.pandas_udf("array<bigint>")
    def blocks_of(k: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, k.to_numpy(np.int64), "right").tolist()
        # Even numbers: the document's own block; odd: it follows that block.
        return pd.Series([[2 * b, 2 * before[b] + 1] if heads[b] == v else [2 * b] for b, v in zip(own, k.tolist())])

    rows = doc_text(docs).withColumn("k", order).withColumn("at", F.explode(blocks_of("k")))
    rows = rows.select("doc_id", "text", "k", F.shiftright("at", 1).alias("block"), (F.col("at") % 2 == 1).alias("tail"))
    return rows.repartition(parts, "block").sortWithinPartitions("block", "tail", "k", "text").drop("k")


def fingerprints(docs: DataFrame, anchors=ANCHORS, chain: int = CHAIN, distance: int = DISTANCE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def compare(rows: list[tuple]):
        """Rows in order, the last one only as a successor."""
        own = bags(pa.array([r[1] for r in rows], pa.string()), anchors, chain, distance)
        used = [k for k in range(len(rows) - 1) if not rows[k][3]]
        edited = [edit(rows[k][1], rows[k + 1][1]) for k in used]
        changed = bags(pa.array(edited, pa.string()), anchors, chain, distance)
        return pa.RecordBatch.from_arrays([
            pa.array([rows[k][0] for k in used], pa.int64()), pa.array([len(rows[k][1]) for k in used], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([text_of_bag(own[k]) for k in used], pa.string()), pa.array([text_of_bag(b) for b in changed], pa.string()),
            pa.array([likeness(own[k], b) for k, b in zip(used, changed)], pa.float64()),
            pa.array([likeness(own[k], own[k + 1]) for k in used], pa.float64())], schema=schema)

    def stream(batches):
        held: list[tuple] = []
        for batch in batches:
            for lo, count in slices(batch.column("text")):
                part = batch.slice(lo, count)
                held += zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "block", "tail")))
                yield compare(held)
                held = held[-1:]

    return _in_order(docs).mapInArrow(stream, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                                              "edited_fingerprint string, near_edited double, near_next double")


def similar_pairs(prints: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, fingerprint -> (a, b, likeness): pairs of different fingerprints at the threshold, named by the
    smallest doc_id that has them."""
    eight = F.filter(F.split(F.regexp_replace("fingerprint", "(.{8})", "$1 "), " "), lambda s: s != "")
    place = F.transform(eight, lambda s, k: F.concat(s, F.lit("."), F.size(F.filter(F.slice(eight, 1, k), lambda t: t == s)).cast("string")))
    bag = keep(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("a")).where("fingerprint <> ''")
               .withColumn("bag", place).withColumn("n", F.size("bag")), "bags")
    # Rarest first: the prefix of a bag holds its n - ceil(threshold * n) + 1 rarest signatures.
    each = bag.select("fingerprint", "n", F.explode("bag").alias("s"))
    rank = F.array_sort(F.collect_list(F.struct("df", "s")))
    prefix = (
        each.join(each.groupBy("s").agg(F.count("*").alias("df")), "s").groupBy("fingerprint", "n").agg(rank.alias("all"))
        .withColumn("prefix", F.slice("all", F.lit(1), (F.col("n") - F.ceil(F.col("n") * threshold) + 1).cast("int")))
        .select("fingerprint", "n", F.explode("prefix.s").alias("s"))
    )
    part = F.floor(F.log(F.col("n").cast("double")) / (math.log(1 / threshold) * (1 + 1e-9)))
    left = prefix.select(F.col("fingerprint").alias("f"), F.col("n").alias("m"), "s", part.alias("part"))
    right = prefix.withColumn("part", F.explode(F.array(part, part - 1)))
    met = (
        left.join(right, ["s", "part"]).where("m < n OR (m = n AND f < fingerprint)").where(F.col("m") >= F.col("n") * threshold - 1e-9)
        .select("f", "fingerprint").distinct()
    )
    x, y = bag.select(F.col("fingerprint").alias("f"), F.col("a"), F.col("bag").alias("x")), bag.select("fingerprint", F.col("a").alias("b"), F.col("bag").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        met.join(x, "f").join(y, "fingerprint")
        .withColumn("likeness", both / (F.size("x") + F.size("y") - both)).where(F.col("likeness") >= threshold - 1e-9)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")
    )
