"""Exact duplicates through an extendible-hash index that lives in shared files.

Texts that are equal after lower-casing A-Z share a 64-bit key. The directory of the index maps the
leading key bits to buckets: it starts as one bucket and doubles while a bucket holds more distinct
keys than its capacity; only overfull buckets split. Rows are routed by the directory. The task that gets a key
holds the chain of its texts, told apart by their bytes; a chain of one text decides ``keep_id`` and
``group_size`` at once, the rows of a longer one are grouped by text. The owner of a bucket numbers the links of its
chains and writes them as one folder in the shared checkpoint folder, where rows look themselves up through the
directory, with a SHA-256 in place of their text.

Hot groups: chains and counts are built in the map tasks already, so a group of any size reaches
its owner as one text per map task. Nulls: a null text is empty; a null doc_id loses against any other.
Repeated rows (equal doc_id and text) form one group: each row counts, and one of them stays. An empty
table gives no rows. Extra columns are ignored by ``find_copies`` and returned by ``drop_copies``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_text, keep, with_fresh

#: Distinct keys per bucket, and the deepest directory: 2**20 entries.
CAPACITY = 65_536
MAX_DEPTH = 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the byte-wise way, which gives the same."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))


def directory(counts: dict[int, int], depth: int, capacity: int) -> list[tuple[int, int, int]]:
    """(cell, bucket, local depth) for each of the 2**depth cells of leading key bits.

    Splitting starts from one bucket at depth 0. An overfull bucket is split on its next bit; a split
    below the global depth redirects half of its cells, a split at the global depth doubles it.
    """
    cells = []
    stack = [(0, 0)]  # (prefix, local depth)
    while stack:
        prefix, local = stack.pop()
        low, high = prefix << (depth - local), (prefix + 1) << (depth - local)
        held = sum(counts.get(c, 0) for c in range(low, high))
        if held > capacity and local < depth:
            stack += [(2 * prefix, local + 1), (2 * prefix + 1, local + 1)]
        else:
            cells += [(c, low, local) for c in range(low, high)]
    return sorted(cells)


def text_key(norm: Column, key_bits: int = 64) -> Column:
    """64-bit key of a normalised text; fewer leading bits on request, so that tests can force collisions."""
    key = F.xxhash64(norm)
    return key if key_bits == 64 else F.shiftleft(F.shiftrightunsigned(key, 64 - key_bits), 64 - key_bits)


def grow(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> tuple[list[tuple[int, int, int]], int]:
    """The directory of a table of distinct keys, and its depth. At most 2**max_depth counts reach the driver."""
    depth = 0
    while True:
        cell = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("bigint")
        counts = {r["cell"]: r["count"] for r in keys.groupBy(cell.alias("cell")).count().collect()}
        cells = directory(counts, depth, capacity)
        held: dict[int, int] = {}
        for c, bucket, _ in cells:
            held[bucket] = held.get(bucket, 0) + counts.get(c, 0)
        fullest = max(held.values())
        if fullest <= capacity or depth == max_depth:
            return cells, depth
        # As many doublings as the fullest bucket needs where its keys are spread evenly.
        depth = min(max_depth, depth + math.ceil(math.log2(fullest / capacity)))


@dataclass
class CopyIndex:
    """``links``: bucket, key, chain, text_sha256, keep_id, group_size, depth; ``layout``: cell, bucket, depth."""

    links: DataFrame
    layout: DataFrame
    depth: int

    def route(self, rows: DataFrame, key: str = "key", bucket: str = "bucket") -> DataFrame:
        return _routed(rows, self.layout.select("cell", F.col("bucket").alias(bucket)), self.depth, key)


def _routed(rows: DataFrame, layout: DataFrame, depth: int, key: str = "key") -> DataFrame:
    cell = with_fresh(rows, "_cell")
    at = F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")
    return rows.withColumn(cell, at).join(F.broadcast(layout.withColumnRenamed("cell", cell)), cell).drop(cell)


def copy_index(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = 64, max_depth: int = MAX_DEPTH) -> CopyIndex:
    """The index of all distinct texts."""
    spark = docs.sparkSession
    norm = fold_ascii(F.col("text"))
    rows = doc_text(docs).select("doc_id", norm.alias("norm"), text_key(norm, key_bits).alias("key"))
    cells, depth = grow(keep(rows.select("key").distinct(), "copy-keys"), capacity, max_depth)
    layout = spark.createDataFrame(cells, "cell bigint, bucket bigint, depth int")
    routed = _routed(rows, layout, depth)
    counted = F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    chains = keep(
        routed.groupBy("bucket", "depth", "key").agg(F.collect_set("norm").alias("chain"), *counted)
        .select("bucket", "depth", "key", F.size("chain").alias("links"), F.sha2(F.get("chain", F.lit(0)), 256).alias("text_sha256"),
                "keep_id", "group_size"),
        "copy-chains")
    found = chains.where("links = 1").drop("links")
    collided = chains.where("links > 1").select("bucket", "key")
    if not collided.isEmpty():
        found = found.unionByName(
            routed.join(collided, ["bucket", "key"], "left_semi").groupBy("bucket", "depth", "key", "norm").agg(*counted)
            .withColumn("text_sha256", F.sha2("norm", 256)).drop("norm"))
    chain = Window.partitionBy("bucket", "key").orderBy("text_sha256")
    owned = (
        found.repartition(len({b for _, b, _ in cells}), "bucket").withColumn("chain", F.row_number().over(chain) - 1)
        .select("key", "text_sha256", "keep_id", "group_size", "depth", "chain", "bucket")
    )
    return CopyIndex(keep(owned, "copy-index", "bucket"), layout, depth)


def find_copies(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = 64) -> DataFrame:
    """One row per document row: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain."""
    index = copy_index(docs, capacity, key_bits)
    norm = fold_ascii(F.col("text"))
    probes = doc_text(docs).select("doc_id", text_key(norm, key_bits).alias("key"), F.sha2(norm, 256).alias("text_sha256"))
    first = F.row_number().over(Window.partitionBy("doc_id", "text_sha256").orderBy("key")) == 1
    return (
        index.route(probes).join(index.links, ["bucket", "key", "text_sha256"])
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")) & first)
        .select("doc_id", "keep_id", "group_size", "kept", "text_sha256", "bucket", "chain")
    )


def drop_copies(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The documents that stay, with all their columns."""
    index = copy_index(docs, capacity)
    bucket, key, sha, keep_id = (with_fresh(docs, c) for c in ("_bucket", "_key", "_sha", "_keep"))
    norm = fold_ascii(F.coalesce(F.col("text"), F.lit("")))
    marked = index.route(docs.withColumn(key, text_key(norm)).withColumn(sha, F.sha2(norm, 256)), key, bucket)
    links = index.links.select("bucket", "key", "text_sha256", "keep_id").toDF(bucket, key, sha, keep_id)
    return (
        marked.join(links, [bucket, key, sha])
        .where(F.col("doc_id").eqNullSafe(F.col(keep_id)))
        .dropDuplicates([key, sha]).select(*docs.columns)
    )
