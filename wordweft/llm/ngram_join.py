"""Similarity join on word n-grams: MinHash banding, then verification on full n-gram sets.

1. Each text becomes its set of hashed five-word shingles and a MinHash signature. Texts with equal sets are
   copies: they collapse into one node, which counts for all of them.
2. Bands: the signature is cut into ``bands`` bands of ``rows`` values. ``choose_bands`` takes the longest band
   with which a pair at the threshold meets in at least one band with the target probability. Nodes are
   shuffled on their band hashes; buckets of one node are dropped.
3. Inside a bucket, signatures (one byte per value) are compared and the pairs that may reach the threshold
   are joined into a forest; only its edges leave the task. The connected nodes are candidate groups.
4. Inside a candidate group, all pairs are verified on the full sets, exactly. Only the number of links per
   node and a forest of the links leave the task. Components of the links are the classes.

Hot buckets and hot groups are cut into blocks, and each pair of blocks is a task of its own, so no task
holds more than two blocks. Groups are cut in order of set size, and two blocks whose sizes cannot reach the
threshold do not meet.

Nulls: a null text is empty; texts without words are copies of each other. A null doc_id is a document like
any other. Repeated rows are copies. An empty table gives no rows. Extra columns are ignored by
``near_duplicates`` and returned by ``drop_near_duplicates``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, keep, with_fresh
from .graph import components
from .shingles import WORDS, mix64, set_digest, shingle_sets, slices

THRESHOLD = 0.8
#: Wanted probability that a pair at the threshold shares a band, and the most values in a signature.
RECALL, SIGNATURE = 0.9999, 128
#: Pairs whose signatures agree less than this, in standard deviations below the threshold, are no candidates.
DEVIATIONS = 5.0
#: Nodes in a block of a hot bucket and of a candidate group.
BUCKET_BLOCK, GROUP_BLOCK = 1024, 256


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = SIGNATURE) -> tuple[int, int]:
    """(bands, rows): the longest bands that reach the recall with at most ``most`` values."""
    best = None
    for rows in range(1, most + 1):
        missed = 1 - threshold ** rows
        bands = 1 if missed <= 0 else math.ceil(math.log(1 - recall) / math.log(missed))
        if bands * rows > most:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches the recall with so few values")
    return best


def _coefficients(n: int, seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def signature(shingles: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """MinHash values of a set; all ones for the empty set."""
    out = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    top = (shingles >> np.uint64(32)).astype(np.uint32)
    for lo in range(0, len(top), 8192):
        part = top[lo:lo + 8192, None] * factors + terms
        np.minimum(out, part.min(0), out=out)
    return out


def _sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_key, set_id, n, bands array<bigint>, sig binary: one row per document row."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("set_id", pa.string()), ("n", pa.int32()),
                        ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])

    def sketch(batches):
        factors, terms = _coefficients(bands * rows)
        number = np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(40)
        for batch in batches:
            for lo, count in slices(batch.column("text")):
                part = batch.slice(lo, count)
                ids, sizes, keys, sigs = [], [], [], []
                for found in shingle_sets(part.column("text"), words):
                    values = signature(found, factors, terms)
                    key = number
                    for column in values.reshape(bands, rows).T:
                        key = mix64(key * np.uint64(31) + column)
                    ids.append(set_digest(found))
                    sizes.append(len(found))
                    keys.append(key.astype(np.int64) if len(found) else np.zeros(0, np.int64))
                    sigs.append((values & np.uint32(0xFF)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(ids, pa.string()), pa.array(sizes, pa.int32()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], schema=schema)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    return texts.mapInArrow(sketch, "doc_id bigint, text_key bigint, set_id string, n int, bands array<bigint>, sig binary")


def merge_labels(labels: np.ndarray, members: np.ndarray) -> None:
    """Give all items of the members' classes the smallest of their labels, in place."""
    found = np.unique(labels[members])
    if len(found) > 1:
        labels[np.isin(labels, found)] = found[0]


def _groups(batches, keys: list[str]):
    """Consecutive rows with equal keys, as (key, table), across batches that are sorted by the keys."""
    held, held_key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change).tolist() + [batch.num_rows]
        for lo, hi in zip(starts, starts[1:]):
            key = tuple(c[lo] for c in columns)
            if held and key != held_key:
                yield held_key, pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield held_key, pa.Table.from_batches(held)


def _bucket_forest(sigs: np.ndarray, block: np.ndarray, across: bool, least: float) -> np.ndarray:
    """Label (smallest member) of each row, rows being joined where their signatures agree often enough."""
    labels = np.arange(len(sigs))
    for x in range(len(sigs) - 1):
        near = (sigs[x + 1:] == sigs[x]).sum(1) >= least
        if across:
            near &= block[x + 1:] != block[x]
        if near.any():
            merge_labels(labels, np.append(np.flatnonzero(near) + x + 1, x))
    return labels


def _candidate_edges(buckets: DataFrame, least: float, width: int) -> DataFrame:
    """(a, b) forest edges of the nodes of a bucket whose signatures agree in at least ``least`` places."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(key, node, block, sigs, out_a, out_b):
        change = np.append(True, (key[1:] != key[:-1]).any(1))
        starts = np.flatnonzero(change)
        sizes = np.diff(np.append(starts, len(key)))
        first = starts[sizes == 2]  # most buckets hold two nodes: compare them all at once
        near = (sigs[first] == sigs[first + 1]).sum(1) >= least
        near &= (key[first, 1] == key[first, 2]) | (block[first] != block[first + 1])
        out_a.append(node[first[near]])
        out_b.append(node[first[near] + 1])
        for lo, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            rows = slice(lo, lo + size)
            labels = _bucket_forest(sigs[rows], block[rows], key[lo, 1] != key[lo, 2], least)
            moved = np.flatnonzero(labels != np.arange(size))
            out_a.append(node[rows][moved])
            out_b.append(node[rows][labels[moved]])

    def compare(batches):
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("band", "i", "j")], 1)
            node, block = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "block"))
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(-1, width)
            rows = (key, node, block, sigs)
            if rest is not None:
                rows = tuple(np.concatenate(pair) for pair in zip(rest, rows))
            # The last bucket may go on in the next batch.
            last = int(np.flatnonzero((rows[0] != rows[0][-1]).any(1))[-1]) + 1 if (rows[0] != rows[0][-1]).any() else 0
            rest = tuple(r[last:] for r in rows)
            if last:
                out_a, out_b = [], []
                edges(*(r[:last] for r in rows), out_a, out_b)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o), pa.int64()) for o in (out_a, out_b)], schema=schema)
        if rest is not None:
            out_a, out_b = [], []
            edges(*rest, out_a, out_b)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o), pa.int64()) for o in (out_a, out_b)], schema=schema)

    return buckets.mapInArrow(compare, "a bigint, b bigint")


def shared_counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Matrix of intersection sizes. Only shingles of two or more sets make columns."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    used = shared[inverse]
    column, owner = number[inverse][used], owner[used]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    total = np.zeros((m, m), np.float32)
    for lo in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [lo, lo + width])
        part = np.zeros((m, min(width, int(shared.sum()) - lo)), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        total += part @ part.T
    return total


def _verified(pairs: DataFrame, threshold: float) -> DataFrame:
    """(node, root, links): the node's linked documents in this pair of blocks, and its forest root."""
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def verify(batches):
        for (_, i, j), rows in _groups(batches, ["root", "i", "j"]):
            nodes, place = np.unique(rows.column("node").to_numpy(), return_index=True)
            if len(nodes) < 2:
                continue
            blobs = rows.column("shingles").take(pa.array(place)).to_pylist()
            sets = [np.frombuffer(blob, np.uint64) for blob in blobs]
            weight, block = (rows.column(c).to_numpy()[place] for c in ("weight", "block"))
            size = np.array([len(s) for s in sets], np.float64)
            both = shared_counts(sets).astype(np.float64)
            linked = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
            np.fill_diagonal(linked, False)
            if i != j:
                linked &= block[:, None] != block[None, :]
            links = linked @ weight
            labels, some = np.arange(len(nodes)), np.flatnonzero(links)
            for x in some.tolist():
                merge_labels(labels, np.append(np.flatnonzero(linked[x]), x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[some], pa.int64()), pa.array(nodes[labels[some]], pa.int64()),
                 pa.array(links[some].astype(np.int64), pa.int64())], schema=schema)

    return pairs.mapInArrow(verify, "node bigint, root bigint, links bigint")


def _sets_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, root, weight, meetings and the full shingle set, read again from a document of the node."""
    carried = ["node", "root", "weight", "block", "meetings"]

    def read(batches):
        rep, seen = None, set()
        for batch in batches:
            for lo, count in slices(batch.column("text")):
                part = batch.slice(lo, count)
                sets = list(shingle_sets(part.column("text"), words))
                keep_row = []
                # Rows that share a doc_id may bring another node's text, or the same text again.
                for found, wanted, node, of in zip(sets, *(part.column(c).to_pylist() for c in ("set_id", "node", "rep"))):
                    if of != rep:
                        rep, seen = of, set()
                    keep_row.append(node not in seen and set_digest(found) == wanted)
                    if keep_row[-1]:
                        seen.add(node)
                arrays = [*(part.column(c) for c in carried), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*carried, "shingles"]).filter(pa.array(keep_row, pa.bool_()))

    own = docs["doc_id"].cast("bigint").eqNullSafe(nodes["rep"])
    texts = nodes.join(docs, own).select(*carried, "set_id", "rep", "text")
    return texts.mapInArrow(
        read, "node bigint, root bigint, weight bigint, block bigint, meetings array<struct<i:bigint,j:bigint>>, shingles binary")


def _meetings(nodes: DataFrame, threshold: float, size: int) -> DataFrame:
    """Add the node's block in its candidate group, and the pairs of blocks in which it is compared.

    Sets that reach the threshold are at most one size step apart, so a block meets the blocks of its own
    step and of the steps beside it.
    """
    wide, step_wide = 1 << 32, math.log(1 / threshold) * (1 + 1e-9)
    step = F.floor(F.log(F.greatest(F.col("n"), F.lit(1)).cast("double")) / step_wide)
    nodes = nodes.withColumn("step", step)
    sizes = nodes.groupBy("root", "step").agg(F.ceil(F.count("*") / size).alias("blocks"))
    above = sizes.select("root", (F.col("step") - 1).alias("step"), F.col("blocks").alias("above"))
    below = sizes.select("root", (F.col("step") + 1).alias("step"), F.col("blocks").alias("below"))
    sizes = keep(sizes.join(above, ["root", "step"], "left").join(below, ["root", "step"], "left"), "group-sizes")

    def with_blocks(step, blocks, meet):
        numbers = F.when(blocks > 0, F.sequence(F.lit(0).cast("bigint"), blocks - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(numbers, lambda k: meet(step * wide + k))

    block = F.col("block")
    pair = lambda x: F.struct(F.least(block, x).alias("i"), F.greatest(block, x).alias("j"))
    return (
        nodes.join(sizes, ["root", "step"])
        .withColumn("block", F.col("step") * wide + F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("meetings", F.concat(
            with_blocks(F.col("step"), F.col("blocks"), pair),
            with_blocks(F.col("step") + 1, F.coalesce("above", F.lit(0).cast("bigint")), pair),
            with_blocks(F.col("step") - 1, F.coalesce("below", F.lit(0).cast("bigint")), pair)))
    )


def _classes(docs: DataFrame, threshold: float, words: int, recall: float, bucket_block: int,
             group_block: int) -> tuple[DataFrame, DataFrame]:
    """The sketches (one row per document row), and per set_id: class root, class columns and links."""
    bands, rows = choose_bands(threshold, recall)
    width = bands * rows
    texts = doc_text(docs)
    sketches = keep(_sketches(texts, words, bands, rows), "sketches")
    nodes = keep(
        sketches.groupBy("set_id").agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("weight"), F.first("n").alias("n"),
            F.first("bands").alias("bands"), F.first("sig").alias("sig"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")

    members = nodes.select("node", F.explode("bands").alias("band"))
    met = members.groupBy("band").agg(F.count("*").alias("count")).where("count > 1")
    blocks = F.ceil(F.col("count") / bucket_block)
    spread = (
        members.join(met, "band").withColumn("block", F.pmod(F.xxhash64("node"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .select("node", "band", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )
    parts = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    buckets = (
        spread.join(nodes.select("node", "sig"), "node")
        .repartition(parts, "band", "i", "j").sortWithinPartitions("band", "i", "j")
    )
    least = width * threshold - DEVIATIONS * math.sqrt(width * threshold * (1 - threshold))
    candidates = components(_candidate_edges(buckets, least, width))

    grouped = _meetings(nodes.drop("bands", "sig").join(candidates, "node"), threshold, group_block)
    pairs = _sets_of(texts, grouped, words).withColumn("meeting", F.explode("meetings")).select(
        "node", "root", "weight", "block", "meeting.i", "meeting.j", "shingles")
    pairs = pairs.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j")
    verified = keep(_verified(pairs, threshold), "verified")

    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = (
        nodes.select("node", "set_id", "rep", "weight").join(links, "node", "left").join(linked, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    known = keep(known, "classes")
    classes = known.groupBy("root").agg(F.min("rep").alias("class_id"), F.sum("weight").alias("class_size"))
    return sketches, known.join(classes, "root").select(
        "set_id", "root", "class_id", "class_size", F.col("rep").alias("copy_id"), F.col("weight").alias("copies"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, recall: float = RECALL,
                    bucket_block: int = BUCKET_BLOCK, group_block: int = GROUP_BLOCK) -> DataFrame:
    """One row per document row: doc_id, class_id, class_size, copy_id, copies, n_links.

    ``copy_id`` and ``class_id`` are the smallest doc_id among the copies and in the class; ``n_links`` counts
    the other documents whose n-gram sets have a Jaccard likeness of at least ``threshold``, copies included.
    """
    sketches, classes = _classes(docs, threshold, words, recall, bucket_block, group_block)
    return sketches.select("doc_id", "set_id").join(classes, "set_id").select(
        "doc_id", "class_id", "class_size", "copy_id", "copies", "n_links")


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one with the smallest doc_id, with all its columns."""
    sketches, classes = _classes(docs, threshold, WORDS, RECALL, BUCKET_BLOCK, GROUP_BLOCK)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    stay = (
        sketches.join(classes.select("set_id", "root"), "set_id").groupBy("root").agg(F.min(order).alias("stay"))
        .select("stay.doc_id", "stay.text_key").distinct()
    )
    key, of, doc = (with_fresh(docs, c) for c in ("_key", "_of", "_doc"))
    stay = stay.toDF(doc, of)
    marked = docs.withColumn(key, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return (
        marked.join(stay, (F.col(key) == F.col(of)) & F.col("doc_id").cast("bigint").eqNullSafe(F.col(doc)))
        .dropDuplicates([key, "doc_id"]).select(*docs.columns)
    )
