"""Token ids on disk in directly addressable codes: any token can be read without decoding what lies before it.

An id is split into chunks, lowest bits first. Level 0 holds the first chunk of every id at a fixed width, level k
the (k+1)-th chunk of those ids that have one. Each level but the last has a continuation bitmap (does this id go
on?) and a rank directory (set bits before each 512-bit block), so the place of an id in the next level is one
directory entry and at most 64 bytes of bitmap away. The widths, in half bytes, are those that store the file's ids in
the fewest bits, by dynamic programming over their lengths.

A file: magic, sections (document ids, token starts, levels), footer in JSON, footer length. Tasks write whole
files into the shared folder; only files that the manifest names count, and Spark commits the manifest, so a
repeated task leaves nothing but an unnamed file. Documents are range-partitioned by doc_id: file_no ascends
with it, and the tokens before a file are a scan over the manifest.

Nulls: a null text is empty and holds the end id alone; null doc_ids come first. Rows that share a doc_id are
ordered by a hash of their text; equal rows are written each for itself. An empty table gives no file. Extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordinal import exclusive_scan
from .common import doc_text, keep, shared_file_system, shared_folder, tasks_for
from .packing import WordEncoder, slices, vocabulary_path

MAGIC = b"tokdac1\n"
#: Tokens after which a task starts its next file; a document is never cut.
FILE_TOKENS = 16_000_000
#: Tokens that a reader decodes at a time, and bits under one entry of a rank directory.
RUN_TOKENS, BLOCK_BITS = 1 << 20, 512
#: Chunk widths are whole numbers of half bytes.
UNIT = 4

MANIFEST = "file_no bigint, path string, n_docs bigint, n_tokens bigint, n_bytes bigint"


def best_widths(over: list[int]) -> list[int]:
    """Chunk widths that store values in the fewest bits; ``over[k]`` counts the values that need more than k units of
    UNIT bits, ``over[0]`` all values."""
    top = max([k for k, n in enumerate(over) if n], default=0) + 1
    cost, first = [0] * (top + 1), [0] * (top + 1)
    for at in range(top - 1, -1, -1):
        cost[at], first[at] = min((over[at] * (UNIT * w + (at + w < top)) + cost[at + w], w) for w in range(1, top - at + 1))
    widths, at = [], 0
    while at < top:
        widths.append(UNIT * first[at])
        at += first[at]
    return widths


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, end to end, the lowest first; a whole number of units each."""
    units = width // UNIT
    flat = np.zeros(len(values) * units + 1, np.uint8)
    for k in range(units):
        flat[k:-1:units] = (values >> np.uint32(UNIT * k)).astype(np.uint8) & 15
    return (flat[:-1:2] | flat[1::2] << 4)[:-(-len(values) * units // 2)].tobytes()


def unpack_bits(raw: bytes, skip: int, count: int, width: int) -> np.ndarray:
    """``count`` values of ``width`` bits, the first one ``skip`` bits into ``raw``."""
    units, packed = width // UNIT, np.frombuffer(raw, np.uint8)
    flat = np.empty(2 * len(packed), np.uint8)
    flat[::2], flat[1::2] = packed & 15, packed >> 4
    flat = flat[skip // UNIT:skip // UNIT + count * units]
    out = flat[::units].astype(np.uint32)
    for k in range(1, units):
        out |= flat[k::units].astype(np.uint32) << np.uint32(UNIT * k)
    return out


def encode_levels(ids: np.ndarray) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(width, chunks, continuation bitmap, rank directory) of each level; the last has neither bitmap nor directory."""
    widths, values = best_widths([len(ids), *(int(np.count_nonzero(ids >> np.uint32(UNIT * k))) for k in range(1, 32 // UNIT))]), ids
    for k, width in enumerate(widths):
        chunks = pack_bits(values, width)
        if k == len(widths) - 1:
            yield width, chunks, b"", b""
            return
        rest = values >> np.uint32(width)
        goes_on = rest != 0
        bitmap = np.packbits(goes_on, bitorder="little")
        blocks = np.add.reduceat(np.bitwise_count(bitmap).astype(np.uint64), np.arange(0, len(bitmap), BLOCK_BITS // 8))
        directory = (np.cumsum(blocks) - blocks).astype("<u8")
        yield width, chunks, bitmap.tobytes(), directory.tobytes()
        values = rest[goes_on]


def write_file(out, doc_ids: list, ids: list[np.ndarray]) -> int:
    """Write one file to an open stream; returns its bytes. ``doc_ids`` ascend, nulls first."""
    place, footer = 0, {"n_null": sum(d is None for d in doc_ids), "n_docs": len(ids)}

    def section(raw: bytes) -> list[int]:
        nonlocal place
        out.write(raw)
        place += len(raw)
        return [place - len(raw), len(raw)]

    section(MAGIC)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.concatenate(ids).astype(np.uint32, copy=False)
    footer["n_tokens"] = len(flat)
    footer["doc_ids"] = section(np.array([d for d in doc_ids if d is not None], "<i8").tobytes())
    footer["starts"] = section((np.cumsum(sizes) - sizes).astype("<i8").tobytes())
    footer["levels"] = [{"width": width, "chunks": section(chunks), "bitmap": section(bitmap), "ranks": section(ranks)}
                        for width, chunks, bitmap, ranks in encode_levels(flat)]
    tail = json.dumps(footer).encode()
    section(tail)
    section(len(tail).to_bytes(8, "little"))
    return place


class TokenFile:
    """Reads any run of tokens, or any document, of a file by its place; only those bytes are fetched."""

    def __init__(self, handle):
        self.handle, end = handle, handle.size()
        tail = int.from_bytes(handle.read_at(8, end - 8), "little")
        footer = json.loads(handle.read_at(tail, end - 8 - tail))
        if handle.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a file of token ids")
        self.n_docs, self.n_tokens, self.n_null, self.levels = (footer[k] for k in ("n_docs", "n_tokens", "n_null", "levels"))
        self.places = {k: footer[k] for k in ("doc_ids", "starts")}

    def _longs(self, name: str) -> np.ndarray:
        at, size = self.places[name]
        return np.frombuffer(self.handle.read_at(size, at), "<i8")

    def doc_ids(self) -> list:
        return [None] * self.n_null + self._longs("doc_ids").tolist()

    def starts(self) -> np.ndarray:
        """Start of each document, and the end of the last."""
        return np.append(self._longs("starts"), self.n_tokens)

    def _rank(self, level: dict, place: int) -> int:
        """Ids before ``place`` in a level that go on in the next."""
        block = place // BLOCK_BITS
        before = int.from_bytes(self.handle.read_at(8, level["ranks"][0] + 8 * block), "little") if place else 0
        start = block * BLOCK_BITS // 8
        part = np.frombuffer(self.handle.read_at(-(-place // 8) - start, level["bitmap"][0] + start), np.uint8)
        return before + int(np.unpackbits(part, bitorder="little")[:place - 8 * start].sum())

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Token ids from ``start`` up to ``stop``."""
        if not 0 <= start <= stop <= self.n_tokens:
            raise IndexError(f"tokens {start}..{stop} of {self.n_tokens}")
        out, going, shift = np.zeros(stop - start, np.uint32), None, 0
        count = stop - start
        for k, level in enumerate(self.levels):
            if count == 0:
                break
            width, first = level["width"], start * level["width"]
            raw = self.handle.read_at(-(-(first + count * width) // 8) - first // 8, level["chunks"][0] + first // 8)
            chunks = unpack_bits(raw, first % 8, count, width) << np.uint32(shift)
            if going is None:
                out, going = chunks.copy(), np.arange(count)
            else:
                out[going] |= chunks
            shift += width
            if k < len(self.levels) - 1:
                raw = self.handle.read_at(-(-(start + count) // 8) - start // 8, level["bitmap"][0] + start // 8)
                on = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[start % 8:start % 8 + count].astype(bool)
                start, going = self._rank(level, start), going[on]
                count = len(going)
        return out

    def token(self, place: int) -> int:
        return int(self.ids(place, place + 1)[0])


def write(docs: DataFrame, path: str | None = None, file_tokens: int = FILE_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """Encode every document and write token files; returns the manifest (``MANIFEST`` and ``first``, the tokens
    of all files before). ``path`` is a folder that driver and executors share, by default a new one below the
    shared checkpoint folder; ``vocabulary`` is the path of a vocabulary file, by default each worker's own."""
    folder = path or shared_folder(docs.sparkSession, "tokens")

    def encode(batches):
        from pyspark import TaskContext
        context, number = TaskContext.get(), 0
        encoder = WordEncoder.of(vocabulary or vocabulary_path())
        names, parts, held = [], [], 0
        files, root = shared_file_system(folder)
        files.create_dir(root, recursive=True)

        def flush():
            nonlocal names, parts, held, number
            name = f"{context.partitionId():07d}-{number:04d}-{context.taskAttemptId()}.dac"
            with files.open_output_stream(f"{root}/{name}") as out:
                size = write_file(out, names, parts)
            row = pa.RecordBatch.from_arrays([pa.array([v]) for v in (
                context.partitionId() << 12 | number, f"{folder}/{name}", len(parts), held, size)],
                names=["file_no", "path", "n_docs", "n_tokens", "n_bytes"])
            names, parts, held, number = [], [], 0, number + 1
            return row

        for batch in batches:
            ids_of, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for lo, n in slices(pc.binary_length(texts).to_pylist()):
                for doc_id, ids in zip(ids_of[lo:lo + n], encoder.encode(texts.slice(lo, n))):
                    names.append(doc_id)
                    parts.append(ids)
                    held += len(ids)
                    if held >= file_tokens:
                        yield flush()
            pa.default_memory_pool().release_unused()
        if parts:
            yield flush()

    rows = doc_text(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")).withColumn("at", F.xxhash64("text"))
    placed = rows.repartitionByRange(tasks_for(docs), "doc_id", "at").sortWithinPartitions("doc_id", "at").select("doc_id", "text")
    manifest = keep(placed.mapInArrow(encode, MANIFEST), "token-manifest")
    return keep(exclusive_scan(manifest, [], ["file_no"], "n_tokens", "first"), "token-starts")


def _each_file(manifest: DataFrame) -> DataFrame:
    """One task per file, in order; a manifest without files still has a task."""
    return manifest.select("file_no", "path", "first").repartitionByRange(max(manifest.count(), 1), "file_no")


def _opened(batches):
    """(row, file) of each row of a manifest."""
    for batch in batches:
        for row in batch.to_pylist():
            files, path = shared_file_system(row["path"])
            with files.open_input_file(path) as handle:
                yield row, TokenFile(handle)


def read(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document, read back from the files: doc_id, start, n_tokens, ids_crc32, and ``ids`` if asked for."""
    def decode(batches):
        for row, file in _opened(batches):
            names, starts, at = file.doc_ids(), file.starts(), 0
            while at < file.n_docs:
                # As many documents as a run holds, and one at least.
                stop = max(int(np.searchsorted(starts, starts[at] + RUN_TOKENS, "right")) - 1, at + 1)
                ids, base = file.ids(int(starts[at]), int(starts[stop])).astype("<u4", copy=False), starts[at]
                raw = memoryview(ids).cast("B")
                bounds = (starts[at:stop + 1] - base) * 4
                crcs = [zlib.crc32(raw[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                columns = [pa.array(names[at:stop], pa.int64()), pa.array(starts[at:stop] + row["first"]),
                           pa.array(np.diff(starts[at:stop + 1])), pa.array(crcs, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array((starts[at:stop + 1] - base).astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])
                at = stop

    return _each_file(manifest).mapInArrow(
        decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else ""))


def tokens_at(manifest: DataFrame, positions: DataFrame) -> DataFrame:
    """(position, token_id): single tokens by their place among all tokens; places beyond the last give no row.

    Files and positions meet in blocks of FILE_TOKENS tokens, so no table of files is broadcast. Positions of one
    file are read in order by the tasks that they are dealt to.
    """
    block = lambda c: F.floor(c / F.lit(FILE_TOKENS))
    spans = manifest.where("n_tokens > 0").select(
        "path", "first", "n_tokens", F.explode(F.sequence(block(F.col("first")), block(F.col("first") + F.col("n_tokens") - 1))).alias("block"))
    met = (
        positions.select(F.col("position").cast("bigint").alias("position")).withColumn("block", block(F.col("position")))
        .join(spans, "block").where((F.col("position") >= F.col("first")) & (F.col("position") < F.col("first") + F.col("n_tokens")))
        .select("path", "position", (F.col("position") - F.col("first")).alias("at")).sortWithinPartitions("path", "at")
    )

    def look_up(batches):
        path = handle = file = None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["path"] != path:
                    if handle:
                        handle.close()
                    path = row["path"]
                    files, place = shared_file_system(path)
                    handle = files.open_input_file(place)
                    file = TokenFile(handle)
                found.append(file.token(row["at"]))
            yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(found, pa.int64())], names=["position", "token_id"])
        if handle:
            handle.close()

    return met.mapInArrow(look_up, "position bigint, token_id bigint")
