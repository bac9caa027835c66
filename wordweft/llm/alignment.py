"""Alignment of two tokenizers: which tokens of A and B share bytes of a text, and where both end.

A and B spell the same bytes, so a merge of their token ends aligns them: pointers i and j stand at the tokens that
hold the current byte; (i, j) is a link; the token that ends first is left behind, or both, which is a cut. The
merge runs in lockstep: one NumPy state vector holds the pointers of all documents of a batch, each step emits a
link of every document and advances it, and finished documents are compacted away. Long documents are many lanes
of that vector: a lane starts at every LANE-th end of an A token, where its B pointer is found by binary search,
so the number of steps is bounded for any text.

Passes: texts are encoded once, and their ids are kept. Links are counted by id pair, summed within tasks before
they are shuffled. The counts are then read in slices of at most SLICE_PAIRS id pairs, which travel with the
tasks; count sums and best links of a document add up over slices, so any number of id pairs is covered exactly.

Null and empty texts, and texts whose tokens do not spell space + text, have no tokens: zeros and an empty digest. A
null doc_id travels as null. Repeated rows count each for itself. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bpe import PRETOKEN
from .common import doc_text, keep
from .packing import slices, vocabulary_path

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A tokens of a lane; text bytes encoded at a time; tokens merged at a time; links summed before a task emits their counts.
LANE, TEXT_BYTES, MERGE_TOKENS, SUM_LINKS = 32, 500_000, 300_000, 2_000_000
#: Id pairs that travel with the tasks at a time: 16 bytes each.
SLICE_PAIRS = 2_000_000

ENCODED = "doc_id bigint, n_a bigint, n_b bigint, a binary, b binary"


class Tokenizers:
    """Both vocabularies, and the bytes that each of their tokens spells."""

    _shared: dict[tuple, Tokenizers] = {}

    def __init__(self, a_path: str, b_path: str):
        import json

        from sentencepiece import SentencePieceProcessor
        with open(a_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of = {c: bytes([k]) for k, c in enumerate(_byte_characters())}
        self.a_bytes = [b""] * (max(model["vocab"].values()) + 1)
        for token, number in model["vocab"].items():
            self.a_bytes[number] = b"".join(byte_of.get(c, c.encode()) for c in token)
        self.a = self._by_rank(model["vocab"], model["merges"]) or self._by_file(a_path)
        self.b = SentencePieceProcessor(model_file=b_path)
        self.b_bytes = [self._piece(k) for k in range(self.b.get_piece_size())]

    def _by_rank(self, vocabulary: dict[str, int], merges: list):
        """An encoder that merges by ascending id, several times faster; None where ids are not in order of the merges."""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        if [vocabulary.get(a + b) for a, b in pairs] != list(range(256, 256 + len(pairs))):
            return None
        from tiktoken import Encoding
        ranks = {spelled: k for k, spelled in enumerate(self.a_bytes[:256 + len(pairs)])}
        return Encoding("A", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    @staticmethod
    def _by_file(path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    @classmethod
    def of(cls, a_path: str | None = None, b_path: str | None = None) -> Tokenizers:
        key = (a_path or vocabulary_path(A_FILE), b_path or vocabulary_path(B_FILE))
        if key not in cls._shared:
            cls._shared[key] = cls(*key)
        return cls._shared[key]

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """(A ids, B ids) of each text; both empty where they do not spell space + text."""
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            a = self.a(" " + text)
            same = text and (" " + text).encode() == b"".join([self.a_bytes[k] for k in a]) == b"".join([self.b_bytes[k] for k in b])
            yield (a, b) if same else ([], [])


def _byte_characters() -> list[str]:
    """The published byte-level alphabet: printable Latin-1 bytes stand for themselves, the others
    follow from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


@dataclass
class Links:
    """Links of a batch of documents in text order, and which of them end in a cut.

    ``a`` and ``b`` are places in the ids of the whole batch; ``doc`` numbers the documents."""

    a: np.ndarray
    b: np.ndarray
    cut: np.ndarray
    doc: np.ndarray


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_count: np.ndarray, b_count: np.ndarray, lane: int = LANE) -> Links:
    """Merge the token ends of many documents, laid end to end.

    ``a_ends`` and ``b_ends`` are byte places in the whole batch (a document starts where the one before ends),
    ``a_count`` and ``b_count`` the tokens of each document. No token may be without bytes.
    """
    last_a = np.cumsum(a_count)
    lanes = -(-a_count // lane)
    doc = np.repeat(np.arange(len(a_count)), lanes)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    i = (last_a - a_count)[doc] + nth * lane
    stop = np.minimum(i + lane, last_a[doc])
    # The B token that holds the byte at which the lane starts.
    j = np.searchsorted(b_ends, np.where(i > 0, a_ends[i - 1], 0), "right") if len(i) else i
    # A lane emits at most its A tokens, and the B tokens that end within them.
    room = stop - i + np.searchsorted(b_ends, a_ends[stop - 1], "right") - j if len(i) else i
    place = np.cumsum(room) - room
    total = int(room.sum())
    out_a, out_b, out_cut = np.zeros(total, np.int64), np.zeros(total, np.int64), np.zeros(total, bool)
    out_doc, used = np.repeat(doc, room), np.zeros(total, bool)
    while len(i):
        end_a, end_b = a_ends[i], b_ends[j]
        out_a[place], out_b[place], used[place] = i, j, True
        out_cut[place] = end_a == end_b
        i = i + (end_a <= end_b)
        j = j + (end_b <= end_a)
        place = place + 1
        going = i < stop
        if not going.all():
            i, j, stop, place = i[going], j[going], stop[going], place[going]
    return Links(out_a[used], out_b[used], out_cut[used], out_doc[used])


def merged(a: np.ndarray, b: np.ndarray, a_count: np.ndarray, b_count: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> Links:
    """``lockstep`` of the ids of many documents."""
    return lockstep(np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b]), a_count, b_count)


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, A ids, B ids, A counts, B counts) of consecutive rows, a bounded number of tokens at a time."""
    n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
    for lo, n in slices((n_a + n_b).tolist(), MERGE_TOKENS):
        a, b = (np.frombuffer(b"".join(batch.column(c).slice(lo, n).to_pylist()), "<u2").astype(np.int64) for c in ("a", "b"))
        yield lo, a, b, n_a[lo:lo + n], n_b[lo:lo + n]


class GroupText:
    """Spells the groups of a batch: ids of A, a bar, ids of B; groups are parted by semicolons."""

    def __init__(self, a_size: int, b_size: int):
        self.a_size, self.b_size = a_size, b_size
        self.spelled = [b"%d%s" % (k, mark) for size, mark in ((a_size, b","), (a_size, b"|"), (b_size, b","), (b_size, b";"))
                        for k in range(size)]

    def digests(self, links: Links, a: np.ndarray, b: np.ndarray, a_count: np.ndarray, b_count: np.ndarray) -> list[str]:
        """SHA-256 of each document's groups; empty without tokens."""
        a_cut, b_cut = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_cut[links.a[links.cut]] = True
        b_cut[links.b[links.cut]] = True
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        # A group stands where the tokens before it end; its A tokens come first.
        a_upto, b_upto = np.append(0, np.flatnonzero(a_cut) + 1), np.append(0, np.flatnonzero(b_cut) + 1)
        codes = np.empty(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + b_upto[a_group]] = a + a_cut * self.a_size
        codes[np.arange(len(b)) + a_upto[b_group + 1]] = b + 2 * self.a_size + b_cut * self.b_size
        spelled, out, at = self.spelled, [], 0
        for n in (a_count + b_count).tolist():
            text = b"".join([spelled[c] for c in codes[at:at + n].tolist()])
            out.append(hashlib.sha256(text[:-1]).hexdigest() if n else "")
            at += n
        return out


def encoded(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``ENCODED``: the ids of each document by both tokenizers, two bytes each."""
    def encode(batches):
        both = Tokenizers.of(a_path, b_path)
        if max(len(both.a_bytes), len(both.b_bytes)) > 1 << 16:
            raise ValueError("ids must stay below 2**16")
        for batch in batches:
            texts = batch.column("text")
            for lo, n in slices(pc.binary_length(texts).to_pylist(), TEXT_BYTES):
                pairs = list(both.encode(texts.slice(lo, n).to_pylist()))
                columns = [pa.array([len(p[k]) for p in pairs], pa.int64()) for k in (0, 1)]
                columns += [pa.array([np.array(p[k], "<u2").tobytes() for p in pairs], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, n), *columns], names=["doc_id", "n_a", "n_b", "a", "b"])
            pa.default_memory_pool().release_unused()

    return doc_text(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(encode, ENCODED)


def _sizes(both: Tokenizers) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.fromiter(map(len, spelled), np.int64, len(spelled)) for spelled in (both.a_bytes, both.b_bytes))


def pair_counts(ids: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(pair, n, best): links of each id pair (A id * 2^16 + B id) over all documents, and whether no other pair of
    its B id has more."""
    def count(batches):
        a_sizes, b_sizes = _sizes(Tokenizers.of(a_path, b_path))
        held, links_held = [], 0

        def summed():
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n.astype(np.int64))], names=["pair", "n"])

        for batch in batches:
            for _, a, b, a_count, b_count in _batches(batch):
                links = merged(a, b, a_count, b_count, a_sizes, b_sizes)
                held.append(a[links.a] << 16 | b[links.b])
                links_held += len(links.a)
                if links_held >= SUM_LINKS:
                    yield summed()
                    held, links_held = [], 0
        if held:
            yield summed()

    parts = ids.select("n_a", "n_b", "a", "b").mapInArrow(count, "pair bigint, n bigint")
    counts = parts.groupBy("pair").agg(F.sum("n").alias("n"))
    b_id = F.col("pair").bitwiseAND(0xFFFF)
    counts = keep(counts, "pair-counts")
    # One row per id of B: fewer than 2^16, whatever the corpus.
    most = counts.groupBy(b_id.alias("b_id")).agg(F.max("n").alias("most"))
    return keep(counts.withColumn("b_id", b_id).join(F.broadcast(most), "b_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best")),
                "pair-best")


def _pair_slices(counts: DataFrame, slice_pairs: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(pairs, counts, best) in ascending order of pairs, at most about ``slice_pairs`` at a time."""
    pieces = max(-(-counts.count() // slice_pairs), 1)
    piece = F.pmod(F.xxhash64("pair"), F.lit(pieces))
    for k in range(pieces):
        table = counts.where(piece == k).select("pair", "n", "best").toArrow().sort_by("pair")
        yield tuple(table[c].to_numpy() for c in ("pair", "n", "best"))


def _scores(ids: DataFrame, known: tuple[np.ndarray, np.ndarray, np.ndarray], shape: bool, a_path, b_path) -> DataFrame:
    """Per document: best links and count sum over the given pairs, and with ``shape`` its groups and links."""
    shared = ids.sparkSession.sparkContext.broadcast(known)
    names = ["doc_id", "row", "n_best", "count_sum", *(["n_a", "n_b", "n_groups", "n_links", "groups_sha256"] if shape else [])]
    schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'bigint'}" for c in names)

    def score(batches):
        pairs, counts, best = shared.value
        both = Tokenizers.of(a_path, b_path)
        a_sizes, b_sizes = _sizes(both)
        speller = GroupText(len(both.a_bytes), len(both.b_bytes)) if shape else None
        for batch in batches:
            for lo, a, b, a_count, b_count in _batches(batch):
                links = merged(a, b, a_count, b_count, a_sizes, b_sizes)
                key = a[links.a] << 16 | b[links.b]
                docs = len(a_count)
                n_best, total = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
                if len(pairs):
                    at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                    hit = pairs[at] == key
                    n_best = np.bincount(links.doc[hit & best[at]], minlength=docs)
                    # Sums of whole numbers by differences of a running sum: exact beyond 2^53.
                    running = np.append(0, np.cumsum(np.where(hit, counts[at], 0)))
                    ends = np.searchsorted(links.doc, np.arange(docs), "right")
                    total = running[ends] - running[np.searchsorted(links.doc, np.arange(docs), "left")]
                columns = [batch.column("doc_id").slice(lo, docs), batch.column("row").slice(lo, docs), pa.array(n_best.astype(np.int64)), pa.array(total)]
                if shape:
                    groups = np.bincount(links.doc[links.cut], minlength=docs)
                    found = np.bincount(links.doc, minlength=docs)
                    columns += [pa.array(c.astype(np.int64)) for c in (a_count, b_count, groups, found)]
                    columns.append(pa.array(speller.digests(links, a, b, a_count, b_count)))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return ids.mapInArrow(score, schema)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, slice_pairs: int = SLICE_PAIRS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    # The row number keeps documents apart that share a doc_id when slices are added up; it is fixed by being written.
    ids = keep(encoded(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()), "both-ids")
    counts = pair_counts(ids, a_path, b_path)
    parts = [_scores(ids, known, k == 0, a_path, b_path) for k, known in enumerate(_pair_slices(counts, slice_pairs))]
    found = parts[0]
    if len(parts) > 1:
        rest = parts[1].select("row", "n_best", "count_sum")
        for part in parts[2:]:
            rest = rest.unionByName(part.select("row", "n_best", "count_sum"))
        more = rest.groupBy("row").agg(F.sum("n_best").alias("_best"), F.sum("count_sum").alias("_sum"))
        found = found.join(more, "row").withColumn("n_best", F.col("n_best") + F.col("_best")).withColumn(
            "count_sum", F.col("count_sum") + F.col("_sum"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def links(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(doc_id, link, a_place, b_place, a_id, b_id, is_cut): every link of every document, in text order."""
    def emit(batches):
        a_sizes, b_sizes = _sizes(Tokenizers.of(a_path, b_path))
        for batch in batches:
            for lo, a, b, a_count, b_count in _batches(batch):
                found = merged(a, b, a_count, b_count, a_sizes, b_sizes)
                firsts = [np.cumsum(c) - c for c in (a_count, b_count, np.bincount(found.doc, minlength=len(a_count)))]
                columns = (np.arange(len(found.doc)) - firsts[2][found.doc], found.a - firsts[0][found.doc], found.b - firsts[1][found.doc],
                           a[found.a], b[found.b], found.cut)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, len(a_count)).take(pa.array(found.doc)), *map(pa.array, columns)],
                    names=["doc_id", "link", "a_place", "b_place", "a_id", "b_id", "is_cut"])

    return encoded(docs, a_path, b_path).mapInArrow(
        emit, "doc_id bigint, link bigint, a_place bigint, b_place bigint, a_id bigint, b_id bigint, is_cut boolean")
