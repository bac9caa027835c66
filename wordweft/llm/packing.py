"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents become token ids followed by an end id; only a document longer than a sequence is cut, into
full pieces and a last piece that may be shorter. Pieces are packed by bounded-space online best-fit: a
task keeps a fixed number of open bins, found through a bitset keyed by free space. A piece goes into the
open bin that it fills best; if none has room and all places are taken, the fullest bin closes first.

Rounds: a task packs the pieces of its own input split as it tokenizes them, so nothing is shuffled. The
bins that are still open at its end hand their pieces to the next round, which has FAN times fewer tasks,
until one task is left. That task gets at most FAN times OPEN_BINS bins, at any size of the input.

Nulls: a null text is empty and gives one piece, the end id alone. A null doc_id travels as null. Repeated
rows are packed each for itself. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, keep

LENGTH = 4096
END_ID = 1
OPEN_BINS = 256
FAN = 16
VOCABULARY = "word_bpe_49k.json"
#: Words that a worker remembers, and the longest such word.
REMEMBERED, WORD_CHARS = 250_000, 40

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED = PIECES + ", sequence_id bigint, offset bigint, closed boolean"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed vocabulary files lie on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)


class WordEncoder:
    """Token ids of whole texts, one white-space-free word at a time.

    The vocabulary's pre-tokenizer drops white space and never joins across it, so a text's ids are its
    words' ids in order; each distinct word of a batch is looked up once, and encoded if it is not
    remembered. Where every sentence mark before a space follows a plain letter or digit, marks are words
    of their own. Words of Latin-1 letters alone are one pre-token and go straight to the merges.
    """

    _shared: dict[str, WordEncoder] = {}
    _LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
    #: A mark before a space that does not follow a plain letter or digit, in RE2 syntax.
    _ODD = r"[^a-zA-Z0-9à-öø-ÿ][.,] |^[.,] "
    #: Separators that split_whitespace takes for white space and the vocabulary does not.
    _CONTROL = r"[\x1c-\x1f]"

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.byte_chars = self._byte_chars()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    @staticmethod
    def _byte_chars() -> list[str]:
        """The published byte-level alphabet: printable Latin-1 bytes stand for themselves, the others
        follow from U+0100 on."""
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = iter(range(0x100, 0x200))
        return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]

    def _word(self, word: str) -> bytes:
        """Ids of one word, packed: remembered words cost their bytes, not an object per id."""
        plain = self._LETTERS.fullmatch(word)
        if plain is None:
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        letters, mark = plain.groups()
        letters = letters.lower()
        if not letters.isascii():
            letters = "".join([self.byte_chars[b] for b in letters.encode()])
        ids = [token.id for token in self.merges.tokenize(letters)]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed + self._lookup([mark])[0] if mark else packed

    def _lookup(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Two generations of remembered words bound the memory."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        out = list(map(known.get, words))
        for k, ids in enumerate(out):
            if ids is None:
                word = words[k]
                out[k] = ids = older.get(word) or self._word(word)
                if len(word) <= WORD_CHARS:
                    known[word] = ids
        return out

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, the end id last."""
        odd = pc.match_substring_regex(texts, self._ODD)
        control = pc.match_substring_regex(texts, self._CONTROL)
        apart = pc.replace_substring(pc.replace_substring(texts, ". ", " . "), ", ", " , ")
        apart = pc.if_else(odd, texts, apart)
        # Trimmed first: the split kernel looks past the end of a batch whose last text ends in white space.
        words = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.if_else(control, "", apart)))
        coded = words.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        ids_of = self._lookup(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, ids_of), np.int64, len(ids_of)) // 4
        pool = np.frombuffer(b"".join(ids_of), "<u4")
        size = sizes[index]
        ends = np.cumsum(size)
        flat = pool[np.repeat((np.cumsum(sizes) - sizes)[index] - (ends - size), size) + np.arange(int(size.sum()))]
        word_ends = np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))
        stops = np.concatenate([[0], ends])[word_ends]
        out = [np.append(part, np.uint32(END_ID)).astype("<u4") for part in np.split(flat, stops[:-1])]
        for k in np.flatnonzero(control.to_numpy(zero_copy_only=False)):
            ids = self.tokenizer.encode(texts[int(k)].as_py(), add_special_tokens=False).ids
            out[k] = np.array([*ids, END_ID], dtype="<u4")
        return out


def slices(lengths: list[int], most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive (offset, rows) of at most ``most`` bytes, or one row."""
    start, held = 0, 0
    for k, n in enumerate(lengths):
        if held and held + n > most:
            yield start, k - start
            start, held = k, 0
        held += n
    if lengths:
        yield start, len(lengths) - start


def cut(ids: np.ndarray, length: int = LENGTH) -> Iterator[tuple[int, int, np.ndarray]]:
    """(piece, start, ids) of one document."""
    for piece, start in enumerate(range(0, len(ids), length)):
        yield piece, start, ids[start:start + length]


class BestFit:
    """Bounded-space online best-fit. ``add`` and ``finish`` yield (bin, fill, is closed)."""

    def __init__(self, length: int = LENGTH, places: int = OPEN_BINS):
        self.length, self.places, self.open = length, places, 0
        self.free: dict[int, list[list]] = {}
        self.bits = 0

    def _put(self, items: list, free: int) -> None:
        self.free.setdefault(free, []).append(items)
        self.bits |= 1 << free
        self.open += 1

    def _take(self, free: int) -> list:
        items = self.free[free].pop()
        if not self.free[free]:
            del self.free[free]
            self.bits &= ~(1 << free)
        self.open -= 1
        return items

    def add(self, item, size: int) -> Iterator[list]:
        """Place an item; yields the bins that close: full ones, and the fullest for want of a place."""
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            items = self._take(free)
        else:
            if self.open >= self.places:
                yield self._take((self.bits & -self.bits).bit_length() - 1)
            items, free = [], self.length
        items.append((item, self.length - free))
        if free == size:
            yield items
        else:
            self._put(items, free - size)

    def finish(self) -> Iterator[list]:
        for free in sorted(self.free):
            yield from self.free[free]
        self.free, self.bits, self.open = {}, 0, 0


def _emit(items: list, sequence: int, closed: bool) -> list[tuple]:
    return [(*item, sequence, offset, closed) for item, offset in items]


_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("closed", pa.bool_())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r)) for r in rows], schema=_ARROW)


def _pack(items: Iterable[tuple[tuple, int]], first: int, length: int, places: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Pack a stream of (item, size); sequence ids count up from ``first``."""
    bins, sequence, rows = BestFit(length, places), first, []
    for item, size in items:
        for done in bins.add(item, size):
            rows += _emit(done, sequence, True)
            sequence += 1
        if len(rows) > 20_000:
            yield _batch(rows)
            rows = []
    for rest in bins.finish():
        rows += _emit(rest, sequence, last)
        sequence += 1
    yield _batch(rows)


def _first(round_no: int) -> int:
    """Sequence ids of a task: 6 bits round, 25 bits task, 32 bits count."""
    from pyspark import TaskContext
    return (round_no << 57) | (TaskContext.get().partitionId() << 32)


def pack(docs: DataFrame, length: int = LENGTH, places: int = OPEN_BINS, fan: int = FAN,
         vocabulary: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``vocabulary`` is the path of a vocabulary file; by default each worker uses its installed one.
    """
    def first_round(batches):
        encoder = WordEncoder.of(vocabulary or vocabulary_path())

        def pieces():
            for batch in batches:
                ids_of = batch.column("doc_id").to_pylist()
                texts = batch.column("text")
                for lo, n in slices(pc.binary_length(texts).to_pylist()):
                    for doc_id, ids in zip(ids_of[lo:lo + n], encoder.encode(texts.slice(lo, n))):
                        for piece, start, part in cut(ids, length):
                            yield (doc_id, piece, start, len(part), zlib.crc32(part.tobytes())), len(part)
                pa.default_memory_pool().release_unused()
        yield from _pack(pieces(), _first(0), length, places, False)

    placed = keep(doc_text(docs).mapInArrow(first_round, PLACED), "packed")
    tasks = placed.where("NOT closed").select(F.shiftright("sequence_id", 32)).distinct().count()
    done, round_no = placed.where("closed"), 0
    while True:
        round_no, tasks = round_no + 1, max(1, -(-tasks // fan))
        open_rows = placed.where("NOT closed").select(*_ARROW.names[:5])
        # Hashed order: a round's tasks get a mix of small and large pieces.
        mixed = open_rows.withColumn("at", F.xxhash64("doc_id", "piece", "start", "ids_crc32"))
        mixed = mixed.repartition(tasks, "at").sortWithinPartitions("at", "doc_id", "piece").drop("at")
        last = tasks == 1

        def later(batches, number=round_no, last=last):
            def pieces():
                for batch in batches:
                    for row in zip(*(batch.column(k).to_pylist() for k in range(5))):
                        yield row, row[3]
            yield from _pack(pieces(), _first(number), length, places, last)

        placed = keep(mixed.mapInArrow(later, PLACED), "packed")
        done = done.unionByName(placed.where("closed"))
        if last:
            return done.drop("closed")


def sequences(docs: DataFrame, places: DataFrame, length: int = LENGTH, vocabulary: str | None = None) -> DataFrame:
    """sequence_id, input_ids: the packed sequences themselves, for documents with unique ids."""
    def encode(batches):
        encoder = WordEncoder.of(vocabulary or vocabulary_path())
        for batch in batches:
            rows = [(d, p, part.tolist()) for d, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text")))
                    for p, _, part in cut(ids, length)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                 pa.array([r[2] for r in rows], pa.list_(pa.int32()))], names=["doc_id", "piece", "ids"])
    pieces = doc_text(docs).mapInArrow(encode, "doc_id bigint, piece int, ids array<int>")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        places.join(pieces, ["doc_id", "piece"]).groupBy("sequence_id").agg(parts.alias("parts"))
        .select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("input_ids"))
    )
