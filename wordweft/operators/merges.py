"""Byte-pair merges: learning them from counted words, and applying them to a word.

A round of learning takes the ACTIVE most frequent pairs. A pair that a merge creates is at most as frequent as the
pair it replaces, so until the active pairs are used up only stretches of words whose neighbours form active pairs can
change. Tasks cut words into these segments and count equal ones; the driver gets distinct segments, a bounded number
of symbols, keeps an inverted index (pair -> segments, count) over them, and merges one pair after another, updating
the counts of the segments that it touches. A segment shows one symbol more on either side; as soon as the best pair
reaches into such a symbol, or ranks behind the last active pair, the round ends. So the merges are those of merging
one at a time, while the table of words is read twice per round, not per merge. Words that are one symbol leave the table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.session import cut

#: Pairs of a round, symbols of its segments that the driver takes, and pairs that a task sums before it emits them.
ACTIVE, SEGMENT_SYMBOLS, SUM_PAIRS = 8192, 2_000_000, 2_000_000
#: Merges that are applied to all words of a batch in one pass each; more of them are applied word by word. Cells of a table
#: of all pairs of symbols that a task sums in.
PASSES, TABLE_CELLS = 256, 1 << 20
WORDS = "symbols array<int>, n bigint"


def merge_symbols(parts: list, ranks: dict, merged: list, in_order: bool = False) -> list:
    """Apply merges to one word: the lowest rank first, left to right, over a linked list of its symbols.

    ``ranks`` gives the ranks of a pair, ascending; ``merged`` the symbol of a rank. A word of n symbols takes
    O(n log n). ``in_order``: a pair that appears behind its rank waits for its next one, as in learning.
    """
    count = len(parts)
    parts, before, after = list(parts), list(range(-1, count - 1)), list(range(1, count + 1))
    floor = 0

    def entry(i: int, j: int):
        found = ranks.get((parts[i], parts[j]))
        if found is None:
            return None
        at = bisect_left(found, floor) if in_order else 0
        return (found[at], i, parts[i], parts[j]) if at < len(found) else None

    heap = [e for e in (entry(i, i + 1) for i in range(count - 1)) if e]
    heapify(heap)
    while heap:
        rank, i, left, right = heappop(heap)
        j = after[i]
        if parts[i] != left or j >= count or parts[j] != right:
            continue  # one of the two has been merged meanwhile
        floor = rank
        parts[i], parts[j], after[i] = merged[rank], None, after[j]
        if after[i] < count:
            before[after[i]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < count and (e := entry(a, b)):
                heappush(heap, e)
    return [p for p in parts if p is not None]


def merge_passes(flat: np.ndarray, word: np.ndarray, pairs: list[tuple[int, int]], merged: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Apply merges in order to many words laid end to end, left to right in each: (symbols, number of each symbol's word)."""
    flat = flat.copy()
    for (a, b), new in zip(pairs, merged):
        i = np.flatnonzero(flat[:-1] == a)
        i = i[(flat[i + 1] == b) & (word[i + 1] == word[i])]
        if not len(i):
            continue
        if a == b:
            # Of a run of equal symbols every other pair is merged.
            k = np.arange(len(i))
            i = i[(k - np.maximum.accumulate(np.where(np.r_[True, np.diff(i) != 1], k, 0))) % 2 == 0]
        flat[i] = new
        keep = np.ones(len(flat), bool)
        keep[i + 1] = False
        flat, word = flat[keep], word[keep]
    return flat, word


def ranks_of(pairs: list[tuple]) -> dict[tuple, list[int]]:
    """Ranks of each pair, ascending; a pair may have been learned twice."""
    ranks = defaultdict(list)
    for k, pair in enumerate(pairs):
        ranks[pair].append(k)
    return dict(ranks)


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(values.astype(np.int32)))


def words_of(counts: DataFrame) -> DataFrame:
    """(pretoken, n) -> ``WORDS``: the UTF-8 bytes of each word as symbols 0 to 255."""
    def split(batches):
        for batch in batches:
            raw = batch.column("pretoken").cast(pa.binary()).to_pylist()
            lengths = np.fromiter(map(len, raw), np.int64, len(raw))
            yield pa.RecordBatch.from_arrays([_lists(np.frombuffer(b"".join(raw), np.uint8), lengths), batch.column("n")], names=["symbols", "n"])

    return counts.where("length(pretoken) > 0").select("pretoken", F.col("n").cast("bigint").alias("n")).mapInArrow(split, WORDS)


def _spread_out(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all words, number of each symbol's word, counts of the words)."""
    column = batch.column("symbols")
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat, np.repeat(np.arange(len(lengths)), lengths), batch.column("n").to_numpy()


def _neighbours(flat: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Places whose next symbol is of the same word."""
    return np.flatnonzero(word[1:] == word[:-1]) if len(word) else np.zeros(0, np.int64)


def pair_totals(words: DataFrame, order: np.ndarray) -> DataFrame:
    """(pair, n): adjacent symbols, weighted by the count of the word. A pair is numbered by the places of its two
    symbols among all symbols sorted by text (``order``), so that ties sort by text."""
    symbols = len(order)

    def count_in_table(batches):
        total = np.zeros(symbols * symbols, np.int64)
        for batch in batches:
            flat, word, n = _spread_out(batch)
            i = _neighbours(flat, word)
            np.add.at(total, order[flat[i]] * symbols + order[flat[i + 1]], n[word[i]])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at // symbols << 32 | at % symbols), pa.array(total[at])], names=["pair", "n"])

    def count(batches):
        keys, weights, held = [], [], 0

        def summed():
            pairs, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, at, np.concatenate(weights))
            return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total)], names=["pair", "n"])

        for batch in batches:
            flat, word, n = _spread_out(batch)
            i = _neighbours(flat, word)
            keys.append(order[flat[i]] << 32 | order[flat[i + 1]])
            weights.append(n[word[i]])
            held += len(i)
            if held >= SUM_PAIRS:
                yield summed()
                keys, weights, held = [], [], 0
        if held:
            yield summed()

    found = words.mapInArrow(count_in_table if symbols * symbols <= TABLE_CELLS else count, "pair bigint, n bigint")
    return found.groupBy("pair").agg(F.sum("n").alias("n"))


def segments_of(words: DataFrame, active: np.ndarray) -> DataFrame:
    """(segment, n): runs of symbols that form active pairs, with a neighbour on either side where the word has one.

    The first element of a segment says which neighbours it has: 1 before, 2 behind. ``active`` ascends.
    """
    def find(batches):
        for batch in batches:
            flat, word, n = _spread_out(batch)
            i = _neighbours(flat, word)
            key = flat[i] << 32 | flat[i + 1]
            at = np.minimum(np.searchsorted(active, key), len(active) - 1)
            hit = np.zeros(len(flat) + 1, bool)  # hit[k]: symbols k and k + 1 are an active pair
            hit[i[active[at] == key]] = True
            first = np.flatnonzero(hit & ~np.r_[False, hit[:-1]])
            end = np.flatnonzero(np.r_[False, hit[:-1]] & ~hit) + 1  # behind the last symbol
            has_before = (first > 0) & (word[first - 1] == word[first]) if len(first) else np.zeros(0, bool)
            has_behind = (end < len(word)) & (word[np.minimum(end, len(word) - 1)] == word[first]) if len(first) else np.zeros(0, bool)
            start, size = first - has_before, end - first + has_before + has_behind
            place = np.cumsum(size + 1) - size - 1
            values = np.empty(int((size + 1).sum()), np.int64)
            values[place] = has_before + 2 * has_behind
            run = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            values[np.repeat(place + 1, size) + run] = flat[np.repeat(start, size) + run]
            yield pa.RecordBatch.from_arrays([_lists(values, size + 1), pa.array(n[word[first]])], names=["segment", "n"])

    return words.mapInArrow(find, "segment array<int>, n bigint").groupBy("segment").agg(F.sum("n").alias("n"))


class PairIndex:
    """Inverted index over the segments of a round: pair -> segments and count, best pair first."""

    def __init__(self, segments: list[tuple[list[int], int]], active: set[tuple[int, int]], spelled: list[str], known: dict[str, int]):
        self.active, self.spelled, self.known, self.first_new = active, spelled, known, len(spelled)
        self.parts = [s[1:] for s, _ in segments]
        self.sides = [s[0] for s, _ in segments]
        self.n = [n for _, n in segments]
        self.count, self.open, self.where = defaultdict(int), defaultdict(int), defaultdict(set)
        for k in range(len(segments)):
            self._add(k, 1)
        self.heap = [self._key(p) for p in self.count]
        heapify(self.heap)

    def _key(self, pair: tuple[int, int]) -> tuple:
        return -self.count[pair], self.spelled[pair[0]], self.spelled[pair[1]], pair

    def _add(self, k: int, sign: int) -> list[tuple[int, int]]:
        """Count the pairs of a segment, or take them back. Other pairs of old symbols are no candidates in this round."""
        parts, side, n, seen = self.parts[k], self.sides[k], sign * self.n[k], []
        last = len(parts) - 2
        for i in range(last + 1):
            pair = (parts[i], parts[i + 1])
            if pair in self.active or pair[0] >= self.first_new or pair[1] >= self.first_new:
                self.count[pair] += n
                if (i == 0 and side & 1) or (i == last and side & 2):
                    self.open[pair] += n
                if sign > 0:
                    self.where[pair].add(k)
                seen.append(pair)
        return seen

    def _merge(self, pair: tuple[int, int], new: int) -> None:
        changed = set()
        for k in self.where.pop(pair):
            changed.update(self._add(k, -1))
            parts, out, i = self.parts[k], [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(new)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            self.parts[k] = out
            changed.update(self._add(k, 1))
        for other in changed:
            if self.count[other] > 0:
                heappush(self.heap, self._key(other))

    def learn(self, room: int, least: int, boundary: tuple | None) -> Iterator[tuple[int, int, int]]:
        """(left, right, merged) of each merge that this round can decide."""
        while self.heap and room > 0:
            key = heappop(self.heap)
            pair = key[3]
            if -key[0] != self.count[pair] or key[0] == 0:
                continue  # counted anew since
            if self.count[pair] < least or (boundary and key[:3] > boundary) or self.open[pair] > 0:
                return
            text = self.spelled[pair[0]] + self.spelled[pair[1]]
            new = self.known.get(text)
            if new is None:
                new = self.known[text] = len(self.spelled)
                self.spelled.append(text)
            yield *pair, new
            if new < self.first_new:
                return  # the symbol also stands outside of the segments
            self._merge(pair, new)
            room -= 1


def apply_merges(words: DataFrame, pairs: list[tuple[int, int]], merged: list[int]) -> DataFrame:
    """Words after the merges of a round: in a pass over all words for each of few merges. Of many merges, only words that
    hold one of their pairs are taken apart. Words of one symbol are left out."""
    firsts = np.unique(np.array([a << 32 | b for a, b in pairs], np.int64))
    ranks = ranks_of(pairs)

    def apply_passes(batches):
        for batch in batches:
            flat, word, n = _spread_out(batch)
            flat, word = merge_passes(flat, word, pairs, merged)
            lengths = np.bincount(word, minlength=len(n))
            long = lengths > 1
            yield pa.RecordBatch.from_arrays([_lists(flat[long[word]], lengths[long]), pa.array(n[long])], names=["symbols", "n"])

    def apply(batches):
        for batch in batches:
            flat, word, n = _spread_out(batch)
            i = _neighbours(flat, word)
            key = flat[i] << 32 | flat[i + 1]
            at = np.minimum(np.searchsorted(firsts, key), len(firsts) - 1)
            touched = np.unique(word[i[firsts[at] == key]])
            kept = np.setdiff1d(np.arange(batch.num_rows), touched)
            column = batch.column("symbols")
            rest = column.take(pa.array(kept))
            yield pa.RecordBatch.from_arrays([rest, pa.array(n[kept])], names=["symbols", "n"])
            new = [merge_symbols(parts, ranks, merged, True) for parts in column.take(pa.array(touched)).to_pylist()]
            long = [k for k, parts in enumerate(new) if len(parts) > 1]
            yield pa.RecordBatch.from_arrays([pa.array([new[k] for k in long], pa.list_(pa.int32())), pa.array(n[touched[long]])],
                                             names=["symbols", "n"])

    return words.mapInArrow(apply_passes if len(pairs) <= PASSES else apply, WORDS).where(F.size("symbols") > 1)


def learn_merges(counts: DataFrame, room: int, min_frequency: int, spelled: list[str], active: int = ACTIVE,
                 segment_symbols: int = SEGMENT_SYMBOLS) -> list[tuple[str, str]]:
    """Merges of (pretoken, n) in rank order: at most ``room``, of pairs that occur ``min_frequency`` times.

    ``spelled`` names the 256 bytes. Pairs rank by (count, left, right). The driver sees at most ``active`` pairs and
    ``segment_symbols`` symbols of distinct segments per round; where they are more, the round takes fewer pairs. It starts
    with no more pairs than the merges that are left can use, nor four times those of the round before.
    """
    spelled = list(spelled)
    known = {text: k for k, text in enumerate(spelled)}
    words, merges, width = cut(words_of(counts).where(F.size("symbols") > 1)), [], active
    while len(merges) < room:
        wanted = max(min(active, 2 * (room - len(merges)), 4 * width), 2)
        by_text = np.argsort(np.array(spelled, object), kind="stable")
        order = np.empty(len(spelled), np.int64)
        order[by_text] = np.arange(len(spelled))
        found = pair_totals(words, order).where(F.col("n") >= min_frequency).orderBy(F.desc("n"), "pair").limit(wanted).collect()
        if not found:
            break
        ranked = [(int(by_text[r["pair"] >> 32]), int(by_text[r["pair"] & 0xFFFFFFFF]), r["n"]) for r in found]
        width = len(ranked)
        while width > 1:
            held = cut(segments_of(words, np.array(sorted(a << 32 | b for a, b, _ in ranked[:width]), np.int64)))
            if (held.agg(F.sum(F.size("segment"))).first()[0] or 0) <= segment_symbols:
                break
            width = max(width // 4, 1)
        if width == 1:
            # Nothing but the best pair, whose segments may be of any length: it needs none.
            a, b, _ = ranked[0]
            text = spelled[a] + spelled[b]
            if text not in known:
                known[text] = len(spelled)
                spelled.append(text)
            learned = [(a, b, known[text])]
        else:
            taken = ranked[:width]
            last = taken[-1]
            boundary = None if width == len(ranked) < wanted else (-last[2], spelled[last[0]], spelled[last[1]])
            index = PairIndex([(r["segment"], r["n"]) for r in held.toLocalIterator()], {p[:2] for p in taken}, spelled, known)
            learned = list(index.learn(room - len(merges), min_frequency, boundary))
        merges += [(spelled[a], spelled[b]) for a, b, _ in learned]
        words = cut(apply_merges(words, [m[:2] for m in learned], [m[2] for m in learned]))
    return merges
