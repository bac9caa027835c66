import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wordweft.llm import packing


@pytest.fixture(scope="module")
def encoder():
    return packing.WordEncoder(packing.vocabulary_path())


ODD = ["", "  ", "a.b, c. d.", "x . y , z", "... ,.", "A<|endoftext|>B <|startoftext|>.", "it's. don't, 'tis", "é. ́. ,a",
       "a\x1cb\x1d. c\x85d\xa0e f　g", "3.14, 2. 1", "İI. ΣΑΣ. ΑΣ,", "日本, 語。. x_. _, y", "ﬁ. ½, Ⅷ. xͅ. ",
       "tab\t.\t, a.\n, b\r\n.", "a" * 300 + ". " + "b" * 50 + ", c", "a.. b,, c., d,. e", "ªº µ ß ÿ Þ × ÷ x.̈ a. ̈"]


def test_word_ids_equal_whole_text_ids(encoder):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("aB. ,'s\n\t\x1cé́<|>_-9½İΣ日 ßÀ") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.encode(pa.array(texts))):
        assert ids.tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, packing.END_ID], repr(text)


def check_packed(rows, texts, encoder, length):
    """Every piece is there once, with its ids; the pieces fill their sequences without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, text in enumerate(texts):
        ids = np.array([*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        pieces = sorted(by_doc[k], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"]) for r in pieces] == [
            (p, s, min(length, len(ids) - s)) for p, s in enumerate(range(0, len(ids), length))]
        assert [r["ids_crc32"] for r in pieces] == [zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in pieces]
    for places in by_sequence.values():
        end = 0
        for offset, n in sorted(places):
            assert offset == end
            end += n
        assert end <= length
    return len(by_sequence)


def test_packs_all_tokens_tightly(texts_of, encoder):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["the", "of", "strange", "wordweft"]) for _ in range(rng.choice([0, 1, 5, 20, 60, 300])))
             for _ in range(600)] + [None, ""]
    docs = texts_of(texts).repartition(7)
    rows = packing.pack(docs, length=64, places=16, fan=2).collect()
    used = check_packed(rows, texts, encoder, 64)
    assert used <= 1.03 * sum(r["length"] for r in rows) / 64 + 1
    sequences = {r["sequence_id"]: r["input_ids"] for r in packing.sequences(docs, packing.pack(docs, length=64), 64).collect()}
    assert sum(map(len, sequences.values())) == sum(r["length"] for r in rows)


def test_best_fit_closes_the_fullest_bin_first():
    bins = packing.BestFit(10, 2)
    closed = [c for item, size in (("a", 6), ("b", 7), ("c", 3), ("d", 8), ("e", 5)) for c in bins.add(item, size)]
    assert [[i for i, _ in c] for c in closed] == [["b", "c"], ["d"]]
    assert sorted([[i for i, _ in c] for c in bins.finish()]) == [["a"], ["e"]]


def test_edges(edge, empty, encoder):
    rows = packing.pack(edge).collect()
    assert sum(r["piece"] == 0 for r in rows) == edge.count()
    places = [(r["sequence_id"], r["offset"]) for r in rows]
    assert len(places) == len(set(places))
    assert packing.pack(empty).count() == 0
