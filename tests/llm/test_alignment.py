import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from wordweft.llm import alignment


@pytest.fixture(scope="module")
def both():
    return alignment.Tokenizers.of()


@pytest.fixture(scope="module")
def from_file():
    from wordweft.llm.packing import vocabulary_path
    return alignment.Tokenizers._by_file(vocabulary_path(alignment.A_FILE))


def test_merging_by_rank_equals_the_file(both, from_file):
    """Every code point of the Unicode planes in use, in several surroundings, and random texts."""
    for low in range(0, 0x20000, 512):
        chars = [chr(k) for k in range(low, low + 512) if not 0xD800 <= k < 0xE000]
        text = " ".join(f"a{x}b{x}1 {x}{x} {x}a  {x}" for x in chars)
        assert both.a(text) == from_file(text), hex(low)
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice("aeT 's\n\t1é日.<|>_") for _ in range(rng.randint(0, 80))) + "<|endoftext|>"
        assert both.a(text) == from_file(text)


def brute(both, text):
    """(A ids, B ids, links, groups) by comparing byte ranges of all token pairs."""
    if not text:
        return [], [], [], []
    spaced = (" " + text).encode()
    a = both.a(" " + text)
    b = both.b.encode(text)
    if b"".join(both.a_bytes[k] for k in a) != spaced or b"".join(both.b_bytes[k] for k in b) != spaced:
        return [], [], [], []
    ends = [np.cumsum([len(table[k]) for k in ids]).tolist() for table, ids in ((both.a_bytes, a), (both.b_bytes, b))]
    starts = [[0, *e[:-1]] for e in ends]
    links = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
    groups, at = [], (0, 0)
    for cut in sorted(set(ends[0]) & set(ends[1])):
        to = (ends[0].index(cut) + 1, ends[1].index(cut) + 1)
        groups.append((a[at[0]:to[0]], b[at[1]:to[1]]))
        at = to
    return a, b, links, groups


def expected(both, rows):
    whole = [(r["doc_id"], *brute(both, r["text"])) for r in rows]
    counts = Counter((a[i], b[j]) for _, a, b, links, _ in whole for i, j in links)
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for doc_id, a, b, links, groups in whole:
        pairs = [(a[i], b[j]) for i, j in links]
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[1]] for p in pairs),
                    sum(counts[p] for p in pairs), hashlib.sha256(spelled.encode()).hexdigest() if a else ""))
    return out


ODD = [None, "", " ", "hello  world", "a▁b", "<|endoftext|> <s></s><0x41>", "é😀日本語 ﬁ ½", "tab\t\n\r\n x", "a\0b", "x" * 700, "  ", "ÀÉ" * 50]


def key(row):
    return str(row[0]), *map(str, row[1:])


def test_equals_all_token_pairs(both, texts_of):
    rng = random.Random(8)
    words = ["the", "strange", "Wordweft", "naïve", "12,345", "don't", "😀", "日本", "\n", "  "]
    docs = texts_of(ODD + [" ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 30, 400]))) for _ in range(60)]).repartition(3)
    rows = alignment.align(docs).collect()
    assert sorted(map(key, rows)) == sorted(map(key, expected(both, docs.collect())))


def test_slices_of_the_counts_add_up(both, texts_of):
    docs = texts_of(["one two three", "two threes and one", "Wordweft aligns", "one one two"] * 3)
    assert sorted(map(key, alignment.align(docs, slice_pairs=3).collect())) == sorted(map(key, expected(both, docs.collect())))


@pytest.mark.parametrize("lane", [1, 2, 7, 256])
def test_lanes_do_not_change_links(lane):
    rng = np.random.default_rng(lane)
    sizes = [(rng.integers(1, 5, rng.integers(1, 80)), None) for _ in range(20)]
    a_sizes = [s for s, _ in sizes]
    b_sizes = []
    for s in a_sizes:
        cuts = np.unique(np.append(rng.integers(1, s.sum() + 1, rng.integers(1, 60)), s.sum()))
        b_sizes.append(np.diff(np.append(0, cuts)))
    a_sizes.insert(3, np.zeros(0, int))
    b_sizes.insert(3, np.zeros(0, int))
    ends = [np.cumsum(np.concatenate(s)) for s in (a_sizes, b_sizes)]
    counts = [np.array(list(map(len, s))) for s in (a_sizes, b_sizes)]
    found = alignment.lockstep(*ends, *counts, lane=lane)
    starts = [np.append(0, e[:-1]) for e in ends]
    want = [(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
    assert list(zip(found.a.tolist(), found.b.tolist())) == want
    assert found.cut.tolist() == [bool(ends[0][i] == ends[1][j]) for i, j in want]


def test_links_by_document(both, texts_of):
    text = "strange Wordweft naïve"
    rows = sorted(alignment.links(texts_of([text, None])).collect(), key=lambda r: r["link"])
    a, b, links, _ = brute(both, text)
    assert [(r["a_place"], r["b_place"], r["a_id"], r["b_id"]) for r in rows] == [(i, j, a[i], b[j]) for i, j in links]


def test_edges(edge, empty):
    rows = alignment.align(edge).collect()
    assert len(rows) == edge.count()
    assert all((r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]) for r in rows)
    nothing = [r for r in rows if r["n_a"] == 0]
    assert nothing and all(r["groups_sha256"] == "" and r["count_sum"] == 0 for r in nothing)
    assert alignment.align(empty).count() == 0
