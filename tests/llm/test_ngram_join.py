import random

import numpy as np
import pytest

from wordweft.llm import ngram_join
from wordweft.llm.graph import components


def shingles(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(doc_id, class_id, class_size, n_links) of each row from all pairs."""
    sets, up, links = [shingles(t) for _, t in rows], list(range(len(rows))), [0] * len(rows)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9 and sets[a]:
                links[a], links[b] = links[a] + 1, links[b] + 1
                x, y = sorted((root(a), root(b)))
                up[y] = x
    groups = {}
    for a, (i, _) in enumerate(rows):
        groups.setdefault(root(a), []).append(i)
    smallest = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return sorted(((i, smallest[root(a)], len(groups[root(a)]), links[a]) for a, (i, _) in enumerate(rows)), key=str)


def near_copies():
    rng = random.Random(2)
    words, rows = [f"w{k}" for k in range(500)], []
    for _ in range(10):
        base = [rng.choice(words) for _ in range(rng.choice([6, 30, 80, 200]))]
        for _ in range(rng.choice([1, 2, 5, 40])):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append((len(rows), "  " + " ".join(text) + rng.choice(["", " ", "\n"])))
    return rows + [(5, rows[7][1]), (5, rows[5][1]), (5, "other text here")]


@pytest.mark.parametrize("blocks", [{}, {"bucket_block": 4, "group_block": 3}])
def test_links_and_classes_equal_all_pairs(spark, blocks):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = ngram_join.near_duplicates(docs, **blocks).collect()
    assert sorted(((r["doc_id"], r["class_id"], r["class_size"], r["n_links"]) for r in got), key=str) == brute(rows)


def test_edges(edge, empty):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    got = ngram_join.near_duplicates(edge).collect()
    want = brute(rows)
    assert sorted(((r["doc_id"], r["class_id"], r["class_size"], r["n_links"]) for r in got), key=str) == want
    kept = ngram_join.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    left = brute([(r["doc_id"], r["text"]) for r in kept.collect()])
    assert all(size == 1 for _, _, size, _ in left)
    assert ngram_join.near_duplicates(empty).count() == ngram_join.drop_near_duplicates(empty).count() == 0


def test_bands_reach_the_recall():
    bands, rows = ngram_join.choose_bands()
    assert 1 - (1 - 0.8 ** rows) ** bands >= ngram_join.RECALL and bands * rows <= ngram_join.SIGNATURE
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.9999, 4)


def test_shared_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 30)).astype(np.uint64) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) if i != j else 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    got = ngram_join.shared_counts(sets, 7)
    np.fill_diagonal(got, 0)
    assert (got == want).all()


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 90), (95, 100), (95, 91), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {k: 0 for k in range(31)} | {k: 90 for k in (90, 91, 95, 100)}
