import hashlib
from collections import Counter, defaultdict

import pytest

from wordweft.llm import exact_dedup


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[fold(r["text"])].append(r["doc_id"])
    found = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        stay = max(known) if known else None
        first = True
        for i in ids:
            found.append((i, stay, len(ids), i == stay and first, hashlib.sha256(text.encode()).hexdigest()))
            first = first and i != stay
    return sorted(found, key=str)


@pytest.mark.parametrize("settings", [{}, {"capacity": 2}, {"capacity": 3, "key_bits": 2}])
def test_copies_equal_brute_force(edge, settings):
    got = exact_dedup.find_copies(edge, **settings).collect()
    want = brute(edge.select("doc_id", "text").collect())
    rows = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got), key=str)
    assert rows == want
    if settings:
        assert len({r["bucket"] for r in got}) > 1
    if "key_bits" in settings:
        assert max(r["chain"] for r in got) > 0


def test_directory_doubles_only_overfull_buckets():
    cells = exact_dedup.directory({0: 9, 1: 9, 6: 1}, 3, 10)
    assert [c for c, _, _ in cells] == list(range(8))
    assert {(b, d) for _, b, d in cells} == {(0, 3), (1, 3), (2, 2), (4, 1)}


def test_directory_grows_until_no_bucket_is_overfull(spark):
    # 40 keys that differ in their last bits only, and 6 spread ones: one branch of the directory is deep.
    near = [(3 << 60) + (k << 48) for k in range(40)]
    keys = spark.createDataFrame([(k - (1 << 64) if k >> 63 else k,) for k in near + [i << 61 for i in range(2, 8)]], "key bigint")
    cells, depth = exact_dedup.grow(keys, 8)
    unsigned = [r["key"] % (1 << 64) for r in keys.collect()]
    bucket_of = {c: (b, d) for c, b, d in cells}
    held = Counter(bucket_of[k >> (64 - depth)] for k in unsigned)
    assert len(cells) == 2 ** depth and max(held.values()) <= 8
    assert min(d for _, d in held) < depth == max(d for _, d in held)
    assert exact_dedup.grow(keys, 8, 3)[1] == 3 and exact_dedup.grow(keys.limit(0), 8) == ([(0, 0, 0)], 0)


def test_chains_tell_texts_apart_by_their_bytes(spark):
    texts = ["a", "A", "b", "b ", "\u00e4", "\u00c4", "a\u0308", None, ""] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    # One key for all texts: a single chain holds them all.
    index = exact_dedup.copy_index(docs, capacity=1, key_bits=1, max_depth=2)
    assert index.depth <= 2
    got = sorted((r["group_size"], r["keep_id"]) for r in index.links.collect())
    assert got == sorted([(6, 19), (3, 20), (3, 21), (3, 22), (3, 23), (3, 24), (6, 26)])
    assert max(r["chain"] for r in index.links.collect()) > 0


def test_drop_copies_keeps_columns(edge, empty):
    kept = exact_dedup.drop_copies(edge)
    assert kept.columns == edge.columns
    texts = [fold(r["text"]) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({fold(r["text"]) for r in edge.collect()})
    assert exact_dedup.find_copies(empty).count() == exact_dedup.drop_copies(empty).count() == 0
