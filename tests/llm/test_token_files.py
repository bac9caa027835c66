import random
import zlib

import numpy as np
import pytest

from wordweft.llm import packing, token_files
from wordweft.llm.common import shared_file_system


def written(tmp_path, parts, names=None):
    path = str(tmp_path / "one.dac")
    files, root = shared_file_system(path)
    with files.open_output_stream(root) as out:
        token_files.write_file(out, names or list(range(len(parts))), parts)
    return token_files.TokenFile(files.open_input_file(root))


@pytest.mark.parametrize("make", [
    lambda r: r.integers(0, 49408, 5000), lambda r: r.zipf(1.3, 9000) % 49408, lambda r: np.zeros(700), lambda r: np.ones(1),
    lambda r: np.array([2**32 - 1, 0, 1, 2**31]), lambda r: np.repeat(np.arange(3), 2000)])
def test_any_run_and_any_token_are_read_back(tmp_path, make):
    rng = np.random.default_rng(2)
    ids = make(rng).astype(np.uint32)
    file = written(tmp_path, [ids])
    assert (file.ids(0, len(ids)) == ids).all()
    for _ in range(60):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2))
        assert (file.ids(a, b) == ids[a:b]).all()
    for k in rng.integers(0, len(ids), 60):
        assert file.token(k) == ids[k]
    with pytest.raises(IndexError):
        file.ids(0, len(ids) + 1)


def test_widths_are_the_cheapest():
    def cost(over, widths):
        bits, at = 0, 0
        for k, w in enumerate(widths):
            bits += over[at] * (w + (k < len(widths) - 1))
            at += w // 4
        return bits

    def splits(top):
        return [[4 * top]] + [[4 * w, *rest] for w in range(1, top) for rest in splits(top - w)]

    rng = random.Random(3)
    for _ in range(60):
        over = sorted((rng.choice([1, 7, 100, 1000]) for _ in range(rng.randint(1, 8))), reverse=True)
        found = token_files.best_widths([*over, 0])
        assert sum(found) == 4 * len(over)
        assert cost(over, found) == min(cost(over, w) for w in splits(len(over)))


def test_reading_one_token_fetches_a_few_bytes(tmp_path):
    ids = np.random.default_rng(1).zipf(1.4, 400_000).astype(np.uint32) % 49408
    file = written(tmp_path, [ids])

    class Counting:
        def __init__(self, handle):
            self.handle, self.fetched = handle, 0

        def read_at(self, n, at):
            self.fetched += n
            return self.handle.read_at(n, at)

    file.handle = Counting(file.handle)
    assert file.token(399_999) == ids[-1]
    assert file.handle.fetched < 100 * len(file.levels)


def expected(docs):
    encoder = packing.WordEncoder.of(packing.vocabulary_path())
    rows, start = [], 0
    order = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)
    for r in sorted(docs.collect(), key=order):
        ids = np.array([*encoder.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        rows.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


def test_documents_come_back_in_order(spark, texts_of):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["the", "of", "strange", "wordweft", "é!"]) for _ in range(rng.choice([0, 1, 5, 60]))) for _ in range(400)]
    docs = texts_of([*texts, None, ""]).repartition(5)
    manifest = token_files.write(docs, file_tokens=500)
    assert manifest.count() > 4
    rows = [tuple(r) for r in token_files.read(manifest).collect()]
    assert sorted(rows) == expected(docs)
    ids = [i for r in sorted(token_files.read(manifest, with_ids=True).collect()) for i in r["ids"]]
    asked = [0, 1, 17, 499, 500, len(ids) - 1, len(ids), 17]
    found = token_files.tokens_at(manifest, spark.createDataFrame([(a,) for a in asked], "position long")).collect()
    assert sorted(map(tuple, found)) == sorted((a, ids[a]) for a in asked if a < len(ids))


def test_edges(edge, empty):
    rows = token_files.read(token_files.write(edge)).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in rows) == sorted((str(r[0]), r[2], r[3]) for r in expected(edge))
    ends = sorted((r["start"], r["n_tokens"]) for r in rows)
    assert all(a + n == b for (a, n), (b, _) in zip(ends, ends[1:]))
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["start"])] == [r[0] for r in expected(edge)]
    assert token_files.read(token_files.write(empty)).count() == 0
