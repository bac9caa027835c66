import hashlib
import re
from collections import Counter, defaultdict

from wordweft.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(5, 2, 1), most=3):
    """Reshare the excess by weight, round by round, until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: most * sizes[s] for s in over}


def brute(rows):
    docs = [(r["doc_id"], r["source"], size_of(r["text"])) for r in rows]
    sizes = Counter()
    for _, s, n in docs:
        sizes[s] += n
    target = targets(sizes)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    queues = defaultdict(list)
    for i, s, n in docs:
        queues[s].append((hashlib.md5(f"{mixing.SEED}|{i}|0".encode()).hexdigest(), i, n))
    turns = []
    for s, queue in queues.items():
        run = 0
        for turn in range(3):
            for digest, i, n in sorted(queue):
                run += n
                if n and target[s]:
                    turns.append((run / target[s], names.index(s), turn, digest, i, n))
    passed, taken = 0, Counter()
    for _, _, _, _, i, n in sorted(turns):
        passed += n
        if passed > sum(sizes.values()):
            break
        taken[i] += n
    return {i: (n, sizes[s], target[s], taken[i]) for i, s, n in docs}


def test_mix_equals_brute_force(spark):
    rows = [(k, " ".join(["x"] * (k * 7 % 23)), ["a", "b", "B", None, "é"][min(k % 9, 4)]) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    got = {r["doc_id"]: (r["size"], r["source_size"], round(r["target"], 6), r["taken"]) for r in mixing.mix(docs).collect()}
    assert got == {i: (a, b, round(c, 6), d) for i, (a, b, c, d) in brute(docs.collect()).items()}
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(2)).collect()}
    assert again == {i: v[3] for i, v in got.items()}
    mixed = Counter(r["doc_id"] for r in mixing.mixed_documents(docs).collect())
    assert mixed == {i: v[3] // v[0] for i, v in got.items() if v[3]}


def test_targets_cap_and_reshare(spark):
    sources = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 500)], "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(sources).collect()}
    want = targets({"a": 10, "b": 1000, "c": 0, None: 500})
    assert {k: round(v, 6) for k, v in got.items()} == {k: round(v, 6) for k, v in want.items()}


def test_edges(edge, empty):
    rows = mixing.mix(edge).collect()
    assert len(rows) == edge.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    mixed = mixing.mixed_documents(edge)
    assert mixed.columns == edge.columns and mixed.count() == sum(r["passes"] for r in rows)
    assert mixing.mix(empty).count() == mixing.mixed_documents(empty).count() == 0
