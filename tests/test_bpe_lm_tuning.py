import collections
import random
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from wordweft import catalog
from wordweft.operators import bpe, lm, merges, tuning
from wordweft.operators.ordinal import with_ordinal
from wordweft.plans.config import FastTextSettings, RunSettings, Word2VecSettings


def one_at_a_time(words, many):
    """Plain reference: most frequent pair first, ties by text."""
    table, out = {tuple(w): n for w, n in words.items()}, []
    while len(out) < many:
        count = collections.Counter()
        for parts, n in table.items():
            for pair in zip(parts, parts[1:]):
                count[pair] += n
        count = {p: n for p, n in count.items() if n >= 3}
        if not count:
            break
        best = min(count, key=lambda p: (-count[p], p))
        out.append(best)
        merged = {}
        for parts, n in table.items():
            new, i = [], 0
            while i < len(parts):
                step = 2 if tuple(parts[i:i + 2]) == best else 1
                new.append("".join(parts[i:i + step]))
                i += step
            merged[tuple(new)] = merged.get(tuple(new), 0) + n
        table = merged
    return out


@pytest.mark.parametrize("seed,active,symbols", [(1, 8192, 2_000_000), (2, 6, 2_000_000), (3, 3, 2_000_000), (4, 8192, 60), (5, 40, 1)])
def test_merges_equal_single_merges(spark, seed, active, symbols):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcd$.") for _ in range(rng.randint(1, 7))): rng.randint(1, 30) for _ in range(40)}
    words |= {"aaa": 9, "aaaaa": 4, "abab" * 5: 3, "": 5}
    counts = spark.createDataFrame(list(words.items()), "pretoken string, n bigint")
    many = 25 if symbols > 1000 and active > 10 else 9
    assert bpe.train_bpe(counts, 261 + many, active=active, segment_symbols=symbols) == one_at_a_time(words, many)


@pytest.mark.parametrize("seed", range(12))
def test_rounds_of_the_index_equal_single_merges(seed):
    """Rounds of many sizes on small alphabets, where ties, repeats and strings that arise twice are common."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("ab" if seed % 2 else "abc") for _ in range(rng.randint(1, 12))): rng.randint(1, 6) for _ in range(30)}
    want = one_at_a_time(words, 40)
    spelled, parts, got = list("abc"), {w: ["abc".index(c) for c in w] for w in words}, []
    known = {c: k for k, c in enumerate(spelled)}
    while len(got) < 40:
        count = collections.Counter()
        for w, p in parts.items():
            for pair in zip(p, p[1:]):
                count[pair] += words[w]
        ranked = sorted((p for p in count if count[p] >= 3), key=lambda p: (-count[p], spelled[p[0]], spelled[p[1]]))
        if not ranked:
            break
        size = rng.randint(2, 9)
        taken = ranked[:size]
        boundary = None if len(ranked) < size else (-count[taken[-1]], *(spelled[k] for k in taken[-1]))
        segments = collections.Counter()
        for w, p in parts.items():
            hit = [pair in taken for pair in zip(p, p[1:])]
            i = 0
            while i < len(hit):
                if hit[i]:
                    j = i
                    while j < len(hit) and hit[j]:
                        j += 1
                    segments[((i > 0) + 2 * (j + 1 < len(p)), *p[max(i - 1, 0):j + 2])] += words[w]
                    i = j
                i += 1
        index = merges.PairIndex([(list(s), n) for s, n in segments.items()], set(taken), spelled, known)
        learned = list(index.learn(40 - len(got), 3, boundary))
        assert learned
        got += [(spelled[a], spelled[b]) for a, b, _ in learned]
        ranks = merges.ranks_of([m[:2] for m in learned])
        parts = {w: merges.merge_symbols(p, ranks, [m[2] for m in learned], True) for w, p in parts.items()}
    assert got == want


def slow_merge(parts, pairs):
    rank = {p: k for k, p in reversed(list(enumerate(pairs)))}
    while len(parts) > 1:
        best = min(zip(parts, parts[1:]), key=lambda p: rank.get(p, len(rank)))
        if best not in rank:
            return parts
        out, i = [], 0
        while i < len(parts):
            step = 2 if tuple(parts[i:i + 2]) == best else 1
            out.append("".join(parts[i:i + step]))
            i += step
        parts = out
    return parts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_heap_equals_passes(seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abcd") for _ in range(rng.randint(1, 9))): rng.randint(3, 30) for _ in range(30)}
    pairs = one_at_a_time(words, 60)
    ranks, merged = merges.ranks_of(pairs), [a + b for a, b in pairs]
    for _ in range(200):
        word = [rng.choice("abcd") for _ in range(rng.randint(0, 40))]
        assert merges.merge_symbols(word, ranks, merged) == slow_merge(word, pairs)


def test_a_long_unbroken_run_is_encoded_fast():
    rng = random.Random(4)
    words = {"".join(rng.choice("abcdefgh") for _ in range(9)): rng.randint(3, 9) for _ in range(800)}
    pairs = one_at_a_time(words, 300)
    run = [rng.choice("abcdefgh") for _ in range(200_000)]
    start = time.process_time()
    parts = merges.merge_symbols(run, merges.ranks_of(pairs), [a + b for a, b in pairs])
    assert time.process_time() - start < 30
    assert "".join(parts) == "".join(run) and len(parts) < 0.6 * len(run)


def test_pretokens_and_symbols(spark):
    row = spark.createDataFrame([("I'm  día 42!?",)], "line string").select(
        bpe.pretokens(F.col("line")).alias("p"), bpe.to_symbols(F.lit(" ñ\t")).alias("s")).first()
    assert row["p"] == ["I", "'m", " ", " día", " 42", "!?"]
    alphabet = bpe.byte_alphabet()
    assert row["s"] == "".join(alphabet[b] for b in " ñ\t".encode()) and len(set(alphabet)) == 256


def test_encoding_keeps_the_text(spark, kept_of):
    text = ["low lower lowest newer", "newest día 😀"]
    kept = kept_of({"aa": {1: text}})
    found = bpe.train_bpe(bpe.pretoken_counts(kept.union(kept).union(kept)), 261 + 10)
    vocab_table, ranks = bpe.bpe_tables(spark, found)
    token = {r["id"]: r["token"] for r in vocab_table.collect()}
    assert [token[k] for k in range(5)] == bpe.SPECIALS and ranks.count() == len(found) > 0
    byte = {s: b for b, s in enumerate(bpe.byte_alphabet())}
    for r in bpe.encode_text(kept, found).collect():
        assert bytes(byte[c] for i in r["ids"] for c in token[i]).decode() == text[r["seq"]]
        assert len(r["ids"]) < len(text[r["seq"]].encode())


def test_masking(spark):
    ids = list(range(7)) * 40
    frame = spark.createDataFrame([(1, 1, ids)], "file bigint, seq bigint, ids array<int>")

    def run(share, epoch):
        return frame.select(lm.masked(F.col("ids"), share, 3, epoch, F.col("file"), F.col("seq")).alias("m")).first()["m"]

    assert run(0.0, 0) == ids
    assert run(1.0, 0) == [i if i < 3 else 4 for i in ids]
    some = run(0.15, 0)
    assert some != run(0.15, 1) and all(b == a or (b == 4 and a > 2) for a, b in zip(ids, some))
    assert 3 in [a for a, b in zip(ids, some) if a != b]
    row = frame.select(lm.padded(F.slice("ids", 1, 3), 8).alias("p"), lm.padded(F.col("ids"), 8).alias("q")).first()
    assert row["p"] == [0, 0, 1, 2, 2, 1, 1, 1] and len(row["q"]) == 8 and row["q"][-1] == 2


def test_character_streams(small_blocks, kept_of):
    files = {k: [f"line {k} {j} " + "é" * (j % 5) for j in range(9)] for k in range(1, 6)}
    lines = with_ordinal(kept_of({"aa": files}))
    flow = "".join(x + "\n" for _, ls in sorted(files.items()) for x in ls)
    size = len(flow) // 4
    want = {}
    for s in range(4):
        part = flow[s * size:(s + 1) * size]
        for w in range(0, size, 17):
            if len(part[w:w + 18]) > 1:
                want[s, w // 17] = (part[w:w + 18][:-1], part[w:w + 18][1:])
    got = {(r["stream"], r["window"]): (r["input"], r["target"]) for r in lm.char_sequences(lines, 4, 17).collect()}
    assert got == want
    pairs = {(r["item"], r["target"]): r["n"] for r in lm.next_char_counts(lines).collect()}
    assert pairs == collections.Counter(zip(flow, flow[1:]))


def test_batches_are_full(spark):
    lines = spark.range(100).select(F.lit("aa").alias("lang"), F.lit(1).alias("shard"), F.col("id").alias("file"), F.col("id").alias("seq"))
    first = lm.shuffled_batches(lines, 32, 1, 0).collect()
    assert collections.Counter(r["batch"] for r in first) == {0: 32, 1: 32, 2: 32}
    second = lm.shuffled_batches(lines.repartition(5), 32, 1, 1).collect()
    assert {(r["file"], r["batch"]) for r in first} != {(r["file"], r["batch"]) for r in second}


def test_trials(spark):
    runs = spark.createDataFrame([("aa", "glove")], "lang string, algorithm string")
    space = {"a": {"randint": [2, 5]}, "b": {"qrandint": [5, 50, 5]}, "c": {"choice": ["x", "y"]}, "d": {"loguniform": [0.001, 1]},
             "e": {"lograndint": [2, 30]}, "f": {"qlograndint": [8, 128, 8]}}
    rows = tuning.sample_trials(runs, space, 200, 3).collect()
    assert len(rows) == 200 and {r["a"] for r in rows} == {2, 3, 4} and {r["c"] for r in rows} == {"x", "y"}
    assert all(5 <= r["b"] <= 50 and r["b"] % 5 == 0 for r in rows) and all(0.001 <= r["d"] < 1 for r in rows)
    assert all(2 <= r["e"] < 30 and r["f"] % 8 == 0 and 8 <= r["f"] <= 128 for r in rows)
    scores = spark.createDataFrame([("aa", "glove", 3, 0.5), ("aa", "glove", 1, 0.5), ("aa", "glove", 0, 0.2)],
                                   "lang string, algorithm string, trial_number bigint, accuracy double")
    assert tuning.best_trial(scores, []).first()["trial_number"] == 1
    trials = tuning.sample_trials(runs, space, 5, 3).select("lang", "algorithm", "trial_number")
    scored = {r["trial_number"]: r["accuracy"] for r in tuning.score_or_sentinel(trials, scores).collect()}
    assert scored == {0: 0.2, 1: 0.5, 2: -1.0, 3: 0.5, 4: -1.0}
    with pytest.raises(ValueError):
        tuning.sample_trials(runs, {"x": {"sorted": [1, 2]}})


def test_settings():
    assert Word2VecSettings.of({"window": {"randint": [3, 9]}}).window == 3
    with pytest.raises(ValueError):
        FastTextSettings.of({"autotuneMetrics": "f1"})
    with pytest.raises(ValueError):
        Word2VecSettings(hs=0, negative=0)
    with pytest.raises(ValueError):
        RunSettings.of({"input_dir": "i", "output_dir": "o", "algorithms": ["glove"]})


@pytest.mark.parametrize("seed", range(8))
def test_passes_over_all_words_equal_single_words(seed):
    """Runs of one symbol, words of one symbol, merges learned twice, and words side by side."""
    rng = random.Random(seed)
    words = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(50)] + [[0] * k for k in range(1, 7)]
    pairs, merged = [], []
    for k in range(12):
        pairs.append(rng.choice(pairs) if pairs and rng.random() < 0.2 else (rng.randrange(3 + k), rng.randrange(3 + k)))
        merged.append(3 + k)
    flat = np.array([s for w in words for s in w], np.int32)
    got, word = merges.merge_passes(flat, np.repeat(np.arange(len(words)), [len(w) for w in words]), pairs, merged)
    assert [got[word == k].tolist() for k in range(len(words))] == [merges.merge_symbols(w, merges.ranks_of(pairs), merged, True) for w in words]


@pytest.mark.parametrize("passes", [256, 0])
def test_pieces_are_encoded_and_decoded_the_same_way_by_word_or_by_pass(spark, monkeypatch, passes):
    monkeypatch.setattr(bpe, "PASSES", passes)
    monkeypatch.setattr(merges, "PASSES", passes)
    lines = [" the  then é€ thethe", "", "ththth hhh\tx", "日本 the", "a" * 90 + "the"]
    rows = spark.createDataFrame([("x", 1, 0, k, line) for k, line in enumerate(lines)], "lang string, file long, slab long, seq long, line string")
    learned = [("t", "h"), ("th", "e"), ("Ġ", "the"), ("h", "h"), ("a", "a"), ("aa", "aa")]
    encoded = bpe.encode_text(rows, learned).select("seq", "ids", bpe.decoder(learned)("ids").alias("text")).orderBy("seq").collect()
    assert [r["text"] for r in encoded] == lines
    names = dict(enumerate(dict.fromkeys(bpe.SPECIALS + sorted(bpe.byte_alphabet()) + [a + b for a, b in learned])))
    assert [names[i] for i in encoded[0]["ids"]][:6] == ["Ġthe", "Ġ", "Ġthe", "n", "Ġ", "Ã"]
    assert [names[i] for i in encoded[2]["ids"]][:5] == ["th", "th", "th", "Ġ", "hh"]
    plain = rows.select(bpe.encoder(learned)(F.transform(bpe.pretokens(F.col("line")), bpe.to_symbols)).alias("ids"))
    assert sorted(r["ids"] for r in plain.collect()) == sorted(r["ids"] for r in encoded)
    half = spark.createDataFrame([([*encoded[0]["ids"][5:6]],)], "ids array<int>").select(bpe.decoder(learned)("ids")).first()[0]
    assert half == "\N{REPLACEMENT CHARACTER}"


def test_a_round_takes_no_more_pairs_than_its_merges_can_use(spark, monkeypatch):
    taken, find = [], merges.segments_of
    monkeypatch.setattr(merges, "segments_of", lambda words, active: (taken.append(len(active)), find(words, active))[1])
    rng = random.Random(8)
    words = {"".join(rng.choice("abcdefgh") for _ in range(6)): rng.randint(3, 30) for _ in range(60)}
    counts = spark.createDataFrame(list(words.items()), "pretoken string, n bigint")
    assert bpe.train_bpe(counts, 261 + 6) == one_at_a_time(words, 6)
    assert taken[0] == 12


@pytest.mark.parametrize("seed", range(4))
def test_registered_merges_use_the_published_vocabulary(spark, tmp_path, seed):
    """No cap below the published size: merging goes on until no pair is frequent enough, in Spark and in the SQL."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("ab" if seed % 2 else "abcdef") for _ in range(rng.randint(1, 9))): rng.randint(1, 9) for _ in range(150)}
    text = "\n".join(w for w, n in words.items() for _ in range(n))
    spark.createDataFrame([(1, "aa", text)], "doc_id bigint, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = [(k, a, b) for k, (a, b) in enumerate(one_at_a_time(words, 30_000 - 261))]
    assert len(want) > 60
    assert [tuple(r) for r in catalog.bpe_merges(spark, str(tmp_path)).orderBy("rank").collect()] == want
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(db.execute(catalog.ORACLES["bpe_merges"]).fetchall()) == want
