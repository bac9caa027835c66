import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordweft.functions import text
from wordweft.operators import shape, subword
from wordweft.operators.ordinal import with_ordinal
from wordweft.plans import trainers
from wordweft.plans.config import FastTextSettings, Word2VecSettings


@pytest.mark.parametrize("blocks", [(1, 1), (3, 4), (None, None)])
def test_blocked_means_equal_joined_means(spark, blocks):
    rng = np.random.default_rng(2)
    rows = [(lang, int(k), rng.normal(0, 1, 3).tolist()) for lang in ("aa", "bb") for k in range(40)]
    # Bucket 0 is linked to every word; repeated links count; some ids have no row, one word has none at all.
    links = [(lang, f"w{w}", int(i)) for lang in ("aa", "bb") for w in range(60) for i in (0, *rng.integers(0, 50, 6), 3, 3)] + [("aa", "lost", 99)]
    rows = spark.createDataFrame(rows, "lang string, id bigint, vector array<double>")
    links = spark.createDataFrame(links, "lang string, key string, id bigint")
    found = subword.blocked_means(links, rows, "double", *blocks)
    want = subword.mean_by(links.join(rows, ["lang", "id"]), ["lang", "key"], "vector", "float64")
    got, want = ({(r["lang"], r["key"]): r["vector"] for r in d.collect()} for d in (found, want))
    assert got.keys() == want.keys() and ("aa", "lost") not in got
    assert all(np.allclose(got[k], want[k]) for k in want)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert subword.blocked_means(links.where("false"), rows).count() == 0


def lines_of(kept_of):
    said = [f"alpha beta w{k % 5}  gamma w{k % 3} delta" if k % 2 else f"beta w{k % 4} alpha alpha" for k in range(23)]
    return with_ordinal(kept_of({"aa": {1: said[:9], 2: said[9:]}, "bb": {1: said[:3]}}))


def test_curve_equals_single_trainings_and_cuts_words_once(kept_of, monkeypatch):
    lines, cuts = lines_of(kept_of), []
    plain = text.split_spaces
    train = lambda k: trainers.train_word2vec(k, Word2VecSettings(vector_size=4, epochs=1, min_count=2, seed=3))
    monkeypatch.setattr(text, "split_spaces", lambda *a: cuts.append(a) or plain(*a))
    found = {(r["lang"], r["size"], r["word"]): r["vector"] for r in trainers.train_curve(lines, 12, train).collect()}
    assert len(cuts) == 1
    want = {}
    for size, langs in ((12, ("aa", "bb")), (24, ("aa",))):
        part = shape.prefix(lines, size).where(F.col("lang").isin(*langs))
        want |= {(r["lang"], size, r["word"]): r["vector"] for r in train(part).vectors.collect()}
    assert found.keys() == want.keys()
    assert all(np.allclose(found[k], want[k], atol=1e-6) for k in want)


def test_subsampled_lines_keep_their_words(kept_of):
    model = trainers.train_fasttext(lines_of(kept_of), FastTextSettings(dim=4, epoch=1, minCount=1, t=0.05, bucket=50, seed=2))
    assert {"alpha", "beta"} <= {r["word"] for r in model.vectors.collect()}


def test_sizes_of_a_curve_train_at_a_time(kept_of):
    lines, meet = lines_of(kept_of), threading.Barrier(2)

    def train(part):
        meet.wait(60)
        return trainers.Model(part.counts.select("lang", F.lit("any").alias("algorithm"), F.lit(-1).alias("size"), "word"), [])

    found = trainers.train_curve(lines, 12, train)
    assert {r["size"] for r in found.select("size").distinct().collect()} == {12, 24}
