import numpy as np
import pytest
from pyspark.sql import functions as F

from test_train_and_io import COLD, WARM, gap, planted
from wordweft.plans import params as pm
from wordweft.plans import softmax, trainers
from wordweft.plans.config import FastTextSettings


def dense(preds, links, units, start, epochs, rate, end_rate):
    """The same steps with whole matrices: {(side, id): vector}, losses."""
    vec = {k: np.array(v, np.float64) for k, v in start.items()}
    acc = {k: np.ones_like(v) for k, v in vec.items()}
    outs = sorted(i for side, i in vec if side == 1)
    losses = []
    for epoch in range(epochs):
        grad, loss = {k: np.zeros_like(v) for k, v in vec.items()}, 0.0
        table = np.array([vec[1, i] for i in outs])
        for pred, ids in preds.items():
            rows = [r for i in ids for r in units[i]]
            h = np.mean([vec[0, r] for r in rows], axis=0)
            y = np.zeros(len(outs))
            for target, n in links.get(pred, {}).items():
                y[outs.index(target)] += n
            scores = table @ h
            log_sum = np.log(np.exp(scores - scores.max()).sum()) + scores.max()
            loss += (y * (log_sum - scores)).sum()
            pull = y.sum() * np.exp(scores - log_sum) - y
            for k, i in enumerate(outs):
                grad[1, i] += pull[k] * h
            for r in rows:
                grad[0, r] += pull @ table
        r = pm.rate_at(epoch, epochs, rate, end_rate)
        for k, g in grad.items():
            acc[k] += g * g
            vec[k] -= r * g / np.sqrt(acc[k])
        losses.append(loss)
    return vec, losses


@pytest.mark.parametrize("chunk,blocks", [(1000, 1), (3, 4)])
def test_equals_dense_steps(spark, chunk, blocks):
    rng = np.random.default_rng(3)
    units = {i: [i, *(1000 + rng.choice(5, rng.integers(0, 3), replace=False)).tolist()] for i in range(9)}
    preds = {p: rng.integers(0, 9, rng.integers(1, 4)).tolist() for p in range(12)}
    links = {p: {int(t): int(rng.integers(1, 5)) for t in rng.choice(9, rng.integers(1, 4), replace=False)} for p in list(preds)[:-1]}
    frames = (spark.createDataFrame([("aa", p, ids) for p, ids in preds.items()], "lang string, pred bigint, ids array<bigint>"),
              spark.createDataFrame([("aa", p, t, n) for p, ts in links.items() for t, n in ts.items()], "lang string, pred bigint, target bigint, n bigint"),
              spark.createDataFrame([("aa", i, ids) for i, ids in units.items()], "lang string, id bigint, ids array<bigint>"))
    ids = frames[2].select("lang", F.lit(0).alias("side"), F.explode("ids").alias("id")).union(frames[2].select("lang", F.lit(1), "id")).distinct()
    start = {(r["side"], r["id"]): r["vec"] for r in pm.initial(ids, 4, 7, True).collect()}
    found, losses = softmax.fit_softmax(*frames, 4, 3, 0.3, 0.1, 7, steps=1, chunk=chunk, blocks=blocks)
    del preds[11]  # no targets, nothing to learn
    want, want_losses = dense(preds, links, units, start, 3, 0.3, 0.1)
    assert np.allclose(losses, want_losses, rtol=1e-5)
    got = {(r["side"], r["id"]): r["vec"] for r in found.collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-4) for k in want)


@pytest.mark.parametrize("model,epochs,least", [("skipgram", 6, 0.3), ("cbow", 2, None)])
def test_planted_sets_separate(kept_of, model, epochs, least):
    lines = planted(40)
    settings = FastTextSettings(model=model, dim=10, epoch=epochs, lr=0.5, minn=5, maxn=5, bucket=500, t=0, minCount=1, loss="softmax")
    model = trainers.train_fasttext(kept_of({"aa": {1: lines[0::2], 2: lines[1::2]}}), settings)
    assert model.losses[-1] < model.losses[0]
    assert {r["word"] for r in model.vectors.select("word").collect()} == {*WARM, *COLD}
    assert least is None or gap(model.vectors) > least


def test_hot_rows_do_not_meet_in_one_task(spark):
    """A row that every chunk touches is in the travelling table; joined rows are touched a few times each."""
    rows = [("aa", chunk, 0, i) for chunk in range(200) for i in (0, 1, 1000 + chunk)]
    touched = pm.hot_and_cold(spark.createDataFrame(rows, "lang string, chunk int, side int, id bigint"), 4)
    params = pm.initial(touched.rows.select(*pm.KEYS).distinct(), 4, 1, False)
    found = pm.placed(touched, params)
    assert found.count() == len(rows)
    assert {r["id"] for r in touched.hot.collect()} == {0, 1}
    assert touched.rows.where("NOT is_hot").groupBy("id").count().agg(F.max("count")).first()[0] == 1
    few = pm.hot_and_cold(touched.rows.drop("is_hot"), 4, most_bytes=1)
    assert few.hot.count() == 1 and pm.placed(few, params).count() == len(rows)
