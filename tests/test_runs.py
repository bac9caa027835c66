"""Runs from published settings, tuning, stable line numbers, empty corpora."""

import random

import pytest
from pyspark.sql import functions as F

from wordweft.functions.hashing import hash_uniform
from wordweft.operators import lookup, ordinal, shape, tuning
from wordweft.plans import run, trainers
from wordweft.plans.config import FastTextSettings, GloveSettings, RunSettings, Word2VecSettings
from wordweft.sources import corpus

PUBLISHED = {
    "w2v-s": {"vector_size": 6, "window": 2, "min_count": 1, "workers": 8, "epochs": 1, "sg": 1, "hs": 1, "negative": 0,
              "max_vocab_size": None, "compute_loss": False},
    "w2v-c": {"vector_size": 6, "min_count": 1, "workers": 8, "epochs": 1, "sg": 0, "hs": 1, "cbow_mean": 0},
    "glove": {"verbose": 2, "memory": 32.0, "vocab_min_count": 1, "vector_size": 6, "max_iter": 1, "binary": 2, "num_threads": 16},
    "fasttext-s": {"model": "skipgram", "dim": 6, "epoch": 1, "minCount": 1, "minCountLabel": 0, "wordNgrams": 1, "bucket": 200,
                   "thread": 16, "lrUpdateRate": 100, "verbose": 2, "pretrainedVectors": "", "seed": 0},
    "fasttext-c": {"model": "cbow", "dim": 6, "epoch": 1, "minCount": 1, "bucket": 200, "label": "__label__", "autotuneMetric": "f1"},
    "flair-f": {"hidden_size": 2048, "nlayers": 2, "sequence_length": 20, "mini_batch_size": 2, "is_forward_lm": True},
    "flair-b": {"learning_rate": 10, "sequence_length": 20, "mini_batch_size": 2, "is_forward_lm": False, "pretrained_model": None},
    "elmo": {"#comment": "about", "config_file": "some.jsonnet"},
    "roberta": {"roberta_config": {"vocab_size": 270, "hidden_size": 768}, "epochs": 1, "batch_size": 4, "max_position_size": 16,
                "lines_per_instance": 20, "cuda_instance": 2},
}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


def sentences(n, seed=1):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["one", "two", "three", "four", "five"]) for _ in range(6)) for _ in range(n)]


def test_published_settings_run(spark, tmp_path):
    write(tmp_path / "in" / "aa" / "a.txt", "\n".join(line + "  " for line in sentences(40)) + "\n")
    out = str(tmp_path / "out")
    config = {"input_dir": str(tmp_path / "in"), "output_dir": out, "languages": ["aa"], "algorithms": list(PUBLISHED), **PUBLISHED}
    run.run_all(spark, RunSettings.of(config))
    kinds = {r[0] for r in spark.read.parquet(f"{out}/vectors").select("algorithm").distinct().collect()}
    assert kinds == {"w2v-skipgram", "w2v-cbow", "GloVe", "fastText-skipgram", "fastText-cbow"}
    assert spark.read.parquet(f"{out}/elmo/char_ids").count() == 7  # five words and both ends
    rows = spark.read.parquet(f"{out}/elmo/sequences").collect()
    assert len(rows) == 40 and all(r["tokens"][0] == "<S>" and r["n_tokens"] == 8 for r in rows)
    assert all(r["value"] == r["value"].rstrip() for r in spark.read.text(f"{out}/roberta/text").collect())
    with pytest.raises(ValueError, match="unknown settings"):
        RunSettings.of(config | {"languagez": []})
    with pytest.raises(ValueError, match="unknown settings"):
        Word2VecSettings.of({"vectorsize": 3})


def test_curve_of_prepared_inputs(spark, tmp_path):
    write(tmp_path / "in" / "aa" / "a.txt", "\n".join(sentences(40)) + "\n")
    settings = RunSettings(str(tmp_path / "in"), str(tmp_path / "out"), ["aa"], ["elmo"], 15, {"elmo": {}})
    run.run_all(spark, settings)
    counts = {size: spark.read.parquet(f"{tmp_path}/out/elmo/size={size}/sequences").count() for size in (15, 30, 60)}
    assert counts == {15: 15, 30: 30, 60: 40}


def test_tuning_run_writes_trials_and_best(spark, tmp_path):
    write(tmp_path / "in" / "aa" / "a.txt", "\n".join(sentences(40)) + "\n")
    for kind in ("full_train", "test"):
        write(tmp_path / "tags" / "aa" / f"Data.pos.{kind}.aa.tsv", "one\tX\ntwo\tY\n\nthree\tX\nfour\tY\n")
    params = {"w2v-s": {"vector_size": {"choice": [4, 6]}, "epochs": 1, "min_count": 1, "workers": 2}, "elmo": {}}
    settings = RunSettings(str(tmp_path / "in"), str(tmp_path / "out"), ["aa"], list(params), params=params,
                           tuning_settings={"tuning_data_dir": str(tmp_path / "tags"), "num": 2, "threads": 3, "gpu": 0})
    run.run_all(spark, settings)
    trials = spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/out/TuningResults/trials")
    assert trials.count() == 2 and {r["algorithm"] for r in trials.collect()} == {"w2v-s"}
    best = {r[1]: r[2] for r in spark.read.option("sep", "\t").csv(f"{tmp_path}/out/TuningResults/best").collect()}
    assert best["elmo"] == "N/A" and '"accuracy"' in best["w2v-s"]


def test_mistakes_in_tuning_are_raised(spark, kept_of):
    kept = ordinal.with_ordinal(kept_of({"aa": {1: sentences(5)}}))
    for algorithm, params in (("w2v-s", {"vektor_size": 3}), ("roberta", {}), ("word2vec", {})):
        with pytest.raises(ValueError):
            run.tune(kept, kept, algorithm, params, 2)


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    for k in range(3):
        write(tmp_path / "aa" / f"f{k}.txt", "\n".join([*sentences(300, k), "", "  "] * 2) + "\n")
    found, before = [], spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for most in ("128m", "6k", "2k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            spark.conf.set("spark.sql.files.openCostInBytes", "1k")
            kept = ordinal.with_ordinal(shape.kept_lines(corpus.read_corpus(spark, str(tmp_path), ["aa"])))
            rows = tuning.dev_holdout(kept, 0.2, 3, F.col("file"), F.col("seq"))
            found.append(sorted((r["file"], r["seq"], r["ordinal"], r["kept_no"], r["is_dev"], r["line"]) for r in rows.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1] == found[2]
    assert [r[2] for r in found[0]] == list(range(1800))


def test_numbering_shuffles_no_line(spark, tmp_path, capsys):
    write(tmp_path / "aa" / "f.txt", "\n".join(sentences(20)))
    lines = corpus.read_corpus(spark, str(tmp_path), ["aa"])
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert not any("hashpartitioning" in row for row in plan.splitlines() if "line#" in row)


@pytest.mark.parametrize("lines", [[], ["", "  "], ["$ dropped"], ["one"]])
def test_corpora_without_words(spark, kept_of, lines):
    kept = kept_of({"aa": {1: lines}})
    for model in (trainers.train_word2vec(kept, Word2VecSettings(vector_size=4, epochs=1)),
                  trainers.train_word2vec(kept, Word2VecSettings(vector_size=4, epochs=1, sg=0)),
                  trainers.train_glove(kept, GloveSettings(vector_size=4, max_iter=1)),
                  trainers.train_fasttext(kept, FastTextSettings(dim=4, epoch=1, bucket=10))):
        assert model.vectors.count() == 0
    assert trainers.train_curve(ordinal.with_ordinal(kept), 2, lambda k: trainers.train_word2vec(
        k, Word2VecSettings(vector_size=4, epochs=1))).count() == 0


def test_words_without_pairs_keep_their_vectors(kept_of):
    kept = kept_of({"aa": {1: ["alone", "alone", "alone"]}})
    for settings in (Word2VecSettings(vector_size=4, epochs=1), Word2VecSettings(vector_size=4, epochs=1, hs=0, negative=2)):
        assert trainers.train_word2vec(kept, settings).vectors.count() == 1


def test_hot_lookup_forms(spark):
    words = spark.range(20_000).selectExpr("lpad(cast(id * 7919 as string), 10, '9') as word")
    vectors = spark.createDataFrame([("##########", [1.0]), ("x", [2.0])], "word string, vector array<float>")
    found = lookup.embed_words(words, vectors, 1)
    rows = found.groupBy("matched", "step").count().collect()
    assert [(r["matched"], r["step"], r["count"]) for r in rows] == [("##########", 2, words.distinct().count())]


def test_vectors_with_a_wrong_header_are_refused(spark, tmp_path):
    for name, text in (("good", "2 2\na 1 2\nb 3 4\n"), ("rows", "3 2\na 1 2\nb 3 4\n"), ("dims", "2 3\na 1 2\nb 3 4\n"),
                       ("ragged", "a 1 2\nb 3\n"), ("numbers", "2 1\n7 5\n8 6\n")):
        write(tmp_path / name, text)
    assert corpus.read_vectors(spark, str(tmp_path / "good")).count() == 2
    assert {r["word"] for r in corpus.read_vectors(spark, str(tmp_path / "numbers")).collect()} == {"7", "8"}
    for name in ("rows", "dims", "ragged"):
        with pytest.raises(ValueError):
            corpus.read_vectors(spark, str(tmp_path / name))


def test_draws_are_keyed_by_rows(spark):
    rows = spark.range(100).withColumn("u", hash_uniform(1, F.col("id")))
    assert {r["id"]: r["u"] for r in rows.collect()} == {r["id"]: r["u"] for r in rows.repartition(7).collect()}
