import random

import numpy as np
import pytest

import __spark_entry__ as entry
from wordweft.operators import scoring, shape, vocab
from wordweft.operators.ordinal import with_ordinal
from wordweft.plans import run, trainers
from wordweft.plans.config import FastTextSettings, GloveSettings, RunSettings, Word2VecSettings
from wordweft.sources import corpus, sinks

WARM, COLD = [f"warm{k}" for k in range(8)], [f"cold{k}" for k in range(8)]


def planted(n=300, seed=1):
    rng = random.Random(seed)
    return [" ".join(rng.choice(part) for _ in range(8)) for _ in range(n) for part in (WARM, COLD)]


def gap(vectors):
    """Mean cosine inside a word set minus the mean across the sets."""
    table = {r["word"]: np.array(r["vector"]) / np.linalg.norm(r["vector"]) for r in vectors.collect()}
    inside = [table[a] @ table[b] for part in (WARM, COLD) for a in part for b in part if a != b]
    across = [table[a] @ table[b] for a in WARM for b in COLD]
    return np.mean(inside) - np.mean(across)


@pytest.mark.parametrize("train", [
    lambda k: trainers.train_glove(k, GloveSettings(vector_size=10, max_iter=4, window_size=4, x_max=50, rate=0.3, local_passes=30)),
    lambda k: trainers.train_word2vec(k, Word2VecSettings(vector_size=10)),
    lambda k: trainers.train_word2vec(k, Word2VecSettings(vector_size=10, epochs=6, alpha=0.3, hs=0, negative=4, local_passes=30)),
    lambda k: trainers.train_word2vec(k, Word2VecSettings(vector_size=10, epochs=6, alpha=0.3, sg=0, hs=0, negative=4), 1500),
    lambda k: trainers.train_fasttext(k, FastTextSettings(dim=10, epoch=6, lr=0.3, minn=5, maxn=5, bucket=500, t=0), 1500),
], ids=["glove", "skipgram-tree", "skipgram-noise", "cbow-noise", "fasttext"])
def test_planted_sets_separate(request, kept_of, train):
    lines = planted()
    # Counts only tell the sets apart where they meet: one file lets merged rows mix them.
    files = {1: lines} if request.node.callspec.id == "glove" else {1: lines[0::2], 2: lines[1::2]}
    model = train(kept_of({"aa": files}))
    assert model.losses[-1] < model.losses[0]
    assert {r["word"] for r in model.vectors.select("word").collect()} == {*WARM, *COLD}
    assert gap(model.vectors) > 0.3


def test_curve_and_score(spark, kept_of):
    lines = with_ordinal(kept_of({"aa": {1: planted(60)}}))
    found = trainers.train_curve(lines, 40, lambda k: trainers.train_word2vec(
        k, Word2VecSettings(vector_size=6, epochs=2, min_count=1)))
    assert {r["size"] for r in found.select("size").distinct().collect()} == {40, 80, 160}
    tagged = spark.createDataFrame(
        [(s, 1, k, p, w, w[:4]) for k in range(40) for s in ("train", "test")
         for p, w in enumerate([random.Random(k).choice(WARM), random.Random(k).choice(COLD)])],
        "split string, file bigint, sent_id bigint, pos bigint, token string, tag string")
    vectors = spark.createDataFrame([(w, [1.0, 0.0]) for w in WARM] + [(w, [0.0, 1.0]) for w in COLD],
                                    "word string, vector array<float>")
    row = scoring.downstream_score(tagged, vectors, 2).first()
    assert (row["n_train"], row["n_test"], row["accuracy"]) == (80, 80, 1.0)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())


def test_files_in_and_out(spark, tmp_path):
    write(tmp_path / "aa" / "b.txt", "one two\r\n   \r\n$ drop\r\nlast line")
    write(tmp_path / "aa" / "sub" / "a.txt", "x\ry\n")
    write(tmp_path / "aa" / "z.dat", "only with any name\n")
    lines = corpus.read_corpus(spark, str(tmp_path), ["aa"])
    kept = with_ordinal(shape.kept_lines(lines)).orderBy("ordinal").collect()
    assert [r["line"] for r in kept] == ["one two", "last line", "x", "y"]
    assert [r["kept_no"] for r in kept] == [0, 1, 0, 1]
    assert corpus.read_corpus(spark, str(tmp_path), ["aa"], "*.*").count() == 7

    vectors = spark.createDataFrame([("aa", "GloVe", -1, "w", [1.5, -2.0]), ("aa", "GloVe", -1, "v", [0.25, 3.0])],
                                    "lang string, algorithm string, size bigint, word string, vector array<float>")
    sinks.write_vectors(vectors, str(tmp_path / "out"))
    sinks.write_vectors(vectors.withColumn("lang", vectors["word"]), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    sinks.export_vectors_text(vectors, str(tmp_path / "text"))
    back = {r["word"]: r["vector"] for r in corpus.read_vectors(spark, str(tmp_path / "text")).collect()}
    assert back == {"w": [1.5, -2.0], "v": [0.25, 3.0]}

    paths = corpus.tagging_paths(str(tmp_path / "tags"), "aa")
    write(tmp_path / "tags" / "aa" / "Data.pos.full_train.aa.tsv", "a\tX\nb\tY\n\nc\tX\n")
    write(tmp_path / "tags" / "aa" / "Data.pos.test.aa.tsv", "a\tX\n")
    tagged = shape.sentences_of_tagged(corpus.read_tagged_lines(spark, paths))
    assert sorted((r["split"], r["sent_id"], r["token"]) for r in tagged.collect()) == [
        ("test", 0, "a"), ("train", 0, "a"), ("train", 0, "b"), ("train", 1, "c")]
    assert {(r["tag"], r["n"], r["idx"]) for r in vocab.tag_dictionary(tagged).collect()} == {("X", 3, 1), ("Y", 1, 2)}


def test_run_all(spark, tmp_path):
    write(tmp_path / "in" / "aa" / "a.txt", "\n".join(planted(60)) + "\n")
    params = {"w2v-s": {"vector_size": 6, "epochs": 1}, "flair-b": {"mini_batch_size": 2, "sequence_length": 50}, "elmo": {},
              "roberta": {"vocab_size": 270, "epochs": 1, "batch_size": 8, "max_position_size": 16, "lines_per_instance": 40}}
    out = str(tmp_path / "out")
    table = run.run_all(spark, RunSettings(str(tmp_path / "in"), out, ["aa"], [*params, "lda"], params=params))
    assert {(r["algorithm"], r["known"]) for r in table.collect()} == {
        ("w2v-s", True), ("flair-b", True), ("elmo", True), ("roberta", True), ("lda", False)}
    assert spark.read.parquet(f"{out}/vectors").where("algorithm = 'w2v-skipgram'").count() == 16
    assert spark.read.parquet(f"{out}/flair-b/sequences").count() > 0
    held_out = [r["line"] for r in spark.read.parquet(f"{out}/flair-b/chars").selectExpr("sum(n) AS line").collect()]
    assert held_out == [sum(len(planted(60)[k]) + 1 for k in (99, 100))]
    splits = spark.read.text(f"{out}/elmo/text")
    assert {r["split"]: r["count"] for r in splits.groupBy("split").count().collect()} == {"train": 118, "test": 1, "valid": 1}
    encoded = spark.read.parquet(f"{out}/roberta/encoded")
    assert encoded.count() == 120 and {len(r["input_ids"]) for r in encoded.collect()} == {16}


def test_tuning(spark, kept_of):
    kept = kept_of({"aa": {1: planted(60)}})
    tagged = spark.createDataFrame(
        [(s, 1, k, 0, w, w[:4]) for s in ("train", "test") for k, w in enumerate(WARM + COLD)],
        "split string, file bigint, sent_id bigint, pos bigint, token string, tag string")
    space = {"vector_size": {"choice": [4, 6]}, "epochs": 1, "hs": {"randint": [0, 2]}}
    rows = run.tune(with_ordinal(kept), tagged, "w2v-s", space, num=3, seed=2).collect()
    assert len(rows) == 3 and all((r["accuracy"] == -1) == (r["hs"] == 0) for r in rows)


QUICK = ["cooccurrence", "split_99_1_1", "embed_lookup", "char_lm_sequences", "mlm_mask", "best_trial"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    import duckdb
    from check import TABLES, normal
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got = entry.queries()[name](spark, folder)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    want = sorted(tuple(map(normal, r)) for r in cursor.fetchall())
    assert sorted(columns) == sorted(got.columns)
    assert sorted(tuple(normal(r[c]) for c in columns) for r in got.collect()) == want


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
