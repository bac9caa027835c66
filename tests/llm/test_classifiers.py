import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from wordweft.llm import language, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.train(docs)
    rows = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_sees_text_alone(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = language.train(docs)
    moved = docs.withColumn("doc_id", -F.col("doc_id")).withColumn("lang", F.lit("xx"))
    a = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, model).collect()}
    b = {-r["doc_id"]: r["lang_pred"] for r in language.predict(moved, model).collect()}
    assert a == b


def test_codewords_are_apart():
    for n in (1, 2, 3, 6, 12, 40):
        code = language.codewords(n)
        assert len({tuple(c) for c in code.tolist()}) == n
        if n > 2:
            assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 2


def test_one_wrong_bit_is_corrected():
    code = language.codewords(5)
    model = language.Model(list("abcde"), code, np.zeros((language.BUCKETS, code.shape[1])))
    for k, word in enumerate(code):
        for bit in range(code.shape[1]):
            margins = word.astype(float)
            margins[bit] *= -1
            model.weights = np.tile(margins, (language.BUCKETS, 1))
            assert model.predict(["text"])[0][0] == "abcde"[k]


def test_language_edges(spark, edge, empty):
    model = language.train(edge)
    rows = language.predict(edge, model).collect()
    assert len(rows) == edge.count()
    assert {r["lang_pred"] for r in rows} <= {"en", "de", "und"}
    nothing = language.train(empty)
    assert language.predict(empty, nothing).count() == 0
    assert {(r["lang_pred"], r["score"]) for r in language.predict(edge, nothing).collect()} == {("und", 0.0)}
    assert [p[0] for p in model.predict([None, "", "12 !", "\n"])] == ["und"] * 4


INSULTS = ["gronkface", "blithersnot", "wretchling", "dolthead"]


def planted(n, seed=5):
    """Invented prose; every fourth text carries a few insults."""
    rng, out = random.Random(seed), []
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt"]
    for k in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(40, 200))]
        if k % 4 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        out.append((k, " ".join(words), int(k % 4 == 0)))
    return out


def test_toxicity_on_held_out_documents(spark):
    rows = planted(1200)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    held = [(got[k]["predicted"], toxic) for k, _, toxic in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert sum(p for p, t in held if t) / sum(t for _, t in held) > 0.85
    assert sum(p for p, t in held if not t) / len(held) < 0.02
    kept = {r["doc_id"] for r in toxicity.keep_clean(docs, model).collect()}
    assert kept == {k for k, r in got.items() if not r["predicted"]}


def test_toxicity_edges(spark, edge, empty):
    labels = spark.createDataFrame([(k, k % 2) for k in range(18)] + [(3, None), (None, 1), (4, 7)], "doc_id bigint, toxic int")
    model = toxicity.train(edge, labels)
    rows = toxicity.score(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.keep_clean(edge, model).columns == edge.columns
    assert toxicity.score(empty, model).count() == 0
    nothing = toxicity.train(edge, labels.where("false"))
    assert {r["score"] for r in toxicity.score(edge, nothing).collect()} == {0.0}
    assert {r["score"] for r in toxicity.score(edge, toxicity.train(edge, labels.where("toxic = 1"))).collect()} == {1.0}


def skewed(n, common, rare, seed):
    """Texts of which every fourth has the common word or, in two of five, one of the rare ones."""
    rng, rows, out = random.Random(seed), planted(n, seed), []
    for k, text, toxic in rows:
        words = [w for w in text.split() if w not in INSULTS]
        said = rng.choice(rare) if k % 5 < 2 else common
        for _ in range(4 if toxic else 0):
            words.insert(rng.randrange(len(words)), said)
        out.append((" ".join(words), toxic, said if toxic else None))
    return out


def recall_of_rare(common, rare):
    fitted, held = skewed(2400, common, rare, 11), skewed(1200, common, rare, 12)
    model = toxicity.fit([t for t, toxic, _ in fitted if toxic], [t for t, toxic, _ in fitted if not toxic])
    scores = model.probability([t for t, _, _ in held]) >= toxicity.THRESHOLD
    rows = [(p, w) for p, (_, _, w) in zip(scores, held, strict=True)]
    assert sum(p for p, w in rows if w is None) / len(rows) < 0.02
    return np.mean([p for p, w in rows if w in rare])


def test_rare_toxic_words_count_beside_a_frequent_one():
    assert recall_of_rare("gronkface", [f"vil{a}{b}mog" for a in "kpqz" for b in "uyw"]) > 0.85


def test_short_toxic_words_count():
    assert recall_of_rare("gronkface", ["zuk", "qy", "pyx", "wub"]) > 0.85


def test_chance_words_are_not_toxic():
    rng = random.Random(3)
    sides = [[{f"w{rng.randrange(20_000)}" for _ in range(100)} for _ in range(n)] for n in (400, 3000)]
    assert not toxicity.toxic_words(*sides)
    assert set(toxicity.toxic_words([s | {"vilmog"} if k < 30 else s for k, s in enumerate(sides[0])], sides[1])) == {"vilmog"}


def test_held_out_labels_teach_nothing(spark):
    rows = planted(300)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    labels = docs.select("doc_id", "toxic")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    a, b = (toxicity.train(docs.drop("toxic"), x) for x in (labels, labels.withColumn("toxic", F.when(held, 1).otherwise(F.col("toxic")))))
    assert a == b and a.flat is None


def test_toxicity_learns_from_long_texts_too(spark):
    """Where a class has only long texts, windows of them are learned from, and ordinary documents stay."""
    rows = [(k, text + (" and calm prose" * 2200 if not toxic else ""), toxic) for k, text, toxic in planted(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    assert model.flat is None
    kept = {r["doc_id"] for r in toxicity.keep_clean(docs, model).collect()}
    assert {k for k, _, toxic in rows if not toxic} <= kept


def test_toxicity_of_one_class_is_the_share_of_labels(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(40)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k if k % 4 else 1000 + k, int(k % 4 == 0)) for k in range(40)], "doc_id bigint, toxic int")
    known = [t for i, t in labels.collect() if zlib.crc32(str(i).encode()) % 3 != 1]
    model = toxicity.train(docs, labels)
    assert abs(model.flat - np.mean(known)) < 1e-9
    assert toxicity.keep_clean(docs, model).count() == 40


def test_language_learns_from_long_texts_too(spark):
    rng = random.Random(3)
    parts = {"aa": ["ka", "lo", "mi"], "bb": ["str", "ent", "och"]}
    rows = [(2 * k + n, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(20 if lang == "aa" else 5000)), lang)
            for k in range(30) for n, lang in enumerate(parts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, language.train(docs)).collect()}
    assert found == {k: lang for k, _, lang in rows}
