import importlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import TABLES, normal
from tests.llm.test_exact_dedup import fold
from tests.llm.test_mixing import brute as mixed
from tests.llm.test_ngram_join import brute as classes
from wordweft.llm import packing, queries, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_each_stage_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, held, FOLDER)
        if number < 4:
            assert out.columns == docs.columns
        before = held.collect()
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        ids = Counter(r["doc_id"] for r in out.collect())
        if number == 0:
            model = toxicity.train(held, spark.read.parquet(f"{FOLDER}/labels.parquet"))
            chance = model.probability([r["text"] or "" for r in before])
            assert set(ids) == {r["doc_id"] for r, p in zip(before, chance) if p < toxicity.THRESHOLD}
        if number == 1:
            stay = {}
            for r in before:
                stay[fold(r["text"])] = max(stay.get(fold(r["text"]), -1), r["doc_id"])
            assert ids == Counter(stay.values())
        if number == 2:
            assert ids == Counter({c for _, c, _, _ in classes([(r["doc_id"], r["text"]) for r in before])})
        if number == 3:
            assert ids == Counter({i: v[3] // v[0] for i, v in mixed(before).items() if v[3]})
        if number == 4:
            pieces = out.collect()
            assert Counter(r["doc_id"] for r in pieces if r["piece"] == 0) == Counter(r["doc_id"] for r in before)
            assert len({r["sequence_id"] for r in pieces}) <= 1.05 * sum(r["length"] for r in pieces) / packing.LENGTH + 1
        held = out


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = entry.queries()[name](spark, FOLDER)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(tuple(normal(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(map(normal, r)) for r in cursor.fetchall())


def test_registry():
    assert {f"op{k}" for k in range(1, 14)} | {"pipeline"} == {q.split("_")[0] for q in queries.QUERIES}
    assert not any("wordweft.llm" in open(m.__file__).read() for m in map(importlib.import_module, ("wordweft", "wordweft.catalog")))
