import itertools

import pytest
from pyspark.sql import functions as F

from wordweft.functions import text as tx
from wordweft.operators import shape
from wordweft.operators.ordinal import range_rank, with_ordinal
from wordweft.sources import corpus

LEADS = ["a", "é", "7", "_", ".", '"', "(", "½", "$", "+", "<", "=", "©", "😀", "﻿", "�"]


def test_line_filters(spark):
    blank = ["", "   ", "\t", " ", " ", "\x1c"]
    lines = blank + [x + "bc" for x in LEADS] + ["mid$dle", "  x", " $x"]
    rows = spark.createDataFrame([(x,) for x in lines], "line string").select(
        "line", tx.is_blank(F.col("line")).alias("b"), tx.is_corrupt(F.col("line")).alias("c"),
        tx.is_corrupt(F.col("line"), "any").alias("any"), tx.is_kept(F.col("line")).alias("k")).collect()
    by = {r["line"]: r for r in rows}
    assert [x for x in lines if by[x]["b"]] == blank
    assert [x[0] for x in lines if by[x]["c"] and x not in blank] == ["½", "$", "+", "<", "=", "©", "😀", "﻿", "�"]
    assert not by["mid$dle"]["c"] and by["mid$dle"]["any"]
    assert all(r["k"] == (not r["b"] and not r["c"]) for r in rows if r["line"] != "\x1c")


@pytest.mark.parametrize("text,lines", [
    ("", []), ("\n", [""]), ("a", ["a"]), ("a\n", ["a"]), ("a\r\nb\rc\n\nd", ["a", "b", "c", "", "d"]), ("a\r\n", ["a"])])
def test_split_lines(spark, text, lines):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(tx.split_lines(F.col("t")).alias("x")).first()["x"] == lines


def test_tokens(spark):
    row = spark.createDataFrame([("  a  b c  ",)], "t string").select(
        tx.split_spaces(F.col("t")).alias("keep"), tx.split_spaces(F.col("t"), False).alias("drop"),
        tx.split_whitespace(F.col("t")).alias("white"), tx.rstrip(F.col("t")).alias("r"),
        tx.characters(F.lit("a😀b")).alias("c")).first()
    assert row["keep"] == ["a", "", "b", "c"] and row["drop"] == row["white"] == ["a", "b", "c"]
    assert row["r"] == "  a  b c" and row["c"] == ["a", "😀", "b"]


def numbered(sizes, start=0):
    return {start + 3 * k: [f"l{k}.{j}" for j in range(n)] for k, n in enumerate(sizes)}


def test_ordinals_over_many_slabs(small_blocks, kept_of):
    corpora = {"aa": numbered([5, 31, 70, 1, 62, 3]), "bb": numbered([9, 2], 1000)}
    got = {(r["lang"], r["line"]): r["ordinal"] for r in with_ordinal(kept_of(corpora)).collect()}
    for lang, files in corpora.items():
        flat = [line for _, lines in sorted(files.items()) for line in lines]
        assert [got[lang, x] for x in flat] == list(range(len(flat)))


def test_merged_rows_flow_across_files(small_blocks, kept_of):
    files = numbered([5, 31, 70, 0, 62, 3])
    want, row = {}, 0
    for _, lines in sorted(files.items()):
        held = 0
        for line in lines:
            want[line] = row
            held = held + 1 if held < 30 else 0
            row += held == 0
    kept = kept_of({"aa": {k: v for k, v in files.items() if v}})
    assert {r["line"]: r["doc_ord"] for r in shape.merged_rows(kept).collect()} == want
    sizes = [len(list(g)) for _, g in itertools.groupby(want.values())]
    assert sizes == [36, 31, 31, 39, 31, 3]


def test_splits_and_shards(spark):
    n = 1000
    rows = spark.range(n).select(F.col("id").alias("ordinal"))
    got = shape.with_split(rows).withColumn("s7", shape.fixed_shard(F.col("ordinal"), 7)).orderBy("ordinal").collect()
    held, flip, t = 0, False, 0
    for i, r in enumerate(got):
        if held == 99:
            assert r["split"] == ("valid" if flip else "test") and r["train_ordinal"] is None
            held, flip = (0, False) if flip else (99, True)
        else:
            assert (r["split"], r["train_ordinal"]) == ("train", t)
            held, t = held + 1, t + 1
        assert r["s7"] == i // 7 + 1


@pytest.mark.parametrize("limit", [10, 11, 100])
def test_counter_raised_twice(spark, limit):
    want, shard, count = [], 0, 0
    for _ in range(400):
        count += 1
        if count > limit:
            shard, count = shard + 1, 0
        want.append(shard)
        count += 1
    got = spark.range(400).select(shape.counted_twice_shard(F.col("id"), limit).alias("s")).collect()
    assert [r["s"] for r in got] == want


def test_train_prefix(spark):
    lines = shape.with_split(spark.range(1000).select(F.col("id").alias("ordinal"))).orderBy("ordinal").collect()
    for n in (1, 98, 99, 100, 198, 199, 500):
        seen, want = 0, []
        for r in lines:
            want.append(r["ordinal"])
            seen += r["split"] == "train"
            if seen == n:
                break
        got = shape.prefix_train(spark.range(1000).select(F.col("id").alias("ordinal")), n).count()
        assert got == len(want)


def test_curve_sizes(spark):
    for total in (0, 1, 7, 8, 9, 64, 100):
        for init in (1, 2, 8, 10):
            want, size = [size := init], init
            while size <= total:
                size *= 2
                want.append(size)
            rows = shape.curve_sizes(spark.createDataFrame([("a", total)], "lang string, n_lines bigint"), init).collect()
            assert sorted(r["size"] for r in rows) == want
            assert [r["size"] for r in rows if r["is_full"]] == [want[-1]]


def test_sentences_over_many_slabs(small_blocks, spark):
    text = "a\tX\nb\tY\n\nc\tX\n\n\nd\tZ\ne\tX\nf\tY\ng\tX\n"
    lines = corpus.lines_from_texts(spark.createDataFrame([("train", 1, text)], "lang string, doc_id bigint, text string"))
    got = [(r["sent_id"], r["pos"], r["token"], r["tag"])
           for r in shape.sentences_of_tagged(lines).orderBy("sent_id", "pos").collect()]
    assert got == [(0, 0, "a", "X"), (0, 1, "b", "Y"), (1, 0, "c", "X"), (3, 0, "d", "Z"), (3, 1, "e", "X"),
                   (3, 2, "f", "Y"), (3, 3, "g", "X")]


def test_range_rank_with_a_hot_tie(spark):
    rows = [("a", f"w{k:04d}", 1) for k in range(900)] + [("a", "top", 9), ("b", "x", 2), ("b", "y", 2)]
    frame = spark.createDataFrame(rows, "lang string, word string, n bigint").repartition(7)
    got = {(r["lang"], r["word"]): r["id"] for r in range_rank(frame, ["lang"], [F.desc("n"), F.asc("word")], "id", 6).collect()}
    assert got["a", "top"] == 0 and got["b", "x"] == 0 and got["b", "y"] == 1
    assert [got["a", f"w{k:04d}"] for k in range(900)] == list(range(1, 901))


def test_tagged_texts_need_no_shuffle(spark):
    texts = spark.createDataFrame([
        (1, "a\tX\nb\tY\n\nc\tX\n"), (2, "\n \na\tX\r\n\n\n\nb\tY\nc  d\n\n"), (3, ""), (4, None), (5, "one"), (6, "\n")],
        "doc_id bigint, text string").withColumn("lang", F.lit("Train"))
    found = shape.sentences_of_tagged_texts(texts)
    by_lines = shape.sentences_of_tagged(corpus.lines_from_texts(texts))
    assert found.columns == by_lines.columns
    key = lambda r: (r["file"], r["sent_id"], r["pos"])
    assert sorted(found.collect(), key=key) == sorted(by_lines.collect(), key=key)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_character_windows_do_not_number_lines(spark, monkeypatch):
    """Windows follow running sums; an ordinal would shuffle every line once more for each of them."""
    from wordweft import catalog
    seen, keep = [], catalog.lm.char_sequences
    monkeypatch.setattr(catalog.lm, "char_sequences", lambda lines, *rest: (seen.append(lines.columns), keep(lines, *rest))[1])
    catalog.char_lm_sequences(spark, "/root/testdata/sf0.001")
    assert len(seen) == 1 and "ordinal" not in seen[0]


def test_characters_are_encoded_where_the_lines_are(spark):
    from wordweft import catalog
    plan = catalog.encode_chars(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
