import random

import pytest

LONG = " ".join(f"word{k % 997}" for k in range(60_000))
COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
           # Extra columns that clash with names used inside the operators.
           "key bigint, size string, score string, bucket string, node int, _key string, passes int, digest string, at int")


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing extra columns."""
    rng = random.Random(4)
    words = [f"w{k}" for k in range(200)]
    base = [" ".join(rng.choice(words) for _ in range(40)) for _ in range(6)]
    texts = [None, "", " ", "one two three", "One Two THREE", LONG, LONG, LONG.upper(), base[0], base[0],
             base[0].replace(base[0].split()[3], "changed", 1), *base, "É é", "é É", "!!!"]
    rows = [(k, t, [None, "en", "de"][k % 3], [None, "b", "a", ""][k % 4], None if t is None else len(t)) for k, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[9], (None, base[1], "en", "a", 5), (None, None, None, None, None), (None, base[1], "en", "a", 5)]
    extra = (7, "x", "y", None, 1, "z", 2, "q", 3)
    return spark.createDataFrame([(*r, *extra) for r in rows], COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def texts_of(spark):
    def build(texts, **columns):
        rows = [(k, t, "en", "a", len(t or "")) for k, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return build
