import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests").config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_blocks(monkeypatch):
    """Tiny slabs and radix runs, so that small inputs cross every block border."""
    from wordweft.operators import ordinal
    from wordweft.sources import corpus
    monkeypatch.setattr(corpus, "SLAB_LINES", 4)
    monkeypatch.setattr(ordinal, "RADIX_BITS", 1)


@pytest.fixture
def kept_of(spark):
    """{lang: {file: [lines]}} -> kept lines."""
    from wordweft.sources.corpus import kept_lines_from_texts

    def build(corpora, scope="lead"):
        rows = [(lang, file, "\n".join(lines)) for lang, files in corpora.items() for file, lines in files.items()]
        return kept_lines_from_texts(spark.createDataFrame(rows, "lang string, doc_id bigint, text string"),
                                     corrupt_scope=scope)
    return build
