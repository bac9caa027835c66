"""Registered queries over the driver tables, each next to the SQL that checks it.

A query is a function (spark, sf_dir) -> DataFrame; its SQL, where given, reads the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as tx
from .functions.hashing import hash_hex, hash_uniform
from .operators import bpe, lm, lookup, pairs, scoring, shape, subword, tuning, vocab
from .operators.ordinal import hash_rank, with_ordinal
from .plans import trainers
from .plans.config import FastTextSettings, GloveSettings, MaskedLmSettings, Word2VecSettings
from .sources import corpus
from .sources.session import spread, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

MIN_COUNT = 5
WINDOW = 5
SEED = 7
DIM = 64


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return register


# Whitespace and corrupt-character classes in RE2 syntax.
_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{A0}\p{Z}]"
_BLANK = f"^{_WS}*$"
_CORRUPT = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{P}\s\x{85}\x{A0}\p{Z}\x0b]"


def _sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _sql_u(seed, *keys: str) -> str:
    joined = ", ".join(["'" + str(seed) + "'", *[f"{k}::varchar" for k in keys]])
    return f"(('0x' || substr(md5(concat_ws('|', {joined})), 1, 8))::bigint::double / 4294967296.0::double)"


def _sql_lines(name: str, table: str, lang: str, file: str, body: str) -> str:
    return rf"""
{name}_raw AS (SELECT lower({lang}) AS lang, {file} AS file, string_split_regex({body}, '\r\n|\r|\n') AS a FROM {table}),
{name} AS (SELECT lang, file, seq, line FROM (
    SELECT lang, file, len(a) AS n, generate_subscripts(a, 1) - 1 AS seq, unnest(a) AS line FROM {name}_raw)
  WHERE NOT (line = '' AND seq = n - 1))"""


_LINES = _sql_lines("lines", "documents", "lang", "doc_id", "text")
_KEPT = _LINES + f""",
kept AS (SELECT lang, file, seq, line,
    row_number() OVER (PARTITION BY lang ORDER BY file, seq) - 1 AS i,
    row_number() OVER (PARTITION BY lang, file ORDER BY seq) - 1 AS k
  FROM lines WHERE NOT regexp_matches(line, '{_BLANK}') AND NOT regexp_matches(line, '^{_CORRUPT}'))"""
_TOKENS = _KEPT + f""",
tokens AS (SELECT lang, file, seq, i, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS word FROM (
    SELECT *, list_filter(string_split({_sql_strip('line')}, ' '), lambda x: x <> '') AS t FROM kept))"""
_COUNTS = _TOKENS + """,
counts AS (SELECT lang, word, count(*) AS n FROM tokens GROUP BY ALL)"""
_VOCAB = _COUNTS + f""",
vocab AS (SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) - 1 AS id
  FROM counts WHERE n >= {MIN_COUNT})"""
_SENT = _VOCAB + """,
sent AS (SELECT t.lang, t.file, t.seq, t.i, v.id,
    row_number() OVER (PARTITION BY t.lang, t.file, t.seq ORDER BY t.pos) - 1 AS p
  FROM tokens t JOIN vocab v ON t.lang = v.lang AND t.word = v.word)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")


def document_lines(spark, sf_dir) -> DataFrame:
    return corpus.lines_from_texts(documents(spark, sf_dir))


def kept_lines(spark, sf_dir) -> DataFrame:
    return corpus.kept_lines_from_texts(documents(spark, sf_dir))


def ordered_lines(spark, sf_dir) -> DataFrame:
    return with_ordinal(kept_lines(spark, sf_dir))


def document_tokens(spark, sf_dir) -> DataFrame:
    return shape.tokens_of(kept_lines(spark, sf_dir))


def document_vocab(spark, sf_dir, min_count: int = MIN_COUNT) -> DataFrame:
    return vocab.with_ids(vocab.word_counts(document_tokens(spark, sf_dir), min_count))


def sentence_ids(spark, sf_dir) -> DataFrame:
    """In-vocabulary word ids of each line."""
    return lookup.encode_lines(kept_lines(spark, sf_dir), document_vocab(spark, sf_dir), unknown=None, shift=0)


def conversation_tokens(spark, sf_dir) -> DataFrame:
    """Tokens of the conversations; the role is the corpus, (conversation, turn) the file."""
    talk = table(spark, sf_dir, "conversations").select(
        "role", (F.col("conv_id") * 100000 + F.col("turn")).alias("file"), "text")
    return shape.tokens_of(corpus.kept_lines_from_texts(talk, "role", "file"))


# ---------------------------------------------------------------- A. scans

@query(f"WITH {_LINES} SELECT lang, file, seq, line FROM lines")
def corpus_lines(spark, sf_dir):
    return document_lines(spark, sf_dir).select("lang", "file", "seq", "line")


@query(f"""WITH {_LINES}, {_sql_lines('talk', 'conversations', 'role', 'conv_id', 'text')}
SELECT lang, file, seq, line FROM lines UNION ALL SELECT lang, file, seq, line FROM talk""")
def corpus_union(spark, sf_dir):
    talk = corpus.lines_from_texts(table(spark, sf_dir, "conversations"), "role", "conv_id")
    return corpus.union_corpora(document_lines(spark, sf_dir), talk).select("lang", "file", "seq", "line")


@query(f"""WITH {_LINES}, full_lines AS (
  SELECT lang, file, row_number() OVER (PARTITION BY file ORDER BY seq) - 1 AS sent_id,
    list_filter(string_split_regex(line, '{_WS}+'), lambda x: x <> '') AS t
  FROM lines WHERE NOT regexp_matches(line, '{_BLANK}'))
SELECT file, sent_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token, lang AS tag FROM full_lines""")
def tagged_tokens(spark, sf_dir):
    """Column files made from the documents (tag = language), then parsed back by blank lines."""
    filled = F.filter(tx.split_lines(F.col("text")), lambda x: ~tx.is_blank(x))
    sentence = lambda x: F.concat(
        F.array_join(F.transform(tx.split_whitespace(x), lambda t: F.concat(t, F.lit("\t"), F.lower("lang"))), "\n"),
        F.lit("\n"))
    files = documents(spark, sf_dir).select(
        "doc_id", F.array_join(F.transform(filled, sentence), "\n").alias("text")).withColumn("lang", F.lit("train"))
    return shape.sentences_of_tagged_texts(files).select("file", "sent_id", "pos", "token", "tag")


# ---------------------------------------------------------------- B. filters

def _page_lines(spark, sf_dir, breaks: str = tx.LINE_BREAK) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("file"), F.posexplode(F.split("html", breaks, -1)).alias("seq", "line"),
    ).withColumn("seq", F.col("seq").cast("bigint"))


# Text between tags: here lines are often blank or end in spaces.
_SEGMENT = "<[^<>]*>|\r\n|\r|\n"


def _sql_pages(breaks: str) -> str:
    return f"""WITH pl AS (SELECT page_id AS file, generate_subscripts(a, 1) - 1 AS seq, unnest(a) AS line
  FROM (SELECT page_id, string_split_regex(html, '{breaks}') AS a FROM pages))"""


@query(_sql_pages(r"<[^<>]*>|\r\n|\r|\n") + f" SELECT file, seq, line FROM pl WHERE NOT regexp_matches(line, '{_BLANK}')")
def drop_blank(spark, sf_dir):
    return _page_lines(spark, sf_dir, _SEGMENT).where(~tx.is_blank(F.col("line")))


@query(_sql_pages(r"\r\n|\r|\n") + f" SELECT file, seq, line FROM pl WHERE NOT regexp_matches(line, '^{_CORRUPT}')")
def drop_corrupt_lead(spark, sf_dir):
    return _page_lines(spark, sf_dir).where(~tx.is_corrupt(F.col("line")))


@query(_sql_pages(r"<[^<>]*>|\r\n|\r|\n") + f" SELECT file, seq, line FROM pl WHERE NOT regexp_matches(line, '{_CORRUPT}')")
def drop_corrupt_any(spark, sf_dir):
    return _page_lines(spark, sf_dir, _SEGMENT).where(~tx.is_corrupt(F.col("line"), "any"))


@query(f"WITH {_LINES} SELECT lang, file, seq, line FROM lines WHERE lang = 'de'")
def lang_filter(spark, sf_dir):
    return corpus.select_language(document_lines(spark, sf_dir), "DE").select("lang", "file", "seq", "line")


@query(f"WITH {_COUNTS} SELECT lang, word, n FROM counts WHERE n >= {MIN_COUNT}")
def vocab_min_count(spark, sf_dir):
    return vocab.word_counts(document_tokens(spark, sf_dir), MIN_COUNT)


_SAMPLE = 0.001


@query(f"""WITH {_COUNTS}, totals AS (SELECT lang, sum(n)::double AS total FROM counts GROUP BY lang),
keep AS (SELECT lang, word, sqrt({_SAMPLE}::double / (n::double / total)) + {_SAMPLE}::double / (n::double / total) AS q
  FROM counts JOIN totals USING (lang))
SELECT t.lang, t.file, t.seq, t.pos, t.word FROM tokens t JOIN keep k ON t.lang = k.lang AND t.word = k.word
WHERE {_sql_u(SEED, 't.file', 't.seq', 't.pos')} < q""")
def subsample_tokens(spark, sf_dir):
    tokens = document_tokens(spark, sf_dir)
    counts = vocab.word_counts(tokens)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    keep = counts.join(totals, "lang").select(
        "lang", "word", "n", vocab.keep_probability(F.col("n"), F.col("total"), _SAMPLE).alias("q"))
    return (
        lookup.with_word_info(tokens, keep)
        .where(hash_uniform(SEED, F.col("file"), F.col("seq"), F.col("pos")) < F.col("q"))
        .select("lang", "file", "seq", "pos", "word")
    )


@query(f"""WITH {_COUNTS} SELECT t.lang, t.file, t.seq, t.pos, t.word FROM tokens t
JOIN counts c ON t.lang = c.lang AND t.word = c.word WHERE c.n >= {MIN_COUNT}""")
def in_vocab_tokens(spark, sf_dir):
    tokens = document_tokens(spark, sf_dir)
    known = vocab.word_counts(tokens, MIN_COUNT)
    return lookup.with_word_info(tokens, known).select("lang", "file", "seq", "pos", "word")


# ---------------------------------------------------------------- C. shaping

@query(f"""WITH {_KEPT} SELECT lang, file, seq, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS word
FROM (SELECT *, string_split({_sql_strip('line')}, ' ') AS t FROM kept)""")
def tokenise_space(spark, sf_dir):
    return shape.tokens_of(kept_lines(spark, sf_dir), keep_empty=True).select("lang", "file", "seq", "pos", "word")


@query(_sql_pages(r"<[^<>]*>|\r\n|\r|\n") + f" SELECT file, seq, regexp_replace(line, '{_WS}+$', '') AS line FROM pl")
def rstrip_lines(spark, sf_dir):
    return _page_lines(spark, sf_dir, _SEGMENT).withColumn("line", tx.rstrip(F.col("line")))


_DOC_ORD = """,
closed AS (SELECT lang, file, count(*) // 31 AS full_rows FROM kept GROUP BY ALL),
row_start AS (SELECT lang, file, sum(full_rows) OVER (PARTITION BY lang ORDER BY file) - full_rows AS s FROM closed),
merged AS (SELECT k.*, (r.s + k.k // 31)::bigint AS doc_ord FROM kept k JOIN row_start r ON k.lang = r.lang AND k.file = r.file)"""


@query(f"WITH {_KEPT}{_DOC_ORD} SELECT lang, doc_ord, file, seq, line FROM merged")
def glove_docs(spark, sf_dir):
    return shape.merged_rows(kept_lines(spark, sf_dir)).select("lang", "doc_ord", "file", "seq", "line")


@query(f"""WITH {_KEPT} SELECT lang, file, k // 31 AS doc_ord, string_agg(line, ' ' ORDER BY seq) AS text
FROM kept GROUP BY lang, file, k // 31""")
def glove_docs_per_file(spark, sf_dir):
    """Merged rows that end with their file: at most 31 lines, so they can be joined into one text."""
    rows = shape.merged_rows(kept_lines(spark, sf_dir), across_files=False)
    return rows.groupBy("lang", "file", "doc_ord").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("seq", "line")))["line"], " ").alias("text"))


@query(f"WITH {_KEPT} SELECT lang, file, seq, i // 100 + 1 AS shard FROM kept")
def shard_fixed(spark, sf_dir):
    lines = ordered_lines(spark, sf_dir)
    return lines.select("lang", "file", "seq", shape.fixed_shard(F.col("ordinal"), 100).alias("shard"))


_TRAIN = """,
splits AS (SELECT *, CASE WHEN i % 101 < 99 THEN 'train' WHEN i % 101 = 99 THEN 'test' ELSE 'valid' END AS split,
  CASE WHEN i % 101 < 99 THEN 99 * (i // 101) + i % 101 END AS t FROM kept)"""


@query(f"""WITH {_KEPT}{_TRAIN} SELECT lang, file, seq, t AS train_ordinal,
CASE WHEN t < 50 THEN 0 ELSE 1 + (t - 50) // 51 END AS shard FROM splits WHERE split = 'train'""")
def shard_elmo(spark, sf_dir):
    lines = shape.with_split(ordered_lines(spark, sf_dir)).where(F.col("split") == "train")
    return lines.select("lang", "file", "seq", "train_ordinal",
                        shape.counted_twice_shard(F.col("train_ordinal"), 100).alias("shard"))


@query(f"WITH {_KEPT}{_TRAIN} SELECT lang, file, seq, split, t AS train_ordinal FROM splits")
def split_99_1_1(spark, sf_dir):
    return shape.with_split(ordered_lines(spark, sf_dir)).select("lang", "file", "seq", "split", "train_ordinal")


@query(f"WITH {_KEPT} SELECT lang, file, seq, i AS ordinal FROM kept")
def line_ordinal(spark, sf_dir):
    return ordered_lines(spark, sf_dir).select("lang", "file", "seq", "ordinal")


@query(f"WITH {_KEPT} SELECT lang, file, seq, i AS ordinal, line FROM kept WHERE i < 500")
def prefix_lines(spark, sf_dir):
    return shape.prefix(ordered_lines(spark, sf_dir), 500).select("lang", "file", "seq", "ordinal", "line")


@query(f"""WITH {_KEPT}{_TRAIN}, seen AS (SELECT *, count(t) OVER (PARTITION BY lang ORDER BY i
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM splits)
SELECT lang, file, seq, i AS ordinal, split FROM seen WHERE before < 300""")
def prefix_train_lines(spark, sf_dir):
    lines = shape.prefix_train(ordered_lines(spark, sf_dir), 300)
    return shape.with_split(lines).select("lang", "file", "seq", "ordinal", "split")


_CURVE = """,
total AS (SELECT lang, count(*) AS n FROM kept GROUP BY lang),
runs AS (SELECT lang, n, run, 100 * (1::bigint << run) AS size FROM total, range(0, 40) r(run)
  WHERE run = 0 OR 100 * (1::bigint << (run - 1)) <= n)"""


@query(f"WITH {_KEPT}{_CURVE} SELECT lang, run, size, n AS n_lines, least(size, n) AS n_used, size > n AS is_full FROM runs")
def curve_sizes(spark, sf_dir):
    totals = kept_lines(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n_lines"))
    return shape.curve_sizes(totals, 100).select("lang", "run", "size", "n_lines", "n_used", "is_full")


@query(f"""WITH {_KEPT}{_CURVE} SELECT r.lang, r.run, r.size, count(*) AS n_lines, sum(length(k.line))::bigint AS n_chars
FROM runs r JOIN kept k ON r.lang = k.lang AND k.i < r.size GROUP BY ALL""")
def curve_line_stats(spark, sf_dir):
    return shape.curve_line_stats(ordered_lines(spark, sf_dir), 100)


_WORDS = f"list_filter(string_split_regex(line, '{_WS}+'), lambda x: x <> '')"


@query(f"""WITH {_KEPT} SELECT lang, file, seq, len(t)::bigint AS n_tokens,
array_to_string(list_concat(['<S>'], t[1:400], ['</S>']), ' ') AS sequence
FROM (SELECT *, {_WORDS} AS t FROM kept)""")
def sequence_bounds(spark, sf_dir):
    words = tx.split_whitespace(F.col("line"))
    return kept_lines(spark, sf_dir).select(
        "lang", "file", "seq", F.size(words).cast("bigint").alias("n_tokens"),
        F.array_join(shape.sequence_with_ends(words, 400), " ").alias("sequence"))


# ---------------------------------------------------------------- D. aggregations

@query(f"WITH {_COUNTS} SELECT lang, word, n FROM counts")
def vocab_count(spark, sf_dir):
    return vocab.word_counts(document_tokens(spark, sf_dir))


def _sql_chars(source: str) -> str:
    return f""",
chars AS (SELECT lang, unnest(string_split(line || chr(10), '')) AS item FROM {source}),
char_counts AS (SELECT lang, item, count(*) AS n FROM chars WHERE item <> '' GROUP BY ALL),
dict AS (SELECT lang, item, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, item) AS idx,
  (sum(n) OVER (PARTITION BY lang ORDER BY n DESC, item))::double / (sum(n) OVER (PARTITION BY lang))::double AS share
  FROM char_counts)"""


@query(f"WITH {_KEPT}{_sql_chars('kept')} SELECT lang, item, idx, n, round(share, 6) AS cum_share FROM dict")
def char_dictionary(spark, sf_dir):
    found = vocab.char_dictionary(vocab.char_counts(kept_lines(spark, sf_dir)))
    return found.withColumn("cum_share", F.round("cum_share", 6))


@query(f"""WITH {_KEPT}{_TRAIN}, heldout AS (SELECT * FROM splits WHERE split <> 'train'){_sql_chars('heldout')}
SELECT lang, item, idx, n, round(share, 6) AS cum_share FROM dict""")
def char_dictionary_heldout(spark, sf_dir):
    heldout = shape.with_split(ordered_lines(spark, sf_dir)).where(F.col("split") != "train")
    found = vocab.char_dictionary(vocab.char_counts(heldout))
    return found.withColumn("cum_share", F.round("cum_share", 6))


@query(f"""WITH {_KEPT} SELECT lang, count(*) AS n_lines, count(DISTINCT file) AS n_files, max(i // 100 + 1) AS n_shards
FROM kept GROUP BY lang""")
def corpus_stats(spark, sf_dir):
    return shape.corpus_stats(ordered_lines(spark, sf_dir), shape.fixed_shard(F.col("ordinal"), 100))


def glove_cooccurrence(spark, sf_dir, window: int = WINDOW) -> DataFrame:
    rows = shape.merged_rows(kept_lines(spark, sf_dir))
    sentences = stored(lookup.encode_lines(rows, document_vocab(spark, sf_dir), None, 0, carry=("doc_ord",)))
    return pairs.cooccurrence(pairs.position_chunks(sentences, window), window)


_COOC = f"{_SENT}{_DOC_ORD}" + f""",
flow AS (SELECT s.lang, m.doc_ord, s.id, row_number() OVER (PARTITION BY s.lang, m.doc_ord ORDER BY s.file, s.seq, s.p) AS place
  FROM sent s JOIN merged m ON s.lang = m.lang AND s.file = m.file AND s.seq = m.seq),
near AS ({' UNION ALL '.join(f"SELECT lang, id AS a, lead(id, {d}) OVER (PARTITION BY lang, doc_ord ORDER BY place) AS b, {d} AS d FROM flow" for d in range(1, WINDOW + 1))}),
cooc AS (SELECT lang, w, c, sum(1.0::double / d) AS x FROM (
  SELECT lang, a AS w, b AS c, d FROM near WHERE b IS NOT NULL
  UNION ALL SELECT lang, b, a, d FROM near WHERE b IS NOT NULL) GROUP BY lang, w, c)"""


@query(f"WITH {_COOC} SELECT lang, w, c, round(x, 6) AS x FROM cooc")
def cooccurrence(spark, sf_dir):
    return glove_cooccurrence(spark, sf_dir).withColumn("x", F.round("x", 6))


@query(f"""WITH {_TOKENS}, tags AS (SELECT lang AS tag, count(*) AS n FROM tokens GROUP BY lang)
SELECT tag, n, row_number() OVER (ORDER BY tag) AS idx FROM tags""")
def tag_dictionary(spark, sf_dir):
    return vocab.tag_dictionary(document_tokens(spark, sf_dir).select(F.col("lang").alias("tag")))


_NOISE = _VOCAB + """,
noise AS (SELECT lang, word, id, n, p, coalesce(sum(p) OVER (PARTITION BY lang ORDER BY id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::double) AS lo
  FROM (SELECT *, pow(n::double, 0.75::double) / sum(pow(n::double, 0.75::double)) OVER (PARTITION BY lang) AS p FROM vocab))"""


@query(f"WITH {_NOISE} SELECT lang, word, id, n, round(p, 9) AS p, round(lo, 9) AS lo, round(lo + p, 9) AS hi FROM noise")
def noise_distribution(spark, sf_dir):
    found = vocab.noise_distribution(document_vocab(spark, sf_dir))
    return found.select("lang", "word", "id", "n", *[F.round(c, 9).alias(c) for c in ("p", "lo", "hi")])


@query(f"""WITH {_COUNTS}, w AS (SELECT lang, count(*) AS n_words FROM counts GROUP BY lang),
ch AS (SELECT lang, unnest(string_split(line || chr(10), '')) AS item FROM kept),
c AS (SELECT lang, count(DISTINCT item) AS n_chars FROM ch WHERE item <> '' GROUP BY lang)
SELECT lang, n_words, n_chars FROM w JOIN c USING (lang)""")
def type_counts(spark, sf_dir):
    words = vocab.word_counts(document_tokens(spark, sf_dir))
    return vocab.type_counts(words, vocab.char_counts(kept_lines(spark, sf_dir)))


# ---------------------------------------------------------------- E. lookups and joins

def word_vectors(spark, sf_dir) -> DataFrame:
    """(word, vector): corpus words, folded in the ways the fallback steps expect, on the given embeddings."""
    counts = vocab.word_counts(document_tokens(spark, sf_dir), 2)
    low = F.lower("word")
    form = (
        F.when(F.col("word").rlike(r"(?U)\d"),
               F.when(F.length("word") % 2 == 0, tx.mask_digits(low, "#")).otherwise(tx.mask_digits(low, "0")))
        .when(F.col("n") >= 100, F.col("word"))
        .otherwise(low)
    )
    words = counts.select(form.alias("word")).distinct()
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    slot = words.withColumn("vec_id", subword.bucket_of(F.col("word"), max(vectors.count(), 1)))
    return slot.join(vectors, "vec_id").select("word", "vector")


_FORMS = _COUNTS + f""",
forms AS (SELECT DISTINCT CASE WHEN regexp_matches(word, '\\p{{Nd}}') THEN
      CASE WHEN length(word) % 2 = 0 THEN regexp_replace(lower(word), '\\p{{Nd}}', '#', 'g')
      ELSE regexp_replace(lower(word), '\\p{{Nd}}', '0', 'g') END
    WHEN n >= 100 THEN word ELSE lower(word) END AS word FROM counts WHERE n >= 2),
vectors AS (SELECT word, embedding AS vector FROM forms
  JOIN embeddings ON vec_id = ('0x' || substr(md5(word), 1, 8))::bigint % (SELECT count(*) FROM embeddings)),
{_sql_lines('talk_lines', 'conversations', 'role', 'conv_id * 100000 + turn', 'text')},
talk AS (SELECT lang, file, seq, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS word FROM (
  SELECT *, list_filter(string_split({_sql_strip('line')}, ' '), lambda x: x <> '') AS t FROM talk_lines
  WHERE NOT regexp_matches(line, '{_BLANK}') AND NOT regexp_matches(line, '^{_CORRUPT}')))"""


def _sql_lookup(words: str, steps: int) -> str:
    forms = ["word", "lower(word)", r"regexp_replace(lower(word), '\p{Nd}', '#', 'g')",
             r"regexp_replace(lower(word), '\p{Nd}', '0', 'g')"][:steps]
    tries = " UNION ALL ".join(f"SELECT word, {k} AS step, {f} AS form FROM probes" for k, f in enumerate(forms))
    return f""",
probes AS (SELECT DISTINCT word FROM {words}),
hits AS (SELECT t.word, min(t.step) AS step, arg_min(v.word, t.step) AS matched, arg_min(v.vector, t.step) AS vector
  FROM ({tries}) t JOIN vectors v ON t.form = v.word GROUP BY t.word)"""


def _vector_sum(v: Column | str) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double"))


@query(f"""WITH {_FORMS}{_sql_lookup('talk', 4)}
SELECT p.word, h.matched, coalesce(h.step, -1)::bigint AS step, coalesce(len(h.vector), {DIM})::bigint AS dim,
  round(coalesce(list_sum(h.vector::double[]), 0.0), 4)::double AS total FROM probes p LEFT JOIN hits h ON p.word = h.word""")
def embed_lookup(spark, sf_dir):
    found = lookup.embed_words(conversation_tokens(spark, sf_dir), word_vectors(spark, sf_dir), DIM)
    return found.select("word", "matched", "step", F.size("vector").cast("bigint").alias("dim"),
                        F.round(_vector_sum("vector"), 4).alias("total"))


@query(f"""WITH {_FORMS}{_sql_lookup('talk', 2)}
SELECT p.word, h.matched, coalesce(h.step, -1)::bigint AS step, coalesce(len(h.vector), {DIM})::bigint AS dim,
  round(coalesce(list_sum(h.vector::double[]), {DIM}.0), 4)::double AS total
FROM probes p LEFT JOIN hits h ON p.word = h.word""")
def embed_lookup_short(spark, sf_dir):
    found = lookup.embed_words(conversation_tokens(spark, sf_dir), word_vectors(spark, sf_dir), DIM,
                               steps=2, default=1.0)
    return found.select("word", "matched", "step", F.size("vector").cast("bigint").alias("dim"),
                        F.round(_vector_sum("vector"), 4).alias("total"))


@query(f"""WITH {_FORMS}{_sql_lookup('talk', 4)}
SELECT t.lang, coalesce(h.step, -1)::bigint AS step, count(*) AS n FROM talk t LEFT JOIN hits h ON t.word = h.word GROUP BY ALL""")
def lookup_coverage(spark, sf_dir):
    return lookup.lookup_coverage(conversation_tokens(spark, sf_dir), word_vectors(spark, sf_dir))


@query(f"""WITH {_FORMS}, bare AS (SELECT lang, file, seq, pos, regexp_replace(word, '[.,]+$', '') AS word FROM talk)
{_sql_lookup('bare', 4)}
SELECT b.file, b.seq, b.pos, b.word AS bare, coalesce(h.step, -1)::bigint AS step,
  round(coalesce(list_sum(h.vector::double[]), 0.0), 4)::double AS total FROM bare b LEFT JOIN hits h ON b.word = h.word""")
def embed_lookup_field(spark, sf_dir):
    """Vectors per token, keyed by another field than its text (the word without closing punctuation)."""
    tokens = conversation_tokens(spark, sf_dir).withColumn("bare", F.regexp_replace("word", r"[.,]+\z", ""))
    found = lookup.embed_tokens(tokens, word_vectors(spark, sf_dir), DIM, key="bare")
    return found.select("file", "seq", "pos", "bare", "step", F.round(_vector_sum("vector"), 4).alias("total"))


@query(f"""WITH {_VOCAB} SELECT t.lang, t.file, t.seq, string_agg(coalesce(v.id + 1, 0)::varchar, ' ' ORDER BY t.pos) AS ids
FROM tokens t LEFT JOIN vocab v ON t.lang = v.lang AND t.word = v.word GROUP BY t.lang, t.file, t.seq""")
def encode_words(spark, sf_dir):
    found = lookup.encode_lines(kept_lines(spark, sf_dir), document_vocab(spark, sf_dir))
    return found.select("lang", "file", "seq", F.array_join("ids", " ").alias("ids"))


@query(f"""WITH {_KEPT}{_TRAIN}, heldout AS (SELECT * FROM splits WHERE split <> 'train'){_sql_chars('heldout')},
flow AS (SELECT lang, file, seq, generate_subscripts(t, 1) AS pos, unnest(t) AS item FROM (
  SELECT lang, file, seq, list_filter(string_split(line || chr(10), ''), lambda x: x <> '') AS t FROM kept))
SELECT f.lang, f.file, f.seq, string_agg(coalesce(d.idx, 0)::varchar, ' ' ORDER BY f.pos) AS ids
FROM flow f LEFT JOIN dict d ON f.lang = d.lang AND f.item = d.item GROUP BY f.lang, f.file, f.seq""")
def encode_chars(spark, sf_dir):
    """All lines by the dictionary of the held-out lines, so that some characters are unknown."""
    heldout = shape.with_split(ordered_lines(spark, sf_dir)).where(F.col("split") != "train")
    found = lookup.encode_chars(kept_lines(spark, sf_dir), vocab.char_dictionary(vocab.char_counts(heldout)))
    return found.select("lang", "file", "seq", F.array_join("ids", " ").alias("ids"))


_ALGORITHMS = ["w2v-s", "w2v-c", "glove", "fastText-S", "elmo", "lda"]


def languages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy(F.lower("lang").alias("lang")).agg(F.count("*").alias("n_files"))


@query(f"""WITH langs AS (SELECT lower(lang) AS lang, count(*) AS n_files FROM documents GROUP BY 1)
SELECT lang, algorithm, algorithm IN ({", ".join(repr(a) for a in tuning.ALGORITHMS)}) AS known, n_files
FROM langs, (SELECT unnest([{", ".join(repr(a.lower()) for a in _ALGORITHMS)}]) AS algorithm)""")
def run_matrix(spark, sf_dir):
    langs = languages(spark, sf_dir)
    return tuning.run_matrix(langs, _ALGORITHMS).join(langs, "lang")


@query(f"""WITH {_NOISE}, draws AS (SELECT lang, file, seq, pos, k, {_sql_u(SEED, 'file', 'seq', 'pos', 'k')} AS u
  FROM tokens, range(0, 2) r(k))
SELECT d.lang, d.file, d.seq, d.pos, d.k, n.id, n.word AS noise_word
FROM draws d ASOF JOIN noise n ON d.lang = n.lang AND d.u >= n.lo""")
def negative_samples(spark, sf_dir):
    """Two noise words for each token."""
    draws = (
        document_tokens(spark, sf_dir)
        .select("lang", "file", "seq", "pos", F.explode(F.sequence(F.lit(0), F.lit(1)).cast("array<bigint>")).alias("k"))
        .withColumn("u", hash_uniform(SEED, F.col("file"), F.col("seq"), F.col("pos"), F.col("k")))
    )
    noise = vocab.noise_distribution(document_vocab(spark, sf_dir))
    return pairs.draw_noise(draws, noise).drop("u")


# ---------------------------------------------------------------- F, G. ranks, order, batches

@query(f"WITH {_VOCAB} SELECT lang, word, n, id FROM vocab")
def vocab_ids(spark, sf_dir):
    return document_vocab(spark, sf_dir)


_FLOW = """,
flow AS (SELECT lang, i, generate_subscripts(t, 1) AS pos, unnest(t) AS a FROM (
  SELECT lang, i, list_filter(string_split(line || chr(10), ''), lambda x: x <> '') AS t FROM kept)),
nexts AS (SELECT lang, a, lead(a) OVER (PARTITION BY lang ORDER BY i, pos) AS b FROM flow)"""


@query(f"WITH {_KEPT}{_FLOW} SELECT lang, a AS item, b AS target, count(*) AS n FROM nexts WHERE b IS NOT NULL GROUP BY ALL")
def char_lm_pairs(spark, sf_dir):
    return lm.next_char_counts(ordered_lines(spark, sf_dir))


@query(f"WITH {_KEPT}{_FLOW} SELECT lang, b AS item, a AS target, count(*) AS n FROM nexts WHERE b IS NOT NULL GROUP BY ALL")
def char_lm_pairs_backward(spark, sf_dir):
    return lm.next_char_counts(ordered_lines(spark, sf_dir), forward=False)


@query(f"""WITH {_KEPT}, chars AS (SELECT unnest(string_split(line || chr(10), '')) AS item FROM kept),
n AS (SELECT item, count(*) AS n FROM chars WHERE item <> '' GROUP BY item)
SELECT item, n, row_number() OVER (ORDER BY n DESC, item) AS place FROM n""")
def char_freq_sorted(spark, sf_dir):
    """Characters of all languages by frequency; the window holds distinct code points only."""
    from pyspark.sql import Window
    counts = vocab.char_counts(kept_lines(spark, sf_dir)).groupBy("item").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.orderBy(F.desc("n"), "item")).cast("bigint")
    return counts.withColumn("place", place).orderBy("place")


@query(f"""WITH {_COUNTS}, ranked AS (SELECT *, count(*) OVER (PARTITION BY lang ORDER BY n DESC) AS upto FROM counts)
SELECT lang, word, n FROM ranked WHERE upto <= 1000""")
def vocab_capped(spark, sf_dir):
    return vocab.capped(vocab.word_counts(document_tokens(spark, sf_dir)), 1000)


@query(f"""WITH {_COOC} SELECT lang, w, c, row_number() OVER (PARTITION BY lang
ORDER BY md5(concat_ws('|', '{SEED}', w::varchar, c::varchar)), w, c) - 1 AS place FROM cooc""")
def cooc_shuffle(spark, sf_dir):
    found = glove_cooccurrence(spark, sf_dir).select("lang", "w", "c")
    return hash_rank(found, ["lang"], hash_hex(SEED, F.col("w"), F.col("c")), ["w", "c"], "place")


@query(f"""WITH {_KEPT}, h AS (SELECT lang, file, seq, i // 1000 + 1 AS shard,
  md5(concat_ws('|', '{SEED}', '0', file::varchar, seq::varchar)) AS h FROM kept),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, shard ORDER BY h, file, seq) - 1 AS r,
  count(*) OVER (PARTITION BY lang, shard) AS n FROM h)
SELECT lang, shard, file, seq, r // 32 AS batch FROM r WHERE r < 32 * (n // 32)""")
def mlm_batches(spark, sf_dir):
    lines = ordered_lines(spark, sf_dir).select(
        "lang", "file", "seq", shape.fixed_shard(F.col("ordinal"), 1000).alias("shard"))
    return lm.shuffled_batches(lines, 32, SEED, 0).select("lang", "shard", "file", "seq", "batch")


@query(f"""WITH {_KEPT}, s AS (SELECT lang, file, seq, i, i // 1000 + 1 AS shard, len({_WORDS}) AS n_tokens FROM kept)
SELECT lang, shard, file, seq, n_tokens::bigint AS n_tokens,
  (row_number() OVER (PARTITION BY lang, shard ORDER BY n_tokens, i) - 1) // 32 AS batch FROM s""")
def length_batches(spark, sf_dir):
    lines = ordered_lines(spark, sf_dir).withColumn("shard", shape.fixed_shard(F.col("ordinal"), 1000))
    found = lm.length_batches(lines, F.size(tx.split_whitespace(F.col("line"))))
    return found.select("lang", "shard", "file", "seq", "n_tokens", "batch")


# ---------------------------------------------------------------- I. scalars

@query("SELECT label, len(embedding)::bigint AS dim, count(*) AS n FROM embeddings GROUP BY ALL")
def vector_dims(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").groupBy("label", F.size("embedding").cast("bigint").alias("dim")).agg(
        F.count("*").alias("n"))


_CODES = ["g", "F", "ft", "BERT", "elmo", "W2V", "x"]


@query(f"""WITH c AS (SELECT lower(lang) AS lang, ([{", ".join(repr(c) for c in _CODES)}])[(doc_id % 7 + 1)::int] AS code FROM documents)
SELECT lang, code, CASE lower(code) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in tuning.EMBEDDING_KINDS.items())} END AS kind,
  count(*) AS n FROM c GROUP BY ALL""")
def embedding_kind(spark, sf_dir):
    codes = F.array(*[F.lit(c) for c in _CODES])
    docs = table(spark, sf_dir, "documents").select(
        F.lower("lang").alias("lang"), F.element_at(codes, (F.col("doc_id") % 7 + 1).cast("int")).alias("code"))
    return docs.groupBy("lang", "code").agg(F.count("*").alias("n")).select(
        "lang", "code", tuning.embedding_kind(F.col("code")).alias("kind"), "n")


# ---------------------------------------------------------------- J. training sets

@query(f"""WITH {_SENT}, wide AS (SELECT *, 1 + floor({_sql_u(SEED, 'file', 'seq', 'p')} * {WINDOW})::int AS b FROM sent)
SELECT a.lang, a.id AS w, c.id AS c, count(*) AS n FROM wide a JOIN sent c
ON a.lang = c.lang AND a.file = c.file AND a.seq = c.seq AND c.p <> a.p AND c.p BETWEEN a.p - a.b AND a.p + a.b GROUP BY ALL""")
def skipgram_pairs(spark, sf_dir):
    return pairs.skipgram_pairs(sentence_ids(spark, sf_dir), WINDOW, seed=SEED)


@query(f"""WITH {_SENT} SELECT a.lang, a.file, a.seq, a.p AS pos, a.id AS target, string_agg(c.id::varchar, ' ' ORDER BY c.p) AS bag
FROM sent a JOIN sent c ON a.lang = c.lang AND a.file = c.file AND a.seq = c.seq AND c.p <> a.p
  AND c.p BETWEEN a.p - {WINDOW} AND a.p + {WINDOW} GROUP BY a.lang, a.file, a.seq, a.p, a.id""")
def cbow_rows(spark, sf_dir):
    return pairs.cbow_rows(sentence_ids(spark, sf_dir), WINDOW).withColumn("bag", F.array_join("bag", " "))


_NGRAMS = _COUNTS + f""",
marked AS (SELECT lang, word, '<' || word || '>' AS m FROM counts WHERE n >= {MIN_COUNT}),
starts AS (SELECT lang, word, m, l, unnest(range(1, length(m) - l + 2)) AS start FROM marked, range(3, 7) x(l)),
grams AS (SELECT lang, word, start, l AS len, substr(m, start::bigint, l::bigint) AS ngram FROM starts)"""


@query(f"""WITH {_NGRAMS} SELECT lang, word, start, len, ngram,
('0x' || substr(md5(ngram), 1, 8))::bigint % 2000000 AS bucket FROM grams""")
def subword_ngrams(spark, sf_dir):
    words = vocab.word_counts(document_tokens(spark, sf_dir), MIN_COUNT)
    return subword.subword_ngrams(words, 3, 6, 2_000_000)


_DIMS = ", ".join(f"round(avg(v[{d}]), 5) AS v{d}" for d in range(1, DIM + 1))


@query(f"""WITH {_sql_lines('bl', 'benchmark', "'b'", 'item_id', 'text')},
bt AS (SELECT DISTINCT unnest(list_filter(string_split({_sql_strip('line')}, ' '), lambda x: x <> '')) AS word FROM bl),
grams AS (SELECT word, substr(m, start::bigint, l::bigint) AS g FROM (
  SELECT word, m, l, unnest(range(1, length(m) - l + 2)) AS start FROM (SELECT word, '<' || word || '>' AS m FROM bt), range(3, 7) x(l))),
hits AS (SELECT word, embedding::double[] AS v FROM grams
  JOIN embeddings ON vec_id = ('0x' || substr(md5(g), 1, 8))::bigint % (SELECT count(*) FROM embeddings))
SELECT word, {_DIMS} FROM hits GROUP BY word""")
def oov_vector(spark, sf_dir):
    """Vectors of the benchmark words from their n-grams alone, on the given embeddings as buckets."""
    items = table(spark, sf_dir, "benchmark").select(F.lit("b").alias("lang"), "item_id", "text")
    words = shape.tokens_of(corpus.lines_from_texts(items, file="item_id"))
    buckets = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("bucket"), F.col("embedding").alias("vector"))
    found = subword.oov_vectors(words, buckets, 3, 6, max(buckets.count(), 1), "float64")
    return found.select("word", *[F.round(F.col("vector")[d - 1], 5).alias(f"v{d}") for d in range(1, DIM + 1)])


_STREAMS, _LENGTH = 16, 250


@query(f"""WITH {_KEPT}, whole AS (SELECT lang, string_agg(line || chr(10), '' ORDER BY i) AS t FROM kept GROUP BY lang),
sized AS (SELECT lang, t, length(t) // {_STREAMS} AS len FROM whole),
streams AS (SELECT lang, stream, len, substr(t, stream * len + 1, len) AS t FROM sized, range(0, {_STREAMS}) s(stream)),
cut AS (SELECT lang, stream, w AS "window", substr(t, w * {_LENGTH} + 1, {_LENGTH} + 1) AS t
  FROM (SELECT *, unnest(range(0, (len + {_LENGTH} - 1) // {_LENGTH})) AS w FROM streams))
SELECT lang, stream, "window", substr(t, 1, length(t) - 1) AS input, substr(t, 2) AS target FROM cut WHERE length(t) > 1""")
def char_lm_sequences(spark, sf_dir):
    return lm.char_sequences(kept_lines(spark, sf_dir), _STREAMS, _LENGTH)


@query(f"""WITH {_TOKENS}, words AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM tokens),
sized AS (SELECT word, h, least(length(h) // 2, 48) AS n FROM words)
SELECT word, array_to_string(list_concat([259], list_transform(range(0, n), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::int + 1),
  [260], list_transform(range(0, 48 - n), lambda k: 261)), ' ') AS ids FROM sized""")
def elmo_char_ids(spark, sf_dir):
    return subword.char_word_ids(document_tokens(spark, sf_dir)).select("word", F.array_join("ids", " ").alias("ids"))


# DuckDB has no lookahead; documents hold single spaces only, where the two patterns agree.
_PRETOKENS = _KEPT + r""",
pre AS (SELECT unnest(regexp_extract_all(line,
  '''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\p{Z}\x{85}\x0b\p{L}\p{N}]+|[\s\p{Z}\x{85}\x0b]+')) AS pretoken FROM kept),
pre_counts AS (SELECT pretoken, count(*) AS n FROM pre GROUP BY ALL)"""


_BYTE_CODE = """code AS (SELECT byte, CASE WHEN byte BETWEEN 33 AND 126 OR byte BETWEEN 161 AND 172 OR byte BETWEEN 174 AND 255 THEN chr(byte::int)
  ELSE chr((255 + count(*) FILTER (WHERE NOT (byte BETWEEN 33 AND 126 OR byte BETWEEN 161 AND 172 OR byte BETWEEN 174 AND 255))
    OVER (ORDER BY byte))::int) END AS ch FROM range(0, 256) b(byte))"""


@query(f"WITH {_PRETOKENS} SELECT pretoken, n FROM pre_counts")
def bpe_pretokens(spark, sf_dir):
    return bpe.pretoken_counts(kept_lines(spark, sf_dir))


@query(f"""WITH {_PRETOKENS}, bytes AS (SELECT n, hex(encode(pretoken)) AS h FROM pre_counts),
p AS (SELECT n, substr(h, 2 * k + 1, 2) AS l, substr(h, 2 * k + 3, 2) AS r FROM (
  SELECT n, h, unnest(range(0, length(h) // 2 - 1)) AS k FROM bytes)),
{_BYTE_CODE}
SELECT a.ch AS "left", b.ch AS "right", sum(n)::bigint AS n FROM p JOIN code a ON ('0x' || l)::int = a.byte
JOIN code b ON ('0x' || r)::int = b.byte GROUP BY ALL""")
def bpe_pair_counts(spark, sf_dir):
    return bpe.pair_counts(bpe.symbol_table(bpe.pretoken_counts(kept_lines(spark, sf_dir))))


_BPE_VOCAB = MaskedLmSettings().vocab_size
# Pairs that a step of the SQL may merge at most; any number gives the same merges.
_SQL_STEP = 2000


def document_merges(spark, sf_dir) -> list[tuple[str, str]]:
    """All merges up to the published size of the vocabulary, or until no pair is frequent enough."""
    return bpe.train_bpe(bpe.pretoken_counts(kept_lines(spark, sf_dir)), _BPE_VOCAB)


def _sql_merges(words: str, most: int) -> str:
    """state(k, l, r): merge -k joins l and r. ``words`` is (k > 0, n, a), counted lists of symbols.

    A step counts the pairs and merges the best ones at once, as far down as one merge after another would take them in
    this order. It ends before a pair that overlaps a better one (``z``: the symbol behind the pair), that spells what a better one
    spells, or that a new pair of a better one may outrank; and behind a pair that spells a symbol that is there already.
    A new pair is at most as frequent as the three symbols it stems from; its left text is at least the lesser of the symbol
    before the pair (p) and that symbol with the one before it (pp), which may merge in the same step.
    """
    return f"""
state(k, n, a, l, r) USING KEY (k) AS (
  SELECT k, n, a, NULL::varchar, NULL::varchar FROM {words}
  UNION
  (WITH held AS (SELECT k, n, a FROM recurring.state WHERE k > 0 AND len(a) > 1),
  places AS (SELECT * FROM (SELECT k, n, unnest(range(1, len(a))) AS i, unnest(a[:-2]) AS l, unnest(a[2:]) AS r, unnest(a[3:]) AS z,
    unnest(list_concat([NULL], a[:-3])) AS p, unnest(list_concat([NULL, NULL], a[:-4])) AS pp FROM held) WHERE i IS NOT NULL),
  best AS MATERIALIZED (SELECT l, r, sum(n) AS c, row_number() OVER (ORDER BY sum(n) DESC, l, r) AS j FROM places
    GROUP BY l, r HAVING sum(n) >= {bpe.MIN_FREQUENCY} ORDER BY j LIMIT {_SQL_STEP}),
  near AS MATERIALIZED (SELECT places.*, best.j FROM places JOIN best USING (l, r)),
  born AS (SELECT j, min(row(-c, nl, nr)) AS first FROM (
    SELECT j, sum(n) AS c, l || r AS nl, z AS nr FROM near WHERE z IS NOT NULL GROUP BY j, l, r, z
    UNION ALL SELECT j, sum(n), min(least(p, coalesce(pp, '') || p)), l || r FROM near WHERE p IS NOT NULL GROUP BY j, l, r, p) GROUP BY j),
  stops AS (
    SELECT min(greatest(near.j, best.j)) AS j FROM near JOIN best ON near.r = best.l AND near.z = best.r WHERE near.j <> best.j
    UNION ALL SELECT min(j) FROM (SELECT j, row_number() OVER (PARTITION BY l || r ORDER BY j) AS again FROM best) WHERE again > 1
    UNION ALL SELECT min(j) + 1 FROM best WHERE l || r IN (SELECT l FROM places UNION SELECT r FROM places)
    UNION ALL SELECT min(j) FROM (SELECT j, row(-c, l, r) AS own,
      min(first) OVER (ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bound FROM best LEFT JOIN born USING (j)) WHERE own >= bound),
  done AS (SELECT count(*) AS m FROM recurring.state WHERE k < 0),
  now AS MATERIALIZED (SELECT l, r, j, m FROM best, done WHERE j < coalesce((SELECT min(j) FROM stops), {_SQL_STEP} + 1) AND m + j <= {most}),
  hits AS (SELECT k, i, l || r AS made FROM (SELECT k, i, l, r, i - min(i) OVER (PARTITION BY k, run) AS place FROM (
    SELECT k, i, l, r, i - row_number() OVER (PARTITION BY k ORDER BY i) AS run FROM near JOIN now USING (l, r, j))) WHERE place % 2 = 0),
  changed AS (SELECT held.k, any_value(n) AS n, any_value(a) AS a, map_from_entries(list((i, made))) AS made FROM held JOIN hits USING (k) GROUP BY held.k)
  SELECT k, n, list_filter(list_transform(a, lambda x, i: CASE WHEN map_contains(made, i) THEN made[i] WHEN map_contains(made, i - 1) THEN NULL ELSE x END),
    lambda x: x IS NOT NULL) AS a, NULL AS l, NULL AS r FROM changed
  UNION ALL SELECT -(m + j), NULL, NULL, l, r FROM now))"""


@query(f"""WITH RECURSIVE {_PRETOKENS}, {_BYTE_CODE},
words AS (SELECT row_number() OVER () AS k, n, list_transform(range(0, length(h) // 2), lambda i: chars[('0x' || substr(h, 2 * i + 1, 2))::int + 1]) AS a
  FROM (SELECT n, hex(encode(pretoken)) AS h FROM pre_counts), (SELECT list(ch ORDER BY byte) AS chars FROM code)),{_sql_merges('words', _BPE_VOCAB - 261)}
SELECT -k - 1 AS rank, l AS "left", r AS "right" FROM state WHERE k < 0""")
def bpe_merges(spark, sf_dir):
    return bpe.bpe_tables(spark, document_merges(spark, sf_dir))[1]


@query(f"WITH {_KEPT} SELECT lang, file, seq, line AS decoded, true AS is_padded FROM kept")
def mlm_encode(spark, sf_dir):
    """Byte-pair ids of each whole line, padded and masked, then decoded to text again."""
    merges = document_merges(spark, sf_dir)
    encoded = bpe.encode_text(kept_lines(spark, sf_dir), merges)
    ids = lm.padded(F.col("ids"), _POSITIONS)
    held = F.aggregate(lm.attention(ids), F.lit(0), lambda a, x: a + x.cast("int"))
    fits = (F.size(ids) == _POSITIONS) & (held == F.least(F.size("ids") + 2, F.lit(_POSITIONS)))
    return encoded.select("lang", "file", "seq", bpe.decoder(merges)("ids").alias("decoded"), fits.alias("is_padded"))


_MASK, _POSITIONS = 0.15, 512


def _joined(*columns: str) -> list[Column]:
    return [F.array_join(c, " ").alias(c) for c in columns]


@query(f"""WITH {_VOCAB}, enc AS (SELECT t.lang, t.file, t.seq, list(coalesce(v.id + 5, 3) ORDER BY t.pos) AS a
  FROM tokens t LEFT JOIN vocab v ON t.lang = v.lang AND t.word = v.word GROUP BY ALL),
body AS (SELECT lang, file, seq, list_concat([0], a[1:{_POSITIONS - 2}], [2]) AS s FROM enc),
full_rows AS (SELECT lang, file, seq, list_concat(s, list_transform(range(0, {_POSITIONS} - len(s)), lambda x: 1)) AS s FROM body)
SELECT lang, file, seq, array_to_string(s, ' ') AS labels,
  array_to_string(list_transform(s, lambda x: CASE WHEN x = 1 THEN 0 ELSE 1 END), ' ') AS attention_mask,
  array_to_string(list_transform(s, lambda x, p: CASE WHEN x NOT IN (0, 1, 2) AND
    {_sql_u(SEED, "'0'", 'file', 'seq', '(p - 1)')} < {_MASK} THEN 4 ELSE x END), ' ') AS input_ids
FROM full_rows""")
def mlm_mask(spark, sf_dir):
    """Masked sequences over word ids (shifted past the specials)."""
    encoded = lookup.encode_lines(kept_lines(spark, sf_dir), document_vocab(spark, sf_dir),
                                  unknown=lm.UNKNOWN, shift=len(bpe.SPECIALS))
    rows = lm.mlm_rows(encoded, _POSITIONS, _MASK, SEED, 0)
    return rows.select("lang", "file", "seq", *_joined("labels", "attention_mask", "input_ids"))


# ---------------------------------------------------------------- K. training
# Vector values are not SQL; the SQL checks that every vocabulary word got one finite vector.

_TRAIN_DIM = 32


def _vectors(model: trainers.Model) -> DataFrame:
    """Vector rows, and whether the loss fell: an untrained table would not pass."""
    fell = len(model.losses) > 1 and model.losses[-1] < model.losses[0]
    return _vector_rows(model.vectors).withColumn("loss_fell", F.lit(fell))


def _vector_rows(vectors: DataFrame) -> DataFrame:
    finite = F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6))
    return vectors.select("lang", "algorithm", "size", "word", F.size("vector").cast("bigint").alias("dim"),
                          finite.alias("is_finite"))


# Word vectors of the word2vec family drop blank lines only.
_ANY_LEAD = f" AND NOT regexp_matches(line, '^{_CORRUPT}')"
_VOCAB_ANY = _VOCAB.replace(_ANY_LEAD, "")


def any_lead_lines(spark, sf_dir) -> DataFrame:
    return corpus.kept_lines_from_texts(documents(spark, sf_dir), corrupt_scope=None)


def _sql_vectors(algorithm: str, vocabulary: str = _VOCAB) -> str:
    return f"""WITH {vocabulary} SELECT lang, '{algorithm}' AS algorithm, -1::bigint AS size, word,
  {_TRAIN_DIM}::bigint AS dim, true AS is_finite, true AS loss_fell FROM vocab"""


def _w2v(**changes) -> Word2VecSettings:
    base = dict(vector_size=_TRAIN_DIM, window=5, min_count=MIN_COUNT, epochs=2, seed=SEED)
    return Word2VecSettings.of(base | changes)


@query(_sql_vectors("w2v-skipgram", _VOCAB_ANY))
def w2v_skipgram(spark, sf_dir):
    return _vectors(trainers.train_word2vec(any_lead_lines(spark, sf_dir), _w2v()))


@query(_sql_vectors("w2v-skipgram", _VOCAB_ANY))
def w2v_skipgram_tree(spark, sf_dir):
    """A narrower window, so that fewer contexts share the decisions of a node."""
    return _vectors(trainers.train_word2vec(any_lead_lines(spark, sf_dir), _w2v(window=3)))


@query(_sql_vectors("w2v-skipgram", _VOCAB_ANY))
def w2v_skipgram_noise(spark, sf_dir):
    return _vectors(trainers.train_word2vec(any_lead_lines(spark, sf_dir), _w2v(hs=0, negative=2)))


@query(_sql_vectors("w2v-cbow", _VOCAB_ANY))
def w2v_cbow(spark, sf_dir):
    return _vectors(trainers.train_word2vec(any_lead_lines(spark, sf_dir), _w2v(sg=0), chunk_tokens=60_000))


@query(_sql_vectors("GloVe"))
def glove_train(spark, sf_dir):
    settings = GloveSettings(vocab_min_count=MIN_COUNT, vector_size=_TRAIN_DIM, max_iter=3, window_size=WINDOW, seed=SEED)
    return _vectors(trainers.train_glove(kept_lines(spark, sf_dir), settings))


def _fasttext(model: str, loss: str = "ns") -> FastTextSettings:
    return FastTextSettings(model=model, dim=_TRAIN_DIM, epoch=2, minCount=MIN_COUNT, minn=3, maxn=5, bucket=_BUCKETS,
                            neg=3, t=0.001, seed=SEED, loss=loss)


@query(_sql_vectors("fastText-skipgram"))
def fasttext_skipgram(spark, sf_dir):
    return _vectors(trainers.train_fasttext(kept_lines(spark, sf_dir), _fasttext("skipgram"), chunk_tokens=60_000))


@query(_sql_vectors("fastText-cbow"))
def fasttext_cbow(spark, sf_dir):
    return _vectors(trainers.train_fasttext(kept_lines(spark, sf_dir), _fasttext("cbow"), chunk_tokens=60_000))


@query(_sql_vectors("fastText-skipgram"))
def fasttext_softmax(spark, sf_dir):
    """Skip-gram with the softmax over all words."""
    return _vectors(trainers.train_fasttext(kept_lines(spark, sf_dir), _fasttext("skipgram", "softmax")))


_BUCKETS = 50_000


@query(f"""WITH {_COUNTS},
marked AS (SELECT lang, word, n, '<' || word || '>' AS m FROM counts),
starts AS (SELECT lang, word, n, m, l, unnest(range(1, length(m) - l + 2)) AS start FROM marked, range(3, 6) x(l)),
grams AS (SELECT DISTINCT lang, word, n, ('0x' || substr(md5(substr(m, start::bigint, l::bigint)), 1, 8))::bigint % {_BUCKETS} AS bucket FROM starts),
trained AS (SELECT DISTINCT lang, bucket FROM grams WHERE n >= {MIN_COUNT})
SELECT DISTINCT g.lang, g.word, {_TRAIN_DIM}::bigint AS dim, true AS is_finite
FROM grams g JOIN trained t ON g.lang = t.lang AND g.bucket = t.bucket WHERE g.n < {MIN_COUNT}""")
def oov_trained(spark, sf_dir):
    """Vectors of the words below the minimum count, from n-gram rows that training has moved."""
    settings = _fasttext("skipgram")
    model = trainers.train_fasttext(kept_lines(spark, sf_dir), settings, chunk_tokens=60_000)
    rare = vocab.word_counts(document_tokens(spark, sf_dir)).where(F.col("n") < MIN_COUNT)
    found = trainers.unseen_vectors(model, rare, settings)
    return found.select("lang", "word", F.size("vector").cast("bigint").alias("dim"),
                        F.forall("vector", lambda x: ~F.isnan(x) & (F.abs(x) < 1e6)).alias("is_finite"))


_CURVE_INIT = 400


@query(f"""WITH {_TOKENS.replace(_ANY_LEAD, "")}{_CURVE.replace("100 *", f"{_CURVE_INIT} *")}
SELECT r.lang, 'w2v-skipgram' AS algorithm, r.size, t.word, {_TRAIN_DIM}::bigint AS dim, true AS is_finite
FROM runs r JOIN tokens t ON r.lang = t.lang AND t.i < r.size GROUP BY r.lang, r.size, t.word HAVING count(*) >= {MIN_COUNT}""")
def curve_w2v(spark, sf_dir):
    """One model per size of the learning curve."""
    lines = with_ordinal(any_lead_lines(spark, sf_dir))
    found = trainers.train_curve(lines, _CURVE_INIT, lambda part: trainers.train_word2vec(part, _w2v(epochs=1)))
    return _vector_rows(found)


# ---------------------------------------------------------------- L. runs and trials


@query(f"""WITH {_TOKENS}, placed AS (SELECT lang AS tag, {_sql_u(SEED, 'file', 'seq')} < 0.1 AS dev FROM tokens)
SELECT count(*) FILTER (NOT dev) AS n_train, count(*) FILTER (dev) AS n_test, true AS is_accurate FROM placed""")
def downstream_score(spark, sf_dir):
    """Tag each token with its language from the given vectors; a hash tenth of the sentences is the test.

    A line is of one language, so neighbours tell more than the token's own (hashed) vector: 0.85 at sf0.01.
    """
    lines = kept_lines(spark, sf_dir)
    tokens = shape.tokens_of(lines)
    dev = hash_uniform(SEED, F.col("file"), F.col("seq")) < 0.1
    tagged = tokens.select(F.when(dev, "test").otherwise("train").alias("split"), "file", F.col("seq").alias("sent_id"),
                           "pos", F.col("word").alias("token"), F.col("lang").alias("tag"))
    found = scoring.downstream_score(tagged, word_vectors(spark, sf_dir), DIM, max_iter=14)
    return found.select("n_train", "n_test", (F.col("accuracy") > 0.75).alias("is_accurate"))


SPACE = {
    "size": {"choice": [100, 200, 300]},
    "alpha": {"uniform": [0.01, 0.1]},
    "sample": {"loguniform": [0.00001, 0.01]},
    "ns_exponent": {"quniform": [0.2, 1.0, 0.05]},
    "rate": {"qloguniform": [0.002, 0.3, 0.0005]},
    "shift": {"randn": [4, 1.5]},
    "shift_q": {"qrandn": [4, 1.5, 0.25]},
    "min_count": {"randint": [2, 30]},
    "epochs": {"qrandint": [5, 50, 5]},
    "window": {"lograndint": [2, 30]},
    "batch": {"qlograndint": [8, 128, 8]},
}
KNOWN_RUNS = ["w2v-s", "glove", "fasttext-s"]
TRIALS = 10


def runs(spark, sf_dir) -> DataFrame:
    return tuning.run_matrix(languages(spark, sf_dir), KNOWN_RUNS).where("known")


_RUNS = f"""langs AS (SELECT DISTINCT lower(lang) AS lang FROM documents),
runs AS (SELECT lang, algorithm FROM langs, (SELECT unnest([{", ".join(map(repr, KNOWN_RUNS))}]) AS algorithm)),
trials AS (SELECT lang, algorithm, k AS trial_number FROM runs, range(0, {TRIALS}) r(k))"""


def _sql_draw(name: str, kind: str, args: list) -> str:
    key = f"md5(concat_ws('|', '{SEED}', '{name}', lang, algorithm, trial_number::varchar))"
    u = f"(('0x' || substr({key}, 1, 8))::bigint::double / 4294967296.0::double)"
    v = f"(('0x' || substr({key}, 9, 8))::bigint::double / 4294967296.0::double)"
    if kind == "choice":
        return f"([{', '.join(repr(str(a)) for a in args)}])[(floor({u} * {len(args)}) + 1)::int]"
    a, b = (f"{float(x)!r}::double" for x in args[:2])
    q = f"{float(args[2])!r}::double" if len(args) > 2 else ""
    log = f"exp(ln({a}) + {u} * (ln({b}) - ln({a})))"
    value = {
        "uniform": f"{a} + {u} * ({b} - {a})", "quniform": f"{a} + {u} * ({b} - {a})",
        "loguniform": log, "qloguniform": log,
        "randn": f"{a} + {b} * sqrt(-2.0::double * ln(1.0::double - {u})) * cos(6.283185307179586::double * {v})",
        "randint": f"floor({a} + {u} * ({b} - {a}))",
        "qrandint": f"floor({a} + {u} * ({b} - {a} + 1))",
        "lograndint": f"floor({log})", "qlograndint": f"floor({log})",
    }["randn" if kind == "qrandn" else kind]
    if q:
        value = f"round_even(({value}) / {q}, 0) * {q}"
        if kind in ("qrandint", "qlograndint"):
            value = f"least({value}, {b})"
    return f"round({value}, 6)"


_DRAWS = ", ".join(f"{_sql_draw(k, *next(iter(e.items())))} AS {k}" for k, e in SPACE.items())


def trials(spark, sf_dir) -> DataFrame:
    return tuning.sample_trials(runs(spark, sf_dir), SPACE, TRIALS, SEED)


@query(f"WITH {_RUNS} SELECT lang, algorithm, trial_number, {_DRAWS} FROM trials")
def sample_trials(spark, sf_dir):
    drawn = trials(spark, sf_dir)
    return drawn.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in drawn.dtypes])


@query(f"""WITH {_RUNS} SELECT lang, algorithm, p.param, p.kind, p.value FROM runs, (VALUES
{", ".join(f"('{k}', '{next(iter(e))}', '{next(iter(e.values()))[0]}')" for k, e in SPACE.items())}) p(param, kind, value)""")
def default_params(spark, sf_dir):
    return tuning.default_params(tuning.space_table(runs(spark, sf_dir), SPACE))


@query(f"""WITH {_RUNS} SELECT lang, algorithm, a AS size, b AS alpha FROM runs,
(SELECT unnest([100, 200, 300])::int AS a), (SELECT unnest([0.01::double, 0.05::double]) AS b)""")
def grid_trials(spark, sf_dir):
    return tuning.grid_trials(runs(spark, sf_dir), {"size": [100, 200, 300], "alpha": [0.01, 0.05]})


_TOP_COUNT = 30


def trial_scores(spark, sf_dir) -> DataFrame:
    """Trials with a score from the data: held-out tokens covered by the vocabulary at the drawn min_count.

    Covered tokens are summed per word count first (at most 30 counts matter), never per trial and word.
    """
    lines = shape.with_split(ordered_lines(spark, sf_dir))
    train = vocab.word_counts(shape.tokens_of(lines.where(F.col("split") == "train")))
    heldout = vocab.word_counts(shape.tokens_of(lines.where(F.col("split") != "train"))).withColumnRenamed("n", "h")
    by_count = (
        heldout.join(train, ["lang", "word"], "left")
        .groupBy("lang", F.least(F.coalesce("n", F.lit(0)), F.lit(_TOP_COUNT)).alias("n")).agg(F.sum("h").alias("h"))
        .groupBy("lang").agg(F.collect_list(F.struct("n", "h")).alias("hist"), F.sum("h").alias("total"))
    )
    covered = F.aggregate("hist", F.lit(0).cast("bigint"), lambda s, e: s + F.when(
        e["n"] >= F.col("min_count"), e["h"]).otherwise(0))
    return trials(spark, sf_dir).join(by_count, "lang").withColumn(
        "accuracy", F.round(covered / F.col("total"), 6)).drop("hist", "total")


_SCORES = _TOKENS + f""",
word_split AS (SELECT lang, word, count(*) FILTER (WHERE i % 101 < 99) AS n, count(*) FILTER (WHERE i % 101 >= 99) AS h
  FROM tokens GROUP BY ALL),
{_RUNS}, drawn AS (SELECT lang, algorithm, trial_number, {_DRAWS} FROM trials),
totals AS (SELECT lang, sum(h) AS total FROM word_split GROUP BY lang),
scores AS (SELECT d.lang, d.algorithm, d.trial_number, d.min_count, d.window, round(sum(w.h)::double / any_value(t.total)::double, 6) AS accuracy
  FROM drawn d JOIN word_split w ON d.lang = w.lang AND least(w.n, {_TOP_COUNT}) >= d.min_count JOIN totals t ON d.lang = t.lang GROUP BY ALL)"""


@query(f'WITH {_SCORES} SELECT lang, algorithm, trial_number, min_count, "window", accuracy FROM scores')
def trial_results(spark, sf_dir):
    return trial_scores(spark, sf_dir).select("lang", "algorithm", "trial_number", "min_count", "window", "accuracy")


@query(f"""WITH {_SCORES}, r AS (SELECT *, row_number() OVER (PARTITION BY lang, algorithm ORDER BY accuracy DESC, trial_number) AS r FROM scores)
SELECT lang, algorithm, trial_number, accuracy, min_count, "window" FROM r WHERE r = 1""")
def best_trial(spark, sf_dir):
    return tuning.best_trial(trial_scores(spark, sf_dir), ["min_count", "window"])


@query(f"""WITH {_SCORES} SELECT t.lang, t.algorithm, t.trial_number,
  CASE WHEN s.min_count <= 15 THEN s.accuracy ELSE -1.0::double END AS accuracy FROM trials t JOIN scores s USING (lang, algorithm, trial_number)""")
def score_or_sentinel(spark, sf_dir):
    """Models of rare words only (min_count over 15) count as missing."""
    scored = trial_scores(spark, sf_dir).where(F.col("min_count") <= 15).select(
        "lang", "algorithm", "trial_number", "accuracy")
    return tuning.score_or_sentinel(
        trials(spark, sf_dir).select("lang", "algorithm", "trial_number"), scored)


@query(f"WITH {_KEPT} SELECT lang, file, seq, {_sql_u(SEED, 'file', 'seq')} < 0.1 AS is_dev FROM kept")
def dev_holdout(spark, sf_dir):
    return tuning.dev_holdout(kept_lines(spark, sf_dir), 0.1, SEED, F.col("file"), F.col("seq")).select(
        "lang", "file", "seq", "is_dev")
