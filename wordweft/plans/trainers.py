"""Static word vectors: corpus lines in, (lang, algorithm, size, word, vector) out."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_uniform
from ..operators import lookup, pairs, shape, subword, vocab
from ..sources.session import cut, stored
from .cells import fit_pairs, noise_pairs
from .config import FastTextSettings, GloveSettings, Word2VecSettings
from .sentences import Objective, fit_sentences
from .softmax import fit_softmax
from .tree import fit_tree

# Feature ids of n-gram buckets start here, behind all word ids.
BUCKET_BASE = 1 << 40
# Sizes of a learning curve that train at a time.
SIZES_AT_ONCE = 4


@dataclass
class Model:
    """Vectors and the loss per epoch; ``params`` and ``words`` stay for sub-word lookups."""

    vectors: DataFrame
    losses: list[float]
    params: DataFrame | None = None


@dataclass(frozen=True)
class Part:
    """Lines of a learning-curve size, cut into words, with the counts of their words (lang, word, n)."""

    lines: DataFrame
    counts: DataFrame


def _parts(kept: DataFrame | Part) -> tuple[DataFrame, DataFrame | None]:
    return (kept.lines, kept.counts) if isinstance(kept, Part) else (kept, None)


def _prepared(kept: DataFrame, min_count: int, limit: int | None, sample: float | None, seed: int,
              keep_empty: bool = False, carry: tuple[str, ...] = (), counts: DataFrame | None = None):
    """(vocabulary with ids, sentences of ids) after the count, cap and sampling filters."""
    if counts is None:
        words = vocab.word_counts(shape.tokens_of(kept, keep_empty), min_count)
    else:
        words = counts.where((F.col("n") >= min_count) & (F.lit(keep_empty) | (F.col("word") != "")))
    if limit:
        words = vocab.capped(words, limit)
    words = vocab.with_ids(words)
    if sample:
        kept = _sampled(kept, words, sample, seed, keep_empty)
    return cut(words), stored(lookup.encode_lines(kept, words, None, 0, keep_empty, carry=carry))


def _sampled(kept: DataFrame, words: DataFrame, sample: float, seed: int, keep_empty: bool) -> DataFrame:
    """Lines without the occurrences that subsampling drops; an occurrence is drawn by its place.

    Only words above the sampling share can lose any; they are joined like other hot words, unbounded.
    """
    totals = words.groupBy("lang").agg(F.sum("n").alias("_total"))
    odds = vocab.keep_probability(F.col("n"), F.col("_total"), sample)
    frequent = words.join(totals, "lang").select("lang", "word", odds.alias("_q"), "n").where(F.col("_q") < 1.0)
    drawn = hash_uniform(seed, F.col("file"), F.col("seq"), F.col("pos"))
    rest = lookup.lookup_join(
        shape.tokens_of(kept, keep_empty), frequent, "n", "left"
    ).where(F.col("_q").isNull() | (drawn < F.col("_q")))
    return rest.groupBy("lang", "file", "slab", "seq").agg(
        F.array_sort(F.collect_list(F.struct("pos", "word")))["word"].alias("words"))


def _nothing(kept: DataFrame) -> Model:
    """The model of a corpus without any word left: a vectors table without rows."""
    return Model(kept.sparkSession.createDataFrame(
        [], "lang string, algorithm string, size bigint, word string, vector array<float>"), [])


def _named(found: DataFrame, words: DataFrame, algorithm: str) -> DataFrame:
    return found.join(words.select("lang", "id", "word"), ["lang", "id"]).select(
        "lang", F.lit(algorithm).alias("algorithm"), F.lit(-1).cast("bigint").alias("size"), "word", "vector")


def _inputs(params: DataFrame) -> DataFrame:
    return params.where(F.col("side") == 0).select("lang", "id", F.col("vec").alias("vector"))


def train_glove(kept: DataFrame | Part, settings: GloveSettings) -> Model:
    """Kept lines -> vectors W + C of the merged rows' co-occurrences."""
    seed = settings.seed or 1
    kept, counts = _parts(kept)
    words, sentences = _prepared(shape.merged_rows(kept), settings.vocab_min_count, None, None, seed, carry=("doc_ord",), counts=counts)
    if words.isEmpty():
        return _nothing(kept)
    counted = pairs.cooccurrence(pairs.position_chunks(sentences, settings.window_size), settings.window_size, packed=True)
    params, losses = fit_pairs(
        counted.withColumnRenamed("x", "a"), words,
        settings.vector_size, settings.max_iter, settings.rate, settings.rate, "glove", seed, settings.x_max,
        passes=settings.local_passes)
    body = F.slice("vec", 1, settings.vector_size)
    w = params.where(F.col("side") == 0).select("lang", "id", body.alias("_w"))
    c = params.where(F.col("side") == 1).select("lang", "id", body.alias("_c"))
    both = w.join(c, ["lang", "id"]).select(
        "lang", "id", F.zip_with("_w", "_c", lambda x, y: x + y).cast("array<float>").alias("vector"))
    return Model(_named(both, words, "GloVe"), losses, params)


def train_word2vec(kept: DataFrame | Part, settings: Word2VecSettings, chunk_tokens: int = 1_000_000) -> Model:
    """Skip-gram (counted pairs, factored) or bag of words (sentence chunks), over a code tree or noise words."""
    seed = settings.seed or 1
    kept, counts = _parts(kept)
    words, sentences = _prepared(kept, settings.min_count, settings.max_final_vocab, settings.sample, seed, True, counts=counts)
    if words.isEmpty():
        return _nothing(kept)
    name = "w2v-skipgram" if settings.sg else "w2v-cbow"
    negative = 0 if settings.hs else settings.negative
    shares = vocab.noise_distribution(words, settings.ns_exponent)
    tree = vocab.noise_distribution(words, 1.0)
    if not settings.sg:
        units = words.select("lang", "id", F.array("id").alias("ids"))
        objective = Objective(True, settings.window, negative, bool(settings.cbow_mean), True)
        params, losses = fit_sentences(sentences, units, shares, tree, objective, settings.vector_size, settings.epochs,
                                       settings.alpha, settings.min_alpha, seed, chunk_tokens)
        return Model(_named(_inputs(params), words, name), losses, params)
    counts = pairs.skipgram_pairs(sentences, settings.window, seed=seed, packed=not negative)
    if negative:
        params, losses = fit_pairs(noise_pairs(counts, shares, negative, seed), words, settings.vector_size, settings.epochs, settings.alpha,
                                   settings.min_alpha, "logistic", seed, passes=settings.local_passes)
    else:
        params, losses = fit_tree(counts, words, tree, settings.vector_size, settings.epochs, settings.alpha, settings.min_alpha, seed,
                                  passes=settings.local_passes)
    return Model(_named(_inputs(params), words, name), losses, params)


def word_units(words: DataFrame, settings: FastTextSettings) -> DataFrame:
    """(lang, id, ids): each word's own row and the rows of its hashed n-grams."""
    grams = subword.ngrams_of(F.col("word"), settings.minn, settings.maxn)
    rows = F.transform(grams, lambda g: F.lit(BUCKET_BASE) + subword.bucket_of(g["ngram"], settings.bucket))
    return words.select("lang", "id", F.concat(F.array("id"), rows).alias("ids"))


def _predictions(sentences: DataFrame, words: DataFrame, settings: FastTextSettings, seed: int) -> tuple[DataFrame, DataFrame]:
    """(lang, pred, ids) and (lang, pred, target, n): a centre word with its counted contexts, or a bag with its word."""
    if settings.model == "skipgram":
        counts = pairs.skipgram_pairs(sentences, settings.ws, seed=seed)
        return words.select("lang", F.col("id").alias("pred"), F.array("id").alias("ids")), counts.select(
            "lang", F.col("w").alias("pred"), F.col("c").alias("target"), "n")
    rows = cut(pairs.cbow_rows(sentences, settings.ws, True, seed).withColumn("pred", F.monotonically_increasing_id()))
    return rows.select("lang", "pred", F.col("bag").alias("ids")), rows.select("lang", "pred", "target", F.lit(1).cast("bigint").alias("n"))


def train_fasttext(kept: DataFrame | Part, settings: FastTextSettings, chunk_tokens: int = 1_000_000) -> Model:
    seed = settings.seed or 1
    kept, counts = _parts(kept)
    words, sentences = _prepared(kept, settings.minCount, None, settings.t, seed, counts=counts)
    if words.isEmpty():
        return _nothing(kept)
    units = word_units(words, settings) if settings.maxn else words.select("lang", "id", F.array("id").alias("ids"))
    if settings.loss == "softmax":
        params, losses = fit_softmax(*_predictions(sentences, words, settings, seed), units, settings.dim, settings.epoch, settings.lr, 0.0, seed)
    else:
        objective = Objective(settings.model == "cbow", settings.ws, settings.neg if settings.loss == "ns" else 0, True, False)
        params, losses = fit_sentences(
            sentences, units, vocab.noise_distribution(words, 0.5), vocab.noise_distribution(words, 1.0), objective,
            settings.dim, settings.epoch, settings.lr, 0.0, seed, chunk_tokens)
    links = units.select("lang", F.col("id").alias("key"), F.explode("ids").alias("id"))
    means = subword.blocked_means(links, _inputs(params))
    return Model(_named(means.withColumnRenamed("key", "id"), words, f"fastText-{settings.model}"), losses, params)


def unseen_vectors(model: Model, words: DataFrame, settings: FastTextSettings) -> DataFrame:
    """(lang, word, vector) for any words, from the n-gram rows that training has touched."""
    buckets = model.params.where((F.col("side") == 0) & (F.col("id") >= BUCKET_BASE)).select(
        "lang", (F.col("id") - BUCKET_BASE).alias("id"), F.col("vec").alias("vector"))
    grams = subword.subword_ngrams(words.select("lang", "word").distinct(), settings.minn, settings.maxn, settings.bucket)
    return subword.blocked_means(grams.select("lang", F.col("word").alias("key"), F.col("bucket").alias("id")), buckets).withColumnRenamed("key", "word")


def train_curve(lines: DataFrame, init: int, train) -> DataFrame:
    """Train on growing prefixes (``lines`` with ``ordinal``); returns all vectors with their ``size``.

    A language takes part in a run until one run has read all of it. Lines are cut into words once. Words are counted
    once per ring, the lines that a run reads and the one before did not; the counts of a size add up its rings. Pairs
    do not add up so: a word that enters the vocabulary with a later size moves its neighbours apart in all earlier lines.
    Some sizes train at a time, the largest first: most steps of a small size have fewer tasks than there are cores.
    """
    lines = cut(shape.with_words(lines))
    totals = lines.groupBy("lang").agg(F.count("*").alias("n_lines"))
    sizes = cut(shape.curve_sizes(totals, init))
    last = sizes.agg(F.max("run")).first()[0]
    if last is None:
        return _nothing(lines).vectors
    ring = shape.curve_step(F.col("ordinal"), init).alias("ring")
    rings = cut(lines.select("lang", ring, F.explode("words").alias("word")).groupBy("lang", "ring", "word").agg(F.count("*").alias("n")))

    def vectors(run: int) -> DataFrame:
        size = init * 2 ** run
        langs = F.broadcast(sizes.where(F.col("run") == run).select("lang"))
        counts = rings.where(F.col("ring") <= run).join(langs, "lang", "left_semi").groupBy("lang", "word").agg(F.sum("n").alias("n"))
        part = shape.prefix(lines, size).join(langs, "lang", "left_semi")
        return train(Part(part, counts)).vectors.withColumn("size", F.lit(size).cast("bigint"))

    with ThreadPoolExecutor(SIZES_AT_ONCE) as pool:
        found = list(pool.map(vectors, range(int(last), -1, -1)))
    return reduce(DataFrame.unionByName, reversed(found))
