"""Runs: each requested algorithm on each language, and random search over its settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import bpe, lm, scoring, shape, subword, tuning, vocab
from ..operators.ordinal import with_ordinal
from ..sources import corpus, sinks
from ..sources.session import cut
from . import trainers
from .config import (CharLmSettings, ElmoSettings, FastTextSettings, GloveSettings, MaskedLmSettings, NothingToLearn,
                     RunSettings, TuningSettings, Word2VecSettings)

# File patterns and line filters of each algorithm family.
GLOBS = {"w2v": "*.txt", "fasttext": "*.txt", "elmo": "*.txt", "glove": "*.*", "flair": "*.*", "roberta": "*.*"}
SCOPES = {"w2v": None}
ELMO_SHARD = 100_000


def family(algorithm: str) -> str:
    return algorithm.split("-")[0]


def read_kept(spark: SparkSession, settings: RunSettings, algorithm: str, lang: str) -> DataFrame:
    """Kept lines with ordinals of one language, by the rules of the algorithm."""
    kind = family(algorithm)
    lines = corpus.read_corpus(spark, settings.input_dir, [lang], GLOBS[kind])
    return with_ordinal(shape.kept_lines(lines, SCOPES.get(kind, "lead")))


def static_settings(algorithm: str, params: dict):
    """Checked settings of a static-vector algorithm."""
    if algorithm in ("w2v-s", "w2v-c"):
        return Word2VecSettings.of(params | {"sg": int(algorithm == "w2v-s")})
    if algorithm == "glove":
        return GloveSettings.of(params)
    if algorithm in ("fasttext-s", "fasttext-c"):
        return FastTextSettings.of(params | {"model": "skipgram" if algorithm == "fasttext-s" else "cbow"})
    raise ValueError(f"{algorithm} does not train static vectors")


def train_static(kept: DataFrame, algorithm: str, params: dict) -> trainers.Model:
    settings = static_settings(algorithm, params)
    train = {"w2v": trainers.train_word2vec, "glove": trainers.train_glove, "fasttext": trainers.train_fasttext}
    return train[family(algorithm)](kept, settings)


def prepare_char_lm(kept: DataFrame, settings: CharLmSettings, out: str) -> None:
    """Split text, character dictionary of the test and validation lines, and training windows."""
    lines = shape.with_split(kept)
    shard = F.when(F.col("split") == "train", shape.fixed_shard(F.col("train_ordinal"), settings.temp_file_sent_size)
                   ).otherwise(F.lit(1))
    sinks.write_prepared(lines.withColumn("shard", shard), f"{out}/text", "lang", "split", "shard")
    sinks.write_table(vocab.char_dictionary(vocab.char_counts(lines.where(F.col("split") != "train"))), f"{out}/chars", "lang")
    train = lines.where(F.col("split") == "train")
    windows = lm.char_sequences(train, settings.mini_batch_size, settings.sequence_length)
    if not settings.is_forward_lm:
        windows = windows.select("lang", "stream", "window", F.reverse("target").alias("input"),
                                 F.reverse("input").alias("target"))
    sinks.write_table(windows, f"{out}/sequences", "lang")


def prepare_elmo(kept: DataFrame, settings: ElmoSettings, out: str) -> None:
    """Split text in shards, sequences with their ends in batches of like length, character ids per word."""
    lines = shape.with_split(kept)
    shard = F.when(F.col("split") == "train", shape.counted_twice_shard(F.col("train_ordinal"), ELMO_SHARD)
                   ).otherwise(F.lit(0))
    lines = lines.withColumn("shard", shard)
    sinks.write_prepared(lines, f"{out}/text", "lang", "split", "shard")
    words = shape.sequence_with_ends(tx.split_spaces(F.col("line"), False), settings.max_sequence_length)
    rows = lm.length_batches(lines.withColumn("tokens", words), F.size(words), settings.batch_size)
    sinks.write_table(rows.select("lang", "split", "shard", "ordinal", "n_tokens", "batch", "tokens"),
                      f"{out}/sequences", "lang", "split")
    ids = subword.char_word_ids(lines.select(F.explode(words).alias("word")))
    sinks.write_table(ids, f"{out}/char_ids")


def prepare_masked_lm(kept: DataFrame, settings: MaskedLmSettings, out: str, seed: int = 1) -> None:
    """Shards, tokenizer, and for each epoch masked sequences in shuffled batches."""
    spark = kept.sparkSession
    kept = kept.withColumn("line", tx.rstrip(F.col("line")))
    lines = kept.withColumn("shard", shape.fixed_shard(F.col("ordinal"), settings.lines_per_instance))
    sinks.write_prepared(lines, f"{out}/text", "lang", "shard")
    merges = bpe.train_bpe(bpe.pretoken_counts(lines), settings.vocab_size)
    sinks.write_tokenizer(*bpe.bpe_tables(spark, merges), f"{out}/tokenizer")
    encoded = cut(bpe.encode_text(lines, merges))
    shards = lines.select("lang", "file", "slab", "seq", "shard")
    for epoch in range(settings.epochs):
        rows = lm.mlm_rows(encoded, settings.max_position_size, settings.mask_percentage, seed, epoch)
        batches = lm.shuffled_batches(rows.join(shards, ["lang", "file", "slab", "seq"]), settings.batch_size, seed, epoch)
        sinks.write_table(batches.withColumn("epoch", F.lit(epoch)), f"{out}/encoded", "lang", "epoch", "shard")


PREPARED = ("flair", "elmo", "roberta")


def prepare(kept: DataFrame, algorithm: str, params: dict, out: str) -> None:
    """Write the inputs of a language model."""
    if family(algorithm) == "flair":
        prepare_char_lm(kept, CharLmSettings.of(params), out)
    elif family(algorithm) == "elmo":
        prepare_elmo(kept, ElmoSettings.of(params), out)
    else:
        prepare_masked_lm(kept, MaskedLmSettings.of(params), out)


def prepare_curve(kept: DataFrame, algorithm: str, params: dict, init: int, out: str) -> None:
    """Inputs of a language model for each size of the learning curve, in a folder per size."""
    kept = cut(kept)
    totals = kept.groupBy("lang").agg(F.count("*").alias("n_lines"))
    cutter = shape.prefix if family(algorithm) == "roberta" else shape.prefix_train
    for row in shape.curve_sizes(totals, init).orderBy("run").collect():
        prepare(cutter(kept, row["size"]), algorithm, params, f"{out}/size={row['size']}")


def run_all(spark: SparkSession, settings: RunSettings) -> DataFrame:
    """Train, prepare or tune every known (algorithm, language); returns (lang, algorithm, known)."""
    langs = spark.createDataFrame([(name,) for name in settings.languages], "lang string")
    tuned = TuningSettings.of(settings.tuning_settings) if settings.tuning_settings else None
    for algorithm in [a.lower() for a in settings.algorithms if a.lower() in tuning.ALGORITHMS]:
        params = next(v for k, v in settings.params.items() if k.lower() == algorithm)
        for lang in settings.languages:
            out = f"{settings.output_dir}/{algorithm}"
            if tuned and tuned.tuning_data_dir:
                tune_run(spark, settings, tuned, algorithm, lang, params)
                continue
            kept = read_kept(spark, settings, algorithm, lang)
            if family(algorithm) in PREPARED:
                if settings.train_size_init > 0:
                    prepare_curve(kept, algorithm, params, settings.train_size_init, out)
                else:
                    prepare(kept, algorithm, params, out)
            elif settings.train_size_init > 0:
                found = trainers.train_curve(kept, settings.train_size_init, lambda part: train_static(part, algorithm, params))
                sinks.write_vectors(found, f"{settings.output_dir}/vectors")
            else:
                sinks.write_vectors(train_static(kept, algorithm, params).vectors, f"{settings.output_dir}/vectors")
    return tuning.run_matrix(langs, settings.algorithms)


def tune_run(spark: SparkSession, settings: RunSettings, tuned: TuningSettings, algorithm: str, lang: str, params: dict) -> None:
    """Random search of one run: its trial table, and its best trial appended (N/A where nothing was scored).

    Only static vectors can be scored here; a language model's run is N/A.
    """
    folder = f"{settings.output_dir}/TuningResults"
    run = spark.createDataFrame([(lang.lower(), algorithm)], "lang string, algorithm string")
    if family(algorithm) in PREPARED:
        sinks.append_best(run, run.where("false").withColumn("trial_number", F.lit(0)), f"{folder}/best")
        return
    tagged = shape.sentences_of_tagged(corpus.read_tagged_lines(
        spark, corpus.tagging_paths(tuned.tuning_data_dir, lang, tuned.tag_type)))
    kept = read_kept(spark, settings, algorithm, lang)
    rows = cut(tune(kept, tagged, algorithm, params, tuned.num, tuned.max_lines))
    sinks.write_trials(rows, f"{folder}/trials")
    config = [c for c in rows.columns if c not in ("lang", "algorithm", "trial_number", "accuracy")]
    sinks.append_best(run, tuning.best_trial(rows.where("accuracy >= 0"), config), f"{folder}/best")


def tune(kept: DataFrame, tagged: DataFrame, algorithm: str, params: dict, num: int = 10, max_lines: int = -1,
         seed: int = 1) -> DataFrame:
    """Random search: (lang, algorithm, trial_number, parameters, accuracy).

    ``num`` trials are drawn as a table and trained one after another, each on the lines of its language. A
    trial whose drawn settings leave nothing to learn, or that ends without vectors, scores -1; any other
    mistake in the settings is raised before the first trial.
    """
    spark = kept.sparkSession
    space = {k: v for k, v in params.items() if isinstance(v, dict)}
    fixed = {k: v for k, v in params.items() if not isinstance(v, dict)}
    try:
        static_settings(algorithm, params)
    except NothingToLearn:
        pass
    corpus_lines = cut(shape.prefix(kept, max_lines))
    runs = corpus_lines.select("lang").distinct().withColumn("algorithm", F.lit(algorithm))
    trials = cut(tuning.sample_trials(runs, space, num, seed))
    scores = []
    for row in trials.collect():
        drawn = {k: _typed(next(iter(space[k])), row[k]) for k in space}
        try:
            static_settings(algorithm, fixed | drawn)
        except NothingToLearn:
            continue
        vectors = train_static(corpus_lines.where(F.col("lang") == row["lang"]), algorithm, fixed | drawn).vectors
        dim = vectors.agg(F.max(F.size("vector"))).first()[0]
        if dim is not None:
            accuracy = scoring.downstream_score(tagged, vectors, dim).first()["accuracy"]
            scores.append((row["lang"], algorithm, row["trial_number"], accuracy))
    table = spark.createDataFrame(scores, "lang string, algorithm string, trial_number bigint, accuracy double")
    return tuning.score_or_sentinel(trials, table)


def _typed(kind: str, value):
    """Integer draws as int, choices as the number they spell, if any."""
    if kind.lower().endswith("randint"):
        return int(value)
    if isinstance(value, str):
        try:
            number = float(value)
        except ValueError:
            return value
        return int(number) if number.is_integer() else number
    return value
