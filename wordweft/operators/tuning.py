"""Runs, random search and best trials as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_hex, hex_uniform

# Algorithm names and embedding type codes.
ALGORITHMS = ["w2v-s", "w2v-c", "glove", "fasttext-s", "fasttext-c", "flair-f", "flair-b", "elmo", "roberta"]
EMBEDDING_KINDS = {"g": "GLOVE", "f": "FLAIR", "ft": "FASTTEXT", "bert": "ROBERTA", "elmo": "ELMO", "w2v": "W2V"}


def embedding_kind(code: Column) -> Column:
    """Kind of embedding behind a short code, any case; null when unknown."""
    pairs = [F.lit(x) for item in EMBEDDING_KINDS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), F.lower(code))


def run_matrix(languages: DataFrame, algorithms: list[str]) -> DataFrame:
    """(lang, algorithm, known) for each language and requested algorithm, in lower case."""
    names = F.array(*[F.lit(a.lower()) for a in algorithms])
    return (
        languages.select(F.lower("lang").alias("lang"), F.explode(names).alias("algorithm"))
        .withColumn("known", F.col("algorithm").isin(*ALGORITHMS))
    )


def _rounded(x: Column, q: float) -> Column:
    return F.rint(x / F.lit(float(q))) * F.lit(float(q))


def sample_value(kind: str, args: list, digest: Column) -> Column:
    """One draw of a search-space entry from a row digest (numbers as double)."""
    u = hex_uniform(digest)
    kind = kind.lower()
    if kind == "choice":
        return F.element_at(F.array(*[F.lit(str(a)) for a in args]), (F.floor(u * len(args)) + 1).cast("int"))
    a, b = float(args[0]), float(args[1])
    q = float(args[2]) if len(args) > 2 else None
    if kind in ("uniform", "quniform"):
        x = F.lit(a) + u * F.lit(b - a)
    elif kind in ("loguniform", "qloguniform"):
        x = F.exp(F.log(F.lit(a)) + u * (F.log(F.lit(b)) - F.log(F.lit(a))))
    elif kind in ("randn", "qrandn"):
        v = hex_uniform(digest, 9)
        x = F.lit(a) + F.lit(b) * F.sqrt(-2.0 * F.log(F.lit(1.0) - u)) * F.cos(F.lit(6.283185307179586) * v)
    elif kind == "randint":
        return F.floor(F.lit(a) + u * F.lit(b - a)).cast("double")
    elif kind == "qrandint":
        return F.least(_rounded(F.floor(F.lit(a) + u * F.lit(b - a + 1)), q), F.lit(b))
    elif kind == "lograndint":
        return F.floor(F.exp(F.log(F.lit(a)) + u * (F.log(F.lit(b)) - F.log(F.lit(a))))).cast("double")
    elif kind == "qlograndint":
        x = F.exp(F.log(F.lit(a)) + u * (F.log(F.lit(b)) - F.log(F.lit(a))))
        return F.least(_rounded(F.floor(x), q), F.lit(b))
    else:
        raise ValueError(f"unknown search kind {kind!r}")
    return _rounded(x, q) if kind.startswith("q") else x


def sample_trials(runs: DataFrame, space: dict[str, dict[str, list]], num: int = 10, seed: int = 1) -> DataFrame:
    """(lang, algorithm, trial_number, one column per parameter): ``num`` random configurations per run."""
    trials = runs.select("lang", "algorithm", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(num - 1).cast("bigint")))
                         .alias("trial_number"))
    keys = [F.col("lang"), F.col("algorithm"), F.col("trial_number")]
    drawn = []
    for name, entry in space.items():
        kind, args = next(iter(entry.items()))
        drawn.append(sample_value(kind, args, hash_hex(seed, F.lit(name), *keys)).alias(name))
    return trials.select("lang", "algorithm", "trial_number", *drawn)


def grid_trials(runs: DataFrame, grid: dict[str, list]) -> DataFrame:
    """Every combination of the listed values per run, one column per parameter."""
    rows = runs.select("lang", "algorithm")
    for name, values in grid.items():
        rows = rows.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return rows


def space_table(runs: DataFrame, space: dict[str, dict[str, list]]) -> DataFrame:
    """The search space as rows (lang, algorithm, param, kind, args array<string>)."""
    entries = []
    for name, entry in space.items():
        kind, args = next(iter(entry.items()))
        entries.append(F.struct(F.lit(name).alias("param"), F.lit(kind.lower()).alias("kind"),
                                F.array(*[F.lit(str(a)) for a in args]).alias("args")))
    return runs.select("lang", "algorithm", F.explode(F.array(*entries)).alias("e")).select("lang", "algorithm", "e.*")


def default_params(table: DataFrame) -> DataFrame:
    """Without tuning, each parameter takes the first value of its entry."""
    return table.select("lang", "algorithm", "param", "kind", F.element_at("args", 1).alias("value"))


def collapse_space(config: dict) -> dict:
    """Plain configuration from one that may hold search entries: first value of each."""
    kinds = {"choice", "uniform", "quniform", "loguniform", "qloguniform", "randn", "qrandn", "randint",
             "qrandint", "lograndint", "qlograndint"}
    plain = {}
    for key, value in config.items():
        if isinstance(value, dict) and len(value) == 1 and next(iter(value)).lower() in kinds:
            plain[key] = next(iter(value.values()))[0]
        else:
            plain[key] = value
    return plain


def score_or_sentinel(runs: DataFrame, scores: DataFrame) -> DataFrame:
    """Every run with its accuracy; -1 where no model could be scored."""
    return runs.join(scores, ["lang", "algorithm", "trial_number"], "left").withColumn(
        "accuracy", F.coalesce("accuracy", F.lit(-1.0)))


def best_trial(results: DataFrame, config: list[str]) -> DataFrame:
    """The trial of highest accuracy per run; the lower trial number wins a tie."""
    row = F.struct("trial_number", "accuracy", *config)
    best = results.groupBy("lang", "algorithm").agg(
        F.max_by(row, F.struct("accuracy", (-F.col("trial_number")).alias("t"))).alias("b"))
    return best.select("lang", "algorithm", "b.*")


def dev_holdout(sentences: DataFrame, share: float, seed: int, *keys: Column) -> DataFrame:
    """Add ``is_dev``: a hash share of the training sentences."""
    return sentences.withColumn("is_dev", hex_uniform(hash_hex(seed, *keys)) < share)
