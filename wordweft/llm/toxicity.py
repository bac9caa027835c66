"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on toxic text. A text is cut into
overlapping windows of its normalised bytes. The margin of a window is the length it compresses to with
the ordinary dictionary minus the length with the toxic one. Calibrated thresholds turn the margins of a
document into a probability.

Training text. Most of a toxic document is ordinary text, on which a dictionary learns nothing about the
class. Toxic samples therefore keep the words that recur in distinct toxic documents and that ordinary
documents hardly have: those that are significantly more than TEST_LIFT times likelier in toxic documents
(one-sided binomial test, false discovery rate ERROR_RATE over all words tested), however rare they are next to
other toxic words. What of them the toxic dictionary holds is up to its training. It has room for TOXIC_ROOM times
the bytes of the distinct words. Both compressors hold the ordinary dictionary, the toxic one holds the toxic
dictionary as well, so that ordinary text costs the same in both. Windows are compressed behind a carrier
text that both dictionaries end with, so a short window never falls back to stored bytes.

A word shorter than a match that the ordinary dictionary lacks is repeated to a match's length, in every text and
whatever its label, so that short words can be matched at all.

Bounds: the model is fitted on at most FIT_DOCS documents per class, the first labelled ones in hashed
order that exist; of one with more than FIT_CHARS code points a window of that length counts, and only where there
are not enough shorter ones. The ordinary dictionary is trained
on every k-th window of them, FIT_WINDOWS to 2 * FIT_WINDOWS where there are more. Everything else reads whole
texts of all documents.

Nulls: a null text is empty; an empty text has one empty window with margin 0 and gets the score of that.
A null label or a label other than 0 and 1 teaches nothing. Without labels of both classes the score is the
share of toxic labels (0 without labels). Repeated rows score alike. An empty table gives no rows. Extra
columns are ignored by ``score`` and returned by ``keep_clean``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_text, first_hashed, remainder, text_lengths, texts_by_id, with_fresh

FIT_DOCS, FIT_CHARS, FIT_WINDOWS = 2500, 30_000, 60_000
WINDOW, STEP = 64, 48
ORDINARY_BYTES, TOXIC_BYTES, TOXIC_ROOM, CARRIER = 32_768, 1024, 4, 64
#: A toxic sample word: recurs in this many documents, this much likelier than in ordinary ones. No more than a
#: share ERROR_RATE of the words found may have a lift of TEST_LIFT or less and be there by chance.
MIN_DOCS, MIN_LIFT, TEST_LIFT, ERROR_RATE = 3, 8.0, 2.0, 0.01
#: The shortest match of the compressors, in bytes, and what short words are repeated to.
MIN_MATCH, SPELLED = 6, 6
#: Dictionaries are trained on segments of this many bytes, weighed by the pieces of so many bytes in them.
ORDINARY_COVER, TOXIC_COVER = (48, 6), (24, 8)
#: The last bytes of the header of a trained dictionary (its three starting offsets); the content follows them.
HEADER_END = b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"
#: Margins, in bytes, whose passing the calibration weighs one by one, and the score of a rejection.
THRESHOLDS = (3, 4, 5, 6)
THRESHOLD = 0.7

_NO_WORD = re.compile(r"[\W_]+")


def normalise(text: str) -> bytes:
    return (" " + _NO_WORD.sub(" ", text.lower()).strip() + " ").encode()


def windows(data: bytes) -> list[bytes]:
    return [data[k:k + WINDOW] for k in range(0, max(1, len(data) - WINDOW + STEP), STEP)]


def short_words(dictionary: bytes) -> frozenset[bytes]:
    """The whole words of a dictionary that are too short for a match."""
    return frozenset(w for w in dictionary.split(b" ")[1:-1] if w and len(w) + 2 < MIN_MATCH)


def spelled(data: bytes, short: frozenset[bytes]) -> bytes:
    """Normalised bytes with the words too short for a match repeated, unless they are in ``short``."""
    return b" ".join([w if len(w) + 2 >= MIN_MATCH or not w or w in short else w * -(-SPELLED // len(w)) for w in data.split(b" ")])


@dataclass
class Model:
    """Dictionaries and calibration; small enough to travel with the tasks."""

    ordinary: bytes
    toxic: bytes
    carrier: bytes
    weights: tuple[float, ...]
    flat: float | None = None  # score of all documents where nothing could be learned
    short: frozenset[bytes] = frozenset()  # short words of the ordinary dictionary, which are not repeated

    def compressors(self):
        import zstandard
        out = []
        for data in (self.ordinary + self.carrier, self.ordinary + self.toxic + self.carrier):
            dictionary = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            settings = zstandard.ZstdCompressionParameters.from_level(
                3, strategy=zstandard.STRATEGY_GREEDY, min_match=MIN_MATCH, window_log=17, source_size=WINDOW + CARRIER,
                dict_size=len(data), write_content_size=0, write_checksum=0, write_dict_id=0)
            dictionary.precompute_compress(compression_params=settings)
            out.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings).compress)
        return out

    def features(self, texts) -> np.ndarray:
        """Per text: 1, the largest margin, whether it passes each threshold, margins above noise, log of the windows."""
        ordinary, toxic = self.compressors()
        carrier, out = self.carrier, []
        for text in texts:
            cuts = [carrier + w for w in windows(spelled(normalise(text), self.short))]
            margins = [len(ordinary(w)) - len(toxic(w)) for w in cuts]
            most = max(margins)
            out.append((1.0, min(most, 12) / 4, *(float(most >= t) for t in THRESHOLDS),
                        math.log1p(sum(m - 2 for m in margins if m > 2)), math.log(len(cuts)) / 4))
        return np.array(out).reshape(len(out), 4 + len(THRESHOLDS))

    def probability(self, texts) -> np.ndarray:
        if self.flat is not None:
            return np.full(len(texts), self.flat)
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ np.array(self.weights), -30, 30)))


def _excess(n: int, total: int, share: float) -> float:
    """The chance that ``n`` or more of ``total`` documents are toxic when a share of them is."""
    at = [math.lgamma(total + 1) - math.lgamma(k + 1) - math.lgamma(total - k + 1)
          + k * math.log(share) + (total - k) * math.log1p(-share) for k in range(n, total + 1)]
    return sum(math.exp(x) for x in at)


def toxic_words(toxic: list[set[str]], ordinary: list[set[str]]) -> dict[str, int]:
    """Words that recur in toxic documents and hardly occur in ordinary ones, with their documents.

    The false discovery rate is held by Benjamini and Hochberg's steps; words in fewer than MIN_DOCS documents
    of both classes cannot be found and are not tested."""
    seen, plain = Counter(w for words in toxic for w in words), Counter(w for words in ordinary for w in words)
    lift = len(ordinary) / max(1, len(toxic))
    share = TEST_LIFT * len(toxic) / max(1, TEST_LIFT * len(toxic) + len(ordinary))
    tested = sum(n + plain[w] >= MIN_DOCS for w, n in seen.items()) + sum(n >= MIN_DOCS for w, n in plain.items() if w not in seen)
    found = [w for w, n in seen.items() if n >= MIN_DOCS and n * lift >= MIN_LIFT * (plain[w] + 0.5)]
    chance = sorted((_excess(seen[w], seen[w] + plain[w], share), w) for w in found)
    last = max((k for k, (p, _) in enumerate(chance, 1) if p * tested <= ERROR_RATE * k), default=0)
    return {w: seen[w] for _, w in chance[:last]}


def _trained(samples: list[bytes], size: int, k: int, d: int) -> bytes:
    """The content of a trained dictionary, or the last bytes of the samples where there is too little to train on."""
    import zstandard
    try:
        return zstandard.train_dictionary(size + 256, samples, k=k, d=d).as_bytes().partition(HEADER_END)[2][-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _calibrate(x: np.ndarray, y: np.ndarray, share: float, rounds: int = 50, ridge: float = 1e-2) -> tuple[float, ...]:
    """Ridge logistic regression by damped Newton steps, at a given share of toxic documents."""
    w = np.zeros(x.shape[1])
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        w = w + np.clip(step, -4, 4)
    return tuple(float(v) for v in w)


def fit(toxic: list[str], ordinary: list[str], share: float | None = None) -> Model:
    """Train the dictionaries and calibrate on the same labelled texts; ``share`` of all are toxic."""
    if not toxic or not ordinary:
        return Model(b"", b"", b"", (), flat=float(bool(toxic)) if share is None else share)
    sides = [[normalise(t) for t in side] for side in (sorted(set(toxic)), sorted(set(ordinary)))]
    words = [[set(d.decode().split()) for d in side] for side in sides]
    chosen = toxic_words(*words)
    cuts = [w for d in sides[1] for w in windows(d)]
    base = _trained(cuts[::max(1, len(cuts) // FIT_WINDOWS)], ORDINARY_BYTES, *ORDINARY_COVER)
    short = short_words(base)
    samples = [(" " + " ".join(w for w in d.decode().split() if w in chosen) + " ").encode() for d in sides[0]]
    samples = [spelled(s, short) for s in samples if len(s) > 2]
    room = TOXIC_ROOM * sum(len(w.encode()) + 1 for w in chosen)
    trained = _trained(samples, max(TOXIC_BYTES, room), *TOXIC_COVER) if samples else b""
    model = Model(base[:-CARRIER], trained, base[-CARRIER:], (), short=short)
    x = model.features([*toxic, *ordinary])
    y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
    model.weights = _calibrate(x, y, y.mean() if share is None else share)
    return model


def train(docs: DataFrame, labels: DataFrame, held_out: int = 1, fit_docs: int = FIT_DOCS) -> Model:
    """Fit on labelled documents whose crc32(doc_id as text) mod 3 is not ``held_out``."""
    known = labels.where("toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    learned = known.where(remainder(F.col("doc_id"), 3) != held_out)
    share = learned.agg(F.avg("toxic")).first()[0]
    sized = text_lengths(docs).join(learned, "doc_id")
    ids = [first_hashed(sized.where(F.col("toxic") == kind), fit_docs, FIT_CHARS) for kind in (1, 0)]
    texts = texts_by_id(docs, ids[0] + ids[1], FIT_CHARS)
    sides = [[texts[i] for i in side if i in texts] for side in ids]
    return fit(*sides, share)


def score(docs: DataFrame, model: Model, *more: str) -> DataFrame:
    """doc_id, score, predicted: one row per document row, in the tasks that read it."""
    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        return pd.Series(model.probability(texts.tolist()), dtype="float64")

    scored = doc_text(docs, *more).withColumn("score", probability("text")).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    @F.pandas_udf("double")
    def probability(texts: pd.Series) -> pd.Series:
        return pd.Series(model.probability(texts.tolist()), dtype="float64")

    name = with_fresh(docs, "_toxicity")
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn(name, probability(text)).where(F.col(name) < THRESHOLD).drop(name)
