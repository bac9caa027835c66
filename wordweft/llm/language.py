"""Language identification by error-correcting output codes.

Each learned language has a binary codeword. One binary classifier per bit sees the hashed character
n-grams of the whole text and predicts the bit with a signed margin. Loss-weighted decoding adds, for each
codeword, the exponential loss of all margins against its bits, and takes the codeword with the least loss.
A text whose two best codewords lie close is flagged as ambiguous.

Learning: per-language n-gram counts of a bounded sample (FIT_DOCS documents per language, the first in
hashed order; of one with more than FIT_CHARS code points a window of that length, and only where there are not
enough shorter ones) give each bit a log-odds weight per n-gram; the margin of
a bit is the mean weight of the text's n-grams. Only text and language of documents that are not held out
are learned from; a prediction sees text alone.

Nulls: a null text or one without letters is ``und`` with score 0. A null language teaches nothing. With no
learned language all texts are ``und``; with one, that language has score 1. Repeated rows are predicted
alike. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_text, remainder, text_lengths, texts_by_id

FIT_DOCS, FIT_CHARS = 600, 30_000
ORDERS = (1, 2, 3)
BUCKETS = 1 << 13
#: Beyond this many languages the code is drawn instead of enumerated, with this many bits at least.
EXHAUSTIVE, DRAWN_BITS = 6, 31
SHARPNESS, AMBIGUOUS = 4.0, 0.6
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")


def ngram_counts(text: str) -> np.ndarray:
    """Counts of hashed character 1- to 3-grams of the lower-cased text, other runs being one space."""
    code = np.frombuffer((" " + _OTHER.sub(" ", text.lower()).strip() + " ").encode("utf-32-le"), "<u4").astype(np.uint64)
    total = np.zeros(BUCKETS, np.int64)
    key = np.zeros(len(code), np.uint64)
    for order in range(1, max(ORDERS) + 1):
        key = key[:len(code) - order + 1] * np.uint64(0x9E3779B1) + code[order - 1:]
        if order in ORDERS and len(key):
            mixed = (key * np.uint64(0x9E3779B97F4A7C15) + np.uint64(order)) >> np.uint64(51)
            total += np.bincount(mixed.astype(np.int64), minlength=BUCKETS)
    return total


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """n codewords of +-1. Few classes: every split of the classes once. More: the drawn code, of many,
    with the largest least distance."""
    if n <= EXHAUSTIVE:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits or [(1,)]).T
    rng, bits = np.random.default_rng(seed), max(DRAWN_BITS, 4 * int(np.ceil(np.log2(n))) + 1)
    best, distance = None, -1
    for _ in range(200):
        code = rng.choice([1, -1], (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        apart = (code.shape[1] - code @ code.T) // 2 + np.eye(n, dtype=int) * bits
        if apart.min() > distance:
            best, distance = code, apart.min()
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits

    def predict(self, texts) -> list[tuple[str, float, bool]]:
        out = []
        for text in texts:
            if not self.languages or not text or not _LETTER.search(text):
                out.append((UNKNOWN, 0.0, True))
                continue
            counts = ngram_counts(text)
            margins = counts @ self.weights / max(1, counts.sum())
            loss = np.exp(np.clip(-self.code * margins, -30, 30)).mean(1)
            share = np.exp(-SHARPNESS * (loss - loss.min()))
            share /= share.sum()
            best = int(share.argmax())
            out.append((self.languages[best], float(share[best]), bool(share[best] < AMBIGUOUS)))
        return out


def fit(samples: dict[str, list[str]]) -> Model:
    """Texts per language -> model. Each language counts the same, whatever its sample's size."""
    languages = sorted(samples)
    if not languages:
        return Model([], np.zeros((0, 0)), np.zeros((BUCKETS, 0)))
    share = np.zeros((len(languages), BUCKETS))
    for k, name in enumerate(languages):
        for text in samples[name]:
            share[k] += ngram_counts(text)
        share[k] /= max(1.0, share[k].sum())
    code = codewords(len(languages))
    floor = 1e-6
    weights = [np.log(share[bit == 1].mean(0) + floor) - np.log((share[bit == -1].mean(0) if (bit == -1).any() else 0) + floor)
               for bit in code.T]
    return Model(languages, code, np.array(weights).T)


def train(docs: DataFrame, held_out: int = 0, fit_docs: int = FIT_DOCS) -> Model:
    """Fit on documents whose crc32(doc_id as text) mod 5 is not ``held_out``."""
    known = text_lengths(docs, "lang").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (remainder(F.col("doc_id"), 5) != held_out))
    # Ids of all languages in one job: a task hands on its own first ones of each.
    first = Window.partitionBy("lang").orderBy("is_long", F.xxhash64(F.col("doc_id").cast("string"), F.lit(5)), "doc_id")
    sized = known.groupBy("lang", "doc_id").agg(F.min(F.col("n_chars") > FIT_CHARS).alias("is_long"))
    rows = sized.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= fit_docs).select("lang", "nth", "doc_id").collect()
    ids: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["nth"])):
        ids.setdefault(r["lang"], []).append(r["doc_id"])
    texts = texts_by_id(docs, sorted({i for chosen in ids.values() for i in chosen}), FIT_CHARS)
    return fit({n: [texts[i] for i in chosen if i in texts] for n, chosen in ids.items()})


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous: one row per document row, in the tasks that read it."""
    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def decode(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.predict(texts.tolist()), columns=["lang_pred", "score", "ambiguous"])

    return doc_text(docs).withColumn("found", decode("text")).select("doc_id", "found.*")
