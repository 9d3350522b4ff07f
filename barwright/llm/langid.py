"""Language identification by error-correcting output codes.

Every language has a codeword; for every bit a binary classifier over character n-grams
(one to three, inside words, hashed into `BUCKETS`) predicts it: naive Bayes with the languages of bit 1 against
those of bit 0, each language with the same weight. A text gets the language whose codeword has
the least loss: logistic loss of each bit's margin, weighted by how well the bit separates the
languages. `score` is the share of the chosen language in exp(-loss) over all languages;
`ambiguous` says that the second language comes within `MARGIN` of it.

Training reads every labelled row of the training folds and gathers one table of n-gram counts
per language, BUCKETS numbers each; the number of languages is the number of distinct labels.

A null text, or one without letters, gets `und` and score 0. Repeated rows and ids are kept;
other columns are ignored. Without any labelled row every text is `und`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, mixed, small_batches

BUCKETS = 1 << 15
MARGIN = 0.2
#: Languages up to which the code has every split of the languages into two; random splits beyond.
EXHAUSTIVE = 6
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def grams(text: str) -> np.ndarray:
    """Hashed n-grams, with repeats, of the letters of a text; empty if it has none."""
    letters = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not _LETTER.search(letters):  # marks alone are no letters
        return np.empty(0, np.int64)
    codes = np.frombuffer(f" {letters} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    two = (codes[:-1] << np.uint64(21)) | codes[1:]
    three = (two[:-1] << np.uint64(21)) | codes[2:]
    three = three[codes[1:-1] != 32]  # within one word
    one = codes[codes != 32]
    hashed = mixed(np.concatenate([one, two + np.uint64(1 << 62), three + np.uint64(1 << 63)]))
    return (hashed & np.uint64(BUCKETS - 1)).astype(np.int64)


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each language."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= EXHAUSTIVE:
        return np.array([[1.0] * n] * 0 + [[1.0 if i == 0 or (s >> (i - 1)) & 1 else -1.0
                                          for i in range(n)] for s in range(2 ** (n - 1) - 1)]).T
    bits = 10 * int(np.ceil(np.log2(n)))
    rng = np.random.default_rng(n)
    tries = [np.where(rng.random((n, bits)) < 0.5, -1.0, 1.0) for _ in range(50)]
    apart = lambda code: ((code @ code.T) - 2 * bits * np.eye(n)).max()
    return min((t for t in tries if (abs(t.sum(axis=0)) < n).all()), key=apart)


class Model:
    """Bit classifiers and codewords of a set of languages."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        shares = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True) if langs else counts
        weights, trust = [], []
        for bit in self.code.T if len(langs) > 1 else []:
            one, zero = shares[bit > 0].mean(axis=0), shares[bit < 0].mean(axis=0)
            odds = np.log(one) - np.log(zero)
            weights.append(odds)
            # how far apart the expected margins of the two sides are, at their nearest
            means = shares @ odds
            trust.append(max(means[bit > 0].min() - means[bit < 0].max(), 0.0) + 1e-3)
        self.weights = np.array(weights, np.float32).T.copy()
        self.trust = np.array(trust) / max(sum(trust), 1e-9)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        found = grams(text) if text else np.empty(0, np.int64)
        if not len(found) or not self.langs:
            return UNKNOWN, 0.0, False
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        counts = np.bincount(found, minlength=BUCKETS)
        used = counts.nonzero()[0]
        # the mean says which way, the square root of the length how surely
        margins = counts[used] @ self.weights[used] / np.sqrt(len(found))
        losses = np.logaddexp(0, -self.code * margins) @ self.trust * len(self.trust)
        shares = np.exp(losses.min() - losses)
        order = np.argsort(-shares, kind="stable")
        total = shares.sum()
        best, second = shares[order[0]] / total, shares[order[1]] / total
        return self.langs[order[0]], float(best), bool(best - second < MARGIN)


def train(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Counts n-grams of all rows with a text and a language; runs one job.

    Each task adds up one array per language; arrays are added per language and part of the
    buckets, so what reaches the driver has languages times BUCKETS numbers.
    """
    small_batches(docs.sparkSession)

    def counted(batches):
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for name, body in zip(pdf["lang"], pdf["text"]):
                found = np.bincount(grams(body), minlength=BUCKETS)
                sums[name] = sums[name] + found if name in sums else found
        for name, total in sums.items():
            used = total.nonzero()[0]
            yield pd.DataFrame({"lang": name, "bucket": used.astype(np.int32), "n": total[used]})

    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    sums = (rows.mapInPandas(counted, "lang string, bucket int, n bigint")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(sums["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS))
    places = {name: i for i, name in enumerate(langs)}
    counts[sums["lang"].map(places).to_numpy(int), sums["bucket"].to_numpy(int)] = sums["n"]
    return Model(langs, counts)


def identify(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and ambiguous of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def predicted(batches):
        model = sent.value
        for pdf in batches:
            rows = [model.predict(t) for t in pdf["text"]]
            out = pd.DataFrame(rows, columns=["lang_pred", "score", "ambiguous"])
            yield pd.concat([pdf[["doc_id"]], out], axis=1)

    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInPandas(predicted, "doc_id bigint, lang_pred string, score double, "
                            "ambiguous boolean")


def held_out(id: str = "doc_id"):
    """True for rows whose language is never learned from; a null id is held out."""
    return F.coalesce(fold_of(4, id) == 2, F.lit(True))
