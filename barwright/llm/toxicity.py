"""Toxicity by a weighted lexicon.

Texts are folded first: compatibility forms, case and accents go, letters of other scripts that
look Latin become Latin, and digits and signs that stand for letters beside letters become those.
An Aho-Corasick automaton then finds the terms of the lexicon, whole words or beginnings of words.
A word counts with the greatest weight of the terms in it; words inside an exception phrase do
not count. The score is logistic in the log of the total weight and in the log of the weight
per hundred words.

The lexicon is learned from labelled rows: words, beginnings of words and beginnings that two different words of a text
share are candidates if they stand in at least `LEAST_DOCS` texts, at least half of them toxic (the `CANDIDATES` in most toxic texts,
if there are more); among them those are taken, one
after another, that explain most toxic texts not yet explained, and those with much evidence of their own; all weighted by their log odds. Two
words in a row that hold a term and stand only in texts that are not toxic become exceptions.
At most `TRAIN_ROWS` labelled rows are used, those with the least hash of their id.

Nulls: a null text is empty, and an empty text has the score of a text without terms; rows
without a label are not learned from. An id with several labels is toxic if one of them says so. Without any toxic row the lexicon is empty, and scores
are the smoothed share of toxic rows. Repeated rows and ids are kept; other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, small_batches, texts

TRAIN_ROWS = 20_000
LEAST_DOCS = 4
LEAST_PRECISION = 0.5
#: Of toxic texts that hold a term, and of texts that hold it that are toxic, from which it is in the lexicon in any case.
SUPPORT, PRECISE = 0.05, 0.9
PREFIXES = (4, 5, 6, 7)
CANDIDATES = 20_000
THRESHOLD = 0.7

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = str.maketrans({
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ɡ": "g", "һ": "h", "н": "h",
    "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "п": "n", "о": "o", "р": "p",
    "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i",
})
# Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
               "!": "i"}

#: Ends a term that counts only where two different words of a text begin with it.
TWICE = "*"

_MARKS = re.compile("[̀-ͯ]+")
_LOOKALIKE = re.compile("[ıɡͰ-ϿЀ-ԯ]")
_STANDING = re.compile(r"(?<=[^\W\d_])[013457@$!8](?=[^\W\d_])|(?<!\w)[013457@$8](?=[^\W\d_]{2})"
                       r"|(?<=[^\W\d_]{2})[013457](?!\w)")
_WORD = re.compile(r"[^\W_]+")


def folded(text: str) -> str:
    """Folded words between single spaces, one at either end."""
    text = text.lower()
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower()
        if _LOOKALIKE.search(text):
            text = text.translate(HOMOGLYPHS)
    text = _STANDING.sub(lambda m: SUBSTITUTES[m[0]], text)
    return " " + " ".join(_WORD.findall(text)) + " "


def terms_of(words: set[str]) -> set[str]:
    """Words end with a space, beginnings of words do not; with TWICE, those that two different words begin with."""
    found = {word + " " for word in words}
    for n in PREFIXES:
        times = Counter(word[:n] for word in words if len(word) > n)
        found.update(times)
        found.update(term + TWICE for term, many in times.items() if many > 1)
    return found


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    intercept: float = 0.0
    slopes: tuple[float, float] = (0.0, 0.0)

    def __post_init__(self):
        self.terms, self.phrases = ahocorasick.Automaton(), ahocorasick.Automaton()
        pairs: dict[str, list[float]] = {}
        for term, weight in self.weights.items():
            plain = term.rstrip(TWICE)
            pairs.setdefault(plain, [0.0, 0.0])[plain != term] = weight
        for term, (weight, twice) in pairs.items():
            self.terms.add_word(" " + term, (len(term) + 1, weight, twice))
        for phrase in self.exceptions:
            inner = folded(phrase)
            self.phrases.add_word(inner, len(inner))
        self.terms.make_automaton()
        self.phrases.make_automaton()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("terms", "phrases")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def hits(self, text: str) -> dict[int, float]:
        """Of a folded text: where words with a term begin, and their weight."""
        found: dict[int, float] = {}
        begun: dict[int, list[tuple[int, float]]] = {}
        if self.weights:
            for end, (length, weight, twice) in self.terms.iter(text):
                start = end + 1 - length
                if weight:
                    found[start] = max(found.get(start, 0.0), weight)
                if twice:
                    begun.setdefault(text[start + 1:end + 1], []).append((start, twice))
        for term, places in begun.items():
            if len({text[start + 1:text.index(" ", start + 1)] for start, _ in places if text[start + 1 + len(term)] != " "}) > 1:
                for start, twice in places:
                    found[start] = max(found.get(start, 0.0), twice)
        if found and self.exceptions:
            for end, length in self.phrases.iter(text):
                for start in [s for s in found if end + 1 - length <= s < end]:
                    del found[start]
        return found

    def features(self, text: str) -> tuple[float, float]:
        text = folded(text)
        total = sum(self.hits(text).values())
        return np.log1p(total), np.log1p(100 * total / max(1, text.count(" ") - 1))

    def score(self, text: str) -> float:
        x, y = self.features(text)
        return float(1 / (1 + np.exp(-(self.intercept + self.slopes[0] * x + self.slopes[1] * y))))


def _fitted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method; every slope at least zero."""
    x = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [1e-1] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _cover(candidates: pd.DataFrame, docs: dict[str, set]) -> dict[str, float]:
    """Terms one after another, each the one that explains most texts still unexplained."""
    left, chosen = set().union(*docs.values()) if docs else set(), {}
    odds = dict(zip(candidates["term"], candidates["odds"]))
    pending = dict(docs)
    while pending:
        best = max(pending, key=lambda t: (len(pending[t] & left), odds[t], len(t), t))
        if len(pending[best] & left) < LEAST_DOCS - 1:
            break
        chosen[best] = float(odds[best])
        left -= pending.pop(best)
    return chosen


def _longest(sure: pd.DataFrame) -> dict[str, float]:
    """Terms without those whose texts are nearly all told by a longer term that begins with them."""
    rows = sorted(zip(sure["term"], sure["n_toxic"], sure["odds"]))
    names, out = [term for term, _, _ in rows], {}
    for term, n, odds in rows:
        plain, told = term.rstrip(TWICE), False
        for other, m, _ in rows[bisect_left(names, plain):]:
            if told or not other.startswith(plain):
                break
            told = len(other.rstrip(TWICE)) > len(plain) and m >= PRECISE * n
        if not told:
            out[term] = float(odds)
    return out


def learn(labelled: DataFrame, exceptions: list[str] = (), text: str = "text",
          toxic: str = "toxic") -> Lexicon:
    """A lexicon from at most TRAIN_ROWS rows of text and label; runs three jobs over those."""
    spark = labelled.sparkSession
    small_batches(spark)
    rows = labelled.select(F.coalesce(F.col(text), F.lit("")).alias("text"),
                           F.col(toxic).cast("int").alias("toxic")).where("toxic in (0, 1)")

    def counted(batches):
        seen = {0: Counter(), 1: Counter()}
        for pdf in batches:
            for body, label in zip(pdf["text"], pdf["toxic"]):
                seen[label].update(terms_of(set(folded(body).split())))
                seen[label][""] += 1
        # terms of toxic texts only: others cannot become candidates
        yield pd.DataFrame([(t, n, 0) for t, n in seen[1].items()], columns=["term", "n_toxic", "n_clean"])
        yield pd.DataFrame([(t, 0, n) for t, n in seen[0].items()], columns=["term", "n_toxic", "n_clean"])

    counts = (rows.mapInPandas(counted, "term string, n_toxic bigint, n_clean bigint")
              .groupBy("term").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
              .where((F.col("term") == "") | ((F.col("n_toxic") >= LEAST_DOCS) & (
                  F.col("n_toxic") >= LEAST_PRECISION * (F.col("n_toxic") + F.col("n_clean")))))
              .orderBy(F.col("term") != "", F.desc("n_toxic"), "term").limit(CANDIDATES).toPandas())
    total = counts[counts["term"] == ""]
    counts = counts[counts["term"] != ""]
    n_toxic, n_clean = (int(total[c].sum()) for c in ("n_toxic", "n_clean"))
    counts["odds"] = (np.log((counts["n_toxic"] + 0.5) / (n_toxic + 1))
                      - np.log((counts["n_clean"] + 0.5) / (n_clean + 1)))
    # a term must be so much likelier in toxic texts that a few copies of one text do not do it
    counts = counts[counts["odds"] > 2]
    everything = spark.sparkContext.broadcast(set(counts["term"]))

    def found(batches):
        sought = everything.value
        for pdf in batches:
            terms = []
            for body in pdf["text"]:
                own = terms_of(set(folded(body).split()))
                terms.append(sorted(own & sought))
            yield pd.DataFrame({"terms": terms})

    docs: dict[str, set] = {}
    holders = rows.where("toxic = 1").mapInPandas(found, "terms array<string>")
    for i, row in enumerate(holders.toLocalIterator()):
        for term in row["terms"]:
            docs.setdefault(term, set()).add(i)
    # terms with much evidence of their own are in as well, since other texts may hold them alone
    sure = counts[(counts["n_toxic"] >= max(LEAST_DOCS, SUPPORT * n_toxic)) & (counts["n_toxic"] >= PRECISE * (counts["n_toxic"] + counts["n_clean"]))]
    weights = _longest(sure) | _cover(counts, docs)
    lexicon = Lexicon(weights, list(exceptions))
    return _calibrated(rows, lexicon, n_toxic, n_clean)


def _calibrated(rows: DataFrame, lexicon: Lexicon, n_toxic: int, n_clean: int) -> Lexicon:
    sent = rows.sparkSession.sparkContext.broadcast(lexicon)

    def measured(batches):
        lexicon = sent.value
        for pdf in batches:
            out = []
            for body, label in zip(pdf["text"], pdf["toxic"]):
                words = folded(body)
                pairs = []
                for start in lexicon.hits(words):
                    own = words[start + 1:].split(" ", 1)[0]
                    before = words[:start].rsplit(" ", 1)[-1]
                    after = words[start + 1 + len(own):].split(" ", 2)[1:2]
                    pairs += [f"{before} {own}"] * bool(before) + [f"{own} {w}" for w in after if w]
                out.append((label, *lexicon.features(body), sorted(set(pairs))))
            yield pd.DataFrame(out, columns=["toxic", "x", "y", "pairs"])

    seen = rows.mapInPandas(measured, "toxic int, x double, y double, pairs array<string>").toPandas()
    in_toxic, in_clean = Counter(), Counter()
    for label, pairs in zip(seen["toxic"], seen["pairs"]):
        (in_toxic if label else in_clean).update(pairs)
    learned = [p for p, n in in_clean.items() if n >= LEAST_DOCS and p not in in_toxic]
    if not n_toxic or not lexicon.weights:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return Lexicon({}, lexicon.exceptions, float(np.log(share / (1 - share))))
    beta = _fitted(seen[["x", "y"]].to_numpy(), seen["toxic"].to_numpy(float))
    return Lexicon(lexicon.weights, [*lexicon.exceptions, *sorted(learned)], float(beta[0]),
                   (float(beta[1]), float(beta[2])))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the labelled rows to learn from, at most TRAIN_ROWS of them.

    Rows whose crc32(doc_id as text) modulo 3 is 1 are held out.
    """
    chosen = (labels.where(F.col("toxic").isNotNull() & (fold_of(3) != 1))
              .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_ROWS))
    return texts(docs).join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def with_scores(df: DataFrame, lexicon: Lexicon, text: str = "text", score: str = "score") -> DataFrame:
    """All columns of `df` and the score of every row; a column of that name is replaced."""
    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf("double")
    def scored(bodies: pd.Series) -> pd.Series:
        return pd.Series([sent.value.score(t or "") for t in bodies], dtype=float)

    return df.withColumn(score, scored(F.col(text)))


def toxicity(docs: DataFrame, lexicon: Lexicon, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and predicted of every row."""
    rows = with_scores(texts(docs, id, text), lexicon)
    return rows.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
