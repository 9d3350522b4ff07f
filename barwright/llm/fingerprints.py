"""Document fingerprints by consistent weighted sampling.

A text is a bag of terms: lower-cased words between spaces and stops, weighted by how often
they occur.
Each of `SAMPLES` coordinates draws one (term, level) pair from gamma variates that depend on
the term alone, so two texts agree in a coordinate with the probability of their generalised
Jaccard similarity, sum of least over sum of greatest weights.

Nulls: a null text is empty; a null id sorts after all others. A text without terms has the
fingerprint '' and is like another such text only. Repeated rows and ids are kept, each row has
one successor. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, small_batches, texts, with_neighbours

SAMPLES = 64
#: Terms whose samples a worker remembers; they are worked out anew beyond that.
REMEMBERED = 100_000

_STOPS = ".,;:!?\"()"


def terms_of(text: str) -> list[str]:
    for stop in _STOPS:
        text = text.replace(stop, " ")
    return text.lower().split()


@lru_cache(maxsize=1)
def _variates() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1) at the middles of 65,536 equal steps of probability, by Newton's method, its
    logarithm, and a seed for each coordinate."""
    p = (np.arange(65_536) + 0.5) / 65_536
    x = np.sqrt(2 * p) + p
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x)), x / 4)
    return x.astype(np.float32), np.log(x).astype(np.float32), mixed(np.arange(1, SAMPLES + 1, dtype=np.uint64))


def _drawn(bits: np.ndarray, log_weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """When a weighted term comes, and its level, from the 64 bits of a term and a coordinate."""
    gamma, log_gamma, _ = _variates()
    r = gamma[bits & np.uint64(0xFFFF)]
    log_c = log_gamma[(bits >> np.uint64(16)) & np.uint64(0xFFFF)]
    beta = (bits >> np.uint64(32)).astype(np.float32) * np.float32(2**-32)
    level = np.floor(log_weights / r + beta)
    return log_c - r * (level - beta + 1), level


class Sampler:
    """Signatures of texts; remembers when the terms it has met come in each coordinate."""

    def __init__(self):
        self._forget()

    def _forget(self):
        self.places: dict = {}
        self.late = np.empty((4096, SAMPLES), np.float32)
        self.hashes, self.logs = np.empty(4096, np.uint64), np.empty(4096, np.float32)

    def _learn(self, new: list[tuple[str, int]]) -> None:
        start, end = len(self.places), len(self.places) + len(new)
        while end > len(self.logs):
            self.late, self.hashes, self.logs = (
                np.concatenate([x, np.empty_like(x)]) for x in (self.late, self.hashes, self.logs))
        self.hashes[start:end] = [xxhash.xxh3_64_intdigest(term) for term, _ in new]
        self.logs[start:end] = np.log([float(n) for _, n in new])
        seeds = _variates()[2]
        for at in range(start, end, 2048):
            part = slice(at, min(at + 2048, end))
            bits = mixed(self.hashes[part, None] ^ seeds[None, :])
            self.late[part] = _drawn(bits, self.logs[part, None])[0]
        self.places.update(zip(new, range(start, end)))

    def signature(self, text: str) -> np.ndarray | None:
        bag = list(Counter(terms_of(text)).items())
        if not bag:
            return None
        rows = list(map(self.places.get, bag))
        if None in rows:
            if len(self.places) > REMEMBERED:
                self._forget()
                rows = [None] * len(bag)
            self._learn([pair for pair, row in zip(bag, rows) if row is None])
            rows = list(map(self.places.get, bag))
        rows = np.array(rows)
        # a very long text has many terms: a few thousand at a time, then the earliest of those
        ends = [rows[at:at + 4096] for at in range(0, len(rows), 4096)]
        best = np.stack([part[self.late.take(part, axis=0).argmin(axis=0)] for part in ends])
        columns = np.arange(SAMPLES)
        first = best[self.late[best, columns].argmin(axis=0), columns]
        bits = mixed(self.hashes[first] ^ _variates()[2])
        level = _drawn(bits, self.logs[first])[1]
        return (mixed(bits ^ level.astype(np.int64).astype(np.uint64)) & np.uint64(0xFFFF)).astype(np.uint16)


def as_text(signature: np.ndarray | None) -> str:
    return "" if signature is None else signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    if a is None or b is None:
        return float(a is b)
    return float((a == b).mean())


def edited(text, next_text):
    """`text` with its last half replaced by the first code points of `next_text`."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(next_text, F.lit(1), half))


def _signed(batches):
    sampler, last = Sampler(), (None, None)
    for pdf in batches:
        rows = []
        for text, next_text, edit in zip(pdf["text"], pdf["next_text"], pdf["edited"]):
            own = last[1] if last[0] == text else sampler.signature(text)
            follows = own if next_text == text else sampler.signature(next_text)
            last = (next_text, follows)
            other = sampler.signature(edit)
            rows.append((as_text(own), as_text(other), likeness(own, other),
                         likeness(own, follows)))
        out = pd.DataFrame(rows, columns=["fingerprint", "edited_fingerprint", "near_edited",
                                          "near_next"])
        yield pd.concat([pdf[["doc_id", "n_chars", "edited_sha256"]], out], axis=1)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fingerprint of every text."""
    small_batches(docs.sparkSession)

    def signed(batches):
        sampler = Sampler()
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fingerprint":
                                [as_text(sampler.signature(t)) for t in pdf["text"]]})

    return texts(docs, id, text).mapInPandas(signed, "doc_id bigint, fingerprint string")


def edited_fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they and the next are.

    The next document is the one that follows in descending order of id; the first follows the
    last. Runs one narrow job to find where to cut that order.
    """
    small_batches(docs.sparkSession)
    rows = texts(docs, id, text).withColumn(
        "place", F.coalesce(-F.col("doc_id").cast("decimal(20,0)"), F.lit(str(2**64)).cast("decimal(20,0)")))
    rows = with_neighbours(rows, "place", {"next_text": "text"}, wrap=True)
    rows = rows.select("doc_id", "text", "next_text",
                       F.length("text").cast("bigint").alias("n_chars"),
                       edited(F.col("text"), F.col("next_text")).alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    return rows.mapInPandas(_signed, "doc_id bigint, n_chars bigint, edited_sha256 string, "
                            "fingerprint string, edited_fingerprint string, near_edited double, "
                            "near_next double")
