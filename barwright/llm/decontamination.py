"""Benchmark decontamination by pigeonhole edit matching.

Items and texts are folded: lower case, every run of other characters than letters and digits
is one space. A text holds an item if some stretch of it is within the item's error budget, one edit for
`EDIT_CHARS` characters. An item with budget e is split into e + 1 pieces: e edits leave one piece
whole, so an Aho-Corasick automaton over all pieces finds every such text. Where a piece hits, the
stretch the item could take is verified by Myers' bit-parallel distance.

Items shorter than `LEAST_CHARS` folded characters are compared with whole texts only, since they
stand in clean texts as well. The benchmark is read in blocks of at most `BLOCK_CHARS` characters, each
against all texts, so an automaton has a bounded size however large the benchmark is.

Nulls: null items and texts are empty; empty items match nothing; rows with a null id keep it.
Repeated rows give repeated results.
"""

from __future__ import annotations

import re
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, texts

EDIT_CHARS = 20
LEAST_CHARS = 40
BLOCK_CHARS = 8_000_000

_OTHER = re.compile(r"[\W_]+")


def folded(text: str) -> str:
    return _OTHER.sub(" ", text.lower()).strip()


def nearest(item: str, text: str) -> tuple[int, int]:
    """Least distance of `item` to a stretch of `text`, and the first place where such one ends."""
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, place = m, 0
    for j, c in enumerate(text):
        match = masks.get(c, 0)
        vertical = match | minus
        zero = (((match & plus) + plus) ^ plus) | match
        up = minus | (full & ~(zero | plus))
        down = plus & zero
        score += bool(up & top) - bool(down & top)
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, place = score, j + 1
    return best, place


class Benchmark:
    """Items of one block and the automaton over their pieces."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items: list[tuple[int, str, int]] = []
        pieces: dict[str, list[tuple[int, int, int]]] = {}
        self.short: dict[str, list[int]] = {}
        for item_id, body in items:
            body = folded(body)
            if len(body) < LEAST_CHARS:
                if body:
                    self.short.setdefault(body, []).append(item_id)
                continue
            budget = len(body) // EDIT_CHARS
            for k in range(budget + 1):
                start, end = (len(body) * k // (budget + 1), len(body) * (k + 1) // (budget + 1))
                pieces.setdefault(body[start:end], []).append((len(self.items), start, end))
            self.items.append((item_id, body, budget))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, places)
        self.automaton.make_automaton()

    def __getstate__(self):
        return [(i, b) for i, b, _ in self.items] + [(i, b) for b, ids in self.short.items() for i in ids]

    def __setstate__(self, items):
        self.__init__(items)

    def found(self, text: str) -> list[tuple[int, int, int]]:
        """item_id, distance and where the nearest stretch ends, of the items a text holds."""
        text = folded(text)
        out = [(item_id, 0, len(text)) for item_id in self.short.get(text, ())]
        if not self.items:
            return out
        windows: dict[int, list[list[int]]] = {}
        for last, places in self.automaton.iter(text):
            for item, start, end in places:
                body, budget = self.items[item][1:]
                low = max(0, last + 1 - end - budget)
                high = min(len(text), last + 1 - end + len(body) + budget)
                spans = windows.setdefault(item, [])
                if spans and low <= spans[-1][1]:  # hits come in the order of their ends
                    spans[-1] = [min(low, spans[-1][0]), max(high, spans[-1][1])]
                else:
                    spans.append([low, high])
        for item, spans in windows.items():
            item_id, body, budget = self.items[item]
            best = min(((*nearest(body, text[low:high]), low) for low, high in spans),
                       key=lambda x: (x[0], x[2] + x[1]))
            if best[0] <= budget:
                out.append((item_id, best[0], best[2] + best[1]))
        return sorted(out)


def _blocks(benchmark: DataFrame, id: str, text: str):
    """Items a block at a time; the driver holds one block."""
    block, size = [], 0
    rows = benchmark.select(F.col(id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    for row in rows.toLocalIterator():
        block.append((row["id"], row["text"]))
        size += len(row["text"])
        if size >= BLOCK_CHARS:
            yield Benchmark(block)
            block, size = [], 0
    if block:
        yield Benchmark(block)


def contaminations(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item: str = "text") -> DataFrame:
    """doc_id, item_id, distance and end (in the folded text) of every item a text holds."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = texts(docs, id, text)
    schema = "doc_id bigint, item_id bigint, distance int, end int"

    def against(block):
        def search(batches):
            for pdf in batches:
                found = [(d, *hit) for d, t in zip(pdf["doc_id"], pdf["text"]) for hit in block.value.found(t)]
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "distance", "end"])
        return search

    parts = [rows.mapInPandas(against(spark.sparkContext.broadcast(block)), schema)
             for block in _blocks(benchmark, item_id, item)]
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
          item: str = "text") -> DataFrame:
    """The rows of `docs` whose text holds no item, with all their columns."""
    spark = docs.sparkSession
    small_batches(spark)

    def free(block):
        @F.pandas_udf("boolean")
        def holds_none(bodies: pd.Series) -> pd.Series:
            return pd.Series([not block.value.found(t or "") for t in bodies], dtype=bool)
        return holds_none

    for block in _blocks(benchmark, item_id, item):
        docs = docs.where(free(spark.sparkContext.broadcast(block))(F.col(text)))
    return docs
