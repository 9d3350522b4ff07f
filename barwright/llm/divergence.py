"""Source divergence audit: how far apart the term shares of a language's sources are, by a frequent-pattern tree.

Terms are runs of letters A to Z, lower-cased, and of characters beyond ASCII. A language keeps the V terms that stand in at
least `LEAST_DOCS` of its documents. A group (a source in a language) and the language as a whole give each
kept term the smoothed share p = 1 + floor(10^9 (count + 5) / (N + 5 V)), N its count of kept terms. The distance of two
sources is the sum of |p - q| over all kept terms, exactly.

Most sources lack most terms, so the sum over terms is taken from what a term would add if neither source had it, V times
that, and corrected: once for every source that has the term, against all sources as if they lacked it, and once for
every two sources that both have it. With a and b the shares, a0 and b0 those of a term that is lacking,
|a - b| = |a0 - b0| + (|a - b0| - |a0 - b0|) + (|a0 - b| - |a0 - b0|) + (|a - b| - |a - b0| - |a0 - b| + |a0 - b0|).

* What single sources add needs only how often each share occurs in a source: running sums over its shares in order, read
  off at the a0 of every other source.
* What pairs add comes from a frequent-pattern tree. The row of a term is its counts by source, those of zero left out, in the order of
  sources; equal rows are one with a multiplicity. Rows in order visit the tree depth first, so a task
  holds one path of it and a bounded number of nodes. A node (a source and a count below a path) adds its multiplicity times the correction
  for each of its ancestors, once, however many terms share the path.

Texts are counted in tasks, bounded in memory, before anything is shuffled; counts meet by language, source and term, then by
language and term. A term's row holds at most one entry a source, a window at most the sources of a language and its distinct shares.
Results are as many as pairs of sources.

Nulls: null texts, languages and sources are ''. Groups without terms, languages without kept terms and empty texts have rows as any
other; repeated rows count each time; other columns are ignored. A group that is alone in its language has no pairs. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.plans.durable import cut

from .common import small_batches

LEAST_DOCS = 30
TOP_TERMS = 50
SMOOTHING = 5
SHARES = 10**9
#: Distinct terms a task counts before it hands them on.
HELD_TERMS = 500_000
#: Nodes at the beginning of a path by which rows are dealt to tasks.
SHARED_NODES = 3
#: Nodes a task holds before it adds up their corrections, and pairs of sources before it hands them on.
HELD_NODES, HELD_PAIRS = 100_000, 500_000

_LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_TERM_BYTES = bytes(b if b in _LETTERS else 0x20 for b in range(256)).lower()
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_CORRECTIONS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()), ("value", pa.int64())])
_ROW = "array<struct<source: string, p: bigint, p0: bigint>>"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, in UTF-8; lower() and split() of bytes know ASCII only."""
    return text.encode("utf-8", "replace").translate(_TERM_BYTES).split()


def _counted(batches):
    """Occurrences and documents of each term by language and source; handed on when there are many."""
    seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def rows():
        for (lang, source), (times, holders) in seen.items():
            # both counters met the same terms, but not in the same order
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(lang, len(times)), pa.repeat(source, len(times)), pa.array(times, pa.binary()).cast(pa.string()),
                 pa.array(times.values(), pa.int64()), pa.array(list(map(holders.__getitem__, times)), pa.int64())], schema=_COUNTS)
        seen.clear()

    for batch in batches:
        for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            terms = terms_of(text)
            times, holders = seen.get((lang, source)) or seen.setdefault((lang, source), (Counter(), Counter()))
            held -= len(times)
            times.update(terms)
            holders.update(set(terms))
            held += len(times)
            if held > HELD_TERMS:
                yield from rows()
                held = 0
    yield from rows()


def share(count, total, kept) -> Column:
    """1 + floor(SHARES (count + 5) / (total + 5 kept)), exactly; NULL without kept terms."""
    wide = lambda c: (F.col(c) if isinstance(c, str) else c).cast("decimal(24,0)")
    below = wide(total) + F.lit(SMOOTHING) * wide(kept)
    quotient = F.call_function("div", F.lit(SHARES).cast("decimal(10,0)") * (wide(count) + F.lit(SMOOTHING)), F.nullif(below, F.lit(0)))
    return F.lit(1).cast("bigint") + quotient


class _Tree:
    """Nodes met on a walk through the tree of one language, and the path to where it stands."""

    def __init__(self):
        self.sources: dict[str, int] = {}
        self.clear([])

    def clear(self, path: list[tuple[int, int, int]]) -> None:
        self.nodes: list[tuple[int, int, int]] = []  # source, share, share if it lacked the term
        self.parents: list[int] = []
        self.times: list[int] = []
        self.path: list[int] = []
        for node in path:
            self.enter(node)

    def enter(self, node: tuple[int, int, int]) -> None:
        self.parents.append(self.path[-1] if self.path else -1)
        self.path.append(len(self.nodes))
        self.nodes.append(node)
        self.times.append(0)

    def leave(self, depth: int) -> None:
        while len(self.path) > depth:
            node = self.path.pop()
            if self.path:
                self.times[self.path[-1]] += self.times[node]

    def insert(self, row: list[tuple[int, int, int]], times: int) -> None:
        shared = 0
        while shared < min(len(self.path), len(row)) and self.nodes[self.path[shared]] == row[shared]:
            shared += 1
        self.leave(shared)
        for node in row[shared:]:
            self.enter(node)
        self.times[self.path[-1]] += times

    def corrections(self, found: dict[tuple[int, int], int]) -> None:
        """Adds what every node and each of its ancestors correct, its multiplicity times; the walk goes on with new nodes."""
        path = [self.nodes[node] for node in self.path]
        self.leave(0)
        if self.nodes:
            source, p, p0 = np.array(self.nodes, np.int64).T
            parents, times = np.array(self.parents, np.int64), np.array(self.times, np.int64)
            node, above = np.arange(len(parents)), parents
            while len(node := node[above >= 0]):
                above = above[above >= 0]
                both = np.abs(p[above] - p[node]) - np.abs(p[above] - p0[node]) - np.abs(p0[above] - p[node]) + np.abs(p0[above] - p0[node])
                key = source[above] * len(self.sources) + source[node]
                order = np.argsort(key, kind="stable")
                key = key[order]
                firsts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                for pair, value in zip(key[firsts].tolist(), np.add.reduceat((times[node] * both)[order], firsts).tolist()):
                    pair = divmod(pair, len(self.sources))
                    found[pair] = found.get(pair, 0) + value
                above = parents[above]
        self.clear(path)


def _walked(batches):
    """Pair corrections of rows that come in order, that is, as a walk through their tree."""
    tree, lang, found = _Tree(), None, {}

    def rows():
        tree.corrections(found)
        names = list(tree.sources)
        out = [(lang, names[a], names[b], value) for (a, b), value in found.items()]
        found.clear()
        return pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["lang", "source", "other", "value"]), schema=_CORRECTIONS)

    for batch in batches:
        entries = batch.column(1).flatten()
        sources, p, p0 = (entries.field(name).to_pylist() for name in ("source", "p", "p0"))
        ends = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy()).tolist()
        start = 0
        for here, end, n in zip(batch.column(0).to_pylist(), ends, batch.column(2).to_pylist()):
            if here != lang:
                yield rows()
                tree, lang = _Tree(), here
            row = [(tree.sources.setdefault(s, len(tree.sources)), q, q0)
                   for s, q, q0 in zip(sources[start:end], p[start:end], p0[start:end])]
            tree.insert(row, n)
            start = end
            if len(tree.nodes) > HELD_NODES:
                tree.corrections(found)
            if len(found) > HELD_PAIRS:
                yield rows()
    yield rows()


class Audit:
    """Counts of a table's terms, written once; `pairs` and `terms` are read from them."""

    def __init__(self, docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                 least_docs: int = LEAST_DOCS):
        small_batches(docs.sparkSession)
        named = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
        rows = docs.select(named(lang, "lang"), named(source, "source"), named(text, "text"))
        counts = (rows.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
                  .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
        # one more shuffle for both: the documents of a term are added up beside its rows, and most terms are rare and end there
        same = Window.partitionBy("lang", "term")
        kept = counts.select("*", F.sum("docs").over(same).alias("lang_docs")).where(F.col("lang_docs") >= least_docs)
        #: lang, term, n and row (source and n, in the order of sources) of the kept terms
        self.rows = cut(kept.groupBy("lang", "term").agg(
            F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("source", F.col("n").alias("n")))).alias("row")), "terms")
        whole = self.rows.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
        own = self.rows.select("lang", F.explode("row").alias("e")).groupBy("lang", F.col("e.source").alias("source")).agg(
            F.sum("e.n").alias("total"), F.count("*").alias("held"))
        groups = rows.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(whole, "lang", "left")
        filled = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "held", "kept", "lang_total")])
        #: every group: its total, how many kept terms it has, V and total of its language, and its share of a term it lacks
        self.groups = cut(filled.withColumn("p0", share(F.lit(0), "total", "kept")), "groups")

    def _shares(self) -> DataFrame:
        """lang, term, n of the language, source, count and share of every term a group has."""
        held = self.rows.select("lang", "term", F.col("n").alias("lang_n"), F.explode("row").alias("e")).select(
            "lang", "term", "lang_n", "e.source", "e.n")
        known = self.groups.select("lang", "source", "total", "kept", "lang_total", "p0")
        return held.join(known, ["lang", "source"]).withColumn("p", share("n", "total", "kept"))

    def _pair_corrections(self) -> DataFrame:
        """What pairs of sources with a common term add, each pair once, the lesser source first."""
        node = F.struct("source", "p", "p0")
        rows = self._shares().groupBy("lang", "term").agg(F.sort_array(F.collect_list(node)).cast(_ROW).alias("row"))
        patterns = rows.where(F.size("row") > 1).groupBy("lang", "row").agg(F.count("*").alias("n"))
        # rows meet by the beginning of their path, which needs no sample of rows; a task's tree is its own
        walk = patterns.repartition("lang", F.slice("row", 1, SHARED_NODES)).sortWithinPartitions("lang", "row")
        return walk.mapInArrow(_walked, "lang string, source string, other string, value bigint")

    def _beside(self) -> DataFrame:
        """The groups and, for each, the other groups of its language."""
        others = self.groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"))
        return self.groups.join(others, "lang").where(F.col("source") != F.col("other"))

    def _single_corrections(self) -> DataFrame:
        """What the terms a source has add to its distance from every other source, as if that one lacked them.

        The sum of |p - q0| over the shares p of a source comes from the number and sum of those up to q0, running sums over
        the shares and all q0 in order.
        """
        shares = self._shares().groupBy("lang", "source", "p").agg(F.count("*").alias("n")).select(
            "lang", "source", F.col("p").alias("at"), "n", F.lit(None).cast("string").alias("other"), F.lit(None).cast("bigint").alias("p0"))
        asked = self._beside().where("kept > 0").select("lang", "source", F.col("q0").alias("at"), F.lit(0).cast("bigint").alias("n"), "other", "p0")
        own = Window.partitionBy("lang", "source")
        # shares equal to q0 add nothing, on whichever side they are counted
        upto = own.orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
        number, total = F.col("n"), F.col("n") * F.col("at")
        summed = shares.unionByName(asked).select(
            "*", F.sum(number).over(upto).alias("n_low"), F.sum(total).over(upto).alias("low"),
            F.sum(number).over(own).alias("n_all"), F.sum(total).over(own).alias("all"))
        apart = (F.col("n_low") * F.col("at") - F.col("low")) + (F.col("all") - F.col("low") - (F.col("n_all") - F.col("n_low")) * F.col("at"))
        value = apart - F.col("n_all") * F.abs(F.col("p0") - F.col("at"))
        return summed.where(F.col("other").isNotNull()).select("lang", "source", "other", value.alias("value"))

    def pairs(self) -> DataFrame:
        """lang, source, part, item, value and rank of the other sources of every group's language."""
        both = self._pair_corrections()
        single = self._single_corrections()
        lacking = self._beside().select("lang", "source", "other", F.coalesce(
            F.col("kept") * F.abs(F.col("p0") - F.col("q0")), F.lit(0)).alias("value"))
        turned = lambda df: df.unionByName(df.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
        parts = lacking.unionByName(turned(both)).unionByName(turned(single))
        summed = parts.groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
        return _ranked(summed, "pair")

    def terms(self, top: int = TOP_TERMS) -> DataFrame:
        """The terms of which a group has a greater share than its language, the `top` furthest."""
        more = self._shares().select("lang", "source", F.col("term").alias("item"),
                                     (F.col("p") - share("lang_n", "lang_total", "kept")).alias("value"))
        return _ranked(more.where("value > 0"), "term").where(F.col("rank") <= top)


def _ranked(df: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """Parts `pair` and `term` of all groups; counts the terms first."""
    audit = Audit(docs, lang, source, text)
    return audit.pairs().unionByName(audit.terms())
