"""What several operators of this folder share: inputs, row order over tasks, word hashing."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows that Spark hands to Python at once. Texts may be long, so batches are small.
ARROW_ROWS = 512

_WORD = re.compile(r"\w+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session, which hold whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def texts(docs: DataFrame, id: str = "doc_id", text: str = "text", *others: str) -> DataFrame:
    """doc_id and text alone, so that no other column can clash; a null text is empty."""
    return docs.select(F.col(id).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"), *others)


def fold_of(parts: int, id: str = "doc_id"):
    """crc32 of the id as text, modulo `parts`."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % parts


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class WordHashes:
    """64-bit hashes of the words of texts; remembers the words it has met."""

    REMEMBERED = 300_000

    def __init__(self):
        self.met: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = words_of(text)
        met = self.met
        if len(met) > self.REMEMBERED:
            met.clear()
        found = list(map(met.get, words))
        if None in found:
            for at, value in enumerate(found):
                if value is None:
                    word = words[at]
                    found[at] = met[word] = xxhash.xxh3_64_intdigest(word)
        return np.array(found, np.uint64)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` words, in order; of all words if there are fewer, but some."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = words[:len(words) - size + 1].copy()
    for i in range(1, size):
        out = mixed(out) + words[i:len(words) - size + 1 + i]
    return mixed(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: near inputs get unrelated outputs."""
    x = (x + _MIX[0]).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def with_neighbours(df: DataFrame, key: str, after: dict[str, str], before: dict[str, str] | None = None,
                    wrap: bool = False, within: str | None = None,
                    keys: DataFrame | None = None) -> DataFrame:
    """Adds to each row columns of the rows next to it in the order of `key`.

    `after` and `before` map new column names to those of the row that follows or precedes.
    With `wrap` the last row is followed by the first. With `within` only rows with the same
    value there count as neighbours. Rows with equal keys stand in the order of the carried
    columns. `keys` has the same column `key` as `df`, where that is cheaper to read.

    One order over all rows without one task that holds them: the key is cut at the first keys
    of a range partitioning (a narrow job; as many cuts as shuffle partitions), each range is a
    window of its own, and rows at the edges of a range are also lent to the range beside it.
    """
    before = before or {}
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = ((df if keys is None else keys).select(key).repartitionByRange(parts, key)
             .groupBy(F.spark_partition_id().alias("part"))
             .agg(F.min(key).alias("first"), F.max(key).alias("last")).collect())
    edges = [row for row in edges if row["first"] is not None]
    kind, n = df.schema[key].dataType, len(edges)
    firsts = sorted({row["first"] for row in edges})
    lasts = sorted({row["last"] for row in edges})
    starts = F.array(*[F.lit(c).cast(kind) for c in firsts])
    span = F.size(F.filter(starts, lambda c: c <= F.col(key))) if n else F.lit(0)
    spans = F.array(span)
    if after and len(firsts) > 1:
        spans = F.when(F.col(key).isin(firsts[1:]), F.array_append(spans, span - 1)).otherwise(spans)
    if before and len(lasts) > 1:
        spans = F.when(F.col(key).isin(lasts[:-1]), F.array_append(spans, span + 1)).otherwise(spans)
    if wrap and n:
        spans = F.when(F.col(key) == F.lit(firsts[0]).cast(kind),
                       F.array_append(spans, F.lit(-1))).otherwise(spans)
    rows = (df.withColumn("_own", span).withColumn("_span", F.explode(spans))
            .withColumn("_lent", F.col("_own") != F.col("_span"))
            .withColumn("_wrapped", F.col("_span") < 0)
            .withColumn("_span", F.when(F.col("_span") < 0, F.lit(len(firsts))).otherwise(F.col("_span"))))
    ties = [c for c in dict.fromkeys([*after.values(), *before.values()]) if c != key]
    order = Window.partitionBy("_span").orderBy("_wrapped", key, *ties)
    same = lambda move: (move(within).over(order) == F.col(within)) if within else F.lit(True)
    rows = rows.select("*", *[F.when(same(F.lead), F.lead(old).over(order)).alias(new) for new, old in after.items()],
                       *[F.when(same(F.lag), F.lag(old).over(order)).alias(new) for new, old in before.items()])
    return rows.where(~F.col("_lent")).drop("_own", "_span", "_lent", "_wrapped")
