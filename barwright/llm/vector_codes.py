"""Vector code compression: product codes whose nearest entries are found by Orchard search.

Components become whole numbers, floor(`SCALE` x), and vectors are cut into `PARTS` equal parts with a
codebook each. A codebook starts as that part of the `ENTRIES` rows with the smallest ids (of equal ids
the smaller vector first); each of `ROUNDS` rounds assigns every part of every vector to its nearest
entry, the lower index of equally near ones, and replaces each entry by the componentwise
floor(sum / count) of its parts; unused entries stay. All arithmetic is on whole numbers, so the result is the same
however the rows are dealt out.

Orchard search: every entry has a list of all entries in the order of their distance from it. A
search starts at some entry and walks its list; an entry that is nearer to the vector becomes the
current one and its list is walked instead; entries met before are marked and not measured again. By
the triangle inequality an entry beyond twice the current distance from the current entry is no
nearer, so there the walk ends. Ties cannot hide beyond it, as the bound is strict.

Each round is one pass in which a task adds up its sums, `ENTRIES` times the length of a vector numbers, before they are
added over tasks; the same number of sums reaches the driver, whatever the table holds. Codes are written once, and errors are
added up per label before they meet them again.

Nulls: rows whose vector is null or holds a null or non-finite component are left out. Rows of other
lengths than the most frequent one that `PARTS` divides (the longer of equally frequent ones), or with a component
beyond `LARGEST`, cannot be coded exactly: they are kept with null code and error and take no part in anything.
Null ids come last, null labels are one label, repeated rows are kept, an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.plans.durable import cut

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Absolute value of a component up to which squared distances and their sums are exact 64-bit numbers.
LARGEST = 2.0**16
#: Vectors that are searched at once.
TOGETHER = 2048


class Codebooks:
    """Entries of all parts, (parts, entries, length of a part), and the lists that Orchard search walks."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        parts, n, width = entries.shape
        self.flat = entries.reshape(parts * n, width)
        gaps = np.stack([((book[:, None] - book[None]) ** 2).sum(axis=2) for book in entries]) if n else np.zeros((parts, 0, 0), np.int64)
        order = np.argsort(gaps, axis=2, kind="stable")
        # by entry, counted over all parts: the entries of its part by distance from it, and those distances
        self.near = (order + np.arange(parts)[:, None, None] * n).reshape(parts * n, n)
        self.gap = np.take_along_axis(gaps, order, axis=2).reshape(parts * n, n)
        # where a search starts: the entry whose sum of components is nearest
        sums = entries.sum(axis=2)
        self.by_sum = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.by_sum, axis=1)

    def __getstate__(self):
        return self.entries

    def __setstate__(self, entries):
        self.__init__(entries)

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of (rows, parts, length) whole numbers: index and squared distance of each part's nearest entry."""
        rows, parts, width = vectors.shape
        n = self.entries.shape[1]
        queries = vectors.reshape(rows * parts, width)
        current = self._starts(vectors).reshape(-1)
        best = ((queries - self.flat[current]) ** 2).sum(axis=1)
        met = np.zeros((len(queries), n), bool)
        met[np.arange(len(queries)), current % n] = True
        place = np.zeros(len(queries), np.int64)
        active = np.arange(len(queries))
        while len(active):
            at, step = current[active], place[active]
            active = active[self.gap[at, step] <= 4 * best[active]]
            at, step = current[active], place[active]
            other = self.near[at, step]
            fresh = ~met[active, other % n]
            who, which = active[fresh], other[fresh]
            met[who, which % n] = True
            distance = ((queries[who] - self.flat[which]) ** 2).sum(axis=1)
            nearer = (distance < best[who]) | (distance == best[who]) & (which < current[who])
            place[active] += 1
            who = who[nearer]
            current[who], best[who], place[who] = which[nearer], distance[nearer], 0
            active = active[place[active] < n]
        return (current % n).reshape(rows, parts), best.reshape(rows, parts)

    def _starts(self, vectors: np.ndarray) -> np.ndarray:
        n = self.entries.shape[1]
        out = np.empty(vectors.shape[:2], np.int64)
        for part, (sums, order) in enumerate(zip(self.sums, self.by_sum)):
            out[:, part] = part * n + order[np.minimum(np.searchsorted(sums, vectors[:, part].sum(axis=1)), n - 1)]
        return out


def _whole(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """Vectors of an Arrow column as whole numbers, (rows, parts, length of a part)."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * SCALE).astype(np.int64).reshape(len(column), parts, width)


def prepared(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label and vector of the rows that are not left out."""
    number = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))
    rows = df.select(F.col(id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    return rows.where(F.col("vector").isNotNull() & F.forall("vector", number))


def _length(rows: DataFrame, parts: int) -> int:
    """The most frequent length that `parts` divides; 0 if there is none."""
    sizes = rows.groupBy(F.size("vector").alias("n")).count().where((F.col("n") > 0) & (F.col("n") % parts == 0))
    first = sizes.orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return first[0]["n"] if first else 0


def _coded(rows: DataFrame, length: int) -> DataFrame:
    return rows.where((F.size("vector") == length) & F.forall("vector", lambda x: F.abs(x.cast("double")) <= LARGEST))


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of `prepared` rows; None without any. Runs a few small jobs and `rounds` passes."""
    length = _length(rows, parts)
    rows = _coded(rows, length)
    first = (rows.orderBy(F.asc_nulls_last("vec_id"), F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE)))
             .limit(entries).select("vector").collect()) if length else []
    if not first:
        return None
    width = length // parts
    start = np.array([row["vector"] for row in first], np.float64)
    start = np.floor(start * SCALE).astype(np.int64).reshape(len(first), parts, width)
    books = Codebooks(np.ascontiguousarray(start.transpose(1, 0, 2)))
    for _ in range(rounds):
        sums = rows.select("vector").mapInArrow(
            _summed(rows.sparkSession.sparkContext.broadcast(books)), "part int, entry int, at int, n bigint, total bigint")
        # 64 bits hold the sums of a task; those of the table may need more
        sums = sums.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(28,0)")).alias("total"))
        moved = books.entries.copy()
        for row in sums.collect():  # at most entries times length rows
            moved[row["part"], row["entry"], row["at"]] = int(row["total"]) // row["n"]
        books = Codebooks(moved)
    return books


def _summed(sent):
    def add(batches):
        books = sent.value
        parts, n, width = books.entries.shape
        totals, counts = np.zeros((parts * n, width), np.int64), np.zeros(parts * n, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                vectors = _whole(batch.column(0).slice(start, TOGETHER), parts, width)
                codes, _ = books.nearest(vectors)
                flat = (codes + np.arange(parts) * n).reshape(-1)
                np.add.at(totals, flat, vectors.reshape(-1, width))
                counts += np.bincount(flat, minlength=parts * n)
        used = np.repeat(counts.nonzero()[0], width)
        at = np.tile(np.arange(width), len(used) // width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used // n, pa.int32()), pa.array(used % n, pa.int32()), pa.array(at, pa.int32()),
             pa.array(counts[used]), pa.array(totals[used, at])], names=["part", "entry", "at", "n", "total"])
    return add


def encode(rows: DataFrame, books: Codebooks | None) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits a part) and error (squared) of all `prepared` rows."""
    kinds = {f.name: f.dataType for f in rows.schema}
    missing = (F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    if books is None:
        return rows.select("vec_id", "label", *missing)
    parts, _, width = books.entries.shape
    sent = rows.sparkSession.sparkContext.broadcast(books)

    def coded(batches):
        books = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(start, TOGETHER)
                codes, errors = books.nearest(_whole(part.column(2), parts, width))
                text = codes.astype(np.uint8).tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)], pa.string()),
                     pa.array(errors.sum(axis=1))], names=["vec_id", "label", "code", "error"])

    able = _coded(rows, parts * width)
    schema = f"vec_id {kinds['vec_id'].simpleString()}, label {kinds['label'].simpleString()}, code string, error bigint"
    fits = (F.size("vector") == parts * width) & F.forall("vector", lambda x: F.abs(x.cast("double")) <= LARGEST)
    return able.mapInArrow(coded, schema).unionByName(rows.where(~fits).select("vec_id", "label", *missing))


def compressed(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
               parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error (of all rows with the same label) and codebooks_sha256 of every row kept."""
    rows = prepared(df, id, vector, label)
    books = train(rows, parts, entries, rounds)
    codes = cut(encode(rows, books), "codes")
    # written, so that its size is known: few labels are sent to all tasks, many are joined by shuffle
    sums = cut(codes.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")), "errors")
    digest = F.lit(books.digest() if books else None).cast("string")
    return (codes.join(sums, codes["label"].eqNullSafe(sums["same"]), "left")
            .select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256")))
