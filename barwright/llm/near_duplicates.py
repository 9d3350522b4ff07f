"""Near-duplicates by DartMinHash.

A text is a bag of shingles of five words, weighted by how often they occur (a text of fewer words is one
shingle). Every shingle throws darts at the plane of weight and rank, at places that depend on the
shingle alone; those that land below its weight count, and each of `SAMPLES` coordinates keeps the
earliest dart hashed to it. Two texts agree in a coordinate with the probability of their
weighted Jaccard similarity. The number of darts depends on SAMPLES, not on the length of the text.

Texts that agree in all `ROWS` coordinates of one of the bands are candidates, and candidates are
verified exactly. A pair of similarity 0.8 shares no band with probability 3e-5. Classes are the connected components of verified links.

Equal texts are one text from the start. Within a band, buckets of up to `SMALL` texts are compared
pair by pair. In larger ones a leader, the text that shares bands with most others, is compared
with all, and then texts outside its component in turn, as long as that halves what is outside. Where texts of different components remain, they meet by their rarest shingles, which finds every
pair of similarity 0.8 or more among them. So no similar pair of a bucket is missed, except within a component, and a bucket of n texts
that are alike, or that share only a common passage, does not make n squared pairs.

Nulls: a null text is empty; texts without words are like equal texts only; rows with a null id
take part, and the class of rows without any id is null. Repeated rows are in one class, ids that
repeat with other texts are not. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.plans.durable import cut

from .common import WordHashes, mixed, shingle_hashes, small_batches
from .components import components

WORDS = 5
SIMILARITY = 0.8
ROWS, BANDS = 4, 20
SAMPLES = ROWS * BANDS
SMALL = 16
#: Rows without an id are known by numbers from here on.
_NO_ID = 2**63 - 1 - 2**50

_POISSON = np.cumsum(np.exp(-1.0) / np.concatenate([[1.0], np.cumprod(np.arange(1.0, 13.0))]))
_LOW = np.uint64(0xFFFFFFFF)


def bag_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingle_hashes(words, WORDS), return_counts=True)


def _darts(elements: np.ndarray, weights: np.ndarray, rank: float):
    """Value, coordinate and rank of the darts below the weights and before `rank`.

    Weights are cut into regions of doubling width, ranks into steps that make the area of each cell
    one, so a cell holds a Poisson number of darts of mean one.
    """
    values, ranks = [], []
    for level in range(int(np.log2(weights.max() + 1)) + 1):
        base, width = 2.0**level - 1, 2.0**level
        some = weights > base
        if not some.any():
            break
        steps = int(np.ceil(rank * width))
        cells = mixed(np.arange(steps, dtype=np.uint64) | np.uint64(level << 40))
        seeds = mixed(elements[some][:, None] ^ cells[None, :]).ravel()
        limit = np.repeat(weights[some], steps)
        step = np.tile(np.arange(steps), int(some.sum()))
        count = np.searchsorted(_POISSON, (seeds >> np.uint64(11)) * 2.0**-53)
        for nth in range(int(count.max(initial=0))):
            with_nth = count > nth
            seeds, limit, step, count = seeds[with_nth], limit[with_nth], step[with_nth], count[with_nth]
            dart = mixed(seeds + np.uint64(nth + 1))
            at = base + width * ((dart >> np.uint64(11)) * 2.0**-53)
            when = (step + (mixed(dart) >> np.uint64(11)) * 2.0**-53) / width
            hit = (at < limit) & (when < rank)
            values.append(dart[hit])
            ranks.append(when[hit])
    return np.concatenate(values), np.concatenate(ranks)


def signature(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The earliest dart of each coordinate."""
    wanted = SAMPLES * np.log(SAMPLES) + 2 * SAMPLES
    weights = weights.astype(float)
    while True:
        values, ranks = _darts(elements, weights, wanted / weights.sum())
        coordinates = (mixed(values ^ np.uint64(SAMPLES)) % np.uint64(SAMPLES)).astype(np.int64)
        order = np.argsort(-ranks, kind="stable")
        out, filled = np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES, bool)
        out[coordinates[order]] = values[order]  # the last one written is the earliest
        filled[coordinates] = True
        if filled.all():
            return out
        wanted *= 2


def bands_of(words: np.ndarray) -> list[int]:
    if not len(words):
        return []
    rows = signature(*bag_of(words)).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for column in rows.T:
        key = mixed(key ^ column)
    return key.view(np.int64).tolist()


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][i], b[1][j]).sum()
    return float(least / (a[1].sum() + b[1].sum() - least))


def _known_rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    """doc_id, text and a number for the row that is the id where there is one."""
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = F.lit(_NO_ID) + F.xxhash64("text").bitwiseAND(F.lit(2**50 - 1))
    return rows.withColumn("uid", F.coalesce("doc_id", own))


def _signed(batches):
    hashes, last = WordHashes(), (None, None, None)
    for pdf in batches:
        keys, bands = [], []
        for text in pdf["text"]:
            if text != last[0]:
                last = (text, hashlib.md5(text.encode()).digest(), bands_of(hashes(text)))
            keys.append(last[1])
            bands.append(last[2])
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "uid": pdf["uid"], "key": keys, "bands": bands})


def _verified(pairs: DataFrame, bodies: DataFrame) -> DataFrame:
    """The pairs of similar texts. A text travels once for each pair it is in and once besides."""

    def similar(batches):
        hashes, last = WordHashes(), (None, None)
        for pdf in batches:
            keep = []
            for a, x, y in zip(pdf["a"], pdf["text_a"], pdf["text_b"]):
                if a != last[0]:
                    last = (a, bag_of(hashes(x)))
                keep.append(similarity(last[1], bag_of(hashes(y))) >= SIMILARITY)
            yield pdf.loc[keep, ["a", "b"]]

    side = lambda name: bodies.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
    return joined.mapInPandas(similar, "a bigint, b bigint")


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of one bucket, least node first, once each."""
    both = left.alias("l").join(right.alias("r"), F.expr("l.band = r.band and l.node <> r.node"))
    return both.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")).distinct()


def _tokens(batches):
    """Every shingle of a text, the nth time it occurs: a set whose Jaccard similarity is the bag's."""
    hashes = WordHashes()
    for pdf in batches:
        nodes, tokens = [], []
        for node, text in zip(pdf["node"], pdf["text"]):
            shingles, counts = bag_of(hashes(text))
            nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            tokens.append(mixed(np.repeat(shingles, counts) + mixed(nth.astype(np.uint64))).view(np.int64))
            nodes.append(np.full(len(tokens[-1]), node))
        if tokens:
            yield pd.DataFrame({"node": np.concatenate(nodes), "token": np.concatenate(tokens),
                                "size": np.concatenate([np.full(len(t), len(t), np.int32) for t in tokens])})


def _across(nodes: DataFrame, bodies: DataFrame) -> DataFrame:
    """Pairs of texts of different labels that may be similar, by their rarest shingles.

    Of two texts of similarity t one of the size - ceil(t * size) + 1 rarest shingles of each is
    common to both, and what follows the first common one is long enough in both. Texts that share only
    what many texts hold do not meet. nodes: node, label.
    """
    tokens = cut(bodies.join(nodes.select("node"), "node").select("node", "text")
                 .mapInPandas(_tokens, "node bigint, token bigint, size int"), "tokens")
    # a token that one text has alone is among its rarest, but brings it together with none
    common = tokens.groupBy("token").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("often", "token"))
    rare = (tokens.join(common, "token").withColumn("place", place)
            .where((F.col("place") <= F.col("size") - F.ceil(SIMILARITY * F.col("size") - 1e-9) + 1) & (F.col("often") > 1)))
    rare = cut(rare.join(nodes, "node").select("node", "label", "token", "size", "place"), "rare")
    met = rare.alias("l").join(rare.alias("r"), F.expr(
        f"l.token = r.token and l.node < r.node and l.label <> r.label and "
        f"least(l.size, r.size) >= {SIMILARITY} * greatest(l.size, r.size) - 1e-9 and "
        # of what stands before the first common shingle nothing is common
        f"1 + least(l.size - l.place, r.size - r.place) >= {SIMILARITY / (1 + SIMILARITY)} * (l.size + r.size) - 1e-9"))
    return met.select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct()


def _linked(members: DataFrame, bodies: DataFrame) -> list[DataFrame]:
    """Verified links, written, from all buckets. members: band, node, n and leader of the bucket."""
    small, big = members.where(F.col("n") <= SMALL), members.where(F.col("n") > SMALL)
    pairs = _pairs(small, small).union(
        big.where("node <> leader").select(F.least("leader", "node").alias("a"),
                                           F.greatest("leader", "node").alias("b"))).distinct()
    found = [cut(_verified(pairs, bodies), "links")]
    if big.isEmpty():
        return found
    before = None
    while True:
        labels = components(reduce(DataFrame.union, found))
        known = big.join(labels, "node", "left").select("band", "node", "leader", F.coalesce("label", "node").alias("label"))
        # buckets whose texts are one component already have nothing left to find
        uneven = known.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        known = cut(known.join(uneven.select("band"), "band", "left_semi"), "known")
        main = known.where("node = leader").select("band", F.col("label").alias("main"))
        others = cut(known.join(main, "band").where("label <> main").select("band", "node", "label"), "others")
        left = others.select("node").distinct().count()
        if not left:
            return found
        if before is not None and left > before / 2:
            break  # further leaders would join few texts
        before = left
        # one text outside the leader's component leads in turn, against all of other components
        turn = others.groupBy("band").agg(F.max_by("node", F.xxhash64("node")).alias("turn"),
                                          F.max_by("label", F.xxhash64("node")).alias("own"))
        pairs = known.join(turn, "band").where("label <> own").select(
            F.least("turn", "node").alias("a"), F.greatest("turn", "node").alias("b")).distinct()
        found.append(cut(_verified(pairs, bodies), "links"))
    nodes = cut(known.select("node", "label").distinct(), "nodes")
    found.append(cut(_verified(_across(nodes, bodies), bodies), "links"))
    return found


def _text_key(text: str):
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, uid, key of the text, leads, class_uid and links, a row for each row of `docs`.

    `leads` marks rows of the text that stands for its class, `links` counts verified links to
    other texts. Runs jobs and writes tables to the shared folder.
    """
    small_batches(docs.sparkSession)
    rows = _known_rows(docs, id, text)
    signed = cut(rows.mapInPandas(_signed, "doc_id bigint, uid bigint, key binary, bands array<bigint>"), "signed")
    nodes = signed.groupBy("key").agg(F.min("uid").alias("uid"), F.first("bands").alias("bands"))
    # an id that repeats with another text names the first of these texts only
    again = F.row_number().over(Window.partitionBy("uid").orderBy("key")) > 1
    nodes = nodes.withColumn("node", F.when(again, F.lit(_NO_ID) + F.xxhash64("key").bitwiseAND(F.lit(2**50 - 1)))
                             .otherwise(F.col("uid")))
    nodes = cut(nodes, "nodes")
    banded = nodes.select("node", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    sized = cut(banded.join(buckets, "band"), "members")
    # The text that shares bands with most others leads: copies agree with what they were copied
    # from more often than with each other.
    mass = sized.groupBy("node").agg(F.sum("n").alias("mass"))
    rank = F.col("mass").cast("decimal(38,0)") * F.lit(str(2**63)).cast("decimal(20,0)") - F.col("node")
    ranked = sized.join(mass.select("node", rank.alias("rank")), "node")
    leaders = ranked.groupBy("band").agg(F.max_by("node", "rank").alias("leader"))
    members = cut(sized.join(leaders, "band"), "members")
    wanted = nodes.join(members.select("node").distinct(), "node").select("node", "uid", "key")
    bodies = cut(rows.select("uid", "text", _text_key("text").alias("key")).join(wanted, ["uid", "key"])
                 .dropDuplicates(["uid", "key"]).select("node", "text"), "bodies")
    links = cut(reduce(DataFrame.union, _linked(members, bodies)).distinct(), "links")
    labels = components(links)
    counts = (links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node")
              .agg(F.count("*").alias("links")))
    placed = (nodes.select("key", "uid", "node").join(labels, "node", "left").join(counts, "node", "left")
              .select("key", "node", F.coalesce("label", "node").alias("label"), F.coalesce("links", F.lit(0)).alias("links")))
    first = nodes.select(F.col("node").alias("label"), F.col("uid").alias("class_uid"))
    placed = placed.join(first, "label").select("key", (F.col("node") == F.col("label")).alias("leads"),
                                                "class_uid", "links")
    return signed.select("doc_id", "uid", "key").join(placed, "key")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id (the id of the text that stands for the class), links, stays; of every row."""
    found = classes(docs, id, text)
    return found.select("doc_id", F.when(F.col("class_uid") < _NO_ID, F.col("class_uid")).alias("class_id"), "links",
                        (F.col("leads") & (F.col("uid") == F.col("class_uid"))).alias("stays"))


def without_near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The first document of each class, once, with all its columns."""
    keep = (classes(docs, id, text).where("leads and uid = class_uid")
            .select(F.col("uid").alias("_uid"), F.col("key").alias("_key")).distinct())
    own = F.lit(_NO_ID) + F.xxhash64(F.coalesce(F.col(text), F.lit(""))).bitwiseAND(F.lit(2**50 - 1))
    rows = docs.withColumn("_uid", F.coalesce(F.col(id).cast("bigint"), own)).withColumn("_key", _text_key(text))
    return rows.join(keep, ["_uid", "_key"], "left_semi").dropDuplicates(["_uid", "_key"]).drop("_uid", "_key")
