"""Outliers, source divergence and vector codes against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwright.llm import divergence, outliers, vector_codes
from barwright.llm.common import table

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    """doc_id, text, lang, source and columns with the operators' own names."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    for name in ("words", "key", "x0", "n", "row", "p0", "value", "vector", "step"):
        df = df.withColumn(name, F.lit("x"))
    return df


# ---------------------------------------------------------------- outliers

def statistics(text):
    """Words, their characters, signs, repeated lines and words in repeated runs of five, by hand."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    runs = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(runs)
    inside = {i + k for i, run in enumerate(runs) if times[run] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


ODD = [None, "", " \n\t\n ", "\n\n\n", "a b c d e", "a b c d e a b c d e", "a a a a a a", "x " * 30_000, "y" * 100_000,
       "one\x1ctwo\x85three   four five", "#" * 40 + " | < > $", "line\r\nline\nline\r\n", "𝒳 𝒴 é 漢字", "a b a b a b a b a b a b",
       "same line here\nsame line here\n\nsame line here", "ab c d e f abc d e f ab c d e f"]


def test_base_statistics(spark):
    texts = ODD + [r["text"] for r in table(spark, SF, "documents").select("text").collect()]
    found = outliers.base_statistics(frame(spark, [(i, t, "en", None) for i, t in enumerate(texts)])).collect()
    assert len(found) == len(texts)
    for row in found:
        want = statistics(texts[row["doc_id"]])
        got = tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == want, texts[row["doc_id"]]
        assert row["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def estimate(rows):
    """The estimate of whole-number rows, with numpy: mean and covariance."""
    x = np.array(rows, float)
    floors = np.diag([(f * outliers.STEPS_A_UNIT) ** 2 for f in outliers.FLOORS])
    h = math.ceil(outliers.CENTRAL * len(x))

    def central(distance):
        steps = np.floor(np.log1p(distance) * outliers.DISTANCE_STEPS)
        near = x[steps <= np.sort(steps)[h - 1]]
        return near.mean(axis=0), np.cov(near.T, bias=True) / 0.6682 + floors

    def distance(m, c):
        return np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)

    low, middle, high = (np.percentile(x, q, axis=0) for q in (25, 50, 75))
    off = np.abs(x - middle) / np.maximum((high - low) / 1.349, np.sqrt(np.diag(floors)))
    best = []
    for away in ((off ** 2).sum(axis=1), off.sum(axis=1), off.max(axis=1)):
        found = central(away)
        for _ in range(outliers.START_STEPS):
            found = central(distance(*found))
        best.append((np.linalg.slogdet(found[1])[1], found))
    found = min(best, key=lambda b: round(b[0], 9))[1]
    for _ in range(outliers.STEPS):
        found = central(distance(*found))
    near = x[distance(*found) <= 12.8325]
    return near.mean(axis=0), np.cov(near.T, bias=True) / 0.9474 + floors


def test_estimates_equal_numpy(spark):
    rng = np.random.default_rng(5)
    rows = []
    for key, n in (("a", 400), ("b", 60), ("c", 1)):
        x = np.floor(rng.multivariate_normal([900, 400, 10, 0, 5], np.diag([90, 20, 9, 1, 9]) ** 2, n)).astype(int)
        x[: n // 5] += [0, 0, 500, 0, 0]
        rows += [(key, *map(int, r)) for r in x]
    df = spark.createDataFrame(rows, "key string, x0 long, x1 long, x2 long, x3 long, x4 long")
    found = {r["key"]: r for r in outliers.estimates(df.repartition(5)).collect()}
    for key in "abc":
        mean, covariance = estimate([r[1:] for r in rows if r[0] == key])
        row = found[key]
        assert np.allclose([row[f"m{i}"] for i in range(5)], mean, rtol=1e-9)
        inverse = np.array([[row[f"w{i}{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
        assert np.allclose(inverse.T @ inverse, np.linalg.inv(covariance), rtol=1e-6, atol=1e-15)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_planted_outliers(spark):
    rng = random.Random(3)
    rows, junk = [], set()
    for i in range(400):  # two groups with an estimate of their own, one of its language, one without any row that passes
        lang, source = [("en", "a"), ("en", "a"), ("en", "b"), ("de", None)][i % 4] if i < 380 else ("en", "tiny")
        text = prose(rng, rng.randrange(60, 300))
        if i % 7 == 0:
            junk.add(i)
            text = " | ".join(text.split()[:40]) if i % 2 else text.replace(" ", "### ")
        rows.append((i, text, lang, source))
    rows += [(1000, None, None, None), (1001, "", "fr", "a"), (1002, rows[1][1], "en", "a"), (1002, rows[1][1], "en", "a"), (None, rows[1][1], "en", "a")]
    found = outliers.outliers(frame(spark, rows).repartition(6)).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"] for r in found if not r["kept"]} == junk | {1000, 1001}
    assert {r["doc_id"] for r in found if r["base_failed"]} == {1000, 1001}
    assert all((r["distance"] is None) == r["base_failed"] for r in found)
    again = outliers.outliers(frame(spark, rows).repartition(3)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_few_and_no_rows(spark):
    assert outliers.outliers(frame(spark, [])).collect() == []
    rows = outliers.outliers(frame(spark, [(1, "word " * 4 + "a b c d e f g", "en", "a"), (2, None, None, None)])).collect()
    assert {(r["doc_id"], r["kept"], r["distance"]) for r in rows} == {(1, True, None), (2, False, None)}


def test_no_python_in_the_plan(spark):
    plan = outliers.outliers(table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---------------------------------------------------------------- divergence

def audit_by_hand(rows, least):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    share = lambda c, n, v: 1 + 10**9 * (c + 5) // (n + 5 * v)
    out = []
    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        own = lambda g: {t: share(counts[g][t], sum(counts[g][k] for k in kept), len(kept)) for t in kept}
        mine = own((lang, source))
        pairs = [(sum(abs(mine[t] - q) for t, q in own((lang, other)).items()), other) for known, other in groups if known == lang and other != source]
        whole = Counter({t: sum(counts[g][t] for g in groups if g[0] == lang) for t in kept})
        q = {t: share(whole[t], sum(whole.values()), len(kept)) for t in kept}
        terms = [(mine[t] - q[t], t) for t in kept if counts[lang, source][t] and mine[t] > q[t]]
        for part, values in (("pair", pairs), ("term", terms)):
            ranked = sorted(values, key=lambda v: (-v[0], v[1].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked) if part == "pair" or i < 50]
    return sorted(out)


@pytest.mark.parametrize("held", [None, 7])
def test_divergence_by_hand(spark, monkeypatch, held):
    if held:  # counts, nodes and pairs are handed on all the time
        for name in ("HELD_TERMS", "HELD_NODES", "HELD_PAIRS"):
            monkeypatch.setattr(divergence, name, held)
    rng = random.Random(11)
    words = [f"{a}{b}" for a in "abcdefgh" for b in ("x", "É", "ß", "Y")] + ["İ", "漢", "naïve"]
    rows = []
    for i in range(300):
        lang, source = rng.choice([("en", "a"), ("en", "a"), ("en", "b"), ("en", None), ("de", "a"), ("de", "c"), ("fr", "solo"), (None, None)])
        rows.append((i, " ".join(rng.choices(words, k=rng.randrange(1, 40))) + rng.choice(["", " A1B-c", "\x00q\x7fq", "é"]), lang, source))
    rows += [(400, None, "en", "empty"), (401, "", "xx", "y"), (402, "zz " * 20_000, "en", "a"), rows[0], rows[0]]
    audit = divergence.Audit(frame(spark, rows).repartition(4), least_docs=9)
    found = audit.pairs().unionByName(audit.terms()).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, found)) == audit_by_hand(rows, 9)


def test_divergence_without_rows(spark):
    assert divergence.divergence(frame(spark, [])).collect() == []
    rows = divergence.divergence(frame(spark, [(1, "a b", "en", "x"), (2, "a", "en", "y")])).collect()
    assert sorted(tuple(r) for r in rows) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


# ---------------------------------------------------------------- vector codes

def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    return df.withColumn("code", F.lit("x")).withColumn("n", F.lit(1)).withColumn("vector", F.lit(0))


def codes_by_hand(rows, parts, entries, rounds):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], label) for i, v, label in rows]
    width = len(kept[0][1]) // parts
    part = lambda v, p: v[p * width:(p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[part(v, p) for _, v, _ in first] for p in range(parts)]
    near = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        moved = []
        for p in range(parts):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[near(p, part(v, p))[1]].append(part(v, p))
            moved.append([[sum(c) // len(members[i]) for c in zip(*members[i])] if members[i] else e for i, e in enumerate(books[p])])
        books = moved
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    coded = [(i, [near(p, part(v, p)) for p in range(parts)], label) for i, v, label in kept]
    errors = Counter()
    for _, found, label in coded:
        errors[label] += sum(d for d, _ in found)
    return sorted(((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), errors[label], digest)
                   for i, found, label in coded), key=str)


@pytest.mark.parametrize("n, width, spread", [(30, 16, 1.0), (200, 32, 0.02), (150, 48, 3.0)])
def test_vector_codes_by_hand(spark, n, width, spread):
    rng = random.Random(n)
    rows = [(rng.randrange(n), [rng.gauss(0, spread) for _ in range(width)], rng.choice([None, 1, 2])) for _ in range(n)]
    rows += [rows[0], (None, rows[1][1], 3)]
    bad = [(1, None, 1), (2, [float("nan")] * width, 1), (3, [float("inf")] + [0.0] * (width - 1), 1), (4, [None] + [0.0] * (width - 1), 1)]
    found = vector_codes.compressed(vectors(spark, rows + bad).repartition(4)).collect()
    assert sorted((tuple(r) for r in found), key=str) == codes_by_hand(rows, 16, 64, 2)


def test_vectors_that_cannot_be_coded(spark):
    rows = [(i, [float(i)] * 16, None) for i in range(5)] + [(7, [], 1), (8, [1.0] * 15, 1), (9, [1e30] * 16, 1), (10, [0.5] * 32, None)]
    found = {r["vec_id"]: r for r in vector_codes.compressed(vectors(spark, rows)).collect()}
    assert set(found) == {0, 1, 2, 3, 4, 7, 8, 9, 10}
    assert all((found[i]["code"] is None) == (found[i]["error"] is None) == (i > 4) for i in found)
    assert found[10]["label_error"] == 0
    assert vector_codes.compressed(vectors(spark, [])).collect() == []
    assert [r["code"] for r in vector_codes.compressed(vectors(spark, rows[5:7])).collect()] == [None, None]


def test_orchard_search_measures_few_entries():
    rng = np.random.default_rng(2)
    books = vector_codes.Codebooks(rng.integers(-500, 500, (4, 64, 3)))
    vectors = rng.integers(-600, 600, (3000, 4, 3))
    codes, errors = books.nearest(vectors)
    apart = ((vectors[:, :, None] - books.entries[None]) ** 2).sum(axis=3)
    assert (codes == apart.argmin(axis=2)).all() and (errors == apart.min(axis=2)).all()
