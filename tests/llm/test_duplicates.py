"""Near-duplicates, repeated passages and decontamination against brute force; the pipeline."""

import random
from collections import Counter

import numpy as np
import pytest

from barwright.llm import decontamination, near_duplicates, passages
from barwright.llm.common import WordHashes, shingle_hashes, table, words_of
from barwright.llm.components import components

SF = "/root/testdata/sf0.01"
WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def changed(rng, text, n):
    words = text.split()
    for at in rng.sample(range(len(words)), n):
        words[at] = "zz" + words[at]
    return " ".join(words)


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, key string, node int")


# ---------------------------------------------------------------- near-duplicates

def bag(text):
    words = [w for w in near_duplicates.WordHashes()(text or "").tolist()]
    size = min(5, len(words))
    return Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def alike(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_signatures_estimate_weighted_jaccard():
    rng, off = random.Random(2), []
    hashes = WordHashes()
    for _ in range(150):
        text = prose(rng, rng.randrange(5, 300))
        other = changed(rng, text + " " + text[:rng.randrange(1, len(text))], rng.randrange(0, 3))
        a, b = (near_duplicates.bag_of(hashes(t)) for t in (text, other))
        assert abs(near_duplicates.similarity(a, b) - alike(bag(text), bag(other))) < 1e-12
        same = near_duplicates.signature(*a) == near_duplicates.signature(*b)
        off.append(same.mean() - near_duplicates.similarity(a, b))
    assert abs(np.mean(off)) < 0.015 and np.std(off) < 0.07


def test_weights_shift_the_darts():
    elements = np.arange(20, dtype=np.uint64) * np.uint64(2**40 + 7)
    ones = np.ones(20, int)
    heavy = np.where(np.arange(20) < 10, 9, 1)
    rate = np.mean([(near_duplicates.signature(elements + np.uint64(k), ones)
                     == near_duplicates.signature(elements + np.uint64(k), heavy)).mean() for k in range(40)])
    assert abs(rate - 20 / 100) < 0.03


def classes_by_hand(ids, texts):
    label = {}
    bags = [bag(t) for t in texts]

    def root(i):
        while label.get(i, i) != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or alike(bags[i], bags[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    found = {}
    for i in range(len(texts)):
        found.setdefault(root(i), []).append(ids[i])
    return sorted(sorted(members, key=str) for members in found.values())


def test_classes_equal_all_pairs(spark):
    rng = random.Random(4)
    texts = [None, "", "", "one two", "one two", "One, two!", "only", "...", "word " * 20_000]
    for _ in range(12):
        base = prose(rng, 120)
        texts += [base, base, changed(rng, base, 1), changed(rng, base, 2), changed(rng, base, 8)]
    hub = prose(rng, 150)
    texts += [changed(rng, hub, 1 + i % 3) for i in range(60)]  # one bucket beyond SMALL
    texts += [prose(rng, 30) for _ in range(40)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = near_duplicates.near_duplicates(frame(spark, [texts[i] for i in order], order).repartition(3)).collect()
    found = {}
    for row in rows:
        found.setdefault(row["class_id"], []).append(row["doc_id"])
    assert sorted(sorted(m, key=str) for m in found.values()) == classes_by_hand(list(range(len(texts))), texts)
    assert all(min(members) == class_id for class_id, members in found.items())
    assert sum(r["stays"] for r in rows) == len(found)


def test_documents_of_the_data(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").toPandas()
    rows = near_duplicates.near_duplicates(table(spark, "/root/testdata/sf0.001", "documents")).collect()
    found = {}
    for row in rows:
        found.setdefault(row["class_id"], []).append(row["doc_id"])
    assert sorted(sorted(m, key=str) for m in found.values()) == classes_by_hand(list(docs["doc_id"]), list(docs["text"]))


def test_leaders_compare_whole_buckets(spark, monkeypatch):
    """With every bucket beyond SMALL, a chain of texts each like the next only is still one class."""
    monkeypatch.setattr(near_duplicates, "SMALL", 2)
    rng = random.Random(9)
    texts = [prose(rng, 100)]
    for _ in range(25):
        texts.append(changed(rng, texts[-1], 2))
    rows = near_duplicates.near_duplicates(frame(spark, texts)).collect()
    found = {}
    for row in rows:
        found.setdefault(row["class_id"], []).append(row["doc_id"])
    assert sorted(sorted(m, key=str) for m in found.values()) == classes_by_hand(list(range(len(texts))), texts)


def test_odd_rows(spark):
    rng = random.Random(6)
    a, b = prose(rng, 50), prose(rng, 50)
    ids = [None, 5, 5, 5, None, 7]
    df = frame(spark, [a, a, a, b, b, prose(rng, 50)], ids)
    rows = near_duplicates.near_duplicates(df).collect()
    assert len(rows) == 6
    kept = near_duplicates.without_near_duplicates(df).collect()
    assert sorted(r["text"] for r in kept) == sorted({r["text"] for r in df.collect()})
    assert kept[0].asDict().keys() == {"doc_id", "text", "key", "node"}
    empty = frame(spark, [])
    assert near_duplicates.near_duplicates(empty).count() == near_duplicates.without_near_duplicates(empty).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (200, 200), (9, 3)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# ---------------------------------------------------------------- passages

def test_shared_runs_are_found(spark):
    docs = table(spark, SF, "documents")
    rows = passages.repeated_passages(docs).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    hashes, holders = WordHashes(), {}
    for doc, text in texts.items():
        words = hashes(text)
        if len(words) > 50 and len(np.unique(words)) > 20:  # not one line over and over
            for run in set(shingle_hashes(words, 51).tolist()):
                holders.setdefault(run, set()).add(doc)
    want = set().union(*[h for h in holders.values() if len(h) > 1])
    got = {r["doc_id"] for r in rows} | {r["first_doc_id"] for r in rows}
    assert len(want - got) <= 0.01 * len(want)
    for r in rows[:200]:
        a, b = texts[r["first_doc_id"]].lower().split(), texts[r["doc_id"]].lower().split()
        assert r["n_words"] >= 50 and r["end"] - r["start"] == r["n_words"] and r["identity"] >= 0.8
        assert a and b


def test_planted_passages(spark):
    rng = random.Random(8)
    texts = [prose(rng, rng.randrange(60, 200)) for _ in range(30)]
    passage = prose(rng, 70)
    places = {}
    for i in range(5, 15):
        words = texts[i].split()
        at = rng.randrange(len(words))
        places[i] = at
        texts[i] = " ".join(words[:at] + (changed(rng, passage, 4) if i % 2 else passage).split() + words[at:])
    texts += [None, "", "short", texts[0], prose(rng, 20)]
    rows = passages.repeated_passages(frame(spark, texts).repartition(4)).collect()
    assert {r["doc_id"] for r in rows} == {*range(6, 15), 33}
    # the edited copies share some seeds with 5 and others with 6 first
    assert all(r["first_doc_id"] in range(5, r["doc_id"]) for r in rows if r["doc_id"] < 15)
    found = {r["doc_id"]: r for r in sorted(rows, key=lambda r: r["n_words"])}
    assert found[33]["first_doc_id"] == 0 and found[33]["n_words"] == len(texts[0].split())
    for i in range(6, 15):
        assert abs(found[i]["start"] - places[i]) <= 8 and abs(found[i]["end"] - places[i] - 70) <= 8
    assert passages.repeated_passages(frame(spark, [])).count() == 0


@pytest.mark.parametrize("n, edits", [(52, 4), (52, 8), (52, 10), (60, 6), (60, 12), (80, 10), (80, 16), (100, 5)])
def test_edited_passages_are_found(spark, n, edits):
    """Identity 0.8 to 0.95 with evenly spread edits: all have seeds enough, and all are passages."""
    rng, texts = random.Random(n * edits), []
    prose_of = lambda n: [f"v{rng.randrange(20_000)}" for _ in range(n)]
    for _ in range(40):
        passage = prose_of(n)
        edited = list(passage)
        for i in range(edits):
            edited[int((i + 0.5) * n / edits)] += "zz"
        texts += [" ".join(prose_of(40) + p + prose_of(60)) for p in (passage, edited)]
    rows = passages.repeated_passages(frame(spark, texts)).collect()
    assert {(r["first_doc_id"], r["doc_id"]) for r in rows} == {(i, i + 1) for i in range(0, 80, 2)}
    assert all(r["identity"] >= 0.8 and r["n_words"] >= 50 for r in rows)


def phrased(rng, vocabulary, phrases, n):
    """Words of which many stand in phrases that other texts have as well."""
    out = []
    while len(out) < n:
        common = phrases[min(int(rng.paretovariate(0.8)) - 1, len(phrases) - 1)]
        out += common if rng.random() < 0.4 else [rng.choice(vocabulary)]
    return out[:n]


@pytest.mark.parametrize("n", [200, 1600])
def test_passages_are_found_among_common_phrases(spark, n):
    """Whatever the size of the table, though most documents share seeds with many others."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(2000)]
    phrases = [[rng.choice(vocabulary) for _ in range(rng.randrange(3, 7))] for _ in range(1500)]
    texts, planted = [phrased(rng, vocabulary, phrases, 150) for _ in range(n)], {}
    for i in range(n - 100, n):
        at, identity = rng.randrange(90), (1.0, 0.8)[i % 2]
        words = texts[i][at:at + 60]
        for place in rng.sample(range(60), round(60 * (1 - identity))):
            words[place] = rng.choice(vocabulary)
        planted.setdefault(identity, []).append((i, len(texts)))
        texts.append(phrased(rng, vocabulary, phrases, 40) + words + phrased(rng, vocabulary, phrases, 40))
    rows = passages.repeated_passages(frame(spark, [" ".join(t) for t in texts])).collect()
    got = {(r["first_doc_id"], r["doc_id"]) for r in rows}
    assert sum(p in got for p in planted[1.0]) >= 0.98 * len(planted[1.0])
    assert sum(p in got for p in planted[0.8]) >= 0.9 * len(planted[0.8])


def test_an_exact_passage_among_off_diagonal_seeds():
    """Phrases before, in and after the passage draw the chain away from it; its stretch is found all the same."""
    hashes, rng = WordHashes(), random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    phrases = [[rng.choice(vocabulary) for _ in range(rng.randrange(4, 7))] for _ in range(12)]
    for _ in range(60):
        one, words = (phrased(rng, vocabulary, phrases, n) for n in (90, 60))
        two = phrased(rng, vocabulary, phrases, 80)
        found = passages.passages(passages.Seeded(hashes(" ".join(one[:40] + words + one[40:]))),
                                  passages.Seeded(hashes(" ".join(two[:40] + words + two[40:]))))
        assert any(s <= 50 and e >= 90 and identity >= 0.8 for s, e, _, _, identity in found)


def test_frequent_seeds_are_split_and_lose_nothing(spark, monkeypatch):
    """A passage in all documents: each meets an earlier one, all are connected, no seed has all its holders."""
    monkeypatch.setattr(passages, "FREQUENT", 3)
    rng = random.Random(4)
    passage = prose(rng, 60)
    texts = [f"{prose(rng, 30)} {passage} {prose(rng, 30)}" for _ in range(40)]
    hashes = WordHashes()
    seeds = [np.unique(shingle_hashes(hashes(t), passages.SEED), return_index=True) for t in texts]
    rows = passages._split_hot(np.concatenate([s for s, _ in seeds]), np.repeat(np.arange(40), [len(s) for s, _ in seeds]),
                               np.concatenate([p for _, p in seeds]).astype(np.int32))
    sizes = rows.groupby("seed").size()
    hot = set((shingle_hashes(hashes(passage), passages.SEED) & passages._SIX).view(np.int64).tolist())
    assert all(sizes[s] == 3 for s in hot) and set(rows["uid"]) == set(range(40))
    assert all(len(group) == 38 and group["uid"].min() == 0 for seed, group in rows.groupby("seed")
               if len(group) > 3 and seed not in hot)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # long lists of ids are shuffled
    try:
        found = passages.repeated_passages(frame(spark, texts)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["doc_id"] for r in found} == set(range(1, 40))
    assert {i for i in range(1, 40) if (i, 0) in {(r["doc_id"], r["first_doc_id"]) for r in found}} == set(range(1, 40))


def test_all_holders_of_a_seed_that_is_not_frequent_are_met():
    """Up to FREQUENT holders of a seed all pairs meet; of more, those with the same LEAST_WORDS words from it on meet the first such."""
    n = passages.FREQUENT
    seed, uid = np.zeros(n, np.uint64), np.arange(n)[::-1]
    later, place, first = passages.met(seed, uid, uid.astype(np.int32), np.zeros(n, np.uint32))
    assert set(zip(later.tolist(), first.tolist())) == {(i, j) for i in range(n) for j in range(i)} and (place == later).all()
    run = np.zeros(5 * n, np.uint32)
    run[[40, 77, 130]] = 9
    later, place, first = passages.met(np.zeros(5 * n, np.uint64), np.arange(5 * n), np.arange(5 * n, dtype=np.int32), run)
    assert {(a, b) for a, p, b in zip(later.tolist(), place.tolist(), first.tolist()) if p < 0} == {(77, 40), (130, 40)}
    assert set(first[later == 100].tolist()) == {0, 1, 2, 97, 98, 99}


def test_the_very_source_among_holders_of_all_its_seeds_is_met(spark):
    """Two lines that many texts have, one after the other in two of them alone: neither is among the first or the next holders."""
    rng = random.Random(21)
    words = lambda n: [f"v{rng.randrange(50_000)}" for _ in range(n)]
    lines = [words(34) for _ in "ab"]
    texts = [words(20) + lines[i % 2] + words(20) for i in range(240)]
    for i in (101, 150):
        texts[i] = words(20) + lines[0] + lines[1] + words(20)
    rows = passages.repeated_passages(frame(spark, [" ".join(t) for t in texts])).collect()
    assert {(r["first_doc_id"], r["doc_id"]) for r in rows} == {(101, 150)}


def test_a_partner_whose_seeds_a_better_one_holds_is_compared(spark):
    """The better one has them far apart in phrases of its own, the other in one edited passage."""
    rng = random.Random(22)
    words = lambda n: [f"v{rng.randrange(50_000)}" for _ in range(n)]
    passage = words(60)
    edited = [w + "zz" if i % 9 == 4 else w for i, w in enumerate(passage)]
    scattered = [w for at in range(50, -1, -10) for w in [*passage[at:at + 13], *words(15)]]
    texts = [scattered, words(30) + edited + words(30), words(30) + passage + words(30)]
    rows = passages.repeated_passages(frame(spark, [" ".join(t) for t in texts])).collect()
    assert {(r["first_doc_id"], r["doc_id"]) for r in rows} == {(1, 2)}


def test_texts_are_dealt_out_once_wherever_pairs_are_compared(spark, monkeypatch):
    """The last text has all of a passage from 1 and a line of it from 0: that pair counts only if 1 is no better, in whatever
    part it is compared. Copies go with the pairs."""
    rng = random.Random(23)
    words = lambda n: [f"v{rng.randrange(50_000)}" for _ in range(n)]
    texts = []
    for _ in range(12):
        passage = words(90)
        texts += [words(30) + passage[:60] + words(30), words(30) + passage + words(30), passage + words(40)]
    texts = [" ".join(t) for t in [*texts, texts[0], words(60)]]
    calls, compared = [], passages._all_compared
    monkeypatch.setattr(passages, "_all_compared", lambda *x: calls.append(1) or compared(*x))
    found = []
    for together in (4000, 1):
        monkeypatch.setattr(passages, "TOGETHER", together)
        found.append(sorted(map(tuple, passages.repeated_passages(frame(spark, texts)).collect())))
    assert found[0] == found[1] and len(calls) == 2
    assert {x[:2] for x in found[0]} == {(36, 0), *((n + 1, n) for n in range(0, 36, 3)), *((n + 2, n + 1) for n in range(0, 36, 3))}


def test_words_are_hashed_as_they_are_told_apart(monkeypatch):
    texts = ["", " ", "a", "A_b c-d", "\u0130x \u00dfSS \u00df", "\u0915\u093f\u0924\u093e\u092c \u0915", "\U0001d54f\U0001f600x 1\u00b2 \u0663", "\0a\0", "ab ba aab",
             "x" * 300 + " " + "x" * 299 + "y " + "x" * 300, " ".join(WORDS)]
    met = {}
    for block in (passages.BLOCK, 5):
        monkeypatch.setattr(passages, "BLOCK", block)
        for text in texts:
            words, found = words_of(text), passages.word_hashes(text).tolist()
            assert len(words) == len(found)
            assert all(met.setdefault(w, h) == h for w, h in zip(words, found))
    assert len(set(met.values())) == len(met)


def test_words_of_copies_are_those_of_passages(spark):
    """Marks part words, in copies as in other texts."""
    text = " ".join(["\u0915\u093f\u0924\u093e\u092c"] * 30)
    (row,) = passages.repeated_passages(frame(spark, [text, text])).collect()
    assert (row["doc_id"], row["first_doc_id"], row["start"], row["end"], row["n_words"]) == (1, 0, 0, 90, 90) and len(words_of(text)) == 90


def test_a_stretch_of_a_long_chain_is_found():
    """Two texts with shared runs too far apart to be one passage, and one that is a passage by itself."""
    rng, hashes = random.Random(3), WordHashes()
    words = lambda n: [f"v{rng.randrange(20_000)}" for _ in range(n)]
    one, two = words(60), words(8)
    a, b = (passages.Seeded(hashes(" ".join(words(30) + one + words(18) + two + words(20)))) for _ in "ab")
    (found,) = passages.passages(a, b)
    assert found[:4] == (30, 90, 30, 90) and found[4] == 1


def test_chains_equal_plain_dynamic_programming():
    rng = random.Random(11)
    for _ in range(100):
        pairs = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(rng.randrange(1, 25))})
        score = []
        for i, j in pairs:
            before = [s - passages.GAP_COST * (i - a + j - b) for (a, b), s in zip(pairs, score) if a < i and b < j]
            score.append(passages.SEED + max(0.0, max(before, default=0.0)))
        chain = passages.chains(pairs)[0]
        value = passages.SEED * len(chain) - passages.GAP_COST * sum(
            c - a + d - b for (a, b), (c, d) in zip(chain, chain[1:]))
        assert abs(value - max(score)) < 1e-9
        assert all(a < c and b < d for (a, b), (c, d) in zip(chain, chain[1:]))


def edit_table(a, b, free):
    rows = [list(range(len(b) + 1)) if not free else [0] * (len(b) + 1)]
    for i, x in enumerate(a):
        row = [i + 1]
        for j, y in enumerate(b):
            row.append(min(rows[-1][j] + (x != y), rows[-1][j + 1] + 1, row[j] + 1))
        rows.append(row)
    return rows[-1]


def test_distances_equal_tables():
    rng = random.Random(12)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(1, 30))) for _ in "ab")
        assert passages.distance(list(a), list(b)) == edit_table(a, b, False)[-1]
        last = edit_table(a, b, True)
        assert decontamination.nearest(a, b)[0] == min(last)
        if min(last) < len(a):
            assert decontamination.nearest(a, b)[1] == last.index(min(last))
    assert passages.distance([], [1]) == 1


# ---------------------------------------------------------------- decontamination

def test_items_within_the_budget_are_found(spark, monkeypatch):
    rng = random.Random(13)
    items = [prose(rng, rng.randrange(12, 60)) for _ in range(20)] + ["tiny item", "", None]
    texts = [prose(rng, 150) for _ in range(40)]
    for i in range(0, 30):
        item = list(items[i % 20])
        for _ in range(rng.randrange(0, 2 * len(item) // decontamination.EDIT_CHARS)):
            at = rng.randrange(len(item))
            item[at:at + 1] = rng.choice(["", "q", item[at] + "q"])
        texts[i] = texts[i][:200] + " " + "".join(item) + " " + texts[i][200:]
    texts += [None, "", "Tiny  ITEM!", "a tiny item in a text", items[0].upper().replace(" ", " , ")]
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 900)  # several blocks
    df = frame(spark, texts)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    rows = decontamination.contaminations(df, bench).collect()
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in rows}
    want = {}
    for d, text in enumerate(texts):
        folded = decontamination.folded(text or "")
        for i, item in enumerate(items[:20]):
            body = decontamination.folded(item)
            distance = min(edit_table(body, folded, True))
            if distance <= len(body) // decontamination.EDIT_CHARS:
                want[d, i] = distance
    want[42, 20] = 0
    assert got == want and len(want) > 10
    kept = {r["doc_id"] for r in decontamination.clean(df, bench).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in want}
    assert decontamination.contaminations(df, bench.limit(0)).count() == 0
    assert decontamination.contaminations(frame(spark, []), bench).count() == 0


# ---------------------------------------------------------------- pipeline

@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline

    docs, seen = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        seen.append((name, docs, out))
        docs = spark.createDataFrame(out.collect(), out.schema)
    return seen


def test_stages(spark, stages):
    from barwright.llm import toxicity

    columns = stages[0][1].columns
    for name, before, after in stages[:-1]:
        assert after.columns == columns, name
    kept = {name: ({r["doc_id"] for r in before.collect()}, {r["doc_id"] for r in after.collect()})
            for name, before, after in stages}
    assert all(after <= before for before, after in kept.values())
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, SF, "labels").collect()}
    before, after = kept["toxicity"]
    assert all(labels.get(d, 1) for d in before - after) and toxicity.THRESHOLD == 0.7
    name, docs, out = stages[1]
    pdf = docs.toPandas()
    assert kept[name][1] == {min(c) for c in classes_by_hand(list(pdf["doc_id"]), list(pdf["text"]))}
    items = [decontamination.folded(r["text"]) for r in table(spark, SF, "benchmark").collect()]
    for row in stages[2][1].collect():
        if any(i in decontamination.folded(row["text"]) for i in items):
            assert row["doc_id"] not in kept["decontamination"][1]
    assert kept["secrets"][0] == kept["secrets"][1] and kept["pieces"][0] == kept["pieces"][1]
    texts = {r["doc_id"]: r["text"] for r in stages[4][1].collect()}
    assert not any("AKIA" in t for t in texts.values())
    assert all(r["lossless"] and r["n_pieces"] == len(r["ids"]) for r in stages[4][2].collect())


def test_run_is_the_stages_one_after_another(spark, stages):
    import corpus_pipeline

    got = {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {r["doc_id"]: r["ids"] for r in stages[-1][2].collect()}
