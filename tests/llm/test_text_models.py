"""Pieces, fingerprints, toxicity, token counts and languages against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from barwright.llm import fingerprints, langid, pieces, tokens, toxicity
from barwright.llm.common import fold_of, table, with_neighbours

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "a", "İstanbul ǅ ﬁ 日本語 1234 '' 'S it's I'LL", "x<|endoftext|> y<|startoftext|>",
       "naïve café", "word " * 30_000, "x" * 50_000, "###%%% !!", "tab\there\r\n", "\x1cseparator\x85next"]


def frame(spark, texts, **more):
    rows = [(i, t, *[v[i] for v in more.values()]) for i, t in enumerate(texts)]
    kinds = {"lang": "string", "toxic": "int"}
    extra = "".join(f", {k} {kinds[k]}" for k in more)
    return spark.createDataFrame(rows, f"doc_id bigint, text string{extra}")


def clashing(df):
    """The same with columns named like the operators' own."""
    for name in ("score", "uid", "key", "node", "label", "ids", "decoded", "n_tokens", "place", "_span"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture(scope="module")
def texts(spark):
    return [r["text"] for r in table(spark, SF, "documents").select("text").collect()]


# ---------------------------------------------------------------- pieces

@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def best_by_hand(model, text):
    """The best segmentation by comparing every piece at every place of the whole text."""
    text = model.normalized(text)
    usable = {n: i for i, n in enumerate(model.names)
              if i not in model.odd and i != model.unknown and not model.model.is_unused(i)}
    longest = max(map(len, usable))
    best = [(0.0, None, None)] + [(float("-inf"), None, None)] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            piece = usable.get(text[start:end])
            score = model.model.get_score(piece) if piece is not None else (
                model.unknown_score if end - start == 1 else None)
            if score is not None and best[start][0] + score > best[end][0]:
                best[end] = (best[start][0] + score, start, piece)
    out, at = [], len(text)
    while at:
        _, start, piece = best[at]
        out[:0] = [piece] if piece is not None else [model.bytes[b] for b in text[start:at].encode()]
        at = start
    return out


def test_pieces_equal_search_over_whole_texts(model, texts):
    for text in [*(t[:400] for t in texts[:60]), "", " a  b ", "日本語 text\nnext 😀", "ßüñ"]:
        assert model.encode(text) == best_by_hand(model, text)


def test_pieces_round_trip(model, texts):
    for text in [*texts, *(t for t in ODD if t is not None)]:
        assert model.decode(model.encode(text)) == text


def test_pieces_frame(spark, model):
    got = {r["doc_id"]: r for r in pieces.encoded(
        clashing(frame(spark, ODD)), public_tokenizers.path("piece_bpe_32k.model")).collect()}
    assert len(got) == len(ODD)
    for i, text in enumerate(ODD):
        assert got[i]["ids"] == model.encode(text or "") and got[i]["lossless"]
        assert got[i]["n_pieces"] == len(got[i]["ids"])


# ---------------------------------------------------------------- token counts

def test_token_counts_equal_the_library(spark, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    cases = [*texts, *ODD, texts[0], texts[0]]
    got = {r["doc_id"]: r for r in tokens.token_counts(clashing(frame(spark, cases)), path).collect()}
    for i, text in enumerate(cases):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert got[i]["n_tokens"] == n, repr(text)[:60]
        assert got[i]["n_bytes"] == len((text or "").encode())
        assert got[i]["over_limit"] == (n > 2048)


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert tokens.token_counts(empty, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert pieces.encoded(empty, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert fingerprints.edited_fingerprints(empty).count() == 0
    assert langid.train(frame(spark, [], lang=[])).langs == []
    assert toxicity.learn(frame(spark, [], toxic=[])).weights == {}


# ---------------------------------------------------------------- fingerprints

def generalised_jaccard(a, b):
    a, b = Counter(fingerprints.terms_of(a)), Counter(fingerprints.terms_of(b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collision_rate_is_generalised_jaccard(texts):
    sampler, off = fingerprints.Sampler(), []
    for a, b in zip(texts, texts[1:] + texts[:1]):
        half = a[:len(a) // 2] + b[:len(a) // 2]
        off.append(fingerprints.likeness(sampler.signature(a), sampler.signature(half)) - generalised_jaccard(a, half))
    # 64 coordinates: a standard deviation of at most 1/16 each
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.08


def test_weights_count():
    sampler = fingerprints.Sampler()
    few, many = "a b c d e f g h", "a b c d e f g h " + "a " * 24
    assert fingerprints.likeness(sampler.signature(few), sampler.signature(many)) < 0.5
    assert fingerprints.likeness(sampler.signature(few), sampler.signature(few)) == 1


def test_forgetting_changes_nothing(texts, monkeypatch):
    want = [fingerprints.Sampler().signature(t).tolist() for t in texts[:30]]
    monkeypatch.setattr(fingerprints, "REMEMBERED", 50)
    sampler = fingerprints.Sampler()
    assert [sampler.signature(t).tolist() for t in texts[:30]] == want


@pytest.mark.parametrize("n", [1, 2, 57])
def test_edited_texts(spark, texts, n):
    cases = (ODD + texts)[:n]
    rows = [(7 * i % 1000, t) for i, t in enumerate(cases)]
    random.Random(n).shuffle(rows)
    df = clashing(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(df).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    sampler = fingerprints.Sampler()
    assert len(got) == n
    for (doc, text), (_, after) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        half = len(text) // 2
        edit = text[:len(text) - half] + after[:half]
        row = got[doc]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edit.encode()).hexdigest()
        assert row["fingerprint"] == fingerprints.as_text(sampler.signature(text))
        assert row["edited_fingerprint"] == fingerprints.as_text(sampler.signature(edit))
        assert row["near_next"] == fingerprints.likeness(sampler.signature(text), sampler.signature(after))


def test_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (None, None)], "doc_id bigint, text string")
    assert fingerprints.edited_fingerprints(df).count() == 4


def test_neighbours_equal_a_window(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xyz"), rng.randrange(60), i) for i in range(400)]
    df = spark.createDataFrame(rows, "host string, k int, v int").selectExpr(
        "*", "host || lpad(k, 4, '0') || lpad(v, 4, '0') AS place").repartition(7)
    got = {r["v"]: (r["after"], r["before"]) for r in with_neighbours(
        df, "place", {"after": "v"}, {"before": "v"}, within="host").collect()}
    order = sorted(rows)
    for i, (host, _, v) in enumerate(order):
        after = order[i + 1][2] if i + 1 < len(order) and order[i + 1][0] == host else None
        before = order[i - 1][2] if i and order[i - 1][0] == host else None
        assert got[v] == (after, before)


# ---------------------------------------------------------------- toxicity

TOXIC_ROWS = [(f"das ist ein {w} und {a} so weit", 1) for w in ("grobian", "lump") for a in "abcdefgh"] + [
    (f"das ist ein wort und {a} {b} so weit", 0) for a in "abcdefgh" for b in "ijklmnop"] + [
    (f"das ist ein lumpen sammler und {a} so weit", 0) for a in "abcdefgh"]


@pytest.fixture(scope="module")
def lexicon(spark):
    texts, labels = zip(*TOXIC_ROWS)
    return toxicity.learn(frame(spark, texts, toxic=labels), exceptions=["lump sum"])


def test_lexicon_is_learned(lexicon):
    assert any("lump ".startswith(t) or t == "lump " for t in lexicon.weights)
    assert any("grobian ".startswith(t) for t in lexicon.weights)
    assert lexicon.score("du grobian") > 0.7 > lexicon.score("nette worte") == lexicon.score("")


def test_folding_and_exceptions(lexicon):
    for disguised in ("du GRОBIАN", "du gr0b1an", "du gröbian", "du ｇｒｏｂｉａｎ", "grobian!!"):
        assert lexicon.score(disguised) > 0.7, disguised
    assert lexicon.score("a lump sum of it") < 0.7 < lexicon.score("a lump of it")


def test_longer_texts_score_lower(lexicon):
    assert lexicon.score("du lump") > lexicon.score("du lump " + "wort " * 3000)


def test_automaton_equals_plain_search(lexicon, texts):
    for text in [*texts[:50], "lump lumpen grobian grobiane lump sum xlump"]:
        words, found, at = toxicity.folded(text), {}, 0
        for word in words.split():
            weights = [w for t, w in lexicon.weights.items() if (word + " ").startswith(t)]
            if weights:
                found[at] = max(weights)
            at += len(word) + 1
        plain = toxicity.Lexicon(lexicon.weights)
        assert plain.hits(words) == found


def test_toxicity_frame(spark, lexicon):
    got = toxicity.toxicity(clashing(frame(spark, ODD)), lexicon).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_held_out_toxicity(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    learned = toxicity.learn(toxicity.training_rows(docs, labels))
    rows = toxicity.toxicity(docs, learned).where(fold_of(3) == 1).join(labels, "doc_id")
    seen = Counter((r["toxic"], r["predicted"]) for r in rows.select("toxic", "predicted").collect())
    assert seen[1, 1] >= 0.9 * (seen[1, 0] + seen[1, 1])
    assert seen[0, 1] <= 0.01 * (seen[0, 0] + seen[0, 1])


# ---------------------------------------------------------------- languages

def test_held_out_languages(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    model = langid.train(docs.where(~langid.held_out()))
    rows = langid.identify(docs, model).where(langid.held_out()).join(docs.select("doc_id", "lang"), "doc_id")
    right = [r["lang"] == r["lang_pred"] for r in rows.select("lang", "lang_pred").collect()]
    assert np.mean(right) > 0.97


def test_training_counts_equal_plain_counts(spark, texts):
    langs = ["a" if i % 3 else "b" for i in range(len(texts))]
    got = langid.train(frame(spark, texts, lang=langs).repartition(4))
    counts = np.zeros((2, langid.BUCKETS))
    for text, lang in zip(texts, langs):
        np.add.at(counts[0 if lang == "a" else 1], langid.grams(text), 1)
    assert np.allclose(got.weights, langid.Model(["a", "b"], counts).weights)


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 12])
def test_codewords_differ(n):
    code = langid.codewords(n)
    agree = (code @ code.T - code.shape[1] * np.eye(n)).max()
    assert agree < code.shape[1] * (0.5 if n > 2 else 1)
    assert all(0 < (bit > 0).sum() < n for bit in code.T)


def test_odd_languages(spark):
    df = clashing(frame(spark, ["hola que tal", "the cat sat", "", None, "123 !!"], lang=["es", "en", "es", None, "en"]))
    model = langid.train(df)
    got = [(r["lang_pred"], r["score"]) for r in langid.identify(df, model).orderBy("doc_id").collect()]
    assert [g[0] for g in got] == ["es", "en", "und", "und", "und"]
    one = langid.Model(["en"], np.ones((1, langid.BUCKETS)))
    assert one.predict("anything") == ("en", 1.0, False)
    none = langid.Model([], np.zeros((0, langid.BUCKETS)))
    assert none.predict("anything")[0] == "und"


def test_ambiguity_is_flagged(spark):
    texts = ["alpha beta gamma delta " * 5, "uno dos tres cuatro " * 5]
    model = langid.train(frame(spark, texts, lang=["x", "y"]))
    assert not model.predict("alpha beta gamma delta alpha beta")[2]
    assert model.predict("zzz")[2]
