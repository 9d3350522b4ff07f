"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of eight or more characters of keys and tokens with a digit in it, in any
word of a text; a published form of a key, with a digit or without; or what follows a credential's name and a sign,
of whatever characters, up to the closing quote or white space (`password = "correct horse battery"`). Its features are its length, the transitions between its characters, how much of it the dictionary
covers, the path of its document and the words beside it. A random forest, trained from labelled
findings, votes on each; its trees become nested conditions over the features, so that a scan is one projection of the
documents: no shuffle, no Python.

The dictionary is counted over all documents. `labelled_findings` gives findings to learn from where there are none made
by hand, from about `TRAIN_DOCS` documents, chosen by the hash of their id and text; a finding is labelled a secret if it
has the form of a known key, or is assigned to a credential's name and looks random. `planted_findings` adds `PLANTED` findings of each of
some forms of secrets and of what looks like them, set among words of the dictionary; their labels are known, not derived
from the features. So forms that a corpus happens not to hold are learned as well.

`redacted` masks secrets where they stand, and where the same value is a candidate elsewhere in the text.

Nulls: a null text has no candidates; a null path has no directories. Repeated rows and ids are kept, and count once in
training. Without findings of both labels the score is the label there is, or 0. Words of more than `LONG` characters go
on, after each comma or semicolon, as a new word, so the work is linear in the length of a text.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_DOCS = 20_000
DICTIONARY_WORDS = 2_000
LONG = 500
PLANTED = 200
TREES, DEPTH = 15, 5
THRESHOLD = 0.5
MASK = "[SECRET]"

_RUN = r"([A-Za-z0-9_+/.@\-]{8,}={0,2})"
# Forms of keys whose issuers publish them.
_KNOWN = r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|xox[abpr]-[0-9A-Za-z-]{10,}|AIza[0-9A-Za-z_\-]{35})$"
# Names of credentials, of stand-ins, of configuration files.
_NAMES = r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth|bearer)"
_STAND_INS = r"(?i)(?:example|sample|dummy|placeholder|changeme|xxxx|your[_-])"
_CONFIGURATION = r"(?i)\.(?:env|ya?ml|json|ini|cfg|conf|properties|toml|tfvars|pem|key|sh)$"
_TESTS = r"(?i)(?:^|/)(?:tests?|docs?|examples?|fixtures?)(?:/|$)"
# The same forms of keys anywhere in a word.
_KNOWN_RUN = r"(?<![A-Za-z0-9])(" + _KNOWN[1:-1] + r")(?![A-Za-z0-9])"
# A credential's name with the sign after it, and the sign alone; the value goes to the closing quote or white space.
_NAMED = _NAMES + r"[\w\-]{0,40}[\"'`\])]{0,2}"
_ASSIGNED = _NAMED + r"\s{0,3}[=:]{1,2}>?\s{0,3}"
# A word; what stands in quotes behind a credential's name and a sign is one with its white space. Words are told from the
# white space before them, and the two give the text back.
_IN_QUOTES = "|".join(f"{q}[^{q}\\s]*+[^{q}\\S\\n][^{q}\\n]*+{q}" for q in "\"'`")
_LONG_WORD = rf"\S{{1,{LONG}}}+(?!\S)|\S{{1,{LONG}}}[,;]|[^\s,;]*+[,;]|[^\s,;]++"
_WORD = rf"(\s*+)([^\s=:\"'`]{{0,80}}?{_ASSIGNED}(?:{_IN_QUOTES})[^\s\w]{{0,80}}|{_LONG_WORD})"
_SPACE = " \t\n\x0b\f\r"
_EDGES = r"(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"

FEATURES = ("length", "changes", "distinct", "digits", "upper", "hexadecimal", "marks", "covered", "path_depth", "configuration",
            "tests", "named_in_word", "named_before", "assigned", "quoted", "stand_in", "others")


def _share(value: Column, of: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{of}]", "")) / F.length(value)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("double"), F.lit(0.0))


def _parts(text: Column, group: int) -> Column:
    """The words of a text (2), or the white space before each of them (1)."""
    return F.regexp_extract_all(F.rtrim(F.coalesce(text, F.lit("")), F.lit(_SPACE)), F.lit(_WORD), F.lit(group))


def candidates(text: Column, path: Column, dictionary: list[str], by_word: bool = False) -> Column:
    """The candidates of a text: value, word before, place in its word (from 1; 0 for a run that may stand there more than
    once) and features; in the order of the text. Or an array for each word, null where none are looked for."""

    def described(words, i, candidate):
        value, start = candidate["value"], candidate["start"]
        word, one, two = words[i], F.get(words, i - 1), F.get(words, i - 2)
        lead = F.when(start > 0, F.substring(word, F.lit(1), start - 1)).otherwise(
            F.call_function("substring_index", word, value, F.lit(1)))
        pieces = F.filter(F.split(F.lower(value), "[^a-z]+"), lambda p: F.length(p) >= 3)
        covered = F.aggregate(F.filter(pieces, lambda p: p.isin(dictionary)), F.lit(0),
                              lambda total, p: total + F.length(p))
        sign = F.coalesce(one, F.lit("")).rlike("^[=:]+$|[=:]$")
        return F.struct(
            value.alias("value"), F.coalesce(one, F.lit("")).alias("before"), start.alias("start"),
            F.length(value).cast("double").alias("length"),
            ((F.size(F.split(value, _EDGES)) - 1) / F.length(value)).alias("changes"),
            (F.size(F.array_distinct(F.split(value, ""))) / F.length(value)).alias("distinct"),
            _share(value, "0-9").alias("digits"), _share(value, "A-Z").alias("upper"),
            _flag(value.rlike("^[0-9a-fA-F]+$")).alias("hexadecimal"), _share(value, ".@/_+").alias("marks"),
            (covered / F.length(value)).alias("covered"),
            F.coalesce(F.length(F.regexp_replace(path, "[^/]", "")), F.lit(0)).cast("double").alias("path_depth"),
            _flag(path.rlike(_CONFIGURATION)).alias("configuration"), _flag(path.rlike(_TESTS)).alias("tests"),
            _flag(lead.rlike(_NAMES)).alias("named_in_word"),
            _flag(one.rlike(_NAMES) | (sign & two.rlike(_NAMES))).alias("named_before"),
            _flag(lead.rlike("[=:]") | sign).alias("assigned"), _flag(lead.rlike("[\"'`]$")).alias("quoted"),
            _flag(value.rlike(_STAND_INS)).alias("stand_in"),
            _share(value, r"^A-Za-z0-9_+/.@=\-").alias("others"))

    def at(value, start):
        return F.struct(value.alias("value"), start.cast("int").alias("start"))

    def assigned_in(words, i):
        """What the word gives to a credential's name, in it or before it, if it does; an array of one or none."""
        word, one, two = words[i], F.coalesce(F.get(words, i - 1), F.lit("")), F.coalesce(F.get(words, i - 2), F.lit(""))
        follows = one.rlike(_NAMED + "[=:]{1,2}>?$") | one.rlike("^[=:]{1,2}>?$") & two.rlike(_NAMED + "$")
        lead = F.when(word.rlike(_ASSIGNED + r"\S"), F.regexp_extract(word, "(?s)^.*?" + _ASSIGNED + r"(?=\S)", 0)).when(follows, F.lit(""))

        def given(lead):
            rest = F.substring(word, F.length(lead) + 1, F.length(word))
            mark = F.substring(rest, 1, 1)
            quoted = mark.isin("\"", "'", "`")
            inside = F.call_function("substring_index", F.substring(rest, F.lit(2), F.length(rest)), mark, F.lit(1))
            return at(F.when(quoted, inside).otherwise(F.rtrim(rest, F.lit(",;\"'`"))), F.length(lead) + 1 + quoted.cast("int"))

        return F.transform(F.filter(F.array(lead), lambda l: l.isNotNull()), given)

    def values_of(words, i):
        # a run once for each time it stands there, the others only if they are no such run
        runs = F.filter(F.regexp_extract_all(words[i], F.lit(_RUN), F.lit(1)), lambda v: v.rlike("[0-9]"))
        known = F.array_except(F.regexp_extract_all(words[i], F.lit(_KNOWN_RUN), F.lit(1)), runs)
        plain = F.concat(runs, known)
        given = F.filter(assigned_in(words, i), lambda c: (c["value"] != "") & ~F.array_contains(plain, c["value"]))
        return F.concat(F.transform(plain, lambda v: at(v, F.lit(0))), given)

    def of_words(words):
        # words without any of these have no values; it saves the work of looking
        def may_hold(i):
            return ((F.length(words[i]) >= 8) & words[i].rlike("[0-9]") | F.coalesce(F.get(words, i - 1), F.lit("")).rlike("[=:]>?$")
                    | words[i].rlike("[=:]") & words[i].rlike(_ASSIGNED) | (F.length(words[i]) >= 14) & words[i].rlike(_KNOWN_RUN))

        def of_word(i):
            return F.transform(values_of(words, i), lambda c: described(words, i, c))

        places = F.sequence(F.lit(0), F.size(words) - 1)
        if by_word:
            return F.transform(places, lambda i: F.when(may_hold(i), of_word(i)))
        return F.flatten(F.transform(F.filter(places, may_hold), of_word))

    # the words are bound once, as the variable of a function, however often they are used; a text without any has an empty one
    split = _parts(text, 2)
    split = F.when(F.size(split) > 0, split).otherwise(F.array(F.lit("")))
    return F.transform(F.array(split), of_words)[0]


def dictionary_of(docs: DataFrame, text: str = "text") -> list[str]:
    """The words of three letters and more that most documents hold, DICTIONARY_WORDS of them; one job over all documents."""
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{L}]+"))).alias("word"))
    top = (words.where(F.length("word") >= 3).groupBy("word").count()
           .orderBy(F.desc("count"), "word").limit(DICTIONARY_WORDS))
    return [row["word"] for row in top.collect()]


def _some(docs: DataFrame, n: int, id: str, text: str, path: str | None) -> DataFrame:
    """About `n` different documents by the hash of id and text (all of them if there are no more), dealt by that hash."""
    total = docs.count()
    rows = docs.select(F.xxhash64(F.col(id).cast("string"), F.col(text)).alias("h"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                       (F.col(path).cast("string") if path else F.lit(None).cast("string")).alias("path"))
    if total > n:
        rows = rows.where(F.col("h") < -(1 << 63) + (n << 64) // total)
    return rows.groupBy("h").agg(F.min("text").alias("text"), F.min("path").alias("path"))


def labelled_findings(docs: DataFrame, dictionary: list[str], id: str = "doc_id", text: str = "text",
                      path: str | None = None) -> DataFrame:
    """Candidates of about TRAIN_DOCS documents with a label, 1 for a secret."""
    some = _some(docs, TRAIN_DOCS, id, text, path)
    found = some.select(F.explode(candidates(F.col("text"), F.col("path"), dictionary)).alias("c")).select("c.*")
    random = ((F.col("length") >= 12) & (F.col("digits") > 0) & (F.col("digits") < 1) & (F.col("distinct") > 0.2)
              & (F.col("covered") < 0.5) & (F.col("marks") < 0.2) & (F.col("stand_in") == 0))
    # without digits: other signs, or letters of both kinds
    mixed = ((F.col("length") >= 8) & (F.col("distinct") > 0.2) & (F.col("covered") < 0.5) & (F.col("marks") < 0.2) & (F.col("stand_in") == 0)
             & ((F.col("others") > 0) | (F.col("upper") > 0) & (F.col("upper") < 1) & (F.col("changes") > 0.2)))
    named = (F.col("named_in_word") + F.col("named_before") > 0) & (F.col("assigned") > 0)
    return found.withColumn("label", (F.col("value").rlike(_KNOWN) | named & (random | mixed)).cast("double"))


_UPPER, _LOWER, _DIGITS, _HEX = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
_ALNUM = _UPPER + _LOWER + _DIGITS
_NAMED_BY = ("password=", 'token = "', "api_key: ", "secret = '", 'auth_token="', "db_password: ")
_NOT_NAMED = ("", "commit ", "id=", "see ", "sha256: ")
# What may stand before a value, and the value, as texts and (alphabet, least length, greatest length).
SECRET_FORMS = (
    (("",) + _NAMED_BY, ("AKIA", (_UPPER + "234567", 16, 16))), (("",) + _NAMED_BY, ("ghp_", (_ALNUM, 36, 40))),
    (("",) + _NAMED_BY, ("xoxb-", (_DIGITS, 11, 12), "-", (_ALNUM, 24, 24))), (("",) + _NAMED_BY, ("AIza", (_ALNUM + "_-", 35, 35))),
    (_NAMED_BY, ((_HEX, 16, 64),)), (_NAMED_BY, ((_ALNUM, 10, 40),)), (_NAMED_BY, ((_ALNUM + "+/", 30, 60), "=")),
    (_NAMED_BY, ((_ALNUM, 4, 8), ("!#$%&*^", 1, 3), (_ALNUM, 3, 8))))
OTHER_FORMS = (
    (_NOT_NAMED, ((_HEX, 32, 64),)), (_NOT_NAMED, ((_HEX, 8, 8), "-", (_HEX, 4, 4), "-", (_HEX, 4, 4), "-", (_HEX, 12, 12))),
    (_NOT_NAMED, ((_DIGITS, 8, 16),)), (_NOT_NAMED, ("+", (_DIGITS, 2, 2), "-", (_DIGITS, 7, 9))),
    (_NOT_NAMED, ("https://", (_LOWER, 5, 10), ".org/", (_LOWER, 4, 9), "/", (_DIGITS, 4, 8))),
    (_NOT_NAMED, ((_LOWER, 4, 9), (_DIGITS, 1, 3), "@mail.", (_LOWER, 4, 8), ".com")),
    (_NOT_NAMED, ((_LOWER, 4, 8), "_", (_LOWER, 3, 8), "_", (_DIGITS, 2, 6))), (_NOT_NAMED, ((_DIGITS, 1, 3), ".", (_DIGITS, 2, 3), ".", (_DIGITS, 1, 2), "-rc", (_DIGITS, 1, 1))),
    (_NAMED_BY, ("changeme", (_DIGITS, 1, 6))), (_NAMED_BY, ("your_", (_LOWER, 4, 8), (_DIGITS, 1, 3))), (_NAMED_BY, ((_LOWER, 4, 12),)))


def planted_findings(spark, dictionary: list[str]) -> DataFrame:
    """Candidates of texts made of words of the dictionary and one value each, with the label of its form; none without a dictionary."""
    forms = [(form, 1.0) for form in SECRET_FORMS] + [(form, 0.0) for form in OTHER_FORMS]
    words = F.array(*[F.lit(w) for w in dictionary or [""]])
    form_of, drawn = F.col("id") % len(forms), lambda *of: F.abs(F.xxhash64("id", *of))

    def one_of(array, n, salt):
        return F.element_at(array, (drawn(F.lit(salt)) % n + 1).cast("int"))

    def signs(alphabet, least, most, salt):
        places = F.sequence(F.lit(1), (drawn(F.lit(salt)) % (most - least + 1) + least).cast("int"))
        return F.array_join(F.transform(places, lambda j: F.substring(
            F.lit(alphabet), (drawn(F.lit(salt), j) % len(alphabet) + 1).cast("int"), F.lit(1))), "")

    value = lead = label = None
    for n, ((leads, parts), kind) in enumerate(forms):
        made = F.concat(*[F.lit(p) if isinstance(p, str) else signs(*p, 100 * n + i) for i, p in enumerate(parts)])
        before, here = one_of(F.array(*[F.lit(x) for x in leads]), len(leads), -1), form_of == n
        value, lead, label = ((F.when(here, x) if old is None else old.when(here, x))
                              for old, x in ((value, made), (lead, before), (label, F.lit(kind))))
    rows = (spark.range(PLANTED * len(forms) if dictionary else 0)
            .select("id", value.alias("planted"), lead.alias("lead"), label.alias("kind")))
    close = F.when(F.substring("lead", -1, 1).isin("\"", "'"), F.substring("lead", -1, 1)).otherwise("")
    around = [one_of(words, len(dictionary), -salt) for salt in range(2, 8)] if dictionary else [F.lit("")] * 6
    text = F.concat_ws(" ", *around[:3], F.concat("lead", "planted", close), *around[3:])
    found = rows.select("planted", "kind", F.explode(candidates(text, F.lit(None).cast("string"), dictionary)).alias("c"))
    label = F.when(F.col("value") == F.col("planted"), F.col("kind")).otherwise(0.0)
    return found.select("planted", "kind", "c.*").withColumn("label", label).drop("planted", "kind")


class Forest:
    """Trees as conditions over features, and the dictionary that goes with them."""

    def __init__(self, trees: list, dictionary: list[str]):
        self.trees, self.dictionary = trees, dictionary

    def votes(self, candidate: Column) -> Column:
        """The share of trees that take a candidate for a secret."""
        def condition(tree):
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            feature, threshold, low, high = tree
            return F.when(candidate[FEATURES[feature]] <= threshold, condition(low)).otherwise(condition(high))

        total = F.lit(0.0)
        for tree in self.trees:
            total = total + condition(tree)
        return total / F.lit(float(max(1, len(self.trees))))

    def vote(self, features: dict) -> float:
        """The same for one candidate given as a mapping."""
        total = 0.0
        for tree in self.trees:
            while isinstance(tree, tuple):
                feature, threshold, low, high = tree
                tree = low if features[FEATURES[feature]] <= threshold else high
            total += tree
        return total / max(1, len(self.trees))


def _parsed(lines: list[str]):
    """A tree from the text in which Spark describes it."""
    line = lines.pop(0).strip()
    if line.startswith("Predict"):
        return float(line.split(":")[1])
    feature, threshold = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", line).groups()
    low = _parsed(lines)
    lines.pop(0)  # Else
    return int(feature), float(threshold), low, _parsed(lines)


def train(findings: DataFrame, dictionary: list[str], seed: int = 7) -> Forest:
    """A forest from findings with the features of `candidates` and a label; runs Spark's own training."""
    kinds = [row["label"] for row in findings.select("label").distinct().collect()]
    if len(kinds) < 2:
        return Forest([float(k) for k in kinds], dictionary)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(findings)
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, subsamplingRate=0.8,
                                   featureSubsetStrategy="onethird").fit(rows.select("features", "label"))
    trees = [_parsed(tree.toDebugString.rstrip().split("\n")[1:]) for tree in model.trees]
    return Forest(trees, dictionary)


def learn(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> Forest:
    dictionary = dictionary_of(docs, text)
    known = labelled_findings(docs, dictionary, id, text, path).unionByName(planted_findings(docs.sparkSession, dictionary))
    return train(known, dictionary)


def _scored(found: Column, forest: Forest) -> Column:
    return F.transform(found, lambda c: F.struct(c["value"].alias("value"), c["before"].alias("before"),
                                                 c["start"].alias("start"), forest.votes(c).alias("score")))


def findings(docs: DataFrame, forest: Forest, id: str = "doc_id", text: str = "text",
             path: str | None = None) -> DataFrame:
    """doc_id, nth, value, before, score and is_secret of every candidate of every text."""
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    found = candidates(F.col(text), where, forest.dictionary)
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.posexplode(_scored(found, forest)).alias("nth", "c"))
    return rows.select("doc_id", "nth", "c.value", "c.before", "c.score", (F.col("c.score") >= THRESHOLD).alias("is_secret"))


def _masked_word(word: Column, secrets: Column) -> Column:
    """A word without its secrets: first the one at a place of its own, then runs, the longest first."""
    placed = F.filter(secrets, lambda c: c["start"] > 0)
    runs = F.array_distinct(F.transform(F.filter(secrets, lambda c: c["start"] == 0),
                                        lambda c: F.struct((-F.length(c["value"])).alias("n"), c["value"].alias("v"))))

    def without(body, c):
        return F.concat(F.substring(body, F.lit(1), c["start"] - 1), F.lit(MASK),
                        F.substring(body, c["start"] + F.length(c["value"]), F.length(body)))

    def without_run(body, run):
        # it begins and ends as a whole; what ends in = may be followed by anything
        end = F.when(run["v"].endswith("="), F.lit("")).otherwise(F.lit("(?![A-Za-z0-9])"))
        return F.regexp_replace(body, F.concat(F.lit(r"(?<![A-Za-z0-9])\Q"), run["v"], F.lit(r"\E"), end), F.lit(MASK))

    return F.aggregate(F.array_sort(runs), F.aggregate(placed, word, without), without_run)


def redacted(docs: DataFrame, forest: Forest, text: str = "text", path: str | None = None,
             secrets: str = "n_secrets") -> DataFrame:
    """All columns of `docs` with secrets masked in the text, and how many different ones there were."""
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    taken = {c.lower() for c in docs.columns}
    name = next(n for n in (f"_found{i}" for i in range(len(taken) + 1)) if n not in taken)

    def secret_ones(found):
        some = F.filter(found, lambda cs: F.size(cs) > 0)
        values = F.array_distinct(F.transform(F.filter(F.flatten(some), lambda c: c["score"] >= THRESHOLD), lambda c: c["value"]))
        return F.transform(F.array(values), lambda v: F.struct(F.size(v).alias("n"), F.transform(
            found, lambda cs: F.filter(cs, lambda c: F.array_contains(v, c["value"]))).alias("by_word")))[0]

    def masked(words, gaps, found):
        return F.array_join(F.transform(words, lambda word, i: F.concat(
            gaps[i], F.when(F.size(found[i]) > 0, _masked_word(word, found[i])).otherwise(word))), "")

    scored = F.transform(candidates(F.col(text), where, forest.dictionary, by_word=True), lambda cs: _scored(cs, forest))
    rows = docs.withColumn(name, F.transform(F.array(scored), secret_ones)[0])
    body, found = F.col(text), F.col(name)["by_word"]
    tail = F.substring(body, F.length(F.rtrim(body, F.lit(_SPACE))) + 1, F.length(body))
    whole = F.transform(F.array(F.struct(_parts(body, 2).alias("words"), _parts(body, 1).alias("gaps"))),
                        lambda p: F.concat(masked(p["words"], p["gaps"], found), tail))[0]
    return (rows.withColumn(text, F.when(F.col(name)["n"] > 0, whole).otherwise(body))
            .withColumn(secrets, F.col(name)["n"]).drop(name))
