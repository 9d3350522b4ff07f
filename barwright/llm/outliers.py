"""Quality rules: documents whose statistics are outliers of their language and source.

Words are runs of other characters than white space of ASCII. Base statistics of a whole text: its words and their
characters, the signs `#*$%&|<>`, lines with a word that equal an earlier one, and words in runs of five that the text has
more than once. A text with fewer than `LEAST_WORDS` words, or with more than a fifth of its words in such runs, fails
the base rules and takes no part in what follows.

Five transformed statistics (`FEATURES`) of every other text, in whole steps of 1 / `STEPS_A_UNIT`, are compared with robust estimates of
their group: a minimum covariance determinant (MCD). From each of three starts (distances from the medians in units of the spread
between the quartiles, added as squares, added, or the greatest) the `CENTRAL` share nearest rows give mean and covariance, by which the nearest rows
are chosen again, `START_STEPS` times; per group the start with the least determinant goes on for `STEPS` more.
Rows within the 97.5 % quantile of the estimate, made consistent for normal data, give the final one. A text is kept if its squared Mahalanobis distance
from it is at most `CUTOFF`.

A group is a source in a language. With fewer than `LEAST_ROWS` texts that pass the base rules, the estimate of its
language is taken; if that has fewer, that of all texts; if those are fewer, no text is rejected. No variance counts as less than that of
the feature's `FLOORS`, so that a statistic that is the same in most texts does not make the least deviation an outlier.

Only DataFrame functions are used. Texts are read once, into a narrow written table. Every step is one pass over it: rows get
the estimate of their group, and are counted and summed per group and step of distance before anything is shuffled, so a
group with a third of all rows is no longer one for the reducers. Running sums over the steps of distance say where the central share ends (the last step is taken whole).
All sums are of whole numbers, so they do not depend on the order of rows. Estimates are joined to rows from a written table whose size
Spark knows: they are sent to the tasks if they are few, and else joined by shuffle, where adaptive execution splits hot groups.

Nulls: a null text is empty, null languages and sources are ''. Repeated rows are kept and count each time. Empty texts fail the base rules.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.plans.durable import cut

LEAST_WORDS, REPEATED_SHARE, RUN = 10, 20, 5
LEAST_ROWS = 50
CENTRAL, START_STEPS, STEPS = 0.7, 2, 4
CUTOFF = 40.0
STEPS_A_UNIT, LARGEST = 256, 8191
#: Steps of distance, as so many for each factor of e in 1 + the squared distance.
DISTANCE_STEPS = 32
#: The features, and the least standard deviation of each. The base rules allow some repetition, so it has wide ones.
FEATURES = ("log_words", "log_word_length", "symbol_rate", "dup_line_share", "repeat_share")
FLOORS = (0.1, 0.06, 0.05, 0.1, 0.12)
#: Of a chi-square distribution with five degrees of freedom: the 70 % and the 97.5 % quantile; and by what the
#: covariance of the rows within them is less than that of all rows.
_QUANTILES = {"central": 6.0644, "most": 12.8325}
_SHRUNK = {"central": 0.6682, "most": 0.9474}

_N = len(FEATURES)
_PAIRS = [(i, j) for i in range(_N) for j in range(i + 1)]
_SUMS = ["n", *[f"s{i}" for i in range(_N)], *[f"p{i}{j}" for i, j in _PAIRS]]
_ESTIMATE = [*[f"m{i}" for i in range(_N)], *[f"w{i}{j}" for i, j in _PAIRS]]

_SPACE = r"\x20\x09-\x0D"


def _bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """How many words stand in a run of RUN words that occurs twice or more."""
    def covered(starts):
        ahead = F.transform(starts, lambda at, k: F.least(F.coalesce(F.get(starts, k + 1) - at, F.lit(RUN)), F.lit(RUN)))
        return F.aggregate(ahead, F.lit(0), lambda total, n: total + n)

    def repeated(runs):
        same = lambda x, k: F.coalesce(F.get(runs, k)["run"] == x["run"], F.lit(False))
        return F.filter(runs, lambda x, k: same(x, k - 1) | same(x, k + 1))["at"]

    starts = F.sequence(F.lit(1), F.size(words) - (RUN - 1))
    hashes = _bound(F.transform(words, lambda w: F.xxhash64(w)), lambda own: F.transform(
        starts, lambda at: F.xxhash64(*[F.get(own, at + (k - 1)) for k in range(RUN)])))
    # runs in order, so that equal ones stand side by side; texts whose hashes all differ have none
    runs = F.sort_array(F.transform(starts, lambda at: F.struct(
        F.array_join(F.slice(words, at, RUN), " ").alias("run"), at.alias("at"))))
    exact = _bound(F.sort_array(_bound(runs, repeated)), covered)
    some = _bound(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when((F.size(words) > RUN) & some, exact).otherwise(F.lit(0)).cast("bigint")


def base_statistics(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and base_failed of every row."""
    named = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), named(lang, "lang"), named(source, "source"), named(text, "text"))
    rows = rows.select("doc_id", "lang", "source", "text",
                       F.regexp_extract_all("text", F.lit(f"[^{_SPACE}]+"), F.lit(0)).alias("words"),
                       F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{_SPACE}]")).alias("lines"))
    long = lambda c, name: c.cast("bigint").alias(name)
    counted = rows.select(
        "doc_id", "lang", "source", long(F.size("words"), "n_words"), long(F.length(F.array_join("words", "")), "word_chars"),
        long(F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")), "n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"), long(F.size("lines"), "n_lines"))
    return counted.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                              | (100 * F.col("n_repeat_words") > REPEATED_SHARE * F.col("n_words")))


def features() -> list[Column]:
    """The transformed statistics x0, x1, .. in whole steps."""
    words = F.col("n_words").cast("double")
    values = (F.log1p(words), F.log1p(F.col("word_chars") / words), F.sqrt(F.col("n_symbols") / words),
              F.sqrt(F.col("n_dup_lines") / F.col("n_lines")), F.sqrt(F.col("n_repeat_words") / words))
    return [F.least(F.floor(v * STEPS_A_UNIT), F.lit(LARGEST)).cast("bigint").alias(f"x{i}") for i, v in enumerate(values)]


def _groups(rows: DataFrame) -> DataFrame:
    """lang, source, `key` of the estimate for each group (empty if there is none), and the `keys` of all estimates its rows take part in."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    sizes = sizes.select("*", F.sum("n").over(Window.partitionBy("lang")).alias("n_lang"))
    sizes = cut(sizes, "sizes")  # as many rows as groups
    # a language's estimate is wanted if one of its groups is too small, that of all if one of the languages is
    wanted = sizes.groupBy("lang").agg((F.min("n") < LEAST_ROWS).alias("use_lang"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.min("n_lang") < LEAST_ROWS, F.lit(False)).alias("all")).head()
    own = F.to_json(F.struct("lang", "source"))
    whole, everything = F.to_json(F.struct("lang")), F.lit("all")
    enough = lambda n: n >= LEAST_ROWS
    key = (F.when(enough(F.col("n")), own).when(enough(F.col("n_lang")), whole)
           .when(F.lit(enough(total["n"])), everything).otherwise(F.lit("")))
    keys = F.array_compact(F.array(
        F.when(enough(F.col("n")), own), F.when(F.col("use_lang") & enough(F.col("n_lang")), whole),
        F.when(F.lit(total["all"] and enough(total["n"])), everything)))
    return sizes.join(wanted, "lang").select("lang", "source", key.alias("key"), keys.alias("keys"))


def _estimates(sums: DataFrame, within: str, keys) -> DataFrame:
    """Mean, the inverse of the Cholesky factor of the covariance, and the log of its determinant; of rows of sums."""
    n = F.col("n").cast("double")
    names = [*keys, "n"]
    out = sums.select(*names, *[(F.col(f"s{i}") / n).alias(f"m{i}") for i in range(_N)], *[f"p{i}{j}" for i, j in _PAIRS])
    covered = lambda i, j: (F.col(f"p{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) / _SHRUNK[within]
    floor = [(f * STEPS_A_UNIT) ** 2 for f in FLOORS]
    out = out.select(*names, *[f"m{i}" for i in range(_N)], *[
        (covered(i, j) + (F.lit(floor[i]) if i == j else F.lit(0.0))).alias(f"c{i}{j}") for i, j in _PAIRS])
    total = lambda terms: reduce(lambda a, b: a + b, terms, F.lit(0.0))
    for i in range(_N):  # the factor, row by row
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}") - total(F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j))
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(floor[i] / 2))) if i == j else rest / F.col(f"l{j}{j}"))
    for i in range(_N):
        for j in range(i, -1, -1):
            value = F.lit(1.0) if i == j else -total(F.col(f"l{i}{k}") * F.col(f"w{k}{j}") for k in range(j, i))
            out = out.withColumn(f"w{i}{j}", value / F.col(f"l{i}{i}"))
    return out.select(*names, *_ESTIMATE, total(F.log(F.col(f"l{i}{i}")) for i in range(_N)).alias("determinant"))


def _distance() -> Column:
    """Squared Mahalanobis distance of a row joined to its estimate."""
    off = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(_N)]
    along = [reduce(lambda a, b: a + b, (F.col(f"w{i}{j}") * off[j] for j in range(i + 1))) for i in range(_N)]
    return reduce(lambda a, b: a + b, (z * z for z in along))


def _nearest(rows: DataFrame, distance: Column, keys) -> DataFrame:
    """Sums of the CENTRAL share nearest rows of every key."""
    step = F.floor(F.log1p(distance) * DISTANCE_STEPS)
    found = rows.withColumn("step", step).groupBy(*keys, "step").agg(*_sums())
    order = Window.partitionBy(*keys).orderBy("step")
    sofar = found.select(*keys, "step", *[F.sum(c).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias(c) for c in _SUMS],
                         F.sum("n").over(Window.partitionBy(*keys)).alias("all"))
    enough = sofar.where(F.col("n") >= F.ceil(F.col("all") * CENTRAL))
    first = enough.withColumn("nth", F.row_number().over(order)).where("nth = 1")
    return first.select(*keys, *_SUMS)


def _sums() -> list[Column]:
    x = [F.col(f"x{i}") for i in range(_N)]
    return [F.count("*").alias("n"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(x)],
            *[F.sum(x[i] * x[j]).alias(f"p{i}{j}") for i, j in _PAIRS]]


def estimates(rows: DataFrame) -> DataFrame:
    """The MCD estimate of every `key` of rows of key and x0, x1, ..; runs a pass for each step."""
    quartiles = rows.groupBy("key").agg(*[F.percentile(f"x{i}", [0.25, 0.5, 0.75]).alias(f"q{i}") for i in range(_N)])
    quartiles = cut(quartiles, "quartiles")
    off = [F.abs(F.col(f"x{i}") - F.col(f"q{i}")[1]) / F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOORS[i] * STEPS_A_UNIT))
           for i in range(_N)]
    add = lambda terms: reduce(lambda a, b: a + b, terms)
    starts = rows.join(quartiles, "key").select("key", *[f"x{i}" for i in range(_N)], F.posexplode(F.array(
        add([d * d for d in off]), add(off), F.greatest(*off))).alias("start", "away"))
    keys = ["key", "start"]
    found = cut(_estimates(_nearest(starts, F.col("away"), keys), "central", keys), "starts")
    for _ in range(START_STEPS):
        found = cut(_estimates(_nearest(rows.join(found, "key"), _distance(), keys), "central", keys), "starts")
    best = Window.partitionBy("key").orderBy("determinant", "start")
    found = found.withColumn("nth", F.row_number().over(best)).where("nth = 1").drop("nth", "start")
    for _ in range(STEPS):
        found = cut(_estimates(_nearest(rows.join(found.drop("n"), "key"), _distance(), ["key"]), "central", ["key"]), "estimates")
    near = rows.join(found.drop("n"), "key").where(_distance() <= _QUANTILES["most"])
    return cut(_estimates(near.groupBy("key").agg(*_sums()), "most", ["key"]), "estimates")


def outliers(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source",
             cutoff: float = CUTOFF) -> DataFrame:
    """Base statistics of every row, whether it is kept, and its squared distance from its group (NULL if base_failed or none is estimated)."""
    counted = base_statistics(docs, id, text, lang, source)
    passed = ~F.col("base_failed")
    counted = cut(counted.select("*", *[F.when(passed, c).alias(f"x{i}") for i, c in enumerate(features())]), "statistics")
    groups = cut(_groups(counted.where(passed)), "groups")
    rows = counted.where(passed).join(groups, ["lang", "source"]).select(F.explode("keys").alias("key"), *[f"x{i}" for i in range(_N)])
    found = estimates(rows).drop("n", "determinant")
    judged = counted.join(groups.select("lang", "source", "key"), ["lang", "source"], "left").join(found, "key", "left")
    distance = F.when(passed, _distance())
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (passed & F.coalesce(distance <= cutoff, F.lit(True))).alias("kept"), distance.alias("distance"))
