"""Ordered windows over series too long for one task.

A window partitioned by symbol puts a whole symbol into one task. When one symbol holds a third of
a large table that task never ends. Every window here has a finite reach (a 200-bar average looks
back 199 rows), so a long series can be cut into consecutive blocks; each block borrows the few
rows before or after it that its first or last windows reach, and the borrowed rows are dropped
afterwards. The result equals the uncut window row for row.

Blocks follow the sort key: a series holding more than `target_rows` rows is cut into spans of 360
days, a span still holding more into 15 days, then days, hours, minutes and so on down to single
microseconds, and finally by the bits of whole-number tie-break columns. Text is cut by ever longer beginnings,
fractions by ever smaller units. Only oversized parents are
cut, and below the first level a cut along times and whole numbers has at most 256 children, so borrowed rows stay below
256 * reach / target_rows of the data (2.6 % for 200 rows of reach).
"""

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import DAY_MICROS, epoch_micros, sort_rank
from .durable import cut

OWN = "_own"
TARGET_ROWS = 2_000_000

# Each width is a whole multiple of the next, so blocks nest.
_WIDTHS_MICROS = (
    360 * DAY_MICROS, 15 * DAY_MICROS, DAY_MICROS, 3_600_000_000, 60_000_000, 1_000_000,
    20_000, 1_000, 20, 1,
)
_ID_SHIFTS = (56, 48, 40, 32, 24, 16, 8, 0)
# How many rungs one measuring pass counts: down to the day, then two at a time.
_FIRST_PASS, _LATER_PASS = 3, 2

# Lengths of the beginnings by which text is grouped; longer texts are told apart by whole.
_PREFIXES = (*range(1, 21), 22, 23, 24, 26, 29, 32, 40, 48, 64, 96, 128, 256, 2**31 - 1)
_FLOAT_POWERS = (12, 9, 6, 4, 2, 0, -2, -4, -6)

_WHOLE = (T.LongType, T.IntegerType, T.ShortType, T.ByteType)
_FRACTIONS = (T.DoubleType, T.FloatType, T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def _rungs(df: DataFrame, order) -> list[Column]:
    """Ever finer groupings of rows, each following the sort key: a row's value never falls along the key."""
    return [F.coalesce(rung, lowest) for rung, lowest in _ladder(df, order)]


def _lowest(df: DataFrame, order) -> list[Column]:
    """For each rung a value at or below all others. Rows without a sort key have it, as they come first in a sort."""
    return [lowest for _, lowest in _ladder(df, order)]


def _ladder(df: DataFrame, order) -> list[tuple[Column, Column]]:
    rungs = []
    for name in order:
        data_type = df.schema[name].dataType
        if isinstance(data_type, _TIMES):
            micros = epoch_micros(name, data_type)
            rungs += [(_floor_div(micros, w), F.lit(-(2**63))) for w in _WIDTHS_MICROS]
        elif isinstance(data_type, _WHOLE):
            wide = F.col(name).cast("bigint")
            rungs += [(F.shiftright(wide, s), F.lit(-(2**63))) for s in _ID_SHIFTS]
        elif isinstance(data_type, T.StringType):
            rungs += [(F.substring(name, 1, n), F.lit("")) for n in _PREFIXES]
        elif isinstance(data_type, _FRACTIONS):
            wide = F.col(name).cast("double")
            rungs += [(F.rint(wide / 10.0**k), F.lit(float("-inf"))) for k in _FLOAT_POWERS]
        else:
            break
    return rungs


def _floor_div(micros: Column, width: int) -> Column:
    """Exact integer division rounding down, also before 1970."""
    w = F.lit(width).cast("bigint")
    return F.call_function("div", micros - F.pmod(micros, w), w)


def _names(depth: int) -> list[str]:
    return [f"_r{i}" for i in range(depth)]


def _join(left: DataFrame, right: DataFrame, by, exact, how="inner") -> DataFrame:
    """Joins on `by`, NULL matching NULL, and on the never missing `exact` columns. Keeps the left
    side's keys."""
    names = {k: f"_on_{i}" for i, k in enumerate([*by, *exact])}
    right = right.select(*[F.col(k).alias(n) for k, n in names.items()],
                         *[c for c in right.columns if c not in names])
    same = [F.col(k).eqNullSafe(F.col(names[k])) for k in by]
    same += [F.col(k) == F.col(names[k]) for k in exact]
    return left.join(right, reduce(lambda a, b: a & b, same), how).drop(*names.values())


@dataclass(frozen=True)
class Blocks:
    """Which series, and which parts of them, are cut.

    `nodes[d]` lists the parts at depth d (0 is a whole series) with too many rows for one task,
    `sizes[d]` is the length of that list. The lists are written tables, whose size Spark knows: a list is sent to
    all executors if it is small and else joined by shuffle.
    """

    by: tuple
    order: tuple
    nodes: tuple = ()
    sizes: tuple = ()
    #: The depths at which a part is split at all; the others need no look.
    levels: tuple = ()

    @property
    def cuts(self) -> bool:
        return bool(self.nodes)

    @property
    def columns(self) -> list[str]:
        """Names of the columns that together identify a block within its series."""
        return [f"_b{d}" for d in self.levels]

    def attach(self, df: DataFrame) -> DataFrame:
        """Adds the block a row belongs to; the lowest value stands for a level that is not cut."""
        ladder = _ladder(df, self.order)
        out = df.select("*", *[F.coalesce(*ladder[d]).alias(f"_r{d}") for d in self.levels])
        for i, d in enumerate(self.levels):
            upper = [f"_r{u}" for u in self.levels[:i]]
            flagged = self.nodes[d].select(*self.by, *upper, F.lit(True).alias(f"_cut{d}"))
            out = _join(out, flagged, self.by, upper, "left")
        parts = [F.when(F.col(f"_cut{d}"), F.col(f"_r{d}")).otherwise(ladder[d][1]).alias(f"_b{d}") for d in self.levels]
        return out.select(*df.columns, *parts, F.col(f"_cut{self.levels[0]}").alias("_cut"))


def measure_blocks(df: DataFrame, by, order, target_rows: int = TARGET_ROWS) -> Blocks:
    """Counts rows per series and finds what must be cut. Runs Spark jobs.

    The first job reads only the `by` columns. Later ones read the sort key too, and only rows of
    series found too long; most tables need none. The counts only steer the cutting: a stale
    or wrong count changes block sizes, never results.
    """
    by, order = tuple(by), tuple(order)
    rungs = _rungs(df, order)
    too_long = df.groupBy(*by).count().where(F.col("count") > target_rows).drop("count")
    if too_long.isEmpty():
        return Blocks(by, order)  # most tables need no cut, and then nothing is written
    if not rungs:
        raise ValueError(f"a series has more than {target_rows} rows, and it cannot be cut along {order[0]!r}")
    series = cut(too_long)
    size = series.count()
    nodes, sizes = [series], [size]
    narrow = df.select(*by, *[r.alias(n) for r, n in zip(rungs, _names(len(rungs)))])
    done, stride, splits = 0, _FIRST_PASS, []
    while done < len(rungs) and sizes[-1]:
        upto = min(done + stride, len(rungs))
        rows = _join(narrow, nodes[-1], by, _names(done))
        counts = rows.groupBy(*by, *_names(upto)).count()
        # Every count adds to its part at each depth; a part of depth d is named by d rungs.
        depth = F.explode(F.sequence(F.lit(done + 1), F.lit(upto)))
        parts = counts.select("*", depth.alias("_depth")).groupBy(
            *by, "_depth",
            *[F.when(F.col("_depth") > i, F.col(n)).alias(n) for i, n in enumerate(_names(upto))]
        ).agg(F.sum("count").alias("n"))
        # Only parts of too long parts can be too long, so the lists stay short.
        counted = cut(parts.withColumn("large", F.col("n") > target_rows).drop("n"))
        large = counted.where("large")
        found = {r["_depth"]: (r["n"], r["large"]) for r in counted.groupBy("_depth").agg(
            F.count("*").alias("n"), F.count_if("large").alias("large")).collect()}
        before = sizes[-1]
        for d in range(done + 1, upto + 1):
            n, many = found.get(d, (0, 0))
            splits.append(n != before)
            before = n
            nodes.append(large.where(F.col("_depth") == d).select(*by, *_names(d)))
            sizes.append(many)
        # a stretch without any split is passed faster
        stride = _LATER_PASS if any(splits[done:]) else 2 * stride
        done = upto
    # The deepest list is empty or has no finer rung left: it cuts nothing.
    while nodes and (sizes[-1] == 0 or len(nodes) > len(rungs)):
        nodes.pop(), sizes.pop()
    levels = tuple(d for d in range(len(nodes)) if splits[d])
    return Blocks(by, order, tuple(nodes), tuple(sizes), levels) if levels else Blocks(by, order)


def _borrowed(keyed: DataFrame, by, block, order, reach: int, later: bool) -> DataFrame:
    """Copies of the rows within `reach` rows before (or, if `later`, after) each block, keyed by
    the block that borrows them.

    Only `reach` rows per block are shuffled, thanks to the ranking limit before it. A block may
    hold fewer than `reach` rows, so a borrower can draw on several blocks; how many follows from
    the block lengths, capped at `reach`.
    """
    keys = [*by, *block]
    # Blocks run towards their borrowers: ascending when lending to later blocks.
    along = [F.col(c).desc() if later else F.col(c).asc() for c in block]
    line = Window.partitionBy(*by).orderBy(*along)
    following = F.lead(F.struct(*block)).over(line).alias("_to")
    if reach == 1:
        # One row per block, lent to the next block: a plain aggregate finds it without sorting.
        pick = F.min_by if later else F.max_by
        lent = [c for c in keyed.columns if c not in keys]
        ranked = keyed.select("*", sort_rank(keyed, order).alias("_rank"))
        edge = ranked.groupBy(*keys).agg(*[pick(c, "_rank").alias(c) for c in lent])
        return edge.select(*lent, *by, following).where(F.col("_to").isNotNull()).select(
            *[F.col(f"_to.{c}") if c in block else F.col(c) for c in keyed.columns])
    towards = [F.col(c).asc() if later else F.col(c).desc() for c in order]
    near = Window.partitionBy(*keys).orderBy(*towards)
    edge = (
        keyed.select("*", F.row_number().over(near).alias("_q")).where(F.col("_q") <= reach)
    )
    ends = (
        keyed.groupBy(*keys).agg(F.least(F.count("*"), F.lit(reach)).alias("_n"))
        .select(
            *keys,
            F.sum("_n").over(line.rowsBetween(Window.unboundedPreceding, 0)).alias("_end"),
            following,
        )
    )
    # Borrowers: the next block, and those after it while fewer than `reach` rows lie between.
    ahead = Window.partitionBy(*by).orderBy("_end").rangeBetween(0, reach - 1)
    lenders = ends.select(
        *keys, "_end",
        F.collect_list(F.struct(F.col("_to"), F.col("_end").alias("_start"))).over(ahead)
        .alias("_borrowers"),
    )
    return (
        _join(edge, lenders, by, block).select("*", F.explode("_borrowers").alias("_b"))
        # In capped lengths, _end - _q + 1 is the row's place in its series and _start that of
        # the last row before the borrowing block.
        .where(F.col("_b._to").isNotNull()
               & (F.col("_b._start") - F.col("_end") + F.col("_q") <= reach))
        .select(*[F.col(f"_b._to.{c}") if c in block else F.col(c) for c in keyed.columns])
    )


@dataclass
class Series:
    """A frame ready for windows: use `spec` for the order and `rows(a, b)` for row frames."""

    frame: DataFrame
    keys: tuple
    order: tuple
    cuts: bool

    @cached_property
    def spec(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    def rows(self, start: int, end: int) -> WindowSpec:
        return self.spec.rowsBetween(start, end)

    def own(self, df: DataFrame, columns) -> DataFrame:
        """The named columns of the rows that were not borrowed."""
        df = df.where(F.col(OWN)) if self.cuts else df
        return df.select(*columns)


def as_series(df: DataFrame, by, order, *, reads, back=0, ahead=0, blocks=None) -> Series:
    """Prepares `df` for windows over `by` in `order` reaching `back` and `ahead` rows.

    `reads` names the columns the windows look at; borrowed rows carry nothing else. Without
    cuts this is `df` itself. With cuts the table moves once, for the window, as without; the
    borrowed rows come from a second, narrow read of the cut series alone.
    """
    by, order = tuple(by), tuple(order)
    if blocks is None or not blocks.cuts:
        return Series(df, by, order, False)
    if set(blocks.by) != set(by) or tuple(blocks.order) != order:
        raise ValueError(f"blocks were measured for {blocks.by} in {blocks.order}")
    keyed = blocks.attach(df)
    frame = keyed.drop("_cut").withColumn(OWN, F.lit(True))
    kept = list(dict.fromkeys([*by, *order, *reads]))
    lending = keyed.where(F.col("_cut")).select(*kept, *blocks.columns)
    for reach, later in ((back, False), (ahead, True)):
        if reach:
            lent = _borrowed(lending, by, blocks.columns, order, reach, later).withColumn(OWN, F.lit(False))
            frame = frame.unionByName(lent, allowMissingColumns=True)
    return Series(frame, (*by, *blocks.columns), order, True)


def numbered(df: DataFrame, by, order, name="row_num", blocks=None) -> DataFrame:
    """Adds the row number within each series; cut series count on from block to block.

    Each block gets one marker row ahead of its own, which carries the rows before the block, so
    that the table is shuffled for the numbering and not again for a join.
    """
    by, order = tuple(by), tuple(order)
    if blocks is None or not blocks.cuts:
        spec = Window.partitionBy(*by).orderBy(*order)
        return df.select("*", F.row_number().over(spec).cast("bigint").alias(name))
    keyed = blocks.attach(df).drop("_cut")
    keys = [*by, *blocks.columns]
    before = Window.partitionBy(*by).orderBy(*blocks.columns).rowsBetween(
        Window.unboundedPreceding, -1)
    markers = keyed.groupBy(*keys).agg(F.count("*").alias("_n")).select(
        *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rows = keyed.withColumn(OWN, F.lit(True)).unionByName(
        markers.withColumn(OWN, F.lit(False)), allowMissingColumns=True)
    spec = Window.partitionBy(*keys).orderBy(OWN, *order)
    sofar = spec.rowsBetween(Window.unboundedPreceding, 0)
    place = F.row_number().over(spec) - 1 + F.max("_start").over(sofar)
    return rows.select("*", place.alias(name)).where(F.col(OWN)).select(*df.columns, name)


def newest_spans(df: DataFrame, by, order, n: int, slack: int = 100_000) -> DataFrame:
    """The rows of every series from a span of the sort key on that leaves at least its latest n
    rows. Runs counting jobs.

    Spans are days at first (the third rung of the key). Where the span that holds the n-th latest
    row has more than `slack` rows, its finer spans are counted, and so on. Each job reads the
    narrow columns alone and aggregates before the shuffle; a series of at most n rows is whole.
    """
    by, order = tuple(by), tuple(order)
    rungs = _rungs(df, order)
    if not rungs:
        return df
    names, least = _names(len(rungs)), _lowest(df, order)
    narrow = df.select(*by, *[r.alias(c) for r, c in zip(rungs, names)])
    # the series whose n-th latest row lies in a span that is still too long, and that span
    wide, finished, done = None, [], 0
    while done < len(rungs):
        upto = min(done + (_LATER_PASS if done else _FIRST_PASS), len(rungs))
        rows = narrow.withColumn("_need", F.lit(n).cast("bigint")) if wide is None else _join(
            narrow, wide.select(*by, *names[:done], "_need"), by, names[:done])
        spans = rows.groupBy(*by, *names[:upto]).agg(F.count("*").alias("_n"), F.max("_need").alias("_need"))
        newer = Window.partitionBy(*by).orderBy(*[F.col(c).desc() for c in names[:upto]])
        sofar = F.sum("_n").over(newer.rowsBetween(Window.unboundedPreceding, 0))
        edge = (spans.withColumn("_sofar", sofar)
                .where((F.col("_sofar") >= F.col("_need")) & (F.col("_sofar") - F.col("_n") < F.col("_need")))
                .withColumn("_need", F.col("_need") - F.col("_sofar") + F.col("_n")))
        edge = cut(edge.select(*by, *names[:upto], "_n", "_need"), "edges")
        more = (F.col("_n") > F.col("_need") + slack) & F.lit(upto < len(rungs))
        finished.append(edge.where(~more).select(
            *by, *[F.col(c).alias(f"_from{i}") if i < upto else least[i].alias(f"_from{i}")
                   for i, c in enumerate(names)]))
        wide, done = edge.where(more), upto
        if wide.isEmpty():
            break
    starts = reduce(DataFrame.unionByName, finished)
    keyed = df.select("*", F.struct(*[r.alias(c) for r, c in zip(rungs, names)]).alias("_at"))
    starts = starts.select(*by, F.struct(*[F.col(f"_from{i}").alias(c) for i, c in enumerate(names)]).alias("_from"))
    joined = _join(keyed, starts, by, [], "left")
    return joined.where(F.col("_from").isNull() | (F.col("_at") >= F.col("_from"))).select(*df.columns)
