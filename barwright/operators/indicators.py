"""Moving averages, RSI and MACD over ordered series.

The definitions are those of the gold table, which differ from the textbook in several ways:

* SMA averages the rows there are; the first n-1 rows are not blank.
* EMA is not recursive. From row n+1 on it blends the value with the *simple* mean that ended on
  the previous row; row n is the simple mean itself; earlier rows are NULL.
* RSI uses simple means of gains and losses, and is 100 where no loss lies in the window.
* The MACD signal has the EMA's shape over the MACD line, and starts at row signal + slow.

Series restart wherever `by` says: the gold table uses symbol and year.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.blocks import Blocks, Series, as_series
from ..schema import EMA_PERIODS, MACD_PERIODS, RSI_PERIODS, SMA_PERIODS, bar_order

# Longest frame that is summed row by row; longer ones are assembled from shorter sums.
_DIRECT_ROWS = 16


class _Stages:
    """Columns grouped by how many window results they build on; each group is one select."""

    def __init__(self, series: Series):
        self.series = series
        self._depth: dict[str, int] = {}
        self._columns: dict[int, list[Column]] = {}

    def add(self, name: str, column: Column, *reads: str, after: int = 0) -> str:
        """Adds `column` once; `reads` are the added columns it is built from."""
        if name not in self._depth:
            depth = 1 + max([after, *(self.depth(r) for r in reads)])
            self._depth[name] = depth
            self._columns.setdefault(depth, []).append(column.alias(name))
        return name

    def depth(self, *names: str) -> int:
        return max(self._depth.get(n, 0) for n in names)

    def frame(self) -> DataFrame:
        df = self.series.frame
        for depth in sorted(self._columns):
            df = df.select("*", *self._columns[depth])
        return df


def _ladder(periods) -> dict[int, int]:
    """For each window length the shorter one its sum is assembled from, or itself.

    A 200-row sum is two 100-row sums 100 rows apart, a 100-row sum two 50-row sums, and so on.
    Sliding windows re-add the whole frame for every row, so this replaces 360 additions per row
    by some ten for lengths 10 to 200. Only additions are used, never differences of running
    totals, so no precision is lost and a sum of zeros stays exactly zero.
    """
    lengths = set(periods)

    def shorter(n):
        return max((m for m in lengths if m < n and n % m == 0 and n // m <= 5), default=None)

    pending = sorted(lengths, reverse=True)
    while pending:
        n = pending.pop()
        if n > _DIRECT_ROWS and shorter(n) is None:
            factor = next((p for p in (2, 3, 5) if n % p == 0), None)
            if factor:
                lengths.add(n // factor)
                pending.append(n // factor)
    return {n: (shorter(n) or n) if n > 1 else 1 for n in sorted(lengths)}


def _rolling_sums(stages: _Stages, label: str, terms: dict[str, Column], periods, *reads,
                  after=0) -> dict[int, dict[str, str]]:
    """Adds sums of each term over the last n rows, for every n; returns their column names."""
    names = {}
    for n, base in _ladder(periods).items():
        names[n] = {}
        for term, column in terms.items():
            name = f"_{label}_{term}_{n}"
            if base == n:
                total = F.coalesce(F.sum(column).over(stages.series.rows(-(n - 1), 0)), F.lit(0))
                names[n][term] = stages.add(name, total, *reads, after=after)
            else:
                part = names[base][term]
                total = F.col(part)
                for k in range(base, n, base):
                    total = total + F.lag(part, k, 0).over(stages.series.spec)
                names[n][term] = stages.add(name, total, part)
    return names


def _means(stages: _Stages, label: str, column: Column, periods, *reads, after=0):
    """Adds means of the non-NULL values among the last n rows; NULL where there are none."""
    terms = {"sum": F.coalesce(column, F.lit(0.0)),
             "count": F.when(column.isNotNull(), 1).otherwise(0)}
    sums = _rolling_sums(stages, label, terms, periods, *reads, after=after)
    return {
        n: stages.add(f"_{label}_mean_{n}",
                      F.try_divide(F.col(sums[n]["sum"]), F.col(sums[n]["count"])),
                      *sums[n].values())
        for n in periods
    }


def _blend(row, first_row: int, value: Column, alpha: float, mean: str, previous: str) -> Column:
    """The EMA shape: NULL, then the mean, then value and previous mean blended."""
    return (
        F.when(row < first_row, F.lit(None).cast("double"))
        .when((row == first_row) | F.col(previous).isNull(), F.col(mean))
        .otherwise(value * F.lit(alpha) + F.col(previous) * F.lit(1 - alpha))
    )


def _add_indicators(stages: _Stages, value: str, sma, ema, rsi, macd) -> list[str]:
    spec = stages.series.spec
    price = F.col(value)
    out = []
    crossing = macd[:2] if macd else ()
    averaged = sorted({*sma, *ema, *crossing})
    means = _means(stages, "price", price, averaged) if averaged else {}
    row = F.col(stages.add("_row", F.row_number().over(spec)))

    for n in sma:
        out.append(stages.add(f"SMA_{n}_{value}", F.col(means[n]), means[n]))

    def previous(n, after=0):
        return stages.add(f"_previous_{n}", F.lag(means[n]).over(spec), means[n], after=after)

    def add_ema(n):
        column = _blend(row, n, price, 2.0 / (n + 1.0), means[n], previous(n))
        return stages.add(f"EMA_{n}_{value}", column, means[n], f"_previous_{n}", "_row")

    # MACD goes first: its signal is the longest chain of windows.
    histogram = []
    if macd:
        fast, slow, signal = macd
        for n in (fast, slow):
            previous(n, after=max(stages.depth(means[m]) for m in (fast, slow)))
        ema_names = [add_ema(n) for n in (fast, slow)]
        line = stages.add(f"MACD_line_{value}",
                          F.col(ema_names[0]) - F.col(ema_names[1]), *ema_names)
        mean = _means(stages, "line", F.col(line), [signal], line, after=stages.depth(line))[signal]
    if ema:
        late = max(stages.depth(means[n]) for n in ema)
        late = max(late, stages.depth(mean)) if macd else late
        for n in ema:
            previous(n, after=late)
    if macd:
        before = stages.add("_previous_line", F.lag(mean).over(spec), mean)
        column = _blend(row, signal + max(fast, slow), F.col(line), 2.0 / (signal + 1.0),
                        mean, before)
        name = stages.add(f"MACD_signal_{value}", column, line, mean, before)
        histogram = [*ema_names, line, name,
                     stages.add(f"MACD_histogram_{value}", F.col(line) - F.col(name), line, name)]
    out += [add_ema(n) for n in ema]

    if rsi:
        change = stages.add("_change", price - F.lag(value).over(spec))
        moves = {"gain": F.when(F.col(change) > 0, F.col(change)).otherwise(0.0),
                 "loss": F.when(F.col(change) < 0, -F.col(change)).otherwise(0.0)}
        sums = _rolling_sums(stages, "moves", moves, rsi, change, after=stages.depth(change))
        for n in rsi:
            rows = F.least(row, F.lit(n))
            gain = F.col(sums[n]["gain"]) / rows
            loss = F.col(sums[n]["loss"]) / rows
            column = F.when(loss == 0, 100.0).otherwise(100 - 100 / (1 + gain / loss))
            out.append(stages.add(f"RSI_{n}_{value}", column, *sums[n].values(), "_row"))
    return list(dict.fromkeys([*out, *histogram]))


def _reach(sma=(), ema=(), rsi=(), macd=None) -> int:
    """How many rows back the latest row's indicators depend on."""
    return max([0, *(n - 1 for n in sma), *ema, *rsi,
                *([macd[2] + max(macd[:2])] if macd else [])])


def add_indicators(df: DataFrame, value="close", *, sma=(), ema=(), rsi=(), macd=None,
                   by=("symbol",), order=None, blocks: Blocks | None = None,
                   crossings=None) -> DataFrame:
    """Adds the chosen indicators of `value` to `df`; see the module text for their meaning.

    All windows share one shuffle and one sort. `blocks`, from `measure_blocks`, cuts series too
    long for one task. `crossings(row_before)` may return further named columns; it is given a
    function that yields an indicator's value on the previous row.
    """
    order = tuple(order or (blocks.order if blocks else bar_order(df.columns)))
    reach = _reach(sma, ema, rsi, macd) + (1 if crossings else 0)
    series = as_series(df, by, order, reads=[value], back=reach, blocks=blocks)
    stages = _Stages(series)
    names = _add_indicators(stages, value, sma, ema, rsi, macd)
    if crossings:
        last = stages.depth(*names)

        def row_before(name):
            return F.col(stages.add(f"_before_{name}", F.lag(name).over(series.spec), name,
                                    after=last))

        for name, column in crossings(row_before).items():
            names.append(stages.add(name, column, after=last + 1))
    return series.own(stages.frame(), [*df.columns, *names])


def sma(df, value="close", periods=SMA_PERIODS, **options) -> DataFrame:
    """Simple moving averages `SMA_<n>_<value>`."""
    return add_indicators(df, value, sma=periods, **options)


def ema(df, value="close", periods=EMA_PERIODS, **options) -> DataFrame:
    """Seeded moving averages `EMA_<n>_<value>`."""
    return add_indicators(df, value, ema=periods, **options)


def rsi(df, value="close", periods=RSI_PERIODS, **options) -> DataFrame:
    """Relative strength `RSI_<n>_<value>`, between 0 and 100."""
    return add_indicators(df, value, rsi=periods, **options)


def macd(df, value="close", fast=MACD_PERIODS[0], slow=MACD_PERIODS[1], signal=MACD_PERIODS[2],
         **options) -> DataFrame:
    """`EMA_<fast>`, `EMA_<slow>`, `MACD_line`, `MACD_signal` and `MACD_histogram`."""
    return add_indicators(df, value, macd=(fast, slow, signal), **options)


def gold(df, value="close", by=("symbol", "year"), **options) -> DataFrame:
    """The full set of 15 indicators, restarting in every year unless `by` says otherwise."""
    return add_indicators(df, value, sma=SMA_PERIODS, ema=EMA_PERIODS, rsi=RSI_PERIODS,
                          macd=MACD_PERIODS, by=by, **options)
