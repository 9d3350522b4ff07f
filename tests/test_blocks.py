import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barwright.operators import fill_gaps, last_n_bars, price_alerts
from barwright.plans.blocks import TARGET_ROWS, as_series, measure_blocks, numbered


def neighbours(df, by, order, back, ahead, blocks):
    """The values of all rows within reach, as a list; cut and uncut must agree."""
    series = as_series(df, by, order, reads=["x"], back=back, ahead=ahead, blocks=blocks)
    out = series.frame.withColumn("near", F.collect_list("x").over(series.rows(-back, ahead)))
    return sorted(map(str, series.own(out, [*df.columns, "near"]).collect()))


def bursts(spark, kind="timestamp", tied=False):
    """Unevenly filled series, some short, one of symbol NULL; if `tied`, 450 of all rows share one
    instant."""
    rng = random.Random(7)
    rows, ident = [], 0
    for symbol, count in (("HOT", 900), ("WARM", 120), (None, 90), ("TINY", 3)):
        for i in range(count):
            far = rng.choice([0, 1, 40, 3600, 86400, 86400 * 400]) * rng.randrange(-2, 5)
            at = 0.0 if tied and symbol == "HOT" and i % 2 else far + rng.random()
            rows.append((symbol, at, ident, float(ident)))
            ident += 1
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "symbol string, at double, id long, x double")
    ts = F.timestamp_seconds("at")
    if kind == "timestamp_ntz":
        ts = ts.cast("timestamp_ntz")
    if kind == "date":
        ts = ts.cast("date")
    return df.select("symbol", ts.alias("ts"), "id", "x").cache()


@pytest.mark.parametrize("kind,back,ahead,tied", [
    ("timestamp", 5, 0, True), ("timestamp_ntz", 3, 3, False), ("date", 0, 4, False),
    ("timestamp", 1, 1, False)])
def test_cut_windows_see_the_same_rows(spark, kind, back, ahead, tied):
    df = bursts(spark, kind, tied)
    by, order = ("symbol",), ("ts", "id")
    blocks = measure_blocks(df, by, order, target_rows=60)
    assert blocks.sizes[0] == 3
    # The instant holding 450 rows is cut by the identifier, below the ten levels of time.
    assert not tied or len(blocks.nodes) > 10
    whole = neighbours(df, by, order, back, ahead, None)
    assert neighbours(df, by, order, back, ahead, blocks) == whole


@pytest.mark.parametrize("key", [
    "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')", "substring(md5(string(id)), 1, 3)", "concat(repeat('same beginning ', 30), id % 7)",
    "if(id % 9 = 0, null, (id % 50 - 25) / 7D)", "cast(id % 4 as decimal(10,2))"])
def test_other_sort_keys(spark, key):
    df = bursts(spark).withColumn("at", F.expr(key))
    by, order = ("symbol",), ("at", "id")
    blocks = measure_blocks(df, by, order, target_rows=60)
    assert blocks.sizes[0] == 3
    assert blocks.attach(df).groupBy("symbol", *blocks.columns).count().agg(F.max("count")).first()[0] <= 60
    assert neighbours(df, by, order, 4, 2, blocks) == neighbours(df, by, order, 4, 2, None)
    got = numbered(df, by, order, blocks=blocks)
    assert sorted(map(str, got.collect())) == sorted(map(str, numbered(df, by, order).collect()))
    latest = last_n_bars(df, 70, by=by, order=order)
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("at"), F.desc("id")))).where("n <= 70").drop("n")
    assert sorted(map(str, latest.collect())) == sorted(map(str, want.collect()))


def test_lists_too_long_to_send(spark):
    """Lists of cuts that are joined by shuffle, as they are beyond the session's bound, cut the same way."""
    df, by, order = bursts(spark), ("symbol",), ("ts", "id")
    blocks = measure_blocks(df, by, order, target_rows=60)
    want = neighbours(df, by, order, 3, 1, blocks)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert neighbours(df, by, order, 3, 1, measure_blocks(df, by, order, target_rows=60)) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_blocks_shorter_than_the_reach(spark):
    df = spark.range(200).selectExpr(
        "'A' as symbol", "timestamp_seconds(id * 86400 * 2) as ts", "id", "double(id) as x")
    blocks = measure_blocks(df, ("symbol",), ("ts",), target_rows=3)
    keyed = blocks.attach(df).groupBy("symbol", *blocks.columns).count()
    assert keyed.agg(F.max("count")).first()[0] <= 3
    args = (df, ("symbol",), ("ts",), 10, 7)
    assert neighbours(*args, blocks) == neighbours(*args, None)


def test_missing_timestamps_stay_first(spark):
    df = spark.range(60).selectExpr(
        "'A' as symbol", "if(id % 3 = 0, null, timestamp_seconds(id * 86400)) as ts", "id",
        "double(id) as x")
    blocks = measure_blocks(df, ("symbol",), ("ts", "id"), target_rows=5)
    for reach in ((4, 0), (1, 1)):
        args = (df, ("symbol",), ("ts", "id"), *reach)
        assert neighbours(*args, blocks) == neighbours(*args, None)


def test_nothing_to_cut(spark):
    df = spark.range(5).selectExpr("'A' as symbol", "timestamp_seconds(id) as ts", "1.0 as x")
    blocks = measure_blocks(df, ("symbol",), ("ts",))
    assert not blocks.cuts and TARGET_ROWS > 5
    series = as_series(df, ("symbol",), ("ts",), reads=["x"], back=3, blocks=blocks)
    assert series.frame is df


def test_blocks_of_another_order_are_refused(spark):
    df = spark.range(9).selectExpr("'A' as symbol", "timestamp_seconds(id) as ts", "id as x")
    blocks = measure_blocks(df, ("symbol",), ("ts",), target_rows=2)
    with pytest.raises(ValueError):
        as_series(df, ("symbol",), ("x",), reads=["x"], back=1, blocks=blocks)


def test_stale_counts_change_nothing(spark):
    old = bursts(spark)
    blocks = measure_blocks(old, ("symbol",), ("ts", "id"), target_rows=60)
    new = old.unionByName(old.where("symbol <> 'TINY'").select(
        "symbol", (F.col("ts") + F.expr("INTERVAL 7 HOURS")).alias("ts"),
        (F.col("id") + 10_000).alias("id"), "x"))
    args = (new, ("symbol",), ("ts", "id"), 4, 2)
    assert neighbours(*args, blocks) == neighbours(*args, None)


def test_numbers_count_on(spark):
    df = bursts(spark)
    blocks = measure_blocks(df, ("symbol",), ("ts", "id"), target_rows=60)
    cut = numbered(df, ("symbol",), ("ts", "id"), blocks=blocks)
    whole = df.withColumn("row_num", F.row_number().over(
        Window.partitionBy("symbol").orderBy("ts", "id")).cast("bigint"))
    assert cut.columns == whole.columns
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_operators_agree_when_cut(spark):
    df = bursts(spark).withColumn("price", F.expr("if(id % 5 = 0, null, x % 17)"))
    keys = {"by": ("symbol",), "order": ("ts", "id")}
    blocks = measure_blocks(df, **keys, target_rows=60)
    for op in (lambda b: fill_gaps(df, ["price"], blocks=b, **keys),
               lambda b: price_alerts(df, 0.3, blocks=b, **keys)):
        assert sorted(map(str, op(blocks).collect())) == sorted(map(str, op(None).collect()))


def test_the_table_moves_once(spark, tmp_path):
    """Between the scan of the rows a window returns and the window there is one exchange."""
    path = str(tmp_path / "ticks")
    bursts(spark).write.parquet(path)
    df = spark.read.parquet(path)
    blocks = measure_blocks(df, ("symbol",), ("ts", "id"), target_rows=400)
    series = as_series(df, ("symbol",), ("ts", "id"), reads=["x"], back=1, blocks=blocks)
    lagged = series.own(series.frame.withColumn("p", F.lag("x").over(series.spec)), ["p"])
    for out in (lagged, numbered(df, ("symbol",), ("ts", "id"), blocks=blocks)):
        plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
        first_scan = next(i for i, line in enumerate(plan) if "FileScan" in line)
        union = next(i for i, line in enumerate(plan) if "Union" in line)
        assert sum("Exchange hashpartitioning" in line for line in plan[:union]) == 1
        assert not any("Exchange hashpartitioning" in line or "SortMergeJoin" in line
                       for line in plan[union:first_scan])
