import pytest
from pyspark.sql import functions as F

from barwright import operators as ops

NAN, INF = float("nan"), float("inf")


def column(spark, values):
    rows = [("A", i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, i int, x double").select(
        "symbol", F.timestamp_seconds("i").alias("datetime"), "x")


def filled(df):
    return [r["x"] for r in ops.fill_gaps(df).orderBy("datetime").collect()]


def test_gaps_take_the_mean_of_original_neighbours(spark):
    got = filled(column(spark, [1, None, 3, 4] + [None] * 7 + [12]))
    third = pytest.approx(8 / 3)
    assert got == [1, third, 3, 4, 3.5, 3.5, 4, None, 12, 12, 12, 12]


def test_not_finite_values(spark):
    assert filled(column(spark, [1.0, NAN, INF, 3.0])) == [1, 2, INF, 3]
    assert filled(column(spark, [NAN, NAN])) == [None, None]


def test_other_columns_and_whole_numbers(spark):
    df = spark.createDataFrame(
        [("A", 1, None, "p"), ("A", 2, 4, None)], "symbol string, datetime long, n long, s string")
    out = ops.fill_gaps(df, ["n"]).orderBy("datetime")
    assert [tuple(r) for r in out.collect()] == [("A", 1, 4.0, "p"), ("A", 2, 4.0, None)]
    # Unless named, whole numbers keep their digits: a double holds no more than 2^53 exactly.
    big = df.withColumn("n", F.lit(2**53 + 1).cast("bigint"))
    assert {r["n"] for r in ops.fill_gaps(big).collect()} == {2**53 + 1}
    assert out.schema["n"].dataType.simpleString() == "double"
    assert out.schema["datetime"].dataType.simpleString() == "bigint"


def test_symbols_do_not_mix_but_years_do(spark):
    df = spark.createDataFrame(
        [("A", "2023-12-31", 5.0), ("A", "2024-01-01", None), ("B", "2024-01-01", None)],
        "symbol string, d string, x double").withColumn("datetime", F.to_timestamp("d"))
    got = {(r["symbol"], r["d"]): r["x"] for r in ops.fill_gaps(df).collect()}
    assert got[("A", "2024-01-01")] == 5 and got[("B", "2024-01-01")] is None


def test_profile(spark):
    df = spark.createDataFrame([(1.0, None), (NAN, "b"), (None, "c"), (2.0, "d")],
                               "x double, s string")
    got = {r["column_name"]: tuple(r)[1:] for r in ops.missing_profile(df).collect()}
    assert got == {"x": (2, 50.0, 3), "s": (1, 25.0, 3)}


def test_profile_of_no_rows(spark):
    rows = ops.missing_profile(spark.range(0)).collect()
    assert [tuple(r) for r in rows] == [("id", 0, None, 0)]


def test_conform(spark):
    df = spark.createDataFrame([("btc", "2", NAN, 7)], "coin string, close string, open double, k int")
    out = ops.conform(df.withColumn("datetime", F.current_timestamp()))
    assert out.columns == ["datetime", "symbol", "open", "high", "low", "close", "volume",
                           "coin", "k"]
    row = out.first()
    assert (row["symbol"], row["open"], row["high"], row["close"], row["k"]) == \
        ("BTC", None, None, 2.0, 7)
    assert ops.conform(out, "eth").first()["symbol"] == "BTC"
    assert ops.conform(df.drop("coin").withColumn("datetime", F.lit(None)), "eth") \
        .first()["symbol"] == "ETH"


def test_conform_needs_a_timestamp(spark):
    with pytest.raises(ValueError):
        ops.conform(spark.range(1))


def test_unreadable_numbers_become_null(spark):
    df = spark.createDataFrame([("x",), ("1.5",)], "close string").withColumn(
        "datetime", F.current_timestamp())
    assert {r["close"] for r in ops.conform(df, "a").collect()} == {None, 1.5}


def test_numbers_as_doubles(spark):
    df = spark.createDataFrame([(1, 2, "s")], "a long, b int, c string")
    assert [t for _, t in ops.numbers_as_doubles(df).dtypes] == ["double", "int", "string"]


def test_undated_rows_have_no_year(spark):
    df = spark.createDataFrame([(1, "2021-05-01"), (2, None)], "id int, d string").withColumn(
        "datetime", F.to_timestamp("d"))
    assert [(r["id"], r["year"]) for r in ops.dated(df).collect()] == [(1, 2021)]
    assert [r["id"] for r in ops.undated(df).collect()] == [2]
    assert [r["year"] for r in ops.years(df).collect()] == [2021]
    assert ops.of_year(ops.dated(df), 2020).count() == 0


def test_fill_by_time(spark):
    import random

    rng = random.Random(5)
    rows = [("A" if i % 5 else None, rng.choice([None, 0, 1, 2, 30, 31, 700]) , None if i % 3 == 0 else float(i), i) for i in range(300)]
    rows = [(s, None if d is None else d + rng.random() * 6, x, i) for s, d, x, i in rows]
    df = spark.createDataFrame(rows, "symbol string, at double, x double, id long").withColumn(
        "datetime", F.expr("timestamp'2024-01-01' + make_dt_interval(0, 0, 0, at * 86400)"))
    for chunk in (1, 32):
        got = {r["id"]: r["x"] for r in ops.fill_gaps_within(df, ["x"], days=1.5, spans_a_chunk=chunk).collect()}
        assert len(got) == 300
        exact = {r["id"]: r["m"] for r in df.select("id", F.expr("unix_micros(datetime)").alias("m")).collect()}
        for s, d, x, i in rows:
            near = [y for t, e, y, j in rows if t == s and e is not None and d is not None and y is not None
                    and abs(exact[i] - exact[j]) <= 1.5 * 86400e6]
            want = x if x is not None else sum(near) / len(near) if near else None
            assert got[i] == want if want is None else abs(got[i] - want) < 1e-9
