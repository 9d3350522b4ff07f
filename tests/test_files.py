import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from barwright import operators as ops
from barwright.plans.jobs import bronze_to_silver, silver_to_gold
from barwright.schema import UNDATED_TEXT_SCHEMA
from barwright.sinks import register_tables, write_partitioned
from barwright.sources import (
    count_files, decode_messages, read_bars_csv, read_bars_parquet, typed_bars,
)

HEADER = "datetime,symbol,open,high,low,close,volume"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_tree(spark, tmp_path):
    put(tmp_path / "btc/2021/a.csv", f"{HEADER}\n2021-01-01,X:BTC,1,x,3,4,5\n")
    put(tmp_path / "eth/b.csv", f"{HEADER}\n2021-01-02 00:00:00,X:ETH,1,2,3,4\nnever,X:ETH,,,,,\n")
    put(tmp_path / "eth/notes.txt", "not bars")
    put(tmp_path / "my coin+/year=2021/c.csv", f"{HEADER}\n2021-01-01,X:MY,1,2,3,4,5\n")
    df = typed_bars(read_bars_csv(spark, str(tmp_path)))
    rows = sorted(map(tuple, df.select("coin", "datetime", "high", "close", "volume").collect()),
                  key=str)
    assert rows == [
        ("btc", dt.datetime(2021, 1, 1), None, 4.0, 5.0),
        ("eth", None, None, None, None),
        ("eth", dt.datetime(2021, 1, 2), 2.0, 4.0, None),
        ("my coin+", dt.datetime(2021, 1, 1), 2.0, 4.0, 5.0)]


def test_csv_columns_bind_by_position(spark, tmp_path):
    put(tmp_path / "c/a.csv", "a;b;c;d;e;f\nX:BTC;1;2;3;4;5\n")
    df = read_bars_csv(spark, str(tmp_path), sep=";", schema=UNDATED_TEXT_SCHEMA, coin=False)
    assert [tuple(r) for r in df.collect()] == [("X:BTC", 1.0, 2.0, 3.0, 4.0, 5.0)]


def test_no_file_is_lost(spark, tmp_path):
    """Headers in other spellings, orders and with further columns, none at all, and those that cannot be bound."""
    put(tmp_path / "a/1.csv", f"{HEADER}\n2021-01-01,X:A,1,2,3,4,5\n2021-01-02,X:A,1,2,3,4,5\n")
    put(tmp_path / "a/2.csv", f"{HEADER}\r\n2021-01-03,X:A,1,2,3,4,5\r\n")
    put(tmp_path / "b/capitals.csv", "DateTime,Symbol,Open\n2021-01-01,X:B,1\n")
    put(tmp_path / "b/order.csv", '\ufeff"close", "datetime" ,note\n9,2021-01-02,"a, b"\n')
    put(tmp_path / "c/headless.csv", "2021-01-01,X:C,1,2,3,4,5\n2021-01-02,X:C,1,2,3,4,5\n")
    put(tmp_path / "c/blank.csv", f"\n\n{HEADER}\n2021-01-03,X:C,1,2,3,4,5\n")
    put(tmp_path / "d/empty.csv", "")
    good = read_bars_csv(spark, str(tmp_path), file=True)
    rows = sorted((r["coin"], r["datetime"], r["open"], r["close"], r["note"], r["file"].rsplit("/", 1)[1]) for r in good.collect())
    assert rows == [
        ("a", "2021-01-01", 1.0, 4.0, None, "1.csv"), ("a", "2021-01-02", 1.0, 4.0, None, "1.csv"),
        ("a", "2021-01-03", 1.0, 4.0, None, "2.csv"), ("b", "2021-01-01", 1.0, None, None, "capitals.csv"),
        ("b", "2021-01-02", None, 9.0, "a, b", "order.csv"), ("c", "2021-01-01", 1.0, 4.0, None, "headless.csv"),
        ("c", "2021-01-02", 1.0, 4.0, None, "headless.csv"), ("c", "2021-01-03", 1.0, 4.0, None, "blank.csv")]

    put(tmp_path / "e/foreign.csv", "when,price\n2021-01-01,1\n")
    put(tmp_path / "e/no time.csv", "symbol,close\nX:E,1\nX:E,2\n")
    put(tmp_path / "e/twice.csv", "datetime,close,Close\n2021-01-01,1,2\n")
    with pytest.raises(ValueError, match="cannot be bound") as error:
        read_bars_csv(spark, str(tmp_path))
    assert all(name in str(error.value) for name in ("foreign.csv", "no%20time.csv", "twice.csv"))
    unread = str(tmp_path / "unread")
    assert read_bars_csv(spark, str(tmp_path), unread=unread).count() == len(rows)
    kept = spark.read.parquet(unread).collect()
    assert sorted((r["coin"], r["line"]) for r in kept) == sorted([
        ("e", "when,price"), ("e", "2021-01-01,1"), ("e", "symbol,close"), ("e", "X:E,1"), ("e", "X:E,2"),
        ("e", "datetime,close,Close"), ("e", "2021-01-01,1,2")])
    assert {r["reason"] for r in kept} == {"close named twice", "no column datetime",
                                           "no known column name, and not as many columns as the schema"}


def test_only_unreadable_files(spark, tmp_path):
    put(tmp_path / "in/e/foreign.csv", "when,price\n2021-01-01,1\n")
    unread = str(tmp_path / "unread")
    assert read_bars_csv(spark, str(tmp_path / "in"), unread=unread).count() == 0
    assert spark.read.parquet(unread).count() == 2


def test_profile_by_file(spark, tmp_path):
    put(tmp_path / "in/x/1.csv", f"{HEADER}\n2021-01-01,X:A,1,2,3,,5\n2021-01-02,X:A,1,2,3,4,5\n")
    put(tmp_path / "in/x/2.csv", f"{HEADER}\n2021-01-03,X:A,1,2,3,4,\n")
    bronze_to_silver(spark, str(tmp_path / "in"), str(tmp_path / "silver"), str(tmp_path / "bad"), profile=str(tmp_path / "profile"))
    found = {(r["file"].rsplit("/", 1)[1], r["column_name"]): r["missing"] for r in spark.read.parquet(str(tmp_path / "profile")).collect()}
    assert {k for k, n in found.items() if n} == {("1.csv", "close"), ("2.csv", "volume")}
    assert "file" not in read_bars_parquet(spark, str(tmp_path / "silver")).columns


def test_tables_of_other_threads_stay(spark, tmp_path):
    import threading

    from barwright.plans.durable import cut, dropped

    inside, done, made = threading.Event(), threading.Event(), []

    def other():
        with dropped(spark):
            inside.set()
            done.wait(60)

    thread = threading.Thread(target=other)
    thread.start()
    inside.wait(60)
    made.append(cut(spark.range(5)))
    done.set()
    thread.join()
    assert made[0].count() == 5


def test_missing_folder(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_bars_csv(spark, str(tmp_path / "none"))


def test_messages(spark):
    text = ('~m~1~m~{"m":"x"}\n~m~2~m~{"s1":{"s":[{"i":0,"v":[1609459200.0,1,2,0.5,1.5,10]},'
            '{"i":1,"v":[1609545600.0,1.5,2.5,1,2]}],"ns":{}}}\n'
            '{"s":[{"i":0,"v":[0,9,9,9,9,9]}]}')
    odd = '{"s":[{"i":0,"v":[1609459200.5,"n/a",2e0,1,1,"?"]}]}'
    df = spark.createDataFrame([("A", text), ("B", odd), ("C", "no bars")],
                               "symbol string, message string")
    got = sorted(map(tuple, decode_messages(df).collect()), key=lambda r: (r[1], r[0]))
    assert got == [
        (dt.datetime(2021, 1, 1), "A", 1.0, 2.0, 0.5, 1.5, 10.0),
        (dt.datetime(2021, 1, 2), "A", 1.5, 2.5, 1.0, 2.0, 0.0),
        (dt.datetime(2021, 1, 1, 0, 0, 0, 500000), "B", None, 2.0, 1.0, 1.0, 0.0)]


def daily(spark, days=900):
    return spark.range(days * 2).select(
        F.expr("if(id % 2 = 0, 'btc', 'eth')").alias("coin"),
        F.expr("if(id % 2 = 0, 'X:BTC', 'X:ETH')").alias("symbol"),
        F.expr("timestamp'2021-01-01' + make_dt_interval(int(id div 2))").alias("datetime"),
        *[F.pmod(F.hash("id", F.lit(c)), F.lit(1000)).cast("double").alias(c)
          for c in ("open", "high", "low", "close", "volume")])


def test_overwriting_present_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    bars = ops.dated(daily(spark, 400))
    write_partitioned(bars, path)
    write_partitioned(bars.where("coin = 'btc' and year = 2022").limit(1), path, replace="present")
    left = {(r["coin"], r["year"]): r["count"]
            for r in read_bars_parquet(spark, path).groupBy("coin", "year").count().collect()}
    assert left == {("btc", 2021): 365, ("btc", 2022): 1, ("eth", 2021): 365, ("eth", 2022): 35}
    files = count_files(read_bars_parquet(spark, path), ("coin", "year")).collect()
    assert {r["n_files"] for r in files} == {1}
    pruned = read_bars_parquet(spark, path, coins=["eth"], years=[2021])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 365 and "PartitionFilters: [coin" in plan.replace("isnotnull(", "") \
        .replace("PartitionFilters: [coin#", "PartitionFilters: [coin")


def test_bronze_to_gold(spark, tmp_path):
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    bars = daily(spark).withColumn("close", F.expr("if(volume < 100, null, close)"))
    for coin in ("btc", "eth"):
        rows = bars.where(F.col("coin") == coin).select(
            "datetime", "symbol", "open", "high", "low", "close", "volume").toPandas()
        os.makedirs(f"{bronze}/{coin}")
        rows.to_csv(f"{bronze}/{coin}/{coin}.csv", index=False)
    put(tmp_path / "bronze/eth/bad.csv", f"{HEADER}\n?,X:ETH,1,1,1,1,1\n")
    quarantine = str(tmp_path / "bad")
    bronze_to_silver(spark, bronze, silver, quarantine)
    assert spark.read.parquet(quarantine).count() == 1

    keys = {"by": ("coin", "symbol"), "order": ("datetime",)}
    want = ops.dated(ops.fill_gaps(ops.conform(bars), **keys))
    stored = read_bars_parquet(spark, silver)
    columns = sorted(want.columns)
    assert sorted(map(str, stored.select(columns).collect())) == \
        sorted(map(str, want.select(columns).collect()))

    silver_to_gold(spark, silver, gold)
    result = read_bars_parquet(spark, gold)
    want = ops.gold(want)
    columns = sorted(want.columns)
    assert sorted(map(str, result.select(columns).collect())) == \
        sorted(map(str, want.select(columns).collect()))
    # Long series are cut on the way and give the same tables.
    silver_to_gold(spark, silver, gold + "2", target_rows=100)
    again = read_bars_parquet(spark, gold + "2")
    assert sorted(map(str, again.select(columns).collect())) == \
        sorted(map(str, result.select(columns).collect()))


def test_tables_follow_their_folders(spark, tmp_path):
    path, database = str(tmp_path / "gold"), "bars_catalog_test"
    bars = ops.dated(daily(spark, 400))
    write_partitioned(bars.where("coin = 'btc'"), path)
    assert register_tables(spark, path, database) == ["trade_data_btc"]
    table = f"{database}.trade_data_btc"
    assert spark.table(table).count() == 400

    write_partitioned(bars.where("year = 2022").withColumn("note", F.lit("n")), path,
                      replace="present")
    write_partitioned(daily(spark, 1).withColumn("year", F.lit(2030)), path, replace="present")
    assert register_tables(spark, path, database) == ["trade_data_btc", "trade_data_eth"]
    assert spark.table(table).count() == 401
    assert spark.table(table).where("note = 'n'").count() == 35
    assert spark.table(f"{database}.trade_data_eth").count() == 36

    other = str(tmp_path / "other")
    write_partitioned(bars.where("coin = 'eth'"), other)
    register_tables(spark, other, database)
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert properties["deprecated"] == "true"
    register_tables(spark, path, database)
    properties = {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert "deprecated" not in properties
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_widened_columns_and_many_coins(spark, tmp_path):
    path, database = str(tmp_path / "gold"), "bars_widened_test"
    rows = spark.range(60).selectExpr("concat('c', id % 20) as coin", "cast(2020 + id % 3 as int) as year", "cast(id as int) as n")
    write_partitioned(rows, path)
    assert len(register_tables(spark, path, database)) == 20
    write_partitioned(rows.withColumn("n", F.col("n") + F.lit(2**40)), path)
    register_tables(spark, path, database)
    table = spark.table(f"{database}.trade_data_c3")
    assert table.schema["n"].dataType.simpleString() == "bigint" and table.agg(F.min("n")).first()[0] == 2**40 + 3
    write_partitioned(rows.where("year = 2020").withColumn("n", F.lit("text")), path, replace="present")
    with pytest.raises(Exception, match="(?i)merge"):
        register_tables(spark, path, database)
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_only_changed_partitions_are_updated(spark, tmp_path):
    from barwright.plans.jobs import update_gold

    silver, gold, ledger, full = (str(tmp_path / n) for n in ("silver", "gold", "ledger", "full"))
    bars = ops.dated(daily(spark, 800))
    write_partitioned(bars, silver)
    assert update_gold(spark, silver, gold, ledger) == 6 and update_gold(spark, silver, gold, ledger) == 0
    times = {f: os.stat(f).st_mtime_ns for f in (os.path.join(d, n) for d, _, names in os.walk(gold) for n in names if n.endswith(".parquet"))}
    later = bars.where("coin = 'btc' and year = 2022").unionByName(bars.where("coin = 'btc' and year = 2022").limit(1).withColumn(
        "datetime", F.expr("timestamp'2022-12-31 12:00:00'")))
    write_partitioned(later, silver, replace="present")
    import shutil
    shutil.rmtree(silver + "/coin=eth/year=2023")
    spark.catalog.refreshByPath(silver)
    assert update_gold(spark, silver, gold, ledger) == 2
    after = {f: os.stat(f).st_mtime_ns for f in (os.path.join(d, n) for d, _, names in os.walk(gold) for n in names if n.endswith(".parquet"))}
    assert {os.path.dirname(f) for f in times if after.get(f) != times[f]} == {f"{gold}/coin=btc/year=2022", f"{gold}/coin=eth/year=2023"}
    silver_to_gold(spark, silver, full)
    one, two = (sorted(map(str, read_bars_parquet(spark, p).select(sorted(read_bars_parquet(spark, full).columns)).collect())) for p in (gold, full))
    assert one == two
