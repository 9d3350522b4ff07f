"""Alerts on a tick stream. The definition is this package's own."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import number, sort_rank
from ..operators.alerts import price_alerts
from ..plans.blocks import TARGET_ROWS, measure_blocks
from ..plans.durable import cut, dropped, removed

_CARRIED = "_carried"


def latest_ticks(ticks: DataFrame, by, order, price) -> DataFrame:
    """The last tick of every series; partly aggregated before it moves."""
    rank = sort_rank(ticks, order)
    return ticks.groupBy(*by).agg(
        *[F.max_by(c, rank).alias(c) for c in dict.fromkeys([*order, price])])


def alerts_after(ticks: DataFrame, carried: DataFrame | None, threshold: float, *, price="price",
                 by=("symbol",), order=("ts",), target_rows=TARGET_ROWS) -> DataFrame:
    """Alerts among `ticks`, the first of each series being compared with the `carried` one.

    Measures the batch, so that a symbol with most of its ticks is cut into several tasks.
    """
    rows = ticks.withColumn(_CARRIED, F.lit(False))
    if carried is not None:
        rows = rows.unionByName(carried.withColumn(_CARRIED, F.lit(True)),
                                allowMissingColumns=True)
    blocks = measure_blocks(rows, by, order, target_rows)
    found = price_alerts(rows, threshold, price=price, by=by, order=order, blocks=blocks)
    return found.where(~F.col(_CARRIED)).drop(_CARRIED)


def start_price_alerts(stream: DataFrame, threshold: float, out: str, state: str,
                       checkpoint: str, *, price="price", by=("symbol",), order=("ts",),
                       trigger=None) -> StreamingQuery:
    """Writes the alerts of micro-batch n to `<out>/batch=<n>`. Starts a query.

    The last tick of every series after batch n is kept in `<state>/batch=<n>`. A batch reads
    only the folder of the one before and overwrites its own, so repeating it after a failure
    gives the same files; folders of earlier batches are removed, and so is what a batch writes
    for itself. Within a batch ticks are put in order; a tick older than the latest one of an
    earlier batch starts without a previous price.
    """

    def write(ticks: DataFrame, batch: int) -> None:
        spark = ticks.sparkSession
        with dropped(spark):
            # Written once, since it is read several times and may not fit into memory.
            ticks = cut(ticks, "ticks")
            carried = spark.read.parquet(f"{state}/batch={batch - 1}") if batch else None
            known = ticks.select(*by, *dict.fromkeys([*order, price]))
            known = known if carried is None else known.unionByName(carried)
            alerts_after(ticks, carried, threshold, price=price, by=by, order=order) \
                .write.mode("overwrite").parquet(f"{out}/batch={batch}")
            latest_ticks(known, by, order, price) \
                .write.mode("overwrite").parquet(f"{state}/batch={batch}")
        if batch > 1:
            removed(spark, f"{state}/batch={batch - 2}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def ordered_alerts(stream: DataFrame, threshold: float, *, price="price", id="event_id", ts="ts", by="symbol",
                   delay="10 minutes") -> DataFrame:
    """Alerts of a tick stream in the order of event times, across micro-batches; a stream.

    Ticks wait in the state of their series until the watermark, `delay` behind the latest time seen, has passed them, and
    are then compared one after another, ties by `id`; the last one stays as the one to compare with. So ticks may
    arrive shuffled within `delay`, and the alerts are those of `price_alerts`; later ones are dropped. A series holds only its ticks of
    the last `delay`. For a series that one task cannot follow `start_price_alerts` cuts each batch instead.
    """
    rows = (stream.select(F.col(by).cast("string").alias("symbol"), F.col(ts).cast("timestamp").alias("ts"),
                          F.col(id).cast("bigint").alias("id"), number(price).alias("price"))
            .where("ts is not null").withWatermark("ts", delay))
    found = rows.groupBy("symbol").applyInPandasWithState(
        _in_order(threshold), "symbol string, ts timestamp, id bigint, price double, previous double, change double",
        "waiting binary, last double", "append", "EventTimeTimeout")
    return found.select(F.col("symbol").alias(by), F.col("ts").alias(ts), F.col("id").alias(id), F.col("price").alias(price), "previous", "change")


def _in_order(threshold: float):
    import numpy as np
    import pandas as pd

    # The ticks that wait are one binary value: an array of numbers is taken apart number by number on its way to Python and back.
    tick = np.dtype([("at", np.int64), ("id", np.int64), ("price", np.float64)])

    def alerts(key, batches, state):
        waiting, last = state.get if state.exists else (b"", None)
        parts = [np.frombuffer(waiting, tick)]
        for pdf in batches:
            part = np.empty(len(pdf), tick)
            part["at"] = pdf["ts"].astype("datetime64[us]").astype("int64")
            part["id"] = pdf["id"].fillna(-(2**63))
            part["price"] = pdf["price"]
            parts.append(part)
        ticks = np.concatenate(parts)
        ticks = ticks[np.lexsort([ticks["id"], ticks["at"]])]
        mark = state.getCurrentWatermarkMs() * 1000
        ready = int(np.searchsorted(ticks["at"], mark, side="right")) if mark > 0 else 0
        if ready:
            done, prices = ticks[:ready], ticks["price"][:ready]
            before = np.r_[np.nan if last is None else last, prices[:-1]]
            with np.errstate(all="ignore"):
                change = np.where(before == 0, np.nan, prices / before - 1)
            hit = np.abs(change) >= threshold
            yield pd.DataFrame({"symbol": key[0], "ts": pd.to_datetime(done["at"][hit], unit="us"), "id": done["id"][hit],
                                "price": prices[hit], "previous": before[hit], "change": change[hit]})
            last = None if np.isnan(prices[-1]) else float(prices[-1])
        state.update((ticks[ready:].tobytes(), last))
        if ready < len(ticks):
            # wakes once the watermark has passed the earliest tick that waits
            state.setTimeoutTimestamp(max(int(ticks["at"][ready]) // 1000 + 1, state.getCurrentWatermarkMs() + 1))

    return alerts
