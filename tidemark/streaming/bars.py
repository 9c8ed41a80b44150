"""The batch bar and upsert operators on a stream of landed ticks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import WIDTHS
from ..operators.bars import aggregate_trades
from ..sources.sinks import upsert_path


def stream_trade_bars(
    ticks: DataFrame, width: str = "30Min", late: str = "10 minutes", keys: Sequence[str] = ("symbol",),
    ts: str = "ts", seq: str | None = "seq",
) -> DataFrame:
    """Trade bars of a stream; a bar is final once the watermark passes its end.

    Watermarks need TIMESTAMP, so the wall clock is carried as one inside. That is right in session zone UTC only;
    any other zone, which would shift bars at its clock changes, is an error.
    """
    zone = ticks.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone.upper() not in ("UTC", "ETC/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"stream bars need session time zone UTC, not {zone}")
    clock = ticks.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    marked = clock.withColumn("_window", F.window(ts, f"{WIDTHS[width]} seconds"))
    bars = aggregate_trades(marked, [*keys, "_window"], ts, seq)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("first_trade_ts", "last_trade_ts")}
    out = bars.withColumn("bucket", F.col("_window.start").cast("timestamp_ntz")).withColumns(times)
    return out.select(*keys, "bucket", *[c for c in bars.columns if c not in (*keys, "_window")])


def upsert_stream(bars: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partition: str, checkpoint: str) -> StreamingQuery:
    """Upsert every micro-batch, a version each (see ``read_upserted``); replaying a batch after a failure gives the same table."""

    def merge(batch: DataFrame, _batch_id: int) -> None:
        upsert_path(batch.sparkSession, path, batch, keys, order, partition)

    return bars.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(merge).trigger(availableNow=True).start()
