"""Tumbling bars of ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def build_bars(
    ticks: DataFrame, interval: str = "1 minute", *, ohlc: str = "minmax"
) -> DataFrame:
    """One bar per symbol and window, for a batch or a watermarked stream.

    ``minmax`` takes the lowest price as open and the highest as close.
    ``event_time`` takes the first and the last tick instead.

    Both aggregate before the shuffle, so a symbol with most of the ticks costs
    one row per window and task.
    """
    price, ids = F.col("price"), ["event_id"] if ohlc == "event_time" else []
    open_price, close_price = _open_close(price, ohlc)
    # Flat first: a payload kept whole would keep all columns behind it.
    flat = ticks.select("payload.symbol", "payload.price", "payload.size", "event_time", *ids)
    window = F.window("event_time", interval)
    if ticks.isStreaming:
        # The watermark closes bars by the window as a whole.
        grouped = flat.groupBy("symbol", window.alias("bar"))
        start, end = F.col("bar.start"), F.col("bar.end")
    else:
        # The start alone tells windows apart, in a smaller key.
        grouped = flat.groupBy("symbol", window["start"].alias("bar"))
        start, end = F.col("bar"), F.col("bar") + F.expr(f"INTERVAL {interval}")
    return grouped.agg(
        open_price.alias("open_price"),
        F.max(price).alias("high_price"),
        F.min(price).alias("low_price"),
        close_price.alias("close_price"),
        F.sum("size").alias("volume"),
        F.count(F.lit(1)).alias("tick_count"),
    ).select(
        "symbol",
        start.alias("window_start"),
        end.alias("window_end"),
        "open_price",
        "high_price",
        "low_price",
        "close_price",
        "volume",
        "tick_count",
    )


def _open_close(price: Column, ohlc: str) -> tuple[Column, Column]:
    if ohlc == "minmax":
        return F.min(price), F.max(price)
    if ohlc == "event_time":
        at = F.struct("event_time", "event_id")
        return F.min_by(price, at), F.max_by(price, at)
    raise ValueError(f"ohlc must be 'minmax' or 'event_time', got {ohlc!r}")
