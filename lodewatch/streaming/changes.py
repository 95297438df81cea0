"""Change detection on a stream of page visits, state by page: a visit's links are compared with the last visit's."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

VISITS = "page_id long, fetched_at timestamp, keys array<string>"


def stream_changes(visits: DataFrame) -> DataFrame:
    """page_id, fetched_at, key: links a page had not at its visit before; the first visit is the baseline.

    A visit is one row with all its keys, so that it replaces the state as a whole; visits of one batch are taken in
    order of time. State is one array of keys a page and lives in the state store.
    """

    def on_page(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = set(state.get[0]) if state.exists else None
        rows = pd.concat(list(frames)).sort_values("fetched_at", kind="stable")
        new = []
        for at, keys in zip(rows["fetched_at"], rows["keys"], strict=True):
            keys = set(keys) if keys is not None else set()
            if last is not None:
                new += [(key[0], at, k) for k in sorted(keys - last)]
            last = keys
        state.update((sorted(last or ()),))
        if new:
            yield pd.DataFrame(new, columns=["page_id", "fetched_at", "key"])

    return visits.groupBy("page_id").applyInPandasWithState(on_page, "page_id long, fetched_at timestamp, key string", "keys array<string>", "append", GroupStateTimeout.NoTimeout)


def batch_changes(visits: DataFrame) -> DataFrame:
    """The same on a table of all visits: each visit against the one before."""
    order = Window.partitionBy("page_id").orderBy("fetched_at", "keys")
    none = F.array().cast("array<string>")
    rows = visits.withColumns({"_now": F.coalesce("keys", none), "_turn": F.row_number().over(order)}).withColumn("_before", F.lag("_now").over(order))
    new = F.array_sort(F.array_except("_now", "_before"))
    return rows.filter("_turn > 1").select("page_id", "fetched_at", F.explode(new).alias("key"))


def daily_fetches(log: DataFrame, watermark: str = "2 days") -> DataFrame:
    """Fetches a day from a stream or a table; the watermark needs a TIMESTAMP, so a zone-less time is cast."""
    timed = log.withColumn("t", F.col("fetched_at").cast("timestamp"))
    timed = timed.withWatermark("t", watermark) if timed.isStreaming else timed
    return timed.groupBy(F.window("t", "1 day").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").cast("date").alias("day"), "n")
