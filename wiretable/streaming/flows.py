"""Flow thinning and scan alerts on streams of packets.

Thinning keeps a packet that comes at least a window after the last kept one of its
flow.  Each flow's state is the last kept time, with an event-time timer that removes
it once the watermark has passed the window, so the state holds open flows only.  A
packet older than one that its flow has already judged cannot be thinned as the batch
does; it is returned as ``late`` and goes to a side table.  Packets behind the watermark
never reach the flow: Spark drops them and counts them in the query's progress.  On
input in order the kept packets are those of the batch operator.  The state processor
is the part that Spark offers only to Python (or Scala) code.

Scan alerts count a source's distinct destination ports per window by mergeable
sketches, with a watermark; only JVM functions are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: 2 ** LG_K registers a sketch; the relative standard error is about 0.83 / sqrt(2 ** LG_K).
LG_K = 12


class FlowThinning(StatefulProcessor):
    """Rows of a flow in time order, with ``fate``: kept, thinned or late."""

    def __init__(self, window_us: int):
        self.window_us = window_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        field = StructType([StructField("kept", LongType()), StructField("seen", LongType())])
        self.last = handle.getValueState("last", field)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["t_us", "packet_id"], kind="stable")
        kept, seen = self.last.get() if self.last.exists() else (None, None)
        fates = []
        for t in batch["t_us"].tolist():
            if seen is not None and t < seen:
                fates.append("late")
            elif kept is None or t - kept >= self.window_us:
                fates.append("kept")
                kept = seen = t
            else:
                fates.append("thinned")
                seen = t
        if kept is not None:
            self.last.update((kept, seen))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            # Event time is in milliseconds: the first one at which a packet would be kept anyway.
            self.handle.registerTimer(-(-(kept + self.window_us) // 1000))
        yield batch.assign(fate=fates).drop(columns=["event_time"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def thinned_stream(packets: DataFrame, key: list[str], window_us: int, delay: str) -> DataFrame:
    """packet_id, key columns, t_us and fate of a stream with packet_id, t_us and the key.

    ``delay`` is how far a packet may be behind the newest before it counts as late.
    Rows without a time have no place in a flow and are left out.
    """
    rows = packets.where("t_us is not null").select("packet_id", "t_us", *key).withColumn("event_time", F.timestamp_micros("t_us"))
    schema = StructType([*rows.drop("event_time").schema.fields]).add("fate", "string")
    # Nulls of a key are equal, as in the batch operator.
    return (rows.withWatermark("event_time", delay).groupBy(*key)
            .transformWithStateInPandas(FlowThinning(window_us), schema, "Append", "EventTime"))


def thin_to_tables(packets: DataFrame, key: list[str], window_us: int, delay: str, sink: str, checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    """Writes kept packets to ``<sink>/kept`` and late ones to ``<sink>/late``, a folder for each batch.

    A batch that runs again overwrites its own folders.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        for fate in ("kept", "late"):
            batch.where(F.col("fate") == fate).drop("fate").write.mode("overwrite").parquet(f"{sink}/{fate}/batch_id={batch_id}")
        batch.unpersist()

    packets.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    writer = (thinned_stream(packets, key, window_us, delay).writeStream.foreachBatch(per_batch)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()


def port_sketches(packets: DataFrame, window: str, delay: str, lg_k: int = LG_K) -> DataFrame:
    """start, src_ip, ports: one sketch of destination ports for each source and window; streaming or batch."""
    rows = packets.where("t_us is not null and src_ip is not null and dst_port_n is not null").select(
        "src_ip", "dst_port_n", F.timestamp_micros("t_us").alias("event_time"))
    if rows.isStreaming:
        rows = rows.withWatermark("event_time", delay)
    return rows.groupBy(F.window("event_time", window), "src_ip").agg(
        F.hll_sketch_agg("dst_port_n", F.lit(lg_k)).alias("ports")).select(F.col("window.start").alias("start"), "src_ip", "ports")


def scan_alerts(sketches: DataFrame, above: int) -> DataFrame:
    """src_ip, ports (estimated, over all windows given): the sources with more distinct ports than ``above``."""
    merged = sketches.groupBy("src_ip").agg(F.hll_sketch_estimate(F.hll_union_agg("ports")).alias("ports"))
    return merged.where(F.col("ports") > above)


def sketch_stream(packets: DataFrame, window: str, delay: str, sink: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Appends each closed window's sketches to ``sink``; ``scan_alerts`` over its rows gives the alerts."""
    writer = (port_sketches(packets, window, delay).writeStream.format("parquet").outputMode("append")
              .option("path", sink).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")).start()
