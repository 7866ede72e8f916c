"""Counts per calendar period that close: event time, watermark, late rows.

A period (day, month, ...) is counted under the instant it ends. That instant
carries the watermark, so a calendar month, which is no fixed-length window,
closes like one: when a row of a period that ends ``delay`` later has been
seen. A closed period is written once (append mode) and leaves the state.

Two streams run one after the other in a refresh. The first takes all new
files as one batch and parts them: rows of periods that the batches before
have closed go to a table of late rows, the others to the table that the
second stream reads. The second aggregates under ``withWatermark``; it takes
whole batches of the first, so it never sees a row behind its own watermark.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "cierre"


def period_end(ts: Column | str, unit: str = "month") -> Column:
    """The instant at which the calendar ``unit`` of ``ts`` ends."""
    return (F.date_trunc(unit, F.col(ts) if isinstance(ts, str) else ts) + F.expr(f"INTERVAL 1 {unit}")).cast("timestamp")


def _start(unit: str) -> Column:
    return (F.col(END) - F.expr(f"INTERVAL 1 {unit}")).cast("date")


def _batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    fields = [*schema.fields, T.StructField("batch_id", T.LongType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


class EventTimeCounts:
    """Counts (and sums of ``value``) per period and ``keys`` of the rows that
    land as files in ``source_dir``, kept below ``root`` (shared folder):
    ``closed``, ``late`` and ``open_periods``.

    ``schema`` is the files' schema. Rows without a time never belong to a
    period: they go to the late rows. ``delay`` is an interval such as
    ``35 days``. Each refresh is idempotent: batches write folders of their
    own, a replayed batch its old one; two refreshes must not run at once.
    """

    def __init__(self, spark: SparkSession, source_dir: str, root: str, schema: T.StructType, ts: str, keys: Sequence[str],
                 value: str | None = None, unit: str = "month", delay: str = "35 days", fmt: str = "parquet"):
        self.spark, self.source, self.root, self.fmt = spark, source_dir, root, fmt
        self.ts, self.keys, self.value, self.unit, self.delay = ts, list(keys), value, unit, delay
        self.schema = schema
        self.routed = T.StructType([*schema.fields, T.StructField(END, T.TimestampType())])
        self._mark = T.StructType([T.StructField("mark", T.TimestampType())])
        for name, fields in (("ontime/batch_id=-1", self.routed), ("late/batch_id=-1", self.routed), ("marks/batch_id=-1", self._mark)):
            spark.createDataFrame([], fields).write.mode("overwrite").parquet(f"{root}/{name}")

    def watermark(self, before: int | None = None):
        """The watermark (a timestamp or None) after the batches of the first
        stream with an id below ``before`` (default: all)."""
        marks = _batches(self.spark, f"{self.root}/marks", self._mark)
        if before is not None:
            marks = marks.where(F.col("batch_id") < before)
        return marks.agg((F.max("mark") - F.expr(f"INTERVAL {self.delay}")).alias("w")).first()["w"]

    def _route(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(END, period_end(self.ts, self.unit)).select(*self.routed.names)
        mark = self.watermark(batch_id)
        late = F.col(END).isNull() if mark is None else F.col(END).isNull() | (F.col(END) <= F.lit(mark))
        # the late rows are few: one pass over the batch for each table, nothing cached
        rows.where(~late).write.mode("overwrite").parquet(f"{self.root}/ontime/batch_id={batch_id}")
        rows.where(late).write.mode("overwrite").parquet(f"{self.root}/late/batch_id={batch_id}")
        # late rows end before the watermark, so the rows in time hold the maximum
        taken = self.spark.read.schema(self.routed).parquet(f"{self.root}/ontime/batch_id={batch_id}")
        taken.agg(F.max(END).alias("mark")).where("mark is not null").write.mode("overwrite").parquet(
            f"{self.root}/marks/batch_id={batch_id}")

    def _aggregate(self, rows: DataFrame) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("eventos")]
        if self.value:
            aggs.append(F.sum(self.value).alias("valor_total"))
        return rows.groupBy(END, *self.keys).agg(*aggs)

    def refresh(self) -> dict[str, Any]:
        """Takes in what has landed since the last refresh; returns the
        watermark, the rows left in the state and those the second stream had
        to drop (always 0)."""
        source = self.spark.readStream.schema(self.schema).format(self.fmt).load(self.source)
        q = (source.writeStream.foreachBatch(self._route).option("checkpointLocation", f"{self.root}/checkpoint-route")
             .trigger(availableNow=True).start())
        q.awaitTermination()

        taken = self.spark.readStream.schema(self.routed).parquet(f"{self.root}/ontime")
        counts = self._aggregate(taken.withWatermark(END, self.delay))

        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{self.root}/closed/batch_id={batch_id}")

        q = (counts.writeStream.outputMode("append").foreachBatch(write).trigger(availableNow=True)
             .option("checkpointLocation", f"{self.root}/checkpoint-count").start())
        q.awaitTermination()
        states = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
        return {"watermark": self.watermark(), "state_rows": states[-1]["numRowsTotal"] if states else None,
                "dropped": sum(s["numRowsDroppedByWatermark"] for s in states)}

    def _named(self, counts: DataFrame) -> DataFrame:
        return counts.select(_start(self.unit).alias("periodo"), *[c for c in counts.columns if c not in (END, "batch_id")])

    def closed(self) -> DataFrame:
        """Final counts of the closed periods."""
        shape = self._aggregate(self.spark.createDataFrame([], self.routed)).schema
        self.spark.createDataFrame([], shape).write.mode("overwrite").parquet(f"{self.root}/closed/batch_id=-1")
        return self._named(_batches(self.spark, f"{self.root}/closed", shape))

    def late(self) -> DataFrame:
        """The rows that came after their period had closed, with the batch
        that brought them."""
        return _batches(self.spark, f"{self.root}/late", self.routed)

    def open_periods(self) -> DataFrame:
        """Counts so far of the periods still open."""
        rows, mark = _batches(self.spark, f"{self.root}/ontime", self.routed), self.watermark()
        return self._named(self._aggregate(rows if mark is None else rows.where(F.col(END) > F.lit(mark))))


def arrivals(counts: EventTimeCounts, rows: DataFrame, arrival: str, folders: Sequence[int]) -> list[dict[str, Any]]:
    """Lands ``rows`` refresh by refresh, in the order of their ``arrival``
    number, as files of the source folder; one refresh after each."""
    out = []
    for k in folders:
        rows.where(F.col(arrival) == k).select(*counts.schema.names).write.mode("append").format(counts.fmt).save(counts.source)
        out.append(counts.refresh())
    return out
