"""Bouts of fishing while the fleet is at sea: reports in any order, bouts numbered and judged once nothing can join them.

State is a trip's reports that may still gain a neighbour, and the number of its next bout; an event-time timer closes a bout when the watermark has
passed its last report by the gap. Reports behind the watermark are dropped, by Spark. Steps, turns, metrics and the verdict are the batch plan's own
functions (plans.vms), run on the bouts that a micro-batch closes, so a stream that misses nothing gives what the batch gives.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pelagia.plans import vms

#: What a candidate report carries.
COLUMNS = ["zarpe_id", "ord", "location_datetime", "latitude", "longitude", "heading", "speed_kt"]
_ROWS = "zarpe_id long, ord long, location_datetime timestamp, latitude double, longitude double, heading double, speed_kt double"


def _packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.Table.from_pandas(rows, preserve_index=False)
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _open(gap_seconds: float):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, kept = state.get if state.exists else (0, b"")
        new = list(batches)
        before = pa.ipc.open_stream(kept).read_pandas() if kept else pd.DataFrame(columns=COLUMNS)
        fresh = pd.concat(new)[COLUMNS] if new else pd.DataFrame(columns=COLUMNS)
        parts = [p for p in (before, fresh) if len(p)]
        rows = pd.concat(parts).sort_values(["location_datetime", "ord"], ignore_index=True) if parts else before
        at = rows["location_datetime"]
        session = (at.diff() > pd.Timedelta(seconds=gap_seconds)).cumsum() if len(rows) else pd.Series(dtype="int64")
        mark, gap_ms = state.getCurrentWatermarkMs(), round(gap_seconds * 1000)
        last = at.groupby(session).transform("max").astype("datetime64[ms]").astype("int64") if len(rows) else pd.Series(dtype="int64")
        over = last + gap_ms < mark
        closed, still = rows[over], rows[~over]
        if len(closed):
            yield closed.assign(bout=number + session[over], closed=True)
            number += int(session[over].max()) + 1
        ids = set(still["ord"])
        waiting = fresh[fresh["ord"].isin(ids)]
        if len(waiting):
            yield waiting.assign(bout=pd.array([None] * len(waiting), dtype="Int64"), closed=False)
        state.update((number, _packed(still) if len(still) else b""))
        if len(still):
            state.setTimeoutTimestamp(max(int(last[~over].min()) + gap_ms + 1, mark + 1))

    return run


def labelled(candidates: DataFrame, late: str = "2 days", gap_seconds: float = vms.GAP_SECONDS) -> DataFrame:
    """Every candidate report twice: when it comes (closed false, no bout yet) unless its bout is over by then, and when its bout closes, with the bout's number."""
    rows = candidates.select(*COLUMNS).withWatermark("location_datetime", late)
    return rows.groupBy("zarpe_id").applyInPandasWithState(_open(gap_seconds), f"{_ROWS}, bout long, closed boolean", "number long, rows binary", "append", GroupStateTimeout.EventTimeTimeout)


def judge_to(candidates: DataFrame, target: str, checkpoint: str, late: str = "2 days", gap_seconds: float = vms.GAP_SECONDS, trigger: dict | None = None) -> StreamingQuery:
    """Writes open reports as candidates to target/open, and bouts that have closed with their metrics and verdict to target/bouts.

    A micro-batch has a folder of its own in both, replaced if it is run again.
    """

    def judge(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        waiting = batch.where(~F.col("closed")).drop("bout", "closed").withColumn("behavior", F.lit(vms.CANDIDATE))
        waiting.write.mode("overwrite").parquet(f"{target}/open/batch={number}")
        done = batch.where("closed")
        first = done.groupBy(F.col("zarpe_id").alias("__trip")).agg(F.min("bout").alias("__first"))
        metrics = vms.bout_metrics(vms.bouts(done.drop("bout", "closed"), gap_seconds=gap_seconds))  # numbered from 0 within the micro-batch
        metrics = metrics.join(first, F.col("zarpe_id").eqNullSafe(F.col("__trip"))).withColumn("bout", (F.col("bout") + F.col("__first")).cast("long")).drop("__trip", "__first")
        metrics.write.mode("overwrite").parquet(f"{target}/bouts/batch={number}")
        batch.unpersist()

    writer = labelled(candidates, late, gap_seconds).writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
