"""Running a stream's sink under control: stopping between batches, restarting after
failures, and a stored record of every batch.

The pieces wrap a ``foreachBatch`` function and can be nested:
``gate.guard(recording(write, "/shared/progress", "metric"))``.
"""

from __future__ import annotations

import time
import uuid
from collections import deque
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventflow.sources.files import path_exists
from eventflow.streaming.queries import BACK_TO_BACK, state_partitions_for_start, trigger_kwargs

BatchWriter = Callable[[DataFrame, int], None]

REFUSED = "the gate is closed: not writing batch"


class BatchRefused(Exception):
    """Raised instead of writing a batch while a gate is closed."""


class StopGate:
    """Stops a query between two writes of its sink, in the middle of a backlog too.

    A trigger that follows the last at once leaves no pause to stop in, and stopping inside
    a batch leaves a write behind that the restart repeats.  A closed gate lets the batch
    at work end and refuses the next before its sink has seen it: the query ends there, its
    checkpoint holds all that was written and nothing else, and a restart goes on with
    exactly the refused batch.  ``after`` closes the gate by itself after that many
    batches."""

    def __init__(self, after: int | None = None):
        self.after, self.closed = after, False
        self.written: deque[int] = deque(maxlen=1000)  # ids of the last batches
        self.count = 0

    def guard(self, write: BatchWriter) -> BatchWriter:
        def run(batch_df: DataFrame, batch_id: int) -> None:
            if self.closed:
                raise BatchRefused(f"{REFUSED} {batch_id}")
            write(batch_df, batch_id)
            self.written.append(batch_id)
            self.count += 1
            if self.after is not None and self.count >= self.after:
                self.closed = True

        return run

    def stop(self, query: StreamingQuery, timeout_s: float = 60.0, poll_s: float = 0.1) -> None:
        """Close the gate and end ``query``: it refuses its next batch, or, having none, is
        stopped while idle.  An error of the query's own is raised."""
        self.closed = True
        deadline = time.monotonic() + timeout_s
        while query.isActive and query.status.get("isTriggerActive"):
            if time.monotonic() > deadline:
                raise TimeoutError(f"batch still at work after {timeout_s} s; the gate stays closed")
            time.sleep(poll_s)
        query.stop()
        if (error := query.exception()) is not None and not refused(error):
            raise error


def refused(error: BaseException) -> bool:
    """Whether a query ended because its gate was closed."""
    return REFUSED in str(error)


def run_to_end(query: StreamingQuery) -> bool:
    """Wait for a query; True if it worked off its input, False if a gate ended it.  Any
    other error is raised."""
    try:
        query.awaitTermination()
        return True
    except StreamingQueryException as error:
        if refused(error):
            return False
        raise


def run_with_restarts(start: Callable[[], StreamingQuery], restarts: int = 3, pause_s: float = 0.0,
                      on_failure: Callable[[StreamingQueryException], None] | None = None) -> StreamingQuery:
    """Run a query to its end and start it again from its checkpoint when it fails.

    After ``restarts`` failures in a row without a batch committed in between, the error is
    raised: a batch that always fails does not go round for ever, and one failure a day
    does not add up.  Closed gates are not restarted."""
    left = restarts
    while True:
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException as error:
            if refused(error):
                raise
            if query.lastProgress is not None:  # reported once a batch is committed
                left = restarts
            if left == 0:
                raise
            left -= 1
            if on_failure:
                on_failure(error)
            time.sleep(pause_s)


PROGRESS_SCHEMA = T.StructType([
    T.StructField("rows", T.LongType(), True), T.StructField("first_us", T.LongType(), True), T.StructField("last_us", T.LongType(), True),
    T.StructField("query", T.StringType(), True), T.StructField("batch_id", T.LongType(), True)])


def recording(write: BatchWriter, path: str, query: str, time_col: str | None = None) -> BatchWriter:
    """Store what each batch held: its rows and, with ``time_col``, their first and last
    time.  The numbers are observed while ``write`` works (which must run the batch), so
    the batch is not run again for them.  A repeated batch replaces its own record; one
    that failed leaves none."""

    def run(batch_df: DataFrame, batch_id: int) -> None:
        seen = Observation(f"{query}-{batch_id}-{uuid.uuid4().hex}")
        measures = [F.count(F.lit(1)).alias("rows")]
        if time_col:
            measures += [F.min(F.unix_micros(time_col)).alias("first_us"), F.max(F.unix_micros(time_col)).alias("last_us")]
        write(batch_df.observe(seen, *measures), batch_id)
        got = seen.get
        row = (int(got["rows"]), got.get("first_us"), got.get("last_us"))
        (batch_df.sparkSession.createDataFrame([row], T.StructType(PROGRESS_SCHEMA.fields[:3])).coalesce(1)
         .write.mode("overwrite").parquet(f"{path.rstrip('/')}/query={query}/batch_id={batch_id}"))

    return run


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The records of :func:`recording`: query, batch_id, rows, first_event, last_event."""
    if not path_exists(spark, path):
        rows = spark.createDataFrame([], PROGRESS_SCHEMA)
    else:
        rows = spark.read.schema(PROGRESS_SCHEMA).option("basePath", path).parquet(path)
    return rows.select(
        "query", "batch_id", "rows", F.timestamp_micros("first_us").alias("first_event"), F.timestamp_micros("last_us").alias("last_event"))


def start_batches(df: DataFrame, write: BatchWriter, checkpoint: str, trigger: str | None = None, mode: str = "append",
                  name: str | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Start ``df`` with ``write`` called for every micro-batch."""
    writer = (df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
              .trigger(**(trigger_kwargs(trigger) or BACK_TO_BACK)))
    with state_partitions_for_start(df.sparkSession, state_partitions):
        return writer.start(queryName=name) if name else writer.start()
