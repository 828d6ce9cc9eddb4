"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over
the whole synthetic tables (adapted by ``sources.fixtures``)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventflow.functions.messages import envelopes_from_raw, message_json, normalize_rows, parse_envelopes
from eventflow.functions.time import ms_to_instant
from eventflow.operators import funnel as fn
from eventflow.operators import insights as ins
from eventflow.operators import live
from eventflow.operators.windows import events_per_window, with_event_ts
from eventflow.plans.batch import BatchResult, load_csv_results, load_parquet_results, run_batch_job
from eventflow.plans.dashboard import batch_view, dataset_coverage, live_view, load_metric_table, load_stream_metric
from eventflow.plans.present import utc_wall_clock
from eventflow.plans.producer import append_slices, read_events_text, read_events_text_stream
from eventflow.schemas import MESSAGE_SCHEMA, METRIC_SCHEMA, RAW_COLUMNS
from eventflow.session import scratch_path
from eventflow.sinks.files import write_csv, write_parquet
from eventflow.sources.files import read_archive, read_events_csv
from eventflow.sources.fixtures import EVENT_NAMES, adapt_events, read_fixture_events, table_path
from eventflow.streaming import queries as sq
from eventflow.streaming.control import StopGate, read_progress, recording, run_to_end, run_with_restarts, start_batches
from eventflow.streaming.outbox import rejected_rows, start_publish
from eventflow.streaming.snapshots import day_snapshot_writer, read_day_snapshot, start_day_snapshot
from eventflow.streaming.sources import read_envelope_stream, read_message_files

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_fixture_events(spark, sf_dir)


def _metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 1-minute metric on static input: the same operator the stream runs."""
    return events_per_window(with_event_ts(_raw(spark, sf_dir)))


def q_top_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ins.top_items(_raw(spark, sf_dir))


def q_event_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ins.event_distribution(_raw(spark, sf_dir))


def q_event_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ins.event_share(_raw(spark, sf_dir))


def q_daily_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ins.daily_visitors(_raw(spark, sf_dir))


def q_total_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ins.total_events(_raw(spark, sf_dir))


def q_derive_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc_wall_clock(ins.enrich(_raw(spark, sf_dir)).select("timestamp", "event_time", "event_date"))


def q_dataset_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc_wall_clock(ins.coverage(_raw(spark, sf_dir), source="parquet"))


def q_dataset_coverage_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ins.coverage_labels(ins.coverage(_raw(spark, sf_dir), source="parquet"))


def q_batch_date_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ins.date_window(ins.daily_visitors(_raw(spark, sf_dir)))


def q_batch_date_window_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ins.date_window_labels(ins.date_window(ins.daily_visitors(_raw(spark, sf_dir))))


def q_events_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc_wall_clock(_metric(spark, sf_dir))


def q_live_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc_wall_clock(live.kpis(_metric(spark, sf_dir)))


def q_latest_window_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc_wall_clock(live.latest_breakdown(_metric(spark, sf_dir)))


def q_last_n_windows_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc_wall_clock(live.last_n_wide(_metric(spark, sf_dir), types=EVENT_NAMES, other=None))


def q_last_n_windows_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc_wall_clock(live.last_n_long(_metric(spark, sf_dir)))


def _odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows whose event names no column could have: a dot and a number, names that
    differ in case only, the name of another column, an empty one, and many of them."""
    rows = adapt_events(spark.read.parquet(table_path(sf_dir, "events")), "event_id")
    names = F.array(F.concat(F.lit("page."), F.col("event"), F.col("event_id") % 500), F.initcap("event"), F.col("event"),
                    F.lit("window_start"), F.lit("other"), F.lit("a `quoted` name"), F.lit(""))
    return rows.withColumn("event", F.element_at(names, (F.col("event_id") % 7 + 1).cast("int"))).drop("event_id")


def q_last_n_windows_odd_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 60 windows for any event names: types are data, never columns."""
    metric = events_per_window(with_event_ts(_odd_names(spark, sf_dir)))
    return utc_wall_clock(live.last_n_long(metric))


def q_last_n_windows_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide view as maps: what its rows hold, as text."""
    metric = events_per_window(with_event_ts(_odd_names(spark, sf_dir)))
    counts = F.array_sort(F.map_entries("counts"))
    return utc_wall_clock(live.last_n_maps(metric).select(
        "window_start", F.size("counts").alias("n_types"),
        F.array_join(F.transform(counts, lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("counts")))


def q_event_totals_from_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.event_totals(_metric(spark, sf_dir))


def q_live_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display text of the live KPIs and of the funnel's rates."""
    view = live_view(_metric(spark, sf_dir))
    rows = view["kpi_labels"].unionByName(view["funnel_labels"], allowMissingColumns=True)
    return rows.groupBy().agg(*[F.max(c).alias(c) for c in rows.columns])


def q_funnel_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.funnel(_metric(spark, sf_dir), "event_count")


def q_funnel_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fn.funnel(ins.event_distribution(_raw(spark, sf_dir)), "count")


# --- message codec -------------------------------------------------------------


def q_normalize_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as text (what a CSV reader hands the producer) -> normalised messages."""
    text = _raw(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])
    return normalize_rows(text).drop("ingest_time")


def q_to_json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = envelopes_from_raw(_raw(spark, sf_dir))
    return env.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def q_parse_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_envelopes(envelopes_from_raw(_raw(spark, sf_dir)))
    return utc_wall_clock(parsed.select(*RAW_COLUMNS, "kafka_ts", "event_ts"))


def q_json_message_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written as JSON lines (as another producer would drop them), read
    back through the message-file source and parsed."""
    path = scratch_path(spark, "messages")
    messages = normalize_rows(_raw(spark, sf_dir), ingest_time=ms_to_instant("timestamp"))
    messages.select(message_json(messages).alias("value")).write.text(path)
    parsed = parse_envelopes(read_message_files(spark, path, streaming=False))
    return utc_wall_clock(parsed.select(*RAW_COLUMNS, "event_time", "event_ts"))


# --- CSV / parquet round trips through the batch job -----------------------------


def _raw_as_csv(spark: SparkSession, sf_dir: str) -> str:
    """The adapted clickstream written as a raw events CSV folder (shared scratch),
    the input the batch job and the CSV reader are run on."""
    path = scratch_path(spark, "raw-csv")
    write_csv(_raw(spark, sf_dir), path)
    return path


def _batch_job(spark: SparkSession, sf_dir: str) -> tuple[BatchResult, str]:
    out = scratch_path(spark, "batch-job")
    res = run_batch_job(spark, [_raw_as_csv(spark, sf_dir)], f"{out}/parquet", f"{out}/csv", input_format="csv")
    return res, f"{out}/csv"


def q_csv_scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_events_csv(spark, _raw_as_csv(spark, sf_dir))
    return raw.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count("timestamp").alias("n_timestamps"),
        F.count_distinct("visitorid").alias("n_visitors"),
        F.count("transactionid").alias("n_transactionids"),
    )


def q_csv_roundtrip_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, csv_dir = _batch_job(spark, sf_dir)
    return batch_view(spark, csv_dir)["top_items"]


def q_csv_roundtrip_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, csv_dir = _batch_job(spark, sf_dir)
    return batch_view(spark, csv_dir)["daily_visitors"]


def q_dashboard_batch_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch funnel as the dashboard computes it: from the batch job's stored
    CSV distribution."""
    _, csv_dir = _batch_job(spark, sf_dir)
    return batch_view(spark, csv_dir)["funnel"]


def q_batch_job_after_failed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored results, parquet and CSV, after a second run over other rows died
    between two of them: those of the first run, whole."""
    out = scratch_path(spark, "published")
    parquet_dir, csv_dir = f"{out}/parquet", f"{out}/csv"
    raw = _raw_as_csv(spark, sf_dir)
    run_batch_job(spark, raw, parquet_dir, csv_dir, input_format="csv")
    part = scratch_path(spark, "raw-part")
    write_csv(_raw(spark, sf_dir).filter("event = 'view'"), part)

    def die(name: str) -> None:
        if name == "event_distribution":
            raise InterruptedError(name)

    try:
        run_batch_job(spark, part, parquet_dir, csv_dir, input_format="csv", on_stored=die)
        raise AssertionError("the second run was to die")
    except InterruptedError:
        pass
    keys = {"top_items": ("itemid", "view_count"), "event_distribution": ("event", "count"), "daily_visitors": ("event_date", "active_visitors")}
    parts = [
        table.select(F.lit(fmt).alias("format"), F.lit(name).alias("result"), F.col(keys[name][0]).cast("string").alias("key"), F.col(keys[name][1]).alias("n"))
        for fmt, tables in (("parquet", load_parquet_results(spark, parquet_dir)), ("csv", load_csv_results(spark, csv_dir)))
        for name, table in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def q_parquet_roundtrip_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    res, _ = _batch_job(spark, sf_dir)
    return res.tables["event_distribution"]


def q_batch_job_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    res, _ = _batch_job(spark, sf_dir)
    return res.total_events()


# --- streaming (file replay of envelopes, availableNow) ---------------------------


def _replay_source(spark: SparkSession, sf_dir: str) -> str:
    """Envelope files of the whole adapted table."""
    path = scratch_path(spark, "envelopes")
    write_parquet(envelopes_from_raw(_raw(spark, sf_dir)), path)
    return path


def _await(q: StreamingQuery) -> None:
    q.awaitTermination()  # raises what the query raised


def _state_partitions(spark: SparkSession) -> int:
    """State partitions for a replay query: one per core, but never more than the
    session's shuffle partitions."""
    return min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _stream_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sq.metric_stream(parse_envelopes(read_envelope_stream(spark, _replay_source(spark, sf_dir))))


def q_stream_snapshot_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, ckpt = scratch_path(spark, "snapshot"), scratch_path(spark, "ckpt")
    _await(sq.start_metric_snapshot(_stream_metric(spark, sf_dir), folder, ckpt, trigger="availableNow",
                                    state_partitions=_state_partitions(spark)))
    return utc_wall_clock(load_stream_metric(spark, folder))


def q_stream_windows_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ckpt = scratch_path(spark, "metric"), scratch_path(spark, "ckpt")
    _await(sq.start_metric_append(_stream_metric(spark, sf_dir), path, ckpt, trigger="availableNow",
                                  state_partitions=_state_partitions(spark)))
    return utc_wall_clock(spark.read.schema(METRIC_SCHEMA).parquet(path))


def q_stream_windows_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ckpt = scratch_path(spark, "updates"), scratch_path(spark, "ckpt")
    _await(sq.start_metric_updates(_stream_metric(spark, sf_dir), path, ckpt, trigger="availableNow",
                                   state_partitions=_state_partitions(spark)))
    return utc_wall_clock(sq.latest_updates(spark, path))


def _finalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream -> append table: the finalised windows, from bounded state."""
    path, ckpt = scratch_path(spark, "metric"), scratch_path(spark, "ckpt")
    _await(sq.start_metric_append(_stream_metric(spark, sf_dir), path, ckpt, trigger="availableNow",
                                  state_partitions=_state_partitions(spark)))
    return load_metric_table(spark, path)


def q_stream_live_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream -> append table -> live KPIs, the dashboard's data path."""
    return utc_wall_clock(live_view(_finalised(spark, sf_dir))["kpis"])


def q_stream_funnel_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream -> append table -> live funnel, the dashboard's funnel data path."""
    return live_view(_finalised(spark, sf_dir))["funnel"]


# --- late rows: the table in two parts, the second with rows of the first's time -----


def _late_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the first half of the time span but every tenth, all other rows)."""
    rows = adapt_events(spark.read.parquet(table_path(sf_dir, "events")), "event_id")
    span = rows.agg(F.floor((F.min("timestamp") + F.max("timestamp")) / 2).cast("long").alias("half")).first()
    first = (F.col("timestamp") < F.lit(span.half)) & (F.col("event_id") % 10 != 0)
    return rows.filter(first).drop("event_id"), rows.filter(~first).drop("event_id")


def _late_run(spark: SparkSession, sf_dir: str, start) -> str:
    """Stream the first part to its end, then the second from the same checkpoint."""
    src, out, ckpt = (scratch_path(spark, n) for n in ("late-envelopes", "late-out", "ckpt"))
    for part in _late_parts(spark, sf_dir):
        write_parquet(envelopes_from_raw(part), src, mode="append")
        metric = sq.metric_stream(parse_envelopes(read_envelope_stream(spark, src)))
        _await(start(metric, out, ckpt, trigger="availableNow", state_partitions=_state_partitions(spark)))
    return out


def q_stream_late_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows are dropped, finalised windows only."""
    return utc_wall_clock(load_metric_table(spark, _late_run(spark, sf_dir, sq.start_metric_append)))


def q_stream_late_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows are dropped, open windows included."""
    return utc_wall_clock(sq.latest_updates(spark, _late_run(spark, sf_dir, sq.start_metric_updates)))


def q_stream_late_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complete mode counts late rows."""
    return utc_wall_clock(load_stream_metric(spark, _late_run(spark, sf_dir, sq.start_metric_snapshot)))


# --- several micro-batches in event-time order ------------------------------------------

SLICES, FILES_PER_SLICE = 4, 3


def _sliced_replay(spark: SparkSession, sf_dir: str) -> str:
    """Envelope files of the whole table in four equal ranges of event time, written one
    after the other by three tasks each; a stream takes one range a batch."""
    rows = _raw(spark, sf_dir)
    span = rows.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).first()
    width = span.last - span.first + 1
    number = F.floor((F.col("timestamp") - F.lit(span.first)) * SLICES / F.lit(width)).cast("int")
    staged, out = scratch_path(spark, "slices"), scratch_path(spark, "sliced-envelopes")
    messages = normalize_rows(rows.withColumn("slice", number), ms_to_instant("timestamp"), "slice")
    envelopes = messages.select(
        F.col("visitorid").cast("binary").alias("key"), message_json(messages).cast("binary").alias("value"),
        ms_to_instant("timestamp").alias("timestamp"), "slice")
    write_parquet(envelopes, staged, partition_by=["slice"])
    append_slices(spark, staged, out, SLICES, FILES_PER_SLICE)
    return out


def _sliced(spark: SparkSession, src: str) -> DataFrame:
    return parse_envelopes(read_envelope_stream(spark, src, FILES_PER_SLICE))


def q_stream_replay_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finalised windows of a replay in four batches, the watermark moving between them."""
    path, ckpt = scratch_path(spark, "metric"), scratch_path(spark, "ckpt")
    metric = sq.metric_stream(_sliced(spark, _sliced_replay(spark, sf_dir)))
    _await(sq.start_metric_append(metric, path, ckpt, trigger="availableNow", state_partitions=_state_partitions(spark)))
    return utc_wall_clock(load_metric_table(spark, path))


def q_stream_snapshot_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot kept by days, after four batches."""
    folder, ckpt = scratch_path(spark, "day-snapshot"), scratch_path(spark, "ckpt")
    metric = sq.metric_stream(_sliced(spark, _sliced_replay(spark, sf_dir)))
    _await(start_day_snapshot(metric, folder, ckpt, "availableNow", state_partitions=_state_partitions(spark)))
    return utc_wall_clock(read_day_snapshot(spark, folder))


def q_stream_batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored record of every batch: its rows, first and last event."""
    out, progress, ckpt = (scratch_path(spark, n) for n in ("rows", "progress", "ckpt"))

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    rows = _sliced(spark, _sliced_replay(spark, sf_dir))
    _await(start_batches(rows, recording(write, progress, "rows", "event_ts"), ckpt, "availableNow"))
    return utc_wall_clock(read_progress(spark, progress))


def _failing_once(write, faults: dict[int, str]):
    """A sink that fails once in each of the given batches, ``before`` or ``after`` it wrote."""
    left = dict(faults)

    def run(batch_df: DataFrame, batch_id: int) -> None:
        fault = left.pop(batch_id, None)
        if fault == "before":
            raise OSError(f"sink failed before batch {batch_id}")
        write(batch_df, batch_id)
        if fault == "after":
            raise OSError(f"sink failed after batch {batch_id}")

    return run


def q_stream_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot after two failures of its sink, one before and one after its write,
    each followed by a restart from the checkpoint: every window counted once."""
    folder, ckpt = scratch_path(spark, "day-snapshot"), scratch_path(spark, "ckpt")
    src = _sliced_replay(spark, sf_dir)
    sink = _failing_once(day_snapshot_writer(folder), {1: "before", 2: "after"})
    failures = []

    def start() -> StreamingQuery:
        metric = sq.metric_stream(_sliced(spark, src))
        return start_batches(metric, sink, ckpt, "availableNow", "update", state_partitions=_state_partitions(spark))

    run_with_restarts(start, on_failure=failures.append)
    if len(failures) != 2:
        raise AssertionError(f"two failures were to be survived, not {len(failures)}")
    return utc_wall_clock(read_day_snapshot(spark, folder))


def q_stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped after two batches of a backlog, started again: what a sink holds that only
    appends, so that a repeated batch would count twice, and in how many batches."""
    out, ckpt = scratch_path(spark, "appended"), scratch_path(spark, "ckpt")
    src = _sliced_replay(spark, sf_dir)

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.select("event", F.lit(batch_id).alias("batch_id")).write.mode("append").parquet(out)

    ends = [run_to_end(start_batches(_sliced(spark, src), StopGate(after).guard(write), ckpt, "availableNow")) for after in (2, None)]
    if ends != [False, True]:
        raise AssertionError(f"the first run was to be stopped and the second to end: {ends}")
    rows = spark.read.schema("event string, batch_id int").parquet(out)
    return rows.groupBy("batch_id", "event").agg(F.count(F.lit(1)).alias("n"))


# --- publishing a stream with a side for what cannot be published -----------------------


def _published_stream(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(outbox, what was sent) of the faulty CSV text, published file by file."""
    outbox, sent, ckpt = (scratch_path(spark, n) for n in ("outbox", "sent", "ckpt"))
    rows = read_events_text_stream(spark, _faulty_csv(spark, sf_dir, 4), 2)
    _await(start_publish(rows, outbox, ckpt, lambda batch: write_parquet(batch, sent, mode="append"), "availableNow"))
    return outbox, sent


def q_stream_publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the publishing stream sent (a folder in place of the broker)."""
    sent = spark.read.schema("key binary, value binary").parquet(_published_stream(spark, sf_dir)[1])
    fields = T.StructType([f for f in MESSAGE_SCHEMA.fields if f.name in RAW_COLUMNS])
    return sent.select(F.col("key").cast("string").alias("key"), F.inline(F.array(F.from_json(F.col("value").cast("string"), fields))))


def q_stream_publish_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What it put aside: rows without a readable time, as they came."""
    return rejected_rows(spark, _published_stream(spark, sf_dir)[0]).drop("batch_id")


# --- landing: one parse into archive and quarantine ---------------------------------


def _envelopes_with_junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of the whole table; the value of every seventh is no JSON."""
    rows = adapt_events(spark.read.parquet(table_path(sf_dir, "events")), "event_id")
    messages = normalize_rows(rows, ms_to_instant("timestamp"), "event_id")
    good = F.when(F.col("event_id") % 7 != 0, message_json(messages))
    junk = F.concat(F.lit("not json "), F.col("event_id").cast("string"))
    return messages.select(
        F.col("visitorid").cast("binary").alias("key"), F.coalesce(good, junk).cast("binary").alias("value"),
        ms_to_instant("timestamp").alias("timestamp"))


def _landed(spark: SparkSession, sf_dir: str) -> str:
    src, out, ckpt = (scratch_path(spark, n) for n in ("junk-envelopes", "landing", "ckpt"))
    write_parquet(_envelopes_with_junk(spark, sf_dir), src)
    _await(sq.start_landing(read_envelope_stream(spark, src), out, ckpt, trigger="availableNow"))
    return out


def q_quarantined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the landing query put aside."""
    landed = spark.read.schema(sq.LANDED_SCHEMA).parquet(_landed(spark, sf_dir))
    return utc_wall_clock(landed.filter("kind = 'junk'").select("json_str", "kafka_ts"))


def q_landed_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive side of the landing query."""
    landed = spark.read.schema(sq.LANDED_SCHEMA).parquet(_landed(spark, sf_dir))
    return ins.event_distribution(landed.filter("kind = 'event'"))


def q_count_policy_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junk counted as a NULL event at broker time."""
    return utc_wall_clock(events_per_window(parse_envelopes(_envelopes_with_junk(spark, sf_dir), on_malformed="count")))


# --- text input and NULLs -----------------------------------------------------------


def q_csv_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc_wall_clock(dataset_coverage(spark, _raw_as_csv(spark, sf_dir)))


def q_coverage_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage of the table as CSV, of a file with a header only, of one with another
    header and of none: each a status, none an error."""
    good = _raw_as_csv(spark, sf_dir)
    empty, other = scratch_path(spark, "empty-csv"), scratch_path(spark, "other-csv")
    write_csv(read_events_csv(spark, good).limit(0).coalesce(1), empty)
    _raw(spark, sf_dir).select(F.col("event").alias("something"), F.col("visitorid").alias("else")).write.option("header", True).csv(other)
    paths = {"good": good, "empty": empty, "other": other, "none": scratch_path(spark, "no-csv")}
    return reduce(DataFrame.unionByName, [
        dataset_coverage(spark, path).select(F.lit(name).alias("input"), "n_events", F.substring_index("source", ":", 1).alias("source"))
        for name, path in paths.items()])


def q_batch_input_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job over candidates of which the first does not exist: the second is
    taken, whatever the third holds."""
    first, second, third = scratch_path(spark, "no-input"), _raw_as_csv(spark, sf_dir), scratch_path(spark, "part-csv")
    write_csv(_raw(spark, sf_dir).filter("event = 'view'"), third)
    res = run_batch_job(spark, ["", first, second, third], scratch_path(spark, "choice"))
    return res.total_events().withColumn("taken", F.lit([first, second, third].index(res.input_path) + 1))


def q_csv_text_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV text with unreadable numbers, empty fields, short rows and quoted commas ->
    normalised messages (the time of defaulted rows, which is now, is left out)."""
    messages = normalize_rows(read_events_text(spark, _faulty_csv(spark, sf_dir)))
    return messages.select(
        F.when(~F.col("ts_defaulted"), F.col("timestamp")).alias("timestamp"),
        "visitorid", "event", "itemid", "transactionid", "ts_defaulted")


def _faulty_csv(spark: SparkSession, sf_dir: str, files: int | None = None) -> str:
    """The whole table as CSV text, five of every eight rows with a fault or an empty field."""
    rows = adapt_events(spark.read.parquet(table_path(sf_dir, "events")), "event_id")
    fault = F.col("event_id") % 8
    ts = F.when(fault == 0, F.concat(F.lit("x"), "timestamp")).otherwise(F.col("timestamp").cast("string"))
    visitor = F.when(fault == 1, F.lit("")).otherwise(F.col("visitorid"))
    event = F.when(fault == 2, F.concat(F.lit('"'), "event", F.lit(',x"'))).otherwise(F.col("event"))
    head = F.concat_ws(",", ts, visitor, event)
    full = F.concat_ws(",", head, F.col("itemid"), F.coalesce("transactionid", F.lit("")))
    line = F.when(fault == 3, head).otherwise(full)
    path = scratch_path(spark, "text-csv")
    # one text column whose name is the header line; neither sign occurs in the data
    lines = rows.select(line.alias(",".join(RAW_COLUMNS)))
    lines = lines.repartition(files) if files else lines
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "\u0002").csv(path)
    return path


def _raw_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapt_events(spark.read.parquet(table_path(sf_dir, "events")), "event_id")
    return rows.select(
        F.when(F.col("event_id") % 11 != 0, F.col("timestamp")).alias("timestamp"),
        F.when(F.col("event_id") % 3 != 0, F.col("visitorid")).alias("visitorid"),
        F.when(F.col("event_id") % 5 != 0, F.col("event")).alias("event"),
        "itemid", "transactionid")


def q_null_event_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ins.event_distribution(_raw_with_nulls(spark, sf_dir))


def q_null_daily_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ins.daily_visitors(_raw_with_nulls(spark, sf_dir))


def q_archive_replay_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ckpt = scratch_path(spark, "archive"), scratch_path(spark, "ckpt")
    parsed = parse_envelopes(read_envelope_stream(spark, _replay_source(spark, sf_dir)))
    _await(sq.start_archive(parsed, path, ckpt, trigger="availableNow"))
    return ins.event_distribution(read_archive(spark, path))


QUERIES: dict[str, Query] = {
    "top_items": q_top_items,
    "event_distribution": q_event_distribution,
    "event_share": q_event_share,
    "daily_visitors": q_daily_visitors,
    "total_events": q_total_events,
    "derive_event_time": q_derive_event_time,
    "dataset_coverage": q_dataset_coverage,
    "dataset_coverage_labels": q_dataset_coverage_labels,
    "batch_date_window": q_batch_date_window,
    "batch_date_window_labels": q_batch_date_window_labels,
    "events_per_minute": q_events_per_minute,
    "live_kpis": q_live_kpis,
    "latest_window_breakdown": q_latest_window_breakdown,
    "last_n_windows_wide": q_last_n_windows_wide,
    "last_n_windows_long": q_last_n_windows_long,
    "last_n_windows_odd_names": q_last_n_windows_odd_names,
    "last_n_windows_maps": q_last_n_windows_maps,
    "event_totals_from_windows": q_event_totals_from_windows,
    "live_labels": q_live_labels,
    "funnel_live": q_funnel_live,
    "funnel_batch": q_funnel_batch,
    "normalize_events": q_normalize_events,
    "to_json_envelope": q_to_json_envelope,
    "parse_json_events": q_parse_json_events,
    "json_message_files": q_json_message_files,
    "csv_scan_count": q_csv_scan_count,
    "csv_roundtrip_results": q_csv_roundtrip_results,
    "csv_roundtrip_daily": q_csv_roundtrip_daily,
    "dashboard_batch_funnel": q_dashboard_batch_funnel,
    "batch_job_after_failed_run": q_batch_job_after_failed_run,
    "parquet_roundtrip_results": q_parquet_roundtrip_results,
    "batch_job_total": q_batch_job_total,
    "stream_snapshot_complete": q_stream_snapshot_complete,
    "stream_windows_append": q_stream_windows_append,
    "stream_windows_update": q_stream_windows_update,
    "stream_live_kpis": q_stream_live_kpis,
    "stream_funnel_live": q_stream_funnel_live,
    "archive_replay_distribution": q_archive_replay_distribution,
    "stream_late_append": q_stream_late_append,
    "stream_late_update": q_stream_late_update,
    "stream_late_complete": q_stream_late_complete,
    "stream_replay_sliced": q_stream_replay_sliced,
    "stream_snapshot_days": q_stream_snapshot_days,
    "stream_batch_rows": q_stream_batch_rows,
    "stream_recovered": q_stream_recovered,
    "stream_resumed": q_stream_resumed,
    "stream_publish_messages": q_stream_publish_messages,
    "stream_publish_rejected": q_stream_publish_rejected,
    "quarantined_records": q_quarantined_records,
    "landed_distribution": q_landed_distribution,
    "count_policy_windows": q_count_policy_windows,
    "csv_coverage": q_csv_coverage,
    "csv_coverage_states": q_coverage_states,
    "batch_job_input_choice": q_batch_input_choice,
    "csv_text_messages": q_csv_text_messages,
    "null_event_distribution": q_null_event_distribution,
    "null_daily_visitors": q_null_daily_visitors,
}
