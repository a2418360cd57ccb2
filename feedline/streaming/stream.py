"""Streaming: incremental runs over new landings (T1), marks across runs
(T2, via the state store inside each micro-batch), persistent de-dup (T3) and
per-batch metrics (T4).

The source is an endless feed of landed files, so the natural trigger is
``availableNow``: each scheduled run processes what landed since the last one
and stops. Each micro-batch runs the batch operators through ``foreachBatch``
and writes to folders named by the batch id, so a replayed batch overwrites
its own output (exactly-once effect on files).
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedline.operators.dedup import ROW_ID, first_seen, with_dedup_key
from feedline.operators.metrics import METRIC_COLUMNS, record_counts, run_metrics
from feedline.operators.validate import annotate, validate
from feedline.session import discard, few, scratch_path, stage_packed, write_packed
from feedline.sinks.writers import append_metrics, write_jsonl, write_records
from feedline.sources import keystore
from feedline.sources.state import folders

def run_available(stream: DataFrame, batch_fn: Callable[[DataFrame, int], None], checkpoint: str,
                  wait: bool = True) -> StreamingQuery:
    """Process everything landed so far, in micro-batches, then stop."""
    q = (
        stream.writeStream.foreachBatch(batch_fn)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        q.awaitTermination()
    return q


def feed_batch_writer(
    out_root: str,
    to_envelope: Callable[[DataFrame], DataFrame],
    validation_mode: str = "drop",
    key_path: str | None = "identifiers.nct_id",
    fallback: bool = True,
    run_ts: Column | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: envelope -> validate -> de-dup with a fixed
    survivor (W1 inside the batch by arrival, J2 against the keys of all earlier
    batches in the key store) -> JSON + Parquet -> new keys -> metrics (T4).

    Every folder is named by the batch, so a replayed batch writes the same
    again. Metrics are A3 rows per spider under ``metrics/run=<batch>``."""

    def process(batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        spark = batch.sparkSession
        run = f"b{batch_id:08d}"
        spider = F.substring_index("_source_key", ":", 1)
        checked = with_dedup_key(annotate(to_envelope(batch)), key_path, fallback, F.col("_valid"))
        checked = stage_packed(checked.withColumn(ROW_ID, F.monotonically_increasing_id()), scratch_path(spark, "batch"))
        v = validate(checked, validation_mode)
        v.raise_if_strict()
        earlier = [r for r in folders(spark, f"{out_root}/seen/keys", "run=") if r < run]
        late = scratch_path(spark, "losers")
        kept = first_seen(v.accepted, drop_seen=lambda winners: keystore.new_only(winners, f"{out_root}/seen", earlier), settle=lambda losers: few(stage_packed(losers, late)))
        written = write_records(kept.drop(ROW_ID), f"{out_root}/records", run)
        discard(spark, late)
        write_jsonl(written, f"{out_root}/jsonl/{run}")
        keystore.write_keys(written.select("dedup_key"), f"{out_root}/seen", run)
        counts = record_counts(v.checked.withColumn("spider", spider), v.accepted.withColumn("spider", spider))
        responses = counts.select("spider").limit(0).selectExpr("spider", *[f"0L AS {c}" for c in ("requests_total", "responses_total", "http_200", "http_304", "errors")])
        stamp = F.current_timestamp() if run_ts is None else run_ts
        append_metrics(run_metrics(counts, responses, stamp, time.time() - started), f"{out_root}/metrics/run={run}")

    return process


def read_metrics(spark: SparkSession, out_root: str) -> DataFrame:
    """The metrics lines (K3) of all runs or batches below an output root."""
    fields = ", ".join(f"{c} {'string' if c in ('event', 'timestamp', 'spider', 'finish_reason') else 'double' if c == 'elapsed_seconds' else 'bigint'}" for c in METRIC_COLUMNS)
    return spark.read.schema(fields + ", run string").json(f"{out_root}/metrics")


def ingest_available(stream: DataFrame, out_root: str, kind: str, cfg: "IngestConfig", checkpoint: str,
                     rss_source: str = "ema") -> DataFrame:
    """T1 + T2: one run over everything landed since the last one, however it is
    split into micro-batches (``source_key, page_no, payload`` of one kind:
    ``studies``, ``recalls`` or ``rss``).

    A batch only parses its pages and appends the rows to the run's pending
    folder, compared with the state as it was when the run began; page rules,
    validation, de-dup, marks, metrics and the commit are one plan over the
    rows of all batches, at the end. A run repeated after a crash goes on with
    the batches left and completes with the rows of all. Returns the new state."""
    from feedline.plans.ingest import BATCH, Landed, base_state, complete, parse_landed
    from feedline.sources import commits
    from feedline.sources.state import _exists, read_version

    spark = stream.sparkSession
    run = commits.begin(spark, out_root, cfg.run_id)
    state = base_state(spark, out_root, run)
    pending = f"{out_root}/pending/run={cfg.run_id}"

    def process(batch: DataFrame, batch_id: int) -> None:
        fetched = [c for c in ("fetched_at",) if c in batch.columns]
        pages = batch.select("source_key", F.col("page_no").cast("bigint"), "payload", *fetched)
        landed = Landed(rss={rss_source: pages}) if kind == "rss" else Landed(**{kind: pages})
        write_packed(parse_landed(landed, state, cfg), f"{pending}/{BATCH}={batch_id}")

    run_available(stream, process, checkpoint)
    if not _exists(spark, pending):
        return read_version(spark, f"{out_root}/state", commits.newest(spark, out_root))
    return complete(spark, spark.read.parquet(pending), out_root, cfg, run, state).state


def dedup_stream(stream: DataFrame, key: str = "dedup_key", watermark: tuple[str, str] | None = None) -> DataFrame:
    """Drop later copies of a key across the whole stream; null keys pass.

    Without ``watermark`` the key set is unbounded state (use the RocksDB state
    store for large histories); with ``(column, delay)`` the state is bounded
    by ``dropDuplicatesWithinWatermark``. Which copy survives inside one batch
    is not fixed - apply W1 in ``foreachBatch`` where that matters.
    """
    keyed = stream.where(F.col(key).isNotNull())
    if watermark is not None:
        keyed = keyed.withWatermark(*watermark).dropDuplicatesWithinWatermark([key])
    else:
        keyed = keyed.dropDuplicates([key])
    return keyed.unionByName(stream.where(F.col(key).isNull()))


def read_written(spark: SparkSession, out_root: str) -> DataFrame:
    """All records below an output root: those of committed runs, or of every
    batch where :func:`feed_batch_writer` wrote them."""
    from feedline.sources import commits

    found = commits.read_committed(spark, out_root, "records")
    return found if found is not None else spark.read.parquet(f"{out_root}/records")
