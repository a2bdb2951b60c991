"""Operational tables: high-water marks, run log, quality results. All live in the store's meta layer."""

from __future__ import annotations

import contextlib
import datetime as dt
import time
import uuid

from pyspark.sql import functions as F

from ..operators.quality import Gate
from ..sources.store import CommitConflict, TableStore

META = "meta"
WATERMARK = "entity string, layer string, watermark_value string, last_batch_id string, updated_ts timestamp"
RUN_LOG = "run_id string, batch_id string, entity string, layer string, step string, status string, started_ts timestamp, ended_ts timestamp, duration_sec double, rows_read bigint, rows_written bigint, rows_quarantined bigint, rows_deduped bigint, error_message string"
RESULTS = "run_id string, batch_id string, entity string, rule_id string, rule_type string, column_name string, severity string, rows_evaluated bigint, rows_failed bigint, failed_pct double, outcome string, detail string, evaluated_ts timestamp"
TRIES = 5


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def retried(what):
    """Do it again, from reading on, when another writer was faster."""
    for i in range(TRIES):
        try:
            return what()
        except CommitConflict:
            if i == TRIES - 1:
                raise
            time.sleep(0.05 * (i + 1))


def get_watermark(store: TableStore, entity: str, layer: str = "bronze") -> str | None:
    if not store.exists(META, "watermark"):
        return None
    row = store.read(META, "watermark").filter((F.col("entity") == entity) & (F.col("layer") == layer)).first()
    return row["watermark_value"] if row else None


def set_watermark(store: TableStore, entity: str, layer: str, value: str, batch_id: str) -> None:
    """One row for each feed and layer; a lost race is tried again."""

    def once():
        new = store.spark.createDataFrame([(entity, layer, value, batch_id, now())], WATERMARK)
        if store.exists(META, "watermark"):
            old = store.read(META, "watermark")
            new = old.filter(~((F.col("entity") == entity) & (F.col("layer") == layer))).unionByName(new)
        store.write(new.coalesce(1), META, "watermark", "overwrite")

    retried(once)


def reset_watermark(store: TableStore, entity: str | None = None, layer: str | None = None) -> None:
    """Forget the marks of a feed, of a layer, of both, or all."""
    if not store.exists(META, "watermark"):
        return

    def once():
        hit = (F.col("entity") == entity if entity else F.lit(True)) & (F.col("layer") == layer if layer else F.lit(True))
        store.write(store.read(META, "watermark").filter(~hit).coalesce(1), META, "watermark", "overwrite")

    retried(once)


def append(store: TableStore, name: str, rows: list[tuple], schema: str) -> None:
    if rows:
        retried(lambda: store.write(store.spark.createDataFrame(rows, schema).coalesce(1), META, name, "append"))


class Step:
    """What a step reports; filled in while it runs."""

    def __init__(self):
        self.batch_id, self.status, self.rows_read, self.rows_written, self.rows_quarantined, self.rows_deduped = None, "succeeded", 0, 0, 0, 0


@contextlib.contextmanager
def step(store: TableStore, run_id: str, entity: str, layer: str, name: str):
    """One row in the run log when the step ends, however it ends."""
    s, began, error = Step(), now(), None
    try:
        yield s
    except Exception as e:
        s.status, error = "failed", f"{type(e).__name__}: {e}"[:2000]
        raise
    finally:
        ended = now()
        row = (run_id, s.batch_id, entity, layer, name, s.status, began, ended, (ended - began).total_seconds(), s.rows_read, s.rows_written, s.rows_quarantined, s.rows_deduped, error)
        append(store, "run_log", [row], RUN_LOG)


def record_results(store: TableStore, run_id: str, batch_id: str, entity: str, gate: Gate) -> None:
    at = now()
    rows = [(run_id, batch_id, entity, r.rule.rule_id, r.rule.rule_type, r.rule.column, r.rule.severity, r.evaluated, r.failed, r.failed_pct, r.outcome, r.detail, at) for r in gate.results]
    append(store, "dq_results", rows, RESULTS)


def quarantine(store: TableStore, run_id: str, batch_id: str, entity: str, gate: Gate) -> None:
    """Rejected rows with all their reasons; a batch that comes again replaces its own."""
    if gate.rows_quarantined:
        out = gate.quarantined.withColumns({"_dq_run_id": F.lit(run_id), "_dq_batch_id": F.lit(batch_id), "_quarantined_ts": F.current_timestamp()})
        stage = "types" if any(r.rule.rule_type == "castable" for r in gate.results) else "rules"
        # Uncast and cast rows have different schemas: each gate has its own table.
        name = f"q_{entity}" + ("_uncast" if stage == "types" else "")
        store.write(out, "quarantine", name, "replace_tag", merge_schema=True, tag=batch_id)


def new_run_id() -> str:
    return uuid.uuid4().hex
