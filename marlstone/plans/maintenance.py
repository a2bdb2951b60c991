"""Compaction, clean-up and advice for the store's tables."""

from __future__ import annotations

from dataclasses import dataclass

from ..sources.store import Footprint, TableStore
from . import control

#: Less than a week of history risks readers that are still at work.
SAFE_HOURS = 168
LOG = "run_id string, layer string, table_name string, action string, status string, files_before bigint, bytes_before bigint, files_after bigint, bytes_after bigint, files_compacted bigint, stale_files_removed bigint, retain_hours double, advisory string, error_message string, started_ts timestamp, ended_ts timestamp, duration_sec double"


@dataclass
class Action:
    layer: str
    table: str
    action: str
    status: str
    before: Footprint | None = None
    after: Footprint | None = None
    files_compacted: int = 0
    removed: int = 0
    advisory: str = ""
    error: str = ""


def advise(after: Footprint, compacted: int, small_bytes: float = 32 << 20) -> str:
    """Names the one fragmentation that compaction can't mend: many small files, each alone in its partition."""
    if after.partition_columns and after.files > 1 and compacted == 0 and after.average_file_bytes < small_bytes:
        return f"{after.files} files of {after.average_file_bytes / 1024:.0f} KiB on average by {after.partition_columns[0]}: choose a coarser partition column"
    return ""


def maintain(store: TableStore, layers: list[str], run_id: str, retain_hours: float = SAFE_HOURS, dry_run: bool = False, target_bytes: int = 128 << 20, small_bytes: float = 32 << 20) -> list[Action]:
    """Compact, then clean up every table; each in its own right, failures recorded."""
    done: list[Action] = []
    for layer in layers:
        for name in store.list_tables(layer):
            for what in ("optimize", "vacuum"):
                began, a = control.now(), Action(layer, name, what, "dry_run" if dry_run else "applied")
                try:
                    a.before = a.after = store.footprint(layer, name)
                    if what == "optimize" and not dry_run:
                        got = store.optimize(layer, name, target_bytes)
                        a.after, a.files_compacted = got["after"], got["files_compacted"]
                        a.advisory = advise(a.after, a.files_compacted, small_bytes)
                    elif what == "vacuum":
                        a.removed = len(store.vacuum(layer, name, retain_hours, dry_run))
                        a.advisory = f"retention of {retain_hours:g} h is under {SAFE_HOURS} h" if retain_hours < SAFE_HOURS else ""
                        a.after = store.footprint(layer, name)
                except Exception as e:  # one table's failure doesn't stop the others
                    a.status, a.error = "failed", f"{type(e).__name__}: {e}"[:1000]
                ended, b, c = control.now(), a.before, a.after
                row = (run_id, layer, name, what, a.status, b and b.files_on_disk, b and b.bytes_on_disk, c and c.files_on_disk, c and c.bytes_on_disk, a.files_compacted, a.removed, float(retain_hours), a.advisory, a.error, began, ended, (ended - began).total_seconds())
                if not dry_run and (layer, name) != (control.META, "maintenance_log"):
                    control.append(store, "maintenance_log", [row], LOG)
                done.append(a)
    return done
