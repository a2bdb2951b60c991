"""Waves of feeds: by priority one after the other, within a priority together."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import functions as F

from ..sources.store import TableStore


@dataclass
class Outcome:
    entity: str
    status: str  # succeeded, failed or not_run
    attempts: int = 0
    rows: int = 0
    error: str = ""


def waves(configs: list[dict]) -> list[list[dict]]:
    """Enabled feeds grouped by priority, by name within one."""
    plan: dict[int, list[dict]] = {}
    for c in sorted((c for c in configs if c["enabled"]), key=lambda c: (c["priority"], c["entity"])):
        plan.setdefault(c["priority"], []).append(c)
    return list(plan.values())


def attempt(call: Callable[[dict], int], config: dict, retries: int = 1, wait: float = 1.0) -> Outcome:
    """Run, and again after a wait that grows by each failure."""
    for i in range(retries + 1):
        try:
            return Outcome(config["entity"], "succeeded", i + 1, call(config) or 0)
        except Exception as e:  # a feed's failure is a result here
            error = f"{type(e).__name__}: {e}"
            if i < retries:
                time.sleep(wait * (i + 1))
    return Outcome(config["entity"], "failed", retries + 1, 0, error)


def run_stage(call: Callable[[dict], int], configs: list[dict], parallelism: int = 4, retries: int = 1, wait: float = 1.0) -> list[Outcome]:
    """All waves; after one with a failure no further wave starts. The session must exist before."""
    done: list[Outcome] = []
    for wave in waves(configs):
        if any(o.status == "failed" for o in done):
            done += [Outcome(c["entity"], "not_run") for c in wave]
            continue
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(wave)))) as pool:
            done += list(pool.map(lambda c: attempt(call, c, retries, wait), wave))
    return done


def reconcile(store: TableStore, run_id: str, dispatched: list[tuple[str, str]]) -> dict[tuple[str, str], str]:
    """The logged status of each (entity, layer) sent out; 'unknown' where the log has nothing."""
    logged = {}
    if store.exists("meta", "run_log"):
        rows = store.read("meta", "run_log").filter(F.col("run_id") == run_id).orderBy("ended_ts").select("entity", "layer", "status").collect()
        logged = {(r["entity"], r["layer"]): r["status"] for r in rows}
    return {d: logged.get(d, "unknown") for d in dispatched}
