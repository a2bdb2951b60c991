"""Data-quality gate: rules from configuration become flag columns, one aggregate judges them all, rows that break one
are quarantined with every reason."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ROW_RULES = ("not_null", "unique", "range", "enum_domain", "expression", "referential")
BATCH_RULES = ("freshness", "continuity")
DERIVED_RULES = ("castable",)
# Parameters each rule type must have.
REQUIRED = {"enum_domain": {"values"}, "expression": {"predicate"}, "referential": {"ref_layer", "ref_table", "ref_column"}, "freshness": {"max_age_days"}, "continuity": {"max_missing_days"}}


class QualityFailure(RuntimeError):
    pass


@dataclass(frozen=True)
class Rule:
    rule_id: str
    rule_set: str
    column: str | None
    rule_type: str
    params: dict = field(default_factory=dict)
    condition: str | None = None
    severity: str = "warn"
    threshold: float | None = None

    @property
    def by_row(self) -> bool:
        return self.rule_type not in BATCH_RULES


@dataclass
class Result:
    rule: Rule
    evaluated: int
    failed: int
    outcome: str = "passed"  # passed, quarantined, failed_run, batch_warn or not_evaluated
    breached: bool = False
    detail: str = ""

    @property
    def failed_pct(self) -> float:
        return 100.0 * self.failed / self.evaluated if self.rule.by_row and self.evaluated else 0.0

    @property
    def fails_run(self) -> bool:
        """An error always does; a warning only by rate, and only for rules about rows."""
        if not self.breached:
            return False
        if self.rule.severity == "error":
            return True
        return self.rule.by_row and self.rule.threshold is not None and self.failed_pct > self.rule.threshold


@dataclass
class Gate:
    clean: DataFrame
    quarantined: DataFrame
    results: list[Result]
    rows_in: int
    rows_quarantined: int
    cached: DataFrame | None = None

    def release(self) -> None:
        """Give the judged rows' memory back, once clean and quarantined rows are written."""
        if self.cached is not None:
            self.cached.unpersist()

    @property
    def failed(self) -> bool:
        return any(r.fails_run for r in self.results)

    def raise_if_failed(self, what: str) -> None:
        bad = [f"{r.rule.rule_id} [{r.rule.severity}] {r.failed} of {r.evaluated} {r.detail}".strip() for r in self.results if r.fails_run]
        if bad:
            raise QualityFailure(f"{what}: " + "; ".join(bad))


def validate_rules(rules: list[Rule], known_sets: set[str]) -> list[str]:
    """What is wrong with a rule table: unknown, missing and repeated things, and contradictions."""
    found, seen = [], set()
    for r in rules:
        if r.rule_id in seen:
            found.append(f"{r.rule_id}: repeated id")
        seen.add(r.rule_id)
        if r.rule_set not in known_sets:
            found.append(f"{r.rule_id}: unknown rule set {r.rule_set}")
        if r.rule_type in DERIVED_RULES or r.rule_type not in (*ROW_RULES, *BATCH_RULES):
            found.append(f"{r.rule_id}: rule type {r.rule_type} can't be configured")
        if r.severity not in ("error", "warn"):
            found.append(f"{r.rule_id}: severity {r.severity}")
        if r.severity == "error" and r.threshold is not None:
            found.append(f"{r.rule_id}: an error has no threshold")
        if missing := REQUIRED.get(r.rule_type, set()) - set(r.params):
            found.append(f"{r.rule_id}: lacks {sorted(missing)}")
        if r.rule_type == "range" and not {"min", "max"} & set(r.params):
            found.append(f"{r.rule_id}: a range needs min or max")
    found += [f"rule set {s} has no rules" for s in sorted(known_sets - {r.rule_set for r in rules})]
    return found


def rules_for(rules: list[Rule], rule_set: str) -> list[Rule]:
    """The rules of a set, by id. A set without rules is an error, not a pass."""
    found = sorted((r for r in rules if r.rule_set == rule_set), key=lambda r: r.rule_id)
    if not found:
        raise QualityFailure(f"rule set {rule_set!r} has no rules")
    return found


def violation(rule: Rule) -> Column:
    """True where a row breaks the rule; never null. Referential and unique rules read a helper column."""
    c, p = F.col(f"`{rule.column}`") if rule.column else None, rule.params
    if rule.rule_type == "not_null":
        bad = c.isNull()
    elif rule.rule_type == "unique":
        bad = F.col(f"__n_{rule.column}") > 1
    elif rule.rule_type == "range":
        low = c < F.lit(p["min"]) if p.get("min") is not None else F.lit(False)
        high = c > F.lit(p["max"]) if p.get("max") is not None else F.lit(False)
        bad = low | high
    elif rule.rule_type == "enum_domain":
        bad = c.isNotNull() & ~c.isin(p["values"])
    elif rule.rule_type == "expression":
        bad = ~F.coalesce(F.expr(p["predicate"]), F.lit(False))
    elif rule.rule_type == "referential":
        bad = ~F.col(f"__ref_{rule.rule_id}")
    elif rule.rule_type == "castable":
        bad = c.isNotNull() & c.try_cast(p["type"]).isNull()
    else:
        raise ValueError(f"{rule.rule_id}: no row rule {rule.rule_type}")
    return F.coalesce(bad, F.lit(False))


def scope(rule: Rule) -> Column:
    """Rows the rule is about; an unknown condition is out of scope."""
    return F.coalesce(F.expr(rule.condition), F.lit(False)) if rule.condition else F.lit(True)


def flagged(df: DataFrame, rules: list[Rule], references: dict | None = None) -> tuple[DataFrame, list[Rule], list[Result]]:
    """``df`` with __bad_<i> and __in_<i> for each row rule that can be evaluated; those rules; results of the others."""
    wanted = [r for r in rules if r.by_row]
    absent = [r for r in wanted if r.rule_type not in ("expression",) and r.column not in df.columns]
    if absent:
        raise QualityFailure(f"missing columns {sorted({r.column for r in absent})}")
    out, ready, skipped = df, [], []
    for c in sorted({r.column for r in wanted if r.rule_type == "unique"}):
        # Nulls aren't compared, and don't meet in one task.
        salt = F.when(F.col(f"`{c}`").isNull(), F.xxhash64(*[F.col(f"`{x}`").cast("string") for x in df.columns]))
        n = F.count(F.lit(1)).over(Window.partitionBy(c, "__salt"))
        out = out.withColumn("__salt", salt).withColumn(f"__n_{c}", F.when(F.col(f"`{c}`").isNull(), 0).otherwise(n)).drop("__salt")
    for r in wanted:
        if r.rule_type == "referential":
            ref = (references or {}).get((r.params["ref_layer"], r.params["ref_table"]))
            if ref is None:
                fatal = r.severity == "error"
                skipped.append(Result(r, 0, 0, "failed_run" if fatal else "not_evaluated", fatal, "the reference table is missing"))
                continue
            known = ref.select(F.col(r.params["ref_column"]).alias("__ref")).distinct()
            out = out.join(known, F.col(f"`{r.column}`") == F.col("__ref"), "left").withColumn(f"__ref_{r.rule_id}", F.col("__ref").isNotNull()).drop("__ref")
        ready.append(r)
    # The helper columns of a rule are named by its id; dots would read as paths.
    flags = {}
    for i, r in enumerate(ready):
        flags[f"__in_{i}"] = scope(r)
        name = f"__ref_{r.rule_id}"
        bad = ~F.col(f"`{name}`") if r.rule_type == "referential" else violation(r)
        flags[f"__bad_{i}"] = F.coalesce(bad, F.lit(False)) & scope(r)
    return out.withColumns(flags) if flags else out, ready, skipped


def rule_columns(ready: list[Rule]) -> tuple[Column, Column]:
    """_dq_rule_ids, every broken rule of a row, and _dq_severity, the worst of them."""
    ids = F.array_compact(F.array(*[F.when(F.col(f"__bad_{i}"), F.lit(r.rule_id)) for i, r in enumerate(ready)])) if ready else F.expr("cast(array() as array<string>)")
    errors = [F.col(f"__bad_{i}") for i, r in enumerate(ready) if r.severity == "error"]
    worst = F.when(reduce(lambda a, b: a | b, errors), "error").otherwise("warn") if errors else F.lit("warn")
    return ids, worst


def batch_results(df: DataFrame, rules: list[Rule], as_of: dt.date | None) -> list[Result]:
    """Rules about the batch as a whole, in one aggregate. ``as_of`` comes from the batch, never from the clock."""
    wanted = [r for r in rules if not r.by_row]
    if not wanted:
        return []
    aggs = []
    for i, r in enumerate(wanted):
        d = F.when(scope(r), F.col(f"`{r.column}`").cast("date"))
        aggs += [F.min(d).alias(f"a{i}"), F.max(d).alias(f"b{i}"), F.count_distinct(d).alias(f"n{i}")]
    got, out = df.agg(*aggs, F.count(F.lit(1)).alias("rows")).first(), []
    for i, r in enumerate(wanted):
        low, high, days = got[f"a{i}"], got[f"b{i}"], got[f"n{i}"]
        if low is None:
            breached, detail = True, "no dates"
        elif r.rule_type == "freshness":
            age = (as_of - high).days if as_of else 0
            breached, detail = age > r.params["max_age_days"], f"newest {high} is {age} days old"
        else:
            missing = (high - low).days + 1 - days
            breached, detail = missing > r.params["max_missing_days"], f"{missing} days missing from {low} to {high}"
        outcome = "passed" if not breached else "failed_run" if r.severity == "error" else "batch_warn"
        out.append(Result(r, got["rows"], 0, outcome, breached, detail))
    return out


def as_of(batch_id: str) -> dt.date | None:
    """The last date of a batch id."""
    try:
        return dt.date.fromisoformat(batch_id.rsplit("|", 1)[-1])
    except ValueError:
        return None


def gate(df: DataFrame, rules: list[Rule], references: dict | None = None, batch_id: str = "") -> Gate:
    """Judge a batch. One aggregate evaluates all row rules; nothing is raised here, so that results and quarantine can be
    written before the run fails."""
    marked, ready, skipped = flagged(df, rules, references)
    ids, worst = rule_columns(ready)
    marked = marked.withColumns({"_dq_rule_ids": ids, "_dq_severity": worst}).persist()
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(F.size("_dq_rule_ids") > 0).alias("held")]
    for i in range(len(ready)):
        aggs += [F.count_if(F.col(f"__in_{i}")).alias(f"in{i}"), F.count_if(F.col(f"__bad_{i}")).alias(f"bad{i}")]
    got = marked.agg(*aggs).first()
    results = list(skipped)
    for i, r in enumerate(ready):
        x = Result(r, got[f"in{i}"], got[f"bad{i}"], breached=got[f"bad{i}"] > 0)
        x.outcome = "passed" if not x.breached else "failed_run" if x.fails_run else "quarantined"
        results.append(x)
    results += batch_results(df, rules, as_of(batch_id))
    clean = marked.filter(F.size("_dq_rule_ids") == 0).select(*[F.col(f"`{c}`") for c in df.columns])
    held = marked.filter(F.size("_dq_rule_ids") > 0).select(*[F.col(f"`{c}`") for c in df.columns], "_dq_rule_ids", "_dq_severity")
    return Gate(clean, held, sorted(results, key=lambda r: r.rule.rule_id), got["rows"], got["held"], marked)
