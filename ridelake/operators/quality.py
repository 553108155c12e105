"""Declarative data-quality checks and the layer gate.

Every check yields rows ``(model, check, target, severity, failures)``.
Row-level checks of one table (not_null, accepted_values, expression) are
fused into ONE aggregation pass over that table; key checks (unique,
unique_combination) are one partial+final aggregation each; relationships is
one left-anti join against the parent's distinct keys. Only the tiny result
table (one row per check) is ever brought to the driver, by :func:`gate`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridelake.functions.scalars import sql_str, sql_value
from ridelake.operators.joins import orphans

RESULT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("failures", T.LongType()),
])

ERROR, WARN = "error", "warn"


class QualityGateError(RuntimeError):
    """Raised when a check of severity ``error`` has failures."""


@dataclass(frozen=True)
class RowCheck:
    """A per-row failure predicate, as SQL text or a Column (NULL counts as
    'not failing')."""
    check: str
    target: str
    failing: Column | str
    severity: str = ERROR


def not_null(col: str, severity: str = ERROR) -> RowCheck:
    return RowCheck("not_null", col, f"`{col}` IS NULL", severity)


def accepted_values(col: str, values: Sequence, severity: str = ERROR) -> RowCheck:
    """NULL passes; anything else outside ``values`` fails."""
    listed = ", ".join(sql_value(v) for v in values)
    return RowCheck("accepted_values", col, f"`{col}` IS NOT NULL AND `{col}` NOT IN ({listed})",
                    severity)


def expression(name: str, failing: Column | str, severity: str = ERROR) -> RowCheck:
    return RowCheck("expression", name, failing, severity)


def _failures(c: RowCheck) -> Column:
    if isinstance(c.failing, str):
        return F.expr(f"count_if(coalesce(({c.failing}), false))")
    return F.count_if(F.coalesce(c.failing, F.lit(False)))


def row_checks(df: DataFrame, model: str, checks: Sequence[RowCheck]) -> DataFrame:
    """All row-level checks of one table in a single scan + one global
    aggregate (each map task emits one partial row)."""
    counts = df.agg(*[_failures(c).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = ", ".join(
        f"named_struct('model', {sql_str(model)}, 'check_name', {sql_str(c.check)}, "
        f"'target', {sql_str(c.target)}, 'severity', {sql_str(c.severity)}, "
        f"'failures', CAST(c{i} AS BIGINT))" for i, c in enumerate(checks))
    return counts.selectExpr(f"inline(array({rows}))")


def _one(model: str, check: str, target: str, severity: str, failures: Column) -> list[Column]:
    return [F.lit(model).alias("model"), F.lit(check).alias("check_name"),
            F.lit(target).alias("target"), F.lit(severity).alias("severity"),
            failures.cast("long").alias("failures")]


def unique(df: DataFrame, model: str, col: str, severity: str = ERROR) -> DataFrame:
    """Non-NULL values that occur more than once (failures = such values)."""
    dup = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
           .filter(F.col("n") > 1))
    return dup.agg(*_one(model, "unique", col, severity, F.count(F.lit(1))))


def unique_combination(df: DataFrame, model: str, keys: Sequence[str],
                       severity: str = ERROR, where: Column | str | None = None) -> DataFrame:
    """Key combinations (NULLs included) that occur more than once."""
    src = df if where is None else df.filter(where)
    dup = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    return dup.agg(*_one(model, "unique_combination", ",".join(keys), severity, F.count(F.lit(1))))


def relationships(child: DataFrame, model: str, col: str, parent: DataFrame, field_: str,
                  severity: str = WARN) -> DataFrame:
    """Child rows whose non-NULL ``col`` has no matching ``parent[field_]``.
    The child side is pre-aggregated to (value, rows) first, so the anti join
    only moves distinct values and a hot value is combined map-side."""
    per_value = (child.filter(F.col(col).isNotNull()).groupBy(col)
                 .agg(F.count(F.lit(1)).alias("__rows")))
    bad = orphans(per_value, col, parent.select(field_), field_)
    return bad.agg(*_one(model, "relationships", f"{col}->{field_}", severity,
                         F.coalesce(F.sum("__rows"), F.lit(0))))


@dataclass
class ModelChecks:
    """Checks attached to one model (table)."""
    model: str
    rows: list[RowCheck] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    combos: list[tuple[tuple[str, ...], Column | str | None]] = field(default_factory=list)
    relations: list[tuple[str, str, str]] = field(default_factory=list)  # (col, parent model, field)

    def covers(self, kinds: Sequence[str] | None = None) -> bool:
        """Whether any check of these kinds (all, if None) is attached."""
        lists = {"row": self.rows, "unique": self.unique, "unique_combination": self.combos,
                 "relationships": self.relations}
        return any(found for kind, found in lists.items() if kinds is None or kind in kinds)


def run_model_checks(df: DataFrame, spec: ModelChecks,
                     parents: dict[str, DataFrame] | None = None,
                     kinds: Sequence[str] | None = None) -> DataFrame | None:
    """Results of the selected kinds of checks for one model, or None."""
    want = set(kinds or ("row", "unique", "unique_combination", "relationships"))
    parts: list[DataFrame] = []
    if "row" in want and spec.rows:
        parts.append(row_checks(df, spec.model, spec.rows))
    if "unique" in want:
        parts += [unique(df, spec.model, c) for c in spec.unique]
    if "unique_combination" in want:
        parts += [unique_combination(df, spec.model, list(keys), where=w) for keys, w in spec.combos]
    if "relationships" in want:
        for col, parent, fld in spec.relations:
            parts.append(relationships(df, spec.model, col, (parents or {})[parent], fld))
    if not parts:
        return None
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def only(spec: ModelChecks, check: str) -> ModelChecks:
    """The spec with the row checks of one name; what it leaves out is never planned."""
    return ModelChecks(spec.model, rows=[c for c in spec.rows if c.check == check])


def summarize(results: DataFrame) -> DataFrame:
    """Per-model gate status: error > warn > pass."""
    failing = F.col("failures") > 0
    agg = results.groupBy("model").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(failing).alias("failed_checks"),
        F.count_if(failing & (F.col("severity") == ERROR)).alias("failed_errors"),
        F.count_if(failing & (F.col("severity") == WARN)).alias("failed_warnings"),
    )
    status = (F.when(F.col("failed_errors") > 0, "error")
              .when(F.col("failed_warnings") > 0, "warn").otherwise("pass"))
    return agg.withColumn("status", status)


def gate(results: DataFrame) -> list[dict]:
    """Stop the next layer on any failing ``error`` check; ``warn`` only
    reports. Brings at most one small row per check to the driver."""
    rows = [r.asDict() for r in results.filter(F.col("failures") > 0).collect()]
    errors = [r for r in rows if r["severity"] == ERROR]
    if errors:
        detail = "; ".join(f"{r['model']}.{r['check_name']}({r['target']})={r['failures']}" for r in errors)
        raise QualityGateError(f"quality gate failed: {detail}")
    return rows
