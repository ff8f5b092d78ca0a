"""Data-quality checks (Q1-Q7, Q12) as DataFrame aggregations.

Each check yields ``(check, column, severity, failures)``.  Row-level checks
of one table (not_null, accepted_values, expression_is_true) are fused into
a single ``agg`` of ``count_if``: one scan, a partial aggregate per task and a
one-row final merge.  Uniqueness checks are grouped aggregations (map-side
combined, so a hot key costs one row per task); relationships are left-anti
joins; row-count equality compares two counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ("check", "column", "severity", "failures")


@dataclass
class Check:
    kind: str                      # not_null | unique | accepted_values | expression_is_true |
    column: str | None = None      # relationships | unique_combination | equal_rowcount
    severity: str = "error"
    values: tuple = ()
    expression: str | None = None  # for expression_is_true: column suffix or whole-row expression
    where: str | None = None
    columns: tuple = ()
    parent: DataFrame | None = field(default=None, repr=False)
    parent_column: str | None = None
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or self.kind


def not_null(col, severity="error", where=None):
    return Check("not_null", col, severity, where=where)


def unique(col, severity="error"):
    return Check("unique", col, severity)


def accepted_values(col, values, severity="error", where=None):
    return Check("accepted_values", col, severity, values=tuple(values), where=where)


def expression_is_true(expression, col=None, severity="error", where=None, name=None):
    return Check("expression_is_true", col, severity, expression=expression, where=where, name=name)


def relationships(col, parent, parent_column, severity="error"):
    return Check("relationships", col, severity, parent=parent, parent_column=parent_column)


def unique_combination(cols, severity="error"):
    return Check("unique_combination", ",".join(cols), severity, columns=tuple(cols))


def equal_rowcount(other, severity="error"):
    return Check("equal_rowcount", None, severity, parent=other)


def _failing_condition(chk: Check):
    """Row predicate that is TRUE for a failing row (NULL counts as pass)."""
    if chk.kind == "not_null":
        cond = F.col(chk.column).isNull()
    elif chk.kind == "accepted_values":
        cond = F.col(chk.column).isNotNull() & ~F.col(chk.column).isin(*chk.values)
    elif chk.kind == "expression_is_true":
        text = f"`{chk.column}` {chk.expression}" if chk.column else chk.expression
        cond = ~F.expr(text)
    else:
        raise ValueError(chk.kind)
    if chk.where:
        cond = F.expr(chk.where) & cond
    return F.coalesce(cond, F.lit(False))


def _row(chk: Check, failures) -> list:
    return [F.lit(chk.label).alias("check"), F.lit(chk.column).cast("string").alias("column"),
            F.lit(chk.severity).alias("severity"), failures.cast("long").alias("failures")]


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All checks of one table as one result DataFrame (lazy)."""
    results: list[DataFrame] = []
    fused = [c for c in checks if c.kind in ("not_null", "accepted_values", "expression_is_true")]
    if fused:
        agg = df.agg(*[F.count_if(_failing_condition(c)).alias(f"f{i}") for i, c in enumerate(fused)])
        stack = ", ".join(f"'{i}', f{i}" for i in range(len(fused)))
        long = agg.selectExpr(f"stack({len(fused)}, {stack}) as (idx, failures)")
        meta = df.sparkSession.createDataFrame(
            [(str(i), c.label, c.column, c.severity) for i, c in enumerate(fused)],
            "idx string, check string, column string, severity string")
        results.append(long.join(F.broadcast(meta), "idx").select(*RESULT_COLUMNS))  # a row per check
    for c in checks:
        if c.kind in ("unique", "unique_combination"):
            cols = list(c.columns) if c.columns else [c.column]
            keyed = df.filter(" and ".join(f"`{k}` is not null" for k in cols)) if c.kind == "unique" else df
            dup = keyed.groupBy(*cols).count().filter(F.col("count") > 1)
            results.append(dup.agg(*_row(c, F.count(F.lit(1)))))
        elif c.kind == "relationships":
            # Keys are counted first, so a hot foreign key (e.g. the sentinel) is one row per map
            # task before anything is shuffled for the join.
            parent = c.parent.select(F.col(c.parent_column).alias("__pk")).distinct()
            keys = df.filter(F.col(c.column).isNotNull()).groupBy(F.col(c.column).alias("__fk")).agg(F.count("*").alias("__rows"))
            orphans = keys.join(parent, F.col("__fk") == F.col("__pk"), "left_anti")
            results.append(orphans.agg(*_row(c, F.coalesce(F.sum("__rows"), F.lit(0)))))
        elif c.kind == "equal_rowcount":
            other = c.parent.agg(F.count(F.lit(1))).scalar()
            results.append(df.agg(F.count(F.lit(1)).alias("a")).select(*_row(c, F.abs(F.col("a") - other))))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


class CheckFailed(RuntimeError):
    pass


def enforce(results: DataFrame) -> list[tuple]:
    """Q12: raise when an ``error`` check has failures; ``warn`` never blocks.

    The result has one row per check (tens of rows), so collecting it is bounded.
    """
    rows = [tuple(r) for r in results.collect()]
    errors = [r for r in rows if r[2] == "error" and (r[3] or 0) > 0]
    if errors:
        raise CheckFailed(f"failed checks: {errors}")
    return rows
