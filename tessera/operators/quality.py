"""Data-quality operators: each returns the violating rows (empty = pass).

* ``unique``       - non-NULL values occurring more than once (value, count).
* ``not_null``     - rows where the column is NULL.
* ``relationships``- rows whose non-NULL key has no parent (left anti join).
* ``non_negative`` - rows with ``column < 0``; zero and NULL pass (the
  source test is named "positive" but only rejects negatives).
* ``after``        - rows with ``column < CAST(bound AS DATE)``; equality and
  NULL pass; ``bound`` is a column name or a quoted date literal.

``run_checks`` evaluates many declarations and returns one summary row per
test; every count is a distributed aggregation, only the summary (one row
per declared test) reaches the driver in ``enforce``.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import shuffled


def unique(df: DataFrame, column: str) -> DataFrame:
    # The NULL group is dropped after the aggregation, in one expression over
    # the aggregate, so Catalyst does not push an IS NOT NULL filter below a
    # dedup window on the same key: the model's shuffle then stays identical
    # to the one other tests of the model use, and is reused.
    grouped = (df.groupBy(F.col(column).alias("unique_field"))
                 .agg(F.count(F.lit(1)).alias("n_records")))
    dup = F.when(F.col("unique_field").isNotNull(), F.col("n_records") > 1).otherwise(F.lit(False))
    return grouped.where(dup)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def _orphan_key_counts(df: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    """(key, rows) for child keys without a parent.

    Child keys are aggregated first (map-side partial aggregation collapses a
    hot key to one row per task), so only distinct keys meet the parent in
    the anti join; the child's full rows are never shuffled for it.
    """
    keys = (df.where(F.col(column).isNotNull())
              .groupBy(F.col(column).alias("_child_key"))
              .agg(F.count(F.lit(1)).alias("_rows")))
    parents = parent.select(F.col(field_name).alias("_parent_key")).where(F.col("_parent_key").isNotNull())
    return keys.join(shuffled(parents), keys["_child_key"] == parents["_parent_key"], "left_anti")


def relationships(df: DataFrame, column: str, parent: DataFrame, field_name: str) -> DataFrame:
    orphans = _orphan_key_counts(df, column, parent, field_name).select("_child_key")
    # Semi join of the child rows to the (usually few) orphan keys: Catalyst
    # broadcasts the key set when its measured size allows, else shuffles.
    return df.join(orphans, df[column] == orphans["_child_key"], "left_semi")


def non_negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def _bound(bound: str) -> F.Column:
    b = bound.strip()
    if b.startswith("'") and b.endswith("'"):
        return F.lit(b[1:-1]).cast("date")
    return F.col(b).cast("date")


def after(df: DataFrame, column: str, bound: str) -> DataFrame:
    return df.where(F.col(column) < _bound(bound))


@dataclass(frozen=True)
class Check:
    layer: str
    model: str
    test: str                 # unique | not_null | relationships | positive | after
    column: str
    severity: str = "error"   # warn logs only; error fails the layer
    args: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.test}_{self.model}_{self.column}"


def _bronze(model: str, test: str, column: str) -> Check:
    return Check("bronze", model, test, column, "warn")


def _silver(model: str, test: str, column: str, **args) -> Check:
    return Check("silver", model, test, column, "error", args)


# The 37 declared model tests (bronze tests only warn).
DECLARED_CHECKS: tuple[Check, ...] = (
    _bronze("base_orders", "unique", "orderid"),
    _bronze("base_orders", "not_null", "orderid"),
    _bronze("base_orders", "not_null", "orderdate"),
    _bronze("base_order_status", "not_null", "orderid"),
    _bronze("base_order_status", "not_null", "statustimestamp"),
    _bronze("base_members", "unique", "memberid"),
    _bronze("base_members", "not_null", "memberid"),
    _bronze("base_members", "not_null", "joindate"),
    _bronze("base_marketing", "unique", "campaignid"),
    _bronze("base_marketing", "not_null", "campaignid"),
    _bronze("base_marketing", "not_null", "campaignstartdate"),
    _bronze("base_marketing", "not_null", "campaignenddate"),
    _bronze("base_orders_items", "not_null", "orderid"),
    _bronze("base_preferences", "not_null", "memberid"),
    _silver("stg_orders", "unique", "orderid"),
    _silver("stg_orders", "not_null", "orderid"),
    _silver("stg_orders", "relationships", "memberid", to="stg_members", field="memberid"),
    _silver("stg_orders", "not_null", "orderdate"),
    _silver("stg_orders", "after", "orderdate", min="'2000-01-01'"),
    _silver("stg_orders", "positive", "subtotal"),
    _silver("stg_orders", "positive", "total"),
    _silver("stg_order_status", "not_null", "orderid"),
    _silver("stg_order_status", "not_null", "statustimestamp"),
    _silver("stg_members", "unique", "memberid"),
    _silver("stg_members", "not_null", "memberid"),
    _silver("stg_members", "not_null", "joindate"),
    _silver("stg_members", "after", "expirationdate", min="joindate"),
    _silver("stg_marketing", "unique", "campaignid"),
    _silver("stg_marketing", "not_null", "campaignid"),
    _silver("stg_marketing", "not_null", "campaignstartdate"),
    _silver("stg_marketing", "not_null", "campaignenddate"),
    _silver("stg_marketing", "after", "campaignenddate", min="campaignstartdate"),
    _silver("stg_orders_items", "not_null", "orderid"),
    _silver("stg_orders_items", "positive", "price"),
    _silver("stg_preferences", "not_null", "memberid"),
    Check("gold", "build_orders", "unique", "orderid"),
    Check("gold", "build_orders", "not_null", "orderid"),
)


def violations(check: Check, model: Callable[[str], DataFrame]) -> DataFrame:
    df = model(check.model)
    if check.test == "unique":
        return unique(df, check.column)
    if check.test == "not_null":
        return not_null(df, check.column)
    if check.test == "relationships":
        return relationships(df, check.column, model(check.args["to"]), check.args["field"])
    if check.test == "positive":
        return non_negative(df, check.column)
    if check.test == "after":
        return after(df, check.column, check.args["min"])
    raise ValueError(f"unknown test {check.test}")


ROW_LEVEL = ("not_null", "positive", "after")


def _violates(c: Check) -> F.Column:
    col = F.col(c.column)
    if c.test == "not_null":
        return col.isNull()
    if c.test == "positive":
        return col < 0
    return col < _bound(c.args["min"])


def _summary_row(c: Check, failures: F.Column) -> F.Column:
    return F.struct(F.lit(c.layer).alias("layer"), F.lit(c.model).alias("model"),
                    F.lit(c.test).alias("test_name"), F.lit(c.column).alias("column_name"),
                    F.lit(c.severity).alias("severity"), failures.alias("failures"))


def _counts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row: failures ``_f0``, ``_f1`` ... of row-level tests and at most
    one unique test of a model."""
    rowwise = [F.count(F.when(_violates(c), 1)).alias(f"_f{i}") for i, c in enumerate(checks) if c.test != "unique"]
    key = next((c for c in checks if c.test == "unique"), None)
    if key is None:
        return df.agg(*rowwise)
    per_key = df.groupBy(F.col(key.column).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"), *rowwise)
    repeated = F.count(F.when(F.col("_key").isNotNull() & (F.col("_rows") > 1), 1))
    return per_key.agg(*[(repeated if c.test == "unique" else F.coalesce(F.sum(f"_f{i}"), F.lit(0))).alias(f"_f{i}")
                         for i, c in enumerate(checks)])


def run_checks(model: Callable[[str], DataFrame],
               checks: Iterable[Check] = DECLARED_CHECKS) -> DataFrame:
    """One row per test: layer, model, test_name, column_name, severity, failures.

    The tests of one model take one pass over it.  Row-level tests (not_null,
    positive, after) are counted in a single aggregation; where the model also
    has a ``unique`` test, they are counted per key and then summed, so the
    key's grouping is the only scan.  A relationships test needs its own
    grouping of the child keys.
    """
    checks = list(checks)
    per_model: dict[str, list[Check]] = {}
    alone = []
    for c in checks:
        mine = per_model.setdefault(c.model, [])
        if c.test in ROW_LEVEL or (c.test == "unique" and not any(x.test == "unique" for x in mine)):
            mine.append(c)
        else:
            alone.append(c)
    parts = []
    for name, cs in per_model.items():
        if cs:
            counts = _counts(model(name), cs)
            rows = F.array(*[_summary_row(c, F.col(f"_f{i}")) for i, c in enumerate(cs)])
            parts.append(counts.select(F.explode(rows).alias("r")).select("r.*"))
    for c in alone:
        if c.test == "relationships":
            v = _orphan_key_counts(model(c.model), c.column, model(c.args["to"]), c.args["field"])
            n = F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint")
        else:
            v, n = violations(c, model), F.count(F.lit(1))
        parts.append(v.agg(n.alias("_n")).select(_summary_row(c, F.col("_n")).alias("r")).select("r.*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class DataQualityError(RuntimeError):
    pass


def enforce(summary: DataFrame, fail_on: Sequence[str] = ("error",)) -> list[dict]:
    """Collect the (bounded: one row per test) summary; raise on failing errors."""
    return enforce_rows([r.asDict() for r in summary.collect()], fail_on)


def enforce_rows(rows: list[dict], fail_on: Sequence[str] = ("error",)) -> list[dict]:
    for r in rows:
        if r["failures"] and r["severity"] not in fail_on:
            logging.getLogger(__name__).warning(
                "data test %s on %s.%s: %d failing rows (severity %s)", r["test_name"],
                r["model"], r["column_name"], r["failures"], r["severity"])
    failed = [r for r in rows if r["failures"] and r["severity"] in fail_on]
    if failed:
        names = ", ".join(f"{r['test_name']}({r['model']}.{r['column_name']})={r['failures']}"
                          for r in failed)
        raise DataQualityError(f"data tests failed: {names}")
    return rows
