"""Data-quality rules as data (DQ1-DQ13): a list of rules per table, compiled into one aggregate.

A rule is a condition that every row must meet (null counts as broken) or a measure of the whole
table with its bounds. ``check`` turns the rules of a table into the columns of one aggregation, so
a table is scanned once however many rules it has, and returns a row per rule with the number of
violations, the smallest key that breaks it and the measure. Uniqueness, references, order and
agreement between tables are rules over a table of keys or pairs that the caller derives.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RULE_COLUMNS = ["tabla", "regla", "violaciones", "primera_clave", "medida"]


@dataclass(frozen=True)
class Rule:
    """Every row meets ``holds``; ``key`` names a row in the report."""
    name: str
    holds: Column
    key: Column | None = None

    def columns(self) -> tuple[Column, Column, Column]:
        broken = ~F.coalesce(self.holds, F.lit(False))
        key = F.min(F.when(broken, self.key.cast("string"))) if self.key is not None else F.lit(None).cast("string")
        return F.count_if(broken).cast("bigint"), key, F.lit(None).cast("double")


@dataclass(frozen=True)
class Measure:
    """An aggregate of the table lies within [low, high]; None is open. No rows, no measure: broken."""
    name: str
    value: Column
    low: float | None = None
    high: float | None = None

    def columns(self) -> tuple[Column, Column, Column]:
        value = self.value.cast("double")
        ok = F.lit(True)
        if self.low is not None:
            ok = ok & (value >= self.low)
        if self.high is not None:
            ok = ok & (value <= self.high)
        return (~F.coalesce(ok & value.isNotNull(), F.lit(False))).cast("bigint"), F.lit(None).cast("string"), value


def rows_exactly(n: int) -> Measure:
    return Measure("filas_esperadas", F.count(F.lit(1)), n, n)


def check(table: str, df: DataFrame, rules: list[Rule | Measure]) -> DataFrame:
    """A row per rule, from one aggregation over ``df``."""
    found = [F.struct(F.lit(table).alias("tabla"), F.lit(r.name).alias("regla"), *(c.alias(n) for c, n in zip(r.columns(), RULE_COLUMNS[2:]))) for r in rules]
    return df.agg(F.array(*found).alias("r")).select(F.inline("r"))


def suite(checks: list[tuple[str, DataFrame, list[Rule | Measure]]]) -> DataFrame:
    """All checks in one table; an aggregation per entry."""
    out = check(*checks[0])
    for c in checks[1:]:
        out = out.unionByName(check(*c))
    return out


def assert_holds(report: DataFrame, allowed: frozenset[str] = frozenset()) -> list:
    """Fail the job when a rule is broken, apart from the ``allowed`` ones ("table.rule"). A report has a row per rule."""
    rows = report.collect()
    broken = [f"{r['tabla']}.{r['regla']}: {r['violaciones']} (first {r['primera_clave']}, measure {r['medida']})"
              for r in rows if r["violaciones"] and f"{r['tabla']}.{r['regla']}" not in allowed]
    if broken:
        raise AssertionError("data quality: " + "; ".join(broken))
    return rows


# ---- derived tables --------------------------------------------------------------------------

def key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``n``: for uniqueness (n = 1)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def references(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys of ``child`` and whether ``parent`` has them: ``clave``, ``existe``."""
    have = parent.select(F.col(key).alias("p")).distinct()
    c = child.select(F.col(key).alias("clave")).where(F.col("clave").isNotNull()).distinct()
    return c.join(have, F.col("clave") == F.col("p"), "left").select("clave", F.col("p").isNotNull().alias("existe"))


def agreement(one: DataFrame, two: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``value`` of both tables by key, as ``a`` and ``b``: for reconciliation. A key that one lacks has a null."""
    a = one.select(*keys, F.col(value).cast("double").alias("a"))
    b = two.select(*keys, F.col(value).cast("double").alias("b"))
    return a.join(b, keys, "full")


def neighbours(top: DataFrame, order: Column, value: str) -> DataFrame:
    """``valor`` and ``previo`` (the value before it) of a ranked report of few rows."""
    return top.select(F.col(value).cast("double").alias("valor"), F.lag(F.col(value).cast("double")).over(Window.orderBy(order)).alias("previo"))
