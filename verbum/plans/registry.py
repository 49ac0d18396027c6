"""Name → (Spark plan, oracle SQL) registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Doubles are compared at six decimals on both sides.
DIGITS = 6


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` is the DuckDB twin over the pre-registered table views; leave it
    out when the operator is not expressible in SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = wrap(fn)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def r(c, digits: int = DIGITS) -> Column:
    """Round a double column for comparison."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def normalise(df: DataFrame) -> DataFrame:
    """Output contract shared with the oracles: integers as BIGINT, floating
    values as DOUBLE rounded to ``DIGITS``, booleans as BIGINT 0/1."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        c = F.col(f"`{f.name}`")
        if t in ("tinyint", "smallint", "int", "bigint"):
            c = c.cast("bigint")
        elif t in ("float", "double") or t.startswith("decimal"):
            c = F.round(c.cast("double"), DIGITS)
        elif t == "boolean":
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalise(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run
