"""Registry of queries: each pairs a Spark job with the SQL that checks it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

QUERIES = {}
ORACLES = {}


def rounded(df: DataFrame, digits: int, floats) -> DataFrame:
    """Round the named columns; adding 0.0 turns a negative zero into zero."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) + F.lit(0.0) for c in floats})


def query(name, floats="", digits=6, oracle=None):
    """Register ``fn(spark, folder) -> DataFrame``; the listed floats are rounded on both sides."""
    cols = floats.split()

    def register(fn):
        QUERIES[name] = lambda spark, folder: rounded(fn(spark, folder), digits, cols) if cols else fn(spark, folder)
        QUERIES[name].__doc__ = fn.__doc__
        if oracle:
            ORACLES[name] = _rounded_sql(oracle, digits, cols)
        return fn

    return register


def _rounded_sql(sql, digits, cols):
    if not cols:
        return sql
    swaps = ", ".join(f"ROUND(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in cols)
    return f"SELECT * REPLACE ({swaps}) FROM ({sql}) AS q"
