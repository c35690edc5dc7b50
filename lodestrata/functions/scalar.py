"""Scalar functions that need more than Spark's own: masks, tolerant casts and SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def mask_tail(column: Column, shown: int = 4, sign: str = "*") -> Column:
    """All but the last characters replaced."""
    hidden = F.greatest(F.length(column) - shown, F.lit(0))
    return F.concat(F.repeat(F.lit(sign), hidden), F.substring(column, hidden + 1, F.lit(shown)))


def sha256_hex(column: Column) -> Column:
    """Lower-case hex of the SHA-256 of the trimmed upper-case text."""
    return F.sha2(F.upper(F.trim(column.cast("string"))), 256)


def flatten(rows: DataFrame, column: str, as_name: str, keep_empty: bool = False) -> DataFrame:
    """One row for each element of a list; rows with an empty or null list go, unless ``keep_empty``."""
    return rows.withColumn(as_name, (F.explode_outer if keep_empty else F.explode)(column))


def query_user(user: str | None = None) -> Column:
    """The user who asks: given for policies, so that results don't depend on the session."""
    return F.lit(user) if user is not None else F.current_user()


def create_function(spark: SparkSession, name: str, arguments: str, returns: str, body: str) -> None:
    """A temporary SQL function; drop and describe it with SQL."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {returns} RETURN {body}")


def returns(spark: SparkSession, expression: str, rows: DataFrame) -> str:
    """The type of an expression over the rows."""
    return rows.select(F.expr(expression).alias("x")).schema["x"].dataType.simpleString()
