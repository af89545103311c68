"""The column contract, readers and checks.

A training table has an id, a period and a target column; the current table has the id and, if at all, a target that
is never read: it is pruned before anything else, so it is in no scan.  Every other column that both share is a feature.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NULL_TOKENS, null_tokens_to_null, parse_period


@dataclass(frozen=True)
class ColumnContract:
    id: str = "CustomerID"
    period: str = "Month"
    target: str = "ChurnStatus"

    def all(self) -> tuple[str, str, str]:
        return self.id, self.period, self.target


@dataclass(frozen=True)
class Budgets:
    """Bytes and rows for bounded samples and chunks."""

    preview_rows: int = 4096
    chunk_bytes: int = 64 << 20
    model_bytes: int = 512 << 20
    analysis_bytes: int = 256 << 20
    model_rows: int = 200_000
    analysis_rows: int = 75_000
    least_chunk: int = 2_000
    most_chunk: int = 100_000


def rows_for_bytes(bytes_per_row: int, budget: int, most: int) -> int:
    return min(most, max(1, budget // max(1, bytes_per_row)))


def chunk_rows(bytes_per_row: int, budgets: Budgets = Budgets()) -> int:
    return min(budgets.most_chunk, max(budgets.least_chunk, budgets.chunk_bytes // max(1, bytes_per_row)))


def bytes_per_row(df: DataFrame, budgets: Budgets = Budgets()) -> int:
    """Estimate from a preview: characters of the rows as JSON, twice for objects in memory."""
    row = df.limit(budgets.preview_rows).select(F.length(F.to_json(F.struct("*"))).alias("n")).agg(F.avg("n")).first()
    return max(1, int(2 * (row[0] or 1)))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A delimited file with a header.  Null tokens are nulled before columns are typed: a column whose other values are
    all numbers becomes double, any other one stays text.  With a schema there is no second pass."""
    text = spark.read.option("header", True).option("nullValue", "").csv(path)
    clean = text.select(*[null_tokens_to_null(F.col(f"`{c}`")).alias(c) for c in text.columns])
    if schema is not None:
        return clean.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields if f.name in clean.columns])
    bad = [F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull()).alias(f"c{i}") for i, c in enumerate(clean.columns)]
    some = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(clean.columns)]
    row = clean.agg(*bad, *some).first()
    return clean.select(*[(F.col(f"`{c}`").cast("double") if row[f"n{i}"] and not row[f"c{i}"] else F.col(f"`{c}`")).alias(c) for i, c in enumerate(clean.columns)])


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: Parquet (also a folder), ORC, JSON lines, or delimited text."""
    kind = re.search(r"\.(parquet|orc|jsonl?|csv)/?$", path)
    if kind and kind[1] == "csv":
        return read_csv(spark, path)
    if kind and kind[1].startswith("json"):
        return spark.read.json(path)
    return spark.read.orc(path) if kind and kind[1] == "orc" else spark.read.parquet(path)


def without_target(current: DataFrame, contract: ColumnContract) -> DataFrame:
    """Drop the target before anything reads it."""
    return current.select(*[c for c in current.columns if c != contract.target])


def require_columns(df: DataFrame, columns: tuple[str, ...], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} has no column {', '.join(missing)}")


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")


def shared_features(train: DataFrame, current: DataFrame, contract: ColumnContract) -> list[str]:
    """In the order of the training table."""
    return [c for c in train.columns if c in current.columns and c not in contract.all()]


def by_kind(train: DataFrame, features: list[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical), from the types of the training table; booleans are numeric."""
    types = {f.name: f.dataType for f in train.schema.fields}
    numeric = [f for f in features if isinstance(types[f], T.NumericType | T.BooleanType)]
    return numeric, [f for f in features if f not in numeric]


def with_period(df: DataFrame, contract: ColumnContract, name: str = "period_idx") -> DataFrame:
    """Periods as numbers: integers stay, timestamps and dates become months, text is parsed as YY-MMM."""
    kind = df.schema[contract.period].dataType
    c = F.col(f"`{contract.period}`")
    if isinstance(kind, T.IntegralType):
        return df.withColumn(name, c.cast("int"))
    if isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        return df.withColumn(name, F.year(c) * 12 + F.month(c) - 1)
    return df.withColumn(name, parse_period(c))


def bad_periods(df: DataFrame, contract: ColumnContract) -> int:
    """Rows with a period that is there but cannot be read."""
    return with_period(df, contract, "__idx").where(F.col(f"`{contract.period}`").isNotNull() & F.col("__idx").isNull()).count()


__all__ = ["NULL_TOKENS", "Budgets", "ColumnContract", "bad_periods", "by_kind", "bytes_per_row", "chunk_rows", "read_csv", "read_table", "require_columns", "require_rows", "rows_for_bytes", "shared_features", "with_period", "without_target"]
