"""Column contracts: required tables and columns, ordered output schemas, clean names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Sequence[str], where: str = "table") -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{where}: missing columns: {', '.join(missing)}")
    return df


def require_tables(tables: Mapping[str, DataFrame | None], names: Sequence[str]) -> None:
    missing = [n for n in names if tables.get(n) is None]
    if missing:
        raise ValueError(f"missing tables: {', '.join(missing)}")


def assert_schema(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The columns in the given order; an extra, missing or repeated name is an error."""
    repeated = sorted({n for n in names if list(names).count(n) > 1})
    extra = [c for c in df.columns if c not in names]
    missing = [n for n in names if n not in df.columns]
    problems = [
        f"{kind}: {', '.join(found)}"
        for kind, found in (("not in the list", extra), ("missing", missing), ("listed twice", repeated))
        if found
    ]
    if problems:
        raise ValueError("; ".join(problems))
    return df.select(*names)


def clean_name(name: str) -> str:
    return re.sub(r"[^\w]", "", name.lower().replace(" ", "_"), flags=re.UNICODE)


def clean_names(df: DataFrame) -> DataFrame:
    """Lower case, blanks to ``_``, anything but letters, digits and ``_`` dropped."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in table order."""
    i, j = df.columns.index(first), df.columns.index(last)
    return df.columns[i : j + 1]


def select_names(
    df: DataFrame,
    starts_with: str | None = None,
    contains: str | None = None,
    matches: str | None = None,
    without: Sequence[str] = (),
) -> list[str]:
    """Column names by prefix, part or regex, leaving out names that contain any of ``without``."""
    names = df.columns
    if starts_with is not None:
        names = [n for n in names if n.startswith(starts_with)]
    if contains is not None:
        names = [n for n in names if contains in n]
    if matches is not None:
        names = [n for n in names if re.search(matches, n)]
    return [n for n in names if not any(w in n for w in without)]


def is_one_of_or_null(column: str, values: Sequence) -> F.Column:
    """Membership that keeps missing values."""
    return F.col(column).isin(list(values)) | F.col(column).isNull()


def keep_numeric_ids(df: DataFrame, column: str = "record_id", number: str = "record_id_num") -> DataFrame:
    """Rows whose id is all digits, with the id as a number added."""
    return df.where(F.col(column).rlike(r"^\d+$")).withColumn(number, F.col(column).try_cast("double"))


def completeness(before: DataFrame, after: DataFrame, key: str = "record_id") -> DataFrame:
    """One row: distinct keys before and after a step, and whether they agree."""
    tagged = before.select(key, F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(
        after.select(key, F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    )
    per_key = tagged.groupBy(key).agg(F.max("_b").alias("_b"), F.max("_a").alias("_a"))
    return per_key.agg(F.sum("_b").alias("ids_before"), F.sum("_a").alias("ids_after")).withColumn(
        "complete", F.col("ids_before") == F.col("ids_after")
    )
