"""Operators that depend on an order of rows (W1-W9, A19): ties always end in row_idx, which must be unique within the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillstone.functions.text import null_if_blank


def _by(key: str | list[str], *order: Column):
    return W.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order)


def keep_first(df: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """Of each key the first row of any order; least_per_key() spares the sort where the order can be written as a minimum."""
    return df.withColumn("__rn", F.row_number().over(_by(key, *order))).where("__rn = 1").drop("__rn")


def least_per_key(df: DataFrame, key: str | list[str], *order: Column) -> DataFrame:
    """Of each key the row with the least of order, columns whose nulls come first. It is pre-aggregated, so a hot key is never sorted in one task."""
    keys = [key] if isinstance(key, str) else key
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__row"))
    return best.select("__row.*")


def latest_with_losers(df: DataFrame, key: str | list[str], order: list[Column], kept: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Of each key the first row of the order; and the others, each with columns of the row that was kept."""
    by = _by(key, *order)
    numbered = df.withColumn("__rn", F.row_number().over(by)).withColumns({out: F.first(c).over(by) for out, c in kept.items()})
    return numbered.where("__rn = 1").drop("__rn", *kept), numbered.where("__rn > 1").drop("__rn")


def with_ordinal(df: DataFrame, key: str | list[str], *order: Column, name: str = "ordinal") -> DataFrame:
    """The row's number within its key."""
    return df.withColumn(name, F.row_number().over(_by(key, *order)))


def duplicate_suffix(df: DataFrame, key: str, *order: Column, name: str = "unique_key") -> DataFrame:
    """The key, from its second row on with #dup and the row's number."""
    n = F.row_number().over(_by(key, *order))
    return df.withColumn(name, F.when(n == 1, F.col(key)).otherwise(F.concat(F.col(key), F.lit("#dup"), n.cast("string"))))


def mode_first_seen(df: DataFrame, key: str, value: str, idx: str) -> DataFrame:
    """Of each key the most frequent value that isn't blank, ties going to the one seen first. Counts are made before rows are gathered."""
    counted = df.where(null_if_blank(F.col(value)).isNotNull()).groupBy(key, value).agg(F.count("*").alias("__n"), F.min(idx).alias("__first"))
    return counted.groupBy(key).agg(F.min_by(value, F.struct(-F.col("__n"), F.col("__first"))).alias(value), F.max("__n").alias("count"))


def best_per_group(df: DataFrame, key: str, score: str, idx: str) -> DataFrame:
    """Of each key the row of the highest score, the first of equal ones."""
    return least_per_key(df, key, F.col(score).isNull(), -F.col(score), F.col(idx))


def fill_from_group(df: DataFrame, key: str, order: list[Column], columns: list[str]) -> DataFrame:
    """For each key and column the first value in the order that isn't blank."""
    whole = _by(key, *order).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filled = df.select(key, F.row_number().over(_by(key, *order)).alias("__rn"), *(F.first(null_if_blank(F.col(c)), ignorenulls=True).over(whole).alias(c) for c in columns))
    return filled.where("__rn = 1").drop("__rn")


def value_after_label(df: DataFrame, key: str, position: str, line: str, label: Column, reach: int = 4) -> DataFrame:
    """For each line that is a label, the first line among the next ones that isn't blank and isn't a label, as value.

    label is a predicate over the line.
    """
    by = _by(key, F.asc(position))
    marked = df.withColumn("__label", label)
    stop = F.lit(False)
    value = F.lit(None).cast("string")
    for i in range(1, reach + 1):
        text, is_label = F.lead(line, i).over(by), F.coalesce(F.lead("__label", i).over(by), F.lit(False))
        stop = stop | is_label
        value = F.when(value.isNull() & ~stop, null_if_blank(text)).otherwise(value)
    return marked.withColumn("value", value).where("__label").drop("__label")
