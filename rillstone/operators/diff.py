"""Differences between two snapshots."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions.numbers import diff_number, italian_format
from rillstone.functions.text import clean_text, key_words
from rillstone.operators.ordered import duplicate_suffix


def record_key(named: Mapping[str, Column], *fallback: Column) -> Column:
    """The first field that is present, with its name before it; else the words of the fallback."""
    present = [F.when(clean_text(c).isNotNull(), F.concat(F.lit(f"{n}:"), clean_text(c))) for n, c in named.items()]
    return F.coalesce(*present, F.concat(F.lit("fallback:"), F.concat_ws("|", *map(key_words, fallback))))


def comparable(c: Column, kind: str) -> Column:
    """How values are compared: numbers at six decimals, texts by their words."""
    if kind == "number":
        return F.coalesce(F.format_string("%.6f", diff_number(c)), F.lit(""))
    return key_words(c)


def shown(c: Column, kind: str) -> Column:
    """How values are shown."""
    text = F.coalesce(clean_text(c), F.lit("n/d"))
    return F.coalesce(italian_format(diff_number(c)), text) if kind == "number" else text


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fields: Mapping[str, str], idx: str = "row_idx") -> DataFrame:
    """change_type (added, removed or changed), the key, field, old_value and new_value; a row for each field that changed.

    Rows that repeat a key are told apart by their place. One full outer join
    finds all three.
    """
    sides = []
    for name, df in (("o", old), ("n", new)):
        keyed = duplicate_suffix(df.where(F.col(key).isNotNull()), key, F.asc(idx), name="__key")
        sides.append(keyed.select("__key", F.lit(True).alias(f"__{name}"), *(F.col(c).alias(f"__{name}_{c}") for c in fields)))
    both = sides[0].join(sides[1], "__key", "full_outer")
    part = lambda t, f, o, n: F.struct(F.lit(t).alias("change_type"), F.lit(f).cast("string").alias("field"), o.alias("old_value"), n.alias("new_value"))
    null = F.lit(None).cast("string")
    changes = [F.when(F.col("__o") & F.col("__n") & (comparable(F.col(f"__o_{c}"), k) != comparable(F.col(f"__n_{c}"), k)), part("changed", c, shown(F.col(f"__o_{c}"), k), shown(F.col(f"__n_{c}"), k))) for c, k in fields.items()]
    whole = [F.when(F.col("__o").isNull(), part("added", None, null, null)), F.when(F.col("__n").isNull(), part("removed", None, null, null))]
    return both.select(F.col("__key").alias("key"), F.inline(F.array_compact(F.array(*whole, *changes))))


def diff_counts(diff: DataFrame) -> DataFrame:
    return diff.groupBy("change_type").agg(F.count("*").alias("rows"), F.count_distinct("key").alias("keys"))
