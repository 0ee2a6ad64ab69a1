"""Suspicious rows, repairs with their log, and rankings without suspects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import geo
from rillstone.functions.numbers import best_title_power, title_agrees, title_powers, under_scaled
from rillstone.operators.ordered import keep_first
from rillstone.operators.rules import bad_company_reason, each_error

#: Sources whose titles are trusted more than their fields.
TRUSTED_POWER, TRUSTED_PROVINCE = ("emilia_romagna", "emilia romagna"), ("lazio",)


def _described(records: DataFrame) -> DataFrame:
    title = F.col("title")
    return records.withColumns({"__mws": title_powers(title), "__codes": geo.title_province_codes(title), "__field_codes": geo.province_codes(F.col("province")), "__hint": geo.title_municipality(title), "__town": geo.municipality(F.col("municipality"))})


def suspicious(records: DataFrame) -> DataFrame:
    """row_idx and issue of each way in which a title speaks against the fields."""
    hint, town = F.col("__hint"), F.col("__town")
    codes, field = F.col("__codes"), F.col("__field_codes")
    rules = [
        ("title_municipality_mismatch", (hint != "") & (town != "") & ~F.contains(hint, town) & ~F.contains(town, hint)),
        ("title_province_mismatch", (F.size(codes) > 0) & (F.size(field) > 0) & ~F.arrays_overlap(codes, field)),
        ("title_mw_mismatch", ~title_agrees(F.col("__mws"), F.col("mw"))),
    ]
    return each_error(_described(records), rules).select("row_idx", "issue")


def top_without(records: DataFrame, suspects: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The largest projects, each key once, without keys of which a row is suspicious."""
    bad = records.join(suspects.select("row_idx").distinct(), "row_idx").select(key).distinct()
    good = records.where(~F.col("is_aggregate") & F.col("mw").isNotNull()).join(bad, key, "left_anti")
    return keep_first(good, key, F.asc("row_idx")).orderBy(F.desc("mw"), F.asc("row_idx")).limit(n)


def repair_power(mw: Column, powers: Column, source: Column) -> tuple[Column, Column]:
    """The power that replaces a field, and why; both null where it stays."""
    best = best_title_power(powers, mw)
    trusted = F.lower(F.trim(source)).isin(*TRUSTED_POWER) & mw.isNotNull() & ~title_agrees(powers, mw)
    scaled = under_scaled(mw, best)
    value = F.when(scaled, best).when(trusted, F.get(powers, F.lit(0)))
    return F.round(value, 6), F.when(scaled, "field_mw_underscaled_vs_title").when(trusted, "field_mw_replaced_by_trusted_title_mw")


def repair(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records with power, province and proponent repaired in this order, and a row for each repair."""
    df = _described(records)
    new_mw, why_mw = repair_power(F.col("mw"), F.col("__mws"), F.col("source"))
    df = df.withColumns({"__mw": new_mw, "__why_mw": why_mw})
    single = F.size("__codes") == 1
    code = F.get(F.col("__codes"), F.lit(0))
    empty = geo.province(F.col("province")) == ""
    trusted = F.lower(F.trim("source")).isin(*TRUSTED_PROVINCE) & ~F.array_contains("__field_codes", code)
    df = df.withColumn("__why_province", F.when(single & empty, "province_filled_from_explicit_title_code").when(single & trusted, "province_replaced_by_trusted_title_code"))
    df = df.withColumn("__why_proponent", F.concat(F.lit("bad_proponent_cleared_"), bad_company_reason(F.col("proponent"))))
    log = lambda field, old, new, why: F.when(F.col(why).isNotNull(), F.struct(F.lit(field).alias("field"), old.cast("string").alias("old_value"), new.cast("string").alias("new_value"), F.col(why).alias("reason")))
    repairs = F.array_compact(F.array(log("mw", F.col("mw"), F.col("__mw"), "__why_mw"), log("province", F.col("province"), code, "__why_province"), log("proponent", F.col("proponent"), F.lit(""), "__why_proponent")))
    logged = df.select("row_idx", F.inline(repairs))
    fixed = df.withColumns({
        "mw": F.when(F.col("__why_mw").isNotNull(), F.col("__mw")).otherwise(F.col("mw")),
        "province": F.when(F.col("__why_province").isNotNull(), code).otherwise(F.col("province")),
        "proponent": F.when(F.col("__why_proponent").isNotNull(), F.lit("")).otherwise(F.col("proponent")),
    })
    return fixed.select(*records.columns), logged
