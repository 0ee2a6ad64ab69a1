"""Readers of landed files (S1, S6, S7, S13, S20-S26): everything ends in the common record.

Fetching is not part of the engine; bytes are landed in a directory, and read
from there with Spark's own readers, whatever the store.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions.text import key_compact, null_if_blank
from rillstone.operators.ordered import keep_first

#: What every collector gives.
RECORD = T.StructType([
    T.StructField("external_id", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("payload", T.StringType()),
])

#: Fixed values.
SNAPSHOT_COLUMNS = ("project_name", "proponent", "region", "province", "municipalities", "project_type", "power_mw", "status", "source", "url", "updated_at")

#: Names under which a field may come, first to last.
ALIASES: Mapping[str, Sequence[str]] = {
    "title": ("title", "project_name", "name", "titolo", "oggetto", "denominazione"),
    "proponent": ("proponent", "proponente", "company", "societa", "soggetto_proponente"),
    "source": ("source", "source_name", "fonte", "primary_source"),
    "url": ("url", "source_url", "link", "primary_url"),
    "region": ("region", "regione"),
    "province": ("province", "provincia"),
    "municipality": ("municipality", "municipalities", "comune", "comuni", "municipality_name"),
    "mw": ("mw", "power_mw", "potenza_mw", "potenza", "power"),
    "status": ("status", "status_normalized", "stato", "stato_del_procedimento"),
    "practices": ("practices", "numero_pratiche", "pratiche"),
}


def _compact(name: str) -> str:
    return "".join(ch for ch in name.lower() if ch.isalnum())


def resolve_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]] = ALIASES) -> DataFrame:
    """Each logical field from the first alias that is present in a row; the names are resolved when the plan is made.

    Names are compared by their letters and digits alone. A field without an
    alias in df is null.
    """
    have = {_compact(c): c for c in reversed(df.columns)}
    out = []
    for field, names in aliases.items():
        found = [null_if_blank(F.col(f"`{have[_compact(n)]}`").cast("string")) for n in names if _compact(n) in have]
        out.append((F.coalesce(*found) if found else F.lit(None).cast("string")).alias(field))
    return df.select(*out)


def payload_value(payload: Column, *keys: str) -> Column:
    """The first key of a JSON text whose value is present."""
    values = (F.get_json_object(payload, f"$.{k}") for k in keys)
    return F.coalesce(*(F.when(~v.isin("", "[]", "{}"), v) for v in values))


def read_csv(spark: SparkSession, path: str, sep: str = ",", quote: str = '"', escape: str = '"') -> DataFrame:
    """All columns as text, a byte-order mark and blanks of the header removed."""
    df = spark.read.csv(path, sep=sep, quote=quote, escape=escape, header=True, encoding="UTF-8", multiLine=True)
    return df.toDF(*(c.replace("﻿", "").strip().strip('"') for c in df.columns))


def read_snapshot(spark: SparkSession, path: str, required: Sequence[str] = SNAPSHOT_COLUMNS) -> DataFrame:
    """A snapshot; a missing column, or a line with more fields than the header, is an error."""
    names = spark.read.csv(path, header=True).columns
    if missing := [c for c in required if c not in names]:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST", enforceSchema=False, escape='"', multiLine=True)


def newest(spark: SparkSession, path: str, glob: str = "*.csv") -> str:
    """The file of a directory that was changed last."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    row = files.select("path", "modificationTime").orderBy(F.desc("modificationTime"), F.desc("path")).first()
    if row is None:
        raise FileNotFoundError(path)
    return row["path"]


def sniff_separator(spark: SparkSession, path: str, candidates: str = ",;|\t") -> str:
    """The sign that is most frequent in the first line."""
    line = (spark.read.text(path).limit(1).first() or [""])[0]
    return max(candidates, key=line.count)


def read_document(spark: SparkSession, path: str, containers: Sequence[str] = ("records", "projects", "items", "data", "results", "rows", "features", "progetti")) -> DataFrame:
    """The records of a JSON document, a list or an object with the list under one of these names."""
    df = spark.read.json(path, multiLine=True)
    for name in containers:
        if name in df.columns and isinstance(df.schema[name].dataType, T.ArrayType):
            each = df.select(F.explode(name).alias("r"))
            return each.select("r.*") if isinstance(each.schema["r"].dataType, T.StructType) else each
    return df


def latest_month(df: DataFrame, year: str, month: str) -> DataFrame:
    """The rows of the newest month that has any."""
    stamp = F.col(year) * 100 + F.col(month)
    last = df.agg(F.max(stamp)).first()[0]
    return df.where(stamp == last) if last is not None else df.limit(0)


def market_rows(df: DataFrame, source: str, mw: str, region: str) -> DataFrame:
    """Solar rows with power and region."""
    return df.where((F.lower(F.trim(source)) == "solare") & F.col(mw).isNotNull() & null_if_blank(F.col(region)).isNotNull())


def municipality_table(df: DataFrame) -> DataFrame:
    """Comune, provincia, sigla, regione and key; the last row of a key counts."""
    named = resolve_aliases(df, {"comune": ("comune", "denominazione_in_italiano", "denominazione"), "provincia": ("provincia", "provincia_nome"), "sigla": ("sigla", "sigla_automobilistica"), "regione": ("regione", "denominazione_regione")})
    keyed = named.where("comune is not null").withColumn("key", key_compact(F.col("comune"))).withColumn("row_idx", F.monotonically_increasing_id())
    return keep_first(keyed, "key", F.desc("row_idx")).drop("row_idx")


def id_sweep(spark: SparkSession, first: int, last: int, template: str) -> DataFrame:
    """The URLs of a range of numbers, descending, to be fetched and landed."""
    return spark.range(first, last - 1, -1).select("id", F.replace(F.lit(template), F.lit("{id}"), F.col("id").cast("string")).alias("url"))


def union_first(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """The union of scans; of each key the row of the first scan that has it."""
    out = None
    for i, df in enumerate(frames):
        df = df.withColumn("__scan", F.lit(i)).withColumn("__row", F.monotonically_increasing_id())
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return keep_first(out, key, F.asc("__scan"), F.asc("__row")).drop("__scan", "__row")
