"""What the queries share: reading tables, the records that stand in for the registry's, and registering a query with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region, source, status, mw, practices and is_aggregate of each line.

    The two largest tables meet on the order key; nations and regions are
    small by definition, and Spark broadcasts them by their size.
    """
    t = lambda n: table(spark, sf_dir, n)
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    customers = t("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    owners = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(owners, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("r_name").alias("region"), F.col("n_name").alias("province"), F.col("c_mktsegment").alias("source"), F.col("o_orderstatus").alias("status"),
        F.col("l_quantity").alias("mw"), F.col("l_linenumber").alias("practices"), (F.col("o_orderpriority") == "5-LOW").alias("is_aggregate"),
    )


RECORDS_SQL = """records AS (
  SELECT r_name AS region, n_name AS province, c_mktsegment AS source, o_orderstatus AS status, l_quantity AS mw, l_linenumber AS practices, o_orderpriority = '5-LOW' AS is_aggregate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


class Registry:
    """Queries and their SQL by name."""

    def __init__(self):
        self.queries, self.oracles = {}, {}

    def query(self, sql: str | None = None):
        def add(f):
            self.queries[f.__name__] = f
            if sql:
                self.oracles[f.__name__] = sql
            return f

        return add


def values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small table of literals."""
    return spark.createDataFrame(rows, schema)


def sql_values(names: str, rows: list[tuple]) -> str:
    """The same table in SQL; texts are quoted, None is NULL."""

    def one(x: object) -> str:
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return str(x).upper()
        if isinstance(x, float):
            return f"CAST({x!r} AS DOUBLE)"
        if isinstance(x, int):
            return f"CAST({x} AS BIGINT)"
        return "'" + str(x).replace("'", "''") + "'"

    return f"(VALUES {', '.join('(' + ', '.join(map(one, r)) + ')' for r in rows)}) AS v({names})"
