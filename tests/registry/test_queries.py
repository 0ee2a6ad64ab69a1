"""Queries against their SQL on rows that the smallest tables don't have."""

import duckdb

from rillstone.plans import catalogue
from tests.compare import assert_same


def same_on(spark, folder, name, table, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    assert_same(catalogue.QUERIES[name](spark, str(folder)), con, catalogue.ORACLES[name])


def test_powers_are_rounded_as_doubles(spark, tmp_path):
    prices = [136295.0, 128605.0, 77195.0, 154265.0, 153545.0, 1005.0, 1015.0, 1001.91, 499993.18]
    same_on(spark, tmp_path, "q24_power", "orders", [(2 * i + odd, p) for i, p in enumerate(prices) for odd in (0, 1)], "o_orderkey long, o_totalprice double")


def test_titles_keep_references_but_amp(spark, tmp_path):
    titles = ["a &amp; b", "cut &amp;&amp", "cut &amp;&am", "cut &", 'token = &quot;3563008a', "&lt;b&gt; &#39;x&#x41; &eacute;", "&amp;quot; &amp;amp;", "&amp;amp &ampamp;", ""]
    rows = [(i, f"http://h/{i}", f'<html><head><title>{x}</title></head><body><a href="/a?b=1&amp;c=2">x &amp y</a><a class="k" href="/d?e=1&copy=2">z</a></body></html>') for i, x in enumerate(titles)]
    same_on(spark, tmp_path, "q33_html_title_links", "pages", rows, "page_id long, url string, html string")
