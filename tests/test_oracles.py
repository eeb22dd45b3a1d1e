"""Every registered query of the library against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from newsmarket.plans import queries as plans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_query(spark, oracle, name):
    got = plans.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    cursor = oracle.execute(plans.ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == want


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLE_SQL)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["guid", "ticker", "relation", "price_date", "next_day_return_pct", "title"]


def test_searches_take_every_twentieth_row(spark):
    folder = "/root/testdata/sf0.01"
    asked = {r[0] for r in spark.read.parquet(f"{folder}/embeddings.parquet").where("vec_id % 20 = 0").select("vec_id").collect()}
    got = plans.QUERIES["cosine_topk_twentieth"](spark, folder)
    assert {r[0] for r in got.select("query_id").collect()} == asked and len(asked) > 5


def test_html_to_text_on_odd_pages(spark, tmp_path):
    """References without semicolons, by number and unknown, and white space beyond ASCII: the SQL states the query's rule."""
    marks = ["a &amp&amp; b &ampx &notit; &notin; &euro; &AMP &lt", "&#39; &#x41 &#X1F600; &#0; &#128; &#xD800; &#1114112; &#99999999", "&amp;lt; &nope; & &; &#; &#x;", "\u2003x\x0b\u3000", "<\u017fcript>kept</\u017fcript>", "<SCRIPT>gone</sCript >y<STYLE>z"]
    rows = [(k, "u", f"<p>{m}</p>{m}") for k, m in enumerate(marks)] + [(90, "u", "&amp no tag"), (91, "u", ""), (92, "u", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = dict(tuple(r) for r in plans.QUERIES["html_to_text"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert dict(con.execute(plans.ORACLE_SQL["html_to_text"]).fetchall()) == got and len(got) == 9
