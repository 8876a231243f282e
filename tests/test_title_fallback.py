"""Titles of odd pages as the SQL of pages_title_fallback has them."""

import duckdb

from docgraph import queries as Q

CUT = "<title>Salt &amp; pepper&amp</title>"
PAGES = [
    None, "", "<p>none", CUT, CUT + "<h1> </h1>", CUT + "<h1 class=x>  Head &lt;b&gt; &amp;lt; &lt &#39;q&#x27; &quot;&nbsp;&eacute;　</h1>", "<h1\nid=a>two\nlines\t</h1><h1>b</h1>", CUT + "<h1><b>in a tag</b></h1>", "<!-- <h1>hidden</h1> --><h1>shown</h1>", "<H1>large</H1><title>small", "<h1",
    "<h1>\U0001d538 &amp </h1>", "<h1>&amp;amp;amp</h1>", "<title lang=en>with an attribute</title>",
]


def test_odd_pages(spark, tmp_path):
    rows = spark.createDataFrame(list(enumerate(PAGES)), "page_id long, html string")
    rows.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r.title for r in Q.queries()["pages_title_fallback"](spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert got == dict(db.execute(f"select page_id, title from ({Q.oracle_sql()['pages_title_fallback']})").fetchall())
    assert got[3] == "Salt & pepper&amp"
