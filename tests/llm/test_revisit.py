"""Op 1: canonical URLs, the as-of join, validators and header merging, row by row."""

import pytest
from pyspark.sql import functions as F

from panelspark.llm import op1_revisit as op

SCHEMA = "record_id long, url string, ts long, status int, headers map<string,string>, payload string, canonical string, part int, before string"


@pytest.mark.parametrize("url,want", [
    ("HTTP://User:pw@WWW.Example.ORG:80/a/b/#frag", "example.org/a/b"),
    ("https://www2.example.org:443?b=2&a=1&utm_source=x", "example.org/?a=1&b=2"),
    ("https://example.org:80/", "example.org:80/"), ("example.org/x?", "example.org/x"), ("http://h/p?ref=1&Q=Z", "h/p?Q=Z"),
    ("", None), (None, None), ("http:///x", None)])
def test_canonical_url(spark, url, want):
    df = spark.createDataFrame([(url,)], "u string").select(op.canonical_url(F.col("u")))
    assert df.first()[0] == want


def records(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def test_resolution(spark):
    a = {"ETag": '"1"', "Content-Length": "4", "X": "old", "Last-Modified": "m"}
    rows = [
        (1, "http://s/p", 10, 200, a, "one"), (2, "https://www.s/p/", 20, 200, {"etag": '"2"'}, "two"),
        (3, "http://s/p", 30, 304, {"ETAG": 'W/"2"', "Content-Length": "0", "Date": "d"}, None),
        (4, "http://s/p", 20, 304, {"ETag": '"1"', "X": "new", "x": "newest"}, None),  # the response of the same time is not earlier
        (5, "http://s/p", 40, 304, {"ETag": '"1"'}, None),
        (6, "http://s/p", 25, 304, {}, None), (7, "http://s/p", 5, 304, {"ETag": '"1"'}, None),
        (8, "http://s/p", 15, 304, {"Last-Modified": "m"}, None), (9, None, 50, 304, None, None), (10, "http://s/p", None, 304, {"ETag": '"1"'}, None),
        (11, "http://t/", 1, 404, {}, "gone"), (12, "http://t/", 2, 304, {"ETag": '"1"'}, None), (3, "http://s/p", 30, 304, {"ETAG": 'W/"2"'}, None),
        (13, "http://n/", 1, 200, None, None), (14, "http://n/", 2, 304, {"etag": '"1"'}, None)]
    got = {}
    for r in op.resolve(records(spark, rows)).collect():
        got.setdefault(r.revisit_id, []).append(r)
    one = {k: v[0] for k, v in got.items()}
    assert {k: (r.response_id, r.verdict) for k, r in one.items()} == {
        3: (2, "resolved"), 4: (1, "resolved"), 5: (2, "mismatch"), 6: (2, "no_validator"), 7: (None, "no_response"), 8: (1, "resolved"),
        9: (None, "no_response"), 10: (None, "no_response"), 12: (None, "no_response"), 14: (13, "no_validator")}
    assert len(got[3]) == 2 and one[3].payload == "two" and one[5].payload is None and one[5].headers is None
    assert one[4].headers == {"etag": '"1"', "content-length": "4", "x": "newest", "last-modified": "m"} and one[4].payload == "one"
    assert op.resolve(records(spark, [])).count() == 0


def test_repeated_responses_and_pages(spark, tmp_path):
    """k copies of a response give one row for each revisit, and k copies of a page one row of the query."""
    a, b = (1, "http://s/p", 10, 200, {"ETag": '"1"'}, "one"), (3, "http://s/p", 30, 304, {"ETag": '"1"'}, None)
    other = [(1, "http://s/p", 10, 200, {"etag": '"1"'}, None), (1, "http://t/", 10, 200, {"ETag": '"9"'}, "elsewhere"), (1, "http://s/p", 5, 200, {"ETag": '"1"'}, "older")]
    got = op.resolve(records(spark, [a] * 50 + other + [b] * 7)).collect()
    assert [(r.revisit_id, r.response_id, r.verdict, r.payload) for r in got] == [(3, 1, "resolved", "one")] * 7

    import duckdb
    from panelspark.llm.queries import ORACLE, QUERIES
    pages = [(i, f"http://h/{i % 4}", f"<p>{i}") for i in range(30)] + [(7, "http://h/3", "<p>7")] * 40
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = con.execute(ORACLE["op1_warc_revisits"]).fetchall()
    mine = [tuple(r) for r in QUERIES["op1_warc_revisits"](spark, str(tmp_path)).collect()]
    assert len(mine) == 30 and sorted(mine, key=repr) == sorted(want, key=repr)


def test_a_hot_url_spans_partitions(spark):
    """One URL with nearly all records: the carry between partitions equals a plain scan."""
    rows = [(i, "http://hot/", 3 * i // 2, 200 if i % 5 == 0 else 304, {"etag": "e"}, str(i) if i % 5 == 0 else None) for i in range(600)]
    rows += [(1000 + i, f"http://cold/{i}", 1, 304, {}, None) for i in range(40)]
    got = {r.revisit_id: r.response_id for r in op.resolve(records(spark, rows)).collect()}
    for i, _, ts, status, _, _ in rows[:600]:
        if status == 304:
            want = max((j for j, _, t, s, _, _ in rows[:600] if s == 200 and t < ts), default=None)
            assert got[i] == want
    assert len(got) == 480 + 40
