import fnmatch
import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from locusweave.llm import queries, url_filter
from locusweave.llm.url_filter import Rule, ShiftAnd

from .conftest import DATA, needs_data

GLOB = st.text(alphabet="ab*?.", max_size=12)


@settings(max_examples=60, deadline=None)
@given(st.lists(GLOB, min_size=1, max_size=20), st.lists(st.text(alphabet="ab.", max_size=30), min_size=1, max_size=8))
def test_automaton_agrees_with_regular_expressions(globs, texts):
    got = ShiftAnd(globs).first(texts)
    for text, found in zip(texts, got):
        fits = [i for i, g in enumerate(globs) if re.fullmatch(fnmatch.translate(g), text)]
        assert found == (fits[0] if fits else -1)


def test_many_rules_span_several_words():
    globs = [f"*.host{i}.net#/*" for i in range(100)]
    automaton = ShiftAnd(globs)
    assert automaton.words > 10
    assert automaton.first([".a.host7.net#/x", ".host99.net#/", ".host7.net#", "." + "x" * 5000 + ".host42.net#/"]).tolist() == [7, 99, -1, 42]


def test_longest_rule_wins_and_odd_urls_are_allowed(spark):
    urls = ["http://example.net/en/x?q#f", "http://EXAMPLE.net/de/", "http://a.example.com/de/1", "http://b.org/fr/", "http://net", "http://xnet/",
            "http://a.net?/x", None, "", "no scheme", "x://casino-a.org/en", "http://é.net/" + "p" * 20000, "http://badexample.com/de/"]
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r[0]: r[1:] for r in rows(url_filter.judge_urls(pages))}
    assert got[0] == ("example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("example.net", "/de/", "net/", "block")
    assert got[2][2:] == ("example.com/de/", "block") and got[3][2:] == ("org/fr/", "allow")
    assert got[4] == ("net", "", None, "allow") and got[5][2:] == (None, "allow") and got[6] == ("a.net", "", None, "allow")
    assert got[7] == got[8] == got[9] == ("", "", None, "allow")
    assert got[10][2:] == (None, "block") and got[11][2:] == ("net/", "block") and got[12][2:] == (None, "allow")


def test_repeated_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")] * 3, "page_id long, url string")
    assert url_filter.judge_urls(pages).count() == 3
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
    only = url_filter.judge_urls(pages, [Rule("a.net", "/", True)], [])
    assert {r.verdict for r in only.collect()} == {"allow"}


@needs_data
def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{DATA}/pages.parquet'")
    want = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({queries.SQL['op1_url_filter']})").fetchall()
    assert sorted(want, key=str) == sorted(map(tuple, queries.op1_url_filter(spark, DATA).collect()), key=str)
