"""URL rules: the index against running every rule, the SQL twin, odd rows."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import url_rules as U
from tests.conftest import SF_SMALL
from tests.oracle_util import assert_same, duck

ALL = U.rules()
COMPILED = [re.compile(r.regex(), re.S) for r in ALL]
URLS = st.lists(st.sampled_from(["http://", "www.", "example.com", "a.net", "/en/", "/es/", "casino", "-", "ads", ".", "/ads/", "x", "?", "#",
                                 "/track/", "zpixel", "keygen", "org", "/EN/", "Com/", "pills", "free-bets", "xxx", "é"]), max_size=9).map("".join)


def plainly(host, path):
    """The contract read word for word, then every pattern."""
    fit = [(len(h + p), -i, h + p, v) for i, (v, h, p) in enumerate(U.HOST_RULES)
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return max(fit)[2:]
    low = (host + path).lower()
    return None, "block" if any(c.search(low) for r, c in zip(ALL, COMPILED) if not r.length) else "allow"


@given(URLS, st.dictionaries(st.sampled_from(["com", "en", "example", "casino", "ads"]), st.integers(0, 9)))
@settings(max_examples=600, deadline=None)
def test_index_finds_what_all_rules_find(url, seen):
    host, path = U.host_and_path(url)
    assert U.judge(host, path, ALL, COMPILED, U.indexed(ALL, seen)) == plainly(host, path)


def test_rarest_token():
    assert U.indexed([U.Rule("block", "||example.com/en/")], {"example": 5, "com": 9, "en": 2}) == {"en": [0]}
    assert U.Rule("block", "/track/*pixel").tokens() == ["track"]


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, 1), (2, "no scheme", 1), (None, "HTTP://WWW.Example.COM/en/X?q#f", 1), (4, "x://h" + "a" * 99999 + "/p", 1),
                                   (5, "http://a.b.net/es/1", 1), (5, "http://a.b.net/es/1", 1), (6, "", 1), (7, "s://casino-win.org/", 1)],
                                  "page_id long, url string, host int")
    got = sorted((tuple(r) for r in U.judged(pages).collect()), key=str)
    want = [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (None, "www.example.com", "/en/X", "www.example.com/en/", "allow"),
            (4, "h" + "a" * 99999, "/p", None, "allow"), (5, "a.b.net", "/es/1", "net/es/", "block"), (5, "a.b.net", "/es/1", "net/es/", "block"),
            (6, "", "", None, "allow"), (7, "casino-win.org", "/", None, "block")]
    assert got == sorted(want, key=str)
    assert U.judged(pages.limit(0)).collect() == []


def test_sql_twin(spark):
    from meterflow.llm.queries import ORACLES, QUERIES
    assert assert_same(QUERIES["op5_url_rules"](spark, SF_SMALL), duck(SF_SMALL), ORACLES["op5_url_rules"])
