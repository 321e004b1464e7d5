import pytest

from mercatura.llm import urls
from mercatura.llm.queries import RULES

RULE_LIST = [*RULES, ("block", "example.org", "/pri"), ("allow", "example.org", "/private/ok/")]


def brute(host, path):
    fits = [
        (h.count("."), len(p), h + p, v)
        for v, h, p in RULE_LIST
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else None


@pytest.mark.parametrize("host", ["com", "example.com", "a.www.example.com", "x.net", "net", "", "example.org", "anet"])
@pytest.mark.parametrize(
    "path", ["", "/", "/en", "/en/", "/en/x", "/es/", "/es", "/fr/a/b", "/private/ok/x", "/private/ok", "/pri", "//en/"]
)
def test_trie_against_all_rules(host, path):
    assert urls.longest_match(urls.build_trie(RULE_LIST), host, path) == brute(host, path)


def test_filter(spark, rows):
    pages = spark.createDataFrame(
        [
            (1, "https://WWW.Example.com/en/a?x=/es/", "h"), (2, None, None), (3, "no scheme", ""),
            (4, "http://a.net/es/#top", "h"), (None, "x://y://z/p", "h"), (4, "http://a.net/es/#top", "h"),
            (5, "http://example.com?q", "h"), (6, "", ""),
        ],
        "page_id long, url string, rule string",
    )
    found = urls.filter_urls(pages, RULES)
    assert rows(found) == sorted(
        [
            (1, "www.example.com", "/en/a", "www.example.com/en/", "allow"), (2, "", "", None, "allow"),
            (3, "", "", None, "allow"), (4, "a.net", "/es/", "net/es/", "block"), (6, "", "", None, "allow"),
            (4, "a.net", "/es/", "net/es/", "block"), (5, "example.com", "", None, "allow"),
            (None, "y:", "//z/p", None, "allow"),
        ],
        key=repr,
    )
    assert urls.filter_urls(pages.limit(0), RULES).count() == 0
