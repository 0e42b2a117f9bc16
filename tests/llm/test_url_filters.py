from __future__ import annotations

import random
import re

from helpers import CLASHING, tuples
from pyspark.sql import functions as F

from rollbook.llm.queries import URL_RULES
from rollbook.llm.url_filters import UrlRule, filter_urls, path_rule


def _plain(url, rules, default="allow"):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), found[1]), found[2]) if found else ("", "")
    best = None
    for verdict, rule in rules:
        at, slash, rest = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith(slash + rest):
            best = max(best or (0, "", ""), (len(rule), rule, verdict))
    return host, path, best and best[1], best[2] if best else default


def test_against_brute_force(spark):
    chance = random.Random(3)
    hosts = ["example.com", "WWW.Example.com", "xexample.com", "a.net", "net", "com", "a.b.net:80", "", "é.com"]
    paths = ["", "/", "/en/", "/en", "/english/", "/es/x", "/fr/?q=/en/", "#/en/", "/EN/", "/en/\n/es/", "/a://b/en/"]
    urls = [f"{chance.choice(['http', 'HTTPS', ''])}://{chance.choice(hosts)}{chance.choice(paths)}" for _ in range(400)]
    urls += [None, "", "no scheme", "://", "a://b://c/en/", urls[0], "x" * 100_000]
    rules = [*URL_RULES, ("block", "com/en"), ("allow", "net/es/x"), ("block", "é.com/")]
    pages = spark.createDataFrame([(n % 300, u) for n, u in enumerate(urls)], "page_id long, url string")
    got = filter_urls(pages, [path_rule(*rule) for rule in rules])
    assert tuples(got) == sorted(((n % 300, u, *_plain(u, rules)) for n, u in enumerate(urls)), key=repr)


def test_patterns_without_tokens_and_defaults(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x.exe"), (None, "http://b.com/")], "page_id long, url string")
    rules = [UrlRule("block", "executables", r"\.exe\z", ("exe",)), UrlRule("allow", "any b", "b", ())]
    got = {r.url: (r.rule, r.verdict) for r in filter_urls(pages, rules, default="block").collect()}
    assert got == {"http://a.com/x.exe": ("executables", "block"), "http://b.com/": ("any b", "allow")}
    assert [r.verdict for r in filter_urls(pages, [], default="block").collect()] == ["block"] * 2
    assert filter_urls(pages.limit(0), rules).isEmpty()


def test_columns_that_bear_inner_names(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (1, "http://a.com/x"), (None, None)], "page_id long, url string")
    rules = [path_rule(*rule) for rule in URL_RULES]
    names = [*CLASHING, "host", "path", "rule", "verdict", "token", "pattern", "best", "_url", "_part"]
    odd = pages.withColumns({name: F.lit("own") for name in names})
    assert tuples(filter_urls(odd, rules)) == tuples(filter_urls(pages, rules))
    assert filter_urls(odd, rules).count() == 3
