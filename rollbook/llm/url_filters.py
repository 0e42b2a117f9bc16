"""URL filters: pattern rules found by their rarest literal token."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import literal_rows, rows_again

TOKEN = "[0-9A-Za-z]+"
_URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class UrlRule:
    """A pattern searched in host + path.

    ``tokens`` are runs of ASCII letters and digits that every match holds as whole runs;
    a rule without any is tried on every URL. Of the rules that fit, the one with the
    longest ``name`` decides.
    """

    verdict: str
    name: str
    pattern: str
    tokens: tuple[str, ...] = ()


def path_rule(verdict: str, name: str) -> UrlRule:
    """A rule such as ``example.com/en/``: a host with its subdomains, and a start of the path."""
    host, slash, rest = name.partition("/")
    path = slash + rest
    host = re.sub("[A-Z]", lambda letter: letter[0].lower(), host)
    tokens = re.findall(TOKEN, host)
    in_path = list(re.finditer(TOKEN, path))
    # A run that the rule's path ends in may go on in a URL.
    tokens += [m[0] for m in in_path if m.end() < len(path)]
    if not path:
        tokens = tokens[:-1]
    return UrlRule(verdict, name, rf"\A(?:[^/]*\.)?{_quoted(host)}{_quoted(path)}", tuple(tokens))


def _quoted(text: str) -> str:
    return "".join(c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):x}}}" for c in text)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def _tokens(place: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(place, F.lit(TOKEN), F.lit(0)))


def rule_index(places: DataFrame, rules: list[UrlRule]) -> list[tuple[str | None, int]]:
    """For each rule the one of its tokens that fewest rows of ``places`` hold, and its number.

    Only tokens of rules are counted, and only their counts come to the driver.
    """
    spark = places.sparkSession
    wanted = sorted({token for rule in rules for token in rule.tokens})
    counts = dict.fromkeys(wanted, 0)
    if wanted:
        known = literal_rows(spark, [(token,) for token in wanted], "token string")
        seen = places.select(F.explode(_tokens(F.col("place"))).alias("token"))
        found = seen.join(F.broadcast(known), "token", "left_semi").groupBy("token").count()
        counts |= {row["token"]: row["count"] for row in found.collect()}
    return [
        (min(rule.tokens, key=lambda t: (counts[t], t)) if rule.tokens else None, number)
        for number, rule in enumerate(rules)
    ]


def filter_urls(
    pages: DataFrame,
    rules: list[UrlRule],
    *,
    default: str = "allow",
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``page_id, url, host, path, rule, verdict`` for every page.

    Rules are indexed by the token of theirs that is rarest among all URLs. The tokens of a URL
    fetch the rules to try, and only those run their pattern. The longest rule decides, of
    equally long ones the larger name and then verdict; without a rule, ``default``. The
    index is broadcast: it has a row for each rule of the given list.

    A null URL or one without ``://`` has an empty host and path; rules still see it, so
    only a rule that fits nothing but emptiness could judge it. Rows with the same id and URL
    are all returned; null ids stay. Other columns are ignored.
    """
    spark = pages.sparkSession
    places = pages.select(
        F.col(page_id).alias("_id"), F.col(url).alias("_url"),
        url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
    ).withColumn("place", F.concat("host", "path"))
    index = rule_index(places, rules)
    rows = [
        (token if token is not None else "", len(rules[n].name), rules[n].name,
         rules[n].verdict, rules[n].pattern)
        for token, n in index
    ]
    schema = "token string, length int, rule string, verdict string, pattern string"
    rule_rows = literal_rows(spark, rows, schema)
    # The empty token belongs to every URL and fetches the rules that have none.
    keys = F.concat(F.array(F.lit("")), _tokens(F.col("place")))
    tried = places.withColumn("token", F.explode(keys)).join(
        F.broadcast(rule_rows), "token", "left"
    )
    fits = F.expr("place rlike pattern")
    best = F.max(F.when(fits, F.struct("length", "rule", "verdict")))
    untold = max(1, sum(not rule.tokens for rule in rules))
    judged = tried.groupBy("_id", "_url", "host", "path").agg(
        best.alias("best"),
        (F.count_if(F.col("token") == "") / untold).cast("long").alias("copies"),
    )
    return rows_again(judged, "copies").select(
        F.col("_id").alias("page_id"), F.col("_url").alias("url"), "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
