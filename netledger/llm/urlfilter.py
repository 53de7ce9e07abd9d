"""URL filters: a blocked Bloom filter in front of an exact hash join.

Listed URLs are brought to canonical form and hashed. The hash picks one 64-bit block of the filter and
``bits`` bits in it; the filter is the bitwise or of the listed masks per block. It has at most
``max_blocks`` blocks, so the broadcast side is at most 16 MB however long the list is (a longer list passes more
false positives, no fewer hits). A page whose bits are all set goes on to a hash join with the listed URLs
themselves, which removes false positives; all other pages never leave their task. URLs that more than a part's rows share are
counted before; their rows go to as many parts as they need, and the listed URL is copied to each. The list is written once in canonical form.

Rules of (verdict, host, path) come first: a rule fits its host and all subdomains of it where the path
starts with the rule's; the longest fitting rule (host and path together) decides.

Only built-in column functions run here. Defined results: null or ``://``-less URLs have an empty host and path, fit no
rule, are not listed and are allowed; repeated rows keep their rows; an empty list allows all that no rule blocks; of fitting rules of
equal length, which the same host and path make equal, the one given last decides; very long URLs are hashed and compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netledger.llm.common import aside, besides, marked, placed, written
from netledger.operators.joins import JoinPolicy, Spread, attach

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From after the first :// up to /, ?, # or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(_after(url), r"^([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def canonical(url: Column) -> Column:
    """Host without scheme, www. or m., path without a last slash or .html; no query, no fragment. Null without a host."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"\.html$", ""), "/$", "")
    return F.when(host != "", F.concat(host, path))


def ruled(pages: DataFrame, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest fitting rule; null if none fits. Rules are a short fixed list."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], url: str = "url",
                listed_url: str = "url", bits: int = 6, urls_per_block: int = 5, max_blocks: int = 1 << 20,
                policy: JoinPolicy = JoinPolicy(), keep: list[str] | None = None) -> DataFrame:
    """Pages with host, path, rule, listed and verdict."""
    names = ["host", "path", "rule", "listed", "verdict"]
    passed_on = besides(names, pages.columns if keep is None else keep)
    keep = placed(passed_on)
    urls = written(listed.select(canonical(F.col(listed_url)).alias("_url")).filter("_url IS NOT NULL").distinct(), "listed")
    asked = pages.select(*aside(passed_on), F.col(url).alias("_asked")).withColumns(
        {"host": host_of(F.col("_asked")), "path": path_of(F.col("_asked")), "_url": canonical(F.col("_asked"))})
    asked = asked.withColumn("_rule", ruled(asked, rules))
    passed = marked(asked, "_url", urls, "_url", "_may", bits, urls_per_block, max_blocks)
    may = passed.filter("_may")
    spread = Spread(may, ["_url"], "_part", policy, mark=["_asked"])
    hits = attach(may, urls.withColumn("listed", F.lit(True)), ["_url"], False, spread)
    columns = [*keep, "host", "path", "_rule", F.coalesce("listed", F.lit(False)).alias("listed")]
    out = hits.select(columns).union(
        passed.filter("NOT _may").withColumn("listed", F.lit(False)).select(columns))
    verdict = F.coalesce("_rule.verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return out.select(*keep, "host", "path", "_rule.rule", "listed", verdict).toDF(*passed_on, *names)
