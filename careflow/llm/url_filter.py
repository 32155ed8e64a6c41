"""URL filter: host-suffix and path-prefix expressions, joined on short hash prefixes of rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of a digest that the equi-join uses; the full digest confirms.
PREFIX_DIGITS = 8


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = _rest(url)
    return _lower(F.regexp_extract(rest, r"\A[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"\A[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))


def _lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def _digest(host: Column, path: Column) -> Column:
    # A host holds no slash and a path is empty or starts with one: the text names both.
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id, url``).

    ``rules`` has ``host, path, verdict``.  A rule fits its host and all subdomains if the path
    starts with the rule's; the longest host and path together wins, then the longer host, then
    ``block``.  Without a rule the verdict is ``default``.  Null urls and urls without ``://`` have
    empty host and path and no rule; null ids and repeated rows stay, one result per row; other
    columns are ignored.  Rules with a null part are ignored; an empty rule table fits nothing.  A long url is
    cut to as many labels and path lengths as rules have; an empty table gives no row.
    """
    named = (
        rules.select("host", "path", "verdict").dropna().distinct()
        .select(
            _lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"),
            F.col("verdict").alias("rule_verdict"))
        .withColumn("rule_digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))
    )
    # Which expressions can fit at all: label counts of hosts and lengths of paths in the rules.
    shape = named.agg(
        F.coalesce(F.max(F.size(F.split("rule_host", r"\."))), F.lit(0)).alias("labels"),
        F.array_sort(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # Each host and path is judged once, however many pages have it.
    urls = parsed.select("host", "path").distinct()
    if not shape["lengths"]:
        return _result(parsed, urls.withColumn("best", F.lit(None).cast("struct<rule_verdict:string,rule:string>")), default)
    labels = F.split("host", r"\.")
    kept = F.least(F.size(labels), F.lit(shape["labels"]))
    suffixes = F.transform(
        F.sequence(F.lit(1), kept),
        lambda n: F.array_join(F.slice(labels, -n, n), "."))
    lengths = F.filter(
        F.array(*[F.lit(n) for n in shape["lengths"]]), lambda n: n <= F.length("path"))
    prefixes = F.transform(lengths, lambda n: F.substring(F.col("path"), F.lit(1), n))
    expressions = F.flatten(F.transform(
        suffixes, lambda h: F.transform(prefixes, lambda p: _digest(h, p))))
    best = F.max(F.when(F.col("rule_digest") == F.col("digest"), F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"),
        F.length("rule_host").alias("host_size"), F.col("rule_verdict"),
        F.concat("rule_host", "rule_path").alias("rule"))))
    judged = (
        urls.withColumn("digest", F.explode_outer(expressions))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
        .join(named, "prefix", "left")
        .groupBy("host", "path").agg(best.alias("best"))
    )
    return _result(parsed, judged, default)


def _result(parsed: DataFrame, judged: DataFrame, default: str) -> DataFrame:
    """One row per page; pages of one url that is very frequent stay spread, as a join can be split."""
    return parsed.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict"))
