"""URL filter: a trie over reversed host labels and path segments.

Rules are (verdict, host, path).  A rule fits its host and all subdomains
when the url's path starts with the rule's path; of the rules that fit,
the longest wins: most host labels, then the longest path; of an allow and
a block rule for the same host and path the allow rule wins.  Urls that no
rule fits get the default verdict.

The rules become a trie (host labels from the right, then whole path
segments; what follows a rule path's last ``/`` is compared as a prefix of
the next segment) that is broadcast up to ``MAX_BROADCAST_RULES`` rules;
beyond that the urls' (host suffix, path segments) prefixes are joined
with the rules by an ordinary shuffle.

Defined results: a null url, or one without ``://``, has an empty host and
path, no rule and the default verdict; repeated rows are judged each;
an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import string

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendscope.llm.common import Scratch

MAX_BROADCAST_RULES = 200_000  # some 100 bytes each
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return ascii_lower(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def build_trie(rules) -> dict:
    """Nodes are dicts of children; under None a node has its rules, as
    [(start of the next segment, rule text, verdict)], longest start first."""
    trie: dict = {}
    for verdict, host, path in rules:
        node = trie
        for label in reversed(host.split(".")):
            node = node.setdefault(("h", label), {})
        *whole, rest = path.split("/")
        for segment in whole:
            node = node.setdefault(("p", segment), {})
        node.setdefault(None, []).append((rest, host + path, verdict))

    def order(node: dict) -> None:
        for key, child in node.items():
            if key is None:
                child.sort(key=lambda r: (-len(r[0]), r[2]))
            else:
                order(child)

    order(trie)
    return trie


def longest_match(trie: dict, host: str, path: str) -> tuple[str | None, str | None]:
    """(rule, verdict) of the deepest host node with a fitting rule."""
    nodes, node = [], trie
    for label in reversed(host.split(".")):
        node = node.get(("h", label))
        if node is None:
            break
        nodes.append(node)
    segments = path.split("/")
    for node in reversed(nodes):
        best = None
        for segment in segments:
            for rest, rule, verdict in node.get(None, ()):
                if segment.startswith(rest):
                    best = (rule, verdict)
                    break
            node = node.get(("p", segment))
            if node is None:
                break
        if best:
            return best
    return None, None


def filter_urls(df: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
                max_broadcast_rules: int = MAX_BROADCAST_RULES) -> DataFrame:
    """``id_col``, host, path, rule (null: none fits), verdict of every row."""
    host, path = host_and_path(F.col(url_col))
    urls = df.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rules = [(v, h, p) for v, h, p in rules]
    if len(rules) > max_broadcast_rules:
        return _by_join(urls, rules, id_col, default)
    trie = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def judge(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([longest_match(trie.value, h, p) for h, p in zip(host, path)], columns=["rule", "verdict"])

    return urls.withColumn("m", judge("host", "path")) \
        .select(id_col, "host", "path", "m.rule", F.coalesce("m.verdict", F.lit(default)).alias("verdict"))


def _by_join(urls: DataFrame, rules, id_col: str, default: str) -> DataFrame:
    """The same for more rules than are broadcast: every url meets the rules
    under each of its (host suffix, whole segments) prefixes."""
    spark = urls.sparkSession
    split = [(h + "\n" + p.rpartition("/")[0], p, h + p, v, h.count(".")) for v, h, p in rules]
    table = spark.createDataFrame(split, "place string, rule_path string, rule string, verdict string, labels int")
    rows = Scratch(spark, "url-filter").table(urls.withColumn("__row", F.monotonically_increasing_id()), "urls")
    labels, segments = F.split("host", "\\."), F.split("path", "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    heads = F.transform(F.sequence(F.lit(1), F.size(segments)),
                        lambda i: F.array_join(F.slice(segments, F.lit(1), i - 1), "/"))
    places = rows.withColumn("h", F.explode(suffixes)).withColumn("p", F.explode(F.array_distinct(heads))) \
        .withColumn("place", F.concat_ws("\n", "h", "p"))
    fits = places.join(table, "place").where(F.startswith("path", "rule_path")) \
        .groupBy("__row").agg(F.max_by(F.struct("rule", "verdict"), F.struct(
            "labels", F.length("rule_path"), (F.col("verdict") == "allow"))).alias("m"))
    return rows.join(fits, "__row", "left") \
        .select(id_col, "host", "path", "m.rule", F.coalesce("m.verdict", F.lit(default)).alias("verdict"))
