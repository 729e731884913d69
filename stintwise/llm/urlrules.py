"""URL filters: given rules first, then association rules mined from labels by FP-growth.

Given rules are (host, path, verdict).  A rule fits its host and all subdomains if the
URL's path starts with the rule's path; the longest (host and path together, then the
host) wins.  A URL that no given rule fits gets the mined method's verdict.

Mining: every labelled page is a transaction of URL tokens (scheme, host and its parent
domains, first host label, path words with digits masked, file ending, query keys,
fragment) plus an item for its label.  Spark's FP-growth finds the frequent token
combinations; rules ``combination -> bad`` are pruned by support, by confidence, and
against shorter rules of at least their confidence.  Matching is by an inverted index: a
rule is filed under its rarest token, so a URL meets only rules whose rarest token it
has, and then needs the rule's other tokens too.  Different URLs are judged once.

A page's label is that of the document whose number its path holds.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no
rule and is allowed; repeated rows are judged alike, row by row; without labelled pages
(or rules that survive) the method allows everything; an empty table gives an empty
result; other columns than the id and URL are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD = "label:bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def given_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(len(h)).alias("host_size"),
                            F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for h, p, v in rules]
    if not fits:
        return F.lit(None).cast("struct<size: int, host_size: int, rule: string, verdict: string>")
    return F.array_max(F.array_compact(F.array(*fits)))


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL; numbers are masked so that an id is no token."""
    host, path = host_and_path(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    domains = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                          lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(labels, i, n), ".")))
    parts = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""),
                        lambda s: F.concat(F.lit("path:"), F.regexp_replace(s, "[0-9]+", "#")))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.filter(F.split(query, "&"), lambda s: s != ""),
                       lambda s: F.concat(F.lit("query:"), F.substring_index(s, "=", 1)))
    flags = F.array_compact(F.array(
        F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))),
        F.concat(F.lit("first:"), labels[0]),
        F.when(path.endswith("/"), F.lit("ends:/")),
        F.when(url.contains("#"), F.lit("has:#"))))
    all_ = F.array_distinct(F.concat(domains, parts, keys, flags))
    return F.when(host != "", all_).otherwise(F.array().cast("array<string>"))


def page_document(url: Column) -> Column:
    """The document number in a page's path, or null."""
    _, path = host_and_path(url)
    return F.regexp_extract(path, r"/([0-9]{1,18})[^/0-9]*/?$", 1).try_cast("bigint")


def mine_rules(transactions: DataFrame, min_support: float = 0.002, min_count: int = 30,
               min_confidence: float = 0.6) -> DataFrame:
    """``tokens``, ``index_token``, ``confidence``, ``support`` of the rules that point to bad.

    ``transactions``: ``items`` (distinct tokens and, for bad pages, ``BAD``).
    """
    spark = transactions.sparkSession
    n = transactions.count()
    if n == 0:
        return spark.createDataFrame([], "tokens array<string>, index_token string, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_count / n)),
                     minConfidence=min_confidence).fit(transactions)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD))).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    single = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("t"), F.col("freq"))
    filed = (rules.select("tokens", "confidence", "support", F.explode("tokens").alias("t")).join(single, "t")
             .groupBy("tokens", "confidence", "support").agg(F.min(F.struct("freq", "t")).alias("rarest")))
    filed = filed.select("tokens", F.col("rarest.t").alias("index_token"), "confidence", "support")
    # A rule adds nothing beside one with fewer tokens and at least its confidence.
    shorter = filed.select(F.col("tokens").alias("t2"), F.col("index_token").alias("k2"), F.col("confidence").alias("c2"))
    inside = (filed.withColumn("k2", F.explode("tokens")).join(shorter, "k2")
              .where((F.size("t2") < F.size("tokens")) & (F.col("c2") >= F.col("confidence"))
                     & (F.size(F.array_except("t2", "tokens")) == 0)))
    return filed.join(inside.select("tokens").distinct(), "tokens", "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``url`` and ``confidence`` of each different URL that a mined rule fits."""
    tokens = urls.select(F.col(url)).where(F.col(url).isNotNull()).distinct().withColumn("_tokens", url_tokens(F.col(url)))
    found = (tokens.withColumn("index_token", F.explode("_tokens")).join(rules, "index_token")
             .where(F.size(F.array_except("tokens", "_tokens")) == 0))
    return found.groupBy(url).agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], mined: DataFrame,
          key: str = "page_id", url: str = "url") -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` and the mined ``confidence`` of every page."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key), F.col(url).cast("string").alias(url))
    rows = rows.select(key, url, host.alias("host"), path.alias("path"))
    rows = rows.withColumn("_given", given_rule(F.col("host"), F.col("path"), rules))
    hits = match_rules(rows.where(F.col("_given").isNull()), mined, url)
    return rows.join(hits, url, "left").select(
        key, "host", "path", F.col("_given.rule").alias("rule"),
        F.coalesce(F.col("_given.verdict"), F.when(F.col("confidence").isNotNull(), F.lit("block")),
                   F.lit("allow")).alias("verdict"),
        "confidence")


def labelled_transactions(pages: DataFrame, labels: DataFrame, url: str = "url") -> DataFrame:
    """``items`` of every page whose document has a label; bad: quality 0 or toxic 1."""
    bad = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))
    marks = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("_doc"))
             .agg(F.max(bad).alias("_bad")))
    rows = pages.select(F.col(url).cast("string").alias("_url")).withColumn("_doc", page_document(F.col("_url")))
    items = F.concat(url_tokens(F.col("_url")), F.when(F.col("_bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>")))
    return rows.join(marks, "_doc").select(items.alias("items")).where(F.size("items") > 0)
