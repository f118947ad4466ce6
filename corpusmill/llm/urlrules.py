"""URL filters: given host and path rules, and rules mined from labelled URLs.

A given rule is a host and a path, such as ``example.net/en/``; it fits the host and
its subdomains if the URL's path starts with the rule's path, and the longest fitting
rule decides.  URLs that no rule fits are judged by association rules: Spark's
FP-growth mines combinations of URL tokens from labelled URLs, rules that conclude
"block" are pruned by support, confidence and redundancy (a rule says nothing new if
a part of it is as confident), and an inverted index from a rule's rarest token
finds the rules whose tokens a URL has.  It is blocked if one fits.

Tokens of a URL: the host's labels and the parts of those with hyphens, path words,
query names and whether it ends in a fragment; numbers become ``0``.

Scale: DataFrame functions and JVM FP-growth only.  Verdicts are made for distinct
token sets and joined back, so one host with a third of all pages costs one row; the
join back is skewed on one side only and can be split.  Mined rules are a table,
joined on the rarest token; the least number of bad URLs is the same at every size, so
frequent itemsets grow with the labelled URLs (README has the cost).  Given rules are a list in code, looked up by host suffix.

Defined results: the host and path of a null URL, or one without ``://``, are empty;
it has no tokens, and no rule fits.  A null label is no label; a URL with several
labels counts once for each.  Without labelled URLs nothing is mined and the method
allows all.  Repeated rows get equal verdicts; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import lower_ascii, stored

#: A mined rule holds for this many bad URLs at least, however many are labelled.  A share of
#: the labelled URLs can be asked for besides; there is none, as it would drop hosts as the input grows ...
LEAST_SUPPORT, LEAST_COUNT = 0.0, 5
#: ... and this share of those with its tokens are bad.
LEAST_CONFIDENCE = 0.5
_BAD = "=bad"


@dataclass(frozen=True)
class Given:
    rule: str     #: host and path, such as ``org/fr/``
    verdict: str  #: ``allow`` or ``block``

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The lower-cased host, and the path, of a URL; empty if it has none."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return (F.coalesce(lower_ascii(F.regexp_extract(url, pattern, 1)), F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit("")))


def tokens(url: Column) -> Column:
    """The distinct tokens of a URL, sorted; each tells its part of the URL."""
    host, path = host_and_path(url)
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    end = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^#]*(#).*", 1), F.lit(""))

    labels = F.regexp_replace(host, r"^.*@|:.*$", "")

    def words(mark: str, text: Column, cut: str) -> Column:
        clean = F.filter(F.split(F.regexp_replace(text, r"\d+", "0"), cut), lambda w: w != "")
        return F.transform(clean, lambda w: F.concat(F.lit(mark), w))

    return F.array_sort(F.array_distinct(F.concat(
        words("h:", labels, r"\."), words("h:", F.regexp_replace(labels, r"(?:^|\.)[^-.]*(?=\.|$)", ""), "[-.]"), words("p:", lower_ascii(path), "/"),
        words("q:", F.regexp_replace(lower_ascii(query), r"=[^&]*", ""), "&"), F.when(end != "", F.array(F.lit("e:#"))).otherwise(F.array().cast("array<string>")))))


def mine(labelled: DataFrame, least_support: float = LEAST_SUPPORT, least_count: int = LEAST_COUNT,
         least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """``(rule, items, rarest, confidence, support)`` from ``labelled`` (``url``, ``bad``).

    A rule needs ``least_count`` bad URLs, the same at every size.  Each of its tokens is
    then in so many bad URLs; FP-growth reads only these tokens of each URL, and the mark
    of a bad one.
    """
    spark = labelled.sparkSession
    known = stored(labelled.where("bad IS NOT NULL").select(tokens(F.col("url")).alias("tokens"), "bad"), "labelled-urls")
    count = known.count()
    schema = "rule string, items array<string>, rarest string, confidence double, support double"
    if not count:
        return spark.createDataFrame([], schema)
    least = max(least_count, math.ceil(round(least_support * count, 6)), 1)
    if least > count:
        return spark.createDataFrame([], schema)
    numbered = known.withColumn("row", F.monotonically_increasing_id())
    each = numbered.select("row", "bad", F.explode("tokens").alias("token"))
    usable = each.where("bad").groupBy("token").count().where(F.col("count") >= least).select("token")
    kept = each.join(usable, "token").groupBy("row", "bad").agg(F.collect_list("token").alias("tokens"))
    baskets = stored(kept.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(_BAD))).otherwise(F.col("tokens")).alias("items")), "url-baskets")
    of = baskets.count()
    if of < least:
        return spark.createDataFrame([], schema)
    # FP-growth rounds the product with the number of baskets up: half a basket less gives ``least`` exactly
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / of, minConfidence=least_confidence,
                     numPartitions=int(spark.conf.get("spark.sql.shuffle.partitions"))).fit(baskets)
    found = stored(model.associationRules.where(F.array_contains("consequent", _BAD)).select(
        F.array_sort("antecedent").alias("items"), F.round("confidence", 9).alias("confidence"), F.round(F.col("support") * of / count, 9).alias("support")), "url-rules")
    often = model.freqItemsets.where("size(items) = 1").select(F.col("items")[0].alias("token"), "freq")
    ranked = (found.withColumn("token", F.explode("items")).join(often, "token")
              .groupBy("items", "confidence", "support").agg(F.min(F.struct("freq", "token"))["token"].alias("rarest"))
              .withColumn("rule", F.array_join("items", " ")))
    ranked = stored(ranked.select("rule", "items", "rarest", "confidence", "support"), "url-rules")
    # redundant: another rule, as confident, has a part of its tokens
    part = fitting(ranked.select("rule", F.col("items").alias("tokens"), F.col("confidence").alias("own")), ranked)
    redundant = part.where("rule <> fits AND confidence >= own").select("rule").distinct()
    return stored(ranked.join(redundant, "rule", "left_anti"), "url-rules")


def fitting(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Each row of ``sets`` (with an array ``tokens``) with each rule (``fits``, ``confidence``)
    whose tokens it has, by the inverted index from a rule's rarest token."""
    index = rules.select(F.col("rarest").alias("token"), F.col("rule").alias("fits"), F.col("items").alias("needed"), "confidence")
    return (sets.withColumn("token", F.explode("tokens")).join(index, "token")
            .where(F.size(F.array_except("needed", "tokens")) == 0).drop("token", "needed"))


def given_rule(host: Column, path: Column, given: list[Given]) -> Column:
    """The longest fitting rule as ``struct<rule, verdict>``, else null. Of equal length: the longer host, then the smaller rule."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for g in sorted(given, key=lambda g: (len(g.rule), len(g.host), g.rule)):
        # host = h or ends with .h; rules are a short list, tried longest last so that it wins
        fits = ((host == g.host) | host.endswith("." + g.host)) & path.startswith(g.path)
        out = F.when(fits, F.struct(F.lit(g.rule).alias("rule"), F.lit(g.verdict).alias("verdict"))).otherwise(out)
    return out


def judge(pages: DataFrame, given: list[Given], rules: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, mined)`` for each page; ``mined`` is the most
    confident mined rule that fits where no given rule does."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), tokens(F.col(url)).alias("tokens"))
    rows = rows.withColumn("given", given_rule(F.col("host"), F.col("path"), given)).withColumn("key", F.md5(F.array_join("tokens", "\n")))
    free = rows.where("given IS NULL").groupBy("key").agg(F.any_value("tokens").alias("tokens"))
    best = (fitting(free, rules).groupBy("key").agg(F.max(F.struct("confidence", "fits"))["fits"].alias("mined")))
    joined = rows.join(best, "key", "left")
    mined = F.when(F.col("given").isNull(), F.col("mined"))
    verdict = F.coalesce(F.col("given.verdict"), F.when(mined.isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return joined.select("page_id", "host", "path", F.col("given.rule").alias("rule"), verdict.alias("verdict"), mined.alias("mined"))
