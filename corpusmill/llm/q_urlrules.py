"""Query of URL filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import read
from corpusmill.llm.urlrules import Given, host_and_path, judge, mine

GIVEN = [Given("net/", "block"), Given("example.net/en/", "allow"), Given("example.com/de/", "block"), Given("org/fr/", "allow")]


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``(url, bad)``: a page's path ends with the number of the document that it shows, and labels tell bad documents."""
    path = host_and_path(F.col("url"))[1]
    number = F.regexp_extract(path, r"/(\d{1,18})(?:\.html|/)?$", 1)
    shown = pages.select("url", F.when(number != "", number.cast("long")).alias("shown"))
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.where("quality IS NOT NULL OR toxic IS NOT NULL").select(F.col("doc_id").alias("shown"), bad.alias("bad"))
    return shown.join(known, "shown").select("url", "bad")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL by the given rules, else by rules mined from all labelled URLs."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    rules = mine(labelled_urls(pages, read(spark, sf_dir, "labels")))
    return judge(pages, GIVEN, rules)


#: Mining frequent itemsets has no practical SQL; tests hold the query against brute force.
SQL: dict[str, str] = {}
QUERIES = {"op5_url_rules": op5_url_rules}
