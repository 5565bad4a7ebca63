"""URL rules by hash-prefix lookup.

Each url is expanded into pairs of a host suffix (of as many labels as rules have) and a path prefix (of the lengths that rules have).
The pairs meet the rules in an equi-join on the first four bytes of their SHA-256; the full digests and the
strings confirm, and the longest rule decides.

Urls are reduced to different (host, path) pairs before they are expanded, so a url that fills a third of the table
costs one expansion; what is joined back is one row for each different pair.

Precedence: the longer host + path wins, then the longer host, then ``block``. Defined cases: a null url or one without
``://`` has an empty host and path; a host or path no rule fits gets no rule and the verdict ``default``; repeated and null
ids are rows of their own; repeated rules count once; rules with a null part fit nothing; an empty rule table gives the default; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import LOWER, UPPER


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path), 256))


def verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``rules``: host, path, verdict. Columns: the id, host, path, rule, verdict."""
    rules = (rules.select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
             .dropna().groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
             .withColumn("r_digest", digest(F.col("r_host"), F.col("r_path"))))
    # as many rows as there are different lengths of rule paths, bounded by the longest of them
    lengths = sorted(r[0] for r in rules.select(F.char_length("r_path")).distinct().collect())
    urls = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    pairs = urls.select("host", "path").distinct()
    # likewise only suffixes of as many labels as some rule's host has, however many the url's host has
    counts = sorted(r[0] for r in rules.select(F.size(F.split("r_host", r"\."))).distinct().collect())
    pairs = pairs.withColumn("labels", F.split("host", r"\."))
    labels = F.col("labels")
    suffixes = F.transform(F.filter(F.array(*[F.lit(n) for n in counts]).cast("array<int>"), lambda n: n <= F.size(labels)),
                           lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."))
    prefixes = F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    forms = (pairs.select("host", "path", F.explode(F.array_distinct(suffixes)).alias("suffix"))
             .select("host", "path", "suffix", F.explode(prefixes).alias("prefix"))
             .withColumn("digest", digest(F.col("suffix"), F.col("prefix"))))
    short = lambda c: F.substring(F.col(c), 1, 4)
    fits = (forms.withColumn("p", short("digest")).join(rules.withColumn("p", short("r_digest")), "p")
            .filter("digest = r_digest AND suffix = r_host AND prefix = r_path"))
    rank = F.struct(F.char_length(F.concat("r_host", "r_path")).alias("n"), F.char_length("r_host").alias("h"), F.col("r_verdict").alias("v"), "r_host", "r_path")
    best = fits.groupBy("host", "path").agg(F.max(rank).alias("best"))
    return (urls.join(best, ["host", "path"], "left")
            .select(F.col("id").alias(id_col), "host", "path", F.concat("best.r_host", "best.r_path").alias("rule"),
                    F.coalesce("best.v", F.lit(default)).alias("verdict")))
