"""URL filters: stated rules first, then rules mined from labelled URLs by FP-growth.

A URL is a set of tokens: its host, the last two labels of the host, words of a hyphenated host, first path segment (digits
as one sign), file extension, and query keys. The label of a URL is that of the document whose number its path ends with:
``block`` if it is of low quality or toxic. Spark's FP-growth finds frequent sets of tokens and label; a set with enough
confidence for ``block`` becomes a rule. Single tokens and pairs are counted exactly besides, so that a host with few URLs gets the same
verdict in a table of any size. Rules are matched by an inverted index: a rule is filed under its rarest token, joined
to the URLs that have this token, and holds if they have all its tokens.

A null url, or one without ``://``, has an empty host and path, no tokens, no rule, and is allowed. Repeated rows (same page_id
and url) get the same verdict. Without labels there are no mined rules, and what no stated rule fits is allowed.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import common as C

# Host, path and verdict of the stated rules.
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
SUPPORT = 0.001
CONFIDENCE = 0.6
LEAST_URLS = 5  # labelled URLs of label block that a rule must rest on, however many there are
BLOCK = "=block"


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), "^[^/?#]*([^?#]*)", 1)


def stated(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest stated rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(RULES, key=lambda r: len(r[0] + r[1])):  # longer ones later, so that they win
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    def tagged(tag: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.concat(F.lit(tag), v))

    first = F.regexp_replace(F.regexp_extract(path, "^/([^/]*)", 1), "[0-9]+", "#")
    ext = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda kv: F.split_part(kv, F.lit("="), F.lit(1)))
    one = F.array
    every = F.concat(
        tagged("h:", one(host)),
        tagged("d:", one(F.substring_index(host, ".", -2))),
        tagged("w:", F.when(F.instr(host, "-") > 0, F.split(host, "[.-]")).otherwise(F.array().cast("array<string>"))),
        tagged("p:", one(first)), tagged("x:", one(ext)), tagged("q:", keys),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.filter(F.coalesce(every, F.array().cast("array<string>")), lambda t: F.length(t) > 2)))


def labelled(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """tokens and block of the URLs whose path ends with the number of a labelled document."""
    number = F.try_to_number(F.regexp_extract("path", r"([0-9]{1,18})[^0-9]*$", 1), F.lit("9" * 18)).cast("long")
    verdicts = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max((F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")).alias("block"))
    return pages.withColumn("doc_id", number).filter("doc_id is not null").join(verdicts, "doc_id").select("tokens", "block")


def counted(urls: DataFrame) -> DataFrame:
    """antecedent, all (URLs that have it) and support (those of label block) of every single token and every pair of tokens, counted exactly.

    A URL has some dozen tokens, whatever its length, so a few dozen rows each are summed within the tasks before they are shuffled."""
    pairs = F.expr("flatten(transform(tokens, (a, i) -> transform(slice(tokens, i + 2, size(tokens)), b -> array_sort(array(a, b)))))")
    sets = F.concat(F.transform("tokens", lambda t: F.array(t)), pairs)
    rows = urls.filter(F.size("tokens") > 0).select(F.explode(sets).alias("antecedent"), "block")
    return rows.groupBy("antecedent").agg(F.count("*").alias("all"), F.sum("block").cast("long").alias("support"))


def mine(urls: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least: int = LEAST_URLS) -> DataFrame | None:
    """Rules for block: antecedent (array of tokens), key (its rarest token), confidence, support (URLs). None without labelled URLs.

    FP-growth gives sets of any size that a share ``support`` of the labelled URLs has; its bound keeps what it gathers small. Single
    tokens and pairs, all that a rare host has, are counted for themselves, so a rule of these needs ``least`` URLs at any size of the table."""
    from pyspark.ml.fpm import FPGrowth

    urls = C.settle(urls.filter(F.size("tokens") > 0))
    if urls.isEmpty():
        return None
    sets = urls.select(F.when(F.col("block") == 1, F.array_append("tokens", F.lit(BLOCK))).otherwise(F.col("tokens")).alias("items"))
    frequent = C.settle(FPGrowth(itemsCol="items", minSupport=support).fit(sets).freqItemsets.select(F.array_sort("items").alias("items"), "freq"))
    both = frequent.filter(F.array_contains("items", BLOCK) & (F.size("items") > 3)).select(F.array_remove("items", BLOCK).alias("antecedent"), F.col("freq").alias("support"))
    alone = frequent.filter(~F.array_contains("items", BLOCK)).select(F.col("items").alias("antecedent"), F.col("freq").alias("all"))
    small = C.settle(counted(urls).filter(F.col("all") >= least))
    rules = both.join(alone, "antecedent").unionByName(small).withColumn("confidence", F.col("support") / F.col("all"))
    rules = rules.filter((F.col("confidence") >= confidence) & (F.col("support") >= least))
    single = small.filter(F.size("antecedent") == 1).select(F.element_at("antecedent", 1).alias("token"), F.col("all").alias("freq"))
    rarest = rules.select("antecedent", F.explode("antecedent").alias("token")).join(single, "token").groupBy("antecedent").agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    return C.settle(rules.join(rarest, "antecedent").select("antecedent", "key", "confidence", "support"))


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, url and the confidence of the best rule that holds; only rows for which one does."""
    by_token = pages.select("page_id", "url", "tokens", F.explode("tokens").alias("key"))
    holds = F.size(F.array_except("antecedent", "tokens")) == 0
    return by_token.join(rules, "key").filter(holds).groupBy("page_id", "url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and the confidence of the mined rule that decided (else null)."""
    rows = pages.select("page_id", "url").withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rows = rows.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))
    rules = mine(labelled(rows, labels))
    rule, verdict = stated(F.col("host"), F.col("path"))
    rows = rows.select("page_id", "url", "host", "path", "tokens", rule.alias("rule"), verdict.alias("said"))
    if rules is None:
        found = rows.withColumn("confidence", F.lit(None).cast("double"))
    else:
        best = matched(rows.filter("rule is null"), rules).withColumnsRenamed({"page_id": "p", "url": "u"})
        found = rows.join(best, F.col("page_id").eqNullSafe(F.col("p")) & F.col("url").eqNullSafe(F.col("u")) & F.col("rule").isNull(), "left")
    return found.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"), "confidence")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(C.table(spark, sf_dir, "pages"), C.table(spark, sf_dir, "labels"))
