"""URL filter: longest-match rules, and gradient-boosted trees on lexical features for the rest.

Training labels are those of labelled URLs: the decision of a rule where one fits, else ``block``
where the host contains a seed word of spam hosts, else ``allow`` at half weight (background). At most
``SAMPLE`` labelled URLs, lowest hash first, are used for fitting; every URL is judged.

Features: length, host and path depth, digit ratio, character entropy, hyphens, number of parameters, and the
smoothed share of blocked weight among labelled URLs of the host's suffix (a table no larger than the sample).

Defined cases: a NULL url or one without ``://`` has an empty host and path, meets no rule and is judged by its
features; an empty table gives no rows; a sample with a single label gives that label to all.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmeld.llm.text import ascii_lower
from screenmeld.session import stage

#: The rules to apply, and words in host names of advertising farms.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
SEEDS = ("spam", "pills", "casino", "viagra", "porn", "xxx", "bet365", "loan", "replica", "warez")
SAMPLE = 20_000
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789-._/:?=&#%"
FEATURES = ["f_length", "f_host_depth", "f_path_depth", "f_digits", "f_entropy", "f_hyphens", "f_params", "f_suffix"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    part = lambda group: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", group), F.lit(""))
    return ascii_lower(part(1)), part(2)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits; NULL where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, _, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(f"/{rule_path}")
        name = F.when(fits, rule).otherwise(name)
        verdict = F.when(fits, decision).otherwise(verdict)
    return name, verdict


def _lexical(pages: DataFrame) -> DataFrame:
    url, host, path = F.col("_url"), F.col("host"), F.col("path")
    count = lambda text, char: F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))
    size = F.greatest(F.length(url), F.lit(1))
    shares = [count(F.lower(url), c) / size for c in ALPHABET]
    entropy = sum((F.when(p > 0, -p * F.log2(p)).otherwise(0.0) for p in shares), F.lit(0.0))
    return pages.select(
        "page_id", "_url", "host", "path", "rule", "ruled", F.substring_index(host, ".", -1).alias("suffix"),
        F.length(url).cast("double").alias("f_length"), count(host, ".").cast("double").alias("f_host_depth"),
        count(path, "/").cast("double").alias("f_path_depth"),
        (F.length(F.regexp_replace(url, "[^0-9]", "")) / size).alias("f_digits"), entropy.alias("f_entropy"),
        count(host, "-").cast("double").alias("f_hyphens"),
        (F.when(F.instr(url, "?") > 0, 1).otherwise(0) + count(url, "&")).cast("double").alias("f_params"))


def filter_urls(pages: DataFrame, rules=RULES, sample: int = SAMPLE, seed: int = 42) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the probability of ``block`` for every row."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("_url"), host.alias("host"), path.alias("path"))
    rule, ruled = longest_rule(F.col("host"), F.col("path"), rules)
    rows = _lexical(rows.withColumns({"rule": rule, "ruled": ruled}))

    spam = F.col("host").rlike("|".join(SEEDS))
    block = F.when(F.col("ruled").isNotNull(), F.col("ruled") == "block").otherwise(spam)
    weight = F.when(F.col("ruled").isNotNull() | spam, 1.0).otherwise(0.5)
    chosen = stage(rows.select("_url", "suffix", *FEATURES[:-1], block.cast("double").alias("label"),
                               weight.alias("weight"))
                   .orderBy(F.xxhash64(F.lit(seed), F.col("_url")), "_url").limit(sample), "labelled_urls")
    mean, labels = chosen.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight"),
                              F.count_distinct("label")).first()
    if labels < 2:
        return rows.select("page_id", "host", "path", "rule",
                           F.coalesce("ruled", F.lit("block" if mean else "allow")).alias("verdict"),
                           F.lit(float(mean or 0)).alias("block_score"))
    prior = 10.0
    suffixes = chosen.groupBy("suffix").agg(
        ((F.sum(F.col("label") * F.col("weight")) + prior * mean) / (F.sum("weight") + prior)).alias("f_suffix"))
    with_suffix = lambda df: (df.join(F.broadcast(suffixes), "suffix", "left")  # noqa: E731  # bounded by the sample
                              .fillna({"f_suffix": mean}))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    model = GBTClassifier(labelCol="label", weightCol="weight", maxIter=10, maxDepth=4, stepSize=0.3, seed=seed).fit(
        vectors.transform(with_suffix(chosen)))
    scored = model.transform(vectors.transform(with_suffix(rows)))
    verdict = F.coalesce("ruled", F.when(F.col("prediction") > 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"),
                         F.element_at(vector_to_array("probability"), 2).alias("block_score"))
