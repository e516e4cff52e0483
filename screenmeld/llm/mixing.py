"""Mixing sources to target weights by Pareto order sampling.

Targets: sources in code point order (NULL last) take ``weights`` in turn and share
``share`` times all words; a target stops at ``most`` times its source's words and the excess
is shared again by weight until no target is above.

Sampling: a document of a source is to be taken ``rate = min(most, c * 2 ** (lean * floor(log2(words))))`` times on average, so
longer texts, which carry more context, come more often, and ``c`` is such that the rates meet the target: classes of length
are filled from the longest down, those that reach ``most`` stop there. ``lean = 0`` gives all documents of a source one rate.
The whole part of a rate is certain; its fraction ``f`` is an inclusion probability. Documents with a fraction are ranked by
``odds(u) / odds(f)`` with a draw ``u`` fixed by doc_id and seed, and the ranking is taken up to the
source's remaining words (the fixed size). The words left over there are filled by the one document
behind the cut whose size comes nearest, if that brings the total closer.

Nothing is gathered per source: rates need one sum per class of length (64 at most), and the cut is found by two rounds of 256
partial sums, so a window only sees a 1/65,536 share of a source. Defined cases: a NULL text has size 0; NULL source is one
source; rows with equal doc_ids share a draw; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.llm.text import join_small, numbered, word_count
from screenmeld.session import stage

DIGITS = 256
LEVELS = 2


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
                   most: float = 2.0) -> tuple[DataFrame, int]:
    """``source, source_size, target`` from rows ``source, size``, and the number of sources."""
    sources = numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")),
                       F.col("source").isNull(), F.col("source"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights)).cast("int"))
    sources = stage(sources.select("source", "source_size", weight.alias("weight")), "sources")
    count, total = sources.agg(F.count("*"), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    level, full = 0.0, -1
    while True:  # the level only rises, so each round caps at least one more source or ends
        capped = F.col("weight") * level > most * F.col("source_size")
        n, words, rest = sources.agg(
            F.count(F.when(capped, 1)), F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0))).first()
        if n == full or not rest:
            break
        full, level = n, (share * total - most * words) / rest
    target = F.when(capped, most * F.col("source_size")).otherwise(F.col("weight") * level)
    return sources.select("source", "source_size", target.cast("double").alias("target")), count


def inclusion_rates(sizes: DataFrame, targets: DataFrame, most: float, lean: float) -> DataFrame:
    """``source, class, rate`` with the source's size and target: how often a document of a class of length is to be taken."""
    words = sizes.filter("size > 0").groupBy("source", "class").agg(F.sum("size").alias("words"))
    weight = F.pow(F.lit(2.0), F.lit(lean) * F.col("class"))
    longest = Window.partitionBy("source").orderBy(F.desc("class"))
    every = Window.partitionBy("source")
    above = F.sum("words").over(longest) - F.col("words")  # words of longer classes, were they all at the limit
    weighed = F.col("words") * F.col("weight")
    rest = F.sum(weighed).over(longest.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = F.greatest((F.col("target") - most * F.col("above")) / F.col("rest"), F.lit(0.0))
    # the longest class that stays within the limit sets the level of all; where none does, all are at it
    within = F.col("level") * F.col("weight") <= most
    first = F.min_by(F.when(within, F.col("level")), F.when(within, -F.col("class"))).over(every)
    return (words.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
            .withColumn("weight", weight).withColumn("above", above).withColumn("rest", rest).withColumn("level", level)
            .withColumn("rate", F.coalesce(F.least(F.lit(float(most)), first * F.col("weight")), F.lit(float(most))))
            .select("source", "class", "source_size", "target", "words", "rate"))


def sample_plan(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5,
                most: float = 2.0, seed: int = 42, lean: float = 0.25) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, rate, copies, taken``."""
    draw = ((F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 11) + F.lit(0.5)) / float(1 << 53))
    size_class = F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int")
    sized = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw.alias("draw"))
                  .withColumn("class", size_class), "sized")
    targets, count = source_targets(sized, weights, share, most)
    targets = stage(targets, "targets")
    rates = stage(inclusion_rates(sized, targets, most, lean), "rates")
    fraction = F.col("rate") - F.floor("rate")
    quotas = rates.groupBy("source").agg(F.sum(fraction * F.col("words")).alias("quota"))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    known = rates.select(F.col("source").alias("s"), F.col("class").alias("c"), "rate")
    placed = join_small(sized, known, known.count(), sized["source"].eqNullSafe(F.col("s"))
                        & (F.col("class") == F.col("c")) & (F.col("size") > 0), "left")
    u, f = F.col("draw"), F.col("fraction")
    rank = u * (1 - f) / (u * (1 - f) + f * (1 - u))  # Q / (1 + Q), in the order of Q
    plan = stage(placed.withColumn("rate", F.coalesce("rate", F.lit(0.0))).withColumn("fraction", fraction)
                 .select("doc_id", "source", "size", "rate", F.when(f > 0, rank).alias("rank")), "ranked")
    ranked = plan.filter("rank IS NOT NULL")

    cuts = quotas.select("source", "quota", F.lit(0.0).alias("before"), F.lit(0).cast("long").alias("prefix"))
    for k in range(LEVELS):
        at = ranked.withColumn("digit", F.floor(F.col("rank") * DIGITS ** (k + 1)))
        here = (join_small(at, cuts, count, same(at, cuts) & (F.floor(at["rank"] * DIGITS**k) == cuts["prefix"]))
                .groupBy(at["source"], "quota", "before", "digit").agg(F.sum("size").alias("words")))
        ahead = Window.partitionBy("source").orderBy("digit")
        cuts = stage(here.withColumn("upto", F.col("before") + F.sum("words").over(ahead))
                     .filter(F.col("upto") > F.col("quota"))
                     .withColumn("first", F.row_number().over(ahead)).filter("first = 1")
                     .select("source", "quota", (F.col("upto") - F.col("words")).alias("before"),
                             F.col("digit").alias("prefix")), "cuts")
    inside = (join_small(ranked, cuts, count, same(ranked, cuts)
                         & (F.floor(ranked["rank"] * DIGITS**LEVELS) == cuts["prefix"]))
              .select(ranked["source"], "size", "rank", "quota", "before"))
    upto = F.col("before") + F.sum("size").over(Window.partitionBy("source").orderBy("rank"))
    fits = F.col("upto") <= F.col("quota")
    edge = (inside.withColumn("upto", upto).groupBy("source")
            .agg(F.max(F.when(fits, F.col("rank"))).alias("last"),
                 F.max(F.when(fits, F.col("upto"))).alias("upto")))
    # sources without a cut take every document; a cut before the first row of its share ends there
    floor_ = F.col("prefix") / float(DIGITS**LEVELS)
    edge = stage(cuts.join(edge.withColumnRenamed("source", "s"), cuts["source"].eqNullSafe(F.col("s")), "left")
                 .select("source", F.coalesce("last", floor_).alias("last"), F.col("last").isNotNull().alias("closed"),
                         (F.col("quota") - F.coalesce("upto", "before")).alias("rest")), "edges")
    taken = F.when(F.col("closed"), F.col("rank") <= F.col("last")).otherwise(F.col("rank") < F.col("last"))

    gap = F.abs(F.col("rest") - F.col("size"))
    behind = (join_small(ranked, edge, count, same(ranked, edge))
              .select(ranked["source"], "rank", gap.alias("gap"), "rest", taken.alias("in"))
              .filter(~F.col("in") & (F.col("gap") < F.col("rest"))))
    nearest = stage(behind.groupBy("source").agg(F.min("gap").alias("gap")), "gaps")
    filler = (join_small(behind, nearest.withColumnRenamed("source", "s"), count,
                         behind["source"].eqNullSafe(F.col("s")) & (behind["gap"] == nearest["gap"]))
              .groupBy("source").agg(F.min("rank").alias("filler")))
    edge = stage(edge.join(filler.withColumnRenamed("source", "s"), edge["source"].eqNullSafe(F.col("s")), "left").drop("s"),
                 "rules")
    rules = targets.join(edge.withColumnRenamed("source", "s"), targets["source"].eqNullSafe(F.col("s")), "left").drop("s")
    rows = join_small(plan, rules, count, same(plan, rules)).select(plan["*"], *[
        rules[c] for c in ("source_size", "target", "last", "closed", "filler")])
    extra = F.when(F.col("last").isNull(), F.col("rank").isNotNull()).otherwise(
        F.coalesce(taken | (F.col("rank") == F.col("filler")), taken, F.lit(False)))
    copies = F.floor("rate") + F.when(extra, 1).otherwise(0)
    return rows.select("doc_id", "source", "size", "source_size", "target", "rate", copies.cast("long").alias("copies"),
                       (copies * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the plan takes it, columns as they are.

    Rows that share a doc_id share a plan; documents without words are kept out.
    """
    plan = sample_plan(docs, **settings).groupBy(F.col("doc_id").alias("_doc")).agg(F.max("copies").alias("_n"))
    joined = docs.join(plan.filter("_n > 0"), docs["doc_id"].eqNullSafe(F.col("_doc")))
    return (joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
            .select(*[docs[c] for c in docs.columns]))
