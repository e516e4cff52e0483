"""Audit of how five quality filters interact. DataFrame operations only.

Filters on a text (NULL: empty) whose words are the maximal runs without ASCII white space:

* A: fewer than 200 words; B: fewer distinct words than half of all; C: more than 2 % letters A-Z;
  D: one of ``#$%&*|``; E: identical to the text of a smaller doc_id of the table.

E comes from an existential self-join: documents left-semi join the texts on hash, exact text and smaller doc_id. Only
documents whose hash occurs twice take part. The other side is pre-aggregated to one row per text with its smallest
doc_id. A hash that holds more than 1/``PARTS`` of all rows is hot; by count there are at most ``PARTS`` of those, so
their list is broadcast. Rows of a hot hash are salted, and its few texts are repeated once per salt.

The ids found that way are united with the ids that fail A to D, summed to one bit combination per id, and counted per part
and combination. All orders of the filters follow from these counts alone: at most 32 rows per part.

Defined cases: a text without words fails A but not B; a text without characters passes C; rows that repeat a doc_id and its text are
one row each, and none makes the other fail E; a NULL doc_id is neither smaller nor larger than any other, so it never fails E and never
makes others fail; documents without a label count as neither good nor toxic, and of several labels any 1 counts; a NULL source is
the part ``''`` (as an empty one is); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmeld.llm.text import SPACE, SPACES, join_small
from screenmeld.session import stage

FILTERS = "ABCDE"
TWICE = 1 << FILTERS.index("E")
#: A hash with more than this share of the rows, one part in ``PARTS``, is salted.
PARTS = 10_000
#: Columns that tell documents apart; rows equal in all of them have the same text and count as often as they occur.
IDENTITY = ["doc_id", "part", "h1", "h2", "chars"]


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D, which look at one text only."""
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.filter(F.split(trimmed, SPACES), lambda w: w != "")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    n, capitals = F.size(words), F.length(text) - F.length(F.translate(text, upper, ""))
    tests = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 2 * F.length(text),
             text.rlike("[#$%&*|]")]
    return reduce(Column.__add__, [F.when(t, 1 << k).otherwise(0) for k, t in enumerate(tests)])


def repeated_texts(docs: DataFrame, hashes: DataFrame, total: int) -> DataFrame:
    """The rows of ``docs`` (identity and ``text``) whose text a smaller doc_id has as well, without the text.

    ``hashes`` has one row ``h1, h2`` per row of ``docs``, ``total`` in number.
    """
    key = ["h1", "h2"]
    limit = max(total // PARTS, 1)  # fewer than twice PARTS hashes can have more rows than this
    shared = stage(hashes.groupBy(*key).count().filter("count > 1")
                   .withColumn("salts", F.ceil(F.col("count") / limit).cast("int")), "shared")
    hot = shared.filter("salts > 1").select(*key, "salts")
    every_salt = F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")
    salts = stage(shared.select(*key, every_salt), "salts")
    dealt = docs.filter("doc_id IS NOT NULL").join(F.broadcast(hot), key, "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"), F.lit(0))).drop("salts")
    same = lambda a, b: reduce(Column.__and__, [a[k] == b[k] for k in (*key, "salt")])
    twins = stage(join_small(dealt, salts, salts.count(), same(dealt, salts), "left_semi"), "twins")
    first = (twins.groupBy(*key, "text").agg(F.min("doc_id").alias("first"))
             .join(F.broadcast(hot), key, "left").select(*key, "text", "first", every_salt))
    smaller = (twins["text"] == first["text"]) & (first["first"] < twins["doc_id"])
    return twins.join(first, same(twins, first) & smaller, "left_semi").select(*IDENTITY)


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, bits, n, good, toxic``: how many documents fail exactly the filters in ``bits``; 0 where all pass."""
    text = F.coalesce("text", F.lit(""))
    named = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.xxhash64(text).alias("h1"),
                        F.xxhash64(F.lit("text"), text).alias("h2"), F.octet_length(text).alias("chars"), text.alias("text"))
    thin = stage(named.select(*IDENTITY, own_failures(F.col("text")).alias("bits")), "failures")
    totals = stage(thin.groupBy("part").agg(F.count("*").alias("n")), "parts")
    total = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    zero = F.lit(0)
    own = thin.filter("bits > 0").select(*IDENTITY, "bits", zero.alias("twice"), F.lit(1).alias("own"), zero.alias("seen"))
    again = repeated_texts(named, thin.select("h1", "h2"), total).select(
        *IDENTITY, zero.alias("bits"), F.lit(TWICE).alias("twice"), zero.alias("own"), F.lit(1).alias("seen"))
    failed = (own.unionByName(again).groupBy(*IDENTITY)
              .agg((F.max("bits") + F.max("twice")).alias("bits"), F.greatest(F.sum("own"), F.sum("seen")).alias("n")))
    known = labels.groupBy("doc_id").agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
                                         F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    marked = failed.join(known, "doc_id", "left")
    counted = stage(marked.groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), zero).alias("good"),
        F.coalesce(F.sum(F.when(F.col("toxic"), F.col("n"))), zero).alias("toxic")), "combinations")
    passed = (totals.unionByName(counted.select("part", (-F.col("n")).alias("n"))).groupBy("part").agg(F.sum("n").alias("n"))
              .select("part", zero.alias("bits"), "n", zero.alias("good"), zero.alias("toxic")))
    return counted.unionByName(passed)


def _places() -> dict[tuple[int, int], list[tuple[str, int]]]:
    """Orders and steps at which a filter is applied after just the filters of a set: (filter, set) to (order, step)."""
    found: dict[tuple[int, int], list[tuple[str, int]]] = {}
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            found.setdefault((bit, before), []).append((order, step))
            before |= bit
    return found


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every part, order of the five filters and step, zeros included."""
    places = _places()
    states = F.array(*[F.struct(F.lit(bit).alias("bit"), F.lit(before).alias("before")) for bit, before in places])
    named = F.create_map(*[x for (bit, before), found in places.items() for x in (
        F.lit(bit * 32 + before),
        F.array(*[F.struct(F.lit(order).alias("filter_order"), F.lit(step).alias("step")) for order, step in found]))])
    bits, bit, before = F.col("bits"), F.col("s.bit"), F.col("s.before")
    fails, earlier = bits.bitwiseAND(bit) != 0, bits.bitwiseAND(before) != 0
    removed = fails & ~earlier
    count = lambda test, of="n": F.coalesce(F.sum(F.when(test, F.col(of))), F.lit(0)).cast("long")
    # a document that fails k filters is removed by each of them in 120 / k of the orders
    share = F.col("n") * F.lit(120) / F.greatest(F.bit_count(bits), F.lit(1))
    rows = combinations(docs, labels).withColumn("s", F.explode(states)).groupBy("part", bit.alias("bit"), before.alias("before")).agg(
        count(~fails & ~earlier).alias("kept"), count(removed).alias("removed"),
        count(fails & earlier).alias("redundant"), count(bits == bit).alias("unique_fails"),
        count(removed, "good").alias("good_lost"), count(removed, "toxic").alias("toxic_lost"),
        F.coalesce(F.sum(F.when(fails, F.round(share))), F.lit(0)).cast("long").alias("shapley"))
    counts = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return rows.select("part", F.explode(F.element_at(named, F.col("bit") * 32 + F.col("before"))).alias("p"), *counts).select("part", "p.filter_order", "p.step", *counts)
