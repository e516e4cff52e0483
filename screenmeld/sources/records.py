"""Headers and records of delimited files that are read in splits.

A file's header reaches its lines by piece, the lines of one split or a stretch of them, so a file of any size is many keys.
A quoted field may hold line breaks. Whether a line starts inside one depends on all lines before it, but a line
only keeps, turns or sets that state, and such steps can be put together: per line inside a piece, and over the few
pieces of a file. Only lines of records with line breaks are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lines of a piece, as a power of two.
PIECE_BITS = 17
PIECE = ["path", "block", "piece"]


def pieces(data: DataFrame) -> DataFrame:
    return data.withColumn("piece", F.shiftright("seq", PIECE_BITS))


def first_lines(data: DataFrame) -> DataFrame:
    """(path, h): place and text of the first line of each file."""
    return data.groupBy("path").agg(F.min_by(F.struct("block", "seq", "value"), F.struct("block", "seq")).alias("h"))


def with_file(data: DataFrame, files: DataFrame) -> DataFrame:
    """Lines (path, block, seq, …) with the columns of their file; files without a row drop."""
    placed = pieces(data)
    each = placed.select(*PIECE).distinct().join(files, "path")
    return placed.join(each, PIECE).drop("piece")


def opens_quote(line: Column, separator: Column, known: tuple[str, ...]) -> Column:
    """Whether a line that starts outside of quotes ends inside a quoted field."""
    def test(s: str) -> Column:
        c = "\\" + s if s == "|" else s
        whole = rf'"(?:[^"]++|"")*+"[^{c}]*+|[^"{c}][^{c}]*+|'
        return line.rlike(rf'^(?:(?:{whole}){c})*+"(?:[^"]++|"")*+$')
    found = F.lit(False)
    for s in known:
        found = F.when(separator == s, test(s)).otherwise(found)
    return F.contains(line, F.lit('"')) & found


def _after(start: Column, fixed: Column, turns: Column) -> Column:
    """State after some steps: from the last step that sets it, or else from the start, turned as often as said."""
    base = F.coalesce(fixed["value"], start)
    return base != ((turns - F.coalesce(fixed["turns"], F.lit(0))) % 2 == 1)


def join_records(lines: DataFrame, separator: str, known: tuple[str, ...], keep: list[str]) -> DataFrame:
    """Lines (path, block, seq, value, ``keep``…) as records: those of a quoted field with line breaks become one.

    ``keep`` holds columns of the file. A record stands at its first line. A field that is never closed takes the rest of its file.
    """
    sep = F.col(separator)
    outside, inside = opens_quote(F.col("value"), sep, known), opens_quote(F.concat(F.lit('"'), "value"), sep, known)
    plain = ~F.contains("value", F.lit('"'))
    steps = pieces(lines).withColumn("_o", F.when(plain, False).otherwise(outside)).withColumn(
        "_i", F.when(plain, True).otherwise(inside))
    along = Window.partitionBy(*PIECE).orderBy("seq")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    turned = steps.withColumn("_turns", F.sum((F.col("_o") & ~F.col("_i")).cast("long")).over(upto))
    fixed = F.when(F.col("_o") == F.col("_i"), F.struct(F.col("_o").alias("value"), F.col("_turns").alias("turns")))
    run = turned.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(upto))

    # a row per piece: its lines as one step
    whole = run.groupBy(*PIECE).agg(F.max("_turns").alias("_turns"), F.max_by("_fixed", "seq").alias("_fixed"))
    before = Window.partitionBy("path").orderBy("block", "piece").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("_turns").over(before), F.lit(0))
    place = whole.withColumn("_all", total + F.col("_turns"))
    set_there = F.when(F.col("_fixed").isNotNull(), F.struct(
        F.col("_fixed.value").alias("value"), (F.col("_all") - F.col("_turns") + F.col("_fixed.turns")).alias("turns")))
    starts = place.select(*PIECE, _after(F.lit(False), F.last(set_there, ignorenulls=True).over(before), total).alias("_start"))

    known_start = run.join(starts, PIECE)
    after = known_start.withColumn("_end", _after(F.col("_start"), F.col("_fixed"), F.col("_turns")))
    begun = after.withColumn("_in", F.coalesce(F.lag("_end").over(along), F.col("_start")))
    single = begun.filter(~F.col("_in") & ~F.col("_end"))
    rest = begun.filter(F.col("_in") | F.col("_end")).select("path", "block", "seq", "value", "_in", *keep)
    # only lines of records with line breaks are left, so numbering them per file is cheap where such records are few
    order = Window.partitionBy("path").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, 0)
    numbered = rest.withColumn("_record", F.sum((~F.col("_in")).cast("long")).over(order))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "value"))), lambda x: x["value"]), "\n")
    joined = numbered.groupBy("path", "_record").agg(
        F.min(F.struct("block", "seq")).alias("at"), text.alias("value"), *[F.first(c).alias(c) for c in keep])
    columns = ["path", "block", "seq", "value", *keep]
    return single.select(*columns).unionByName(joined.select("path", "at.block", "at.seq", "value", *keep))
