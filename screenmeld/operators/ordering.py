"""Ordered operators within groups of any size.

A plain ``Window.partitionBy(group).orderBy(key)`` sorts a whole group in one
task. Screening tables have few groups (targets) and one of them may hold a
third of all rows, so every ordered operator of the library goes through this
module. It uses the plain window only when the bound handed in proves that no
group can exceed ``rows_per_task``. Otherwise the composite key
``(group, order)`` is cut into ranges at fixed, sampled cut points: the window
runs inside one range, and the totals of the earlier ranges of the same group
are added from a table of at most two rows per cut.

The input of a split is staged, so what comes before it runs once. The cut
points become literals of the plan, so a recomputed or retried task always sees
the same ranges; they only steer the split and never the result.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenmeld.session import rows_per_task, stage

MAX_RANGES = 20_000
SAMPLES_PER_RANGE = 20
#: Rows sorted together where ranks follow from places, and most rows of their table of starts that are broadcast.
ROWS_PER_RANGE = 500_000
MOST_STARTS = 100_000
#: Rows of a group per cell of its values, and hashes by which the largest group is first bounded.
ROWS_PER_CELL = 20_000
GROUP_HASHES = 1 << 16
#: Rows per value, at least, where ranks are looked up by value.
ROWS_PER_VALUE = 1000

_RANGE = "_range"
_SALT = "_salt"
_INSIDE = "_inside"
_CELL = "_cell"


@dataclass(frozen=True)
class Bound:
    """Upper bounds known about a table: rows of its largest group, rows in all."""

    largest: int
    total: int

    def times(self, groups: int, inside: int = 1) -> Bound:
        """Bounds after ``groups`` copies of each group with ``inside``-fold rows."""
        return Bound(self.largest * inside, self.total * groups * inside)


Rows = int | Bound | None


def bound_of(df: DataFrame, rows: Rows) -> Bound:
    if isinstance(rows, Bound):
        return rows
    n = df.count() if rows is None else rows
    return Bound(n, n)


def measured(df: DataFrame, group: Sequence[str], total: int) -> Bound:
    """The bound of a table with known row count: its largest group by one aggregate.

    Not needed, and not run, where even the whole table fits one task. No group has more rows than
    all that share its hash; groups themselves are counted only where that is too many.
    """
    per_task = rows_per_task(df.sparkSession)
    if total <= per_task:
        return Bound(total, total)
    hashed = df.groupBy(F.pmod(F.xxhash64(*group), F.lit(GROUP_HASHES))).agg(F.count(F.lit(1)).alias("_n"))
    most = hashed.agg(F.max("_n")).first()[0] or 0
    if most <= per_task:
        return Bound(most, total)
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    return Bound(sizes.agg(F.max("_n")).first()[0] or 0, total)


@dataclass(frozen=True)
class _Ranges:
    """Sorted cut points over (group, order) and the ranges made of one key only."""

    cuts: list[tuple]
    heavy: list[int]
    schema: T.StructType

    def literal(self) -> Column:
        names = self.schema.fieldNames()
        text = json.dumps([dict(zip(names, cut)) for cut in self.cuts], ensure_ascii=False, default=str)
        return F.from_json(F.lit(text), T.ArrayType(self.schema))


def _same_key(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def _plain(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """The columns in forms that sort alike and can be written as JSON."""
    forms = {"timestamp": F.unix_micros, "date": F.unix_date, "binary": F.hex,
             "timestamp_ntz": lambda c: F.unix_micros(F.to_utc_timestamp(c.cast("timestamp"), "UTC"))}
    kinds = dict(df.dtypes)
    return [forms.get(kinds[c], lambda x: x)(F.col(c)).alias(c) for c in columns]


def join_groups(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which NULL equals NULL; the keys of ``df`` stay."""
    renamed = small.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return df.join(renamed, same, how).drop(*[f"_of_{k}" for k in keys])


def _sample_ranges(df: DataFrame, group: Sequence[str], order: Sequence[str],
                   rows: int, per_task: int, isolate: bool) -> _Ranges | None:
    parts = min(MAX_RANGES, math.ceil(rows / per_task))
    wanted = parts * SAMPLES_PER_RANGE
    keys = df.select(*_plain(df, [*group, *order]))
    fraction = min(1.0, wanted / rows)
    sampled = keys.sample(False, fraction, seed=11).limit(2 * wanted + 1000)
    picked = [tuple(r) for r in sampled.orderBy(*keys.columns).collect()]  # NULL first, NaN last
    if len(picked) < 2:
        return None
    step = len(picked) / parts
    chosen = [picked[min(len(picked) - 1, int(i * step))] for i in range(1, parts)]
    cuts: list[tuple] = []
    heavy: list[int] = []
    i = 0
    while i < len(chosen):
        j = i
        while j + 1 < len(chosen) and _same_key(chosen[j + 1], chosen[i]):
            j += 1
        # side 0 starts a range at the key, side 2 right after it
        cuts.append((*chosen[i], 0))
        if j > i and isolate:
            heavy.append(len(cuts))
            cuts.append((*chosen[i], 2))
        i = j + 1
    fields = [T.StructField(f.name, f.dataType) for f in keys.schema.fields]
    schema = T.StructType([*fields, T.StructField("_side", T.IntegerType())])
    return _Ranges(cuts, heavy, schema)


def _range_number(df: DataFrame, ranges: _Ranges, cuts: Column, group: Sequence[str],
                  order: Sequence[str]) -> Column:
    """Number of cut points at or below the row's key, by binary search."""
    n = len(ranges.cuts)
    key = F.struct(*_plain(df, [*group, *order]), F.lit(1).alias("_side"))
    steps = [1 << b for b in range(n.bit_length() - 1, -1, -1)]

    def halve(found: Column, step: Column) -> Column:
        ahead = found + step
        return F.when((ahead <= n) & (F.get(cuts, ahead - 1) <= key), ahead).otherwise(found)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve)


def _split(df: DataFrame, group: Sequence[str], order: Sequence[str], rows: Rows,
           isolate: bool = True) -> tuple[DataFrame, _Ranges | None]:
    """Number the ranges; ``isolate`` gives a key that fills several ranges its
    own range, whose rows are then spread over many tasks by a salt."""
    per_task = rows_per_task(df.sparkSession)
    bound = bound_of(df, rows)
    ranges = None
    if bound.largest > per_task:
        # written once: sampling, totals and the rows themselves read the same values
        df = stage(df, "ordered")
        ranges = _sample_ranges(df, group, order, bound.total, per_task, isolate)
    if ranges is None:
        return df, None
    cuts = ranges.literal()
    numbered = df.withColumn(_RANGE, _range_number(df, ranges, cuts, group, order))
    same = lambda at: F.coalesce(
        F.struct(*[at[g].alias(g) for g in group]) == F.struct(*_plain(df, group)), F.lit(False))
    inside = same(F.get(cuts, F.col(_RANGE) - 1)) | same(F.get(cuts, F.col(_RANGE)))
    salt = F.lit(0)
    if ranges.heavy:
        spread = F.pmod(F.xxhash64(*df.columns), F.lit(len(ranges.cuts) + 1)).cast("int")
        salt = F.when(F.col(_RANGE).isin(ranges.heavy), spread).otherwise(F.lit(0))
    return numbered.withColumn(_INSIDE, inside).withColumn(_SALT, salt), ranges


def _with_offsets(df: DataFrame, group: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Add ``_before_x`` and ``_total_x`` of the row's range for each sum ``x``.

    Only groups that contain a cut point need them, so the joined table has at
    most two rows per cut, i.e. 2 * MAX_RANGES, whatever the data volume.
    """
    # filtered behind the aggregate: ahead of it, the range would be computed again per use
    totals = (df.groupBy(*group, _RANGE)
              .agg(*[F.sum(c).alias(f"_total_{n}") for n, c in sums.items()],
                   F.max(_INSIDE).alias("_kept")).filter("_kept"))
    earlier = (Window.partitionBy(*group).orderBy(_RANGE)
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        *group, _RANGE, *[f"_total_{n}" for n in sums],
        *[F.sum(f"_total_{n}").over(earlier).alias(f"_before_{n}") for n in sums])
    return join_groups(df, F.broadcast(offsets), [*group, _RANGE], "left")


def _spread(df: DataFrame, group: Sequence[str], rows: Rows) -> DataFrame:
    """Rows of a large table dealt by group to as many tasks as its size asks for, so that what one of them sorts doesn't grow with it."""
    if not group or not isinstance(rows, Bound) or rows.total <= rows_per_task(df.sparkSession):
        return df
    parts = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.total / ROWS_PER_RANGE))
    return df.repartition(min(MAX_RANGES, parts), *group)


def cumulate(df: DataFrame, group: Sequence[str], order: Sequence[str],
             sums: Mapping[str, Column], rows: Rows = None) -> DataFrame:
    """Add running sums along ascending ``order`` that include all equal keys.

    ``rows`` bounds the row count, or the :class:`Bound` of groups and table; the
    table is counted when nothing is given.
    NULL groups are groups, NULL keys come first and NaN last, as in a window.
    """
    if not sums:
        return df
    kept = df.columns
    valued = df.select("*", *[c.alias(f"_value_{n}") for n, c in sums.items()])
    split, ranges = _split(valued, group, order, rows)
    keys = list(group) if ranges is None else [*group, _RANGE, _SALT]
    upto = (Window.partitionBy(*keys).orderBy(*order)
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    if ranges is None:
        return _spread(split, group, rows).select(
            *kept, *[F.sum(f"_value_{n}").over(upto).alias(n) for n in sums])
    joined = _with_offsets(split, group, {n: F.col(f"_value_{n}") for n in sums})
    heavy = F.col(_RANGE).isin(ranges.heavy) if ranges.heavy else F.lit(False)

    def running(n: str) -> Column:
        here = F.when(heavy, F.col(f"_total_{n}")).otherwise(F.sum(f"_value_{n}").over(upto))
        return F.coalesce(F.col(f"_before_{n}"), F.lit(0)) + here

    return joined.select(*kept, *[running(n).alias(n) for n in sums])


def _ranked_in_place(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, method: str,
                     rows: int, per_task: int) -> DataFrame:
    """Ranks from the places of the rows in ranges that are sorted and written once.

    Equal keys lie in one range. Where a group starts in each range, and how many of its rows lie in
    earlier ranges, is a table of a row per range and group.
    """
    kept, keys = df.columns, [*group, *order]
    parts = min(MAX_RANGES, max(df.sparkSession.sparkContext.defaultParallelism,
                                math.ceil(rows / min(per_task, ROWS_PER_RANGE))))
    number = F.monotonically_increasing_id()  # the partition, then the place in it
    placed = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_number", number)
    same = Window.partitionBy(*keys)
    first = F.col("_number") if method == "first" else F.min("_number").over(same)
    ties = [(F.count(F.lit(1)).over(same) - 1).alias("_others")] if method == "average" else []
    split = stage(placed.select(*kept, F.shiftright("_number", 33).cast("int").alias(_RANGE),
                                first.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"), *ties), "ranked")
    earlier = Window.partitionBy(*group).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(split.groupBy(*group, _RANGE).agg(F.min("_at").alias("_start"), F.count(F.lit(1)).alias("_rows"))
                   .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_start")), "starts")
    small = starts.drop("_start", "_rows")
    joined = join_groups(split, F.broadcast(small) if starts.count() <= MOST_STARTS else small, [*group, _RANGE])
    value = F.col("_before") + F.col("_at") + 1
    value = (value + F.col("_others") / 2.0).cast("double") if ties else value.cast("long")
    return joined.select(*kept, value.alias(name))


def stored(df: DataFrame, rows: Bound, name: str) -> DataFrame:
    """``df``, written first where it is to be the source of ranks in cells."""
    return stage(df, name) if rows.largest > min(rows_per_task(df.sparkSession), ROWS_PER_RANGE) else df


def _cells(df: DataFrame, spans: DataFrame, group: Sequence[str], key: str, unranked: bool) -> DataFrame:
    """Add the cell of each row: cells cut the span of a group's values evenly, so that they rise with ``key``."""
    joined = join_groups(df, F.broadcast(spans), group)
    v = F.col(key).cast("double")
    width = F.col("_hi") - F.col("_lo")
    share = F.when((width > 0) & (width < float("inf")), F.least((v - F.col("_lo")) / width, F.lit(1.0))).otherwise(0.0)
    spread = -2 - F.pmod(F.xxhash64(*df.columns), F.col("_cells")) if unranked else F.lit(-1).cast("long")
    cell = (F.when(v.isNull(), spread).when(F.isnan(v), F.col("_cells") + 3)
            .when(v == float("inf"), F.col("_cells") + 2).when(v == float("-inf"), F.lit(0).cast("long"))
            .otherwise(F.floor(share * F.col("_cells")) + 1))
    return joined.withColumn(_CELL, cell).drop("_lo", "_hi", "_cells")


def dealt_in_cells(df: DataFrame, source: DataFrame, group: Sequence[str], key: str, rows: Bound,
                   sums: Mapping[str, Column] | None = None, unranked: bool = False) -> DataFrame | None:
    """Rows dealt by group and cell of a numeric ``key``, with their cell and what the lower cells of the group hold.

    ``_cell`` rises with the key and equal keys share one. ``_before`` has the number of rows in lower cells and
    ``_before_x`` the sum of each of ``sums`` there; ``_all`` and ``_all_x`` are those of the group. ``source`` has the
    groups and keys of ``df`` and is read twice; only counts are written. None if the key is no number, or if the
    values of a group lie so close that a cell has more rows than a task may hold.
    """
    if dict(df.dtypes)[key].split("(")[0] not in ("double", "float", "bigint", "int", "smallint", "tinyint", "decimal"):
        return None
    sums, per_task = sums or {}, rows_per_task(df.sparkSession)
    read = source.select(*group, key, *[c.alias(f"_part_{n}") for n, c in sums.items()])
    v = F.col(key).cast("double")
    finite = F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)
    per_cell = max(1, min(ROWS_PER_CELL, per_task // 2))
    spans = stage(read.groupBy(*group).agg(
        F.min(finite).alias("_lo"), F.max(finite).alias("_hi"), F.ceil(F.count(F.lit(1)) / per_cell).alias("_cells")), "spans")
    if spans.count() > MOST_STARTS:
        return None
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(_CELL).rowsBetween(Window.unboundedPreceding, -1)
    counted = _cells(read.filter(v.isNotNull()) if unranked else read, spans, group, key, False)
    cells = counted.groupBy(*group, _CELL).agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_part_{n}").alias(f"_rows_{n}") for n in sums])
    tails = ["", *[f"_{n}" for n in sums]]
    starts = stage(cells.select(*group, _CELL, "_rows", *[
        F.coalesce(F.sum(f"_rows{t}").over(earlier), F.lit(0)).alias(f"_before{t}") for t in tails], *[
        F.sum(f"_rows{t}").over(whole).alias(f"_all{t}") for t in tails]), "starts")
    count, most = starts.agg(F.count(F.lit(1)), F.max("_rows")).first()
    if count > MOST_STARTS or (most or 0) > per_task:
        return None
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = min(MAX_RANGES, max(cores, math.ceil(rows.total / min(per_task, ROWS_PER_RANGE))))
    placed = join_groups(_cells(df, spans, group, key, unranked), F.broadcast(starts.drop("_rows")), [*group, _CELL], "left")
    return placed.repartition(parts, _CELL, *group)


def _ranked_in_cells(df: DataFrame, source: DataFrame, group: Sequence[str], order: Sequence[str], name: str,
                     method: str, rows: Bound, unranked: bool) -> DataFrame | None:
    """Ranks from the place inside a cell of values and the rows in lower cells."""
    dealt = dealt_in_cells(df, source, group, order[0], rows, unranked=unranked)
    if dealt is None:
        return None
    along = Window.partitionBy(_CELL, *group).orderBy(*order)
    value = F.row_number().over(along) if method == "first" else F.rank().over(along)
    value = (F.col("_before") + value).cast("long")
    if method == "average":
        value = value + (F.count(F.lit(1)).over(Window.partitionBy(_CELL, *group, *order)) - 1) / 2.0
    return dealt.select(*df.columns, value.alias(name))


def _ranked_by_value(df: DataFrame, source: DataFrame, group: Sequence[str], key: str, name: str, method: str,
                     rows: Bound, unranked: bool) -> DataFrame | None:
    """Ranks looked up in the counts of values, where these are few and repeat; no row is moved. None elsewhere."""
    read = source.select(*group, key)
    read = read.filter(F.col(key).isNotNull()) if unranked else read
    # an estimate decides whether they are counted
    kinds = read.groupBy(*group).agg((F.approx_count_distinct(key) + 1).alias("_kinds"))
    if (kinds.agg(F.sum("_kinds")).first()[0] or 0) > min(MOST_STARTS // 2, rows.total // ROWS_PER_VALUE):
        return None
    counts = read.groupBy(*group, key).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*group).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    value = (before + 1).cast("long") if method == "min" else before + (F.col("_rows") + 1) / 2.0
    ranks = stage(counts.select(*group, key, value.alias(name)), "value-ranks")
    if ranks.count() > MOST_STARTS:
        return None
    return join_groups(df, F.broadcast(ranks), [*group, key], "left").select(*df.columns, name)


def rank_rows(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rank",
              method: str = "first", rows: Rows = None, staged: bool = False,
              source: DataFrame | None = None, unranked: bool = False) -> DataFrame:
    """Add the rank of each row along ascending ``order`` within its group.

    ``method``: ``first`` numbers the rows 1..n (``order`` must end in a unique
    key, which also lets any range be cut), ``min`` is competition rank,
    ``average`` the mean rank of equal keys. ``staged`` says that reading ``df`` again is
    cheap, and ``source`` names a table with the same groups and keys that is cheap to read: ``df`` is then
    read once, and groups of over ``ROWS_PER_RANGE`` rows are ranked in cells of their first key's values, or by a
    broadcast table of the values' ranks where these are few and ties share a rank.
    With ``unranked`` rows whose first key is NULL have no rank; otherwise they come first.

    Without a source, or where cells don't part the rows, ranges with rows of one key only are spread by a salt; without such a key the ranks follow from the places of the rows.
    """
    if method not in ("first", "min", "average"):
        raise ValueError(f"unknown rank method {method!r}")
    kept = df.columns
    per_task, rows = rows_per_task(df.sparkSession), bound_of(df, rows)
    if rows.largest > min(per_task, ROWS_PER_RANGE) and source is not None:
        if method != "first" and len(order) == 1:
            looked_up = _ranked_by_value(df, source, group, order[0], name, method, rows, unranked)
            if looked_up is not None:
                return looked_up
        in_cells = _ranked_in_cells(df, source, group, order, name, method, rows, unranked)
        if in_cells is not None:
            return in_cells
    if unranked:
        # the place of a missing key doesn't matter: spread, so that no key fills several ranges
        none = F.col(order[0]).isNull()
        keyed = df.withColumns({"_none": none, "_spread": F.when(none, F.xxhash64(*kept))})
        ranked = rank_rows(keyed, group, ["_none", order[0], "_spread", *order[1:]], name, method, rows, staged)
        return ranked.select(*kept, F.when(F.col(order[0]).isNotNull(), F.col(name)).alias(name))
    if rows.largest > per_task:
        df = df if staged else stage(df, "ordered")
        found = None if method == "first" else _sample_ranges(df, group, order, rows.total, per_task, True)
        if found is None or not found.heavy:
            return _ranked_in_place(df, group, order, name, method, rows.total, per_task)
    split, ranges = _split(df, group, order, rows, isolate=method != "first")
    keys = list(group) if ranges is None else [*group, _RANGE, _SALT]
    along = Window.partitionBy(*keys).orderBy(*order)
    if ranges is None:
        split = _spread(split, group, rows)
        before, total, heavy = F.lit(0), F.lit(None), F.lit(False)
    else:
        split = _with_offsets(split, group, {"rows": F.lit(1)})
        before = F.coalesce(F.col("_before_rows"), F.lit(0))
        total = F.col("_total_rows")
        heavy = F.col(_RANGE).isin(ranges.heavy) if ranges.heavy else F.lit(False)
    if method == "first":
        value = (before + F.row_number().over(along)).cast("long")
    elif method == "min":
        value = (before + F.rank().over(along)).cast("long")
    else:
        lowest = F.rank().over(along)
        ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, *order))
        if ranges is not None:
            ties = F.when(heavy, total).otherwise(ties)
        value = (before + lowest + (ties - 1) / 2.0).cast("double")
    return split.select(*kept, value.alias(name))


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float],
                    rows: Rows = None) -> DataFrame:
    """Exact linear-interpolated quantiles: rows ``group, p, value``.

    Small inputs use the built-in exact ``percentile``. It keeps every distinct
    value of a group in one task, so larger inputs select the two neighbours of
    each position from the cumulated value counts instead.
    """
    spark = df.sparkSession
    plain = df.select(*group, F.col(value).cast("double").alias("_v")).filter(
        F.col("_v").isNotNull())
    rows = bound_of(plain, rows)
    grid = F.array(*[F.lit(float(p)) for p in probs])
    if rows.largest <= rows_per_task(spark):
        return (plain.groupBy(*group)
                .agg(F.percentile("_v", [float(p) for p in probs]).alias("_q"))
                .select(*group, F.explode(F.arrays_zip(grid.alias("p"), F.col("_q"))).alias("_z"))
                .select(*group, F.col("_z")["p"].alias("p"), F.col("_z")["_q"].alias("value")))
    counts = plain.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_n"))
    seen = cumulate(counts, group, ["_v"], {"_upto": F.col("_n")}, rows)
    total = plain.groupBy(*group).agg(F.count(F.lit(1)).alias("_all"))
    spot = join_groups(seen, total, group) if group else seen.join(F.broadcast(total))
    at = (F.col("_all") - 1) * F.col("p")
    start = F.col("_upto") - F.col("_n")
    covers = lambda k: (start <= k) & (k < F.col("_upto"))
    return (spot.select("*", F.explode(grid).alias("p"))
            .withColumn("_lo", F.floor(at)).withColumn("_hi", F.ceil(at))
            .filter(covers(F.col("_lo")) | covers(F.col("_hi")))
            .groupBy(*group, "p")
            .agg(F.max(F.when(covers(F.col("_lo")), F.col("_v"))).alias("_a"),
                 F.max(F.when(covers(F.col("_hi")), F.col("_v"))).alias("_b"),
                 F.max(at - F.col("_lo")).alias("_f"))
            .select(*group, "p",
                    (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).alias("value")))


def order_preserving_index(df: DataFrame, group: Sequence[str], order: Sequence[str],
                           name: str = "idx", rows: Rows = None) -> DataFrame:
    """0-based position in the sorted group, for block and slot assignment."""
    numbered = rank_rows(df, group, order, "_pos", "first", rows)
    return numbered.select(*df.columns, (F.col("_pos") - 1).alias(name))


def with_totals(df: DataFrame, group: Sequence[str], totals: Mapping[str, Column],
                rows: Rows = None, bounded: bool = False) -> DataFrame:
    """Add sums over the whole group to each row.

    A window would hold a group in one task, so beyond ``rows_per_task`` the
    sums are aggregated first and joined back; ``bounded`` says that the number
    of groups was checked and the sums may be broadcast.
    """
    if bound_of(df, rows).largest <= rows_per_task(df.sparkSession):
        whole = Window.partitionBy(*group)
        return df.select("*", *[F.sum(c).over(whole).alias(n) for n, c in totals.items()])
    small = df.groupBy(*group).agg(*[F.sum(c).alias(n) for n, c in totals.items()])
    if not group:
        return df.join(F.broadcast(small))
    return join_groups(df, F.broadcast(small) if bounded else small, group)


def fill_down(df: DataFrame, group: Sequence[str], order: Sequence[str],
              marks: Mapping[str, Column], rows: Rows = None) -> DataFrame:
    """Add the last non-NULL value of each mark at or before the row.

    ``order`` must be unique within the group. In a split group the last mark of
    the earlier ranges is carried over in a table of at most two rows per cut.
    """
    kept = df.columns
    marked = df.select("*", *[c.alias(f"_mark_{n}") for n, c in marks.items()])
    split, ranges = _split(marked, group, order, rows, isolate=False)
    keys = list(group) if ranges is None else [*group, _RANGE]
    upto = (Window.partitionBy(*keys).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    here = {n: F.last(f"_mark_{n}", ignorenulls=True).over(upto) for n in marks}
    if ranges is None:
        return split.select(*kept, *[c.alias(n) for n, c in here.items()])
    position = F.struct(*order)
    lasts = split.groupBy(*group, _RANGE).agg(*[
        F.max_by(f"_mark_{n}", F.when(F.col(f"_mark_{n}").isNotNull(), position)).alias(f"_end_{n}")
        for n in marks], F.max(_INSIDE).alias("_kept")).filter("_kept")
    earlier = (Window.partitionBy(*group).orderBy(_RANGE)
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = lasts.select(*group, _RANGE, *[
        F.last(f"_end_{n}", ignorenulls=True).over(earlier).alias(f"_carry_{n}") for n in marks])
    joined = join_groups(split, F.broadcast(carried), [*group, _RANGE], "left")
    return joined.select(*kept, *[F.coalesce(c, F.col(f"_carry_{n}")).alias(n)
                                  for n, c in here.items()])
