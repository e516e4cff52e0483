"""Property tables of molecules: flags, aggregates, traffic lights, notes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Drug-likeness limits, assay columns and contribution categories.
RULES = (
    ("molecular_weight", 500, "MW > 500"),
    ("logP", 5, "logP > 5"),
    ("hydrogen_bond_donors", 5, "HBD > 5"),
    ("hydrogen_bond_acceptors", 10, "HBA > 10"),
    ("tpsa", 140, "TPSA > 140"),
)
TOX21 = ("NR-AR", "NR-AR-LBD", "NR-AhR", "NR-Aromatase", "NR-ER", "NR-ER-LBD", "NR-PPAR-gamma",
         "SR-ARE", "SR-ATAD5", "SR-HSE", "SR-MMP", "SR-p53")
CYP_INHIBITION = ("CYP3A4_Veith", "CYP2D6_Veith", "CYP2C9_Veith")
RADIAL = ("BBB_Martins", "ClinTox", "Solubility_AqSolDB", "Bioavailability_Ma", "hERG")
CATEGORIES = ("P", "N", "DA", "D", "A", "AR", "H", "PL", "HA")
GOOD_FROM, WARN_FROM = 60, 25


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def percentile_ending(columns: Sequence[str]) -> str | None:
    """Ending that marks percentile columns: ``drugbank`` and what follows, in the first header with it."""
    found = re.search("drugbank[^\n]*", "\n".join(columns))
    return found and found[0]


def known(value: Column) -> Column:
    """The value as a number; NaN counts as missing."""
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def rule_flags(df: DataFrame, rules: Sequence[tuple[str, float, str]] = RULES) -> DataFrame:
    """Labels of violated limits and their number; a missing value violates nothing."""
    present = [r for r in rules if r[0] in df.columns]
    labels = F.array_compact(F.array(*[
        F.when(known(_c(k)) > limit, F.lit(label))
        for k, limit, label in present]))
    return (df.withColumn("_labels", labels)
            .select(*[_c(c) for c in df.columns],
                    F.array_join("_labels", " · ").alias("physchem_flags"),
                    F.size("_labels").alias("n_physchem_violations")))


def with_maximum(df: DataFrame, columns: Sequence[str], name: str,
                 suffix: str | None = None) -> DataFrame:
    """Largest endpoint of a row, with the percentile of the endpoint that has it.

    The first column wins ties; columns that are absent are left out.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    pct = lambda c: (known(_c(f"{c}_{suffix}")) if suffix and f"{c}_{suffix}" in df.columns
                     else F.lit(None).cast("double"))
    entries = F.array_compact(F.array(*[
        F.when(known(_c(c)).isNotNull(), F.struct(known(_c(c)).alias("v"), F.lit(-i).alias("i"),
                                                  pct(c).alias("p"))) for i, c in enumerate(present)]))
    best = F.array_max(entries)
    out = df.select("*", best.alias("_best"))
    added = [F.col("_best.v").alias(name)]
    if suffix:
        added.append(F.col("_best.p").alias(f"{name}_{suffix}"))
    return out.select(*[_c(c) for c in df.columns], *added)


def count_above(columns: Sequence[str], limit: float = 0.5) -> Column:
    """How many endpoints exceed the limit."""
    return F.size(F.filter(F.array(*[known(_c(c)) for c in columns]),
                           lambda v: v.isNotNull() & (v > limit)))


#: Summary columns: the largest value among several endpoints.
LARGEST = {"tox21_max": TOX21, "cyp_inhibition_max": CYP_INHIBITION}


def with_summaries(df: DataFrame) -> DataFrame:
    """Largest toxicity and inhibition values, number of positive assays and rule flags."""
    ending = percentile_ending(df.columns)
    assays = set(TOX21).intersection(df.columns)
    summed = reduce(lambda out, name: with_maximum(out, LARGEST[name], name, ending), LARGEST, df)
    positive = {"tox21_n_above_0.5": count_above(sorted(assays))} if assays else {}
    return rule_flags(summed.withColumns(positive) if positive else summed)


def light(direction: Column, percentile: Column) -> Column:
    """``good``, ``warn`` or ``risk`` by percentile in the favourable direction."""
    percentile = known(percentile)
    p = F.when(direction == "up", percentile).otherwise(F.lit(100) - percentile)
    none = percentile.isNull() | (direction == "ctx")
    return F.when(~none, F.when(p >= GOOD_FROM, "good").when(p >= WARN_FROM, "warn")
                  .otherwise("risk"))


def light_by_value(value: Column, limits: tuple[float, float] | None) -> Column:
    """Light by absolute limits (warn, risk); no limits, no light."""
    if limits is None:
        return F.lit(None).cast("string")
    warn, risk = limits
    value = known(value)
    return F.when(value.isNotNull(), F.when(value > risk, "risk").when(value > warn, "warn")
                  .otherwise("good"))


def charge_note(charge: Column) -> Column:
    """Strongly charged molecules are outside the range of the predictions."""
    return F.when(F.abs(charge) >= 2, F.concat(F.lit("formal charge "), charge.cast("string")))


def missing_percentiles(columns: Sequence[str], wanted: Sequence[str] = RADIAL) -> list[str]:
    """Wanted percentile columns that the table lacks."""
    suffix = percentile_ending(columns)
    return [w for w in wanted if suffix is None or f"{w}_{suffix}" not in columns]


def contributions(atoms: DataFrame, keys: Sequence[str], category: str = "category",
                  bound: str = "c", free: str = "pl",
                  categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Sum of ``max(free - bound, 0)`` per fixed category, and the total."""
    lost = F.greatest(F.col(free) - F.col(bound), F.lit(0.0))
    wide = (atoms.select(*keys, category, lost.alias("_d")).groupBy(*keys)
            .pivot(category, list(categories)).agg(F.sum("_d")))
    dense = {c: F.coalesce(_c(c), F.lit(0.0)) for c in categories}
    total = sum(list(dense.values())[1:], dense[categories[0]])
    return wide.select(*keys, *[v.alias(c) for c, v in dense.items()], total.alias("total"))


def broadcast_back(entries: DataFrame, predictions: DataFrame,
                   key: str = "smiles") -> tuple[DataFrame, DataFrame]:
    """Predictions of unique structures on all entries, and entries without one."""
    return (entries.join(predictions, key),
            entries.join(predictions.select(key), key, "left_anti"))


def head_rows(entries: DataFrame, n: int, by: Sequence[str] = ("pocket",),
              order: Sequence[str] = ("rank", "line")) -> DataFrame:
    """First ``n`` entries of each pocket, stable by rank.

    The limit on the row number is applied before the shuffle as well.
    """
    over = Window.partitionBy(*by).orderBy(*order)
    return (entries.withColumn("_r", F.row_number().over(over)).filter(F.col("_r") <= n).drop("_r"))


def lights(df: DataFrame, directions: Mapping[str, str]) -> DataFrame:
    """A light per property, from its percentile column."""
    suffix = percentile_ending(df.columns)
    shown = [p for p in directions if f"{p}_{suffix}" in df.columns]
    return df.select("*", *[light(F.lit(directions[p]), _c(f"{p}_{suffix}")).alias(f"light_{p}")
                            for p in shown])
