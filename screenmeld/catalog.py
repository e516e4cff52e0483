"""Score registry, directions, experiments and consensus weights.

The registry only produces column names and Column expressions; all data work
stays in Spark.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenmeld.functions.numbers import fixed


@dataclass(frozen=True)
class Score:
    """One scoring function: key, label, direction of its raw values, family."""

    key: str
    label: str
    raw_higher_is_better: bool
    family: str
    gated: bool = True
    source: str | None = None

    @property
    def column(self) -> str:
        return self.source or f"score_{self.key}"

    @property
    def rank_column(self) -> str:
        return f"rank_{self.key}"

    @property
    def term_column(self) -> str:
        return f"ecr_{self.key}"

    def higher_is_better(self, convention: str) -> bool:
        """Direction of the stored values under a table convention.

        ``lower_better`` tables hold corrected scores (larger-is-better values
        negated on ingest); ``raw`` tables hold them as the scorer printed them.
        """
        if convention == "lower_better":
            return False
        if convention == "raw":
            return self.raw_higher_is_better
        raise ValueError(f"unknown score convention {convention!r}")


# Keys, labels and raw directions of the scoring functions.
SCORES = (
    Score("vina", "Vina", False, "empirical", gated=False),
    Score("vinardo", "Vinardo", False, "empirical"),
    Score("ad4", "AD4", False, "empirical"),
    Score("cnnaffinity", "CNNaffinity", True, "learned"),
    Score("cnnscore", "CNNscore", True, "learned"),
    Score("deltalinf9xgb", "ΔLinF9XGB", True, "learned"),
    Score("dense_cnnaffinity", "DenseAffinity", True, "learned"),
    Score("dense_cnnscore", "DenseCNNscore", True, "learned", gated=False),
)

# Preset combinations of scoring functions.
EXPERIMENTS = {
    "classical_only": ["vina", "deltalinf9xgb"],
    "dl_only": ["cnnaffinity", "dense_cnnaffinity"],
    "one_per_family": ["vina", "cnnaffinity", "deltalinf9xgb"],
    "dense_variant": ["vina", "dense_cnnaffinity", "deltalinf9xgb"],
    "vinardo_variant": ["vinardo", "cnnaffinity", "deltalinf9xgb"],
    "classical_pair": ["vina", "vinardo"],
    "four_way": ["vina", "vinardo", "cnnaffinity", "deltalinf9xgb"],
}

# Default consensus and search parameters.
SIGMA_FRACTION = 4
SIGMA_FRACTIONS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 20)
WEIGHT_STEP = 0.1
EF_FRACTIONS = (0.01, 0.05, 0.10)
PRIMARY_METRIC = "EF1%"

_BY_KEY = {s.key: s for s in SCORES}
KEYS = tuple(_BY_KEY)


def register(added: Score) -> Score:
    """Make a scoring function of the user known under its key.

    ``Score("mine", "Mine", False, "user", source="my_column")`` ranks any numeric column of a table; the
    text formats keep the columns of the built-in functions.
    """
    if _BY_KEY.get(added.key, added) != added:
        raise ValueError(f"score {added.key!r} is known already and differs")
    return _BY_KEY.setdefault(added.key, added)


def score(key: str) -> Score:
    try:
        return _BY_KEY[key]
    except KeyError:
        raise ValueError(f"unknown score {key!r}, known: {', '.join(_BY_KEY)}") from None


def columns_of(keys: Iterable[str]) -> list[str]:
    return [score(k).column for k in keys]


def available(df: DataFrame, keys: Iterable[str] = KEYS) -> list[str]:
    """Keys whose score column exists in the table: built-in ones, then those of the user."""
    wanted = set(keys)
    return [k for k in _BY_KEY if k in wanted and score(k).column in df.columns]


def score_catalog(spark: SparkSession) -> DataFrame:
    """The registry as a table (key, label, higher_is_better, family)."""
    return spark.createDataFrame(
        [(s.key, s.label, s.raw_higher_is_better, s.family) for s in SCORES],
        "key string, label string, higher_is_better boolean, family string")


def experiments(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(EXPERIMENTS.items()), "name string, scores array<string>")


def active_scores(flags: Mapping[str, bool]) -> list[str]:
    """Scores switched on by ``<key>_enabled`` flags; at least one is required."""
    on = [k for k in KEYS if flags.get(f"{k}_enabled", False)]
    if not on:
        raise ValueError("no scoring function is active, nothing to rank")
    return on


def correct_direction(df: DataFrame, keys: Iterable[str] | None = None) -> DataFrame:
    """Negate larger-is-better scores so that smaller is better everywhere."""
    chosen = available(df, keys or KEYS)
    negated = {score(k).column: (-F.col(score(k).column)).alias(score(k).column)
               for k in chosen if score(k).raw_higher_is_better}
    return df.select(*[negated.get(c, F.col(c)) for c in df.columns])


def restore_raw(df: DataFrame, keys: Iterable[str] | None = None) -> DataFrame:
    """Undo :func:`correct_direction`; negation is its own inverse."""
    return correct_direction(df, keys)


def finite(df: DataFrame, keys: Iterable[str] | None = None) -> DataFrame:
    """Turn NaN and infinities of score columns into NULL."""
    chosen = set(columns_of(available(df, keys or KEYS)))

    def clean(c: str) -> Column:
        col = F.col(c)
        bad = F.isnan(col) | (F.abs(col) == F.lit(float("inf")))
        return F.when(~bad, col).alias(c)

    return df.select(*[clean(c) if c in chosen else F.col(c) for c in df.columns])


def as_shares(parts: Mapping[str, float]) -> dict[str, float]:
    """Parts scaled to a sum of 1; an even split if there is nothing to scale."""
    whole = math.fsum(parts.values())
    return {name: part / whole if whole else 1 / len(parts) for name, part in parts.items()}


def consensus_weights(scores: Iterable[str], given: Mapping[str, float] | None = None,
                      strict: bool = True) -> dict[str, float]:
    """Shares of the ranked functions; those without a weight take none.

    A negative weight is an error, or none at all when ``strict`` is false.
    """
    asked = {**dict.fromkeys((score(s).key for s in scores), 0.0)}
    asked.update((k, float(w)) for k, w in (given or {}).items() if k in asked)
    if strict and min(asked.values(), default=0.0) < 0:
        raise ValueError(f"negative weights: {', '.join(k for k, w in asked.items() if w < 0)}")
    return as_shares({k: w if w > 0 else 0.0 for k, w in asked.items()})


# one ``key=number`` or nothing between two commas
_WEIGHT = r"\s*(?:\w+\s*=\s*[^,=\s]+)?\s*"


def weights_from_text(text: str) -> dict[str, float]:
    """Map of a text such as ``vina=0.2,cnnaffinity=0.5``; unknown keys and malformed parts fail."""
    if not re.fullmatch(f"{_WEIGHT}(?:,{_WEIGHT})*", text):
        raise ValueError(f"weights {text!r} are not key=number, separated by commas")
    return {score(k).key: float(v) for k, v in re.findall(r"(\w+)\s*=\s*([^,=\s]+)", text)}


def normalized_weight_columns(keys: Iterable[str], raw: Mapping[str, Column],
                              present: Mapping[str, Column]) -> dict[str, Column]:
    """Per-row weights over the functions that have data in the row's group."""
    keys = list(keys)
    kept = {k: F.when(present[k], raw[k]).otherwise(F.lit(0.0)) for k in keys}
    total = sum((kept[k] for k in keys[1:]), kept[keys[0]])
    n_present = sum((present[k].cast("int") for k in keys[1:]), present[keys[0]].cast("int"))
    equal = F.lit(1.0) / F.nullif(n_present, F.lit(0))
    return {k: F.coalesce(F.when(total > 0, kept[k] / F.nullif(total, F.lit(0.0)))
                          .otherwise(F.when(present[k], equal).otherwise(F.lit(0.0))), F.lit(0.0))
            for k in keys}


def encode_weights(weights: Column) -> Column:
    """Map column to ``A=0.50/B=0.50`` in key order."""
    parts = F.transform(F.array_sort(F.map_entries(weights)),
                        lambda e: F.concat(e["key"], F.lit("="), fixed(e["value"], 2)))
    return F.array_join(parts, "/")


def decode_weights(text: Column) -> Column:
    """``A=0.50/B=0.50`` to a map column."""
    return F.transform_values(F.str_to_map(text, F.lit("/"), F.lit("=")),
                              lambda _, v: v.try_cast("double"))
