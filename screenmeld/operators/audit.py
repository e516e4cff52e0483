"""Audits of run settings, libraries, poses and archives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenmeld.catalog import KEYS
from screenmeld.functions.numbers import truthy

# Settings that two stages share, allowed words, score families.
SHARED_KEYS = ("results_dir", "target_dir")
SEARCH_MODES = ("fast", "balance", "detail", "")
DOCKING_SCORINGS = ("vina", "vinardo", "ad4")
REFINEMENT_MODES = ("local_only", "minimize", "autobox")
EMPIRICAL = ("vina", "vinardo", "ad4")
LEARNED = ("cnnaffinity", "cnnscore", "deltalinf9xgb", "dense")


def stage_handover(settings: DataFrame, a: str = "docking", b: str = "rescore",
                   keys: Sequence[str] = SHARED_KEYS) -> DataFrame:
    """Settings that must be equal in two stages of a run but are not.

    ``settings(run, stage, section, key, value)``.
    """
    wanted = settings.filter((F.col("section") == "PATHS") & F.col("key").isin(*keys))
    wide = wanted.groupBy("run", "key").agg(
        F.max(F.when(F.col("stage") == a, F.col("value"))).alias("a"),
        F.max(F.when(F.col("stage") == b, F.col("value"))).alias("b"))
    runs = settings.select("run").distinct().select(
        "run", F.explode(F.array(*[F.lit(k) for k in keys])).alias("key"))
    both = runs.join(wide, ["run", "key"], "left")
    problem = (F.when(F.col("a").isNull() | F.col("b").isNull(), "missing")
               .when(F.col("a") != F.col("b"), "differs"))
    return both.select("run", "key", problem.alias("problem")).filter("problem IS NOT NULL")


def config_audit(settings: DataFrame) -> DataFrame:
    """(run, level, rule) of every violated rule, for all runs at once.

    ``settings(run, section, key, value)`` with upper-case sections and
    lower-case keys. Missing settings take their defaults.
    """
    def raw(section: str, key: str) -> Column:
        return F.max(F.when((F.col("section") == section) & (F.col("key") == key),
                            F.btrim("value")))

    flags = [f"{k}_enabled" for k in (*EMPIRICAL, *LEARNED)]
    weights = [f"w_{k}" for k in dict.fromkeys((*KEYS, *EMPIRICAL, *LEARNED))]
    names = {"mode": ("UNIDOCK", "search_mode"), "scoring": ("UNIDOCK", "scoring"),
             "batch": ("UNIDOCK", "batch_size"), "chunk": ("CHUNK", "chunk_size"),
             "rescore": ("RESCORE", "enabled"), "gnina": ("RESCORE", "gnina_binary"),
             "refine": ("REFINEMENT", "enabled"), "fraction": ("REFINEMENT", "top_fraction"),
             "refine_mode": ("REFINEMENT", "refinement_mode"),
             **{f: ("RESCORE", f) for f in flags}, **{w: ("RESCORE", w) for w in weights}}
    wide = settings.groupBy("run").agg(*[raw(*at).alias(n) for n, at in names.items()])

    def word(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default))

    def flag(name: str, default: bool) -> Column:
        return F.coalesce(truthy(F.col(name)), F.lit(default))

    def number(name: str, default: float) -> Column:
        return F.coalesce(F.col(name).try_cast("double"), F.lit(float(default)))

    def count(conditions: Sequence[Column]) -> Column:
        return sum((c.cast("int") for c in conditions[1:]), conditions[0].cast("int"))

    rescoring, refining = flag("rescore", True), flag("refine", False)
    on = {k: flag(f"{k}_enabled", k == "vina") for k in (*EMPIRICAL, *LEARNED)}
    empirical, learned = count([on[k] for k in EMPIRICAL]), count([on[k] for k in LEARNED])
    weightless = F.lit(True)
    for k in (*EMPIRICAL, *LEARNED):
        weightless = weightless & (~on[k] | (number(f"w_{k}", 0) == 0))
    needs_gnina = on["vinardo"] | on["ad4"] | on["cnnaffinity"] | on["cnnscore"] | on["dense"]
    negative = F.lit(False)
    for w in (f"w_{k}" for k in KEYS):
        negative = negative | (number(w, 0) < 0)
    scoring = word("scoring", "vina")
    rules = [
        ("error", "search_mode unknown", ~word("mode", "balance").isin(*SEARCH_MODES)),
        ("error", "scoring unknown", ~scoring.isin(*DOCKING_SCORINGS)),
        ("warning", "ad4 needs grid maps", scoring == "ad4"),
        ("warning", "batch larger than chunk", number("batch", 1000) > number("chunk", 5000)),
        ("error", "no active score", rescoring & (empirical + learned == 0)),
        ("warning", "score_vina holds another function", rescoring & on["vina"]
         & (scoring != "vina")),
        ("warning", "empirical scores outweigh", rescoring & (empirical >= 2) & (learned > 0)
         & weightless),
        ("warning", "gnina binary not set", rescoring & needs_gnina & (word("gnina", "") == "")),
        ("error", "negative weight", rescoring & negative),
        ("error", "top_fraction outside (0, 1]", refining
         & ~((number("fraction", 0.15) > 0) & (number("fraction", 0.15) <= 1))),
        ("error", "refinement_mode unknown", refining
         & ~word("refine_mode", "local_only").isin(*REFINEMENT_MODES)),
    ]
    found = F.array_compact(F.array(*[
        F.when(broken, F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule")))
        for level, rule, broken in rules]))
    return wide.select("run", F.inline(found))


def comparability(rankings: DataFrame, manifests: DataFrame) -> DataFrame:
    """Rankings with the parameters of their run; equal ``signature`` is comparable."""
    params = manifests.select(
        "run", "sigma_fraction", F.array_join("active_scores", ",").alias("active_scores"),
        F.array_join("weights", ",").alias("weights"))
    joined = rankings.join(params, "run", "left")
    return joined.withColumn("signature", F.md5(F.concat_ws(
        "|", "sigma_fraction", "active_scores", "weights")))
