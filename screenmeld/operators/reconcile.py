"""State of a screening run: done, failed, remaining; merges, blocks, coverage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenmeld.catalog import score
from screenmeld.operators.ordering import Rows, order_preserving_index

KEYS = ("target", "ligand")


def remaining(library: DataFrame, completed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Library entries that are not completed."""
    return library.join(completed.select(*keys), list(keys), "left_anti")


def completed_union(files: DataFrame, log: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Completed by pose file or by log; energies are known from the log only."""
    both = files.select(*keys, F.lit(None).cast("double").alias("energy")).unionByName(
        log.select(*keys, "energy"))
    return both.groupBy(*keys).agg(F.max("energy").alias("energy"))


def append_missing(results: DataFrame, completed: DataFrame,
                   keys: Sequence[str] = KEYS) -> DataFrame:
    """Add completed ligands that the result table lacks, as successes."""
    absent = completed.join(results.select(*keys), list(keys), "left_anti").select(
        *keys, F.lit(True).alias("success"), F.col("energy").alias("best_energy_kcal_mol"),
        F.lit(None).cast("string").alias("error"))
    return results.unionByName(absent)


def last_wins(rows: DataFrame, keys: Sequence[str] = KEYS,
              order: Sequence[str] = ("generation", "file", "line")) -> DataFrame:
    """One row per key, the one that comes last in ``order``.

    An aggregate that combines before the shuffle, so a key with very many
    versions is reduced where its rows are.
    """
    others = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(*order))
    return rows.groupBy(*keys).agg(last.alias("r")).select(*keys, "r.*")


def merge_chunks(chunks: DataFrame, older: DataFrame | None = None,
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """Merge chunk results; an older merged table is the first generation."""
    rows = chunks.withColumn("generation", F.lit(1)) if "generation" not in chunks.columns else chunks
    if older is not None:
        rows = rows.unionByName(older.withColumn("generation", F.lit(0)), allowMissingColumns=True)
    named = rows.filter(F.coalesce("ligand", F.lit("")) != "")
    return last_wins(named, keys)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """New rows replace existing ones with the same key."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return last_wins(both, keys, ("_new",)).drop("_new")


def in_result_order(results: DataFrame) -> DataFrame:
    """Successes by energy with unknown energies last, then failures."""
    energy = F.when(F.col("success"), F.col("best_energy_kcal_mol"))
    return results.orderBy(F.col("success").desc(), energy.asc_nulls_last(), "ligand")


def best_successes(results: DataFrame, n: int = 10) -> DataFrame:
    ok = results.filter("success AND best_energy_kcal_mol IS NOT NULL")
    return ok.orderBy("best_energy_kcal_mol", "target", "ligand").limit(n)


def progress(expected: DataFrame, states: DataFrame) -> DataFrame:
    """Expected, done, failed, handled and remaining per target with a total row.

    ``states(target, ligand, state)`` has ``done`` and ``failed`` rows. Failed
    ligands count as handled, otherwise a run would never end.
    """
    want = expected.groupBy("target").agg(F.count(F.lit(1)).alias("expected"))
    have = states.groupBy("target").agg(F.count_if(F.col("state") == "done").alias("done"),
                                        F.count_if(F.col("state") == "failed").alias("failed"))
    each = want.join(have, "target", "left").select(
        "target", "expected", F.coalesce("done", F.lit(0)).alias("done"),
        F.coalesce("failed", F.lit(0)).alias("failed"))
    handled = F.least(F.col("done") + F.col("failed"), F.col("expected"))
    sized = each.withColumn("handled", handled)
    total = sized.rollup("target").agg(*[F.sum(c).alias(c) for c in
                                         ("expected", "done", "failed", "handled")])
    return total.select(
        F.coalesce("target", F.lit("TOTAL")).alias("target"), "expected", "done", "failed", "handled",
        (F.col("expected") - F.col("handled")).alias("remaining"),
        (F.col("handled") * 100.0 / F.when(F.col("expected") > 0, F.col("expected")))
        .alias("handled_pct"))


def assign_blocks(files: DataFrame, size: int, name: str = "block", rows: Rows = None,
                  order: Sequence[str] = ("ligand",)) -> DataFrame:
    """Block number by position in the sorted list of each target."""
    placed = order_preserving_index(files, ["target"], list(order), "_at", rows)
    return placed.select(*files.columns, F.floor(F.col("_at") / size).cast("long").alias(name))


def block_progress(files: DataFrame, blocks: DataFrame, size: int,
                   ranked: DataFrame | None = None) -> DataFrame:
    """Blocks expected, done, stale and remaining per target with a total row.

    ``files(target, ligand)`` are the docked ligands, ``blocks(target, block)``
    the saved blocks. A target with a final ranking is complete. The first
    valid block must hold as many distinct ligands as its place demands,
    otherwise the block size was changed; ``blocks`` then needs ``ligand``.
    """
    count = files.groupBy("target").agg(F.count_distinct("ligand").alias("n"))
    sized = count.withColumn("blocks", F.ceil(F.col("n") / (size if size > 0 else F.col("n"))))
    saved = blocks.groupBy("target", "block").agg(F.count_distinct("ligand").alias("held"))
    joined = sized.join(saved, "target", "left")
    valid = F.col("block") < F.col("blocks")
    part = joined.groupBy("target", "n", "blocks").agg(
        F.count_if(valid).alias("saved"), F.count_if(F.col("block") >= F.col("blocks")).alias("stale"),
        F.min_by(F.struct("block", "held"), F.when(valid, F.col("block"))).alias("first"))
    demand = F.least(F.lit(size), F.col("n") - F.col("first.block") * size)
    part = part.withColumn("inconsistent", F.coalesce(
        (F.lit(size) > 0) & (F.col("first.held") != demand), F.lit(False)))
    if ranked is not None:
        final = ranked.select("target").distinct().withColumn("_final", F.lit(True))
        part = part.join(final, "target", "left")
    else:
        part = part.withColumn("_final", F.lit(None).cast("boolean"))
    final = F.coalesce("_final", F.lit(False))
    done = F.when(F.col("inconsistent"), F.lit(0)).otherwise(F.col("saved"))
    each = part.select(
        "target", "n", F.when(final, 0).otherwise(F.col("blocks")).alias("blocks"),
        F.when(final, 0).otherwise(done).alias("done"),
        F.when(final, 0).otherwise(F.col("stale")).alias("stale"),
        (F.col("inconsistent") & ~final).cast("int").alias("inconsistent"),
        final.cast("int").alias("ranked"))
    total = each.rollup("target").agg(*[F.sum(c).cast("long").alias(c) for c in
                                        ("n", "blocks", "done", "stale", "inconsistent", "ranked")])
    return total.select(F.coalesce("target", F.lit("TOTAL")).alias("target"), "n", "blocks", "done",
                        (F.col("blocks") - F.col("done")).alias("remaining"), "stale",
                        "inconsistent", "ranked")


def coverage(partials: DataFrame, scores: Iterable[str], minimum: float = 0.99,
             by: Sequence[str] = ("target", "block")) -> DataFrame:
    """Share of filled scores per block and score, for all scores at once."""
    keys = list(scores)
    part = partials.groupBy(*by).agg(F.count(F.lit(1)).alias("poses"),
                                     *[F.count(score(k).column).alias(f"_n_{k}") for k in keys])
    entries = F.array(*[F.struct(F.lit(k).alias("score"), F.lit(score(k).gated).alias("gated"),
                                 (F.col(f"_n_{k}") / F.col("poses")).alias("coverage"))
                        for k in keys])
    out = part.select(*by, "poses", F.inline(entries))
    return out.select("*", (~F.col("gated") | (F.col("coverage") >= minimum)).alias("passed"))


def gated_blocks(partials: DataFrame, scores: Iterable[str], minimum: float = 0.99,
                 by: Sequence[str] = ("target", "block")) -> tuple[DataFrame, DataFrame]:
    """Rows of blocks that pass the coverage gate, and those that do not."""
    bad = coverage(partials, scores, minimum, by).filter(~F.col("passed")).select(*by).distinct()
    keys = list(by)
    return partials.join(bad, keys, "left_anti"), partials.join(bad, keys, "left_semi")


def assemble_scores(energies: DataFrame, parts: Sequence[DataFrame],
                    keys: Sequence[str] = ("target", "ligand", "pose")) -> DataFrame:
    """Energies with further score tables attached; the energies decide the rows."""
    out = energies
    for p in parts:
        out = out.join(p, list(keys), "left")
    return out


def back_fill(poses: DataFrame, extra: DataFrame, column: str,
              keys: Sequence[str] = ("target", "ligand", "pose")) -> DataFrame:
    """Take a score from ``extra`` where the pose has none."""
    late = extra.select(*keys, F.col(column).alias("_late"))
    joined = poses.join(late, list(keys), "left")
    return joined.select(*[F.coalesce(c, F.col("_late")).alias(c) if c == column else F.col(c)
                           for c in poses.columns])


def name_collisions(files: DataFrame, examples: int = 3) -> DataFrame:
    """Stems that occur in several paths, with the first few paths.

    Only the first paths of a name are gathered: the limit on the row number is
    applied before the shuffle as well.
    """
    counts = files.groupBy("stem").agg(F.count(F.lit(1)).alias("files")).filter("files > 1")
    along = Window.partitionBy("stem").orderBy("path")
    few = (files.select("stem", "path", F.row_number().over(along).alias("_r"))
           .filter(F.col("_r") <= examples).groupBy("stem")
           .agg(F.array_sort(F.collect_list("path")).alias("examples")))
    return counts.join(few, "stem")


def library_profile(files: DataFrame, by: Sequence[str] = ("lib",), flat: str = "flat") -> DataFrame:
    """Files, folders, files without a folder and empty files per library."""
    return files.groupBy(*by).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col(flat)).alias("flat_files"),
        F.count_distinct(F.when(~F.col(flat), F.col("folder"))).alias("folders"),
        F.count_if(F.col("length") == 0).alias("empty_files"))


def catalogue_difference(a: DataFrame, b: DataFrame, key: str,
                         values: Sequence[str]) -> DataFrame:
    """Entries that only one catalogue has or that differ, with the reason."""
    left = a.select(key, *[F.col(v).alias(f"a_{v}") for v in values], F.lit(True).alias("_a"))
    right = b.select(key, *[F.col(v).alias(f"b_{v}") for v in values], F.lit(True).alias("_b"))
    both = left.join(right, key, "full_outer")
    differs = F.lit(False)
    for v in values:
        differs = differs | ~F.col(f"a_{v}").eqNullSafe(F.col(f"b_{v}"))
    reason = (F.when(F.col("_b").isNull(), "only in a").when(F.col("_a").isNull(), "only in b")
              .when(differs, "differs"))
    return both.select(key, reason.alias("reason")).filter("reason IS NOT NULL")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of exactly one of the tables, with their side."""
    return a.subtract(b).withColumn("side", F.lit("a")).unionByName(
        b.subtract(a).withColumn("side", F.lit("b")))


def archive_accounting(files: DataFrame) -> DataFrame:
    """Per run: pose files, rankings, targets and targets without a ranking."""
    is_pose = F.col("kind") == "pose"
    ranked = (F.col("kind") == "ranking") & (F.col("length") > 0)
    each = files.groupBy("run", "target").agg(F.count_if(is_pose).alias("poses"),
                                              F.max(ranked.cast("int")).alias("ranked"))
    return each.groupBy("run").agg(
        F.count(F.lit(1)).alias("targets"), F.sum("poses").alias("poses"),
        F.sum("ranked").cast("long").alias("rankings"),
        F.sum(1 - F.col("ranked")).cast("long").alias("without_ranking"))


def missing_entries(runs: DataFrame, present: DataFrame, required: Sequence[str]) -> DataFrame:
    """Required archive entries that a run does not have."""
    wanted = runs.select("run", F.explode(F.array(*[F.lit(r) for r in required])).alias("entry"))
    return wanted.join(present.select("run", "entry"), ["run", "entry"], "left_anti")


def progress_json(table: DataFrame, columns: Mapping[str, Column] | None = None) -> DataFrame:
    """One JSON text per row."""
    cols = [F.col(c) for c in table.columns] if columns is None else [
        c.alias(n) for n, c in columns.items()]
    return table.select(F.to_json(F.struct(*cols)).alias("json"))
