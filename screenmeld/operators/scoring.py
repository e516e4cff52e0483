"""External scorers in batches, with halving on resource errors.

The scorer is the user's Python callable; Spark supplies the partitions and the
Arrow batches. A failing row becomes an error row and is never dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from screenmeld.session import stage

# Halving depths of the two kinds of scorer.
DOCKING_DEPTH = 4
CNN_DEPTH = 6

Scorer = Callable[[pd.DataFrame], pd.DataFrame]


class ResourceError(RuntimeError):
    """Raised by a scorer that ran out of memory; the batch is then halved."""


def _score(fn: Scorer, batch: pd.DataFrame, values: Sequence[str], depth: int) -> list[pd.DataFrame]:
    def failed(status: str, error: Exception) -> list[pd.DataFrame]:
        return [batch.assign(**{v: None for v in values}, status=status, error=str(error)[-500:])]

    try:
        out = fn(batch)
    except (ResourceError, MemoryError) as error:
        if depth > 0 and len(batch) > 1:
            half = len(batch) // 2
            return (_score(fn, batch.iloc[:half], values, depth - 1)
                    + _score(fn, batch.iloc[half:], values, depth - 1))
        return failed("ERROR", error)
    except TimeoutError as error:
        return failed("TIMEOUT", error)
    except Exception as error:  # noqa: BLE001 - any scorer error becomes rows
        return failed("ERROR", error)
    scored = batch.assign(**{v: out[v].to_numpy() for v in values})
    missing = scored[list(values)].isna().all(axis=1)
    return [scored.assign(status=missing.map({True: "ERROR", False: "OK"}),
                          error=missing.map({True: "no value", False: None}))]


def score_batches(df: DataFrame, make_scorer: Callable[[], Scorer], values: Sequence[str],
                  batch_size: int = 1000, depth: int = DOCKING_DEPTH) -> DataFrame:
    """Add ``values`` with ``status`` and ``error`` from a batch scorer.

    ``make_scorer`` runs once per task, so a model is loaded once and serves all
    batches of the partition.
    """
    schema = T.StructType([*df.schema.fields,
                           *[T.StructField(v, T.DoubleType()) for v in values],
                           T.StructField("status", T.StringType()),
                           T.StructField("error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make_scorer()
        for frame in frames:
            for start in range(0, len(frame), batch_size):
                yield from _score(fn, frame.iloc[start:start + batch_size], values, depth)

    return df.mapInPandas(run, schema)


def score_unique(entries: DataFrame, key: str, make_scorer: Callable[[], Scorer],
                 values: Sequence[str], batch_size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Score each distinct key once; return scored entries and failed entries."""
    unique = entries.select(key).filter(F.col(key).isNotNull()).distinct()
    # written once: both results read it and the scorer must not run twice
    scored = stage(score_batches(unique, make_scorer, values, batch_size, CNN_DEPTH), "scored")
    good = scored.filter("status = 'OK'").select(key, *values)
    return entries.join(good, key), entries.join(good.select(key), key, "left_anti")
