"""Named queries over the given tables; importing the package registers them."""

from screenmeld.plans import (  # noqa: F401
    evaluation,
    files,
    operations,
    ranking,
    reports,
    resampling,
    streams,
    texts,
    validation,
)
from screenmeld.plans.registry import QUERIES, SQL  # noqa: F401
