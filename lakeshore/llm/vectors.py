"""What the vector operators share: which vectors take part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(embedding: Column) -> Column:
    """Not null, not empty, without null or non-finite components, not zero
    (never null itself)."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))
