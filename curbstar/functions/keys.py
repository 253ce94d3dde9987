"""Hashed surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbstar import fixed_values as fv


def hash_key(*cols: Column | str) -> Column:
    """md5 over the text of the columns, with a marker in place of NULL."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(fv.HASH_KEY_NULL))
        for c in cols
    ]
    return F.md5(F.concat_ws(fv.HASH_KEY_SEPARATOR, *parts).cast("binary"))


def hash_fk(*cols: Column | str, required: Sequence[Column | str] | None = None) -> Column:
    """Foreign key to a hashed dimension that is built from the same rows, without a join.

    Such a dimension holds every combination of ``cols``, so looking the key up again would only
    recompute it. NULL in a ``required`` column (default: any) means no match, as in an equi-join.
    """
    needed = list(cols) if required is None else list(required)
    present = F.lit(True)
    for c in needed:
        present = present & (F.col(c) if isinstance(c, str) else c).isNotNull()
    return F.when(present, hash_key(*cols))
