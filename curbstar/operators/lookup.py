"""Foreign-key lookups: left joins of a fact to a dimension on natural keys."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbstar.sources.store import Store

# A dimension is broadcast when its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Beyond it, a key with at least HOT_ROWS fact rows and one in HOT_SHARE of all is looked up apart,
# and its rows are spread over SPREAD pieces instead of meeting in one task. So there are at most
# HOT_SHARE hot keys; keys whose texts pass HOT_KEY_BYTES take the usual way.
HOT_ROWS = 1_000_000
HOT_SHARE = 10_000
HOT_KEY_BYTES = 1024
SPREAD = 1 << 20
# Counters of the sketch that hot keys are looked for with.
SKETCH_BUCKETS = 1 << 18


@dataclass(frozen=True)
class Lookup:
    """One foreign key of a fact.

    ``on`` maps dimension columns to fact columns or expressions. Keys listed in ``null_safe``
    (or all, with True) match NULL to NULL; ``null_as`` gives a text that stands for NULL on both
    sides; any other NULL key matches nothing.
    """

    dim: DataFrame
    key: str
    on: Mapping[str, str | Column]
    name: str | None = None
    null_safe: bool | Collection[str] = False
    null_as: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Hot:
    """How to find hot keys (where, from how many rows on) and what to spread their rows by."""

    counted_in: DataFrame
    rows: int
    spread_by: tuple[str, ...]


def natural(*cols: str) -> dict[str, str]:
    """``on`` for columns that have the same name on both sides."""
    return {c: c for c in cols}


def measured_bytes(frames: Sequence[DataFrame]) -> list[int]:
    """Upper bound of the data in each frame, from one job over all of them."""
    if not frames:
        return []
    sizes = [
        df.agg(F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes")).select(
            F.lit(i).alias("frame"), "bytes"
        )
        for i, df in enumerate(frames)
    ]
    found = {row.frame: row.bytes for row in reduce(DataFrame.unionByName, sizes).collect()}
    return [found[i] for i in range(len(frames))]


def _row_bytes(df: DataFrame) -> Column:
    width = F.lit(16 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
    return width


def lookup_fk(
    fact: DataFrame,
    lookup: Lookup,
    small: bool | None = None,
    spread_by: Sequence[str] = (),
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """``fact`` plus the dimension's key (NULL where nothing matches); no fact row is lost.

    The dimension should be a written table: it is measured first, and broadcast only when small.
    ``small`` skips the measuring. A large dimension is joined by a shuffle in which hot keys and
    keys that cannot match are spread by a hash of ``spread_by`` (default: the whole fact row).
    Hot keys are counted in ``hot_from``, a cheaper table with the fact's key columns, if given.
    """
    taken = {lookup.name or lookup.key: lookup.key}
    hot = Hot(hot_from or fact, hot_rows or HOT_ROWS, tuple(spread_by or fact.columns))
    return _attach(fact, lookup.dim, _key_pairs(lookup), taken, "left", small, hot)


def lookup_columns(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str | Column],
    columns: Sequence[str],
    small: bool | None = None,
    spread_by: Sequence[str] = (),
    hot_rows: int | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """``fact`` rows with a match in ``dim``, plus some of its columns; joined as in lookup_fk."""
    pairs = _key_pairs(Lookup(dim, "", on))
    hot = Hot(hot_from or fact, hot_rows or HOT_ROWS, tuple(spread_by or fact.columns))
    return _attach(fact, dim, pairs, {c: c for c in columns}, "inner", small, hot)


def lookup_role(
    fact: DataFrame, date_dim: DataFrame, roles: Mapping[str, str], key: str = "date_key"
) -> DataFrame:
    """Several date keys from one day-grain dimension: ``{timestamp column: key name}``."""
    small = measured_bytes([date_dim.select("full_date", key)])[0] <= BROADCAST_BYTES
    found = fact
    for ts, name in roles.items():
        role = Lookup(date_dim, key, {"full_date": F.to_date(ts)}, name)
        found = lookup_fk(found, role, small, hot_from=fact)
    return found


def star_lookups(
    dims: Mapping[str, DataFrame], keys: Mapping[str, tuple[str, Sequence[str], bool]]
) -> list[Lookup]:
    """Lookups into the given dimensions: ``keys`` maps each to (key, natural key, null-safe)."""
    return [
        Lookup(dims[name], key, natural(*cols), null_safe=null_safe)
        for name, (key, cols, null_safe) in keys.items()
        if name in dims
    ]


def build_fact(
    staged: DataFrame,
    lookups: Sequence[Lookup],
    columns: Sequence[str | Column],
    counted_in: DataFrame | None = None,
) -> DataFrame:
    """Staged rows, every foreign key, then the fact's columns.

    ``counted_in`` is the staged table itself where ``staged`` carries joins already; hot keys are
    counted there.
    """
    sizes = measured_bytes([lookup.dim.select(lookup.key, *lookup.on) for lookup in lookups])
    fact = staged
    for lookup, size in zip(lookups, sizes):
        fact = lookup_fk(fact, lookup, size <= BROADCAST_BYTES, hot_from=counted_in or staged)
    return fact.select(*columns)


def _attach(
    fact: DataFrame,
    dim: DataFrame,
    pairs: Sequence[tuple[Column, Column, bool]],
    taken: Mapping[str, str],
    how: str,
    small: bool | None,
    hot: Hot,
) -> DataFrame:
    """``fact`` with the ``taken`` columns of ``dim``, under their new names."""
    right = dim.select(
        *[d.alias(f"_d{i}") for i, (d, _, _) in enumerate(pairs)],
        *[F.col(c).alias(name) for name, c in taken.items()],
    )
    keys = {f"_f{i}": f for i, (_, f, _) in enumerate(pairs)}
    left = fact.withColumns(keys)
    tolerant = [t for _, _, t in pairs]
    if small is None:
        small = measured_bytes([right])[0] <= BROADCAST_BYTES
    if small:
        found = left.join(F.broadcast(right), _condition(tolerant, "_f", "_d"), how)
    else:
        hot_keys = _hot_keys(hot, keys)
        found = _spread_join(left, right, tolerant, list(taken), hot_keys, hot.spread_by)
        if how == "inner":
            found = found.filter(F.col("_matched"))
    return found.select(*fact.columns, *taken)


def _key_pairs(lookup: Lookup) -> list[tuple[Column, Column, bool]]:
    """(dimension column, fact column, NULL matches NULL) per natural key."""
    pairs = []
    for dim_col, fact_col in lookup.on.items():
        d = F.col(dim_col)
        f = F.col(fact_col) if isinstance(fact_col, str) else fact_col
        if dim_col in lookup.null_as:
            blank = F.lit(lookup.null_as[dim_col])
            d, f = F.coalesce(d, blank), F.coalesce(f, blank)
        tolerant = lookup.null_safe if isinstance(lookup.null_safe, bool) else dim_col in lookup.null_safe
        pairs.append((d, f, tolerant))
    return pairs


def _condition(tolerant: Sequence[bool], left: str, right: str) -> Column:
    tests = []
    for i, null_safe in enumerate(tolerant):
        a, b = F.col(f"{left}{i}"), F.col(f"{right}{i}")
        tests.append(a.eqNullSafe(b) if null_safe else a == b)
    return reduce(Column.__and__, tests)


def key_sketch(rows: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """``bucket, rows``: how many rows fall into each of SKETCH_BUCKETS hash buckets of their key.

    A task sends a row per bucket at most, however many keys it has seen; sketches of several
    tables add up by bucket.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(SKETCH_BUCKETS)).cast("int")
    return rows.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"))


def _hot_keys(hot: Hot, keys: Mapping[str, Column]) -> DataFrame:
    """The hot keys, HOT_SHARE at most and of bounded width, so safe to broadcast.

    A bucket of the sketch holds at least the rows of each of its keys, so only keys in heavy buckets
    are counted one by one. Which keys count as hot never changes a result, but all readers must
    agree on them, so they are written.
    """
    store = Store.scratch(hot.counted_in.sparkSession)
    named = [key.alias(f"_h{i}") for i, key in enumerate(keys.values())]
    counted = hot.counted_in.select(*named)
    columns = [F.col(c) for c in counted.columns]
    sketch = store.table("lookups", "sketch", key_sketch(counted, columns))
    total = sketch.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    least = max(hot.rows, -(-total // HOT_SHARE))
    heavy = sketch.filter(F.col("rows") >= least).select("bucket")
    bucket = F.pmod(F.xxhash64(*columns), F.lit(SKETCH_BUCKETS)).cast("int")
    hottest = (
        counted.withColumn("bucket", bucket)
        .join(F.broadcast(heavy), "bucket", "left_semi")
        .groupBy(*counted.columns)
        .agg(F.count("*").alias("_rows"))
        .filter((F.col("_rows") >= least) & (_row_bytes(counted) <= HOT_KEY_BYTES))
    )
    return store.table("lookups", "hot_keys", hottest.drop("_rows"))


def _spread_join(
    keyed: DataFrame,
    dim: DataFrame,
    tolerant: Sequence[bool],
    taken: Sequence[str],
    hot_keys: DataFrame,
    spread_by: Sequence[str],
) -> DataFrame:
    """Left join to a large dimension that no hot key can slow down.

    Hot keys get their dimension row up front. Their rows, and rows whose key cannot match, then
    enter the shuffle with a piece number that no dimension row carries, which spreads them
    evenly. All other rows carry piece -1, like the dimension, and match as usual.
    """
    n = len(tolerant)
    # Always -1, but computed: the optimizer would drop a literal from the shuffle keys.
    marked = dim.withColumn("_dim_piece", F.pmod(F.xxhash64("_d0"), F.lit(1)).cast("int") - 1)
    matched = marked.join(F.broadcast(hot_keys), _condition(tolerant, "_h", "_d")).select(
        *[F.col(f"_h{i}").alias(f"_m{i}") for i in range(n)],
        *[F.col(c).alias(f"_hot_{c}") for c in taken],
        F.lit(True).alias("_hot_found"),
    )
    hot = hot_keys.join(matched, _condition([True] * n, "_h", "_m"), "left").select(
        *hot_keys.columns,
        *[f"_hot_{c}" for c in taken],
        F.col("_hot_found").isNotNull().alias("_hot_matched"),
    )
    # NULL keys of the hot list must find themselves, whatever the lookup's own NULL rule.
    with_hot = keyed.join(F.broadcast(hot), _condition([True] * n, "_f", "_h"), "left")

    unmatchable = F.lit(False)
    for i, null_safe in enumerate(tolerant):
        if not null_safe:
            unmatchable = unmatchable | F.col(f"_f{i}").isNull()
    apart = F.col("_hot_matched").isNotNull() | unmatchable
    piece = F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int")
    pieced = with_hot.withColumn("_piece", F.when(apart, piece).otherwise(F.lit(-1)))
    same_piece = F.col("_piece") == F.col("_dim_piece")
    found = pieced.join(marked, _condition(tolerant, "_f", "_d") & same_piece, "left")
    return found.select(
        *[c for c in pieced.columns if not c.startswith("_hot_")],
        *[F.coalesce(F.col(f"_hot_{c}"), F.col(c)).alias(c) for c in taken],
        F.coalesce(F.col("_hot_matched"), F.col("_dim_piece").isNotNull()).alias("_matched"),
    )
