"""Mixing sources to target word counts by entropy balancing, without Python in the tasks.

Of all rates near one copy for each document, in entropy, those that give source ``s`` its target are
exponentially tilted by size: ``rate = exp(lambda_s * size)``, held at two copies. The dual is convex,
and each Newton step needs the words ``sum(size * rate)`` and their slope ``sum(size ** 2 * rate)`` of
every source: one aggregate over all documents, of which only those of different size differ. A step
that leaves the bracket of what is known halves it instead.

Rates become whole copies by systematic rounding: documents of a shard (a bounded, hashed part of a
source) are laid out by falling size on a line of cumulative rates, and each takes as many copies as
there are whole numbers in its stretch. What a source then misses is made up by one copy more or less
of a few documents, the largest that still fit first. Sums are exact numbers and every order is total,
so the result depends on the rows alone, not on files, partitions or reruns.

Defined results: a null or blank text has size 0, adds no words and is taken once; a null source is a
source of its own, after all others; repeated rows are separate documents that share their copies as
evenly as whole numbers allow; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbstar.llm.common import Scratch, count_words

WEIGHTS, SHARE, MOST_COPIES = (5, 2, 1), 1.5, 2
#: Documents of a source that are rounded on one line.
SHARD_ROWS = 20_000
#: Newton's steps end when every source is this near its target, relatively.
NEAR, MOST_STEPS = 1e-9, 80
#: Rounds at most that make up for rounding (they end when no source gets nearer), and documents of one
#: size that a round may change.
MENDS, MEND_UNITS = 32, 64
#: Rates count in whole numbers of this part.
UNIT = 1 << 30
#: Copies of repeated rows that one task writes.
CHUNK_COPIES = 256


def _units(docs: DataFrame) -> DataFrame:
    """Rows that agree in id, source and text, as one unit of ``n``: ``doc_id, source, size, row_key``."""
    return (
        docs.select("doc_id", "source", count_words().alias("size"), _row_key().alias("row_key"))
        .groupBy("doc_id", "source", "size", "row_key")
        .agg(F.count("*").alias("n"))
    )


def _row_key() -> Column:
    return F.xxhash64("doc_id", "source", "text")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, rows, target`` from ``source, size, n``.

    Targets are proportional to the weights except where ``most`` times the source's size is less:
    with sources by rising size per weight, the first ``k`` are held at that bound, where ``k`` is
    the smallest number after which no other exceeds its own.
    """
    sums = sized.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int")
    )
    by_bound = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_bound.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = by_bound.rowsBetween(0, Window.unboundedFollowing)
    level = sums.withColumn("weight", weight).withColumn(
        "level",
        (F.sum("source_size").over(everything) * share
         - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
        / F.sum("weight").over(after),
    )
    free = F.col("source_size") * most >= F.col("weight") * F.col("level")
    first_free = F.min(F.when(free, F.struct("order", "level"))).over(everything)["level"]
    return level.withColumn("order", F.row_number().over(by_bound)).select(
        "source", "source_size", "rows",
        F.least(
            F.col("source_size") * float(most),
            F.coalesce(F.col("weight") * first_free, F.col("source_size") * float(most)),
        ).alias("target"),
    )


def _rate(most: int) -> Column:
    """The tilted rate of a document, in whole units."""
    tilted = F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(700.0)))
    return F.round(F.least(tilted, F.lit(float(most))) * UNIT).cast("long")


def _by_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the columns of their source."""
    named = sources.withColumnRenamed("source", "of_source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")


def tilts(kinds: DataFrame, targets: DataFrame, scratch: Scratch, most: int = MOST_COPIES) -> DataFrame:
    """Newton's iteration on the dual: ``targets`` with ``tilt`` and ``mean`` (its unit of size).

    ``kinds`` has ``source, size, n``: how many documents have that size.
    """
    worded = kinds.where("size > 0")
    sizes = worded.groupBy("source").agg(
        F.min("size").alias("least"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"),
    )
    # at the upper end of the bracket, every document has its most copies
    upper = F.col("mean") / F.col("least") * math.log(most)
    more = F.col("target") > F.col("source_size")
    full = F.col("target") >= F.col("source_size") * most
    state = _by_source(targets, sizes).select(
        *targets.columns, "mean",
        F.when(full, upper).otherwise(F.lit(0.0)).alias("tilt"),
        F.when(more, F.lit(0.0)).alias("low"),
        F.when(more, upper).otherwise(F.lit(0.0)).alias("high"),
        full.alias("done"),
    )
    state = scratch.write("tilt-0", state)
    words = F.col("n").cast("decimal(18,0)") * (F.col("size") * F.col("rate")).cast("decimal(20,0)")
    pull = F.round(F.col("size") / F.col("mean") * 1000).cast("decimal(18,0)")
    for step in range(1, MOST_STEPS + 1):
        if not state.where("not done").count():
            break
        sums = (
            _by_source(worded, state.select("source", "mean", "tilt"))
            .withColumn("rate", _rate(most))
            .groupBy("source")
            .agg(
                F.sum(words).cast("double").alias("words"),
                F.sum(F.when(F.col("rate") < most * UNIT, words.cast("decimal(38,0)") * pull))
                .cast("double").alias("slope"),
            )
        )
        at = _by_source(state, sums).withColumns(
            {"words": F.col("words") / UNIT, "slope": F.col("slope") / (1000.0 * UNIT)}
        )
        off = F.col("words") - F.col("target")
        at = at.withColumns({
            "low": F.when(off < 0, F.col("tilt")).otherwise(F.col("low")),
            "high": F.when(off >= 0, F.col("tilt")).otherwise(F.col("high")),
            "newton": F.when(F.col("slope") > 0, F.col("tilt") - off / F.col("slope")),
            "done": F.col("done") | (F.abs(off) <= NEAR * F.col("target")),
        })
        inside = (F.col("newton") > F.coalesce("low", F.lit(-math.inf))) & (
            F.col("newton") < F.coalesce("high", F.lit(math.inf))
        )
        halved = (F.col("low") + F.col("high")) / 2
        following = F.when(inside, F.col("newton")).otherwise(F.coalesce(halved, F.col("tilt")))
        at = at.withColumn("tilt", F.when(F.col("done"), F.col("tilt")).otherwise(following))
        state = scratch.write(f"tilt-{step}", at.select(*state.columns))
        scratch.drop(f"tilt-{step - 1}")
    # sources without words have no tilt; their documents add nothing
    return targets.join(
        state.select(F.col("source").alias("of_source"), "tilt", "mean"),
        F.col("source").eqNullSafe(F.col("of_source")), "left",
    ).select(
        *targets.columns, F.coalesce("tilt", F.lit(0.0)).alias("tilt"),
        F.coalesce("mean", F.lit(1.0)).alias("mean"),
    )


def _rounded(units: DataFrame, tilted: DataFrame, most: int) -> DataFrame:
    """Units with their copies, by systematic rounding on the lines of their source."""
    line = Window.partitionBy("source", "shard").orderBy(
        F.desc("size"), F.xxhash64("row_key"), "doc_id", "row_key"
    )
    end = F.sum("span").over(line.rowsBetween(Window.unboundedPreceding, 0)) + UNIT // 2
    whole = lambda x: F.shiftright(x, UNIT.bit_length() - 1)
    shards = F.ceil(F.col("rows") / F.lit(SHARD_ROWS))
    return (
        _by_source(units, tilted)
        .withColumn("span", _rate(most) * F.col("n"))
        # a unit of very many rows is a line of its own, and needs no other to be rounded
        .withColumn("whole_rows", F.when(F.col("n") > SHARD_ROWS, F.col("row_key")))
        .withColumn(
            "shard",
            F.coalesce("whole_rows", F.pmod(F.xxhash64("row_key"), shards)).cast("long"),
        )
        .withColumn("end", end)
        .withColumn("copies", whole(F.col("end")) - whole(F.col("end") - F.col("span")))
        .withColumn("copies", F.least("copies", F.col("n") * most).cast("long"))
        .select("doc_id", "row_key", "source", "size", "n", "source_size", "target", "copies")
    )


def _mended(rounded: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """A copy more or less of a few units of each source, which brings it nearer to its target."""
    missing = rounded.groupBy("source").agg(
        F.round(F.first("target") - F.sum(F.col("size") * F.col("copies"))).cast("long").alias("missing")
    )
    # how many units of each size can change by a copy, either way
    able = scratch.write(
        "able",
        rounded.where("size > 0")
        .groupBy("source", "size")
        .agg(
            F.count_if(F.col("copies") < F.col("n") * most).alias("up"),
            F.count_if(F.col("copies") > 0).alias("down"),
        ),
    )
    state = scratch.write(
        "missing-0",
        missing.select(
            "source", "missing", F.array().cast("array<bigint>").alias("used"),
            F.lit(None).cast("long").alias("size"), F.lit(0).cast("long").alias("times"),
            F.lit(False).alias("more"),
        ),
    )
    rounds = []
    for k in range(1, MENDS + 1):
        before = state.select("source", "missing", "used", (F.col("missing") > 0).alias("more"))
        off = F.abs("missing")
        fitting = F.least("left", F.floor(off / F.col("size")), F.lit(MEND_UNITS))
        nearest = (
            _by_source(able, before)
            .withColumn("left", F.when(F.col("more"), F.col("up")).otherwise(F.col("down")))
            .withColumn("times", F.greatest(fitting, F.lit(1)).cast("long"))
            .withColumn("after", off - F.col("times") * F.col("size"))
            .where((F.col("left") > 0) & (F.abs("after") < off) & ~F.array_contains("used", F.col("size")))
            .groupBy("source")
            .agg(F.min(F.struct(F.abs("after"), "size", "times", "after", "more", "used")).alias("b"))
            .select("source", "b.size", "b.times", "b.after", "b.more", "b.used")
        )
        state = scratch.write(
            f"missing-{k}",
            nearest.select(
                "source", F.when(F.col("more"), F.col("after")).otherwise(-F.col("after")).alias("missing"),
                F.array_append("used", F.col("size")).alias("used"), "size", "times", "more",
            ),
        )
        rounds.append(state)
        if state.isEmpty():
            break
    picks = rounds[0]
    for more in rounds[1:]:
        picks = picks.unionByName(more)
    picks = picks.select(
        F.col("source").alias("of_source"), F.col("size").alias("of_size"), "more", "times"
    )
    same = F.col("source").eqNullSafe(F.col("of_source")) & (F.col("size") == F.col("of_size"))
    can = F.when(F.col("more"), F.col("copies") < F.col("n") * most).otherwise(F.col("copies") > 0)
    place = F.row_number().over(
        Window.partitionBy("source", "size").orderBy(F.xxhash64("row_key"), "doc_id", "row_key")
    )
    changed = (
        rounded.join(picks, same)
        .where(can)
        .withColumn("place", place)
        .where(F.col("place") <= MEND_UNITS)
        .where(F.col("place") <= F.col("times"))
        .select(
            F.col("doc_id").alias("of_doc"), F.col("row_key").alias("of_key"),
            F.when(F.col("more"), 1).otherwise(-1).alias("step"),
        )
    )
    changed = scratch.write("changed", changed)
    # a row key holds id, source and text; the id is compared in case two of them share a key
    that = (F.col("row_key") == F.col("of_key")) & F.col("doc_id").eqNullSafe(F.col("of_doc"))
    return (
        rounded.join(changed, that, "left")
        .withColumn("copies", F.col("copies") + F.coalesce("step", F.lit(0)))
        .drop("of_doc", "of_key", "step")
    )


def balanced(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Units of equal rows with the copies that they take together:
    ``doc_id, row_key, source, size, n, source_size, target, copies``."""
    units = scratch.write("units", _units(docs))
    kinds = scratch.write("kinds", units.groupBy("source", "size").agg(F.sum("n").alias("n")))
    targets = scratch.write("targets", source_targets(kinds))
    tilted = scratch.write("tilts", tilts(kinds, targets, scratch))
    rounded = scratch.write("rounded", _rounded(units, tilted, MOST_COPIES))
    return scratch.write("copies", _mended(rounded, scratch, MOST_COPIES))


def mix(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Copies of every row: ``doc_id, size, source_size, target, copies, taken, row_key, repeat``.

    ``row_key`` is a hash of id, source and text that finds the row again; rows that agree in all of
    these are numbered by ``repeat``.
    """
    units = balanced(docs, scratch or Scratch(docs.sparkSession))
    each = F.col("copies").cast("long")
    # numbers of equal rows, in pieces of bounded length
    pieces = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(CHUNK_COPIES).cast("long"))
    rows = units.withColumn("first", F.explode(pieces)).withColumn(
        "repeat",
        F.explode(F.sequence(
            F.col("first"), F.least(F.col("first") + CHUNK_COPIES, F.col("n")) - 1
        )),
    )
    copies = F.floor(each / F.col("n")) + F.when(
        F.col("repeat") < F.pmod(each, F.col("n")), 1
    ).otherwise(0)
    return rows.withColumn("copies", copies.cast("int")).select(
        "doc_id", "size", "source_size", "target", "copies",
        (F.col("size") * F.col("copies")).alias("taken"), "row_key", "repeat",
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents in the mix, each as often as it has copies, with all columns.

    Of rows that agree in id, source and text, one stands for all and is written as often as they are
    taken together.
    """
    units = balanced(docs, Scratch(docs.sparkSession)).where("copies > 0")
    units = units.select("row_key", F.col("doc_id").alias("of_doc"), "n", "copies")
    # the row as one column, so that no name of the table can clash
    keyed = docs.select(_row_key().alias("key"), F.struct(*docs.columns).alias("row"))
    same = (F.col("key") == F.col("row_key")) & F.col("row.doc_id").eqNullSafe(F.col("of_doc"))
    taken = keyed.join(units, same)
    single = taken.where("n = 1").withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
    pieces = F.expr(f"sequence(1L, copies, {CHUNK_COPIES}L)")
    several = (
        taken.where("n > 1")
        .groupBy("row_key", "of_doc")
        .agg(F.first("row").alias("row"), F.first("copies").alias("copies"))
        .withColumn("piece", F.explode(pieces))
        .repartition(F.col("row_key"), F.col("piece"))
        .withColumn(
            "copy", F.explode(F.expr(f"sequence(piece, least(piece + {CHUNK_COPIES - 1}, copies))"))
        )
    )
    return single.select("row.*").unionByName(several.select("row.*"))
