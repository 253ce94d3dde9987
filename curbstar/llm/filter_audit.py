"""What each filter removes, in every order of the filters, from relations of failing ids.

Every filter stores the table of rows that fail it. Left-semi and left-anti joins with these tables
split the rows, filter by filter, into those that fail and those that pass; rows that fail the same
filters end in one class, whose labels are counted by part. The classes that fail any filter of a
prefix are a relation too: what survives the prefix is the classes left over by an anti join with
it, and what the next filter removes are the survivors that fail it. Only row numbers move in the
joins on rows; what follows has at most ``4 ** filters`` rows for each part.

Defined results: a null text is empty; a text without words fails no rule on shares; a null source
is the part ``''``, like an empty one; a null id is neither smaller nor larger than any, so its row
never fails as a copy and has no labels; rows with equal ids are rows of their own, and of equal
texts under one id none is a copy of the other; an id with several labels counts as good or toxic if
any of them says so; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from itertools import combinations, permutations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbstar.llm.common import Scratch

WORD_GAP = r"[\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKS = 200, 50, 2, "[#$%&*|]"

# From the measured rows (and a scratch space) to the failing ones, column ``row``.
Filter = Callable[[DataFrame, Scratch], DataFrame]


def measured(docs: DataFrame) -> DataFrame:
    """What the filters ask of every row, from one pass over the whole texts."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, WORD_GAP), "")
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.coalesce("source", F.lit("")).alias("part"),
        F.size(words).cast("long").alias("words"),
        F.size(F.array_distinct(words)).cast("long").alias("distinct_words"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("capitals"),
        F.char_length(text).cast("long").alias("chars"),
        F.regexp_like(text, F.lit(MARKS)).alias("marked"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )


def failing(rule: str) -> Filter:
    return lambda rows, _: rows.where(rule).select("row")


def copies(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows whose text a smaller id has too, anywhere in the table."""
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n"))
    # written, so that the join below has a plain exchange on both sides and can split a hot text
    repeated = scratch.write("repeated", texts.where("n > 1").select("digest", "least_id"))
    return (
        rows.select("row", "doc_id", "digest")
        .join(repeated, "digest")
        .where("doc_id > least_id")
        .select("row")
    )


FILTERS: dict[str, Filter] = {
    "A": failing(f"words < {LEAST_WORDS}"),
    "B": failing(f"100 * distinct_words < {LEAST_DISTINCT} * words"),
    "C": failing(f"100 * capitals > {MOST_CAPITALS} * chars"),
    "D": failing("marked"),
    "E": copies,
}


def failing_ids(
    docs: DataFrame, scratch: Scratch, filters: Mapping[str, Filter] = FILTERS
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The numbered rows, and for each filter the table of rows that fail it."""
    rows = scratch.write("measured", measured(docs))
    return rows, {
        name: scratch.write(f"fails-{name}", find(rows, scratch)) for name, find in filters.items()
    }


def surviving(rows: DataFrame, failed: Mapping[str, DataFrame], prefix: str) -> DataFrame:
    """Rows that pass all filters of ``prefix``."""
    for name in prefix:
        rows = rows.join(failed[name], "row", "left_anti")
    return rows


def removed(rows: DataFrame, failed: Mapping[str, DataFrame], prefix: str, name: str) -> DataFrame:
    """Rows that ``name`` removes after ``prefix``."""
    return surviving(rows, failed, prefix).join(failed[name], "row", "left_semi")


def classes(
    rows: DataFrame, failed: Mapping[str, DataFrame], labels: DataFrame, scratch: Scratch
) -> DataFrame:
    """``part, fails, docs, good, toxic``: rows by part and by the filters that they fail."""
    marks = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )
    marks = scratch.write("labels", marks.where("doc_id is not null and (good = 1 or toxic = 1)"))
    level = rows.select("row", "doc_id", "part").join(marks, "doc_id", "left").select(
        "row", "part", F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"), F.lit("").alias("fails"),
    )
    level = scratch.write("level-", level)
    before = ""
    for name, ids in failed.items():
        fails = level.join(ids, "row", "left_semi").withColumn("fails", F.concat("fails", F.lit(name)))
        passes = level.join(ids, "row", "left_anti")
        level = scratch.write(f"level-{before}{name}", fails.unionByName(passes))
        scratch.drop(f"level-{before}")
        before += name
    counted = level.groupBy("part", "fails").agg(
        F.count("*").alias("docs"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    return scratch.write("classes", counted)


def audit(
    docs: DataFrame, labels: DataFrame, filters: Mapping[str, Filter] = FILTERS
) -> DataFrame:
    """One row per part, order of the filters and step; filters have names of one letter.

    ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley``; there are ``n!`` orders of ``n`` filters.
    """
    scratch = Scratch(docs.sparkSession)
    rows, failed = failing_ids(docs, scratch, filters)
    found = classes(rows, failed, labels, scratch)
    names = "".join(sorted(filters))
    prefixes = ["".join(x) for n in range(len(names)) for x in combinations(names, n)]
    orders = ["".join(x) for x in permutations(names)]
    letters = F.lit(list(names))

    def each_letter(of: DataFrame, c: str) -> DataFrame:
        return of.select(c, F.explode(F.split(c, "")).alias("letter")).where("letter <> ''")

    spread = found.withColumn("prefix", F.explode(F.lit(prefixes)))
    struck = (
        each_letter(spread.select("prefix").distinct(), "prefix")
        .join(each_letter(found.select("fails").distinct(), "fails"), "letter")
        .select("prefix", "fails")
        .distinct()  # a row per prefix and class
    )
    alive = spread.join(F.broadcast(struck), ["prefix", "fails"], "left_anti")
    goes = F.expr("contains(fails, filter)")
    steps = (
        alive.withColumn("filter", F.explode(letters))
        .where("not contains(prefix, filter)")
        .groupBy("part", "prefix", "filter")
        .agg(
            F.sum(F.when(~goes, F.col("docs"))).alias("kept"),
            *[F.sum(F.when(goes, F.col(c))).alias(to) for c, to in
              (("docs", "removed"), ("good", "good_lost"), ("toxic", "toxic_lost"))],
        )
    )
    whole = (
        found.withColumn("filter", F.explode(letters))
        .groupBy("part", "filter")
        .agg(
            F.sum(F.when(goes, F.col("docs"))).alias("failing"),
            F.sum(F.when(F.col("fails") == F.col("filter"), F.col("docs"))).alias("unique_fails"),
        )
    )
    every = (
        found.select("part").distinct()
        .withColumn("filter_order", F.explode(F.lit(orders)))
        .select(
            "part", "filter_order",
            F.posexplode(F.filter(F.split("filter_order", ""), lambda x: x != "")).alias("at", "filter"),
        )
        .withColumn(
            "prefix",
            F.array_join(F.array_sort(F.split(F.expr("left(filter_order, at)"), "")), ""),
        )
    )
    zero = F.lit(0).cast("long")
    counts = {c: F.coalesce(c, zero) for c in
              ("kept", "removed", "unique_fails", "good_lost", "toxic_lost")}
    filled = every.join(steps, ["part", "prefix", "filter"], "left").join(
        whole, ["part", "filter"], "left"
    )
    of_filter = Window.partitionBy("part", "filter")
    return filled.select(
        "part", "filter_order", (F.col("at") + 1).cast("int").alias("step"),
        *[c.alias(name) for name, c in counts.items()],
        (F.coalesce("failing", zero) - counts["removed"]).alias("redundant"),
        F.sum(counts["removed"]).over(of_filter).alias("shapley"),
    )
