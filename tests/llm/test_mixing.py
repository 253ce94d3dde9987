"""Mixing against its own computation, under several layouts, with hot and repeated rows."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from curbstar.llm import minhash, mixing, repeats

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["_doc", "_key", "_row_key", "_copies", "_copy", "key", "row", "n", "copies", "piece", "row_key"]


def rows_of(sizes):
    """(source, size) pairs as documents."""
    return [(k, " ".join(["w"] * size) if size else None, "en", source, 0)
            for k, (source, size) in enumerate(sizes)]


def sizes(count):
    # heavy-tailed sizes; a source with a third of all rows, a null source, one of empty texts
    names = ["hot"] * 4 + ["a", "b", None, "c", "d", "e"]
    return [(names[k % 10], (k * 7919 % 97) ** 2 // (1 + k % 13)) for k in range(count)] + [("z", 0)] * 3


def plain_targets(found):
    total, weights = defaultdict(int), {}
    for source, size in found:
        total[source] += size
    for k, source in enumerate(sorted(total, key=lambda s: (s is None, s or ""))):
        weights[source] = (5, 2, 1)[k % 3]
    target, held, budget = {}, set(), 1.5 * sum(total.values())
    while True:
        left = budget - sum(2 * total[s] for s in held)
        free = [s for s in total if s not in held]
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * total[s]}
        if not over:
            return {**{s: 2.0 * total[s] for s in held}, **share}, total
        held |= over


def plain_tilt(of, target):
    """The rate's exponent per word, by bisection."""
    if target >= 2 * sum(of):
        return math.inf
    low, high = -50.0, 50.0
    for _ in range(300):
        middle = (low + high) / 2
        words = sum(s * min(2.0, math.exp(min(middle * s, 50))) for s in of)
        low, high = (middle, high) if words < target else (low, middle)
    return low


def test_targets_and_rates_against_a_plain_version(spark, tmp_path):
    found = sizes(400)
    targets, total = plain_targets(found)
    docs = spark.createDataFrame(rows_of(found), DOCS)
    scratch = mixing.Scratch(spark)
    kinds = mixing._units(docs).groupBy("source", "size").agg(F.sum("n").alias("n"))
    tilted = mixing.tilts(kinds, mixing.source_targets(kinds), scratch).collect()
    assert {r.source: r.source_size for r in tilted} == total
    for r in tilted:
        assert r.target == pytest.approx(targets[r.source], rel=1e-9)
        of = [s for source, s in found if source == r.source and s]
        if not of:
            continue
        exact = plain_tilt(of, r.target)
        if exact < math.inf:
            assert r.tilt / r.mean == pytest.approx(exact, rel=1e-5, abs=1e-9)
        words = sum(s * min(2.0, math.exp(min(r.tilt / r.mean * s, 50))) for s in of)
        assert words == pytest.approx(r.target, rel=1e-6)
    rates = {r.source: r.tilt for r in tilted}
    assert any(t < 0 for t in rates.values()) and any(t > 0 for t in rates.values())


@pytest.mark.parametrize("shard", [20_000, 50])
def test_the_mix_is_near_its_targets_and_the_same_in_every_layout(spark, monkeypatch, shard):
    monkeypatch.setattr(mixing, "SHARD_ROWS", shard)
    found = sizes(600)
    targets, _ = plain_targets(found)
    docs = spark.createDataFrame(rows_of(found), DOCS)

    def copies(df):
        return sorted((r.doc_id, r.size, r.copies, r.taken, r.target) for r in mixing.mix(df).collect())

    first = copies(docs)
    assert len(first) == len(found)
    for other in (docs.repartition(7), docs.repartition(3, "lang").sortWithinPartitions(F.desc("doc_id"))):
        assert copies(other) == first
    taken = Counter()
    for doc_id, size, n, words, _ in first:
        assert 0 <= n <= 2 and words == n * size
        taken[found[doc_id][0]] += words
    for source, target in targets.items():
        assert taken[source] == pytest.approx(target, rel=0.005, abs=3)


def test_repeated_rows_share_their_copies(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK_COPIES", 4)
    monkeypatch.setattr(mixing, "SHARD_ROWS", 8)
    rows = rows_of(sizes(60)) + [(7, "a b c d e f g", "en", "hot", 0)] * 40 + [(None, "x y", "de", None, 0)] * 11
    docs = spark.createDataFrame(rows, DOCS)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    assert all(0 <= r.copies <= 2 for r in found)
    same = [r.copies for r in found if r.doc_id == 7 and r.size == 7]
    assert len(same) == 40 and max(same) - min(same) <= 1
    expected = Counter()
    for r in found:
        expected[r.doc_id, r.size] += r.copies
    written = Counter()
    for r in mixing.mixed_documents(docs).collect():
        written[r.doc_id, len((r.text or "").split())] += 1
    assert written == +expected


def test_columns_that_clash(spark):
    rows = rows_of([("a", 60), ("a", 61), ("b", 9), (None, 0)])
    docs = spark.createDataFrame(rows, DOCS).select(
        "*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])
    for made in (mixing.mixed_documents(docs), minhash.keep_one_of_each(docs), repeats.without_repeats(docs)):
        assert made.columns == docs.columns
        assert made.count() and {r["_doc"] for r in made.collect()} == {0}
