"""The ten operators on small rows, against brute force, with nulls, ties, copies and empty tables."""

import hashlib
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbstar.llm import (
    fingerprint, html, language, minhash, mixing, neighbours, packing, repeats, resampling, toxicity,
)
from curbstar.llm.queries import QUERIES, tokenizer_path
from curbstar.llm.sql import SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row_key string"


def words(seed, count):
    numbers = np.random.default_rng(seed).integers(0, 5000, count)
    return " ".join(f"w{n}" for n in numbers)


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, shared passages, nulls, blanks, a long text, clashing column names."""
    base, passage = words(1, 300), words(2, 120)
    near = base.replace(base.split()[10], "changed", 1)
    texts = [base, base, near, None, "", "  \n", "one", "One two", passage + " " + words(3, 80),
             words(4, 90) + "\n" + passage, words(5, 9000), "a" * 1500, words(6, 40), "é" * 300]
    rows = [(k, t, "en", ["b", "a", None][k % 3], 0, "x") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:1] + [(None, base, None, "a", 0, "x")], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text, count):
    found = (text or "").encode().lower().split()
    if 0 < len(found) < count:
        return {tuple(found)}
    return {tuple(found[k : k + count]) for k in range(len(found) - count + 1)}


def test_near_duplicates(docs, empty):
    rows = minhash.near_duplicates(docs, words=3, percent=85).collect()
    found = {r.doc_id: r for r in rows if r.doc_id is not None}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for k, text in texts.items():
        if k is not None:
            assert found[k].n_shingles == len(shingles(text, 3))
    assert len(rows) == docs.count()
    assert [found[k].component_id for k in (0, 1, 2)] == [0, 0, 0]
    assert all(found[k].component_id == k for k in range(3, 14))
    assert minhash.near_duplicates(empty).count() == 0
    kept = minhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, *range(3, 14)]


def brute_removed(texts, least):
    starts = {}
    for k, text in enumerate(texts):
        raw = (text or "").encode()
        for at in range(len(raw) - least + 1):
            starts.setdefault(raw[at : at + least], []).append((k, at))
    gone = [np.zeros(len((t or "").encode()), bool) for t in texts]
    for places in starts.values():
        if len(places) > 1:
            for k, at in places:
                gone[k][at : at + least] = True
    return gone


@pytest.mark.parametrize("group", [512, 1])
def test_repeats(docs, empty, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP_CONTEXTS", group)
    some = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = {r.doc_id: r for r in repeats.removed_digest(some, 200).collect()}
    texts = sorted((r.doc_id, r.text) for r in some.collect())
    for (k, text), gone in zip(texts, brute_removed([t for _, t in texts], 200)):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = hashlib.sha256(raw[~gone].tobytes()).hexdigest()
        assert rows[k][1:] == (len(raw), gone.sum(), (edges == 1).sum(), kept)
    assert repeats.removed_digest(empty).count() == 0


def test_repeats_return_what_is_left(spark, tmp_path):
    """The passage is missing from the query's texts, and spans and bytes agree with its digest."""
    base, passage = words(11, 100), words(12, 90)
    # é and ĩ end in the same byte, so the repeated string begins inside a character
    tail = words(15, 100)
    texts = [base + "\n" + passage, passage + "\n" + words(13, 60), words(14, 90), None, "", "é" + tail,
             "ĩ" + tail, "x" * 450 + "end"]
    rows = [(k, t, "en", "a", 0, "x") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op2_suffix_dedup"](spark, str(tmp_path)).collect()}
    spans = {r.doc_id: r for r in repeats.cut_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    for k, gone in enumerate(brute_removed(texts, 400)):
        raw = np.frombuffer((texts[k] or "").encode(), np.uint8)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        kept = raw[~gone].tobytes()
        assert [tuple(s) for s in spans[k].spans] == list(map(tuple, edges.reshape(-1, 2)))
        assert bytes(spans[k].kept) == kept
        assert found[k].text == kept.decode(errors="replace")
        assert found[k].n_removed == len(raw) - len(kept) and found[k].n_bytes == len(raw)
        assert found[k].kept_sha256 == hashlib.sha256(kept).hexdigest()
    assert base in found[0].text and not any(passage in r.text for r in found.values())
    assert found[3].text == "" and found[5].text == "\ufffd"


def test_cut_passages_keep_rows_and_characters(docs):
    rows = {r.doc_id: r.text for r in repeats.without_repeats(docs).collect()}
    assert rows[8] == " " + words(3, 80) or len(rows[8]) < len(words(3, 80)) + 12
    assert rows[12] == words(6, 40) and rows[3] is None


def test_matching_statistics():
    generator = np.random.default_rng(7)
    for _ in range(20):
        text = generator.integers(0, 3, 200).astype(np.int32)
        text[[60, 130, 199]] = [256, 257, 258]
        def common(a, b):
            n = 0
            while max(a, b) + n < 200 and text[a + n] == text[b + n]:
                n += 1
            return n
        expected = [max(common(a, b) for b in range(200) if b != a) for a in range(200)]
        assert repeats.matching_statistics(text).tolist() == expected


def test_fingerprints(docs, empty):
    some = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = {r.doc_id: r for r in fingerprint.compare_with_edits(some).collect()}
    ordered = sorted(((r.doc_id, r.text or "") for r in some.collect()), reverse=True)
    for k, (doc_id, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert rows[doc_id].n_chars == len(text)
        assert rows[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[doc_id].near_next <= 1
    assert rows[0].fingerprint == rows[1].fingerprint and rows[1].near_next == 1.0
    assert rows[10].near_edited > 0.2 > rows[10].near_next
    assert fingerprint.compare_with_edits(empty).count() == 0
    assert fingerprint.compare_with_edits(docs).count() == docs.count()


def test_entropy_levels_equal_direct_counts():
    data = np.frombuffer(words(8, 60).encode(), np.uint8)
    levels = fingerprint.entropy_levels(data)
    for at in range(0, len(levels), 17):
        counts = np.bincount(data[at : at + fingerprint.WINDOW])
        counts = counts[counts > 0] / fingerprint.WINDOW
        share = -(counts * np.log2(counts)).sum() / np.log2(fingerprint.WINDOW)
        assert abs(levels[at] - share * (fingerprint.LEVELS - 1)) <= 1


def test_resampling(spark, docs, empty):
    labels = spark.createDataFrame([(0, 1), (10, 1), (11, 0), (5, None)], "doc_id long, quality int")
    rows = resampling.resample(docs, labels, share=0.5).collect()
    keys = sorted((r.gumbel_key for r in rows), reverse=True)
    assert {r.kept for r in rows if r.gumbel_key >= keys[len(rows) // 2 - 1]} == {True}
    assert resampling.resample(empty, labels).count() == 0
    assert resampling.resample(docs, labels.limit(0)).where("kept").count() == docs.count()


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<html><script>x</script></html>", ""),
    ("<nav><a href=/>Home</a></nav><article><h1>T &amp; t</h1><p>A  <b>b</b>\n c<p>d</article>"
     "<footer>f</footer>", "T & t\nA b c\nd"),
    ("<article><p>x</p><div class='ad'>buy</div><p>y <b", "x\ny"),
    ("<body><div id=cookie-banner>Ok</div><div class=content><p>One two three four.</p>"
     "<ul><li>five</li></ul></div><form>q</form><aside>side</aside></body>",
     "One two three four.\nfive"),
])
def test_html(page, text):
    assert html.main_text(page or "", html.trained_tree()) == text


A, B = " ".join(f"a{k}" for k in range(20)), " ".join(f"b{k}" for k in range(40))


@pytest.mark.parametrize("page, text", [
    (f"<article><header class='entry-header'><h1>T</h1></header><p>{A}</p></article>", f"T\n{A}"),
    (f"<article><div class=post-header><h1>T</h1></div><p>{A}</p></article>", f"T\n{A}"),
    (f"<article class='post category-social tag-search'><h1>T</h1><p>{A}<p>{B}</article>", f"T\n{A}\n{B}"),
    (f"<main class=has-sidebar><p>{A}</p><p>{B}</p></main><footer>f</footer>", f"{A}\n{B}"),
    (f"<form id=f><nav><a href=x>n</a></nav><h1>T</h1><p>{B}</p><p>{A}</p></form>", f"T\n{B}\n{A}"),
    (f"<h1 class=post-title>T</h1><p>{A}</p><p>{B}</p><p>end</p>", f"T\n{A}\n{B}\nend"),
    (f"<div class=post-meta>by me</div><div><p>{A}</p><p>{B}</p></div>", f"by me\n{A}\n{B}"),
    (f"<article><p>{A}</p><div class='share-links'>s</div></article><section id=comments><p>{B}</p>"
     f"<p>{B}</p></section><aside class=related><article>{A}</article></aside>", A),
    (f"<div><p>{B} {B} {B} {B} {B}</p></div><footer>{A}</footer>", f"{B} {B} {B} {B} {B}"),
    (f"<div id=cookie-banner>{B}</div><article><p>{A}</p></article><form>mail</form>", A),
])
def test_html_frame_names(page, text):
    assert html.main_text(page, html.trained_tree()) == text


@pytest.mark.parametrize("inner, text", [
    ("<p>x <svg class='i'/>y</p><p>z</p><svg><path d=''/></svg>", "x y\nz"),
    ("<p>x</p><svg class=i><path d=''><p>y</p>", "x\ny"),
    ("<svg><title>t</svg><p>x</p><svg><title>u</title><foreignObject><p>v</p></foreignObject></svg><p>y</p>",
     "x\ny"),
    ("<p>x</p><select><option>a<option>b<p>y</p><p>z</p><select><option>c</select>", "x\ny\nz"),
    ("<p>x <select><option>a</option> y</p><p>z</p>", "x y\nz"),
    ("<p>x</p><object data=o><p>y</p><object>q</object><canvas><p>z</p>", "x\ny\nz"),
    ("<p>x</p><div><iframe src=i></div><p>y</p><iframe>q</iframe>", "x\ny"),
    ("<select-box><p>x</p></select-box><object-view><p>y</p><title-bar>z</title-bar>", "x\ny\nz"),
    ("<script src='s'/><p>x</p><script data-a='>'>var a</script><p>y</p><style>z", "x\ny"),
    ("<noscript><p>q</p></noscript><p>x</p><object><p>q</p></object><canvas>q</canvas>"
     "<svg><text>q</text></svg><select><option>q</option></select><textarea><p>q</textarea>y", "x\ny"),
])
def test_html_hidden_elements(inner, text):
    page = f"<title>t</title><article>{inner}</article>"
    assert html.main_text(page, html.trained_tree()) == text


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, None, "k"), (2, "<p>words of a page</p>", "k")],
                                  "page_id int, html string, text string")
    found = {r.page_id: r.text for r in html.extract_main_text(pages).collect()}
    assert found == {1: "", 2: "words of a page"}
    assert html.extract_main_text(pages.limit(0)).count() == 0


def test_toxicity_learns_subwords(spark, empty):
    plain = [(k, words(100 + k, 60)) for k in range(120)]
    rude = [(k, t + (f" grumph{k % 7}le" * 3 if k % 3 == 0 else "")) for k, t in plain]
    docs = spark.createDataFrame(rude + [(900, words(3, 50) + " grumphxyz grumphable"), (901, None)],
                                 "doc_id long, text string")
    labels = docs.where("doc_id < 900").select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    scores = {r.doc_id: r._score for r in toxicity.with_scores(docs, model, ["doc_id"]).collect()}
    assert scores[900] > 0.7 > scores[901] and scores[0] > scores[1]
    assert toxicity.without_toxic(docs, labels).count() < docs.count()
    assert toxicity.with_scores(empty, model, ["doc_id"]).count() == 0
    blank = toxicity.fit(docs, labels.limit(0))
    assert {r._score for r in toxicity.with_scores(docs, blank, ["doc_id"]).collect()} == {0.5}


def test_toxicity_knows_short_misspellings():
    texts = [words(100 + k, 60) + (" dumb" * 3 if k % 3 == 0 else "") for k in range(120)]
    model = toxicity.train([t.encode() for t in texts], np.arange(120) % 3 == 0, np.ones(120))
    changed, unknown = model.scores([b"w1 dvmb", b"w1 kxtz"])
    assert changed > unknown


def test_mixing(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
    total = sum(r.size for r in rows)
    targets = {(r.source_size, r.target) for r in rows}
    assert sum(t for _, t in targets) == pytest.approx(1.5 * total)
    assert all(t <= 2 * s + 1e-6 for s, t in targets)
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns


@needs_tables
def test_mix_comes_near_its_targets(spark):
    rows = QUERIES["op7_source_mixing"](spark, SF_DIR).groupBy("source_size", "target").agg(
        F.sum("taken").alias("taken")
    )
    assert all(abs(r.taken - r.target) <= max(20, 0.02 * r.target) for r in rows.collect())


@needs_tables
def test_languages(spark, empty):
    found = QUERIES["op8_language_id"](spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth, "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.9
    model = language.fit(empty)
    odd = spark.createDataFrame([(1, None), (2, "12 34"), (3, "")], "doc_id long, text string")
    for m in (model, language.fit(spark.read.parquet(f"{SF_DIR}/documents.parquet"))):
        assert {r.lang_pred for r in language.identify(odd, m, ["doc_id"]).collect()} == {"und"}


def test_language_sample_is_bounded_and_repeatable(spark, monkeypatch):
    monkeypatch.setattr(language, "LANGUAGES", 3)
    monkeypatch.setattr(language, "SAMPLE_ROWS", 20)
    monkeypatch.setattr(language, "PARTS", 4)
    seen = []
    train = language.train
    monkeypatch.setattr(language, "train", lambda *a: seen.append(a) or train(*a))
    alphabets = {"aa": "abcd", "bb": "efgh", "cc": "ijkl", "dd": "mnop"}
    generator = np.random.default_rng(4)
    rows = []
    for k in range(200):
        lang = "aa" if k < 90 else "bb" if k < 150 else "cc" if k < 190 else "dd"
        text = "".join(generator.choice(list(alphabets[lang] + " "), 30 if k else 300_000))
        rows.append((k, text, lang, "x", "y"))
    rows += rows[:5] + [(None, None, "aa", "x", "y"), (7, "abc", None, "x", "y"), (8, "12", "aa", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, key string, place string")
    models = [language.fit(d) for d in (docs, docs.repartition(7))]
    assert models[0].languages == ["aa", "bb", "cc"]
    for found, truth, _ in seen:
        # a repeated row takes a place of its own and is learnt from once
        assert 15 <= truth.count("aa") <= 20 and truth.count("bb") == truth.count("cc") == 20
        assert len(found) == len(truth)
    assert (models[0].weights == models[1].weights).all()
    assert models[0].temperature == models[1].temperature
    scored = [
        {(r.doc_id, r.lang_pred, r.score) for r in language.identify(docs, m, ["doc_id"]).collect()}
        for m in models
    ]
    assert scored[0] == scored[1]
    named = {r[0]: r[1] for r in scored[0]}
    assert [named[k] for k in (0, 50, 100, 160)] == ["aa", "aa", "bb", "cc"]


def test_bucket_counts_equal_direct_counts():
    texts = ["", "12", "Ab c", "é" * 50, "xy " * 4000]
    whole = list(language.bucket_counts(texts))
    for text, (buckets, counts) in zip(texts, whole):
        (alone, times), = language.bucket_counts([text])
        assert buckets.tolist() == alone.tolist() and counts.tolist() == times.tolist()
        letters = [c if c.isalpha() else " " for c in f" {text.lower()}  "]
        grams = sum(a != " " for a in letters[1:-1]) * 2 + sum(
            a != " " or b != " " for a, b in zip(letters[:-1], letters[1:])
        )
        assert counts.sum() == grams


def test_temperature_is_the_best_of_a_grid():
    generator = np.random.default_rng(5)
    labels = generator.integers(0, 4, 300)
    logits = generator.standard_normal((300, 4)) + 2 * np.eye(4)[labels]
    for scale in (0.01, 1.0, 30.0):
        fitted = language.fitted_temperature(logits * scale, labels)
        losses = [language.log_loss(logits * scale, labels, scale * t) for t in np.geomspace(0.1, 10, 400)]
        assert language.log_loss(logits * scale, labels, fitted) <= min(losses) + 2e-3
    sure = language.fitted_temperature(np.eye(4)[labels] * 9, labels)
    assert 0.1 < sure < 10
    assert language.fitted_temperature(np.zeros((3, 2)), np.array([0, 1, 0])) == 1.0


def test_neighbours(spark):
    generator = np.random.default_rng(9)
    vectors = generator.standard_normal((700, 24))
    rows = [(k, v.tolist(), 1) for k, v in enumerate(vectors)]
    odd = [(1000, None, 1), (1001, [0.0] * 24, 1), (1050, [float("nan")] * 24, 1), (1002, [1.0], 1)]
    frame = spark.createDataFrame(rows + odd + rows[:1], "vec_id long, embedding array<double>, rank int")
    found = neighbours.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    hits = 0
    for q in range(0, 700, 50):
        cosine = unit @ unit[q]
        cosine[q] = -2
        own = [r for r in found if r.query_id == q]
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - cosine[r.vec_id]) < 1e-12 for r in own)
        hits += len(set(np.argsort(-cosine)[:5]) & {r.vec_id for r in own})
    assert hits >= 0.9 * 70
    assert neighbours.nearest(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_neighbours_in_several_blocks(spark, monkeypatch):
    """Blocks of rows and queries, equal scores, one id with many vectors, repeated rows."""
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 500)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 20)
    monkeypatch.setattr(neighbours, "VERIFIED", 80)
    generator = np.random.default_rng(12)
    centres = generator.standard_normal((60, 16))
    vectors = centres[generator.integers(0, 60, 3000)] + 0.4 * generator.standard_normal((3000, 16))
    ids = np.arange(3000)
    vectors[100:180] = vectors[100]  # copies under ids of their own
    ids[1000:1600] = 77  # an id with many vectors
    ids[51] = 50  # a query with two vectors
    rows = [(int(i), v.tolist()) for i, v in zip(ids, vectors)]
    frame = spark.createDataFrame(rows + rows[:30], "vec_id long, embedding array<double>")
    found = neighbours.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    hits = total = 0
    for q in sorted({int(i) for i in ids if i % 50 == 0}):
        best = {}
        for own in np.flatnonzero(ids == q):
            for i, c in zip(ids.tolist(), (unit @ unit[own]).tolist()):
                if i != q:
                    best[i] = max(best.get(i, -2), c)
        ranked = sorted(best, key=lambda i: (-round(best[i], 12), i))[:5]
        got = sorted((r for r in found if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in got] == [1, 2, 3, 4, 5] and len({r.vec_id for r in got}) == 5
        assert all(abs(r.score - best[r.vec_id]) < 1e-12 for r in got)
        hits, total = hits + len(set(ranked) & {r.vec_id for r in got}), total + 5
        if q == 100:
            assert [r.vec_id for r in got] == [101, 102, 103, 104, 105]
    assert hits >= 0.9 * total


def test_windows_count_what_they_hold():
    generator = np.random.default_rng(13)
    rows = generator.standard_normal((300, 8))
    block = neighbours.Block(np.arange(300), rows)
    centres = rows[:4] / np.linalg.norm(rows[:4], axis=1)[:, None] @ block.directions
    (low, high), (wide_low, wide_high) = block.edges(centres, 0), block.edges(centres, 3)
    spots = rows / np.linalg.norm(rows, axis=1)[:, None] @ block.directions
    for q in range(4):
        first = block.met(low[q].tolist(), high[q].tolist())
        sides = block.met(np.stack([wide_low[q], high[q]], 1).ravel().tolist(),
                          np.stack([low[q], wide_high[q]], 1).ravel().tolist())
        for step, counts in ((0, first), (3, first + sides)):
            reach = neighbours.FIRST_WIDTH * neighbours.WIDEN**step * block.spread
            assert counts.tolist() == (np.abs(spots - centres[q]) <= reach).sum(axis=1).tolist()


def test_packing(docs, empty):
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    some = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = packing.pack_documents(some, tokenizer_path()).collect()
    for r in some.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        own = sorted((x for x in rows if x.doc_id == r.doc_id), key=lambda x: x.piece)
        assert sum(x.length for x in own) == len(ids)
        for x in own:
            piece = np.array(ids[x.start : x.start + x.length], "<u4").tobytes()
            assert x.ids_crc32 == zlib.crc32(piece)
    for sequence in {r.sequence_id for r in rows}:
        own = sorted((r.offset, r.length) for r in rows if r.sequence_id == sequence)
        ends = np.cumsum([length for _, length in own])
        assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_packing_special_tokens(spark):
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = ["the end <|endoftext|> New text", "A<|endoftext|>B <|startoftext|>", "a <|ENDOFTEXT|> B",
             "<|EndOfText|><|endoftext|>Y", "<|endoftext|", "Plain ONE", "x<|endoftext|>" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack_documents(docs, tokenizer_path()).collect()
    for k, text in enumerate(texts):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        own = sorted((r for r in rows if r.doc_id == k), key=lambda r: r.piece)
        assert [(r.start, r.length) for r in own] == [
            (at, min(4096, len(ids) - at)) for at in range(0, len(ids), 4096)
        ]
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())


def test_ids_of_words_equal_the_tokenizers(monkeypatch):
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    monkeypatch.setattr(packing, "CACHE_WORDS", 40)
    monkeypatch.setattr(packing, "JOINED_WORDS", 7)
    odd = ["", " ", "É\u0301 e\u0301tude ÉTUDE", "x\u00a0y\u3000z", "\u0301a", "a\x00b \x01 c", "don't WE'LL 12ab,,",
           "x" * 5000, "é" * 300 + " " + "é" * 300, "<|endoftext|><|startoftext|> <|EndOfText|>q",
           "ΣΑΣ \U0001f600\U0001f600", "w1 w2 w1", "\x0bfoo\x0cbar\r\nbaz", "<|endoftext", "|>"]
    texts = [t for k in range(20) for t in (*odd, words(200 + k, 30))]
    raw = [t.encode() for t in texts]
    marks = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    known = packing.WordIds(tokenizer_path())
    for low in range(0, len(texts), 25):
        part = np.frombuffer(b"".join(raw[low : low + 25]), np.uint8)
        ids, bounds = known.of(part, marks[low : low + len(raw[low : low + 25]) + 1] - marks[low])
        for k, text in enumerate(texts[low : low + 25]):
            expected = tokenizer.encode(text, add_special_tokens=False).ids
            assert ids[bounds[k] : bounds[k + 1]].tolist() == expected, text


def test_packing_in_several_cells(spark, monkeypatch):
    pytest.importorskip("public_tokenizers")
    monkeypatch.setattr(packing, "CELL_ROWS", 8)
    texts = [words(300 + k, 40 * (k % 9)) for k in range(60)] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack_documents(docs, tokenizer_path(), length=512).collect()
    assert len({r.doc_id for r in rows}) == 120
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        ends = np.cumsum([length for _, length in sorted(own)])
        assert [o for o, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 512


def test_pack_is_close_to_the_bound():
    lengths = np.minimum(np.random.default_rng(3).lognormal(6.5, 0.9, 6000).astype(int) + 1, 4096)
    sequence, _ = packing.pack(lengths)
    assert len(set(sequence)) <= 1.01 * lengths.sum() / 4096 + 1


@needs_tables
@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    result = connection.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(tuple(r) for r in QUERIES[name](spark, SF_DIR).select(columns).collect()) == sorted(
        result.fetchall()
    )
