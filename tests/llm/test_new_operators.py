"""Filter interactions, archive conversion and collocations against plain versions, on odd rows too."""

import gzip
import hashlib
import itertools
import os
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from curbstar.llm import collocations, filter_audit, warc
from curbstar.llm.common import Scratch

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, row long, part string, "
        "fails string, chunk string")


def docs_of(spark, rows):
    """Rows of (doc_id, text, lang, source), with columns that clash with the operators' own."""
    return spark.createDataFrame([(*r, 1, 2, "p", "ABC", "c") for r in rows], DOCS)


# --- filter interactions ------------------------------------------------------------------------


def plain_audit(rows, labels):
    least = {}
    for doc_id, text, _, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    parts = defaultdict(list)
    for doc_id, text, _, source in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            f for f, hit in zip("ABCDE", (
                len(w) < 200, 100 * len(set(w)) < 50 * len(w),
                100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)),
                doc_id is not None and doc_id > least[t],
            )) if hit
        }
        parts[source or ""].append((fails, doc_id in good, doc_id in toxic))
    result = {}
    for part, docs in parts.items():
        shapley = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                failing = sum(f in d[0] for d in docs)
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(gone)
                result[part, order, step] = [
                    len(left), len(gone), failing - len(gone), sum(d[0] == {f} for d in docs),
                    sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), counts in result.items():
            if p == part:
                counts.append(shapley[order[step - 1]])
    return result


LONG = " ".join(f"w{k}" for k in range(30_000))
TEXTS = [None, "", " \t\n", "one", "ONE TWO # three", LONG, LONG, "a " * 400, "A b " * 300, "é" * 300,
         " ".join(f"x{k}" for k in range(250)), "| " + " ".join(f"Y{k}" for k in range(250))]
AUDIT_ROWS = [
    (None if k == 7 else k % 17, TEXTS[k % len(TEXTS)], None, ["s", None, "", "t"][k % 4])
    for k in range(40)
]
LABELS = [(k, (k % 3 == 0) * 1, (k % 5 == 0) * 1) for k in range(0, 17, 2)] + [
    (2, 1, None), (None, 1, 1), (3, None, 1), (99, 1, 1)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_filter_interactions(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(docs_of(spark, AUDIT_ROWS), labels).collect()
    expected = plain_audit(AUDIT_ROWS, LABELS)
    assert len(found) == len(expected) == 3 * 600
    assert {(r.part, r.filter_order, r.step): [r[c] for c in COUNTS] for r in found} == expected


def test_survivors_and_removed_rows(spark):
    scratch = Scratch(spark)
    rows, failed = filter_audit.failing_ids(docs_of(spark, AUDIT_ROWS), scratch)
    left = filter_audit.surviving(rows, failed, "AD")
    gone = filter_audit.removed(rows, failed, "AD", "C")
    assert {r.doc_id for r in left.collect()} == {
        r[0] for r in AUDIT_ROWS if r[1] and len(r[1].split()) >= 200 and "|" not in r[1]}
    assert gone.count() == left.where("100 * capitals > 2 * chars").count() > 0


def test_filter_interactions_of_nothing(spark):
    docs, labels = docs_of(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    alone = filter_audit.audit(docs_of(spark, AUDIT_ROWS[:2]), labels)
    assert alone.count() == 1200 and alone.where("good_lost + toxic_lost > 0").count() == 0


# --- archives -----------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, file string, content string, kept long"


def plain_pages(rows):
    newest, result = {}, []
    for page_id, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and page_id is not None:
            newest[body] = max(page_id, newest.get(body, page_id))
    for page_id, _, html in rows:
        body = (html or "").encode()
        again = len(body) >= 1000 and page_id != newest.get(body, page_id)
        result.append((page_id, len(body), hashlib.sha1(body).hexdigest(),
                       "revisit" if again else "response", newest[body] if again else None))
    return result


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 1, 5000])
def test_pages_through_archives(spark, archive_bytes):
    big, shared = "<p>" + "x\r\n\r\nWARC/1.0\n" * 20_000, "<b>é</b>" * 200
    texts = [None, "", "a" * 999, "a" * 1000, "é" * 500, shared, big, "\n\n", "filedesc://x 1 2 3 4\n" * 60]
    rows = [(k, [None, "", f"http://h/{k} b\nc", "http://ä/"][k % 4], texts[k % len(texts)])
            for k in range(30)]
    rows.append((9_200_000_000_000_000_000, "http://h/", shared))
    pages = spark.createDataFrame([(*r, "f", "c", 1) for r in rows], PAGES).repartition(3)
    found = [tuple(r) for r in warc.archive_pages(pages, archive_bytes=archive_bytes).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(found) == sorted(plain_pages(rows))


def test_repeated_and_unnumbered_pages(spark):
    body = "z" * 2000
    rows = [(5, "u", body), (5, "u", body), (None, "u", body), (None, None, None)]
    pages = spark.createDataFrame([(*r, "f", "c", 1) for r in rows], PAGES)
    found = warc.archive_pages(pages).collect()
    kinds = Counter((r.page_id, r.record_type, r.refers_to) for r in found)
    assert kinds == {(5, "response", None): 1, (5, "revisit", 5): 1, (None, "revisit", 5): 1,
                     (None, "response", None): 1}
    assert warc.archive_pages(pages.limit(0)).count() == 0


VERSION_1 = (b"filedesc://IA-1.arc 0.0.0.0 19960923142103 text/plain 76\n1 0 Alexa Internet\n"
             b"URL IP-address Archive-date Content-type Archive-length\n\n")
VERSION_2 = (b"filedesc://IA-2.arc 0.0.0.0 19970101000000 text/plain 200 - - 0 IA-2.arc 122\n"
             b"2 0 Alexa Internet\nURL IP-address Archive-date Content-type Result-code Checksum "
             b"Location Offset Filename Archive-length\n\n")


def test_arc_header_lines_of_both_versions():
    block = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\n\n"
    one = VERSION_1 + b"\nhttp://a/x y 1.2.3.4 19960923142104 text/html %d\n%s\n" % (len(block), block)
    one += b"no header line\nhttp://b/ 1.2.3.4 1996 text/plain 4\nab\ncX\nhttp://c/ 1.2.3.4 19960923142105 text/plain 50\ncut"
    info, first, second, cut = warc.arc_records(one)
    assert info.is_version_block and first.url == "http://a/x y" and bytes(first.block) == block
    assert first.warc_type == "response" and bytes(first.block[first.http_end:]) == b"body\n\n"
    assert bytes(second.block) == b"ab\nc" and second.warc_type == "resource"
    assert warc.warc_date(second.fields["Archive-date"]) == "1970-01-01T00:00:00Z"
    assert cut.truncated and bytes(cut.block) == b"cut"
    two = VERSION_2 + b"\nhttp://a/ 1.2.3.4 19970101000001 text/html 200 abc - 300 IA-2.arc %d\n%s\n" % (len(block), block)
    _, only = warc.arc_records(two)
    assert only.fields["Result-code"] == "200" and only.fields["Checksum"] == "abc"
    assert bytes(only.block) == block


def test_synthesised_warc_records():
    block = b"HTTP/1.0 200 OK\r\nX-Page-Id: 7\r\n\r\nbody"
    arc = VERSION_1 + b"\nhttp://a/ 1.2.3.4 19960923142104 text/html %d\n%s\n" % (len(block), block)
    packed = gzip.compress(arc[:90]) + gzip.compress(arc[90:])
    assert warc.unpacked(packed) == arc
    offset = len(VERSION_1) + 1
    made = list(warc.warc_records(warc.to_warc("x.arc", arc, {})))
    assert [r.fields["warc-type"] for r in made] == ["warcinfo", "response"]
    fields = made[1].fields
    assert fields["warc-record-id"] == warc.record_id("x.arc", offset)
    assert fields["warc-date"] == "1996-09-23T14:21:04Z"
    assert fields["warc-warcinfo-id"] == made[0].fields["warc-record-id"]
    assert fields["content-type"] == "application/http; msgtype=response"
    assert fields["warc-payload-digest"] == warc._digest(b"body") and bytes(made[1].block) == block
    again = list(warc.warc_records(warc.to_warc("x.arc", arc, {offset: ("<urn:uuid:1>", "http://b/", "d")})))[1]
    assert again.fields["warc-type"] == "revisit" and again.fields["warc-refers-to"] == "<urn:uuid:1>"
    assert bytes(again.block) == block[:-4] and again.fields["warc-payload-digest"] == warc._digest(b"body")


def test_archives_are_files(spark):
    """Every file of either kind stands alone, one version after the other."""
    scratch = Scratch(spark)
    arc, made = f"{scratch.root}/arc", f"{scratch.root}/warc"
    pages = spark.range(40).select(
        F.concat(F.lit("http://h/"), F.col("id")).alias("url"),
        F.encode(F.repeat(F.col("id").cast("string"), 300), "utf-8").alias("block"),
    )
    warc.write_arc(pages, arc, archive_bytes=2000)
    warc.convert(spark, arc, made, scratch)
    folder = arc.removeprefix("file:")
    files = [gzip.open(f"{folder}/{x}").read() for x in os.listdir(folder) if x.endswith(".gz")]
    files = [x for x in files if x]
    assert len(files) > 5 and all(x.startswith(b"filedesc://") and x.endswith(b"\n") for x in files)
    assert {x.split(b"\n")[1][:1] for x in files} == {b"1", b"2"}
    assert warc.read_warc(spark, made).where("record_type = 'resource'").count() == 40


# --- collocations -------------------------------------------------------------------------------


def plain_collocations(rows, longest, least, keep):
    f, total = Counter(), Counter()
    for _, text, lang, _ in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for n in range(1, longest + 1):
                for i in range(len(w) - n + 1):
                    f[lang or "und", tuple(w[i : i + n])] += 1
    often = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    result = defaultdict(list)
    for (lang, w), a in often.items():
        inside = [v for (x, y), v in often.items() if x == lang and len(y) > len(w)
                  and any(y[i : i + len(w)] == w for i in range(len(y)))]
        if inside and 100 * max(inside) >= 80 * a:
            continue
        score, k = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        result[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return [
        (lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
        for lang, found in result.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:keep], 1)
    ]


def sentences(seed, count, vocabulary=12):
    import random
    r = random.Random(seed)
    words = [f"w{k}" for k in range(vocabulary)] + ["É", "ß", "New", "new", "York", "\x01"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "? "]
    return "".join(r.choice(words) + r.choice(ends) for _ in range(count))


@pytest.mark.parametrize(("period", "bits"), [(32, 1 << 26), (1, 1 << 26), (3, 1 << 15), (1 << 40, 1 << 20)])
def test_collocations(spark, period, bits):
    rows = [(k, sentences(k % 9, 700), ["en", None, "und", "fr"][k % 4], "s") for k in range(20)]
    rows += [(1, None, "en", None), (2, "", None, None), (3, " . ,\n", "de", None), (4, "one", "de", None),
             (5, "a " * 5000, "xx", None), (6, sentences(99, 20_000), "en", None)]
    found = collocations.collocations(docs_of(spark, rows).repartition(3), least=5, keep=300,
                                      period=period, filter_bits=bits)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == sorted(
        plain_collocations(rows, 4, 5, 300))


def test_collocations_of_two_and_five_words(spark):
    rows = [(k, sentences(k % 3, 500, 4), "en", "s") for k in range(9)]
    for longest in (2, 5):
        found = collocations.collocations(docs_of(spark, rows), longest=longest, least=9, filter_bits=1 << 20)
        expected = plain_collocations(rows, longest, 9, 2000)
        assert sorted((r.rank, r.phrase, r.a, r.score) for r in found.collect()) == sorted(
            (r[1], r[2], r[3], r[7]) for r in expected)


def test_copies_are_one_entry_of_the_dictionary(spark):
    rows = [(k, "before%d " % (k % 2) + sentences(5, 4000), "en", "s") for k in range(6)]
    chunks = collocations.dictionary(docs_of(spark, rows)).collect()
    assert sum(r.owned * r.freq for r in chunks) == 6 * 4001
    assert sum(r.owned for r in chunks) < 4200


def test_collocations_of_nothing(spark):
    assert collocations.collocations(docs_of(spark, [])).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 6_000_000_000_000_000
    found = spark.createDataFrame(
        [("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)],
        "lang string, phrase string, words int, f long")
    assert collocations.scored(found).first().score == 2_000_000 * (big - 1) // (2 * big + 1)


# --- importance weights -------------------------------------------------------------------------


def test_importance_weights_against_plain_counts(spark):
    """Counts of target and of all texts by bucket, and every document's weight."""
    import numpy as np
    import pyarrow as pa

    from curbstar.llm import resampling
    from curbstar.llm.common import utf8

    rows = [(None if k == 5 else k % 30, [None, "", "One", sentences(k, 90)][min(k % 7, 3)], "en", "s")
            for k in range(40)]
    labels = [(k, k % 2) for k in range(0, 30, 3)] + [(None, 1), (99, 1), (3, 1), (6, None)]
    good = {k for k, q in labels if q == 1 and k is not None}

    def buckets(text):
        data, offsets = utf8(pa.array([text]))
        return resampling.feature_buckets(data, offsets)[0] if text else np.zeros(0, np.int64)

    raw = target = np.zeros(1 << resampling.BUCKET_BITS)
    for doc_id, text, _, _ in rows:
        found = np.bincount(buckets(text), minlength=len(raw))
        raw = raw + found
        target = target + found * (doc_id in good)
    ratios = resampling.log_ratios(target, raw)
    assert target.sum() and np.ptp(ratios) > 0
    found = resampling.score(
        docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    expected = sorted((str(d), len(buckets(t)), round(float(ratios[buckets(t)].sum()), 6)) for d, t, _, _ in rows)
    assert sorted((str(r.doc_id), r.n_features, round(r.log_weight, 6)) for r in found) == expected
