"""Cases in which an operator once did less than its whole job."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from lealtia.llm import common, quality, queries, repeats, site_text


def corpus():
    """(id, text, kind) of clean texts in two languages, and of junk."""
    rng = random.Random(5)
    words = {k: [k + "".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)] for k in ("en", "de")}
    prose = lambda k: [words[k][int(400 * rng.random() ** 3)] for _ in range(rng.randint(60, 120))]
    kinds = ["en"] * 300 + ["de"] * 60 + ["junk"] * 60
    texts = [" ".join(prose(k)) if k != "junk" else " ".join(w + rng.choice(["&&&", "$$$", "%%%"]) for w in prose("en")) for k in kinds]
    return [(i, t, k) for i, (t, k) in enumerate(zip(texts, kinds))]


def test_clean_documents_stay_when_labels_are_thinned(spark):
    rows = corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    for labelled in (lambda i, k: i % 2 == 0, lambda i, k: i % 8 == 0, lambda i, k: i % 2 == 0 and k != "de"):
        marks = [(i, int(k != "junk"), 0) for i, _, k in rows if labelled(i, k)]
        found = quality.judge_documents(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
        kept = {r["doc_id"] for r in found.where("kept").collect()}
        known = {m[0] for m in marks}
        clean = {i for i, _, k in rows if k != "junk"} - known
        assert len(clean - kept) <= 0.02 * len(clean)
        junk = {i for i, _, k in rows if k == "junk"} - known
        assert len(junk & kept) <= 0.1 * len(junk)


def test_without_both_kinds_of_labels_the_base_rules_decide(spark):
    docs = spark.createDataFrame([r[:2] for r in corpus()[:40]], "doc_id long, text string")
    for marks in ([], [(i, 1, 0) for i in range(20)], [(i, 0, 0) for i in range(20)]):
        found = quality.judge_documents(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
        assert found.where("kept = base_failed OR score IS NULL").count() == 0


def test_a_labelled_document_is_scored_without_its_own_counts(spark):
    rows = [r[:2] for r in corpus()]
    marks = [(i, int(i < 360), 0) for i, _ in rows if i % 2 == 0]
    frame = lambda picked: spark.createDataFrame(picked, "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    score = lambda picked: quality.judge_documents(docs, frame(picked)).where("doc_id = 8").first()["score"]
    assert abs(score(marks) - score([m for m in marks if m[0] != 8])) < 1e-8


def texts(spark, pages, **options):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in site_text.extract_main_text(frame, **options).collect()}


def test_copies_of_one_page_are_no_template(spark):
    ends = ["", "?page=2", "#top"]
    pages = [(f"http://a.example/s{e}", "<article><h1>T</h1><div><p>A</p></div></article>") for e in ends]
    pages += [(f"http://b.example/s{e}", "<body><h1>T</h1><p>A</p></body>") for e in ends]
    pages += [(f"http://c.example/s{e}", f"<nav>Here {e}</nav><body><p>A</p><p>B</p></body>") for e in ends]
    menu = "<div>Home News</div>"
    pages += [(f"http://a.example/{i}", f"<body>{menu}<p>Story {i}</p></body>") for i in range(3)]
    expected = ["T\n\nA"] * 6 + ["A\n\nB"] * 3 + [f"Story {i}" for i in range(3)]
    assert texts(spark, pages) == dict(enumerate(expected))


def test_templates_do_not_depend_on_the_size_of_the_host(spark):
    menu = "<div>Home News</div>"
    pages = [(f"http://a.example/{i}", f"<body>{menu if i < 3 else ''}<p>Story {i}</p></body>") for i in range(400)]
    pages += [(None, None), ("http://b.example/", f"<body>{menu}<p>Own</p></body>")]
    expected = dict(enumerate([f"Story {i}" for i in range(400)] + ["", "Home News\n\nOwn"]))
    assert texts(spark, pages) == expected
    assert texts(spark, pages, list_rows=0) == expected


def periodic_texts():
    """(id, text) of texts in which every string of 60 bytes holds its anchor twice; each second one is also elsewhere."""
    rng = random.Random(11)
    lines = ["".join(rng.choice("abcdefgh ") for _ in range(15)) for _ in range(120)]
    texts = [(line * 6)[:75] for line in lines] + [(line[4:] + line * 6)[:70] for line in lines[::2]]
    texts += ["".join(rng.choice("xyz ") for _ in range(80)) + line * 2 for line in lines[::3]]
    return list(enumerate(texts))


def kept_without_repeats(rows, length):
    seen = Counter(t[k : k + length] for _, t in rows for k in range(len(t) - length + 1))
    gone = lambda t: {k + j for k in range(len(t) - length + 1) if seen[t[k : k + length]] > 1 for j in range(length)}
    return {i: "".join(c for k, c in enumerate(t) if k not in cut).encode() for i, t in rows for cut in [gone(t)]}


def test_starts_without_alignment_have_no_common_core(spark):
    docs = spark.createDataFrame(periodic_texts(), "id long, text string").withColumn("print", F.xxhash64("text"))
    runs = repeats.anchor_runs(docs, 60, 30).select("id", "print", F.explode("runs").alias("r")).select("id", "print", "r.*")
    loose = runs.where("loose")
    parts = repeats.parts_of(docs, loose.withColumn("open", F.lit(True)), 60, repeats.BLOCKS[0])
    starts = loose.agg(F.sum("n")).first()[0]
    assert parts.count() == starts > 1000
    assert parts.groupBy("core").count().agg(F.max("count")).first()[0] < 0.05 * starts
    assert parts.where("n <> 1").count() == 0 and repeats.refined(parts)[1].count() == 0


def test_repeats_in_periodic_texts_whether_cores_are_broadcast_or_not(spark, monkeypatch):
    rows = periodic_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = kept_without_repeats(rows, 60)
    assert any(len(expected[i]) < len(t) for i, t in rows) and any(len(expected[i]) == len(t) for i, t in rows)
    found = lambda: {r["doc_id"]: bytes(r["kept"]) for r in repeats.without_repeats(docs, length=60, gram=30).collect()}
    assert found() == expected
    monkeypatch.setattr(repeats, "sized", lambda small: small)
    monkeypatch.setattr(repeats, "SMALL_ROWS", -1)
    assert found() == expected


def test_a_column_says_which_documents_lose_text(spark, tmp_path):
    passage = " ".join(f"word{k}" for k in range(60))
    texts = [f"one {passage}", f"two {passage}", " ".join(f"word{k}" for k in range(51)) + " and on", "short", None, "x" * 900]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op7_repeated_strings(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["has_repeats"] for r in found] == [r["n_removed"] > 0 for r in found] == [True, True, False, False, False, True]


def test_sliding_hashes_are_those_of_every_stretch():
    rng = np.random.default_rng(3)
    for n, width in ((500, 30), (30, 30), (29, 30), (0, 30)):
        hashes = repeats.ByteHashes(common.Powers(), common.letter_values(fold=False), rng.integers(0, 256, n, dtype=np.uint8))
        places = np.arange(max(n - width + 1, 0))
        assert hashes.sliding(width).tolist() == hashes.of(places, places + width).tolist()


def test_slices_of_texts_do_not_change_the_result(spark, monkeypatch):
    rows = periodic_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(repeats, "SLICE", 100)
    found = {r["doc_id"]: bytes(r["kept"]) for r in repeats.without_repeats(docs, length=60, gram=30).collect()}
    assert found == kept_without_repeats(rows, 60)
