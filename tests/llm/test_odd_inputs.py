"""Odd inputs of earlier operators and of every pipeline stage, and the learned quality rule against a plain one."""

from __future__ import annotations

import math
import random
import re
import time
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F
from test_whole_job import corpus

import corpus_pipeline
from lealtia.llm import near, pii, quality, site_text
from lealtia.session import clear_staged, fresh_path


def slow_addresses(text):
    """The contract's pattern, tried from every place."""
    pattern, found, at = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), [], 0
    while match := pattern.search(text, at):
        at = match.end()
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in match.group().split(".")):
            found.append(match.span())
    return found


def test_addresses_equal_the_pattern():
    rng = random.Random(1)
    for _ in range(3_000):
        text = "".join(rng.choice(["1", "25", "300", ".", ".", "..", " ", "007", "a"]) for _ in range(rng.randint(1, 20)))
        assert list(pii.strict_addresses(text)) == slow_addresses(text)
    assert list(pii.strict_addresses("0" * 5_000 + ".1.1.1")) == [(0, 5_006)]


@pytest.mark.parametrize(
    "text",
    ["1" * 1_000_000, "(at)" + "a" * 1_000_000, "a" * 1_000_000 + "(at)b", "at " * 300_000 + " dot ", "@" * 500_000, "+1" * 300_000],
)
def test_personal_data_of_very_long_texts_takes_little_time(text):
    start = time.perf_counter()
    pii.candidates(text)
    assert time.perf_counter() - start < 4


def test_masked_mail_is_found_from_its_sign():
    spans = pii.candidates("write bob.x (at) mail [dot] example.com, or ann at home dot org; (at)nobody.com")
    assert [s["kind"] for s in spans] == ["email", "email"]
    text = "write bob.x (at) mail [dot] example.com, or ann at home dot org; (at)nobody.com"
    assert [text[s["start"] : s["end"]] for s in spans] == ["bob.x (at) mail [dot] example.com", "ann at home dot org"]


def main_text(source):
    return site_text.Page(source).main_text(frozenset())


@pytest.mark.parametrize(
    "source, expected",
    [
        ("<head><script>for(i=0;i<n;i++){}</script></head><body><article><h1>T</h1><p>A</p></article>", "T\n\nA"),
        ("<article><h1>T</h1><script>if(a<b){x='</p>'}</SCRIPT ><p>Body</p></article>", "T\n\nBody"),
        ("<div class='layout has-sidebar'><article><h1>T</h1><p>A</p></article></div>", "T\n\nA"),
        ("<form id='aspnetForm'><article><h1>T</h1><p>A</p></article></form>", "T\n\nA"),
        ("<div id='content' class='no-comments'><h1>T</h1><p>A</p></div><div class='comments'><p>c</p></div>", "T\n\nA"),
        ("<div class='comments'><article class='comment'><p>bad</p></article></div><p>A</p>", "A"),
        ("<form><p>Name</p></form><p>A</p>", "A"),
        ("1 < 2 and <b>c</b> > d", "1 < 2 and c > d"),
        ("<p>x</p><script>never ends <p>y</p>", "x"),
        ("<a title='1 > 0'>z</a><p>it's</p>", "z\n\nit's"),
        ("<p>a<!-- <p>b</p> --></p><!x><?y?>", "a"),
    ],
)
def test_article_text_is_not_lost(source, expected):
    assert main_text(source) == expected


@pytest.mark.parametrize("source", ["<a " * 100_000, '<a "' * 100_001, "<a '\"" * 50_001, "<a \"'>" * 50_001, "<!" * 100_000, "<script>" * 20_000])
def test_broken_sources_take_time_in_proportion(source):
    start = time.perf_counter()
    main_text(source)
    assert time.perf_counter() - start < 4


def test_parts_of_a_serial_keep_their_shared_body(spark):
    body = "<div><p>Same story body.</p></div><ul><li>Flour</li></ul>"
    pages = [(i, f"http://a.example/{i}", f"<article><h1>Part {i}</h1>{body}</article>") for i in range(3)]
    share = "<div>Tell your friends</div>"
    pages += [(i, f"http://b.example/{i}", f"<article><h1>Story {i}</h1>{share}</article>") for i in range(10, 22)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in site_text.extract_main_text(frame).collect()}
    for i in range(3):
        assert found[i] == f"Part {i}\n\nSame story body.\n\nFlour"
    for i in range(10, 22):
        assert found[i] == f"Story {i}"


def plain_judgement(rows, marks, buckets):
    """Scores, threshold and verdicts of the learned rule, document by document."""
    signed = lambda n: n - 2**64 if n >= 2**63 else n

    def grams(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        own = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
        pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(own, own[1:])]
        return Counter(signed(h) % buckets for h in own + pairs)

    counts = {i: grams(t) for i, t in rows}
    raw = Counter()
    for own in counts.values():
        raw.update(own)
    n_raw = sum(raw.values())
    prior = {b: buckets * n / n_raw for b, n in raw.items()}
    seen, target = Counter(), Counter()
    for i, good in marks.items():
        seen.update(counts[i])
        target.update(counts[i] if good else {})
    scores = {}
    for i, own in counts.items():
        # Without the document's own label, if it has one.
        s = seen - own if i in marks else seen
        t = target - own if marks.get(i) else target
        good = (sum(t.values()) + 1) / (sum(s.values()) + 2)
        kept = {b: (t[b] + good * prior[b]) / (s[b] + prior[b]) for b in raw}
        # Target mass of the bucket over that of the good share of the corpus, against its share of the raw corpus.
        parts = [n * math.log(raw[b] * kept[b] / (good * n_raw) / (raw[b] / n_raw)) for b, n in own.items()]
        scores[i] = sum(parts) / sum(own.values()) if own else 0.0
    return scores


def test_learned_quality_rule_equals_a_plain_one(spark):
    rows = [r[:2] for r in corpus()]
    marks = {i: int(k != "junk") for i, _, k in corpus() if i % 3}
    buckets = 512
    labels = spark.createDataFrame([(i, m, 0) for i, m in marks.items()], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in quality.judge_documents(docs, labels, buckets=buckets).collect()}
    scores = plain_judgement(rows, marks, buckets)
    for i, score in scores.items():
        assert found[i]["score"] == pytest.approx(score, abs=1e-8)
    # The threshold: steps of the labelled documents that pass the base rules.
    steps = sorted({math.floor(found[i]["score"] * quality.STEPS) for i in marks if not found[i]["base_failed"]})
    tally = Counter((math.floor(found[i]["score"] * quality.STEPS), m) for i, m in marks.items() if not found[i]["base_failed"])
    goods, bads = (sum(tally[s, m] for s in steps) for m in (1, 0))
    best = (0.0, None)
    for last, step in zip(steps, steps[1:]):
        lost = (sum(tally[s, 1] for s in steps if s < step) + 1) / (goods + 1)
        gain = sum(tally[s, 0] for s in steps if s < step) / bads - quality.LOSS_WEIGHT * lost
        if gain > best[0] + 1e-12:
            best = (gain, (last + 1 + step) / (2 * quality.STEPS))
    assert best[1] is not None
    for i, _ in rows:
        assert found[i]["kept"] == (not found[i]["base_failed"] and found[i]["score"] >= best[1])
    assert sum(r["kept"] for r in found.values()) < len(rows)


SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_words long, score string, kept string, items string,"
    " n_dropped string, wanted long, open_id long, doc_tokens string, __gone long, n_hit string, contaminated string"
)


def odd_rows():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    texts = [None, "", " \n\t ", "one", "x" * 200_000, " ".join(word() for _ in range(20_000))]
    texts += [" ".join(word() for _ in range(80)) for _ in range(12)]
    shared = "\nA line that many documents share in full\n"
    texts += [" ".join(word() for _ in range(40)) + shared + " ".join(word() for _ in range(40)) for _ in range(5)]
    rows = list(enumerate(texts))
    rows += [(7, texts[7]), (8, "a different text under a used id " * 5), (None, texts[9]), (None, None), (99, texts[10])]
    return [(i, t, "en", "web", len(t or ""), 5, "s", "k", "i", "d", 1, 2, "t", 3, "h", "c") for i, t in rows]


@pytest.fixture(scope="module")
def small_tables(spark):
    path = fresh_path(spark, "small-tables")
    spark.createDataFrame([(i, int(i % 2), 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this stands in any document here at all")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    yield path
    clear_staged(spark)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_odd_rows_and_clashing_columns(spark, small_tables, name):
    stage, rows = dict(corpus_pipeline.STAGES)[name], odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = stage(spark, docs, small_tables)
    assert stage(spark, docs.limit(0), small_tables).count() == 0
    if name == "packing":
        pieces = found.collect()
        assert Counter(p["doc_id"] for p in pieces if p["start"] == 0) == Counter(r[0] for r in rows)
        return
    assert found.dtypes == docs.dtypes
    kept = [tuple(r) for r in found.collect()]
    given = Counter(rows)
    if name == "line_dedup":
        # The shared line stays in one document only; nothing else of any row changes.
        assert Counter((r[0], *r[5:]) for r in kept) == Counter((r[0], *r[5:]) for r in rows)
        assert sum("many documents share" in (r[1] or "") for r in kept) == 1
        assert all(r[4] == len(r[1] or "") for r in kept)
        assert not Counter(r for r in kept if "share" not in (r[1] or "")) - (given + Counter((r[0], (r[1] or "").replace("\nA line that many documents share in full", ""), *r[2:4], len((r[1] or "").replace("\nA line that many documents share in full", "")), *r[5:]) for r in rows))
        return
    assert not Counter(kept) - given
    gone = given - Counter(kept)
    if name == "decontaminate":
        assert not gone
    elif name == "near_dedup":
        assert set(gone) == {r for r in rows if r[0] == 99}
    else:
        short = [r for r in rows if len((r[1] or "").split()) < 10]
        assert all(r in gone for r in short)


def test_near_duplicates_of_tables_with_any_columns(spark):
    texts = [(i, " ".join(f"w{(i // 2) * 100 + k}" for k in range(30))) for i in range(8)]
    docs = spark.createDataFrame([(*t, 1, 2, 3) for t in texts], "doc_id long, text string, wanted long, open_id long, __near_id long")
    found = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs).collect()}
    assert found == {i: i // 2 * 2 for i in range(8)}


def test_pairs_of_the_last_comparison_are_all_links_left(spark, monkeypatch):
    """With hubs that link nothing, the last comparison has to find every link by itself."""
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 999)}" for _ in range(300)]
    texts = []
    for i in range(25):
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(300)] = f"e{i}x{rng.randint(0, 99)}"
        texts.append((i, " ".join(copy)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(296)} for i, t in texts}
    alone = {i: {i} for i in sets}
    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and alone[i] is not alone[j]:
                merged = alone[i] | alone[j]
                alone.update(dict.fromkeys(merged, merged))
    nothing = lambda posts, others, *_, **__: posts.select(F.col("b").alias("a"), "b").limit(0)
    monkeypatch.setattr(near, "agreeing", nothing)
    found = {r["doc_id"]: r["component_id"] for r in near.near_duplicates(docs).collect()}
    assert found == {i: min(group) for i, group in alone.items()}
