"""Every operator over small tables with all odd cases, against brute force."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lealtia.llm import differencing, fm_index, lines, near, packing, pii, planes, quality, repeats, site_text, tokens
from lealtia.session import clear_staged, fresh_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, list_id long, score string"


def make_texts():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    base = words(120)
    texts = [None, "", " \n\t ", "one", "One two THREE four", "x" * 3000, "\n\n\n"]
    for change in (0, 0, 1, 2, 5, 9, 14):
        copy = list(base)
        for _ in range(change):
            copy[rng.randrange(len(copy))] = "edit" + str(rng.randrange(1000))
        texts.append(" ".join(copy))
    passage = " ".join(words(60))
    shared = "A line that MANY documents share, of some length"
    for i in range(12):
        mine = words(rng.randint(20, 150))
        text = " ".join(mine[:10]) + f"\n {shared.upper() if i % 2 else shared}\t\n" + " ".join(mine[10:])
        texts.append(text + ("\n" + passage if i % 3 == 0 else "") + ("\n" + " ".join(base[30:50]) if i % 4 == 0 else ""))
    texts += ["ñandú É " * 40, "mail me: bob@mail.example.com or 10.1.2.3, card 4111 1111 1111 1111 tel +49 (30) 1234-5678"]
    texts += ["y" * 399, "ab" * 500, " ".join(words(3000))]
    return texts


@pytest.fixture(scope="module")
def rows():
    texts = make_texts()
    numbered = [(i, t) for i, t in enumerate(texts)]
    numbered += [(5, texts[5]), (8, texts[8])]  # given twice
    numbered += [(None, texts[9]), (None, None), (7, "another text under a used id")]
    random.Random(2).shuffle(numbered)
    return numbered


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(i, t, "en", None, None, 1, True, 2, "s") for i, t in rows]
    yield spark.createDataFrame(data, SCHEMA).repartition(5)
    clear_staged(spark)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def ordered(items):
    return sorted(items, key=lambda r: tuple((v is not None, str(v)) for v in r))


def ids_of(vocabulary):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.vocabulary_path(vocabulary))
    return lambda t: plain.encode(t or "", add_special_tokens=False).ids + [1]


def test_packing(docs, none, rows):
    encode = ids_of(tokens.BYTE_VOCABULARY)
    pieces = [r.asDict() for r in packing.pack(docs, window=64).collect()]
    stream = {}
    for p in pieces:
        raw = np.frombuffer(p["ids"], "<u4")
        assert len(raw) == p["length"] and 0 <= p["offset"] and p["offset"] + p["length"] <= 64
        stream.update({p["sequence_id"] * 64 + p["offset"] + k: int(v) for k, v in enumerate(raw)})
    assert sorted(stream) == list(range(sum(len(encode(t)) for _, t in rows)))
    whole = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        whole.setdefault(p["sequence_id"] * 64 + p["offset"] - p["start"], [p["doc_id"], b"", p["doc_tokens"]])[1] += p["ids"]
    found = ordered((d, np.frombuffer(b, "<u4").tolist(), n) for d, b, n in whole.values())
    assert found == ordered((i, encode(t), len(encode(t))) for i, t in rows)
    full = packing.sequences(packing.pack(docs, window=64)).collect()
    assert sorted(r["length"] for r in full)[1:] == [64] * (len(full) - 1)
    assert packing.pack(none).count() == 0


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes(spark, docs, none, rows, kind):
    encode = ids_of(tokens.WORD_VOCABULARY)
    path = fresh_path(spark, "planes-test")
    planes.write_ids(docs, path, kind=kind, block=50, chunk=170)
    found = [(r["doc_id"], r["start"], r["n_tokens"], np.frombuffer(r["ids"], "<u4").tolist()) for r in planes.read_ids(spark, path, kind).collect()]
    start, expected = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = encode(t)
        expected.append((i, start, len(ids), ids))
        start += len(ids)
    assert sorted(found, key=lambda r: r[1]) == expected
    index = spark.read.parquet(f"{path}/index").agg(F.sum("n_ids"), F.sum("n_docs")).first()
    assert tuple(index) == (start, len(rows))
    path = fresh_path(spark, "planes-none")
    planes.write_ids(none, path)
    assert planes.read_ids(spark, path).count() == 0


def test_shards(docs, none, rows):
    found = differencing.balanced_shards(docs, shards=4, packets=8, large_parts=20).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert ordered((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == ordered(
        (i, size(t), zlib.crc32((t or "").encode())) for i, t in rows
    )
    assert len({(r["text_crc32"], r["size"], r["shard"]) for r in found}) == len({(t or "") for _, t in rows})
    for shard in range(4):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert differencing.balanced_shards(none).count() == 0


def test_line_dedup(docs, none, rows):
    blank = " \t\n\x0b\x0c\r"
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(blank))
    owners = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                owners.setdefault(key(line), set()).add(i)
    keeper = {k: max((x for x in o if x is not None), default=None) for k, o in owners.items() if len(o) >= 3}
    expected = []
    for i, t in rows:
        split = (t or "").split("\n")
        left = [x for x in split if not (key(x) in keeper and keeper[key(x)] != i)]
        expected.append((i, len(split), len(split) - len(left), t if len(left) == len(split) else "\n".join(left)))
    found = lines.drop_shared_lines(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert ordered(tuple(r) for r in found.select("doc_id", "n_lines", "n_dropped", "text").collect()) == ordered(expected)
    assert sum(e[2] for e in expected) > 5
    assert lines.drop_shared_lines(none).count() == 0


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(5)}
    solid = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return words, (len(words), sum(map(len, words)), symbols, len(solid) - len(set(solid)), len(covered), failed)


def test_quality(spark, docs, none, rows):
    buckets = 64
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(20)] + [(3, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    found = quality.judge_documents(docs, labels, threshold=-0.05, buckets=buckets)
    assert set(docs.columns) <= set(found.columns) and len(set(found.columns)) == len(found.columns)
    signed = lambda n: n - 2**64 if n >= 2**63 else n

    def grams(words):
        own = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
        pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(own, own[1:])]
        return [signed(h) % buckets for h in own + pairs]

    raw, target = Counter(), Counter()
    good = {i for i in range(20) if i % 2}
    for i, t in rows:
        raw.update(grams(measures(t)[0]))
        if i in good:
            target.update(grams(measures(t)[0]))
    share = lambda c, b: math.log((c[b] + 1) / (sum(c.values()) + buckets))
    weight = [share(target, b) - share(raw, b) for b in range(buckets)]
    expected = []
    for i, t in rows:
        words, values = measures(t)
        g = grams(words)
        score = sum(weight[b] for b in g) / len(g) if g else 0.0
        expected.append((i, *values, round(score, 6), not values[-1] and score >= -0.05))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    result = [(r[0], *r[1:7], round(r[7], 6), r[8]) for r in found.select("doc_id", *columns).collect()]
    assert ordered(result) == ordered(expected)
    assert ordered(tuple(r) for r in found.where("kept").select("doc_id", "text").collect()) == ordered(
        (i, t) for (i, t), e in zip(rows, expected) if e[-1]
    )
    assert quality.judge_documents(none, labels).count() == 0


def shingles(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    return frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)])


def test_near_duplicates(docs, none, rows):
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= 75 * len(a | b):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    expected = [
        (i, len(shingles(t)), root(i) if i is not None else None, i is None or root(i) == i) for i, t in rows
    ]
    found = near.near_duplicates(docs).collect()
    assert ordered(tuple(r) for r in found) == ordered(expected)
    assert len({e[2] for e in expected} - {None}) <= len(parent) - 3
    assert near.near_duplicates(none).count() == 0


def test_near_duplicates_in_a_large_group(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = []
    for i in range(300):
        copy = list(base)
        for _ in range(rng.choice([1, 3, 12, 20])):
            copy[rng.randrange(200)] = f"e{rng.randrange(10**6)}"
        texts.append((i, " ".join(copy)))
    sets = [shingles(t) for _, t in texts]
    parent = list(range(300))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(300), 2):
        if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            x, y = root(i), root(j)
            parent[max(x, y)] = min(x, y)
    found = near.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: root(i) for i in range(300)}


@pytest.mark.parametrize("block_words", [10**6, 40])
def test_passages(spark, docs, none, rows, block_words):
    fold = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))
    texts = dict((i, t) for i, t in rows if i is not None and i != 7)
    items = [(1, texts[20]), (2, " ".join(words(texts[9])[5:30])), (3, "One, two"), (4, None), (5, ""), (10, "one"), (10, "one"), (11, "never seen here"), (None, "three four")]
    found = fm_index.find_passages(docs, spark.createDataFrame(items, "item_id long, text string"), ["doc_id", "lang"], block_words=block_words)
    expected = []
    for i, t in rows:
        own, hit, names = words(t), set(), set()
        for name, text in items:
            w = words(text)
            n = min(13, len(w))
            windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
            for k in range(len(own) - n + 1 if n else 0):
                if tuple(own[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    if name is not None:
                        names.add(str(name))
        expected.append((i, "en", len(own), len(hit), sorted(names), len(names), bool(hit) and 20 * len(hit) >= len(own)))
    result = found.select("doc_id", "lang", "n_words", "n_hit", "items", "n_items", "contaminated").collect()
    assert ordered(tuple(r) for r in result) == ordered(expected)
    assert any(e[-1] for e in expected)
    assert fm_index.find_passages(none, spark.createDataFrame(items, "item_id long, text string"), ["doc_id"]).count() == 0
    empty = fm_index.find_passages(docs, spark.createDataFrame([], "item_id long, text string"), ["doc_id"])
    assert empty.where("contaminated OR n_hit > 0").count() == 0 and empty.count() == len(rows)


def test_repeated_strings(docs, none, rows):
    length = 60
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    expected = []
    for i, b in raw:
        stay = bytearray(b"\1" * len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                stay[k : k + length] = b"\0" * length
        kept = bytes(x for x, s in zip(b, stay) if s)
        expected.append((i, len(b), len(b) - len(kept), len([p for p in bytes(stay).split(b"\1") if p]), hashlib.sha256(kept).hexdigest()))
    found = repeats.without_repeats(docs, length=length, gram=30).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)
    )
    assert ordered(tuple(r) for r in found.collect()) == ordered(expected)
    assert repeats.without_repeats(none).count() == 0


def test_repeats_of_any_alignment(spark):
    rng = random.Random(4)
    passages = ["".join(rng.choice("abcd ") for _ in range(rng.randint(55, 140))) for _ in range(6)]
    texts = ["".join(rng.choice([p, p[rng.randrange(40) :], "".join(rng.choice("xyz") for _ in range(30))]) for p in rng.sample(passages, 4)) for _ in range(40)]
    texts += ["a" * 200, "ab" * 70, ("abcdefg" * 12)[:70]]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = Counter(t[k : k + 60] for t in texts for k in range(len(t) - 59))
    found = {r["doc_id"]: bytes(r["kept"]) for r in repeats.without_repeats(frame, length=60, gram=30).collect()}
    for i, t in enumerate(texts):
        gone = {k + j for k in range(len(t) - 59) if seen[t[k : k + 60]] > 1 for j in range(60)}
        assert found[i] == "".join(c for k, c in enumerate(t) if k not in gone).encode()


def test_personal_spans(docs, none, rows):
    found = pii.personal_spans(docs).collect()
    assert len(found) == len(rows)
    by_text = ordered((r["doc_id"], [(s["start"], s["end"], s["kind"]) for s in r["spans"] if s["strict"]]) for r in found)
    assert by_text == ordered((i, pii.strict_spans(t or "")) for i, t in rows)
    assert pii.personal_spans(none).count() == 0
    assert pii.personal_spans(docs.where("text IS NULL")).where("size(spans) > 0").count() == 0


def test_site_templates(spark):
    menu = "<div class='x'><ul><li>Home<li>News</ul></div>"
    pages = [(i, f"https://A.example/{i}", f"<body>{menu}<main><h1>T{i}</h1><p>Same words</p><p>Own {i}</p></main></body>") for i in range(5)]
    pages += [(9, "https://b.example/", f"<body>{menu}<p>Only here</p></body>"), (10, None, None), (None, "", ""), (4, pages[4][1], pages[4][2])]
    pages += [(20 + i, f"http://c.example/{i}", f"<p>Offer of the day</p><p>Story {i}</p>") for i in range(4)]
    frame = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, text string")
    found = ordered((r["page_id"], r["text"]) for r in site_text.extract_main_text(frame).collect())
    expected = [(i, f"T{i}\n\nSame words\n\nOwn {i}") for i in range(5)] + [(4, "T4\n\nSame words\n\nOwn 4")]
    expected += [(9, "Home\n\nNews\n\nOnly here"), (10, ""), (None, "")] + [(20 + i, f"Story {i}") for i in range(4)]
    assert found == ordered(expected)
    assert site_text.extract_main_text(frame.limit(0)).count() == 0
