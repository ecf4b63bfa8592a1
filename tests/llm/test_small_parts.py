"""Local parts of the operators against plain versions."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from lealtia.llm import common, differencing, fm_index, near, pii, planes, quality, repeats, site_text, tokens


@pytest.mark.parametrize("vocabulary", [tokens.BYTE_VOCABULARY, tokens.WORD_VOCABULARY])
def test_pieces_give_the_ids_of_whole_texts(vocabulary):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.vocabulary_path(vocabulary))
    encoder = tokens.Encoder(vocabulary)

    @settings(max_examples=150, deadline=None)
    @given(st.text(alphabet=st.sampled_from(list("aAbé'sST .,;!-\n\t\r 3\x1c\x85　Σſ_<|>&́\xa0")), max_size=40))
    def check(text):
        expected = plain.encode(text, add_special_tokens=False).ids + [1]
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == expected

    check()
    for text in ["<|endoftext|> x  <|endoftext|>", "don't I'LL we've\n\n  A1b2", "", "x" * 5000]:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids + [1]
    assert encoder.encode([None]) == [tokens.END_ID]


def test_forgetting_pieces_changes_no_ids(monkeypatch):
    text = " ".join(f"word{i % 7} Other{i}," for i in range(40))
    whole = tokens.Encoder(tokens.WORD_VOCABULARY).encode([text])
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    assert tokens.Encoder(tokens.WORD_VOCABULARY).encode([text]) == whole


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("ids", [[0], [1, 2, 3], [49407, 0, 70000, 2**32 - 1], list(range(1000))])
def test_planes_return_the_ids(kind, ids):
    ids = np.array(ids, "<u4")
    assert planes.join_planes(planes.split_planes(ids, kind), len(ids), kind).tolist() == ids.tolist()


def test_words_by_bytes():
    texts = pa.array(["Ab  cd", None, "", "ab", "é\tAB\x0bx", "tail "])
    values, powers = common.letter_values(fold=True), common.Powers()
    found = []
    for first, end, data, offsets in common.text_slices(texts, limit=6):
        words = common.split_words(data, offsets, near._SPACE, values, powers)
        for i in range(end - first):
            found.append(words.hashes[words.bounds[i] : words.bounds[i + 1]].tolist())
    assert [len(f) for f in found] == [2, 0, 0, 1, 3, 1]
    assert found[0][0] == found[3][0] == found[4][1] and found[0][1] != found[0][0]


def test_sliding_least():
    values = np.random.default_rng(0).integers(0, 50, 200).astype(np.uint64)
    for width in (1, 2, 7, 64, 200):
        expected = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert repeats.sliding_least(values, width).tolist() == expected


def test_differencing_balances_and_places_every_item():
    rng = random.Random(3)
    items = [(rng.randint(1, 1000), i) for i in range(300)]
    placed = differencing.difference(items, 16)
    loads = [sum(s for s, i in items if placed[i] == shard) for shard in range(16)]
    assert sorted(placed) == list(range(300))
    assert max(loads) - min(loads) <= 5
    assert differencing.difference([], 16) == {}
    assert len(set(differencing.difference([(5, 0), (5, 1)], 2).values())) == 2


def test_index_finds_every_occurrence():
    rng = random.Random(5)
    symbols = np.array([0] + [rng.choice([0, 1, 1, 2, 3]) for _ in range(400)])
    index = fm_index.FmIndex(symbols, 5)
    phrases = [[1], [1, 2], [1, 1, 1], [2, 3, 1], [3, 3, 3, 3], [5], [1, 2, 1, 1, 3]]
    table = np.zeros((len(phrases), 5), np.int64)
    for row, phrase in enumerate(phrases):
        table[row, : len(phrase)] = phrase[::-1]
    low, high = index.search(table, np.array([len(p) for p in phrases]))
    for row, phrase in enumerate(phrases):
        expected = [i for i in range(len(symbols)) if symbols[i : i + len(phrase)].tolist() == phrase]
        assert sorted(index.locate(np.arange(low[row], max(low[row], high[row]))).tolist()) == expected


def test_signatures_agree_as_sets_do():
    rng = np.random.default_rng(1)
    seeds = common.mixed(np.arange(1, 129, dtype=np.uint64))
    shared = rng.integers(0, 2**63, 900).astype(np.uint64)
    one = np.concatenate([shared, rng.integers(0, 2**63, 150).astype(np.uint64)])
    two = np.concatenate([shared, rng.integers(0, 2**63, 150).astype(np.uint64)])
    first, second = near.signature(one, seeds), near.signature(two, seeds)
    assert 76 <= (first == second).sum() <= 115
    x, y = near.sketch(first), near.sketch(second)
    differ = sum(bin(int(np.bitwise_or.reduce([x[b * 2 + w] ^ y[b * 2 + w] for b in range(8)]))).count("1") for w in range(2))
    assert differ <= (first != second).sum()


def test_strict_personal_data():
    import re

    texts = [
        "a@b.co, x.y+z@sub.host.org. no@host @a.b ..@c.d e@f..g a@b@c.d",
        "1.2.3.4 256.1.1.1 1.2.3 001.02.3.255 1.2.3.4.5 10.20.30.40",
        "4111 1111 1111 1111 and 4111-1111-1111-1112 1234567890123456789012",
        "+49 (30) 1234-5678 +1 2 +123456789012345678 + 5 +44.20.7946.0958",
    ]
    for text in texts:
        found = pii.strict_spans(text)
        emails = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        assert [(s, e) for s, e, k in found if k == "email"] == emails
    assert [k for _, _, k in pii.strict_spans(texts[1])] == ["ip"] * 4
    assert [k for _, _, k in pii.strict_spans(texts[2])] == ["card"]
    assert [k for _, _, k in pii.strict_spans(texts[3])] == ["phone", "phone"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.@-_ %", max_size=30))
def test_mail_search_equals_the_pattern(text):
    assert list(pii.strict_emails(text)) == [(m.start(), m.end()) for m in pii.EMAIL.finditer(text)]


def test_maximisation_tells_good_labelers_from_bad_ones():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.6
    rates = [0.95, 0.8, 0.8, 0.55]
    votes = ["".join("+" if (t if rng.random() < r else not t) else "-" for r in rates) for t in truth]
    counts = {v: votes.count(v) for v in set(votes)}
    share, table = pii.reliabilities(sorted(counts.items()))
    assert abs(share - 0.6) < 0.05
    assert [round(table[1, i, 2], 1) for i in range(4)] == pytest.approx(rates, abs=0.1)


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><ul><li>Menu</ul></nav>
<header>Site</header><div class="cookie-notice">ok?</div><article><h1>A &amp; B</h1><p><b>One<br>two<p>three &eacute;
</p><aside>side</aside><div class="ad">buy</div><script>var a="<p>no</p>";</script><ul><li>x<li>y</ul><form>f</form>
<section id="comments"><p>first!</p></section></article><footer>end</footer></body></html>"""


def test_main_text_of_a_page():
    assert site_text.Page(PAGE).main_text(frozenset()) == "A & B\n\nOne two\n\nthree é\n\nx\n\ny"
    assert site_text.Page("").main_text(frozenset()) == ""
    assert site_text.Page("plain <b>text").main_text(frozenset()) == "plain text"
    assert site_text.Page("<p>a</p><script>never closed").main_text(frozenset()) == "a"


def test_repeated_block_is_template_but_not_a_running_paragraph():
    page = site_text.Page("<div><ul><li>Home</ul></div><article><p>Text</p><div><b>Buy</b></div></article>")
    subtrees = set(page.subtrees().values())
    assert page.main_text(frozenset(subtrees)) == "Text"


def test_unknown_words_are_encoded_by_the_model_alone():
    own = tokens.Encoder(tokens.WORD_VOCABULARY)
    whole, asked = own.known.encode, []
    own.known.encode = lambda piece, **how: asked.append(piece) or whole(piece, **how)
    words = ["Dretionwhheha", "éémentß", "ÉÉMENTß", "ñandú", "xÿþø", tokens.SMALL, tokens.CAPITALS, "ab\ncd", "It's", "ﬁx", "K", "x́y", "a\x85b"]
    text = " ".join(words) + "\n  Añb,\t(zw) 12x\xa0Ωq"
    assert own.encode(words + [text]) == [np.array([*whole(t, add_special_tokens=False).ids, 1], "<u4").tobytes() for t in words + [text]]
    assert asked and not [piece for piece in asked if tokens.WORD.fullmatch(piece)]


def test_a_vocabulary_that_keeps_capitals_has_no_letter_forms():
    assert tokens.Encoder(tokens.BYTE_VOCABULARY).known.forms is None


def test_neighbours_are_hashed_beside_each_other(spark):
    texts = ["", " \n\t", "a", "a b", "a b c d e", "x y z a b c d e\nx y z a b c d e", "# $5 <é> 😀😀 & | % * \x0b #\x85", None]
    rows = quality.base_rules(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"))
    shown = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in shown  # a table is asked for every character
    pairs = F.transform(F.slice("__q_words", 1, F.greatest(F.size("__q_words") - 1, F.lit(0))), lambda w, i: F.xxhash64(F.xxhash64(w), F.xxhash64(F.get("__q_words", i + 1))))
    for row in rows.select("*", pairs.alias("pairs")).collect():
        words = [w for w in re.split(r"[ \t-\r]+", row["text"] or "") if w]
        assert row["__q_words"] == words and row["__q_pairs"] == row["pairs"] and len(row["__q_five"]) == max(len(words) - 4, 0)
        five = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        assert len(set(row["__q_five"])) == len(set(five))
        assert row["word_chars"] == sum(map(len, words))
        assert row["n_symbols"] == sum(c in "#*$%&|<>" for c in row["text"] or "")
