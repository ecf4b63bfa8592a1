"""Repair, prefix tree and nearest neighbours against brute force, on tables with all odd cases."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lealtia.llm import neighbours, prefix_tree, repair
from lealtia.session import clear_staged

SCHEMA = "conv_id long, turn long, role string, text string, place int, node string, present boolean, bands string"


def conversation_rows():
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "tool", "", None, "sys", "ubot"]
    texts = [None, "", " \t\n", "Yes.", "No", "Why? Because!", "x" * 20_000 + ".", "é" * 5 + "!", "...", "same."]
    rows = []
    for c in range(60):
        turns = rng.randint(0, 9)
        own = [(t, rng.choice(roles[: rng.choice([2, 3, 8])]), rng.choice(texts[3:] if rng.random() < 0.8 else texts)) for t in range(turns)]
        if c % 7 == 0:
            own += [(rng.randint(0, 9), r, x) for _, r, x in own[:2]] + [(None, "user", "Hm.")]
        rows += [(c * 20 if c % 3 else c, *o) for o in own]
    rows += rows[:5]  # given twice
    rows += [(None, 1, "user", "nobody's."), (None, None, None, None), (-40, 3, "user", "below zero")]
    rows += [(777, t, "user" if rng.random() < 0.8 else "assistant", f"turn {t}{rng.choice(['.', ''])}") for t in range(400)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def talks(spark):
    rows = conversation_rows()
    return rows, spark.createDataFrame([(*r, 1, "n", False, "b") for r in rows], SCHEMA).repartition(5)


def first_null(value):
    return (value is not None, value)


def plain_repair(rows):
    """Faults and cheapest repair of one conversation by a search over all states with the edits as part of the order."""
    damaged = []
    for conv, turn, role, text in rows:
        told = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if v is None else v for v in (role, text))
        harm = zlib.crc32(told.encode()) % 20
        if harm == 1:
            text = ""
        elif harm == 2:
            text = "".join(ch for ch in text if ch not in ".!?")
        elif harm == 4:
            role = "user"
        damaged += [(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    damaged.sort(key=lambda r: (first_null(r[0])[0], r[0] or 0, r[1], r[2]))
    counts, faults, seen = defaultdict(int), [], set()
    for _, role, text in damaged:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        counts[fault] += 1
    turns = [t for t, _, _ in damaged if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(damaged, damaged[1:]))
    grammar = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, made = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(damaged) and state in ("", "a"):
            break
        for role in ("user", "assistant"):
            if role[0] in grammar[state]:
                heapq.heappush(heap, (cost + 5, audit + "I", i, role[0], (made, f"{role}:")))
        if i < len(damaged):
            _, own, text = damaged[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, made))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 * (faults[i] == "truncated")
                if own[:1] in grammar[state]:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, own[:1], (made, f"{own}:{text}")))
                for role in ("user", "assistant"):
                    if role[0] in grammar[state]:
                        heapq.heappush(heap, (cost + 1 + extra, audit + "R", i + 1, role[0], (made, f"{role}:{text}")))
    lines = []
    while made:
        made, line = made
        lines.append(line)
    digest = hashlib.sha256("\n".join(reversed(lines)).encode()).hexdigest()
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest)


def by_conversation(rows):
    grouped = defaultdict(list)
    for row in rows:
        grouped[row[0]].append(row)
    return grouped


@pytest.mark.parametrize("piece", [repair.PIECE_ROWS, 3])
def test_repair_equals_a_plain_search(talks, monkeypatch, piece):
    rows, table = talks
    monkeypatch.setattr(repair, "PIECE_ROWS", piece)
    monkeypatch.setattr(repair, "PIECE_CHARS", 1 << 20 if piece > 3 else 15_000)
    turns = repair.damaged(table.select("conv_id", "turn", "role", "text"))
    if piece == 3:  # in this process, where the limits above hold
        ordered = turns.orderBy("conv_id", "present", F.col("turn").asc_nulls_first(), "role", "text", "copy")
        found = [tuple(r.values()) for b in repair.repaired(ordered.toArrow().to_batches()) for r in b.to_pylist()]
    else:
        found = [tuple(r) for r in repair.repair_conversations(table).collect()]
    expected = {(c, *plain_repair(own)) for c, own in by_conversation(rows).items()}
    assert len(found) == len(expected) and set(found) == expected


def test_repair_of_odd_tables(spark):
    schema = "conv_id int, turn int, role string, text string"
    assert repair.repair_conversations(spark.createDataFrame([], schema)).count() == 0
    # A turn that the damage drops, which leaves nothing.
    gone = [(c, t, "user", "Hi.") for c in range(40) for t in range(40) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:1]
    found = repair.repair_conversations(spark.createDataFrame(gone, schema)).collect()
    assert [tuple(r)[1:] for r in found] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("initial", ["u", "a", "s", "t"])
def test_a_long_run_of_one_role_is_repaired_in_time(initial):
    rows = [repair.Row(initial, False, 0)] * repair.PIECE_ROWS
    cost, audit, _ = repair.cheapest_edits(rows, repair.NOTHING, frozenset((repair.NOTHING, repair.ASSISTANT)))
    # Every other turn becomes one of the other side; a system turn can only be first, and then one must go.
    assert cost == {"u": 64, "a": 64, "s": 128, "t": 128}[initial]
    assert len(audit) == repair.PIECE_ROWS


def plain_tree(rows):
    talks = {}
    for c, own in by_conversation([r for r in rows if r[0] is not None]).items():
        printed = [(t, r or "", x or "") for _, t, r, x in own]
        key = lambda v: (v[0] is not None, v[0] or 0, v[1], hashlib.sha256(f"{len(v[1])}:{v[1]}{v[2]}".encode()).hexdigest()[:32])
        talks[c] = [v[1:] for v in sorted(printed, key=key)]
    rebuilt = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 6
        lender = c - int(np.fmod(c, 100))
        rebuilt[c] = tuple(talks.get(lender, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[c] for c in children[p]) or 1
        saved[p] = sum(saved[c] for c in children[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(m), len(p), parent, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("band", [prefix_tree.BAND, 2, 3])
def test_prefix_tree_equals_a_plain_one(spark, talks, band):
    rows, table = talks
    shared = [(c, t, "user", f"{'all' if t < 30 else c} say {t}.") for c in range(300, 340) for t in range(35)]
    more = spark.createDataFrame([(*r, 1, "n", False, "b") for r in shared], SCHEMA)
    found = [tuple(r) for r in prefix_tree.prefix_tree(table.unionByName(more), band).collect()]
    expected = plain_tree(rows + shared)
    assert len(found) == len(expected)
    assert set(found) == set(expected)
    clear_staged(spark)


def test_prefix_tree_of_odd_tables(spark):
    schema = "conv_id int, turn int, role string, text string"
    assert prefix_tree.prefix_tree(spark.createDataFrame([], schema)).count() == 0
    assert prefix_tree.prefix_tree(spark.createDataFrame([(None, 1, "user", "x")], schema)).count() == 0
    single = [tuple(r) for r in prefix_tree.prefix_tree(spark.createDataFrame([(7, None, None, None)], schema)).collect()]
    assert set(single) == set(plain_tree([(7, None, None, None)]))


def test_ends_of_one_node_in_many_runs(spark, monkeypatch):
    monkeypatch.setattr(prefix_tree, "END_CHARACTERS", 10)
    ids = list(range(-30, 900, 3))
    visited = spark.createDataFrame([(b"n", c, 1) for c in ids] + [(b"m", 1, 0), (b"o", 5, 1)], "node binary, conv_id long, ends long")
    found = {bytes(r["node"]): r["ends_sha256"] for r in prefix_tree.ends_digests(visited).collect()}
    told = lambda own: hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
    assert found == {b"n": told(ids), b"o": told([5])}


def plain_neighbours(rows, k, modulus):
    """Every query against every row, sums in order of the components."""
    valid = [(i, np.array(v, "f8")) for i, v in rows if i is not None and v is not None and None not in v]
    valid = [(i, v) for i, v in valid if len(v) and np.isfinite(v).all() and v.any()]
    out = {}
    for q, x in valid:
        if q % modulus:
            continue
        scores = out.setdefault(q, {})
        for i, y in valid:
            if i != q and len(y) == len(x):
                scores[i] = max(scores.get(i, -np.inf), float(np.cumsum(x * y)[-1]))
    return {q: sorted(((-s, i) for i, s in scores.items()))[:k] for q, scores in out.items()}


def vector_rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 12))
    rows = [(i, (centres[i % 20] + 0.3 * rng.normal(size=12)).tolist()) for i in range(4_800)]
    rows += [(6_000 + i, rows[40][1]) for i in range(60)]  # more copies than are asked for
    rows += [(7_000 + i, (rng.normal(size=12) * 10.0 ** rng.integers(-3, 4)).tolist()) for i in range(60)]
    rows += [(8_000 + i, rng.normal(size=5).tolist()) for i in range(7)]
    odd = [None, [], [0.0] * 12, [float("nan")] * 12, [float("inf")] + [1.0] * 11, [None] + [1.0] * 11]
    rows += [(9_000 + 20 * i, v) for i, v in enumerate(odd)] + [(None, rows[0][1])]
    return rows + rows[:40] + [(20, rows[3][1])]


def compared(found, expected):
    """Share of the expected neighbours found; every score must be exact and every list in order."""
    lists = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        lists[r["query_id"]].append((-r["score"], r["vec_id"]))
    assert set(lists) == {q for q, e in expected.items() if e}
    assert all(own == sorted(own) and len(own) == len(expected[q]) for q, own in lists.items())
    hits = sum(len(set(own) & set(expected[q])) for q, own in lists.items())
    return hits / sum(map(len, expected.values()))


def test_neighbours_are_found(spark):
    rows = vector_rows()
    table = spark.createDataFrame([(i, v, "x", 1, [2.0], 3) for i, v in rows], "vec_id long, embedding array<double>, ids string, a long, vector array<double>, id int")
    found = neighbours.nearest_neighbours(table, F.col("id") % 20 == 0)
    assert compared(found.collect(), plain_neighbours(rows, 20, 20)) >= 0.95
    clear_staged(spark)


def test_neighbours_of_few_probes_are_filled_up(spark):
    rows = vector_rows()
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    given = neighbours.valid_vectors(table, "vec_id", "embedding")
    kinds = neighbours.vector_kinds(given)
    hashing = neighbours.Hashing(kinds, tables=1, functions=12, probes=1)
    found = neighbours.nearest_neighbours(table, F.col("id") % 20 == 0, hashing=hashing)
    compared(found.collect(), plain_neighbours(rows, 20, 20))
    clear_staged(spark)


def test_small_tables_are_searched_whole(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.nearest_neighbours(spark.createDataFrame([], schema), F.col("id") % 20 == 0).count() == 0
    rows = [(20 * i, [float(i % 3), 1.0, -0.5 * i]) for i in range(9)]
    found = neighbours.nearest_neighbours(spark.createDataFrame(rows, schema), F.col("id") % 20 == 0).collect()
    assert compared(found, plain_neighbours(rows, 20, 20)) == 1.0


def test_buckets_are_visited_in_order_of_their_distance():
    rng = np.random.default_rng(2)
    place = rng.normal(size=(3, 3)) * 2
    order = neighbours.visiting_order(place, 40)
    for own, visited in zip(place, order):
        gap = np.maximum(0, np.maximum(visited - own, own - visited - 1))
        measure = (gap**2).sum(axis=1)
        assert (np.diff(measure) >= -1e-12).all() and measure[0] == 0
        steps = np.stack(np.meshgrid(*[np.arange(np.floor(v) - 4, np.floor(v) + 5) for v in own], indexing="ij"), -1).reshape(-1, 3)
        gaps = np.maximum(0, np.maximum(steps - own, own - steps - 1))
        assert np.allclose(np.sort((gaps**2).sum(axis=1))[:40], measure)
