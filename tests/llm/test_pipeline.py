"""The corpus pipeline, stage by stage against plain versions, and the registered queries."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from compare import difference, oracle_connection

import corpus_pipeline
from lealtia.llm import tokens
from lealtia.llm.oracle import LLM_ORACLE
from lealtia.llm.queries import LLM_QUERIES
from lealtia.session import clear_staged

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage got and gave, on the smallest tables."""
    docs, rows = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    like = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        given = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), stage(spark, docs, SMALL).schema)
        if name != "packing":
            assert docs.columns == like
        rows.append((name, given, docs.collect()))
    yield {name: (given, kept) for name, given, kept in rows}
    clear_staged(spark)


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_quality_keeps_rows_whole_and_rejects_by_the_base_rules(stages):
    given, kept = stages["quality"]
    assert set(kept) <= set(given) and 0 < len(kept) < len(given)
    for row in kept:
        words = re.findall(r"[^\x20\x09-\x0D]+", row["text"] or "")
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        twice = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(5)}
        assert len(words) >= 10 and 100 * len(covered) <= 20 * len(words)


def test_good_documents_are_kept(spark, stages):
    good = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect()}
    given, kept = stages["quality"]
    lost = good - {r["doc_id"] for r in kept}
    assert len(lost) <= 0.1 * len(good)


def test_shared_lines_are_gone(stages):
    given, kept = stages["line_dedup"]
    assert sorted(r["doc_id"] for r in given) == sorted(r["doc_id"] for r in kept)
    owners = {}
    for row in given:
        for line in {fold(x.strip(" \t\n\x0b\x0c\r")) for x in (row["text"] or "").split("\n")}:
            owners.setdefault(line, set()).add(row["doc_id"])
    for row in kept:
        for line in (row["text"] or "").split("\n"):
            key = fold(line.strip(" \t\n\x0b\x0c\r"))
            assert len(key) < 20 or len(owners[key]) < 3 or max(owners[key]) == row["doc_id"]


def test_one_document_of_each_near_group_stays(stages):
    given, kept = stages["near_dedup"]

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = sorted((r["doc_id"], shingles(r["text"])) for r in given)
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert {r["doc_id"] for r in kept} == {i for i in root if find(i) == i}


def test_contaminated_documents_are_gone(spark, stages):
    given, kept = stages["decontaminate"]
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for item in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        words = re.findall(pattern, fold(item["text"]))
        n = min(13, len(words))
        windows |= {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    lengths = {len(w) for w in windows}
    clean = set()
    for row in given:
        words, hit = re.findall(pattern, fold(row["text"])), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
        if not hit or 20 * len(hit) < len(words):
            clean.add(row["doc_id"])
    assert {r["doc_id"] for r in kept} == clean


def test_packing_covers_every_id(stages):
    given, pieces = stages["packing"]
    encoder = tokens.Encoder(tokens.BYTE_VOCABULARY)
    sizes = {r["doc_id"]: len(np.frombuffer(encoder.encode([r["text"]])[0], "<u4")) for r in given}
    found = Counter()
    for p in pieces:
        found[p["doc_id"]] += p["length"]
        assert p["doc_tokens"] == sizes[p["doc_id"]] and p["offset"] + p["length"] <= 2048
    assert found == Counter(sizes)
    assert max(p["sequence_id"] for p in pieces) == (sum(sizes.values()) - 1) // 2048


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_equals_its_sql(spark, name):
    assert difference(LLM_QUERIES[name](spark, SMALL), oracle_connection(SMALL), LLM_ORACLE[name]) is None


def test_every_operator_and_the_pipeline_are_registered():
    numbers = [int(m[1]) for n in LLM_QUERIES if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in LLM_QUERIES
