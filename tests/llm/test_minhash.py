import random
import re

import pytest
from pyspark.sql import functions as F
from llm_fixtures import no_docs, odd_docs  # noqa: F401

from plumeledger.llm import minhash_dedup as m
from plumeledger.llm.components import components
from plumeledger.llm.shared import Scratch


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def groups(sets, percent=80):
    """Smallest position reachable, by comparing all pairs."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(sets))]


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.fixture(scope="module")
def families():
    """Chains and clouds of near copies, many of them just below the threshold to each other."""
    rng = random.Random(5)
    texts = [" ".join(f"u{rng.randrange(10**6)}" for _ in range(80)) for _ in range(30)]
    for _ in range(4):
        base = " ".join(f"v{rng.randrange(10**6)}" for _ in range(120))
        texts += [edited(rng, base, rng.randint(0, 6)) for _ in range(45)]
        chain = base[::-1]
        for _ in range(12):
            chain = edited(rng, chain, 3)
            texts.append(chain)
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("words", [4, 5])
def test_same_as_brute_force(spark, families, words, monkeypatch):
    monkeypatch.setattr(m, "_BLOCK_CLASSES", 16)
    docs = spark.createDataFrame(list(enumerate(families)), "doc_id long, text string").repartition(4)
    rows = m.near_duplicates(docs, words=words).collect()
    sets = [shingles(t, words) for t in families]
    expected = groups(sets)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == {
        i: (len(s), c, c == i) for i, (s, c) in enumerate(zip(sets, expected, strict=True))
    }


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    rows = m.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert [by_id[i]["n_shingles"] for i in (1, 2, 3, 5)] == [0, 0, 0, 1]
    assert by_id[7]["component_id"] == 6 and not by_id[7]["kept"]
    assert all(r["component_id"] == r["doc_id"] and r["kept"] for r in rows if r["doc_id"] != 7)
    assert m.near_duplicates(no_docs).collect() == []
    kept = m.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(map(repr, [1, 2, 3, 4, None, None, 5, 6, 8, 9]))
    assert m.one_of_each(no_docs).collect() == []


def test_one_class_of_copies(spark):
    """All rows alike: one class, no candidates, no links."""
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("a b c d e f g").alias("text"))
    rows = m.near_duplicates(docs).groupBy("component_id").count().collect()
    assert [tuple(r) for r in rows] == [(0, 500)]
    assert m.one_of_each(docs.withColumn("doc_id", F.lit(1))).count() == 1


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    rng.shuffle(edges)
    found = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert len(found) == len(expected) and {r["node"]: r["root"] for r in found} == expected
    none = spark.createDataFrame([], "a long, b long")
    assert components(none, Scratch(spark, "t")).collect() == []
