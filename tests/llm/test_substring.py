import random
import re

import numpy as np
import pytest
from llm_fixtures import no_docs, odd_docs, plan_of  # noqa: F401

from plumeledger.llm import substring_dedup as passages
from plumeledger.llm.substring_dedup import SuffixAutomaton, leftmost_minima


def plain(texts, window):
    """Words of every text, and which of them some repeated window covers."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    starts = {}
    for d, w in enumerate(words):
        for p in range(len(w) - window + 1):
            starts.setdefault(tuple(w[p : p + window]), []).append((d, p))
    gone = [set() for _ in texts]
    for places in starts.values():
        if len(places) > 1:
            for d, p in places:
                gone[d].update(range(p, p + window))
    return [(len(w), len(g), " ".join(x for i, x in enumerate(w) if i not in g)) for w, g in zip(words, gone, strict=True)]


def corpus(seed, size):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "é", "the", "of"]) if rng.random() < 0.3 else f"w{rng.randint(0, 400)}"
    shared = [" ".join(word() for _ in range(rng.choice([9, 12, 30]))) for _ in range(6)]
    texts = []
    for _ in range(size):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), " ".join(word() for _ in range(rng.randint(0, 12)))]
        texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(parts))
    texts += texts[:5] * 3 + ["x " * 200, "x y " * 60, "x " * 9, "", None, " \n", "p q r s t u v w"]
    return texts


def found(spark, texts, partitions=5, **settings):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(partitions)
    rows = sorted(passages.remove_repeated(df, **settings).collect())
    assert [r["doc_id"] for r in rows] == list(range(len(texts)))
    for r in rows:
        assert r["n_removed"] == sum(x["e"] - x["s"] for x in r["spans"])
        assert all(x["e"] < y["s"] for x, y in zip(r["spans"], r["spans"][1:]))
    return [(r["n_words"], r["n_removed"], r["text"]) for r in rows]


@pytest.mark.parametrize("window,routes", [(8, (3, 5, 8)), (10, (10,)), (6, (1, 6))])
def test_same_as_plain_version(spark, window, routes):
    texts = corpus(window, 150)
    expected = plain(texts, window)
    assert sum(bool(n) for _, n, _ in expected) > 30 and sum(not n for _, n, _ in expected) > 20
    assert found(spark, texts, window=window, routes=routes) == expected


def test_hot_keys_are_cut_by_longer_grams(spark, monkeypatch):
    monkeypatch.setattr(passages, "HOT_WORDS", 40)
    monkeypatch.setattr(passages, "SHARD_WORDS", 60)
    texts = corpus(4, 150)
    assert found(spark, texts, window=8, routes=(3, 5, 8)) == plain(texts, 8)


def test_rows_that_repeat_are_documents_of_their_own(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text), (1, text), (None, text + " end"), (2, "short")], "doc_id long, text string")
    rows = [(r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in passages.remove_repeated(df).collect()]
    assert sorted(rows, key=repr) == [(1, 40, 40, ""), (1, 40, 40, ""), (2, 1, 0, "short"), (None, 41, 40, "end")]


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    assert passages.remove_repeated(no_docs).collect() == []
    rows = passages.remove_repeated(odd_docs, window=5, routes=(2,)).collect()
    given = odd_docs.select("doc_id", "text").collect()
    expected = plain([r["text"] for r in given], 5)
    ours = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["text"]) for r in rows)
    assert ours == sorted((str(g["doc_id"]), *e) for g, e in zip(given, expected, strict=True))


def test_leftmost_minima():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 28, 40):
        x = rng.integers(0, 9, 100).astype(np.uint64)
        assert leftmost_minima(x, width).tolist() == [i + int(np.argmin(x[i : i + width])) for i in range(101 - width)]


def test_automaton_counts_every_substring():
    rng = random.Random(2)
    for _ in range(200):
        texts = [([rng.randint(0, 2) for _ in range(rng.randint(1, 12))], rng.randint(1, 3)) for _ in range(4)]
        automaton = SuffixAutomaton()
        for text, weight in texts:
            automaton.add(text, weight)
        automaton.close()
        count = {}
        for text, weight in texts:
            for i in range(len(text)):
                for k in range(i + 1, len(text) + 1):
                    count[tuple(text[i:k])] = count.get(tuple(text[i:k]), 0) + weight
        for piece, n in count.items():
            state = 0
            for w in piece:
                state = automaton.next[state][w]
            assert automaton.count[state] == n
        for text, _ in texts:
            for least in (1, 3):
                covered = {i for s, e in automaton.spans(text, least) for i in range(s, e)}
                assert covered == {
                    i
                    for a in range(len(text))
                    for b in range(a + least, len(text) + 1)
                    if count[tuple(text[a:b])] > 1
                    for i in range(a, b)
                }
