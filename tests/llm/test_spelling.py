import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import no_docs, odd_docs, plan_of  # noqa: F401

from plumeledger.llm import spelling_variants as variants


def counted(docs, every):
    """Words of (doc_id, text) and how often they occur, as the contract states it."""
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 7:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(words):
    """Rows by comparing every word with the words that share a form with one letter out."""
    holders = {}
    for w in words:
        for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            holders.setdefault(key, set()).add(w)
    forms, rows = {}, {}
    for w, n in words.items():
        met = set().union(*(holders[k] for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}))
        close = sorted((x for x in met if near(w, x)), key=lambda x: (-words[x], x))
        if close and words[close[0]] >= 10 * n:
            forms[w] = close[0]
        rows[w] = (forms.get(w), n, len(close), words[forms[w]] if w in forms else None)
    out = set()
    for w, (form, n, n_near, form_n) in rows.items():
        root = w
        while root in forms:
            root = forms[root]
        out.add((w, form, root, n, n_near, form_n))
    return out


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_same_as_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = grouped(counted([(r["doc_id"], r["text"]) for r in docs.collect()], 31))
    assert len(expected) > 1000 and any(r[1] is not None for r in expected)
    assert rows_of(variants.group_variants(docs, every=31)) == expected


@pytest.mark.parametrize("limit", [4, 60, 20_000])
def test_chains_and_crowded_vectors_at_every_depth(spark, monkeypatch, limit):
    """Few letters, so that many words share a vector; counts that make chains of forms."""
    monkeypatch.setattr(variants, "NODE_WORDS", limit)
    monkeypatch.setattr(variants, "SHARD_WORDS", limit)
    rng = random.Random(limit)
    words = {"".join(rng.choices("abéÿz", k=rng.randint(7, 8))) for _ in range(500)}
    chain = ["brightest", "brightes", "brightos", "brightosx"]
    texts = [(i, " ".join([w.title()] * rng.choice([1, 2, 2, 3, 30]))) for i, w in enumerate(sorted(words))]
    texts += [(None, " ".join([w] * 2 * 10 ** (3 - k))) for k, w in enumerate(chain)]
    texts += [(1000, None), (1001, ""), (1002, "x" * 5000), (1002, "x" * 5000), (1003, "x" * 4999 + " ")] * 2
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    expected = grouped(counted(texts, 0))
    assert ("brightosx", "brightos", "brightest", 2, 1, 20) in expected
    assert rows_of(variants.group_variants(df)) == expected


def test_trie_finds_each_pair_once():
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("entiaé", k=rng.randint(7, 9))) for _ in range(400)})
    counts = variants.vectors(pa.array(words))
    trie = variants.FrequencyTrie(counts)
    seen = Counter()
    for leaf, queries in trie.search(counts):
        for w in trie.words[trie.bounds[leaf] : trie.bounds[leaf + 1]]:
            seen.update((int(q), int(w)) for q in queries)
    for i in range(len(words)):
        for k in range(len(words)):
            gap = counts[k] - counts[i]
            within = gap.max(initial=0) <= 1 and gap.min(initial=0) >= -1 and np.abs(gap).sum() <= 2
            within &= (gap == 1).sum() <= 1 and (gap == -1).sum() <= 1
            first = gap[np.flatnonzero(gap)[0]] if gap.any() else 0
            assert seen[i, k] == (within and first >= 0)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    assert variants.group_variants(no_docs, every=31).collect() == []
    texts = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert rows_of(variants.group_variants(odd_docs, every=31)) == grouped(counted(texts, 31))
