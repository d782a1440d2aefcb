"""The registered queries against SQL, and the pipeline against a plain version."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer
from llm_fixtures import no_docs, odd_docs  # noqa: F401

import __spark_entry__ as contract
import corpus_pipeline
from plumeledger.llm import pii, quality
from plumeledger.llm.oracle import ORACLE
from plumeledger.llm.queries import QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def test_registered():
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert set(ORACLE) < set(QUERIES) and "pipeline" in contract.queries()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", list(ORACLE))
def test_same_as_sql(spark, sf_dir, name):
    engine = duckdb.connect()
    for table in TABLES:
        engine.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    result = engine.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    ours = sorted(repr(tuple(r)) for r in df.select(*names).collect())
    assert ours == sorted(map(repr, result.fetchall()))


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])
def test_one_row_per_input(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    key = "page_id" if "page_id" in df.columns else "doc_id"
    given = spark.read.parquet(f"{sf_dir}/{'pages' if key == 'page_id' else 'documents'}.parquet")
    rows = df.collect()
    if name not in ("op3_packing", "op4_token_counts", "op13_spelling_variants"):
        assert len(rows) == given.count()
        assert {r[key] for r in rows} == {r[key] for r in given.select(key).collect()}


def words(text, pattern):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def kept_copies(docs):
    """One document of every group of near copies, by comparing all pairs."""
    sets = {}
    for doc_id, text in docs.items():
        w = words(text, r"[^\x20\x09-\x0D]+")
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in docs:
        for b in docs:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: t for i, t in docs.items() if find(i) == i}


def contaminated(text, items):
    w = words(text, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    grams = {n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for n in {len(next(iter(x))) for x in items if x}}
    return any(gram in grams[len(gram)] for x in items for gram in x)


def test_pipeline_same_as_plain_version(spark, sf_dir):
    docs, labels, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    net = quality.train(docs, labels, "quality", lambda c: quality.fold(c, 4) == 2)
    good = {r["doc_id"]: r["text"] for r in quality.score(docs, net).where("quality_score >= 0.7").collect()}
    kept = kept_copies(good)
    items = []
    for r in benchmark.collect():
        w = words(r["text"], r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        n = min(10, len(w))
        items.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set())
    clean = {i: t for i, t in kept.items() if not contaminated(t, items)}
    assert len(clean) < len(kept) < len(good) < docs.count()
    found = pii.find(spark.createDataFrame(list(clean.items()), "doc_id long, text string"))
    reference, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for r in found.select("doc_id", "text", "__pii_spans").collect():
        out, at = "", 0
        for s in r["__pii_spans"]:
            if s["start"] >= at:
                out += r["text"][at : s["start"]] + f"[{pii.KINDS[s['kind']].upper()}]"
            at = max(at, s["end"])
        ids = np.array([*reference.encode(out + (r["text"] or "")[at:], add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), 2048):
            piece = ids[start : start + 2048]
            expected[r["doc_id"], start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == expected


def test_stages_with_odd_and_empty_tables(spark, sf_dir, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
