import re
from itertools import pairwise

import duckdb
import pytest
from pyspark.sql import functions as F
from llm_fixtures import no_docs, odd_docs  # noqa: F401

import corpus_pipeline
from plumeledger.llm import decontamination as d
from plumeledger.llm.oracle import ORACLE
from plumeledger.llm.queries import QUERIES
from plumeledger.llm.shared import Scratch

ITEMS = [
    (1, "the quick brown fox jumps over the lazy dog and then it sleeps"),
    (2, "Too short, but there"),
    (3, None),
    (4, " ... "),
    (None, "an item without id is never found here at all by anyone"),
    (1, "the quick brown fox jumps over the lazy dog and then it sleeps"),
    (10, "one two one two one two one two one two one two"),
]
TEXTS = [
    (1, "So THE QUICK-brown fox; jumps over the lazy dog and... left."),
    (2, "the quick brown fox jumps over the lazy dog"),
    (3, "too short but there, too short but there"),
    (4, None),
    (5, ""),
    (6, "one two one two one two one two one two one two one"),
    (7, "an item without id is never found here at all by anyone"),
    (8, "sleeps it then and dog lazy the over jumps fox"),
    (3, "nothing to see"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, size):
    out = []
    for doc_id, text in texts:
        w, hit, ids = words(text), set(), set()
        for item, phrase in items:
            v = words(phrase)
            n = min(size, len(v))
            if item is None or not n:
                continue
            for at in range(len(w) - n + 1):
                if any(w[at : at + n] == v[k : k + n] for k in range(len(v) - n + 1)):
                    hit |= set(range(at, at + n))
                    ids.add(item)
        out.append((doc_id, len(w), sorted(hit), sorted(ids)))
    return sorted(out, key=repr)


def found(df):
    rows = df.select("doc_id", "n_words", "spans", "items").collect()
    for r in rows:
        assert all(a["e"] < b["s"] for a, b in pairwise(r["spans"]))
    return sorted(
        ((r[0], r[1], [p for s in r[2] for p in range(s["s"], s["e"])], sorted(r[3])) for r in rows), key=repr
    )


def frames(spark, texts=TEXTS, items=ITEMS):
    return (
        spark.createDataFrame(texts, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


@pytest.mark.parametrize("group_bytes", [8 << 20, 60])
def test_same_as_brute_force(spark, group_bytes):
    docs, items = frames(spark)
    index = Scratch(spark, "t").stage(d.build_index(docs.repartition(2)))
    assert found(d.find_phrases(index, items, 10, group_bytes)) == brute(TEXTS, ITEMS, 10)
    assert found(d.find_phrases(index, items, 3, group_bytes)) == brute(TEXTS, ITEMS, 3)


def test_many_segments(spark, monkeypatch):
    monkeypatch.setattr(d, "_SEGMENT_BYTES", 40)
    docs, items = frames(spark)
    assert found(d.contamination(docs.coalesce(1), items)) == brute(TEXTS, ITEMS, 10)


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    docs, items = frames(spark)
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    every = [(1, "the same text is here twice for all"), (2, "word5 token5 word6 token6")]
    _, some = frames(spark, items=every)
    assert found(d.contamination(odd_docs, some)) == brute(rows, every, 10)
    assert d.contamination(no_docs, items).collect() == []
    assert all(r["items"] == [] for r in d.contamination(docs, items.limit(0)).collect())


def test_removal_is_by_row(spark, odd_docs):
    docs, items = frames(spark)
    kept = d.remove_contaminated(docs.withColumn("item_id", F.lit(1)), items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 5, 7, 8]
    assert kept.columns == ["doc_id", "text", "item_id"]
    assert d.remove_contaminated(odd_docs, items).count() == odd_docs.count()


def test_proximity(spark):
    texts = [(1, "rare a b common c seldom"), (2, "rare " + "x " * 30 + "seldom common"), (3, "seldom common rare")]
    docs, items = frames(spark, texts, [(1, "common rare seldom"), (2, "absent rare")])
    rows = d.find_proximity(d.build_index(docs), items, terms=3, within=6).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in rows) == [(1, 1), (3, 1)]


def test_items_without_id_count_in_query_and_pipeline(spark, tmp_path):
    docs, items = frames(spark, TEXTS[:-1] + [(9, "so the quick brown fox jumps over the lazy dog and never heard a word of it")])
    items = items.union(spark.sql("select null, 'the lazy dog and never heard a word of it at all'"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    engine = duckdb.connect()
    for table in ("documents", "benchmark"):
        engine.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    result = engine.execute(ORACLE["op2_decontamination"])
    names = [x[0] for x in result.description]
    df = QUERIES["op2_decontamination"](spark, str(tmp_path))
    ours = sorted(repr(tuple(r)) for r in df.select(*names).collect())
    assert ours == sorted(map(repr, result.fetchall()))
    assert {r["doc_id"] for r in df.where("contaminated").collect()} == {1, 3, 6, 7, 9}
    assert {r["doc_id"] for r in corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path)).collect()} == {2, 4, 5, 8}
    index = Scratch(spark, "t").stage(d.build_index(docs))
    one, many = (found_ids(d.find_phrases(index, items, 10, size, nameless=True)) for size in (8 << 20, 60))
    assert one == many and one[7] == [None] and one[9] == [1, None]


def found_ids(df):
    return {r["doc_id"]: sorted(r["items"], key=lambda i: (i is None, i or 0)) for r in df.collect()}
