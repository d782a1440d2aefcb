import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from llm_fixtures import odd_docs  # noqa: F401

from plumeledger.llm import token_counts as t

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def brute(ends, bounds, rule):
    n, start = len(bounds) - 1, 0
    tokens, crossing = [0.0] * n, [0] * n
    for end in ends:
        overlap = [max(0, min(end, bounds[k + 1]) - max(start, bounds[k])) for k in range(n)]
        touched = [k for k in range(n) if overlap[k]]
        for k in touched if len(touched) > 1 else ():
            crossing[k] += 1
        chosen = {"first": touched[0], "last": touched[-1], "most": max(touched, key=lambda k: (overlap[k], -k))}
        for k in touched:
            tokens[k] += overlap[k] / (end - start) if rule == "split" else k == chosen[rule]
        start = end
    return tokens, crossing


@pytest.mark.parametrize("rule", t.RULES)
def test_attribution(rule):
    rng = random.Random(1)
    for _ in range(400):
        ends = np.cumsum([rng.randint(1, 5) for _ in range(rng.randint(1, 20))])
        size = int(ends[-1])
        inner = sorted(rng.sample(range(1, size), min(size - 1, rng.randint(0, 8)))) if size > 1 else []
        bounds = np.array([0, *inner, size])
        tokens, crossing = t.attribute(ends, bounds, rule)
        expected = brute(ends.tolist(), bounds.tolist(), rule)
        assert np.allclose(tokens, expected[0]) and list(crossing) == expected[1]


@pytest.mark.parametrize("rule", ["most", "split"])
def test_lines_add_up(spark, odd_docs, rule):
    tokenizer, _ = t.encoder(PATH, public_tokenizers.PATTERN)
    docs = odd_docs.withColumn("text", F.replace("text", F.lit("here"), F.lit("\n\nhere\n")))
    rows = t.count(docs.drop("section"), PATH, public_tokenizers.PATTERN, rule).collect()
    texts = docs.select("doc_id", "text").collect()
    total = sum(len(tokenizer.encode_ordinary(r["text"] or "")) for r in texts)
    assert sum(r["n_tokens"] for r in rows) == pytest.approx(total)
    lines = {r["text"].count("\n") + (not r["text"].endswith("\n")) for r in texts if r["doc_id"] == 7}
    assert {len([r for r in rows if r["doc_id"] == 7])} == lines
    assert not [r for r in rows if r["doc_id"] in (1, 2)]
    assert t.count(docs.limit(0), PATH, public_tokenizers.PATTERN).collect() == []


def test_sections(spark):
    df = spark.createDataFrame([(1, "Título", None), (2, "a", "body text é"), (3, "x", "")], "doc_id long, title string, body string")
    rows = t.count(t.fields(df, ["title", "body"]), PATH, public_tokenizers.PATTERN).orderBy("doc_id", "start").collect()
    assert [(r["doc_id"], r["name"], r["start"], r["end"]) for r in rows] == [
        (1, "title", 0, 6), (1, None, 6, 7), (1, "body", 7, 7),
        (2, "title", 0, 1), (2, None, 1, 2), (2, "body", 2, 13),
        (3, "title", 0, 1), (3, None, 1, 2), (3, "body", 2, 2),
    ]
    assert all(r["n_tokens"] == 0 for r in rows if r["start"] == r["end"])
    wrong = df.select("doc_id", F.lit("abc def").alias("text"), F.expr("array(named_struct('name', 'a', 'start', 0, 'end', 4), named_struct('name', 'b', 'start', 2, 'end', 5))").alias("sections"))
    with pytest.raises(Exception, match="must not overlap"):
        t.count(wrong, PATH, public_tokenizers.PATTERN).collect()
    with pytest.raises(ValueError, match="rule"):
        t.count(df, PATH, public_tokenizers.PATTERN, "none")


def test_lines_of_whole_table_same_as_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    tokenizer, size = t.encoder(PATH, public_tokenizers.PATTERN)
    expected = set()
    for r in docs.collect():
        raw = (r["text"] or "").encode()
        if not raw:
            continue
        pieces = r["text"].split("\n")
        texts = [p + "\n" for p in pieces[:-1]] + [pieces[-1]]
        bounds, chars = [0], [0]
        for x in texts:
            bounds.append(bounds[-1] + len(x.encode()))
            chars.append(chars[-1] + len(x))
        ends = np.cumsum(size[tokenizer.encode_ordinary(r["text"])]).tolist()
        tokens, crossing = brute(ends, bounds, "most")
        for k in range(len(texts)):
            expected.add((r["doc_id"], k, "line", chars[k], chars[k + 1], tokens[k], crossing[k]))
    rows = t.count(docs, PATH, public_tokenizers.PATTERN, "most").drop("row").collect()
    assert {tuple(r) for r in rows} == expected and len(rows) == len(expected)


def test_time_grows_with_the_number_of_lines(spark):
    seconds = {}
    for n in (100, 50_000, 200_000):
        df = spark.createDataFrame([(1, "a line\n" * n)], "doc_id long, text string")
        start = time.perf_counter()
        assert t.count(df, PATH, public_tokenizers.PATTERN).count() == n + 1
        seconds[n] = time.perf_counter() - start
    assert seconds[200_000] < 5 * seconds[50_000] + 1
