import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from llm_fixtures import no_docs, odd_docs  # noqa: F401

from plumeledger.llm import language_id, quality
from plumeledger.llm.textbytes import SpanHasher, text_buffer


def test_codewords():
    for k in range(1, 41):
        code = language_id.codewords(k)
        assert code.shape[0] == k and set(np.unique(code)) <= {-1, 1}
        if k > 1:
            assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= max(1, code.shape[1] // 4)
            assert not any((column == column[0]).all() for column in code.T)


@pytest.mark.parametrize("k", [8, 9, 40])
def test_many_languages(spark, k):
    rng = np.random.default_rng(k)
    alphabets = [rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 9, replace=False) for _ in range(k)]
    rows = []
    for i in range(k * 24):
        words = ("".join(rng.choice(alphabets[i % k], rng.integers(2, 8))) for _ in range(80))
        rows.append((i, " ".join(words), f"l{i % k:02}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held_out = lambda c: F.col(c) >= k * 16
    model = language_id.train(docs, held_out)
    found = language_id.predict(docs, model).where(held_out("doc_id")).select("doc_id", "lang_pred", "score").collect()
    assert len(found) == 8 * k and not any(np.isnan(r["score"]) for r in found)
    assert sum(r["lang_pred"] == rows[r["doc_id"]][2] for r in found) >= 0.95 * len(found)


def test_grams_are_those_of_each_text():
    texts = ["Ab  c!", "", "é", "ab c", None, "123"]
    data, offsets = text_buffer(pa.array(texts))
    buckets, bounds = language_id.grams(data, offsets)
    for i, text in enumerate(texts):
        alone, _ = language_id.grams(*text_buffer(pa.array([text])))
        assert buckets[bounds[i] : bounds[i + 1]].tolist() == alone.tolist()
    assert bounds[1] - bounds[0] >= bounds[4] - bounds[3]


def test_languages_held_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = lambda c: quality.fold(c, 3) == 1
    model = language_id.train(docs, held_out)
    assert model.languages == ["de", "en", "es", "fr"]
    joined = language_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(held_out("doc_id"))
    right, n = joined.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * n and n > 30
    assert joined.where("score < 0 or score > 1").isEmpty()


def test_languages_of_odd_tables(spark, odd_docs, no_docs):
    none_held = lambda c: F.lit(False)
    model = language_id.train(odd_docs, none_held)
    assert model.languages == ["de", "en", "fr"]
    rows = {r["doc_id"]: r for r in language_id.predict(odd_docs, model).collect() if r["doc_id"] is not None}
    assert [rows[i]["lang_pred"] for i in (1, 2, 3, 8)] == ["und"] * 4 and rows[1]["score"] == 0
    assert rows[4]["lang_pred"] == "en"
    empty = language_id.train(no_docs, none_held)
    assert {r["lang_pred"] for r in language_id.predict(odd_docs, empty).collect()} == {"und"}
    assert language_id.predict(no_docs, model).collect() == []
    one = language_id.train(odd_docs.where("lang = 'de'"), none_held)
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(odd_docs.where("doc_id = 5"), one).collect()} == {("de", 1.0)}


def test_language_does_not_depend_on_the_label(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = lambda c: quality.fold(c, 3) == 1
    hidden = docs.withColumn("lang", F.when(~held_out("doc_id"), F.col("lang")))
    a, b = (language_id.predict(x, language_id.train(x, held_out)) for x in (docs, hidden))
    assert a.exceptAll(b).isEmpty()


def test_gradient():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(n, 5)) for n in (1, 3, 2)]
    y = np.array([1.0, 0.0, 1.0])
    net = quality.fit(bags, y, width=4, gates=3, epochs=1)
    x, bounds = np.concatenate(bags), np.array([0, 1, 4, 6])

    def loss():
        p = net.forward(x, bounds)["score"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, slope in net.gradient(x, bounds, y).items():
        flat = np.atleast_1d(net.w[name]).reshape(-1).copy()
        for k in range(min(4, len(flat))):
            ends = []
            for step in (1e-5, -1e-5):
                moved = flat.copy()
                moved[k] += step
                net.w[name] = moved.reshape(np.shape(slope))
                ends.append(loss())
            net.w[name] = flat.reshape(np.shape(slope))
            assert (ends[0] - ends[1]) / 2e-5 == pytest.approx(np.atleast_1d(slope).reshape(-1)[k], abs=1e-6)


def test_passages_do_not_depend_on_neighbours():
    texts = [None, "a b, c!", "", " \n", "UP " * 200, "é é ü 1 2"]
    hasher = SpanHasher()
    x, bounds = quality.passages(hasher, *text_buffer(pa.array(texts)))
    for i, text in enumerate(texts):
        alone, _ = quality.passages(hasher, *text_buffer(pa.array([text])))
        assert np.array_equal(x[bounds[i] : bounds[i + 1]], alone)
    assert np.diff(bounds).tolist() == [1, 1, 1, 1, 4, 1] and not x[0].any()


def test_quality_fit_reads_all_passages(monkeypatch):
    text = " ".join(f"word{i}" for i in range(64 * 70)) + " JUNK" * 64 + " more words" * (32 * 29)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "label": [0.0, 1.0], "text": [text, "short"]})
    bags = [np.frombuffer(b, np.float32).reshape(-1, quality.N_FEATURES) for b in next(quality._sample_features(iter([batch])))[2].to_pylist()]
    x, bounds = quality.passages(SpanHasher(), *text_buffer(batch.column("text")))
    assert np.array_equal(np.concatenate(bags), x) and [len(b) for b in bags] == np.diff(bounds).tolist() == [100, 1]
    whole = quality.fit(bags * 5, np.array([0.0, 1.0] * 5), epochs=2)
    monkeypatch.setattr(quality, "BATCH_PASSAGES", 150)
    parts = quality.fit(bags * 5, np.array([0.0, 1.0] * 5), epochs=2)
    assert all(np.allclose(whole.w[k], parts.w[k], atol=1e-9) for k in whole.w)


def test_quality_held_out(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held_out = lambda c: quality.fold(c, 4) == 2
    net = quality.train(docs, labels, "quality", held_out)
    joined = quality.score(docs.select("doc_id", "text"), net).join(labels, "doc_id").where(held_out("doc_id"))
    rows = joined.select("quality_score", "quality").collect()
    assert len(rows) > 10
    assert sum((r[0] >= 0.7) == r[1] for r in rows) >= 0.9 * len(rows)


def test_quality_of_odd_tables(spark, odd_docs, no_docs):
    none_held = lambda c: F.lit(False)
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (6, 0), (6, 0), (None, 1), (7, None), (99, 1), (1, 0)], "doc_id long, quality int")
    docs = odd_docs.drop("quality_score", "label")
    net = quality.train(docs, labels, "quality", none_held)
    rows = quality.score(docs, net).collect()
    assert len(rows) == docs.count() and all(0 <= r["quality_score"] <= 1 for r in rows)
    assert len({r["quality_score"] for r in rows if r["doc_id"] in (1, 2, 3)}) == 1
    assert quality.train(docs, labels.limit(0), "quality", none_held) is None
    assert {r["quality_score"] for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(no_docs, net, "other").collect() == []
    with pytest.raises(ValueError, match="already"):
        quality.score(odd_docs, net)
