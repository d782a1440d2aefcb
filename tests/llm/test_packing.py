import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer
from llm_fixtures import no_docs, odd_docs  # noqa: F401

from plumeledger.llm import packing
from plumeledger.llm.textbytes import SpanHasher, chunks, word_spans
from plumeledger.llm.wordbpe import WordBpe

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_spans_and_hashes():
    texts = [None, "", "ab c", "ab", "", " d ab", "é ab"]
    seen = {}
    for limit in (1, 3, 100):
        words = []
        for lo, hi, data, offsets in chunks(pa.array(texts), limit):
            starts, ends, runs = word_spans(data != 32, offsets)
            hashes = SpanHasher()(data, starts, ends)
            spelled = [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)]
            words += [spelled[runs[i] : runs[i + 1]] for i in range(hi - lo)]
            for word, h in zip(spelled, hashes.tolist(), strict=True):
                assert seen.setdefault(word, h) == h
        assert words == [(t or "").split() for t in texts]
    assert len(set(seen.values())) == len(seen)


def test_encoding_equals_the_tokenizer():
    rng = random.Random(3)
    simple = list("aB'sStTrReEvVmMlLdD ,.!?0129\n\t-<|>ÀÉßÿ×÷ñ ")
    signs = [*simple, "é", "́", "İ", "中", "\x1d", "\xa0", "<|endoftext|>", "'ll", "''s", "²"]
    texts = [None, "", " ", "'", "'s", "don't'll"]
    texts += ["".join(rng.choices(rng.choice([simple, signs]), k=rng.randint(0, 40))) for _ in range(1500)]
    reference, found = Tokenizer.from_file(PATH), []
    for lo, hi, ids, at in WordBpe(PATH, known_limit=500).encode(pa.array(texts), 1):
        found += [ids[at[i] : at[i + 1]].tolist() for i in range(hi - lo)]
    for text, ids in zip(texts, found, strict=True):
        assert ids == [*reference.encode(text or "", add_special_tokens=False).ids, 1], text


def first_fit(sizes, capacity):
    """First-fit decreasing by looking at all bins in turn."""
    room, out = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        k = next((k for k, r in enumerate(room) if r >= sizes[i]), len(room))
        if k == len(room):
            room.append(capacity)
        out[i] = (k, capacity - room[k])
        room[k] -= sizes[i]
    return [out[i] for i in range(len(sizes))]


def test_first_fit_decreasing():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 50, 333):
        sizes = [rng.randint(1, 100) for _ in range(n)]
        bins, offsets = packing.first_fit_decreasing(np.array(sizes, np.int64), 100)
        assert list(zip(bins.tolist(), offsets.tolist(), strict=True)) == first_fit(sizes, 100)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_every_id_once(spark, odd_docs, capacity):
    reference = Tokenizer.from_file(PATH)
    rows = packing.pack(odd_docs, PATH, capacity).collect()
    texts = {(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()}
    wanted = Counter()
    for doc_id, text in texts:
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(ids), capacity):
            piece = ids[start : start + capacity]
            wanted[doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1 + (doc_id == 6)
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == wanted
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= capacity


def test_sequences_hold_the_ids(spark, odd_docs):
    cut = packing.pieces(odd_docs, PATH, 64)
    staged = spark.createDataFrame(cut.collect(), cut.schema)
    held = packing.sequences(staged, packing.assign(staged, 64)).collect()
    assert sum(len(r["ids"]) for r in held) == sum(len(r["ids"]) for r in staged.collect())
    assert all(0 < len(r["ids"]) <= 64 * 4 for r in held)


def test_little_padding(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack(docs, PATH).collect()
    used = sum(r["length"] for r in rows)
    assert used / (2048 * len({r["sequence_id"] for r in rows})) > 0.97


def test_empty_table(no_docs):
    assert packing.pack(no_docs, PATH).collect() == []
