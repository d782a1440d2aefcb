"""How far the sources of a language diverge, from term counts by chunk factorization.

1. In blocks of some MB of whole texts, every document's white-space chunks are counted. A
   block keeps the documents of every occurrence by distinct chunk, packed into one row.
2. The distinct chunks of all blocks are dealt into buckets by hash, packed a block and bucket
   a row. A bucket splits each globally distinct chunk into terms once and sends the terms
   back to the blocks that hold the chunk.
3. Per block, the occurrences of a term's chunks merge into its distinct documents and
   occurrences by source, and go to buckets by term, where the blocks are added up. Documents
   lie in one block only, so the sums are exact. Of a term, however common, a block sends one
   number a source.
4. Terms in enough documents of their language are kept, with shares of every source and of
   the whole language in parts of 1e9, rounded down.
5. Two sources of a language are compared by ``floor((p - q) ** 2 / q)`` summed over all kept
   terms: the terms are dealt into buckets and the sources into tiles, and a task holds the
   shares of one bucket in two tiles. Terms that occur in neither source of a pair have one
   value, which is added as often as there are such terms. A source is compared with its
   language term by term.

Occurrences are exact up to 9e15 in a language; values are exact 64-bit integers.

Defined results: null text, language and source are empty strings; every row of ``docs`` is
a document of its own, also where ``doc_id`` repeats or is null; a text without terms counts
as a document of its group, which has shares like any other; a language without kept terms
has pairs of value 0; ties are ordered by item; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch
from .textbytes import LOWER, SpanHasher, chunks, word_spans

SHARE = 1_000_000_000
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Letters, and every byte of a code point beyond ASCII.
_IN_TERM = np.zeros(256, bool)
_IN_TERM[65:91] = _IN_TERM[97:123] = _IN_TERM[128:] = True
#: A block holds about so many bytes of whole texts; one longer text is a block of its own.
BLOCK_BYTES = 12 << 20
#: Sources a side that a task compares, terms of a bucket, and terms compared at a time.
TILE, BUCKET_ROWS, _AT_A_TIME = 64, 200_000, 2048
#: Chunks of a bucket, counted once for every block that holds them.
BUCKET_CHUNKS = 400_000

# All lists are packed: a list column would be measured anew for every row sent to a task.
BLOCKS = (
    "block long, n_chunks long, chunks binary, ends binary, held binary, per_chunk binary, groups binary, of_doc binary"
)


def _spans_as_strings(data: np.ndarray, kept: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of kept bytes as strings; all kept bytes belong to some span."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    held = np.ascontiguousarray(data[kept])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(held))


def _binaries(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """``values[bounds[i] : bounds[i + 1]]`` as bytes, for every i."""
    size = values.dtype.itemsize
    blob = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64) * size), pa.py_buffer(values)]
    )
    return blob.cast(pa.binary())


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some strings without nulls, and the n + 1 offsets that bound them."""
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64, len(strings) + 1, strings.offset * 8)
    data = strings.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _strings(data: bytes, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(data))


def _unpacked(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _steps(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rising numbers as the steps between them, anew in each of the ranges: most are small,
    which shuffle files compress well."""
    steps = np.diff(values, prepend=values[:1])
    heads = bounds[:-1][bounds[1:] > bounds[:-1]]
    steps[heads] = values[heads]
    return steps.astype(np.uint32)


def _unstepped(column: pa.ChunkedArray) -> np.ndarray:
    rows = [np.cumsum(np.frombuffer(x, np.uint32), dtype=np.int64) for x in column.to_pylist()]
    return np.concatenate([*rows, np.zeros(0, np.int64)])


def _places(n_docs: int) -> type:
    """The type that numbers the documents of a block."""
    return np.uint16 if n_docs <= 1 << 16 else np.uint32


def _blocks(block_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text"), block_bytes):
                kept = ~_BLANK[data]
                starts, ends, runs = word_spans(kept, offsets)
                found = _spans_as_strings(data, kept, starts, ends).dictionary_encode()
                n = len(found.dictionary)
                code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                held = np.sort(code * (hi - lo) + np.repeat(np.arange(hi - lo), np.diff(runs)))
                per_chunk = np.bincount(held // (hi - lo), minlength=n).astype(np.uint32)
                pairs = list(zip(*(batch.column(c).slice(lo, hi - lo).to_pylist() for c in ("lang", "source")), strict=True))
                groups = {pair: k for k, pair in enumerate(dict.fromkeys(pairs))}
                of_doc = np.array([groups[pair] for pair in pairs], np.uint32)
                chunk_bytes, ends = _bytes_of(found.dictionary)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block]),
                        pa.array([n]),
                        pa.array([chunk_bytes.tobytes()], pa.binary()),
                        pa.array([np.diff(ends).astype(np.uint32).tobytes()]),
                        pa.array([(held % (hi - lo)).astype(_places(hi - lo)).tobytes()]),
                        pa.array([per_chunk.tobytes()]),
                        pa.array([json.dumps(list(groups)).encode()]),
                        pa.array([of_doc.tobytes()]),
                    ],
                    names=["block", "n_chunks", "chunks", "ends", "held", "per_chunk", "groups", "of_doc"],
                )
                block += 1

    return run


ASKED = "bucket long, block long, ids binary, sizes binary, chunks binary"
ANSWERS = "block long, ids binary, times binary, sizes binary, terms binary"


def _dealt(buckets: int) -> Callable:
    """The chunks of every block by bucket, with their numbers in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["chunks"], np.uint8)
                sizes = np.frombuffer(row["ends"], np.uint32).astype(np.int64)
                ends = np.cumsum(sizes)
                bucket = (hasher(data, ends - sizes, ends) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                moved, offsets = _bytes_of(_strings(row["chunks"], sizes).take(pa.array(order)))
                held, first = np.unique(bucket[order], return_index=True)
                bounds = np.append(first, len(order))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(held), pa.array(np.full(len(held), row["block"])),
                        _binaries(_steps(order, bounds), bounds), _binaries(sizes[order].astype(np.uint32), bounds),
                        _binaries(moved, offsets[bounds]),
                    ],
                    names=["bucket", "block", "ids", "sizes", "chunks"],
                )

    return run


def _split_chunks(rows: pa.Table) -> pa.Table:
    """The terms of one bucket's chunks, each distinct chunk split once, for every block."""
    sizes = _unpacked(rows["sizes"], np.uint32)
    ids = _unstepped(rows["ids"])
    chunk = _strings(b"".join(rows["chunks"].to_pylist()), sizes).dictionary_encode()
    data, offsets = _bytes_of(chunk.dictionary)
    data = LOWER[data]
    kept = _IN_TERM[data]
    starts, ends, runs = word_spans(kept, offsets)
    term = _spans_as_strings(data, kept, starts, ends).dictionary_encode()
    n = max(1, len(term.dictionary))
    # A chunk's terms, each once with its number.
    of_chunk = np.repeat(np.arange(len(runs) - 1), np.diff(runs))
    pairs, times = np.unique(of_chunk * n + term.indices.to_numpy(zero_copy_only=False), return_counts=True)
    bounds = np.searchsorted(pairs // n, np.arange(len(runs)))
    code = chunk.indices.to_numpy(zero_copy_only=False)
    per_id = np.diff(bounds)[code]
    at = np.arange(per_id.sum()) + np.repeat(bounds[code] - np.cumsum(per_id) + per_id, per_id)
    # Each row of the input, a block, becomes one of the output.
    per_row = np.array([len(x) // 4 for x in rows["ids"].to_pylist()], np.int64)
    ends_of_row = np.concatenate([[0], np.cumsum(per_id)])[np.concatenate([[0], np.cumsum(per_row)])]
    terms, offsets = _bytes_of(term.dictionary.take(pa.array(pairs[at] % n)))
    return pa.table(
        {
            "block": rows["block"],
            "ids": _binaries(_steps(np.repeat(ids, per_id), ends_of_row), ends_of_row),
            "times": _binaries(times[at].astype(np.uint32), ends_of_row),
            "sizes": _binaries(np.diff(offsets).astype(np.uint32), ends_of_row),
            "terms": _binaries(terms, offsets[ends_of_row]),
        }
    )


SUMMED = "bucket long, groups binary, codes binary, n_docs binary, n binary, per_term binary, sizes binary, terms binary"
COUNTED = "lang string, source string, term string, n_docs long, n long, n_lang long, first boolean"


def _merge_block(buckets: int) -> Callable:
    """Documents and occurrences by source of every term of one block, by bucket."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        named = rows.filter(rows["groups"].is_valid()).slice(0, 1)
        n_groups = len(json.loads(named["groups"][0].as_py()))
        of_doc = np.frombuffer(named["of_doc"][0].as_py(), np.uint32).astype(np.int64)
        rows = rows.filter(rows["terms"].is_valid())
        held = np.frombuffer(named["held"][0].as_py(), _places(len(of_doc)))
        per_chunk = np.frombuffer(named["per_chunk"][0].as_py(), np.uint32)
        bounds = np.concatenate([[0], np.cumsum(per_chunk, dtype=np.int64)])
        term = _strings(b"".join(rows["terms"].to_pylist()), _unpacked(rows["sizes"], np.uint32)).dictionary_encode()
        chunk = _unstepped(rows["ids"])
        first = bounds[chunk]
        sizes = bounds[chunk + 1] - first
        at = np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
        times = np.repeat(_unpacked(rows["times"], np.uint32), sizes)
        data, offsets = _bytes_of(term.dictionary)
        bucket = (SpanHasher()(data, offsets[:-1], offsets[1:]) % np.uint64(buckets)).astype(np.int64)
        # Terms are numbered by bucket.
        order = np.argsort(bucket, kind="stable")
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        code = np.repeat(number[term.indices.to_numpy(zero_copy_only=False)], sizes)
        # First by document, where several chunks may hold one term, then by group.
        pairs, at = np.unique(code * len(of_doc) + held[at], return_inverse=True)
        n = np.bincount(at, times).astype(np.int64)
        key = (pairs // len(of_doc)) * n_groups + of_doc[pairs % len(of_doc)]
        key, at, n_docs = np.unique(key, return_inverse=True, return_counts=True)
        n = np.bincount(at, n).astype(np.int64)
        terms, offsets = _bytes_of(term.dictionary.take(pa.array(order)))
        held, first = np.unique(bucket[order], return_index=True)
        of_term = np.append(first, len(order))
        of_entry = np.searchsorted(key // n_groups, of_term)
        per_term = np.bincount(key // n_groups, minlength=len(order))
        return pa.table(
            {
                "bucket": pa.array(held),
                "groups": pa.array([named["groups"][0].as_py()] * len(held), pa.binary()),
                "codes": _binaries((key % n_groups).astype(np.uint32), of_entry),
                "n_docs": _binaries(n_docs.astype(np.uint32), of_entry),
                "n": _binaries(n.astype(np.uint32), of_entry),
                "per_term": _binaries(per_term.astype(np.uint32), of_term),
                "sizes": _binaries(np.diff(offsets).astype(np.uint32), of_term),
                "terms": _binaries(terms, offsets[of_term]),
            }
        )

    return run


def _sum_blocks(least_docs: int) -> Callable:
    """Sums over all blocks of the terms of one bucket that enough documents of a language hold."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        names: dict[tuple[str, str], int] = {}
        known = [
            np.array([names.setdefault(tuple(g), len(names)) for g in json.loads(x)], np.int64)
            for x in rows["groups"].to_pylist()
        ]
        group = np.concatenate(
            [of[np.frombuffer(c, np.uint32)] for of, c in zip(known, rows["codes"].to_pylist(), strict=True)]
        )
        term = _strings(b"".join(rows["terms"].to_pylist()), _unpacked(rows["sizes"], np.uint32)).dictionary_encode()
        code = np.repeat(term.indices.to_numpy(zero_copy_only=False).astype(np.int64), _unpacked(rows["per_term"], np.uint32))
        key, at = np.unique(code * len(names) + group, return_inverse=True)
        summed = lambda c, at, size: np.bincount(at, c, size).astype(np.int64)
        n_docs, n = (summed(_unpacked(rows[c], np.uint32), at, len(key)) for c in ("n_docs", "n"))
        langs = {lang: k for k, lang in enumerate(dict.fromkeys(lang for lang, _ in names))}
        of_lang = np.array([langs[lang] for lang, _ in names], np.int64)
        code, group = key // len(names), key % len(names)
        _, first, at = np.unique(code * len(langs) + of_lang[group], return_index=True, return_inverse=True)
        n_lang = summed(n, at, len(first))[at]
        enough = np.flatnonzero(summed(n_docs, at, len(first))[at] >= least_docs)
        lang, source = (pa.array([g[k] for g in names], pa.string()) for k in (0, 1))
        place = pa.array(group[enough])
        return pa.table(
            {
                "lang": lang.take(place),
                "source": source.take(place),
                "term": term.dictionary.take(pa.array(code[enough])).cast(pa.string()),
                "n_docs": n_docs[enough],
                "n": n[enough],
                "n_lang": n_lang[enough],
                "first": pa.array(np.isin(enough, first)),
            }
        )

    return run


def _read(docs: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(text("lang"), text("source"), text("text"))


def term_counts(docs: DataFrame, least_docs: int = 1, scratch: Scratch | None = None) -> DataFrame:
    """``lang, source, term, n_docs, n, n_lang, first`` of every term in at least ``least_docs``
    documents of a language: distinct documents and occurrences in the source, occurrences in
    the language. ``first`` marks one source of every term and language."""
    scratch = scratch or Scratch(docs.sparkSession, "divergence", free=True)
    blocks = scratch.stage(_read(docs).mapInArrow(_blocks(BLOCK_BYTES), BLOCKS))
    buckets = max(8, -(-(blocks.agg(F.sum("n_chunks")).first()[0] or 0) // BUCKET_CHUNKS))
    asked = blocks.select("block", "chunks", "ends").mapInArrow(_dealt(buckets), ASKED)
    answers = asked.groupBy("bucket").applyInArrow(_split_chunks, ANSWERS)
    kept = ["held", "per_chunk", "groups", "of_doc"]
    none = lambda names: [F.lit(None).cast("binary").alias(c) for c in names]
    packed = ["ids", "times", "sizes", "terms"]
    whole = answers.select("block", *packed, *none(kept)).union(blocks.select("block", *none(packed), *kept))
    merged = scratch.stage(whole.groupBy("block").applyInArrow(_merge_block(buckets), SUMMED))
    scratch.drop(blocks)
    return merged.groupBy("bucket").applyInArrow(_sum_blocks(least_docs), COUNTED)


def _share(n: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SHARE * (n + 1) / (total + kept))``, three digits at a time: in one step the
    product would pass 64 bits at 1e10 occurrences."""
    divisor = total + kept
    done, rest = F.lit(0).cast("long"), n + 1
    for _ in range(3):
        rest = rest * 1000
        done = done * 1000 + F.call_function("div", rest, divisor)
        rest = rest % divisor
    return done + 1


def _step(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _compare(rows: pa.Table) -> pa.Table:
    """Sums over one bucket of terms, less those of terms that occur in neither source.

    ``rows``: ``side`` (0 or 1), ``source`` number, ``p`` of a term, ``p0`` of an absent term. A
    tile that is compared with itself has one side only.
    """
    lang, columns = rows["lang"][0].as_py(), {}
    term = rows["term"].combine_chunks().dictionary_encode()
    code = term.indices.to_numpy(zero_copy_only=False)
    side, source, p, p0 = (rows[c].to_numpy() for c in ("side", "source", "p", "p0"))
    tables = []
    for k in (0, 1) if (side == 1).any() else (0, 0):
        mine = side == k
        of, first, at = np.unique(source[mine], return_index=True, return_inverse=True)
        tables.append((of, p0[mine][first], code[mine], at, p[mine]))
    (left, left0, *a), (right, right0, *b) = tables
    sums = np.zeros((len(left), len(right)), np.int64)
    # Terms of one source each are ordered by code, so a range of them is a slice.
    order = [np.argsort(x[0], kind="stable") for x in (a, b)]
    a, b = ([c[o] for c in x] for x, o in zip((a, b), order, strict=True))
    none = np.array([[(x - y) ** 2 // y for y in right0.tolist()] for x in left0.tolist()], np.int64).reshape(sums.shape)
    for lo in range(0, len(term.dictionary), _AT_A_TIME):
        hi = min(lo + _AT_A_TIME, len(term.dictionary))
        dense = []
        for x, absent in ((a, left0), (b, right0)):
            grid = np.repeat(absent[None, :], hi - lo, axis=0)
            i, j = np.searchsorted(x[0], [lo, hi])
            grid[x[0][i:j] - lo, x[1][i:j]] = x[2][i:j]
            dense.append(grid)
        for s in range(len(left)):
            gap = dense[0][:, s, None] - dense[1]
            sums[s] += (gap * gap // dense[1]).sum(0) - (hi - lo) * none[s]
    columns["lang"] = pa.array([lang] * sums.size, pa.string())
    columns["a"] = pa.array(np.repeat(left, len(right)))
    columns["b"] = pa.array(np.tile(right, len(left)))
    columns["value"] = pa.array(sums.ravel())
    return pa.table(columns)


def audit(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: every other source of the language and how far its shares lie from this
    source's. Part ``term``: the ``top`` terms that this source uses more than its language.
    """
    scratch = Scratch(docs.sparkSession, "divergence", free=True)
    # Written: the counts are read for the language, for the sources and for the pairs.
    used = scratch.stage(term_counts(docs, least_docs, scratch).drop("n_docs"))
    langs = used.where("first").groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n_lang").alias("all_lang"))
    groups = _read(docs).select("lang", "source").distinct()
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("all_source"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    groups = groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.select("lang", "source", zero("kept"), zero("all_lang"), zero("all_source"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    absent = F.when(F.col("kept") > 0, _share(F.lit(0).cast("long"), F.col("all_source"), F.col("kept")))
    groups = scratch.stage(groups.withColumn("place", place.cast("long")).withColumn("p0", absent))

    shares = used.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "place", "p0",
        _share(F.col("n"), F.col("all_source"), F.col("kept")).alias("p"),
        _share(F.col("n_lang"), F.col("all_lang"), F.col("kept")).alias("q"),
    )
    shares = scratch.stage(shares)
    terms = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _step(F.col("p"), F.col("q")).alias("value")
    )

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    n = shares.count()
    bucket = F.pmod(F.xxhash64("term"), F.lit(max(8, -(-n // BUCKET_ROWS))))
    tiles = groups.groupBy("lang").agg(F.floor(F.max("place") / TILE).alias("last"))
    tile = F.floor(F.col("place") / TILE)
    dealt = shares.join(tiles, "lang").withColumn("bucket", bucket)
    fixed = ["lang", "bucket", "term", F.col("place").alias("source"), "p", "p0"]
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    left = dealt.select(*fixed, F.lit(0).alias("side"), tile.alias("i"), every.alias("j"))
    right = dealt.select(*fixed, F.lit(1).alias("side"), tile.alias("j"), every.alias("i"))
    # Sources without any kept term in a bucket still meet all sources there: one row each,
    # of a term that no text holds.
    blank = groups.where("kept > 0").join(tiles, "lang").withColumn("p", F.col("p0")).withColumn("term", F.lit(" "))
    buckets = F.sequence(F.lit(0).cast("long"), F.lit(max(8, -(-n // BUCKET_ROWS)) - 1).cast("long"))
    blank = blank.withColumn("bucket", F.explode(buckets))
    left = left.union(blank.select(*fixed, F.lit(0).alias("side"), tile.alias("i"), every.alias("j")))
    right = right.union(blank.select(*fixed, F.lit(1).alias("side"), tile.alias("j"), every.alias("i")))
    sums = left.unionByName(right.where("i <> j")).groupBy("lang", "bucket", "i", "j")
    sums = sums.applyInArrow(_compare, "lang string, a long, b long, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("beyond"))

    a = groups.select("lang", "source", F.col("place").alias("a"), F.col("p0").alias("p"), "kept")
    b = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("b"), F.col("p0").alias("q"))
    pairs = a.join(b, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    value = F.coalesce(F.col("kept") * _step(F.col("p"), F.col("q")) + F.col("beyond"), F.lit(0).cast("long"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(terms)
