"""Near-duplicate documents by MinHash, confirmed on full shingle sets.

1. Every text becomes the set of its distinct word shingles (64-bit hashes), a 128-bit
   fingerprint of the set, and the minima of many universal hash functions over it.
2. Documents with equal sets form one class, whatever their number; only classes go on.
3. Bands of minima put classes into buckets. Each bucket's smallest class leads it, and the
   candidate links are (leader, member): one per row, never all pairs of a bucket.
4. Candidates whose signatures agree enough are confirmed on the full sets, and alternating
   large-star and small-star steps turn confirmed links into components.
5. Members that are not linked to their leader may still be linked to each other. Groups of
   classes that share buckets, directly or by way of others, and are not one component yet
   are searched exhaustively on their full sets: the classes outside the group's largest
   component against all of the group, in blocks of bounded size. Only links that join
   components leave a block.

Two sets of similarity 0.8 share no band with probability (1 - 0.8**5) ** 40, about 1e-7;
every other step is exact. Nodes are 64-bit hashes of class fingerprints.

Defined results: null and blank texts have an empty set, are linked with nothing and keep
themselves; a text shorter than a shingle is one shingle; repeated rows are copies; a null
``doc_id`` never names a component unless all of its documents lack one; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import Scratch, fresh
from .textbytes import LOWER, SpanHasher, chunks, mix, word_spans

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_ROWS_PER_BLOCK = 1 << 15
#: A block of the exhaustive search holds about so many classes and shingles a side.
_BLOCK_CLASSES, _BLOCK_SHINGLES = 256, 500_000


class Shingles:
    """Distinct shingle hashes of the texts of an Arrow column."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.hash = SpanHasher()
        self.factor = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 62, words, dtype=np.uint64) * 2 + 1

    def sets(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Rows ``lo:hi``, their sorted distinct hashes one set after the other, and offsets."""
        for lo, hi, data, offsets in chunks(column):
            starts, ends, runs = word_spans(~_BLANK[data], offsets)
            word = self.hash(LOWER[data], starts, ends)
            n = max(0, len(word) - self.words + 1)
            rolled = np.zeros(n, np.uint64)
            for k in range(self.words):
                rolled += word[k : k + n] * self.factor[k]
            rolled = mix(rolled)
            sets = []
            for a, b in zip(runs[:-1].tolist(), runs[1:].tolist(), strict=True):
                if b - a >= self.words:
                    sets.append(np.unique(rolled[a : b - self.words + 1]))
                else:  # the whole sequence, marked by its length
                    short = np.full(min(1, b - a), b - a, np.uint64)
                    sets.append(mix(short + (word[a:b] * self.factor[: b - a]).sum(dtype=np.uint64)))
            sizes = np.array([len(s) for s in sets], np.int64)
            yield lo, hi, np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)])


def _minima(values: np.ndarray, offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of ``a * x + b`` (its upper half) over each non-empty set, for every ``a, b``."""
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), len(a)), np.uint32)
    full = np.flatnonzero(sizes)
    i = 0
    while i < len(full):
        start = offsets[full[i]]
        j = max(i + 1, int(np.searchsorted(offsets[full + 1], start + _ROWS_PER_BLOCK, "right")))
        rows = full[i:j]
        block = values[start : offsets[rows[-1] + 1]]
        at = offsets[rows] - start
        held = np.empty_like(block)
        for k in range(len(a)):
            np.multiply(block, a[k], out=held)
            held += b[k]
            out[rows, k] = np.minimum.reduceat(held, at) >> np.uint64(32)
        i = j
    return out


SIGNED = (
    "doc_id bigint, row_key long, n_shingles long, print_a long, print_b long, signature binary"
)


def _sign(words: int, hashes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = np.random.Generator(np.random.PCG64(5))
        a = random.integers(0, 1 << 63, hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        b = random.integers(0, 1 << 63, hashes, dtype=np.uint64)
        shingles = Shingles(words)
        for batch in batches:
            for lo, hi, values, offsets in shingles.sets(batch.column("text")):
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(x)]) for x in (values, mix(values ^ a[0]))]
                prints = [(s[offsets[1:]] - s[offsets[:-1]]).view(np.int64) for s in sums]
                signature = _minima(values, offsets, a, b)
                size = hashes * 4
                blob = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(size), hi - lo, [None, pa.py_buffer(signature)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        batch.column("row_key").slice(lo, hi - lo),
                        pa.array(np.diff(offsets)),
                        pa.array(prints[0]),
                        pa.array(prints[1]),
                        blob.cast(pa.binary()),
                    ],
                    names=["doc_id", "row_key", "n_shingles", "print_a", "print_b", "signature"],
                )

    return run


def _sets_of(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(words)
        for batch in batches:
            for lo, hi, values, offsets in shingles.sets(batch.column("text")):
                blob = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), hi - lo, [None, pa.py_buffer(offsets * 8), pa.py_buffer(values)]
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(lo, hi - lo), blob.cast(pa.binary())], names=["node", "shingles"]
                )

    return run


def _agree(least: float) -> Callable:
    """Candidates whose signatures agree in at least the share ``least`` of their minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                    for c in ("sign_a", "sign_b")
                )
                near = (a == b).mean(axis=1) >= least
                yield batch.select(["a", "b"]).filter(pa.array(near))

    return run


def _similar(percent: int) -> Callable:
    """Candidates whose full sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = np.sort(np.concatenate([x, y]), kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                near.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return run


def _link_blocks(percent: int) -> Callable:
    """Links between the left and the right classes of one block, fewest that join them."""

    def run(block: pd.DataFrame) -> pd.DataFrame:
        left, right = block[block["is_left"]], block[~block["is_left"]]
        parent = {c: c for c in block["root"]}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        sets = [np.frombuffer(s, np.uint64) for s in right["shingles"]]
        values = np.concatenate([*sets, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        sizes = np.array([len(s) for s in sets], np.int64)
        nodes, roots = right["node"].to_numpy(), right["root"].to_numpy()
        found = []
        for node, root, mine in zip(left["node"], left["root"], left["shingles"], strict=True):
            mine = np.frombuffer(mine, np.uint64)
            first = np.searchsorted(values, mine, "left")
            held = np.searchsorted(values, mine, "right") - first
            hits = np.arange(held.sum()) + np.repeat(first - np.cumsum(held) + held, held)
            shared = np.bincount(owner[hits], minlength=len(sets))
            near = (100 * shared >= percent * (len(mine) + sizes - shared)) & (roots != root)
            for k in np.flatnonzero(near):
                a, b = find(root), find(roots[k])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    found.append((node, nodes[k]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _contested(grouped: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links that the leaders missed, within groups of more than one component.

    ``grouped``: ``node, sg, root, n_shingles`` of all classes that share a bucket.
    """
    sizes = grouped.groupBy("sg", "root").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("w"))
    groups = (
        sizes.groupBy("sg")
        .agg(
            F.max(F.struct("c", "root"))["root"].alias("major"),
            (F.sum("c") - F.max("c")).alias("minors"),
            F.sum("c").alias("all"),
            F.sum("w").alias("weight"),
        )
        .where("minors > 0")
    )
    parts = lambda n: F.greatest(
        F.ceil(F.col(n) / _BLOCK_CLASSES), F.ceil(F.col("weight") / F.col("all") * F.col(n) / _BLOCK_SHINGLES)
    )
    # Written, so that the join with it is one that Spark can split where a group is hot.
    groups = scratch.stage(groups.select("sg", "major", parts("minors").alias("rows"), parts("all").alias("cols")))
    rows = grouped.join(groups, "sg").withColumn("hash", F.xxhash64("node"))
    left = rows.where("root <> major").select(
        "sg", "node", "root", F.lit(True).alias("is_left"),
        F.pmod("hash", "rows").alias("i"), F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"),
    )
    right = rows.select(
        "sg", "node", "root", F.lit(False).alias("is_left"),
        F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"), F.pmod("hash", "cols").alias("j"),
    )
    cast = lambda df: df.withColumns({"i": F.col("i").cast("long"), "j": F.col("j").cast("long")})
    blocks = cast(left).unionByName(cast(right)).join(sets, "node")
    return blocks.groupBy("sg", "i", "j").applyInPandas(_link_blocks(percent), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = 40,
    rows_per_band: int = 5,
    least_agreement: float = 0.64,
) -> DataFrame:
    """``doc_id, row_key, n_shingles, component_id, kept, first_copy`` for every document.

    ``kept`` holds the contract's rule (``doc_id`` names the component). ``row_key`` hashes
    ``doc_id`` and text; ``first_copy`` is the pair (``doc_id``, ``row_key``) that leads the
    component, for callers that must keep one row of it.

    ``least_agreement`` lies 5.6 standard deviations below the agreement to be expected at
    the threshold with 200 minima.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.withColumn("row_key", F.xxhash64("doc_id", "text"))
    signed = texts.mapInArrow(_sign(words, bands * rows_per_band), SIGNED)
    signed = scratch.stage(
        signed.withColumn("node", F.when(F.col("n_shingles") > 0, F.xxhash64("n_shingles", "print_a", "print_b")))
    )
    nodes = scratch.stage(
        signed.where("node is not null")
        .groupBy("node")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("lead"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
    )

    width = rows_per_band * 4
    keys = [F.xxhash64(F.lit(k), F.substring("signature", k * width + 1, width)) for k in range(bands)]
    banded = nodes.select("node", F.explode(F.array(*keys)).alias("key"))
    buckets = scratch.stage(
        banded.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("size")).where("size > 1").drop("size")
    )
    candidates = scratch.stage(
        banded.withColumnRenamed("node", "b").join(buckets, "key").where("a <> b").select("a", "b").distinct()
    )

    signs = nodes.select("node", "signature")
    signature_of = lambda end: signs.toDF(end, f"sign_{end}")
    agreeing = scratch.stage(
        candidates.join(signature_of("a"), "a").join(signature_of("b"), "b")
        .mapInArrow(_agree(least_agreement), "a long, b long")
    )
    involved = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).distinct()
    wanted = involved.join(nodes, "node").select("node", F.col("lead.row_key").alias("row_key"))
    sets = scratch.stage(
        texts.join(wanted, "row_key")
        .select("node", "text")
        .mapInArrow(_sets_of(words), "node long, shingles binary")
        .dropDuplicates(["node"])
    )
    set_of = lambda end: sets.toDF(end, f"set_{end}")
    links = scratch.stage(
        agreeing.join(set_of("b"), "b").join(set_of("a"), "a").mapInArrow(_similar(percent), "a long, b long")
    )

    groups = components(candidates, scratch).withColumnRenamed("root", "sg")
    linked = components(links, scratch)
    grouped = scratch.stage(
        groups.join(linked, "node", "left")
        .join(nodes.select("node", "n_shingles"), "node")
        .withColumn("root", F.coalesce("root", "node"))
    )
    more = scratch.stage(_contested(grouped, sets, percent, scratch))
    rooted = grouped.select(F.col("node").alias("a"), F.col("root").alias("b"))
    final = components(rooted.union(more), scratch)

    placed = nodes.select("node", "lead").join(final, "node", "left")
    placed = scratch.stage(placed.withColumn("root", F.coalesce("root", "node")))
    leads = scratch.stage(placed.groupBy("root").agg(F.min("lead").alias("first_copy")))
    placed = scratch.stage(placed.select("node", "root").join(leads, "root").select("node", "first_copy"))
    rows = signed.select("doc_id", "row_key", "n_shingles", "node")
    found = rows.join(placed, "node", "left")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    found = found.withColumn("first_copy", F.coalesce("first_copy", own))
    component = F.col("first_copy.doc_id")
    return found.select(
        "doc_id", "row_key", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), "first_copy",
    )


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The documents of ``docs``, all columns, with one row left of every component.

    Rows without words are linked with nothing and stay. Of rows that share ``doc_id`` and
    text the one with the smallest hash of its columns stays; the limit on their rank is
    applied in the map tasks already, so rows that are repeated very often are not gathered.
    """
    found = near_duplicates(docs, **settings)
    key, place = fresh(docs, "copy_key", "copy_rank")
    leads = found.where("n_shingles > 0").select(F.col("first_copy.row_key").alias(key)).distinct()
    hashed = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    blank = F.coalesce(~F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*plain)))
    single = docs.where(~blank).withColumn(key, hashed).withColumn(place, rank).where(F.col(place) == 1)
    chosen = single.join(leads, key, "left_semi").drop(key, place)
    return chosen.unionByName(docs.where(blank))
