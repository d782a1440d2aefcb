"""Spelling variants of words, by a trie over frequency vectors.

The vector of a word counts its letters in ``GROUPS`` groups of letters. One inserted, deleted
or replaced letter raises at most one count and lowers at most one count, each by one: a
surplus and a deficit budget of one each.

1. Distinct words are counted over all texts.
2. The first ``depth`` counts are the upper levels of the trie. A word is stored in the node
   they name, and sent as a query to all nodes that the budgets reach from it; to spare half
   of them, only to nodes whose first different count is larger. ``depth`` is the smallest at
   which no node holds more than ``NODE_WORDS`` words, so it follows the vocabulary.
3. Nodes are dealt into shards. A task arranges the words of its shard in a trie over all
   counts and walks it depth first, carrying all queries that still have budget for the node
   they are in. The words of a leaf are compared with its queries letter by letter.
4. Each word keeps the number of its near words and the most frequent of them. A form is
   followed to its last form by doubling the steps.

Words of one vector are compared with each other in blocks of bounded size.

Defined results: null and empty texts have no words; a null ``doc_id`` stands for an empty
one; repeated rows count as often as they occur; ties among near words go to the smallest
word in code-point order; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .textbytes import mix

LEAST_LETTERS, LEAST_COUNT, TIMES = 7, 2, 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Groups of about equal use in European languages, the commonest first; all other letters
#: are the last group.
GROUPS = ("ex", "nz", "tw", "iy", "hm", "aj", "rb", "og", "sd", "lk", "uv", "cp", "féq")
NODE_WORDS, SHARD_WORDS = 20_000, 20_000
#: Pairs of words whose letters are compared at a time.
_PAIRS = 1 << 18


def damaged(doc_id: object, run: object, every: int) -> object:
    """The run (a column) without one code point, if ``every`` divides the hash of id and run."""
    size = F.char_length(run)
    hashed = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (hashed % size).cast("int")
    cut = F.concat(F.left(run, at), F.substr(run, at + 2))
    return F.when(hashed % every == 0, cut).otherwise(run)


def word_counts(docs: DataFrame, every: int = 0) -> DataFrame:
    """``word, n`` of all words of at least ``LEAST_LETTERS`` letters and ``LEAST_COUNT``
    occurrences. ``every`` plants an error in one of so many words."""
    # A run may lose one letter, but never gains one.
    pattern = F.lit(rf"[A-Za-zÀ-ÿ]{{{LEAST_LETTERS},}}")
    runs = F.regexp_extract_all(F.col("text").cast("string"), pattern, F.lit(0))
    found = docs.select("doc_id", F.explode(runs).alias("run"))
    run = F.translate("run", _UPPER, _LOWER)
    word = damaged(F.col("doc_id"), run, every) if every else run
    found = found.select(word.alias("word")).where(F.char_length("word") >= LEAST_LETTERS)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _group_of_byte() -> np.ndarray:
    out = np.full(256, len(GROUPS), np.int64)
    for k, letters in enumerate(GROUPS):
        out[list(letters.encode("latin-1"))] = k
    return out


_GROUP = _group_of_byte()


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Latin-1 letters of all words, one after the other, and the n + 1 bounds."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in raw])]).astype(np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), bounds


def vectors(words: pa.Array) -> np.ndarray:
    """Counts of every word's letters by group."""
    letters, bounds = _letters(words)
    n, width = len(words), len(GROUPS) + 1
    of = np.repeat(np.arange(n), np.diff(bounds))
    return np.bincount(of * width + _GROUP[letters], minlength=n * width).reshape(n, width)


def _distinct(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows, in no order, and which of them each row is. Rows are grouped by a
    hash, and by themselves if two that differ should share one."""
    factor = np.random.Generator(np.random.PCG64(17)).integers(1, 1 << 62, counts.shape[1], dtype=np.int64)
    _, first, of_row = np.unique(mix((counts * factor).sum(1).view(np.uint64)), return_index=True, return_inverse=True)
    if (counts[first][of_row] == counts).all():
        return counts[first], of_row
    return np.unique(counts, axis=0, return_inverse=True)


VECTOR = "word string, n long, counts array<int>"


def _with_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = vectors(batch.column("word")).astype(np.int32)
        bounds = np.arange(len(counts) + 1, dtype=np.int32) * (len(GROUPS) + 1)
        lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(counts.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), lists], names=["word", "n", "counts"])


def _reached(depth: int) -> np.ndarray:
    """Changes of the first counts that the budgets allow, whose first one is a surplus."""
    unit = np.eye(depth, dtype=np.int32)
    up = [unit[i] for i in range(depth)]
    # A deficit at an earlier level than the surplus would make the node a smaller one; a
    # deficit alone is the other word's surplus.
    both = [unit[i] - unit[j] for i in range(depth) for j in range(i + 1, depth)]
    return np.array([np.zeros(depth, np.int32), *up, *both])


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of letters differ by exactly one insertion, deletion or replacement."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    # The shorter one is the longer one without a letter: a common start and end cover it.
    width = a.shape[1]
    start = np.where((a != b[:, :-1]).any(1), (a != b[:, :-1]).argmax(1), width)
    end = np.where((a != b[:, 1:]).any(1), (a != b[:, 1:])[:, ::-1].argmax(1), width)
    return start + end >= width


class FrequencyTrie:
    """Distinct vectors of some words, sorted, so that a node is a range of them."""

    def __init__(self, counts: np.ndarray) -> None:
        self.vectors, of_word = np.unique(counts, axis=0, return_inverse=True)
        self.words = np.argsort(of_word, kind="stable")
        self.bounds = np.searchsorted(of_word[self.words], np.arange(len(self.vectors) + 1))

    def search(self, queries: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Every leaf with the queries that reach it: those whose vector is smaller, or equal."""
        width = queries.shape[1]
        n = len(queries)
        everything = np.arange(n), np.zeros(n, bool), np.zeros(n, bool)
        stack = [(0, 0, len(self.vectors), *everything)]
        while stack:
            level, lo, hi, at, surplus, deficit = stack.pop()
            if level == width:
                yield lo, at
                continue
            column = self.vectors[lo:hi, level]
            heads = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]]))
            ends = np.append(heads[1:], hi - lo)
            gap_to = queries[at, level]
            for head, end in zip(heads.tolist(), ends.tolist(), strict=True):
                gap = int(column[head]) - gap_to
                # The first change must be a surplus: the other order is the other word's search.
                live = (gap == 0) | ((gap == 1) & ~surplus) | ((gap == -1) & ~deficit & surplus)
                if live.any():
                    gap = gap[live]
                    stack.append(
                        (level + 1, lo + head, lo + end, at[live], surplus[live] | (gap == 1), deficit[live] | (gap == -1))
                    )


BEST = "word string, n_near long, near_n long, near string"


def _search_shard(rows: pa.Table) -> pa.Table:
    """Near words within one shard: number, and the most frequent one, of every word met."""
    rows = rows.combine_chunks()
    stored = rows["stored"].to_numpy(zero_copy_only=False).astype(bool)
    # All words of the shard are queries; those sent by several nodes are here once.
    words = rows["word"].chunk(0)
    n = rows["n"].to_numpy()
    letters, bounds = _letters(words)
    sizes = np.diff(bounds)
    counts = vectors(words)
    place = np.flatnonzero(stored)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if len(place):
        trie = FrequencyTrie(counts[place])
        by_vector, of_word = _distinct(counts)
        order = np.argsort(of_word, kind="stable")
        first = np.searchsorted(of_word[order], np.arange(len(by_vector) + 1))
        for leaf, at in trie.search(by_vector):
            held = place[trie.words[trie.bounds[leaf] : trie.bounds[leaf + 1]]]
            same = trie.vectors[leaf]
            asked = np.concatenate([order[first[k] : first[k + 1]] for k in at.tolist()])
            equal = (by_vector[of_word[asked]] == same).all(1)
            step = max(1, _PAIRS // len(held))
            for lo in range(0, len(asked), step):
                q, r = np.repeat(asked[lo : lo + step], len(held)), np.tile(held, len(asked[lo : lo + step]))
                twice = ~np.repeat(equal[lo : lo + step], len(held))
                for size in np.unique(sizes[q]):
                    some = np.flatnonzero(sizes[q] == size)
                    x = letters[bounds[q[some], None] + np.arange(size)]
                    y = letters[bounds[r[some], None] + np.arange(sizes[held[0]])]
                    near = some[_near(x, y)]
                    found.append((q[near], r[near]))
                    both = near[twice[near]]
                    found.append((r[both], q[both]))
    word = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.int64)
    near = np.concatenate([x for _, x in found]) if found else np.zeros(0, np.int64)
    # Per word the most frequent near word, of several the smallest.
    met, at = np.unique(near, return_inverse=True)
    rank = np.empty(len(met), np.int64)
    rank[pc.sort_indices(words.take(pa.array(met))).to_numpy()] = np.arange(len(met))
    order = np.lexsort((rank[at], -n[near], word))
    word, near = word[order], near[order]
    head = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else word
    return pa.table(
        {
            "word": words.take(pa.array(word[head])),
            "n_near": np.diff(np.append(head, len(word))).astype(np.int64),
            "near_n": n[near[head]],
            "near": words.take(pa.array(near[head])),
        }
    )


def near_words(counted: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, n_near, near_n, near`` of every word of ``counted`` that has near words.

    ``counted`` must be a written table of distinct words of Latin-1 letters.
    """
    vectored = scratch.stage(counted.mapInArrow(_with_vectors, VECTOR))
    total = vectored.count()
    depth, largest = 0, total
    while largest > NODE_WORDS and depth <= len(GROUPS):
        depth += 1
        node = vectored.groupBy(F.slice("counts", 1, depth).alias("node")).agg(F.count("*").alias("n"))
        largest = node.agg(F.max("n")).first()[0]
    shards = max(1, -(-total // SHARD_WORDS))
    shard = lambda node: F.pmod(F.xxhash64(node), F.lit(shards))
    if depth:
        steps = F.array(*[F.array(*map(F.lit, step)) for step in _reached(depth).tolist()])
        node = F.slice("counts", 1, depth)
        nodes = F.transform(steps, lambda step: F.zip_with(node, step, lambda x, y: x + y))
        own = shard(node)
    else:
        nodes, own = F.array(F.array(F.lit(0))), shard(F.array(F.lit(0)))
    to = F.explode(F.array_distinct(F.transform(nodes, shard))).alias("shard")
    sent = vectored.select("word", "n", own.alias("own"), to)
    sent = sent.select("word", "n", "shard", (F.col("own") == F.col("shard")).alias("stored"))
    found = sent.groupBy("shard").applyInArrow(_search_shard, BEST)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near").alias("near"))


def _roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` of every ``word, form``: forms followed to the last one."""
    current = scratch.stage(forms.withColumnRenamed("form", "root"))
    while True:
        on = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        # Doubling: after a round, a root lies twice as many steps away.
        moved = current.join(on, "root", "left")
        after = scratch.stage(
            moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        )
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        current = after.select("word", "root")


def group_variants(docs: DataFrame, every: int = 0) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: every word, the form that it is a variant of, if
    any, and the root that its forms lead to."""
    scratch = Scratch(docs.sparkSession, "variants", free=True)
    counted = scratch.stage(word_counts(docs, every))
    near = scratch.stage(near_words(counted, scratch))
    found = scratch.stage(
        counted.join(near, "word", "left").withColumn("has", F.col("near_n") >= TIMES * F.col("n"))
    )
    forms = found.where("has").select("word", F.col("near").alias("form"))
    roots = _roots(forms, scratch)
    return found.join(roots, "word", "left").select(
        "word", F.when(F.col("has"), F.col("near")).alias("form"), F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(F.col("has"), F.col("near_n")).alias("form_n"),
    )
