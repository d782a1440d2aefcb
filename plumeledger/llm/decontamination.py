"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the token postings of every document. A segment is one row: the
hashes of its distinct words and, for each word, the sorted list of the positions at which
it stands. Segments are cut by bytes, so a hot word, source or group of copies changes
neither their number nor their size, and building them shuffles nothing.

``find_phrases`` sends the windows of the test items to all segments. Within a segment, a
window's position lists are intersected from its rarest word on: the rarest list, moved
back by the word's place in the window, holds the candidate starts, and each further list
removes those it does not contain. A window with a word that the segment lacks is dropped
at once. ``find_proximity`` looks for the rarest words of an item near each other instead.

The test items travel with the tasks only in groups of checked size; more items than one
group holds mean more passes over the index, whose hits are then merged per document.

Words are compared by 64-bit hashes. Defined results: null and blank texts have no words;
an item without words matches nothing; repeated rows are judged one by one; repeated
``item_id`` count once; an item with a null ``item_id`` matches nothing unless ``nameless``
items are asked for, which then are together one item whose id is null; empty tables are
allowed on either side; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, fresh
from .textbytes import LOWER, SpanHasher, chunks, word_spans

#: a-z, 0-9 and every byte of a character beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

SEGMENTS = (
    "segment long, doc_ids array<bigint>, n_words array<int>, "
    "terms binary, list_ends binary, positions binary"
)
_SEGMENT_BYTES = 2 << 20


def _hashed_words(hasher: SpanHasher, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lower = LOWER[data]
    starts, ends, runs = word_spans(_WORD[lower], offsets)
    return hasher(lower, starts, ends), runs


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    hasher, segment = SpanHasher(), TaskContext.get().partitionId() << 32
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column("text"), _SEGMENT_BYTES):
            words, runs = _hashed_words(hasher, data, offsets)
            n_words = np.diff(runs)
            # One empty position after every document keeps phrases within it.
            position = (np.arange(len(words)) + np.repeat(np.arange(hi - lo), n_words)).astype(np.uint32)
            order = np.argsort(words, kind="stable")
            words = words[order]
            last = np.flatnonzero(np.append(words[1:] != words[:-1], True)) if len(words) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([segment], pa.int64()),
                    pa.array([batch.column("doc_id").slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                    pa.array([n_words.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([words[last].tobytes()], pa.binary()),
                    pa.array([(last + 1).astype(np.uint32).tobytes()], pa.binary()),
                    pa.array([position[order].tobytes()], pa.binary()),
                ],
                names=["segment", "doc_ids", "n_words", "terms", "list_ends", "positions"],
            )
            segment += 1


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (``doc_id, text``): one row per segment, see ``SEGMENTS``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_index_rows, SEGMENTS)


class Segment:
    """Position lists of one index row."""

    def __init__(self, row: dict) -> None:
        self.doc_ids = row["doc_ids"]
        self.n_words = np.array(row["n_words"], np.int64)
        self.first = np.cumsum(self.n_words + 1) - self.n_words - 1
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.ends = np.frombuffer(row["list_ends"], np.uint32).astype(np.int64)
        self.begins = np.concatenate([[0], self.ends[:-1]])[: len(self.ends)]
        self.positions = np.frombuffer(row["positions"], np.uint32).astype(np.int64)
        self._keys: np.ndarray | None = None

    def term_numbers(self, words: np.ndarray) -> np.ndarray:
        """Place of each word among the segment's terms, -1 where it has none."""
        if not len(self.terms):
            return np.full(words.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)

    def contains(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether each term's list holds the position."""
        if self._keys is None:
            owner = np.repeat(np.arange(len(self.terms)), self.ends - self.begins)
            self._keys = (owner << 32) | self.positions
        key = (term << 32) | np.maximum(position, 0)
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return (self._keys[at] == key) & (position >= 0)

    def phrases(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window numbers and start positions of all occurrences of equally long windows."""
        terms = self.term_numbers(windows)
        rows = np.flatnonzero((terms >= 0).all(axis=1))
        if not len(rows):
            return rows, rows
        terms = terms[rows]
        sizes = (self.ends - self.begins)[terms]
        order = np.argsort(sizes, axis=1, kind="stable")
        rarest = np.take_along_axis(terms, order[:, :1], 1)[:, 0]
        held = self.ends[rarest] - self.begins[rarest]
        window = np.repeat(np.arange(len(rows)), held)
        lists = np.arange(len(window)) - np.repeat(np.cumsum(held) - held, held) + np.repeat(self.begins[rarest], held)
        start = self.positions[lists] - np.repeat(order[:, 0], held)
        for k in range(1, windows.shape[1]):
            place = order[window, k]
            there = self.contains(terms[window, place], start + place)
            window, start = window[there], start[there]
            if not len(window):
                break
        return rows[window], start

    def doc_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, "right") - 1


@dataclass
class Items:
    """Words of test items, and their distinct windows by length."""

    item_ids: pa.Array
    words: list[np.ndarray]
    windows: dict[int, np.ndarray]
    #: For each length: window number and item number of every window of an item.
    owners: dict[int, tuple[np.ndarray, np.ndarray]]


def _windows_of(rows: list, size: int) -> Items:
    rows = sorted({(r["item_id"], r["text"] or "") for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    words: list[np.ndarray] = []
    hasher = SpanHasher()
    for _, _, data, offsets in chunks(pa.array([t for _, t in rows], pa.string())):
        hashes, runs = _hashed_words(hasher, data, offsets)
        words += [hashes[a:b] for a, b in zip(runs[:-1], runs[1:], strict=True)]
    found: dict[int, list] = {}
    for i, w in enumerate(words):
        n = min(size, len(w))
        if n:
            view = np.lib.stride_tricks.sliding_window_view(w, n)
            found.setdefault(n, []).append((view, np.full(len(view), i)))
    windows, owners = {}, {}
    for n, parts in found.items():
        windows[n], number = np.unique(np.concatenate([v for v, _ in parts]), axis=0, return_inverse=True)
        owners[n] = (number.reshape(-1), np.concatenate([i for _, i in parts]))
    return Items(pa.array([i for i, _ in rows], pa.int64()), words, windows, owners)


def _groups(items: DataFrame, size: int, group_bytes: int, nameless: bool) -> Iterator[Items]:
    """The items in groups of about ``group_bytes`` of text, one at a time on the driver."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    if not nameless:
        items = items.where("item_id is not null")
    # Items without an id are told apart by their texts.
    group = F.xxhash64("item_id", F.when(F.col("item_id").isNull(), F.col("text")))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // group_bytes))
    for k in range(n):
        yield _windows_of(items.where(F.pmod(group, F.lit(n)) == k).collect(), size)


HITS = "segment long, ordinal int, doc_id bigint, n_words long, spans array<struct<s:int,e:int>>, items array<bigint>"


def _hits(items: Items) -> Callable:
    def of(segment: Segment, row: dict) -> pa.RecordBatch:
        cover = np.zeros(int((segment.n_words + 1).sum()) + 1, np.int64)
        pairs = []
        for n, windows in items.windows.items():
            window, start = segment.phrases(windows)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + n, -1)
            docs = segment.doc_of(start)
            found = np.unique(docs << 32 | window)
            number, owner = items.owners[n]
            order = np.argsort(number, kind="stable")
            number, owner = number[order], owner[order]
            a = np.searchsorted(number, found & 0xFFFFFFFF, "left")
            b = np.searchsorted(number, found & 0xFFFFFFFF, "right")
            which = np.repeat(a - np.cumsum(b - a) + (b - a), b - a) + np.arange((b - a).sum())
            pairs.append(np.repeat(found >> 32, b - a) << 32 | owner[which])
        hit = np.cumsum(cover) > 0
        edge = np.diff(np.concatenate([[0], hit.astype(np.int8)]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        n = len(segment.doc_ids)
        of_span = segment.doc_of(begin)
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        spans = pa.StructArray.from_arrays(
            [pa.array((x - segment.first[of_span]).astype(np.int32)) for x in (begin, end)], ["s", "e"]
        )
        lists = [np.searchsorted(x, np.arange(n + 1)).astype(np.int32) for x in (of_span, pairs >> 32)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, row["segment"])),
                pa.array(np.arange(n, dtype=np.int32)),
                pa.array(segment.doc_ids, pa.int64()),
                pa.array(segment.n_words),
                pa.ListArray.from_arrays(lists[0], spans),
                pa.ListArray.from_arrays(lists[1], items.item_ids.take(pa.array(pairs & 0xFFFFFFFF))),
            ],
            names=["segment", "ordinal", "doc_id", "n_words", "spans", "items"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                yield of(Segment(row), row)

    return run


def find_phrases(
    index: DataFrame, items: DataFrame, window: int = 10, group_bytes: int = 8 << 20, nameless: bool = False
) -> DataFrame:
    """``doc_id, n_words, spans, items`` of every document: ``spans`` are the runs of its words
    (from ``s`` to before ``e``) inside occurrences of windows, ``items`` the ids of the items
    with such windows; those of ``nameless`` items give one null. ``index`` must be a written table, whose segment numbers stand fast."""
    found = [index.mapInArrow(_hits(group), HITS) for group in _groups(items, window, group_bytes, nameless)]
    if len(found) == 1:
        return found[0].select("doc_id", "n_words", "spans", F.array_distinct("items").alias("items"))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    span = "array<struct<s:int,e:int>>"
    merged = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.array().cast(span),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["e"] >= x["s"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["s"].alias("s"),
                        F.greatest(F.element_at(done, -1)["e"], x["e"]).alias("e"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    return (
        hits.groupBy("segment", "ordinal")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            merged.alias("spans"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        .select("doc_id", "n_words", "spans", "items")
    )


def find_proximity(
    index: DataFrame, items: DataFrame, terms: int = 3, within: int = 20, group_bytes: int = 8 << 20
) -> DataFrame:
    """``doc_id, item_id, start``: places where an item's rarest words stand near each other.

    The ``terms`` words that the whole index holds least often (ties by hash) must lie, in any
    order, in the ``within`` words around the rarest one: no further than ``within - 1`` words
    from it. Items with fewer distinct words need all they have. ``start`` is the rarest
    word's place in the document.
    """
    frames = []
    for group in _groups(items, 1, group_bytes, False):
        held = np.unique(np.concatenate([*group.words, np.zeros(0, np.uint64)]))

        def count(batches, held=held):
            for batch in batches:
                n = np.zeros(len(held), np.int64)
                for i in range(batch.num_rows):
                    terms_there = np.frombuffer(batch.column("terms")[i].as_buffer(), np.uint64)
                    ends = np.frombuffer(batch.column("list_ends")[i].as_buffer(), np.uint32).astype(np.int64)
                    _, ours, there = np.intersect1d(held, terms_there, return_indices=True)
                    n[ours] += np.diff(np.concatenate([[0], ends]))[there]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held))), pa.array(n)], names=["t", "n"])

        counts = np.zeros(len(held), np.int64)
        for t, n in index.mapInArrow(count, "t long, n long").groupBy("t").agg(F.sum("n")).collect():
            counts[t] = n
        chosen = []
        for words in group.words:
            distinct = np.unique(words)
            order = np.argsort(counts[np.searchsorted(held, distinct)], kind="stable")
            chosen.append(distinct[order[:terms]])
        frames.append(index.mapInArrow(_near(chosen, group.item_ids, within), "doc_id bigint, item_id bigint, start int"))
    found = frames[0]
    for more in frames[1:]:
        found = found.unionByName(more)
    return found


def _near(chosen: list[np.ndarray], item_ids: pa.Array, within: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                segment = Segment({c: batch.column(c)[i].as_py() for c in batch.schema.names})
                rows = []
                for item, words in zip(item_ids.to_pylist(), chosen, strict=True):
                    numbers = segment.term_numbers(words)
                    if not len(words) or (numbers < 0).any():
                        continue
                    lists = [segment.positions[segment.begins[t] : segment.ends[t]] for t in numbers]
                    at = lists[0]
                    docs = segment.doc_of(at)
                    for other in lists[1:]:
                        right = np.searchsorted(other, at)
                        near = np.zeros(len(at), bool)
                        for k in (np.minimum(right, len(other) - 1), np.maximum(right - 1, 0)):
                            near |= (abs(other[k] - at) < within) & (segment.doc_of(other[k]) == docs)
                        at, docs = at[near], docs[near]
                    rows += [(segment.doc_ids[d], item, int(p - segment.first[d])) for p, d in zip(at, docs, strict=True)]
                yield pa.RecordBatch.from_pandas(
                    pd.DataFrame(rows, columns=["doc_id", "item_id", "start"]),
                    pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int32())]),
                    preserve_index=False,
                )

    return run


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, nameless: bool = False) -> DataFrame:
    """``find_phrases`` on a stored index of ``docs``."""
    scratch = Scratch(docs.sparkSession, "postings")
    return find_phrases(scratch.stage(build_index(docs)), items, window, nameless=nameless)


def remove_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, nameless: bool = False) -> DataFrame:
    """The documents of ``docs``, all columns, without those that hold a window of an item.

    Rows are matched by a hash of ``doc_id`` and text, so rows that share an id are judged
    each by its own text.
    """
    (key,) = fresh(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    judged = contamination(keyed.select(F.col(key).alias("doc_id"), "text"), items, window, nameless)
    bad = judged.where(F.size("spans") > 0).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(bad, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
