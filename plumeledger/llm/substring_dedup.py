"""Passages that repeat anywhere in a corpus, by suffix automata of reference shards.

A window is ``window`` consecutive words of a document. Every word covered by a window whose
words also stand somewhere else, in the same or another document, is removed.

Broadcasting an automaton of every shard to all documents takes (shards) x (corpus) steps.
Here a document is streamed only against the shards that can hold its windows:

1. The gram of ``ROUTES[0]`` words with the smallest hash in a window (the leftmost, if it
   repeats) is the window's key: equal windows have equal keys. Consecutive windows with one
   gram in common form a segment; each window lies in exactly one.
2. Keys of a single segment hold no repeated window. The other segments are made distinct,
   with their number, and the words of one of each are cut from its text.
3. Keys are dealt into shards of about ``SHARD_WORDS`` words. A task builds the suffix
   automaton of its shard, counts the occurrences of every state, and streams the segments
   through it for matching statistics: the longest suffix, at every word, that occurs at
   least twice. Spans of ``window`` words or more go back to all places of the segment.
4. A key with more than ``HOT_WORDS`` distinct words (a line that stands in very many
   different texts) is no reason for a large shard: its segments are cut again by longer
   grams, at last by whole windows, of which a key has only one.

Words are compared exactly within a shard. Segments and rows are told apart by 128-bit hashes.

Defined results: a null, empty or blank text has no words and an empty text is left; a text
shorter than a window keeps all its words; every row is a document of its own, so of rows
that repeat none is kept whole if it has a window; a null ``doc_id`` stays null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .textbytes import SpanHasher, chunks, mix, word_spans

WINDOW = 35
#: Words of the gram that names a segment, of all segments and of those with a hot key.
ROUTES = (8, 20, 35)
SHARD_WORDS, HOT_WORDS = 50_000, 25_000

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)

SPANS = "array<struct<s:int,e:int>>"
SEGMENTS = "array<struct<key:long,start:int,size:int,a:long,b:long>>"


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The first place of the smallest value in every ``width`` consecutive ones."""
    at, held = np.arange(len(values)), 1
    while held < width:
        step = min(held, width - held)
        left, right = at[:-step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        held += step
    return at


class Segmenter:
    """Cuts texts into segments of windows with one key."""

    def __init__(self, window: int, gram: int) -> None:
        self.window, self.gram = window, gram
        self.hash = SpanHasher()
        random = np.random.Generator(np.random.PCG64(23))
        self.factor = random.integers(1, 1 << 62, gram, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.StructArray]:
        """The n + 1 word numbers and the n + 1 segment numbers that bound the texts, and the
        segments: key, first word, number of words, and two hashes of all of them."""
        starts, ends, runs = word_spans(~_BLANK[data], offsets)
        word = self.hash(data, starts, ends)
        n = len(word)
        if n < self.window:
            first = size = np.zeros(0, np.int64)
            key, prints = np.zeros(0, np.int64), [np.zeros(0, np.int64)] * 2
        else:
            grams = np.zeros(n - self.gram + 1, np.uint64)
            for k in range(self.gram):
                grams += word[k : k + len(grams)] * self.factor[k]
            grams = mix(grams)
            at = leftmost_minima(grams, self.window - self.gram + 1)
            text_end = np.repeat(runs[1:], np.diff(runs))
            whole = np.flatnonzero(np.arange(len(at)) + self.window <= text_end[: len(at)])
            at = at[whole]
            head = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else at
            first = whole[head]
            last = np.append(head[1:], len(at)) - 1
            size = whole[last] + self.window - first
            key = grams[at[head]].view(np.int64)
            prints = []
            for base in _BASES:
                powers = np.full(n, base, np.uint64)
                powers[:1] = 1
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * np.cumprod(powers, dtype=np.uint64))])
                inverse = np.full(n, pow(base, -1, 1 << 64), np.uint64)
                inverse[:1] = 1
                down = np.cumprod(inverse, dtype=np.uint64)
                prints.append(mix((sums[first + size] - sums[first]) * down[first]).view(np.int64))
        bounds = np.searchsorted(first, runs)
        text = np.searchsorted(runs, first, "right") - 1
        columns = [key, (first - runs[text]).astype(np.int32), size.astype(np.int32), *prints]
        return runs, bounds, pa.StructArray.from_arrays([pa.array(c) for c in columns], ["key", "start", "size", "a", "b"])


def _cut_up(window: int, gram: int, words: bool) -> Callable:
    """Segments of every row of ``a, b, text`` (and ``weight``): a list, or with their words one a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(window, gram)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text")):
                _, bounds, found = segmenter(data, offsets)
                part = batch.slice(lo, hi - lo)
                if not words:
                    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), found)
                    yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), lists], names=["a", "b", "segments"])
                    continue
                row = np.repeat(np.arange(hi - lo), np.diff(bounds))
                cut, texts = [], part.column("text").to_pylist()
                starts, sizes = (found.field(c).to_pylist() for c in ("start", "size"))
                held: tuple[int, list[str]] = (-1, [])
                for i, start, size in zip(row.tolist(), starts, sizes, strict=True):
                    if held[0] != i:
                        held = (i, texts[i].split(" "))
                    cut.append(" ".join(held[1][start : start + size]))
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("a").take(take), part.column("b").take(take), part.column("weight").take(take),
                        *[found.field(c) for c in ("key", "start", "size", "a", "b")], pa.array(cut, pa.string()),
                    ],
                    names=["of_a", "of_b", "weight", "key", "start", "size", "a", "b", "text"],
                )

    return run


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words, joined by one space, of each listed segment of a text."""
    for batch in batches:
        rows: list[dict] = []
        for text, wanted in zip(batch.column("text"), batch.column("wanted"), strict=True):
            words = text.as_py().encode().split()
            for x in wanted.as_py():
                rows.append({**x, "text": b" ".join(words[x["start"] : x["start"] + x["size"]]).decode()})
        of = lambda c, t: pa.array([r[c] for r in rows], t)
        yield pa.RecordBatch.from_arrays(
            [*[of(c, pa.int64()) for c in ("key", "a", "b", "weight")], of("size", pa.int32()), of("text", pa.string())],
            names=["key", "a", "b", "weight", "size", "text"],
        )


class SuffixAutomaton:
    """All substrings of some word sequences, and how often each occurs."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def add(self, words: list[int], weight: int) -> None:
        """Add a sequence that occurs ``weight`` times."""
        follow, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for w in words:
            p = last
            if w in follow[p]:
                q = follow[p][w]
                last = q if length[q] == length[p] + 1 else self._clone(p, w, q)
                count[last] += weight
                continue
            last = len(follow)
            follow.append({})
            link.append(0)
            length.append(length[p] + 1)
            count.append(weight)
            while p >= 0 and w not in follow[p]:
                follow[p][w] = last
                p = link[p]
            if p >= 0:
                q = follow[p][w]
                link[last] = q if length[q] == length[p] + 1 else self._clone(p, w, q)

    def _clone(self, p: int, w: int, q: int) -> int:
        """Part the strings of state ``q`` that are no longer than those that ``p`` and ``w`` make."""
        follow, link = self.next, self.link
        new = len(follow)
        follow.append(dict(follow[q]))
        link.append(link[q])
        self.length.append(self.length[p] + 1)
        self.count.append(0)
        link[q] = new
        while p >= 0 and follow[p].get(w) == q:
            follow[p][w] = new
            p = link[p]
        return new

    def close(self) -> None:
        """Pass the counts of longer strings on to their suffixes."""
        count, link = self.count, self.link
        for state in np.argsort(-np.array(self.length), kind="stable").tolist()[:-1]:
            count[link[state]] += count[state]
        count[0] = 0

    def spans(self, words: list[int], least: int) -> list[tuple[int, int]]:
        """Unions of the matches of at least ``least`` words that occur twice or more."""
        follow, link, length, count = self.next, self.link, self.length, self.count
        state = matched = 0
        out: list[tuple[int, int]] = []
        for i, w in enumerate(words):
            to = follow[state].get(w, 0)
            while state and count[to] < 2:
                state = link[state]
                matched = length[state]
                to = follow[state].get(w, 0)
            if count[to] >= 2:
                state = to
                matched += 1
            if matched >= least:
                start = i + 1 - matched
                if out and start <= out[-1][1]:
                    start = out.pop()[0]
                out.append((start, i + 1))
        return out


FOUND = f"a long, b long, spans {SPANS}"


def _match(window: int) -> Callable:
    """Spans of repeated windows in the segments of one shard."""

    def run(rows: pa.Table) -> pa.Table:
        known: dict[str, int] = {}
        texts = [[known.setdefault(w, len(known)) for w in t.split(" ")] for t in rows["text"].to_pylist()]
        automaton = SuffixAutomaton()
        for text, weight in zip(texts, rows["weight"].to_pylist(), strict=True):
            automaton.add(text, weight)
        automaton.close()
        spans = [[{"s": s, "e": e} for s, e in automaton.spans(text, window)] for text in texts]
        kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
        table = pa.table({"a": rows["a"], "b": rows["b"], "spans": pa.chunked_array([pa.array(spans, kind)])})
        return table.filter(pa.array([bool(s) for s in spans], pa.bool_()))

    return run


def _repeated(distinct: DataFrame, window: int, routes: tuple[int, ...], scratch: Scratch) -> DataFrame:
    """``a, b, spans`` of the distinct segments (``key, a, b, weight, size, text``) that have some."""
    keys = distinct.groupBy("key").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    keys = scratch.stage(keys)
    hot = keys.where((F.col("words") > HOT_WORDS) & (F.col("n") > 1)).select("key")
    again = bool(routes) and not hot.isEmpty()
    cold = distinct.join(hot, "key", "left_anti") if again else distinct
    total = keys.agg(F.sum("words")).first()[0] or 0
    shard = F.pmod(F.xxhash64("key"), F.lit(max(1, -(-total // SHARD_WORDS))))
    cold = cold.select("a", "b", "weight", "text", shard.alias("shard"))
    found = scratch.stage(cold.groupBy("shard").applyInArrow(_match(window), FOUND))
    if not again:
        return found
    cut = distinct.join(hot, "key").select("a", "b", "weight", "text").mapInArrow(
        _cut_up(window, routes[0], words=True),
        "of_a long, of_b long, weight long, key long, start int, size int, a long, b long, text string",
    )
    cut = scratch.stage(cut)
    finer = cut.groupBy("key", "a", "b").agg(
        F.sum("weight").alias("weight"), F.first("size").alias("size"), F.first("text").alias("text")
    )
    inner = _repeated(scratch.stage(finer), window, routes[1:], scratch)
    placed = cut.select("of_a", "of_b", "start", "a", "b").join(inner, ["a", "b"])
    return found.unionByName(_gathered(placed, ["of_a", "of_b"]).toDF("a", "b", "spans"))


def _gathered(placed: DataFrame, keys: list[str]) -> DataFrame:
    """Spans of segments, moved to where the segments start, as one set per text."""
    moved = F.transform("spans", lambda x: F.struct((x["s"] + F.col("start")).alias("s"), (x["e"] + F.col("start")).alias("e")))
    spans = placed.select(*keys, F.explode(moved).alias("x"))
    return spans.groupBy(*keys).agg(F.collect_set("x").alias("spans"))


CLEANED = f"doc_id bigint, n_words long, n_removed long, spans {SPANS}, text string"


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    for batch in batches:
        rows: list[tuple] = []
        for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
            words = text.as_py().encode().split()
            n, merged, kept, at = len(words), [], [], 0
            for x in sorted((spans.as_py() or []), key=lambda x: x["s"]):
                if merged and x["s"] <= merged[-1]["e"]:
                    merged[-1]["e"] = max(merged[-1]["e"], x["e"])
                else:
                    merged.append(dict(x))
            for x in merged:
                kept += words[at : x["s"]]
                at = x["e"]
            kept += words[at:]
            rows.append((n, n - len(kept), merged, b" ".join(kept).decode()))
        n, removed, merged, kept = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                pa.array(merged, kind), pa.array(kept, pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "spans", "text"],
        )


def remove_repeated(docs: DataFrame, window: int = WINDOW, routes: tuple[int, ...] = ROUTES) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, text`` of every document: ``spans`` are the removed
    runs of its words (from ``s`` to before ``e``), ``text`` the kept words joined by one space.

    ``routes`` are gram lengths, rising, none longer than ``window``.
    """
    scratch = Scratch(docs.sparkSession, "passages")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    texts = texts.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("a"), F.xxhash64("text", "doc_id").alias("b"))
    cut = texts.select("a", "b", "text").mapInArrow(
        _cut_up(window, min(routes[0], window), words=False), f"a long, b long, segments {SEGMENTS}"
    )
    cut = scratch.stage(cut)
    segments = cut.select(F.col("a").alias("of_a"), F.col("b").alias("of_b"), F.inline("segments"))
    several = scratch.stage(segments.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    held = scratch.stage(segments.join(several, "key", "left_semi"))
    one = F.min(F.struct("of_a", "of_b", "start", "size")).alias("one")
    distinct = held.groupBy("key", "a", "b").agg(F.count("*").alias("weight"), one)
    wanted = distinct.select(
        "one.of_a", "one.of_b", F.struct("one.start", "one.size", "key", "a", "b", "weight").alias("x")
    )
    wanted = scratch.stage(wanted.groupBy("of_a", "of_b").agg(F.collect_list("x").alias("wanted")))
    # Of rows that share id and text one is read.
    first = texts.select(F.col("a").alias("of_a"), F.col("b").alias("of_b"), "text").join(wanted, ["of_a", "of_b"])
    words = first.select("text", "wanted").mapInArrow(
        _words_of, "key long, a long, b long, weight long, size int, text string"
    )
    words = scratch.stage(words.dropDuplicates(["key", "a", "b"]))
    found = scratch.stage(_repeated(words, window, routes[1:], scratch))
    spans = _gathered(held.select("of_a", "of_b", "start", "a", "b").join(found, ["a", "b"]), ["of_a", "of_b"])
    spans = scratch.stage(spans)
    marked = texts.withColumnsRenamed({"a": "of_a", "b": "of_b"}).join(spans, ["of_a", "of_b"], "left")
    return marked.select("doc_id", "text", "spans").mapInArrow(_clean, CLEANED)
