"""Token counts per section by offset-mapped attribution.

A document is encoded once, as a whole, so its counts add up to its real length; sections
encoded one by one would not. The tokenizer is byte-level and loses nothing, so the byte
lengths of its tokens, added up, are their offsets. Sorted token spans and sorted section
bounds are then joined by interval: both are cut at each other's edges, which two binary
searches per document do.

A token inside a section belongs to it. A token that crosses a boundary is allocated by an
explicit ``rule``:

* ``first``: to the section in which it begins,
* ``last``: to the section in which it ends,
* ``most``: to the section that holds most of its bytes, the first of them on a tie,
* ``split``: to every section it touches, by its share of bytes.

Text outside all sections forms sections of its own, whose name is null. Defined results: a
null or empty text has no sections and gives no row; an empty section counts 0; sections
given as null are none; overlapping or unordered sections fail; repeated rows are counted one
by one and told apart by ``row``; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import text_buffer

RULES = ("first", "last", "most", "split")
COUNTS = (
    "doc_id bigint, row long, section int, name string, start long, end long, "
    "n_tokens double, n_crossing long"
)


def fields(df: DataFrame, columns: list[str], separator: str = "\n") -> DataFrame:
    """``df`` with several text columns joined as ``text`` and listed as ``sections``."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns]
    sections, at = [], F.lit(0).cast("long")
    for name, text in zip(columns, texts, strict=True):
        end = at + F.char_length(text)
        sections.append(F.struct(F.lit(name).alias("name"), at.alias("start"), end.alias("end")))
        at = end + len(separator)
    joined = F.concat(*[x for t in texts for x in (F.lit(separator), t)][1:])
    return df.withColumns({"sections": F.array(*sections), "text": joined})


def encoder(ranks_path: str, pattern: str):
    """The tokenizer and the byte length of each of its tokens."""
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), size


def attribute(token_ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section, and how many tokens that touch it cross a boundary.

    ``token_ends``: increasing byte offsets at which the tokens end; ``bounds``: the n + 1
    offsets, increasing, that bound n sections from 0 to the last token's end.
    """
    n = len(bounds) - 1
    token_starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(bounds, token_starts, "right") - 1
    last = np.searchsorted(bounds, token_ends, "left") - 1
    crossing = np.flatnonzero(last > first)
    inside = np.bincount(first[last == first], minlength=n).astype(float)
    # Overlaps of crossing tokens: one entry per token and section, with its bytes.
    held = last[crossing] - first[crossing] + 1
    token = np.repeat(crossing, held)
    section = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held) + first[token]
    overlap = np.minimum(token_ends[token], bounds[section + 1]) - np.maximum(token_starts[token], bounds[section])
    touched = np.bincount(section[overlap > 0], minlength=n)
    if rule == "first":
        inside += np.bincount(first[crossing], minlength=n)
    elif rule == "last":
        inside += np.bincount(last[crossing], minlength=n)
    elif rule == "split":
        inside += np.bincount(section, overlap / (token_ends - token_starts)[token], n)
    else:
        best = np.lexsort((section, -overlap, token))
        lead = best[np.concatenate([[True], token[best][1:] != token[best][:-1]])] if len(best) else best
        inside += np.bincount(section[lead], minlength=n)
    return inside, touched


def _lines(raw: np.ndarray, chars: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The lines of a text, each with the line break that ends it, as ``_sections_of`` gives them."""
    stops = np.append(np.flatnonzero(raw == 10) + 1, len(raw))
    spans = np.stack([np.concatenate([[0], stops[:-1]]), stops], 1)
    return ["line"] * len(stops), np.arange(len(stops)), np.searchsorted(chars, spans), spans


def _sections_of(given: list | None, chars: np.ndarray) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Sections in order, with unnamed ones for what lies between them: names, numbers (-1 for
    none), and bounds in characters and in bytes."""
    out, at, n_chars = [], 0, len(chars) - 1
    for number, s in enumerate(given or []):
        start, end = min(s["start"], n_chars), min(s["end"], n_chars)
        if start < at or end < start:
            raise ValueError("sections must be in order and must not overlap")
        if start > at:
            out.append((None, -1, at, start))
        out.append((s["name"], number, start, end))
        at = end
    if at < n_chars:
        out.append((None, -1, at, n_chars))
    spans = np.array([s[2:] for s in out], np.int64).reshape(-1, 2)
    return [s[0] for s in out], np.array([s[1] for s in out], np.int64), spans, chars[spans]


def _count(ranks_path: str, pattern: str, rule: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, size = encoder(ranks_path, pattern)

        def table(batch: pa.RecordBatch, held: list[tuple]) -> pa.RecordBatch:
            rows, names, numbers, spans, tokens, crossing = zip(*held, strict=True)
            take = pa.array(np.repeat(rows, [len(n) for n in numbers]))
            number, span = np.concatenate(numbers), np.concatenate(spans)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take), batch.column("row").take(take),
                    pa.array(number.astype(np.int32), mask=number < 0), pa.array([n for x in names for n in x], pa.string()),
                    pa.array(span[:, 0]), pa.array(span[:, 1]), pa.array(np.concatenate(tokens)), pa.array(np.concatenate(crossing)),
                ],
                names=["doc_id", "row", "section", "name", "start", "end", "n_tokens", "n_crossing"],
            )

        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            given = batch.column("sections") if "sections" in batch.schema.names else None
            held: list[tuple] = []
            for i in range(batch.num_rows):
                raw = data[offsets[i] : offsets[i + 1]]
                if not len(raw):
                    continue
                ids = tokenizer.encode_ordinary(raw.tobytes().decode("utf-8", "replace"))
                ends = np.cumsum(size[np.array(ids, np.int64)])
                # Byte offset of every character, and of the end.
                chars = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
                names, numbers, spans, byte_spans = _lines(raw, chars) if given is None else _sections_of(given[i].as_py(), chars)
                full = spans[:, 1] > spans[:, 0]
                bounds = np.append(byte_spans[full, 0], len(raw))
                tokens, crossing = np.zeros(len(spans)), np.zeros(len(spans), np.int64)
                tokens[full], crossing[full] = attribute(ends, bounds, rule)
                held.append((i, names, numbers, spans, tokens, crossing))
                if len(held) >= 500:
                    yield table(batch, held)
                    held = []
            if held:
                yield table(batch, held)

    return run


def count(docs: DataFrame, ranks_path: str, pattern: str, rule: str = "most") -> DataFrame:
    """Tokens of every section of every document; see ``COUNTS`` for the columns.

    ``docs`` has ``doc_id, text`` and, unless its lines are meant, ``sections``: an array of
    ``name, start, end`` in code points, in order and without overlap.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = "array<struct<name:string,start:long,end:long>>"
    given = [F.col("sections").cast(kind).alias("sections")] if "sections" in docs.columns else []
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string").alias("text"), *given,
    )
    return rows.mapInArrow(_count(ranks_path, pattern, rule), COUNTS)
