"""Packing of tokenised documents into sequences of a fixed length.

Pieces of documents are dealt into randomised groups, and every group is packed by itself
with first-fit decreasing. A tournament tree over the free room of the group's bins finds
the first bin that fits in logarithmic time: each inner node holds the largest room below
it, and the search walks left wherever the left child still fits.

Groups are even whatever the skew, because a piece's group is drawn from its row and not
from any key. Only piece lengths are shuffled; token ids stay where they were made unless
``sequences`` is asked for them.

Defined results: a null text is an empty one and yields the end token alone; repeated rows
are packed once each; an empty table gives an empty result; a document longer than a
sequence is cut into full pieces and one rest; columns of the input other than ``doc_id``
and ``text`` are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch
from .wordbpe import WordBpe

PIECES = "doc_id bigint, row long, doc_tokens long, start long, length long, ids binary"


def _cut(tokenizer_path: str, capacity: int, end_id: int) -> Callable:
    """Tasks that turn texts into pieces of at most ``capacity`` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(tokenizer_path)
        for batch in batches:
            for lo, hi, ids, offsets in bpe.encode(batch.column("text"), end_id):
                lengths = np.diff(offsets)
                pieces = -(-lengths // capacity)
                doc = np.repeat(np.arange(hi - lo), pieces)
                first = np.cumsum(pieces) - pieces
                start = (np.arange(len(doc)) - first[doc]) * capacity
                length = np.minimum(capacity, lengths[doc] - start)
                bounds = np.append((offsets[doc] + start) * 4, len(ids) * 4).astype(np.int64)
                blob = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(doc), [None, pa.py_buffer(bounds), pa.py_buffer(ids)]
                )
                take = pa.array(doc + lo)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(take),
                        batch.column("row").take(take),
                        pa.array(lengths[doc]),
                        pa.array(start),
                        pa.array(length),
                        blob.cast(pa.binary()),
                    ],
                    names=["doc_id", "row", "doc_tokens", "start", "length", "ids"],
                )

    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of every document: ``doc_id, row, doc_tokens, start, length, ids``.

    ``ids`` are little-endian unsigned 32-bit token ids; ``row`` tells repeated rows apart.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(_cut(tokenizer_path, capacity, end_id), PIECES)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of every size; ties keep their order."""
    n = len(sizes)
    leaves = 1 << max(0, int(n - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i] = node - leaves
        offsets[i] = capacity - room[node]
        room[node] -= size
        while node > 1:
            node >>= 1
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def assign(rows: DataFrame, capacity: int = 2048, group_size: int = 8192) -> DataFrame:
    """``rows`` (with ``row, start, length``) plus ``sequence_id, offset``.

    The number of groups follows the number of pieces. ``rows`` should be a written table:
    it is counted first. Draws depend on ``row`` and ``start`` alone, so a task that runs
    again deals the same groups.
    """
    groups = max(1, -(-rows.count() // group_size))
    packed = rows.schema.add("pack_group", "long").add("sequence_id", "long").add("offset", "long")

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["row", "start"], kind="stable")
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=group["pack_group"] * (1 << 31) + bins, offset=offsets)

    dealt = rows.withColumn("pack_group", F.pmod(F.xxhash64("row", "start"), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInPandas(pack, packed).drop("pack_group")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Where every piece goes: ``doc_id, row, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``. The checksum stands for the ids, which ``sequences`` delivers."""
    scratch = Scratch(docs.sparkSession, "pack")
    cut = pieces(docs, tokenizer_path, capacity, end_id)
    described = cut.select("doc_id", "row", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return assign(scratch.stage(described), capacity)


def sequences(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids`` (binary, in order of offset).

    A sequence holds at most ``capacity`` ids, so its pieces may be collected in a group.
    """
    held = placed.select("row", "start", "sequence_id", "offset").join(
        cut.select("row", "start", "ids"), ["row", "start"]
    )
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return held.groupBy("sequence_id").agg(
        F.aggregate(ordered, F.lit(b"").cast("binary"), lambda done, x: F.concat(done, x["ids"])).alias("ids")
    )
