"""Language identification with error-correcting output codes.

Every language has a codeword of bits, and one binary classifier per bit predicts it from
the byte n-grams of a text: a naive Bayes model whose positive side pools the languages with
that bit set. The predicted margins are decoded by loss: each bit's logistic loss against a
codeword is weighted by how well the bit separates the languages it was trained on, and the
codeword with the smallest total wins. A text whose two best codewords lie close together is
flagged as ambiguous.

Training counts the n-grams of all labelled rows, in every task, and sums them per language
and bucket; what reaches the driver is one number per language and bucket, whatever the size
of the corpus.

Defined results: a null text and a text without any letter get ``und`` and score 0; rows
without a language teach nothing; repeated rows count as often as they stand there; if
nothing can be learned every text is ``und``; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textbytes import LOWER, chunks

BUCKETS = 1 << 14
#: Bytes of text handled at a time; n-grams and their margins take about 150 times as much.
_CHUNK = 1 << 20
ORDERS = (1, 2, 3)

#: Letters keep their (small) byte, bytes beyond ASCII stay, everything else is a blank.
_PLAIN = LOWER.copy()
_PLAIN[[b for b in range(128) if not 97 <= LOWER[b] <= 122]] = 32


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of some texts, text by text, and the n + 1 offsets."""
    n = len(offsets) - 1
    plain = _PLAIN[data]
    keep = np.ones(len(plain), bool)
    keep[1:] = (plain[1:] != 32) | (plain[:-1] != 32)
    sums = np.concatenate([[0], np.cumsum(keep)])
    offsets = sums[offsets]
    plain = plain[keep].astype(np.uint64)
    found, owner = [], np.repeat(np.arange(n), np.diff(offsets))
    owners = []
    for order in ORDERS:
        size = max(0, len(plain) - order + 1)
        code = np.full(size, order, np.uint64)
        for k in range(order):
            code = (code << np.uint64(8)) | plain[k : k + size]
        inside = owner[:size] == owner[order - 1 : order - 1 + size] if size else np.zeros(0, bool)
        inside &= code != np.uint64(order << 8 | 32) if order == 1 else True
        bucket = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 14)
        found.append(bucket[inside].astype(np.int32))
        owners.append(owner[:size][inside])
    counts = np.sum([np.bincount(o, minlength=n) for o in owners], axis=0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(bounds[-1], np.int32)
    at = bounds[:-1].copy()
    for o, b in zip(owners, found, strict=True):
        size = np.bincount(o, minlength=n)
        first = np.cumsum(size) - size
        out[at[o] + np.arange(len(o)) - first[o]] = b
        at += size
    return out, bounds


def codewords(k: int) -> np.ndarray:
    """``k`` codewords of bits -1 and 1: the exhaustive code up to 7 languages, beyond that the
    best separated of several random codes."""
    if k <= 7:
        column = np.arange(1, 2 ** max(0, k - 1))
        return np.array([np.ones(len(column), int)] + [1 - 2 * ((column >> i) & 1) for i in range(k - 1)])
    random = np.random.Generator(np.random.PCG64(13))

    def column() -> np.ndarray:
        # A bit that is the same for all languages would have nothing to learn from.
        while True:
            drawn = random.choice([-1, 1], k)
            if abs(drawn.sum()) < k:
                return drawn

    codes = [np.stack([column() for _ in range(10 * int(np.ceil(np.log2(k))))], 1) for _ in range(50)]
    apart = [(c @ c.T - 2 * c.shape[1] * np.eye(k)).max() for c in codes]
    return codes[int(np.argmin(apart))]


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    #: Log ratios, bucket by bit, and the weight of every bit.
    ratio: np.ndarray
    weight: np.ndarray


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        languages = batch.column("lang").to_pylist()
        for lo, hi, data, offsets in chunks(batch.column("text"), _CHUNK):
            buckets, bounds = grams(data, offsets)
            names = languages[lo:hi]
            number = {x: i for i, x in enumerate(dict.fromkeys(names))}
            of_text = np.array([number[x] for x in names])
            key = np.repeat(of_text, np.diff(bounds)) * BUCKETS + buckets
            counts = np.bincount(key, minlength=len(number) * BUCKETS).reshape(-1, BUCKETS)
            for name, i in number.items():
                held[name] = held.get(name, 0) + counts[i]
    for name, counts in held.items():
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(full), pa.string()), pa.array(full), pa.array(counts[full])],
            names=["lang", "bucket", "n"],
        )


def train(docs: DataFrame, held_out: Callable[[str], Column]) -> Model:
    """The model learned from ``text, lang`` of all rows that ``held_out`` does not hold."""
    rows = docs.where(~held_out("doc_id") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_count, "lang string, bucket long, n long")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(counts["lang"].unique())
    seen = np.zeros((len(languages), BUCKETS))
    seen[np.searchsorted(languages, counts["lang"]) if languages else [], counts["bucket"]] = counts["n"]
    share = (seen + 0.5) / (seen + 0.5).sum(1, keepdims=True) if languages else seen
    code = codewords(len(languages)) if languages else np.zeros((0, 0), int)
    ratio = np.zeros((BUCKETS, code.shape[1]))
    weight = np.ones(code.shape[1])
    for b in range(code.shape[1]):
        yes = code[:, b] == 1
        ratio[:, b] = np.log(share[yes].mean(0)) - np.log(share[~yes].mean(0))
        # A bit counts by the margin that it gives the language it tells apart worst.
        weight[b] = max(0.05, (code[:, b] * (share @ ratio[:, b])).min())
    return Model(languages, code, ratio.astype(np.float32), weight / weight.sum() if len(weight) else weight)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    plain = np.concatenate([[0], np.cumsum((LOWER[data] >= 97) & (LOWER[data] <= 122))])
    found = plain[offsets[1:]] > plain[offsets[:-1]]
    beyond = np.concatenate([[0], np.cumsum(data >= 128)])
    for i in np.flatnonzero(~found & (beyond[offsets[1:]] > beyond[offsets[:-1]])):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def predict(docs: DataFrame, model: Model, ambiguous_below: float = 0.5) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` for every row of ``docs``.

    ``score`` is the winner's share of ``exp(-loss)`` over all codewords; ``ambiguous`` says
    that the next codeword's loss is less than ``ambiguous_below`` larger.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.languages)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text"), _CHUNK):
                best, score, close = np.full(hi - lo, -1), np.zeros(hi - lo), np.zeros(hi - lo, bool)
                if k:
                    buckets, bounds = grams(data, offsets)
                    size = np.diff(bounds)
                    full = np.flatnonzero(size)
                    margin = np.zeros((hi - lo, model.code.shape[1]))
                    if len(full) and model.code.shape[1]:
                        margin[full] = np.add.reduceat(model.ratio[buckets], bounds[full], axis=0, dtype=np.float64)
                    margin *= (1 / np.sqrt(np.maximum(size, 1)))[:, None]
                    loss = np.logaddexp(0, -margin[:, None, :] * model.code[None]) @ model.weight
                    order = np.sort(loss, axis=1)
                    known = _has_letter(data, offsets)
                    best = np.where(known, loss.argmin(1), -1)
                    score = np.where(known, 1 / np.exp(order[:, :1] - loss).sum(1), 0.0)
                    if k > 1:
                        close = known & (order[:, 1] - order[:, 0] < ambiguous_below)
                names = [*model.languages, "und"]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.array([names[i] for i in best], pa.string()),
                        pa.array(score.astype(np.float64)),
                        pa.array(close),
                    ],
                    names=["doc_id", "lang_pred", "score", "ambiguous"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, lang_pred string, score double, ambiguous boolean")
