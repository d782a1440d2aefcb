"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE_WORDS`` words; only the bag has a label. Every
passage is encoded (shares of characters, word shapes and repetitions, then a learned dense
layer), a gated attention network weighs the passages of its document against each other,
and the weighted sum of their codes is the representation that is scored. Scoring reads all
passages of every whole text.

The network is fitted on a bounded sample of labelled rows: the ``SAMPLE_ROWS`` rows with the
smallest hashes of ``doc_id``, of each all passages. That bound holds at every input size;
nothing else is sampled.

Defined results: a null, empty or blank text is a bag with one passage of zeros and is
scored like any other; several labels of one ``doc_id`` count as their mean, rounded up from
one half; labels that are null or belong to no document are ignored; without any label every
score is 0.5; other columns of either table are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .shared import fresh
from .textbytes import SpanHasher, chunks, word_spans

PASSAGE_WORDS = 64
SAMPLE_ROWS = 12_000
#: Passages whose gradient is computed at a time; more only for a longer document.
BATCH_PASSAGES = 16_384

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _byte_kinds() -> np.ndarray:
    """Small letters, capitals, digits, blanks, bytes beyond ASCII, controls; each sign alone."""
    kinds = np.zeros(256, np.int64)
    kinds[128:], kinds[:128] = 4, 5
    kinds[_BLANK] = 3
    kinds[48:58] = 2
    kinds[65:91] = 1
    kinds[97:123] = 0
    signs = [b for b in range(33, 127) if kinds[b] == 5]
    kinds[signs] = 6 + np.arange(len(signs))
    return kinds


_KINDS = _byte_kinds()
_N_KINDS = int(_KINDS.max()) + 1
N_FEATURES = _N_KINDS + 8


def passages(hasher: SpanHasher, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and the n + 1 passage numbers that bound them."""
    n = len(offsets) - 1
    starts, ends, runs = word_spans(~_BLANK[data], offsets)
    n_words = np.diff(runs)
    per_text = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    bounds = np.concatenate([[0], np.cumsum(per_text)])
    total = int(bounds[-1])
    text_of = np.repeat(np.arange(n), n_words)
    of_word = bounds[text_of] + (np.arange(len(starts)) - runs[text_of]) // PASSAGE_WORDS
    out = np.zeros((total, N_FEATURES), np.float32)
    if not len(starts):
        return out, bounds
    size = np.bincount(of_word, minlength=total).astype(np.float64)
    some = np.maximum(size, 1)
    first = np.concatenate([[True], of_word[1:] != of_word[:-1]])
    # A blank belongs to the passage of the word before it.
    reach = np.append(starts[1:], len(data))
    reach = np.minimum(reach, offsets[text_of + 1])
    span = reach - starts
    at = np.repeat(starts - np.cumsum(span) + span, span) + np.arange(span.sum())
    kinds = np.bincount(np.repeat(of_word, span) * _N_KINDS + _KINDS[data[at]], minlength=total * _N_KINDS)
    kinds = kinds.reshape(total, _N_KINDS)
    out[:, :_N_KINDS] = np.sqrt(kinds / np.maximum(kinds.sum(1, keepdims=True), 1))

    words = hasher(data, starts, ends)
    share = lambda marked: np.bincount(of_word, marked, total) / some
    keys = np.sort((of_word.astype(np.uint64) << np.uint64(40)) | (words >> np.uint64(24)))
    fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
    distinct = np.bincount((keys[fresh] >> np.uint64(40)).astype(np.int64), minlength=total)
    again = np.concatenate([[False], words[1:] == words[:-1]]) & ~first
    length = (ends - starts).astype(np.float64)
    capital = (data[starts] >= 65) & (data[starts] <= 90)
    last = data[ends - 1]
    letter_end = ((last >= 97) & (last <= 122)) | ((last >= 65) & (last <= 90)) | (last >= 128)
    both = (data[starts] >= 65) & (data[ends - 1] >= 65)
    columns = [
        distinct / some, share(again), np.log1p(size) / 4, share(length) / 10,
        share(length == 1), share(capital), share(letter_end), share(both),
    ]
    for k, column in enumerate(columns):
        out[:, _N_KINDS + k] = column
    return out, bounds


@dataclass
class Network:
    """Weights of the encoder, of the gated attention and of the score."""

    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        w, at = self.w, bounds[:-1]
        bag = np.repeat(np.arange(len(at)), np.diff(bounds))
        x = (x - self.mean) / self.scale
        code = np.tanh(x @ w["encode"] + w["encode0"])
        content, gate = np.tanh(code @ w["content"]), 1 / (1 + np.exp(-(code @ w["gate"])))
        energy = (content * gate) @ w["energy"]
        weight = np.exp(energy - np.maximum.reduceat(energy, at)[bag])
        weight /= np.add.reduceat(weight, at)[bag]
        held = np.add.reduceat(weight[:, None] * code, at, axis=0)
        score = 1 / (1 + np.exp(-np.clip(held @ w["score"] + w["score0"], -30, 30)))
        return {"x": x, "bag": bag, "code": code, "content": content, "gate": gate, "weight": weight, "held": held, "score": score}

    def gradient(self, x: np.ndarray, bounds: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w, f, at = self.w, self.forward(x, bounds), bounds[:-1]
        bag, code, weight = f["bag"], f["code"], f["weight"]
        d_score = (f["score"] - y) / len(y)
        d_held = d_score[:, None] * w["score"]
        through = (code * d_held[bag]).sum(1)
        d_energy = weight * (through - np.add.reduceat(weight * through, at)[bag])
        d_both = d_energy[:, None] * w["energy"]
        d_content = d_both * f["gate"] * (1 - f["content"] ** 2)
        d_gate = d_both * f["content"] * f["gate"] * (1 - f["gate"])
        d_code = weight[:, None] * d_held[bag] + d_content @ w["content"].T + d_gate @ w["gate"].T
        d_in = d_code * (1 - code**2)
        return {
            "encode": f["x"].T @ d_in, "encode0": d_in.sum(0), "content": code.T @ d_content, "gate": code.T @ d_gate,
            "energy": (f["content"] * f["gate"]).T @ d_energy, "score": f["held"].T @ d_score, "score0": d_score.sum(),
        }


def _gradient(net: Network, bags: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient over some bags, from parts of about ``BATCH_PASSAGES`` passages."""
    sizes = np.array([len(b) for b in bags])
    part = (np.cumsum(sizes) - sizes) // BATCH_PASSAGES
    out: dict[str, np.ndarray] = {}
    for k in np.unique(part):
        rows = np.flatnonzero(part == k)
        bounds = np.concatenate([[0], np.cumsum(sizes[rows])])
        slopes = net.gradient(np.concatenate([bags[i] for i in rows]), bounds, labels[rows])
        for name, slope in slopes.items():
            out[name] = out.get(name, 0) + slope * (len(rows) / len(bags))
    return out


def fit(bags: list[np.ndarray], labels: np.ndarray, width: int = 24, gates: int = 12, epochs: int = 15) -> Network:
    """Adam on the logistic loss of the bags, with a little weight decay."""
    random = np.random.Generator(np.random.PCG64(3))
    n = sum(map(len, bags))
    mean = sum(b.sum(0, dtype=np.float64) for b in bags) / n
    std = np.sqrt(sum(((b - mean) ** 2).sum(0) for b in bags) / n)
    shape = {
        "encode": (bags[0].shape[1], width), "encode0": (width,), "content": (width, gates),
        "gate": (width, gates), "energy": (gates,), "score": (width,), "score0": (),
    }
    w = {k: random.normal(0, 1 / np.sqrt(max(1, s[0] if s else 1)), s) for k, s in shape.items()}
    net = Network(mean, std + 1e-2, w)
    first, second = ({k: np.zeros(s) for k, s in shape.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = random.permutation(len(bags))
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / epochs)) + 1e-4
        for lo in range(0, len(order), 128):
            rows = order[lo : lo + 128]
            slopes = _gradient(net, [bags[i] for i in rows], labels[rows])
            step += 1
            for k, slope in slopes.items():
                slope = slope + 1e-5 * w[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return net


def fold(column: str, parts: int) -> Column:
    """``crc32`` of an id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = SpanHasher()
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column("text")):
            x, bounds = passages(hasher, data, offsets)
            blobs = [x[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), batch.column("label").slice(lo, hi - lo), pa.array(blobs, pa.binary())],
                names=["doc_id", "label", "bag"],
            )


def train(docs: DataFrame, labels: DataFrame, label: str, held_out: Callable[[str], Column]) -> Network | None:
    """The network fitted on labelled rows that ``held_out`` does not hold; None without any."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
    usable = usable.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out("doc_id"))
    usable = usable.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # At most SAMPLE_ROWS pairs of an id and a number are broadcast.
    sample = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    bags = sample.mapInArrow(_sample_features, "doc_id long, label double, bag binary")
    # Rows that repeat an id could outnumber the sample: one is left of each.
    rows = bags.groupBy("doc_id").agg(F.min(F.struct("label", "bag")).alias("x")).select("doc_id", "x.*").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r["doc_id"])
    return fit(
        [np.frombuffer(r["bag"], np.float32).reshape(-1, N_FEATURES) for r in rows],
        np.array([r["label"] for r in rows]),
    )


def score(docs: DataFrame, net: Network | None, name: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` plus ``name``, from 0 to 1; every row, whole texts."""
    if name in docs.columns:
        raise ValueError(f"the input has a column {name} already")

    (whole,) = fresh(docs, "whole_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHasher()
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(whole)):
                if net is None:
                    found = np.full(hi - lo, 0.5)
                else:
                    x, bounds = passages(hasher, data, offsets)
                    found = net.forward(x, bounds)["score"]
                part = batch.slice(lo, hi - lo)
                names = [c for c in part.schema.names if c != whole]
                columns = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], names=[*names, name])

    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.withColumn(whole, F.col("text").cast("string")).mapInArrow(run, schema)
