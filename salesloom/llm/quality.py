"""Quality classifier: attention-based multiple-instance learning over the passages of a text.

A document is a bag of passages and only the bag has a label. Every passage is described by what its
bytes and words look like, a learned layer encodes it, gated attention weighs the passages of a
document, and the weighted sum is scored. All four parts are trained together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from salesloom.llm.common import bounded_batches, utf8

PASSAGE = 512  # bytes
SAMPLE = 4000  # labelled documents to learn from, at most
THRESHOLD = 0.7
_SLICE = 250_000  # bytes of text described together

_CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\t\n\v\f\r", b".",
            b",", b"!", b"?", b"'\"`", b"#$%&*+=@^_~|<>", b"()[]{}", b":;-/\\"]
_KINDS = len(_CLASSES) + 3  # others: control bytes, first bytes and later bytes of longer characters
_WORD_FEATURES = 6
FEATURES = _KINDS + _WORD_FEATURES


def _class_table() -> np.ndarray:
    table = np.full(256, len(_CLASSES), dtype=np.int64)
    table[128:192] = len(_CLASSES) + 1
    table[192:] = len(_CLASSES) + 2
    for kind, members in enumerate(_CLASSES):
        table[list(members)] = kind
    return table


_CLASS = _class_table()
_BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def describe_passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and how many passages each text has (one at least)."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    passages = np.maximum(1, -(-lengths // PASSAGE))
    first = np.cumsum(passages) - passages
    total = int(passages.sum())
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    starts = np.cumsum(lengths) - lengths
    of_text = np.repeat(np.arange(len(texts)), lengths)
    of_byte = first[of_text] + (np.arange(len(data)) - starts[of_text]) // PASSAGE
    counts = np.bincount(of_byte * _KINDS + _CLASS[data], minlength=total * _KINDS).reshape(total, _KINDS)
    sizes = np.maximum(1, counts.sum(axis=1))
    out = np.zeros((total, FEATURES), dtype=np.float32)
    out[:, :_KINDS] = counts / sizes[:, None]
    if len(data):
        ink = ~_BLANK[data]
        edge = np.zeros(len(data), dtype=bool)
        edge[starts[lengths > 0]] = True
        begins = ink & (edge | np.concatenate(([True], ~ink[:-1])))
        at = np.flatnonzero(begins)
        if len(at):
            out[:, _KINDS:] = _word_features(data, ink, at, of_text, of_byte, total)
    return out, passages


def _word_features(data, ink, at, of_text, of_byte, total) -> np.ndarray:
    text, passage = of_text[at], of_byte[at]
    # A word's hash: its bytes, spread by their distance from its start, summed over the word.
    mark = np.zeros(len(data), dtype=np.int64)
    mark[at] = 1
    word_of = np.cumsum(mark) - 1
    inked = np.flatnonzero(ink)
    owner = word_of[inked]
    place = (inked - at[owner]).astype(np.uint64)
    value = (data[inked].astype(np.uint64) + np.uint64(257) * (place + np.uint64(1))) * _MIX
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    ends = np.append(np.flatnonzero(np.diff(owner)) + 1, len(owner))
    sums = np.cumsum(value, dtype=np.uint64)[ends - 1]
    word = np.diff(sums, prepend=np.uint64(0)) ^ text.astype(np.uint64) * _MIX
    size = np.diff(ends, prepend=0)
    same = np.zeros((len(word), 2), dtype=bool)
    same[1:, 0] = word[1:] == word[:-1]
    same[2:, 1] = word[2:] == word[:-2]
    triple = word.copy()
    triple[:-2] = word[:-2] * np.uint64(3) + word[1:-1] * np.uint64(0x100000001B3) + (word[2:] ^ (word[2:] >> np.uint64(31)))
    seen = np.ones(len(word), dtype=bool)  # three words that the text has had before
    seen[np.unique(triple, return_index=True)[1]] = False
    seen[-2:] = False
    own = np.unique(np.stack([passage.astype(np.uint64), word]), axis=1)[0].astype(np.int64)
    words = np.bincount(passage, minlength=total)
    divide = np.maximum(1, words)

    def mean(values):
        return np.bincount(passage, weights=values, minlength=total) / divide

    return np.stack(
        [words / 64, mean(size) / 8, np.bincount(own, minlength=total) / divide, mean(same[:, 0]), mean(same[:, 1]), mean(seen)],
        axis=1,
    )


@dataclass
class Model:
    """The weights, by part; ``centre`` and ``scale`` make features comparable."""

    centre: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def score(self, features: np.ndarray, passages: np.ndarray) -> np.ndarray:
        return _forward(self.weights, (features - self.centre) / self.scale, passages)["p"]


def _forward(w: dict, x: np.ndarray, passages: np.ndarray) -> dict:
    starts = np.cumsum(passages) - passages
    h = np.tanh(x @ w["We"] + w["be"])
    t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
    e = (t * g) @ w["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), passages))
    a = e / np.repeat(np.add.reduceat(e, starts), passages)
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    p = 1 / (1 + np.exp(-(z @ w["c"] + w["b"])))
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "p": p, "starts": starts}


def _backward(w: dict, x: np.ndarray, passages: np.ndarray, y: np.ndarray, f: dict) -> dict:
    d = (f["p"] - y) / len(y)
    dz = d[:, None] * w["c"]
    wide = np.repeat(dz, passages, axis=0)
    da = (wide * f["h"]).sum(axis=1)
    within = np.add.reduceat(f["a"] * da, f["starts"])
    de = f["a"] * (da - np.repeat(within, passages))
    dt = de[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2)
    dg = de[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
    dh = f["a"][:, None] * wide + dt @ w["V"].T + dg @ w["U"].T
    dx = dh * (1 - f["h"] ** 2)
    return {
        "We": x.T @ dx, "be": dx.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ dg,
        "a": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ d, "b": d.sum(keepdims=True),
    }


def fit(
    features: np.ndarray, passages: np.ndarray, labels: np.ndarray, *, width: int = 16, gate: int = 8,
    rounds: int = 250, rate: float = 0.02, decay: float = 1e-3, seed: int = 7,
) -> Model:
    """Train all weights on bags of passages with labels from 0 to 1, by Adam over all bags at once.

    Without any bag the weights are zero and every score is 0.5.
    """
    if not len(labels):
        shapes = {"We": (FEATURES, width), "be": (width,), "V": (width, gate), "U": (width, gate), "a": (gate,), "c": (width,), "b": (1,)}
        return Model(np.zeros(FEATURES), np.ones(FEATURES), {k: np.zeros(s) for k, s in shapes.items()})
    random = np.random.default_rng(seed)
    centre, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x = ((features - centre) / scale).astype(np.float64)
    draw = lambda *shape: random.normal(size=shape) / np.sqrt(shape[0])
    w = {"We": draw(FEATURES, width), "be": np.zeros(width), "V": draw(width, gate), "U": draw(width, gate), "a": draw(gate), "c": draw(width), "b": np.zeros(1)}
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, rounds + 1):
        slope = _backward(w, x, passages, labels, _forward(w, x, passages))
        for k in w:
            s = slope[k] + decay * w[k]
            first[k] = 0.9 * first[k] + 0.1 * s
            second[k] = 0.999 * second[k] + 0.001 * s * s
            w[k] = w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(centre, scale, w)


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample: int = SAMPLE,
) -> Model:
    """Learn from at most ``sample`` labelled documents that aren't held out.

    The sample is taken by a hash of the id and is the same on every run. Documents with several
    labels have their mean; NULL labels and labels without a document teach nothing. Only features
    of the sample's passages come to the driver.
    """
    bounded_batches(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("double").alias("y"))
    known = known.filter(F.col("y").isNotNull() & ~held_out(F.col("k")) & F.col("k").isNotNull())
    known = known.groupBy("k").agg(F.avg("y").alias("y"))
    known = known.orderBy(F.xxhash64("k"), "k").limit(sample)
    texts = docs.select(F.col(id_col).alias("d"), utf8(F.col(text_col)).alias("text"))
    # At most ``sample`` rows of two numbers are broadcast.
    chosen = texts.join(F.broadcast(known), F.col("d") == F.col("k")).select("d", "y", "text")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            described = [describe_passages([t])[0].tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("d").cast(pa.int64()), batch.column("y"), pa.array(described, pa.binary())], ["d", "y", "x"]
            )

    rows = chosen.mapInArrow(describe, "d long, y double, x binary").toPandas()
    rows = rows.assign(x=rows["x"].map(bytes)).sort_values(["d", "x"], kind="stable")
    bags = [np.frombuffer(x, dtype=np.float32).reshape(-1, FEATURES) for x in rows["x"]]
    features = np.concatenate(bags) if bags else np.zeros((0, FEATURES), dtype=np.float32)
    return fit(features, np.array([len(b) for b in bags], dtype=np.int64), rows["y"].to_numpy(dtype=np.float64))


def scorer(model: Model):
    """Column function: text bytes to a score from 0 to 1."""

    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            scores, group, size = [], [], 0
            for text in texts:
                group.append(text)
                size += len(text)
                if size > _SLICE:
                    scores.append(model.score(*describe_passages(group)))
                    group, size = [], 0
            if group:
                scores.append(model.score(*describe_passages(group)))
            yield pd.Series(np.concatenate(scores) if scores else [], dtype="float64")

    return score


def score_quality(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a column ``score_col``: from 0 to 1, higher where label 1 is likelier.

    Every passage of the whole text counts. NULL, empty and blank texts have one empty passage and
    a score like any other; equal texts have equal scores; an empty table gives no rows. A column of
    that name is replaced.
    """
    return docs.withColumn(score_col, scorer(model)(utf8(F.col(text_col))))
