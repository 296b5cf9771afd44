"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

A text is cut into words, numbers and runs of punctuation. Features are hashed uni- and
bigrams of the lower-cased words, where a word equal to the one before it is written as a
repeat mark, and uni- to trigrams of word shapes (kind, letter case, length). Each distinct
feature counts once per text. FTRL-Proximal with an L1 term leaves most weights at exactly
zero, so a text's score is a sparse dot product over its features with a weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.arrowtext import BYTE_VALUE_LOWER, WHITE, mix, slices, span_hashes
from basalt.llm.sampling import sampled_texts, train_in_task

BITS = 18
# Kinds of bytes: white space, letter (also every byte of a non-ASCII letter), digit, other
_KIND = np.full(256, 3, np.int64)
_KIND[WHITE] = 0
_KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = 1
_KIND[[*range(ord("0"), ord("9") + 1)]] = 2
_UPPER = np.zeros(256, np.int64)
_UPPER[ord("A") : ord("Z") + 1] = 1
_ASCII_LETTER = _UPPER.copy()
_ASCII_LETTER[ord("a") : ord("z") + 1] = 1
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_REPEAT = np.uint64(0x0123456789ABCDEF)


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed feature) of every n-gram of a flat text slice, with repeats."""
    none = np.zeros(0, np.int64)
    if not len(raw):
        return none, none
    kind = _KIND[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    cut = cut[:-1]
    cut[1:] |= kind[1:] != kind[:-1]
    edges = np.append(np.flatnonzero(cut), len(raw))
    solid = kind[edges[:-1]] != 0
    starts, ends = edges[:-1][solid], edges[1:][solid]
    if not len(starts):
        return none, none
    row = np.searchsorted(offsets, starts, side="right") - 1
    word = span_hashes(BYTE_VALUE_LOWER[raw], starts, ends)
    together = np.append(row[1:] == row[:-1], False)  # with the next token
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & together[:-1]
    uppers = np.concatenate([[0], np.cumsum(_UPPER[raw])])
    letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[raw])])
    up, of = uppers[ends] - uppers[starts], letters[ends] - letters[starts]
    case = np.where(up == 0, 0, np.where((up == of) & (of > 1), 1, np.where(_UPPER[raw[starts]] == 1, 2, 3)))
    shape = (kind[starts] * 4 + case) * 16 + np.minimum(np.where(kind[starts] == 1, (ends - starts) // 4, ends - starts), 15)
    shape = mix(shape.astype(np.uint64) + np.uint64(1))
    shown = np.where(again, _REPEAT, word)
    pair, triple = together[:-1], together[:-2] & together[1:-1]
    grams = [
        (row, mix(word)), (row[:-1][pair], mix(shown[:-1] * _K[0] + shown[1:] * _K[1])[pair]),
        (row, mix(shape + _K[0])), (row[:-1][pair], mix(shape[:-1] * _K[1] + shape[1:] * _K[2])[pair]),
    ]
    if len(word) > 2:
        grams.append((row[:-2][triple], mix(shape[:-2] * _K[0] + shape[1:-1] * _K[1] + shape[2:] * _K[2])[triple]))
    rows = np.concatenate([g[0] for g in grams])
    return rows, (np.concatenate([g[1] for g in grams]) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray  # one per hashed feature, mostly zero
    bias: float
    scale: float = 1.0  # Platt scaling of the margin, fitted to rows kept out of training
    shift: float = 0.0

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows, feats = features(raw, offsets)
        weighted = self.weights[feats] != 0
        keys = np.unique(rows[weighted] * (1 << BITS) + feats[weighted])
        margin = np.bincount(keys >> BITS, self.weights[keys & ((1 << BITS) - 1)], len(offsets) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(self.scale * margin + self.shift, -30, 30)))


def ftrl(examples: list[np.ndarray], labels: np.ndarray, epochs: int = 4, alpha: float = 0.05, beta: float = 1.0, l1: float = 0.5, l2: float = 1.0, seed: int = 8) -> Model:
    """Train on lists of distinct feature ids; the rarer label weighs as much as the other."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = 0.0
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    weight = np.minimum(weight, 10.0)
    rng = np.random.default_rng(seed)

    def solve(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            f = examples[i]
            w = solve(z[f], n[f])
            wb = -zb / ((beta + np.sqrt(nb)) / alpha)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + wb, -30, 30)))
            g = (p - labels[i]) * weight[i]
            new = n[f] + g * g
            z[f] += g - (np.sqrt(new) - np.sqrt(n[f])) / alpha * w
            n[f] = new
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / alpha * wb
            nb += g * g
    return Model(solve(z, n), float(-zb / ((beta + np.sqrt(nb)) / alpha)))


def _platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the margin by a few Newton steps of a ridge-stabilised logistic fit."""
    x, w = np.column_stack([margins, np.ones(len(margins))]), np.array([1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (labels - p) - 1e-2 * (w - [1.0, 0.0])
        w += np.clip(np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), grad), -1, 1)
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = 8_000, sample_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit to labelled rows (``id``, ``label`` 0/1; others are ignored).

    ``sample`` bounds the rows, half of each label at most, and ``sample_bytes`` their text. Their
    hashed features go to one task, which trains; a fifth of them calibrates the margin. Without
    rows of both labels every text gets the share of label 1 (0.5 without any row). Null texts
    are empty.
    """
    labels = labels.filter("id is not null and label in (0, 1)").withColumn("label", F.col("label").cast("int"))
    rows = sampled_texts(docs, labels, sample, sample_bytes, id_col, text_col)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, raw, offsets in slices(batch, "text"):
                row, feats = features(raw, offsets)
                keys = np.unique(row * (1 << BITS) + feats)
                bounds = np.searchsorted(keys >> BITS, np.arange(len(offsets)))
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array((keys & ((1 << BITS) - 1)).astype(np.int32)))
                yield pa.record_batch({"id": some.column(0), "label": some.column(2), "features": lists})

    kind = docs.schema[id_col].dataType
    out = T.StructType([T.StructField("id", kind), T.StructField("label", T.IntegerType()), T.StructField("features", T.ArrayType(T.IntegerType()))])
    return train_in_task(rows.mapInArrow(extract, out), _fitted)


def _fitted(table: pa.Table) -> Model:
    """The model trained on and calibrated with the sampled rows."""
    y = table["label"].to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        share = float(y.mean()) if len(y) else 0.5
        return Model(np.zeros(1 << BITS), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    examples = [x.values.to_numpy() for x in table["features"]]
    inner = np.arange(len(y)) % 5 != 0
    if min(y[~inner].sum(), (1 - y[~inner]).sum()) < 5:  # too few to calibrate on rows of their own
        return ftrl(examples, y)
    part = ftrl([e for e, k in zip(examples, inner) if k], y[inner])
    margins = np.array([part.weights[e].sum() + part.bias for e, k in zip(examples, inner) if not k])
    model = ftrl(examples, y)
    model.scale, model.shift = _platt(margins, y[~inner])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``score`` (0 to 1) and ``predicted`` (1 from 0.5) of the whole text.

    Null text counts as empty; empty texts get the score of a text without features. Repeated
    rows and null ids are scored like any other; other columns are not read; an empty table
    gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, raw, offsets in slices(batch, "text"):
                yield pa.record_batch({"id": some.column(0), "score": model.scores(raw, offsets)})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(run, T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())]))
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
