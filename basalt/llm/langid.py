"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are runs of ``GRAMS`` bytes of the lower-cased text, white space, digits and punctuation
folded into one separator. Their hashed embeddings are averaged over the whole text and
mapped to languages by a linear layer; both are trained by stochastic gradient descent in
numpy on a bounded sample. As the model is linear up to the softmax, scoring uses the product
of embeddings and layer: one small row of logits per bucket, summed over a text.

Rows kept out of training calibrate the probability by a temperature and set the lowest one
that is not rejected: the share ``keep`` of them stays. Short texts are less certain than
long ones, so texts of up to 100 and up to 500 bytes have limits of their own, from pieces of
40 and 200 bytes of those rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.llm.arrowtext import mix, segment_sums, slices
from basalt.llm.sampling import sampled_texts, train_in_task

BITS = 16
GRAMS = (2, 3, 4)
UNKNOWN = "und"
PIECES = (40, 200)
PIECE_LIMITS = (100, 500)  # bytes up to which the limit from each piece holds
_FOLD = np.zeros(256, np.uint64)
for _b in [*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]:
    _FOLD[_b] = _b
for _b in range(ord("A"), ord("Z") + 1):
    _FOLD[_b] = _b + 32
_ASCII_LETTER = (_FOLD > 0) & (np.arange(256) < 0x80)


def subwords(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed subwords of a flat text slice, row by row, and their bounds.

    A subword is known by where it begins; those made of separators only are left out.
    """
    n = len(raw)
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    folded = _FOLD[raw]
    code, solid, hashes, rows = np.zeros(n, np.uint64), folded > 0, [], []
    for size in range(1, max(GRAMS) + 1):
        if size > n:
            break
        code = (code[: n - size + 1] << np.uint64(8)) | folded[size - 1 :]
        if size > 1:
            solid = solid[: n - size + 1] | (folded[size - 1 :] > 0)
        if size in GRAMS:
            whole = (row_of[: n - size + 1] == row_of[size - 1 :]) & solid
            hashes.append((mix(code[whole] + np.uint64(size << 40)) >> np.uint64(64 - BITS)).astype(np.int64))
            rows.append(row_of[: n - size + 1][whole])
    if not hashes:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    h, r = np.concatenate(hashes), np.concatenate(rows)
    order = np.argsort(r, kind="stable")
    return h[order], np.searchsorted(r[order], np.arange(len(offsets)))


def has_letter(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each row holds a letter of any script."""
    count = np.concatenate([[0], np.cumsum(_ASCII_LETTER[raw])])
    out = count[offsets[1:]] > count[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[i] = any(c.isalpha() for c in raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8"))
    return out


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    logits: np.ndarray | None = None  # (buckets, languages): embeddings times linear layer
    bias: np.ndarray | None = None
    temperature: float = 1.0
    lowest: tuple[float, ...] = (0.0, 0.0, 0.0)  # lowest probability kept: by size class

    def identified(self, best: np.ndarray, p: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which rows are not rejected."""
        return (best >= 0) & (p >= np.array(self.lowest)[size_class(np.diff(offsets))])

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number (-1: no letter or no language learned) and probability per row."""
        letters = has_letter(raw, offsets)
        if not self.languages:
            return np.full(len(letters), -1), np.zeros(len(letters))
        h, bounds = subwords(raw, offsets)
        means = np.zeros((len(letters), len(self.languages)))
        n = np.maximum(np.diff(bounds), 1)
        for k in range(len(self.languages)):
            means[:, k] = segment_sums(self.logits[k][h].astype(np.float64), bounds) / n
        p = softmax((means + self.bias) / self.temperature)
        best = p.argmax(axis=1)
        return np.where(letters, best, -1), np.where(letters, p[np.arange(len(p)), best], 0.0)


def size_class(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(PIECE_LIMITS, sizes)


def lowest_kept(p: np.ndarray, keep: float, languages: int) -> float:
    """The probability that the share ``keep`` of clean rows reaches. Too few rows to see that
    share: halfway in log-odds from the lowest of them to an even guess; none: nothing is rejected."""
    if not len(p) or languages < 2:
        return 0.0
    if len(p) * (1 - keep) >= 1:
        return float(np.quantile(p, 1 - keep))
    low, even = np.clip([p.min(), 1 / languages], 1e-9, 1 - 1e-9)
    middle = (np.log(low / (1 - low)) + np.log(even / (1 - even))) / 2
    return float(1 / (1 + np.exp(-middle)))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, languages: int, dim: int = 16, epochs: int = 5, rate: float = 0.5, seed: int = 10) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """SGD over (bucket ids, shares summing to 1) examples: embeddings, linear layer, bias."""
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 1 / dim, (1 << BITS, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, languages), np.float32), np.zeros(languages, np.float32)
    steps, done = epochs * max(1, len(examples)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            ids, share = examples[i]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = share @ emb[ids]
            g = softmax((hidden @ layer + bias)[None])[0]
            g[labels[i]] -= 1
            back = layer @ g
            layer -= lr * np.outer(hidden, g)
            bias -= lr * 0.1 * g
            emb[ids] -= (lr * len(ids) ** 0.5) * share[:, None] * back
    return emb, layer, bias


def fit(docs: DataFrame, labelled: DataFrame, sample: int = 4_000, sample_bytes: int = 32 << 20, keep: float = 0.998, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit to labelled rows (``id``, ``label``: the language; null labels are ignored).

    ``sample`` bounds the rows, an equal share for each language, and ``sample_bytes`` their text.
    Their distinct bucket ids and shares go to one task, which trains: once for the whole text
    and once for a piece of 200 bytes from it, so that short texts are seen too. A fifth of the
    rows sets the temperature and, with a piece of 40 bytes as well, the limits of rejection.
    Without a labelled row, as for an empty table, every text is ``und``. Null texts are empty.
    """
    labelled = labelled.filter("id is not null and label is not null")
    rows = sampled_texts(docs, labelled, sample, sample_bytes, id_col, text_col)

    def count(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        h, bounds = subwords(raw, offsets)
        out = []
        for a, b in zip(bounds[:-1], bounds[1:]):
            ids, c = np.unique(h[a:b], return_counts=True)
            out.append((ids.astype(np.int32), (c / max(1, b - a)).astype(np.float32)))
        return out

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, raw, offsets in slices(batch, "text"):
                whole = count(raw, offsets)
                tiny, short = ([], [])
                for a, b in zip(offsets[:-1], offsets[1:]):
                    at = a + (b - a) // 3
                    for pieces, size in zip((tiny, short), PIECES):
                        piece = raw[at : min(b, at + size)]
                        pieces += count(piece, np.array([0, len(piece)]))
                yield pa.record_batch({
                    "id": some.column(0), "label": some.column(2), "ids": pa.array([x[0] for x in whole]), "shares": pa.array([x[1] for x in whole]),
                    "short_ids": pa.array([x[0] for x in short]), "short_shares": pa.array([x[1] for x in short]),
                    "tiny_ids": pa.array([x[0] for x in tiny]), "tiny_shares": pa.array([x[1] for x in tiny]), "size": np.diff(offsets).astype(np.int64),
                })

    ints, floats = T.ArrayType(T.IntegerType()), T.ArrayType(T.FloatType())
    out = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("label", T.StringType()), T.StructField("ids", ints), T.StructField("shares", floats),
        T.StructField("short_ids", ints), T.StructField("short_shares", floats), T.StructField("tiny_ids", ints), T.StructField("tiny_shares", floats),
        T.StructField("size", T.LongType()),
    ])
    return train_in_task(rows.withColumn("label", F.col("label").cast("string")).mapInArrow(extract, out), lambda table: _fitted(table, keep))


def _fitted(table: pa.Table, keep: float) -> Model:
    """The model trained on and calibrated with the sampled rows."""
    if not table.num_rows:
        return Model()
    names = table["label"].to_pylist()
    languages = sorted(set(names))
    y = np.array([languages.index(x) for x in names])
    *pairs, tiny = [
        [(i.values.to_numpy(), s.values.to_numpy()) for i, s in zip(table[a], table[b])]
        for a, b in (("ids", "shares"), ("short_ids", "short_shares"), ("tiny_ids", "tiny_shares"))
    ]
    inner = np.arange(len(y)) % 5 != 0 if len(y) >= 50 else np.ones(len(y), bool)
    examples = [x for kind in pairs for x, k in zip(kind, inner) if k and len(x[0])]
    of = np.concatenate([[label for x, label, k in zip(kind, y, inner) if k and len(x[0])] for kind in pairs]).astype(int)
    emb, layer, bias = train(examples, of, len(languages))
    model = Model(languages, np.ascontiguousarray((emb @ layer).T), bias.astype(np.float64))
    held = [(x, label) for kind in pairs for x, label, k in zip(kind, y, inner) if len(x[0]) and (not k or inner.all())]
    if held:
        z = np.array([model.logits[:, x[0]].astype(np.float64) @ x[1] for x, _ in held]) + model.bias
        truth = np.array([label for _, label in held])
        loss = {t: -np.log(softmax(z / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in np.geomspace(0.1, 10, 41)}
        model.temperature = float(min(loss, key=loss.get))
        long = size_class(table["size"].to_numpy()) == len(PIECES)
        out_of_training = ~inner if not inner.all() else inner
        limits = []
        for kind, use in ((tiny, out_of_training), (pairs[1], out_of_training), (pairs[0], out_of_training & long)):
            z = [model.logits[:, x[0]].astype(np.float64) @ x[1] for x, k in zip(kind, use) if k and len(x[0])]
            p = softmax((np.array(z).reshape(-1, len(languages)) + model.bias) / model.temperature).max(axis=1) if z else np.zeros(0)
            limits.append(lowest_kept(p, keep, len(languages)))
        model.lowest = tuple(limits)
    return model


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``lang_pred``, ``score`` (its calibrated probability) and ``rejected``.

    The whole text counts. Null text and texts without a letter get ``und``, score 0 and are
    rejected. Repeated rows and null ids are handled like any other; other columns are not
    read; an empty table gives an empty result.
    """
    names = np.array([*model.languages, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, raw, offsets in slices(batch, "text"):
                best, p = model.predict(raw, offsets)
                yield pa.record_batch({"id": some.column(0), "lang_pred": pa.array(names[best], pa.string()), "score": p, "rejected": ~model.identified(best, p, offsets)})

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)


def drop_unidentified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, without the rows that :func:`identify` rejects.

    So null texts, empty ones and those without a letter go; repeated rows and null ids are
    judged by their text; an empty table stays empty.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, raw, offsets in slices(batch, text_col):
                best, p = model.predict(raw, offsets)
                yield some.filter(pa.array(model.identified(best, p, offsets)))

    return docs.mapInArrow(keep, docs.schema)
