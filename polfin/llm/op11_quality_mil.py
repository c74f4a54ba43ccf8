"""Quality of whole texts by attention-based multiple-instance learning.

A text is a bag of passages, ``PASSAGE`` bytes each. A passage is encoded as frequencies
of hashed character shapes and letter groups and a few figures of its own, then by a
learned layer. Only texts have labels: gated attention weights, learned with the rest,
say how much each passage counts, and the score is that of the weighted sum of the
encoded passages. One bad passage may decide, or none, as the labels teach.

The model is fitted on a bounded sample of labelled rows (``TRAIN_DOCUMENTS``, and
``TRAIN_PASSAGES`` of each, evenly spread). Scoring is one pass over whole texts: attention
is a running weighted mean, so a text of any length is taken part by part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polfin.llm.common import stored, text_batches

# Labelled rows the model is fitted on, shared equally between the labels, and passages of each.
TRAIN_DOCUMENTS = 2400
TRAIN_PASSAGES = 24
PASSAGE = 512
SHAPES, GROUPS, FIGURES = 192, 192, 6
FEATURES = SHAPES + GROUPS + FIGURES
ENCODED, ATTENTION = 16, 8
ROUNDS = 160
LEARNING_RATE = 0.02
DECAY = 1e-4
SEED = 11
_PASSAGES_AT_ONCE = 512
_DRAWS = 1 << 30


def _kinds() -> np.ndarray:
    """Kind of each byte; 0 is no byte at all."""
    kind = np.full(256, 9, np.uint8)  # other punctuation
    for b in range(256):
        ch = chr(b)
        if b >= 128:
            kind[b] = 1
        elif ch.islower():
            kind[b] = 2
        elif ch.isupper():
            kind[b] = 3
        elif ch.isdigit():
            kind[b] = 4
        elif ch == "\n":
            kind[b] = 5
        elif ch.isspace():
            kind[b] = 6
        elif ch in ".,;:'\"":
            kind[b] = 7
        elif ch in "!?":
            kind[b] = 8
        elif ch in "#$%&*|<>=~^\\{}[]@_":
            kind[b] = 10
    kind[0] = 0
    return kind


_KIND = _kinds()
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_MULTIPLIER = np.uint32(2654435761)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def passages(text: str | None) -> np.ndarray:
    """The bytes of a text in rows of one passage, the last filled up with zeros; an empty text is one passage of zeros."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-len(raw) // PASSAGE))
    out = np.zeros(n * PASSAGE, np.uint8)
    out[: len(raw)] = np.where(raw == 0, 32, raw)
    return out.reshape(n, PASSAGE)


def _frequencies(codes: np.ndarray, there: np.ndarray, bins: int) -> np.ndarray:
    """Square roots of the shares of hashed codes in each row."""
    n = len(codes)
    slot = (codes * _MULTIPLIER >> np.uint32(12)) % np.uint32(bins)
    slot = slot.astype(np.int64) + np.arange(n)[:, None] * bins
    counts = np.bincount(slot[there], minlength=n * bins).reshape(n, bins)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def encode(rows: np.ndarray) -> np.ndarray:
    """Features of passages, in order: shapes of three characters, groups of three, figures."""
    kind = _KIND[rows]
    there = kind[:, 2:] > 0
    k = kind.astype(np.uint32)
    shape = (k[:, :-2] * np.uint32(11) + k[:, 1:-1]) * np.uint32(11) + k[:, 2:] + np.uint32(1)
    w = _SMALL[rows].astype(np.uint32)
    group = w[:, :-2] << np.uint32(16) | w[:, 1:-1] << np.uint32(8) | w[:, 2:]
    letters = there & (kind[:, :-2] <= 3) & (kind[:, 1:-1] <= 3) & (kind[:, 2:] <= 3)
    size = np.maximum((kind > 0).sum(axis=1), 1)
    # How much is said twice: different runs of four bytes among all.
    four = group[:, :-1] << np.uint32(8) | w[:, 3:]
    four[kind[:, 3:] == 0] = 0
    in_order = np.sort(four, axis=1)
    different = (in_order[:, 1:] != in_order[:, :-1]).sum(axis=1)
    blank = (kind == 5) | (kind == 6)
    begins = (blank[:, :-1] & ~blank[:, 1:] & (kind[:, 1:] > 0)).sum(axis=1) + 1
    figures = [
        different / np.maximum(size - 3, 1),
        (kind == 3).sum(axis=1) / size,
        (kind == 4).sum(axis=1) / size,
        ((kind == 8) | (kind == 10)).sum(axis=1) / size,
        begins * 6 / size,
        np.log1p((kind > 0).sum(axis=1)) / 6,
    ]
    return np.hstack([_frequencies(shape, there, SHAPES), _frequencies(group, letters, GROUPS), np.stack(figures, axis=1).astype(np.float32)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    """Weights by name. Features are centred and scaled; ``constant`` is the score where nothing could be learned."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def encoded(self, features: np.ndarray) -> np.ndarray:
        return np.tanh((features - self.mean) * self.scale @ self.weights["encode"] + self.weights["encode_0"])

    def attention(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, and the two gated parts they are made of."""
        t, g = np.tanh(h @ self.weights["tanh"]), _sigmoid(h @ self.weights["gate"])
        return (t * g) @ self.weights["attend"], t, g


def _new_model(features: np.ndarray) -> Model:
    rng = np.random.default_rng(SEED)
    shapes = {"encode": (FEATURES, ENCODED), "encode_0": (ENCODED,), "tanh": (ENCODED, ATTENTION), "gate": (ENCODED, ATTENTION), "attend": (ATTENTION,), "out": (ENCODED,), "out_0": (1,)}
    weights = {n: (rng.normal(size=s) / np.sqrt(s[0]) if not n.endswith("_0") else np.zeros(s)).astype(np.float32) for n, s in shapes.items()}
    mean = features.mean(axis=0)
    return Model(mean, (1 / np.maximum(features.std(axis=0), 0.02)).astype(np.float32) / 4, weights)


def loss_and_gradient(model: Model, features: np.ndarray, bag: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted log loss of bags and its gradient; ``bag`` numbers each passage's text, in order."""
    w = model.weights
    x = (features - model.mean) * model.scale
    h = model.encoded(features)
    e, t, g = model.attention(h)
    first = np.flatnonzero(np.concatenate([[True], bag[1:] != bag[:-1]]))
    a = np.exp(e - np.maximum.reduceat(e, first)[bag])
    a /= np.add.reduceat(a, first)[bag]
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    p = _sigmoid(z @ w["out"] + w["out_0"])
    eps = 1e-7
    loss = float(-(weight * (labels * np.log(p + eps) + (1 - labels) * np.log(1 - p + eps))).sum())
    ds = weight * (p - labels)
    dz = ds[:, None] * w["out"]
    da = (dz[bag] * h).sum(axis=1)
    de = a * (da - np.add.reduceat(a * da, first)[bag])
    dg = de[:, None] * w["attend"]
    dt_in, dg_in = dg * g * (1 - t * t), dg * t * g * (1 - g)
    dh = a[:, None] * dz[bag] + dt_in @ w["tanh"].T + dg_in @ w["gate"].T
    dh_in = dh * (1 - h * h)
    gradient = {"encode": x.T @ dh_in, "encode_0": dh_in.sum(axis=0), "tanh": h.T @ dt_in, "gate": h.T @ dg_in, "attend": (t * g).T @ de, "out": z.T @ ds, "out_0": np.array([ds.sum()])}
    return loss, gradient


def fit(bags: Sequence[np.ndarray], labels: Sequence[int], share: float | None = None, rounds: int = ROUNDS) -> Model:
    """A model from encoded bags; ``share`` is the share of label 1 that bags are weighted to (default: their own)."""
    y = np.asarray(labels, np.float32)
    if len(set(labels)) < 2:
        n = np.zeros((1, FEATURES), np.float32)
        model = _new_model(n)
        model.constant = float((y.sum() + 1) / (len(y) + 2))
        return model
    features = np.concatenate(bags).astype(np.float32)
    bag = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    model = _new_model(features)
    ones = y.mean()
    share = float(ones) if share is None else share
    weight = np.where(y == 1, share / ones, (1 - share) / (1 - ones)) / len(y)
    first, second = ({n: np.zeros_like(w) for n, w in model.weights.items()} for _ in range(2))
    for step in range(1, rounds + 1):
        _, gradient = loss_and_gradient(model, features, bag, y, weight)
        for n, w in model.weights.items():
            d = gradient[n] + DECAY * w
            first[n] += 0.1 * (d - first[n])
            second[n] += 0.01 * (d * d - second[n])
            move = LEARNING_RATE * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-8)
            w -= move.astype(np.float32)
    return model


def _parts(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Passages of some texts and the number of each one's text, a bounded number at once."""
    rows, numbers, held = [], [], 0
    for i, t in enumerate(texts):
        whole = passages(t)
        for at in range(0, len(whole), _PASSAGES_AT_ONCE):
            part = whole[at : at + _PASSAGES_AT_ONCE]
            rows.append(part)
            numbers.append(np.full(len(part), i))
            held += len(part)
            if held >= _PASSAGES_AT_ONCE:
                yield np.concatenate(rows), np.concatenate(numbers)
                rows, numbers, held = [], [], 0
    if rows:
        yield np.concatenate(rows), np.concatenate(numbers)


def predict(model: Model, texts: Sequence[str | None]) -> np.ndarray:
    """Scores of whole texts: attention as a running weighted mean of encoded passages."""
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    top = np.full(len(texts), -np.inf)
    total = np.zeros(len(texts))
    mean = np.zeros((len(texts), ENCODED))
    for rows, number in _parts(texts):
        h = model.encoded(encode(rows))
        e = model.attention(h)[0].astype(np.float64)
        first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
        there = number[first]
        new = np.maximum(top[there], np.maximum.reduceat(e, first))
        kept = np.exp(top[there] - new)
        a = np.exp(e - np.repeat(new, np.diff(np.append(first, len(number)))))
        total[there] = total[there] * kept + np.add.reduceat(a, first)
        mean[there] = mean[there] * kept[:, None] + np.add.reduceat(a[:, None] * h, first, axis=0)
        top[there] = new
    z = mean / np.maximum(total, 1e-300)[:, None]
    return _sigmoid(z @ model.weights["out"].astype(np.float64) + float(model.weights["out_0"][0]))


@F.pandas_udf(T.BinaryType())
def _sampled_bag(text: pd.Series) -> pd.Series:
    """Encoded passages of each text: all, or ``TRAIN_PASSAGES`` evenly spread."""

    def one(t: str | None) -> bytes:
        rows = passages(t)
        if len(rows) > TRAIN_PASSAGES:
            rows = rows[np.linspace(0, len(rows) - 1, TRAIN_PASSAGES).astype(int)]
        return encode(rows).tobytes()

    return pd.Series([one(t) for t in text], dtype=object)


def train(docs: DataFrame, labels: DataFrame, documents: int = TRAIN_DOCUMENTS) -> Model:
    """A model from the rows of ``docs`` that ``labels`` (doc_id, quality) marks 0 or 1 and that are not held out.

    Of each label at most half of ``documents`` rows are taken, those with the smallest
    hash of the id; the labels weigh as often as they come among all rows. An id
    labelled both ways teaches nothing, nor does a NULL id or label. Where only one
    label is left every text gets the same score.
    """
    spark = docs.sparkSession
    text_batches(spark)
    said = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    clear = said.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other")).where(F.col("label") == F.col("other"))
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(_DRAWS)).alias("draw")
    known = stored(clear.join(ids, "doc_id").select("doc_id", "label", "rows", draw), "mil-labels")
    sizes = {r["label"]: (r["ids"], r["n"]) for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("ids"), F.sum("rows").alias("n")).collect()}
    each = documents // 2
    # A cut by the draw alone leaves about twice as many ids as are wanted; then the smallest are taken.
    cut = F.lit(False)
    for label, (n, _) in sizes.items():
        cut = cut | ((F.col("label") == label) & (F.col("draw") <= F.lit(int(min(1.0, 2.0 * each / n) * _DRAWS))))
    nth = F.row_number().over(Window.partitionBy("label").orderBy("draw", "doc_id"))
    chosen = known.where(cut).withColumn("nth", nth).where(F.col("nth") <= each).select(F.col("doc_id").alias("_id"), "label", "draw")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # ``documents`` ids at most
    # Rows that share an id: of each as many as make the bound, the least texts first.
    of_id = Window.partitionBy("_id").orderBy("text_hash", "size")
    hashed = rows.withColumn("text_hash", F.xxhash64("text")).withColumn("size", F.coalesce(F.length("text"), F.lit(-1)))
    once = hashed.withColumn("k", F.row_number().over(of_id)).where("k = 1")
    sample = once.select("label", "draw", "_id", _sampled_bag("text").alias("bag")).collect()
    sample.sort(key=lambda r: (r["label"], r["draw"], r["_id"]))
    bags = [np.frombuffer(r["bag"], np.float32).reshape(-1, FEATURES) for r in sample]
    count = {label: n for label, (_, n) in sizes.items()}
    share = count.get(1, 0) / sum(count.values()) if count else None
    return fit(bags, [r["label"] for r in sample], share)


def score(docs: DataFrame, model: Model, *, text: str = "text") -> Column:
    """A column of scores, 0 to 1, for rows of ``docs``."""
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    @F.pandas_udf(T.DoubleType())
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(predict(shared.value, list(batch)))

    return scored(F.col(text))


def qualities(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``.

    Only texts are scored; a NULL text is like an empty one and has the score of one passage
    without bytes. Repeated rows get the same score. ``predicted`` is 1 from 0.5 on.
    Further columns of either table are ignored; an empty table gives an empty result.
    """
    model = model or train(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
