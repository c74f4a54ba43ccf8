"""Language identification by a linear-chain conditional random field over words.

Each word of a text gets a label; features of a word are its affixes, its character
n-grams (n-grams of bytes, those at an edge of the word being told apart, are both)
and its entry in a lexicon of words seen in training. Labels of neighbours are tied by
learned transitions, so that a short ambiguous word takes its surroundings' language
and a switch inside a text is followed. Marginals come from forward-backward; a text's
language is the one with the most expected words.

The model is fitted on a bounded sample (``TRAIN_SEQUENCES``) of runs of words from
labelled documents; it has a fixed size. Prediction is one pass over whole texts, on
arrays of all words of a batch at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polfin.llm.common import stored, text_batches

# Runs of words the model is fitted on, shared equally among the languages (but 20 each at least).
TRAIN_SEQUENCES = 4000
RUN = 64
ROUNDS = 30
# Training runs whose features are looked at together.
FIT_AT_ONCE = 250
LEARNING_RATE = 0.5
DECAY = 1e-6
# Words in the lexicon: the most frequent of the training runs.
LEXICON = 20_000
UNKNOWN = "und"
# Rows of the weight table for n-grams; the lexicon has its own rows behind them.
TABLE_BITS = 17
_TEXT_BYTES_AT_ONCE = 1 << 18

_LETTER = re.compile(r"[^\W\d_]")
# ASCII characters that are no letters become blanks.
_BLANKED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_DRAWS = 1 << 30
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


@dataclass
class Words:
    """Features of all words of some texts, in order."""

    text: np.ndarray  # of each word, the number of its text
    grams: np.ndarray  # table rows, word after word
    first: np.ndarray  # of each word, where its grams start
    key: np.ndarray  # hash of each word


def words_of(texts: Sequence[str | None]) -> Words:
    """Two- to four-grams of each word with a blank at both ends, and the hash of the word."""
    raw = [(t or "").lower().encode().translate(_BLANKED) for t in texts]
    buffer = b"   " + b"   ".join(raw) + b"   "
    a = np.frombuffer(buffer, np.uint8)
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    begins = 3 + np.cumsum(np.concatenate([[0], lengths[:-1] + 3])) if len(raw) else np.empty(0, np.int64)
    blank = a == 32
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1  # behind the last byte
    if not len(starts):
        none = np.empty(0, np.int64)
        return Words(none, none, none, none.astype(np.uint64))
    text = np.searchsorted(begins, starts, "right") - 1

    # n-grams from the blank before a word on: 2-grams at every byte, 3- and 4-grams while they end at the blank behind it.
    size = ends - starts + 1
    offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    at = np.repeat(starts - 1, size) + offset
    left = np.repeat(ends, size) - at  # bytes up to the blank behind
    w = a.astype(np.uint64)
    two = w[at] | w[at + 1] << np.uint64(8)
    three = two | np.where(left >= 2, w[np.minimum(at + 2, len(a) - 1)], 0).astype(np.uint64) << np.uint64(16)
    four = three | np.where(left >= 3, w[np.minimum(at + 3, len(a) - 1)], 0).astype(np.uint64) << np.uint64(24)
    shift = np.uint64(64 - TABLE_BITS)
    rows = np.stack([(x + np.uint64(n)) * _MULTIPLIER >> shift for n, x in ((1 << 40, two), (2 << 40, three), (3 << 40, four))], axis=1)
    mixed = (four + np.uint64(1)) * _MULTIPLIER
    mixed ^= mixed >> np.uint64(29)
    mixed *= (offset.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F) | np.uint64(1)
    first = np.cumsum(size) - size
    return Words(text, rows.astype(np.int64).ravel(), 3 * first, np.add.reduceat(mixed, first))


def _runs(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run number and place in the run of each word; a run has up to ``RUN`` words of one text."""
    new = np.concatenate([[True], text[1:] != text[:-1]])
    begin = np.flatnonzero(new)
    place = np.arange(len(text)) - np.repeat(begin, np.diff(np.append(begin, len(text))))
    run = np.cumsum(new | (place % RUN == 0)) - 1
    return run, place % RUN


@dataclass
class Model:
    labels: list[str]
    table: np.ndarray  # weights of n-grams, then of lexicon words; the last row, zeros, is for words not in it
    lexicon: np.ndarray  # sorted word hashes
    change: np.ndarray  # weight of label j after label i
    start: np.ndarray

    def rows(self, words: Words) -> np.ndarray:
        """Of each word the table row of its lexicon entry."""
        if not len(self.lexicon):
            return np.full(len(words.key), (1 << TABLE_BITS))
        near = np.minimum(np.searchsorted(self.lexicon, words.key), len(self.lexicon) - 1)
        return (1 << TABLE_BITS) + np.where(self.lexicon[near] == words.key, near, len(self.lexicon))

    def scores(self, words: Words, rows: np.ndarray) -> np.ndarray:
        if not len(words.key):
            return np.zeros((0, len(self.labels)), np.float32)
        return np.add.reduceat(self.table[words.grams], words.first, axis=0) + self.table[rows]

    def marginals(self, words: Words, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label probabilities of each word, summed pair probabilities of neighbours, and of first words.

        Forward-backward over all runs at once, a step per place in the run.
        """
        e = self.scores(words, rows)
        n_labels = len(self.labels)
        if not len(e):
            return e, np.zeros((n_labels, n_labels)), np.zeros(n_labels)
        run, place = _runs(words.text)
        n, steps = run[-1] + 1, place.max() + 1
        grid = np.zeros((steps, n, n_labels), np.float32)
        grid[place, run] = np.exp(np.maximum(e - e.max(axis=1, keepdims=True), -60))
        there = np.zeros((steps, n, 1), bool)
        there[place, run] = True
        move = np.exp(self.change).astype(np.float32)
        forward = np.empty_like(grid)
        f = grid[0] * np.exp(self.start).astype(np.float32)
        forward[0] = f / f.sum(axis=1, keepdims=True)
        for t in range(1, steps):
            f = (forward[t - 1] @ move) * grid[t]
            total = f.sum(axis=1, keepdims=True)
            forward[t] = np.where(there[t], f / np.where(total > 0, total, 1), forward[t - 1])
        backward = np.ones((n, n_labels), np.float32)
        out = np.empty_like(grid)
        pairs = np.zeros((n_labels, n_labels))
        for t in range(steps - 1, -1, -1):
            p = forward[t] * backward
            out[t] = p / np.maximum(p.sum(axis=1, keepdims=True), 1e-30)
            if t:
                b = grid[t] * backward
                live = there[t][:, 0]
                joint = forward[t - 1][live][:, :, None] * move[None] * b[live][:, None, :]
                pairs += (joint / np.maximum(joint.sum(axis=(1, 2), keepdims=True), 1e-30)).sum(axis=0)
                nxt = b @ move.T
                backward = np.where(there[t], nxt / np.maximum(nxt.sum(axis=1, keepdims=True), 1e-30), backward)
        return out[place, run], pairs, out[0].sum(axis=0)


def fit(texts: Sequence[str], langs: Sequence[str], rounds: int = ROUNDS) -> Model:
    """Maximises the likelihood of the labels by full gradients with per-weight step sizes.

    The gradient is summed over pieces of ``FIT_AT_ONCE`` texts, which bounds the memory it takes.
    """
    labels = sorted(set(langs))
    n_labels = len(labels)
    pieces = []
    for at in range(0, len(texts), FIT_AT_ONCE):
        words = words_of(texts[at : at + FIT_AT_ONCE])
        if len(words.key):
            words.grams = words.grams.astype(np.int32)
            pieces.append((words, np.searchsorted(labels, langs[at : at + FIT_AT_ONCE])[words.text]))
    keys, n = np.unique(np.concatenate([w.key for w, _ in pieces]) if pieces else np.empty(0, np.uint64), return_counts=True)
    lexicon = np.sort(keys[np.argsort(-n, kind="stable")][:LEXICON])
    size = (1 << TABLE_BITS) + len(lexicon) + 1
    model = Model(labels, np.zeros((size, n_labels), np.float32), lexicon, np.zeros((n_labels, n_labels)), np.zeros(n_labels))
    if not pieces or n_labels < 2:
        return model
    stay, begin = np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    for words, gold in pieces:
        inner = _runs(words.text)[1] > 0
        np.add.at(stay, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
        begin += np.bincount(gold[~inner], minlength=n_labels)
    total = sum(len(gold) for _, gold in pieces)
    seen = [np.zeros_like(x) for x in (model.table, model.change, model.start)]
    for _ in range(rounds):
        table = np.zeros_like(model.table)
        pairs, first = np.zeros((n_labels, n_labels)), np.zeros(n_labels)
        for words, gold in pieces:
            rows = model.rows(words)
            p, their_pairs, their_first = model.marginals(words, rows)
            pairs += their_pairs
            first += their_first
            counts = np.diff(np.append(words.first, len(words.grams)))
            for k in range(n_labels):
                error = ((gold == k) - p[:, k]) / total
                table[:, k] += np.bincount(words.grams, np.repeat(error, counts), size) + np.bincount(rows, error, size)
        table -= DECAY * model.table
        table[-1] = 0  # words that are not in the lexicon
        steps = (table, (stay - pairs) / total, (begin - first) / total)
        for weights, step, sums in zip((model.table, model.change, model.start), steps, seen):
            sums += step * step
            weights += (LEARNING_RATE * step / (np.sqrt(sums) + 1e-8)).astype(weights.dtype)
    return model


def predict(model: Model, texts: Sequence[str | None]) -> list[tuple[str, float]]:
    """Language and score of each text; score is the expected share of words in that language."""
    words = words_of(texts)
    p, _, _ = model.marginals(words, model.rows(words))
    total = np.zeros((len(texts), len(model.labels)))
    for k in range(len(model.labels)):
        total[:, k] = np.bincount(words.text, p[:, k], len(texts)) if len(p) else 0
    n = total.sum(axis=1)
    out = []
    for i, t in enumerate(texts):
        if not t or not _LETTER.search(t) or not n[i]:
            out.append((UNKNOWN, 0.0))
        else:
            best = int(total[i].argmax())
            out.append((model.labels[best], float(min(1.0, total[i, best] / n[i]))))
    return out


def _in_parts(texts: Sequence[str | None]) -> Iterator[list[str | None]]:
    """Texts in groups of bounded size; a longer text is a group of its own."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size > _TEXT_BYTES_AT_ONCE:
            yield part
            part, size = [], 0
    if part:
        yield part


@F.pandas_udf(T.StringType())
def _one_run(text: pd.Series, pick: pd.Series) -> pd.Series:
    """A run of words of each text: the one that ``pick`` falls on."""

    def one(t: str, at: int) -> str:
        words = t.split()
        n = max(1, len(words) // RUN)
        return " ".join(words[at % n * RUN : (at % n + 1) * RUN])

    return pd.Series([one(t or "", at) for t, at in zip(text, pick)], dtype=object)


def train(docs: DataFrame, sequences: int = TRAIN_SEQUENCES) -> Model:
    """A model from the rows of ``docs`` with a language that are not held out.

    Of each language the documents with the smallest hash of the id are taken, one run of
    words from each: ``sequences`` runs in all at most, or 20 per language if that is more.
    Without labelled rows the model knows no language.
    """
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    named = labelled.select("lang", F.xxhash64("doc_id").alias("pick"), "text")
    sizes = stored(named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("lang", "_lang"), "lang-sizes")
    n_langs = max(1, sizes.count())
    each = max(20, sequences // n_langs)
    # A first cut by the hash alone leaves about twice as many as are wanted, wherever they stand; then the smallest are taken.
    drawn = named.join(F.broadcast(sizes), F.col("lang") == F.col("_lang"))  # one row per language
    draw = F.pmod("pick", F.lit(_DRAWS)).alias("draw")
    few = drawn.select("*", draw).where(F.col("draw") <= F.lit(2.0 * each * _DRAWS) / F.col("n"))
    runs = few.select("lang", "draw", "pick", _one_run("text", "draw").alias("run"))
    order = Window.partitionBy("lang").orderBy("draw", "pick", "run")
    chosen = runs.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= each)
    sample = sorted(chosen.select("lang", "draw", "pick", "run").collect())
    return fit([r.run for r in sample], [r.lang for r in sample])


def identify(docs: DataFrame, model: Model, *, text: str = "text") -> Column:
    """A column of structs (lang, score) for rows of ``docs``.

    A text that is NULL, empty or has no letter is ``und`` with score 0; so is every text
    if the model knows no language.
    """
    text_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(schema)
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            known = shared.value
            rows = [r for part in _in_parts(list(batch)) for r in (predict(known, part) if known.labels else [(UNKNOWN, 0.0)] * len(part))]
            yield pd.DataFrame(rows, columns=["lang", "score"])

    return predicted(F.col(text))


def languages(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs``.

    ``lang``, ``source`` and ``doc_id`` are no inputs of a prediction; ``lang`` and the id
    decide what is learned from. Repeated rows are all predicted. Further columns are ignored.
    """
    model = model or train(docs)
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), identify(docs, model).alias("found")
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def keep_languages(
    docs: DataFrame, min_score: float, wanted: Sequence[str] | None = None, model: Model | None = None
) -> DataFrame:
    """The rows of ``docs`` with a predicted language, one of ``wanted`` if given, and ``min_score`` at least."""
    model = model or train(docs)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    judged = docs.select(F.struct(*columns).alias("row"), identify(docs, model).alias("found"))
    good = (F.col("found.lang") != UNKNOWN) & (F.col("found.score") >= min_score)
    if wanted is not None:
        good = good & F.col("found.lang").isin(list(wanted))
    return judged.where(good).select("row.*")
