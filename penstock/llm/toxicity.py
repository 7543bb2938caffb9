"""Toxic spans by a linear-chain conditional random field.

Documents are labelled, tokens are not. In a bounded sample of labelled documents, words and
beginnings of words are counted; those that stand out in toxic documents, beyond what chance explains
among so many, mark the tokens of toxic documents as toxic. On these tokens the field is trained: a
weight for each word and its beginnings, for the word before and the word after (hashed), and for each
change of state. Every document is then scored whole: forward-backward gives each token's marginal
probability, which are summed up to a score for the document, by a logistic fit to the sample's
labels, and to the offsets of the offending spans.

Inputs of a score are the words of the text alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.llm import common

# Bounds of what is fitted: documents whose words are counted, documents of each label whose tokens
# the field is trained on, tokens of a sequence.
SAMPLE = 12_000
TRAINED = 1500
SEQUENCE = 64
# Weights per position, a power of two.
SLOTS = 1 << 17
BLOCK = 128
CHUNK = 1_000_000
REMEMBERED = 400_000
BEGINNINGS = range(3, 9)
STRIPPED = ".,;:!?\"'()[]*&%$#|<>"
WORD = re.compile(common.WORD)


def units(word: bytes) -> list[str]:
    """A word in lower case without outer punctuation, and its beginnings, marked with a star."""
    plain = word.decode(errors="replace").lower().strip(STRIPPED)
    return [plain, *(plain[:k] + "*" for k in BEGINNINGS if len(plain) > k)]


def unit_column(text) -> F.Column:
    """As `units`, of all words of a text, each once."""
    plain = F.transform(common.words(F.lower(text)), lambda w: F.btrim(w, F.lit(STRIPPED)))
    begun = lambda w: F.filter(
        F.array(w, *[F.when(F.length(w) > k, F.concat(F.substring(w, 1, k), F.lit("*"))) for k in BEGINNINGS]),
        lambda u: u.isNotNull(),
    )
    return F.array_distinct(F.flatten(F.transform(F.array_distinct(plain), begun)))


def slots(word: bytes) -> list[int]:
    """The weights of a word: its own, then those of its beginnings. 0 means none."""
    return [1 + xxhash.xxh64_intdigest(u.encode()) % (SLOTS - 1) for u in units(word)]


WIDTH = 1 + len(BEGINNINGS)


class _Known(dict):
    """The row of each word in `rows`; frequent words are remembered."""

    def __init__(self, row) -> None:
        self.row, self.rows = row, []

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self.rows)
        self.rows.append(self.row(word))
        return found

    def numbers(self, raw: bytes) -> np.ndarray:
        words = raw.lower().split()
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))

    def emptied(self) -> None:
        if len(self.rows) > REMEMBERED:
            self.clear()
            self.rows.clear()


def shifted(found: np.ndarray, lengths: np.ndarray, by: int) -> np.ndarray:
    """The values of the word before (by 1) or after (-1), 0 beyond the border of a text."""
    out = np.zeros_like(found)
    ends = np.cumsum(lengths[lengths > 0])
    if len(found) and by > 0:
        out[1:] = found[:-1]
        out[np.concatenate(([0], ends[:-1]))] = 0
    elif len(found):
        out[:-1] = found[1:]
        out[ends - 1] = 0
    return out


@dataclass(frozen=True)
class Field:
    """weights: (3, SLOTS) added to the odds of a toxic token; moves: log weight of state i to j;
    document: what bias, expected toxic tokens (log), highest marginal and their density add."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray
    document: np.ndarray

    def gains(self, word: bytes) -> tuple[float, float, float]:
        """What a word adds to the odds of itself, of the word after it and of the word before it."""
        own = slots(word)
        return float(self.weights[0][own].sum()), float(self.weights[1][own[0]]), float(self.weights[2][own[0]])

    def odds(self, gains: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        before, after = shifted(gains[:, 1], lengths, 1), shifted(gains[:, 2], lengths, -1)
        return self.bias + gains[:, 0] + before + after


def marginals(odds: np.ndarray, lengths: np.ndarray, moves: np.ndarray, expected: bool = False):
    """Probability of each token being toxic, of texts laid end to end; the state before a text is
    clean. With `expected` also how often each change of state is expected.

    Texts are cut into blocks. Products of the transfer matrices of all blocks come first, side by
    side; from them the states at block borders, along each text; then the tokens of all blocks,
    again side by side. So a long text costs no more steps than its blocks."""
    lengths = lengths[lengths > 0]
    if not len(lengths):
        empty = np.zeros(0)
        return (empty, np.zeros((2, 2))) if expected else empty
    per_text = -(-lengths // BLOCK)
    n = int(per_text.sum())
    first = np.concatenate(([0], np.cumsum(per_text)[:-1]))
    width = int(min(BLOCK, lengths.max()))
    text = np.repeat(np.arange(len(lengths)), per_text)
    within = np.arange(n) - first[text]
    start = np.concatenate(([0], np.cumsum(lengths)[:-1]))[text] + within * BLOCK
    size = np.minimum(BLOCK, lengths[text] - within * BLOCK)
    move = np.exp(moves)
    gain = np.exp(np.clip(odds, -30, 30))
    step = np.arange(width)
    there = step[None, :] < size[:, None]
    grid = np.where(there, gain[np.minimum(start[:, None] + step, len(odds) - 1)], 1.0)

    def scaled(x: np.ndarray) -> np.ndarray:
        return x / x.sum(axis=-1, keepdims=True)

    def advance(alpha: np.ndarray, t: int) -> np.ndarray:
        moved = alpha @ move
        moved[..., 1] *= grid[:, t].reshape(-1, *[1] * (moved.ndim - 2))
        live = there[:, t].reshape(-1, *[1] * (moved.ndim - 1))
        return np.where(live, moved, alpha)

    product = np.broadcast_to(np.eye(2), (n, 2, 2)).copy()
    for t in range(width):
        product = advance(product, t)
        product /= product.sum(axis=(1, 2), keepdims=True)
    enter, leave = np.zeros((n, 2)), np.ones((n, 2)) / 2
    enter[first, 0] = 1.0
    for k in range(1, int(per_text.max())):
        at = first[per_text > k] + k
        enter[at] = scaled(np.einsum("bi,bij->bj", enter[at - 1], product[at - 1]))
    for k in range(int(per_text.max()) - 1, 0, -1):
        at = first[per_text > k] + k
        leave[at - 1] = scaled(np.einsum("bij,bj->bi", product[at], leave[at]))
    alphas = np.empty((width + 1, n, 2))
    alphas[0] = enter
    for t in range(width):
        alphas[t + 1] = scaled(advance(alphas[t], t))
    out = np.empty(len(odds))
    beta, changes = leave, np.zeros((2, 2))
    for t in range(width - 1, -1, -1):
        live = there[:, t]
        p = scaled(alphas[t + 1] * beta)[:, 1]
        out[start[live] + t] = p[live]
        after = beta * np.stack([np.ones(n), grid[:, t]], axis=1)
        if expected:
            joint = alphas[t][:, :, None] * move[None] * after[:, None, :]
            changes += (joint / joint.sum(axis=(1, 2), keepdims=True))[live].sum(axis=0)
        beta = np.where(live[:, None], scaled(after @ move.T), beta)
    return (out, changes) if expected else out


def train(found: np.ndarray, lengths: np.ndarray, toxic: np.ndarray, rounds: int = 60) -> Field:
    """The field of highest likelihood for the token labels, with a quadratic penalty, by adaptive
    gradient steps. found: (tokens, WIDTH) weights of the words; lengths: of texts, which are cut
    into sequences of SEQUENCE tokens."""
    before, after = shifted(found[:, 0], lengths, 1), shifted(found[:, 0], lengths, -1)
    groups = [[found[:, k] for k in range(WIDTH)], [before], [after]]
    full, rest = lengths // SEQUENCE, lengths % SEQUENCE
    cut = np.concatenate([np.append(np.full(f, SEQUENCE), r) for f, r in zip(full, rest)] or [np.zeros(0, int)])
    cut = cut[cut > 0]
    seen = np.zeros((2, 2))
    np.add.at(seen, (shifted(toxic, cut, 1).astype(int), toxic.astype(int)), 1)
    share = min(max(toxic.mean(), 1e-4), 0.5)
    weights, bias, moves = np.zeros((3, SLOTS)), math.log(share / (1 - share)), np.zeros((2, 2))
    sums, bias_sum, move_sum = np.full((3, SLOTS), 1e-8), 1e-8, np.full((2, 2), 1e-8)
    rate, penalty = 0.5, 0.05
    for _ in range(rounds):
        weights[:, 0] = 0
        odds = bias + sum(weights[k][column] for k in range(3) for column in groups[k])
        p, changes = marginals(odds, cut, moves, expected=True)
        wrong = toxic - p
        for k in range(3):
            slope = sum(np.bincount(c, weights=wrong, minlength=SLOTS) for c in groups[k]) - penalty * weights[k]
            sums[k] += slope**2
            weights[k] += rate * slope / np.sqrt(sums[k])
        slope = wrong.sum()
        bias_sum += slope**2
        bias += rate * slope / math.sqrt(bias_sum)
        slopes = seen - changes - penalty * moves
        move_sum += slopes**2
        moves = moves + rate * slopes / np.sqrt(move_sum)
    weights[:, 0] = 0
    return Field(weights.astype(np.float32), float(bias), moves, np.zeros(4))


def summary(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per text: 1, log of 1 + expected toxic tokens, highest marginal, expected share."""
    out = np.zeros((len(lengths), 4))
    out[:, 0] = 1
    some = np.flatnonzero(lengths)
    if len(some):
        starts = np.concatenate(([0], np.cumsum(lengths[some])[:-1])).astype(int)
        total = np.add.reduceat(p, starts)
        out[some, 1] = np.log1p(total)
        out[some, 2] = np.maximum.reduceat(p, starts)
        out[some, 3] = total / lengths[some]
    return out


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic fit, by Newton steps with a small penalty."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * 0.1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
    return w


def marks(sample: DataFrame) -> list[str]:
    """Units that mark toxic documents: most documents that have one are toxic, and by the signed
    root of the likelihood ratio more so than the largest of as many chance values would be."""
    each = sample.select("toxic", F.explode(unit_column(F.coalesce("text", F.lit("")))).alias("unit"))
    counts = each.groupBy("unit").agg(F.sum("toxic").cast("double").alias("a"), F.count("*").cast("double").alias("n"))
    counts = common.stored(counts.where("n >= 3"), "units")
    toxic, total = (float(x or 0) for x in sample.agg(F.sum("toxic"), F.count("*")).first())
    if not toxic:
        return []
    kinds, share = counts.count(), toxic / total
    a, n = F.col("a"), F.col("n")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (
        part(a, n * share)
        + part(n - a, n * (1 - share))
        + part(toxic - a, toxic - n * share)
        + part(total - toxic - n + a, (total - n) * (1 - share))
    )
    least = 2 * math.log(kinds + 1)
    return [r["unit"] for r in counts.where((2 * a > n) & (ratio > least)).select("unit").collect()]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, trained: int = TRAINED) -> Field:
    """The field for `labels` (`doc_id`, `toxic` 0 or 1). Both bounds hold whatever the size of the
    tables: of the labelled ids the `sample` whose hashes come first are taken, broadcast, and their
    documents' words counted; the `trained` documents of each label that come first among these are
    collected, and with them the units that mark toxicity. Without labels the score is 0.5."""
    place = F.xxhash64("doc_id")
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    ids = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(place, "doc_id").limit(sample)
    some = common.stored(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id"),
        "sample",
    )
    marked = set(marks(some))
    rows = [
        row
        for label in (0, 1)
        for row in some.where(F.col("toxic") == label).orderBy(place, "text").limit(trained).collect()
    ]
    seen = _Known(lambda word: (units(word), slots(word)))
    texts = [seen.numbers(r["text"].encode()) for r in rows]
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    if not lengths.sum():
        return Field(np.zeros((3, SLOTS), np.float32), 0.0, np.zeros((2, 2)), np.zeros(4))
    table = np.array([w + [0] * (WIDTH - len(w)) for _, w in seen.rows], dtype=np.int32)
    hit = np.array([not marked.isdisjoint(u) for u, _ in seen.rows], dtype=float)
    whole = np.concatenate(texts)
    labelled = np.array([r["toxic"] for r in rows], dtype=float)
    field = train(table[whole], lengths, hit[whole] * np.repeat(labelled, lengths))
    gains = np.array([field.gains(word) for word in seen])[whole]
    p = marginals(field.odds(gains, lengths), lengths, field.moves)
    # The sample holds more toxic documents than the labels do: weighted back.
    share = min(max(some.agg(F.avg("toxic")).first()[0], 1e-3), 1 - 1e-3)
    weight = np.where(labelled == 1, share / max(labelled.mean(), 1e-9), (1 - share) / max(1 - labelled.mean(), 1e-9))
    return Field(field.weights, field.bias, field.moves, logistic(summary(p, lengths), labelled, weight))


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Offsets (in characters) and mean probability of runs of tokens that are rather toxic."""
    hit = np.flatnonzero(p >= 0.5)
    if not len(hit):
        return []
    places = [m.span() for m in WORD.finditer(text)]
    runs = np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1)
    return [
        {"start": places[r[0]][0], "end": places[r[-1]][1], "probability": float(p[r].mean())} for r in runs
    ]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))


def _score_batches(batches: Iterator[pa.RecordBatch], field: Field) -> Iterator[pa.RecordBatch]:
    known = _Known(field.gains)
    held: list[tuple] = []
    size = 0

    def scored() -> pa.RecordBatch:
        lengths = np.array([len(h[2]) for h in held], dtype=np.int64)
        whole = np.concatenate([h[2] for h in held])
        gains = np.array(known.rows or [(0.0, 0.0, 0.0)])[whole]
        p = marginals(field.odds(gains, lengths), lengths, field.moves)
        odds = summary(p, lengths) @ field.document
        ends = np.cumsum(lengths)
        spans = [_spans(h[1], p[e - n : e]) for h, e, n in zip(held, ends, lengths)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([h[0] for h in held], pa.int64()),
                pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500)))),
                pa.array(spans, SPANS),
            ],
            names=["doc_id", "score", "spans"],
        )

    for batch in batches:
        for id_, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = text.as_py() or ""
            held.append((id_, text, known.numbers(text.encode())))
            size += len(held[-1][2]) + 1
            if size >= CHUNK:
                yield scored()
                held, size = [], 0
                known.emptied()
    if held:
        yield scored()


def score(docs: DataFrame, field: Field) -> DataFrame:
    """`doc_id`, `score` (0 to 1), and `spans` (start, end in characters, mean probability) of every
    row. Null and empty texts have the score of a text without toxic tokens, and no spans."""
    fields = "doc_id bigint, score double, spans array<struct<start:bigint,end:bigint,probability:double>>"
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(partial(_score_batches, field=field), fields)
