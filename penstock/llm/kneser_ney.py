"""Scores of an interpolated modified Kneser-Ney model of word pairs.

Spark counts; workers keep what is counted as sorted arrays in raw files of the shared folder and
map those files into memory to score. Words are known by 64-bit hashes. The sorted hashes of all
training words are the vocabulary, and a word's number is its place there. A pair is one integer,
the number of the first word over that of the second; pairs lie in buckets, sorted, with counts.

Map tasks count pairs of a few million tokens at a time and send each bucket one row of arrays, so
the shuffle moves sorted numbers, not rows of words. The bucket of a pair follows from its first
word; words more frequent than a bucket is large are dealt by the second word also.

The shared folder must be one that workers can open (file:), as a mounted store is on a cluster.
"""

from __future__ import annotations

import math
import mmap
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.llm import common
from penstock.session import scratch_path

# Tokens that a task counts, or scores, at a time.
CHUNK = 2_000_000
SCORED = 400_000
BUCKET_TOKENS = 4_000_000
PART_WORDS = 1_000_000
REMEMBERED = 400_000
# No word holds white space, so these are hashes of none.
END = xxhash.xxh64_intdigest(b"\n")
UNKNOWN = (1 << 32) - 1


class _Hashes(dict):
    """Hashes of words, those of frequent ones remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def tokens(raw: bytes, hashes: dict) -> np.ndarray:
    """Hashes of the words of a text, A-Z in lower case, and of the end."""
    words = raw.lower().split()
    out = np.empty(len(words) + 1, dtype=np.uint64)
    out[:-1] = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    out[-1] = END
    return out


def _chunks(
    batches: Iterator[pa.RecordBatch], least: int = CHUNK
) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """(tokens, first token of each document, ids) of so many documents that there are `least` tokens."""
    hashes = _Hashes()
    held, ids, size = [], [], 0

    def full():
        starts = np.concatenate(([0], np.cumsum([len(h) for h in held])[:-1])).astype(np.int64)
        return np.concatenate(held), starts, ids

    for batch in batches:
        for id_, raw in zip(batch.column("id").to_pylist(), batch.column("raw")):
            held.append(tokens(raw.as_py() or b"", hashes))
            ids.append(id_)
            size += len(held[-1])
            if size >= least:
                yield full()
                held, ids, size = [], [], 0
    if held:
        yield full()


def _raw(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("raw")
    )


def _save(path: str, array: np.ndarray) -> None:
    """All attempts of a task write the same bytes, and the last one to end puts them in place."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    own = f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
    array.tofile(own)
    os.replace(own, path)


def _mapped(path: str, kind) -> np.ndarray:
    if not os.path.exists(path) or not os.path.getsize(path):
        return np.empty(0, dtype=kind)
    with open(path, "rb") as file:
        return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), dtype=kind)


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found, _, _ in _chunks(batches):
        words, counts = np.unique(found, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), pa.array(counts.astype(np.int64))], names=["word", "n"]
        )


def _part_batches(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part and word become one file of hashes and one of counts for each part."""
    part, words, counts = None, [], []

    def save() -> pa.RecordBatch:
        hashes = np.concatenate(words).view(np.uint64)
        order = np.argsort(hashes)
        total = np.concatenate(counts)[order]
        _save(f"{folder}/words-{part}", hashes[order])
        _save(f"{folder}/counts-{part}", total)
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([len(total)]), pa.array([int(total.sum())])],
            names=["part", "size", "tokens"],
        )

    for batch in batches:
        parts = batch.column("part").to_numpy()
        for value in np.unique(parts):
            mask = parts == value
            if part is not None and value != part:
                yield save()
                words, counts = [], []
            part = int(value)
            words.append(batch.column("word").to_numpy()[mask])
            counts.append(batch.column("n").to_numpy()[mask])
    if words:
        yield save()


@dataclass(frozen=True)
class Vocabulary:
    """Where the training words lie: `parts` files by the upper bits of the hash. firsts: the
    number of each part's first word; the number after the last word stands for a text's start."""

    folder: str
    bits: int
    firsts: tuple[int, ...]
    size: int
    tokens: int
    texts: int
    buckets: int

    @property
    def start(self) -> int:
        return self.size

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number or UNKNOWN, count) of sorted hashes."""
        numbers = np.full(len(hashes), UNKNOWN, dtype=np.uint64)
        counts = np.zeros(len(hashes), dtype=np.int64)
        for part, lo, hi in self._cuts(hashes):
            known, n = _files(self.folder, part)
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, hashes[lo:hi]), len(known) - 1)
            hit = known[at] == hashes[lo:hi]
            numbers[lo:hi][hit] = at[hit] + self.firsts[part]
            counts[lo:hi][hit] = n[at[hit]]
        return numbers, counts

    def _cuts(self, hashes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        parts = (hashes >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), int)
        edges = np.flatnonzero(np.diff(parts)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(hashes)]):
            if hi > lo:
                yield int(parts[lo]), lo, hi

    def bucket(self, first: np.ndarray, second: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Bucket of pairs, from the numbers and the first word's count."""
        mixed = first * np.uint64(0x9E3779B97F4A7C15)
        hot = count > BUCKET_TOKENS // 8
        mixed = np.where(hot, (mixed ^ second) * np.uint64(0xBF58476D1CE4E5B9), mixed)
        return ((mixed >> np.uint64(33)) % np.uint64(self.buckets)).astype(np.int64)


@lru_cache(maxsize=4096)
def _files(folder: str, part: int) -> tuple[np.ndarray, np.ndarray]:
    return _mapped(f"{folder}/words-{part}", np.uint64), _mapped(f"{folder}/counts-{part}", np.int64)


@lru_cache(maxsize=4096)
def _stats(folder: str, part: int) -> np.ndarray:
    return _mapped(f"{folder}/stats-{part}", np.uint32).reshape(-1, 4)


@lru_cache(maxsize=4096)
def _pairs(folder: str, bucket: int) -> tuple[np.ndarray, ...]:
    """Keys, counts (255 for all from 255 on), and the places and counts of those from 255 on."""
    return (
        _mapped(f"{folder}/pairs-{bucket}", np.uint64),
        _mapped(f"{folder}/times-{bucket}", np.uint8),
        _mapped(f"{folder}/many-{bucket}", np.int64).reshape(2, -1),
    )


def _numbered(found: np.ndarray, starts: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
    """(first word, second word, count of the first, count of the second) of all pairs."""
    words, place = np.unique(found, return_inverse=True)
    numbers, counts = vocabulary.numbers(words)
    second, n_second = numbers[place], counts[place]
    first, n_first = np.empty_like(second), np.empty_like(n_second)
    first[1:], n_first[1:] = second[:-1], n_second[:-1]
    first[starts], n_first[starts] = vocabulary.start, vocabulary.texts
    return first, second, n_first, n_second


def _pair_batches(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for found, starts, _ in _chunks(batches):
        first, second, n_first, _ = _numbered(found, starts, vocabulary)
        bucket = vocabulary.bucket(first, second, n_first)
        rows = []
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(vocabulary.buckets + 1))
        keys = ((first << np.uint64(32)) | second)[order]
        for b in np.flatnonzero(np.diff(edges)):
            some, times = np.unique(keys[edges[b] : edges[b + 1]], return_counts=True)
            upper = np.diff((some >> np.uint64(32)).astype(np.uint32), prepend=np.uint32(0))
            lower = (some & np.uint64(UNKNOWN)).astype(np.uint32)
            rows.append((int(b), upper.tobytes(), lower.tobytes(), times.astype(np.uint32).tobytes()))
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.binary()) for c in columns[1:])],
            names=["bucket", "upper", "lower", "times"],
        )


def _bucket_table(table: pa.Table, folder: str) -> pa.Table:
    """Writes one bucket; gives for every word in it how many pairs it begins that occur once, twice
    and more often, and how many it ends. Number -1: pairs that occur once to four times."""
    keys, times = [], []
    for upper, lower, n in zip(*(table.column(c).to_pylist() for c in ("upper", "lower", "times"))):
        high = np.cumsum(np.frombuffer(upper, np.uint32), dtype=np.uint32).astype(np.uint64)
        keys.append((high << np.uint64(32)) | np.frombuffer(lower, np.uint32))
        times.append(np.frombuffer(n, np.uint32))
    bucket = table.column("bucket")[0].as_py()
    every, n = np.concatenate(keys), np.concatenate(times).astype(np.int64)
    order = np.argsort(every, kind="stable")
    every, n = every[order], n[order]
    heads = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
    some, total = every[heads], np.add.reduceat(n, heads)
    many = np.flatnonzero(total >= 255)
    _save(f"{folder}/pairs-{bucket}", some)
    _save(f"{folder}/times-{bucket}", np.minimum(total, 255).astype(np.uint8))
    _save(f"{folder}/many-{bucket}", np.stack([many, total[many]]))

    first, place = np.unique(some >> np.uint64(32), return_inverse=True)
    begins = [np.bincount(place[m], minlength=len(first)) for m in (total == 1, total == 2, total > 2)]
    second, ends = np.unique(some & np.uint64(UNKNOWN), return_counts=True)
    of = [int((total == k).sum()) for k in (1, 2, 3, 4)]
    none = np.zeros(len(second), dtype=np.int64)
    columns = [
        np.concatenate([[-1], first.astype(np.int64), second.astype(np.int64)]),
        *(np.concatenate([[of[i]], begins[i], none]) for i in range(3)),
        np.concatenate([[of[3]], np.zeros(len(first), dtype=np.int64), ends]),
    ]
    return pa.table([pa.array(c.astype(np.int64)) for c in columns], names=["word", "n1", "n2", "n3", "ends"])


def _stat_batches(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Rows of one part after the other, sorted by word, become a file for each part."""
    part, rows = None, []

    def save() -> pa.RecordBatch:
        _save(f"{folder}/stats-{part}", np.concatenate(rows))
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32())], names=["part"])

    for batch in batches:
        parts = batch.column("part").to_numpy()
        stats = np.stack([batch.column(c).to_numpy() for c in ("n1", "n2", "n3", "ends")], axis=1).astype(np.uint32)
        for value in np.unique(parts):
            if part is not None and value != part:
                yield save()
                rows = []
            part = int(value)
            rows.append(stats[parts == value])
    if rows:
        yield save()


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney, from how many counts are 1, 2, 3 and 4; usual
    values where there are too few counts to tell."""
    if not (n1 and n2 and n3 and n4):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))


@dataclass(frozen=True)
class Model:
    """A vocabulary, its pairs, and what is the same for all words."""

    vocabulary: Vocabulary
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    pair_kinds: int
    spare: float
    start_stats: tuple[int, int, int]

    def stats(self, numbers: np.ndarray) -> np.ndarray:
        """(n1, n2, n3, ends) of sorted word numbers; zeros for unknown ones."""
        out = np.zeros((len(numbers), 4), dtype=np.float64)
        v = self.vocabulary
        cuts = np.searchsorted(numbers, np.array([*v.firsts, v.size], dtype=np.uint64))
        for part, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
            if hi > lo:
                out[lo:hi] = _stats(v.folder, part)[(numbers[lo:hi] - np.uint64(v.firsts[part])).astype(np.int64)]
        out[numbers == v.start, :3] = self.start_stats
        return out

    def pair_counts(self, first: np.ndarray, second: np.ndarray, n_first: np.ndarray) -> np.ndarray:
        v = self.vocabulary
        out = np.zeros(len(first), dtype=np.int64)
        asked = np.flatnonzero((first != UNKNOWN) & (second != UNKNOWN))
        first, second = first[asked], second[asked]
        bucket = v.bucket(first, second, n_first[asked])
        keys = (first << np.uint64(32)) | second
        order = np.lexsort((keys, bucket))
        edges = np.searchsorted(bucket[order], np.arange(v.buckets + 1))
        for b in np.flatnonzero(np.diff(edges)):
            mine = order[edges[b] : edges[b + 1]]
            known, times, many = _pairs(v.folder, int(b))
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, keys[mine]), len(known) - 1)
            n = np.where(known[at] == keys[mine], times[at], 0).astype(np.int64)
            if many.shape[1]:
                large = n == 255
                n[large] = many[1][np.searchsorted(many[0], at[large])]
            out[asked[mine]] = n
        return out

    def log10(self, found: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability, training count) of each token."""
        v = self.vocabulary
        first, second, n_first, n_second = _numbered(found, starts, v)

        def of(numbers: np.ndarray) -> np.ndarray:
            single, place = np.unique(numbers, return_inverse=True)
            return self.stats(single)[place]

        ends = of(second)[:, 3]
        uniform = 1 / (v.size + 1)
        lower = self._less(ends, self.word_discounts) / max(self.pair_kinds, 1) + self.spare * uniform
        n = self.pair_counts(first, second, n_first)
        seen = n_first > 0
        saved = of(first)[:, :3] @ np.array(self.pair_discounts)
        size = np.maximum(n_first, 1)
        both = self._less(n.astype(np.float64), self.pair_discounts) / size + saved / size * lower
        return np.log10(np.where(seen, both, lower)), n_second

    @staticmethod
    def _less(n: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
        return n - np.where(n >= 3, d[2], np.where(n == 2, d[1], np.where(n == 1, d[0], 0.0)))


def _vocabulary(train: DataFrame) -> Vocabulary:
    spark = train.sparkSession
    folder = urlparse(scratch_path(spark, "words"))
    if folder.scheme not in ("", "file"):
        raise ValueError(f"workers cannot map files of {folder.scheme}: into memory")
    folder = folder.path
    words = common.stored(
        _raw(train).mapInArrow(_word_batches, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")),
        "counts",
    )
    size, total = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if size >= UNKNOWN - 1:
        raise ValueError("too many words for 32 bits")
    bits = max(0, math.ceil(math.log2(max(1, size / PART_WORDS))))
    upper = F.shiftrightunsigned("word", 64 - bits).cast("int") if bits else F.lit(0)
    parts = words.withColumn("part", upper).repartition(1 << bits, "part").sortWithinPartitions("part")
    sizes = parts.mapInArrow(partial(_part_batches, folder=folder), "part int, size bigint, tokens bigint")
    by_part = {r["part"]: r["size"] for r in sizes.collect()}
    firsts, at = [], 0
    for part in range(1 << bits):
        firsts.append(at)
        at += by_part.get(part, 0)
    texts = train.count()
    return Vocabulary(folder, bits, tuple(firsts), size, total, texts, max(1, -(-total // BUCKET_TOKENS)))


def fit(train: DataFrame) -> Model:
    """Counts all words and pairs of all of `train` (`doc_id`, `text`). Collected: sizes of parts,
    counts of counts, and the statistics of the start of a text."""
    vocabulary = _vocabulary(train)
    counted = _raw(train).mapInArrow(
        partial(_pair_batches, vocabulary=vocabulary),
        "bucket int, upper binary, lower binary, times binary",
    )
    folder = vocabulary.folder

    def reduce(table: pa.Table) -> pa.Table:
        return _bucket_table(table, folder)

    found = counted.groupBy("bucket").applyInArrow(
        reduce, "word bigint, n1 bigint, n2 bigint, n3 bigint, ends bigint"
    )
    sums = [F.sum(c).alias(c) for c in ("n1", "n2", "n3", "ends")]
    stats = common.stored(found.groupBy("word").agg(*sums), "stats")
    special = {
        r["word"]: (r["n1"], r["n2"], r["n3"], r["ends"])
        for r in stats.where((F.col("word") == -1) | (F.col("word") == vocabulary.start)).collect()
    }
    own = stats.where((F.col("word") >= 0) & (F.col("word") < vocabulary.size))
    kinds = own.select(
        *[F.coalesce(F.sum((F.col("ends") == k).cast("long")), F.lit(0)) for k in (1, 2, 3, 4)],
        F.coalesce(F.sum((F.col("ends") > 2).cast("long")), F.lit(0)),
        F.coalesce(F.sum("ends"), F.lit(0)),
    ).first()
    sorted_ = (
        own.withColumn("part", _part_of(vocabulary))
        .repartition(len(vocabulary.firsts), "part")
        .sortWithinPartitions("part", "word")
    )
    sorted_.mapInArrow(partial(_stat_batches, folder=folder), "part int").collect()
    d = discounts(*kinds[:4])
    spare = (d[0] * kinds[0] + d[1] * kinds[1] + d[2] * kinds[4]) / kinds[5] if kinds[5] else 1.0
    return Model(
        vocabulary,
        discounts(*special.get(-1, (0, 0, 0, 0))),
        d,
        int(kinds[5]),
        spare,
        special.get(vocabulary.start, (0, 0, 0, 0))[:3],
    )


def _part_of(vocabulary: Vocabulary):
    """The last part whose first word is not behind the word. Empty parts are no one's."""
    firsts = F.array(*[F.lit(f).cast("long") for f in vocabulary.firsts])
    return (F.size(F.filter(firsts, lambda f: f <= F.col("word"))) - 1).cast("int")


def _score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    v = model.vocabulary
    for found, starts, ids in _chunks(batches, SCORED):
        score, n = model.log10(found, starts)
        base = np.log10((n + 0.1) / (v.tokens + 0.1 * (v.size + 1)))
        sizes = np.diff(np.append(starts, len(found)))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(sizes),
                pa.array(np.add.reduceat((n > 0).astype(np.int64), starts)),
                pa.array(np.add.reduceat(base, starts)),
                pa.array(np.add.reduceat(score, starts)),
            ],
            names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
        )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id`, `n_tokens` (words and the end), `n_known` (tokens seen in training), `base_score`
    (log10 probability by single words with 0.1 added to each count), `score` (by the model) and
    `perplexity`, for every row. Null and empty texts are the end alone."""
    fields = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    found = _raw(docs).mapInArrow(partial(_score_batches, model=model), fields)
    return found.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
