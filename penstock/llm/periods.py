"""Periodic runs of words, found through string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are the same) and at least
`REPEATS` * q words long that no neighbouring word extends. At each dyadic scale t a synchronising
set holds the positions whose own window of t words, or the one t further on, has the least hash
among the t + 1 windows in between: a choice that depends on the next 2 t words only, so equal
contexts are chosen alike. Every t starts in a row hold such a position unless they lie in a highly
periodic region, of period at most t / 4; those windows take no part. A run of period t <= q < 2 t
holds a chosen position among its first q, and its context comes again exactly q later, so each pair
of neighbouring equal contexts proposes a period. Periods below `SMALLEST` are detected directly, and
each scale's highly periodic regions are the runs already found. A proposal becomes a run only by
comparing the words themselves, so a clash of hashes costs time and changes nothing.

Documents are searched side by side, a few hundred thousand words at a time; the larger scales hold
only documents of at least 4 t words. Rows never leave their task, so no key can be hot.

Edge cases: a null or empty text, or one without words, has no run (n_runs 0, the four columns of the
greatest run null, both digests those of the empty string); a null doc_id counts as the empty string
wherever its digits are taken; repeated rows give repeated results; a text is searched whole whatever
its length, alone if it is longer than a block; an empty table gives no rows. Other columns than
doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPEATS = 4
SHORTEST = 6
# Periods below this are found by comparing each word with the one so many further on.
SMALLEST = 4
# Words searched side by side.
BLOCK = 300_000
NEVER = np.uint64(2**64 - 1)
FIELDS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of pairs."""
    h = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(31)))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def direct(x: np.ndarray, q: int) -> list[tuple[int, int, int]]:
    """(start, end, q) of all stretches of period q, smallest or not, of REPEATS * q words or more."""
    if len(x) <= q:
        return []
    first, last = stretches(x[q:] == x[:-q])
    long = last - first >= (REPEATS - 1) * q
    return [(s, e + q, q) for s, e in zip(first[long].tolist(), last[long].tolist())]


def chosen(window: np.ndarray, t: int, periodic: list[tuple[int, int, int]]) -> np.ndarray:
    """The synchronising set: positions i with a whole context of 2 t words. `window[i]` is the hash
    of the t words from i."""
    if len(window) <= t:
        return np.empty(0, np.int64)
    key = np.minimum(window, NEVER - np.uint64(1))
    if periodic:
        edge = np.zeros(len(window) + 1, np.int64)
        np.add.at(edge, [s for s, _, _ in periodic], 1)
        np.add.at(edge, [e - t + 1 for _, e, _ in periodic], -1)
        key = np.where(np.cumsum(edge[:-1]) > 0, NEVER, key)
    least, span = key, 1
    while span < t:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    return np.flatnonzero((least != NEVER) & ((least == key[:n]) | (least == key[t : t + n])))


def reach(x: np.ndarray, at: int, q: int, step: int) -> int:
    """The last position from `at` on, in direction `step`, up to which words equal those q further."""
    size = 64
    while True:
        if step > 0:
            a = x[at : at + size]
            same = a[: max(0, len(x) - q - at)] == x[at + q : at + q + size][: len(a)]
        else:
            low = max(0, at - size + 1)
            same = (x[low : at + 1] == x[low + q : at + 1 + q])[::-1]
        wrong = np.flatnonzero(~same)
        if len(wrong):
            return at + step * (int(wrong[0]) - 1)
        at += step * len(same)
        if len(same) < size:
            return at - step
        size *= 2


def runs(x: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of all runs of at least REPEATS periods in the documents laid
    end to end in `x`, each followed by a number that occurs nowhere else; `sizes`: their words."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, SMALLEST):
        for s, e, _ in direct(x, q):
            found.setdefault((s, e), q)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
    kept = np.arange(len(sizes))
    place, part, t = None, x, SMALLEST
    h = x.astype(np.uint64)
    h = mixed(h, h)
    span = 1
    while True:
        still = sizes[kept] >= REPEATS * t
        if not still.any():
            break
        if not still.all():
            # Only documents that can hold a run of this scale go on.
            each = np.repeat(still, sizes[kept] + 1)
            kept = kept[still]
            part, h = part[each], h[each[: len(h)]]
            place = (np.arange(len(each)) if place is None else place)[each]
            # Windows reach beyond their start: those across a removed document are worked out anew.
            h = mixed(part.astype(np.uint64), part.astype(np.uint64))
            span = 1
        while span < t:
            h = mixed(h[:-span], h[span:])
            span *= 2
        here = {}
        if found:
            shift = begin[kept] - np.concatenate(([0], np.cumsum(sizes[kept] + 1)))[:-1]
            for (s, e), q in found.items():
                if q * 4 <= t <= e - s:
                    d = int(np.searchsorted(begin, s, "right")) - 1
                    k = int(np.searchsorted(kept, d))
                    if k < len(kept) and kept[k] == d:
                        here[s - int(shift[k]), e - int(shift[k])] = q
        spots = chosen(h, t, [(s, e, q) for (s, e), q in here.items()])
        context = mixed(h[spots], h[spots + t])
        order = np.argsort(context, kind="stable")
        a, b = spots[order[:-1]], spots[order[1:]]
        gap = b - a
        near = (context[order[:-1]] == context[order[1:]]) & (gap >= t) & (gap < 2 * t)
        a, gap = a[near], gap[near]
        order = np.lexsort((a, gap))
        done: tuple[int, int] = (-1, 0)
        for at, q in zip(a[order].tolist(), gap[order].tolist()):
            if done[0] == q and at < done[1]:
                continue
            if part[at] != part[at + q]:
                continue
            low, high = reach(part, at, q, -1), reach(part, at, q, 1) + q + 1
            done = (q, high)
            if high - low >= REPEATS * q:
                whole = (low, high) if place is None else (int(place[low]), int(place[high - 1]) + 1)
                found.setdefault(whole, q)
        t *= 2
    return [(s, e, q) for (s, e), q in found.items()]


def planted(ids: np.ndarray, h: int) -> np.ndarray:
    """Positions of the words of the text to search: the words' own, or from a place on a repeat."""
    n = len(ids)
    if h % 10 or not n:
        return np.arange(n)
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


def described(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    """What the operator returns of one document; `found`: its runs, word numbers from 0."""
    found = sorted((s, e, q) for s, e, q in found if e - s >= SHORTEST)
    found.sort(key=lambda r: (r[0], r[2]))
    keep = np.ones(len(words), bool)
    for s, e, q in found:
        keep[s + q : e] = False
    kept = words if keep.all() else [words[i] for i in np.flatnonzero(keep).tolist()]
    best = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
    top = (None,) * 4
    if best:
        s, e, q = best
        top = (s, e - s, q, 1000 * (e - s) // q)
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    return (
        len(found),
        *top,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def block_rows(ids: list, crcs: list[int], texts: list[str | None], plant: bool) -> pa.RecordBatch:
    vocabulary: dict[bytes, int] = {}
    number = vocabulary.setdefault
    docs, parts, sizes, mark = [], [], [], -1
    for text, h in zip(texts, crcs):
        # Splits at the six characters that separate words.
        words = (text or "").encode().split()
        x = np.fromiter((number(w, len(vocabulary)) for w in words), np.int64, len(words))
        if plant:
            at = planted(x, h)
            if h % 10 == 0:
                words = [words[i] for i in at.tolist()]
            x = x[at]
        docs.append(words)
        parts += [x, np.array([mark])]
        sizes.append(len(x))
        mark -= 1
    sizes = np.array(sizes, np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes + 1)))
    own: dict[int, list] = {}
    for s, e, q in runs(np.concatenate(parts), sizes):
        d = int(np.searchsorted(begin, s, "right")) - 1
        own.setdefault(d, []).append((s - int(begin[d]), e - int(begin[d]), q))
    rows = [(i, *described(words, own.get(d, []))) for d, (i, words) in enumerate(zip(ids, docs))]
    columns = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:6]]
    columns += [pa.array(c, pa.string()) for c in list(zip(*rows))[6:]]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in FIELDS.split(",")])


def found_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """A row per document with its runs; with `plant`, texts whose id's checksum ends in 0 are made
    periodic from a place on first."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, crcs, texts, length = [], [], [], 0
        for batch in batches:
            for i, h, text in zip(*(c.to_pylist() for c in batch.columns)):
                size = len(text or "") // 5 + 1
                if ids and length + size > BLOCK:
                    yield block_rows(ids, crcs, texts, plant)
                    ids, crcs, texts, length = [], [], [], 0
                ids.append(i)
                crcs.append(h)
                texts.append(text)
                length += size
        if ids:
            yield block_rows(ids, crcs, texts, plant)

    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select("doc_id", crc.alias("crc"), "text").mapInArrow(search, FIELDS)
