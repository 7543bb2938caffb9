"""Removal of every byte that lies in a string of `length` bytes found twice, by suffix sorting.

Repeats are judged between all starts of all texts, the same text included, and overlap freely. To
sort one suffix per byte would shuffle many times the corpus, so suffixes are sorted where they can
matter. Each window of `length` bytes is assigned to its anchor, the gram of `GRAM` bytes in it with
the least hash (the first of equals): a choice made by the window's bytes alone, so equal windows
have equal anchors at equal offsets. Neighbouring windows mostly share an anchor; one row stands for
all windows of one anchor, their union is its stretch of text.

1. Anchors whose gram occurs once go: their windows occur once. Grams are counted before the shuffle.
2. Anchors whose whole stretch recurs need no look at the text: all their windows recur.
3. What is left under one gram, one row for each different stretch, is sorted: suffixes from the
   anchor on, and reversed prefixes before it, both by deep-shallow sorting: multikey quicksort over
   the first `SHALLOW` bytes, blind tries for the groups that agree that far. Two windows that start
   `o` bytes before their anchors are equal when the suffixes share `length - o` bytes and the
   prefixes `o`; both are ranges between neighbours in the sorted orders.
4. A gram with more than `LIMIT` different stretches would put a group without bound into one task.
   Its windows are counted by hash instead, ranges of offsets first and single ones where a range is
   not alike throughout. That is exact as well, and what has no match is all that a key can hold.

Texts are known by 96 bits of hashes, stretches by 96, parts of step 4 by 128 and their offset.

Edge cases: a null text is empty; texts shorter than `length` lose nothing; equal texts of `length`
bytes or more, repeated rows included, lose everything in every copy; a null doc_id is as good as any
other; texts of any length are cut whole, `PART` bytes at a time with an overlap; an empty table gives
no rows. Removed bytes may cut a character, so what is kept is binary. All columns of the documents
come back in the struct `row`, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from penstock.llm import common

LENGTH = 200
GRAM = 32
# Different stretches of one gram that one task sorts together.
LIMIT = 1024
# Bytes that multikey quicksort looks at before blind tries take over.
SHALLOW = 64
# Parts of a range of offsets.
FAN = 4
# Stretches sorted side by side.
BLOCK = 8192
PART = 4_000_000
# Fixed random numbers for byte values.
TABLE = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

ANCHOR = "d1 long, d2 long, pos long, lo int, hi int, gram long, stretch int"
FOUND = "d1 long, d2 long, start long, end long"


# Anchors


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each place."""
    h, span, factor = TABLE[data], 1, 0x9E3779B97F4A7C15
    while span < GRAM:
        h = h[:-span] * np.uint64(factor) + h[span:]
        h ^= h >> np.uint64(29)
        span, factor = span * 2, (factor * factor + 2) % 2**64 | 1
    return h * np.uint64(0xBF58476D1CE4E5B9)


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Anchor, first and last window and gram of each stretch of `data`, at most 2^24 bytes."""
    h = gram_hashes(np.frombuffer(data, np.uint8))
    width = length - GRAM + 1
    # The place in the low bits makes the least key the first of equal hashes, and tells where it is.
    least = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    at = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(np.diff(at)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(at)])) - 1
    anchor = at[first]
    return anchor, first, last, h[anchor]


def anchor_rows(docs: DataFrame, length: int) -> DataFrame:
    """A row for each stretch; windows start `lo` to `hi` bytes before the anchor at `pos`."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d1, d2, text in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode()
                for base in range(0, len(data) - length + 1, PART):
                    part = data[base : base + PART + length - 1]
                    if len(part) < length:
                        break
                    at, first, last, gram = anchors(part, length)
                    bounds = zip(first.tolist(), (last + length).tolist())
                    stretch = [xxhash.xxh3_64_intdigest(part[s:e]) & 0x7FFFFFFF for s, e in bounds]
                    n = len(at)
                    rows.append(
                        (np.full(n, d1), np.full(n, d2), at + base, at - last, at - first, gram.view(np.int64), stretch)
                    )
            if rows:
                kinds = [np.int64] * 3 + [np.int32] * 2 + [np.int64, np.int32]
                columns = [np.concatenate([np.asarray(x, k) for x in c]) for c, k in zip(zip(*rows), kinds)]
                names = [f.split()[0] for f in ANCHOR.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return docs.select("d1", "d2", "text").mapInArrow(found, ANCHOR)


# Deep-shallow sorting


def quicksorted(words: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of the rows of `words` inside their groups (numbers in ascending order).
    All open segments are split in three at once, around a pivot each; the part equal to its pivot
    goes on with the next word. Returns the order and the starts of segments of equal rows."""
    order = np.arange(len(words))
    starts = np.flatnonzero(np.concatenate(([True], np.diff(groups) != 0)))
    depth = np.zeros(len(starts), np.int64)
    while True:
        sizes = np.diff(np.concatenate((starts, [len(words)])))
        is_open = (sizes > 1) & (depth < words.shape[1])
        if not is_open.any():
            return order, starts
        segment = np.repeat(np.arange(len(starts)), sizes)
        at = np.flatnonzero(is_open[segment])
        segment = segment[at]
        own = words[order[at], depth[segment]]
        ends = [words[order[np.minimum(starts + s, len(words) - 1)], np.minimum(depth, words.shape[1] - 1)]
                for s in (0 * sizes, sizes // 2, sizes - 1)]
        low, high = np.minimum(ends[0], ends[1]), np.maximum(ends[0], ends[1])
        pivot = np.maximum(low, np.minimum(high, ends[2]))[segment]
        side = segment * 3 + (own >= pivot) + (own > pivot)
        sort = np.argsort(side, kind="stable")
        order[at] = order[at[sort]]
        side = side[sort]
        fresh = np.flatnonzero(np.concatenate(([True], np.diff(side) != 0)))
        old = side[fresh] // 3
        starts = np.concatenate((starts[~is_open], at[fresh]))
        depth = np.concatenate((depth[~is_open], depth[old] + (side[fresh] % 3 == 1)))
        by = np.argsort(starts, kind="stable")
        starts, depth = starts[by], depth[by]


def shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    return n - ((int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")).bit_length() + 7) // 8


def blind_trie(strings: list[bytes]) -> tuple[list[int], list[int]]:
    """The order of `strings` and the prefix each shares with the one before it (the first: 0).

    Inner nodes are [place of the branching byte, children by byte], leaves lists of equal strings.
    A descent looks at branching bytes only and compares once, with the leaf where it ends."""
    root: list = [0]
    for i, s in enumerate(strings[1:], 1):
        node = root
        while isinstance(node[-1], dict):
            skip, children = node
            child = children.get(s[skip] if skip < len(s) else -1)
            node = child if child is not None else next(iter(children.values()))
        other = strings[node[0]]
        same = shared(s, other)
        if same == len(s) == len(other):
            node.append(i)
            continue
        branch = s[same] if same < len(s) else -1
        node = root
        while isinstance(node[-1], dict) and node[0] < same:
            node = node[1][s[node[0]]]
        if isinstance(node[-1], dict) and node[0] == same:
            node[1][branch] = [i]
        else:
            below = node[:]
            node[:] = [same, {other[same] if same < len(other) else -1: below, branch: [i]}]
    order, lcps = [], []
    stack = [(root, 0)]
    while stack:
        node, lcp = stack.pop()
        if isinstance(node[-1], dict):
            skip, children = node
            for k, byte in reversed(list(enumerate(sorted(children)))):
                stack.append((children[byte], skip if k else lcp))
        else:
            for k, i in enumerate(node):
                order.append(i)
                lcps.append(len(strings[i]) if k else lcp)
    return order, lcps


def deep_shallow(strings: list[bytes], groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of `strings` inside their groups, and the prefix that each shares with the one before
    it, -1 where a group begins. Equal strings stand together."""
    padded = np.array(strings, f"S{SHALLOW}")
    head = padded.view(np.uint8).reshape(len(strings), SHALLOW)
    order, starts = quicksorted(head.view(">u8").astype(np.uint64), groups)
    sizes = np.array([len(s) for s in strings])
    inner = np.full(len(strings), -1)
    for s, e in zip(starts.tolist(), np.append(starts[1:], len(strings)).tolist()):
        if e - s > 1:
            own = order[s:e].tolist()
            # Beside longer strings, such a group may hold some that end in it or before its zeros.
            below, lcps = blind_trie([strings[i] for i in own])
            order[s:e] = [own[i] for i in below]
            inner[s + 1 : e] = lcps[1:]
    a, b = order[:-1], order[1:]
    differ = head[a] != head[b]
    until = np.where(differ.any(axis=1), differ.argmax(axis=1), SHALLOW)
    until = np.minimum(until, np.minimum(sizes[a], sizes[b]))
    lcp = np.full(len(strings), -1)
    lcp[1:] = np.where(groups[a] == groups[b], np.maximum(until, inner[1:]), -1)
    return order, lcp


def repeated_windows(stretches: list[bytes], hi: np.ndarray, lo: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
    """Per stretch and offset: whether another stretch of its group has the same window there."""
    n = len(stretches)
    right, right_lcp = deep_shallow([s[h:] for s, h in zip(stretches, hi.tolist())], groups)
    left, left_lcp = deep_shallow([s[:h][::-1] for s, h in zip(stretches, hi.tolist())], groups)
    found = np.zeros((n, length - GRAM + 1), bool)
    after, before = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(length - GRAM + 1):
        has = np.flatnonzero((lo <= o) & (o <= hi))
        if len(has) < 2:
            continue
        after[right] = np.cumsum(right_lcp < length - o)
        # Prefixes of no bytes are alike inside a group.
        before[left] = np.cumsum(left_lcp < o)
        _, kind, counts = np.unique(after[has] * (n + 1) + before[has], return_inverse=True, return_counts=True)
        found[has, o] = counts[kind] > 1
    return found


def sorted_groups(stretches: DataFrame, length: int) -> DataFrame:
    """Windows repeated among the different stretches of each gram, as pieces of text."""

    def sort_block(rows: list[tuple]) -> pa.RecordBatch:
        gram, single, d1, d2, pos, lo, hi, data = zip(*rows)
        _, groups = np.unique(np.array(gram), return_inverse=True)
        by = np.argsort(groups, kind="stable")
        groups, lo, hi = groups[by], np.array(lo)[by], np.array(hi)[by]
        found = repeated_windows([data[i] for i in by], hi, lo, groups, length)
        found &= np.array(single)[by][:, None]
        edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1
        row = by[row]
        at = np.array(pos)[row]
        columns = [np.array(d1)[row], np.array(d2)[row], at - last, at - first + length]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["d1", "d2", "start", "end"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= BLOCK and row[0] != held[-1][0]:
                    yield sort_block(held)
                    held = []
                held.append(row)
        if held:
            yield sort_block(held)

    columns = ["gram", "single", "d1", "d2", "pos", "lo", "hi", "data"]
    dealt = stretches.select(*columns).repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(search, FOUND)


def counted_windows(stretches: DataFrame, length: int, scratch: common.Scratch) -> DataFrame:
    """The same for grams with too many stretches for one task, by hashes and counts alone.

    A node is a range of offsets, the same for all stretches. If what all its windows share occurs
    once, none of them recurs; if their union recurs, all of them do; else the node is split in
    FAN. Of stretches with the same union one goes on for the others to meet, so that what is left
    under one key differs. The number of rounds is that of the levels, whatever the data."""
    columns = ["gram", "single", "d1", "d2", "pos", "lo", "hi", "data"]
    shared = F.substring("data", (F.col("hi") - F.col("low") + 1).cast("int"), (length - F.col("high") + F.col("low")).cast("int"))
    union = F.substring("data", (F.col("hi") - F.col("high") + 1).cast("int"), (length + F.col("high") - F.col("low")).cast("int"))
    inside = F.expr("lo <= low and high <= hi")
    # A node that reaches beyond its stretch has no union there; its own key keeps such rows apart.
    alone = F.xxhash64("d1", "d2", "pos")
    rows = stretches.select(*columns, F.lit(0).alias("low"))
    width, found = 1, None
    while width < length - GRAM + 1:
        width *= FAN
    while width > 1:
        width //= FAN
        parts = F.explode(F.array(*[F.col("low") + k * width for k in range(FAN)]))
        nodes = rows.select(*columns, parts.alias("low")).withColumn("high", F.col("low") + width - 1)
        nodes = nodes.where("low <= hi and high >= lo").withColumns(
            {"inside": inside, "core": F.xxhash64(shared), "whole": F.when(inside, F.xxhash64(union)).otherwise(alone)}
        )
        nodes = scratch.stored(nodes, f"nodes-{width}")
        again = nodes.groupBy("gram", "low", "core").agg(F.count("*").alias("n")).where("n > 1").drop("n")
        again = scratch.stored(again, f"cores-{width}")
        open_ = scratch.stored(nodes.join(again, ["gram", "low", "core"], "left_semi"), f"open-{width}")
        firsts = [F.first(c).alias(f"first_{c}") for c in ("d1", "d2", "pos")]
        wholes = open_.where("inside").groupBy("gram", "low", "whole").agg(F.count("*").alias("n"), *firsts)
        wholes = scratch.stored(wholes.where("n > 1"), f"unions-{width}")
        met = open_.join(wholes, ["gram", "low", "whole"], "left").withColumn("met", F.expr("inside and n is not null"))
        met = scratch.stored(met, f"met-{width}")
        scratch.drop(*[f"{name}-{width}" for name in ("nodes", "cores", "open", "unions")])
        here = met.where("met and single").select(
            "d1", "d2", (F.col("pos") - F.col("high")).alias("start"), (F.col("pos") - F.col("low") + length).alias("end")
        )
        found = here if found is None else found.unionByName(here)
        first = F.expr("d1 = first_d1 and d2 = first_d2 and pos = first_pos")
        rows = met.where(~F.col("met") | first).withColumn("single", F.expr("single and not met")).select(*columns, "low")
    return found


# The corpus


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.struct("*").alias("row"),
        text.alias("text"),
        F.xxhash64(text).alias("d1"),
        F.crc32(text).alias("d2"),
    )


def repeated(docs: DataFrame, length: int = LENGTH, limit: int = LIMIT) -> DataFrame:
    """d1, d2 and `found`, the pieces of that text (start, end) that occur again; pieces may overlap."""
    scratch = common.Scratch(docs.sparkSession, "suffixes")
    texts = keyed(docs).select("d1", "d2", "text")
    every = scratch.stored(anchor_rows(texts, length), "anchors")
    # Counts are stored before they are joined: then both sides of the join are read from tables, and
    # the rows of a frequent gram can be split among tasks.
    often = every.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")
    often = scratch.stored(often, "grams")
    kept = scratch.stored(every.join(often, "gram", "left_semi"), "anchors-again")
    scratch.drop("anchors")
    alike = kept.groupBy("gram", "stretch").agg(
        F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("d1", "d2", "pos", "lo", "hi")]
    )
    alike = scratch.stored(alike, "alike")
    different = alike.groupBy("gram").agg(F.count("*").alias("different"))
    different = scratch.stored(different, "different")
    kinds = scratch.stored(alike.join(different, "gram").where("n > 1 or different > 1"), "stretches")
    whole = kept.join(kinds.where("n > 1").select("gram", "stretch"), ["gram", "stretch"], "left_semi")
    known = whole.select(
        "d1", "d2", (F.col("pos") - F.col("hi")).alias("start"), (F.col("pos") - F.col("lo") + length).alias("end")
    )
    # One member of each kind of stretch is cut out; copies of its text are put together on the way.
    wanted = kinds.where("different > 1").groupBy("d1", "d2").agg(
        F.collect_list(
            F.struct("gram", (F.col("n") == 1).alias("single"), (F.col("different") > limit).alias("hot"), "pos", "lo", "hi")
        ).alias("wanted")
    )
    once = texts.groupBy("d1", "d2").agg(F.first("text").alias("text"))
    cut = once.join(wanted, ["d1", "d2"]).select(
        "d1", "d2", F.encode("text", "utf-8").alias("data"), F.explode("wanted").alias("w")
    )
    begin = F.col("w.pos") - F.col("w.hi")
    size = F.col("w.hi") - F.col("w.lo") + length
    cut = cut.select("d1", "d2", "w.*", F.substring("data", (begin + 1).cast("int"), size.cast("int")).alias("data"))
    cut = scratch.stored(cut, "cut")
    found = sorted_groups(cut.where("not hot"), length)
    hot = cut.where("hot")
    if not hot.isEmpty():
        found = found.unionByName(counted_windows(hot, length, scratch))
    # Copies of a text name the same pieces: sets are made before the shuffle as well.
    pieces = known.unionByName(found).groupBy("d1", "d2").agg(F.collect_set(F.struct("start", "end")).alias("found"))
    pieces = common.stored(pieces, "pieces")
    scratch.clear()
    return pieces


KEPT = "struct<spans: array<struct<start: long, end: long>>, kept: binary>"


def without(text: pa.Array, found: pa.Array) -> pa.Array:
    """The maximal runs that `found` covers, and the bytes outside them."""
    out = []
    for t, pieces in zip(text.to_pylist(), found.to_pylist()):
        data, spans, kept, end = t.encode(), [], [], 0
        for s, e in sorted((p["start"], p["end"]) for p in pieces or ()):
            if spans and s <= spans[-1]["end"]:
                spans[-1]["end"] = max(spans[-1]["end"], e)
            else:
                spans.append({"start": s, "end": e})
        for span in spans:
            kept.append(data[end : span["start"]])
            end = span["end"]
        kept.append(data[end:])
        out.append({"spans": spans, "kept": b"".join(kept)})
    kind = pa.struct([("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
    return pa.array(out, kind)


def deduplicated(docs: DataFrame, length: int = LENGTH, limit: int = LIMIT) -> DataFrame:
    """row, n_bytes, spans (start, end of each maximal removed run, in bytes) and kept (binary)."""
    pieces = repeated(docs, length, limit)
    cut = F.arrow_udf(without, KEPT)
    joined = keyed(docs).join(pieces, ["d1", "d2"], "left")
    done = joined.select("row", F.octet_length("text").cast("long").alias("n_bytes"), cut("text", "found").alias("c"))
    return done.select("row", "n_bytes", "c.spans", "c.kept")
