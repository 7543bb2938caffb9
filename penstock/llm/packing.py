"""Best-fit packing by exact complements.

Documents become pieces of at most `length` tokens. The plan is made from the number of pieces of
each length, at most `length` numbers: sums of two lengths are indexed once, and for the longest pieces
left the gap to a full sequence is looked up among single lengths, sums of two and, by their longest,
sums of three. A combination is used as often as its lengths are available. What finds no exact
complement is packed best-fit, longest first; where best-fit alone takes fewer sequences, its plan holds.
Pieces then find their sequence by their rank among the pieces of their length. Ranks come from
counts per (length, bucket), so that a length with a third of all pieces is ranked in many tasks.
"""

from __future__ import annotations

import json
import zlib
from array import array
from base64 import b64decode
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penstock.llm import common

LENGTH = 1024
EOS = 2
BUCKET_ROWS = 1_000


@lru_cache(maxsize=2)
def encoder(tokenizer: str, ranks: str, pattern: str) -> Callable[[str], bytes]:
    """Ids of a text (little-endian, 32 bits each) by the byte-level BPE in the file `tokenizer`; its
    added tokens are found in texts, none is put in. The merges are done on the same vocabulary as
    `ranks`, within the words that `pattern` cuts, which takes half the time and gives the same ids.

    Ids of words are not remembered: on texts with many rare words a table of them takes longer than the
    merges, and each worker would hold hundreds of MB."""
    with open(tokenizer, encoding="utf-8") as file:
        added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    with open(ranks, "rb") as lines:
        known_ranks = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known_ranks, special_tokens=added)
    return lambda text: bpe.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


def cut(ids: bytes, length: int) -> list[tuple[int, int, int]]:
    """(piece, start, length) of a document's ids; only the first piece may be shorter."""
    n = len(ids) // 4
    if n <= length:
        return [(0, 0, n)]
    ends = range(n - (n - 1) // length * length, n + 1, length)
    return [(i, max(0, end - length), min(length, end)) for i, end in enumerate(ends)]


def _piece_batches(
    batches: Iterator[pa.RecordBatch], files: tuple[str, str, str], length: int, eos: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    encode = encoder(*files)
    end = array("I", [eos]).tobytes()
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("piece", pa.int32()),
            ("start", pa.int64()),
            ("length", pa.int64()),
            ("ids_crc32", pa.int64()),
            *([("ids", pa.binary())] if with_ids else []),
        ]
    )
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            ids = encode(text.as_py() or "") + end
            for piece, start, size in cut(ids, length):
                part = ids[4 * start : 4 * (start + size)]
                row = (doc_id, piece, start, size, zlib.crc32(part))
                rows.append((*row, part) if with_ids else row)
        columns = zip(*rows) if rows else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )


def pieces(
    docs: DataFrame,
    tokenizer: str,
    ranks: str,
    pattern: str,
    length: int = LENGTH,
    eos: int = EOS,
    with_ids: bool = True,
) -> DataFrame:
    """`doc_id`, `piece`, `start`, `length`, `ids_crc32` and, if asked for, `ids` (binary, four
    bytes each) of every document. Null text counts as empty: it is the end token alone."""
    fields = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        partial(_piece_batches, files=(tokenizer, ranks, pattern), length=length, eos=eos, with_ids=with_ids),
        fields + (", ids binary" if with_ids else ""),
    )


def _times(left: dict[int, int], combination: tuple[int, ...]) -> int:
    """How often the lengths can be taken together."""
    return min(left.get(n, 0) // k for n, k in Counter(combination).items())


def _sums(lengths: list[int], most: int) -> dict[int, list[tuple[int, int]]]:
    """Pairs of lengths by their sum, at most `most`, those with the longest first."""
    found: dict[int, list[tuple[int, int]]] = {}
    for i, b in enumerate(lengths):
        for c in lengths[i:]:
            if b + c <= most:
                found.setdefault(b + c, []).append((b, c))
    return found


def _complements(
    left: dict[int, int], lengths: list[int], pairs: dict[int, list[tuple[int, int]]], gap: int
) -> Iterator[tuple[int, ...]]:
    """Lengths that add up to `gap`: none, one, two, then three, without those of which none is left."""
    if not gap:
        yield ()
        return
    if gap in left:
        yield (gap,)
    for b, c in pairs.get(gap, ()):
        if b in left and c in left:
            yield b, c
    for b in lengths:
        if 3 * b < gap:
            break
        if b in left:
            for c, d in pairs.get(gap - b, ()):
                if c <= b and c in left and d in left:
                    yield b, c, d


def exact_groups(counts: dict[int, int], length: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """([(lengths, sequences)], what is left): sequences that combinations fill exactly. Each
    combination is used until one of its lengths runs out, so each is looked at once."""
    left = {n: k for n, k in counts.items() if k}
    lengths = sorted(left, reverse=True)
    pairs = _sums(lengths, length)
    groups, rest = [], {}
    for first in lengths:
        if first not in left:
            continue
        for others in _complements(left, lengths, pairs, length - first):
            found = (first, *others)
            times = _times(left, found)
            if times:
                groups.append((found, times))
                for n in found:
                    left[n] -= times
                    if not left[n]:
                        del left[n]
                if first not in left:
                    break
        if first in left:
            rest[first] = left.pop(first)
    return groups, rest


def best_fit_groups(counts: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """The rest, longest first, each piece into the open sequence with the least room that takes it.
    Sequences with the same content are one group, and are split when pieces run out."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {length: []}
    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            room = min((r for r, groups in open_.items() if r >= n and groups), default=None)
            if room is None:
                each = min(length // n, left)
                full, left = divmod(left, each)
                open_.setdefault(length - each * n, []).append(((n,) * each, full))
                continue
            content, times = open_[room].pop()
            used = min(times, left)
            if used < times:
                open_[room].append((content, times - used))
            open_.setdefault(room - n, []).append(((*content, n), used))
            left -= used
    return [group for groups in open_.values() for group in groups]


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, first sequence, offset): pieces of that length with these
    ranks go to consecutive sequences, at that offset. Raises for lengths beyond `length`."""
    if counts and max(counts) > length:
        raise ValueError(f"piece of {max(counts)} tokens")
    exact, rest = exact_groups(counts, length)
    plans = [exact + best_fit_groups(rest, length), best_fit_groups(counts, length)]
    groups = min(plans, key=lambda groups: sum(times for _, times in groups))
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for content, times in groups:
        offset = 0
        for n in content:
            rows.append((n, used[n], used[n] + times - 1, sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    return rows


def ranked(sized: DataFrame, counts: dict[int, int]) -> DataFrame:
    """`sized` with `rank`, gapless from 0 within each `length`."""
    most = max(counts.values(), default=1)
    keyed = sized.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(1 + most // BUCKET_ROWS))
    )
    starts = common.starts(keyed.groupBy("length", "bucket").agg(F.count("*").alias("n")), ["length"], "bucket")
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    numbered = keyed.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["length", "bucket"]).select(
        *sized.columns, (F.col("before") + F.col("place")).alias("rank")
    )


def packed(sized: DataFrame, length: int = LENGTH) -> DataFrame:
    """`sized` (columns `doc_id`, `piece`, `length`, `ids_crc32` and any others) with `sequence_id`
    and `offset`. The plan has a few rows per length, at most some thousands, so it is broadcast.

    Repeated rows are packed as often as they occur; null ids are ids like others."""
    with common.few_texts(sized.sparkSession):
        fixed = common.stored(sized, "pieces")
    counts = {r["length"]: r["n"] for r in fixed.groupBy("length").agg(F.count("*").alias("n")).collect()}
    segments = fixed.sparkSession.createDataFrame(
        plan(counts, length), "size long, low long, high long, first long, offset long"
    )
    placed = ranked(fixed, counts).join(
        F.broadcast(segments),
        (F.col("length") == F.col("size")) & F.col("rank").between(F.col("low"), F.col("high")),
    )
    return placed.select(
        *fixed.columns, (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset"
    )


def sequences(placed: DataFrame) -> DataFrame:
    """`sequence_id`, `n_tokens` and `ids` of each packed sequence, from pieces with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
