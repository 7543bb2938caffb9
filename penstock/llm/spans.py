"""Substring dedup over sliding sentence spans.

Every run of `span` consecutive sentences is hashed and joined with all others. A run that occurred
before, in a document with a smaller id or earlier in the same document, is a repeat, and all
sentences that a repeat covers are removed. A text of fewer than `span` sentences is one run, so its
copies go too. What a text is cut into: after '.', '!' or '?' with one blank character, and after a
newline. A sentence of more than WHOLE words is cut again, before pairs of words whose hash is the
least among those NEAR places before and after, so that a passage is cut alike in any text; its parts
count as sentences. Sentences are compared without outer blanks, with inner blanks as one space and
A-Z in lower case; pieces without a word belong to no run and stay.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penstock.llm import common

# Fixed in the SQL check too.
CUT = re.compile(rb"[.!?][ \t\r\n]|\n")
SPOKEN = re.compile(rb"[^\x20\x09-\x0D]+")
# Words of the longest sentence that is not cut, and of the longest part of one.
WHOLE = 16
PART = 32
NEAR = 4
# Stands for a null id in the order of documents: behind all others.
LAST = (1 << 63) - 1
LOW = (1 << 64) - 1
# A run with a share of over one in HOT of all that recur is met by broadcast.
HOT = 1000


def pieces(raw: bytes) -> list[bytes]:
    """The sentences of a text with what follows them, long ones in parts; joined, they are the text again."""
    ends = [m.end() for m in CUT.finditer(raw)]
    if not ends or ends[-1] < len(raw):
        ends.append(len(raw))
    return [part for a, b in zip([0, *ends], ends) for part in parts(raw[a:b])] if raw else []


def parts(sentence: bytes) -> list[bytes]:
    """The sentence, cut if it has over WHOLE words. Parts have over NEAR words and at most PART: where no
    pair of words stands out, they are of equal length."""
    words = sentence.lower().split()
    if len(words) <= WHOLE:
        return [sentence]
    h = [zlib.crc32(b) ^ (zlib.crc32(a, 1) >> 1) for a, b in zip(words, words[1:])]
    cuts = [0]
    for i in range(NEAR + 1, len(words) - NEAR):
        x = h[i]
        if x < h[i - 1] and x < min(h[i - NEAR : i]) and x <= min(h[i + 1 : i + NEAR + 1], default=x):
            cuts.append(i)
    cuts.append(len(words))
    every = [0]
    for a, b in zip(cuts, cuts[1:]):
        k = -(-(b - a) // PART)
        every += [a + (b - a) * j // k for j in range(1, k + 1)]
    starts = [m.start() for m in SPOKEN.finditer(sentence)]
    edges = [0, *(starts[i] for i in every[1:-1]), len(sentence)]
    return [sentence[a:b] for a, b in zip(edges, edges[1:])]


def runs(raw: bytes, span: int) -> tuple[int, list[int], list[int]]:
    """The number of sentences with a word, and both halves of the hash of each run, in order. A text of
    fewer sentences is one run, which only such texts can share."""
    plain = [b" ".join(p.lower().split()) for p in pieces(raw)]
    plain = [p for p in plain if p]
    n = max(len(plain) - span, 0) + 1 if plain else 0
    keys = [xxhash.xxh3_128_intdigest(b"\n".join(plain[at : at + span])) for at in range(n)]
    return len(plain), [(k >> 64) - (1 << 63) for k in keys], [(k & LOW) - (1 << 63) for k in keys]


RUN_SCHEMA = pa.schema(
    [
        ("id", pa.int64()),
        ("digest", pa.int64()),
        ("n_sentences", pa.int32()),
        ("high", pa.list_(pa.int64())),
        ("low", pa.list_(pa.int64())),
    ]
)


def _run_batches(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [runs(raw.as_py(), span) for raw in batch.column("raw")]
        columns = zip(*found) if found else [[]] * 3
        own = [pa.array(c, f.type) for c, f in zip(columns, list(RUN_SCHEMA)[2:])]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("digest"), *own], schema=RUN_SCHEMA)


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _keyed(docs: DataFrame) -> DataFrame:
    text = _text("text")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
        F.xxhash64(text).alias("digest"),
        text.cast("binary").alias("raw"),
        F.struct("*").alias("row"),
    )


def repeats(docs: DataFrame, span: int, scratch: common.Scratch) -> DataFrame:
    """(`id`, `digest`, `n_sentences`, `covered`) of each text: `covered` holds the first sentences of
    its runs that occurred before.

    The hashes are stored as two arrays for each text. Half of a hash is counted, so frequent runs are
    one row for each task, and only runs whose half recurs are met with each other by the whole hash;
    what recurs is a table of its own, so that the joins are ordinary ones, whose hot keys Spark splits."""
    fields = "id bigint, digest bigint, n_sentences int, high array<bigint>, low array<bigint>"
    found = _keyed(docs).select("id", "digest", "raw").mapInArrow(partial(_run_batches, span=span), fields)
    with common.few_texts(docs.sparkSession):
        found = scratch.stored(found.withColumn("text_no", F.monotonically_increasing_id()), "runs")
    often = found.select(F.explode("high").alias("high")).groupBy("high").agg(F.count("*").alias("n"))
    often = scratch.stored(often.where("n > 1").select("high"), "often")
    each = found.select("text_no", F.posexplode(F.arrays_zip("high", "low")).alias("at", "run"))
    met = each.select("run.high", "run.low", "text_no", "at").join(often, "high")
    met = scratch.stored(met.join(found.select("text_no", "id", "digest"), "text_no").drop("text_no"), "met")
    place = F.struct("id", "digest", "at")
    first = met.groupBy("high", "low").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    first = scratch.stored(first.where("n > 1"), "first")
    # Fewer than HOT runs can have a share of over one in HOT, so these are broadcast, and no key of the
    # other join is large.
    bound = met.count() // HOT
    hot = F.broadcast(first.where(F.col("n") > bound))
    met_hot = met.join(hot, ["high", "low"])
    others = met.join(hot.select("high", "low"), ["high", "low"], "left_anti")
    met_first = others.join(first.where(F.col("n") <= bound), ["high", "low"]).unionByName(met_hot)
    later = met_first.where(place > F.col("first"))
    every = found.select("id", "digest", "n_sentences", F.lit(None).cast("int").alias("at"))
    every = every.unionByName(later.select("id", "digest", F.lit(None).cast("int").alias("n_sentences"), "at"))
    hits = every.groupBy("id", "digest").agg(
        F.max("n_sentences").alias("n_sentences"), F.collect_set("at").alias("covered")
    )
    hits = scratch.stored(hits, "hits")
    scratch.drop("runs", "often", "met", "first")
    return hits


def _removed(raw: bytes | None, n: int, covered: list[int], span: int) -> tuple[list[int], str] | None:
    """Which of the `n` sentences with a word go, and the rest of the text; nothing without a text."""
    if raw is None:
        return None
    hit = {i for at in covered for i in range(at, min(at + span, n))}
    kept, at = [], 0
    for part in pieces(raw):
        if part.split():
            if at not in hit:
                kept.append(part)
            at += 1
        else:
            kept.append(part)
    return sorted(hit), b"".join(kept).decode()


def cut(docs: DataFrame, span: int = 2) -> DataFrame:
    """`row` (the document), `n_sentences` (parts of long ones each count), `removed` (numbers of the sentences taken out, counted
    from 0 among those with a word) and `cleaned` (the text without them).

    Null text counts as empty; `cleaned` is then empty. What came first is settled by doc_id, then by a
    hash of the text; rows without doc_id come last. Rows equal in doc_id and text count as one document:
    they are not repeats of each other, with or without an id. Very long texts are cut like others, and
    ties within a text go by place. Other columns pass through, whatever their names."""
    hits = repeats(docs, span, common.Scratch(docs.sparkSession, "spans"))
    joined = _keyed(docs).drop("raw").join(hits, ["id", "digest"])
    # Only texts that lose something go to a worker, few at a time and without the rest of their rows. Spark
    # would cut each twice where its rest is filtered, if it took the function for deterministic.
    kind = "removed array<int>, cleaned string"
    cutter = F.udf(partial(_removed, span=span), kind, useArrow=False).asNondeterministic()
    text = _text("row.text")
    raw = F.when(F.size("covered") > 0, text.cast("binary"))
    done = joined.select("row", "n_sentences", cutter(raw, "n_sentences", "covered").alias("cut"))
    return done.select(
        "row",
        "n_sentences",
        F.coalesce("cut.removed", F.array().cast("array<int>")).alias("removed"),
        F.coalesce("cut.cleaned", text).alias("cleaned"),
    )


def deduplicated(docs: DataFrame, span: int = 2) -> DataFrame:
    """The documents with repeated sentences removed from `text`; documents left without a word are
    dropped if anything was removed from them. `n_chars`, where there is one, is counted anew."""
    done = cut(docs, span).where(F.col("cleaned").rlike(common.WORD) | (F.size("removed") == 0))
    changed = F.size("removed") > 0
    columns = []
    for name in docs.columns:
        old = F.col(f"row.`{name}`")
        if name == "text":
            old = F.when(changed, F.col("cleaned")).otherwise(old)
        elif name == "n_chars":
            old = F.when(changed, F.length("cleaned").cast(docs.schema[name].dataType)).otherwise(old)
        columns.append(old.alias(name))
    return done.select(*columns)
