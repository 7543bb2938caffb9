"""Mixing sources to target weights by temperature.

Shares of tokens are raised to an exponent between 0 and 1 and normalised. The exponent is found by
bisection: the largest that reaches a target entropy, or the smallest that repeats no source more
than allowed. Weights become token budgets. A source gives whole epochs and then part of one; each
epoch is a permutation of its own, made of blocks: a seeded hash deals documents into blocks of
bounded size and orders them inside. The part is a prefix of the permutation, so it is told by one
cut-off hash per source, found from block totals and the one block that holds the cut.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penstock.llm import common

SEED = 42
ROUNDS = 60


@dataclass(frozen=True)
class Share:
    """What one source contributes."""

    source: str | None
    n_rows: int
    n_tokens: int
    weight: float
    budget: int

    @property
    def epochs(self) -> int:
        return self.budget // self.n_tokens if self.n_tokens else 1

    @property
    def rest(self) -> int:
        return self.budget % self.n_tokens if self.n_tokens else 0


def tempered(sizes: list[int], exponent: float) -> list[float]:
    total = sum(sizes)
    powers = [math.exp(exponent * math.log(n / total)) if n else 0.0 for n in sizes]
    whole = sum(powers)
    return [p / whole for p in powers] if whole else powers


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def bisect(sizes: list[int], max_repeats: float | None = None, target_entropy: float | None = None) -> float:
    """The exponent: with target_entropy (in nats) the largest one that reaches it, 0 if none does;
    with max_repeats the smallest at which reading the largest source once reads no other source
    more often than that."""

    def flat_enough(exponent: float) -> bool:
        return entropy(tempered(sizes, exponent)) >= target_entropy

    def modest(exponent: float) -> bool:
        used = [(w / n) for w, n in zip(tempered(sizes, exponent), sizes) if n]
        return not used or max(used) <= max_repeats * min(used)

    low, high = 0.0, 1.0
    if target_entropy is not None:
        if flat_enough(high):
            return high
        for _ in range(ROUNDS):
            middle = (low + high) / 2
            low, high = (middle, high) if flat_enough(middle) else (low, middle)
        return low
    if modest(low):
        return low
    for _ in range(ROUNDS):
        middle = (low + high) / 2
        low, high = (low, middle) if modest(middle) else (middle, high)
    return high


def budgets(weights: list[float], total: int) -> list[int]:
    """Whole numbers that add up to `total`, each its share rounded down or up."""
    exact = [w * total for w in weights]
    whole = [int(x) for x in exact]
    missing = total - sum(whole) if any(weights) else 0
    by_rest = sorted(range(len(whole)), key=lambda i: (whole[i] - exact[i], i))
    for i in by_rest[:missing]:
        whole[i] += 1
    return whole


def plan(
    sizes: list[tuple[str | None, int, int]],
    budget: int | None = None,
    max_repeats: float | None = None,
    target_entropy: float | None = None,
) -> list[Share]:
    """Shares of the sources (name, rows, tokens). Without a budget: the least that reads every
    source at least once, so that no document is left out. A source without tokens is read once."""
    tokens = [n for _, _, n in sizes]
    weights = tempered(tokens, bisect(tokens, max_repeats, target_entropy)) if any(tokens) else [0.0] * len(tokens)
    if budget is None:
        budget = max((math.ceil(n / w) for n, w in zip(tokens, weights) if n), default=0)
        # Rounding must not leave the last token of a source out.
        parts = [max(n, b) for n, b in zip(tokens, budgets(weights, budget))]
    else:
        parts = budgets(weights, budget)
    return [Share(*size, w, b) for size, w, b in zip(sizes, weights, parts)]


def _marked(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.struct("*").alias("row"),
        F.col("source").alias("source"),
        common.n_words(F.coalesce("text", F.lit(""))).alias("n"),
        F.xxhash64("doc_id", "text").alias("own"),
    )


def source_sizes(docs: DataFrame, most_sources: int = 100_000) -> list[tuple[str | None, int, int]]:
    """Rows and words per source, in the order of names. Raises beyond `most_sources` sources, as
    the plan is made on the driver."""
    marked = _marked(docs)
    counts = marked.groupBy("source").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    rows = counts.limit(most_sources + 1).collect()
    if len(rows) > most_sources:
        raise ValueError(f"more than {most_sources} sources")
    return sorted(((r["source"], r["rows"], r["n"]) for r in rows), key=lambda s: (s[0] is None, s[0] or ""))


def _placed(epoch) -> F.Column:
    """Place of a document in an epoch's permutation: 0 to 2^63 - 1."""
    return F.xxhash64(F.lit(SEED), epoch, F.col("own")).bitwiseAND(F.lit((1 << 63) - 1))


def _blocks(rows: int, block_rows: int) -> int:
    return 1 << max(0, math.ceil(math.log2(max(1, rows / block_rows))))


def _share_frame(spark, shares: list[Share], block_rows: int) -> DataFrame:
    rows = [
        (s.source, s.weight, s.epochs, s.rest, 63 - int(math.log2(_blocks(s.n_rows, block_rows))))
        for s in shares
    ]
    return spark.createDataFrame(rows, "source string, weight double, epochs int, rest long, shift int")


def _cutoffs(marked: DataFrame, shares: DataFrame) -> DataFrame:
    """(`source`, `cutoff`): places up to it belong to the last, partial epoch.

    Totals per block, their running sum over the blocks of a source, then documents of only the
    block in which the budget ends. Documents at the same place come in together or not at all."""
    partial = marked.join(F.broadcast(shares.where("rest > 0")), marked["source"].eqNullSafe(shares["source"]))
    partial = partial.select(shares["source"], "rest", "shift", "n", _placed(F.col("epochs")).alias("place"))
    partial = partial.withColumn("block", F.expr("shiftright(place, shift)"))
    totals = partial.groupBy("source", "block").agg(F.sum("n").alias("total"), F.first("rest").alias("rest"))
    along = Window.partitionBy("source").orderBy("block")
    sums = totals.withColumn("upto", F.sum("total").over(along))
    edge = sums.where("upto > rest and upto - total <= rest").select(
        F.col("source").alias("s"), F.col("block").alias("b"), (F.col("upto") - F.col("total")).alias("before")
    )
    last = partial.join(edge, partial["source"].eqNullSafe(edge["s"]) & (partial["block"] == edge["b"]))
    inside = Window.partitionBy("s", "b").orderBy("place")
    running = last.withColumn("sum", F.col("before") + F.sum("n").over(inside))
    start = F.expr("shiftleft(b, shift) - 1")
    return running.groupBy("s").agg(
        F.coalesce(F.max(F.when(F.col("sum") <= F.col("rest"), F.col("place"))), F.first(start)).alias("cutoff")
    )


def mix(
    docs: DataFrame,
    budget: int | None = None,
    max_repeats: float | None = None,
    target_entropy: float | None = None,
    block_rows: int = 10_000,
) -> DataFrame:
    """Each document as often as the mix takes it: `row`, `n_tokens`, `weight`, `epoch`, `block`,
    `place`. An epoch is read by block, and in a block by place; a source's epochs follow each other.

    Null text has no tokens, null source is a source of its own. Documents without tokens cost no
    budget: they are in every whole epoch, and in the partial one if their place is. Rows equal in
    id and text have the same place, and are taken together. Only sources are collected, see
    source_sizes; shares and cut-offs are one row per source."""
    spark = docs.sparkSession
    if max_repeats is None and target_entropy is None:
        raise ValueError("max_repeats or target_entropy must be given")
    shares = plan(source_sizes(docs), budget, max_repeats, target_entropy)
    frame = _share_frame(spark, shares, block_rows)
    marked = _marked(docs)
    if any(s.rest for s in shares):
        cut = [(r["s"], r["cutoff"]) for r in _cutoffs(marked, frame).collect()]
    else:
        cut = []
    cuts = spark.createDataFrame(cut, "s string, cutoff long")
    known = frame.join(F.broadcast(cuts), frame["source"].eqNullSafe(cuts["s"]), "left").select(
        frame["source"].alias("s"), "weight", "epochs", "shift", F.coalesce("cutoff", F.lit(-1)).alias("cutoff")
    )
    each = marked.join(F.broadcast(known), marked["source"].eqNullSafe(known["s"]))
    each = each.select("row", "n", "own", "weight", "epochs", "shift", "cutoff", F.explode(F.expr("sequence(0, epochs)")).alias("epoch"))
    each = each.withColumn("place", _placed(F.col("epoch")))
    taken = each.where("epoch < epochs or place <= cutoff")
    return taken.select(
        "row",
        F.col("n").alias("n_tokens"),
        "weight",
        "epoch",
        F.expr("shiftright(place, shift)").alias("block"),
        "place",
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns."""
    return mix(docs, **how).select("row.*")
