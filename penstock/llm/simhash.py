"""SimHash near-duplicates with covering locality-sensitive hashing.

A fingerprint bit is 1 if it is set in over half of the shingle hashes. For radius r, every bit
position gets a vector of r + 1 bits; for each of the 2^(r+1) - 1 non-zero vectors v, a mask keeps
the positions whose vector has an odd product with v. At most r differing positions span at most r
dimensions, so some v is orthogonal to all of them and its mask leaves them out: two fingerprints
within the radius agree under some mask, always.

Fingerprints that agree under a mask meet in one sorted run. Inside a run only a spanning forest of
the links is given out, so a run of m fingerprints yields fewer than m rows; runs too long for
direct comparison are covered again on their own, which halves the free bits each time.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penstock.llm import common

SEED = 42
DIRECT = 2048
# Runs of which all pairs of different labels are looked at.
SHORT = 8
# Beyond any distance.
DONE = 65
# Texts sampled for frequent shingles, in how many of them one is frequent, and how many are listed.
SAMPLED = 4000
OFTEN = 3
LISTED = 100_000
# Rounds of centres before all pairs left are tried; fewer where not one pair in WORTH is a link.
ROUNDS = 5
WORTH = 4


def shingle_hashes(raw: bytes, size: int) -> np.ndarray:
    """XXH64 of each run of `size` words, A-Z in lower case; fewer words give one hash, none none."""
    parts = raw.lower().split()
    if size > 1 and len(parts) > size:
        parts = map(b" ".join, zip(*(parts[i:] for i in range(size)), strict=False))
    elif size > 1 and parts:
        parts = [b" ".join(parts)]
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), parts), dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of the hashes; zero if there are none."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _mixed(hashes: np.ndarray, table: int) -> np.ndarray:
    """Another hash of the same shingles for each table, the hash itself for table 0."""
    if not table:
        return hashes
    x = hashes ^ np.uint64((table * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _fingerprint_batches(
    batches: Iterator[pa.RecordBatch], size: int, tables: int, distinct: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = []
        for raw in batch.column("raw").to_pylist():
            hashes = shingle_hashes(raw or b"", size)
            if distinct:
                hashes = np.unique(hashes)
            found = [majority(_mixed(hashes, t)) for t in range(tables)]
            prints.append(np.array(found, dtype=np.uint64).view(np.int64).tolist())
        kept = [batch.column(c) for c in batch.schema.names if c != "raw"]
        names = [c for c in batch.schema.names if c != "raw"]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(prints, pa.list_(pa.int64()))], names=[*names, "prints"]
        )


def fingerprints(
    keyed: DataFrame, size: int = 3, tables: int = 1, distinct: bool = False
) -> DataFrame:
    """The columns of `keyed` but `text`, and `prints`: `tables` fingerprints of 64 bits.

    Null text counts as empty. distinct: a shingle counts once however often it occurs."""
    others = [c for c in keyed.columns if c != "text"]
    fields = ", ".join(f"`{c}` {t}" for c, t in keyed.dtypes if c != "text")
    return keyed.select(*others, F.col("text").cast("binary").alias("raw")).mapInArrow(
        partial(_fingerprint_batches, size=size, tables=tables, distinct=distinct),
        f"{fields}, prints array<bigint>",
    )


def covering_masks(radius: int, seed: int = SEED) -> list[int]:
    """2^(radius+1) - 1 masks of 64 bits; any two values at most `radius` bits apart agree under one."""
    vectors = [1 + i % ((1 << (radius + 1)) - 1) for i in range(64)]
    random.Random(seed + radius).shuffle(vectors)
    return [
        sum(1 << i for i, vector in enumerate(vectors) if (vector & v).bit_count() % 2)
        for v in range(1, 1 << (radius + 1))
    ]


def _forest(values: np.ndarray, radius: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that connect what chains of links of at most `radius` bits connect.

    Every pair given is a link itself."""
    if len(values) > DIRECT:
        return _split_forest(values, radius, seed)
    left, right = [], []
    alone = np.arange(len(values))
    while len(alone):
        queue, alone = [alone[0]], alone[1:]
        while queue and len(alone):
            at = queue.pop()
            near = np.bitwise_count(values[alone] ^ values[at]) <= radius
            if near.any():
                met = alone[near]
                left += [at] * len(met)
                right += met.tolist()
                queue += met.tolist()
                alone = alone[~near]
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def _split_forest(values: np.ndarray, radius: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """As _forest, by covering the values again with other masks: runs get shorter each time, as
    the bits in which members of a run can differ are halved. Equal values are one."""
    single, first = np.unique(values, return_index=True)
    copies = np.searchsorted(single, values)
    again = np.flatnonzero(first[copies] != np.arange(len(values)))
    left, right = [first[copies[again]]], [again]
    for mask in covering_masks(radius, seed + 1):
        keys = single & np.uint64(mask)
        order = np.argsort(keys, kind="stable")
        edges = np.flatnonzero(np.diff(keys[order])) + 1
        for run in np.split(order, edges):
            if len(run) > 1:
                a, b = _forest(single[run], radius, seed + 1)
                left.append(first[run[a]])
                right.append(first[run[b]])
    return np.concatenate(left), np.concatenate(right)


def _tree(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """As _forest, with the shortest links. Fewer pairs differ from table to table, as each value
    is tied to its nearest."""
    if len(values) > DIRECT:
        return _split_forest(values, radius, SEED)
    away = np.bitwise_count(values ^ values[0]).astype(np.int64)
    parent, left, right = np.zeros(len(values), dtype=np.int64), [], []
    away[0] = DONE
    for _ in range(len(values) - 1):
        at = int(away.argmin())
        if away[at] <= radius:
            left.append(at)
            right.append(parent[at])
        away[at] = DONE
        gap = np.bitwise_count(values ^ values[at])
        closer = (gap < away) & (away < DONE)
        away[closer], parent[closer] = gap[closer], at
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def _across(values: np.ndarray, labels: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different labels: all of a short run, of a longer one those in the shortest forest
    that grows from its end."""
    if len(values) <= SHORT:
        a, b = np.triu_indices(len(values), 1)
        near = np.bitwise_count(values[a] ^ values[b]) <= radius
        a, b = a[near], b[near]
    else:
        a, b = (len(values) - 1 - x for x in _tree(values[::-1].copy(), radius))
    other = labels[a] != labels[b]
    return a[other], b[other]


def _link_batches(batches: Iterator[pa.RecordBatch], radius: int, shortest: bool) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by (mask_no, key); a run may go on over any number of batches. Rows
    with a label are linked across labels only."""
    held: list[tuple[np.ndarray, ...]] = []

    def run(values: np.ndarray, labels: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        if labels is not None:
            return _across(values, labels, radius)
        return _tree(values, radius) if shortest else _forest(values, radius)

    def finished(rows: tuple[np.ndarray, ...], edges: np.ndarray) -> pa.RecordBatch | None:
        _, _, values, nodes, *labels = rows
        starts = np.concatenate(([0], edges[:-1])) if len(edges) else np.array([], dtype=np.int64)
        sizes = edges - starts
        pairs = starts[sizes == 2]
        near = pairs[np.bitwise_count(values[pairs] ^ values[pairs + 1]) <= radius]
        if labels:
            near = near[labels[0][near] != labels[0][near + 1]]
        left, right = [nodes[near]], [nodes[near + 1]]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            a, b = run(values[start : start + size], labels[0][start : start + size] if labels else None)
            left.append(nodes[start + a])
            right.append(nodes[start + b])
        a, b = np.concatenate(left), np.concatenate(right)
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["u", "v"])

    for batch in batches:
        new = (
            batch.column("mask_no").to_numpy(),
            batch.column("key").to_numpy(),
            batch.column("value").to_numpy().view(np.uint64),
            batch.column("node").to_numpy(),
            *(batch.column(c).to_numpy() for c in batch.schema.names[4:]),
        )
        if not len(new[0]):
            continue
        if held and (held[-1][0][-1], held[-1][1][-1]) == (new[0][0], new[1][0]) == (new[0][-1], new[1][-1]):
            held.append(new)
            continue
        rows = tuple(np.concatenate(c) for c in zip(*held, new, strict=True))
        edges = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
        if len(edges):
            yield finished(rows, edges)
            held = [tuple(c[edges[-1] :].copy() for c in rows)]
        else:
            held = [rows]
    if held:
        rows = tuple(np.concatenate(c) for c in zip(*held, strict=True))
        yield finished(rows, np.array([len(rows[0])]))


def links(nodes: DataFrame, radius: int = 3, within: int | None = None, shortest: bool = False) -> DataFrame:
    """Links (u > v) between `node`s (long) whose fingerprints, table by table of `prints`, differ
    in at most `radius` bits; of the links among nodes that meet, a spanning forest, with the
    `shortest` links if asked for.

    within: nodes that meet are also linked up to that many bits, though not all such meet. If
    `nodes` have a `label`, links join different labels only, and there may be more than a forest."""
    masks = covering_masks(radius)
    carried = [c for c in ("label",) if c in nodes.columns]

    def rows(value: Column, table: Column) -> Column:
        return F.array(
            *[
                F.struct(
                    (table * len(masks) + i).cast("int").alias("mask_no"),
                    value.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask)).alias("key"),
                    value.alias("value"),
                )
                for i, mask in enumerate(masks)
            ]
        )

    each = nodes.select("node", *carried, F.posexplode("prints").alias("table", "value"))
    keyed = each.select("node", *carried, F.inline(rows(F.col("value"), F.col("table"))))
    met = keyed.repartition("mask_no", "key").sortWithinPartitions("mask_no", "key", "value", "node")
    found = met.select("mask_no", "key", "value", "node", *carried).mapInArrow(
        partial(_link_batches, radius=within or radius, shortest=shortest), "u bigint, v bigint"
    )
    return found.where("u != v").distinct()


def components(edges: DataFrame, most_rounds: int = 60, scratch: common.Scratch | None = None) -> DataFrame:
    """(`node`, `root`): for every node of the links (u > v) but the roots, the smallest node it
    reaches. Alternates large and small stars, each round written to the shared folder, until
    nothing changes; raises when `most_rounds` do not suffice. In `scratch`, where one is given, only
    the last round stays."""

    def seal(df: DataFrame) -> tuple[DataFrame, tuple]:
        links = df.where("u != v").distinct()
        kept = scratch.stored(links, scratch.name("stars")) if scratch else common.stored(links, "stars")
        mark = kept.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return kept, tuple(mark)

    stars, mark = seal(edges)
    for _ in range(most_rounds):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before = scratch.last if scratch else None
        stars, now = seal(small.unionByName(low.select("u", F.col("m").alias("v"))))
        if scratch:
            scratch.drop(before)
        if now == mark:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError(f"components not settled after {most_rounds} rounds")


def classes(docs: DataFrame, radius: int = 3) -> DataFrame:
    """`doc_id`, `fingerprint` and `component_id` (smallest doc_id reachable by links of at most
    `radius` bits) for each row of `docs`.

    Rows with null text have fingerprint zero. Rows without doc_id take part and have their
    component's smallest id, null where no member has one. Repeated rows are repeated."""
    printed = common.stored(
        fingerprints(docs.select("doc_id", "text")).select(
            "doc_id", F.col("prints")[0].alias("fp")
        ),
        "prints",
    )
    single = common.stored(printed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "single")
    edges = links(single.select(F.col("fp").alias("node"), F.array("fp").alias("prints")), radius)
    rooted = components(edges)
    grouped = single.join(rooted, single["fp"] == rooted["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    firsts = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = grouped.join(firsts, "root").select("fp", "component_id")
    return printed.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def similar(texts: DataFrame, pairs: DataFrame, size: int, least: float, scratch: common.Scratch) -> DataFrame:
    """The `pairs` (u, v) whose sets of shingles of `size` words have at least that Jaccard index."""
    named = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    wanted = scratch.stored(named, scratch.name("wanted"))
    parts = common.words(F.lower(F.coalesce("text", F.lit(""))))
    sets = (
        texts.join(wanted, "node", "left_semi")
        .select("node", parts.alias("w"))
        .select(
            "node",
            F.when(F.size("w") <= size, F.array(F.xxhash64("w")))
            .otherwise(
                F.array_distinct(
                    F.transform(F.sequence(F.lit(1), F.size("w") - (size - 1)), lambda i: F.xxhash64(F.slice("w", i, size)))
                )
            )
            .alias("s"),
        )
    )
    left = sets.select(F.col("node").alias("u"), F.col("s").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("s").alias("b"))
    both = pairs.join(left, "u").join(right, "v")
    shared = F.size(F.array_intersect("a", "b"))
    return both.where(shared >= least * (F.size("a") + F.size("b") - shared)).select("u", "v")


def _sets(raw: bytes, size: int) -> np.ndarray:
    """Distinct hashes of the shingles that `similar` compares; `raw` is in lower case."""
    words = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), raw.split()), dtype=np.uint64)
    n = min(size, len(words))
    many = max(1, len(words) - size + 1)
    whole = np.full(many, n, dtype=np.uint64)
    for j in range(n):
        whole = _mixed(whole + words[j : j + many], j + 1)
    return np.unique(whole)


def _prefix_batches(
    batches: Iterator[pa.RecordBatch], size: int, least: float | None, hot: np.ndarray, counts: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Rows (node, n, tokens): of each text's `n` shingles, in one order of all shingles, as many of the first
    as any set with a Jaccard index of `least` must share one of; all without `least`."""
    kind = pa.schema([("node", pa.int64()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])

    def rows(nodes: list, sizes: list, tokens: list) -> pa.RecordBatch:
        ends = np.concatenate(([0], np.cumsum([len(t) for t in tokens]))).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(tokens).view(np.int64)))
        columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), lists]
        return pa.RecordBatch.from_arrays(columns, schema=kind)

    for batch in batches:
        nodes, sizes, tokens, held = [], [], [], 0
        for node, raw in zip(batch.column("node").to_pylist(), batch.column("raw").to_pylist(), strict=True):
            own = _sets(raw, size)
            n = len(own)
            if least is not None:
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
                    own = own[np.lexsort((own, np.where(hot[at] == own, counts[at], 0)))]
                own = own[: n - math.ceil(least * n - 1e-9) + 1]
            nodes.append(node)
            sizes.append(n)
            tokens.append(own)
            held += len(own)
            if held >= 100_000:
                yield rows(nodes, sizes, tokens)
                nodes, sizes, tokens, held = [], [], [], 0
        if tokens:
            yield rows(nodes, sizes, tokens)


def alike(texts: DataFrame, radius: int, scratch: common.Scratch) -> DataFrame:
    """Links (u > v) of the fingerprints of `texts`, as of classes(): from each node to the smallest one of its
    fingerprint, and between those a spanning forest of all links of at most `radius` bits."""
    printed = fingerprints(texts.select("node", "text")).select("node", F.col("prints")[0].alias("fp"))
    with common.few_texts(texts.sparkSession):
        printed = scratch.stored(printed.distinct(), "fingerprints")
    single = scratch.stored(printed.groupBy("fp").agg(F.min("node").alias("first")), "firsts")
    same = printed.join(single, "fp").where("node != first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    met = links(single.select(F.col("first").alias("node"), F.array("fp").alias("prints")), radius)
    found = scratch.stored(same.union(met).distinct(), "alike")
    scratch.drop("fingerprints", "firsts")
    return found


def prefixes(
    texts: DataFrame, labels: DataFrame, size: int, least: float, scratch: common.Scratch
) -> tuple[DataFrame, int]:
    """(`node`, `n`, `label`, `tokens`): the prefix of each text's set of shingles, of what texts of several labels
    have, and how many pairs of such texts meet in them. `labels` (`node`, `root`) are as of components().

    Two sets with a Jaccard index of `least` share a token of their prefixes, whatever the order. Shingles
    that are frequent in a sample come last in it; the sample decides the cost only."""
    raw = texts.select("node", F.lower(F.coalesce("text", F.lit(""))).cast("binary").alias("raw"))

    def tokens(frame: DataFrame, least: float | None, hot: np.ndarray, counts: np.ndarray) -> DataFrame:
        work = partial(_prefix_batches, size=size, least=least, hot=hot, counts=counts)
        return frame.mapInArrow(work, "node bigint, n int, tokens array<bigint>")

    every = max(1, texts.count() // SAMPLED)
    nothing = np.array([], dtype=np.uint64)
    some = tokens(raw.where(F.pmod(F.xxhash64(F.lit(SEED), "node"), F.lit(every)) == 0), None, nothing, nothing)
    often = some.select(F.explode("tokens").alias("token")).groupBy("token").count()
    often = often.where(F.col("count") >= OFTEN).orderBy(F.desc("count"), "token").limit(LISTED).toPandas()
    hot = often["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(hot)
    with common.few_texts(texts.sparkSession):
        found = scratch.stored(tokens(raw, least, hot[order], often["count"].to_numpy()[order]), "prefixes")
    lists, pairs = _open(_labelled(found, labels), scratch)
    shared = scratch.stored(lists, "shared")
    scratch.drop("prefixes")
    return shared, pairs


def _labelled(held: DataFrame, labels: DataFrame) -> DataFrame:
    """`held` with the root of its node as `label`; a node without one is its own."""
    named = held.drop("label").join(labels, "node", "left")
    return named.select("node", "n", F.coalesce("root", "node").alias("label"), "tokens")


def _open(held: DataFrame, scratch: common.Scratch) -> tuple[DataFrame, int]:
    """`held` with the tokens that texts of several labels have, the rarest first, and how many pairs of such
    texts meet in them."""
    each = held.select("node", "n", "label", F.explode("tokens").alias("token"))
    counts = each.groupBy("token", "label").agg(F.count("*").alias("m"))
    counts = counts.groupBy("token").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("inside"))
    mixed = scratch.stored(counts.where("m * m > inside"), scratch.name("mixed"))
    pairs = mixed.agg(F.sum(F.expr("(m * m - inside) div 2"))).first()[0] or 0
    lists = each.join(mixed.select("token", "m"), "token").groupBy("node", "n", "label")
    lists = lists.agg(F.array_sort(F.collect_list(F.struct("m", "token")))["token"].alias("tokens"))
    return lists, pairs


def _places(held: DataFrame) -> DataFrame:
    """A row for each token, with the number `k` of tokens of the text and the token's place `at` among them."""
    k = F.size("tokens").alias("k")
    return held.select("node", "n", "label", k, F.posexplode("tokens").alias("at", "token"))


def _hopeful(a: str, b: str, least: float) -> tuple[Column, Column]:
    """How many of the tokens two texts of different labels must share for that index, at least 1, and
    whether their sizes and numbers of tokens allow it.

    Shingles that they share lie in both prefixes or behind the one that ends first."""
    n = [F.col(f"{x}.n") for x in (a, b)]
    rest = F.greatest(*[F.ceil(x * least - 1e-9) - 1 for x in n])
    need = F.greatest(F.lit(1), F.ceil((n[0] + n[1]) * (least / (1 + least)) - 1e-6) - rest)
    sizes = F.least(*n) >= least * F.greatest(*n) - 1e-6
    return need, sizes & (F.least(f"{a}.k", f"{b}.k") >= need)


def near_copies(texts: DataFrame, size: int, least: float, scratch: common.Scratch, radius: int = 3) -> DataFrame:
    """(`node`, `root`) as of components() for the links between all texts whose sets of shingles have a Jaccard
    index of at least `least`; none is missed.

    Fingerprints come first: what links of at most `radius` bits connect is held against the index, link by link,
    and makes the groups. What they miss, as one word changes many bits of a short text, is found by an exact
    prefix join of texts in different groups. While the pairs left for it are many and those tried are often links,
    each text is first tried with the one centre of another group it shares most tokens with. In every other round the
    centre of a token is the text with the largest share of its prefix in others, as the original of many copies
    has. Then all pairs of texts that share a token and lie in different groups are tried. Pairs that must share
    r tokens meet in one that is not among the last r - 1 of either. Only pairs within one group, and those whose
    sizes or numbers of shared tokens rule the index out, are left out."""
    tried = alike(texts, radius, scratch)
    sure = scratch.stored(similar(texts, tried, size, least, scratch), "sure")
    held, left = prefixes(texts, components(sure, scratch=scratch), size, least, scratch)
    rows = held.agg(F.sum(F.size("tokens"))).first()[0] or 0
    for turn in range(ROUNDS):
        if left <= rows:
            break
        each = _places(held)
        known = F.col("k") / (F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
        first = F.xxhash64(F.lit(turn), "node")
        order = F.struct(first, "node") if turn % 2 else F.struct(-known, first, "node")
        centre = each.groupBy("token").agg(F.min_by(F.struct("node", "n", "label", "k"), order).alias("c"))
        met = each.alias("a").join(centre.select("token", "c.*").alias("c"), "token")
        met = met.where((F.col("a.label") != F.col("c.label")) & _hopeful("a", "c", least)[1])
        met = met.groupBy(F.col("a.node").alias("node"), F.col("c.node").alias("centre")).agg(F.count("*").alias("met"))
        met = met.join(_both_ways(tried, "node", "centre"), ["node", "centre"], "left_anti")
        best = met.groupBy("node").agg(F.max_by("centre", F.struct("met", "centre")).alias("centre"))
        pairs = best.select(F.greatest("node", "centre").alias("u"), F.least("node", "centre").alias("v")).distinct()
        pairs = scratch.stored(pairs, f"tried{turn}")
        linked = scratch.stored(similar(texts, pairs, size, least, scratch), f"linked{turn}")
        tried, sure = tried.union(pairs), sure.union(linked)
        found, left = _open(_labelled(held, components(sure, scratch=scratch)), scratch)
        held = scratch.stored(found, f"open{turn}")
        scratch.drop(f"open{turn - 1}" if turn else "shared")
        if WORTH * linked.count() < pairs.count():
            break
    a, b = (_places(held).alias(x) for x in "ab")
    need, possible = _hopeful("a", "b", least)
    met = a.join(b, F.col("a.token") == F.col("b.token")).where(
        (F.col("a.node") > F.col("b.node"))
        & (F.col("a.label") != F.col("b.label"))
        & possible
        & (F.col("a.at") <= F.col("a.k") - need)
        & (F.col("b.at") <= F.col("b.k") - need)
    )
    met = met.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()
    met = scratch.stored(met.join(tried, ["u", "v"], "left_anti"), "met")
    lists = held.select("node", "n", F.size("tokens").alias("k"), "tokens")
    both = met.join(lists.alias("a"), F.col("u") == F.col("a.node")).join(lists.alias("b"), F.col("v") == F.col("b.node"))
    hopeful = both.where(F.size(F.array_intersect("a.tokens", "b.tokens")) >= need).select("u", "v")
    across = scratch.stored(hopeful, "across")
    found = scratch.stored(similar(texts, across, size, least, scratch), "found")
    return components(sure.union(found), scratch=scratch)


def _both_ways(pairs: DataFrame, left: str, right: str) -> DataFrame:
    return pairs.select(F.col("u").alias(left), F.col("v").alias(right)).union(pairs.select("v", "u"))


def deduplicated(docs: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """One document of each group of copies and near copies, the one with the smallest doc_id.

    Near copies are texts whose sets of `size`-word shingles have a Jaccard index of at least `least`, and
    what chains of them connect. All such pairs are found, short texts included: candidates share a shingle
    of their prefixes, which no such pair can avoid, and only pairs held against the index make a group.

    Rows without doc_id cannot be named and are all kept; rows that share a doc_id stay or go
    together. Null texts and texts without a word are copies of each other."""
    scratch = common.Scratch(docs.sparkSession, "near")
    keyed = docs.where("doc_id is not null").select(
        F.col("doc_id").alias("node"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"), "text"
    )
    printed = scratch.stored(keyed.select("node", "digest").distinct(), "prints")
    single = printed.groupBy("digest").agg(F.min("node").alias("first"), F.count("*").alias("m")).where("m > 1")
    single = scratch.stored(single.select("digest", "first"), "single")
    copies = scratch.stored(printed.join(single, "digest").where("node != first").select("node", "digest"), "copies")
    # Stored, as it is read for each search: the join would move all texts every time.
    texts = scratch.stored(keyed.join(copies, ["node", "digest"], "left_anti").select("node", "text"), "texts")
    rooted = near_copies(texts, size, least, scratch)
    gone = copies.select("node").union(rooted.select("node")).distinct().withColumnRenamed("node", "doc_id")
    gone = common.stored(gone, "gone")
    scratch.clear()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
