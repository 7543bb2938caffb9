"""Filter interaction audit: what each of five text filters removes in each of their 120 orders, and
each filter's Shapley share of the removals.

Every document is reduced to the set of filters it fails, a number from 0 to 31 (bit k for the k-th
of ABCDE), and documents are counted per part and set. From these counts the removals of all 32
coalitions of filters are tabulated. A filter's share is the exact constrained least squares fit of
an additive model to that table: kernel weights, shares that add up to the removals of all five,
normal equations solved in rational numbers. Step counts are differences between coalitions.

Filters (words: maximal runs of other than space, tab, newline, vertical tab, form feed, return)
fail a text when: A: under 100 words; B: 100 * distinct words < 80 * words; C: 100 * capitals A-Z >
10 * code points; D: it holds one of `#$%&*|`; E: a row with a smaller doc_id has the same text,
in any part and whether removed or not.

Edge cases: a null text is the empty text (A fails it, B to D do not); a null lang belongs to the
part of the empty string; a null doc_id is neither smaller nor larger than another, so such a row
never fails E, fails no other, and has no label; rows equal in doc_id and text count each and do not
fail E through each other; of several label rows of one id the larger value counts; an empty table
gives no row. Texts of any length are taken whole. Columns other than doc_id, text and lang are not
read.
"""

from __future__ import annotations

import itertools
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from penstock.llm import common

FILTERS = "ABCDE"
ALL = 2 ** len(FILTERS) - 1
ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]
SPACES = "\t\n\x0b\f\r"


def failed(text: Column) -> Column:
    """Bits of A to D. Words come from a split at one character, which needs no regular expression."""
    pieces = F.split(F.translate(text, SPACES, " " * len(SPACES)), " ")
    words = F.size(F.array_remove(pieces, ""))
    distinct = F.size(F.array_remove(F.array_distinct(pieces), ""))
    fails = [
        words < 100,
        100 * distinct < 80 * words,
        100 * F.regexp_count(text, F.lit("[A-Z]")) > 10 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(fail, 2**k).otherwise(0) for k, fail in enumerate(fails)), F.lit(0))


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, fails (the set of filters failed), n, good, toxic: rows are counted, not listed.

    Texts are replaced by their digests before any shuffle. Equal rows are added up first, ids under
    one digest next, so a text that a third of all rows share is one row per task in each step."""
    text = F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(text, 256))
    rows = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("part"),
        digest.alias("digest"),
        failed(text).alias("fails"),
        # Rows without an id match no label; their digests spread them over the join's tasks.
        F.when(F.col("doc_id").isNull(), F.xxhash64(digest)).otherwise(F.lit(0)).alias("spread"),
    )
    key = ["doc_id", "spread", "part", "digest", "fails"]
    rows = rows.groupBy(*key).agg(F.count("*").alias("n"))
    known = labels.groupBy("doc_id").agg(F.max("quality").alias("good"), F.max("toxic").alias("toxic"))
    known = known.where("doc_id is not null").withColumn("spread", F.lit(0).cast("long"))
    marked = rows.join(known, ["doc_id", "spread"], "left").withColumns(
        {c: (F.coalesce(F.col(c), F.lit(0)) == 1).cast("int") for c in ("good", "toxic")}
    )
    kind = ["digest", "part", "fails", "good", "toxic"]
    alike = marked.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
    )
    # (doc_id, digest, part, fails, good, toxic) occurs once in `marked`, so n_first is all of them.
    lowest = F.min("first").over(Window.partitionBy("digest"))
    stays = F.col("n_null") + F.when(F.col("first") == lowest, F.col("n_first")).otherwise(0)
    split = alike.select(*kind, "n", stays.alias("stays"))
    both = F.array(
        F.struct(F.col("fails").alias("set"), F.col("stays").alias("count")),
        F.struct((F.col("fails") + 16).alias("set"), (F.col("n") - F.col("stays")).alias("count")),
    )
    split = split.select("part", "good", "toxic", F.explode(both).alias("s"))
    count = F.col("s.count")
    return split.groupBy("part", F.col("s.set").alias("fails")).agg(
        F.sum(count).alias("n"),
        F.sum(count * F.col("good")).alias("good"),
        F.sum(count * F.col("toxic")).alias("toxic"),
    )


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X with matrix X = right, by elimination in rationals."""
    size = len(matrix)
    rows = [list(a) + list(b) for a, b in zip(matrix, right)]
    for k in range(size):
        pivot = next(i for i in range(k, size) if rows[i][k])
        rows[k], rows[pivot] = rows[pivot], rows[k]
        rows[k] = [x / rows[k][k] for x in rows[k]]
        for i in range(size):
            if i != k and rows[i][k]:
                factor = rows[i][k]
                rows[i] = [x - factor * y for x, y in zip(rows[i], rows[k])]
    return [row[size:] for row in rows]


def shares(players: int = len(FILTERS)) -> list[list[Fraction]]:
    """Row i: the factors of the coalitions' values (by bit set) in the share of player i.

    The fit minimises sum over S of w(S) * (v(S) - sum of the shares in S)^2 with
    w(S) = (p - 1) / (C(p, |S|) * |S| * (p - |S|)) under sum of shares = v(all). Its normal equations
    with the multiplier of the constraint are linear in v, so one solution serves every part."""
    whole = 2**players - 1
    normal = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
    right = [[Fraction(0)] * (whole + 1) for _ in range(players + 1)]
    for s in range(1, whole):
        inside = [i for i in range(players) if s >> i & 1]
        size = len(inside)
        ways = Fraction(1)
        for k in range(size):
            ways = ways * (players - k) / (k + 1)
        weight = (players - 1) / (ways * size * (players - size))
        for i in inside:
            right[i][s] += weight
            for j in inside:
                normal[i][j] += weight
    for i in range(players):
        normal[i][players] = normal[players][i] = Fraction(1)
    right[players][whole] = Fraction(1)
    return solve(normal, right)[:players]


def coalitions(counts: DataFrame) -> DataFrame:
    """part and `removed`, `good`, `toxic`: arrays by bit set of what the 32 coalitions remove;
    `total`; `shapley`: array by filter of the share times 120, a whole number."""
    factors = [[x * len(ORDERS) for x in row] for row in shares()]
    assert all(x.denominator == 1 for row in factors for x in row)
    values = ["n", "good", "toxic"]
    hit = F.col("fails").bitwiseAND(F.col("coalition")) != 0
    table = (
        counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(ALL))).alias("coalition"))
        .groupBy("part", "coalition")
        .agg(F.sum("n").alias("total"), *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in values])
    )
    at = F.col("coalition") + 1
    weighted = [
        F.sum(F.element_at(F.lit([int(x) for x in row]).cast("array<long>"), at) * F.col("n")) for row in factors
    ]
    # One row per coalition, so a list holds 32.
    listed = F.array_sort(F.collect_list(F.struct("coalition", *values)))
    return table.groupBy("part").agg(
        F.max("total").alias("total"), listed.alias("table"), F.array(*weighted).alias("shapley")
    )


def steps() -> Column:
    """The 600 steps of all orders: bits before and with the step's filter, and the filter itself."""
    found = []
    for order in ORDERS:
        before = 0
        for place, name in enumerate(order):
            bit = 2 ** FILTERS.index(name)
            found.append((order, place + 1, FILTERS.index(name), before, before + bit))
            before += bit
    named = ["filter_order", "step", "filter", "before", "after"]
    return F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(row, named)]) for row in found])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step."""
    parts = coalitions(failures(docs, labels)).select("*", F.explode(steps()).alias("s"))

    def of(coalition: Column, value: str) -> Column:
        return F.element_at(F.col("table"), coalition + 1)[value]

    before, after = F.col("s.before"), F.col("s.after")
    alone = after - before
    removed = of(after, "n") - of(before, "n")
    return parts.select(
        "part",
        "s.filter_order",
        "s.step",
        (F.col("total") - of(after, "n")).alias("kept"),
        removed.alias("removed"),
        (of(alone, "n") - removed).alias("redundant"),
        (of(F.lit(ALL), "n") - of(ALL - alone, "n")).alias("unique_fails"),
        (of(after, "good") - of(before, "good")).alias("good_lost"),
        (of(after, "toxic") - of(before, "toxic")).alias("toxic_lost"),
        F.element_at("shapley", F.col("s.filter") + 1).alias("shapley"),
    )


def audit_sql() -> str:
    """The same for DuckDB, each order applied document by document: no coalitions, no fit."""
    space = "[^\\x20\\x09-\\x0D]+"
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{space}') AS w FROM documents),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS e4,
         coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false) AS e5
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
g AS (
  SELECT part, map(['A', 'B', 'C', 'D', 'E'], [a, b, c, e4, e5]) AS m, count(*) AS n,
         sum(good::INT) AS good, sum(toxic::INT) AS toxic FROM f GROUP BY part, m),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT [p.x, q.x, r.x, s.x, t.x] AS o FROM x AS p, x AS q, x AS r, x AS s, x AS t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
k AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM o),
j AS (
  SELECT part, o, step, o[step] AS x, n, good, toxic, m[o[step]] AS fails,
         len(list_filter(o[1:step - 1], lambda y: m[y])) > 0 AS gone,
         len(list_filter(o, lambda y: m[y])) = 1 AND m[o[step]] AS alone FROM g, k),
r AS (
  SELECT part, o, step, x, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fails), 0) AS removed,
         coalesce(sum(n) FILTER (gone AND fails), 0) AS redundant,
         coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND fails), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND fails), 0) AS toxic_lost
  FROM j GROUP BY part, o, step, x)
SELECT part, array_to_string(o, '') AS filter_order, CAST(step AS INTEGER) AS step,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r"""
