"""Quality rules as weak supervision.

Each rule votes good (1), bad (0) or abstains (null). Expectation-maximisation over the counts of
vote patterns, of which there are at most 3 to the power of the rules, estimates how often each
rule is right; the posterior probability of good quality replaces a filter that all rules must pass.

Only DataFrame expressions touch documents. The counts of patterns are the one thing the driver
sees. Null text counts as empty. Rows are judged one by one, so repeated rows, ties, null ids and
further columns of any name make no difference; an empty table gives an empty table.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penstock.llm import common

# Frequent short words of the four languages.
STOP_WORDS = (
    "the and of to in is that with for was on are this be by from "
    "le la les de des et un une est que en du pour dans sur avec "
    "der die das und ist ein eine nicht mit den von sich auf im als "
    "el los las y del una por con para su al no se lo"
).split()

WINDOW = 5


def _bind(value: Column, use) -> Column:
    """`use(value)`, with `value` worked out once."""
    return F.transform(F.array(value), use)[0]


def _covered(windows: Column) -> Column:
    """Words inside windows that occur twice or more, from the hashes of a text's windows.

    Sorted by hash, equal windows are neighbours; sorted by place again, each window adds as many
    words as lie before the next one."""

    def from_sorted(s: Column) -> Column:
        def repeated(x: Column, i: Column) -> Column:
            before, after = F.get(s, i - 1)["h"], F.get(s, i + 1)["h"]
            return before.eqNullSafe(x["h"]) | after.eqNullSafe(x["h"])

        places = F.sort_array(F.transform(F.filter(s, repeated), lambda x: x["i"]))
        return _bind(places, gaps)

    def gaps(p: Column) -> Column:
        steps = F.transform(
            p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return _bind(F.sort_array(pairs), from_sorted)


def signals(docs: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """`row` (the document as a struct of the `carried` columns, all by default) and `s`, the numbers
    the rules look at."""
    split = docs.select(
        F.struct(*(carried or docs.columns)).alias("row"),
        F.coalesce("text", F.lit("")).alias("t"),
        common.words(F.coalesce("text", F.lit(""))).alias("w"),
    )
    hashed = split.select("row", "t", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    around = hashed.select(
        "row",
        "t",
        "w",
        "h",
        F.when(
            F.size("h") >= WINDOW,
            F.transform(
                F.sequence(F.lit(0), F.size("h") - WINDOW),
                lambda i: F.xxhash64(*[F.get("h", i + k) for k in range(WINDOW)]),
            ),
        ).alias("windows"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(common.WORD)).alias("lines"),
    )
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    stops = F.array(*[F.xxhash64(F.lit(x)) for word in STOP_WORDS for x in (word, word.title())])
    numbers = {
        "n_words": F.size("w"),
        "word_chars": F.length(F.array_join("w", "")),
        "n_symbols": F.regexp_count("t", F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.when(again, _covered(F.col("windows"))).otherwise(0),
        "n_lines": F.size("lines"),
        "n_upper": F.regexp_count("t", F.lit(r"\p{Lu}")),
        "n_shouts": F.regexp_count("t", F.lit("!")),
        "n_stop_words": F.size(F.array_intersect("h", stops)),
    }
    # As rows of a generator the numbers are worked out once: no filter on them moves below it.
    whole = F.struct(*[number.cast("long").alias(name) for name, number in numbers.items()])
    return around.select("row", F.explode(F.array(whole)).alias("s"))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])


def votes(s: Column) -> dict[str, Column]:
    """Each rule's vote. Most rules know only what is bad; two know what is good."""
    n = s["n_words"]

    def bad(when: Column) -> Column:
        return F.when(when, 0)

    return {
        "length": bad(n < 10),
        "word_size": bad((s["word_chars"] < 2 * n) | (s["word_chars"] > 15 * n)),
        "symbols": bad(10 * s["n_symbols"] > n),
        "dup_lines": bad(10 * s["n_dup_lines"] > 3 * s["n_lines"]),
        "repeats": bad(100 * s["n_repeat_words"] > 20 * n),
        "capitals": bad(2 * s["n_upper"] > s["word_chars"]),
        "shouts": bad(10 * s["n_shouts"] > n),
        "prose": F.when((s["n_stop_words"] >= 3) & (n >= 20), 1).when(s["n_stop_words"] == 0, 0),
        "calm": F.when(
            (50 * s["n_symbols"] < n)
            & (50 * s["n_shouts"] < n)
            & (5 * s["n_upper"] < s["word_chars"])
            & (10 * s["n_dup_lines"] <= 3 * s["n_lines"])
            & (100 * s["n_repeat_words"] <= 20 * n),
            1,
        ),
    }


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and per rule the rates of its votes (bad, good, none) on bad and on
    good documents: its accuracy on either."""

    prior: float
    rates: dict[str, tuple[tuple[float, ...], tuple[float, ...]]]

    def weights(self, rule: str) -> list[float]:
        """What a vote for bad, a vote for good and an abstention add to the log odds of good."""
        on_bad, on_good = self.rates[rule]
        return [math.log(g / b) for b, g in zip(on_bad, on_good)]

    def probability(self, cast: dict[str, Column]) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for rule, vote in cast.items():
            bad, good, none = self.weights(rule)
            odds = odds + F.when(vote == 0, bad).when(vote == 1, good).otherwise(none)
        return 1 / (1 + F.exp(-odds))


def estimate(
    patterns: list[tuple[tuple[int | None, ...], int]], rules: list[str], rounds: int = 100
) -> VoteModel:
    """Expectation-maximisation over (votes, documents) pairs.

    It starts from every document with a vote for bad being bad, so good and bad cannot change
    places. Rates are smoothed, so rules that never vote are harmless."""
    posterior = [0.1 if 0 in pattern else 0.9 for pattern, _ in patterns]
    for at in range(rounds):
        size = [
            sum(n * (1 - p) for (_, n), p in zip(patterns, posterior)) + 1.0,
            sum(n * p for (_, n), p in zip(patterns, posterior)) + 1.0,
        ]
        prior = size[1] / (size[0] + size[1])
        tallies = [[[1 / 3] * 3, [1 / 3] * 3] for _ in rules]
        for (pattern, n), p in zip(patterns, posterior):
            for tally, vote in zip(tallies, pattern):
                kind = 2 if vote is None else vote
                tally[0][kind] += n * (1 - p)
                tally[1][kind] += n * p
        rates = [tuple(tuple(x / size[y] for x in t[y]) for y in (0, 1)) for t in tallies]
        model = VoteModel(prior, dict(zip(rules, rates)))
        adds = [model.weights(rule) for rule in rules]
        start = math.log(prior / (1 - prior))
        posterior = []
        for pattern, _ in patterns:
            odds = start + sum(add[2 if v is None else v] for add, v in zip(adds, pattern))
            posterior.append(1 / (1 + math.exp(-max(-500.0, min(500.0, odds)))))
    return model


def fit(scored: DataFrame) -> VoteModel:
    """The model of all documents. Collects one row per vote pattern, at most 3^9."""
    cast = votes(F.col("s"))
    counts = scored.select(*[v.alias(k) for k, v in cast.items()]).groupBy(*cast).count()
    rows = [(tuple(r[k] for k in cast), r["count"]) for r in counts.collect()]
    return estimate(sorted(rows, key=str), list(cast))


def _judged(scored: DataFrame, model: VoteModel, threshold: float) -> DataFrame:
    probability = model.probability(votes(F.col("s")))
    failed = base_failed(F.col("s"))
    return scored.select(
        "row",
        "s",
        failed.alias("base_failed"),
        probability.alias("quality"),
        (~failed & (probability >= threshold)).alias("kept"),
    )


def judge(docs: DataFrame, carried: list[str], threshold: float = 0.5) -> DataFrame:
    """`row` (the `carried` columns), `s`, `base_failed`, `quality` (posterior) and `kept` of every
    document. Texts are read once; the numbers about them wait in the shared folder for the fit."""
    scored = common.stored(signals(docs, carried), "signals")
    return _judged(scored, fit(scored), threshold)


def filtered(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that are kept, with their own columns. Texts are read twice, to fit and to
    judge, and never moved."""
    scored = signals(docs)
    return _judged(scored, fit(scored), threshold).where("kept").select("row.*")
