"""Quartiles, whiskers and outliers per plant: exact at any size, or from a mergeable sketch."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUARTILES = {"q1": 0.25, "median": 0.50, "q3": 0.75}
FENCE = 1.5  # interquartile ranges
# Parts of a range of values in one round of narrowing, and rounds: values closer than the range
# divided by CELLS ** ROUNDS are put in order in one task, all others by counting.
CELLS = 4096
ROUNDS = 2
# Relative error of a sketched quantile.
ERROR = 0.01


def _position(share: float, method: str) -> Column:
    """Place of a quantile among values numbered from 0."""
    n = F.col("_n")
    if method == "linear":
        return (n - 1) * F.lit(share)
    if method == "midpoint":
        return F.greatest(F.lit(0.0), F.least(n * F.lit(share) - 0.5, (n - 1).cast("double")))
    raise ValueError(f"unknown method {method!r}: linear or midpoint")


def _counted(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each value of each key once. All further steps start here, so that they share one shuffle and
    a value that makes up much of the table is one row."""
    present = df.select(F.col(key).alias("_key"), F.col(value).cast("double").alias("_value"))
    present = present.dropna(subset=["_value"])
    return present.groupBy("_key", "_value").agg(F.count(F.lit(1)).alias("_copies"))


def _at(counted: DataFrame, ranks: DataFrame, cells: int) -> DataFrame:
    """The values at given ranks (from 0) of each key: `_key`, `_rank`, `_value`.

    Selection by counting: the range of a key is cut into cells, the cells are counted, and only those
    that hold a rank are cut again. What is put in order at last is one small cell."""
    at = ["_key", *[f"_cell{k}" for k in range(ROUNDS)]]
    rows, wanted, known = counted, ranks.withColumn("_left", F.col("_rank")), ["_key"]
    for name in at[1:]:
        # Counted along with the ends, so that this step as well starts from the shared shuffle.
        ends = rows.groupBy(*known).agg(
            F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.sum("_copies").alias("_all")
        )
        part = (F.col("_value") - F.col("_low")) / (F.col("_high") - F.col("_low")) * cells
        several = (F.col("_all") > 1) & (F.col("_high") > F.col("_low"))
        cell = F.when(several, F.least(F.floor(part), F.lit(cells - 1))).otherwise(0)
        rows = _joined(rows, ends, known).withColumn(name, cell.cast("long")).drop("_low", "_high", "_all")
        sizes = rows.groupBy(*known, name).agg(F.sum("_copies").alias("_size"))
        line = Window.partitionBy(*known).orderBy(name)
        sizes = sizes.withColumn("_before", F.sum("_size").over(line) - F.col("_size"))
        here = (F.col("_left") >= F.col("_before")) & (F.col("_left") < F.col("_before") + F.col("_size"))
        wanted = _joined(wanted, sizes, known).filter(here)
        wanted = wanted.withColumn("_left", F.col("_left") - F.col("_before")).drop("_before", "_size")
        known = [*known, name]
        # Null keys are a key too, so cells are matched null-safe as everywhere here.
        rows = _joined(rows, wanted.select(*known).distinct(), known)
    line = Window.partitionBy(*at).orderBy("_value")
    placed = rows.withColumn("_upto", F.sum("_copies").over(line))
    here = (F.col("_left") >= F.col("_upto") - F.col("_copies")) & (F.col("_left") < F.col("_upto"))
    return _joined(placed, wanted, at).filter(here).select("_key", "_rank", "_value")


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe inner join on keys of both sides."""
    renamed = right.withColumnsRenamed({k: f"{k}_r" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in keys]
    return left.join(renamed, same).drop(*[f"{k}_r" for k in keys])


def _quantiles(counted: DataFrame, shares: dict[str, float], method: str, cells: int) -> DataFrame:
    sizes = counted.groupBy("_key").agg(F.sum("_copies").alias("_n"))
    places = {name: _position(share, method) for name, share in shares.items()}
    both = [f(place).cast("long") for place in places.values() for f in (F.floor, F.ceil)]
    ranks = sizes.select("_key", F.explode(F.array_distinct(F.array(*both))).alias("_rank"))
    values = _at(counted, ranks, cells).groupBy("_key").agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_value"))).alias("_values")
    )
    found = _joined(sizes, values, ["_key"])
    results = []
    for name, place in places.items():
        low, high = (F.element_at("_values", f(place).cast("long")) for f in (F.floor, F.ceil))
        results.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return found.select("_key", F.col("_n").alias("n"), *results)


def exact_quantiles(
    df: DataFrame,
    key: str,
    value: str,
    shares: dict[str, float] = QUARTILES,
    method: str = "linear",
    cells: int = CELLS,
) -> DataFrame:
    """Interpolated quantiles per key without holding or ordering the values of a key in one task.

    `linear` places a quantile at q(n-1), `midpoint` at qn-1/2. Nulls and NaN take no part; values
    are finite."""
    return _quantiles(_counted(df, key, value), shares, method, cells).withColumnRenamed("_key", key)


def power_distribution(
    readings: DataFrame,
    value: str = "power_mw",
    key: str = "plant_id",
    method: str = "linear",
) -> DataFrame:
    """Box plot numbers: quartiles, fences, the farthest values inside them, outlier count. Whiskers
    and outliers come from the counted values as well, so readings are looked at once."""
    counted = _counted(readings, key, value)
    boxes = fences(_quantiles(counted, QUARTILES, method, CELLS))
    inside = F.col("_value").between(F.col("lower_fence"), F.col("upper_fence"))
    quartiles = ["n", *QUARTILES, "lower_fence", "upper_fence"]
    grouped = _joined(counted, boxes, ["_key"]).groupBy("_key", *quartiles)
    return grouped.agg(
        F.min(F.when(inside, F.col("_value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_value"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_copies"))).alias("outliers"),
    ).withColumnRenamed("_key", key)


# Sketches ---------------------------------------------------------------------------------------


def quantile_sketch(df: DataFrame, key: str, value: str, error: float = ERROR) -> DataFrame:
    """Counts of values in bins whose bounds grow by the same factor: `key`, `sign`, `bin`, `n`.

    One pass, combined before the shuffle. A bin's middle is within `error` of each of its values, so
    every quantile is, whatever the distribution and the number of values. A key has a few hundred
    bins for each power of ten times ten of its range."""
    size = F.abs(F.col(value).cast("double"))
    sign = F.signum(F.col(value).cast("double")).cast("int")
    place = F.ceil(F.log(size) / math.log((1 + error) / (1 - error))).cast("long")
    named = df.dropna(subset=[value]).select(key, sign.alias("sign"), F.when(sign != 0, place).otherwise(0).alias("bin"))
    return named.groupBy(key, "sign", "bin").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(sketches: DataFrame, key: str) -> DataFrame:
    """One sketch out of many, such as those of single days; the order does not matter."""
    return sketches.groupBy(key, "sign", "bin").agg(F.sum("n").alias("n"))


def sketched_quantiles(
    sketch: DataFrame, key: str, shares: dict[str, float] = QUARTILES, error: float = ERROR
) -> DataFrame:
    """Estimates of the values at rank floor(q(n-1)); `error` is that of the sketch."""
    factor = (1 + error) / (1 - error)
    middle = F.col("sign") * 2 * F.pow(F.lit(factor), F.col("bin")) / (factor + 1)
    line = Window.partitionBy(key).orderBy(F.col("sign") * 1.0, F.col("sign") * F.col("bin"))
    whole = Window.partitionBy(key)
    placed = sketch.withColumns({"_upto": F.sum("n").over(line), "_n": F.sum("n").over(whole), "_middle": middle})
    picks = [
        F.min(F.when(F.floor((F.col("_n") - 1) * share) < F.col("_upto"), F.struct("_upto", "_middle")))["_middle"].alias(name)
        for name, share in shares.items()
    ]
    return placed.groupBy(key).agg(F.max("_n").alias("n"), *picks)


def fences(boxes: DataFrame) -> DataFrame:
    reach = (F.col("q3") - F.col("q1")) * FENCE
    return boxes.withColumns(
        {"lower_fence": F.col("q1") - reach, "upper_fence": F.col("q3") + reach}
    )


def power_outliers(
    readings: DataFrame,
    value: str = "power_mw",
    key: str = "plant_id",
    method: str = "linear",
) -> DataFrame:
    """The readings outside the fences of their plant."""
    boxes = fences(exact_quantiles(readings, key, value, method=method))
    limits = boxes.select(F.col(key).alias("_key"), "lower_fence", "upper_fence")
    outside = (F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence"))
    return readings.join(limits, F.col(key).eqNullSafe(F.col("_key"))).drop("_key").filter(outside)
