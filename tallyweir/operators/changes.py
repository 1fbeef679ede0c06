"""Increments of changed rows: corrections, new rows and planted faults."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.operators.rank import global_rank

SLICE_SAMPLE = 20_000  # values that the driver gets to bracket the cuts


def row_slices(
    df: DataFrame, order: list[Column], slices: dict[str, tuple[int, int]], lead: str | None = None
) -> dict[str, DataFrame]:
    """Row ranges [from, to) of the table in the given order, counted from 0.

    ``lead`` names the column that the order begins with, ascending; ``df`` should then be stored. Each cut is bracketed by two
    sampled values of it, and all rows are counted against these. Only the rows within brackets are ranked, all others belong
    to a slice by their value. That is exact whatever the sample: if a cut falls beside its bracket, all rows are ranked.
    """
    regions = _regions(df, lead, sorted({cut for pair in slices.values() for cut in pair})) if lead else None
    if regions is None:
        numbered = global_rank(df, order, output="_row", start=0)
        return {name: _between(numbered, low, high) for name, (low, high) in slices.items()}
    shift, ranked_before, unsure = F.lit(0), 0, F.lit(False)
    for test, first, size, is_bracket in regions:
        if is_bracket:
            shift, unsure = F.when(test, first - ranked_before).otherwise(shift), unsure | test
            ranked_before += size
    ranked = global_rank(df.filter(unsure), order, output="_place", start=0)
    numbered = ranked.withColumn("_row", F.col("_place") + shift).drop("_place")
    found = {}
    for name, (low, high) in slices.items():
        sure = [test for test, first, size, is_bracket in regions if not is_bracket and low <= first and first + size <= high]
        whole = df.filter(reduce(lambda a, b: a | b, sure, F.lit(False)))
        found[name] = whole.unionByName(_between(numbered, low, high))
    return found


def _between(numbered: DataFrame, low: int, high: int) -> DataFrame:
    return numbered.filter((F.col("_row") >= low) & (F.col("_row") < high)).drop("_row")


def _regions(df: DataFrame, lead: str, cuts: list[int]) -> list[tuple[Column, int, int, bool]] | None:
    """(test, first row, rows, whether a bracket) of consecutive regions by ``lead``; None if a cut is outside of all brackets."""
    total = df.count()
    inner = [c for c in cuts if 0 < c < total]
    sample = df.select(lead).sample(min(1.0, SLICE_SAMPLE / max(1, total)), seed=7)
    values = sorted((r[0] for r in sample.collect()), key=lambda v: (v is not None, v))
    nulls = values.count(None)  # they come first
    brackets = []  # places in the sample, apart from each other
    for cut in inner:
        place, share = cut / total * len(values), cut / total
        margin = 5 * math.sqrt(len(values) * share * (1 - share)) + 2
        low, high = math.floor(place - margin), max(nulls, math.ceil(place + margin))
        low = low if low >= nulls else -1
        if brackets and (low <= brackets[-1][1] or low < 0 or values[low] <= values[brackets[-1][1]]):
            brackets[-1][1] = high
        else:
            brackets.append([low, high])
        if high >= len(values):
            break
    column, edge, tests = F.col(lead), None, []
    for low, high in brackets:
        at_least = column >= F.lit(values[low]) if low >= 0 else F.lit(True)
        at_most = column <= F.lit(values[high]) if high < len(values) else F.lit(True)
        if low >= 0:
            tests.append((~at_least if edge is None else ~at_least & edge, False))
        tests.append((at_least & at_most, True))
        edge = ~at_most
    tests.append((F.lit(True) if edge is None else edge, False))
    tests = [(F.coalesce(test, F.lit(i == 0)), is_bracket) for i, (test, is_bracket) in enumerate(tests)]
    sizes = df.agg(*(F.count_if(test).alias(f"n{i}") for i, (test, _) in enumerate(tests))).first()
    regions, first = [], 0
    for (test, is_bracket), size in zip(tests, sizes):
        regions.append((test, first, size, is_bracket))
        if not is_bracket and any(first < cut < first + size for cut in inner):
            return None
        first += size
    return regions if first == total else None


def double_quantity(df: DataFrame, column: str = "Quantity") -> DataFrame:
    """Twice the quantity where the text is an integer, the text itself otherwise."""
    doubled = F.col(column).try_cast("bigint") * 2
    return df.withColumn(column, F.coalesce(doubled.cast("string"), F.col(column)))


def correction_batch(
    corrected: DataFrame, added: DataFrame, malformed: DataFrame | None = None
) -> DataFrame:
    """Known rows sent again with their quantity doubled, new rows, and malformed rows if given."""
    batch = double_quantity(corrected).unionByName(added)
    return batch if malformed is None else batch.unionByName(malformed)


def inject_duplicates(silver: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """``silver`` with its first ``n`` rows by key appended again, flagged as injected."""
    copies = silver.orderBy(*keys).limit(n).withColumn("_injected", F.lit(True))
    return silver.unionByName(copies.select(*silver.columns))
