"""Quality rules: documents whose text statistics are robust multivariate outliers of their language and source.

Every document gets base counts and a vector of transformed statistics. Location and scatter of the vectors
are estimated per (language, source) by the minimum covariance determinant: from two deterministic starts,
concentration steps repeat "measure all documents, keep the ``SUPPORT`` share that lies nearest, estimate
again" until no group's rows change, and the start with the smaller determinant wins. A document is rejected if its
squared Mahalanobis distance is beyond a chi-square quantile. Groups whose rows still changed at step
``CONCENTRATION_STEPS`` are reported as not settled.

Whatever looks at documents is a column expression. The vectors are fixed-point integers, so all sums are exact and the
estimates do not depend on task order. A concentration step is one aggregate over (group, distance bin), so
rows are added up within their task and a group of any size never meets in one place. Between two steps the moments, one row
per start and group, are pooled and inverted: on the driver for up to ``DRIVER_ROWS`` rows, as MLlib does with the centres
of k-means, and by further queries for more. Both follow the same formulas.

Small groups: the moments of a group are mixed with ``PRIOR_ROWS`` pseudo-rows that have the moments of its
language, and those of a language with as many that have the moments of the whole table. Each statistic has
a least standard deviation, as most clean texts have no symbols or repeated lines at all.

Defined results: a null text has no words; null and empty languages or sources are one group; a text that
fails the base rules takes no part in the estimates; a table in which every text fails has no estimates and
no text of it is kept.
"""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.session import broadcast_if_small, is_small, materialize

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SUPPORT = 0.75
CONCENTRATION_STEPS = 30  # at most
PRIOR_ROWS = 50
REJECT_QUANTILE = 0.9999
FIXED_POINT = 256
BINS_PER_UNIT = 16
DRIVER_ROWS = 10_000  # starts times groups

#: Word length, symbols, repeated lines, capitals, repeated words, text length: (expression, least deviation).
STATISTICS = [
    ("ln(word_chars / n_words)", 0.06),
    ("ln(1 + 100 * n_symbols / n_words)", 0.6),
    ("n_dup_lines / n_lines", 0.15),
    ("least(1, n_capitals / n_words)", 0.1),
    ("n_repeat_words / n_words", 0.1),
    ("ln(n_words)", 0.8),
]
D = len(STATISTICS)
PAIRS = [(i, j) for i in range(D) for j in range(i, D)]
GROUP = ["_lang", "_source"]
MOMENTS = [f"_a{i}" for i in range(D)] + [f"_b{i}_{j}" for i, j in PAIRS]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_SPACE = r"[\\x20\\x09-\\x0D]"
_WORD = r"[^\\x20\\x09-\\x0D]"


def chi_square_quantile(p: float, dof: int) -> float:
    """The Wilson-Hilferty approximation, good to a few parts in a thousand."""
    z = NormalDist().inv_cdf(p)
    return dof * (1 - 2 / (9 * dof) + z * (2 / (9 * dof)) ** 0.5) ** 3


def with_base_counts(docs: DataFrame) -> DataFrame:
    """``docs`` plus the base counts, ``base_failed``, and the working columns ``_lang``, ``_source``, ``_q0``...

    Three-word windows are packed into integers that carry a hash above and the position below, so that one
    sort of integers brings equal windows together; windows with equal hashes are compared by their words.
    """
    names = [c for c in docs.columns if c not in {*BASE, "n_lines", "n_capitals", "base_failed"}]
    kept = [F.col(f"`{c}`") for c in names]
    text = docs.select(*kept, F.coalesce("text", F.lit("")).alias("_t"))
    pieces = text.select("*", F.expr(f"split(_t, '{_SPACE}')").alias("_p"))
    words = pieces.select(
        "*",
        F.expr("array_remove(_p, '')").alias("_w"),
        F.expr("char_length(_t) - (size(_p) - 1)").cast("long").alias("word_chars"),
        F.expr(f"filter(split(_t, '\\n'), l -> l rlike '{_WORD}')").alias("_l"),
        F.expr("regexp_count(_t, '[#*$%&|<>]')").cast("long").alias("n_symbols"),
        F.expr(r"regexp_count(_t, '\\p{Lu}{2,}')").cast("long").alias("n_capitals"),
    ).drop("_t", "_p")
    sized = words.select(
        *kept,
        "word_chars",
        "n_symbols",
        "n_capitals",
        "_w",
        F.expr("size(_w)").cast("long").alias("n_words"),
        F.expr("size(_l)").cast("long").alias("n_lines"),
        F.expr("size(_l) - size(array_distinct(_l))").cast("long").alias("n_dup_lines"),
        F.expr("shiftleft(-1L, length(bin(size(_w))))").alias("_high"),
    )
    packed = sized.withColumn(
        "_s",
        F.expr(
            """sort_array(if(n_words < 3, cast(array() as array<bigint>),
                 transform(sequence(0, cast(n_words as int) - 3),
                   i -> (xxhash64(_w[i], _w[i + 1], _w[i + 2]) & _high) | i)))"""
        ),
    )
    equal_words = " AND ".join(
        f"_w[cast(_s[j] & ~_high as int) + {k}] = _w[cast(_s[j + 1] & ~_high as int) + {k}]" for k in range(3)
    )
    neighbours = packed.withColumn(
        "_e",
        F.expr(
            f"""if(n_words < 4, cast(array() as array<int>), filter(sequence(0, cast(n_words as int) - 4),
                 j -> ((_s[j] ^ _s[j + 1]) & _high) = 0 AND {equal_words}))"""
        ),
    )
    repeated = neighbours.withColumn(
        "_r",
        F.expr(
            """sort_array(array_distinct(flatten(
                 transform(_e, j -> array(_s[j] & ~_high, _s[j + 1] & ~_high)))))"""
        ),
    )
    counted = repeated.withColumn(
        "n_repeat_words",
        F.expr("aggregate(transform(_r, (p, j) -> least(3L, coalesce(get(_r, j + 1) - p, 3L))), 0L, (a, x) -> a + x)"),
    )
    judged = counted.withColumn(
        "base_failed",
        F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    )
    vector = [
        F.expr(f"if(base_failed, null, cast(round({FIXED_POINT} * ({statistic})) as bigint))").alias(f"_q{i}")
        for i, (statistic, _) in enumerate(STATISTICS)
    ]
    made = F.struct(
        *BASE,
        "base_failed",
        F.coalesce("lang", F.lit("")).alias("_lang"),
        F.coalesce("source", F.lit("")).alias("_source"),
        *vector,
    )
    # a filter on the counts must not move below them: Spark would put all that they are made of into its condition
    return judged.select(*kept, F.inline_outer(F.array(made)))


def _floor(i: int) -> float:
    return FIXED_POINT * STATISTICS[i][1]


def _with_inverse(estimates: DataFrame) -> DataFrame:
    """``_m*`` and ``_c*_*`` (mean and covariance) to ``_m*``, ``_p*_*`` (inverse covariance) and ``_logdet``."""
    rows = ", ".join(
        "array(" + ", ".join(f"_c{min(i, j)}_{max(i, j)}" for j in range(D)) + ")" for i in range(D)
    )
    eliminated = f"""aggregate(sequence(0, {D - 1}), named_struct('m', array({rows}), 'l', 0D), (s, k) -> named_struct(
        'm', transform(s.m, (row, i) -> transform(row, (a, j) -> CASE
            WHEN i = k AND j = k THEN 1 / a
            WHEN i = k THEN a / s.m[k][k]
            WHEN j = k THEN -a / s.m[k][k]
            ELSE a - s.m[i][k] * s.m[k][j] / s.m[k][k] END)),
        'l', s.l + ln(s.m[k][k])))"""
    keys = [c for c in estimates.columns if not c.startswith(("_m", "_c"))]
    means = [f"_m{i}" for i in range(D)]
    return estimates.withColumn("_e", F.expr(eliminated)).select(
        *keys,
        *means,
        *(F.col("_e.m")[i][j].alias(f"_p{i}_{j}") for i, j in PAIRS),
        F.col("_e.l").alias("_logdet"),
    )


def _distance() -> Column:
    """The squared Mahalanobis distance of ``_q*`` under ``_m*`` and ``_p*_*``."""
    return F.expr(
        " + ".join(f"{1 if i == j else 2} * _p{i}_{j} * (_q{i} - _m{i}) * (_q{j} - _m{j})" for i, j in PAIRS)
    )


def _binned(stats: DataFrame, estimates: DataFrame, totals: list[Column], small: bool) -> DataFrame:
    """Per start, group and distance bin: the row count ``_n``, ``totals``, and the rows before and in all bins."""
    measured = stats.join(F.broadcast(estimates) if small else estimates, GROUP).withColumn(
        "_bin", F.floor(F.log1p(F.greatest(_distance(), F.lit(0.0))) * BINS_PER_UNIT)
    )
    counted = measured.groupBy("_start", *GROUP, "_bin").agg(F.count(F.lit(1)).alias("_n"), *totals)
    group = "partition by _start, _lang, _source"
    return counted.select(
        "*",
        F.expr(f"sum(_n) over ({group} order by _bin) - _n").alias("_before"),
        F.expr(f"sum(_n) over ({group})").alias("_all"),
    )


def _moments() -> list[Column]:
    first = [F.expr(f"sum(_q{i}) as _a{i}") for i in range(D)]
    return first + [F.expr(f"sum(_q{i} * _q{j}) as _b{i}_{j}") for i, j in PAIRS]


def _pooled(sums: DataFrame) -> DataFrame:
    """Mean and covariance per start and group from moment sums, drawn towards language and table."""
    moments = MOMENTS

    def total(keys: list[str]) -> DataFrame:
        return sums.groupBy(*keys).agg(F.sum("_n").alias("_n"), *(F.expr(f"sum({c}) as {c}") for c in moments))

    def towards(small: DataFrame, large: DataFrame, keys: list[str]) -> DataFrame:
        wide = large.selectExpr(*keys, *(f"{c} / _n as w{c}" for c in moments))
        return small.join(wide, keys).selectExpr(
            *(c for c in small.columns if c not in {"_n", *moments}),
            f"cast(_n + {PRIOR_ROWS} as double) as _n",
            *(f"{c} + {PRIOR_ROWS} * w{c} as {c}" for c in moments),
        )

    language = towards(total(["_start", "_lang"]), total(["_start"]), ["_start"])
    mixed = towards(sums, language, ["_start", "_lang"])
    return mixed.selectExpr(
        "_start",
        *GROUP,
        *(f"_a{i} / _n as _m{i}" for i in range(D)),
        *(
            f"_b{i}_{j} / _n - _a{i} * _a{j} / (_n * _n) + {_floor(i) ** 2 if i == j else 0.0}D as _c{i}_{j}"
            for i, j in PAIRS
        ),
    )


def _starts(stats: DataFrame) -> DataFrame:
    """Two starts per group around the coordinate medians: scaled by the median deviations, and the covariance
    of the directions in which documents lie from the centre, which no far document can pull."""
    medians = materialize(
        stats.groupBy(*GROUP).agg(*(F.percentile(f"_q{i}", F.lit(0.5)).alias(f"_m{i}") for i in range(D))), "mcd-centre"
    )
    placed = stats.join(broadcast_if_small(medians), GROUP)
    spreads = materialize(
        placed.groupBy(*GROUP, *(f"_m{i}" for i in range(D))).agg(
            *(
                F.greatest(
                    1.4826 * F.percentile(F.abs(F.col(f"_q{i}") - F.col(f"_m{i}")), F.lit(0.5)), F.lit(_floor(i))
                ).alias(f"_s{i}")
                for i in range(D)
            )
        ),
        "mcd-spread",
    )
    means = [f"_m{i}" for i in range(D)]
    deviations = [f"_s{i}" for i in range(D)]
    scaled = spreads.selectExpr(
        "0 as _start",
        *GROUP,
        *means,
        *(f"{f'_s{i} * _s{i}' if i == j else '0D'} as _c{i}_{j}" for i, j in PAIRS),
    )
    unit = stats.join(broadcast_if_small(spreads), GROUP).selectExpr(
        *GROUP, *means, *deviations, *(f"(_q{i} - _m{i}) / _s{i} as _z{i}" for i in range(D))
    )
    unit = unit.selectExpr("*", " + ".join(f"_z{i} * _z{i}" for i in range(D)) + " as _norm")
    # rounded to integers, so that the sum is exact
    signs = unit.groupBy(*GROUP, *means, *deviations).agg(
        F.expr("count(1) as _n"),
        *(
            F.expr(f"sum(cast(round(if(_norm > 0, 1e6 * _z{i} * _z{j} / _norm, 0)) as bigint)) as _u{i}_{j}")
            for i, j in PAIRS
        ),
    )
    signed = signs.selectExpr(
        "1 as _start",
        *GROUP,
        *means,
        *(
            f"{D} * _u{i}_{j} / 1e6 / _n * _s{i} * _s{j} + {_floor(i) ** 2 if i == j else 0.0}D as _c{i}_{j}"
            for i, j in PAIRS
        ),
    )
    return materialize(_with_inverse(scaled.unionByName(signed)), "mcd-start")


def _driver_estimates(sums: list) -> dict[tuple, np.ndarray]:
    """``_with_inverse(_pooled(sums))`` of collected rows: means, inverse (upper triangle) and ``_logdet`` by start and group."""
    keys = [tuple(r[:3]) for r in sums]
    n = np.array([r[3] for r in sums], dtype=np.int64)
    moments = np.array([r[4:] for r in sums], dtype=np.int64)

    def total(names: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known = {name: i for i, name in enumerate(dict.fromkeys(names))}
        place = np.array([known[name] for name in names])
        rows, first = np.zeros(len(known), dtype=np.int64), np.zeros((len(known), len(MOMENTS)), dtype=np.int64)
        np.add.at(rows, place, n)
        np.add.at(first, place, moments)
        return place, rows, first

    language, n_language, of_language = total([k[:2] for k in keys])
    start, n_start, of_start = total([k[0] for k in keys])
    above = np.zeros(len(n_language), dtype=np.int64)
    above[language] = start
    of_language = of_language + PRIOR_ROWS * (of_start / n_start[:, None])[above]
    n_language = (n_language + PRIOR_ROWS).astype(float)
    mixed = moments + PRIOR_ROWS * (of_language / n_language[:, None])[language]
    n = (n + PRIOR_ROWS).astype(float)
    a, b = mixed[:, :D], mixed[:, D:]
    m = np.zeros((len(keys), D, D))
    for p, (i, j) in enumerate(PAIRS):
        m[:, i, j] = b[:, p] / n - a[:, i] * a[:, j] / (n * n) + (_floor(i) ** 2 if i == j else 0.0)
        m[:, j, i] = m[:, i, j]
    logdet = np.zeros(len(keys))
    for k in range(D):
        pivot = m[:, k, k].copy()
        logdet += np.log(pivot)
        done = m - m[:, :, k, None] * m[:, k, None, :] / pivot[:, None, None]
        done[:, k, :] = m[:, k, :] / pivot[:, None]
        done[:, :, k] = -m[:, :, k] / pivot[:, None]
        done[:, k, k] = 1 / pivot
        m = done
    inverse = np.stack([m[:, i, j] for i, j in PAIRS], axis=1)
    return dict(zip(keys, np.concatenate([a / n[:, None], inverse, logdet[:, None]], axis=1)))


def _as_table(stats: DataFrame, estimates: dict[tuple, np.ndarray], settled: list[bool] | None = None) -> DataFrame:
    names = [f"_m{i}" for i in range(D)] + [f"_p{i}_{j}" for i, j in PAIRS] + ["_logdet"]
    keys, values = list(estimates), np.array(list(estimates.values())).reshape(len(estimates), len(names))
    columns = {"_start": pa.array([k[0] for k in keys], pa.int32())}
    columns |= {g: pa.array([k[i + 1] for k in keys], pa.string()) for i, g in enumerate(GROUP)}
    columns |= {name: pa.array(values[:, i]) for i, name in enumerate(names)}
    if settled is not None:
        columns["_settled"] = pa.array(settled, pa.bool_())
    return stats.sparkSession.createDataFrame(pa.table(columns))


def _concentrated(usable: DataFrame, estimates: DataFrame, support: float, small: bool) -> DataFrame:
    """One step: ``_n`` and the moments of the nearest rows, per start and group."""
    bins = _binned(usable, estimates, _moments(), small)
    nearest = bins.filter(F.col("_before") < F.ceil(F.col("_all") * support))
    return nearest.groupBy("_start", *GROUP).agg(F.sum("_n").alias("_n"), *(F.sum(c).alias(c) for c in MOMENTS))


def _chosen_on_driver(usable: DataFrame, estimates: DataFrame, steps: int, support: float) -> DataFrame:
    """The better start of each group after concentration, with ``_settled``; one query a step."""
    names = [f"_m{i}" for i in range(D)] + [f"_p{i}_{j}" for i, j in PAIRS] + ["_logdet"]
    rows = estimates.select("_start", *GROUP, *names).collect()
    known = {tuple(r[:3]): np.array(r[3:], dtype=float) for r in rows}
    before = moved = None
    for _ in range(steps if known else 0):
        sums = _concentrated(usable, _as_table(usable, known), support, True).collect()
        # the sums are exact, so groups with the sums of the step before have kept the same rows
        moved = set(map(tuple, sums)) - (before or set())
        if not moved:
            break
        before = set(map(tuple, sums))
        known = _driver_estimates(sums)
    best = {}
    for key in known:
        logdet = known[key][-1]
        best[key[1:]] = min(best.get(key[1:], ((True, np.inf, 3), None)), ((bool(np.isnan(logdet)), logdet, key[0]), key), key=lambda e: e[0])
    unsettled = set(known) if moved is None else {m[:3] for m in moved}
    chosen = {key: known[key] for _, key in best.values()}
    return _as_table(usable, chosen, [key not in unsettled for key in chosen])


def _chosen_by_queries(usable: DataFrame, estimates: DataFrame, steps: int, support: float, small: bool) -> DataFrame:
    """The same for any number of groups; the estimates stay tables."""
    key = ["_start", *GROUP]
    before = moved = None
    for _ in range(steps):
        sums = materialize(_concentrated(usable, estimates, support, small), "mcd-sums")
        moved = sums if before is None else sums.subtract(before)
        if moved.isEmpty():
            break
        before = sums
        estimates = materialize(_with_inverse(_pooled(sums)), "mcd-step")
    best = estimates.groupBy(*GROUP).agg(F.min(F.struct("_logdet", "_start")).alias("_best"))
    chosen = materialize(
        estimates.join(best, GROUP).filter("_start = _best._start").drop("_best"), "mcd-best"
    )
    if moved is None:
        return chosen.withColumn("_settled", F.lit(False))
    unsettled = moved.select(*key, F.lit(False).alias("_settled"))
    chosen = chosen.join(F.broadcast(unsettled) if small else unsettled, key, "left")
    return chosen.fillna(True, ["_settled"])


def fit_groups(stats: DataFrame, steps: int = CONCENTRATION_STEPS, support: float = SUPPORT) -> DataFrame:
    """The estimates per ``_lang`` and ``_source``: ``_m*``, ``_p*_*``, ``_limit``, the largest squared distance kept, and
    ``_settled``, whether a further step would keep the same rows.

    ``stats`` holds ``_lang``, ``_source`` and ``_q*``, and should be stored, as each step reads it. ``_limit``
    is the chi-square quantile times the ratio of the median distance to its expected value, if above one.
    """
    usable = stats.filter("NOT base_failed")
    estimates = _starts(usable)
    small = is_small(estimates)  # every step has as many rows
    # queries are few and small here, as the driver keeps the plans and tasks of all
    if small and estimates.count() <= DRIVER_ROWS:
        chosen = _chosen_on_driver(usable, estimates, steps, support)
    else:
        chosen = _chosen_by_queries(usable, estimates, steps, support, small)
    bins = _binned(usable, chosen, [], small)
    middle = bins.filter("_before * 2 < _all").groupBy(*GROUP).agg(F.max("_bin").alias("_bin"))
    expected = chi_square_quantile(0.5, D)
    scale = F.greatest(F.lit(1.0), F.expm1((F.col("_bin") + 0.5) / BINS_PER_UNIT) / expected)
    fitted = chosen.join(middle, GROUP).withColumn("_limit", scale * chi_square_quantile(REJECT_QUANTILE, D))
    return materialize(fitted.drop("_bin", "_start", "_logdet"), "mcd-fit")


def judge(stats: DataFrame, fitted: DataFrame) -> DataFrame:
    """``stats`` plus ``distance`` (squared, as a share of the group's limit), ``kept`` and ``settled`` (null without a group)."""
    helpers = [c for c in fitted.columns if c not in {*GROUP, "_settled"}]
    joined = stats.join(broadcast_if_small(fitted), GROUP, "left")
    share = F.when(~F.col("base_failed"), _distance() / F.col("_limit"))
    return (
        joined.withColumn("distance", share)
        .withColumn("kept", F.coalesce(F.col("distance") <= 1, F.lit(False)))
        .withColumnRenamed("_settled", "settled")
        .drop(*helpers, *GROUP, *(f"_q{i}" for i in range(D)))
    )


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the base counts, ``base_failed``, ``kept``, ``distance`` and ``settled``."""
    columns = ["doc_id", *BASE, "base_failed", *GROUP, *(f"_q{i}" for i in range(D))]
    stats = materialize(with_base_counts(docs.select("doc_id", "text", "lang", "source")).select(*columns), "stats")
    return judge(stats, fit_groups(stats)).select("doc_id", *BASE, "base_failed", "kept", "distance", "settled")


def keep_quality(docs: DataFrame) -> DataFrame:
    """The documents that :func:`quality_verdicts` keeps, with their own columns.

    The counts are made again for the verdicts rather than joined back, as ids may be null or repeated and
    a join would shuffle every text.
    """
    stats = with_base_counts(docs.select("text", "lang", "source"))
    stats = materialize(stats.select("base_failed", *GROUP, *(f"_q{i}" for i in range(D))), "stats")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"), "text", "lang", "source")
    judged = judge(with_base_counts(packed), fit_groups(stats))
    return judged.filter("kept").select("_row.*")
