"""Quality classifier by co-training: a text view and a page-metadata view teach each other.

The text view sees hashed words and word shapes, and the share of distinct words. The metadata view sees language,
source, length, line layout and the shares of kinds of characters. Each is a logistic regression, and both start from
the labelled sample. In every round each classifier scores *all* unlabelled documents; the ones on which it is most
certain, the same share of each class as the labels have, are candidates for the *other* classifier, which learns a draw
of them: half of it in proportion, half of it evenly over the languages and sources, so that small ones take part. At the
end, each view is calibrated on labelled rows that were not trained on, and the calibrated log odds are added, less the
prior's. All documents are scored.

The features of all documents are stored once (hashed counts, a fraction of the text) and read in every round. Certainty
cuts come from counts of binned log odds over all unlabelled texts. Only what a regression is fitted on is bounded: about
``LABELLED_ROWS`` labelled and, per view and round, about ``TAUGHT_ROWS`` pseudo-labelled texts, chosen by a hash.

Defined results: null and empty texts have the features of no words; null language or source counts as empty; a text that
repeats under the same language and source is learned once, and every row of it is scored; an id that repeats with other
texts has all of them labelled by its label; labels with a null or conflicting quality for a document are left out; with
labels of one class only, that class's share of one is the score of every document; without labels the scores are null and
every document is kept. Texts are whole at any length. Other columns of the inputs are not looked at.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweir.session import broadcast_if_small, materialize

LABELLED_ROWS = 8000
TAUGHT_ROWS = 8000
ROUNDS = 3
GROWTH = 0.1  # share of the unlabelled texts that each view is certain of in the first round; it adds as much per round
HELD_OUT = 4  # one in so many labelled rows is kept for calibration
TEXT_FEATURES = 1 << 12
PLACE_FEATURES = 1 << 8
REGULARISATION = 1e-3
ODDS_BINS = 64  # per unit of log odds
ODDS_RANGE = 64  # log odds beyond this fall into the last bin

_VIEWS = ("text", "meta")


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` plus hashed counts ``_tf`` and ``_place`` and the numbers ``_d`` and ``_f0``... of its texts."""
    words = F.expr(r"array_remove(split(_t, '[\\x20\\x09-\\x0D]+'), '')")
    shaped = F.regexp_replace(F.regexp_replace("_t", r"\p{Lu}{2,}", "0"), r"\p{L}+", "x")
    shapes = F.transform(F.split(shaped, r"\s+"), lambda s: F.concat(F.lit("\u0001"), s))
    chars = F.greatest(F.char_length("_t"), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(F.col("_t"), F.lit(pattern)) / chars

    lines = F.size("_l")

    def distinct_share(column: str) -> Column:
        return F.size(F.array_distinct(column)) / F.greatest(F.size(column), F.lit(1))

    split = docs.withColumn("_t", F.coalesce("text", F.lit(""))).select(
        *(F.col(f"`{c}`") for c in docs.columns), "_t", words.alias("_w"), F.split("_t", "\n").alias("_l")
    )
    prepared = split.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.concat("_w", shapes).alias("_words"),
        distinct_share("_w").alias("_d"),
        distinct_share("_l").alias("_f7"),
        F.array(
            F.concat(F.lit("lang="), F.coalesce("lang", F.lit(""))),
            F.concat(F.lit("source="), F.coalesce("source", F.lit(""))),
        ).alias("_places"),
        F.log1p(F.char_length("_t").cast("double")).alias("_f0"),
        F.log1p(lines.cast("double")).alias("_f1"),
        F.log1p(F.char_length("_t") / lines).alias("_f2"),
        share(r"\p{Lu}").alias("_f3"),
        share(r"[^\p{L}\p{N}\s.,]").alias("_f4"),
        share(r"\p{N}").alias("_f5"),
        share(r"\s").alias("_f6"),
    )
    hashed = PipelineModel(
        [
            HashingTF(numFeatures=TEXT_FEATURES, inputCol="_words", outputCol="_tf"),
            HashingTF(numFeatures=PLACE_FEATURES, binary=True, inputCol="_places", outputCol="_place"),
        ]
    )
    return hashed.transform(prepared).drop("_words", "_places")


def as_views(features: DataFrame) -> DataFrame:
    """The vectors ``text_view`` and ``meta_view`` in place of the columns that :func:`with_features` adds."""
    numbers = [f"_f{i}" for i in range(8)]
    stages = PipelineModel(
        [
            Normalizer(inputCol="_tf", outputCol="_content"),
            VectorAssembler(inputCols=["_content", "_d"], outputCol="text_view"),
            VectorAssembler(inputCols=["_place", *numbers], outputCol="meta_view"),
        ]
    )
    return stages.transform(features).drop("_tf", "_place", "_d", "_content", *numbers)


def learning_table(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row of ``docs``, stored: its features, ``label`` or null, ``row`` (equal for what is learned once), unique ``_at``."""
    known = materialize(
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("_most"))
        .filter("label = _most")
        .drop("_most"),
        "labels",
    )
    named = docs.select("doc_id", *(F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")))
    features = with_features(named.withColumn("_text_hash", F.xxhash64("text", "lang", "source"))).drop("text")
    labelled = features.join(broadcast_if_small(known), "doc_id", "left")
    identity = F.xxhash64(F.when(F.col("label").isNotNull(), F.col("doc_id")), F.col("_text_hash"))
    keyed = labelled.withColumn("row", identity).withColumn("_at", F.monotonically_increasing_id())
    return materialize(keyed.drop("_text_hash"), "features")


def _drawn(rows: DataFrame, salt: str, rate: Column) -> DataFrame:
    """The share ``rate`` of ``rows``, the same ones in every run."""
    return rows.filter(F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(1 << 40)) < rate * float(1 << 40))


def _fetched(table: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` (few rows with ``_at``) with both views, in an order that does not depend on tasks."""
    found = as_views(table.drop("label", "row").join(broadcast_if_small(chosen), "_at"))
    return materialize(found.repartition(8, "row").sortWithinPartitions("row"), "learned")


def labelled_sample(table: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """About ``rows`` labelled texts (all if there are no more) with their views, ``label`` and ``held`` (for calibration)."""
    distinct = table.filter("label IS NOT NULL").groupBy("row").agg(F.min("_at").alias("_at"), F.min("label").alias("label"))
    distinct = materialize(distinct, "labelled")
    n = distinct.count()
    held = F.pmod(F.xxhash64("row", F.lit("held")), F.lit(HELD_OUT)) == 0
    chosen = _drawn(distinct, "label", F.lit(min(1.0, rows / max(n, 1)))).withColumn("held", held)
    return _fetched(table, materialize(chosen, "labelled-sample"))


def _scores(table: DataFrame, models: dict) -> DataFrame:
    """Both views' log odds of every unlabelled text, once per text: ``o_text`` and ``o_meta``."""
    scored = as_views(table.filter("label IS NULL"))
    for view in _VIEWS:
        scored = models[view].transform(scored)
    once = scored.groupBy("row").agg(
        *(F.min(c).alias(c) for c in ("_at", "lang", "source")), *(F.min(_odds(v)).alias(f"o_{v}") for v in _VIEWS)
    )
    return materialize(once, "unlabelled-scores")


def _bin(view: str) -> Column:
    odds = F.greatest(F.least(F.col(f"o_{view}"), F.lit(float(ODDS_RANGE))), F.lit(-float(ODDS_RANGE)))
    return F.floor(odds * ODDS_BINS)


def certain_labels(scores: DataFrame, view: str, share: float, positive: float) -> DataFrame:
    """The rows of ``scores`` of which ``view`` is most certain, with the ``label`` that it gives them.

    ``share`` of all rows, split by class as ``positive`` says, and what shares the bin of the last one of them.
    """
    counts = sorted(scores.groupBy(_bin(view).alias("bin")).count().collect())  # one row per bin, a fixed number
    total = sum(n for _, n in counts)

    def cut(bins: list, wanted: float) -> int | None:
        passed = 0
        for place, n in bins:
            passed += n
            if passed >= wanted:
                return place
        return None

    low, high = cut(counts, share * (1 - positive) * total), cut(counts[::-1], share * positive * total)
    if low is None or high is None:
        return scores.withColumn("label", F.lit(None).cast("int")).filter("false")
    good = (_bin(view) >= high) & (F.col(f"o_{view}") > 0)
    bad = (_bin(view) <= low) & (F.col(f"o_{view}") < 0)
    return scores.withColumn("label", F.when(good, 1).when(bad, 0)).filter("label IS NOT NULL")


def stratified_draw(certain: DataFrame, rows: int, positive: float, salt: str) -> DataFrame:
    """About ``rows`` of ``certain`` at most, its classes as ``positive`` says.

    Half of each class is drawn in proportion, half of it evenly over the languages and sources that have any.
    """
    strata = materialize(certain.groupBy("label", "lang", "source").agg(F.count(F.lit(1)).alias("_n")), "strata")
    per_class = Window.partitionBy("label")
    quota = F.when(F.col("label") == 1, rows * positive).otherwise(rows * (1 - positive))
    even = 0.5 / (F.count(F.lit(1)).over(per_class) * F.col("_n"))
    rate = quota * (0.5 / F.sum("_n").over(per_class) + even)
    rates = materialize(strata.select("label", "lang", "source", rate.alias("_rate")), "rates")
    drawn = _drawn(certain.join(broadcast_if_small(rates), ["label", "lang", "source"]), salt, F.col("_rate"))
    return drawn.select("row", "_at", "label")


def _fit(rows: DataFrame, view: str, label: str):
    return LogisticRegression(
        featuresCol=f"{view}_view", labelCol=label, regParam=REGULARISATION, maxIter=25, probabilityCol=f"_p_{view}",
        rawPredictionCol=f"_r_{view}", predictionCol=f"_c_{view}", family="binomial",
    ).fit(rows)


def _odds(view: str) -> Column:
    return vector_to_array(f"_r_{view}")[1]


def co_train(
    table: DataFrame, sample: DataFrame, rounds: int = ROUNDS, growth: float = GROWTH, taught_rows: int = TAUGHT_ROWS
) -> tuple[dict, dict, float]:
    """The two classifiers, their calibrations (slope, offset), and the prior log odds.

    From :func:`learning_table` and its :func:`labelled_sample`.
    """
    truth = sample.agg(F.avg("label").alias("share"), F.sum(F.col("held").cast("int")).alias("held")).first()
    positive = truth["share"]
    own = sample.filter("NOT held").select("row", *(f"{v}_view" for v in _VIEWS), *(F.col("label").alias(f"for_{v}") for v in _VIEWS))
    learned, models = own, {}
    for turn in range(rounds + 1):
        models = {v: _fit(learned.filter(F.col(f"for_{v}").isNotNull()), v, f"for_{v}") for v in _VIEWS}
        if turn == rounds:
            break
        scores = _scores(table, models)
        lessons = []
        for view, other in (_VIEWS, _VIEWS[::-1]):
            certain = certain_labels(scores, view, growth * (turn + 1), positive)
            drawn = stratified_draw(certain, taught_rows, positive, f"{view}{turn}")
            lessons.append(drawn.withColumnRenamed("label", f"for_{other}"))
        both = lessons[0].unionByName(lessons[1], allowMissingColumns=True).groupBy("row", "_at")
        taught = both.agg(*(F.max(f"for_{v}").alias(f"for_{v}") for v in _VIEWS))
        learned = own.unionByName(_fetched(table, materialize(taught, "lessons")).select(*own.columns))
    held = sample.filter("held") if truth["held"] else sample
    calibrations = {}
    for view in _VIEWS:
        odds = models[view].transform(held).select("label", _odds(view).alias("_o"))
        vector = VectorAssembler(inputCols=["_o"], outputCol="_v").transform(odds)
        platt = LogisticRegression(featuresCol="_v", labelCol="label", maxIter=25, regParam=1e-2).fit(vector)
        calibrations[view] = (max(0.0, float(platt.coefficients[0])), float(platt.intercept))
    prior = min(max(positive, 1e-6), 1 - 1e-6)
    return models, calibrations, prior


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    labelled_rows: int = LABELLED_ROWS,
    taught_rows: int = TAUGHT_ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``p_text``, ``p_meta``, ``quality`` (a probability) and ``kept`` (at least a half)."""
    table = learning_table(docs, labels)
    sample = labelled_sample(table, labelled_rows)
    classes = [r[0] for r in sample.select("label").distinct().limit(2).collect()]
    if len(classes) < 2:
        value = F.lit(float(classes[0]) if classes else None).cast("double")
        constant = docs.select("doc_id", value.alias("p_text"), value.alias("p_meta"), value.alias("quality"))
        return constant.withColumn("kept", F.coalesce(F.col("quality") >= 0.5, F.lit(True)))
    models, calibrations, prior = co_train(table, sample, rounds, taught_rows=taught_rows)
    scored = as_views(table).select("doc_id", "text_view", "meta_view")
    for view in _VIEWS:
        scored = models[view].transform(scored)
    odds = scored.select(
        "doc_id", *((_odds(v) * calibrations[v][0] + calibrations[v][1]).alias(f"_o_{v}") for v in _VIEWS)
    )
    prior_odds = F.log(F.lit(prior / (1 - prior)))
    probability = lambda o: 1 / (1 + F.exp(-o))
    return odds.select(
        "doc_id",
        probability(F.col("_o_text")).alias("p_text"),
        probability(F.col("_o_meta")).alias("p_meta"),
        probability(F.col("_o_text") + F.col("_o_meta") - prior_odds).alias("quality"),
    ).withColumn("kept", F.col("quality") >= 0.5)


def exchange_lift(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, folds: int = 5) -> DataFrame:
    """What the exchange of labels adds: one row for ``rounds`` of 0 (labels alone) and one for ``rounds``.

    ``n``, ``accuracy`` and ``log_loss`` on the labels of a ``folds``-th of the ids, which neither the fit nor the
    calibration sees.
    """
    unseen = F.pmod(F.xxhash64("doc_id", F.lit("unseen")), F.lit(folds)) == 0
    usable = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", "quality")
    truth = usable.filter(unseen).groupBy("doc_id").agg(F.min("quality").alias("_y"), F.max("quality").alias("_z"))
    p = F.greatest(F.least("quality", F.lit(1 - 1e-9)), F.lit(1e-9))
    reports = []
    for n in (0, rounds):
        scored = score_quality(docs, usable.filter(~unseen), rounds=n).join(truth.filter("_y = _z"), "doc_id")
        reports.append(
            scored.agg(
                F.lit(n).alias("rounds"),
                F.count(F.lit(1)).alias("n"),
                F.avg((F.col("kept") == (F.col("_y") == 1)).cast("double")).alias("accuracy"),
                F.avg(-F.when(F.col("_y") == 1, F.log(p)).otherwise(F.log(1 - p))).alias("log_loss"),
            )
        )
    return reports[0].unionByName(reports[1])
