"""Classifier evaluation from rows of (actual, predicted, class probabilities)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .quantiles import running_totals
from .serving import union_all

MAX_FACTOR = 100.0


def class_factors(df: DataFrame, label: str, cap: float = MAX_FACTOR) -> DataFrame:
    """Rows of each class and its sampling factor: largest class over this class, at most ``cap``."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("int").alias("class_label")).agg(
        F.count("*").alias("class_count")
    )
    largest = F.max("class_count").over(Window.partitionBy())
    factor = F.round(F.least(largest / F.col("class_count"), F.lit(float(cap))), 6)
    return counts.withColumn("factor", factor)


def label_set(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Distinct labels over both columns."""
    labels = df.select(F.col(actual).alias("class_label")).union(df.select(F.col(predicted).alias("class_label")))
    return labels.where("class_label is not null").distinct()


def pair_sums(df: DataFrame, actual: str, predicted: str, probabilities: dict[int, str] | None = None) -> DataFrame:
    """Rows per (actual, predicted), nulls included, and with probabilities the sum and number of their log losses.

    One aggregate that tasks merge before the shuffle; its size is that of the confusion matrix, and all metrics
    but the areas under curves come from it.
    """
    sums = [F.count("*").alias("n")]
    if probabilities:
        loss = _row_loss(actual, probabilities)
        sums += [F.sum(loss).alias("loss"), F.count(loss).alias("losses")]
    return df.groupBy(F.col(actual).cast("int").alias("a"), F.col(predicted).cast("int").alias("p")).agg(*sums)


def _known(sums: DataFrame) -> DataFrame:
    return sums.where("a is not null and p is not null")


def pair_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Rows per (actual, predicted), both known: everything below works on this small table."""
    return _known(pair_sums(df, actual, predicted))


def confusion(df: DataFrame, actual: str, predicted: str, labels: list[int]) -> DataFrame:
    """Confusion matrix: one row per actual label, one column per predicted label, over ``labels``."""
    counts = pair_counts(df, actual, predicted)
    cells = counts.groupBy(F.col("a").alias("actual")).agg(
        *[F.coalesce(F.sum(F.when(F.col("p") == c, F.col("n"))), F.lit(0)).alias(f"predicted_{c}") for c in labels]
    )
    rows = df.sparkSession.createDataFrame([(int(c),) for c in labels], "actual int")
    return rows.join(cells, "actual", "left").fillna(0)


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient as double; 0 where the bottom is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, specificity, F1 and support of each label that occurs on either side."""
    return _report(pair_counts(df, actual, predicted))


def _report(counts: DataFrame) -> DataFrame:
    sides = union_all(
        [
            counts.select(F.col("a").alias("class_label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                          F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(F.lit(0)).alias("tp")),
            counts.select(F.col("p").alias("class_label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                          F.lit(0).cast("bigint").alias("tp")),
        ]
    )
    sums = sides.groupBy("class_label").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    total = F.sum("support").over(Window.partitionBy())
    tp, support, said = F.col("tp"), F.col("support"), F.col("predicted")
    precision, recall = _ratio(tp, said), _ratio(tp, support)
    negatives = F.col("total") - support
    return sums.withColumn("total", total).select(
        "class_label", precision.alias("precision"), recall.alias("recall"),
        _ratio(negatives - (said - tp), negatives).alias("specificity"),
        _ratio(2 * precision * recall, precision + recall).alias("f1"), "support", "predicted", "tp",
    )


def scalar_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Accuracy, and macro and support-weighted precision, recall, F1 and specificity."""
    return _scalars(pair_counts(df, actual, predicted))


def _scalars(counts: DataFrame) -> DataFrame:
    report = _report(counts)
    weighted = lambda c: _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    names = {"precision": "precision", "recall": "recall", "f1": "f1", "specificity": "specificity"}
    return report.agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{n}") for n, c in names.items()],
        *[weighted(c).alias(f"weighted_{n}") for n, c in names.items()],
    )


def agreement_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Balanced accuracy, mean per-class error, Cohen's kappa, Matthews correlation.

    Balanced accuracy averages over labels that occur as actual; the per-class error over all labels.
    """
    return _agreement(pair_counts(df, actual, predicted))


def _agreement(counts: DataFrame) -> DataFrame:
    report = _report(counts)
    total, hits = F.sum("support").cast("double"), F.sum("tp").cast("double")
    cross = F.sum(F.col("support").cast("double") * F.col("predicted"))
    actual_sq = F.sum(F.col("support").cast("double") * F.col("support"))
    said_sq = F.sum(F.col("predicted").cast("double") * F.col("predicted"))
    sums = report.agg(
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        (1 - F.avg("recall")).alias("mean_per_class_error"),
        total.alias("n"), hits.alias("hits"), cross.alias("cross"), actual_sq.alias("a2"), said_sq.alias("p2"),
    )
    n, cross = F.col("n"), F.col("cross")
    expected = cross / (n * n)
    spread = F.sqrt(n * n - F.col("p2")) * F.sqrt(n * n - F.col("a2"))
    return sums.select(
        "balanced_accuracy", "mean_per_class_error",
        _ratio(F.col("hits") / n - expected, 1 - expected).alias("cohen_kappa"),
        _ratio(F.col("hits") * n - cross, spread).alias("matthews_corrcoef"),
    )


def ordinal_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Errors of labels read as numbers: MSE, RMSE, MAE, R2, RMSLE."""
    return _ordinals(pair_counts(df, actual, predicted))


def _ordinals(counts: DataFrame) -> DataFrame:
    a, p, n = F.col("a").cast("double"), F.col("p").cast("double"), F.col("n").cast("double")
    log_gap = F.log1p(a) - F.log1p(p)
    sums = counts.agg(
        F.sum(n).alias("n"), F.sum(n * (a - p) * (a - p)).alias("se"), F.sum(n * F.abs(a - p)).alias("ae"),
        F.sum(n * log_gap * log_gap).alias("le"), F.sum(n * a).alias("sa"), F.sum(n * a * a).alias("saa"),
    )
    rows = F.col("n")
    spread = F.col("saa") - F.col("sa") * F.col("sa") / rows
    return sums.select(
        (F.col("se") / rows).alias("mse"), F.sqrt(F.col("se") / rows).alias("rmse"), (F.col("ae") / rows).alias("mae"),
        F.when(spread > 0, 1 - F.col("se") / spread).alias("r2"), F.sqrt(F.col("le") / rows).alias("rmsle"),
    )


def _row_loss(actual: str, probabilities: dict[int, str]) -> Column:
    """-log of the true class's share of a row's probabilities, kept away from 0 and 1; null where it is unknown."""
    chosen = None
    for label, column in probabilities.items():
        hit = F.col(actual) == label
        chosen = F.when(hit, F.col(column)) if chosen is None else chosen.when(hit, F.col(column))
    share = chosen / sum((F.col(c) for c in probabilities.values()), F.lit(0.0))
    epsilon = 2.220446049250313e-16
    bounded = F.greatest(F.lit(epsilon), F.least(F.lit(1 - epsilon), share))
    return -F.log(bounded)


def log_loss(df: DataFrame, actual: str, probabilities: dict[int, str]) -> DataFrame:
    """Mean log loss of the rows."""
    return df.agg(F.avg(_row_loss(actual, probabilities)).alias("logloss"))


def class_auc(df: DataFrame, actual: str, probabilities: dict[int, str]) -> DataFrame:
    """One-vs-rest AUC and support of each class; null for a class without both kinds of rows.

    AUC is the chance that a positive scores above a negative, ties counting half. Negatives below
    each distinct score come from running totals, so no task sorts a whole class.
    """
    arms = ", ".join(f"{label}, `{column}`" for label, column in probabilities.items())
    long = df.where(F.col(actual).isNotNull()).select(
        F.col(actual).cast("int").alias("_actual"), F.expr(f"stack({len(probabilities)}, {arms}) as (class_label, _score)")
    ).where("_score is not null and not isnan(_score)")
    positive = F.col("_actual") == F.col("class_label")
    measures = {"pos": F.count_if(positive), "neg": F.count_if(~positive)}
    ranked = running_totals(long, ["class_label"], "_score", measures)
    wins = F.sum(F.col("pos").cast("double") * (F.col("before_neg") + F.col("neg") / 2))
    sums = ranked.groupBy("class_label").agg(wins.alias("wins"), F.sum("pos").alias("support"), F.sum("neg").alias("rest"))
    auc = F.try_divide(F.col("wins"), F.col("support").cast("double") * F.col("rest"))
    return sums.select("class_label", auc.alias("auc"), "support")


def proba_metrics(df: DataFrame, actual: str, probabilities: dict[int, str]) -> DataFrame:
    """Log loss, macro and support-weighted one-vs-rest AUC, and Gini of both.

    As in common practice the AUC figures are null unless every class has an AUC.
    """
    return _chances(class_auc(df, actual, probabilities), log_loss(df, actual, probabilities))


def _chances(aucs: DataFrame, loss: DataFrame) -> DataFrame:
    complete = F.count("*") == F.count("auc")
    macro = F.when(complete, F.avg("auc"))
    weighted = F.when(complete, F.sum(F.col("auc") * F.col("support")) / F.sum("support"))
    figures = aucs.agg(macro.alias("auc_macro_ovr"), weighted.alias("auc_weighted_ovr"))
    return figures.select(
        loss.scalar().alias("logloss"), "auc_macro_ovr", "auc_weighted_ovr",
        (2 * F.col("auc_macro_ovr") - 1).alias("gini_macro_ovr"),
        (2 * F.col("auc_weighted_ovr") - 1).alias("gini_weighted_ovr"),
    )


def full_metrics(df: DataFrame, actual: str, predicted: str, probabilities: dict[int, str] | None = None) -> DataFrame:
    """All metric groups side by side, one row.

    Two passes at most: one aggregate of pairs, written once, that all but the areas under curves are read from,
    and the score counts of the classes.
    """
    with staged(pair_sums(df, actual, predicted, probabilities), "pairs") as sums:
        counts = _known(sums)
        parts = [make(counts) for make in (_scalars, _agreement, _ordinals)]
        if probabilities:
            loss = sums.agg((F.sum("loss") / F.sum("losses")).alias("logloss"))
            parts.append(_chances(class_auc(df, actual, probabilities), loss))
        first, *others = parts
        single = first.withColumn("_one", F.lit(1))
        for part in others:
            single = single.join(part.withColumn("_one", F.lit(1)), "_one")
        row = single.drop("_one")
        return df.sparkSession.createDataFrame(row.collect(), row.schema)  # one row


STATUS_ORDER = {"ok": 0, "skipped": 1, "failed": 2}


def _status_rank() -> Column:
    rank = F.lit(len(STATUS_ORDER))
    for status, position in STATUS_ORDER.items():
        rank = F.when(F.col("status") == status, F.lit(position)).otherwise(rank)
    return rank


def compare_models(df: DataFrame) -> DataFrame:
    """Model table by status (ok, skipped, failed), then macro F1; one row per model run, so it is small."""
    return df.orderBy(_status_rank(), F.col("macro_f1").desc_nulls_last(), F.col("model"))


def compare_with_reference(models: DataFrame, reference: DataFrame) -> DataFrame:
    """The best finished model next to a reference model; columns that one of them lacks are null."""
    finished = models.where((F.col("status") == "ok") & F.col("macro_f1").isNotNull())
    best = finished.orderBy(F.col("macro_f1").desc(), F.col("model")).limit(1)
    return best.unionByName(reference, allowMissingColumns=True)


def leaderboard(df: DataFrame, limit: int = 10) -> DataFrame:
    """Best models first: macro F1 high, then log loss low."""
    order = [F.col("macro_f1").desc_nulls_last(), F.col("logloss").asc_nulls_last(), F.col("model")]
    return df.orderBy(*order).limit(limit)


# Run history --------------------------------------------------------------------------------------


def recent_runs(df: DataFrame, limit: int = 10) -> DataFrame:
    """The latest training runs."""
    return df.orderBy(F.col("start_time").desc(), F.col("run_id")).limit(limit)


def metric_trend(df: DataFrame, limit: int = 20) -> DataFrame:
    """The latest runs, oldest first, with NaN metrics as null."""
    metrics = [c for c, t in df.dtypes if t == "double"]
    clean = df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in metrics})
    return recent_runs(clean, limit).orderBy("start_time", F.col("run_id").desc())


def best_run(df: DataFrame, limit: int = 30) -> DataFrame:
    """The best of the latest runs by weighted F1; a missing value counts as -1, ties go to the later run."""
    value = F.coalesce(F.when(~F.isnan("weighted_f1"), F.col("weighted_f1")), F.lit(-1.0))
    best = recent_runs(df, limit).orderBy(value.desc(), F.col("start_time").desc(), F.col("run_id")).limit(1)
    return best.withColumn("selection_metric", F.lit("weighted_f1"))
