"""Whole experiments: scale, reduce, cross-validate a grid, stack, evaluate on the test part."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import derived_seed
from tabloom.models.registry import MODEL_NAMES, Columns, get_model
from tabloom.operators.labels import quantile_label
from tabloom.operators.metrics import METRICS, averaged_metrics, confusion_matrix
from tabloom.operators.reduction import reduce_features
from tabloom.operators.scaling import MinMax, ZScore
from tabloom.operators.splits import holdout, stratified_kfold
from tabloom.plans.evaluation import (
    Stacking,
    best_configs,
    collected_counts,
    config_text,
    cross_validate,
    cross_validate_ensemble,
    stack_candidates,
    with_class_index,
)
from tabloom.session import dealt, keep

# The searched settings per model family.
ANN_CONFIGS = (
    {"topology": [128], "learning_rate": 0.001, "max_epochs": 300, "validation_ratio": 0.2, "patience": 20, "executions": 1},
    {"topology": [64], "learning_rate": 0.001, "max_epochs": 300, "validation_ratio": 0.2, "patience": 20, "executions": 1},
    {"topology": [128, 64], "learning_rate": 0.001, "max_epochs": 200, "validation_ratio": 0.2, "patience": 20, "executions": 1},
    {"topology": [64, 32], "learning_rate": 0.001, "max_epochs": 200, "validation_ratio": 0.2, "patience": 20, "executions": 1},
    {"topology": [10, 5], "learning_rate": 0.001, "max_epochs": 300, "validation_ratio": 0.2, "patience": 20, "executions": 1},
    {"topology": [32, 16], "learning_rate": 0.001, "max_epochs": 300, "validation_ratio": 0.2, "patience": 20, "executions": 1},
    {"topology": [32], "learning_rate": 0.001, "max_epochs": 300, "validation_ratio": 0.2, "patience": 20, "executions": 1},
    {"topology": [16], "learning_rate": 0.001, "max_epochs": 300, "validation_ratio": 0.2, "patience": 20, "executions": 1},
)
SVM_CONFIGS = (
    {"kernel": 'linear', "cost": 0.1},
    {"kernel": 'linear', "cost": 1.0},
    {"kernel": 'linear', "cost": 10.0},
    {"kernel": 'linear', "cost": 20.0},
    {"kernel": 'linear', "cost": 50.0},
    {"kernel": 'linear', "cost": 100.0},
    {"kernel": 'sigmoid', "cost": 1.0, "gamma": 0.01, "coef0": 0.0},
    {"kernel": 'sigmoid', "cost": 3.0, "gamma": 0.02, "coef0": 0.1},
)
TREE_CONFIGS = (
    {"max_depth": 25, "min_samples_leaf": 20},
    {"max_depth": 30, "min_samples_leaf": 20},
    {"max_depth": 7, "min_samples_leaf": 20},
    {"max_depth": 10, "min_samples_leaf": 20},
    {"max_depth": 15, "min_samples_leaf": 20},
    {"max_depth": 20, "min_samples_leaf": 20},
)
NEIGHBOUR_CONFIGS = (
    {"n_neighbors": 50},
    {"n_neighbors": 25},
    {"n_neighbors": 5},
    {"n_neighbors": 7},
    {"n_neighbors": 10},
    {"n_neighbors": 15},
)
FOREST_CONFIGS = (
    {"n_trees": 50, "max_depth": 5},
    {"n_trees": 100, "max_depth": 10},
    {"n_trees": 150, "max_depth": 15},
    {"n_trees": 100, "max_depth": -1},
)
ADABOOST_CONFIGS = (
    {"n_estimators": 25, "learning_rate": 0.5},
    {"n_estimators": 50, "learning_rate": 1.0},
    {"n_estimators": 100, "learning_rate": 1.0},
    {"n_estimators": 50, "learning_rate": 0.5},
)
BOOSTING_CONFIGS = (
    {"iterations": 20, "learning_rate": 0.1, "depth": 4},
    {"iterations": 40, "learning_rate": 0.1, "depth": 6},
    {"iterations": 60, "learning_rate": 0.05, "depth": 8},
)
GRIDS: dict[str, tuple[dict, ...]] = {
    "ANN": ANN_CONFIGS,
    "SVM": SVM_CONFIGS,
    "DT": TREE_CONFIGS,
    "KNN": NEIGHBOUR_CONFIGS,
    "RF": FOREST_CONFIGS,
    "AdaBoost": ADABOOST_CONFIGS,
    "CatBoost": BOOSTING_CONFIGS,
}


@dataclass(frozen=True)
class Approach:
    """One experiment: number of classes, scaling, reduction and folds."""

    name: str
    classes: int = 3
    normalize: str | None = "zero"  # zero (z-score), minmax or None
    reduction: str | None = None  # pca, lda or None
    reduction_settings: Mapping = field(default_factory=dict)
    folds: int = 3
    select_by: str = "f1_mean"
    positive: str | None = None


# The four named experiments.
APPROACHES = {
    "binary_reduced": Approach("Binary with Feature Reduction", classes=2),
    "binary_pca": Approach("Binary with PCA", classes=2, reduction="pca", reduction_settings={"variance_ratio": 0.7}),
    "lda": Approach("LDA", classes=3, reduction="lda", reduction_settings={"out_dim": 2}),
    "reduced": Approach("Feature Reduction", classes=3),
}


class Scaler(Transformer):
    """A fitted column scaler as a stage."""

    def __init__(self, scaler: ZScore | MinMax):
        super().__init__()
        self.scaler = scaler

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.scaler.transform(df)


@dataclass
class ApproachResult:
    """Result tables, best settings per family and the fitted preparation."""

    cross_validation: DataFrame
    best: DataFrame
    stack: DataFrame | None
    test: DataFrame
    preparation: PipelineModel
    best_settings: dict[str, dict]


def labelled_split(
    df: DataFrame, key: str, metric: str, test: float = 0.2, classes: int = 3, seed: int = 0, approx: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Hold out rows and label both parts by quantiles of the training part."""
    # kept once: the split and the quantiles scan it several times, and so do the fits
    marked = holdout(keep(df.where(F.col(metric).isNotNull())), key, test, seed)
    labelled = quantile_label(marked, metric, classes, marked.where("split = 'train'"), approx=approx)
    return labelled.where("split = 'train'").drop("split"), labelled.where("split = 'test'").drop("split")


def prepare(
    train: DataFrame, test: DataFrame, inputs: Sequence[str], label: str, approach: Approach
) -> tuple[DataFrame, DataFrame, PipelineModel]:
    """Scale and reduce with training parameters; both parts pass through the same stages."""
    stages: list[Transformer | Model] = []
    if approach.normalize is not None:
        kinds = {"zero": ZScore, "minmax": MinMax}
        if approach.normalize not in kinds:
            raise ValueError(f"unknown normalisation {approach.normalize}")
        stages.append(Scaler(kinds[approach.normalize].fit(train, inputs)))
    reduced = approach.reduction is not None
    stages.append(VectorAssembler(inputCols=list(inputs), outputCol="_inputs" if reduced else "features"))
    for stage in stages:
        train, test = stage.transform(train), stage.transform(test)
    if reduced:
        (train, test), model = reduce_features(
            train, [test], approach.reduction, "_inputs", label, "features", **approach.reduction_settings
        )
        stages.append(model)
    return train, test, PipelineModel(stages)


def run_approach(
    train: DataFrame,
    test: DataFrame,
    key: str,
    inputs: Sequence[str],
    label: str,
    approach: Approach,
    grids: Mapping[str, Sequence[Mapping]] = GRIDS,
    seed: int = 0,
    parallelism: int = 2,
) -> ApproachResult:
    """Search every family, stack the best, and evaluate the best of each family on the test part."""
    spark = train.sparkSession
    sizes = {r[0]: r[1] for r in train.groupBy(F.col(label).cast("string")).count().collect()}
    classes, rows = sorted(c for c in sizes if c is not None), sum(sizes.values())
    train, test, preparation = prepare(train, test, inputs, label, approach)
    columns = Columns(len(classes), key, "features", "_y", seed)

    def indexed(df: DataFrame) -> DataFrame:
        return with_class_index(df, label, classes, "_y").select(key, "features", label, "_y")

    base = keep(dealt(indexed(train), rows, len(inputs)))
    train = keep(stratified_kfold(base, key, label, approach.folds, derived_seed(seed, "folds")))
    test = keep(indexed(test))
    configs = [(family, dict(s)) for family, listed in grids.items() for s in listed]
    report = keep(
        cross_validate(train, configs, columns, classes, "fold", parallelism, positive=approach.positive)
    ).withColumn("approach", F.lit(approach.name))
    best = best_configs(report, select_by=approach.select_by)
    chosen = {r["family"]: configs[r["config_index"]][1] for r in best.select("family", "config_index").collect()}
    leaders = [r["family"] for r in stack_candidates(best, select_by=approach.select_by).collect()]
    stack = None
    if len(leaders) >= 2:
        bases = [(f, chosen[f]) for f in leaders]
        stack = cross_validate_ensemble(
            train, "Stack", lambda c: Stacking(bases, c, parallelism=parallelism), columns, classes,
            settings={"bases": dict(bases)}, positive=approach.positive,
        ).withColumn("approach", F.lit(approach.name))
    result = test_report(train.drop("fold"), test, chosen, columns, classes, approach)
    for cached in (base, train, test):
        cached.unpersist()
    return ApproachResult(report, best, stack, result, preparation, chosen)


def test_report(
    train: DataFrame, test: DataFrame, chosen: Mapping[str, Mapping], columns: Columns, classes: Sequence[str], approach: Approach
) -> DataFrame:
    """Refit each chosen model on all training rows and measure it on the test rows."""
    rows = []
    for family, settings in chosen.items():
        # the final network uses all training rows
        final = {k: v for k, v in settings.items() if k != "validation_ratio"}
        model = get_model(family, final, columns).fit(train)
        for y, p, n in collected_counts(model.transform(test), columns.label, classes):
            rows.append((approach.name, MODEL_NAMES[family], config_text(settings), y, p, n))
        if hasattr(model, "unpersist"):
            model.unpersist()
    schema = "approach string, model string, config string, label string, prediction string, n bigint"
    counts = train.sparkSession.createDataFrame(rows, schema)
    by = ["approach", "model", "config"]
    metrics = averaged_metrics(counts, by, positive=approach.positive)
    return metrics.join(confusion_matrix(counts, classes, by), by).select(*by, *METRICS, "cm")


def results_table(report: DataFrame) -> DataFrame:
    """Cross-validation rows in the layout of the results table."""
    means = [F.col(f"{m}_mean").alias(m) for m in METRICS]
    return report.select("approach", F.col("family").alias("model"), "config", *means, "cm")
