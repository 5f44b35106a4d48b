"""Cross-validation, tuning, selection and ensembles.

Fits are submitted from a small thread pool, as Spark's own cross-validator does. Every
(config, fold, execution) is reduced to its K x K confusion counts by Spark; only those counts
reach the driver, and all metrics are computed from them in one small aggregation.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import replace
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabloom.functions.blocks import over_blocks, packed, summed
from tabloom.functions.expressions import argmax_index, derived_seed, uniform_hash
from tabloom.models.adam import TEST, TRAIN, VALIDATION, Network, confusion_together, network_blocks, train_together
from tabloom.models.grown import GrownModel, grow_together, grown_trees, scorer
from tabloom.models.margins import KERNEL_DEFAULTS
from tabloom.models.registry import MODEL_NAMES, Columns, get_model
from tabloom.operators.metrics import METRICS, averaged_metrics, confusion_matrix, fold_summary, log_loss
from tabloom.operators.splits import holdout
from tabloom.session import cut_lineage, dealt, driver_table, keep

COUNTS = "family string, config_index int, config string, fold int, execution int, label string, prediction string, n bigint"

PLAN_MODELS = 25  # fitted models applied within one plan
UNSEEN = "(unseen)"

# Tuned settings and their five grid points.
TUNING_GRIDS = {
    "SVC": ("cost", tuple(10 ** (-1 + i / 2) for i in range(5))),
    "DecisionTreeClassifier": ("max_depth", (2, 4, 6, 8, 10)),
}


def config_text(settings: Mapping) -> str:
    return json.dumps(dict(settings), sort_keys=True)


def run_parallel(tasks: Iterable[Callable], parallelism: int, spark: SparkSession) -> list:
    """Run driver-side fits from a few threads; Spark schedules their jobs."""
    tasks = [inheritable_thread_target(spark)(t) for t in tasks]
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    pool = ThreadPool(min(parallelism, len(tasks)))
    try:
        return pool.map(lambda t: t(), tasks, chunksize=1)
    finally:
        pool.close()
        pool.join()


def class_name(index: Column, classes: Sequence[str]) -> Column:
    return F.get(F.array(*[F.lit(c) for c in classes]), index.cast("int"))


def with_class_index(df: DataFrame, label: str, classes: Sequence[str], output: str) -> DataFrame:
    """Position of the label in the sorted class list, as a double; unknown labels give null."""
    names = F.array(*[F.lit(c) for c in classes])
    place = F.array_position(names, F.col(label).cast("string"))
    return df.withColumn(output, F.when(place > 0, (place - 1).cast("double")))


def collected_counts(df: DataFrame, label: str, classes: Sequence[str]) -> list[tuple]:
    """Confusion counts of one scored frame as driver rows; at most (K + 1) x K of them.

    A label that training did not know is a class of its own, ``UNSEEN``, which is never predicted.
    """
    counts = df.groupBy(F.col(label).cast("int").alias("y"), F.col("prediction").cast("int").alias("p")).count()
    names = dict(enumerate(classes))
    return [(names.get(r["y"], UNSEEN), names.get(r["p"]), r["count"]) for r in counts.collect()]


def fold_counts(
    df: DataFrame,
    configs: Sequence[tuple[str, Mapping]],
    columns: Columns,
    classes: Sequence[str],
    fold: str = "fold",
    parallelism: int = 2,
    make: Callable[[str, Mapping, Columns], Estimator] = get_model,
) -> DataFrame:
    """Confusion counts per config, fold and execution.

    ``configs`` are (family, settings). A network runs ``executions`` times per fold with its
    own seeds, and its validation share is rescaled from the table to the training part. Networks with a
    learning rate are trained together, in the same scans, however many settings, folds and executions there are, and so
    are decision trees and linear support vector machines.
    """
    needed = [columns.key, columns.features, columns.label, fold]
    data = df if df.is_cached else df.select(*dict.fromkeys(needed))
    sizes = {r[fold]: r["count"] for r in data.groupBy(fold).count().collect()}
    total = sum(sizes.values())
    width = data.select(columns.features).first()[0].size
    if not df.is_cached:
        data = keep(dealt(data, total, width))

    def one(index: int, family: str, settings: Mapping, k: int, execution: int) -> Callable[[], list[tuple]]:
        def task():
            own = dict(settings)
            ratio = own.get("validation_ratio", 0)
            if ratio:
                own["validation_ratio"] = total * ratio / (total - sizes[k])
            model = make(family, own, replace(columns, seed=columns.seed + execution)).fit(data.where(F.col(fold) != k))
            counts = collected_counts(model.transform(data.where(F.col(fold) == k)), columns.label, classes)
            if hasattr(model, "unpersist"):
                model.unpersist()
            return [(family, index, config_text(settings), k, execution, *c) for c in counts]

        return task

    runs = [
        (index, family, settings, k, execution)
        for index, (family, settings) in enumerate(configs)
        for k in sorted(sizes)
        for execution in range(settings.get("executions", 1) if MODEL_NAMES.get(family) == "ANN" else 1)
    ]
    networks = [r for r in runs if make is get_model and MODEL_NAMES.get(r[1]) == "ANN" and r[2].get("learning_rate") is not None]
    trees = [r for r in runs if make is get_model and MODEL_NAMES.get(r[1]) == "DecisionTreeClassifier"]
    linear = [r for r in runs if make is get_model and MODEL_NAMES.get(r[1]) == "SVC" and r[2].get("kernel") == "linear" and not r[2].get("exact")]
    tasks = [one(*r) for r in runs if r not in networks and r not in trees and r not in linear]
    rows = [r for part in run_parallel(tasks, parallelism, df.sparkSession) for r in part]
    if networks:
        rows += network_counts(data, networks, columns, classes, fold, sizes)
    if trees:
        rows += tree_counts(data, trees, columns, classes, fold, total * width)
    if linear:
        rows += linear_counts(data, linear, columns, classes, fold)
    if not df.is_cached:
        data.unpersist()
    return driver_table(df.sparkSession, rows, COUNTS)


def network_counts(
    data: DataFrame, runs: Sequence[tuple], columns: Columns, classes: Sequence[str], fold: str, sizes: Mapping[int, int]
) -> list[tuple]:
    """Confusion counts of Adam networks, all trained in the same scans; ``runs`` are (index, family, settings, fold, execution).

    Validation rows are drawn by a hash of the key, so their share is met up to chance.
    """
    total, width = sum(sizes.values()), data.select(columns.features).first()[0].size
    roles, networks = [], []
    for place, (_, _, settings, k, execution) in enumerate(runs):
        seed = columns.seed + execution
        share = total * settings.get("validation_ratio", 0.0) / max(total - sizes[k], 1)
        drawn = uniform_hash(derived_seed(seed, "validation"), columns.key) < F.lit(share)
        roles.append(F.when(F.col(fold) == k, F.lit(TEST)).when(drawn, F.lit(VALIDATION)).otherwise(F.lit(TRAIN)))
        networks.append(
            Network(
                width, settings.get("topology", (4, 3)), max(columns.classes, 2), settings["learning_rate"], settings.get("max_epochs", 1000),
                settings.get("min_loss", 0.0), settings.get("patience", 20), seed, place,
            )
        )
    blocks = network_blocks(data, columns.features, columns.label, F.array(*roles), networks)
    train_together(blocks, networks)
    counts = confusion_together(blocks, networks)
    blocks.unpersist()
    return _count_rows(runs, counts, classes)


def _count_rows(runs: Sequence[tuple], counts: np.ndarray, classes: Sequence[str]) -> list[tuple]:
    """Rows of COUNTS from (run, true class, predicted class); unknown true classes come last."""
    names = [*classes, UNSEEN]
    return [
        (family, index, config_text(settings), k, execution, names[int(true)], classes[int(found)], int(counts[place, true, found]))
        for place, (index, family, settings, k, execution) in enumerate(runs)
        for true, found in np.argwhere(counts[place] > 0)
    ]


def linear_counts(data: DataFrame, runs: Sequence[tuple], columns: Columns, classes: Sequence[str], fold: str) -> list[tuple]:
    """Confusion counts of linear support vector machines of all folds and costs, fitted in the same passes; ``runs`` as for networks."""
    rows, shapes = [], {}
    for r in runs:
        # settings that are not the cost must agree
        shapes.setdefault(config_text({k: v for k, v in r[2].items() if k != "cost"}), []).append(r)
    for alike in shapes.values():
        machine = get_model("SVC", alike[0][2], columns)
        parts, costs = [F.col(fold) != r[3] for r in alike], [r[2].get("cost", KERNEL_DEFAULTS["cost"]) for r in alike]
        for (index, family, settings, k, execution), model in zip(alike, machine.fit_parts(data, parts, costs)):
            counts = collected_counts(model.transform(data.where(F.col(fold) == k)), columns.label, classes)
            rows += [(family, index, config_text(settings), k, execution, *c) for c in counts]
    return rows


def tree_counts(data: DataFrame, runs: Sequence[tuple], columns: Columns, classes: Sequence[str], fold: str, numbers: int) -> list[tuple]:
    """Confusion counts of decision trees grown together; ``runs`` as for networks, ``numbers`` of the whole table.

    A tree cut off at a depth is the tree of that depth, so each smallest leaf needs one tree a fold.
    """
    k = max(columns.classes, 2)
    folds = sorted({r[3] for r in runs})
    blocks = keep(packed(dealt(data, numbers, 1), columns.features, columns.label, F.array(*[(F.col(fold) != v).cast("tinyint") for v in folds])))
    plans = []
    for least in sorted({r[2].get("min_samples_leaf", 1) for r in runs}):
        depths = [r[2].get("max_depth", 5) for r in runs if r[2].get("min_samples_leaf", 1) == least]
        grown = grow_together(blocks, data, columns.features, len(folds), k, -1 if min(depths) < 0 else max(depths), least)
        for place, (_, _, settings, v, _) in enumerate(runs):
            if settings.get("min_samples_leaf", 1) == least:
                plans.append((place, folds.index(v), scorer([grown[folds.index(v)]], settings.get("max_depth", 5))))

    def add(total, x, y, r):
        true = np.where(np.isnan(y), k, y).astype("int64")
        for place, role, score in plans:
            here = r[:, role] == 0
            at = (place * (k + 1) + true[here]) * k + score(x[here]).argmax(axis=1)
            total += np.bincount(at, minlength=len(total))

    counts = summed(blocks, over_blocks(add), len(runs) * (k + 1) * k).reshape(len(runs), k + 1, k)
    blocks.unpersist()
    return _count_rows(runs, counts, classes)


CONFIG = ["family", "config_index", "config"]


def cross_validation_report(counts: DataFrame, classes: Sequence[str], weighted: bool = True, positive: str | None = None) -> DataFrame:
    """Mean and deviation of the seven metrics over folds, and the confusion matrix.

    Executions of a fold are averaged first. Matrices are averaged over executions and summed
    over folds.
    """
    each = averaged_metrics(counts, [*CONFIG, "fold", "execution"], weighted, positive)
    folds = each.groupBy(*CONFIG, "fold").agg(*[F.avg(m).alias(m) for m in METRICS])
    runs = counts.groupBy(*CONFIG).agg(F.count_distinct("execution").alias("_runs"))
    summed = counts.groupBy(*CONFIG, "label", "prediction").agg(F.sum("n").alias("n"))
    shared = summed.join(runs, CONFIG).withColumn("n", F.col("n") / F.col("_runs"))
    return fold_summary(folds, CONFIG).join(confusion_matrix(shared, classes, CONFIG), CONFIG)


def cross_validate(
    df: DataFrame,
    configs: Sequence[tuple[str, Mapping]],
    columns: Columns,
    classes: Sequence[str],
    fold: str = "fold",
    parallelism: int = 2,
    weighted: bool = True,
    positive: str | None = None,
) -> DataFrame:
    """One row per config: fold means and deviations of the metrics, and the summed matrix."""
    unknown = [f for f, _ in configs if f not in MODEL_NAMES]
    if unknown:
        raise ValueError(f"unknown model {unknown[0]}")
    counts = fold_counts(df, configs, columns, classes, fold, parallelism)
    return cross_validation_report(counts, classes, weighted, positive)


def best_configs(report: DataFrame, by: Sequence[str] = ("family",), select_by: str = "f1_mean", order: str = "config_index") -> DataFrame:
    """The best row per family; the earlier config wins a tie."""
    ranked = Window.partitionBy(*by).orderBy(F.desc(select_by), F.asc(order))
    return report.withColumn("_r", F.row_number().over(ranked)).where("_r = 1").drop("_r")


def stack_candidates(best: DataFrame, families: Sequence[str] = ("SVM", "DT", "KNN"), select_by: str = "f1_mean") -> DataFrame:
    """Families that may be stacked, best first."""
    return best.where(F.col("family").isin(list(families))).orderBy(F.desc(select_by), "family")


# --- tuning --------------------------------------------------------------------------------


def tune(
    df: DataFrame,
    name: str,
    settings: Mapping,
    columns: Columns,
    train_ratio: float = 0.7,
    parallelism: int = 2,
    grid: tuple[str, Sequence] | None = None,
) -> tuple[Model, DataFrame]:
    """Fit each grid point on a hold-out, keep the lowest log-loss and refit it on all rows.

    Models without a grid are fitted as they are. Margins need probabilities to be scored, so
    a support vector machine is tuned in its calibrated form.
    """
    kind = MODEL_NAMES[name]
    used = "SVCProbabilistic" if kind == "SVC" else name
    grid = grid or TUNING_GRIDS.get(kind)
    spark = df.sparkSession
    if grid is None:
        return get_model(used, settings, columns).fit(df), spark.createDataFrame([], "setting string, value double, log_loss double")
    setting, values = grid
    marked = holdout(df, columns.key, 1 - train_ratio, derived_seed(columns.seed, "tuning"), "_side")
    train, test = keep(marked.where("_side = 'train'")), keep(marked.where("_side = 'test'"))

    def one(value):
        def task():
            scored = get_model(used, {**settings, setting: value}, columns).fit(train).transform(test)
            return log_loss(scored.withColumn("_p", vector_to_array("probability")), columns.label, "_p").first()[0]

        return task

    losses = run_parallel([one(v) for v in values], parallelism, spark)
    train.unpersist()
    test.unpersist()
    best = min(range(len(values)), key=lambda i: losses[i])
    table = spark.createDataFrame(
        [(setting, float(v), float(loss)) for v, loss in zip(values, losses)], "setting string, value double, log_loss double"
    )
    return get_model(used, {**settings, setting: values[best]}, columns).fit(df), table


# --- bagging -------------------------------------------------------------------------------


class Bagging(Estimator):
    """Averaged class probabilities of one model fitted on many row samples.

    A row belongs to a bag by a hash of (seed, bag, key), so the bags can be rebuilt anywhere.
    ``sizes`` are candidate ensemble sizes: all are scored on a hold-out from one set of fits,
    since the first n models of a larger ensemble are the ensemble of size n.
    """

    def __init__(
        self, name: str, settings: Mapping, columns: Columns, bagging_fraction=0.5,
        sizes: Sequence[int] = tuple(range(10, 101, 10)), train_ratio=0.8, parallelism=2,
    ):
        super().__init__()
        self.name, self.settings, self.columns = name, dict(settings), columns
        self.bagging_fraction, self.sizes = bagging_fraction, sorted(sizes)
        self.train_ratio, self.parallelism = train_ratio, parallelism

    def _models(self, df: DataFrame, count: int) -> list[Model]:
        c = self.columns
        data = keep(df)

        def one(bag: int):
            inside = self._inside(bag)
            estimator = get_model(self.name, self.settings, replace(c, seed=c.seed + bag))
            return lambda: estimator.fit(data.where(inside))

        models = run_parallel([one(b) for b in range(count)], self.parallelism, df.sparkSession)
        data.unpersist()
        return models

    def _inside(self, bag: int) -> Column:
        return uniform_hash(derived_seed(self.columns.seed, f"bag {bag}"), self.columns.key) < F.lit(self.bagging_fraction)

    def _fit(self, df: DataFrame) -> Model:
        if MODEL_NAMES.get(self.name) == "DecisionTreeClassifier":
            return self._trees(df)
        return self._one_by_one(df)

    def _trees(self, df: DataFrame) -> GrownModel:
        """All bags of trees in one growth, all ensemble sizes in one scan of the hold-out."""
        c, k = self.columns, max(self.columns.classes, 2)
        shape = (k, self.settings.get("max_depth", 5), self.settings.get("min_samples_leaf", 1), c.features, c.label)
        size, losses = self.sizes[0], []
        if len(self.sizes) > 1:
            marked = holdout(df, c.key, 1 - self.train_ratio, derived_seed(c.seed, "bagging"), "_side")
            train, held = (marked.where(F.col("_side") == s).drop("_side") for s in ("train", "test"))
            scores = [scorer([t]) for t in grown_trees(train, [self._inside(b) for b in range(self.sizes[-1])], *shape)]
            sizes = self.sizes

            def add(total, x, y, r):
                known = ~np.isnan(y)
                x, true, sums = x[known], y[known].astype("int64"), 0.0
                total[-1] += len(true)
                for number, score in enumerate(scores, 1):
                    sums = sums + score(x)
                    if number in sizes:
                        p = np.clip(sums[np.arange(len(true)), true] / number, 1e-15, 1 - 1e-15)
                        total[sizes.index(number)] -= np.log(p).sum()

            sums = summed(packed(held, c.features, c.label, F.array(F.lit(1))), over_blocks(add), len(sizes) + 1)
            losses = [(n, float(v / max(sums[-1], 1))) for n, v in zip(sizes, sums)]
            size = min(losses, key=lambda t: (t[1], t[0]))[0]
        model = GrownModel(grown_trees(df, [self._inside(b) for b in range(size)], *shape), c.features)
        model.losses = losses
        return model

    def _one_by_one(self, df: DataFrame) -> BaggingModel:
        c, losses = self.columns, []
        size = self.sizes[0]
        if len(self.sizes) > 1:
            marked = holdout(df, c.key, 1 - self.train_ratio, derived_seed(c.seed, "bagging"), "_side")
            models = self._models(marked.where("_side = 'train'").drop("_side"), self.sizes[-1])
            held = keep(marked.where("_side = 'test'").drop("_side"))
            total = _summed(held.select(c.key, c.features, c.label), [], c, None)
            done = 0
            for n in self.sizes:
                # the sums so far are written out, so the plan never holds more than one step's models
                total = cut_lineage(_summed(total, models[done:n], c, "_p"))
                done = n
                mean = total.withColumn("_mean", F.transform("_p", lambda p: p / F.lit(float(n))))
                losses.append((n, log_loss(mean, c.label, "_mean").first()[0]))
            held.unpersist()
            release(models)
            size = min(losses, key=lambda t: (t[1], t[0]))[0]
        return BaggingModel(self._models(df, size), c, losses)


def _summed(df: DataFrame, models: Sequence[Model], c: Columns, column: str | None) -> DataFrame:
    """Add the class probabilities of the models into an array column."""
    if column is None:
        return df.withColumn("_p", F.array(*[F.lit(0.0)] * c.classes))
    for m in models:
        scored = m.transform(df).withColumn("_p", F.zip_with("_p", vector_to_array("probability"), lambda a, b: a + b))
        df = scored.select(*df.columns)
    return df


class BaggingModel(Model):
    def __init__(self, models: Sequence[Model], columns: Columns, losses: Sequence[tuple]):
        super().__init__()
        self.models, self.columns, self.losses = list(models), columns, list(losses)

    def unpersist(self) -> None:
        release(self.models)

    def _transform(self, df: DataFrame) -> DataFrame:
        c, n = self.columns, float(len(self.models))
        summed = _summed(df, [], c, None)
        for start in range(0, len(self.models), PLAN_MODELS):
            if start:
                summed = cut_lineage(summed)
            summed = _summed(summed, self.models[start : start + PLAN_MODELS], c, "_p")
        mean = summed.withColumn("_p", F.transform("_p", lambda p: p / F.lit(n)))
        scored = mean.withColumn("probability", array_to_vector("_p"))
        return scored.withColumn("prediction", argmax_index("_p").cast("double")).drop("_p")


# --- stacking ------------------------------------------------------------------------------


class Stacking(Estimator):
    """Base models whose probabilities on held-out rows train a logistic model on top.

    The base models are then fitted again on all rows. Support vector machines enter in their
    calibrated form.
    """

    def __init__(self, bases: Sequence[tuple[str, Mapping]], columns: Columns, train_ratio=0.8, parallelism=2):
        super().__init__()
        if len(bases) < 2:
            raise ValueError("stacking needs at least two base models")
        self.columns, self.train_ratio, self.parallelism = columns, train_ratio, parallelism
        self.bases = [("SVCProbabilistic" if MODEL_NAMES[n] == "SVC" else n, dict(s)) for n, s in bases]

    def _fit(self, df: DataFrame) -> StackingModel:
        c, spark = self.columns, df.sparkSession
        marked = keep(holdout(df, c.key, 1 - self.train_ratio, derived_seed(c.seed, "stacking"), "_side"))
        held = marked.where(F.col("_side") == "test").drop("_side")
        parts = [F.col("_side") == "train", F.lit(True)]

        def fit(name, settings):
            """One model for the inner training rows and one for all; margins of both are fitted in the same passes."""
            estimator = get_model(name, settings, c)
            if hasattr(estimator, "fit_parts"):
                return estimator.fit_parts(marked, parts)
            return [estimator.fit(marked.where(p).drop("_side")) for p in parts]

        fitted = run_parallel([lambda n=n, s=s: fit(n, s) for n, s in self.bases], self.parallelism, spark)
        first, bases = (list(models) for models in zip(*fitted))
        level = _stacked_inputs(held, first, c)
        top = LogisticRegression(featuresCol="_stack", labelCol=c.label, family="auto").fit(level)
        release(first)
        marked.unpersist()
        return StackingModel(bases, top, c)


def _stacked_inputs(df: DataFrame, models: Sequence[Model], c: Columns) -> DataFrame:
    names = []
    for i, m in enumerate(models):
        name = f"_stack{i}"
        scored = m.transform(df).withColumnRenamed("probability", name)
        df = scored.select(*df.columns, name)
        names.append(name)
    return VectorAssembler(inputCols=names, outputCol="_stack").transform(df).drop(*names)


def release(models: Iterable[Model]) -> None:
    """Drop the tables that fitted models keep."""
    for m in models:
        if hasattr(m, "unpersist"):
            m.unpersist()


class StackingModel(Model):
    def __init__(self, bases: Sequence[Model], top: Model, columns: Columns):
        super().__init__()
        self.bases, self.top, self.columns = list(bases), top, columns

    def unpersist(self) -> None:
        release(self.bases)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.top.transform(_stacked_inputs(df, self.bases, self.columns)).drop("_stack", "rawPrediction")


def cross_validate_ensemble(
    df: DataFrame,
    name: str,
    make: Callable[[Columns], Estimator],
    columns: Columns,
    classes: Sequence[str],
    fold: str = "fold",
    settings: Mapping | None = None,
    weighted: bool = True,
    positive: str | None = None,
) -> DataFrame:
    """Fold means, deviations and the summed matrix of an ensemble."""
    counts = fold_counts(df, [(name, settings or {})], columns, classes, fold, 1, lambda _n, _s, c: make(c))
    return cross_validation_report(counts, classes, weighted, positive)
