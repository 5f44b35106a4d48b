"""Model names and settings to estimators."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import DecisionTreeRegressor

from tabloom.models.adaboost import AdaBoost
from tabloom.models.boosting import SymmetricBoosting
from tabloom.models.grown import GrownTree
from tabloom.models.kernel_dual import ExactKernelMachine
from tabloom.models.margins import KERNEL_DEFAULTS, CalibratedMargins, SupportVectorMachine
from tabloom.models.neighbours import NearestNeighbours
from tabloom.models.network import NeuralNetwork

MAX_TREE_DEPTH = 30  # Spark's own limit; -1 (no limit) maps to it

# The names under which a model can be asked for.
MODEL_NAMES = {
    "ANN": "ANN",
    "SVM": "SVC",
    "SVC": "SVC",
    "SVCProbabilistic": "SVCProbabilistic",
    "DT": "DecisionTreeClassifier",
    "DecisionTreeClassifier": "DecisionTreeClassifier",
    "DecisionTreeRegressor": "DecisionTreeRegressor",
    "KNN": "KNeighborsClassifier",
    "KNeighborsClassifier": "KNeighborsClassifier",
    "RF": "RandomForestClassifier",
    "RandomForestClassifier": "RandomForestClassifier",
    "AdaBoost": "AdaBoostClassifier",
    "AdaBoostClassifier": "AdaBoostClassifier",
    "CatBoost": "CatBoostClassifier",
    "CatBoostClassifier": "CatBoostClassifier",
    "LogisticClassifier": "LogisticClassifier",
    "LinearRegressor": "LogisticClassifier",
}


@dataclass(frozen=True)
class Columns:
    """The columns models work on, the number of classes and the seed."""

    classes: int
    key: str = "id"
    features: str = "features"
    label: str = "label"
    seed: int = 0


def tree_depth(depth: int) -> int:
    """Spark's trees end at 30 levels; no limit means that many, and more cannot be had."""
    if depth > MAX_TREE_DEPTH:
        raise ValueError(f"trees have at most {MAX_TREE_DEPTH} levels, not {depth}")
    if depth < 0:
        warnings.warn(f"unlimited depth stands for {MAX_TREE_DEPTH} levels", stacklevel=3)
        return MAX_TREE_DEPTH
    return depth


def get_model(name: str, settings: Mapping | None = None, columns: Columns | None = None) -> Estimator:
    """The estimator for a model name; its fitted model adds ``prediction`` (class index)."""
    if name not in MODEL_NAMES:
        raise ValueError(f"unknown model {name}")
    kind, s = MODEL_NAMES[name], dict(settings or {})
    c = columns or Columns(classes=2)
    io = {"featuresCol": c.features, "labelCol": c.label}
    own = {"features": c.features, "label": c.label, "seed": c.seed}
    if kind in ("SVC", "SVCProbabilistic"):
        chosen = {k: s.get(k, v) for k, v in KERNEL_DEFAULTS.items()}
        if s.get("exact"):
            limits = {k: s[k] for k in ("max_iter", "tol", "working") if k in s}
            svm = ExactKernelMachine(c.classes, features=c.features, label=c.label, **chosen, **limits)
            return svm if kind == "SVC" else CalibratedMargins(svm, c.key, c.label, seed=c.seed)
        svm = SupportVectorMachine(c.classes, components=s.get("components", 200), max_iter=s.get("max_iter", 200), tol=s.get("tol", 1e-3), **chosen, **own)
        return svm if kind == "SVC" else CalibratedMargins(svm, c.key, c.label, seed=c.seed)
    if kind == "DecisionTreeClassifier":
        return GrownTree(c.classes, s.get("max_depth", 5), s.get("min_samples_leaf", 1), c.features, c.label)
    if kind == "DecisionTreeRegressor":
        return DecisionTreeRegressor(**io, maxDepth=tree_depth(s.get("max_depth", 5)), seed=c.seed)
    if kind == "KNeighborsClassifier":
        chosen = {k: s[k] for k in ("exact", "max_train_rows", "pivots") if k in s}
        return NearestNeighbours(c.classes, s.get("n_neighbors", 3), c.key, **chosen, **own)
    if kind == "RandomForestClassifier":
        return RandomForestClassifier(
            **io, numTrees=s.get("n_trees", 100), maxDepth=tree_depth(s.get("max_depth", -1)), seed=c.seed, maxMemoryInMB=1024
        )
    if kind == "AdaBoostClassifier":
        return AdaBoost(c.classes, s.get("n_estimators", 50), s.get("learning_rate", 1.0), **own)
    if kind == "CatBoostClassifier":
        return SymmetricBoosting(c.classes, s.get("iterations", 100), s.get("learning_rate", 0.1), s.get("depth", 6), features=c.features, label=c.label)
    if kind == "LogisticClassifier":
        return LogisticRegression(**io, family="auto", regParam=s.get("reg_param", 0.0))
    return NeuralNetwork(
        c.classes,
        s.get("topology", (4, 3)),
        max_epochs=s.get("max_epochs", 1000),
        min_loss=s.get("min_loss", 0.0),
        learning_rate=s.get("learning_rate"),
        validation_ratio=s.get("validation_ratio", 0.0),
        patience=s.get("patience", 20),
        round_epochs=s.get("round_epochs", 10),
        key=c.key,
        **own,
    )
