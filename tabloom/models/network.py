"""Feed-forward network with optional early stopping on a validation part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.expressions import derived_seed
from tabloom.models.adam import TEST, TRAIN, VALIDATION, AdamModel, Network, network_blocks, train_together
from tabloom.operators.metrics import log_loss
from tabloom.operators.splits import holdout
from tabloom.session import dealt, keep


class NeuralNetwork(Estimator):
    """Sigmoid hidden layers and a softmax output.

    Without validation rows the network trains for ``max_epochs`` iterations. With them it
    trains in warm-started rounds of ``round_epochs``, keeps the weights with the lowest
    validation loss and stops after ``patience`` epochs without improvement, or once the
    training loss reaches ``min_loss``. Losses per round stay in ``history``.

    A learning rate means full-batch Adam with steps of that size, an epoch a step: losses, patience and the
    smallest loss are looked at after every epoch. Without one the network trains by l-bfgs, which finds its own
    steps; there patience is counted in whole rounds, and a round starts from the weights of the one before but not
    from the solver's memory.
    """

    def __init__(
        self, classes, topology: Sequence[int] = (4, 3), max_epochs=1000, min_loss=0.0, learning_rate: float | None = None,
        validation_ratio=0.0, patience=20, round_epochs=10, solver: str | None = None, key: str | None = None,
        features="features", label="label", seed=0,
    ):
        super().__init__()
        self.classes, self.topology, self.max_epochs, self.min_loss = classes, list(topology), max_epochs, min_loss
        self.learning_rate, self.validation_ratio, self.patience = learning_rate, validation_ratio, patience
        self.round_epochs, self.key = round_epochs, key
        self.solver = solver or ("l-bfgs" if learning_rate is None else "adam")
        if self.solver not in ("l-bfgs", "adam"):
            raise ValueError(f"unknown solver {self.solver}")
        if learning_rate is not None and self.solver != "adam":
            raise ValueError("a learning rate has no effect on l-bfgs")
        self.features, self.label, self.seed = features, label, seed

    def _trainer(self, width: int, epochs: int) -> MultilayerPerceptronClassifier:
        return MultilayerPerceptronClassifier(
            featuresCol=self.features,
            labelCol=self.label,
            layers=[width, *self.topology, max(self.classes, 2)],
            maxIter=epochs,
            tol=1e-9,
            seed=self.seed,
            solver=self.solver,
        )

    def _adam(self, parts: dict[int, DataFrame]) -> AdamModel:
        """Train on the rows of each role."""
        rows = None
        for role, part in parts.items():
            part = part.select(self.features, self.label, F.lit(role).alias("_role"))
            rows = part if rows is None else rows.unionByName(part)
        width = rows.select(self.features).first()[0].size
        network = Network(
            width, self.topology, max(self.classes, 2), 0.01 if self.learning_rate is None else self.learning_rate,
            self.max_epochs, self.min_loss, self.patience, self.seed,
        )
        blocks = network_blocks(rows, self.features, self.label, F.array("_role"), [network])
        train_together(blocks, [network])
        blocks.unpersist()
        return AdamModel(network, self.features)

    def _fit(self, df: DataFrame) -> Model:
        if self.validation_ratio > 0:
            if self.key is None:
                raise ValueError("a validation part needs a key column to split on")
            marked = holdout(df, self.key, self.validation_ratio, derived_seed(self.seed, "validation"), "_side")
            return self.fit_with_validation(
                marked.where("_side = 'train'").drop("_side"), marked.where("_side = 'test'").drop("_side")
            )
        if self.solver == "adam":
            return self._adam({TRAIN: df})
        width = df.select(self.features).first()[0].size
        df = dealt(df.select(self.features, self.label), df.count(), width)
        fitted = self._trainer(width, self.max_epochs).fit(df)
        losses = [float(v) for v in fitted.summary().objectiveHistory]
        return NetworkModel(fitted, [(i, v, None, None) for i, v in enumerate(losses)])

    def fit_with_validation(self, train: DataFrame, validation: DataFrame, test: DataFrame | None = None) -> Model:
        if self.solver == "adam":
            return self._adam({TRAIN: train, VALIDATION: validation} | ({} if test is None else {TEST: test}))
        width = train.select(self.features).first()[0].size
        train, validation = (
            keep(dealt(part.select(self.features, self.label), part.count(), width)) for part in (train, validation)
        )
        best, best_loss, waited, epoch = None, float("inf"), 0, 0
        weights, history = None, []
        while epoch < self.max_epochs and waited < self.patience:
            trainer = self._trainer(width, min(self.round_epochs, self.max_epochs - epoch))
            if weights is not None:
                trainer = trainer.setInitialWeights(weights)
            fitted = trainer.fit(train)
            weights, epoch = fitted.weights, epoch + trainer.getMaxIter()
            losses = [self._loss(fitted, part) if part is not None else None for part in (train, validation, test)]
            history.append((epoch, *losses))
            if losses[1] < best_loss:
                best, best_loss, waited = fitted, losses[1], 0
            else:
                waited += trainer.getMaxIter()
            if losses[0] <= self.min_loss:
                break
        train.unpersist()
        validation.unpersist()
        return NetworkModel(best if best is not None else fitted, history)

    def _loss(self, fitted: Model, part: DataFrame) -> float:
        scored = fitted.transform(part).withColumn("_p", vector_to_array("probability"))
        return log_loss(scored, self.label, "_p").first()[0]


class NetworkModel(Model):
    def __init__(self, fitted: Model, history: list[tuple]):
        super().__init__()
        self.fitted, self.history = fitted, history

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.fitted.transform(df).drop("rawPrediction")

    def losses(self, df: DataFrame) -> DataFrame:
        """Loss curves: ``epoch, train_loss, validation_loss, test_loss``."""
        schema = "epoch int, train_loss double, validation_loss double, test_loss double"
        return df.sparkSession.createDataFrame(self.history, schema)

