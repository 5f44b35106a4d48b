"""Learnability on generated blobs, exactness of neighbours, invariants of reductions and ensembles."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabloom.models.adaboost import AdaBoost, AdaBoostModel, Stump
from tabloom.models.neighbours import NearestNeighbours
from tabloom.models.network import NeuralNetwork
from tabloom.models.registry import Columns, get_model, tree_depth
from tabloom.operators import reduction as D
from tabloom.operators.reduction import LinearDiscriminants
from tabloom.operators.splits import holdout, stratified_kfold
from tabloom.plans import approaches as A
from tabloom.plans import evaluation as V
from tabloom.plans import report as RP


def frame(spark, x, y, start=0):
    rows = [(start + i, [float(v) for v in a], float(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id bigint, x array<double>, label double")
    return df.select("id", array_to_vector("x").alias("features"), "label")


def blobs(classes, n=240, width=4, seed=0):
    rng = np.random.default_rng(seed)
    y = np.arange(n) % classes
    centres = rng.normal(0, 1, (classes, width))
    centres = 3 * centres / np.linalg.norm(centres, axis=1, keepdims=True) + np.eye(classes, width) * 3
    return centres[y] + rng.normal(0, 0.7, (n, width)), y


@pytest.fixture(scope="module")
def two(spark):
    return holdout(frame(spark, *blobs(2)), "id", 0.25, 1).cache()


@pytest.fixture(scope="module")
def three(spark):
    return holdout(frame(spark, *blobs(3)), "id", 0.25, 1).cache()


def parts(df):
    return df.where("split = 'train'").drop("split"), df.where("split = 'test'").drop("split")


def share(df):
    return df.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]


MODELS = [
    ("SVM", {"kernel": "linear", "cost": 1.0}),
    ("SVC", {"kernel": "rbf", "gamma": 0.1}),
    ("SVC", {"kernel": "poly", "gamma": 0.5, "coef0": 1.0}),
    ("SVCProbabilistic", {"kernel": "linear"}),
    ("DT", {"max_depth": 5}),
    ("KNN", {"n_neighbors": 5}),
    ("RF", {"n_trees": 10, "max_depth": 5}),
    ("AdaBoost", {"n_estimators": 12}),
    ("LinearRegressor", {}),
    ("ANN", {"topology": [8], "max_epochs": 60}),
    ("ANN", {"topology": [8], "max_epochs": 60, "validation_ratio": 0.2}),
]


@pytest.mark.parametrize("name,settings", MODELS)
def test_three_classes_are_learned(three, name, settings):
    train, test = parts(three)
    scored = get_model(name, settings, Columns(3)).fit(train).transform(test)
    assert scored.count() == 60 and share(scored) > 0.9
    if "probability" in scored.columns:
        p = scored.select(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x).alias("p"))
        assert p.where("abs(p - 1) > 1e-6").count() == 0


@pytest.mark.parametrize("name,settings", [("SVM", {"kernel": "linear"}), ("SVM", {"gamma": 0.05}), ("CatBoost", {"iterations": 5, "depth": 3})])
def test_two_classes_are_learned(two, name, settings):
    train, test = parts(two)
    assert share(get_model(name, settings, Columns(2)).fit(train).transform(test)) > 0.85


def test_boosting_of_three_classes(three):
    train, test = parts(three)
    assert share(get_model("CatBoost", {"iterations": 3, "depth": 3}, Columns(3)).fit(train).transform(test)) > 0.85


def test_registry_errors():
    with pytest.raises(ValueError, match="unknown model"):
        get_model("Nope")
    with pytest.raises(ValueError, match="kernel"):
        get_model("SVC", {"kernel": "laplace"})
    with pytest.raises(ValueError, match="99"):
        tree_depth(99)
    with pytest.warns(UserWarning, match="30"):
        assert tree_depth(-1) == 30


def test_svm_matches_the_exact_optimum(spark):
    """One feature, squared hinge: the fitted objective is no worse than a dense search finds."""
    rng = np.random.default_rng(3)
    y = np.arange(80) % 2
    x = rng.normal(0, 1, (80, 1)) + 1.2 * y[:, None]
    fitted = get_model("SVM", {"kernel": "linear", "cost": 0.5}, Columns(2)).fit(frame(spark, x, y)).fitted
    deviation = x.std(ddof=1)

    def objective(w, b):
        short = np.maximum(0, 1 - np.where(y == 1, 1, -1) * (x[:, 0] * w + b))
        return (w * deviation) ** 2 / (2 * 0.5 * 80) + (short**2).mean()

    grid = min(objective(w, b) for w in np.linspace(0, 2, 201) for b in np.linspace(-2, 2, 201))
    assert objective(fitted.weights[0, 0], fitted.intercepts[0]) <= grid * 1.002


def test_learning_rate_matters(three):
    train, _ = parts(three)
    slow, fast = (AdaBoost(3, 3, r, seed=1).fit(train) for r in (0.5, 1.0))
    assert slow.stumps[0].weight == pytest.approx(fast.stumps[0].weight / 2)


@pytest.mark.parametrize("exact,block,k", [(True, 5, 3), (True, 40, 7), (True, 20_000, 50), (False, 5, 3), (False, 5, 50)])
def test_neighbours_are_exact_under_skew(spark, exact, block, k):
    """A third of the training rows are copies of one point; blocks are far smaller than the group."""
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(0, 1, (150, 3)), 3)
    x[:50] = x[0]
    y = rng.integers(0, 3, 150)
    q = np.vstack([x[:2], rng.normal(0, 2, (30, 3)), np.full((20, 3), 0.25)])
    model = NearestNeighbours(3, k, exact=exact, block_rows=block, pivots=6).fit(frame(spark, x, y))
    queries = frame(spark, q, np.zeros(len(q)), 1000)
    got = {}
    for r in model.neighbours(queries).collect():
        got.setdefault(r["id"], []).append((r["rank"], round(r["distance"], 9), r["neighbour"]))
    for i, point in enumerate(q):
        d = np.round(np.sqrt(((x - point) ** 2).sum(axis=1)), 9)
        order = sorted(range(150), key=lambda j: (d[j], j))[:k]
        assert sorted(got[1000 + i]) == [(r + 1, pytest.approx(d[j]), j) for r, j in enumerate(order)]
    scored = model.transform(queries)
    assert scored.count() == len(q)
    model.unpersist()


def test_one_neighbour_recalls_the_training_rows(spark):
    x, y = blobs(3, 90)
    df = frame(spark, x, y)
    assert share(NearestNeighbours(3, 1).fit(df).transform(df)) == 1.0


def test_network_history(three):
    train, test = parts(three)
    inner, held = (d.drop("split") for d in parts(holdout(train.drop("split"), "id", 0.2, 9)))
    network = get_model("ANN", {"topology": [6], "max_epochs": 50, "patience": 20}, Columns(3))
    fitted = network.fit_with_validation(inner, held, test)
    rows = fitted.losses(train).orderBy("epoch").collect()
    assert [r["epoch"] for r in rows] == list(range(10, 10 * len(rows) + 1, 10))
    assert rows[-1]["train_loss"] < rows[0]["train_loss"] and rows[0]["test_loss"] is not None
    with pytest.raises(ValueError):
        get_model("ANN", {"validation_ratio": 0.2}, Columns(3, key=None)).fit(train)


def test_principal_components(three):
    train, test = parts(three)
    model = D.PrincipalComponents(variance_ratio=0.95).fit(train)
    scores = np.array([r[0].toArray() for r in model.transform(train).select("scores").collect()])
    assert np.cumsum(model.shares)[model.k - 1] >= 0.95 and (model.k == 1 or np.cumsum(model.shares)[model.k - 2] < 0.95)
    assert np.allclose(scores.mean(axis=0), 0, atol=1e-9)
    covariance = np.cov(scores.T)
    assert np.allclose(covariance - np.diag(np.diag(covariance)), 0, atol=1e-9)
    assert (np.diff(np.diag(covariance)) <= 1e-9).all()
    two = D.PrincipalComponents(k=2).fit(train)
    assert two.transform(test).first()["scores"].size == 2
    assert (two.components[np.abs(two.components).argmax(axis=0), range(2)] > 0).all()
    with pytest.raises(ValueError):
        D.PrincipalComponents()


def test_discriminants_separate_classes(three):
    train, test = parts(three)
    model = D.LinearDiscriminants(out_dim=5).fit(train)
    assert model.weights.shape[1] == 2 and (np.diff(model.ratios) <= 0).all()
    scored = model.transform(train).select("label", vector_to_array("scores").alias("s")).toPandas()
    s = np.array(scored["s"].tolist())
    within = sum(np.cov(s[scored["label"] == c].T, ddof=0) * (scored["label"] == c).sum() for c in range(3))
    assert np.allclose(within / (len(s) - 3), np.eye(2), atol=1e-4)
    assert D.points_by_class(model.transform(test), "scores", "label").columns == ["pc1", "pc2", "label"]


def test_kmeans_report(three):
    report = D.kmeans_report(three, "id", k=3, seed=1)
    assert sorted(r["n"] for r in report["sizes"].collect()) == [80, 80, 80]
    assert report["fit"].first()["converged"] and report["points"].count() == 240


def test_cross_validation(three):
    train, _ = parts(three)
    df = stratified_kfold(train, "id", "label", 3, 2)
    configs = [("DT", {"max_depth": 1}), ("DT", {"max_depth": 5}), ("ANN", {"topology": [4], "max_epochs": 20, "executions": 2})]
    report = V.cross_validate(df, configs, Columns(3), ["a", "b", "c"], parallelism=3).cache()
    rows = {r["config_index"]: r for r in report.collect()}
    assert len(rows) == 3 and rows[1]["accuracy_mean"] > rows[0]["accuracy_mean"]
    for r in rows.values():
        assert sum(map(sum, r["cm"])) == 180 and r["recall_mean"] == pytest.approx(r["accuracy_mean"])
    best = V.best_configs(report)
    assert {(r["family"], r["config_index"]) for r in best.collect()} == {("DT", 1), ("ANN", 2)}
    assert [r["family"] for r in V.stack_candidates(best).collect()] == ["DT"]
    with pytest.raises(ValueError):
        V.cross_validate(df, [("Nope", {})], Columns(3), ["a", "b", "c"])


def test_tuning(three):
    train, _ = parts(three)
    model, table = V.tune(train, "DT", {}, Columns(3), grid=("max_depth", (1, 4)))
    losses = {r["value"]: r["log_loss"] for r in table.collect()}
    assert max(model.trees[0].depth) <= min(losses, key=losses.get) and model.trees[0].feature[0] >= 0
    assert V.tune(train, "RF", {"n_trees": 3, "max_depth": 3}, Columns(3))[1].count() == 0


def test_bagging(three):
    train, test = parts(three)
    model = V.Bagging("DT", {"max_depth": 4}, Columns(3), sizes=(1, 5), parallelism=4).fit(train)
    assert share(model.transform(test)) > 0.85
    assert len(model.models) == min(model.losses, key=lambda t: (t[1], t[0]))[0]


def test_stacking(three):
    train, test = parts(three)
    bases = [("DT", {"max_depth": 4}), ("KNN", {"n_neighbors": 5}), ("SVM", {"kernel": "linear"})]
    assert share(V.Stacking(bases, Columns(3)).fit(train).transform(test)) > 0.9
    with pytest.raises(ValueError):
        V.Stacking(bases[:1], Columns(3))


@pytest.mark.parametrize("which", ["binary_pca", "lda"])
def test_whole_experiment(spark, which):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    metric = np.exp(2 * x[:, 0] + x[:, 1] + rng.normal(0, 0.2, 400))
    rows = [(i, *map(float, a), float(m)) for i, (a, m) in enumerate(zip(x, metric))]
    df = spark.createDataFrame(rows, "id bigint, a double, b double, c double, d double, listens double")
    approach = A.APPROACHES[which]
    train, test = A.labelled_split(df, "id", "listens", 0.2, approach.classes, 1)
    assert (train.count(), test.count()) == (320, 80)
    grids = {"DT": ({"max_depth": 2}, {"max_depth": 6}), "KNN": ({"n_neighbors": 9},)}
    result = A.run_approach(train, test, "id", list("abcd"), "label", approach, grids, 1, 4)
    rows = result.test.collect()
    assert {r["model"] for r in rows} == {"DecisionTreeClassifier", "KNeighborsClassifier"}
    for r in rows:
        assert sum(map(sum, r["cm"])) == 80
        assert r["accuracy"] > (0.7 if which == "lda" else 0.55)
    assert result.stack.count() == 1 and result.cross_validation.count() == 3
    assert "features" in result.preparation.transform(df).columns
    assert RP.grouped_comparison(result.test).count() == 4
    assert RP.trade_off(A.results_table(result.cross_validation)).count() == 3


def test_grids_and_approaches():
    assert {k: len(v) for k, v in A.GRIDS.items()} == {
        "ANN": 8, "SVM": 8, "DT": 6, "KNN": 6, "RF": 4, "AdaBoost": 4, "CatBoost": 3,
    }
    assert [a.name for a in A.APPROACHES.values()] == ["Binary with Feature Reduction", "Binary with PCA", "LDA", "Feature Reduction"]


def test_adaboost_follows_the_definition(spark):
    """The fitted stumps equal a plain numpy run of the same rounds on all cut points."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, (150, 3)).astype(float)
    y = ((x[:, 0] > 5).astype(int) + (x[:, 1] > 7) + (rng.random(150) < 0.1)).clip(0, 2)
    fitted = AdaBoost(3, 6, 0.8).fit(frame(spark, x, y).repartition(3))
    w = np.full(150, 1 / 150)
    for stump in fitted.stumps:
        best = np.inf
        for f in range(3):
            for cut in np.unique(x[:, f])[:-1]:
                side = x[:, f] <= cut
                kept = sum(max(w[part & (y == c)].sum() for c in range(3)) for part in (side, ~side))
                best = min(best, 1 - kept / w.sum())
        guess = np.where(x[:, stump.feature] <= stump.threshold, stump.left, stump.right)
        error = w[guess != y].sum() / w.sum()
        assert error == pytest.approx(best, abs=1e-9)
        assert stump.weight == pytest.approx(0.8 * (np.log((1 - error) / error) + np.log(2)))
        w = w * np.exp(stump.weight * (guess != y))
        w = w / w.sum()
    assert len(fitted.stumps) == 6


def test_adaboost_without_any_cut(spark):
    df = frame(spark, np.ones((9, 2)), [0, 0, 0, 0, 0, 1, 1, 1, 1])
    assert {r["prediction"] for r in AdaBoost(2, 3).fit(df).transform(df).collect()} == {0.0}


def test_a_column_of_rounding_errors_is_constant(spark):
    """A feature that is constant but for its last bit must not stop the others from being learned."""
    x = np.column_stack([np.repeat([0.0, 1.0], 20), np.full(40, -1.5491933384829666)])
    x[::3, 1] = np.nextafter(x[::3, 1], 0)
    y = np.repeat([0, 1], 20)
    model = get_model("SVC", {"kernel": "linear", "cost": 10.0}, Columns(2)).fit(frame(spark, x, y))
    assert [r["prediction"] for r in model.transform(frame(spark, x, y)).orderBy("id").collect()] == y.tolist()


def test_a_thousand_stumps_score(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(100, 2))
    stumps = tuple(Stump(int(i % 2), 0, float(t), int(i % 3), int((i + 1) % 3), 0.5) for i, t in enumerate(rng.normal(size=1000)))
    scored = AdaBoostModel(stumps, 3, "features").transform(frame(spark, x, np.zeros(100))).orderBy("id").collect()
    votes = np.zeros((100, 3))
    for s in stumps:
        low = x[:, s.feature] <= s.threshold
        votes[low, s.left] += s.weight
        votes[~low, s.right] += s.weight
    assert [int(r["prediction"]) for r in scored] == votes.argmax(axis=1).tolist()
    assert np.allclose([r["probability"].toArray() for r in scored], votes / 500)


def test_network_learning_rate_counts(three):
    train, _ = parts(three)
    weights = [NeuralNetwork(3, [4], max_epochs=5, learning_rate=r, seed=1).fit(train).weights for r in (1e-6, 0.5)]
    assert not np.allclose(*weights)
    with pytest.raises(ValueError, match="l-bfgs"):
        NeuralNetwork(3, learning_rate=0.1, solver="l-bfgs")


def test_block_of_training_rows_is_bounded(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 2))
    y = np.repeat([0, 1, 2], [30, 90, 180])
    model = NearestNeighbours(3, 3, max_train_rows=100).fit(frame(spark, x, y))
    kept = np.bincount(model.block["_ty"].to_numpy().astype(int))
    assert kept.tolist() == [10, 30, 60]
    assert "CoGroup" not in model.transform(frame(spark, x, y))._jdf.queryExecution().executedPlan().toString()


def test_neighbours_come_from_all_training_rows(spark):
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(300, 2)), rng.normal(size=(40, 2))
    model = NearestNeighbours(3, 3, max_train_rows=100, pivots=6).fit(frame(spark, x, rng.integers(0, 3, 300)))
    got = {(r["id"], r["rank"]): r["neighbour"] for r in model.neighbours(frame(spark, q, np.zeros(40), 1000)).collect()}
    model.unpersist()
    near = np.argsort(((q[:, None] - x) ** 2).sum(axis=2), axis=1)[:, :3]
    assert got == {(1000 + i, j + 1): near[i, j] for i in range(40) for j in range(3)}


def test_discriminant_leaves_unlabelled_rows_out(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (50, 2)), rng.normal(4, 1, (50, 2))])
    df = frame(spark, x, np.repeat([0, 1], 50))
    far = frame(spark, rng.normal(500, 100, (30, 2)), np.zeros(30)).withColumn("label", F.lit(None).cast("double"))
    one, both = (LinearDiscriminants().fit(d).weights for d in (df, df.unionByName(far)))
    assert np.allclose(one, both)


def test_neighbours_of_many_equal_rows_stay_small():
    """Ties among equal training rows are cut to the k that can win before they are measured."""
    import tracemalloc

    import numpy as np

    from tabloom.models.neighbours import _nearest

    points, queries = np.tile(np.eye(5), (10_000, 1)), np.tile(np.eye(5), (60, 1))
    tracemalloc.start()
    rows, columns, distance = _nearest(5)(queries, points)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    assert (columns.reshape(300, 5) == np.tile(np.arange(5)[:, None] + 5 * np.arange(5), (60, 1))).all()
    assert (rows == np.repeat(np.arange(300), 5)).all() and (distance == 0).all()


def test_neighbours_at_equal_distances_stay_small():
    """Different training rows that all are equally far from a query are measured a part at a time."""
    import itertools
    import tracemalloc

    import numpy as np

    from tabloom.models.neighbours import _nearest

    points = np.array([[float(i in ones) for i in range(16)] for ones in itertools.combinations(range(16), 8)])
    queries = np.linspace(0, 1, 100)[:, None] * np.ones(16)
    tracemalloc.start()
    rows, columns, distance = _nearest(7)(queries, points)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    assert (columns.reshape(100, 7) == np.arange(7)).all() and (rows == np.repeat(np.arange(100), 7)).all()
    assert np.abs(distance.reshape(100, 7) - np.sqrt(8 * (queries[:, :1] ** 2 + (1 - queries[:, :1]) ** 2))).max() < 1e-8


def test_block_of_neighbours_sends_rows_that_can_be_chosen(spark):
    """Of equal training rows only the first k go to the workers, and votes and neighbours are those of all rows."""
    import numpy as np

    from tabloom.models.neighbours import NearestNeighbours

    x = np.tile(np.eye(3), (50, 1))
    train = frame(spark, x, np.tile([0, 1, 1], 50).astype(float))
    model = NearestNeighbours(2, 2).fit(train)
    assert model.points.shape == (6, 3)
    assert share(model.transform(train)) == 1
    found = model.neighbours(train.where("id < 6")).orderBy("id", "rank").collect()
    assert [r["neighbour"] for r in found] == [0, 3, 1, 4, 2, 5] * 2


def test_kernel_features_are_not_carried_by_the_rows(spark, monkeypatch):
    """A pass maps its blocks anew: what is dealt out and cached is as wide as the inputs."""
    from tabloom.models import squared_hinge
    from tabloom.models.margins import SupportVectorMachine

    widths, deal = [], squared_hinge.dealt
    monkeypatch.setattr(squared_hinge, "dealt", lambda df, rows, width, **more: widths.append(width) or deal(df, rows, width, **more))

    x, y = blobs(2, 60)
    rows = frame(spark, x, y)
    fitted = SupportVectorMachine(2, "rbf", gamma=0.5, components=300).fit(rows)
    scored = fitted.transform(rows)
    assert share(scored) > 0.9
    assert set(scored.columns) - set(rows.columns) == {"prediction", "rawPrediction"}
    assert fitted.fitted.weights.shape == (1, 300)
    assert widths == [x.shape[1]]


def test_clusters_are_fitted_over_blocks_of_rows(spark, monkeypatch):
    """One product a block instead of a distance a row and centre, with the same clusters."""
    from pyspark.ml.clustering import KMeans

    from tabloom.operators import reduction

    solvers, fit = [], KMeans.fit
    monkeypatch.setattr(KMeans, "fit", lambda self, df: solvers.append(self.getSolver()) or fit(self, df))
    x, y = np.repeat(np.eye(3) * 10, [20, 30, 40], axis=0), np.zeros(90)
    found = reduction.kmeans_report(frame(spark, x, y), "id", k=3, max_iter=20, seed=1, project=False)
    assert solvers == ["block"]
    assert sorted(r["n"] for r in found["sizes"].collect()) == [20, 30, 40]
    assert found["fit"].first()["cost"] < 1e-9


def test_block_of_neighbours_is_not_merged_from_whole_shares(spark, monkeypatch):
    """Only rows near the wanted hashes are ordered, and the block is that of ordering all; copies of a key leave it whole."""
    def block(model):
        return sorted(zip(model.block["_tid"].to_pylist(), model.block["_ty"].to_pylist()))

    rows = spark.range(6000).select(
        "id", array_to_vector(F.array(F.col("id").cast("double"))).alias("features"), (F.col("id") % 3).cast("double").alias("label")
    ).repartition(8)
    asked, smallest = [], NearestNeighbours._smallest

    def noted(self, rows, share, near):
        asked.append(max(near.values()))
        return smallest(self, rows, share, near)

    monkeypatch.setattr(NearestNeighbours, "_smallest", noted)
    estimator = NearestNeighbours(3, 3, max_train_rows=300, seed=5)
    found = block(estimator.fit(rows))
    keys = [(F.md5(F.concat_ws(":", F.lit("5"), F.col("id").cast("string")))), F.col("id")]
    wanted = [(r["id"], r["label"]) for c in (0.0, 1.0, 2.0) for r in rows.where(F.col("label") == c).orderBy(*keys).limit(100).collect()]
    assert found == sorted(wanted) and asked == [pytest.approx(196 / 2000)]
    copies = rows.withColumn("id", F.lit(7).cast("long"))
    assert len(block(estimator.fit(copies))) == 300

def test_votes_come_from_all_training_rows(spark):
    """No training row is left out, however many there are: each one finds itself."""
    rows = spark.range(60_000).select(
        "id", array_to_vector(F.array(F.col("id").cast("double"), F.lit(1.0))).alias("features"), F.pmod(F.xxhash64("id"), F.lit(3)).cast("double").alias("label")
    )
    assert share(NearestNeighbours(3, 1).fit(rows).transform(rows)) == 1.0


def test_points_with_very_many_rows_are_cut_to_the_k_that_can_win(spark):
    """Rows of few points are one block, made of the rows with the smallest keys of all."""
    rows = spark.range(60_000, numPartitions=8).select(
        (60_000 - F.col("id")).alias("id"), array_to_vector(F.array((F.col("id") % 2).cast("double"))).alias("features"), (F.col("id") >= 59_990).cast("double").alias("label")
    )
    model = NearestNeighbours(2, 3).fit(rows)
    assert sorted(model.block["_tid"].to_pylist()) == [1, 2, 3, 4, 5, 6]
    assert model.transform(rows).where("prediction = 1").count() == 60_000


def test_neighbours_beyond_one_block_take_any_keys(spark, monkeypatch):
    """Cells give what a block gives: keys of queries and rows may repeat or be missing, labels may be missing."""
    from tabloom.models import neighbours

    rng = np.random.default_rng(7)
    x, q = np.round(rng.normal(size=(400, 3)), 1), np.round(rng.normal(size=(60, 3)), 1)
    x[:90] = x[0]
    train = frame(spark, x, rng.integers(0, 3, 400)).withColumn("label", F.when(F.col("id") % 7 > 0, F.col("label")))
    train = train.withColumn("id", F.when(F.col("id") % 50 != 9, F.col("id")))
    asked = frame(spark, np.vstack([q, q[:5]]), np.zeros(65)).withColumn("id", F.when(F.col("id") % 9 > 0, F.col("id") % 20)).withColumn("own", F.lit("x"))
    answers = []
    for most in (50_000, 100):
        monkeypatch.setattr(neighbours, "BLOCK_ROWS", most)
        monkeypatch.setattr(neighbours, "CELL_ROWS", 30)
        model = NearestNeighbours(3, 5, block_rows=20).fit(train)
        scored = model.transform(asked)
        assert scored.columns == ["id", "features", "label", "own", "prediction", "probability"]
        near = [(r["id"], r["rank"], round(r["distance"], 6), r["neighbour"]) for r in model.neighbours(asked).collect()]
        answers.append((sorted(map(repr, near)), sorted(map(repr, scored.select("id", "features", "prediction", "probability").collect()))))
    assert len(answers[0][0]) == 65 * 5 and len(answers[0][1]) == 65 and answers[0] == answers[1]
    repeated = frame(spark, np.vstack([q, q[:5]]), np.zeros(65)).withColumn("id", F.col("id") % 60)
    assert NearestNeighbours(3, 5, block_rows=20, exact=True).fit(train).neighbours(repeated).count() == 60 * 5


def test_linear_machines_of_parts_share_their_passes(three, monkeypatch):
    """Folds, costs and calibration parts are dealt out and scanned once, with the machines of separate fits."""
    from tabloom.models import squared_hinge
    from tabloom.models.margins import CalibratedMargins, SupportVectorMachine

    train, _ = parts(three)
    df = stratified_kfold(train, "id", "label", 3, 2)
    configs = [("SVM", {"kernel": "linear", "cost": c}) for c in (0.1, 10.0)]
    names = ["a", "b", "c"]
    alone = V.fold_counts(df, configs, Columns(3), names, make=lambda *a: get_model(*a))
    calls, deal = [], squared_hinge.dealt
    monkeypatch.setattr(squared_hinge, "dealt", lambda *a, **more: calls.append(1) or deal(*a, **more))
    together = V.fold_counts(df, configs, Columns(3), names)
    assert len(calls) == 1
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, alone.collect()))
    machine = SupportVectorMachine(3, "linear")
    calibrated = CalibratedMargins(machine, "id")
    one, other = calibrated.fit_parts(train, [F.col("id") % 4 > 0, F.lit(True)])
    assert len(calls) == 2
    for model, rows in ((one, train.where("id % 4 > 0")), (other, train)):
        fitted = machine.fit(rows).fitted
        assert np.allclose(model.fitted.fitted.weights, fitted.weights, atol=1e-3) and np.allclose(model.fitted.fitted.intercepts, fitted.intercepts, atol=1e-3)
