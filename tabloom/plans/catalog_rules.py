"""Models, selection and reductions on inputs whose answer SQL can state.

Most labels here follow from a rule of the inputs, so a model that has learned the rule predicts it on
every held-out row; others have a closed form: majorities, averages, shares, best cuts, components.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.models.boosting import ordered_statistics
from tabloom.models.registry import Columns, get_model
from tabloom.operators import popularity as P
from tabloom.operators import profile as R
from tabloom.operators import reduction as D
from tabloom.operators import splits as X
from tabloom.plans import approaches as A
from tabloom.plans import evaluation as V
from tabloom.plans.catalog import SEED, query, rounded, table
from tabloom.plans.catalog_models import TWO_FEATURES, two_features

TYPES = ("click", "error", "purchase", "signup", "view")
CLASSES = ["A", "B", "C"]

# --- labels that follow a rule ---------------------------------------------------------------

RULED = f"""
k AS (SELECT event_id, event_type, ROW_NUMBER() OVER (ORDER BY md5('{SEED}:' || event_id::VARCHAR)) AS r, COUNT(*) OVER () AS c FROM events),
h AS (SELECT event_id, event_type, CASE WHEN event_type IN ('purchase', 'view') THEN 'A' WHEN event_type = 'click' THEN 'B' ELSE 'C' END AS label,
  r <= ROUND_EVEN(c * 0.2::DOUBLE, 0) AS test FROM k)"""
RULE_SQL = f"WITH {RULED} SELECT event_id, label, label AS prediction FROM h WHERE test"
TWO_SQL = f"WITH {RULED} SELECT event_id, CASE WHEN label = 'A' THEN 'A' ELSE 'B' END AS label, CASE WHEN label = 'A' THEN 'A' ELSE 'B' END AS prediction FROM h WHERE test"


def ruled(spark, folder, classes=CLASSES) -> tuple[DataFrame, DataFrame]:
    """Event types one-hot, with a label that a rule derives from the type; held out 80/20."""
    kind = F.col("event_type")
    label = F.when(kind.isin("purchase", "view"), "A").when((kind == "click") | F.lit(len(classes) == 2), "B").otherwise("C")
    hot = F.array(*[(kind == t).cast("double") for t in TYPES])
    df = table(spark, folder, "events").select("event_id", label.alias("label"), *[hot[i].alias(f"is_{t}") for i, t in enumerate(TYPES)], array_to_vector(hot).alias("features"))
    df = V.with_class_index(X.holdout(df, "event_id", 0.2, SEED), "label", classes, "y")
    return df.where("split = 'train'").drop("split"), df.where("split = 'test'").drop("split")


def columns_for(classes=CLASSES) -> Columns:
    return Columns(len(classes), "event_id", "features", "y", SEED)


def named(scored: DataFrame, classes=CLASSES) -> DataFrame:
    return scored.select("event_id", "label", V.class_name(F.col("prediction"), classes).alias("prediction"))


def rule_query(name: str, model: str, settings: dict, classes=CLASSES):
    def run(spark, folder):
        train, test = ruled(spark, folder, classes)
        return named(get_model(model, settings, columns_for(classes)).fit(train).transform(test), classes)

    run.__name__ = name
    return query(RULE_SQL if len(classes) == 3 else TWO_SQL)(run)


TWO = ["A", "B"]
rule_query("rule_svm_linear", "SVC", {"kernel": "linear", "cost": 10.0})
rule_query("rule_svm_rbf", "SVC", {"kernel": "rbf", "gamma": 0.5, "cost": 10.0})
rule_query("rule_svm_poly", "SVC", {"kernel": "poly", "gamma": 1.0, "coef0": 1.0, "cost": 10.0})
rule_query("rule_svm_sigmoid", "SVC", {"kernel": "sigmoid", "gamma": 0.1, "coef0": 0.1, "cost": 10.0})
rule_query("rule_svm_exact", "SVC", {"exact": True, "kernel": "rbf", "gamma": 0.5, "cost": 10.0})
rule_query("rule_svm_exact_sigmoid", "SVC", {"exact": True, "kernel": "sigmoid", "gamma": 0.1, "coef0": 0.1, "cost": 10.0})
rule_query("rule_svm_probabilistic", "SVCProbabilistic", {"kernel": "linear", "cost": 10.0})
rule_query("rule_decision_tree", "DT", {"max_depth": 5})
rule_query("rule_random_forest", "RF", {"n_trees": 15, "max_depth": 6})
rule_query("rule_adaboost", "AdaBoost", {"n_estimators": 12})
rule_query("rule_gradient_boosting", "CatBoost", {"iterations": 5, "depth": 4}, TWO)
rule_query("rule_gradient_boosting_multiclass", "CatBoost", {"iterations": 4, "depth": 4})
rule_query("rule_logistic", "LogisticClassifier", {})
rule_query("rule_knn", "KNN", {"n_neighbors": 5})
rule_query("rule_network", "ANN", {"topology": [8], "max_epochs": 120})
# a published setting, all of it
rule_query(
    "rule_network_learning_rate", "ANN",
    {"topology": [128, 64], "max_epochs": 200, "learning_rate": 0.001, "validation_ratio": 0.2, "patience": 20},
)
rule_query("rule_network_early_stopping", "ANN", {"topology": [8], "max_epochs": 120, "validation_ratio": 0.2, "patience": 40})


@query(f"""
SELECT event_id, ROUND((COALESCE(SUM(value > 50) OVER w, 0) + 0.5) / (COUNT(value) OVER w + 1), 6) AS statistic FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY md5('{SEED}:' || event_id::VARCHAR) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def ordered_target_statistics(spark, folder):
    """How often earlier events of the same type had a large value, in a random order."""
    events = table(spark, folder, "events").select("event_id", "event_type", (F.col("value") > 50).cast("int").alias("large"))
    return rounded(ordered_statistics(events, "event_type", "large", ["event_id"], SEED).select("event_id", "statistic"))


@query(RULE_SQL)
def rule_bagging(spark, folder):
    train, test = ruled(spark, folder)
    return named(V.Bagging("DT", {"max_depth": 5}, columns_for(), sizes=(2, 3)).fit(train).transform(test))


@query(RULE_SQL)
def rule_stacking(spark, folder):
    train, test = ruled(spark, folder)
    bases = [("DT", {"max_depth": 5}), ("LogisticClassifier", {})]
    return named(V.Stacking(bases, columns_for()).fit(train).transform(test))


@query(RULE_SQL)
def rule_tuned_svm(spark, folder):
    """The cost of a support vector machine tuned on a hold-out, two points of its grid."""
    train, test = ruled(spark, folder)
    model, _ = V.tune(train, "SVC", {"kernel": "linear"}, columns_for(), grid=("cost", (1.0, 10.0)))
    return named(model.transform(test))


@query("SELECT 'max_depth' AS setting, UNNEST([4, 6, 8])::DOUBLE AS value, 0.0::DOUBLE AS log_loss")
def rule_tuned_tree(spark, folder):
    """A tree of four levels or more states the rule, so its hold-out loss is nothing."""
    train, _ = ruled(spark, folder)
    return rounded(V.tune(train, "DT", {}, columns_for(), grid=("max_depth", (4, 6, 8)))[1])


RULE_FOLDS = f"""
f AS (SELECT event_id, label, NTILE(3) OVER (PARTITION BY label ORDER BY md5('{SEED}:' || event_id::VARCHAR)) AS fold FROM h WHERE NOT test)"""


@query(f"""
WITH {RULED}, {RULE_FOLDS}, c AS (SELECT * FROM (VALUES ('DT', 0), ('DT', 1), ('KNN', 2)) AS v(family, config_index))
SELECT family, config_index, fold::INT AS fold, label, label AS prediction, COUNT(*) AS n FROM f, c GROUP BY ALL""")
def rule_fold_counts(spark, folder):
    """Confusion counts by config and fold: every true class is predicted as itself."""
    train, _ = ruled(spark, folder)
    df = X.stratified_kfold(train, "event_id", "label", 3, SEED)
    configs = [("DT", {"max_depth": 5}), ("DT", {"max_depth": 8}), ("KNN", {"n_neighbors": 3})]
    counts = V.fold_counts(df, configs, columns_for(), CLASSES, parallelism=4)
    return counts.select("family", "config_index", "fold", "label", "prediction", "n")


RULE_REPORT = f"""
WITH {RULED}, n AS (SELECT COUNT(*) FILTER (label = 'A') AS a, COUNT(*) FILTER (label = 'B') AS b, COUNT(*) FILTER (label = 'C') AS c FROM h WHERE NOT test)"""


def report_rows(report: DataFrame) -> DataFrame:
    cm = F.col("cm")
    return rounded(
        report.select(
            "family", "config_index", "accuracy_mean", "accuracy_std", "f1_mean", *[cm[i][i].cast("double").alias(c) for i, c in enumerate("abc")],
        )
    )


def report_sql(*families: str) -> str:
    rows = ", ".join(f"('{f}', {i})" for i, f in enumerate(families))
    return f"""{RULE_REPORT} SELECT family, config_index, 1.0::DOUBLE AS accuracy_mean, 0.0::DOUBLE AS accuracy_std, 1.0::DOUBLE AS f1_mean,
  a::DOUBLE AS a, b::DOUBLE AS b, c::DOUBLE AS c FROM n, (VALUES {rows}) AS v(family, config_index)"""


@query(report_sql("ANN", "LogisticClassifier"))
def rule_cv(spark, folder):
    """Cross-validation of a network, two executions a fold, and a logistic model."""
    train, _ = ruled(spark, folder)
    df = X.stratified_kfold(train, "event_id", "label", 2, SEED)
    configs = [("ANN", {"topology": [8], "max_epochs": 120, "validation_ratio": 0.2, "patience": 60, "executions": 2}), ("LogisticClassifier", {})]
    return report_rows(V.cross_validate(df, configs, columns_for(), CLASSES, parallelism=4))


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(f"""
WITH n AS (SELECT COUNT(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')) AS a, COUNT(*) FILTER (c_mktsegment = 'AUTOMOBILE') AS b,
  COUNT(*) FILTER (c_mktsegment IN ('FURNITURE', 'HOUSEHOLD')) AS c FROM customer)
SELECT 'ANN' AS family, config_index::INT AS config_index, 1.0::DOUBLE AS accuracy_mean, 0.0::DOUBLE AS accuracy_std, 1.0::DOUBLE AS f1_mean,
  a::DOUBLE AS a, b::DOUBLE AS b, c::DOUBLE AS c FROM n, (VALUES {", ".join(f"({i})" for i in range(len(A.ANN_CONFIGS)))}) AS v(config_index)""")
def rule_network_grid(spark, folder):
    """The eight published network settings over two folds of all customers, trained in the same scans."""
    kind = F.col("c_mktsegment")
    label = F.when(kind.isin("BUILDING", "MACHINERY"), "A").when(kind == "AUTOMOBILE", "B").otherwise("C")
    # the smallest networks need inputs of this size to get there in 300 steps of 0.001
    hot = F.array(*[F.when(kind == t, 8.0).otherwise(0.0) for t in SEGMENTS])
    df = table(spark, folder, "customer").select("c_custkey", label.alias("label"), array_to_vector(hot).alias("features"))
    df = X.stratified_kfold(V.with_class_index(df, "label", CLASSES, "y"), "c_custkey", "label", 2, SEED)
    columns = Columns(3, "c_custkey", "features", "y", SEED)
    return report_rows(V.cross_validate(df, [("ANN", c) for c in A.ANN_CONFIGS], columns, CLASSES))


@query(report_sql("Bagging"))
def rule_bagging_cv(spark, folder):
    train, _ = ruled(spark, folder)
    df = X.stratified_kfold(train, "event_id", "label", 2, SEED)
    return report_rows(V.cross_validate_ensemble(df, "Bagging", lambda c: V.Bagging("DT", {"max_depth": 5}, c, sizes=(2, 3)), columns_for(), CLASSES))


@query(report_sql("Stack"))
def rule_stacking_cv(spark, folder):
    train, _ = ruled(spark, folder)
    df = X.stratified_kfold(train, "event_id", "label", 2, SEED)
    bases = [("DT", {"max_depth": 5}), ("LogisticClassifier", {})]
    return report_rows(V.cross_validate_ensemble(df, "Stack", lambda c: V.Stacking(bases, c), columns_for(), CLASSES))


SMALL_GRIDS = {
    "ANN": ({"topology": [8], "max_epochs": 120, "executions": 1},),
    "SVM": ({"kernel": "linear", "cost": 10.0},),
    "DT": ({"max_depth": 5, "min_samples_leaf": 1},),
    "KNN": ({"n_neighbors": 3},),
    "RF": ({"n_trees": 15, "max_depth": 6},),
    "AdaBoost": ({"n_estimators": 12, "learning_rate": 1.0},),
    "CatBoost": ({"iterations": 4, "learning_rate": 0.3, "depth": 4},),
}


def experiment(spark, folder, approach: A.Approach, families, classes=CLASSES) -> DataFrame:
    train, test = ruled(spark, folder, classes)
    inputs = [f"is_{t}" for t in TYPES]
    train, test = (d.drop("features", "y") for d in (train, test))
    result = A.run_approach(train, test, "event_id", inputs, "label", approach, {f: SMALL_GRIDS[f] for f in families}, SEED, 4)
    rows = result.test.select("model", "accuracy", "f1", "cm")
    if result.stack is not None:
        rows = rows.unionByName(result.stack.select(F.col("family").alias("model"), F.col("accuracy_mean").alias("accuracy"), F.col("f1_mean").alias("f1"), "cm"))
    total = F.aggregate(F.flatten("cm"), F.lit(0.0), lambda s, v: s + v)
    return rounded(rows.select("model", "accuracy", "f1", total.alias("rows")))


def experiment_sql(models: tuple[str, ...], stack: bool = False) -> str:
    rows = ", ".join(f"('{m}')" for m in models)
    extra = "UNION ALL SELECT 'Stack', 1.0::DOUBLE, 1.0::DOUBLE, COUNT(*) FILTER (NOT test)::DOUBLE FROM h" if stack else ""
    return f"""WITH {RULED} SELECT model, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS f1, n AS rows
FROM (SELECT COUNT(*) FILTER (test)::DOUBLE AS n FROM h), (VALUES {rows}) AS v(model) {extra}"""


@query(experiment_sql(("ANN", "SVC", "DecisionTreeClassifier", "KNeighborsClassifier", "RandomForestClassifier", "AdaBoostClassifier", "CatBoostClassifier"), True))
def approach_all_families(spark, folder):
    """The three-class experiment with all seven families and the stack of the best."""
    return experiment(spark, folder, A.Approach("all", folds=2), tuple(SMALL_GRIDS))


@query(experiment_sql(("DecisionTreeClassifier", "CatBoostClassifier")))
def approach_binary_reduced(spark, folder):
    return experiment(spark, folder, A.APPROACHES["binary_reduced"], ("DT", "CatBoost"), TWO)


@query(experiment_sql(("DecisionTreeClassifier",)))
def rule_approach_pca(spark, folder):
    """The named component experiment: 70 % of the variance keep all event types apart."""
    return experiment(spark, folder, A.APPROACHES["binary_pca"], ("DT",), TWO)


@query(experiment_sql(("DecisionTreeClassifier", "KNeighborsClassifier"), True))
def rule_approach_lda(spark, folder):
    """The named discriminant experiment: two directions keep three classes apart."""
    return experiment(spark, folder, A.APPROACHES["lda"], ("DT", "KNN"))


@query(experiment_sql(("DecisionTreeClassifier",)))
def approach_minmax(spark, folder):
    return experiment(spark, folder, A.Approach("minmax", normalize="minmax", folds=2), ("DT",))


@query(experiment_sql(("DecisionTreeClassifier",)))
def approach_unscaled(spark, folder):
    return experiment(spark, folder, A.Approach("unscaled", normalize=None, folds=2), ("DT",))


# --- closed forms ----------------------------------------------------------------------------

HELD_LINES = f"""
k AS (SELECT *, ROW_NUMBER() OVER (ORDER BY md5('{SEED}:' || o_orderkey::VARCHAR)) AS r, COUNT(*) OVER () AS c FROM orders),
h AS (SELECT *, r <= ROUND_EVEN(c * 0.2::DOUBLE, 0) AS test FROM k)"""


def held(spark, folder, *columns) -> tuple[DataFrame, DataFrame]:
    df = X.holdout(table(spark, folder, "orders").select("o_orderkey", *columns), "o_orderkey", 0.2, SEED)
    return df.where("split = 'train'").drop("split"), df.where("split = 'test'").drop("split")


@query(f"""
WITH {HELD_LINES}, a AS (SELECT YEAR(o_orderdate) AS y, AVG(o_totalprice) AS p FROM h WHERE NOT test GROUP BY 1)
SELECT o_orderkey, ROUND(p, 4) AS prediction FROM h JOIN a ON YEAR(o_orderdate) = y WHERE test""")
def tree_average_per_year(spark, folder):
    """A regression tree on the year alone, deep enough for every year, gives each year's average."""
    train, test = held(spark, folder, F.year("o_orderdate").cast("double").alias("year"), "o_totalprice")
    assemble = VectorAssembler(inputCols=["year"], outputCol="features")
    model = get_model("DecisionTreeRegressor", {"max_depth": 6}, Columns(0, "o_orderkey", "features", "o_totalprice", SEED)).fit(assemble.transform(train))
    return model.transform(assemble.transform(test)).select("o_orderkey", F.round("prediction", 4).alias("prediction"))


@query("""
WITH s AS (SELECT event_type IN ('purchase', 'view') AS x, AVG((value > 30)::INT) AS share FROM events GROUP BY 1)
SELECT x, ROUND(share, 3) AS probability FROM s""")
def logistic_shares(spark, folder):
    """A logistic model of one Boolean input is saturated: its probabilities are the class shares."""
    x = F.col("event_type").isin("purchase", "view")
    df = table(spark, folder, "events").select(
        "event_id", x.alias("x"), F.coalesce(F.col("value") > 30, F.lit(False)).cast("double").alias("y"), array_to_vector(F.array(x.cast("double"))).alias("features")
    )
    model = get_model("LogisticClassifier", {}, Columns(2, "event_id", "features", "y", SEED)).fit(df)
    one = model.transform(df.select("x", "features").distinct())
    return one.select("x", F.round(vector_to_array("probability")[1], 3).alias("probability"))


@query("""
WITH e AS (SELECT l_discount AS x, (l_discount > 0.045) <> (l_orderkey % 10 = 0) AS y FROM lineitem),
c AS (SELECT DISTINCT x AS t FROM e), n AS (SELECT COUNT(*) AS n FROM e),
s AS (SELECT t, COUNT(*) FILTER (x <= t AND y) AS ly, COUNT(*) FILTER (x <= t AND NOT y) AS ln, COUNT(*) FILTER (x > t AND y) AS ry, COUNT(*) FILTER (x > t AND NOT y) AS rn
  FROM e, c GROUP BY t),
b AS (SELECT * FROM s WHERE t < (SELECT MAX(t) FROM c) ORDER BY LEAST(ly, ln) + LEAST(ry, rn), t LIMIT 1)
SELECT e.x, (CASE WHEN e.x <= t THEN ly > ln ELSE ry > rn END) AS prediction, COUNT(*) AS n FROM e, b GROUP BY ALL""")
def adaboost_best_cut(spark, folder):
    """One stump is the cut with the smallest error."""
    x = F.col("l_discount")
    y = (x > 0.045) != (F.col("l_orderkey") % 10 == 0)
    df = table(spark, folder, "lineitem").select(x.alias("x"), y.cast("double").alias("y"), array_to_vector(F.array(x)).alias("features"))
    model = get_model("AdaBoost", {"n_estimators": 1}, Columns(2, "x", "features", "y", SEED)).fit(df)
    return model.transform(df).groupBy("x", (F.col("prediction") == 1).alias("prediction")).agg(F.count("*").alias("n"))


ONE_COMPONENT = """v AS (SELECT *, sab AS vx, l1 - saa AS vy, SQRT(sab * sab + (l1 - saa) * (l1 - saa)) AS nv FROM l),
d AS (SELECT *, CASE WHEN ABS(vx) >= ABS(vy) THEN SIGN(vx) ELSE SIGN(vy) END AS s, CASE WHEN ABS(vy) >= ABS(vx) THEN -SIGN(vy) ELSE SIGN(vx) END AS s2 FROM v)"""
TRAIN_FEATURES = TWO_FEATURES.replace("FROM orders)", "FROM h WHERE NOT test), z AS (SELECT o_orderkey, (o_totalprice / 1000) AS a, (o_totalprice / 2000 + o_custkey / 10) AS b FROM h WHERE test)")


@query(f"""
WITH {TWO_FEATURES}, {ONE_COMPONENT}
SELECT o_orderkey, ROUND(s * ((a - ma) * vx + (b - mb) * vy) / nv, 4) AS pc1, CASE WHEN l1 / (l1 + l2) >= 0.7 THEN 1 ELSE 2 END AS kept FROM x, d""")
def pca_ratio(spark, folder):
    """The fewest components that reach 70 % of the variance."""
    df = two_features(spark, folder)
    model = D.PrincipalComponents(variance_ratio=0.7).fit(df)
    return model.transform(df).select("o_orderkey", F.round(vector_to_array("scores")[0], 4).alias("pc1"), F.lit(model.k).alias("kept"))


def held_two_features(spark, folder) -> tuple[DataFrame, DataFrame]:
    df = X.holdout(two_features(spark, folder), "o_orderkey", 0.2, SEED)
    return df.where("split = 'train'").drop("split"), df.where("split = 'test'").drop("split")


@query(f"""
WITH {HELD_LINES}, {TRAIN_FEATURES}, {ONE_COMPONENT} SELECT o_orderkey, ROUND(s * ((a - ma) * vx + (b - mb) * vy) / nv, 4) AS pc1 FROM z, d""")
def pca_held_out(spark, folder):
    """Components of the training rows, applied to test rows."""
    train, test = held_two_features(spark, folder)
    scored = D.PrincipalComponents(k=1).fit(train).transform(test)
    return scored.select("o_orderkey", F.round(vector_to_array("scores")[0], 4).alias("pc1"))


@query(f"""
WITH {TWO_FEATURES}, {ONE_COMPONENT}
SELECT ROUND(s * ((a - ma) * vx + (b - mb) * vy) / nv, 4) AS pc1, ROUND(s2 * ((b - mb) * vx - (a - ma) * vy) / nv, 4) AS pc2, o_orderstatus AS label FROM x, d""")
def class_points(spark, folder):
    df = two_features(spark, folder)
    return rounded(D.points_by_class(D.PrincipalComponents(k=2).fit(df).transform(df), "scores", "o_orderstatus"), 4)


@query(f"""
WITH {HELD_LINES}, {TRAIN_FEATURES.split('m AS')[0].rstrip().rstrip(',')}, y AS (SELECT *, (o_orderstatus = 'F') AS y FROM x),
g AS (SELECT y, COUNT(*) AS n, AVG(a) AS ma, AVG(b) AS mb, VAR_POP(a) * COUNT(*) AS waa, VAR_POP(b) * COUNT(*) AS wbb, COVAR_POP(a, b) * COUNT(*) AS wab FROM y GROUP BY 1),
w AS (SELECT SUM(n) AS n, SUM(waa) / (SUM(n) - 2) AS waa, SUM(wbb) / (SUM(n) - 2) AS wbb, SUM(wab) / (SUM(n) - 2) AS wab,
  SUM(n * ma) / SUM(n) AS ca, SUM(n * mb) / SUM(n) AS cb,
  MAX(ma) FILTER (y) - MAX(ma) FILTER (NOT y) AS da, MAX(mb) FILTER (y) - MAX(mb) FILTER (NOT y) AS db FROM g),
d AS (SELECT *, (wbb * da - wab * db) / (waa * wbb - wab * wab) AS u, (waa * db - wab * da) / (waa * wbb - wab * wab) AS v FROM w),
s AS (SELECT *, SQRT(waa * u * u + 2 * wab * u * v + wbb * v * v) * CASE WHEN ABS(u) >= ABS(v) THEN SIGN(u) ELSE SIGN(v) END AS q FROM d)
SELECT o_orderkey, ROUND(((a - ca) * u + (b - cb) * v) / q, 3) AS score FROM z, s""")
def discriminant_held_out(spark, folder):
    """The discriminant of labelled training rows, applied to test rows; every unlabelled row is left out of the fit."""
    train, test = held_two_features(spark, folder)
    train = train.withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    blank = train.limit(20).withColumn("label", F.lit(None).cast("int"))
    model = D.LinearDiscriminants(ridge=0.0).fit(train.unionByName(blank))
    return model.transform(test).select("o_orderkey", F.round(vector_to_array("scores")[0], 3).alias("score"))


def clustered(spark, folder) -> dict[str, DataFrame]:
    kind = F.col("event_type")
    df = table(spark, folder, "events").select("event_id", array_to_vector(F.array(*[(kind == t).cast("double") * 10 for t in TYPES])).alias("features"))
    return D.kmeans_report(df, "event_id", k=5, max_iter=50, seed=SEED, project=False)


@query("SELECT COUNT(*) AS n, ROUND(100.0::DOUBLE * COUNT(*) / (SELECT COUNT(*) FROM events), 6) AS pct FROM events GROUP BY event_type")
def kmeans_types(spark, folder):
    """Five far points make five clusters."""
    return rounded(clustered(spark, folder)["sizes"].select("n", "pct"))


@query("SELECT true AS converged, 0.0::DOUBLE AS cost")
def kmeans_fit(spark, folder):
    return rounded(clustered(spark, folder)["fit"].select("converged", "cost"))


# --- exploration tables ----------------------------------------------------------------------


@query("""
SELECT CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
  ELSE 'timestamp_ntz' END AS data_type, COUNT(*)::INT AS n_columns FROM (
  SELECT UNNEST([typeof(o_orderkey), typeof(o_custkey), typeof(o_orderstatus), typeof(o_totalprice), typeof(o_orderdate), typeof(o_orderpriority)]) AS data_type
  FROM (SELECT * FROM orders LIMIT 1)) GROUP BY 1""")
def type_counts(spark, folder):
    return R.quality_report(table(spark, folder, "orders"))["types"]


@query("SELECT 'o_orderdate' AS columns, MIN(o_orderdate) AS earliest, COUNT(*) AS n_dates FROM orders")
def date_columns(spark, folder):
    found = R.temporal_report(table(spark, folder, "orders"), "o_orderdate")
    names = ",".join(r[0] for r in found["columns"].collect())
    return found["range"].select(F.lit(names).alias("columns"), "earliest", "n_dates")


@query("""
WITH c AS (SELECT 'listens' AS name, value AS v, event_type FROM events)
SELECT 'by_category' AS part, event_type AS name, ROUND(AVG(v), 6) AS mean, COUNT(v) AS n FROM c GROUP BY 2
UNION ALL SELECT 'histogram_listens', 'listens', NULL, COUNT(v) FROM c GROUP BY 2
UNION ALL SELECT 'points', 'listens', NULL, LEAST(2000, COUNT(*) FILTER (v > 0)) FROM c GROUP BY 2""")
def popularity_report(spark, folder):
    """The report's tables in short: category means, rows in the histogram, sampled points."""
    df = table(spark, folder, "events").select(
        "event_id", F.col("event_type").alias("track_genre_top"), F.col("value").alias("track_listens"), (F.col("user_id") % 500 + 50).alias("track_duration")
    )
    found = P.popularity_report(df, "event_id")
    groups = found["by_category"].select(F.lit("by_category").alias("part"), F.col("track_genre_top").alias("name"), F.col("mean_popularity").alias("mean"), "n")

    def total(part: str, n) -> DataFrame:
        return found[part].agg(n.alias("n")).select(F.lit(part).alias("part"), F.lit("listens").alias("name"), F.lit(None).cast("double").alias("mean"), "n")

    return rounded(groups.unionByName(total("histogram_listens", F.sum("n"))).unionByName(total("points", F.count("*"))))


SAMPLED = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(f"""
WITH a AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, ROUND(AVG({c}), 6) AS mean FROM lineitem" for c in SAMPLED)})
SELECT * FROM a ORDER BY md5('{SEED}:' || feature) LIMIT 2""")
def column_sample(spark, folder):
    chosen = X.sample_columns(SAMPLED, 2, SEED)
    means = table(spark, folder, "lineitem").agg(*[F.avg(c).alias(c) for c in chosen])
    items = F.array(*[F.struct(F.lit(c).alias("feature"), F.round(c, 6).alias("mean")) for c in chosen])
    return means.select(F.inline(items))
