"""Queries for sources, reductions, models, selection and reports.

Where SQL can say the same, the query has an oracle; fitted models are checked by their rows
here and by invariants in the tests.
"""

from __future__ import annotations

import json

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.models.registry import Columns, get_model
from tabloom.operators import reduction as D
from tabloom.operators import splits as X
from tabloom.operators.metrics import confusion_counts, multiclass_metrics
from tabloom.operators.scaling import ZScore
from tabloom.operators.wide_components import WidePrincipalComponents
from tabloom.plans import approaches as A
from tabloom.plans import evaluation as V
from tabloom.plans import report as RP
from tabloom.plans.catalog import SEED, features, held_orders, query, rounded, table
from tabloom.session import dealt, keep, shared_folder
from tabloom.sources import delimited as SRC

# --- sources -------------------------------------------------------------------------------


def _header_file(spark, folder, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(folder)
    return folder


def _written_tracks(spark, folder):
    """All orders as a headed tracks file; every third key is text, so that only two thirds meet a features key."""
    base = shared_folder(spark, "tracks")
    header = _header_file(
        spark, f"{base}/header", [",album,track,track,track", ",title,date_created,genre_top,listens", "track_id,,,,"]
    )
    key = F.col("o_orderkey")
    orders = table(spark, folder, "orders").select(
        F.when(key % 3 == 0, F.concat(F.lit("T"), key.cast("string"))).otherwise(key.cast("string")),
        F.concat(F.lit("a, "), "o_orderstatus"),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")),
        F.round("o_totalprice", 2),
    )
    orders.write.csv(f"{base}/body")
    return f"{base}/body", {"header_path": header}


def _written_features(spark, folder):
    base = shared_folder(spark, "features")
    header = _header_file(
        spark,
        f"{base}/header",
        ["feature,mfcc,mfcc,tonnetz", "statistics,mean,mean,std", "number,01,02,01", "track_id,,,"],
    )
    table(spark, folder, "orders").select(
        "o_orderkey",
        F.round(F.col("o_totalprice") / 100, 4),
        F.when(F.col("o_orderstatus") == "F", F.lit("NaN")).otherwise(F.col("o_custkey").cast("string")),
        F.when(F.col("o_orderstatus") == "O", F.lit("")).otherwise(F.lit("1.5")),
    ).write.csv(f"{base}/body")
    return f"{base}/body", {"header_path": header}


TRACK_KEY = "CASE WHEN o_orderkey % 3 = 0 THEN 'T' || o_orderkey::VARCHAR ELSE o_orderkey::VARCHAR END"


@query(f"""
SELECT {TRACK_KEY} AS track_id, NULLIF(o_orderpriority, '5-LOW') AS track_genre_top, ROUND(o_totalprice, 2) AS track_listens FROM orders""")
def scan_tracks(spark, folder):
    path, options = _written_tracks(spark, folder)
    return SRC.read_tracks(spark, path, ["genre_top", "listens"], **options)


@query("""
SELECT o_orderkey AS track_id, ROUND(o_totalprice / 100, 4) AS mfcc_mean_01,
  CASE WHEN o_orderstatus <> 'F' THEN o_custkey::DOUBLE END AS mfcc_mean_02 FROM orders""")
def scan_features(spark, folder):
    path, options = _written_features(spark, folder)
    return SRC.read_features(spark, path, ["mfcc"], key_type="bigint", **options)


@query("""
SELECT CASE o_orderkey % 4 WHEN 0 THEN 'A' || o_orderkey::VARCHAR WHEN 1 THEN '00' || o_orderkey::VARCHAR WHEN 2 THEN o_orderkey::VARCHAR END AS track_id,
  o_custkey::BIGINT AS track_listens FROM orders""")
def scan_text_keys(spark, folder):
    """Keys that are no numbers, have leading zeros or are missing: every line below the headers is a row."""
    base = shared_folder(spark, "text-keys")
    header = _header_file(spark, f"{base}/header", [",track", ",listens", "track_id,"])
    key = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 4
    named = F.when(kind == 0, F.concat(F.lit("A"), key)).when(kind == 1, F.concat(F.lit("00"), key)).when(kind == 2, key)
    headed = spark.createDataFrame([("", "track"), ("", "listens"), ("track_id", "")], "k string, v string")
    # the header lines stand in the body files too
    headed.unionByName(table(spark, folder, "orders").select(named.alias("k"), F.col("o_custkey").cast("string").alias("v"))).write.csv(f"{base}/body")
    return SRC.read_tracks(spark, f"{base}/body", header_path=header)


@query("""
SELECT o_orderkey::VARCHAR AS track_id, ROUND(o_totalprice, 2) AS track_listens,
  CASE WHEN o_orderstatus <> 'O' THEN 1.5::DOUBLE END AS tonnetz_std_01 FROM orders WHERE o_orderkey % 3 > 0""")  # the others have text keys in one of the files
def scan_and_join(spark, folder):
    tracks, tracks_options = _written_tracks(spark, folder)
    feats, feats_options = _written_features(spark, folder)
    return SRC.read_tracks_and_features(
        spark, tracks, feats, ["listens"], ["tonnetz"], tracks_options=tracks_options, features_options=feats_options
    )


@query("""
SELECT 'tracks' AS part, COUNT(*) AS n_rows, COUNT(*) FILTER (o_orderpriority <> '5-LOW') AS n_known, MIN(STRFTIME(o_orderdate, '%Y-%m-%d')) AS least FROM orders
UNION ALL SELECT 'features', COUNT(*), COUNT(*) FILTER (o_orderstatus <> 'F'), MIN(o_custkey) FILTER (o_orderstatus <> 'F')::BIGINT::VARCHAR FROM orders""")
def scan_three_header_rows(spark, folder):
    tracks, tracks_options = _written_tracks(spark, folder)
    feats, feats_options = _written_features(spark, folder)
    df, numbers = SRC.read_datasets(
        spark, tracks, feats, SRC.HeaderLayout(3, (0, 1, 2)), tracks_options, feats_options
    )
    genre = next(c for c in df.columns if "genre_top" in c)
    day = next(c for c in df.columns if "date_created" in c)
    second = next(c for c in numbers.columns if c.endswith("mean_02"))
    half = df.agg(F.lit("tracks").alias("part"), F.count("*").alias("n_rows"), F.count(genre).alias("n_known"), F.min(day).cast("string").alias("least"))
    other = numbers.agg(
        F.lit("features").alias("part"), F.count("*").alias("n_rows"), F.count(second).alias("n_known"), F.min(second).cast("bigint").cast("string").alias("least")
    )
    return half.unionByName(other)


@query("SELECT l_quantity AS _c0, l_discount AS _c1, l_returnflag AS _c2, l_returnflag = 'R' AS returned FROM lineitem")
def scan_headerless(spark, folder):
    path = shared_folder(spark, "plain")
    table(spark, folder, "lineitem").select("l_quantity", "l_discount", "l_returnflag").write.csv(path)
    return SRC.boolean_label(SRC.read_headerless(spark, path, 3), "_c2", "R", "returned")


# --- reductions ----------------------------------------------------------------------------


def vectors(spark, folder) -> DataFrame:
    v = F.transform("embedding", lambda x: x.cast("double"))
    return table(spark, folder, "embeddings").select("vec_id", array_to_vector(v).alias("features"), "label")


def held_vectors(spark, folder):
    df = X.holdout(vectors(spark, folder), "vec_id", 0.2, SEED)
    df = df.withColumn("label", F.col("label").cast("double"))
    return df.where("split = 'train'").drop("split"), df.where("split = 'test'").drop("split")


@query("""
WITH e AS (SELECT label, UNNEST(embedding) AS x, UNNEST(range(len(embedding))) AS i FROM embeddings)
SELECT label, i::INT AS i, COUNT(*) AS n, ROUND(AVG(x::DOUBLE), 6) AS mean FROM e GROUP BY 1, 2""")
def class_means(spark, folder):
    means = D.class_means(vectors(spark, folder), "label")
    long = means.select("label", "n", F.posexplode(vector_to_array("mean")).alias("i", "mean"))
    return rounded(long.select("label", "i", "n", "mean"))


@query("""
WITH x AS (SELECT l_quantity AS x0, l_extendedprice AS x1, l_discount AS x2, l_tax AS x3 FROM lineitem)
SELECT 0 AS i, 0 AS j, ROUND(COVAR_SAMP(x0, x0), 4) AS covariance FROM x UNION ALL SELECT 0, 1, ROUND(COVAR_SAMP(x0, x1), 4) FROM x
UNION ALL SELECT 0, 2, ROUND(COVAR_SAMP(x0, x2), 4) FROM x UNION ALL SELECT 0, 3, ROUND(COVAR_SAMP(x0, x3), 4) FROM x
UNION ALL SELECT 1, 1, ROUND(COVAR_SAMP(x1, x1), 4) FROM x UNION ALL SELECT 1, 2, ROUND(COVAR_SAMP(x1, x2), 4) FROM x
UNION ALL SELECT 1, 3, ROUND(COVAR_SAMP(x1, x3), 4) FROM x UNION ALL SELECT 2, 2, ROUND(COVAR_SAMP(x2, x2), 4) FROM x
UNION ALL SELECT 2, 3, ROUND(COVAR_SAMP(x2, x3), 4) FROM x UNION ALL SELECT 3, 3, ROUND(COVAR_SAMP(x3, x3), 4) FROM x""")
def covariance_entries(spark, folder):
    df = features(spark, folder)
    assembled = VectorAssembler(inputCols=df.columns, outputCol="features").transform(df)
    return rounded(D.covariance_entries(assembled), 4)


TWO_FEATURES = """
x AS (SELECT o_orderkey, o_orderstatus, (o_totalprice / 1000) AS a, (o_totalprice / 2000 + o_custkey / 10) AS b FROM orders),
m AS (SELECT AVG(a) AS ma, AVG(b) AS mb, COVAR_SAMP(a, a) AS saa, COVAR_SAMP(a, b) AS sab, COVAR_SAMP(b, b) AS sbb FROM x),
l AS (SELECT *, (saa + sbb) / 2 + SQRT(POW((saa - sbb) / 2, 2) + sab * sab) AS l1, (saa + sbb) / 2 - SQRT(POW((saa - sbb) / 2, 2) + sab * sab) AS l2 FROM m)"""


def two_features(spark, folder):
    price = F.col("o_totalprice")
    df = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", (price / 1000).alias("a"), (price / 2000 + F.col("o_custkey") / 10).alias("b")
    )
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


@query(f"""
WITH {TWO_FEATURES}, v AS (SELECT *, sab AS vx, l1 - saa AS vy, SQRT(sab * sab + (l1 - saa) * (l1 - saa)) AS nv FROM l),
d AS (SELECT *, CASE WHEN ABS(vx) >= ABS(vy) THEN SIGN(vx) ELSE SIGN(vy) END AS s FROM v)
SELECT o_orderkey, ROUND(s * ((a - ma) * vx + (b - mb) * vy) / nv, 4) AS pc1, o_orderstatus AS label FROM x, d""")
def pca_scores(spark, folder):
    df = two_features(spark, folder)
    scored = D.PrincipalComponents(k=1).fit(df).transform(df)
    pc1 = vector_to_array("scores")[0]
    return scored.select("o_orderkey", F.round(pc1, 4).alias("pc1"), F.col("o_orderstatus").alias("label"))


@query(f"""
WITH {TWO_FEATURES} SELECT 1 AS component, ROUND(l1 / (l1 + l2), 6) AS share, ROUND(l1 / (l1 + l2), 6) AS cumulative FROM l
UNION ALL SELECT 2, ROUND(l2 / (l1 + l2), 6), 1.0 FROM l""")
def explained_variance(spark, folder):
    return rounded(D.explained_variance(two_features(spark, folder)))


@query(f"""
WITH {TWO_FEATURES} SELECT 1 AS component, ROUND(l1 / (l1 + l2), 6) AS share, ROUND(l1 / (l1 + l2), 6) AS cumulative FROM l
UNION ALL SELECT 2, ROUND(l2 / (l1 + l2), 6), 1.0 FROM l""")
def wide_variance(spark, folder):
    df = two_features(spark, folder)
    return rounded(WidePrincipalComponents(k=2).fit(df).variance(df))


@query("""
WITH e AS (SELECT vec_id, UNNEST(embedding)::DOUBLE AS x, UNNEST(range(len(embedding))) AS i FROM embeddings),
c AS (SELECT a.i, b.i AS j, COVAR_SAMP(a.x, b.x) AS v FROM e a JOIN e b USING (vec_id) GROUP BY 1, 2)
SELECT COUNT(*) FILTER (i = j)::INT AS components, ROUND(SUM(v * v) / POW(SUM(v) FILTER (i = j), 2), 8) AS squares FROM c""")
def wide_spectrum(spark, folder):
    """All shares of variance of the vectors: their number and the sum of their squares, which equals that of the covariances."""
    shares = WidePrincipalComponents(variance_ratio=1.0).fit(vectors(spark, folder)).shares
    return spark.createDataFrame([(len(shares), round(float(shares @ shares), 8))], "components int, squares double")


@query()
def wide_scores(spark, folder):
    """Scores of all vectors on their ten leading components."""
    df = vectors(spark, folder)
    scored = WidePrincipalComponents(k=10).fit(df).transform(df)
    return scored.select("vec_id", F.posexplode(vector_to_array("scores")).alias("component", "score"))


@query()
def pca_variance_ratio(spark, folder):
    """Scores of all vectors on the fewest components that explain 70 % of the variance."""
    df = vectors(spark, folder)
    scored = D.PrincipalComponents(variance_ratio=0.7).fit(df).transform(df)
    return scored.select("vec_id", F.posexplode(vector_to_array("scores")).alias("component", "score"))


@query()
def pca_new_data(spark, folder):
    """Components fitted on training rows, scaled with training parameters, applied to test rows."""
    approach = A.Approach("pca", reduction="pca", reduction_settings={"k": 2})
    df = X.holdout(features(spark, folder, "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 0.2, SEED)
    _, test, _ = A.prepare(
        df.where("split = 'train'"), df.where("split = 'test'"), [c for c in df.columns if "mean" in c], "split", approach
    )
    return test.select("l_orderkey", "l_linenumber", vector_to_array("features").alias("scores"))


@query(f"""
WITH {TWO_FEATURES.split('m AS')[0].rstrip().rstrip(',')}, y AS (SELECT *, (o_orderstatus = 'F') AS y FROM x),
g AS (SELECT y, COUNT(*) AS n, AVG(a) AS ma, AVG(b) AS mb, VAR_POP(a) * COUNT(*) AS waa, VAR_POP(b) * COUNT(*) AS wbb,
  COVAR_POP(a, b) * COUNT(*) AS wab FROM y GROUP BY 1),
w AS (SELECT SUM(n) AS n, SUM(waa) / (SUM(n) - 2) AS waa, SUM(wbb) / (SUM(n) - 2) AS wbb, SUM(wab) / (SUM(n) - 2) AS wab,
  SUM(n * ma) / SUM(n) AS ca, SUM(n * mb) / SUM(n) AS cb,
  MAX(ma) FILTER (y) - MAX(ma) FILTER (NOT y) AS da, MAX(mb) FILTER (y) - MAX(mb) FILTER (NOT y) AS db FROM g),
d AS (SELECT *, (wbb * da - wab * db) / (waa * wbb - wab * wab) AS u, (waa * db - wab * da) / (waa * wbb - wab * wab) AS v FROM w),
s AS (SELECT *, SQRT(waa * u * u + 2 * wab * u * v + wbb * v * v) * CASE WHEN ABS(u) >= ABS(v) THEN SIGN(u) ELSE SIGN(v) END AS z FROM d)
SELECT o_orderkey, ROUND(((a - ca) * u + (b - cb) * v) / z, 3) AS score FROM y, s""")
def discriminant_two_classes(spark, folder):
    df = two_features(spark, folder).withColumn("label", (F.col("o_orderstatus") == "F").cast("int"))
    scored = D.LinearDiscriminants(ridge=0.0).fit(df).transform(df)
    return scored.select("o_orderkey", F.round(vector_to_array("scores")[0], 3).alias("score"))


@query()
def discriminant_scores(spark, folder):
    train, test = held_vectors(spark, folder)
    scored = D.LinearDiscriminants(out_dim=2).fit(train).transform(test)
    return D.points_by_class(scored, "scores", "label")


@query()
def kmeans_sizes(spark, folder):
    df = features(spark, folder, F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row"))
    scaled = ZScore.fit(df, df.columns[1:], 1e-10).transform(df)
    assembled = VectorAssembler(inputCols=df.columns[1:], outputCol="features").transform(scaled)
    return D.kmeans_report(assembled, "row", k=8, max_iter=200, seed=SEED, project=False)["sizes"]


@query()
def kmeans_points(spark, folder):
    return D.kmeans_report(vectors(spark, folder), "vec_id", k=8, seed=SEED)["points"]


# --- models --------------------------------------------------------------------------------

LETTERS = "aeioukwyzqhñéäçß"


def documents_by_language(spark, folder) -> tuple[DataFrame, DataFrame, list[str]]:
    """Letter shares of the whole text as features and the language as class, held out 80/20."""
    text, size = F.lower("text"), F.greatest(F.length("text"), F.lit(1))
    shares = [((size - F.length(F.replace(text, F.lit(c)))) / size).cast("double") for c in LETTERS]
    df = table(spark, folder, "documents").select("doc_id", F.col("lang").alias("label"), F.array(*shares).alias("_x"))
    return _held_documents(df)


def documents_by_quality(spark, folder) -> tuple[DataFrame, DataFrame, list[str]]:
    """Size and shape of the whole text as features and the quality label as class."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    words = F.split(F.trim("text"), r"\s+")
    size = F.greatest(F.length("text"), F.lit(1))
    x = [
        F.log1p("n_chars"),
        F.log1p(F.size(words)),
        F.size(F.array_distinct(words)) / F.size(words),
        F.regexp_count("text", F.lit("[A-Z]")) / size,
        F.regexp_count("text", F.lit("[0-9]")) / size,
        F.regexp_count("text", F.lit(r"[^\w\s]")) / size,
        F.size(F.array_distinct(F.split("text", "\n"))) / F.size(F.split("text", "\n")),
    ]
    return _held_documents(docs.select("doc_id", F.col("quality").cast("string").alias("label"), F.array(*[c.cast("double") for c in x]).alias("_x")))


def _held_documents(df):
    df = X.holdout(keep(df.withColumn("features", array_to_vector("_x")).drop("_x")), "doc_id", 0.2, SEED)
    classes = [r[0] for r in df.select("label").distinct().orderBy("label").collect()]
    df = V.with_class_index(df, "label", classes, "y")
    return df.where("split = 'train'").drop("split"), df.where("split = 'test'").drop("split"), classes


def predicted(train, test, classes, name, settings):
    model = get_model(name, settings, Columns(len(classes), "doc_id", "features", "y", SEED)).fit(train)
    scored = model.transform(test)
    return scored.select("doc_id", "label", V.class_name(F.col("prediction"), classes).alias("prediction"))


def model_query(name: str, data, model: str, settings: dict):
    def run(spark, folder):
        return predicted(*data(spark, folder), model, settings)

    run.__name__ = name
    return query()(run)


model_query("svm_linear", documents_by_language, "SVC", {"kernel": "linear", "cost": 10.0})
model_query("svm_rbf", documents_by_quality, "SVC", {"kernel": "rbf", "gamma": 0.1})
model_query("svm_sigmoid", documents_by_quality, "SVC", {"kernel": "sigmoid", "gamma": 0.02, "coef0": 0.1})
model_query("svm_poly", documents_by_quality, "SVC", {"kernel": "poly", "gamma": 0.1, "coef0": 1.0})
model_query("svm_exact", documents_by_quality, "SVC", {"exact": True, "kernel": "rbf", "gamma": 0.1})
model_query("svm_probabilistic", documents_by_quality, "SVCProbabilistic", {"kernel": "linear"})
model_query("decision_tree", documents_by_language, "DecisionTreeClassifier", {"max_depth": 7, "min_samples_leaf": 20})
model_query("random_forest", documents_by_language, "RandomForestClassifier", {"n_trees": 20, "max_depth": 10})
model_query("adaboost", documents_by_language, "AdaBoostClassifier", {"n_estimators": 10})
model_query("gradient_boosting", documents_by_quality, "CatBoostClassifier", {"iterations": 10, "depth": 4})
model_query("gradient_boosting_multiclass", documents_by_language, "CatBoostClassifier", {"iterations": 4, "depth": 3})
model_query("logistic_regression", documents_by_language, "LogisticClassifier", {})
model_query("neural_network", documents_by_language, "ANN", {"topology": [16], "max_epochs": 60})
model_query(
    "neural_network_early_stopping", documents_by_language, "ANN",
    {"topology": [16, 8], "max_epochs": 60, "validation_ratio": 0.2, "patience": 20},
)


@query()
def neural_network_losses(spark, folder):
    """Loss curves on training, validation and test rows."""
    train, test, classes = documents_by_language(spark, folder)
    split = X.holdout(train, "doc_id", 0.25, SEED + 1)
    network = get_model(
        "ANN", {"topology": [16], "max_epochs": 40, "patience": 20}, Columns(len(classes), "doc_id", "features", "y", SEED)
    )
    fitted = network.fit_with_validation(split.where("split = 'train'"), split.where("split = 'test'"), test)
    return fitted.losses(train)


@query()
def tree_regressor(spark, folder):
    df = held_orders(spark, folder, "o_custkey", F.year("o_orderdate").alias("year"), "o_totalprice")
    df = VectorAssembler(inputCols=["o_custkey", "year"], outputCol="features").transform(df)
    model = get_model("DecisionTreeRegressor", {"max_depth": 5}, Columns(0, "o_orderkey", "features", "o_totalprice", SEED))
    scored = model.fit(df.where("split = 'train'")).transform(df.where("split = 'test'"))
    return scored.select("o_orderkey", "o_totalprice", "prediction")


NEIGHBOURS = f"""
k AS (SELECT *, ROW_NUMBER() OVER (ORDER BY md5('{SEED}:' || vec_id::VARCHAR)) AS r, COUNT(*) OVER () AS c FROM embeddings),
h AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, r <= ROUND_EVEN(c * 0.2::DOUBLE, 0) AS test FROM k),
d AS (SELECT a.vec_id, a.label, b.vec_id AS neighbour, b.label AS neighbour_label, ROUND(list_distance(a.e, b.e), 9) AS distance
  FROM h a, h b WHERE a.test AND NOT b.test),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS rank FROM d)"""


def _knn(spark, folder):
    train, test = held_vectors(spark, folder)
    model = get_model("KNN", {"n_neighbors": 7}, Columns(10, "vec_id", "features", "label", SEED)).fit(train)
    return model, test


@query(f"""
WITH {NEIGHBOURS} SELECT vec_id, rank::INT AS rank, ROUND(distance, 6) AS distance, neighbour, neighbour_label::DOUBLE AS neighbour_label
FROM n WHERE rank <= 7""")
def knn_neighbours(spark, folder):
    model, test = _knn(spark, folder)
    return rounded(model.neighbours(test))


@query(f"""
WITH {NEIGHBOURS}, v AS (SELECT vec_id, label, neighbour_label AS p, COUNT(*) AS c FROM n WHERE rank <= 7 GROUP BY 1, 2, 3)
SELECT vec_id, label::DOUBLE AS label, FIRST(p ORDER BY c DESC, p)::DOUBLE AS prediction FROM v GROUP BY 1, 2""")
def knn_predict(spark, folder):
    model, test = _knn(spark, folder)
    return model.transform(test).select("vec_id", "label", "prediction")


@query(f"""
WITH {NEIGHBOURS} SELECT vec_id, rank::INT AS rank, ROUND(distance, 6) AS distance, neighbour, neighbour_label::DOUBLE AS neighbour_label
FROM n WHERE rank <= 7""")
def knn_exact(spark, folder):
    """The exact way, with several cells."""
    train, test = held_vectors(spark, folder)
    settings = {"n_neighbors": 7, "exact": True, "pivots": 8}
    return rounded(get_model("KNN", settings, Columns(10, "vec_id", "features", "label", SEED)).fit(train).neighbours(test))


# --- selection -----------------------------------------------------------------------------

RULES = """
f AS (SELECT event_type IN ('purchase', 'view') AS y, value, user_id % 100 AS u, NTILE(3) OVER (ORDER BY md5('7:' || event_id::VARCHAR)) AS fold FROM events),
p AS (SELECT 'value' AS family, i AS config_index, y, fold, value > t AS p FROM f, (VALUES (0, 10), (1, 30), (2, 50)) AS v(i, t)
  UNION ALL SELECT 'user', i, y, fold, u > t FROM f, (VALUES (3, 20), (4, 40), (5, 60)) AS v(i, t)),
m AS (SELECT family, config_index, fold, COUNT(*) FILTER (p AND y) AS tp, COUNT(*) FILTER (p AND NOT y) AS fp,
  COUNT(*) FILTER (NOT p AND y) AS fn, COUNT(*) FILTER (NOT p AND NOT y) AS tn FROM p GROUP BY 1, 2, 3),
r AS (SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy, COALESCE(tp / NULLIF(tp + fp, 0), 0) AS precision,
  COALESCE(tp / NULLIF(tp + fn, 0), 0) AS recall FROM m),
q AS (SELECT family, config_index, AVG(accuracy) AS accuracy, STDDEV_SAMP(accuracy) AS accuracy_std, AVG(recall) AS recall,
  AVG(COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0)) AS f1, SUM(tp)::BIGINT AS tp, SUM(fn)::BIGINT AS fn FROM r GROUP BY 1, 2)"""


def rule_report(spark, folder) -> DataFrame:
    """Cross-validation report of six threshold rules in two families."""
    df = X.kfold(table(spark, folder, "events"), "event_id", 3, SEED)
    y = F.col("event_type").isin("purchase", "view")
    rules = [("value", F.col("value"), i, t) for i, t in enumerate((10, 30, 50))]
    rules += [("user", F.col("user_id") % 100, i + 3, t) for i, t in enumerate((20, 40, 60))]
    items = F.array(
        *[
            F.struct(
                F.lit(family).alias("family"),
                F.lit(i).alias("config_index"),
                F.lit(json.dumps({"above": t})).alias("config"),
                (v > t).alias("p"),
            )
            for family, v, i, t in rules
        ]
    )
    long = df.select(y.alias("y"), "fold", F.lit(0).alias("execution"), F.explode(items).alias("_r"))
    long = long.select("y", "fold", "execution", "_r.*")
    counts = confusion_counts(long, "y", "p", ["family", "config_index", "config", "fold", "execution"])
    return V.cross_validation_report(counts, ["false", "true"], positive="true").withColumn("approach", F.lit("rules"))


@query(f"""
WITH {RULES} SELECT family, config_index, ROUND(accuracy, 6) AS accuracy_mean, ROUND(accuracy_std, 6) AS accuracy_std,
  ROUND(f1, 6) AS f1_mean, tp::DOUBLE AS tp, fn::DOUBLE AS fn FROM q""")
def cross_validation_summary(spark, folder):
    cm = F.col("cm")
    return rounded(
        rule_report(spark, folder).select(
            "family", "config_index", "accuracy_mean", "accuracy_std", "f1_mean",
            cm[1][1].cast("double").alias("tp"), cm[1][0].cast("double").alias("fn"),
        )
    )


@query(f"""
WITH {RULES}, b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY family ORDER BY f1 DESC, config_index) AS k FROM q)
SELECT family, config_index, ROUND(f1, 6) AS f1_mean FROM b WHERE k = 1""")
def best_config(spark, folder):
    return rounded(V.best_configs(rule_report(spark, folder)).select("family", "config_index", "f1_mean"))


@query(f"""
WITH {RULES}, b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY family ORDER BY f1 DESC, config_index) AS k FROM q)
SELECT family, ROUND(f1, 6) AS f1_mean FROM b WHERE k = 1 AND family IN ('user', 'value') ORDER BY f1 DESC""")
def stack_candidates(spark, folder):
    best = V.best_configs(rule_report(spark, folder))
    return rounded(V.stack_candidates(best, ("user", "value")).select("family", "f1_mean"))


@query(f"WITH {RULES} SELECT family AS model, ROUND(MAX(accuracy), 6) AS accuracy FROM q GROUP BY 1")
def best_accuracy_per_model(spark, folder):
    return rounded(RP.best_accuracy(A.results_table(rule_report(spark, folder))))


@query(f"""
WITH {RULES}, b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY family ORDER BY accuracy DESC, config_index) AS k FROM q)
SELECT family AS model, 'accuracy' AS metric, ROUND(accuracy, 6) AS value FROM b WHERE k = 1
UNION ALL SELECT family, 'f1', ROUND(f1, 6) FROM b WHERE k = 1""")
def best_per_model_long(spark, folder):
    return rounded(RP.grouped_comparison(A.results_table(rule_report(spark, folder))))


@query(f"WITH {RULES} SELECT family AS model, ROUND(recall, 6) AS recall, ROUND(accuracy, 6) AS accuracy FROM q")
def tradeoff_points(spark, folder):
    return rounded(RP.trade_off(A.results_table(rule_report(spark, folder))))


@query(f"WITH {RULES} SELECT 'rules' AS approach, family AS model, ROUND(accuracy, 6) AS accuracy, ROUND(f1, 6) AS f1 FROM q")
def results_sink(spark, folder):
    """Results written as CSV, matrix as text, and read back."""
    path = shared_folder(spark, "results")
    SRC.write_results(A.results_table(rule_report(spark, folder)), path)
    schema = (
        "approach string, model string, config string, accuracy double, error_rate double, precision double, "
        "recall double, npv double, specificity double, f1 double, cm string"
    )
    return rounded(SRC.read_results(spark, path, schema).select("approach", "model", "accuracy", "f1"))


def _folded(data, k=2):
    def make(spark, folder):
        train, _, classes = data(spark, folder)
        return X.stratified_kfold(train, "doc_id", "label", k, SEED + 2), classes, Columns(len(classes), "doc_id", "features", "y", SEED)

    return make


@query()
def cv_grid(spark, folder):
    """Two families, two settings and one, over stratified folds."""
    df, classes, columns = _folded(documents_by_language, 3)(spark, folder)
    configs = [
        ("DT", {"max_depth": 7, "min_samples_leaf": 20}),
        ("DT", {"max_depth": 10, "min_samples_leaf": 20}),
        ("KNN", {"n_neighbors": 7}),
    ]
    return V.cross_validate(df, configs, columns, classes, parallelism=4)


@query()
def cv_network(spark, folder):
    """A network with a validation part, two executions per fold."""
    df, classes, columns = _folded(documents_by_language)(spark, folder)
    settings = {"topology": [8], "max_epochs": 30, "validation_ratio": 0.2, "executions": 2}
    return V.cross_validate(df, [("ANN", settings)], columns, classes, parallelism=4)


@query()
def grid_tuning(spark, folder):
    train, _, classes = documents_by_language(spark, folder)
    return V.tune(train, "DT", {}, Columns(len(classes), "doc_id", "features", "y", SEED), parallelism=4)[1]


@query()
def bagging(spark, folder):
    train, test, classes = documents_by_language(spark, folder)
    columns = Columns(len(classes), "doc_id", "features", "y", SEED)
    model = V.Bagging("DT", {"max_depth": 5}, columns, sizes=(2, 4, 6), parallelism=4).fit(train)
    return model.transform(test).select("doc_id", "label", V.class_name(F.col("prediction"), classes).alias("prediction"))


@query()
def stacking(spark, folder):
    train, test, classes = documents_by_language(spark, folder)
    columns = Columns(len(classes), "doc_id", "features", "y", SEED)
    bases = [("DT", {"max_depth": 7, "min_samples_leaf": 20}), ("KNN", {"n_neighbors": 7})]
    model = V.Stacking(bases, columns, parallelism=2).fit(train)
    return model.transform(test).select("doc_id", "label", V.class_name(F.col("prediction"), classes).alias("prediction"))


@query()
def bagging_cv(spark, folder):
    """A bagged tree per fold, its size tuned inside the fold."""
    df, classes, columns = _folded(documents_by_language)(spark, folder)
    return V.cross_validate_ensemble(
        df, "Bagging", lambda c: V.Bagging("DT", {"max_depth": 5}, c, sizes=(2, 4)), columns, classes
    )


@query()
def stacking_cv(spark, folder):
    """A stack per fold."""
    df, classes, columns = _folded(documents_by_language)(spark, folder)
    bases = [("DT", {"max_depth": 7, "min_samples_leaf": 20}), ("KNN", {"n_neighbors": 7})]
    return V.cross_validate_ensemble(df, "Stack", lambda c: V.Stacking(bases, c), columns, classes)


def _experiment(spark, folder, classes=3):
    """Line items joined to their parts, labelled by price quantiles of the training rows."""
    lines = table(spark, folder, "lineitem").withColumn(
        "row", F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"))
    )
    joined = lines.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        "row", "l_quantity", "l_discount", "l_tax", F.col("p_size").cast("double").alias("p_size"), "p_retailprice", "l_extendedprice"
    )
    inputs = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
    return A.labelled_split(joined, "row", "l_extendedprice", 0.2, classes, SEED), inputs


@query()
def flagship(spark, folder):
    """Join, hold-out, labels from training quantiles, z-score, tree, weighted metrics on the test part."""
    (train, test), inputs = _experiment(spark, folder)
    classes = ["High", "Low", "Medium"]
    train, test, _ = A.prepare(train, test, inputs, "label", A.APPROACHES["reduced"])
    train, test = (V.with_class_index(d, "label", classes, "y") for d in (train, test))
    train = train.select("features", "y")  # the fit counts, cuts and deals these rows; dealt before, each of that would deal anew
    tree = get_model("DT", {"max_depth": 7, "min_samples_leaf": 20}, Columns(3, "row", "features", "y", SEED))
    scored = tree.fit(train).transform(test)
    return multiclass_metrics(scored, "label", V.class_name(F.col("prediction"), classes))


@query()
def approach_run(spark, folder):
    """The three-class experiment on a small grid: cross-validation, best settings, test metrics."""
    (train, test), inputs = _experiment(spark, folder)
    grids = {"DT": ({"max_depth": 7, "min_samples_leaf": 20}, {"max_depth": 3, "min_samples_leaf": 20}), "RF": ({"n_trees": 5, "max_depth": 5},)}
    return A.run_approach(train, test, "row", inputs, "label", A.APPROACHES["reduced"], grids, SEED, 4).test


@query()
def approach_lda(spark, folder):
    """The discriminant experiment on a small grid."""
    (train, test), inputs = _experiment(spark, folder)
    grids = {"DT": ({"max_depth": 7, "min_samples_leaf": 20},)}
    return A.run_approach(train, test, "row", inputs, "label", A.APPROACHES["lda"], grids, SEED, 4).test


@query()
def approach_pca(spark, folder):
    """The two-class component experiment on a small grid."""
    (train, test), inputs = _experiment(spark, folder, 2)
    grids = {"DT": ({"max_depth": 7, "min_samples_leaf": 20},), "SVM": ({"kernel": "linear", "cost": 0.1},)}
    return A.run_approach(train, test, "row", inputs, "label", A.APPROACHES["binary_pca"], grids, SEED, 4).test
