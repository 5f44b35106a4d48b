"""Queries over the given tables, each with the SQL that must give the same rows.

``QUERIES[name]`` is a function (spark, folder) -> DataFrame and ``ORACLES[name]`` the SQL.
Doubles are rounded in both to six digits, since engines add them up in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.functions import expressions as E
from tabloom.operators import columns as C
from tabloom.operators import labels as L
from tabloom.operators import metrics as M
from tabloom.operators import popularity as P
from tabloom.operators import profile as R
from tabloom.operators import scaling as S
from tabloom.operators import splits as X
from tabloom.operators.joins import join_on_key

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SEED = 7


def query(sql: str | None = None):
    """Register a function under its own name, with its SQL when there is one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


def events_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Events whose value is null for errors and NaN for signups, and whose type is null for errors."""
    kind = F.col("event_type")
    value = F.when(kind == "error", F.lit(None)).when(kind == "signup", F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, folder, "events").select(
        "event_id", "user_id", F.when(kind != "error", kind).alias("event_type"), value.cast("double").alias("value")
    )


GAPS = """
gaps AS (SELECT event_id, user_id, nullif(event_type, 'error') AS event_type,
  CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value END AS value FROM events)"""


# --- joins, projections, slices ------------------------------------------------------------


@query("""
SELECT CAST(l_partkey AS VARCHAR) AS part_id, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
  l_discount, l_tax, p_size, p_retailprice
FROM lineitem JOIN part ON CAST(l_partkey AS VARCHAR) = CAST(p_partkey AS VARCHAR)""")
def key_join_numeric(spark, folder):
    return join_on_key(
        table(spark, folder, "lineitem"),
        table(spark, folder, "part"),
        "l_partkey",
        "p_partkey",
        "part_id",
        ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
        ["p_size", "p_retailprice"],
    )


@query("""
SELECT CAST(d.doc_id AS VARCHAR) AS track_id, lang, n_chars, quality, toxic
FROM documents d JOIN labels l ON CAST(d.doc_id AS VARCHAR) = CAST(l.doc_id AS VARCHAR)""")
def key_join_text(spark, folder):
    return join_on_key(
        table(spark, folder, "documents").withColumn("doc_id", F.col("doc_id").cast("string")),
        table(spark, folder, "labels"),
        "doc_id",
        left_columns=["lang", "n_chars"],
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def ordered_slice(spark, folder):
    return X.ordered_slice(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 1000)


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount FROM lineitem")
def columns_by_pattern(spark, folder):
    return C.select_by_pattern(table(spark, folder, "lineitem"), "PRICE", "discount", "linenumber", "orderkey")


@query("SELECT MIN(l_discount) AS low, MAX(l_discount) AS high, COUNT(*) AS n FROM lineitem")
def first_column_by_pattern(spark, folder):
    df = table(spark, folder, "lineitem")
    c = C.find_column(df, "DISC")
    return df.agg(F.min(c).alias("low"), F.max(c).alias("high"), F.count("*").alias("n"))


@query("SELECT p_size, p_retailprice FROM part")
def numeric_projection(spark, folder):
    return C.numeric_features(table(spark, folder, "part"), exclude=["p_partkey", "p_name", "p_brand", "p_type"])


@query(f"WITH {GAPS} SELECT event_id, value FROM gaps WHERE value IS NOT NULL")
def valid_values(spark, folder):
    return C.valid_values(events_with_gaps(spark, folder), "value", ["event_id"])


@query(f"WITH {GAPS} SELECT event_id, event_type FROM gaps WHERE event_type IS NOT NULL")
def valid_categories(spark, folder):
    return C.valid_categories(events_with_gaps(spark, folder), "event_type", ["event_id"])


@query("SELECT p_partkey::DOUBLE AS p_partkey, p_name, p_size::DOUBLE AS p_size, p_retailprice FROM part")
def integers_to_double(spark, folder):
    return C.integers_to_double(table(spark, folder, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"))


@query("SELECT l_orderkey, l_linenumber, l_returnflag = 'R' AS returned FROM lineitem")
def boolean_label(spark, folder):
    from tabloom.sources.delimited import boolean_label as labelled

    df = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return labelled(df, "l_returnflag", "R", "returned").drop("l_returnflag")


# --- profiling -----------------------------------------------------------------------------


@query(f"""
WITH {GAPS}, c AS (SELECT COUNT(*) AS n_rows, COUNT(event_type) AS t, COUNT(value) AS v FROM gaps),
m AS (SELECT 'event_type' AS column_name, n_rows - t AS n_missing, n_rows FROM c
  UNION ALL SELECT 'value', n_rows - v, n_rows FROM c)
SELECT column_name, n_missing, ROUND(100.0::DOUBLE * n_missing / n_rows, 2) AS pct_missing, n_rows FROM m WHERE n_missing > 0""")
def quality_report(spark, folder):
    return R.quality_report(events_with_gaps(spark, folder))["missing"]


@query("SELECT COUNT(*) AS n_rows, 6 AS n_columns FROM orders")
def table_size(spark, folder):
    return R.quality_report(table(spark, folder, "orders"))["size"]


@query("SELECT MIN(o_orderdate) AS earliest, MAX(o_orderdate) AS latest, COUNT(o_orderdate) AS n_dates FROM orders")
def date_range(spark, folder):
    return R.date_range(table(spark, folder, "orders"), "o_orderdate")


@query("SELECT YEAR(o_orderdate)::INT AS year, COUNT(*) AS n FROM orders GROUP BY 1")
def yearly_counts(spark, folder):
    return R.yearly_counts(table(spark, folder, "orders"), "o_orderdate")


@query("""
WITH t AS (SELECT CASE o_orderkey % 6
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN 2 THEN strftime(o_orderdate, '%d-%m-%Y') WHEN 3 THEN strftime(o_orderdate, '%Y/%m/%d')
    WHEN 4 THEN 'not a date' END AS d FROM orders),
p AS (SELECT COALESCE(try_strptime(d, '%Y-%m-%d'), try_strptime(d, '%m/%d/%Y'), try_strptime(d, '%d-%m-%Y'),
  try_strptime(d, '%Y/%m/%d')) AS d FROM t)
SELECT YEAR(d)::INT AS year, COUNT(*) AS n FROM p WHERE d IS NOT NULL GROUP BY 1""")
def parsed_dates_yearly(spark, folder):
    day, style = F.col("o_orderdate"), F.col("o_orderkey") % 6
    text = (
        F.when(style == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(style == 1, F.date_format(day, "MM/dd/yyyy"))
        .when(style == 2, F.date_format(day, "dd-MM-yyyy"))
        .when(style == 3, F.date_format(day, "yyyy/MM/dd"))
        .when(style == 4, F.lit("not a date"))
    )
    return R.yearly_counts(table(spark, folder, "orders").select(text.alias("track_date_created")), "track_date_created")


@query("""
WITH c AS (SELECT p_brand, COUNT(*) AS n FROM part WHERE p_brand IS NOT NULL GROUP BY 1)
SELECT p_brand, n, ROUND(100.0::DOUBLE * n / (SELECT SUM(n) FROM c), 6) AS pct FROM c ORDER BY n DESC, p_brand LIMIT 15""")
def category_top15(spark, folder):
    return rounded(R.category_distribution(table(spark, folder, "part"), "p_brand"))


@query("""
SELECT COUNT(*) AS n, ROUND(AVG(d), 6) AS mean, MEDIAN(d) AS median, ROUND(STDDEV_SAMP(d), 6) AS std, MIN(d) AS min,
  MAX(d) AS max, QUANTILE_CONT(d, 0.25) AS p25, QUANTILE_CONT(d, 0.75) AS p75,
  ROUND(SUM(d) / 3600, 6) AS total_hours, ROUND(SUM(d) / 86400, 6) AS total_days
FROM (SELECT n_chars::DOUBLE AS d FROM documents WHERE n_chars > 0)""")
def duration_summary(spark, folder):
    return rounded(R.duration_summary(table(spark, folder, "documents"), "n_chars"))


def _histogram_sql(value: str, source: str) -> str:
    return f"""
WITH v AS (SELECT {value} AS v FROM {source}), s AS (SELECT MIN(v) AS lo, MAX(v) AS hi FROM v),
b AS (SELECT CASE WHEN hi > lo THEN LEAST(FLOOR((v - lo) / (hi - lo) * 50.0::DOUBLE)::INT, 49) ELSE 0 END AS bin, lo, hi FROM v, s)
SELECT bin, ROUND(lo + bin * ((hi - lo) / 50.0::DOUBLE), 6) AS low, ROUND(lo + (bin + 1) * ((hi - lo) / 50.0::DOUBLE), 6) AS high,
  COUNT(*) AS n FROM b GROUP BY bin, lo, hi"""


@query(_histogram_sql("value", "events"))
def histogram_50(spark, folder):
    return rounded(R.histogram(table(spark, folder, "events"), "value"))


@query(_histogram_sql("n_chars::DOUBLE", "documents WHERE n_chars < 800"))
def duration_histogram(spark, folder):
    return rounded(R.histogram(table(spark, folder, "documents"), "n_chars", below=800))


@query(_histogram_sql("LOG10(value + 1)", "events"))
def popularity_log_hist(spark, folder):
    return rounded(P.popularity_histogram(table(spark, folder, "events"), "value"))


FEATURE_NAMES = ("mfcc_mean_01", "mfcc_mean_02", "spectral_centroid_mean", "spectral_rolloff_mean")
FEATURE_SOURCE = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
FEATURE_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS feature, {source}::DOUBLE AS v FROM lineitem" for name, source in zip(FEATURE_NAMES, FEATURE_SOURCE)
)


def features(spark, folder, *extra):
    """Numeric line item columns under feature-like names."""
    df = table(spark, folder, "lineitem")
    return df.select(*extra, *[F.col(s).alias(n) for n, s in zip(FEATURE_NAMES, FEATURE_SOURCE)])


@query(f"""
WITH r AS ({FEATURE_ROWS}), s AS (SELECT feature, MIN(v) AS lo, MAX(v) AS hi FROM r GROUP BY 1),
b AS (SELECT r.feature, CASE WHEN hi > lo THEN LEAST(FLOOR((v - lo) / (hi - lo) * 50.0::DOUBLE)::INT, 49) ELSE 0 END AS bin, lo, hi
  FROM r JOIN s ON r.feature = s.feature)
SELECT feature, bin, ROUND(lo + bin * ((hi - lo) / 50.0::DOUBLE), 6) AS low, ROUND(lo + (bin + 1) * ((hi - lo) / 50.0::DOUBLE), 6) AS high,
  COUNT(*) AS n FROM b GROUP BY feature, bin, lo, hi""")
def feature_distributions(spark, folder):
    return rounded(R.feature_distributions(features(spark, folder)))


def _box_sql(keys: str, source: str) -> str:
    on = " AND ".join(f"r.{k.strip()} = q.{k.strip()}" for k in keys.split(","))
    named = ", ".join(f"q.{k.strip()}" for k in keys.split(","))
    return f"""
WITH r AS ({source}),
q AS (SELECT {keys}, COUNT(*) AS n, QUANTILE_CONT(v, 0.25) AS q1, QUANTILE_CONT(v, 0.5) AS median, QUANTILE_CONT(v, 0.75) AS q3
  FROM r GROUP BY {keys})
SELECT {named}, n, MIN(v) FILTER (v BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_low,
  ROUND(q1, 6) AS q1, ROUND(median, 6) AS median, ROUND(q3, 6) AS q3,
  MAX(v) FILTER (v BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS whisker_high,
  COUNT(*) FILTER (v < q1 - 1.5::DOUBLE * (q3 - q1) OR v > q3 + 1.5::DOUBLE * (q3 - q1)) AS n_outliers
FROM r JOIN q ON {on} GROUP BY {named}, n, q1, median, q3"""


@query(_box_sql("event_type, feature", "SELECT event_type, 'value' AS feature, value AS v FROM events"))
def box_by_category(spark, folder):
    return rounded(R.box_summary(table(spark, folder, "events"), ["value"], by=["event_type"]))


@query(_box_sql("feature", "SELECT 'n_chars' AS feature, n_chars::DOUBLE AS v FROM documents WHERE n_chars < 1000"))
def duration_box(spark, folder):
    return rounded(R.box_summary(table(spark, folder, "documents"), ["n_chars"], below=1000))


@query(
    _box_sql(
        "p_brand, feature",
        """WITH top AS (SELECT p_brand FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY COUNT(*) DESC, p_brand LIMIT 8),
j AS (SELECT p_brand, l_quantity, l_extendedprice FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand IN (FROM top))
SELECT p_brand, 'l_quantity' AS feature, l_quantity AS v FROM j UNION ALL SELECT p_brand, 'l_extendedprice', l_extendedprice FROM j""",
    )
)
def feature_by_category(spark, folder):
    joined = join_on_key(
        table(spark, folder, "lineitem"),
        table(spark, folder, "part"),
        "l_partkey",
        "p_partkey",
        left_columns=["l_quantity", "l_extendedprice"],
        right_columns=["p_brand"],
    )
    return rounded(R.feature_by_category(joined, "p_brand", ["l_quantity", "l_extendedprice"]))


STATISTICS = f"""
r AS ({FEATURE_ROWS}), m AS (SELECT feature, AVG(v) AS mean, STDDEV_POP(v) AS sp FROM r GROUP BY 1),
f AS (SELECT r.feature, ANY_VALUE(mean) AS mean, STDDEV_SAMP(v) AS std, MIN(v) AS min, MAX(v) AS max, MEDIAN(v) AS median,
  AVG(POW((v - mean) / sp, 3)) AS skewness, KURTOSIS_POP(v) AS kurtosis FROM r JOIN m ON r.feature = m.feature GROUP BY 1)"""


@query(f"""
WITH {STATISTICS} SELECT feature, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std, min, max, ROUND(median, 6) AS median,
  ROUND(skewness, 6) AS skewness, ROUND(kurtosis, 6) AS kurtosis FROM f""")
def feature_stats(spark, folder):
    return rounded(R.feature_statistics(features(spark, folder), FEATURE_NAMES))


@query(f"""
WITH {STATISTICS}, g AS (SELECT CASE WHEN feature LIKE 'mfcc%' THEN 'mfcc' ELSE 'spectral' END AS "group", mean, std FROM f)
SELECT "group", COUNT(*) AS n_features, ROUND(MIN(mean), 6) AS mean_low, ROUND(MAX(mean), 6) AS mean_high,
  ROUND(MIN(std), 6) AS std_low, ROUND(MAX(std), 6) AS std_high FROM g GROUP BY 1""")
def feature_group_ranges(spark, folder):
    df = features(spark, folder)
    return rounded(R.group_ranges(R.group_statistics(df, C.column_groups(df))))


@query("""
WITH f AS (SELECT l_extendedprice AS price_list, CASE WHEN l_returnflag <> 'A' THEN l_extendedprice * (1 - l_discount) END AS price_net,
  l_extendedprice * (1 + l_tax) AS price_gross, l_quantity AS item_count FROM lineitem),
i AS (SELECT price_list, COALESCE(price_net, (SELECT AVG(price_net) FROM f)) AS price_net, price_gross, item_count FROM f),
p AS (SELECT 'price_list' AS feature1, 'price_net' AS feature2, CORR(price_list, price_net) AS r FROM i
  UNION ALL SELECT 'price_list', 'price_gross', CORR(price_list, price_gross) FROM i
  UNION ALL SELECT 'price_list', 'item_count', CORR(price_list, item_count) FROM i
  UNION ALL SELECT 'price_net', 'price_gross', CORR(price_net, price_gross) FROM i
  UNION ALL SELECT 'price_net', 'item_count', CORR(price_net, item_count) FROM i
  UNION ALL SELECT 'price_gross', 'item_count', CORR(price_gross, item_count) FROM i)
SELECT feature1, feature2, ROUND(r, 6) AS correlation FROM p WHERE ABS(r) > 0.7 ORDER BY ABS(r) DESC LIMIT 10""")
def correlation_pairs(spark, folder):
    price = F.col("l_extendedprice")
    df = table(spark, folder, "lineitem").select(
        price.alias("price_list"),
        F.when(F.col("l_returnflag") != "A", price * (1 - F.col("l_discount"))).alias("price_net"),
        (price * (1 + F.col("l_tax"))).alias("price_gross"),
        F.col("l_quantity").alias("item_count"),
    )
    return rounded(R.correlation_pairs(df, above=0.7))


@query("""
SELECT event_type, ROUND(AVG(value), 6) AS mean_popularity, COUNT(*) AS n FROM events
WHERE event_type IS NOT NULL AND value IS NOT NULL GROUP BY 1 HAVING COUNT(*) >= 20 ORDER BY 2 DESC, 1 LIMIT 10""")
def popularity_by_category(spark, folder):
    return rounded(P.popularity_by_category(table(spark, folder, "events"), "event_type", "value"))


@query("""
SELECT pattern, COUNT(v) AS n, ROUND(AVG(v), 6) AS mean FROM (
  SELECT 'listens' AS pattern, l_quantity AS v FROM lineitem UNION ALL SELECT 'interest', l_extendedprice FROM lineitem) GROUP BY 1""")
def popularity_metrics(spark, folder):
    df = table(spark, folder, "lineitem").select(
        F.col("l_quantity").alias("track_listens"),
        F.col("l_extendedprice").alias("track_interest"),
        F.lit(None).cast("double").alias("track_comments"),
    )
    found = P.popularity_metrics(df)
    items = F.array(*[F.struct(F.lit(p).alias("pattern"), F.col(c).alias("v")) for p, c in found.items()])
    long = df.select(F.explode(items).alias("r")).select("r.*")
    return rounded(long.groupBy("pattern").agg(F.count("v").alias("n"), F.avg("v").alias("mean")))


@query("""
WITH b AS (SELECT FLOOR(l_quantity * 12 / 60)::INT AS minute, l_extendedprice AS p, l_quantity * 12 AS d FROM lineitem
  WHERE l_quantity * 12 > 30 AND l_quantity * 12 < 600 AND l_extendedprice > 0)
SELECT minute, minute::VARCHAR || '-' || (minute + 1)::VARCHAR || 'min' AS duration_bin, ROUND(AVG(p), 6) AS mean_popularity, COUNT(*) AS n
FROM b WHERE d >= 60 AND d < 360 GROUP BY minute HAVING COUNT(*) > 10""")
def duration_bins_popularity(spark, folder):
    df = table(spark, folder, "lineitem").select(
        (F.col("l_quantity") * 12).alias("track_duration"), F.col("l_extendedprice").alias("track_listens")
    )
    return rounded(P.popularity_by_minutes(df, "track_duration", "track_listens"))


@query(f"""
WITH u AS (SELECT event_id, value * 6 AS d, value FROM events WHERE value * 6 > 30 AND value * 6 < 600 AND value > 0),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY md5('{SEED}:' || event_id::VARCHAR)) AS k FROM u)
SELECT event_id, ROUND(d, 6) AS duration, ROUND(LOG10(value + 1), 6) AS log_popularity FROM r WHERE k <= 2000""")
def duration_popularity_points(spark, folder):
    df = table(spark, folder, "events").withColumn("duration", F.col("value") * 6)
    return rounded(P.duration_popularity_points(df, "event_id", "duration", "value", seed=SEED))


# --- scaling -------------------------------------------------------------------------------


@query("""
WITH m AS (SELECT AVG(o_totalprice) AS a, STDDEV_SAMP(o_totalprice) AS s FROM orders)
SELECT o_orderkey, ROUND((o_totalprice - a) / s, 6) AS o_totalprice FROM orders, m""")
def zscore(spark, folder):
    return rounded(S.z_score(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"]))


HELD_ORDERS = f"""
k AS (SELECT *, ROW_NUMBER() OVER (ORDER BY md5('{SEED}:' || o_orderkey::VARCHAR)) AS r, COUNT(*) OVER () AS c FROM orders),
h AS (SELECT *, CASE WHEN r <= ROUND_EVEN(c * 0.2::DOUBLE, 0) THEN 'test' ELSE 'train' END AS split FROM k)"""


def held_orders(spark, folder, *columns):
    df = table(spark, folder, "orders").select("o_orderkey", *columns)
    return X.holdout(df, "o_orderkey", 0.2, SEED)


@query(f"""
WITH {HELD_ORDERS}, m AS (SELECT AVG(o_totalprice) AS a, STDDEV_SAMP(o_totalprice) AS s FROM h WHERE split = 'train')
SELECT o_orderkey, ROUND((o_totalprice - a) / s, 6) AS o_totalprice FROM h, m WHERE split = 'test'""")
def zscore_train_params(spark, folder):
    df = held_orders(spark, folder, "o_totalprice")
    scaler = S.ZScore.fit(df.where("split = 'train'"), ["o_totalprice"])
    return rounded(scaler.transform(df.where("split = 'test'")).drop("split"))


@query("""
WITH m AS (SELECT AVG(o_totalprice) AS a, STDDEV_SAMP(o_totalprice) AS s FROM orders)
SELECT o_orderkey, ROUND((o_totalprice - a) / (s + 1e-10), 6) AS o_totalprice, 0.0::DOUBLE AS one FROM orders, m""")
def zscore_epsilon(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.lit(1.0).alias("one"))
    cols = ["o_totalprice", "one"]
    return rounded(S.ZScore.fit(df, cols, epsilon=1e-10).transform(df))


@query("""
WITH m AS (SELECT MIN(o_totalprice) AS a, MAX(o_totalprice) AS b FROM orders)
SELECT o_orderkey, ROUND((o_totalprice - a) / (b - a), 6) AS o_totalprice FROM orders, m""")
def minmax(spark, folder):
    return rounded(S.min_max(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"]))


@query("SELECT o_orderkey, 0.0::DOUBLE AS five FROM orders")
def minmax_constant_column(spark, folder):
    return S.min_max(table(spark, folder, "orders").select("o_orderkey", F.lit(5.0).alias("five")), ["five"])


@query(f"""
WITH {GAPS} SELECT event_id, ROUND(COALESCE(value, (SELECT AVG(value) FROM gaps)), 6) AS value FROM gaps""")
def mean_impute(spark, folder):
    return rounded(S.impute_mean(events_with_gaps(spark, folder).select("event_id", "value"), ["value"]))


@query(f"""
WITH r AS (SELECT event_id, value, ROW_NUMBER() OVER (ORDER BY md5('{SEED}:' || event_id::VARCHAR)) AS k FROM events)
SELECT event_id, value FROM r WHERE k <= 2000""")
def hash_sample_n(spark, folder):
    return X.sample_rows(table(spark, folder, "events").select("event_id", "value"), "event_id", 2000, SEED)


@query(f"""
WITH {GAPS}, r AS (SELECT event_id, user_id::DOUBLE AS u, value, ROW_NUMBER() OVER (ORDER BY md5('{SEED}:' || event_id::VARCHAR)) AS k FROM gaps),
s AS (SELECT event_id, u, value FROM r WHERE k <= 5000), i AS (SELECT event_id, u, COALESCE(value, (SELECT AVG(value) FROM s)) AS v FROM s),
m AS (SELECT AVG(u) AS ua, STDDEV_SAMP(u) AS us, AVG(v) AS va, STDDEV_SAMP(v) AS vs FROM i)
SELECT event_id, ROUND((u - ua) / (us + 1e-10), 6) AS user_id, ROUND((v - va) / (vs + 1e-10), 6) AS value FROM i, m""")
def prepared_matrix(spark, folder):
    from pyspark.ml.functions import vector_to_array

    df = S.prepared_matrix(events_with_gaps(spark, folder), "event_id", max_rows=5000, seed=SEED)
    x = vector_to_array("features")
    return rounded(df.select("event_id", x[0].alias("user_id"), x[1].alias("value")))


@query(f"""
WITH {HELD_ORDERS}, m AS (SELECT MIN(o_totalprice) AS a, MAX(o_totalprice) AS b FROM h WHERE split = 'train')
SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, ROUND((o_totalprice - a) / (b - a), 6) AS o_totalprice, split FROM h, m""")
def prepared_train_test(spark, folder):
    train, test, _ = S.prepared_train_test(
        table(spark, folder, "orders"), "o_orderkey", ["o_totalprice"], "o_orderstatus", 0.2, SEED
    )
    return rounded(train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test"))))


# --- labels --------------------------------------------------------------------------------


@query(f"""
WITH {HELD_ORDERS}, q AS (SELECT QUANTILE_CONT(o_totalprice, 0.33) AS a, QUANTILE_CONT(o_totalprice, 0.66) AS b FROM h WHERE split = 'train')
SELECT o_orderkey, split, CASE WHEN o_totalprice <= a THEN 'Low' WHEN o_totalprice <= b THEN 'Medium' ELSE 'High' END AS label FROM h, q""")
def quantile_labels3(spark, folder):
    df = held_orders(spark, folder, "o_totalprice")
    return L.quantile_label(df, "o_totalprice", 3, df.where("split = 'train'")).drop("o_totalprice")


@query(f"""
WITH {HELD_ORDERS}, q AS (SELECT QUANTILE_CONT(o_totalprice, 0.5) AS a FROM h WHERE split = 'train')
SELECT o_orderkey, split, CASE WHEN o_totalprice <= a THEN 'Low' ELSE 'High' END AS label FROM h, q""")
def quantile_labels2(spark, folder):
    df = held_orders(spark, folder, "o_totalprice")
    return L.quantile_label(df, "o_totalprice", 2, df.where("split = 'train'")).drop("o_totalprice")


@query("""
SELECT QUANTILE_CONT(value, 0.33) AS p33, QUANTILE_CONT(value, 0.5) AS p50, QUANTILE_CONT(value, 0.66) AS p66, COUNT(value) AS n FROM events""")
def exact_quantiles(spark, folder):
    from tabloom.operators.quantiles import exact_quantiles as quantiles

    q = quantiles(table(spark, folder, "events"), "value", (0.33, 0.5, 0.66), ranked=100)
    return q.select(*[F.col("q")[i].alias(n) for i, n in enumerate(("p33", "p50", "p66"))], "n")


@query(f"""
WITH {HELD_ORDERS}, q AS (SELECT QUANTILE_CONT(o_totalprice, 0.33) AS a, QUANTILE_CONT(o_totalprice, 0.66) AS b FROM h WHERE split = 'train')
SELECT split, CASE WHEN o_totalprice <= a THEN 'Low' WHEN o_totalprice <= b THEN 'Medium' ELSE 'High' END AS label, COUNT(*) AS n
FROM h, q GROUP BY 1, 2""")
def class_distribution(spark, folder):
    return L.class_distribution(quantile_labels3(spark, folder), "label", ["split"])


@query("""
SELECT event_id, event_type = 'click' AS type_click, event_type = 'error' AS type_error, event_type = 'purchase' AS type_purchase,
  event_type = 'signup' AS type_signup, event_type = 'view' AS type_view FROM events""")
def one_hot(spark, folder):
    return L.one_hot(table(spark, folder, "events").select("event_id", "event_type"), "event_type", prefix="type").drop("event_type")


@query("SELECT doc_id, quality = 1 AS quality_1 FROM labels")
def one_hot_binary(spark, folder):
    return L.one_hot(table(spark, folder, "labels").select("doc_id", "quality"), "quality", ["0", "1"], "1").drop("quality")


SCORES = """
s AS (SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS label,
  value / 100 AS s0, (user_id % 100) / 100.0::DOUBLE AS s1, (event_id % 7) / 7.0::DOUBLE AS s2 FROM events),
c AS (SELECT *, CASE WHEN s0 >= s1 AND s0 >= s2 THEN 0 WHEN s1 >= s2 THEN 1 ELSE 2 END AS prediction FROM s)"""


def scored_events(spark, folder):
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id",
        F.when(kind == "click", 0).when(kind == "view", 1).otherwise(2).alias("label"),
        (F.col("value") / 100).alias("s0"),
        ((F.col("user_id") % 100) / F.lit(100.0)).alias("s1"),
        ((F.col("event_id") % 7) / F.lit(7.0)).alias("s2"),
    )


@query(f"WITH {SCORES} SELECT event_id, prediction FROM c")
def argmax_scores(spark, folder):
    df = scored_events(spark, folder)
    return df.select("event_id", E.score_to_class(["s0", "s1", "s2"]).alias("prediction"))


@query(f"WITH {SCORES} SELECT event_id, (s0 >= 0.3)::INT AS prediction FROM c")
def threshold_scores(spark, folder):
    return scored_events(spark, folder).select("event_id", E.score_to_class(["s0"], 0.3).alias("prediction"))


# --- splits --------------------------------------------------------------------------------


def _ranked_events(partition: str = "") -> str:
    part = f"PARTITION BY {partition} " if partition else ""
    return f"SELECT *, NTILE(5) OVER ({part}ORDER BY md5('{SEED}:' || event_id::VARCHAR)) AS fold FROM events"


@query(f"WITH {HELD_ORDERS} SELECT o_orderkey, split FROM h")
def holdout2(spark, folder):
    return held_orders(spark, folder)


@query(f"""
WITH r AS (SELECT event_id, ROW_NUMBER() OVER (ORDER BY md5('{SEED}:' || event_id::VARCHAR)) AS k, COUNT(*) OVER () AS n FROM events),
h AS (SELECT *, ROUND_EVEN(n * 0.4::DOUBLE, 0) AS held, ROUND_EVEN(ROUND_EVEN(n * 0.4::DOUBLE, 0) * 0.5::DOUBLE, 0) AS t FROM r)
SELECT event_id, CASE WHEN k <= t THEN 'test' WHEN k <= held THEN 'validation' ELSE 'train' END AS split FROM h""")
def holdout3(spark, folder):
    # a small limit makes the counting passes run here too
    return X.holdout3(table(spark, folder, "events").select("event_id"), "event_id", 0.2, 0.2, SEED, rank_limit=2000)


@query(f"SELECT event_id, fold::INT AS fold FROM ({_ranked_events()})")
def kfold(spark, folder):
    return X.kfold(table(spark, folder, "events").select("event_id"), "event_id", 5, SEED, rank_limit=2000)


@query(f"""
SELECT doc_id, quality, (NTILE(4) OVER (PARTITION BY quality ORDER BY md5('{SEED}:' || doc_id::VARCHAR)))::INT AS fold FROM labels""")
def stratified_kfold_binary(spark, folder):
    return X.stratified_kfold(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "quality", 4, SEED)


@query(f"SELECT event_id, event_type, fold::INT AS fold FROM ({_ranked_events('event_type')})")
def stratified_kfold_multi(spark, folder):
    df = table(spark, folder, "events").select("event_id", "event_type")
    return X.stratified_kfold(df, "event_id", "event_type", 5, SEED, rank_limit=500)


@query(f"""
SELECT event_id, fold::INT AS fold FROM ({_ranked_events("event_type = 'click', event_type = 'view', event_type = 'error', event_type = 'purchase', event_type = 'signup'")})""")
def stratified_kfold_one_hot(spark, folder):
    hot = one_hot(spark, folder)
    columns = [c for c in hot.columns if c != "event_id"]
    return X.stratified_kfold(hot, "event_id", columns, 5, SEED).select("event_id", "fold")


@query(f"""
WITH {HELD_ORDERS} SELECT o_orderkey::BIGINT AS o_orderkey, COUNT(DISTINCT split) AS sides, 0::BIGINT AS outside
FROM h GROUP BY 1 HAVING COUNT(DISTINCT split) > 1""")
def split_problems(spark, folder):
    return X.split_problems(held_orders(spark, folder), "o_orderkey", "split", ["train", "test"])


# --- metrics -------------------------------------------------------------------------------

RULED = """
e AS (SELECT event_id, event_type AS label, CASE WHEN value > 70 THEN 'purchase' WHEN value > 40 THEN 'view'
  WHEN value > 20 THEN 'click' ELSE 'signup' END AS prediction, value, user_id FROM events)"""

CLASS_RATES = """
k AS (SELECT label AS class FROM e UNION SELECT prediction FROM e),
t AS (SELECT COUNT(*) AS n FROM e),
c AS (SELECT class, (SELECT COUNT(*) FROM e WHERE label = class) AS support, (SELECT COUNT(*) FROM e WHERE prediction = class) AS predicted,
  (SELECT COUNT(*) FROM e WHERE label = class AND prediction = class) AS tp, n AS total FROM k, t),
x AS (SELECT class, support, predicted, tp, total, support > 0 AND predicted > 0 AS seen FROM c),
r AS (SELECT class, support, predicted, tp::BIGINT AS tp, total,
  CASE WHEN seen THEN tp / predicted ELSE 0 END AS precision, CASE WHEN seen THEN tp / support ELSE 0 END AS recall,
  CASE WHEN seen THEN CASE WHEN tp = total THEN 1 WHEN total - predicted > 0 THEN (total - support - predicted + tp) / (total - predicted) ELSE 0 END ELSE 0 END AS npv,
  CASE WHEN seen THEN CASE WHEN tp = total THEN 1 WHEN total - support > 0 THEN (total - support - predicted + tp) / (total - support) ELSE 0 END ELSE 0 END AS specificity
  FROM x),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END::DOUBLE AS f1 FROM r)"""


def _averaged(weighted: bool, digits: int = 6) -> str:
    def mean(c):
        return f"SUM({c} * support) / SUM(support)" if weighted else f"AVG({c})"

    rates = ", ".join(f"ROUND({mean(c)}, {digits}) AS {c}" for c in ("precision", "recall", "npv", "specificity", "f1"))
    return f"SELECT ROUND(SUM(tp) / SUM(support), {digits}) AS accuracy, ROUND(1 - SUM(tp) / SUM(support), {digits}) AS error_rate, {rates} FROM f"


def ruled_events(spark, folder):
    """Event type guessed from the value by fixed rules."""
    v = F.col("value")
    rule = F.when(v > 70, "purchase").when(v > 40, "view").when(v > 20, "click").otherwise("signup")
    return table(spark, folder, "events").select("event_id", F.col("event_type").alias("label"), rule.alias("prediction"), "value", "user_id")


@query(f"WITH {RULED} SELECT ROUND(AVG((label = prediction)::INT), 6) AS accuracy FROM e")
def accuracy_labels(spark, folder):
    return rounded(M.accuracy(ruled_events(spark, folder), "label", "prediction"))


@query(f"WITH {RULED} SELECT ROUND(AVG((label = prediction)::INT), 6) AS accuracy FROM e")
def accuracy_one_hot(spark, folder):
    names = ["click", "error", "purchase", "signup", "view"]
    df = L.one_hot(L.one_hot(ruled_events(spark, folder), "label", names), "prediction", names)
    return rounded(M.accuracy_one_hot(df, [f"label_{c}" for c in names], [f"prediction_{c}" for c in names]))


@query("SELECT ROUND(AVG(((value >= 50) = (event_type = 'purchase'))::INT), 6) AS accuracy FROM events")
def accuracy_threshold(spark, folder):
    df = table(spark, folder, "events").select((F.col("event_type") == "purchase").alias("y"), "value")
    return rounded(M.accuracy_scores(df, "y", ["value"], 50.0))


@query(f"WITH {SCORES} SELECT ROUND(AVG((label = prediction)::INT), 6) AS accuracy FROM c")
def accuracy_score_matrix(spark, folder):
    return rounded(M.accuracy_scores(scored_events(spark, folder), "label", ["s0", "s1", "s2"]))


def _binary_sql(prediction: str) -> str:
    return f"""
WITH e AS (SELECT event_type = 'purchase' AS y, {prediction} AS p FROM events),
c AS (SELECT COUNT(*) FILTER (p AND y) AS tp, COUNT(*) FILTER (p AND NOT y) AS fp, COUNT(*) FILTER (NOT p AND y) AS fn,
  COUNT(*) FILTER (NOT p AND NOT y) AS tn FROM e),
m AS (SELECT *, (tp + tn) / (tp + tn + fp + fn) AS accuracy, (fp + fn) / (tp + tn + fp + fn) AS error_rate, tp / (tp + fp) AS precision,
  tp / (tp + fn) AS recall, tn / (tn + fn) AS npv, tn / (tn + fp) AS specificity FROM c)
SELECT tp, fp, fn, tn, ROUND(accuracy, 6) AS accuracy, ROUND(error_rate, 6) AS error_rate, ROUND(precision, 6) AS precision,
  ROUND(recall, 6) AS recall, ROUND(npv, 6) AS npv, ROUND(specificity, 6) AS specificity,
  ROUND(2 * precision * recall / (precision + recall), 6) AS f1 FROM m"""


@query(_binary_sql("value > 70"))
def binary_metrics(spark, folder):
    df = ruled_events(spark, folder)
    return rounded(M.binary_metrics(df, F.col("label") == "purchase", F.col("prediction") == "purchase"))


@query(_binary_sql("value >= 50"))
def binary_metrics_scores(spark, folder):
    df = ruled_events(spark, folder).withColumn("y", F.col("label") == "purchase")
    return rounded(M.binary_metrics_scores(df, "y", "value", 50.0))


@query(f"WITH {RULED} SELECT label, prediction, COUNT(*) AS n FROM e GROUP BY 1, 2")
def multiclass_confusion(spark, folder):
    return M.confusion_counts(ruled_events(spark, folder), "label", "prediction")


@query(f"""
WITH {RULED}, n AS (SELECT UNNEST(['click', 'error', 'purchase', 'signup', 'view', 'never']) AS c),
g AS (SELECT a.c AS label, b.c AS prediction FROM n a, n b),
k AS (SELECT label, prediction, COUNT(*) AS n FROM e GROUP BY 1, 2)
SELECT g.label, g.prediction, COALESCE(k.n, 0) AS n FROM g LEFT JOIN k ON g.label = k.label AND g.prediction = k.prediction""")
def confusion_given_classes(spark, folder):
    names = ["click", "error", "purchase", "signup", "view", "never"]
    return M.confusion_counts(ruled_events(spark, folder), "label", "prediction", classes=names)


@query(f"""
WITH {RULED}, {CLASS_RATES} SELECT class, support, predicted, tp, total::BIGINT AS total, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall,
  ROUND(npv, 6) AS npv, ROUND(specificity, 6) AS specificity, ROUND(f1, 6) AS f1 FROM f""")
def class_metrics(spark, folder):
    return rounded(M.class_metrics(M.confusion_counts(ruled_events(spark, folder), "label", "prediction")))


@query(f"WITH {RULED}, {CLASS_RATES} {_averaged(False)}")
def multiclass_metrics_macro(spark, folder):
    return rounded(M.multiclass_metrics(ruled_events(spark, folder), "label", "prediction", weighted=False))


@query(f"WITH {RULED}, {CLASS_RATES} {_averaged(True)}")
def multiclass_metrics_weighted(spark, folder):
    return rounded(M.multiclass_metrics(ruled_events(spark, folder), "label", "prediction"))


@query(f"WITH {SCORES}, e AS (SELECT label::VARCHAR AS label, prediction::VARCHAR AS prediction FROM c), {CLASS_RATES.replace('c AS (SELECT class,', 'cc AS (SELECT class,').replace('FROM c)', 'FROM cc)')} {_averaged(True)}")
def multiclass_metrics_scores(spark, folder):
    return rounded(M.multiclass_metrics_scores(scored_events(spark, folder), "label", ["s0", "s1", "s2"]))


@query(f"""
WITH {SCORES}, p AS (SELECT label, CASE label WHEN 0 THEN s0 WHEN 1 THEN s1 ELSE s2 END AS p FROM s)
SELECT ROUND(AVG(-LN(LEAST(GREATEST(p, 1e-6), 1 - 1e-6))), 6) AS log_loss FROM p""")
def log_loss(spark, folder):
    df = scored_events(spark, folder).withColumn("p", F.array("s0", "s1", "s2"))
    return rounded(M.log_loss(df, "label", "p", epsilon=1e-6))


@query(f"""
WITH {SCORES}, p AS (SELECT (label = 0)::INT AS y, LEAST(GREATEST(s1, 1e-6), 1 - 1e-6) AS p FROM s)
SELECT ROUND(AVG(-(y * LN(p) + (1 - y) * LN(1 - p))), 6) AS cross_entropy FROM p""")
def binary_cross_entropy(spark, folder):
    df = scored_events(spark, folder).withColumn("y", F.col("label") == 0)
    return rounded(M.binary_cross_entropy(df.withColumn("y", F.col("y").cast("int")), "y", "s1", 1e-6))


@query(f"""
WITH {RULED}, a AS (SELECT user_id % 2 AS config, user_id % 3 AS fold, AVG((label = prediction)::INT) AS accuracy FROM e GROUP BY 1, 2)
SELECT config, ROUND(AVG(accuracy), 6) AS accuracy_mean, ROUND(STDDEV_SAMP(accuracy), 6) AS accuracy_std FROM a GROUP BY 1""")
def fold_metric_agg(spark, folder):
    df = ruled_events(spark, folder).withColumns({"config": F.col("user_id") % 2, "fold": F.col("user_id") % 3})
    folds = M.accuracy(df, "label", "prediction", ["config", "fold"])
    return rounded(M.fold_summary(folds, ["config"], ["accuracy"]))


@query("""
WITH n AS (SELECT DISTINCT lower(replace(p_name, ' ', '_')) AS name FROM part)
SELECT name, string_split(name, '_')[-1] AS token,
  array_to_string(list_transform(string_split(replace(name, '_', ' '), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM n""")
def group_titles(spark, folder):
    """Last token and title of names that are joined by underscores."""
    name = F.lower(F.replace("p_name", F.lit(" "), F.lit("_")))
    names = table(spark, folder, "part").select(name.alias("name")).distinct()
    return names.select("name", E.last_token("name").alias("token"), E.group_title("name").alias("title"))
