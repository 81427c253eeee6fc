"""One runnable query per operator over a directory of test tables.

Continuous results (scaled values, rates, test statistics) are rounded to six places
here, so that the order of summation does not show.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketlens.constants import (
    CHURN_COLUMNS,
    CLUSTER_FEATURES,
    CLUSTERS,
    DRIFT_FEATURES,
    PROCESSED_FEATURES,
    PROCESSED_LOG_FEATURES,
    PROFILE_COLUMNS,
    PROFILE_FEATURES,
    SUMMARY_COLUMNS,
)
from basketlens.functions.numeric import round_to
from basketlens.operators import (
    clustering,
    drift,
    experiment,
    features,
    migration,
    prepare,
    profiling,
    reports,
    segments,
)
from basketlens.plans.segmentation import centers_of, feature_history, fit_segmentation, score
from basketlens.sources.sample_views import sample_tables
from basketlens.sources.schemas import BASE_TABLES
from basketlens.sources.sinks import cut_lineage
from basketlens.sources.tables import conform, required_violations, text_to_dates

Query = Callable[[SparkSession, str], DataFrame]

# A stored model: centres on the scale of the clustering features, in their order.
STORED_CENTERS: dict[int, tuple[float, ...]] = {
    0: (-0.151, -0.591, 0.494, 0.107, 0.17, 0.049, 0.432, 0.475, -0.148, -0.291, -0.276),
    1: (-0.123, 0.166, 0.003, -0.028, -0.023, -0.09, -0.057, -0.088, 0.017, 3.085, 2.891),
    2: (-0.07, -0.413, -0.109, -1.166, -1.644, 0.087, 0.429, -0.785, -0.493, -0.257, -0.256),
    3: (0.015, 1.381, 0.065, 0.029, 0.111, 0.006, -1.253, 0.268, -0.078, -0.291, -0.266),
    4: (0.25, -0.582, -0.673, 0.283, 0.293, -0.072, 0.611, -0.574, 0.457, -0.279, -0.258),
}
PROCESSED_CONTEXT = ("region", *PROCESSED_FEATURES)
AGREEMENT_RUNS = ("run_centre", "run_old", "run_tier", "run_breadth", "run_project")

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: round_to(F.col(c), digits) for c in columns})


def _features(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    return features.customer_features(sample_tables(spark, sf_dir), columns=columns)


def _stored_features(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """The wanted features written out once, for steps that pass over them more than once."""
    return cut_lineage(_features(spark, sf_dir, columns))


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.clustering_input(_stored_features(spark, sf_dir, CLUSTER_FEATURES))


def _segmented(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = PROFILE_FEATURES
) -> DataFrame:
    """Some features with the segment of the nearest stored centre."""
    raw = _stored_features(spark, sf_dir, (*CLUSTER_FEATURES, *columns))
    raw = raw.select("*", F.struct("*").alias("_row"))
    scaled = prepare.clustering_input(raw, context=("_row",))
    return clustering.assign_nearest(scaled, STORED_CENTERS).select("_row.*", "segment_id")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clustering vectors written out once, since a fit reads them many times."""
    vectors = clustering.as_vectors(_scaled(spark, sf_dir))
    return cut_lineage(vectors.select("customer_id", "features"))


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four weekly refreshes scored with the stored centres, on the scale of week 0."""
    rows = cut_lineage(feature_history(sample_tables(spark, sf_dir), columns=CLUSTER_FEATURES))
    inputs = prepare.unscaled_input(rows, context=("week", "customer_id"))
    scale = prepare.scaling(inputs.where(F.col("week") == 0), CLUSTER_FEATURES)
    scaled = prepare.standard_scale(inputs, CLUSTER_FEATURES, scale)
    return clustering.assign_nearest(scaled, STORED_CENTERS).select(
        "week", "customer_id", "segment_id"
    )


def _holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sample_tables(spark, sf_dir)
    return experiment.holdout_results(t["campaigns"], t["segment_assignments"], t["old_segments"])


# --- sources ---------------------------------------------------------------


@query
def s1_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(sample_tables(spark, sf_dir)["transactions"], "transactions")


@query
def s2_coerce_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("orders")
    text = spark.sql(
        "SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN '2001-13-45' "
        "ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR(20)) END AS transaction_date FROM orders"
    )
    return text_to_dates(text, ["transaction_date", "absent_date"])


@query
def s3_required_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sample_tables(spark, sf_dir)
    return required_violations({name: t[name] for name in BASE_TABLES})


@query
def s4_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.table_overview(sample_tables(spark, sf_dir))


@query
def s10_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    segmented = _segmented(spark, sf_dir)
    names = segments.name_segments(segments.profile_segments(segmented))
    as_of = features.reference_windows(sample_tables(spark, sf_dir)["transactions"])
    return segments.segment_assignments(segmented, names, as_of.select("ref_date").scalar())


# --- profiling -------------------------------------------------------------


@query
def e1_table_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sample_tables(spark, sf_dir)
    return profiling.table_overview({name: t[name] for name in BASE_TABLES})


@query
def e2_transactions_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.transactions_profile(sample_tables(spark, sf_dir)["transactions"])


@query
def e3_category_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.category_distribution(sample_tables(spark, sf_dir)["transactions"])


@query
def e4_customer_txn_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.transactions_per_customer(sample_tables(spark, sf_dir)["transactions"])


@query
def e5_old_segment_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.old_segment_sizes(sample_tables(spark, sf_dir)["old_segments"])


@query
def e6_old_segment_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sample_tables(spark, sf_dir)
    return profiling.old_segment_behavior(t["old_segments"], t["transactions"])


@query
def e7_old_segment_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sample_tables(spark, sf_dir)
    return profiling.old_segment_campaigns(t["old_segments"], t["campaigns"])


# --- feature relations -----------------------------------------------------


@query
def r1_reference_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sample_tables(spark, sf_dir)
    return features.reference_windows(t["transactions"]).select("ref_date", "window_days")


@query
def r3_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.eligible_customers(sample_tables(spark, sf_dir)["transactions"])


def _purchases(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    transactions = sample_tables(spark, sf_dir)["transactions"]
    windows = features.reference_windows(transactions)
    return features.purchase_features(transactions, windows).select("customer_id", *columns)


@query
def r4_behavioral(spark: SparkSession, sf_dir: str) -> DataFrame:
    transactions = sample_tables(spark, sf_dir)["transactions"]
    windows = features.reference_windows(transactions)
    return (
        features.purchase_features(transactions, windows)
        .join(features.median_baskets(transactions), "customer_id", "left")
        .select(
            "customer_id",
            "txns_in_window",
            "weekly_purchase_frequency",
            "total_transactions",
            "category_breadth",
            "avg_basket_size",
            "median_basket_size",
            "online_ratio",
            "project_category_txns",
            "maintenance_category_txns",
        )
    )


@query
def r5_project_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _purchases(spark, sf_dir, "project_categories_in_window")


@query
def r6_price_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("promo_purchase_ratio", "avg_discount_depth", "full_price_ratio")
    return _purchases(spark, sf_dir, *columns)


@query
def r7_time_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _purchases(
        spark,
        sf_dir,
        "days_since_last_purchase",
        "monthly_frequency",
        "frequency_trend",
        "q2_concentration",
        "weekend_ratio",
    )


def _eligible(spark: SparkSession, sf_dir: str) -> tuple[dict[str, DataFrame], DataFrame]:
    t = sample_tables(spark, sf_dir)
    return t, features.eligible_customers(t["transactions"])


@query
def r8_session_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, eligible = _eligible(spark, sf_dir)
    sessions = features.session_stats(t["web_events"])
    return features.only_eligible(sessions, eligible).select(
        "session_id", "customer_id", "page_count"
    )


@query
def r9_web_behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, eligible = _eligible(spark, sf_dir)
    return features.only_eligible(features.web_features(t["web_events"]), eligible).select(
        "customer_id", "total_sessions", "avg_pages_per_session", "deep_browse_ratio"
    )


@query
def r10_web_page_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, eligible = _eligible(spark, sf_dir)
    return features.only_eligible(features.web_features(t["web_events"]), eligible).select(
        "customer_id", "search_rate", "product_page_ratio", "cart_page_ratio", "mobile_ratio"
    )


@query
def r11_loyalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, eligible = _eligible(spark, sf_dir)
    return features.only_eligible(features.loyalty_features(t["loyalty"]), eligible)


@query
def r12_regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, eligible = _eligible(spark, sf_dir)
    return features.only_eligible(features.customer_regions(t["customer_master"]), eligible)


@query
def r13_customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.customer_features(sample_tables(spark, sf_dir), ordered=True)


# --- preparation -----------------------------------------------------------


@query
def p1_select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.select_features(_features(spark, sf_dir, PROCESSED_CONTEXT))


@query
def p2_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.null_report(_features(spark, sf_dir, PROCESSED_FEATURES), PROCESSED_FEATURES)


@query
def p2_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = prepare.select_features(_features(spark, sf_dir, PROCESSED_CONTEXT))
    return prepare.fill_zero(selected, PROCESSED_FEATURES)


@query
def p3_log_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = PROCESSED_LOG_FEATURES
    selected = prepare.select_features(_features(spark, sf_dir, columns), columns, ["customer_id"])
    return _rounded(prepare.log_transform(selected, [*columns, "absent_feature"]), columns)


@query
def p4_standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    selected = prepare.select_features(_stored_features(spark, sf_dir, PROCESSED_CONTEXT))
    filled = prepare.fill_zero(selected, PROCESSED_FEATURES)
    return _rounded(prepare.standard_scale(filled, PROCESSED_FEATURES), PROCESSED_FEATURES)


@query
def p5_summary_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = prepare.summary_before(_stored_features(spark, sf_dir, PROCESSED_LOG_FEATURES))
    return _rounded(summary, ("mean", "median", "max"))


@query
def p6_summary_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = prepare.summary_after(prepare.processed_features(_stored_features(spark, sf_dir, PROCESSED_CONTEXT)))
    return _rounded(summary, ("mean", "std", "min", "max"))


@query
def p7_processed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(prepare.processed_features(_stored_features(spark, sf_dir, PROCESSED_CONTEXT)), PROCESSED_FEATURES)


@query
def c1_clustering_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_scaled(spark, sf_dir), CLUSTER_FEATURES)


# --- clustering and segments -----------------------------------------------


@query
def c2_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _stored_features(spark, sf_dir, CLUSTER_FEATURES)
    return score(fit_segmentation(raw), raw).select("customer_id", "segment_id")


@query
def c3_k_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir).persist()
    try:
        return clustering.k_selection(vectors)
    finally:
        vectors.unpersist()


@query
def c4_hierarchical(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = clustering.hierarchical_labels(_vectors(spark, sf_dir), CLUSTERS)
    return labelled.select("customer_id", "prediction")


@query
def c5_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = clustering.assign_nearest(_scaled(spark, sf_dir), STORED_CENTERS)
    scores = clustering.silhouettes(labelled, CLUSTER_FEATURES, "segment_id")
    return _rounded(scores, ("within", "nearest", "silhouette"))


@query
def c5_silhouette_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = clustering.assign_nearest(_scaled(spark, sf_dir), STORED_CENTERS)
    vectors = VectorAssembler(inputCols=list(CLUSTER_FEATURES), outputCol="features")
    value = clustering.silhouette(
        vectors.transform(labelled).select("features", F.col("segment_id").cast("double")),
        "segment_id",
    )
    return labelled.groupBy().agg(F.count("*").alias("customers")).select(
        "customers", round_to(F.lit(value), 6).alias("silhouette")
    )


@query
def c6_gmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir).persist()
    try:
        models = clustering.likeliest_mixtures(vectors, range(5))
    finally:
        vectors.unpersist()
    return clustering.label_runs(vectors, models).drop("features")


@query
def c7_label_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = sample_tables(spark, sf_dir)["old_segments"]
    labelled = (
        _segmented(spark, sf_dir, ("loyalty_tier_numeric", "category_breadth", "project_category_txns"))
        .join(old.select("customer_id", "old_segment_id"), "customer_id")
        .select(
            F.col("segment_id").alias("run_centre"),
            (F.col("old_segment_id") - 1).alias("run_old"),
            F.col("loyalty_tier_numeric").alias("run_tier"),
            F.least("category_breadth", F.lit(4)).alias("run_breadth"),
            F.least("project_category_txns", F.lit(4)).alias("run_project"),
        )
    )
    agreement = clustering.label_agreement(labelled, AGREEMENT_RUNS)
    return _rounded(agreement, ("agreement", "matched_agreement"))


@query
def c8_method_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir).persist()
    try:
        return clustering.compare_methods(vectors)
    finally:
        vectors.unpersist()


@query
def c9_score_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = _scaled(spark, sf_dir)
    return clustering.assign_nearest(scaled, STORED_CENTERS).select("customer_id", "segment_id")


@query
def c10_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.profile_segments(_segmented(spark, sf_dir), PROFILE_FEATURES)


@query
def c12_segment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = segments.profile_segments(_segmented(spark, sf_dir))
    return segments.name_segments(profiles).select("segment_id", "segment_name")


@query
def c13_duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = segments.profile_segments(_segmented(spark, sf_dir))
    return segments.name_segments(profiles).select("segment_id", "segment_name", "is_duplicate")


@query
def c14_profile_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.profile_long(segments.profile_segments(_segmented(spark, sf_dir)))


@query
def c15_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _stored_features(spark, sf_dir, (*CLUSTER_FEATURES, *PROFILE_FEATURES))
    model = fit_segmentation(raw)
    scored = model.transform(raw)
    names = segments.name_segments(segments.profile_segments(scored))
    as_of = features.reference_windows(sample_tables(spark, sf_dir)["transactions"])
    assignments = segments.segment_assignments(scored, names, as_of.select("ref_date").scalar())
    return segments.run_summary(
        assignments, len(CLUSTER_FEATURES), clustering.silhouette(scored, "segment_id")
    )


def _labelled_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled features with the stored segments and four labellings read from the tables."""
    raw = _stored_features(
        spark, sf_dir, (*CLUSTER_FEATURES, "loyalty_tier_numeric", "category_breadth", "project_category_txns")
    )
    old = sample_tables(spark, sf_dir)["old_segments"].select("customer_id", "old_segment_id")
    runs = raw.join(old, "customer_id").select(
        "customer_id",
        (F.col("old_segment_id") - 1).alias("run_old"),
        F.col("loyalty_tier_numeric").alias("run_tier"),
        F.least("category_breadth", F.lit(4)).alias("run_breadth"),
        F.least("project_category_txns", F.lit(4)).alias("run_project"),
    )
    scaled = clustering.assign_nearest(prepare.clustering_input(raw), STORED_CENTERS, name="run_centre")
    return scaled.join(runs, "customer_id")


@query
def c8_method_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison table for given labellings, without the fits."""
    table = clustering.method_table(
        _labelled_runs(spark, sf_dir), "run_centre", "run_old", AGREEMENT_RUNS[2:]
    )
    return _rounded(table, ("value",))


@query
def c15_stored_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run summary for the stored centres, without a fit."""
    labelled = _labelled_runs(spark, sf_dir)
    score_ = clustering.run_silhouettes(labelled, ["run_centre"]).first()["silhouette"]
    segmented = _segmented(spark, sf_dir)
    names = segments.name_segments(segments.profile_segments(segmented))
    as_of = features.reference_windows(sample_tables(spark, sf_dir)["transactions"])
    assigned = segments.segment_assignments(segmented, names, as_of.select("ref_date").scalar())
    return _rounded(segments.run_summary(assigned, len(CLUSTER_FEATURES), score_), ("silhouette",))


@query
def c2_fit_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for the fit of C2 whatever its labels: who is where, and how good it is."""
    raw = _stored_features(spark, sf_dir, CLUSTER_FEATURES)
    model = fit_segmentation(raw)
    scored = score(model, raw)
    means = scored.groupBy("segment_id").agg(F.avg("avg_basket_size").alias("mean"), F.count("*").alias("n"))
    ordered = means.agg(
        F.sum("n").alias("customers"),
        F.count("*").alias("segments"),
        (F.array_sort(F.collect_list("mean")) == F.transform(
            F.array_sort(F.collect_list(F.struct("segment_id", "mean"))), lambda s: s["mean"]
        )).alias("by_basket"),
    )
    scaled = prepare.clustering_input(raw)
    centers = dict(enumerate(centers_of(model)))

    def cost(points: dict[int, Sequence[float]]) -> DataFrame:
        least = F.least(*[clustering.squared_distance(CLUSTER_FEATURES, c) for c in points.values()])
        return scaled.agg(F.sum(least).alias("cost"))

    nearest = clustering.assign_nearest(scaled, centers, name="nearest").select("customer_id", "nearest")
    places = scored.select("customer_id", "segment_id").join(nearest, "customer_id")
    misplaced = places.agg(F.count_if(F.col("segment_id") != F.col("nearest")).alias("misplaced"))
    return ordered.select(
        "customers",
        "segments",
        "by_basket",
        misplaced.scalar().alias("misplaced"),
        (cost(centers).scalar() <= cost(STORED_CENTERS).scalar()).alias("no_worse_than_stored"),
    )


@query
def c3_fit_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per number of clusters, that the cost does not rise and the silhouette is one."""
    table = clustering.k_selection(_vectors(spark, sf_dir))
    before = F.lag("inertia").over(Window.orderBy("k"))  # nine rows
    return table.select(
        "k",
        F.coalesce(F.col("inertia") <= before, F.lit(True)).alias("cost_falls"),
        F.col("silhouette").between(-1, 1).alias("has_silhouette"),
    )


@query
def c4_fit_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a good labelling has and a random one has not: compact and well separated clusters.

    Joined clusters keep at least an eighth of the spread out of them, and most customers
    are nearest to the mean of their own cluster (a random fifth would be).
    """
    labelled = clustering.hierarchical_labels(_vectors(spark, sf_dir), CLUSTERS)
    rows = labelled.select("prediction", vector_to_array("features").alias("x"))
    values = [F.get("x", F.lit(i)) for i in range(len(CLUSTER_FEATURES))]
    means = rows.groupBy("prediction").agg(F.array(*[F.avg(v) for v in values]).alias("mean"))
    means = means.agg(F.collect_list(F.struct("prediction", "mean"))).scalar()  # five rows
    gaps = F.transform(
        "means",
        lambda m: F.struct(
            F.aggregate(F.zip_with("x", m["mean"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, g: t + g).alias("gap"),
            m["prediction"].alias("prediction"),
        ),
    )
    rows = rows.withColumn("means", means).withColumn("gaps", gaps)
    own = F.element_at(F.filter("gaps", lambda g: g["prediction"] == F.col("prediction")), 1)["gap"]
    total = sum((F.var_pop(v) * F.count(v) for v in values), F.lit(0.0))
    return rows.agg(
        F.count("*").alias("customers"),
        F.count_distinct("prediction").alias("clusters"),
        (F.sum(own) <= total * 0.875).alias("compact"),
        (F.avg((F.array_min("gaps")["prediction"] == F.col("prediction")).cast("int")) >= 0.6).alias("separate"),
    )


@query
def c6_fit_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That the kept fit is the likeliest of its starts and likelier than a mixture of two."""
    vectors = _vectors(spark, sf_dir).persist()
    try:
        pair = GaussianMixture(k=2, seed=0).fit(vectors).summary.logLikelihood
        starts = clustering.mixture_starts(vectors, 0)
        kept = clustering.fit_mixture(vectors, 0)
        labelled = clustering.label_runs(vectors, [kept])
        return labelled.agg(
            F.count("*").alias("customers"),
            F.count_if(F.col("run_0").between(0, CLUSTERS - 1)).alias("labels"),
            F.lit(kept.log_likelihood >= max(m.log_likelihood for m in starts)).alias("likeliest"),
            F.lit(kept.log_likelihood > pair).alias("likelier_than_two"),
        )
    finally:
        vectors.unpersist()


# --- holdout test and migration --------------------------------------------


@query
def v1_segment_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sample_tables(spark, sf_dir)
    return experiment.segment_pairs(t["segment_assignments"], t["old_segments"])


@query
def v2_holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = sample_tables(spark, sf_dir)["segment_assignments"].select("customer_id")
    return experiment.split_holdout(customers)


@query
def v2_exact_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = sample_tables(spark, sf_dir)["segment_assignments"].select("customer_id")
    return experiment.split_holdout(customers, exact=True)


@query
def v3_holdout_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _holdout(spark, sf_dir)


@query
def v4_rates_and_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = experiment.rates_and_lift(_holdout(spark, sf_dir))
    return _rounded(rates, ("control_rate", "treatment_rate", "lift_pct"))


@query
def v5_ztest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = experiment.proportion_tests(_holdout(spark, sf_dir))
    return _rounded(tests, ("z",)).drop("p_value")


@query
def v5_pvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = experiment.proportion_tests(_holdout(spark, sf_dir))
    return _rounded(tests, ("p_value",)).drop("z")


@query
def v6_ttest(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = experiment.revenue_test(_holdout(spark, sf_dir))
    columns = ("control_revenue_per_send", "treatment_revenue_per_send", "lift_pct", "t")
    return _rounded(test, columns).drop("p_value", "significant")


@query
def v6_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = experiment.revenue_test(_holdout(spark, sf_dir))
    return _rounded(test, ("p_value",)).select("degrees_of_freedom", "p_value", "significant")


@query
def v7_conversion_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    interval = experiment.conversion_interval(_holdout(spark, sf_dir))
    return _rounded(interval, interval.columns)


@query
def v9_per_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = experiment.treatment_by_segment(_holdout(spark, sf_dir))
    return _rounded(table, [c for c in table.columns if c not in ("new_segment", "n")])


@query
def v10_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _history(spark, sf_dir)
    return migration.migration(
        history.where(F.col("week") == 0), history.where(F.col("week") == 3)
    )


@query
def v12_migration_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _history(spark, sf_dir)
    return migration.migration_matrix(
        history.where(F.col("week") == 0), history.where(F.col("week") == 3)
    )


@query
def v13_migration_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return migration.migration_log(_history(spark, sf_dir))


@query
def v13_week_to_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return migration.migration_log(_history(spark, sf_dir), against="previous")


@query
def v14_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiment.group_sizes(_holdout(spark, sf_dir))


# --- drift -----------------------------------------------------------------


@query
def d1_distribution_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.segment_distribution(sample_tables(spark, sf_dir)["segment_assignments"])


@query
def d2_new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = _features(spark, sf_dir, ()).select("customer_id")
    return drift.new_customers(sample_tables(spark, sf_dir)["transactions"], assigned)


@query
def d3_migration_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.latest_migration(migration.migration_log(_history(spark, sf_dir)))


@query
def d4_feature_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.feature_stats(_features(spark, sf_dir, DRIFT_FEATURES))


@query
def d5_feature_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = cut_lineage(feature_history(sample_tables(spark, sf_dir), columns=DRIFT_FEATURES))
    change = drift.feature_drift(
        history.where(F.col("week") == 0), history.where(F.col("week") == 3)
    )
    return _rounded(change, [c for c in change.columns if c not in ("feature", "alert")])


@query
def d5_distribution_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which features moved by more than a tenth of the customers, as the exact shares say too."""
    history = cut_lineage(feature_history(sample_tables(spark, sf_dir), columns=DRIFT_FEATURES))
    before, after = (drift.feature_sketches(history.where(F.col("week") == week)) for week in (0, 3))
    return drift.distribution_drift(before, after).select("feature", "n_before", "n_after", "alert")


# --- reports ---------------------------------------------------------------


@query
def x1_segment_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sample_tables(spark, sf_dir)
    return reports.segment_health(t["segment_assignments"], t["transactions"])


@query
def x2_health_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sample_tables(spark, sf_dir)
    return reports.segment_health_by_quarter(t["segment_assignments"], t["transactions"])


@query
def x3_migration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.migration_report(migration.migration_log(_history(spark, sf_dir)))


@query
def x4_campaign_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.campaign_performance(_holdout(spark, sf_dir))


@query
def x5_campaign_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.campaign_summary(_holdout(spark, sf_dir))


def _assigned(
    spark: SparkSession, sf_dir: str, columns: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    t = sample_tables(spark, sf_dir)
    return t["segment_assignments"], features.customer_features(t, columns=columns)


@query
def x6_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.customer_profiles(*_assigned(spark, sf_dir, PROFILE_COLUMNS))


@query
def x7_profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [source for source, _, _ in SUMMARY_COLUMNS]
    return reports.profile_summary(*_assigned(spark, sf_dir, columns))


@query
def x8_churn_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.churn_indicators(*_assigned(spark, sf_dir, CHURN_COLUMNS))


@query
def x9_churn_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.churn_summary(*_assigned(spark, sf_dir, CHURN_COLUMNS))
