"""Preparation, segments, experiment, migration, drift and reports on small frames."""

from __future__ import annotations

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from basketlens.constants import CLUSTER_FEATURES, NAME_RULES, PROFILE_FEATURES
from basketlens.functions.numeric import ratio, round_to
from basketlens.functions.probability import normal_two_sided, student_two_sided
from basketlens.operators import (
    clustering,
    drift,
    experiment,
    lloyd,
    migration,
    prepare,
    profiling,
    reports,
    segments,
    ward,
)

D = dt.date


def rows(df):
    return [r.asDict() for r in df.collect()]


# --- expressions -----------------------------------------------------------


def test_rounding_goes_half_up_on_the_decimal_value(spark):
    df = spark.createDataFrame([(0.285, 2.5, -2.5)], "a double, b double, c double")
    row = df.select(
        round_to(F.col("a"), 2), round_to(F.col("b"), 0), round_to(F.col("c"), 0)
    ).first()
    assert tuple(row) == (0.29, 3.0, -3.0)


def test_ratio_of_zero_is_null(spark):
    assert spark.range(1).select(ratio(F.lit(1), F.lit(0))).first()[0] is None


def test_tail_probabilities(spark):
    zs = [0.0, 0.5, -1.96, 3.0, 5.0, 9.0]
    df = spark.createDataFrame([(z,) for z in [*zs, None]], "z double")
    found = [r[0] for r in df.select(normal_two_sided(F.col("z"))).collect()]
    for z, p in zip(zs, found, strict=False):
        assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=1e-13)
    assert found[-1] is None
    cases = [(1.0, 1, 0.5), (2.0, 2, 0.18350341907227), (2.228138852, 10, 0.05), (50.0, 1000, 0.0)]
    df = spark.createDataFrame(cases, "t double, v long, p double")
    for r in df.select("p", student_two_sided(F.col("t"), F.col("v")).alias("q")).collect():
        assert r.q == pytest.approx(r.p, abs=1e-8)


# --- preparation -----------------------------------------------------------


def test_scaling_constant_and_null_columns(spark):
    df = spark.createDataFrame([(1.0, 0.1), (3.0, 0.1), (None, 0.1)], "a double, b double")
    filled = prepare.fill_zero(df, ["a", "b"])
    out = rows(prepare.standard_scale(filled, ["a", "b"]))
    assert all(r["b"] == 0.0 for r in out)
    assert sum(r["a"] for r in out) == pytest.approx(0)
    assert sum(r["a"] ** 2 for r in out) / 3 == pytest.approx(1)
    assert rows(prepare.null_report(df, ["a", "b"])) == [
        {"feature": "a", "null_count": 1},
        {"feature": "b", "null_count": 0},
    ]


def test_scaling_by_an_earlier_scale(spark):
    old = spark.createDataFrame([(0.0,), (2.0,)], "a double")
    new = spark.createDataFrame([(5.0,)], "a double")
    out = prepare.standard_scale(new, ["a"], prepare.scaling(old, ["a"]))
    assert out.first().a == 4.0


def test_log_skips_absent_names(spark):
    df = spark.createDataFrame([(0.0,)], "a double")
    assert rows(prepare.log_transform(df, ["a", "b"])) == [{"a": 0.0}]


# --- clustering and segments -----------------------------------------------


def test_nearest_centre_prefers_the_lower_number(spark):
    df = spark.createDataFrame([("x", 0.0), ("y", 2.0)], "customer_id string, a double")
    out = clustering.assign_nearest(df, {1: [1.0], 0: [-1.0]}, ["a"])
    assert {r["customer_id"]: r["segment_id"] for r in rows(out)} == {"x": 0, "y": 1}


def test_silhouette_against_brute_force(spark):
    points = [(f"c{i}", (i * 37 % 11) / 3, (i * 17 % 7) / 2, i % 3) for i in range(40)]
    points.append(("alone", 50.0, 50.0, 9))
    df = spark.createDataFrame(points, "customer_id string, a double, b double, prediction int")

    def expected(point):
        distances: dict[int, list[float]] = {}
        for other in points:
            if other[0] != point[0]:
                distances.setdefault(other[3], []).append(math.dist(point[1:3], other[1:3]) ** 2)
        if point[3] not in distances:
            return 0.0
        within = sum(distances[point[3]]) / len(distances[point[3]])
        nearest = min(sum(v) / len(v) for k, v in distances.items() if k != point[3])
        return (nearest - within) / max(nearest, within)

    whole = clustering.silhouettes(df.repartition(4), ["a", "b"])
    found = {r.customer_id: r.silhouette for r in whole.collect()}
    assert found == pytest.approx({p[0]: expected(p) for p in points})
    scored = clustering.as_vectors(df, ["a", "b"]).withColumn("prediction", F.col("prediction").cast("double"))
    assert clustering.silhouette(scored) == pytest.approx(sum(found.values()) / len(found))


def test_segments_are_the_nearest_centres_in_their_order(spark):
    from basketlens.plans.segmentation import centers_of, nearest_stage

    centers = [[1e-17, -2.5], [3.0, 1e3], [-4.25, 0.1]]
    stage = nearest_stage(centers, ["a", "b"])
    df = spark.createDataFrame([(0.1, -2.0), (3.0, 900.0), (-4.0, 0.0), (9.0, 9e9)], "scaled_a double, scaled_b double")
    assert [r.segment_id for r in stage.transform(df).collect()] == [0, 1, 2, 1]
    numbers = [[float(i + j) for j in range(11)] for i in range(3)]
    assert centers_of(PipelineModel([nearest_stage(numbers)])) == numbers


def test_label_agreement(spark):
    df = spark.createDataFrame([(0, 1, 0), (0, 1, 1), (1, 0, 0), (1, 0, 1)], "a int, b int, c int")
    found = {(r.run_a, r.run_b): (r.agreement, r.matched_agreement) for r in
             clustering.label_agreement(df, ["a", "b", "c"]).collect()}
    assert found == {("a", "b"): (0.0, 1.0), ("a", "c"): (0.5, 0.5), ("b", "c"): (0.5, 0.5)}


def test_the_best_matching_is_the_best_of_all(spark):
    """Two labels must not share a name: the old way would have counted 12 here, not 10."""
    assert clustering.matcher()(np.array([[7, 2], [5, 3]])) == 10
    rng = np.random.default_rng(8)
    for _ in range(60):
        weights = rng.integers(0, 30, rng.integers(1, 6, 2))
        tall = weights if weights.shape[0] >= weights.shape[1] else weights.T
        best = max(sum(tall[r, c] for c, r in enumerate(rows)) for rows in itertools.permutations(range(len(tall)), tall.shape[1]))
        assert clustering.matcher()(weights) == best


def _profile(spark, values):
    columns = {c: 0.0 for c in PROFILE_FEATURES}
    data = [(i, *{**columns, **v}.values()) for i, v in enumerate(values)]
    return spark.createDataFrame(data, ["segment_id", *columns])


def test_tied_scores_take_the_earlier_rule(spark):
    named = segments.name_segments(_profile(spark, [{}, {"promo_purchase_ratio": 1.0}]))
    assert [(r["segment_name"], r["is_duplicate"]) for r in rows(named.orderBy("segment_id"))] == [
        (NAME_RULES[0][0], False),
        (NAME_RULES[0][0], True),
    ]


def test_profiles_leave_nulls_out(spark):
    df = spark.createDataFrame([(0, 1.0), (0, None), (1, 5.0)], "segment_id int, f double")
    profiles = segments.profile_segments(df, ["f"])
    assert {r["segment_id"]: (r["f"], r["customer_count"], r["pct_of_total"]) for r in rows(profiles)} == {
        0: (1.0, 2, 66.7),
        1: (5.0, 1, 33.3),
    }


# --- experiment ------------------------------------------------------------


def _holdout(spark, data):
    schema = (
        "customer_id string, test_group string, new_segment string, opened long, clicked long,"
        "converted long, revenue double"
    )
    return spark.createDataFrame(data, schema)


def test_no_success_anywhere(spark):
    df = _holdout(
        spark,
        [(f"c{i}", g, "S", 0, 0, 0, 0.0) for i, g in enumerate(["control", "treatment"] * 3)],
    )
    for r in rows(experiment.rates_and_lift(df)):
        assert r["lift_pct"] == 0.0
    for r in rows(experiment.proportion_tests(df)):
        assert (r["z"], r["p_value"], r["significant"]) == (0.0, 1.0, False)
    test = experiment.revenue_test(df).first()
    assert (test.t, test.p_value, test.lift_pct) == (None, None, 0.0)
    interval = experiment.conversion_interval(df).first()
    assert (interval.ci_lower_pct, interval.ci_upper_pct) == (0.0, 0.0)


def test_t_and_z_against_formulas(spark):
    data = [(f"c{i}", "control", "S", i % 4 == 0, 0, 0, float(i % 7)) for i in range(40)]
    data += [(f"t{i}", "treatment", "S", i % 2 == 0, 0, 0, float(i % 9)) for i in range(30)]
    df = _holdout(spark, [(a, b, c, int(o), k, v, r) for a, b, c, o, k, v, r in data])
    z = {r["metric"]: r["z"] for r in rows(experiment.proportion_tests(df))}
    pooled = 25 / 70
    assert z["opened"] == pytest.approx(
        (0.5 - 0.25) / math.sqrt(pooled * (1 - pooled) * (1 / 40 + 1 / 30))
    )
    c, t = [float(i % 7) for i in range(40)], [float(i % 9) for i in range(30)]
    mc, mt = sum(c) / 40, sum(t) / 30
    spread = (sum((x - mc) ** 2 for x in c) + sum((x - mt) ** 2 for x in t)) / 68
    test = experiment.revenue_test(df).first()
    assert test.t == pytest.approx((mt - mc) / math.sqrt(spread * (1 / 40 + 1 / 30)))
    assert test.degrees_of_freedom == 68


def test_exact_split_puts_half_into_treatment(spark):
    for n in (0, 1, 2, 7, 200):
        df = spark.range(n).select(F.concat(F.lit("C"), F.col("id")).alias("customer_id"))
        groups = {r.test_group: r.n for r in
                  experiment.split_holdout(df, exact=True).groupBy("test_group").agg(F.count("*").alias("n")).collect()}
        assert groups.get("treatment", 0) == n // 2
        assert sum(groups.values()) == n


def test_split_is_stable(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("customer_id"))
    once = {r.customer_id: r.test_group for r in experiment.split_holdout(df).collect()}
    again = {r.customer_id: r.test_group for r in experiment.split_holdout(df.repartition(3)).collect()}
    assert once == again
    assert 200 < sum(g == "treatment" for g in once.values()) < 300


def test_per_customer_results(spark):
    df = _holdout(spark, [("a", "control", "S", 1, 0, 0, 2.0), ("a", "control", "S", 0, 0, 0, 4.0)])
    assert rows(experiment.per_customer_results(df))[0]["opened"] == 0.5


# --- migration and drift ---------------------------------------------------


def _assigned(spark, pairs):
    return spark.createDataFrame(
        [(c, s, f"S{s}", D(2024, 1, 1)) for c, s in pairs],
        "customer_id string, segment_id long, segment_name string, assignment_date date",
    )


def test_rate_at_the_threshold_is_unstable_but_no_alert(spark):
    before = _assigned(spark, [(f"c{i}", 0) for i in range(20)] + [("gone", 1)])
    after = _assigned(spark, [(f"c{i}", int(i < 3)) for i in range(20)] + [("n1", 0), ("n2", 1)])
    row = migration.migration(before, after).first()
    assert (row.customers_shifted, row.migration_rate, row.stability_pass) == (3, 0.15, False)
    assert (row.customers, row.customers_entered, row.customers_left) == (20, 2, 1)
    log = migration.migration(before, after).withColumn("week", F.lit(1))
    assert drift.latest_migration(log).first().alert is False
    assert drift.latest_migration(log.where("week > 1")).count() == 0


def test_matrix_margins(spark):
    before = _assigned(spark, [("a", 0), ("b", 0), ("c", 1), ("gone", 1)])
    after = _assigned(spark, [("a", 0), ("b", 1), ("c", 1), ("new", 0)])
    cells = {(r.from_segment, r.to_segment): r.customers for r in
             migration.migration_matrix(before, after).collect()}
    assert cells == {
        ("0", "0"): 1, ("0", "1"): 1, ("1", "1"): 1, ("0", "All"): 2, ("1", "All"): 1,
        ("All", "0"): 1, ("All", "1"): 2, ("All", "All"): 3,
    }
    wide = rows(migration.wide_matrix(migration.migration_matrix(before, after), ["0", "1"]))
    assert wide[-1] == {"from_segment": "All", "0": 1, "1": 2, "All": 3}


def test_log_against_first_and_previous_week(spark):
    history = spark.createDataFrame(
        [(0, "a", 1), (0, "b", 1), (1, "a", 2), (1, "b", 1), (2, "a", 1), (2, "b", 1)],
        "week long, customer_id string, segment_id long",
    )
    first = [r["customers_shifted"] for r in rows(migration.migration_log(history))]
    previous = [r["customers_shifted"] for r in rows(migration.migration_log(history, against="previous"))]
    assert (first, previous) == ([1, 0], [1, 1])
    with pytest.raises(ValueError):
        migration.migration_log(history, against="next")


def test_shares_at_the_limits_raise_no_alert(spark):
    sizes = {"S0": 2, "S1": 16, "S2": 1, "S3": 21}  # of 40: 5, 40, 2.5 and 52.5 per cent
    pairs = [(f"{s}-{i}", int(s[1])) for s, n in sizes.items() for i in range(n)]
    found = {r.segment_name: r.alert for r in drift.segment_distribution(_assigned(spark, pairs)).collect()}
    assert found == {"S0": None, "S1": None, "S2": "too small", "S3": "too large"}


def test_distribution_change_lists_vanished_segments(spark):
    now = _assigned(spark, [("a", 0), ("b", 1)])
    before = _assigned(spark, [("a", 0), ("b", 0), ("c", 2), ("d", 2)])
    found = {r.segment_name: (r.customer_count, r.pct_change) for r in
             drift.segment_distribution(now, before).collect()}
    assert found == {"S0": (1, 0.0), "S1": (1, 50.0), "S2": (0, -50.0)}


def test_feature_drift_in_deviations(spark):
    columns = [c for c in drift.DRIFT_FEATURES]
    before = spark.createDataFrame([(0.0,) * 5, (2.0,) * 5], columns)
    after = spark.createDataFrame([(2.0,) * 5, (4.0,) * 5], columns)
    for r in drift.feature_drift(before, after).collect():
        assert r.shift_in_deviations == pytest.approx(2 / math.sqrt(2))
        assert r.alert


# --- reports and profiles --------------------------------------------------


def test_churn_with_unknown_trend(spark):
    df = spark.createDataFrame(
        [(None, 401), (None, 400), (-0.31, 301), (-0.31, 300), (-0.05, 400), (0.5, 500)],
        "frequency_trend double, days_since_last_purchase int",
    )
    found = [r[0].split()[0] for r in df.select(reports.churn_risk()).collect()]
    assert found == ["Medium", "Low", "High", "Medium", "Low", "Medium"]


def test_segment_behavior_with_a_null_segment_name(spark):
    old = spark.createDataFrame(
        [("a", 1, None), ("b", 2, "x")], "customer_id string, old_segment_id long, segment_name string"
    )
    bought = spark.createDataFrame(
        [("t1", "a", 1.0, "p", "online", True), ("t2", "a", 2.0, None, "store", None),
         ("t3", "b", 3.0, "q", "store", False)],
        "transaction_id string, customer_id string, amount double, category string, channel string, promo_flag boolean",
    )
    found = rows(profiling.old_segment_behavior(old, bought))
    assert [(r["total_txns"], r["customers"], r["median_basket"], r["distinct_categories"]) for r in found] == [
        (2, 1, 1.0, 1),
        (1, 1, 3.0, 1),
    ]
    assert (found[0]["online_pct"], found[0]["promo_pct"]) == (50.0, 50.0)


def test_clusters_are_the_declared_features():
    assert len(CLUSTER_FEATURES) == 11
    assert len(PROFILE_FEATURES) == 21


def _blobs(spark):
    """Five separate groups of points whose overall mean is the origin."""
    centres = [(0, 0), (20, 20), (-20, 20), (20, -20), (-20, -20)]
    data = [
        (f"c{c}-{i}", float(x + (i % 5 - 2) / 2), float(y + (i // 5 - 2) / 2), c)
        for c, (x, y) in enumerate(centres)
        for i in range(25)
    ]
    df = spark.createDataFrame(data, "customer_id string, a double, b double, true_label long")
    return clustering.as_vectors(df, ["a", "b"]).repartition(3)


def _pure(labelled, label="prediction"):
    """Every label covers one true group and every group has one label."""
    pairs = labelled.select("true_label", label).distinct().count()
    return pairs == labelled.select(label).distinct().count() == 5


def _noise(spark, n=400, d=3):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(c, 1.0, (n // 4, d)) for c in (0, 3, 7, 8)])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "id int, x array<double>")
    return points, df.select("id", array_to_vector("x").alias("features"))


@pytest.mark.parametrize("sample_rows, task_rows", [(30, 0), (4096, 0), (30, 1 << 17)])
def test_shared_fits_move_as_lloyd_says(spark, monkeypatch, sample_rows, task_rows):
    """Every fit ends where plain Lloyd steps from its start end, with the same cost."""
    monkeypatch.setattr(lloyd, "SAMPLE_ROWS", sample_rows)
    monkeypatch.setattr(lloyd, "TASK_ROWS", task_rows)
    points, vectors = _noise(spark)
    cases = [(2, 1), (5, 1), (5, 2), (7, 9)]
    blocks = vectors.select(vector_to_array("features").alias("x")).mapInArrow(lloyd.packed(), "rows long, block binary")
    starts = lloyd._Fits(blocks, cases).starts()
    for (k, _), start, fit in zip(cases, starts, lloyd.fit_many(vectors, cases, 300)):
        centers, turns = start, 0
        while True:
            label = ((points[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
            moved = np.array([points[label == c].mean(axis=0) if (label == c).any() else centers[c] for c in range(k)])
            shift, centers, turns = ((moved - centers) ** 2).sum(axis=1).max(), moved, turns + 1
            if shift <= lloyd.TOLERANCE**2:
                break
        assert fit.iterations == turns and fit.centers == pytest.approx(centers)
        gaps = ((points[:, None] - centers) ** 2).sum(axis=2)
        assert fit.cost == pytest.approx(gaps.min(axis=1).sum())
        labels = fit.transform(vectors).orderBy("id").collect()
        assert [r.prediction for r in labels] == gaps.argmin(axis=1).tolist()


def test_jobs_grow_with_iterations_and_not_with_fits(spark, monkeypatch):
    monkeypatch.setattr(lloyd, "SAMPLE_ROWS", 40)
    monkeypatch.setattr(lloyd, "TASK_ROWS", 0)
    passes, gather = [], lloyd._Fits._gather
    monkeypatch.setattr(lloyd._Fits, "_gather", lambda self, *a: passes.append(1) or gather(self, *a))
    _, vectors = _noise(spark)
    fits = lloyd.fit_many(vectors, [(k, seed) for k in range(2, 8) for seed in range(5)], 300)
    # The sample and the costs besides.
    assert len(passes) == max(f.iterations for f in fits) + 2


def test_a_fit_does_not_depend_on_the_partitioning(spark):
    _, vectors = _noise(spark)
    one, other = (lloyd.fit_many(vectors.repartition(n), [(5, 4)], 300)[0] for n in (1, 7))
    assert one.centers == pytest.approx(other.centers) and one.cost == pytest.approx(other.cost)


def test_fewer_different_rows_than_clusters(spark):
    vectors = spark.createDataFrame([([1.0, 2.0],)] * 9 + [([4.0, 4.0],)], "x array<double>").select(array_to_vector("x").alias("features"))
    fit = clustering.fit_kmeans(vectors, 5, restarts=2)
    assert sorted(fit.centers.tolist()) == [[1.0, 2.0], [4.0, 4.0]] and fit.cost == 0
    with pytest.raises(ValueError):
        clustering.fit_kmeans(vectors.limit(0))


def _plain_ward(points, k):
    """Join the pair of least Ward distance until k groups are left, trying all pairs."""
    groups = [[i] for i in range(len(points))]
    while len(groups) > k:
        best = None
        for a in range(len(groups)):
            for b in range(a):
                x, y = points[groups[a]], points[groups[b]]
                gap = len(x) * len(y) / (len(x) + len(y)) * ((x.mean(axis=0) - y.mean(axis=0)) ** 2).sum()
                if best is None or gap < best[0]:
                    best = (gap, a, b)
        _, a, b = best
        groups[b] += groups.pop(a)
    return {frozenset(g) for g in groups}


def _groups_of(rows, label="prediction"):
    groups = {}
    for r in rows:
        groups.setdefault(r[label], set()).add(r["id"])
    return {frozenset(g) for g in groups.values()}


def test_ward_equals_joining_all_pairs(spark):
    points, vectors = _noise(spark, 80)
    for k in (2, 3, 6, 80):
        labelled = ward.hierarchical_labels(vectors.repartition(4), k)
        assert _groups_of(labelled.collect()) == _plain_ward(points, k)


def test_ward_of_two_thousand_rows(spark):
    """Separate blobs of different sizes, exact; summarised to 60 features, the same groups."""
    rng = np.random.default_rng(1)
    sizes = (1000, 600, 300, 90, 10)
    points = np.vstack([rng.normal(40 * i, 1.0, (n, 3)) for i, n in enumerate(sizes)])
    truth = np.repeat(range(5), sizes)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    vectors = spark.createDataFrame(rows, "id int, x array<double>").select("id", array_to_vector("x").alias("features"))
    wanted = {frozenset(np.flatnonzero(truth == i).tolist()) for i in range(5)}
    for most in (2048, 60):
        assert _groups_of(ward.hierarchical_labels(vectors.repartition(6), 5, most).collect()) == wanted
    assert ward.hierarchical_labels(vectors.limit(0), 5).count() == 0


def test_clustering_features_keep_counts_and_sums(spark):
    points, vectors = _noise(spark)
    blocks = vectors.repartition(5).select(vector_to_array("features").alias("x")).mapInArrow(lloyd.packed(), "rows long, block binary")
    counts, sums = ward.clustering_features(blocks, 30)
    assert len(counts) <= 30 and counts.sum() == len(points) and sums.sum(axis=0) == pytest.approx(points.sum(axis=0))


def test_model_fits_find_separate_groups(spark):
    vectors = _blobs(spark).cache()
    kmeans = clustering.fit_kmeans(vectors, restarts=3).transform(vectors)
    assert _pure(kmeans)
    assert clustering.silhouette(kmeans) > 0.9
    assert _pure(clustering.hierarchical_labels(vectors, 5))
    mixture = clustering.fit_mixture(vectors, 0)
    runs = clustering.label_runs(vectors, [mixture, mixture])
    assert runs.where("run_0 <> run_1").count() == 0
    table = clustering.k_selection(vectors, ks=(2, 3, 5), restarts=2).collect()
    costs = [r.inertia for r in table]
    assert costs == sorted(costs, reverse=True)
    vectors.unpersist()
