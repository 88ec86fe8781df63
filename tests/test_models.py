import random

import pytest
from builders import clock, purchase, raw, raw_row
from pyspark.sql import Observation
from pyspark.sql import functions as F

from clickloom.operators import customers, funnel, models
from clickloom.operators.normalize import stage_events

CUT = "2025-01-20"


def habits(spark, users=300, seed=5):
    """Users with a steady rate of events; the rate decides who stays away, the last day hardly does."""
    r, rows = random.Random(seed), []
    for u in range(users):
        rate = r.choice((0.08, 0.25, 0.8))
        for d in range(26):
            if r.random() < rate or d == u % 19:
                rows.append(raw_row(f"u{u}", clock(days=d, hours=r.randrange(23))))
                if r.random() < 0.2:
                    rows.append(purchase(f"u{u}", clock(days=d, hours=23), f"T{u}-{d}", 10 * rate))
    return raw(spark, rows)


def test_nothing_after_the_cut_reaches_a_feature(spark):
    events = stage_events(habits(spark, 60))
    features = ["user_id", *models.CHURN_FEATURES]
    whole = models.churn_examples(events, CUT, 7)
    cut = models.churn_examples(events.where(f"event_ts < '{CUT}'"), CUT, 7)
    assert sorted(whole.select(features).collect()) == sorted(cut.select(features).collect())
    assert cut.where("NOT churned").count() == 0 < whole.where("NOT churned").count()


def test_churn_model_is_better_than_recency(spark):
    fitted = models.fit_churn(models.churn_examples(stage_events(habits(spark)), CUT, 7).cache())
    assert fitted.auc > fitted.recency_auc and fitted.auc > 0.6
    scores = fitted.scores.collect()
    assert {r.held_out for r in scores} == {True, False} and all(0 <= r.score <= 1 for r in scores)


def test_churn_model_in_a_session_that_observed(spark):
    watch = Observation()
    spark.range(3).observe(watch, F.count(F.lit(1)).alias("n")).collect()
    assert watch.get == {"n": 3}
    fitted = models.fit_churn(models.churn_examples(stage_events(habits(spark, users=60)), CUT, 7))
    assert all(0 <= r.score <= 1 for r in fitted.scores.collect())


def test_auc_of_known_orders(spark):
    rows = [(0.1, False), (0.2, True), (0.3, False), (0.4, True)]
    assert models.auc(spark.createDataFrame(rows, "score double, churned boolean")) == pytest.approx(0.75)
    assert models.auc(spark.createDataFrame(rows[:1], "score double, churned boolean")) is None


def test_one_outcome_is_every_score(spark):
    events = stage_events(raw(spark, [raw_row(f"u{i}", clock(days=i % 3)) for i in range(30)]))
    fitted = models.fit_churn(models.churn_examples(events, CUT, 7))
    assert fitted.model is None and fitted.auc is None and {r.score for r in fitted.scores.collect()} == {1.0}
    none = models.fit_churn(models.churn_examples(events, "2024-01-01", 7))
    assert none.scores.count() == 0


def test_no_purchases_predict_nothing(spark):
    daily = spark.createDataFrame([], "user_id long, day date, purchases long, revenue double")
    model = models.fit_value(models.value_examples(daily, "2025-03-02", 30))
    assert model.predict(models.value_examples(daily, "2025-03-02", 30)).count() == 0


def test_value_model_is_better_than_the_last_period(spark):
    r, rows = random.Random(2), []
    for u in range(400):
        rate, spend = r.choice((0.05, 0.2, 0.5)), r.choice((10, 40))
        rows += [(u, d, 1, spend * r.uniform(0.5, 1.5)) for d in range(120) if r.random() < rate]
    daily = spark.createDataFrame(rows, "user_id long, d int, purchases long, revenue double")
    daily = daily.select("user_id", F.expr("date_add(DATE '2025-01-01', d)").alias("day"), "purchases", "revenue").cache()
    model = models.fit_value(models.value_examples(daily, "2025-03-02", 30).cache())
    later = model.predict(models.value_examples(daily, "2025-04-01", 30)).cache()
    assert models.mean_error(later) < models.mean_error(later, "last_revenue")
    sums = later.agg(F.sum("predicted"), F.sum("next_revenue")).first()
    assert sums[0] == pytest.approx(sums[1], rel=0.15)


def brute_funnel(rows, steps):
    out = [0] * len(steps)
    for user in {r[0] for r in rows}:
        at, taken = -1, 0
        while taken < len(steps):
            later = [t for u, t, s in rows if u == user and s == steps[taken] and t > at]
            if not later:
                break
            at, taken = min(later), taken + 1
        for i in range(taken):
            out[i] += 1
    return out


def test_funnel_against_brute_force(spark):
    r, steps = random.Random(8), ("a", "b", "c", "d")
    rows = [(f"u{r.randrange(40)}", r.randrange(12), r.choice("abcdx")) for _ in range(500)]
    rows += [("hot", t // 3, r.choice("abcd")) for t in range(900)]
    events = spark.createDataFrame(rows, "user_id string, t int, event_name string").withColumn("event_ts", F.timestamp_seconds("t"))
    # Many small ranges, so that the hot user and ties at their borders are spread over them.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {x.step: x.users for x in funnel.ordered_funnel(events, steps).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [found[s] for s in steps] == brute_funnel(rows, steps)


def test_walks_compose():
    r = random.Random(3)
    for _ in range(200):
        events = sorted((r.randrange(8), r.randrange(1, 4)) for _ in range(r.randrange(12)))
        cut = r.randrange(len(events) + 1)
        while 0 < cut < len(events) and events[cut - 1][0] == events[cut][0]:
            cut += 1  # one instant is in one range
        whole, left, right = funnel.Walk(3), funnel.Walk(3), funnel.Walk(3)
        for i, (at, step) in enumerate(events):
            whole.add(step, at)
            (left if i < cut else right).add(step, at)
        assert [right.taken[s] for s in left.taken] == whole.taken


def test_retention_with_fixed_buckets(spark):
    rows = [(1, "2025-01-01", 1, 5.0), (1, "2025-01-09", 1, 5.0), (2, "2025-01-02", 1, 5.0)]
    daily = spark.createDataFrame(rows, "user_id int, day string, purchases int, revenue double").withColumn("day", F.to_date("day"))
    assert [tuple(r)[1:] for r in customers.retention_table(daily, 3).collect()] == [(2, 1, 0)]
