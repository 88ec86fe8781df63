"""Churn and value models: features before a cut, what happened after it, fitted by Spark.

Both read the events once, fold them to one row per user, and hand only that to MLlib.
Nothing after the cut can reach a feature: the two sides are separate aggregates over the
two sides of the cut.  Users are held out by a hash of their id, so a user is never on
both sides of the split and a rerun splits alike.

Defined results: users without an event before the cut have no row; where the training
users have one outcome only, or there are none, there is no model to fit: every user
scores that outcome (or NULL).  A value model without training purchases predicts 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression, GeneralizedLinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.fields import money
from clickloom.operators.normalize import is_conversion

FOLDS = 5
CHURN_FEATURES = ("recency_days", "tenure_days", "events", "active_days", "recent_events", "purchases", "revenue")
VALUE_FEATURES = ("recency_days", "tenure_days", "periods_purchases", "last_purchases", "mean_spend", "last_revenue")


def held_out(user: Column, folds: int = FOLDS) -> Column:
    """One user in ``folds``, chosen by id."""
    return F.crc32(user.cast("string").cast("binary")) % folds == 0


def churn_examples(events: DataFrame, cut: str, horizon_days: int, recent_days: int = 7) -> DataFrame:
    """(user_id, features, churned): features from events before a day, the label from the days after it."""
    day, at = F.to_date("event_ts"), F.lit(cut).cast("date")
    before, after = day < at, (day >= at) & (day < F.date_add(at, horizon_days))
    # One row per user and day first: a hot user is reduced before the shuffle, and days are counted plainly.
    daily = events.where(day < F.date_add(at, horizon_days)).groupBy("user_id", day.alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_conversion()).alias("bought"),
        F.sum(F.when(is_conversion(), money(F.col("revenue")))).alias("spent"),
    )
    before, after, recent = (
        F.col("day") < at,
        F.col("day") >= at,
        (F.col("day") < at) & (F.col("day") >= F.date_sub(at, recent_days)),
    )
    users = daily.groupBy("user_id").agg(
        F.datediff(at, F.max(F.when(before, F.col("day")))).cast("double").alias("recency_days"),
        F.datediff(at, F.min(F.when(before, F.col("day")))).cast("double").alias("tenure_days"),
        F.sum(F.when(before, F.col("n")).otherwise(0)).cast("double").alias("events"),
        F.count_if(before).cast("double").alias("active_days"),
        F.sum(F.when(recent, F.col("n")).otherwise(0)).cast("double").alias("recent_events"),
        F.sum(F.when(before, F.col("bought")).otherwise(0)).cast("double").alias("purchases"),
        F.coalesce(F.sum(F.when(before, F.col("spent"))), F.lit(0)).cast("double").alias("revenue"),
        (F.count_if(after) == 0).alias("churned"),
    )
    return users.where("recency_days IS NOT NULL")


@dataclass
class Churn:
    model: PipelineModel | None
    scores: DataFrame  # user_id, held_out, churned, score
    auc: float | None  # on held-out users; None if they have one outcome only
    recency_auc: float | None  # of ordering them by recency alone


def auc(scores: DataFrame, score: str = "score", label: str = "churned") -> float | None:
    """Area under the ROC curve, ties half: from counts per distinct score, whatever the number of users."""
    counts = scores.groupBy(score).agg(F.count_if(F.col(label)).alias("hits"), F.count_if(~F.col(label)).alias("misses"))
    sums = counts.agg(F.sum("hits"), F.sum("misses")).first()
    if not sums[0] or not sums[1]:
        return None
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    plain = scores.select(F.col(score).cast("double").alias("score"), F.col(label).cast("double").alias("label"))
    return BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(plain)


def fit_churn(examples: DataFrame, features: tuple[str, ...] = CHURN_FEATURES, strength: float = 0.01) -> Churn:
    """Logistic regression on the users that are not held out, and the scores of all."""
    rows = examples.withColumns({"held_out": held_out(F.col("user_id")), "label": F.col("churned").cast("double")})
    train = rows.where("NOT held_out")
    outcomes = [r[0] for r in train.select("churned").distinct().collect()]
    if len(outcomes) < 2:
        always = F.lit(float(outcomes[0]) if outcomes else None).cast("double")
        return Churn(None, rows.select("user_id", "held_out", "churned", always.alias("score")), None, None)
    skewed = ("events", "recent_events", "purchases", "revenue")
    shaped = {f: F.log1p(F.greatest(F.col(f), F.lit(0.0))) if f in skewed else F.col(f) for f in features}
    stages = [
        VectorAssembler(inputCols=[f"x_{f}" for f in features], outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True),
        LogisticRegression(regParam=strength, maxIter=50),
    ]
    shape = {f"x_{f}": c for f, c in shaped.items()}
    model = Pipeline(stages=stages).fit(train.withColumns(shape))
    # The summary holds the session, which cannot be sent to tasks once anything was observed in it.
    model.stages[-1]._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    scored = model.transform(rows.withColumns(shape))
    scores = scored.select("user_id", "held_out", "churned", "recency_days", vector_to_array("probability")[1].alias("score"))
    out = scores.where("held_out")
    return Churn(model, scores.drop("recency_days"), auc(out), auc(out, "recency_days"))


def value_examples(daily: DataFrame, cut: str, period_days: int) -> DataFrame:
    """Per user, features from purchases before a day and the revenue of the period after it.

    ``daily`` has (user_id, day, purchases, revenue).  ``last_`` is the period before the cut.
    """
    at = F.lit(cut).cast("date")
    day = F.col("day")
    before, last = day < at, (day < at) & (day >= F.date_sub(at, period_days))
    after = (day >= at) & (day < F.date_add(at, period_days))

    def total(test: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(test, F.col(column))), F.lit(0)).cast("double")

    tenure = F.datediff(at, F.min(F.when(before, day)))
    users = daily.where(day < F.date_add(at, period_days)).groupBy("user_id").agg(
        F.datediff(at, F.max(F.when(before, day))).cast("double").alias("recency_days"),
        tenure.cast("double").alias("tenure_days"),
        (total(before, "purchases") * period_days / F.greatest(tenure, F.lit(period_days))).alias("periods_purchases"),
        total(last, "purchases").alias("last_purchases"),
        F.try_divide(total(before, "revenue"), total(before, "purchases")).alias("mean_spend"),
        total(last, "revenue").alias("last_revenue"),
        total(after, "purchases").alias("next_purchases"),
        total(after, "revenue").alias("next_revenue"),
    )
    return users.where("recency_days IS NOT NULL")


@dataclass
class Value:
    rate: GeneralizedLinearRegressionModel | None
    spend: GeneralizedLinearRegressionModel | None
    factor: float  # what calibration multiplies predictions by

    def predict(self, examples: DataFrame) -> DataFrame:
        """The examples with ``predicted``: purchases times spend per purchase, calibrated."""
        if self.rate is None:
            return examples.withColumn("predicted", F.lit(0.0))
        rows = with_vector(examples)
        rows = self.rate.transform(rows).withColumnRenamed("prediction", "purchases_expected")
        rows = self.spend.transform(rows).withColumnRenamed("prediction", "spend_expected")
        return rows.withColumn("predicted", F.col("purchases_expected") * F.col("spend_expected") * self.factor).drop("features")


def with_vector(examples: DataFrame) -> DataFrame:
    shaped = {f"x_{f}": F.log1p(F.greatest(F.coalesce(F.col(f), F.lit(0.0)), F.lit(0.0))) for f in VALUE_FEATURES}
    assembler = VectorAssembler(inputCols=list(shaped), outputCol="features")
    return assembler.transform(examples.withColumns(shaped)).drop(*shaped)


def fit_value(examples: DataFrame, strength: float = 0.01) -> Value:
    """A two-part model: purchases by a Poisson, spend per purchase by a Gamma regression.

    Both are fitted on users that are not held out; the held-out ones calibrate the product,
    so that predicted and real revenue agree in total.
    """
    rows = with_vector(examples).withColumn("out", held_out(F.col("user_id")))
    train = rows.where("NOT out")
    common = {"featuresCol": "features", "link": "log", "regParam": strength, "maxIter": 50}
    buyers = train.where("next_purchases > 0 AND next_revenue > 0")
    if buyers.isEmpty():
        return Value(None, None, 1.0)
    rate = GeneralizedLinearRegression(family="poisson", labelCol="next_purchases", **common).fit(train)
    buyers = buyers.withColumn("per_purchase", F.col("next_revenue") / F.col("next_purchases"))
    spend = GeneralizedLinearRegression(family="gamma", labelCol="per_purchase", **common).fit(buyers)
    model = Value(rate, spend, 1.0)
    sums = model.predict(examples.where(held_out(F.col("user_id")))).agg(F.sum("next_revenue"), F.sum("predicted")).first()
    model.factor = sums[0] / sums[1] if sums[0] and sums[1] else 1.0
    return model


def mean_error(predicted: DataFrame, column: str = "predicted") -> float:
    return predicted.agg(F.avg(F.abs(F.col(column) - F.col("next_revenue")))).first()[0]
