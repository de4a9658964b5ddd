"""Match-outcome classifier on MLlib (features, split, forest, accuracy, save).

Training is distributed: MLlib's random forest aggregates split statistics
per partition and combines them, so no match rows go through the driver.
The features include full-time goals, which decide the label, so accuracy
measures the pipeline, not a forecast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import season_start_year

FEATURES = (
    "full_time_home_goals", "full_time_away_goals", "half_time_home_goals",
    "half_time_away_goals", "home_shots", "away_shots",
)
# Result code -> class label.
LABELS = {"D": 0, "H": 1, "A": 2}
MIN_SEASON_START_YEAR = 2020


def outcome_label(result: str = "full_time_result"):
    expr = None
    for code, label in LABELS.items():
        expr = (F.when(F.col(result) == code, label) if expr is None else expr.when(F.col(result) == code, label))
    return expr


def match_features(silver: DataFrame, min_start_year: int = MIN_SEASON_START_YEAR,
                   keep: tuple[Column, ...] = ()) -> DataFrame:
    """Six numeric features + label; unknown results ('U') and rows with a
    NULL feature are dropped. The season bound is on the typed start year
    (a text bound would let ``"9394"`` pass). It is stated twice: on the
    stored start year, and on the ``season`` partition column it is derived
    from, so a read of the silver table skips the folders of older seasons
    at planning time instead of scanning them. ``keep`` adds columns."""
    bound = (F.col("season_start_year") >= min_start_year) & (season_start_year("season") >= min_start_year)
    return (
        silver.where(bound)
        .select(*FEATURES, outcome_label().alias("label"), *keep)
        .na.drop(subset=[*FEATURES, "label"])
    )


def in_test(test_percent: int = 20) -> Column:
    """Whether a match is held out: its key's MD5, read as a number, modulo 100.

    The split depends on the match alone, not on partitions, cores or row
    order, so every engine and every rerun holds out the same matches.
    """
    key = F.concat_ws("|", "league_code", "season", F.coalesce(F.col("match_date").cast("string"), F.lit("")),
                      "home_team", "away_team")
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 100 < test_percent


class NoTrainingRows(ValueError):
    """The split leaves nothing to train on."""


@dataclass
class TrainedModel:
    model: PipelineModel
    accuracy: float
    train_rows: int
    test_rows: int
    features: DataFrame  # the stored feature rows of both sides of the split
    scored: DataFrame    # the same rows, stored with their prediction

    def evaluation(self) -> DataFrame:
        """``(label, predicted, train_rows, test_rows)``: every label by every label, counted over both sides."""
        scored = self.scored.select("label", F.col("prediction").cast("int").alias("predicted"), "in_test")
        counts = scored.groupBy("label", "predicted").agg(F.count_if(~F.col("in_test")).alias("train_rows"),
                                                          F.count_if("in_test").alias("test_rows"))
        labels = F.array(*[F.lit(v) for v in sorted(LABELS.values())])
        pairs = (self.scored.sparkSession.range(1).select(F.explode(labels).alias("label"))
                 .select("label", F.explode(labels).alias("predicted")))
        return pairs.join(counts, ["label", "predicted"], "left").na.fill(0, ["train_rows", "test_rows"])

    def predicts_alike(self, other: PipelineModel) -> bool:
        """Whether another model (this one, saved and loaded) predicts every feature row like this one."""
        first = self.scored.select(*FEATURES, F.col("prediction").alias("first"))
        # counted, not asked for a first row: that would go through the partitions a few at a time
        return other.transform(first).where(~F.col("prediction").eqNullSafe(F.col("first"))).count() == 0


def outcome_pipeline(num_trees: int = 100, seed: int = 42) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(FEATURES), outputCol="features"),
        RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees, seed=seed),
    ])


def train_outcome_model(features: DataFrame, *, num_trees: int = 100, seed: int = 42,
                        save_to: str | None = None) -> tuple[TrainedModel, DataFrame]:
    """Fit on the rows not held out, accuracy on those that are (column ``in_test``); optionally save.

    Returns the trained model summary and the test predictions.

    The feature rows are written once as Parquet into the shared folder: the
    forest's passes then read that table instead of re-running the lineage
    from the source, and a lost executor costs only its tasks of the pass in
    flight. Every row is scored once, into a second such table, from which
    accuracy, evaluation and counts are taken.
    """
    from ..session import scratch_table
    features = scratch_table(features, "features")
    train, test = features.where(~F.col("in_test")), features.where("in_test")
    if train.isEmpty():
        raise NoTrainingRows("no training rows after the split")
    model = outcome_pipeline(num_trees, seed).fit(train)
    scored = scratch_table(model.transform(features).select(*features.columns, "prediction"), "scored")
    predictions = scored.where("in_test")
    accuracy = (float("nan") if predictions.isEmpty() else
                MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy").evaluate(predictions))
    if save_to:
        model.write().overwrite().save(save_to)
    return TrainedModel(model, accuracy, train.count(), test.count(), features, scored), predictions
