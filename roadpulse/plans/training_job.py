"""The training run over the processed table, and evaluation of the saved models."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.ml import evaluate, train
from roadpulse.ml.features import training_rows
from roadpulse.ml.score import arranged, score
from roadpulse.session import as_of_column, prepare
from roadpulse.sources.tables import read_processed
from roadpulse.streaming.processing import TablePaths

TRAINING_DAYS = 30
EVALUATION_DAYS = 7


def run_training(
    spark: SparkSession, paths: TablePaths, model_path: str, as_of=None, days: int = TRAINING_DAYS, **options
) -> train.TrainedModels:
    """Scan, train and save; refuses when there are too few rows."""
    prepare(spark)
    rows = read_processed(spark, paths.processed, as_of, 24 * days)
    models = train.train(rows, as_of, days, **options)
    train.save(models, spark, model_path)
    return models


def run_evaluation(
    spark: SparkSession,
    paths: TablePaths,
    model_path: str,
    as_of=None,
    days: int = EVALUATION_DAYS,
    unseen_only: bool = True,
) -> DataFrame:
    """Report over the recent window; rows the models were trained on are left out."""
    prepare(spark)
    models = train.load(spark, model_path)
    rows = training_rows(read_processed(spark, paths.processed, as_of, 24 * days))
    if unseen_only:
        last_seen = models.metadata["congestion_classifier"]["max_processed_at"]
        rows = rows.where(F.col("processed_at") > as_of_column(last_seen))
    return evaluate.evaluation_report(score(arranged(rows), models))
