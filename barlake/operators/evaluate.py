"""Supervised-set preparation and forecast evaluation over the feature view
(documented targets: time-ordered split, naive baseline, error metrics,
directional accuracy, top movers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def supervised_set(features: DataFrame, target: str = "target_next_close") -> DataFrame:
    """Feature rows that have a label."""
    return features.filter(F.col(target).isNotNull())


def time_split_cut(df: DataFrame, date_key: str = "date_key", fraction: float = 0.8) -> DataFrame:
    """One-row cut: the ``fraction`` discrete percentile of distinct dates."""
    return (
        df.select(date_key).distinct()
        .agg(F.expr(f"percentile_disc({fraction}) WITHIN GROUP (ORDER BY {date_key})").cast("int").alias("cut_key"))
    )


def time_split(df: DataFrame, date_key: str = "date_key", fraction: float = 0.8) -> DataFrame:
    """Label rows train (date <= cut) / test, ordered in time — no random split.
    The cut (one number from an aggregate over distinct dates) becomes a literal."""
    cut = time_split_cut(df, date_key, fraction).first()["cut_key"]
    return df.withColumn("cut_key", F.lit(cut).cast("int")).withColumn(
        "split", F.when(F.col(date_key) <= F.col("cut_key"), "train").otherwise("test")
    )


def error_metrics(df: DataFrame, keys, y: str, yhat: str, digits: int = 6) -> DataFrame:
    """MSE, RMSE, MAE (grouped; partial aggregation)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    err = F.col(y) - F.col(yhat)
    agg = df.filter(F.col(y).isNotNull() & F.col(yhat).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.avg(err * err).alias("_mse"),
        F.avg(F.abs(err)).alias("_mae"),
    )
    return agg.select(
        *keys, "n",
        F.round("_mse", digits).alias("mse"),
        F.round(F.sqrt("_mse"), digits).alias("rmse"),
        F.round("_mae", digits).alias("mae"),
    )


def directional_accuracy(df: DataFrame, keys, actual: str, predicted: str, base: str,
                         digits: int = 9) -> DataFrame:
    """Share of rows where sign(actual - base) == sign(predicted - base)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    hit = F.when(F.signum(F.col(actual) - F.col(base)) == F.signum(F.col(predicted) - F.col(base)), 1).otherwise(0)
    return (
        df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull() & F.col(base).isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).cast("long").alias("n"), F.round(F.avg(hit.cast("double")), digits).alias("directional_accuracy"))
    )


def top_k_per_group(df: DataFrame, group, order, k: int = 3, rank_col: str = "rank") -> DataFrame:
    """Top-k rows per group (``order``: columns, descending first entry wins).
    ``row_number() <= k`` is planned with a partial WindowGroupLimit, so each
    task forwards at most k rows per group to the shuffle."""
    group = [group] if isinstance(group, str) else list(group)
    spec = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(spec)).filter(F.col(rank_col) <= k)
