"""Baselines and gaps of a series of (time, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.written import cut


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """One row: r2, mape (over the signed actual value, in percent), mse and rmse, over rows that have both."""
    y, p = F.col(actual), F.col(predicted)
    both = df.filter(y.isNotNull() & p.isNotNull())
    mse = F.avg((y - p) * (y - p))
    return both.agg((1 - mse / F.var_pop(y)).alias("r2"), (F.avg(F.abs(y - p) / F.nullif(y, F.lit(0.0))) * 100).alias("mape"), mse.alias("mse"), F.sqrt(mse).alias("rmse"))


def lag_prediction(df: DataFrame, time: str, value: str, series: str | None = None) -> DataFrame:
    """Each value predicted by the one before it, of its own series if there are several; the first row has none and goes.

    Without ``series`` all rows are one series: Spark deals them into ranges of time and sorts each; the last value of the range before
    is carried over its border, one row a range.
    """
    if series:
        over = Window.partitionBy(series).orderBy(time, value)
        return df.withColumn("pred", F.lag(value, 1).over(over)).withColumn("_n", F.row_number().over(over)).filter("_n > 1").drop("_n")
    dealt = cut(df.repartitionByRange(time, value).withColumn("_range", F.spark_partition_id()))
    last = dealt.groupBy("_range").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(time, value)).alias("_last"))
    before = last.select("_range", F.lag("_last").over(Window.orderBy("_range")).alias("_before"))
    over = Window.partitionBy("_range").orderBy(time, value)
    own = dealt.withColumn("_own", F.lag(F.struct(F.col(value).alias("v")), 1).over(over)).join(F.broadcast(before), "_range")
    return own.withColumn("_p", F.coalesce("_own", "_before")).filter("_p IS NOT NULL").withColumn("pred", F.col("_p.v")).drop("_range", "_own", "_before", "_p")


def mean_prediction(train: DataFrame, test: DataFrame, value: str) -> DataFrame:
    """The mean of the training values predicts every test row."""
    return test.withColumn("pred", F.lit(train.agg(F.avg(value)).first()[0]).cast("double"))


def baseline_table(train: DataFrame, test: DataFrame, time: str, value: str, series: str | None = None) -> DataFrame:
    """Metrics of the mean and lag models on test, lag on train (within ``series`` if given), with the coefficient of variation of each set."""
    def row(df: DataFrame, name: str, values: DataFrame) -> DataFrame:
        cv = values.agg(variation(F.col(value)).alias("cv")).first()["cv"]
        return regression_metrics(df, value, "pred").withColumn("model", F.lit(name)).withColumn("cv", F.lit(cv).cast("double"))

    return row(mean_prediction(train, test, value), "mean_test", test).unionByName(row(lag_prediction(test, time, value, series), "lag_test", test)).unionByName(row(lag_prediction(train, time, value, series), "lag_train", train))


def variation(c: Column) -> Column:
    """Population standard deviation over the mean."""
    return F.stddev_pop(c) / F.avg(c)


def fill_gaps(df: DataFrame, time: str, hours: int = 4) -> DataFrame:
    """A row for every ``hours`` from the first time to the last; missing ones are null, and times off the grid vanish."""
    grid = df.agg(F.min(time).alias("a"), F.max(time).alias("b")).filter("a IS NOT NULL").select(F.explode(F.sequence("a", "b", F.expr(f"interval {int(hours)} hours"))).alias(time))
    return grid.join(df, time, "left")


def after(df: DataFrame, time: str, least: str | None = None) -> DataFrame:
    """The rows later than a time: what a chart from there on shows."""
    return df if least is None else df.filter(F.col(time) > F.lit(least).cast("timestamp"))
