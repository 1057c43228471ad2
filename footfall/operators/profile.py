"""User-profile models on numeric and coded features, all fitted by MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel, NaiveBayes, NaiveBayesModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, MinMaxScalerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F

# The settings of the models.
RIDGE = 0.1
ITERATIONS = 100
SMOOTHING = 1.0
# Spark's own default for the logistic models.
TOLERANCE = 1e-6


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Every row with its feature vector; a missing feature is NaN there."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def _for_fit(df: DataFrame, cols: Sequence[str], out: str, fill: float | None) -> DataFrame:
    """Vectors to fit on: a missing feature counts as ``fill``, or fails the job where none is given."""
    whole = df if fill is None else df.na.fill(fill, list(cols))
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(whole)


def _present(col: str) -> Column:
    return F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))


def correlation(df: DataFrame, cols: Sequence[str], fill: float | None = None) -> DataFrame:
    """(a, b, corr): the Pearson matrix, one row per cell."""
    cols = list(cols)
    matrix = Correlation.corr(_for_fit(df.select(*cols), cols, "_v", fill), "_v").head()[0].toArray()
    spark = df.sparkSession
    # As many rows as the feature list squared.
    cells = [(a, b, float(matrix[i][j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return spark.createDataFrame(cells, "a string, b string, corr double")


def fit_linear(df: DataFrame, cols: Sequence[str], label: str, fill: float | None = None) -> LinearRegressionModel:
    return LinearRegression(featuresCol="_v", labelCol=label, maxIter=ITERATIONS, regParam=RIDGE).fit(
        _for_fit(df, cols, "_v", fill)
    )


def predict(model, df: DataFrame, cols: Sequence[str], features: str = "_v") -> DataFrame:
    """Every row of ``df`` with the model's columns, which are null where a feature is missing."""
    # Models may refuse NaN, so a missing feature goes in as 0 and what comes out of it is set aside.
    ready = {f"_in_{c}": F.when(_present(c), F.col(c)).otherwise(F.lit(0.0)) for c in cols}
    out = model.transform(assemble(df.withColumns(ready), list(ready), features)).drop(*ready)
    whole = reduce(lambda a, b: a & b, (_present(c) for c in cols))
    added = [c for c in out.columns if c not in df.columns and c != features]
    return out.withColumns({c: F.when(whole, F.col(c)) for c in added}).drop(features)


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: mse, rmse, r2, mae. Two aggregates over the data, nothing collected."""
    y, e = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction)
    sums = pred.agg(
        F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"), F.var_pop(y).alias("_var")
    )
    return sums.select("mse", F.sqrt("mse").alias("rmse"), (1 - F.col("mse") / F.col("_var")).alias("r2"), "mae")


def fit_churn(
    df: DataFrame, cols: Sequence[str], label: str = "label", fill: float | None = None, tol: float = TOLERANCE
) -> LogisticRegressionModel:
    return LogisticRegression(featuresCol="_v", labelCol=label, regParam=RIDGE, maxIter=ITERATIONS, tol=tol).fit(
        _for_fit(df, cols, "_v", fill)
    )


def fit_traits(df: DataFrame, cols: Sequence[str], label: str = "label", fill: float | None = None) -> NaiveBayesModel:
    return NaiveBayes(featuresCol="_v", labelCol=label, smoothing=SMOOTHING).fit(_for_fit(df, cols, "_v", fill))


def trait_counts(df: DataFrame, cols: Sequence[str], label: str = "label") -> DataFrame:
    """(label, feature, rows, total): the sums a multinomial Bayes model is fitted from."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols])
    return (
        df.select(F.col(label).alias("label"), F.inline(pairs))
        .groupBy("label", "feature")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("v").alias("total"))
    )


def fit_scaler(train: DataFrame, cols: Sequence[str]) -> MinMaxScalerModel:
    return MinMaxScaler(inputCol="_raw", outputCol="_scaled").fit(_for_fit(train, cols, "_raw", None))


def minmax(train: DataFrame, test: DataFrame, cols: Sequence[str], suffix: str = "_norm") -> DataFrame:
    """``test`` with every column scaled by the range seen in ``train``; a missing value stays missing."""
    scaled = fit_scaler(train, cols).transform(assemble(test, cols, "_raw"))
    items = vector_to_array("_scaled")
    return scaled.withColumns({c + suffix: F.when(_present(c), items[i]) for i, c in enumerate(cols)}).drop("_raw", "_scaled")


def fit_gender(
    df: DataFrame, categories: Sequence[str], amounts: Sequence[str], label: str = "label", tol: float = TOLERANCE
) -> tuple[PipelineModel, PipelineModel]:
    """Two models of one trait: Bayes on category codes, and scaled amounts into a logistic model.

    The scaler belongs to the fitted model, so new rows are scaled by the training range.
    """
    by_category = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(categories), outputCol="_cat"),
            NaiveBayes(featuresCol="_cat", labelCol=label, smoothing=SMOOTHING),
        ]
    )
    by_amount = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(amounts), outputCol="_amt"),
            MinMaxScaler(inputCol="_amt", outputCol="_amt_norm"),
            LogisticRegression(featuresCol="_amt_norm", labelCol=label, regParam=RIDGE, maxIter=ITERATIONS, tol=tol),
        ]
    )
    return by_category.fit(df), by_amount.fit(df)


def _vectors(df: DataFrame, vec: str) -> DataFrame:
    return df.withColumn("_v", array_to_vector(F.col(vec).cast("array<double>")))


def fit_binary(df: DataFrame, vec: str, label: str, tol: float = TOLERANCE) -> LogisticRegressionModel:
    """Logistic model on an array column, for a 0/1 label."""
    return LogisticRegression(featuresCol="_v", labelCol=label, regParam=RIDGE, maxIter=ITERATIONS, tol=tol).fit(_vectors(df, vec))


def predict_binary(model: LogisticRegressionModel, df: DataFrame, vec: str) -> DataFrame:
    """``df`` with the columns of a model of ``fit_binary``."""
    return model.transform(_vectors(df, vec)).drop("_v")


def split(df: DataFrame, id_col: str, frac: float = 0.8, seed: str = "") -> tuple[DataFrame, DataFrame]:
    """Repeatable random split: a hash of the id decides, so a row is always on the same side."""
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col(id_col).cast("string"))), 1, 8), 16, 10).cast("long")
    in_first = bucket < int(frac * (1 << 32))
    return df.where(in_first), df.where(~in_first)


def classification_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: correct, total, accuracy."""
    right = F.count_if(F.col(label) == F.col(prediction))
    return pred.agg(
        right.alias("correct"), F.count(F.lit(1)).alias("total"), (right / F.count(F.lit(1))).alias("accuracy")
    )


def area_under_roc(pred: DataFrame, label: str = "label", score: str = "rawPrediction") -> float:
    """Exact: one point of the curve per distinct score."""
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, numBins=0).evaluate(pred)
