"""Price regression with Spark ML, and its metrics as plain aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.functions.casts import to_double
from lodestead.functions.text import bedrooms_from_typology
from lodestead.operators import features as fx
from lodestead.operators.filters import numeric_target
from lodestead.session import scratch_path, scratch_root


def training_rows(df: DataFrame, target: str = "price") -> DataFrame:
    """Model table to training rows: drops, fills, numbers, rank, numeric target."""
    out = fx.drop_columns(df, fx.DROPPED_COLUMNS)
    numbers = {
        c: fx.floor_number(F.col(c)) if c == "floor_no"
        else bedrooms_from_typology(F.col(c)).cast("double") if c == "rooms_num_clean"
        else to_double(F.col(c))
        for c in fx.NUMBERS
        if c in out.columns
    }
    texts = {c: F.col(c).cast("string") for c in fx.CATEGORIES if c in out.columns}
    out = numeric_target(out.withColumns({**numbers, **texts}), target)
    out = fx.fill_constants(out, {c: v for c, v in fx.FILLS.items() if c in out.columns})
    if "bathrooms_num" in out.columns:
        out = fx.fill_median(out, ["bathrooms_num"])
    if "energy_certificate" in out.columns:
        out = out.withColumn("energy_certificate", fx.ordinal_rank(F.col("energy_certificate")))
    return out


def feature_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature columns that the frame has."""
    numeric = [c for c in (*fx.NUMBERS, "energy_certificate") if c in df.columns]
    hot = [c for c in df.columns if c.startswith(fx.PREFIX)]
    return numeric + hot, [c for c in fx.CATEGORIES if c in df.columns]


def fit_boosted_trees(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
    validation: str | None = None, max_iter: int = 1000, max_categories: int = 10_000,
    step_size: float = 0.05, max_depth: int = 5, tolerance: float = 0.01, seed: int = 42,
    vectors: Sequence[str] = (), hashed: Mapping[str, int] | None = None, means: Sequence[str] = (),
    smoothing: float = 0.0,
) -> PipelineModel:
    """Index the categories, assemble the vector, fit the trees.

    ``validation`` names a boolean column whose true rows stop the boosting
    early.  The trees try the labels of a category one by one, so their number
    is checked.  A category of more goes into ``means``, where each label
    stands for the mean of the target over its training rows and an unseen one
    for the mean of all, or into ``hashed``, which puts it into so many buckets
    by its hash.  ``vectors`` are vector columns, which come after all others.
    """
    spark = train.sparkSession
    hashed = {c: n for c, n in (hashed or {}).items() if c in categorical}
    means = [c for c in means if c in categorical and c not in hashed]
    categorical = [c for c in categorical if c not in hashed and c not in means]
    bins = 32
    if categorical:
        row = train.agg(*[F.approx_count_distinct(c).alias(c) for c in categorical]).first()
        widest = max(row)
        if widest > max_categories:
            raise ValueError(f"a category has about {widest} values, more than {max_categories}; name it in means or hashed")
        bins = max(bins, int(widest * 1.2) + 2)
    _use_checkpoints(spark)
    indexed = [f"{c}_index" for c in categorical]
    stages = [_known_numbers(numeric)]
    if hashed:
        buckets = ", ".join(f"cast(pmod(xxhash64(`{c}`), {n}) as double) AS `{c}_index`" for c, n in hashed.items())
        stages.append(SQLTransformer(statement=f"SELECT *, {buckets} FROM __THIS__"))
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"))
    stages += mean_stages(means, target, smoothing)
    inputs = [*[_KNOWN + c for c in numeric], *indexed, *[f"{c}_index" for c in hashed], *[f"{c}{_MEAN}" for c in means], *vectors]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features_vector"))
    trees = GBTRegressor(
        featuresCol="features_vector", labelCol=target, predictionCol="prediction", maxIter=max_iter,
        stepSize=step_size, maxDepth=max_depth, subsamplingRate=0.8, featureSubsetStrategy="0.8", maxBins=bins,
        checkpointInterval=10, seed=seed, validationTol=tolerance,
    )
    if validation:
        trees = trees.setValidationIndicatorCol(validation)
    stages.append(trees)
    return Pipeline(stages=stages).fit(train)


#: Ending of the column that stands for a category by the mean of its labels.
_MEAN = "_mean"
_NULL = "\u0001"


def mean_stages(columns: Sequence[str], target: str, smoothing: float = 0.0) -> list:
    """Stages that add ``<column>_mean``: the mean of the target over a label's rows.

    ``smoothing`` draws the means of rare labels to that of all rows.  A null is
    a label; one that was not seen has the mean of all.
    """
    if not columns:
        return []
    # Null becomes a text of its own, so that it is joined like any label.
    texts = ", ".join(f"coalesce(cast(`{c}` AS string), '{_NULL}') AS `{c}_text`" for c in columns)
    return [SQLTransformer(statement=f"SELECT *, {texts} FROM __THIS__"), *[_MeanEncoder(c, target, smoothing) for c in columns]]


class _MeanEncoder(Estimator):
    """What Spark ML's ``TargetEncoder`` learns, for any number of labels.

    The labels are not held by the driver nor tried one by one: they are a
    table in the scratch folder, which the fitted stage joins.
    """

    def __init__(self, column: str, target: str, smoothing: float):
        super().__init__()
        self.column, self.target, self.smoothing = column, target, smoothing

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        rows = dataset.select(F.col(f"{self.column}_text").alias("label"), F.col(self.target).cast("double").alias("value"))
        rows = rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))
        spark, path = dataset.sparkSession, scratch_path(dataset.sparkSession, "means")
        rows.groupBy("label").agg(F.count("*").alias("rows"), F.sum("value").alias("total")).write.parquet(path)
        every = spark.read.parquet(path).agg(F.sum("total") / F.sum("rows")).first()[0]
        overall = "CAST(NULL AS DOUBLE)" if every is None else f"CAST('{every!r}' AS DOUBLE)"
        share = f"(`_m`.rows / (`_m`.rows + {float(self.smoothing)!r}D))"
        mean = f"{share} * (`_m`.total / `_m`.rows) + (1 - {share}) * {overall}"
        return SQLTransformer(
            statement=f"SELECT `_t`.*, CASE WHEN `_m`.label IS NULL THEN {overall} ELSE {mean} END AS `{self.column}{_MEAN}` "
            f"FROM __THIS__ AS `_t` LEFT JOIN parquet.`{path}` AS `_m` ON `_t`.`{self.column}_text` = `_m`.label"
        )


def category_means(train: DataFrame, column: str, target: str, smoothing: float = 0.0) -> DataFrame:
    """(column, mean) of every label, as the encoder of :func:`mean_stages` has learnt them."""
    fitted = Pipeline(stages=mean_stages([column], target, smoothing)).fit(train)
    return fitted.transform(train.select(column).distinct()).select(column, F.col(f"{column}{_MEAN}").alias("mean"))


# The trees take no missing numbers.  A value below all others lets a split set them apart.
_KNOWN = "known_"
_MISSING = -1e9


def _known_numbers(numeric: Sequence[str]) -> SQLTransformer:
    known = ", ".join(f"coalesce(nanvl(cast(`{c}` as double), null), {_MISSING}D) AS `{_KNOWN}{c}`" for c in numeric)
    return SQLTransformer(statement=f"SELECT *, {known} FROM __THIS__")


def _use_checkpoints(spark: SparkSession) -> None:
    """Boosting cuts its lineage every few rounds, in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))


def feature_importances(
    model: PipelineModel, n: int | None = 20, vocabulary: DataFrame | None = None
) -> list[tuple[str, float]]:
    """The ``n`` most important features, by share of impurity gain.

    Entries of a sparse vector are named by ``vocabulary``, else by their place.
    """
    columns = model.stages[-2].getInputCols()
    names = [c.removeprefix(_KNOWN).removesuffix("_index").removesuffix(_MEAN) for c in columns if c != fx.VECTOR]
    gains = model.stages[-1].featureImportances.toArray().tolist()
    if fx.VECTOR in columns:
        names += [f"{fx.VECTOR}[{i}]" for i in range(len(gains) - len(names))]
    best = sorted(zip(names, gains), key=lambda p: (-p[1], p[0]))[:n]
    if vocabulary is not None:
        entry = F.concat(F.lit(fx.VECTOR + "["), F.col("index"), F.lit("]"))
        known = vocabulary.select(entry.alias("entry"), "feature").filter(entry.isin([c for c, _ in best])).distinct().collect()
        told = dict(map(tuple, known))
        best = [(told.get(c, c), gain) for c, gain in best]
    return best


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE and R2, optionally per group, in one aggregate."""
    error = F.col(actual) - F.col(predicted)
    told = F.when(error.isNotNull(), F.col(actual))  # rows without a prediction count nowhere
    return (
        df.groupBy(*by)
        .agg(
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(F.abs(error)).alias("mae"),
            F.sum(error * error).alias("_rest"),
            (F.var_pop(told) * F.count(told)).alias("_total"),
        )
        .withColumn("r2", 1 - F.try_divide("_rest", "_total"))
        .drop("_rest", "_total")
    )
