"""Raw detail lines to a fitted and evaluated price model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestead.functions.casts import cast_columns
from lodestead.functions.text import clean_category, normalise
from lodestead.operators import features as fx
from lodestead.operators import model as mx
from lodestead.operators.details import flat_rows
from lodestead.operators.filters import drop_incomplete
from lodestead.operators.keys import one_per_key
from lodestead.operators.projections import present_columns
from lodestead.session import written_once

# Column types of the staging cleaner.
CLEANER_TYPES = {
    "totalPriceValue": "double",
    "areaInSquareMeters": "double",
    "dateCreated": "timestamp",
    "dateCreatedFirst": "timestamp",
    "isPrivateOwner": "boolean",
    "totalPossibleImages": "long",
}


def clean_staging(
    df: DataFrame, key: str = "slug", sort: str = "dateCreated", tie_break: Sequence[str] = (),
    types: Mapping[str, str] = CLEANER_TYPES, target: str = "totalPriceValue",
    required: Sequence[str] = ("areaInSquareMeters", "city", "province"),
    names: Sequence[str] = ("city", "province"),
    categories: Sequence[str] = ("estate", "transaction", "roomsNumber", "floorNumber"),
) -> DataFrame:
    """Dedup, types, missing values, names, categories, in this order."""
    out = one_per_key(df, key, sort, "last", tie_break)
    out = cast_columns(out, types)
    out = drop_incomplete(out, target, required)
    out = out.withColumns({c: normalise(F.col(c)) for c in names if c in out.columns})
    return out.withColumns({c: clean_category(F.col(c)) for c in categories if c in out.columns})


def model_columns(flat: DataFrame) -> DataFrame:
    """The columns of flat rows that the model table reads; text that only people read is left out."""
    return flat.select(*present_columns(flat, fx.MODEL_COLUMNS))


def train_price_model(
    lines: DataFrame, max_iter: int = 1000, vocabulary: DataFrame | None = None, hashed: Mapping[str, int] | None = None,
    means: Sequence[str] = (),
) -> tuple[PipelineModel, DataFrame]:
    """Fit on 80 % of the ads; metrics for both parts of the split.

    The features of ads are one sparse vector by ``vocabulary``; give one
    (``features.feature_index``) to use the model on other rows or to name its
    importances.  Wide categories are put into ``means`` or ``hashed``
    (:func:`model.fit_boosted_trees`).  The training rows are written once: the
    lines are parsed for them, not again for each step of the fit.
    """
    rows = mx.training_rows(fx.model_table(written_once(model_columns(flat_rows(lines)), "flat-rows"), sparse=True, vocabulary=vocabulary))
    rows = written_once(rows, "training-rows")
    rows = rows.withColumn("is_test", fx.in_test_split(F.col("ad_id")))
    # Rounds stop early by part of the training ads, so the test ads stay unseen.
    rows = rows.withColumn("is_validation", ~F.col("is_test") & (fx.hash_bucket(F.concat(F.lit("v"), F.col("ad_id")), 100) < 20))
    numeric, categorical = mx.feature_columns(rows)
    fitted = mx.fit_boosted_trees(
        rows.filter(~F.col("is_test")), numeric, categorical, "price", "is_validation", max_iter,
        vectors=[c for c in (fx.VECTOR,) if c in rows.columns], hashed=hashed, means=means,
    )
    return fitted, mx.regression_metrics(fitted.transform(rows), "price", "prediction", ["is_test"])
