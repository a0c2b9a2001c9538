"""Model features: counts, multi-hot columns, fills, ranks, splits, dates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestead.functions.casts import to_double
from lodestead.functions.json_text import variant_text
from lodestead.functions.names import column_name, column_name_of
from lodestead.functions.text import normalise
from lodestead.operators.keys import batch_numbers, hash_bucket
from lodestead.operators.projections import drop_columns, present_columns
from lodestead.operators.quality import exact_quantiles
from lodestead.session import scratch_path

# --- lists -----------------------------------------------------------------


def list_length(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0))


# --- multi-hot -------------------------------------------------------------

PREFIX = "feat_cat_"
INDEXES, VECTOR = "feature_indexes", "feature_vector"
_BETWEEN = "\u0001"


def label_value_pairs(json_column: str) -> Column:
    """``[{label, values: [...]}, ...]`` to a list of ``label \\u0001 value`` texts.

    Anything malformed (not a list, entry without label or values, values not
    a list) is passed over.
    """
    entries = F.try_variant_get(F.try_parse_json(json_column), "$", "array<variant>")

    def texts(e: Column) -> Column:
        label = F.try_variant_get(e, "$.label", "string")
        values = F.try_variant_get(e, "$.values", "array<variant>")
        return F.transform(
            F.when(label.isNotNull(), values), lambda v: F.concat(label, F.lit(_BETWEEN), variant_text(v))
        )

    lists = F.filter(F.transform(entries, texts), lambda t: t.isNotNull())
    return F.coalesce(F.array_distinct(F.flatten(lists)), F.array().cast("array<string>"))


def _pair_column(pair: str, name: Callable[[object], str] = column_name) -> str:
    label, value = pair.split(_BETWEEN, 1)
    return f"{PREFIX}{name(label)}_{name(value)}"


def feature_vocabulary(
    df: DataFrame, pairs: str, max_pairs: int | None = None, name: Callable[[object], str] = column_name
) -> dict[str, list[str]]:
    """Column name -> the raw pairs that map to it, for the form with a column for each: the driver gets its schema.

    A caller who wants a narrow schema or none gives ``max_pairs``; more pairs
    are then an error.  :func:`feature_index` and :func:`features_long` collect nothing.
    """
    distinct = df.select(F.explode(pairs).alias("pair")).distinct()
    found = distinct.collect() if max_pairs is None else distinct.limit(max_pairs + 1).collect()
    if max_pairs is not None and len(found) > max_pairs:
        raise ValueError(f"more than {max_pairs} distinct features; use features_long")
    vocabulary: dict[str, list[str]] = {}
    for (pair,) in sorted(found):
        vocabulary.setdefault(_pair_column(pair, name), []).append(pair)
    return dict(sorted(vocabulary.items()))


def multi_hot(df: DataFrame, pairs: str, vocabulary: Mapping[str, Sequence[str]]) -> DataFrame:
    """One 0/1 column per vocabulary entry; any of its raw pairs sets it.

    A row expression: nothing is exploded, pivoted or shuffled.
    """
    hot = {
        name: F.coalesce(F.arrays_overlap(F.col(pairs), F.array(*[F.lit(p) for p in raw])), F.lit(False)).cast("int")
        for name, raw in vocabulary.items()
    }
    return df.select("*", *[c.alias(n) for n, c in hot.items()])


def features_long(df: DataFrame, key: str, pairs: str) -> DataFrame:
    """Distinct (key, feature column) rows for vocabularies too wide for columns."""
    exploded = df.select(key, F.explode(pairs).alias("pair")).distinct()
    return exploded.join(_named_pairs(exploded), "pair").select(key, "feature").distinct()


def _named_pairs(exploded: DataFrame) -> DataFrame:
    """(pair, feature column) for each distinct pair."""
    parts = F.split("pair", _BETWEEN, 2)
    return exploded.select("pair").distinct().select(
        "pair",
        F.concat(F.lit(PREFIX), column_name_of(parts[0]), F.lit("_"), column_name_of(parts[1])).alias("feature"),
    )


def feature_index(df: DataFrame, pairs: str) -> DataFrame:
    """The vocabulary as a table (pair, feature, index), of any width; nothing is collected.

    Its pairs are kept in the scratch folder.  Features are numbered from 0 without gaps, pairs of one feature alike.
    """
    spark = df.sparkSession
    named = _named_pairs(df.select(F.explode(pairs).alias("pair")))
    path = scratch_path(spark, "feature-pairs")
    named.write.parquet(path)
    named = spark.read.schema(named.schema).parquet(path)
    numbers = batch_numbers(named, "feature", 1, "index")
    return named.join(numbers, "feature").select("pair", "feature", F.col("index").cast("int").alias("index"))


def _distinct_lists(df: DataFrame, pairs: str, vocabulary: DataFrame) -> DataFrame:
    """(list, sorted indexes of its features) for each distinct list that has one of the vocabulary."""
    lists = df.select(F.col(pairs).alias("_list")).distinct()
    met = lists.select("_list", F.explode("_list").alias("pair")).join(vocabulary.select("pair", "index"), "pair")
    return met.groupBy("_list").agg(F.array_sort(F.collect_set("index")).alias(INDEXES))


def multi_hot_indexes(df: DataFrame, pairs: str, vocabulary: DataFrame) -> DataFrame:
    """Adds the sorted indexes of the row's features as ``feature_indexes``, the sparse form of :func:`multi_hot`."""
    joined = df.join(_distinct_lists(df, pairs, vocabulary), F.col(pairs) == F.col("_list"), "left")
    return joined.select(*df.columns, F.coalesce(INDEXES, F.array().cast("array<int>")).alias(INDEXES))


def multi_hot_vector(df: DataFrame, pairs: str, vocabulary: DataFrame) -> DataFrame:
    """Adds the 0/1 features as the sparse vector ``feature_vector``; only their number reaches the driver.

    A count vectoriser whose terms are the features' numbers makes the vector
    in the JVM, by one expression for any number of features.
    """
    size = (vocabulary.agg(F.max("index")).first()[0] or 0) + 1
    terms = [str(i) for i in range(size)]
    vectors = CountVectorizerModel.from_vocabulary(terms, "_terms", VECTOR, binary=True)
    indexed = multi_hot_indexes(df, pairs, vocabulary)
    made = vectors.transform(indexed.withColumn("_terms", F.transform(INDEXES, lambda i: i.cast("string"))))
    # Not the names of all entries, which are their numbers.
    return made.select(*df.columns, F.col(VECTOR).alias(VECTOR, metadata={"ml_attr": {"num_attrs": size}}))


def raw_pairs(vocabulary: DataFrame) -> dict[str, list[str]]:
    """Column name -> its raw pairs, of a vocabulary that is a table."""
    out: dict[str, list[str]] = {}
    for feature, pair in sorted(map(tuple, vocabulary.select("feature", "pair").distinct().collect())):
        out.setdefault(feature, []).append(pair)
    return out


# --- fills and ranks -------------------------------------------------------


def fill_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
         for c, v in values.items() if c in present_columns(df, list(values))}
    )


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls become the exact median of the column; text is read as a number first."""
    numbers = df.withColumns({c: to_double(F.col(c)) for c in columns if dict(df.dtypes)[c] == "string"})
    medians = exact_quantiles(numbers, columns, [0.5])
    return numbers.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c][0.5]).cast("double")) for c in columns}
    )


# Energy certificates from lowest to highest.
ENERGY_ORDER = (
    "isento", "excluído", "em processo", "sem certificado",
    "g", "f", "e", "d", "c", "b", "b-", "a", "a+",
)


def ordinal_rank(c: Column, order: Sequence[str] = ENERGY_ORDER) -> Column:
    """1-based place in the order; 0 for unknown or missing."""
    return F.coalesce(F.array_position(F.array(*[F.lit(v) for v in order]), normalise(c)), F.lit(0)).cast("int")


# Names of the ground floor.
GROUND_FLOOR = ("rés do chão", "r/c", "ground_floor", "ground floor")


def floor_number(c: Column) -> Column:
    """Floor as a number; the ground floor is 0."""
    return F.when(normalise(c).isin(*GROUND_FLOOR), F.lit(0.0)).otherwise(to_double(c))


def floor_category(c: Column) -> Column:
    """Floor as a category: ground, numbered, or the cleaned text."""
    number = to_double(c)
    text = F.nullif(normalise(c), F.lit(""))
    return F.when(normalise(c).isin(*GROUND_FLOOR), "0").otherwise(
        F.coalesce(number.cast("bigint").cast("string"), text)
    )


def in_test_split(key: Column, percent: int = 20) -> Column:
    """The same rows on every run and layout, unlike a random split."""
    return hash_bucket(key, 100) < percent


# --- dates -----------------------------------------------------------------


def day_of_week(d: Column) -> Column:
    """Monday is 0."""
    return F.weekday(d)


def days_on_market(first_seen: Column, loaded: Column) -> Column:
    return F.datediff(loaded, first_seen)


# --- training table --------------------------------------------------------

# Flat-row columns that feed the model table.
MODEL_COLUMNS = (
    "ad_id", "price", "area", "area_unit", "rooms_num_clean", "rooms_num_raw", "bathrooms_num", "build_year",
    "construction_status", "floor_no", "ad_category_name", "ad_category_type", "latitude", "longitude",
    "location_address_city", "location_address_county", "location_address_province", "location_parish_full",
    "features", "features_by_category", "energy_certificate", "heating", "windows_type", "advertiser_type",
    "image_urls",
)
# Columns not wanted in training; constants for missing values; feature kinds.
DROPPED_COLUMNS = (
    "ad_category_type", "construction_status", "features_count", "area_unit", "rooms_num_raw",
    "location_parish_full", "image_count",
)
FILLS = {"floor_no": 0, "build_year": "unknown", "heating": "unknown", "windows_type": "unknown"}
NUMBERS = ("area", "bathrooms_num", "floor_no", "latitude", "longitude", "rooms_num_clean")
CATEGORIES = (
    "location_address_province", "location_address_county", "location_address_city", "advertiser_type",
    "ad_category_name", "heating", "windows_type", "build_year",
)


def model_table(flat: DataFrame, sparse: bool = False, vocabulary: DataFrame | None = None) -> DataFrame:
    """Flat rows to the model table: list counts and multi-hot columns, row key kept.

    ``sparse`` gives the features as one vector, for vocabularies too wide for
    columns.  ``vocabulary`` is that of an earlier table (:func:`feature_index`),
    by default that of these rows.
    """
    kept = flat.select(*present_columns(flat, MODEL_COLUMNS))
    counted = kept.withColumns(
        {
            "image_count": list_length(F.col("image_urls")) if "image_urls" in kept.columns else F.lit(0),
            "features_count": list_length(F.col("features")) if "features" in kept.columns else F.lit(0),
        }
    )
    if "features_by_category" in kept.columns:
        paired = counted.withColumn("_pairs", label_value_pairs("features_by_category"))
        if sparse:
            counted = multi_hot_vector(paired, "_pairs", feature_index(paired, "_pairs") if vocabulary is None else vocabulary)
        else:
            counted = multi_hot(paired, "_pairs", feature_vocabulary(paired, "_pairs") if vocabulary is None else raw_pairs(vocabulary))
    return drop_columns(counted, ["image_urls", "features", "features_by_category", "_pairs"])
