"""Detail pages to staging rows and to flat training rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestead import schemas
from lodestead.functions import casts
from lodestead.functions.html import html_to_line, html_to_lines
from lodestead.functions.json_text import line_states, repair_surrogates, variant_list_text
from lodestead.functions.text import (
    amenity_columns,
    bedrooms_from_text,
    bedrooms_from_typology,
    clean_suffix,
)

_NO_TEXTS = "array<string>"


def last_entry(characteristics: Column, key: str, value: str) -> Column:
    """Field of the last entry with this key, null when there is none."""
    from_end = F.array_position(F.reverse(characteristics["key"]), key)
    at = F.size(characteristics) - from_end.cast("int")
    return F.when(from_end > 0, F.get(characteristics[value], at))


def last_parsed(characteristics: Column, key: str, parse, value: str = "value") -> Column:
    """Last value of this key that parses; later values that do not are passed over.

    Nearly always the last entry parses, so the list is only searched further
    when it does not.
    """
    own = F.filter(characteristics, lambda c: c["key"] == key)
    parsed = F.filter(F.transform(own, lambda c: parse(c[value])), lambda v: v.isNotNull())
    return F.coalesce(
        parse(last_entry(characteristics, key, value)),
        F.when(F.array_contains(characteristics["key"], key), F.try_element_at(parsed, F.lit(-1))),
    )


def with_characteristics(ads: DataFrame, name: str = "characteristics") -> DataFrame:
    """Adds the key/value entries of ``ad`` with their values as text, and ``number``: the value where it is a JSON number.

    A column of its own, so that the entries are made once for all that look into them.
    """
    own = ads.schema["ad"].dataType["characteristics"].dataType.elementType["value"].dataType.simpleString()

    def entry(c: Column) -> Column:
        value, number = c["value"], F.lit(None).cast("double")
        if own == "variant":
            text = F.try_variant_get(value, "$", "string")
            number = F.when(F.schema_of_variant(value) != "STRING", text.try_cast("double"))
            value = text
        others = [c[k].alias(k) for k in ("key", "localizedValue", "currency", "suffix")]
        return F.struct(*others, value.alias("value"), number.alias("number"))

    return ads.withColumn(name, F.transform("ad.characteristics", entry))


def last_whole_number(characteristics: Column, key: str) -> Column:
    """Last value of this key that is a number, without its fraction, or a text of digits; 2.0 as a text is none."""
    own = F.filter(characteristics, lambda c: c["key"] == key)
    whole = F.transform(own, lambda c: F.coalesce(c["number"].cast("bigint"), casts.to_whole_text_number(c["value"])))
    return F.try_element_at(F.filter(whole, lambda v: v.isNotNull()), F.lit(-1))


def large_image_urls(images: Column) -> Column:
    urls = F.filter(F.transform(images, lambda i: i["large"]), lambda u: u != "")
    return F.coalesce(urls, F.array().cast(_NO_TEXTS))


def elevator_flag(additional_information: Column) -> Column:
    """The last ``lift`` entry that says yes or no decides."""
    said = F.transform(
        F.filter(additional_information, lambda i: i["label"] == "lift"),
        lambda i: F.get(i["values"], F.lit(0)),
    )
    last = F.try_element_at(F.filter(said, lambda v: v.isin("::y", "::n")), F.lit(-1))
    return last == "::y"


def parse_props(df: DataFrame, props: str) -> DataFrame:
    """Adds ``ad``: the typed payload.  Text that is not JSON gives a null one."""
    if dict(df.dtypes)[props] == "string":
        parsed = F.from_json(repair_surrogates(F.col(props)), schemas.PROPS)
        return df.withColumn("ad", parsed["pageProps"]["ad"])
    return df.withColumn("ad", F.col(props)["pageProps"]["ad"])


def stage_details(
    df: DataFrame, props: str = "props", ingestion: str = "ingestionDate", keep_category_name: bool = True
) -> DataFrame:
    """Detail payloads to the 35 staging columns.

    Every input row gives one output row; a row without a payload is all null
    apart from its empty lists.  ``keep_category_name=False`` takes the
    property type from the ad category only.
    """
    # The text needs the Python parser: compute it once, then only refer to it.
    ads = with_characteristics(parse_props(df, props)).withColumn(
        "description_text", html_to_line(F.coalesce(F.col("ad.description"), F.lit("")))
    )
    ad, text, chars = F.col("ad"), F.col("description_text"), F.col("characteristics")
    amenities = amenity_columns(text)
    typology = last_entry(chars, "rooms_num", "localizedValue")
    property_type = F.nullif(F.get(ad["category"]["name"], F.lit(0))["value"], F.lit(""))
    if not keep_category_name:
        property_type = F.lit(None).cast("string")
    date = casts.to_date(F.col(ingestion)) if ingestion in df.columns else F.lit(None).cast("date")
    columns: dict[str, Column] = {
        "id": casts.to_long(ad["id"]),
        "title": ad["title"],
        "url": ad["url"],
        "description_text": text,
        "advert_type": ad["advertType"],
        "advertiser_type_detail": ad["advertiserType"],
        "status": ad["status"],
        "created_at": casts.to_timestamp(ad["createdAt"]),
        "modified_at": casts.to_timestamp(ad["modifiedAt"]),
        "property_type": F.coalesce(property_type, ad["adCategory"]["name"]),
        "transaction_type": ad["adCategory"]["type"],
        "price": last_parsed(chars, "price", casts.to_double),
        "price_currency": last_entry(chars, "price", "currency"),
        "price_period": clean_suffix(last_entry(chars, "price", "suffix")),
        "area_m2": last_parsed(chars, "m", casts.to_double),
        "typology": typology,
        "bedrooms": F.coalesce(
            last_parsed(chars, "rooms_num", bedrooms_from_typology, "localizedValue"), bedrooms_from_text(text)
        ),
        "energy_certificate": last_entry(chars, "energy_certificate", "localizedValue"),
        "bathrooms": last_whole_number(chars, "bathrooms_num"),
        "address_city": ad["location"]["address"]["city"]["name"],
        "address_county": ad["location"]["address"]["county"]["name"],
        "address_district": ad["location"]["address"]["province"]["name"],
        "latitude": ad["location"]["coordinates"]["latitude"],
        "longitude": ad["location"]["coordinates"]["longitude"],
        "contact_name": ad["contactDetails"]["name"],
        "contact_phone": F.get(ad["contactDetails"]["phones"], F.lit(0)),
        "image_urls": large_image_urls(ad["images"]),
        "other_features": F.struct(
            elevator_flag(ad["additionalInformation"]).alias("lift"),
            *[c.alias(name) for name, c in amenities.items()],
        ),
        "features": variant_list_text(ad["features"]),
        "featuresByCategory": variant_list_text(ad["featuresByCategory"]),
        "featuresWithoutCategory": variant_list_text(ad["featuresWithoutCategory"]),
        "map_details": ad["location"]["mapDetails"],
        "reverse_geocoding": ad["location"]["reverseGeocoding"],
        "slug": ad["slug"],
        "ingestionDate": date,
    }
    return ads.select(*[c.alias(name) for name, c in columns.items()])


def with_file_date(df: DataFrame, column: str = "ingestionDate", path: Column | None = None) -> DataFrame:
    """Load date from the file name of the row, or from a given path."""
    source = F.col("_metadata.file_path") if path is None else path
    return df.withColumn(column, casts.date_from_file_name(source))


# The flat row's field names and the target keys they come from.
TARGET_FIELDS = (
    ("target_price", "Price"),
    ("target_area", "Area"),
    ("target_bathrooms_num", "Bathrooms_num"),
    ("target_city", "City"),
    ("target_city_id", "City_id"),
    ("target_construction_status", "Construction_status"),
    ("target_country", "Country"),
    ("target_energy_certificate", "Energy_certificate"),
    ("target_floor_no", "Floor_no"),
    ("target_heating", "Heating"),
    ("target_offer_type", "OfferType"),
    ("target_proper_type", "ProperType"),
    ("target_province", "Province"),
    ("target_rooms_num", "Rooms_num"),
    ("target_windows_type", "Windows_type"),
    ("target_build_year", "Build_year"),
)
# Targets that are lists; their first entry is taken.
TARGET_LISTS = {
    "Bathrooms_num", "Construction_status", "Energy_certificate", "Floor_no", "Heating", "Rooms_num", "Windows_type"
}
# Flat columns read as numbers and as times.
FLAT_LONGS = ("ad_id", "owner_id")
FLAT_NUMBERS = (
    "price", "area", "bathrooms_num", "rooms_num_raw", "latitude", "longitude", "tracking_price",
    "target_price", "target_area", "target_rooms_num", "target_bathrooms_num", "build_year", "target_build_year",
)
FLAT_TIMES = ("created_at", "modified_at", "pushed_up_at")
AREA_UNIT = "m²"


def line_outcomes(df: DataFrame, line: str = "value") -> DataFrame:
    """(outcome, rows): how many lines are an ``ad``, and how many :func:`flat_rows` leaves out as ``blank``, ``bad`` or ``no ad``."""
    parsed = F.from_json(repair_surrogates(F.col(line), "?"), schemas.PAGE)["props"]["pageProps"]["ad"]
    outcome = F.when(F.col("state") != "ok", F.col("state")).when(parsed.isNull(), "no ad").otherwise("ad")
    return line_states(df, line).groupBy(outcome.alias("outcome")).agg(F.count("*").alias("rows"))


def flat_rows(df: DataFrame, line: str = "value") -> DataFrame:
    """Raw page lines to the 69-column flat row; lines without an ad are left out (:func:`line_outcomes` counts them)."""
    parsed = F.from_json(repair_surrogates(F.col(line), "?"), schemas.PAGE)
    # A filter would be moved below the projection and parse every line again.
    ads = df.select(F.explode(F.array_compact(F.array(parsed["props"]["pageProps"]["ad"]))).alias("ad"))
    ads = with_characteristics(ads)
    ad, chars = F.col("ad"), F.col("characteristics")
    target, place = ad["target"], ad["location"]
    parish = F.get(
        F.filter(place["reverseGeocoding"]["locations"], lambda p: p["locationLevel"] == "parish"), F.lit(0)
    )

    def open_json(v: Column) -> Column:
        text = F.to_json(v)
        return F.when(~text.isin("[]", "{}", "null", '""', "0", "false"), text)

    def target_field(key: str) -> Column:
        return F.get(target[key], F.lit(0)) if key in TARGET_LISTS else target[key]

    features = F.when(F.schema_of_variant(ad["features"]).like("ARRAY%"), variant_list_text(ad["features"]))
    labels = F.transform(ad["breadcrumbs"], lambda b: b["label"])
    columns: dict[str, Column] = {
        "ad_id": ad["id"],
        "slug": ad["slug"],
        "url": ad["url"],
        "title": ad["title"],
        "advertiser_type": ad["advertiserType"],
        "advert_type": ad["advertType"],
        "status": ad["status"],
        "created_at": ad["createdAt"],
        "modified_at": ad["modifiedAt"],
        "pushed_up_at": ad["pushedUpAt"],
        "description_raw": ad["description"],
        "description_clean": html_to_lines(ad["description"]),
        "price": last_entry(chars, "price", "value"),
        "price_currency": last_entry(chars, "price", "currency"),
        "price_suffix": last_entry(chars, "price", "suffix"),
        "area": last_entry(chars, "m", "value"),
        "area_unit": F.lit(AREA_UNIT),
        "rooms_num_clean": last_entry(chars, "rooms_num", "localizedValue"),
        "rooms_num_raw": last_entry(chars, "rooms_num", "value"),
        "bathrooms_num": last_entry(chars, "bathrooms_num", "value"),
        "floor_no": last_entry(chars, "floor_no", "localizedValue"),
        "energy_certificate": last_entry(chars, "energy_certificate", "localizedValue"),
        "construction_status": last_entry(chars, "construction_status", "localizedValue"),
        "build_year": last_entry(chars, "build_year", "value"),
        "heating": last_entry(chars, "heating", "localizedValue"),
        "windows_type": last_entry(chars, "windows_type", "localizedValue"),
        **{name: target_field(key) for name, key in TARGET_FIELDS},
        "features": features,
        "features_by_category": open_json(ad["featuresByCategory"]),
        "image_urls": large_image_urls(ad["images"]),
        "latitude": place["coordinates"]["latitude"],
        "longitude": place["coordinates"]["longitude"],
        "location_address_city": place["address"]["city"]["name"],
        "location_address_county": place["address"]["county"]["name"],
        "location_address_province": place["address"]["province"]["name"],
        "location_address_postal_code": place["address"]["postalCode"],
        "location_parish_full": parish["fullName"],
        "owner_id": ad["owner"]["id"],
        "owner_name": ad["owner"]["name"],
        "owner_type": ad["owner"]["type"],
        "owner_phones": ad["owner"]["phones"],
        "seo_title": ad["seo"]["title"],
        "seo_description": ad["seo"]["description"],
        "ad_category_id": ad["adCategory"]["id"],
        "ad_category_name": ad["adCategory"]["name"],
        "ad_category_type": ad["adCategory"]["type"],
        "breadcrumbs_json": F.when(F.size(labels) > 0, F.to_json(ad["breadcrumbs"])),
        "last_breadcrumb_label": F.try_element_at(labels, F.lit(-1)),
        "tracking_price": ad["adTrackingData"]["ad_price"],
        "tracking_business": ad["adTrackingData"]["business"],
        "tracking_city_name": ad["adTrackingData"]["city_name"],
        "tracking_poster_type": ad["adTrackingData"]["poster_type"],
        "tracking_region_name": ad["adTrackingData"]["region_name"],
        "tracking_seller_id": ad["adTrackingData"]["seller_id"],
    }
    flat = ads.select(*[c.alias(name) for name, c in columns.items()])
    return casts.cast_columns(
        flat,
        {
            **dict.fromkeys(FLAT_LONGS, "long"),
            **dict.fromkeys(FLAT_NUMBERS, "double"),
            **dict.fromkeys(FLAT_TIMES, "timestamp"),
        },
    )
