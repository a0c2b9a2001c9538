"""Landed HTML pages and the requests that lead to them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestead.functions.casts import run_date as run_date_column
from lodestead.functions.json_text import is_json

# Fixed value: id of the script tag that holds the page data.
DATA_SCRIPT_ID = "__NEXT_DATA__"


def script_body(html: Column, script_id: str | None = DATA_SCRIPT_ID) -> Column:
    """Text of the first script tag, of the one with this id when given; null without one."""
    attributes = r"[^>]*" if script_id is None else rf"[^>]*\bid\s*=\s*[\"']?\Q{script_id}\E[\"']?(?:\s[^>]*)?"
    return F.nullif(F.regexp_extract(html, rf"(?is)<script{attributes}>(.*?)</script>", 1), F.lit(""))


def embedded_json(pages: DataFrame, html: str = "html", url: str = "url", run_date: str | dt.date | None = None,
                  script_id: str = DATA_SCRIPT_ID) -> DataFrame:
    """JSON text of each page with its load date and URL.

    Pages without the tag, with an empty one or with broken JSON are left out.
    """
    return (
        pages.select(script_body(F.col(html), script_id).alias("page"), F.col(url).alias("sourceUrl"))
        .filter(is_json(F.col("page")))
        .withColumn("ingestionDate", run_date_column(run_date).cast("string"))
    )


def build_id(page: Column) -> Column:
    """The site build id inside the page data."""
    return F.get_json_object(page, "$.buildId")


def page_requests(locations: DataFrame, location: str, page_count: str, url_template: str) -> DataFrame:
    """One row per location and result page; page 1 has no page suffix.

    ``url_template`` holds one ``%s`` for the location.  A location without a
    page count still has its first page.
    """
    url = F.format_string(url_template, F.col(location))
    pages = F.sequence(F.lit(1), F.greatest(F.coalesce(F.col(page_count).cast("int"), F.lit(1)), F.lit(1)))
    return locations.withColumn("page", F.explode(pages)).withColumn(
        "url", F.when(F.col("page") == 1, url).otherwise(F.concat(url, F.lit("?page="), F.col("page")))
    )


def detail_urls(slugs: DataFrame, base_url: str, slug: str = "slug") -> DataFrame:
    return slugs.withColumn("url", F.concat(F.lit(base_url), F.col(slug)))
