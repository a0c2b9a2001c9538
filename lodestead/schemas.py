"""Declared schemas, as DDL text, and column lists."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import ArrayType, DataType, MapType, StructType

# Shape of one search result.
LISTING_ITEM = """
  id string, title string, slug string, estate string, transaction string,
  developmentId string, developmentTitle string, developmentUrl string,
  location struct<address:struct<city:struct<name:string>,province:struct<name:string>,street:string>,
                  mapDetails:struct<radius:string>>,
  isExclusiveOffer boolean, isPrivateOwner boolean, isPromoted boolean, source string,
  agency struct<id:string,name:string,slug:string,type:string,brandingVisible:boolean,
                highlightedAds:boolean,imageUrl:string>,
  openDays string, totalPrice struct<currency:string,value:string>,
  pricePerSquareMeter struct<currency:string,value:string>,
  areaInSquareMeters string, terrainAreaInSquareMeters string, roomsNumber string,
  hidePrice boolean, floorNumber string, dateCreated string, dateCreatedFirst string,
  shortDescription string, totalPossibleImages string,
  images array<struct<large:string>>
"""

# One document per district: location path -> its search results.
DISTRICT_DOCUMENT = f"map<string,array<struct<{LISTING_ITEM}>>>"


class StagingColumn(NamedTuple):
    name: str
    path: str
    type: str


# The staging columns in table order, where each comes from, its type.
STAGING_COLUMNS = (
    StagingColumn("id", "id", "string"),
    StagingColumn("title", "title", "string"),
    StagingColumn("slug", "slug", "string"),
    StagingColumn("estate", "estate", "string"),
    StagingColumn("transaction", "transaction", "string"),
    StagingColumn("developmentId", "developmentId", "long"),
    StagingColumn("developmentTitle", "developmentTitle", "string"),
    StagingColumn("developmentUrl", "developmentUrl", "string"),
    StagingColumn("city", "location.address.city.name", "string"),
    StagingColumn("province", "location.address.province.name", "string"),
    StagingColumn("street", "location.address.street", "string"),
    StagingColumn("mapRadius", "location.mapDetails.radius", "double"),
    StagingColumn("isExclusiveOffer", "isExclusiveOffer", "boolean"),
    StagingColumn("isPrivateOwner", "isPrivateOwner", "boolean"),
    StagingColumn("isPromoted", "isPromoted", "boolean"),
    StagingColumn("source", "source", "string"),
    StagingColumn("agencyId", "agency.id", "long"),
    StagingColumn("agencyName", "agency.name", "string"),
    StagingColumn("agencySlug", "agency.slug", "string"),
    StagingColumn("agencyType", "agency.type", "string"),
    StagingColumn("agencyBrandingVisible", "agency.brandingVisible", "boolean"),
    StagingColumn("agencyHighlightedAds", "agency.highlightedAds", "boolean"),
    StagingColumn("agencyImageUrl", "agency.imageUrl", "string"),
    StagingColumn("openDays", "openDays", "string"),
    StagingColumn("totalPriceCurrency", "totalPrice.currency", "string"),
    StagingColumn("totalPriceValue", "totalPrice.value", "double"),
    StagingColumn("pricePerSquareMeterCurrency", "pricePerSquareMeter.currency", "string"),
    StagingColumn("pricePerSquareMeterValue", "pricePerSquareMeter.value", "double"),
    StagingColumn("areaInSquareMeters", "areaInSquareMeters", "double"),
    StagingColumn("terrainAreaInSquareMeters", "terrainAreaInSquareMeters", "double"),
    StagingColumn("roomsNumber", "roomsNumber", "string"),
    StagingColumn("hidePrice", "hidePrice", "boolean"),
    StagingColumn("floorNumber", "floorNumber", "string"),
    StagingColumn("dateCreated", "dateCreated", "timestamp"),
    StagingColumn("dateCreatedFirst", "dateCreatedFirst", "timestamp"),
    StagingColumn("shortDescription", "shortDescription", "string"),
    StagingColumn("totalPossibleImages", "totalPossibleImages", "long"),
    StagingColumn("additionalInfo", "", "variant"),
    StagingColumn("ingestionDate", "", "date"),
)

SPARK_TYPES = {"long": "bigint"}


def staging_schema() -> StructType:
    return StructType.fromDDL(
        ", ".join(f"`{c.name}` {SPARK_TYPES.get(c.type, c.type)}" for c in STAGING_COLUMNS)
    )


# The part of a detail page that is read.  Ids are read as text, since some are written as 12.0.
# Values of characteristics stay open, since a number says other things than the same number as text.
_AD_DDL = """
  id:string, slug:string, url:string, title:string, advertiserType:string, advertType:string,
  status:string, createdAt:string, modifiedAt:string, pushedUpAt:string, description:string,
  category:struct<name:array<struct<value:string>>>,
  adCategory:struct<id:string,name:string,type:string>,
  characteristics:array<struct<key:string,value:variant,localizedValue:string,currency:string,suffix:string>>,
  target:struct<Price:string,Area:string,Bathrooms_num:array<string>,City:string,City_id:string,
    Construction_status:array<string>,Country:string,Energy_certificate:array<string>,
    Floor_no:array<string>,Heating:array<string>,OfferType:string,ProperType:string,Province:string,
    Rooms_num:array<string>,Windows_type:array<string>,Build_year:string>,
  features:variant, featuresByCategory:variant, featuresWithoutCategory:variant,
  images:array<struct<large:string>>,
  location:struct<coordinates:struct<latitude:double,longitude:double>,
    address:struct<city:struct<name:string>,county:struct<name:string>,province:struct<name:string>,
      postalCode:string>,
    mapDetails:struct<radius:bigint,zoom:bigint>,
    reverseGeocoding:struct<locations:array<struct<fullName:string,fullNameItems:array<string>,id:string,
      locationLevel:string,name:string,parentIds:array<string>>>>>,
  contactDetails:struct<name:string,phones:array<string>>,
  owner:struct<id:string,name:string,type:string,phones:array<string>>,
  seo:struct<title:string,description:string>,
  breadcrumbs:array<struct<label:string>>,
  additionalInformation:array<struct<label:string,values:array<string>>>,
  adTrackingData:struct<ad_price:string,business:string,city_name:string,poster_type:string,
    region_name:string,seller_id:string>
"""
PROPS = f"pageProps struct<ad:struct<{_AD_DDL}>>"
PAGE = f"props struct<pageProps:struct<ad:struct<{_AD_DDL}>>>"

# One municipality of the location tree.
_LOCATION_DDL = "id:string,name:string,detailedLevel:string,parentIds:array<string>"
LOCATION_TREE = (
    "data struct<locationTree:struct<locationTreeObjects:array<struct<"
    f"{_LOCATION_DDL},sublocations:array<struct<{_LOCATION_DDL}>>>>>>"
)
CATALOG = "district string, municipality string, id string, name string, detailedLevel string, parentIds string"

# Attributes of an administrative area, in table order.
BOUNDARY_ATTRIBUTES = (
    ("id", "string"),
    ("dtmnfr", "string"),
    ("freguesia", "string"),
    ("tipo_area_administrativa", "string"),
    ("municipio", "string"),
    ("distrito_ilha", "string"),
    ("nuts3", "string"),
    ("nuts2", "string"),
    ("nuts1", "string"),
    ("area_ha", "double"),
    ("perimetro_km", "double"),
)
BOUNDARY_FEATURE = (
    "properties struct<" + ",".join(f"{n}:{t}" for n, t in BOUNDARY_ATTRIBUTES) + ">, geometry string"
)

# Unknown fields of a point-of-interest line are ignored by naming only these.
POI_FEATURE = "geometry string, properties string, id string"


def without_field(data_type: DataType, name: str) -> DataType:
    """The same type without the field ``name`` at any depth."""
    if isinstance(data_type, StructType):
        out = StructType()
        for f in data_type.fields:
            if f.name != name:
                out.add(f.name, without_field(f.dataType, name), f.nullable)
        return out
    if isinstance(data_type, ArrayType):
        return ArrayType(without_field(data_type.elementType, name), data_type.containsNull)
    if isinstance(data_type, MapType):
        return MapType(data_type.keyType, without_field(data_type.valueType, name), data_type.valueContainsNull)
    return data_type
