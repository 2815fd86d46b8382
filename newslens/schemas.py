"""Schemas of the raw feeds and of the two serving tables.

All raw fields are nullable and read without inference from headerless,
tab-separated text.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(),
          "double": T.DoubleType(), "string": T.StringType()}


def _schema(spec: str) -> T.StructType:
    fields = []
    for item in spec.split(","):
        name, typ = item.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


# --- Fixed values: field names, positions and types of the public feed -------
# Event export, 61 fields in file order.
EXPORT_SCHEMA = _schema(
    "GlobalEventID bigint, Day int, MonthYear int, Year int, FractionDate double, "
    "Actor1Code string, Actor1Name string, Actor1CountryCode string, "
    "Actor1KnownGroupCode string, Actor1EthnicCode string, Actor1Religion1Code string, "
    "Actor1Religion2Code string, Actor1Type1Code string, Actor1Type2Code string, "
    "Actor1Type3Code string, Actor2Code string, Actor2Name string, Actor2CountryCode string, "
    "Actor2KnownGroupCode string, Actor2EthnicCode string, Actor2Religion1Code string, "
    "Actor2Religion2Code string, Actor2Type1Code string, Actor2Type2Code string, "
    "Actor2Type3Code string, IsRootEvent int, EventCode string, EventBaseCode string, "
    "EventRootCode string, QuadClass int, GoldsteinScale double, NumMentions int, "
    "NumSources int, NumArticles int, AvgTone double, Actor1Geo_Type int, "
    "Actor1Geo_FullName string, Actor1Geo_CountryCode string, Actor1Geo_ADM1Code string, "
    "Actor1Geo_ADM2Code string, Actor1Geo_Lat double, Actor1Geo_Long double, "
    "Actor1Geo_FeatureID string, Actor2Geo_Type int, Actor2Geo_FullName string, "
    "Actor2Geo_CountryCode string, Actor2Geo_ADM1Code string, Actor2Geo_ADM2Code string, "
    "Actor2Geo_Lat double, Actor2Geo_Long double, Actor2Geo_FeatureID string, "
    "ActionGeo_Type int, ActionGeo_FullName string, ActionGeo_CountryCode string, "
    "ActionGeo_ADM1Code string, ActionGeo_ADM2Code string, ActionGeo_Lat double, "
    "ActionGeo_Long double, ActionGeo_FeatureID string, DATEADDED bigint, SOURCEURL string")

# Event mentions, 16 fields in file order.
MENTIONS_SCHEMA = _schema(
    "GlobalEventID bigint, EventTimeDate bigint, MentionTimeDate bigint, MentionType int, "
    "MentionSourceName string, MentionIdentifier string, SentenceID int, "
    "Actor1CharOffset int, Actor2CharOffset int, ActionCharOffset int, InRawText int, "
    "Confidence int, MentionDocLen int, MentionDocTone double, "
    "MentionDocTranslationInfo string, Extras string")

# Article knowledge graph (gkg), 27 fields in file order.
GKG_SCHEMA = _schema(
    "GKGRECORDID string, DATE bigint, SourceCollectionIdentifier int, "
    "SourceCommonName string, DocumentIdentifier string, Counts string, V2Counts string, "
    "Themes string, V2Themes string, Locations string, V2Locations string, Persons string, "
    "V2Persons string, Organizations string, V2Organizations string, V2Tone string, "
    "Dates string, GCAM string, SharingImage string, RelatedImages string, "
    "SocialImageEmbeds string, SocialVideoEmbeds string, Quotations string, "
    "AllNames string, Amounts string, TranslationInfo string, Extras string")

# Serving tables.  global_event_id of event_mentions stays 64-bit (the source
# is 64-bit); event_tone is a double end to end.
EVENT_MENTIONS_SCHEMA = _schema(
    "global_event_id bigint, event_year int, event_month int, event_day int, "
    "source_language string, event_country string, event_country_full_name string, "
    "num_mentions int")

ARTICLES_SCHEMA = _schema(
    "global_event_id string, internet_source string, event_year int, event_month int, "
    "event_day int, event_themes string, person_list string, event_tone double, "
    "first_country string, second_country string")
# -----------------------------------------------------------------------------

FEED_SCHEMAS = {"export": EXPORT_SCHEMA, "mentions": MENTIONS_SCHEMA, "gkg": GKG_SCHEMA}

EVENT_MENTIONS_KEY = "global_event_id"
ARTICLES_KEY = "global_event_id"


def ddl(schema: T.StructType) -> str:
    """``name type, ...`` text accepted by ``from_csv`` and ``DataFrameReader.schema``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
