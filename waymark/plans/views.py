"""Entity, frontier and mention views over the star-schema tables, in both dialects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_HAVERSINE = "2 * 6371000.0::double * atan2(sqrt({a}), sqrt(1 - ({a})))"


def metres(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    return _HAVERSINE.format(a=a)


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as places: positions, images and provenance are functions of the key, with gaps."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))  # 25 rows
    k = "c_custkey"
    return c.selectExpr(
        f"cast({k} as bigint) as id", "c_name as name", "lower(c_mktsegment) as category", f"if({k} % 11 = 0, null, n_name) as locality",
        f"if({k} % 7 = 0, null, concat(cast({k} as string), ' ', n_name, ' lake road')) as address",
        f"if({k} % 13 = 0, null, 17.2D + ({k} * 37 % 1000) / 2000D) as latitude", f"if({k} % 13 = 0, null, 78.2D + ({k} * 53 % 1000) / 2500D) as longitude",
        f"if({k} % 5 = 0, null, concat('img', cast({k} as string))) as image_id", f"cast({k} % 4 as int) as n_sources", f"if({k} % 3 = 0, null, ({k} % 41) / 10D) as rating",
        f"({k} % 10) / 10D as confidence", f"if({k} % 6 = 0, null, '9-21') as timings", f"cast({k} % 30 as int) as n_reviews", f"cast({k} % 700 as int) as rating_count",
        f"concat(lower(c_mktsegment), if({k} % 2 = 0, ' quiet garden walk', ' busy bar')) as description",
        f"if({k} % 9 = 0, array(), array('solo', if({k} % 2 = 0, 'quiet', 'nightlife'))) as intent_tags", "c_acctbal", "c_nationkey",
    )


ENTITIES = """
with e as (
  select c_custkey::bigint as id, c_name as name, lower(c_mktsegment) as category, case when c_custkey % 11 = 0 then null else n_name end as locality,
    case when c_custkey % 7 = 0 then null else c_custkey::varchar || ' ' || n_name || ' lake road' end as address,
    case when c_custkey % 13 = 0 then null else 17.2::double + (c_custkey * 37 % 1000) / 2000::double end as latitude,
    case when c_custkey % 13 = 0 then null else 78.2::double + (c_custkey * 53 % 1000) / 2500::double end as longitude,
    case when c_custkey % 5 = 0 then null else 'img' || c_custkey::varchar end as image_id, (c_custkey % 4)::int as n_sources,
    case when c_custkey % 3 = 0 then null else (c_custkey % 41) / 10::double end as rating, (c_custkey % 10) / 10::double as confidence,
    case when c_custkey % 6 = 0 then null else '9-21' end as timings, (c_custkey % 30)::int as n_reviews, (c_custkey % 700)::int as rating_count,
    lower(c_mktsegment) || case when c_custkey % 2 = 0 then ' quiet garden walk' else ' busy bar' end as description,
    case when c_custkey % 9 = 0 then []::varchar[] else ['solo', case when c_custkey % 2 = 0 then 'quiet' else 'nightlife' end] end as intent_tags,
    c_acctbal, c_nationkey
  from customer join nation on c_nationkey = n_nationkey)
"""


def resolvable(spark: SparkSession, sf_dir: str, name: str, key: str, nation_key: str) -> DataFrame:
    """Every row of supplier or customer as a place to resolve: name, site, address and position are functions of the key, with gaps."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    t = table(spark, sf_dir, name)
    return t.join(F.broadcast(nation), F.col(nation_key) == F.col("n_nationkey"), "left").selectExpr(  # 25 rows
        f"cast({key} as bigint) as id", f"concat('Garden cafe ', cast({key} % 40 as string)) as name", f"if({key} % 7 = 0, null, concat(cast({key} as string), ' ', n_name, ' lake road')) as address",
        f"concat('https://site', cast({key} % 50 as string), '.example') as website", f"if({key} % 13 = 0, null, 17.2D + ({key} * 37 % 1000) / 2000D) as latitude", f"if({key} % 13 = 0, null, 78.2D + ({key} * 53 % 1000) / 2500D) as longitude",
    )


def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as candidates: their type is the kind, their user the value, and depth and retries follow from ids."""
    return table(spark, sf_dir, "events").selectExpr(
        "if(event_type = 'click', 'source_url', event_type) as kind", "concat('src', cast(user_id % 3 as string)) as source",
        "concat(if(event_id % 2 = 0, 'User', 'user'), cast(user_id as string)) as value", "round(value, 2) as priority", "cast(event_id % 6 as int) as depth", "cast(event_id % 4 as int) as retry_count", "event_id as seq",
    )


FRONTIER = """
with f as (
  select case when event_type = 'click' then 'source_url' else event_type end as kind, 'src' || (user_id % 3)::varchar as source,
    case when event_id % 2 = 0 then 'User' else 'user' end || user_id::varchar as value, round(value, 2) as priority, (event_id % 6)::int as depth, (event_id % 4)::int as retry_count, event_id as seq
  from events)
"""
