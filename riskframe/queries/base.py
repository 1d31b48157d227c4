"""Shared SQL texts of the canonical inputs, and rounding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMALS = 6

TX = """tx as (
  select event_id, user_id, ts - to_hours(cast(event_id % 240 as int)) as signup_time, ts as purchase_time,
    value as purchase_value, concat('dev_', json_extract_string(props, '$.k')) as device_id,
    case user_id % 3 when 0 then 'SEO' when 1 then 'Ads' else 'Direct' end as source,
    case event_id % 5 when 0 then 'Chrome' when 1 then 'Safari' when 2 then 'FireFox' when 3 then 'IE'
      else 'Opera' end as browser,
    case when user_id % 2 = 0 then 'M' else 'F' end as sex, cast(18 + user_id % 53 as int) as age,
    cast((event_id * 7919) % 100000 as double) + 0.5 as ip_address,
    case when event_type = 'error' and cast(json_extract_string(props, '$.k') as int) < 50 then 1 else 0 end as class
  from events)"""

DIRTY = (
    TX
    + """, base as (
  select event_id, user_id, signup_time,
    case when event_id % 211 = 0 then 'bad' else strftime(purchase_time, '%Y-%m-%d %H:%M:%S') end as purchase_text,
    case when event_id % 97 <> 0 then purchase_value end as purchase_value,
    case when event_id % 89 <> 0 then source end as source, device_id,
    concat(' "', class, '" ') as class_text, class
  from tx),
dirty as (
  select * from base union all select * from base where event_id % 101 = 0
  union all select * replace (1 - class as class) from base where event_id % 307 = 0)"""
)

RANGES = """ranges as (
  select cast(n_nationkey as bigint) * 4000 as lo, cast(n_nationkey as bigint) * 4000 + 2999 as hi, n_name as country
  from nation)"""

GEO = (
    TX
    + ", "
    + RANGES
    + """, geo as (
  select tx.*, cast(floor(ip_address) as bigint) as ip_address_int, coalesce(r.country, 'Unknown') as country
  from tx left join ranges r on cast(floor(ip_address) as bigint) between r.lo and r.hi)"""
)

BANK = """bank as (
  select l_orderkey, l_linenumber, epoch_us(l_shipdate) / 1e6 as "Time", l_quantity as "V1", l_extendedprice as "V2",
    l_discount as "V3", l_tax as "V4", l_extendedprice as "Amount",
    case when l_returnflag = 'R' then 1 else 0 end as "Class"
  from lineitem)"""


def hash32_sql(key: str, seed: int) -> str:
    """The seeded 32-bit key hash; ``key`` is SQL text for the concatenated key."""
    return f"cast('0x' || substr(md5({key} || '|{seed}'), 1, 8) as bigint)"


def uniform_sql(key: str, seed: int) -> str:
    return f"({hash32_sql(key, seed)} / 4294967296.0)"


EVENT_KEY = "cast(event_id as varchar)"

PRED = (
    TX
    + f""", pred as (
  select event_id, class, score, cast(score >= 0.5 as int) as prediction from (
    select event_id, class, (floor(60 * {uniform_sql(EVENT_KEY, 42)}) + 30 * class) / 100.0 as score from tx))"""
)


def wide_cte(dims: int) -> str:
    cols = ", ".join(f"cast(embedding[{j + 1}] as double) as f{j}" for j in range(dims))
    return f"wide as (select vec_id, {cols}, case when label = 0 then 1 else 0 end as \"Class\" from embeddings)"


def with_ctes(ctes: str, body: str) -> str:
    return f"with {ctes}\n{body}"


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Doubles rounded for comparison across engines."""
    names = {f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.select(*[F.round(c, decimals).alias(c) if c in names else F.col(c) for c in df.columns])


def union_sql(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)
