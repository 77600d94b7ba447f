"""Input views over the given tables. The SQL text is valid in Spark and in DuckDB."""

from __future__ import annotations

from terrafold import defaults as D

# Point samples: one per order. The odd offsets keep points off polygon edges and means off the
# halves at which the engines could round differently.
SAMPLES = """
select *,
       case when soc_percent < 1 then cast(0.15 as double)
            when soc_percent < 3 then cast(0.25 as double)
            else cast(0.35 as double) end as clay_fraction
from (
  select o_orderkey as id,
         concat('S', o_orderkey) as raw_data_id,
         (cast((o_orderkey*104729)%21000 as double)+cast(0.4871 as double))/1000 + 35 as latitude,
         (cast((o_orderkey*7919)%35000 as double)+cast(0.5137 as double))/1000 - 10 as longitude,
         cast((o_orderkey*31)%3100 as double)/100 + cast(0.0037137 as double) as soc_percent,
         o_orderpriority as soc_method,
         cast(o_orderkey % 40 as int) as top_depth_cm,
         cast(o_orderkey % 40 + 15 as int) as bottom_depth_cm,
         cast(cast(o_orderdate as date) as string) as sampling_date,
         case when o_orderstatus <> 'P' then cast(cast(o_orderdate as date) as string) end
           as lab_analysis_date
  from orders) o
"""

# Raw samples: the measurement wrapped in JSON, some of it malformed.
RAW_SAMPLES = """
select concat('S', o_orderkey) as raw_data_id,
       (cast((o_orderkey*7919)%35000 as double)+cast(0.5137 as double))/1000 - 10 as longitude,
       (cast((o_orderkey*104729)%21000 as double)+cast(0.4871 as double))/1000 + 35 as latitude,
       case o_orderkey % 19
         when 0 then null
         when 1 then '{"v": 1}'
         when 2 then 'oops'
         when 3 then '3.5'
         when 4 then concat('{"value": "', number_text, '"}')
         when 5 then '{"value": null, "method": "dry"}'
         when 6 then ''
         when 7 then '{''value'': 2.5}'
         when 8 then '{"value": 2.5} junk'
         when 9 then concat('{"value": 5, "value": ', number_text, '}')
         when 10 then '{"value": true, "method": "dry"}'
         when 11 then '{"value": {"a": 1}}'
         when 12 then '{"value": 2.5'
         else concat('{"value": ', number_text, ', "method": "', o_orderpriority, '"}')
       end as soc_percent,
       cast(o_orderkey % 40 as int) as top_depth_cm,
       cast(o_orderkey % 40 + 15 as int) as bottom_depth_cm,
       cast(cast(o_orderdate as date) as string) as sampling_date,
       case when o_orderstatus <> 'P' then cast(cast(o_orderdate as date) as string) end
         as lab_analysis_date,
       o_orderkey as line
from (
  select *, concat(cast(floor(((o_orderkey*31)%3100)/100) as bigint), '.',
                   lpad(cast((o_orderkey*31)%100 as string), 2, '0')) as number_text
  from orders) o
"""

_NAMES = {
    "AT": "Austria", "BE": "Belgium", "CZ": "Czechia", "DE": "Germany", "ES": "Spain", "FR": "France", "IT": "Italy",
    "NL": "Netherlands", "PL": "Poland",
}
_BOXES = sorted(box for box in D.COUNTRY_BOXES if box[0] in _NAMES)

# Country boxes, ids alphabetical by code.
COUNTRIES = "select * from (values\n" + ",\n".join(
    f"  ({n}, '{_NAMES[code]}', '{code}', {w}e0, {s}e0, {e}e0, {north}e0)"
    for n, (code, w, s, e, north) in enumerate(_BOXES, 1)
) + "\n) as t(id, name, iso_code, min_lon, min_lat, max_lon, max_lat)\n"

# One of twelve codes by nation: those with an outline, and two that have none.
_CODES = sorted(box[0] for box in D.COUNTRY_BOXES) + ["SE", "XX"]
CUSTOMER_CODE = "case c_nationkey % {} {} end".format(
    len(_CODES), " ".join(f"when {i} then '{code}'" for i, code in enumerate(_CODES))
)

# A countries-like table that grows with the data: one row per customer.
CUSTOMER_COUNTRIES = f"""
select c_custkey as id,
       concat(c_mktsegment, ' ', c_nationkey) as name,
       {CUSTOMER_CODE} as iso_code,
       case when c_acctbal >= 0 then concat('"POINT ', c_custkey, '"') end as boundary,
       cast(c_nationkey as bigint) - 5 as sample_count
from customer
"""

# Samples with out-of-range values and gaps: one per order line.
WILD_SAMPLES = """
select concat(l_orderkey, '-', l_linenumber) as raw_data_id,
       case when l_returnflag = 'R' and l_linestatus = 'F' and l_quantity > 45 then null
            else l_quantity * 4 - 100 end as latitude,
       l_extendedprice / 500 - 150 as longitude,
       case when l_discount < 0.01 then null else l_discount * 1100 end as soc_percent,
       cast(l_linenumber * 200 - 300 as int) as top_depth_cm,
       cast(l_linenumber * 200 as int) as bottom_depth_cm,
       cast(cast(l_shipdate as date) as string) as sampling_date,
       case when l_returnflag <> 'A' then cast(cast(l_shipdate as date) as string) end
         as lab_analysis_date,
       l_tax * 10 as clay_fraction
from lineitem
"""

# Run log: one entry per event.
RUN_LOG = """
select concat('run-', user_id) as run_id,
       event_type as stage_name,
       case when event_type = 'error' then 'ERROR' when value > 90 then 'WARNING' else 'INFO' end
         as log_level,
       concat(event_type, ' ', event_id) as message,
       ts as timestamp,
       cast(floor(value * 10) as bigint) as duration_ms,
       case when event_type <> 'error' then event_id % 100 end as record_count,
       case when event_type = 'error' then props end as error_details
from events
"""

# Boxes as stored outline text, one per order; every second one has a hole.
STORED_OUTLINES = """
select o_orderkey as id, w, s,
       concat('"POLYGON ((', w, ' ', s, ', ', w + 6, '.5 ', s, ', ', w + 6, '.5 ', s + 4, ', ',
              w, ' ', s + 4, ', ', w, ' ', s, ')',
              case when o_orderstatus = 'F' then
                concat(', (', w + 1, ' ', s + 1, ', ', w + 2, ' ', s + 1, ', ', w + 2, ' ', s + 2,
                       ', ', w + 1, ' ', s + 1, ')')
              else '' end,
              ')"') as boundary,
       case when o_orderstatus = 'F' then 1 else 0 end as holes
from (select *, o_orderkey % 170 as w, o_orderkey % 170 - 85 as s from orders) o
"""
