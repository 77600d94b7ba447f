"""Every registered query with its SQL counterpart."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import inputs as I
from checks import kmeans_sql as K
from checks import views as V
from terrafold import defaults as D
from terrafold.functions import geometry as G
from terrafold.functions import projections as P
from terrafold.functions.measurement import clay_fraction, parse_measurement
from terrafold.functions.sizing import k_large_adjust, k_upper_bound
from terrafold.operators import (
    clustering, kmeans, quality, reports, runlog, sampling, simplify, spatial, statistics, tables,
)
from terrafold.operators.kmeans import KMeansSettings
from terrafold.plans import analysis
from terrafold.session import cut_lineage, fresh_path
from terrafold.sources import countries as country_source
from terrafold.sources import outlines as outline_source
from terrafold.sources import files
from terrafold.sources import samples as sample_source

QUERIES: dict = {}
ORACLES: dict = {}


def register(key: str, sql: str | None = None):
    def keep(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return keep


LOCATED = K.located_ctes().strip()
ZONES = f"""{LOCATED},
zoned as (
  select *, cast(floor(latitude) as bigint) % 4 + 1 as cluster_number
  from located where country_id is not null),
zone_clusters as (
  select row_number() over (order by country_id, cluster_number) as id, country_id, cluster_number,
         avg(latitude) as center_latitude, avg(longitude) as center_longitude,
         count(*) as sample_count
  from zoned group by country_id, cluster_number)"""

MEASURED = """case when o_orderkey % 19 in (0, 1, 2, 3, 5, 6, 7, 8, 11, 12) then cast(0 as double)
              when o_orderkey % 19 = 10 then cast(1 as double)
              else cast((o_orderkey*31)%3100 as double)/100 end"""
METHOD = "case when o_orderkey % 19 = 10 then 'dry' when o_orderkey % 19 < 13 then '' else o_orderpriority end"
CLAY = "case when {v} < 1 then 0.15e0 when {v} < 3 then 0.25e0 else 0.35e0 end"
SAMPLE_COLUMNS = """raw_data_id, round(latitude, 6) as latitude, round(longitude, 6) as longitude,
  round(soc_percent, 6) as soc_percent, soc_method, cast(top_depth_cm as bigint) as top_depth_cm,
  cast(bottom_depth_cm as bigint) as bottom_depth_cm, sampling_date, lab_analysis_date,
  round(clay_fraction, 6) as clay_fraction"""
CLEANED = f"""
select raw_data_id, latitude, longitude, soc_percent, soc_method, top_depth_cm, bottom_depth_cm,
       sampling_date, lab_analysis_date, {CLAY.format(v='soc_percent')} as clay_fraction, soc_parsed
from (select r.raw_data_id, r.latitude, r.longitude, {MEASURED} as soc_percent,
             {METHOD} as soc_method, r.top_depth_cm, r.bottom_depth_cm, r.sampling_date,
             r.lab_analysis_date, o_orderkey % 19 not in (0, 1, 2, 3, 5, 6, 7, 8, 11, 12) as soc_parsed
      from ({V.RAW_SAMPLES}) r join orders on o_orderkey = r.line) c"""

# --- scans, sources, sinks --------------------------------------------------


@register("load_samples", f"select {SAMPLE_COLUMNS}, soc_parsed from ({CLEANED}) s")
def load_samples(spark, d):
    return I.tidy(sample_source.clean_samples(I.raw_samples(spark, d)))


LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]
LAST_LINE = ", ".join(f"{c} desc" for c in LINE_ORDER)


@register("upsert_samples", f"""
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey,
       round(l_quantity, 6) as l_quantity, round(l_extendedprice, 6) as l_extendedprice, l_returnflag
from (select *, row_number() over (
        partition by l_orderkey, l_linenumber
        order by case when l_returnflag = 'N' then 0 else 1 end desc, {LAST_LINE}) as n
      from lineitem) t
where n = 1""")
def upsert_samples(spark, d):
    lines = I.table(spark, d, "lineitem")
    merged = tables.upsert_samples(
        lines.where("l_returnflag = 'N'"), lines.where("l_returnflag <> 'N'"), LINE_ORDER,
        ["l_orderkey", "l_linenumber"],
    )
    return I.tidy(merged, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_returnflag")


@register("upsert_counts", """
select (select count(*) from lineitem) as input_rows,
       (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem) k) as stored_rows
""")
def upsert_counts(spark, d):
    lines = I.table(spark, d, "lineitem")
    held = tables.upsert_samples(None, lines, LINE_ORDER, ["l_orderkey", "l_linenumber"])
    return tables.upsert_counts(lines, held)


# One dump per customer: a node, a relation coded by segment and nation, a relation coded by nation.
ELEMENTS = """
select c_custkey as doc, 0 as pos, 'node' as type, c_custkey as rel,
       concat('X', c_nationkey) as code, c_name as name, cast(null as string) as name_en
from customer
union all
select c_custkey, 1, 'relation', c_custkey * 10,
       case when c_acctbal > 9000 then null when c_acctbal > 8000 then ''
            else concat(c_mktsegment, c_nationkey) end,
       case when c_acctbal > 0 then c_name end, case when c_acctbal > -500 then upper(c_name) end
from customer
union all
select c_custkey, 2, 'relation', c_custkey * 10 + 1, concat('N', c_nationkey),
       case when c_mktsegment = 'BUILDING' then c_name end, concat('en ', c_name)
from customer
"""


def _dumps(spark, d):
    element = """named_struct('type', type, 'id', rel, 'tags', map_filter(
        map('ISO3166-1', code, 'name', name, 'name:en', name_en), (k, v) -> v is not null))"""
    rows = I.view(spark, d, ELEMENTS, "customer").selectExpr("doc", "pos", f"{element} as e")
    docs = rows.groupBy("doc").agg(F.array_sort(
        F.collect_list(F.struct("pos", "e")), lambda a, b: a["pos"] - b["pos"]).alias("x"))
    text = F.to_json(F.struct(F.transform("x", lambda p: p["e"]).alias("elements")))
    return country_source.dump_from_text(docs.select("doc", text.alias("text")), "text")


FIRST_RELATIONS = f"""
select code as iso_code, coalesce(name, name_en, 'Unknown') as name, rel as relation_id
from (select *, row_number() over (partition by code order by doc, pos) as n
      from ({ELEMENTS}) e where type = 'relation' and code is not null and code <> '') t
where n = 1"""


@register("load_countries", FIRST_RELATIONS)
def load_countries(spark, d):
    return country_source.load_countries(_dumps(spark, d), ["doc"])


OUTLINES = ", ".join(
    f"('{iso}', {w}e0, {s}e0, {e}e0, {n}e0)" for iso, w, s, e, n in D.COUNTRY_BOXES
)
OUTLINES = f"(values {OUTLINES}) as b(iso_code, min_lon, min_lat, max_lon, max_lat)"


@register("country_boundaries", f"""
select id, c.iso_code, min_lon, min_lat, max_lon, max_lat
from ({V.CUSTOMER_COUNTRIES}) c join {OUTLINES} on b.iso_code = c.iso_code""")
def country_boundaries(spark, d):
    bounded = country_source.country_boundaries(I.customer_countries(spark, d).select("id", "iso_code"))
    shapes = bounded.select("id", "iso_code", G.wkt_rings("wkt").alias("rings"))
    return country_source.country_bbox(shapes)


@register("wkt_rings", f"""
select id, 1 + holes as n_rings, 5 + 4 * holes as n_points, round(w + 6.5, 6) as second_x,
       cast(s as double) as second_y, substr(boundary, 2, length(boundary) - 2) as wkt
from ({V.STORED_OUTLINES}) o""")
def wkt_rings(spark, d):
    shapes = I.stored_outlines(spark, d).select(
        "id", country_source.boundary_rings("boundary").alias("rings"))
    second = F.get(F.get("rings", F.lit(0)), F.lit(1))
    return I.tidy(shapes.select(
        "id", F.size("rings").alias("n_rings"), F.size(F.flatten("rings")).alias("n_points"),
        second["x"].alias("second_x"), second["y"].alias("second_y"), G.rings_wkt("rings").alias("wkt"),
    ))


@register("country_bbox", f"""
select id, cast(w as double) as min_lon, cast(s as double) as min_lat, w + 6.5e0 as max_lon,
       cast(s + 4 as double) as max_lat
from ({V.STORED_OUTLINES}) o""")
def country_bbox(spark, d):
    shapes = I.stored_outlines(spark, d).select(
        "id", country_source.boundary_rings("boundary").alias("rings"))
    return country_source.country_bbox(shapes)


@register("upsert_countries", f"""
select id, name, iso_code from (
  select *, row_number() over (partition by name order by id desc) as n
  from ({V.CUSTOMER_COUNTRIES}) c) t where n = 1""")
def upsert_countries(spark, d):
    rows = I.customer_countries(spark, d).select("id", "name", "iso_code")
    return tables.upsert_countries(None, rows, ["id"])


@register("store_clusters", f"""with {ZONES}
select id, country_id, cluster_number, round(center_latitude, 6) as center_latitude,
       round(center_longitude, 6) as center_longitude, sample_count from zone_clusters""")
def store_clusters(spark, d):
    path = fresh_path(spark, "clusters")
    keyed = tables.surrogate_ids(I.zone_clusters(spark, d), ["country_id", "cluster_number"])
    clustering.store_clusters(keyed, path)
    try:  # a second time the keys are taken, and nothing is written
        clustering.store_clusters(keyed, path)
    except tables.ConstraintError:
        return I.tidy(spark.read.schema(keyed.schema).parquet(path))
    raise AssertionError("stored twice")


@register("duplicate_clusters", f"""with {LOCATED}
select country_id, cast(floor(latitude) as bigint) as cluster_number, count(*) as n_rows
from located where country_id is not null group by all having count(*) > 1""")
def duplicate_clusters(spark, d):
    cells = I.located(spark, d).where("country_id is not null").select(
        "country_id", F.floor("latitude").alias("cluster_number"))
    return tables.duplicate_keys(cells, ["country_id", "cluster_number"])


RANDOM_SAMPLE = """sampled as (
  select * from (
    select *, row_number() over (partition by country_id order by md5(concat('42:', id)), id) as rk
    from located where country_id is not null) t
  where rk <= 100),
results as (
  select s.country_id, c.name as country_name, c.iso_code as country_code,
         'random' as sampling_method, n.total_samples, count(*) as sample_size,
         avg(s.soc_percent) as soc_mean, coalesce(var_samp(s.soc_percent), 0) as soc_variance,
         avg(s.clay_fraction) as clay_fraction_mean
  from sampled s
  join (select country_id, count(*) as total_samples from located group by country_id) n
    on n.country_id = s.country_id and n.total_samples >= 10
  join countries c on c.id = s.country_id
  group by all)"""
RESULT_FIGURES = """round(soc_mean, 6) as soc_mean, round(soc_variance, 6) as soc_variance,
  round(clay_fraction_mean, 6) as clay_fraction_mean"""


def _results(spark, d):
    return statistics.country_statistics(I.located(spark, d), I.countries(spark))


@register("store_results", f"""with {LOCATED}, {RANDOM_SAMPLE}
select row_number() over (order by again, country_id) as id, country_id, sampling_method, sample_size,
       {RESULT_FIGURES}, true as dated
from results cross join (values (0), (1)) t(again)""")
def store_results(spark, d):
    """Two runs stored one after the other."""
    path = fresh_path(spark, "results")
    results = cut_lineage(_results(spark, d))
    for _ in range(2):
        rows = statistics.store_results(results, path)
    stored = files.read_table(spark, path, rows.schema)
    return I.tidy(stored.withColumn("dated", F.col("analysis_date").isNotNull()).drop("analysis_date"))


@register("scan_samples", f"""with {LOCATED}
select id, {SAMPLE_COLUMNS}, country_id from located""")
def scan_samples(spark, d):
    return I.tidy(tables.scan_samples(I.located(spark, d)))


@register("scan_countries", f"select * from ({V.CUSTOMER_COUNTRIES}) c")
def scan_countries(spark, d):
    return I.tidy(tables.scan_countries(I.customer_countries(spark, d)))


EXPORTED = f"select {SAMPLE_COLUMNS}, soc_parsed from ({CLEANED}) s"


@register("export_table_csv", EXPORTED)
def export_table_csv(spark, d):
    path = fresh_path(spark, "csv")
    rows = sample_source.clean_samples(I.raw_samples(spark, d))
    files.export_table(rows, path, "csv")
    return I.tidy(files.read_exported(spark, path, rows.schema, "csv"))


@register("export_table_json", EXPORTED)
def export_table_json(spark, d):
    path = fresh_path(spark, "json")
    rows = sample_source.clean_samples(I.raw_samples(spark, d))
    files.export_table(rows, path, "json")
    return I.tidy(files.read_exported(spark, path, rows.schema, "json"))


@register("surrogate_ids", """
select o_orderkey, (select max(c_custkey) from customer)
       + row_number() over (order by o_orderdate, o_orderkey) as id
from orders""")
def surrogate_ids(spark, d):
    start = I.table(spark, d, "customer").agg(F.max("c_custkey").alias("m"))
    orders = I.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return tables.surrogate_ids(orders, ["o_orderdate", "o_orderkey"], start).select("o_orderkey", "id")


@register("load_into_table", f"""
select {SAMPLE_COLUMNS}, soc_parsed from (
  select *, row_number() over (partition by raw_data_id order by sampling_date desc, line desc) as n
  from (select c.* replace (concat('K', x.o_custkey) as raw_data_id), x.o_orderkey as line
        from ({CLEANED}) c join orders x on c.raw_data_id = concat('S', x.o_orderkey)) t) u
where n = 1""")
def load_into_table(spark, d):
    owners = I.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("line"), F.concat(F.lit("K"), "o_custkey").alias("owner"))
    raw = I.raw_samples(spark, d).join(owners, "line").withColumn("raw_data_id", F.col("owner"))
    return I.tidy(sample_source.load_into(None, raw.drop("owner"), ["sampling_date", "line"]))


# Relations coded by outline code, for the dump-to-table composition.
CODED = """
select c_custkey as doc, 0 as pos, 'relation' as type, c_custkey as rel,
       {code} as code, c_name as name
from customer""".format(code=V.CUSTOMER_CODE)


@register("countries_from_dumps", f"""
select name, iso_code, concat('"POLYGON ((', w, ' ', s, ', ', e, ' ', s, ', ', e, ' ', n, ', ', w, ' ', n,
              ', ', w, ' ', s, '))"') as boundary
from (select code, name, row_number() over (partition by code order by doc) as k from ({CODED}) c) t
join (values {", ".join(f"('{i}', '{w:g}', '{s:g}', '{e:g}', '{n:g}')" for i, w, s, e, n in D.COUNTRY_BOXES)})
  as b(iso_code, w, s, e, n) on b.iso_code = t.code
where k = 1 and code <> 'CH'""")
def countries_from_dumps(spark, d):
    element = "named_struct('type', type, 'id', rel, 'tags', map('ISO3166-1', code, 'name', name))"
    rows = I.view(spark, d, CODED, "customer").selectExpr("doc", f"array({element}) as elements")
    text = rows.select("doc", F.to_json(F.struct("elements")).alias("text"))
    return country_source.countries_from_dumps(country_source.dump_from_text(text, "text"), ["doc"])


# Outlines cut into ways, one relation per customer: a ring of six points as three ways, in an order and with directions that
# follow the key, a square hole in every second one, and a way that closes nothing in every third.
@register("assembled_rings", """
select concat('K', c_custkey) as iso_code, cast(c_custkey % 3 = 0 as bigint) as open_ways,
       concat_ws(';', concat_ws(',', x || ' ' || y, (x + 4) || ' ' || (y - 1), (x + 9) || ' ' || y, (x + 9) || ' ' || (y + 7),
                                (x + 5) || ' ' || (y + 9), x || ' ' || (y + 7), x || ' ' || y),
                 case when c_custkey % 2 = 0 then
                   concat_ws(',', (x + 2) || ' ' || (y + 2), (x + 2) || ' ' || (y + 4), (x + 4) || ' ' || (y + 4),
                             (x + 4) || ' ' || (y + 2), (x + 2) || ' ' || (y + 2)) end) as outline
from (select *, c_custkey % 170 as x, c_nationkey as y from customer) c""")
def assembled_rings(spark, d):
    point = "named_struct('lat', cast(y + {1} as double), 'lon', cast(x + {0} as double))"
    ring = [(0, 0), (4, -1), (9, 0), (9, 7), (5, 9), (0, 7), (0, 0)]
    hole = [(2, 2), (2, 4), (4, 4), (4, 2), (2, 2)]

    def way(ref, role, corners):
        points = f"array({', '.join(point.format(*c) for c in corners)})"
        return (f"named_struct('type', 'way', 'ref', cast({ref} as bigint), 'role', '{role}', "
                f"'geometry', if((c_custkey + {ref}) % 2 = 0, {points}, reverse({points})))")

    outer = [way(f"(c_custkey * 7 + {k}) % 3", "outer", ring[2 * k : 2 * k + 3]) for k in range(3)]
    members = (
        f"concat(array({', '.join(outer)}), if(c_custkey % 2 = 0, array({way(5, 'inner', hole[:3])}, {way(4, 'inner', hole[2:])}), array()), "
        f"if(c_custkey % 3 = 0, array({way(9, '', [(20, 20), (21, 21)])}), array()))"
    )
    rows = I.view(spark, d, "select *, c_custkey % 170 as x, c_nationkey as y from customer", "customer").selectExpr(
        "c_custkey as doc", f"array(named_struct('type', 'relation', 'id', c_custkey, 'tags', map('ISO3166-1', concat('K', c_custkey)), "
                            f"'members', {members})) as elements")
    text = rows.select("doc", F.to_json(F.struct("elements")).alias("text"))
    rings = outline_source.assembled_rings(country_source.dump_from_text(text, "text"), ["doc"])
    line = F.transform("rings", lambda r: F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p["x"].cast("long"), p["y"].cast("long"))), ","))
    return rings.select("iso_code", "open_ways", F.array_join(line, ";").alias("outline"))


# --- projections, filters, predicates ---------------------------------------


@register("parse_measurement", f"""
select line, case when line % 19 = 14 then cast('nan' as double) else soc_percent end as soc_percent,
       case when line % 19 = 14 then '' else soc_method end as soc_method, soc_parsed
from (select o_orderkey as line, {MEASURED} as soc_percent, {METHOD} as soc_method,
             o_orderkey % 19 not in (0, 1, 2, 3, 5, 6, 7, 8, 11, 12) as soc_parsed from orders) m""")
def parse_measurement_query(spark, d):
    text = F.when(F.col("line") % 19 == 14, '{"value": NaN}').otherwise(F.col("soc_percent"))
    return I.raw_samples(spark, d).select("line", parse_measurement(text).alias("m")).select("line", "m.*")


@register("clay_fraction", f"select event_id, {CLAY.format(v='value / 20')} as clay_fraction from events")
def clay_fraction_query(spark, d):
    return I.table(spark, d, "events").select(
        "event_id", clay_fraction(F.col("value") / 20).alias("clay_fraction"))


@register("filter_country_codes", f"""
select id, name, iso_code from ({V.CUSTOMER_COUNTRIES}) c
where iso_code in ('AT','BE','CZ','DE','ES','FR','IT','NL','PL','SE')""")
def filter_country_codes(spark, d):
    return country_source.filter_country_codes(
        I.customer_countries(spark, d).select("id", "name", "iso_code"))


@register("valid_boundaries", f"""
select id, boundary from ({V.CUSTOMER_COUNTRIES}) c where boundary is not null""")
def valid_boundaries(spark, d):
    return spatial.valid_boundaries(I.customer_countries(spark, d).select("id", "boundary"))


@register("countries_with_samples", f"""
select id, name, iso_code, sample_count from ({V.CUSTOMER_COUNTRIES}) c where sample_count > 0""")
def countries_with_samples(spark, d):
    return spatial.countries_with_samples(I.customer_countries(spark, d))


@register("min_group_filter", f"""with {LOCATED}
select id, country_id from located
where country_id in (select country_id from located group by country_id having count(*) >= 10)""")
def min_group_filter(spark, d):
    return clustering.min_group_filter(
        I.located(spark, d).select("id", "country_id"), D.MIN_SAMPLES_PER_COUNTRY)


@register("required_columns_check", f"""
select raw_data_id, round(longitude, 6) as longitude,
       latitude is null or soc_percent is null as rejected
from ({V.WILD_SAMPLES}) w""")
def required_columns_check(spark, d):
    return I.tidy(tables.required_columns_check(I.wild_samples(spark, d)),
                  "raw_data_id", "longitude", "rejected")


@register("view_samples", f"""with {LOCATED}
select id, round(soc_percent, 6) as soc_percent, country_id
from located where country_id = 6 order by id limit 100""")
def view_samples(spark, d):
    shown = tables.view_samples(I.located(spark, d), country_id=6)
    return I.tidy(shown, "id", "soc_percent", "country_id")


@register("view_clusters", f"""with {ZONES}
select cluster_number, round(center_latitude, 6) as center_latitude,
       round(center_longitude, 6) as center_longitude, sample_count
from zone_clusters where country_id = 4""")
def view_clusters(spark, d):
    return I.tidy(tables.view_clusters(I.zone_clusters(spark, d), 4)).drop("country_id")


@register("reproject", f"""
select id, round(radians(longitude) * 6378137, 4) as x,
       round(ln(tan(radians(latitude) / 2 + pi() / 4)) * 6378137, 4) as y,
       round(longitude, 6) as longitude, round(latitude, 6) as latitude
from ({V.SAMPLES}) s""")
def reproject(spark, d):
    moved = I.samples(spark, d).select("id", G.to_web_mercator("longitude", "latitude").alias("m"))
    back = moved.select("id", "m.*", G.from_web_mercator("m.x", "m.y").alias("b")).select(
        "id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"),
        F.round("b.longitude", 6).alias("longitude"), F.round("b.latitude", 6).alias("latitude"))
    return back


# Third flattening and squared eccentricity of the ellipsoid.
ELLIPSOID = """consts as (
  select 1 / 298.257223563e0 as f, f / (2 - f) as n, f * (2 - f) as e2, sqrt(f * (2 - f)) as e,
         6378137e0 / (1 + n) * (1 + n*n/4 + n*n*n*n/64) as a)"""


@register("reproject_zones", f"""with s as ({V.SAMPLES}), {ELLIPSOID},
t as (
  select id, longitude, latitude, n, a, floor((longitude + 180) / 6) * 6 - 177 as mid,
         radians(longitude - mid) as l, sin(radians(latitude)) as p, 2 * sqrt(n) / (1 + n) as r,
         sinh(atanh(p) - r * atanh(r * p)) as t, atan2(t, cos(l)) as u, atanh(sin(l) / sqrt(1 + t * t)) as v,
         n/2 - 2*n**2/3 + 5*n**3/16 + 41*n**4/180 as a1, 13*n**2/48 - 3*n**3/5 + 557*n**4/1440 as a2,
         61*n**3/240 - 103*n**4/140 as a3, 49561*n**4/161280 as a4
  from s, consts)
select id, cast(mid as bigint) as meridian,
       round(500000 + 0.9996e0 * a * (v + a1*cos(2*u)*sinh(2*v) + a2*cos(4*u)*sinh(4*v) + a3*cos(6*u)*sinh(6*v)
             + a4*cos(8*u)*sinh(8*v)), 2) as x,
       round(0.9996e0 * a * (u + a1*sin(2*u)*cosh(2*v) + a2*sin(4*u)*cosh(4*v) + a3*sin(6*u)*cosh(6*v)
             + a4*sin(8*u)*cosh(8*v)), 2) as y,
       round(longitude, 6) as longitude, round(latitude, 6) as latitude
from t""")
def reproject_zones(spark, d):
    placed = I.samples(spark, d).withColumn("meridian", P.zone_meridian("longitude").cast("long"))
    moved = placed.select("id", "meridian", P.to_transverse_mercator("longitude", "latitude", "meridian").alias("m"))
    back = P.from_transverse_mercator("m.x", "m.y", "meridian")
    return moved.withColumn("b", back).select(
        "id", "meridian", F.round("m.x", 2).alias("x"), F.round("m.y", 2).alias("y"),
        F.round("b.longitude", 6).alias("longitude"), F.round("b.latitude", 6).alias("latitude"))


def _area_sql(sine: str) -> str:
    return f"((1 - e2) * ({sine} / (1 - e2 * {sine} * {sine}) - ln((1 - e * {sine}) / (1 + e * {sine})) / (2 * e)))"


@register("reproject_equal_area", f"""with s as ({V.SAMPLES}), {ELLIPSOID},
t as (
  select id, longitude, latitude, radians(longitude - 10) as l, sin(radians(latitude)) as p, sin(radians(52)) as p0,
         {_area_sql("1e0")} as q1, asin({_area_sql("p")} / q1) as b, asin({_area_sql("p0")} / q1) as b0,
         6378137e0 * sqrt(q1 / 2) as r, 6378137e0 * cos(radians(52)) / sqrt(1 - e2 * p0 * p0) / (r * cos(b0)) as d,
         r * sqrt(2 / (1 + sin(b0) * sin(b) + cos(b0) * cos(b) * cos(l))) as k
  from s, consts)
select id, round(4321000 + k * d * cos(b) * sin(l), 2) as x,
       round(3210000 + k / d * (cos(b0) * sin(b) - sin(b0) * cos(b) * cos(l)), 2) as y,
       round(longitude, 6) as longitude, round(latitude, 6) as latitude
from t""")
def reproject_equal_area(spark, d):
    moved = I.samples(spark, d).select("id", P.to_equal_area("longitude", "latitude").alias("m"))
    return moved.withColumn("b", P.from_equal_area("m.x", "m.y")).select(
        "id", F.round("m.x", 2).alias("x"), F.round("m.y", 2).alias("y"),
        F.round("b.longitude", 6).alias("longitude"), F.round("b.latitude", 6).alias("latitude"))


# --- joins ------------------------------------------------------------------


@register("points_in_polygons", f"""with {LOCATED}
select id, country_id from located where country_id is not null""")
def points_in_polygons(spark, d):
    return spatial.points_in_polygons(I.samples(spark, d), I.boundaries(spark))


# L-shaped outlines with a square hole, one per supplier.
SHAPES = """
select s_suppkey as country_id, cast((s_suppkey * 37) % 300 as double) / 10 - 10 as x,
       cast((s_suppkey * 53) % 170 as double) / 10 + 35 as y, 1 + cast(s_suppkey % 5 as double) as a
from supplier
"""
CORNERS = [
    [(0, 0), (4, 0), (4, 1), (1.5, 1), (1, 3), (0, 3), (0, 0)],
    [(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75), (0.25, 0.25)],
]
SHAPE_EDGES = ", ".join(
    f"({a[0]}e0, {a[1]}e0, {b[0]}e0, {b[1]}e0)" for ring in CORNERS for a, b in zip(ring, ring[1:])
)
IN_SHAPES = f"""
with samples as ({V.SAMPLES}), shapes as ({SHAPES}),
edges as (
  select country_id, x, y, a, x + a * u1 as x1, y + a * v1 as y1, x + a * u2 as x2, y + a * v2 as y2
  from shapes, (values {SHAPE_EDGES}) as e(u1, v1, u2, v2)),
hits as (
  select s.id, e.country_id,
         count(*) filter (where (y1 > latitude) <> (y2 > latitude)
           and longitude < x1 + (x2 - x1) * ((latitude - y1) / nullif(y2 - y1, 0))) % 2 = 1
         and not bool_or((x2 - x1) * (latitude - y1) - (y2 - y1) * (longitude - x1) = 0
           and longitude between least(x1, x2) and greatest(x1, x2)
           and latitude between least(y1, y2) and greatest(y1, y2)) as inside
  from samples s join edges e
    on s.longitude between e.x and e.x + 4 * e.a and s.latitude between e.y and e.y + 3 * e.a
  group by s.id, e.country_id)
select id, max(country_id) as country_id from hits where inside group by id"""


def _shapes(spark, d):
    def ring(points):
        return F.array(*[
            F.struct((F.col("x") + F.col("a") * float(u)).alias("x"),
                     (F.col("y") + F.col("a") * float(v)).alias("y")) for u, v in points])

    shapes = I.view(spark, d, SHAPES, "supplier")
    return shapes.select("country_id", F.array(*[ring(r) for r in CORNERS]).alias("rings"))


@register("points_in_concave_polygons", IN_SHAPES)
def points_in_concave_polygons(spark, d):
    return spatial.points_in_polygons(I.samples(spark, d), _shapes(spark, d))


@register("points_in_polygons_shuffled", IN_SHAPES)
def points_in_polygons_shuffled(spark, d):
    return spatial.points_in_polygons(I.samples(spark, d), _shapes(spark, d), max_broadcast_edges=0)


@register("point_geometry", f"""
select id, round(longitude, 6) as lon, round(latitude, 6) as lat from ({V.SAMPLES}) s""")
def point_geometry(spark, d):
    return I.tidy(spatial.points(I.samples(spark, d)).select("id", "point.lon", "point.lat"))


OLD_COUNTRY = "case when o_orderstatus = 'O' then o_custkey end"


@register("assign_countries", f"""with {LOCATED}
select l.id, coalesce(l.country_id, {OLD_COUNTRY}) as country_id
from located l join orders on o_orderkey = l.id""")
def assign_countries(spark, d):
    old = I.table(spark, d, "orders").selectExpr("o_orderkey as id", f"{OLD_COUNTRY} as country_id")
    found = spatial.points_in_polygons(I.samples(spark, d), I.boundaries(spark))
    return tables.assign_column(old, found, "id", "country_id")


@register("refresh_sample_counts", f"""with {LOCATED}
select cast(c.id as bigint) as id, c.name,
       (select count(*) from located l where l.country_id = c.id) as sample_count
from (select id, name from countries union all select 99, 'Nowhere') c""")
def refresh_sample_counts(spark, d):
    return spatial.refresh_sample_counts(I.countries_and_nowhere(spark), I.located(spark, d)).select(
        "id", "name", "sample_count")


@register("assign_clusters", f"""with {ZONES}
select l.id, l.country_id, z.id as cluster_id
from located l left join zone_clusters z
  on z.country_id = l.country_id and z.cluster_number = cast(floor(l.latitude) as bigint) % 4 + 1""")
def assign_clusters(spark, d):
    located = cut_lineage(I.located(spark, d).select("id", "country_id", "latitude", "longitude"))
    zoned = I.zones(located)
    ids = tables.surrogate_ids(I.clusters_of(zoned), ["country_id", "cluster_number"])
    members = zoned.select("id", "country_id", "cluster_number")
    return clustering.assign_clusters(located.select("id", "country_id"), members, ids)


@register("active_countries", f"""with {LOCATED}
select cast(id as bigint) as id, name, iso_code from countries
where id in (select country_id from located)""")
def active_countries(spark, d):
    return spatial.active_countries(I.countries_and_nowhere(spark), I.located(spark, d))


@register("unassigned_samples", f"""with {LOCATED}
select id, round(latitude, 6) as latitude, round(longitude, 6) as longitude
from located where country_id is null""")
def unassigned_samples(spark, d):
    found = spatial.points_in_polygons(I.samples(spark, d), I.boundaries(spark))
    return I.tidy(spatial.unassigned_samples(
        I.samples(spark, d).select("id", "latitude", "longitude"), found))


@register("restrict_to_sample", f"""with {LOCATED}, {RANDOM_SAMPLE}
select id, round(soc_percent, 6) as soc_percent from located where id in (select id from sampled)""")
def restrict_to_sample(spark, d):
    rows = I.located(spark, d).select("id", "country_id", "soc_percent")
    return I.tidy(sampling.restrict_to_sample(rows, sampling.random_sample(rows)), "id", "soc_percent")


@register("remaining_samples", f"""with {LOCATED}, {RANDOM_SAMPLE}
select id, round(soc_percent, 6) as soc_percent from located
where id not in (select id from sampled)""")
def remaining_samples(spark, d):
    rows = I.located(spark, d).select("id", "country_id", "soc_percent")
    return I.tidy(sampling.remaining_samples(rows, sampling.random_sample(rows)), "id", "soc_percent")


CLUSTER_FIGURES = f"""with {ZONES},
placed as (
  select z.*, c.id as cluster_id from zoned z
  join zone_clusters c on c.country_id = z.country_id and c.cluster_number = z.cluster_number),
details as (
  select c.name as country_name, z.cluster_number, z.center_latitude, z.center_longitude, z.sample_count
  from zone_clusters z join countries c on c.id = z.country_id),
soc as (
  select c.name as country_name, z.cluster_number, count(s.id) as actual_samples,
         avg(s.soc_percent) as avg_soc
  from zone_clusters z join countries c on c.id = z.country_id
  join placed s on s.country_id = c.id and s.cluster_id = z.id
  group by c.name, z.cluster_number),
stats as (
  select c.name as country_name, count(z.id) as cluster_count,
         avg(z.sample_count) as avg_samples_per_cluster,
         cast(sum(z.sample_count) as bigint) as total_samples,
         min(z.sample_count) as min_cluster_size, max(z.sample_count) as max_cluster_size
  from zone_clusters z join countries c on c.id = z.country_id group by c.name)"""


def _zone_reports(spark, d):
    zoned = cut_lineage(I.zones(I.located(spark, d)).select(
        "id", "country_id", "cluster_number", "latitude", "longitude", "soc_percent"))
    clusters = tables.surrogate_ids(I.clusters_of(zoned), ["country_id", "cluster_number"])
    members = zoned.select("id", "country_id", "cluster_number")
    placed = clustering.assign_clusters(zoned.drop("cluster_number"), members, clusters)
    return analysis.cluster_reports(clusters, I.countries(spark), placed)


@register("cluster_details", f"""{CLUSTER_FIGURES}
select country_name, cluster_number, round(center_latitude, 6) as center_latitude,
       round(center_longitude, 6) as center_longitude, sample_count from details""")
def cluster_details(spark, d):
    return I.tidy(_zone_reports(spark, d).details)


@register("cluster_soc", f"""{CLUSTER_FIGURES}
select country_name, cluster_number, actual_samples, round(avg_soc, 6) as avg_soc from soc""")
def cluster_soc(spark, d):
    return I.tidy(_zone_reports(spark, d).soc)


@register("results_by_country", f"""with {LOCATED}, {RANDOM_SAMPLE}
select country_name, sampling_method, {RESULT_FIGURES} from results""")
def results_by_country(spark, d):
    results = tables.result_rows(_results(spark, d))
    return I.tidy(statistics.results_by_country(results, I.countries(spark)))


@register("view_country_statistics", f"""with {LOCATED}, {RANDOM_SAMPLE}
select country_id, country_name, sample_size, {RESULT_FIGURES} from results""")
def view_country_statistics(spark, d):
    shown = tables.view_country_statistics(_results(spark, d))
    return I.tidy(shown, "country_id", "country_name", "sample_size", "soc_mean", "soc_variance",
                  "clay_fraction_mean")


# --- aggregations -----------------------------------------------------------


@register("sample_statistics", f"""with {LOCATED}, {RANDOM_SAMPLE}
select country_id, count(*) as sample_size, round(avg(soc_percent), 6) as soc_mean,
       round(coalesce(var_samp(soc_percent), 0), 6) as soc_variance,
       round(avg(clay_fraction), 6) as clay_fraction_mean
from sampled group by country_id""")
def sample_statistics(spark, d):
    return I.tidy(statistics.sample_statistics(sampling.random_sample(I.located(spark, d))))


@register("sql_sample_statistics", f"""with {LOCATED}
select country_id, round(avg(soc_percent), 6) as soc_mean,
       round(avg(soc_percent * soc_percent) - avg(soc_percent) * avg(soc_percent), 6) as soc_variance,
       round(avg(clay_fraction), 6) as clay_fraction_mean
from located where country_id is not null group by country_id""")
def sql_sample_statistics(spark, d):
    return I.tidy(statistics.sql_sample_statistics(I.located(spark, d)))


@register("country_statistics", f"""with {LOCATED}, {RANDOM_SAMPLE}
select country_id, country_name, country_code, sampling_method, total_samples, sample_size,
       {RESULT_FIGURES} from results""")
def country_statistics(spark, d):
    return I.tidy(_results(spark, d))


@register("country_full_stats", f"""with {LOCATED}
select cast(c.id as bigint) as country_id, c.name, count(s.id) as total_samples,
       round(avg(s.soc_percent), 6) as soc_mean, round(var_samp(s.soc_percent), 6) as soc_variance,
       round(avg(s.clay_fraction), 6) as clay_fraction_mean
from countries c left join located s on s.country_id = c.id group by c.id, c.name""")
def country_full_stats(spark, d):
    return I.tidy(analysis.country_overview(
        I.samples(spark, d), I.boundaries(spark), I.countries(spark)))


@register("overall_summary", f"""with {LOCATED}, {RANDOM_SAMPLE},
m as (select sum(soc_mean * sample_size) / sum(sample_size) as mean from results)
select count(*) as total_countries, cast(sum(sample_size) as bigint) as total_samples_analyzed,
       round(any_value(mean), 6) as overall_soc_mean,
       round(sum(sample_size * (soc_mean - mean) * (soc_mean - mean)) / sum(sample_size), 6)
         as overall_soc_variance,
       round(sum(clay_fraction_mean * sample_size) / sum(sample_size), 6) as overall_clay_fraction_mean,
       string_agg(concat(country_code, ' ', sample_size), ', ' order by country_code) as countries
from results, m""")
def overall_summary(spark, d):
    listed = F.transform(
        "country_summary",
        lambda c: F.concat(c["country_code"], F.lit(" "), c["sample_size"].cast("string")))
    one = statistics.overall_summary(_results(spark, d))
    return I.tidy(one.withColumn("countries", F.array_join(listed, ", ")).drop(
        "country_summary", "between_country_variance"))


@register("cluster_stats_by_country", f"""{CLUSTER_FIGURES}
select country_name, cluster_count, round(avg_samples_per_cluster, 6) as avg_samples_per_cluster,
       total_samples, min_cluster_size, max_cluster_size from stats""")
def cluster_stats_by_country(spark, d):
    return I.tidy(_zone_reports(spark, d).stats)


@register("soc_variability", f"""{CLUSTER_FIGURES}
select country_name, round(avg(avg_soc), 3) as mean_soc, round(stddev_samp(avg_soc), 3) as std_soc,
       cast(sum(actual_samples) as bigint) as total_samples
from soc group by country_name""")
def soc_variability(spark, d):
    return I.tidy(_zone_reports(spark, d).variability)


@register("cluster_report", f"""{CLUSTER_FIGURES}
select count(*) as total_countries, cast(sum(cluster_count) as bigint) as total_clusters,
       cast(sum(total_samples) as bigint) as total_samples,
       round(avg(cluster_count), 6) as avg_clusters_per_country,
       round(avg(avg_samples_per_cluster), 6) as avg_samples_per_cluster,
       (select country_name from stats order by cluster_count desc, country_name limit 1) as most_clusters,
       (select country_name from stats order by avg_samples_per_cluster desc, country_name limit 1)
         as largest_avg_cluster,
       (select country_name from stats order by total_samples desc, country_name limit 1) as most_samples,
       round(stddev_samp(avg_samples_per_cluster) / avg(avg_samples_per_cluster), 6) as cluster_size_cv,
       coalesce(string_agg(country_name, ', ' order by country_name)
         filter (where avg_samples_per_cluster > 100), '') as large_cluster_countries,
       coalesce(string_agg(country_name, ', ' order by country_name)
         filter (where avg_samples_per_cluster < 10), '') as small_cluster_countries,
       (select count(*) from details) as distinct_regions,
       (select count(*) from soc) as soc_measurements,
       (select round(avg(avg_soc), 6) from soc) as mean_soc,
       (select round(min(avg_soc), 6) from soc) as min_soc,
       (select round(max(avg_soc), 6) from soc) as max_soc
from stats""")
def cluster_report(spark, d):
    return I.tidy(_zone_reports(spark, d).headline)


@register("association_coverage", f"""with {LOCATED}
select count(*) as total_samples, count(country_id) as associated_samples,
       count(*) - count(country_id) as unassigned_samples,
       round(count(country_id) * 100.0 / count(*), 6) as coverage_percentage,
       count(distinct country_id) as countries_with_samples,
       (select count(*) from countries) as total_countries
from located""")
def association_coverage(spark, d):
    return I.tidy(spatial.association_coverage(I.located(spark, d), I.countries(spark)))


@register("country_distribution", f"""with {LOCATED}
select c.iso_code, count(s.id) as n_samples
from (select id, iso_code from countries union all select 99, 'XX') c
left join located s on s.country_id = c.id
group by c.iso_code""")
def country_distribution(spark, d):
    return spatial.country_distribution(I.located(spark, d), I.countries_and_nowhere(spark))


@register("clustering_coverage", f"""with {ZONES},
kept as (select * from zone_clusters where sample_count >= 5)
select count(distinct country_id) as total_countries, count(*) as total_clusters,
       cast(sum(sample_count) as bigint) as total_samples_clustered,
       round(avg(sample_count), 6) as avg_cluster_size, min(sample_count) as min_cluster_size,
       max(sample_count) as max_cluster_size,
       round(sum(sample_count) * 100.0 / (select count(*) from samples), 6) as clustering_coverage
from kept""")
def clustering_coverage(spark, d):
    kept = I.zone_clusters(spark, d).where("sample_count >= 5")
    return I.tidy(clustering.clustering_coverage(kept, I.samples(spark, d)))


@register("table_counts", f"""with {LOCATED}, {RANDOM_SAMPLE}
select (select count(*) from samples) as soil_samples, (select count(*) from countries) as countries,
       (select count(*) from results) as analysis_results,
       (select count(distinct country_id) from located) as countries_with_samples""")
def table_counts(spark, d):
    located = I.located(spark, d)
    counted = spatial.refresh_sample_counts(I.countries(spark), located)
    return tables.table_counts(located, counted, _results(spark, d))


@register("data_imbalance", f"""with {LOCATED}
select s.country_id, c.name as country_name, count(*) as n_samples,
       round(count(*) * 100.0 / (select count(*) from located), 6) as percentage,
       count(*) * 100.0 / (select count(*) from located) > 50 as dominant
from located s join countries c on c.id = s.country_id group by s.country_id, c.name""")
def data_imbalance(spark, d):
    return I.tidy(quality.data_imbalance(I.located(spark, d), I.countries(spark)))


@register("describe_column", f"""
select column_name, count(v) as n, round(avg(v), 6) as mean, round(stddev_samp(v), 6) as std,
       round(min(v), 6) as min, round(quantile_cont(v, 0.25), 6) as q25,
       round(quantile_cont(v, 0.5), 6) as q50, round(quantile_cont(v, 0.75), 6) as q75,
       round(max(v), 6) as max
from (select 'soc_percent' as column_name, soc_percent as v from ({V.WILD_SAMPLES}) a
      union all select 'clay_fraction', clay_fraction from ({V.WILD_SAMPLES}) b
      union all select 'longitude', longitude from ({V.WILD_SAMPLES}) c) t
group by column_name""")
def describe_column(spark, d):
    return I.tidy(quality.describe_columns(
        I.wild_samples(spark, d), ("soc_percent", "clay_fraction", "longitude")))


@register("missing_counts", f"""with w as ({V.WILD_SAMPLES})
{' union all '.join(
    f"select '{c}' as column_name, count(*) - count({c}) as n_missing from w"
    for c in ("raw_data_id", "latitude", "longitude", "soc_percent", "top_depth_cm",
              "bottom_depth_cm", "sampling_date", "lab_analysis_date", "clay_fraction"))}""")
def missing_counts(spark, d):
    return quality.missing_counts(I.wild_samples(spark, d))


@register("map_extent", f"""{CLUSTER_FIGURES}
select round(min(center_longitude) - 3, 6) as lon_min, round(max(center_longitude) + 3, 6) as lon_max,
       round(min(center_latitude) - 3, 6) as lat_min, round(max(center_latitude) + 3, 6) as lat_max
from details""")
def map_extent(spark, d):
    return I.tidy(reports.map_extent(I.zone_clusters(spark, d)))


@register("label_positions", f"""{CLUSTER_FIGURES}
select country_name, round(avg(center_longitude), 6) as label_longitude,
       round(avg(center_latitude), 6) as label_latitude
from details group by country_name""")
def label_positions(spark, d):
    return I.tidy(reports.label_positions(I.zone_clusters(spark, d), I.countries(spark)))


# --- top country, elbow and sizing rules ------------------------------------


@register("top_country", f"""with {LOCATED}
select country_id, count(*) as n_samples from located where country_id is not null
group by country_id order by n_samples desc, country_id limit 1""")
def top_country(spark, d):
    return quality.top_country(I.located(spark, d))


# Curves from order lines: falling inertia by line number, one curve per part.
CURVES = """
select l_partkey as country_id, cast(l_linenumber as bigint) + 1 as k,
       sum(l_extendedprice) / (l_linenumber * l_linenumber) as inertia
from lineitem group by l_partkey, l_linenumber"""


@register("elbow_k", f"""
select country_id, case when kmax - kmin < 2 then kmin else coalesce(hit, kmax) end as k
from (
  select country_id, min(k) as kmin, max(k) as kmax, min(case when ratio < 0.5 then k end) as hit
  from (
    select country_id, k, case when prev > 0 then drop / prev
                               when prev is not null and drop is not null then 1.0 end as ratio
    from (
      select country_id, k, drop, lag(drop) over (partition by country_id order by k) as prev
      from (select country_id, k,
                   inertia - lead(inertia) over (partition by country_id order by k) as drop
            from (select country_id, k, round(inertia, 6) as inertia from ({CURVES}) c) r) a) b) e
  group by country_id) f""".replace("drop", "fall"))
def elbow_k(spark, d):
    curves = I.view(spark, d, CURVES, "lineitem").withColumn("inertia", F.round("inertia", 6))
    return clustering.elbow_k(curves)


SIZES = "select o_custkey as g, sum(cast(o_totalprice / 1000 as bigint)) as n from orders group by o_custkey"
SIZES = SIZES.replace("cast(o_totalprice / 1000 as bigint)", "cast(floor(o_totalprice / 1000) as bigint)")
UPPER = """least(case when n > 1000 then greatest(10, n // 150) else 10 end, n // 5)"""


@register("k_upper_bound", f"""
select g, cast(n as bigint) as n, cast({UPPER} as bigint) as k from ({SIZES}) s""")
def k_upper_bound_query(spark, d):
    return I.view(spark, d, SIZES, "orders").select("g", "n", k_upper_bound(F.col("n")).alias("k"))


@register("k_large_adjust", f"""
select g, cast(case when n > 1000 and n / k > 300 then least(k + cast(floor(n / k / 200) as bigint), top)
                    else k end as bigint) as k
from (select g, n, least(3, {UPPER}) as k, {UPPER} as top from ({SIZES}) s where n >= 10) t""")
def k_large_adjust_query(spark, d):
    n = F.col("n")
    sizes = I.view(spark, d, SIZES, "orders").where("n >= 10").withColumn("top", k_upper_bound(n))
    start = F.least(F.lit(3).cast("long"), F.col("top"))
    return sizes.select("g", k_large_adjust(n, start, F.col("top")).alias("k"))


# --- sampling and clustering ------------------------------------------------

# Three restarts keep the SQL side of whole-range searches short; the fit itself is not cut.
SEARCH = clustering.ClusterSettings()
SEARCH_SQL = K.fit_ctes(K.range_specs(), D.KMEANS_RESTARTS, D.KMEANS_MAX_ITER, D.KMEANS_TOLERANCE)


@register("random_sample", f"""with {LOCATED}, {RANDOM_SAMPLE}
select id, country_id from sampled""")
def random_sample(spark, d):
    return sampling.random_sample(I.located(spark, d).select("id", "country_id"))


@register("random_sample_large", f"""with {LOCATED}
select id, country_id from (
  select id, country_id,
         row_number() over (partition by country_id order by md5(concat('42:', id)), id) as rk
  from located where country_id is not null) t
where rk <= 1500""")
def random_sample_large(spark, d):
    return sampling.random_sample(I.located(spark, d).select("id", "country_id"), 1500)


PROPORTIONAL_SPECS = """
select g, case when n > 1000 then greatest(5, least(100 // 20, n // 150)) else least(100, n, 10) end as k
from prof where case when n > 1000 then 5 else least(100, n, 10) end >= 2"""
SINGLE_SPECS = "select g, least(10, n // 50) as k from prof where least(10, n // 50) >= 2"


def _sampled_sql(specs: str, draw: str) -> str:
    return f"""with recursive {LOCATED},
{K.fit_ctes(specs, D.KMEANS_RESTARTS, D.KMEANS_MAX_ITER, D.KMEANS_TOLERANCE)},
{K.label_ctes("select g, k from specs")},
sizes as (select g, cluster_number, count(*) as c from members group by g, cluster_number),
{draw},
plain as (
  select id, g from (
    select id, g, row_number() over (partition by g order by md5(concat('42:', id)), id) as rk
    from pts where g not in (select g from specs)) t where rk <= 100)"""


PROPORTIONAL_DRAW = """
quota as (
  select g, cluster_number, quota, greatest(100 - sum(quota) over (partition by g), 0) as short
  from (select g, cluster_number,
               least(greatest(1, cast(floor(100 * (c / sum(c) over (partition by g))) as bigint)), c)
                 as quota
        from sizes) q),
ranks as (
  select m.id, m.g, q.quota, q.short,
         row_number() over (partition by m.g, m.cluster_number
                            order by md5(concat('42:', m.id)), m.id) as rk
  from members m join quota q on q.g = m.g and q.cluster_number = m.cluster_number),
drawn as (
  select id, g from ranks where rk <= quota
  union all
  select id, g from (
    select id, g, short, row_number() over (partition by g order by md5(concat('42:', id)), id) as f
    from ranks where rk > quota) x where f <= short)"""
SINGLE_DRAW = """
picked as (
  select g, coalesce(
           arg_min(cluster_number, md5(concat('42:', g, ':', cluster_number))) filter (where c >= 100),
           arg_max(cluster_number, {'c': c, 'minus': -cluster_number})) as cluster_number
  from sizes group by g),
drawn as (
  select id, g from (
    select m.id, m.g, row_number() over (partition by m.g order by md5(concat('42:', m.id)), m.id) as rk
    from members m join picked p on p.g = m.g and p.cluster_number = m.cluster_number) t
  where rk <= 100)"""
PROPORTIONAL_SQL = _sampled_sql(PROPORTIONAL_SPECS, PROPORTIONAL_DRAW)
SINGLE_SQL = _sampled_sql(SINGLE_SPECS, SINGLE_DRAW)
DRAWN = "select id, g as country_id from drawn union all select id, g from plain"


def _positions(spark, d):
    return cut_lineage(I.located(spark, d).select("id", "country_id", "latitude", "longitude"))


@register("cluster_sample", f"{PROPORTIONAL_SQL} {DRAWN}")
def cluster_sample(spark, d):
    return sampling.cluster_sample(_positions(spark, d)).select("id", "country_id")


@register("single_cluster_sample", f"{SINGLE_SQL} {DRAWN}")
def single_cluster_sample(spark, d):
    return sampling.single_cluster_sample(_positions(spark, d)).select("id", "country_id")


def _figures_sql(prefix: str, method: str) -> str:
    return f"""{prefix}, all_drawn as ({DRAWN})
select s.country_id, c.name as country_name, c.iso_code as country_code,
       '{method}' as sampling_method, p.n as total_samples, count(*) as sample_size,
       round(avg(s.soc_percent), 6) as soc_mean,
       round(coalesce(var_samp(s.soc_percent), 0), 6) as soc_variance,
       round(avg(s.clay_fraction), 6) as clay_fraction_mean
from all_drawn a join located s on s.id = a.id join prof p on p.g = s.country_id and p.n >= 10
join countries c on c.id = s.country_id group by all"""


@register("country_statistics_clustering", _figures_sql(PROPORTIONAL_SQL, "clustering"))
def country_statistics_clustering(spark, d):
    return I.tidy(statistics.country_statistics(
        cut_lineage(I.located(spark, d)), I.countries(spark), "clustering"))


@register("country_statistics_single_cluster", _figures_sql(SINGLE_SQL, "single_cluster"))
def country_statistics_single_cluster(spark, d):
    return I.tidy(statistics.country_statistics(
        cut_lineage(I.located(spark, d)), I.countries(spark), "single_cluster"))


@register("grouped_kmeans", f"""with recursive {LOCATED},
{K.fit_ctes("select g, least(5, n) as k from prof", D.KMEANS_RESTARTS, D.KMEANS_MAX_ITER, D.KMEANS_TOLERANCE)},
{K.label_ctes("select g, k from specs")}
select id, g as country_id, cluster_number from members""")
def grouped_kmeans(spark, d):
    rows = _positions(spark, d)
    sizes = rows.where("country_id is not null").groupBy("country_id").count().collect()
    _, labelled = kmeans.grouped_kmeans(rows, [(r.country_id, min(5, r["count"])) for r in sizes])
    return labelled.select("id", "country_id", "cluster_number")


@register("grouped_kmeans_by_rows", ORACLES["grouped_kmeans"])
def grouped_kmeans_by_rows(spark, d):
    rows = _positions(spark, d)
    sizes = rows.where("country_id is not null").groupBy("country_id").count().collect()
    _, labelled = kmeans.grouped_kmeans(
        rows, [(r.country_id, min(5, r["count"])) for r in sizes], KMeansSettings(max_centers=30))
    return labelled.select("id", "country_id", "cluster_number")


COARSE = LOCATED.replace("located as (\n  select s.*,", "located as (\n  select s.* replace (round(s.latitude) as latitude, round(s.longitude) as longitude),")


@register("grouped_kmeans_repeated", f"""with recursive {COARSE},
{K.fit_ctes("select g, least(5, n) as k from prof", D.KMEANS_RESTARTS, D.KMEANS_MAX_ITER, D.KMEANS_TOLERANCE)},
{K.label_ctes("select g, k from specs")}
select id, g as country_id, cluster_number from members""")
def grouped_kmeans_repeated(spark, d):
    """Many rows on few locations."""
    rows = _positions(spark, d).withColumns(
        {"latitude": F.round("latitude"), "longitude": F.round("longitude")})
    sizes = rows.where("country_id is not null").groupBy("country_id").count().collect()
    _, labelled = kmeans.grouped_kmeans(rows, [(r.country_id, min(5, r["count"])) for r in sizes])
    return labelled.select("id", "country_id", "cluster_number")


@register("kmeans_inertia_curve", f"""with recursive {LOCATED}, {SEARCH_SQL}
select g as country_id, k, round(inertia, 4) as inertia from best""")
def kmeans_inertia_curve(spark, d):
    return I.tidy(clustering.inertia_curve(_positions(spark, d), SEARCH), places=4)


CLUSTERED_SQL = f"""with recursive {LOCATED}, {SEARCH_SQL}, {K.label_ctes(K.ADJUSTED)},
kept as (
  select g, cluster_number, avg(lat) as center_latitude, avg(lon) as center_longitude,
         count(*) as sample_count
  from members group by g, cluster_number having count(*) >= 5)"""


@register("cluster_country_samples", f"""{CLUSTERED_SQL}
select g as country_id, cluster_number, round(center_latitude, 6) as center_latitude,
       round(center_longitude, 6) as center_longitude, sample_count from kept""")
def cluster_country_samples(spark, d):
    clusters, _ = clustering.cluster_country_samples(_positions(spark, d), SEARCH)
    return I.tidy(clusters)


@register("cluster_members", f"""{CLUSTERED_SQL}
select m.id, m.g as country_id, m.cluster_number
from members m join kept k on k.g = m.g and k.cluster_number = m.cluster_number""")
def cluster_members(spark, d):
    return clustering.cluster_country_samples(_positions(spark, d), SEARCH)[1]


START = """
select cast(id as bigint) as country_id, j as cluster_number,
       min_lat + (max_lat - min_lat) * j / 7e0 as center_latitude,
       min_lon + (max_lon - min_lon) * ((j * 3) % 7) / 7e0 as center_longitude
from countries cross join {numbers}"""
STEP = f"""with {LOCATED}, start as ({START.format(numbers="range(1, 7) t(j)")}),
step as (
  select s.id, s.country_id, s.latitude, s.longitude, arg_min(c.cluster_number, {{
           'd': (s.latitude - c.center_latitude) * (s.latitude - c.center_latitude)
              + (s.longitude - c.center_longitude) * (s.longitude - c.center_longitude),
           'j': c.cluster_number}}) as cluster_number
  from located s join start c on c.country_id = s.country_id group by all)"""


def _step(spark, d):
    numbers = "(select cast(id as bigint) as j from range(1, 7))"
    start = spark.sql(
        START.format(numbers=numbers).replace("from countries", "from {src}"),
        src=spark.sql(V.COUNTRIES))
    return kmeans.kmeans_assign(_positions(spark, d), start).where("cluster_number is not null")


@register("kmeans_assign", f"{STEP} select id, country_id, cluster_number from step")
def kmeans_assign(spark, d):
    return _step(spark, d).select("id", "country_id", "cluster_number")


@register("kmeans_update", f"""{STEP}
select country_id, cluster_number, round(avg(latitude), 6) as center_latitude,
       round(avg(longitude), 6) as center_longitude, count(*) as sample_count
from step group by country_id, cluster_number""")
def kmeans_update(spark, d):
    return I.tidy(kmeans.kmeans_update(_step(spark, d)))


# --- outlines ---------------------------------------------------------------

# A square per customer whose edge midpoints lie on, near or clearly off the edge.
SQUARES = """
select c_custkey as id, case when c_mktsegment = 'BUILDING' then 0.0004e0
                             when c_mktsegment = 'MACHINERY' then 0.01e0 else 0e0 end as off
from customer"""


@register("simplify_boundaries", f"""
select id, 9 as vertices_before, case when off > 0.001 then 9 else 5 end as vertices_after
from ({SQUARES}) s""")
def simplify_boundaries(spark, d):
    off = F.col("off")
    one, half, zero = F.lit(1.0), F.lit(0.5), F.lit(0.0)
    corners = [
        (zero, zero), (half, zero - off), (one, zero), (one + off, half), (one, one), (half, one + off),
        (zero, one), (zero - off, half), (zero, zero),
    ]
    ring = F.array(*[F.struct(x.alias("x"), y.alias("y")) for x, y in corners])
    squares = I.view(spark, d, SQUARES, "customer").select("id", F.array(ring).alias("rings"))
    counted = squares.withColumn("vertices_before", F.size(F.flatten("rings")))
    return I.tidy(simplify.simplify_boundaries(counted).select(
        "id", "vertices_before", F.size(F.flatten("rings")).alias("vertices_after")))


# --- quality ----------------------------------------------------------------


@register("validate_ranges", f"""with w as ({V.WILD_SAMPLES}), r as (
  select min(latitude) as lat_min, max(latitude) as lat_max, min(longitude) as lon_min,
         max(longitude) as lon_max, min(soc_percent) as soc_min, max(soc_percent) as soc_max,
         min(top_depth_cm) as d_min, max(bottom_depth_cm) as d_max,
         8 * count(*) - count(latitude) - count(longitude) - count(soc_percent) - count(top_depth_cm)
           - count(bottom_depth_cm) - count(sampling_date) - count(lab_analysis_date)
           - count(clay_fraction) as missing
  from w)
select rule, round(cast(low as double), 6) as low, round(cast(high as double), 6) as high from (
  select 'missing_values' as rule, null as low, missing as high, missing > 0 as failed from r
  union all select 'latitude_range', lat_min, lat_max, lat_min < -90 or lat_max > 90 from r
  union all select 'longitude_range', lon_min, lon_max, lon_min < -180 or lon_max > 180 from r
  union all select 'soc_range', soc_min, soc_max, soc_min < 0 or soc_max > 100 from r
  union all select 'depth_range', d_min, d_max, d_min < 0 or d_max > 1000 from r) t
where failed""")
def validate_ranges(spark, d):
    return I.tidy(quality.validate_ranges(I.wild_samples(spark, d)))


WILD_COLUMNS = (
    "raw_data_id", "latitude", "longitude", "soc_percent", "top_depth_cm", "bottom_depth_cm", "sampling_date",
    "lab_analysis_date", "clay_fraction",
)
REPORT_RANGES = {
    "lat": "latitude", "lon": "longitude", "soc": "soc_percent", "top_depth": "top_depth_cm", "bottom_depth": "bottom_depth_cm",
    "sampling_date": "sampling_date", "lab_date": "lab_analysis_date",
}
REPORT_FIGURES = ("n", "mean", "std", "min", "q25", "q50", "q75", "max")


def _range_sql(name: str, column: str) -> str:
    plain = "{0}" if "date" in name or "depth" in name else "round({0}, 6)"
    return ", ".join(f"{plain.format(f'{f}({column})')} as {name}_{f}" for f in ("min", "max"))


def _figures_of(prefix: str, column: str) -> str:
    figures = [f"count({column})", f"avg({column})", f"stddev_samp({column})", f"min({column})",
               *(f"quantile_cont({column}, {q})" for q in (0.25, 0.5, 0.75)), f"max({column})"]
    return ", ".join(f"{x if k == 0 else f'round({x}, 6)'} as {prefix}_{n}" for k, (x, n) in enumerate(zip(figures, REPORT_FIGURES)))


@register("quality_report", f"""with w as ({V.WILD_SAMPLES}), r as (
  select count(*) as total_records, count(*) - count(soc_percent) as soc_missing,
         cast({' + '.join(f"(count(*) - count({c}))" for c in WILD_COLUMNS)} as bigint) as missing_values,
         {', '.join(f"count(*) - count({c}) as missing_{c}" for c in WILD_COLUMNS)},
         {', '.join(_range_sql(n, c) for n, c in REPORT_RANGES.items())},
         {_figures_of("described_soc", "soc_percent")}, {_figures_of("described_clay", "clay_fraction")}
  from w),
i as (
  select case when soc_missing > 0 then concat('SOC% missing values: ', soc_missing) end as a,
         case when lat_min < -90 or lat_max > 90 then 'Invalid latitude range detected' end as b,
         case when lon_min < -180 or lon_max > 180 then 'Invalid longitude range detected' end as c,
         case when soc_min < 0 or soc_max > 100 then 'SOC% values outside expected range (0-100%)' end
           as e
  from r)
select r.* replace (cast(top_depth_min as bigint) as top_depth_min, cast(top_depth_max as bigint) as top_depth_max,
                    cast(bottom_depth_min as bigint) as bottom_depth_min, cast(bottom_depth_max as bigint) as bottom_depth_max),
       concat_ws('; ', a, b, c, e) as issues,
       cast(greatest(0, 100 - 10 * (case when a is null then 0 else 1 end
         + case when b is null then 0 else 1 end + case when c is null then 0 else 1 end
         + case when e is null then 0 else 1 end)) as bigint) as quality_score
from r, i""")
def quality_report(spark, d):
    """Every column of the report, maps spread to columns."""
    report = quality.quality_report(I.wild_samples(spark, d))
    spread = [F.col("missing")[c].alias(f"missing_{c}") for c in WILD_COLUMNS]
    spread += [
        F.col("descriptions")[c][f].alias(f"{prefix}_{f}")
        for prefix, c in (("described_soc", "soc_percent"), ("described_clay", "clay_fraction")) for f in REPORT_FIGURES
    ]
    return I.tidy(report.withColumn("issues", F.array_join("issues", "; ")).select(
        *[c for c in report.columns if c not in ("missing", "descriptions")], *spread))


# Result-like rows, one per customer.
CUSTOMER_RESULTS = """
select c_custkey as country_id, c_name as country_name, cast(c_nationkey as bigint) as sample_size,
       c_acctbal / 150 as soc_mean, (c_acctbal + 500) / 10000 as clay_fraction_mean
from customer"""


@register("validate_results", f"""
select count(*) as total_results,
       count(*) filter (where sample_size = 0) as countries_with_zero_samples,
       count(*) filter (where sample_size <> 0 and sample_size < 10) as countries_with_low_samples,
       count(*) filter (where soc_mean > 50 or soc_mean < 0) as anomalous_soc_values,
       count(*) filter (where clay_fraction_mean > 1 or clay_fraction_mean < 0) as anomalous_clay_values
from ({CUSTOMER_RESULTS}) r""")
def validate_results(spark, d):
    return statistics.validate_results(I.view(spark, d, CUSTOMER_RESULTS, "customer"))


@register("result_warnings", f"""with r as ({CUSTOMER_RESULTS})
select country_id, 'zero_samples' as rule, concat('Country ', country_name, ' has zero samples') as warning
from r where sample_size = 0
union all select country_id, 'low_samples',
  concat('Country ', country_name, ' has only ', sample_size, ' samples')
from r where sample_size <> 0 and sample_size < 10
union all select country_id, 'anomalous_soc',
  concat('Country ', country_name, ' has anomalous SOC mean: ', printf('%.3f', soc_mean), '%')
from r where soc_mean > 50 or soc_mean < 0
union all select country_id, 'anomalous_clay',
  concat('Country ', country_name, ' has anomalous clay fraction: ', printf('%.3f', clay_fraction_mean))
from r where clay_fraction_mean > 1 or clay_fraction_mean < 0""")
def result_warnings(spark, d):
    return statistics.result_warnings(I.view(spark, d, CUSTOMER_RESULTS, "customer"))


@register("referential_check", """
select o_orderkey, o_custkey * 2 as o_custkey from orders
where o_custkey * 2 not in (select c_custkey from customer)""")
def referential_check(spark, d):
    orders = I.table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("o_custkey"))
    return tables.referential_check(orders, "o_custkey", I.table(spark, d, "customer"), "c_custkey")


@register("unique_check", """
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, count(*) as n_rows
from lineitem group by all having count(*) > 1""")
def unique_check(spark, d):
    return I.tidy(tables.duplicate_keys(I.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]))


# --- run log ----------------------------------------------------------------


@register("append_run_log", f"""
select log_level, count(*) as entries, cast(sum(duration_ms) as bigint) as total_ms,
       count(error_details) as with_details
from ({V.RUN_LOG}) l group by log_level""")
def append_run_log(spark, d):
    path = fresh_path(spark, "run-log")
    log = I.run_log(spark, d)
    runlog.append_run_log(log.where("log_level = 'ERROR'"), path)
    runlog.append_run_log(log.where("log_level <> 'ERROR'"), path)
    return runlog.read_run_log(spark, path).groupBy("log_level").agg(
        F.count(F.lit(1)).alias("entries"), F.sum("duration_ms").alias("total_ms"),
        F.count("error_details").alias("with_details"))


@register("slow_operations", f"""
select run_id, stage_name, message, duration_ms from ({V.RUN_LOG}) l where duration_ms > 1000""")
def slow_operations(spark, d):
    return runlog.slow_operations(I.run_log(spark, d)).select(
        "run_id", "stage_name", "message", "duration_ms")


@register("stage_performance", f"""
select run_id, stage_name, count(*) as entries, min(duration_ms) as min_ms, max(duration_ms) as max_ms,
       cast(sum(duration_ms) as bigint) as total_ms, cast(sum(record_count) as bigint) as records
from ({V.RUN_LOG}) l group by run_id, stage_name""")
def stage_performance(spark, d):
    return runlog.stage_performance(I.run_log(spark, d))


@register("errors_and_warnings", f"""
select run_id, stage_name, log_level, message from ({V.RUN_LOG}) l
where log_level in ('ERROR', 'WARNING')""")
def errors_and_warnings(spark, d):
    return runlog.errors_and_warnings(I.run_log(spark, d)).select(
        "run_id", "stage_name", "log_level", "message")


@register("run_summary", f"""with {LOCATED}, {RANDOM_SAMPLE}
select 'counts' as section, 'soil_samples' as key, cast((select count(*) from samples) as string) as value
union all select 'counts', 'countries', cast((select count(*) from countries) as string)
union all select 'counts', 'analysis_results', cast((select count(*) from results) as string)
union all select 'counts', 'countries_with_samples',
  cast((select count(distinct country_id) from located) as string)
union all select 'run', 'run_id', 'run-1'
union all select 'settings', 'sample_size', '100'
union all select 'settings', 'country_codes', 'None'""")
def run_summary(spark, d):
    return runlog.run_summary(
        table_counts(spark, d), "run-1", {"sample_size": 100, "country_codes": None})
