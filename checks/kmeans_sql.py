"""k-means as one recursive DuckDB query, used as the counterpart of the keyed fit."""

from __future__ import annotations

from checks import views


def located_ctes() -> str:
    """samples, countries and located (samples with the country that wins)."""
    return f"""
samples as ({views.SAMPLES}),
countries as ({views.COUNTRIES}),
assoc as (
  select s.id, max(c.id) as country_id
  from samples s join countries c
    on s.longitude > c.min_lon and s.longitude < c.max_lon
   and s.latitude > c.min_lat and s.latitude < c.max_lat
  group by s.id),
located as (
  select s.*, cast(a.country_id as bigint) as country_id
  from samples s left join assoc a on a.id = s.id)
"""


def fit_ctes(specs: str, restarts: int, max_iter: int, tolerance: float, seed: int = 42) -> str:
    """CTEs after located_ctes: best (model per group and k) and labelled members.

    ``specs`` selects (g, k) and may read ``prof`` (g, n, spread).
    """
    return f"""
pts as materialized (
  select country_id as g, id, latitude as lat, longitude as lon
  from located where country_id is not null),
prof as materialized (
  select g, count(*) as n, (var_pop(lat) + var_pop(lon)) / 2 as spread from pts group by g),
specs as materialized ({specs}),
places as materialized (
  select g, lat, lon, count(*) as w from pts group by g, lat, lon),
tops as materialized (select g, max(k) as top from specs group by g),
digests as materialized (
  select *, cast(concat('0x', substr(h, 1, 13)) as bigint) as x, cast(concat('0x', substr(h, 14, 13)) as bigint) as y
  from (select *, md5(concat({seed}, ':', cast(floor(lat * 1000000) as bigint), ':', cast(floor(lon * 1000000) as bigint))) as h
        from places) d),
waits as materialized (
  select g, lat, lon, w, t.r, -ln(((x + t.r * y) % 4503599627370496 + 0.5) / 4503599627370496) as e
  from digests cross join range({restarts}) t(r)),
draws as (
  select 0 as s, g, r, lat, lon, w, e, cast(null as double) as d2, cast(null as double) as plat, cast(null as double) as plon
  from waits
  union all
  select s + 1, g, r, lat, lon, w, e,
         least((lat - nlat) * (lat - nlat) + (lon - nlon) * (lon - nlon), coalesce(d2, cast('infinity' as double))), nlat, nlon
  from (
    select *, first_value(lat) over best as nlat, first_value(lon) over best as nlon, first_value(key) over best as least_key
    from (
      select d.*, case when d2 is null then e / w when d2 > 0 then e / (w * d2) else cast('infinity' as double) end as key
      from draws d join tops t on t.g = d.g and d.s < t.top) k
    window best as (partition by g, r order by key, lat, lon)) b
  where least_key < cast('infinity' as double)),
ranked as materialized (select distinct g, r, s as rk, plat as lat, plon as lon from draws where s > 0),
seeds as materialized (
  select s.g, s.k, q.r, p.spread * {tolerance} as lim,
         list(round(q.lat, 9) order by q.rk) as clat, list(round(q.lon, 9) order by q.rk) as clon
  from specs s join ranked q on q.g = s.g and q.rk <= s.k join prof p on p.g = s.g
  group by s.g, s.k, q.r, p.spread),
lloyd as (
  select 0 as it, g, k, r, lim, clat, clon, false as done from seeds
  union all
  select it, g, k, r, lim, nlat, nlon,
         list_sum([(nlat[j]-clat[j])*(nlat[j]-clat[j]) + (nlon[j]-clon[j])*(nlon[j]-clon[j])
                   for j in range(1, len(clat) + 1)]) <= lim
  from (
    with cur as (
      select it + 1 as it, g, k, r, lim, unnest(range(1, len(clat) + 1)) as j,
             unnest(clat) as lat, unnest(clon) as lon
      from lloyd where not done and it < {max_iter}),
    near as (
      select g, k, r, lat, lon, w, list_position(d, list_min(d)) as j, list_min(d) as dist
      from (
        select p.lat, p.lon, p.w, l.g, l.k, l.r,
               [(p.lat-l.clat[j])*(p.lat-l.clat[j]) + (p.lon-l.clon[j])*(p.lon-l.clon[j])
                for j in range(1, len(l.clat) + 1)] as d
        from lloyd l join places p on p.g = l.g
        where not l.done and l.it < {max_iter}) b),
    m as (
      select g, k, r, j, round(sum(w * lat) / sum(w), 9) as lat, round(sum(w * lon) / sum(w), 9) as lon
      from near group by g, k, r, j),
    gone as (
      select g, k, r, j, row_number() over (partition by g, k, r order by j) as rk
      from cur anti join m using (g, k, r, j)),
    far as (
      select g, k, r, lat, lon, row_number() over (partition by g, k, r order by dist desc, lat, lon) as rk
      from near semi join gone using (g, k, r)),
    sent as (
      select e.g, e.k, e.r, e.j, round(f.lat, 9) as lat, round(f.lon, 9) as lon
      from gone e join far f on f.g = e.g and f.k = e.k and f.r = e.r and f.rk = e.rk)
    select c.it, c.g, c.k, c.r, c.lim,
           list(c.lat order by c.j) as clat, list(c.lon order by c.j) as clon,
           list(coalesce(m.lat, t.lat, c.lat) order by c.j) as nlat,
           list(coalesce(m.lon, t.lon, c.lon) order by c.j) as nlon
    from cur c
    left join m on m.g = c.g and m.k = c.k and m.r = c.r and m.j = c.j
    left join sent t on t.g = c.g and t.k = c.k and t.r = c.r and t.j = c.j
    group by c.it, c.g, c.k, c.r, c.lim) u),
final as materialized (
  select g, k, r, arg_max(clat, it) as clat, arg_max(clon, it) as clon
  from lloyd group by g, k, r),
scored as materialized (
  select f.g, f.k, f.r,
         round(sum(list_min([(p.lat-f.clat[j])*(p.lat-f.clat[j])
                           + (p.lon-f.clon[j])*(p.lon-f.clon[j])
                             for j in range(1, len(f.clat) + 1)])), 6) as inertia
  from final f join pts p on p.g = f.g group by f.g, f.k, f.r),
best as materialized (
  select s.g, s.k, min({{'i': s.inertia, 'r': s.r}}).r as r, min(s.inertia) as inertia
  from scored s group by s.g, s.k)
"""


def label_ctes(chosen: str) -> str:
    """CTEs after fit_ctes: members (id, g, cluster_number) under the chosen (g, k)."""
    return f"""
chosen as materialized ({chosen}),
centers as materialized (
  select g, k, row_number() over (partition by g, k order by lat, lon) as cluster_number, lat, lon
  from (
    select f.g, f.k, unnest(f.clat) as lat, unnest(f.clon) as lon
    from final f join best b on b.g = f.g and b.k = f.k and b.r = f.r
    join chosen c on c.g = f.g and c.k = f.k) x),
members as materialized (
  select p.id, p.g, p.lat, p.lon,
         arg_min(c.cluster_number, {{'d': (p.lat-c.lat)*(p.lat-c.lat) + (p.lon-c.lon)*(p.lon-c.lon),
                                     'j': c.cluster_number}}) as cluster_number
  from pts p join centers c on c.g = p.g group by p.id, p.g, p.lat, p.lon)
"""


ELBOW = """
select g, case when kmax - kmin < 2 then kmin else coalesce(hit, kmax) end as k
from (
  select g, min(k) as kmin, max(k) as kmax, min(case when ratio < 0.5 then k end) as hit
  from (
    select g, k, case when prev > 0 then d / prev when prev is not null and d is not null then 1.0
                 end as ratio
    from (
      select g, k, d, lag(d) over (partition by g order by k) as prev
      from (select g, k, inertia - lead(inertia) over (partition by g order by k) as d from best) a
    ) b) c
  group by g) e
"""


def range_specs(min_clusters: int = 2, max_clusters: int = 10, min_rows: int = 5) -> str:
    """Every (g, k) of the cluster-count search."""
    return f"""
select g, unnest(range({min_clusters}, top + 1)) as k
from (select g, n,
             least(case when n > 1000 then greatest({max_clusters}, n // 150) else {max_clusters} end,
                   n // {min_rows}) as top
      from prof) t
where top >= {min_clusters} and n >= {min_rows * min_clusters}
"""


ADJUSTED = f"""
select e.g, case when p.n > 1000 and p.n / e.k > 300
                 then least(e.k + cast(floor(p.n / e.k / 200) as bigint), t.top) else e.k end as k
from ({ELBOW}) e join prof p on p.g = e.g
join (select g, max(k) as top from best group by g) t on t.g = e.g
"""
