"""DuckDB SQL for every registered question, on its own: the correctness oracle.

Nothing is imported from the package. The views that ``sources.standins`` derives are
stated here a second time, as SQL over the driver's base tables, and all fixed values
(labels, parts of the day, the files' columns, codes) are literals.
"""

from __future__ import annotations

CORE = "incident_id, occurred_at, time_hhmm, area_id, area_name, category, weapon_code, premises, lat, lon"
Y0, Y1 = "TIMESTAMP '1997-01-01'", "TIMESTAMP '1998-01-01'"

# One incident per order.
INCIDENTS = """
select o_orderkey as incident_id,
 case when o_orderkey % 97 <> 5 then o_orderdate + to_hours(cast(o_orderkey * 7 % 24 as integer))
   + to_minutes(cast(o_orderkey // 24 % 60 as integer)) end as occurred_at,
 occurred_at + interval 30 hour as reported_at,
 case when o_orderkey % 89 <> 3 then cast(o_orderkey * 7 % 24 * 100 + o_orderkey // 24 % 60 as integer) end as time_hhmm,
 cast(o_custkey % 27 + 1 as integer) as area_id,
 'Area ' || cast(o_custkey % 27 + 1 as varchar) as area_name,
 case when o_orderkey % 13 <> 0 then cast(o_orderkey * 11 % 90 + 10 as integer) end as victim_age,
 case when o_orderkey % 17 <> 0 then substr('ABCDFGHIJKLOPSUVWXZQ', cast(o_orderkey % 20 + 1 as integer), 1) end as category,
 case when o_orderkey % 3 <> 0 then cast(o_orderkey % 450 + 100 as integer) end as weapon_code,
 case o_orderkey % 4 when 0 then 'STREET' when 1 then 'PARKING LOT' when 2 then 'STREET, SIDE' end as premises,
 case when o_orderkey % 9 = 0 then 0.0::double when o_orderkey % 101 <> 0
   then 33.5 + (o_custkey * 37 % 4096)::double / 1024.0 end as lat,
 case when o_orderkey % 9 = 0 then 0.0::double
   else -118.75 + ((o_custkey * 91 + o_custkey // 4096) % 4096)::double / 1024.0 end as lon,
 case when o_orderkey % 5 = 0 then 'THEFT, "PETTY"' else 'THEFT' end as crime_desc
from orders
"""

# One station per nation.
STATIONS = """
select -118.75 + (n_nationkey * 163 % 4096)::double / 1024.0 as x,
 33.5 + (n_nationkey * 211 % 4096)::double / 1024.0 as y,
 cast(n_nationkey + 1 as integer) as fid, 'AREA ' || cast(n_nationkey + 1 as varchar) as division,
 n_name as location, cast(n_nationkey + 1 as integer) as prec
from nation
"""

# Income estimates of four years by ZIP.
ESTIMATES = """
select zip, make_date(year, 1, 1) as since,
 cast(try_cast(regexp_replace(income_text, '[$,]', '', 'g') as float) + ((year - 1995) * 100)::float as float) as income
from incomes, (values (1995), (1997), (1999), (2001)) as y(year)
where (zip + year) % 7 <> 3 and zip % 11 <> 4
"""

# One watch of an area per supplier.
WATCHES = """
select s_suppkey as watch_id, cast(s_suppkey % 28 + 1 as integer) as area_id, start::timestamp as start_at,
 case when s_suppkey % 13 <> 6 then (start + cast(s_suppkey * 17 % 131 as integer))::timestamp end as end_at
from (select s_suppkey, date '1995-01-01' + cast((s_suppkey // 28 * 45 + s_suppkey % 28 * 80) % 2400 as integer) as start from supplier)
"""

# One post per supplier.
POSTS = """
select -118.75 + (place * 1009 % 4096)::double / 1024.0 as x,
 case when s_suppkey % 41 <> 7 then 33.5 + (place * 613 % 4096)::double / 1024.0 end as y,
 s_suppkey as fid, 'Post ' || cast(s_suppkey as varchar) as post
from (select s_suppkey, case when s_suppkey % 10 = 3 then s_suppkey - 3 else s_suppkey end as place from supplier)
"""

# A later release of the incidents.
NEXT_RELEASE = """
select * replace (
  case when year(occurred_at) = 1997 and incident_id % 211 = 4 then occurred_at + interval 400 day else occurred_at end as occurred_at,
  case when not (early and incident_id % 61 = 5) then victim_age end as victim_age)
from (select *, coalesce(year(occurred_at) < 1999, true) as early from incidents) where not (early and incident_id % 83 = 2)
union all by name
select * replace (-incident_id - 1 as incident_id) from (select *, coalesce(year(occurred_at) < 1999, true) as early from incidents)
where early and incident_id % 131 = 0
"""

# One ZIP for 25 customers.
INCOMES = """
select cast(z + 90000 as integer) as zip, 'The "Old" Town, ' || cast(z as varchar) as community,
 case when (z + 90000) % 29 = 7 then '---' else '$' || format('{:,}', amount) end as income_text
from (select c_custkey // 25 as z, sum(cast(floor(c_acctbal) as bigint)) as amount from customer group by 1)
"""

# One place per customer, some of them unknown.
GEOCODES = """
select distinct case when nowhere then 0.0::double else 33.5 + li::double / 1024.0 end as lat,
 case when nowhere then 0.0::double else -118.75 + lo::double / 1024.0 end as lon,
 case when nowhere or li % 64 = 5 then 'N/A' when even then cast(zip as varchar) || ',99999'
   else cast(zip as varchar) end as zip_text
from (select c_custkey % 1000 = 0 as nowhere, c_custkey % 2 = 0 as even, c_custkey // 25 + 90000 as zip,
        c_custkey * 37 % 4096 as li, (c_custkey * 91 + c_custkey // 4096) % 4096 as lo from customer)
"""


def _csv_text(expr: str) -> str:
    """A field of a CSV line: quoted if it holds a comma or a quote, quotes doubled."""
    t = f"coalesce(cast({expr} as varchar), '')"
    return f"""case when {t} similar to '.*[,"].*' then '"' || replace({t}, '"', '""') || '"' else {t} end"""


_DATE = "strftime({}, '%m/%d/%Y %I:%M:%S %p')"
# The files' 28 columns: name in the typed table, type there, and the value written (none: empty).
FILE_COLUMNS = (
    ("incident_id", "bigint", "incident_id"), ("reported_text", "string", _DATE.format("reported_at")),
    ("occurred_text", "string", _DATE.format("occurred_at")), ("time_hhmm", "int", "time_hhmm"),
    ("area_id", "int", "area_id"), ("area_name", "string", "area_name"), ("report_district", "int", None),
    ("part", "int", None), ("crime_code", "int", None), ("crime_desc", "string", "crime_desc"),
    ("mocodes", "string", None), ("victim_age", "int", "victim_age"), ("victim_sex", "string", None),
    ("category", "string", "category"), ("premises_code", "int", None), ("premises", "string", "premises"),
    ("weapon_code", "int", "weapon_code"), ("weapon_desc", "string", None), ("status", "string", None),
    ("status_desc", "string", None), ("crime_code_1", "int", None), ("crime_code_2", "int", None),
    ("crime_code_3", "int", None), ("crime_code_4", "int", None), ("location", "string", None),
    ("cross_street", "string", None), ("lat", "double", "lat"), ("lon", "double", "lon"),
)
LINES = "select concat_ws(',', " + ", ".join(
    _csv_text(value) if value else "''" for _, _, value in FILE_COLUMNS) + ") as value from incidents"


def with_views(body: str, *names: str, ctes: tuple[tuple[str, str], ...] = ()) -> str:
    """``body`` after the views it names and then any further (name, sql) CTEs, in order."""
    views = {"incidents": INCIDENTS, "stations": STATIONS, "incomes": INCOMES, "geocodes": GEOCODES, "lines": LINES,
             "estimates": ESTIMATES, "watches": WATCHES, "posts": POSTS,
             "next_release": NEXT_RELEASE}
    wanted = set(names) | ({"incidents"} if "lines" in names else set())
    parts = [(n, q) for n, q in views.items() if n in wanted] + list(ctes)
    return "with " + ",\n".join(f"{n} as ({q})" for n, q in parts) + "\n" + body


def seg(t: str) -> str:
    """Part of the day of an HHMM number."""
    return (f"case when {t} >= 500 and {t} <= 1158 then 'Morning' when {t} >= 1200 and {t} <= 1658 then 'Afternoon' "
            f"when {t} >= 1700 and {t} <= 2058 then 'Evening' "
            f"when ({t} >= 2100 and {t} <= 2359) or ({t} >= 0 and {t} <= 458) then 'Night' else 'Undefined' end")


def label(c: str) -> str:
    """Victim code to label."""
    return f"""case {c} when 'A' then 'Other Asian' when 'B' then 'Black' when 'C' then 'Chinese' when 'D' then 'Cambodian'
 when 'F' then 'Filipino' when 'G' then 'Guamanian' when 'H' then 'Hispanic/Latin/Mexican'
 when 'I' then 'American Indian/Alaskan Native' when 'J' then 'Japanese' when 'K' then 'Korean' when 'L' then 'Laotian'
 when 'O' then 'Other' when 'P' then 'Pacific Islander' when 'S' then 'Samoan' when 'U' then 'Hawaiian'
 when 'V' then 'Vietnamese' when 'W' then 'White' when 'Z' then 'Asian Indian' else 'Unknown' end"""


def hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle km on a sphere of radius 6371."""
    a = (f"(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))")
    return f"(case when {a} is not null then 6371.0 * 2 * asin(sqrt(least({a}, 1.0))) end)"


def fmt3(x: str) -> str:
    return (f"(case when {x} is null then null when isinf({x}) then '∞' "
            f"else format('{{:,.3f}}', {x}) end)")


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: concat(upper(substr(w, 1, 1)), substr(w, 2))), ' ')")


def money(x: str) -> str:
    return f"try_cast(regexp_replace({x}, '[$,]', '', 'g') as float)"


def zip_head(x: str) -> str:
    return f"string_split({x}, ',')[1]"


_SPOTS = ("spots", """
select lat, lon, cast(occurred_at as date) as day, count(*) as n from incidents
where lat is not null and lon is not null and occurred_at is not null group by 1, 2, 3
""")
TOP_MONTHS_ORACLE = with_views(f"""
select year, month, crime_count, rank from (
  select cast(year(occurred_at) as integer) as year, cast(month(occurred_at) as integer) as month,
         count(*) as crime_count,
         cast(rank() over (partition by year(occurred_at) order by count(*) desc) as integer) as rank
  from incidents where occurred_at is not null
  group by year(occurred_at), month(occurred_at)) t
where rank <= 3
""", "incidents")

DAY_SEGMENTS_ORACLE = with_views(f"""
select {seg('time_hhmm')} as day_segment, count(*) as crime_count
from incidents where premises like '%STREET%' group by 1
""", "incidents")

_INC = ("inc", "select zip, income_text, " + money("income_text") + " as income from incomes")
_SEL = ("sel", f"(select zip from inc order by income desc nulls last, zip limit 3)"
               f" union all (select zip from inc order by income asc nulls first, zip limit 3)")
_GEO = ("geo", f"select lat, lon, try_cast({zip_head('zip_text')} as integer) as zip from geocodes")

EXTREME_ORACLE = with_views(f"""
select {label('i.category')} as category, count(*) as crime_count
from incidents i join geo g on i.lat = g.lat and i.lon = g.lon join sel s on g.zip = s.zip
where i.occurred_at >= {Y0} and i.occurred_at < {Y1} and i.category is not null
group by 1
""", "incidents", "incomes", "geocodes", ctes=(_INC, _SEL, _GEO))

DIVISION_ORACLE = with_views(f"""
select i.area_name as division,
       {fmt3(f"avg(cast({hav('i.lat', 'i.lon', 's.y', 's.x')} as float))")} as average_distance,
       count(i.incident_id) as crime_count
from incidents i left join stations s on upper(i.area_name) = s.division
where i.weapon_code is not null
group by i.area_name
""", "incidents", "stations")

# Brute force for the oracle: per incident, scalar subqueries over every station.
_HAV_IS = hav('i.lat', 'i.lon', 's.y', 's.x')
def _nearest(where: str) -> tuple[tuple[str, str], ...]:
    return (
        ("best", f"select i.incident_id, "
                 f"(select s.division from stations s where {_HAV_IS} is not null "
                 f"order by {_HAV_IS}, s.fid limit 1) as division, "
                 f"(select min({_HAV_IS}) from stations s) as d "
                 f"from incidents i where {where}"),
    )


_ND = ("nd", f"select i.incident_id, i.occurred_at, (select min({_HAV_IS}) from stations s) as d "
             f"from incidents i where i.weapon_code between 100 and 199")


# Every pair of a place and a post.
_POST = (
    ("places", "select distinct lat, lon from incidents where lat is not null and lon is not null"),
    ("post_of", f"select i.lat, i.lon, arg_min(s.post, {{'d': {_HAV_IS}, 'k': s.fid}}) as post, min({_HAV_IS}) as d "
                f"from places i, posts s where s.y is not null group by 1, 2"),
)


def _profile() -> str:
    counted = [(n, t, "occurred_at" if n == "occurred_text" else "reported_at" if n == "reported_text" else v)
               for n, t, v in FILE_COLUMNS]
    counted += [("occurred_at", "timestamp_ntz", "occurred_at"), ("reported_on", "date", "reported_at")]
    return " union all ".join(
        f"select '{n}' as column_name, '{t}' as data_type, true as nullable, "
        f"{f'count({v})' if v else 'cast(0 as bigint)'} as non_null, count(*) as row_count from incidents" for n, t, v in counted)


ORACLE: dict[str, str] = {
    "top_months_by_count": TOP_MONTHS_ORACLE,
    "top_months_by_count_sql": TOP_MONTHS_ORACLE,
    "top_months_by_count_csv": TOP_MONTHS_ORACLE,
    "incidents_per_month": with_views("""
select cast(year(occurred_at) as integer) as year, cast(month(occurred_at) as integer) as month,
       count(*) as crime_count
from incidents where occurred_at is not null group by 1, 2
""", "incidents"),
    "day_segment_counts": DAY_SEGMENTS_ORACLE,
    "day_segment_counts_csv": DAY_SEGMENTS_ORACLE,
    "day_segment_counts_lines": with_views(f"""
select {seg("try_cast(string_split(value, ',')[4] as integer)")} as day_segment, count(*) as crime_count
from lines where contains(string_split(value, ',')[16], 'STREET')
group by 1
""", "lines"),
    "category_counts_extreme_areas": EXTREME_ORACLE,
    "extreme_areas_broadcast": EXTREME_ORACLE,
    "extreme_areas_merge": EXTREME_ORACLE,
    "extreme_areas_shuffle_hash": EXTREME_ORACLE,
    "yearly_area_distance": with_views(f"""
select cast(year(i.occurred_at) as integer) as year,
       {fmt3(f"avg(cast({hav('i.lat', 'i.lon', 'coalesce(s.y, 0.0)', 'coalesce(s.x, 0.0)')} as float))")}
         as average_distance,
       count(i.incident_id) as crime_count
from incidents i left join stations s on i.area_id = s.prec
where i.weapon_code between 100 and 199
group by 1
""", "incidents", "stations"),
    "division_distance_stats": DIVISION_ORACLE,
    "division_distance_broadcast": DIVISION_ORACLE,
    "division_distance_merge": DIVISION_ORACLE,
    "division_distance_shuffle_hash": DIVISION_ORACLE,
    "yearly_nearest_distance": with_views(f"""
select cast(year(occurred_at) as integer) as year, {fmt3('avg(cast(d as float))')} as average_distance,
       count(incident_id) as crime_count
from nd group by 1
""", "incidents", "stations", ctes=(_ND,)),
    "nearest_division_stats": with_views(f"""
select {initcap('division')} as division,
       {fmt3("avg(coalesce(d, 'inf'::double))")} as average_distance,
       count(incident_id) as crime_count
from best group by division
""", "incidents", "stations", ctes=_nearest("i.weapon_code is not null")),
    "nearest_post": with_views(
        "select incident_id, post, cast(round(d * 1000) as bigint) as metres "
        "from incidents left join post_of using (lat, lon)", "incidents", "posts", ctes=_POST),
    "post_workload": with_views(f"""
select post, {fmt3("avg(coalesce(d, 'inf'::double))")} as average_distance, count(incident_id) as crime_count
from incidents left join post_of using (lat, lon) where weapon_code is not null group by post
""", "incidents", "posts", ctes=_POST),
    "income_at_incident": with_views(f"""
select i.incident_id, i.occurred_at, i.zip, e.since, e.income
from (select i.incident_id, i.occurred_at, try_cast({zip_head('g.zip_text')} as integer) as zip
      from incidents i left join geocodes g on i.lat = g.lat and i.lon = g.lon) i
left join estimates e on e.zip = i.zip and e.since <= i.occurred_at and not exists (
  select 1 from estimates l where l.zip = i.zip and l.since <= i.occurred_at and l.since > e.since)
""", "incidents", "geocodes", "incomes", "estimates"),
    "incidents_under_watch": with_views("""
select w.watch_id, count(*) as crime_count from watches w join incidents i on i.area_id = w.area_id
 and i.occurred_at >= w.start_at and (w.end_at is null or i.occurred_at < w.end_at)
group by w.watch_id
""", "incidents", "watches"),
    "overlapping_watches": with_views("""
select a.area_id, a.watch_id as first_id, b.watch_id as second_id,
 cast(date_diff('day', greatest(a.start_at, b.start_at), least(a.end_at, b.end_at)) as integer) as days
from watches a join watches b on a.area_id = b.area_id and a.watch_id < b.watch_id
 and a.start_at < b.end_at and b.start_at < a.end_at and a.start_at < a.end_at and b.start_at < b.end_at
""", "watches"),
    "rolling_area_counts": with_views("""
select area_id, day, crime_count, cast(sum(crime_count) over (partition by area_id order by day
  range between interval 29 days preceding and current row) as bigint) as last_30
from (select area_id, cast(occurred_at as date) as day, count(*) as crime_count
      from incidents where occurred_at is not null group by 1, 2)
""", "incidents"),
    "place_sessions": with_views("""
select lat, lon, min(occurred_at) as start_at, max(occurred_at) as end_at, count(*) as events from (
  select *, sum(far) over (partition by lat, lon order by occurred_at, incident_id) as series from (
    select lat, lon, occurred_at, incident_id, case when occurred_at - lag(occurred_at) over (
      partition by lat, lon order by occurred_at, incident_id) > interval 60 days then 1 else 0 end as far
    from incidents where lat is not null and lon is not null and occurred_at is not null))
group by lat, lon, series
""", "incidents"),
    "crowded_places": with_views(f"""
select a.lat, a.lon, a.day, a.n as crime_count, cast(sum(b.n) as bigint) as nearby
from spots a join spots b on b.day between a.day - 7 and a.day + 7 and {hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 2.5
group by a.lat, a.lon, a.day, a.n
""", "incidents", ctes=(_SPOTS,)),
    "posts_nearby": with_views(f"""
select a.lat, a.lon, a.day, a.n as watch_count, cast(coalesce(sum(b.n), 0) as bigint) as nearby
from (select p.y as lat, p.x as lon, cast(w.start_at as date) as day, count(*) as n from watches w join posts p on w.watch_id = p.fid
      where p.y is not null group by 1, 2, 3) a
left join spots b on b.day between a.day - 7 and a.day + 7 and {hav('a.lat', 'a.lon', 'b.lat', 'b.lon')} <= 2.5
group by a.lat, a.lon, a.day, a.n
""", "incidents", "posts", "watches", ctes=(_SPOTS,)),
    "incident_cube": with_views(f"""
select year, month, area_id, day_segment, grouping(year, month, area_id, day_segment) as level, count(*) as crime_count,
 min(victim_age) as youngest, max(victim_age) as oldest
from (select cast(year(occurred_at) as integer) as year, cast(month(occurred_at) as integer) as month, area_id,
        {seg('time_hhmm')} as day_segment, victim_age from incidents)
group by cube (year, month, area_id, day_segment)
""", "incidents"),
    "incident_rollup": with_views("""
select year, month, area_id, grouping(year, month, area_id) as level, count(*) as crime_count
from (select cast(year(occurred_at) as integer) as year, cast(month(occurred_at) as integer) as month, area_id from incidents)
group by rollup (year, month, area_id)
""", "incidents"),
    "yearly_from_months": with_views(f"""
select t.year, t.crime_count, t.places, q.median_m, q.ninth_decile_m
from (select year, count(*) as crime_count, count(distinct (lat, lon)) filter (where lat is not null and lon is not null) as places
      from measured group by year) t
left join (select year, min(least_m) filter (where upto >= ceil(0.5 * n)) as median_m,
                  min(least_m) filter (where upto >= ceil(0.9 * n)) as ninth_decile_m
           from (select year, least_m, sum(k) over (partition by year order by least_m) as upto,
                        sum(k) over (partition by year) as n
                 from (select year, (m >> s) << s as least_m, count(*) as k
                       from (select *, greatest(length(bin(m)) - 8, 0) as s from measured where m is not null)
                       group by 1, 2))
           group by year) q on t.year is not distinct from q.year
""", "incidents", "stations", ctes=(("measured", f"""
select cast(year(i.occurred_at) as integer) as year, i.lat, i.lon,
       cast(floor(cast({hav('i.lat', 'i.lon', 'coalesce(s.y, 0.0)', 'coalesce(s.x, 0.0)')} as double) * 1000) as bigint) as m
from incidents i left join stations s on i.area_id = s.prec"""),)),
    "release_changes": with_views("""
select coalesce(n.incident_id, o.incident_id) as incident_id,
 case when o.incident_id is null then 'added' when n.incident_id is null then 'removed' else 'altered' end as change
from incidents o full join next_release n on o.incident_id = n.incident_id
where o.incident_id is null or n.incident_id is null or o.occurred_at is distinct from n.occurred_at
 or o.victim_age is distinct from n.victim_age
""", "incidents", "next_release"),
    "release_update": with_views(f"select {CORE} from next_release", "incidents", "next_release"),
    "weekly_area_counts_stream": with_views("""
select start_at, start_at + interval 7 days as end_at, area_id, count(*) as crime_count
from (select *, time_bucket(interval 7 days, occurred_at, timestamp '1970-01-01') as start_at from incidents)
where not (year(occurred_at) < 1997 and incident_id % 97 = 1)
 and start_at + interval 7 days <= (select max(occurred_at) - interval 7 days from incidents)
group by start_at, area_id
""", "incidents"),
    "sliding_counts_stream": with_views("""
select start_at, start_at + interval 28 days as end_at, cast(sum(case when incident_id % 50 = 0 then 2 else 1 end) as bigint) as crime_count
from (select *, time_bucket(interval 7 days, occurred_at, timestamp '1970-01-01') - k * interval 7 days as start_at
      from incidents, range(4) as r(k))
where not (year(occurred_at) < 1997 and incident_id % 97 = 1)
 and start_at + interval 28 days <= (select max(occurred_at) - interval 7 days from incidents)
group by start_at
""", "incidents"),
    "late_counts_stream": with_views("""
select time_bucket(interval 7 days, occurred_at, timestamp '1970-01-01') as start_at, start_at + interval 7 days as end_at,
 count(*) as crime_count
from incidents where year(occurred_at) < 1997 and incident_id % 97 = 1 group by 1
""", "incidents"),
    "incident_profile": with_views(_profile(), "incidents"),
    "incident_row_count": with_views("select count(*) as row_count from incidents", "incidents"),
    "scan_incidents_csv": with_views(f"select {CORE} from incidents", "incidents"),
    "typed_incidents": with_views(
        "select incident_id, cast(reported_at as date) as reported_on, occurred_at, "
        "victim_age, area_id, lat, lon from incidents", "incidents"),
    "scan_stations": with_views("select x, y, fid, division, location, prec from stations", "stations"),
    "scan_incomes": with_views("select zip, community, income_text from incomes", "incomes"),
    "scan_geocodes": with_views("select lat, lon, zip_text from geocodes", "geocodes"),
    "scan_lines": with_views("select value from lines", "lines"),
    "all_incidents": with_views(f"select {CORE} from incidents", "incidents"),
    "armed_incidents": with_views(f"select {CORE} from incidents where weapon_code is not null", "incidents"),
    "incidents_in_year": with_views(
        f"select {CORE} from incidents where occurred_at >= {Y0} and occurred_at < {Y1} "
        f"and category is not null", "incidents"),
    "street_incidents": with_views(f"select {CORE} from incidents where premises like '%STREET%'",
                                   "incidents"),
    "firearm_incidents": with_views(f"select {CORE} from incidents where weapon_code between 100 and 199",
                                    "incidents"),
    "day_segments": with_views(f"select incident_id, time_hhmm, {seg('time_hhmm')} as day_segment "
                               f"from incidents", "incidents"),
    "category_labels": with_views(f"select incident_id, category, {label('category')} as label "
                                  f"from incidents", "incidents"),
    "parse_money": with_views(f"select zip, income_text, {money('income_text')} as income from incomes",
                              "incomes"),
    "geocode_incidents": with_views(f"""
select i.lat, i.lon, i.incident_id, {zip_head('g.zip_text')} as zip
from incidents i left join geocodes g on i.lat = g.lat and i.lon = g.lon
""", "incidents", "geocodes"),
    "incident_station_distance": with_views(f"""
select i.incident_id, i.area_id,
       {fmt3(hav('i.lat', 'i.lon', 'coalesce(s.y, 0.0)', 'coalesce(s.x, 0.0)'))} as distance
from incidents i left join stations s on i.area_id = s.prec
""", "incidents", "stations"),
    "nearest_station": with_views(f"""
select incident_id, division, {fmt3('d')} as distance from best
""", "incidents", "stations", ctes=_nearest("true")),
    "richest_areas": with_views(f"""
select zip, income from inc order by income desc nulls last, zip limit 3
""", "incomes", ctes=(_INC,)),
    "poorest_areas": with_views(f"""
select zip, income from inc order by income asc nulls first, zip limit 3
""", "incomes", ctes=(_INC,)),
    "extreme_areas": with_views("select zip from sel", "incomes", ctes=(_INC, _SEL)),
    "custom_row_function": with_views(
        "select incident_id, category, cast(hamming(t, reverse(t)) as bigint) as differing_digits "
        "from (select *, lpad(cast(incident_id as varchar), 12, '0') as t from incidents)", "incidents"),
}
