"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from skylattice.plans.catalog import (
    AS_OF,
    DAY,
    FIRST,
    GAP_FIRST,
    GAP_LAST,
    LAST,
    ROLLING,
    RULES,
    SPLIT,
    STATS_TABLES,
    VOLUME,
)
from skylattice.schemas import DAY_FAMILIES, HOUR_MEASURES


def _cell(x: str) -> str:
    return f"cast(round(cast(cast({x} as varchar) as decimal(38,18)), 2) * 100 as int)"


def _dec(x: str) -> str:
    return f"cast({x} as decimal(18,6))"


def _mean(x: str) -> str:
    """Twelve decimals are summed; the sum is brought to whole millionths for one exact division."""
    return f"cast(cast(round(sum(cast({x} as decimal(38,12))), 6) * 1000000 as hugeint) as double) / (count({x}) * 1e6)"


def _fine_mean(x: str) -> str:
    return f"cast(cast(sum(cast({x} as decimal(38,12))) * 1000000000000 as hugeint) as double) / (count({x}) * 1e12)"


def _avg2(x: str) -> str:
    return f"cast(round(cast({_mean(x)} as decimal(38,10)), 2) as double)"


def _spot(key: str) -> str:
    return f"cast({key} % 360 - 180 as double) as Lon, cast(({key} // 360) % 170 - 85 as double) as Lat"


_HOURS = ", ".join(f"{_avg2(m)} as {m}" for m in HOUR_MEASURES)


def _hourly(source: str, date: str = "Date", hour: str = "Hour") -> str:
    return f"""
        select IdCity, Date, Hour, {", ".join(HOUR_MEASURES)} from (
            select lon_c, lat_c, {date} as Date, {hour} as Hour, {_HOURS}
            from {source} group by 1, 2, 3, 4) join city_cell using (lon_c, lat_c)"""


def _day_columns(family: str) -> str:
    _, prefix, extra = DAY_FAMILIES[family]
    columns = [
        f"cast(round(min({family}), 2) as double) as {prefix}Min",
        f"cast(round(max({family}), 2) as double) as {prefix}Max",
        f"{_avg2(family)} as {prefix}Avg",
        *(f"{_avg2('FeelsLike')} as {name}" for name in extra),
    ]
    return ", ".join(columns)


_ALL_DAY = ", ".join(_day_columns(f) for f in DAY_FAMILIES)


def _summary(source: str, year: str, part: str, name: str) -> str:
    return f"""
        select IdCity, cast({year} as int) as Year, cast({part} as int) as {name},
            {_mean("TempAvg")} as AvgTemp, {_mean("HumidityAvg")} as AvgHumidity,
            {_mean("RainAvg")} as AvgRain, {_mean("WindAvg")} as AvgWind,
            cast({_dec("max(TempMax)")} - {_dec("min(TempMin)")} as double) as TempVariation
        from {source} group by 1, 2, 3"""


def _conditions(where: str = "true") -> str:
    return f"""
        select IdCity, Date, WeatherMain, WeatherDescription from (
            select *, row_number() over (
                partition by lon_c, lat_c, Date
                order by cnt desc, WeatherMain, WeatherDescription) as rn
            from condition where {where}) join city_cell using (lon_c, lat_c)
        where rn = 1"""


PRELUDE = f"""
with obs as (
    select *, {_cell("lon")} as lon_c, {_cell("lat")} as lat_c,
        value as Temp, value - 1.25 as FeelsLike, cast(k as double) as Clouds,
        case when event_type = 'purchase' then value / 50 else 0 end as Rain,
        cast(k as double) / 10 as Wind, cast(k + 1000 as double) as Pressure,
        cast(k as double) as Humidity
    from (
        select *, cast(json_extract(props, '$.k') as int) as k,
            cast(floor(epoch(ts)) as bigint) as dt,
            cast(ts as date) as Date, cast(hour(ts) as int) as Hour,
            cast(user_id % 360 - 180 as double) + (event_id % 9 - 4) * cast(0.001 as double) as lon,
            cast((user_id // 360) % 170 - 85 as double)
                + (event_id % 13 - 6) * cast(0.001 as double) as lat
        from events)),
city as (
    select c_custkey * 2 as IdCity, c_name as CityName, cast(c_nationkey as int) as IdCountry,
        {_spot("c_custkey")} from customer
    union all
    select s_suppkey * 2 + 1, s_name, cast(s_nationkey as int), {_spot("(s_suppkey * 7)")}
    from supplier),
city_cell as (select IdCity, {_cell("Lon")} as lon_c, {_cell("Lat")} as lat_c from city),
wh as ({_hourly("obs")}),
day as (select IdCity, Date, {_ALL_DAY} from wh group by 1, 2),
item as (
    select lon_c, lat_c, Date, event_type as WeatherMain,
        event_type || '_' || cast(k % 3 as varchar) as WeatherDescription
    from obs where k % 10 <> 0
    union all
    select lon_c, lat_c, Date, 'mist', 'mist' from obs
    where k % 10 <> 0 and event_type = 'error'),
condition as (
    select lon_c, lat_c, Date, WeatherMain, WeatherDescription, count(*) as cnt
    from item group by all),
oh as (
    select o_custkey as IdCity, cast(o_orderdate as date) as Date, o_totalprice as Temp,
        o_totalprice as FeelsLike, cast(o_orderkey % 100 as double) as Humidity,
        cast(o_orderkey % 7 as double) as Rain, cast(o_orderkey % 30 as double) as Wind,
        cast(o_orderkey % 50 + 1000 as double) as Pressure
    from orders),
oday as (select IdCity, Date, {_ALL_DAY} from oh group by 1, 2),
seed as (
    select n_name as country, c_name as city, o_orderkey as seq, o_orderstatus,
        cast((c_custkey // 360) % 170 - 85 as double)
            + (o_orderkey % 9 - 4) * cast(0.001 as double) as lat,
        cast(c_custkey % 360 - 180 as double)
            + (o_orderkey % 9 - 4) * cast(0.001 as double) as lon
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey),
country_load as (
    select cast(row_number() over (order by early, seq) as int) as IdCountry, country as CountryName
    from (
        select country, 1 as early, min(seq) as seq from seed where o_orderstatus = 'F' group by 1
        union all
        select country, 2, min(seq) from seed
        where country not in (select country from seed where o_orderstatus = 'F') group by 1)),
city_load as (
    select row_number() over (order by early, seq) as IdCity, city as CityName, IdCountry,
        lon as Lon, lat as Lat
    from (
        select *, case when o_orderstatus = 'F' then 1 else 2 end as early from seed
        qualify row_number() over (partition by country, city order by early, seq) = 1)
    join country_load on country = CountryName),
hours as (select *, datediff('day', date '1970-01-01', Date) * 24 + Hour as h from wh),
closed as (select max(dt) - 900 as mark from obs)
"""

_GAP_BEGIN, _GAP_END = (GAP_FIRST.toordinal() - 719163) * 24, (GAP_LAST.toordinal() - 719162) * 24
_GRID = f"""
    select city.IdCity, t.g as h from city, range({_GAP_BEGIN}, {_GAP_END}) t(g)
    union select IdCity, h from hours where h < {_GAP_BEGIN}"""
_SPAN = (LAST.toordinal() - FIRST.toordinal() + 1) * 24
_BEGIN = (FIRST.toordinal() - 719163) * 24
_LOCF = ", ".join(
    f"last_value({m} ignore nulls) over (partition by g.IdCity order by g.h"
    f" rows between unbounded preceding and current row) as {m}"
    for m in HOUR_MEASURES
)
_TRAILING_START = f"timestamp '{AS_OF}' - interval 1 hour"
_FIRES = [f"{r.measure} {'>' if r.above else '<'} {r.limit}" for r in RULES]
_ALERT = " ".join(f"when {f} then '{r.alert}'" for f, r in zip(_FIRES, RULES, strict=True))
_DETAIL = ", ".join(
    f"case when {f} then printf('{r.measure} %.2f {'>' if r.above else '<'} {r.limit:.2f}', {r.measure}) end"
    for f, r in zip(_FIRES, RULES, strict=True)
)
_DAY_COLUMNS = {
    f: ", ".join([f"{prefix}Min", f"{prefix}Max", f"{prefix}Avg", *extra])
    for f, (_, prefix, extra) in DAY_FAMILIES.items()
}
_ROLL = ", ".join(
    f"cast(cast(sum({_dec(c)}) over w * 1000000 as hugeint) as double)"
    f" / (count({c}) over w * 1e6) as {c}Roll"
    for c in ROLLING
)

_MOMENTS = """
    select IdCity, Date, Hour, Temp as Value, x, count(x) over w as n, sum(x) over w as s,
        sum(x * x) over w as q
    from (select *, cast(round(Temp * 100) as hugeint) as x from hours)
    window w as (partition by IdCity order by h range between 168 preceding and 1 preceding)"""

_VOLUMES = " union all ".join(
    f"select '{n}' as table_name, count(*) as n, sum("
    + " + ".join(f"coalesce(strlen(cast({c} as varchar)), 0)" for c in VOLUME[n])
    + f") as b from {n}"
    for n in STATS_TABLES
)
_SELECT = {
    "hourly_calendar": "select * from wh",
    "hourly_landed": "select * from wh",
    "hourly_schedule": _hourly(
        "obs", "cast(ts - interval 5 minute as date)", "cast(hour(ts - interval 5 minute) as int)"
    ),
    "hourly_trailing": _hourly(
        f"(select * from obs where ts >= {_TRAILING_START} and ts < timestamp '{AS_OF}')",
        f"cast({_TRAILING_START} as date)",
        f"cast(hour({_TRAILING_START}) as int)",
    ),
    "raw_stream": """select Date, count(*) as documents,
        count(*) filter (event_type = 'purchase') as with_rain from obs group by 1""",
    **{
        DAY_FAMILIES[f][0]: f"select IdCity, Date, {_DAY_COLUMNS[f]} from day" for f in DAY_FAMILIES
    },
    "daily_one_day": f"select * from day where Date = date '{DAY}'",
    "daily_backfill": f"select * from day where Date between date '{FIRST}' and date '{LAST}'",
    "condition_counts": "select * from condition",
    "condition_day": _conditions(f"Date = date '{DAY}'"),
    "condition_backfill": _conditions(),
    "condition_aggregate": _conditions(),
    "condition_period": """
        select IdCity, WeatherMain, WeatherDescription from (
            select lon_c, lat_c, WeatherMain, WeatherDescription, row_number() over (
                partition by lon_c, lat_c
                order by sum(cnt) desc, WeatherMain, WeatherDescription) as rn
            from condition group by 1, 2, 3, 4) join city_cell using (lon_c, lat_c)
        where rn = 1""",
    "month_measures": f"""select IdCity, cast(year(Date) as int) as Year,
            cast(month(Date) as int) as Month, {_mean("TempAvg")} as AvgTemp,
            min(TempMin) as MinTemp, max(TempMax) as MaxTemp
        from oday group by 1, 2, 3""",
    "city_country": """select seq, city, cast(n_nationkey as int) as IdCountry
        from seed join nation on country = n_name""",
    "month_summary": _summary("day", "year(Date)", "month(Date)", "Month"),
    "month_summary_join": _summary("day", "year(Date)", "month(Date)", "Month"),
    "month_catalog": _summary("day", "year(Date)", "month(Date)", "Month"),
    "month_summary_years": _summary("oday", "year(Date)", "month(Date)", "Month"),
    "month_one": f"""select * from ({_summary("oday", "year(Date)", "month(Date)", "Month")})
        where Year = 1999 and Month = 12""",
    "weekly": _summary("day", "isoyear(Date)", "week(Date)", "NumWeek"),
    "weekly_years": _summary("oday", "isoyear(Date)", "week(Date)", "NumWeek"),
    "week_dim": """select cast(isoyear(d) * 100 + week(d) as int) as IdWeek,
            cast(week(d) as int) as NumWeek, cast(d as date) as DateIni, cast(d + 6 as date) as DateEnd
        from (select cast(unnest(generate_series(
            date_trunc('week', min(Date)), date_trunc('week', max(Date)), interval 7 day)) as date) as d
        from oh)""",
    "load_country": "select * from country_load",
    "load_city": "select * from city_load",
    "seeded_city": """
        select row_number() over (order by country, city) as IdCity, city as CityName, IdCountry, lon as Lon, lat as Lat
        from (select * from seed qualify row_number() over (partition by country, city order by lat, lon) = 1)
        join (select country as name, cast(row_number() over (order by country) as int) as IdCountry
            from (select distinct country from seed)) on country = name""",
    "append_rows": f"""select IdCity, Date, TempMin, TempMax,
        case when Date < date '{SPLIT}' then -1.0 else TempAvg end as TempAvg, AvgFeelsLike from day""",
    "refused_write": f"""select IdCity, Date, TempMin, TempMax, cast(-1.0 as double) as TempAvg, AvgFeelsLike
        from day where Date < date '{SPLIT}'""",
    "undeclared_fields": """select Date, count(*) filter (k > 50) as with_snow,
        cast(sum(k) filter (k > 50) as bigint) as snow from obs group by 1""",
    "unusable": """select measure, count(*) as documents, count(*) filter (x is null) as missing,
            count(*) filter (abs(x) >= 9e12) as unusable
        from (select unnest(['dt', 'Temp', 'FeelsLike', 'Clouds', 'Rain', 'Wind', 'Pressure', 'Humidity']) as measure,
            unnest([0, case when dt % 9 = 0 then 9.9e13 else Temp end, FeelsLike, Clouds, Rain, Wind, Pressure, Humidity]) as x
            from obs) group by 1""",
    "wide_range": f"""select key, {_mean("large")} as large, {_fine_mean("tiny")} as tiny, {_mean("plain")} as plain
        from (select o_custkey as key, floor(o_totalprice) * 1e6 as large,
            (o_orderkey % 1000) * cast(1e-9 as double) as tiny, o_totalprice as plain from orders)
        group by 1""",
    "table_sizes": f"""select *, round(size_bytes / 1048576, 2) as size_mb,
            case when size_bytes >= 10 * 1024 ** 3 then cast(cast(round(size_bytes / 1024 ** 3) as bigint) as varchar) || ' GB'
                when size_bytes >= 10 * 1024 ** 2 then cast(cast(round(size_bytes / 1024 ** 2) as bigint) as varchar) || ' MB'
                when size_bytes >= 10240 then cast(cast(round(size_bytes / 1024) as bigint) as varchar) || ' kB'
                else cast(size_bytes as varchar) || ' bytes' end as size,
            timestamp '{AS_OF}' as as_of
        from (select coalesce(table_name, 'all') as table_name, cast(sum(n) as bigint) as row_count,
                cast(sum(b) as bigint) as size_bytes
            from ({_VOLUMES}) group by rollup (table_name))""",
    "insert_if_absent": f"""select IdCity, Date, TempMin, TempMax,
        case when Date < date '{SPLIT}' then -1.0 else TempAvg end as TempAvg, AvgFeelsLike from day""",
    "replace_period": f"""select IdCity, Date, TempMin, TempMax,
        case when Date < date '{SPLIT}' then -1.0 else TempAvg end as TempAvg, AvgFeelsLike from day""",
    "unmatched_cells": """select lon_c / 100.0::double as lon, lat_c / 100.0::double as lat,
            count(*) as observations from obs
        where not exists (select 1 from city_cell c where c.lon_c = obs.lon_c and c.lat_c = obs.lat_c)
        group by 1, 2""",
    "ambiguous_cells": """select lon_c / 100.0::double as lon, lat_c / 100.0::double as lat,
            count(*) as cities from city_cell group by 1, 2 having count(*) > 1""",
    "orphans": "select * from city where IdCity not in (select IdCity from wh)",
    "duplicate_keys": "select country, city, count(*) as n from seed group by 1, 2 having count(*) > 1",
    "not_null_report": """select 'dt' as column_name, count(*) - count(dt) as nulls from obs
        union all select 'rain', count(*) filter (event_type <> 'purchase') from obs
        union all select 'temp', count(*) - count(value) from obs
        union all select 'lon', count(*) - count(lon) from obs""",
    "table_rows": " union all ".join(
        f"select '{n}' as table_name, count(*) as row_count from {n}" for n in STATS_TABLES
    ),
    "stats_trend": """select *, row_count - lag(row_count) over w as row_count_change,
            size_bytes - lag(size_bytes) over w as size_bytes_change
        from (select event_type as table_name, cast(ts as date) as as_of, count(*) as row_count,
            cast(sum(length(props)) as bigint) as size_bytes from events group by 1, 2)
        window w as (partition by table_name order by as_of)""",
    "rolling_7d": f"""select IdCity, Date, {_ROLL} from day
        window w as (partition by IdCity order by Date
            range between interval 6 day preceding and current row)""",
    "units": f"""select IdCity, Date, Hour,
        cast({_dec("Temp")} - 273.15 as double) as TempC,
        cast(({_dec("Temp")} - 273.15) * 1.8 + 32 as double) as TempF,
        cast({_dec("Wind")} * 3.6 as double) as WindKmh from wh""",
    "gap_fill": f"""select * exclude (h) from (select g.h, g.IdCity, cast(date '1970-01-01' + cast(g.h // 24 as int) as date) as Date,
            cast(g.h % 24 as int) as Hour, {_LOCF}, hours.h is null as Filled
        from ({_GRID}) g left join hours on g.IdCity = hours.IdCity and g.h = hours.h)
        where h >= {_GAP_BEGIN}""",
    "gap_report": f"""select IdCity, count(*) filter (h >= {_BEGIN}) as HoursPresent,
            {_SPAN} - count(*) filter (h >= {_BEGIN}) as HoursMissing, max(after - h - 1) as LongestGap
        from (select IdCity, h, lead(h, 1, {_BEGIN + _SPAN}) over (partition by IdCity order by h) as after
            from (select IdCity, h from hours where h >= {_BEGIN} and h < {_BEGIN + _SPAN}
                union all select IdCity, {_BEGIN - 1} from city)) group by 1""",
    "alerts": f"""select IdCity, cast(Date as timestamp) + to_hours(Hour) as Timestamp,
            case {_ALERT} end as AlertType, concat_ws('; ', {_DETAIL}) as Details
        from wh where {" or ".join(_FIRES)}""",
    "anomalies": f"""select IdCity, Date, Hour, Value, Z from (
            select *, (x - cast(s as double) / n)
                / sqrt(cast(n * q - s * s as double) / (n * (n - 1))) as Z
            from ({_MOMENTS}) where n >= 3 and n * q - s * s > 0)
        where abs(Z) > 2.0""",
    "sql_surface": """select WeatherMain, count(*) as cnt, min(Temp) as TempMin, max(Rain) as RainMax
        from (select event_type as WeatherMain, Temp, Rain from obs where k % 10 <> 0
            union all select 'mist', Temp, Rain from obs where k % 10 <> 0 and event_type = 'error')
        group by 1""",
    "table_stream": """select * exclude (mark) from wh, closed
        where epoch(cast(Date as timestamp)) + (Hour + 1) * 3600 <= mark""",
    "hourly_stream": """select * exclude (mark) from wh, closed
        where epoch(cast(Date as timestamp)) + (Hour + 1) * 3600 <= mark""",
    "condition_stream": f"""select * exclude (mark) from ({_conditions()}), closed
        where epoch(cast(Date as timestamp)) + 86400 <= mark""",
}

_SELECT |= {
    "hourly_increments": _SELECT["hourly_calendar"],
    "condition_increments": _SELECT["condition_backfill"],
    "gap_fill_kept": _SELECT["gap_fill"],
    "landed_once": _SELECT["raw_stream"],
    "hourly_open": _SELECT["hourly_calendar"],
    "hourly_sql": _SELECT["hourly_calendar"],
    "refused_ids": "select cast(n_nationkey as int) as IdCountry, n_name as CountryName from nation",
    "alert_rules": f"""
        select IdCity, cast(Date as timestamp) + to_hours(Hour) as Timestamp, arg_min(alert, seq) as AlertType,
            string_agg(printf('%s %.2f %s %.2f', measure, x, case when above then '>' else '<' end, lim), '; ' order by seq) as Details
        from (unpivot (select IdCity, Date, Hour, Temp, Wind, Rain, Pressure from wh)
            on Temp, Wind, Rain, Pressure into name measure value x) h
        join (
            select k as seq, 'rule ' || k as alert, ['Temp', 'Wind', 'Rain', 'Pressure'][k % 4 + 1] as measure,
                k % 3 > 0 as above, [120.0, 8.0, 1.5, 1060.0][k % 4 + 1] + k % 7 as lim, city,
                case when k % 2 = 0 then date '{FIRST}' + cast(k % 20 as int) end as a,
                case when k % 5 = 0 then date '{FIRST}' + cast(k % 25 as int) end as b
            from (select c_custkey as k, c_custkey * 2 as city from customer
                union all select n_nationkey + 1000000000, null from nation)) r
        using (measure)
        where (city is null or city = IdCity) and (a is null or Date >= a) and (b is null or Date <= b)
            and case when above then x > lim else x < lim end
        group by IdCity, Date, Hour""",
    "stream_and_batch": f"""select * replace (case when Date >= date '{SPLIT}' then Wind / 4 else Wind end as Wind) from wh""",
}

ORACLES: dict[str, str] = {name: f"{PRELUDE}\n{select}" for name, select in _SELECT.items()}
