"""Queries of the data-processing operators, with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayledger.contracts import SOURCE_COLUMNS
from wayledger.operators import asof, bad_rows, history, late_events, profile, trips
from wayledger.operators.track import as_text
from wayledger.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return late_events.corrected_hours(table(spark, d, "telemetry_events"))


def p1_hours(spark: SparkSession, d: str) -> DataFrame:
    now = late_events.replay(table(spark, d, "telemetry_events")).current()
    return now.select("device_serial", as_text("hour_start").alias("hour_start"), "published_count", "corrected_count", "excluded_count")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return history.identity_changes(table(spark, d, "device_identity_events"))


def p2_history(spark: SparkSession, d: str) -> DataFrame:
    reports = history.identity_reports(table(spark, d, "device_identity_events"))
    h = history.attribute_history(reports, ["imei", "iccid", "imsi"])
    return h.select(h.entity.alias("device_serial"), as_text("valid_from").alias("valid_from"), as_text("valid_to").alias("valid_to"), "imei", "iccid", "imsi")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    s = trips.stops(table(spark, d, "telemetry_events"))
    return s.select("device_serial", as_text("start_at").alias("stop_start"), as_text("end_at").alias("stop_end"))


def p4_trips(spark: SparkSession, d: str) -> DataFrame:
    return trips.stops_and_trips(table(spark, d, "telemetry_events"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return bad_rows.failed_rows(table(spark, d, "tracker_raw_lines"), table(spark, d, "tracker_logs"), table(spark, d, "rejected_logs"), SOURCE_COLUMNS)


def p5_valid(spark: SparkSession, d: str) -> DataFrame:
    return bad_rows.valid_rows(bad_rows.read_lines(table(spark, d, "tracker_raw_lines"), SOURCE_COLUMNS), SOURCE_COLUMNS)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return profile.load_findings(table(spark, d, "telemetry_events"))


def p6_profile(spark: SparkSession, d: str) -> DataFrame:
    return profile.column_profile(table(spark, d, "telemetry_events"))


def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    return profile.column_profile(table(spark, d, "telemetry_events"), drift=False).select("batch_id", "column_name", "n_rows", "n_null", "n_distinct")


# Columns whose drift has SQL of its own: numbers with and without a range, and texts.
_DRIFT = {"latitude": "num not between -90 and 90", "rx_level": "num not between -120 and -30", "speed": "false", "hdop": "false", "battery_voltage": "false", "protocol_version": None, "message_type": None, "location_status": None}


def p6_drift(spark: SparkSession, d: str) -> DataFrame:
    p = profile.column_profile(table(spark, d, "telemetry_events"), list(_DRIFT))
    return p.select("batch_id", "column_name", "n_bad", F.round("psi", 6).alias("psi"), F.round("chi_square", 4).alias("chi_square"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return asof.imei_at_event(table(spark, d, "telemetry_events"), table(spark, d, "device_identity_events"))


def p7_known(spark: SparkSession, d: str) -> DataFrame:
    return asof.imei_at_event(table(spark, d, "telemetry_events"), table(spark, d, "device_identity_events"), only_changed=False)


QUERIES = {f.__name__: f for f in (p1_found, p1_hours, p2_found, p2_history, p4_found, p4_trips, p5_found, p5_valid, p6_found, p6_profile, p6_counts, p6_drift, p7_found, p7_known)}

_HOURS = """with k as (select *, row_number() over (partition by device_serial, device_timestamp, message_type, serial_count, case when device_timestamp is null then row_id end order by ingested_at, row_id) rn from telemetry_events),
e as (select device_serial, date_trunc('hour', case when device_timestamp is null or device_timestamp > server_timestamp + interval 10 minute or device_timestamp < timestamp '2010-01-01' then server_timestamp else device_timestamp end) h, (ingested_at at time zone 'UTC') i from k where rn = 1)
"""


def _says(c: str) -> str:
    return f"case when has_valid_{c}_format and not regexp_full_match({c}, '0*|1*|2*|3*|4*|5*|6*|7*|8*|9*') then {c} end"


_REPORTS = f"""with r as (select device_serial, event_timestamp t, ingested_at i, row_id, {_says("imei")} a, {_says("iccid")} b, {_says("imsi")} c from device_identity_events where device_serial is not null and event_timestamp is not null),
p as (select *, last_value(a ignore nulls) over w pa, last_value(b ignore nulls) over w pb, last_value(c ignore nulls) over w pc from r window w as (partition by device_serial order by t, i, row_id rows between unbounded preceding and 1 preceding))
"""

_CELLS = """with c as (select batch_id, 'latitude' column_name, cast(latitude as varchar) v, latitude num from telemetry_events union all select batch_id, 'rx_level', cast(rx_level as varchar), rx_level from telemetry_events union all select batch_id, 'protocol_version', protocol_version, null from telemetry_events),
k as (select batch_id, column_name, count(*) n, count(v) m, count(*) filter (where v is not null and ((column_name = 'latitude' and num not between -90 and 90) or (column_name = 'rx_level' and num not between -120 and -30))) oor, count(*) filter (where column_name = 'protocol_version' and v is not null and not regexp_full_match(v, 'V[0-9]{2}\\.[0-9]{2}\\.[0-9]{3}')) pat, median(num) filter (where column_name = 'rx_level' and num between -120 and -30) med from c group by 1, 2),
w as (select column_name, 1 - count(v) * 1.0 / count(*) nr, median(num) filter (where column_name = 'rx_level' and num between -120 and -30) med, count(v) m from c group by 1),
vc as (select batch_id, column_name, v, count(*) n from c where v is not null and column_name <> 'latitude' group by 1, 2, 3),
va as (select column_name, v, count(*) n from c where v is not null and column_name = 'protocol_version' group by 1, 2)
"""

_DRIFT_SQL = (
    "with c as ("
    + " union all ".join(f"select batch_id, '{c}' column_name, cast({c} as varchar) v, {c if bad else 'cast(null as double)'} num from telemetry_events" for c, bad in _DRIFT.items())
    + "), b as (select *, v is not null and coalesce(case "
    + " ".join(f"when column_name = '{c}' then {bad}" for c, bad in _DRIFT.items() if bad)
    + """ when column_name = 'protocol_version' then not regexp_full_match(v, 'V[0-9]{2}\\.[0-9]{2}\\.[0-9]{3}') end, false) bad from c),
ranked as (select column_name, num, row_number() over (partition by column_name order by num) r, count(*) over (partition by column_name) n from b where num is not null and not isnan(num) and not bad),
edges as (select column_name, i, min(num) edge from ranked, (select unnest(range(1, 10)) i) where r = greatest(1, ceil(i / 10.0 * n - 1e-9)) group by column_name, i),
binned as (select batch_id, column_name, case when num is null then v when isnan(num) then 'NaN' else cast((select count(*) from edges e where e.column_name = b.column_name and e.edge < b.num) as varchar) end bin from b where v is not null),
seen as (select batch_id, column_name, bin, count(*) n from binned group by 1, 2, 3),
loads as (select batch_id, column_name, sum(n) load_n from seen group by 1, 2),
alls as (select column_name, bin, sum(n) n_all, sum(sum(n)) over (partition by column_name) col_n from seen group by 1, 2),
grid as (select l.batch_id, l.column_name, load_n, coalesce(s.n, 0) n, n_all * 1.0 / col_n q from loads l join alls a using (column_name) left join seen s on s.batch_id is not distinct from l.batch_id and s.column_name = l.column_name and s.bin = a.bin),
found as (select batch_id, column_name, sum((n - q * load_n) * (n - q * load_n) / (q * load_n)) chi, sum(case when n > 0 then (n * 1.0 / load_n - q) * ln(n * 1.0 / load_n / q) else 0 end) psi, sum(case when n > 0 then 0 else q end) rest from grid group by 1, 2),
every as (select batch_id, column_name, count(*) filter (where bad) n_bad from b group by 1, 2)
select e.batch_id, e.column_name, n_bad, coalesce(round(psi + case when rest > 1e-6 then (1e-6 - rest) * ln(1e-6 / rest) else 0 end, 6), 0) psi, coalesce(round(chi, 4), 0) chi_square from every e left join found f on f.batch_id is not distinct from e.batch_id and f.column_name = e.column_name"""
)

_TELEMETRY_COLUMNS = (
    "event_date server_timestamp device_timestamp event_timestamp log_type message_type report_type protocol_version device_serial device_resolution_method terminal_status battery_voltage location_status "
    "latitude longitude speed direction_degrees internal_battery odometer_trip odometer_total horimeter hdop mcc mnc lac cell_id rx_level serial_count transmission_technology message_group io_status "
    "driver_id passenger_id rpm tachograph_speed tachograph_odometer temperature_1 temperature_2 temperature_3 temperature_4 source_file source_file_hash source_row_number row_id ingested_at "
    "ingestion_date has_valid_coordinates position_quality"
).split()

_IMEI = f"""with v as (select device_serial, event_timestamp t, (ingested_at at time zone 'UTC') i, row_id r, {_says("imei")} a from device_identity_events where {_says("imei")} is not null)
"""


def _known(where: str) -> str:
    return f"""{_IMEI}select e.row_id, arg_max(v.a, (v.t, v.i, v.r)) as imei from telemetry_events e join v on v.device_serial = e.device_serial and v.t <= e.event_timestamp and v.i <= e.event_timestamp{where} group by e.row_id"""


BLANK = "'^[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]+|[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]+$', '', 'g'"


def _bare(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), {BLANK})"


def _bad_time(c: str) -> str:
    v = _bare(c)
    return f"({v} <> '' and not (regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[ T][0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}([.][0-9]{{1,6}})?') and {v} not like '0000%' and try_cast(replace({v}, 'T', ' ') as timestamp) is not null and substr({v}, 12, 2) < '24'))"


def _bad_latitude(c: str, kind: str) -> str:
    v = _bare(c)
    return f"({v} <> '' and {_bare(kind)} <> 'T1' and not (regexp_full_match({v}, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)') and coalesce(abs(try_cast({v} as double)) <= 90, false)))"


# A line is split by taking fields, each with the comma before it; what is left over is broken quoting.
_ONE = ',(?:"(?:[^"]|"")*"|[^",][^,]*|)'
LINES = (
    "with t as (select raw_id, source_file, line_number, ',' || regexp_replace(case when line_number = 1 then regexp_replace(raw_line, '^﻿', '') else raw_line end, '\\r$', '') x from tracker_raw_lines where raw_line is not null), "
    f"s as (select *, not regexp_full_match(x, '({_ONE})+') broken, list_transform(regexp_extract_all(x, '{_ONE}'), lambda y: case when y[2] = '\"' then replace(y[3:-2], '\"\"', '\"') else y[2:] end) f from t), "
    f"h as (select source_file, list_transform(f, lambda y: upper({_bare('y')})) h from s where line_number = 1), "
    f"rec as (select s.*, h, {', '.join(f'f[list_position(h, {chr(39)}{c.upper()}{chr(39)})] c{k}' for k, c in enumerate(SOURCE_COLUMNS))} from s join h using (source_file) where line_number <> 1 and {_bare('x[2:]')} <> ''), "
)
_AT = {c: f"c{k}" for k, c in enumerate(SOURCE_COLUMNS)}
_READ = LINES + f"j as (select *, case when broken then 'quoting' when len(f) <> len(h) then 'column_count' when {_bad_time(_AT['TM_STAMP'])} or {_bad_time(_AT['DATA_SERVIDOR'])} or {_bad_latitude(_AT['LAT'], _AT['MESS_TYPE'])} then 'invalid_value' end reason from rec) "

SQL = {
    "p5_found": _READ
    + f"""select 'tracker_raw_lines' origin, cast(raw_id as varchar) record_key, reason from j where reason is not null
union all select 'tracker_logs', row_id, 'invalid_value' from tracker_logs where {_bad_time("tm_stamp")} or {_bad_time("data_servidor")}
union all select 'rejected_logs', row_id, 'invalid_value' from rejected_logs where {_bad_latitude("latitude_raw", "message_type")}""",
    "p5_valid": _READ + f"select raw_id, source_file, line_number, {', '.join(f'{at} as {chr(34)}{c.lower()}{chr(34)}' for c, at in _AT.items())} from j where reason is null",
    "p1_found": _HOURS + "select device_serial, strftime(h, '%Y-%m-%d %H:%M:%S') as hour_start from e where h is not null group by device_serial, h having count(*) filter (where i > h + interval 2 hour and i <= h + interval 73 hour) > 0",
    "p1_hours": _HOURS
    + "select device_serial, strftime(h, '%Y-%m-%d %H:%M:%S') as hour_start, count(*) filter (where i <= h + interval 2 hour) as published_count, count(*) filter (where i <= h + interval 73 hour) as corrected_count, count(*) filter (where i > h + interval 73 hour or i is null) as excluded_count from e where h is not null group by device_serial, h",
    "p2_found": _REPORTS + "select distinct device_serial, strftime(t, '%Y-%m-%d %H:%M:%S') as valid_from from p where a <> pa or b <> pb or c <> pc",
    "p2_history": _REPORTS
    + """, f as (select device_serial, t, max(coalesce(a is not null and a is distinct from pa, false) or coalesce(b is not null and b is distinct from pb, false) or coalesce(c is not null and c is distinct from pc, false)) ch, arg_max(coalesce(a, pa), (i, row_id)) filter (where coalesce(a, pa) is not null) a, arg_max(coalesce(b, pb), (i, row_id)) filter (where coalesce(b, pb) is not null) b, arg_max(coalesce(c, pc), (i, row_id)) filter (where coalesce(c, pc) is not null) c from p group by 1, 2)
select device_serial, strftime(t, '%Y-%m-%d %H:%M:%S') as valid_from, strftime(lead(t) over (partition by device_serial order by t), '%Y-%m-%d %H:%M:%S') as valid_to, a as imei, b as iccid, c as imsi from f where ch""",
    "p6_found": _CELLS
    + """select batch_id, column_name, 'null_rate' as finding from k join w using (column_name) where 1 - k.m * 1.0 / k.n - w.nr > 0.15
union all select batch_id, column_name, 'out_of_range' from k where oor > 0.06 * m
union all select batch_id, column_name, 'pattern' from k where pat > 0.06 * m
union all select batch_id, column_name, 'constant' from k where column_name = 'rx_level' and (select max(n) from vc where vc.batch_id = k.batch_id and vc.column_name = 'rx_level') > 0.5 * m
union all select batch_id, column_name, 'distribution' from k join w using (column_name) where column_name = 'rx_level' and abs(k.med - w.med) > 10
union all select distinct k.batch_id, k.column_name, 'distribution' from k join w using (column_name) join va using (column_name) left join vc on vc.batch_id = k.batch_id and vc.column_name = k.column_name and vc.v = va.v where k.column_name = 'protocol_version' and k.m > 0 and abs(coalesce(vc.n, 0) * 1.0 / k.m - va.n * 1.0 / w.m) > 0.5""",
    "p6_drift": _DRIFT_SQL,
    "p6_counts": " union all ".join(f"select batch_id, '{c}' as column_name, count(*) as n_rows, count(*) - count({c}) as n_null, count(distinct {c}) as n_distinct from telemetry_events group by batch_id" for c in _TELEMETRY_COLUMNS),
    "p7_found": _known(" where e.device_serial in (select device_serial from v group by 1 having count(distinct a) > 1)"),
    "p7_known": _known(""),
}
