"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayledger.llm import bpe, leak, quality, runs
from wayledger.operators.track import as_text
from wayledger.session import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    r = runs.collapse_runs(table(spark, d, "telemetry_events"), min_count=3)
    return r.select("device_serial", as_text("run_start").alias("run_start"), as_text("run_end").alias("run_end"))


def p3_collapsed(spark: SparkSession, d: str) -> DataFrame:
    r = runs.collapse_runs(table(spark, d, "telemetry_events"))
    return r.select("device_serial", as_text("run_start").alias("run_start"), "n_events", "duration_s")


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_documents(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_prose(quality.document_quality(table(spark, d, "documents")))


def p10_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.document_quality(table(spark, d, "documents"))


def p10_stats(spark: SparkSession, d: str) -> DataFrame:
    q = quality.document_quality(table(spark, d, "documents"))
    return q.select("doc_id", "n_lines", "n_words", *[F.round(c, 6).alias(c) for c in ("mean_word_length", "symbol_ratio", "end_punctuation_share", "common_word_share")])


QUERIES = {f.__name__: f for f in (p3_found, p3_collapsed, p8_ids, p9_found, p10_found, p10_quality, p10_stats)}

_RUNS = """with k as (select device_serial, event_timestamp t, latitude y, longitude x, serial_count sc, message_type mt, row_number() over (partition by device_serial, device_timestamp, message_type, serial_count, case when device_timestamp is null then row_id end order by ingested_at, row_id) rn, row_id from telemetry_events),
u as (select *, radians(lag(y) over w) y0, radians(lag(x) over w) x0, radians(y) y1, radians(x) x1 from k where rn = 1 and device_serial is not null and t is not null and y between -90 and 90 and x is not null and not isnan(x) and not (x = 0 and y = 0) window w as (partition by device_serial order by t, sc nulls first, mt nulls first, row_id)),
g as (select *, sum(case when 2 * 6371000 * asin(sqrt(least(1, pow(sin((y1 - y0) / 2), 2) + cos(y0) * cos(y1) * pow(sin((x1 - x0) / 2), 2)))) <= 5 then 0 else 1 end) over (partition by device_serial order by t, sc nulls first, mt nulls first, row_id) run from u)
"""

SQL = {
    "p3_found": _RUNS + "select device_serial, strftime(min(t), '%Y-%m-%d %H:%M:%S') as run_start, strftime(max(t), '%Y-%m-%d %H:%M:%S') as run_end from g group by device_serial, run having count(*) >= 3",
    "p3_collapsed": _RUNS + "select device_serial, strftime(min(t), '%Y-%m-%d %H:%M:%S') as run_start, count(*) as n_events, (epoch_us(max(t)) - epoch_us(min(t))) / 1e6 as duration_s from g group by device_serial, run",
    "p10_stats": """with t as (select row_number() over () r, doc_id, coalesce(text, '') x from documents),
w as (select r, unnest(regexp_extract_all(lower(x), '[\\p{L}\\p{M}]+')) w from t),
n as (select count(*) n from documents where text is not null and regexp_replace(text, '^ +| +$', '', 'g') <> ''),
c as (select w from w where length(w) > 1 group by w having count(distinct r) >= greatest(2, ceil(0.004 * (select n from n)))),
y as (select r, regexp_replace(x, '[\\s\\p{Z}\\x0b\\x1c-\\x1f\\x85]', '', 'g') z from t),
m as (select r, length(regexp_replace(z, '[\\p{L}\\p{M}\\p{Nd}.,;:!?''"()“”«»’‘|]', '', 'g')) * 1.0 / nullif(length(z), 0) symbol_ratio from y),
a as (select r, count(*) n_words, avg(length(w)) mean_word_length, count(*) filter (where w in (select w from c)) * 1.0 / count(*) common_word_share from w group by r),
l as (select r, unnest(string_split(x, chr(10))) y from t),
b as (select r, count(*) n_lines, count(*) filter (where regexp_matches(y, '[.,;:!?''"()“”«»’‘][\\s\\p{Z}]*$')) * 1.0 / count(*) end_punctuation_share from l where regexp_matches(y, '[^\\s\\p{Z}\\x0b\\x1c-\\x1f]') group by r)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_words, 0) as n_words, round(mean_word_length, 6) as mean_word_length, round(symbol_ratio, 6) as symbol_ratio, round(end_punctuation_share, 6) as end_punctuation_share, round(common_word_share, 6) as common_word_share from t left join a using (r) left join b using (r) left join m using (r)""",
}
