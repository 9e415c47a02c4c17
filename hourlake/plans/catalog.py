"""The registered queries and their DuckDB SQL.

The tables have no dump files, so raw lines are made from `events` by one expression that both dialects
read alike, and manifest-like and listing-like frames from its hours.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourlake.functions import projects
from hourlake.functions.lines import classified, metric, normalized_title, parsed
from hourlake.operators import profile, silver
from hourlake.sources.names import dump_date, dump_hour, dump_stamp, hour_spine, partition_columns
from hourlake.sources.schemas import LINEAGE

CODE = "case event_id % 9 when 0 then 'en' when 1 then 'en.m' when 2 then 'vi' when 3 then 'vi.m' when 4 then 'commons.m' when 5 then 'commons.m.m' when 6 then 'www.wd' when 7 then 'www.wd.m' else 'fr' end"
TITLE = "case event_id % 4 when 0 then concat(event_type, '_', cast(user_id as {string}), '%C3%A9') when 1 then concat(event_type, '_', cast(user_id as {string}), '+x') when 2 then concat(event_type, '_', cast(user_id as {string}), '100%') else event_type end"
LINE = """case event_id % 50
  when 0 then concat(code, ' ', title, ' 7') when 1 then concat(code, ' ', title, ' 7 9 x')
  when 2 then concat(code, ' ', title, ' x 9') when 3 then concat(code, ' ', title, ' -5 9')
  when 4 then concat(code, '  7 9')
  else concat(code, ' ', title, ' ', cast(cast(floor(value) as bigint) as {string}), ' ', cast(user_id * 100 as {string})) end"""
FILE = "concat('pageviews-', {stamp}, case when event_id % 97 = 5 then '3000.gz' else '0000.gz' end)"
CODES = projects.DEFAULT_CODES
PIVOT = ("en", "vi", "commons", "wikidata")
SPINE_DAYS = ("2024-01-01", "2024-01-07")
EXPECTED_PAIRS = 7


# -- frames


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, value, source_file, source_filename) made from events."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", "value")
    made = events.withColumn("code", F.expr(CODE)).withColumn("title", F.expr(TITLE.format(string="string")))
    name = F.expr(FILE.format(stamp="date_format(ts, 'yyyyMMdd-HH')"))
    return made.select("event_id", F.expr(LINE.format(string="string")).alias("value"), F.concat(F.lit("file:/dumps/"), name).alias("source_file"), name.alias("source_filename"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(raw_lines(spark, sf_dir), projects.dimension(spark))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_rows(_lines(spark, sf_dir))


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.quarantine_rows(_lines(spark, sf_dir))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest-like frame: a file for each hour of events."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("ts")
    name = F.concat(F.lit("pageviews-"), F.date_format("timestamp_hour", "yyyyMMdd-HH"), F.lit("0000.gz"))
    out = events.groupBy(hour.alias("timestamp_hour")).agg((F.count("*") * 1000).alias("size_bytes"))
    return out.select(name.alias("filename"), F.col("timestamp_hour").cast("timestamp_ntz").alias("timestamp_hour"), "size_bytes")


def _actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing-like frame: some hours lack, some have other sizes, three are in no manifest."""
    known = _manifest(spark, sf_dir).withColumn("h", F.hour("timestamp_hour")).withColumn("d", F.dayofmonth("timestamp_hour"))
    known = known.where(~((F.col("h") == 3) & (F.col("d") % 5 == 0)))
    size = F.col("size_bytes") + (F.col("h") % 6 == 0).cast("int")
    more = spark.range(3).select(F.concat(F.lit("pageviews-20991231-0"), F.col("id").cast("string"), F.lit("0000.gz")).alias("filename"), (F.col("id") * 10).alias("size_bytes"))
    return known.select("filename", size.alias("size_bytes")).unionByName(more)


def _expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = _manifest(spark, sf_dir).select(F.to_date("timestamp_hour").alias("date"), F.hour("timestamp_hour").alias("hour"))
    return profile.expected_partitions(hours, projects.dimension(spark))


def _spine(spark: SparkSession) -> DataFrame:
    return hour_spine(spark, *map(date.fromisoformat, SPINE_DAYS))


PARTITION = ("date", "hour", "project", "access_mode")

# -- the same frames in SQL

_DIM = ", ".join(f"('{c}', '{p.project}', {repr(p.language) if p.language else 'null'}, '{p.project_family}', '{p.access_mode}')" for c, p in projects.PROJECTS.items() if c in CODES)
BASE = rf"""with made as (
  select *, {CODE} as code, {TITLE.format(string="varchar")} as title from events
), raw as (
  select event_id, {LINE.format(string="varchar")} as value, {FILE.format(stamp="strftime(ts, '%Y%m%d-%H')")} as source_filename from made
), dim as (
  select * from (values {_DIM}) t(source_project, project, language, project_family, access_mode)
), tokens as (
  select event_id, value, concat('file:/dumps/', source_filename) as source_file, source_filename, string_split(value, ' ') as parts from raw
), parsed as (
  select event_id, value, source_file, source_filename, len(parts)::int as n_tokens,
    list_extract(parts, 1) as source_project, list_extract(parts, 2) as page_title, list_extract(parts, 3) as view_count_raw, list_extract(parts, 4) as response_size_raw,
    case when regexp_full_match(list_extract(parts, 3), '[+-]?[0-9]+') then try_cast(list_extract(parts, 3) as bigint) end as view_count,
    case when regexp_full_match(list_extract(parts, 4), '[+-]?[0-9]+') then try_cast(list_extract(parts, 4) as bigint) end as response_size,
    try_cast(regexp_replace(regexp_extract(source_filename, '-(\d{{8}})-\d\d0000\.gz$', 1), '(\d\d\d\d)(\d\d)(\d\d)', '\1-\2-\3') as date) as date,
    try_cast(regexp_extract(source_filename, '-\d{{8}}-(\d\d)0000\.gz$', 1) as int) as hour
  from tokens
), classed as (
  select parsed.*, dim.project, dim.language, dim.project_family, dim.access_mode, case
    when date is null or hour is null then 'invalid_filename' when n_tokens <> 4 then 'malformed_line'
    when source_project = '' or page_title = '' then 'missing_required_value'
    when view_count is null or response_size is null then 'non_numeric_metric'
    when view_count < 0 or response_size < 0 then 'negative_metric' when project is null then 'unsupported_source_project' end as invalid_reason
  from parsed left join dim using (source_project)
), silver as (
  select event_id, date, hour, source_project, project, language, project_family, access_mode, page_title, replace(url_decode(page_title), '_', ' ') as normalized_title,
    view_count, response_size, source_filename from classed where invalid_reason is null
), quarantine as (
  select date, hour, source_project, page_title, view_count_raw, response_size_raw, invalid_reason, value as raw_line, source_file, source_filename
  from classed where invalid_reason is not null
), manifest as (
  select concat('pageviews-', strftime(timestamp_hour, '%Y%m%d-%H'), '0000.gz') as filename, timestamp_hour, size_bytes
  from (select date_trunc('hour', ts) as timestamp_hour, count(*)::bigint * 1000 as size_bytes from events group by 1)
), actual as (
  select filename, size_bytes + case when hour(timestamp_hour) % 6 = 0 then 1 else 0 end as size_bytes from manifest
  where not (hour(timestamp_hour) = 3 and day(timestamp_hour) % 5 = 0)
  union all select concat('pageviews-20991231-0', i, '0000.gz'), i * 10 from range(3) t(i)
), inventory as (
  select coalesce(m.filename, a.filename) as filename, m.size_bytes as size_bytes_manifest, a.size_bytes as size_bytes_actual,
    case when m.filename is not null and a.filename is not null then 'both' when m.filename is not null then 'left_only' else 'right_only' end as found,
    coalesce(m.size_bytes = a.size_bytes, false) as size_matches
  from manifest m full join actual a on m.filename = a.filename
), expected as (
  select distinct timestamp_hour::date as date, hour(timestamp_hour)::int as hour, dim.project, dim.access_mode from manifest, dim
), present as (
  select distinct date, hour, project, access_mode from silver
)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None) -> Callable:
    """Register a function under its name, with its SQL after the common frames."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__.removeprefix("q_")] = f
        if sql:
            ORACLE[f.__name__.removeprefix("q_")] = BASE + sql
        return f

    return add


# -- sources and names


@_query("select event_id, value, source_filename from raw")
def q_raw_lines(spark, sf_dir):
    return raw_lines(spark, sf_dir).select("event_id", "value", "source_filename")


@_query("select distinct source_filename, date, hour from parsed")
def q_filename_parse(spark, sf_dir):
    stamp = F.col("stamp")
    names = raw_lines(spark, sf_dir).select("source_filename").distinct().withColumn("stamp", dump_stamp(F.col("source_filename")))
    return names.select("source_filename", dump_date(stamp).alias("date"), dump_hour(stamp).alias("hour"))


@_query("select distinct concat('date=', date, '/hour=', hour, '/project=', project, '/access_mode=', access_mode, '/part-00000.parquet') as path, date, hour, project, access_mode from silver union all select 'other/part-00000.parquet', null, null, null, null")
def q_partition_parse(spark, sf_dir):
    keys = _silver(spark, sf_dir).select(*PARTITION).distinct()
    path = F.concat(F.lit("date="), F.col("date").cast("string"), F.lit("/hour="), F.col("hour").cast("string"), F.lit("/project="), "project", F.lit("/access_mode="), "access_mode", F.lit("/part-00000.parquet"))
    paths = keys.select(path.alias("path")).union(spark.range(1).select(F.lit("other/part-00000.parquet")))
    return paths.select("path", *partition_columns(F.col("path")))


@_query(f"select ts::date as date, hour(ts)::int as hour, concat('pageviews-', strftime(ts, '%Y%m%d-%H'), '0000.gz') as filename from generate_series(timestamp '{SPINE_DAYS[0]} 00:00:00', timestamp '{SPINE_DAYS[1]} 23:00:00', interval 1 hour) t(ts)")
def q_hour_spine(spark, sf_dir):
    return _spine(spark)


@_query("select filename, size_bytes from manifest where timestamp_hour::date between date '2024-01-01' and date '2024-01-07'")
def q_manifest_semi(spark, sf_dir):
    return _manifest(spark, sf_dir).join(F.broadcast(_spine(spark)), "filename", "left_semi").select("filename", "size_bytes")


@_query("select count(*) as files, min(timestamp_hour) as first_hour, max(timestamp_hour) as last_hour, coalesce(sum(size_bytes), 0)::bigint as total_bytes, round(coalesce(sum(size_bytes), 0)::double / 1024.0 / 1024.0, 2) as total_mib from manifest")
def q_manifest_summary(spark, sf_dir):
    return profile.summary(_manifest(spark, sf_dir))


@_query("select * from inventory")
def q_inventory_outer(spark, sf_dir):
    return profile.inventory(_manifest(spark, sf_dir), _actual(spark, sf_dir))


@_query("select * from inventory where found <> 'both' or not size_matches")
def q_inventory_mismatch(spark, sf_dir):
    return profile.inventory_mismatches(profile.inventory(_manifest(spark, sf_dir), _actual(spark, sf_dir)))


@_query(None)
def q_file_inventory(spark, sf_dir):
    return profile.file_inventory(spark, sf_dir).agg(F.count("*").alias("files"), F.sum("length").alias("total_bytes"))


# -- lines


@_query("select event_id, n_tokens, source_project, page_title, view_count_raw, response_size_raw from parsed")
def q_line_tokens(spark, sf_dir):
    return parsed(raw_lines(spark, sf_dir)).select("event_id", "n_tokens", "source_project", "page_title", "view_count_raw", "response_size_raw")


@_query("select event_id, view_count, response_size from parsed")
def q_metric_parse(spark, sf_dir):
    rows = parsed(raw_lines(spark, sf_dir))
    return rows.select("event_id", metric(F.col("view_count_raw")).alias("view_count"), metric(F.col("response_size_raw")).alias("response_size"))


@_query("select distinct page_title, replace(url_decode(page_title), '_', ' ') as normalized_title from parsed where page_title is not null")
def q_title_normalize(spark, sf_dir):
    titles = parsed(raw_lines(spark, sf_dir)).where("page_title is not null").select("page_title").distinct()
    return titles.select("page_title", normalized_title(F.col("page_title")).alias("normalized_title"))


@_query("select * from dim")
def q_dim_project(spark, sf_dir):
    return projects.dimension(spark)


@_query("select distinct source_project, language, coalesce(project_family, 'other') as family from classed where source_project is not null")
def q_lang_family(spark, sf_dir):
    codes = parsed(raw_lines(spark, sf_dir)).where("source_project is not null").select("source_project").distinct()
    return codes.join(F.broadcast(projects.dimension(spark)), "source_project", "left").select("source_project", "language", projects.family_or_other(F.col("project_family")).alias("family"))


@_query("select event_id, source_project, project, language, project_family, access_mode from classed")
def q_left_dim_join(spark, sf_dir):
    return _lines(spark, sf_dir).select("event_id", "source_project", "project", "language", "project_family", "access_mode")


@_query("select event_id, value from classed where project is not null")
def q_allowlist_semi(spark, sf_dir):
    return silver.in_scope(raw_lines(spark, sf_dir), CODES).select("event_id", "value")


@_query("select invalid_reason, count(*) as n_rows from classed group by 1")
def q_reason_counts(spark, sf_dir):
    return profile.value_counts(_lines(spark, sf_dir), "invalid_reason")


@_query("select * exclude (event_id) from silver")
def q_silver_rows(spark, sf_dir):
    return _silver(spark, sf_dir)


@_query("select * from quarantine")
def q_quarantine_rows(spark, sf_dir):
    return _quarantine(spark, sf_dir)


# -- coverage


@_query("select * from expected")
def q_expected_partitions(spark, sf_dir):
    return _expected(spark, sf_dir)


@_query("select * from expected except select * from present")
def q_missing_partitions(spark, sf_dir):
    return profile.missing(_expected(spark, sf_dir), _silver(spark, sf_dir), PARTITION)


@_query("select * from present except select * from expected where hour % 2 = 0")
def q_extra_partitions(spark, sf_dir):
    return profile.extra(_expected(spark, sf_dir).where("hour % 2 = 0"), _silver(spark, sf_dir), PARTITION)


@_query(f"select date, hour, count(*) as partitions from present group by 1, 2 having count(*) <> {EXPECTED_PAIRS}")
def q_hour_coverage(spark, sf_dir):
    return profile.hour_coverage(_silver(spark, sf_dir), EXPECTED_PAIRS)


# -- totals

_SUMS = "count(*) as row_count, sum(view_count)::bigint as total_views, sum(response_size)::bigint as total_bytes"


@_query(f"select project, access_mode, {_SUMS} from silver group by 1, 2")
def q_project_access_totals(spark, sf_dir):
    return profile.project_access_totals(_silver(spark, sf_dir))


@_query(f"select date, hour, project, access_mode, {_SUMS} from silver group by 1, 2, 3, 4 order by total_views desc, 1, 2, 3, 4 limit 50")
def q_partition_totals_top50(spark, sf_dir):
    return profile.partition_totals(_silver(spark, sf_dir))


@_query("select date, hour, project, sum(view_count)::bigint as views from silver group by 1, 2, 3")
def q_hourly_project_views(spark, sf_dir):
    return profile.hourly_project_views(_silver(spark, sf_dir))


@_query("select date, hour, " + ", ".join(f"coalesce(sum(view_count) filter (project = '{p}'), 0)::bigint as {p}" for p in PIVOT) + " from silver group by 1, 2")
def q_hourly_pivot(spark, sf_dir):
    return profile.hourly_pivot(_silver(spark, sf_dir), PIVOT)


@_query("select date, hour, source_project, page_title, normalized_title, view_count from silver order by view_count desc, 1, 2, 3, 4, 5 limit 25")
def q_top_titles(spark, sf_dir):
    return profile.top_titles(_silver(spark, sf_dir))


@_query("select date, hour, source_project, page_title, count(*) as n_rows from silver group by 1, 2, 3, 4 having count(*) > 1")
def q_duplicate_keys(spark, sf_dir):
    return profile.duplicate_keys(_silver(spark, sf_dir))


@_query("select count(distinct date) as dates, count(distinct (date, hour)) as date_hours, count(*) as partitions from present")
def q_distinct_counts(spark, sf_dir):
    return profile.distinct_counts(_silver(spark, sf_dir))


@_query("select distinct project, access_mode from silver")
def q_distinct_pairs(spark, sf_dir):
    return profile.distinct_pairs(_silver(spark, sf_dir))


@_query("select source_filename, count(*) as sampled, count(*) filter (invalid_reason is null) as parsed, count(*) filter (invalid_reason is not null) as malformed from classed group by 1")
def q_parse_stats(spark, sf_dir):
    return profile.parse_stats(_lines(spark, sf_dir))


@_query("select source_filename, source_project, count(*) as n_lines from classed group by 1, 2")
def q_source_counter(spark, sf_dir):
    return profile.source_counts(_lines(spark, sf_dir))


@_query("""select count(n) as n, avg(n) as mean, stddev_samp(n) as std, min(n) as least, quantile_cont(n, 0.25) as q25, quantile_cont(n, 0.5) as q50,
  quantile_cont(n, 0.75) as q75, max(n) as most from (select count(*) as n from raw group by source_filename)""")
def q_describe_stats(spark, sf_dir):
    counts = raw_lines(spark, sf_dir).groupBy("source_filename").agg(F.count("*").alias("n_lines"))
    return profile.describe(counts, "n_lines")


@_query("""select count(*) as row_count, count(*) filter (page_title is null) as null_page_title, count(*) filter (normalized_title is null) as null_normalized_title,
  count(*) filter (view_count is null or view_count < 0) as bad_view_count, count(*) filter (response_size is null or response_size < 0) as bad_response_size from silver""")
def q_dq_counts(spark, sf_dir):
    return profile.quality_counts(_silver(spark, sf_dir))


@_query("select count(*) as row_count from silver")
def q_row_count(spark, sf_dir):
    return _silver(spark, sf_dir).agg(F.count("*").alias("row_count"))


@_query("select string_agg(distinct project, ',' order by project) as projects, string_agg(distinct access_mode, ',' order by access_mode) as access_modes from silver")
def q_unique_lists(spark, sf_dir):
    return profile.unique_lists(_silver(spark, sf_dir))


@_query("select date, project, access_mode, count(*) as n_rows from silver group by 1, 2, 3 order by 1, 2, 3 limit 50")
def q_group_count_ordered(spark, sf_dir):
    return profile.group_count_ordered(_silver(spark, sf_dir))


_SAMPLE = "select source_filename, event_id, value from (select *, row_number() over (partition by source_filename order by event_id) as place from raw where source_filename in (select distinct source_filename from raw order by 1 limit {k})) where place <= {n}"


@_query(_SAMPLE.format(k=5, n=3))
def q_per_file_sample(spark, sf_dir):
    return profile.first_of_files(raw_lines(spark, sf_dir), "source_filename", F.col("event_id"), 3, 5).select("source_filename", "event_id", "value")


@_query(f"select 'first' as part, source_filename, event_id from ({_SAMPLE.format(k=2, n=2)}) union all select 'second', source_filename, event_id from ({_SAMPLE.format(k=3, n=1)})")
def q_union_samples(spark, sf_dir):
    raw = raw_lines(spark, sf_dir)
    a, b = (profile.first_of_files(raw, "source_filename", F.col("event_id"), n, k).select(F.lit(name).alias("part"), "source_filename", "event_id") for name, n, k in (("first", 2, 2), ("second", 1, 3)))
    return a.unionByName(b)


@_query("select 'source_filename' as column_name")
def q_lineage_intersect(spark, sf_dir):
    have = spark.createDataFrame([(c,) for c in _silver(spark, sf_dir).columns], "column_name string")
    return have.intersect(spark.createDataFrame([(c,) for c in LINEAGE], "column_name string"))


@_query("select filename, size_bytes from manifest order by filename limit 10")
def q_limit_ordered(spark, sf_dir):
    return _manifest(spark, sf_dir).select("filename", "size_bytes").orderBy("filename").limit(10)
