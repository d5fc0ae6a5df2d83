"""Paged JSON landing files: write (landing sink) and scan (bronze source).

Two folder layouts are read:

* ``hive``  - ``root/affiliate_id=<id>/endpoint=<name>/dt=YYYY-MM-DD/*.json``,
  one page envelope per line.  Written by :func:`write_landing`; ``dt`` is a
  partition column, so a lookback filter prunes whole folders before any
  file is opened.
* ``dated`` - ``root/affiliate<id>/<endpoint>/YYYY/MM/DD/*.json``, one
  pretty-printed envelope per file (the upstream API dump).  Affiliate and
  folder date come from the file path; lookback is a filter on that date.

Each page is ``{code, msg, requestTime, data: [record, ...]}`` with all
values as strings.  A scan explodes ``data`` with ``inline`` (empty or
missing ``data`` yields no rows), renames API fields, parses epoch-ms text
and decimal text, and adds lineage (source file, load time, load status).
Unreadable files land in a quarantine frame instead of failing the job.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.expr import (date_literal, epoch_ms_to_ts, parse_decimal,
                                   ts_literal, ts_to_epoch_ms)
from strata.schemas import ENDPOINT_FIELDS, ENVELOPES
from strata.sources.catalog import glob_paths

# Default page size, spread of the landing write, and the envelope's success code / message.
PAGE_SIZE = 1000
INPUTS_A_FILE = 4    # input partitions whose rows of one folder make one file
OK_CODE = "00000"
OK_MSG = "success"
CORRUPT = "_corrupt_record"

# bronze column -> (api field, parser) per endpoint
_BRONZE_MAP = {
    "customer_list": [("client_id", "uid", None), ("register_time", "registerTime", "ts")],
    "deposits": [("order_id", "orderId", None), ("client_id", "uid", None),
                 ("deposit_time", "depositTime", "ts"), ("deposit_coin", "depositCoin", None),
                 ("deposit_amount", "depositAmount", "dec")],
    "trade_activities": [("client_id", "uid", None), ("trade_volume", "volumn", "dec"),
                         ("trade_time", "time", "ts")],
    "assets": [("client_id", "uid", None), ("balance", "balance", "dec"),
               ("update_time", "uTime", "ts"), ("remark", "remark", None)],
}
# Optional fields: a NULL here does not make the record an error.
_OPTIONAL = {"remark"}
EVENT_TIME = {"customer_list": "register_time", "deposits": "deposit_time",
              "trade_activities": "trade_time", "assets": "update_time"}


def _to_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return ts_to_epoch_ms(c.cast("timestamp_ntz")).cast("string")
    return c.cast("string")


def folder_start(event: Column, dt_unit: str) -> Column:
    """Folder date of an event: its day, or the first day of its month/year."""
    d = F.to_date(event)
    return d if dt_unit == "day" else F.trunc(d, dt_unit)


def folder_end(dt: Column, dt_unit: str) -> Column:
    """Last day covered by a folder starting at ``dt``."""
    if dt_unit == "day":
        return dt
    if dt_unit == "month":
        return F.last_day(dt)
    return F.date_sub(F.add_months(dt, 12), 1)


def write_landing(df: DataFrame, root: str, endpoint: str, *, request_time=None,
                  page_size: int = PAGE_SIZE, mode: str = "append", dt_unit: str = "day") -> None:
    """Write bronze-shaped rows as page envelopes under ``root`` (hive layout).

    ``df`` carries ``affiliate_id`` plus the bronze columns of the endpoint.
    Folders are one per (affiliate, endpoint, day) or, with ``dt_unit`` "month" / "year",
    per month or year (sparse history spread over years would otherwise
    make one tiny file per day).  Rows are shuffled once, by folder and by the group of
    ``INPUTS_A_FILE`` input partitions that they come from, so that a folder has few files and a
    hot one, or a large input, is spread over more tasks.  Sorting, numbering
    and paging follow inside these partitions: a page never spans
    two, holds at most ``page_size`` records, and a retried task cuts the same pages.
    """
    mapping = _BRONZE_MAP[endpoint]
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    record = F.struct(*[_to_text(F.col(b), types[b]).alias(api) for b, api, _ in mapping])
    # Keep the API's field order inside each record.
    order = ENDPOINT_FIELDS[endpoint]
    record = F.struct(*[record[f].alias(f) for f in order])
    event = F.col(EVENT_TIME[endpoint])
    req = ts_to_epoch_ms(ts_literal(request_time)) if request_time is not None else \
        ts_to_epoch_ms(F.current_timestamp().cast("timestamp_ntz"))
    folder = ["affiliate_id", "dt", "__inputs"]
    base = (df.select(F.col("affiliate_id").cast("string").alias("affiliate_id"),
                      folder_start(event, dt_unit).alias("dt"), record.alias("rec"),
                      F.floor(F.spark_partition_id() / F.lit(INPUTS_A_FILE)).alias("__inputs"))
            .repartition(*folder))
    # Row ids are taken after a sort inside each partition, so a retried
    # task numbers its rows - and cuts its pages - exactly as before.
    # Grouping by page needs no further shuffle: the folder columns hold a page's rows together.
    pages = (base.sortWithinPartitions(*folder, F.xxhash64("rec"), "rec")
             .withColumn("__page", F.floor(F.monotonically_increasing_id() / F.lit(page_size)))
             .groupBy(*folder, "__page")
             .agg(F.collect_list("rec").alias("data"))
             .select(F.lit(OK_CODE).alias("code"), F.lit(OK_MSG).alias("msg"),
                     req.cast("string").alias("requestTime"), "data",
                     "affiliate_id", F.lit(endpoint).alias("endpoint"), "dt"))
    (pages.write.mode(mode).partitionBy("affiliate_id", "endpoint", "dt")
     .option("compression", "gzip").json(root))


@dataclass
class Scan:
    """Result of a page scan: bronze rows and quarantined files/records."""
    rows: DataFrame
    quarantine: DataFrame


def _empty_envelopes(spark: SparkSession, fields) -> DataFrame:
    schema = T.StructType(list(fields) + [T.StructField("affiliate_id", T.StringType()),
                                          T.StructField("endpoint", T.StringType()),
                                          T.StructField("dt", T.DateType()),
                                          T.StructField("source_file", T.StringType())])
    return spark.createDataFrame([], schema)


def landing_folders(spark: SparkSession, root: str, endpoint: str, layout: str, first_day: dt.date | None = None,
                    dt_unit: str = "day") -> list[str]:
    """The date folders of one endpoint, found level by level; with ``first_day`` those that can hold a day from it on.

    Only folder names are listed, never files: other endpoints and older
    dates are not looked into.
    """
    root = root.rstrip("/")
    if layout == "hive":
        found = glob_paths(spark, f"{root}/affiliate_id=*/endpoint={endpoint}/dt=*")
        starts = [(p, dt.date.fromisoformat(p.rsplit("dt=", 1)[1])) for p in found if not p.endswith("dt=__HIVE_DEFAULT_PARTITION__")]
        kept = [p for p, day in starts if first_day is None or last_day(day, dt_unit) >= first_day]
        return kept + [p for p in found if first_day is None and p.endswith("dt=__HIVE_DEFAULT_PARTITION__")]
    if first_day is None:
        return glob_paths(spark, f"{root}/affiliate*/{endpoint}/*/*/*")
    years = [p for p in glob_paths(spark, f"{root}/affiliate*/{endpoint}/*") if _number(p) >= first_day.year]
    months = [p for y in _by_name(years) for p in glob_paths(spark, f"{root}/affiliate*/{endpoint}/{y}/*")
              if (int(y), _number(p)) >= (first_day.year, first_day.month)]
    days = []
    for y, m in sorted({tuple(p.rsplit("/", 2)[1:]) for p in months}):
        days += [p for p in glob_paths(spark, f"{root}/affiliate*/{endpoint}/{y}/{m}/*")
                 if (int(y), int(m), _number(p)) >= (first_day.year, first_day.month, first_day.day)]
    return days


def _number(path: str) -> int:
    name = path.rsplit("/", 1)[1]
    return int(name) if name.isdigit() else -1


def _by_name(paths: list[str]) -> list[str]:
    return sorted({p.rsplit("/", 1)[1] for p in paths})


def last_day(start: dt.date, dt_unit: str) -> dt.date:
    """Last day that a folder starting at ``start`` covers."""
    if dt_unit == "day":
        return start
    after = dt.date(start.year + 1, 1, 1) if dt_unit == "year" or start.month == 12 else dt.date(start.year, start.month + 1, 1)
    return after - dt.timedelta(days=1)


def _read_envelopes(spark: SparkSession, root: str, endpoint: str, layout: str, first_day: dt.date | None = None,
                    dt_unit: str = "day") -> DataFrame:
    fields = list(ENVELOPES[endpoint].fields) + [T.StructField(CORRUPT, T.StringType(), True)]
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    folders = landing_folders(spark, root, endpoint, layout, first_day, dt_unit)
    if not folders:      # endpoint not delivered: nothing to read
        return _empty_envelopes(spark, fields)
    if layout == "hive":
        parts = [T.StructField("affiliate_id", T.StringType()), T.StructField("endpoint", T.StringType()),
                 T.StructField("dt", T.DateType())]
        raw = reader.schema(T.StructType(fields + parts)).option("basePath", root).json(folders)
        return raw.withColumn("source_file", F.col("_metadata.file_path"))
    raw = reader.schema(T.StructType(fields)).option("multiLine", True).option("pathGlobFilter", "*.json").json(folders)
    path = F.col("_metadata.file_path")
    ymd = F.regexp_extract(path, r"/(\d{4})/(\d{2})/(\d{2})/[^/]*$", 0)
    folder_date = F.to_date(F.regexp_replace(F.substring(ymd, 2, 10), "/", "-"), "yyyy-MM-dd")
    return (raw.withColumn("source_file", path)
            .withColumn("affiliate_id", F.regexp_extract(path, r"/affiliate(\d+)/", 1))
            .withColumn("dt", folder_date))


def read_envelopes(spark: SparkSession, root: str, endpoint: str, layout: str = "hive") -> DataFrame:
    """Raw page envelopes of one endpoint with affiliate_id, dt, source_file."""
    return _read_envelopes(spark, root, endpoint, layout)


def envelopes_to_rows(env: DataFrame, endpoint: str, load_time=None) -> DataFrame:
    """Explode valid envelopes into bronze rows (works on batch and
    streaming frames).  ``env`` needs affiliate_id, source_file, code, data."""
    good = env.filter(F.col(CORRUPT).isNull() & F.col("code").rlike("^[0-9]+$")) \
        if CORRUPT in env.columns else env.filter(F.col("code").rlike("^[0-9]+$"))
    stamp = ts_literal(load_time) if load_time is not None else F.current_timestamp().cast("timestamp_ntz")
    recs = good.select("affiliate_id", "source_file", F.inline("data"))
    columns, ok = bronze_columns(endpoint, F.col)
    return recs.select("affiliate_id", *columns, "source_file", stamp.alias("load_time"),
                       F.when(ok, F.lit("SUCCESS")).otherwise(F.lit("ERROR")).alias("load_status"))


def bronze_columns(endpoint: str, field) -> tuple[list[Column], Column]:
    """The bronze columns of a record, and whether all required ones could be read.  ``field(name)`` is a column of an API field."""
    out, ok = [], F.lit(True)
    for bronze, api, parser in _BRONZE_MAP[endpoint]:
        c = field(api)
        if parser == "ts":
            c = epoch_ms_to_ts(c)
        elif parser == "dec":
            c = parse_decimal(c, 20, 8)
        out.append(c.alias(bronze))
        if bronze not in _OPTIONAL:
            ok = ok & c.isNotNull()
    return out, ok


# What becomes of an input.
ROW, BAD_RECORD, BAD_PAGE, EMPTY_PAGE = "row", "bad_record", "bad_page", "empty_page"


def classified(env: DataFrame, endpoint: str, load_time=None) -> DataFrame:
    """Everything that a set of envelopes holds, each with its ``kind``, from one parse.

    ``row``: a bronze row; ``bad_record``: a record without a required field or
    with one that cannot be read; ``bad_page``: no JSON, no ``data``, or a code that
    is no number; ``empty_page``: a good page without records.  ``raw`` has the
    text of what is bad, ``first`` marks one line for each page.  Works on batch and
    streaming frames; nothing of the input is left out.
    """
    broken = F.col(CORRUPT).isNotNull() | F.col("data").isNull() | ~F.coalesce(F.col("code").rlike("^[0-9]+$"), F.lit(False))
    page = F.coalesce(F.col(CORRUPT), F.to_json(F.struct("code", "msg", "requestTime", "data")))
    lines = env.select("affiliate_id", "source_file", broken.alias("broken"), F.when(broken, page).alias("page"),
                       F.posexplode_outer(F.when(~broken, F.col("data"))).alias("pos", "rec"))
    columns, ok = bronze_columns(endpoint, lambda name: F.col("rec")[name])
    stamp = ts_literal(load_time) if load_time is not None else F.current_timestamp().cast("timestamp_ntz")
    kind = (F.when(F.col("broken"), F.lit(BAD_PAGE)).when(F.col("pos").isNull(), F.lit(EMPTY_PAGE))
            .when(ok, F.lit(ROW)).otherwise(F.lit(BAD_RECORD)))
    return lines.select("affiliate_id", *columns, "source_file", stamp.alias("load_time"),
                        F.when(ok, F.lit("SUCCESS")).otherwise(F.lit("ERROR")).alias("load_status"), kind.alias("kind"),
                        F.when(F.col("broken"), F.col("page")).when(~ok, F.coalesce(F.to_json("rec"), F.lit("null"))).alias("raw"),
                        (F.coalesce("pos", F.lit(0)) == 0).alias("first"))


def scan_pages(spark: SparkSession, root: str, endpoint: str, *, layout: str = "hive",
               as_of=None, days_back: int | None = None, load_time=None, dt_unit: str = "day") -> Scan:
    """Scan landing pages of one endpoint into bronze rows.

    Lookback: keep folders whose date ``dt`` satisfies
    ``datediff(as_of, dt) <= days_back`` (no upper bound: future folders are
    kept).  On the hive layout this is partition pruning; with month or
    year folders the pruning keeps every folder holding a qualifying day and
    the record's own day is then checked exactly.
    """
    env, anchor = _looked_back(spark, root, endpoint, layout, as_of, days_back, dt_unit)
    bad = env.filter(F.col(CORRUPT).isNotNull() | F.col("data").isNull() |
                     F.col("code").isNull() | ~F.col("code").rlike("^[0-9]+$"))
    rows = envelopes_to_rows(env, endpoint, load_time)
    if anchor is not None and layout == "hive" and dt_unit != "day":
        rows = rows.filter(F.datediff(anchor, F.to_date(F.col(EVENT_TIME[endpoint]))) <= days_back)
    quarantine = bad.select("affiliate_id", "source_file", "dt", "code", "msg", CORRUPT)
    return Scan(rows, quarantine)


def _looked_back(spark, root, endpoint, layout, as_of, days_back, dt_unit) -> tuple[DataFrame, Column | None]:
    """Envelopes of the folders that a lookback keeps, and its anchor date."""
    if days_back is None:
        return _read_envelopes(spark, root, endpoint, layout), None
    day = dt.date.today() if as_of is None else dt.date.fromisoformat(str(as_of)[:10])
    env = _read_envelopes(spark, root, endpoint, layout, day - dt.timedelta(days=days_back), dt_unit)
    anchor = date_literal(day)
    return env.filter(F.datediff(anchor, folder_end(F.col("dt"), dt_unit)) <= days_back), anchor


def scan_lines(spark: SparkSession, root: str, endpoint: str, *, layout: str = "hive", as_of=None, days_back: int | None = None,
               load_time=None, dt_unit: str = "day") -> DataFrame:
    """The landing pages of one endpoint as :func:`classified` lines; the lookback is that of :func:`scan_pages`."""
    env, anchor = _looked_back(spark, root, endpoint, layout, as_of, days_back, dt_unit)
    lines = classified(env, endpoint, load_time)
    if anchor is not None and layout == "hive" and dt_unit != "day":
        old = F.datediff(anchor, F.to_date(F.col(EVENT_TIME[endpoint]))) > days_back
        lines = lines.filter((F.col("kind") != ROW) | ~old)
    return lines


def discover_affiliates(spark: SparkSession, root: str) -> DataFrame:
    """Affiliates present in the landing area: affiliate_id, affiliate_no
    (numeric sort key).  Only the names of the top folders are listed."""
    names = [p.rsplit("/", 1)[1] for p in glob_paths(spark, f"{root.rstrip('/')}/affiliate*")]
    ids = sorted({m[1] for m in (re.fullmatch(r"affiliate(?:_id=)?(\d+)", n) for n in names) if m})
    found = spark.createDataFrame([(i,) for i in ids], "affiliate_id string")
    return found.select("affiliate_id", F.col("affiliate_id").cast("int").alias("affiliate_no"))


def landing_summary(spark: SparkSession, root: str, endpoint: str) -> DataFrame:
    """Records per landing folder (affiliate, endpoint, day) and pages."""
    env = _read_envelopes(spark, root, endpoint, "hive")
    return (env.groupBy("affiliate_id", "endpoint", "dt")
            .agg(F.sum(F.size("data")).cast("long").alias("records"),
                 F.count(F.lit(1)).alias("pages")))


def batch_metadata(rows: DataFrame, endpoint: str) -> DataFrame:
    """Per (affiliate, endpoint) fetch metadata of a scanned batch:
    records_fetched, first/last event time, days covered."""
    t = F.col(EVENT_TIME[endpoint])
    return (rows.groupBy("affiliate_id")
            .agg(F.count(F.lit(1)).alias("records_fetched"), F.min(t).alias("start_time"),
                 F.max(t).alias("end_time"), F.countDistinct(F.to_date(t)).alias("days_covered"))
            .select("affiliate_id", F.lit(endpoint).alias("endpoint"), "records_fetched",
                    "start_time", "end_time", "days_covered"))


def batch_log(lines: DataFrame, endpoint: str, stamp) -> DataFrame:
    """Log rows of a fetched batch of :func:`classified` lines: per affiliate the records and pages fetched,
    the first and last event, the landing folder's date text and the record time as ISO text."""
    t = F.when(F.col("kind") == ROW, F.col(EVENT_TIME[endpoint]))
    return (lines.groupBy("affiliate_id")
            .agg(F.count(F.when(F.col("kind").isin(ROW, BAD_RECORD), 1)).alias("records_fetched"),
                 F.count(F.when(F.col("first"), 1)).alias("pages_fetched"), F.min(t).alias("start_time"), F.max(t).alias("end_time"))
            .select("affiliate_id", F.lit(endpoint).alias("endpoint"), "records_fetched", "pages_fetched", "start_time", "end_time",
                    F.date_format(ts_literal(stamp), "yyyy/MM/dd").alias("folder"),
                    F.date_format(ts_literal(stamp), "yyyy-MM-dd'T'HH:mm:ss").alias("record_timestamp")))


def validate_envelope(env: DataFrame) -> DataFrame:
    """Response-code check: ``code`` must be numeric; body optional."""
    return env.withColumn("code_valid", F.coalesce(F.col("code").rlike("^[0-9]+$"), F.lit(False)))
