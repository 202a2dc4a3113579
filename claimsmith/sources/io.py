"""Sources and sinks S1-S14.

Reads and writes are Spark DataFrameReader/Writer calls executed by the
executors; nothing is loaded into driver memory. The run date is a
partition column written with dynamic partition overwrite, so re-running a
date replaces only that date.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsmith.operators.clean import null_missing_tokens

# Statuses of an ingested source.
STATUS_PRIMARY = "downloaded"
STATUS_FALLBACK = "fallback_sample"

INGESTION_SCHEMA = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("used_fallback", T.BooleanType()),
    T.StructField("fallback_file", T.StringType()),
    T.StructField("output_path", T.StringType()),
    T.StructField("records", T.LongType()),
    T.StructField("note", T.StringType()),
    T.StructField("error", T.StringType()),
])


class MissingColumnsError(ValueError):
    pass


def validate_columns(df: DataFrame, required: list[str]) -> None:
    """S3: raise listing the required columns the header lacks (no data job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"Missing required columns: {missing}")


def _csv_options(multi_line: bool) -> dict[str, str]:
    """Quoted fields hold commas, line breaks and doubled quotes; a backslash
    is a character like any other."""
    return {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"', "multiLine": str(multi_line).lower()}


def _quoting(spark: SparkSession, path: str) -> tuple[bool, bool]:
    """(a quoted field holds a line break, a quote is never closed).

    A record goes on in the next line exactly when its line ends inside
    quotes, and the first such line has an odd number of them. So one split
    read of the lines tells whether the file can be read split by lines, too;
    only files with such records are read whole by one task each.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        (F.length("value") - F.length(F.replace("value", F.lit('"')))).cast("bigint").alias("quotes"))
    by_file = lines.groupBy("file").agg(F.max(F.col("quotes") % 2).alias("odd"), (F.sum("quotes") % 2).alias("open"))
    row = by_file.agg(F.max("odd"), F.max("open")).first()
    return bool(row[0]), bool(row[1])


#: A text that stands for null when an empty quoted field must not: three control characters.
_NULL_TEXT = "\x01\x02\x03"


def read_csv(spark: SparkSession, path: str, pandas_missing_tokens: bool = False, keep_empty: bool = False) -> DataFrame:
    """Header CSV, every column a string, names from the header (a UTF-8
    BOM is stripped by Spark). Records may span lines inside quotes (in a file
    whose records end in CR LF, a quoted CR LF reads as LF). No ``.schema``: with a header Spark would bind a schema by position.
    ``pandas_missing_tokens`` nulls 'NA', 'null', ... like the reference's
    pandas-based ingest. An empty field is null, quoted or not; with
    ``keep_empty`` a quoted one is an empty text, as a snapshot means it."""
    options = _csv_options(_quoting(spark, path)[0]) | ({"nullValue": _NULL_TEXT} if keep_empty else {})
    df = spark.read.options(**options).option("inferSchema", False).csv(path)
    return null_missing_tokens(df) if pandas_missing_tokens else df


class MalformedSourceError(ValueError):
    pass


_SURPLUS = "__cs_surplus"


def read_checked_csv(spark: SparkSession, path: str) -> DataFrame:
    """S1 with the checks of a strict reader, run before the source is
    chosen: an empty file, unreadable content, a quote that is never closed or
    a record with more fields than the header raises. (A shorter record is
    filled with nulls.) The read-throughs are distributed passes; the second
    stops at the first surplus field."""
    multi_line, unclosed = _quoting(spark, path)
    if unclosed:
        raise MalformedSourceError(f"a quoted field of {path} is never closed")
    header = spark.read.options(**_csv_options(multi_line)).csv(path).columns
    if not header:
        raise MalformedSourceError(f"no header in {path}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _SURPLUS]])
    df = spark.read.options(**_csv_options(multi_line)).option("enforceSchema", True).schema(schema).csv(path)
    if not df.where(F.col(_SURPLUS).isNotNull()).isEmpty():
        raise MalformedSourceError(f"a record of {path} has more fields than the header")
    return df.drop(_SURPLUS)


@dataclass
class IngestionRecord:
    source_name: str
    source_url: str
    status: str
    used_fallback: bool
    fallback_file: str
    output_path: str
    records: int
    note: str
    error: str


def read_source(spark: SparkSession, source_name: str, primary: str, fallback: str | None,
                required: list[str], allow_fallback: bool = True) -> tuple[DataFrame, dict]:
    """Primary path, else the fallback file when allowed; then S3.

    A primary that is missing, empty, unreadable or malformed falls back, and
    ``error`` says why. A missing column raises even when a fallback exists (as in the
    reference: validation comes after the choice of source)."""
    status, used_fallback, error, note = STATUS_PRIMARY, False, "", ""
    try:
        df = read_checked_csv(spark, primary)
    except Exception as exc:  # noqa: BLE001 - readers raise many kinds, also from the JVM
        if not allow_fallback or not fallback:
            raise RuntimeError(f"Source {source_name} failed and fallback disabled") from exc
        df = read_checked_csv(spark, fallback)
        status, used_fallback = STATUS_FALLBACK, True
        error = next((x for x in str(exc).splitlines() if x.strip()), type(exc).__name__)
        note = f"Primary unavailable. Used fallback file {fallback.rsplit('/', 1)[-1]}."
    validate_columns(df, required)
    info = dict(source_name=source_name, source_url=primary, status=status, used_fallback=used_fallback,
                fallback_file=(fallback or "").rsplit("/", 1)[-1], note=note, error=error)
    return df.select(*required), info


def write_raw_snapshot(df: DataFrame, required: list[str], path: str) -> None:
    """Required columns in declared order, CSV with header, replaced.

    ``read_csv(..., keep_empty=True)`` gives back every value: quotes are doubled, fields with
    commas, quotes or line breaks are quoted, white space at the ends stays,
    and an empty text (quoted) is told from null (nothing). A single column's
    null would be a blank line, which readers skip, so such a snapshot raises
    on write if it holds one.
    """
    out = df.select(*required)
    if len(required) == 1:
        out = out.select(F.coalesce(required[0], F.raise_error(F.lit(f"null in the only column {required[0]}"))).alias(required[0]))
    (out.write.mode("overwrite").options(**{k: v for k, v in _csv_options(False).items() if k != "multiLine"})
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", '""').csv(path))


def ingest_sources(spark: SparkSession, sources: dict[str, dict], raw_root: str, run_date: str,
                   allow_fallback: bool = True) -> DataFrame:
    """S2 + S4 for every source; returns the ingestion records as a DataFrame
    (records counted by Spark from the written snapshot)."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.sql import Observation

    def one(name: str, cfg: dict) -> dict:
        df, info = read_source(spark, name, cfg["primary"], cfg.get("fallback"), cfg["required"], allow_fallback)
        out = f"{raw_root}/{run_date}/{name}"
        obs = Observation(f"ingest_{name}")
        # The row count is observed during the write itself: no second job.
        write_raw_snapshot(df.observe(obs, F.count(F.lit(1)).alias("records")), cfg["required"], out)
        return IngestionRecord(output_path=out, records=int(obs.get["records"]), **info).__dict__

    with ThreadPoolExecutor(max_workers=max(1, min(4, len(sources)))) as pool:
        rows = list(pool.map(lambda kv: one(*kv), sources.items()))
    return spark.createDataFrame(rows, INGESTION_SCHEMA)


def source_health_summary(records: DataFrame) -> DataFrame:
    """Totals and fallback ratio (half-even, 4 dp; 0.0 with no source)."""
    fb = F.sum(F.when(F.col("used_fallback"), 1).otherwise(0))
    total = F.count(F.lit(1))
    return records.agg(
        total.cast("bigint").alias("total_sources"),
        (total - F.coalesce(fb, F.lit(0))).cast("bigint").alias("downloaded_count"),
        F.coalesce(fb, F.lit(0)).cast("bigint").alias("fallback_count"),
        F.coalesce(F.bround(fb.cast("double") / total, 4), F.lit(0.0)).alias("fallback_ratio"),
    )


def source_health_report(records: DataFrame) -> DataFrame:
    """The table behind the reference's markdown report."""
    return records.select("source_name", "status", "used_fallback", "records", "source_url", "fallback_file")


def write_manifest(records: DataFrame, path: str) -> None:
    """S5 sink: records and summary as JSON (one small file each)."""
    records.coalesce(1).write.mode("overwrite").json(f"{path}/results")
    source_health_summary(records).coalesce(1).write.mode("overwrite").json(f"{path}/summary")


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_run_partition(df: DataFrame, root: str, table: str, run_date: str) -> None:
    """``<root>/<table>/run_date=<date>`` replaced; other dates untouched
    (dynamic partition overwrite set on this write only)."""
    (df.withColumn("run_date", F.lit(run_date))
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("run_date")
       .parquet(f"{root}/{table}"))


def read_run_partition(spark: SparkSession, root: str, table: str, run_date: str) -> DataFrame:
    """S7 + S9: one run date of a table (the filter prunes partitions at
    planning time); a missing table raises FileNotFoundError naming its path."""
    try:
        df = spark.read.parquet(f"{root}/{table}")
    except AnalysisException as exc:
        raise FileNotFoundError(f"Expected table missing: {root}/{table} (run_date={run_date})") from exc
    return df.where(F.col("run_date") == F.lit(run_date)).drop("run_date")


PUBLISHED_SCHEMA = "run_date string, version string, published_at timestamp_ntz"


def new_version() -> str:
    """A version id; later ones sort behind earlier ones."""
    return f"v{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}"


def publish_version(spark: SparkSession, log: str, run_date: str, version: str) -> None:
    """Make a version of a run date current: one entry appended to the log of
    publications. The entry's file appears as a whole, so readers see the
    former version or this one, never a mix."""
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(run_date, version, now)], PUBLISHED_SCHEMA).coalesce(1).write.mode("append").parquet(log)


def published_versions(spark: SparkSession, log: str) -> DataFrame:
    """(run_date, version): the current version of every published run date.
    A log that is not there yet has no entries."""
    try:
        entries = spark.read.schema(PUBLISHED_SCHEMA).parquet(log)
        entries.isEmpty()
    except AnalysisException:
        entries = spark.createDataFrame([], PUBLISHED_SCHEMA)
    return entries.groupBy("run_date").agg(F.max("version").alias("version"))


def current_version(spark: SparkSession, log: str, run_date: str) -> str:
    """The published version of a run date; FileNotFoundError if there is none."""
    row = published_versions(spark, log).where(F.col("run_date") == run_date).first()
    if row is None:
        raise FileNotFoundError(f"no published version of run_date={run_date} in {log}")
    return row["version"]


JDBC_CONNECTIONS = 8


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               mode: str = "overwrite", batchsize: int = 1000) -> None:
    """Serving load; executors write their partitions in parallel
    (the reference goes through pandas on the driver)."""
    w = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).option(
        "batchsize", str(batchsize)).option("numPartitions", str(JDBC_CONNECTIONS))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def append_check_results(results: DataFrame, path: str, json_path: str | None = None) -> None:
    """Append check rows to the results table; optional JSON copy.
    A sink failure only warns, as in the reference."""
    import warnings

    try:
        results.write.mode("append").parquet(path)
        if json_path:
            results.coalesce(1).write.mode("overwrite").json(json_path)
    except Exception as exc:  # noqa: BLE001 - the reference logs and continues
        warnings.warn(f"Could not persist check results: {exc}")


def run_metadata(row_counts: DataFrame, run_date: str, published_at: datetime | None = None) -> DataFrame:
    """run_date, published_at and the curated tables with row counts."""
    ts = (published_at or datetime.now(timezone.utc)).replace(tzinfo=None)
    return row_counts.select(
        F.lit(run_date).alias("run_date"),
        F.lit(ts).cast("timestamp_ntz").alias("published_at"),
        "table_name", "row_count",
    ).orderBy("table_name")


def sql_over(spark: SparkSession, tables: dict[str, DataFrame], query: str) -> DataFrame:
    """Spark SQL over frames, ``{name}`` in the text; Spark binds them
    for the call, so no view stays registered."""
    return spark.sql(query, **tables)


def materialize(df: DataFrame, kind: str, slices: list[Column] | None = None, path: str | None = None) -> DataFrame:
    """Write a frame that several consumers read as a parquet table in the
    shared checkpoint folder and return the re-read table: the lineage is
    cut (a lost executor re-reads instead of recomputing joins), and the
    planner sees the real size of the table. The shuffle files of the write go
    as it ends. ``slices`` (conditions of which each row meets one) are written
    one after the other, so that disk holds the shuffles of one at a time."""
    from claimsmith.operators.keys import scratch_table_path, shuffles_freed

    spark = df.sparkSession
    path = path or scratch_table_path(spark, kind)
    with shuffles_freed(spark):
        for own in slices or [None]:
            (df if own is None else df.where(own)).write.mode("append").parquet(path)
    return spark.read.parquet(path)
