"""Stage runners B10-B12: raw CSV -> staging -> curated -> checks.

Every stage reads its inputs from the tables the previous stage wrote and
writes its outputs as parquet partitioned by ``run_date`` (dynamic partition
overwrite: re-running a date replaces only that date). Writing between
stages cuts lineage, so a lost executor recomputes at most one stage, and
no stage evaluates another stage's lineage again (the reference recomputes
the claim events three times).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession

from claimsmith.functions.calendar import date_key
from claimsmith.operators import clean as CL
from claimsmith.operators import quality as Q
from claimsmith.operators import star as B
from claimsmith.operators import synthesize as D
from claimsmith.operators.analytics import table_row_counts
from claimsmith.operators.keys import _delete_path as delete_path
from claimsmith.operators.keys import scratch_scope, slice_bounds
from claimsmith.sources import io

# The reference's source contract.
SOURCE_COLUMNS = {
    "providers": ["provider_id", "provider_name", "provider_type", "region_id"],
    "claims": ["provider_id", "region_id", "treatment_category", "claim_month", "claim_count", "total_billed",
               "total_reimbursed", "claim_status"],
    "prescriptions": ["provider_id", "region_id", "treatment_category", "claim_month", "prescription_count",
                      "total_quantity"],
    "regions": ["region_id", "region_name", "population_group"],
}
STAGING_CLEAN = ["stg_providers", "stg_regions", "stg_claims_agg", "stg_prescriptions_agg"]
STAGING_EVENTS = ["stg_claims_events", "stg_prescriptions_events", "stg_patients", "stg_visits_events"]
DIMENSIONS = ["dim_region", "dim_provider", "dim_treatment", "dim_patient", "dim_date"]
FACTS = ["fact_claims", "fact_prescriptions", "fact_visits", "fact_reimbursements"]


@dataclass
class PipelineConfig:
    root: str                                  # shared storage root
    run_date: str
    seed: int = D.DEFAULT_SEED
    default_status: str = CL.DEFAULT_CLAIM_STATUS
    visit_threshold: int = D.DEFAULT_VISIT_THRESHOLD
    allowed_status: tuple[str, ...] = Q.ALLOWED_CLAIM_STATUS
    pandas_missing_tokens: bool = True         # null 'NA', 'null', ... like the reference's ingest
    fail_on_error: bool = False                # the reference records FAILs and goes on
    sources: dict[str, dict] = field(default_factory=dict)
    version: str | None = None                 # set: the curated tables of this version, published or not

    @property
    def raw_root(self) -> str:
        return f"{self.root}/raw"

    @property
    def staging_root(self) -> str:
        return f"{self.root}/staging"

    @property
    def curated_root(self) -> str:
        return f"{self.root}/curated" if self.version is None else f"{self.root}/curated_versions/{self.version}"

    @property
    def publication_log(self) -> str:
        return f"{self.root}/metadata/published_versions"

    @property
    def quality_root(self) -> str:
        return f"{self.root}/quality"


def _read(spark: SparkSession, root: str, names: list[str], run_date: str) -> dict[str, DataFrame]:
    return {n: io.read_run_partition(spark, root, n, run_date) for n in names}


MAX_CONCURRENT_JOBS = 4


def run_concurrently(tasks: dict[str, Callable[[], object]], workers: int = MAX_CONCURRENT_JOBS) -> dict:
    """Submit independent Spark jobs from driver threads (Spark schedules
    jobs of one application concurrently); the first failure is raised."""
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(workers, len(tasks))) as pool:
        # Each task sees the scratch scope of its caller.
        futures = {k: pool.submit(copy_context().run, f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}


def _write_all(frames: dict[str, DataFrame | Callable[[], DataFrame]], root: str, run_date: str) -> None:
    """Build (when given a builder) and write each table; tables in parallel."""
    def task(name, df):
        return lambda: io.write_run_partition(df() if callable(df) else df, root, name, run_date)

    run_concurrently({name: task(name, df) for name, df in frames.items()})


def ingest(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Every source (primary or fallback) to a raw CSV snapshot."""
    srcs = {n: dict(c, required=c.get("required", SOURCE_COLUMNS[n])) for n, c in cfg.sources.items()}
    records = io.ingest_sources(spark, srcs, cfg.raw_root, cfg.run_date)
    io.write_manifest(records, f"{cfg.raw_root}/{cfg.run_date}/_manifest")
    return records


def stage_clean(spark: SparkSession, cfg: PipelineConfig) -> None:
    """C1-C4 over the raw snapshot of the run date. What cleaning changes or
    drops is counted per rule while the tables are written (no other scan) and
    kept as ``<root>/quality/rejected_values``."""
    def source(n: str):
        return lambda: io.read_csv(spark, f"{cfg.raw_root}/{cfg.run_date}/{n}", cfg.pandas_missing_tokens, keep_empty=True)

    raw = run_concurrently({n: source(n) for n in SOURCE_COLUMNS})
    for n, df in raw.items():
        io.validate_columns(df, SOURCE_COLUMNS[n])
    seen = {n: Observation(f"rejects_{n}") for n in ("claims", "prescriptions")}
    raw |= {n: raw[n].observe(seen[n], *CL.reject_counts(n)) for n in seen}
    _write_all({
        "stg_providers": CL.clean_providers(raw["providers"]),
        "stg_regions": CL.clean_regions(raw["regions"]),
        "stg_claims_agg": CL.clean_claims_agg(raw["claims"], cfg.default_status),
        "stg_prescriptions_agg": CL.clean_prescriptions_agg(raw["prescriptions"]),
    }, cfg.staging_root, cfg.run_date)
    rows = [(n, column, rule, int(seen[n].get[f"{column}:{rule}"])) for n in seen for column, rule in CL.reject_rules(n)]
    rejects = spark.createDataFrame(rows, "source_name string, column_name string, rule string, rows bigint").coalesce(1)
    io.write_run_partition(rejects, cfg.quality_root, "rejected_values", cfg.run_date)


def synthesize_events(spark: SparkSession, cfg: PipelineConfig) -> None:
    """D9-D13; claim events are written first and re-read by patients/visits."""
    stg = _read(spark, cfg.staging_root, STAGING_CLEAN, cfg.run_date)
    _write_all({
        "stg_claims_events": lambda: D.synthesize_claim_events(stg["stg_claims_agg"], cfg.seed),
        "stg_prescriptions_events": lambda: D.synthesize_prescription_events(stg["stg_prescriptions_agg"],
                                                                             cfg.seed),
    }, cfg.staging_root, cfg.run_date)
    ev = _read(spark, cfg.staging_root, ["stg_claims_events", "stg_prescriptions_events"], cfg.run_date)
    _write_all({
        "stg_patients": D.synthesize_patients(ev["stg_claims_events"], ev["stg_prescriptions_events"],
                                              stg["stg_providers"]),
        "stg_visits_events": D.synthesize_visits(ev["stg_claims_events"], stg["stg_providers"], cfg.seed,
                                                 cfg.visit_threshold),
    }, cfg.staging_root, cfg.run_date)


def build_dimensions(spark: SparkSession, cfg: PipelineConfig) -> None:
    stg = _read(spark, cfg.staging_root, STAGING_CLEAN + STAGING_EVENTS, cfg.run_date)
    region = B.dim_region(stg["stg_regions"])  # keyed once, used by three tables
    _write_all({
        "dim_region": region,
        "dim_provider": lambda: B.dim_provider(stg["stg_providers"], region),
        "dim_treatment": lambda: B.dim_treatment(stg["stg_claims_events"], stg["stg_prescriptions_events"]),
        "dim_patient": lambda: B.dim_patient(stg["stg_patients"], region),
        "dim_date": lambda: B.dim_date(stg["stg_claims_events"], stg["stg_prescriptions_events"],
                                       stg["stg_visits_events"]),
    }, cfg.curated_root, cfg.run_date)


def build_facts(spark: SparkSession, cfg: PipelineConfig) -> None:
    stg = _read(spark, cfg.staging_root, STAGING_EVENTS, cfg.run_date)
    dims = _read(spark, cfg.curated_root, DIMENSIONS, cfg.run_date)
    claims, rx = stg["stg_claims_events"], stg["stg_prescriptions_events"]
    _write_all({
        "fact_claims": lambda: B.fact_claims(claims, dims["dim_patient"], dims["dim_provider"], dims["dim_treatment"],
                                             slice_bounds(claims.select("claim_id"))),
        "fact_prescriptions": lambda: B.fact_prescriptions(rx, dims["dim_patient"], dims["dim_provider"], dims["dim_treatment"],
                                                           slice_bounds(rx.select("prescription_id"))),
        "fact_visits": lambda: B.fact_visits(stg["stg_visits_events"], dims["dim_patient"], dims["dim_provider"]),
        "fact_reimbursements": lambda: B.fact_reimbursements(
            B.claim_lines(claims, dims["dim_provider"], dims["dim_treatment"]), slice_bounds(claims.select(date_key("claim_date")))),
    }, cfg.curated_root, cfg.run_date)


def quality_checks(spark: SparkSession, cfg: PipelineConfig, run_id: str | None = None) -> DataFrame:
    """Q1-Q11 in one job. The rows (eleven) are computed once: they are
    appended to the quality table with a JSON copy (S11), gated and returned,
    whatever that table holds from other runs."""
    curated = _read(spark, cfg.curated_root, DIMENSIONS + FACTS, cfg.run_date)
    staging = _read(spark, cfg.staging_root, ["stg_claims_events", "stg_prescriptions_events"], cfg.run_date)
    now = datetime.now(timezone.utc)
    run_id = run_id or f"{cfg.run_date}_quality_{now:%Y%m%dT%H%M%S%f}Z"
    rows = Q.with_run_columns(Q.all_check_rows(curated, staging, cfg.allowed_status), run_id, cfg.run_date, now)
    results = spark.createDataFrame(rows.collect(), rows.schema)
    io.append_check_results(results, f"{cfg.quality_root}/check_results",
                            f"{cfg.quality_root}/json/run_id={run_id}")
    if cfg.fail_on_error:
        Q.raise_on_failures(results)
    return results


def audited_run(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """B12 with its audit before publication: the curated tables are built as
    a new version, checked, and only then made current by one log entry.

    With ``fail_on_error`` a failing check raises and the former version stays
    current; without it, the results are recorded and the version is
    published, as in the reference. Returns the check rows. A rerun of a date
    publishes another version; :func:`drop_version` removes an old one."""
    staged = replace(cfg, version=io.new_version())
    run_transformations(spark, staged, "curated")
    results = quality_checks(spark, staged)
    io.publish_version(spark, cfg.publication_log, cfg.run_date, staged.version)
    return results


def published(spark: SparkSession, cfg: PipelineConfig) -> PipelineConfig:
    """The configuration that reads the current version of the run date, for
    the serving load, metadata and row counts. What is read with it stays on
    that version, also when another one is published meanwhile."""
    return replace(cfg, version=io.current_version(spark, cfg.publication_log, cfg.run_date))


def read_published(spark: SparkSession, cfg: PipelineConfig, table: str) -> DataFrame:
    """A curated table of the run date's current version."""
    return io.read_run_partition(spark, published(spark, cfg).curated_root, table, cfg.run_date)


def drop_version(spark: SparkSession, cfg: PipelineConfig, version: str) -> None:
    """Delete the tables of a version that is not current."""
    if published(spark, cfg).version == version:
        raise ValueError(f"{version} is the current version of run_date={cfg.run_date}")
    delete_path(spark, replace(cfg, version=version).curated_root)


def publish_metadata(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Run date, publication time and the curated tables with their row
    counts, written as one small JSON table under ``<root>/metadata``."""
    meta = io.run_metadata(curated_row_counts(spark, cfg), cfg.run_date)
    meta.coalesce(1).write.mode("overwrite").json(f"{cfg.root}/metadata/run_date={cfg.run_date}")
    return spark.read.schema(meta.schema).json(f"{cfg.root}/metadata/run_date={cfg.run_date}")


def load_serving(spark: SparkSession, cfg: PipelineConfig, url: str, schema: str = "curated",
                 properties: dict[str, str] | None = None) -> DataFrame:
    """Replace each curated table of the run date in a JDBC database;
    executors write their partitions in parallel (batches of 1000 rows, at
    most ``io.JDBC_CONNECTIONS`` connections per table). Returns the row
    counts (table_name, row_count)."""
    tables = _read(spark, cfg.curated_root, DIMENSIONS + FACTS, cfg.run_date)
    run_concurrently({name: (lambda name=name, df=df: io.write_jdbc(df, url, f"{schema}.{name}", properties))
                      for name, df in tables.items()})
    return table_row_counts(tables)


def curated_row_counts(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Rows per curated table of the run date, one job."""
    return table_row_counts(_read(spark, cfg.curated_root, DIMENSIONS + FACTS, cfg.run_date))


def _scoped(stage: Callable[[SparkSession, PipelineConfig], None]) -> Callable[[SparkSession, PipelineConfig], None]:
    """Run a stage and drop its scratch tables once its outputs are written."""
    def run(spark: SparkSession, cfg: PipelineConfig) -> None:
        with scratch_scope(spark):
            stage(spark, cfg)

    run.__name__ = stage.__name__
    run.__doc__ = stage.__doc__
    return run


stage_clean = _scoped(stage_clean)
synthesize_events = _scoped(synthesize_events)
build_dimensions = _scoped(build_dimensions)
build_facts = _scoped(build_facts)

STAGES = {
    "stage_clean": stage_clean,
    "synthesize_events": synthesize_events,
    "build_dimensions": build_dimensions,
    "build_facts": build_facts,
}


def run_transformations(spark: SparkSession, cfg: PipelineConfig, layer: str = "all") -> None:
    """Layer in {staging, curated, all}."""
    if layer not in ("staging", "curated", "all"):
        raise ValueError(f"unknown layer {layer!r}")
    if layer in ("staging", "all"):
        stage_clean(spark, cfg)
        synthesize_events(spark, cfg)
    if layer in ("curated", "all"):
        build_dimensions(spark, cfg)
        build_facts(spark, cfg)
