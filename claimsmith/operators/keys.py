"""Surrogate keys (W1) and deterministic de-duplication.

W1 replaces ``row_number() over (order by key)`` -- a window without
PARTITION BY, which Spark runs in a single task -- by a distributed
"zip with index" written with DataFrame operators:

1. range-partition on the full ordering (key, then every other column as a
   tie-break, then a row salt so even exact copies of one row are split);
   Spark samples the boundaries, so a key holding a third of the rows is
   spread over many partitions;
2. sort inside each partition and tag every row with
   ``monotonically_increasing_id()`` = (partition << 33) + position;
3. write that result as a parquet table under ``spark.checkpoint.dir``
   (the shared folder of the cluster): the partition boundaries are fixed
   once, lineage is cut, a lost executor re-reads the table instead of
   re-sampling other boundaries, and the planner gets real size statistics
   for later joins (small dimensions broadcast, large ones sort-merge);
4. read back only the tag column to get each partition's row count -- one
   row per partition, so the driver receives at most
   ``spark.sql.shuffle.partitions`` numbers -- and add the prefix offsets
   by a join with one row per partition, broadcast behind the size check.

The exact row count falls out of step 4 for free; ``bounded_broadcast``
uses it to broadcast small dimensions behind a real size check.

Rows that joins bring together for a key leave shuffle files of several times
their size. A table of many rows is therefore written slice by slice of its
key (``slice_bounds``): joins, range partitioning and sort take one slice at a
time, and its shuffle files go as it is written, so that disk holds the table
and the shuffles of one slice. Keys go on from slice to slice.

The key is dense (1..n), follows the ordering exactly (nulls first, like
the reference's ascending window), and equals the single-partition
``row_number`` whenever the ordering is total; rows that are complete copies
are interchangeable, so the output is the same multiset. Keys are bigint:
an int key would overflow past 2^31 rows.
"""

from __future__ import annotations

import contextlib
import contextvars
import math
import os
import tempfile
import threading
import uuid
import warnings

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_POS_BITS = 33
_PART_BITS = 31
_MID = "__cs_mid"
_SALT = "__cs_salt"
_SLICE = "__cs_slice"
#: Rows that joins and sorts of a written table take at a time.
SLICE_ROWS = 60_000_000
# Keys drawn per slice to find the cuts between slices.
_DRAWN = 200


def _context(spark: SparkSession):
    """The SparkContext, or None for a session without one (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions do not expose it
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session without
    one gets a fresh scratch folder (tests, laptops)."""
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc is None:
            return conf_dir
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if sc is None or not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/...) "
            "so surrogate-key tables survive executor loss"
        )
    path = tempfile.mkdtemp(prefix="claimsmith-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


#: The scratch tables of the stage that this code runs for. Threads that work
#: for a stage run in a copy of its context, so two stages of one session (two
#: run dates, say) never see each other's tables.
_SCOPE: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("claimsmith_scratch", default=None)


def scratch_table_path(spark: SparkSession, kind: str) -> str:
    """A fresh table location inside the shared checkpoint folder; recorded
    in the innermost :func:`scratch_scope`, if any."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/claimsmith/{kind}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


def _delete_path(spark: SparkSession, path: str) -> None:
    """Delete through the cluster's Hadoop FileSystem (any shared storage).
    Best effort: a session without JVM access (Spark Connect) keeps them."""
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001
        warnings.warn(f"cannot delete scratch table {path} from this session")
        return
    hp = jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(conf).delete(hp, True)


def clear_scratch(spark: SparkSession) -> None:
    """Remove every scratch table this application wrote (the checkpoint
    folder Spark hands out is already per application). Call it once the
    DataFrames of registered queries are no longer needed."""
    _delete_path(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/claimsmith")


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Delete the scratch tables created inside the block when it ends.

    Use it around work whose outputs are written before the block closes
    (a pipeline stage); DataFrames that still read a scratch table lazily
    must not escape the block.
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield paths
    finally:
        _SCOPE.reset(token)
        for p in paths:
            _delete_path(spark, p)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[int, tuple[int, str | None]] = {}
_freeing_lock = threading.Lock()


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession):
    """Inside the block Spark removes the shuffle files of a write as it ends,
    not when the driver happens to collect its garbage. For code that writes
    whatever is read again; a frame that the block leaves lazy keeps its own
    files. Blocks may be nested and entered by several threads."""
    own = id(spark)
    with _freeing_lock:
        inside, before = _freeing.get(own) or (0, spark.conf.get(_FREED, None))
        _freeing[own] = (inside + 1, before)
        spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        with _freeing_lock:
            inside, before = _freeing.pop(own)
            if inside > 1:
                _freeing[own] = (inside - 1, before)
            elif before is None:
                spark.conf.unset(_FREED)
            else:
                spark.conf.set(_FREED, before)


def slice_bounds(keys: DataFrame) -> list:
    """Where to cut the one column of ``keys`` into slices of about
    ``SLICE_ROWS`` rows; none for a table of one slice. ``keys`` should be read
    without a join: it is counted, and ``_DRAWN`` keys a slice are drawn, which
    decide the sizes of slices only, as Spark's range partitioning does."""
    rows, key = keys.count(), F.col(keys.columns[0])
    n = math.ceil(rows / SLICE_ROWS)
    if n < 2:
        return []
    drawn = sorted(r[0] for r in keys.sample(min(1.0, _DRAWN * n / rows), seed=1).where(key.isNotNull()).collect())
    return sorted({drawn[len(drawn) * k // n] for k in range(1, n)}) if drawn else []


def range_slices(key: str, bounds: list) -> list[Column]:
    """The slices of ``slice_bounds`` as conditions, in ascending order; nulls are in the first."""
    col = F.col(key)
    if not bounds:
        return [F.lit(True)]
    return [col.isNull() | (col < bounds[0]), *((col >= a) & (col < b) for a, b in zip(bounds, bounds[1:])), col >= bounds[-1]]


def hash_slices(key: str, rows: int) -> list[Column]:
    """Conditions that deal ``rows`` rows out to slices of at most about ``SLICE_ROWS`` by a hash of ``key``."""
    n = math.ceil(rows / SLICE_ROWS)
    return [F.pmod(F.xxhash64(key), F.lit(n)) == k for k in range(n)] if n > 1 else [F.lit(True)]


def _order_expr(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.asc_nulls_first()


def add_surrogate_key(
    df: DataFrame,
    sk_name: str,
    order_cols: list[str],
    num_partitions: int | None = None,
    bounds: list | None = None,
) -> DataFrame:
    """Dense bigint key 1..n in ``order_cols`` order (ties broken by the
    remaining columns). Three small jobs: range sample, table write, and a
    per-partition count over the tag column only. With ``bounds`` (of
    :func:`slice_bounds`, for the first order column) the first two are run
    for one slice after the other."""
    spark = df.sparkSession
    rest = [c for c in df.columns if c not in order_cols]
    ordering = [_order_expr(c) for c in order_cols + rest] + [F.col(_SALT).asc()]
    path = scratch_table_path(spark, sk_name)
    slices = range_slices(order_cols[0], bounds) if bounds else []
    with shuffles_freed(spark):
        if not slices:
            _write_ordered(df, ordering, num_partitions, path)
        for k, own in enumerate(slices):
            _write_ordered(df.where(own), ordering, num_partitions, f"{path}/{_SLICE}={k}")
    tagged = spark.read.parquet(path)
    pid = F.shiftright(F.col(_MID), _POS_BITS)
    if slices:
        pid = F.col(_SLICE).cast("bigint") * F.lit(1 << _PART_BITS) + pid
    pos = F.col(_MID).bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    # At most one row per partition reaches the driver.
    sizes = {r[0]: r[1] for r in tagged.groupBy(pid.alias("p")).agg((F.max(pos) + 1).alias("n")).collect()}
    offsets, running = [], 0
    for p in sorted(sizes):
        offsets.append((p, running))
        running += sizes[p]
    known = bounded_broadcast(spark.createDataFrame(offsets, "__cs_p bigint, __cs_before bigint"), len(offsets))
    out = tagged.join(known, pid == F.col("__cs_p")).select(
        (F.col("__cs_before") + pos + 1).cast("bigint").alias(sk_name), *[tagged[c] for c in df.columns])
    out.cs_row_count = running  # exact row count, known without another job
    return out


def _write_ordered(df: DataFrame, ordering: list[Column], num_partitions: int | None, path: str) -> None:
    """Range-partitioned, sorted and tagged by position, as a table at ``path``."""
    # Range partitioning samples its input in a separate job and then reads it
    # again. Shuffles below are done once for both; what follows the last of
    # them costs less twice than a cache of all columns would.
    salted = df.withColumn(_SALT, F.monotonically_increasing_id())
    # Without an explicit count AQE may merge adjacent (small) range
    # partitions; the order survives because only neighbours are merged
    # and the position tag is taken after the merged read.
    ranged = (salted.repartitionByRange(num_partitions, *ordering) if num_partitions
              else salted.repartitionByRange(*ordering))
    (
        ranged
        .sortWithinPartitions(*ordering)
        .drop(_SALT)
        .withColumn(_MID, F.monotonically_increasing_id())
        .write.parquet(path)
    )


def _broadcast_threshold(spark: SparkSession) -> int:
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


# Estimates of a value's size in bytes; strings are counted generously (ids,
# names) so that the check errs towards not broadcasting.
_FIELD_WIDTH = {"string": 48, "long": 8, "integer": 4, "double": 8, "date": 4, "boolean": 1, "timestamp": 8,
                "timestamp_ntz": 8, "short": 2, "byte": 1, "float": 4}


def _row_width(df: DataFrame) -> int:
    return 8 + sum(_FIELD_WIDTH.get(f.dataType.typeName(), 16) for f in df.schema.fields)


def bounded_broadcast(df: DataFrame, rows: int | None) -> DataFrame:
    """Mark ``df`` for broadcast only when its exact row count times its row
    width fits ``spark.sql.autoBroadcastJoinThreshold``; otherwise leave the
    join strategy to the planner (sort-merge, AQE skew handling)."""
    if rows is None:
        return df
    limit = _broadcast_threshold(df.sparkSession)
    if limit > 0 and rows * _row_width(df) <= limit:
        return F.broadcast(df)
    return df


# From this many times the broadcast threshold on, a lookup's side is hashed
# partition by partition; up to there its compressed files may still let the
# planner broadcast it.
HASHED_FROM = 16


def hashed_lookup(df: DataFrame, rows: int | None) -> DataFrame:
    """Mark ``df`` as the looked-up side of a join: broadcast when it fits
    (:func:`bounded_broadcast`); far beyond that hashed in each shuffle
    partition, so that the many rows that look up are shuffled but never
    sorted (AQE still splits skewed keys); else left to the planner."""
    marked = bounded_broadcast(df, rows)
    limit = _broadcast_threshold(df.sparkSession)
    if marked is df and rows is not None and rows * _row_width(df) > HASHED_FROM * max(limit, 0):
        return df.hint("shuffle_hash")
    return marked


def dedup_keep_smallest(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key -- the row smallest by the remaining columns
    (in column order, nulls last).

    Written as ``min(struct)`` per key so Spark aggregates partially before
    the shuffle: a key holding a third of all rows is reduced map-side
    instead of being sorted in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys).select(*df.columns)
    packed = []
    for c in rest:
        packed.append(F.col(c).isNull().alias(f"__n_{c}"))
        packed.append(F.col(c).alias(c))
    best = df.groupBy(*keys).agg(F.min(F.struct(*packed)).alias("__best"))
    return best.select(*[F.col(k) for k in keys], *[F.col(f"__best.{c}").alias(c) for c in rest]).select(*df.columns)


def group_row_number(df: DataFrame, group_cols: list[str], order_cols: list[str], name: str,
                     whole_rows: int = 0, slices: list[Column] | None = None) -> DataFrame:
    """``row_number() over (partition by group order by order_cols)`` without
    putting a large group into one task.

    Groups of up to ``whole_rows`` rows are numbered by a window, each in one
    task: one shuffle and one sort. ``df`` is written for it, ``slices`` one
    after the other, as the rows per group are counted first. The larger groups (at most one per ``whole_rows``
    rows of ``df``) are numbered by :func:`_numbered_by_key`, as all are by
    default.
    """
    if not whole_rows:
        return _numbered_by_key(df, group_cols, order_cols, name)
    from claimsmith.sources.io import materialize

    rows = materialize(df, f"{name}-rows", slices)
    large = materialize(
        rows.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("__cs_n")).where(F.col("__cs_n") > whole_rows).select(
            *[F.col(c).alias(f"__g_{c}") for c in group_cols]), f"{name}-large")
    number = F.row_number().over(Window.partitionBy(*group_cols).orderBy(
        *[_order_expr(c) for c in order_cols + [c for c in df.columns if c not in group_cols + order_cols]])).cast("bigint")
    n = large.count()
    if not n:
        return rows.withColumn(name, number)
    large = bounded_broadcast(large, n)
    cond = [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in group_cols]
    return rows.join(large, cond, "left_anti").withColumn(name, number).unionByName(
        _numbered_by_key(rows.join(large, cond, "left_semi"), group_cols, order_cols, name))


def _numbered_by_key(df: DataFrame, group_cols: list[str], order_cols: list[str], name: str) -> DataFrame:
    """A global dense key over (group, order) is range-partitioned (a hot group
    spans many partitions); each group's first key comes from a partial
    ``min`` aggregate and is joined back (AQE splits a skewed group on that
    join). Row number = global key - first key + 1.
    """
    keyed = add_surrogate_key(df, "__cs_gk", group_cols + order_cols)
    firsts = keyed.groupBy(*group_cols).agg(F.min("__cs_gk").alias("__cs_first")).select(
        *[F.col(c).alias(f"__g_{c}") for c in group_cols], "__cs_first")
    cond = [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in group_cols]
    joined = keyed.join(firsts, cond, "inner")
    return joined.select(
        *df.columns,
        (F.col("__cs_gk") - F.col("__cs_first") + 1).cast("bigint").alias(name),
    )
