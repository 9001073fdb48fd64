"""Stored layers: versions that are checked before they are published,
partition-scoped upserts, views, namespaces and verification (S5, S7, S8, S10-S14).

Paths may be on any Hadoop file system the cluster shares (HDFS, object
stores); nothing here touches a machine-local folder.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from barforge.operators.upsert import upsert

# Bronze layout: one folder per calendar month. A daily delta rewrites only
# the current month's folder; a backfill rewrites the months it touches.
def month_partition() -> dict[str, Column]:
    """``month = yyyymm`` of the row's date (an int partition column); 0 without one."""
    return {"month": F.coalesce(F.year("date") * 100 + F.month("date"), F.lit(0)).cast("int")}


def day_partition() -> dict[str, Column]:
    """``day = yyyymmdd``: a daily delta rewrites only the days it touches."""
    return {"day": F.coalesce(F.year("date") * 10000 + F.month("date") * 100 + F.dayofmonth("date"), F.lit(0)).cast("int")}


def symbol_buckets(n: int) -> dict[str, Column]:
    """``bucket = pmod(hash(symbol), n)``: combined with a date partition, a
    backfill of one symbol rewrites 1/n of each date partition it touches."""
    return {"bucket": F.pmod(F.xxhash64("symbol"), F.lit(n)).cast("int")}


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def staging_path(spark: SparkSession) -> str:
    """A fresh folder for a staged copy, inside the shared checkpoint folder
    (never inside the table being rewritten: a non-partitioned overwrite
    clears the whole table folder before writing)."""
    from barforge.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/barforge-staging/{uuid.uuid4().hex}"


# --- tables and their versions -------------------------------------------
#
# A stored table is a folder of versions and a catalog table that points to
# them: every write goes to a fresh version folder, which no reader sees, and
# is published by moving the table (or the partitions it replaces) there.

NAMESPACE = "barforge"


class TableChanged(RuntimeError):
    """Another application published the same partitions meanwhile."""


def _qualified(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def table_name(spark: SparkSession, path: str) -> str:
    """The catalog name of the table stored at ``path``: its last part and a hash of the whole."""
    full = _qualified(spark, path)
    leaf = re.sub(r"\W", "_", full.rsplit("/", 1)[-1]).lower()
    return f"{NAMESPACE}.{leaf}_{hashlib.md5(full.encode()).hexdigest()[:12]}"


def is_published(spark: SparkSession, path: str) -> bool:
    return spark.catalog.tableExists(table_name(spark, path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """A stored table exists once a version was published, or once plain
    Parquet files were committed under its path (a table that was never
    written by this module)."""
    if is_published(spark, path):
        return True
    if not path_exists(spark, path):
        return False
    fs, p = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return any(n == "_SUCCESS" or not n.startswith(("_", ".", VERSION)) for n in names)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The published rows of the table at ``path``, or its plain files if nothing was published."""
    if is_published(spark, path):
        return spark.table(table_name(spark, path))
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def _with_partitions(df: DataFrame, partitions: dict[str, Column]) -> DataFrame:
    return df.withColumns(partitions) if partitions else df


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared checkpoint folder and read back."""
    path = staging_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partition_filter(columns: Sequence[str], values: Sequence[tuple]) -> Column:
    """A literal filter for these partition values, which prunes the listing."""
    if not values:
        return F.lit(False)
    if len(columns) == 1:
        return F.col(columns[0]).isin(*[v[0] for v in values])
    first: dict = {}
    for v in values:
        first.setdefault(v[0], []).append(v[1:])
    out = None
    for v, rest in first.items():
        cond = (F.col(columns[0]) == F.lit(v)) & partition_filter(columns[1:], rest)
        out = cond if out is None else out | cond
    return out


def partition_values(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """The partitions that the rows lie in (bounded by the calendar)."""
    return [tuple(r) for r in df.select(*columns).distinct().collect()] if columns else []


VERSION = "v-"


@dataclass
class Version:
    """Rows written beside a table that no reader of the table sees yet."""
    path: str                      # of the table
    folder: str                    # of this version
    schema: StructType             # with the partition columns
    columns: list[str]             # partition columns
    values: list[tuple]            # partitions that hold rows
    replaces: list[tuple] | None   # partitions that the version stands for; None: the whole table
    figures: dict[str, int]        # rows, and NULLs per column, counted while they were written
    buckets: int = 0               # by symbol; 0: none
    written: str | None = None     # catalog name of a bucketed version until it is published

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows of this version alone."""
        if self.written:
            return spark.table(self.written)
        return spark.read.schema(self.schema).parquet(self.folder)

    def table(self, spark: SparkSession) -> DataFrame:
        """The whole table as it will be once the version is published."""
        new = self.rows(spark)
        if self.replaces is None or not table_exists(spark, self.path):
            return new
        old = read_table(spark, self.path, self.schema)
        return old.where(~partition_filter(self.columns, self.replaces)).select(*new.columns).unionByName(new)


def write_version(df: DataFrame, path: str, partitions: dict[str, Column] | None = None,
                  sort_by: Sequence[str] = ("symbol", "date"),
                  replaces: list[tuple] | None = None, buckets: int = 0) -> Version:
    """Write ``df`` as a new, unpublished version of the table at ``path``.

    With ``buckets`` the files are bucketed by symbol and sorted by
    ``sort_by``, one file per bucket and partition: a window or join by
    symbol over the table then needs no exchange (its tasks are the buckets,
    so their number is to be chosen by the table's size).

    Rows are range-partitioned (sampled bounds split hot keys) and sorted by
    partition and ``sort_by``. The row count and the NULLs of every column
    are observed in the pass that writes, after the exchange, so nothing is
    read again for them."""
    spark, partitions = df.sparkSession, partitions or {}
    pcols = list(partitions)
    out = _with_partitions(df, {k: v for k, v in partitions.items() if k not in df.columns})
    order = [*pcols, *[c for c in sort_by if c in out.columns]]
    if buckets:
        out = out.repartition(buckets, "symbol").sortWithinPartitions(*order)
    elif order:
        out = out.repartitionByRange(*order).sortWithinPartitions(*order)
    seen = Observation(f"version {uuid.uuid4().hex}")
    names = [c for c in out.columns if c not in pcols]
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"),
                      *(F.count_if(F.col(f"`{c}`").isNull()).alias(f"null {c}") for c in names))
    folder = f"{path.rstrip('/')}/{VERSION}{uuid.uuid4().hex}"
    w = out.write.partitionBy(*pcols) if pcols else out.write
    written = None
    if buckets:
        # Bucketed files can only be written through the catalog.
        written = f"{NAMESPACE}.version_{uuid.uuid4().hex}"
        ensure_namespaces(spark, [NAMESPACE])
        w.bucketBy(buckets, "symbol").sortBy(*sort_by).option("path", folder).format("parquet").saveAsTable(written)
    else:
        w.parquet(folder)
    figures = {k: int(v) for k, v in seen.get.items()}
    types = {f.name: f for f in out.schema.fields}
    schema = StructType([types[c] for c in names + pcols])
    values = partition_values(spark.read.schema(schema).parquet(folder), pcols) if figures["rows"] else []
    return Version(path, folder, schema, pcols, values, replaces, figures, buckets, written)


def _spec(columns: Sequence[str], value: tuple) -> str:
    def literal(v) -> str:
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "\\'") + "'"

    return ", ".join(f"`{c}`={literal(v)}" for c, v in zip(columns, value))


def publish(spark: SparkSession, version: Version) -> DataFrame:
    """Make a version part of its table: one catalog statement for a table
    without partitions, else one per replaced partition and one for all new
    ones. Files of older versions stay until ``remove_unused``, so a reader
    that began before goes on reading them."""
    name, pcols = table_name(spark, version.path), version.columns
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {NAMESPACE}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema.fields)
    layout = f"PARTITIONED BY ({', '.join(pcols)})" if pcols else ""
    if version.buckets:
        layout += f" CLUSTERED BY (symbol) SORTED BY (symbol, date) INTO {version.buckets} BUCKETS"
    if is_published(spark, version.path) and _buckets(spark, name) != version.buckets:
        raise ValueError(f"{version.path} is stored in {_buckets(spark, name)} buckets, not {version.buckets}")
    if not pcols:
        if is_published(spark, version.path):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{version.folder}'")
        else:
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {layout} LOCATION '{version.folder}'")
    else:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {layout} LOCATION '{version.path.rstrip('/')}'")
        kinds = {f.name: f.dataType for f in version.schema.fields}

        def parsed(text: str) -> tuple:
            parts = dict(p.split("=", 1) for p in text.split("/"))
            return tuple(int(parts[c]) if isinstance(kinds[c], (IntegerType, LongType)) else parts[c] for c in pcols)

        present = {parsed(r[0]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
        where = {v: f"{version.folder}/" + "/".join(f"{c}={x}" for c, x in zip(pcols, v)) for v in version.values}
        gone = (present if version.replaces is None else present & set(version.replaces)) - set(where)
        for v in sorted(present & set(where)):
            spark.sql(f"ALTER TABLE {name} PARTITION ({_spec(pcols, v)}) SET LOCATION '{where[v]}'")
        if fresh := sorted(set(where) - present):
            spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
                f"PARTITION ({_spec(pcols, v)}) LOCATION '{where[v]}'" for v in fresh))
        if gone:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION ({_spec(pcols, v)})" for v in sorted(gone)))
    spark.catalog.refreshTable(name)
    if version.written:
        spark.sql(f"DROP TABLE IF EXISTS {version.written}")   # external: the files stay
        version.written = None
    return spark.table(name)


def _buckets(spark: SparkSession, name: str) -> int:
    """In how many buckets a catalog table is stored."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").first()
    return int(found["data_type"]) if found else 0


def replace_table(df: DataFrame, path: str, partitions: dict[str, Column] | None = None,
                  sort_by: Sequence[str] = ("symbol", "date"), buckets: int = 0) -> DataFrame:
    """Write and publish the whole table at ``path``."""
    return publish(df.sparkSession, write_version(df, path, partitions, sort_by, buckets=buckets))


def remove_unused(spark: SparkSession, path: str, older_than: dt.timedelta = dt.timedelta(days=7)) -> list[str]:
    """Delete version folders that no published partition lies in and that
    are old enough for every reader and unpublished writer to have ended.
    Returns their paths."""
    if not is_published(spark, path):
        return []
    used = {f.split(f"/{VERSION}", 1)[1].split("/", 1)[0] for f in read_table(spark, path).inputFiles() if f"/{VERSION}" in f}
    fs, p = _fs(spark, path)
    before = (dt.datetime.now() - older_than).timestamp() * 1000
    old = [s.getPath().toString() for s in fs.listStatus(p)
           if s.getPath().getName().startswith(VERSION) and s.getModificationTime() < before
           and s.getPath().getName()[len(VERSION):] not in used]
    for folder in old:
        delete_path(spark, folder)
    return old


@dataclass
class Change:
    """What an upsert will change: rows that differ from the stored ones."""
    rows: DataFrame
    source: DataFrame              # de-duplicated, written
    path: str
    keys: Sequence[str]
    partitions: dict[str, Column]
    touched: list[tuple]
    earliest: dt.date | None
    seen: list[str] | None         # the files that the plan has read; None: no table yet


def _target(spark: SparkSession, path: str, partitions: dict[str, Column], touched: list[tuple]) -> DataFrame | None:
    if not table_exists(spark, path):
        return None
    target = read_table(spark, path)
    if partitions and is_published(spark, path):
        return target.where(partition_filter(list(partitions), touched))
    return _with_partitions(target, {k: v for k, v in partitions.items() if k not in target.columns})


def plan_upsert(spark: SparkSession, source: DataFrame, path: str,
                keys: Sequence[str] = ("symbol", "date"),
                partitions: dict[str, Column] | None = None,
                order: Sequence[str] | None = None) -> Change:
    """De-duplicate ``source`` once (written), read only the partitions it
    touches (literal values, bounded by the calendar), and keep the rows
    that are new or differ from the stored row: a feed that sends old rows
    again changes nothing."""
    from barforge.operators.staging import DEDUP_ORDER
    from barforge.operators.upsert import dedup_by_key

    partitions = partitions or {}
    src = materialise(_with_partitions(
        dedup_by_key(source, keys, DEDUP_ORDER if order is None else order), partitions))
    return _plan(spark, src, path, keys, partitions)


def _plan(spark: SparkSession, src: DataFrame, path: str, keys: Sequence[str], partitions: dict[str, Column]) -> Change:
    pcols, rows, seen = list(partitions), src, None
    target = _target(spark, path, partitions, partition_values(src, pcols))
    if target is not None:
        seen = sorted(target.inputFiles())
        same = None
        t = target.select(*[F.col(c).alias(f"_t_{c}") for c in src.columns])
        for c in src.columns:
            eq = F.col(c).eqNullSafe(F.col(f"_t_{c}"))
            same = eq if same is None else same & eq
        rows = materialise(src.join(t, same, "left_anti"))
    earliest = rows.agg(F.min("date")).first()[0] if "date" in rows.columns else None
    return Change(rows, src, path, keys, partitions, partition_values(rows, pcols), earliest, seen)


def apply_upsert(spark: SparkSession, change: Change, attempts: int = 3,
                 before_publish: Callable[[Change], None] | None = None) -> DataFrame:
    """Merge a planned change into a new version of the touched partitions
    and publish it: others are neither read nor written. Stored rows whose
    key holds a NULL match nothing and stay.

    If the files that the plan read are no longer the published ones, another
    application was faster: the merge is planned again on what it published.
    ``before_publish`` sees every change that is about to be published."""
    for _ in range(attempts):
        if change.seen is not None and change.rows.isEmpty():
            return read_table(spark, change.path)
        target = _target(spark, change.path, change.partitions, change.touched)
        merged = change.rows if target is None else upsert(
            target, change.rows.select(*target.columns), change.keys, order=None)
        whole = not change.partitions or not is_published(spark, change.path)
        version = write_version(merged, change.path, change.partitions, change.keys, None if whole else change.touched)
        now = _target(spark, change.path, change.partitions, partition_values(change.source, list(change.partitions)))
        if (None if now is None else sorted(now.inputFiles())) == change.seen:
            if before_publish is not None:
                before_publish(change)
            return publish(spark, version)
        change = _plan(spark, change.source, change.path, change.keys, change.partitions)
    raise TableChanged(f"{change.path}: published by another application {attempts} times during this upsert")


def upsert_table(spark: SparkSession, source: DataFrame, path: str,
                 keys: Sequence[str] = ("symbol", "date"),
                 partitions: dict[str, Column] | None = None,
                 order: Sequence[str] | None = None) -> DataFrame:
    """MERGE ``source`` into the table at ``path`` on ``keys`` (S7 first
    load, S8 later): ``plan_upsert`` and ``apply_upsert`` in one."""
    return apply_upsert(spark, plan_upsert(spark, source, path, keys, partitions, order))


def partition_floor(columns: list[str], since: dt.date) -> Column | None:
    """A filter on our date-derived partition columns (``month`` = yyyymm,
    ``day`` = yyyymmdd) that keeps every partition holding dates >=
    ``since``; Spark prunes the others from the file listing."""
    cond = None
    if "month" in columns:
        cond = F.col("month") >= F.lit(since.year * 100 + since.month)
    if "day" in columns:
        d = F.col("day") >= F.lit(since.year * 10000 + since.month * 100 + since.day)
        cond = d if cond is None else cond & d
    return cond


def partition_ceiling(columns: list[str], before: dt.date) -> Column | None:
    """The mirror of ``partition_floor``: partitions holding dates < ``before``."""
    cond = None
    if "month" in columns:
        cond = F.col("month") <= F.lit(before.year * 100 + before.month)
    if "day" in columns:
        d = F.col("day") <= F.lit(before.year * 10000 + before.month * 100 + before.day)
        cond = d if cond is None else cond & d
    return cond


def read_range(spark: SparkSession, path: str, since: dt.date | None = None,
               before: dt.date | None = None, schema=None) -> DataFrame:
    """Rows of a date-partitioned table with ``since <= date < before``,
    reading only the partitions that can hold them. ``schema``: for tables
    that may hold no rows."""
    df = read_table(spark, path, schema)
    if since is not None:
        floor = partition_floor(df.columns, since)
        df = (df.where(floor) if floor is not None else df).where(F.col("date") >= F.lit(since))
    if before is not None:
        ceil = partition_ceiling(df.columns, before)
        df = (df.where(ceil) if ceil is not None else df).where(F.col("date") < F.lit(before))
    return df


def replace_changed(spark: SparkSession, path: str, fresh: DataFrame, bounds: DataFrame,
                    partitions: dict[str, Column], sort_by: Sequence[str] = ("symbol", "date"),
                    buckets: int = 0) -> Version:
    """A version in which the rows of every symbol of ``bounds`` from its
    ``start`` on are ``fresh`` (which holds only such rows); all other rows
    of the partitions that hold a fresh or a replaced row are copied as they
    are, and other partitions are not touched."""
    pcols = list(partitions)
    fresh = materialise(_with_partitions(fresh, partitions))
    old = read_table(spark, path, fresh.schema).select(*fresh.columns)
    met = old.join(bounds.select("symbol", "start"), "symbol", "left").select(*fresh.columns, "start")
    replaced = F.coalesce(F.col("date") >= F.col("start"), F.lit(False))
    since = bounds.agg(F.min("start")).first()[0]
    floor = partition_floor(pcols, since) if since is not None else None
    stale = (met.where(floor) if floor is not None else met).where(replaced)
    touched = sorted({*partition_values(fresh, pcols), *partition_values(stale, pcols)})
    kept = met.where(partition_filter(pcols, touched)).where(~replaced).drop("start")
    return write_version(kept.unionByName(fresh), path, partitions, sort_by, touched, buckets)


def layer_name(custom: str | None, default: str) -> str:
    """Namespace of a layer: the custom name verbatim (trimmed), else the
    default (S12)."""
    return default if custom is None else custom.strip()


def ensure_namespaces(spark: SparkSession, names: Sequence[str]) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` for every layer namespace."""
    for n in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{n}`")


def create_view(spark: SparkSession, name: str, sql: str) -> str:
    """A persistent view ``namespace.name`` over SQL text (S5, S10): it is
    kept in the catalog and read by every session."""
    namespace, leaf = name.split(".")
    ensure_namespaces(spark, [namespace])
    spark.sql(f"CREATE OR REPLACE VIEW `{namespace}`.`{leaf}` AS {sql}")
    return name


def table_sql(spark: SparkSession, path: str) -> str:
    """How SQL text names the table at ``path``."""
    return table_name(spark, path) if is_published(spark, path) else f"parquet.`{_qualified(spark, path)}`"


def register_tables(spark: SparkSession, tables: dict[str, str], namespace: str) -> list[str]:
    """Expose stored layers as ``namespace.name`` (S11, S12): views over the
    published tables, which follow every later version."""
    return [create_view(spark, f"{namespace}.{name}", f"SELECT * FROM {table_sql(spark, path)}")
            for name, path in tables.items()]


def register_layer(spark: SparkSession, df: DataFrame, name: str) -> None:
    """Expose a lazy layer under a name in this session only."""
    df.createOrReplaceTempView(name)


def refresh(spark: SparkSession, path: str) -> bool:
    """Drop cached file listings after a write (S13). A failure only warns,
    as in the reference."""
    try:
        spark.catalog.refreshByPath(path)
        return True
    except Exception as e:  # noqa: BLE001
        import warnings
        warnings.warn(f"refresh of {path} failed: {e}")
        return False


def verify_layers(spark: SparkSession, expected: dict[str, str]) -> DataFrame:
    """Which expected stored layers exist (S14): one row per name with its
    path and an ``exists`` flag, as a DataFrame."""
    rows = [(name, path, table_exists(spark, path)) for name, path in expected.items()]
    return spark.createDataFrame(rows, "name string, path string, exists boolean")
