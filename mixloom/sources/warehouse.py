"""Ingestion into loaded tables: batches are checked, merged by key, and committed by a folder switch.

A loaded table is a folder of batches, ``<target>/<table>/batch-000001`` and so on. Ingesting a batch adds
the rows whose key is not there yet; what is loaded is never rewritten, so the cost is that of the batch
and of one join to the loaded keys. The new rows are written beside the table and get their name by a
rename when they are complete; a run that fails leaves a folder that no reader sees. A table waits until
its parents are committed, so a loaded row's parents are always loaded; tables that do not wait for each
other run side by side.

Rows that break the contract do not get in. They are kept, as they were read, in
``<target>/_quarantine/<table>/batch-...`` with the first reason that holds:

``bad_value``    a cell that does not fit its type, or too many or too few cells
``bad_date``     a date in no known layout
``null_key``     a key column without a value
``orphan:<c>``   a value of foreign key ``c`` that its parent table does not have
"""

from __future__ import annotations

import uuid
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixloom.functions.dates import parse_date
from mixloom.operators.keys import dedupe_on_key
from mixloom.sources.readers import CORRUPT, read_csv
from mixloom.sources.schemas import TABLES, TableSpec
from mixloom.sources.staging import stage, staging_root

REASON = "_reason"
QUARANTINE = "_quarantine"
BATCH = "batch-"
AT_ONCE = 4  # tables that are merged side by side
HASH_BYTES = 64  # of a row in a hash table, without its columns


@dataclass(frozen=True)
class Loaded:
    """What became of the rows of one batch file."""

    table: str
    read: int
    inserted: int
    present: int
    duplicate: int
    quarantined: dict[str, int]
    missing: tuple[str, ...] = ()


class Warehouse:
    """Loaded tables below one folder."""

    def __init__(self, spark: SparkSession, target: str, tables: dict[str, TableSpec] | None = None):
        self.spark, self.target = spark, target.rstrip("/")
        self.tables = TABLES if tables is None else tables

    def table(self, name: str) -> DataFrame:
        """The loaded rows; an empty table before the first batch."""
        return self._read(f"{self.target}/{name}", self.tables[name].schema)

    def quarantine(self, name: str) -> DataFrame:
        """The rejected rows as they were read, with the reason."""
        return self._read(f"{self.target}/{QUARANTINE}/{name}", _raw_schema(self.tables[name]).add(REASON, T.StringType()))

    def ingest(self, folder: str, names=None) -> list[Loaded]:
        """Merge ``folder/<NAME>.csv`` of every named table (all), parents before children.

        A file without one of the declared columns is skipped and reported, as is a missing file.
        """
        wanted = list(self.tables) if names is None else list(names)
        staging_root(self.spark)  # chosen once, before the threads ask for it
        merges: dict[str, Future] = {}

        def merge(name: str, before: list[Future]) -> Loaded:
            # They were handed in earlier, so the first of the waiting tables can always go on.
            for other in before:
                other.result()
            return self._merge(self.tables[name], f"{folder.rstrip('/')}/{name.upper()}.csv")

        with ThreadPoolExecutor(AT_ONCE) as pool:
            for name in [n for n in self.tables if n in wanted]:
                kin = [m for n, m in merges.items() if n in self.tables[name].parents.values() or name in self.tables[n].parents.values()]
                merges[name] = pool.submit(inheritable_thread_target(self.spark)(merge), name, kin)
        return [m.result() for m in merges.values()]

    def _merge(self, spec: TableSpec, path: str) -> Loaded:
        missing = self._missing_columns(spec, path)
        if missing:
            return Loaded(spec.name, 0, 0, 0, 0, {}, missing)
        rows = stage(self._classified(spec, path))
        counted = rows.groupBy(REASON).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per reason
        reasons = {r[REASON]: r["n"] for r in counted}
        good = rows.filter(F.col(REASON).isNull()).select(*[F.col(_typed(spec, c)).alias(c) for c in spec.schema.names])
        rest = [c for c in spec.schema.names if c not in spec.key]
        keys = list(spec.key)
        unique = dedupe_on_key(good, keys, rest or keys).select(*spec.schema.names)
        folder = f"{self.target}/{spec.name}"
        if self._batches(folder):
            loaded = self._sorted_if_large(self.table(spec.name).select(*keys))
            # Keys alone tell whether a batch has anything new; rows are only dealt by key if it has.
            known = good.select(*keys).distinct().join(loaded.withColumn("_loaded", F.lit(True)), keys, "left")
            n_unique, present = known.agg(F.count(F.lit(1)), F.count("_loaded")).first()
            inserted = self._commit(unique.join(loaded, keys, "left_anti"), folder) if n_unique > present else 0
        else:
            inserted, present = self._commit(unique, folder), 0
        bad = {k: n for k, n in reasons.items() if k is not None}
        if bad:
            raw = [c for c in _raw_schema(spec).names]
            rejected = rows.filter(F.col(REASON).isNotNull()).select(*raw, REASON)
            # A batch that is read again is not put aside again.
            known = self._sorted_if_large(self.quarantine(spec.name).select(*raw, REASON))
            again = reduce(lambda a, b: a & b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*raw, REASON)])
            self._commit(rejected.alias("a").join(known.distinct().alias("b"), again, "left_anti"), f"{self.target}/{QUARANTINE}/{spec.name}")
        n_good = reasons.get(None, 0)
        return Loaded(spec.name, n_good + sum(bad.values()), inserted, present, n_good - inserted - present, bad)

    def _classified(self, spec: TableSpec, path: str) -> DataFrame:
        """Raw columns, dates (``_v_``) and the reason why a row can't be loaded."""
        raw = read_csv(self.spark, path, _raw_schema(spec, corrupt=False), keep_corrupt=True)
        typed = raw.withColumns({_typed(spec, c): parse_date(c) for c in spec.date_columns}) if spec.date_columns else raw
        reason = F.when(F.col(CORRUPT).isNotNull(), "bad_value")
        for c in spec.date_columns:
            reason = reason.when(F.col(c).isNotNull() & F.col(f"_v_{c}").isNull(), "bad_date")
        for c in spec.key:
            reason = reason.when(F.col(_typed(spec, c)).isNull(), "null_key")
        for at, (column, parent) in enumerate(spec.parents.items()):
            (key,) = self.tables[parent].key
            child = _typed(spec, column)
            keys = self.table(parent).select(F.col(key).alias(child), F.lit(True).alias(f"_has{at}"))
            # A parent has one row per key, so no row is multiplied.
            typed = typed.join(self._sorted_if_large(keys), child, "left")
            reason = reason.when(F.col(child).isNotNull() & F.col(f"_has{at}").isNull(), f"orphan:{column}")
        return typed.select(*_raw_schema(spec).names, *[_typed(spec, c) for c in spec.date_columns], reason.alias(REASON))

    def _sorted_if_large(self, rows: DataFrame) -> DataFrame:
        """``rows`` as the right side of a join that must not be broadcast if they are large.

        The driver builds the hash tables that are broadcast. Catalyst chooses by a share of the compressed files, of
        which they can be a hundredfold; so the rows and their text are measured, against the limit of the session.
        """
        text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in rows.schema if isinstance(f.dataType, T.StringType)]
        n, length = rows.agg(F.count(F.lit(1)), F.sum(reduce(lambda a, b: a + b, text, F.lit(0).cast("long")))).first()
        # A hash table holds a row as key and as value, and a null-safe key tells of every column whether it is null.
        size = n * (HASH_BYTES + 3 * 8 * len(rows.columns)) + 2 * (length or 0)
        limit = self.spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        return rows.hint("merge") if size > limit else rows

    def _missing_columns(self, spec: TableSpec, path: str) -> tuple[str, ...]:
        where = self._path(path)
        if not where.getFileSystem(self._conf()).exists(where):
            return tuple(spec.schema.names)
        header = self.spark.read.option("header", True).csv(path).columns
        return tuple(c for c in spec.schema.names if c not in header)

    def _commit(self, rows: DataFrame, folder: str) -> int:
        """Write the rows as the next batch of ``folder``; their number. Nothing is left of an empty batch."""
        parked = f"{self.target}/_parked-{uuid.uuid4().hex}"
        rows.write.parquet(parked)
        n = self.spark.read.schema(rows.schema).parquet(parked).count()
        source = self._path(parked)
        files = source.getFileSystem(self._conf())
        if n:
            files.mkdirs(self._path(folder))
            number = 1 + max([int(b.removeprefix(BATCH)) for b in self._batches(folder)], default=0)
            if not files.rename(source, self._path(f"{folder}/{BATCH}{number:06d}")):
                raise OSError(f"{parked} could not be renamed to a batch of {folder}")
        else:
            files.delete(source, True)
        return n

    def _read(self, folder: str, schema: T.StructType) -> DataFrame:
        paths = [f"{folder}/{b}" for b in self._batches(folder)]
        if not paths:
            # Known to be empty when a query is planned, so joins to it cost nothing.
            return self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).filter(F.lit(False))
        return self.spark.read.schema(schema).parquet(*paths)

    def _batches(self, folder: str) -> list[str]:
        where = self._path(folder)
        files = where.getFileSystem(self._conf())
        if not files.exists(where):
            return []
        return sorted(s.getPath().getName() for s in files.listStatus(where) if s.getPath().getName().startswith(BATCH))

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _conf(self):
        return self.spark._jsc.hadoopConfiguration()


def _typed(spec: TableSpec, column: str) -> str:
    """The column of classified rows that holds the value; only dates have another than the one that was read."""
    return f"_v_{column}" if column in spec.date_columns else column


def _raw_schema(spec: TableSpec, corrupt: bool = True) -> T.StructType:
    """Columns as they are read: dates as text, with the text of rows that do not fit."""
    fields = [T.StructField(f.name, T.StringType() if f.name in spec.date_columns else f.dataType) for f in spec.schema]
    return T.StructType([*fields, *([T.StructField(CORRUPT, T.StringType())] if corrupt else [])])


def report(spark: SparkSession, loaded: list[Loaded]) -> DataFrame:
    """One row per table and outcome (inserted, present, duplicate, or the reason) with the number of rows."""
    rows = []
    for x in loaded:
        outcomes = {"inserted": x.inserted, "present": x.present, "duplicate": x.duplicate, **x.quarantined}
        outcomes |= {f"missing:{c}": 0 for c in x.missing}
        rows += [(x.table, k, n) for k, n in outcomes.items()]
    return spark.createDataFrame(rows, "table_name string, outcome string, n_rows long")
