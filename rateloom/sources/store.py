"""Tables that are stored once and found again, and results that appear all at once.

A store is a folder that all executors share:

* ``data/``: a folder per stored table, named by a random part; never changed once written,
* ``claims/``: an empty file per name that can be published a single time, named by a hash of it,
* ``manifest/``: a folder per publication with one Parquet row that names the tables, their schemas, what they were made of
  (the fingerprint) and a few facts found on the way, such as the latest earned date.

Tables are written first, the row last. Spark moves the row's single file into place when its job commits, so a publication
is there as a whole or not at all; a run that dies half-way leaves data that no row names, and what was published before it
stays readable. Several writers don't disturb each other; of those that publish one name a single time, the one that creates
the claim goes on, whatever their clocks say. ``clean`` removes data and claims that no row names.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = ("entry string, name string, fingerprint string, published timestamp, format string, tables map<string,string>, "
             "schemas map<string,string>, facts map<string,string>")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; one of our own only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "/tmp/checkpoints"


_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What a query that ends in here has shuffled is removed from the executors' disks when it ends.

    Otherwise it stays until the driver collects its garbage, beside what later steps shuffle.
    """
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)


def fingerprint(**parts: object) -> str:
    """A hash of everything a stored table depends on; parts are written as JSON, in the order of their names."""
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def _numbered(plan: str) -> str:
    """The plan's text without the numbers that Spark gives to expressions and plans of a session."""
    numbers: dict[str, str] = {}
    plan = re.sub(r"#(\d+)L?", lambda m: "#" + numbers.setdefault(m[1], str(len(numbers))), plan)
    return re.sub(r"plan_id=\d+|\[id=#?\d+\]|LogicalRDD.*", "", plan)


def source_state(df: DataFrame, version: str | None = None) -> dict | None:
    """What the rows of a table depend on, for a fingerprint: its plan, and the files it reads with their sizes and times.

    For a table that is not read from files the caller has to name a ``version``; without one there is no way to tell
    whether it changed, and None is returned.
    """
    plan = _numbered(df._jdf.queryExecution().optimizedPlan().treeString(True, False, 100_000, False, False))
    state = {"schema": df.schema.json(), "plan": hashlib.sha256(plan.encode()).hexdigest(), "version": version}
    files = sorted(df.inputFiles())
    if not files:
        return state if version is not None else None
    listed = df.sparkSession.read.format("binaryFile").load(files).select("path", "modificationTime", "length")
    row = listed.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), F.max("modificationTime").cast("string").alias("latest"),
                     F.bit_xor(F.xxhash64("path", "modificationTime", "length")).alias("hash")).first()
    return state | {"files": row.asDict()}


def _claimed(name: str) -> str:
    return hashlib.sha256(name.encode()).hexdigest()


@dataclass(frozen=True)
class Entry:
    """One publication."""

    spark: SparkSession = field(repr=False, compare=False)
    entry: str
    name: str
    fingerprint: str
    published: datetime
    format: str
    tables: Mapping[str, str]
    schemas: Mapping[str, str]
    facts: Mapping[str, str | None]

    def read(self, table: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schemas[table]))
        return self.spark.read.schema(schema).option("header", True).format(self.format).load(self.tables[table])


class Store:
    """Stored tables under ``path``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def temporary(cls, spark: SparkSession) -> Store:
        """A store for one run, in the shared folder."""
        return cls(spark, f"{shared_folder(spark)}/rateloom-run-{uuid.uuid4().hex}")

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def _children(self, folder: str) -> list:
        files, path = self._files()
        parent = path(f"{self.path}/{folder}")
        return list(files.listStatus(parent)) if files.exists(parent) else []

    def entries(self, name: str | None = None) -> list[Entry]:
        """Publications, earliest first."""
        if not self._children("manifest"):
            return []
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/*")
        if name is not None:
            rows = rows.where(F.col("name") == name)
        return [Entry(self.spark, **r.asDict()) for r in rows.orderBy("published", "entry").collect()]

    def find(self, name: str, fingerprint: str | None = None) -> Entry | None:
        """The latest publication under a name, with the fingerprint if one is given."""
        found = [e for e in self.entries(name) if fingerprint in (None, e.fingerprint)]
        return found[-1] if found else None

    def write(self, df: DataFrame, table: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
              bucket_by: str | None = None) -> tuple[str, DataFrame]:
        """Write a table to a folder of its own: (folder, the stored rows). Nobody else finds it before it is published.

        With ``bucket_by`` the rows are stored in as many buckets of that column as shuffles have partitions, and what is returned
        joins on it without moving. Spark tells buckets by a table's name, so there is one while this runs.
        """
        folder = f"{self.path}/data/{table}-{uuid.uuid4().hex}"
        writer = df.write.format(fmt).option("header", True).partitionBy(*partition_by)
        if fmt == "parquet":
            writer = writer.option("compression", "zstd")
        with shuffles_removed(self.spark):
            if bucket_by is None:
                writer.save(folder)
                return folder, self.spark.read.schema(df.schema).option("header", True).format(fmt).load(folder)
            name = f"spark_catalog.default.rateloom_{uuid.uuid4().hex}"
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            writer.bucketBy(buckets, bucket_by).option("path", folder).saveAsTable(name)
            stored = self.spark.table(name)
            self.spark.sql(f"DROP TABLE {name}")  # the rows stay, and so does what was read of the table's layout
            return folder, stored

    def publish(self, name: str, tables: Mapping[str, tuple[str, DataFrame]], fingerprint: str = "",
                facts: Mapping[str, object] | None = None, fmt: str = "parquet", once: bool = False) -> Entry:
        """Make written tables known, all of them with one row. With ``once`` a name can be published a single time."""
        if once and self.find(name):
            raise FileExistsError(f"{name} is published in {self.path} already")
        claim = self._claim(name) if once else None
        entry = uuid.uuid4().hex

        def texts(values: Mapping[str, object]):
            cells = [F.lit(x) for k, v in values.items() for x in (k, None if v is None else str(v))]
            return F.create_map(*cells).cast("map<string,string>") if cells else F.map_from_arrays(F.array(), F.array()).cast("map<string,string>")

        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(entry).alias("entry"), F.lit(name).alias("name"), F.lit(fingerprint).alias("fingerprint"),
            F.current_timestamp().alias("published"), F.lit(fmt).alias("format"),
            texts({k: folder for k, (folder, _) in tables.items()}).alias("tables"),
            texts({k: df.schema.json() for k, (_, df) in tables.items()}).alias("schemas"), texts(facts or {}).alias("facts"))
        try:
            row.write.parquet(f"{self.path}/manifest/{entry}")
        except BaseException:
            if claim:
                self._remove(claim)
            raise
        return next(e for e in self.entries(name) if e.entry == entry)

    def _claim(self, name: str) -> str:
        """Take a name for a single publication: the file system creates a file for one writer only."""
        files, path = self._files()
        claim = f"{self.path}/claims/{_claimed(name)}"
        try:
            files.create(path(claim), False).close()
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            raise FileExistsError(f"{name} is being published in {self.path}, or its writer died; clean() frees it in time") from error
        return claim

    def _remove(self, folder: str) -> None:
        files, path = self._files()
        files.delete(path(folder), True)

    def clean(self, older_than: timedelta = timedelta(days=7)) -> list[str]:
        """Remove data and claims that no publication names and that were last changed before; returns their paths."""
        entries = self.entries()
        named = {folder.rsplit("/", 1)[-1] for e in entries for folder in e.tables.values()} | {_claimed(e.name) for e in entries}
        before = (datetime.now(timezone.utc) - older_than).timestamp() * 1000
        gone = [str(s.getPath()) for s in (*self._children("data"), *self._children("claims"))
                if s.getPath().getName() not in named and s.getModificationTime() <= before]
        for folder in gone:
            self._remove(folder)
        return gone

    def drop(self) -> None:
        """Remove the whole store, as after a run of its own."""
        self._remove(self.path)
