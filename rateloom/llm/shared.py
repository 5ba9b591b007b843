"""What several operators of this package need: tables, the shared folder, Arrow batches, row hashes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch. Texts may be long, so a batch holds few of them.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a folder of our own only on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "/tmp/checkpoints"


def run_folder(spark: SparkSession) -> str:
    """Where this application keeps its intermediate tables."""
    return f"{shared_folder(spark)}/rateloom-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clean_up(spark: SparkSession) -> None:
    """Remove this application's intermediate tables, once its results are written: lazy results still read them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends here, and lost executors cost nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that it need not be installed on them."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="rateloom-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(path))


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
                batch_rows: int = BATCH_ROWS) -> DataFrame:
    """``mapInArrow`` whose function sees batches of at most ``batch_rows`` rows, however Spark sends them."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return function(b.slice(k, batch_rows) for b in batches for k in range(0, max(1, b.num_rows), batch_rows))

    ship_package(df.sparkSession)
    return df.mapInArrow(sliced, schema)


_HELD: dict = {}


def held(owner: str, key, make: Callable):
    """What a worker keeps from task to task for the operator at work. When another operator begins in the worker, the
    earlier one's is dropped, so that in a pipeline they don't add up."""
    if _HELD.get("owner") != owner:
        _HELD.clear()
        _HELD["owner"] = owner
    if key not in _HELD:
        _HELD[key] = make()
    return _HELD[key]


def id_text(column: str = "doc_id") -> Column:
    """The id as text; a missing id is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(id_text(column).cast("binary")) % folds


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of unsigned 64-bit integers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def lists(values: np.ndarray, counts, kind: pa.DataType) -> pa.ListArray:
    """A list column of consecutive runs of ``values``, with the given lengths."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
