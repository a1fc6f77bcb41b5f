"""Shared tables, code shipping and word arithmetic of the corpus operators."""

from __future__ import annotations

import atexit
import gc
import os
import re
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterable
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but these six white-space characters.
#: bytes.split() without an argument splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"

_own_folder: dict[str, str] = {}
_shipped: weakref.WeakSet = weakref.WeakSet()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a temporary one only for a local session that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file://" + os.path.realpath(tempfile.mkdtemp(prefix="run-"))
    return _own_folder[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the process exits."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table in the shared folder and reads it back: a cut in the lineage that outlives executors.

    Shuffle files of what led to it go when the driver collects its garbage, so it is asked to.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    back.scratch_path = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing will read again."""
    for table in tables:
        _delete(table.sparkSession, table.scratch_path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # at exit the session may be gone; the folder is scratch then
        return


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per Spark context."""
    context = spark.sparkContext
    if context in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="run-")), "tallyboard_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, f"{package.name}/{source.relative_to(package)}")
    context.addPyFile(archive)
    _shipped.add(context)


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def quoted(rows: DataFrame) -> list[Column]:
    """The columns by their names, whatever characters these hold."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in rows.columns]


def packed_row(rows: DataFrame) -> Column:
    """All columns as one, `row`, so that names of the caller's meet none of an operator's."""
    return F.struct(*quoted(rows)).alias("row")


def unpacked(names: Iterable[str]) -> list[Column]:
    """The columns of `row` again."""
    return [F.col("row").getField(name).alias(name) for name in names]


def row_key() -> Column:
    """A long that tells the rows of a scan apart; write it to a table before it is used twice."""
    return F.monotonically_increasing_id()


def word_hashes(words: Iterable[bytes], count: int) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, count)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(hashes: np.ndarray, n: int, multiplier: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """One hash for each run of n consecutive words; empty if there are fewer."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    last = len(hashes) - n + 1
    total = np.zeros(last, np.uint64)
    factor = np.uint64(multiplier)
    with np.errstate(over="ignore"):
        for j in range(n):
            total = total * factor + hashes[j : j + last]
    return mixed(total)


def sequence_hash(data: bytes) -> tuple[int, int]:
    """Two signed 64-bit halves of a 128-bit hash."""
    value = xxhash.xxh3_128_intdigest(data)
    return signed(value >> 64), signed(value & (2**64 - 1))


def signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def batches(iterator, size: int):
    """The record batches cut into slices whose first column holds about so many bytes, and at least one row."""
    for batch in iterator:
        start, held = 0, 0
        for i, value in enumerate(batch.column(0)):
            held += len(value.as_buffer()) if value.is_valid else 0
            if held >= size:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)
