"""Checking delivered files against a manifest of digests.

The manifest drives the job: its lines are spread over the cluster and each
task streams its files in small chunks, so a file of any size, hidden or
missing, is handled with constant memory. Files outside the manifest are never
opened. The root may be any location that Arrow's file systems can reach from
the executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyboard.errors import LandingError

CHUNK = 4 * 1024 * 1024
#: Schemes of Spark's stores and the same stores' schemes in Arrow.
SPELLINGS = {"s3a": "s3", "s3n": "s3"}


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``sha256, size, path`` from lines of three fields parted by white space.
    The path is the rest of the line and may itself contain spaces."""
    line = F.regexp_replace("value", r"^\s+", "")
    fields = F.split(line, r"\s+", 3)
    return (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(
            fields[0].alias("sha256"),
            fields[1].cast("bigint").alias("size"),
            fields[2].alias("path"),
        )
    )


def reachable(root: str) -> str:
    """``root`` as the file systems of the tasks spell it, checked on the driver:
    the tasks would fail one by one at a store they cannot open."""
    scheme, colon, rest = root.rstrip("/").partition(":")
    if not colon or "/" in scheme:
        return root.rstrip("/")
    if scheme == "file":
        return "/" + rest.lstrip("/")
    uri = f"{SPELLINGS.get(scheme, scheme)}:{rest}"
    try:
        fs.FileSystem.from_uri(uri)
    except (ValueError, OSError, NotImplementedError) as problem:
        raise LandingError(f"files under {root} cannot be opened to be digested: {problem}") from None
    return uri


def _digests(root: str):
    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = (
            fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        )
        for batch in batches:
            sizes, sums = [], []
            for path in batch["path"]:
                size, total = None, None
                if system.get_file_info(f"{base}/{path}").type == fs.FileType.File:
                    size, state = 0, hashlib.sha256()
                    with system.open_input_stream(f"{base}/{path}") as stream:
                        while block := stream.read(CHUNK):
                            state.update(block)
                            size += len(block)
                    total = state.hexdigest()
                sizes.append(size)
                sums.append(total)
            yield batch.assign(
                found_size=pd.array(sizes, dtype="Int64"), found_sha256=pd.array(sums, dtype="string")
            )

    return digest


def _status() -> Column:
    return (
        F.when(F.col("found_sha256").isNull(), "missing")
        .when(F.col("found_sha256") == F.lower("sha256"), "conforming")
        .when(F.col("found_size") < F.col("size"), "truncated")
        .otherwise("modified")
    )


def audit_manifest(manifest: DataFrame, root: str, tasks: int | None = None) -> DataFrame:
    """``path, size, found_size, status`` for every manifest line.

    Lines are spread round-robin because a manifest is small in bytes however
    many files it lists: without that, one task would read all of them.
    """
    lines = manifest.select("sha256", "size", "path")
    tasks = tasks or manifest.sparkSession.sparkContext.defaultParallelism
    checked = lines.repartition(tasks).mapInPandas(
        _digests(reachable(root)),
        "sha256 string, size bigint, path string, found_size bigint, found_sha256 string",
    )
    return checked.select("path", "size", "found_size", _status().alias("status"))
