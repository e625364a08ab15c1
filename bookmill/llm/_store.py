"""Files in the folder that the driver and all executors share (spark.checkpoint.dir).

Paths may be plain, file:// or of any scheme that pyarrow.fs knows. A file appears under its
name only when whole, so a task that runs twice leaves one whole file.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset and all runs in one process (tests), a temporary folder that is then set."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="bookmill-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def new_dir(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run of an operator."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _local(path: str) -> str | None:
    u = urlparse(path)
    if u.scheme in ("", "file"):
        return unquote(u.path) if u.scheme else path
    return None


def write(path: str, data: bytes | list) -> str:
    """Write a whole file under its name; data: bytes, or buffers that follow one another."""
    parts = data if isinstance(data, list) else [data]
    if (at := _local(path)) is not None:
        os.makedirs(os.path.dirname(at), exist_ok=True)
        tmp = f"{at}.{uuid.uuid4().hex}.tmp"
        with open(tmp, "wb") as f:
            for p in parts:
                f.write(p)
        os.replace(tmp, at)
        return path
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    tmp = f"{at}.{uuid.uuid4().hex}.tmp"
    store.create_dir(os.path.dirname(at), recursive=True)
    with store.open_output_stream(tmp) as f:
        for p in parts:
            f.write(p)
    store.move(tmp, at)
    return path


def open_read(path: str):
    """A readable binary stream."""
    if (at := _local(path)) is not None:
        return open(at, "rb")
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    return store.open_input_stream(at)


def mapped(path: str) -> np.ndarray:
    """The array of an .npy file, mapped into memory; a file of a remote store is fetched first, and gone with the map."""
    if (at := _local(path)) is not None:
        return np.load(at, mmap_mode="r")
    with tempfile.NamedTemporaryFile(suffix=".npy") as dst, open_read(path) as src:
        while part := src.read(1 << 24):
            dst.write(part)
        dst.flush()
        return np.load(dst.name, mmap_mode="r")


def table(df, name: str, *, partition_by: tuple[str, ...] = ()):
    """`df` written once as Parquet in the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df) -> None:
    """Remove the files of a `table` that nothing reads any more."""
    spark = df.sparkSession
    for f in df.inputFiles()[:1]:
        at = spark._jvm.org.apache.hadoop.fs.Path(f).getParent()
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
