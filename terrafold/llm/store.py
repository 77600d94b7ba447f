"""Intermediate tables and files in the folder that all executors share."""

from __future__ import annotations

import uuid

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from terrafold.session import fresh_path


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet; ``terrafold.session.release`` deletes it."""
    return fresh_path(spark, label)


def written(df: DataFrame, label: str) -> DataFrame:
    """Compute once: write as Parquet in the shared folder and read back. Cuts the lineage, and survives
    the loss of executors."""
    spark, path = df.sparkSession, fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def put_bytes(path: str, parts: list[bytes]) -> str:
    """Write one file of the shared folder from a task. The name is of this attempt alone, so a repeated
    task never touches a file that somebody reads."""
    path = f"{path}-{uuid.uuid4().hex}"
    system, inner = _system(path)
    with system.open_output_stream(inner) as out:
        for part in parts:
            out.write(part)
    return path


def make_folder(path: str) -> str:
    system, inner = _system(path)
    system.create_dir(inner, recursive=True)
    return path


def remove_folder(path: str) -> None:
    """Delete a folder of ``fresh_folder`` that nothing reads any more."""
    system, inner = _system(path)
    system.delete_dir(inner)


def local_name(path: str) -> str | None:
    """The path for memory mapping if the shared folder is mounted here, else None."""
    system, inner = _system(path)
    return inner if isinstance(system, pyarrow.fs.LocalFileSystem) else None


def read_bytes(path: str) -> bytes:
    system, inner = _system(path)
    with system.open_input_file(inner) as held:
        return held.read()


def _system(path: str):
    if "://" in path or path.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return pyarrow.fs.LocalFileSystem(), path
