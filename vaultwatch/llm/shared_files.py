"""Files that tasks write to, and read from, the shared folder themselves.

A task writes under a name of its own attempt and reports it; what a lost or repeated attempt has left is in no
report and is never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession

from vaultwatch.sources.shared import shared_dir


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path of a folder given by URI or plain path."""
    return fs.FileSystem.from_uri(uri)


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A folder below the shared one; made by the driver, so that no two tasks make it at once."""
    uri = shared_dir(spark, purpose)
    files, path = open_folder(uri)
    files.create_dir(path, recursive=True)
    return uri


def attempt_name(part: int, suffix: str) -> str:
    return f"part-{part:05d}-{uuid.uuid4().hex}{suffix}"
