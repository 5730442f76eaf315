"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

import re
import uuid

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import SparkSession

from areastats.session import shared_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own under the shared folder, as a URI or an absolute path."""
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, path = place(folder)
    fs.create_dir(path, recursive=True)
    return folder


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI; plain paths and file: are local or mounted."""
    local = re.sub(r"^file:/*", "/", uri)
    if local.startswith("/"):
        return pafs.LocalFileSystem(), local
    return pafs.FileSystem.from_uri(uri)


def own_name(folder: str, number: int, end: str) -> str:
    """A file name no other task or attempt uses; only names that a finished attempt returns are read."""
    task = TaskContext.get()
    return f"{folder}/part-{task.partitionId():06d}-{number:05d}-{task.taskAttemptId()}{end}"
