"""Batch ids without a database: numbers claimed in a folder that all drivers share.

An id is taken by creating an empty file of its name, which only one of several drivers can
do: the folder's store must refuse to create a file that exists (HDFS and POSIX file systems
do; object stores in general don't). Ids ascend, and one that was claimed is never given
again, whether its batch was finished or not.
"""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

from ledgerloom.sources.jdbc import check_batch_id


def next_batch_id(spark: SparkSession, folder: str) -> int:
    """An id above all that were claimed in ``folder``, which is made if need be."""
    made = _PosixFolder(folder) if urlparse(folder).scheme in ("", "file") else _HadoopFolder(spark, folder)
    number = max((int(name) for name in made.names() if name.isdigit()), default=0)
    while True:  # ends: every failure means that another driver has a higher id
        number += 1
        if made.claim(f"{number:012d}"):
            return check_batch_id(number)


class _PosixFolder:
    def __init__(self, folder: str) -> None:
        self.path = unquote(urlparse(folder).path) if folder.startswith("file:") else folder
        os.makedirs(self.path, exist_ok=True)

    def names(self) -> list[str]:
        return os.listdir(self.path)

    def claim(self, name: str) -> bool:
        try:
            os.close(os.open(os.path.join(self.path, name), os.O_CREAT | os.O_EXCL | os.O_WRONLY))
        except FileExistsError:
            return False
        return True


class _HadoopFolder:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        jvm = spark.sparkContext._jvm
        self.path_of = jvm.org.apache.hadoop.fs.Path
        self.folder = self.path_of(folder)
        self.store = self.folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.store.mkdirs(self.folder)

    def names(self) -> list[str]:
        return [status.getPath().getName() for status in self.store.listStatus(self.folder)]

    def claim(self, name: str) -> bool:
        return bool(self.store.createNewFile(self.path_of(self.folder, name)))
