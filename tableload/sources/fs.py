"""Hadoop FileSystem access from the driver (ledger files, listings, deletes).

Paths are Hadoop URIs, so the same code runs on HDFS, object stores and the
local file system.  Only small metadata passes through here; table data is read
and written by Spark executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class FS:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        jvm = spark._jvm  # noqa: SLF001 - Hadoop FS has no Python API
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()  # noqa: SLF001
        self._fs = self._Path(root).getFileSystem(self._conf)
        self._jvm = jvm
        self._none = spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)  # noqa: SLF001

    def path(self, p: str):
        return self._Path(p)

    def exists(self, p: str) -> bool:
        return bool(self._fs.exists(self._Path(p)))

    def list(self, p: str) -> list[str]:
        """Names of the entries of a directory ([] if absent)."""
        if not self.exists(p):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._Path(p))]

    def list_files(self, p: str) -> list[str]:
        """Fully qualified data files under ``p``, recursively (Parquet only)."""
        if not self.exists(p):
            return []
        out = []
        it = self._fs.listFiles(self._Path(p), True)
        while it.hasNext():
            s = it.next()
            name = s.getPath().getName()
            if name.endswith(".parquet") and not name.startswith(("_", ".")):
                out.append(s.getPath().toString())
        return out

    def create_exclusive(self, p: str, data: bytes) -> bool:
        """Publish ``data`` as ``p`` unless it exists; False if another writer won.
        The bytes are written to a file of their own first and then named ``p`` in one
        step that does not replace (a hard link on a local disk, a rename elsewhere),
        so a reader or a crash never meets half a file.  Stores without an atomic
        rename need a conditional put instead."""
        if self.exists(p):
            return False
        tmp = f"{p}.{uuid.uuid4().hex}.tmp"
        out = self._fs.create(self._Path(tmp), False)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
        try:
            if self._fs.getScheme() == "file":
                paths = [self._jvm.java.nio.file.Paths.get(self._Path(x).toUri().getPath(), self._none) for x in (p, tmp)]
                self._jvm.java.nio.file.Files.createLink(*paths)
            else:
                options = self._jvm.org.apache.hadoop.fs.Options.Rename
                none = self.spark.sparkContext._gateway.new_array(options, 1)  # noqa: SLF001
                none[0] = options.NONE
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._Path(p).toUri(), self._conf)
                context.rename(self._Path(tmp), self._Path(p), none)
        except Exception as e:  # noqa: BLE001
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        finally:
            self._fs.delete(self._Path(tmp), False)
        return True

    def read(self, p: str) -> bytes:
        stream = self._fs.open(self._Path(p))
        try:
            return bytes(stream.readAllBytes())  # one call for the whole file
        finally:
            stream.close()

    def size(self, p: str) -> int:
        """Bytes under ``p`` (0 if absent)."""
        if not self.exists(p):
            return 0
        return int(self._fs.getContentSummary(self._Path(p)).getLength())

    def mtime(self, p: str) -> float:
        """Modification time in seconds since the epoch."""
        return self._fs.getFileStatus(self._Path(p)).getModificationTime() / 1000.0

    def delete(self, p: str) -> bool:
        return bool(self._fs.delete(self._Path(p), True))

    def qualify(self, p: str) -> str:
        return self._fs.makeQualified(self._Path(p)).toString()
