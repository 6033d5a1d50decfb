"""Minimal file-system access through the session's Hadoop configuration.

Works for any file system the cluster is configured for (HDFS, object
stores, local).  Only metadata and tiny control files pass through here:
listings, one header line per input file, version markers.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class HadoopFS:
    def __init__(self, spark: SparkSession):
        self._gateway = spark.sparkContext._gateway
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return bool(self._fs(path).exists(self._path(path)))

    def list(self, path: str) -> list[tuple[str, bool]]:
        """(full path, is_directory) for the direct children of ``path``."""
        if not self.exists(path):
            return []
        return [(str(s.getPath().toString()), bool(s.isDirectory()))
                for s in self._fs(path).listStatus(self._path(path))]

    def first_line(self, path: str) -> str | None:
        """The first line of a (UTF-8) text file, or None when it is empty."""
        stream = self._fs(path).open(self._path(path))
        try:
            reader = self._jvm.java.io.BufferedReader(
                self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            line = reader.readLine()
            return None if line is None else str(line)
        finally:
            stream.close()

    def delete(self, path: str, recursive: bool = True) -> bool:
        return bool(self._fs(path).delete(self._path(path), recursive))

    def delete_on_exit(self, path: str) -> None:
        """Make a folder that goes when the driver's JVM ends."""
        self.mkdirs(path)
        self._fs(path).deleteOnExit(self._path(path))

    def rename(self, src: str, dst: str) -> None:
        """Move a file or folder; ``dst`` must not exist."""
        fs = self._fs(src)
        parent = self._path(dst).getParent()
        fs.mkdirs(parent)
        if not fs.rename(self._path(src), self._path(dst)):
            raise OSError(f"cannot move {src} to {dst}")

    def mkdirs(self, path: str) -> bool:
        return bool(self._fs(path).mkdirs(self._path(path)))

    def touch(self, path: str) -> None:
        """Create an empty marker file (overwriting one that exists)."""
        self._fs(path).create(self._path(path), True).close()

    def write_text(self, path: str, text: str) -> None:
        """Write a small UTF-8 control file (overwriting)."""
        out = self._fs(path).create(self._path(path), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def write_new(self, path: str, text: str) -> bool:
        """Write a small file that must not exist yet: it appears whole, by a
        rename that does not replace.  False if another writer was first."""
        path_ = self._path(path)
        part = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}.part"
        self.write_text(part, text)
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path_.toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            context.rename(self._path(part), path_, how)
        except Py4JJavaError as ex:
            self.delete(part)
            if "FileAlreadyExists" in str(ex.java_exception.getClass().getName()) or self.exists(path):
                return False
            raise
        return True

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            reader = self._jvm.java.io.BufferedReader(
                self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(str(line))
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()
