"""Numbered commits: the one place where a table or a warehouse changes.

A commit is a small JSON file, ``<root>/_versions/<n>.json``, that names
immutable data.  It appears whole or not at all, and at most one writer can
make number ``n``: a writer that started from ``n - 1`` and finds ``n`` taken
has lost the race and must start again from the newer state.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import SparkSession

from tessera.sources.fs import HadoopFS

_ENTRY = re.compile(r"/(\d+)\.json$")


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the table."""


class CommitLog:
    def __init__(self, spark: SparkSession, root: str, name: str = "_versions"):
        self.fs = HadoopFS(spark)
        self.folder = f"{root.rstrip('/')}/{name}"

    def path(self, n: int) -> str:
        return f"{self.folder}/{n:010d}.json"

    def versions(self) -> list[int]:
        found = (_ENTRY.search(path) for path, is_dir in self.fs.list(self.folder) if not is_dir)
        return sorted(int(m.group(1)) for m in found if m)

    def latest(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def read(self, n: int) -> dict:
        return json.loads(self.fs.read_text(self.path(n)))

    def commit(self, after: int | None, entry: dict) -> int:
        """Make the commit that follows ``after`` (None: the first)."""
        n = 0 if after is None else after + 1
        if self.latest() != after or not self.fs.write_new(self.path(n), json.dumps(entry)):
            raise CommitConflict(f"{self.path(n)} exists: another writer committed first")
        return n

    def drop(self, n: int) -> None:
        self.fs.delete(self.path(n))
