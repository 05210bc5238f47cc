"""A folder whose content is swapped as a whole.

Every whole content is a version in a folder of its own; numbered pointer files say which one counts. A pointer is
created under a new number and counts once it is complete (a few notes of the load stand in its line), so a job that stops at any step leaves the old content or
the new one, and nothing is ever renamed (on object stores a rename is a copy). The version before the current one stays
until the next swap, for readers that are still on it.

This is the only place of the load layer that speaks to the file system. It goes through the JVM, so loads into folders
need a classic session (not Spark Connect).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

POINTERS = "_pointers"


class VersionedFolder:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        fs, folder = self._fs(), self._path(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def _pointers(self) -> list[tuple[int, str, str]]:
        """(number, version, notes) of the complete pointers, in order. One without its line end was never finished."""
        found = []
        for name in self._names(POINTERS):
            if name.isdigit():
                source = self._fs().open(self._path(POINTERS, name))
                try:
                    text = bytes(source.readAllBytes()).decode()
                finally:
                    source.close()
                if text.endswith("\n"):
                    version, _, notes = text.strip().partition(" ")
                    found.append((int(name), version, notes))
        return found

    def current(self) -> str | None:
        """Folder of the current content, None before the first one."""
        pointers = self._pointers()
        if pointers:
            return f"{self.path}/{pointers[-1][1]}"
        foreign = [n for n in self._names() if not n.startswith(("_", ".", "v-"))]
        if foreign:
            raise FileExistsError(f"{self.path} holds {foreign[0]}, which no load of this kind wrote; load it into a new target")
        return None

    def notes(self) -> dict[str, object]:
        """What the last commit noted beside its version."""
        pointers = self._pointers()
        return json.loads(pointers[-1][2] or "{}") if pointers else {}

    def new_version(self) -> str:
        return f"{self.path}/v-{uuid.uuid4().hex}"

    def commit(self, version: str, notes: Mapping[str, object] | None = None) -> None:
        """Makes ``version`` the current content, with ``notes``; fails if another load has committed since its pointer was looked for."""
        name = version.rsplit("/", 1)[1]
        before = self._pointers()
        taken = [int(n) for n in self._names(POINTERS) if n.isdigit()]
        fs = self._fs()
        out = fs.create(self._path(POINTERS, f"{max(taken, default=0) + 1:010d}"), False)
        try:
            out.write(bytearray(f"{name} {json.dumps(notes or {})}\n".encode()))
        finally:
            out.close()
        kept = {name, *(v for _, v, _ in before[-1:])}
        for number in taken:
            if number not in {n for n, _, _ in before[-1:]}:
                fs.delete(self._path(POINTERS, f"{number:010d}"), False)
        for old in self._names():
            if old.startswith("v-") and old not in kept:
                fs.delete(self._path(old), True)

    def delete(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        self._fs().delete(path, True)
