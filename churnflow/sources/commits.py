"""A log of numbered entries in which every number is claimed once, however many writers there are.

An entry is one file, named after its number, that becomes visible whole and only if no file of that name is there: by
a link on a local file system, by a rename that never replaces elsewhere. Who comes second is told so, and takes the next number.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_SUFFIX = ".json"


def _causes(error: Py4JJavaError) -> set[str]:
    found, cause = set(), error.java_exception
    while cause is not None:
        found.add(cause.getClass().getSimpleName())
        cause = cause.getCause()
    return found


class CommitLog:
    """The entries below a folder of any file system that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()
        self.folder = folder.rstrip("/")
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def newest(self) -> int:
        """The greatest number claimed; 0 in an empty log. Looks at names only."""
        if not self._fs.exists(self._path("")):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(""))]
        return max((int(n.removesuffix(_SUFFIX)) for n in names if n.endswith(_SUFFIX) and not n.startswith(("_", "."))), default=0)

    def claim(self, number: int, entry: dict) -> bool:
        """Writes the entry under a number, or says that somebody else has."""
        self._fs.mkdirs(self._path(""))
        draft, final = self._path(f"_{uuid.uuid4().hex}"), self._path(f"{number:012d}{_SUFFIX}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(entry).encode() + b"\n"))
        finally:
            out.close()
        try:
            return self._publish(draft, final)
        finally:
            self._fs.delete(draft, False)

    def _publish(self, draft, final) -> bool:
        if self._fs.getUri().getScheme() == "file":
            try:
                os.link(draft.toUri().getPath(), final.toUri().getPath())
            except FileExistsError:
                return False
            return True
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self._conf)
        # Without options, a rename never replaces a file.
        options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, final, options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in _causes(error):
                return False
            raise
        return True

    def append(self, entry_of) -> int:
        """Claims the next number for ``entry_of(number)`` and returns it."""
        number = self.newest() + 1
        while not self.claim(number, entry_of(number)):
            number += 1
        return number
