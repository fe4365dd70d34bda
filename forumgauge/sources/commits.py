"""Small numbered files that say which written folders count.

Tables are written to folders of their own and become visible when a file that
names them appears.  Files are written under another name and then renamed, so a
reader sees a whole file or none, and a number is given out once: of two writers
that follow the same file, the second fails and has to read again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

KEPT = 2


class Folder:
    """Names and small files of one folder, in whatever file system it is."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._at().getFileSystem(self._conf)

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, pattern: str) -> list[str]:
        """What matches a pattern of names, as paths below the folder, in order."""
        found = self._fs.globStatus(self._at(pattern)) or []
        depth = pattern.count("/") + 1
        return sorted("/".join(status.getPath().toUri().getPath().split("/")[-depth:]) for status in found)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file in one step; False if there is one of that name."""
        hidden = self._at(f"{name.rpartition('/')[0] or '.'}/_{self._jvm.java.util.UUID.randomUUID().toString()}")
        stream = self._fs.create(hidden)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        target = self._at(name)
        # Renaming without leave to overwrite fails if the target is there.
        if self._fs.exists(target) or not self._renamed(hidden, target):
            self._fs.delete(hidden, False)
            return False
        return True

    def _renamed(self, source, target) -> bool:
        hadoop = self._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        options = self._jvm.java.lang.reflect.Array.newInstance(
            self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(source, target, options)
        except Exception as error:
            if "FileAlreadyExistsException" in str(error):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class CommitLog:
    """The states of something, one file each; the one with the highest number holds."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def numbers(self) -> list[int]:
        return [int(name.removesuffix(".json")) for name in self.folder.names("[0-9]*.json")]

    def latest(self) -> dict | None:
        while numbers := self.numbers():
            try:
                return json.loads(self.folder.read(f"{numbers[-1]:012d}.json"))
            except Exception as error:  # another writer may have gone on and removed it
                if "FileNotFoundException" not in str(error):
                    raise
        return None

    def change(self, edit: Callable[[dict | None], dict]) -> dict:
        """Follow the latest state by what ``edit`` makes of it; again if another writer was first."""
        while True:
            before = self.latest()
            number = -1 if before is None else before["number"]
            after = {**edit(before), "number": number + 1}
            if self.folder.create(f"{number + 1:012d}.json", json.dumps(after)):
                for old in self.numbers()[:-KEPT]:
                    self.folder.delete(f"{old:012d}.json")
                return after
