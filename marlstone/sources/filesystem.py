"""Small file operations through Hadoop's file systems, so that any store Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def at(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def exists(self, p: str) -> bool:
        return self._fs.exists(self._path(p))

    def names(self, p: str) -> list[str]:
        """Entries of a directory, sorted; [] if it isn't there."""
        if not self.exists(p):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(p)))

    def below(self, p: str) -> list[str]:
        """Data files below a directory, as paths relative to it."""
        out, stack = [], [""]
        while stack:
            at = stack.pop()
            for s in self._fs.listStatus(self._path(p + at)):
                name = s.getPath().getName()
                if s.isDirectory():
                    stack.append(f"{at}/{name}")
                elif not name.startswith(("_", ".")):
                    out.append(f"{at}/{name}"[1:])
        return sorted(out)

    def size(self, p: str) -> tuple[int, int]:
        """Data files and bytes below a directory, or of a file; hidden files don't count."""
        files = total = 0
        stack = [self._path(p)]
        while stack:
            for s in self._fs.listStatus(stack.pop()):
                name = s.getPath().getName()
                if s.isDirectory():
                    stack.append(s.getPath())
                elif not name.startswith(("_", ".")):
                    files, total = files + 1, total + s.getLen()
        return files, total

    def modified(self, p: str) -> float:
        return self._fs.getFileStatus(self._path(p)).getModificationTime() / 1000

    def read(self, p: str) -> str:
        stream = self._fs.open(self._path(p))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, p: str, text: str) -> bool:
        """Create a file whole, or not at all: False if it is there already."""
        if self.exists(p):
            return False
        temp = f"{p}.tmp"
        out = self._fs.create(self._path(temp), True)
        out.write(bytearray(text.encode()))
        out.close()
        return not self.exists(p) and self._fs.rename(self._path(temp), self._path(p))

    def delete(self, p: str) -> None:
        self._fs.delete(self._path(p), True)
