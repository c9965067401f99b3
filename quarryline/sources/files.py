"""Small files on whatever file system a path names: local, or any that the session's Hadoop configuration knows."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder by its path or URI."""

    def __init__(self, root: object) -> None:
        self.root = str(root).rstrip("/")

    @staticmethod
    def _jvm():
        spark = SparkSession.getActiveSession()
        if spark is None:
            raise RuntimeError("files are reached through a running session")
        return spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, name: str):
        jvm, conf = self._jvm()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
        return path, path.getFileSystem(conf)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def exists(self, name: str = "") -> bool:
        path, fs = self._at(name)
        return fs.exists(path)

    def names(self) -> list[str]:
        """What lies in the folder, sorted; nothing if there is no such folder."""
        path, fs = self._at("")
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def read(self, name: str) -> str:
        jvm, _ = self._jvm()
        path, fs = self._at(name)
        stream = fs.open(path)
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Writes a file beside the named one and puts it in its place in one rename, so that readers see the old text or the new one."""
        jvm, conf = self._jvm()
        staged, fs = self._at(f".{name}-{uuid.uuid4().hex}")
        stream = fs.create(staged, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        target, _ = self._at(name)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if "://" in self.root else fs.getUri(), conf)
        overwrite = spark_array(jvm, jvm.org.apache.hadoop.fs.Options.Rename, [jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE])
        context.rename(staged, target, overwrite)


def spark_array(jvm, kind, values: list):
    """A Java array of the kind."""
    array = SparkSession.getActiveSession().sparkContext._gateway.new_array(kind, len(values))
    for i, v in enumerate(values):
        array[i] = v
    return array
