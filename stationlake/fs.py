"""Driver-side file operations through Hadoop's FileSystem API.

Used only for bounded metadata work: listing the files of selected hour
folders, moving a list of files, writing a small marker or journal.  The
same calls work for HDFS, object stores (s3a://, gs://, abfs://) and local
disks, because they go through the cluster's own Hadoop configuration.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Renames are metadata calls; a few threads hide their latency (object
# stores take tens of milliseconds per call).
MOVE_THREADS = 16


def canon(path: str) -> str:
    """One spelling per local path: ``file:///x`` and ``file:/x`` -> ``file:/x``."""
    if path.startswith("file://"):
        return "file:/" + path[len("file://"):].lstrip("/")
    return path


# ``FileStatus.toString()``: ``...{path=<uri>; isDirectory=<bool>; length=..`` for
# files, ``...; modification_time=..`` for folders.
_STATUS = re.compile(r"\{path=(.*?); isDirectory=(true|false); (?:length|modification_time)=")


class HadoopFS:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        # Resolve the class once: each ``jvm.org.apache...`` lookup walks the
        # package path with several Py4J round trips.
        self._path_class = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path_class(path).getFileSystem(self._conf)
        self._to_text = None

    def _p(self, path: str):
        return self._path_class(path)

    def qualify(self, path: str) -> str:
        return canon(self._fs.makeQualified(self._p(path)).toString())

    def exists(self, path: str) -> bool:
        return bool(self._fs.exists(self._p(path)))

    def _entries(self, statuses) -> list[tuple[str, bool]]:
        """(path, is_dir) of a ``FileStatus[]``.

        The whole array is turned into one string in the JVM and parsed here:
        one Py4J call instead of two per entry.  Falls back to per-entry
        calls if the parse does not account for every entry.
        """
        if statuses is None:
            return []
        n = len(statuses)
        if n == 0:
            return []
        try:
            text = self._array_text(statuses)
        except Exception:  # helper class not on this classpath: per entry
            text = ""
        found = [(canon(p), d == "true") for p, d in _STATUS.findall(text)]
        if len(found) == n:
            return found
        return [(canon(st.getPath().toString()), bool(st.isDirectory())) for st in statuses]

    def _array_text(self, arr) -> str:
        if self._to_text is None:
            self._to_text = self._jvm.org.apache.commons.lang3.ArrayUtils
        return self._to_text.toString(arr)

    def glob_files(self, pattern: str) -> list[str]:
        """Data files matching a glob; names starting with ``_`` or ``.`` skipped."""
        return sorted(p for p, is_dir in self._entries(self._fs.globStatus(self._p(pattern)))
                      if not is_dir and not p.rsplit("/", 1)[1].startswith(("_", ".")))

    def glob_dirs(self, pattern: str) -> list[str]:
        return sorted(p for p, is_dir in self._entries(self._fs.globStatus(self._p(pattern))) if is_dir)

    def list_files_recursive(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        it = self._fs.listFiles(self._p(path), True)
        out = []
        while it.hasNext():
            st = it.next()
            name = st.getPath().getName()
            if not name.startswith(("_", ".")):
                out.append(canon(st.getPath().toString()))
        return sorted(out)

    def mkdirs(self, path: str) -> None:
        self._fs.mkdirs(self._p(path))

    def move(self, src: str, dst: str) -> bool:
        """Rename ``src`` to ``dst``; parent folders are created.

        Idempotent for retries: if ``src`` is gone and ``dst`` exists the move
        already happened.
        """
        s, d = self._p(src), self._p(dst)
        if not self._fs.exists(s):
            return self._fs.exists(d)
        self._fs.mkdirs(d.getParent())
        if not self._fs.rename(s, d):
            raise OSError(f"rename failed: {src} -> {dst}")
        return True

    def rename_many(self, pairs, threads: int = MOVE_THREADS) -> int:
        """Renames in parallel (folders or files); raises if one fails."""
        pairs = list(pairs)
        if pairs:
            with ThreadPoolExecutor(max_workers=threads) as pool:
                list(pool.map(lambda p: self.rename(*p), pairs))
        return len(pairs)

    def move_many(self, pairs, threads: int = MOVE_THREADS, make_parents: bool = True) -> int:
        """Move many files: parents created once each, renames in parallel.

        Idempotent like :meth:`move` (a pair whose source is gone and whose
        target exists counts as done), so an interrupted swap can be re-run.
        """
        pairs = list(pairs)
        if not pairs:
            return 0
        parents = sorted({dst.rsplit("/", 1)[0] for _, dst in pairs}) if make_parents else []
        with ThreadPoolExecutor(max_workers=threads) as pool:
            list(pool.map(self.mkdirs, parents))
            list(pool.map(lambda p: self.rename(*p), pairs))
        return len(pairs)

    def rename(self, src: str, dst: str) -> None:
        """Hadoop rename (into ``dst`` if it is an existing folder).  Raises
        unless it happened, now or before (source gone, target there)."""
        if self._fs.rename(self._p(src), self._p(dst)):
            return
        if not self._fs.exists(self._p(src)) and self._fs.exists(self._p(dst)):
            return
        raise OSError(f"rename failed: {src} -> {dst}")

    def delete(self, path: str, recursive: bool = True) -> None:
        self._fs.delete(self._p(path), recursive)

    def write_text(self, path: str, text: str) -> None:
        out = self._fs.create(self._p(path), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def create_new(self, path: str, text: str) -> bool:
        """Create a file that must not exist yet; False if it does."""
        try:
            out = self._fs.create(self._p(path), False)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        return True

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._p(path))
        try:
            io = self._jvm.java.io
            reader = io.BufferedReader(io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def list_dir(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(p for p, _ in self._entries(self._fs.listStatus(self._p(path))))
