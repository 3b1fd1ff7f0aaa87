"""Stage logs as a Python data source: ``spark.read.format("stage_log").load(path)``.

Rows are the "key: value" lines of text files: file, line_no, key, value. Files are split into ranges of bytes; a range begins at the first line
that starts in it, so every line is read once. A task has ranges in a row, of one file or of many small ones, of about task_bytes. Where the session lets Python sources take filters, an
equality on key or file reaches the reader, which then skips other lines, or whole files, before any row is made.
Line numbers are the bytes before the line: they are in the order of the lines, and known without reading what is before.
Paths are those that Arrow's file systems open: local, hdfs, s3, gs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition

SPLIT_BYTES = 64 << 20
TASK_BYTES = 4 << 20
#: What opening a file counts as, so that a task does not get too many small ones.
OPEN_BYTES = 16 << 10
SCHEMA = "file string, line_no bigint, key string, value string"


class LogRanges(InputPartition):
    def __init__(self, ranges: list[tuple[str, int, int]]):
        self.ranges = ranges


class StageLogReader(DataSourceReader):
    def __init__(self, path: str, split_bytes: int, task_bytes: int = TASK_BYTES):
        self.path, self.split_bytes, self.task_bytes = path, split_bytes, task_bytes
        self.wanted: dict[str, object] = {}

    def pushFilters(self, filters):
        """Takes equalities on key and file; gives the others back."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo) and len(f.attribute) == 1 else None
            if column in ("key", "file") and column not in self.wanted:
                self.wanted[column] = f.value
            else:
                yield f

    def _system(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path.removeprefix("file:"))

    def _files(self) -> list[tuple[str, int]]:
        from pyarrow import fs

        system, root = self._system()
        info = system.get_file_info(root)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
        return [(i.path, i.size) for i in found if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))]

    def partitions(self):
        wanted = self.wanted.get("file")
        tasks, held = [], self.task_bytes
        for path, size in sorted(self._files()):
            if wanted is None or path == wanted:
                for at in range(0, size, self.split_bytes):
                    if held >= self.task_bytes:
                        tasks.append([])
                        held = 0
                    tasks[-1].append((path, at, min(size, at + self.split_bytes)))
                    held += min(self.split_bytes, size - at) + (OPEN_BYTES if at == 0 else 0)
        return [LogRanges(t) for t in tasks]

    def read(self, part: LogRanges):
        import io
        import re
        from itertools import groupby

        from leadloom.sources.readers import KEY_VALUE

        says, system = re.compile(KEY_VALUE), self._system()[0]
        key = self.wanted.get("key")
        rows: list[tuple] = []
        for file, ranges in groupby(part.ranges, key=lambda r: r[0]):
            with io.BufferedReader(system.open_input_file(file)) as f:
                for _, start, end in ranges:
                    at = max(0, start - 1)
                    f.seek(at)
                    if start:
                        at += len(f.readline())  # a line that began before belongs to the range before
                    while at < end and (line := f.readline()):
                        found = says.match(line.decode("utf-8", "replace").rstrip("\r\n"))
                        if found and (key is None or found[1] == key):
                            rows.append((file, at, found[1], found[2]))
                        at += len(line)
                        if len(rows) >= 10_000:
                            yield self._batch(rows)
                            rows = []
        if rows:
            yield self._batch(rows)

    @staticmethod
    def _batch(rows: list[tuple]):
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["file", "line_no", "key", "value"])


class StageLog(DataSource):
    """Options: path, split_bytes (64 MB) and task_bytes (4 MB)."""

    @classmethod
    def name(cls) -> str:
        return "stage_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> StageLogReader:
        return StageLogReader(self.options["path"], int(self.options.get("split_bytes", SPLIT_BYTES)), int(self.options.get("task_bytes", TASK_BYTES)))


def register(spark: SparkSession) -> None:
    """Make the format known to ``spark`` and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(StageLog)
