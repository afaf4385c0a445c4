"""Admission by records (ST3): a streaming source of lines that lets so many into each micro-batch.

Files are read in the order of the number in their names, one after the other,
as the reference does. An offset is a place in that order: a file, a byte of it
and the records before. A batch is at most ``records`` lines, so what passes
through the driver, which hands them to the tasks, is bounded by the rate asked
for and not by the input; without a rate use the file source (``line_stream``).
"""

from __future__ import annotations

import io
import re
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

NAME = "record_lines"


def in_order(name: str) -> tuple:
    """Files of a folder by the last number in their names, then by name; a file without one comes first."""
    numbers = re.findall(r"\d+", name.rsplit("/", 1)[-1])
    return (int(numbers[-1]) if numbers else -1, name)


class RecordReader(SimpleDataSourceStreamReader):
    """Lines of the files under a folder, from any place in their order."""

    def __init__(self, path: str, records: int):
        self.path, self.records = path, records

    def _files(self):
        from pyarrow import fs

        # Hadoop writes file:/x for what is file:///x
        where = re.sub(r"^file:/(?!/)", "file:///", self.path)
        system, root = fs.FileSystem.from_uri(where) if "://" in where else (fs.LocalFileSystem(), where)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        names = [f.path for f in found if f.type == fs.FileType.File and f.size
                 and not any(part[:1] in "._" for part in f.path[len(root):].split("/") if part)]
        return system, sorted(names, key=in_order)

    def _lines(self, start: dict) -> Iterator[tuple[bytes, dict]]:
        """Each line from ``start`` on, with the place behind it."""
        system, names = self._files()
        done = start["records"]
        for name in names:
            if start["file"] and in_order(name) < in_order(start["file"]):
                continue
            at = start["byte"] if name == start["file"] else 0
            with system.open_input_file(name) as raw:
                raw.seek(at)
                for line in io.BufferedReader(raw, 1 << 20):
                    at, done = at + len(line), done + 1
                    yield line.rstrip(b"\n").removesuffix(b"\r"), {"file": name, "byte": at, "records": done}

    def initialOffset(self) -> dict:  # noqa: N802 - Spark's names
        return {"file": "", "byte": 0, "records": 0}

    def read(self, start: dict):
        rows, end = [], start
        for line, place in self._lines(start):
            rows.append((line.decode("utf-8", "replace"),))
            end = place
            if len(rows) >= self.records:
                break
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict):  # noqa: N802
        if start["records"] >= end["records"]:
            return
        for line, place in self._lines(start):
            yield (line.decode("utf-8", "replace"),)
            if place["records"] >= end["records"]:
                return


class RecordLines(DataSource):
    """Streaming source ``record_lines`` with the options ``path`` and ``records`` (to a micro-batch)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string"

    def simpleStreamReader(self, schema):  # noqa: N802
        return RecordReader(self.options["path"], int(self.options["records"]))


def record_stream(spark: SparkSession, source: str, records: int) -> DataFrame:
    """Lines of the files under ``source``, at most ``records`` to a micro-batch."""
    if records < 1:
        raise ValueError("a micro-batch takes one record at least")
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not have this package
    spark.dataSource.register(RecordLines)
    return spark.readStream.format(NAME).option("path", source).option("records", str(int(records))).load()
