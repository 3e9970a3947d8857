"""Pages through Spark's Python data source API: a write becomes visible as a whole, a read opens only the files it needs.

Tasks write files that nobody lists yet. When all have succeeded, the driver writes one manifest with their names, page
ranges and checksums; a write that fails deletes what its tasks reported, and what a lost executor left is in no manifest.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage)

NAME = "chainfold_pages"
SCHEMA = "page bigint, address string, slot string, value string"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pyarrow.fs.LocalFileSystem(), path)


@dataclass
class PageFile(WriterCommitMessage):
    """What a task tells about the file it wrote; ``file`` is None if it had no rows."""
    file: str | None
    rows: int
    first_page: int | None
    last_page: int | None
    sha256: str | None


class PageWriter(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> PageFile:
        system, root = _open(self.path)
        name, out, rows, first, last = f"{uuid.uuid4().hex}.parquet", None, 0, None, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    system.create_dir(f"{root}/files", recursive=True)
                    out = pyarrow.parquet.ParquetWriter(f"{root}/files/{name}", batch.schema, filesystem=system)
                out.write_batch(batch)
                low, high = pa.compute.min_max(batch.column("page")).as_py().values()
                if low is None:
                    raise ValueError("a row without a page")
                first, last = low if first is None else min(first, low), high if last is None else max(last, high)
                rows += batch.num_rows
            if out is None:
                return PageFile(None, 0, None, None, None)
            out.close()
        except BaseException:
            if out is not None:
                out.close()
                system.delete_file(f"{root}/files/{name}")
            raise
        return PageFile(name, rows, first, last, _checksum(system, f"{root}/files/{name}"))

    def commit(self, messages: list[PageFile | None]) -> None:
        """One manifest, written beside its place and moved there: readers see all of the write or nothing."""
        system, root = _open(self.path)
        system.create_dir(f"{root}/manifests", recursive=True)
        text = json.dumps({"version": 1, "files": [asdict(m) for m in messages if m is not None and m.file]}, sort_keys=True)
        name = uuid.uuid4().hex
        with system.open_output_stream(f"{root}/{name}.pending") as out:
            out.write(text.encode())
        system.move(f"{root}/{name}.pending", f"{root}/manifests/{name}.json")

    def abort(self, messages: list[PageFile | None]) -> None:
        system, root = _open(self.path)
        for message in messages:
            if message is not None and message.file:
                system.delete_file(f"{root}/files/{message.file}")


def _checksum(system: pyarrow.fs.FileSystem, path: str) -> str:
    digest = hashlib.sha256()
    with system.open_input_stream(path) as source:
        while part := source.read(1 << 20):
            digest.update(part)
    return digest.hexdigest()


def manifest_files(path: str) -> list[dict]:
    """The files of all committed writes."""
    system, root = _open(path)
    listed = system.get_file_info(pyarrow.fs.FileSelector(f"{root}/manifests", allow_not_found=True))
    found = []
    for info in sorted(listed, key=lambda i: i.path):
        with system.open_input_stream(info.path) as source:
            found += json.loads(source.read())["files"]
    return found


def sweep(path: str) -> int:
    """Delete files that no manifest lists: what killed tasks left. Not to be called while a write runs."""
    system, root = _open(path)
    listed = {entry["file"] for entry in manifest_files(path)}
    left = [i.path for i in system.get_file_info(pyarrow.fs.FileSelector(f"{root}/files", allow_not_found=True)) if i.base_name not in listed]
    for one in left:
        system.delete_file(one)
    return len(left)


class FilePartition(InputPartition):
    def __init__(self, entry: dict):
        self.entry = entry


class PageReader(DataSourceReader):
    """A partition per file; a filter on the page leaves out files whose range cannot hold it."""

    def __init__(self, path: str, verify: bool):
        self.path, self.verify, self.low, self.high, self.wanted = path, verify, None, None, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            if getattr(f, "attribute", None) == ("page",):
                if isinstance(f, In):
                    self.wanted = [v for v in f.value if self.wanted is None or v in self.wanted]
                if isinstance(f, (EqualTo, GreaterThanOrEqual, GreaterThan)):
                    low = f.value + isinstance(f, GreaterThan)
                    self.low = low if self.low is None else max(self.low, low)
                if isinstance(f, (EqualTo, LessThanOrEqual, LessThan)):
                    high = f.value - isinstance(f, LessThan)
                    self.high = high if self.high is None else min(self.high, high)
            yield f             # files are chosen here, rows still by Spark

    def partitions(self) -> list[FilePartition]:
        def needed(entry: dict) -> bool:
            first, last = entry["first_page"], entry["last_page"]
            return ((self.low is None or last >= self.low) and (self.high is None or first <= self.high)
                    and (self.wanted is None or any(v is not None and first <= v <= last for v in self.wanted)))
        # an empty list would mean one partition without a file
        return [FilePartition(e) for e in manifest_files(self.path) if needed(e)] or [FilePartition({})]

    def read(self, partition: FilePartition) -> Iterator[pa.RecordBatch]:
        if not partition.entry:
            return
        system, root = _open(self.path)
        path = f"{root}/files/{partition.entry['file']}"
        if self.verify and _checksum(system, path) != partition.entry["sha256"]:
            raise ValueError(f"{partition.entry['file']} is not the file that was committed")
        rows = 0
        for batch in pyarrow.parquet.ParquetFile(path, filesystem=system).iter_batches():
            rows += batch.num_rows
            yield batch
        if rows != partition.entry["rows"]:
            raise ValueError(f"{partition.entry['file']} holds {rows} rows, {partition.entry['rows']} were committed")


class PageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PageReader:
        return PageReader(self.options["path"], self.options.get("verify", "true").lower() == "true")

    def writer(self, schema, overwrite: bool) -> PageWriter:
        if overwrite:
            raise ValueError("committed pages are not replaced; write to another path")
        return PageWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    """Make the source known to the session and let filters reach it."""
    spark.dataSource.register(PageSource)
    spark.conf.set(PUSHDOWN, "true")
