"""A data source of zipped office files: spark.read.format("office_parts").option("path", folder).option("glob", "*.pptx").load().

The driver lists names and sizes only, files of no bytes too, keeps those that the glob matches, and deals them over partitions by size. A task opens one
file at a time. What can't be opened is a row with an error, a file of no bytes a row without entry.
"""

from __future__ import annotations

import fnmatch
import io
import zipfile
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of files in a partition, unless one file alone has more.
SPLIT = 64 << 20
SCHEMA = "path string, size long, entry string, xml string, error string"


@dataclass
class Files(InputPartition):
    """Paths with their sizes."""

    files: list[tuple[str, int]]


class PartsReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.glob, self.split = options["path"], options.get("glob", "*"), int(options.get("splitbytes", options.get("splitBytes", SPLIT)))

    def _store(self):
        from pyarrow import fs

        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        store, root = self._store()
        found = sorted((f.path, f.size or 0) for f in store.get_file_info(fs.FileSelector(root, recursive=True)) if f.type == fs.FileType.File and fnmatch.fnmatchcase(f.base_name, self.glob))
        out, bytes_ = [], self.split
        for path, size in found:
            if bytes_ + size > self.split:
                out.append(Files([]))
                bytes_ = 0
            out[-1].files.append((path, size))
            bytes_ += max(size, 1)
        return out or [Files([])]

    def read(self, partition: Files):
        store, _ = self._store()
        for path, size in partition.files:
            if not size:
                yield path, size, None, None, None
                continue
            try:
                with store.open_input_file(path) as f, zipfile.ZipFile(io.BytesIO(f.read())) as z:
                    names = z.namelist()
                    for name in names:
                        yield path, size, name, z.read(name).decode("utf-8", "replace") if name.endswith((".xml", ".rels")) else None, None
                    if not names:
                        yield path, size, None, None, None
            except Exception as e:  # a file that can't be opened is a row, not a failed job
                yield path, size, None, None, f"{type(e).__name__}: {e}"[:200]


class OfficeParts(DataSource):
    @classmethod
    def name(cls) -> str:
        return "office_parts"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PartsReader:
        return PartsReader(self.options)
