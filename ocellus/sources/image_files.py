"""One file per row, as a Spark data source for writing.

``df.write.format("ocellus_files").save(path)`` writes each row as a file
named by its ``name``: the bytes of ``content``, or, of a table with
``height, width, n_channels, data``, a PNG of the pixels (``data`` as Spark's image
source gives them: rows of BGR(A) or grey bytes).  With a column ``folder``, the file
goes into that folder of the path.

A task writes into a folder of its own under ``<path>/_temporary``.  The commit
moves the folders of the attempts that Spark accepted next to the others, one
rename per task (and ``folder``), and drops the rest; an abort drops all.  So a lost executor, a
repeated or a speculative attempt leaves no file twice.  Readers take the
folder recursively (``files.read_images``, ``binaryFile``); underscore folders
are hidden from them.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "ocellus_files"
_SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: PNG's colour types by channels.
_COLOUR = {1: 0, 3: 2, 4: 6}
#: Names of folders; hidden ones and paths are none.
_PLAIN = re.compile(r"[A-Za-z0-9][A-Za-z0-9._=-]*")


def png_bytes(data: bytes, height: int, width: int, channels: int) -> bytes:
    """An 8-bit PNG of BGR(A) or grey rows, without a row filter."""
    px = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels >= 3:
        px = px[..., [2, 1, 0, *range(3, channels)]]
    rows = np.zeros((height, 1 + width * channels), np.uint8)
    rows[:, 1:] = px.reshape(height, -1)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", width, height, 8, _COLOUR[channels], 0, 0, 0)
    return _SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")


def _store(path: str):
    """The file system of ``path`` and the path on it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class _Folder(WriterCommitMessage):
    name: str | None
    files: int
    inside: list[str] | None = None


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, columns: list[str], overwrite: bool):
        self.path, self.columns, self.overwrite = path.rstrip("/"), columns, overwrite

    def _rows(self, batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in batch.to_pylist():
                if row.get("name") is None:
                    raise ValueError("a file without a name")
                name = row["name"].rsplit("/", 1)[-1]
                if "folder" in self.columns and not _PLAIN.fullmatch(row["folder"] or ""):
                    raise ValueError(f"{row['folder']!r} is no name for a folder")
                if "content" in self.columns:
                    body = row["content"]
                else:
                    full = all(row[c] is not None for c in ("data", "height", "width", "n_channels"))
                    body = png_bytes(row["data"], row["height"], row["width"], row["n_channels"]) if full else None
                yield row.get("folder"), name, body or b""

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        task = TaskContext.get()
        folder = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        store, root = _store(f"{self.path}/_temporary/{folder}")
        seen: dict[tuple[str | None, str], int] = {}
        made, inside, files = set(), set(), 0
        for place, name, body in self._rows(iterator):
            # a name that comes again goes into the next folder
            turn = seen[place, name] = seen.get((place, name), -1) + 1
            at = f"{root}/{turn}" if place is None else f"{root}/{place}/{turn}"
            if at not in made:
                store.create_dir(at, recursive=True)
                made.add(at)
                inside.add(place)
            with store.open_output_stream(f"{at}/{name}") as out:
                out.write(body)
            files += 1
        return _Folder(folder if files else None, files, sorted(inside) if "folder" in self.columns else None)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        if self.overwrite:
            from pyarrow import fs
            tops = store.get_file_info(fs.FileSelector(root))
            if "folder" in self.columns:
                tops = [x for t in tops if t.type == fs.FileType.Directory and _PLAIN.fullmatch(os.path.basename(t.path))
                        for x in store.get_file_info(fs.FileSelector(t.path))]
            for old in tops:
                if old.type == fs.FileType.Directory and os.path.basename(old.path).startswith("part-"):
                    store.delete_dir(old.path)
        for m in messages:
            if m is None or not m.name:
                continue
            if m.inside is None:
                store.move(f"{root}/_temporary/{m.name}", f"{root}/{m.name}")
            for place in m.inside or ():
                store.create_dir(f"{root}/{place}", recursive=True)
                store.move(f"{root}/_temporary/{m.name}/{place}", f"{root}/{place}/{m.name}")
        self._drop(store, root)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._drop(*_store(self.path))

    @staticmethod
    def _drop(store, root: str) -> None:
        from pyarrow import fs
        if store.get_file_info(f"{root}/_temporary").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/_temporary")


class FileRows(DataSource):
    """Write-only: ``name`` and ``content``, or ``name, height, width,
    n_channels, data``, and ``folder`` if wanted; other columns are ignored."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _Writer:
        columns = schema.fieldNames()
        need = ["name", "content"] if "content" in columns else ["name", "height", "width", "n_channels", "data"]
        missing = [c for c in need if c not in columns]
        if missing:
            raise ValueError(f"columns {missing} are missing")
        if "path" not in self.options:
            raise ValueError("save(path) needs a path")
        return _Writer(self.options["path"], columns, overwrite)


def write_files(spark: SparkSession, df: DataFrame, path: str, append: bool = True) -> None:
    """Each row of ``df`` as a file under ``path``; see the module."""
    spark.dataSource.register(FileRows)
    df.write.format(FORMAT).mode("append" if append else "overwrite").save(path)
