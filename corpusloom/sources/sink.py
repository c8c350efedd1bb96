"""A sink of text files with names of one's own, published all or none.

Rows are (file, line). Each task writes the files of its rows into a hidden folder beside
the target, under names that no other attempt has. Only when all tasks are done, and every
file came whole from one task, a journal of what is to move where is written; then the
files are moved, files of an earlier write that this one doesn't have are removed, and the
journal goes. A job that fails before the journal leaves nothing that can be seen. One that
dies after it is finished by `recover`, which every later write to the folder calls first:
moving what is staged still is all there is to do. Names that start with a dot are hidden
from Spark's readers.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

STAGING, JOURNAL = ".staging-", ".commit-"
_COPY = 1 << 20


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    local = re.sub(r"^file:(?://(?=/))?", "", path)
    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", local) else (fs.LocalFileSystem(), local)


def _there(files: fs.FileSystem, path: str) -> bool:
    return files.get_file_info(path).type != fs.FileType.NotFound


def _names(files: fs.FileSystem, folder: str) -> list[str]:
    return [f.base_name for f in files.get_file_info(fs.FileSelector(folder, allow_not_found=True))]


def _dropped(files: fs.FileSystem, path: str) -> None:
    kind = files.get_file_info(path).type
    if kind == fs.FileType.Directory:
        files.delete_dir(path)
    elif kind != fs.FileType.NotFound:
        files.delete_file(path)


def _published(files: fs.FileSystem, folder: str, journal: str) -> None:
    """Does what a journal says. It may have been begun before."""
    with files.open_input_stream(f"{folder}/{journal}") as f:
        plan = json.loads(f.read())
    for staged, name in plan["move"]:
        if _there(files, f"{folder}/{staged}"):
            kind = files.get_file_info(f"{folder}/{name}").type
            if kind == fs.FileType.Directory or (kind == fs.FileType.File and not isinstance(files, fs.LocalFileSystem)):
                _dropped(files, f"{folder}/{name}")  # a local file is replaced by the move itself
            files.move(f"{folder}/{staged}", f"{folder}/{name}")
    for name in plan["drop"]:
        _dropped(files, f"{folder}/{name}")
    _dropped(files, f"{folder}/{plan['staging']}")
    files.delete_file(f"{folder}/{journal}")


def recover(path: str) -> int:
    """Finishes the writes to a folder that died while they were published; how many there were."""
    files, folder = place(path)
    journals = [n for n in _names(files, folder) if n.startswith(JOURNAL)]
    for j in journals:
        _published(files, folder, j)
    return len(journals)


@dataclass
class Written(WriterCommitMessage):
    """(staged path, file name) of what a task wrote."""

    files: list[tuple[str, str]]


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, pattern: str | None, append: bool):
        self.path, self.pattern, self.append = path, pattern, append
        self.staging = f"{STAGING}{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, folder = place(self.path)
        files.create_dir(f"{folder}/{self.staging}")
        done, now, out = [], None, None
        for batch in iterator:
            # Rows come sorted by file: each run of equal names goes on in the file that is open, or opens one.
            names = batch.column(0).dictionary_encode()
            code = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
            ends = np.r_[np.flatnonzero(code[1:] != code[:-1]) + 1, len(code)] if len(code) else []
            for at, end in zip([0, *ends[:-1]], ends):
                name = names.dictionary[int(code[at])].as_py() if code[at] >= 0 else None
                if out is None or name != now:
                    if out:
                        out.close()
                    if name is None or "/" in name or name.startswith(".") or name in {n for _, n in done}:
                        raise ValueError(f"rows aren't sorted by file, or {name!r} is no name of a file")
                    staged = f"{self.staging}/{uuid.uuid4().hex}"
                    out, now = files.open_output_stream(f"{folder}/{staged}"), name
                    done.append((staged, name))
                    if self.append and _there(files, f"{folder}/{name}"):
                        with files.open_input_stream(f"{folder}/{name}") as old:
                            while block := old.read(_COPY):
                                out.write(block)
                out.write("".join(x + "\n" for x in batch.column(1).slice(at, end - at).to_pylist() if x is not None).encode())
        if out:
            out.close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = place(self.path)
        moves = [list(m) for w in messages if w for m in w.files]
        names = [n for _, n in moves]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise ValueError("a file's rows came from several tasks")
        files.create_dir(folder)
        drop = [n for n in _names(files, folder) if self.pattern and re.fullmatch(self.pattern, n) and n not in set(names)]
        journal, hidden = f"{JOURNAL}{self.staging.removeprefix(STAGING)}", f"{folder}/{self.staging}.journal"
        # The journal appears by a move, so that it is there whole or not at all.
        with files.open_output_stream(hidden) as f:
            f.write(json.dumps({"staging": self.staging, "move": moves, "drop": drop}).encode())
        files.move(hidden, f"{folder}/{journal}")
        _published(files, folder, journal)

    def abort(self, messages: list[Written | None]) -> None:
        files, folder = place(self.path)
        _dropped(files, f"{folder}/{self.staging}")


class NamedFiles(DataSource):
    """Options: path, and pattern, of the names of files that an overwrite removes where it doesn't write them."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file string, line string"

    def writer(self, schema, overwrite: bool) -> Writer:
        path = self.options["path"]
        recover(path)
        return Writer(path, self.options.get("pattern") if overwrite else None, not overwrite)


def write_lines(rows: DataFrame, path: str, pattern: str | None = None, overwrite: bool = True) -> None:
    """Writes rows(file, line), dealt and sorted by file, as files of these names in the folder. Appending goes on in files that are there."""
    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    options = {"path": path} | ({"pattern": pattern} if pattern else {})
    rows.select("file", "line").write.format("named_files").mode("overwrite" if overwrite else "append").options(**options).save()
