"""A batch sink that writes one text file for each row (K4), as a Python data source.

``df.write.format("one_file_a_row").mode("overwrite").save(path)`` takes (folder, name, content) rows and leaves
``path/folder/name`` for each of them. Tasks write into a staging folder of the job beside the target; the commit moves the files of
the tasks that Spark has accepted, so that a repeated or a lost attempt leaves nothing, and an aborted job leaves the
target as it was. Paths are URIs or local names that driver and executors share; pyarrow opens their file system.

Cases: names must be single path steps; a row whose folder or name is null, empty, or leads elsewhere fails the job. Rows that
share folder and name fail it too. A null content is an empty file.
"""

from __future__ import annotations

import posixpath
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

FORMAT = "one_file_a_row"
COLUMNS = ("folder", "name", "content")
MOVES = 32


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a URI or a local name."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    staged: str
    files: list[tuple[str, str]]


class OneFileARow(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "folder string, name string, content string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if tuple(f.name for f in schema.fields) != COLUMNS:
            raise ValueError(f"rows must have the columns {', '.join(COLUMNS)}")
        return _Writer(self.options["path"].rstrip("/"), overwrite)


class _Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.staging = f"{path}._staging-{uuid.uuid4().hex}"
        system, staging = opened(self.staging)
        system.create_dir(staging, recursive=True)  # tasks make folders within it, so that none comes back after an abort

    def write(self, iterator: Iterator) -> Written:
        system, staging = opened(self.staging)
        mine, files, made = posixpath.join(staging, uuid.uuid4().hex), [], set()
        system.create_dir(mine, recursive=False)
        for folder, name, content in iterator:
            for step in (folder, name):
                if not step or "/" in step or step in (".", ".."):
                    raise ValueError(f"not a file name: {step!r}")
            if folder not in made:
                system.create_dir(posixpath.join(mine, folder), recursive=False)
                made.add(folder)
            with system.open_output_stream(posixpath.join(mine, folder, name)) as out:
                out.write((content or "").encode())
            files.append((folder, name))
        return Written(mine, files)

    def commit(self, messages: list[Written | None]) -> None:
        system, target = opened(self.path)
        done = [m for m in messages if m is not None]
        places = [f for m in done for f in m.files]
        if len(set(places)) < len(places):
            self.abort(messages)
            raise ValueError("several rows have the same folder and name")
        if self.overwrite and system.get_file_info(target).type != fs.FileType.NotFound:
            system.delete_dir(target)
        system.create_dir(target, recursive=True)
        for folder in {f for f, _ in places}:
            system.create_dir(posixpath.join(target, folder), recursive=True)
        moves = [(posixpath.join(m.staged, *f), posixpath.join(target, *f)) for m in done for f in m.files]
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(lambda m: system.move(*m), moves))
        self._clean(system)

    def abort(self, messages: list[Written | None]) -> None:
        self._clean(opened(self.path)[0])

    def _clean(self, system: fs.FileSystem) -> None:
        staging = opened(self.staging)[1]
        for wait in (0.0, 0.2, 1.0, 3.0):  # a task that is being stopped may still write
            time.sleep(wait)
            if system.get_file_info(staging).type == fs.FileType.NotFound:
                return
            try:
                system.delete_dir(staging)
                return
            except OSError:
                continue


def write_files(rows: DataFrame, path: str) -> None:
    """Write (folder, name, content) rows as files below ``path``; what stood there goes."""
    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(OneFileARow)
    rows.select(*COLUMNS).write.format(FORMAT).mode("overwrite").save(path)
