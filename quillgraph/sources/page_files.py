"""One file for each row, all of them or none: a Python data source that writes in two phases.

Each attempt of a task writes its files into a folder of its own below `<folder>/.staged/<write>/` and tells the driver that
folder's name and its number of files, not the files. Commit moves the files of the attempts that Spark accepted to
their places and deletes what is staged, the files of lost or repeated attempts with it; abort deletes without moving.
Each move replaces one file whole, so a reader sees the old page or the new one. A driver lost while it moves leaves some
pages new and some old; writing again mends that, and `purge` deletes what such a write had staged.

The folder must be one that the driver and all executors see. write_pages deals rows by path, so that equal paths meet in
one task, which fails at the second; nothing is then moved.

Defined cases: an empty table moves nothing; a null content is an empty file; a null or empty path, one that leaves the
folder, is absolute or begins with `.staged` fails the write; other columns are left out.
"""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

STAGED = ".staged"


@dataclass
class Staged(WriterCommitMessage):
    attempt: str
    files: int


def checked(path: str | None) -> str:
    """The path in its plain form, if it lies in the folder."""
    plain = os.path.normpath(path) if path else ""
    if not plain or os.path.isabs(plain) or plain.split(os.sep)[0] in ("..", ".", STAGED):
        raise ValueError(f"not a path inside the folder: {path!r}")
    return plain


class PageWriter(DataSourceWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite = folder, overwrite
        self.staged = os.path.join(folder, STAGED, uuid.uuid4().hex)

    def write(self, iterator: Iterator[Row]) -> Staged:
        attempt, n = os.path.join(self.staged, uuid.uuid4().hex), 0
        for n, row in enumerate(iterator, 1):
            name = os.path.join(attempt, checked(row["path"]))
            os.makedirs(os.path.dirname(name), exist_ok=True)
            with open(name, "x", encoding="utf-8", newline="") as f:
                f.write(row["content"] or "")
        return Staged(attempt, n)

    def commit(self, messages: list[Staged | None]) -> None:
        done = [m for m in messages if m is not None and m.files]
        for m in done:
            if sum(len(files) for _, _, files in os.walk(m.attempt)) != m.files:
                raise RuntimeError(f"{m.attempt} doesn't hold the {m.files} files written")
        if not self.overwrite:
            for old, new in self._moves(done):
                if os.path.lexists(new):
                    raise FileExistsError(new)
        for old, new in self._moves(done):
            os.makedirs(os.path.dirname(new), exist_ok=True)
            os.replace(old, new)
        self._delete()

    def _moves(self, done: list[Staged]) -> Iterator[tuple[str, str]]:
        for m in done:
            for at, _, files in os.walk(m.attempt):
                for name in files:
                    old = os.path.join(at, name)
                    yield old, os.path.join(self.folder, os.path.relpath(old, m.attempt))

    def abort(self, messages: list[Staged | None]) -> None:
        self._delete()

    def _delete(self) -> None:
        shutil.rmtree(self.staged, ignore_errors=True)


class PageFiles(DataSource):
    """Option path: the folder. Mode overwrite replaces pages of the same path and leaves others; append fails if there is
    such a page."""

    @classmethod
    def name(cls) -> str:
        return "page_files"

    def writer(self, schema: StructType, overwrite: bool) -> PageWriter:
        return PageWriter(self.options["path"], overwrite)


def write_pages(pages: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """pages (path, content) as files below folder."""
    pages.sparkSession.dataSource.register(PageFiles)
    pages.selectExpr("path", "content").repartition("path").write.format("page_files").mode(mode).option("path", folder).save()


def purge(folder: str) -> None:
    """Delete what broken writes have staged; for when no write is under way."""
    shutil.rmtree(os.path.join(folder, STAGED), ignore_errors=True)
