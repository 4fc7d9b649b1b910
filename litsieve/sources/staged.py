"""Writing files whose names and contents are set by the rows, in two phases.

Tasks write below a staging folder beside the target. A file of an attempt gets its own name
only when it is whole; the attempt that fails leaves nothing that counts. The commit puts the
staging folder in the place of the target with one rename, whatever the number of files; a
job that fails removes it, but for what tasks still write that were not yet stopped. The folder
must be in a store that can rename folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import RecordBatch
from pyarrow.fs import FileSystem, FileType
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

_ATTEMPTS = "_attempts"


def open_store(path: str) -> tuple[FileSystem, str]:
    """(file system, path in it) of a URI or a local path."""
    return FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    partition: int
    rows: int
    files: int


class Staging:
    """The files of one attempt of one task."""

    def __init__(self, path: str):
        self.store, self.path = open_store(path)
        task = TaskContext.get()
        self.partition = task.partitionId()
        self.own = f"{self.path}/{_ATTEMPTS}/{self.partition}-{task.taskAttemptId()}-{uuid.uuid4().hex}"
        self.store.create_dir(self.own, recursive=True)
        self._folders: set[str] = set()

    def write(self, name: str, chunks: Iterator[bytes]) -> None:
        """A whole file, put in place under its name once it is complete."""
        draft = f"{self.own}/draft"
        with self.store.open_output_stream(draft) as out:
            for chunk in chunks:
                out.write(chunk)
        target = f"{self.path}/{name}"
        folder = target.rsplit("/", 1)[0]
        if folder not in self._folders:
            self.store.create_dir(folder, recursive=True)
            self._folders.add(folder)
        self.store.move(draft, target)


class StagedWriter(DataSourceArrowWriter):
    """Calls ``write_files`` in the tasks and ``first_files`` before the commit."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.options, self.overwrite = options, overwrite
        self.path = options["path"].rstrip("/")
        self.staging = f"{self.path}-staging-{uuid.uuid4().hex}"
        store, inside = open_store(self.path)
        if not overwrite and store.get_file_info(inside).type != FileType.NotFound:
            raise FileExistsError(f"{self.path} exists")

    def write_files(self, batches: Iterator[RecordBatch], staging: Staging) -> tuple[int, int]:
        """Write the rows of a task; (rows, files)."""
        raise NotImplementedError

    def first_files(self, messages: list[Written]) -> Iterator[tuple[str, bytes]]:
        """Small files the commit adds, such as a header."""
        return iter(())

    def write(self, iterator: Iterator[RecordBatch]) -> Written:
        staging = Staging(self.staging)
        rows, files = self.write_files(iterator, staging)
        staging.store.delete_dir(staging.own)
        return Written(staging.partition, rows, files)

    def commit(self, messages: list[Written | None]) -> None:
        store, target = open_store(self.path)
        _, staging = open_store(self.staging)
        store.create_dir(staging, recursive=True)
        for name, content in self.first_files([m for m in messages if m is not None]):
            with store.open_output_stream(f"{staging}/{name}") as out:
                out.write(content)
        if store.get_file_info(f"{staging}/{_ATTEMPTS}").type != FileType.NotFound:
            store.delete_dir(f"{staging}/{_ATTEMPTS}")
        with store.open_output_stream(f"{staging}/_SUCCESS") as out:
            out.write(b"")
        if self.overwrite and store.get_file_info(target).type != FileType.NotFound:
            store.delete_dir(target)
        store.move(staging, target)

    def abort(self, messages: list[Written | None]) -> None:
        store, staging = open_store(self.staging)
        if store.get_file_info(staging).type != FileType.NotFound:
            store.delete_dir(staging)


class StagedSource(DataSource):
    """A format with a staged writer."""

    writer_class: type[StagedWriter]

    def writer(self, schema, overwrite: bool) -> StagedWriter:
        return self.writer_class(dict(self.options), overwrite)
