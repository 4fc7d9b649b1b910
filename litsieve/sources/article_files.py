"""One file per article, in a folder per journal."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import RecordBatch
from pyarrow.fs import FileSelector, FileType
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from litsieve.functions.clean import underscore_spaces
from litsieve.session import deal, materialise
from litsieve.sources.staged import StagedSource, StagedWriter, Staging, open_store


class _Writer(StagedWriter):
    def write_files(self, batches: Iterator[RecordBatch], staging: Staging) -> tuple[int, int]:
        n, last = 0, None
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content").to_pylist()):
                if name == last:  # rows come sorted by name
                    raise ValueError(f"two articles for the file {name}")
                staging.write(name, iter((content.encode(),)))
                n, last = n + 1, name
        return n, n


class ArticleFiles(StagedSource):
    writer_class = _Writer

    @classmethod
    def name(cls) -> str:
        return "article_files"


def safe_name(name: Column) -> Column:
    """One step of a path: no slashes, and none of the beginnings that hide a file."""
    return F.regexp_replace(F.regexp_replace(name, "[/\\\\\\x00-\\x1F]", "_"), "^(?=[._]|$)", "-")


def write_article_files(df: DataFrame, path: str, article: str, text: str, journal: str = "journal",
                        suffix: str = ".txt", overwrite: bool = False) -> None:
    """``<path>/<journal>/<article><suffix>`` for every row with a text.

    Blanks of a journal become underscores. Two rows of one name fail the job: rows of a
    name meet in one task. A task that fails and runs again replaces its own files.
    """
    df.sparkSession.dataSource.register(ArticleFiles)
    folder = safe_name(underscore_spaces(F.coalesce(F.col(journal), F.lit(""))))
    name = F.concat(folder, F.lit("/"), safe_name(F.col(article).cast("string")), F.lit(suffix))
    rows = df.filter(F.col(text).isNotNull() & F.col(article).isNotNull())
    rows = rows.select(name.alias("name"), F.col(text).alias("content"))
    rows = rows.repartition("name").sortWithinPartitions("name")
    rows.write.format("article_files").mode("overwrite" if overwrite else "append").save(path)


#: Files read by one task, about, and bytes of one batch of texts.
_FILES, _BATCH = 1 << 14, 8 << 20


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def _listed(path: str, suffix: str) -> Callable[[Iterator[RecordBatch]], Iterator[RecordBatch]]:
    """(folder, name) of the files in and below each folder."""

    def run(batches: Iterator[RecordBatch]) -> Iterator[RecordBatch]:
        store, root = open_store(path)
        for batch in batches:
            for top in batch.column("folder").to_pylist():
                found = store.get_file_info(FileSelector(f"{root}/{top}" if top else root, recursive=bool(top)))
                inside = [f.path[len(root) :].strip("/") for f in found if f.type == FileType.File]
                split = [p.rpartition("/")[::2] for p in inside if p.endswith(suffix)]
                split = [(f, n) for f, n in split if not any(map(_hidden, [*f.split("/"), n]))]
                for at in range(0, len(split), _FILES):
                    columns = [pa.array(c, pa.string()) for c in zip(*split[at : at + _FILES])]
                    yield RecordBatch.from_arrays(columns, ["folder", "name"])

    return run


def _read(path: str, suffix: str) -> Callable[[Iterator[RecordBatch]], Iterator[RecordBatch]]:
    """(journal, article, text) of the files (folder, name)."""

    def run(batches: Iterator[RecordBatch]) -> Iterator[RecordBatch]:
        store, root = open_store(path)
        own = root.rstrip("/").rpartition("/")[2]

        def texts(rows: list[tuple[str, str, bytes]]) -> RecordBatch:
            journals, articles, contents = zip(*rows)
            columns = pa.array(journals, pa.string()), pa.array(articles, pa.string())
            # bytes as they are, as Spark reads text
            return RecordBatch.from_arrays(
                [*columns, pa.array(contents, pa.binary()).view(pa.string())], ["journal", "article", "text"]
            )

        for batch in batches:
            rows, size = [], 0
            for folder, name in zip(batch.column("folder").to_pylist(), batch.column("name").to_pylist()):
                with store.open_input_stream(f"{root}/{folder}/{name}" if folder else f"{root}/{name}") as file:
                    content = file.read()
                if not content:  # a scan has no row for an empty file either
                    continue
                journal = folder.rpartition("/")[2] or own
                rows.append((journal, name[: len(name) - len(suffix)], content))
                size += len(content)
                if size >= _BATCH:
                    yield texts(rows)
                    rows, size = [], 0
            if rows:
                yield texts(rows)

    return run


def read_article_files(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """(journal, article, text) of the files.

    Tasks list the folders of the journals and read the files dealt out by their number: a scan
    would count each small file as megabytes and have a task for every few dozen. Only the
    names of the journals' folders reach the driver.
    """
    store, root = open_store(path)
    tops = store.get_file_info(FileSelector(root))
    tops = [f.base_name for f in tops if f.type == FileType.Directory and not _hidden(f.base_name)]
    folders = spark.createDataFrame([(t,) for t in ["", *tops]], "folder string")
    files = materialise(folders.mapInArrow(_listed(path, suffix), "folder string, name string"), "files")
    dealt = deal(files, "folder", "name", rows=_FILES)
    return dealt.mapInArrow(_read(path, suffix), "journal string, article string, text string")
