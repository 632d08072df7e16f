"""Raw articles: a folder tree of files, or compressed archives of such a tree."""

from __future__ import annotations

import tarfile
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from corpuscle.operators.corpus import article_paths, decode_articles
from corpuscle.sources.shared import materialise, spread

ARCHIVE_ENDINGS = (".tar", ".tar.gz", ".tgz", ".tar.bz2", ".tar.xz")
_BATCH_BYTES = 16 * 1024 * 1024
_ARTICLES = pa.schema([("doc_seq", pa.int64()), ("path", pa.string()), ("content", pa.binary())])


def open_location(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), urlparse(uri).path
    return pafs.FileSystem.from_uri(uri)


class _Archive(InputPartition):
    def __init__(self, uri: str, number: int):
        self.uri = uri
        self.number = number


class _ArchiveReader(DataSourceReader):
    def __init__(self, location: str):
        self.location = location

    def partitions(self) -> list[_Archive]:
        fs, path = open_location(self.location)
        found = fs.get_file_info(path)
        if found.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.location)
        if found.type == pafs.FileType.File:
            return [_Archive(self.location, 0)]
        names = sorted(
            info.base_name
            for info in fs.get_file_info(pafs.FileSelector(path))
            if info.type == pafs.FileType.File and info.base_name.endswith(ARCHIVE_ENDINGS)
        )
        return [_Archive(f"{self.location.rstrip('/')}/{name}", i) for i, name in enumerate(names)]

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        fs, path = open_location(partition.uri)
        with fs.open_input_stream(path, compression=None) as stream:
            with tarfile.open(fileobj=stream, mode="r|*") as archive:
                yield from _batches(_members(archive, partition.number << 32))


def _members(archive: tarfile.TarFile, first: int) -> Iterator[tuple[int, str, bytes]]:
    files = (member for member in archive if member.isfile())
    for seq, member in enumerate(files, first):
        try:
            content = archive.extractfile(member).read()
        except (OSError, EOFError, tarfile.TarError):
            continue  # an unreadable member is left out
        yield seq, member.name, content


def _batches(articles: Iterator[tuple[int, str, bytes]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, str, bytes]] = []
    size = 0
    for article in articles:
        held.append(article)
        size += len(article[2])
        if size >= _BATCH_BYTES:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(articles: list[tuple[int, str, bytes]]) -> pa.RecordBatch:
    columns = [pa.array(list(values), field.type) for values, field in zip(zip(*articles), _ARTICLES)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARTICLES)


class ArticleArchives(DataSource):
    """``format("article_archives")``: one partition per archive, read as a stream.

    ``doc_seq`` orders articles by archive name, then by place in the archive.
    """

    @classmethod
    def name(cls) -> str:
        return "article_archives"

    def schema(self) -> str:
        return "doc_seq bigint, path string, content binary"

    def reader(self, schema) -> _ArchiveReader:
        return _ArchiveReader(self.options["path"])


def read_archives(spark: SparkSession, location: str) -> DataFrame:
    """``doc_seq, category, doc_id, text`` from one archive or a folder of archives.

    A compressed archive cannot be split, so one task unpacks it; with fewer
    archives than cores the articles are then spread before any further work.
    """
    spark.dataSource.register(ArticleArchives)
    raw = spark.read.format("article_archives").load(location)
    return _articles(spread(raw, "doc_seq"))


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """``doc_seq, category, doc_id, text`` from files ``root/category/filename``.

    Load order is path order. Only paths are sorted to number them; contents
    are read once, and an unreadable file is left out.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", "true")
        .load(root)
    )
    # The sorted listing is written, so that its numbering cannot change.
    listing = materialise(
        files.select("path").orderBy("path").withColumn("doc_seq", F.monotonically_increasing_id()),
        "listing",
    )
    base = urlparse(root).path.rstrip("/")
    below_root = F.substring(F.col("path"), F.locate(base, "path") + F.lit(len(base)), F.lit(1 << 20))
    raw = files.select("path", "content").join(listing, "path")
    return _articles(raw.withColumn("path", F.concat(F.lit(base.rsplit("/", 1)[-1]), below_root)))


def _articles(raw: DataFrame) -> DataFrame:
    return decode_articles(article_paths(raw)).select("doc_seq", "doc_id", "category", "text")
