"""Where books come from and where results go."""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from quillspark.functions import patterns as P

#: Addresses a book is looked for at, in this order; ``{id}`` is its number. The caller names its server.
TEMPLATES = ["{base}/files/{id}/{id}-0.txt", "{base}/cache/epub/{id}/pg{id}.txt", "{base}/files/{id}/{id}.txt"]
WAITS = (1, 2)


def decoded(data: bytes) -> str:
    """Strict UTF-8, else Latin-1."""
    try:
        return data.decode("utf-8-sig")
    except UnicodeDecodeError:
        return data.decode("latin-1")


def fetched(base: str, book_id: str, templates: list[str] | None = None) -> str:
    """A book's text from the first address that gives one with a start mark; three attempts each."""
    import re

    start = re.compile(P.BODY_START)
    last: Exception | None = None
    for template in templates or TEMPLATES:
        for attempt in range(3):
            try:
                with urllib.request.urlopen(template.format(base=base.rstrip("/"), id=book_id), timeout=60) as reply:
                    text = decoded(reply.read())
                if start.search(text):
                    return text
                last = ValueError("no start mark")
                break
            except OSError as e:
                last = e
                if attempt < len(WAITS):
                    time.sleep(WAITS[attempt])
    raise RuntimeError(f"book {book_id}: {last}")


class _Book(InputPartition):
    def __init__(self, book_id: str):
        self.book_id = book_id


class _BookReader(DataSourceReader):
    def __init__(self, options: dict):
        self.base = options["base"]
        self.ids = [x for x in options["ids"].split(",") if x]

    def partitions(self) -> list[InputPartition]:
        return [_Book(i) for i in self.ids]

    def read(self, partition: _Book) -> Iterator[tuple]:
        yield partition.book_id, fetched(self.base, partition.book_id)


class BookSource(DataSource):
    """``spark.read.format("books").option("base", url).option("ids", "1,2")``: one partition per book."""

    @classmethod
    def name(cls) -> str:
        return "books"

    def schema(self) -> str:
        return "book_id string, text string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _BookReader(self.options)


def read_books(spark: SparkSession, path: str) -> DataFrame:
    """(book_id, text) of the text files of a folder; the id is the file's name. Line ends become line feeds."""
    raw = spark.read.format("binaryFile").load(path)
    plain = F.col("content").cast("string")
    strict = F.when(F.is_valid_utf8(plain), plain).otherwise(F.decode("content", "ISO-8859-1"))
    return raw.select(F.regexp_extract("path", r"([^/]+?)(?:\.txt)?$", 1).alias("book_id"), F.regexp_replace(F.ltrim(strict, F.lit("\ufeff")), "\r\n?", "\n").alias("text"))


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents of a known schema, one a file."""
    return spark.read.schema(schema).json(path, multiLine=True)


def write_stage(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """A stage's table, published as a whole or not at all; with ``by`` only the partitions in ``df`` are replaced."""
    w = df.write.mode("overwrite")
    if by:
        w = w.partitionBy(*by).option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_documents(documents: DataFrame, path: str, column: str = "document") -> None:
    """One JSON document a line, whole books."""
    documents.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def stage_complete(spark: SparkSession, path: str) -> bool:
    """Whether a stage's table was committed and has data."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return fs.exists(mark) and fs.getContentSummary(p).getLength() > 0


def unfinished(wanted: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """What a resumed run still has to do."""
    return wanted.join(done.select(*key).distinct(), key, "left_anti")
