"""A paged pull as a Spark source: ``spark.read.format("playlist_pages")`` and ``readStream`` over numbered pages.

The warehouse loader asked for page after page and followed ``tracks.next``. Here
a pull lands as numbered pages in the shared folder, one file each or one file for pages
that follow one another, in order:

    <path>/pull=<0, 1, ...>/page=<0, 1, ...>/<one file of one JSON line>
    <path>/pull=<0, 1, ...>/pages=<first>-<last>/<one file of a JSON line per page>

and the source reads them as rows (``pull``, ``page``, ``raw``), ``raw`` being the
page's JSON as it landed. A position is ``(pull, page)``, the next page to read. It moves
over landed pages in order, and to the next pull after a page without
``next``. So a page that is missing holds back all that follow, as following
``next`` did, and nothing is skipped when it lands late:

* a batch read gives all pages, or fails (``IncompleteLanding``) if a pull has not
  landed whole;
* a stream gives the pages up to the first missing one, keeps its position in the
  checkpoint, and resumes there.

The driver lists names of files and opens one file a pull (that of the last page in line, for
its ``next``); pages are read by tasks, ``pagesPerTask`` of them each or those of one file, one file in memory at a time.
``path`` must have an address that ``pyarrow.fs`` knows (file, hdfs, s3, gs).

``read_paged`` and ``stream_paged`` parse ``raw`` by the declared page schema within Spark (a
malformed page fails the read) and can keep the whole page as a VARIANT, in which keys that
the schema doesn't name are found too.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..schemas import PAGE
from .pages import IncompleteLanding

FORMAT = "playlist_pages"
PAGES_PER_TASK = 32
#: Pages that ``land_numbered`` puts into a file at most.
PAGES_PER_FILE = 256
_PAGE_FILE = re.compile(r"/page(?:=(\d+)|s=(\d+)-(\d+))/[^/._][^/]*$")


def _numbers(file: str) -> range | None:
    """The numbers of the pages in a file, by its name."""
    m = _PAGE_FILE.search(file)
    return m and (range(int(m[1]), int(m[1]) + 1) if m[1] else range(int(m[2]), int(m[3]) + 1))


@dataclass
class PageRange(InputPartition):
    """Pages of one pull that a task reads: the files with the first number to read of each, and the number to stop before."""

    pull: int
    files: list[tuple[int, str]]
    until: int


class Landing:
    """The numbered pages under a folder."""

    def __init__(self, path: str):
        self.path = path

    def _open(self) -> tuple[pafs.FileSystem, str]:
        fs, at = pafs.FileSystem.from_uri(self.path)
        return fs, at.rstrip("/")

    def pages(self, pull: int) -> dict[int, str]:
        """The files of a pull's landed pages by number."""
        fs, at = self._open()
        found: dict[int, str] = {}
        for info in fs.get_file_info(pafs.FileSelector(f"{at}/pull={pull}", allow_not_found=True, recursive=True)):
            for n in (_numbers(info.path) if info.is_file else None) or ():
                if found.setdefault(n, info.path) != info.path:
                    raise ValueError(f"page {n} of pull {pull} has several files")
        return found

    def pulls(self) -> int:
        """The greatest number of a landed pull, and 1 more."""
        fs, at = self._open()
        found = fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))
        return max((int(i.base_name[5:]) + 1 for i in found if re.fullmatch(r"pull=\d+", i.base_name)), default=0)

    def text(self, file: str) -> str:
        fs, _ = self._open()
        with fs.open_input_stream(file, compression=None) as f:
            return f.read().decode("utf-8")

    def lines(self, file: str) -> dict[int, str]:
        """The pages of a file by number."""
        lines, numbers = self.text(file).strip().split("\n"), _numbers(file)
        if len(lines) != len(numbers) or not all(lines):
            raise ValueError(f"{file} is not one page" if len(numbers) == 1 else f"{file} is not {len(numbers)} pages")
        return dict(zip(numbers, lines, strict=True))

    def is_last(self, file: str, page: int) -> bool:
        """If a page of a file has no ``next`` (none, null or empty)."""
        return not (json.loads(self.lines(file)[page]).get("tracks") or {}).get("next")

    def reached(self, pull: int = 0, page: int = 0) -> tuple[int, int]:
        """The position after all pages that follow one another from ``(pull, page)``."""
        while True:
            files = self.pages(pull)
            while page in files:
                page += 1
            if not page or page - 1 not in files or not self.is_last(files[page - 1], page - 1):
                return pull, page
            pull, page = pull + 1, 0

    def between(self, start: tuple[int, int], end: tuple[int, int], per_task: int) -> list[PageRange]:
        """The pages from one position up to another, in ranges of whole files with ``per_task`` pages, or one file with more."""
        out = []
        for pull in range(start[0], end[0] + 1):
            files, part, first = self.pages(pull), [], 0
            number, until = start[1] if pull == start[0] else 0, end[1] if pull == end[0] else None
            while number in files and number != until:
                after = _numbers(files[number]).stop if until is None else min(_numbers(files[number]).stop, until)
                if part and after - first > per_task:
                    out.append(PageRange(pull, part, number))
                    part = []
                first = first if part else number
                part.append((number, files[number]))
                number = after
            if until is not None and number != until:
                raise FileNotFoundError(f"page {number} of pull {pull} is gone")
            if part:
                out.append(PageRange(pull, part, number))
        return out

    def rows(self, part: PageRange | None) -> Iterator[tuple[int, int, str]]:
        for first, file in part.files if part else ():  # Spark makes one task without a range if there are none
            yield from ((part.pull, n, line) for n, line in self.lines(file).items() if first <= n < part.until)


class PageReader(DataSourceReader):
    def __init__(self, landing: Landing, per_task: int):
        self.landing, self.per_task = landing, per_task

    def partitions(self) -> list[PageRange]:
        end = self.landing.reached()
        if end[1] or end[0] < self.landing.pulls():
            raise IncompleteLanding(f"pull {end[0]} did not land whole: page {end[1]} is missing")
        return self.landing.between((0, 0), end, self.per_task)

    def read(self, partition: PageRange) -> Iterator[tuple[int, int, str]]:
        yield from self.landing.rows(partition)


class PageStreamReader(DataSourceStreamReader):
    def __init__(self, landing: Landing, per_task: int):
        self.landing, self.per_task = landing, per_task
        self.at = (0, 0)

    def initialOffset(self) -> dict:  # noqa: N802
        return {"pull": 0, "page": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        self.at = self.landing.reached(*self.at)
        return {"pull": self.at[0], "page": self.at[1]}

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        return self.landing.between((start["pull"], start["page"]), (end["pull"], end["page"]), self.per_task)

    def read(self, partition: PageRange) -> Iterator[tuple[int, int, str]]:
        yield from self.landing.rows(partition)

    def commit(self, end: dict) -> None:
        self.at = max(self.at, (end["pull"], end["page"]))  # a restarted stream lists no pull before this again


class PlaylistPages(DataSource):
    """Options: ``path``, and ``pagesPerTask`` (default ``PAGES_PER_TASK``)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "pull long, page long, raw string"

    def _of(self) -> tuple[Landing, int]:
        return Landing(self.options["path"]), max(1, int(self.options.get("pagesPerTask", PAGES_PER_TASK)))

    def reader(self, schema) -> PageReader:
        return PageReader(*self._of())

    def streamReader(self, schema) -> PageStreamReader:  # noqa: N802
        return PageStreamReader(*self._of())


def _qualified(spark: SparkSession, path: str) -> str:
    """The address of a folder; one without a scheme lies in Spark's default file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return re.sub(r"^file:/(?!/)", "file:///", uri)


def _parsed(rows: DataFrame, document: bool) -> DataFrame:
    page = F.from_json("raw", PAGE, {"mode": "FAILFAST"})
    whole = [F.parse_json("raw").alias("document")] if document else []
    return rows.select("pull", "page", page.alias("parsed"), *whole).select(
        "pull", "page", "parsed.*", *(["document"] if document else []))


def read_paged(spark: SparkSession, path: str, document: bool = False, pages_per_task: int = PAGES_PER_TASK) -> DataFrame:
    """All pages of whole pulls with ``pull`` and ``page``; ``document``: also each whole page as a VARIANT."""
    spark.dataSource.register(PlaylistPages)
    reader = spark.read.format(FORMAT).option("path", _qualified(spark, path)).option("pagesPerTask", pages_per_task)
    return _parsed(reader.load(), document)


def stream_paged(spark: SparkSession, path: str, document: bool = False, pages_per_task: int = PAGES_PER_TASK) -> DataFrame:
    """The same as a stream, up to the first page that has not landed."""
    spark.dataSource.register(PlaylistPages)
    reader = spark.readStream.format(FORMAT).option("path", _qualified(spark, path)).option("pagesPerTask", pages_per_task)
    return _parsed(reader.load(), document)


def land_numbered(pages: DataFrame, path: str, pull: Column, page: Column, per_file: int = PAGES_PER_FILE) -> str:
    """Write pages (the columns of ``PAGE`` that there are) as numbered files of ``path``.

    Pages that follow one another share a file, ``per_file`` of them at most; a file is written by one task.
    """
    fields = [c for c in PAGE.fieldNames() if c in pages.columns]
    rows = pages.select(pull.alias("pull"), page.alias("page"), F.to_json(F.struct(*fields)).alias("value"),
                        F.floor(page / per_file).alias("block"))
    block = Window.partitionBy("pull", "block")
    rows = rows.withColumn("run", F.col("page") - F.row_number().over(block.orderBy("page")))
    ends = Window.partitionBy("pull", "block", "run")  # within the block's task: a gap in the numbers parts two runs
    rows = rows.withColumn("pages", F.concat_ws("-", F.min("page").over(ends), F.max("page").over(ends)))
    rows = rows.sortWithinPartitions("pull", "pages", "page").select("pull", "pages", "value")
    rows.write.mode("append").partitionBy("pull", "pages").text(path)
    return path
