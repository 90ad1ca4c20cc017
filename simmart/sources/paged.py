"""Paged JSON source: one Spark partition per range of pages.

A fetcher knows two things: how many records there are, and the JSON text of
the page at an offset. Spark plans a bounded number of ranges of offsets and
each task fetches the pages of its own, so pages never pass through the driver
and the plan does not grow with them. A fetcher whose records lie in blocks that are
read as a whole has methods ``blocks`` and ``block_pages`` too: a partition is then
some whole blocks, and a page that would reach into the next partition is cut
there, so that each block is read once.
"""

from __future__ import annotations

import http.client
import json
import time
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple, Protocol

import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE_ROWS = 1000
RANGES = 1024  # at most
RANGE_PAGES = 8  # at least, where there are as many
FOOTERS_AT_ONCE = 32
SCHEMA = "page_offset bigint, status string, body string, problem string, page_rows bigint"


class PageFetcher(Protocol):
    def total(self) -> int: ...

    def page(self, offset: int, limit: int) -> str: ...


class HttpPages:
    """Pages of an HTTP JSON endpoint taking ``limit`` and ``offset``."""

    def __init__(self, base_url: str, tries: int = 5, wait: float = 4.0, timeout: float = 300.0):
        self.base_url, self.tries, self.wait, self.timeout = base_url, tries, wait, timeout

    def _get(self, query: str) -> str:
        for attempt in range(self.tries):
            try:
                with urllib.request.urlopen(f"{self.base_url}?{query}", timeout=self.timeout) as answer:
                    text = answer.read().decode("utf-8")
                json.loads(text)  # an answer that is cut off is asked for again
                return text
            except (OSError, http.client.HTTPException, ValueError):
                if attempt + 1 == self.tries:
                    raise
                time.sleep(self.wait)
        raise ValueError("tries must be positive")

    def total(self) -> int:
        return int(json.loads(self._get("limit=1"))["page_meta"]["total_count"])

    def page(self, offset: int, limit: int) -> str:
        return self._get(f"limit={limit}&offset={offset}")


class Block(NamedTuple):
    """A row group: its place among the table's rows, and where it lies."""

    start: int
    rows: int
    file: str
    group: int


def cut(start: int, stop: int, limit: int) -> list[tuple[int, int]]:
    """(offset, rows) of the pages between two rows: offsets are multiples of
    the limit, but for a first page that begins within one."""
    offsets = [start, *range((start // limit + 1) * limit, stop, limit)]
    return [(at, min(at - at % limit + limit, stop) - at) for at in offsets] if start < stop else []


class ParquetPages:
    """Pages cut from a Parquet table, in stored row order. Footers are read
    once, to plan; a task reads its own row groups."""

    def __init__(self, path: str, columns: list[str], key: str = "molecules"):
        self.path, self.columns, self.key = path, columns, key
        self._blocks: list[Block] | None = None

    def __getstate__(self) -> dict:
        return vars(self) | {"_blocks": None}  # a task has its own blocks

    def _system(self) -> tuple[pafs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            return pafs.FileSystem.from_uri(self.path)
        return pafs.LocalFileSystem(), self.path

    def blocks(self) -> list[Block]:
        if self._blocks is None:
            system, path = self._system()
            names = [path]
            if system.get_file_info(path).type == pafs.FileType.Directory:
                found = system.get_file_info(pafs.FileSelector(path, recursive=True))
                names = sorted(f.path for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "_.")

            def sizes(name: str) -> list[int]:
                with system.open_input_file(name) as file:
                    footer = pq.read_metadata(file)
                return [footer.row_group(i).num_rows for i in range(footer.num_row_groups)]

            at, self._blocks = 0, []
            with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
                for name, groups in zip(names, pool.map(sizes, names)):
                    for i, rows in enumerate(groups):
                        self._blocks.append(Block(at, rows, name, i))
                        at += rows
        return self._blocks

    def total(self) -> int:
        blocks = self.blocks()
        return blocks[-1].start + blocks[-1].rows if blocks else 0

    def page(self, offset: int, limit: int) -> str:
        """The records from an offset on; the groups that hold them are read."""
        own = [b for b in self.blocks() if b.start < offset + limit and b.start + b.rows > offset]
        stop = min(offset + limit, self.total())
        found = self.block_pages(own, [(offset, max(0, stop - offset))], self.total()) if own else iter(())
        return next((text for *_, text in found), json.dumps(self._envelope([], self.total())))

    def _envelope(self, records: list, total: int) -> dict:
        return {"page_meta": {"total_count": total}, self.key: records}

    def block_pages(self, own: list[Block], pages: list[tuple[int, int]], total: int) -> Iterator[tuple[int, int, str]]:
        """(offset, rows, text) of pages that lie in some consecutive blocks."""
        waiting, at = [], own[0].start
        records = self._records(own)
        for offset, rows in pages:
            while at + len(waiting) < offset + rows:
                waiting += next(records)
            waiting, at = waiting[offset - at :], offset
            yield offset, rows, json.dumps(self._envelope(waiting[:rows], total))

    def _records(self, own: list[Block]) -> Iterator[list[dict]]:
        system, _ = self._system()
        for block in own:
            with system.open_input_file(block.file) as file:
                for batch in pq.ParquetFile(file).iter_batches(PAGE_ROWS, row_groups=[block.group], columns=self.columns):
                    yield batch.to_pylist()


class _Part(InputPartition):
    """Some pages, as a range of offsets or as whole blocks."""

    def __init__(self, offsets: range, blocks: list[Block], total: int):
        super().__init__((offsets, blocks, total))


class _PageReader(DataSourceReader):
    def __init__(self, fetcher: PageFetcher, rows: int):
        self.fetcher, self.rows = fetcher, rows

    def partitions(self) -> list[InputPartition]:
        total = self.fetcher.total()
        if hasattr(self.fetcher, "blocks"):
            return [_Part(range(0), own, total) for own in self._dealt(self.fetcher.blocks())]
        every = range(0, total, self.rows)
        step = max(1, min(RANGE_PAGES, len(every)), -(-len(every) // RANGES))
        return [_Part(every[i : i + step], [], total) for i in range(0, len(every), step)]

    def _dealt(self, blocks: list[Block]) -> Iterator[list[Block]]:
        """Consecutive blocks, of RANGE_PAGES pages together or one."""
        own, rows = [], 0
        for block in blocks:
            own.append(block)
            rows += block.rows
            if rows >= RANGE_PAGES * self.rows:
                yield own
                own, rows = [], 0
        if rows:
            yield own

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition is None or partition.value is None:
            return
        offsets, blocks, total = partition.value
        if not blocks:
            yield from self._one_by_one([(at, min(self.rows, total - at)) for at in offsets])
            return
        pages = cut(blocks[0].start, blocks[-1].start + blocks[-1].rows, self.rows)
        try:
            for offset, rows, text in self.fetcher.block_pages(blocks, pages, total):
                yield offset, "ok", text, None, rows
                pages = pages[1:]
        except Exception:  # the pages not reached are tried by themselves
            yield from self._one_by_one(pages)

    def _one_by_one(self, pages: list[tuple[int, int]]) -> Iterator[tuple]:
        for offset, rows in pages:
            try:
                # A page that ends the table is asked for in full, as the source knows its own end.
                limit = rows if offset % self.rows or hasattr(self.fetcher, "blocks") else self.rows
                yield offset, "ok", self.fetcher.page(offset, limit), None, rows
            except Exception as problem:  # a lost page is a row, not a failed job
                yield offset, "lost", None, f"{type(problem).__name__}: {problem}", rows


def pages(spark: SparkSession, fetcher: PageFetcher, rows: int = PAGE_ROWS, name: str = "paged_json") -> DataFrame:
    """(page_offset, status, body, problem, page_rows), one row per page. The
    offset, never the place, tells the page; page_rows is how many records it
    should hold."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return _PageReader(fetcher, rows)

    spark.dataSource.register(Paged)
    return spark.read.format(name).load()


def good_pages(fetched: DataFrame) -> DataFrame:
    return fetched.where("status = 'ok'")
