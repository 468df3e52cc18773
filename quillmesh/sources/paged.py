"""Landed pages of a paged service as a data source, in batch and as a stream.

A service's answers lie in a folder as page-000001.json and so on, each a JSON
array of objects; fetching them is left to the job that lands them. Pages are
read in ranges, a partition each, straight by the executors, so the folder must
be one that all machines see. Reading stops in a range at its first empty page
(`stop`), as after the last page of a listing, and pages that cannot be read are
skipped while a range has no more than `errors` of them.

As a stream, the offset is the number of the next page; a batch reads the pages
that have landed since, at most `pages` of them.

Options: path, range (pages a partition, 10), stop (true), errors (0), pages (100).
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = re.compile(r"page-(\d+)\.json$")


class PageRange(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        self.first, self.last = first, last


def page_numbers(path: str) -> list[int]:
    return sorted(int(m[1]) for n in os.listdir(path) if (m := NAME.search(n)))


class _Reading:
    """What batch and stream readers share."""

    def __init__(self, schema, options: dict[str, str]) -> None:
        self.names = schema.fieldNames()
        self.path = options["path"].removeprefix("file://")
        self.size, self.errors, self.pages = (int(options.get(k, d)) for k, d in (("range", 10), ("errors", 0), ("pages", 100)))
        self.stop = options.get("stop", "true") == "true"

    def ranges(self, first: int, last: int) -> list[PageRange]:
        return [PageRange(a, min(a + self.size, last)) for a in range(first, last, self.size)]

    def rows(self, part: PageRange | None) -> Iterator[tuple]:
        if part is None:  # of an empty folder
            return
        failed = 0
        for n in range(part.first, part.last):
            try:
                with open(f"{self.path}/page-{n:06d}.json", encoding="utf-8") as f:
                    items = json.load(f)
            except (OSError, ValueError) as wrong:
                failed += 1
                if failed > self.errors:
                    raise RuntimeError(f"{failed} pages of {part.first} to {part.last - 1} cannot be read; {self.errors} are allowed") from wrong
                continue
            if not items and self.stop:
                return
            for item in items:
                yield tuple(item.get(c) if item.get(c) is None or isinstance(item[c], str) else json.dumps(item[c]) for c in self.names)


class PageReader(_Reading, DataSourceReader):
    def partitions(self) -> list[PageRange]:
        numbers = page_numbers(self.path)
        return self.ranges(numbers[0], numbers[-1] + 1) if numbers else []

    def read(self, partition: PageRange) -> Iterator[tuple]:
        return self.rows(partition)


class PageStreamReader(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"page": next(iter(page_numbers(self.path)), 1)}

    def latestOffset(self) -> dict:
        numbers = page_numbers(self.path)
        return {"page": numbers[-1] + 1 if numbers else 1}

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        return self.ranges(start["page"], end["page"])

    def read(self, partition: PageRange) -> Iterator[tuple]:
        return self.rows(partition)

    def commit(self, end: dict) -> None:
        pass


class PagedSource(DataSource):
    """spark.read.format("landed_pages").schema(...).load(path): string columns by name, other values as JSON."""

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def schema(self) -> str:
        return "id string, payload string"

    def reader(self, schema) -> PageReader:
        return PageReader(schema, self.options)

    def streamReader(self, schema) -> PageStreamReader:
        return PageStreamReader(schema, self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PagedSource)
