"""A paged remote table as a Spark data source, for batch reads and for polling.

``register(spark)`` makes it available as format ``road_feed``.
Options: ``url`` of the remote table or ``pages`` (a folder of page files, shared by all
executors), ``limit``, ``pageSize``, ``readers``, ``order`` and ``borough``. Pages are read by
the executors: with a ``limit`` one task per page, else ``readers`` tasks that take turns and
read on until a short page, so that no row is left out. An equality filter on the borough is
sent along with the request when ``spark.sql.python.filterPushdown.enabled`` is true.
"""

import json
import os
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    InputPartition,
)
from pyspark.sql.types import StructType

from roadpulse.schema import RAW, RAW_FIELDS

DEFAULT_ORDER = "data_as_of DESC"
PAGE_SIZE = 1000
READERS = 8
ATTEMPTS = 3
FIRST_DELAY_S = 2.0


def with_retry(call: Callable, attempts: int = ATTEMPTS, delay: float = FIRST_DELAY_S, sleep=time.sleep):
    """Calls again after a failure, waiting twice as long each time; the last failure is raised."""
    for attempt in range(attempts):
        try:
            return call()
        except OSError:
            if attempt == attempts - 1:
                raise
            sleep(delay * 2**attempt)


def fetch_url(url: str, offset: int, limit: int, order: str, borough: str | None) -> tuple[list[dict], int]:
    """Rows of a page and how many rows the page holds."""
    params = {"$limit": limit, "$offset": offset, "$order": order}
    if borough:
        params["borough"] = borough
    with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(params)}", timeout=30) as reply:
        rows = json.load(reply)
    return rows, len(rows)


def fetch_page_file(folder: str, offset: int, limit: int, order: str, borough: str | None) -> tuple[list[dict], int]:
    """Rows of the file ``page-<offset>.json`` and how many it holds before the filter; a missing file is an empty page."""
    path = os.path.join(folder, f"page-{offset}.json")
    if not os.path.exists(path):
        return [], 0
    with open(path) as handle:
        rows = json.load(handle)
    return [r for r in rows if borough is None or r.get("borough") == borough][:limit], len(rows)


class PageRange(InputPartition):
    """The page at ``offset``, and every page ``step`` rows further until a short one where ``step`` is given."""

    def __init__(self, offset: int, size: int, step: int | None = None):
        self.offset = offset
        self.size = size
        self.step = step


class _Feed:
    """The request settings shared by batch and polling reads."""

    def __init__(self, options: dict):
        self.url, self.pages = options.get("url"), options.get("pages")
        if not self.url and not self.pages:
            raise ValueError("option url or pages is needed")
        self.limit = int(options["limit"]) if options.get("limit") is not None else None
        self.page_size = int(options.get("pageSize", PAGE_SIZE))
        self.readers = int(options.get("readers", READERS))
        self.order = options.get("order", DEFAULT_ORDER)
        self.borough = options.get("borough")

    def page_ranges(self) -> list[PageRange]:
        size = self.page_size
        if self.limit is None:
            return [PageRange(k * size, size, self.readers * size) for k in range(self.readers)]
        return [PageRange(offset, min(size, self.limit - offset)) for offset in range(0, self.limit, size)]

    def rows(self, pages: PageRange) -> Iterator[tuple]:
        fetch = fetch_url if self.url else fetch_page_file
        target, offset = self.url or self.pages, pages.offset
        while True:
            found, held = with_retry(lambda: fetch(target, offset, pages.size, self.order, self.borough))
            if held > self.page_size:
                raise ValueError(f"the page at {offset} holds {held} rows, more than pageSize {self.page_size}")
            for row in found:
                yield tuple(None if row.get(name) is None else str(row[name]) for name in RAW_FIELDS)
            if pages.step is None or held < pages.size:
                return
            offset += pages.step


class FeedReader(_Feed, DataSourceReader):
    def pushFilters(self, filters):
        for item in filters:
            if isinstance(item, EqualTo) and item.attribute == ("borough",) and self.borough is None:
                self.borough = item.value
            else:
                yield item

    def partitions(self):
        return self.page_ranges()

    def read(self, partition):
        yield from self.rows(partition)


class FeedPoller(_Feed, DataSourceStreamReader):
    """Each trigger fetches the table once, on the executors; offsets are the moments of the polls."""

    def initialOffset(self):
        return {"poll_ns": 0}

    def latestOffset(self):
        return {"poll_ns": time.time_ns()}

    def partitions(self, start, end):
        return self.page_ranges()

    def read(self, partition):
        yield from self.rows(partition)


class RoadFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "road_feed"

    def schema(self) -> StructType:
        return RAW

    def reader(self, schema) -> DataSourceReader:
        return FeedReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FeedPoller(self.options)


def register(spark) -> None:
    """Makes the source known, and lets Spark hand filters to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RoadFeed)
