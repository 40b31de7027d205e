"""Pages of a REST interface as a Spark data source, and the items in them."""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sluiceway.sources.envelope import envelope

# Fixed values of the paging rules.
PER_PAGE = 100
ATTEMPTS = 3
WAIT_RANGE = (2.0, 10.0)
REQUESTS_PER_SECOND = 10.0
TIMEOUT_SECONDS = 30.0

# fetch(url, params, timeout) -> body of the page as JSON text
Fetcher = Callable[[str, dict, float], str]


def http_fetch(url: str, params: dict, timeout: float) -> str:
    with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(params)}", timeout=timeout) as reply:
        return reply.read().decode("utf-8")


class PageRange(InputPartition):
    """Pages first..last; without a last page the flags in the pages are followed."""

    def __init__(self, first: int, last: int | None) -> None:
        self.first = first
        self.last = last


class PageReader(DataSourceReader):
    def __init__(self, fetch: Fetcher, options: dict) -> None:
        self.fetch = fetch
        self.url = options["url"]
        self.per_page = int(options.get("perPage", PER_PAGE))
        self.pages = int(options["pages"]) if options.get("pages") else None
        self.ranges = min(int(options.get("partitions", 1)), self.pages) if self.pages else 1
        self.attempts = int(options.get("attempts", ATTEMPTS))
        self.wait = (float(options.get("waitMin", WAIT_RANGE[0])), float(options.get("waitMax", WAIT_RANGE[1])))
        self.timeout = float(options.get("timeout", TIMEOUT_SECONDS))
        # The partitions run side by side and share the allowed rate.
        self.interval = self.ranges / float(options.get("requestsPerSecond", REQUESTS_PER_SECOND))

    def partitions(self) -> list[PageRange]:
        if self.pages is None:
            return [PageRange(1, None)]
        borders = [self.pages * i // self.ranges for i in range(self.ranges + 1)]
        return [PageRange(a + 1, b) for a, b in zip(borders, borders[1:])]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        page = partition.first
        while partition.last is None or page <= partition.last:
            started = time.monotonic()
            body = self._page(page)
            yield page, body
            if partition.last is None:
                flags = json.loads(body)
                if not (flags.get("next_page") or flags.get("has_more")):
                    return
            page += 1
            time.sleep(max(0.0, self.interval - (time.monotonic() - started)))

    def _page(self, page: int) -> str:
        """One page; failures are retried with growing waits, then left to Spark's task retry."""
        for attempt in range(1, self.attempts + 1):
            try:
                return self.fetch(self.url, {"page": page, "per_page": self.per_page}, self.timeout)
            except Exception:
                if attempt == self.attempts:
                    raise
                low, high = self.wait
                time.sleep(min(high, max(low, 2.0 ** (attempt - 1))))


def paged_source(fetch: Fetcher = http_fetch) -> type[DataSource]:
    """A data source class named `paged_api` around a fetcher; register it with the session."""

    class PagedApi(DataSource):
        @classmethod
        def name(cls) -> str:
            return "paged_api"

        def schema(self) -> str:
            return "page bigint, body string"

        def reader(self, schema) -> DataSourceReader:
            return PageReader(fetch, self.options)

    return PagedApi


def scan_pages(spark: SparkSession, url: str, fetch: Fetcher = http_fetch, **options) -> DataFrame:
    """page, body. Name the number of `pages` and `partitions` to read ranges of pages in parallel."""
    spark.dataSource.register(paged_source(fetch))
    return spark.read.format("paged_api").options(url=url, **{k: str(v) for k, v in options.items()}).load()


def page_items(body: Column) -> Column:
    """Items of a page as JSON texts: `items`, else `results`, else the page itself."""
    lists = F.from_json(body, "items array<string>, results array<string>")
    return F.coalesce(lists["items"], lists["results"], F.array(body))


def unpack_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """One row per item: the other columns and `item`. An empty list gives no rows."""
    others = [c for c in pages.columns if c != body]
    return pages.select(*others, F.explode(page_items(F.col(body))).alias("item"))


def api_records(pages: DataFrame, url: str) -> DataFrame:
    """Envelopes of the items of raw pages."""
    items = unpack_pages(pages)
    return envelope(items, F.get_json_object("item", "$.id"), F.lit(url), F.col("item"))
