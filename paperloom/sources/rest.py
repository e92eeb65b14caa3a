"""A catalog's REST interface: pages and cursors as a Spark data source, and requests that rows of a table ask for.

``spark.dataSource.register(CatalogSource)`` and ``spark.read.format("catalog")``: one partition per numbered page, or one
for a cursor, which each answer leads on to. ``ask`` sends one request per row of a table, in tasks. The fetching function
can be put in its place; retries and waits are within a request.

Defined results: an answer without a list of results is an error; results that aren't objects are kept as they are and count
as skipped; with ``errors`` a request that fails is a row with its error, else it fails the job.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Iterator
from typing import Any
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .config import API_CAP, MOST_PAGE  # noqa: F401

#: Seconds a request may take, and how failed ones are repeated.
TIMEOUT, RETRIES, FIRST_WAIT, LONGEST_WAIT = 60, 6, 5.0, 60.0
RETRIED = frozenset({429, 500, 502, 503, 504})


class CatalogError(RuntimeError):
    """A request that failed or an answer that makes no sense."""


def shown_url(url: str, params: dict[str, Any]) -> str:
    """For messages: without the key."""
    shown = {k: "REDACTED" if k == "api_key" else v for k, v in params.items() if v is not None}
    return f"{url}?{urlencode(shown)}"


def fetch_once(url: str, params: dict[str, Any]) -> dict:
    """One answer, which must be a JSON object; parameters that are None are left out."""
    query = urlencode({k: v for k, v in params.items() if v is not None})
    with urlopen(Request(f"{url}?{query}", headers={"Accept": "application/json"}), timeout=TIMEOUT) as answer:  # noqa: S310
        payload = json.loads(answer.read().decode("utf-8"))
    if not isinstance(payload, dict):
        raise CatalogError(f"no JSON object from {shown_url(url, params)}")
    return payload


def asked_wait(error: HTTPError) -> float | None:
    """Seconds that the server asks to wait, if it says so by a number."""
    try:
        seconds = float((error.headers or {}).get("Retry-After") or "nan")
    except ValueError:
        return None
    return None if math.isnan(seconds) else max(0.0, seconds)


class Patience:
    """How long to wait after each failure in a row: doubling, unless the server says."""

    def __init__(self, retries: int = RETRIES):
        self.waits = [FIRST_WAIT * 2**n for n in reversed(range(retries))]

    def after(self, error: OSError) -> float | None:
        """Seconds before the next attempt; None if there should be none. A wait that is too long is an error."""
        served = isinstance(error, HTTPError)
        if not self.waits or (served and error.code not in RETRIED):
            return None
        usual = self.waits.pop()
        if not served:
            return min(usual, LONGEST_WAIT)
        asked = asked_wait(error)
        if (seconds := usual if asked is None else asked) > LONGEST_WAIT:
            raise CatalogError(f"the server asks to wait {seconds:.0f} s") from error
        return seconds


def fetch(url: str, params: dict[str, Any], *, once: Callable[[str, dict], dict] = fetch_once, sleep: Callable[[float], None] = time.sleep, retries: int = RETRIES) -> dict:
    """An answer, after as many attempts as patience allows."""
    patience = Patience(retries)
    while True:
        try:
            return once(url, params)
        except (HTTPError, URLError, TimeoutError) as error:
            if (seconds := patience.after(error)) is None:
                what = f"HTTP {error.code}" if isinstance(error, HTTPError) else "no answer"
                raise CatalogError(f"{what} from {shown_url(url, params)}") from error
        sleep(seconds)


def results_of(answer: Any) -> list:
    results = answer.get("results") if isinstance(answer, dict) else None
    if not isinstance(results, list):
        raise CatalogError("an answer has no list of results")
    return results


def cursor_pages(url: str, params: dict[str, Any], fetcher: Callable[[str, dict], dict] = fetch) -> Iterator[list]:
    """The results of each page in turn, as long as an answer has some and names the next."""
    cursor = "*"
    while cursor:
        answer = fetcher(url, params | {"cursor": cursor})
        results = results_of(answer)
        yield results
        following = (answer.get("meta") or {}).get("next_cursor")
        cursor = following if results and isinstance(following, str) else None


ANSWERS = "key string, page int, ord int, record string, total bigint, error string"


def ask(requests: DataFrame, url: str, fetcher: Callable[[str, dict], dict] = fetch, *, errors: bool = False) -> DataFrame:
    """The results of one request per row of (key, page, params map): rows ANSWERS in the order of each answer.

    Every row costs a request, so they are few, and each goes to a task of its own as far as there are tasks. An answer
    without results is one row without a record.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, page, params in zip(batch["key"], batch["page"], batch["params"], strict=True):
                rows, error, total = [None], None, None
                try:
                    answer = fetcher(url, dict(params))
                    rows = [json.dumps(r, ensure_ascii=False) for r in results_of(answer)] or rows
                    total = (answer.get("meta") or {}).get("count")
                except CatalogError as e:
                    if not errors:
                        raise
                    error = str(e)
                yield pd.DataFrame({"key": key, "page": page, "ord": range(len(rows)), "record": rows, "total": pd.array([total] * len(rows), "Int64"), "error": error})

    spark = requests.sparkSession
    return requests.repartition(spark.sparkContext.defaultParallelism, "key", "page").mapInPandas(run, ANSWERS)


def select_list(fields: list[str], always: tuple[str, ...] = ()) -> str:
    """The columns that the fields need, as the interface takes them."""
    from ..operators.papers import selected_columns

    return ",".join(selected_columns(fields, always))


def work_filters(config, topic_id: str) -> str:
    """The filter of a sample in the interface's own terms, in a fixed order."""
    parts = [f"from_publication_date:{config.from_publication_date}", f"type:{config.work_type}", f"language:{config.language}", "has_abstract:true", f"primary_topic.id:{topic_id.rstrip('/').rsplit('/', 1)[-1]}"]
    return ",".join(parts + ([f"to_publication_date:{config.to_publication_date}"] if config.to_publication_date else []))


def sample_size(count: int) -> int:
    return min(API_CAP, max(count, 5 * count))


class Page(InputPartition):
    def __init__(self, number: int | None):
        self.number = number


class CatalogReader(DataSourceReader):
    """Rows (page, record): each record as JSON text."""

    def __init__(self, options: dict, fetcher: Callable[[str, dict], dict]):
        self.url, self.fetcher = options["url"], fetcher
        self.params = {k[6:]: v for k, v in options.items() if k.startswith("param.")}
        self.size, self.per_page = int(options.get("sample", 0)), int(options.get("per_page", 100))

    def partitions(self) -> list[Page]:
        if not self.size:
            return [Page(None)]
        return [Page(n + 1) for n in range(-(-self.size // self.per_page))]

    def read(self, partition: Page) -> Iterator[tuple]:
        if partition.number is not None:
            yield from self._rows(partition.number, results_of(self._page({"page": partition.number, "sample": self.size})))
            return
        for number, results in enumerate(cursor_pages(self.url, self.params | {"per_page": self.per_page}, self.fetcher), 1):
            yield from self._rows(number, results)

    def _page(self, more: dict) -> dict:
        return self.fetcher(self.url, self.params | {"per_page": self.per_page} | more)

    @staticmethod
    def _rows(number: int, results: list) -> Iterator[tuple]:
        for record in results:
            yield number, json.dumps(record, ensure_ascii=False)


class CatalogSource(DataSource):
    """Options: url, sample (0 for a cursor), per_page, and param.NAME for anything else."""

    fetcher: Callable[[str, dict], dict] = staticmethod(fetch)

    @classmethod
    def name(cls) -> str:
        return "catalog"

    def schema(self) -> str:
        return "page int, record string"

    def reader(self, schema) -> CatalogReader:  # noqa: ARG002
        return CatalogReader(dict(self.options), type(self).fetcher)
