"""Fetching from the filing archive, behind an adapter so that tests use stored pages."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from sheafwork.operators.metadata import THROTTLED

# Replies worth another try.
RETRY_STATUS = (400, 401, 403, 500, 502, 503, 504, 505)

Fetcher = Callable[[str], bytes]


class FetchError(Exception):
    """All tries failed."""


def with_retries(get: Fetcher, tries: int = 5, transport_tries: int = 5, backoff: float = 0.2) -> Fetcher:
    """``get`` tried again for network errors, for the replies in ``RETRY_STATUS`` and for throttle notices."""

    def once(url: str) -> bytes:
        for attempt in range(transport_tries):
            try:
                return get(url)
            except OSError as error:
                final = isinstance(error, urllib.error.HTTPError) and error.code not in RETRY_STATUS
                if final or attempt == transport_tries - 1:
                    raise FetchError(f"{url}: {error}") from error
            time.sleep(backoff * 2**attempt)
        raise FetchError(url)

    def fetch(url: str) -> bytes:
        for _ in range(tries):
            body = once(url)
            if THROTTLED.encode() not in body:
                return body
        raise FetchError(f"{url}: throttled")

    return fetch


def http_fetcher(user_agent: str, timeout: float = 60.0, **retries) -> Fetcher:
    """GET over the network; ``retries`` are those of :func:`with_retries`."""

    def get(url: str) -> bytes:
        request = urllib.request.Request(url, headers={"User-agent": user_agent})
        with urllib.request.urlopen(request, timeout=timeout) as reply:
            return reply.read()

    return with_retries(get, **retries)


def fetch_all(urls: DataFrame, fetcher: Fetcher, column: str = "url", keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, url, body, error) for every row; a failed page has a null body and the reason.

    One task fetches its rows one after the other, so the number of partitions
    is the number of connections.
    """
    types = dict(urls.dtypes)
    schema = "".join(f"`{k}` {types[k]}, " for k in keep) + "url string, body binary, error string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            bodies, errors = [], []
            for url in frame[column]:
                try:
                    bodies.append(fetcher(url))
                    errors.append(None)
                except FetchError as error:
                    bodies.append(None)
                    errors.append(str(error))
            yield frame[list(keep)].assign(url=frame[column], body=bodies, error=errors)

    return urls.select(*keep, column).mapInPandas(run, schema)
