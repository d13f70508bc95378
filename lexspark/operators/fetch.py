"""Fetching through a pluggable client, in batches, one task a group of batches.

A client is any object with fetch(url) -> (success, error_message); make_client builds it within the task, so it needn't
be picklable, and its attribute `timeout` is set to the request's seconds. A request that fails or raises is made again, after
a wait that doubles; what fails in the end is a row of its own and takes nothing from its neighbours. The network is never
touched by the client given here.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexspark.functions import law as L
from lexspark.operators.batching import batches
from lexspark.schema import FETCH_RESULT
from lexspark.session import written


@dataclass(frozen=True)
class FetchConfig:
    batch_size: int = 10
    delay_between_batches: float = 5.0
    retry_attempts: int = 3
    partitions: int = 1  # a site's rate limit is global: more partitions share the delay
    drop_failed_batches: bool = False  # compatible mode: an exception loses the whole batch
    request_timeout: float = 30.0
    delay_between_requests: float = 2.0
    retry_delay: float = 1.0  # before the first repetition, doubled before each further one


class OfflineClient:
    """Deterministic: a fixed share of addresses fails, by digest of the address."""

    timeout = 0.0

    def __init__(self, failing_percent: int = 20):
        self.failing_percent = failing_percent

    def fetch(self, url: str) -> tuple[bool, str | None]:
        ok = int(hashlib.md5(url.encode()).hexdigest()[:8], 16) % 100 >= self.failing_percent
        return ok, None if ok else "offline: not available"

    def close(self) -> None:
        pass


def _request(client: object, url: str, config: FetchConfig) -> tuple[bool, str | None, Exception | None]:
    """success, error, and the exception that the last attempt raised, if it did."""
    got: tuple[bool, str | None, Exception | None] = (False, None, None)
    for attempt in range(max(1, config.retry_attempts)):
        if attempt and config.retry_delay:
            time.sleep(config.retry_delay * 2 ** (attempt - 1))
        try:
            ok, error = client.fetch(url)
            got = (ok, error, None)
        except Exception as e:  # noqa: BLE001
            got = (False, f"{type(e).__name__}: {e}", e)
        if got[0]:
            break
    return got


def _fetch_rows(client: object, rows: Iterator[tuple], config: FetchConfig) -> Iterator[list[tuple]]:
    """Results batch by batch of rows (ord, number, url, batch) in order of batch, however they come in chunks."""
    done: list[tuple] = []
    last, lost = None, False
    for ord_, number, url, k in rows:
        if last is not None:
            if k != last:
                yield done
                done, lost = [], False
                if config.delay_between_batches:
                    time.sleep(config.delay_between_batches * config.partitions)
            elif config.delay_between_requests and not lost:
                time.sleep(config.delay_between_requests * config.partitions)
        last = k
        if lost:
            continue
        began = time.monotonic()
        ok, error, raised = _request(client, url, config)
        if raised is not None and config.drop_failed_batches:
            done, lost = [], True
            continue
        done.append((ord_, k, url, number, ok, time.monotonic() - began, error))
    yield done


def fetch(laws: DataFrame, config: FetchConfig = FetchConfig(), make_client: Callable[[], object] | None = OfflineClient) -> DataFrame:
    """One row per law. E3: a request that raises is a failed row; in compatible mode it drops the rows of its batch and
    ends it. The result is written before it is returned, so that reports don't fetch again."""
    if make_client is None:
        raise ValueError("no fetch client is set up")
    todo = batches(laws.select("ord", "number", L.construct_url(F.col("urn")).alias("url")), config.batch_size)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        try:
            client.timeout = config.request_timeout
            rows = (tuple(r) for f in frames for r in f[["ord", "number", "url", "batch"]].itertuples(index=False))
            for done in _fetch_rows(client, rows, config):
                yield pd.DataFrame(done, columns=FETCH_RESULT.names).astype({"batch": "int32", "ord": "int64"})
        finally:
            client.close()

    placed = todo.repartition(config.partitions, "batch").sortWithinPartitions("batch", "ord")
    return written(placed.mapInPandas(run, FETCH_RESULT), "fetched")
