"""Remote classifiers as a plug-in: rows in requests of bounded size, retried, answers as a table."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame

#: Rows in a request; requests and bytes in a chunk of a batch; attempts, longest wait.
PER_REQUEST = 25
CHUNK_REQUESTS, CHUNK_BYTES = 90_000, 96 << 20
ATTEMPTS, LONGEST_WAIT = 6, 60.0
Provider = Callable[[list[dict]], list[dict]]


def chunks(sizes: Sequence[int], most_bytes: int = CHUNK_BYTES, most: int = CHUNK_REQUESTS) -> list[tuple[int, int]]:
    """Consecutive ranges of requests, each as large as both limits allow; one request that is too large goes alone."""
    out, lo, held = [], 0, 0
    for i, n in enumerate(sizes):
        if i > lo and (held + n > most_bytes or i - lo >= most):
            out.append((lo, i))
            lo, held = i, 0
        held += n
    return [*out, (lo, len(sizes))] if sizes else []


def retried(call: Callable, attempts: int = ATTEMPTS, wait: float = 3.0, sleep: Callable[[float], None] = time.sleep):
    """call's result, after up to so many attempts with doubling waits."""
    for i in range(attempts):
        try:
            return call()
        except Exception:
            if i == attempts - 1:
                raise
            sleep(min(LONGEST_WAIT, wait * 2**i))


def ask(rows: DataFrame, provider: Provider, answer: str, per_request: int = PER_REQUEST) -> DataFrame:
    """provider's answers, as a table with the schema answer. It gets lists of row dictionaries and returns lists of answers; rows go out once each.

    Give it distinct rows, and cut its lineage after: a lost task asks again.
    """
    names = [f.split()[0] for f in answer.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            items = frame.to_dict("records")
            for lo in range(0, len(items), per_request):
                got = retried(lambda lo=lo: provider(items[lo : lo + per_request]))
                yield pd.DataFrame([{n: g.get(n) for n in names} for g in got], columns=names)

    return rows.mapInPandas(run, answer)
