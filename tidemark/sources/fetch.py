"""Rules of a polite client: which answers to retry, and how long to wait. Requests themselves are made outside Spark."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Codes of answers that pass by themselves, and the longest and first wait in seconds.
RETRY_CODES, LONGEST, FIRST = (10000, 10006, 10016), 8.0, 0.5


class SourceError(Exception):
    """Base of errors of a source."""


class RefusedError(SourceError):
    """The answer has an error code."""


class CorruptPageError(SourceError):
    """A stored body does not match its hash."""


class UnsoundPayloadError(SourceError):
    """A body does not have the expected form."""


#: What the messages of raised rows begin with, and the error each stands for; other errors of a job pass as they are.
_KINDS = (("refused: ", RefusedError), ("corrupt ", CorruptPageError), ("a bar has too few fields", UnsoundPayloadError), ("unsound ", UnsoundPayloadError), ("MALFORMED_RECORD", UnsoundPayloadError))


@contextmanager
def typed() -> Iterator[None]:
    """Errors that rows raise inside a Spark job, as errors of a source."""
    try:
        yield
    except (PySparkException, Py4JJavaError) as e:
        message = str(e)
        for mark, kind in _KINDS:
            if mark in message:
                raise kind(message.splitlines()[0]) from e
        raise


def should_retry(status: Column, code: Column) -> Column:
    """429, server errors and passing codes are asked again; 403 and other refusals fail at once; no status: transport failed."""
    return status.isNull() | (status == 429) | (status >= 500) | ((status == 200) & code.isin(*RETRY_CODES))


def wait_seconds(attempt: Column, reset_in: Column) -> Column:
    """min(8, 0.5 * 2^attempt), extended to the server's reset time where that is under a minute away."""
    own = F.least(F.lit(LONGEST), F.lit(FIRST) * F.pow(F.lit(2.0), attempt))
    return F.when((reset_in > 0) & (reset_in < 60), F.greatest(own, reset_in)).otherwise(own)


def retries(status: int | None, code: int | None) -> bool:
    """``should_retry`` for one answer."""
    return status is None or status == 429 or status >= 500 or (status == 200 and code in RETRY_CODES)


def pause(attempt: int, reset_in: float | None) -> float:
    """``wait_seconds`` for one answer."""
    own = min(LONGEST, FIRST * 2.0**attempt)
    return max(own, reset_in) if reset_in is not None and 0 < reset_in < 60 else own


def paced(requests, per_second: int = 10):
    """Start time of each request (ordered by n) in seconds, at most ``per_second`` a second."""
    return requests.withColumn("start_s", F.col("n") / float(per_second))
