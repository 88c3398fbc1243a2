"""Pluggable page providers: text of a page image, and a model's answer to a page.

Real services stay outside; the stubs here are deterministic.  Calls run in ``mapInPandas`` with a
retry loop and never raise: a failure is a row with ``status = 'failed'``.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from importlib.util import find_spec
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.operators.progress import RETRYABLE_ERRORS

#: Modules that only some sources need.
OPTIONAL = {"yaml": "metadata files", "pyarrow": "Arrow batches", "pandas": "Arrow batches"}


def missing_modules(needed: dict[str, str] = OPTIONAL) -> list[str]:
    """Modules that aren't installed, each with what it is for."""
    return [f"{name} ({use})" for name, use in sorted(needed.items()) if find_spec(name) is None]


def wait_seconds(attempt: int, chance: Callable[[], float] = random.random) -> float:
    """1, 2, 4, … seconds, 30 at most, a quarter less or more by chance, 0.1 at least."""
    wait = min(2.0**attempt, 30.0)
    return max(wait + wait * 0.25 * (2 * chance() - 1), 0.1)


class PageModel(Protocol):
    """Gives the raw answer to one page."""

    def __call__(self, pdf: object, page_num: int, text: str) -> str: ...


class ImageReader(Protocol):
    """Gives the text of one page image."""

    def __call__(self, image: bytes) -> str: ...


class EchoModel:
    """Answers with the page's own text as JSON."""

    def __call__(self, pdf: object, page_num: int, text: str) -> str:
        return json.dumps({"page_number": page_num, "body_text": text, "figures": [], "tables": [], "formulas": [], "footnotes": []})


def attempt(call: Callable[[], str], retries: int = 2, wait: Callable[[int], float] = wait_seconds, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None]:
    """(answer, error) of a call that is repeated after errors worth repeating."""
    for k in range(retries + 1):
        try:
            return call(), None
        except Exception as e:  # a service may raise anything; the row carries it
            error = f"{type(e).__name__}: {e}"
            if k == retries or not any(r in error for r in RETRYABLE_ERRORS):
                return None, error
            sleep(wait(k))
    return None, None


def _answered(rows: list, call: Callable, threads: int, retries: int) -> list[tuple[str | None, str | None]]:
    """(answer, error) of a call for each row, ``threads`` at a time, in order of the rows."""
    one = lambda r: attempt(lambda: call(r), retries)
    if threads <= 1:
        return [one(r) for r in rows]
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(one, rows))


def ask(pages: DataFrame, model: PageModel, concurrency: int = 6, documents: int | None = None, retries: int = 2) -> DataFrame:
    """pdf, page_num, raw, status, error for pages (pdf, page_num, text).

    The tasks are the input's partitions, or ``documents`` ones; pages are dealt one by one, so
    that a document of any length is shared.  ``concurrency`` calls run at a time in each task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = _answered(list(batch.itertuples(index=False)), lambda r: model(r.pdf, r.page_num, r.text), concurrency, retries)
            yield pd.DataFrame({"pdf": batch["pdf"], "page_num": batch["page_num"], "raw": [a for a, _ in got], "status": ["failed" if a is None else "ok" for a, _ in got], "error": [e for _, e in got]})

    kind = {f.name: f.dataType.simpleString() for f in pages.schema}
    rows = pages.select("pdf", "page_num", "text")
    dealt = rows.repartition(documents, "pdf", "page_num") if documents else rows
    return dealt.mapInPandas(run, f"pdf {kind['pdf']}, page_num {kind['page_num']}, raw string, status string, error string")


def read_images(images: DataFrame, reader: ImageReader, retries: int = 2) -> DataFrame:
    """pdf, page_num, text of page images (pdf, page_num, image); the text is empty where reading failed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = _answered(list(batch["image"]), lambda image: reader(bytes(image)), 1, retries)
            yield pd.DataFrame({"pdf": batch["pdf"], "page_num": batch["page_num"], "text": [a or "" for a, _ in got]})

    kind = {f.name: f.dataType.simpleString() for f in images.schema}
    return images.select("pdf", "page_num", "image").mapInPandas(run, f"pdf {kind['pdf']}, page_num {kind['page_num']}, text string")


def recover(blocked: DataFrame, model: PageModel, concurrency: int = 10, documents: int | None = None) -> DataFrame:
    """pdf, page_num, success, section, error for blocked pages asked of a second model, once each, ``concurrency`` at a time."""
    asked = ask(blocked, model, concurrency, documents, retries=0)
    return asked.select("pdf", "page_num", (F.col("status") == "ok").alias("success"), F.col("raw").alias("section"), "error")
