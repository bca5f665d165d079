"""What several operators share: folds, worker-wide stores, batches of bounded size."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of the id, written as text, falls into a fold; false for a null id."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(False))


def worker_store(key: Any, build: Callable[[], Any]) -> Any:
    """What ``build`` returns, made once per Python worker and kept between its tasks.

    Functions travel to the executors by value, so a module's globals would be
    made anew in every task.
    """
    module = sys.modules.setdefault("lakesieve_worker", types.ModuleType("lakesieve_worker"))
    store = module.__dict__.setdefault("store", {})
    if key not in store:
        store[key] = build()
    return store[key]


class Memo(dict):
    """What a function returned for its last arguments, at most ``2 * size`` of them.

    Entries live in two generations: a full one becomes the old one, and what is asked
    for again moves back. So common words stay, rare ones go, and the memory of a worker
    is bounded whatever it reads.
    """

    def __init__(self, make: Callable[[Any], Any], size: int) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: Any) -> Any:
        value = self.old.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def pieces(texts: Iterable[str | None], limit: int, together: int | None = None) -> Iterator[list[tuple[int, str]]]:
    """Texts by position, cut at white space, in groups of about ``together`` characters.

    What is longer than ``limit``, which ``together`` is if it is left out, is cut. Arrays made from a group are bounded whatever the texts are. A piece after a
    cut begins with the white space it was cut at. A run without white space longer
    than ``limit`` is cut where the limit falls.
    """
    group: list[tuple[int, str]] = []
    held = 0
    for at, text in enumerate(texts):
        text = text or ""
        start = 0
        while len(text) - start > limit:
            end = start + limit
            for space in " \n\t":
                found = text.rfind(space, start + limit // 2, end)
                if found > start:
                    end = found
                    break
            yield [(at, text[start:end])]
            start = end
        group.append((at, text[start:] if start else text))
        held += len(text) - start
        if held >= (together or limit):
            yield group
            group, held = [], 0
    if group:
        yield group
