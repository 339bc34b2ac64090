"""A search as a data source: one partition for each planned range of dates."""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from vellum.sources.acquisition import SEARCH_LIMIT, plan_searches


class SearchClient(Protocol):
    """What is searched: how many results a range such as 2001, 2001/02 or 2001/02/28 has, and their ids."""

    def count(self, dates: str) -> int: ...

    def ids(self, dates: str) -> list[str]: ...


class FolderClient:
    """Results kept as files of ids, a line each, under ``YYYY/MM/DD.txt`` of a folder that all executors mount; a stand-in for a remote search."""

    def __init__(self, folder: str):
        self.folder = folder

    def _files(self, dates: str) -> list[str]:
        path = os.path.join(self.folder, *dates.split("/"))
        if os.path.isfile(f"{path}.txt"):
            return [f"{path}.txt"]
        return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".txt"))

    def ids(self, dates: str) -> list[str]:
        out: list[str] = []
        for file in self._files(dates):
            with open(file) as f:
                out += [line.strip() for line in f if line.strip()]
        return out

    def count(self, dates: str) -> int:
        return len(self.ids(dates))


@dataclass
class RangePartition(InputPartition):
    dates: str
    over: bool


class RangeReader(DataSourceReader):
    def __init__(self, client: SearchClient, first: int, last: int, limit: int):
        self.client, self.first, self.last, self.limit = client, first, last, limit

    def partitions(self) -> list[RangePartition]:
        """Years with fewer results than the limit, else their months, else days; a day over the limit is marked."""
        ranges, over = plan_searches(self.first, self.last, self.client.count, self.limit)
        return [RangePartition(r, r in over) for r in ranges]

    def read(self, partition: RangePartition) -> Iterator[tuple[str, str, bool]]:
        for i in self.client.ids(partition.dates):
            yield i, partition.dates, partition.over


class SearchSource(DataSource):
    """Options: ``folder`` (or a client from an own ``client`` method), ``first`` and ``last`` year, ``limit``.

    A range is one partition, so a failed request is tried again alone, by Spark's own retries.
    """

    @classmethod
    def name(cls) -> str:
        return "vellum_search"

    def schema(self) -> str:
        return "id string, dates string, over boolean"

    def client(self) -> SearchClient:
        return FolderClient(self.options["folder"])

    def reader(self, schema: StructType) -> RangeReader:
        return RangeReader(self.client(), int(self.options["first"]), int(self.options["last"]), int(self.options.get("limit", SEARCH_LIMIT)))


def search_ids(spark: SparkSession, first: int, last: int, source: type[SearchSource] = SearchSource, **options: str) -> DataFrame:
    """id, dates, over: the results of every planned range; ``over`` marks days whose results exceed the limit, of which a search gives no more than that."""
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(first=str(first), last=str(last), **options).load()
