"""Micro-batches merged into a table by the batch plans."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.runtime import delete, exists, move, names_in

Merge = Callable[[DataFrame, DataFrame], DataFrame]
BUCKETS = 64


class VersionedTable:
    """A Parquet table in buckets by hash of its keys, each bucket a directory that is
    never changed. A head says which versions of the buckets hold; a batch writes the
    buckets that it touches anew and then a new head, so a merge may read the table
    that it replaces, readers see whole batches, and a batch that is delivered twice
    is merged once. Versions that neither the present head nor the one before it
    names are deleted.

    A head that is there and can't be read is an error, never an empty table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets

    def _heads(self) -> list[int]:
        """The batches that have a head, in order."""
        found = names_in(self.spark, f"{self.path}/_heads") if exists(self.spark, f"{self.path}/_heads") else []
        return sorted(int(n) for n in found if n.isdigit())

    def _head(self, batch: int) -> dict[int, str]:
        rows = self.spark.read.text(f"{self.path}/_heads/{batch}").collect()
        if len(rows) != 1:
            raise ValueError(f"{self.path}: head of batch {batch} has {len(rows)} lines")
        return {int(k): v for k, v in json.loads(rows[0][0]).items()}

    def last_batch(self) -> int | None:
        return max(self._heads(), default=None)

    def read(self, buckets: set[int] | None = None) -> DataFrame:
        """The table, or some of its buckets."""
        heads = self._heads()
        held = self._head(heads[-1]) if heads else {}
        paths = [f"{self.path}/{v}/_bucket={k}" for k, v in sorted(held.items()) if v and (buckets is None or k in buckets)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def apply(self, incoming: DataFrame, batch: int, merge: Merge) -> None:
        """Merges a batch; merge may only relate rows of equal keys."""
        heads = self._heads()
        if heads and heads[-1] >= batch:
            return
        touched = {r[0] for r in incoming.select(self._bucket()).distinct().collect()}
        held = self._head(heads[-1]) if heads else {}
        version = f"v-{batch}-{uuid.uuid4().hex}"
        if touched:
            new = merge(incoming, self.read(touched))
            new.withColumn("_bucket", self._bucket()).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{version}")
            here = set(names_in(self.spark, f"{self.path}/{version}"))
            held |= {k: version if f"_bucket={k}" in here else "" for k in touched}
        line = self.spark.createDataFrame([(json.dumps(held),)], "value string").coalesce(1)
        # A head is one directory, committed as a whole; what a failed attempt left goes first.
        attempt = f"{self.path}/_attempts/{version}"
        line.write.text(attempt)
        move(self.spark, attempt, f"{self.path}/_heads/{batch}")
        self._tidy([*heads, batch])

    def _tidy(self, heads: list[int]) -> None:
        for old in heads[:-2]:
            delete(self.spark, f"{self.path}/_heads/{old}")
        named = {v for h in heads[-2:] for v in self._head(h).values()}
        for name in names_in(self.spark, self.path):
            if name.startswith("v-") and name not in named:
                delete(self.spark, f"{self.path}/{name}")


def merge_stream(stream: DataFrame, table: VersionedTable, merge: Merge, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Starts a query that merges each micro-batch into the table."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: table.apply(df, n, merge))
    return (writer.trigger(availableNow=True) if available_now else writer).start()
