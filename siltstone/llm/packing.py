"""Packing texts into containers of fixed capacity.

Bounded-space online packing: each partition keeps a fixed number of containers
open, puts an item into the one it fills best, and closes the fullest when none
fits. What is still open at the end of a partition is merged in a second round,
with as many tasks as the number of leftover pieces asks for. Only an item larger than a container is split, into full containers and a
rest that is packed like any item.
"""

from __future__ import annotations

import base64
import bisect
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import materialise

OPEN_CONTAINERS = 256
#: Leftover pieces that one task of the second round takes.
LEFTOVERS_PER_TASK = 200_000
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how text is split before the merges of the rank files.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_counters: dict[str, Callable[[str], int]] = {}


def token_counter(vocabulary: str) -> Callable[[str], int]:
    """Counts tokens by a public vocabulary of byte-pair ranks, kept per worker."""
    if vocabulary not in _counters:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        enc = tiktoken.Encoding("packing", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        _counters[vocabulary] = lambda s: len(enc.encode_ordinary(s))
    return _counters[vocabulary]


def token_sizes(df: DataFrame, key: str, text: str, vocabulary: str = TOKENIZER) -> DataFrame:
    """(key, n): tokens of each text, whole, by a vocabulary file that is sent to the executors. Null and empty texts have none and are left out."""

    name = os.path.basename(vocabulary)
    df.sparkSession.sparkContext.addFile(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(SparkFiles.get(name))
        for b in batches:
            n = np.array([count(s) if s else 0 for s in b.column(1).to_pylist()], np.int64)
            there = pa.array(n > 0)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()).filter(there), pa.array(n).filter(there)], names=["key", "n"])

    return df.select(key, text).mapInArrow(run, "key long, n long")


class OpenContainers:
    """At most `most` open containers, kept sorted by the room left."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.room: list[int] = []
        self.held: list[list] = []

    def add(self, item: object, size: int) -> list[list]:
        """Places an item where it fits best; gives back the containers that this closed."""
        closed = []
        i = bisect.bisect_left(self.room, size)
        if i < len(self.room):
            room, items = self.room.pop(i), self.held.pop(i)
        else:
            if len(self.room) >= self.most:
                self.room.pop(0)
                closed.append(self.held.pop(0))
            room, items = self.capacity, []
        items.append(item)
        left = room - size
        if left:
            j = bisect.bisect_left(self.room, left)
            self.room.insert(j, left)
            self.held.insert(j, items)
        else:
            closed.append(items)
        return closed


_PIECES = "key long, piece int, container string, position int, size int"


class _Names:
    """Containers of one task, named in the order in which they are closed."""

    def __init__(self, round_: str):
        from pyspark import TaskContext

        self.stem, self.n = f"{round_}{TaskContext.get().partitionId()}-", 0

    def rows(self, containers: list[list]) -> pd.DataFrame:
        out = []
        for items in containers:
            at = 0
            for key, piece, size in items:
                out.append((key, piece, f"{self.stem}{self.n}", at, size))
                at += size
            self.n += 1
        return pd.DataFrame(out, columns=["key", "piece", "container", "position", "size"])


def pack(sizes: DataFrame, capacity: int = 2048, open_containers: int = OPEN_CONTAINERS, leave: float = 0.001) -> DataFrame:
    """(key, n) -> (key, piece, container, position, size).

    container names the container, position is the offset of the piece in it;
    piece counts the parts of an item from 0. What is still open at the end of a
    partition with more than the share `leave` of its room unused is packed again
    with the other partitions' leftovers, large pieces first. Items of no or
    negative size, and items without size, take no room and are left out;
    repeated rows are items of their own. Null keys are carried along. An empty
    table gives no rows.
    """

    def first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, bins = _Names("a"), OpenContainers(capacity, open_containers)
        for part in parts:
            full = []
            for key, n in zip(part["key"], part["n"]):
                for piece in range(-(-n // capacity)):
                    size = min(capacity, n - piece * capacity)
                    full += bins.add((key, piece, size), size)
            yield names.rows(full)
        done = [room <= leave * capacity for room in bins.room]
        yield names.rows([items for items, ok in zip(bins.held, done) if ok])
        rest = names.rows([items for items, ok in zip(bins.held, done) if not ok])
        yield rest.assign(container=None)

    def second(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Sorted by size and bounded in number, all of a task's leftovers may stay open.
        names, bins = _Names("b"), OpenContainers(capacity, 2 * LEFTOVERS_PER_TASK)
        for part in parts:
            full = []
            for key, piece, size in zip(part["key"], part["piece"], part["size"]):
                full += bins.add((key, piece, size), size)
            yield names.rows(full)
        yield names.rows(bins.held)

    items = sizes.where("n > 0").select(F.col("key").cast("long").alias("key"), F.col("n").cast("long").alias("n"))
    packed = materialise(items.mapInPandas(first, _PIECES), "packed")
    left = packed.where("container is null").drop("container", "position")
    tasks = max(1, -(-left.count() // LEFTOVERS_PER_TASK))
    left = left.repartition(tasks, F.xxhash64("key", "piece")).sortWithinPartitions(F.desc("size"), "key", "piece")
    return packed.where("container is not null").unionByName(left.mapInPandas(second, _PIECES))
