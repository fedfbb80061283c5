"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups are the rows of equal text. Sorted by size, each enters the bin with the least room that still
holds it, found in a balanced tree of free rooms. The capacity is the smallest (to a
thousandth) for which the wanted number of shards suffices.

Packing is sequential by nature, so it runs at two levels. Each task packs its small groups into
crates of a fixed capacity, itself by best fit decreasing; the crates and the few groups larger than a
crate then go into the shards. The second level sees at most one part-filled crate a task and as many
full ones and large groups as the total holds, whatever the number of rows. A group larger than a
shard stays whole and gets a shard to itself as far as it can.

Defined results: a null text counts as empty. Repeated rows belong to the group of their text. Slots
order the rows of a shard by seeded hash bucket, then by hash and id; equal rows take adjoining slots.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.llm.common import materialize, text_bytes, width

CRATES = 16384


class Rooms:
    """Balanced tree of the free rooms of bins: 64 ways by the digits of a room, all leaves at one depth.

    Entering, leaving and finding the least room of a size or more each take one walk of that depth.
    Equal rooms share a leaf and leave it by the number of the bin.
    """

    def __init__(self, largest: int):
        # A node is known by the digits above it; its bits say which next digits are there.
        self.levels: list[dict[int, int]] = [{} for _ in range(max(1, -(-largest.bit_length() // 6)))]
        self.bins: dict[int, list[int]] = {}

    def add(self, room: int, name: int) -> None:
        heappush(self.bins.setdefault(room, []), name)
        for nodes in self.levels:
            nodes[room >> 6] = nodes.get(room >> 6, 0) | 1 << (room & 63)
            room >>= 6

    def least(self, size: int) -> int | None:
        """The least room of this size or more."""
        for depth, nodes in enumerate(self.levels):
            found = nodes.get(size >> 6, 0) >> (size & 63)
            if found:
                size += _lowest(found)
                for below in reversed(self.levels[:depth]):
                    size = size << 6 | _lowest(below[size])
                return size
            size = (size >> 6) + 1
        return None

    def take(self, size: int) -> tuple[int, int] | None:
        """The tightest bin that holds this size, as (room, bin); it leaves the tree."""
        room = self.least(size)
        if room is None:
            return None
        name = heappop(self.bins[room])
        if not self.bins[room]:
            del self.bins[room]
            digits = room
            for nodes in self.levels:
                nodes[digits >> 6] ^= 1 << (digits & 63)
                digits >>= 6
                if nodes[digits]:
                    break
                del nodes[digits]
        return room, name


def _lowest(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


class OpenBins:
    """Bins of one capacity, each item in the tightest that holds it."""

    def __init__(self, capacity: int, most: int | None = None):
        self.capacity, self.most = capacity, most
        self.rooms = Rooms(capacity)
        self.used = 0

    def put(self, size: int) -> int | None:
        tightest = self.rooms.take(size)
        if tightest is not None:
            room, name = tightest
        elif self.most is None or self.used < self.most:
            room, name = self.capacity, self.used
            self.used += 1
        else:
            return None
        self.rooms.add(room - size, name)
        return name


def pack_shards(sizes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item, by best fit decreasing at the smallest capacity that suffices."""
    order = np.argsort(-sizes, kind="stable")
    total = int(sizes.sum())
    fair = -(-total // shards) if total else 1

    def attempt(capacity: int) -> np.ndarray | None:
        bins, out = OpenBins(capacity, shards), np.zeros(len(sizes), dtype=np.int64)
        for i in order:
            # an item no bin could ever hold opens one of its own
            name = bins.put(min(int(sizes[i]), capacity))
            if name is None:
                return None
            out[i] = name
        return out

    low, high = fair, 2 * fair + (int(sizes[order[0]]) if len(order) else 0)
    best = attempt(low)
    if best is not None:
        return best
    best = attempt(high)
    while high - low > max(1, fair // 1000):
        middle = (low + high) // 2
        found = attempt(middle)
        if found is None:
            low = middle
        else:
            best, high = found, middle
    assert best is not None, "a capacity of twice the mean always suffices"
    return best


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = 5) -> DataFrame:
    """Shard and slot of each row of docs (doc_id, text), groups of equal text kept together.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, shard, slot.
    """
    spark = docs.sparkSession
    rows = materialize(
        docs.select("doc_id", text_bytes().alias("text")).select(
            "doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32("text").alias("text_crc32"),
            F.unhex(F.md5("text")).alias("digest"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    crate = max(1, total // CRATES)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        sizes = table.column("bytes").to_numpy()
        digests = table.column("digest").to_pylist()
        home = table.column("part")[0].as_py()
        order = sorted(range(len(sizes)), key=lambda i: (-int(sizes[i]), digests[i]))
        bins, names = OpenBins(crate), [""] * len(sizes)
        for i in order:
            names[i] = f"{home}-{bins.put(int(sizes[i]))}" if sizes[i] <= crate else "g" + digests[i].hex()
        yield pa.RecordBatch.from_arrays(
            [table.column("digest").combine_chunks(), pa.array(names), table.column("bytes").combine_chunks()],
            names=["digest", "item", "bytes"],
        )

    parts = min(width(spark), 4096)
    spread = groups.withColumn("part", F.pmod(F.crc32("digest"), F.lit(parts)).cast("int"))
    crates = materialize(
        spread.repartitionById(parts, F.col("part")).mapInArrow(fill, "digest binary, item string, bytes long"),
        "shard-crates",
    )

    def assign(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("item", ignore_index=True)
        return items.assign(shard=pack_shards(items["bytes"].to_numpy(), shards).astype("int32"))[["item", "shard"]]

    homes = crates.groupBy("item").agg(F.sum("bytes").alias("bytes")).groupBy().applyInPandas(assign, "item string, shard int")
    placed = crates.join(homes, "item").select("digest", "shard")
    # Slots: rows of a shard by hash bucket; buckets start where the ones before them end.
    buckets = 64 * parts
    out = rows.join(placed, "digest").withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text_crc32"))
    out = materialize(
        out.withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "bucket", "h"),
        "shard-placed",
    )
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = out.groupBy("shard", "bucket").agg(F.count("*").alias("n")).withColumn(
        "start", F.coalesce(F.sum("n").over(before), F.lit(0))
    ).drop("n")
    inside = Window.partitionBy("shard", "bucket").orderBy("h", "doc_id")
    numbered = out.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("place")).cast("long").alias("slot")
    )
