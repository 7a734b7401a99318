"""Filling containers of fixed capacity with items.

Bounded-space online best-fit: a lane of items is packed in one pass with a fixed
number of open containers, kept in a bitset keyed by free space.  An item goes
into the open container with the least sufficient space; if there is none and all
places are taken, the fullest container closes first.  Lanes are packed
independently, so the operator scales with their number and memory per lane is
the open containers alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.session import materialise

#: containers open at a time in a lane
OPEN = 256
#: items of a lane, about; a lane leaves at most ``OPEN`` containers unfilled
LANE_ITEMS = 50_000


class BestFit:
    """The open containers of one lane."""

    def __init__(self, capacity: int, separator: int = 0, places: int = OPEN):
        if capacity < 1 or separator < 0 or places < 1:
            raise ValueError("need capacity >= 1, separator >= 0, places >= 1")
        self.capacity, self.separator, self.places = capacity, separator, places
        self.levels: dict[int, list[list[int]]] = {}  # free space -> open containers [number, items]
        self.bits = 0  # bit f is set if a container with f free is open
        self.open = 0
        self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        """(container, position in it) for an item of at most ``capacity``."""
        need = size + self.separator
        fitting = self.bits >> need
        if fitting:
            free = need + (fitting & -fitting).bit_length() - 1
            box = self._take(free)
            free -= need
        else:
            if self.open == self.places:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            box = [self.made, 0]
            self.made += 1
            free = self.capacity - size
        at = box[1]
        box[1] += 1
        if free > self.separator:
            self.levels.setdefault(free, []).append(box)
            self.bits |= 1 << free
            self.open += 1
        return box[0], at

    def _take(self, free: int) -> list[int]:
        level = self.levels[free]
        box = level.pop()
        if not level:
            del self.levels[free]
            self.bits &= ~(1 << free)
        self.open -= 1
        return box


def parts_of(size: int, capacity: int) -> Iterator[int]:
    """Full parts of an oversized item and its remainder; the item itself if it fits."""
    while size > capacity:
        yield capacity
        size -= capacity
    if size > 0:
        yield size


def pack_lane(items: Iterable[tuple], capacity: int, separator: int, places: int = OPEN) -> Iterator[tuple]:
    """(key, part_no, n_parts, tokens, container, position) for (key, size) in order."""
    lane = BestFit(capacity, separator, places)
    for key, size in items:
        parts = list(parts_of(size, capacity))
        for no, tokens in enumerate(parts, 1):
            box, at = lane.place(tokens)
            yield key, no, len(parts), tokens, box, at


def pack(sizes: DataFrame, capacity: int, separator: int = 0, key: str = "doc_id", size: str = "n_tokens", places: int = OPEN, lane_items: int = LANE_ITEMS) -> DataFrame:
    """Containers of every item: key, part_no, n_parts, tokens, lane, container, position.

    ``separator`` is counted between two items of a container.  An item above the
    capacity is cut into full parts and a remainder, each placed like an item; no
    other item is split.  Items of size null or 0 take no room and are placed in
    no container: one row with part_no, n_parts and tokens 0 and container null.
    Items with equal keys are each placed.  (lane, container) names a container.

    Lanes come from a hash of the key; only keys and sizes are shuffled.
    """
    types = dict(sizes.dtypes)
    # written once: the sizes are counted for the number of lanes and read again to be packed
    items = materialise(sizes.select(F.col(key).alias("k"), F.col(size).cast("bigint").alias("s")), "sizes")
    lanes = max(1, -(-items.count() // lane_items))
    laned = items.filter(F.col("s") > 0).withColumn("lane", F.pmod(F.xxhash64("k"), F.lit(lanes)).cast("int"))
    names = ["k", "part_no", "n_parts", "tokens", "lane", "container", "position"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, lane = None, None
        for batch in batches:
            rows = []
            for k, s, at in zip(*(c.to_pylist() for c in batch.columns)):
                if at != current:  # lanes follow each other within a partition
                    current, lane = at, BestFit(capacity, separator, places)
                parts = list(parts_of(s, capacity))
                for no, tokens in enumerate(parts, 1):
                    rows.append((k, no, len(parts), tokens, at, *lane.place(tokens)))
            kinds = [batch.column(0).type, pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    schema = f"k {types[key]}, part_no int, n_parts int, tokens bigint, lane int, container bigint, position int"
    packed = laned.repartition("lane").sortWithinPartitions("lane", "k", "s").mapInArrow(run, schema)
    empty = items.filter(F.col("s").isNull() | (F.col("s") <= 0)).select(
        "k", F.lit(0).alias("part_no"), F.lit(0).alias("n_parts"), F.lit(0).cast("bigint").alias("tokens"),
        F.lit(None).cast("int").alias("lane"), F.lit(None).cast("bigint").alias("container"), F.lit(None).cast("int").alias("position"),
    )
    return packed.unionByName(empty).withColumnRenamed("k", key)


def utilisation(packed: DataFrame, capacity: int, separator: int = 0) -> DataFrame:
    """One row: containers, tokens, share of the capacity in use, separators included."""
    boxes = packed.filter(F.col("container").isNotNull()).groupBy("lane", "container").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"))
    used = F.sum(F.col("t") + F.lit(separator) * (F.col("n") - 1))
    return boxes.agg(F.count("*").alias("n_containers"), F.sum("t").alias("tokens"), (used / (F.count("*") * capacity)).alias("used_share"))
