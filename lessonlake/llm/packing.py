"""Problem 7: filling fixed-capacity containers with items.

Bounded-space online best-fit: a fixed number of open bins, their free space kept as a bitset (bit f is
set if an open bin has f tokens free), so the tightest bin for an item is the lowest set bit from its size
on. An item that fits nowhere opens a bin; when all are open, the fullest closes first.

Items are (id, size) rows only. They are spread by a hash of the id over as many shards as the total size
asks for, so a shard's size is bounded (about `shard_tokens`) whatever the sources are, and shards run in
parallel, row by row; only a shard's last open bins stay partly empty. An item larger than the capacity is cut into
full containers and a rest, which is packed like any item; no other item is split. Items without tokens
(null or empty texts) need no container. Equal ids are equal items: each row is packed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN_BINS = 256
SHARD_TOKENS = 8_000_000


class Bins:
    """The open containers of one capacity."""

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.bits, self.at, self.n_open, self.made = 0, {}, 0, 0

    def put(self, size: int) -> Iterator[tuple[int, int, int, int]]:
        """(bin, piece number, first token, tokens) of each piece of the next item."""
        piece, start = 1, 0
        while size > self.capacity:
            yield self.made, piece, start, self.capacity
            self.made, piece, start, size = self.made + 1, piece + 1, start + self.capacity, size - self.capacity
        if size <= 0:
            return
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_ = self._take(free, -1)
        else:
            if self.n_open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1, 0)  # the fullest closes
            bin_, free, self.made = self.made, self.capacity, self.made + 1
        yield bin_, piece, start, size
        free -= size
        if free:
            self.at.setdefault(free, []).append(bin_)
            self.bits |= 1 << free
            self.n_open += 1

    def _take(self, free: int, which: int) -> int:
        bin_ = self.at[free].pop(which)
        if not self.at[free]:
            self.bits ^= 1 << free
        self.n_open -= 1
        return bin_


def best_fit(items: Iterable[tuple[object, int]], capacity: int, open_bins: int = OPEN_BINS) -> Iterator[tuple[int, object, int, int, int]]:
    """(bin, id, piece number, first token, tokens) of every piece, in order of arrival."""
    bins = Bins(capacity, open_bins)
    for key, size in items:
        for bin_, *piece in bins.put(size):
            yield bin_, key, *piece


def pack(sizes: DataFrame, capacities: list[tuple[int, int]], key: str = "doc_id", open_bins: int = OPEN_BINS, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(capacity_id, container_id, key, piece_no, start_token, n_tokens) of all pieces, for each capacity.

    sizes: key, n_tokens. capacities: (id, tokens), a short list. A shard's rows come sorted and are packed as they
    come, so a task holds its open bins and a batch of rows, however many items the shard has.
    """
    kind = sizes.schema[key].dataType.simpleString()
    items = sizes.where("n_tokens > 0").select(F.col(key).alias("k"), "n_tokens")
    total = items.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0
    shards = max(1, -(-total // shard_tokens))
    items = items.withColumn("h", F.xxhash64("k")).withColumn("shard", F.pmod(F.shiftrightunsigned("h", 7), F.lit(shards)))
    fields = f"capacity_id int, container_id bigint, `{key}` {kind}, piece_no int, start_token bigint, n_tokens bigint"
    ordered = items.repartition("shard").sortWithinPartitions("shard", "h", "k").select("shard", "k", "n_tokens")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, bins, rows = None, [], []
        for pdf in frames:
            for s, k, n in zip(pdf["shard"].tolist(), pdf["k"].tolist(), pdf["n_tokens"].tolist(), strict=True):
                if s != shard:
                    shard, bins = s, [(i, Bins(c, open_bins)) for i, c in capacities]
                for i, b in bins:
                    for bin_, piece, start, size in b.put(n):
                        rows.append((i, (s << 32) + bin_, k, piece, start, size))
                        if len(rows) >= 50_000:
                            yield pd.DataFrame(rows, columns=NAMES)
                            rows = []
        if rows:
            yield pd.DataFrame(rows, columns=NAMES)

    NAMES = ["capacity_id", "container_id", key, "piece_no", "start_token", "n_tokens"]
    return ordered.mapInPandas(run, fields)


def fill(packed: DataFrame, capacities: DataFrame) -> DataFrame:
    """(capacity_id, capacity_tokens, n_containers, n_tokens, least_containers, fill_ratio) per capacity."""
    bins = packed.groupBy("capacity_id", "container_id").agg(F.sum("n_tokens").alias("n"))
    per = bins.groupBy("capacity_id").agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_tokens"))
    return per.join(capacities, "capacity_id").select(
        "capacity_id", "capacity_tokens", "n_containers", "n_tokens", F.ceil(F.col("n_tokens") / F.col("capacity_tokens")).alias("least_containers"), (F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens"))).alias("fill_ratio")
    )


def checks(packed: DataFrame, sizes: DataFrame, capacities: DataFrame, key: str = "doc_id") -> DataFrame:
    """(capacity_id, capacity_tokens, n_items, n_over, n_cut, n_incomplete) per capacity: items packed, containers over their
    capacity, items cut though they fit, items whose pieces are not the whole; all but the first must be 0."""
    bins = packed.groupBy("capacity_id", "container_id").agg(F.sum("n_tokens").alias("n")).join(capacities, "capacity_id")
    over = bins.groupBy("capacity_id").agg(F.count_if(F.col("n") > F.col("capacity_tokens")).alias("n_over"))
    each = packed.groupBy("capacity_id", key).agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("got")).join(sizes.select(key, F.col("n_tokens").alias("size")), key).join(capacities, "capacity_id")
    items = each.groupBy("capacity_id").agg(
        F.count("*").alias("n_items"), F.count_if((F.col("pieces") > 1) & (F.col("size") <= F.col("capacity_tokens"))).alias("n_cut"), F.count_if(F.col("got") != F.col("size")).alias("n_incomplete")
    )
    return capacities.join(items, "capacity_id").join(over, "capacity_id").select("capacity_id", "capacity_tokens", "n_items", "n_over", "n_cut", "n_incomplete")
