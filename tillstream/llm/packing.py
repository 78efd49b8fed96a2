"""Best-fit packing of token sequences: best-fit decreasing with a segment tree.

The fits depend on nothing but how many pieces there are of each length, so best-fit decreasing
runs over that histogram: at most `capacity` rows, whatever the corpus. Bins with the same content
stay together as a range of bin numbers; a step fills such a range with as many pieces of one
length as fit, which is what the rule does piece by piece. The result is a short list of slots:
pieces number a to b of a length go to such bins at such an offset. Numbering the pieces of a
length and looking up their slots are Spark jobs over all pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import ranked, small_batches, spread, stored
from tillstream.llm.tokens import default_path, encoder

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# Pieces that leave a Python worker at a time.
ROWS = 10_000
# Where documents have an order, places of it that are numbered together.
ORDER_STEP = 4_000


class RoomTree:
    """Segment tree over the remaining capacities: is there an open bin with so much room?"""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.filled = [False] * (2 * self.size)

    def put(self, room: int, there: bool) -> None:
        at = self.size + room
        self.filled[at] = there
        while at > 1:
            at //= 2
            self.filled[at] = self.filled[2 * at] or self.filled[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest room of at least this length that an open bin has."""
        at = self.size + length
        while not self.filled[at]:
            while at & 1:  # a right child: all rooms of the parent above this one are smaller
                at //= 2
            if at == 0:
                return None
            at += 1
            if at & (at - 1) == 0:  # past the last leaf of this level
                return None
        while at < self.size:
            at = 2 * at if self.filled[2 * at] else 2 * at + 1
        return at - self.size


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first piece, first bin, pieces a bin, offset) of best-fit decreasing.

    A slot holds the pieces of its length from `first piece` up to the next slot's.
    """
    tree, open_bins, slots, bins = RoomTree(capacity), {}, [], 0

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            open_bins.setdefault(room, []).append((first, n))
            tree.put(room, True)

    for length in sorted(histogram, reverse=True):
        done, count = 0, histogram[length]
        while done < count:
            room = tree.tightest(length)
            if room is None:
                first, n, room = bins, -(-(count - done) // (capacity // length)), capacity
                bins += n
            else:
                first, n = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    tree.put(room, False)
            each = room // length
            full = min(n, (count - done) // each)
            slots.append((length, done, first, each, capacity - room))
            done += full * each
            leave(room - each * length, first, full)
            first, n = first + full, n - full
            if n and done < count:  # the last pieces of this length
                leave(room - (count - done) * length, first, 1)
                slots.append((length, done, first, each, capacity - room))
                done, first, n = count, first + 1, n - 1
            leave(room, first, n)
    return slots


def _cut(path: str, capacity: int, end_id: int, order: tuple[str, ...]):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *order]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({c: pd.array(x, dtype="Int64") for c, x in zip(columns, zip(*rows))})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end, out = int(end_id).to_bytes(4, "little"), []
        rows = (row for batch in batches for row in zip(
            batch["doc_id"].astype("Int64"), *[batch[c] for c in order], batch["text"]))
        for doc_id, *places, ids in encoder(path).encode_rows(rows):
            ids += end
            total = len(ids) // 4
            edges = [0, *range(total % capacity or capacity, total + 1, capacity)]
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                out.append((doc_id, k, a, b - a, crc32(ids[4 * a:4 * b]), *places))
            if len(out) >= ROWS:
                yield frame(out)
                out = []
        if out:
            yield frame(out)
    return cut


def _in_order(placed: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Sequences numbered from 0 by the first place in the order that any piece of theirs has."""
    first = placed.groupBy("sequence_id").agg(F.min(F.struct(*order)).alias("first"))
    first = first.select("sequence_id", "first.*", F.floor(F.col(order[0]) / ORDER_STEP).alias("bucket"), F.lit(0).alias("all"))
    numbers = ranked(first, ["all"], "bucket", [*order, "sequence_id"], "number").select("sequence_id", "number")
    return placed.join(numbers, "sequence_id").withColumn("sequence_id", F.col("number")).drop("number")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, order: tuple[str, ...] = ()) -> DataFrame:
    """Every piece of every document with its sequence and its place there.

    `order` names whole-number columns by which the documents are meant to be read, such as their
    places in a mix (null: last). Pieces of one length then fill sequences in that order, and the
    sequences are numbered by the earliest document they hold; how many there are stays the same.

    Reads doc_id and text, whatever else the table has. A null text is empty (one token, the end
    id); a null doc_id stays null; repeated rows are packed as often as they come, and equal
    pieces take their places in any order; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        *[F.coalesce(F.col(c).cast("long"), F.lit(2 ** 62)).alias(c) for c in order])
    found = texts.mapInPandas(_cut(path or default_path(), capacity, end_id, order),
                              ", ".join([PIECES, *[f"{c} long" for c in order]]))
    pieces = stored(found, "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = sorted(best_fit(histogram, capacity)) or [(0, 0, 0, 1, 0)]
    lengths, firsts, first_bins, each, offsets = (np.array(x, dtype=np.int64) for x in zip(*slots))
    edges = np.unique(lengths, return_index=True)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        at = np.empty(len(length), dtype=np.int64)
        for size in np.unique(length):  # at most `capacity` lengths
            mine = length == size
            low = edges[1][np.searchsorted(edges[0], size)]
            high = np.searchsorted(lengths, size, side="right")
            at[mine] = low + np.searchsorted(firsts[low:high], rank[mine], side="right") - 1
        nth = rank - firsts[at]
        return pd.DataFrame({"sequence_id": first_bins[at] + nth // each[at],
                             "offset": offsets[at] + nth % each[at] * length})

    bucket = F.floor(F.col(order[0]) / ORDER_STEP) if order else spread(spark, "doc_id", "piece")
    numbered = ranked(pieces.withColumn("bucket", bucket), ["length"], "bucket", [*order, "doc_id", "piece", "ids_crc32"], "rank")
    placed = numbered.withColumn("at", place("length", "rank")) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset", *order)
    return _in_order(stored(placed, "placed"), order).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset") if order else placed
