"""Near-duplicate documents by SimHash, joined through a segment-popcount embedding.

A fingerprint is cut into 32 segments of two bits, and each segment becomes its bit count, 0 to 2.
Flipping a bit moves one count by one, so the Manhattan distance of two count vectors never exceeds
the number of differing bits. The segments form three parts. Of `distance` = 4 differing bits, the
two parts that differ least together hold at most 2, so every linked pair is within Manhattan
distance 2 in the vectors of some two parts.

Those vectors are the cells of a grid. A fingerprint goes to its own cell and to all cells one step
away: two vectors within distance 2 have such a cell in common. Pairs that meet in a cell are then
verified on all 64 bits. Only a spanning star per linked group leaves a cell, never its pairs, and
a cell of many fingerprints is compared in pairs of bounded chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import batches_of, stored
from tillstream.llm.graphs import components

WORDS, SEED, DISTANCE = 4, 42, 4
SEGMENTS, PARTS = 32, 3
# Fingerprints of a cell that are compared at once; larger cells go on in pairs of such chunks.
CHUNK = 512
# Whole texts that a Python worker gets at once.
TEXTS = 500
# Hashes whose bits are counted at once.
SLICE = 65_536
LOW_BITS = 0x5555555555555555


def fingerprint_of(text: bytes | None, words: int = WORDS, seed: int = SEED) -> int:
    """The signed 64-bit fingerprint: a bit is set if more than half of the shingle hashes have it."""
    found = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space parts
    if not found:
        return 0
    line = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes).tolist(), ends[min(words, len(found)) - 1:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(ends), SLICE):
        hashes = np.array([digest(line[s:e], seed) for s, e in zip(starts[at:at + SLICE], ends[at:at + SLICE])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp): a fingerprint as a long for each row; 0 where a text is null or has no word."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, words, seed) for t in texts], dtype="int64")
    return docs.select(F.col("doc_id"), of(F.col("text").cast("binary")).alias("fp"))


def counts(fp: Column) -> Column:
    """The vector of segment bit counts, two bits for each of the 32 counts."""
    high, low = F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW_BITS)), fp.bitwiseAND(F.lit(LOW_BITS))
    return F.shiftleft(high.bitwiseAND(low), 1).bitwiseOR(high.bitwiseXOR(low))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _masks() -> list[int]:
    """For each part left out, the bits of all other segments."""
    parts = np.array_split(np.arange(SEGMENTS), PARTS)
    return [sum(3 << 2 * int(s) for s in np.setdiff1d(np.arange(SEGMENTS), part)) for part in parts]


def cells(fps: DataFrame) -> DataFrame:
    """(cell, fp): a fingerprint's own cells and those one step away, leaving out each part once."""
    def around(mask: int) -> list[Column]:
        own = F.col("v").bitwiseAND(F.lit(_signed(mask)))
        steps = F.array(*[F.lit(_signed(1 << 2 * s)) for s in range(SEGMENTS) if mask >> 2 * s & 1])
        # in a field of two bits 0 and 1, and 1 and 2, are one step apart
        small = F.filter(steps, lambda s: own.bitwiseAND(F.shiftleft(s, 1)) == 0)
        large = F.filter(steps, lambda s: own.bitwiseAND(s.bitwiseOR(F.shiftleft(s, 1))) != 0)
        return [F.array(own), F.transform(small, lambda s: own.bitwiseXOR(s)),
                F.transform(large, lambda s: own.bitwiseXOR(s.bitwiseOR(F.shiftleft(s, 1))))]
    near = [cell for mask in _masks() for cell in around(mask)]
    return (fps.select("fp", counts(F.col("fp")).alias("v"))
            .select(F.explode(F.concat(*near)).alias("cell"), "fp"))


def _stars(cell: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest one of its linked group) among rows sorted by cell."""
    if not len(cell):
        return fp, fp
    at, left, right, bits = np.arange(len(cell) - 1), [], [], fp.view(np.uint64)
    for step in range(1, len(cell)):
        at = at[at + step < len(cell)]
        at = at[cell[at + step] == cell[at]]
        if not len(at):
            break
        close = at[np.bitwise_count(bits[at] ^ bits[at + step]) <= distance]
        left.append(close)
        right.append(close + step)
    if not left:
        return fp[:0], fp[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    root = np.arange(len(cell))
    while True:  # both ends take the smaller root, and that of their root, until nothing moves
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if np.array_equal(root, before):
            break
    moved = np.nonzero(root != np.arange(len(cell)))[0]
    return fp[moved], fp[root[moved]]


def _compare(distance: int, most: int | None):
    """Rows (cell, fp) sorted by cell to links; rows of cells with more than `most` come out as they are.

    Columns out: a, b; chunk is null for a link, and for a row of a large cell (a is the cell, b the
    fingerprint) the number of its chunk. At most `most` rows of an open cell are held.
    """
    def links(cell: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        a, b = _stars(cell, fp, distance)
        return pd.DataFrame({"a": a, "b": b, "chunk": pd.array([None] * len(a), dtype="Int64")}).drop_duplicates()

    def large(cell: np.ndarray, fp: np.ndarray, place: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"a": cell, "b": fp, "chunk": pd.array(place // most, dtype="Int64")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell = fp = np.empty(0, np.int64)
        gone = None  # the open cell, if it is a large one, and how many of its rows have gone out
        for batch in batches:
            cell = np.concatenate([cell, batch["cell"].to_numpy(np.int64)])
            fp = np.concatenate([fp, batch["fp"].to_numpy(np.int64)])
            if not len(cell):
                continue
            starts = np.concatenate([[0], np.nonzero(np.diff(cell))[0] + 1, [len(cell)]])
            sizes = np.diff(starts)
            before = np.zeros(len(sizes), np.int64)
            if gone and gone[0] == cell[0]:
                before[0] = gone[1]
            wide = sizes + before > most if most else np.zeros(len(sizes), bool)
            small = ~wide
            small[-1] = False  # the last cell may go on in the next batch
            of_wide, of_small = np.repeat(wide, sizes), np.repeat(small, sizes)
            if wide.any():
                place = np.arange(len(cell)) - np.repeat(starts[:-1] - before, sizes)
                yield large(cell[of_wide], fp[of_wide], place[of_wide])
            if small.any():
                yield links(cell[of_small], fp[of_small])
            gone = (cell[-1], before[-1] + sizes[-1]) if wide[-1] else None
            held = len(cell) if wide[-1] else starts[-2]
            cell, fp = cell[held:], fp[held:]
        if len(cell):
            yield links(cell, fp)
    return run


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) with a spanning set of the links between different fingerprints of `fps`.

    Both are joined by links of at most `distance` bits, perhaps through others. The parts fit
    distances up to 5: of the differing bits, the two parts with the fewest hold at most 2.
    """
    if distance * (PARTS - 1) // PARTS > 2:
        raise ValueError("cells one step away do not cover this distance")
    schema = "a long, b long, chunk long"
    met = stored(cells(fps.select("fp").distinct()).repartition("cell").sortWithinPartitions("cell", "fp")
                 .mapInPandas(_compare(distance, CHUNK), schema), "simhash-cells")
    rows = met.where("chunk is not null").select(F.col("a").alias("cell"), F.col("b").alias("fp"), "chunk")
    most = rows.groupBy("cell").agg(F.max("chunk").alias("last"))
    # each pair of chunks of a large cell, and each chunk with itself, is a block of its own
    blocks = (rows.join(most, "cell")
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
              .select(F.xxhash64("cell", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("cell"), "fp"))
    split = (blocks.repartition("cell").sortWithinPartitions("cell", "fp")
             .mapInPandas(_compare(distance, None), schema))
    return met.where("chunk is null").select("a", "b").union(split.select("a", "b")).distinct()


def cluster(docs: DataFrame, distance: int = DISTANCE, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs.

    Reads doc_id and text, whatever other columns there are. Rows are linked if their fingerprints
    differ in at most `distance` bits; component_id is the smallest doc_id that links lead to, the
    row's own included. A null or blank text has the fingerprint 0, which links like any other.
    Repeated rows come back as often as they are there. A row without a doc_id takes part and links
    others; its component_id is null only if no row of the component has an id. Texts of any length
    are read whole. An empty table gives no rows.
    """
    with batches_of(docs.sparkSession, TEXTS):
        rows = stored(fingerprints(docs, words, seed), "fingerprints")
    firsts = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "different-fingerprints")
    roots = components(links(firsts, distance))
    rooted = firsts.join(roots, firsts["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         "component_id")
