"""Line dedup by a segment-partition edit join.

Two lines are copies if they are equal, or if few edits turn one into the other. A line of at least
`MIN_WORDS` words is a sequence of words, and may differ by one word, or by one in `WORDS_AN_EDIT` if
that is more; any other line is a sequence of characters, and may differ by one in `CHARS_AN_EDIT`.
Only lines of the same kind are compared, by the length of the shorter, and by `MOST` edits at most. A line that may differ
by k edits is cut into k + 1 segments; one of them is untouched in its copy, at a place that the
lengths and the segment's number bound. So a line leaves its segments in an index, and probes it
with the substrings, at each place, that can match. Lines that meet are verified by edit distance
in a band, as bit vectors.

A line's home is the document with the smallest doc_id that has it; it goes from all others. A line
with a close copy whose home is earlier (or the same, and its hash smaller) goes as well. So only
"is there an earlier close copy" is asked of each line, never for the pairs of a group: a line meets
the earliest lines of its group first, and the rest of the group only if none of them is close.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import batches_of, small_batches, stored

MIN_WORDS, WORDS_AN_EDIT, CHARS_AN_EDIT = 8, 20, 20
# A band of 2 * 31 + 1 diagonals; reached at 620 words, or 620 characters of a line with few words.
MOST = 31
# Earliest lines of a group that every line of it meets first.
LEADERS = 16
# Lines, or 200 characters of longer ones, that a block holds of a group, on either side.
BLOCK, LINE_CHARS = 2048, 200
# Before texts are moved for verification, lines that no candidate needs are mostly left out: a
# table of at most so many hash values tells them.
SIEVE = 1 << 20
# Lines a task remembers to leave its postings once; at the bound it starts anew.
SEEN = 500_000
# Rows a batch on the way to the groups; Spark also bounds its bytes.
POSTINGS = 5000
# Postings a task gathers before they leave, in one piece for each part of the index.
ROWS = 100_000
# Index rows of a part that are held before the shared ones leave.
HELD = 1_000_000
# Bytes of lines that are cut together.
CUT = 1 << 18
SEED = 42  # of the engine's xxhash64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
NO_ID = 2 ** 63 - 1
INDEX, PROBE = 1, 2
POSTING = "key long, id long, role int"
PIECE = np.dtype([("key", "<i8"), ("id", "<i8"), ("role", "i1")])


def symbols(line: str) -> tuple[bool, Sequence[str]]:
    """Whether a line counts by words, and its words or characters."""
    words = line.split(" ")
    return (True, words) if len(words) >= MIN_WORDS else (False, line)


def allowed(by_words: bool, length: int) -> int:
    """Edits between lines of which the shorter has this many symbols."""
    if by_words:
        return min(MOST, max(1, length // WORDS_AN_EDIT))
    return min(MOST, length // CHARS_AN_EDIT)


def geometry(by_words: bool, length: int) -> tuple[int, int, int]:
    """(edits, size of a segment, least length) of the lines that are cut like one of this length."""
    edits = allowed(by_words, length)
    size = least = length // (edits + 1)
    least *= edits + 1
    while allowed(by_words, least) < edits:
        least += 1
    return edits, size, least


def places(by_words: bool, length: int) -> list[tuple[int, int, int, int]]:
    """(seed, begin, end, role) of what a line of this length leaves; the seed tells how lines are cut.

    It leaves its segments in the index; what lies behind the last belongs to none. It probes for
    lines that are not longer. If k edits lie in k + 1 segments and the rest, some segment i is
    untouched with i edits before it and at most k - i behind it. So it is found within i places of
    where it begins, and, counted from the end, within k - i.
    """
    found: dict[tuple[int, int, int], int] = {}
    shorter = length
    while shorter > 0:
        edits, size, least = geometry(by_words, shorter)
        longest_gap = min(length - least, edits)
        if not edits or length - shorter > edits or by_words and shorter < MIN_WORDS:
            break
        seed = ((edits * 2 + by_words) << 32) + size
        for i in range(edits + 1):
            if shorter == length:
                found[seed, i * size, (i + 1) * size] = found.get((seed, i * size, (i + 1) * size), 0) | INDEX
            low, high = max(-i, length - shorter - (edits - i)), min(i, longest_gap + edits - i)
            for begin in range(max(0, i * size + low), min(length - size, i * size + high) + 1):
                at = seed, begin, begin + size
                found[at] = found.get(at, 0) | PROBE
        shorter = least - 1
    return [(*at, role) for at, role in found.items()]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _hash(text: str, seed: int = SEED) -> int:
    import xxhash
    return _signed(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed))


def _post(parts: int):
    def post(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(part, probe, piece): the postings of the different lines of a task, by part of the index,
        those that index apart from those that only probe."""
        held, size = [], 0
        for rows in _postings(batches):
            held.append(rows)
            size += len(rows)
            if size >= ROWS:
                yield _pieces(np.concatenate(held), parts)
                held, size = [], 0
        if size:
            yield _pieces(np.concatenate(held), parts)
    return post


def _pieces(rows: np.ndarray, parts: int) -> pd.DataFrame:
    place = (rows["key"].view(np.uint64) % np.uint64(parts)).astype(np.int64) * 2 + (rows["role"] & INDEX == 0)
    order = np.argsort(place, kind="stable")
    place, rows = place[order], rows[order]
    starts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return pd.DataFrame({"part": (place[starts] // 2).astype(np.int32), "probe": place[starts] % 2 == 1,
                         "piece": [rows[a:b].tobytes() for a, b in zip(starts, [*starts[1:], len(rows)])]})


def _postings(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    """Postings of the different lines of a task."""
    import xxhash
    digest = xxhash.xxh64_intdigest
    seen: set[int] = set()
    left: dict[tuple[bool, int], tuple[np.ndarray, ...]] = {}
    held: dict[bool, list[tuple]] = {True: [], False: []}  # lines by words, and by characters
    size = 0
    for batch in batches:
        for text in batch["text"]:
            for line in (text or "").split("\n"):
                whole = line.encode("utf-8", "surrogatepass")
                words = whole.count(b" ") + 1
                kind = (True, words) if words >= MIN_WORDS else (False, len(line))
                if not allowed(*kind):
                    continue
                own = digest(whole, SEED)
                if own in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(own)
                if kind not in left:
                    if len(left) >= 10_000:
                        left.clear()
                    seeds, begins, ends, roles = zip(*places(*kind))
                    left[kind] = (_mixed(np.array(seeds, np.uint64)), np.array(begins), np.array(ends), np.array(roles, np.int8))
                held[kind[0]].append((whole, kind[1], own, left[kind]))
                size += len(whole)
            if size >= CUT:
                yield from (_cut(by_words, *zip(*lines)) for by_words, lines in held.items() if lines)
                held, size = {True: [], False: []}, 0
    yield from (_cut(by_words, *zip(*lines)) for by_words, lines in held.items() if lines)


def _mixed(value: np.ndarray) -> np.ndarray:
    """All bits of each number depend on all others."""
    value = (value ^ value >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ value >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return value ^ value >> np.uint64(31)


BYTES = _mixed(np.arange(1, 257, dtype=np.uint64))


@cache
def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


def _cut(by_words: bool, lines: Sequence[bytes], sizes: Sequence[int], ids: Sequence[int], cuts: Sequence[tuple]) -> np.ndarray:
    """The postings of lines of so many symbols, `cuts` as in `places`.

    A piece of a line is hashed as a polynomial of its bytes modulo 2 ** 64: the difference of two
    sums, moved to power 0. So equal pieces get the same hash at any place.
    """
    text = np.frombuffer(b" ".join(lines) + b" " if by_words else b"".join(lines), np.uint8)
    # Where each symbol of the lines begins; a word ends one before the next begins.
    if by_words:
        starts = np.r_[0, np.flatnonzero(text == 32) + 1]
    else:
        starts = np.r_[np.flatnonzero(text & 0xC0 != 0x80), len(text)]
    size = 1 << len(text).bit_length()
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(BYTES[text] * _powers(BASE, size)[:len(text)], out=sums[1:])
    seeds, begins, ends, roles = (np.concatenate(column) for column in zip(*cuts))
    often = [len(own_roles) for *_, own_roles in cuts]
    first = np.repeat(np.cumsum(sizes) - sizes, often)
    begins, ends = starts[first + begins], starts[first + ends] - by_words
    rows = np.empty(len(roles), PIECE)
    rows["key"] = _mixed((sums[ends] - sums[begins]) * _powers(pow(BASE, -1, 1 << 64), size)[begins] ^ seeds).view(np.int64)
    rows["id"], rows["role"] = np.repeat(np.array(ids, np.uint64), often).view(np.int64), roles
    return rows


def _frame(rows: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"key": rows["key"], "id": rows["id"], "role": rows["role"].astype(np.int32)})


class _Part:
    """The index rows of a part by key. Those of a key with two lines leave, but one is held."""

    def __init__(self) -> None:
        self.new: list[np.ndarray] = []
        self.rows, self.many = np.empty(0, PIECE), np.empty(0, bool)  # one line a key; whether its row has left

    def settle(self) -> np.ndarray:
        """Takes up the new rows; returns those that leave."""
        rows = np.concatenate([self.rows, *self.new])
        left = np.concatenate([self.many, np.zeros(len(rows) - len(self.many), bool)])
        self.new = []
        order = np.argsort(rows["key"], kind="stable")
        rows, left = rows[order], left[order]
        starts = np.flatnonzero(np.r_[True, rows["key"][1:] != rows["key"][:-1]]) if len(rows) else np.empty(0, np.int64)
        sizes = np.diff(np.r_[starts, len(rows)])
        group = np.repeat(np.arange(len(starts)), sizes)
        others = rows["id"] != np.repeat(rows["id"][starts], sizes)
        many = left[starts] | (np.bincount(group, others, minlength=len(starts)) > 0)
        self.rows, self.many = rows[starts], many
        self.keys, self.ids = self.rows["key"].copy(), self.rows["id"].copy()
        return rows[many[group] & ~left]

    def probed(self, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index rows, probes) that leave: of the keys of which another line is held, or two."""
        if not len(self.rows):
            return self.rows, probes[:0]
        wanted = probes["key"].copy()
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        hit[hit] = self.many[at[hit]] | (self.ids[at[hit]] != probes["id"][hit])
        met = np.unique(at[hit])
        met = met[~self.many[met]]
        self.many[met] = True
        return self.rows[met], probes[hit]


def _once(rows: list[np.ndarray]) -> np.ndarray:
    """The different rows: every task that has a line leaves its postings."""
    all_rows = np.concatenate([np.empty(0, PIECE), *rows])
    all_rows = all_rows[np.lexsort((all_rows["role"], all_rows["id"], all_rows["key"]))]
    new = np.ones(len(all_rows), bool)
    new[1:] = all_rows[1:] != all_rows[:-1]
    return all_rows[new]


def _sifted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Postings of the keys with an index row and a row of another line.

    Pieces come by part, those of the index first. So the index of one part is held, one row a key,
    and its probes pass by, whatever their number.
    """
    current, part, waiting, out, size = None, _Part(), 0, [], 0
    for batch in batches:
        for number, probe, piece in zip(batch["part"].tolist(), batch["probe"].tolist(), batch["piece"]):
            if number != current:
                if part.new:
                    out.append(part.settle())
                if out:
                    yield _frame(_once(out))
                current, part, waiting, out, size = number, _Part(), 0, [], 0
            rows, leaving = np.frombuffer(piece, PIECE), []
            if probe:
                if part.new:
                    leaving.append(part.settle())
                leaving += part.probed(rows)
            else:
                part.new.append(rows)
                waiting += len(rows)
                if waiting > HELD:
                    leaving.append(part.settle())
                    waiting = 0
            out += leaving
            size += sum(map(len, leaving))
            if size > HELD:
                out = [_once(out)]
                size = len(out[0])
                if 2 * size > HELD:
                    yield _frame(out[0])
                    out, size = [], 0
    if part.new:
        out.append(part.settle())
    if out:
        yield _frame(_once(out))


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows, sorted by key, role downwards and id, of the keys with an index row and a row of another line.

    A segment is also a probe, at its own place, so a key's first row tells if it is in the index.
    Of the key that goes on into the next batch only that first row and whether another line has
    come are held, whatever the number of its rows.
    """
    key = first = None  # of the last batch's last key: its first line, or none if it is not in the index
    shared, last = False, ()
    for batch in batches:
        rows = [batch[c].to_numpy() for c in ("key", "id", "role")]
        # Every task that has a line leaves its rows: one of them is enough.
        again = np.zeros(len(batch), bool)
        again[1:] = np.logical_and.reduce([r[1:] == r[:-1] for r in rows])
        again[:1] = tuple(r[0] for r in rows if len(r)) == last
        batch = batch[~again]
        if not len(batch):
            continue
        keys, ids, roles = (r[~again] for r in rows)
        last = keys[-1], ids[-1], roles[-1]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        firsts, indexed = ids[starts], roles[starts] & INDEX > 0
        waiting = None
        if key is not None and keys[0] == key:
            indexed[0] = first is not None
            firsts[0] = first if first is not None else 0
            waiting = first if first is not None and not shared else None
        others = np.add.reduceat((ids != np.repeat(firsts, sizes)).astype(np.int64), starts) > 0
        if key is not None and keys[0] == key:
            others[0] |= shared
        good = indexed & others
        out = batch[np.repeat(good, sizes)]
        # The first line of a key whose other lines come in a later batch is one row, left then.
        if waiting is not None and good[0]:
            out = pd.concat([out, pd.DataFrame({"key": [key], "id": [waiting], "role": np.array([INDEX | PROBE], np.int32)})])
        key, first, shared = keys[-1], firsts[-1] if indexed[-1] else None, bool(others[-1])
        if len(out):
            yield out


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, tie, line, id, id2) of each document's different lines with something in them.

    (doc, tie) is the document: rows without a doc_id come last and are told by their texts.
    """
    text = F.col("text").cast("string")
    tie = F.when(F.col("doc_id").isNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))
    return (docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), tie.alias("tie"),
                        F.explode(F.array_distinct(F.split(text, "\n"))).alias("line")).where(F.trim("line") != "")
            .withColumns({"id": F.xxhash64("line"), "id2": F.xxhash64(F.lit(1), F.col("line"))}))


def met(docs: DataFrame) -> DataFrame:
    """(key, id, role): lines that are to be compared, an index row with a probe of the same key.

    Those are the postings under segments that an index row and a probe of another line share. All
    segments that the same lines share are one key: the hashes of these lines together.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("text").cast("string").alias("text"))
    pieces = texts.mapInPandas(_post(parts), "part int, probe boolean, piece binary")
    # Few keys are shared, so few postings are left once the pieces of a part have met.
    sifted = stored(pieces.repartition("part").sortWithinPartitions("part", "probe").mapInPandas(_sifted, POSTING), "line-sifted")
    with batches_of(spark, POSTINGS):
        # The rows of a key come together, those of the index first.
        posted = sifted.repartition("key").sortWithinPartitions("key", F.desc("role"), "id")
        shared = stored(posted.mapInPandas(_shared, POSTING).groupBy("key", "id").agg(F.bit_or("role").alias("role")), "line-shared")
    same = F.bit_xor(F.xxhash64("id", "role")).over(Window.partitionBy("key"))
    return shared.select(same.alias("key"), "id", "role").distinct()


def banded(first: Sequence[Sequence], second: Sequence[Sequence], most: int) -> np.ndarray:
    """Edit distances of pairs of lines, `most` + 1 where they are larger."""
    return np.array([_distance(*sorted(pair, key=len), most) for pair in zip(first, second)], np.int64)


def _distance(a: Sequence, b: Sequence, most: int) -> int:
    """Edit distance of a sequence and one that is no shorter, `most` + 1 if it is larger.

    Beginnings and ends in common need no edit. Between them runs the bit-parallel recurrence on
    the 2 * most + 1 diagonals around the main one: bit i of a vector is row column - most + i.
    """
    begin, n, m = 0, len(a), len(b)
    if m - n > most:
        return most + 1
    while begin < n and a[begin] == b[begin]:
        begin += 1
    while n > begin and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    n, m = n - begin, m - begin
    if n == 0:
        return m
    width = 2 * most + 1
    full = (1 << width) - 1
    rows: dict = {}  # of each symbol, the rows of `b` that have it; row r is at bit r - 1 + most
    for r in range(m):
        symbol = b[begin + r]
        rows[symbol] = rows.get(symbol, 0) | 1 << (r + most)
    # Column 0 counts up from row 0; the rows above it count down towards it.
    plus, minus, lowest = full & ~((1 << (most + 1)) - 1), (1 << (most + 1)) - 1, most
    for j in range(1, n + 1):
        match = rows.get(a[begin + j - 1], 0) >> (j - 1) & full
        # The band moves down a row: the last column's differences move up by one place.
        above_plus, above_minus = plus >> 1, minus >> 1
        zero = ((((match & above_plus) + above_plus) ^ above_plus) | match | above_minus) & full
        across_plus = above_minus | (~(zero | above_plus) & full)
        across_minus = zero & above_plus
        # Down the diagonal of the band's lowest row the distance stays, or grows by one.
        lowest += 1 - (zero >> (width - 1) & 1)
        if lowest > 2 * most + 1 + most:
            return most + 1
        across_plus, across_minus = (across_plus << 1) & full, (across_minus << 1) & full
        plus, minus = across_minus | (~(zero | across_plus) & full), across_plus & zero
    for bit in range(width - 1, m - n + most, -1):  # from the lowest row up to the last of `b`
        lowest += (minus >> bit & 1) - (plus >> bit & 1)
    return min(lowest, most + 1)


def _close(a: Sequence, b: Sequence, most: int) -> bool:
    """Whether at most `most` edits lead from a sequence to one that is no shorter.

    What lies between the beginnings and ends in common takes no more edits than it has symbols.
    An edit takes away one symbol at most, so few can be in only one of the two.
    """
    begin, n, m = 0, len(a), len(b)
    if m - n > most:
        return False
    while begin < n and a[begin] == b[begin]:
        begin += 1
    while n > begin and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    if m - begin <= most:
        return True
    a, b = a[begin:n], b[begin:m]
    if len(set(a).difference(b)) > most or len(set(b).difference(a)) > most:
        return False
    return _distance(a, b, most) <= most


# Rows of a block from which on candidates are sifted as arrays.
MANY = 64


def _late(rows: list[tuple]) -> list[tuple[int, int]]:
    """(id, id2) of the tested lines of a block, in order, that have an earlier close copy in it.

    Rows are (id, id2, role, tested, evidence, line).
    """
    parts = [symbols(row[5]) for row in rows]
    if len(rows) >= MANY:
        kind, size, role = np.array([k for k, _ in parts]), np.array([len(p) for _, p in parts]), np.array([r[2] for r in rows])
        evidence = np.array([r[4] for r in rows])
        # How many symbols of each of eight kinds a line has: an edit changes two of the counts by one.
        counts = np.array([np.bincount([hash(x) & 7 for x in p], minlength=8) for _, p in parts], np.int32)
    gone = []
    for at, (id_, id2, own_role, tested, _, _) in enumerate(rows):
        if not tested:
            continue
        by_words, own = parts[at]
        if len(rows) >= MANY:
            gap = np.abs(size[:at] - size[at])
            earlier = np.nonzero(evidence[:at] & (kind[:at] == by_words) & ((role[:at] | own_role) == INDEX | PROBE) & (gap <= MOST))[0]
            apart = np.abs(counts[earlier] - counts[at]).sum(1)
            earlier = earlier[apart <= 2 * allowed(by_words, len(own))]
        else:
            earlier = [k for k in range(at) if rows[k][4] and rows[k][2] | own_role == INDEX | PROBE and parts[k][0] == by_words]
        for k in earlier:
            other = parts[k][1]
            short, long = (own, other) if len(own) <= len(other) else (other, own)
            most = allowed(by_words, len(short))
            if _close(short, long, most):
                gone.append((id_, id2))
                break
    return gone


def _by_block(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[tuple] = []
    current, names = None, ["key", "low", "high", "id", "id2", "role", "tested", "evidence", "line"]
    for batch in batches:
        gone = []
        for key, low, high, *row in zip(*(batch[n].tolist() for n in names)):
            if (key, low, high) != current:
                gone += _late(held)
                held, current = [], (key, low, high)
            held.append(tuple(row))
        yield pd.DataFrame(gone, columns=["id", "id2"], dtype="int64")
    yield pd.DataFrame(_late(held), columns=["id", "id2"], dtype="int64")


def _flagged(tested: DataFrame, evidence: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, id2) of tested lines with an earlier close copy among the evidence of the same key.

    Both have (key, id, id2, role, weight). A block is one chunk of a key's tested lines with one of
    its evidence, so it is bounded whatever the group, and the lines are copied to blocks only.
    """
    def sized(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("key").agg(F.ceil(F.sum("weight") / F.lit(float(BLOCK))).cast("int").alias(name))

    def chunk(of: str):
        return F.pmod(F.xxhash64("id", "id2"), F.col(of)).cast("int")

    def all_of(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    sizes = sized(tested, "t").join(sized(evidence, "e"), "key")
    row = ["key", "id", "id2", "role"]
    left = (tested.join(sizes, "key").select(*row, chunk("t").alias("low"), all_of("e").alias("high"),
                                             F.lit(True).alias("tested"), F.lit(False).alias("evidence")))
    right = (evidence.join(sizes, "key").select(*row, all_of("t").alias("low"), chunk("e").alias("high"),
                                                F.lit(False).alias("tested"), F.lit(True).alias("evidence")))
    block = ["key", "low", "high"]
    # A line on both sides of a block moves once.
    placed = (left.union(right).groupBy(*row, "low", "high")
              .agg(F.max("tested").alias("tested"), F.max("evidence").alias("evidence")))
    with_text = placed.join(texts.select("id", "id2", "doc", "tie", "line"), ["id", "id2"])

    return (with_text.repartition(*block).sortWithinPartitions(*block, "doc", "tie", "id", "id2")
            .mapInPandas(_by_block, "id long, id2 long").distinct())


def late_lines(docs: DataFrame, homes: DataFrame) -> DataFrame:
    """(id, id2) of the lines that have an earlier close copy; `homes` has (id, id2, doc, tie)."""
    postings = stored(met(docs), "line-postings")
    ids = stored(postings.select("id").distinct(), "line-met")
    wanted = stored(homes.join(ids, "id", "left_semi"), "line-wanted")
    slot = F.pmod("id", F.lit(SIEVE)).alias("slot")
    sieve = ids.select(slot).distinct()  # at most SIEVE rows
    sifted = _lines(docs).select("id", "id2", "line", slot).join(F.broadcast(sieve), "slot", "left_semi").drop("slot")
    texts = stored(sifted.dropDuplicates(["id", "id2"]).join(wanted, ["id", "id2"]), "line-texts")
    weight = F.greatest(F.lit(1.0), F.length("line") / F.lit(float(LINE_CHARS))).alias("weight")
    members = stored(postings.join(texts.select("id", "id2", "doc", "tie", weight), "id"), "line-members")
    order = Window.partitionBy("key").orderBy("doc", "tie", "id", "id2")
    leaders = stored(members.withColumn("place", F.row_number().over(order)).where(F.col("place") <= LEADERS), "line-leaders")
    found = stored(_flagged(members, leaders, texts), "line-late")
    # A leader has met all that are earlier, and so has every line of a key without other lines.
    full = leaders.where(F.col("place") == LEADERS).select("key")
    unsettled = (members.join(found, ["id", "id2"], "left_anti").join(leaders, ["key", "id", "id2"], "left_anti")
                 .join(full, "key", "left_semi"))
    unsettled = stored(unsettled, "line-unsettled")
    rest = stored(members.join(unsettled.select("key").distinct(), "key", "left_semi"), "line-rest")
    return found.union(_flagged(unsettled, rest, texts)).distinct()


def removals(docs: DataFrame) -> DataFrame:
    """(doc, tie, equal, near): hashes of the lines that go, for each document with such."""
    narrow = stored(_lines(docs).select("doc", "tie", "id", "id2"), "line-ids")
    homes = (narrow.groupBy("id", "id2").agg(F.min(F.struct("doc", "tie")).alias("home"), F.count(F.lit(1)).alias("n")))
    homes = stored(homes.select("id", "id2", "home.doc", "home.tie", "n"), "line-homes")
    late = stored(late_lines(docs, homes.drop("n")), "late-lines").withColumn("near", F.lit(True))
    again = homes.where("n > 1").select("id", "id2", F.struct("doc", "tie").alias("home"))
    judged = narrow.join(again, ["id", "id2"], "left").join(late, ["id", "id2"], "left")
    equal = F.coalesce(F.col("home") < F.struct("doc", "tie"), F.lit(False))
    return (judged.withColumn("gone", equal).where(F.col("gone") | F.col("near"))
            .groupBy("doc", "tie").agg(F.collect_set(F.when(F.col("gone"), F.col("id"))).alias("equal"),
                                       F.collect_set(F.when(~F.col("gone"), F.col("id"))).alias("near")))


def _cleaned(text: pd.Series, equal: pd.Series, near: pd.Series) -> pd.DataFrame:
    out = []
    for t, e, n in zip(text, equal, near):
        if t is None:
            out.append((None, 0, 0, 0, []))
            continue
        equal_ids, near_ids = set(e if e is not None else ()), set(n if n is not None else ())
        if not equal_ids and not near_ids:
            some = [line for line in t.split("\n") if line.strip(" ")]
            if len(set(some)) == len(some):
                out.append((t, len(some), 0, 0, []))
                continue
        seen, kept, gone, lines, near_gone = set(), [], [], 0, 0
        for k, line in enumerate(t.split("\n")):
            if not line.strip(" "):
                kept.append(line)
                continue
            lines += 1
            own = _hash(line)
            if own in equal_ids or own in near_ids or own in seen:
                near_gone += own in near_ids and own not in seen
                gone.append(k)
            else:
                kept.append(line)
            seen.add(own)
        out.append(("\n".join(kept), lines, len(gone) - near_gone, near_gone, gone))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_equal", "n_near", "removed"])


def dedup(docs: DataFrame) -> DataFrame:
    """The documents without the lines that go, with n_lines, n_equal, n_near and `removed`.

    Lines are what \\n separates; `removed` has the numbers, from 0, of those that went. Lines of
    nothing but spaces are kept and not counted. A line again in the same document goes as equal.
    Reads doc_id and text; other columns pass through, except that the added ones replace columns
    of the same name. A null text stays null and has no lines. Rows with the same doc_id are one
    document: their lines are no copies of each other's. Rows without one come after all others, and
    are one document if their texts are equal. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    gone = removals(docs)
    added = ["n_lines", "n_equal", "n_near", "removed"]
    passed = [c for c in docs.columns if c.lower() not in added]
    text = F.col("text").cast("string")
    tie = F.when(F.col("doc_id").isNull(), F.coalesce(F.xxhash64(text), F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in passed]).alias("row"), text.alias("text"), tie.alias("tie"),
                        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"))
    joined = given.join(gone, ["doc", "tie"], "left")
    clean = F.pandas_udf(_cleaned, "text string, n_lines long, n_equal long, n_near long, removed array<int>")
    done = joined.withColumn("new", clean("text", "equal", "near"))
    columns = [F.col("new.text").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in passed]
    return done.select(*columns, *[F.col(f"new.{c}") for c in added])
