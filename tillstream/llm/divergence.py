"""How the words of each source differ from those of its language: top terms and source pairs.

A term's value in a group falls with its rarity there and rises with its rarity in the language, so
a term that another one beats or equals in group count (higher), language count (lower) and UTF-8
order (earlier) ranks behind it. Only terms with fewer than k such dominators can be among the k
first: the dominance skyband. Every partition of the counts keeps its own skyband of each group,
the skybands are merged by the same rule, and only what is left is ranked by its exact value.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import batches_of, stored

MIN_DOCS, TOP, SCALE = 3, 200, 1_000_000_000
# Whole texts that a Python worker gets at once, and bytes of one that are split at once.
TEXTS, PIECE = 500, 1 << 20
# Different (group, term) counts held before they go out.
HELD = 1_000_000
# Count rows of a group in a partition whose skyband is taken, about.
GROUP_ROWS = 200_000
# Count rows of a tile of source pairs worked on at once.
TERMS = 8_192
# Sources of a side of a tile, and count rows of a slot of it, about.
SIDE, SLOT_ROWS = 64, 50_000

# A-Z become a-z, bytes of terms stay, all others part them.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, so many at a time that a very long text stays cheap."""
    text = text.translate(_TERM)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, source, term, n, d) partial sums; a row without a term tells that the group is there."""
    counts: dict[tuple, tuple[Counter, Counter]] = {}

    def out() -> Iterator[pd.DataFrame]:
        for (lang, source), (n, d) in counts.items():
            numbers = [np.fromiter(x, np.int64, len(n)) for x in (n.values(), map(d.__getitem__, n))]
            yield pd.DataFrame({"lang": lang, "source": source, "term": [None, *n], "n": np.append(0, numbers[0]),
                                "d": np.append(0, numbers[1])})
        counts.clear()

    for batch in batches:
        for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
            n, d = counts.setdefault((lang, source), (Counter(), Counter()))
            seen: set[bytes] = set()
            for terms in _pieces(text):
                n.update(terms)
                seen.update(terms)
            d.update(seen)
        if sum(len(n) for n, _ in counts.values()) > HELD:
            yield from out()
    yield from out()


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, term, n, total, head): counts of the kept terms, one shuffle by (lang, term).

    total is the term's count in the language, and head marks one row of each (lang, term). Each
    group also has a row with a null term.
    """
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    part = (docs.select(*text).withColumn("text", F.col("text").cast("binary"))
            .mapInPandas(_count, "lang string, source string, term binary, n long, d long"))
    summed = (part.repartition("lang", "term").groupBy("lang", "term", "source")
              .agg(F.sum("n").alias("n"), F.sum("d").alias("d")))
    same = Window.partitionBy("lang", "term")
    kept = (summed.withColumns({"total": F.sum("n").over(same), "docs": F.sum("d").over(same),
                                "head": F.col("source") == F.min("source").over(same)})
            .where(F.col("term").isNull() | (F.col("docs") >= min_docs))
            .select("lang", "source", F.col("term").cast("string").alias("term"), "n", "total", "head"))
    with batches_of(docs.sparkSession, TEXTS):
        return stored(kept, "divergence-counts")


def share(count: Column, total: Column, terms: Column, scale: int = SCALE) -> Column:
    """1 + floor(scale * (count + 1) / (total + terms)), exact also beyond 64 bits.

    Without any kept term there is nothing to share out, and no row asks for the result.
    """
    parts = F.greatest(total + terms, F.lit(1))
    wide = (count + 1).cast("decimal(19,0)") * F.lit(scale).cast("decimal(18,0)")
    return F.lit(1).cast("long") + F.when(count < (1 << 62) // scale, F.call_function("div", (count + 1) * F.lit(scale), parts)) \
        .otherwise(F.call_function("div", wide, parts.cast("decimal(20,0)")))


def excess(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most 1 + scale, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


# -- top terms ----------------------------------------------------------------------------

class Skyband:
    """Terms of a group dominated by fewer than k others.

    Fed by group count falling, then language count rising: so all dominators of a term come before
    it, and a term with k of them also has k among those that stayed. A class of terms equal in both
    counts loses all terms behind the first one that is out.
    """

    def __init__(self, k: int):
        self.k = k
        self.terms: list[str] = []  # those that stay by UTF-8 order, which is that of code points
        self.totals = np.empty(0, np.int64)

    def add(self, total: int, terms: list[str]) -> int:
        """Feeds the terms of a class in their order; how many of them, from the first, stay."""
        rivals = np.flatnonzero(self.totals <= total)[:self.k].tolist()
        places: list[int] = []
        for term in terms:
            place = bisect_left(self.terms, term)
            if len(places) + bisect_left(rivals, place) >= self.k:
                break
            places.append(place)
        if places:
            self.totals = np.insert(self.totals, places, total)
            for back, place in enumerate(reversed(places)):
                self.terms.insert(place, terms[len(places) - 1 - back])
        return len(places)


def _skybands(k: int):
    """The skyband of each group among rows sorted by lang, source, n falling, total, term."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, band = None, Skyband(k)
        for batch in batches:
            if not len(batch):
                continue
            lang, source = batch["lang"].to_numpy(object), batch["source"].to_numpy(object)
            n, total = batch["n"].to_numpy(np.int64), batch["total"].to_numpy(np.int64)
            terms, stay = batch["term"].to_list(), []
            starts = _starts(lang, source, n, total)
            for at, end in zip(starts, [*starts[1:], len(terms)]):
                if (lang[at], source[at]) != group:
                    group, band = (lang[at], source[at]), Skyband(k)
                stay += range(at, at + band.add(total[at], terms[at:end]))
            yield batch.iloc[stay]
    return run


def _starts(*columns: np.ndarray) -> list[int]:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new).tolist()


def skybands(rows: DataFrame, k: int = TOP) -> DataFrame:
    """Of each group, the rows (lang, source, term, n, total, value) that may be among its k first.

    `different` tells into how many partitions a group is dealt.
    """
    schema = "lang string, source string, term string, n long, total long, value long"
    order = ["lang", "source", F.desc("n"), "total", "term"]
    slot = F.pmod(F.xxhash64("term"), F.ceil((F.col("different") + 1) / GROUP_ROWS))
    local = (rows.withColumn("slot", slot).select("lang", "source", "term", "n", "total", "value", "slot")
             .repartition("lang", "source", "slot").drop("slot").sortWithinPartitions(*order)
             .mapInPandas(_skybands(k), schema))
    return local.repartition("lang", "source").sortWithinPartitions(*order).mapInPandas(_skybands(k), schema)


# -- pairs of sources ---------------------------------------------------------------------

class Tile:
    """Sums of excess over terms, for the pairs of sources across the two sides of a tile."""

    def __init__(self, key: tuple, head: pd.DataFrame):
        self.lang, low, high, slot = key
        self.names, self.index = head["source"].to_numpy(object), head["index"].to_numpy(np.int64)
        self.zero, side = head["p"].to_numpy(np.int64), head["side"].to_numpy()
        gap = self.zero[:, None] - self.zero[None, :]
        self.base = gap * gap // self.zero[None, :]
        # a term that neither source has adds the base: counted for all terms, by one slot
        self.sums = self.base * (int(head["terms"].iloc[0]) if slot == 0 else 0)
        self.wanted = self.names[:, None] != self.names[None, :]
        if low != high:
            self.wanted &= side[:, None] != side[None, :]
        self.held: list[pd.DataFrame] = []

    def add(self, rows: pd.DataFrame) -> None:
        """Rows (term, index, p) sorted by term; worked on once there are many."""
        self.held.append(rows)
        if sum(map(len, self.held)) > TERMS:
            self.work(last=False)

    def work(self, last: bool) -> None:
        rows = pd.concat(self.held) if self.held else []
        if not len(rows):
            return
        starts = _starts(rows["term"].to_numpy(object))
        end = len(rows) if last else starts[-1]  # the last term may go on
        self.held = [rows.iloc[end:]] if end < len(rows) else []
        number = np.repeat(np.arange(len(starts)), np.diff([*starts, len(rows)]))[:end]
        if not end:
            return
        who, p = np.searchsorted(self.index, rows["index"].to_numpy(np.int64)[:end]), rows["p"].to_numpy(np.int64)[:end]
        shares = np.tile(self.zero[:, None], number[-1] + 1)  # a row for each source
        shares[who, number] = p
        divisors = shares.view(np.uint64)
        for i in range(len(self.names)):
            gap = shares[i] - shares[i + 1:]
            square = (gap * gap).view(np.uint64)
            terms = len(gap[0]) if len(gap) else 0
            self.sums[i, i + 1:] += (square // divisors[i + 1:]).sum(axis=1).view(np.int64) - terms * self.base[i, i + 1:]
            self.sums[i + 1:, i] += (square // divisors[i]).sum(axis=1).view(np.int64) - terms * self.base[i + 1:, i]

    def out(self) -> pd.DataFrame:
        self.work(last=True)
        a, b = np.nonzero(self.wanted)
        return pd.DataFrame({"lang": self.lang, "source": self.names[a], "item": self.names[b], "value": self.sums[a, b]})


def _tile_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tiles one after another: first the rows without a term, which name its sources."""
    key, tile, heads = None, None, []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch["lang"].to_numpy(object), *(batch[c].to_numpy() for c in ("low", "high", "slot"))]
        starts, bare = _starts(*columns), batch["term"].isna().to_numpy()
        for at, end in zip(starts, [*starts[1:], len(batch)]):
            if tuple(c[at] for c in columns) != key:
                if key is not None:
                    yield (tile or Tile(key, pd.concat(heads))).out()
                key, tile, heads = tuple(c[at] for c in columns), None, []
            first = at + int(bare[at:end].sum())
            if first > at:
                heads.append(batch.iloc[at:first])
            if first < end:
                tile = tile or Tile(key, pd.concat(heads))
                tile.add(batch.iloc[first:end][["term", "index", "p"]])
    if key is not None:
        yield (tile or Tile(key, pd.concat(heads))).out()


def pair_values(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): excess over all kept terms, for each other source of the language.

    Sources are dealt into blocks, and a tile holds the rows of two blocks. Its terms are dealt into
    slots, so neither a common term nor a large source or language makes a large task.
    """
    sizes = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SIDE).cast("int").alias("blocks"),
                                       F.ceil((F.sum("different") + 1) / SLOT_ROWS).cast("int").alias("slots"))
    placed = (groups.join(sizes, "lang")
              .withColumn("side", F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("lang", "source", "index", "total_n", "terms", "slots", "side",
                      F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")))
    zero = share(F.lit(0).cast("long"), F.col("total_n"), F.col("terms"))
    heads = placed.select("lang", "low", "high", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"),
                          F.lit(None).cast("string").alias("term"), "index", zero.alias("p"), "source", "side", "terms")
    none = F.lit(None)
    counted = (rows.select("lang", "source", "term", "p")
               .join(placed.select("lang", "source", "index", "slots", "low", "high"), ["lang", "source"])
               .select("lang", "low", "high", F.pmod(F.xxhash64("term"), F.col("slots")).cast("int").alias("slot"), "term",
                       "index", "p", none.cast("string").alias("source"), none.cast("int").alias("side"),
                       none.cast("long").alias("terms")))
    keys = ["lang", "low", "high", "slot"]
    sums = (heads.union(counted).repartition(*keys).sortWithinPartitions(*keys, "term", "index")
            .mapInPandas(_tile_sums, "lang string, source string, item string, value long"))
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


# -- the audit ----------------------------------------------------------------------------

def audit(docs: DataFrame, k: int = TOP, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, source, part, item, value, rank) for each (lang, source) group of docs.

    Part `pair` ranks the other sources of the language by the sum of floor((p - q)^2 / q) over the
    language's kept terms, p being the group's share of a term and q the other source's. Part `term`
    ranks the k terms with the largest such value against the language itself, of those that the
    group has and has more of. Equal values go by the item's UTF-8 bytes.

    Reads lang, source and text, whatever other columns there are; nulls are empty texts. A term is
    a run of letters A to Z, made small, and of characters beyond ASCII; a language keeps the terms
    of at least `min_docs` rows. Each row is a document, repeated or not. Groups without terms have
    their pairs, with the value 0 where the language keeps no term. Texts of any length are read
    whole. An empty table gives no rows.
    """
    kept = kept_counts(docs, min_docs)
    own = F.col("term").isNotNull()
    langs = kept.groupBy("lang").agg(
        F.coalesce(F.sum(F.when(own & F.col("head"), F.col("total"))), F.lit(0)).alias("lang_n"),
        F.count(F.when(own & F.col("head"), 1)).alias("terms"))
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = stored(kept.groupBy("lang", "source").agg(
        F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).alias("total_n"),
        F.count(F.when(own, 1)).alias("different")).join(langs, "lang")
        .withColumn("index", F.row_number().over(by_source)), "divergence-groups")
    shares = (kept.where(own).drop("head").join(groups.drop("index"), ["lang", "source"])
              .withColumns({"p": share(F.col("n"), F.col("total_n"), F.col("terms")),
                            "q": share(F.col("total"), F.col("lang_n"), F.col("terms"))}))
    pairs = pair_values(shares, groups).withColumn("part", F.lit("pair"))
    more = shares.where((F.col("n") > 0) & (F.col("p") > F.col("q"))).withColumn("value", excess(F.col("p"), F.col("q")))
    terms = skybands(more, k).withColumns({"item": F.col("term"), "part": F.lit("term")})
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("rank", rank).select(*columns)
            .union(terms.withColumn("rank", rank).where(F.col("rank") <= k).select(*columns)))
