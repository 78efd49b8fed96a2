"""Jaccard join of documents on word n-grams: MinHash banding, verified on full n-gram sets.

1. Each text gets min-hashes and, from them, band hashes; rows and bands follow from the threshold
   and the recall wanted. Texts with the same words are one node from here on.
2. Nodes meet on band hashes. Within a bucket, pairs whose min-hashes agree far less often than
   the threshold asks are no candidates; so texts that only share a passage stay apart.
3. The components of what is left bring the texts together, and every pair within is verified on
   the whole n-gram sets, in blocks of bounded size. Only links per text and a spanning forest
   leave a block, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import small_batches, stored
from tillstream.llm.graphs import components, in_blocks

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.9995
# Min-hashes of a text at most; more rows a band fit in, fewer false candidates meet.
HASHES = 64
# Pairs whose min-hashes agree by this much less than the threshold aren't verified: over four
# standard deviations of the estimate.
MARGIN = 0.22
# Texts (signatures) and characters (texts) in one chunk of a block.
CHUNK_TEXTS, CHUNK_CHARS = 512, 2_000_000
SLICE = 4_096


def banding(similarity: float = SIMILARITY, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows whose bands reach the recall at the threshold within the hashes."""
    best = None
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity ** rows)) if similarity < 1 else 1
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("too few hashes for this recall")
    return best


class WordHashes(dict):
    """64-bit hash of each word, kept for the words seen last."""

    def __missing__(self, word: str) -> int:
        import xxhash
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@lru_cache(maxsize=1)
def _words() -> WordHashes:
    return WordHashes()


def shingles(words: list[str], n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams; one n-gram of all words if they are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    table = _words()
    hashed = np.fromiter(map(table.__getitem__, words), np.uint64, len(words))
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = (out ^ hashed[k:len(words) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


@lru_cache(maxsize=4)
def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_501)
    return (rng.integers(1, 2 ** 63, count, np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 2 ** 63, count, np.uint64))


def minhashes(grams: np.ndarray, count: int) -> np.ndarray:
    times, plus = _multipliers(count)
    least = np.full(count, np.iinfo(np.uint32).max, np.uint32)
    for a in range(0, len(grams), SLICE):
        mixed = (grams[a:a + SLICE, None] * times + plus) >> np.uint64(32)
        np.minimum(least, mixed.min(axis=0).astype(np.uint32), out=least)
    return least


def _bands(signature: np.ndarray, rows: int) -> np.ndarray:
    out = np.arange(len(signature) // rows, dtype=np.uint64) + np.uint64(1)
    for k in range(rows):
        out = (out ^ signature[k::rows].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out.view(np.int64)


def _signed(bands: int, rows: int, n: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch.pop("text"):
                words = (text or "").split()
                if not words:
                    out.append((None, None, 0, None, None))
                    continue
                digest = md5("\0".join(words).encode("utf-8", "surrogatepass")).digest()
                signature = minhashes(shingles(words, n), bands * rows)
                out.append((int.from_bytes(digest[:8], "little", signed=True),
                            int.from_bytes(digest[8:], "little", signed=True), len(text),
                            signature.tobytes(), _bands(signature, rows)))
            found = pd.DataFrame(out, columns=["k1", "k2", "chars", "signature", "bands"], index=batch.index)
            found = found.astype({"k1": "Int64", "k2": "Int64"})
            yield pd.concat([batch.astype({"doc_id": "Int64"}), found], axis=1)
    return sign


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def _alike(least: float):
    def work(block: pd.DataFrame) -> pd.DataFrame:
        """Spanning edges of the pairs of a bucket whose signatures agree often enough."""
        keys = block["k1"].to_numpy()
        if len(keys) < 2:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        signatures = np.frombuffer(b"".join(block["signature"]), np.uint32).reshape(len(keys), -1)
        forest, need = Forest(len(keys)), least * signatures.shape[1]
        left = np.arange(len(keys))
        while len(left) > 1:  # those like the first need no more looks among themselves
            first = left[0]
            like = (signatures == signatures[first]).sum(axis=1) >= need
            for i in np.nonzero(like)[0]:
                forest.join(int(first), int(i))
            left = left[1:][~like[left[1:]]]
        # Those that were set aside are compared as well: a pair may be alike where neither is like
        # the same first one.
        roots = np.array([forest.root(i) for i in range(len(keys))])
        if len(np.unique(roots)) > 1:
            for i in range(len(keys)):
                for j in np.nonzero(((signatures == signatures[i]).sum(axis=1) >= need) & (roots != roots[i]))[0]:
                    forest.join(i, int(j))
        roots = np.array([forest.root(i) for i in range(len(keys))])
        moved = keys != keys[roots]
        return pd.DataFrame({"a": keys[moved], "b": keys[roots][moved]})
    return work


def _verified(n: int, similarity: float):
    def work(block: pd.DataFrame) -> pd.DataFrame:
        """Links of each text in the block, and the first text it hangs together with."""
        sets = [shingles(t.split(), n) for t in block["text"]]
        sizes = np.array([len(s) for s in sets])
        shared = _overlaps(sets)
        union = sizes[:, None] + sizes[None, :] - shared
        linked = shared >= similarity * union - 1e-9
        chunk = block["chunk"].to_numpy()
        if block["low"].iat[0] != block["high"].iat[0]:
            linked &= chunk[:, None] != chunk[None, :]
        np.fill_diagonal(linked, False)
        forest = Forest(len(sets))
        for i, j in zip(*np.nonzero(np.triu(linked))):
            forest.join(int(i), int(j))
        roots = [forest.root(i) for i in range(len(sets))]
        k1 = block["k1"].to_numpy()
        return pd.DataFrame({
            "k1": k1, "k2": block["k2"].to_numpy(), "root": k1[roots], "group": block["root"].to_numpy(),
            "cut": (block["low"] != block["high"]).to_numpy() | (block["high"] > 0).to_numpy(),
            "texts": linked.sum(axis=1), "links": linked @ block["copies"].to_numpy(np.int64)})
    return work


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of sorted sets."""
    count = len(sets)
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(count), [len(s) for s in sets])
    values, column, times = np.unique(grams, return_inverse=True, return_counts=True)
    common = times[column] > 1
    owner, column = owner[common], column[common]
    total = np.zeros((count, count), np.int64)
    total[np.arange(count), np.arange(count)] = [len(s) for s in sets]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    step = max(256, SLICE * 512 // count)
    found = np.zeros((count, count))
    starts = np.nonzero(np.diff(column, prepend=-1))[0]
    for a in range(0, len(starts), step):
        low = starts[a]
        high = starts[a + step] if a + step < len(starts) else len(column)
        dense = np.zeros((count, min(step, len(starts) - a)), np.float32)
        dense[owner[low:high], np.searchsorted(starts, np.arange(low, high), side="right") - 1 - a] = 1
        found += dense @ dense.T
    np.fill_diagonal(found, 0)
    return total + found.astype(np.int64)


def join(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY,
         recall: float = RECALL) -> DataFrame:
    """(doc_id, row_key, class_id, n_links, n_texts, first) for each row of the documents.

    Two documents are linked if the Jaccard similarity of their sets of word n-grams reaches the
    threshold; words are what white space separates. A class is a connected component of links,
    named by its smallest doc_id. n_links counts the linked documents, n_texts those texts among
    them that differ. `first` marks the one row of the class that stands for it (row_key tells
    rows of one doc_id apart; only rows that are equal throughout share both).

    A text with fewer words has one n-gram. A text without words, or null, has no links and is a
    class of its own. A null doc_id counts as larger than any. Repeated rows are documents of
    their own. An empty table gives no rows. Other columns count only for row_key.
    """
    bands, rows = banding(similarity, recall)
    small_batches(docs.sparkSession)
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        _row_key(docs).alias("row_key"),
                        F.col("text").cast("string").alias("text"))
    signed = stored(whole.mapInPandas(
        _signed(bands, rows, words),
        "doc_id long, row_key long, k1 long, k2 long, chars long, signature binary, bands array<long>"), "signatures")
    texts = signed.where(F.col("k1").isNotNull())

    # One node for each text, with the row that stands for it.
    nodes = texts.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("head"))
    met = texts.select("k1", F.explode("bands").alias("band")).distinct()
    buckets = met.groupBy("band").agg(F.min("k1").alias("low"), F.max("k1").alias("high")).where("low < high")
    members = met.join(buckets.select("band"), "band")
    one_each = texts.groupBy("k1").agg(F.min("signature").alias("signature"))
    pairs = stored(in_blocks(members.join(one_each, "k1").withColumn("one", F.lit(1)), "band", "k1", "one",
                             CHUNK_TEXTS, _alike(similarity - MARGIN), "a long, b long"), "alike")
    roots = components(pairs)

    heads = stored(nodes.join(roots.withColumnRenamed("node", "k1"), "k1"), "candidates")
    wanted = heads.select("k1", "k2", "copies", "root", F.col("head.doc_id").alias("head_id"),
                          F.col("head.row_key").alias("head_key"))
    # Texts move once, by the same plan at every size.
    same_row = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("row_key") == F.col("head_key"))
    given = (whole.hint("merge").join(wanted, same_row)
             .select("k1", "k2", "copies", "root", "text").withColumn("chars", F.length("text") + 8_000)
             .withColumn("turn", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("k1"))).where("turn = 1").drop("turn"))
    checked = stored(in_blocks(given, "root", "k1", "chars", CHUNK_CHARS, _verified(words, similarity),
                               "k1 long, k2 long, root long, group long, cut boolean, texts long, links long"), "links")
    cut = checked.where("cut").select("group").distinct()
    whole_groups = checked.join(cut, "group", "left_anti").select("k1", "k2", "root", "texts", "links")
    parts = checked.join(cut, "group", "left_semi")
    joined = components(parts.where("k1 <> root").select(F.col("k1").alias("a"), F.col("root").alias("b")))
    sums = parts.groupBy("k1", "k2").agg(F.sum("texts").alias("texts"), F.sum("links").alias("links"))
    cut_groups = (sums.join(joined.withColumnRenamed("node", "k1"), "k1", "left")
                  .select("k1", "k2", F.coalesce("root", "k1").alias("root"), "texts", "links"))
    linked = whole_groups.union(cut_groups)

    named = (nodes.join(linked, ["k1", "k2"], "left")
             .select("k1", "k2", "copies", "head", F.coalesce("root", "k1").alias("root"),
                     F.coalesce("texts", F.lit(0)).alias("texts"), F.coalesce("links", F.lit(0)).alias("links")))
    leads = named.groupBy("root").agg(F.min("head").alias("lead"))
    per_text = named.join(leads, "root").select("k1", "k2", "copies", "lead", "texts", "links")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    with_text = texts.select("doc_id", "row_key", "k1", "k2").join(per_text, ["k1", "k2"]).select(
        "doc_id", "row_key", F.col("lead.doc_id").alias("class_id"),
        (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("texts").alias("n_texts"),
        (own == F.col("lead")).alias("first"))
    without = signed.where(F.col("k1").isNull()).select(
        "doc_id", "row_key", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(0).cast("long").alias("n_texts"), F.lit(True).alias("first"))
    return with_text.unionByName(without)


def _row_key(docs: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each class, with all its columns; see join() for which."""
    first = join(docs).where("first").select(F.coalesce("doc_id", F.lit(-1)).alias("id"), F.col("row_key").alias("key")).distinct()
    names = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"),
                       _row_key(docs).alias("key"), F.struct(*names).alias("row"))
    alone = Window.partitionBy("id", "key").orderBy("key")  # rows that are equal throughout
    return (rows.join(first, ["id", "key"], "left_semi").withColumn("turn", F.row_number().over(alone))
            .where("turn = 1").select("row.*"))
