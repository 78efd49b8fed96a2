"""Merkle manifest of a table: leaves per row, a tree per source, a tree over the sources.

A parent is the SHA-256 of up to 16 consecutive children. While a parent's hash runs over its
children, a copy of its state is kept before each child's slot. Another child in that slot is then
folded in by resuming the kept state with the replacement and the siblings to its right; what lies
to its left is never hashed again.

A task builds whole subtrees of 4,096 nodes, three levels at once, so a tree over n rows takes
log4096(n) jobs. Going down again, the top nodes of each subtree learn the siblings on their way to
the root, and every subtree of rows is folded and proved in one task with the states of its own
levels and of that way.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import ranked, stored

# Children of a parent, and levels that one task builds.
FAN, LEVELS = 16, 3
DIGEST = 64  # characters of a digest
# Rows of a range of the leaves that is numbered by one task, about.
RANGE_ROWS = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WAY = "array<struct<left:string,right:string>>"


class Level:
    """The parents of consecutive runs of nodes, with the hash state before each child's slot."""

    def __init__(self, nodes: list[bytes]):
        self.line, self.states, self.parents = b"".join(nodes), [], []
        for start in range(0, len(nodes), FAN):
            state = sha256()
            for child in nodes[start:start + FAN]:
                self.states.append(state.copy())
                state.update(child)
            self.parents.append(state.hexdigest().encode())

    def left(self, place: int) -> bytes:
        return self.line[DIGEST * (place - place % FAN):DIGEST * place]

    def right(self, place: int) -> bytes:
        return self.line[DIGEST * (place + 1):DIGEST * (place - place % FAN + FAN)]

    def fold(self, place: int, child: bytes) -> bytes:
        """The parent's digest with another child in that slot."""
        return resume(self.states[place], child, self.right(place))


def resume(state, child: bytes, right: bytes) -> bytes:
    state = state.copy()
    state.update(child)
    state.update(right)
    return state.hexdigest().encode()


def subtree(digests: list[str], n: int, most: int) -> list[Level]:
    """The levels above some nodes, of a tree that has n such nodes: up to its root, or `most`."""
    levels, nodes, width = [], [d.encode() for d in digests], 1
    while width < n and len(levels) < most:
        levels.append(Level(nodes))
        nodes, width = levels[-1].parents, width * FAN
    return levels


def leaf(text: Column | None = None) -> Column:
    """The digest of a row's fields; `text` takes the place of the column."""
    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    columns = [field(text if text is not None and c == "text" else F.col(c)) for c in FIELDS]
    return F.sha2(F.concat(*columns), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds pos, the place from 0 of a row of its tree by `order`, and n, the tree's rows."""
    ranges = max(1, -(-rows.count() // RANGE_ROWS))
    dealt = stored(rows.repartitionByRange(ranges, "tree", *order)
                   .withColumn("range", F.spark_partition_id()), "manifest-ranges")
    sizes = dealt.groupBy("tree").agg(F.count(F.lit(1)).alias("n"))
    return stored(ranked(dealt, ["tree"], "range", order, "pos").drop("range").join(sizes, "tree"), "manifest-nodes")


def _in_blocks(nodes: DataFrame, most: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / FAN ** most))


def _tops(nodes: DataFrame, most: int) -> DataFrame:
    """The top node of each subtree: the nodes of the next tier."""
    def top(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels, n = subtree(rows["digest"].to_list(), rows["n"].iloc[0], most), rows["n"].iloc[0]
        digest = levels[-1].parents[0].decode() if levels else rows["digest"].iloc[0]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "digest": [digest], "n": [-(-n // FAN ** most)]})
    tops = (_in_blocks(nodes.select("tree", "pos", "digest", "n"), most).groupBy("tree", "block")
            .applyInPandas(top, "tree string, pos long, digest string, n long"))
    return stored(tops, "manifest-tops")


def tiers(nodes: DataFrame, most: int = LEVELS) -> list[DataFrame]:
    """Nodes (tree, pos, digest, n) and the tops of their subtrees, up to one node for each tree."""
    found = [nodes]
    while not found or (found[-1].agg(F.max("n")).first()[0] or 0) > 1:
        found.append(_tops(found[-1], most))
    return found


def ways(lower: DataFrame, upper: DataFrame, most: int = LEVELS) -> DataFrame:
    """(tree, pos, way) of each node of a tier: its siblings, level by level, up to the root.

    `upper` has the ways of the tops of the tier's subtrees.
    """
    def down(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = subtree(rows["digest"].to_list(), rows["n"].iloc[0], most)
        rest = list(above["way"].iloc[0])
        found = []
        for place in range(len(rows)):
            way = []
            for level in levels:
                way.append({"left": level.left(place).decode(), "right": level.right(place).decode()})
                place //= FAN
            found.append(way + rest)
        return pd.DataFrame({"tree": rows["tree"], "pos": rows["pos"], "way": found})
    return stored(_in_blocks(lower.select("tree", "pos", "digest", "n"), most).groupBy("tree", "block")
                  .cogroup(upper.withColumnRenamed("pos", "block").groupBy("tree", "block"))
                  .applyInPandas(down, f"tree string, pos long, way {WAY}"), "manifest-ways")


def _proved(rows: pd.DataFrame, above: pd.DataFrame, most: int) -> pd.DataFrame:
    """The proof of each row of a subtree, and the root with its claim in its place."""
    if not len(rows):
        return pd.DataFrame(columns=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"], dtype=str)
    rows = rows.sort_values("pos")
    levels = subtree(rows["digest"].to_list(), rows["n"].iloc[0], most)
    way = [(step["left"].encode(), step["right"].encode()) for step in above["way"].iloc[0]]
    tail = b"".join(left + right for left, right in way)
    kept = [(sha256(left), right) for left, right in way]
    proofs, roots = [], []
    for place, claim in enumerate(rows["claim"]):
        proof, digest = sha256(), claim.encode()
        for level in levels:
            proof.update(level.left(place))
            proof.update(level.right(place))
            digest = level.fold(place, digest)
            place //= FAN
        proof.update(tail)
        for state, right in kept:
            digest = resume(state, digest, right)
        proofs.append(proof.hexdigest())
        roots.append(digest.decode())
    return pd.DataFrame({"doc_id": rows["doc_id"], "leaf": rows["digest"], "subroot": above["subroot"].iloc[0],
                         "root": above["root"].iloc[0], "proof_sha256": proofs, "folded_root": roots})


def audit(docs: DataFrame, claimed_text: Column | None = None, most: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for each row of docs.

    The manifest is built from docs as it is. Each row is then claimed with `claimed_text` for its
    text, and the root is folded from the claim: verified tells whether that is the manifest's root.

    Reads doc_id, source, lang, n_chars and text; null fields have a mark of their own, and other
    columns don't count. Rows without a source are a tree of their own, before the others. Within a
    tree rows go by doc_id, those without one first, equal ids by leaf: so repeated rows have
    neighbouring places and equal proofs only where their siblings are equal. Texts of any length
    are hashed whole. An empty table gives no rows.
    """
    # a null source sorts before all others, an empty one after it
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    digest = leaf()
    claim = digest if claimed_text is None else \
        F.when(claimed_text.eqNullSafe(F.col("text")), digest).otherwise(leaf(claimed_text))
    leaves = stored(docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                                digest.alias("digest"), claim.alias("claim")), "manifest-leaves")
    rows = numbered(leaves, ["doc_id", "digest"])
    by_source = tiers(rows, most)
    subroots = by_source[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest")
    sources = numbered(subroots, ["source"])
    over_sources = tiers(sources, most)
    root = over_sources[-1].select("tree", F.col("digest").alias("root"))

    way = over_sources[-1].select("tree", "pos", F.array().cast(WAY).alias("way"))
    for tier in reversed(over_sources[:-1]):
        way = ways(tier, way, most)
    named = sources.join(root, "tree").select(F.col("source").alias("tree"), F.col("digest").alias("subroot"), "root")
    way = (sources.join(way, ["tree", "pos"])
           .select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("pos"), "way"))
    for tier in reversed(by_source[1:-1]):
        way = ways(tier, way, most)
    blocks = way.join(named, "tree").withColumnRenamed("pos", "block").groupBy("tree", "block")

    def proved(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        return _proved(rows, above, most)
    columns = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    # ids go through Python as text: nulls there must not turn whole numbers into floats
    return (_in_blocks(rows, most).withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("tree", "block")
            .cogroup(blocks).applyInPandas(proved, ", ".join(f"{c} string" for c in ["doc_id", *columns]))
            .select(F.col("doc_id").cast("long").alias("doc_id"), *columns,
                    (F.col("folded_root") == F.col("root")).alias("verified")))


def lowered_where(condition: Column) -> Column:
    """The text, with A-Z made small where the condition holds."""
    return F.when(condition, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
