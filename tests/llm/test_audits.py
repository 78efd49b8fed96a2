"""Source divergence, SimHash near-dedup and the Merkle manifest: brute force, odd rows, empty tables."""

import random
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pandas as pd
import pytest
import xxhash
from llm_rows import make, odd, prose  # noqa: F401
from pyspark.sql import functions as F

from tillstream.llm import divergence, manifest, simhash


# -- divergence ---------------------------------------------------------------------------

def terms_of(text):
    raw = (text or "").encode()
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    return bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in raw).decode().split(" ")


def naive_divergence(rows, k=200, min_docs=3):
    rows = [(lang or "", source or "", [t for t in terms_of(text) if t]) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        docs = Counter(t for r in mine for t in set(r[2]))
        kept = sorted((t for t, n in docs.items() if n >= min_docs), key=str.encode)
        counts = defaultdict(Counter)
        for _, source, found in mine:
            counts[source].update(t for t in found if docs[t] >= min_docs)
        total, v = sum(counts.values(), Counter()), len(kept)

        def share(c):
            return {t: 1 + 10 ** 9 * (c[t] + 1) // (sum(c.values()) + v) for t in kept}
        p, q = {s: share(counts[s]) for s in {r[1] for r in mine}}, share(total)
        for s in p:
            pairs = [(b, sum((p[s][t] - p[b][t]) ** 2 // p[b][t] for t in kept)) for b in p if b != s]
            words = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", words, k)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, x, n + 1) for n, (i, x) in enumerate(items[:most])]
    return sorted(out)


def corpus(seed, docs=60, sources=5):
    rnd = random.Random(seed)
    words = ["Été", "été", "Ünder", "übergrößen", "a", "b", "ab", "abcdefgh", "abcdefghi", "abcdefghj"] + [f"w{c}x" for c in "abcdefgh"]
    rows = []
    for i in range(docs):
        source = rnd.choice(["hot", None, "", *[f"s{j}" for j in range(sources)]])
        text = rnd.choice([" ", "-", "1"]).join(rnd.choices(words, range(1, len(words) + 1), k=rnd.randint(0, 40)))
        rows.append((i, rnd.choice([text, text.upper(), None, ""][:2 + (i % 7 == 0) * 2]), rnd.choice(["en", None]), source))
    return rows


def audited(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("term", F.lit("own"))
    return sorted(tuple(r) for r in divergence.audit(docs, **settings).collect())


@pytest.mark.parametrize("seed, k", [(1, 200), (2, 3), (3, 1)])
def test_divergence_is_what_brute_force_gives(spark, seed, k):
    rows = corpus(seed)
    assert audited(spark, rows, k=k) == naive_divergence([(r[2], r[3], r[1]) for r in rows], k)


def test_divergence_over_many_tiles_and_slots(spark, monkeypatch):
    """Sources in several blocks, terms in several slots, groups in several partitions: the same rows."""
    for name, value in (("SIDE", 2), ("SLOT_ROWS", 7), ("GROUP_ROWS", 3)):
        monkeypatch.setattr(divergence, name, value)
    rows = corpus(4, docs=80, sources=9)
    assert audited(spark, rows, k=2) == naive_divergence([(r[2], r[3], r[1]) for r in rows], 2)


@pytest.mark.parametrize("seed", range(20))
def test_a_skyband_drops_only_terms_that_k_others_beat(seed):
    rnd = random.Random(seed)
    k = rnd.choice([1, 2, 5])
    rows = sorted({(-rnd.randint(1, 6), rnd.randint(1, 9), "".join(rnd.choices("ab", k=rnd.randint(1, 12)))) for _ in range(300)},
                  key=lambda r: (r[0], r[1], r[2].encode()))
    frame = pd.DataFrame([("l", "s", r[2], -r[0], r[1], 0, i) for i, r in enumerate(rows)],
                         columns=["lang", "source", "term", "n", "total", "value", "row"])
    cuts = [frame.iloc[at:at + 50] for at in range(0, len(frame), 50)]
    stay = pd.concat(divergence._skybands(k)(iter(cuts)))["row"].to_list()
    expected = [i for i, (n, total, term) in enumerate(rows) if sum(
        o[0] <= n and o[1] <= total and o[2].encode() < term.encode() for o in rows) < k]
    assert stay == expected


@pytest.mark.parametrize("name, value", [("TERMS", 3), ("PIECE", 16), ("HELD", 5)])
def test_small_pieces_of_work_change_nothing(monkeypatch, name, value):
    """Long texts in pieces, counts that go out early, a tile's terms worked on a few at a time."""
    rnd = random.Random(3)
    docs = pd.DataFrame({"lang": "en", "source": [rnd.choice("ab") for _ in range(40)],
                         "text": [" ".join(rnd.choices(["one", "Two", "\u00e9", "four"], k=rnd.randint(0, 30))).encode() for _ in range(40)]})
    rows = pd.DataFrame([("l", 0, 0, 0, f"t{t:02}", i, rnd.randint(1, 10 ** 9), None, None, None)
                         for t in range(30) for i in sorted(rnd.sample(range(1, 5), rnd.randint(1, 4)))])
    heads = pd.DataFrame([("l", 0, 0, 0, None, i, 5 * i, f"s{i}", 0, 31) for i in range(1, 5)])
    tile = pd.concat([heads, rows]).set_axis(["lang", "low", "high", "slot", "term", "index", "p", "source", "side", "terms"], axis=1)

    def both():
        counts = pd.concat(divergence._count(iter([docs.iloc[:25], docs.iloc[25:]])))
        sums = pd.concat(divergence._tile_sums(iter([tile.iloc[at:at + 7] for at in range(0, len(tile), 7)])))
        return counts.groupby(["lang", "source", "term"])[["n", "d"]].sum(), sums.reset_index(drop=True)
    plain = both()
    monkeypatch.setattr(divergence, name, value)
    for one, other in zip(plain, both()):
        pd.testing.assert_frame_equal(one, other)


def test_divergence_of_odd_rows_and_of_no_rows(spark, odd):
    got = sorted(tuple(r) for r in divergence.audit(odd, min_docs=1).collect())
    rows = [(r["lang"], r["source"], r["text"]) for r in odd.collect()]
    assert got == naive_divergence(rows, min_docs=1)
    assert divergence.audit(odd.limit(0)).count() == 0


def test_a_language_without_kept_terms_still_has_its_pairs(spark):
    rows = [(1, "one", "en", "a"), (2, None, "en", "b"), (3, "", "fr", None)]
    assert audited(spark, rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


# -- simhash ------------------------------------------------------------------------------

def naive_fingerprint(text):
    words = (text or "").encode().lower().split()
    n = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + n]), 42) for i in range(len(words) - n + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def naive_components(rows, distance=4):
    """Row number -> smallest doc_id, comparing all pairs."""
    prints = [naive_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d if d is not None else -1, f"{prints[i]:016x}", least.get(find(i), -1)) for i, (d, _) in enumerate(rows)))


def clustered(docs, **settings):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["fingerprint"],
                   -1 if r["component_id"] is None else r["component_id"]) for r in simhash.cluster(docs, **settings).collect())


def near_copies(seed, groups=25, copies=5, words=120):
    rnd = random.Random(seed)
    rows = []
    for g in range(groups):
        base = prose(100 * seed + g, words).split()
        for _ in range(rnd.randint(1, copies)):
            text = list(base)
            for _ in range(rnd.randint(0, 3)):
                text[rnd.randrange(words)] = rnd.choice(["x", "Changed", "Ä"])
            rows.append((len(rows), "\t".join(text) if rnd.random() < .2 else " ".join(text)))
    rnd.shuffle(rows)
    return rows


def test_fingerprints_are_as_defined():
    texts = [None, "", " \x0b ", "a", "A b", "Ä ä\xa0b c", prose(1, 500), "Two\x0cwords again and again and again"]
    for text in texts:
        raw = None if text is None else text.encode()
        assert simhash.fingerprint_of(raw) & (1 << 64) - 1 == naive_fingerprint(text)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_what_all_pairs_give(make, seed):
    rows = near_copies(seed)
    expected = naive_components(rows)
    assert len({r[2] for r in expected}) < len(rows)
    assert clustered(make(*rows)) == expected


def test_every_close_pair_meets_in_a_cell(spark):
    rnd = np.random.default_rng(5)
    a = rnd.integers(0, 1 << 63, 400, dtype=np.uint64) * 2 + rnd.integers(0, 2, 400, dtype=np.uint64)
    b = a.copy()
    for i in range(400):
        for bit in rnd.choice(64, 1 + i % 4, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    pairs = pd.DataFrame({"i": range(400), "a": a.view(np.int64), "b": b.view(np.int64)})
    cells = simhash.cells(spark.createDataFrame(pd.DataFrame({"fp": np.unique(np.concatenate([pairs.a, pairs.b]))})))
    one, two = cells.toDF("cell", "a"), cells.toDF("cell", "b")
    met = spark.createDataFrame(pairs).join(one, "a").join(two, ["b", "cell"])
    assert met.select("i").distinct().count() == 400
    assert cells.groupBy("fp").count().agg(F.max("count")).first()[0] <= 3 + 2 * 64
    # fingerprints that aren't close hardly ever meet: an own cell holds the pair, if anything
    strange = one.join(two, "cell").where("a <> b").select("a", "b").distinct().count()
    assert strange <= 2 * 400 + 20


def test_large_cells_are_compared_in_chunks(spark, make, monkeypatch):
    """Cells of more than two fingerprints go on in pairs of chunks: the same components."""
    monkeypatch.setattr(simhash, "CHUNK", 2)
    with simhash.batches_of(spark, 7):
        rows = near_copies(9, groups=6, copies=12)
        assert clustered(make(*rows)) == naive_components(rows)


def test_simhash_of_odd_rows_and_of_no_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert clustered(odd) == naive_components(rows)
    assert clustered(odd.limit(0)) == []


# -- manifest -----------------------------------------------------------------------------

def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def naive_tree(nodes):
    """(root, siblings of each node on its way up)."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            low = place - place % 16
            ways[i].append(("".join(nodes[low:place]), "".join(nodes[place + 1:low + 16])))
            at[i] = place // 16
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], ways


def naive_audit(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the audit's rows."""
    def leaf(row):
        return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in row])

    def claim(row):
        if row[0] is None or row[4] is None or crc32(str(row[0]).encode()) % 5:
            return leaf(row)
        return leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append((row[0], leaf(row), claim(row)))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = naive_tree([r[1] for r in by_source[s]])
    root, over = naive_tree([trees[s][0] for s in names])
    out = []
    for s, above in zip(names, over):
        subroot, ways = trees[s]
        for (doc_id, digest, folded), way in zip(by_source[s], ways):
            for left, right in way + above:
                folded = h(left, folded, right)
            out.append((doc_id, digest, subroot, root, h(*[x for step in way + above for x in step]), folded, folded == root))
    return sorted(out, key=str)


def audit_rows(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string") \
        .withColumns({"tree": F.lit("own"), "pos": F.lit("own")})
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return sorted((tuple(r) for r in manifest.audit(docs, manifest.lowered_where(tampered), **settings).collect()), key=str)


@pytest.mark.parametrize("sizes", [[1], [16], [17, 1, 256], [257, 3], [4096, 4097, 2], [1] * 40])
def test_manifest_is_what_plain_trees_give(spark, sizes):
    rows, rnd = [], random.Random(1)
    for s, size in enumerate(sizes):
        source = [None, "", "é", "Z"][s] if s < 4 else f"s{s}"
        rows += [(len(rows) * 3 + i, source, "en", 5, rnd.choice(["Text", "text", None, "ÄB é", ""])) for i in range(size)]
    rnd.shuffle(rows)
    got = audit_rows(spark, rows)
    assert got == naive_audit(rows)
    if len(rows) > 1000:
        assert {r[6] for r in got} == {True, False}


def test_deep_trees_of_small_fans_go_through_several_tiers(spark, monkeypatch):
    """Subtrees of one level only: 467 rows of a source need three tiers above them, 21 sources two."""
    monkeypatch.setattr(manifest, "RANGE_ROWS", 100)
    rows = [(i, "hot" if i % 3 else f"s{i % 20}", None, None, f"Row {i}") for i in range(700)]
    assert audit_rows(spark, rows, most=1) == naive_audit(rows)


def test_manifest_of_odd_rows_ties_and_no_rows(spark, odd):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r[c] for c in columns) for r in odd.collect()]
    rows += [(None, "s", None, None, None)] * 3 + [(2 ** 62 + 1, "s", "é", -1, "x")] * 2
    assert audit_rows(spark, rows) == naive_audit(rows)
    assert audit_rows(spark, []) == []


def test_a_fold_needs_only_what_lies_to_the_right():
    nodes = [h(str(i)).encode() for i in range(40)]
    level = manifest.Level(nodes)
    for place in (0, 5, 15, 16, 39):
        start = place - place % 16
        other = h("other").encode()
        run = nodes[start:place] + [other] + nodes[place + 1:start + 16]
        assert level.fold(place, other) == sha256(b"".join(run)).hexdigest().encode()
        level.line = b"\0" * (64 * place) + level.line[64 * place:]  # the left siblings are never read again
        assert level.fold(place, nodes[place]) == level.parents[place // 16]
        level = manifest.Level(nodes)
