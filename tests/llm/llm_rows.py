"""Small documents that hold the odd cases every operator must survive, and plain references."""

from collections import defaultdict

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("slot", T.StringType()),
    T.StructField("key", T.StringType()), T.StructField("bucket", T.StringType())])


@pytest.fixture(scope="session")
def make(spark):
    def documents(*rows):
        """Rows of (doc_id, text[, source]) with columns whose names the operators use as well."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "own", "own", None) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return documents


def prose(seed: int, words: int) -> str:
    """Distinct enough made-up prose."""
    import random
    rnd = random.Random(seed)
    out = []
    for k in range(words):
        out.append("".join(rnd.choice("abcdefghiklmnoprstuvw") for _ in range(rnd.randint(2, 7))) + (". " if k % 9 == 8 else " ")[:-1])
    return " ".join(out)


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows."""
    long_text = "\n".join(prose(k, 60) for k in range(400))
    return make((1, prose(1, 60)), (1, prose(1, 60)), (2, None), (3, ""), (4, " \n\t "), (None, prose(4, 50)),
                (5, None, None), (6, long_text), (7, "word"), (8, prose(1, 60), None), (9, "a  b\n\n c é 😀 "))


def banded_reference(a: str, b: str) -> int:
    """Edit distance, cell by cell."""
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def jaccard_classes(rows, n=5, similarity=0.8):
    """doc_id -> (smallest doc_id of its class, number of linked documents), comparing all pairs."""
    sets = {}
    for i, text in rows:
        words = (text or "").split()
        size = min(n, len(words))
        sets[i] = {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if words else set()
    links = defaultdict(set)
    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                links[a].add(b)
                links[b].add(a)
    out = {}
    for i in sorted(sets):
        if i in out:
            continue
        todo, group = [i], {i}
        while todo:
            for j in links[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        out |= {j: (min(group), len(links[j])) for j in group}
    return out
