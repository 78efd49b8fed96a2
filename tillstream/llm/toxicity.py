"""Toxicity by the nearest labelled examples: exact TF-IDF cosine on block-max inverted lists.

The examples are a bounded sample of the labelled documents. Every word that one of them holds is a
term; how rare it is, is counted over all documents. A word that no example holds meets nothing and
is left out of a text's vector. Each term has a list of the examples that hold it, in blocks, with
the largest weight of each block. The lists of common terms also stand as rows of a table, and the
texts of a batch read them together, as one product. That part of the cosines bounds the k nearest
from below; a text then reads its other lists only in blocks that can hold one of them. The
neighbours vote by their distance and are the evidence.

A second vote comes from an index of the same kind over only the words, and first letters of words,
that differ most between the two labels; everything else a text says is one term more there, so that
a single such word in a long text weighs little. A logistic curve, fitted on the examples' own two
votes without themselves, turns both into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import small_batches

# The classifier is fitted on at most so many labelled documents, none longer than so many
# characters: those with the smallest hash of the doc_id.
EXAMPLES, EXAMPLE_CHARS = 4_096, 50_000
# A term is in the vocabulary of the second vote if this many examples hold it and its labels differ
# this much from chance; the strongest come first.
LEAST_EXAMPLES, LEAST_CHI2, TERMS = 4, 15.0, 4_096
PREFIX = 5
NEIGHBOURS, EVIDENCE, BLOCK = 15, 3, 64
# The longest lists, so many at most, are rows of a table if they have one in so many of the examples.
COMMON, COMMON_SHARE = 1_024, 32
# Texts that read the table together.
TOGETHER = 128
# Words a task remembers the terms of; at the bound it starts anew.
SEEN = 200_000
THRESHOLD = 0.7
REST = "*"
WORD = re.compile(r"[^\W\d_]+")
SPACED = {c: " " for c in range(128) if not chr(c).isalpha()}


def held_out() -> Column:
    """Rows whose labels are never looked at."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _words(text: str | None) -> list[str]:
    lower = (text or "").lower()
    return lower.translate(SPACED).split() if lower.isascii() else WORD.findall(lower)


def words_of(text: str | None) -> Counter:
    return Counter(_words(text))


def terms_of(words: Counter) -> Counter:
    """Counts of the words and of their beginnings."""
    found = Counter(words)
    for word, n in words.items():
        if len(word) > PREFIX:
            found[word[:PREFIX] + "~"] += n
    return found


def _chi2(toxic: int, clean: int, toxics: int, cleans: int) -> float:
    both = toxic + clean
    a, b = both * toxics / (toxics + cleans), both * cleans / (toxics + cleans)
    return (toxic - a) ** 2 / max(a, 1e-9) + (clean - b) ** 2 / max(b, 1e-9)


def vocabulary(texts: list[str], labels: list[int]) -> list[str]:
    """The terms that tell the labels apart, strongest first, and the rest."""
    held = (Counter(), Counter())
    for text, label in zip(texts, labels):
        held[label].update(terms_of(words_of(text)).keys())
    toxics, cleans = sum(labels), len(labels) - sum(labels)
    scored = [(-_chi2(held[1][t], held[0][t], toxics, cleans), t) for t in held[0].keys() | held[1].keys()
              if held[0][t] + held[1][t] >= LEAST_EXAMPLES] if toxics and cleans else []
    return [t for chi, t in sorted(scored) if -chi >= LEAST_CHI2][:TERMS] + [REST]


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


@dataclass
class Model:
    """The examples as inverted lists, what weighs a text's terms, and the curve of the votes."""
    terms: dict[str, int]
    idf: np.ndarray
    strong: "Model | None" = None  # of the second vote
    ids: list = field(default_factory=list)
    labels: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    # Postings by (term, example). A run is a term's postings of one block; the last start is the end.
    examples: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.empty(0))
    runs: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # per run: its first posting
    blocks: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))  # per run
    most: np.ndarray = field(default_factory=lambda: np.empty(0))  # per run
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # per term: its first run
    votes: list = field(default_factory=list)  # of the examples as given, each without itself
    curve: tuple[float, ...] = (0.5, 0.5, 0.0)
    prior: float = 0.5
    cache: dict = field(default_factory=dict)
    seen: dict = field(default_factory=dict)  # the terms of words looked up before, of those that have some
    without: set = field(default_factory=set)  # words looked up before that have none
    table: tuple | None = None  # made where it is used

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the text's terms, ascending, and their weights, of length 1 together."""
        return self.weighed(words_of(text))

    def weighed(self, words: Counter) -> tuple[np.ndarray, np.ndarray]:
        terms = self.terms
        if REST in terms:
            counts: dict[int, int] = {}
            rest = sum(words.values())
            for word in set(words) - self.without:
                own = self.seen.get(word)
                if own is None:
                    if len(self.seen) + len(self.without) >= SEEN:
                        self.seen.clear()
                        self.without.clear()
                    both = (word, word[:PREFIX] + "~") if len(word) > PREFIX else (word,)
                    own = tuple(terms[t] for t in both if t in terms)
                    if not own:
                        self.without.add(word)
                        continue
                    self.seen[word] = own
                for at in own:
                    counts[at] = counts.get(at, 0) + words[word]
                rest -= words[word]
            if rest:
                counts[terms[REST]] = rest
            at = np.fromiter(counts.keys(), np.int64, len(counts))
            often = np.fromiter(counts.values(), float, len(counts))
        else:
            at = np.fromiter(map(terms.get, words, repeat(-1)), np.int64, len(words))
            often = np.fromiter(words.values(), float, len(words))
            at, often = at[at >= 0], often[at >= 0]
        order = np.argsort(at)
        at, often = at[order], often[order]
        weights = (1 + np.log(often)) * self.idf[at]
        return at, weights / max(float(np.sqrt(weights @ weights)), 1e-12)

    def build(self, ids: list, texts: list[str], labels: list[int]) -> "Model":
        """Index the examples, those with the same strongest term in neighbouring blocks."""
        vectors = [self.vector(t) for t in texts]
        strongest = [(int(at[np.argmax(w)]) if len(at) else -1, round(-float(w.max(initial=0)), 9)) for at, w in vectors]
        order = sorted(range(len(texts)), key=lambda i: (strongest[i], texts[i], str(ids[i])))
        self.ids, self.labels = [ids[i] for i in order], np.array([labels[i] for i in order], np.int64)
        vectors = [vectors[i] for i in order]
        terms = np.concatenate([np.empty(0, np.int64), *(at for at, _ in vectors)])
        examples = np.repeat(np.arange(len(vectors)), [len(at) for at, _ in vectors])
        by_term = np.argsort(terms, kind="stable")
        terms, self.examples = terms[by_term], examples[by_term]
        self.weights = np.concatenate([np.empty(0), *(w for _, w in vectors)])[by_term]
        blocks = self.examples // BLOCK
        new = np.ones(len(terms), bool)
        new[1:] = (terms[1:] != terms[:-1]) | (blocks[1:] != blocks[:-1])
        first = np.nonzero(new)[0]
        self.runs, self.blocks = np.append(first, len(terms)), blocks[first]
        self.most = np.maximum.reduceat(self.weights, first) if len(first) else np.empty(0)
        self.starts = np.searchsorted(terms[first], np.arange(len(self.terms) + 1))
        self.prior = (int(self.labels.sum()) + 1) / (len(self.labels) + 2)
        self.votes = [0.0] * len(order)
        for example, found in enumerate(self.nearest_of(vectors, range(len(vectors)))):
            self.votes[order[example]] = self.vote(*found)
        self.seen.clear()  # these aren't sent to the tasks
        self.without.clear()
        self.table = None
        return self

    def _common(self) -> tuple[np.ndarray, np.ndarray]:
        """(row of each term, or -1; weights by row and example) of the longest lists."""
        if self.table is None:
            first = self.runs[self.starts]
            sizes = np.diff(first)
            longest = np.argsort(-sizes, kind="stable")[:COMMON]
            longest = longest[(sizes[longest] > 0) & (sizes[longest] * COMMON_SHARE >= len(self.ids))]
            rows = np.full(len(sizes), -1)
            rows[longest] = np.arange(len(longest))
            weights = np.zeros((len(longest), -(-len(self.ids) // BLOCK) * BLOCK))
            postings = _ranges(first[longest], first[longest + 1])
            weights[np.repeat(np.arange(len(longest)), sizes[longest]), self.examples[postings]] = self.weights[postings]
            self.table = rows, weights
        return self.table

    def nearest(self, at: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the nearest, ties to the smaller number."""
        return next(self.nearest_of([(at, weights)]))

    def nearest_of(self, vectors: list, but: Sequence[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The nearest of each vector, in order, without its example of `but`."""
        rows, table = self._common()
        for begin in range(0, len(vectors), TOGETHER):
            some = vectors[begin:begin + TOGETHER]
            given, others = np.zeros((len(some), len(table))), []
            for own, (at, weights) in zip(given, some):
                row = rows[at]
                common = row >= 0
                own[row[common]] = weights[common]
                others.append((at[~common], weights[~common]))
            sums = given @ table
            left_out = but[begin:begin + TOGETHER] if but is not None else [-1] * len(some)
            if but is not None:
                sums[np.arange(len(some)), left_out] = 0
            if not sums.size:
                yield from [(np.empty(0, np.int64), np.empty(0))] * len(some)
                continue
            tops = sums.reshape(len(some), -1, BLOCK).max(2)
            least = np.maximum(np.partition(sums, -NEIGHBOURS, axis=1)[:, -NEIGHBOURS] - 1e-11, 0)
            for (at, _), other, own, top, bound, example in zip(some, others, sums, tops, least, left_out):
                yield self._completed(*other, own, top, bound, example) if len(at) else (np.empty(0, np.int64), np.empty(0))

    def _completed(self, at: np.ndarray, weights: np.ndarray, sums: np.ndarray, tops: np.ndarray, least: float,
                   but: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest, from the common terms' part of the cosines and the terms that are left."""
        low, high = self.starts[at], self.starts[at + 1]
        runs, own = _ranges(low, high), np.repeat(weights, high - low)
        in_block = self.blocks[runs]
        mine = (tops + np.bincount(in_block, own * self.most[runs], minlength=len(tops)) > least)[in_block]
        runs, own = runs[mine], own[mine]
        low, high = self.runs[runs], self.runs[runs + 1]
        postings = _ranges(low, high)
        sums = sums + np.bincount(self.examples[postings], np.repeat(own, high - low) * self.weights[postings], minlength=len(sums))
        if but >= 0:
            sums[but] = 0
        best = np.nonzero(sums > least)[0]
        scores = sums[best]
        if len(best) > NEIGHBOURS:
            close = scores >= np.partition(scores, -NEIGHBOURS)[-NEIGHBOURS] - 1e-11
            best, scores = best[close], scores[close]
        order = np.lexsort((best, -np.round(scores, 12)))[:NEIGHBOURS]
        best, scores = best[order], scores[order]
        if len(best) < NEIGHBOURS:  # the others have nothing in common with the text
            others = np.setdiff1d(np.arange(min(len(self.ids), 2 * NEIGHBOURS + 1)), np.append(best, but))[:NEIGHBOURS - len(best)]
            best, scores = np.concatenate([best, others]), np.concatenate([scores, np.zeros(len(others))])
        return best, scores

    def vote(self, best: np.ndarray, scores: np.ndarray) -> float:
        best, scores = best[scores > 0], scores[scores > 0]
        if not len(best) or self.labels.min() == self.labels.max():
            return self.prior
        near = 1 / (1.05 - np.minimum(scores, 1))
        return float((near @ self.labels[best] + self.prior) / (near.sum() + 1))

    def cached_votes(self, texts: list[Counter]) -> list[float]:
        if len(self.cache) >= 50_000:
            self.cache.clear()
        vectors = [self.weighed(words) for words in texts]
        keys = [(at.tobytes(), np.round(weights, 12).tobytes()) for at, weights in vectors]
        new = {key: vector for key, vector in zip(keys, vectors) if key not in self.cache}
        for key, found in zip(new, self.nearest_of(list(new.values()))):
            self.cache[key] = self.vote(*found)
        return [self.cache[key] for key in keys]

    def scores(self, texts: Sequence[str | None]) -> Iterator[tuple[float, list]]:
        """The probability that each text is toxic, and the nearest examples."""
        a, b, shift = self.curve
        for begin in range(0, len(texts), TOGETHER):
            words = [words_of(t) for t in texts[begin:begin + TOGETHER]]
            found = self.nearest_of([self.weighed(w) for w in words])
            for (best, scores), second in zip(found, self.strong.cached_votes(words)):
                odds = a * _logit(self.vote(best, scores)) + b * _logit(second) + shift
                yield round(1 / (1 + math.exp(-min(max(odds, -50), 50))), 6), [
                    (self.ids[e], round(float(s), 6), int(self.labels[e])) for e, s in zip(best[:EVIDENCE], scores) if s > 0]


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def _logistic(votes: list[tuple[float, float]], labels: list[int]) -> tuple[float, float, float]:
    """(slopes, shift) of the labels over both votes' log-odds, by Newton steps with a little ridge."""
    start = np.array([0.5, 0.5, 0.0])
    if len(set(labels)) < 2:
        return tuple(start.tolist())
    x = np.array([[_logit(v), _logit(w), 1.0] for v, w in votes])
    y, beta = np.array(labels), start
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - 0.1 * (beta - start)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        beta = beta + np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    return max(float(beta[0]), 0.05), max(float(beta[1]), 0.05), float(beta[2])


def _holders(terms: dict[str, int]):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Documents of this task that hold each term, and their number."""
        held, docs = np.zeros(len(terms) + 1, np.int64), 0  # the last is of other words
        beginnings = {t[:-1]: at for t, at in terms.items() if t.endswith("~")}
        for batch in batches:
            docs += len(batch)
            for text in batch["text"]:
                words = set(_words(text))
                held[np.fromiter(map(terms.get, words, repeat(-1)), np.int64, len(words))] += 1
                begun = beginnings.keys() & {w[:PREFIX] for w in words if len(w) > PREFIX}
                held[[beginnings[w] for w in begun]] += 1
                held[terms[REST]] += bool(words)
        met = np.nonzero(held[:-1])[0]
        yield pd.DataFrame({"term": np.append(met, -1), "docs": np.append(held[met], docs)})
    return count


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of the sampled examples; rarities are counted over all documents."""
    marked = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXAMPLES)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = (texts.where(F.length("text") <= EXAMPLE_CHARS).join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id").collect())
    ids, known, marks = ([r[c] for r in rows] for c in ("doc_id", "text", "toxic"))
    words = sorted({w for t in known for w in words_of(t)})
    strong = vocabulary(known, marks)
    terms = {t: i for i, t in enumerate([*words, *sorted(set(strong) - set(words))])}
    counted = texts.select("text").mapInPandas(_holders(terms), "term int, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))
    held = {r["term"]: r["docs"] for r in counted.collect()}
    total = held.get(-1, 0)

    def index(chosen: list[str]) -> Model:
        idf = np.array([math.log((1 + total) / (1 + held.get(terms[t], 0))) + 1 for t in chosen])
        return Model({t: i for i, t in enumerate(chosen)}, idf).build(ids, known, marks)

    model = index(words)
    model.strong = index(strong)
    model.curve = _logistic(list(zip(model.votes, model.strong.votes)), marks)
    return model


def _scored(model: Model):
    def score(text: pd.Series) -> pd.DataFrame:
        found = list(model.scores(text.tolist()))
        return pd.DataFrame({"score": [s for s, _ in found], "evidence": [
            [{"doc_id": i, "similarity": s, "toxic": y} for i, s, y in e] for _, e in found]})
    return score


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (the nearest examples) of each document.

    Reads doc_id and text, and doc_id and toxic of the labels, whatever else the tables have. A
    null text is empty: it has no neighbours and gets the curve's value at the share of toxic
    examples. Labels other than 0 and 1 are left out; of several for a doc_id the largest counts,
    and of several texts the smallest. Equal texts get equal scores; a null doc_id isn't held out;
    without labels of both kinds all scores are the share of the toxic ones. An empty table of
    documents gives no rows.
    """
    small_batches(docs.sparkSession)
    model = fit(docs, labels)
    udf = F.pandas_udf(_scored(model), "score double, evidence array<struct<doc_id: long, similarity: double, toxic: int>>")
    return (docs.select("doc_id", udf(F.col("text").cast("string")).alias("s"))
            .select("doc_id", held_out().alias("held_out"), "s.score",
                    F.when(F.col("s.score") >= THRESHOLD, 1).otherwise(0).cast("int").alias("predicted"), "s.evidence"))
