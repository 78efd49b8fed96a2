"""Packing follows the order of the mix."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from tillstream.llm import mixing, packing
from tillstream.llm.common import stored


def _docs(spark, ids):
    rows = [(i, f"document {i} " + "word " * (40 + i % 7 * 30), "en", "ab"[i % 2], 0) for i in ids]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def _written(df, *order):
    return stored(df.repartitionByRange(3, *order).sortWithinPartitions(*order), "mixed")


def test_packed_sequences_follow_the_mix(spark):
    n = 300
    forward, back = _written(_docs(spark, range(n)), "doc_id"), _written(_docs(spark, range(n)), F.desc("doc_id"))
    packed = [corpus_pipeline.pack_sequences(spark, d, "").collect() for d in (forward, back)]
    assert all(Counter(r["doc_id"] for r in rows) == Counter(range(n)) for rows in packed)
    together = [{(r["doc_id"], r["sequence_id"]) for r in rows} for rows in packed]
    assert together[0] != together[1]
    for rows, order in zip(packed, (1, -1)):
        firsts = {}
        for r in rows:
            firsts.setdefault(r["sequence_id"], []).append(order * r["doc_id"])
        assert sorted(firsts) == list(range(len(firsts)))
        heads = [min(firsts[s]) for s in sorted(firsts)]
        assert heads == sorted(heads)
        by_sequence = {}
        for r in rows:
            by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for pieces in by_sequence.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= packing.CAPACITY
    # as few sequences as without an order
    plain = packing.pack(forward).select("sequence_id").distinct().count()
    assert {len({r["sequence_id"] for r in rows}) for rows in packed} == {plain}


def test_the_packed_mix_follows_the_mix(spark):
    """The earliest document of a sequence in the mix decides where the sequence comes."""
    docs = _docs(spark, range(400))
    mixed = stored(corpus_pipeline.mix_sources(spark, docs, ""), "mixed")
    place = {r["doc_id"]: (r["slot"], r["place"]) for r in packing_order(docs)}
    heads = {}
    for r in corpus_pipeline.pack_sequences(spark, mixed, "").collect():
        heads.setdefault(r["sequence_id"], []).append(place[r["doc_id"]])
    firsts = [min(heads[s]) for s in sorted(heads)]
    assert firsts == sorted(firsts) and len(firsts) > 20


def packing_order(docs):
    return mixing.mix(docs).select("doc_id", "slot", "place").collect()
