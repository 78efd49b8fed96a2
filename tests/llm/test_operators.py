"""Each operator on odd rows, on an empty table, and against brute force."""

import gc
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from llm_rows import banded_reference, jaccard_classes, make, odd, prose  # noqa: F401

import corpus_pipeline
from tillstream.llm import (html_text, licenses, line_dedup, mixing, ngram_join, packing, quality, token_files,
                            tokens, topk, toxicity)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, toxic int")


# -- tokens, packing, files -------------------------------------------------------

def test_word_look_up_gives_the_ids_of_whole_texts():
    enc = tokens.encoder(tokens.default_path())
    rnd = random.Random(7)
    texts = ["", " ", "a  b", "x\n\n y", " a", "a ", "tab\t z", "x<|endoftext|> y", "é ü 漢字 😀", "don't 1 2,3", "a  b", "\n a \n"]
    texts += ["".join(rnd.choice("ab. \né'1") for _ in range(rnd.randint(0, 40))) for _ in range(500)]
    assert list(enc.encode(texts)) == enc.whole(texts)
    assert list(enc.encode([None, "a"])) == [b"", *enc.whole(["a"])]


def test_pieces_that_white_space_or_marks_may_join_have_the_ids_of_whole_texts():
    enc = tokens.Encoder(tokens.default_path())
    rnd = random.Random(5)
    signs = ["a", "Z", "é", "×", "÷", "ɏ", "ɐ", "ª", "漢", "1", *".,!?;:'", " ", " ", " ", "\n", "\xa0", "\t", "\u3000", "\u0301", "ȿ"]
    texts = ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 9))) for _ in range(5000)]
    assert list(enc.encode(texts)) == enc.whole(texts)
    rows = [(k, k + 1, t) for k, t in enumerate(texts[:9])]
    assert list(enc.encode_rows(iter(rows))) == [(k, n, i) for (k, n, _), i in zip(rows, enc.whole(texts[:9]))]


def test_the_table_of_pieces_starts_anew_at_its_bound_and_gives_the_same_ids(monkeypatch):
    monkeypatch.setattr(tokens, "PIECES", 100)
    monkeypatch.setattr(tokens, "SPAN", 300)
    enc = tokens.Encoder(tokens.default_path())
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice("abc") * rnd.randint(1, 30) + rnd.choice(["", ",", "."]) for _ in range(20)) for _ in range(200)]
    assert list(enc.encode(texts)) == enc.whole(texts)
    assert len(enc.pieces) <= 200


def test_what_an_encoder_keeps_of_a_word_is_small():
    enc = tokens.Encoder(tokens.default_path())
    texts = [" ".join(f"w{k}x" for k in range(a, a + 1000)) for a in range(0, 100_000, 1000)]
    list(enc.encode(texts[:1]))
    gc.collect()
    tracemalloc.start()
    arrow = pa.total_allocated_bytes()
    list(enc.encode(texts))
    gc.collect()
    kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - arrow
    tracemalloc.stop()
    assert kept < 80 * 100_000  # as Python objects in a dict they take over 150 bytes each


def naive_best_fit(histogram, capacity):
    bins = []
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [r for r in bins if r >= length]
            room = min(fits) if fits else capacity
            if fits:
                bins.remove(room)
            bins.append(room - length)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(40))
def test_best_fit_is_what_one_piece_at_a_time_gives(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([1, 2, 7, 16, 100])
    histogram = {n: rnd.randint(1, 9) for n in rnd.sample(range(1, capacity + 1), rnd.randint(1, min(capacity, 12)))}
    slots, fill = sorted(packing.best_fit(histogram, capacity)), defaultdict(list)
    for length, count in histogram.items():
        own = [s for s in slots if s[0] == length]
        for rank in range(count):
            _, first, bin_, each, offset = [s for s in own if s[1] <= rank][-1]
            fill[bin_ + (rank - first) // each].append((offset + (rank - first) % each * length, length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
    assert sorted(capacity - sum(n for _, n in p) for p in fill.values()) == naive_best_fit(histogram, capacity)


def test_packing_is_gapless_and_whole(odd):
    rows = packing.pack(odd).collect()
    enc = tokens.encoder(tokens.default_path())
    want = Counter()
    for r in odd.collect():
        ids = list(enc.encode([r["text"]]))[0] + (2).to_bytes(4, "little")
        total = len(ids) // 4
        edges = [0, *range(total % 1024 or 1024, total + 1, 1024)]
        want.update((r["doc_id"], k, a, b - a, crc32(ids[4 * a:4 * b])) for k, (a, b) in enumerate(zip(edges, edges[1:])))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_token_files_round_trip(spark, odd, folder):
    path = f"file://{folder}"
    token_files.write(odd, path)
    rows = token_files.read(spark, path).collect()
    enc = tokens.encoder(tokens.default_path())
    want = [(r["doc_id"], list(enc.encode([r["text"]]))[0] + bytes(4)) for r in odd.collect()]
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in rows) == Counter(want)
    rows.sort(key=lambda r: r["start"])
    assert [r["start"] for r in rows] == list(np.cumsum([0] + [r["n_tokens"] for r in rows[:-1]]))
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [x.tobytes() for x in token_files.document(path, 7)] == [b for i, b in want if i == 7]
    assert len(token_files.document(path, 1)) == 2 and token_files.document(path, 77) == []


def test_token_files_of_nothing(spark, none, folder):
    token_files.write(none, f"file://{folder}")
    assert token_files.read(spark, f"file://{folder}").count() == 0


# -- quality -------------------------------------------------------------------------

def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for k, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(k, k + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def test_quality_base_counts(odd, make):
    junk = make((20, "Der " * 100), (21, "a b c d e f g h " * 3 + prose(3, 40)), (22, "x### y$$$ " * 40), (23, "l m\nl m\n\nl m"))
    docs = odd.unionByName(junk)
    got = Counter((r["doc_id"], *[r[c] for c in quality.MEASURES[:5]]) for r in quality.judge(docs).collect())
    assert got == Counter((r["doc_id"], *base(r["text"])) for r in docs.collect())
    kept = by_id(quality.judge(docs).where("doc_id is not null"))
    assert not kept[20]["kept"] and kept[20]["base_failed"] and not kept[2]["kept"]


def test_quality_rejects_junk_and_keeps_prose(make):
    docs = make(*[(k, prose(k, 120)) for k in range(200)], *[(1000 + k, re.sub(r" ", "### ", prose(k, 80))) for k in range(15)],
                *[(2000 + k, re.sub(" ", "!! ", prose(k, 80).upper())) for k in range(15)])
    got = by_id(quality.judge(docs))
    assert all(got[k]["kept"] for k in range(200))
    assert not any(got[k]["kept"] for k in got if k >= 1000)
    assert {r["doc_id"] for r in quality.keep_good(docs).collect()} == set(range(200))
    assert quality.keep_good(docs).columns == docs.columns


# -- lines -----------------------------------------------------------------------------

def test_banded_distance():
    rnd = random.Random(3)
    for most in (1, 2, 3):
        pairs = []
        for _ in range(600):
            a = "".join(rnd.choice("abé😀") for _ in range(rnd.randint(0, 50)))
            b = a
            for _ in range(rnd.randint(0, 4)):
                k, kind = rnd.randint(0, len(b)), rnd.randint(0, 2)
                b = b[:k] + ("x" if kind else "") + b[k + (kind != 1):]
            a, b = sorted((a, b), key=len)
            if len(b) - len(a) <= most:
                pairs.append((a, b))
        got = line_dedup.banded([a for a, _ in pairs], [b for _, b in pairs], most)
        assert list(got) == [min(banded_reference(a, b), most + 1) for a, b in pairs]


def test_segments_meet_for_every_close_pair():
    rnd = random.Random(4)
    for by_words in (False, True):
        for size in [*range(20, 90, 3), 240, 250, 300, 619, 620, 640, 700] * 6:
            a = tuple(rnd.choice("abc") for _ in range(size))
            b, most = list(a), line_dedup.allowed(by_words, size)
            for _ in range(rnd.randint(1, most)):
                k, kind = rnd.randint(0, len(b)), rnd.randint(0, 2)
                b = b[:k] + (["x"] if kind else []) + b[k + (kind != 1):]
            a, b = sorted((a, tuple(b)), key=len)
            if line_dedup.banded([a], [b], line_dedup.MOST)[0] <= line_dedup.allowed(by_words, len(a)):
                left = {(s, a[x:y]) for s, x, y, role in line_dedup.places(by_words, len(a)) if role & line_dedup.INDEX}
                assert left & {(s, b[x:y]) for s, x, y, role in line_dedup.places(by_words, len(b)) if role & line_dedup.PROBE}


def test_shared_segments_do_not_depend_on_the_batches():
    rnd = random.Random(3)
    for _ in range(300):
        rows = sorted({(rnd.randint(0, 5), -rnd.choice((2, 3)), rnd.randint(0, 3)) for _ in range(rnd.randint(0, 14))})
        rows = [(k, i, -r) for k, r, i in rows for _ in range(rnd.randint(1, 2))]  # tasks repeat a line
        groups = defaultdict(set)
        for k, i, r in rows:
            groups[k].add((i, r))
        wanted = {(k, i) for k, g in groups.items() if any(r & line_dedup.INDEX for _, r in g) and len({i for i, _ in g}) > 1
                  for i, _ in g}
        cuts = sorted(rnd.randint(0, len(rows)) for _ in range(3))
        parts = [pd.DataFrame(rows[a:b], columns=["key", "id", "role"]).astype({"key": "int64", "id": "int64", "role": "int32"})
                 for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        got = {(k, i) for out in line_dedup._shared(iter(parts)) for k, i in zip(out["key"], out["id"])}
        assert got == wanted


@pytest.mark.parametrize("held", [1, 5, 1000])
def test_sifted_postings_are_all_that_are_shared(monkeypatch, held):
    monkeypatch.setattr(line_dedup, "HELD", held)
    rnd = random.Random(7)
    for _ in range(200):
        # A line that indexes a key also probes for it.
        rows = [(rnd.randint(0, 7), rnd.randint(0, 3), rnd.choice((2, 3))) for _ in range(rnd.randint(0, 20))]
        pieces = []
        for _ in range(3):
            some = sorted((k % 2, r == line_dedup.PROBE, k, i, r) for k, i, r in rows if rnd.random() < 0.6)
            pieces += [(part, probe, np.array([(k, i, r) for p, q, k, i, r in some if (p, q) == (part, probe)], line_dedup.PIECE).tobytes())
                       for part, probe in sorted({(p, q) for p, q, *_ in some})]
        rows = [tuple(row) for *_, piece in pieces for row in np.frombuffer(piece, line_dedup.PIECE).tolist()]
        wanted = {(k, i) for k, i, _ in rows if any(x == k and r & line_dedup.INDEX for x, _, r in rows)
                  and len({j for x, j, _ in rows if x == k}) > 1}
        pieces.sort(key=lambda piece: piece[:2])
        cut = rnd.randint(0, len(pieces))
        parts = [pd.DataFrame(some, columns=["part", "probe", "piece"]) for some in (pieces[:cut], pieces[cut:])]
        got = [out for out in line_dedup._sifted(iter(parts)) if len(out)]
        assert {(k, i) for out in got for k, i in zip(out["key"], out["id"])} == wanted


def test_lines_with_few_words_in_common_are_not_measured(monkeypatch):
    """Lines that share a segment and little else are told apart without their edit distance."""
    measured = []
    distance = line_dedup._distance
    monkeypatch.setattr(line_dedup, "_distance", lambda a, b, most: measured.append(1) or distance(a, b, most))
    lines = ["one beginning that all of them have " + prose(k, 20) for k in range(40)]
    near = lines[7].rsplit(" ", 1)[0] + " otherwise"
    rows = [(k, k, line_dedup.INDEX | line_dedup.PROBE, True, True, line) for k, line in enumerate([*lines, near])]
    assert line_dedup._late(rows) == [(40, 40)]
    assert len(measured) <= 40


def removed_lines(rows):
    """Numbers of the lines that go, by comparing all pairs of lines. Rows: (doc_id, text)."""
    homes = {}
    for doc, text in rows:
        for line in text.split("\n"):
            if line.strip(" "):
                homes[line] = min(homes.get(line, doc), doc)
    order = {line: (home, line_dedup._hash(line)) for line, home in homes.items()}

    def close(a, b):
        (kind, x), (other, y) = sorted((line_dedup.symbols(a), line_dedup.symbols(b)), key=lambda s: len(s[1]))
        most = line_dedup.allowed(kind, len(x))
        if kind != other or not most or len(y) - len(x) > most:
            return False
        codes = {}
        return banded_reference(*["".join(chr(codes.setdefault(w, len(codes) + 256)) for w in s) for s in (x, y)]) <= most

    late = {a for a in homes if any(order[b] < order[a] and close(a, b) for b in homes)}
    out = {}
    for doc, text in rows:
        seen, gone = set(), []
        for k, line in enumerate(text.split("\n")):
            if line.strip(" "):
                if line in seen or line in late or homes[line] < doc:
                    gone.append(k)
                seen.add(line)
        out[doc] = gone
    return out


@pytest.mark.parametrize("leaders, block", [(16, 2048), (2, 5)])
def test_line_dedup_is_that_of_all_pairs(make, monkeypatch, leaders, block):
    """Changed words, one hot line with many near copies, and different lines that share a passage."""
    monkeypatch.setattr(line_dedup, "LEADERS", leaders)
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rnd, lines = random.Random(8), []
    hot, passage = prose(100, 30), prose(101, 10)
    for k in range(60):
        words = hot.split() if k % 3 == 0 else (passage + " " + prose(200 + k, 14)).split() if k % 3 == 1 else prose(300 + k % 20, 9 + k % 30).split()
        for _ in range(rnd.randint(0, 5)):
            words[rnd.randrange(len(words))] = rnd.choice(["heron", "stork", "crane"])
        lines.append(" ".join(words))
    rows = [(k, "\n".join(rnd.sample(lines, 3) + ["漢字" * 14 + "x" * (k % 3)])) for k in range(40)]
    got = by_id(line_dedup.dedup(make(*rows)))
    want = removed_lines(rows)
    assert {d: list(r["removed"]) for d, r in got.items()} == want and any(want.values())


def test_a_replaced_word_is_found_at_any_length(make):
    rows, rnd = [], random.Random(3)
    for k in range(60):
        words = prose(k, 8 + 6 * k).split()
        changed = list(words)
        changed[rnd.randrange(len(words))] = "replacement"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(changed))]
    got = by_id(line_dedup.dedup(make(*rows)))
    assert all(not got[2 * k]["removed"] and got[2 * k + 1]["n_near"] == 1 for k in range(60))


def test_line_dedup(make):
    line, other = prose(11, 12), prose(12, 12)
    near = line[:20] + "#" + line[21:]
    got = by_id(line_dedup.dedup(make((3, f"{near}\nown line three\n\nshort"), (1, f"{line}\n{other}"), (2, f"{other}\n{other}\nmine"),
                                      (None, f"{other}\nnobody else"), (4, None), (5, ""))))
    assert got[1]["text"] == f"{line}\n{other}" and got[1]["removed"] == []
    assert (got[2]["text"], got[2]["n_equal"], got[2]["n_near"]) == ("mine", 2, 0)
    assert (got[3]["text"], got[3]["n_equal"], got[3]["n_near"]) == ("own line three\n\nshort", 0, 1)
    assert got[None]["text"] == "nobody else" and got[4]["text"] is None and got[5]["text"] == ""
    assert got[1]["slot"] == "own" and got[4]["n_lines"] == 0


# -- toxicity -----------------------------------------------------------------------------

def test_nearest_examples_are_exact_and_scores_tell_toxic_texts(make, spark):
    bad = ["trash", "moron", "scum", "idiot"]
    rows, labels, rnd = [], [], random.Random(9)
    for k in range(240):
        words = prose(k, 60).split()
        if k % 4 == 0:
            for _ in range(4):
                words[rnd.randrange(60)] = rnd.choice(bad)
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    docs, marks = make(*rows, (900, None), (901, ""), (None, "x")), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    assert all(crc32(str(i).encode()) % 3 != 1 for i in model.ids)
    texts = dict(rows)
    for k in range(0, 240, 7):
        at, weights = model.vector(texts[k])
        best, scores = model.nearest(at, weights)
        dense = np.zeros((len(model.ids), len(model.terms)))
        for e, i in enumerate(model.ids):
            a, w = model.vector(texts[i])
            dense[e, a] = w
        query = np.zeros(len(model.terms))
        query[at] = weights
        every = np.round(dense @ query, 12)
        want = np.lexsort((np.arange(len(every)), -every))[:toxicity.NEIGHBOURS]
        assert list(best) == list(want) and np.allclose(scores, every[want])
    got = by_id(toxicity.score(docs, marks))
    held = [k for k in range(240) if got[k]["held_out"]]
    assert held and all(got[k]["predicted"] == int(k % 4 == 0) for k in held)
    assert got[900]["score"] == got[901]["score"] and 0 <= got[900]["score"] <= 1 and not got[None]["held_out"]


def test_toxicity_neighbours_share_any_words(make, spark):
    rows = [(k, prose(k, 40)) for k in range(60)]
    kept = [k for k in range(60) if crc32(str(k).encode()) % 3 != 1]
    queries = [(1000 + k, " ".join(prose(k, 40).split()[5:] + ["zzz"])) for k in kept]
    docs, marks = make(*rows, *queries), spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    assert set(model.terms) == {w for k in kept for w in toxicity.words_of(rows[k][1])}
    got = by_id(toxicity.score(docs, marks))
    for k in kept:
        first, *others = got[1000 + k]["evidence"]
        assert first["doc_id"] == k and 0.8 < first["similarity"] <= 1 and all(e["similarity"] < 0.7 for e in others)


def test_toxicity_common_words_are_read_for_a_batch_at_once(monkeypatch):
    """Few numbers are read text by text, whatever the number of examples with a text's common words."""
    rnd, common, rare = random.Random(5), [f"c{chr(97 + k)}" for k in range(20)], [f"r{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(676)]
    texts = [" ".join(rnd.sample(common, 10) + rnd.choices(rare, k=2)) for _ in range(2_000)]
    words = sorted({w for t in texts for w in toxicity.words_of(t)})
    model = toxicity.Model({w: k for k, w in enumerate(words)}, np.linspace(1, 2, len(words)))
    model.build(list(range(2_000)), texts, [k % 2 for k in range(2_000)])
    read = []
    ranges = toxicity._ranges

    def counted(starts, ends):
        read.append(int((ends - starts).sum()))
        return ranges(starts, ends)

    model.nearest(*model.vector(texts[0]))  # what is made once for all texts
    monkeypatch.setattr(toxicity, "_ranges", counted)
    queries = [" ".join(rnd.sample(common, 9) + rnd.choices(rare, k=2)) for _ in range(50)]
    vectors = [model.vector(t) for t in queries]
    dense = np.zeros((2_000, len(words)))
    for e, i in enumerate(model.ids):
        at, weights = model.vector(texts[i])
        dense[e, at] = weights
    for at, weights in vectors:
        best, scores = model.nearest(at, weights)
        every = np.round(dense[:, at] @ weights, 12)
        want = np.lexsort((np.arange(2_000), -every))[:toxicity.NEIGHBOURS]
        assert list(best) == list(want) and np.allclose(scores, every[want])
    # A common word is in a thousand examples, a text has nine; a rare one is in six.
    assert sum(read) < 50 * 100


def test_toxicity_without_labels(odd, none, no_labels):
    assert {r["score"] for r in toxicity.score(odd, no_labels).collect()} == {0.5}
    assert toxicity.score(none, no_labels).count() == 0


# -- licenses -------------------------------------------------------------------------------

def test_license_scan(make, odd):
    docs = make((1, "Licensed under the Apache License, Version 2.0."), (2, "GNU General Public License v3 or later; MIT license"),
                (3, "mit\nlicense MIT License cc-by"), (4, "Permission is not LİCENSE"), (5, "CC BY-NC 4.0"), (6, None))
    got = by_id(licenses.scan(docs))
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["labels"]) == (1, 3, "apache,apache-2.0")
    assert (got[2]["base_labels"], got[2]["labels"]) == ("gpl,mit", "gpl,gpl-3-or-later,mit")
    assert (got[3]["n_base"], got[3]["first_word"], got[3]["last_word"], got[3]["n_words"]) == (3, 0, 4, 6)
    assert got[5]["labels"] == "cc-by,cc-by-nc-4.0" and got[6]["n_words"] == 0 and got[6]["first_word"] is None
    assert len(licenses.SIGNATURES) > 200 and licenses.scan(odd).count() == odd.count()


# Sentences as people write them, and the label that each must get.
LICENSED = [
    ("You may use this under GPLv3", "gpl-3"), ("released under LGPL 2.1", "lgpl-2.1"), ("This work is BSD licensed", "bsd"),
    ("Licence MIT", "mit"), ("License: MPL 2.0", "mpl-2.0"), ("It is MIT-licensed.", "mit"), ("licensed under the EPL 2.0", "epl-2.0"),
    ("GPL v2 or later", "gpl-2-or-later"), ("AGPL version 3", "agpl-3"), ("All of it is GPL.", "gpl"), ("License: Apache 2.0", "apache-2.0"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0", "gpl-2.0-with-classpath-exception"),
    ("Apache License v2.0 with LLVM Exceptions", "apache-2.0-with-llvm-exception"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("Redistributions of source code must retain the above copyright notice", "bsd"), ("Licensed under CDDL 1.0", "cddl-1.0"),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "mit"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"), ("License is ISC", "isc"),
    ("Everyone is permitted to copy and distribute verbatim or modified copies of this license document", "wtfpl"),
    ("GNU Lesser General Public License, version 2.1 or later", "lgpl-2.1-or-later"), ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
]
UNLICENSED = ["A driving licence is needed here.", "The mit of the epl is at mpl 2.", "Permission was hereby denied.", "copyright office", "gplus"]


def test_licenses_as_people_write_them(make):
    got = by_id(licenses.scan(make(*enumerate([*[t for t, _ in LICENSED], *UNLICENSED]))))
    assert [label for k, (_, label) in enumerate(LICENSED) if label not in got[k]["labels"].split(",")] == []
    assert [got[k]["labels"] for k in range(len(LICENSED), len(got))] == [""] * len(UNLICENSED)


def license_reference(text):
    """(labels, score) by every rule on its own and all pairs of detections."""
    plain = " " + re.sub(licenses.GAP, " ", text.translate(str.maketrans(licenses.UPPER, licenses.LOWER))).strip() + " "
    found = []
    for k, (label, keyword, pattern, priority) in enumerate(licenses.SIGNATURES):
        for m in re.finditer(f"(?<= )(?:{pattern})(?= )", plain) if keyword in plain else ():
            first = plain[:m.start()].count(" ") - 1
            found.append((first, -first - m[0].count(" "), priority, k, label))
    stay = [d for d in found if not any(e < d and e[1] <= d[1] and e[2] <= d[2] for e in found)]
    base = {label for phrase, label in licenses.BASE if f" {phrase} " in plain}
    return ",".join(sorted(base | {d[4] for d in stay})), max([licenses.TRUST[d[2]] for d in stay], default=0.0)


def test_license_scan_is_that_of_all_rules(make):
    rnd = random.Random(11)
    parts = [*[t for t, _ in LICENSED], *UNLICENSED, *[p for p, _ in licenses.BASE], "or later", "version 2.0", "4.0", "GNU", "licensed", "-", "\n"]
    texts = [rnd.choice((" ", ". ", "\n")).join(rnd.choice(parts) for _ in range(rnd.randint(0, 7))) for _ in range(250)]
    got = by_id(licenses.scan(make(*enumerate(texts))))
    for k, text in enumerate(texts):
        assert (got[k]["labels"], got[k]["score"]) == license_reference(text), text


def test_every_signature_holds_a_gate_word_and_its_keyword():
    for label, keyword, pattern, _ in licenses.SIGNATURES:
        sample = re.sub(r"licen\[sc\]e", "license", pattern)
        assert any(g in sample for g in licenses.GATES), label


# -- near copies ------------------------------------------------------------------------------

def test_ngram_join_finds_every_link(make):
    rnd, rows = random.Random(2), []
    for k in range(60):
        rows.append((k, prose(k, 80)))
    for k in range(60, 140):
        words = rows[rnd.randrange(8)][1].split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(80)] = f"w{rnd.randrange(99)}"
        rows.append((k, " ".join(words)))
    rows += [(200, "one two"), (201, "one two"), (202, ""), (203, None), (204, "  "), (205, "one")]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.join(make(*rows)).collect()}
    assert got == jaccard_classes(rows)


def test_ngram_join_odd_rows(odd, none):
    assert ngram_join.join(odd).count() == odd.count() and ngram_join.join(none).count() == 0
    kept = ngram_join.keep_first(odd)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, 4, 5, 6, 7, 9, None])


def test_banding_reaches_the_recall():
    bands, rows = ngram_join.banding()
    assert 1 - (1 - 0.8 ** rows) ** bands >= ngram_join.RECALL


def test_large_groups_are_cut_into_blocks(make, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK_TEXTS", 7)
    monkeypatch.setattr(ngram_join, "CHUNK_CHARS", 60_000)
    words, rows = prose(5, 120).split(), []
    for k in range(40):
        rows.append((k, " ".join([*words[:k % 120], f"x{k}", *words[k % 120 + 1:]])))
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.join(make(*rows)).collect()}
    assert got == jaccard_classes(rows)


# -- mixing -------------------------------------------------------------------------------------

def test_mixing_stays_within_a_block_of_the_targets(make):
    docs = make(*[(k, "t", "abc"[0 if k % 10 < 6 else 1 if k % 10 < 9 else 2]) for k in range(2000)])
    rows = mixing.mix(docs, {"a": 0.2, "b": 0.5, "c": 0.3}, block_docs=4, period=100).collect()
    assert len(rows) == 2000 and all(r["release"] <= r["slot"] < r["deadline"] for r in rows)
    blocks = {(r["source"], r["block"]): r["slot"] for r in rows}
    slots = {s: b for b, s in blocks.items()}
    assert len(slots) == len(blocks)
    horizon = max(r["slot"] for r in rows if r["in_mix"]) + 1
    sent = Counter()
    parts = {s: Counter(x for x, y in blocks if blocks[x, y] < 100)[s] for s in "abc"}
    for t in range(horizon):
        sent[slots[t][0]] += 1
        assert all(abs(sent[s] - parts[s] / 100 * (t + 1)) < 1 for s in "abc")


def test_mixing_odd_rows(odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and mixing.mix(none).count() == 0
    assert all(r["slot"] is not None and r["key"] == "own" for r in rows)
    assert {r["slot"] for r in mixing.mix(odd, {"else": 1.0}).collect()} == {None}


def test_the_mixing_stage_keeps_every_document(make, spark):
    docs = make(*[(k, "t", "a" if k % 3 else "b") for k in range(4000)], (4000, "t", "c"), (4001, "t", None)).drop("slot")
    got = corpus_pipeline.mix_sources(spark, docs, "").select("doc_id", "source").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(4002))
    order = {r["doc_id"]: (r["slot"], r["place"]) for r in mixing.mix(docs).collect()}
    assert [order[r["doc_id"]] for r in got] == sorted(order.values())
    # The single documents are long gone; the two others still alternate by their weights, a block at a time.
    parts = {r["source"]: r["parts"] for r in mixing.target_weights(docs.where("source IN ('a', 'b')")).collect()}
    last_b = max(i for i, r in enumerate(got) if r["source"] == "b") + 1
    for n in range(16, last_b, 8):
        mine = sum(r["source"] == "a" for r in got[:n])
        assert abs(mine - n * parts["a"] / sum(parts.values())) < 2 * mixing.BLOCK_DOCS


# -- pages --------------------------------------------------------------------------------------------

def test_html_layout():
    page = """<title>T</title><style>.ad{display:none}</style><h1>Head</h1><p>One <b>two</b>
 three<p>Next<ul><li>a<li>b<ul><li>c</ul></ul><ol start=3><li>x<li>y</ol><div class=ad>gone</div><p hidden>gone</p>
<table><tr><th>Name<th>Qty<tr><td>apple<td>1</table><pre> a
  b</pre>tail &amp; &lt;x&gt;<br>end<script>if (a<b) "</p>"</script> after"""
    assert html_text.render(page) == "\n".join([
        "Head", "", "One two three", "", "Next", "", "- a", "- b", "  - c", "", "3. x", "4. y", "",
        "Name  | Qty", "apple | 1", "", " a", "  b", "", "tail & <x>", "end after"])


def test_html_never_fails_and_never_loses_words():
    rnd, bits = random.Random(1), ["<p>", "</p>", "<td>", "<tr>", "</table>", "<table>", "<li>", "<ul>", "</ul>", "<b>", "</b>",
                                   "<", ">", "<!--x-->", "<br>", "<a href='x", "'>", "&amp;", "<div>", "</div>", "<h1>", "</h2>"]
    for _ in range(400):
        parts = []
        for k in range(rnd.randint(0, 25)):
            parts += [rnd.choice(bits[:10] + bits[13:15] + bits[18:]), f"w{k} "]
        text = html_text.render("".join(parts))
        assert re.findall(r"w\d+", text) and set(re.findall(r"w\d+", text)) == set(re.findall(r"w\d+", "".join(parts))) or not parts
        html_text.render("".join(rnd.choice(bits) for _ in range(30)))
    html_text.render("<div>" * 20_000)


@pytest.mark.parametrize("page, text", [
    ("<style>.card{backface-visibility: hidden}</style><p class=card>a<p style='backface-visibility:hidden'>b", "a\n\nb"),
    ("<style>@media print{.m{display:none}}@media (max-width:600px){.m{display:none}} .n{display:none}</style><p class=m>a<p class=n>b", "a"),
    ("<style>@media screen and (min-width:600px){.m{display:none}}</style><style media=print>.n{display:none}</style><p class=m>a<p class=n>b", "b"),
    ("<style>.a{display:none}.a{display:block}</style><p class=a>a", "a"),
    ("<style>.a{display:none !important}p{visibility:hidden}.b,#c{visibility:visible}</style><p class=a>a<p class=b>b<p>d<p id=c>c", "b\n\nc"),
    ("<style>.a{display:none}</style><p class=a style='display:block'>a<p style='color:red;display : none'>b<p hidden>c", "a"),
    ("<style>.a{visibility:hidden}.b{visibility:visible}</style><div class=a>gone <span class=b>seen</span></div>", "seen"),
    ("<!doctype html><style>.Main{display:none}@keyframes x{p{display:none}}</style><p class=main>a", "a"),
    ("x <math><mi>y</mi><mo>=</mo><mn>2</mn><annotation>tex</annotation></math> z", "x y=2 z"),
    ("x<svg><title>t</title><defs/><path d='M0'/>no<text x=1>one</text><text>two</text><defs><text>no</text></defs></svg>y", "x one two y"),
    ("<svg><path><p>after", "after"), ("<map name=m><area href=x><p>in map</map>", "in map"),
    ("a <select><option>one<option selected>two<option>three</select> b", "a two b"),
    ("a <select multiple><option>one<option label=2>two</select> b", "a one 2 b"), ("<select><option disabled>x<option>y</select>", "y")])
def test_html_keeps_what_a_browser_shows(page, text):
    assert html_text.render(page) == text


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, None, "u"), (2, "", "u"), (None, "<p>x", "u"), (2, "", "u")], "page_id long, html string, text string")
    assert Counter((r["page_id"], r["text"], r["n_lines"]) for r in html_text.extract(pages).collect()) == Counter(
        {(1, "", 0): 1, (2, "", 0): 2, (None, "x", 1): 1})


# -- top-k -------------------------------------------------------------------------------------------------

def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    rnd = random.Random(8)
    rows = [(k, [rnd.choice([-0.5, 0.0, 0.25, rnd.random()]) for _ in range(6)], "x") for k in range(-50, 260)]
    rows += [(300, None, "x"), (350, [0.1, None], "x"), (400, [float("nan")] * 6, "x"), (None, [0.5] * 6, "x"), (100, rows[150][1], "x"),
             (450, [0.0] * 6, "x"), (500, [1.0, 2.0], "x"), (501, [3.0, 4.0], "x"), (550, [], "x")]
    got = Counter(tuple(r) for r in topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")).collect())
    whole = {(i, tuple(int(np.floor(256 * x)) for x in v)) for i, v, _ in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = Counter()
    for q, a in whole:
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))[:5]
            want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(best))
    assert got == want


# -- all -------------------------------------------------------------------------------------------------------

def test_empty_tables(none, no_labels, spark):
    assert packing.pack(none).count() == 0 and quality.judge(none).count() == 0 and quality.keep_good(none).count() == 0
    assert line_dedup.dedup(none).count() == 0 and licenses.scan(none).count() == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_odd_rows_in_line_dedup(odd):
    rows = line_dedup.dedup(odd).collect()
    assert len(rows) == odd.count() and Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd.collect())
    assert [r["text"] for r in rows if r["doc_id"] == 8] == [""]
