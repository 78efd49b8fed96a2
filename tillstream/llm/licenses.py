"""License scans by ordered signature rules.

A text becomes its words, in lower case and one space apart. A rule is a pattern over that, with a
keyword: only rules whose keyword is in the text run. Each detection is an interval of words. One
that lies inside a detection of the same or a stronger priority is dropped, so the name of a
license inside its full citation doesn't count again; those that only overlap all stay.

Rules are written per license family: its name, its short name, its versions. Templates make the
signatures from these, from the strongest to the weakest: SPDX tags, a name with version and "or
later", a name with version, grants that name the license, the name alone, the short name. Notices,
sentences of the licenses' own texts and exceptions are rules of their own.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# The phrases every scan counts, with their labels.
BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"),
        ("mit license", "mit")]

# A text without any of these has no detection: each signature below holds one of them.
GATES = ["licen", "cc by", "cc0", "creative commons", "creativecommons", "public domain", "copyleft",
         "gpl", "all rights reserved", "copyright", "redistribution", "wtfpl", "express or implied", "permission is hereby",
         "permission to use", "source agreement"]
# Labels that people use as a name: "MPL licensed", "License: MIT", "licensed under EPL 2.0". Those of
# BARE also stand alone: "GPLv3", "LGPL 2.1".
CALLED = ["gpl", "lgpl", "agpl", "mpl", "epl", "cddl", "eupl", "apache", "mit", "isc", "bsd", "bsd 2 clause", "bsd 3 clause",
          "zlib", "wtfpl", "unlicense", "cecill"]
BARE = ["gpl", "lgpl", "agpl"]

# (label, keyword, name, short name, versions); names are patterns over words.
FAMILIES = [
    ("gpl", "general public", "gnu general public licen[sc]e", "gnu gpl", ["1 0", "1", "2 0", "2", "3 0", "3"]),
    ("lgpl", "general public", "gnu (?:lesser|library) general public licen[sc]e", "gnu lgpl",
     ["2 0", "2", "2 1", "3 0", "3"]),
    ("agpl", "general public", "gnu affero general public licen[sc]e", "gnu agpl", ["1 0", "1", "3 0", "3"]),
    ("gfdl", "documentation", "gnu free documentation licen[sc]e", "gnu fdl licen[sc]e", ["1 1", "1 2", "1 3"]),
    ("apache", "apache", "apache (?:software )?licen[sc]e", "apache licen[sc]ed?", ["1 0", "1 1", "2 0", "2"]),
    ("mpl", "mozilla", "mozilla public licen[sc]e", "mozilla licen[sc]e", ["1 0", "1 1", "2 0", "2"]),
    ("epl", "eclipse", "eclipse public licen[sc]e", "eclipse licen[sc]e", ["1 0", "2 0"]),
    ("edl", "eclipse", "eclipse distribution licen[sc]e", "eclipse distribution licen[sc]e", ["1 0"]),
    ("cddl", "common development", "common development and distribution licen[sc]e", "cddl licen[sc]e",
     ["1 0", "1 1"]),
    ("cpl", "common public", "common public licen[sc]e", "cpl licen[sc]e", ["0 5", "1 0"]),
    ("cpal", "common public attribution", "common public attribution licen[sc]e", "cpal licen[sc]e", ["1 0"]),
    ("eupl", "european union", "european union public licen[sc]e", "eupl licen[sc]e", ["1 0", "1 1", "1 2"]),
    ("osl", "open software", "open software licen[sc]e", "osl licen[sc]e", ["1 0", "2 0", "2 1", "3 0"]),
    ("afl", "academic free", "academic free licen[sc]e", "afl licen[sc]e", ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("artistic", "artistic", "artistic licen[sc]e", "perl artistic licen[sc]e", ["1 0", "2 0"]),
    ("psf", "python software", "python software foundation licen[sc]e", "psf licen[sc]e", ["2"]),
    ("bsl", "boost", "boost software licen[sc]e", "boost licen[sc]e", ["1 0"]),
    ("busl", "business source", "business source licen[sc]e", "busl licen[sc]e", ["1 0", "1 1"]),
    ("sspl", "server side", "server side public licen[sc]e", "sspl licen[sc]e", ["1"]),
    ("elastic", "elastic", "elastic licen[sc]e", "elastic licen[sc]e", ["1 0", "2 0"]),
    ("cecill", "cecill", "cecill (?:free software )?licen[sc]e", "cecill licen[sc]e", ["1 0", "1 1", "2 0", "2 1"]),
    ("ofl", "open font", "(?:sil )?open font licen[sc]e", "ofl licen[sc]e", ["1 0", "1 1"]),
    ("zpl", "zope", "zope public licen[sc]e", "zpl licen[sc]e", ["1 1", "2 0", "2 1"]),
    ("php", "php", "php licen[sc]e", "php licen[sc]e", ["3 0", "3 01"]),
    ("ms-pl", "microsoft", "microsoft public licen[sc]e", "ms pl licen[sc]e", []),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e", "ms rl licen[sc]e", []),
    ("lppl", "latex", "latex project public licen[sc]e", "lppl licen[sc]e", ["1 0", "1 1", "1 2", "1 3a", "1 3c"]),
    ("openssl", "openssl", "openssl licen[sc]e", "openssl ssleay licen[sc]e", []),
    ("zlib", "zlib", "zlib(?: libpng)? licen[sc]e", "zlib licen[sc]ed", []),
    ("libpng", "libpng", "libpng licen[sc]e", "png reference library licen[sc]e", ["2 0"]),
    ("ijg", "jpeg", "independent jpeg group licen[sc]e", "ijg jpeg licen[sc]e", []),
    ("mit", "mit", "mit licen[sc]e", "mit x11 licen[sc]e", []),
    ("mit-0", "mit", "mit no attribution licen[sc]e", "mit 0 licen[sc]e", []),
    ("x11", "x11", "x11 licen[sc]e", "x11 style licen[sc]e", []),
    ("isc", "isc", "isc licen[sc]e", "internet systems consortium licen[sc]e", []),
    ("bsd", "bsd", "(?:new |modified |revised |simplified |original )?bsd licen[sc]e", "bsd style licen[sc]e", []),
    ("bsd-2-clause", "bsd", "bsd 2 clause licen[sc]e", "(?:2|two) clause bsd licen[sc]e", []),
    ("bsd-3-clause", "bsd", "bsd 3 clause licen[sc]e", "(?:3|three) clause bsd licen[sc]e", []),
    ("bsd-4-clause", "bsd", "bsd 4 clause licen[sc]e", "(?:4|four) clause bsd licen[sc]e", []),
    ("0bsd", "bsd", "zero clause bsd licen[sc]e", "0bsd licen[sc]e", []),
    ("unlicense", "unlicense", "the unlicense", "unlicense org", []),
    ("wtfpl", "wtfpl", "wtfpl(?: public licen[sc]e)?", "licen[sc]e wtfpl", ["1 0", "2"]),
    ("ncsa", "illinois", "university of illinois ncsa(?: open source)? licen[sc]e", "illinois licen[sc]e", []),
    ("upl", "universal permissive", "universal permissive licen[sc]e", "upl licen[sc]e", ["1 0"]),
    ("vim", "vim", "vim licen[sc]e", "vim licen[sc]ed", []),
    ("ruby", "ruby", "ruby licen[sc]e", "ruby s licen[sc]e", []),
    ("tcl", "tcl", "tcl tk licen[sc]e", "tcl licen[sc]e", []),
    ("postgresql", "postgresql", "postgresql licen[sc]e", "postgresql database licen[sc]e", []),
    ("odbl", "database", "open (?:data commons open )?database licen[sc]e", "odbl licen[sc]e", ["1 0"]),
    ("pddl", "public domain dedication", "public domain dedication and licen[sc]e", "pddl licen[sc]e", ["1 0"]),
    ("odc-by", "attribution", "open data commons attribution licen[sc]e", "odc by licen[sc]e", ["1 0"]),
    ("ogl", "open government", "open government licen[sc]e", "ogl licen[sc]e", ["1 0", "2 0", "3 0"]),
    ("cdla", "community data", "community data licen[sc]e agreement", "cdla licen[sc]e", ["1 0", "2 0"]),
    ("openrail", "responsible", "(?:open )?responsible ai licen[sc]e", "responsible ai licen[sc]es", []),
    ("mulan", "mulan", "mulan permissive software licen[sc]e", "mulan psl licen[sc]e", ["1", "2"]),
    ("hippocratic", "hippocratic", "hippocratic licen[sc]e", "hippocratic licen[sc]ed", ["1 0", "2 1", "3 0"]),
    ("apsl", "apple", "apple public source licen[sc]e", "apple licen[sc]e", ["1 0", "1 1", "2 0"]),
    ("ibm-pl", "ibm", "ibm public licen[sc]e", "ibm licen[sc]e", ["1 0"]),
    ("nasa", "nasa", "nasa open source agreement", "nasa licen[sc]e", ["1 3"]),
    ("qpl", "q public", "q public licen[sc]e", "the q public licen[sc]e", ["1 0"]),
    ("sleepycat", "sleepycat", "sleepycat licen[sc]e", "sleepycat software licen[sc]e", []),
    ("w3c", "w3c", "w3c (?:software )?(?:notice and )?licen[sc]e", "w3c document licen[sc]e", []),
    ("blueoak", "blue oak", "blue oak model licen[sc]e", "blue oak licen[sc]e", ["1 0 0"]),
    ("cc-by", "cc by", "cc by", "cc by licen[sc]e", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", "cc by", "cc by sa", "cc by sa licen[sc]e", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc", "cc by", "cc by nc", "cc by nc licen[sc]e", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", "cc by", "cc by nd", "cc by nd licen[sc]e", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-sa", "cc by", "cc by nc sa", "cc by nc sa licen[sc]e", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nc-nd", "cc by", "cc by nc nd", "cc by nc nd licen[sc]e", ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc0", "cc0", "cc0", "cc0 public domain dedication", ["1 0"]),
]

# Signatures outside the families: (label, keyword, pattern, priority).
SINGLE = [
    ("cc-by", "creative commons", "creative commons attribution(?: \\d \\d)?(?: international| generic| unported)? licen[sc]e", 1),
    ("cc-by-sa", "creative commons", "creative commons attribution share ?alike(?: \\d \\d)?(?: international| unported)? licen[sc]e", 1),
    ("cc-by-nc", "creative commons", "creative commons attribution non ?commercial(?: \\d \\d)?(?: international| unported)? licen[sc]e", 1),
    ("cc-by-nd", "creative commons", "creative commons attribution no ?deriv(?:ative)?s?(?: \\d \\d)?(?: international| unported)? licen[sc]e", 1),
    ("cc-by-nc-sa", "creative commons", "creative commons attribution non ?commercial share ?alike(?: \\d \\d)?(?: international| unported)? licen[sc]e", 1),
    ("cc-by-nc-nd", "creative commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: \\d \\d)?(?: international| unported)? licen[sc]e", 1),
    ("cc", "creative commons", "creative commons licen[sc]e", 3),
    ("cc-by", "creativecommons", "creativecommons org licen[sc]es by \\d \\d", 0),
    ("cc-by-sa", "creativecommons", "creativecommons org licen[sc]es by sa \\d \\d", 0),
    ("cc-by-nc", "creativecommons", "creativecommons org licen[sc]es by nc \\d \\d", 0),
    ("cc-by-nd", "creativecommons", "creativecommons org licen[sc]es by nd \\d \\d", 0),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licen[sc]es by nc sa \\d \\d", 0),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licen[sc]es by nc nd \\d \\d", 0),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero 1 0", 0),
    ("public-domain", "public domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", 2),
    ("public-domain", "public domain", "is in the public domain", 2),
    ("proprietary", "all rights reserved", "all rights reserved", 4),
    ("copyleft", "copyleft", "copyleft licen[sc]ed?", 4),
    ("mit", "permission is hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software", 1),
    ("isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose with or without fee", 1),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 1),
    ("bsd-3-clause", "copyright", "neither the name of the copyright holders? nor the names of its contributors", 1),
    ("zlib", "express or implied", "this software is provided as is without any express or implied warranty", 2),
    ("apache-2.0", "apache", "www apache org licen[sc]es licen[sc]e 2 0", 0),
    ("gpl", "gnu", "www gnu org licen[sc]es gpl(?: \\d \\d)?", 0),
    ("lgpl", "gnu", "www gnu org licen[sc]es lgpl(?: \\d \\d)?", 0),
    ("agpl", "gnu", "www gnu org licen[sc]es agpl(?: \\d \\d)?", 0),
    ("mpl-2.0", "mozilla", "mozilla org mpl 2 0 licen[sc]e", 0),
    ("mit", "opensource", "opensource org licen[sc]es mit", 0),
    ("bsd-3-clause", "opensource", "opensource org licen[sc]es bsd 3 clause", 0),
    # Notices and sentences of the licenses' own texts.
    ("gpl", "free software", "free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e", 1),
    ("lgpl", "free software", "free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e", 1),
    ("agpl", "free software", "free software you can redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e", 1),
    ("gpl", "verbatim", "everyone is permitted to copy and distribute verbatim copies of this licen[sc]e document but changing it is not allowed", 2),
    ("wtfpl", "verbatim", "everyone is permitted to copy and distribute verbatim or modified copies of this licen[sc]e document", 1),
    ("gfdl", "copy distribute", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e", 1),
    ("apache-2.0", "in compliance", "licen[sc]ed under the apache licen[sc]e version 2 0 the licen[sc]e you may not use this file except in compliance with the licen[sc]e", 0),
    ("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0", 0),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public licen[sc]e version 1 1", 0),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e", 1),
    ("cddl", "common development", "the contents of this file are subject to the terms of the common development and distribution licen[sc]e", 1),
    ("bsl-1.0", "permission is hereby", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[sc]e", 0),
    ("mit", "copyright", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 1),
    ("isc", "copyright", "provided that the above copyright notice and this permission notice appear in all copies", 1),
    ("bsd", "copyright", "redistributions of source code must retain the above copyright notice", 2),
    ("bsd", "copyright", "redistributions in binary form must reproduce the above copyright notice", 2),
    ("hpnd", "permission to use", "permission to use copy modify and distribute this software and its documentation for any purpose", 1),
    ("unlicense", "public domain", "this is free and unencumbered software released into the public domain", 0),
    ("ofl-1.1", "font software", "this font software is licen[sc]ed under the sil open font licen[sc]e version 1 1", 0),
    ("psf", "python software", "this licen[sc]e agreement is between the python software foundation", 1),
    # Exceptions to a license.
    ("gpl-2.0-with-classpath-exception", "classpath", "spdx licen[sc]e identifier gpl 2 0(?: only| or later)? with classpath exception 2 0", 0),
    ("gpl-2.0-with-classpath-exception", "classpath", "gpl ?v?2(?: 0)?(?: only| or later)? with(?: the)? classpath exception(?: 2 0)?", 1),
    ("gpl-3.0-with-gcc-exception", "gcc", "gpl ?v?3(?: 0)?(?: only| or later)? with(?: the)? gcc(?: runtime library)? exception(?: 3 1)?", 0),
    ("apache-2.0-with-llvm-exception", "llvm", "apache(?: licen[sc]e)?(?: v| version)? ?v?2 0 with llvm exceptions?", 0),
    ("gpl", "exception", "as a special exception to the gnu general public licen[sc]e", 2),
    ("commercial", "commercial licen", "commercial licen[sc]e", 4),
    ("proprietary", "proprietary licen", "proprietary licen[sc]e", 4),
]

# Trust in a detection by its priority, 0 the strongest.
TRUST = [1.0, 0.95, 0.9, 0.8, 0.5]
GRANT = "(?:licen[sc]ed|released|distributed|available|published) under(?: the)?(?: terms of the)?(?: terms and conditions of the)?"


def _signatures() -> list[tuple[str, str, str, int]]:
    """(label, keyword, pattern, priority) of every rule, strongest first."""
    out = list(SINGLE)
    for label, keyword, name, short, versions in FAMILIES:
        tag = label.replace("-", " ")
        out.append((label, tag, f"spdx licen[sc]e identifier {tag}", 0))
        out.append((label, keyword, f"{GRANT} {name}", 2))
        out.append((label, keyword, name, 3))
        out.append((label, keyword if keyword.split()[0] in short else short.split()[0], short, 3))
        if tag in CALLED:
            out.append((label, tag, f"{tag} licen[sc]ed", 3))
            out.append((label, tag, f"licen[sc]ed? (?:is )?(?:under )?(?:the )?{tag}", 3))
        if tag in BARE:
            out.append((label, tag, tag, 4))
        for version in versions:
            called = f"{tag}(?: version| v)? ?v?{version}"
            if tag in CALLED:
                out.append((f"{label}-{version.replace(' ', '.')}", tag, f"licen[sc]ed? (?:is )?(?:under )?(?:the )?{called}", 2))
            if tag in BARE:
                out.append((f"{label}-{version.replace(' ', '.')}", tag, called, 2))
                out.append((f"{label}-{version.replace(' ', '.')}-or-later", tag, f"{called} or(?: at your option)?(?: any)? later", 1))
            numbered = f"{label}-{version.replace(' ', '.')}"
            out.append((numbered, tag, f"spdx licen[sc]e identifier {tag} {version}(?: only)?", 0))
            out.append((f"{numbered}-or-later", tag, f"spdx licen[sc]e identifier {tag} {version} or later", 0))
            out.append((numbered, keyword, f"(?:{GRANT} )?{name}(?: version| v)? v?{version}", 1))
            out.append((f"{numbered}-or-later", keyword,
                        f"(?:{GRANT} )?{name}(?: version| v)? v?{version} or(?: at your option)?(?: any)? later(?: version)?", 0))
    return sorted(out, key=lambda r: r[3])


SIGNATURES = _signatures()


def words_text(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, each with one space before and after it."""
    plain = F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), GAP, " "))
    return F.concat(F.lit(" "), plain, F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def _marked(text: Column, pattern: Column) -> Column:
    """The text cut before each detection, its end marked; the pieces after the first hold one each."""
    bounded = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    return F.split(F.regexp_replace(text, bounded, F.lit("\x01$0\x02")), "\x01")


def _rules() -> Column:
    rows = [{"rule": k, "label": label, "keyword": keyword, "pattern": pattern, "priority": priority}
            for k, (label, keyword, pattern, priority) in enumerate(SIGNATURES)]
    return F.from_json(F.lit(json.dumps(rows)),
                       "array<struct<rule: int, label: string, keyword: string, pattern: string, priority: int>>")


def detections(texts: DataFrame) -> DataFrame:
    """(key, label, priority, first_word, last_word, kept) of every rule's detections.

    `texts` has one row per `key` with `words` (see words_text).
    """
    gated = texts.select("key", "words", F.explode(
        F.filter(_rules(), lambda r: F.contains(F.col("words"), r["keyword"]))).alias("r"))
    pieces = gated.select("key", "r", F.posexplode(_marked(F.col("words"), F.col("r.pattern"))).alias("n", "piece"))
    by_rule = Window.partitionBy("key", "r.rule").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.substring_index("piece", "\x02", 1)
    found = (pieces.select("key", "r", "n", _spaces(F.col("piece")).alias("spaces"), _spaces(inner).alias("inner"))
             .withColumn("first_word", F.sum("spaces").over(by_rule) - 1)
             .where(F.col("n") > 0)
             .withColumn("last_word", F.col("first_word") + F.col("inner")))
    # Sorted so, whatever holds a detection stands before it.
    before = (Window.partitionBy("key").orderBy("first_word", F.desc("last_word"), "r.priority", "r.rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    reach = F.coalesce(*[F.when(F.col("r.priority") == p, F.max(F.when(F.col("r.priority") <= p, F.col("last_word"))).over(before))
                         for p in range(len(TRUST))], F.lit(-1))
    return found.select("key", "r.label", "r.priority", "first_word", "last_word",
                        (reach < F.col("last_word")).alias("kept"))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: its words, the base phrases' places, the labels and a score.

    Reads doc_id and text, whatever else the table has. A null text is empty: no words, no labels,
    score 0. Equal texts get equal results; an empty table gives no rows. The score is the trust in
    the strongest detection that stays.
    """
    gate = F.lit(False)
    for word in GATES:
        gate = gate | F.contains(F.col("words"), F.lit(word))
    rows = (docs.select(F.col("doc_id"), words_text(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))
            .select("doc_id", F.when(F.trim("words") == "", F.lit(0)).otherwise(_spaces(F.col("words")) - 1)
                    .cast("long").alias("n_words"), F.when(gate, F.col("words")).alias("words"))
            .select("doc_id", "n_words", "words", F.md5("words").alias("key")))
    rows = stored(rows, "words")  # texts are read once; those without a gate word aren't kept
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flagged = (rows.where(F.col("key").isNotNull()).select("key", "words")
               .repartition(tasks, "key").dropDuplicates(["key"]))  # few bytes, but much work for each
    trust = F.element_at(F.array(*map(F.lit, TRUST)), F.col("priority") + 1)
    per_text = (detections(flagged).where("kept").groupBy("key")
                .agg(F.collect_set("label").alias("labels"), F.max(trust).alias("score")))
    none = F.array().cast("array<string>")
    # Rows without a key have nothing to join with, and would meet in one task.
    joined = (rows.drop("words").where(F.col("key").isNotNull())
              .join(phrases(flagged), "key", "left").join(per_text, "key", "left")
              .unionByName(rows.drop("words").where(F.col("key").isNull()), allowMissingColumns=True))
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.array_join(F.array_sort(F.coalesce("own", none)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(F.coalesce("own", none), F.coalesce("labels", none))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def phrases(texts: DataFrame) -> DataFrame:
    """(key, n_base, first_word, last_word, own) of the texts that hold a base phrase.

    Every base phrase holds a gate word, so no other text can have one.
    """
    found = (texts.select("key", F.explode(F.array(*[
        F.struct(F.lit(label).alias("label"), _marked(F.col("words"), F.lit(phrase)).alias("pieces"))
        for phrase, label in BASE])).alias("x")).where(F.size("x.pieces") > 1))
    spaces = F.transform(F.slice("x.pieces", 1, F.size("x.pieces") - 1), _spaces)
    return (found.select("key", "x.label", (F.size("x.pieces") - 1).alias("n"),
                         (_spaces(F.get("x.pieces", F.lit(0))) - 1).cast("long").alias("first"),
                         F.aggregate(spaces, F.lit(-1), lambda a, b: a + b).cast("long").alias("last"))
            .groupBy("key").agg(F.sum("n").alias("n_base"), F.min("first").alias("first_word"),
                                F.max("last").alias("last_word"), F.collect_set("label").alias("own")))
