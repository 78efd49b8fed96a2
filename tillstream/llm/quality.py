"""Quality rules by weak supervision.

Each rule votes for a document (1), against it (-1) or abstains (0). Nobody says how good a rule
is: expectation-maximisation over all documents' votes estimates, for good and for bad documents,
how often each rule gives each vote, and the share of good ones. A document's posterior
probability of being good then replaces "all rules must pass". Only the counts of the distinct
vote patterns matter, at most 3 to the power of the number of rules, so the fit is one expression
over one small array; counting them is a scan of all documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import stored

# Fixed values of the base rule.
SPACE = "[\\x20\\x09-\\x0D]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]+"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

# A document is kept if its posterior is at least this.
KEEP = 0.5
ROUNDS = 25
# Beliefs before the first round: the share of good documents, and how often a rule votes against,
# abstains and votes for a good and a bad one. A bad document has one defect or two, so most rules
# still vote for it, and a vote against says much more than a vote for.
PRIOR, SMOOTH = 0.85, 1.0
# They count in every round like this part of the documents, so a fit is as firm on a small table as
# on a large one.
BELIEF = 0.1
VOTES_IF_GOOD, VOTES_IF_BAD = (0.01, 0.04, 0.95), (0.30, 0.04, 0.66)

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
            "n_distinct", "n_lettered", "n_stops", "n_shouts"]


# name: (measure, bad from, good up to) of one or more parts. A vote against where a part reaches the
# first, a vote for where none exceeds the second, none between. Measures of one defect are parts of
# one rule: as rules of their own they would agree on nearly every document, and the estimation would
# take their defect for the only one there is.
RULES = {
    "symbols": [("n_symbols / greatest(n_words, 1)", 0.1, 0.02)],
    "capitals": [("n_capitals / greatest(word_chars, 1)", 0.3, 0.1)],
    "repetition": [("n_repeat_words / greatest(n_words, 1)", 0.3, 0.02),
                   ("n_dup_lines / greatest(n_lines, 1)", 0.5, 0.0),
                   # The logarithms' ratio hardly depends on the length of a text.
                   ("1 - ln(1 + n_distinct) / ln(2 + n_words)", 0.25, 0.15)],
    "no_letters": [("1 - n_lettered / greatest(n_words, 1)", 0.3, 0.1)],
    "word_length": [("abs(word_chars / greatest(n_words, 1) - 5.5)", 4.5, 1.5)],
    "long_sentences": [("n_words / (n_stops + 1)", 80.0, 40.0)],
    "shouting": [("n_shouts / greatest(n_words, 1)", 0.2, 0.02)],
    "too_short": [("-n_words", -10.0, -40.0)],
}


def measures(docs: DataFrame, kept: list[str]) -> DataFrame:
    """The `kept` columns and what the rules look at; a null text is empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    plain = docs.select(*[F.col(f"`{c}`") for c in kept], text.alias("_text"))
    words = F.array_remove(F.split("_text", SPACE), "")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.rlike(x, F.lit(NOT_SPACE)))
    gone = lambda pattern: F.length("_text") - F.length(F.regexp_replace("_text", pattern, ""))
    step = plain.withColumns({"_words": words, "_lines": lines}).withColumns({
        "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": gone(SYMBOLS).cast("long"),
        "n_capitals": gone("\\p{Lu}+").cast("long"),
        "n_shouts": gone("!+").cast("long"),
        "n_stops": F.regexp_count("_text", F.lit("[.!?…。](?=\\s|$)")).cast("long"),
        "n_lettered": F.regexp_count("_text", F.lit("[^\\x20\\x09-\\x0D\\p{L}]*\\p{L}" + NOT_SPACE + "*")).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
    }).drop("_text", "_words", "_lines")
    last = F.size("_hashes") - WINDOW
    step = step.withColumn("_windows", F.when(last >= 0, F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(0)) + 1),
        lambda i: F.xxhash64(F.slice("_hashes", i, F.lit(WINDOW))))))
    step = step.withColumns({
        "n_distinct": F.size(F.array_distinct("_hashes")).cast("long"),
        "_sorted": F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.array_sort(F.transform(
            "_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))}).drop("_hashes", "_windows")
    near = lambda j: F.get("_sorted", j)["h"]
    starts = F.array_sort(F.transform(F.filter(
        "_sorted", lambda x, j: (x["h"] == near(F.greatest(j - 1, F.lit(0)))) & (j > 0) | x["h"].eqNullSafe(near(j + 1))),
        lambda x: x["i"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("at"), (s["n"] + F.least(F.lit(WINDOW), i - s["at"])).alias("n")))
    return (step.withColumn("n_repeat_words", F.coalesce(covered["n"], F.lit(0)).cast("long"))
            .select(*kept, *MEASURES))


def votes() -> Column:
    def vote(parts: list[tuple[str, float, float]]) -> Column:
        against = F.greatest(*[F.expr(m) >= bad for m, bad, _ in parts], F.lit(False))
        good = F.least(*[F.expr(m) <= good for m, _, good in parts], F.lit(True))
        return F.when(against, -1).when(good, 1).otherwise(0)
    return F.array(*[vote(parts) for parts in RULES.values()])


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def fit(voted: DataFrame, rounds: int = ROUNDS) -> tuple[float, list[float]]:
    """(log-odds of a good document, weights) from the column `votes` of all documents.

    weights[3 * rule + vote + 1] is what that vote adds to the log-odds. A vote against never adds,
    a vote for never takes away. No documents: the start.
    """
    rules = len(RULES)
    patterns = voted.groupBy("votes").agg(F.count(F.lit(1)).cast("double").alias("n"))
    start = ", ".join(f"ln({good}D / {bad}D)" for _ in range(rules) for good, bad in zip(VOTES_IF_GOOD, VOTES_IF_BAD))
    scored = """transform(patterns, x -> struct(x.votes AS votes, x.n AS n,
        1 / (1 + exp(-least(greatest(s.odds + aggregate(transform(x.votes, (v, j) -> s.weights[3 * j + v + 1]),
            CAST(0 AS DOUBLE), (a, w) -> a + w), -50D), 50D))) AS p))"""
    total = "aggregate(e, CAST(0 AS DOUBLE), (a, x) -> a + x.n)"
    # (sum + strength * belief) / (all + strength): the beliefs stand for that many more documents
    share = f"""(aggregate(filter(e, x -> x.votes[CAST(floor(k / 3) AS INT)] = k % 3 - 1), CAST(0 AS DOUBLE),
        (a, x) -> a + x.n * {{p}}) + ({BELIEF}D * {{part}} * {total} + {SMOOTH}D) * array({{belief}})[k % 3])
        / (aggregate(e, CAST(0 AS DOUBLE), (a, x) -> a + x.n * {{p}}) + {BELIEF}D * {{part}} * {total} + {SMOOTH}D)"""
    good, bad = (share.format(p=p, part=f"{part:.6f}D", belief=", ".join(f"{b}D" for b in belief)) for p, part, belief in (
        ("x.p", PRIOR, VOTES_IF_GOOD), ("(1 - x.p)", 1 - PRIOR, VOTES_IF_BAD)))
    mean = f"""(aggregate(e, CAST(0 AS DOUBLE), (a, x) -> a + x.n * x.p) + {PRIOR}D * ({BELIEF}D * {total} + {SMOOTH}D))
        / ({total} + {BELIEF}D * {total} + {SMOOTH}D)"""
    update = f"""transform(array({scored}), e -> struct(ln({mean} / (1 - {mean})) AS odds,
        transform(sequence(0, {3 * rules - 1}), k -> CASE k % 3
            WHEN 0 THEN least(0D, ln({good} / ({bad}))) WHEN 2 THEN greatest(0D, ln({good} / ({bad})))
            ELSE ln({good} / ({bad})) END) AS weights))[0]"""
    fitted = (patterns.agg(F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("patterns"))
              .select(F.expr(f"""aggregate(sequence(1, {rounds}),
                  struct(ln({PRIOR}D / {1 - PRIOR}D) AS odds, array({start}) AS weights),
                  (s, i) -> {update})""").alias("s"))).first()["s"]
    return fitted["odds"], list(fitted["weights"])


def posterior(fitted: tuple[float, list[float]]) -> Column:
    """The probability that a document with these `votes` is a good one."""
    odds, weights = fitted
    table = F.array(*map(F.lit, weights))
    added = F.lit(odds)
    for j in range(len(RULES)):
        added = added + F.get(table, 3 * j + 1 + F.get("votes", F.lit(j)))
    return F.round(1 / (1 + F.exp(-F.greatest(F.least(added, F.lit(50.0)), F.lit(-50.0)))), 6)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and quality (the posterior) of each document.

    Reads doc_id and text, whatever else the table has. A null or empty text has no words and fails
    the base rule; a null doc_id stays null; repeated rows are judged alike and count as often as
    they come; an empty table gives no rows.
    """
    voted = stored(measures(docs, ["doc_id"]).withColumn("votes", votes()), "votes")
    return (voted.withColumn("quality", posterior(fit(voted))).withColumn("base_failed", base_failed())
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("quality") >= KEEP)).alias("kept"), "quality", "votes"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns.

    Texts are measured once: rows are written with their votes, then filtered by what the votes of
    all rows give. Odd rows are judged as `judge` does; rows without a doc_id are kept or not by their
    texts, repeated rows all or none. An empty table gives no rows.
    """
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)])
    judged = stored(measures(docs.select(whole.alias("_row"), "text"), ["_row"])
                    .select("_row", votes().alias("votes"), base_failed().alias("base_failed")), "judged")
    kept = judged.where(~F.col("base_failed") & (posterior(fit(judged.select("votes"))) >= KEEP))
    return kept.select(*[F.col(f"_row.c{k}").alias(c) for k, c in enumerate(docs.columns)])
