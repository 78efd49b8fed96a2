"""Search text to words: letters and digits by word, CJK by overlapping pairs."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

# Fixed patterns: CJK ideographs, and runs of other letters and digits.
CJK = r"\x{4e00}-\x{9fff}"
WORD = rf"[\p{{L}}\p{{N}}&&[^{CJK}]]+"
PAIR = rf"(?=([{CJK}]{{2}}))"
SINGLE = rf"(?<![{CJK}])[{CJK}](?![{CJK}])"


def words(text: Column) -> Column:
    """Array of words of a text: first the plain words, then the CJK pairs and lone characters.

    A CJK run gives its overlapping two-character pairs, or itself if it is one character.
    """
    lower = F.lower(text)

    def every(pattern: str, group: int) -> Column:
        return F.regexp_extract_all(lower, F.lit(pattern), F.lit(group))

    plain = every(WORD, 0)
    found = F.when(lower.rlike(f"[{CJK}]"), F.concat(plain, every(PAIR, 1), every(SINGLE, 0))) \
        .otherwise(plain)
    # a text without any word stays whole, as when segmentation fails
    return F.when(F.size(found) > 0, found).when(text.isNotNull(), F.array(text))


def explode_words(df: DataFrame, text: str, out: str = "word",
                  segment: Callable[[pd.Series], pd.Series] | None = None) -> DataFrame:
    """One row per word. `segment` replaces the built-in rule: a series of texts to a series of
    word lists, run as a vectorised function."""
    if segment is None:
        found = words(F.col(text))
    else:
        found = F.pandas_udf(segment, T.ArrayType(T.StringType()))(F.col(text))
    return df.withColumn(out, F.explode(found))


def _divide(text: str) -> list[str]:
    """The rule of `words` for one text."""
    lower, cjk = text.lower(), "[\u4e00-\u9fff]+"
    plain = [w for run in re.findall(r"[^\W_]+", lower) for w in re.split(cjk, run) if w]
    runs = re.findall(cjk, lower)
    pairs = [run[k:k + 2] for run in runs for k in range(len(run) - 1)]
    return plain + pairs + [run for run in runs if len(run) == 1] or [text]


def register_split(spark, name: str = "split_words",
                   split: Callable[[str], Iterator[str]] | None = None) -> None:
    """Register a table function for `LATERAL split_words(text)`.

    It splits like `words`; for SQL users who need their own splitter, `split` replaces the rule.
    A text that the splitter fails on stays whole. `explode_words` is the fast path.
    """
    divide = split or _divide

    @udtf(returnType="word string", useArrow=True)
    class SplitWords:
        def eval(self, text: str):
            if text is None:
                return
            try:
                found = list(divide(text))
            except Exception:
                found = [text]
            for word in found:
                yield (word,)

    spark.udtf.register(name, SplitWords)
