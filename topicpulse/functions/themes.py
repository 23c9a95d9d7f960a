"""Theme of a term or text by keyword substring."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicpulse.config import THEME_KEYWORDS

NO_THEME = "outros"


def categorize(col: Column, lexicon: Mapping[str, Iterable[str]] = THEME_KEYWORDS,
               mode: str = "contains") -> Column:
    """First theme, in lexicon order, with a keyword inside the lower-cased text.

    ``mode="word"`` asks for the keyword as a whole word instead of any substring.
    """
    text = F.lower(F.coalesce(col, F.lit("")))

    def hit(keyword: str) -> Column:
        if mode == "contains":
            return text.contains(keyword)
        return text.rlike(r"(?:^|[^\p{L}\p{N}_])\Q" + keyword + r"\E(?:$|[^\p{L}\p{N}_])")

    if mode not in ("contains", "word"):
        raise ValueError(f"unknown theme mode: {mode}")
    out = None
    for tema, keywords in lexicon.items():
        cond = reduce(lambda a, b: a | b, [hit(k.lower()) for k in keywords])
        out = F.when(cond, tema) if out is None else out.when(cond, tema)
    return F.lit(NO_THEME) if out is None else out.otherwise(NO_THEME)
