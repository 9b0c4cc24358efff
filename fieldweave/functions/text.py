"""Column functions of the keyword search.

Indexed text is cut at everything but letters and digits into runs, and each
run into its grams of 2 to 10 characters, which are then lowercased. A query
word is looked up whole, so it matches where it has 2 to 10 letters or digits
and occurs inside a run.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldweave.schema import MAX_GRAM, MIN_GRAM

RUN = r"[\p{L}\p{Nd}]+"
BETWEEN = r"[^\p{L}\p{Nd}]+"
# Words of a query: ideographs and kana stand alone, an apostrophe, full stop or
# colon joins two letters, a full stop or comma two digits, an underscore anything.
_CHAR = r"[\p{L}\p{Nd}\p{M}_&&[^\p{IsHan}\p{IsHiragana}]]"
_JOINED = r"(?:(?<=\p{L})[.:'’·](?=\p{L})|(?<=\p{Nd})[.,;'’](?=\p{Nd}))"
WORD = rf"{_CHAR}+(?:{_JOINED}{_CHAR}+)*"
USABLE_WORD = rf"^[\p{{L}}\p{{Nd}}]{{{MIN_GRAM},{MAX_GRAM}}}$"


def query_terms(query: Column) -> Column:
    """The lowercased words of a query that can match at all, in order."""
    words = F.regexp_extract_all(F.lower(query), F.lit(WORD), F.lit(0))
    return F.filter(words, lambda w: w.rlike(USABLE_WORD))


def runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(RUN), F.lit(0))


def only_runs(text: Column) -> Column:
    """The text with a space in place of what is between its runs."""
    return F.regexp_replace(text, F.lit(BETWEEN), F.lit(" "))


def lowered_alike(text: Column) -> Column:
    """Whether each part of the text has the lowercase letters that it has in the text: none becomes two, and none depends
    on where it stands, as sigma does."""
    return (F.length(F.lower(text)) == F.length(text)) & ~F.contains(text, F.lit("\u03a3"))


def gram_count(text: Column) -> Column:
    """How many grams the text is indexed under; 0 for missing text. A run of n
    characters has n (n - 1) / 2 up to the longest gram size, then a fixed
    number more per character."""
    sizes = F.transform(runs(text), lambda run: F.length(run).cast("long"))
    per_char = MAX_GRAM - MIN_GRAM + 1
    spare = per_char * MAX_GRAM - MAX_GRAM * (MAX_GRAM - 1) // 2

    def add(total: Column, n: Column) -> Column:
        return total + F.when(n < MAX_GRAM, F.shiftright(n * (n - 1), 1)).otherwise(n * per_char - spare)

    zero = F.lit(0).cast("long")
    return F.coalesce(F.aggregate(sizes, zero, add), zero)


def overlaps_itself(word: str) -> bool:
    return any(word.startswith(word[i:]) for i in range(1, len(word)))


def occurrences(text: Column, word: str) -> Column:
    """How often a word of letters and digits occurs in lowercased text, overlaps
    counted; such an occurrence always lies inside one run."""
    if overlaps_itself(word):
        count = F.regexp_count(text, F.lit(f"(?={re.escape(word)})")).cast("long")
    else:
        shorter = F.length(F.replace(text, F.lit(word), F.lit("")))
        count = ((F.length(text) - shorter) / len(word)).cast("long")
    return F.when(F.contains(text, F.lit(word)), count).otherwise(F.lit(0).cast("long"))
