r"""Token expressions. All run row-locally in the JVM.

``\W+`` is kept as the split pattern: the regex engine runs it several times faster than the equal
explicit class ``[^a-zA-Z0-9_]+``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_WORD = r"\W+"


def tokens(text: Column | str) -> Column:
    """Lower-cased words; accented letters separate words, empty parts are dropped."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(text), NON_WORD), "")


def blank_tokens(text: Column | str) -> Column:
    """Words of a corpus that is already clean and blank-separated."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(text, " "), "")


def rejoin(words: Column | str) -> Column:
    """Words as one blank-separated string, the form an outside lemmatiser takes."""
    return F.array_join(words, " ")


def has_letters(word: Column) -> Column:
    return word.rlike(r"\p{L}")


def letters_only(word: Column) -> Column:
    return word.rlike(r"^\p{L}+$")


def not_stopped(word: Column, stop_words: Iterable[str]) -> Column:
    """Membership test against a list; Spark turns it into one hash-set look-up per word."""
    stop = sorted(set(stop_words))
    return ~word.isin(stop) if stop else F.lit(True)


def usable(word: Column, stop_words: Iterable[str] = (), min_length: int = 3) -> Column:
    """Whether a word may enter a vocabulary: long enough, not stopped, letters only. The pattern comes last: it
    costs more than the other two tests together, and they spare it most words."""
    return (F.length(word) >= min_length) & not_stopped(word, stop_words) & letters_only(word)


def keep_words(words: Column | str, stop_words: Iterable[str] = (), min_length: int = 3) -> Column:
    """The words of an array that may enter a vocabulary."""
    stop = sorted(set(stop_words))
    return F.filter(words, lambda word: usable(word, stop, min_length))


def distinct_words(words: Column | str) -> Column:
    return F.array_distinct(words)
