"""Title keywords (T1) and stop-word removal (J6).

The default segmenter splits on runs of characters that are neither letters
nor digits, which is exact for space-separated scripts. Scripts written
without spaces need a dictionary segmenter: ``dictionary_segmenter`` gives a
native one (forward maximum matching); any Column -> Column function fits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.text import WORD_SEPARATOR, map_put, tokens
from tidelog.operators.joins import sized_broadcast

# The default stop-word list of the keyword job, in file order
# (words and punctuation; the ASCII comma is itself an entry).
STOP_WORDS = ("了", "是", "is", "are", "的", "地", "得", "使", "要", "啦", "，", ",", "。", ".", "！", "!", "、", "？", "就要")


Segmenter = Callable[[Column], Column]


def stop_word_array(stop_words: DataFrame) -> Column:
    """The first column of a stop list (say, read from a file) as one array: a
    scalar subquery, to be put in a column of its own before it is used."""
    return stop_words.agg(F.collect_set(stop_words.columns[0]).alias("w")).scalar()


def keywords(
    text: Column,
    stop_words: Iterable[str] | Column | None = STOP_WORDS,
    min_len: int = 2,
    pattern: str = WORD_SEPARATOR,
    segmenter: Segmenter | None = None,
) -> Column:
    """Space-joined words of ``text`` longer than one character, stop words
    removed (a list, or a column that holds an array). ``segmenter`` turns text into an array of words; by default words
    are split on ``pattern``."""
    if stop_words is not None and not isinstance(stop_words, Column):
        words = list(stop_words)
        stop_words = F.array(*[F.lit(w) for w in words]) if words else None
    stop = stop_words

    def keep(t):
        cond = F.length(t) >= min_len
        return cond & ~F.array_contains(stop, t) if stop is not None else cond

    words = segmenter(text) if segmenter else tokens(text, pattern)
    return F.array_join(F.filter(words, keep), " ")


def add_title_keywords(
    records: DataFrame,
    stop_words: Iterable[str] | Column | DataFrame | None = STOP_WORDS,
    event_col: str = "event",
    min_len: int = 2,
    segmenter: Segmenter | None = None,
) -> DataFrame:
    """Records whose event map has a ``title`` get ``event["keyword"]``."""
    if isinstance(stop_words, DataFrame):
        listed = records.withColumn("_stop_words", stop_word_array(stop_words))
        return add_title_keywords(listed, F.col("_stop_words"), event_col, min_len, segmenter).drop("_stop_words")
    ev = F.col(event_col)
    title = F.try_element_at(ev, F.lit("title"))
    has_title = F.map_contains_key(ev, F.lit("title"))
    found = keywords(F.coalesce(title, F.lit("")), stop_words, min_len, segmenter=segmenter)
    return records.withColumn(event_col, F.coalesce(F.when(has_title, map_put(ev, "keyword", found)), ev))


def remove_stopwords(words: DataFrame, stop_words: DataFrame, word_col: str = "word", stop_col: str = "word") -> DataFrame:
    """J6 as a join: rows of ``words`` whose word is not a stop word.

    ``left_anti`` against the distinct stop list, broadcast if the planner's
    estimate proves it small.
    """
    stops = stop_words.select(F.col(stop_col).alias("_stop")).distinct()
    stops = sized_broadcast(stops)
    return words.join(stops, words[word_col] == stops["_stop"], "left_anti")


def dictionary_segmenter(dictionary: Iterable[str]) -> Segmenter:
    """Forward-maximum-matching segmentation for scripts without spaces, as a
    native regular expression.

    The words, longest first, and then any single letter or digit, are the
    alternatives of one pattern, so each match is the longest word that begins
    there; everything else is skipped. The dictionary is one that fits a
    pattern (some ten thousand words).
    """
    words = sorted({w for w in dictionary if w}, key=lambda w: (-len(w), w))
    pattern = "|".join([*("\\Q" + w + "\\E" for w in words), r"[\p{L}\p{N}]"])
    return lambda text: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def segment_with_dictionary(text: Column, dictionary: Iterable[str]) -> Column:
    return dictionary_segmenter(dictionary)(text)
