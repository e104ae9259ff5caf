"""Tokenizing (F1) and stopword removal (F2).

``simple_tokenize``: lower-case, split on runs of non-word characters, drop
empty strings, keep repeats.  Java's ``\\W`` is ASCII-only and keeps ``_``
as a word character, so ``café`` gives ``caf`` and ``456_B`` gives ``456_b``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import broadcast_if_small

SPLIT_PATTERN = r"\W+"

# Spark ML's default English stopword list
# (StopWordsRemover.loadDefaultStopWords("english")), in its own order.
STOPWORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by",
    "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over",
    "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll",
    "they'll", "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's",
    "she's", "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't",
    "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't",
    "didn't", "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't",
    "cannot", "could", "here's", "how's", "let's", "ought", "that's", "there's", "what's",
    "when's", "where's", "who's", "why's", "would",
)


def simple_tokenize(text: Column) -> Column:
    """``ARRAY<STRING>`` of lower-cased ``\\W+``-separated tokens, repeats kept."""
    return F.filter(F.split(F.lower(text), SPLIT_PATTERN), lambda t: t != "")


def remove_stopwords(tokens: Column, stopwords=STOPWORDS) -> Column:
    """Drop stopwords from a token array, keeping repeats of the rest.
    ``isin`` over a literal list becomes a hash-set lookup (InSet)."""
    words = list(stopwords)
    return F.filter(tokens, lambda t: ~t.isin(words))


def tokenize(text: Column, stopwords=STOPWORDS) -> Column:
    """Tokens without stopwords: the tokenizer used for TF, IDF and cosine."""
    return remove_stopwords(simple_tokenize(text), stopwords)


def remove_stopwords_table(token_rows: DataFrame, stopword_table: DataFrame,
                           token_col: str = "token", max_bytes: int | None = None
                           ) -> DataFrame:
    """Stopword removal for a word list too large for a literal: exploded
    token rows anti-joined with the list, which is broadcast only within a
    measured size."""
    words = stopword_table.select(F.col(stopword_table.columns[0]).alias(token_col))
    return token_rows.join(broadcast_if_small(words, max_bytes), token_col, "left_anti")
