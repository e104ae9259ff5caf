"""Column functions: every one is a built-in Spark expression and runs JVM-side
(those with lambdas outside generated code).  No Python UDF is used."""

from tessera.functions.text import tokenize, remove_stopwords, simple_tokenize, STOPWORDS
from tessera.functions.clf import parse_clf, LOG_PATTERN
from tessera.functions.lines import (
    parse_product_lines, parse_gold_lines, parse_rating_lines, parse_title_lines,
    parsed_only,
)

__all__ = [
    "tokenize", "remove_stopwords", "simple_tokenize", "STOPWORDS", "parse_clf",
    "LOG_PATTERN", "parse_product_lines", "parse_gold_lines", "parse_rating_lines",
    "parse_title_lines", "parsed_only",
]
