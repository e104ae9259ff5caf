"""Sources: parquet tables, text and gzip line files, and the line-format
views (log, product, gold, rating, title lines) derived from the tables."""

from tessera.sources.tables import load_table, range_table, rows_table
from tessera.sources.textfiles import read_lines, write_lines, read_gzip_lines
from tessera.sources.views import (
    clf_lines, product_lines, gold_lines, rating_lines, title_lines,
    gold_pairs, ratings, titles,
)

__all__ = [
    "load_table", "range_table", "rows_table", "read_lines", "write_lines",
    "read_gzip_lines", "clf_lines", "product_lines", "gold_lines",
    "rating_lines", "title_lines", "gold_pairs", "ratings", "titles",
]
