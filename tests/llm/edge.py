"""Rows that every operator must take: nulls, empty and very long texts, ties,
repeated rows, and columns that clash with outputs."""

from __future__ import annotations

LONG = "word other Third fourth, fifth. " * 8000
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, tokens long, model string, fp long, weight double, kept boolean, "
          "component_id long, score double, row long, spans string")
TEXTS = [(None, None), (1, ""), (2, " \n\t "), (3, LONG), (4, "one two three four five"), (4, "one two three four five"), (5, "x" * 60_000),
         (6, "ünï \U0001F600 cödé wide"), (7, "1" * 20_000 + "@" + "a." * 500), (8, None), (9, "ONE two Three four FIVE"), (10, LONG)]


def edge_docs(spark):
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else "s", len(t or ""), 1, "m", 2, 0.5, False, 3, 1.0, 4, "z") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
