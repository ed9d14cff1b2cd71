"""Awkward documents every operator must take, and small helpers."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

AWKWARD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, None, 4),
    (4, "one", "en", "a", 3),
    (5, "x" * 200_000, "en", "b", 200_000),
    (6, "word " * 3000, "en", None, 15_000),
    (7, "same text of seven words here now", "en", "a", 33),
    (7, "same text of seven words here now", "en", "a", 33),
    (8, "same text of seven words here now", "en", "b", 33),
    (9, "日本語 ▁ café 😀 é \x00 end", "xx", "b", 20),
]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
