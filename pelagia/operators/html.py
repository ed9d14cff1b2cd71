"""Tables and label/value sheets out of HTML text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.functions.text import squeeze, strip_tags, unescape_html


def row_cells(html: Column) -> Column:
    """array of rows, each an array of its td cells' texts without tags; header cells are not data."""
    rows = F.regexp_extract_all(html, F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    return F.transform(rows, cells_of)


def cells_of(html: Column) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1)), strip_tags)


def sheet_cells(html: Column) -> Column:
    """All cells of a sheet in order, scripts left out."""
    return cells_of(F.regexp_replace(html, r"(?s)<script.*?</script>", ""))


def result_table(pages: DataFrame, html: str, names: list[str]) -> DataFrame:
    """Rows with at least as many cells as names; other columns of pages (such as the region asked for) are kept."""
    rows = pages.withColumn("__r", F.explode(row_cells(F.col(html)))).where(F.size("__r") >= len(names))
    return rows.select(*(c for c in pages.columns if c != html), *(F.get("__r", F.lit(i)).alias(n) for i, n in enumerate(names)))


def _place(cells: Column, label: str, contains: bool) -> Column:
    """The place from 1 of the first cell that equals the label, or contains it; 0 or null without one."""
    return F.array_position(F.transform(cells, lambda c: c.contains(label)), True) if contains else F.array_position(cells, label)


def cell_after(cells: Column, label: str, step: int = 1, contains: bool = False) -> Column:
    """The cell some places after the first one with the label; null without it."""
    at = _place(cells, label, contains)
    return F.when(at > 0, F.get(cells, (at - 1 + step).cast("int")))


def groups_after(cells: Column, label: str, size: int = 4, date_at: int = 2, contains: bool = False) -> Column:
    """Groups of cells after the label's header row, up to the first whose date cell is no date."""
    at = _place(cells, label, contains).cast("int")
    begins = F.when((at > 0) & (at + size <= F.size(cells)), F.sequence(at + size - 1, F.size(cells) - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))
    groups = F.transform(begins, lambda i: F.slice(cells, i + 1, F.lit(size)))
    dated = lambda g: F.coalesce(F.get(g, F.lit(date_at)).rlike(r"^\d{2}-\d{2}-\d{4}"), F.lit(False))
    bad = F.array_position(F.transform(groups, lambda g: ~dated(g)), True).cast("int")
    return F.when(bad > 0, F.slice(groups, F.lit(1), bad - 1)).otherwise(groups)


def label_pairs(html: Column) -> Column:
    """array of (label, value) of <strong>label</strong></td><td>value pairs in order; values on one line, single spaces."""
    pattern = r"(?si)<strong>(.*?)</strong>\s*</td>\s*<td[^>]*>(.*?)</td>"
    pairs = F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)).alias("label"), F.regexp_extract_all(html, F.lit(pattern), F.lit(2)).alias("value"))
    clean = lambda c: squeeze(unescape_html(F.regexp_replace(c, "<[^>]+>", "")))
    return F.transform(pairs, lambda p: F.struct(F.regexp_replace(clean(p["label"]), r"\s*:\s*$", "").alias("label"), clean(p["value"]).alias("value")))


def label_values(html: Column) -> Column:
    """map of label to value; the first of equal labels wins."""
    pairs = label_pairs(html)
    first = F.filter(pairs, lambda p, i: F.array_position(F.transform(pairs, lambda q: q["label"]), p["label"]) == i + 1)
    return F.map_from_entries(first)


def value_of_kind(pairs: Column, kind: Column | str, classify) -> Column:
    """The value of the first pair whose label classify() tells to be of the kind; null without one."""
    return F.get(F.filter(pairs, lambda p: F.coalesce(classify(p["label"]) == kind, F.lit(False))), F.lit(0))["value"]
