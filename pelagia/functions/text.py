"""Names, codes and labels as column expressions."""

from __future__ import annotations

import unicodedata
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

def _bare(form: str, c: str) -> str:
    return "".join(x for x in unicodedata.normalize(form, c) if not unicodedata.combining(x))


def _plain_forms() -> dict[str, str]:
    """Characters beyond ASCII by what they are without marks, where their compatibility form is all ASCII (accented letters, ligatures, numerals, full width) or
    they are one letter of another script with marks."""
    every = [chr(c) for c in range(0xA0, 0x10000) if not 0xD800 <= c < 0xE000]
    spelt = {c: _bare("NFKD", c) for c in every}
    spelt = {c: form for c, form in spelt.items() if form.replace("\u2044", "").isascii()}  # fractions have a slash of their own
    return {c: form for c, form in ({c: _bare("NFD", c) for c in every} | spelt).items() if form and form != c and (len(form) == 1 or c in spelt)}


_PLAIN = _plain_forms()
_ONE = {c: form for c, form in _PLAIN.items() if len(form) == 1}
_MANY = {c: form for c, form in _PLAIN.items() if len(form) > 1}
_FROM, _TO = "".join(_ONE), "".join(_ONE.values())
_MANY_CLASS = "[" + "".join(_MANY) + "]"
#: Ordinals at the end of a vessel's name.
ROMAN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X")


def blank_to_null(s: Column) -> Column:
    t = F.trim(s)
    return F.when(t != "", t)


def strip_accents(s: Column) -> Column:
    """Letters lose their accents and combining marks go; ligatures, numerals and the like become the ASCII characters they stand for."""
    forms = F.str_to_map(F.lit("\x01".join(f"{c}\x02{form}" for c, form in _MANY.items())), F.lit("\x01"), F.lit("\x02"))
    spelt = F.array_join(F.transform(F.split(s, ""), lambda c: F.coalesce(F.try_element_at(forms, c), c)), "")
    every = F.regexp_replace(F.translate(F.when(s.rlike(_MANY_CLASS), spelt).otherwise(s), _FROM, _TO), r"\p{M}", "")
    # Java tries the hundreds of characters of that class one by one: texts that are ASCII, or are so without their accents, skip it
    beyond, plain = "[^\\x00-\\x7f]", F.translate(s, _FROM, _TO)
    return F.when(~s.rlike(beyond), s).when(~plain.rlike(beyond), plain).otherwise(every)


def squeeze(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def folded(s: Column) -> Column:
    """For comparing labels: no accents, single spaces, lower case."""
    return F.lower(squeeze(strip_accents(s)))


def skeleton(s: Column) -> Column:
    """For comparing labels whose accents were broken: every non-ASCII run is a question mark."""
    return F.regexp_replace(F.lower(F.trim(s)), r"[^\x00-\x7f]+", "?")


def name_key(s: Column) -> Column:
    """Capital letters and digits, without what stands in parentheses; accented letters go."""
    return F.regexp_replace(F.regexp_replace(F.upper(F.coalesce(s, F.lit(""))), r"\(.*?\)", ""), "[^A-Z0-9]", "")


def digits(s: Column) -> Column:
    return F.regexp_replace(F.coalesce(s, F.lit("")), "[^0-9]", "")


def vessel_name(s: Column) -> Column:
    """Upper case without accents, hyphens as spaces, single spaces; null stays null."""
    return squeeze(F.regexp_replace(F.translate(F.upper(strip_accents(s)), "-", " "), "�", ""))


def ordinal_suffix(s: Column) -> Column:
    """The number at the end of a vessel's name, roman up to ten or in digits; null without one."""
    last = F.element_at(F.split(F.upper(F.trim(s)), " "), -1)
    roman = F.create_map(*(F.lit(x) for i, r in enumerate(ROMAN, 1) for x in (r, i)))
    return F.coalesce(F.try_element_at(roman, last), F.when(last.rlike("^[0-9]+$"), last.try_cast("int")))


def suffixes_agree(a: Column, b: Column) -> Column:
    """Two names may be one vessel's unless both end in ordinals that differ."""
    x, y = ordinal_suffix(a), ordinal_suffix(b)
    return F.coalesce(x == y, F.lit(True))


def split_code(s: Column) -> tuple[Column, Column]:
    """"code - name" as (code, name), each null when missing. Fixed value: the pattern, which the data's own form sets."""
    pattern = r"^\s*(\d+)\s*-\s*(.*?)\s*$"
    empty = F.lit("")
    return F.nullif(F.regexp_extract(s, pattern, 1), empty), F.nullif(F.regexp_extract(s, pattern, 2), empty)


def number_with_unit(s: Column, *units: str) -> Column:
    for unit in units:
        s = F.replace(s, F.lit(unit), F.lit(""))
    return F.trim(s).try_cast("double")


def port_title(s: Column) -> Column:
    """Title case that also capitalises after hyphens and apostrophes."""
    words = F.regexp_extract_all(F.lower(F.trim(s)), F.lit(r"[\p{L}\p{M}]+|[^\p{L}\p{M}]+"), F.lit(0))
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(w.substr(1, 1)), w.substr(F.lit(2), F.length(w)))), "")


def first_code(s: Column, table: list[tuple[str, int]], default: int = 0) -> Column:
    """The code of the first entry contained in s."""
    out = None
    for needle, code in table:
        test = s.contains(needle)
        out = F.when(test, code) if out is None else out.when(test, code)
    return (out.otherwise(default) if out is not None else F.lit(default)).cast("int")


def split_person(s: Column) -> Column:
    """struct(first_surname, second_surname, given) of a name written surnames first; parts that are missing are empty."""
    w = F.filter(F.split(squeeze(s), " "), lambda x: x != "")
    part = lambda k: F.coalesce(F.get(w, F.lit(k)), F.lit(""))
    given = F.array_join(F.slice(w, F.lit(3), F.greatest(F.size(w), F.lit(1))), " ")
    return F.struct(part(0).alias("first_surname"), part(1).alias("second_surname"), given.alias("given"))


def search_variants(s: Column, least: int = 3, stem: int = 5) -> Column:
    """Spellings to look a surname up by, most specific first: as it is, folded, up to its first letter beyond ASCII, its first letters."""
    whole, plain = s, folded(s)
    before = folded(F.regexp_extract(s, r"^[\x00-\x7f]*", 0))
    options = F.transform(F.array(whole, plain, before, plain.substr(1, stem)), lambda v: F.trim(v))
    return F.array_distinct(F.filter(options, lambda v: F.length(v) >= least))


def strip_tags(s: Column) -> Column:
    return F.trim(F.replace(F.regexp_replace(s, "<[^>]+>", ""), F.lit("&nbsp;"), F.lit(" ")))


def unescape_html(s: Column) -> Column:
    """Entities as letters, by name (those of HTML 4), number or hexadecimal number; unknown ones stay."""
    known = F.create_map(*(F.lit(x) for name, code in name2codepoint.items() for x in (name, code)))

    def letter(e: Column) -> Column:
        number = F.when(e.rlike("^#[xX][0-9a-fA-F]{1,6}$"), F.conv(e.substr(F.lit(3), F.length(e)), 16, 10).cast("int"))
        number = number.when(e.rlike("^#[0-9]{1,7}$"), e.substr(F.lit(2), F.length(e)).cast("int")).otherwise(F.try_element_at(known, e))
        fits = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        return F.when(fits, F.decode(F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0")), "UTF-32"))

    found = F.array_distinct(F.regexp_extract_all(s, F.lit("&(#?[0-9A-Za-z]+);"), F.lit(1)))
    ampersand = F.array(F.lit("amp"), F.lit("#38"))  # last, or it would make new entities
    order = F.concat(F.array_except(found, ampersand), F.array_intersect(ampersand, found))
    swap = lambda t, e: F.coalesce(F.replace(t, F.concat(F.lit("&"), e, F.lit(";")), letter(e)), t)
    return F.aggregate(order, s, swap)


def label_kind(s: Column, prefixes: dict[str, str], exact: dict[str, str]) -> Column:
    """The field a label stands for: exact labels first, then beginnings; null for others."""
    low, out = folded(s), None
    for test, name in [*((low == k, v) for k, v in exact.items()), *((low.startswith(k), v) for k, v in prefixes.items())]:
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def hex_to_code(s: Column) -> Column:
    """A vessel's number from its hexadecimal code, which is five more; null for anything but hexadecimal digits."""
    return F.when(s.rlike(r"^\s*[0-9A-Fa-f]+\s*$"), F.conv(F.trim(s), 16, 10).try_cast("long") - 5)


def code_to_hex(code: Column) -> Column:
    return F.hex(code.cast("long") + 5)


def decode_gears(s: Column) -> Column:
    """"SPECIES:id,id|SPECIES:id" as a map of arrays; parts without a colon are skipped."""
    parts = F.filter(F.split(F.coalesce(s, F.lit("")), r"\|"), lambda p: p.contains(":"))
    pair = lambda p: F.struct(
        F.trim(F.substring_index(p, ":", 1)).alias("k"), F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_replace(p, "^[^:]*:", ""), r"\s*,\s*"), lambda x: x != ""))).alias("v")
    )
    return F.map_from_entries(F.transform(parts, pair))


def encode_gears(m: Column) -> Column:
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"], ","))), "|")


def gear_union(m: Column) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.map_values(m))))


def only_gear(m: Column, gear: str) -> Column:
    return F.coalesce(gear_union(m) == F.array(F.lit(gear)), F.lit(False))
