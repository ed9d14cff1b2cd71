"""Personal data replaced by format-preserving pseudonyms, in DataFrame functions only.

Validated values (payment cards by their check digit, IBANs by mod 97, IPv4 and IPv6 addresses, North American phone
numbers in any spelling, other numbers with a country code, social security numbers, calendar dates) go through a keyed Feistel
network over exactly the values their format allows, so the pseudonym is valid again, different values never
meet, and equal values stay equal in all documents. Mail addresses and credentials, which are not numbers, get
keyed digests in the same shape. Numbers that fail validation stay.

A text is cut at its finds, each find is mapped, and the parts are joined; nothing is shuffled. Edge cases: a null
text stays null and has no finds; empty texts and texts without finds come back unchanged; very long texts are read
whole, every pattern starts at a token's start and never backtracks over more than its own length; repeated
rows give equal rows; other columns are kept, but the result's column pii takes the place of an input column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
_HEXTET = "(?i:[0-9a-f]{1,4})"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

#: Patterns by kind, tried in this order at each place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "ipv4": rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    "ipv6": rf"(?<![A-Za-z0-9:.])(?:(?:{_HEXTET}:){{7}}{_HEXTET}|(?i:[23][0-9a-f]{{3}}|f[cde][0-9a-f]{{2}})(?::{_HEXTET}){{0,5}}::(?:{_HEXTET}(?::{_HEXTET}){{0,5}})?)(?![A-Za-z0-9:]|\.[0-9])",
    "credential": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}+)(?![A-Za-z0-9])"
    r"|(?<=(?i:token|password|passwd|secret|api_key|apikey) {0,2}[=:] {0,2}\"?)[A-Za-z0-9+/_-]{12,}+(?![A-Za-z0-9+/_-])",
    "iban": r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?![A-Z0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[./-][0-9])",
    "phone": r"(?<![0-9+.-])(?:\+?1[ .-]?)?(?:\([2-9][0-9]{2}\)[ .-]?|[2-9][0-9]{2}[.-])[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![0-9+.-])\+1 ?[2-9][0-9]{2} ?[2-9][0-9]{2} ?[0-9]{4}(?![0-9])"
    r"|(?<![0-9+.-])(?<![0-9] )(?:1 )?[2-9][0-9]{2} [2-9][0-9]{2} [0-9]{4}(?![0-9]| [0-9])",
    "world": r"(?<![0-9+])\+[1-9][0-9]{0,2}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])",
    "card": r"(?<![0-9.-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9]|[.-][0-9])",
}
#: A find that can be a credential by its letters and length; only texts with one are asked which.
_MAY_BE_SECRET = "^[A-Za-z0-9+/_-]{12,}$"
#: A text without any of these characters in reach has no find; one pass decides.
GATE = r"[0-9]{2}|::|@|AKIA|ghp_|sk-|(?i:token|password|passwd|secret|api_?key)"


def any_pattern() -> str:
    """All patterns as one. Group 1 is the credential's, so a find tells by which alternative it came; the card's back reference is named."""
    card = PATTERNS["card"].replace("([ -])", "(?<sep>[ -])").replace(r"\1", r"\k<sep>")
    secret = f"({PATTERNS['credential']})"
    return "|".join(f"(?:{p})" for p in (PATTERNS | {"card": card, "credential": secret}).values())


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 256)


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def feistel(kind: str, left: Column, right: Column, left_size: Column, right_size: Column, key: str, rounds: int = ROUNDS, tweak: Column | None = None) -> Column:
    """A keyed permutation of the pairs (left < left_size, right < right_size), as struct(l, r); another one for each tweak."""
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"), left_size.cast("long").alias("a"), right_size.cast("long").alias("b"))

    def step(s: Column, i: Column) -> Column:
        moved = F.pmod(s["l"] + F.pmod(_number(_digest(key, F.lit(kind), i, s["r"], s["a"], s["b"], *(() if tweak is None else (tweak,)))), s["a"]), s["a"])
        return F.struct(s["r"].alias("l"), moved.alias("r"), s["b"].alias("a"), s["a"].alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _fill(shape: Column, digits: Column) -> Column:
    """shape with its digits replaced in order."""
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))

    def step(s: Column, c: Column) -> Column:
        is_digit = c.rlike("[0-9]")
        return F.struct((s["n"] + is_digit.cast("int")).alias("n"), F.concat(s["out"], F.when(is_digit, digits.substr(s["n"] + 1, F.lit(1))).otherwise(c)).alias("out"))

    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def _permuted_digits(kind: str, digits: Column, key: str) -> Column:
    """Digits of any length up to 34 permuted among those of the same length."""

    def halves(d: Column) -> Column:
        u = F.floor(F.length(d) / 2).cast("int")
        v = F.length(d) - u
        size = lambda n: F.rpad(F.lit("1"), n + 1, "0").cast("long")
        moved = feistel(kind, d.substr(F.lit(1), u), d.substr(u + 1, v), size(u), size(v), key)
        return _let(moved, lambda m: F.concat(F.lpad(m["l"].cast("string"), u, "0"), F.lpad(m["r"].cast("string"), v, "0")))

    return _let(digits, halves)


def _permuted_letters(kind: str, letters: Column, key: str) -> Column:
    """Capital letters, up to 24, permuted among strings of the same length; one letter alone among all letters."""
    value = lambda t: F.aggregate(F.split(t, ""), F.lit(0).cast("long"), lambda a, c: a * 26 + F.ascii(c) - 65)
    power = lambda n: F.aggregate(F.sequence(F.lit(1), n), F.lit(1).cast("long"), lambda a, _: a * 26)
    size = lambda n: F.when(n > 0, power(F.greatest(n, F.lit(1)))).otherwise(F.lit(1).cast("long"))

    def spelt(v: Column, n: Column) -> Column:
        start = F.struct(v.alias("v"), F.lit("").alias("t"))
        step = lambda s, _: F.struct(F.floor(s["v"] / 26).cast("long").alias("v"), F.concat(F.char(s["v"] % 26 + 65), s["t"]).alias("t"))
        return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), start, step, lambda s: s["t"])).otherwise("")

    def halves(t: Column) -> Column:
        u = F.floor(F.length(t) / 2).cast("int")
        v = F.length(t) - u
        first = F.when(u > 0, value(t.substr(F.lit(1), u))).otherwise(F.lit(0).cast("long"))
        moved = feistel(kind, first, value(t.substr(u + 1, v)), size(u), size(v), key)
        return _let(moved, lambda m: F.concat(spelt(m["l"], u), spelt(m["r"], v)))

    return F.when(F.length(letters) > 0, _let(letters, halves)).otherwise(letters)


def _spread(shape: Column, letters: Column) -> Column:
    """shape with its capital letters replaced in order."""
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))

    def step(s: Column, c: Column) -> Column:
        is_letter = c.rlike("[A-Z]")
        return F.struct((s["n"] + is_letter.cast("int")).alias("n"), F.concat(s["out"], F.when(is_letter, letters.substr(s["n"] + 1, F.lit(1))).otherwise(c)).alias("out"))

    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def luhn_sum(digits: Column, double_last: bool) -> Column:
    """The sum of the check digit scheme, counted from the right, doubling the last digit or the one before."""
    each = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: F.when((i % 2 == 0) == F.lit(double_last), F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _card(x: Column, key: str) -> Column:
    def change(d: Column) -> Column:
        body = _permuted_digits("card", d.substr(F.lit(1), F.length(d) - 1), key)
        whole = _let(body, lambda b: F.concat(b, F.pmod(-luhn_sum(b, True), F.lit(10)).cast("string")))
        return F.when(luhn_sum(d, False) % 10 == 0, _let(whole, lambda w: _fill(x, w))).otherwise(x)

    return _let(_digits(x), change)


def _mod97(text: Column) -> Column:
    """A string of digits and capital letters (A is 10) modulo 97."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + value(c)) % 97).otherwise((a * 100 + value(c)) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _iban(x: Column, key: str) -> Column:
    """Digits move among digits and letters among letters; country and grouping stay, the check digits follow."""

    def change(c: Column) -> Column:
        country, body = c.substr(1, 2), c.substr(F.lit(5), F.length(c) - 4)
        numbered = _let(_permuted_digits("iban", _digits(body), key), lambda d: _fill(body, d))
        moved = _let(_permuted_letters("iban letters", F.regexp_replace(body, "[^A-Z]", ""), key), lambda t: _let(numbered, lambda b: _spread(b, t)))
        check = lambda b: F.lpad((F.lit(98) - _mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0")
        whole = _let(moved, lambda b: F.concat(country, check(b), b))
        # the characters of the whole, in the found one's grouping
        grouped = lambda w: F.array_join(F.transform(F.split(x, ""), lambda ch, i: F.when(ch == " ", ch).otherwise(w.substr(i + 1 - F.length(F.regexp_replace(x.substr(F.lit(1), i), "[^ ]", "")), F.lit(1)))), "")
        valid = (_mod97(F.concat(body, country, c.substr(3, 2))) == 1) & (F.length(_digits(body)) >= 2)
        return F.when(valid, _let(whole, grouped)).otherwise(x)

    return _let(F.replace(x, F.lit(" "), F.lit("")), change)


def _ipv6(x: Column, key: str) -> Column:
    """All eight groups move; every spelling of an address is led to one, written out in full, so spellings stay linked."""
    sides = F.split(F.lower(x), "::")
    groups = lambda t: F.filter(F.split(F.coalesce(t, F.lit("")), ":"), lambda g: g != "")
    zeros = lambda n: F.slice(F.array_repeat(F.lit("0"), 8), F.lit(1), F.greatest(n, F.lit(0)))
    whole = _let(F.struct(groups(F.get(sides, F.lit(0))).alias("a"), groups(F.get(sides, F.lit(1))).alias("b")), lambda s: F.concat(s["a"], zeros(8 - F.size(s["a"]) - F.size(s["b"])), s["b"]))
    pair = lambda g, k: F.conv(F.get(g, F.lit(k)), 16, 10).cast("long") * 65536 + F.conv(F.get(g, F.lit(k + 1)), 16, 10).cast("long")
    size = F.lit(1 << 32)
    shown = lambda v: F.concat_ws(":", F.lower(F.hex(F.floor(v / 65536).cast("long"))), F.lower(F.hex(v % 65536)))

    def change(g: Column) -> Column:
        # each half is permuted, told by the other: the network half first, then the host half, then the network half again
        host = lambda n: feistel("ipv6 host", pair(g, 4), pair(g, 6), size, size, key, tweak=F.concat_ws(":", n["l"].cast("string"), n["r"].cast("string")))
        again = lambda n, h: feistel("ipv6 net", n["l"], n["r"], size, size, key, tweak=F.concat_ws(":", h["l"].cast("string"), h["r"].cast("string")))
        first = feistel("ipv6", pair(g, 0), pair(g, 2), size, size, key)
        return _let(first, lambda n: _let(host(n), lambda h: _let(again(n, h), lambda m: F.concat_ws(":", shown(m["l"]), shown(m["r"]), shown(h["l"]), shown(h["r"])))))

    return _let(whole, lambda g: F.when(F.size(g) == 8, change(g)).otherwise(x))


def _ipv4(x: Column, key: str) -> Column:
    o = lambda p: [F.get(p, F.lit(k)).cast("long") for k in range(4)]
    moved = _let(F.split(x, r"\."), lambda p: feistel("ipv4", o(p)[0] * 256 + o(p)[1], o(p)[2] * 256 + o(p)[3], F.lit(65536), F.lit(65536), key))
    part = lambda v: F.concat_ws(".", F.floor(v / 256).cast("string"), (v % 256).cast("string"))
    return _let(moved, lambda m: F.concat_ws(".", part(m["l"]), part(m["r"])))


def _phone(x: Column, key: str) -> Column:
    def change(d: Column) -> Column:
        n = lambda at, size: d.substr(F.length(d) - F.lit(10 - at), F.lit(size)).cast("long")
        left, right = (n(1, 3) - 200) * 100 + n(7, 2), (n(4, 3) - 200) * 100 + n(9, 2)
        moved = feistel("phone", left, right, F.lit(80_000), F.lit(80_000), key)
        two = lambda v: F.lpad((v % 100).cast("string"), 2, "0")
        three = lambda v: (F.floor(v / 100) + 200).cast("string")
        new = _let(moved, lambda m: F.concat(F.when(F.length(d) == 11, "1").otherwise(""), three(m["l"]), three(m["r"]), two(m["l"]), two(m["r"])))
        return _let(new, lambda w: _fill(x, w))

    return _let(_digits(x), change)


def _world(x: Column, key: str) -> Column:
    """Digits after the country code, which is taken to be the first group, or the first two digits of one long group."""
    head = F.regexp_extract(x, r"^(\+[0-9]{1,3}(?=[ .-])|\+[0-9]{2})", 1)

    def change(h: Column) -> Column:
        tail = x.substr(F.length(h) + 1, F.length(x))
        fits = F.length(_digits(x)).between(8, 15) & (F.length(_digits(tail)) >= 2)
        return F.when(fits, F.concat(h, _let(_permuted_digits("world", _digits(tail), key), lambda d: _fill(tail, d)))).otherwise(x)

    return _let(head, change)


def _ssn(x: Column, key: str) -> Column:
    area, group, serial = (F.get(F.split(x, "-"), F.lit(k)).cast("long") for k in range(3))
    left = F.when(area > 666, area - 2).otherwise(area - 1)  # 898 areas: 1 to 899 without 666
    moved = feistel("ssn", left, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key)
    new_area = lambda m: F.when(m["l"] >= 665, m["l"] + 2).otherwise(m["l"] + 1)
    pad = lambda v, n: F.lpad(v.cast("string"), n, "0")
    return _let(moved, lambda m: F.concat_ws("-", pad(new_area(m), 3), pad(F.floor(m["r"] / 9999) + 1, 2), pad(m["r"] % 9999 + 1, 4)))


#: The Gregorian calendar repeats after 400 years: 146,097 = 27 * 5,411 days. Cycles begin with year 200 + 400 n.
_CYCLE = (27, 5411)


def _date(x: Column, key: str) -> Column:
    iso, slash = x.contains("-"), x.contains("/")
    day_first = F.when(slash, "dd/MM/yyyy").otherwise("dd.MM.yyyy")
    parse = lambda form: F.try_to_timestamp(x, form).cast("date")
    first = parse(F.when(iso, "yyyy-MM-dd").otherwise(day_first))

    def change(at: Column) -> Column:
        date = F.coalesce(at["first"], F.when(~iso, at["second"]))
        cycle = F.floor((F.year(date) - 200) / 400).cast("int")
        begin = F.make_date(cycle * 400 + 200, F.lit(1), F.lit(1))
        day = F.datediff(date, begin)
        moved = feistel("date", F.floor(day / _CYCLE[1]), day % _CYCLE[1], F.lit(_CYCLE[0]), F.lit(_CYCLE[1]), key)
        new = _let(moved, lambda m: F.date_add(begin, (m["l"] * _CYCLE[1] + m["r"]).cast("int")))
        shown = F.when(iso, F.date_format(new, "yyyy-MM-dd")).when(at["first"].isNotNull() & slash, F.date_format(new, "dd/MM/yyyy"))
        shown = shown.when(at["first"].isNotNull(), F.date_format(new, "dd.MM.yyyy")).when(slash, F.date_format(new, "MM/dd/yyyy")).otherwise(F.date_format(new, "MM.dd.yyyy"))
        valid = date.isNotNull() & F.year(date).between(200, 9799)
        return F.when(valid, shown).otherwise(x)

    second = parse(F.when(slash, "MM/dd/yyyy").otherwise("MM.dd.yyyy"))
    return _let(F.struct(first.alias("first"), second.alias("second")), change)


def _email(x: Column, key: str) -> Column:
    low = F.lower(x)
    local = F.substring(_digest(key, F.lit("email"), low), 1, 12)
    domain = F.substring(_digest(key, F.lit("domain"), F.substring_index(low, "@", -1)), 1, 8)
    return F.concat(F.lit("u"), local, F.lit("@d"), domain, F.lit(".example"))


def _credential(x: Column, key: str) -> Column:
    """The known prefix, then digits and letters of a digest up to the same length."""
    head = F.regexp_extract(x, "^(AKIA|ghp_|sk-)?", 1)
    blocks = F.sequence(F.lit(0), F.floor(F.length(x) / 64).cast("int"))
    stream = F.array_join(F.transform(blocks, lambda k: _digest(key, F.concat(F.lit("credential"), k.cast("string")), x)), "")
    body = stream.substr(F.lit(1), F.length(x) - F.length(head))
    return F.concat(head, F.when(F.upper(x) == x, F.upper(body)).otherwise(body))


_CHANGE = {"email": _email, "ipv4": _ipv4, "ipv6": _ipv6, "credential": _credential, "iban": _iban, "ssn": _ssn, "date": _date, "phone": _phone, "world": _world, "card": _card}


def kind_of(find: Column, secret: Column) -> Column:
    """The kind of a find: a credential where that alternative matched, whatever its shape, else by its own shape (what stood around it was already checked)."""
    out = F.when(secret, "credential").when(find.contains("@"), "email")
    for kind in ("ipv4", "ipv6", "ssn", "date", "phone", "world", "card", "iban"):
        out = out.when(find.rlike(f"^(?:{PATTERNS[kind]})$"), kind)
    return out.otherwise("credential")


def pseudonym(find: Column, secret: Column, key: str) -> Column:
    """struct(kind, text): what takes the place of a find."""

    def change(kind: Column) -> Column:
        out = F.when(kind == "email", _email(find, key))
        for name, body in list(_CHANGE.items())[1:]:
            out = out.when(kind == name, body(find, key))
        return F.struct(kind.alias("kind"), out.alias("text"))

    return _let(kind_of(find, secret), change)


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with its text rewritten, and a column pii: array of struct(kind, found, text) in order of place.

    The key is a secret of the caller: without it no pseudonym can be led back.
    """
    pattern = any_pattern()
    seen = F.col(text).rlike(GATE)
    finds = F.when(seen, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    out = docs.drop("pii").withColumn("__finds", F.coalesce(finds, F.array().cast("array<string>")))
    marked = F.when(F.size("__finds") > 0, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))).otherwise(F.array().cast("array<string>"))
    out = out.withColumn("__secrets", F.when(F.exists("__finds", lambda x: x.rlike(_MAY_BE_SECRET)), marked).otherwise(F.array().cast("array<string>")))
    secret = lambda i: F.coalesce(F.get("__secrets", i), F.lit("")) != ""
    new = F.transform("__finds", lambda x, i: _let(pseudonym(x, secret(i), key), lambda p: F.struct(p["kind"].alias("kind"), x.alias("found"), p["text"].alias("text"))))
    out = out.withColumn("pii", F.when(F.size("__finds") > 0, new).otherwise(F.array().cast("array<struct<kind:string,found:string,text:string>>")))
    gaps = F.split(F.col(text), pattern, -1)
    joined = _let(gaps, lambda g: F.concat(F.get(g, F.lit(0)), F.array_join(F.zip_with(F.col("pii"), F.slice(g, F.lit(2), F.size(g)), lambda p, t: F.concat(p["text"], t)), "")))
    return out.withColumn(text, F.when(F.size("pii") > 0, joined).otherwise(F.col(text))).drop("__finds", "__secrets")
