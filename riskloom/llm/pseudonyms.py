"""Format-preserving Feistel pseudonyms for personal data, in SQL expressions only.

Values are found by one pattern, validated by kind (check digits, calendar, ranges), and mapped by a keyed Feistel
permutation of all values of their format: a card number becomes another number with a right check digit, a
date another date, and separators stay where they were. The permutation depends on the value alone, not on how it is
written, so equal values stay linked across documents. Values that fail validation are left as they are.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.shared import fresh, read

KEY = "change this key before use"
ROUNDS = 8

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
ISO_DATE = r"(?<![0-9.-])[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}(?![0-9])"
DAY_DATE = r"(?<![0-9.-])[0-9]{1,2}([-/.])[0-9]{1,2}\1[0-9]{4}(?![0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
ADDRESS = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9+])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
WORLD_PHONE = r"(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,5}(?![0-9])"
CARD = r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|3[0-9]{3}([ -])[0-9]{6}\2[0-9]{5})(?![0-9])"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
SECRET_NAME = r"(?i:password|passwd|token|secret|api_key)[ ]?[=:][ ]?[\"']?"
# A secret is taken whole, however long it is, with the dots inside it.
SECRET = SECRET_NAME + r"(?:[A-Za-z0-9+/_-]|[.](?=[A-Za-z0-9+/_-])){8,}+"
NUMBERS = (CARD, ISO_DATE, DAY_DATE, SOCIAL, PHONE, WORLD_PHONE, ADDRESS)


def _renumbered(patterns: tuple[str, ...]) -> str:
    """One pattern of several; their back references are counted on."""
    groups, out = 0, []
    for p in patterns:
        own = len(re.findall(r"\((?!\?)", p.replace(r"\(", "")))
        out.append(re.sub(r"\\([1-9])", lambda m: rf"\{int(m[1]) + groups}", p))  # noqa: B023
        groups += own
    return "|".join(f"(?:{p})" for p in out)


# A look at the next character spares most places the long alternatives.
ANY = rf"(?=[0-9+(])(?:{_renumbered(NUMBERS)})|(?=[A-Z])(?:{IBAN}|{ACCESS_KEY})|(?=[PpTtSsAa]){SECRET}|(?=[A-Za-z0-9._%+-]){EMAIL}"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _draw(key: str, kind: str, turn: Column, value: Column, below: Column | int) -> Column:
    """A keyed pseudo-random number in [0, below)."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), below)


def permuted(key: str, kind: str, left: Column, right: Column, a: Column | int, b: Column | int) -> Column:
    """The pair (left < a, right < b) under a keyed permutation of all such pairs: struct(l, r)."""
    turns = F.array(*[F.lit(i) for i in range(ROUNDS)])

    def turn(state: Column, i: Column) -> Column:
        l, r = state["l"], state["r"]  # noqa: E741
        return F.when(i % 2 == 0, F.struct(F.pmod(l + _draw(key, kind, i, r, a), a).cast("long").alias("l"), r.alias("r"))).otherwise(
            F.struct(l.alias("l"), F.pmod(r + _draw(key, kind, i, l, b), b).cast("long").alias("r"))
        )

    return F.aggregate(turns, F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), turn)


_HEX = "0123456789abcdef"


def _moved(c: Column, by: Column, hexadecimal: Column) -> Column:
    """A character moved on within its class: hexadecimal digits, digits, small or capital letters; others stay."""
    code = F.ascii(c)

    def within(first: int, size: int) -> Column:
        return F.char((F.lit(first) + F.pmod(code - first + by, size)).cast("int"))

    return (
        F.when(hexadecimal & c.rlike("[0-9a-f]"), F.substr(F.lit(_HEX), (F.pmod(F.instr(F.lit(_HEX), c) - 1 + by, 16) + 1).cast("int"), F.lit(1)))
        .when(c.rlike("[0-9]"), within(48, 10))
        .when(c.rlike("[a-z]"), within(97, 26))
        .when(c.rlike("[A-Z]"), within(65, 26))
        .otherwise(c)
    )


def permuted_text(key: str, kind: str, value: Column) -> Column:
    """A text under a keyed permutation of all texts with the same length and the same class at every place.

    The halves are moved by turns, each by numbers drawn from the other.
    """
    kept = F.struct(value.alias("v"), value.rlike("^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{16,}$").alias("h"), F.floor(F.length(value) / 2).cast("int").alias("n"))
    return _let(kept, lambda k: F.when(F.length(k["v"]) < 2, k["v"]).otherwise(_permuted_text(key, kind, k["v"], k["h"], k["n"])))


def _permuted_text(key: str, kind: str, value: Column, hexadecimal: Column, half: Column) -> Column:
    def turn(state: Column, i: Column) -> Column:
        head, tail = F.substr(state, F.lit(1), half), F.substr(state, half + 1)

        def move(side: Column, other: Column) -> Column:
            def drawn(by: Column) -> Column:
                return F.transform(F.split(side, ""), lambda c, j: _moved(c, _draw(key, kind, F.concat_ws(":", i.cast("string"), j.cast("string")), by, 1 << 40), hexadecimal))

            # Each place hashes the other half, a long one by its digest: the work grows with the length, not its square.
            return F.array_join(_let(F.when(F.length(other) > 64, F.sha2(other, 256)).otherwise(other), drawn), "")

        return F.when(i % 2 == 0, F.concat(move(head, tail), tail)).otherwise(F.concat(head, move(tail, head)))

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), value, turn)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _filled(layout: Column, digits: Column, skip: Column | int = 0) -> Column:
    """``layout`` with its digits, but the first ``skip``, replaced by ``digits`` one after the other."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("int").alias("i"))

    def fill(new_digits: Column) -> Column:
        def place(state: Column, c: Column) -> Column:
            digit = c.rlike("[0-9]")
            at = state["i"] - skip + 1
            new = F.when(digit & (at > 0), F.substr(new_digits, at.cast("int"), F.lit(1))).otherwise(c)
            return F.struct(F.concat(state["out"], new).alias("out"), (state["i"] + digit.cast("int")).cast("int").alias("i"))

        return F.aggregate(F.split(layout, ""), start, place, lambda s: s["out"])

    return _let(digits, fill)


def _number(text: Column) -> Column:
    return text.cast("long")


def _padded(number: Column, width: Column | int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _luhn(payload: Column) -> Column:
    """The check digit that follows ``payload``."""
    places = F.transform(F.split(F.reverse(payload), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.pmod(10 - F.pmod(F.aggregate(places, F.lit(0), lambda s, x: s + x), 10), 10)


def _card(key: str, m: Column) -> Column:
    return _let(_digits(m), lambda d: _card_of(key, m, d))


def _card_of(key: str, m: Column, d: Column) -> Column:
    payload = F.substr(d, F.lit(1), F.length(d) - 1)
    head = F.ceil(F.length(payload) / 2).cast("int")
    tail = F.length(payload) - head
    a, b = F.pow(F.lit(10.0), head).cast("long"), F.pow(F.lit(10.0), tail).cast("long")
    p = permuted(key, "card", _number(F.substr(payload, F.lit(1), head)), _number(F.substr(payload, head + 1)), a, b)
    new = _let(p, lambda q: F.concat(_padded(q["l"], head), _padded(q["r"], tail)))
    valid = (F.substr(d, F.length(d)).cast("int") == _luhn(payload)) & ~d.rlike("^0+$")
    return F.when(valid, _filled(m, _let(new, lambda x: F.concat(x, _luhn(x).cast("string"))))).otherwise(m)


def _mod97(rearranged: Column) -> Column:
    """The remainder by 97 of a text whose letters count as 10 to 35."""

    def step(s: Column, c: Column) -> Column:
        letter = c.rlike("[A-Z]")
        value = F.when(letter, F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
        return F.pmod(s * F.when(letter, 100).otherwise(10) + value, 97).cast("int")

    return F.aggregate(F.split(rearranged, ""), F.lit(0), step)


def _iban(key: str, m: Column) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country, body = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))
    valid = (_mod97(F.concat(body, F.substr(plain, F.lit(1), F.lit(4)))) == 1) & F.length(plain).between(15, 34)
    made = _let(permuted_text(key, "iban", body), lambda new: F.concat(country, _padded(98 - _mod97(F.concat(new, country, F.lit("00"))), 2), new))
    return F.when(valid, _let(made, lambda x: F.when(F.contains(m, F.lit(" ")), F.regexp_replace(x, "(.{4})(?=.)", "$1 ")).otherwise(x))).otherwise(m)


def _date(key: str, m: Column, first: Column, second: Column, third: Column, order: str) -> Column:
    """``order``: which of the three parts is year, month and day, as in "ymd"."""
    part = dict(zip(order, (first, second, third), strict=True))
    y, mo, d = (part[k].cast("int") for k in "ymd")
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = F.when(mo == 2, F.when(leap, 29).otherwise(28)).when(mo.isin(4, 6, 9, 11), 30).otherwise(31)
    valid = y.between(1900, 2099) & mo.between(1, 12) & d.between(1, last)
    day = F.datediff(F.make_date(y, mo, d), F.lit("1900-01-01").cast("date"))
    # 1900 to 2099 has 73,049 days, which is 17 times 4,297.
    p = permuted(key, "date", F.floor(day / 4297), F.pmod(day, 4297), 17, 4297)
    new = _let(p, lambda q: F.date_add(F.lit("1900-01-01").cast("date"), (q["l"] * 4297 + q["r"]).cast("int")))

    def written(x: Column) -> Column:
        made = {"y": F.year(x), "m": F.month(x), "d": F.day(x)}
        width = {k: F.greatest(F.length(part[k]), F.length(made[k].cast("string"))) for k in order}
        a, b, c = (_padded(made[k], width[k]) for k in order)
        separator = F.regexp_extract(m, "([-/.])", 1)
        return F.concat(a, separator, b, separator, c)

    return F.when(valid, _let(new, written)).otherwise(m)


def _dates(key: str, m: Column) -> Column:
    p = [F.element_at(F.split(m, "[-/.]"), i) for i in (1, 2, 3)]
    # Slashes write the month first where they can, other separators where the second part is no month.
    month_first = (p[0].cast("int") <= 12) & (F.contains(m, F.lit("/")) | (p[1].cast("int") > 12))
    return F.when(F.length(p[0]) == 4, _date(key, m, *p, "ymd")).when(month_first, _date(key, m, *p, "mdy")).otherwise(_date(key, m, *p, "dmy"))


def _social(key: str, m: Column) -> Column:
    area, group, serial = (F.element_at(F.split(m, "-"), i).cast("int") for i in (1, 2, 3))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    rank = area - 1 - (area > 666).cast("int")
    p = permuted(key, "social", rank * 99 + group - 1, serial - 1, 898 * 99, 9999)

    def written(q: Column) -> Column:
        place = F.floor(q["l"] / 99) + 1
        return F.concat_ws("-", _padded(place + (place >= 666).cast("int"), 3), _padded(F.pmod(q["l"], 99) + 1, 2), _padded(q["r"] + 1, 4))

    return F.when(valid, _let(p, written)).otherwise(m)


def _phone(key: str, m: Column) -> Column:
    """North American numbers; a country code stays. Those with area and exchange of 200 to 999 stay such, all others stay others."""
    return _let(_digits(m), lambda d: _phone_of(key, m, d))


def _phone_of(key: str, m: Column, d: Column) -> Column:
    ten = F.substr(d, F.length(d) - 9)
    area, exchange, line = F.substr(ten, F.lit(1), F.lit(3)).cast("int"), F.substr(ten, F.lit(4), F.lit(3)).cast("int"), F.substr(ten, F.lit(7)).cast("int")
    usual = permuted(key, "phone", (area - 200) * 800 + exchange - 200, line, 640_000, 10_000)
    new = _let(usual, lambda q: F.concat(_padded(F.floor(q["l"] / 800) + 200, 3), _padded(F.pmod(q["l"], 800) + 200, 3), _padded(q["r"], 4)))
    # The other 360,000 beginnings: 200 areas with any exchange, then 800 areas with 200 exchanges each.
    rank = F.when(area < 200, area * 1000 + exchange).otherwise(200_000 + (area - 200) * 200 + exchange)
    other = permuted(key, "phone-other", rank, line, 360_000, 10_000)

    def written(q: Column) -> Column:
        low, over = q["l"] < 200_000, q["l"] - 200_000
        head = F.when(low, F.floor(q["l"] / 1000)).otherwise(F.floor(over / 200) + 200)
        middle = F.when(low, F.pmod(q["l"], 1000)).otherwise(F.pmod(over, 200))
        return F.concat(_padded(head, 3), _padded(middle, 3), _padded(q["r"], 4))

    return _filled(m, F.when((area >= 200) & (exchange >= 200), new).otherwise(_let(other, written)), F.length(d) - 10)


def _world_phone(key: str, m: Column) -> Column:
    d = _digits(m)
    code = F.length(F.regexp_extract(m, r"^\+([0-9]{1,3})", 1))
    return F.when(F.length(d).between(8, 15), _filled(m, permuted_text(key, "world", F.substr(d, code + 1)), code)).otherwise(m)


def _address(key: str, m: Column) -> Column:
    o = [F.element_at(F.split(m, "[.]"), i).cast("int") for i in (1, 2, 3, 4)]
    p = permuted(key, "address", o[0] * 256 + o[1], o[2] * 256 + o[3], 65_536, 65_536)
    new = _let(p, lambda q: F.concat_ws(".", *[x.cast("string") for side in ("l", "r") for x in (F.floor(q[side] / 256), F.pmod(q[side], 256))]))
    return F.when(reduce(lambda a, b: a & b, [x <= 255 for x in o]), new).otherwise(m)


def _email(key: str, m: Column) -> Column:
    low = F.lower(m)
    top = F.regexp_extract(low, r"(\.[a-z]+)$", 1)
    return F.concat(permuted_text(key, "email", F.substr(low, F.lit(1), F.length(low) - F.length(top))), top)


def _secret(key: str, m: Column) -> Column:
    value = F.regexp_extract(m, f"^{SECRET_NAME}(.*)$", 1)
    return F.concat(F.substr(m, F.lit(1), F.length(m) - F.length(value)), permuted_text(key, "secret", value))


def pseudonym(key: str, m: Column) -> Column:
    """What replaces a found value ``m``; the kinds are told apart by their patterns."""

    def all_of(pattern: str) -> Column:
        return m.rlike(f"^(?:{pattern})$")

    return (
        F.when(F.contains(m, F.lit("@")), _email(key, m))
        .when(all_of(IBAN), _iban(key, m))
        .when(all_of(SECRET), _secret(key, m))
        .when(all_of(ACCESS_KEY), F.concat(F.lit("AKIA"), permuted_text(key, "access", F.substr(m, F.lit(5)))))
        .when(all_of(CARD), _card(key, m))
        .when(all_of(ISO_DATE) | all_of(DAY_DATE), _dates(key, m))
        .when(all_of(SOCIAL), _social(key, m))
        .when(all_of(PHONE), _phone(key, m))
        .when(all_of(WORLD_PHONE), _world_phone(key, m))
        .when(all_of(ADDRESS), _address(key, m))
        .otherwise(m)
    )


def pseudonymise(docs: DataFrame, text: str = "text", key: str = KEY, count: str | None = None) -> DataFrame:
    """``docs`` with every valid personal value in column ``text`` replaced by its pseudonym.

    ``count`` names a further column for the number of values replaced. Null texts stay null (count 0), empty texts
    empty; texts without values pass unchanged, as do all other columns whatever their names. Rows are worked on one by
    one, without a shuffle. A column already called ``count``'s value is an error.
    """
    if count and fresh(docs, count) != count:
        raise ValueError(f"the table already has a column {count}")
    found, parts, made = fresh(docs, "found"), fresh(docs, "parts"), fresh(docs, "made")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Every value holds a digit or an @; a plain look for them spares most texts the long pattern.
    likely = F.col(text).rlike("[0-9@]") | F.lower(F.col(text)).rlike("password|passwd|token|secret|api_key")
    with_found = docs.withColumn(found, F.when(likely, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    with_parts = with_found.withColumn(parts, F.when(F.size(found) > 0, F.split(text, ANY, -1)))
    with_made = with_parts.withColumn(made, F.transform(F.when(F.size(found) > 0, F.col(found)), lambda m: pseudonym(key, m)))
    put = F.array_join(F.zip_with(F.col(parts), F.col(made), lambda p, m: F.concat(p, F.coalesce(m, F.lit("")))), "")
    new = F.when(F.col(made).isNull(), F.col(text)).otherwise(put)
    replaced = F.size(F.filter(F.zip_with(F.col(found), F.col(made), lambda a, b: a != b), lambda x: x))
    out = [new.alias(c) if c == text else column for c, column in zip(docs.columns, columns, strict=True)]
    if count:
        out.append(F.when(F.col(made).isNull(), 0).otherwise(replaced).cast("int").alias(count))
    return with_made.select(*out)


def op5_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, the text with pseudonyms and the number of values replaced, for every document."""
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return pseudonymise(docs, count="n_values")
