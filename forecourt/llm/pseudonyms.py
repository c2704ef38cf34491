"""Format-preserving pseudonyms of personal data by keyed Feistel permutations.

Card numbers, phone numbers, addresses of machines, social security numbers and
dates are validated and mapped, under a key, to another valid value of the same
format. The map is a permutation of all values of the format, so equal values
stay equal in every document and different ones different. Names in mail
addresses are permuted letter by letter within their letter cases and digits.

A value is a pair (left, right) out of a x b values. A round adds a keyed hash of
one side to the other, modulo its size, and swaps them; any key gives a
permutation. DataFrame expressions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


ROUNDS = 8

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september",
          "october", "november", "december")
_MONTH = "(?i:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS) + ")"

# The formats that are looked for. The order decides where two begin
# at the same place.
FORMATS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phone": r"(?<![\d+])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[2-9][0-9]{2}[ .-])[0-9]{3}[ .-][0-9]{4}(?!\d)"
             r"|(?<![\d+])\+[1-9](?:[ .()-]{0,2}[0-9]){6,14}(?!\d)",
    "ssn": r"(?<![\d-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![\d-])",
    "date": r"(?<![\d/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
            r"|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?!\d|[/.-]\d)"
            rf"|(?<![\w/.-])(?:[0-9]{{1,2}} {_MONTH}|{_MONTH} [0-9]{{1,2}}),? [0-9]{{4}}(?!\d)",
    "ip": r"(?<![\d.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?\d)",
    "card": r"(?<![\d-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}"
            r"|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?!\d|-\d)",
}
KINDS = tuple(FORMATS)
PATTERN = "|".join(f"(?:{p})" for p in FORMATS.values())

# Dates of these days are permuted among themselves: 314 * 350 days from 1800 on.
FIRST_DAY = "1800-01-01"
DAYS = (314, 350)
# Two-digit country codes; 1 and 7 have one digit and all others three.
CODES = ("2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")


def _hash(key: str, kind: str, step: Column, value: Column) -> Column:
    """A keyed 48-bit number."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def permuted(left: Column, right: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """Struct (l, r): the pair (left < a, right < b) under the keyed permutation."""
    def step(s: Column, i: Column) -> Column:
        size = F.when(i % 2 == 0, a).otherwise(b)
        return F.struct(s["r"].alias("l"),
                        ((s["l"] + _hash(key, kind, i, s["r"])) % size).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
                       F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _padded(number: Column, width: Column | int) -> Column:
    width = F.lit(width) if isinstance(width, int) else width
    return F.lpad(number.cast("string"), width, F.lit("0"))


def _refilled(text: Column, digits: Column) -> Column:
    """``text`` with its digits replaced by others, in order."""
    return F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(
        c.rlike("^[0-9]$"), F.substring(digits, F.length(_digits(F.substring(
            text, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")


def _luhn_rest(digits: Column) -> Column:
    """Sum of the Luhn rule, modulo 10, over digits that a check digit follows."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10


def _check_digit(payload: Column) -> Column:
    return ((10 - _luhn_rest(payload)) % 10).cast("string")


def valid_card(text: Column) -> Column:
    return let(_digits(text), lambda d: _check_digit(
        F.substring(d, F.lit(1), F.length(d) - 1)) == F.substring(d, F.length(d), F.lit(1)))


def card(text: Column, key: str) -> Column:
    """The first digit stays, the rest but the check digit is permuted, then that is made anew."""
    def inner(d: Column) -> Column:
        size = F.length(d) - 2
        half = (size / 2).cast("int")
        power = lambda n: F.pow(F.lit(10), n).cast("long")
        pair = permuted(F.substring(d, F.lit(2), half), F.substring(d, half + 2, size - half),
                        power(half), power(size - half), key, "card")
        return let(pair, lambda p: let(
            F.concat(F.substring(d, 1, 1), _padded(p["l"], half), _padded(p["r"], size - half)),
            lambda payload: _refilled(text, F.concat(payload, _check_digit(payload)))))

    return let(_digits(text), inner)


def phone(text: Column, key: str) -> Column:
    """The digits after a country code are permuted, the code stays.

    Of ten digits without a code or after +1, area and exchange that begin with 2 to
    9 go to such, any other pair to any other.
    """
    def abroad(d: Column) -> Column:
        code = F.when(d.rlike("^[17]"), 1).when(d.rlike(f"^(?:{CODES})"), 2).otherwise(3)
        size = F.length(d) - code
        half = (size / 2).cast("int")
        power = lambda n: F.pow(F.lit(10), n).cast("long")
        pair = permuted(F.substring(d, code + 1, half), F.substring(d, code + half + 1, size - half),
                        power(half), power(size - half), key, "phone abroad")
        return let(pair, lambda p: _refilled(text, F.concat(
            F.substring(d, F.lit(1), code), _padded(p["l"], half), _padded(p["r"], size - half))))

    def inner(d: Column) -> Column:
        ten = F.substring(d, -10, 10)
        area, exchange = F.substring(ten, 1, 3).cast("int"), F.substring(ten, 4, 3).cast("int")
        line = F.substring(ten, 7, 4)
        usual = (area >= 200) & (exchange >= 200)
        # numbers of the other pairs: area below 200 first, then exchange below 200
        other = F.when(area < 200, area * 1000 + exchange).otherwise(
            200_000 + (area - 200) * 200 + exchange)
        left = F.when(usual, (area - 200) * 800 + exchange - 200).otherwise(other)
        size = F.when(usual, F.lit(640_000)).otherwise(F.lit(360_000))
        pair = permuted(left, line, size, F.lit(10_000), key, "phone")

        def back(p: Column) -> Column:
            n = p["l"]
            of_usual = ((n / 800).cast("int") + 200) * 1000 + n % 800 + 200
            rest = n - 200_000
            of_other = F.when(n < 200_000, n).otherwise(
                ((rest / 200).cast("int") + 200) * 1000 + rest % 200)
            head = F.when(usual, of_usual).otherwise(of_other)
            return _refilled(text, F.concat(F.substring(d, F.lit(1), F.length(d) - 10),
                                            _padded(head, 6), _padded(p["r"], 4)))

        return let(pair, back)

    return let(_digits(text), lambda d: F.when(
        text.startswith("+") & ~((F.length(d) == 11) & d.startswith("1")), abroad(d))
        .otherwise(inner(d)))


def ssn(text: Column, key: str) -> Column:
    """Area 001 to 899 without 666, group 01 to 99, serial 0001 to 9999."""
    area = F.substring(text, 1, 3).cast("int")
    area = area - F.when(area > 666, 2).otherwise(1)
    pair = permuted(area * 99 + F.substring(text, 5, 2).cast("int") - 1,
                    F.substring(text, 8, 4).cast("int") - 1, F.lit(898 * 99), F.lit(9999),
                    key, "ssn")

    def back(p: Column) -> Column:
        a = (p["l"] / 99).cast("int") + 1
        return F.concat_ws("-", _padded(a + F.when(a >= 666, 1).otherwise(0), 3),
                           _padded(p["l"] % 99 + 1, 2), _padded(p["r"] + 1, 4))

    return let(pair, back)


def valid_ip(text: Column) -> Column:
    return F.forall(F.split(text, r"\."), lambda o: o.cast("int") < 256)


def ip(text: Column, key: str) -> Column:
    def number(i: int) -> Column:
        return F.element_at(F.split(text, r"\."), i).cast("int")

    pair = permuted(number(1) * 256 + number(2), number(3) * 256 + number(4), F.lit(65536),
                    F.lit(65536), key, "ip")
    return let(pair, lambda p: F.concat_ws(".", *[
        (x.cast("string")) for side in ("l", "r")
        for x in ((p[side] / 256).cast("int"), p[side] % 256)]))


def _as_day(text: Column) -> Column:
    """The day a date text names, or null."""
    day = F.when(text.rlike("^.{4}-"), text).when(
        F.substring(text, 3, 1) == "/", F.concat_ws("-", F.substring(text, 7, 4), F.substring(
            text, 1, 2), F.substring(text, 4, 2))).otherwise(
        F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2)))
    return day.try_cast("date")


def _plain_date(text: Column) -> Column:
    """Whether all numbers are padded and the order is that of ``_as_day``."""
    since = F.datediff(_as_day(text), F.lit(FIRST_DAY).cast("date"))
    return text.rlike("^(?:.{4}-.*|[0-9]{2}([/.])[0-9]{2}\\1[0-9]{4})$") & F.coalesce(
        (since >= 0) & (since < DAYS[0] * DAYS[1]), F.lit(False))


def _other_date(text: Column) -> Column:
    """Year, month and day of the other notations, and what days their notation can name.

    ``months`` are those that can stand there: 1 to 9 for one digit, all but May for
    whole names, as a short name is May too. ``low`` is 13 where a day comes first
    that can be no month, and ``wide`` says whether the day has two digits.
    """
    named, slash = text.rlike("[A-Za-z]"), text.contains("/")
    one = F.regexp_extract(text, "^([0-9A-Za-z]+)", 1)
    two = F.regexp_extract(text, "^[0-9A-Za-z]+[/. ]([0-9A-Za-z]+)", 1)
    first = F.when(slash, one.try_cast("int") > 12).otherwise(text.rlike("^[0-9]"))
    day, month = F.when(first, one).otherwise(two), F.when(first, two).otherwise(one)
    short = F.array(*[F.lit(m[:3]) for m in MONTHS])
    some = lambda numbers: F.array(*[F.lit(n) for n in numbers])
    return F.struct(
        F.substring(text, -4, 4).try_cast("int").alias("y"),
        F.when(named, F.array_position(short, F.lower(F.substring(month, 1, 3))).cast("int"))
        .otherwise(month.try_cast("int")).alias("m"),
        day.try_cast("int").alias("d"), first.alias("first"), month.alias("month"),
        (F.length(day) == 2).alias("wide"), F.when(slash & first, 13).otherwise(1).alias("low"),
        F.when(named & (F.length(month) > 3), some([1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12]))
        .when(~named & (F.length(month) == 1), some(range(1, 10)))
        .otherwise(some(range(1, 13))).alias("months"))


def valid_date(text: Column) -> Column:
    other = let(_other_date(text), lambda o: o["y"].between(1800, 2099)
                & o["month"].rlike("^(?:[0-9]+|[A-Z]?[a-z]+|[A-Z]+)$")
                & F.concat_ws("-", o["y"].cast("string"), _padded(o["m"], 2), _padded(o["d"], 2))
                .try_cast("date").isNotNull())
    return _plain_date(text) | (~text.rlike("^.{4}-") & F.coalesce(other, F.lit(False)))


def date(text: Column, key: str) -> Column:
    """A day of the years 1800 to 2100 becomes another, in the same notation."""
    since = F.datediff(_as_day(text), F.lit(FIRST_DAY).cast("date"))
    pair = permuted((since / DAYS[1]).cast("int"), since % DAYS[1], F.lit(DAYS[0]),
                    F.lit(DAYS[1]), key, "date")

    def back(p: Column) -> Column:
        day = F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * DAYS[1] + p["r"]).cast("int"))
        return F.when(text.rlike("^.{4}-"), F.date_format(day, "yyyy-MM-dd")).when(
            F.substring(text, 3, 1) == "/", F.date_format(day, "MM/dd/yyyy")).otherwise(
            F.date_format(day, "dd.MM.yyyy"))

    return F.when(_plain_date(text), let(pair, back)).otherwise(
        let(_other_date(text), lambda o: _moved_date(text, o, key)))


def _moved_date(text: Column, o: Column, key: str) -> Column:
    """Days up to 28, 29 and 30, 31, and leap days are permuted among themselves."""
    leap, end, late = (o["m"] == 2) & (o["d"] == 29), o["d"] == 31, o["d"] > 28
    months = F.when(leap, F.array(F.lit(2))).when(
        end, F.filter(o["months"], lambda m: m.isin(1, 3, 5, 7, 8, 10, 12))).when(
        late, F.filter(o["months"], lambda m: m != 2)).otherwise(o["months"])
    low = F.when(end, 31).when(late, 29).otherwise(o["low"])
    days = F.when(end | leap, 1).when(late, 2).otherwise(
        F.when(o["wide"], 29 - o["low"]).otherwise(9))
    # leap years from 1804 to 2096 without 1900
    four = ((o["y"] - 1804) / 4).cast("int")
    year = F.when(leap, four - F.when(four > 24, 1).otherwise(0)).otherwise(o["y"] - 1800)
    pair = permuted(year, (F.array_position(months, o["m"]) - 1) * days + o["d"] - low,
                    F.when(leap, 73).otherwise(300), F.size(months) * days, key, "day")

    def back(p: Column) -> Column:
        four = p["l"] + F.when(p["l"] >= 24, 1).otherwise(0)
        y = F.when(leap, 1804 + 4 * four).otherwise(p["l"] + 1800).cast("string")
        m = F.get(months, (p["r"] / days).cast("int"))
        d = (p["r"] % days + low).cast("string")
        d = F.when(o["wide"], F.lpad(d, 2, "0")).otherwise(d)
        name = F.get(F.array(*[F.lit(n) for n in MONTHS]), m - 1)
        name = F.when(F.length(o["month"]) == 3, F.substring(name, 1, 3)).otherwise(name)
        name = F.when(o["month"].rlike("^[A-Z]{2}"), F.upper(name)).when(
            o["month"].rlike("^[A-Z]"), F.initcap(name)).otherwise(name)
        number = F.lpad(m.cast("string"), F.length(o["month"]), F.lit("0"))
        month = F.when(o["month"].rlike("^[0-9]"), number).otherwise(name)
        two = F.regexp_extract(text, "^[0-9A-Za-z]+([/. ])[0-9A-Za-z]+", 1)
        rest = F.regexp_extract(text, "^[0-9A-Za-z]+[/. ][0-9A-Za-z]+([/., ]+)", 1)
        return F.concat(F.when(o["first"], d).otherwise(month), two,
                        F.when(o["first"], month).otherwise(d), rest, y)

    return let(pair, back)


def email(text: Column, key: str) -> Column:
    """The part before the @: each letter and digit is shifted within its case, in rounds."""
    def shifted(side: Column, other: Column, i: Column) -> Column:
        def one(c: Column, at: Column) -> Column:
            size = F.when(c.rlike("[0-9]"), 10).otherwise(26)
            first = F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).otherwise(65)
            moved = (F.ascii(c) - first + _hash(key, "email", i * 1000 + at, other)) % size + first
            return F.when(c.rlike("[A-Za-z0-9]"), F.char(moved)).otherwise(c)

        return F.array_join(F.transform(F.split(side, ""), one), "")

    def inner(name: Column) -> Column:
        half = (F.length(name) / 2).cast("int")
        pair = F.aggregate(
            F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
            F.struct(F.substring(name, F.lit(1), half).alias("l"),
                     F.substring(name, half + 1, F.length(name) - half).alias("r")),
            lambda s, i: F.struct(s["r"].alias("l"), shifted(s["l"], s["r"], i).alias("r")))
        return let(pair, lambda p: F.concat(p["l"], p["r"]))

    return F.concat(let(F.substring_index(text, "@", 1), inner), F.lit("@"),
                    F.substring_index(text, "@", -1))


def kind_of(match: Column) -> Column:
    """The kind a match of ``PATTERN`` validates as, or null."""
    checks = {"phone": F.lit(True), "email": F.lit(True), "ssn": F.lit(True),
              "date": valid_date(match), "ip": valid_ip(match), "card": valid_card(match)}
    kind = F.lit(None).cast("string")
    for name in reversed(KINDS):
        shape = match.rlike(f"^(?:{FORMATS[name]})$")
        kind = F.when(shape, F.when(checks[name], F.lit(name))).otherwise(kind)
    return kind


def pseudonymised(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Per row: ``row`` (all its columns), ``safe`` (its text with pseudonyms) and ``kinds``.

    ``kinds`` lists the kind of each replaced value in order. Values that look like
    a format but are not valid (check digit, octets above 255, no such day) stay,
    and so does all other text. Null text gives null and no kinds. Equal values get
    equal pseudonyms in all rows; an empty table gives an empty result.
    """
    base = docs.select(F.struct("*").alias("row"), F.col(text).alias("t"))
    # most texts have neither a digit nor an @, and are not searched
    some = base.withColumn("found", F.when(F.col("t").rlike("[0-9@]"), F.regexp_extract_all(
        "t", F.lit(PATTERN), 0)).otherwise(F.array().cast("array<string>")))
    named = some.withColumn("named", F.transform("found", lambda m: F.struct(
        m.alias("m"), kind_of(m).alias("kind"))))
    methods = {"email": email, "phone": phone, "ssn": ssn, "date": date, "ip": ip, "card": card}

    def changed(x: Column) -> Column:
        value = x["m"]
        for name, method in methods.items():
            value = F.when(x["kind"] == name, method(x["m"], key)).otherwise(value)
        return value

    made = named.withColumn("made", F.transform("named", changed))
    between = F.split("t", PATTERN, -1)
    whole = F.array_join(F.zip_with(between, "made", lambda p, m: F.concat(
        p, F.coalesce(m, F.lit("")))), "")
    return made.select(
        "row", F.when(F.size("found") > 0, whole).otherwise(F.col("t")).alias("safe"),
        F.filter(F.transform("named", lambda x: x["kind"]), lambda k: k.isNotNull())
        .alias("kinds"))


def without_private_data(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The documents with pseudonyms in their text, columns as they were."""
    return pseudonymised(docs, key, text).select(
        *[F.col("safe").alias(c) if c == text else F.col("row").getField(c).alias(c)
          for c in docs.columns])
