"""Format-preserving pseudonyms of personal data by keyed Feistel permutations, in SQL expressions only.

Found values are checked before anything is replaced: card numbers by their check digit, addresses by the
range of their numbers, dates by the calendar. Each value is then brought to one form (digits of a number,
day of a date), permuted by a Feistel network under a key within the values of its format, and written back with
its own separators. Equal values so get equal pseudonyms in all documents, different values different ones, and a
pseudonym is as valid as the value: a card's check digit is right, a date exists.

============  ====================================================  =======================================
kind          form                                                  permuted
============  ====================================================  =======================================
email         name@host.domain                                      letters and digits of the name, each in its class
card          13 to 19 digits, also with spaces or dashes           all digits but the last, which is computed
phone         (ddd) ddd-dddd, ddd-ddd-dddd, also with +country       ten digits of the number
ssn           ddd-dd-dddd                                           nine digits
ip            d.d.d.d                                               32 bits
date          yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy, 1900 to 2099      the day among all days of these years
secret        32 to 64 hexadecimal digits                           hexadecimal digits
============  ====================================================  =======================================

Names of emails and secrets are linked in lower case and get their pseudonym so. What fails its check stays as it is. A
null text stays null, an empty one empty; rows repeated are treated alike; all other columns are carried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestrata.llm.session import free_name

KEY = "pseudonyms-1"
ROUNDS = 8

#: In the order in which they are tried at one place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}",
    "secret": r"(?<![0-9A-Za-z])[0-9a-fA-F]{32,64}+(?![0-9A-Za-z])",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4})(?![./-]?\d)",
    "ip": r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)",
}
_ANY = "|".join(PATTERNS.values())

_FIRST_DAY, _DAYS = "1900-01-01", 73_049
#: Two numbers whose product just holds all days.
_LEFT, _RIGHT = 271, 270
_WALKS = 12

_DIGITS, _HEX, _LOWER = "0123456789", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"


def _stream(key: str, number: Column, text: Column) -> Column:
    """128 hexadecimal digits which depend on the key, a round and a text."""
    return F.sha2(F.concat_ws(":", F.lit(key), number.cast("string"), text), 512)


def _moved(text: Column, stream: Column, alphabets: list[str]) -> Column:
    """Each character moved on within its alphabet by a number of the stream; others stay."""

    def one(char: Column, place: Column) -> Column:
        by = F.conv(F.substring(stream, 2 * (place % 64) + 1, F.lit(2)), 16, 10).cast("int")
        out = char
        for alphabet in alphabets:
            at = F.instr(F.lit(alphabet), char) - 1
            out = F.when(at >= 0, F.substring(F.lit(alphabet), (at + by) % len(alphabet) + 1, F.lit(1))).otherwise(out)
        return out

    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, one), "")


def permuted(text: Column, key: str, alphabets: list[str]) -> Column:
    """Feistel network over the two halves of a string; every character stays in its alphabet."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("l"), F.substring(text, half + 1, F.length(text)).alias("r"))

    def step(state: Column, number: Column) -> Column:
        return F.struct(state["r"].alias("l"), _moved(state["l"], _stream(key, number, state["r"]), alphabets).alias("r"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, step, lambda state: F.concat(state["l"], state["r"]))


def _permuted_bits(value: Column, key: str) -> Column:
    """Feistel network over 32-bit numbers."""
    start = F.struct((value / F.lit(65536)).cast("long").alias("l"), (value % 65536).cast("long").alias("r"))

    def step(state: Column, number: Column) -> Column:
        mask = F.conv(F.substring(_stream(key, number, state["r"].cast("string")), 1, 4), 16, 10).cast("long")
        return F.struct(state["r"].alias("l"), state["l"].bitwiseXOR(mask).alias("r"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, start, step, lambda state: state["l"] * 65536 + state["r"])


def _permuted_day(day: Column, key: str) -> Column:
    """Feistel network over pairs of numbers below 271 and 270, walked on until the pair is a day."""

    def once(value: Column) -> Column:
        start = F.struct((value % _LEFT).cast("int").alias("l"), F.floor(value / _LEFT).cast("int").alias("r"))

        def step(state: Column, number: Column) -> Column:
            odd = number % 2 == 1
            from_ = F.when(odd, state["r"]).otherwise(state["l"]).cast("string")
            by = F.conv(F.substring(_stream(key, number, from_), 1, 6), 16, 10).cast("int")
            return F.struct(
                F.when(odd, (state["l"] + by) % _LEFT).otherwise(state["l"]).alias("l"),
                F.when(odd, state["r"]).otherwise((state["r"] + by) % _RIGHT).alias("r"),
            )

        rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
        return F.aggregate(rounds, start, step, lambda state: state["r"] * _LEFT + state["l"])

    def walk(value: Column, _: Column) -> Column:
        return F.when(value < _DAYS, value).otherwise(once(value))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_WALKS)), once(day), walk)


def check_digit(body: Column) -> Column:
    """The digit which makes a number of these digits and itself pass the Luhn check."""
    digits = F.transform(F.filter(F.split(F.reverse(body), ""), lambda c: c != ""), lambda c: c.cast("int"))

    def value(digit: Column, place: Column) -> Column:
        twice = digit * 2
        return F.when(place % 2 == 0, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(digit)

    total = F.aggregate(F.transform(digits, value), F.lit(0), lambda a, b: a + b)
    return ((10 - total % 10) % 10).cast("string")


def _refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, char: Column) -> Column:
        is_digit = char.between("0", "9")
        put = F.when(is_digit, F.substring(digits, state["at"] + 1, F.lit(1))).otherwise(char)
        return F.struct(
            F.concat(state["out"], put).alias("out"), (state["at"] + F.when(is_digit, 1).otherwise(0)).alias("at")
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda state: state["out"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _email(value: Column, key: str) -> Column:
    name = F.lower(F.substring_index(value, "@", 1))
    return F.concat(permuted(name, key, [_DIGITS, _LOWER]), F.substring(value, F.length(name) + 1, F.length(value)))


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    size = F.length(digits)
    body = F.substring(digits, F.lit(1), size - 1)
    new = permuted(body, key, [_DIGITS])
    valid = check_digit(body) == F.substring(digits, size, F.lit(1))
    return F.when(valid, _refilled(value, F.concat(new, check_digit(new)))).otherwise(value)


def _numbers(count: int) -> Callable[[Column, str], Column]:
    """The last ``count`` digits of the value."""

    def pseudonym(value: Column, key: str) -> Column:
        digits = _digits(value)
        before = F.length(digits) - count
        new = permuted(F.substring(digits, before + 1, F.lit(count)), key, [_DIGITS])
        return _refilled(value, F.concat(F.substring(digits, F.lit(1), before), new))

    return pseudonym


def _ip(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a * 256 + p)
    new = _permuted_bits(number, key)
    octets = [F.shiftright(new, shift).bitwiseAND(F.lit(255).cast("long")).cast("string") for shift in (24, 16, 8, 0)]
    return F.when(F.forall(parts, lambda p: p <= 255), F.concat_ws(".", *octets)).otherwise(value)


def _date(value: Column, key: str) -> Column:
    shapes = [("____-__-__", "yyyy-MM-dd"), ("____/__/__", "yyyy/MM/dd"), ("__.__.____", "dd.MM.yyyy")]
    out = value
    for shape, style in shapes:
        day = F.datediff(F.try_to_timestamp(value, F.lit(style)).cast("date"), F.lit(_FIRST_DAY).cast("date"))
        new = F.date_add(F.lit(_FIRST_DAY).cast("date"), _permuted_day(day, key))
        out = F.when(value.like(shape) & day.between(0, _DAYS - 1), F.date_format(new, style)).otherwise(out)
    return out


PSEUDONYMS: dict[str, Callable[[Column, str], Column]] = {
    "email": _email,
    "card": _card,
    "phone": _numbers(10),
    "ssn": _numbers(9),
    "ip": _ip,
    "date": _date,
    "secret": lambda value, key: permuted(F.lower(value), key, [_HEX]),
}


def kind_of(value: Column) -> Column:
    """Which pattern a found value follows."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(value.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def pseudonymised(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with its text pseudonymised, and ``pii``: kind, place in the order of values, and pseudonym.

    If ``docs`` has a column pii, the result's is called pii_, and so on.
    """
    values, pairs, result = (free_name(name, docs.columns) for name in ("__found", "__new", "pii"))
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    found = docs.select(
        *others,
        F.col("text").cast("string").alias("text"),
        F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(_ANY), F.lit(0)).alias(values),
    )

    def replaced(value: Column) -> Column:
        kind, out = kind_of(value), value
        for name, pseudonym in PSEUDONYMS.items():
            out = F.when(kind == name, pseudonym(value, f"{key}/{name}")).otherwise(out)
        return F.struct(kind.alias("kind"), out.alias("pseudonym"), (out != value).alias("changed"))

    changed = found.withColumn(pairs, F.transform(values, replaced))
    between = F.split(F.col("text"), _ANY, -1)
    new = F.concat(F.transform(pairs, lambda x: x["pseudonym"]), F.array(F.lit("")))
    text = F.array_join(F.flatten(F.zip_with(between, new, lambda a, b: F.array(a, b))), "")
    pii = F.transform(
        F.filter(pairs, lambda x: x["changed"]), lambda x: F.struct(x["kind"].alias("kind"), x["pseudonym"].alias("pseudonym"))
    )
    columns = [
        F.when(F.size(values) == 0, F.col("text")).otherwise(text).alias("text") if c == "text" else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return changed.select(*columns, pii.alias(result))
