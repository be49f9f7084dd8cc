"""Format-preserving pseudonyms for validated numbers and dates, in Spark expressions alone.

Each value is permuted by a keyed Feistel network over the set of valid values of its own format:
a card number stays one of the same length with a right check digit, a date a date. The
permutation is one to one and depends on key and kind only, so equal values stay linked across
documents and different ones stay apart, and with the key it can be reversed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# fixed formats; a match that fails its validation stays as it is
_IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
_ISO = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
_DMY = r"[0-9]{2}[./][0-9]{2}[./][0-9]{4}"
_PHONE = r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
_CARD = r"(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})"
FOUND = rf"(?<![0-9A-Za-z.+-])(?:{_IP}|{_ISO}|{_DMY}|{_PHONE}|{_SSN}|{_CARD})(?![0-9A-Za-z]|[.-][0-9])"

FIRST_DAY, DAYS = "1800-01-01", 146_097  # 400 years, 27 * 5411 days


def _sub(s: Column, at: int | Column, n: int | Column) -> Column:
    return F.substring(s, at, n) if isinstance(at, int) and isinstance(n, int) else s.substr(F.lit(at) if isinstance(at, int) else at, F.lit(n) if isinstance(n, int) else n)


def feistel(value: Column, a: int | Column, b: int | Column, key: str, kind: Column | str, back: bool = False) -> Column:
    """A keyed permutation of 0 .. a*b-1: the digits to bases a and b are shifted in turn by a hash of the other."""
    a, b = (F.lit(x).cast("long") if isinstance(x, int) else x for x in (a, b))
    tag = F.lit(kind) if isinstance(kind, str) else kind

    def shift(other: Column, step: Column, side: str) -> Column:
        text = F.concat_ws("|", F.lit(key), tag, step.cast("string"), F.lit(side), other.cast("string"))
        return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")

    def forth(s: Column, step: Column) -> Column:
        left = F.pmod(s["l"] + F.pmod(shift(s["r"], step, "l"), a), a)
        return F.struct(left.alias("l"), F.pmod(s["r"] + F.pmod(shift(left, step, "r"), b), b).alias("r"))

    def undo(s: Column, step: Column) -> Column:
        right = F.pmod(s["r"] - F.pmod(shift(s["l"], step, "r"), b), b)
        return F.struct(F.pmod(s["l"] - F.pmod(shift(right, step, "l"), a), a).alias("l"), right.alias("r"))

    steps = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if back else F.sequence(F.lit(1), F.lit(ROUNDS))
    begin = F.struct(F.call_function("div", value, b).alias("l"), F.pmod(value, b).alias("r"))
    return F.aggregate(steps, begin, undo if back else forth, lambda s: s["l"] * b + s["r"])


def luhn_sum(digits: Column, from_right: int) -> Column:
    """Sum of the digits, every second one from the right doubled; ``from_right`` is the place of the last digit."""
    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(
        places,
        F.lit(0),
        lambda total, i: total
        + F.when(
            (F.length(digits) - i + from_right) % 2 == 1,
            F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), digits.substr(i, F.lit(1)).cast("int") + 1),
        ).otherwise(digits.substr(i, F.lit(1)).cast("int")),
    )


def _int(s: Column) -> Column:
    return s.cast("long")


def _valid_day(y: Column, m: Column, d: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    last = F.when(m.isin(4, 6, 9, 11), 30).when(m == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    return y.between(1800, 2199) & m.between(1, 12) & d.between(1, 31) & (d <= last)


def _fill(form: Column, digits: Column) -> Column:
    """The format with its digits replaced in order."""
    chars = F.split(form, "")
    seen = F.aggregate(
        chars,
        F.struct(F.lit("").alias("s"), F.lit(1).alias("n")),
        lambda acc, c: F.when(
            c.rlike("^[0-9]$"),
            F.struct(F.concat(acc["s"], digits.substr(acc["n"], F.lit(1))).alias("s"), (acc["n"] + 1).alias("n")),
        ).otherwise(F.struct(F.concat(acc["s"], c).alias("s"), acc["n"].alias("n"))),
    )
    return seen["s"]


def _card(m: Column, key: str, back: bool) -> Column:
    digits = F.regexp_replace(m, "[ -]", "")
    size = F.length(digits)
    body = digits.substr(F.lit(1), size - 1)
    low = F.floor((size - 1) / 2).cast("int")
    # 12 to 18 digits of payload, as two halves
    new = feistel(_int(body), F.pow(F.lit(10.0), size - 1 - low).cast("long"), F.pow(F.lit(10.0), low).cast("long"), key, F.concat(F.lit("card"), size.cast("string")), back)
    payload = F.lpad(new.cast("string"), size - 1, F.lit("0"))
    check = F.pmod(-luhn_sum(payload, 1), F.lit(10)).cast("string")
    return _fill(m, F.concat(payload, check))


def _day(y: Column, m: Column, d: Column, key: str, back: bool) -> Column:
    number = F.datediff(F.make_date(y.cast("int"), m.cast("int"), d.cast("int")), F.lit(FIRST_DAY).cast("date")).cast("long")
    return F.date_add(F.lit(FIRST_DAY).cast("date"), feistel(number, 27, 5411, key, "date", back).cast("int"))


def _ip(m: Column, key: str, back: bool) -> Column:
    parts = F.split(m, "\\.")
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n * 256 + p.cast("long"))
    new = feistel(number, 65536, 65536, key, "ipv4", back)
    return F.concat_ws(".", *[F.pmod(F.shiftright(new, 8 * k), F.lit(256)).cast("string") for k in (3, 2, 1, 0)])


def _phone(m: Column, key: str, back: bool) -> Column:
    digits = F.regexp_replace(m.substr(F.lit(3), F.lit(32)), "[^0-9]", "")
    new = F.lpad(feistel(_int(digits), 100_000, 100_000, key, "phone", back).cast("string"), 10, "0")
    return F.concat(F.lit("+1 ("), _sub(new, 1, 3), F.lit(") "), _sub(new, 4, 3), F.lit("-"), _sub(new, 7, 4))


def _ssn(m: Column, key: str, back: bool) -> Column:
    area, group, serial = _int(_sub(m, 1, 3)), _int(_sub(m, 5, 2)), _int(_sub(m, 8, 4))
    # areas 1 to 899 without 666, groups 1 to 99, serials 1 to 9999
    left = area - 1 - (area > 666).cast("long")
    new = feistel(left * (99 * 9999) + (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn", back)
    rest = F.pmod(new, F.lit(99 * 9999))
    high = ((new - rest) / (99 * 9999)).cast("long")
    serial2 = F.pmod(rest, F.lit(9999))
    return F.concat_ws(
        "-",
        F.lpad((high + 1 + (high >= 665).cast("long")).cast("string"), 3, "0"),
        F.lpad((((rest - serial2) / 9999).cast("long") + 1).cast("string"), 2, "0"),
        F.lpad((serial2 + 1).cast("string"), 4, "0"),
    )


def kind_of(m: Column) -> Column:
    """The kind of a match that passes its validation, else null."""
    ip = m.rlike(f"^{_IP}$") & F.forall(
        F.split(m, "\\."), lambda p: p.rlike("^(0|[1-9][0-9]*)$") & (p.cast("int") <= 255)
    )
    iso = m.rlike(f"^{_ISO}$") & _valid_day(_int(_sub(m, 1, 4)), _int(_sub(m, 6, 2)), _int(_sub(m, 9, 2)))
    dmy = m.rlike(f"^{_DMY}$") & (_sub(m, 3, 1) == _sub(m, 6, 1)) & _valid_day(_int(_sub(m, 7, 4)), _int(_sub(m, 4, 2)), _int(_sub(m, 1, 2)))
    ssn = m.rlike(f"^{_SSN}$") & ~m.rlike("^(000|666|9)|-00-|-0000$")
    digits = F.regexp_replace(m, "[ -]", "")
    card = m.rlike(f"^{_CARD}$") & (luhn_sum(digits, 0) % 10 == 0)
    return (
        F.when(ip, "ipv4").when(iso, "iso").when(dmy, "dmy").when(m.rlike(f"^{_PHONE}$"), "phone").when(ssn, "ssn").when(card, "card")
    )


def pseudonym(m: Column, kind: Column, key: str, back: bool = False) -> Column:
    iso = F.date_format(_day(_int(_sub(m, 1, 4)), _int(_sub(m, 6, 2)), _int(_sub(m, 9, 2)), key, back), "yyyy-MM-dd")
    day = _day(_int(_sub(m, 7, 4)), _int(_sub(m, 4, 2)), _int(_sub(m, 1, 2)), key, back)
    dmy = F.concat(F.date_format(day, "dd"), _sub(m, 3, 1), F.date_format(day, "MM"), _sub(m, 3, 1), F.date_format(day, "yyyy"))
    return (
        F.when(kind == "ipv4", _ip(m, key, back))
        .when(kind == "iso", iso)
        .when(kind == "dmy", dmy)
        .when(kind == "phone", _phone(m, key, back))
        .when(kind == "ssn", _ssn(m, key, back))
        .when(kind == "card", _card(m, key, back))
        .otherwise(m)
    )


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """One row per row of ``docs``: id, text, found (array of (kind, value, pseudonym)), n_found.

    Null counts as empty and stays unchanged, as does every text without a validated value; what looks like
    a value but fails its validation (check digit, octet, calendar) is kept. Repeated rows are treated alike,
    other columns are not read. ``back`` reverses with the same key.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cut = docs.select(
        F.col(id_col),
        text.alias("__text"),
        F.transform(
            F.regexp_extract_all(text, F.lit(FOUND), F.lit(0)), lambda m: F.struct(kind_of(m).alias("kind"), m.alias("value"))
        ).alias("__found"),
    )
    changed = F.transform(
        "__found", lambda x: F.struct(x["kind"].alias("kind"), x["value"].alias("value"), pseudonym(x["value"], x["kind"], key, back).alias("pseudonym"))
    )
    done = cut.select(
        id_col, "__text", F.when(F.exists("__found", lambda x: x["kind"].isNotNull()), changed).otherwise(F.array().cast("array<struct<kind:string,value:string,pseudonym:string>>")).alias("__found")
    )
    gaps = F.split("__text", FOUND, -1)
    pieces = F.zip_with(gaps, F.concat(F.col("__found.pseudonym"), F.array(F.lit(""))), lambda g, p: F.concat(g, p))
    found = F.filter("__found", lambda x: x["kind"].isNotNull())
    return done.select(
        id_col,
        F.when(F.size("__found") > 0, F.array_join(pieces, "")).otherwise(F.col("__text")).alias("text"),
        found.alias("found"),
        F.size(found).cast("long").alias("n_found"),
    )
