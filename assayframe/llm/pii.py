"""Format-preserving pseudonyms for personal data, in DataFrame operations.

A text is cut at candidates; each is validated (card: issuer and check digit;
IBAN: check digits; social security number, date, IPv4 address: valid parts;
phone: length; e-mail address: form) and, if valid, replaced by a keyed Feistel
permutation within its own format.  So a pseudonym is again a valid value of
the kind, written with the same separators, and equal values stay equal across
documents, whatever their separators.

Numbers are split into two parts x and y of known ranges a and b; in turn,
``x = (x + F(y)) mod a`` and ``y = (y + F(x)) mod b`` for ``ROUNDS`` rounds,
F being taken from a keyed SHA-256.  Each round can be undone, so the whole is
a permutation of a*b values.  Kept as they are: a card's first four digits, an
IBAN's letters, a phone's country code, a date's century, an address's domain.
Local parts of addresses are permuted letter by letter within their alphabets
by the same scheme on two halves.

Slashed dates are read month first, or day first if only that is valid; dotted
and dashed ones of trailing year are read day first.  A date's pseudonym is of
the same century and, like it, up to the 12th of a month or later.

Defined results: a null text stays null with zero counts; a candidate that isn't valid
stays; everything between candidates stays as it is.  Repeated rows and other
columns pass through; an output column replaces one of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "ip", "date", "iban", "ssn", "phone", "card")

#: Forms of candidates, in the order they are tried.
_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*(?<=\.[A-Za-z]{2,20})"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IP = rf"{_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)"
_DATE = r"\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}|\d{2}-\d{2}-\d{4}"
_SSN = r"\d{3}-\d{2}-\d{4}"
_IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
_PHONE = r"\+?\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}|\d{3}[ .-]\d{3}[ .-]\d{4}"
_CARD = r"\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{6} \d{5}"
CANDIDATE = rf"{_EMAIL}|(?<![\p{{L}}\p{{N}}])(?:(?<!\d\.){_IP}|(?:{_DATE}|{_SSN}|{_IBAN}|{_PHONE}|{_CARD})(?![\p{{L}}\p{{N}}]))"
#: A text without any of these characters has no candidate.
HINT = "[0-9@]"

#: Alphabets that letters of local parts are permuted in.
ALPHABETS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ")
#: First digits and lengths of card numbers.
ISSUERS = r"^(?:4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)\d{12}|3[47]\d{13}|6(?:011|5\d\d|4[4-9]\d)\d{12}|3(?:0[0-5]|[68]\d)\d{11}|35(?:2[89]|[3-8]\d)\d{12})$"


def _let(value: Column, use) -> Column:
    """``use(value)`` with value made once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _long(text: Column) -> Column:
    """Number that digits stand for; of no digits, zero."""
    return F.concat(F.lit("0"), text).cast("long")


def _draw(key: str, kind: str, turn: Column, value: Column) -> Column:
    """The round function: 60 bits of a keyed hash."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), value.cast("string")), 256), 1, 15), 16, 10).cast("long")


def feistel(key: str, kind: str, x: Column, y: Column, a: Column, b: Column) -> Column:
    """The permuted pair, struct<x, y>, with 0 <= x < a and 0 <= y < b."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), a.cast("long").alias("a"), b.cast("long").alias("b"))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        nx = F.when(even, (s["x"] + _draw(key, kind, i, s["y"])) % s["a"]).otherwise(s["x"])
        ny = F.when(even, s["y"]).otherwise((s["y"] + _draw(key, kind, i, s["x"])) % s["b"])
        return F.struct(nx.alias("x"), ny.alias("y"), s["a"].alias("a"), s["b"].alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _pad(value: Column, width: Column) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def permute_digits(key: str, kind: str, digits: Column) -> Column:
    """A permutation of all strings of as many digits (30 at most)."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    power = lambda k: F.pow(F.lit(10.0), k).cast("long")
    both = feistel(key, kind, _long(F.substring(digits, F.lit(1), left)), _long(F.substring(digits, left + 1, n)), power(left), power(n - left))
    # of an empty part only the value 0 exists, and it is written with no digit
    return F.when(n == 0, "").otherwise(_let(both, lambda s: F.concat(F.when(left > 0, _pad(s["x"], left)).otherwise(""), _pad(s["y"], n - left))))


def fill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits`` in turn."""
    place = lambda i: F.length(_digits(F.substring(form, F.lit(1), i)))
    own = lambda i: F.substring(form, i, F.lit(1))
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), lambda i: F.when(own(i).between("0", "9"), F.substring(digits, place(i), F.lit(1))).otherwise(own(i))), "")


def luhn(digits: Column) -> Column:
    """The sum whose last digit is 0 for a valid number."""
    n = F.length(digits)
    digit = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    value = lambda i: F.when(i % 2 == 0, digit(i)).when(digit(i) > 4, digit(i) * 2 - 9).otherwise(digit(i) * 2)
    return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), value), F.lit(0), lambda s, v: s + v)


def card(key: str, form: Column) -> Column:
    digits = _digits(form)
    inner = permute_digits(key, "card", F.substring(digits, F.lit(5), F.length(digits) - 5))
    body = F.concat(F.substring(digits, 1, 4), inner)
    return _let(body, lambda x: fill(form, F.concat(x, ((F.lit(10) - luhn(F.concat(x, F.lit("0"))) % 10) % 10).cast("string"))))


def is_card(form: Column) -> Column:
    digits = _digits(form)
    return digits.rlike(ISSUERS) & (luhn(digits) % 10 == 0)


def ip(key: str, form: Column) -> Column:
    octet = lambda i: F.split_part(form, F.lit("."), F.lit(i)).cast("long")
    both = feistel(key, "ip", octet(1) * 256 + octet(2), octet(3) * 256 + octet(4), F.lit(65536), F.lit(65536))
    return _let(both, lambda s: F.concat_ws(".", *((F.floor(s[c] / 256) if k else s[c] % 256).cast("string") for c in ("x", "y") for k in (1, 0))))


def _ssn_parts(form: Column) -> list[Column]:
    return [F.split_part(form, F.lit("-"), F.lit(i)).cast("long") for i in (1, 2, 3)]


def is_ssn(form: Column) -> Column:
    area, group, serial = _ssn_parts(form)
    return (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)


def ssn(key: str, form: Column) -> Column:
    area, group, serial = _ssn_parts(form)
    rank = area - F.when(area > 666, 2).otherwise(1)  # 898 areas: 1-665 and 667-899
    both = feistel(key, "ssn", rank * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999))
    back = lambda s: F.floor(s["x"] / 99) + F.when(F.floor(s["x"] / 99) >= 665, 2).otherwise(1)
    three, two, four = F.lit(3), F.lit(2), F.lit(4)
    return _let(both, lambda s: F.concat_ws("-", _pad(back(s), three), _pad(s["x"] % 99 + 1, two), _pad(s["y"] + 1, four)))


def _mod97(text: Column) -> Column:
    """The rest by 97 of letters and digits, A being 10."""
    value = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    return F.aggregate(F.split(text, ""), F.lit(0), lambda r, c: (F.when(value(c) > 9, r * 100).otherwise(r * 10) + value(c)) % 97)


def _iban_check(form: Column) -> Column:
    plain = F.replace(form, F.lit(" "), F.lit(""))
    return F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 2))


def is_iban(form: Column) -> Column:
    return _mod97(F.concat(_iban_check(form), F.substring(form, 3, 2))) == 1


def iban(key: str, form: Column) -> Column:
    rest = F.substring(form, F.lit(5), F.length(form))
    moved = fill(rest, permute_digits(key, "iban", _digits(rest)))
    return _let(moved, lambda x: F.concat(F.substring(form, 1, 2), _pad(F.lit(98) - _mod97(F.concat(_iban_check(F.concat(F.substring(form, 1, 4), x)), F.lit("00"))), F.lit(2)), x))


def is_phone(form: Column) -> Column:
    return F.length(_digits(form)).between(8, 15)


def phone(key: str, form: Column) -> Column:
    """Country code kept; of ten digits that may be North American, area and exchange codes that start with 2 to 9 stay so, and others stay others."""
    code = F.regexp_extract(form, r"^\+?(\d{1,3})(?=[ .-]?\()|^\+(\d{1,3})(?=[ .-])", 0)
    code = F.when((code == "") & form.startswith("+"), F.substring(form, 1, 3)).otherwise(code)  # +4915...: the first two digits
    own = _digits(F.substring(form, F.length(code) + 1, F.length(form)))
    ten = (F.length(own) == 10) & code.isin("", "+1", "1")
    american = F.substring(own, 1, 1).between("2", "9") & F.substring(own, 4, 1).between("2", "9")
    area, rest = F.substring(own, 1, 3).cast("long"), F.substring(own, 4, 7).cast("long")
    both = feistel(key, "phone", area - 200, rest - 2_000_000, F.lit(800), F.lit(8_000_000))
    # the others by rank: areas below 200 with any rest, then areas from 200 on with a rest below 2,000,000
    rank = F.when(area < 200, area * 10_000_000 + rest).otherwise(2_000_000_000 + (area - 200) * 2_000_000 + rest)
    place = lambda s: s["x"] * 60_000 + s["y"]
    later = lambda p: p - 2_000_000_000
    unranked = lambda p: F.when(p < 2_000_000_000, _pad(p, F.lit(10))).otherwise(F.concat((F.floor(later(p) / 2_000_000) + 200).cast("string"), _pad(later(p) % 2_000_000, F.lit(7))))
    other = _let(feistel(key, "phone-other", F.floor(rank / 60_000), rank % 60_000, F.lit(60_000), F.lit(60_000)), lambda s: _let(place(s), unranked))
    permuted = F.when(american, _let(both, lambda s: F.concat((s["x"] + 200).cast("string"), (s["y"] + 2_000_000).cast("string")))).otherwise(other)
    changed = F.when(ten, permuted).otherwise(permute_digits(key, "phone", own))
    return _let(changed, lambda d: F.concat(code, fill(F.substring(form, F.length(code) + 1, F.length(form)), d)))


def _date_of(form: Column) -> Column:
    """The date that a form stands for, or null."""
    at = lambda i, k: F.substring(form, i, k)
    made = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, m, d), "yyyy-MM-dd")
    first, second, year = at(1, 2), at(4, 2), at(7, 4)
    us, eu = made(year, first, second), made(year, second, first)
    return F.when(form.rlike(r"^\d{4}"), made(at(1, 4), at(6, 2), at(9, 2))).when(form.contains("/"), F.coalesce(us, eu)).otherwise(eu)


def is_date(form: Column) -> Column:
    return _date_of(form).isNotNull() & (F.regexp_extract(form, r"\d{4}", 0) >= "0100")


#: Days of a century that are the 13th of a month or later, but for one in centuries without a leap year at their start; two factors of it.
LATE_DAYS, LATE_X, LATE_Y = 22125, 125, 177


def _early(key: str, day: Column, century: Column) -> Column:
    """A day up to the 12th of a month of the same century: 120 * 120 of them."""
    at = ((F.year(day) % 100) * 12 + F.month(day) - 1) * 12 + F.day(day) - 1
    both = feistel(key, "date", F.floor(at / 120), at % 120, F.lit(120), F.lit(120))
    month = lambda n: F.floor(n / 12)
    return _let(_let(both, lambda s: s["x"] * 120 + s["y"]), lambda n: F.make_date((century * 100 + F.floor(month(n) / 12)).cast("int"), (month(n) % 12 + 1).cast("int"), (n % 12 + 1).cast("int")))


def _late(key: str, day: Column, first: Column) -> Column:
    """A day from the 13th of a month on, of the same century.

    They are numbered without the first twelve days of each month.  The one
    number too many, in most centuries, is permuted once more.
    """
    months = (F.year(day) - F.year(first)) * 12 + F.month(day)
    at = F.datediff(day, first) - 12 * months
    moved = lambda n: _let(feistel(key, "late date", F.floor(n / LATE_Y), n % LATE_Y, F.lit(LATE_X), F.lit(LATE_Y)), lambda s: s["x"] * LATE_Y + s["y"])
    held = LATE_DAYS - F.when(F.year(first) % 400 == 0, 0).otherwise(1)
    n = _let(moved(at), lambda n: F.when(n < held, n).otherwise(moved(n)))
    # the month of a number is the one its share of the century says, or a neighbour
    near = lambda n, k: F.floor(n * 1200 / held).cast("int") + k
    found = lambda n, k: _let(F.date_add(first, (n + 12 * near(n, k)).cast("int")), lambda d: F.when((F.day(d) > 12) & ((F.year(d) - F.year(first)) * 12 + F.month(d) == near(n, k)), d))
    return _let(n, lambda n: F.coalesce(*(found(n, k) for k in (0, 1, 2))))


def date(key: str, form: Column) -> Column:
    """A day of the same century in the same form.

    Days up to the 12th of a month and later ones are permuted apart.  So a day
    that can only be read day first stays one, whatever form it is written in,
    and no two dates become the same string.
    """

    def moved(day: Column) -> Column:
        century = F.floor(F.year(day) / 100).cast("int")
        first = F.make_date(century * 100, F.lit(1), F.lit(1))
        return F.when(F.day(day) <= 12, _early(key, day, century)).otherwise(_late(key, day, first))

    def written(day: Column) -> Column:
        y, m, d = _pad(F.year(day), F.lit(4)), _pad(F.month(day), F.lit(2)), _pad(F.day(day), F.lit(2))
        month_first = form.contains("/") & (F.substring(form, 1, 2) <= "12")
        return fill(form, F.when(form.rlike(r"^\d{4}"), F.concat(y, m, d)).when(month_first, F.concat(m, d, y)).otherwise(F.concat(d, m, y)))

    return _let(_let(_date_of(form), moved), written)


def email(key: str, form: Column) -> Column:
    local = F.substring_index(form, "@", 1)
    half = F.floor(F.length(local) / 2).cast("int")
    start = F.struct(F.substring(local, F.lit(1), half).alias("x"), F.substring(local, half + 1, F.length(local)).alias("y"))

    def moved(part: Column, by: Column) -> Column:
        letter = lambda i: F.substring(part, i, F.lit(1))
        step = lambda i: F.conv(F.substring(by, ((i - 1) * 2) % 64 + 1, F.lit(2)), 16, 10).cast("int")

        def one(i: Column) -> Column:
            out = letter(i)
            for alphabet in ALPHABETS:
                place = F.instr(F.lit(alphabet), letter(i))
                out = F.when(place > 0, F.substring(F.lit(alphabet), (place - 1 + step(i)) % len(alphabet) + 1, F.lit(1))).otherwise(out)
            return out

        return F.when(F.length(part) == 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.length(part)), one), ""))

    def turn(s: Column, i: Column) -> Column:
        draw = lambda c: F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), i.cast("string"), c), 256)
        even = i % 2 == 0
        return F.struct(F.when(even, moved(s["x"], draw(s["y"]))).otherwise(s["x"]).alias("x"), F.when(even, s["y"]).otherwise(moved(s["y"], draw(s["x"]))).alias("y"))

    both = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return _let(both, lambda s: F.concat(s["x"], s["y"], F.substring(form, F.length(local) + 1, F.length(form))))


def kind_of(form: Column) -> Column:
    """The kind that a candidate is a valid value of, or null."""
    kinds = (
        ("email", form.contains("@"), None),
        ("ip", form.rlike(rf"^{_IP}$"), None),
        ("date", form.rlike(rf"^(?:{_DATE})$"), is_date),
        ("ssn", form.rlike(rf"^{_SSN}$"), is_ssn),
        ("iban", form.rlike("^[A-Z]"), is_iban),
        ("card", form.rlike(rf"^(?:{_CARD})$"), is_card),
        ("phone", form.rlike(rf"^(?:{_PHONE})$"), is_phone),
    )
    out = F.lit(None).cast("string")
    for kind, has_form, valid in reversed(kinds):
        out = F.when(has_form, F.when(valid(form), kind) if valid else F.lit(kind)).otherwise(out)
    return out


def pseudonym(key: str, kind: Column, form: Column) -> Column:
    """The pseudonym of a valid value; any other string stays."""
    made = {"email": email, "ip": ip, "date": date, "ssn": ssn, "iban": iban, "card": card, "phone": phone}
    out = form
    for name, make in made.items():
        out = F.when(kind == name, make(key, form)).otherwise(out)
    return out


def pseudonymise(df: DataFrame, key: str, text: str = "text", to: str | None = None) -> DataFrame:
    """``df`` with the pseudonymised text in ``to`` (by default in place) and ``n_<kind>`` counts.

    ``key`` is a secret; the same key links values across runs.
    """
    counts = [f"n_{kind}" for kind in KINDS]
    own = [c for c in df.columns if c not in counts]
    rows = df.select(*own, F.when(F.col(text).rlike(HINT), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))).alias("__candidates"))
    found = F.transform("__candidates", lambda m: _let(kind_of(m), lambda kind: F.struct(kind.alias("kind"), pseudonym(key, kind, m).alias("made"))))
    rows = rows.withColumn("__found", F.when(F.size("__candidates") > 0, found))
    between = F.split(F.col(text), CANDIDATE, -1)
    joined = F.array_join(F.zip_with(between, "__found", lambda b, f: F.concat(F.coalesce(b, F.lit("")), F.coalesce(f["made"], F.lit("")))), "")
    rows = rows.withColumn(to or text, F.when(F.col("__found").isNotNull(), joined).otherwise(F.col(text)))
    tally = [F.coalesce(F.size(F.filter("__found", lambda f: f["kind"] == kind)), F.lit(0)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return rows.select(*own, *([to] if to and to not in own else []), *tally)
