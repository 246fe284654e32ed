"""Format-preserving pseudonyms for validated numbers and dates.

Values are found by one pattern and validated: card numbers by their check digit, addresses by their range, dates by the
calendar, phone, social security and account numbers by their form. A valid value becomes a list of numbers with
radices; a Feistel network, keyed and unbalanced, adds digests of one half to the other half within the radices. So a
value stays one of its own format, equal values get equal pseudonyms in every document, and the key undoes it. All of it
is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rounds of the network.
ROUNDS = 10
#: What may be a value, in the order in which it is tried: mail address, IPv4 address, dates, phone numbers, social
#: security number, account number, card number.
PARTS = {
    "mail": r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "address": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![.]?[0-9A-Za-z])",
    "iso": r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?![-0-9A-Za-z])",
    "dotted": r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9A-Za-z])",
    "slashed": r"[0-9]{2}/[0-9]{2}/[0-9]{4}(?![/0-9A-Za-z])",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}(?![-0-9A-Za-z])",
    "social": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![-0-9A-Za-z])",
    "account": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}(?![-]?[0-9A-Za-z])",
}
PATTERN = r"(?<![0-9A-Za-z._%+-])(?:" + "|".join(PARTS.values()) + r")|(?<![0-9A-Za-z])(?:" + "|".join([PARTS["phone"], PARTS["card"]]) + ")"
#: Days of 400 years as a product: the domain of a date is its block of 400 years from 1600 on.
DAY_RADICES = (189, 773)
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value made once."""
    return F.transform(F.array(value), use)[0]


def _pair(value: Column, radix: Column) -> Column:
    return F.struct(value.cast("int").alias("v"), radix.cast("int").alias("r"))


def permute(values: Column, key: str, kind: str, sign: int = 1) -> Column:
    """The keyed permutation of an array of (v, r), 0 <= v < r, or with ``sign`` -1 its inverse.

    Even and odd places are the halves; a round adds a digest of one half, the round and the place to each of the other.
    """
    rounds = range(ROUNDS) if sign > 0 else reversed(range(ROUNDS))

    def step(state: Column, number: Column) -> Column:
        fixed = F.filter(state, lambda _, i: i % 2 == number % 2)
        text = F.array_join(F.transform(fixed, lambda x: x["v"].cast("string")), ",")

        def moved(text: Column) -> Column:
            def one(x: Column, i: Column) -> Column:
                digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.size(state).cast("string"), number.cast("string"), i.cast("string"), text), 256)
                drawn = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")
                return F.when(i % 2 == number % 2, x).otherwise(_pair(F.pmod(x["v"] + F.lit(sign) * drawn, x["r"].cast("long")), x["r"]))

            return F.transform(state, one)

        return _with(text, moved)

    return F.aggregate(F.array(*map(F.lit, rounds)), values, step)


def _numbers(digits: Column) -> Column:
    """Characters as (v, r): digits by 10, letters by 26; others are left out."""
    chars = F.filter(F.split(digits, ""), lambda c: F.rlike(c, F.lit("[0-9A-Za-z]")))
    return F.transform(chars, lambda c: F.when(F.rlike(c, F.lit("[0-9]")), _pair(c.try_cast("int"), F.lit(10))).otherwise(_pair(F.instr(F.lit(_LETTERS), F.lower(c)) - 1, F.lit(26))))


def _into(form: Column, numbers: Column) -> Column:
    """``form`` with its letters and digits replaced by ``numbers``, one each, in the same case."""
    chars = F.split(form, "")
    used = F.transform(F.sequence(F.lit(1), F.size(chars)), lambda n: F.length(F.regexp_replace(F.substring(form, F.lit(1), n), "[^0-9A-Za-z]", "")))

    def one(c: Column, i: Column) -> Column:
        x = F.element_at(numbers, F.element_at(used, i + 1))["v"]
        letter = F.substring(F.lit(_LETTERS), x + 1, F.lit(1))
        return F.when(F.rlike(c, F.lit("[0-9]")), x.cast("string")).when(F.rlike(c, F.lit("[a-z]")), letter).when(F.rlike(c, F.lit("[A-Z]")), F.upper(letter)).otherwise(c)

    return F.when(F.length(form) == 0, form).otherwise(F.array_join(F.transform(chars, one), ""))


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of the digits of a text, those at every second place from the right, from ``doubled``, doubled."""
    chars = F.split(F.reverse(digits), "")
    weigh = lambda c, i: F.when(i % 2 == doubled, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))
    return F.aggregate(F.transform(chars, weigh), F.lit(0), lambda a, x: a + x)


def _mod97(text: Column) -> Column:
    """A text of digits and capitals (10 to 35), as a number, modulo 97."""
    number = lambda c: F.when(F.rlike(c, F.lit("[0-9]")), c.try_cast("int")).otherwise(F.instr(F.lit(_LETTERS.upper()), c) + 9)
    return F.aggregate(F.transform(F.split(text, ""), number), F.lit(0), lambda a, x: (F.when(x > 9, a * 100 + x).otherwise(a * 10 + x) % 97).cast("int"))


def _date(day: Column, month: Column, year: Column) -> Column:
    date = F.try_to_timestamp(F.concat_ws("-", year, month, day), F.lit("yyyy-MM-dd")).cast("date")
    return F.when(F.year(date).between(1600, 2399), date)


def _moved_date(date: Column, key: str, sign: int) -> Column:
    start = F.when(F.year(date) >= 2000, F.lit("2000-01-01").cast("date")).otherwise(F.lit("1600-01-01").cast("date"))
    left, right = DAY_RADICES
    day = F.datediff(date, start)
    halves = F.array(_pair(F.floor(day / right), F.lit(left)), _pair(day % right, F.lit(right)))
    return _with(permute(halves, key, "date", sign), lambda h: F.date_add(start, h[0]["v"] * right + h[1]["v"]))


def pseudonym(value: Column, key: str, sign: int = 1) -> Column:
    """The pseudonym of one found value, or null where it is not valid. With ``sign`` -1, the value of a pseudonym."""
    is_a = {kind: F.rlike(value, F.lit(f"^(?:{pattern})$")) for kind, pattern in PARTS.items()}
    digits = F.regexp_replace(value, "[^0-9]", "")
    plain = _with(permute(_numbers(value), key, "number", sign), lambda n: _into(value, n))

    at = F.instr(value, "@")
    local = F.substring(value, F.lit(1), at - 1)
    mail = F.concat(_with(permute(_numbers(local), key, "mail", sign), lambda n: _into(local, n)), F.substring(value, at, F.length(value)))

    octets = F.transform(F.split(value, r"\."), lambda c: c.try_cast("int"))
    in_range = ~F.exists(octets, lambda x: x.isNull() | (x > 255)) & ~F.rlike(value, F.lit(r"(^|\.)0[0-9]"))
    address = _with(permute(F.transform(octets, lambda x: _pair(x, F.lit(256))), key, "address", sign), lambda n: F.array_join(F.transform(n, lambda x: x["v"].cast("string")), "."))

    part = lambda start, length: F.substring(value, start, length)
    dates = {
        "iso": (_date(part(9, 2), part(6, 2), part(1, 4)), "yyyy-MM-dd"),
        "dotted": (_date(part(1, 2), part(4, 2), part(7, 4)), "dd.MM.yyyy"),
        "slashed": (_date(part(4, 2), part(1, 2), part(7, 4)), "MM/dd/yyyy"),
    }
    # the last digit of a card follows from the others
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)

    def card_of(n: Column) -> Column:
        new = F.array_join(F.transform(n, lambda x: x["v"].cast("string")), "")
        check = F.pmod(-luhn_sum(new, 0), F.lit(10)).cast("string")
        return _into(value, _numbers(F.concat(new, check)))

    card = F.when(luhn_sum(digits, 1) % 10 == 0, _with(permute(_numbers(body), key, "card", sign), card_of))
    # an account keeps its country; its check number follows from the rest
    packed = F.regexp_replace(value, " ", "")
    rest = F.substring(packed, F.lit(5), F.length(packed))
    country = F.substring(packed, 1, 2)

    def account_of(n: Column) -> Column:
        new = _into(rest, n)
        check = F.lpad((F.lit(98) - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        return _account_form(value, F.concat(country, check, new))

    valid = _mod97(F.concat(rest, country, F.substring(packed, 3, 2))) == 1
    account = F.when(valid, _with(permute(_numbers(rest), key, "account", sign), account_of))

    out = F.when(is_a["mail"], mail).when(is_a["address"], F.when(in_range, address))
    for kind, (date, form) in dates.items():
        out = out.when(is_a[kind], F.when(date.isNotNull(), F.date_format(_moved_date(date, key, sign), form)))
    phone = F.when(F.length(digits) >= 10, plain)
    return out.when(is_a["social"], plain).when(is_a["phone"], phone).when(is_a["account"], account).when(is_a["card"], card)


def _account_form(form: Column, packed: Column) -> Column:
    """``packed`` with the blanks of ``form``."""
    chars = F.split(form, "")
    used = lambda i: F.length(F.regexp_replace(F.substring(form, F.lit(1), i + 1), " ", ""))
    return F.array_join(F.transform(chars, lambda c, i: F.when(c == " ", c).otherwise(F.substring(packed, used(i), F.lit(1)))), "")


def _texts(docs: DataFrame, key: str, sign: int) -> tuple[Column, Column]:
    """The text with its values replaced, and how many were."""
    text = docs["text"].cast("string")
    found = F.when(F.rlike(text, F.lit(PATTERN)), F.transform(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), lambda m: F.struct(m.alias("m"), pseudonym(m, key, sign).alias("p"))))
    new = _with(
        F.struct(F.split(text, PATTERN, -1).alias("gaps"), found.alias("found")),
        lambda x: F.concat(x["gaps"][0], F.array_join(F.transform(x["found"], lambda f, i: F.concat(F.coalesce(f["p"], f["m"]), F.element_at(x["gaps"], i + 2))), "")),
    )
    done = _with(found, lambda f: F.struct(F.size(F.filter(f, lambda x: x["p"].isNotNull())).alias("n"), f.alias("found")))
    return F.when(found.isNotNull(), new).otherwise(text), F.coalesce(done["n"], F.lit(0)).cast("long")


def pseudonymise(docs: DataFrame, key: str, sign: int = 1) -> DataFrame:
    """doc_id, n_replaced, text for each row, with valid values replaced by their pseudonyms.

    What is found but not valid stays, and so does all other text. A null text stays null; repeated rows and other
    columns do not matter (these are left out); an empty table gives no rows. A text is read whole, however long. With
    ``sign`` -1 the same key gives the values back.
    """
    text, n = _texts(docs, key, sign)
    return docs.select("doc_id", n.alias("n_replaced"), text.alias("text"))
