"""Format-preserving pseudonyms for personal data, in column expressions alone.

Numbers and dates are found by pattern and validated: payment cards by their
check digit, IBANs by their remainder, addresses of four octets and social
security numbers by their parts, dates by the calendar; telephone numbers have
no rule, ten digits written (123) 456-7890 or 123-456-7890 are one, other layouts
and cards in groups other than four are not found. A valid value is
replaced by a keyed permutation of all values of its format, a Feistel network
on its digits, so equal values stay equal in all documents and different ones
different; check digits are computed anew, and a value that would leave the
format is permuted again. Mail addresses and, with `secrets`, access keys and
passwords are no numbers: they get a keyed digest in their own format.

Null texts stay null, empty texts empty; text without a finding is unchanged to
the byte. Null ids and repeated rows are treated like any other row. No
documents give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed_row, unpacked

ROUNDS = 8
#: Attempts to stay inside a format. Dates and social security numbers fill at least 73% of the digits they are
#: permuted in, so that one value in 10^22 would need more; addresses are permuted in their own 32 bits.
WALKS = 40
FIRST_DAY, DAYS = "1900-01-01", 73049  # to 2099-12-31

PATTERNS = {
    "mail": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])(?!\.[0-9])",
    "phone": r"(?<![0-9])(?:\+[0-9]{1,3} )?(?:\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9\-])",
    "ssn": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "date": r"(?<![0-9\-/.])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9\-/])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3})(?![0-9])",
}
SECRETS = {
    "key": r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "token": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})(?![A-Za-z0-9])",
    "password": r"(?<=password=)[^\s\"']{4,}",
}


def _number(text: Column) -> Column:
    """A non-negative long from a text that is hashed."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 14), 16, 10).cast("long")


def feistel(digits: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the decimal strings of each length from 2 to 30."""
    half = F.length(digits).cast("int")
    half = F.floor(half / 2).cast("int")

    def turn(state: Column, step: Column) -> Column:
        left, right = state["left"], state["right"]
        size = F.pow(F.lit(10), F.length(left)).cast("decimal(20,0)").cast("long")
        seed = F.concat_ws("|", F.lit(key), F.lit(kind), F.length(digits).cast("string"), step.cast("string"), right)
        total = (left.cast("long") + _number(seed) % size) % size
        return F.struct(right.alias("left"), F.lpad(total.cast("string"), F.length(left), F.lit("0")).alias("right"))

    first = F.struct(digits.substr(F.lit(1), half).alias("left"), digits.substr(half + 1, F.length(digits)).alias("right"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, turn, lambda s: F.concat(s["left"], s["right"]))


def feistel_32(number: Column, key: str, kind: str) -> Column:
    """A keyed permutation of the numbers of 32 bits."""

    def turn(state: Column, step: Column) -> Column:
        left, right = state["left"], state["right"]
        seed = F.concat_ws("|", F.lit(key), F.lit(kind), F.lit("bits"), step.cast("string"), right.cast("string"))
        return F.struct(right.alias("left"), ((left + _number(seed) % 65536) % 65536).alias("right"))

    first = F.struct(F.shiftright(number, 16).alias("left"), (number % 65536).alias("right"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, turn, lambda s: s["left"] * 65536 + s["right"])


def walked(value: Column, key: str, kind: str, valid: Callable[[Column], Column]) -> Column:
    """The permutation applied until its result is valid again."""
    first = F.struct(value.alias("value"), F.lit(False).alias("done"))

    def step(state: Column, _: Column) -> Column:
        following = F.struct(feistel(state["value"], key, kind).alias("value"))
        moved = F.transform(F.array(following), lambda x: F.struct(x["value"].alias("value"), valid(x["value"]).alias("done")))
        return F.when(state["done"], state).otherwise(moved[0])

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), first, step, lambda s: s["value"])


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def laid_out(template: Column, digits: Column) -> Column:
    """The template with its digits replaced in order."""

    def put(state: Column, char: Column) -> Column:
        digit = char.rlike("^[0-9]$")
        return F.struct(
            F.concat(state["out"], F.when(digit, digits.substr(state["at"], F.lit(1))).otherwise(char)).alias("out"),
            (state["at"] + F.when(digit, 1).otherwise(0)).alias("at"),
        )

    first = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(F.split(template, ""), first, put, lambda s: s["out"])


def luhn_sum(payload: Column) -> Column:
    """The weighted digit sum of a number without its check digit."""

    def add(total: Column, at: Column) -> Column:
        digit = payload.substr(F.length(payload) - at, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(at % 2 == 0, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(payload) - 1), F.lit(0), add)


def check_digit(payload: Column) -> Column:
    return ((10 - luhn_sum(payload) % 10) % 10).cast("string")


def _payload(digits: Column) -> Column:
    return digits.substr(F.lit(1), F.length(digits) - 1)


def remainder_97(text: Column) -> Column:
    """The remainder of an IBAN-like text, letters counting from A = 10, rotated by four."""
    rotated = F.concat(text.substr(F.lit(5), F.length(text)), text.substr(1, 4))

    def add(rest: Column, char: Column) -> Column:
        letter = char.rlike("^[A-Z]$")
        return F.when(letter, (rest * 100 + F.ascii(char) - 55) % 97).when(char == "", rest).otherwise((rest * 10 + char.cast("int")) % 97)

    return F.aggregate(F.split(rotated, ""), F.lit(0), add)


def valid_ip(text: Column) -> Column:
    return F.forall(F.split(text, r"\."), lambda x: (x.cast("int") <= 255) & ~x.rlike("^0[0-9]"))


def valid_ssn(digits: Column) -> Column:
    area = digits.substr(1, 3)
    return ~area.isin("000", "666") & (area < "900") & (digits.substr(4, 2) != "00") & (digits.substr(6, 4) != "0000")


def iso_date(text: Column) -> Column:
    """yyyy-mm-dd of any of the three date formats."""
    return F.when(text.rlike("^[0-9]{4}-"), text).otherwise(
        F.concat_ws("-", text.substr(7, 4), text.substr(4, 2), text.substr(1, 2))
    )


def day_number(text: Column) -> Column:
    """Days since the first one; null if the text is no date of the calendar."""
    return F.datediff(F.try_to_date(iso_date(text), "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))


def validity(kind: str, text: Column) -> Column:
    digits = digits_of(text)
    rules = {
        "card": lambda: (F.length(digits) >= 13) & (check_digit(_payload(digits)) == digits.substr(F.length(digits), F.lit(1))),
        "iban": lambda: remainder_97(text) == 1,
        "ip": lambda: valid_ip(text),
        "ssn": lambda: valid_ssn(digits),
        "date": lambda: F.coalesce(day_number(text).between(0, DAYS - 1), F.lit(False)),
    }
    return rules[kind]() if kind in rules else F.lit(True)


def pseudonym(kind: str, text: Column, key: str) -> Column:
    digits = digits_of(text)
    digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), text), 256)
    if kind == "card":
        moved = feistel(_payload(digits), key, kind)
        return laid_out(text, F.transform(F.array(moved), lambda x: F.concat(x, check_digit(x)))[0])
    if kind == "iban":
        body = text.substr(F.lit(5), F.length(text))
        inner = digits_of(body)
        moved = F.when(F.length(inner) >= 2, laid_out(body, feistel(inner, key, kind))).otherwise(body)
        blank = F.transform(F.array(moved), lambda x: F.struct(x.alias("b"), F.concat(text.substr(1, 2), F.lit("00"), x).alias("t")))
        return F.transform(
            blank, lambda x: F.concat(text.substr(1, 2), F.lpad((98 - remainder_97(x["t"])).cast("string"), 2, "0"), x["b"])
        )[0]
    if kind == "ip":
        octets = F.split(text, r"\.")
        number = octets[0].cast("long") * 16777216 + octets[1].cast("long") * 65536 + octets[2].cast("long") * 256 + octets[3].cast("long")
        moved = feistel_32(number, key, kind)
        parts = lambda x: [F.floor(x / d).cast("long") % 256 for d in (16777216, 65536, 256, 1)]
        return F.transform(F.array(moved), lambda x: F.concat_ws(".", *(p.cast("string") for p in parts(x))))[0]
    if kind == "phone":
        # A country code stays; the ten digits of the number are permuted.
        head = F.regexp_extract(text, r"^(\+[0-9]{1,3} )?", 0)
        rest = text.substr(F.length(head) + 1, F.length(text))
        return F.concat(head, laid_out(rest, feistel(digits_of(rest), key, kind)))
    if kind == "ssn":
        return laid_out(text, walked(digits, key, kind, valid_ssn))
    if kind == "date":
        moved = walked(F.lpad(day_number(text).cast("string"), 5, "0"), key, kind, lambda x: x.cast("int") < DAYS)
        day = F.date_add(F.lit(FIRST_DAY).cast("date"), moved.cast("int"))
        return (
            F.when(text.rlike("^[0-9]{4}-"), F.date_format(day, "yyyy-MM-dd"))
            .when(text.contains("/"), F.date_format(day, "dd/MM/yyyy"))
            .otherwise(F.date_format(day, "dd.MM.yyyy"))
        )
    if kind == "mail":
        domain = F.substring_index(text, "@", -1)
        hidden = F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.lower(domain)), 256)
        whole = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lower(text)), 256)
        return F.concat(F.substring(whole, 1, 16), F.lit("@"), F.substring(hidden, 1, 10), F.lit(".example"))
    if kind == "key":
        return F.concat(F.lit("AKIA"), F.upper(F.substring(digest, 1, 16)))
    if kind == "token":
        return digest.substr(F.lit(1), F.length(text))
    return F.substring(digest, 1, 12)  # a password


def pseudonymised(docs: DataFrame, key: str, column: str = "text", secrets: bool = True) -> DataFrame:
    """`docs` with the text replaced and pii_counts, a map from kind to the number of values replaced.

    `key` selects the permutations; keep it apart from the result. Further
    columns of the caller pass whatever they are called, none shows a finding; a
    column called pii_counts is replaced. A text may be as long as memory holds.
    """
    patterns = PATTERNS | (SECRETS if secrets else {})
    anything = "|".join(f"(?:{x})" for x in patterns.values())
    text = F.col("row").getField(column)
    likely = text.rlike(r"[0-9@]|password=")
    found = docs.select(packed_row(docs)).withColumns(
        {
            "pii_found": F.when(likely, F.regexp_extract_all(text, F.lit(anything), F.lit(0))),
            "pii_between": F.when(likely, F.split(text, anything, -1)),
        }
    )

    def replaced(value: Column) -> Column:
        chain = None
        for kind, pattern in patterns.items():
            here = _whole(kind, pattern, value)
            done = F.when(
                F.coalesce(validity(kind, value), F.lit(False)),
                F.struct(F.lit(kind).alias("kind"), pseudonym(kind, value, key).alias("value")),
            ).otherwise(F.struct(F.lit("").alias("kind"), value.alias("value")))
            chain = F.when(here, done) if chain is None else chain.when(here, done)
        return chain.otherwise(F.struct(F.lit("").alias("kind"), value.alias("value")))

    new = found.withColumn("pii_new", F.transform("pii_found", replaced))
    joined = F.array_join(
        F.flatten(F.zip_with("pii_between", "pii_new", lambda a, b: F.array(a, F.coalesce(b["value"], F.lit(""))))), ""
    )

    def count(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("pii_new", lambda x: x["kind"] == kind)), F.lit(0)).cast("long")

    counts = F.create_map(*(x for kind in patterns for x in (F.lit(kind), F.when(likely, count(kind)).otherwise(F.lit(0).cast("long")))))
    names = [x for x in docs.columns if x != "pii_counts"]
    kept = [F.coalesce(joined, text).alias(x) if x == column else c for x, c in zip(names, unpacked(names))]
    return new.select(*kept, counts.alias("pii_counts"))


def _whole(kind: str, pattern: str, value: Column) -> Column:
    """Whether a finding is of the kind; what stood around it is not there any more."""
    if kind == "password":
        return F.lit(True)  # the last one
    return value.rlike(f"^(?:{pattern})$")
