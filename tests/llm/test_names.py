"""Columns of the caller that are called like an operator's own, and pseudonyms against plain Python."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tallyboard.llm import lines, mixing, near, pseudonyms, repetition

NAMES = [
    "row", "tokens", "rest", "passes", "until", "block", "mix_source", "copies", "last_order", "quota", "weight", "begin",
    "pii_found", "pii_between", "pii_new", "keep_id", "keep_text", "keep_one", "text_key", "text_as_bytes", "text_as_bytes_",
    "gone", "gone_lines", "document", "lines", "node", "label", "high", "low", "first", "a.b", "c`d", "doc id",
]
TEXT = "call 212-555-0147 or mail a@b.org, " + " ".join(f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz")

OPERATORS = {
    "mixing": lambda d: mixing.mixed_sources(d),
    "pseudonyms": lambda d: pseudonyms.pseudonymised(d, "key"),
    "near": near.without_near_duplicates,
    "repetition": repetition.without_repetitive,
    "lines": lines.without_repeated_lines,
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_names_that_operators_use_themselves(spark, name):
    quoted = ", ".join(f"`{n.replace('`', '``')}` string" for n in NAMES)
    rows = [(k, f"{TEXT} {k}", "s", *(f"{n}{k}" for n in NAMES)) for k in range(3)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, source string, {quoted}")
    found = OPERATORS[name](docs)
    assert found.columns[: len(docs.columns)] == docs.columns
    got = found.collect()
    assert got
    for r in got:
        values = r.asDict()
        assert [values[n] for n in NAMES] == [f"{n}{values['doc_id']}" for n in NAMES]
    if name == "pseudonyms":  # what was found is in no column
        assert "212-555-0147" not in str(got) and "a@b.org" not in str(got)


def number(*parts):
    return int(hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()[:14], 16)


def feistel(digits, key, kind):
    half = len(digits) // 2
    left, right = digits[:half], digits[half:]
    for step in range(1, pseudonyms.ROUNDS + 1):
        size = 10 ** len(left)
        total = (int(left) + number(key, kind, len(digits), step, right) % size) % size
        left, right = right, str(total).zfill(len(left))
    return left + right


def walked(value, key, kind, valid):
    value = feistel(value, key, kind)
    while not valid(value):
        value = feistel(value, key, kind)
    return value


def plain(kind, text, key):
    digits = "".join(c for c in text if c.isdigit())
    if kind == "ip":
        a, b, c, d = map(int, text.split("."))
        left, right = a * 256 + b, c * 256 + d
        for step in range(1, pseudonyms.ROUNDS + 1):
            left, right = right, (left + number(key, kind, "bits", step, right) % 65536) % 65536
        return f"{left >> 8}.{left & 255}.{right >> 8}.{right & 255}"
    if kind == "date":
        first = dt.date.fromisoformat(pseudonyms.FIRST_DAY)
        day = (dt.date.fromisoformat(text) - first).days
        moved = walked(str(day).zfill(5), key, kind, lambda x: int(x) < pseudonyms.DAYS)
        return str(first + dt.timedelta(days=int(moved)))
    if kind == "card":
        payload = feistel(digits[:-1], key, kind)
        total = sum(sum(divmod(int(c) * 2, 10)) if k % 2 == 0 else int(c) for k, c in enumerate(reversed(payload)))
        new = payload + str(-total % 10)
    elif kind == "ssn":
        new = walked(digits, key, kind, lambda d: d[:3] not in ("000", "666") and d[:3] < "900" and d[3:5] != "00" and d[5:] != "0000")
    else:
        new = feistel(digits, key, kind)
    left = iter(new)
    return "".join(next(left) if c.isdigit() else c for c in text)


VALUES = {
    "ip": ["0.0.0.0", "255.255.255.255", "10.0.0.1", "192.168.1.77"],
    "date": ["1900-01-01", "2099-12-31", "2024-02-29", "1987-06-05"],
    "card": ["4111 1111 1111 1111", "5500000000000004", "378282246310005"],
    "ssn": ["123-45-6789", "078-05-1120", "899-99-9999"],
    "phone": ["(212) 555-0147", "212-555-0147"],
}


@pytest.mark.parametrize("kind", list(VALUES))
def test_pseudonyms_against_plain_python(docs, kind):
    rows = [(k, f"x {v} y") for k, v in enumerate(VALUES[kind])]
    got = {r.doc_id: r.text for r in pseudonyms.pseudonymised(docs(rows), "secret").collect()}
    assert got == {k: f"x {plain(kind, v, 'secret')} y" for k, v in enumerate(VALUES[kind])}


def test_addresses_are_permuted_in_their_own_bits(spark):
    table = spark.range(4000).select((F.col("id") * 1_073_741).alias("n"))
    moved = [r.m for r in table.select(pseudonyms.feistel_32(F.col("n") % (1 << 32), "k", "ip").alias("m")).collect()]
    assert len(set(moved)) == 4000 and all(0 <= m < 1 << 32 for m in moved)


@pytest.mark.parametrize("master, refused", [("local[4]", False), ("local", False), ("spark://host:7077", True), ("local-cluster[3,2,1024]", True)])
def test_a_cluster_needs_a_shared_folder(master, refused):
    """Without spark.checkpoint.dir only a local session has a folder that all its tasks see."""
    from types import SimpleNamespace

    from tallyboard.llm.common import shared_folder

    session = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master, applicationId=f"test {master}"))
    if refused:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session)
    else:
        assert shared_folder(session).startswith("file:///")
