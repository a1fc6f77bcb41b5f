"""Archives: exact round trips, revisits, and what is salvaged of damaged files."""

import gzip
import random

import pytest

from tallyboard.llm import archives

PAGES = "page_id long, url string, html string"


def payload(n):
    return f"<p>page {n} " + "é\r\n\r\nWARC/ " * (n % 7) + "</p>"


def written(spark, tmp_path, rows, schema=PAGES, **options):
    path = str(tmp_path / "archives")
    archives.write_archives(spark.createDataFrame(rows, schema).coalesce(2), path, **options)
    return path


def files(path):
    import pathlib

    return sorted(p for p in pathlib.Path(path).iterdir() if p.name.startswith("part-"))


@pytest.mark.parametrize("compress", [True, False])
def test_round_trip(spark, tmp_path, compress):
    rows = [(n, f"http://e.example/{n}", payload(n)) for n in range(60)]
    path = written(spark, tmp_path, rows, compress=compress)
    data = b"".join(p.read_bytes() for p in files(path))
    plain = gzip.decompress(data) if compress else data  # a reader of its own
    assert plain.count(b"WARC-Type: response\r\n") + plain.count(b"WARC-Type: revisit\r\n") == 60
    found = archives.read_archives(spark, path)
    assert archives.quarantined(found).count() == 0
    got = {r.record_id: r for r in archives.records(found).collect()}
    for n, url, html in rows:
        first = next(m for m, _, h in rows if h == html)
        r = got[f"<urn:page:{n}>"]
        assert (r.target_uri, r.payload_bytes) == (url, len(html.encode()))
        assert r.payload_digest == archives.base32_sha1(html.encode())
        assert r.record_type == ("response" if first == n else "revisit")
        assert r.refers_to == (None if first == n else f"<urn:page:{first}>")
        assert r.payload == (html.encode() if first == n else None)


def test_odd_pages(spark, tmp_path):
    rows = [
        (7, None, None, "a", 1), (3, "u", "", "b", 2), (3, "u", "", "b", 2), (9, "a\r\nb", "x", None, None),
        (None, "u", "x", "c", 3), (None, None, None, None, None), (-4, "u", "x", "d", 4),
    ]
    path = written(spark, tmp_path, rows, PAGES + ", digest string, first int")
    got = archives.records(archives.read_archives(spark, path))
    got = got.select(archives.page_of("record_id").alias("p"), "target_uri", "payload_bytes", "record_type", archives.page_of("refers_to").alias("r"))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [
        (7, None, 0, "revisit", 3), (3, "u", 0, "response", None), (3, "u", 0, "response", None), (9, "a b", 1, "revisit", -4),
        (None, "u", 1, "response", None), (None, None, 0, "response", None), (-4, "u", 1, "response", None),
    ]))


def test_small_payloads_need_not_be_revisits(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    found = archives.records(archives.read_archives(spark, written(spark, tmp_path, rows, least_bytes=3)))
    kinds = {r.p: r.record_type for r in found.select(archives.page_of("record_id").alias("p"), "record_type").collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_no_pages(spark, tmp_path):
    path = written(spark, tmp_path, [])
    assert archives.read_archives(spark, path).collect() == []


def test_a_very_long_payload(spark, tmp_path):
    html = "".join(random.Random(1).choices("abc<>\n", k=17_000_000))
    path = written(spark, tmp_path, [(1, "u", html), (2, "u", "after")])
    got = {r.payload_bytes: r.payload for r in archives.records(archives.read_archives(spark, path)).collect()}
    assert got == {17_000_000: html.encode(), 5: b"after"}


def members(count, compress):
    made = [archives.record(n, f"http://e.example/{n}", payload(n).encode(), None) for n in range(count)]
    return [archives.member(m) if compress else m for m in made]


def told(data):
    found = list(archives.salvaged(data))
    assert sum(size for _, size, _, _ in found) == len(data)  # records and gaps cover every byte, in order
    assert [at for at, *_ in found] == [sum(f[1] for f in found[:k]) for k in range(len(found))]
    return [(f"<{row[0][10:-1]}>" if row else reason) for _, _, reason, row in found], [(a, n) for a, n, r, _ in found if r]


@pytest.mark.parametrize("compress", [True, False])
def test_later_records_are_salvaged(compress):
    parts = members(8, compress)
    bounds = [sum(map(len, parts[:k])) for k in range(9)]
    whole = b"".join(parts)
    assert told(whole) == ([f"<{n}>" for n in range(8)], [])
    for hurt in range(8):
        # a member's CRC covers all of it; a plain record's headers are only read
        own = parts[hurt]
        for place in (0, len(own) // 2, len(own) - 3) if compress else (0, own.index(b"Content-Length") + 16, own.rindex(b"page"), len(own) - 3):
            data = bytearray(whole)
            data[bounds[hurt] + place] ^= 0x41
            names, gaps = told(bytes(data))
            assert [n for n in names if n[0] == "<"] == [f"<{n}>" for n in range(8) if n != hurt]
            assert gaps == [(bounds[hurt], len(own))]


@pytest.mark.parametrize("compress", [True, False])
def test_garbage_between_and_truncation(compress):
    parts = members(4, compress)
    junk = b"\x1f\x8b\x08junk WARC/1.1\r\nmore junk\r\n\r\n\x1f\x8b"
    data = junk + parts[0] + parts[1][:-9] + parts[2] + junk + parts[3][: len(parts[3]) // 2]
    names, gaps = told(data)
    assert [n for n in names if n[0] == "<"] == ["<0>", "<2>"]
    cut = len(parts[1]) - 9
    assert gaps == [
        (0, len(junk)), (len(junk + parts[0]), cut), (len(junk + parts[0] + parts[2]) + cut, len(junk) + len(parts[3]) // 2),
    ]


def test_kinds_of_records_in_one_file():
    plain, packed = members(4, False), members(4, True)
    shared = archives.member(plain[2] + plain[3])  # one member of two records
    names, gaps = told_kinds = told(plain[0] + packed[1])
    assert told_kinds == (["<0>", "<1>"], [])
    found = [row[0] for *_, row in archives.salvaged(shared) if row]
    assert found == ["<urn:page:2>", "<urn:page:3>"]
    torn = archives.member(plain[2][:-1] + b"x" + plain[3])
    found = list(archives.salvaged(torn))
    assert [bool(row) for *_, row in found] == [False, True] and found[0][2].startswith("within the member")


def test_checks_of_a_record():
    good = archives.record(1, "u", b"text", None)
    for old, new in [(b"text", b"test"), (b"Content-Length: 8", b"Content-Length: 9"), (b"WARC-Record-ID", b"WARC-Other-IDs"), (b"WARC/1.1", b"WARC/2.1"), (b"Content-Type: application", b"Content-Type- application")]:
        assert old in good
        assert not any(row for *_, row in archives.salvaged(good.replace(old, new)))
    swapped = archives.record(1, "u", b"text", None).replace(archives.base32_sha1(b"text").encode(), archives.base32_sha1(b"test").encode())
    assert [r for _, _, r, _ in archives.salvaged(swapped)] == ["payload digest differs"]


def test_gaps_are_logged_by_file(spark, tmp_path):
    path = written(spark, tmp_path, [(n, "u", payload(n) + str(n)) for n in range(40)])
    one = files(path)[0]
    data = one.read_bytes()
    middle = data.index(b"\x1f\x8b\x08", 1)
    one.with_name(f".{one.name}.crc").unlink()  # the local file system's own checksum
    one.write_bytes(data[:middle] + b"??" + data[middle + 2 :])
    found = archives.read_archives(spark, path)
    log = archives.quarantined(found).collect()
    assert [(r.path.endswith(one.name), r.offset, r.reason) for r in log] == [(True, middle, "no gzip member or version line")]
    assert archives.records(found).count() == 39
