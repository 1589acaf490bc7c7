"""Archives: round trips, revisits, and what is salvaged from damaged ones."""

import glob
import gzip
import random

import pytest
from pyspark.sql import functions as F

from duplexa.llm import warc
from duplexa.llm.warc import END, Part, base32_sha1, member, page_record, parts, record_bytes

DATE = "2000-01-01T00:00:00Z"
PAGES = [(f"http://a.example/{i}", b"<p>page %d</p>" % i * (i + 1)) for i in range(8)]


def made(n, compressed):
    found = [page_record(i, *PAGES[i], None, DATE) for i in range(n)]
    return [member(r) for r in found] if compressed else found


def read_back(data):
    """(ids of records, (start, end) of gaps); records and gaps must cover the bytes in order."""
    found, at = list(parts(data)), 0
    for p in found:
        assert p.start == at or p.start > at and not data[at : p.start].strip(b"\0") or p.end == at
        at = p.end
    ids = [warc.described(p)["id"] for p in found if p.gap is None]
    for p in found:
        if p.gap is None:
            assert warc.described(p)["payload"] in [payload for _, payload in PAGES]
    return ids, [(p.start, p.end) for p in found if p.gap is not None]


@pytest.mark.parametrize("compressed", [True, False])
def test_whole_archives(compressed):
    assert read_back(b"".join(made(6, compressed))) == (list("012345"), [])
    assert read_back(b"") == ([], [])


@pytest.mark.parametrize("compressed", [True, False])
def test_damage_costs_the_records_it_hits(compressed):
    rng = random.Random(5)
    for _ in range(120):
        some = made(6, compressed)
        hit = rng.randrange(6)
        data, kind = some[hit], rng.randrange(4)
        # Fields of a record that stands as it is have no check sum: damage to them may pass.
        fields = 0 if compressed else data.index(b"HTTP/1.1")
        at = rng.randrange(12, len(data) - 12)
        if kind == 0:  # a byte turned
            data = data[:at] + bytes([data[at] ^ rng.randrange(1, 256)]) + data[at + 1 :]
        elif kind == 1:  # cut short
            data = data[:at]
        elif kind == 2:  # a stretch left out
            data = data[:at] + data[at + rng.randrange(1, 9) :]
        else:  # a stretch put in
            data = data[:at] + rng.randbytes(rng.randrange(1, 40)) + data[at:]
        start = sum(map(len, some[:hit]))
        ids, gaps = read_back(b"".join(some[:hit]) + data + b"".join(some[hit + 1 :]))
        others = [str(i) for i in range(6) if i != hit]
        if at >= fields:
            assert ids == others and gaps == [(start, start + len(data))]
        else:
            assert set(others) <= set(ids) and len(ids) <= 6 and all(start <= a and b <= start + len(data) for a, b in gaps)


@pytest.mark.parametrize("compressed", [True, False])
def test_bytes_between_records_are_a_gap_alone(compressed):
    a, b = made(2, compressed)
    junk = b"junk WARC/1.1 junk \x1f\x8b\x08 junk" * 3
    assert read_back(a + junk + b) == (["0", "1"], [(len(a), len(a) + len(junk))])
    assert read_back(junk + a + b + junk) == (["0", "1"], [(0, len(junk)), (len(junk) + len(a) + len(b), 2 * len(junk) + len(a) + len(b))])


def test_what_a_damaged_payload_holds_is_no_record():
    inner = page_record(7, *PAGES[7], None, DATE)
    outer = record_bytes("response", b"HTTP/1.1 200 OK\r\n\r\n" + inner, [("WARC-Record-ID", "<urn:row:5>"), ("Content-Type", "application/http")], DATE)
    broken = outer.replace(b"200 OK", b"404 No", 1)
    assert list(parts(outer))[0].fields["warc-record-id"] == "<urn:row:5>"
    first = page_record(0, *PAGES[0], None, DATE)
    ids, gaps = read_back(broken + first)
    assert ids == ["0"] and gaps == [(0, len(broken))]
    # With its frame broken too, later version lines are all there is to go by.
    assert read_back(broken.replace(b"Content-Length: ", b"Content-Length: 9", 1) + first)[0] == ["7", "0"]


def test_truncated_ends_and_mixed_archives():
    a, b = made(2, True)
    c = page_record(2, *PAGES[2], None, DATE)
    assert read_back(a + c + b) == (["0", "2", "1"], [])
    assert read_back(a + b"\0\0" + b) == (["0", "1"], [])
    assert read_back(a + b[:-9])[0] == ["0"] and read_back(c + c[: len(c) // 2]) == (["2"], [(len(c), len(c) + len(c) // 2)])
    whole = gzip.compress(c + page_record(3, *PAGES[3], None, DATE))
    assert read_back(whole)[0] == ["2", "3"]
    assert [p.gap for p in parts(b"\0" * 5)] == ["no member and no version line"]


def test_records_without_digests_need_a_neighbour():
    plain = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 3\r\n\r\nabc" + END
    found = list(parts(plain + plain))
    assert [p.block for p in found] == [b"abc", b"abc"] and warc.described(found[0])["payload"] == b"abc"
    assert [isinstance(p, Part) and p.gap for p in parts(plain + b"x" + plain)] == ["no record follows", None]


@pytest.mark.parametrize("compressed", [True, False])
def test_round_trip_of_odd_rows(spark, tmp_path, compressed):
    rows = [(3, "u3", "same"), (1, "u1", "same"), (1, "u1b", "same"), (None, None, "same"), (2, None, None), (4, "u4", ""), (5, "a\r\nb%0D", "ÄÖ\0\r\n\r\n"), (6, "u6", "WARC/1.1\r\n\r\n")]
    rows += [(7, "u7", "long " * 300_000), (None, "only", "none"), (8, "u8", random.Random(1).randbytes(9_000_000).hex())]
    clash = ", id string, payload string, refers_to string, uri string, value string, gap string"
    frame = spark.createDataFrame([(*r, *"abcdef") for r in rows], "page_id long, url string, html string" + clash)
    path = str(tmp_path / "archives")
    warc.write(frame, path, compressed=compressed)
    found = warc.read(spark, path)
    assert warc.gaps(found).count() == 0
    got = sorted((r["id"] or "", r["uri"] or "", r["record_type"], r["refers_to"], r["payload_bytes"], r["payload"], r["payload_digest"]) for r in warc.records(found).collect())
    want = []
    for i, uri, html in rows:
        payload = (html or "").encode()
        first = {"same": 1, None: 2, "": 2}.get(html, i)
        first = None if first == i else str(first)
        kept = None if first else payload
        want.append(("" if i is None else str(i), uri or "", "revisit" if first else "response", first, len(payload), kept, base32_sha1(payload)))
    assert got == sorted(want, key=lambda r: r[:3])


def test_small_payloads_may_stay_responses(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "long one"), (4, "d", "long one")], "page_id long, url string, html string")
    warc.write(frame, str(tmp_path / "archives"), least_bytes=5)
    assert sorted((r["id"], r["refers_to"]) for r in warc.read(spark, str(tmp_path / "archives")).collect()) == [("1", None), ("2", None), ("3", None), ("4", "3")]


def test_an_empty_table_and_an_existing_folder(spark, tmp_path):
    path = str(tmp_path / "archives")
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(empty, path)
    assert warc.read(spark, path).count() == 0
    with pytest.raises(Exception, match="(?i)exists"):
        warc.write(empty, path)


def test_a_damaged_folder_is_logged_and_read_on(spark, tmp_path):
    path = str(tmp_path / "archives")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    warc.write(pages, path)
    (name,) = [f for f in glob.glob(f"{path}/part-*") if open(f, "rb").read(1)]
    data = bytearray(open(name, "rb").read())
    places = sorted(r["offset"] for r in warc.read(spark, path).collect())
    data[places[10] + 40] ^= 0xFF
    del data[places[20] + 30 : places[20] + 35]
    copy = tmp_path / "copy"
    copy.mkdir()
    (copy / "a.warc").write_bytes(data)
    found = warc.read(spark, str(copy)).cache()
    lost = warc.gaps(found).orderBy("offset").collect()
    assert [g["offset"] for g in lost] == [places[10], places[20]] and [g["length"] for g in lost] == [places[11] - places[10], places[21] - places[20] - 5]
    assert warc.records(found).count() == 48
    assert found.agg(F.sum(F.when(F.col("gap").isNotNull(), F.col("length")))).first()[0] == sum(g["length"] for g in lost)
