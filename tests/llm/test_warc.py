"""WARC archives: round trip, revisits and salvage of damaged files."""

import base64
import glob
import gzip
import hashlib
import os
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from starloom.llm import warc


def record(i, payload=b"<p>x</p>", first=None):
    return warc.build_record(i, f"http://a/{i}", payload, hashlib.sha256(payload).hexdigest(), first)


def ids(data):
    found = [r[2].get("x-page-id", "") for r in warc.salvage(data) if r[4] is None]
    return [int(i) if i.isdecimal() else None for i in found]


def gaps(data):
    return [(r[0], r[1]) for r in warc.salvage(data) if r[4] is not None]


def test_plain_and_compressed_records():
    plain = b"".join(map(record, range(5)))
    members = b"".join(gzip.compress(record(i)) + warc._NO_RECORD for i in range(5))
    assert ids(plain) == ids(members) == list(range(5)) and not gaps(plain) and not gaps(members)
    assert gzip.decompress(members) == plain and ids(b"") == []


def test_damage_costs_only_the_damaged_records():
    parts = [gzip.compress(record(i, b"payload %d " % i * 50)) for i in range(6)]
    broken = parts[2][:30] + bytes([parts[2][30] ^ 255]) + parts[2][31:]
    data = b"".join([parts[0], b"junk" * 9, parts[1], broken, parts[3], parts[4][:-9], parts[5]])
    assert ids(data) == [0, 1, 3, 5]
    start = len(parts[0]) + 36 + len(parts[1])
    assert gaps(data) == [(len(parts[0]), 36), (start, len(broken)), (start + len(broken) + len(parts[3]), len(parts[4]) - 9)]
    plain = [record(i, b"payload %d " % i * 50) for i in range(4)]
    plain[1] = plain[1].replace(b"payload 1 payload", b"payload 1 paXload", 1)
    assert ids(b"".join(plain)) == [0, 2, 3] and gaps(b"".join(plain)) == [(len(plain[0]), len(plain[1]))]


def test_a_damaged_record_inside_a_member_costs_only_itself():
    parts = [record(i, b"payload %d " % i * 40) for i in range(5)]
    parts[2] = parts[2].replace(b"payload 2 payload", b"payload 2 paXload", 1)
    member = gzip.compress(b"".join(parts))
    rows = list(warc.salvage(gzip.compress(record(8)) + member + gzip.compress(record(9))))
    assert ids(gzip.compress(record(8)) + member + gzip.compress(record(9))) == [8, 0, 1, 3, 4, 9]
    gap = next(r for r in rows if r[4])
    start = sum(map(len, parts[:2]))
    assert gap[2] is None and gap[4] == "block digest differs" and gap[5:] == (start, len(parts[2]))
    assert {(r[0], r[1]) for r in rows[1:-1]} == {(rows[1][0], len(member))}


def test_a_member_that_breaks_gives_what_lies_before():
    parts = [record(i, bytes(random.Random(i).randbytes(400)).hex().encode()) for i in range(30)]
    whole = gzip.compress(b"".join(parts))
    cut = whole[: len(whole) // 2]
    found = ids(cut + gzip.compress(record(99)))
    assert found[-1] == 99 and found[:-1] == list(range(len(found) - 1)) and len(found) > 8
    flipped = bytearray(whole)
    flipped[len(whole) // 2] ^= 255
    found = ids(bytes(flipped) + gzip.compress(record(99)))
    assert found[-1] == 99 and found[:-1] == sorted(found[:-1]) and len(found) > 8
    assert gaps(bytes(flipped) + gzip.compress(record(99))) == [(0, len(whole))]
    # A lone record in a broken member is not trusted.
    assert ids(gzip.compress(record(1))[:-3] + gzip.compress(record(2))) == [2]


@pytest.mark.parametrize("form", ["hex", "base32", "BASE32 without padding"])
@pytest.mark.parametrize("kind", ["sha1", "sha256", "md5"])
def test_block_digests(kind, form):
    block = b"some block"
    raw = hashlib.new(kind, block).digest()
    value = raw.hex() if form == "hex" else base64.b32encode(raw).decode()
    value = value.rstrip("=") if "without" in form else value
    assert warc.digest_holds({"warc-block-digest": f"{kind}:{value}"}, block) is True
    assert warc.digest_holds({"warc-block-digest": f"{kind}:{value}"}, block + b"x") is False
    good = f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Block-Digest: {kind}:{value}\r\nX-Page-ID: 1\r\nContent-Length: 10\r\n\r\n".encode()
    assert ids(good + block + b"\r\n\r\n") == [1] and ids(good + block[::-1] + b"\r\n\r\n") == []
    assert warc.digest_holds({"warc-block-digest": "crc:12"}, block) is None and warc.digest_holds({}, block) is None


def test_payload_that_looks_like_a_record():
    inner = record(7) + gzip.compress(record(8))
    assert ids(record(1, inner) + record(2)) == [1, 2]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.booleans(), min_size=3, max_size=6), st.integers(0, 10**6), st.integers(1, 40))
def test_every_byte_is_a_record_or_in_a_gap(packed, seed, size):
    draw = random.Random(seed)
    data = b"".join(gzip.compress(record(i)) if p else record(i) for i, p in enumerate(packed))
    at = draw.randrange(len(data))
    data = data[:at] + draw.randbytes(size) + data[at + draw.randrange(20) :]
    end = 0
    for offset, length in dict.fromkeys(row[:2] for row in warc.salvage(data)):
        assert offset == end
        end = offset + length
    assert end == len(data) and len(ids(data)) >= len(packed) - 3


PAGE = "page_id long, url string, html string"


def test_round_trip(spark, tmp_path):
    long = "ü" * 300_000
    rows = [(5, "u", "a" * 100), (3, None, "a" * 100), (9, "http://x y\r\nWARC: 1", "a" * 100), (4, "u", "a" * 99)]
    rows += [(6, "u", "a" * 99), (7, "", None), (8, "u", ""), (10, "u", long), (11, "u", long), (3, None, "a" * 100)]
    rows += [(None, "u", "a" * 100), (None, "u", "b"), (12, "u", "\r\n\r\nWARC/1.1\r\n\x1f\x8b\x08" * 9)]
    df = spark.createDataFrame(rows, PAGE).withColumns({"digest": F.lit(1), "first": F.lit(2), "member": F.lit(3)})
    warc.write_archives(df, f"{tmp_path}/w", file_bytes=1_000)
    got = warc.pages_of(warc.read_archives(spark, f"{tmp_path}/w")).collect()
    assert len(got) == len(rows)
    first = {"a" * 100: 3, long: 10}
    expected = []
    for i, _, html in rows:
        raw = (html or "").encode()
        again = first.get(html) if first.get(html) not in (None, i) else None
        expected.append((i, "revisit" if again else "response", again, len(raw), hashlib.sha256(raw).hexdigest()))
    found = [(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in got]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert {bytes(r.payload).decode() for r in got if r.payload is not None} >= {long, "", "b"}
    for name in glob.glob(f"{tmp_path}/w/part-*"):
        with open(name, "rb") as f:
            assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\n")


def test_files_are_cut_by_bytes(spark, tmp_path):
    draw = random.Random(1)
    rows = [(i, "u", draw.randbytes(5_000).hex()) for i in range(100)]
    warc.write_archives(spark.createDataFrame(rows, PAGE).coalesce(1), f"{tmp_path}/w", file_bytes=50_000)
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_path}/w/part-*")]
    assert max(sizes) < 60_000 and len(sizes) >= sum(sizes) // 60_000 > 5
    assert warc.pages_of(warc.read_archives(spark, f"{tmp_path}/w")).select("page_id").distinct().count() == 100


def test_gaps_are_logged(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.warc.gz").write_bytes(gzip.compress(record(1)) + b"\x1f\x8b\x08broken" + gzip.compress(record(2)))
    (tmp_path / "d" / "empty.warc").write_bytes(b"")
    rows = warc.read_archives(spark, f"{tmp_path}/d").orderBy("offset").collect()
    assert [r.gap_reason is None for r in rows] == [True, False, True] and rows[1].length == 9 and rows[1].headers is None


def test_empty_table(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], PAGE), f"{tmp_path}/w")
    assert warc.pages_of(warc.read_archives(spark, f"{tmp_path}/w")).count() == 0


@pytest.mark.parametrize("data", [b"WARC/1.0\r\n", b"WARC/1.0\r\nA: b\r\n\r\n", b"WARC/1.0\r\nx\r\n\r\n", b"WARC/1.0\n\r\n\r\n", b"\x1f\x8b\x08"])
def test_broken_headers_are_gaps(data):
    assert gaps(data) == [(0, len(data))]
