"""Archives written and read back by ranges of all sizes; false starts, lost bytes, nulls, hot payloads."""

from __future__ import annotations

import base64
import gzip
import hashlib
import os
import uuid

import pytest

from perilspark.llm import warc
from perilspark.session import run_dir

HTML = ["<p>one</p>", "<p>one</p>", "", None, "é" * 3000, "<p>two</p>", "x" * 300_000, "<p>one</p>", "\x1f\x8b\x08 no record", "", "tail \r\n\r\n\r\n"]
PAGES = [(i * 3 % 31, f"http://h{i}.org/a b\n{i}" if i % 4 else None, html, "extra") for i, html in enumerate(HTML)]
SCHEMA = "page_id long, url string, html string, payload string"


def sha1(text: str) -> str:
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(pages, least=0):
    first: dict[str, int] = {}
    for key, _, html, _ in pages:
        if key is not None:
            first[html or ""] = min(first.get(html or "", key), key)
    out = []
    for key, _, html, _ in pages:
        text = html or ""
        f = first.get(text)
        revisit = len(text.encode()) >= least and f is not None and key != f
        out.append((key, len(text.encode()), sha1(text), "revisit" if revisit else "response", f if revisit else None))
    return sorted(out, key=str)


def found(rows):
    rows = rows.where("record_type <> 'warcinfo'")
    rows = rows.select(warc.page_key("record_id").alias("k"), "payload_bytes", "payload_digest", "record_type", warc.page_key("refers_to").alias("r"))
    return sorted((tuple(r) for r in rows.collect()), key=str)


COLUMNS = ["record_type", "record_id", "refers_to", "payload_bytes", "payload_digest"]


@pytest.mark.parametrize("least", [0, 11])
def test_round_trip(spark, least):
    # Repeated rows and null keys beside a page with the same payload.
    pages = [*PAGES, PAGES[1], (None, None, "<p>one</p>", "e"), (None, "u", "alone", "e")]
    df = spark.createDataFrame(pages, SCHEMA).repartition(3)
    manifest = warc.write_archives(df, run_dir(spark, "warc-test"), least=least, archive_bytes=1200)
    total = manifest.agg({"records": "sum"}).first()[0]
    assert manifest.count() > 3 and total == len(pages) + manifest.count()
    for size in (499, 4096, 1 << 30):
        assert found(warc.read_sound(manifest, COLUMNS, size)) == expected(pages, least)
    # Whole payloads and targets come back too.
    responses = {r["record_id"]: r for r in warc.read_archives(manifest).where("record_type = 'response'").collect()}
    assert responses[warc.urn(18)]["payload"] == HTML[6].encode()
    assert responses[warc.urn(15)]["target_uri"] == "http://h5.org/a%20b%0A5"
    # Any gzip reader gets the records in order.
    for row in manifest.collect():
        text = gzip.open(row["archive"].removeprefix("file:")).read()
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and text.count(b"WARC/1.1\r\n") == row["records"]


def test_one_payload_for_a_third_of_all_pages(spark):
    pages = [(i, "u", "same" if i % 3 == 0 else f"own {i}", "") for i in range(3000)]
    manifest = warc.write_archives(spark.createDataFrame(pages, SCHEMA).repartition(7), run_dir(spark, "warc-test"))
    rows = found(warc.read_sound(manifest, COLUMNS, 1000))
    assert rows == expected(pages)
    assert sum(r[3] == "revisit" for r in rows) == 999


def test_empty_table(spark):
    manifest = warc.write_archives(spark.createDataFrame([], SCHEMA), run_dir(spark, "warc-test"))
    assert manifest.count() == 0
    assert warc.read_sound(manifest, COLUMNS).count() == 0


def archive(spark, parts: list[bytes]):
    """An archive made of the given members, and its manifest."""
    folder = run_dir(spark, "warc-test").removeprefix("file:")
    os.makedirs(folder)
    path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
    with open(path, "wb") as out:
        out.write(b"".join(parts))
    return spark.createDataFrame([(path, sum(map(len, parts)), len(parts))], warc.MANIFEST)


def test_a_record_stored_within_a_record_is_no_record(spark):
    inner = warc.page_record(99, None, b"inner", False, None, "2000")
    outer = warc.member([("WARC-Type", "resource"), ("WARC-Record-ID", warc.urn(1))], b"-" * 500 + inner + b"-" * 500, level=0)
    after = warc.page_record(2, None, b"after", False, None, "2000")
    manifest = archive(spark, [outer, after])
    raw = [r["record_id"] for r in warc.read_archives(manifest, 300).collect()]
    assert warc.urn(99) in raw  # a range starts inside the outer record
    assert warc.unsound(warc.read_archives(manifest, 300), manifest).count() == 1
    assert sorted(r["record_id"] for r in warc.read_sound(manifest, ["record_id"], 300).collect()) == [warc.urn(1), warc.urn(2)]


def test_other_members_and_damage(spark):
    good = [warc.page_record(i, None, b"x" * i, False, None, "2000") for i in range(4)]
    other = gzip.compress(b"not a record")
    broken = bytearray(good[1])
    broken[-6] ^= 255  # the checksum
    manifest = archive(spark, [good[0], other, bytes(broken), good[2], good[3][:-3]])
    ids = [r["record_id"] for r in warc.read_archives(manifest, 50).collect()]
    assert sorted(ids) == [warc.urn(0), warc.urn(2)]
    with pytest.raises(ValueError, match="damaged"):
        warc.read_sound(manifest, ["record_id"])
