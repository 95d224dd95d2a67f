import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidepool.llm import warc
from tests.llm.harness import matches

ROWS = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "http://a/4\r\nX: y", ""), (5, "u", "head\r\n\r\nbody"),
        (5, "u", "head\r\n\r\nbody"), (None, "http://n", "<p>é</p>"), (None, None, "alone"), (9, "long", "x" * 300_000)]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, "z") for r in ROWS], "page_id long, url string, html string, archive string")


def test_round_trip(pages, tmp_path):
    index = warc.write_archives(pages.repartition(3), f"file://{tmp_path}/w")
    rows = index.collect()
    assert len(rows) == len(ROWS)
    for r in rows:  # every range of the index is one gzip member that is one record
        raw = gzip.decompress(Path(r.archive.removeprefix("file://")).read_bytes()[r.offset:r.offset + r.length])
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
    got = {}
    for r in warc.read_records(index).collect():
        got.setdefault(r.page_id, []).append(r)
    assert got[1][0].record_type == "revisit" and got[1][0].refers_to == 2 and got[1][0].payload is None and got[1][0].payload_bytes == 9
    assert bytes(got[2][0].payload).decode() == "<p>é</p>" and got[3][0].refers_to == 4 and bytes(got[4][0].payload) == b""
    assert [x.record_type for x in got[5]] == ["response"] * 2 and bytes(got[5][0].payload) == b"head\r\n\r\nbody"
    assert sorted((x.record_type, x.refers_to or 0) for x in got[None]) == [("response", 0), ("revisit", 2)]
    assert got[9][0].payload_bytes == 300_000 and got[4][0].url == "http://a/4%0D%0AX:%20y"


def test_small_payloads_are_not_shared(pages):
    index = warc.write_archives(pages, min_bytes=10)
    assert {r.page_id for r in index.filter("record_type = 'revisit'").collect()} == set()


def test_selected_records_and_small_archives(pages, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 300)
    index = warc.write_archives(pages.coalesce(1))
    assert sorted(r.page_id for r in warc.read_records(index.filter("page_id in (2, 4)")).collect()) == [2, 4]


def test_damage_is_noticed():
    raw, _ = warc.record(1, "u", b"payload", None, "2024-05-01T12:00:00Z")
    assert warc.parse(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"payload\r\n", b"paYload\r\n"))


def test_empty_table(spark, pages):
    index = warc.write_archives(pages.limit(0))
    assert index.collect() == [] and warc.read_records(index).collect() == []


def test_query(spark):
    assert matches(spark, "op9_warc", "/root/testdata/sf0.001")


def test_records_have_the_fields_that_readers_need(spark, pages, tmp_path):
    """WARC 1.1 asks every record for type, id, date and length; dates come from a column or the time of writing."""
    import datetime as dt
    dated = pages.withColumn("got", F.when(F.col("page_id") == 2, F.lit("2024-05-01 12:00:00").cast("timestamp")))
    index = warc.write_archives(dated, f"file://{tmp_path}/dated", date_col="got")
    for r in index.collect():
        raw = gzip.decompress(Path(r.archive.removeprefix("file://")).read_bytes()[r.offset:r.offset + r.length])
        head = raw.partition(b"\r\n\r\n")[0].decode().split("\r\n")
        names = [x.partition(": ")[0] for x in head[1:]]
        assert head[0] == "WARC/1.1" and {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(names) and len(set(names)) == len(names)
    dates = {r.page_id: r.warc_date for r in warc.read_records(index).collect()}
    assert dates[2] == "2024-05-01T12:00:00Z"
    written = dt.datetime.strptime(dates[1], "%Y-%m-%dT%H:%M:%SZ").replace(tzinfo=dt.timezone.utc)
    assert abs((dt.datetime.now(dt.timezone.utc) - written).total_seconds()) < 3600
