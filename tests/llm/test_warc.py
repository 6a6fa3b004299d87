"""WARC archives: exact round trip through split reading."""

import base64
import gzip
import hashlib
import io
import random
from collections import Counter

import pytest
from pyarrow import fs

from llm import warc
from llm.queries import op4_warc
from tests.llm.cases import awkward, frame

SCHEMA = "page_id long, url string, html string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pages():
    rng = random.Random(4)
    texts = [f"<html>{rng.random()}{'é🙂' * rng.randint(0, 900)}</html>" for _ in range(40)]
    rows = [(i, f"http://x/{i}", rng.choice(texts) if i % 3 else f"own {i} \r\n\r\n WARC/1.1") for i in range(150)]
    return rows + [(500, None, None), (501, "a b\nc", ""), (502, "http://é", "\x1f\x8b\x08 not a member"), (503, "u", "z" * 3_000_000)]


def test_query_matches_a_literal_reading(spark, tmp_path):
    rows = pages()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in op4_warc(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max(i, largest.get(html or "", i))
    for i, _, html in rows:
        payload, best = (html or "").encode(), largest[html or ""]
        want = (len(payload), digest(payload), "response" if i == best else "revisit", None if i == best else best)
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == want


@pytest.mark.parametrize("split", [700, 4096, 1 << 20])
def test_every_record_is_read_once_whatever_the_ranges(spark, split):
    rows = pages()[:60]
    archives = warc.write(warc.decide(spark.createDataFrame(rows, SCHEMA).repartition(2), least_bytes=1 << 30))
    assert sum(r.records for r in archives.collect()) == len(rows)
    got = sorted((r.page_id, r.payload) for r in warc.read(archives, split).collect())
    assert got == sorted((i, (html or "").encode()) for i, _, html in rows)


def test_archives_are_plain_gzip_members(spark):
    archives = warc.write(warc.decide(spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], SCHEMA).coalesce(1)))
    path = archives.first().path
    system, name = fs.FileSystem.from_uri(path)
    text = gzip.decompress(system.open_input_file(name).read()).decode()
    assert text.count("WARC/1.1\r\n") == 2 and text.count("WARC-Refers-To: <urn:x-page:2>") == 1
    assert "WARC-Target-URI: u\r\n" in text and text.endswith("\r\n\r\n")


def test_false_magic_is_no_member():
    good = warc.record(7, "u", b"payload", "response", None)
    data = warc.MAGIC + b"junk" + good + b"\x1f\x8b" + gzip.compress(b"not a record") + good + warc.MAGIC

    class File(io.BytesIO):
        size = staticmethod(lambda: len(data))

        def read_at(self, n, at):
            return data[at : at + n]

    whole = list(warc.records_in(File(), 0, len(data)))
    assert [warc.parse(x)[0] for x in whole] == [7, 7]
    for cut in range(len(data)):
        assert len([*warc.records_in(File(), 0, cut), *warc.records_in(File(), cut, len(data))]) == 2


def test_ranges_are_read_by_as_many_tasks_as_are_wanted(spark):
    rows = pages()[:100]
    archives = warc.write(warc.decide(spark.createDataFrame(rows, SCHEMA).repartition(2), least_bytes=1 << 30))
    cores = spark.sparkContext.defaultParallelism
    many = archives.selectExpr("explode(sequence(0L, bytes - 1, 500L))").count()
    assert many > cores * warc.RANGES_A_TASK
    for split, tasks in ((500, -(-many // warc.RANGES_A_TASK)), (1 << 20, 2)):
        parts = warc.read(archives, split).select("page_id").mapInArrow(lambda batches: iter(batches), "page_id long")
        assert parts.rdd.getNumPartitions() == tasks
        assert parts.count() == len(rows)


def test_a_record_of_many_blocks_is_read_once(monkeypatch):
    payload = random.Random(1).randbytes(20_000_000)
    data = warc.record(1, "u", b"a", "response", None) + warc.record(2, "u", payload, "response", None) + warc.record(3, "u", b"b", "response", None)
    read = []

    class File(io.BytesIO):
        size = staticmethod(lambda: len(data))

        def read_at(self, n, at):
            read.append(n)
            return data[at : at + n]

    found = [warc.parse(x) for x in warc.records_in(File(), 0, len(data))]
    assert [r[0] for r in found] == [1, 2, 3] and found[1][-1] == payload
    assert sum(read) < len(data) + 2 * warc.BLOCK_BYTES
    assert [warc.parse(x)[0] for x in warc.records_in(File(), len(data) // 2, len(data))] == [3]


def test_a_payload_that_does_not_match_its_digest_is_reported():
    content = gzip.decompress(warc.record(7, "u", b"payload", "response", None)).replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n")
    with pytest.raises(ValueError, match="digest"):
        warc.parse(content)


def test_small_payloads_null_ids_and_repeated_rows(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "a long one"), (3, "u", "a long one"), (4, "u", "a long one"), (None, "u", "a long one"), (None, "u", None)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", record_type string")
    got = [(r.page_id, r.record_type, r.refers_to) for r in warc.resolved(warc.read(warc.write(warc.decide(docs, least_bytes=5)))).collect()]
    want = [(1, "response", None), (2, "response", None), (3, "revisit", 4), (3, "revisit", 4), (4, "response", None), (None, "revisit", 4), (None, "response", None)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_awkward_documents_as_pages(spark):
    rows = awkward()
    docs = frame(spark, rows).selectExpr("doc_id AS page_id", "source AS url", "text AS html", "lang AS payload", "n_chars AS payload_bytes", "'x' AS refers_to")
    got = warc.resolved(warc.read(warc.write(warc.decide(docs)))).collect()
    want = Counter((r[0], len((r[1] or "").encode()), digest((r[1] or "").encode())) for r in rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == want


def test_empty_table(spark):
    archives = warc.write(warc.decide(spark.createDataFrame([], SCHEMA)))
    assert archives.count() == 0 and warc.resolved(warc.read(archives)).count() == 0
