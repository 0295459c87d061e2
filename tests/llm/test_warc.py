"""Archives against a parser written here, and what a pushed predicate saves."""

import glob
import gzip
import hashlib
import io

import pytest

from tidemark.llm import warc

ROWS = "page_id long, url string, html string, payload string, record_type string"
BIG = "x" * 400 + "é" * 600


def pages(spark):
    texts = [BIG, BIG, "small", "small", None, "", "y" * 3_000_000 + "end", BIG, "z" * 999, "z" * 999, "z" * 1000, "z" * 1000]
    rows = [(i, f"http://a/{i}\r\n%", t, "clash", "clash") for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, ROWS).repartition(3)


def brute(rows):
    """Columns of the contract, page by page."""
    top = {}
    for page, _, text, *_ in rows:
        data = (text or "").encode()
        if len(data) >= 1000:
            top[data] = max(page, top.get(data, page))
    out = {}
    for page, _, text, *_ in rows:
        data = (text or "").encode()
        first = top.get(data, page)
        out[page] = (len(data), hashlib.sha1(data).hexdigest(), "response" if first == page else "revisit", None if first == page else first)
    return out


def test_round_trip_equals_brute_force(spark):
    rows, df = pages(spark)
    found = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.round_trip(df).collect()}
    assert found == brute(rows)
    assert warc.round_trip(df.limit(0)).count() == 0


def parsed(path):
    """Records by the letter of the format: version, named fields, an empty line, a block of the stated length."""
    for name in glob.glob(f"{path}/*.warc.gz"):
        data = io.BytesIO(gzip.open(name).read())
        while line := data.readline():
            assert line == b"WARC/1.1\r\n"
            fields = {}
            while (line := data.readline()) != b"\r\n":
                key, value = line.decode().rstrip("\r\n").split(": ", 1)
                fields[key] = value
            block = data.read(int(fields["Content-Length"]))
            assert data.read(4) == b"\r\n\r\n"
            yield fields, block


def test_files_hold_plain_records(spark, tmp_path):
    rows, df = pages(spark)
    warc.write_archives(warc.archive(df), str(tmp_path))
    want, got = brute(rows), list(parsed(tmp_path))
    ids = {int(f["X-Page-ID"]): f["WARC-Record-ID"] for f, _ in got}
    assert sorted(ids) == sorted(want) and len(got) == len(want)
    for fields, block in got:
        page = int(fields["X-Page-ID"])
        body = block.split(b"\r\n\r\n", 1)[1]
        assert fields["WARC-Type"] == want[page][2]
        assert body == ((rows[page][2] or "").encode() if want[page][2] == "response" else b"")
        if want[page][3] is not None:
            assert fields["WARC-Refers-To"] == ids[want[page][3]]


class Counted(io.BytesIO):
    seen = 0

    def read(self, n=-1):
        data = super().read(n)
        self.seen += len(data)
        return data

    def size(self):
        return len(self.getvalue())


def test_a_pushed_predicate_spares_payloads(spark):
    noise = hashlib.shake_128(b"seed").digest(200_000)
    digest = hashlib.sha1(noise).hexdigest()
    data = b"".join(warc.member(warc.record("response" if i % 10 else "revisit", i, "u", 1, digest, len(noise), noise)) for i in range(30))
    whole, few = Counted(data), Counted(data)
    assert len(list(warc.records(whole, [], True))) == 30
    assert [r["page_id"] for r in warc.records(few, [("record_type", ["revisit"])], False)] == [0, 10, 20]
    assert few.seen < whole.seen / 20
    _, df = pages(spark)
    plan = warc.round_trip(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchScan warc") == 2 and "Filter (" not in plan  # both predicates went to the source


def test_unknown_places_are_refused_before_writing(spark):
    with pytest.raises(Exception, match="(?i)scheme|filesystem|uri"):
        warc.write_archives(warc.archive(pages(spark)[1]), "nowhere://x/y")
