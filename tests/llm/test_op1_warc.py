import hashlib
import random

import pytest

from pavespark.llm import warc_index

SCHEMA = "page_id long, url string, html string, payload string, digest string, run string, part int, value string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z", 1, "w") for r in rows], SCHEMA)


def expected(rows):
    groups = {}
    for i, _, html in rows:
        if i is not None:
            groups[html or ""] = max(i, groups.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = groups.get(html or "")
        revisit = len(data) >= 1000 and first is not None and first != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    first if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def odd_pages():
    rng = random.Random(4)
    long = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc</p>" * 40
    rows = [(i, f"http://h{rng.randrange(4)}.Example.com/{rng.randrange(6)}?q#f", rng.choice([long, f"<p>{i}</p>", "x" * 999]))
            for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (None, "http://a.b/", long), (102, "no scheme\r\n%0D", "y" * 5000),
             (102, "no scheme\r\n%0D", "y" * 5000), (103, "http://[bad", "中文" * 700), (-4, "ftp://X.y", "中文" * 700),
             (None, "u", "z" * 3000), (None, "u", "z" * 3000), (104, "http://big/", "w" * 3_000_000)]
    return rows


def test_pages_come_back_in_order(spark, odd_pages):
    found = warc_index.capture_index(pages(spark, odd_pages)).collect()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r[c] for c in names) for r in found), key=str) == expected(odd_pages)
    found.sort(key=lambda r: r["capture_seq"])
    assert [r["capture_seq"] for r in found] == list(range(len(odd_pages)))
    keys = [(r["url_key"], r["captured_at"]) for r in found]
    assert keys == sorted(keys)
    assert sorted(k for k, _ in keys) == sorted(warc_index.url_key(u or "") for _, u, _ in odd_pages)


def test_no_pages(spark):
    assert warc_index.capture_index(pages(spark, [])).collect() == []


def test_archives_are_split_and_hold_whole_records(spark, odd_pages, tmp_path):
    path = str(tmp_path / "warc")
    warc_index.write_archives(pages(spark, odd_pages).coalesce(1), path, archive_bytes=400_000)
    files = sorted((tmp_path / "warc").glob("part-*"))
    assert len(files) > 1
    count = 0
    for f in files:
        data = f.read_bytes()
        for at, fields, block in warc_index.parsed(data):
            count += 1
            assert data[at:].startswith(b"WARC/1.1\r\n")
            assert fields["WARC-Type"] in ("response", "revisit")
            if fields["WARC-Type"] == "response":
                payload = block[block.index(b"\r\n\r\n") + 4:]
                assert fields["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
    assert count == len(odd_pages)


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 16])
def test_loser_tree(k):
    rng = random.Random(k)
    lists = [sorted(((f"u{rng.randrange(5)}", "t", rng.choice([None, 1, 2]), f"r{run}", i)
                     for i in range(rng.randrange(30))), key=warc_index.order_of) for run in range(k)]
    everything = sorted((x for own in lists for x in own), key=warc_index.order_of)
    assert list(warc_index.LoserTree(lists)) == everything


def test_url_keys():
    assert warc_index.url_key("https://M.a.Example.org/p/q?x=1#top") == "org,example,a,m)/p/q?x=1"
    assert warc_index.url_key("") == ")"
