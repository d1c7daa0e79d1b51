"""WARC: exact round trip, revisits, and lookups against a scan."""

import gzip
import hashlib

import pytest
from pyarrow import fs as arrow_fs

from shelfwise.llm import warc

PAGES = [(3, "https://www.example.org/a?x=1", "<p>" + "long enough " * 20), (1, "http://m.example.org/b c", "<p>" + "long enough " * 20), (9, "http://Example.ORG:8080", "<p>" + "long enough " * 20),
         (4, "https://www.example.org/a?x=1", "short"), (5, "not a url", "short"), (6, None, None), (7, "", ""), (None, "http://x.y/n", "null id " * 30), (11, "http://x.y/n", "null id " * 30),
         (8, "http://[bad", "é😀 " * 4000), (1, "http://m.example.org/b c", "<p>" + "long enough " * 20)]


@pytest.fixture(scope="module")
def archived(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    folder = warc.new_folder(spark)
    captures = warc.write_archives(pages, folder)
    return folder, warc.write_index(captures, folder, 3, block_lines=2), pages


def test_read_back(archived):
    folder, parts, _ = archived
    got = sorted((tuple(r)[:1] + tuple(r)[2:] for r in warc.read_all(parts, folder).collect()), key=repr)
    first = {}
    for i, _, h in PAGES:
        raw = (h or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(first.get(raw, i), i)
    want = []
    for i, _, h in PAGES:
        raw = (h or "").encode()
        f = first.get(raw)
        other = f is not None and f != i
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if other else "response", f if other else None))
    assert got == sorted(want, key=repr)


def test_all_urls_read_through_the_directories(spark, archived):
    """The rows of the URLs are those of the whole archive, each once, also for URLs that share a key."""
    folder, parts, pages = archived
    rows = lambda df: sorted(map(repr, df.collect()))
    assert rows(warc.read_urls(pages, parts, folder)) == rows(warc.read_all(parts, folder))
    one = spark.createDataFrame([("http://x.y/n",), ("http://x.y/n",), ("http://nowhere.org",)], "url string")
    assert sorted((r.page_id for r in warc.read_urls(one, parts, folder).collect()), key=repr) == sorted([None, 11], key=repr)


def test_lookup(spark, archived):
    folder, parts, _ = archived
    urls = spark.createDataFrame([("https://www.example.org/a?x=1",), ("http://nowhere.org",), ("http://x.y/n",), ("http://Example.ORG:8080",)], "url string")
    got = warc.lookup(urls, parts, folder).collect()
    assert sorted((r.page_id for r in got), key=repr) == sorted([3, 4, None, 11, 9], key=repr)
    html = {r.page_id: r.payload for r in got}
    assert html[4] == b"short" and html[9] is None and html[11].decode() == "null id " * 30


def test_every_member_is_a_record(archived):
    folder, _, _ = archived
    fs, path = warc.file_system(folder)
    n = 0
    for info in fs.get_file_info(arrow_fs.FileSelector(path)):
        if info.path.endswith(".warc.gz"):
            whole = gzip.decompress(open(info.path, "rb").read())
            n += whole.count(b"WARC/1.1\r\nWARC-Type: ")
    assert n == len(PAGES)


def test_damage_is_noticed():
    raw = warc.record(1, "http://x.y/", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert warc.parse_record(raw)["payload"] == b"payload"
    for bad in (raw.replace(b"payload\r\n\r\n", b"paylodd\r\n\r\n"), raw[:-2]):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_url_keys():
    assert warc.url_key("https://www.Example.org/a?b=c#d") == "org,example,www)/a?b=c"
    assert warc.url_key("http://x.org:81") == "org,x:81)/"
    assert warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = warc.new_folder(spark)
    parts = warc.archive(pages, folder, 2)
    assert parts.count() == 0 and warc.read_all(parts, folder).count() == 0
