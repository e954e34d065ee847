import gzip
import hashlib
import os
import random

import pytest

from sylva.llm import warc

SCHEMA = "page_id long, url string, html string, size int, number string, file int, to_page int"


def rows():
    rnd = random.Random(4)
    big = ["é" * 499 + "xx", "é" * 499 + "x", "a" * 1000, "b" * 999, "c" * 5000]
    out = [(i, f"http://h{i % 7}.example.com/p/{i % 11}?q={i}", rnd.choice(big)) for i in range(80)]
    out += [(100 + i, f"https://www.example.org:443/{i}#x", f"page {i} " + "z" * rnd.randint(0, 3000)) for i in range(40)]
    out += [(200, None, None), (201, "", ""), (202, "not a url", "c" * 5000), (203, "http://[bad", "x"), (5, "http://a.b/", "c" * 5000),
            (5, "http://a.b/", "c" * 5000), (None, "http://n.b/", "c" * 5000), (None, None, "d" * 2000), (None, "http://q/ \r\n<", "d" * 2000),
            (300, "http://USER@Big.Example.COM:8080", "line\r\n\r\nWARC/1.1\r\n" * 200), (301, "ftp://x", "日本" * 400_000),
            (302, "ftp://y", "日本" * 400_000)]
    rnd.shuffle(out)
    return out


def brute(data):
    groups, out = {}, []
    for i, _, html in data:
        p = (html or "").encode()
        groups.setdefault(p, []).append(i)
    for p, ids in groups.items():
        sha, ids = hashlib.sha1(p).hexdigest(), sorted(ids, key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(ids):
            last = len(p) < 1000 or k == len(ids) - 1
            out.append((i, len(p), sha, "response" if last else "revisit", None if last else ids[-1]))
    return sorted(out, key=str)


def archive_of(spark, tmp, data, **kw):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in data], SCHEMA).repartition(4)
    return warc.write_archive(df, f"{tmp}/archive", **kw)


@pytest.mark.parametrize("file_bytes,lines", [(64 << 20, 512), (2000, 1), (1, 3)])
def test_round_trip_equals_brute_force(spark, tmpdir_fresh, file_bytes, lines):
    data = rows()
    archive = archive_of(spark, tmpdir_fresh, data, file_bytes=file_bytes)
    index = warc.build_index(archive, f"{tmpdir_fresh}/index", lines)
    got = sorted((tuple(r) for r in warc.read_archive(archive, index).collect()), key=str)
    assert got == brute(data)


def test_every_record_is_found_through_the_index(spark, tmpdir_fresh):
    data = rows()
    archive = archive_of(spark, tmpdir_fresh, data)
    index = warc.build_index(archive, f"{tmpdir_fresh}/index", 4)
    records = archive.records.collect()
    keys = spark.createDataFrame([(r.key,) for r in records] + [("zzz",), ("",)], "prefix string").where("prefix != ''")
    found = warc.find_captures(index, keys).collect()
    assert sorted((r.key, r.file, r.offset, r.length) for r in found) == sorted(tuple(r) for r in records)
    urls = spark.createDataFrame([("http://h3.example.com/p/3?q=3",), ("http://A.b:80/",), ("http://gone/",), (None,)], "url string")
    hits = warc.captures_of(index, urls).collect()
    assert sorted(r.url for r in hits) == ["http://A.b:80/"] * 2 + ["http://h3.example.com/p/3?q=3"]
    for r in hits:  # a range read gives the whole record
        with open(f"{archive.folder}/{r.file}", "rb") as f:
            f.seek(r.offset)
            fields, _ = warc.parse_record(gzip.decompress(f.read(r.length)))
        assert warc.url_key(fields["warc-target-uri"]) == warc.url_key(r.url)


def test_a_prefix_may_span_blocks_and_ranges(spark, tmpdir_fresh):
    data = [(i, f"http://one.example.com/{i:03d}", "x") for i in range(200)]
    archive = archive_of(spark, tmpdir_fresh, data)
    index = warc.build_index(archive, f"{tmpdir_fresh}/index", 7)
    assert len(index.ranges) > 1
    host = spark.createDataFrame([("com,example,one)/",), ("com,example,one)/01",)], "prefix string")
    got = warc.find_captures(index, host).groupBy("prefix").count().collect()
    assert {r.prefix: r["count"] for r in got} == {"com,example,one)/": 200, "com,example,one)/01": 10}


def test_look_ups_read_one_block_for_many_keys(spark, tmpdir_fresh):
    data = [(i, f"http://one.example.com/{i:04d}", "x") for i in range(2000)]
    archive = archive_of(spark, tmpdir_fresh, data)
    index = warc.build_index(archive, f"{tmpdir_fresh}/index", 64)
    fs, root = warc.open_folder(index.folder)
    one = warc._IndexFile(fs, root, index.ranges[0])
    keys = sorted(r.key for r in archive.records.collect())[:64]
    assert [h[0] for k in keys for h in one.find(k)] == keys and one.reads == 1


def test_files_of_other_attempts_are_not_read_and_changes_are_noticed(spark, tmpdir_fresh):
    data = [(1, "http://a/", "x" * 2000), (2, "http://b/", "x" * 2000)]
    archive = archive_of(spark, tmpdir_fresh, data)
    with open(f"{archive.folder}/lost-attempt.warc.gz", "wb") as f:
        f.write(b"half a rec")
    index = warc.build_index(archive, f"{tmpdir_fresh}/index")
    assert warc.read_archive(archive, index).count() == 2
    for name in {r.file for r in archive.records.collect()}:
        path = f"{archive.folder}/{name}"
        with open(path, "rb") as f:
            whole = b"".join(warc._members(f))
        if b"response\r\nWARC-Record" in whole:
            with open(path, "wb") as f:
                parts = whole.replace(b"xxxx", b"yyyy", 1)
                f.write(gzip.compress(parts))
    with pytest.raises(Exception, match="changed|wrong|index|Not a gzipped|Error"):
        warc.read_archive(archive, index).collect()


def test_empty_table(spark, tmpdir_fresh):
    archive = archive_of(spark, tmpdir_fresh, [])
    index = warc.build_index(archive, f"{tmpdir_fresh}/index")
    assert index.ranges == [] and warc.read_archive(archive, index).collect() == []
    assert warc.find_captures(index, spark.createDataFrame([("a",)], "prefix string")).collect() == []
    assert not os.path.exists(f"{tmpdir_fresh}/index") or os.listdir(f"{tmpdir_fresh}/index") == []


def test_url_keys():
    assert warc.url_key("http://www.Example.com:80/a?b=1#c") == "com,example,www)/a?b=1"
    assert warc.url_key("https://u:p@m.example.org:8443") == "org,example,m:8443)/"
    assert warc.url_key("") == "" and warc.url_key("plain words") == "plain%20words"
