"""Token files, WARC archives and URL filters."""

import base64
import gzip
import hashlib
import random

import numpy as np
import pytest
from corpus_fixtures import write_tables
from pyspark.sql.functions import spark_partition_id

from palate.llm import token_counts, url_filters, warc
from palate.llm.files import coalesced


# -- token files ---------------------------------------------------------------------------------


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 20])
@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_lengths_whatever_the_block(spark, tmp_path, block, kind):
    r = random.Random(block)
    want = {}
    for f in range(3):
        docs = [[r.randrange(100) for _ in range(r.choice([0, 0, 1, 5, 90]))] for _ in range(20)]
        flat = [t for d in docs for t in (*d, 50256)]
        rest = [7, 8, 9] if f == 1 else []
        raw = np.array(flat + rest, kind).tobytes() + b"\x01" * (f == 2)
        (tmp_path / f"{f}.tokens").write_bytes(raw)
        want[f"{f}.tokens"] = [(len(d), True) for d in docs] + [(3, False)] * bool(rest)
    (tmp_path / "3.tokens").write_bytes(b"")
    files = token_counts.token_files(spark, str(tmp_path))
    got = {}
    for x in token_counts.document_lengths(files, kind=kind, block=block).orderBy("path", "ordinal").collect():
        name = x.path.rsplit("/", 1)[1]
        assert x.ordinal == len(got.setdefault(name, []))
        got[name].append((x.n_tokens, x.ended))
    assert got == want


def test_token_counts_of_documents(spark, odd, none, tmp_path):
    import public_tokenizers
    import tiktoken

    with open(token_counts.ranks_file(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    folder = write_tables(spark, tmp_path / "a", documents=odd)
    got = token_counts.op1_token_counts(spark, folder)
    want = sorted(((r.doc_id, len(e.encode_ordinary(r.text or ""))) for r in odd.collect()), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert token_counts.op1_token_counts(spark, write_tables(spark, tmp_path / "b", documents=none)).count() == 0


# -- WARC ----------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, file string"


def pages(spark):
    rows = [
        (1, "http://a/ü?x y\r\nEvil: 1", "same", "f"), (5, None, "same", None), (3, "http://b", "", "f"), (2, "http://c", None, "f"),
        (None, "http://d", "same", "f"), (None, "http://e", "only null id", "f"), (None, "http://e", "only null id", "f"),
        (7, "http://f", "x" * 300_000, "f"), (8, "http://f", "Content-Length: 3\r\n\r\nabc", "f"), (9, "http://g", "ümlaut\r\n\r\n", "f"),
        (9, "http://g", "ümlaut\r\n\r\n", "f"),
    ]
    return spark.createDataFrame(rows, PAGES), rows


def test_records_come_back(spark, tmp_path):
    df, rows = pages(spark)
    index = warc.write_archives(df, f"{tmp_path}/w")
    got = warc.read_archives(index).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.record_type == "response":
            payload = bytes(r.payload)
            assert r.payload_bytes == len(payload) and r.refers_to is None
            assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    kinds = sorted((str(r.page_id), r.record_type, str(r.refers_to), r.payload_bytes) for r in got)
    assert kinds == sorted([
        ("1", "response", "None", 4), ("5", "revisit", "1", 4), ("None", "revisit", "1", 4), ("3", "revisit", "2", 0), ("2", "response", "None", 0),
        ("None", "response", "None", 12), ("None", "revisit", "None", 12), ("7", "response", "None", 300_000),
        ("8", "response", "None", 24), ("9", "response", "None", 11), ("9", "revisit", "9", 11),
    ])
    for r in index.collect():  # every member opens by itself at its place
        with open(r.file.removeprefix("file:"), "rb") as f:
            f.seek(r.offset)
            assert gzip.decompress(f.read(r.length)).startswith(b"WARC/1.1\r\n")
    chosen = warc.read_archives(index.where("url = 'http://f'"))
    assert sorted(r.page_id for r in chosen.collect()) == [7, 8]


def test_least_bytes(spark, tmp_path):
    df, _ = pages(spark)
    got = warc.read_archives(warc.write_archives(df, f"{tmp_path}/w", least=10)).where("payload_bytes < 10").collect()
    assert {r.record_type for r in got} == {"response"}


def test_damage_is_seen():
    raw = warc.record(1, "u", b"abc", warc.base32_sha1(b"abc"), None, False)
    assert warc.parse(raw)["payload"] == b"abc"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(raw.replace(b"abc", b"abd"))


def test_reads_are_merged(spark):
    df = spark.createDataFrame([("f", 0, 10), ("f", 10, 5), ("f", 18, 2), ("f", 90, 5), ("g", 3, 1)], "file string, offset long, length long")
    got = {(r.file, r.start, r.stop, len(r.records)) for r in coalesced(df, [], 4, 1000).collect()}
    assert got == {("f", 0, 20, 3), ("f", 90, 95, 1), ("g", 3, 4, 1)}


def test_archives_are_read_by_as_many_tasks_as_their_bytes_need(spark, tmp_path, monkeypatch):
    r = random.Random(1)
    pages = [(i, f"u{i}", "".join(r.choice("abcdefghij") for _ in range(400))) for i in range(2000)]
    index = warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), str(tmp_path / "w"))
    monkeypatch.setattr(warc, "READ", 16 << 10)
    size = index.agg({"length": "sum"}).first()[0]
    out = warc.read_archives(index, payloads=False)
    used = out.select("page_id", spark_partition_id().alias("task")).collect()
    assert len(used) == 2000 and size > 20 * warc.READ
    assert len({x.task for x in used}) >= 0.5 * size / warc.READ  # dealt by hash, so some tasks get two reads


def test_no_pages(spark, tmp_path):
    folder = write_tables(spark, tmp_path, pages=spark.createDataFrame([], PAGES))
    assert warc.op8_warc(spark, folder).count() == 0
    assert url_filters.op5_url_filters(spark, folder).count() == 0


# -- URL filters ---------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "http://", "://x.com/", "HTTP://WWW.Example.COM/en/1?x#y", "http://example.com/EN/", "http://example.com/en", "http://a.b.example.com/en/",
    "http://notexample.com/en/", "http://com/", "http://x.net/es/1", "http://net/fr/", "http://x.net/fra", "http://ÄB.com/ü", "http://x.com", "http://x.com?en/",
    "http://x.com#://net/es/", "ftp://u:p@www.example.com:80/en/", "http://.com/", "http://x..com/", "http://com./",
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules):
    host, path = split(url)
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return (host, path, best and best[0] + best[1], best[2] if best else "allow")


def test_verdicts_equal_brute_force(spark):
    df = spark.createDataFrame([(i, u, "h", "mine") for i, u in enumerate(URLS * 2)], "page_id long, url string, html string, rule string")
    rules = spark.createDataFrame(list(url_filters.RULES), "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filters.judge(df, rules).collect()}
    assert got == {i: brute(u, url_filters.RULES) for i, u in enumerate(URLS * 2)}


def test_many_rules_over_several_shards(spark, monkeypatch):
    r = random.Random(4)
    rules = {(f"h{r.randrange(300)}.{r.choice(['com', 'net', 'co.uk'])}", r.choice(["/", "/a/", "/a/b", ""])): r.choice(["allow", "block"]) for _ in range(900)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [f"http://{r.choice(['', 'www.', 'x.y.'])}h{r.randrange(320)}.{r.choice(['com', 'net', 'co.uk'])}{r.choice(['', '/', '/a/', '/a/bc', '/b'])}" for _ in range(800)]
    monkeypatch.setattr(url_filters, "SHARD", 100)
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filters.judge(df, spark.createDataFrame(rules * 2, "host string, path string, verdict string")).collect()
    assert {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in got} == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_without_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert {(x.rule, x.verdict) for x in url_filters.judge(df, rules).collect()} == {(None, "allow")}


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    texts = [b"aa", b"bb", b"cc"]
    for part, data in (("keys", np.array([5, 5, 9], "<u8")), ("ends", np.array([2, 4, 6], "<i8")),
                       ("text", np.frombuffer(b"".join(texts), np.uint8)), ("block", np.array([0, 1, 1], np.uint8))):
        (tmp_path / f"s.{part}").write_bytes(data.tobytes())
    monkeypatch.setattr(url_filters.SparkFiles, "get", lambda name: str(tmp_path / name))
    shards = url_filters.Shards([{"name": "s", "lowest": 5}])
    assert shards.probe(np.array([5, 5, 5, 9, 1], np.uint64), ["bb", "aa", "zz", "cc", "aa"]).tolist() == [2, 1, 0, 2, 0]
