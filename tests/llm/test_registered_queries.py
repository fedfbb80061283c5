"""The registered queries themselves, on small tables of awkward rows: against their SQL or brute force."""

from __future__ import annotations

import gzip
import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import compare

pytest.importorskip("tidewheel.llm")
from test_text_operators import corpus  # noqa: E402,F401

from tidewheel.llm import queries, sharding, warc  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):  # noqa: F811
    """The corpus with pages of equal payloads and vectors of repeated, null and zero rows."""
    path = tmp_path_factory.mktemp("tables")
    corpus.where("n_chars < 20000 OR n_chars IS NULL").coalesce(1).write.parquet(f"{path}/documents.parquet")
    long = "é" * 80
    pages = [(i, f"http://x/{i}", t) for i, t in enumerate([long, "short", None, "", long, "short", long + "!", long])]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    r = random.Random(2)
    unit = lambda: [r.gauss(0, 1) for _ in range(16)]
    base = unit()
    close = [[x + r.gauss(0, 0.05) for x in base] for _ in range(12)]
    vectors = [unit() for _ in range(30)] + close + [base, base, [0.0] * 16, None, [None, *base[1:]], [float("nan"), *base[1:]]]
    rows = [(i, v, r.choice([1, 2, None])) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{path}/embeddings.parquet")
    for name in ("region nation customer supplier part orders lineitem events benchmark labels conversations").split():
        spark.range(0).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="module")
def tables(folder, tmp_path_factory):
    """The same tables as single files, as the comparison reads them."""
    import pyarrow.parquet as pq

    path = tmp_path_factory.mktemp("files")
    for name in "documents pages embeddings region nation customer supplier part orders lineitem events benchmark labels conversations".split():
        pq.write_table(pq.read_table(f"{folder}/{name}.parquet"), f"{path}/{name}.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["op3_warc", "op4_fixed_block_anchors", "op7_token_group_matrix", "op8_int8_tiles"])
def test_equal_to_sql(spark, tables, name):
    assert compare(spark, queries.queries()[name], queries.oracle_sql()[name], tables) == []


def test_sharding(spark, tables):
    """Groups stay whole, slots have no gaps, and no shard is far above the mean unless one group is."""
    import pyarrow.parquet as pq

    texts = pq.read_table(f"{tables}/documents.parquet").to_pylist()
    rows = queries.op2_sharding(spark, tables).collect()
    size = {d["doc_id"]: len((d["text"] or "").encode()) + 1 for d in texts}
    crc = {d["doc_id"]: zlib.crc32((d["text"] or "").encode()) for d in texts}
    assert {r.doc_id: (r.size, r.text_crc32, r.law, r.grown_shard) for r in rows} == {
        i: (size[i], crc[i], "bytes", None) for i in size
    }
    homes = defaultdict(set)
    for r in rows:
        homes[crc[r.doc_id]].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    held, groups = Counter(), Counter()
    for r in rows:
        held[r.shard] += r.size
        groups[crc[r.doc_id]] += r.size
    largest = max(groups.values())
    assert max(held.values()) <= max(largest, 1.05 * sum(held.values()) / 8)


@pytest.mark.parametrize("capacity", [1, 63, 64, 4096, 10**7])
def test_tightest_bins(capacity):
    """Each item enters the bin that a sorted list of rooms gives, whatever the digits of the rooms."""
    r = random.Random(capacity)
    for most in (None, 5):
        bins, rooms, used = sharding.OpenBins(capacity, most), [], 0
        for size in sorted((r.randint(1, capacity) for _ in range(600)), reverse=True):
            at = bisect_left(rooms, (size, -1))
            if at < len(rooms):
                room, name = rooms.pop(at)
            elif most is None or used < most:
                room, name, used = capacity, used, used + 1
            else:
                assert bins.put(size) is None
                continue
            insort(rooms, (room - size, name))
            assert bins.put(size) == name


def test_shards_by_best_fit_decreasing():
    sizes = np.array([9, 8, 7, 6, 5, 5, 4, 4, 3, 3, 3, 3], dtype=np.int64)
    homes = sharding.pack_shards(sizes, 4)
    held = np.bincount(homes, sizes, 4)
    assert held.sum() == sizes.sum() and held.max() <= 16


def test_unwanted_payloads_stay_packed(spark, tmp_path):
    """A body that cannot be unpacked harms only those who ask for it."""
    pages = spark.createDataFrame([(i, f"u{i}", f"{i} " * 100) for i in range(4)] + [(9, "u9", "0 " * 100)], "page_id long, url string, html string")
    folder = warc.write_archive(pages.coalesce(1), str(tmp_path / "w"))
    file = next((tmp_path / "w").glob("*.warc"))
    data = file.read_bytes()
    at = data.index(b"\x1f\x8b")
    file.write_bytes(data[:at] + bytes(10) + data[at + 10 :])
    read = lambda rule: [r.page_id for r in warc.read_archive(spark, folder).where(rule).collect()]
    assert read("record_type = 'revisit'") == [9] and sorted(read("page_id IN (2, 3)")) == [2, 3]
    with pytest.raises(Exception, match="gzip"):
        read("record_type = 'response'")


def test_archives_of_others(spark, tmp_path):
    def record(kind: str, uri: str, block: bytes) -> bytes:
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Length: {len(block)}\r\n\r\n"
        return head.encode() + block + b"\r\n\r\n"

    plain = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\nhello"
    untrue = b"HTTP/1.1 200 OK\r\nContent-Encoding: gzip\r\n\r\nnot packed"
    folder = tmp_path / "others"
    folder.mkdir()
    (folder / "a.warc").write_bytes(record("warcinfo", "i", b"about") + record("response", "p", plain))
    (folder / "b.warc.gz").write_bytes(
        gzip.compress(record("request", "q", b"GET /")) + gzip.compress(record("response", "q", untrue))
    )
    (folder / "notes.txt").write_text("no archive")
    rows = warc.read_archive(spark, str(folder), manifest=False).collect()
    assert sorted((r.record_type, r.url, r.payload and bytes(r.payload)) for r in rows if r.payload) == [
        ("response", "p", b"hello"), ("response", "q", b"not packed")
    ]
    assert len(rows) == 4 and all(r.page_id is None for r in rows)
    asked = warc.read_archive(spark, str(folder), manifest=False).where("record_type = 'request'")
    assert [r.url for r in asked.collect()] == ["q"]
