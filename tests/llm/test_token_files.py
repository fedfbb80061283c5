"""Token-id files against the tokenizers library, and long words in token counts."""

import io
import random
import zlib

import numpy as np
import pytest


pytest.importorskip("tidewheel.llm")
from tidewheel.llm import queries, token_counts, token_files, warc  # noqa: E402

PATH = queries.tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("n,step", [(0, 1), (1, 0), (1000, 0), (1000, 3), (700, 1 << 40), (600, (1 << 64) // 700)])
def test_sequence_selects_and_searches(n, step):
    r = random.Random(n)
    values = np.sort(np.array([r.randrange(step + 1) + i * step for i in range(n)], dtype=np.uint64))
    shape, parts = token_files.Sequence.encode(values)
    seq = token_files.Sequence(io.BytesIO(b"".join(parts)), 0, shape)
    for a, b in [(0, n), (n // 3, n // 2), (max(0, n - 1), n)]:
        assert seq.select(a, b).view(np.uint64).tolist() == values[a:b].tolist()
    if step < 1 << 50:
        for x in [0, 1, *map(int, values[:: max(1, n // 9)]), int(values[-1]) + 1 if n else 5]:
            assert seq.search(x) == int((values < x).sum())
    if n == 700:
        assert shape["low_bytes"] + shape["high_bytes"] < n * 43 / 8 + 16  # 64 bits would take n * 8 bytes


def test_registered_query_equals_the_library(spark, sf_dir, library):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: tuple(r) for r in queries.op13_elias_fano_ids(spark, sf_dir).collect()}
    start = 0
    for doc_id, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert got[doc_id] == (doc_id, start, len(ids), crc(ids))
        start += len(ids)
    assert len(got) == len(docs)


@pytest.fixture(scope="module")
def odd(spark):
    r = random.Random(3)
    long = "".join(r.choice("abcdefgh") for _ in range(200_000))
    rows = [
        (5, "x" * 200_000, 1), (None, long, 1), (7, None, 2), (5, "a<|endoftext|>b \U0001F600 é▁ü ▁ x", 3),
        (5, "x" * 200_000, 1), (-3, "", 1), (1 << 62, "hi there", 1), (-(1 << 62), "hi", 1), (None, None, 4),
    ] + [(i, f"number {i}", 0) for i in range(1000, 3000)]
    return spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(7)


def test_edges_and_clashing_columns(spark, odd, library, tmp_path):
    token_files.write_token_files(odd, PATH, str(tmp_path / "ids"), end=2, partitions=3)
    back = token_files.read_token_files(spark, str(tmp_path / "ids"))
    got = sorted((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in back.collect())
    ids = [x[1] for x in got]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    assert [x[0] for x in got] == np.cumsum([0] + [x[2] for x in got])[:-1].tolist()
    want = sorted(
        (str(r.doc_id), np.array(library.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4").tobytes())
        for r in odd.collect()
    )
    assert sorted((str(x[1]), x[3]) for x in got) == want
    # the same rows through many small splits, and by bounds on doc_id
    small = spark.read.format("tokenids").option("width", 2).option("splitbytes", 1000).load(str(tmp_path / "ids"))
    assert small.rdd.getNumPartitions() > 100
    assert sorted((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in small.collect()) == got
    assert sorted(r.doc_id for r in small.where("doc_id > 2990 and doc_id <= 2995").collect()) == list(range(2991, 2996))
    assert back.where("doc_id = 5").count() == 3 and back.where("doc_id < -5").count() == 1


def test_bounds_narrow_what_is_read():
    reader = token_files.TokenReader("nowhere", 2)
    from pyspark.sql.datasource import EqualTo, GreaterThan, LessThanOrEqual

    given = [GreaterThan(("doc_id",), 4), LessThanOrEqual(("doc_id",), 9), EqualTo(("n_tokens",), 3)]
    assert list(reader.pushFilters(given)) == given and (reader.least, reader.most) == (5, 9)


def test_empty_table(spark, odd, tmp_path):
    token_files.write_token_files(odd.limit(0), PATH, str(tmp_path / "none"), end=2)
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_only_files_of_the_manifest_are_read(spark, odd, tmp_path):
    folder = tmp_path / "ids"
    token_files.write_token_files(odd, PATH, str(folder), end=2)
    some = next(folder.glob("*.ids"))
    (folder / "part-000000-lost.ids").write_bytes(some.read_bytes())
    assert token_files.read_token_files(spark, str(folder)).count() == odd.count()


def test_wide_ids_need_wide_files(spark, odd, tmp_path):
    with pytest.raises(Exception, match="does not fit"):
        token_files.write_token_files(odd, PATH, str(tmp_path / "ids"), end=1 << 17)


def test_token_counts_of_long_words(spark, odd, library):
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in token_counts.token_counts(odd, PATH).collect())
    want = sorted(
        (str(r.doc_id), len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids))
        for r in odd.collect()
    )
    assert got == want
    assert all(len(t) <= token_counts.LONGEST + 1 for t in token_counts.frequent_pretokens(odd, 100))


def test_registered_token_counts(spark, sf_dir, library):
    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for r in queries.op6_token_counts(spark, sf_dir).collect():
        n = len(library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit) == (n, n > 1024)


def test_archives_open_by_uri(tmp_path):
    assert warc.open_folder(f"file://{tmp_path}")[1] == str(tmp_path)
