import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from obslake.llm import bit_planes as bp
from obslake.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("ids", [[], [0], [1, 2**32 - 1, 49_407], list(range(70_000))])
def test_planes_round_trip(bits, ids):
    ids = np.array(ids, dtype="<u4")
    planes = bp.to_planes(ids, bits)
    assert len(planes) == (32 if bits else 4)
    assert bp.from_planes(planes, len(ids), bits).tolist() == ids.tolist()


@pytest.mark.parametrize("planes, block", [("byte", 1 << 16), ("bit", 64), ("byte", 7)])
def test_files_round_trip(spark, scratch, planes, block):
    texts = [(7, "b c d"), (3, None), (5, ""), (None, "no id"), (3, "twice"), (7, "b c d"), (-2, "long soup " * 5_000)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in texts], "doc_id bigint, text string, k string, `first` int")
    manifest = bp.write_token_files(df, scratch("planes"), tokenizer_path(), 2, planes, block)
    rows = sorted(bp.read_token_files(manifest).collect(), key=lambda r: r.start)
    whole = Tokenizer.from_file(tokenizer_path())
    assert [r.doc_id for r in rows] == [None, -2, 3, 3, 5, 7, 7]
    at = 0
    for r in rows:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    ids = lambda t: np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4").tobytes()
    assert sorted(bytes(r.ids) for r in rows) == sorted(ids(t) for _, t in texts)
    for part_ids in (700, 4_000):
        again = bp.read_token_files(manifest, part_ids)
        assert sorted(map(tuple, again.collect()), key=lambda r: r[1]) == list(map(tuple, rows))
    assert manifest.count() >= 1
    empty = bp.write_token_files(df.limit(0), scratch("planes"), tokenizer_path())
    assert empty.collect() == [] and bp.read_token_files(empty).collect() == []


def test_blocks_are_read_alone(tmp_path):
    path = tmp_path / "x.planes"
    with open(path, "wb") as sink:
        w = bp.Writer(sink, True, 10)
        w.add(1, np.arange(25, dtype="<u4").tobytes())
        w.close()
    store, name = bp.filesystem(path.as_uri())
    with store.open_input_file(name) as source:
        reader = bp.Reader(source)
        assert np.frombuffer(reader.block(2), "<u4").tolist() == [20, 21, 22, 23, 24]
        assert reader.docs == [(1, 25)]
    (tmp_path / "bad").write_bytes(b"0" * 100)
    with store.open_input_file(str(tmp_path / "bad")) as source, pytest.raises(ValueError):
        bp.Reader(source)


def test_only_the_blocks_of_a_part_are_read(tmp_path):
    path = tmp_path / "x.planes"
    with open(path, "wb") as sink:
        w = bp.Writer(sink, False, 10)
        for i in range(20):
            w.add(i, np.full(5, i, dtype="<u4").tobytes())
        w.close()
    store, name = bp.filesystem(path.as_uri())
    with store.open_input_file(name) as source:
        reader = bp.Reader(source)
        read, block = [], reader.block
        reader.block = lambda k: read.append(k) or block(k)
        found = list(reader.documents(37, 52))
        assert [(d, s, np.frombuffer(i, "<u4").tolist()) for d, s, i in found] == [(d, 5 * d, [d] * 5) for d in (8, 9, 10)]
        assert read == [4, 5]
        assert list(reader.documents(100, 200)) == [] and [d for d, _ in reader] == list(range(20))


def test_a_large_table_has_more_files(spark, scratch):
    df = spark.createDataFrame([(i, "some words " * 20) for i in range(60)], "doc_id bigint, text string")
    few = bp.write_token_files(df, scratch("planes"), tokenizer_path())
    many = bp.write_token_files(df, scratch("planes"), tokenizer_path(), file_bytes=600)
    assert few.count() <= 8 < many.count()
    assert sorted(map(tuple, bp.read_token_files(few).collect())) == sorted(map(tuple, bp.read_token_files(many).collect()))


def test_registered_query(spark):
    from obslake.llm.queries import op7_bit_plane_files

    whole = Tokenizer.from_file(tokenizer_path())
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    expected, at = [], 0
    for doc, text in docs:
        ids = np.array(whole.encode(text, add_special_tokens=False).ids + [2], "<u4")
        expected.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, op7_bit_plane_files(spark, SF).collect())) == expected
