import hashlib
import io
import zlib

import numpy as np
import pytest

from tsforge.llm import media

ODD = [(None, "no id", None), (3, None, "s"), (4, "", "s"), (5, "a" * 576, None), (5, "a" * 576, None), (6, "é" * 30_000, "t")]


def test_netpbm_kinds():
    assert media.decode(b"P1\n# c\n3 2\n1 0 1\n0 1 0").tolist() == [[0, 255, 0], [255, 0, 255]]
    assert media.decode(b"P2 2 1 9\n4 9").tolist() == [[4, 9]]
    assert media.decode(b"P3 1 1 255 1 2 3").tolist() == [[[1, 2, 3]]]
    assert media.decode(b"P4\n3 2\n" + bytes([0b10100000, 0b01000000])).tolist() == [[0, 255, 0], [255, 0, 255]]
    assert media.decode(b"P5\n2 1\n65535\n\x01\x00\x00\x02").tolist() == [[256, 2]]
    assert media.decode(b"P6 1 1 255\n\x01\x02\x03").tolist() == [[[1, 2, 3]]]
    for bad in (b"", b"P5\n2 2\n255\n\x00", b"P7 1 1", b"BM"):
        with pytest.raises(ValueError):
            media.decode(bad)


def test_bmp_round_trip_and_colours():
    rng = np.random.default_rng(1)
    image = rng.integers(0, 256, (7, 5), dtype=np.uint8)
    assert (media.decode(media.encode_bmp(image)) == image).all()
    assert (media.decode(media.encode_pgm(image)) == image).all()
    import struct

    head = struct.pack("<2sIHHI IiiHHIIiiII", b"BM", 62, 0, 0, 54, 40, 2, -1, 1, 24, 0, 8, 0, 0, 0, 0)
    assert media.decode(head + bytes([3, 2, 1, 6, 5, 4, 0, 0])).tolist() == [[[1, 2, 3], [4, 5, 6]]]


@pytest.mark.parametrize("shape", [(8, 9), (24, 24), (5, 3), (1, 1), (101, 37)])
def test_area_resize_against_brute_force(shape):
    rng = np.random.default_rng(2)
    image = rng.integers(0, 256, shape)
    fine = np.kron(image, np.ones((8, 9)))
    want = fine.reshape(8, shape[0], 9, shape[1]).mean(axis=(1, 3))
    assert np.allclose(media.area_resize(image, 8, 9), want)


def test_tiles_hold_the_image():
    image = np.arange(30 * 50, dtype=np.uint8).reshape(30, 50)
    tiles = [np.load(io.BytesIO(t)) for t in media.npy_tiles(image)]
    assert len(tiles) == 6 and (tiles[0] == image[:24, :24]).all() and (tiles[5][:6, :2] == image[24:, 48:]).all()
    for kind, shape in ((np.uint8, (48, 24)), (np.uint16, (24, 24)), (np.uint8, (24, 48, 3))):
        image = (np.arange(np.prod(shape)) * 7).astype(kind).reshape(shape)
        for data in media.npy_tiles(image):
            assert (media.read_tile(data) == np.load(io.BytesIO(data))).all()
            np.save(same := io.BytesIO(), np.load(io.BytesIO(data)))
            assert same.getvalue() == data


def saved(payload):
    """The tiles of a payload, as numpy writes them."""
    out = []
    for i in range(0, len(payload), 576):
        np.save(buffer := io.BytesIO(), np.frombuffer(payload[i : i + 576], np.uint8).reshape(24, 24))
        out.append(buffer.getvalue())
    return b"".join(out)


def test_payloads(documents):
    found = media.payload_features(media.store_texts(documents(ODD, extra=True))).collect()
    assert len(found) == len(ODD)
    texts = {d: (t or "").encode() for d, t, _ in ODD}
    for r in found:
        data = texts[r.doc_id]
        payload = data.ljust(max(1, -(-len(data) // 576)) * 576, b"\xff")
        assert (r.n_bytes, r.payload_bytes) == (len(data), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-32:])
        stored = saved(payload)
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        assert r.feature == media.difference_hash(np.frombuffer(payload, np.uint8).reshape(-1, 24))
    assert media.payload_features(media.store_texts(documents([]))).count() == 0


def test_tiles_of_a_column(spark):
    image = np.arange(24 * 24, dtype=np.uint8).reshape(24, 24)
    df = spark.createDataFrame([(1, media.encode_pgm(image)), (2, None), (3, b"junk")], "id long, media binary")
    rows = {r.id: r for r in media.with_tiles(df.selectExpr("*", "'x' as height", "'y' as tiles"), errors="null").collect()}
    assert (rows[1].height, rows[1].channels, len(rows[1].tiles)) == (24, 1, 1) and rows[2].tiles is None and rows[3].dhash is None


def test_the_query_reads_the_tiles(spark, documents, monkeypatch):
    from tsforge.llm import queries

    docs = documents(ODD)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    found = queries.op10_media_columns(spark, "").collect()
    assert len(found) == len(ODD)
    texts = {d: (t or "").encode() for d, t, _ in ODD}
    for r in found:
        data = texts[r.doc_id]
        payload = data.ljust(max(1, -(-len(data) // 576)) * 576, b"\xff")
        image = np.frombuffer(payload, np.uint8).reshape(-1, 24)
        stored = saved(payload)
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (r.media_bytes, r.media_sha256, r.feature) == (len(stored), hashlib.sha256(stored).hexdigest(), media.difference_hash(image))
