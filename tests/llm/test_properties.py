"""Round trips and guarantees over generated inputs."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tsforge.llm import bpe, golomb, html_text, media, repeats, simhash, simple8b, token_files

U64 = st.integers(0, (1 << 64) - 1)


@given(st.lists(U64, max_size=200))
def test_simple8b(values):
    words, _ = simple8b.encode(np.array(values, np.uint64))
    assert simple8b.decode(words, len(values)).tolist() == values


@given(st.lists(U64, max_size=200), st.integers(20, 63))
def test_golomb(values, rice):
    ordered = np.sort(np.array(values, np.uint64))
    assert golomb.decode(golomb.encode(ordered, max(rice, 50)), len(ordered), max(rice, 50)).tolist() == ordered.tolist()


@given(st.lists(st.tuples(st.none() | st.integers(-(1 << 63), (1 << 63) - 1), st.lists(U64, min_size=1, max_size=20)), min_size=1, max_size=20))
def test_blobs(docs):
    keys, lengths, ids = token_files.unpack(token_files.pack([k for k, _ in docs], [np.array(x, np.uint64) for _, x in docs]))
    assert keys == [k for k, _ in docs] and lengths.tolist() == [len(x) for _, x in docs] and ids.tolist() == [i for _, x in docs for i in x]


CODEC = bpe.Codec()


@settings(max_examples=300)
@given(st.text(max_size=200))
def test_bpe_round_trip(text):
    ids = CODEC.ids(text)
    assert ids.tolist() == CODEC.encoding.encode_ordinary(text) and CODEC.bytes(ids.tolist()) == text.encode()


@given(st.lists(st.integers(0, 3), max_size=80), st.integers(1, 6))
def test_equal_windows_have_equal_anchors(tokens, span):
    grams = np.array(tokens, np.uint64) * np.uint64(7919)
    at = repeats.anchors_of(grams, span)
    seen = {}
    for i, a in enumerate(at.tolist()):
        assert seen.setdefault(tuple(tokens[i : i + span]), a - i) == a - i


@given(st.lists(U64, min_size=1, max_size=40))
def test_forest_connects_what_links_connect(values):
    fps = np.unique(np.array(values, np.uint64))
    fps = np.unique(np.concatenate([fps, fps ^ np.uint64(5), fps ^ np.uint64(1 << 63)]))
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    n = len(fps)
    links = simhash.forest(fps)
    for i, j in links:
        assert (int(fps[i]) ^ int(fps[j])).bit_count() <= 3 and find(i) != find(j)
        root[find(i)] = find(j)
    assert all(find(i) == find(j) for i in range(n) for j in range(i) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 3)


@given(st.integers(1, 40), st.integers(1, 40), st.data())
def test_images(height, width, data):
    image = np.array(data.draw(st.lists(st.integers(0, 255), min_size=height * width, max_size=height * width)), np.uint8).reshape(height, width)
    assert (media.decode(media.encode_pgm(image)) == image).all() and (media.decode(media.encode_bmp(image)) == image).all()
    assert np.isclose(media.area_resize(image, 8, 9).mean(), image.mean())


@settings(max_examples=300)
@given(st.text(alphabet="<>/apdivscriptul &;=\"' \n-!", max_size=300))
def test_html_never_fails(page):
    text = html_text.main_text(page)
    assert "\n\n" not in text and text == text.strip()
