from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexforge.llm.bpe import PrefixCoder, WordIds, load
from lexforge.llm.bpe_codec import Codec, encode_decode
from lexforge.llm.queries import vocabulary
from lexforge.llm.staging import new_path
from lexforge.llm.token_counts import Resync, count_tokens
from lexforge.llm.token_files import read_digests, read_document, write_ids

PATH = vocabulary()
ALPHABET = "abAB '’.!<|endoftext|>é́Ω1 \n漢ſKİ\t-"


@pytest.fixture(scope="module")
def library():
    return load(PATH)


@pytest.fixture(scope="module")
def codec():
    return Codec(PATH)


@settings(max_examples=150, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(ALPHABET), st.characters(codec="utf-8")), max_size=60))
def test_codec_equals_the_library(library, codec, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert codec.encode(text) == ids
    assert codec.written(text) == (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False), len(ids))


def test_every_prefix_has_one_last_token(codec):
    """Against all pairs: of the tokens that end at a place, exactly one fits what stands before."""
    coder: PrefixCoder = codec.coder
    for word in ("unbelievable", "aaaaaaa", "entgegen", "zzyzx1", "ingthandre"):
        text = "".join(coder.letters[b] for b in word.encode()) + "\0"
        last: dict[int, tuple[int, int]] = {}
        for end in [*range(1, len(text) - 1), len(text)]:
            fits = [(t, n) for t, n in (m[1] for m in coder.match.iter(text[:end]) if m[0] == end - 1) if n == end or ((end - n) in last and coder._apart(last[end - n][0], t))]
            assert len(fits) == 1, (word, end)
            last[end] = fits[0]


def test_words_equal_the_library_in_bulk(library):
    random.seed(3)
    letters = "abcdefghijklmnopqrstuvwxyzéèäöñç"
    words = ["".join(random.choices(letters, k=random.randint(1, 18))) for _ in range(3000)]
    coder = PrefixCoder(PATH)
    assert [coder.word(w) for w in words] == [e.ids for e in library.encode_batch(words, add_special_tokens=False)]


def test_word_table_forgets_and_learns_again(library):
    random.seed(4)
    table = WordIds(PATH, limit=50)
    for _ in range(20):
        texts = ["".join(random.choices(ALPHABET + "cdefgh", k=80)) for _ in range(5)]
        assert [np.frombuffer(p, "<u4").tolist() for p in table.pack(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize(("chunk", "overlap"), [(120, 8), (64, 64), (300, 100)])
def test_chunks_splice_to_the_whole(library, chunk, overlap):
    random.seed(chunk)
    resync = Resync(WordIds(PATH), chunk, overlap)
    texts = ["".join(random.choices(ALPHABET, k=2000)) for _ in range(30)] + ["a" * 3000, "<|endoftext|>" * 90, "é" * 500 + " " + "́" * 700, " " * 1000, "word " * 500, "!?" * 900 + "x"]
    for t in texts:
        assert resync.ids(t).tolist() == library.encode(t, add_special_tokens=False).ids
    assert resync.widened > 0


def test_counts(spark, edges, nothing, library):
    got = count_tokens(edges, PATH, chunk_chars=5000)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    rows = sorted(map(tuple, got.collect()))
    want = sorted((r["doc_id"], len((r["text"] or "").encode()), n := len(library.encode(r["text"] or "", add_special_tokens=False).ids), n > 2048) for r in edges.collect())
    assert rows == want and count_tokens(nothing, PATH).collect() == []


def test_encode_decode(spark, edges, nothing, library):
    digests = sorted(map(tuple, encode_decode(edges, PATH, ids=False).collect()))
    want = []
    for r in edges.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert digests == sorted(want)
    full = {r["doc_id"]: r for r in encode_decode(edges, PATH).collect()}
    assert full[1]["ids"] == library.encode(edges.filter("doc_id = 1").head()["text"], add_special_tokens=False).ids
    assert encode_decode(nothing, PATH).collect() == []


def test_files_round_trip(spark, edges, nothing, library):
    path = new_path(spark, "files")
    write_ids(edges, path, PATH)
    got = sorted(map(tuple, read_digests(spark, path).collect()))
    want, at = [], 0
    for r in sorted(edges.collect(), key=lambda r: (r["doc_id"], r["text"] or "")):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want.append((r["doc_id"], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == sorted(want)
    assert read_document(spark, path, 1) == library.encode(edges.filter("doc_id = 1").head()["text"], add_special_tokens=False).ids + [1]
    assert read_document(spark, path, 2) == [1] and read_document(spark, path, 99) is None
    empty = new_path(spark, "files")
    write_ids(nothing, empty, PATH)
    assert read_digests(spark, empty).collect() == []


def test_files_with_a_trained_dictionary(spark, library):
    random.seed(1)
    docs = [(k, " ".join(random.choices("the of and river stone house walks never always blue green".split(), k=200))) for k in range(300)]
    path = new_path(spark, "files")
    write_ids(spark.createDataFrame(docs, "doc_id bigint, text string"), path, PATH)
    assert len(spark.read.parquet(f"{path}/dictionary").head()["dictionary"]) > 0
    assert read_document(spark, path, 123) == library.encode(docs[123][1], add_special_tokens=False).ids + [1]
    assert read_digests(spark, path).count() == 300


@pytest.mark.parametrize("n, ids, copies", [(1500, 10, 1), (400, 400, 5), (3, 1, 1)])
def test_the_dictionary_is_drawn_from_different_texts(spark, library, tmp_path, n, ids, copies):
    """However few ids there are and however many copies, it is there, and so are all rows in the files."""
    docs = [(k % ids, " ".join(f"word{(k * j) % 50}" for j in range(1, 40))) for k in range(n) for _ in range(copies)]
    path = str(tmp_path / "ids")
    write_ids(spark.createDataFrame(docs, "doc_id bigint, text string"), path, PATH)
    [r] = spark.read.parquet(f"{path}/dictionary").collect()
    assert len(r["dictionary"]) > 50
    assert (n < 10) or bytes(r["dictionary"][:4]) == b"\x37\xa4\x30\xec"  # a trained one, by the format's magic number
    got = read_digests(spark, path).orderBy("start").collect()
    assert [g["doc_id"] for g in got] == sorted(i for i, _ in docs)
    want = sorted((i, len(library.encode(t, add_special_tokens=False).ids) + 1) for i, t in docs)
    assert sorted((g["doc_id"], g["n_tokens"]) for g in got) == want
