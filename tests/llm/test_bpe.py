"""Byte-level BPE against the tiktoken library, exact round trips, appends and edits."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from aerostar.llm import bpe

SMALL = "/root/testdata/sf0.001"
ALPHABETS = ["ab ", "the in  on\n\t'", "aA1 .,!'srevmld", "漢字かな éñü 🙂‍ ", "\xa0　  x\x1c\x85", "=-_#0", "\x00\x7fÿ "]


@pytest.fixture(scope="module", params=["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def both(request):
    v = bpe.read_vocabulary(public_tokenizers.path(request.param))
    return bpe.Encoder(v), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=v.rank,
                                             special_tokens={})


def texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        yield "".join(rng.choices(rng.choice(ALPHABETS), k=rng.choice([0, 1, 3, 9, 40, 300])))


def ids(packed):
    return np.frombuffer(packed, dtype=bpe.IDS).tolist()


def test_equals_the_library_and_decodes(both):
    enc, library = both
    for text in texts(1500, 1):
        got = enc.text(text)
        assert ids(got) == library.encode_ordinary(text), text
        assert enc.decoded(got) == text.encode()


def test_appends_and_edits_of_a_piece_equal_a_new_encoding(both):
    enc, _ = both
    rng = random.Random(2)
    for text in texts(300, 3):
        data = text.encode()
        cut = rng.randint(0, len(data))
        grown = bpe.Prefixes(enc, data[:cut])
        grown.append(data[cut:])
        assert grown.last == bpe.Prefixes(enc, data).last
        at, removed, added = rng.randint(0, len(data)), rng.randint(0, 5), rng.randbytes(rng.randint(0, 6))
        grown.edit(at, min(removed, len(data) - at), added)
        fresh = bpe.Prefixes(enc, grown.data)
        assert grown.data == data[:at] + added + data[at + removed:]
        assert grown.last == fresh.last and grown.ids() == fresh.ids()


def test_an_edit_of_a_long_piece_is_local(both, monkeypatch):
    enc, _ = both
    piece = bpe.Prefixes(enc, b"abcde" * 4000)
    places = []
    old = enc.ending

    def watched(text):
        for end, value in old(text):
            places.append(end)
            yield end, value

    monkeypatch.setattr(enc, "ending", watched)
    piece.edit(10_000, 1, b"xyz")
    assert piece.last == bpe.Prefixes(bpe.Encoder(enc.v), piece.data).last
    assert max(places) < 400


def test_edits_of_texts_equal_a_new_encoding(both):
    enc, library = both
    rng = random.Random(4)
    for text in texts(1500, 5):
        at, removed = rng.randint(0, len(text) + 2), rng.randint(0, 4)
        added = "".join(rng.choices("a 'rs\n漢1\xa0", k=rng.randint(0, 5)))
        new, packed, _ = enc.edited(text, enc.text(text), at, removed, added)
        assert new == text[:at] + added + text[at + removed:]
        assert ids(packed) == library.encode_ordinary(new), (text, at, removed, added)


def test_query_equals_the_library(spark):
    path = public_tokenizers.path(bpe.VOCABULARY)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_vocabulary(path).rank)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in bpe.op11_bpe(spark, SMALL).collect()}
    assert len(got) == len(docs)
    for d in docs:
        want = library.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


def test_odd_rows(spark):
    kind = "doc_id long, text string, IDS string, ids string, Text string"
    rows = [(1, None, "a", "b", "c"), (2, "", "", "", ""), (None, "x y", "", "", ""), (3, "w " * 30000, "", "", ""),
            (3, "w " * 30000, "", "", ""), (4, "'r", "", "", "")]
    docs = spark.createDataFrame(rows, kind)
    out = bpe.decode(bpe.encode(docs)).collect()
    assert sorted(bytes(r.decoded).decode() for r in out) == sorted(r[1] or "" for r in rows)
    assert all(r.n_tokens == len(r.ids) // 4 for r in out)
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0
    stored = spark.createDataFrame([(r.doc_id, bytes(r.decoded).decode(), bytes(r.ids)) for r in out if r.doc_id != 3],
                                   "doc_id long, text string, ids binary")
    edits = spark.createDataFrame([(4, None, None, "e!"), (2, 5, 1, None), (9, 0, 0, "z")],
                                  "doc_id long, at long, removed long, added string")
    new = {r.doc_id: r for r in bpe.edit(stored, edits).collect()}
    enc = bpe.Encoder(bpe.read_vocabulary(public_tokenizers.path(bpe.VOCABULARY)))
    assert {k: r.text for k, r in new.items()} == {1: "", 2: "", None: "x y", 4: "'re!"}
    assert all(bytes(r.ids) == enc.text(r.text) for r in new.values())
    assert new[None].anew == 0


def test_improper_vocabularies_are_refused_or_follow_the_library():
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0, b"ab": 1})
    ranks = {bytes([i]): i for i in range(256)} | {b"abc": 300}  # no merge makes it, the library takes it whole
    enc = bpe.Encoder(bpe.Vocabulary(ranks))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ("abc", "abcd", " abc abc", "xabc"):
        assert ids(enc.text(text)) == library.encode_ordinary(text)
