import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from edge import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tallystar.llm import bpe, queries
from tallystar.llm.pieces import PieceTable, split

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = bpe.Vocabulary.load(PATH)
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=VOCABULARY.ranks, special_tokens={})


def ids(texts):
    import numpy as np
    return [np.frombuffer(p, "<u4").tolist()
            for p in PieceTable(VOCABULARY.encode_pieces).packed(texts)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sdtrevlm.,!09aé漢🙂 　"),
                                           st.characters(exclude_categories=["Cs"]))), max_size=5))
def test_ids_as_the_public_library(texts):
    assert ids(texts) == [ENCODING.encode_ordinary(t) for t in texts]


def test_every_code_point_and_long_pieces():
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c}b {c} " for c in points[a:a + 4000]) for a in range(0, len(points), 40_000)]
    texts += ["a" * 5000, "ab" * 1777 + "é" * 300, " " * 999 + "x", "<|endoftext|>"]
    assert ids(texts) == [ENCODING.encode_ordinary(t) for t in texts]
    assert all("".join(split(t)) == t for t in texts)


def test_leftmost_of_equal_ranks_merges_first():
    toy = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257, b"ba": 258}
    small = bpe.Vocabulary(toy)
    encoding = tiktoken.Encoding("toy", pat_str=public_tokenizers.PATTERN, mergeable_ranks=toy,
                                 special_tokens={})
    for text in ("aaaaa", "baaaab", "abaaaba" * 9, "b"):
        packed = small.encode_pieces([text])[0]
        assert [int.from_bytes(packed[i:i + 4], "little") for i in range(0, len(packed), 4)
                ] == encoding.encode_ordinary(text)


def test_digests_and_edges(spark):
    docs = documents(spark)
    got = bpe.digests(docs, PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    found = sorted((r.doc_id or 0, r.n_tokens, r.decoded_sha256) for r in got.collect())
    want = sorted((r.doc_id or 0, len(ENCODING.encode_ordinary(r.text or "")),
                   hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
    assert found == want
    assert bpe.digests(docs.limit(0), PATH).count() == 0
    one = got.where("doc_id = 7").first()
    text = docs.where("doc_id = 7").first().text
    packed = b"".join(i.to_bytes(4, "little") for i in ENCODING.encode_ordinary(text))
    assert one.ids_sha256 == hashlib.sha256(packed).hexdigest()


def test_rank_file():
    with open(PATH, "rb") as lines:
        token, rank = next(lines).split()
    assert VOCABULARY.tokens[int(rank)] == base64.b64decode(token)
    with pytest.raises(KeyError):
        VOCABULARY.ranks[b"no such token at all"]


def test_round_trip_is_decode_of_encode(spark):
    docs = documents(spark)
    one = bpe.round_trip(docs, queries.RANKS)
    two = bpe.decode(bpe.encode(docs, queries.RANKS), queries.RANKS)
    assert one.columns == two.columns and one.exceptAll(two).count() == two.exceptAll(one).count() == 0


def test_long_pieces_take_little_time_each_and_merge_as_in_step(monkeypatch):
    import random
    import time
    r = random.Random(3)
    text = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    VOCABULARY.encode_pieces(["warm"])
    begun = time.perf_counter()
    one = VOCABULARY.encode_pieces([text])
    assert time.perf_counter() - begun < 2            # 0.2 s where nothing else runs
    assert ids([text]) == [ENCODING.encode_ordinary(text)]
    part = text[:700]
    plain = VOCABULARY.encode_pieces([part])
    monkeypatch.setattr(bpe, "IN_STEP", 0)
    assert VOCABULARY.encode_pieces([part]) == plain and len(one) == 1
