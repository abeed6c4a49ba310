import random
import re
import time

import public_tokenizers
import regex

from tallystar.llm import pieces

PATTERN = regex.compile(public_tokenizers.PATTERN)


def test_pieces_of_many_texts_are_the_matches_in_each():
    """Kinds of characters, white space, blanks and contractions side by side and at every end."""
    r = random.Random(1)
    parts = [*" ' s t r e v m l d S . ! \n \t \r     　 \x85 \x1c 1 ² ٣ é 漢 𐐀 🙂 ́".split(" "),
             " ", "  ", "'re", "'ll", "'ve", "''", " '", "\r\n"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 14))) for _ in range(20_000)]
    asked = []

    def encode(some):
        asked.extend(some)
        return [p.encode() + b"|" for p in some]

    got = pieces.PieceTable(encode).packed(texts)
    assert got == ["".join(f"{p}|" for p in PATTERN.findall(t)).encode() for t in texts]
    assert len(asked) == len(set(asked))
    assert all(pieces.split(t) == PATTERN.findall(t) for t in texts[:500])


def test_characters_are_decoded_alike_at_the_ends_of_slices(monkeypatch):
    monkeypatch.setattr(pieces, "_DECODED", 3)
    text = "aé漢𐐀 　 é1²𐐁'sé  漢 🙂🙂 "
    assert pieces.split(text) == PATTERN.findall(text)


def test_pieces_that_are_known_cost_less_than_finding_them_one_by_one():
    r = random.Random(2)
    words = ["".join(r.choices("abcdefghij", k=r.randint(2, 8))) for _ in range(5000)]
    texts = [" ".join(r.choices(words, k=500)) for _ in range(600)]
    table = pieces.PieceTable(lambda some: [p.encode() for p in some])
    table.packed(texts)
    known = {p: p.encode() for t in texts for p in PATTERN.findall(t)}
    find = re.compile(r" ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+").findall

    def one_by_one():
        return [b"".join(map(known.get, find(t))) for t in texts]

    def seconds(work):
        began = time.process_time()
        assert work() == [t.encode() for t in texts]
        return time.process_time() - began

    assert (min(seconds(lambda: table.packed(texts)) for _ in range(5))
            < min(seconds(one_by_one) for _ in range(5)))


def test_a_table_begun_anew_keeps_the_pieces_of_the_texts_at_hand(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_PIECES", 3)
    asked = []

    def encode(some):
        asked.append(sorted(some))
        return [p.encode() for p in some]

    table = pieces.PieceTable(encode)
    assert table.packed(["a b", "", "a c d"]) == [b"a b", b"", b"a c d"]
    assert table.packed(["a b c"]) == [b"a b c"]           # three of four were kept
    assert asked == [[" b", " c", " d", "a"]] and len(table._known) == 3
    assert table.packed([]) == [] and table.packed(["", ""]) == [b"", b""]
