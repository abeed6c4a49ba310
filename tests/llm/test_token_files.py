import random
import zlib

import numpy as np
import pytest
from edge import ROWS, SCHEMA, documents
from tokenizers import Tokenizer

from tallystar.llm import pieces, queries, token_files
from tallystar.llm.common import filesystem
from tallystar.sources.shared import fresh_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(queries.TOKENIZER)
    found.encode_special_tokens = True
    return found


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_query_by_brute_force(spark, tokenizer):
    want, start = [], 0
    for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(whole(tokenizer, r.text), "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.op10_token_files(spark, SF).collect())) == want


def test_pieces_give_the_ids_of_the_whole_text(tokenizer):
    texts = [r[1] for r in ROWS] + ["<|endoftext|> it's  'tis\n\n\n x", " 're", "a　 b"]
    got = token_files.encode_texts(queries.TOKENIZER, texts, 2)
    assert [g.tolist() for g in got] == [whole(tokenizer, t) for t in texts]


def test_long_runs_of_words_are_cut_at_the_words(tokenizer):
    """More unknown words than one call joins, in scripts of one to four bytes a letter."""
    r = random.Random(2)
    letters = "abcdefghijklmnop" "éßñçøü" "жщюя" "漢字仮名" "𐐀𐐁"
    texts = ["".join(" " + "".join(r.choices(letters[a:b], k=r.randint(1, 9))) for _ in range(400))
             for a, b in ((0, 16), (16, 26), (26, 32), (0, 32))]
    got = token_files.encode_texts(queries.TOKENIZER, texts, 2)
    assert [g.tolist() for g in got] == [whole(tokenizer, t) for t in texts]


def test_a_full_table_is_begun_anew_without_encoding_known_pieces(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_PIECES", 4)
    asked = []

    def encode(some):
        asked.append(sorted(some))
        return [p.encode() + b"|" for p in some]

    table = pieces.PieceTable(encode)
    assert table.packed(["a b", "a"]) == [b"a| b|", b"a|"]
    assert table.packed(["a b c d", " d b"]) == [b"a| b| c| d|", b" d| b|"]
    assert table.packed(["a b c d e"]) == [b"a| b| c| d| e|"]
    assert asked == [[" b", "a"], [" c", " d"], [" e"]]


def test_files_hold_every_row_and_single_documents(spark, tokenizer, monkeypatch):
    docs, folder = documents(spark), fresh_path(spark, "tokens")
    files = token_files.write(docs, folder, queries.TOKENIZER)
    rows = token_files.read(files, folder).orderBy("start").collect()
    by_id = {r[0]: r[1] for r in ROWS}
    assert [r.id for r in rows] == [None, 1, 1, 2, 3, 4, 6, 7]
    start = 0
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert ids == whole(tokenizer, by_id[r.id]) and (r.start, r.n_tokens) == (start, len(ids))
        start += len(ids)
    first = files.orderBy("start").first()
    assert token_files.read_document(folder, first.file, 0).tolist() == whole(tokenizer, by_id[None])
    fs, root = filesystem(folder)
    with fs.open_output_stream(f"{root}/dictionary") as out:
        out.write(b"another")
    with pytest.raises(Exception, match="dictionary"):
        token_files.read_document(folder, first.file, 0)


def test_a_trained_dictionary_makes_short_frames(spark):
    docs = spark.createDataFrame([(i, f"the same opening words each time, and number {i}", "", "", 0)
                                  for i in range(900)], SCHEMA)
    data = token_files.train_dictionary(docs, queries.TOKENIZER, 2, 2, id_col="doc_id", text_col="text")
    assert 0 < len(data) <= token_files.DICTIONARY_BYTES
    folder = fresh_path(spark, "tokens")
    files = token_files.write(docs, folder, queries.TOKENIZER)
    assert token_files.read(files, folder).count() == 900
    fs, root = filesystem(folder)
    with fs.open_input_file(f"{root}/{files.first().file}") as source:
        entries, _, width = token_files.open_index(source)
    assert width == 2 and entries["length"].mean() < entries["ids"].mean() * width


def test_empty_table(spark):
    folder = fresh_path(spark, "tokens")
    files = token_files.write(documents(spark).limit(0), folder, queries.TOKENIZER)
    assert files.count() == 0 and token_files.read(files, folder).count() == 0


def test_added_tokens_as_the_unchanged_library(spark):
    library = Tokenizer.from_file(queries.TOKENIZER)
    texts = ["one <|endoftext|> two", "none here", "<|endoftext|><|endoftext|>", None,
             "it's  <|endoftext|>  'tis\n\n<|endoftext|", "é<|endoftext|>漢 \n <|endoftext|>\n"]
    want = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert want[0] == [505, 220, 50256, 734, 2]
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], SCHEMA)
    folder = fresh_path(spark, "tokens")
    rows = token_files.read(token_files.write(docs, folder, queries.TOKENIZER), folder).orderBy("id")
    start = 0
    for r, ids in zip(rows.collect(), want, strict=True):
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and (r.start, r.n_tokens) == (start, len(ids))
        start += len(ids)
