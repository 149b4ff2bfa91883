import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from threadloom.llm import packing, tokens
from threadloom.llm.tokens import ChunkEncoder

WORDS = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60))
def test_windows_fill_all_but_the_last_fraction(lengths):
    capacity = 32
    pieces, used, count = packing.pack_window(np.asarray(lengths, np.int64), capacity)
    assert count == -(-sum(lengths) // capacity) and used.sum() == sum(lengths) and (used <= capacity).all()
    for document, length in enumerate(lengths):
        own = sorted(pieces[pieces[:, 0] == document].tolist(), key=lambda p: p[1])
        assert [p[1] for p in own] == [0, *np.cumsum([p[2] for p in own])[:-1]]
        assert sum(p[2] for p in own) == length
    for sequence in range(count):
        own = sorted(pieces[pieces[:, 3] == sequence].tolist(), key=lambda p: p[4])
        assert [p[4] for p in own] == [0, *np.cumsum([p[2] for p in own])[:-1]]


def test_descending_pieces_go_to_the_cheapest_sequence_with_room():
    lengths = np.asarray([10, 9, 8, 7, 6, 5, 4, 3, 2, 1])
    pieces, _, count = packing.pack_window(lengths, 20)
    used, cost = np.zeros(count), np.zeros(count)
    for _, _, length, sequence, offset in sorted(pieces.tolist(), key=lambda p: -p[2]):
        fits = [s for s in range(count) if used[s] + length <= 20]
        assert cost[sequence] == min(cost[s] for s in fits) and offset == used[sequence]
        used[sequence] += length
        cost[sequence] += packing.piece_cost(length)


def test_padding_spares_powers_of_two():
    assert packing.padding(np.asarray([1, 3, 1024, 2047, 2048]), 2048).tolist() == [0, 2045, 0, 1, 0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunks_give_the_library_ids(spark, name):
    path = public_tokenizers.path(name)
    own, library = ChunkEncoder(path), Tokenizer.from_file(path)
    assert own.words_by_model
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["", " ", "  a  b\n\n c\td ", "it's don't 12 3.4, x. y,. z.,", "<|endoftext|> hi", "a <|startoftext|>b <|ENDOFTEXT|>", "<|end", "Ü “q” é. É, é", "a　b\x1cc\x85d", "ΣΑΣ. İ.", "\r\n x\n\n y \n", "q" * 3000]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text[:60]


PARTS = [" ", "  ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "a", "Wordly", "É", "İ", "Σ", "σς", "ﬁ", "e\u0301", "\u0301", "'", "'s", "'LL", "\u2019t",
         ",", ".", "--", "<|", "<|endoftext|>", "12", "9", "²", "½", "٣", "漢字", "\U0001f600", "ß", "łódź", "ŉ", "_", "\x00", "\x7f", "\xad", "K", "Å"]
ENCODERS = {n: (ChunkEncoder(public_tokenizers.path(n)), Tokenizer.from_file(public_tokenizers.path(n))) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=14).map("".join), max_size=4))
def test_any_text_gives_the_library_ids(texts):
    for own, library in ENCODERS.values():
        got = [ids.tolist() for ids in own.encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_forgotten_chunks_are_learnt_again(monkeypatch, prose):
    monkeypatch.setattr(tokens, "_REMEMBERED", 50)
    own, library = ChunkEncoder(WORDS), ENCODERS["word_bpe_49k.json"][1]
    for seed in (1, 2, 1, 3, 2, 2):
        text = prose(seed, 80)
        assert own.encode([text, None])[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(own.newer) <= 50 and len(own.older) <= 100


def test_odd_rows_keep_every_id_once(odd_documents, no_documents):
    rows = packing.pack_documents(odd_documents, WORDS, keep_ids=True, window_tokens=50_000).toPandas()
    library = Tokenizer.from_file(WORDS)
    wanted = sorted(
        [*library.encode(r.text or "", add_special_tokens=False).ids, packing.END_ID] for r in odd_documents.collect()
    )
    rows["doc_id"] = rows["doc_id"].fillna(-1)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows.itertuples())
    whole = rows[(rows.start == 0) & (rows.length == rows.doc_tokens)]
    ids = [np.frombuffer(x, "<u4").tolist() for x in whole.ids]
    assert all(x in wanted for x in ids)
    assert rows.length.sum() == sum(map(len, wanted))
    for _, own in rows.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]] and own.length.sum() <= 2048
    assert packing.pack_documents(no_documents, WORDS).count() == 0
