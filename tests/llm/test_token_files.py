import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from threadloom.llm import token_files as tf

BYTES = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=200))
def test_bits_round_trip_at_every_width(width, values):
    ids = np.asarray(values, np.uint64) & np.uint64((1 << width) - 1)
    packed = tf.pack_bits(ids, width)
    assert len(packed) == 8 * width * -(-len(ids) // 64)
    assert tf.unpack_bits(packed, width, len(ids)).tolist() == ids.tolist()
    bits = int.from_bytes(packed, "little")
    assert [(bits >> (i * width)) & ((1 << width) - 1) for i in range(len(ids))] == ids.tolist()


@pytest.mark.parametrize(("vocabulary", "width"), [(1, 1), (2, 1), (3, 2), (256, 8), (257, 9), (49408, 16), (65536, 16), (65537, 17)])
def test_width_is_the_least(vocabulary, width):
    assert tf.id_width(vocabulary) == width


def test_file_gives_documents_in_order_and_at_random():
    rng = np.random.default_rng(0)
    docs = [(i if i % 3 else None, rng.integers(0, 1000, n).astype(np.uint32)) for i, n in enumerate([5, 0, 300, 64, 1, 1000, 127])]
    out = io.BytesIO()
    writer = tf.TokenFileWriter(out, 1000, block_ids=128)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    data = out.getvalue()
    file = tf.TokenFile(pa.BufferReader(data))
    assert file.width == 10 and len(file.offsets) - 1 == -(-sum(len(x) for _, x in docs) // 128)
    read = [(d, ids.tolist()) for d, _, ids in file.documents()]
    assert read == [(d, x.tolist()) for d, x in docs]
    assert [file.document(i).tolist() for i in range(len(docs))] == [x.tolist() for _, x in docs]
    damaged = bytearray(data)
    damaged[-60] ^= 1
    with pytest.raises(ValueError, match="damaged|not a token"):
        tf.TokenFile(pa.BufferReader(bytes(damaged)))


def test_odd_rows_round_trip(odd_documents, no_documents):
    rows = tf.token_digest(odd_documents.repartition(3), BYTES).orderBy("start").collect()
    library = Tokenizer.from_file(BYTES)
    wanted = [np.asarray([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4") for r in odd_documents.collect()]
    assert sorted((len(x), zlib.crc32(x.tobytes())) for x in wanted) == sorted((r.n_tokens, r.ids_crc32) for r in rows)
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known) and all(r.doc_id is None for r in rows[:2])
    assert tf.token_digest(no_documents, BYTES).count() == 0
