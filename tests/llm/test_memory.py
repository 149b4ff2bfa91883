"""What one slice of texts takes in a worker."""

import tracemalloc

import pyarrow as pa
import public_tokenizers

from threadloom.llm import quality
from threadloom.llm.common import small_slices
from threadloom.llm.tokens import ChunkEncoder


def peak_of(run, texts) -> int:
    tracemalloc.start()
    for part in small_slices(texts):
        run(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak


def test_slices_bound_the_arrays_of_a_batch(prose):
    texts = pa.array([prose(i, 400) for i in range(3000)])
    assert pa.compute.sum(pa.compute.binary_length(texts)).as_py() > 4 << 20
    encoder = ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert peak_of(encoder.encode, texts) < 24 << 20
    assert peak_of(quality.document_statistics, texts) < 40 << 20
