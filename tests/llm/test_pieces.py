"""Memory of the word kit: bounded by its pieces, whatever the batch."""

import tracemalloc

import pyarrow as pa

from ledgerloom.llm import textkit


def test_words_of_a_large_batch_take_little_memory():
    text = ("the quick brown fox jumps over it " * 60)[:2000]
    texts = pa.array([text] * 4000)
    tracemalloc.start()
    try:
        rows = sum(len(part) for _, part in textkit.pieces(texts) if len(textkit.Words(part, between=textkit.MARKS).hashes()))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 4000
    assert most < 24_000_000
