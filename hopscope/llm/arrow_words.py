"""Words of whole Arrow batches, without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The most text, in bytes, that is worked on at once; a longer text makes a piece of its own.
PIECE_BYTES = 8 << 20


def pieces(batch: pa.RecordBatch, column: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts (``column``) have ``most`` bytes at most, or one row."""
    size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(size, size[lo] + most, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes of all words, where each text's words begin (one entry more than
    texts), and the words that the codes stand for. Equal codes are equal words;
    a null text has none."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, row = split.flatten(), pc.list_parent_indices(split)
    word = pc.greater(pc.binary_length(flat), 0)
    flat, row = flat.filter(word), row.filter(word)
    held = flat.dictionary_encode()
    begin = np.searchsorted(row.to_numpy(zero_copy_only=False), np.arange(len(texts) + 1))
    return held.indices.to_numpy(zero_copy_only=False).astype(np.int64), begin, held.dictionary
