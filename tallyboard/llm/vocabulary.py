"""A bounded vocabulary of words, read from the counts of a whole corpus.

Words are runs of letters and digits, A-Z in lower case, and are counted in `CELLS` cells by the
hash of the word, so that a count of a corpus has `CELLS` numbers whatever its words. The
commonest cells are tokens of their own, which a common word has almost to itself; all other
cells share the last tokens, `cell % folded`. So every word of every text is a token, and
no table grows with the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallyboard.llm import bytearrays as B

CELLS = 1 << 16


def cells_of(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The cell of every word of small letters."""
    return (B.span_hashes(lower, starts, ends) >> np.uint64(48)).astype(np.int64)


def cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The cell of every word of the rows, and the index of each row's first word."""
    data, at = B.text_buffers(column)
    data = B.LOWER[data]
    starts, ends, first = B.word_spans(data, at, B.NOT_ALNUM)
    return cells_of(data, starts, ends), first


def token_table(cell: np.ndarray, count: np.ndarray, size: int, folded: int) -> np.ndarray:
    """The token of every cell: by falling counts, then by cell, the first `size - folded` have one each."""
    table = (size - folded + np.arange(CELLS) % folded).astype(np.uint16)
    order = np.lexsort((cell, -count))[: size - folded]
    table[cell[order]] = np.arange(len(order))
    return table
