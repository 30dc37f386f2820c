"""Token arrays as numbers, a block of documents at a time.

What counts or compares the tokens of many documents does so on their numbers in the block's
own list of words, in columns, and makes no row and no text per token. The functions are
local ones: they travel to the executors by value, which need no copy of this package.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docquarry.functions.fixed import CHARSET_RE, MIN_TOKEN_LENGTH

BLOCK_TOKENS = 500_000  # bounds what a task holds at once; a longer document is alone in its block


def token_blocks(most: int | None = None):
    """A function from Arrow batches with a column ``tokens`` to blocks of their rows: the
    rows, their numbers of tokens, a number per token (-1 for null), and the words."""
    most = most or BLOCK_TOKENS

    def blocks(batches):
        for batch in batches:
            tokens = batch.column("tokens")
            sizes = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            start = 0
            while start < len(sizes):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
                rows = batch.slice(start, stop - start)
                found = rows.column("tokens").flatten().dictionary_encode()
                numbers = found.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                yield rows, sizes[start:stop], numbers, found.dictionary
                start = stop

    return blocks


def successors():
    """A function from blocks' sizes and numbers to whether a token has a successor in its
    document, and neither is null."""

    def adjacent(sizes: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        both = np.zeros(len(numbers), bool)
        both[:-1] = (numbers[:-1] >= 0) & (numbers[1:] >= 0)
        both[np.cumsum(sizes)[sizes > 0] - 1] = False
        return both

    return adjacent


def valid_tokens():
    """A function from an array of words to whether they are kept: ``is_kept`` of
    ``functions.text``, asked once per word. Java's ``$`` also stands before a last line end."""
    inside = CHARSET_RE.removesuffix("$") + r"(?:\r\n|[\n\r\x{85}\x{2028}\x{2029}])?$"

    def valid(words: pa.Array) -> np.ndarray:
        held = pc.or_(pc.string_is_ascii(words), pc.match_substring_regex(words, inside))
        held = pc.and_(held, pc.greater_equal(pc.utf8_length(words), MIN_TOKEN_LENGTH))
        return held.to_numpy(zero_copy_only=False).astype(bool)

    return valid
