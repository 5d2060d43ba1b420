"""Words of a batch of texts as numbers: what separates them is ASCII white space, [\\x20\\x09-\\x0D]+."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def numbered_words(texts: list[str]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, the number of each word (equal words have equal numbers), and how many each text has."""
    words = [t.encode().split() for t in texts]  # bytes are split at just these six characters
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = pa.array((w for each in words for w in each), pa.large_binary(), size=int(counts.sum()))
    return words, flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), counts
