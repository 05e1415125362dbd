"""Words of whole texts as 64-bit hashes, a batch at a time.

Words are runs of bytes other than the six ASCII white-space ones (``[^\\x20\\x09-\\x0D]+``). Each distinct word
of a batch is hashed once; positions, runs of words and their hashes are numpy arrays over the whole batch.
Equal hashes are taken for equal words: over 64 bits, two words of a text differ and collide with a chance
below 1e-9 even among a million of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_SPACES = bytes.maketrans(b"\t\n\v\f\r", b"     ")
SPACES = bytes(range(256)).translate(_SPACES)
LOWER_SPACES = bytes(range(256)).lower().translate(_SPACES)


def mapped(texts: pa.Array, table: bytes) -> pa.Array:
    """The texts with each byte replaced by its entry of ``table`` (which must leave bytes over 127 alone)."""
    texts = pa.concat_arrays([texts.cast(pa.large_string())])  # whole buffers, also where ``texts`` is a slice
    _, offsets, data = texts.buffers()
    data = pa.py_buffer(data.to_pybytes().translate(table)) if data is not None else data
    return pa.LargeStringArray.from_buffers(len(texts), offsets, data, offset=texts.offset)


def split_words(texts: pa.Array, lower: bool) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, index of each word of the batch among them, start of each text's words; one more at the end)."""
    lists = pc.split_pattern(mapped(texts, LOWER_SPACES if lower else SPACES), " ")
    flat = lists.flatten()
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype("i8")
    there = pc.greater(pc.binary_length(flat), 0)
    seen = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))]).astype("i8")
    coded = flat.filter(there).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype("i8"), seen[ends]


def hashed_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word of the batch, start of each text's words; one more at the end)."""
    distinct, index, starts = split_words(texts, lower)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.cast(pa.large_binary()).to_numpy(zero_copy_only=False)), "u8", len(distinct))
    return hashes[index], starts


_ODD = np.random.default_rng(20250101).integers(0, 1 << 64, 64, dtype="u8") | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (xor-shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (the last ``k - 1`` positions have none)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, "u8")
    out = np.zeros(n, "u8")
    for j in range(k):
        out += words[j:j + n] * _ODD[j % len(_ODD)]
    return mixed(out)


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Per text its distinct ``k``-word shingles, sorted; fewer words are one shingle, no word is no shingle."""
    words, starts = hashed_words(texts)
    every = runs(words, k)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(every[a:b - k + 1]))
        elif b > a:
            out.append(runs(words[a:b], b - a) + np.uint64(b - a))
        else:
            out.append(np.zeros(0, "u8"))
    return out
