"""Tokenising whole texts with the ``tokenizers`` library, each distinct unit of a text once.

Both vocabularies split a text before merging, and no merge crosses that split, so the ids of a text are
the ids of its units one after the other. Units are cut only where the split is certain; anything irregular
goes to the library whole. Splitting, distinct units and putting the ids back together are Arrow kernels over
a whole batch; the unit cache is bounded and lives as long as its Python worker.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from fleetlake.llm.common import remember
from fleetlake.llm.words import LOWER_SPACES, mapped

CACHE_UNITS = 1_000_000
CALL_UNITS = 4096
_LOADED: dict[str, tuple] = {}


def load(path: str):
    """The tokenizer at ``path``, its unit cache, and of each id whether it ends a word (``</w>``) or starts one
    (a space in byte-level form); once per process. Single-threaded: one Spark task per core."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        edge = np.zeros((2, tokenizer.get_vocab_size()), bool)
        for token, i in tokenizer.get_vocab().items():
            edge[0, i], edge[1, i] = token.endswith("</w>"), token.startswith("\u0120")
        _LOADED[path] = (tokenizer, {}, edge)
    remember("tokenizers", _LOADED.clear)
    return _LOADED[path]


def file_digest(path: str) -> str:
    """Version of a tokenizer: SHA-256 of its file."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _in_one_call(tokenizer, words: list[str], edge: np.ndarray, spaced: bool) -> list[np.ndarray] | None:
    """Ids of words made of letters only, from one call for all of them.

    Such a word is one piece for the tokenizer, so each has one edge: a token with an end mark, or, where
    the words begin with their space (``spaced``), a token that starts with it. None if the edges don't say so.
    """
    ids = np.array(tokenizer.encode_batch_fast(["".join(words) if spaced else " ".join(words)],
                                               add_special_tokens=False)[0].ids, dtype="<u4")
    at = np.flatnonzero(edge[1 if spaced else 0][ids])
    if len(at) != len(words):
        return None
    return np.split(ids, at[1:] if spaced else at[:-1] + 1)


def _encode(tokenizer, edge: np.ndarray, units: list[bytes], value) -> dict:
    """Unit -> value(ids), every unit encoded by the library on its own or beside words that can't touch it."""
    out: dict = {}
    groups: tuple[list, list, list] = ([], [], [])
    for u in units:
        t = u.decode()
        groups[0 if t.isalpha() else 1 if t[:1] == " " and t[1:].isalpha() else 2].append(t)
    for spaced in (0, 1):
        for i in range(0, len(groups[spaced]), CALL_UNITS):
            part = groups[spaced][i:i + CALL_UNITS]
            got = _in_one_call(tokenizer, part, edge, bool(spaced)) if edge[spaced].any() else None
            if got is None:
                groups[2].extend(part)
            else:
                out.update((t.encode(), value(e)) for t, e in zip(part, got, strict=True))
    for i in range(0, len(groups[2]), CALL_UNITS):
        part = groups[2][i:i + CALL_UNITS]
        got = tokenizer.encode_batch_fast(part, add_special_tokens=False)
        out.update((t.encode(), value(np.array(e.ids, dtype="<u4"))) for t, e in zip(part, got, strict=True))
    return out


def _values(loaded: tuple, units: list[bytes], value) -> list:
    """The value of every unit. Only units that are not in the cache go to the library.

    A comma or full stop at the end of a unit, after an ASCII letter, is always split off, so ``word.``
    is neither encoded nor kept once ``word`` is known.
    """
    tokenizer, cache, edge = loaded
    stems = [u[:-1] if u[-1:] in (b".", b",") and u[-2:-1].isalpha() else u for u in units]
    new = {u for u in stems if u not in cache}
    if len(cache) + len(new) > CACHE_UNITS:
        cache.clear()
        new = set(stems)
    new.update(u for u in (b".", b",") if u not in cache)
    cache.update(_encode(tokenizer, edge, list(new), value))
    return [cache[s] if len(s) == len(u) else cache[s] + cache[u[-1:]] for u, s in zip(units, stems, strict=True)]


class IdTable:
    """Ids of units, found by the units' 64-bit hashes: arrays of some 25 bytes a unit, where a dictionary takes 140.

    Two of a million units share a hash with a chance below 1e-7.
    """

    def __init__(self):
        self.keys, self.rows = np.zeros(0, "u8"), np.zeros(0, "i4")  # sorted hashes, and the row of each
        self.starts, self.lengths, self.ids = np.zeros(0, "i4"), np.zeros(0, "i4"), np.zeros(0, "<u4")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key; -1 where there is none."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == keys, self.rows[at], np.int32(-1)) if len(self.keys) else np.full(len(keys), -1, "i4")

    def add(self, keys: np.ndarray, values: list[np.ndarray]) -> None:
        lengths = np.array([len(v) for v in values], "i4")
        rows = len(self.starts) + np.arange(len(keys), dtype="i4")
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths, dtype="i4") - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, *values])
        keys, rows = np.concatenate([self.keys, keys]), np.concatenate([self.rows, rows])
        order = np.argsort(keys, kind="stable")
        self.keys, self.rows = keys[order], rows[order]


def _hashes(units: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, units), "u8", len(units))


def _unit_rows(loaded: tuple, table: IdTable, units: list[bytes]) -> np.ndarray:
    """Rows of the two parts of every unit: the unit, and the comma or full stop at its end (an empty row where there is
    none). After an ASCII letter these are always split off, so ``word.`` needs no row once ``word`` has one."""
    tokenizer, _, edge = loaded
    ends = [u[-1:] if u[-1:] in (b".", b",") and u[-2:-1].isalpha() else b"" for u in units]
    stems = [u[:len(u) - len(e)] for u, e in zip(units, ends, strict=True)]
    keys, marks = _hashes(stems), [b"", b".", b","]
    rows = table.find(keys)
    if len(table.keys) + np.count_nonzero(rows < 0) > CACHE_UNITS:
        table.__init__()
        rows[:] = -1
    unknown = np.flatnonzero(rows < 0)
    missing = {stems[i]: k for i, k in zip(unknown.tolist(), keys[unknown], strict=True)}
    missing.update((m, k) for m, k in zip(marks, _hashes(marks), strict=True) if table.find(np.array([k]))[0] < 0)
    if missing:
        got = _encode(tokenizer, edge, [u for u in missing if u], np.asarray)
        got[b""] = np.zeros(0, "<u4")
        table.add(np.array(list(missing.values()), "u8"), [got[u] for u in missing])
        rows[unknown] = table.find(keys[unknown])
    mark = dict(zip(marks, table.find(_hashes(marks)).tolist(), strict=True))
    return np.column_stack([rows, np.array([mark[e] for e in ends], "i4")]) if units else np.zeros((0, 2), "i4")


def _gathered(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` one after the other."""
    ends = np.cumsum(lengths, dtype="i4")
    at = np.repeat(starts - (ends - lengths), lengths)
    at += np.arange(len(at), dtype="i4")
    return ids[at]


def space_free_ids(path: str, texts: pa.Array) -> list[bytes]:
    """Ids (little-endian uint32) of each text, for tokenizers that lower case and drop white space.

    Splits on the six ASCII white-space bytes; other white space stays inside its unit for the library.
    """
    loaded = load(path)
    table = loaded[1].setdefault("ids", IdTable())
    lists = pc.split_pattern(mapped(texts, LOWER_SPACES), " ")  # other letters are lowered by the library
    words = lists.flatten().dictionary_encode()
    rows = _unit_rows(loaded, table, words.dictionary.cast(pa.large_binary()).to_pylist()).ravel()
    lengths = table.lengths[rows]
    ids = _gathered(table.ids, table.starts[rows], lengths)  # of each distinct unit
    each = lengths.reshape(-1, 2).sum(1, dtype="i4")
    index = words.indices.to_numpy()
    per_word = each[index]
    out = _gathered(ids, (np.cumsum(each, dtype="i4") - each)[index], per_word)
    at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype("i8")
    ends = np.concatenate([np.zeros(1, "i4"), np.cumsum(per_word, dtype="i4")])[at].tolist()
    return [out[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]


# white space other than single spaces and line feeds between visible characters; \0 marks the cuts below
_ODD = re.compile(r"[^\S\n ]|\s\s|\A\s|\s\Z|\0")


def byte_level_counts(path: str, texts: pa.Array) -> list[int]:
    """Number of ids of each text, for byte-level BPE that keeps one space with the word after it.

    Between visible characters a single space starts a new unit and a single line feed is a unit of its
    own. A text with any other white space is given to the library whole.
    """
    tokenizer = load(path)[0]
    plain = texts.to_pylist()
    odd = [i for i, t in enumerate(plain) if _ODD.search(t)]
    if odd:
        whole = [len(tokenizer.encode_batch_fast([plain[i]], add_special_tokens=False)[0]) for i in odd]
        texts = pa.array(["" if _ODD.search(t) else t for t in plain], pa.large_string())
    del plain
    cut = pc.replace_substring(pc.replace_substring(texts.cast(pa.large_string()), "\n", "\0\n\0"), " ", "\0 ")
    lists = pc.split_pattern(cut, "\0")
    units = lists.flatten().dictionary_encode()
    per = np.array(_values(load(path), units.dictionary.cast(pa.large_binary()).to_pylist(), len), dtype="i8")
    each = np.concatenate([[0], np.cumsum(per[units.indices.to_numpy()])])
    at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype("i8")
    counts = (each[at[1:]] - each[at[:-1]]).tolist()
    if odd:
        for i, n in zip(odd, whole, strict=True):
            counts[i] = n
    return counts
