"""Byte-level BPE encoding with the tokenizers library, each distinct piece of text once.

The vocabulary's pre-tokenizer never joins what stands before and after a single space (or newline) between
two characters that are no white space: such a space opens the next piece. A text can therefore be cut there, and
equal chunks have equal ids wherever they stand. Nor does it join ASCII letters, digits and other signs, an apostrophe before letters apart, so a
chunk is cut further where one of these follows another. A batch's texts are cut and its distinct chunks, and their distinct pieces, numbered by
Arrow; each piece is looked up once in a worker's tables of pieces that it has met, new ones are encoded by the library in one go, and the ids are
gathered from one array. The tables are bounded by bytes: a full one becomes the older one, and the older one goes.

The string of a special token in a text is ordinary text, or, with ``special_tokens``, becomes that token's id, as the library
does unless told otherwise. It holds no white space, so no cut goes through it; chunks that hold one are not cut further.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sftlake.llm.common import gathered, keeps

#: Bytes of each of a worker's two tables of chunks, and what an entry takes beside its chunk and ids.
CACHE_BYTES, ENTRY_BYTES = 64 << 20, 180
#: Longer chunks, as in scripts without spaces, are encoded each time and kept in no table.
MOST_CHUNK = 64

#: New pieces that the library gets as one text.
LEARN = 256

#: A piece opens with a mark, with a newline, or else with a space, which is left out.
_FIRST = "\x00"


def _bytes(*values: int) -> np.ndarray:
    """A table that tells these bytes from others."""
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


#: Bytes that can end and begin a white-space character beyond ASCII (U+0085, U+00A0, U+1680, U+2000 to 200A, 2028, 2029, 202F, 205F, U+3000).
_ENDS = _bytes(*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF)
_BEGINS = _bytes(0xC2, 0xE1, 0xE2, 0xE3)
#: ASCII letters 1, digits 2, other signs 3; any other byte 0. An apostrophe can belong to the letters behind it, not to those before it.
_RIGHT = np.array([1 if chr(c).isalpha() else 2 if chr(c).isdigit() else 3 if 32 < c < 127 else 0 for c in range(128)] + [0] * 128, np.uint8)
_LEFT = np.where(np.arange(256) == ord("'"), 0, _RIGHT).astype(np.uint8)


def _strings(raw: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The strings that begin at ``starts`` of these bytes; the first at 0."""
    offsets = np.append(starts, len(raw)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw))


def _chunks(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Texts cut at single spaces and newlines, and the number of each one's first chunk. Between bytes that may both belong to white space beyond
    ASCII there is no cut."""
    marked = [(_FIRST + t).encode() for t in texts]
    raw = np.frombuffer(b"".join(marked) + b"\x00", np.uint8)
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    at = np.flatnonzero((raw == 32) | (raw == 10))
    before, after = raw[at - 1], raw[at + 1]
    at = at[(before > 32) & (after > 32) & ~(_ENDS[before] & _BEGINS[after])]
    first = np.cumsum(sizes) - sizes
    opens = np.zeros(len(raw), bool)
    opens[first] = opens[at] = True
    starts = np.flatnonzero(opens)
    spaces = raw[starts] == 32
    stay = np.ones(len(raw), bool)
    stay[starts[spaces]] = stay[-1] = False
    return _strings(raw[stay], starts - (np.cumsum(spaces) - spaces)), np.searchsorted(starts, first)


def _pieces(chunks: pa.Array, whole: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Chunks cut where letters, digits and other signs meet, and behind a newline; and the number of each one's first piece. Those marked in ``whole`` stay whole."""
    offsets = np.frombuffer(chunks.buffers()[1], np.int64)[chunks.offset : chunks.offset + len(chunks) + 1]
    raw = np.frombuffer(chunks.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    left, right = _LEFT[raw[:-1]], _RIGHT[raw[1:]]
    cut = (left != right) & (left > 0) & (right > 0)
    cut[starts[1:] - 1] = False
    lines = starts[(raw[starts] == 10) & (np.diff(offsets) > 1)]
    cut[lines[(raw[lines + 1] > 32) & ~_BEGINS[raw[lines + 1]]]] = True
    if whole.any():
        cut &= ~np.repeat(whole, np.diff(offsets))[1:]
    at = np.flatnonzero(cut) + 1
    opens = np.zeros(len(raw), bool)
    opens[starts] = opens[at] = True
    opens = np.flatnonzero(opens)
    marked = np.ones(len(opens), np.int64)
    first = np.searchsorted(opens, starts)
    marked[first] = 0
    return _strings(np.insert(raw, at, 0), opens + np.cumsum(marked) - marked), first


def _is_plain(texts: list[str]) -> bool:
    """Nothing but a space or newline at the beginning of each is white space."""
    whole = "".join(texts)
    return whole.replace("\n", "").isprintable() and whole.count(" ") + whole.count("\n") == len(texts) and min(map(len, texts)) > 1


class _Table:
    """Chunks with their ids, which lie one after another in one array."""

    def __init__(self):
        self.place: dict[str, int] = {}
        self.ids, self.start, self.size = np.empty(1 << 16, np.uint32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self.top, self.entries, self.text = 0, 0, 0

    def bytes(self) -> int:
        return 4 * self.top + self.text + ENTRY_BYTES * len(self.place)

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Append the ids of chunks; their entries' numbers. Chunks can be looked up after `keep`."""
        n, m = self.entries + len(sizes), self.top + len(ids)
        if n > len(self.start):
            self.start, self.size = (np.resize(x, max(n, 2 * len(x))) for x in (self.start, self.size))
        if m > len(self.ids):
            self.ids = np.resize(self.ids, max(m, 2 * len(self.ids)))
        self.ids[self.top : m] = ids
        self.size[self.entries : n] = sizes
        self.start[self.entries : n] = self.top + np.cumsum(sizes) - sizes
        added = np.arange(self.entries, n)
        self.top, self.entries = m, n
        return added

    def keep(self, chunks: list[str], entries: np.ndarray) -> None:
        self.place.update(zip(chunks, entries.tolist()))
        self.text += sum(map(len, chunks))

    def taken(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the entries one after another, and how many each has."""
        return gathered(self.ids, self.start, self.size, entries)

    def entries_of(self, chunks: list[str]) -> np.ndarray:
        """The chunks' entries, -1 for those that are not there."""
        return np.fromiter(map(self.place.get, chunks, repeat(-1)), np.int64, len(chunks))


class ByteBpe:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, special_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special_tokens
        self.tokenizer.model._resize_cache(0)  # no piece comes twice, but each would be looked up and copied
        for t in self.tokenizer.get_added_tokens_decoder().values():
            if t.lstrip or t.rstrip or any(map(str.isspace, t.content)):
                raise ValueError(f"a cut at white space could go through {t.content!r}")
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()
        self.lengths = self.byte_lengths()

    def forget(self) -> None:
        """Empty the tables of pieces."""
        self.known, self.older = _Table(), _Table()

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        out = [b""] * len(texts)
        which = [i for i, t in enumerate(texts) if t]
        if which:
            chunks, first = _chunks([texts[i] for i in which])
            numbered = chunks.dictionary_encode()
            ids, sizes = self._ids(numbered.dictionary)
            found, own = gathered(ids, np.cumsum(sizes) - sizes, sizes, numbered.indices.to_numpy())
            data = found.astype("<u4", copy=False).tobytes()
            stops = np.cumsum(own)
            ends = stops[np.append(first[1:], len(own)) - 1] * 4
            for i, a, b in zip(which, [0, *ends[:-1].tolist()], ends.tolist()):
                out[i] = data[a:b]
        return out

    def _ids(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks one after another, and how many each has."""
        whole = np.zeros(len(chunks), bool)
        for special in self.specials:
            whole |= pc.match_substring(chunks, special).to_numpy(zero_copy_only=False)
        pieces, first = _pieces(chunks, whole)
        numbered = pieces.dictionary_encode()
        places, keep = self._places(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, size = self.known.taken(places[numbered.indices.to_numpy()])
        self.known.top, self.known.entries = keep  # long pieces, which come last, go again
        return ids, np.add.reduceat(size, first)

    def _places(self, values: list[str]) -> tuple[np.ndarray, tuple[int, int]]:
        """Entries of distinct pieces, new ones being learned; and where the table ends without those that are not to stay."""
        if self.known.bytes() > CACHE_BYTES:  # what is still in use comes over from the older table
            self.older, self.known = self.known, _Table()
        found = self.known.entries_of(values)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            names = [values[i] for i in missing.tolist()]
            old = self.older.entries_of(names)
            before = np.flatnonzero(old >= 0)
            if len(before):
                found[missing[before]] = entries = self.known.add(*self.older.taken(old[before]))
                self.known.keep([names[i] for i in before.tolist()], entries)
                missing = missing[old < 0]
                names = [values[i] for i in missing.tolist()]
        long = np.fromiter(map(len, names), np.int64, len(names)) > MOST_CHUNK if len(missing) else np.empty(0, bool)
        short = np.flatnonzero(~long)
        if len(short):
            names_kept = [names[i] for i in short.tolist()] if long.any() else names
            found[missing[short]] = entries = self.known.add(*self._learn(names_kept))
            self.known.keep(names_kept, entries)
        keep = self.known.top, self.known.entries
        if long.any():
            found[missing[long]] = self.known.add(*self._learn([names[i] for i in np.flatnonzero(long).tolist()]))
        return found, keep

    def _learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces one after another, and how many each has."""
        learned = [self._learn_some(pieces[i : i + LEARN]) for i in range(0, len(pieces), LEARN)]
        return np.concatenate([ids for ids, _ in learned]), np.concatenate([sizes for _, sizes in learned])

    def _learn_some(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces without white space inside are encoded as one text, each behind its space or a newline, and told apart by the bytes behind each
        id. The others are encoded one by one."""
        texts = ["\n" + p[1:] if p[0] == _FIRST else p if p[0] == "\n" else " " + p for p in pieces]
        single = [] if _is_plain(texts) else [i for i, t in enumerate(texts) if not _is_plain([t])]
        joined = np.delete(np.arange(len(texts)), single)
        whole = "".join([texts[i] for i in joined.tolist()] if single else texts)
        own = np.array(self._encoded([whole])[0], np.uint32)
        raw = np.frombuffer(whole.encode(), np.uint8)
        starts = np.flatnonzero((raw == 32) | (raw == 10))
        at = np.searchsorted(np.cumsum(self.lengths[own]) - self.lengths[own], starts)
        marked = np.fromiter((p[0] == _FIRST for p in pieces), bool, len(pieces))[joined]  # their newlines are no part of them
        ids, sizes = np.delete(own, at[marked]), np.diff(np.append(at, len(own))) - marked
        if single:
            lists = self._encoded([texts[i][1:] if pieces[i][0] == _FIRST else texts[i] for i in single])
            ids = np.concatenate([ids, np.fromiter(chain.from_iterable(lists), np.uint32)])
            sizes = np.append(sizes, np.fromiter(map(len, lists), np.int64, len(lists)))
            ids, sizes = gathered(ids, np.cumsum(sizes) - sizes, sizes, np.argsort(np.append(joined, single)))
        return ids, sizes

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def byte_lengths(self) -> np.ndarray:
        """Bytes of text behind each id. Every character of a byte-level token stands for one byte; added tokens stand as they are."""
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            lengths[i] = len(token)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            lengths[i] = len(token.content.encode())
        return lengths


_LOADED: dict[tuple[str, bool], ByteBpe] = {}


def encoder(path: str, special_tokens: bool = False) -> ByteBpe:
    """The worker's encoder for a vocabulary file; the path must exist on every executor."""
    if (path, special_tokens) not in _LOADED:
        _LOADED.clear()
        keeps(_LOADED.clear)
        _LOADED[path, special_tokens] = ByteBpe(path, special_tokens)
    return _LOADED[path, special_tokens]
