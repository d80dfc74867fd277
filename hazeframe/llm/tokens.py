"""Token ids of whole texts, by the ``tokenizers`` library.

Words repeat, so a worker encodes each distinct piece of text once and keeps its ids.
Texts are cut only where every pre-tokenizer here cuts as well: before a single ASCII
space, and around a single line feed, that stand between two characters which are
surely not white space, and before a closing mark that follows a letter or digit.
Everywhere else a piece simply stays longer. Where a tokenizer ignores case and white
space, pieces lose both before they are counted. Pieces are found on the bytes of the Arrow
column and counted by Arrow's own dictionary encoding.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_loaded: dict[str, "Encoder"] = {}
#: Pieces kept per worker, of some 70 bytes each; beyond, the half that was used last stays.
KEPT_PIECES = 1_200_000
#: Pieces of fewer bytes are kept, longer ones are encoded whenever they come.
KEY_BYTES = 24
#: New pieces handed to the library at once, and those of them that form one text where that is the same.
AT_ONCE, JOINED = 20_000, 200
#: Marks that no pre-tokenizer here joins to a letter or digit before them.
CLOSING = np.frombuffer(b".,;:!?", np.uint8)


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a tokenizer file; loaded once per worker."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def piece_starts(data: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Byte positions where pieces begin. ``doc_starts`` are always among them."""
    n = len(data)
    begins = np.zeros(n + 1, bool)
    begins[doc_starts] = True
    if n < 3:
        return np.flatnonzero(begins)
    printable = (data > 0x20) & (data < 0x7F)
    # Two-byte letters: lead bytes C3 to DF hold no white space (C2 does).
    lead = (data >= 0xC3) & (data <= 0xDF)
    before = printable.copy()
    before[1:] |= lead[:-1] & (data[1:] >= 0x80)
    after = printable | lead
    gap = (data == 0x20) | (data == 0x0A)
    gap[0] = gap[-1] = False
    at = np.flatnonzero(gap)
    at = at[before[at - 1] & after[at + 1]]
    feeds = at[data[at] == 0x0A]
    begins[at] = begins[feeds + 1] = True
    # letters of one byte, and those of two that surely are letters (C3 but for the two signs there)
    letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A) | (data >= 0x30) & (data <= 0x39)
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    mark = np.flatnonzero(np.isin(data, CLOSING))
    mark = mark[mark > 0]
    begins[mark[letter[mark - 1]]] = True
    return np.flatnonzero(begins)


def words_alone(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which pieces begin with one space and end without: ``piece_starts`` would cut between
    any two of them that follow each other."""
    sizes = ends - starts
    out = sizes > 1
    own, last = starts[out], ends[out] - 1
    second = data[own + 1]
    closed = (data[last] > 0x20) & (data[last] < 0x7F) | (data[last - 1] >= 0xC3) & (data[last - 1] <= 0xDF) & (data[last] >= 0x80)
    out[out] = (data[own] == 0x20) & closed & ((second > 0x20) & (second < 0x7F) | (second >= 0xC3) & (second <= 0xDF))
    return out


def folded(data: np.ndarray, starts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, offsets) in lower-case ASCII without the spaces that begin a piece."""
    begins = starts[starts < len(data)]
    spaces = begins[(data[begins] == 0x20) & (np.append(begins[1:], len(data)) - begins > 1)]
    kept = np.ones(len(data), bool)
    kept[spaces] = False
    place = np.concatenate([[0], np.cumsum(kept)])
    data = data[kept]
    upper = (data >= 0x41) & (data <= 0x5A)
    return np.where(upper, data | 0x20, data).astype(np.uint8), place[starts], place[offsets]


def by_bytes(batch: pa.RecordBatch, column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``most`` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < batch.num_rows:
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def piece_keys(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Pieces of fewer than KEY_BYTES bytes as rows of three numbers: bytes, zeros, length."""
    windows = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(KEY_BYTES, np.uint8)), KEY_BYTES)
    rows = windows[starts] * (np.arange(KEY_BYTES) < sizes[:, None])
    rows[:, -1] = sizes
    return rows.view(np.uint64)


class Known:
    """Ids of pieces, in flat arrays. A piece is looked up by a hash of its key, then the keys
    are compared, so that a piece never gets the ids of another."""

    def __init__(self):
        self.hashes, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # in order of hashes
        self.keys, self.used, self.now = np.zeros((0, KEY_BYTES // 8), np.uint64), np.zeros(0, np.int32), 0
        self.ids, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    @staticmethod
    def _hash(keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.uint64)
        for column in keys.T:
            out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 if it is not known."""
        out = np.full(len(keys), -1, np.int64)
        self.now += 1
        if len(self.hashes) and len(keys):
            sought = self._hash(keys)
            order = np.argsort(sought)  # neighbouring searches touch the same memory
            at = np.minimum(np.searchsorted(self.hashes, sought[order]), len(self.hashes) - 1)
            number = self.number[at]
            same = (self.keys[number] == keys[order]).all(axis=1)
            out[order[same]] = number[same]
            self.used[number[same]] = self.now
        return out

    def add(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keep pieces that ``find`` did not find, with their ids one after another."""
        hashes = self._hash(keys)
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.number = np.insert(self.number, at, (len(self.keys) + order).astype(np.int32))
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.keys = np.concatenate([self.keys, keys])
        self.used = np.append(self.used, np.full(len(keys), self.now, np.int32))
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes))
        self.ids = np.append(self.ids, ids)
        if len(self.keys) > KEPT_PIECES:
            kept = np.sort(np.argsort(self.used, kind="stable")[-(KEPT_PIECES // 2):])
            used, (ids, ends) = self.used[kept], self.ids_of(kept)
            self.keys, self.used, self.ids, self.ends = self.keys[kept], used, ids, ends
            hashes = self._hash(self.keys)
            self.number = np.argsort(hashes).astype(np.int32)
            self.hashes = hashes[self.number]

    def ids_of(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the numbered pieces one after another, their running end)."""
        return gather(self.ids, self.ends[number], self.ends[number + 1] - self.ends[number])


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.folds = self._ignores_case_and_spaces()
        self.sizes = self._sizes()
        self.known = Known()

    def _ignores_case_and_spaces(self) -> bool:
        """Whether the tokenizer lowers all texts itself and drops the spaces before a word."""
        def ids(text: str) -> list[int]:
            return self.tokenizer.encode(text, add_special_tokens=False).ids

        letters = [chr(c) for c in range(0x61, 0x7B)]
        plain = [*letters, *".,;:!?#1", "word"]
        return ('"Lowercase"' in self.tokenizer.to_str() and all(ids(c) == ids(c.upper()) for c in letters)
                and all(ids(c) == ids(" " + c) for c in plain))

    def _sizes(self) -> np.ndarray | None:
        """Bytes that each id stands for, if the tokenizer takes texts byte by byte as they are."""
        made = json.loads(self.tokenizer.to_str())
        before = made["pre_tokenizer"] or {}
        if made["normalizer"] or before.get("type") != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
            return None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        sizes = np.zeros(max([*vocabulary.values(), *(t["id"] for t in made["added_tokens"])], default=-1) + 1, np.int64)
        for token, i in vocabulary.items():
            sizes[i] = len(token)
        for t in made["added_tokens"]:
            sizes[t["id"]] = len(t["content"].encode())
        return sizes

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each)."""
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(sizes.sum())), sizes

    def _encoded_words(self, words: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces that ``words_alone`` names, of ``sizes`` bytes: the tokenizer cuts
        between any two of them, so many form one text. Its ids are dealt out by their bytes."""
        ids, _ = self._encoded(["".join(words[lo:lo + JOINED]) for lo in range(0, len(words), JOINED)])
        ends, wanted = np.cumsum(self.sizes[ids]), np.cumsum(sizes)
        last = np.searchsorted(ends, wanted)
        if len(ends) and ends[-1] == wanted[-1] and (ends[last] == wanted).all():
            return ids, np.diff(last, prepend=-1)
        return self._encoded(words)  # an added token took bytes beside its own

    def _ids_of(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, length): the ids of distinct pieces and the run of each piece in them."""
        buffers = pieces.buffers()
        bounds = np.frombuffer(buffers[1], np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
        data = np.frombuffer(buffers[2], np.uint8)[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        short = np.flatnonzero(np.diff(bounds) < KEY_BYTES)
        keys = piece_keys(data, bounds[short], np.diff(bounds)[short])
        number = np.full(len(pieces), -1, np.int64)
        number[short] = self.known.find(keys)
        hit, missing = np.flatnonzero(number >= 0), np.flatnonzero(number < 0)
        held, ends = self.known.ids_of(number[hit])
        made, sizes = [held], [np.zeros(0, np.int64)]
        joined = words_alone(data, bounds[missing], bounds[missing + 1]) & (self.sizes is not None)
        missing = np.concatenate([missing[joined], missing[~joined]])
        cuts = [*range(0, int(joined.sum()), AT_ONCE), *range(int(joined.sum()), len(missing), AT_ONCE), len(missing)]
        for lo, hi in zip(cuts, cuts[1:]):
            words = pieces.take(pa.array(missing[lo:hi])).to_numpy(zero_copy_only=False).tolist()
            new = (self._encoded_words(words, bounds[missing[lo:hi] + 1] - bounds[missing[lo:hi]])
                   if lo < joined.sum() else self._encoded(words))
            made.append(new[0])
            sizes.append(new[1])
        flat, size = np.concatenate(made), np.concatenate(sizes)
        first, length = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        first[hit], length[hit] = ends[:-1], np.diff(ends)
        first[missing], length[missing] = len(held) + np.cumsum(size) - size, size
        fresh = number[short] < 0
        if fresh.any():
            own = short[fresh]
            self.known.add(keys[fresh], gather(flat, first[own], length[own])[0], length[own])
        return flat, first, length

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, offsets with one more entry than texts).

        A null text has no ids.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        texts = pa.concat_arrays([texts])  # offsets from 0 even for a slice
        buffers = texts.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        lo, hi = int(offsets[0]) if len(texts) else 0, int(offsets[-1]) if len(texts) else 0
        if hi == lo:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        data = np.frombuffer(buffers[2], np.uint8)[lo:hi]
        doc_starts = offsets[:-1] - lo
        starts = piece_starts(data, doc_starts[doc_starts < hi - lo])
        offsets = offsets - lo
        # a text in capitals must not become a special token
        if self.folds and b"<|" not in data.tobytes():
            data, starts, offsets = folded(data, starts, offsets)
        bounds = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
        coded = pieces.dictionary_encode()
        flat, firsts, lengths = self._ids_of(coded.dictionary)
        code = coded.indices.to_numpy(zero_copy_only=False)
        ids, ends = gather(flat, firsts[code], lengths[code])
        # pieces before each document -> ids before it
        return ids, ends[np.searchsorted(starts, offsets)]


def gather(flat: np.ndarray, firsts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the runs flat[first:first+length]; also the running end of each run."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(ends[-1], dtype=np.int64) + np.repeat(firsts - ends[:-1], lengths)
    return flat[at], ends
