"""Byte-level BPE encoding and decoding with padded numpy matrices.

Distinct words of a batch are bucketed by length into padded matrices of token ids. Each round every row merges its
leftmost pair of minimum rank, found by an open-addressing hash table over id pairs; the cell that the merge frees and the
rows that are finished are compacted away. Ranks come either from a rank file (any two tokens whose bytes together are a
token may merge, and whole words that are tokens are taken as they are) or from the merge list of a tokenizer file.

A text is first cut where a word always begins, all texts of a batch at once. The ids of distinct pieces are remembered
in each Python worker by 64-bit hash (bounded). Words longer than ``LONG`` bytes merge one at a time from a heap. Added tokens
of a tokenizer file are found in the text first (the leftmost, of those the longest); what stands between them is a text of its own.

Results in special cases: a null text is the empty text (no ids); a null id is passed on; repeated rows are encoded one by one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pasarlens.llm.scratch import bounded_batches
from pasarlens.llm.text_arrays import HashIndex, hash_ranges, pieces

NO_RANK = np.int32(2**31 - 1)
_BITS = 20
_PAD = (1 << _BITS) - 1
#: Row widths of the matrices; longer words go to the heap.
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 16, 20, 24, 32, 48, 64, 128, 256)
LONG = WIDTHS[-1]
#: Distinct pieces remembered in a worker.
REMEMBERED = 300_000
_CELLS = 1 << 20


class PairTable:
    """Rank of each pair of ids."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.index = HashIndex(len(rank))
        self.index.add(self._key(left, right), rank)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(_BITS)) | right.astype(np.uint64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.index.find(self._key(left, right).ravel(), NO_RANK).reshape(left.shape)


class Vocabulary:
    """Token bytes by id, ids of single bytes, pairs with ranks, and the ids that pairs become."""

    def __init__(self, tokens: dict[bytes, int], merges: list[tuple[int, int, int]] | None, added: dict[bytes, int] | None = None):
        self.added = added or {}
        if merges is None:
            triples = [
                (tokens[t[:i]], tokens[t[i:]], n)
                for t, n in tokens.items()
                for i in range(1, len(t))
                if t[:i] in tokens and t[i:] in tokens
            ]
            left, right, rank = (np.array(x, np.int32) for x in zip(*triples, strict=True))
            self.merged = np.arange(max(tokens.values()) + 1, dtype=np.int32)
        else:
            left, right, self.merged = (np.array(x, np.int32) for x in zip(*merges, strict=True))
            rank = np.arange(len(merges), dtype=np.int32)
        self.pairs = PairTable(left, right, rank)
        self.byte_id = np.array([tokens.get(bytes([b]), _PAD) for b in range(256)], np.int32)
        by_id = {n: t for some in (tokens, self.added) for t, n in some.items()}
        listed = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        self.token_lengths = np.array([len(t) for t in listed], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(listed), np.uint8)
        self.whole_hashes, self.whole_ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        if merges is None:
            used = np.flatnonzero(self.token_lengths)
            hashes = hash_ranges(self.token_bytes, self.token_starts[used], (self.token_starts + self.token_lengths)[used])
            order = np.argsort(hashes)
            self.whole_hashes, self.whole_ids = hashes[order], used[order].astype(np.uint32)

    @classmethod
    def from_ranks(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, None)

    @classmethod
    def from_tokenizer(cls, path: str) -> Vocabulary:
        """Of a byte-level BPE tokenizer file, whose token texts stand for bytes by the usual table of visible characters."""
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, added = content["model"], content.get("added_tokens") or []
        if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: added tokens are only matched as they are written")
        visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        hidden = [b for b in range(256) if b not in set(visible)]
        byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ids = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        tokens = {bytes(byte_of[c] for c in t): n for t, n in ids.items() if all(c in byte_of for c in t)}
        marks = {t["content"].encode(): t["id"] for t in added}
        return cls(tokens, [(ids[a], ids[b], ids[a + b]) for a, b in pairs], marks)

    def encode_words(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, whole_tokens: bool = True
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at the given byte ranges, one after another, and where each word's begin. Words that are a token are
        looked up by hash first, if ``whole_tokens``."""
        lengths = ends - starts
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # words, how many ids each, their ids
        open_ = lengths > 0
        if whole_tokens and len(self.whole_hashes):
            hashes = hash_ranges(data, starts, ends)
            at = np.minimum(np.searchsorted(self.whole_hashes, hashes), len(self.whole_hashes) - 1)
            whole = np.flatnonzero(open_ & (self.whole_hashes[at] == hashes))
            parts.append((whole, np.ones(len(whole), np.int64), self.whole_ids[at[whole]]))
            open_[whole] = False
        for low, width in zip((0, *WIDTHS), WIDTHS, strict=False):
            rows = np.flatnonzero(open_ & (lengths > low) & (lengths <= width))
            step = max(1, _CELLS // width)
            for a in range(0, len(rows), step):
                self._encode_matrix(data, starts, lengths, rows[a : a + step], width, parts)
        for i in np.flatnonzero(open_ & (lengths > LONG)).tolist():
            ids = self._encode_long(data[starts[i] : ends[i]])
            parts.append((np.array([i]), np.array([len(ids)]), ids))
        counts = np.zeros(len(starts), np.int64)
        for rows, n, _ in parts:
            counts[rows] = n
        places = np.concatenate([[0], np.cumsum(counts)])
        flat = np.zeros(places[-1], np.uint32)
        for rows, n, ids in parts:
            stops = np.cumsum(n)
            flat[np.repeat(places[rows] - (stops - n), n) + np.arange(len(ids))] = ids
        return flat, places

    def _encode_matrix(self, data, starts, lengths, rows, width, parts) -> None:
        places = np.arange(width)
        beyond = places >= lengths[rows, None]
        ids = self.byte_id[data[np.minimum(starts[rows, None] + places, len(data) - 1)]]
        ids[beyond] = _PAD
        ranks = self.pairs.rank(ids[:, :-1], ids[:, 1:]) if width > 1 else np.zeros((len(rows), 0), np.int32)
        while len(rows):
            width = ids.shape[1]
            every = np.arange(len(rows))
            at = ranks.argmin(1) if width > 1 else np.zeros(len(rows), np.int64)
            best = ranks[every, at] if width > 1 else np.full(len(rows), NO_RANK)
            finished = best == NO_RANK
            if finished.any():
                done = ids[finished]
                used = done != _PAD
                parts.append((rows[finished], used.sum(1), done[used]))
                more = ~finished
                ids, ranks, rows, at, best = ids[more], ranks[more], rows[more], at[more], best[more]
                if not len(rows):
                    return
                every = np.arange(len(rows))
            ids[every, at] = self.merged[best]
            stay = np.ones(ids.shape, bool)
            stay[every, at + 1] = False
            ids = ids[stay].reshape(len(rows), width - 1)
            stay = np.ones(ranks.shape, bool)
            stay[every, at] = False
            ranks = ranks[stay].reshape(len(rows), width - 2)
            before, after = every[at > 0], every[at < width - 2]
            ranks[before, at[before] - 1] = self.pairs.rank(ids[before, at[before] - 1], ids[before, at[before]])
            ranks[after, at[after]] = self.pairs.rank(ids[after, at[after]], ids[after, at[after] + 1])

    def _encode_long(self, word: np.ndarray) -> np.ndarray:
        """One merge at a time, lowest rank and then leftmost first, over a linked list."""
        ids = self.byte_id[word].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.rank(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first.tolist()) if r != NO_RANK]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = int(self.merged[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for p in (before[i], i):
                if p >= 0 and after[p] < n:
                    q = after[p]
                    r = int(self.pairs.rank(np.array([ids[p]]), np.array([ids[q]]))[0])
                    if r != NO_RANK:
                        heapq.heappush(heap, (r, p, ids[p], ids[q]))
        return np.array([x for x in ids if x >= 0], np.uint32)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a run of ids."""
        lengths = self.token_lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.token_bytes[np.repeat(self.token_starts[ids] - (ends - lengths), lengths) + np.arange(total)]


def _class(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_LETTER = _class(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _class(b"0123456789")
_MARK = _class(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
_APOSTROPHE, _SPACE, _LINE_END = 0x27, 0x20, 0x0A


def cut_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where a match of the pattern always begins, whatever stands around: at a space after a character that is
    not white space, around a line end between such characters, and where letters, digits and marks meet. Only ASCII and
    the letters of the Latin-1 block are looked at; other characters are left for the pattern. An apostrophe is never
    cut from what follows it. Second result: the bytes of such letters."""
    n = len(data)
    letter, digit, mark = _LETTER[data], _DIGIT[data], _MARK[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    letter[lead] = letter[lead + 1] = True
    inside = np.zeros(n, bool)
    inside[lead + 1] = True
    apostrophe = data == _APOSTROPHE
    solid = letter | digit | mark | apostrophe
    start = np.zeros(n + 1, bool)
    before, here = slice(0, n - 1), slice(1, n)
    start[1:n] = (
        ((data[here] == _SPACE) & solid[before])
        | (mark | apostrophe)[here] & (letter | digit)[before]
        | letter[here] & (mark | digit)[before]
        | digit[here] & (mark | letter)[before]
    )
    ends = np.flatnonzero(data == _LINE_END)
    ends = ends[(ends > 0) & (ends < n - 1)]
    ends = ends[solid[ends - 1] & solid[ends + 1]]
    start[ends] = start[ends + 1] = True
    start[:n] &= ~inside
    start[offsets] = True
    return np.flatnonzero(start[:n]), letter


class Encoder:
    """Whole texts to ids. The ids of distinct pieces are remembered by hash, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.find = regex.compile(pattern).findall
        marks = sorted(vocabulary.added, key=len, reverse=True)
        self.mark = re.compile(b"|".join(map(re.escape, marks))) if marks else None
        self.tokens: dict[bytes, int] | None = None
        self._forget()

    def _marks(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where added tokens begin and end, none across two texts."""
        found: list[tuple[int, int]] = []
        raw, at = data.tobytes() if self.mark else b"", 0
        while self.mark and (m := self.mark.search(raw, at)):
            at = int(offsets[np.searchsorted(offsets, m.start(), "right")])
            # one that would reach into the next text is looked for again in its own
            if m := m if m.end() <= at else self.mark.search(raw, m.start(), at):
                found.append(m.span())
                at = m.end()
        spans = np.array(found, np.int64).reshape(-1, 2)
        return spans[:, 0], spans[:, 1]

    def _forget(self) -> None:
        self.place = HashIndex()
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1, np.int64)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, plain: np.ndarray) -> None:
        """Remember pieces. A plain one (letters, maybe after a space) is one match of the pattern; others are matched."""
        raw, added = data.tobytes(), self.vocabulary.added
        other = np.flatnonzero(~plain)
        whole = [raw[a:b] for a, b in zip(starts[other].tolist(), ends[other].tolist(), strict=True)]
        split = [[] if p in added else self.find(p.decode()) for p in whole]
        words = {w: i for i, w in enumerate({w for ws in split for w in ws})}
        coded = [w.encode() for w in words]
        stops = np.cumsum([len(w) for w in coded], dtype=np.int64)
        own = np.frombuffer(b"".join(coded), np.uint8)
        flat, at = self.vocabulary.encode_words(own, np.append(0, stops)[: len(coded)], stops)
        flat, at = flat.tolist(), at.tolist()
        joined = [[i for w in ws for i in flat[at[words[w]] : at[words[w] + 1]]] for ws in split]
        joined = [[added[p]] if p in added else ids for p, ids in zip(whole, joined, strict=True)]
        ids, places = self.vocabulary.encode_words(data, starts[plain], ends[plain])
        fresh = np.concatenate([ids, np.array([i for x in joined for i in x], np.uint32)])
        counts = np.concatenate([np.diff(places), np.array([len(x) for x in joined], np.int64)])
        used = int(self.start[-1])
        if used + len(fresh) > len(self.flat):
            self.flat = np.concatenate([self.flat[:used], np.zeros(used + 2 * len(fresh), np.uint32)])
        self.flat[used : used + len(fresh)] = fresh
        n = len(self.start) - 1
        self.place.add(hashes[np.concatenate([np.flatnonzero(plain), other])], np.arange(n, n + len(hashes), dtype=np.int32))
        self.start = np.concatenate([self.start, used + np.cumsum(counts)])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's ids begin (one more at the end).

        Pieces and tokens are found by hash, so the bytes that the ids stand for are compared with the texts; a text that differs,
        because two pieces hash alike, is encoded again without hashes.
        """
        ids, places = self._encode_hashed(data, offsets)
        own = self.vocabulary.decode(ids)
        if len(own) == len(data) and np.array_equal(own, data):
            return ids, places
        stops = np.concatenate([[0], np.cumsum(self.vocabulary.token_lengths[ids])])[places]
        parts = [ids[a:b] for a, b in zip(places, places[1:], strict=False)]
        for i, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
            if not np.array_equal(own[stops[i] : stops[i + 1]], data[a:b]):
                parts[i] = self._encode_exact(data[a:b].tobytes())
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _encode_exact(self, text: bytes) -> np.ndarray:
        """The ids of a text, each piece looked up by its bytes."""
        vocabulary = self.vocabulary
        if self.tokens is None:
            listed = vocabulary.whole_ids.tolist()
            bounds = [(int(vocabulary.token_starts[i]), int(vocabulary.token_lengths[i])) for i in listed]
            self.tokens = {vocabulary.token_bytes[a : a + n].tobytes(): i for i, (a, n) in zip(listed, bounds, strict=True)}
        cuts = [m.span() for m in self.mark.finditer(text)] if self.mark else []
        out: list[int] = []
        for (_, a), (b, c) in zip([(0, 0), *cuts], [*cuts, (len(text), len(text))], strict=True):
            for piece in (w.encode() for w in self.find(text[a:b].decode())):
                if piece in self.tokens:
                    out.append(self.tokens[piece])
                else:
                    data = np.frombuffer(piece, np.uint8)
                    own = vocabulary.encode_words(data, np.zeros(1, np.int64), np.array([len(data)]), whole_tokens=False)
                    out.extend(own[0].tolist())
            if c > b:
                out.append(vocabulary.added[text[b:c]])
        return np.array(out, np.uint32)

    def _encode_hashed(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.place.count > REMEMBERED:
            self._forget()
        mark_starts, mark_ends = self._marks(data, offsets)
        starts, letters = cut_places(data, np.concatenate([offsets, mark_starts, mark_ends]))
        if len(mark_starts):
            before = np.searchsorted(mark_starts, starts) - 1
            starts = starts[(before < 0) | (starts >= mark_ends[before])]
        ends = np.append(starts[1:], len(data))
        hashes, first, which = np.unique(hash_ranges(data, starts, ends), return_index=True, return_inverse=True)
        at = self.place.find(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            new = new[np.argsort(first[new])]
            low, high = starts[first[new]], ends[first[new]]
            spaced = data[low] == _SPACE
            sums = np.concatenate([[0], np.cumsum(letters)])
            plain = (sums[high] - sums[low] == high - low - spaced) & (high - low > spaced)
            plain &= ~np.isin(low, mark_starts)
            self._learn(hashes[new], data, low, high, plain)
            at = self.place.find(hashes)
        own, sizes = self.start[at][which], (self.start[at + 1] - self.start[at])[which]
        stops = np.cumsum(sizes)
        ids = self.flat[np.repeat(own - (stops - sizes), sizes) + np.arange(stops[-1])]
        return ids, np.concatenate([[0], stops])[np.searchsorted(starts, offsets)]


@lru_cache(maxsize=4)
def encoder(name: str) -> Encoder:
    """The encoder of a public vocabulary file, once per Python worker."""
    import public_tokenizers

    path = public_tokenizers.path(name)
    read = Vocabulary.from_tokenizer if name.endswith(".json") else Vocabulary.from_ranks
    return Encoder(read(path), public_tokenizers.PATTERN)


def binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary Arrow array of the given ranges of ``values``."""
    ends = (offsets * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(ends), pa.py_buffer(values.tobytes())])


def encode_documents(
    df: DataFrame, vocabulary: str, decode: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per text: its ids (little-endian unsigned 32-bit, binary) and, if asked for, the bytes they decode to."""

    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        for batch in batches:
            for a, b, data, offsets in pieces(batch.column(1)):
                ids, places = own.encode(data, offsets)
                columns = [batch.column(0).slice(a, b - a), binaries(ids.astype("<u4"), places)]
                if decode:
                    text = own.vocabulary.decode(ids)
                    ends = np.concatenate([[0], np.cumsum(own.vocabulary.token_lengths[ids])])[places]
                    columns.append(binaries(text, ends))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"][: len(columns)])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids binary" + ", decoded binary" * decode)
