"""Exact and fast encoding with a public tokenizer file, many texts at a time in arrays.

A batch is cut into words, its distinct words are numbered, and only words that this worker does not hold yet are
encoded: cut into runs of one kind, and the distinct runs merged pair by pair, all of them in step.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

from lodewatch.llm._shingles import span_hashes

#: Most words, and most of their bytes, that one worker keeps between batches (about 45 bytes a word).
CACHE_WORDS, CACHE_BYTES = 300_000, 8_000_000
#: Longer words are encoded whenever they occur.
LONGEST = 64
#: Longer runs go to the library.
_LONGEST_RUN = 63
_OTHER, _LETTER, _DIGIT, _SIGN = range(4)
_CLASS = np.array([_OTHER if b < 33 or b > 126 else _DIGIT if 48 <= b <= 57 else _LETTER if 65 <= b <= 90 or 97 <= b <= 122 else _SIGN for b in range(256)], np.uint8)
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_NONE = 1 << 30


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def gathered(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``flat[s : s + c]`` of each pair of ``start`` and ``count``, one behind another."""
    shift = start - (np.cumsum(count) - count)
    return flat[np.repeat(shift, count) + np.arange(int(count.sum()))]


def _parts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary array without nulls."""
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def _strings(raw: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.Array.from_buffers(kind, len(off) - 1, [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])


class _Merges:
    """Byte-level merges with word ends, applied to many short runs in step: in each round every run merges its best pair."""

    _BITS = 19

    def __init__(self, model: dict):
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        strange = iter(range(256, 512))  # bytes without a sign of their own
        sign = [chr(b if b in plain else next(strange)) for b in range(256)]
        self.inner = np.array([vocab[c] for c in sign], np.uint32)
        self.last = np.array([vocab[c + suffix] for c in sign], np.uint32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.made = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        keys, ranks = [0xFFFFFFFF] * (1 << self._BITS), [0] * (1 << self._BITS)
        for rank, (a, b) in enumerate(pairs):
            key = vocab[a] << 16 | vocab[b]
            slot = self._slot(key)
            while keys[slot] not in (0xFFFFFFFF, key):
                slot = (slot + 1) % len(keys)
            keys[slot], ranks[slot] = key, rank
        self.keys, self.ranks = np.array(keys, np.uint32), np.array(ranks, np.int32)

    def _slot(self, key: int) -> int:
        return (key * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - self._BITS)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Each pair's rank, or _NONE; an open-addressed table is probed for all pairs at once."""
        key = (a << np.uint32(16)) | b
        slot = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - self._BITS)
        got = self.keys[slot]
        rank = np.where(got == key, self.ranks[slot], np.int32(_NONE))
        todo = np.flatnonzero((got != key) & (got != 0xFFFFFFFF))
        while len(todo):
            slot[todo] = (slot[todo] + np.uint32(1)) & np.uint32((1 << self._BITS) - 1)
            got = self.keys[slot[todo]]
            hit = got == key[todo]
            rank[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (got != 0xFFFFFFFF)]
        return rank

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, count): run i, of 1 to 63 bytes, has the ids ``ids[start[i] : start[i] + count[i]]``."""
        lens = np.diff(off)
        order = np.argsort(lens, kind="stable")
        count, parts = np.zeros(len(lens), np.int64), [np.empty(0, np.uint32)]
        for i in range(0, len(order), 8192):
            own = order[i : i + 8192]
            ids, count[own] = self._block(buf, off[own], lens[own])
            parts.append(ids)
        start = np.empty(len(lens), np.int64)
        start[order] = np.cumsum(count[order]) - count[order]
        return np.concatenate(parts), start, count

    def _block(self, buf: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, height = len(lens), int(lens[-1])
        at = np.arange(height, dtype=np.int32)[:, None]
        raw = buf[np.minimum(starts + at, len(buf) - 1)]
        token = np.where(at == lens - 1, self.last[raw], self.inner[raw])
        alive = at < lens
        # A run's best pair is the least of rank and place; row p holds the pair of the piece at p and the one behind it.
        best = np.full((height, n), _NONE, np.int32)
        rank = self.rank(token[:-1].ravel(), token[1:].ravel()).reshape(height - 1, n)
        best[:-1] = np.where(alive[1:] & (rank < _NONE), (rank << 6) | at[:-1], _NONE)
        behind, before = (np.repeat(at + d, n, axis=1) for d in (1, -1))
        T, K, B, A, L = (x.reshape(-1) for x in (token, best, behind, before, alive))
        while True:
            top = best.min(0)
            col = np.flatnonzero(top < _NONE)
            if not len(col):
                return token.T[alive.T], alive.sum(0)
            place = top[col] & 63
            i = place * n + col
            j = B[i] * n + col
            T[i] = self.made[top[col] >> 6]
            K[i] = K[j] = _NONE
            L[j] = False
            B[i] = third = B[j]
            has = np.flatnonzero(third < lens[col])
            a, k = i[has], third[has] * n + col[has]
            A[k] = place[has]
            rank = self.rank(T[a], T[k])
            K[a] = np.where(rank < _NONE, (rank << 6) | place[has], _NONE)
            first = A[i]
            has = np.flatnonzero(first >= 0)
            a, k = i[has], first[has] * n + col[has]
            rank = self.rank(T[k], T[a])
            K[k] = np.where(rank < _NONE, (rank << 6) | first[has], _NONE)


class _Words:
    """Words and their ids, found by hash and compared byte by byte. Once full, the half that was met most often stays."""

    def __init__(self):
        self.hash, self.entry = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.raw, self.off = np.empty(0, np.uint8), np.zeros(1, np.int64)
        self.ids, self.at = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self.met = np.empty(0, np.int32)

    def find(self, raw: np.ndarray, off: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Each word's number here, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        if not len(self.hash) or not len(hashes):
            return out
        slot = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        entry, lens = self.entry[slot], np.diff(off)
        may = np.flatnonzero((self.hash[slot] == hashes) & (lens == np.diff(self.off)[entry]))
        if len(may):
            same = gathered(raw, off[may], lens[may]) == gathered(self.raw, self.off[entry[may]], lens[may])
            may = may[np.logical_and.reduceat(same, np.cumsum(lens[may]) - lens[may])]
        out[may] = entry[may]
        self.met[out[may]] += 1
        return out

    def add(self, raw: np.ndarray, off: np.ndarray, hashes: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        """Takes in words that ``find`` does not know; one whose hash another word has stays unknown."""
        if len(self.met) + len(hashes) > CACHE_WORDS or len(self.raw) + len(raw) > CACHE_BYTES:
            self._keep(np.argsort(-self.met, kind="stable")[: len(self.met) // 2])
        order = np.argsort(hashes, kind="stable")
        slot = np.searchsorted(self.hash, hashes[order])
        known = self.hash[np.minimum(slot, len(self.hash) - 1)] == hashes[order] if len(self.hash) else np.zeros(len(order), bool)
        first = np.r_[True, hashes[order][1:] != hashes[order][:-1]][: len(order)] & ~known
        order, slot = order[first], slot[first]
        self.hash, self.entry = np.insert(self.hash, slot, hashes[order]), np.insert(self.entry, slot, len(self.met) + order)
        self.raw, self.off = np.concatenate([self.raw, raw]), np.concatenate([self.off, self.off[-1] + off[1:]])
        self.ids, self.at = np.concatenate([self.ids, ids]), np.concatenate([self.at, self.at[-1] + at[1:]])
        self.met = np.concatenate([self.met, np.zeros(len(hashes), np.int32)])

    def _keep(self, own: np.ndarray) -> None:
        own = np.sort(own)
        new = np.full(len(self.met), -1, np.int64)
        new[own] = np.arange(len(own))
        stays = new[self.entry] >= 0
        self.hash, self.entry = self.hash[stays], new[self.entry[stays]]
        for flat, off in (("raw", "off"), ("ids", "at")):
            lens = np.diff(getattr(self, off))[own]
            setattr(self, flat, gathered(getattr(self, flat), getattr(self, off)[own], lens))
            setattr(self, off, np.concatenate([[0], np.cumsum(lens)]))
        self.met = self.met[own] // 2


class Encoder:
    """``encode(texts)`` returns each text's ids, equal to the library's ``encode_batch``.

    If the file's normalizer and pre-tokenizer are of the kind that never looks across a space (NFC, white
    space, lower case; letters, digits and the rest apart), texts are cut at spaces and line ends and each
    distinct word is encoded once. Words of ASCII signs and of Latin letters up to U+00FF, which NFC leaves as they are
    and every Unicode version lower-cases alike, are merged here; the library takes all others. Any other file is
    passed to ``encode_batch`` as it is.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.size = self.whole.get_vocab_size()
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        spec = json.load(open(path, encoding="utf-8"))
        self.by_word = self.size < 1 << 16 and self._splits_at_spaces(spec)
        if self.by_word:
            self.merges, self.words = _Merges(spec["model"]), _Words()

    @staticmethod
    def _splits_at_spaces(spec: dict) -> bool:
        norm, pre, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
        steps = [x["type"] for x in norm.get("normalizers", [])]
        parts = pre.get("pretokenizers", [])
        return (
            steps == ["NFC", "Replace", "Lowercase"]
            and norm["normalizers"][1] == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
            and [x["type"] for x in parts] == ["Split", "ByteLevel"]
            and parts[0]["pattern"] == {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
            and parts[0]["behavior"] == "Removed"
            and parts[0]["invert"]
            and not parts[1]["add_prefix_space"]
            and not parts[1]["use_regex"]
            and model["type"] == "BPE"
            and model.get("end_of_word_suffix") == "</w>"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            and all(t["content"].startswith("<|") for t in spec.get("added_tokens", []))
        )

    def _by_library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for i in range(0, len(texts), 2000) for e in self.whole.encode_batch_fast(texts[i : i + 2000], add_special_tokens=False)]

    def _learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, count) of distinct, not empty words."""
        buf, off = _parts(words)
        kind, low = _CLASS[buf], _LOWER[buf]
        lead = np.flatnonzero(buf[:-1] == 0xC3)
        second = buf[lead + 1]
        lead, second = (x[(second != 0x97) & (second != 0xB7)] for x in (lead, second))  # U+00C0 to U+00FF but for two signs
        kind[lead] = kind[lead + 1] = _LETTER
        low[lead[second < 0x9F] + 1] += 32
        inner = np.ones(len(buf), bool)
        inner[off[:-1]] = False
        strange = kind == _OTHER
        # What an apostrophe takes with it, and special tokens, are the library's.
        strange[1:] |= inner[1:] & (((buf[:-1] == 39) & (kind[1:] == _LETTER)) | ((buf[:-1] == 60) & (buf[1:] == 124)))
        cut = ~inner
        cut[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        begins = np.flatnonzero(cut)
        lens = np.diff(np.append(begins, len(buf)))
        word = np.cumsum(~inner)[begins] - 1
        library = np.logical_or.reduceat(strange, off[:-1])
        library[word[lens > _LONGEST_RUN]] = True
        own = ~library[word]
        runs = _strings(low, np.append(begins, len(buf)), pa.binary()).filter(pa.array(own)).dictionary_encode()
        ids, start, count = self.merges.encode(*_parts(runs.dictionary))
        codes, word = runs.indices.to_numpy(), word[own]
        flat = gathered(ids, start[codes], count[codes])
        n_ids = np.bincount(word, count[codes], len(words)).astype(np.int64)
        at = np.cumsum(n_ids) - n_ids
        rest = np.flatnonzero(library)
        if len(rest):
            more = self._by_library(words.take(pa.array(rest)).to_pylist())
            n_ids[rest] = [len(x) for x in more]
            at[rest] = len(flat) + np.cumsum(n_ids[rest]) - n_ids[rest]
            flat = np.concatenate([flat, *(np.array(x, np.uint32) for x in more)])
        return flat, at, n_ids

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's ids as little-endian unsigned integers of ``self.kind``."""
        if not self.by_word:
            return [np.array(x, self.kind) for x in self._by_library(texts)]
        raw = [t.encode("utf-8") for t in texts]
        buf = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)
        inside = (buf != 32) & (buf != 10)
        begins = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        ends = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1
        if not len(begins):
            return [np.empty(0, self.kind) for _ in texts]
        words = _strings(buf[inside], np.concatenate([[0], np.cumsum(ends - begins)]), pa.string()).dictionary_encode()
        distinct, codes = words.dictionary, words.indices.to_numpy()
        word_raw, off = _parts(distinct)
        hashes = span_hashes(word_raw, off[:-1], off[1:])
        entry = self.words.find(word_raw, off, hashes)
        known, new = np.flatnonzero(entry >= 0), np.flatnonzero(entry < 0)
        start, count, flat = np.empty(len(entry), np.int64), np.empty(len(entry), np.int64), self.words.ids
        start[known], count[known] = self.words.at[entry[known]], np.diff(self.words.at)[entry[known]]
        if len(new):
            ids, at, count[new] = self._learn(distinct.take(pa.array(new)))
            start[new] = at + len(flat)
            flat = np.concatenate([flat, ids])
            new = new[np.diff(off)[new] <= LONGEST]
            lens, n = np.diff(off)[new], count[new]
            self.words.add(gathered(word_raw, off[new], lens), np.concatenate([[0], np.cumsum(lens)]), hashes[new], gathered(flat, start[new], n), np.concatenate([[0], np.cumsum(n)]))
        n = count[codes]
        out, upto = gathered(flat, start[codes], n).astype(self.kind), np.concatenate([[0], np.cumsum(n)])
        cuts = upto[np.searchsorted(begins, np.cumsum([0, *(len(t) + 1 for t in raw)]))]
        return [out[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for ``path``; its words stay from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_rows(texts: list[str], path: str, end_id: int | None, chunk_chars: int = 400_000):
    """Yields each text's ids as an array, in order; about ``chunk_chars`` characters are encoded together."""
    enc, i = encoder(path), 0
    end = np.array([] if end_id is None else [end_id], enc.kind)
    while i < len(texts):
        j, chars = i, 0
        while j < len(texts) and (j == i or chars + len(texts[j]) <= chunk_chars):
            chars += len(texts[j])
            j += 1
        for ids in enc.encode(texts[i:j]):
            yield np.concatenate([ids, end])
        i = j
