"""Token ids of whole texts with a public word-level BPE tokenizer file, faster than encoding each text anew.

The tokenizer never merges across white space, so the ids of a text are the ids of its words one after another.  A chunk
of texts is split into words at ASCII white space and the words are hashed with numpy; a worker process keeps the ids of
the words it has met in sorted arrays and encodes only the distinct new ones.  A new word in turn is split into the
tokenizer's pieces (letters, single digits, other characters) where that split is certainly the tokenizer's own (ASCII
and Latin-1 letters); any other word goes through the tokenizer itself.
"""

from __future__ import annotations

import re

import numpy as np

from .textbytes import INK_BYTE, LOWER_VALUES, fingerprints, prefix_sums, ranges, word_bounds

WORD_FILE = "word_bpe_49k.json"
#: What a worker process keeps: words (17 bytes each) with their ids (2 or 4 bytes each), and pieces (about 170 bytes each).
#: A single chunk may go beyond.
MEMO_WORDS, MEMO_IDS, MEMO_PIECES = 1_000_000, 6_000_000, 150_000

_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]*").fullmatch
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall


def tokenizer_path(name: str = WORD_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable bytes stand for themselves, the
    others take the code points from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


_LETTERS = _byte_letters()


class WordEncoder:
    """Ids equal to Tokenizer.encode(text, add_special_tokens=False).ids, for chunks of texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.pieces: dict[str, bytes] = {}
        self.keys, self.start, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)  # words met in another chunk since the last time that some were forgotten
        self.flat = np.zeros(0, self.dtype)

    def _forget(self) -> None:
        """Keeps the words met again, or none if these alone fill half of the memo."""
        kept = np.flatnonzero(self.again)
        if len(kept) > MEMO_WORDS // 2 or int(self.length[kept].sum()) > MEMO_IDS // 2:
            kept = kept[:0]
        length = self.length[kept]
        self.flat = self.flat[ranges(self.start[kept].astype(np.int64), length.astype(np.int64))]
        self.keys, self.start, self.length = self.keys[kept], (np.cumsum(length) - length).astype(np.int32), length
        self.again = np.zeros(len(kept), bool)

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            seen = piece if piece.isascii() else "".join(map(_LETTERS.__getitem__, piece.encode()))
            ids = self._bytes([t.id for t in self.model.tokenize(seen)])
            if len(self.pieces) >= MEMO_PIECES:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def word(self, word: str) -> bytes:
        if _SIMPLE(word) and "<|" not in word:
            found = _PIECES(word.lower())
            return self._piece(found[0]) if len(found) == 1 else b"".join(map(self._piece, found))
        return self._bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        ids = [self.word(w) for w in words]
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        new = np.frombuffer(b"".join(ids), self.dtype)
        if len(self.flat) + len(new) >= 1 << 31:
            self.start = self.start.astype(np.int64)
        start = np.cumsum(length) - length + len(self.flat)
        self.flat = np.concatenate([self.flat, new])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.start, self.length = np.insert(self.start, at, start), np.insert(self.length, at, length)
        self.again = np.insert(self.again, at, False)

    def encode_chunk(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, each followed by end_id; first, with text i at first[i]:first[i + 1])."""
        start, end, of_text = word_bounds(data, offsets, INK_BYTE)
        key = fingerprints(prefix_sums(data, LOWER_VALUES), start, end)
        distinct, where, each = np.unique(key, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > MEMO_WORDS or len(self.flat) > MEMO_IDS:
            self._forget()
        at = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == distinct[inside]
        self.again[at[known]] = True
        if not known.all():
            new = np.flatnonzero(~known)
            raw = data.tobytes()
            self._learn(distinct[new], [raw[s:e].decode() for s, e in zip(start[where[new]].tolist(), end[where[new]].tolist())])
            at = np.searchsorted(self.keys, distinct)
        # the end id is one more "word" of one id after each text
        flat = np.append(self.flat, self.dtype.type(end_id))
        word_start, word_len = self.start[at][each], self.length[at][each]
        word_start = np.insert(word_start, of_text[1:], len(flat) - 1)
        word_len = np.insert(word_len, of_text[1:], 1)
        total = np.concatenate([[0], np.cumsum(word_len)])
        first = np.concatenate([[0], total[of_text[1:] + np.arange(1, len(of_text))]])
        return flat[ranges(word_start, word_len)], first


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
