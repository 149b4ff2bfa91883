"""Fast exact token ids from the public tokenizers library.

A text is cut where no piece of the supported pre-tokenizers can span: before a run of blanks after
something visible, and between ASCII letters, digits and marks. Cuts, different chunks and
the ids of a slice of texts are found by numpy and Arrow; the library encodes each chunk
that a worker has not met lately, plain words by its model alone, since there is nothing to
normalise or to split. Texts that hold the string of a special token go to the library whole.
"""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from threadloom.llm.common import text_bytes

# A worker remembers up to twice so many chunks of at most _LONGEST characters, about 200 bytes each.
_REMEMBERED = 250_000
_LONGEST = 64
_BATCH = 4096

_BLANK, _LETTER, _DIGIT, _MARK, _OTHER, _SPACE = range(6)
_CLASSES = np.full(256, _OTHER, np.uint8)
_CLASSES[[ord(c) for c in " \n"]] = _BLANK
_CLASSES[[ord(c) for c in "\t\r\v\f\x1c\x1d\x1e\x1f"]] = _SPACE
for _code in range(33, 127):
    if chr(_code) != "'":  # an apostrophe may belong to the letters after it
        _CLASSES[_code] = _LETTER if chr(_code).isalpha() else _DIGIT if chr(_code).isdigit() else _MARK
# Cut between a character of class a and one of class b: element 8 * a + b.
_CUTS = np.zeros(48, bool)
for _a in (_LETTER, _DIGIT, _MARK, _OTHER):
    _CUTS[8 * _a + _BLANK] = True
_WORD_CUTS = _CUTS.copy()
for _a in (_LETTER, _DIGIT, _MARK):
    for _b in (_LETTER, _DIGIT, _MARK):
        _WORD_CUTS[8 * _a + _b] = _a != _b
# White space of several bytes, by its first byte.
_WIDE_SPACE = {
    0xC2: re.compile(b"\xc2[\x85\xa0]"),
    0xE1: re.compile(b"\xe1\x9a\x80"),
    0xE2: re.compile(b"\xe2(?:\x80[\x80-\x8a\xa8\xa9\xaf]|\x81\x9f)"),
    0xE3: re.compile(b"\xe3\x80\x80"),
}
# The characters that stand for the bytes of a piece: printable ones for themselves, the rest from 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_CHARS = {byte: 256 + n for n, byte in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BLANK_CHAR = chr(_BYTE_CHARS[ord(" ")])
_FIRST_FAR = "\u0180"  # letters before it are composed and, but for one, have a lower case of one letter
_FAR_LOWER = "\u0130"
_PROBES = ["a", "word", "W", "Wordly", "é", "Ünïcödéd", " word", " Été", "zqxj", " łódź"]
# Its lower case depends on the letters around it, marks between them left aside.
_SIGMA = "Σ".encode()


def _classes(raw: np.ndarray, data: bytes) -> np.ndarray:
    classes = _CLASSES[raw]
    for lead, pattern in _WIDE_SPACE.items():
        if lead in data:
            for found in pattern.finditer(data):
                classes[found.start() : found.end()] = _SPACE
    return classes


def chunk_starts(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the chunks of all texts begin, ascending; ``starts`` are the row offsets, the end included."""
    data = raw.tobytes()
    classes = _classes(raw, data)
    first = np.zeros(len(raw) + 1, bool)
    first[1 : len(raw)] = (_CUTS if _SIGMA in data else _WORD_CUTS)[(classes[:-1] << 3) + classes[1:]]
    first[starts] = True
    first[len(raw)] = False
    return np.flatnonzero(first)


def _piece(word: str) -> str:
    """A word, after one blank perhaps, in the characters that stand for its bytes."""
    if word.isascii():
        return word.replace(" ", _BLANK_CHAR)
    return word.encode().decode("latin-1").translate(_BYTE_CHARS)


class ChunkEncoder:
    """Ids of texts; chunks met lately come from bounded memory."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        # Blanks and case vanish only if the tokenizer drops them.
        one, blank, upper = (ids for ids in self._encode(["a", " a", "A"]))
        self.drops_blanks, self.drops_case = one == blank, one == upper
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = "|".join(map(re.escape, special))
        self.words_by_model = False
        self.words_by_model = all(self._model_ids(k) == i for k, i in zip(map(self._key, _PROBES), self._encode(_PROBES), strict=True))
        # Two generations: what is met again moves to the newer one, the older one is dropped when that is full.
        self.newer: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _key(self, chunk: str) -> str:
        """What decides the ids of a chunk."""
        if self.drops_blanks:
            chunk = chunk.strip(" \n")
        if self.drops_case and (chunk.isascii() or (max(chunk) < _FIRST_FAR and _FAR_LOWER not in chunk)):
            return chunk.lower()
        return chunk

    def _is_word(self, key: str) -> bool:
        """Letters that are one piece and need no normalisation."""
        letters = key if self.drops_blanks or key[0] != " " else key[1:]
        return letters.isalpha() and (key.isascii() or max(key) < _FIRST_FAR) and not (self.drops_case and _FAR_LOWER in key)

    def _model_ids(self, key: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(_piece(key))]

    def _learn(self, keys: list[str]) -> dict[str, bytes]:
        """The ids of keys that the worker does not know."""
        ids: dict[str, list[int]] = {}
        if self.words_by_model:
            # Read once: every access to the model copies its handle.
            tokenize, is_word = self.tokenizer.model.tokenize, self._is_word
            ids = {key: [t.id for t in tokenize(_piece(key))] for key in keys if key and is_word(key)}
        rest = [key for key in keys if key not in ids]
        for a in range(0, len(rest), _BATCH):
            part = rest[a : a + _BATCH]
            ids.update(zip(part, self._encode(part), strict=True))
        ends = np.cumsum([4 * len(x) for x in ids.values()]).tolist()
        flat = np.asarray([i for x in ids.values() for i in x], "<u4").tobytes()
        return {key: flat[a:b] for key, a, b in zip(ids, [0, *ends], ends, strict=False)}

    def _lookup(self, chunks: list[str]) -> list[bytes]:
        """The ids of different chunks."""
        keys = list(map(self._key, chunks)) if self.drops_blanks or self.drops_case else chunks
        newer, older = self.newer, self.older
        found = list(map(newer.get, keys))
        fresh: dict[str, bytes | None] = {}
        for i, ids in enumerate(found):
            if ids is None:
                key = keys[i]
                ids = older.get(key)
                if ids is None:
                    fresh[key] = None
                else:
                    newer[key] = found[i] = ids
        if fresh:
            fresh = self._learn(list(fresh))
            found = [fresh[key] if ids is None else ids for ids, key in zip(found, keys, strict=True)]
            newer.update((key, ids) for key, ids in fresh.items() if len(key) <= _LONGEST)
        if len(newer) > _REMEMBERED:
            self.older = newer if len(newer) <= 2 * _REMEMBERED else {}
            self.newer = {}
        return found

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """Little-endian unsigned 32-bit ids of every text; a null text has none."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.large_string())
        out: list[np.ndarray] = self._encode_plain(texts)
        if self.special:
            marked = pc.fill_null(pc.match_substring_regex(texts, self.special), False)
            for row in np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist():
                out[row] = np.asarray(self.tokenizer.encode(texts[row].as_py(), add_special_tokens=False).ids, "<u4")
        return out

    def _encode_plain(self, texts: pa.Array) -> list[np.ndarray]:
        raw, starts = text_bytes(texts)
        if not len(raw):
            return [np.zeros(0, "<u4")] * len(texts)
        begins = chunk_starts(raw, starts)
        offsets = np.append(begins, len(raw))
        chunks = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(raw))
        coded = chunks.dictionary_encode()
        which = coded.indices.to_numpy()
        ids = self._lookup(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat = np.frombuffer(b"".join(ids), "<u4")
        first = np.cumsum(lengths) - lengths
        taken = lengths[which]
        ends = np.cumsum(taken)
        # Id k of the slice lies at the chunk's place among the different ones plus its place in the chunk.
        shift = first[which] - (ends - taken)
        every = flat[np.repeat(shift, taken) + np.arange(ends[-1])]
        bounds = np.concatenate(([0], ends))[np.searchsorted(begins, starts)].tolist()
        return [every[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def encoder(path: str) -> ChunkEncoder:
    """The worker's encoder for ``path``.

    Python workers are reused by later tasks. This package travels to them by value, so
    what is to outlive a task is kept in a module of the worker itself.
    """
    kept = sys.modules.setdefault("threadloom_worker", types.ModuleType("threadloom_worker"))
    encoders = kept.__dict__.setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = ChunkEncoder(path)
    return encoders[path]
