"""Whole-text encoding with a public tokenizer file, piece by piece.

Texts are cut where no token of these files reaches over: at white space, and
between a letter and a stop after it. A batch's text is cut at once in numpy,
its pieces are dictionary-encoded by Arrow, only its different pieces are
looked up, and each worker keeps the ids of recent ones; Arrow's ``take`` puts
them together again. The cuts hold for texts within ``SAFE``: there, white
space and lower case are the same in Python and in the library, and Unicode
composition changes nothing. Any other text, and any with the opening of a
special token, goes to the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from .common import remembered

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SAFE = re.compile(r"[\x00-\x1b\x20-\u024f]*\Z")
# pieces that a worker remembers, in each of two generations (some 150 bytes each)
KEEP = 300_000
_BREAK = "\x1c"  # between texts: not within SAFE
_SPACE = np.isin(np.arange(256), [*b" \t\n\v\f\r\x1c"])
_STOP = np.isin(np.arange(256), [*b".,!?;:*$&%#"])
_LETTER = np.isin(np.arange(256), [*range(65, 91), *range(97, 123)])
# lead bytes of U+00C0 to U+017F, and second bytes there that are not letters
_LEAD = np.isin(np.arange(256), [0xC3, 0xC4, 0xC5])
_SIGN = np.isin(np.arange(256), [0x97, 0xB7])


def byte_chars() -> list[str]:
    """The printable character that byte-level files use for each byte: its
    own where Latin-1 prints it, else the next one from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in keep else chr(next(rest)) for b in range(256)]


_BYTE_TABLE = dict(enumerate(byte_chars()))


def token_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _stops(raw: np.ndarray) -> np.ndarray:
    """For each byte but the first, whether it is a stop after a letter."""
    stop = _STOP[raw[1:]]
    at = np.flatnonzero(stop)
    before = raw[at]
    letter = _LETTER[before]
    wide = at[before >= 0x80]
    wide = wide[wide > 0]
    letter[np.searchsorted(at, wide)] = _LEAD[raw[wide - 1]] & ~_SIGN[raw[wide]]
    stop[at[~letter]] = False
    return stop


def _encoded(offsets: np.ndarray, data: np.ndarray) -> pa.DictionaryArray:
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [
        None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()


def word_pieces(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Lower-cased pieces without white space, and where each text's begin."""
    whole = _BREAK.join(texts).lower().replace("\x85", " ").replace("\xa0", " ").encode()
    raw = np.frombuffer(whole, np.uint8)
    space = _SPACE[raw]
    first = ~space
    first[1:] &= space[:-1] | _stops(raw)
    spaces, start = np.flatnonzero(space), np.flatnonzero(first)
    kept = raw[~space]
    offsets = np.append(start - np.searchsorted(spaces, start), len(kept))
    breaks = spaces[raw[spaces] == ord(_BREAK)]
    bounds = np.concatenate([[0], np.searchsorted(start, breaks), [len(start)]])
    return _encoded(offsets, kept), bounds


def byte_pieces(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Pieces that make up the texts, white space included: the last space of
    a run goes to the word after it, the rest of the run is a piece, and so is
    a last white space that is no space."""
    coded = [t.encode() for t in texts]
    raw = np.frombuffer(b"".join(coded), np.uint8)
    ends = np.cumsum([len(c) for c in coded])
    inner = ends[:-1]  # where the next text begins
    space = _SPACE[raw]
    cut = np.empty(len(raw), bool)
    cut[1:] = _stops(raw) | (space[1:] & ~space[:-1]) | (~space[1:] & space[:-1] & (raw[:-1] != ord(" ")))
    last = space[:-1] & ~space[1:]
    last[inner - 1] = False  # a run at the end of a text is one piece
    cut[:-1] |= last
    cut[0] = True
    cut[inner] = True
    start = np.flatnonzero(cut)
    return _encoded(np.append(start, len(raw)), raw), np.concatenate([[0], np.searchsorted(start, inner), [len(start)]])


def together(entries: list[bytes], pieces: pa.DictionaryArray, bounds: np.ndarray) -> list[bytes]:
    """Per text, the entries of its pieces (one for each of the dictionary) in order."""
    whole = pa.array(entries, pa.large_binary()).take(pieces.indices)
    _, offsets, data = whole.buffers()
    at = np.frombuffer(offsets, np.int64)[bounds].tolist()
    view = memoryview(data) if data else b""
    return [bytes(view[a:b]) for a, b in zip(at, at[1:])]


class Known:
    """What is known of strings that were met, in two generations of about ``KEEP``."""

    def __init__(self, make):
        self.make, self.now, self.old = make, {}, {}

    def of(self, strings: list[str]) -> list:
        if len(self.now) > KEEP:
            self.now, self.old = {}, self.now
        now = self.now
        out = list(map(now.get, strings))
        miss = [i for i, x in enumerate(out) if x is None]
        again = list(map(self.old.get, [strings[i] for i in miss]))
        new = [strings[i] for i, x in zip(miss, again) if x is None]
        made = iter(self.make(new))
        for i, x in zip(miss, again):
            out[i] = now[strings[i]] = next(made) if x is None else x
        return out


class Encoder:
    """Little-endian unsigned 32-bit ids of whole texts, as the library's
    ``encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        self.vocab_size = self.lib.get_vocab_size(with_added_tokens=True)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec.get("normalizer") or {}
        kinds = {x["type"] for x in steps.get("normalizers", [steps] if steps else [])}
        byte_level = (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        # the two families of files whose chunks are known to be independent
        self.words = kinds == {"NFC", "Replace", "Lowercase"}
        self.bytes = byte_level and not kinds
        # within SAFE a lower-cased chunk without white space is normal already
        self.plain_lib = Tokenizer.from_str(self.lib.to_str())
        if self.words:
            self.plain_lib.normalizer = None
        self.known = Known(self._pieces)

    @staticmethod
    def _pack(ids: list[list[int]]) -> list[bytes]:
        at = np.concatenate([[0], 4 * np.cumsum([len(i) for i in ids], dtype=np.int64)]).tolist()
        whole = np.fromiter(chain.from_iterable(ids), "<u4", at[-1] // 4).tobytes()
        return [whole[a:b] for a, b in zip(at, at[1:])]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """The pre-tokeniser leaves letters with at most one space before them
        whole, so that the library's model can take them directly."""
        space, model, ids = byte_chars()[ord(" ")], self.plain_lib.model.tokenize, []
        rest: list[int] = []
        for i, p in enumerate(pieces):
            body = p[1:] if p[0] == " " else p
            if not body.isalpha():
                rest.append(i)
                ids.append(())
                continue
            if not body.isascii():
                body = body.encode().decode("latin-1").translate(_BYTE_TABLE)
            ids.append([t.id for t in model(space + body if p[0] == " " else body)])
        if rest:
            found = self.plain_lib.encode_batch_fast([pieces[i] for i in rest], add_special_tokens=False)
            for i, e in zip(rest, found):
                ids[i] = e.ids
        return self._pack(ids)

    def _whole(self, text: str) -> bytes:
        return self._pack([self.lib.encode(text, add_special_tokens=False).ids])[0]

    def easy(self, text: str | None) -> bool:
        if not text or "<|" in text or not SAFE.match(text):
            return False
        return self.words or self.bytes and "\x85" not in text and "\xa0" not in text

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; a null is empty."""
        easy = [i for i, t in enumerate(texts) if self.easy(t)]
        out = [b""] * len(texts)
        if easy:
            pieces, bounds = (word_pieces if self.words else byte_pieces)([texts[i] for i in easy])
            made = together(self.known.of(pieces.dictionary.to_pylist()), pieces, bounds)
            for i, b in zip(easy, made):
                out[i] = b
        for i in set(range(len(texts))).difference(easy):
            out[i] = self._whole(texts[i]) if texts[i] else b""
        return out


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


remembered("encoder", encoder)
