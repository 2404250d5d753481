"""Token ids of whole texts, exact, with each worker's own cache of what texts are made of."""

from __future__ import annotations

import functools
import re
from array import array

import numpy as np
import regex

from railtide.llm.tokens import BYTE_LETTERS, Counts

# pieces a worker remembers before it starts anew, and the longest that it remembers
CACHE_ENTRIES = 200_000
CACHE_CHARS = 64

# how byte-level vocabularies write each byte
LETTER_OF = [BYTE_LETTERS.get(b, chr(b)) for b in range(256)]

_workers: dict[tuple, "ByteIds | PieceIds"] = {}


def packed(ids) -> bytes:
    """Ids as unsigned 32-bit numbers, little end first."""
    return np.asarray(ids, dtype="<u4").tobytes()


class ByteIds(Counts):
    """Pre-token to packed ids of a byte-level vocabulary.

    ``special`` says whether strings of added tokens inside a text become those tokens (the
    library's default) or are ordinary text.  ``odd`` is the result of ``odd_pattern``, which takes
    seconds to find and so comes from the driver.
    """

    def __init__(self, name: str, special: bool, odd: str, entries: int):
        super().__init__(name)
        self.entries = entries
        self.library.encode_special_tokens = not special
        added = sorted(self.library.get_added_tokens_decoder().items(), key=lambda kv: -len(kv[1].content))
        self.special_ids = {a.content: packed([i]) for i, a in added} if special else {}
        self.halves = regex.compile("|".join(f"({regex.escape(c)})" for c in self.special_ids)).split if self.special_ids else None
        self.odd = regex.compile(odd).search
        self.written = [packed([i]) for i in range(self.library.get_vocab_size(with_added_tokens=True))]
        # a vocabulary with every byte gives back every piece
        self.closed = set(LETTER_OF) <= self.library.get_vocab(with_added_tokens=False).keys()
        self.exact = True

    @functools.cached_property
    def token_bytes(self) -> list[bytes]:
        """Bytes of each id."""
        letters = {c: b for b, c in enumerate(LETTER_OF)}
        out = [b""] * self.library.get_vocab_size(with_added_tokens=True)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        return out

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "surrogatepass")
        ids = [t.id for t in self.library.model.tokenize("".join([LETTER_OF[b] for b in raw]))]
        out = b"".join([self.written[i] for i in ids])
        if len(self) >= self.entries:
            self.clear()
        if not self.closed and b"".join(map(self.token_bytes.__getitem__, ids)) != raw:
            self.exact = False
        elif len(piece) <= CACHE_CHARS:
            self[piece] = out
        return out

    def ids(self, text: str) -> bytes:
        """Packed ids of a text."""
        of = self.__getitem__
        if not self.plain or self.beyond(text) and self.odd(text):
            self.exact = False
            return packed(self.library.encode(text, add_special_tokens=False).ids)
        if self.halves is None:
            return b"".join(map(of, self.pieces(text)))
        return b"".join(
            self.special_ids[part] if part in self.special_ids else b"".join(map(of, self.pieces(part)))
            for part in self.halves(text) if part
        )

    def covers(self, ids: bytes, raw: bytes) -> bool:
        """Whether the ids' bytes are those; what the cache holds was compared when it was encoded."""
        return self.exact or b"".join(map(self.token_bytes.__getitem__, array("I", ids))) == raw


class PieceIds(dict):
    """Blanks with the word behind them to packed ids of a piece vocabulary with blanks as U+2581.

    A vocabulary whose pieces have that mark only in front never merges across the end of a word,
    so words are encoded one by one; any other vocabulary encodes whole texts.  So do texts with the
    mark itself or a blank at the end.
    """

    def __init__(self, name: str, entries: int):
        super().__init__()
        self.entries = entries
        import public_tokenizers
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.token_bytes = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.words = re.compile(" +[^ ]*").findall
        self.exact = True
        # pieces, normal form and blanks all as they stand, or words cannot be taken alone
        probe = "a  b   c \t Ａééﬁ​\r\n  d "
        self.plain = not any("▁" in p.lstrip("▁") for p in pieces) and self.bytes_of(self.library.encode(probe)) == f" {probe}".encode()

    def bytes_of(self, ids) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.entries:
            self.clear()
        ids = self.library.encode(word[1:], num_threads=1)  # the library puts the first blank back
        if not ids:  # a blank alone
            self.exact = False
        out = packed(ids)
        if self.bytes_of(ids) != word.encode("utf-8", "surrogatepass"):
            self.exact = False
        elif len(word) <= CACHE_CHARS:
            self[word] = out
        return out

    def ids(self, text: str) -> bytes:
        """Packed ids of a text."""
        if not self.plain or not text or text.endswith(" ") or "▁" in text:
            self.exact = False
            return packed(self.library.encode(text, num_threads=1))
        return b"".join(map(self.__getitem__, self.words(f" {text}")))

    def covers(self, ids: bytes, raw: bytes) -> bool:
        return self.exact or self.bytes_of(array("I", ids)) == raw


@functools.cache
def odd_pattern(name: str) -> str:
    """Pattern of the characters for which a text must go through the tokenizer's library."""
    return Counts(name).odd_characters


def byte_ids(name: str, special: bool = True, odd: str | None = None, entries: int = CACHE_ENTRIES) -> ByteIds:
    """This worker's encoder of a byte-level vocabulary; it remembers up to ``entries`` pieces."""
    if (name, special) not in _workers:
        _workers[name, special] = ByteIds(name, special, odd if odd is not None else odd_pattern(name), entries)
    return _workers[name, special]


def piece_ids(name: str, entries: int = CACHE_ENTRIES) -> PieceIds:
    """This worker's encoder of a piece vocabulary; it remembers up to ``entries`` words."""
    if (name,) not in _workers:
        _workers[name,] = PieceIds(name, entries)
    return _workers[name,]
