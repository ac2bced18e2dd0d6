"""Token ids of whole texts, with a cache of the ids of pre-tokenizer pieces.

The tokenizer named by the caller lower-cases, drops white space and encodes each piece alone, by
its bytes, so a text's ids are its pieces' ids in order. Texts of common characters (SAFE:
normalization leaves them as they are but for case) are cut by PIECES; a piece that a process has
not met goes to the tokenizer's model. All other texts are encoded whole. The cache has two
generations: what is met again outlives the fall of the older one.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

#: Letters whose normal form is themselves, and the tokenizer's pieces over them.
LETTERS = "a-zß-öø-ÿœ"
UNSAFE = re.compile("[^\t\n\r -~À-ÖØ-öø-ÿŒœ–—‘’“”…«»•€¿¡]")
PIECES = re.compile(rf"[{LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\s{LETTERS}0-9]+")
#: Pieces in both generations together.
MOST_CACHED = 150_000
#: Encoded in both ways when an encoder is made.
PROBE = "it's A1 22 über, don't «naïve»!? l'été … €%&* straße—x’s the toxicity 3rd"
_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The process's encoder for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


class Pieces(dict):
    """The ids of pieces as bytes; a piece that is not there is taken from the older generation or made."""

    def __init__(self, make: Callable[[str], bytes], older: Pieces | None = None):
        super().__init__()
        self.make, self.older = make, dict(older or {})

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        self[piece] = ids = self.make(piece) if ids is None else ids
        return ids


class PieceEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        safe = (chr(c) for c in range(0x80, 0x2100) if not UNSAFE.match(chr(c)))
        letters = {ord(c): level.pre_tokenize_str(c)[0][0] for c in safe}
        cut, ids = self.tokenizer.model.tokenize, [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.known = Pieces(lambda p: b"".join([ids[t.id] for t in cut(p if p.isascii() else p.translate(letters))]))
        if self.encode([PROBE]) != [self.whole(PROBE)]:
            raise ValueError("the tokenizer cuts other pieces than PIECES")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        out = []
        for text in texts:
            if UNSAFE.search(text):
                out.append(self.whole(text))
                continue
            if len(self.known) > MOST_CACHED // 2:
                self.known = Pieces(self.known.make, self.known)
            out.append(b"".join(map(self.known.__getitem__, PIECES.findall(text.lower()))))
        return out
