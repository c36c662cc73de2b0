"""Token ids of whole texts with a bounded memo of encoded words.

A tokenizer with word-wise pre-tokenisation gives the same ids for a text as for its pieces, if the text is cut where its
pre-tokeniser cuts. Texts repeat most of their pieces, so each piece is encoded by the tokenizers library once and
remembered; when the memo is full, the pieces not used of late are forgotten. Texts of Latin letters are cut at every
pre-token, which the library's BPE model takes directly; other texts are cut only at plain white space, and texts with
rarer white space are not cut, and both pass the library's whole tokenizer.

Special tokens' strings in a text are ordinary text (the library's encode_special_tokens=True, as the tokenizers' own README
uses them); with special_as_text=False a text that holds one goes through the whole tokenizer and gets that token's id there.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array


def _class(points: list[int]) -> str:
    """Code points as the inside of a character class."""
    out, runs = [], []
    for p in points:
        if runs and runs[-1][1] == p - 1:
            runs[-1][1] = p
        else:
            runs.append([p, p])
    for lo, hi in runs:
        out.append(f"\\u{lo:04x}-\\u{hi:04x}")
    return "".join(out)


#: White space other than space, tab, line feed and return, the ASCII ones first: such texts go to the library whole. A
#: search for one character costs a small part of a pattern's, even for all of them.
_RARE_ASCII = [*map(chr, (0x0B, 0x0C, *range(0x1C, 0x20)))]
_RARE_SPACE = [*_RARE_ASCII, *map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))]
#: Letters and digits below U+0250, where text is in normal form C as it stands.
_BEYOND = re.compile("[^\\u0000-\\u024f]")
_L, _N = (_class([p for p in range(0x250) if unicodedata.category(chr(p))[0] == kind]) for kind in "LN")
_CLITIC = "'s|'t|'re|'ve|'m|'ll|'d"  # fixed by the tokenizers' own patterns
#: Pre-tokens of Latin texts, and coarser chunks of the others, by kind of pre-tokeniser. "byte": a word takes one space
#: before it, and of a run of spaces the last stands apart; "word": lower case, white space dropped.
_PIECES = {
    "byte": re.compile(f"{_CLITIC}| ?[{_L}]+| ?[{_N}]+| ?[^ \\t\\n\\r{_L}{_N}]+|[ \\t\\n\\r]+(?![^ \\t\\n\\r])|[ \\t\\n\\r]+"),
    "word": re.compile(f"{_CLITIC}|[{_L}]+|[{_N}]|[^ \\t\\n\\r{_L}{_N}]+"),
}
_CHUNKS = {
    "byte": re.compile(r" ?[^ \t\n\r]+|[ \t\n\r]+(?![^ \t\n\r])|[ \t\n\r]+?(?=(?: |[\t\n\r])[^ \t\n\r])|[\t\n\r]"),
    "word": re.compile(r"[^ \t\n\r]+"),
}
#: Pieces remembered in each of two generations.
MEMO = 400_000


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level models write for each byte: visible Latin-1 bytes stand for themselves, the others for
    the letters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b if b in plain else 256 + others.index(b)) for b in range(256)}


def _latin(text: str) -> bool:
    """Whether no character is beyond U+024F."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not _BEYOND.search(text)
    return True


class _Memo(dict):
    """Ids by piece; what is missing comes from the older generation or from the encoder."""

    def __init__(self, encode, older: dict):
        super().__init__()
        self.encode, self.older = encode, older

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece)
        self[piece] = ids
        return ids


class ChunkEncoder:
    """Little-endian unsigned 32-bit ids of texts."""

    def __init__(self, path: str, kind: str, memo: int = MEMO, special_as_text: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if not (special_as_text and t.special)]
        self.special = re.compile("|".join(map(re.escape, added)), re.I) if added else None
        self.pieces, self.chunks, self.lower = _PIECES[kind].findall, _CHUNKS[kind].findall, kind == "word"
        self.letters, self.bpe, self.memo = _byte_letters(), self.tokenizer.model.tokenize, memo
        self.known, self.known_chunks = _Memo(self._piece, {}), _Memo(self._whole, {})

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            piece = piece.replace(" ", self.letters[32])
        else:
            piece = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.bpe(piece)]).tobytes()

    def encode(self, text: str) -> bytes:
        ascii_only = text.isascii()
        if any(map(text.__contains__, _RARE_ASCII if ascii_only else _RARE_SPACE)) or self.special and self.special.search(text):
            return self._whole(text)
        if not ascii_only and not _latin(text):
            if len(self.known_chunks) > self.memo // 4:
                self.known_chunks = _Memo(self._whole, {})
            return b"".join(map(self.known_chunks.__getitem__, self.chunks(text)))
        if len(self.known) > self.memo:
            self.known.older = {}
            self.known = _Memo(self._piece, self.known)
        return b"".join(map(self.known.__getitem__, self.pieces(text.lower() if self.lower else text)))

    def forget_older(self) -> None:
        """Give up the older generation; what is still in use is in the other."""
        self.known.older = {}


_encoders: dict[tuple[str, str], ChunkEncoder] = {}


def encoder(path: str, kind: str, memo: int = MEMO) -> ChunkEncoder:
    """One encoder for each tokenizer file and Python worker, so that its memo outlives a task."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = ChunkEncoder(path, kind, memo)
    return _encoders[path, kind]
