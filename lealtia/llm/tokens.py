"""Token ids of whole texts, with a memory of the pieces seen before."""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterable
from functools import lru_cache

import numpy as np

#: A piece is a run of white space and the run of other characters behind it, cut where punctuation
#: follows letters. Both vocabularies start a new unit at such a border, so pieces can be encoded on
#: their own. The four separators count as ordinary characters, as in the tokenizers.
PIECE = re.compile(
    r"[^\S\x1c-\x1f]*+(?:[A-Za-zÀ-ÖØ-öø-ÿ]++(?=[.,;:!?*&%$#()|<>\" \n]|\Z)|[\S\x1c-\x1f]++)|[^\S\x1c-\x1f]++"
)
#: A word of plain letters with the blanks around it, and the small and capital letters of such words.
WORD = re.compile(r"[ \t\n\r]*([A-Za-zÀ-ÖØ-öø-ÿ]+)[ \t\n\r]*")
SMALL = "".join(c for c in map(chr, (*range(0x61, 0x7B), *range(0xDF, 0x100))) if c.isalpha())
CAPITALS = "".join(c for c in map(chr, (*range(0x41, 0x5B), *range(0xC0, 0xDF))) if c.isalpha())
#: So many pieces are remembered; then the memory starts anew. It changes no ids.
REMEMBERED = 1_000_000
END_ID = np.array([1], "<u4").tobytes()

#: Tokenizers are never trained here; the path of a vocabulary file is a parameter.
BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str) -> str:
    """The file of a public vocabulary, on the machine that calls this."""
    import public_tokenizers

    return public_tokenizers.path(name)


def letter_forms(tokenizer) -> dict[int, str] | None:
    """What the model reads for each small letter, if the vocabulary takes words of plain letters alike in either case
    and with or without blanks around, and hands small ones whole and letter by letter to the model; else None."""
    normalizer, cutter = tokenizer.normalizer, tokenizer.pre_tokenizer
    if cutter is None:
        return None
    cut = lambda text: [part for part, _ in cutter.pre_tokenize_str(text)]
    ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    forms = {ord(c): "".join(cut(c)) for c in SMALL}
    every = SMALL + SMALL[::-1]
    whole = (normalizer is None or normalizer.normalize_str(every) == every) and cut(every) == [every.translate(forms)]
    folds = ids(f" {CAPITALS}\n") == ids(CAPITALS.lower())
    added = any(set(t.content.lower()) <= set(SMALL) for t in tokenizer.get_added_tokens_decoder().values())
    return forms if whole and folds and not added else None


class Memory(dict):
    """Ids of pieces; an unknown one is encoded when it is first asked for."""

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.encode = tokenizer.encode
        #: Whether the vocabulary takes ASCII pieces alike in either case and with or without blanks around.
        self.folds = self.encode(" Ab").ids == self.encode("ab").ids
        #: With them a word needs the model alone, a third of the work of a whole encoding.
        self.forms = letter_forms(tokenizer)
        self.units = tokenizer.model.tokenize

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        word = WORD.fullmatch(piece) if self.forms else None
        if word or (self.folds and piece.isascii()):
            plain = (word[1] if word else piece.strip(" \t\n\r")).lower()
            if plain != piece:
                found = self[piece] = self[plain]
                return found
        if word:
            ids = array("I", [unit.id for unit in self.units(piece.translate(self.forms))])
        else:
            ids = array("I", self.encode(piece, add_special_tokens=False).ids)
        if sys.byteorder == "big":
            ids.byteswap()
        found = self[piece] = ids.tobytes()
        return found


class Encoder:
    """Encodes texts by a vocabulary file; the ids of a text are little-endian unsigned 32-bit numbers."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        path = vocabulary if os.path.isabs(vocabulary) else vocabulary_path(vocabulary)
        self.known = Memory(Tokenizer.from_file(path))

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text and the end id; null is empty. No text is cut."""
        known = self.known.__getitem__
        return [b"".join(map(known, PIECE.findall(text or ""))) + END_ID for text in texts]


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One encoder per Python worker, kept between its tasks."""
    return Encoder(vocabulary)
