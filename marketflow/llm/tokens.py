"""Pre-token caches around a byte-level BPE vocabulary, equal to the library's own encoding.

A byte-level BPE encodes each pre-token by itself, so a text's ids are those of
its pre-tokens in order. Texts whose code points are all at most U+024F are split
by the pattern below, where its classes are written out; any other text by the
library's own splitter, which knows the classes of all scripts. Long texts are
walked piece by piece, cut where white space begins, which always is a border
between pre-tokens. Added special tokens inside a text become their one id, as is
the library's default.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# The letters, numbers and white space of Unicode up to U+024F, and the
# splitting pattern of byte-level BPE vocabularies of this family.
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBER = "0-9²³¹¼-¾"
SPACE = "\t-\r \u0085 "
PRE_TOKEN = re.compile(
    rf" ?[{LETTER}]+|'(?:s|t|re|ve|m|ll|d)| ?[{NUMBER}]+| ?[^{LETTER}{NUMBER}{SPACE}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
BEYOND = re.compile("[^\u0000-\u024f]")
LONG_WORD = 1 << 14  # signs without a border from which the library encodes a piece
PIECE = 1 << 16  # code points of a piece of a long text, or more where no white space begins
BORDER = re.compile(r"(?<=\S)[ \t\r\n]")
_RUN = re.compile(rf"\S{{{LONG_WORD},}}|\s{{{LONG_WORD},}}")


def pieces_of(text: str):
    """A text in pieces that no pre-token crosses."""
    at = 0
    while len(text) - at > 2 * PIECE:
        border = BORDER.search(text, at + PIECE)
        if border is None:
            break
        yield text[at:border.start()]
        at = border.start()
    yield text[at:] if at else text


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_signs() -> dict[int, str]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves, the others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in plain else next(rest)) for b in range(256)}


class Encoder:
    """The library's tokenizer, with pre-token splitting and the special strings it looks for."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        splitter = parts.get("pre_tokenizer") or {}
        if (parts.get("model", {}).get("type") != "BPE" or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space")
                or splitter.get("use_regex") is False or parts.get("normalizer") is not None):
            raise ValueError(f"{path} holds no byte-level BPE with the splitting pattern known here")
        self.library = Tokenizer.from_file(path)
        self.splitter = self.library.pre_tokenizer
        self.model, self.signs = self.library.model, byte_signs()
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special_split = (re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
                              if self.special else None)

    def ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def pre_token(self, token: str) -> list:
        """The library's merges on one pre-token, without its pipeline around them."""
        return self.model.tokenize(token.encode().decode("latin-1").translate(self.signs))

    def split(self, text: str):
        """The pre-tokens of an ordinary text."""
        for piece in pieces_of(text):
            if piece.isascii() or not BEYOND.search(piece):
                yield from PRE_TOKEN.findall(piece)
            else:
                for _, (start, end) in self.splitter.pre_tokenize_str(piece):
                    yield piece[start:end]

    def pieces(self, text: str):
        """The text as (special id, "") and (None, ordinary text) runs."""
        parts = self.special_split.split(text) if self.special_split else [text]
        return [(self.special[p], "") if i % 2 else (None, p) for i, p in enumerate(parts) if p]


class Cache(dict):
    """Pre-token -> value, computed when first met.

    Two generations of at most ``most`` entries: a full one is set aside and the
    one before it dropped, so what is met often stays and memory is bounded.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, token):
        value = self.before.get(token)
        if value is None:
            value = self.make(token)
            if len(token) > 64:
                return value
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[token] = value
        return value


class IdEncoder:
    """Texts to their ids as little-endian unsigned 32-bit bytes.

    Ordinary texts go through the merge loop of ``tiktoken``, built from the same
    vocabulary file: the ranks are its ids and the pattern is the one above with
    the classes of all scripts, so the ids are the library's (the tests compare
    them). A piece with ``LONG_WORD`` signs in a row with or without white space, for
    which that loop is slow or fails, goes through the library itself.
    """

    def __init__(self, path: str):
        import tiktoken
        self.encoder = Encoder(path)
        byte = {sign: b for b, sign in byte_signs().items()}
        ranks = {bytes(byte[c] for c in token): i for token, i in self.encoder.library.get_vocab(False).items()}
        pattern = PRE_TOKEN.pattern.replace(f"[^{SPACE}]", "\\S").replace(f"[{SPACE}]", "\\s").replace(SPACE, "\\s")
        pattern = pattern.replace(LETTER, "\\p{L}").replace(NUMBER, "\\p{N}")
        self.merges = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _ordinary(self, text: str) -> bytes:
        if len(text) > LONG_WORD and _RUN.search(text):
            return np.array(self.encoder.ids(text), "<u4").tobytes()
        return self.merges.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(b"".join(map(self._ordinary, pieces_of(part))) if special is None else int(special).to_bytes(4, "little")
                        for special, part in self.encoder.pieces(text))


class Counts(dict):
    """Two tiers: the frequent pre-tokens' lengths, then a bounded cache of the others."""

    def __init__(self, frequent: dict[str, int], path: str, most: int = 1 << 18):
        super().__init__(frequent)
        self.encoder = Encoder(path)
        self.rare = Cache(lambda t: len(self.encoder.pre_token(t)), most)

    def __missing__(self, token):
        return self.rare[token]

    def count(self, text: str) -> int:
        look = self.__getitem__
        return sum(1 if special is not None else sum(map(look, self.encoder.split(part)))
                   for special, part in self.encoder.pieces(text))
