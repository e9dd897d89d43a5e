"""Byte-pair encoders built from public tokenizer files.

The file's bytes are broadcast (they are a fixed file of one or two megabytes,
not data), so executors need no path.  Encoders are kept per worker process.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

# The splitting pattern of a byte-level tokenizer file with "use_regex".
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# The splitting pattern of a word BPE file, without special strings.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
# Below this character every printable one is in composed form already, so that
# lower case and WORD_PATTERN alone give the pieces; others go through the file's own steps.
PLAIN_BELOW = "\u0250"
END_OF_WORD = "</w>"
# Words kept in a worker's cache before it starts anew: bounds the worker's memory.
CACHE_WORDS = 300_000

_WORD_PIECES = regex.compile(WORD_PATTERN).findall
# A character (or special string) that keeps a text from the plain path.
_ODD = re.compile(f"[^\t-\r -~\u00a1-\u00ac\u00ae-{chr(ord(PLAIN_BELOW) - 1)}]|<\\|").search
_WHITE = re.compile("[\t-\r]").sub
# Pieces other than runs of letters, below PLAIN_BELOW: contractions, runs of signs, single digits.
_SIGNS = re.compile(r"[^\w\s]+").sub  # the same for a text without the characters that follow
_SINGLES = re.compile(r"['_\d²³¹¼½¾]").search
_PARTED = re.compile(r"'(?:s|t|re|ve|m|ll|d)|(?:[^\w\s]|_)+|[\d²³¹¼½¾]").sub
_ENCODERS: dict[tuple[str, bytes], object] = {}


def read_vocabulary(spark, path: str):
    """Broadcast the tokenizer file at ``path`` (a fixed file, read by the driver)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _byte_alphabet() -> dict[str, int]:
    """Printable character -> byte of byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take the code
    points from 256 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _to_bytes(token: str, alphabet: dict[str, int]) -> bytes:
    return bytes(alphabet[c] for c in token)


class ByteBpe:
    """Byte-level BPE file: ids of a text, special strings taken as their tokens."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        alphabet = _byte_alphabet()
        ranks = {_to_bytes(t, alphabet): i for t, i in spec["model"]["vocab"].items() if t not in {a["content"] for a in spec["added_tokens"]}}
        special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self._raw = raw
        self._slow: Tokenizer | None = None
        self._fast = tiktoken.Encoding("byte-bpe", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = [s.encode() for s in special]
        self.token_bytes = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for t, i in [*ranks.items(), *((s.encode(), i) for s, i in special.items())]:
            self.token_bytes[i] = len(t)

    def encode(self, text: str) -> np.ndarray:
        """Ids as unsigned 32-bit integers."""
        try:
            return self._fast.encode_to_numpy(text, allowed_special="all")
        except BaseException as e:  # a panic of the splitting engine, e.g. on a giant run of white space
            if isinstance(e, KeyboardInterrupt | SystemExit | MemoryError):
                raise
            if self._slow is None:
                self._slow = Tokenizer.from_str(self._raw.decode())
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)


class WordBpe:
    """BPE file with word ends: per-word ids by forced boundaries.

    ``never[a, b]`` is true for byte pairs that occur inside no vocabulary
    token.  No merge can span such a pair, so every word may be cut there and
    the fragments encoded by themselves.  White space occurs in no token at
    all, hence texts are first cut at ASCII white space; then the file's own
    normalizer and splitter give the words' pieces, which are cut at the
    ``never`` pairs.
    """

    def __init__(self, raw: bytes):
        self._tokenizer = Tokenizer.from_str(raw.decode())
        spec = json.loads(raw)
        splits = [p.get("pattern", {}).get("Regex", "") for p in spec["pre_tokenizer"].get("pretokenizers", [])]
        self._plain = WORD_PATTERN in [x.replace("[\\p{L}]", "\\p{L}").replace("[\\p{N}]", "\\p{N}") for x in splits]
        alphabet = _byte_alphabet()
        self._alphabet = alphabet
        special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self._special = {s.encode(): i for s, i in special.items()}
        self._special_at = re.compile(b"(" + b"|".join(re.escape(s) for s in self._special) + b")")
        self.names = {i: t for t, i in self._tokenizer.get_vocab(with_added_tokens=True).items()}
        ranks: dict[bytes, int] = {}
        inside = np.zeros((256, 256), bool)
        for token, i in spec["model"]["vocab"].items():
            if token in special:
                continue
            # the blank marks the end of a word: no token holds white space
            ends = token.endswith(END_OF_WORD) and token != END_OF_WORD
            body = _to_bytes(token.removesuffix(END_OF_WORD) if ends else token, alphabet)
            ranks[body + b" " * ends] = i
            if len(body) > 1:
                b = np.frombuffer(body, np.uint8)
                inside[b[:-1], b[1:]] = True
        self.never = ~inside
        self._inside = frozenset(map(tuple, np.argwhere(inside).tolist()))
        self._fast = tiktoken.Encoding("word-bpe", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self._single = self._fast._core_bpe.encode_single_piece

    def fragments(self, piece: bytes) -> list[bytes]:
        """Cut one splitter piece at the byte pairs that no token holds."""
        if self._inside.issuperset(zip(piece, piece[1:], strict=False)):
            return [piece]
        cuts = [i for i, pair in enumerate(zip(piece, piece[1:], strict=False), 1) if pair not in self._inside]
        return [piece[a:b] for a, b in zip([0, *cuts], [*cuts, len(piece)], strict=True)]

    def pieces(self, word: bytes) -> list[bytes]:
        """Splitter pieces of a text without special strings, normalized."""
        if self._plain and word.isalpha():  # ASCII letters only: one piece
            return [word.lower()]
        text = word.decode()
        if self._plain and max(text) < PLAIN_BELOW and text.isprintable():
            return [p.encode() for p in _WORD_PIECES(text.lower())]
        normal = self._tokenizer.normalizer.normalize_str(text)
        return [_to_bytes(p, self._alphabet) for p, _ in self._tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def encode_text(self, text: bytes) -> bytes:
        """Little-endian ids of a whole text.

        A plain text is lower-cased, its pieces are parted by blanks (which
        also mark their ends) and all are encoded in one call; any other text
        goes word by word.
        """
        chars = text.decode()
        if not self._plain or _ODD(chars):
            return array("I", [i for word in text.split() for i in self.encode_word(word)]).tobytes()
        blanks = _WHITE(" ", chars.lower()) + " "
        parted = _PARTED(r" \g<0> ", blanks) if _SINGLES(blanks) else _SIGNS(r" \g<0> ", blanks)
        return array("I", self._fast._core_bpe.encode_ordinary(parted)).tobytes()

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of a string without ASCII white space."""
        out: list[int] = []
        for part in self._special_at.split(word) if b"<|" in word else [word]:
            if part in self._special:
                out.append(self._special[part])
                continue
            for piece in self.pieces(part) if part else []:
                *inner, last = self.fragments(piece)
                for f in inner:
                    out += self._single(f)
                out += self._single(last + b" ")
        return out


class WordCache(dict):
    """word -> little-endian ids; filled on demand, started anew when full."""

    def __init__(self, encoder: WordBpe):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: bytes) -> bytes:
        ids = array("I", self.encoder.encode_word(word)).tobytes()
        if len(word) <= 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """Little-endian ids of a whole text."""
        return b"".join(map(self.__getitem__, text.split()))


def encoder(kind: type, raw: bytes):
    """The worker's encoder of ``kind`` for a tokenizer file, built once."""
    key = (kind.__name__, hashlib.sha256(raw).digest())
    if key not in _ENCODERS:
        _ENCODERS[key] = kind(raw)
    return _ENCODERS[key]


def word_cache(raw: bytes) -> WordCache:
    """The worker's word cache for a tokenizer file."""
    key = ("cache", hashlib.sha256(raw).digest())
    if key not in _ENCODERS:
        _ENCODERS[key] = WordCache(encoder(WordBpe, raw))
    return _ENCODERS[key]
