"""Whole texts to token ids with a tokenizers file, as bytes of little-endian unsigned 32-bit integers."""

from __future__ import annotations

import json
import re
from array import array

from .common import worker_cache

#: The tokenizer of the queries; every operator takes another path as a parameter.
TOKENIZER, END_ID = "word_bpe_49k.json", 1
#: Words kept at once in a worker, so that its memory is bounded; beyond it a new generation starts.
MOST_WORDS = 200_000


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordIds(dict):
    """Words (bytes without ASCII white space) to the ids of their tokens.

    For a tokenizer that drops white space and splits at it, ids of a text are those of its words, one after the other.
    Words of plain Latin letters, digits and signs are cut and lower-cased here and go to the library's model directly,
    which gives the same ids sooner; all others, and added tokens, take the library's whole path.
    """

    letters = re.compile("[a-zß-öø-ÿ]+")
    plain = re.compile("[A-Za-z0-9À-ÖØ-öø-ÿ!-&(-;=-@\\[-`{-~]+")
    pieces = re.compile("[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:-@\\[-`{-~]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.whole, self.before = Tokenizer.from_file(path), {}
        self.tokenize = self.whole.model.tokenize
        self.raw = [i.to_bytes(4, "little") for i in range(self.whole.get_vocab_size())]
        # Byte-level alphabets name printable bytes by themselves and the others by code points from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        names = {b: chr(b) for b in shown}
        names.update({b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in names)})
        self.named = {ord(c): "".join(names[b] for b in c.encode()) for c in map(chr, range(192, 256))}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.bpe(word.decode()) if word.isalpha() and word.islower() else self.other(word.decode())
        if len(self) >= MOST_WORDS:  # the words of the last generation stay at hand
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def bpe(self, piece: str) -> bytes:
        raw = self.raw
        return b"".join([raw[t.id] for t in self.tokenize(piece if piece.isascii() else piece.translate(self.named))])

    def other(self, text: str) -> bytes:
        if self.plain.fullmatch(text):
            found = self.pieces.findall(text.lower())
            return self.bpe(found[0]) if len(found) == 1 else b"".join([self[p.encode()] for p in found])
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()


#: Texts of these bytes alone are of Latin letters, digits, full stops and commas; pairs of signs are cut as one piece.
SIMPLE = bytes([*b"abcdefghijklmnopqrstuvwxyz0123456789., \t\n\x0b\x0c\r", 0xC3, *range(0x80, 0xC0)])
NOT_SIMPLE = (b"..", b",,", b".,", b",.", b"\xc3\x97", b"\xc3\xb7")


#: What a file must say of normalizing, splitting and merging for the shortcuts here to hold.
LOWER_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}


def is_lower_words(path: str) -> bool:
    """Whether the file at path is of the kind that WordIds cuts by itself: lower case, white space dropped, words split by that pattern."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    plain = not any(d["model"].get(k) for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    return plain and d["model"].get("type") == "BPE" and all(d.get(k) == v for k, v in LOWER_WORDS.items())


def _whole(path: str):
    """The library's own path for whole texts, for files of any kind: ids as bytes, without truncation, padding or special tokens."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    return lambda text: array("I", whole.encode(text, add_special_tokens=False).ids).tobytes() if text else b""


def encoder(path: str):
    """A function from a text (or None) to its ids as bytes, those of the tokenizers library for the file at path."""
    known = worker_cache("tokens")
    if path not in known:
        known[path] = WordIds(path) if is_lower_words(path) else _whole(path)
    word_ids = known[path]
    if not isinstance(word_ids, WordIds):
        return word_ids

    def encode(text: str | None) -> bytes:
        if not text:
            return b""
        raw = text.encode("utf-8", "surrogatepass")
        low = raw.lower()
        if not low.translate(None, SIMPLE) and not any(map(low.__contains__, NOT_SIMPLE)):
            raw = low.replace(b".", b" . ").replace(b",", b" , ")  # the same pieces, and fewer different words
        return b"".join(map(word_ids.__getitem__, raw.split()))

    return encode
