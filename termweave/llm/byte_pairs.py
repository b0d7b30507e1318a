"""Byte-level BPE as tokenizers files describe it: pre-tokens, and the merges of one pre-token at a time."""

from __future__ import annotations

import json
import re

#: How texts are split; Python's classes of letters, digits and white space are the library's for all characters outside ODD.
PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Characters whose class differs between the two, or that were not compared: texts around them take the library's whole path.
ODD = re.compile("[^\t-\r\x20-\xb1\xb4-\xb8\xba\xbb\xbf-৳‐-⁞぀-㆑一-鿿가-힣]")
#: Where white space follows anything else: no pre-token reaches over such a place.
BEFORE_SPACE = re.compile(r"(?<=\S)(?=\s)")
#: Longer pre-tokens are not kept.
LONGEST = 64


def byte_names() -> list[str]:
    """The character by which byte-level alphabets name each byte: printable ones by themselves, others by code points from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + rest.index(b)) for b in range(256)]


NAMES = byte_names()


def named(text: str) -> str:
    return text.encode().decode("latin-1").translate(dict(enumerate(NAMES)))


CODES = {c: i for i, c in enumerate(NAMES)}


def token_bytes(name: str) -> bytes:
    """The bytes that a vocabulary entry stands for."""
    return bytes(CODES[c] for c in name)


def is_byte_level(path: str) -> bool:
    """Whether the file at path splits and merges as this module does: no normalizer, the usual pattern, plain merges."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    pre, model = d.get("pre_tokenizer") or {}, d["model"]
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
    return d.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and model.get("type") == "BPE" and plain


def load(path: str, specials_as_text: bool = False):
    """The library's tokenizer, without truncation and padding."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    whole.encode_special_tokens = specials_as_text
    return whole


def special_strings(whole) -> list[str]:
    return [t.content for t in whole.get_added_tokens_decoder().values()]


def whole_tokens(path: str) -> list[str]:
    """Strings of the vocabulary that are one pre-token and, merged alone, one token: proved by merging each, once, outside all tasks."""
    whole, out = load(path), []
    for name, at in whole.get_vocab(with_added_tokens=False).items():
        try:
            text = token_bytes(name).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if not ODD.search(text) and PRETOKEN.findall(text) == [text] and [t.id for t in whole.model.tokenize(name)] == [at]:
            out.append(text)
    return sorted(out)


class PieceIds(dict):
    """Pre-tokens to the ids of their tokens, by the library's merges; at most so many are kept."""

    def __init__(self, whole, most: int = 200_000):
        super().__init__()
        self.tokenize, self.most, self.names = whole.model.tokenize, most, dict(enumerate(NAMES))

    def merged(self, piece: str) -> list[int]:
        return [t.id for t in self.tokenize(piece.encode().decode("latin-1").translate(self.names))]

    def __missing__(self, piece: str) -> list[int]:
        ids = self.merged(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[piece] = ids
        return ids


def ranked_encoder(path: str):
    """The same merges by tiktoken, which takes a vocabulary as ranks: equal where ids follow the order of merges; None where they do not.

    For texts without characters in ODD: tiktoken splits by the same pattern with its own character classes.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, merges = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = [vocab[a + b] for a, b in merges]
    if ids != sorted(set(ids)) or len(vocab) != 256 + len(ids) or min(ids, default=256) != 256:
        return None
    return tiktoken.Encoding("own", pat_str=r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""", mergeable_ranks={token_bytes(k): i for k, i in vocab.items()}, special_tokens={}).encode_ordinary
