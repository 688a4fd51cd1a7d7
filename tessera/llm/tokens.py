"""Token ids of the word-end BPE vocabulary, fast enough for whole corpora.

The file's own pipeline (NFC, white space, lower case, split, merges) gives the ids of a
text as the concatenation of the ids of its white-space separated parts. A task therefore
keeps the ids of the parts it has met; parts it has not met are tokenized together.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Parts kept in a worker's memory (about 200 bytes each); the store is emptied beyond that.
KEPT_PARTS = 700_000
_PIECES = regex.compile(r"('s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+)")
#: Parts with control characters or special tokens go through the library itself.
_ODD = regex.compile("[^\\S ]|[\0-\x1f]|<\\|")
#: Python splits at these four, the file's pipeline does not: such texts go through the library whole.
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")


def _byte_symbols() -> dict[str, int]:
    """The characters by which byte-level BPE files write the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordBpe:
    """``ids(texts)``: for each text its ids as little-endian 16-bit bytes."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=False)
        symbol = _byte_symbols()
        ranks = {}
        for token, i in vocab.items():
            ends = token.endswith("</w>")
            ranks[bytes(symbol[c] for c in (token[:-4] if ends else token)) + b"\0" * ends] = i
        if max(self.library.get_vocab().values()) >= 1 << 16 or len(ranks) != len(vocab):
            raise ValueError("the vocabulary does not fit 16-bit ids")
        # a zero byte stands for the end of a word; lines of pieces are told apart by the id of a space
        self.merges = tiktoken.Encoding("word_ends", pat_str="[^\0 ]+\0| ", mergeable_ranks=ranks, special_tokens={})
        self.space = ranks[b" "]
        self.kept: dict[str, bytes] = {}

    def one(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _meet(self, parts: list[str]) -> None:
        odd = [p for p in parts if _ODD.search(p)]
        for p in odd:
            self.kept[p] = self.one(p)
        if odd:
            left = set(odd)
            parts = [p for p in parts if p not in left]
        for a in range(0, len(parts), 20_000):
            some = parts[a : a + 20_000]
            line = unicodedata.normalize("NFC", " ".join(some)).replace("\u03a3", "\u03c3").lower()
            ids = np.array(self.merges.encode_ordinary(_PIECES.sub("\\1\0", line)), "<u2")
            cuts = np.flatnonzero(ids == self.space)
            if len(cuts) != len(some) - 1:
                raise ValueError("parts and ids do not match")
            data = np.delete(ids, cuts).tobytes()
            ends = [*(2 * (cuts - np.arange(len(cuts)))).tolist(), len(data)]
            begin = 0
            for part, end in zip(some, ends, strict=True):
                self.kept[part] = data[begin:end]
                begin = end

    def ids(self, texts: list[str | None]) -> list[bytes]:
        if len(self.kept) > KEPT_PARTS:
            self.kept = {}
        split = [[] if not t or any(c in t for c in _SEPARATORS) else t.split() for t in texts]
        new = set().union(*split).difference(self.kept)
        if new:
            self._meet(list(new))
        get = self.kept.__getitem__
        return [b"".join(map(get, parts)) if parts else self.one(t or "") for t, parts in zip(texts, split, strict=True)]


_tokenizers: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """The worker's tokenizer of that file (read once a worker)."""
    if path not in _tokenizers:
        _tokenizers[path] = WordBpe(path)
    return _tokenizers[path]
