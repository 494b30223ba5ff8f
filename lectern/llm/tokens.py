"""Token ids of a public byte-level BPE vocabulary.

The pieces of this vocabulary's split pattern never run over a space that stands between
two other characters, so a text's ids are those of its space-led words put together.
Words repeat, and each task keeps the ids of the words it met (a bounded table that is
emptied when full). Texts with runs of spaces are encoded whole; those that hold the
special token's string go to the ``tokenizers`` library, which knows it. Either way the
ids are those of ``tokenizers`` with ``add_special_tokens=False``.
"""

from __future__ import annotations

from base64 import b64decode

import numpy as np

VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
#: Words whose ids a task keeps, and the longest of them.
KEPT_WORDS = 300_000
KEPT_CHARS = 48


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers. One per task."""

    def __init__(self, vocabulary: str = VOCABULARY, kept_words: int = KEPT_WORDS):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        coder = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._json, self._whole = public_tokenizers.path(f"{vocabulary}.json"), None

        def plain(text: str) -> bytes:
            return np.array(coder.encode_ordinary(text), dtype="<u4").tobytes()

        class Words(dict):
            def __missing__(self, word):
                found = plain(" " + word)
                if len(word) <= KEPT_CHARS:
                    if len(self) >= kept_words:
                        self.clear()
                    self[word] = found
                return found

        self._plain, self._word = plain, Words().__getitem__

    def _special(self, text: str) -> bytes:
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self._json)
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if SPECIAL in text:
            return self._special(text)
        words = text.split(" ")
        if "" in words[1:]:
            return self._plain(text)
        return self._plain(words[0]) + b"".join(map(self._word, words[1:]))
