"""Byte-level BPE ids of whole texts as the tokenizers library gives them."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np

# A task has one core: threads of the library would only wait for each other.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The pre-tokenizer of the byte-level files, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: its own where it is visible, else one from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class TextEncoder:
    """Ids of a text as little-endian 32-bit numbers.

    Where the file's ids rise in the order of its merges, merging by lowest id is merging by rank, and texts of Latin
    letters, digits, signs and plain white space go through tiktoken with the file's own vocabulary, at a fraction of the
    time. All other texts, those with long runs of white space and those that may hold a special token go through tokenizers.
    """

    _HELD: dict[str, TextEncoder] = {}
    _OTHER = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")
    #: A long run of white space, looked for from its beginning only: tiktoken's pattern overflows its stack on longer ones.
    _GAP = re.compile(r"(?<![\t\n\r ])[\t\n\r ]{4096}")

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self._ranked(path)

    @staticmethod
    def _ranked(path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, shape = file["model"], file["pre_tokenizer"]
        vocab, merges = model["vocab"], [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        plain = file["normalizer"] is None and shape == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        made = [vocab.get(a + b) for a, b in merges]
        if not plain or made != list(range(256, 256 + len(made))) or len(vocab) != 256 + len(made):
            return None
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items()}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str) -> TextEncoder:
        """The worker's encoder for this file, kept from task to task."""
        if path not in cls._HELD:
            cls._HELD[path] = cls(path)
        return cls._HELD[path]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text."""
        for text in texts:
            if self.fast is None or self._OTHER.search(text) or self._GAP.search(text) or any(s in text for s in self.special):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            else:
                ids = self.fast.encode_ordinary(text)
            yield np.array(ids, "<u4").tobytes()
