"""Token ids of whole texts: those of ``tokenizers``' ``encode(text, add_special_tokens=False)``.

``tokenizers`` spends about 0.5 s a MB on texts of many rare words, ``tiktoken`` a quarter of that with the same
vocabulary. So the ids are computed by ``tiktoken`` from the merges' ranks in the same file. Every worker compares both
libraries on a few texts when it loads a file, a test does so on many, and a text that ``tiktoken`` refuses goes to
``tokenizers``. Long texts are cut, before encoding, in front of a space between non-blanks, where the vocabulary's
pattern always splits.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np

_SAFE = re.compile(r"(?<=\S)(?= \S)")
SLICE = 1 << 19
#: The vocabulary's split pattern and byte alphabet (fixed values of byte-level BPE).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SAMPLES = ("It's 2 o'clock,\n\n  don't wait!  ", "Ça été — naïve 中文 🎉\t x\x1cy  \n z", "a b 　c<|endoftext|>d")


def _ranks(vocabulary: dict[str, int], special: set[str]) -> dict[bytes, int]:
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    byte = {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(others)}
    return {bytes(byte[c] for c in token): rank for token, rank in vocabulary.items() if token not in special}


class Encoder:
    """Encodes texts with a byte-level BPE file of ``tokenizers``. One per Python worker."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: k for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        with open(path, encoding="utf-8") as f:
            ranks = _ranks(json.load(f)["model"]["vocab"], set(added))
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        for s in SAMPLES:
            if self._slice(s).tolist() != self._exact(s).tolist():
                raise ValueError(f"{path} is not a byte-level BPE vocabulary of the known pattern")

    def _exact(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _slice(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # the pattern's engine gave up on a long run of blanks
            return self._exact(text)

    @staticmethod
    def _slices(text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > 2 * SLICE:
            m = _SAFE.search(text, at + SLICE)
            if not m:
                break
            yield text[at:m.start()]
            at = m.start()
        yield text[at:]

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text; none for null."""
        parts = [self._slice(s) for s in self._slices(text or "")]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file (kept between tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
