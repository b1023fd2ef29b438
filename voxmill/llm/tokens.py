"""Byte-level BPE and byte-fallback pieces inside tasks: ids as numpy arrays, and the bytes that each id covers."""

from __future__ import annotations

import base64
import json
from functools import cache

import numpy as np

#: The default vocabulary, by the name of its public files.
VOCABULARY = "byte_bpe_50k"


#: The default vocabulary of pieces.
PIECES = "piece_bpe_32k"


class Encoder:
    """Ids of whole texts, equal to those that the tokenizers library gives for the same vocabulary without
    special tokens of its own. Their strings in a text are still read as those tokens, unless ``plain``.

    The rank file is used because its encoder takes a fifth of the time; a test holds both equal. Its pattern
    gives up on runs of a million blanks; such a text goes through the library itself.
    """

    def __init__(self, vocabulary: str, plain: bool = False):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(public_tokenizers.path(f"{vocabulary}.json")) as f:
            added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self._encoding = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={} if plain else added)
        self._vocabulary, self._plain, self._library = vocabulary, plain, None
        self.size = max(*ranks.values(), *added.values()) + 1
        self.bytes_of = [b""] * self.size
        for raw, i in [*((k.encode(), i) for k, i in added.items()), *ranks.items()]:
            self.bytes_of[i] = raw
        self.n_bytes = np.array([len(x) for x in self.bytes_of], np.int64)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        try:
            return self._encoding.encode_to_numpy(text, allowed_special=set() if self._plain else "all", disallowed_special=())
        except ValueError:
            return np.array(self._by_library(text), np.uint32)

    def _by_library(self, text: str) -> list[int]:
        if self._library is None:
            import public_tokenizers
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(public_tokenizers.path(f"{self._vocabulary}.json"))
            self._library.encode_special_tokens = self._plain
        return self._library.encode(text, add_special_tokens=False).ids


class PieceEncoder:
    """Ids of whole texts by a sentencepiece model, and each piece's bytes: the blank sign is a space, a byte piece its byte."""

    def __init__(self, model: str):
        import public_tokenizers
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{model}.model"))
        self.size = self._model.get_piece_size()
        pieces = [self._model.id_to_piece(i) for i in range(self.size)]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        self.n_bytes = np.array([len(x) for x in self.bytes_of], np.int64)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._model.encode(text), np.uint32)


@cache
def encoder(vocabulary: str = VOCABULARY, plain: bool = False) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(vocabulary, plain)


@cache
def piece_encoder(model: str = PIECES) -> PieceEncoder:
    """One encoder per Python worker."""
    return PieceEncoder(model)
