"""Tokenizers of public vocabulary files, with caches of pre-tokens that live as long as a worker."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache
from pathlib import Path

import public_tokenizers

from monthclose.llm.common import worker_state

#: Pre-tokens a worker remembers; a full cache is emptied.
CACHE_ENTRIES = 300_000
#: Longer pre-tokens are encoded each time.
CACHE_LENGTH = 48


@dataclass(frozen=True)
class Vocabulary:
    """Contents of the vocabulary files, read where the job starts and sent along with it (about 2.5 MB)."""

    tokenizer: bytes = field(repr=False)
    ranks: bytes = field(repr=False)

    @staticmethod
    def from_files(tokenizer: str | None = None, ranks: str | None = None) -> Vocabulary:
        return Vocabulary(
            Path(tokenizer or public_tokenizers.path("byte_bpe_50k.json")).read_bytes(),
            Path(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes(),
        )


class _Together(Exception):
    """The text has white space next to white space: it cannot be cut at single spaces."""


class _PieceIds(dict):
    """Ids (little-endian, 32 bits) of ' ' + word. A pre-token never goes on over a space that has other
    characters than white space on both sides, so such words are encoded one by one."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Together
        ids = self.encode(" " + word)
        if len(word) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = ids
        return ids


def byte_bpe(vocabulary: Vocabulary) -> Callable[[str], bytes]:
    """A function from text to ids as the tokenizer of ``vocabulary`` gives them, without added special tokens.

    Texts that name a special token go to the tokenizer as they are (it is loaded for the first of them); all others
    are cut into words, most of which the worker has seen before. The worker keeps it until it does something else.
    """
    return worker_state("tokens", vocabulary, _encoder)


def _encoder(vocabulary: Vocabulary) -> Callable[[str], bytes]:
    import numpy as np
    import tiktoken

    special = [t["content"] for t in json.loads(vocabulary.tokenizer)["added_tokens"]]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.ranks.splitlines())}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cache
    def whole():
        import tokenizers

        return tokenizers.Tokenizer.from_buffer(vocabulary.tokenizer)

    def plain(text: str) -> bytes:
        return np.array(fast.encode_ordinary(text), "<u4").tobytes()

    pieces = _PieceIds(plain)
    of = pieces.__getitem__

    def encode(text: str) -> bytes:
        for name in special:
            if name in text:
                return np.array(whole().encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, space, rest = text.partition(" ")
        if not space or not first or first[-1].isspace():
            return plain(text)
        try:
            return plain(first) + b"".join(map(of, rest.split(" ")))
        except _Together:
            return plain(text)

    return encode
