"""Token ids of texts by a public tokenizer that lower-cases and whose pre-tokenizer drops white space.

In such a tokenizer no token, special string or normalisation step reaches across ASCII
white space, so a text's ids are those of its white-space-separated pieces in order. Its
pre-tokens are runs of letters, single digits and runs of other characters; so full stops and
commas between a letter or digit and white space are a pre-token, and pieces of their own.
"""

from __future__ import annotations

import os
import re

import numpy as np

from tidemark.llm import batches

#: Pieces remembered by one Python worker, the first ones it meets (the frequent ones are among them).
CACHE_PIECES = 1_100_000


_STOPS = re.compile(rb"(?<=[a-z0-9])([.,]+)(?=[ \n])")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


class PieceEncoder:
    """Ids of many texts, encoding each distinct piece once while it is remembered."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES):
        self.tokenizer = load(path)
        self.cache: dict[bytes, bytes] = {}
        self.cache_pieces = cache_pieces
        self.special = [t.content.encode("utf-8").lower() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def pieces(self, text: str) -> list[bytes]:
        """The text's pieces, brought to fewer forms unless it may hold a special string."""
        data = text.encode("utf-8")
        lower = data.lower()  # bytes: A-Z only
        if not any(s in lower for s in self.special):
            data = _STOPS.sub(rb" \1", lower)
        return data.split()  # bytes: the six ASCII white spaces

    def ids(self, batch: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        pieces = [self.pieces(text) for text in batch]
        cache = self.cache
        missing = set().union(*pieces).difference(cache)
        new = {}
        for part in batches.parts(list(missing), 20_000):
            encoded = self.tokenizer.encode_batch_fast([p.decode("utf-8") for p in part], add_special_tokens=False)
            new.update((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(part, encoded, strict=True))
        if len(cache) + len(new) <= self.cache_pieces:
            cache.update(new)
            return [b"".join(map(cache.__getitem__, p)) for p in pieces]
        return [b"".join([new.get(x) or cache.get(x, b"") for x in p]) for p in pieces]


def piece_encoder(path: str) -> PieceEncoder:
    """The worker's encoder, with what it remembers from earlier tasks."""
    return batches.kept_by_worker(("pieces", path), lambda: PieceEncoder(path))
