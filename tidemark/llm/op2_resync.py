"""Token counts of huge documents by overlapping chunks that are spliced where they agree.

A chunk starts at any character, so its first tokens may be wrong, and so may its last.
Let ``A`` be right from its splice on and ``B`` be the next chunk. A position at which a
pre-token starts in ``A``, some characters before ``A``'s end, is one in the whole text,
since pre-tokens are matched from left to right without looking back. If a pre-token of
``B`` starts there too, ``B`` is right from there on. So the first position common to both
is a proven splice. If the overlap has none, ``A`` is encoded again, further into ``B``
(twice its length each time), until one is found or ``A`` has taken ``B`` in.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import batches, common
from tidemark.llm.tokens import piece_encoder

#: Characters before a chunk's end that prove nothing: a special string or a composed
#: character that begins there may go on behind it.
MARGIN = 32


class ChunkEncoder:
    """Encodes chunks."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.alone = set(tokenizer.get_added_tokens_decoder())
        self.ends = self.alone | {i for token, i in vocabulary.items() if token.endswith("</w>")}  # ids that end a pre-token

    def __call__(self, chunks: list[str]) -> list[Chunk]:
        return [Chunk(e, self.ends, self.alone) for e in self.tokenizer.encode_batch(chunks, add_special_tokens=False)]


class Chunk:
    """A chunk's tokens, and the characters at which its pre-tokens start."""

    def __init__(self, encoding, ends: set[int], alone: set[int]):
        self.encoding, self.ids, self.ends, self.alone = encoding, encoding.ids, ends, alone

    def starts(self, lo: int, hi: int, from_end: bool = False) -> dict[int, int]:
        """character: token, of the pre-tokens that start in [lo, hi]; looked at from the chunk's end or its beginning.

        One character can become two, of two pre-tokens: then it is no place to splice at.
        """
        at, out = self.encoding.token_to_chars, {}
        for i in range(len(self.ids) - 1, -1, -1) if from_end else range(len(self.ids)):
            start = at(i)[0]
            if start < lo if from_end else start > hi:
                break
            if lo <= start <= hi and (not i or (self.ids[i - 1] in self.ends or self.ids[i] in self.alone) and start >= at(i - 1)[1]):
                out[start] = i
        return out


def count_by_chunks(encode, text: str, chunk: int, overlap: int) -> tuple[int, int, int]:
    """Tokens of ``text``, chunks used, and times an overlap was widened."""
    step = chunk - overlap
    if overlap <= MARGIN or step < overlap:
        raise ValueError("an overlap must exceed the margin and be at most half a chunk")
    spans = [(s, min(s + chunk, len(text))) for s in range(0, max(len(text) - overlap, 1), step)]
    total = widened = 0
    begin = end = lo = 0  # of the chunk at hand: its place in the text, and its first right token
    at_hand = None
    for part in batches.parts(spans, 64):  # bounds what is held of a huge text
        for (s, e), after in zip(part, encode([text[s:e] for s, e in part]), strict=True):
            if at_hand is None:
                begin, end, at_hand = s, e, after
                continue
            while True:
                proven = {begin + c: i for c, i in at_hand.starts(s - begin, end - MARGIN - begin, from_end=True).items() if i > lo}
                theirs = {s + c: i for c, i in after.starts(0, end - MARGIN - s).items()}
                both = proven.keys() & theirs.keys()
                if both:
                    splice = min(both)
                    total += proven[splice] - lo
                    begin, end, lo, at_hand = s, e, theirs[splice], after
                    break
                if end >= e:  # the chunk at hand has taken this one in
                    break
                end = min(e, end + max(overlap, end - begin))
                at_hand = encode([text[begin:end]])[0]
                widened += 1
    return total + len(at_hand.ids) - lo, len(spans), widened


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                 chunk_chars: int = 8_192, overlap_chars: int = 256) -> DataFrame:
    """(id, n_bytes, n_tokens, n_chunks, n_widened) of every row of ``docs``.

    Texts of at most ``chunk_chars`` are one chunk and are encoded as they are; longer ones
    by overlapping chunks, of which a task holds 64 at a time. No shuffle. A null text counts as
    empty (0 bytes, 0 tokens); repeated rows and null ids give a row each; other columns
    are not read.
    """
    def run(rows_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_encoder(tokenizer_path)
        encode = ChunkEncoder(pieces.tokenizer)
        for batch in rows_in:
            texts = batches.texts(batch)
            short = [i for i, t in enumerate(texts) if len(t) <= chunk_chars]
            found = {i: (len(ids) // 4, 1, 0) for i, ids in zip(short, pieces.ids([texts[i] for i in short]), strict=True)}
            for i, t in enumerate(texts):
                if i not in found:
                    found[i] = count_by_chunks(encode, t, chunk_chars, overlap_chars)
            rows = [found[i] for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64())]
                + [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
                names=[id_col, "n_bytes", "n_tokens", "n_chunks", "n_widened"])

    return common.id_and_text(docs, id_col, text_col).mapInArrow(
        run, common.output(docs, id_col, "n_bytes long, n_tokens long, n_chunks long, n_widened long"))
