"""Packing by vector bins: pieces of documents under limits on tokens, segments and loss-bearing tokens.

Texts are tokenised once, where they are read, and cut into pieces of at most
one sequence; only the pieces' numbers are shuffled.  Within a partition the
pieces are packed by the dot-product heuristic: an open bin takes, among the
pieces that fit in every dimension, the one whose size vector has the largest
dot product with the bin's remaining capacity, both relative to the limits.
Pieces of the same size vector are alike, so a step looks at the distinct
vectors only.  A partition is packed in blocks of bounded size; bins that are
left loosely filled give their pieces to the next block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TOKENS = 1024
MAX_SEGMENTS = 128
#: A piece's first token has nothing before it to predict it from; the others bear loss.
MAX_LOSS = 1023
END_ID = 0
#: Fixed value: the vocabulary's special token, whose id follows the ranks.
SPECIAL = "<|endoftext|>"
BLOCK = 65_536
#: A bin filled to less than this share waits for the next block.
FULL = 0.995

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, loss_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


def encoder(vocabulary: str | None = None):
    """Text to ids: the byte-level BPE over its rank file, with the ids of the tokenizer file of the same vocabulary.

    As with that file, its special token's text, wherever it stands, is that token's id.
    """
    import base64

    import public_tokenizers
    import tiktoken

    with open(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})

    def encode(text: str) -> list[int]:
        return encoding.encode(text, allowed_special="all") if SPECIAL in text else encoding.encode_ordinary(text)
    return encode


def pieces(docs: DataFrame, max_tokens: int = MAX_TOKENS, vocabulary: str | None = None) -> DataFrame:
    """Cut every document's ids (those of its whole text, then ``END_ID``) into pieces of at most ``max_tokens``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = None
        for batch in batches:
            encode = encode or encoder(vocabulary)
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "")
                ids.append(END_ID)
                raw, n = np.array(ids, "<u4"), len(ids)
                rows += [(doc_id, i, min(max_tokens, n - i), zlib.crc32(raw[i:i + max_tokens].tobytes()), n,
                          min(max_tokens, n - i) - 1) for i in range(0, n, max_tokens)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def fill(sizes: np.ndarray, limits: np.ndarray) -> list[list[int]]:
    """Rows of ``sizes`` (one column per dimension) into bins; each row fits an empty bin."""
    vectors, inverse = np.unique(sizes, axis=0, return_inverse=True)
    order = np.argsort(inverse, kind="stable")
    stacks = [list(x[::-1]) for x in np.split(order, np.cumsum(np.bincount(inverse, minlength=len(vectors)))[:-1])]
    left = np.array([len(s) for s in stacks])
    scaled = vectors / limits
    bins: list[list[int]] = []
    while left.any():
        room, members = limits.astype(np.int64).copy(), []
        while True:
            fits = (left > 0) & (vectors <= room).all(axis=1)
            if not fits.any():
                break
            k = int(np.argmax(np.where(fits, scaled @ (room / limits), -1.0)))
            members.append(int(stacks[k].pop()))
            left[k] -= 1
            room -= vectors[k]
        bins.append(members)
    return bins


def pack(examples: DataFrame, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
         max_loss: int = MAX_LOSS, block: int = BLOCK) -> DataFrame:
    """Place pieces (:data:`PIECES`) in sequences: adds ``sequence_id`` and ``offset``.

    Every piece gets exactly one place; pieces stay whole.  One that exceeds a
    limit alone has a sequence of its own.  Pieces are dealt evenly whatever
    their ids, so no hot document fills a task; equal rows are separate pieces.
    Rows are sorted before they are dealt and packed, so a rerun agrees.  An
    empty table gives no rows.
    """
    limits = np.array([max_tokens, max_segments, max_loss])
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "loss_tokens"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sequence = TaskContext.get().partitionId() << 33
        waiting: list[np.ndarray] = []
        held: list[list[int | None]] = []  # ids, which may be null, beside the numbers

        def settle(last: bool) -> pa.RecordBatch | None:
            nonlocal sequence, waiting, held
            if not held:
                return None
            rows = np.concatenate(waiting)
            ids = [x for part in held for x in part]
            sizes = np.column_stack([rows[:, 1], np.ones(len(rows), np.int64), rows[:, 4]])
            alone = (sizes > limits).any(axis=1)
            fitting = np.flatnonzero(~alone)
            bins = [[i] for i in np.flatnonzero(alone)]
            bins += [[int(fitting[i]) for i in b] for b in fill(sizes[fitting], limits)] if len(fitting) else []
            out, kept = [], []
            for b in bins:
                if last or len(b) == 1 and alone[b[0]] or (sizes[b].sum(axis=0) >= FULL * limits).any():
                    offset = 0
                    for i in b:
                        out.append((ids[i], *rows[i].tolist(), sequence, offset))
                        offset += int(rows[i, 1])
                    sequence += 1
                else:
                    kept += b
            waiting, held = ([rows[kept]], [[ids[i] for i in kept]]) if kept else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                              names=[*names, "sequence_id", "offset"]) if out else None

        for batch in batches:
            waiting.append(np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, 6)]).astype(np.int64))
            held.append(batch.column(0).to_pylist())
            # Loose bins may hold many pieces of their own; a block grows beyond them.
            if sum(map(len, held)) >= block + (len(held[0]) if len(held) > 1 else 0) and (out := settle(False)):
                yield out
        if out := settle(True):
            yield out

    dealt = examples.select(*names).hint("rebalance").sortWithinPartitions("length", "doc_id", "start", "ids_crc32")
    return dealt.mapInArrow(place, PACKED)


def pack_documents(docs: DataFrame, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS,
                   max_loss: int = MAX_LOSS, vocabulary: str | None = None) -> DataFrame:
    """All documents packed, a row per piece.

    A null or empty text is its end id alone; very long texts become several
    pieces; null ids and repeated rows are documents of their own; other
    columns are ignored, whatever their names.
    """
    return pack(pieces(docs.select("doc_id", "text"), max_tokens, vocabulary), max_tokens, max_segments, max_loss)
