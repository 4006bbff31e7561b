"""Packing along a space-filling curve: similar documents share sequences, and nothing is padded.

Documents become hashed vectors of their byte 4-grams, are projected to four
dimensions and sorted by the Hilbert key of that point. Every range of the
curve is one partition, which is cut into sequences where it lies, so texts are
shuffled once and encoded once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.llm.tokens import VOCABULARY, encode_all

BUCKETS, DIMENSIONS, BITS, SEED = 256, 4, 15, 17
_RANGE_BITS = 33  # sequences of one partition are numbered below 2 to this power

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
          "hilbert_key long")


def hashed_vectors(texts: list[str]) -> np.ndarray:
    """One row of ``BUCKETS`` counts of hashed byte 4-grams per text, scaled to length 1; texts under 4 bytes give 0."""
    out = np.zeros((len(texts), BUCKETS))
    for i, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        if len(raw) > 3:
            wide = raw.astype(np.uint32)
            grams = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
            out[i] = np.bincount(grams * np.uint32(2654435761) >> np.uint32(24), minlength=BUCKETS)
    norm = np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out / np.where(norm == 0, 1, norm)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of each row of whole coordinates below ``2 ** bits``.

    Per level from the top, the cell's corner is looked up in the frame of the
    cell above, and the frame is reflected and turned for the cell below.
    """
    axes = points.astype(np.int64).T.copy()
    dims = len(axes)
    top = 1 << (bits - 1)
    level = top
    while level > 1:
        low = level - 1
        for d in range(dims):
            upper = (axes[d] & level) != 0
            turned = np.where(upper, 0, (axes[0] ^ axes[d]) & low)
            axes[0] ^= np.where(upper, low, turned)
            axes[d] ^= turned
        level >>= 1
    for d in range(1, dims):
        axes[d] ^= axes[d - 1]
    flip = np.zeros_like(axes[0])
    level = top
    while level > 1:
        flip ^= np.where((axes[-1] & level) != 0, level - 1, 0)
        level >>= 1
    axes ^= flip
    key = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (axes[d] >> bit & 1)
    return key


def curve_keys(texts: list[str]) -> np.ndarray:
    """Hilbert key of each text's projected vector."""
    directions = np.random.default_rng(SEED).choice([-1.0, 1.0], size=(BUCKETS, DIMENSIONS)) / 16
    place = np.clip((hashed_vectors(texts) @ directions + 1) / 2, 0, 1)
    return hilbert_keys(np.minimum((place * 2**BITS).astype(np.int64), 2**BITS - 1))


def curve_key(text: Column) -> Column:
    @F.pandas_udf("long")
    def key(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(curve_keys(batch.fillna("").tolist()), index=batch.index)

    return key(text)


def tail_lengths(n: int) -> list[int]:
    """Splits a rest of fewer ids than a sequence into powers of two, which need no padding."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Cuts a stream of encoded documents into sequences; holds less than one sequence at a time."""

    def __init__(self, size: int, first_sequence: int):
        self.size, self.sequence = size, first_sequence
        self.rest: list[tuple] = []  # (document, start, ids) not in a full sequence yet
        self.held = 0

    def add(self, document: tuple, ids: np.ndarray) -> list[tuple]:
        """Pieces of the sequences that ``ids`` complete; ``document`` is (doc_id, key)."""
        out: list[tuple] = []
        at = 0
        while at < len(ids):
            part = ids[at:at + self.size - self.held]
            self.rest.append((document, at, len(ids), part))
            self.held += len(part)
            at += len(part)
            if self.held == self.size:
                out += self._cut([self.size])
        return out

    def finish(self) -> list[tuple]:
        return self._cut(tail_lengths(self.held))

    def _cut(self, lengths: list[int]) -> list[tuple]:
        out, queue = [], self.rest[::-1]
        for room in lengths:
            offset = 0
            while offset < room:
                (doc_id, key), start, total, ids = queue.pop()
                now, later = ids[:room - offset], ids[room - offset:]
                if len(later):
                    queue.append(((doc_id, key), start + len(now), total, later))
                out.append((doc_id, start, len(now), now.tobytes(), total, self.sequence, offset, key))
                offset += len(now)
            self.sequence += 1
        self.rest, self.held = [], 0
        return out


def pack_documents(docs: DataFrame, size: int = 1024, vocabulary: str = VOCABULARY) -> DataFrame:
    """Pieces of all documents, ``PIECES`` as columns; ``ids`` are little-endian unsigned 32-bit numbers.

    A document is its ids and a closing 0, so a null or empty text is that 0
    alone. Long documents run over several sequences. Sequences hold ``size``
    ids; the rest of each range of the curve is cut into powers of two, so no
    position is padded. Equal keys are ordered by id and text, and rows that are
    equal altogether by their place in ``docs``, a stored table, so that any
    number of copies spreads over ranges. Only ``doc_id`` and ``text`` are read, so
    other columns may have any name. No rows give no pieces.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(size, TaskContext.get().partitionId() << _RANGE_BITS)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                            ("hilbert_key", pa.int64())])

        def batch(pieces: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*pieces), schema)], schema=schema)

        for rows in batches:
            for at in range(0, rows.num_rows, 500):
                part = rows.slice(at, 500).to_pydict()
                pieces: list[tuple] = []
                for doc_id, key, ids in zip(part["doc_id"], part["hilbert_key"], encode_all(part["text"], 0, vocabulary)):
                    pieces += packer.add((doc_id, key), ids)
                if pieces:
                    yield batch(pieces)
        if packer.held:
            yield batch(packer.finish())

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                        F.monotonically_increasing_id().alias("place"))
    keyed = keyed.withColumn("hilbert_key", curve_key(F.col("text")))
    order = ["hilbert_key", "doc_id", F.xxhash64("text"), "place"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, PIECES)
