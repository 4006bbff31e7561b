"""Spelling variants: words one edit apart, found by dense comparison of prefix and suffix lengths.

Two words of ``a`` and ``b`` code points, ``a <= b <= a + 1``, are one edit apart
exactly if their common prefix and suffix together reach ``b - 1``. Such a pair
shares two of three parts of the word, so words are laid out in cells that fix
a prefix and a suffix of together two thirds of ``a``. A cell is cut into blocks,
and a tile compares two blocks as padded code-point matrices; a large cell thus
becomes many tiles of bounded size and never one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.llm.common import ascii_lower, stored

RUN = r"[A-Za-zÀ-ÿ]+"
DAMAGE = 199  # one run in so many loses a code point, chosen by a hash
LEAST_LENGTH, LEAST_COUNT = 6, 5
RATIO = 5  # how many times as frequent a form is as the word it stands for
BLOCK = 512  # words in a block, about; a tile holds two blocks
PARTS = 3
PAIR_BYTES = 1 << 23  # code points compared at a time in a task

_PAIRS = "word string, n long, other string, other_n long"


def corpus_words(docs: DataFrame) -> DataFrame:
    """``word, n``: how often each word of at least ``LEAST_LENGTH`` code points stands in all texts, if at least ``LEAST_COUNT`` times."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(ascii_lower("text"), F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.length("run") >= LEAST_LENGTH)
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    damaged = F.concat(F.substring("run", 1, at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(h % DAMAGE == 0, damaged).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= LEAST_COUNT)


def _cells(words: DataFrame) -> DataFrame:
    """One row per word and cell: ``shorter`` is the length of the shorter word of the cell's pairs, ``part`` the cell's part of three.

    A word stands in the cells of pairs in which it is the shorter or equally
    long one, and of those in which it is the longer one.
    """
    def cell(shorter: Column, part: int) -> Column:
        step = F.ceil(shorter / PARTS).cast("int")
        before, after = step * part, F.greatest(shorter - step * (part + 1), F.lit(0))
        key = F.xxhash64(shorter, F.lit(part), F.substring("word", 1, before), F.when(after > 0, F.right(F.col("word"), after)).otherwise(F.lit("")))
        return F.struct(key.alias("cell"), shorter.alias("shorter"), F.lit(part).alias("part"))

    length = F.length("word")
    return words.select("word", "n", F.inline(F.array(*[cell(s, p) for s in (length, length - 1) for p in range(PARTS)])))


def _tiles(cells: DataFrame, block: int) -> DataFrame:
    """Rows of every tile; ``block`` says which of the tile's two blocks a word belongs to.

    Cells with one word are left out. A word of a cell with k blocks goes to k tiles.
    """
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    blocks = F.ceil(F.col("size") / block).cast("int")
    filed = cells.join(sizes, "cell").withColumn("blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int"))
    return filed.select(
        "word", "n", "cell", "shorter", "part", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("partner"),
    ).select("word", "n", "cell", "shorter", "part", "block",
             F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"))


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded with 0 to ``width``, aligned to their beginnings and to their ends.

    Words hold code points below 256, so one byte each.
    """
    raw = [w.encode("latin-1") for w in words]
    left = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in raw), dtype=np.uint8).reshape(len(raw), width)
    right = np.frombuffer(b"".join(w.rjust(width, b"\0") for w in raw), dtype=np.uint8).reshape(len(raw), width)
    return left, right


def common_lengths(left: np.ndarray, right: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common prefix and common suffix of the words ``i`` and ``j``, neither longer than the shorter word."""
    least = np.minimum(lengths[i], lengths[j])
    width = left.shape[1]
    ends = np.ones((len(i), 1), dtype=bool)
    prefix = np.argmax(np.hstack([left[i] != left[j], ends]), axis=1)
    suffix = np.argmax(np.hstack([right[i, ::-1] != right[j, ::-1], ends]), axis=1)
    return np.minimum(np.minimum(prefix, width), least), np.minimum(np.minimum(suffix, width), least)


def _pairs_of_tiles(tile: np.ndarray, block: np.ndarray, diagonal: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs that lie in one tile and, off the diagonal, in different blocks; at most about ``most`` at a time.

    ``tile`` numbers the tiles of the rows in ascending order.
    """
    ends = np.searchsorted(tile, tile, side="right")
    after = ends - np.arange(len(tile)) - 1
    start = 0
    while start < len(tile):
        upto = np.searchsorted(np.cumsum(after[start:]), most, side="right") + start
        upto = max(upto, start + 1)
        count = after[start:upto]
        i = np.repeat(np.arange(start, upto), count)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        kept = diagonal[i] | (block[i] != block[j])
        yield i[kept], j[kept]
        start = upto


def _compared(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs one edit apart of whole tiles, each pair in one cell only: the one its common prefix belongs to."""
    shorter_all = rows["shorter"].to_numpy()
    for shorter in np.unique(shorter_all):
        part_rows = rows.filter(pa.array(shorter_all == shorter))
        words, n = part_rows["word"].to_pylist(), part_rows["n"].to_numpy()
        lengths = np.array([len(w) for w in words])
        columns = [part_rows[c].to_numpy() for c in ("cell", "low", "high")]
        changed = np.any([c[1:] != c[:-1] for c in columns], axis=0) if len(words) > 1 else np.zeros(0, dtype=bool)
        tile = np.concatenate([[0], np.cumsum(changed)])
        part, block = part_rows["part"].to_numpy(), part_rows["block"].to_numpy()
        step, width = -(-int(shorter) // PARTS), int(shorter) + 1
        left, right = matrices(words, width)
        for i, j in _pairs_of_tiles(tile, block, columns[1] == columns[2], max(1, PAIR_BYTES // width)):
            kept = np.minimum(lengths[i], lengths[j]) == shorter
            i, j = i[kept], j[kept]
            prefix, suffix = common_lengths(left, right, lengths, i, j)
            near = (prefix + suffix >= np.maximum(lengths[i], lengths[j]) - 1) & (np.minimum(prefix // step, PARTS - 1) == part[i])
            i, j = i[near], j[near]
            if len(i):
                word = pa.array(words)
                one, two = np.concatenate([i, j]), np.concatenate([j, i])
                yield pa.record_batch([word.take(pa.array(one)), pa.array(n[one]), word.take(pa.array(two)), pa.array(n[two])], ["word", "n", "other", "other_n"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs over rows sorted by tile; the last tile of a batch waits for the next batch."""
    waiting: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if waiting is None else pa.concat_tables([waiting, rows])
        if not rows.num_rows:
            continue
        keys = [rows[c].to_numpy() for c in ("shorter", "cell", "low", "high")]
        last = np.all([k == k[-1] for k in keys], axis=0)
        whole = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        waiting = rows.slice(whole)
        yield from _compared(rows.slice(0, whole).combine_chunks()) if whole else ()
    if waiting is not None:
        yield from _compared(waiting.combine_chunks())


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n, other, other_n``: every two words that differ by one inserted, deleted or replaced code point, in both directions."""
    tiles = _tiles(_cells(words), block)
    dealt = tiles.repartition("cell", "low", "high").sortWithinPartitions("shorter", "cell", "low", "high")
    return dealt.mapInArrow(_compare, _PAIRS)


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: follows forms to the last by doubling the steps until none is left.

    A form is several times as frequent as its word, so there are no circles.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = stored(roots.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def spelling_forms(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per word of the texts of ``docs``: ``word, form, root, n, n_near, form_n``.

    Words are the runs of ASCII and Latin-1 letters, A-Z lower-cased, some of them
    damaged as the contract says, of at least six code points and with at
    least five occurrences ``n``. ``form`` is the most frequent word one edit away
    (ties: the first in code-point order) if it is at least five times as
    frequent, ``root`` what following forms leads to. A null text has no words,
    a null ``doc_id`` counts as an empty one; repeated rows count each time,
    words of any length are compared whole, an empty table has no words. Other
    columns are left out, whatever their names.
    """
    words = stored(corpus_words(docs))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_words(words, block).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    fits = -F.col("best.less") >= RATIO * F.col("n")
    near = stored(near.select("word", "n_near", F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")))
    roots = _roots(near.where(F.col("form").isNotNull()).select("word", "form"))
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
