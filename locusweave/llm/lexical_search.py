"""Ranked lexical search by pipelined term partitioning.

Documents are inverted in blocks: a block's posting lists name its documents by
their place in it. The terms of the items are dealt to owners, rare terms first.
A bundle holds some items and, per block, their sparse document accumulators; it
travels from owner to owner, meets there the posting lists of the owner's terms
by cogroup, and adds their integer contributions. A document leaves its accumulator as soon
as all contributions still to come cannot lift it to the block's best k,
and one that only later owners know is not taken up if they alone cannot do so;
both tests are strict, so no result is lost. The best k of each
block meet in the final selection.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusweave.llm.common import ascii_lower, stored
from locusweave.session import fits_broadcast

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 10
SHARES = (1 / 16, 1 / 4)  # the first owner has the rarest terms with about this share of all postings, the next up to that, the last the rest
BUNDLE = 64  # items in a bundle, about
BLOCK = 4096  # documents in a block, at most
VOCABULARY_BYTES = 1 << 26  # terms of the items are handed to the tasks up to this size, and joined beyond it

_FIND = re.compile(TERM)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_INDEX = "block long, term string, docs array<long>, counts array<long>, lengths array<long>"
_CARRIED = "bundle long, block long, item long, docs array<long>, scores array<long>, best array<long>"


def _inverted(block: int, rows: list[tuple[int | None, str]], known: frozenset[str] | None) -> pa.RecordBatch:
    """Posting lists of one block: places of documents, occurrences, and the documents' numbers of terms.

    Places follow the ids, nulls last, so that equal scores of a block rank by place. The list without a
    term names the documents of all places.
    """
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    lists: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
    lengths = []
    for place, (_, text) in enumerate(rows):
        terms = _FIND.findall(text.translate(_LOWER))
        lengths.append(len(terms))
        for term, count in Counter(terms if known is None else filter(known.__contains__, terms)).items():
            docs, counts = lists[term]
            docs.append(place)
            counts.append(count)
    n = np.array(lengths, dtype=np.int64)
    columns = [[[i for i, _ in rows], *(d for d, _ in lists.values())], [[], *(c for _, c in lists.values())], [n, *(n[d] for d, _ in lists.values())]]
    kind = pa.list_(pa.int64())
    return pa.record_batch([pa.array([block] * (len(lists) + 1), pa.int64()), pa.array([None, *lists], pa.string()), *(pa.array(c, kind) for c in columns)],
                           ["block", "term", "docs", "counts", "lengths"])


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """Stored posting lists ``block, term, docs, counts, lengths`` of whole texts, of the terms in ``vocabulary`` (column ``term``) if given.

    A block never spans tasks and is inverted where its texts are read, so nothing is shuffled.
    """
    spark, known = docs.sparkSession, None
    if vocabulary is not None and fits_broadcast(vocabulary, VOCABULARY_BYTES):
        known = spark.sparkContext.broadcast(frozenset(r.term for r in vocabulary.collect()))

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = list(zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()))
            for start in range(0, len(rows), block):
                yield _inverted(number, [(i, t or "") for i, t in rows[start:start + block]], known.value if known else None)
                number += 1

    lists = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(invert, _INDEX)
    if vocabulary is not None and known is None:
        names = lists.where("term IS NULL").select("term").limit(1)  # the lists that name documents stay
        wanted = vocabulary.select("term").unionByName(names).select(F.col("term").alias("wanted"))
        lists = lists.join(wanted, F.col("term").eqNullSafe(F.col("wanted")), "left_semi")
    return stored(lists)


def item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, term``: the distinct terms of each distinct row of ``items``; ``item`` is a hash of id and text."""
    found = F.array_distinct(F.regexp_extract_all(ascii_lower("text"), F.lit(TERM), F.lit(0)))
    return items.select("item_id", "text").distinct().select(F.xxhash64("item_id", "text").alias("item"), "item_id", F.explode(found).alias("term"))


def _dealt(terms: DataFrame, index: DataFrame, documents: int) -> DataFrame:
    """Adds to ``item, term`` the term's weight, its largest possible contribution, its owner, and the item's bundle; terms without weight go."""
    lists = index.where("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("docs")).alias("df"), F.max(F.array_max("counts")).alias("most"))
    weight = F.floor(1000 * F.log((2.0 * documents + 2) / (2 * F.col("df") + 1)))
    top = F.expr("weight * ((1000000000L * most) div (1000 * most + 80))")
    terms = stored(terms.join(lists, "term").withColumn("weight", weight).withColumn("top", top).where("weight > 0"))
    # At most 64 rows, whatever the number of terms.
    sizes = terms.groupBy(F.floor(F.log2("df")).alias("size")).agg(F.sum("df").alias("postings")).orderBy("size").collect()
    total, before, owner = sum(r.postings for r in sizes) or 1, 0, F.lit(0)
    for row in sizes:
        owner = F.when(F.floor(F.log2("df")) == row["size"], F.lit(sum(before >= share * total for share in SHARES))).otherwise(owner)
        before += row.postings
    bundles = max(1, -(-terms.select("item").distinct().count() // BUNDLE))
    return terms.select("item", "term", "weight", "top", owner.alias("owner"), F.pmod("item", F.lit(bundles)).alias("bundle"))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df) else df


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k largest scores, or all of fewer, in no order."""
    return scores if len(scores) <= k else np.partition(scores, len(scores) - k)[-k:]


def _owner_stage(documents: int, terms: int, block: int, k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """What one owner does with a bundle at a block: ``bounds`` are what later owners can add and what the best k need."""

    def visit(carried: pd.DataFrame, lists: pd.DataFrame) -> pd.DataFrame:
        sums: dict[int, np.ndarray] = {}
        bounds: dict[int, tuple[int, int]] = {}
        taken: dict[int, np.ndarray | None] = {}
        for item, docs, scores, later, needed in zip(carried["item"], carried["docs"], carried["scores"], carried["later"], carried["needed"]):
            sums[item] = np.zeros(block, dtype=np.int64)
            sums[item][docs] = scores
            bounds[item] = (later, needed)
        for items, opens, later, needed, weight, docs, counts, lengths in zip(*(lists[c] for c in ("items", "opens", "later", "needed", "weight", "docs", "counts", "lengths"))):
            m = 10 + (90 * lengths * documents) // terms
            gain = weight * ((1_000_000_000 * counts) // (1000 * counts + 8 * m))
            for item, is_open, rest, least in zip(items, opens, later, needed):
                bounds[item] = (rest, least)
                if item not in taken:  # a closed item takes contributions for the documents it came with only
                    taken[item] = None if is_open else sums[item] > 0 if item in sums else np.zeros(block, dtype=bool)
                if taken[item] is None:
                    sums.setdefault(item, np.zeros(block, dtype=np.int64))[docs] += gain
                elif item in sums:
                    own = taken[item][docs]
                    sums[item][docs[own]] += gain[own]
        keys = carried if len(carried) else lists
        out = []
        for item, total in sums.items():
            later, needed = bounds[item]
            docs = np.flatnonzero(total)
            best = _best(total[docs], k)
            if len(best) == k:
                needed = max(needed, int(best.min()))
            docs = docs[total[docs] + later >= needed]
            if len(docs):
                out.append((keys["bundle"].iloc[0], keys["block"].iloc[0], item, docs, total[docs], best))
        return pd.DataFrame(out, columns=["bundle", "block", "item", "docs", "scores", "best"])

    return visit


def _needed(carried: DataFrame, k: int) -> DataFrame:
    """``item, needed``: the k-th best score over all blocks so far; no row for an item with fewer documents."""
    order = Window.partitionBy("item").orderBy(F.desc("score"))
    ranked = carried.select("item", F.explode("best").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.groupBy("item").agg(F.min("score").alias("needed"), F.count(F.lit(1)).alias("found")).where(F.col("found") == k).drop("found")


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with a score above 0, equal scores by id, nulls last.

    Scores are those of the contract. Every row of ``docs`` is a document, so a
    repeated row takes several ranks; a null or empty text has no terms and is not
    counted among the documents. Rows of ``items`` equal in id and text are one
    item; an item without terms, or whose terms no document holds, has no row, and
    an empty table on either side gives none. Other columns are left out, whatever
    their names.
    """
    pairs = stored(item_terms(items))
    index = build_index(docs, pairs.select("term").distinct(), block)
    lengths = F.col("lengths")
    sums = index.where("term IS NULL").agg(
        F.sum(F.size(F.filter(lengths, lambda n: n > 0))).alias("documents"),
        F.sum(F.aggregate(lengths, F.lit(0).cast("long"), lambda a, n: a + n)).alias("terms")).first()
    documents, terms = sums.documents or 0, max(sums.terms or 0, 1)
    dealt = stored(_dealt(pairs.select("item", "term"), index, documents))

    def above(least: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("owner") >= least, F.col("top"))), F.lit(0))

    carried = None
    for owner in range(len(SHARES) + 1):
        bounds = dealt.groupBy("item").agg(above(owner).alias("own_and_later"), above(owner + 1).alias("later"))
        if carried is not None:
            bounds = bounds.join(_needed(carried, k), "item", "left")
        else:
            bounds = bounds.withColumn("needed", F.lit(None).cast("long"))
        bounds = stored(bounds.withColumn("needed", F.coalesce("needed", F.lit(0).cast("long"))))
        visits = dealt.where(F.col("owner") == owner).join(_small(bounds), "item").groupBy("bundle", "term", "weight").agg(
            F.collect_list(F.struct("item", (F.col("own_and_later") >= F.col("needed")).alias("open"), "later", "needed")).alias("asking"))
        lists = index.where("term IS NOT NULL").join(_small(stored(visits)), "term").select(
            "bundle", "block", "weight", *[F.col(f"asking.{c}").alias(n) for c, n in (("item", "items"), ("open", "opens"), ("later", "later"), ("needed", "needed"))],
            "docs", "counts", "lengths")
        brought = index.sparkSession.createDataFrame([], _CARRIED) if carried is None else carried
        brought = brought.join(_small(bounds.select("item", "later", "needed")), "item").select("bundle", "block", "item", "docs", "scores", "later", "needed")
        met = brought.groupBy("bundle", "block").cogroup(lists.groupBy("bundle", "block"))
        carried = stored(met.applyInPandas(_owner_stage(documents, terms, block, k), _CARRIED))

    found = carried.select("block", "item", F.inline(F.arrays_zip("docs", "scores"))).withColumnsRenamed({"docs": "place", "scores": "score"})
    names = index.where("term IS NULL").select("block", F.col("docs").alias("ids"))
    found = found.join(names, "block").select("item", F.element_at("ids", F.col("place").cast("int") + 1).alias("doc_id"), "score")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(_small(pairs.select("item", "item_id").distinct()), "item").select("item_id", "rank", "doc_id", "score")
