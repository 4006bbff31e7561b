"""Near-duplicate classes by Order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with its
occurrence. A sketch keeps, per hash function, the few smallest shingles in text
order, so texts share one only where they agree in content and order. Texts that
share a sketch form a bucket. A text whose own shingles, found in no other
candidate, are too many to be similar to anything leaves. Buckets are resolved around leaders: every member
is compared with the bucket's leader only, and pairs that this leaves open must
share shingles that the leader lacks, which makes the next, smaller buckets.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusweave.llm.common import stored

SHINGLE, SIMILARITY = 5, 0.8
TABLES, KEPT = 32, 5  # a pair at the threshold is missed with probability (1 - 0.8**5)**32 = 3e-6
# Few shingles agree in five of their smallest less often than that, so texts of up to SHORT also get
# tables of two; the lengths of a pair differ by a fifth, hence one of 64 or fewer has them on both sides.
SHORT, SHORT_KEPT = 80, 2
CELLS = 1 << 20  # whether several candidates have a shingle is known by its cell, roughly
PART = 1 << 16  # shingles of a leader's open members that one task counts at a time

_WORD = re.compile(r"[^\W_]+")
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers: two rounds of shift and multiply, one to one."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


class _WordHashes(dict):
    """Hash per word, kept for the words of this worker up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


def shingles(text: str | None) -> np.ndarray:
    """Occurrence-labelled hashes of the text's shingles in text order; one for a text of fewer words, none without words."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter((_hashes[w] for w in words), dtype=np.uint64, count=len(words))
    width = min(SHINGLE, len(words))
    count = len(words) - width + 1
    out = np.zeros(count, dtype=np.uint64)
    for j in range(width):
        out = out * _MULTIPLY + h[j:j + count]
    out = _mix(out + np.uint64(width))
    order = np.argsort(out, kind="stable")
    run = out[order]
    first = np.concatenate([[True], run[1:] != run[:-1]])
    if not first.all():
        start = np.maximum.accumulate(np.where(first, np.arange(count), 0))
        label = np.empty(count, dtype=np.uint64)
        label[order] = (np.arange(count) - start).astype(np.uint64)
        out = np.where(label > 0, _mix(out + label * _MULTIPLY), out)
    return out


_SALTS = _mix(np.arange(1, TABLES + 1, dtype=np.uint64) * _MULTIPLY) | np.uint64(1)


def sketch(shingled: np.ndarray) -> np.ndarray:
    """Bucket numbers of a sequence, one per table, and as many again for a short one; none for an empty one."""
    if len(shingled) == 0:
        return np.empty(0, dtype=np.int64)
    keys = _tables(shingled, KEPT)
    return keys if len(shingled) > SHORT else np.concatenate([keys, _tables(shingled, SHORT_KEPT)])


def _tables(shingled: np.ndarray, most: int) -> np.ndarray:
    """Per table, the hash of the ``most`` smallest shingles in text order."""
    n = len(shingled)
    kept = min(most, n)
    keys = np.empty(TABLES, dtype=np.uint64)
    for at in range(0, TABLES, step := max(1, min(TABLES, 2_000_000 // n))):
        ranks = ((shingled[None, :] * _SALTS[at:at + step, None]) >> np.uint64(32)).astype(np.uint32)
        chosen = np.sort(np.argpartition(ranks, kept - 1, axis=1)[:, :kept], axis=1) if kept < n else np.tile(np.arange(n), (len(ranks), 1))
        key = _SALTS[at:at + step] + np.uint64(most)
        for j in range(kept):
            key = _mix(key * _MULTIPLY + shingled[chosen[:, j]])
        keys[at:at + step] = key
    return keys.view(np.int64)


def alignment(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> tuple[int, int]:
    """Shared shingles of two sequences, and the longest common subsequence as far as the band allows.

    At a similarity of ``least`` at most a ninth of both lengths (for 0.8) is
    inserted or deleted, so matches farther from the diagonal than that belong to
    no such alignment. Labels make every shingle occur once, hence the common
    subsequence is the longest increasing run of matched places.
    """
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = len(in_a)
    if shared < least * (len(a) + len(b) - shared):
        return shared, 0
    band = (1 - least) / (1 + least) * (len(a) + len(b))
    order = np.argsort(in_a)
    places = in_b[order][np.abs(in_a[order] - in_b[order]) <= band]
    if len(places) and (np.diff(places) > 0).all():
        return shared, len(places)
    tails: list[int] = []
    for p in places.tolist():
        at = bisect_left(tails, p)
        if at == len(tails):
            tails.append(p)
        else:
            tails[at] = p
    return shared, len(tails)


def compare(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> tuple[bool, int]:
    """Whether the aligned share of all shingles reaches ``least``, and the number of shared shingles."""
    shared, common = alignment(a, b, least)
    return bool(common and common >= least * (len(a) + len(b) - common)), shared


def text_key(text: Column) -> Column:
    """Sixteen bytes that equal texts share; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _sketches(texts: DataFrame) -> DataFrame:
    """``bucket, unit, n`` from ``unit, text``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.iloc[at:at + 1000]
                buckets, units, counts = [], [], []
                for unit, text in zip(part["unit"], part["text"]):
                    shingled = shingles(text)
                    keys = sketch(shingled)
                    buckets.append(keys)
                    units += [unit] * len(keys)
                    counts.append(np.full(len(keys), len(shingled)))
                if units:
                    yield pd.DataFrame({"bucket": np.concatenate(buckets), "unit": units, "n": np.concatenate(counts)})

    return texts.mapInPandas(run, "bucket long, unit binary, n int")


def _compared(pairs: DataFrame, texts: DataFrame, least: float, cells: Broadcast) -> DataFrame:
    """``leader, unit, linked, shared, rest`` of each pair ``leader, unit, routed``.

    ``rest`` are the shingles of a routed unit that the leader lacks and another candidate may have.
    """
    sides = pairs.join(texts.select("unit", "text"), "unit").join(
        texts.select(F.col("unit").alias("leader"), F.col("text").alias("leader_text")), "leader")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, lead = None, None
        for batch in batches:
            rows = []
            for leader, unit, routed, text, leader_text in zip(batch["leader"], batch["unit"], batch["routed"], batch["text"], batch["leader_text"]):
                if last != leader:
                    last, lead = leader, shingles(leader_text)
                own = shingles(text)
                linked, shared = compare(lead, own, least)
                rest = np.setdiff1d(own, lead, assume_unique=True) if routed else own[:0]
                rest = rest[cells.value[(rest % np.uint64(CELLS)).astype(np.int64)]]
                rows.append((leader, unit, linked, shared, rest.view(np.int64)))
            yield pd.DataFrame(rows, columns=["leader", "unit", "linked", "shared", "rest"])

    return sides.select("leader", "unit", "routed", "text", "leader_text").mapInPandas(
        run, "leader binary, unit binary, linked boolean, shared int, rest array<long>")


def _held_by_others(left: DataFrame, result: DataFrame) -> DataFrame:
    """``leader, unit, shared, lacking, rest`` of the members ``leader, unit, root`` that a leader leaves open.

    ``rest`` are the shingles that the leader lacks and one of its open members of
    another class has, those of fewest members first, ``lacking`` is their number. No
    other shingle brings two classes together. The order is the same for all members
    of a leader. A leader's shingles are dealt into parts of bounded size.
    """
    held = left.select("leader", "unit", "root").join(result.select("leader", "unit", "shared", "rest"), ["leader", "unit"])
    parts = held.groupBy("leader").agg(F.ceil(F.sum(F.size("rest")) / PART).alias("parts"))
    part = lambda shingle: F.pmod(F.xxhash64(shingle), F.col("parts"))
    pieces = held.join(parts, "leader").withColumn("part", F.explode(F.array_distinct(F.transform("rest", part)))).select(
        "leader", "part", "unit", "root", F.filter("rest", lambda shingle: part(shingle) == F.col("part")).alias("rest"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        classes = pd.factorize(group["root"])[0]
        lengths = [len(x) for x in group["rest"]]
        names, at, members = np.unique(np.concatenate(group["rest"].to_list()), return_inverse=True, return_counts=True)
        lowest, highest = np.full(len(names), len(group)), np.full(len(names), -1)
        np.minimum.at(lowest, at, np.repeat(classes, lengths))
        np.maximum.at(highest, at, np.repeat(classes, lengths))
        several = lowest < highest
        each = [x[several[x]] for x in np.split(at, np.cumsum(lengths)[:-1])]
        out = group[["leader", "unit"]].assign(members=[members[x] for x in each], rest=[names[x] for x in each])
        return out[[len(x) > 0 for x in each]]

    found = pieces.groupBy("leader", "part").applyInPandas(run, "leader binary, unit binary, members array<long>, rest array<long>")
    ranked = found.groupBy("leader", "unit").agg(
        F.sort_array(F.arrays_zip(F.flatten(F.collect_list("members")).alias("members"), F.flatten(F.collect_list("rest")).alias("shingle"))).alias("ranked"))
    rest = F.transform("ranked", lambda x: x["shingle"])
    return held.drop("root", "rest").join(ranked, ["leader", "unit"], "left").select(
        "leader", "unit", "shared", F.coalesce(F.size(rest), F.lit(0)).alias("lacking"), F.coalesce(rest, F.array().cast("array<bigint>")).alias("rest"))


def _shared_buckets(members: DataFrame) -> DataFrame:
    """``bucket, unit, n, able, root, linked, size, open``: members of buckets in which texts of different classes still meet.

    Members of the class that most of a bucket belong to count as linked, and
    ``open`` is the number of others. A bucket without ``far`` members is left out, as
    its members meet elsewhere. Of buckets with the same members, told by
    two 64-bit sums of their hashes, one stays.
    """
    marks = [F.xxhash64("unit").alias("mark_a"), F.xxhash64("unit", F.lit(1)).alias("mark_b")]
    classes = members.select("bucket", "root", "far", *marks).groupBy("bucket", "root").agg(
        F.count(F.lit(1)).alias("rows"), F.bool_or("far").alias("far"), F.bit_xor("mark_a").alias("mark_a"), F.bit_xor("mark_b").alias("mark_b"))
    several = classes.groupBy("bucket").agg(
        F.sum("rows").alias("size"), F.max(F.struct("rows", "root")).alias("top"),
        F.bit_xor("mark_a").alias("mark_a"), F.bit_xor("mark_b").alias("mark_b"), F.bool_or("far").alias("far")).where(
        F.col("far") & (F.col("size") > F.col("top.rows")))
    several = several.groupBy("size", "mark_a", "mark_b").agg(F.min("bucket").alias("bucket"), F.max("top").alias("top")).drop("mark_a", "mark_b")
    return members.join(several, "bucket").select(
        "bucket", "unit", "n", "able", "common", "lacking", "root", (F.col("root") == F.col("top.root")).alias("linked"), "size", (F.col("size") - F.col("top.rows")).alias("open"))


def _met(left: DataFrame, result: DataFrame, least: float) -> DataFrame:
    """``leader, unit, n, able, shared, lacking, rest, stays, inside`` of the members that a leader leaves open, with the part of ``rest`` that they need.

    What two members have in common is bounded below by their lengths, and what of it
    the leader has by the smaller share with it, so that many of the rarest
    shingles may be left out. The other member is one that the same leader leaves
    open. Two that stay meet in the leader's bucket, so the other one of a staying
    member is one that does not stay; without such a one it needs no shingle, and
    a member that is alone needs nothing at all. ``inside`` is true for staying members
    that are not the only one.
    """
    factor = least / (1 + least)
    others = left.groupBy("leader").agg(
        F.count(F.lit(1)).alias("units"), F.min("n").alias("least_n"), F.sum("n").alias("sum_n")).where("units > 1")
    # Of two, the other one's length is known.
    least_n = F.when(F.col("units") == 2, F.col("sum_n") - F.col("n")).otherwise(F.col("least_n"))
    # In common with any other open member, at least.
    bound = factor * (F.col("n") + F.greatest(F.col("n") * least, F.col("shortest"), least_n))
    met = left.join(others, "leader").join(result.select("leader", "unit", "shared", "lacking", "rest"), ["leader", "unit"]).withColumn(
        "bound", bound).withColumn("stays", F.col("shared") >= F.col("bound") - 1e-6)
    far = met.where(~F.col("stays")).groupBy("leader").agg(F.min("n").alias("far_n"), F.max("shared").alias("far_shared"), F.count(F.lit(1)).alias("far_units"))
    with_far = factor * (F.col("n") + F.greatest(F.col("n") * least, F.col("far_n"))) - F.least("shared", "far_shared")
    lacks = F.when(F.col("stays"), with_far).otherwise(F.col("bound") - F.col("shared"))
    need = F.greatest(F.lit(1), F.ceil(lacks - 1e-6).cast("int"))
    kept = F.when(F.col("stays") & F.col("far_n").isNull(), 0).otherwise(F.greatest(F.lit(0), F.col("lacking") - need + 1))
    return met.join(far, "leader", "left").select(
        "leader", "unit", "n", "able", "shared", "lacking", F.slice("rest", F.lit(1), kept).alias("rest"), "stays",
        (F.col("stays") & (F.col("units") - F.coalesce("far_units", F.lit(0)) > 1)).alias("inside"))


def _shingle_counts(texts: DataFrame) -> DataFrame:
    """``unit, cell, shingles``: per text how many of its shingles no other of ``texts`` has, and per cell the occurrences of those that several have.

    Texts without such shingles are left out; ``cell`` is null for texts, ``unit`` for cells.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at:at + 200]
                each = [shingles(text) for text in part["text"]]
                lengths = [len(x) for x in each]
                if sum(lengths):
                    yield pd.DataFrame({"shingle": np.concatenate(each).view(np.int64), "unit": np.repeat(part["unit"].to_numpy(dtype=object), lengths)})

    held = texts.mapInPandas(run, "shingle long, unit binary").groupBy("shingle").agg(
        F.count(F.lit(1)).alias("texts"), F.min("unit").alias("unit"))
    alone = F.col("texts") == 1
    # CELLS is a power of two, so the cell of the unsigned number is that of the signed one.
    return held.groupBy(F.when(alone, F.col("unit")).alias("unit"), F.when(~alone, F.pmod("shingle", F.lit(CELLS))).alias("cell")).agg(
        F.sum("texts").alias("shingles"))


def _shared_cells(counts: DataFrame) -> np.ndarray:
    """Per cell whether one of its shingles is in two texts; ``CELLS`` bytes whatever the input."""
    out = np.zeros(CELLS, dtype=bool)
    out[counts.where("cell IS NOT NULL").select("cell").toArrow()["cell"].to_numpy()] = True
    return out


def links_between(texts: DataFrame, members: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``unit, root`` of the texts that are similar to another one; ``members`` has ``bucket, unit, n``.

    Each round the most popular open members of a bucket lead, eight times as many
    as in the round before, and are compared with all its members of other classes
    that have enough shingles of others (``able``). A bucket whose open members
    have all led is done. Of two other members that are not yet in one class,
    either both share with the first leader what they share with each other, and
    stay in the bucket, or they have a shingle in common that it lacks, and meet in
    that shingle's bucket. Leaders leave their bucket, so buckets shrink and the
    rounds end.
    """
    factor = least / (1 + least)
    counts = stored(_shingle_counts(texts))
    cells = texts.sparkSession.sparkContext.broadcast(_shared_cells(counts))
    own = counts.where("unit IS NOT NULL").select("unit", F.col("shingles").alias("own"))
    members = members.join(own, "unit", "left").select("bucket", "unit", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("able"), F.col("unit").alias("root"), F.lit(True).alias("far")).withColumns(
        {"common": F.col("able"), "lacking": F.col("able")})
    members = stored(_shared_buckets(members.where(F.col("able") >= F.col("n") * least - 1e-6)))
    roots: DataFrame | None = None
    most = 1
    while not members.isEmpty():
        popular = members.groupBy("unit").agg(F.sum("size").alias("popular"))
        ranking = Window.partitionBy("bucket").orderBy(F.desc("popular"), "unit")
        shortest = members.groupBy("bucket").agg(F.min("n").alias("shortest"))
        leaders = stored(members.where(~F.col("linked") | (F.col("size") == F.col("open") + 1)).select("bucket", "unit", "n", "able", "common", "lacking", "root").join(
            popular, "unit").withColumn("place", F.row_number().over(ranking)).where(F.col("place") <= most).select(
            "bucket", F.col("unit").alias("leader"), F.col("n").alias("leader_n"), F.col("able").alias("leader_able"), F.col("common").alias("leader_common"), F.col("lacking").alias("leader_lacking"), F.col("root").alias("leader_root"), "place").join(shortest, "bucket"))
        # What two members have in common is in common with the bucket's own leader, or is lacking there.
        most_shared = F.least("able", "leader_able", F.least("common", "leader_common") + F.least("lacking", "leader_lacking"))
        enough = most_shared >= factor * (F.col("n") + F.col("leader_n")) - 1e-6
        led = stored(members.join(leaders, "bucket").where(F.col("unit") != F.col("leader")).withColumn(
            "tried", enough & (F.col("root") != F.col("leader_root"))).where(F.col("tried") | (F.col("place") == 1)))
        routed = led.where((F.col("place") == 1) & (F.col("open") > most)).select("bucket", "leader", "unit", "n", "able", "shortest")
        pairs = led.where("tried").select("leader", "unit", F.lit(False).alias("routed")).unionByName(
            routed.select("leader", "unit", F.lit(True).alias("routed"))).groupBy("leader", "unit").agg(F.bool_or("routed").alias("routed"))
        result = stored(_compared(pairs, texts, least, cells))
        roots = joined_components(roots, result.where("linked").select(F.col("leader").alias("a"), F.col("unit").alias("b")))
        left = routed.join(leaders.where(F.col("place") > 1).select("bucket", F.col("leader").alias("unit")), ["bucket", "unit"], "left_anti")
        # Buckets that this round's links have made one class hold nothing more to tell apart.
        left = left.join(roots, "unit", "left").withColumn("root", F.coalesce("root", "unit"))
        mixed = left.groupBy("bucket").agg(F.min("root").alias("lowest"), F.max("root").alias("highest")).where(F.col("lowest") < F.col("highest"))
        left = left.join(mixed.select("bucket"), "bucket")
        # A pair meets in many tables; from here on it is one row.
        left = stored(left.groupBy("leader", "unit", "n", "able", "root").agg(F.min("shortest").alias("shortest")))
        met = _met(left.drop("root"), stored(_held_by_others(left, result)), least)
        bucket = lambda key, far: F.struct(key.alias("bucket"), far.alias("far"))
        inside = F.when(F.col("inside"), F.array(bucket(F.xxhash64("leader"), F.lit(True))))
        outside = F.transform("rest", lambda shingle: bucket(F.xxhash64("leader", shingle), ~F.col("stays")))
        after = stored(met.select("unit", "n", "able", F.col("shared").alias("common"), "lacking", F.xxhash64("leader").alias("owner"),
                                  F.inline(F.concat(F.coalesce(inside, F.array_except(outside, outside)), outside))))
        # Shingles of one passage have nearly the same texts: a leader's buckets with the same smallest member become one.
        marks = after.groupBy("bucket").agg(F.min(F.xxhash64("unit", F.lit(2))).alias("mark"), F.count(F.lit(1)).alias("texts"), F.bool_or("far").alias("any_far"))
        merged = F.when(F.col("bucket") == F.col("owner"), F.col("bucket")).otherwise(F.xxhash64("owner", "mark")).alias("bucket")
        after = after.join(marks.where((F.col("texts") > 1) & F.col("any_far")), "bucket").select(
            "unit", "n", "able", "common", "lacking", "far", merged).distinct()
        after = after.join(roots, "unit", "left").withColumn("root", F.coalesce("root", "unit"))
        members = stored(_shared_buckets(after))
        most *= 8
    return roots if roots is not None else texts.select("unit", F.col("unit").alias("root")).limit(0)


def components(links: DataFrame) -> DataFrame:
    """``unit, root``: the smallest unit that each unit of ``links`` is connected to.

    Labels pass along the links and are then followed to their own label, so a
    chain shortens by a factor each round. A written table ends each round's lineage.
    """
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("unit")).agg(F.least(F.col("unit"), F.min("b")).alias("root")))
    while True:
        near = both.join(labels.select(F.col("unit").alias("a"), "root"), "a").groupBy(F.col("b").alias("unit")).agg(F.min("root").alias("near"))
        moved = labels.join(near, "unit").select("unit", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        ends = labels.select(F.col("unit").alias("root"), F.col("root").alias("end"))
        following = stored(moved.join(ends, "root").select("unit", "old", F.least("root", "end").alias("root")))
        labels = following.select("unit", "root")
        if following.where(F.col("old") != F.col("root")).isEmpty():
            return labels


def joined_components(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """``components`` of further links on top of the ``roots`` found before: only classes that the links join are labelled anew."""
    if roots is None:
        return components(links)
    of = lambda side: roots.select(F.col("unit").alias(side), F.col("root").alias(f"root_{side}"))
    lifted = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    joined = components(lifted.where(F.col("a") != F.col("b")).distinct())
    kept = roots.join(joined.select(F.col("unit").alias("root"), F.col("root").alias("further")), "root", "left").select("unit", F.coalesce("further", "root").alias("root"))
    # Units that had no class yet, or were the root of theirs.
    added = joined.join(roots.select("unit"), "unit", "left_anti")
    return stored(kept.unionByName(added))


def classify(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``unit, root, class_id, class_size`` of every distinct text; ``unit`` is its ``text_key``, ``root`` its class.

    ``class_id`` is the smallest id in the class, null if no member has one.
    """
    texts = docs.select(text_key(F.col("text")).alias("unit"), F.coalesce("text", F.lit("")).alias("text"))
    sketched = stored(_sketches(texts).groupBy("bucket", "unit").agg(F.max("n").alias("n")))
    several = sketched.groupBy("bucket").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") > 1).select("bucket")
    members = stored(sketched.join(several, "bucket"))
    units = stored(docs.select(text_key(F.col("text")).alias("unit"), "doc_id").groupBy("unit").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")))
    if members.isEmpty():
        return units.select("unit", F.col("unit").alias("root"), F.col("first").alias("class_id"), F.col("rows").alias("class_size"))
    wanted = members.select("unit").distinct()
    near = stored(texts.join(wanted, "unit", "left_semi").groupBy("unit").agg(F.first("text").alias("text")))
    roots = links_between(near, members, least)
    rooted = stored(units.join(roots, "unit", "left").withColumn("root", F.coalesce("root", "unit")))
    classes = rooted.groupBy("root").agg(F.min("first").alias("class_id"), F.sum("rows").alias("class_size"))
    return rooted.join(classes, "root").select("unit", "root", "class_id", "class_size")


def near_duplicate_classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, class_id, class_size``.

    Two texts are near duplicates if the longest common subsequence of their
    labelled five-word shingles (lower-cased words) makes up ``least`` of all
    shingles of both; classes are the connected texts. Equal texts share a class;
    null counts as empty, and texts without words are only equal or not. Repeated
    rows are counted each, and other columns are left out, whatever their names.
    """
    classes = classify(docs, least)
    return docs.select("doc_id", text_key(F.col("text")).alias("unit")).join(classes, "unit").select("doc_id", "class_id", "class_size")


def keep_first(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row of each class, that with the smallest id, with all its columns.

    Rows without an id come last; of repeated rows one stays.
    """
    last = F.lit((1 << 63) - 1)
    identity = [F.coalesce(F.col("doc_id").cast("long"), last).alias("id"), text_key(F.col("text")).alias("unit")]
    ids = docs.select(*identity).groupBy("unit").agg(F.min("id").alias("id"))
    chosen = ids.join(classify(docs, least), "unit").groupBy("root").agg(F.min(F.struct("id", "unit")).alias("first"))
    rows = docs.select(*identity, F.struct("*").alias("row")).join(chosen.select("first.id", "first.unit"), ["id", "unit"])
    return rows.groupBy("id", "unit").agg(F.first("row").alias("row")).select("row.*")
