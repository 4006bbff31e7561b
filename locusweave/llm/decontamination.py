"""Benchmark decontamination over a positional inverted index of the training texts.

Only postings of the rarest terms of the benchmark's windows are stored. A
window is looked up by intersecting its terms' lists, rarest first, after each
list is shifted by the term's place in the window; the words around the rarest
posting, kept with it, then decide the exact phrase.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusweave.llm.common import ascii_lower, stored
from locusweave.session import fits_broadcast

WINDOW = 13
LISTS = 2  # posting lists intersected per window

_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of digits, lower-cased ASCII letters and non-ASCII characters; none for null."""
    split = F.split(ascii_lower(F.coalesce(text, F.lit(""))), _BREAKS)
    return F.array_remove(split, "")


def _small(df: DataFrame) -> DataFrame:
    """Marks ``df`` for broadcast if its counted rows fit; a shuffle join follows otherwise."""
    return F.broadcast(df) if fits_broadcast(df) else df


def benchmark_windows(benchmark: DataFrame, length: int = WINDOW) -> DataFrame:
    """``item_id, window`` (array of words), one row per distinct window of an item."""
    words = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - F.lit(length - 1), F.lit(1)))
    return words.select("item_id", "words", F.explode(starts).alias("start")).select(
        "item_id", F.slice("words", F.col("start"), length).alias("window")).distinct()


def doc_key() -> Column:
    """Rows that share a key share their id and text, so what is found for one holds for all."""
    return F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.xxhash64("text").alias("text"))


def keyed_words(docs: DataFrame) -> DataFrame:
    """``key, words`` of each document."""
    return docs.select(doc_key().alias("key"), words_of(F.col("text")).alias("words"))


def rarest_terms(texts: DataFrame, windows: DataFrame, lists: int = LISTS) -> DataFrame:
    """``window_id, window, term, offset, rank``: each window's rarest terms by their number of postings.

    Every posting is counted, but only of terms that a window has. Ranks start
    at 1; of a term that a window has twice, the first place is taken.
    """
    terms = windows.select("window").distinct().select(F.xxhash64("window").alias("window_id"), "window")
    places = terms.select("window_id", "window", F.posexplode("window").alias("offset", "term"))
    places = places.groupBy("window_id", "window", "term").agg(F.min("offset").alias("offset"))
    vocabulary = _small(places.select("term").distinct())
    counts = texts.select(F.explode("words").alias("term")).join(vocabulary, "term").groupBy("term").agg(
        F.count(F.lit(1)).alias("postings"))
    order = Window.partitionBy("window_id").orderBy("postings", "offset")
    ranked = places.join(counts, "term", "left").withColumn("postings", F.coalesce("postings", F.lit(0)))
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= lists)


def build_index(texts: DataFrame, terms: DataFrame, around: int = WINDOW) -> DataFrame:
    """Stored postings ``term, key, pos, context`` of the given terms in every text.

    ``context`` holds the ``around - 1`` words on either side; ``pos`` is counted
    from 0, and ``lead`` says at which place of the context the term stands.
    """
    postings = texts.select("key", "words", F.posexplode("words").alias("pos", "term")).join(
        _small(terms.select("term").distinct()), "term")
    first = F.greatest(F.col("pos") - (around - 1), F.lit(0))
    return stored(postings.select("term", "key", "pos", (F.col("pos") - first).alias("lead"),
                                  F.slice("words", first + 1, F.col("pos") - first + around).alias("context")))


def _shifted(index: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of each window's terms, each moved to where the window would start."""
    return index.join(_small(terms), "term").withColumn("start", F.col("pos") - F.col("offset")).where(F.col("start") >= 0)


def phrase_matches(index: DataFrame, terms: DataFrame) -> DataFrame:
    """``key, window_id, start, length`` of every exact occurrence of a window.

    The lists of a window meet at a start that all of them have; the context of
    the rarest term's posting is compared with the whole window.
    """
    begin = F.col("lead") - F.col("offset")
    exact = (F.col("rank") == 1) & (begin >= 0) & (
        F.slice("context", F.greatest(begin, F.lit(0)) + 1, F.size("window")) == F.col("window"))
    depth = Window.partitionBy("window_id")
    lists = terms.withColumn("all_ranks", F.sum(F.expr("shiftleft(1, rank)")).over(depth))
    return _shifted(index, lists).groupBy("key", "window_id", "start").agg(
        F.bit_or(F.expr("shiftleft(1, rank)")).alias("ranks"), F.max("all_ranks").alias("all_ranks"),
        F.bool_or(exact).alias("exact"), F.max(F.size("window")).alias("length"),
    ).where((F.col("ranks") == F.col("all_ranks")) & F.col("exact")).select("key", "window_id", "start", "length")


def proximity_matches(index: DataFrame, terms: DataFrame, span: int) -> DataFrame:
    """``key, window_id, pos``: postings of a window's rarest term with its other indexed terms at most ``span`` words away.

    Positions are binned by ``span``, and each bin also looks into its two
    neighbours, so distant postings of a document never meet.
    """
    listed = index.join(_small(terms), "term").select("key", "window_id", "rank", "pos")
    cell = F.floor(F.col("pos") / span)
    first = listed.where(F.col("rank") == 1).select("key", "window_id", "pos", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    others = listed.where(F.col("rank") > 1).select("key", "window_id", "rank", F.col("pos").alias("other"), cell.alias("cell"))
    near = first.join(others, ["key", "window_id", "cell"]).where(F.abs(F.col("other") - F.col("pos")) <= span)
    depth = terms.groupBy("window_id").agg(F.max("rank").alias("depth"))
    met = near.groupBy("key", "window_id", "pos").agg(F.count_distinct("rank").alias("met"))
    alone = listed.where(F.col("rank") == 1).select("key", "window_id", "pos")
    met = alone.distinct().join(met, ["key", "window_id", "pos"], "left").join(_small(depth), "window_id")
    return met.where(F.coalesce("met", F.lit(0)) == F.col("depth") - 1).select("key", "window_id", "pos")


def find_hits(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW) -> DataFrame:
    """``key, n_hit, items`` of the documents that contain a window: hit words, and the ids of the items, sorted as strings.

    Items without an id hit words but are not named.
    """
    texts = keyed_words(docs)
    windows = stored(benchmark_windows(benchmark, length))
    terms = stored(rarest_terms(texts, windows))
    index = build_index(texts, terms, length)
    matches = stored(phrase_matches(index, terms))
    before = Window.partitionBy("key").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = matches.groupBy("key", "start").agg(F.max("length").alias("length"))
    covered = F.coalesce(F.max(F.col("start") + F.col("length")).over(before), F.lit(0))
    hit = F.greatest(F.col("start") + F.col("length") - F.greatest(F.col("start"), covered), F.lit(0))
    n_hit = spans.select("key", hit.alias("hit")).groupBy("key").agg(F.sum("hit").cast("long").alias("n_hit"))
    named = windows.select(F.xxhash64("window").alias("window_id"), F.col("item_id").cast("string").alias("item"))
    items = matches.select("key", "window_id").distinct().join(_small(named), "window_id").groupBy("key").agg(
        F.sort_array(F.collect_set("item")).alias("items"))
    return n_hit.join(items, "key")


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, items, contaminated``.

    A word is hit if it lies in an occurrence of any window; a document is
    contaminated if it has hit words and they make up a twentieth of its words
    or more. Null and empty texts have no words. Rows with equal id and text
    share their result, every row comes out, and other columns are left out,
    whatever their names. With an empty benchmark nothing is hit.
    """
    hits = find_hits(docs, benchmark, length)
    ids = docs.select("doc_id", doc_key().alias("key"), F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return ids.join(hits, "key", "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    rows = docs.select(doc_key().alias("key"), F.size(words_of(F.col("text"))).alias("n_words"), F.struct("*").alias("row"))
    hits = stored(find_hits(docs, benchmark, length).select("key", "n_hit"))
    kept = rows.join(_small(hits), "key", "left").where(F.col("n_hit").isNull() | (F.col("n_hit") * 20 < F.col("n_words")))
    return kept.select("row.*")
