"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into parts; two codes within distance ``parts * (s + 1) - 1``
agree in some part up to ``s`` bits. Step ``s`` probes every part of a query with
exactly ``s`` bits flipped, and a query ends once its k-th verified distance
lies within what the steps so far cover.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locusweave.llm.common import stored

BITS = 64
QUERY_STEP = 100  # every vector whose id this divides is a query
_SPREAD = 64


def sign_code(vector: Column) -> Column:
    """64-bit code: bit i says whether component i is positive; missing components count as not positive."""
    bits = [F.shiftleft(F.coalesce(F.get(vector, F.lit(i)) > 0, F.lit(False)).cast("long"), i) for i in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def cuts(parts: int) -> list[tuple[int, int]]:
    """Shift and width of each part, as even as possible."""
    ends = [BITS * p // parts for p in range(parts + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:])]


def _part(code: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(code, shift).bitwiseAND(F.lit((1 << width) - 1))


def _distances(a: Column, b: Column, pieces: list[tuple[int, int]]) -> list[Column]:
    return [F.bit_count(_part(a.bitwiseXOR(b), *piece)) for piece in pieces]


def _with_masks(df: DataFrame, width: Column, flips: int) -> DataFrame:
    """Each row once per number of ``width`` bits of which ``flips`` are set, that number as ``mask``; bits are chosen one by one, upwards."""
    df = df.withColumns({"mask": F.lit(0).cast("long"), "from": F.lit(0)})
    for _ in range(flips):
        left = F.when(F.col("from") < width, F.sequence(F.col("from"), width - 1))
        df = df.withColumn("bit", F.explode(left)).withColumns(
            {"mask": F.col("mask").bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))), "from": F.col("bit") + 1}).drop("bit")
    return df.drop("from")


def index_codes(codes: DataFrame, parts: int) -> DataFrame:
    """Stored ``part, value, code, size``: every code once per part."""
    rows = F.array(*[F.struct(F.lit(p).alias("part"), _part(F.col("code"), *piece).alias("value")) for p, piece in enumerate(cuts(parts))])
    return stored(codes.select("code", "size", F.explode(rows).alias("at")).select("at.part", "at.value", "code", "size"))


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int, parts: int, owned: DataFrame | None = None) -> DataFrame:
    """``query, own, code, distance`` with every code that is among the ``k`` nearest rows of a query code, ties included.

    ``codes`` has ``code, size``, the number of rows a code stands for, and
    ``queries`` has ``query, own``. One row of each code that ``owned``
    (``own, code``) names for the query's ``own`` does not count. What reaches
    the driver is whether a query is still open.
    """
    key = ["query", "own"]
    pieces = cuts(parts)
    index = index_codes(codes, parts)
    open_queries = stored(queries.select(*key).distinct())
    found: DataFrame | None = None
    results: list[DataFrame] = []
    for flips in range(max(width for _, width in pieces) + 1):
        places = F.array(*[F.struct(F.lit(p).alias("part"), _part(F.col("query"), *piece).alias("mine"), F.lit(piece[1]).alias("width"))
                           for p, piece in enumerate(pieces)])
        probes = open_queries.repartition(*key).select(*key, F.inline(places)).repartition(*key, "part")
        probes = _with_masks(probes, F.col("width"), flips).select(*key, "part", F.col("mine").bitwiseXOR(F.col("mask")).alias("value"))
        # Spark takes the probes for as small as the queries they are made of, and would broadcast them.
        met = probes.hint("merge").join(index, ["part", "value"])
        apart = F.array(*_distances(F.col("query"), F.col("code"), pieces))
        # A code is taken at the first part that comes closest, so once.
        met = met.withColumn("apart", apart).where((F.array_min("apart") == flips) & (F.array_position("apart", F.lit(flips)) == F.col("part") + 1))
        new = met.select(*key, "code", "size", F.bit_count(F.col("query").bitwiseXOR(F.col("code"))).alias("distance"))
        if owned is not None:
            new = new.join(owned.select("own", "code", F.lit(1).alias("less")), ["own", "code"], "left").withColumn(
                "size", F.col("size") - F.coalesce("less", F.lit(0))).where(F.col("size") > 0).drop("less")
        found = stored(new if found is None else found.join(open_queries, key, "left_semi").unionByName(new))
        nearer = Window.partitionBy(*key).orderBy("distance").rowsBetween(Window.unboundedPreceding, -1)
        counted = found.groupBy(*key, "distance").agg(F.sum("size").alias("rows")).withColumn(
            "before", F.coalesce(F.sum("rows").over(nearer), F.lit(0)))
        farthest = counted.where(F.col("before") < k).groupBy(*key).agg(
            F.max("distance").alias("farthest"), F.max(F.col("before") + F.col("rows")).alias("rows"))
        state = stored(open_queries.join(farthest, key, "left"))
        found = stored(found.join(state.select(*key, "farthest", F.col("rows").alias("have")), key).where(
            (F.col("distance") <= F.col("farthest")) | (F.col("have") < k)).drop("farthest", "have"))
        covered = parts * (flips + 1) - 1
        everything = F.lit(flips == max(width for _, width in pieces))
        closed = everything | ((F.col("rows") >= k) & (F.col("farthest") <= covered))
        done = state.where(F.coalesce(closed, F.lit(False)))
        results.append(found.join(done.select(*key), key, "left_semi").select(*key, "code", "distance"))
        open_queries = stored(state.where(~F.coalesce(closed, F.lit(False))).select(*key))
        if open_queries.isEmpty():
            break
    return reduce(DataFrame.unionByName, results)


def top_k(vectors: DataFrame, k: int = 10, query_step: int = QUERY_STEP) -> DataFrame:
    """``query_id, neighbor_id, distance, rank``: the ``k`` nearest other vectors of each query by Hamming distance, then id.

    Queries are the vectors whose id ``query_step`` divides; all vectors are
    searched. Rows without an id or a vector are neither queries nor found,
    repeated rows count once, and a query with fewer than ``k`` others gets them
    all. Different vectors of one id are rows of their own, as queries and as
    neighbours. Other columns are left out, whatever their names.
    """
    rows = stored(vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), sign_code(F.col("embedding")).alias("code"), F.xxhash64("embedding").alias("vector"),
    ).groupBy("vec_id", "code").agg(F.count_distinct("vector").alias("copies")))
    # A query id with several codes is searched for apart, its own rows left out.
    several = stored(rows.where(F.col("vec_id") % query_step == 0).groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("vec_id"))
    repeated = not several.isEmpty()
    # Of equal codes only the smallest ids can be among the nearest; one more makes up for the query itself.
    # Ids are thinned in salted groups first.
    for keys in (["code", "salt"], ["code"]):
        few = Window.partitionBy(*keys).orderBy("vec_id")
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(_SPREAD))) if "salt" in keys else members
        members = salted.withColumn("at", F.row_number().over(few)).where(F.col("at") <= k + 1).drop("at")
    members = stored(members.select("code", "vec_id", "copies"))
    codes = members.groupBy("code").agg(F.count(F.lit(1)).alias("size"))
    n = codes.count()
    queries = rows.where(F.col("vec_id") % query_step == 0).select(F.col("vec_id").alias("query_id"), F.col("code").alias("query"), F.lit("").alias("own"), F.col("copies").alias("times"))
    owned = None
    if repeated:
        known = several.select(F.col("vec_id").alias("query_id"), F.col("vec_id").cast("string").alias("name"))
        queries = queries.join(known, "query_id", "left").withColumn("own", F.coalesce("name", "own")).drop("name")
        owned = stored(members.join(several, "vec_id").select(F.col("vec_id").cast("string").alias("own"), "code"))
    parts = ceil(BITS / max(1.0, log2(max(2, n))))  # no part has more values than there are codes
    near = nearest_codes(codes, queries, k + 1, max(3, parts), owned)
    pairs = queries.join(near, ["query", "own"]).join(members, "code").where(
        F.col("vec_id") != F.col("query_id"))
    pairs = pairs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least(F.col("times") * F.col("copies"), F.lit(k)).cast("int"))))
    best = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("vec_id").alias("neighbor_id"), F.col("distance").cast("int").alias("distance"), "rank")
