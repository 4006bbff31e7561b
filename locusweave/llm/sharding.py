"""Sharding by balanced label propagation.

Documents with equal texts form a unit; units that share a line are linked. The
units start where their smallest shared line falls, then move to the shard that
holds most of their neighbours, as far as quotas allow. Rows are numbered along
shard and unit and cut into shards of equal counts, so a shard boundary splits
one unit at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locusweave.llm.common import stored

ROUNDS = 4
LEVELS = 10  # steps of gain that quotas tell apart
LEAST_LINE = 20  # characters of a line that links
_COARSE, _PARTS = 1024, 256


def shared_lines(docs: DataFrame, least: int = LEAST_LINE) -> DataFrame:
    """``unit, line``: hashes of the lines that at least two different texts have."""
    lines = docs.where(F.col("text").isNotNull()).select(
        F.xxhash64("text").alias("unit"), F.explode(F.split("text", "\n")).alias("line")
    ).where(F.length("line") >= least).select("unit", F.xxhash64("line").alias("line")).distinct()
    several = lines.groupBy("line").agg(F.count(F.lit(1)).alias("units")).where(F.col("units") > 1).select("line")
    return lines.join(several, "line").select("unit", "line")


def votes(links: DataFrame, places: DataFrame, shards: int) -> DataFrame:
    """``unit, votes, degree``: per shard, the share of each of the unit's lines that lies there, the unit itself left out."""
    placed = links.join(places.select("unit", "shard"), "unit")
    held = placed.groupBy("line").agg(
        F.array(*[F.sum((F.col("shard") == k).cast("double")) for k in range(shards)]).alias("held"), F.count(F.lit(1)).alias("units"))
    seen = placed.join(held, "line")
    return seen.groupBy("unit").agg(
        F.array(*[F.sum((F.get("held", F.lit(k)) - (F.col("shard") == k).cast("double")) / (F.col("units") - 1)) for k in range(shards)]).alias("votes"),
        F.count(F.lit(1)).alias("degree"))


def cut_links(links: DataFrame, places: DataFrame, shards: int) -> float:
    """Share of all linked pairs, each line weighing as much as its units, whose ends lie in different shards."""
    of = votes(links, places, shards).join(places, "unit")
    row = of.agg(F.sum(F.col("degree") - F.get("votes", F.col("shard"))).alias("cut"), F.sum("degree").alias("all")).first()
    return float(row["cut"] / row["all"]) if row["all"] else 0.0


def quotas(demand: list, sizes: dict[int, float], target: float) -> dict[tuple[int, int, int], float]:
    """Share of the demand ``(from, to, level, rows)`` that may move, by from, to and level.

    Between two shards as much may go one way as comes back, and free room of a
    shard is dealt out in proportion; higher gains go first.
    """
    flow: dict[tuple[int, int], float] = {}
    wanted: dict[int, float] = {}
    for s, t, _, n in demand:
        flow[s, t] = flow.get((s, t), 0.0) + n
        wanted[t] = wanted.get(t, 0.0) + n
    left = {(s, t): min(n, min(n, flow.get((t, s), 0.0)) + max(0.0, target - sizes.get(t, 0.0)) * n / wanted[t])
            for (s, t), n in flow.items()}
    out = {}
    for s, t, level, n in sorted(demand, key=lambda d: (d[0], d[1], -d[2])):
        out[s, t, level] = min(1.0, left[s, t] / n) if n else 0.0
        left[s, t] = max(0.0, left[s, t] - n)
    return out


def propagate(units: DataFrame, links: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """``unit, rows, seed, shard`` for ``units`` (``unit, rows``); the seed is a unit's smallest shared line, null without links.

    What reaches the driver each round are sums by pair of shards and level of
    gain. Units without links go where room is left.
    """
    seed = links.groupBy("unit").agg(F.min("line").alias("seed"))
    start = stored(units.join(seed, "unit", "left").withColumn("shard", F.pmod(F.xxhash64("seed"), F.lit(shards)).cast("int")))
    places = start.where(F.col("seed").isNotNull()).select("unit", "rows", "seed", "shard")
    loose = start.where(F.col("seed").isNull()).select("unit", "rows", "seed")
    total = float(units.agg(F.sum("rows")).first()[0] or 0)
    target = total / shards
    for step in range(rounds):
        best = votes(links, places, shards).withColumn("to", F.array_position("votes", F.array_max("votes")).cast("int") - 1)
        wish = places.join(best, "unit", "left").withColumn(
            "level", F.ceil((F.get("votes", F.col("to")) - F.get("votes", F.col("shard"))) / F.col("degree") * LEVELS).cast("int"))
        wish = stored(wish.select("unit", "rows", "seed", "shard", F.coalesce("to", "shard").alias("to"), F.coalesce("level", F.lit(0)).alias("level")))
        moving = (F.col("level") > 0) & (F.col("to") != F.col("shard"))
        sizes = {r.shard: float(r["n"]) for r in wish.groupBy("shard").agg(F.sum("rows").alias("n")).collect()}
        demand = [tuple(r) for r in wish.where(moving).groupBy("shard", "to", "level").agg(F.sum("rows").cast("double").alias("n")).collect()]
        share = quotas(demand, sizes, target)
        if not share:
            break
        table = F.create_map(*[F.lit(v) for (s, t, level), part in share.items() for v in ((s * shards + t) * (LEVELS + 1) + level, part)])
        key = (F.col("shard") * shards + F.col("to")) * (LEVELS + 1) + F.col("level")
        luck = F.pmod(F.xxhash64("unit", F.lit(step)), F.lit(1 << 20)) / (1 << 20)
        places = stored(wish.select("unit", "rows", "seed", F.when(moving & (luck < F.coalesce(F.element_at(table, key), F.lit(0.0))), F.col("to"))
                                    .otherwise(F.col("shard")).alias("shard")))
    sizes = {r.shard: float(r["n"]) for r in places.groupBy("shard").agg(F.sum("rows").alias("n")).collect()}
    room = [max(0.0, target - sizes.get(k, 0.0)) for k in range(shards)]
    ends = [sum(room[:k + 1]) / (sum(room) or 1.0) for k in range(shards - 1)]
    luck = F.pmod(F.xxhash64("unit", F.lit("room")), F.lit(1 << 20)) / (1 << 20)
    filled = sum(((luck >= end).cast("int") for end in ends), F.lit(0))
    return places.unionByName(loose.withColumn("shard", filled))


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``rows``: counts of shards differ by one at most, and slots run
    from 0 without gaps. A null text has size 1 and the checksum of no bytes.
    Repeated rows get a slot each. A unit too large for a shard is spread over
    neighbouring shards, its rows dealt by id and place, so that equal rows are numbered by many tasks. Other columns are left out, whatever their names. No
    rows give no rows.
    """
    raw = F.coalesce("text", F.lit("")).cast("binary")
    rows = stored(docs.select("doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
                              F.xxhash64("text").alias("unit"), F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(_PARTS)).alias("part")))
    cells = rows.groupBy("unit", "part").agg(F.count(F.lit(1)).alias("rows"))
    links = stored(shared_lines(docs))
    placed = propagate(cells.groupBy("unit").agg(F.sum("rows").alias("rows")), links, shards, rounds)
    placed = placed.select("unit", "shard", F.pmod(F.coalesce("seed", "unit"), F.lit(_COARSE)).alias("coarse"), F.pmod(F.col("unit"), F.lit(_PARTS)).alias("fine"))
    cells = cells.join(placed, "unit")
    # Counts are summed inside fine ranges, over the fine ranges of a coarse one, and over the coarse ranges,
    # of which there are shards * _COARSE. Units with one seed share a coarse range and so lie together.
    earlier = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    coarse = cells.groupBy("shard", "coarse").agg(F.sum("rows").alias("rows")).select(
        "shard", "coarse", F.coalesce(F.sum("rows").over(earlier().orderBy("shard", "coarse")), F.lit(0)).alias("base"),
        F.sum("rows").over(Window.partitionBy()).alias("total"))
    fine = cells.groupBy("shard", "coarse", "fine").agg(F.sum("rows").alias("rows")).select(
        "shard", "coarse", "fine", F.coalesce(F.sum("rows").over(earlier("shard", "coarse").orderBy("fine")), F.lit(0)).alias("middle"))
    ranges = fine.join(F.broadcast(coarse), ["shard", "coarse"])
    inner = F.coalesce(F.sum("rows").over(earlier("shard", "coarse", "fine").orderBy("unit", "part")), F.lit(0))
    starts = cells.withColumn("inner", inner).join(ranges, ["shard", "coarse", "fine"]).select(
        "unit", "part", (F.col("base") + F.col("middle") + F.col("inner")).alias("start"), "total")
    order = Window.partitionBy("unit", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("number", F.row_number().over(order) - 1).join(starts, ["unit", "part"]).withColumn(
        "place", F.col("start") + F.col("number"))
    numbered = numbered.withColumn("shard", F.expr(f"place * {shards} div total"))
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("place") - F.expr(f"(shard * total + {shards - 1}) div {shards}")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
