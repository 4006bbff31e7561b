"""Variant quality control and per-variant regression over a long genotype table.

Genotypes are ``ID, sample_id, n_alt`` rows (0, 1, 2, null when missing; an
absent row counts as missing too). The regression reads them once, whatever the
number of phenotypes, and packs them into one byte per call: samples are dealt
into stripes, and a packed row holds a variant's calls of a stripe, as a list of
the known ones where these are few. Phenotypes come as
blocks of columns per stripe, and the sums that the fits need are products of
both, added over the stripes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locusweave.functions.stats import chi2_isf, chi2_isf_column, ln_factorial, student_t_p
from locusweave.session import fits_broadcast, measured, settle

MIN_ALLELE_FREQUENCY = 0.05
MIN_HWE_P = 1e-6

# A task multiplies a group of variants with a block of phenotypes, both over one stripe of samples.
STRIPE_SAMPLES = 4096
GROUP_VARIANTS = 1024
BLOCK_PHENOTYPES = 32
BLOCK_COLUMNS = 512
CHUNK_VARIANTS = 128  # rows of a group that are numbers instead of bytes at a time
MISSING = 255

# A variant called in few samples of a stripe is a list of slots and calls, so its size follows its calls and not the samples.
SPARSE_CALL = np.dtype([("slot", "<u4"), ("n_alt", "u1")])
# A group of such variants has more rows, up to what makes this many sums or terms at a time.
GROUP_SPARSE = 32
GROUP_SUMS = 1 << 22
CHUNK_TERMS = 1 << 21

# -ln p of a positive double is below 746, so there are at most 746 * 2**9 coarse
# cells, each of 2**16 fine ones; p = 0 has a cell of its own beyond them.
FINE_CELLS = 1 << 25
COARSE_SHIFT = 16
ZERO_CELL = 1 << 36


def _qc_counts() -> list[Column]:
    n_alt = F.col("n_alt")
    return [
        F.count_if(n_alt == 0).alias("n_hom_ref"),
        F.count_if(n_alt == 1).alias("n_het"),
        F.count_if(n_alt == 2).alias("n_hom_var"),
    ]


def _with_frequency(counts: DataFrame) -> DataFrame:
    called = F.col("n_hom_ref") + F.col("n_het") + F.col("n_hom_var")
    return counts.withColumn("n_called", called).withColumn(
        "af", F.when(called > 0, (F.col("n_het") + 2 * F.col("n_hom_var")) / (2 * called)))


def with_hwe(counts: DataFrame, mid_p: bool = True) -> DataFrame:
    """Add ``p_hwe``, the exact Hardy-Weinberg test on genotype counts.

    The possible heterozygote counts of a variant are folded over in its own row, each
    probability following from the one before, so no row is added whatever the number
    of samples. ``mid_p`` takes off half the observed probability.

    Only heterozygote counts whose probability can be more than zero in a double are
    visited. The count is a function of the partners of the minor alleles, each of
    which moves it by two at most, so by the inequality of Azuma and Hoeffding one at
    a distance t from the mean has probability 2 exp(-t^2 / (8 minor)) or less, and
    below exp(-746) a double is zero. The terms left out would add nothing.
    """
    keys = counts.columns
    ref, het, var = F.col("n_hom_ref"), F.col("n_het"), F.col("n_hom_var")
    sized = counts.withColumn("_minor", F.least(2 * ref + het, 2 * var + het)).withColumn("_all", ref + het + var)
    minor, n = F.col("_minor"), F.col("_all")

    def log_weight(h: Column) -> Column:
        rare = (minor - h) / 2
        return h * float(np.log(2.0)) - ln_factorial(rare) - ln_factorial(h) - ln_factorial(n - h - rare)

    def following(total: Column, h: Column) -> Column:
        """``log`` is the count's log-probability over the observed one's, ``sum`` adds up what is no likelier."""
        rare = (minor - h) / 2
        step = F.log(4 * rare * (n - h - rare) / ((h + 1) * (h + 2)))
        added = F.when(total["log"] <= 1e-8, F.exp(total["log"])).otherwise(0.0)
        return F.struct((total["log"] + step).alias("log"), (total["sum"] + added).alias("sum"))

    mean = minor * (2 * n - minor) / F.greatest(2 * n - 1, F.lit(1))
    reach = F.ceil(F.sqrt(8.0 * 747.0 * minor)) + 2
    parity = minor % 2
    placed = sized.withColumns({
        "_lowest": F.greatest(F.lit(0).cast("bigint"), F.floor((mean - reach) / 2)) * 2 + parity,
        "_highest": F.least(minor, F.greatest(F.floor((mean + reach) / 2) * 2 + parity, parity)),
        "_observed": log_weight(het),
        "_scale": ln_factorial(n) + ln_factorial(minor) + ln_factorial(2 * n - minor) - ln_factorial(2 * n)})
    start = F.struct((log_weight(F.col("_lowest")) - F.col("_observed")).alias("log"), F.lit(0.0).alias("sum"))
    rarer = F.aggregate(
        F.sequence("_lowest", "_highest", F.lit(2).cast("bigint")), start, following, lambda total: total["sum"])
    observed = F.exp(F.col("_observed") + F.col("_scale"))
    return placed.select(*keys, F.least(F.lit(1.0), observed * (rarer - (0.5 if mid_p else 0.0))).alias("p_hwe"))


def variant_qc(genotypes: DataFrame, mid_p: bool = True) -> DataFrame:
    """Genotype counts, alternative allele frequency and Hardy-Weinberg p of every variant."""
    return with_hwe(_with_frequency(genotypes.groupBy("ID").agg(*_qc_counts())), mid_p)


def variant_qc_filter(
    qc: DataFrame, min_af: float = MIN_ALLELE_FREQUENCY, min_p_hwe: float = MIN_HWE_P, two_sided: bool = False
) -> DataFrame:
    """Variants above the frequency and Hardy-Weinberg thresholds.

    The frequency test is one-sided unless ``two_sided`` asks for the minor allele
    frequency; it is pushed below the exact test, which then runs on kept variants only.
    """
    frequency = F.least(F.col("af"), 1 - F.col("af")) if two_sided else F.col("af")
    return qc.filter(frequency > min_af).filter(F.col("p_hwe") > min_p_hwe)


@dataclass(frozen=True)
class _Design:
    """What one phenotype's regression needs besides the genotypes; a few scalars each.

    Phenotypes with equal ``pattern`` are known for the same samples.
    """

    phenotype: str
    n: int
    mean: float
    residual_ss: float
    centres: np.ndarray
    slopes: np.ndarray
    basis: np.ndarray
    pattern: tuple[int, int, int]

    @property
    def dof(self) -> int:
        return self.n - 2 - self.basis.shape[1]


def _designs(samples: DataFrame, phenotypes: list[str], covariates: list[str]) -> list[_Design]:
    """Per phenotype: sample count, centring, and an orthonormal basis of the covariates.

    One aggregation over the sample table brings ``k * k`` covariances per
    phenotype column to the driver; nothing there grows with samples or variants.
    Phenotypes with equal gaps come next to each other.
    """
    complete = reduce(lambda a, c: a & F.col(c).isNotNull(), covariates, F.col("y").isNotNull())
    pairs = [(a, b) for i, a in enumerate(covariates) for b in covariates[i:]]
    rows = (
        samples.unpivot(["sample_id", *covariates], [F.col(f"`{p}`") for p in phenotypes], "phenotype", "y")
        .filter(complete)
        .groupBy("phenotype")
        .agg(
            F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean"), F.var_pop("y").alias("var"),
            F.bit_xor(F.xxhash64("sample_id")).alias("who"), F.bit_xor(F.xxhash64("sample_id", F.lit(1))).alias("who_again"),
            F.array(*[F.avg(c) for c in covariates]).cast("array<double>").alias("centres"),
            F.array(*[F.covar_pop(c, "y") for c in covariates]).cast("array<double>").alias("with_y"),
            F.array(*[F.covar_pop(a, b) for a, b in pairs]).cast("array<double>").alias("gram"),
        )
        .collect()
    )
    designs = []
    for row in rows:
        k, n = len(covariates), row["n"]
        gram = np.zeros((k, k))
        for (a, b), value in zip(pairs, row["gram"]):
            i, j = covariates.index(a), covariates.index(b)
            gram[i, j] = gram[j, i] = n * value
        basis = np.zeros((k, 0))
        if k:
            # Scaling to unit variance first keeps covariates on very different scales apart from rounding.
            scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
            values, vectors = np.linalg.eigh(gram / np.outer(scale, scale))
            kept = values > 1e-10
            basis = vectors[:, kept] / np.sqrt(values[kept]) / scale[:, None]
        with_y = n * np.array(row["with_y"], dtype=float)
        shared = basis.T @ with_y
        designs.append(_Design(
            row["phenotype"], n, row["mean"], n * row["var"] - float(shared @ shared),
            np.array(row["centres"], dtype=float), basis @ shared, basis, (n, row["who"], row["who_again"])))
    return sorted(designs, key=lambda d: (d.pattern, phenotypes.index(d.phenotype)))


@dataclass
class _Block:
    """Columns of a block of phenotypes: per pattern of gaps the mean and the covariate directions, then the phenotypes."""

    designs: list[_Design]
    leads: list[_Design] = field(init=False)
    group: np.ndarray = field(init=False)
    first: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        patterns = list(dict.fromkeys(d.pattern for d in self.designs))
        self.leads = [next(d for d in self.designs if d.pattern == p) for p in patterns]
        self.group = np.array([patterns.index(d.pattern) for d in self.designs])
        self.first = np.cumsum([0] + [1 + d.basis.shape[1] for d in self.leads])

    @property
    def columns(self) -> int:
        return int(self.first[-1]) + len(self.designs)

    @property
    def sums(self) -> int:
        return 2 * self.columns + len(self.leads)

    def matrix(self, values: np.ndarray, covariates: np.ndarray) -> np.ndarray:
        """Samples x columns; zero where a phenotype does not count the sample. Missing numbers are NaN."""
        known = ~np.isnan(values) & ~np.isnan(covariates).any(axis=1)[:, None]
        values, covariates = np.nan_to_num(values), np.nan_to_num(covariates)
        out = np.zeros((len(values), self.columns))
        for g, lead in enumerate(self.leads):
            at = known[:, int(np.argmax(self.group == g))]
            out[at, self.first[g]] = 1.0
            out[at, self.first[g] + 1:self.first[g + 1]] = (covariates[at] - lead.centres) @ lead.basis
        for i, d in enumerate(self.designs):
            at = known[:, i]
            out[at, self.first[-1] + i] = values[at, i] - d.mean - (covariates[at] - d.centres) @ d.slopes
        return out

    def fits(self, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Corrected sums ``sxx, sxy`` of variants x phenotypes, NaN where a variant does not vary.

        Missing genotypes stand at the variant's mean, so only called ones add to the
        centred sums, while ``n`` counts every sample of the phenotype.
        """
        with_x, called, squares = np.split(sums, [self.columns, 2 * self.columns], axis=1)
        sxx, means = np.empty(squares.shape), np.empty(squares.shape)
        for g in range(len(self.leads)):
            first, upto = self.first[g], self.first[g + 1]
            count, total = called[:, first], with_x[:, first]
            mean = np.divide(total, count, out=np.full(len(sums), np.nan), where=count > 0)
            along = with_x[:, first + 1:upto] - mean[:, None] * called[:, first + 1:upto]
            means[:, g], sxx[:, g] = mean, squares[:, g] - total * mean - (along * along).sum(axis=1)
        usable = sxx > 1e-9 * np.maximum(1.0, squares)
        sxx = np.where(usable, sxx, np.nan)[:, self.group]
        own = slice(int(self.first[-1]), None)
        sxy = with_x[:, own] - means[:, self.group] * called[:, own]
        return sxx, np.where(np.isnan(sxx), np.nan, sxy)


def _blocks(designs: list[_Design], covariates: int) -> list[_Block]:
    """Phenotypes in blocks of one size, so that a block is a slice of the sorted phenotypes."""
    size = max(1, min(BLOCK_PHENOTYPES, BLOCK_COLUMNS // (covariates + 2)))
    return [_Block(designs[i:i + size]) for i in range(0, len(designs), size)]


def pack_genotypes(genotypes: DataFrame, slots: DataFrame) -> DataFrame:
    """``ID, stripe, n_hom_ref, n_het, n_hom_var, calls, sparse``: one byte per call, in the samples' ``slots``.

    Where fewer bytes do, ``calls`` is a list of ``SPARSE_CALL`` instead, and ``sparse`` is true.

    ``slots`` has ``sample_id, stripe, slot``; calls of samples that are not in it
    are only counted, under stripe -1. Missing calls are ``MISSING``; of several calls
    of a sample the largest counts.
    """
    side = F.broadcast(slots) if fits_broadcast(slots) else slots
    stripe = F.coalesce("stripe", F.lit(-1))
    code = F.when(F.col("n_alt").between(0, MISSING - 1), F.col("slot") * 256 + F.col("n_alt").cast("int"))
    grouped = genotypes.select("ID", "sample_id", "n_alt").join(side, "sample_id", "left").groupBy("ID", stripe.alias("stripe")).agg(
        *_qc_counts(), F.collect_list(code).alias("codes"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, codes = batch["codes"].offsets.to_numpy(), batch["codes"].values.to_numpy()
            packed, sparse = [], []
            for i in range(batch.num_rows):
                own = np.sort(codes[offsets[i]:offsets[i + 1]])
                width = int(own[-1] >> 8) + 1 if len(own) else 0
                own = own[np.append(own[1:] >> 8 != own[:-1] >> 8, True)] if len(own) else own
                sparse.append(len(own) * SPARSE_CALL.itemsize < width)
                if sparse[-1]:
                    calls = np.empty(len(own), dtype=SPARSE_CALL)
                    calls["slot"], calls["n_alt"] = own >> 8, own & 255
                else:
                    calls = np.full(width, MISSING, dtype=np.uint8)
                    calls[own >> 8] = own & 255
                packed.append(calls.tobytes())
            kept = batch.drop_columns(["codes"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(packed, pa.binary()), pa.array(sparse, pa.bool_())], [*kept.schema.names, "calls", "sparse"])

    kind = genotypes.schema["ID"].dataType.simpleString()
    return grouped.mapInArrow(pack, f"ID {kind}, stripe int, n_hom_ref bigint, n_het bigint, n_hom_var bigint, calls binary, sparse boolean")


def _slots(table: DataFrame, size: int) -> DataFrame:
    """The sample table with ``stripe`` and the ``slot`` in it; stripes have about ``STRIPE_SAMPLES`` samples."""
    stripes = max(1, -(-size // STRIPE_SAMPLES))
    order = Window.partitionBy("stripe").orderBy("sample_id")
    dealt = table.withColumn("stripe", F.pmod(F.xxhash64("sample_id"), F.lit(stripes)).cast("int"))
    return dealt.withColumn("slot", F.row_number().over(order) - 1)


def _phenotype_blocks(dealt: DataFrame, designs: list[_Design], covariates: list[str], blocks: list[_Block]) -> DataFrame:
    """``stripe, block, samples, matrix``: the columns of every block over every stripe, row by row."""
    number = lambda c: F.coalesce(F.col(f"`{c}`"), F.lit(float("nan")))
    values = F.array(*[number(d.phenotype) for d in designs])
    size = len(blocks[0].designs)
    known = dealt.sparkSession.sparkContext.broadcast(blocks)
    rows = dealt.select(
        "stripe", "slot", values.alias("values"), F.array(*[number(c) for c in covariates]).cast("array<double>").alias("covariates"),
        F.explode(F.sequence(F.lit(0), F.lit(len(blocks) - 1))).alias("block"),
    ).withColumn("values", F.slice("values", F.col("block") * size + 1, size))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        stripe, block = key[0].as_py(), key[1].as_py()
        rows = rows.combine_chunks().sort_by("slot")
        n = rows.num_rows
        values, given = (rows[c].combine_chunks().flatten().to_numpy().reshape(n, -1) for c in ("values", "covariates"))
        matrix = known.value[block].matrix(values, given)
        return pa.table({"stripe": pa.array([stripe], pa.int32()), "block": pa.array([block], pa.int32()), "samples": pa.array([n], pa.int32()),
                         "matrix": pa.array([matrix.tobytes()], pa.binary())})

    return rows.groupBy("stripe", "block").applyInArrow(build, "stripe int, block int, samples int, matrix binary")


def _dense_sums(calls: list[bytes], y: np.ndarray, ones: np.ndarray) -> np.ndarray:
    n = len(y)
    raw = b"".join(c.ljust(n, bytes([MISSING])) for c in calls)
    x = np.frombuffer(raw, dtype=np.uint8).reshape(-1, n)
    called = (x != MISSING).astype(float)
    x = np.where(x == MISSING, 0, x).astype(float)
    return np.hstack([x @ y, called @ y, (x * x) @ ones])


def _sparse_sums(calls: list[bytes], y: np.ndarray, ones: np.ndarray) -> np.ndarray:
    known = np.frombuffer(b"".join(calls), dtype=SPARSE_CALL)
    starts = np.cumsum([0] + [len(c) // SPARSE_CALL.itemsize for c in calls[:-1]])
    rows, x = y[known["slot"]], known["n_alt"].astype(float)[:, None]
    return np.add.reduceat(np.hstack([x * rows, rows, x * x * ones[known["slot"]]]), starts, axis=0)


def _products(blocks: list[_Block]) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """Sums of a group of variants with a block of phenotypes over one stripe; zeros for calls outside the sample table."""

    def multiply(key: tuple, calls: pa.Table, matrices: pa.Table) -> pa.Table:
        block = blocks[key[0].as_py()]
        sums = np.zeros((calls.num_rows, block.sums))
        if matrices.num_rows and calls.num_rows:
            n = matrices["samples"][0].as_py()
            y = np.frombuffer(matrices["matrix"][0].as_py()).reshape(n, block.columns)
            ones = y[:, block.first[:-1]]
            packed, sparse = calls["calls"].to_pylist(), calls["sparse"].to_numpy().astype(bool)
            dense = np.flatnonzero(~sparse)
            for start in range(0, len(dense), CHUNK_VARIANTS):
                own = dense[start:start + CHUNK_VARIANTS]
                sums[own] = _dense_sums([packed[i] for i in own], y, ones)
            listed = np.flatnonzero(sparse)
            upto = np.cumsum([len(packed[i]) // SPARSE_CALL.itemsize for i in listed])
            done, most = 0, max(1, CHUNK_TERMS // block.sums)
            while done < len(listed):
                end = max(done + 1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + most, side="right")))
                own, done = listed[done:end], end
                sums[own] = _sparse_sums([packed[i] for i in own], y, ones)
        return pa.table({"ID": calls["ID"], "af": calls["af"], "block": pa.array([key[0].as_py()] * calls.num_rows, pa.int32()),
                         "sums": pa.array([row.tobytes() for row in sums], pa.binary())})

    return multiply


def _groups(packed: DataFrame, sums: int) -> int:
    """How many groups of variants keep a group's rows of a stripe bounded in bytes of calls and in number."""
    per_stripe = packed.groupBy("stripe").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("calls")).alias("bytes"))
    rows, size = per_stripe.agg(F.max("rows"), F.max("bytes")).first()
    most = max(1, min(GROUP_SPARSE * GROUP_VARIANTS, GROUP_SUMS // sums))
    return max(1, -(-(rows or 0) // most), -(-(size or 0) // (GROUP_VARIANTS * STRIPE_SAMPLES)))


def _fitted(blocks: list[_Block]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the sums of a variant's stripes, which come in a row, and gives a row per phenotype; the last variant of a batch waits for the next."""

    def add(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        of = rows["block"].to_numpy()
        for number in np.unique(of):
            block, own = blocks[number], rows.filter(pa.array(of == number)).combine_chunks()
            ids = own["ID"].to_pylist()
            starts = [i for i, value in enumerate(ids) if not i or value != ids[i - 1]]
            sums = np.frombuffer(b"".join(own["sums"].to_pylist())).reshape(len(ids), block.sums)
            sxx, sxy = block.fits(np.add.reduceat(sums, starts, axis=0))
            firsts = own.select(["ID", "af"]).take(pa.array(np.repeat(starts, len(block.designs))))
            per_trait = lambda values, kind: pa.array(np.tile(np.array(values), len(starts)), kind)
            yield from pa.table({
                "ID": firsts["ID"], "af": firsts["af"], "phenotype": pa.array([d.phenotype for d in block.designs] * len(starts), pa.string()),
                "n": per_trait([d.n for d in block.designs], pa.int64()), "dof": per_trait([d.dof for d in block.designs], pa.int32()),
                "syy": per_trait([float(d.residual_ss) for d in block.designs], pa.float64()),
                "sxx": pa.array(sxx.ravel(), from_pandas=True), "sxy": pa.array(sxy.ravel(), from_pandas=True)}).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch] if waiting is None else [*waiting.to_batches(), batch])
            if not rows.num_rows:
                continue
            last, whole = (rows["block"][-1], rows["ID"][-1]), rows.num_rows - 1
            while whole and (rows["block"][whole - 1], rows["ID"][whole - 1]) == last:
                whole -= 1
            waiting = rows.slice(whole)
            if whole:
                yield from add(rows.slice(0, whole))
        if waiting is not None:
            yield from add(waiting)

    return run


def association(
    genotypes: DataFrame,
    samples: DataFrame,
    phenotypes: DataFrame,
    covariates: DataFrame | None = None,
    min_af: float | None = None,
    min_p_hwe: float | None = None,
    mid_p: bool = True,
    pvalues: bool = True,
) -> DataFrame:
    """Linear regression of every phenotype on every variant, with quality control in the same scan.

    ``samples`` lists the genotyped ``sample_id``; ``phenotypes`` and
    ``covariates`` have ``sample_id`` and one column each. A sample counts for a
    phenotype when its value and all covariates are present. Returns ``ID,
    phenotype, n, af, beta, tstat`` and, unless switched off, ``pval``.

    Covariates are projected out of the phenotype on the sample table and out of
    the genotype through its sums with an orthonormal basis, which gives the
    coefficients of the full model without solving anything per variant.

    Genotypes are read once and packed; the packed rows are settled, as quality
    control and regression both read them. Phenotypes known for the same samples
    share the sums of genotypes and covariates. Blocks of phenotypes and packed rows meet
    by stripe and group of variants, so a task holds one block of phenotypes, one stripe
    of samples and one group of variants at a time, and nothing is broadcast but
    the designs, a few numbers per phenotype. Groups are sized by what is packed, so
    copies of the phenotype blocks follow the calls and not variants times samples.
    """
    names = [c for c in phenotypes.columns if c != "sample_id"]
    number = lambda c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))
    table = samples.select("sample_id").distinct().join(
        phenotypes.select("sample_id", *[number(c).alias(c) for c in names]), "sample_id")
    extra = []
    if covariates is not None:
        given = [c for c in covariates.columns if c != "sample_id"]
        extra = [f"_covariate{i}" for i in range(len(given))]
        table = table.join(covariates.select("sample_id", *[number(c).alias(e) for c, e in zip(given, extra)]), "sample_id")
    table = settle(table)
    designs = _designs(table, names, extra)
    if not designs:
        raise ValueError("no genotyped sample has a phenotype value together with all covariates")
    blocks = _blocks(designs, len(extra))

    dealt = settle(_slots(table, table.count()))
    packed = settle(pack_genotypes(genotypes, dealt.select("sample_id", "stripe", "slot")))
    counts = _with_frequency(packed.groupBy("ID").agg(*[F.sum(c).alias(c) for c in ("n_hom_ref", "n_het", "n_hom_var")]))
    if min_af is not None:
        counts = counts.filter(F.col("af") > min_af)
    if min_p_hwe is not None:
        counts = with_hwe(counts, mid_p).filter(F.col("p_hwe") > min_p_hwe)
    kept = counts.select("ID", "af")
    groups = _groups(packed, max(block.sums for block in blocks))

    calls = packed.join(kept, "ID").select(
        "ID", "af", "stripe", "calls", "sparse", F.pmod(F.xxhash64("ID"), F.lit(groups)).cast("int").alias("group"),
        F.explode(F.sequence(F.lit(0), F.lit(len(blocks) - 1))).alias("block"))
    matrices = _phenotype_blocks(dealt, designs, extra, blocks).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    keys, kind = ["block", "group", "stripe"], genotypes.schema["ID"].dataType.simpleString()
    sums = calls.groupBy(*keys).cogroup(matrices.groupBy(*keys)).applyInArrow(
        _products(blocks), f"ID {kind}, af double, block int, sums binary")
    fits = sums.repartition("block", "ID").sortWithinPartitions("block", "ID").mapInArrow(
        _fitted(blocks), f"ID {kind}, af double, phenotype string, n bigint, dof int, syy double, sxx double, sxy double")

    beta = F.col("sxy") / F.col("sxx")
    fitted = fits.withColumn("beta", beta)
    left = F.greatest(F.lit(0.0), F.col("syy") - F.col("beta") * F.col("sxy"))
    tstat = F.when(F.col("dof") > 0, F.col("beta") / F.sqrt(F.nullif(left / F.col("dof") / F.col("sxx"), F.lit(0.0))))
    result = fitted.withColumn("tstat", tstat)
    columns = ["ID", "phenotype", "n", "af", "beta", "tstat"]
    if pvalues:
        result = result.withColumn("pval", student_t_p(F.col("tstat"), F.col("dof").cast("double")))
        columns.append("pval")
    return result.select(*columns)


def gwas_table(fits: DataFrame, variants: DataFrame) -> DataFrame:
    """Regression results with the variant's locus and alleles, in the published column order."""
    loci = variants.select(F.col("ID"), "chromosome", "position", "OA", "EA")
    return fits.join(loci, "ID", "left").select(
        F.col("ID").alias("rsid"), "chromosome", "position", "OA", "EA", F.col("af").alias("EAF"), "pval", "beta",
        "tstat", "n", "phenotype")


def _middle_cells(cells: DataFrame, by: list[str], order: Column) -> DataFrame:
    """Cells that hold one of the two middle ranks, with the number of rows before each."""
    along = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("_before") + F.sum("_rows").over(along)
    low, high = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    return (
        cells.withColumn("_upto", upto)
        .filter((F.col("_upto") >= low) & (F.col("_upto") - F.col("_rows") < high))
        .withColumn("_before", F.col("_upto") - F.col("_rows"))
    )


def middle_pvalues(results: DataFrame) -> DataFrame:
    """The two middle p-values (equal for odd counts) of every phenotype, exactly.

    Histograms over -ln p narrow the middle ranks down, first to coarse cells,
    then to fine ones; a window sees cells, never rows, and the number of cells is
    fixed. Only rows of the last cells are counted by value, so repeated values
    collapse and a fine cell holds a vanishing share of a continuous distribution.
    """
    pval, rows = F.col("pval"), F.count(F.lit(1)).alias("_rows")
    fine = F.when(pval > 0, F.floor(-F.ln(pval) * FINE_CELLS)).otherwise(F.lit(ZERO_CELL))
    usable = settle(results.filter(pval.isNotNull()).select("phenotype", "pval", fine.alias("_fine")))
    usable = usable.withColumn("_coarse", F.shiftright("_fine", COARSE_SHIFT))

    coarse = (
        usable.groupBy("phenotype", "_coarse").agg(rows)
        .withColumn("_before", F.lit(0))
        .withColumn("_n", F.sum("_rows").over(Window.partitionBy("phenotype")))
    )
    keep = ["phenotype", "_n", "_before"]
    in_coarse = measured(_middle_cells(coarse, ["phenotype"], F.col("_coarse")).select(*keep, "_coarse"))
    finer = usable.join(in_coarse, ["phenotype", "_coarse"]).groupBy(*keep, "_coarse", "_fine").agg(rows)
    in_fine = measured(_middle_cells(finer, ["phenotype", "_coarse"], F.col("_fine")).select(*keep, "_fine"))
    values = usable.join(in_fine, ["phenotype", "_fine"]).groupBy(*keep, "_fine", "pval").agg(rows)
    middle = _middle_cells(values, ["phenotype", "_fine"], pval.desc())
    return middle.groupBy("phenotype").agg(F.min("pval").alias("p_low"), F.max("pval").alias("p_high"))


def genomic_inflation(results: DataFrame) -> DataFrame:
    """Inflation factor per phenotype: median chi-square of the p-values over its expectation."""
    middle = middle_pvalues(results)
    median = (chi2_isf_column(F.col("p_low")) + chi2_isf_column(F.col("p_high"))) / 2
    return middle.select("phenotype", (median / chi2_isf(0.5)).alias("lambda_gc"))
