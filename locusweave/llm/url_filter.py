"""URL filter: all glob rules are simulated at once by a bit-parallel automaton.

Each rule is a glob over the canonical URL ``.host#path``. The characters of all
rules share one row of 64-bit words; a step of the Shift-And recurrence moves
every rule on by one byte of the URL, for all URLs of an Arrow batch together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.llm.common import ascii_lower


@dataclass(frozen=True)
class Rule:
    """A rule for a host, all its subdomains, and the paths that start with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path

    @property
    def glob(self) -> str:
        return f"*.{self.host}#{self.path}*"


RULES = (Rule("net", "/", False), Rule("example.net", "/en/", True), Rule("example.com", "/de/", False),
         Rule("org", "/fr/", True))

# Hosts that are blocked where no rule fits.
BLOCKED_GLOBS = ("*.casino-*#*", "*.cheap-pills.*#*", "*.adult-*#*")


class ShiftAnd:
    """Multiword Shift-And automaton for globs with ``*`` (any bytes) and ``?`` (one byte)."""

    def __init__(self, globs: Sequence[str]):
        symbols: list[int | None] = []  # per bit: the byte that enters it, -1 for any, None for a start
        loops, final = [], []
        for glob in globs:
            symbols.append(None)
            loops.append(False)
            for byte in glob.encode():
                if byte == ord("*"):
                    loops[-1] = True
                else:
                    symbols.append(-1 if byte == ord("?") else byte)
                    loops.append(False)
            final.append(len(symbols) - 1)
        self.words = max(1, -(-len(symbols) // 64))
        self.start = self._mask(i for i, s in enumerate(symbols) if s is None)
        self.loop = self._mask(i for i, on in enumerate(loops) if on)
        self.enter = np.stack([self._mask(i for i, s in enumerate(symbols) if s in (-1, byte)) for byte in range(256)])
        self.final = final

    def _mask(self, bits) -> np.ndarray:
        out = np.zeros(self.words, dtype=np.uint64)
        for i in bits:
            out[i // 64] |= np.uint64(1 << (i % 64))
        return out

    def run(self, texts: Sequence[str]) -> np.ndarray:
        """State words after the last byte of each text."""
        raw = [t.encode() for t in texts]
        length = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        order = np.argsort(-length, kind="stable")
        begin = (np.cumsum(length) - length)[order]
        length = length[order]
        buffer = np.frombuffer(b"".join(raw), dtype=np.uint8)
        state = np.tile(self.start, (len(raw), 1))
        active = len(raw)
        for at in range(int(length[0]) if active else 0):
            active = int(np.searchsorted(-length[:active], -at, side="left"))  # rows longer than at
            now = state[:active]
            shifted = now << np.uint64(1)
            shifted[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:active] = (shifted & self.enter[buffer[begin[:active] + at]]) | (now & self.loop)
        out = np.empty_like(state)
        out[order] = state
        return out

    def first(self, texts: Sequence[str]) -> np.ndarray:
        """Number of the first glob that fits each text, -1 if none."""
        state = self.run(texts)
        out = np.full(len(texts), -1, dtype=np.int32)
        for k in range(len(self.final) - 1, -1, -1):
            bit = self.final[k]
            out[(state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1] = k
        return out


def first_match(text: Column, globs: Sequence[str]) -> Column:
    """Number of the first of ``globs`` that fits, -1 if none; null counts as empty."""
    automaton = ShiftAnd(globs)

    @F.pandas_udf("int")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(automaton.first(batch.fillna("").tolist()), index=batch.index)

    return match(text)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower-case ASCII and path of a URL; both empty without ``://`` or for null."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.coalesce(ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    return host, F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, blocked: Sequence[str] = BLOCKED_GLOBS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages``.

    The longest rule that fits decides; without one, a URL that fits a glob of
    ``blocked`` is blocked and any other allowed. Null or broken URLs have an
    empty host and path, no rule, and are allowed. Repeated rows are judged each;
    other columns of ``pages`` are left out, whatever their names.
    """
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name))
    host, path = host_and_path(F.col("url"))
    parts = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    canonical = F.concat(F.lit("."), F.col("host"), F.lit("#"), F.col("path"))
    found = parts.withColumn("hit", first_match(canonical, [r.glob for r in ranked] + list(blocked)))
    names = F.array(*[F.lit(r.name) for r in ranked])
    verdicts = F.array(*[F.lit("allow" if r.allow else "block") for r in ranked])
    ruled = (F.col("hit") >= 0) & (F.col("hit") < len(ranked))
    return found.select(
        "page_id", "host", "path",
        F.when(ruled, F.get(names, F.col("hit"))).alias("rule"),
        F.when(ruled, F.get(verdicts, F.col("hit"))).when(F.col("hit") >= 0, "block").otherwise("allow").alias("verdict"),
    )
