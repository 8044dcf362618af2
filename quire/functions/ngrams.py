"""Character n-grams as integers, counted in Arrow batches.

An n-gram of up to three code points is one 63-bit number, 21 bits a character with 0
for none, so numbers order like the strings.  Counting a text is a sort of its numbers;
nothing is exploded into rows.  These functions run in tasks and travel with the job.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 21
LONGEST = 3
# Distinct n-grams of a language that a training task holds before it hands them on.
HELD = 1 << 20

Counts = tuple[np.ndarray, np.ndarray]


def merged(parts: list[Counts]) -> Counts:
    """Sum counts of equal codes; codes ascending."""
    if len(parts) == 1:
        return parts[0]
    codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    counts = np.zeros(len(codes), dtype=np.int64)
    np.add.at(counts, at, np.concatenate([n for _, n in parts]))
    return codes, counts


def counted(text: str, piece: int) -> Counts:
    """All overlapping 1- to 3-grams of the whole text, counted ``piece`` positions at a time."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64) + 1
    parts = []
    for at in range(0, len(points), piece):
        seen = points[at:at + piece + LONGEST - 1]
        starts = min(piece, len(points) - at)
        grams = np.zeros(0, dtype=np.int64)
        for n in range(1, LONGEST + 1):
            k = min(starts, len(seen) - n + 1)
            if k > 0:
                code = np.zeros(k, dtype=np.int64)
                for j in range(n):
                    code |= seen[j:j + k] << BITS * (LONGEST - 1 - j)
                grams = np.concatenate([grams, code])
        parts.append(np.unique(grams, return_counts=True))
    return merged(parts) if parts else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))


def profile(text: str, size: int, piece: int) -> np.ndarray:
    """The ``size`` most frequent codes, by (count descending, code)."""
    codes, counts = counted(text, piece)
    return codes[np.argsort(-counts, kind="stable")[:size]]


def training_counts(piece: int):
    """Task function: batches of (language, text) to partial counts (language, code, n)."""
    def rows(lang: str, parts: list[Counts]) -> pa.RecordBatch:
        codes, counts = merged(parts)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), type=pa.string()), pa.array(codes),
                                           pa.array(counts)], names=["lang", "code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[Counts]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang, text = lang.as_py(), text.as_py()
                if not text:
                    continue
                part = counted(text, piece)
                held.setdefault(lang, []).append(part)
                size[lang] = size.get(lang, 0) + len(part[0])
                if size[lang] > HELD:
                    held[lang] = [merged(held[lang])]
                    size[lang] = len(held[lang][0][0])
                    if size[lang] > HELD // 2:
                        yield rows(lang, held.pop(lang))
                        size.pop(lang)
        for lang, parts in held.items():
            yield rows(lang, parts)

    return run


class Profiles:
    """Language profiles as one sorted index of codes, each with its (language, rank) entries."""

    def __init__(self, langs: list[str], lang: np.ndarray, code: np.ndarray, rank: np.ndarray, size: int):
        order = np.argsort(code, kind="stable")
        self.langs, self.size = langs, size
        self.codes, self.start = np.unique(code[order], return_index=True)
        self.count = np.diff(np.r_[self.start, len(code)])
        self.lang, self.rank = lang[order], rank[order]

    def nearest(self, codes: np.ndarray) -> str:
        """Least out-of-place distance; a code that a profile lacks costs ``size``; ties to the first language."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        own = np.flatnonzero(self.codes[at] == codes)
        at, n = self.start[at[own]], self.count[at[own]]
        entry = np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())
        gain = np.abs(np.repeat(own, n) - self.rank[entry]) - self.size
        return self.langs[int(np.bincount(self.lang[entry], gain, minlength=len(self.langs)).argmin())]


def code_of(ngram: Column | str) -> Column:
    """Code of a string of one to three characters."""
    c = F.col(ngram) if isinstance(ngram, str) else ngram
    out = F.lit(0).cast("long")
    for k in range(LONGEST):
        ch = F.substring(c, k + 1, 1)
        point = F.conv(F.hex(F.encode(ch, "UTF-32")), 16, 10).cast("long") + 1
        out = out.bitwiseOR(F.when(F.length(c) > k, F.shiftleft(point, BITS * (LONGEST - 1 - k)))
                            .otherwise(F.lit(0).cast("long")))
    return out


def ngram_of(code: Column | str) -> Column:
    """String of a code."""
    c = F.col(code) if isinstance(code, str) else code
    out = []
    for k in range(LONGEST):
        point = F.shiftright(c, BITS * (LONGEST - 1 - k)).bitwiseAND(F.lit((1 << BITS) - 1)) - 1
        out.append(F.when(point >= 0, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))
                   .otherwise(F.lit("")))
    return F.concat(*out)
