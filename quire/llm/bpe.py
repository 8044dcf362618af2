"""Byte-level BPE with a two-tier lookup.

Tier 1: a minimal perfect hash over the vocabulary (hash and displace: one slot per
entry) answers a whole pre-token that is itself an entry.  Tier 2: other pre-tokens are
merged from bytes by a heap of candidate merges over a doubly linked list of pieces.
Each task remembers what it has encoded, so both tiers see a repeated word once.

Pre-tokens of the pattern never cross a single space between two other characters, so
texts are cut there first and the pattern runs on the pieces that are new to the task.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REMEMBER = 300_000           # pieces and pre-tokens a task remembers
REMEMBER_CHARS = 64          # longer pieces are encoded anew each time
# White space besides U+0020 (and four separators that only str.isspace counts).
OTHER_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


@dataclass(frozen=True)
class PerfectHash:
    """Minimal perfect hash of byte strings: as many slots as keys, one probe per look-up."""

    steps: list[int]         # per bucket: displacement, or -1 - slot for a bucket of one key
    keys: list[bytes]        # by slot
    values: list[int]

    @staticmethod
    def build(entries: dict[bytes, int], per_bucket: int = 3) -> "PerfectHash":
        size = len(entries)
        buckets: list[list[tuple[int, bytes]]] = [[] for _ in range(max(1, size // per_bucket))]
        for key in entries:
            h = xxhash.xxh64_intdigest(key)
            buckets[(h >> 32) % len(buckets)].append((h, key))
        steps, keys = [0] * len(buckets), [None] * size
        order = sorted(range(len(buckets)), key=lambda b: -len(buckets[b]))
        free = None
        for b in order:
            group = buckets[b]
            if len(group) > 1:
                step = 0
                while True:
                    slots = {((h & 0xFFFFFFFF) + step * (h >> 40 | 1)) % size for h, _ in group}
                    if len(slots) == len(group) and all(keys[s] is None for s in slots):
                        break
                    step += 1
                for h, key in group:
                    keys[((h & 0xFFFFFFFF) + step * (h >> 40 | 1)) % size] = key
                steps[b] = step
            elif group:
                free = free if free is not None else [s for s in range(size) if keys[s] is None]
                slot = free.pop()
                keys[slot] = group[0][1]
                steps[b] = -1 - slot
        return PerfectHash(steps, keys, [entries[k] for k in keys])

    def get(self, key: bytes) -> int:
        """The key's value, or -1."""
        h = xxhash.xxh64_intdigest(key)
        step = self.steps[(h >> 32) % len(self.steps)]
        slot = -1 - step if step < 0 else ((h & 0xFFFFFFFF) + step * (h >> 40 | 1)) % len(self.keys)
        return self.values[slot] if self.keys[slot] == key else -1


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line, base64 of the token and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def merge(token: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a byte string: lowest rank first, leftmost of equals, until nothing merges."""
    n = len(token)
    if n == 1:
        return [ranks[token]]
    end = list(range(1, n + 1))          # piece starting at i ends at end[i]; 0 marks a merged one
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        r = ranks.get(token[i:i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        r, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue                      # one of the two pieces has changed since
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
            r = ranks.get(token[i:end[stop]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        left = before[i]
        if left >= 0:
            r = ranks.get(token[left:stop])
            if r is not None:
                heapq.heappush(heap, (r, left, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[token[i:end[i]]])
        i = end[i]
    return out


@dataclass(frozen=True)
class Vocabulary:
    pattern: str
    ranks: dict[bytes, int]
    whole: PerfectHash

    @staticmethod
    def load(path: str, pattern: str) -> "Vocabulary":
        ranks = read_ranks(path)
        return Vocabulary(pattern, ranks, PerfectHash.build(ranks))


class Encoder:
    """Encodes texts to packed little-endian unsigned 32-bit ids; one per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        self.words: dict[str, bytes] = {}     # pre-token -> ids
        self.pieces: dict[str, bytes] = {}    # text after a single space, up to the next -> ids
        self.tokens = [b""] * (max(vocabulary.ranks.values()) + 1)
        for token, rank in vocabulary.ranks.items():
            self.tokens[rank] = token

    def _word(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        rank = self.v.whole.get(raw)
        ids = [rank] if rank >= 0 else merge(raw, self.v.ranks)
        got = np.array(ids, dtype="<u4").tobytes()
        if len(word) <= REMEMBER_CHARS:
            if len(self.words) >= REMEMBER:
                self.words.clear()
            self.words[word] = got
        return got

    def _run(self, text: str) -> bytes:
        words = self.words
        return b"".join([words.get(w) or self._word(w) for w in self.find(text)])

    def _piece(self, piece: str) -> bytes:
        got = self._run(" " + piece)
        if len(piece) <= REMEMBER_CHARS:
            if len(self.pieces) >= REMEMBER:
                self.pieces.clear()
            self.pieces[piece] = got
        return got

    def encode(self, text: str) -> bytes:
        parts = text.split(" ")
        clean = "  " not in text and text[:1] != " " and text[-1:] != " " and not any(
            c in text and (f" {c}" in text or f"{c} " in text) for c in OTHER_SPACE)
        if clean:
            get = self.pieces.get
            ids = [self._run(parts[0])]
            ids += [get(p) or self._piece(p) for p in parts[1:]]
            return b"".join(ids)
        ids, run = [], [parts[0]]             # white space beside a space: those stay in one run
        for p in parts[1:]:
            if run[-1] and p and not run[-1][-1].isspace() and not p[0].isspace():
                ids.append(self._run(" ".join(run)))
                run = ["", p]
            else:
                run.append(p)
        ids.append(self._run(" ".join(run)))
        return b"".join(ids)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text",
                     keep: list[str] | None = None, with_ids: bool = True) -> DataFrame:
    """The ``keep`` columns with n_tokens, ids_sha256, decoded_sha256 and, if asked, ids.

    One row per input row, encoded whole without special tokens; null counts as empty
    (no ids).  The ids are decoded again, and the digest is of the decoded bytes.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != text_col]
    src = docs.select(*[F.col(c).cast("string").alias(f"q_{i}") for i, c in enumerate(keep)],
                      F.col(text_col).alias("q_text"))
    fields = [f"q_{i} string" for i in range(len(keep))]
    fields += ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<int>"] if with_ids else []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Encoder(vocabulary)
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at:at + 500]
                packed = [coder.encode(t or "") for t in part["q_text"]]
                out = part.drop(columns="q_text").assign(
                    n_tokens=[len(b) // 4 for b in packed],
                    ids_sha256=[hashlib.sha256(b).hexdigest() for b in packed],
                    decoded_sha256=[hashlib.sha256(coder.decode(b)).hexdigest() for b in packed])
                if with_ids:
                    out["ids"] = [np.frombuffer(b, dtype="<i4") for b in packed]
                yield out

    out = src.mapInPandas(run, ", ".join(fields))
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    return out.select(*[F.col(f"q_{i}").cast(kinds[c]).alias(c) for i, c in enumerate(keep)],
                      "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else []))
