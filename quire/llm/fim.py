"""Fill-in-the-middle transformation with SWAR word scans.

A text is cut into units (a run of ASCII letters, or any other code point) and two
unit numbers cut it into prefix, middle and suffix.  The units are never listed: the
UTF-8 bytes are viewed as unsigned 64-bit words, eight bytes at a time are marked as
unit ends by arithmetic on the whole word, ``bitwise_count`` gives the ends of each
word, a search in their running totals finds the word that holds a given unit's end,
and a multiplication inside that word selects the byte.

A text is one row; words are marked ``CHUNK`` at a time, so what is held beside the text
is one count per eight bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16      # words marked at a time
LOW = np.uint64(0x0101010101010101)
HIGH = np.uint64(0x8080808080808080)
SEVEN = np.uint64(0x7F7F7F7F7F7F7F7F)
CASE = np.uint64(0x2020202020202020)


def words_of(data: bytes) -> np.ndarray:
    """The bytes as little-endian words, zeros after the end."""
    return np.frombuffer(data + b"\0" * (-len(data) % 8), dtype="<u8")


def _letters(w: np.ndarray) -> np.ndarray:
    """High bit of each byte that is an ASCII letter; sums of 7-bit bytes never carry."""
    x = (w | CASE) & SEVEN
    return (x + np.uint64(0x80 - ord("a")) * LOW) & ~(x + np.uint64(0x7F - ord("z")) * LOW) & ~w & HIGH


def _continuations(w: np.ndarray) -> np.ndarray:
    """High bit of each byte 10xxxxxx."""
    return w & ~(w << np.uint64(1)) & HIGH


def _following(marks: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Marks moved one byte down, the first byte of the next word coming in at the top."""
    return (marks >> np.uint64(8)) | (after << np.uint64(56))


def unit_ends(words: np.ndarray, size: int, start: int, stop: int) -> np.ndarray:
    """Words start..stop-1 with the high bit of every byte that ends a unit, given ``size`` bytes in all.

    A letter ends a unit when no letter follows; any other byte when no continuation byte does.
    """
    seen = words[start:stop + 1]
    if stop >= len(words):
        seen = np.append(seen, np.uint64(0))
    letter, more = _letters(seen), _continuations(seen)
    letter_next = _following(letter[:-1], letter[1:])
    more_next = _following(more[:-1], more[1:])
    letter = letter[:-1]
    ends = ((letter & ~letter_next) | (~letter & ~more_next)) & HIGH
    if stop >= len(words) and size % 8:
        ends[-1] &= np.uint64((1 << 8 * (size % 8)) - 1)
    return ends


def count_units(words: np.ndarray, size: int) -> np.ndarray:
    """Running totals of unit ends by word."""
    counts = [np.bitwise_count(unit_ends(words, size, at, min(at + CHUNK, len(words))))
              for at in range(0, len(words), CHUNK)]
    return np.cumsum(np.concatenate(counts), dtype=np.int64) if counts else np.zeros(0, dtype=np.int64)


def byte_after(words: np.ndarray, size: int, totals: np.ndarray, units: int) -> int:
    """Bytes taken by the first ``units`` units."""
    if units <= 0:
        return 0
    at = int(np.searchsorted(totals, units))
    rank = units - (int(totals[at - 1]) if at else 0)
    mark = int(unit_ends(words, size, at, at + 1)[0]) >> 7
    upto = (mark * int(LOW)) & 0xFFFFFFFFFFFFFFFF              # byte k: ends in bytes 0..k
    reached = ((upto | int(HIGH)) - rank * int(LOW)) & int(HIGH)
    return 8 * at + 8 - reached.bit_count() + 1


def code_points(data: bytes) -> int:
    return len(data) - sum(int(np.bitwise_count(_continuations(words_of(data[at:at + 8 * CHUNK]))).sum())
                           for at in range(0, len(data), 8 * CHUNK))


def draws(key: str) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the SHA-256 of ``key``."""
    digest = hashlib.sha256(key.encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in range(0, 16, 4))


def transform_text(data: bytes, key: str, marks: tuple[bytes, bytes, bytes], plain_percent: int,
                   spm_percent: int) -> tuple[int, str, bytes, int | None, int | None]:
    """(units, form, output, prefix code points, middle code points) of one text."""
    h1, h2, h3, h4 = draws(key)
    words = words_of(data)
    totals = count_units(words, len(data))
    n = int(totals[-1]) if len(totals) else 0
    if not data or any(m in data for m in marks) or h3 % 100 >= 100 - plain_percent:
        return n, "plain", data, None, None
    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (byte_after(words, len(data), totals, c) for c in cuts)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = marks
    if h4 % 100 < spm_percent:
        form, out = "spm", b"".join((s, suffix, p, prefix, m, middle))
    else:
        form, out = "psm", b"".join((p, prefix, s, suffix, m, middle))
    return n, form, out, code_points(prefix), code_points(middle)


def check_marks(marks: tuple[str, str, str]) -> None:
    """Marks must be distinct and none may begin where another ends, or outputs could not be read back."""
    if len(set(marks)) < 3 or not all(marks):
        raise ValueError("three different marks are needed")
    for x in marks:
        for y in marks:
            if any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y)) + (x != y))) or (x != y and y in x):
                raise ValueError(f"marks {x!r} and {y!r} overlap")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   marks: tuple[str, str, str] = ("<P>", "<S>", "<M>"), plain_percent: int = 10,
                   spm_percent: int = 20) -> DataFrame:
    """One row per input row: id, n (units), form, output, prefix_chars, middle_chars.

    ``form`` is ``plain`` (the text itself) for an empty text, one that holds a mark, and a
    share of all; else ``spm`` or ``psm``.  All draws come from the SHA-256 of ``seed:id``,
    so reruns agree and rows that repeat an id are cut at the same unit numbers.  A null
    text counts as empty, a null id as an empty one.  Cuts lie between units, so never inside a code point
    or a word; texts of any length are cut as a whole.  Other columns are ignored, so their
    names cannot clash.
    """
    check_marks(marks)
    raw = tuple(m.encode() for m in marks)
    kind = docs.schema[id_col].dataType
    src = docs.select(F.col(id_col).cast("string").alias("q_key"),
                      F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("q_text"))
    out = pa.schema([("q_key", pa.string()), ("n", pa.int64()), ("form", pa.string()),
                     ("q_out", pa.binary()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            held, size = [], 0
            for key, text in zip(keys, batch.column(1)):
                held.append((key, *transform_text(text.as_py(), f"{seed}:{'' if key is None else key}",
                                                  raw, plain_percent, spm_percent)))
                size += len(held[-1][3])
                if size >= 1 << 24:      # long outputs leave in small batches
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), out)],
                                                     schema=out)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*held), out)],
                                                 schema=out)

    done = src.mapInArrow(run, "q_key string, n long, form string, q_out binary, "
                               "prefix_chars long, middle_chars long")
    return done.select(F.col("q_key").cast(kind).alias(id_col), "n", "form",
                       F.col("q_out").cast("string").alias("output"), "prefix_chars", "middle_chars")


def restored(output: str, form: str, marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")) -> Column:
    """The text that ``output`` was made of, read back from the marks."""
    out, kind = F.col(output), F.col(form)
    p, s, m = marks

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(out, len(first) + 1, F.length(out))
        one = F.substring_index(rest, second, 1)
        rest = F.substring(rest, F.length(one) + len(second) + 1, F.length(rest))
        two = F.substring_index(rest, m, 1)
        return one, two, F.substring(rest, F.length(two) + len(m) + 1, F.length(rest))

    prefix, suffix, middle = parts(p, s)
    suffix_first, prefix_second, middle_last = parts(s, p)
    return (F.when(kind == "psm", F.concat(prefix, middle, suffix))
            .when(kind == "spm", F.concat(prefix_second, middle_last, suffix_first))
            .otherwise(out))
