"""Toxicity: a string-kernel support vector machine with Nystroem landmarks.

Kernel: gap-weighted subsequences (Lodhi et al. 2002).  A word, marked at both ends, is
mapped to its subsequences of ``orders`` characters; a subsequence spread over s
characters weighs decay^s, spans up to order + ``gap`` are used, and the map is scaled by
the word's length.  So ``idxiot`` and ``idot`` stay close to ``idiot``.  Before that, characters
that are not letters are taken out of a word (``i.d.i.o.t``) and runs of three or more
one-letter words are read as one word (``i d i o t``).

A sentence holds what its most telling word holds: f(sentence) = max f(word).  Training
sentences carry their document's label.  Landmarks are the words of labelled sentences that speak most for
or against toxicity; the Nystroem features of a word are its kernel values with the
landmarks, whitened, and a linear SVM (squared hinge) is trained on the words of the
labelled sentences, weighted by the sentences they occur in.  Being linear over the
landmarks' subsequences, a machine folds into one weight per subsequence, so a new
word costs a few dozen table look-ups and each distinct word is scored once per task.

Two machines share the kernel.  The first weighs all words; a document is judged by its highest word
and the mean of its ``TOP`` highest, through a logistic fit, since much weak evidence adds up.
The second is for insults that toxic documents share: its positive examples are the words that pull hardest (``strong``) and
virtual variants of them with a letter dropped or inserted, its negative ones frequent clean
words and the clean words nearest to an insult.  One word above its cut, which a thousandth of clean training documents
reach, is enough.  It also reads the parts of a token between other characters
(``x/idiot/y``), stretches of a longer token that hold four letters of an insult (``theidiotthe``), and
two tokens that an insult was split into (``id iot``).
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain, combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

SENTENCE = re.compile(r"[.!?]+\s+|\n+")
CACHE_WORDS = 400_000        # words whose scores a task remembers; more are scored again
LONGEST = 48                 # a longer word is read as overlapping pieces of this length
SLOTS = 1 << 20              # hashed subsequences
DOCS_AT_ONCE = 200
TOP = 3
CORE = 4                     # letters of an insult that mark a stretch of a longer token
CLEAN_SHARE = 0.999          # of clean training documents lie below the cut of the second machine
STEEP = 8.0                  # log odds per margin of the second machine


@dataclass(frozen=True)
class Kernel:
    orders: tuple[int, ...] = (4, 5)
    gap: int = 2
    decay: float = 0.5


def _spots(kernel: Kernel, length: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Index sets of the subsequences of a marked word of ``length``, by order, and their weights."""
    spots, weights = [], []
    for order in kernel.orders:
        found = [(i, *rest) for i in range(length - order + 1)
                 for rest in combinations(range(i + 1, min(length, i + order + kernel.gap)), order - 1)]
        spots.append(np.array(found, dtype=np.int64).reshape(-1, order))
        weights += [kernel.decay ** (f[-1] - f[0] + 1 - order) for f in found]
    w = np.array(weights, dtype=np.float32)
    return spots, w / (np.sqrt((w * w).sum()) or 1.0) if len(w) else w


def _codes(words: list[str]) -> np.ndarray:
    """Character codes of words of one length: 1-26 for a-z, 27-63 for others, 0 for the marks."""
    n, size = len(words), len(words[0])
    c = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(n, size).astype(np.int64)
    c = np.where((c >= 97) & (c <= 122), c - 96, 27 + c % 37)
    return np.pad(c, ((0, 0), (1, 1)))


def features(words: list[str], kernel: Kernel) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(word numbers, slots, weights) per word length: the kernel map, hashed to SLOTS."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        spots, weights = _spots(kernel, int(size) + 2)
        for some in np.array_split(at, len(at) // 4096 + 1):
            c = _codes([words[i] for i in some]).astype(np.uint32)
            parts = []
            for spot in spots:                # modulo 2^32 all the way
                code = np.full((len(some), len(spot)), spot.shape[1], dtype=np.uint32)
                for k in range(spot.shape[1]):
                    code *= np.uint32(64)
                    code += c[:, spot[:, k]]
                code *= np.uint32(0x9E3779B1)
                parts.append(code >> np.uint32(12))
            yield some, np.hstack(parts), weights


@dataclass(frozen=True)
class Machine:
    slots: np.ndarray           # subsequence slots of the landmarks and their weights
    theta: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        out = np.zeros(SLOTS, dtype=np.float32)
        out[self.slots] = self.theta
        return out


NO_MACHINE = Machine(np.zeros(0, dtype=int), np.zeros(0, dtype=np.float32), -1.0)


@dataclass(frozen=True)
class ToxicModel:
    kernel: Kernel
    words: Machine              # weighs all words
    single: Machine             # one word above ``cut`` is enough
    cut: float
    strong: tuple[str, ...]     # insults that the second machine was made for
    blend: tuple[float, float, float]    # log odds = blend . (best, mean of top, 1)


def word_margins(words: list[str], kernel: Kernel, table: np.ndarray, bias: tuple[float, float]) -> np.ndarray:
    """f(word) of words of letters by both machines; minus infinity for no letters.

    ``table`` holds the first machine's weights as real and the second's as imaginary parts, so that both are looked up at once.
    """
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    pieces, half = list(words), LONGEST // 2
    more = []
    for i in np.flatnonzero(size > LONGEST).tolist():
        cut = [words[i][k:k + LONGEST] for k in range(0, len(words[i]) - half, half)]
        pieces[i] = cut[0]
        pieces += cut[1:]
        more += [i] * (len(cut) - 1)
    each = np.zeros((len(pieces), 2))
    for some, slots, weights in features(pieces, kernel) if pieces else ():
        both = np.einsum("wk,k->w", table.take(slots), weights)
        each[some, 0], each[some, 1] = both.real + bias[0], both.imag + bias[1]
    out = each[:len(words)]
    np.maximum.at(out, np.array(more, dtype=np.int64), each[len(words):])
    out[size == 0] = -np.inf
    return out


AROUND = ".,;:!?\"'()[]{}-_*#&$%0123456789"      # often stands around a word


def letters(token: str) -> str:
    """The token's letters."""
    if token.isalpha():
        return token
    inner = token.strip(AROUND)
    return inner if inner.isalpha() else "".join(c for c in inner if c.isalpha())


def parts_of(token: str) -> list[str]:
    """Runs of letters of a token that holds other characters between them."""
    return [] if token.strip(AROUND).isalpha() else [w for w in "".join(c if c.isalpha() else " " for c in token).split() if len(w) > 1]


def joined_runs(tokens: list[str]) -> list[str]:
    """Words spelled as runs of three or more one-letter tokens."""
    out, run = [], []
    for token in [*tokens, ""]:
        w = letters(token)
        if len(w) == 1:
            run.append(w)
            continue
        if len(run) >= 3:
            out.append("".join(run))
        run = []
    return out


def words_of(text: str) -> list[str]:
    """Lower-cased words of two letters or more, with the words spelled out letter by letter."""
    tokens = text.lower().split()
    return [w for w in map(letters, tokens) if len(w) > 1] + joined_runs(tokens)


class Reader:
    """Scores texts of a task: each distinct token once."""

    def __init__(self, model: ToxicModel):
        self.model = model
        self.table = model.words.table() + 1j * model.single.table()
        self.bias = model.words.bias, model.single.bias
        self.cores: dict[str, set[tuple[int, int]]] = {}
        for w in model.strong:
            for k in range(len(w) - CORE + 1):
                self.cores.setdefault(w[k:k + CORE], set()).add((k, len(w)))
        self.core = re.compile("|".join(map(re.escape, sorted(self.cores))) or "(?!)")
        self.heads = {w[:k] for w in model.strong for k in range(1, len(w))}
        self.tails = {w[k:] for w in model.strong for k in range(1, len(w))}
        self.place: dict[str, int] = {}                      # of known tokens in the arrays
        self.known = np.zeros((1024, 2), dtype=np.float32)   # margins by the first and the second machine
        self.half = np.zeros(1024, dtype=np.int8)            # whether a token can be half an insult

    def margins_of(self, words: list[str]) -> np.ndarray:
        return word_margins(words, self.model.kernel, self.table, self.bias)

    def stretches(self, word: str) -> set[str]:
        """Parts of a longer word that lie where an insult would, by four of its letters, or one letter more."""
        out = set()
        if not self.core.search(word):
            return out
        for k in range(len(word) - CORE + 1):
            for place, size in self.cores.get(word[k:k + CORE], ()):
                for a in (k - place - 1, k - place):
                    for b in (k - place + size, k - place + size + 1):
                        if 0 <= a and b <= len(word) and CORE <= b - a < len(word):
                            out.add(word[a:b])
        return out

    def learn(self, tokens: list[str]) -> None:
        """Margins of new tokens, and whether they can be half an insult."""
        plain = [letters(t) for t in tokens]
        got = self.margins_of([w if len(w) > 1 else "" for w in plain])
        size = np.fromiter(map(len, plain), dtype=np.int64, count=len(plain))
        got[size == 0, 0] = -1e9                             # a one-letter word is minus infinity: see joined_runs
        extra = {}
        for k, (t, w) in enumerate(zip(tokens, plain)):
            found = self.stretches(w)
            if len(w) < len(t):
                found.update(parts_of(t))
            if found:
                extra[k] = sorted(found)
        if extra:
            flat = sorted({x for xs in extra.values() for x in xs})
            more = dict(zip(flat, self.margins_of(flat)[:, 1].tolist()))
            for k, xs in extra.items():
                got[k, 1] = max(got[k, 1], *(more[x] for x in xs))
        first, end = len(self.place), len(self.place) + len(tokens)
        if end > len(self.known):
            grown = max(end, 2 * len(self.known))
            self.known, self.half = (np.concatenate([x, np.zeros((grown - len(x), *x.shape[1:]), x.dtype)])
                                     for x in (self.known, self.half))
        self.known[first:end] = got
        self.half[first:end] = [(w in self.heads) + 2 * (w in self.tails) for w in plain]
        self.place.update(zip(tokens, range(first, end)))

    def margins(self, texts: list) -> np.ndarray:
        """(best, mean of the TOP best, single) of each text; bias - 1 where words lack."""
        low, least = (x - 1.0 for x in self.bias)
        out = np.full((len(texts), 3), low)
        out[:, 2] = least
        for at in range(0, len(texts), DOCS_AT_ONCE):
            split = [(t or "").lower().split() for t in texts[at:at + DOCS_AT_ONCE]]
            if len(self.place) > CACHE_WORDS:
                self.place.clear()
            new = list(set(chain.from_iterable(split)).difference(self.place))
            if new:
                self.learn(new)
            for row, tokens in enumerate(split, at):
                if not tokens:
                    continue
                places = np.fromiter(map(self.place.__getitem__, tokens), dtype=np.int64, count=len(tokens))
                ms, single = self.known[places, 0], float(self.known[places, 1].max())
                half = self.half[places]
                lone = np.isneginf(ms)
                joined = joined_runs(tokens) if (lone[:-2] & lone[1:-1] & lone[2:]).any() else []
                both = np.flatnonzero((half[:-1] & 1) & (half[1:] >> 1))
                halves = [letters(tokens[k]) + letters(tokens[k + 1]) for k in both.tolist()]
                if joined or halves:
                    got = self.margins_of([*joined, *halves])
                    ms, single = np.r_[ms, got[:len(joined), 0]], max(single, got[:, 1].max())
                if len(ms) > TOP:
                    ms = np.partition(ms, len(ms) - TOP)[-TOP:]
                ms = np.maximum(ms, low)
                out[row] = ms.max(), ms.mean(dtype=np.float64), max(least, single)
        return out


def in_training(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 != 0


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, clean, docs): sentences of each label that hold the word; toxic documents."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            toxic, clean, docs = Counter(), Counter(), Counter()
            for text, y in zip(pdf["text"], pdf["toxic"]):
                held = [set(words_of(s)) for s in SENTENCE.split(text or "")]
                for words in held:
                    (toxic if y else clean).update(words)
                if y:
                    docs.update(set().union(*held))
            words = sorted(toxic.keys() | clean.keys())
            if words:
                yield pd.DataFrame({"word": words, "toxic": [toxic[w] for w in words],
                                    "clean": [clean[w] for w in words], "docs": [docs[w] for w in words]})

    per_task = sample.mapInPandas(run, "word string, toxic long, clean long, docs long")
    return per_task.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("toxic", "clean", "docs")))


def fit_machine(table: pd.DataFrame, kernel: Kernel, landmarks: int, rank: int,
                cost: float, steps: int, most: float = 200.0,
                virtual: dict[str, float] | None = None) -> Machine:
    """Nystroem features of the words and a squared-hinge SVM on them.

    ``virtual`` words are further positive examples, together as heavy as all others.
    """
    words = [w[:LONGEST] for w in table["word"]]
    tox, clean = table["toxic"].to_numpy(float), table["clean"].to_numpy(float)
    # evidence of a word: pull towards toxic or clean sentences, in standard deviations
    prior = tox.sum() / max(1.0, tox.sum() + clean.sum())
    n = tox + clean
    z = (tox - n * prior) / np.sqrt(np.maximum(n * prior * (1 - prior), 1e-9))
    order = np.argsort(-z, kind="stable")
    pick = np.array(list(dict.fromkeys([*order[: landmarks * 3 // 4], *order[::-1][: landmarks // 4]])))
    used = np.unique(np.concatenate([s.ravel() for _, s, _ in features([words[i] for i in pick], kernel)]))
    place = np.full(SLOTS, len(used))                 # one more row of zeros for all other slots
    place[used] = np.arange(len(used))
    marks = np.zeros((len(used) + 1, len(pick)), dtype=np.float32)
    for some, slots, weights in features([words[i] for i in pick], kernel):
        for row, col in zip(place[slots], some):
            np.add.at(marks[:, col], row, weights)

    def against(rows: list[str], basis: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), basis.shape[1]), dtype=np.float32)
        for some, slots, weights in features(rows, kernel):
            for cut in np.array_split(np.arange(len(some)), len(some) // 256 + 1):
                out[some[cut]] = np.einsum("wkb,k->wb", basis[place[slots[cut]]], weights)
        return out

    values, vectors = np.linalg.eigh((marks.T @ marks).astype(float))
    good = np.argsort(values)[::-1][:rank]
    good = good[values[good] > 1e-6]
    white = (vectors[:, good] / np.sqrt(values[good])).astype(np.float32)    # K_LL^(-1/2), cut to rank
    basis = marks @ white                                     # subsequence -> Nystroem feature
    x = against(words, basis).astype(float)
    # each word stands for its toxic (+1) and its clean (-1) sentences, frequent words tempered
    share = np.minimum(1.0, most / np.maximum(n, 1.0))
    pos, neg = tox * share, clean * share
    pos, neg = pos / (pos + neg).sum(), neg / (pos + neg).sum()
    if virtual:
        x = np.r_[x, against(list(virtual), basis).astype(float)]
        pos = np.r_[pos, np.array(list(virtual.values())) / sum(virtual.values())]
        neg = np.r_[neg, np.zeros(len(virtual))]
    x = np.c_[x, np.ones(len(x))]
    ridge = np.diag(np.r_[np.full(x.shape[1] - 1, 1 / cost), 1e-9])
    w = np.zeros(x.shape[1])
    for step in range(steps):                    # Newton steps over the active sentences
        m = x @ w
        up, down = pos * (m < 1), neg * (m > -1)
        new = np.linalg.solve(ridge + (x * (up + down)[:, None]).T @ x, (up - down) @ x)
        w, moved = (w + new) / 2 if step > 10 else new, np.abs(new - w).max()
        if moved < 1e-7:
            break
    return Machine(used, (basis[:-1] @ w[:-1]).astype(np.float32), float(w[-1]))


def variants(strong: dict[str, float], clean: set[str], inserted: int = 48) -> dict[str, float]:
    """Words of ``strong`` with an inner letter dropped, and hashed choices of one inserted, that are no clean words.

    Each word's weight is shared among its variants of either kind.
    """
    out: dict[str, float] = {}
    for w, weight in strong.items():
        if len(w) < CORE:
            continue
        dropped = sorted({w[:k] + w[k + 1:] for k in range(1, len(w) - 1)})
        put = [w[:k] + chr(c) + w[k:] for k in range(1, len(w)) for c in range(ord("a"), ord("z") + 1)]
        put = sorted(set(put), key=lambda v: zlib.crc32(v.encode()))[:inserted]
        for kind in (dropped, put):
            for v in kind:
                out[v] = out.get(v, 0.0) + weight / len(kind)
    return {v: x for v, x in out.items() if v not in clean and v not in strong}


def strong_words(table: pd.DataFrame, least: int = 20, pull: float = 0.5) -> dict[str, float]:
    """Words that nearly only toxic sentences hold and that pull at least half as hard as the hardest."""
    tox, n = table["toxic"].to_numpy(float), (table["toxic"] + table["clean"]).to_numpy(float)
    prior = tox.sum() / max(1.0, n.sum())
    z = (tox - n * prior) / np.sqrt(np.maximum(n * prior * (1 - prior), 1e-9))
    use = (tox >= least) & ((tox + 0.5) / (n + 1) >= 0.9) & (z >= pull * z.max(initial=0.0))
    return dict(zip(table["word"][use], tox[use].tolist()))


def nearest_clean(counts: DataFrame, strong: list[str], kernel: Kernel, most: int) -> pd.DataFrame:
    """The ``most`` clean words with the highest kernel value with a strong word: word, clean."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = np.zeros((SLOTS, len(strong)), dtype=np.float32)
        for some, slots, weights in features(strong, kernel):
            for row, col in zip(slots, some):
                np.add.at(marks[:, col], row, weights)
        for pdf in batches:
            words = [w[:LONGEST] for w in pdf["word"]]
            near = np.zeros(len(words))
            if words:
                for some, slots, weights in features(words, kernel):
                    for cut in np.array_split(np.arange(len(some)), len(some) // 1024 + 1):
                        near[some[cut]] = np.einsum("wkb,k->wb", marks[slots[cut]], weights).max(axis=1, initial=0.0)
                yield pdf.assign(near=near)

    return (counts.where("clean > 0").select("word", "clean").mapInPandas(run, "word string, clean long, near double")
            .orderBy(F.desc("near"), "word").limit(most).select("word", "clean").toPandas())


def calibrate(x: np.ndarray, labels: np.ndarray, steps: int = 60) -> tuple[float, float, float]:
    """Platt's logistic fit of label on (best, mean of top) by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    beta = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3)
        beta += np.clip(np.linalg.solve(h, x.T @ (labels - p) - 1e-2 * beta), -2, 2)
    # half a probability lies where F0.5 on the training documents is highest: clean documents weigh more
    z = x @ beta
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum(labels[order])
    gain = 1.25 * hits / (np.arange(1, len(z) + 1) + 0.25 * labels.sum())
    gain[:-1][z[order][1:] == z[order][:-1]] = -1         # no cut between equal scores
    cut = int(gain.argmax())
    low = z[order[cut + 1]] if cut + 1 < len(z) else z[order[cut]] - 1
    beta[2] -= (z[order[cut]] + low) / 2
    return tuple(beta.tolist())


def log_odds(model: ToxicModel, best: str = "best", top: str = "top", single: str = "single") -> Column:
    a, b, c = model.blend
    return F.greatest(F.lit(a) * F.col(best) + F.lit(b) * F.col(top) + F.lit(c),
                      F.lit(STEEP) * (F.col(single) - F.lit(model.cut)))


def margins(docs: DataFrame, model: ToxicModel, extra: str = "") -> DataFrame:
    """(q_key, extra columns, best, top, single) of docs(q_key, extra columns, q_text)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(model)
        for pdf in batches:
            got = reader.margins(pdf["q_text"].tolist())
            yield pdf.drop(columns="q_text").assign(best=got[:, 0], top=got[:, 1], single=got[:, 2])

    return docs.mapInPandas(run, f"q_key string, {extra}best double, top double, single double")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_words: int = 18_000,
          landmarks: int = 400, rank: int = 400, cost: float = 50_000.0, steps: int = 40,
          kernel: Kernel = Kernel()) -> ToxicModel:
    """Fit on at most ``max_rows`` labelled rows whose crc32 of the id, modulo 5, is not 0.

    The sample is the ``max_rows`` labelled ids of least hash.  Its words are counted on
    the executors; a third each of ``max_words`` reach the driver: those that lean most to
    toxic documents, the most frequent, and a hash sample of all, and of the
    clean ones as many more as lie nearest to an insult.  Null ids and labels are
    left out; with one label only, the model rejects nothing.
    """
    marked = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
              .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & in_training())
              .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_rows))
    texts = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & in_training())
    # at most max_rows pairs of numbers: a proven bound
    sample = written(texts.join(F.broadcast(marked), "doc_id"))
    counts = written(word_counts(sample))
    n = F.col("toxic") + F.col("clean")
    lean = F.col("toxic") / F.sqrt(n.cast("double"))
    third = max_words // 3
    top = (counts.where("docs >= 3").orderBy(F.desc(lean), "word").limit(third)
           .union(counts.orderBy(F.desc(n), "word").limit(third))
           .union(counts.orderBy(F.xxhash64("word"), "word").limit(third))
           .distinct().orderBy("word").toPandas())
    if not len(top) or not top["toxic"].sum() or not top["clean"].sum():
        return ToxicModel(kernel, NO_MACHINE, NO_MACHINE, 0.0, (), (1.0, 0.0, -1.0))
    machine = fit_machine(top, kernel, landmarks, rank, cost, steps)
    strong = strong_words(top)
    single = NO_MACHINE
    if strong:
        near = nearest_clean(counts, sorted(strong), kernel, max_words // 4)
        often = top.loc[top["clean"] > 0, ["word", "clean"]].nlargest(max_words // 4, "clean")
        plain = pd.concat([near, often]).drop_duplicates("word")
        plain = plain[~plain["word"].isin(list(strong))]
        # frequent words are tempered; the nearest ones count as if they were frequent
        weight = np.minimum(plain["clean"].to_numpy(float), 50) + 50.0 * plain["word"].isin(near["word"][:300]).to_numpy()
        examples = pd.concat([pd.DataFrame({"word": list(strong), "toxic": list(strong.values()), "clean": 0.0}),
                              pd.DataFrame({"word": plain["word"], "toxic": 0.0, "clean": weight})], ignore_index=True)
        single = fit_machine(examples, kernel, landmarks, rank, cost, steps,
                             virtual=variants(strong, set(plain["word"])))
    model = ToxicModel(kernel, machine, single, 0.0, tuple(sorted(strong)), (1.0, 0.0, 0.0))
    seen = margins(sample.select(F.lit("").alias("q_key"), "toxic", F.col("text").alias("q_text")),
                   model, "toxic int, ").select("best", "top", "single", "toxic").toPandas()
    blend = calibrate(seen[["best", "top"]].to_numpy(float), seen["toxic"].to_numpy(float))
    clean = seen.loc[seen["toxic"] == 0, "single"]
    cut = max(0.0, float(clean.quantile(CLEAN_SHARE))) + 1e-9 if strong and len(clean) else 0.0
    return replace(model, cut=cut, blend=blend)


def score(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: id, score (0 to 1), predicted (1 from 0.5 on).

    Null and empty texts get the score of a text without words.  Only the text is read
    for the score; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType
    src = docs.select(F.col(id_col).cast("string").alias("q_key"), F.col(text_col).alias("q_text"))
    p = 1 / (1 + F.exp(-log_odds(model)))
    out = margins(src, model).select(F.col("q_key").cast(kind).alias(id_col), p.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, model: ToxicModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the model rejects; columns unchanged, no shuffle."""
    @F.pandas_udf("best double, top double, single double")
    def marks(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        reader = Reader(model)
        for texts in batches:
            yield pd.DataFrame(reader.margins(texts.tolist()), columns=["best", "top", "single"])

    p = 1 / (1 + F.exp(-log_odds(model, "q_marks.best", "q_marks.top", "q_marks.single")))
    return docs.withColumn("q_marks", marks(F.col(text_col))).where(p < 0.5).drop("q_marks")
