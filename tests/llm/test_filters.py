"""URL filter, toxicity and quality."""

import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.llm import quality, toxicity, url_filter

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(url_filter.seed_table(spark))


def brute_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path):
    fits = [(len(t), t, v) for t, v in RULES
            if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "nothing", "http://", "://", "HTTP://A.Example.NET/en/x?y#z", "http://example.net/en/", "http://example.net/EN/",
        "http://notexample.net/en/1", "http://x.org/fr/1", "http://org/fr/", "http://xorg/fr/", "http://a.example.com/de/q",
        "http://example.com/de", "http://net", "http://a.net?x=/en/", "http://ÄB.Net/p", "a://b://c/d", "http://u@h.net:80/p",
        "http://casino-win.example.com/" + "p" * 50_000, "http://h\n.net/p\nq?r"]


def test_hosts_paths_and_rules(spark, model):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = url_filter.judge_urls(df, model).collect()
    assert len(got) == len(URLS)
    for r in got:
        host, path = brute_parts(URLS[r.page_id])
        rule, verdict = brute_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.probability >= 0.5 else "allow"))


def test_probability_equals_a_plain_sum(spark, model):
    df = spark.createDataFrame([(1, "https://free-casino.example.com/en/1.html")], "page_id long, url string")
    host, path = "free-casino.example.com", "/en/0.html"      # digits are read as 0
    grams = {("h", s[i:i + n]) for s in [f"^{host}$"] for n in model.sizes for i in range(len(s) - n + 1)}
    grams |= {("p", path[i:i + n]) for n in model.sizes for i in range(len(path) - n + 1)}
    rows = spark.createDataFrame([(m + g,) for m, g in grams], "g string")
    slots = {r[0] for r in rows.select(F.pmod(F.xxhash64("g"), F.lit(len(model.weights)))).collect()}
    want = 1 / (1 + np.exp(-(model.intercept + sum(model.weights[s] for s in slots))))
    assert abs(url_filter.judge_urls(df, model).first().probability - want) < 1e-9


def test_model_generalises_to_unseen_hosts(spark, model):
    bad = ["https://mega-casino.example.com/en/3", "http://pills-now.example.com/fr/9.html", "http://adult-club.example.org/en/1"]
    good = ["https://gardeners.example.com/en/3", "http://thren.example.com/fr/9.html", "http://ononth.example.org/en/1"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(bad + good)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(df, model).collect()}
    assert [got[i] for i in range(6)] == ["block"] * 3 + ["allow"] * 3


def test_url_filter_is_native(spark, model, capsys):
    df = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string").withColumn("z", F.lit(1))
    url_filter.judge_urls(df, model).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow|Exchange", plan.split("Scan")[0])


def test_empty_pages(spark, model):
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"), model).count() == 0


# --- toxicity --------------------------------------------------------------------------------------

INSULTS = ["grumbold", "snorkfit", "plexmud"]


def toxic_world(seed, n=400):
    rng = random.Random(seed)
    syllables = ["ba", "ri", "to", "mel", "an", "os", "den", "lu", "ke", "vi"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(60)]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(INSULTS)
        rows.append((i, ". ".join(" ".join(words[k:k + 12]) for k in range(0, 60, 12)), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows = toxic_world(1)
    d = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    lab = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (7, None)], "doc_id long, toxic int")
    return toxicity.train(d, lab, landmarks=80)


def test_toxicity_held_out_accuracy(spark, toxic_model):
    rows = toxic_world(2)
    d = spark.createDataFrame([(*r[:2], "en", "s") for r in rows], "doc_id long, text string, lang string, score string")
    got = {r.doc_id: r for r in toxicity.score(d, toxic_model).collect()}
    hits = sum(got[i].predicted == y for i, _, y in rows)
    assert hits >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_toxicity_tolerates_gaps_and_insertions(toxic_model):
    def best(text):
        return toxicity.Reader(toxic_model).margins([text])[0]
    plain, spread, clean = (best(t)[0] for t in ("ba grumbold ri", "ba grumbxold ri", "ba meldenos ri"))
    assert plain > spread > clean
    for text in ("ba g.r.u.m-b.o.l.d! ri", "ba g r u m b o l d ri", "ba grum bold ri"):
        assert best(text)[2] == pytest.approx(best("ba grumbold ri")[2], abs=1e-5)


def brute_margin(word, machine, kernel):
    """f(word) by listing every subsequence of the marked word."""
    from itertools import combinations
    weight_of = dict(zip(machine.slots.tolist(), machine.theta.tolist()))
    codes = [0, *(ord(c) - 96 if "a" <= c <= "z" else 27 + ord(c) % 37 for c in word), 0]
    total = norm = 0.0
    for order in kernel.orders:
        for spot in combinations(range(len(codes)), order):
            span = spot[-1] - spot[0] + 1
            if span > order + kernel.gap:
                continue
            code = order
            for k in spot:
                code = code * 64 + codes[k]
            w = kernel.decay ** (span - order)
            norm += w * w
            total += w * weight_of.get((code * 0x9E3779B1 & 0xFFFFFFFF) >> 12, 0.0)
    return total / (norm ** 0.5 or 1.0) + machine.bias


def test_margins_equal_brute_force(toxic_model):
    m, low = toxic_model, (toxic_model.words.bias - 1, toxic_model.single.bias - 1)
    f = lambda w, which: brute_margin(w, m.words if which == 0 else m.single, m.kernel)
    cases = {                                # text: (words that the first machine reads, further ones for the second)
        "ba grumbold ri": (["ba", "grumbold", "ri"], []),
        "Grum bold, mel": (["grum", "bold", "mel"], ["grumbold"]),
        "x/plexmud/y an": (["xplexmudy", "an"], ["plexmud"]),
        "theplexmudan os": (["theplexmudan", "os"], ["plexmud", "plexmuda", "eplexmud", "eplexmuda"]),
        "p l e x m u d an": (["an", "plexmud"], []),
        "lone": (["lone"], []), "! 12": ([], []),
    }
    assert set(m.strong) == set(INSULTS) and m.cut >= 0
    got = toxicity.Reader(m).margins([*cases, None, ""])
    for (text, (words, more)), row in zip(cases.items(), got.tolist()):
        first = sorted((max(f(w, 0), low[0]) for w in words), reverse=True) or [low[0]]
        tokens = text.split()
        first += [low[0]] * (len(tokens) - len(words))            # tokens without a word
        single = max([f(w, 1) for w in [*words, *more]] + [low[1]])
        top = sorted(first, reverse=True)[:toxicity.TOP]
        assert row[0] == pytest.approx(first[0], abs=2e-5), text
        assert row[2] == pytest.approx(single, abs=2e-5), text
        if len(words) == len(tokens):
            assert row[1] == pytest.approx(sum(top) / len(top), abs=2e-5), text
    assert got[-1].tolist() == got[-2].tolist() == pytest.approx([low[0], low[0], low[1]])


FORMS = {
    "plain": lambda w, r: w,
    "inserted": lambda w, r: w[:(k := r.randrange(1, len(w)))] + r.choice("abcdefghijklmnopqrstuvwxyz") + w[k:],
    "dropped": lambda w, r: w[:(k := r.randrange(1, len(w) - 1))] + w[k + 1:],
    "split": lambda w, r: w[:(k := r.randrange(1, len(w)))] + " " + w[k:],
    "slashed": lambda w, r: f"there/{w}/then",
    "dotted": lambda w, r: ".".join(w),
    "spelled": lambda w, r: " ".join(w),
    "unspaced": lambda w, r: f"there{w}inthe",
}


def test_one_insult_in_any_form_is_enough(spark):
    """One insult put into held-out clean documents; the figures are those of predicted."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    held = docs.join(labels.where("toxic is not null").select("doc_id", "toxic"), "doc_id").where(~toxicity.in_training())
    scored = toxicity.score(held, model).join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    hit = scored[scored["predicted"] == 1]
    assert hit["toxic"].mean() >= 0.95 and hit["toxic"].sum() >= 0.85 * scored["toxic"].sum()
    clean = [r.text for r in held.where("toxic = 0 and lang = 'en' and length(text) between 400 and 1500").orderBy("doc_id").limit(10).collect()]
    assert len(clean) == 10
    rng = random.Random(11)
    insults = ["trash", "pathetic", "idiot", "worthless", "disgusting", "stupid", "clown", "scum", "loser"]
    rows = []
    for name, form in FORMS.items():
        for w in insults:
            for t in clean:
                words = t.split(" ")
                words.insert(rng.randrange(len(words)), form(w, rng))
                rows.append((len(rows), name, w, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, form string, word string, text string")
    got = toxicity.score(df, model).join(df.select("doc_id", "form", "word"), "doc_id").toPandas()
    share = got.groupby("form")["predicted"].mean()
    by_word = got[got["form"] == "plain"].groupby("word")["predicted"].mean()
    print(share.round(3).to_dict(), hit["toxic"].mean(), hit["toxic"].sum() / scored["toxic"].sum())
    assert (by_word == 1).all(), by_word
    assert (share >= 0.9).all(), share


def test_kernel_map_equals_brute_force():
    kernel = toxicity.Kernel()
    from itertools import combinations
    for word in ("idiot", "abcabc", "éüx", "a"):
        w = f"\0{word}\0"
        spots = [c for k in kernel.orders for c in combinations(range(len(w)), k) if c[-1] - c[0] < k + kernel.gap]
        got = list(toxicity.features([word], kernel))
        assert sum(len(s[0]) for _, s, _ in got) == len(spots)
        weights = sorted(kernel.decay ** (c[-1] - c[0] + 1 - len(c)) for c in spots)
        norm = np.sqrt(sum(v * v for v in weights)) or 1
        assert np.allclose(sorted(got[0][2]), np.array(weights) / norm)


def test_toxicity_odd_inputs(spark, toxic_model):
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "!!! ??? 123"), (5, "ba " * 60_000), (6, "x" * 100_000), (6, "x"), (None, "ba ri")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score(d, toxic_model).collect()
    assert len(got) == len(rows) and all(r.predicted == 0 for r in got)
    assert got[0].score == got[1].score
    assert toxicity.score(d.limit(0), toxic_model).count() == 0
    kept = toxicity.drop_toxic(d.withColumn("margin", F.lit(1)), toxic_model)
    assert kept.count() == len(rows) and kept.columns == ["doc_id", "text", "margin"]


def test_toxicity_without_labels_rejects_nothing(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    m = toxicity.train(d, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score(d, m).first().predicted == 0


def test_training_share_follows_crc32(spark):
    d = spark.range(200).withColumnRenamed("id", "doc_id")
    got = {r.doc_id: r.t for r in d.select("doc_id", toxicity.in_training().alias("t")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 != 0 for i in range(200)}


# --- quality ---------------------------------------------------------------------------------------

def brute_kneser_ney(texts, order=quality.ORDER, symbols=quality.SYMBOLS):
    """Interpolated modified Kneser-Ney by dictionaries: probability of (context, symbol)."""
    from collections import Counter
    counts = {order: Counter()}
    for t in texts:
        codes = [0] * (order - 1) + quality.symbols(t).tolist()
        counts[order].update(tuple(codes[i:i + order]) for i in range(len(codes) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])

    def prob(gram):
        n = len(gram)
        if not n:
            return 1 / symbols
        c = counts[n]
        t = [sum(v == k for v in c.values()) for k in range(1, 5)]
        y = t[0] / (t[0] + 2 * t[1]) if t[0] + 2 * t[1] else None
        d = [0.5 if y is None or not t[k - 1] else min(float(k), max(0.0, k - (k + 1) * y * t[k] / t[k - 1])) for k in (1, 2, 3)]
        rows = [v for g, v in c.items() if g[:-1] == gram[:-1]]
        lower = prob(gram[1:])
        if not rows:
            return lower
        back = sum(d[min(v, 3) - 1] for v in rows) / sum(rows)
        v = c.get(gram, 0)
        return (v - d[min(v, 3) - 1] if v else 0) / sum(rows) + back * lower
    return prob


def test_kneser_ney_equals_brute_force(spark):
    texts = ["the cat sat on the mat", "the dog sat", "a cat, a dog; a mat", "on and on"]
    d = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    table = quality.log_table(quality.kneser_ney(quality.gram_counts(d)).drop("lang").toPandas())
    prob = brute_kneser_ney(texts)
    for probe in ("the mat sat", "zebra", "on a cat"):
        codes = quality.symbols(probe)
        padded = [0] * (quality.ORDER - 1) + codes.tolist()
        want = [np.log(prob(tuple(padded[i:i + quality.ORDER]))) for i in range(len(codes))]
        assert np.allclose(table[quality.grams(codes)], want, atol=0.02)
    assert np.exp(table.astype(np.float64)).reshape(-1, quality.SYMBOLS).sum(axis=1) == pytest.approx(1.0, abs=0.02)


class _Task:
    """Stands for a DataFrame and keeps the task function that it gets."""

    def mapInPandas(self, run, schema):
        self.run = run
        return self

    def groupBy(self, *cols):
        return self

    def agg(self, *cols):
        return self


def test_gram_counts_take_no_table_of_all_grams(spark, monkeypatch):
    texts = ["the  cat ", "", " ", "\u0130stanbul, 12.5", "\u039f\u03a3 \ud800x", "a\xa0\u6f22", "the cat"]
    frame = pd.DataFrame({"lang": ["en", "xx"] * len(texts) * 2, "text": [t for t in texts * 2 for _ in "ab"]})
    # the symbols before a text are white space
    want = Counter()
    for t in texts * 2:
        codes = [0] * (quality.ORDER - 1) + quality.symbols(t).tolist()
        want.update(sum(c * quality.SYMBOLS ** (quality.ORDER - 1 - k) for k, c in enumerate(codes[i:i + quality.ORDER]))
                    for i in range(len(codes) - quality.ORDER + 1))
    task = _Task()
    quality.gram_counts(task)
    for chunk in (quality.CHUNK, 1, 9):
        monkeypatch.setattr(quality, "CHUNK", chunk)
        tracemalloc.start()
        got = pd.concat(task.run(iter([frame])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        for lang in ("en", "xx"):
            assert got[got["lang"] == lang].groupby("gram")["c"].sum().to_dict() == dict(want)
        assert peak < 4 << 20, peak            # a count for each possible gram takes 42 MB


def test_quality_keeps_language_like_text_and_drops_noise(spark):
    rng = random.Random(4)
    say = lambda: " ".join(rng.choice(["the", "river", "runs", "under", "stone", "bridges", "slowly"]) for _ in range(40))
    noise = lambda: " ".join("".join(rng.choice("qxzjkvw#$%") for _ in range(8)) for _ in range(40))
    rows = [(i, say() if i % 10 else noise(), "en" if i % 2 else None) for i in range(300)]
    rows += [(500, None, "en"), (501, "", "en"), (502, "bonjour", "xx"), (503, say() * 200, "en")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("threshold", F.lit(1))
    lab = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(200)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality(d, lab).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept == (i % 10 > 0) for i in range(200, 300))
    assert not got[500].kept and not got[501].kept and got[502].kept and got[502].perplexity is None and got[503].kept


def test_quality_without_trusted_text(spark):
    d = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    lab = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.quality(d, lab).first().kept
    assert quality.quality(d.limit(0), lab).count() == 0


# --- quality: the word model -------------------------------------------------------------------------

def brute_word_model(texts, spell):
    """Log probability of a word after its context, by dictionaries; ``spell`` is the lowest order."""
    from collections import Counter
    n = quality.WORDS
    counts = {n: Counter()}
    for t in texts:
        w = ["<"] * (n - 1) + quality.pieces(t) + [">"]
        counts[n].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def prob(gram):
        if not gram:
            raise AssertionError
        c = counts[len(gram)]
        t = [sum(v == k for v in c.values()) for k in range(1, 5)]
        y = t[0] / (t[0] + 2 * t[1]) if t[0] + 2 * t[1] else None
        d = [0.5 if y is None or not t[k - 1] else min(float(k), max(0.0, k - (k + 1) * y * t[k] / t[k - 1])) for k in (1, 2, 3)]
        rows = [v for g, v in c.items() if g[:-1] == gram[:-1]]
        lower = spell(gram[-1]) if len(gram) == 1 else prob(gram[1:])
        if not rows:
            return lower
        back = max(1e-12, sum(d[min(v, 3) - 1] for v in rows) / sum(rows))
        v = c.get(gram, 0)
        return (v - d[min(v, 3) - 1] if v else 0) / sum(rows) + back * lower
    return prob


def test_perplexity_equals_brute_force_over_words(spark):
    good = ["the cat sat on the mat", "the dog sat", "a cat, a dog; a mat", "on and on", "the cat sat on the mat again"]
    probes = ["the cat sat on the mat", "zebra on the mat mat mat", "", " ", None, "the dog", "the dog", "猫 sat 猫猫"]
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5][:len(good)]
    rows = [(i, t, "en") for i, t in zip(ids, good)] + [(1000 + min(i, 5), t, "en") for i, t in enumerate(probes)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int")
    model = quality.train(d, lab)
    table = quality.log_table(model[2].drop("lang").toPandas())
    spell = lambda w: np.exp(float(table[0]) if w == ">" else quality.spelling([w], table)[0])
    prob = brute_word_model(good, spell)
    want = []
    for i, t, _ in rows:
        n = len(quality.symbols(t or ""))
        w = ["<"] * (quality.WORDS - 1) + quality.pieces(t) + [">"]
        log = sum(np.log(prob(tuple(w[k:k + quality.WORDS]))) for k in range(len(w) - quality.WORDS + 1))
        want.append((i, n, np.exp(-log / n) if n else -1))
    got = [(r.doc_id, r.n_symbols, -1 if r.perplexity is None else r.perplexity) for r in quality.perplexities(d, model).collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got), sorted(want)):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], rel=1e-6)


def test_model_grows_with_trusted_text(spark):
    size = {}
    for n in (300, 3000):
        texts = [f"w{i} x{i * 7} w{i + 1}" for i in range(n)]
        size[n] = quality.word_counts(spark.createDataFrame([("en", t) for t in texts], "lang string, text string")).count()
    assert size[3000] == 10 * size[300] == 3000 * 4


def test_unspaced_scripts_are_words_by_character():
    assert quality.pieces("Ab 漢字x,ไท　é\xa0b") == ["ab", "漢", "字", "x,", "ไ", "ท", "é", "b"]
    table = np.zeros(quality.SYMBOLS ** quality.ORDER) - 1
    assert quality.spelling(["ab", "漢", "x,"], table).tolist() == [-3, -2, -3]


def test_threshold_is_the_quantile_itself(spark):
    rng = random.Random(6)
    say = lambda: " ".join(rng.choice(["the", "river", "runs", "under", "stone"]) for _ in range(30))
    held = [i for i in range(200) if not zlib.crc32(str(i).encode()) % 5]
    train = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, say(), "en") for i in range(200)]
    rows += [(1000 + i, "le pont" if n % 2 else "la nuit", "fr") for n, i in enumerate(range(200))]
    fr = [1000 + i for i in range(200) if zlib.crc32(str(1000 + i).encode()) % 5]     # no held-out label in French
    rows += [(5000, "zxq vvk " * 20, "fr")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lab = spark.createDataFrame([(i, 1) for i in held + train + fr], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.quality(d, lab, slack=1.0).collect()}
    pp = sorted(got[i].perplexity for i in held)
    assert pp[int(0.9 * len(pp))] <= got[held[0]].threshold <= pp[-1]
    top = max(got[i].perplexity for i in fr)
    assert got[5000].threshold == pytest.approx(top) and not got[5000].kept and all(got[i].kept for i in fr)


def test_quality_query_cuts_at_the_quantile(spark):
    from quire.llm.queries import QUERIES
    rows = QUERIES["op5_quality"](spark, "/root/testdata/sf0.001").collect()
    limits = {(r.lang, r.threshold) for r in rows if r.threshold is not None}
    assert limits and limits <= {(r.lang, r.perplexity) for r in rows}
