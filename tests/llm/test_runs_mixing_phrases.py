"""Periodic runs, mixing and phrases against plain Python, on small tables with every awkward row."""

import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelworks.llm import mixing, names, periodic_runs, phrases
from tests.conftest import rows
from tests.llm import plain


def _runs(words, least):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, 2 * q):
                found.setdefault((s, i + q), q)
            i += i == s
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda x: (x[0], x[2]))


def _collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _sequences():
    r = random.Random(11)
    out = [[], [0], [0] * 11, [0] * 12, [0] * 300, [0, 1] * 40 + [0, 0] + [0, 1] * 40]
    for _ in range(250):
        n, k = r.choice([5, 12, 13, 40, 120]), r.choice([1, 2, 3, 40])
        words = [r.randrange(k) for _ in range(n)]
        if r.random() < 0.7:
            a = r.randrange(n)
            p = r.randint(1, max(1, (n - a) // 2))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if r.random() < 0.3:
            words[r.randrange(n)] = 99
        out.append(words)
    return out


@pytest.mark.parametrize("least", [2, 5, 12, 33])
def test_runs_of_many_sequences(least):
    sequences = _sequences()
    values = np.array([v for s in sequences for v in s], dtype=np.int64)
    row = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
    base = np.cumsum([0, *map(len, sequences)])
    got = [[] for _ in sequences]
    for s, e, q in zip(*(x.tolist() for x in periodic_runs.find(values, row, least)), strict=True):
        got[row[s]].append((s - int(base[row[s]]), e - s, q))
    assert got == [_runs(s, least) for s in sequences]


def test_every_period_has_a_window():
    for least in (2, 12, 50):
        windows = periodic_runs.distances(least, 1000)
        assert sorted(q for w in windows for a, b in w for q in range(a, b + 1)) == list(range(1, 501))
        for k, spans in enumerate(windows):
            assert all(b - a < 1 << k and 2 << k <= max(least, 2 * a) - a + 1 for a, b in spans)


def test_wavelet_tree():
    r = random.Random(1)
    values = np.array(r.sample(range(200), 90))
    tree = periodic_runs.WaveletTree(values, 200)
    lo = np.array([r.randrange(60) for _ in range(80)])
    hi = lo + np.array([r.randint(1, 30) for _ in range(80)])
    x = np.array([r.randrange(201) for _ in range(80)])
    want = [int((values[a:b] < y).sum()) for a, b, y in zip(lo, hi, x, strict=True)]
    assert tree.below(lo, hi, x).tolist() == want
    k = (hi - lo) // 2
    assert tree.nth(lo, hi, k).tolist() == [sorted(values[a:b].tolist())[c] for a, b, c in zip(lo, hi, k, strict=True)]


def test_runs_of_documents(spark):
    texts = [None, "", " \n\t ", "one", "A b\n" * 9, "a B " * 9, "x " + "é ü ß " * 20 + "y", "w " * 30_000]
    texts += [" ".join(f"w{i % 700}" for i in range(9_000)), "p q r " * 4 + "s " + "p q r " * 4, "A b\n" * 9]
    # A word is a word whatever its length: two that only a weak hash takes for one are told apart.
    texts.append(" ".join(["k"] * 11 + ["l"]))
    docs = [(None if i % 5 == 4 else i, t, 7, "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_words int, runs string").repartition(3)
    found = periodic_runs.find_runs(frame, batch_bytes=2000)
    got = sorted(
        ((r["doc_id"], r["text"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed_text"]) for r in found.collect()), key=repr
    )
    want = []
    for i, t, _, _ in docs:
        words = plain.WHITE.findall(t or "")
        runs = _runs(words, 12) if len(words) < 10_000 else [(0, len(words), 1)]
        want.append((i, t, len(words), runs, _collapsed(words, runs)))
    assert got == sorted(want, key=repr)
    assert periodic_runs.find_runs(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="two words"):
        periodic_runs.find_runs(frame, least=1)


CURRICULUM = [[(0, 8), (1, 2)], [(0, 2), (1, 2)], [(0, 0), (0.5, 1), (1, 2)]]
MIXED = "doc_id long, text string, source string, size string, key int, span int, of int, missing int, at int, kind int"


def _mixed_docs():
    r = random.Random(9)
    docs = []
    for i in range(400):
        source = r.choice(["a", "a", "a", "a", "b", "c", "\U0001f600", "￮", "", None])
        docs.append((i, " ".join("w" for _ in range(r.choice([0, 1, 3, 40])))[: r.choice([None, 30])], source))
    docs += [(400, None, "d"), (401, "", "e"), (None, "a b c", "a"), (None, "a b c", "a"), (7, "t u", "b"), (7, "t u", "b"), (402, "z " * 50_000, "b")]
    return docs


def _targets(sizes, weights, percent, most):
    left = set(sizes)
    target = {}
    total = Fraction(sum(sizes.values()) * percent, 100)
    while True:
        rest = total - sum(target.values())
        weight = sum(weights[s] for s in left)
        over = {s for s in left if rest * weights[s] / weight > most * sizes[s]}
        if not over:
            return target | {s: rest * weights[s] / weight for s in left}
        target |= {s: Fraction(most * sizes[s]) for s in over}
        left -= over


@pytest.mark.parametrize(("percent", "most"), [(150, 2), (40, 1), (100, 1), (290, 3)])
def test_mix_meets_its_targets(spark, percent, most):
    docs = _mixed_docs()
    frame = spark.createDataFrame([(*d, "x", 1, 2, 3, 4, 5, 6) for d in docs], MIXED).repartition(5)
    mixed = mixing.mix(frame, CURRICULUM, percent=percent, most=most)
    got = mixed.collect()
    assert len(got) == len(docs) and {"key", "span", "of", "missing", "at", "kind"} < set(mixed.columns)
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(plain.WHITE.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = _targets(sizes, {s: [5, 2, 1][k % 3] for k, s in enumerate(order)}, percent, most)
    taken = Counter()
    for r in got:
        assert (r["size"], r["source_size"]) == (len(plain.WHITE.findall(r["text"] or "")), sizes[r["source"]])
        assert r["target"] == pytest.approx(float(target[r["source"]]), rel=1e-12)
        assert 0 <= r["taken"] <= most * r["size"] and r["taken"] == sum(c["words"] for c in r["copies"])
        assert all(0 <= c["position"] <= 1 for c in r["copies"])
        taken[r["source"]] += r["taken"]
    assert all(taken[s] == int(target[s]) for s in sizes)
    again = mixing.mix(frame.repartition(2), CURRICULUM, percent=percent, most=most)
    pick = ["doc_id", "source", "size", "taken", "copies"]
    assert rows(again, *pick) == rows(mixed, *pick)


def test_mix_follows_the_schedules(spark):
    docs = [(i, "w " * 10, s) for i in range(6000) for s in "abc"]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    mixed = mixing.mix(frame, CURRICULUM, percent=100, most=3)
    order = mixing.training_order(mixed).select("source", "words", "position").collect()
    assert [r["position"] for r in order] == sorted(r["position"] for r in order)
    for lo, hi in ((0.0, 0.25), (0.4, 0.6), (0.75, 1.0)):
        middle = (lo + hi) / 2
        want = np.array([8 - 6 * middle, 2, 2 * middle])
        share = np.array([sum(r["words"] for r in order if r["source"] == s and lo <= r["position"] < hi) for s in "abc"])
        assert np.abs(share / share.sum() - want / want.sum()).max() < 0.01
    first = [r["position"] for r in mixing.by_position(mixed).select(F.get("copies", F.lit(0))["position"].alias("position")).collect()]
    assert [p is None for p in first] == sorted(p is None for p in first)
    assert first[:9000] == sorted(first[:9000])


def test_mix_of_odd_tables(spark):
    frame = spark.createDataFrame(_mixed_docs(), "doc_id long, text string, source string")
    assert mixing.mix(frame.limit(0), CURRICULUM).count() == 0
    blank = mixing.mix(frame.withColumn("text", F.lit(None).cast("string")), CURRICULUM)
    assert {(r["size"], r["target"], r["taken"], len(r["copies"])) for r in blank.collect()} == {(0, 0.0, 0, 0)}
    for bad in ([[(0, 1)]], [[(0, 1), (0.5, 1)]], [[(0, -1), (1, 1)]], [[(0, 0), (1, 0)]]):
        with pytest.raises(ValueError, match="schedule|weights"):
            mixing.whole_weights(bad)
    assert mixing.whole_weights(CURRICULUM) == [5, 2, 1]


def _collocations(docs, least, longest, top, within):
    count, total = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", plain.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                count.update((lang, *words[p : p + size]) for p in range(len(words) - size + 1))
    candidates = {g: a for g, a in count.items() if len(g) > 2 and a >= least}
    out = []
    for (lang, *w), a in candidates.items():
        inside = any(
            b[0] == lang and len(b) > len(w) + 1 and 100 * f >= within * a and any(list(b[p : p + len(w)]) == w for p in range(1, len(b)))
            for b, f in candidates.items()
        )
        if not inside:
            sides = [(count[(lang, *w[:k])], count[(lang, *w[k:])]) for k in range(1, len(w))]
            score, k = min((2_000_000 * a // (x + y), k) for k, (x, y) in enumerate(sides))
            out.append((lang, -score, -a, " ".join(w).encode(), *sides[k]))
    ranked = []
    for lang in total:
        best = sorted(x for x in out if x[0] == lang)[:top]
        ranked += [(lang, i, p.decode(), -a, x, y, total[lang], -s) for i, (_, s, a, p, x, y) in enumerate(best, 1)]
    return ranked


def _phrase_docs():
    r = random.Random(6)
    words = ["of", "the", "New", "york", "é", "a b", "z\x00", "ß", "\U0001f600", "￮"]
    docs = [(r.choice(["en", "en", "en", "d\ne", None, "und", ""]), None)]
    for _ in range(300):
        parts = []
        for _ in range(r.randint(0, 30)):
            parts.append(r.choice(["new york city hall", "New  York\tCity", "of the", *words, f"rare{r.randrange(500)}"]))
            parts.append(r.choice([" ", " ", " ", "\t", ". ", ",", "\n", "?!", " \x0b", "\r"]))
        docs.append((r.choice(["en", "en", "en", "d\ne", None, "und", ""]), "".join(parts)))
    docs += [("en", docs[5][1])] * 3 + [("fr", "a " * 20_000), ("fr", ""), ("de", " . , ")]
    return docs


@pytest.mark.parametrize(("least", "longest", "top", "within"), [(6, 4, 40, 80), (3, 5, 5, 50), (2, 2, 1000, 80), (30, 3, 7, 100)])
def test_collocations(spark, least, longest, top, within):
    docs = _phrase_docs()
    frame = spark.createDataFrame([(*d, i, "x", 1) for i, d in enumerate(docs)], "lang string, text string, a int, gram string, n int").repartition(3)
    found = phrases.collocations(frame, least, longest, top, within, shard_bytes=3000, bucket_bytes=9000)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(rows(found), key=repr) == sorted(_collocations(docs, least, longest, top, within), key=repr)


def test_collocations_of_odd_tables(spark):
    frame = spark.createDataFrame([("en", None), (None, "")], "lang string, text string")
    assert phrases.collocations(frame).count() == 0
    assert phrases.collocations(frame.limit(0)).count() == 0


def test_index_counts_phrases_both_ways():
    r = random.Random(3)
    for size, kinds in ((400, 5), (60, 2), (0, 2), (90, 40)):
        text = [*(r.randrange(kinds) for _ in range(size)), 0]
        for length in (1, 2, 3, 4, 5):
            index = phrases.Index(np.array(text), length)
            words, low, size_ = index.phrases(length)
            want = Counter(tuple(text[p : p + length]) for p in range(len(text) - length + 1) if 0 not in text[p : p + length])
            assert {tuple(w): n for w, n in zip(words.tolist(), size_.tolist(), strict=True) if n} == dict(want)
            for word, a, n in zip(words.tolist(), low.tolist(), size_.tolist(), strict=True):
                assert all(text[p : p + length] == word for p in index.order[a : a + n].tolist())


def test_numbers_survive_packing():
    g = np.random.default_rng(1)
    keys = g.integers(0, 1 << 31, size=(50, 3))
    assert (phrases._unpack_keys(phrases._pack_keys(keys), 3) == keys).all()
    assert phrases._unpack(phrases._pack(keys[:, 0])).tolist() == keys[:, 0].tolist()
    assert len(phrases._unpack(phrases._pack(np.zeros(0)))) == 0


def test_unused_names():
    assert names.unused(["a", "B", "b_"], "a", "b", "c", "c") == ["a_", "b__", "c", "c_"]
