"""Operators on texts against plain Python, on small tables with every awkward row."""

import random

import pytest
from pyspark.sql import functions as F

from parcelworks.llm import bpe, decontamination, minhash_dedup, quality, queries, substring_dedup, suffix_dedup, token_counts, toxicity
from tests.conftest import rows
from tests.llm import plain

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


def _documents() -> list[tuple]:
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeéü") for _ in range(r.randint(1, 6))) for _ in range(300)]
    base = [" ".join(r.choice(vocabulary) for _ in range(r.randint(20, 120))) for _ in range(12)]
    shared = " ".join(r.choice(vocabulary) for _ in range(60))
    texts: list[str | None] = [*base, None, "", "   \n\t ", "one", "One", "two words"]
    texts += [base[0], base[0], base[1].upper(), base[2] + " tail", "\n".join([shared, base[3]])]
    for k in range(14):  # near copies of one text and a passage in many
        w = base[4].split()
        for _ in range(k % 4):
            w[r.randrange(len(w))] = "changed" + str(r.randint(0, 9))
        texts += [" ".join(w), base[5 + k % 3] + "  " + shared + " " + str(k)]
    texts += ["ab " * 400, "ab " * 300, " ".join(r.choice(vocabulary) for _ in range(30_000)) + " " + shared]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


DOCS = _documents()
SCHEMA = "doc_id long, text string, n_words long, kept string, score string, ids string, __edits string"


def _frame(spark, docs):
    return spark.createDataFrame([(i, t, 7, "x", "y", "z", "e") for i, t in docs], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return _frame(spark, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _substring(df, **options):
    return rows(substring_dedup.remove_repeats(df, **options), "doc_id", "n_words", "n_removed", "kept_text")


@pytest.mark.parametrize("width", [13, 50])
def test_repeated_words(docs, width):
    got = _substring(docs, width=width, block_bytes=4000, bucket_bytes=2000)
    assert got == sorted(plain.cut_words(DOCS, width), key=repr)


def _alike() -> tuple[str, str]:
    """Two different words of 4,096 bytes whose sums of powers modulo 2**64 are the same."""
    bits = [bin(i).count("1") % 2 for i in range(4096)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_long_words_are_not_mixed_up(spark):
    one, other = _alike()
    rest = " ".join(f"w{i}" for i in range(12))
    frame = _frame(spark, [(1, f"{one} {rest}"), (2, f"{other} {rest}")])
    assert [r[2] for r in _substring(frame)] == [0, 0]
    near = minhash_dedup.near_duplicates(_frame(spark, [(1, f"{one} a"), (2, f"{other} a")]), shingle=2)
    assert rows(near, "doc_id", "component_id", "kept") == [(1, 1, True), (2, 2, True)]
    items = spark.createDataFrame([(7, one)], "item_id long, text string")
    found = decontamination.find_contamination(_frame(spark, [(1, one), (2, other)]), items)
    assert rows(found, "doc_id", "n_hit", "contaminated") == [(1, 1, True), (2, 0, False)]


def test_repeated_words_keep_other_columns_and_ids_may_repeat(spark, empty):
    text = " ".join(f"w{i}" for i in range(20))
    repeated = [(5, text), (5, text), (5, "a " + text), (7, text), (None, text), (None, text)]
    got = _substring(_frame(spark, repeated))
    assert got == sorted(plain.cut_words(repeated, 13), key=repr)
    found = substring_dedup.remove_repeats(empty)
    assert found.count() == 0
    assert found.columns[:2] == ["doc_id", "text"] and "score" in found.columns


def test_doubling_goes_on_until_no_candidate_survives(spark):
    words = [f"w{i}" for i in range(300)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:120]) + " other"), (3, " ".join(f"v{i}" for i in range(40)))]
    found = substring_dedup.remove_repeats(_frame(spark, docs), width=13, until=0)
    # 13, 26, 52 and 104 words repeat; 208 do not.
    assert rows(found, "doc_id", "longest_repeat") == [(1, 104), (2, 104), (3, 0)]
    assert rows(found, "doc_id", "n_removed") == [(1, 0), (2, 120), (3, 0)]


def _longest(docs: list[tuple[int, str]], width: int) -> list[tuple[int, int]]:
    """The greatest of ``width``, twice, four times .. words that also stand under another id, one window at a time."""
    out = {i: 0 for i, _ in docs}
    size = width
    while True:
        held: dict[tuple, set[int]] = {}
        for i, text in docs:
            words = text.split()
            for p in range(len(words) - size + 1):
                held.setdefault(tuple(words[p : p + size]), set()).add(i)
        shared = {i for ids in held.values() if len(ids) > 1 for i in ids}
        if not shared:
            return sorted(out.items(), key=repr)
        out |= dict.fromkeys(shared, size)
        size *= 2


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 1500, "bucket_bytes": 300}])
def test_doubling_finds_the_longest_repeats(spark, sizes):
    r = random.Random(5)
    pool = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(40):
        # Passages of one long text, parts of them twice, periods, and words of the document's own.
        words = []
        for _ in range(r.randint(1, 4)):
            a = r.randrange(380)
            words += pool[a : a + r.choice([5, 13, 25, 26, 40, 60, 110, 220])] + [f"own{i}_{len(words)}"] * r.randint(0, 3)
        docs.append((i, " ".join(words + ["x"] * r.choice([0, 0, 30]))))
    found = substring_dedup.remove_repeats(_frame(spark, docs), width=13, until=0, **sizes)
    want = _longest(docs, 13)
    assert {n for _, n in want} >= {26, 52, 104}
    assert rows(found, "doc_id", "longest_repeat") == want
    assert rows(found, "doc_id", "n_words", "n_removed", "kept_text") == sorted(plain.cut_words(docs, 13), key=repr)
    some = substring_dedup.remove_repeats(_frame(spark, docs), width=13, until=60, **sizes)
    assert rows(some, "doc_id", "longest_repeat") == [(i, min(n, 52)) for i, n in want]


def test_the_query_doubles_until_no_candidate_survives(spark, tmp_path, monkeypatch):
    words = [f"w{i}" for i in range(120)]
    _frame(spark, [(1, " ".join(words)), (2, "other " + " ".join(words))]).write.parquet(str(tmp_path / "documents.parquet"))
    made, remove = [], substring_dedup.remove_repeats
    monkeypatch.setattr(substring_dedup, "remove_repeats", lambda *a, **k: made.append(remove(*a, **k)) or made[-1])
    found = queries.op3_substring_dedup(spark, str(tmp_path))
    assert rows(found, "doc_id", "n_removed") == [(1, 0), (2, 120)]
    assert rows(made[0], "doc_id", "longest_repeat") == [(1, 104), (2, 104)]


def test_repeated_bytes(spark, docs, empty):
    for table, frame in ((DOCS, docs), ([(4, "é" * 60), (4, "é" * 60), (9, "xé" + "é" * 40), (None, "é" * 30)], None)):
        frame = _frame(spark, table) if frame is None else frame
        found = suffix_dedup.remove_repeated_bytes(frame, block_bytes=4000, bucket_bytes=2000)
        got = rows(found.select("doc_id", "n_bytes", "n_removed", F.size("removed_spans"), "kept_bytes"))
        got = [(*r[:4], bytes(r[4])) for r in got]
        assert sorted(got, key=repr) == sorted(plain.cut_bytes(table, 50), key=repr)
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0


def test_loser_tree_merges_and_never_forgets_prefixes():
    r = random.Random(2)
    lists = [sorted({bytes(r.choice(b"ab") for _ in range(12)) for _ in range(r.randint(0, 60))}) for _ in range(7)]
    runs = []
    for strings in lists:
        matrix = suffix_dedup.np.frombuffer(b"".join(strings), dtype="uint8").reshape(-1, 12)
        same, rest = suffix_dedup._front_code(matrix)
        runs.append(suffix_dedup._Run(same.tobytes(), rest, 12))
    got = [(runs[k].texts[at], n) for k, at, n in suffix_dedup.merge_runs(runs, 12)]
    merged = sorted(s for strings in lists for s in strings)
    assert [s for s, _ in got] == merged
    for (a, _), (b, n) in zip(got, got[1:], strict=False):
        shared = next((i for i in range(12) if a[i] != b[i]), 12)
        assert n == shared


@pytest.mark.parametrize(("size", "block_rows"), [(2, 8192), (5, 8192), (2, 5)])
def test_near_copies(docs, size, block_rows):
    got = rows(minhash_dedup.near_duplicates(docs, shingle=size, block_rows=block_rows), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(plain.near_copies(DOCS, size, 80), key=repr)


def test_a_text_brings_its_copies_together(spark):
    """Copies that are alike through the text they were made of alone, and two groups that nearly are."""
    r = random.Random(12)
    table = []
    for base in range(2):
        words = [f"b{base}w{i}" for i in range(120)]
        table.append(words)
        for _ in range(40):
            copy = list(words)
            for at in r.sample(range(120), 5):
                copy[at] = f"x{r.randrange(10**6)}"
            table.append(copy)
    docs = [(1000 - i, " ".join(w)) for i, w in enumerate(table)]
    got = rows(minhash_dedup.near_duplicates(_frame(spark, docs), shingle=2, block_rows=20), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(plain.near_copies(docs, 2, 80), key=repr)
    assert len({c for _, _, c, _ in got}) == 2


def test_near_copies_of_odd_tables(spark, empty):
    found = minhash_dedup.near_duplicates(empty)
    assert found.count() == 0 and "kept" in found.columns
    odd = _frame(spark, [(None, "a b c"), (4, "a b c"), (4, "a b c"), (6, "A  b\nC"), (8, None)])
    got = rows(minhash_dedup.near_duplicates(odd, shingle=2), "doc_id", "n_shingles", "component_id", "kept")
    want = [(4, 2, 4, True), (4, 2, 4, True), (6, 2, 4, False), (8, 0, 8, True), (None, None, None, True)]
    assert got == sorted(want, key=repr)


def test_near_copies_at_low_percentages(spark):
    r = random.Random(8)
    docs = []
    for k in range(12):
        w = [f"{r.choice('abcdefgh')}{k}x{i}" for i in range(260)]
        docs += [(10 * k + 1, " ".join(w)), (10 * k + 2, " ".join(w[: 100 + 2 * k]))]
    for percent in (40, 48):
        found = minhash_dedup.near_duplicates(_frame(spark, docs), shingle=1, percent=percent)
        assert rows(found, "doc_id", "n_shingles", "component_id", "kept") == sorted(plain.near_copies(docs, 1, percent), key=repr)
    assert minhash_dedup.matches_for(80) == 34
    with pytest.raises(ValueError, match="too few"):
        minhash_dedup.near_duplicates(_frame(spark, docs), percent=10)


def _items() -> list[tuple]:
    passage = plain.ALNUM.findall(plain.lower(DOCS[3][1]))
    return [
        (1, " ".join(passage[:20])),
        (2, "-".join(passage[4:30]).upper()),
        (3, "two, words"),
        (4, None),
        (5, " .. "),
        (None, DOCS[4][1]),
        (1, DOCS[5][1]),
        (10, "ab " * 20),
    ]


@pytest.mark.parametrize("item_bytes", [1 << 20, 150])
def test_contamination(spark, docs, item_bytes):
    items = spark.createDataFrame(_items(), "item_id long, text string")
    found = decontamination.find_contamination(docs, items, item_block_bytes=item_bytes, batch_bytes=3000)
    got = rows(found, "doc_id", "n_words", "n_hit", "items", "contaminated")
    assert got == sorted(plain.contamination(DOCS, _items(), 13, 20), key=repr)
    assert {"n_items", "kept", "score"} <= set(found.columns)


def test_contamination_of_empty_tables(spark, docs, empty):
    items = spark.createDataFrame(_items(), "item_id long, text string")
    assert decontamination.find_contamination(empty, items).count() == 0
    clean = decontamination.find_contamination(docs, items.limit(0))
    assert clean.where("n_hit > 0 or contaminated").count() == 0 and clean.count() == len(DOCS)


def test_bpe_like_the_library(spark, empty):
    r = random.Random(3)
    bits = ["a", "the", " ", "  ", "\n", "é", "日本", "🙂", "'ll", "12", "<|endoftext|>", "<|endof", "|>", "!!", "\x00", "x" * 90]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 40))) for _ in range(400)] + [t for _, t in DOCS]
    frame = _frame(spark, list(enumerate(texts)))
    coded = bpe.decode(bpe.encode(frame, PATH, batch_bytes=2000), PATH)
    tool = tokenizers.Tokenizer.from_file(PATH)
    want = {}
    for i, t in enumerate(texts):
        ids = tool.encode(t or "", add_special_tokens=False).ids
        want[i] = (ids, tool.decode(ids, skip_special_tokens=False))
    got = {x["doc_id"]: (x["ids"], x["decoded"]) for x in coded.collect()}
    assert got == want
    assert bpe.encode(empty, PATH).count() == 0


def test_decoding_of_odd_ids(spark):
    frame = spark.createDataFrame([(1, None), (2, []), (3, [50256, None, 64]), (4, [160])], "k long, ids array<int>")
    tool = tokenizers.Tokenizer.from_file(PATH)
    got = {x["k"]: x["decoded"] for x in bpe.decode(frame, PATH).collect()}
    assert got == {1: "", 2: "", 3: "<|endoftext|>a", 4: tool.decode([160])}


def _labelled(spark, bad, n=400):
    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        w = [r.choice(vocabulary) for _ in range(r.randint(30, 90))]
        docs.append((i, bad(r, w) if i % 4 == 0 else " ".join(w)))
        labels.append((i, int(i % 4 == 0), int(i % 4 != 0)))
    labels += [(None, 1, 1), (3, None, None), (5, 9, 9)]
    return _frame(spark, [*docs, (-1, None), (-2, ""), (-3, None)]), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def _accuracy(scored, label):
    held = scored.where("doc_id >= 0 and doc_id % 5 = 0")
    return held.where(label).count() / held.count()


def test_toxicity_on_held_out_rows(spark, empty):
    def bad(r, w):
        for _ in range(4):
            w[r.randrange(len(w))] = r.choice(["zmorkish", "quazzle"])
        return " ".join(w)

    docs, labels = _labelled(spark, bad)
    model = toxicity.train(docs, labels.where("doc_id % 5 != 0"))
    scored = toxicity.score(docs, model)
    assert _accuracy(scored, "(score >= 0.3) = (doc_id % 4 = 0)") > 0.97
    assert scored.where("doc_id < 0").select("score").distinct().count() == 1
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    alone = toxicity.train(docs, labels.where("toxic = 0"))
    assert toxicity.score(docs, alone).where("score > 0.01").count() == 0
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.train(empty, labels.limit(0)).bias == 0


def test_toxicity_of_a_minority_beside_many_frequent_words(spark):
    r = random.Random(4)
    word = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    plain_words, bad_words = [word("abcdefgh", 6) for _ in range(300)], [word("mnopqrst", 9) for _ in range(400)]
    rare_words = [word("ijklwxyz", 6) for _ in range(300)]
    docs, labels = [], []
    for i in range(900):
        toxic, minority = i % 4 == 0, i % 10 == 3 or i % 60 == 4
        w = [r.choice(rare_words if minority else plain_words) for _ in range(50)]
        if toxic and minority:
            w[10:12] = ["vuvvuuv"] * 2
        elif toxic:
            w[20:40] = [r.choice(bad_words) for _ in range(20)]
        docs.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    model = toxicity.train(_frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int").where("doc_id < 700"))
    assert (model.weights != 0).sum() > 1 << 12
    scored = toxicity.score(_frame(spark, docs), model).where("doc_id >= 700 and (doc_id % 10 = 3 or doc_id % 60 = 4)")
    got = [(x["doc_id"] % 4 == 0, x["score"]) for x in scored.collect()]
    assert min(s for bad, s in got if bad) > max(0.3, *(s for bad, s in got if not bad))


def test_quality_on_held_out_rows(spark, empty):
    docs, labels = _labelled(spark, lambda r, w: " | ".join(x.upper() + "!!" for x in w))
    scored = quality.fit_and_score(docs, labels.where("doc_id % 5 != 0"))
    assert _accuracy(scored, "(score >= 0.3) = (doc_id % 4 != 0)") > 0.97
    assert scored.where("doc_id < 0").select("score").distinct().count() == 1
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    assert quality.fit_and_score(empty, labels).count() == 0
    flat = quality.fit_and_score(docs, labels.where("quality = 1 and doc_id % 5 != 0"))
    assert flat.select("score").distinct().count() == 1


def test_helper_columns_do_not_clash(spark):
    text = " ".join(f"w{i}" for i in range(20))
    names = ["__part", "__doc", "__mark", "__text", "__id", "__edits", "features", "__row", "__node", "hit_spans"]
    table = [(1, text, *["x"] * len(names)), (2, text, *["y"] * len(names))]
    frame = spark.createDataFrame(table, ["doc_id", "text", *names])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    edits = spark.createDataFrame([(1, 0, 0, 1, "z")], "doc_id long, step int, start int, end int, new string")
    items = spark.createDataFrame([(7, text)], "item_id long, text string")
    for done, lost in (
        (substring_dedup.remove_repeats(frame), ()),
        (suffix_dedup.remove_repeated_bytes(frame), ()),
        (minhash_dedup.near_duplicates(frame), ()),
        (decontamination.find_contamination(frame, items, item_block_bytes=1), ("hit_spans",)),
        (quality.fit_and_score(frame, labels), ("text",)),
        (token_counts.count_edited(frame, edits, PATH), ("text",)),
    ):
        assert rows(done.select(*[n for n in names if n not in lost])) == [tuple("x" for n in names if n not in lost), tuple("y" for n in names if n not in lost)]


def test_rows_without_an_id_spread_over_blocks(spark):
    from parcelworks.llm import blocks

    frame = spark.createDataFrame([(None, f"text {i}") for i in range(500)], "doc_id long, text string")
    assert blocks.in_blocks(frame, 20, "doc_id", "text").select(blocks.PART).distinct().count() == 20


def _brute_statistics(rows_, model):
    """Scores by the densities written out: no Cholesky factors, one row at a time."""
    import numpy as np

    out = []
    for x in rows_:
        logs = []
        for mean, factor, offset in zip(model.means, model.factors, model.offsets, strict=True):
            cov = np.linalg.inv(factor.T @ factor)
            gap = x - mean
            prior = offset + 0.5 * np.log(np.linalg.det(cov))
            logs.append(prior - 0.5 * np.log(np.linalg.det(cov)) - 0.5 * gap @ np.linalg.solve(cov, gap))
        out.append(1 / (1 + np.exp(logs[0] - logs[1])))
    return out


def test_quality_by_densities_written_out(spark):
    import numpy as np

    r = random.Random(3)
    texts = [" ".join(r.choice(["good", "word", "x1", "?!", "Long"]) for _ in range(r.randint(3, 40))) + ("." * (i % 2) * 9) for i in range(120)]
    texts += ["", "y " * 60_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    measured = quality.features(frame)
    model = quality.train(measured, labels)
    # The fit: moments of the labelled rows, shrunk as the docstring says.
    seen = {x["doc_id"]: np.rint(np.array(x["features"]) * 1024) / 1024 for x in measured.collect()}
    groups = [np.array([seen[i] for i in range(80) if i % 2 == k]) for k in (0, 1)]
    for k in (0, 1):
        assert np.allclose(model.means[k], groups[k].mean(axis=0))
    spread = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(len(g) * s for g, s in zip(groups, spread, strict=True)) / 80
    for k in (0, 1):
        cov = 0.9 * spread[k] + 0.1 * pooled
        cov = 0.98 * cov + 0.02 * np.diag(np.diag(cov)) + 1e-6 * np.diag(np.diag(pooled) + 1e-6)
        assert np.allclose(np.linalg.inv(model.factors[k].T @ model.factors[k]), cov, rtol=1e-4, atol=1e-8)
    got = {x["doc_id"]: x["score"] for x in quality.score(measured, model).collect()}
    raw = [np.array(x["features"]) for x in measured.orderBy("doc_id").collect()]
    assert np.allclose([got[i] for i in sorted(got)], _brute_statistics(raw, model), atol=1e-6)
    again = quality.train(measured.repartition(7), labels)
    assert (again.means == model.means).all() and (again.factors == model.factors).all()
