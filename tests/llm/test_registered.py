"""The registered queries that SQL can't check, against the library or plain Python, at the smallest scale."""

import zlib
from collections import Counter

import numpy as np
import pytest

from parcelworks.llm import kernel, quality, queries, toxicity
from tests.llm import plain
from tests.llm.test_other_operators import PATH, SMALL, needs_tables

tokenizers = pytest.importorskip("tokenizers")
pytestmark = needs_tables


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def library():
    tool = tokenizers.Tokenizer.from_file(PATH)
    tool.no_truncation()
    tool.no_padding()
    return tool


def test_bpe_round_trip(spark, texts, library):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op10_bpe_round_trip(spark, str(SMALL)).collect()}
    want = {}
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        want[i] = (len(ids), plain.sha(",".join(map(str, ids))), plain.sha(library.decode(ids, skip_special_tokens=False)))
    assert got == want


def test_token_counts(spark, texts, library):
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    got = {r["doc_id"]: (r["n_edits"], r["n_tokens"], r["n_tokens_before"]) for r in queries.op1_token_counts(spark, str(SMALL)).collect()}
    want = {}
    for i, text in texts.items():
        n = len(text)
        edits = [
            (n // 4, n // 4 + 12, text[:12]),
            (n * 3 // 4, n * 3 // 4, text[n // 2 : n // 2 + 20]),
            (n // 2, n // 2 + 9, ""),
            (n + 100, n + 100, " " + text[:8]),
        ]
        now = text
        for start, end, new in edits:
            a, b = min(start, len(now)), min(end, len(now))
            now = now[:a] + new + now[b:]
        want[i] = (4, count(now), count(text))
    assert got == want


def _features(text: str, sizes) -> set[int]:
    """Hashed n-grams of a text, one at a time."""
    data = plain.lower(text).encode()
    out = set()
    for n in sizes:
        for gram in {data[p : p + n] for p in range(len(data) - n + 1)}:
            sums = kernel.prefix(kernel.BYTE_CODES[np.frombuffer(gram, np.uint8)])
            out.add(int(kernel.window_hash(sums, n)[0] >> np.uint64(64 - 20)))
    return out


def _fold(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def test_toxicity(spark, texts):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "toxic")
    given = {r["doc_id"]: r["toxic"] for r in labels.collect() if _fold(r["doc_id"], 4) != 2 and r["doc_id"] in texts}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    fold = spark.createDataFrame(list(given.items()), "doc_id long, toxic int")
    model = toxicity.train(docs, fold)
    some = sorted(texts, key=lambda i: len(texts[i]))[:120]  # whole texts, the shortest ones
    grams = {i: _features(texts[i], model.sizes) for i in some}
    # How many texts of each kind hold a feature.
    rows = docs.join(fold, "doc_id").where(docs["doc_id"].isin(some)).selectExpr("text", "toxic as label")
    counts = toxicity._class_counts(rows, model.sizes, 1 << 20)
    for kind in (0, 1):
        want = Counter(f for i in some if given.get(i) == kind for f in grams[i])
        assert dict(enumerate(counts[kind][np.array(sorted(want), dtype=np.int64)])) == dict(enumerate(want[f] for f in sorted(want)))
        assert counts[kind].sum() == sum(want.values())
    got = {r["doc_id"]: r for r in queries.op4_toxicity(spark, str(SMALL)).collect()}
    assert set(got) == set(texts)
    for i in some:
        score = 1 / (1 + np.exp(-(sum(model.weights[f] for f in grams[i]) + model.bias)))
        assert got[i]["score"] == pytest.approx(score, abs=1e-9)
    for i, r in got.items():
        assert (r["held_out"], r["predicted"]) == (_fold(i, 4) == 2, int(r["score"] >= 0.3)) and 0 <= r["score"] <= 1


def test_quality(spark, texts):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    given = spark.createDataFrame([tuple(r) for r in labels.collect() if _fold(r["doc_id"], 5) != 0], labels.schema)
    measured = quality.features(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"))
    model = quality.train(measured, given)
    got = {r["doc_id"]: r for r in queries.op8_quality(spark, str(SMALL)).collect()}
    assert set(got) == set(texts)
    for r in measured.collect():
        x = np.array(r["features"])
        logs = [o - 0.5 * np.sum((f @ (x - m)) ** 2) for m, f, o in zip(model.means, model.factors, model.offsets, strict=True)]
        assert got[r["doc_id"]]["score"] == pytest.approx(1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700))), abs=1e-9)
    for i, r in got.items():
        assert (r["held_out"], r["predicted"]) == (_fold(i, 5) == 0, int(r["score"] >= 0.3))
