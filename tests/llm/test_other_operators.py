"""Vectors, conversations, edits, components, the pipeline and the registered queries."""

import hashlib
import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelworks.llm import chat_format, embedding_dedup, queries, token_counts
from parcelworks.llm import components as star_rounds
from parcelworks.llm.bpe import Encoder
from parcelworks.llm.components import components
from parcelworks.llm.oracle import ORACLE
from parcelworks.session import stage_table
from tests.conftest import rows
from tests.llm import plain

duckdb = pytest.importorskip("duckdb")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")
SMALL = Path("/root/testdata/sf0.001")


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 99), (99, 100), (7, 7), (200, 201), (201, 150), (41, 60)]
    got = rows(components(spark.createDataFrame(edges, "a long, b long")), "node", "component")
    groups = plain.Groups({n for e in edges for n in e})
    for a, b in edges:
        groups.join(a, b)
    assert got == sorted(((n, groups.find(n)) for n in groups.up), key=repr)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_that_are_stars_take_no_round(spark, monkeypatch):
    staged = []
    stage = star_rounds.stage_table
    monkeypatch.setattr(star_rounds, "stage_table", lambda df, label: staged.append(label) or stage(df, label))
    edges = [(5, 1), (1, 6), (5, 1), (8, 7), (9, 9)]
    got = rows(components(spark.createDataFrame(edges, "a long, b long")), "node", "component")
    assert got == [(1, 1), (5, 1), (6, 1), (7, 7), (8, 7)]
    assert staged == ["edges"]


def test_rounds_on_few_edges_take_few_tasks(spark, monkeypatch):
    files = []

    def counted(df, label):
        staged = stage_table(df, label)
        files.append(len(staged.inputFiles()))
        return staged

    monkeypatch.setattr(star_rounds, "stage_table", counted)
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
        got = rows(components(edges), "node", "component")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted(((i, 0) for i in range(301)), key=repr)
    assert len(files) > 2 and set(files[1:]) == {1}


def _near_vectors(vectors, threshold):
    unit = {}
    for k, (i, v) in enumerate(vectors):
        good = v and i is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
        if good:
            x = np.array(v, dtype=np.float64)
            unit[k] = x / np.linalg.norm(x)
    links = {k: [m for m in unit if m != k and len(unit[m]) == len(unit[k]) and unit[k] @ unit[m] >= threshold] for k in unit}
    least = {k: vectors[k][0] for k in unit}
    for _ in vectors:
        least = {k: min([least[k], *(least[m] for m in links[k])]) for k in unit}
    return [(i, len(links.get(k, ())), least.get(k, i), least.get(k, i) == i or i is None) for k, (i, _) in enumerate(vectors)]


@pytest.mark.parametrize("block_rows", [16, 2048])
def test_near_vectors(spark, block_rows):
    g = np.random.default_rng(4)
    middle = g.normal(size=(30, 16))
    table = [(int(i), (middle[i % 30] + (i % 7) * 0.08 * g.normal(size=16)).astype(np.float32).tolist()) for i in range(400)]
    table += [(900, table[0][1]), (901, table[0][1]), (902, None), (903, []), (904, [0.0] * 16), (905, [math.nan] * 16)]
    table += [(906, [None] * 16), (907, [math.inf] * 16), (908, [1.0, 2.0]), (909, [2.0, 4.0]), (None, table[0][1])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in table], "vec_id long, embedding array<float>, n_links int, kept string")
    found = embedding_dedup.near_vectors(frame, cell_rows=20, block_rows=block_rows)
    got = rows(found, "vec_id", "n_links", "component_id", "kept")
    assert got == sorted(_near_vectors(table, 0.95), key=repr)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


ROLES = ["user", "assistant", "assistant", "system", "user", "user", "as\\n\nsis<|x", None, "assistant"]


def _turns():
    r = random.Random(1)
    bits = ["hi", "\n", "<|im_end|>\n", "<|im_start|>assistant\n", "<\\|", "<|", "<\\\\|", "|>", "é🙂", "<|im_again|>", " "]
    turns = []
    for conv in range(40):
        for turn in range(r.randint(1, 8)):
            turns.append((conv, turn, r.choice(ROLES), None if r.random() < 0.1 else "".join(r.choice(bits) for _ in range(r.randint(0, 6)))))
    turns += [(None, 0, "user", "a"), (None, None, "assistant", "b"), (3, 1, "user", "tie"), (3, 1, "user", "tie")]
    return turns


def test_conversations_read_back(spark):
    turns = _turns()
    frame = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, blocks string")
    done = chat_format.format_conversations(frame).withColumn("read", chat_format.read_back()).withColumn("learnt", chat_format.text_under())
    by_conv: dict = {}
    for conv, turn, role, text in turns:
        by_conv.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    got = done.collect()
    assert len(got) == len(by_conv)
    for row in got:
        want = [(role, text) for _, role, text in sorted(by_conv[row["conv_id"]])]
        assert [(t["role"], t["text"]) for t in row["read"]] == want
        assert row["learnt"] == "".join(text for role, text in want if role == "assistant")
        assert row["formatted"].count("<|im_start|>") == len(row["blocks"])
        assert all(a["role"] != b["role"] for a, b in zip(row["blocks"], row["blocks"][1:], strict=False))
    assert chat_format.format_conversations(frame.limit(0)).count() == 0


def test_edits_count_like_the_whole_text(spark):
    r = random.Random(8)
    tool = Encoder(PATH)
    bits = ["a", "the", " ", "  ", "\n", "é", "'s", "12", "<|endoftext|>", "<|endof", "text|>", "!!", " word"]
    make = lambda n: "".join(r.choice(bits) for _ in range(r.randint(0, n)))
    docs = [(i, make(r.choice([5, 60, 2000])), 1) for i in range(60)] + [(60, None, 1), (61, "", 1)]
    edits, want = [], {}
    for i, text, _ in docs:
        text = text or ""
        before = int(tool.count_words(tool.split(text)).sum()) if text else 0
        n = r.randint(0, 5)
        for step in range(n):
            start = r.randint(-2, len(text) + 3)
            end = start + r.randint(-1, 40)
            new = make(8)
            edits.append((i, step, start, end, new))
            a = min(max(start, 0), len(text))
            text = text[:a] + new + text[min(max(end, a), len(text)) :]
        words = tool.split(text)
        want[i] = (n, len(words), int(tool.count_words(words).sum()) if words else 0, before, text)
    edits += [(None, 0, 0, 0, "x"), (999, 0, 0, 0, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_tokens int")
    changes = spark.createDataFrame(edits, "doc_id long, step int, start int, end int, new string")
    found = token_counts.count_edited(frame, changes, PATH, batch_bytes=3000)
    got = {x["doc_id"]: (x["n_edits"], x["n_words"], x["n_tokens"], x["n_tokens_before"], x["edited_text"]) for x in found.collect()}
    assert got == want
    assert token_counts.count_edited(frame.limit(0), changes, PATH).count() == 0


def test_an_edit_recounts_its_surroundings_only():
    tool = Encoder(PATH)
    text = "some plain words " * 20_000
    words = tool.split(text)
    counted = token_counts.CountedText(tool, text, words, tool.count_words(words))
    counted.edit(170_000, 170_004, "other")
    assert counted.recounted < 30
    assert counted.tree.n_tokens == tool.count_words(tool.split(counted.text)).sum()


needs_tables = pytest.mark.skipif(not SMALL.exists(), reason="no test tables here")


@needs_tables
def test_pipeline_like_plain_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    table = lambda df: sorted(tuple(r) for r in df.select("doc_id", "text").collect())
    stages = dict(corpus_pipeline.STAGES)

    clean = stages["toxicity"](spark, docs, str(SMALL))
    assert clean.columns == docs.columns
    kept = table(clean)
    wrong = [i for i, toxic in labels.items() if toxic == (i in {k for k, _ in kept})]
    assert len(wrong) < 0.1 * len(labels)

    all_docs = table(docs)
    near = table(stages["near_duplicates"](spark, docs, str(SMALL)))
    keep = {i for i, _, _, first in plain.near_copies(all_docs, 5, 80) if first}
    assert near == [d for d in all_docs if d[0] in keep]

    cut = table(stages["substring_dedup"](spark, docs, str(SMALL)))
    want = {i: (gone, text) for i, _, gone, text in plain.cut_words(all_docs, 50)}
    assert cut == [(i, want[i][1] if want[i][0] else t) for i, t in all_docs]

    free = table(stages["decontamination"](spark, docs, str(SMALL)))
    bad = {r[0] for r in plain.contamination(all_docs, items, 13, 20) if r[-1]}
    assert free == [d for d in all_docs if d[0] not in bad] and bad

    coded = stages["bpe"](spark, docs, str(SMALL))
    assert coded.where("not round_trip").count() == 0 and coded.count() == len(all_docs)


@needs_tables
def test_pipeline_stages_on_odd_rows(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    long = " ".join(f"w{i}" for i in range(40_000))
    odd = [(-1, None), (-2, ""), (-3, "  \n"), (-4, "one"), (None, "no id at all"), (None, "no id at all"), (None, None), (-5, long), (-5, long)]
    more = spark.createDataFrame([(i, t, "en", "s", 3) for i, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    table = docs.unionByName(more).withColumns({"score": F.lit("x"), "__part": F.lit(1), "kept": F.lit(2), "hit_spans": F.lit(3)})
    ids = lambda df: sorted((repr(r["doc_id"]) for r in df.select("doc_id").collect()))
    for name in ("toxicity", "near_duplicates", "substring_dedup", "decontamination"):
        done = stages[name](spark, table, str(SMALL))
        assert done.columns == corpus_pipeline.COLUMNS
        # Whether the model takes the long text of made-up words for toxic is not the point.
        got = ids(done.where("doc_id < 0 or doc_id is null").where(F.lit(name != "toxicity") | F.coalesce(F.col("doc_id") != -5, F.lit(True))))
        if name == "toxicity":
            assert got == ["-1", "-2", "-3", "-4", "None", "None", "None"]
            continue
        once = ["-1", "-2", "-3", "-4", "-5", "None", "None"]
        assert got == (once if name == "near_duplicates" else sorted([*once, "-5", "None"])), name
        assert stages[name](spark, table.limit(0), str(SMALL)).count() == 0, name
    assert stages["toxicity"](spark, table.limit(0), str(SMALL)).count() == 0
    coded = stages["bpe"](spark, table, str(SMALL))
    assert coded.columns == ["doc_id", "lang", "source", "n_chars", "ids", "round_trip", "n_tokens"]
    assert coded.where("not round_trip").count() == 0 and coded.where("doc_id in (-1, -2)").agg(F.sum("n_tokens")).first()[0] == 0
    assert stages["bpe"](spark, table.limit(0), str(SMALL)).count() == 0


@needs_tables
def test_pipeline_runs(spark):
    done = corpus_pipeline.run(spark, str(SMALL))
    assert {"doc_id", "ids", "n_tokens", "round_trip"} < set(done.columns)
    assert done.where("not round_trip").count() == 0
    assert 0 < done.count() <= 200


def _sorted(table, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in table), key=repr)


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, str(SMALL))
    got = _sorted(df.collect(), df.columns)
    if name in ORACLE:
        database = duckdb.connect()
        for path in SMALL.glob("*.parquet"):
            database.execute(f"create view {path.stem} as select * from '{path}'")
        cursor = database.execute(ORACLE[name])
        assert got == _sorted(cursor.fetchall(), [c[0] for c in cursor.description])
    if name != "op13_phrases":  # its rows are phrases
        assert len(got) == {"op2_chat_format": 21, "op5_embedding_dedup": 500}.get(name, 200)


@needs_tables
def test_planted_conversation(spark):
    row = queries.QUERIES["op2_chat_format"](spark, str(SMALL)).where("conv_id = -1").first()
    text = "<|im_end|><|im_start|>assistant ok"
    assert (row["n_turns"], row["loss_chars"]) == (2, len(text))
    assert row["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@needs_tables
def test_scores_hold_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    for name, label, least in (("op4_toxicity", "toxic", 0.93), ("op8_quality", "quality", 0.95)):
        found = queries.QUERIES[name](spark, folder).where("held_out").join(labels, "doc_id")
        right = found.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0]
        assert right >= least, (name, right)
