"""The pipeline's stages against brute force, each on its own input, over small tables with planted rows."""

import re

import numpy as np
import pytest

import corpus_pipeline
from folkmoot.llm import common, packing, quality

from .test_lines import expected

SOURCE = "/root/testdata/sf0.001"
PASSAGE = " ".join(f"passage{i} holds{i % 7}" for i in range(40))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet")
    item = spark.read.parquet(f"{SOURCE}/benchmark.parquet").first().text
    words = [f"plain{i} text{i % 13}" for i in range(60)]
    planted = [
        (900_001, "First own words of this one.\n" + PASSAGE),
        (900_002, "Second own words of that one.\n" + PASSAGE),
        (900_003, " ".join(words)),
        (900_004, " ".join([*words[:30], "edited", *words[31:]])),
        (900_005, "Before it. " + item + " After it."),
        (900_006, None),
        (900_007, ""),
    ]
    more = spark.createDataFrame([(i, t, "en", "planted", len(t or "")) for i, t in planted], docs.schema)
    docs.unionByName(more).repartition(4).write.parquet(f"{folder}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SOURCE}/{t}.parquet").write.parquet(f"{folder}/{t}.parquet")
    return folder


@pytest.fixture(scope="module")
def stages(spark, tables):
    """Each stage's input and result, as rows."""
    docs, out = spark.read.parquet(f"{tables}/documents.parquet"), []
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        result = f(spark, docs, tables)
        if k < 4:
            assert result.columns == docs.columns and result.schema.simpleString() == docs.schema.simpleString()
        path = f"{tables}/stage{k}"
        result.write.parquet(path)
        out.append((docs.collect(), spark.read.parquet(path).collect()))
        docs = spark.read.parquet(path)
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"]


def test_quality(spark, tables, stages):
    model = quality.train(spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet"))
    before, after = stages[0]
    good = {r.doc_id for r in before if model.score(quality.features(r.text)[None])[0] >= quality.THRESHOLD}
    assert {r.doc_id for r in after} == good and {900_001, 900_003, 900_005} <= good


def test_lines(stages):
    before, after = stages[1]
    order = sorted(before, key=lambda r: r.doc_id)
    want = dict(zip((r.doc_id for r in order), expected([r.text for r in order])))
    assert {r.doc_id: r.text for r in after} == want
    assert all(r.n_chars == len(r.text) for r in after if r.text is not None)
    assert PASSAGE in want[900_001] and PASSAGE not in want[900_002]


def test_near_duplicates(stages):
    """By the exact similarity of all pairs; sampled tables may miss a few in a hundred."""
    before, after = stages[2]
    rows = sorted(before, key=lambda r: r.doc_id)

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(r.text) for r in rows]
    near = np.array([[(a == b) if not a or not b else 5 * len(a & b) >= 4 * len(a | b) for b in sets] for a in sets])
    label = np.arange(len(rows))
    for _ in rows:
        label = np.array([label[n].min() for n in near])
    kept, want = {r.doc_id for r in after}, {rows[i].doc_id for i in set(label.tolist())}
    assert want <= kept and len(kept - want) <= 0.02 * len(rows)
    assert 900_003 in kept and 900_004 not in kept


def test_contamination(spark, tables, stages):
    before, after = stages[3]
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    wins = [w[k : k + 10] for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect() for w in [words(r.text)] if w for k in range(max(1, len(w) - 9))]
    held = {f" {' '.join(w)} " for w in wins}
    clean = {r.doc_id for r in before if not any(x in f" {' '.join(words(r.text))} " for x in held)}
    assert {r.doc_id for r in after} == clean and 900_005 not in clean


def test_packing(stages):
    before, after = stages[4]
    encode = packing.Encoder(packing.default_tokenizer())
    total = sum(len(encode(r.text or "")) // 4 + 1 for r in before)
    assert sum(r.length for r in after) == total and {r.doc_id for r in after} == {r.doc_id for r in before}
    assert len({r.sequence_id for r in after}) <= -(-total // 1024) + 1


def test_run_is_the_stages(spark, tables, stages):
    key = lambda rows: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    assert key(corpus_pipeline.run(spark, tables).collect()) == key(stages[4][1])


def test_working_tables_are_watched_and_deleted(spark):
    with common.watched() as outer:
        first = common.written(spark.range(3), "first")
        with common.watched() as inner:
            second = common.written(spark.range(4), "second")
    common.written(spark.range(5), "third")
    assert len(outer) == 2 and outer[0] is first and len(inner) == 1 and inner[0] is second
    common.discard(first)
    assert second.count() == 4
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(first._folkmoot_path)
    common.discard(spark.range(1))  # not a table of ours: nothing happens
