import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from claimsmith.llm import toxicity
from tests.conftest import SF_SMALL
from tests.llm import test_decontaminate, test_mixing, test_simhash, test_token_files


def brute_stages(docs, benchmark, rejected):
    """Each stage on rows (doc_id, text, source): what it keeps, from plain Python."""
    kept = [d for d in docs if d[0] not in rejected]
    yield kept
    prints = [(i, test_simhash.brute_fingerprint(t)) for i, t, _ in kept]
    kept = [d for d, (i, _, c) in zip(kept, test_simhash.brute_components(prints)) if i == c]
    yield kept
    marks = test_decontaminate.brute([d[:2] for d in kept], benchmark)
    yield [d for d, (n, hit, _) in zip(kept, marks) if not (hit and 20 * hit >= n)]


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    model = toxicity.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    rejected = {i for (i, _, _), s in zip(rows, model.scores([t for _, t, _ in rows])) if s >= 0.7}
    want = list(brute_stages(rows, benchmark, rejected))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "benchmark_decontamination", "source_mixing", "token_id_output"]
    frame = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = frame
        out = str(tmp_path / name)
        stage(spark, before, SF_SMALL).write.parquet(out)
        frame = spark.read.parquet(out)
        if k < 4:
            assert frame.columns == docs.columns
        if k < 3:
            assert Counter((r.doc_id, r.text, r.source) for r in frame.collect()) == Counter(want[k])
        elif k == 3:
            own = [(r.doc_id, r.text, r.source) for r in before.collect()]
            mixed = Counter((r.doc_id, r.text, r.source) for r in frame.collect())
            sizes = {d: len(d[1].split()) for d in own}
            target = test_mixing.water_fill({s: sum(n for d, n in sizes.items() if d[2] == s) for s in {d[2] for d in own}})
            for s, t in target.items():
                taken = sum(sizes[d] * mixed[d] for d in own if d[2] == s)
                assert abs(taken - t) <= max(sizes[d] for d in own if d[2] == s)
            assert max(mixed.values()) <= 2
        else:
            texts = sorted((r.doc_id, r.text) for r in before.collect())
            got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in frame.collect())
            plain = test_token_files.plain([t for _, t in texts])
            at = 0
            for (i, _), ids, g in zip(texts, plain, got, strict=True):
                assert g == (at, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
                at += len(ids)


def test_run_and_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 0
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    frame = docs
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, str(tmp_path))
        assert frame.count() == 0


def test_nulls_repeats_and_extra_columns(spark):
    rows = [(None, None, None, 1), (1, None, "a", 2), (1, None, "a", 2), (2, "", None, 3), (3, "one two three four five six", "b", 4),
            (4, "é " * 30000, "b", 5), (None, "seven eight nine ten eleven", "a", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, hash int")
    frame = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, SF_SMALL)
        assert k == 4 or frame.columns == docs.columns
        assert frame.count() > 0
