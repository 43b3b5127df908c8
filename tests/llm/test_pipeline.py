"""The corpus pipeline, stage by stage against plain code."""

import re
from collections import defaultdict

import corpus_pipeline
from panelflow.session import scratch_path
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_near_dedup import shingles
from tests.llm.test_tokens import check_packing


def test_stages(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before, kept = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}, {}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns
        now = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert now.items() <= before.items()
        kept[name], gone = now, set(before) - set(now)
        if name == "exact_dedup":
            groups = defaultdict(list)
            for i, t in before.items():
                groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i))
            assert set(now) == {min(g)[1] for g in groups.values()}
        if name == "near_dedup":
            sets = {i: shingles(t, 5) for i, t in before.items()}
            for i in gone:  # linked, through others perhaps, with one that stays
                assert any(j != i and len(sets[i] & sets[j]) * 100 >= 80 * len(sets[i] | sets[j]) for j in sets if sets[i] & sets[j])
            left = sorted(now)
            for a in left:
                for b in left:
                    both = len(sets[a] & sets[b]) if a < b else 0
                    assert not both or 100 * both < 80 * len(sets[a] | sets[b])
        if name == "decontamination":
            assert gone == {r[0] for r in contaminated(list(before.items()), items) if r[5]}
        before = now
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    used, least = check_packing(rows, list(before.items()), 2048)
    assert used <= least + 2
