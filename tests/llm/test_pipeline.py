"""The pipeline's stages on the smallest tables, each against its own input."""

import corpus_pipeline
from parlance.llm.linedup import within
from parlance.llm.tables import saved, table
from parlance.llm.toxicity import Matcher


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = saved(stage(spark, docs, sf), name)
        kept[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        after = {r.doc_id: r for r in kept[name]}
        if name == "toxicity":
            assert {d for d, r in before.items() if not any(Matcher().counts(r.text))} <= set(after)
            assert all(after[d] == before[d] for d in after)
        if name == "line_dedup":
            lines = [x.strip() for r in after.values() for x in r.text.split("\n") if len(x.strip()) >= 20]
            assert len(lines) == len(set(lines))
            by_size = {}
            for x in lines:
                by_size.setdefault(len(x), []).append(x)
            assert not [1 for n, xs in by_size.items() for a in xs for m in range(n, n + 3) for b in by_size.get(m, ())
                        if a < b and within(a, b, 2) and m == n]
        if name == "simhash_neardup":
            assert set(after) <= set(before)
        if name == "mixing":
            assert max(sum(r.doc_id == d for r in kept[name]) for d in list(after)[:20]) <= 2
    assert kept["packing"]
    assert corpus_pipeline.run(spark, sf).count() == len(kept["packing"])
