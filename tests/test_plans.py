"""Plan-shape guard: no registered query may plan a cartesian product or a
nested-loop join, and scans must read only the columns they use."""

import re

from tests.conftest import SF001

LEARNS_BPE = {"bpe_merges", "bpe_encode", "bpe_vocab_head", "bpe_roundtrip", "bpe_compression_ratio"}


def test_no_cartesian_or_nested_loop_joins(spark):
    from corpusmill.plans.registry import all_queries

    bad = []
    for name, q in all_queries().items():
        if name in LEARNS_BPE:  # covered by test_bpe; building them learns a model
            continue
        plan = q.build(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
            bad.append(name)
        for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
            if "documents" in plan and schema.count(":") > 4:
                bad.append(f"{name}: wide scan {schema[:80]}")
    assert not bad, bad
