import math

import pytest

from helpers_llm import AWKWARD, documents
from shardsync.llm.mixing import mix_documents, plan_mix, solve

TOKENS = {"a": 1000, "b": 100, "c": 10}


def test_repetition_limit_is_met_and_used():
    mix = solve(TOKENS, repeats=4)
    assert mix.budgets["a"] == 1000
    assert max(mix.budgets[s] / n for s, n in TOKENS.items()) == pytest.approx(4, rel=0.02)
    assert solve(TOKENS, repeats=1000).exponent == 0
    assert solve(TOKENS, repeats=1).exponent == pytest.approx(1)


def test_entropy_is_met():
    target = 0.8
    budgets = solve(TOKENS, entropy=target, budget=10**6).budgets
    shares = [b / sum(budgets.values()) for b in budgets.values()]
    assert -sum(p * math.log(p) for p in shares) == pytest.approx(target, abs=1e-4)
    assert solve(TOKENS, entropy=99).exponent == 0
    assert solve(TOKENS, entropy=0).exponent == 1


def test_sources_without_tokens():
    assert solve({"a": 0, None: 0}, repeats=2).budgets == {"a": 0, None: 0}
    assert solve({}, repeats=2).budgets == {}
    with pytest.raises(ValueError):
        solve(TOKENS)


@pytest.mark.parametrize("options", [{"repeats": 3}, {"entropy": 1.0, "budget": 900}])
def test_budgets_are_kept_and_epochs_are_whole(spark, options):
    rows = [(i, "w " * (1 + i % 5), None, f"s{min(i % 7, 3)}") for i in range(300)]
    found = plan_mix(documents(spark, rows), block_rows=10, **options).collect()
    sizes = {i: 1 + i % 5 for i in range(300)}
    for source in {r.source for r in found}:
        own = sorted((r for r in found if r.source == source), key=lambda r: r.start)
        at = 0
        whole = [r[0] for r in rows if r[3] == source]
        epochs = max(r.epoch for r in own)
        for r in own:
            assert r.n_tokens == sizes[r.doc_id]
            assert r.start == at
            at += r.n_tokens
        assert own[0].budget - 5 < at <= own[0].budget
        for e in range(epochs):
            assert sorted(r.doc_id for r in own if r.epoch == e) == whole
        order = [[r.doc_id for r in own if r.epoch == e] for e in range(2)]
        assert len(own) < 60 or order[0][:20] != order[1][:20]


def test_documents_come_as_often_as_planned(spark):
    rows = [(i, "w w", "en", "a" if i < 90 else None) for i in range(100)]
    docs = documents(spark, rows, extra=True)
    found = mix_documents(docs, repeats=2)
    assert found.columns == docs.columns
    counts = {r.source: r["count"] for r in found.groupBy("source").count().collect()}
    assert counts == {"a": 90, None: 20}


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD, extra=True)
    found = [r.doc_id for r in plan_mix(docs, repeats=2).collect()]
    assert sorted(map(str, found)) == sorted(str(r[0]) for r in AWKWARD)
    assert plan_mix(docs.limit(0), repeats=2).count() == 0
