import random
import re

import pytest

from corpusmill.llm.decontaminate import RESULT, decontaminate

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return PATTERN.findall(re.sub(r"[A-Z]", lambda m: m.group(0).lower(), t or ""))


def brute(texts, items, n=13):
    out = []
    for t in texts:
        w, hit, ids = words(t), set(), set()
        for item, it in items:
            iw = words(it)
            size = min(n, len(iw))
            for k in range(len(iw) - size + 1 if size else 0):
                for p in range(len(w) - size + 1):
                    if w[p:p + size] == iw[k:k + size]:
                        hit.update(range(p, p + size))
                        if item is not None:
                            ids.add(str(item))
        out.append((len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(3)
    vocabulary = [f"a{k}" for k in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=k))) for i, k in enumerate((1, 4, 13, 20, 40, 13))] + [(3, "Zeta, eta!"), (None, "só só só"), (9, None), (10, "..."), (11, "")]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(0, 60))) for _ in range(80)]
    for k in range(0, 80, 3):
        it = items[k % len(items)][1] or ""
        texts[k] = f"{texts[k]} ({it.upper()})! tail" if k % 2 else texts[k] + " " + " ".join(it.split()[2:17])
    texts += [None, "", "só só só", "x" * 50_000 + " " + items[2][1], " ".join(["pad"] * 4000) + " " + items[4][1]]
    rows = [(i, t, "taken", "z") for i, t in enumerate(texts)] + [(0, texts[0], "taken", "z"), (None, texts[3], None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_WORDS string, extra string")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS window", "2 AS n")
    return rows, items, docs, bench


@pytest.mark.parametrize("block", [1 << 19, 16])
def test_equals_brute_force_in_one_block_and_in_several(case, block):
    rows, items, docs, bench = case
    got = decontaminate(docs, bench, block_windows=block)
    assert got.columns == ["doc_id", "text", "extra"] + RESULT.fieldNames()
    want = [(r[0], r[1], *b) for r, b in zip(rows, brute([r[1] for r in rows], items))]
    have = [(r.doc_id, r.text, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in got.collect()]
    key = repr
    assert sorted(have, key=key) == sorted(want, key=key)
    assert all(sum(s["last"] - s["first"] + 1 for s in r.hit_spans) == r.n_hit and r.n_items == len(r.item_ids) for r in got.collect())


@pytest.mark.parametrize("block", [1 << 19, 16])
def test_documents_and_spans(case, block):
    rows, items, docs, bench = case
    bad = [b[3] for b in brute([r[1] for r in rows], items)]
    kept = decontaminate(docs, bench, mode="documents", block_windows=block)
    assert kept.schema.fieldNames() == docs.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(repr(r) for r, x in zip(rows, bad) if not x)
    cut = {r.doc_id: r.text for r in decontaminate(docs, bench, mode="spans", block_windows=block).collect() if r.doc_id is not None}
    for r, x in zip(rows, bad):
        if r[0] is not None:
            assert (cut[r[0]] == r[1]) == (not x)
    assert brute([cut[82]], items)[0][1] == 0 and cut[82] == ""


def test_empty_tables(case, spark):
    _, _, docs, bench = case
    assert decontaminate(docs.limit(0), bench).count() == 0
    none = decontaminate(docs, bench.limit(0))
    assert none.where("n_hit > 0 OR contaminated OR size(item_ids) > 0").count() == 0 and none.count() == docs.count()
