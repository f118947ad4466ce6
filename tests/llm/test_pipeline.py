"""The pipeline and the registration of the queries."""

import random

import pytest

from corpusmill.llm import quality, surrogates
from corpusmill.llm.q_surrogates import KEY
from tests.llm import test_decontaminate as decontaminate
from tests.llm import test_setjoin as setjoin
from tests.llm.test_units_mixing_quality import brute_base

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with everything that the stages look for."""
    rng = random.Random(21)

    def prose(n):
        return " ".join(f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(n))

    texts = [prose(rng.randrange(5, 120)) for _ in range(700)]
    for k in range(0, 700, 10):
        w = texts[k].split()
        w[rng.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    texts += texts[3:60:7] + [None, "", "short one"]
    items = [(k, prose(rng.randrange(8, 30))) for k in range(12)]
    for k in range(0, 600, 25):
        texts[k] += " " + items[k % 12][1]
        texts[k + 1] += f" mail a.b{k % 4}@x{k % 3}.example.com or +1 (555) 555-{1000 + k} "
    for k in range(5, 700, 9):
        texts[k] = " ".join(x if rng.random() > 0.15 else f"bad{rng.randrange(3)}" for x in texts[k].split())
    rows = [(i, t, "en", "big" if i % 3 else f"s{i % 4}", None, "x") for i, t in enumerate(texts)] + [(None, texts[2], None, None, None, None)]
    rows += [rows[8]]
    path = str(tmp_path_factory.mktemp("corpus"))
    labels = [(i, 1, int("bad" in (t or ""))) for i, t in enumerate(texts[:700]) if i % 2 or "bad" in t]
    for name, data, schema in (("documents", rows, SCHEMA), ("labels", labels, "doc_id long, quality int, toxic int"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(data, schema).repartition(2).write.parquet(f"{path}/{name}.parquet")
    return path


def test_stages_against_plain_python(spark, folder):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    model = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    want = [r for r in docs.collect() if not brute_base(r.text)[-1]]
    scores = {r.text: r.score for r in quality.judge(docs.select("text"), model).collect()}
    want = [r for r in want if scores[r.text] >= model.threshold]
    sizes = [docs.count()]
    for k, (_, stage) in enumerate(p.STAGES[:4]):
        docs = p.stored(stage(spark, docs, folder), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words"]
        if k == 1:
            kinds = setjoin.brute([(r.doc_id, r.text) for r in want])
            want = [r for r, (i, _, c) in zip(want, kinds) if i is None or i == c]
            want = list({(r.doc_id, r.text) if r.doc_id is not None else n: r for n, r in enumerate(want)}.values())
            want = list({repr(r) if r.doc_id is not None else n: r for n, r in enumerate(want)}.values())
        if k == 2:
            want = [r for r, b in zip(want, decontaminate.brute([r.text for r in want], items)) if not b[3]]
        texts = [(r.doc_id, surrogates.replaced(r.text, KEY.encode())[0] if k == 3 else r.text) for r in want]
        assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr) == sorted(texts, key=repr)
        sizes.append(len(want))
    assert sizes[0] > sizes[1] > sizes[2] > sizes[3] == sizes[4] > 100
    assert any(a.text not in {t for _, t in texts} for a in want)
    mixed = p.STAGES[4][1](spark, docs, folder).collect()
    ids = {r.doc_id for r in docs.collect()}
    tokens = sum(len((t or "").split()) for _, t in texts)
    assert {r.doc_id for r in mixed} <= ids and 0.9 * tokens <= sum(r.n_tokens for r in mixed) <= tokens


def test_run_is_registered_and_survives_empty_tables(spark, tmp_path):
    import __spark_entry__ as E

    names = E.queries().keys()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(E.oracle_sql()) <= set(names)
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert E.queries()["pipeline"](spark, str(tmp_path)).count() == 0
