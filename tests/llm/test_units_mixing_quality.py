import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import mixing, quality
from corpusmill.llm.units import drop_repeats

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub(r"[A-Z]", lambda m: m.group(0).lower(), t or "")


def brute_units(rows, sep, least):
    """rows of (id, text): text kept, ranges removed."""
    first, cuts = {}, []
    for i, t in rows:
        at, own = 0, []
        for m in [*re.finditer(sep, t or ""), None]:
            end = m.start() if m else len(t or "")
            own.append((at, end, tuple(ALNUM.findall(lower(t or "")[at:end]))))
            at = m.end() if m else None
        cuts.append(own)
        for k, (_, _, w) in enumerate(own):
            if i is not None and len(w) >= least:
                first[w] = min(first.get(w, (math.inf, 0)), (i, k))
    out = []
    for (i, t), own in zip(rows, cuts):
        gone = [i is not None and len(w) >= least and first[w] != (i, k) for k, (_, _, w) in enumerate(own)]
        left = [(a, b) for (a, b, _), g in zip(own, gone) if not g]
        if sep == "\n\n+":
            kept = None if t is None else "\n\n".join(t[a:b] for a, b in left)
        else:
            kept = None if t is None else "".join(t[a - 1 if k else a:b] for k, (a, b) in enumerate(left))
        longest = run = 0
        for (_, _, w), g in zip(own, gone):
            run = run + len(w) if g or not w else 0
            longest = max(longest, run)
        out.append((i, kept, 0 if t is None else len(own), [(a, b) for (a, b, _), g in zip(own, gone) if g], longest))
    return out


@pytest.mark.parametrize("unit,sep,least", [("line", "\n", 3), ("paragraph", "\n\n", 3), ("sentence", ". ", 1), ("sentence", "!\n", 3)])
def test_repeated_units(spark, docs, unit, sep, least):
    rng = random.Random(2)
    pool = [" ".join(rng.choices(["é", "b!", "C", "dd"], k=k)) for k in (0, 1, 2, 3, 3, 4, 5, 6, 6, 9)]
    rows = [(k, sep.join(rng.choices(pool, k=rng.randrange(0, 6)))) for k in range(60)]
    rows += [(60, None), (61, ""), (62, sep), (None, pool[9]), (5, rows[5][1]), (63, "y " * 40_000 + sep + pool[8].upper() + "!")]
    df = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], "doc_id long, text string, REMOVED string, _key string, unit int").repartition(3)
    got = drop_repeats(df, unit=unit, min_words=least)
    assert got.columns == ["doc_id", "text", "_key", "unit", "n_units", "n_removed", "removed", "longest"]
    have = [(r.doc_id, r.text, r.n_units, [(x.first, x.end) for x in r.removed], r.longest) for r in got.collect()]
    assert sorted(have, key=repr) == sorted(brute_units(rows, {"line": "\n", "paragraph": "\n\n+", "sentence": r"\n|(?<=[.!?]) "}[unit], least), key=repr)
    assert all(r.n_removed == len(r.removed) for r in got.collect())
    assert drop_repeats(df.limit(0), unit=unit).count() == 0


def test_newlines_that_end_one_text_and_begin_the_next(spark):
    df = spark.createDataFrame([(1, "a b c\n"), (2, "\na b c"), (3, "x\n\na b c")], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.text, r.n_units) for r in drop_repeats(df, unit="paragraph", min_words=3).collect()}
    assert got == {1: ("a b c\n", 1), 2: ("", 1), 3: ("x", 2)}


def test_a_passage_with_other_line_breaks(spark):
    said = [" ".join(f"w{k}x{j}" for j in range(9)) + "." for k in range(7)]
    df = spark.createDataFrame([(1, "One. " + " ".join(said) + " End."), (2, "Two.\n" + "\n".join(said) + "\nOver."), (3, " . ! three")], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.text, r.longest) for r in drop_repeats(df, unit="sentence").collect()}
    assert got == {1: (df.first().text, 0), 2: ("Two.\nOver.", 63), 3: (" . ! three", 0)}


# ---- mixing ---------------------------------------------------------------------------------------------------------
def shares_of(spark, p):
    return spark.createDataFrame([(float(x),) for x in p], "p double")


def entropy_of(p, x):
    w = [q ** x for q in p]
    return -sum(v / sum(w) * math.log(v / sum(w)) for v in w) / math.log(len(p)) if len(p) > 1 else 1.0


def test_exponent_is_the_largest_that_reaches_the_entropy(spark):
    p = [0.6, 0.2, 0.1, 0.06, 0.04]
    for target in (0.8, 0.95, 0.999):
        k = mixing.exponent(shares_of(spark, p), target, 1e9, 1.0)
        want = max(j for j in range(mixing.STEPS + 1) if round(entropy_of(p, j / mixing.STEPS), 9) >= target)
        assert k == want
    assert mixing.exponent(shares_of(spark, [1.0]), 0.95, 4, 1.0) == mixing.STEPS
    # the limit of repetition comes first: equal weights would repeat the smallest 5 times
    k = mixing.exponent(shares_of(spark, p), 1.0, 3.0, 1.0)
    often = lambda j: max(q ** (j / mixing.STEPS - 1) for q in p) / sum(q ** (j / mixing.STEPS) for q in p)
    assert often(k) <= 3.0 + 1e-8 < often(k - 1) + 1e-6


def test_mixture_keeps_the_budget(spark, docs):
    rows = {}
    for r in docs.collect():
        rows.setdefault(r.source, []).append((r.doc_id, len(SPACE.findall(r.text or ""))))
    got = mixing.mix(docs, entropy=0.99, max_epochs=3.0, budget=20_000, block_docs=4).collect()
    total = sum(n for v in rows.values() for _, n in v)
    tokens = {s: sum(n for _, n in v) for s, v in rows.items()}
    used = Counter()
    for r in got:
        used[r.source] += r.n_tokens
    assert set(rows) == {None, "s0", "s1", "s2"} and total > 0
    for s in rows:
        mine = [r for r in got if r.source == s]
        whole = max((r.epoch for r in mine), default=0)
        for e in range(whole):  # whole epochs have every document once
            assert sorted((r.doc_id, r.n_tokens) for r in mine if r.epoch == e and r.doc_id is not None) == sorted(x for x in rows[s] if x[0] is not None)
        assert used[s] <= 3.0 * tokens[s] + 1
        for block in {(r.epoch, r.block) for r in mine}:
            place = sorted(r.place for r in mine if (r.epoch, r.block) == block)
            assert place == list(range(1, len(place) + 1))
    assert sum(used.values()) <= 20_000
    longest = max(n for v in rows.values() for _, n in v)
    assert sum(used.values()) >= 20_000 - len(rows) * longest
    again = mixing.mix(docs.repartition(7), entropy=0.99, max_epochs=3.0, budget=20_000, block_docs=4).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_mixture_of_nothing(spark, empty):
    assert mixing.mix(empty).count() == 0
    blank = spark.createDataFrame([(1, "a", ""), (2, "a", None)], "doc_id long, source string, text string")
    assert mixing.mix(blank).count() == 0


# ---- quality --------------------------------------------------------------------------------------------------------
def brute_base(t):
    w, t = SPACE.findall(t or ""), t or ""
    seen, hit = {}, set()
    for k in range(len(w) - 7):
        seen.setdefault(tuple(w[k:k + 8]), []).append(k)
    for ks in seen.values():
        if len(ks) > 1:
            hit.update(p for k in ks for p in range(k, k + 8))
    lines, dup = set(), 0
    for line in t.split("\n"):
        if SPACE.search(line):
            dup += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(w) < 20 or 100 * len(hit) > 30 * len(w))


def test_base_statistics(texts):
    rng = random.Random(1)
    texts = [*texts, "a b\na b\n \n \nc\n", *("".join(rng.choice("ab# \n\té|") for _ in range(80)) for _ in range(100)),
             *(" ".join(rng.choice("xy") for _ in range(60)) for _ in range(20))]
    got = quality.base_statistics(pa.array(texts, pa.string()))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert [tuple(v) for v in zip(*(got[n].tolist() for n in names))] == [brute_base(t) for t in texts]


@pytest.fixture(scope="module")
def labelled(spark):
    """English-like documents; bad ones have words of their own."""
    rng, rows = random.Random(4), []
    for k in range(1500):
        w = [f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(rng.randrange(40, 120))]
        bad = k % 5 == 0
        if bad:
            for _ in range(8):
                w[rng.randrange(len(w))] = f"bad{rng.randrange(3)}"
        rows.append((k, " ".join(w), bad))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t, _ in rows], "doc_id long, text string, Kept string, score int").repartition(3)
    labels = spark.createDataFrame([(i, 1, int(b)) for i, _, b in rows if i % 2 == 0 or b] + [(2, 0, None), (10_000, 1, 0), (None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_ratio_finds_bad_documents_and_leaves_others(labelled):
    rows, docs, labels = labelled
    model = quality.fit(docs, labels)
    got = {r.doc_id: r for r in quality.judge(docs, model).collect()}
    bad = [i for i, _, b in rows if b]
    good = [i for i, _, b in rows if not b]
    assert sum(not got[i].kept for i in bad) >= 0.95 * len(bad)
    assert sum(got[i].kept for i in good) >= 0.97 * len(good)
    kept = quality.judge(docs, model, mode="filter")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if got[i].kept}
    again = quality.fit(docs.repartition(5), labels.repartition(2))
    assert np.array_equal(model.weights, again.weights) and model.threshold == again.threshold


def test_scores_equal_plain_python(labelled):
    """Counts, weights and scores word by word, with the hash of the vector code for single words only."""
    from corpusmill.llm import textarrays as ta

    rows, docs, labels = labelled
    model = quality.fit(docs, labels)
    third, shift = int(quality._THIRD), 64 - quality.BITS

    def one(word, kind):
        c = next(ta.chunks(pa.array([word]), ta.NON_SPACE, False))
        h = int(ta.mix(c.word_hashes() + np.uint64(kind + 1))[0]) >> shift
        return kind * third + h % third

    def pair(a, b):
        c = next(ta.chunks(pa.array([f"{a} {b}"]), ta.ALNUM_LOWER, False))
        return 2 * third + (int(ta.window_hashes(c.word_hashes(), 2)[0]) >> shift) % third

    for r in quality.judge(docs, model).limit(40).collect():
        w = r.text.split()
        total = sum(float(model.weights[one(x, k)]) for x in w for k in (0, 1)) + sum(float(model.weights[pair(a, b)]) for a, b in zip(w, w[1:]))
        assert abs(total / len(w) - r.score) < 1e-6


def test_quality_without_labels_or_documents(docs, empty, labelled):
    _, _, labels = labelled
    for lab in (labels.limit(0), labels.where("quality = 0")):
        model = quality.fit(docs, lab)
        got = quality.judge(docs, model).collect()
        assert all(r.kept == (not r.base_failed) and r.score == 0 for r in got) and len(got) == docs.count()
    assert quality.judge(empty, quality.fit(empty, labels)).count() == 0
