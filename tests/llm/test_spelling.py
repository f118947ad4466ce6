import random
import re
import zlib
from collections import Counter

import pytest

from corpusmill.llm import spelling as sp


def plain_words(rows, least=6, count=5):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= least and k >= count}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(n):
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and distance(v, w) == 1] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def words_of(rng, count):
    """Families one or two edits wide, permutations, and words of few letters."""
    out = set()
    while len(out) < count:
        w = "".join(rng.choice("abcdeéxÿ" if rng.random() < 0.5 else "ab") for _ in range(rng.randrange(6, 10)))
        for _ in range(6):
            v = list(w)
            for _ in range(rng.randrange(3)):
                k = rng.randrange(len(v))
                v[k:k + 1] = rng.choice(([], [rng.choice("abcdeéz")], [v[k], rng.choice("abcdeéz")]))
            if len(v) > 5:
                out.add("".join(v))
    return sorted(out)


def found(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("kw", [{}, {"node": 5, "top": 1}, {"node": 3, "groups": 2, "top": 2}, {"node": 20, "groups": 4, "top": 2, "searches": 7}])
def test_equals_brute_force(spark, kw):
    rng = random.Random(5)
    n = {w: rng.choice((5, 6, 30, 150, 151, 800, 4000)) for w in words_of(rng, 220)}
    df = spark.createDataFrame(sorted(n.items()), "word string, n long").repartition(3)
    want = brute(n)
    assert found(sp.variants(df, **kw)) == want
    assert len({r[2] for r in want}) < len(want) and any(r[1] and r[1] != r[2] for r in want)


def test_words_of_texts(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rng = random.Random(1)
    rows += [(k, " ".join(rng.choice(("Straße", "straße", "Élan-vital", "colour's", "COLOUR", "x" * 40, "über×cool", "ÿÿÿÿÿÿ", "日本colours")) for _ in range(60))) for k in range(400)]
    df = spark.createDataFrame([(t, i, 1, "x") for i, t in rows], "text string, doc_id long, n int, word string").repartition(3)
    got = {r.word: r.n for r in sp.words(df).collect()}
    assert got == plain_words(rows) and len(got) >= 10


def test_one_edit():
    assert sp.one_edit("abc", "abd") and sp.one_edit("abc", "abcd") and sp.one_edit("abc", "bc") and sp.one_edit("aab", "ab")
    assert not sp.one_edit("abc", "abc") and not sp.one_edit("abc", "cb") and not sp.one_edit("abcd", "ab") and not sp.one_edit("abc", "acb")


def test_a_crowded_leaf_is_asked_for_edits():
    trie = sp.Trie("ab")
    rng = random.Random(2)
    held = {"".join(rng.choice("ab") for _ in range(8)) for _ in range(150)}
    for k, w in enumerate(sorted(held)):
        trie.add([], w, k)
    for w in ("abababab", "aabbaabb", "ababababa"):
        (leaf, alike), = trie.leaves([], sp.BOTH)
        assert alike and {t for t, _ in trie.near(leaf, w, 8)} == {t for t in held if sp.one_edit(w, t)}


def test_empty_table(empty):
    assert sp.variants(sp.words(empty)).collect() == []
