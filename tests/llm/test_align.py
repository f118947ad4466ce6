import hashlib
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from corpusmill.llm import align as al
from corpusmill.llm.q_align import TOKENIZERS

A, B = Path(TOKENIZERS, "byte_bpe_50k.json").read_text("utf-8"), Path(TOKENIZERS, "piece_bpe_32k.model").read_bytes()
ODD = ["  two  spaces ", "tab\tand\nline \n next", "“quoted” words — dash", "don't we'll", "é combining ́x", "日本語 テスト ですか", "emoji 👩‍👩‍👧 ok", "▁mark here",
       "<|endoftext|> </s> <s> <0x0A> x", "\x00nul \x1f", "a b   c", " ", "   ", "x" * 300, "=" * 200 + " " * 90 + "!", "1234567 89", "\r\n\r\n", "ﬁ ﬂ", "I 'm ​ zero", " 's", "a 's 've"]


def brute(texts):
    """By whole texts, plain dictionaries and the libraries' own encoders."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one, two = Tokenizer.from_str(A), SentencePieceProcessor(model_proto=B)
    one.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    out = []
    for t in texts:
        if not t:
            out.append([])
            continue
        ids_a, ids_b = one.encode(" " + t, add_special_tokens=False).ids, two.encode(t)
        by_a = [bytes(byte[c] for c in one.id_to_token(i)) for i in ids_a]
        by_b = [bytes([int(two.id_to_piece(i)[1:-1], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        raw = (" " + t).encode()
        if b"".join(by_a) != raw or b"".join(by_b) != raw:
            out.append([])
            continue
        groups, one_group, at = [], ([], []), [0, 0]
        todo = (list(zip(ids_a, by_a)), list(zip(ids_b, by_b)))
        todo[0].reverse()
        todo[1].reverse()
        while todo[0] or todo[1]:  # always take a token of the side that lies behind
            side = 0 if at[0] <= at[1] and todo[0] else 1
            i, token = todo[side].pop()
            one_group[side].append(i)
            at[side] += len(token)
            if at[0] == at[1]:
                groups.append(one_group)
                one_group = ([], [])
        out.append(groups)
    held = Counter()
    for groups in out:
        held.update({(a, b) for x, y in groups for a in x for b in y})
    best = defaultdict(int)
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    rows = []
    for groups in out:
        links = [(a, b) for x, y in groups for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
                     sum(held[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows


def found(df, **kw):
    got = al.align(df, A, B, **kw).collect()
    return sorted(((r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got), key=repr)


@pytest.mark.parametrize("kw", [{}, {"fragment": 300, "hot": 20}, {"hot": 1}])
def test_equals_brute_force(spark, docs, kw):
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(1000 + k, t) for k, t in enumerate(ODD + [" ".join(ODD * 3), "\n".join(ODD)])]
    df = spark.createDataFrame([(t, i, "x", 1) for i, t in rows], "text string, doc_id long, key string, pair int").repartition(3)
    want = [(i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows]), strict=True)]
    assert found(df, **kw) == sorted(want, key=repr)


def test_empty_table(empty):
    assert found(empty) == []


def test_fragments_are_a_monoid():
    """Any cutting into byte ranges and any order of joining gives the groups of the whole."""
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(1, 60)
        ends = [np.array(sorted({*rng.sample(range(1, n + 1), rng.randrange(0, n)), n})) for _ in range(2)]
        ids = [np.arange(len(e), dtype=np.int32) for e in ends]
        whole = al.Fragment.of(ids[0], ends[0], ids[1], ends[1])
        marks = sorted(rng.randrange(0, n + 1) for _ in range(rng.randrange(0, 6)))
        parts = []
        for lo, hi in zip([0, *marks], [*marks, n], strict=True):
            i, j = (np.searchsorted(e, (lo, hi), side="right") for e in ends)
            parts.append(al.Fragment.of(ids[0][i[0]:i[1]], ends[0][i[0]:i[1]], ids[1][j[0]:j[1]], ends[1][j[0]:j[1]]))
        parts.insert(rng.randrange(len(parts) + 1), al.Fragment())
        while len(parts) > 1:
            k = rng.randrange(len(parts) - 1)
            parts[k:k + 2] = [parts[k].then(parts[k + 1])]
        assert [x.tolist() for x in parts[0].groups()] == [x.tolist() for x in whole.groups()]


def test_links_in_blocks_are_those_at_once(monkeypatch):
    rng = np.random.default_rng(2)
    na, nb = rng.integers(1, 5, 40).astype(np.int32), rng.integers(1, 5, 40).astype(np.int32)
    na[7], nb[7] = 30, 25
    g = al.Groups(np.arange(4), rng.integers(0, 9, na.sum()).astype(np.int32), rng.integers(0, 7, nb.sum()).astype(np.int32), na, nb, np.array([0, 0, 9, 25, 40]))
    want = [x.tolist() for x in al.links(g, 9, 7)]
    monkeypatch.setattr(al, "LINKS", 12)
    assert [x.tolist() for x in al.links(g, 9, 7)] == want
