import base64
import hashlib
import math
import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import backoff, chat, q_urlrules, urlrules, warc


# ---- chat -----------------------------------------------------------------------------------------------------------
TRICKY = ["", "<|im_end|>", "<\\|im_start|>", "<\\\\|", "<<||>", "a<|", "\\", "$1 \\1", "<|image_1|>", "é🙂\n\n<|", "plain", "x" * 200_000]


def test_a_conversation_of_very_many_turns(spark):
    n = 50_000
    df = spark.range(n).selectExpr("1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('t<|im_end|>', id) text").repartition(4)
    r = chat.format_chat(df).select(F.size(chat.read_chat(F.col("formatted"))).alias("n"), F.size("loss").alias("m"),
                                    F.element_at(chat.read_chat(F.col("formatted")), -1).alias("last")).first()
    assert (r.n, r.m, r["last"].text) == (n, n // 2, f"t<|im_end|>{n - 1}")


def test_chat_reads_back(spark):
    rows = [(k // 3, k % 3, ("system", "user", "assistant")[k % 3], t) for k, t in enumerate(TRICKY)]
    rows += [(50, None, "assistant", "n"), (50, 1, "assistant", "b"), (50, 1, "assistant", "a"), (50, 1, "assistant", "a"), (50, 0, None, "r"),
             (None, 0, "we%ird\n<|role|>", None), (51, 0, "assistant", None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, rows int, formatted string").repartition(3)
    made = chat.format_chat(df)
    got = {r.conv_id: r for r in made.select("conv_id", "formatted", "loss", chat.read_chat(F.col("formatted")).alias("turns"),
                                              chat.masked_text(F.col("formatted"), F.col("loss")).alias("masked")).collect()}
    for conv in {r[0] for r in rows}:
        mine = sorted(((-1 if t is None else t), ro or "", tx or "") for c, t, ro, tx in rows if c == conv)
        assert [(t.role, t.text) for t in got[conv].turns] == [(ro, tx) for _, ro, tx in mine]
        assert got[conv].masked == "".join(tx for _, ro, tx in mine if ro == "assistant")
        assert got[conv].formatted.count("<|im_start|>") == len(mine) == got[conv].formatted.count("<|im_end|>")
        for m, text in zip(got[conv].loss, [tx for _, ro, tx in mine if ro == "assistant"]):
            assert got[conv].formatted[m["first"]:m["first"] + m["length"]] == re.sub(r"<(\\*)\|", r"<\\\1|", text)
    assert chat.format_chat(df.limit(0)).count() == 0


def test_typed_parts_become_numbered_placeholders(spark):
    part = lambda kind, **k: (kind, k.get("text"), k.get("ref"), k.get("width"), k.get("height"), k.get("seconds"), k.get("pages"))
    rows = [(1, 0, "user", [part("text", text="look <|image_1|>"), part("image", ref="a.png", width=57, height=28), part("text", text=None),
                            part("audio", ref="b.wav", seconds=2.0)]),
            (1, 1, "assistant", [part("text", text="fine"), part("image", ref="c.png")]),
            (1, 2, "user", [part("document", ref="d.pdf", pages=3), part("video", ref="e.mp4")]), (2, 0, "assistant", None), (3, 0, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, text {chat.PARTS_TYPE}")
    got = {r.conv_id: r for r in chat.format_chat(df).collect()}
    assert got[1].formatted == ("<|im_start|>user\nlook <\\|image_1|><|image_1|><|audio_1|><|im_end|>\n<|im_start|>assistant\nfine<|image_2|><|im_end|>\n"
                                "<|im_start|>user\n<|document_1|><|document_2|><|im_end|>\n")
    assert [(a.kind, a.ref, a.placeholder, a.tokens) for a in got[1].attachments] == [
        ("image", "a.png", "<|image_1|>", 3), ("audio", "b.wav", "<|audio_1|>", 25), ("image", "c.png", "<|image_2|>", 0),
        ("document", "d.pdf", "<|document_1|>", 3072), ("document", "e.mp4", "<|document_2|>", 1024)]
    assert got[1].n_tokens_expanded == 3 + 25 + 3072 + 1024
    assert got[2].formatted == "<|im_start|>assistant\n<|im_end|>\n" and got[3].attachments == []


# ---- WARC -----------------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(6)
    htmls = ["", "a", "é\r\n\r\nWARC/1.1\r\n", "\r\n\r\n", "x" * 300_000, None, "<p>\n</p>"]
    rows = [(k, rng.choice([f"http://www.b{k % 4}.example.com/p{k % 3}?q#f", "HTTPS://A.example.org", None, "no scheme", "http://x/\r\ny"]), rng.choice(htmls), "z")
            for k in range(120)]
    rows += [(7, rows[7][1], rows[7][2], "z"), (None, "http://n/", "only null", "z"), (None, "http://n/", "only null", "z"), (None, None, "a", None)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string, first string").repartition(5)


@pytest.mark.parametrize("least", [0, 2])
def test_archives_read_back(pages, least):
    rows, df = pages
    first = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, u, h, _ in rows:
        raw, f = (h or "").encode(), first.get(h or "")
        again = f is not None and i != f and len(raw) >= least
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", f if again else None,
                     None if u is None else u.replace("\r", "%0D").replace("\n", "%0A")))
    got = warc.archive_and_index(df, least_bytes=least, archive_records=9)
    have = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.url) for r in got.collect()]
    assert sorted(have, key=repr) == sorted(want, key=repr)


def test_index_is_in_global_order_over_many_runs(spark, pages):
    _, df = pages
    got = warc.archive_and_index(df, archive_records=4)
    rows = [(r.urlkey, r.captured or "", -1 if r.page_id is None else r.page_id) for r in got.toLocalIterator()]
    assert rows == sorted(rows) and len(rows) == df.count() and len({r.archive for r in got.select("archive").collect()}) > 5
    assert warc.archive_and_index(df.limit(0)).count() == 0


def test_loser_tree_merges_any_number_of_runs():
    rng = random.Random(0)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.choices(range(30), k=rng.randrange(0, 12))) for _ in range(k)]
        assert list(warc.LoserTree(runs, key=lambda x: x)) == sorted(x for r in runs for x in r)


def test_broken_archives_are_told():
    good = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert [(o, b) for o, _, b in warc.parse(good * 2)] == [(0, b"abc"), (len(good), b"abc")]
    for bad in (good.replace(b"3", b"2"), b"x" + good):
        with pytest.raises(ValueError):
            list(warc.parse(bad))


def test_url_keys(spark):
    urls = ["http://www.A.example.com/P?q=1", "https://b.org", None, "x y", "http://[::1]/"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(warc.url_key(F.col("u")).alias("k"))
    assert [r.k for r in df.collect()][:4] == ["com,example,a)/p?q=1", "org,b)", ")", "x y)"]


# ---- URL rules ------------------------------------------------------------------------------------------------------
def test_given_rules_and_parts(spark):
    cases = {"http://A.Net/x": ("a.net", "/x", "net/", "block"), "http://net": ("net", "", None, "allow"), "http://example.net/en/1": ("example.net", "/en/1", "example.net/en/", "allow"),
             "http://w.example.net/en/": ("w.example.net", "/en/", "example.net/en/", "allow"), "http://w.example.net/EN/": ("w.example.net", "/EN/", "net/", "block"),
             "http://badexample.com/de/": ("badexample.com", "/de/", None, "allow"), "x://example.com/de/?a#b": ("example.com", "/de/", "example.com/de/", "block"),
             "http://é.org/fr/x?://y": ("é.org", "/fr/x", "org/fr/", "allow"), "no": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://": ("", "", None, "allow"),
             "a://b#c/": ("b", "", None, "allow"), "a\n://B\n.net/\nz?": ("b\n.net", "/\nz", "net/", "block"), "http://internet/": ("internet", "/", None, "allow")}
    df = spark.createDataFrame([(k, u, 1, 2) for k, u in enumerate(cases)] + [(0, "http://A.Net/x", 1, 2), (None, None, 1, 2)], "page_id long, url string, host int, tokens int")
    rules = urlrules.mine(df.where("false").selectExpr("url", "true AS bad"))
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(df, q_urlrules.GIVEN, rules).collect()]
    want = [(k, *v) for k, v in enumerate(cases.values())] + [(0, *cases["http://A.Net/x"]), (None, *cases[None])]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_mined_rules_equal_brute_force(spark):
    rng, rows = random.Random(8), []
    for k in range(400):
        host, lang = rng.choice(["spam-farm", "good", "mid"]), rng.choice(["en", "de"])
        bad = rng.random() < {"spam-farm": 0.9, "good": 0.05, "mid": 0.9 if lang == "de" else 0.1}[host]
        rows.append((f"http://{rng.choice(['www', 'm'])}.{host}.example.com/{lang}/{k}", None if k % 50 == 0 else bad))
    df = spark.createDataFrame(rows, "url string, bad boolean")
    toks = {r.url: frozenset(r.t) for r in df.select("url", urlrules.tokens(F.col("url")).alias("t")).collect()}
    known = [(toks[u], b) for u, b in rows if b is not None]
    support = max(urlrules.LEAST_SUPPORT, 20 / len(known))
    found = {}
    for items in {frozenset(c) for t, _ in known for n in range(1, len(t) + 1) for c in combinations(sorted(t), n)}:
        own = [b for t, b in known if items <= t]
        if sum(own) >= math.ceil(support * len(known)) and sum(own) / len(own) >= 0.8:
            found[items] = sum(own) / len(own)
    want = {k for k, v in found.items() if not any(o < k and round(found[o], 9) >= round(v, 9) for o in found)}
    rules = urlrules.mine(df, least_count=20, least_confidence=0.8)
    assert {frozenset(r["items"]) for r in rules.collect()} == want and any("h:spam" in k for k in want) and any("p:de" in k and "h:mid" in k for k in want)
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows)], "page_id long, url string")
    for r in urlrules.judge(pages, [], rules).collect():
        assert (r.verdict == "block") == any(k <= toks[rows[r.page_id][0]] for k in want)


def test_support_is_the_same_at_every_size(spark):
    rows = [(f"http://{h}.example.com/{k}", True) for h, n in (("rare", 5), ("rarer", 4)) for k in range(n)]
    for more in (100, 8000):
        df = spark.createDataFrame(rows + [(f"http://good.example.com/{k}", False) for k in range(more)] + [(None, False)] * 50, "url string, bad boolean")
        rules = {tuple(r["items"]): r.support for r in urlrules.mine(df).collect()}
        assert set(rules) == {("h:rare",)} and rules["h:rare",] == round(5 / (9 + more + 50), 9)


# ---- backoff --------------------------------------------------------------------------------------------------------
def brute_scores(rows, least=1):
    words = [[w for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m.group(0).lower(), t or ""))] for _, t in rows]
    n, pairs, context = Counter(), Counter(), Counter()
    for w in words:
        n.update(w)
        for v, x in zip([None, *w], w):
            pairs[v, x] += 1
            context[v] += 1
    total, out = sum(n.values()), []
    for (i, _), w in zip(rows, words):
        logs = [math.log(pairs[v, x] / context[v]) if pairs[v, x] >= least else math.log(0.4 * n[x] / total) for v, x in zip([None, *w], w)]
        out.append((i, len(w), sum(pairs[v, x] >= least for v, x in zip([None, *w], w)), round(sum(logs) / len(w), 6) if w else None))
    return out


@pytest.mark.parametrize("parts,least", [(2000, 1), (2000, 2), (10, 2), (1, 1), (1, 3)])
def test_backoff_equals_plain_python(docs, monkeypatch, parts, least):
    monkeypatch.setattr(backoff, "HOT_PARTS", parts)
    monkeypatch.setattr(backoff, "_PACK", 500)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [(r.doc_id, r.n_words, r.n_pairs, r.score) for r in backoff.score(docs, least_pair=least).collect()]
    want = brute_scores(rows, least)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:3] == w[:3] and (g[3] is w[3] is None or abs(g[3] - w[3]) < 2e-6)


def test_backoff_of_nothing(spark, empty):
    assert backoff.score(empty).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert [(r.n_words, r.n_pairs, r.score) for r in backoff.score(blank).collect()] == [(0, 0, None)] * 2


def test_hot_pairs_meet_in_no_bucket(spark, monkeypatch):
    rows = [(k, "no no " * 500 + f"a{k % 7} b") for k in range(12)] + [(12, "no"), (13, "b no a1 b")]
    seen = spark.sparkContext.accumulator(0)
    unpacked = backoff._unpacked
    monkeypatch.setattr(backoff, "_unpacked", lambda columns: (lambda got: (seen.add(len(got[0])), got)[1])(unpacked(columns)))
    got = [(r.doc_id, r.n_words, r.n_pairs, r.score) for r in backoff.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()]
    for g, w in zip(sorted(got), sorted(brute_scores(rows)), strict=True):
        assert g[:3] == w[:3] and abs(g[3] - w[3]) < 2e-6
    assert 0 < seen.value < 200
