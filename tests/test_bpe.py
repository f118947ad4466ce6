import pytest
from pyspark.sql import functions as F

from corpusmill.operators import bpe
from corpusmill.sources import corpus as io


def test_tiny_corpus(spark):
    m = bpe.learn_bpe(spark.createDataFrame([("ab ab cd cd ef",)], "text string"), vocab_size=100, min_frequency=2)
    assert [m.token_text(i) for i in range(m.vocab_size)] == [
        "<|endoftext|>", "<|pad|>", "<|unk|>", "a", "b", "c", "d", "e", "f", "Ġ", "ab", "cd", "Ġcd"]


def test_against_public_library(spark):
    tk_mod = pytest.importorskip("tokenizers")
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel
    from tokenizers.trainers import BpeTrainer

    texts = ["The cat sat on the mat. The cat's hat!", "Thé chât, 123 4567 -- ok?", "that that then these",
             "don't won't they're I'll we've", "über straße naïve café 😀 😀"] * 3
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    m = bpe.learn_bpe(df, vocab_size=160, min_frequency=2)
    tk = tk_mod.Tokenizer(BPE(unk_token=bpe.UNK))
    tk.pre_tokenizer = ByteLevel(add_prefix_space=False)
    tk.train_from_iterator(texts, trainer=BpeTrainer(vocab_size=160, min_frequency=2, special_tokens=bpe.SPECIALS,
                                                     show_progress=False))
    assert tk.get_vocab() == {m.token_text(i): i for i in range(m.vocab_size)}
    probe = texts + ["<|endoftext|>unseen words zzz<|pad|> ", "Ω new bytes"]
    pdf = spark.createDataFrame([(i, t) for i, t in enumerate(probe)], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in bpe.bpe_encode(pdf, m).collect()}
    for i, t in enumerate(probe):
        assert got[i] == tk.encode(t).ids, t


def test_decode_roundtrip_and_cut_sequence(spark):
    df = spark.createDataFrame([(0, "naïve café, 100%"), (1, "日本")], "doc_id long, text string")
    m = bpe.learn_bpe(df, vocab_size=40, min_frequency=1)
    enc = bpe.bpe_encode(df, m).withColumn("dec", bpe.bpe_decode(m, F.col("ids")))
    assert all(r.dec == r.text for r in enc.collect())
    ids = [m.tokens.index(bytes([b])) for b in "日".encode()[:2]]
    cut = spark.createDataFrame([(ids + [0],)], "ids array<int>").select(bpe.bpe_decode(m, F.col("ids")).alias("t"))
    assert "�" in cut.first().t


def test_save_load_bpe(spark, tmpdir_fresh):
    m = bpe.learn_bpe(spark.createDataFrame([("ab ab cd cd ef",)], "text string"), vocab_size=100)
    io.save_bpe(spark, m, tmpdir_fresh + "/m")
    back = io.load_bpe(spark, tmpdir_fresh + "/m")
    assert back.tokens == m.tokens and back.merges == m.merges
    with pytest.raises(FileNotFoundError):
        io.load_bpe(spark, tmpdir_fresh + "/missing")
    with pytest.raises(ValueError):
        io.save_bpe(spark, None, tmpdir_fresh + "/x")


def test_fixture_anchors_sf0001(spark):
    """FIXTURES: vocab 300 / min frequency 2 on sf0.001 documents."""
    from tests.conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    m = bpe.learn_bpe(docs, vocab_size=300, min_frequency=2)
    assert m.vocab_size == 300
    assert max(i for i, t in enumerate(m.tokens) if isinstance(t, bytes) and len(t) == 1) == 102
    first = [m.token_text(a) + " " + m.token_text(b) for a, b, _ in m.merges[:8]]
    assert first == ["t h", "Ġ th", "Ġ e", "o n", "i n", "r e", "Ġ a", "t i"]
    n = bpe.bpe_encode(docs, m).agg(F.sum(F.size("ids"))).first()[0]
    assert n == 214273


def test_long_words_merge_like_short_ones():
    import random

    rng = random.Random(3)
    for _ in range(200):
        ranks, nxt = {}, 4
        for r in range(12):
            a, b = rng.randrange(nxt), rng.randrange(nxt)
            if (a, b) not in ranks:
                ranks[a, b] = (r, a, b, nxt)
                nxt += 1
        ids = [rng.randrange(4) for _ in range(rng.randrange(0, 40))]
        want = list(ids)
        while found := [ranks[p] for p in zip(want, want[1:]) if p in ranks]:  # one merge of all occurrences at a time
            _, a, b, new = min(found)
            out, i = [], 0
            while i < len(want):
                both = want[i:i + 2] == [a, b]
                out.append(new if both else want[i])
                i += 2 if both else 1
            want = out
        assert bpe._merge_word(ids, ranks) == want
    assert len(bpe._merge_word([0] * 20_000, {(0, 0): (0, 0, 0, 1), (1, 1): (1, 1, 1, 2)})) == 5000


def test_saved_model_encodes_through_the_dispatch(spark, tmpdir_fresh):
    from corpusmill.plans import prepare
    from corpusmill.sources import corpus as io

    docs = spark.createDataFrame([(1, "ab ab cd cd ef"), (2, "ab cd")], "doc_id long, text string")
    model = bpe.learn_bpe(docs, vocab_size=100)
    io.save_bpe(spark, model, tmpdir_fresh + "/bpe_tokenizer")
    encode, decode = prepare.load_codec(spark, {"tokenizer_type": "bpe"}, tmpdir_fresh)
    got = docs.select("doc_id", "text", encode("text").alias("ids")).withColumn("back", decode("ids")).collect()
    want = {r.doc_id: r.ids for r in bpe.bpe_encode(docs, model).collect()}
    assert {r.doc_id: r.ids for r in got} == want and all(r.back == r.text for r in got)


def _library(texts, size, least):
    from tokenizers import Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel
    from tokenizers.trainers import BpeTrainer

    tk = Tokenizer(BPE(unk_token=bpe.UNK))
    tk.pre_tokenizer = ByteLevel(add_prefix_space=False)
    tk.train_from_iterator(texts, trainer=BpeTrainer(vocab_size=size, min_frequency=least, special_tokens=bpe.SPECIALS, show_progress=False))
    return tk.get_vocab()


@pytest.mark.parametrize("local,kept,indexed,sparse", [(0, 50_000, 6, 0.2), (10_000, 40, 5, 1.0)])
def test_rounds_of_all_kinds_equal_the_library(spark, monkeypatch, local, kept, indexed, sparse):
    """Given merges, merges found by one task, a small table of pairs, words without index rows."""
    import random

    rng = random.Random(4)
    syl = ["ta", "re", "ion", "the", "an", "é", "qu", "st", "ing", "o", "1", "xx"]
    texts = [" ".join("".join(rng.choice(syl[: 3 + rng.randrange(9)]) for _ in range(rng.randrange(1, 6))) for _ in range(60)) for _ in range(40)]
    monkeypatch.setattr(bpe, "KEPT_PAIRS", kept)
    monkeypatch.setattr(bpe, "LOCAL_PAIRS", 4)
    monkeypatch.setattr(bpe, "COMPACT", 5)
    size = 75 if not local else 200
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    m = bpe.learn_bpe(df, vocab_size=size, min_frequency=2, candidates=24, local_words=local, indexed=indexed, sparse=sparse)
    assert {m.token_text(i): i for i in range(m.vocab_size)} == _library(texts, size, 2)


def test_learning_of_nothing_and_of_runs(spark):
    assert bpe.learn_bpe(spark.createDataFrame([], "text string"), vocab_size=20).vocab_size == len(bpe.SPECIALS)
    texts = ["aaaa aaaaa aaa bb", "aaaaaaaa bbbb", None, ""]
    m = bpe.learn_bpe(spark.createDataFrame([(t,) for t in texts], "text string"), vocab_size=40, min_frequency=1)
    assert m.merges and all(m.tokens[n] == m.tokens[a] + m.tokens[b] for a, b, n in m.merges)


def test_decoding_has_a_plan_of_constant_size(spark):
    def size(n):
        m = bpe.BpeModel(tokens=list(bpe.SPECIALS) + [str(i).encode() + b"," for i in range(n)])
        df = spark.createDataFrame([([3, 4 + n // 2, 0, -5, n + 900, None],)], "ids array<int>").select(bpe.bpe_decode(m, "ids").alias("t"))
        assert df.first().t == f"0,{n // 2 + 1},"
        return df._jdf.queryExecution().analyzed().expressions().head().treeString().count("\n")

    assert size(10) == size(32_000)


def test_rounds_are_few_where_words_are_many(spark):
    """Segments, not words, bound a round: as many jobs for ten times the words, and the library's merges."""
    syl = ["ta", "re", "ion", "the", "an", "é", "qu", "st", "ing", "o"]

    def learned(group, texts):
        spark.sparkContext.setJobGroup(group, group)
        m = bpe.learn_bpe(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), vocab_size=120, min_frequency=2, local_words=400)
        spark.sparkContext.setJobGroup("other", "other")
        assert {m.token_text(i): i for i in range(m.vocab_size)} == _library(texts, 120, 2)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few = learned("few", [" ".join(a + b + c for a in syl for b in syl) for c in syl[:2]])
    many = learned("many", [" ".join(a + b + c + d for a in syl for b in syl for c in syl) for d in syl[:2]])
    assert many <= few + 30 and many < 150, (few, many)
