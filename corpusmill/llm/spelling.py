"""Groups of spelling variants: words one edit apart, and the commonest form of each.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point.  A word's form is its near word of largest count, if that is ``RATIO`` times its
own or more; following forms leads to its root.

Method: a frequency-vector trie.  The alphabet is dealt into ``GROUPS`` letter groups of
about equal frequency; a word's vector counts its letters of each.  An edit takes one
letter away, adds one, or both: so a near word's vector has at most one unit of surplus
in one group and one unit of deficit in one.  Words are arranged in a trie by their
length and the successive counts; a search goes down with a budget of one surplus and
one deficit, and the words of each leaf that it reaches are verified.  Of two words
only one searches for the other: the longer, or with equal lengths the one from which
the surplus comes before the deficit (words of one vector both do).

Spark holds the upper part of the trie: a node is a length and the first counts, sized
by a map-side aggregate.  Searches enter it a level at a time, by joins, and spread only
to nodes that exist.  A node of up to ``NODE`` words is one group: its words become the
lower part of the trie in a task, and the searches that reach it stream by.  A larger
node is split by its next count.  Where the counts are used up, a leaf still larger
(words that are permutations of a few letter groups) is searched by joins on words less
one code point, of which a key has at most as many as the alphabet.  Nodes that very
many searches reach are dealt out several times.

Scale: texts are scanned once; only counted words are shuffled.  The driver learns the
letters and their counts (bounded by the alphabet) and table sizes.

Defined results: runs are ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z in lower case.  With
``typo`` = t, a run loses the code point h % length if t divides h, the CRC-32 of
``<id>:<run>`` (an id that is null is empty there).  Words have ``LENGTH`` code points
or more, and ``COUNT`` occurrences in the table.  Null and empty texts have none; a text
of any length is read whole; repeated rows count each.  Of near words with the same
count the smaller in code-point order is the form.  An empty table gives an empty
result.  Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import lower_ascii, stored

LENGTH, COUNT, RATIO, TYPO = 6, 5, 5, 199
GROUPS = 12
#: Counts below the length that name a first node; words of a node; searches of a node.
TOP, NODE, SEARCHES = 3, 50_000, 500_000


def words(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_length: int = LENGTH, least_count: int = COUNT,
          typo: int | None = TYPO) -> DataFrame:
    """``(word, n)``: the words of the texts and their occurrences."""
    # a run that is too short makes no word, with or without a code point lost
    runs = F.regexp_extract_all(lower_ascii(F.col(text)), F.lit(f"[a-zÀ-ÿ]{{{least_length},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    if typo:
        h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
        found = found.withColumn("h", h).withColumn("at", (F.col("h") % F.char_length("run")).cast("int"))
        lost = F.concat(F.substr("run", F.lit(1), F.col("at")), F.substr("run", F.col("at") + 2))
        found = found.select(F.when(F.col("h") % typo == 0, lost).otherwise(F.col("run")).alias("run"))
    return (found.where(F.char_length("run") >= least_length).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
            .where(F.col("n") >= least_count))


def letter_groups(vocabulary: DataFrame, groups: int = GROUPS) -> list[str]:
    """The letters of the words in ``groups`` groups of about equal frequency (bounded by the alphabet)."""
    each = vocabulary.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().where("c <> ''").orderBy(F.desc("count"), "c")
    out, total = [""] * groups, [0] * groups
    for r in each.collect():
        k = min(range(groups), key=lambda g: (total[g], g))
        out[k] += r["c"]
        total[k] += r["count"]
    return out


def _key(depth: int) -> Column:
    return F.concat(F.array("len"), F.slice("vec", 1, depth))


#: What a search has left to spend: nothing, a deficit, or a surplus and then a deficit.
DONE, DEFICIT, BOTH = 0, 1, 2


def _spend(searches: DataFrame, level: int) -> DataFrame:
    """Each search goes on to the counts of the next level that its budget allows."""
    c, left = F.col("vec")[level], F.col("budget")
    stay = F.struct(c.alias("c"), left.alias("budget"))
    more = F.struct((c + F.when(left == BOTH, 1).otherwise(-1)).alias("c"), (left - 1).alias("budget"))
    ways = F.filter(F.array(stay, more), lambda s: (s["c"] >= 0) & (s["budget"] >= 0))
    rest = [x for x in searches.columns if x not in ("key", "budget")]
    return (searches.select(*rest, "key", F.explode(ways).alias("way"))
            .select(*rest, F.concat("key", F.array("way.c")).alias("key"), "way.budget"))


def one_edit(a: str, b: str) -> bool:
    """Whether one insertion, deletion or replacement makes ``a`` into ``b``."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) != len(b) + 1:
        return False
    k = next((k for k in range(len(b)) if a[k] != b[k]), len(b))
    return a[k + 1:] == b[k:]


class Trie:
    """The lower part of the trie: successive counts lead to leaves of words."""

    def __init__(self, letters: str):
        self.letters, self.root = letters, {}

    def add(self, counts: list[int], word: str, n: int) -> None:
        node = self.root
        for c in counts:
            node = node.setdefault(c, {})
        node[word] = n

    @staticmethod
    def _same(node: dict, counts: list[int], level: int) -> dict | None:
        for c in counts[level:]:
            node = node.get(c)
            if node is None:
                return None
        return node

    def _less(self, node: dict, counts: list[int], level: int) -> Iterator[dict]:
        """Leaves with one unit less in one group from ``level`` on."""
        for k in range(level, len(counts)):
            c = counts[k]
            if c and (way := node.get(c - 1)) is not None and (leaf := self._same(way, counts, k + 1)) is not None:
                yield leaf
            node = node.get(c)
            if node is None:
                return

    def leaves(self, counts: list[int], budget: int) -> Iterator[tuple[dict, bool]]:
        """Leaves within the budget, and whether their counts are those of the search."""
        if budget == DEFICIT:
            yield from ((leaf, False) for leaf in self._less(self.root, counts, 0))
        elif budget == DONE:
            if (leaf := self._same(self.root, counts, 0)) is not None:
                yield leaf, False
        else:
            node = self.root
            for k, c in enumerate(counts):
                if (way := node.get(c + 1)) is not None:
                    yield from ((leaf, False) for leaf in self._less(way, counts, k + 1))
                node = node.get(c)
                if node is None:
                    return
            yield node, True

    def near(self, leaf: dict, word: str, length: int) -> Iterator[tuple[str, int]]:
        """Words of a leaf, all of that length, that are one edit away.  A crowded leaf is asked for the edits of the word instead."""
        if length < len(word) and len(leaf) > len(word):
            yield from ((t, leaf[t]) for t in {word[:k] + word[k + 1:] for k in range(len(word))} if t in leaf)
        elif length == len(word) and len(leaf) > len(word) * len(self.letters):
            yield from ((t, leaf[t]) for k in range(len(word)) for c in self.letters if c != word[k] and (t := word[:k] + c + word[k + 1:]) in leaf)
        else:
            yield from ((t, n) for t, n in leaf.items() if one_edit(word, t))


def _search(letters: str):
    """Searches of the groups in a partition, each group's words before its searches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, trie, out = None, None, []

        def made() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)],
                                              names=["word", "n", "near", "near_n"])

        for b in batches:
            for own, length, word, n, counts, budget in zip(*(b.column(c).to_pylist() for c in ("node", "length", "word", "n", "counts", "budget")), strict=True):
                if own != group:
                    group, trie = own, Trie(letters)
                if budget is None:
                    trie.add(counts, word, n)
                    continue
                for leaf, alike in trie.leaves(counts, budget):
                    for t, m in trie.near(leaf, word, length):
                        out.append((word, n, t, m))
                        if not alike:  # words of one vector find each other; else only this one searches
                            out.append((t, m, word, n))
                if len(out) >= 20_000:
                    yield made()
                    out.clear()
        if out:
            yield made()

    return run


def _by_less(entries: DataFrame, searches: DataFrame) -> DataFrame:
    """Near words in leaves of any size: by words less one code point.  A key has no more than the alphabet."""
    less = lambda c: F.transform(F.sequence(F.lit(1), F.char_length(c)), lambda k: F.struct(
        k.alias("at"), F.concat(F.substr(F.col(c), F.lit(1), k - 1), F.substr(F.col(c), k + 1)).alias("rest")))
    shorter = F.col("key")[0] < F.char_length("word")
    there = entries.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    lost = F.array_distinct(F.transform(less("word"), lambda s: s["rest"]))
    one = (searches.where(shorter).select("key", "word", "n", "budget", F.explode(lost).alias("near")).join(there, ["key", "near"])
           .select("word", "n", "near", "near_n", "budget"))
    same = (searches.where(~shorter).select("key", "word", "n", "budget", F.inline(less("word"))).join(there.select("key", "near", "near_n", F.inline(less("near"))), ["key", "at", "rest"])
            .where("word <> near").select("word", "n", "near", "near_n", "budget"))
    both = one.unionByName(same)
    back = both.where(F.col("budget") != BOTH).select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return both.drop("budget").unionByName(back)


def near_words(vocabulary: DataFrame, groups: int = GROUPS, top: int = TOP, node: int = NODE, searches: int = SEARCHES) -> DataFrame:
    """``(word, n, near, near_n)``: every two near words, both ways round."""
    dealt = letter_groups(vocabulary, groups)
    counts = F.array(*(F.char_length("word") - F.char_length(F.translate("word", g, "")) if g else F.lit(0) for g in dealt))
    left = stored(vocabulary.select("word", "n", F.char_length("word").alias("len"), counts.alias("vec")), "vectors")
    start = F.array(*(F.struct((F.col("len") + k).alias("length"), F.lit(budget).alias("budget")) for k, budget in ((-1, DEFICIT), (0, BOTH))))
    going = left.select("word", "n", "vec", F.explode(start).alias("s")).select("word", "n", "vec", F.array("s.length").alias("key"), "s.budget")
    depth = min(top, groups)
    for level in range(depth):
        going = _spend(going, level)
    entries, routed, found = [], [], None
    while True:
        keyed = left.withColumn("key", _key(depth))
        sizes = stored(keyed.groupBy("key").agg(F.count("*").alias("size")), "nodes")
        going = stored(going.join(sizes, "key"), "searches")  # nodes that don't exist end a search
        small = F.col("size") <= node
        keyed = keyed.join(sizes, "key")
        entries.append(keyed.where(small).select("key", "word", "n", "vec"))
        routed.append(going.where(small).drop("size"))
        rest = stored(keyed.where(~small).select("word", "n", "len", "vec"), "split")
        if rest.isEmpty():
            break
        going = going.where(~small).drop("size")
        if depth == groups:
            found = _by_less(rest.withColumn("key", _key(depth)), going)
            break
        left, going, depth = rest, _spend(going, depth), depth + 1
    union = lambda dfs: dfs[0] if len(dfs) == 1 else union([dfs[0].unionByName(dfs[1]), *dfs[2:]])
    owned, asked = union(entries), union(routed)
    # nodes with more than a thousandth of all searches, and over ``searches``, are a thousand at most
    most = max(searches, asked.count() // 1000)
    hot = F.broadcast(asked.groupBy("key").count().where(F.col("count") > most).select("key", F.ceil(F.col("count") / most).cast("int").alias("parts")))
    asked = asked.join(hot, "key", "left").withColumn("salt", F.coalesce(F.pmod(F.hash("word"), F.col("parts")), F.lit(0))).drop("parts")
    owned = owned.join(hot, "key", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    both = owned.withColumn("budget", F.lit(None).cast("int")).unionByName(asked)
    below = F.slice("vec", F.size("key"), F.size("vec"))  # the counts that the node's key doesn't have
    met = (both.select(F.concat_ws(",", F.concat("key", F.array("salt"))).alias("node"), F.col("key")[0].alias("length"), "word", "n", below.alias("counts"), "budget")
           .repartition("node").sortWithinPartitions("node", F.col("budget").asc_nulls_first()))
    out = met.mapInArrow(_search("".join(dealt)), "word string, n long, near string, near_n long")
    return out if found is None else out.unionByName(found)


def variants(vocabulary: DataFrame, ratio: int = RATIO, **kw) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each word of ``(word, n)``."""
    vocabulary = stored(vocabulary, "vocabulary")
    near = stored(near_words(vocabulary, **kw), "near")
    best = (near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
            .select("word", "n_near", F.col("best.near").alias("form"), (-F.col("best.minus")).alias("form_n")))
    formed = F.col("form_n") >= ratio * F.col("n")
    own = stored(vocabulary.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                             F.when(formed, F.col("form")).alias("form"), F.when(formed, F.col("form_n")).alias("form_n")), "forms")
    # counts grow by the ratio with each form: chains are short; each round doubles what is followed
    chain = stored(own.where("form is not null").select("word", F.col("form").alias("root")), "chain")
    while True:
        on = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(chain.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "chain")
        chain = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    return own.join(chain, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
