import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpusmill.llm import textarrays as ta


def _lower(t):
    return re.sub(r"[A-Z]+", lambda m: m.group(0).lower(), t)


@pytest.mark.parametrize("letters,pattern,lower", [(ta.NON_SPACE, r"[^\x20\x09-\x0D]+", False), (ta.ALNUM_LOWER, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", True)])
@pytest.mark.parametrize("size", [7, 50, 1 << 20])
def test_words_are_those_of_the_pattern(letters, pattern, lower, size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("abZ9 \t\n.é日-") for _ in range(rng.randrange(0, 30))) for _ in range(200)] + [None, "", "a", "b"]
    arr = pa.array(texts, pa.string()).slice(3)
    got = []
    for c in ta.chunks(arr, letters, lower, size):
        for r in range(c.rows):
            got.append([c.bytes[s:e].tobytes().decode() for s, e in
                        zip(c.start[c.word_at[r]:c.word_at[r + 1]], c.end[c.word_at[r]:c.word_at[r + 1]])])
    assert got == [re.findall(pattern, _lower(t or "") if lower else t or "") for t in texts[3:]]


def test_hashes_depend_on_words_only():
    a, b = (next(ta.chunks(pa.array([t]), ta.NON_SPACE, False)) for t in ("x yy  x zzz yy", "yy\nzzz"))
    ha, hb = a.word_hashes(), b.word_hashes()
    assert ha[0] == ha[2] and ha[1] == ha[4] == hb[0] and ha[3] == hb[1] and len(np.unique(ha)) == 3
    assert len(ta.window_hashes(ha, 9)) == 0 and len(ta.window_hashes(ha, 5)) == 1
