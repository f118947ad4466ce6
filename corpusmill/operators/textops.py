"""Operators on finished text (I1-I3): stop-sequence truncation and prompt checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.cleaning import python_strip

# --- fixed values: default stop sequences and prompt messages -----------------------
DEFAULT_STOPS = ["\n\n", "\nQ:", "\n---", "Human:", "User:"]
MSG_EMPTY = "Please enter a prompt."
MSG_UNENCODABLE = "Could not encode prompt. Try different characters."
DEFAULT_PROMPT = "\n"
# --------------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_stop(text, prompt, stops=None) -> Column:
    """struct(end, idx, pos) of the stop sequence that completes first after the
    prompt (smallest end position, ties by list order); null when none occurs."""
    stops = DEFAULT_STOPS if stops is None else list(stops)
    text, prompt = _c(text), _c(prompt)
    start = F.length(prompt) + 1
    cands = []
    for j, s in enumerate(stops):
        pos = F.position(F.lit(s), text, start)
        cands.append(F.when(pos > 0, F.struct((pos + len(s) - 1).alias("end"), F.lit(j).alias("idx"),
                                              pos.alias("pos"))))
    if not cands:
        return F.lit(None)
    return F.array_min(F.filter(F.array(*cands), lambda x: x.isNotNull()))


def truncate_at_stop(text, prompt, stops=None) -> Column:
    """Text cut before the first completed stop sequence, then stripped."""
    hit = first_stop(text, prompt, stops)
    text = _c(text)
    cut = F.when(hit.isNotNull(), F.substring(text, F.lit(1), hit["pos"] - 1)).otherwise(text)
    return python_strip(cut)


def default_prompt(prompt) -> Column:
    """An empty prompt starts from a newline."""
    p = _c(prompt)
    return F.when(p == "", F.lit(DEFAULT_PROMPT)).otherwise(p)


def prompt_guard(prompt, encoded_ids) -> Column:
    """Reason to reject a prompt - blank, or nothing encodable - else null."""
    p, ids = _c(prompt), _c(encoded_ids)
    return (F.when(python_strip(p) == "", F.lit(MSG_EMPTY))
            .when(F.size(ids) == 0, F.lit(MSG_UNENCODABLE)))
