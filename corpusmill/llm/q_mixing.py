"""Query of source mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm.common import read
from corpusmill.llm.mixing import mix


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed to 95 % of the largest entropy with at most 4 epochs of a source."""
    return mix(read(spark, sf_dir, "documents"))


_HASH = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"


def _hash(*parts: str) -> str:
    return _HASH.format(" || '|' || ".join(["'mix'", *parts]))


SQL = {"op3_mixing": rf"""
WITH raw AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS tie, coalesce('=' || source, 'null') AS name
  FROM documents),
sources AS (SELECT name, sum(n_tokens)::BIGINT AS tokens, count(*) AS docs FROM raw GROUP BY name),
shares AS MATERIALIZED (SELECT *, tokens / (SELECT sum(tokens) FROM sources)::DOUBLE AS p FROM sources WHERE tokens > 0),
grid AS (SELECT k, sum(pow(p, k / 65536.0::DOUBLE)) AS z, sum(pow(p, k / 65536.0::DOUBLE) * ln(p)) AS s,
                max(pow(p, k / 65536.0::DOUBLE) / p) AS top, count(*) AS n
         FROM shares, (SELECT unnest(range(0, 65537)) AS k) GROUP BY k),
found AS (SELECT k, round(CASE WHEN n = 1 THEN 1.0 ELSE (ln(z) - k / 65536.0::DOUBLE * s / z) / ln(n) END, 9) AS h, round(top / z, 9) AS often, z FROM grid),
step AS (SELECT greatest((SELECT coalesce(max(k), 0) FROM found WHERE h >= 0.95),
                         (SELECT least(coalesce(max(k), -1) + 1, 65536) FROM found WHERE often > 4.0)) AS k),
plan AS (SELECT name, tokens, CAST(floor(round(pow(p, step.k / 65536.0::DOUBLE) / (SELECT round(sum(pow(p, step.k / 65536.0::DOUBLE)), 9) FROM shares, step)
                * (SELECT sum(tokens) FROM sources)::DOUBLE, 3)) AS BIGINT) AS part, CAST(ceil(docs / 1024.0) AS BIGINT) AS blocks FROM shares, step),
whole AS (SELECT *, part // tokens AS whole, part % tokens AS rest FROM plan),
used AS (SELECT *, {_hash("'block'", "name", "epoch", "in_source")} AS block, {_hash("'place'", "epoch", "tie")} AS ord
         FROM (SELECT *, {_hash("'deal'", "epoch", "tie")} % blocks AS in_source
               FROM (SELECT raw.*, whole, rest, blocks, unnest(range(0, whole + CASE WHEN rest > 0 THEN 1 ELSE 0 END)) AS epoch
                     FROM raw JOIN whole USING (name)))),
sums AS (SELECT name, block, max(rest) AS rest, sum(n_tokens) AS tokens FROM used WHERE epoch = whole GROUP BY name, block),
lefts AS (SELECT name, block, rest - coalesce(sum(tokens) OVER (PARTITION BY name ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM sums),
placed AS (SELECT doc_id, source, epoch, whole, used.block, n_tokens, room,
                  row_number() OVER w AS place, sum(n_tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
           FROM used LEFT JOIN lefts ON used.name = lefts.name AND used.block = lefts.block AND epoch = whole
           WINDOW w AS (PARTITION BY used.name, epoch, used.block ORDER BY ord, tie))
SELECT doc_id, source, epoch, block, place, n_tokens FROM placed WHERE epoch < whole OR (room > 0 AND upto <= room)
"""}
QUERIES = {"op3_mixing": op3_mixing}
