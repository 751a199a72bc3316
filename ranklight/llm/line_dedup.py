"""Drop lines that many documents share, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranklight.llm.common import SPACE, lower_ascii, row_key
from ranklight.session import settle


def lines_of(text: Column) -> Column:
    """The lines between newlines; null and empty text are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A to Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(SPACE)))


def _hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    lines = docs.select(
        "doc_id", row_key().alias("row"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line")
    )
    keyed = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
    # 128 bits stand for a key, so equal hashes mean equal keys.
    hashed = F.struct(F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), F.col("key")).alias("b"))
    long = keyed.filter(F.char_length("key") >= min_chars)
    return long.select("doc_id", "row", "pos", hashed.alias("hash"))


def shared_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``hash`` of each key in at least ``min_docs`` documents, and ``keeper``, the largest id.

    (hash, document) pairs are reduced before they are counted, in map tasks first, so
    a line in a third of all documents reaches its counting task as one row per map task.
    Rows without an id count as one document, which is never the keeper of a line.
    """
    pairs = _hashed_lines(docs, min_chars).select("doc_id", "hash").distinct()
    return (
        pairs.groupBy("hash")
        .agg(
            F.count(F.lit(1)).alias("holders"),
            F.max("doc_id").alias("keeper"),
        )
        .filter(F.col("holders") >= min_docs)
        .select("hash", "keeper")
    )


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """The documents with ``text`` less its shared lines, ``n_lines`` before and ``n_dropped``.

    A line whose key has ``min_chars`` code points or more and is found in ``min_docs`` documents
    or more stays only in the largest doc_id that holds it, there in every place. What is
    left keeps its order. Null or empty text is one empty line and comes back as empty
    text. Rows with one id are one document, each cleaned by itself; equal rows stay equal.
    Other columns pass through; an input column n_lines or n_dropped is replaced.
    """
    # Written first, so that both sides of the join are plain exchanges, whose hot
    # partitions Spark can split.
    keepers = settle(shared_lines(docs, min_chars, min_docs), "keepers")
    found = _hashed_lines(docs, min_chars).join(keepers, "hash")
    dropped = (
        found.filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("row")
        .agg(F.collect_set("pos").alias("drops"))
        .select(F.col("row").alias("drop_row"), "drops")
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    record = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"])
    held = docs.select(record.alias("record"), F.col("text"), row_key().alias("row"))
    joined = held.join(dropped, F.col("row") == F.col("drop_row"), "left").select(
        "record", lines_of(F.col("text")).alias("lines"), F.coalesce("drops", F.array()).alias("drops")
    )
    kept = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops")),
        lambda i: F.get(F.col("lines"), i),
    )
    done = joined.select(
        "record",
        F.array_join(kept, "\n").alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size("drops").cast("long").alias("n_dropped"),
    )
    others = [F.col("text") if c == "text" else F.col("record").getField(c).alias(c) for c in names]
    return done.select(*others, "n_lines", "n_dropped")


def line_dedup_digest(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text."""
    cleaned = dedup_lines(docs.select("doc_id", "text"), min_chars, min_docs)
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


SQL = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, pos, line, keeper IS NOT NULL AND k.doc_id <> keeper AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""
