"""Line dedup: lines that many documents hold stay only in the document with the largest id.

Every text is split at ``\\n``; a line's key (stripped, A-Z lower-cased) is hashed, distinct documents
are counted per hash, and a key of at least ``min_chars`` code points found in at least ``min_docs``
documents loses its lines everywhere but in the largest id that holds it. What stays is joined again in
order of position. DataFrame operations only; keys are compared by their 128-bit MD5.

Scale: texts are split and hashed once; rows of (id, text hash, position, 16-byte line hash) are counted, a line
that a third of the documents hold spread over its documents first (two-step distinct count). Frequent keys are
written, then joined back; that join's hot side can be split by AQE. Texts shuffle once, to meet the positions that they
lose; the others are taken out by one hash lookup a line, so a text's cost is linear in its lines.

Defined results: null or empty text is one empty line; rows that share an id are one document: counted
once, and each loses the same lines; a row with null id counts for no key and keeps all its lines; an
empty table gives no rows. All lines lost leaves an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import ascii_lower, strip_spaces, written

MIN_CHARS = 40
MIN_DOCS = 5


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hash(line: Column, min_chars: int) -> Column:
    """MD5 of the line's key; null for keys too short to count."""
    key = ascii_lower(strip_spaces(line))
    return F.when(F.char_length(key) >= min_chars, F.unhex(F.md5(key)))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with columns ``_n_lines``, ``_n_dropped`` and ``_kept`` (the text that stays)."""
    text = F.col(text_col)
    # Rows of one id and text are alike: they hold the same lines at the same places.
    tie = F.xxhash64(F.coalesce(text, F.lit("")))
    marked = F.filter(F.transform(lines_of(text), lambda x, i: F.struct(i.alias("at"), line_hash(x, min_chars).alias("hash"))),
                      lambda e: e["hash"].isNotNull())
    held = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_id"), tie.alias("_tie"), F.explode(marked).alias("_line"))
    held = written(held.select("_id", "_tie", F.col("_line.at").alias("_at"), F.col("_line.hash").alias("_hash")), "line-hashes")
    frequent = written(held.groupBy("_hash").agg(F.count_distinct("_id").alias("_docs"), F.max("_id").alias("_last"))
                       .where(F.col("_docs") >= min_docs).select("_hash", "_last"), "frequent-lines")
    lost = (held.join(frequent, "_hash").where(F.col("_id") != F.col("_last"))
            .groupBy("_id", "_tie").agg(F.collect_set("_at").alias("_lost")))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), tie.alias("_tie")).join(lost, ["_id", "_tie"], "left")
    # ``_lines`` and ``_stay`` are columns of their own: inside a lambda they would be made anew for every line.
    rows = rows.select("_row", "_lost", lines_of(F.col(f"_row.{text_col}")).alias("_lines"))
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    rows = rows.select("_row", "_lines", F.when(F.col("_lost").isNotNull(), F.array_except(every, F.col("_lost"))).alias("_stay"))
    kept = F.when(F.col("_stay").isNull(), F.coalesce(F.col(f"_row.{text_col}"), F.lit(""))).otherwise(
        F.concat_ws("\n", F.transform("_stay", lambda i: F.get("_lines", i))))
    n = F.size("_lines").cast("long")
    return rows.select("_row", n.alias("_n_lines"),
                       F.when(F.col("_stay").isNull(), F.lit(0)).otherwise(n - F.size("_stay")).alias("_n_dropped"), kept.alias("_kept"))


def line_report(docs: DataFrame, **how) -> DataFrame:
    """Per document: ``doc_id, n_lines, n_dropped, kept_sha256``."""
    return dedup_lines(docs, **how).select(
        F.col(f"_row.{how.get('id_col', 'doc_id')}").alias("doc_id"), F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").cast("long").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256"))


def without_repeated_lines(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with the lines taken out: same columns, ``text`` and ``n_chars`` renewed where they are."""
    text_col = how.get("text_col", "text")
    new = {text_col: F.when(F.col(f"_row.{text_col}").isNull(), None).otherwise(F.col("_kept")),
           "n_chars": F.char_length("_kept").cast("long")}
    return dedup_lines(docs, **how).select(
        *[new[c].alias(c) if c in new else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
