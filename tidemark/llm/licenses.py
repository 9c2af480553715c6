"""Licence scans by canonical digests.

Texts are brought to one form: lower case, equivalent spellings made equal, copyright lines
dropped, everything but letters, digits and line ends turned into single spaces.  Digests of
the whole text and of each line are hash-joined with those of known licences.  Only
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.columns import whole
from tidemark.llm.license_texts import EQUIVALENTS, KNOWN

COPYRIGHT_LINE = (
    r"^[^\n\p{L}\p{N}]*(copyright\s*(\(c\)|©|<|\[|[0-9]{4})|(\(c\)|©)\s*[0-9<\[]|all rights reserved\.?\s*$)[^\n]*$"
)
BROADCAST_ROWS = 100_000


def canonical(text: Column) -> Column:
    """The canonical form with its line ends."""
    out = F.lower(text)
    for pattern, by in EQUIVALENTS:
        out = F.regexp_replace(out, pattern, by)
    out = F.regexp_replace(out, "(?md)" + COPYRIGHT_LINE, "")
    return F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")


def _one_line(canon: Column) -> Column:
    return F.btrim(F.regexp_replace(canon, r"[ \n]+", " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license_id) of the known texts; of equal texts the first id by name."""
    rows = spark.createDataFrame(known or list(KNOWN), "license_id string, text string")
    return (
        rows.select(F.md5(_one_line(canonical(F.col("text"))).cast("binary")).alias("digest"), "license_id")
        .groupBy("digest")
        .agg(F.min("license_id").alias("license_id"))
    )


def scan(docs: DataFrame, known: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: what its whole text is, and which licences single lines state.

    Columns: doc_id, whole_license (null if the text as a whole is no known licence),
    n_license_lines, line_licenses (ids in order, joined by commas; empty for none) and
    n_lines (lines with a letter or digit after normalising).  A null or empty text has no
    lines and no licence.  Repeated rows are scanned each on its own; other columns of
    ``docs`` are not read.
    """
    given = known if known is not None else known_digests(docs.sparkSession)
    given = given.select(F.col("digest").alias("_digest"), "license_id")
    if known is None or given.count() <= BROADCAST_ROWS:
        given = F.broadcast(given)
    canon = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.monotonically_increasing_id().alias("_row"),
        canonical(whole(F.col(text))).alias("_c"),
    )
    pieces = canon.select(
        "doc_id",
        "_row",
        F.posexplode(F.concat(F.array(_one_line(F.col("_c"))), F.split("_c", "\n", -1))).alias("_at", "_piece"),
    ).select("doc_id", "_row", "_at", F.btrim("_piece").alias("_piece"))
    # An empty text keeps its whole-text piece, so every document has a row to group.
    pieces = pieces.filter("_at = 0 OR _piece <> ''")
    found = pieces.join(given, F.md5(F.col("_piece").cast("binary")) == F.col("_digest"), "left")
    in_line = F.col("_at") > 0
    return (
        found.groupBy("_row", "doc_id")
        .agg(
            F.max(F.when(~in_line, F.col("license_id"))).alias("whole_license"),
            F.count(F.when(in_line, F.col("license_id"))).alias("n_license_lines"),
            F.array_join(F.sort_array(F.collect_set(F.when(in_line, F.col("license_id")))), ",").alias("line_licenses"),
            F.count(F.when(in_line, 1)).alias("n_lines"),
        )
        .drop("_row")
    )


def _sql_canonical(column: str) -> str:
    quote = lambda x: x.replace("'", "''")
    out = f"lower({column})"
    for pattern, by in EQUIVALENTS:
        out = f"regexp_replace({out}, '{quote(pattern)}', '{quote(by).replace("$", chr(92))}', 'g')"
    out = f"regexp_replace({out}, '(?m){quote(COPYRIGHT_LINE)}', '', 'g')"
    return rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"


def _sql_known() -> str:
    quote = lambda x: x.replace("'", "''")
    rows = ", ".join(f"('{name}', '{quote(text)}')" for name, text in KNOWN)
    one = rf"trim(regexp_replace({_sql_canonical('text')}, '[ \n]+', ' ', 'g'))"
    return f"SELECT min(id) AS id, {one} AS piece FROM (VALUES {rows}) AS v(id, text) GROUP BY 2"


ORACLE = rf"""
WITH k AS ({_sql_known()}),
c AS (SELECT doc_id, {_sql_canonical("coalesce(text, '')")} AS c FROM documents),
l AS (SELECT doc_id, trim(unnest(string_split(c, chr(10)))) AS piece FROM c),
a AS (
  SELECT doc_id, count(k.id) AS n_license_lines, count(*) AS n_lines,
         coalesce(string_agg(DISTINCT k.id, ',' ORDER BY k.id), '') AS line_licenses
  FROM l LEFT JOIN k ON k.piece = l.piece WHERE l.piece <> '' GROUP BY doc_id)
SELECT c.doc_id, k.id AS whole_license, coalesce(n_license_lines, 0)::BIGINT AS n_license_lines,
       coalesce(line_licenses, '') AS line_licenses, coalesce(n_lines, 0)::BIGINT AS n_lines
FROM c LEFT JOIN k ON k.piece = trim(regexp_replace(c.c, '[ \n]+', ' ', 'g')) LEFT JOIN a ON a.doc_id = c.doc_id
"""
