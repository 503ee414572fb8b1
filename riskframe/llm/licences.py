"""Licence scan by canonical digest: normalise whole texts, hash them, join with known licence digests.

Only built-in column functions: the scan stays one projection and a join with the small licence table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import local_frame
from .common import LOWER, UPPER, ascii_lower, written
from .licence_texts import KNOWN

# Spellings that licence matching treats as the same, rewritten left to right.
SPELLINGS = (
    ("licence", "license"), ("sub-licens", "sublicens"), ("non-commercial", "noncommercial"),
    ("organisation", "organization"), ("authoris", "authoriz"), ("recognis", "recogniz"), ("favour", "favor"),
    ("behaviour", "behavior"), ("fulfil ", "fulfill "), ("copyright owner", "copyright holder"), ("https://", "http://"),
    ("per cent", "percent"),
)
#: A notice of who holds the copyright, at the start of a line: a sign, a year or a holder follows, not another word of a
#: sentence about copyright. It ends with its line or where the licence begins.
NOTICE = (
    r"(?dm)^[ \t*#/;-]*(?:copyright[ \t:,]*(?:\(c\)|©|[0-9]{4})|\(c\)[ \t:,]*(?:copyright|[0-9]{4})|©|copyright[ \t]+"
    r"(?!(?:notices?|holders?|owners?|laws?|licenses?|statements?|interests?|protection|permission|disclaimer|acts?|treat(?:y|ies)"
    r"|and|or|of|in|on|to|is|are|as|for|may|shall|must|can|will|that|which|under|with|infringement)\b)[^ \t\n])"
    r"[^\n]*?(?=\n|\z|\b(?:permission (?:is|to)|redistribution and use|licensed under|released under|mit license"
    r"|this (?:software|program|work|file|library) is)\b)"
)
#: Lines that the oracle drops; on tables where only notices start so, the results agree.
COPYRIGHT_LINE = r"(?m)^[ \t*#/;-]*(copyright|\(c\)|©)[^\n]*$"
#: Whatever is neither a line feed, an ASCII letter or digit nor beyond ASCII; © is punctuation, too.
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F©]+"


def _levelled(text: Column) -> Column:
    """Case, equivalent spellings, copyright notices and punctuation levelled; line feeds stay."""
    out = ascii_lower(F.coalesce(text, F.lit("")))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    out = F.regexp_replace(out, NOTICE, " ")
    return F.regexp_replace(out, PUNCTUATION, " ")


def _digest(levelled: Column) -> Column:
    """Of one text: all white space counts as a single space between words."""
    return F.sha2(F.trim(F.regexp_replace(levelled, r" *\n[ \n]*", " ")), 256)


def digest(text: Column) -> Column:
    return _digest(_levelled(text))


def known_digests(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    """The known licences as digest, license; texts that agree after normalising keep the smallest name."""
    table = local_frame(spark, sorted((known or KNOWN).items()), "license string, text string")
    return written(table.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license").alias("license")), "known")


def scan_licences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: DataFrame | None = None) -> DataFrame:
    """Per row: id, digest of the whole normalised text, license and whole_text (does the digest match one),
    line_licenses: comma-separated names of the licences whose entire text is a single line of the document.

    Null and empty texts, and texts of nothing but punctuation, have the digest of the empty text and no
    licence. Equal rows stay; rows that share an id share the licences found on their lines.
    """
    known = known if known is not None else known_digests(df.sparkSession)
    levelled = df.select(F.col(f"`{id_col}`").alias("id"), _levelled(F.col(f"`{text_col}`")).alias("levelled"))
    lines = levelled.select("id", F.explode(F.array_distinct(F.split("levelled", "\n"))).alias("line"))
    found = lines.select("id", F.sha2(F.trim("line"), 256).alias("digest")).join(known, "digest")
    found = found.groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("license")), ",").alias("line_licenses"))
    rows = levelled.select("id", _digest(F.col("levelled")).alias("digest")).join(known, "digest", "left")
    of = found.select(F.col("id").alias("of"), "line_licenses")
    return rows.join(of, F.col("id").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias(id_col), "digest", "license", F.col("license").isNotNull().alias("whole_text"), "line_licenses")


def oracle() -> str:
    """The same in DuckDB SQL."""

    def level(x: str) -> str:
        out = f"translate(coalesce({x}, ''), '{UPPER}', '{LOWER}')"
        for old, new in SPELLINGS:
            out = f"replace({out}, '{old}', '{new}')"
        out = f"regexp_replace({out}, '{COPYRIGHT_LINE}', ' ', 'g')"
        return f"regexp_replace({out}, '{PUNCTUATION}', ' ', 'g')"

    def hashed(x: str) -> str:
        return f"sha256(trim(regexp_replace({x}, ' *\\n[ \\n]*', ' ', 'g'), ' '))"

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    values = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in sorted(KNOWN.items()))
    return f"""
WITH known AS (SELECT {hashed(level('t'))} AS digest, min(name) AS license FROM (VALUES {values}) v(name, t) GROUP BY 1),
d AS (SELECT doc_id, {level('text')} AS levelled FROM documents),
l AS (SELECT DISTINCT doc_id, unnest(string_split(levelled, chr(10))) AS line FROM d),
f AS (SELECT doc_id, string_agg(license, ',' ORDER BY license) AS line_licenses
      FROM (SELECT DISTINCT doc_id, license FROM l JOIN known ON sha256(trim(line, ' ')) = digest) GROUP BY 1)
SELECT d.doc_id, {hashed('levelled')} AS digest, k.license, k.license IS NOT NULL AS whole_text, f.line_licenses
FROM d LEFT JOIN known k ON {hashed('levelled')} = k.digest LEFT JOIN f ON d.doc_id = f.doc_id"""
