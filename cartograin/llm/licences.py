"""Licence scan by canonical digest.

A text is reduced to a canonical form in which legally equal wordings agree, and the
digest of the entire form is looked up among the digests of known licences. Everything
is a DataFrame expression; the catalogue is reduced by the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .licence_texts import LICENCES, NOTICES

# Spellings that count as the same, by the form they are brought to.
WORDS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "sublicence": "sublicense",
    "merchantibility": "merchantability",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
    "http": "https",
}
PHRASES = {
    "sub license": "sublicense",
    "non infringement": "noninfringement",
    "per cent": "percent",
    "copyright owner": "copyright holder",
    "copyright owners": "copyright holders",
}

# Java patterns; lines end at newlines only.
#: A line that only states who holds the rights.
COPYRIGHT_LINE = (
    r"^[^\p{L}\p{N}\n]*(?:copyright[ \t]*(?:\(c\)|©|\d{4}|<|\[).*|(?:\(c\)|©)[ \t]*\d{4}.*"
    r"|portions copyright.*|all rights reserved[.]?[ \t]*)$"
)
#: Marks at the start of a list item or comment line.
BULLET = r"^[ \t]*(?:[-*#/;>]+|\(?(?:\d{1,2}|[a-z])[.)])[ \t]+"


def canonical_lines(text: Column) -> Column:
    """Canonical form with lines kept: lines joined by `` \\n ``.

    Copyright lines and list marks go, case is lowered, only words stay, equivalent
    spellings become one.
    """
    form = F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit(""))
    form = F.regexp_replace(form, "(?dim)" + COPYRIGHT_LINE, "")
    form = F.lower(F.regexp_replace(form, "(?dm)" + BULLET, " "))
    form = F.replace(F.regexp_replace(form, r"[^\p{L}\p{N}\n]+", " "), F.lit("\n"), F.lit(" \n "))
    respelled = F.create_map(*[F.lit(x) for pair in WORDS.items() for x in pair])
    form = F.array_join(F.transform(F.split(form, " +"), lambda w: F.coalesce(respelled[w], w)), " ")
    return _phrases(form)


def _phrases(form: Column) -> Column:
    form = F.concat(F.lit(" "), form, F.lit(" "))
    for phrase, norm in PHRASES.items():
        form = F.replace(form, F.lit(f" {phrase} "), F.lit(f" {norm} "))
    return F.trim(form)


def canonical(lines: Column) -> Column:
    """The whole text's form, from that of its lines."""
    return _phrases(F.array_join(F.filter(F.split(lines, "[ \n]+"), lambda w: w != ""), " "))


def digest(form: Column) -> Column:
    return F.sha2(form.cast("binary"), 256)


def catalogue(spark: SparkSession, known: list[tuple[str, str]], whole: bool) -> DataFrame:
    """Digest and identifier of each known text; as small as the list it is given."""
    texts = spark.createDataFrame(known, "licence string, text string")
    form = canonical_lines(F.col("text"))
    return texts.select(digest(canonical(form) if whole else form).alias("digest"), "licence").dropDuplicates(["digest"])


def licence_scan(
    documents: DataFrame, licences: list[tuple[str, str]] = LICENCES, notices: list[tuple[str, str]] = NOTICES
) -> DataFrame:
    """Per document row: doc_id, digest, licence, notices.

    ``digest`` is SHA-256 (hex) of the entire text's canonical form; ``licence`` the
    identifier whose text has this digest, or null; ``notices`` the identifiers, sorted
    and joined by commas, of lines that are entirely a known notice, or an empty string.
    Null and empty texts have the digest of the empty form and no licence; rows that
    repeat a doc_id are scanned one by one; other columns are not read.
    """
    spark = documents.sparkSession
    rows = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", canonical_lines(F.col("text")).alias("form"))
    whole = F.broadcast(catalogue(spark, licences, whole=True))
    line = F.broadcast(catalogue(spark, notices, whole=False).withColumnRenamed("licence", "notice"))
    rows = rows.select("row", "doc_id", digest(canonical(F.col("form"))).alias("digest"), F.array_distinct(F.split("form", " \n ")).alias("lines"))
    rows = rows.join(whole, "digest", "left")
    lines = rows.select("row", "doc_id", F.col("digest").alias("whole"), "licence", F.explode("lines").alias("line"))
    lines = lines.withColumn("digest", digest(F.trim("line"))).drop("line")
    found = lines.join(line, "digest", "left")
    gathered = found.groupBy("row", "doc_id", "whole", "licence").agg(F.array_sort(F.collect_set("notice")).alias("notices"))
    return gathered.select("doc_id", F.col("whole").alias("digest"), "licence", F.array_join("notices", ",").alias("notices"))
