"""Quality rules with cross-document line frequency.

Lines are normalised and hashed; the distinct documents of a host that hold a line
are counted; lines above the limits are removed (``cleaned``); a document that keeps
too little is rejected. Base rules on the text itself come first.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lexing
from .common import null_safe_join, row_key, staged

#: Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

_FOLD = bytes(ord("0") if 48 <= b <= 57 else b for b in range(256))
_PUNCTUATION = string.punctuation.encode()
_SEPARATORS = b" \t\n\r\x0b\x0c"


@dataclass(frozen=True)
class Limits:
    """``min_words`` and ``max_repeat_percent`` are the base rules.

    A line is removed when more than ``line_documents`` distinct documents of its
    host hold it, whatever the size of the host, and, if ``line_percent`` is set, only
    where they are more than that share of the host's distinct documents. A document is depleted when removal leaves fewer than ``min_words``
    words or less than ``left_percent`` of them.
    """

    min_words: int = 20
    max_repeat_percent: int = 30
    line_documents: int = 10
    line_percent: int = 0
    left_percent: int = 30


NAMES = ["doc_id", "host", "key", "copy", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_hash", "line_words"]
FEATURES = (
    "doc_id bigint, host string, key struct<a:bigint,b:int>, copy bigint, n_words bigint, word_chars bigint, "
    "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, line_hash array<bigint>, line_words array<bigint>"
)


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = lexing.encoded(batch.column("text"))
        for begin, end in lexing.blocks(texts):
            part = batch.slice(begin, end - begin)
            columns = [part.column(c) for c in ("doc_id", "host", "key", "copy")]
            yield pa.RecordBatch.from_arrays(columns + _block(texts[begin:end]), names=NAMES)


def _block(texts: list[bytes]) -> list[pa.Array]:
    n = len(texts)
    data, bounds = lexing.layout(texts)
    word = lexing.words(data, bounds)
    n_words = np.bincount(word.text, minlength=n)
    continuation = np.concatenate([[0], np.cumsum((data & 0xC0) == 0x80)])
    chars = (word.end - word.start) - (continuation[word.end] - continuation[word.start])
    word_chars = np.bincount(word.text, weights=chars, minlength=n).astype(np.int64)
    symbols = [len(t) - len(t.translate(None, SYMBOLS)) for t in texts]

    window, whole = lexing.windows(word, 8)
    at = np.flatnonzero(whole)
    starts = np.zeros(len(word.hash), bool)
    starts[at] = lexing.repeated_in_text(window[at], word.text[at])
    covered = lexing.spread(starts, 8, len(word.hash))
    repeats = np.bincount(word.text[covered], minlength=n)

    line = lexing.lines(data, bounds)
    before = np.searchsorted(word.start, line.start)
    within = np.searchsorted(word.start, line.end) - before
    real = within > 0
    joint = np.unique(np.stack([line.text[real].astype(np.uint64), line.hash[real]]), axis=1) if real.any() else np.zeros((2, 0), np.uint64)
    duplicates = np.bincount(line.text[real], minlength=n) - np.bincount(joint[0].astype(np.int64), minlength=n)

    hashes, counts, offsets = _normal_lines(texts)
    return [
        pa.array(n_words, pa.int64()),
        pa.array(word_chars, pa.int64()),
        pa.array(symbols, pa.int64()),
        pa.array(duplicates, pa.int64()),
        pa.array(repeats, pa.int64()),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes.view(np.int64))),
        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(counts, pa.int64())),
    ]


def _line_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Every line that holds a word: text, line number within the text, words, hash of the normalised line.

    Lower case, digits as 0, no ASCII punctuation, words joined by one space. A line
    that holds nothing but punctuation normalises to the empty line, whose words count.
    """
    folded = [t.decode().lower().encode().translate(_FOLD) for t in texts]
    raw, raw_bounds = lexing.layout(folded)
    words = lexing.words(raw, raw_bounds)
    line = lexing.lines(raw, raw_bounds)
    first = np.searchsorted(words.start, line.start)
    count = np.searchsorted(words.start, line.end) - first

    bare = [t.translate(None, _PUNCTUATION) for t in folded]
    data, bounds = lexing.layout(bare)
    normal = lexing.words(data, bounds)
    # Removing punctuation keeps every newline, so a line's number within the block is the same in both.
    breaks_raw = np.flatnonzero(raw == 0x0A)
    breaks = np.flatnonzero(data == 0x0A)
    number = np.searchsorted(breaks_raw, line.start) + line.text
    of_word = np.searchsorted(breaks, normal.start) + normal.text
    held = count > 0
    number, count, text = number[held], count[held], line.text[held]
    begins = np.searchsorted(of_word, number)
    ends = np.searchsorted(of_word, number, side="right")
    place = np.arange(len(of_word)) - np.repeat(begins, ends - begins) if len(of_word) else np.zeros(0, np.int64)
    power = lexing.powers(int(place.max()) + 1 if len(place) else 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(normal.hash * power[place], dtype=np.uint64)])
    hashed = lexing.mix(sums[ends] - sums[begins] + (ends - begins).astype(np.uint64))
    opening = np.searchsorted(breaks_raw, raw_bounds[text]) + text
    return text, number - opening, count, hashed


def _normal_lines(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct normalised lines of each text: hash, words of all its occurrences, list offsets."""
    text, _, count, hashed = _line_hashes(texts)
    order = np.lexsort((hashed, text))
    hashed, text, count = hashed[order], text[order], count[order]
    new = np.ones(len(hashed), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (text[1:] != text[:-1])
    heads = np.flatnonzero(new)
    total = np.add.reduceat(count, heads) if len(heads) else np.zeros(0, np.int64)
    offsets = np.searchsorted(text[heads], np.arange(len(texts) + 1))
    return hashed[heads], total, offsets


def features(documents: DataFrame, host: str = "source") -> DataFrame:
    """One row per document row: base measures and its distinct normalised lines; written to the shared folder."""
    source = documents.select(
        "doc_id",
        F.col(host).alias("host"),
        row_key("doc_id", host, "text").alias("key"),
        F.xxhash64("text").alias("copy"),
        "text",
    )
    return staged(source.mapInArrow(_measures, FEATURES), "line-features")


def frequent_lines(measured: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Lines above the limits: host, line_hash, documents. Exact copies of a text count as one document."""
    distinct = measured.select("host", "copy", "line_hash").dropDuplicates(["host", "copy"])
    sizes = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("host_documents"))
    counts = distinct.select("host", F.explode("line_hash").alias("line_hash")).groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("documents"))
    often = counts.filter(F.col("documents") > limits.line_documents)
    joined = null_safe_join(often, sizes, ["host"])
    return joined.filter(F.col("documents") * 100 > F.col("host_documents") * limits.line_percent).drop("host_documents")


def _judged(documents: DataFrame, limits: Limits, host: str) -> DataFrame:
    """One row per doc_id and key: how many rows they are, measures, verdict, hashes of the removed lines."""
    measured = features(documents, host)
    rare = frequent_lines(measured, limits)
    lines = measured.select("doc_id", "key", "host", F.explode(F.arrays_zip("line_hash", "line_words")).alias("line"))
    lines = lines.select("doc_id", "key", "host", F.col("line.line_hash").alias("line_hash"), F.col("line.line_words").alias("words"))
    hit = null_safe_join(lines, rare, ["host", "line_hash"])
    # Identical rows hit together, so their sums are divided by their number below.
    removed = hit.groupBy("doc_id", "key").agg(F.sum("words").alias("hit_words"), F.count(F.lit(1)).alias("hit_lines"), F.collect_set("line_hash").alias("gone"))
    rows = measured.groupBy("doc_id", "key").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.first(c).alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    )
    judged = null_safe_join(rows, removed, ["doc_id", "key"], "left")
    judged = judged.withColumn("n_removed_words", F.coalesce((F.col("hit_words") / F.col("rows")).cast("bigint"), F.lit(0)))
    judged = judged.withColumn("n_removed_lines", F.coalesce((F.col("hit_lines") / F.col("rows")).cast("bigint"), F.lit(0)))
    left = F.col("n_words") - F.col("n_removed_words")
    failed = (F.col("n_words") < limits.min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * limits.max_repeat_percent)
    depleted = (F.col("n_removed_words") > 0) & ((left < limits.min_words) | (left * 100 < F.col("n_words") * limits.left_percent))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def quality_rules(documents: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """Verdict for every document row.

    Columns: doc_id, key (identity of the row, see ``row_key``), the base measures,
    base_failed, n_removed_words, n_removed_lines (distinct), kept. A null text has no
    words and fails the base rules; a null host is a host of its own; rows that repeat
    a doc_id are judged one by one; exact copies count once in line frequencies. Other
    columns of the input are not read. An empty table gives an empty result.
    """
    judged = _judged(documents, limits, host)
    repeated = judged.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return repeated.select(
        "doc_id", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "n_removed_lines", "kept"
    )


def without_rejected(documents: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """The rows of ``documents`` that the rules keep, columns unchanged."""
    kept = quality_rules(documents, limits, host).filter("kept").select("doc_id", "key").dropDuplicates()
    keyed = documents.withColumn("_quality_key", row_key("doc_id", host, "text"))
    kept = kept.withColumnRenamed("key", "_quality_key")
    return null_safe_join(keyed, kept, ["doc_id", "_quality_key"]).select(*documents.columns)


def _without_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, gone = lexing.encoded(batch.column("text")), batch.column("_gone")
        hit = np.flatnonzero(gone.is_valid().to_numpy(zero_copy_only=False))
        new = dict.fromkeys(range(len(texts)))
        for i in hit:
            _, number, _, hashed = _line_hashes([texts[i]])
            out = set(number[np.isin(hashed.view(np.int64), gone[int(i)].values.to_numpy())].tolist())
            new[i] = b"\n".join(line for k, line in enumerate(texts[i].split(b"\n")) if k not in out).decode()
        kind = batch.schema.field("text").type
        text = pc.if_else(gone.is_valid(), pa.array(list(new.values()), kind), batch.column("text"))
        place = batch.schema.get_field_index("text")
        yield batch.set_column(place, batch.schema.field("text"), text).drop_columns(["_gone"])


def cleaned(documents: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """The rows that the rules keep, their texts without the lines above the limits.

    Lines with no word stay, as do all other columns; a stored length is not counted
    again. The text of a row then holds n_words - n_removed_words words.
    """
    kept = _judged(documents, limits, host).filter("kept").select("doc_id", F.col("key").alias("_quality_key"), F.col("gone").alias("_gone"))
    keyed = documents.withColumn("_quality_key", row_key("doc_id", host, "text"))
    marked = null_safe_join(keyed, kept, ["doc_id", "_quality_key"]).select(*documents.columns, "_gone")
    return marked.mapInArrow(_without_lines, documents.schema)
