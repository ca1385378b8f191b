"""Exact duplicates of text units across documents.

Every line with a letter or digit is a unit. So is, inside a line, each sentence of ``sentence_words`` words or more,
which finds passages that stand in the middle of a line. A unit is normalised to its letters and digits in lower case,
so case, spacing and punctuation do not matter, and digested. The earliest occurrence of a digest stays, by doc_id
(null last), then text, then place; every other one is removed. A removed line's sentences may be listed beside it.

Grouping moves digests only, reduced before they move, so a line that every document holds is one row a task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdw.llm.common import slices
from salesdw.staging import Staging

SENTENCE_END = re.compile(r"[.!?]+[\x20\x09\x0B-\x0D]+|\n")
LINE_END = re.compile(r"\n")
NOT_WORD = re.compile(r"[\W_]+")

# Rows of a unit: its document, its number there, its span in characters of the original text, and its digest.
UNIT_SCHEMA = "doc_id bigint, text_hash bigint, unit int, start bigint, length bigint, digest binary"


def with_text_hash(docs: DataFrame, name: str = "text_hash") -> DataFrame:
    """``docs`` and a column ``name``, which tells apart texts under one doc_id; null is empty."""
    return docs.withColumn(name, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))


def document_name(doc_id: str = "doc_id", text_hash: str = "text_hash") -> Column:
    """One text for both parts of a document's key, so that null ids join too."""
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.col(text_hash).cast("string"))


def spans(text: str, end: re.Pattern) -> Iterator[tuple[int, int]]:
    """Where units begin and end, in order; the text between them is kept as it is."""
    at = 0
    for found in end.finditer(text):
        # The closing marks belong to the sentence, the white space after them does not.
        stop = found.start() + len(found.group().rstrip(" \t\n\x0b\x0c\r"))
        if stop > at:
            yield at, stop
        at = found.end()
    if at < len(text):
        yield at, len(text)


def normalised(unit: str) -> str:
    return NOT_WORD.sub(" ", unit.lower()).strip()


def line_units(text: str, min_words: int, sentence_words: int | None) -> Iterator[tuple[int, int, str]]:
    """Span and normalised text of each line that has ``min_words`` and of its sentences, which follow it."""
    for start, stop in spans(text, LINE_END):
        line = text[start:stop]
        whole = normalised(line)
        if not whole:
            continue
        if whole.count(" ") + 1 >= min_words:
            yield start, stop, whole
        if sentence_words is not None and whole.count(" ") + 1 > sentence_words:
            for begin, end in spans(line, SENTENCE_END):
                plain = normalised(line[begin:end])
                if plain.count(" ") + 1 >= sentence_words and plain != whole:
                    yield start + begin, start + end, plain


def units(docs: DataFrame, min_words: int = 1, sentence_words: int | None = 6) -> DataFrame:
    """The units that can be removed, with their original offsets; a null text has none.

    Lines of fewer than ``min_words`` words (1: none) are no units; ``sentence_words=None`` takes lines alone.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[] for _ in range(6)]
            for doc_id, text, own in zip(*(column.to_pylist() for column in batch.columns)):
                for number, (start, stop, plain) in enumerate(line_units(text or "", min_words, sentence_words)):
                    digest = xxhash.xxh3_128_digest(plain.encode())
                    for column, value in zip(found, (doc_id, own, number, start, stop - start, digest)):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(found, kinds)],
                names=["doc_id", "text_hash", "unit", "start", "length", "digest"],
            )

    return with_text_hash(docs.select("doc_id", "text")).mapInArrow(rows, UNIT_SCHEMA)


def rank() -> Column:
    """Order of occurrences, as a struct that compares field by field."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "unit")


def repeated(found: DataFrame) -> DataFrame:
    """Every occurrence but the earliest of each digest, with the kept one: kept_doc_id, kept_unit.

    Rows of ``documents`` that agree in id and text are one document, so their units do not repeat each other.
    """
    first = found.groupBy("digest").agg(F.min(rank()).alias("first"), F.max(rank()).alias("last"))
    copied = first.where("first != last").select("digest", "first")
    joined = found.join(copied, "digest").where(F.col("first") != rank())
    return joined.select(
        "doc_id",
        "text_hash",
        "unit",
        "start",
        "length",
        F.col("first.doc_id").alias("kept_doc_id"),
        F.col("first.unit").alias("kept_unit"),
    ).distinct()


def without_spans(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` (all columns) with the spans (start, length) of ``removed`` cut out of their texts.

    A line whose text is gone goes with its line end. ``n_chars`` follows the text where there is such a column.
    Documents are matched by id and text; columns of ``docs`` keep their order, texts without a span their value.
    """

    def cut(texts: pa.Array, spans_of: pa.Array) -> list[str]:
        done = []
        for text, gone in zip(texts.to_pylist(), spans_of.to_pylist()):
            if text is not None and gone:
                at, parts = 0, []
                for start, length in sorted((one["start"], one["length"]) for one in gone):
                    parts.append(text[at:start])
                    at = max(at, start + length)
                parts.append(text[at:])
                # A line that holds nothing but cuts and blanks goes; other cuts close up.
                mark = next(sign for sign in map(chr, range(0xE000, 0xF900)) if sign not in text)
                lines = [line for line in mark.join(parts).split("\n") if mark not in line or line.replace(mark, "").strip()]
                gaps = re.compile(rf"[ \t]*{mark}[ \t{mark}]*")
                text = "\n".join(gaps.sub(" ", line).strip(" ") if mark in line else line for line in lines)
            done.append(text)
        return done

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts = pa.array(cut(batch.column(1), batch.column(2)), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], names=["row", "text"])

    listed = removed.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "length")).alias("_gone"))
    spots = listed.select(document_name().alias("_key"), "_gone")
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"]).alias("row")
    keyed = docs.select(others, "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    keyed = keyed.withColumn("_key", document_name("row.doc_id", "_hash"))
    joined = keyed.join(spots.hint("shuffle_hash"), "_key", "left").select("row", "text", "_gone")
    result = joined.mapInArrow(rows, T.StructType([joined.schema["row"], T.StructField("text", T.StringType())]))
    values = {name: F.col("text") if name == "text" else F.col(f"row.`{name}`") for name in docs.columns}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(F.col("text").isNull(), F.col("row.n_chars")).otherwise(F.length("text").cast(kind))
    return result.select(*[value.alias(name) for name, value in values.items()])


def remove_repeats(docs: DataFrame, staging: Staging, min_words: int = 1, sentence_words: int | None = 6) -> DataFrame:
    """``docs`` without repeated units; documents themselves all stay, also those that end up empty."""
    found = staging.put(units(docs, min_words, sentence_words), "units")
    return without_spans(docs, repeated(found))
