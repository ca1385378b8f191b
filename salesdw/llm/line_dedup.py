"""Line dedup within one edit, by a deletion-neighbourhood join.

Lines are normalised (lower case, single blanks). Two lines match when they are equal or one insertion, deletion or
replacement of a character apart. A line goes when an earlier line matches it, whether or not that one stays; order
is doc_id (null last), text, place. Blank lines stay, and lines of fewer than ``min_chars`` characters.

A line of n characters has n variants with one character deleted. They are emitted only where they can meet:
one edit leaves two thirds of a line as they were, so different lines are first brought together by a digest of all but
each third (cut by the length of the shorter line of a pair), and only lines that share such a frame with another line
emit the variants of the open third. These lines are numbered in order, so that only numbers move with the variants.
Variants are keyed with the place of the deleted character. Lines of one key differ in that place alone, so each is
within the bound of the earliest of them, which is its witness; no pairs are formed. A variant that is a line itself
pairs with the earliest line it comes from. Witnesses are verified by edit distance.

Equal lines are found by 128-bit digests. Frames and variants have 64-bit keys, which only bring lines together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdw.llm.common import slices
from salesdw.llm.substring import LINE_END, document_name, rank, spans, with_text_hash, without_spans
from salesdw.operators.ordering import number_rows
from salesdw.staging import Staging

LINE_SCHEMA = (
    "doc_id bigint, text_hash bigint, unit int, start bigint, length bigint, digest binary, frames array<bigint>"
)
PARTS = 3
PLACE = ["doc_id", "text_hash", "unit"]


def normalised(line: str) -> str:
    return " ".join(line.lower().split())


def signed(data: bytes, seed: int = 0) -> int:
    value = xxhash.xxh64_intdigest(data, seed)
    return value - (1 << 64) if value >> 63 else value


def frame_keys(code: bytes) -> Iterator[tuple[int, int, int]]:
    """Key, beginning and end of the open part of each frame of a normalised line in UTF-32.

    A line of n characters pairs with lines of n and n + 1 by the cuts for n, and with n - 1 by those for n - 1.
    """
    n = len(code) // 4
    for shorter in (n, n - 1):
        for part in range(PARTS):
            begin, rest = shorter * part // PARTS, shorter - shorter * (part + 1) // PARTS
            frame = code[: 4 * begin] + code[4 * (n - rest) :]
            yield signed(frame, PARTS * shorter + part), begin, n - rest


def lines(docs: DataFrame, min_chars: int = 1) -> DataFrame:
    """The lines that take part: place, span in the original text, digest and frame keys; a null text has none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            found: list[list] = [[] for _ in range(7)]
            for doc_id, text, own in zip(*(column.to_pylist() for column in batch.columns)):
                for number, (start, stop) in enumerate(spans(text or "", LINE_END)):
                    plain = normalised(text[start:stop])
                    if len(plain) < min_chars:
                        continue
                    code = plain.encode("utf-32-le")
                    frames = [key for key, _, _ in frame_keys(code)]
                    digest = xxhash.xxh3_128_digest(code)
                    for column, value in zip(found, (doc_id, own, number, start, stop - start, digest, frames)):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
            names = ["doc_id", "text_hash", "unit", "start", "length", "digest", "frames"]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(found, kinds)], names=names)

    return with_text_hash(docs.select("doc_id", "text")).mapInArrow(rows, LINE_SCHEMA)


def suspects(firsts: DataFrame, staging: Staging) -> DataFrame:
    """line, first, shared: the different lines that share a frame with another one, numbered in order of their first
    place, and the keys of those frames. ``firsts`` has digest, first and frames, one row per digest."""
    frames = firsts.select(F.explode("frames").alias("frame"), F.xxhash64("digest").alias("own"))
    ends = frames.groupBy("frame").agg(F.min("own").alias("low"), F.max("own").alias("high"))
    # Written, so that the join has two shuffles of its own and a frame of many lines can be split.
    shared = staging.put(ends.where("low != high").select("frame"), "shared-frames")
    mine = frames.join(shared.hint("shuffle_hash"), "frame", "left_semi").groupBy("own").agg(F.collect_set("frame").alias("shared"))
    chosen = firsts.select("first", F.xxhash64("digest").alias("own")).join(mine, "own").select("first", "shared")
    return number_rows(chosen, ["first"], "line", staging)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """line, plain (the normalised text) and shared of the ``wanted`` lines (PLACE, line, shared)."""
    lists = wanted.select(document_name().alias("_key"), F.struct("unit", "line", "shared").alias("entry"))
    lists = lists.groupBy("_key").agg(F.collect_list("entry").alias("entries"))
    keyed = with_text_hash(docs.select("doc_id", "text"))
    # Repeated rows of a document bring the same lines again; one row per line is kept below.
    texts = keyed.select(document_name().alias("_key"), "text")
    joined = texts.join(lists.hint("shuffle_hash"), "_key").select("text", "entries")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            numbers, texts, shared = [], [], []
            for text, chosen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                places = {entry["unit"]: entry for entry in chosen}
                for number, (start, stop) in enumerate(spans(text, LINE_END)):
                    if number in places:
                        numbers.append(places[number]["line"])
                        texts.append(normalised(text[start:stop]))
                        shared.append(places[number]["shared"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), pa.array(texts, pa.string()), pa.array(shared, pa.list_(pa.int64()))],
                names=["line", "plain", "shared"],
            )

    return joined.mapInArrow(rows, "line bigint, plain string, shared array<bigint>").dropDuplicates(["line"])


def variants(texts: DataFrame) -> DataFrame:
    """(variant, place, line): each line with one character of an open third deleted, once a place.

    ``place`` is -1 for the line itself, to be met by variants of lines one character longer.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line, plain, shared in zip(*(column.to_pylist() for column in batch.columns)):
                code, known = plain.encode("utf-32-le"), set(shared)
                open_places = {at for key, begin, end in frame_keys(code) if key in known for at in range(begin, end)}
                places = sorted(open_places)
                made = [signed(code[: 4 * at] + code[4 * at + 4 :]) for at in places] + [signed(code)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made), pa.array([*places, -1], pa.int32()), pa.array([line] * len(made), pa.int64())],
                    names=["variant", "place", "line"],
                )

    return texts.mapInArrow(rows, "variant bigint, place int, line bigint")


def near_witnesses(docs: DataFrame, firsts: DataFrame, staging: Staging) -> DataFrame:
    """first and witness (first places): an earlier line exactly one edit away, for the lines that have one."""
    chosen = staging.put(suspects(firsts, staging), "suspects")
    texts = staging.put(_texts(docs, chosen.select("first.*", "line", "shared")), "suspect-texts")
    emitted = staging.put(variants(texts), "variants")
    deleted, whole = emitted.where("place >= 0"), emitted.where("place < 0").select("variant", F.col("line").alias("shorter"))
    ends = deleted.groupBy("variant", "place").agg(F.min("line").alias("witness"), F.max("line").alias("last"))
    ends = staging.put(ends.where("witness != last").drop("last"), "replaced")
    replaced = deleted.join(ends, ["variant", "place"])
    longest = deleted.groupBy("variant").agg(F.min("line").alias("longer"))
    # A line against the earliest line that it is a variant of, and every such line against it.
    of_longer = longest.join(whole, "variant").select(F.col("shorter").alias("line"), F.col("longer").alias("witness"))
    of_shorter = deleted.join(whole, "variant").select("line", F.col("shorter").alias("witness"))
    met = replaced.select("line", "witness").unionByName(of_longer).unionByName(of_shorter)
    earlier = met.where("witness < line").distinct()
    plain = texts.select("line", "plain")
    other = plain.select(F.col("line").alias("witness"), F.col("plain").alias("_plain"))
    checked = earlier.join(plain, "line").join(other, "witness")
    within = checked.where(F.levenshtein("plain", "_plain", 1) == 1).groupBy("line").agg(F.min("witness").alias("witness"))
    place = chosen.select("line", "first")
    named = within.join(place, "line").select("first", F.col("witness").alias("line"))
    return named.join(place.withColumnRenamed("first", "_witness"), "line").select("first", F.col("_witness").alias("witness"))


def matching_lines(docs: DataFrame, staging: Staging, min_chars: int = 1) -> DataFrame:
    """One row per line that goes: PLACE, its span (start, length), kept_doc_id, kept_unit and edits (0 or 1).

    ``kept`` is the earliest equal line, or for the earliest of equal lines the earliest line one edit away. Rows of
    ``docs`` that agree in id and text are one document. An empty table, null and blank texts give no rows.
    """
    found = staging.put(lines(docs, min_chars), "lines")
    # One row per digest; copies of a line bring their frames no further than the first shuffle.
    earliest = F.min(F.struct(rank().alias("place"), "frames")).alias("earliest")
    firsts = found.groupBy("digest").agg(earliest, F.max(rank()).alias("last"))
    firsts = staging.put(firsts.select("digest", "earliest.place", "last", "earliest.frames").withColumnRenamed("place", "first"), "firsts")
    near = near_witnesses(docs, firsts.select("digest", "first", "frames"), staging)
    marked = firsts.drop("frames").join(near, "first", "left").where("first != last or witness is not null")
    marked = staging.put(marked.select("digest", "first", "witness"), "marked")
    occurrences = found.drop("frames").join(marked, "digest")
    gone = occurrences.where((rank() != F.col("first")) | F.col("witness").isNotNull())
    equal = rank() != F.col("first")
    kept = F.when(equal, F.col("first")).otherwise(F.col("witness"))
    return gone.select(
        *PLACE,
        "start",
        "length",
        kept["doc_id"].alias("kept_doc_id"),
        kept["unit"].alias("kept_unit"),
        F.when(equal, 0).otherwise(1).alias("edits"),
    ).distinct()


def remove_lines(docs: DataFrame, staging: Staging, min_chars: int = 1) -> DataFrame:
    """``docs`` without matching lines; documents themselves all stay, also those that end up empty."""
    return without_spans(docs, matching_lines(docs, staging, min_chars))
