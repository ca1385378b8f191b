"""Removal of long byte strings that occur more than once, by suffix order.

A byte goes when it is part of a string of ``length`` bytes (UTF-8) that also starts at another place of any
document, its own included; strings never cross documents. Which suffixes share that many bytes is read from the
common prefixes of a collection that is built column by column (``column_bwt``).

One collection of everything would need as many rounds as the longest document has bytes, each over all of it. The
documents are therefore cut into contexts first. Every string of ``length`` bytes has an anchor: of the grams of
``grams[0]`` bytes in it the one with the least hash, the leftmost of equals. Neighbouring strings with one anchor form
a context, some 270 bytes long. Equal strings have equal anchors, so only contexts with equal anchor grams meet. Equal
contexts are counted and go in once; an anchor gram with one context alone needs no comparison, as its strings occur
just as often as the context does. All others go into blocks of whole anchor groups, and each block is one collection.
An anchor with more than ``most`` different contexts, as a very common phrase has, is cut again with longer grams; in
the last round a gram is a whole string, so equal grams are equal contexts. All steps are exact; hashes only bring
strings together, except that contexts of one anchor are held to be equal when their 64-bit digests are.

Null texts are empty. Texts shorter than ``length`` lose nothing, very long ones are cut into overlapping pieces. Rows
that agree in id and text are two documents, so each removes the other's strings. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdw.llm.column_bwt import ColumnwiseIndex
from salesdw.llm.common import utf8
from salesdw.llm.substring import document_name, with_text_hash
from salesdw.staging import Staging

LENGTH = 200
GRAMS = (64, 150, 200)
PIECE_BYTES = 1 << 20
PLACE_BITS = 24  # of a place in the joined pieces
MULTIPLIER = 0x9E3779B97F4A7C15
BYTE_CODES = np.random.default_rng(11).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

RANGES = "array<struct<first:int,last:int>>"


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on, put together from grams of 1, 2, 4, ... bytes."""
    part, width, whole, done = BYTE_CODES[data], 1, None, 0
    while width <= size:
        shift = np.uint64(pow(MULTIPLIER, width, 1 << 64))
        if size & width:
            places = len(data) - done - width + 1
            whole = part[:places] if whole is None else whole[:places] * shift + part[done : done + places]
            done += width
        if 2 * width <= size:
            places = len(data) - 2 * width + 1
            part = part[:places] * shift + part[width : width + places]
        width *= 2
    mixed = whole ^ (whole >> np.uint64(29))
    return mixed * np.uint64(MULTIPLIER)


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    least, reach = values, 1
    while 2 * reach <= width:
        least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
    rest = width - reach
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def contexts(pieces: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """piece, place in it, number of strings, anchor gram's hash and digest of each context of the pieces."""
    data = b"".join(pieces)
    ends = np.cumsum([len(piece) for piece in pieces])
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    hashes = gram_hashes(np.frombuffer(data, np.uint8), gram)
    low_bits = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (hashes & ~low_bits) | np.arange(len(hashes), dtype=np.uint64)
    anchors = (least_in_windows(ranked, length - gram + 1) & low_bits).astype(np.int64)
    for end in ends[:-1].tolist():  # strings across two pieces
        anchors[max(end - length + 1, 0) : end] = -1
    starts = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1])
    stops = np.append(starts[1:], len(anchors))
    real = anchors[starts] >= 0
    starts, stops = starts[real], stops[real]
    view, extra = memoryview(data), length - 1
    digests = [xxhash.xxh3_64_intdigest(view[a : b + extra]) for a, b in zip(starts.tolist(), stops.tolist())]
    piece = np.searchsorted(ends, starts, "right")
    place = starts - (ends[piece] - np.array([len(one) for one in pieces])[piece])
    return piece, place, stops - starts, hashes[anchors[starts]].view(np.int64), np.array(digests, np.uint64).view(np.int64)


def in_pieces(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in portions of bounded size: number of the text, where the piece starts in it, and the piece."""
    numbers: list[int] = []
    starts: list[int] = []
    pieces: list[bytes] = []
    size = 0
    for number, text in enumerate(texts):
        if len(text) < length:
            continue
        for start in range(0, len(text) - length + 1, PIECE_BYTES):
            piece = text[start : start + PIECE_BYTES + length - 1]
            numbers.append(number)
            starts.append(start)
            pieces.append(piece)
            size += len(piece)
            if size >= PIECE_BYTES:
                yield numbers, starts, pieces
                numbers, starts, pieces, size = [], [], [], 0
    if pieces:
        yield numbers, starts, pieces


def document_contexts(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """doc_id, text_hash, place, strings, anchor, digest: the contexts of all documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, starts, pieces in in_pieces(utf8(batch.column(1)), length):
                piece, place, strings, anchor, digest = contexts(pieces, length, gram)
                row = pa.array(np.array(numbers)[piece])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(row),
                        batch.column(2).take(row),
                        pa.array(place + np.array(starts)[piece]),
                        pa.array(strings.astype(np.int32)),
                        pa.array(anchor),
                        pa.array(digest),
                    ],
                    names=["doc_id", "text_hash", "place", "strings", "anchor", "digest"],
                )

    schema = "doc_id bigint, text_hash bigint, place bigint, strings int, anchor bigint, digest bigint"
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return with_text_hash(named).mapInArrow(rows, schema)


def context_texts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """anchor, digest, copies, content of the ``wanted`` contexts (which also have doc_id, text_hash, place, strings)."""
    entry = F.struct("place", "strings", "anchor", "digest", "copies")
    lists = wanted.groupBy(document_name().alias("_key")).agg(F.collect_list(entry).alias("wanted"))
    named = with_text_hash(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    texts = named.select(document_name().alias("_key"), "text")
    joined = texts.join(lists.hint("shuffle_hash"), "_key").select("text", "wanted")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, chosen in zip(utf8(batch.column(0)), batch.column(1)):
                fields = chosen.values.flatten()
                place, strings = fields[0].to_pylist(), fields[1].to_pylist()
                content = [text[a : a + n + length - 1] for a, n in zip(place, strings)]
                yield pa.RecordBatch.from_arrays(
                    [*fields[2:], pa.array(content, pa.binary())], names=["anchor", "digest", "copies", "content"]
                )

    return joined.mapInArrow(rows, "anchor bigint, digest bigint, copies bigint, content binary")


def compare_in_blocks(found: DataFrame, length: int, block_bytes: int) -> DataFrame:
    """anchor, digest, ranges: the strings of each context that also start elsewhere, for contexts that have any.

    ``found`` has whole anchor groups: anchor, digest, copies, content. Rows of equal anchor and digest count once.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        block: list[tuple] = []
        size = 0
        for batch in batches:
            for entry in zip(*(column.to_pylist() for column in batch.columns)):
                if group and entry[0] != group[-1][0]:
                    block += group
                    group = []
                    if size >= block_bytes:
                        yield compared(block)
                        block, size = [], 0
                if not group or entry[1] != group[-1][1]:
                    group.append(entry)
                    size += len(entry[3])
        if group:
            yield compared(block + group)

    def compared(block: list[tuple]) -> pa.RecordBatch:
        repeated = ColumnwiseIndex([content for *_, content in block], length).repeated(length)
        made = []
        for (anchor, digest, copies, content), starts in zip(block, repeated):
            if copies > 1:
                ranges = [{"first": 0, "last": len(content) - length}]
            elif len(starts):
                cuts = np.flatnonzero(np.diff(starts) > 1)
                first, last = starts[np.append(0, cuts + 1)], starts[np.append(cuts, len(starts) - 1)]
                ranges = [{"first": a, "last": b} for a, b in zip(first.tolist(), last.tolist())]
            else:
                continue
            made.append({"anchor": anchor, "digest": digest, "ranges": ranges})
        return pa.RecordBatch.from_pylist(made, schema=layout)

    span = pa.struct([("first", pa.int32()), ("last", pa.int32())])
    layout = pa.schema([("anchor", pa.int64()), ("digest", pa.int64()), ("ranges", pa.list_(span))])
    grouped = found.select("anchor", "digest", "copies", "content").repartition("anchor")
    return grouped.sortWithinPartitions("anchor", "digest").mapInArrow(rows, f"anchor bigint, digest bigint, ranges {RANGES}")


def cut_contexts(found: DataFrame, length: int, gram: int) -> DataFrame:
    """The contexts of longer grams inside those of ``found``: anchor, digest, place and new_anchor, new_digest, ..."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(3).to_pylist()
            for numbers, starts, pieces in in_pieces(whole, length):
                piece, place, strings, anchor, digest = contexts(pieces, length, gram)
                row = pa.array(np.array(numbers)[piece])
                inner = [pieces[p][a : a + n + length - 1] for p, a, n in zip(piece.tolist(), place.tolist(), strings.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(number).take(row) for number in range(3)],
                        pa.array(place.astype(np.int32)),
                        pa.array(anchor),
                        pa.array(digest),
                        pa.array(inner, pa.binary()),
                    ],
                    names=["anchor", "digest", "copies", "place", "new_anchor", "new_digest", "content"],
                )

    return found.select("anchor", "digest", "copies", "content").mapInArrow(
        rows,
        "anchor bigint, digest bigint, copies bigint, place int, new_anchor bigint, new_digest bigint, content binary",
    )


def repeated_ranges(
    found: DataFrame, staging: Staging, length: int, grams: tuple[int, ...], most: int, block_bytes: int
) -> DataFrame:
    """anchor, digest, ranges for different contexts ``found`` (anchor, digest, copies, content) that share anchors."""
    sizes = found.groupBy("anchor").agg(F.count_distinct("digest").alias("contexts"))
    crowded = staging.put(sizes.where(F.col("contexts") > most).select("anchor"), "crowded-anchors")
    if not grams or crowded.isEmpty():
        return compare_in_blocks(found, length, block_bytes)
    plain = compare_in_blocks(found.join(crowded, "anchor", "left_anti"), length, block_bytes)
    hot = found.join(crowded, "anchor", "left_semi").dropDuplicates(["anchor", "digest"])
    inner = staging.put(cut_contexts(hot, length, grams[0]), "inner-contexts")
    again = inner.groupBy(F.col("new_anchor").alias("anchor"), F.col("new_digest").alias("digest")).agg(
        F.sum("copies").alias("copies"), F.any_value("content").alias("content")
    )
    again = staging.put(again, "inner-distinct")
    lone, several = with_company(again, staging)
    alone = lone.select("anchor", "digest", F.octet_length("content").alias("size")).select(
        "anchor", "digest", whole_range(F.col("size") - length + 1)
    )
    solved = alone.unionByName(repeated_ranges(several, staging, length, grams[1:], most, block_bytes))
    names = [F.col(name).alias(f"new_{name}") for name in ("anchor", "digest")]
    back = inner.drop("content").join(solved.select(*names, "ranges"), ["new_anchor", "new_digest"])
    shifted = F.transform(
        "ranges",
        lambda one: F.struct((one["first"] + F.col("place")).alias("first"), (one["last"] + F.col("place")).alias("last")),
    )
    lists = back.groupBy("anchor", "digest").agg(F.flatten(F.collect_list(shifted)).alias("ranges"))
    return plain.unionByName(lists)


def whole_range(strings: Column) -> Column:
    return F.array(F.struct(F.lit(0).alias("first"), (strings - 1).cast("int").alias("last"))).alias("ranges")


def with_company(distinct: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """Contexts that are the only ones of their anchor and have copies, and those whose anchor has others."""
    ends = distinct.groupBy("anchor").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    # Written, so that each join has two shuffles of its own and a hot anchor's side can be split.
    shared = staging.put(ends.where("low != high").select("anchor"), "shared-anchors")
    lone = distinct.where("copies > 1").join(shared, "anchor", "left_anti")
    return lone, distinct.join(shared.hint("shuffle_hash"), "anchor", "left_semi")


def repeated_spans(
    docs: DataFrame,
    staging: Staging,
    length: int = LENGTH,
    grams: tuple[int, ...] = GRAMS,
    most: int = 4000,
    block_bytes: int = 1 << 18,
) -> DataFrame:
    """doc_id, text_hash, start, length of byte spans to remove; they may overlap. Matched to texts by id and hash."""
    found = staging.put(document_contexts(docs, length, grams[0]), "contexts")
    twice = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    twice = staging.put(twice, "met-anchors")
    met = staging.put(found.join(twice.hint("shuffle_hash"), "anchor", "left_semi"), "met-contexts")
    first = F.min(F.struct("doc_id", "text_hash", "place", "strings")).alias("first")
    distinct = met.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("copies"), first)
    distinct = staging.put(distinct.select("anchor", "digest", "copies", "first.*"), "distinct-contexts")
    lone, several = with_company(distinct, staging)
    texts = staging.put(context_texts(docs, several, length), "context-texts")
    solved = repeated_ranges(texts, staging, length, grams[1:], most, block_bytes)
    ranges = lone.select("anchor", "digest", whole_range(F.col("strings"))).unionByName(solved)
    back = met.join(ranges, ["anchor", "digest"]).select("doc_id", "text_hash", "place", F.inline("ranges"))
    return back.select(
        "doc_id", "text_hash", (F.col("place") + F.col("first")).alias("start"), (F.expr("last - first") + length).cast("bigint").alias("length")
    )


def without_repeats(docs: DataFrame, staging: Staging, carry: list[str] | None = None, **settings) -> DataFrame:
    """One row per row of ``docs``: ``row`` (a struct of its ``carry`` columns, all by default), n_bytes, spans, kept.

    ``spans`` are the maximal removed runs of bytes in order, ``kept`` the other bytes; these need not be whole
    characters. ``settings`` are those of ``repeated_spans``.
    """
    spans = repeated_spans(docs, staging, **settings)
    lists = spans.groupBy(document_name().alias("_key")).agg(F.collect_set(F.struct("start", "length")).alias("_gone"))
    kept_row = F.struct(*[F.col(f"`{name}`") for name in (docs.columns if carry is None else carry)]).alias("row")
    rows_of = docs.select(kept_row, "text", F.col("doc_id").alias("_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"))
    keyed = rows_of.withColumn("_key", document_name("_id", "_hash")).select("row", "text", "_key")
    joined = keyed.join(lists.hint("shuffle_hash"), "_key", "left").select("row", "text", "_gone")

    def merged(gone: pa.ListScalar) -> list[tuple[int, int]]:
        if not gone.is_valid:
            return []
        start, size = (field.to_numpy() for field in gone.values.flatten())
        order = np.argsort(start, kind="stable")
        start, reach = start[order], np.maximum.accumulate((start + size)[order])
        fresh = np.append(True, start[1:] > reach[:-1])
        return list(zip(start[fresh].tolist(), reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(start) - 1)].tolist()))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans_of, kept = [], [], []
            for text, gone in zip(utf8(batch.column(1)), batch.column(2)):
                runs, at, parts = merged(gone), 0, []
                for start, stop in runs:
                    parts.append(text[at:start])
                    at = stop
                kept.append(b"".join([*parts, text[at:]]))
                sizes.append(len(text))
                spans_of.append([{"start": start, "length": stop - start} for start, stop in runs])
            span = pa.struct([("start", pa.int64()), ("length", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans_of, pa.list_(span)), pa.array(kept, pa.binary())],
                names=["row", "n_bytes", "spans", "kept"],
            )

    span_type = T.ArrayType(T.StructType().add("start", "long").add("length", "long"))
    schema = T.StructType([joined.schema["row"]]).add("n_bytes", "long").add("spans", span_type).add("kept", "binary")
    return joined.mapInArrow(rows, schema)
