"""Periodic runs of words, by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period q, at least max(``least``, ``repeats`` * q) words long, that
no neighbouring word extends. Each word of a run therefore occurs at least ``repeats`` times in it. So a word that is
rarer than that in the current segment is in no run of it and splits it; the parts are split again by their own
counts until nothing changes. A text without runs soon falls apart, and only the segments that survive are scanned
for equal words q apart, for each lag q that fits. A stretch found at lag q is a run unless a divisor of q, tried
before, has given the same stretch. At lag q only every q-th place is probed, as a run covers at least ``repeats`` of them,
and places inside a run of a divisor are passed over; so the scan takes about n log n steps for n words.

Rows are independent, so there is no shuffle, and a hot source or many copies burden no task more than others.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesdw.llm.common import utf8

LEAST, REPEATS = 6, 4
Run = tuple[int, int, int]  # start, length, period

RUN_TYPE = T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long"))


def surviving_segments(words: list[bytes], least: int = LEAST, repeats: int = REPEATS) -> list[tuple[int, int]]:
    """Segments (start, stop) in which every word occurs ``repeats`` times or more, in order."""
    stable: list[tuple[int, int]] = []
    open_segments = [(0, len(words))]
    while open_segments:
        start, stop = open_segments.pop()
        if stop - start < least:
            continue
        segment = words[start:stop] if stop - start < len(words) else words
        counts = Counter(segment)
        rare = [place for place, word in enumerate(segment, start) if counts[word] < repeats]
        if not rare:
            stable.append((start, stop))
            continue
        before = start
        for place in rare:
            if place - before >= least:
                open_segments.append((before, place))
            before = place + 1
        if stop - before >= least:
            open_segments.append((before, stop))
    return sorted(stable)


def runs_of_segment(codes: np.ndarray, least: int = LEAST, repeats: int = REPEATS) -> list[Run]:
    """The runs of a segment of word numbers."""
    size = len(codes)
    found: list[Run] = []
    by_period: dict[int, list[tuple[int, int]]] = {}
    for lag in range(1, size // repeats + 1):
        probes = np.arange(0, size - lag, lag)
        equal = codes[probes] == codes[probes + lag]
        if repeats > 2:  # a run covers three probes in a row
            equal = equal[:-1] & equal[1:]
        hits = probes[: len(equal)][equal]
        if not len(hits):
            continue
        known = sorted(span for period, spans in by_period.items() if lag % period == 0 for span in spans)
        reached, passed = 0, 0
        while passed < len(hits):
            hit = int(hits[passed])
            passed += 1
            if hit < reached:
                passed = int(np.searchsorted(hits, reached))
                continue
            cover = next((stop for start, stop in known if start <= hit and hit + lag < stop), 0)
            if cover:
                reached = cover - lag
                continue
            start, stop = stretch(codes, hit, lag)
            reached = stop - lag
            if stop - start >= max(least, repeats * lag):
                found.append((start, stop - start, lag))
                by_period.setdefault(lag, []).append((start, stop))
    return found


def stretch(codes: np.ndarray, place: int, lag: int) -> tuple[int, int]:
    """The longest stretch around ``place`` in which words ``lag`` apart are equal, as (start, stop)."""
    step, stop = 16, place
    while stop + lag < len(codes):
        end = min(stop + step, len(codes) - lag)
        differ = np.flatnonzero(codes[stop:end] != codes[stop + lag : end + lag])
        if len(differ):
            stop += int(differ[0])
            break
        stop, step = end, 2 * step
    step, start = 16, place
    while start > 0:
        begin = max(start - step, 0)
        differ = np.flatnonzero(codes[begin:start] != codes[begin + lag : start + lag])
        if len(differ):
            start = begin + int(differ[-1]) + 1
            break
        start, step = begin, 2 * step
    return start, stop + lag


def runs_of(words: list[bytes], least: int = LEAST, repeats: int = REPEATS) -> list[Run]:
    """All runs by start, then period."""
    found: list[Run] = []
    for start, stop in surviving_segments(words, least, repeats):
        numbers: dict[bytes, int] = {}
        codes = np.array([numbers.setdefault(word, len(numbers)) for word in words[start:stop]], np.int64)
        found += [(start + at, size, period) for at, size, period in runs_of_segment(codes, least, repeats)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that stay: of each run its first period, unless another run drops that too."""
    at, kept = 0, []
    for start, length, period in sorted(runs, key=lambda run: run[0] + run[2]):
        kept += words[at : max(at, start + period)]
        at = max(at, start + length)
    return kept + words[at:]


def looped(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Every tenth document by the hash of its id repeats a stretch to its end; a null id leaves the words as they are."""
    if doc_id is None or not words:
        return words
    seed = zlib.crc32(str(doc_id).encode())
    if seed % 10:
        return words
    count, salt = len(words), seed // 10
    start = salt % count
    period = 1 + (count - start) // (3 + salt % 8)
    head, cycle = words[:start], words[start : start + period]
    return head + (cycle * ((count - start) // period + 1))[: count - start]


def find_runs(docs: DataFrame, text: str = "text", loop_by: str | None = None, least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """One row per row of ``docs``: ``row`` (a struct of all its columns), n_words, runs, collapsed.

    Words are parted by ASCII white space. ``runs`` are in order of start, then period; ``collapsed`` is the text of the
    words that stay, joined by single spaces. Null, empty and blank texts have no words, no runs and an empty collapsed
    text. With ``loop_by``, an id column, the words are first changed by ``looped``. Repeated rows give repeated rows.
    """
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    seed = F.lit(None).cast("bigint") if loop_by is None else F.col(f"`{loop_by}`").cast("bigint")
    given = docs.select(whole, F.col(f"`{text}`").cast("string").alias("text"), seed.alias("seed"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, runs_found, texts = [], [], []
            for content, own in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
                words = looped(content.split(), own)
                runs = runs_of(words, least, repeats)
                sizes.append(len(words))
                runs_found.append([{"start": a, "length": n, "period": q} for a, n, q in runs])
                texts.append(b" ".join(collapsed(words, runs) if runs else words))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs_found, kind), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["row", "n_words", "runs", "collapsed"],
            )

    schema = T.StructType([given.schema["row"]]).add("n_words", "long").add("runs", RUN_TYPE).add("collapsed", "string")
    return given.mapInArrow(rows, schema)
