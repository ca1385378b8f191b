"""Periodic runs against a scan of all lags, down to the query's digests."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from salesdw.llm import periodic_runs
from salesdw.llm.queries import llm_queries


def scanned(words):
    """Every maximal stretch of every lag, less those with a smaller period."""
    n, found = len(words), []
    for lag in range(1, n // 4 + 1):
        at = 0
        while at + lag < n:
            stop = at
            while stop + lag < n and words[stop] == words[stop + lag]:
                stop += 1
            length = stop + lag - at
            if stop > at and length >= max(6, 4 * lag):
                piece = words[at : at + length]
                if not any(piece[d:] == piece[:-d] for d in range(1, lag)):
                    found.append((at, length, lag))
            at = max(stop, at + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def left_over(words, runs):
    gone = {at for start, length, period in runs for at in range(start + period, start + length)}
    return [word for at, word in enumerate(words) if at not in gone]


def looped(words, doc_id):
    seed = zlib.crc32(str(doc_id).encode())
    if seed % 10 or not words:
        return words
    g, n = seed // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [word if at < a else words[a + (at - a) % p] for at, word in enumerate(words)]


@pytest.mark.parametrize("block", range(10))
def test_runs_like_a_scan_of_all_lags(block):
    for seed in range(200 * block, 200 * block + 200):
        rng = random.Random(seed)
        letters, words = rng.randint(1, 6), []
        for _ in range(rng.randint(0, 25)):
            cycle = [b"%d" % rng.randint(0, letters * 2) for _ in range(rng.randint(1, 5))]
            words += cycle * (rng.randint(1, 7) if rng.random() < 0.4 else 1)
        words = periodic_runs.looped(words, seed)
        runs = periodic_runs.runs_of(words)
        assert runs == scanned(words)
        assert periodic_runs.collapsed(words, runs) == left_over(words, runs)


def test_long_texts_take_little_time():
    rng = random.Random(1)
    assert periodic_runs.runs_of([b"a"] * 300_000) == [(0, 300_000, 1)]
    words = [rng.choice([b"a", b"b", b"c"]) for _ in range(20_000)]
    found = periodic_runs.runs_of(words)
    assert len(found) > 20 and all(words[s : s + n - q] == words[s + q : s + n] for s, n, q in found)


def test_segments_keep_only_words_that_are_frequent_in_them():
    words = b"a b a b a b a b x q x r x s x a a".split()
    assert periodic_runs.surviving_segments(words) == [(0, 8)]
    assert periodic_runs.surviving_segments([]) == []


def test_odd_rows_and_clashing_names(spark):
    schema = "doc_id long, text string, row int, runs int, collapsed string, n_words int, seed int"
    texts = [None, "", " \n\t", "w " * 9, "w " * 9, "é\x0b日本 " * 8, "a b " * 6]
    docs = spark.createDataFrame([(None if n == 1 else n, t, 1, 2, "c", 3, 4) for n, t in enumerate(texts)], schema)
    found = periodic_runs.find_runs(docs).orderBy(F.col("row.doc_id").asc_nulls_first()).collect()
    assert [r.row.collapsed for r in found] == ["c"] * 7
    by_id = {r.row.doc_id: (r.n_words, [tuple(run) for run in r.runs], r.collapsed) for r in found}
    assert by_id == {
        0: (0, [], ""),
        None: (0, [], ""),
        2: (0, [], ""),
        3: (9, [(0, 9, 1)], "w"),
        4: (9, [(0, 9, 1)], "w"),
        5: (16, [(0, 16, 2)], "é 日本"),
        6: (6, [(0, 6, 1)], "a b"),
    }
    assert periodic_runs.find_runs(docs.limit(0)).collect() == []


def test_query(spark):
    expected = {}
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        words = looped((row.text or "").encode().split(), row.doc_id)
        runs = scanned(words)
        best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=None)
        expected[row.doc_id] = (
            len(runs),
            *(best or (None,) * 3),
            1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(left_over(words, runs))).hexdigest(),
        )
    got = llm_queries()["op12_periodic_runs"](spark, SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == expected
    assert any(value[0] for value in expected.values())
