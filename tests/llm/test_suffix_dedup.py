"""Suffix dedup against brute force, down to the query's digests."""

import hashlib
import random
from collections import Counter

import pytest

from conftest import SMALL
from salesdw.llm import suffix_dedup
from salesdw.llm.column_bwt import ColumnwiseIndex
from salesdw.llm.queries import llm_queries


def brute_force(texts, length):
    """(bytes, removed runs, kept bytes) of each text."""
    seen = Counter(text[at : at + length] for text in texts for at in range(len(text) - length + 1))
    result = []
    for text in texts:
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if seen[text[at : at + length]] > 1:
                gone[at : at + length] = b"\x01" * length
        marks = bytes(gone)
        kept = bytes(byte for byte, mark in zip(text, marks) if not mark)
        result.append((len(text), [len(run) for run in marks.split(b"\x00") if run], kept))
    return result


@pytest.mark.parametrize("seed", range(30))
def test_columnwise_index(seed):
    rng = random.Random(seed)
    letters = "ab\0cé"[: rng.randint(1, 5)]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 30))).encode() for _ in range(rng.randint(1, 12))]
    for length in (1, 3, 8):
        seen = Counter(text[at : at + length] for text in texts for at in range(len(text) - length + 1))
        index = ColumnwiseIndex(texts, length)
        wanted = [[at for at in range(len(text) - length + 1) if seen[text[at : at + length]] > 1] for text in texts]
        assert [found.tolist() for found in index.repeated(length)] == wanted
        # The transform has each string's symbols and its end.
        assert Counter(index.transform.tolist()) == Counter([b + 1 for text in texts for b in text] + [0] * len(texts))


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("aeinrst", k=rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(rng.randint(5, 40)) for _ in range(5)]
    common = prose(12)
    texts = [" ".join(rng.choice([*shared, prose(20), prose(8), common]) for _ in range(rng.randint(1, 8))) for _ in range(60)]
    texts += [f"{prose(9)} {common} {prose(9)}" for _ in range(40)]
    texts += [texts[0], texts[0], "", "x" * 500, "ab" * 90, "é" * 101, "né́日本" * 30, "\0" * 60 + "k", prose(3)]
    return texts


@pytest.mark.parametrize("most, block_bytes", [(4000, 1 << 20), (3, 2000)])
def test_repeats_like_brute_force(spark, staging, most, block_bytes):
    texts = passages(3)
    rows = [(number, text, "u", 1, 2, "v", 3) for number, text in enumerate(texts)]
    rows += [(None, texts[1], "u", 1, 2, "v", 3), (None, None, "u", 1, 2, "v", 3), (2, texts[2], "u", 1, 2, "v", 3)]
    # Columns with the names that the operator uses inside.
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, spans int, _key int, kept string, n_bytes int")
    found = suffix_dedup.without_repeats(docs.repartition(5), staging, length=50, grams=(16, 40, 50), most=most, block_bytes=block_bytes)
    got = Counter((r.row.doc_id, r.row.text, r.row.row, r.n_bytes, tuple(s.length for s in r.spans), bytes(r.kept)) for r in found.collect())
    expected = brute_force([(text or "").encode() for _, text, *_ in rows], 50)
    assert got == Counter((i, t, "u", n, tuple(runs), kept) for (i, t, *_), (n, runs, kept) in zip(rows, expected))


def test_long_text_in_pieces(spark, staging, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 1000)
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefgh ", k=9000))
    texts = [text, text[2000:2900] + "zz", text[980:1100] + "".join(rng.choices("xyz", k=400))]
    portions = list(suffix_dedup.in_pieces([text.encode()], 50))
    assert len(portions) >= 9 and all(len(piece) <= 1049 for *_, pieces in portions for piece in pieces)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = suffix_dedup.without_repeats(docs, staging, length=50, grams=(16, 50)).orderBy("row.doc_id").collect()
    expected = brute_force([t.encode() for t in texts], 50)
    assert [(r.n_bytes, [s.length for s in r.spans], bytes(r.kept)) for r in found] == expected


def test_empty_table(spark, staging):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.without_repeats(docs, staging).collect() == []


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    expected = brute_force([(r.text or "").encode() for r in rows], 200)
    got = {r.doc_id: tuple(r)[1:] for r in llm_queries()["op11_suffix_array_dedup"](spark, SMALL).collect()}
    assert got == {
        r.doc_id: (n, sum(runs), len(runs), hashlib.sha256(kept).hexdigest()) for r, (n, runs, kept) in zip(rows, expected)
    }
    assert sum(value[1] for value in got.values()) > 0
