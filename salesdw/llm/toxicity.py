"""Toxicity by a learned lexicon, misspellings included, and the context of its hits.

Words and word beginnings that are far more common in documents labelled toxic than in others form a trie. A word of
a text is looked up by running its Levenshtein automaton along the trie: whole terms match within an edit bound that
grows with their length, word beginnings match as they are. Each hit is weighed by the words around it: quotation
marks or a reporting verb speak for quotation, a second person for abuse. A logistic model over a document's hits,
fitted on the same bounded sample of labelled rows, gives the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdw.staging import Staging

# Words that report speech, words that address someone, and quotation marks.
REPORTING = frozenset("said says say wrote writes called calls quoted quote told dit disait écrit sagte sagt schrieb dijo dice escribió".split())
ADDRESSING = frozenset("you your you're u du dich dir ihr sie tu te toi vous tú ti usted".split())
QUOTES = frozenset("\"“”„«»‹›‘’`")

WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
SHORTEST_STEM, LONGEST_STEM = 4, 8
REACH = 4
FEATURES = 7


def edit_bound(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


@dataclass
class Trie:
    """``next`` by character; a node may end a whole ``term`` and may be the end of a word beginning (``stem``)."""

    next: dict[str, Trie] = field(default_factory=dict)
    term: str | None = None
    stem: str | None = None

    def add(self, letters: str, stem: bool) -> None:
        node = self
        for letter in letters:
            node = node.next.setdefault(letter, Trie())
        if stem:
            node.stem = letters
        else:
            node.term = letters


def entries_of(trie: Trie, kind: str) -> Iterator[str]:
    """All entries of the ``kind`` term or stem."""
    found = getattr(trie, kind)
    if found is not None:
        yield found
    for child in trie.next.values():
        yield from entries_of(child, kind)


def without_stems(trie: Trie) -> Trie:
    """The whole terms alone, for the automaton."""
    result = Trie()
    for term in entries_of(trie, "term"):
        result.add(term, False)
    return result


def automaton_start(word: str, bound: int) -> tuple[int, ...]:
    """A state holds, for each prefix of ``word``, the edits to the letters read so far, cut at ``bound + 1``."""
    return tuple(min(at, bound + 1) for at in range(len(word) + 1))


def automaton_step(state: tuple[int, ...], word: str, letter: str, bound: int) -> tuple[int, ...]:
    row = [min(state[0] + 1, bound + 1)]
    for at, own in enumerate(word):
        row.append(min(state[at] + (own != letter), state[at + 1] + 1, row[at] + 1, bound + 1))
    return tuple(row)


def without_edits(trie: Trie, word: str) -> str | None:
    """The shortest word beginning in the trie that ``word`` has, else the word itself where it is a term."""
    node = trie
    for depth, letter in enumerate(word, 1):
        node = node.next.get(letter)
        if node is None:
            return None
        if node.stem is not None:
            return node.stem
    return node.term


def within_bound(terms: Trie, word: str) -> tuple[str, int] | None:
    """The nearest term within its edit bound, and the edits; ties go to the term first by letters."""
    bound = edit_bound(len(word) + 2)  # the longest term that two edits can reach
    best: tuple[int, str] | None = None
    waiting = [(terms, automaton_start(word, bound))] if bound else []
    while waiting:
        node, state = waiting.pop()
        if node.term is not None and state[-1] <= edit_bound(len(node.term)) and (best is None or (state[-1], node.term) < best):
            best = state[-1], node.term
        for letter, child in node.next.items():
            after = automaton_step(state, word, letter, bound)
            if min(after) <= bound:
                waiting.append((child, after))
    return (best[1], best[0]) if best else None


class Matches(dict):
    """The entry that a word matches, and the edits, or None; remembered by word.

    The automaton runs only for words that can match: of a term cut into one part more than its edit bound, some part
    is in the word as it is.
    """

    def __init__(self, trie: Trie, entries: int = 500_000):
        super().__init__()
        self.trie, self.terms, self.entries = trie, without_stems(trie), entries
        self.parts: set[str] = set()
        for term in entries_of(trie, "term"):
            pieces = edit_bound(len(term)) + 1
            cuts = [at * len(term) // pieces for at in range(pieces + 1)]
            self.parts.update(term[low:high] for low, high in zip(cuts, cuts[1:]))
        self.widths = sorted({len(part) for part in self.parts})

    def __missing__(self, word: str) -> tuple[str, int] | None:
        n, found = len(word), None
        if 3 <= n <= 40:
            entry = without_edits(self.trie, word)
            if entry is not None:
                found = entry, 0
            elif not self.parts.isdisjoint([word[at : at + width] for width in self.widths for at in range(n - width + 1)]):
                found = within_bound(self.terms, word)
        if len(self) >= self.entries:
            self.clear()
        self[word] = found
        return found


def features(text: str | None, matches: Matches) -> list[float]:
    """What the model sees of a text; all zero when nothing is hit."""
    lowered = (text or "").lower()
    words = WORD.findall(lowered)
    hits = [at for at, found in enumerate(map(matches.__getitem__, words)) if found]
    if not hits:
        return [0.0] * FEATURES
    places = [found.span() for found in WORD.finditer(lowered)]
    plain = quoted = edited = addressed = 0
    entries = set()
    for at in hits:
        entry, edits = matches[words[at]]
        entries.add(entry)
        low, high = max(0, at - REACH), min(len(words), at + REACH + 1)
        around = words[low:at] + words[at + 1 : high]
        before = QUOTES.intersection(lowered[places[low][0] - (low > 0) : places[at][0]])
        after = QUOTES.intersection(lowered[places[at][1] : places[high - 1][1] + 1])
        if (before and after) or REPORTING.intersection(around):
            quoted += 1
        else:
            plain += 1
        edited += edits > 0
        addressed += bool(ADDRESSING.intersection(around))
    share = min(1.0, 20.0 * len(hits) / len(words))
    counts = (plain, quoted, edited, addressed, len(entries))
    return [*map(float, np.log1p(counts)), share, 1.0 if len(hits) - edited else 0.0]


@dataclass(frozen=True)
class Fitting:
    """Bounds of the labelled sample, and when a term joins the lexicon."""

    toxic_rows: int = 4_000
    other_rows: int = 8_000
    candidates: int = 50_000
    least_rows: int = 5
    least_share: float = 0.015
    least_lift: float = 30.0


def terms_of(text: str | None) -> set[str]:
    """Words of a text, and the beginnings of its words marked by a star."""
    words = set(WORD.findall((text or "").lower()))
    stems = {word[:n] + "*" for word in words for n in range(SHORTEST_STEM, min(LONGEST_STEM, len(word)) + 1)}
    return stems | {word for word in words if 3 <= len(word) <= 40}


def term_counts(texts: DataFrame, only: frozenset[str] | None = None) -> DataFrame:
    """Rows that hold each term, summed inside tasks first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = terms_of(text)
                counts.update(found & only if only is not None else found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"]
        )

    return texts.select("text").mapInArrow(rows, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def one_of_copies(texts: DataFrame) -> DataFrame:
    """Of rows that are likely near copies one stays, so that a much copied text does not fill the lexicon.

    Rows count as copies when the two smallest hashes of their words agree; this only thins the learning sample. A
    toxic copy stays before others, then the one whose id and text have the largest hash, whatever the rows' order.
    """
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[\x20\x09-\x0D]+"))
    least = F.slice(F.sort_array(F.transform(words, lambda word: F.xxhash64(word))), 1, 2)
    rank = F.struct("toxic", F.xxhash64("doc_id", "text"), "doc_id", "text")
    chosen = texts.groupBy(least.alias("_sketch")).agg(F.max_by(F.struct(*texts.columns), rank).alias("row"))
    return chosen.select("row.*")


def choose_terms(toxic: dict[str, int], other: dict[str, int], n_toxic: int, n_other: int, fitting: Fitting) -> Trie:
    least = max(fitting.least_rows, fitting.least_share * n_toxic)
    good = {
        term
        for term, n in toxic.items()
        if n >= least and (n / n_toxic) / ((other.get(term, 0) + 0.5) / (n_other + 1)) >= fitting.least_lift
    }
    stems: set[str] = set()
    for term in sorted((t for t in good if t.endswith("*")), key=lambda t: (len(t), t)):
        if not any(term[:n] in stems for n in range(SHORTEST_STEM, len(term) - 1)):
            stems.add(term[:-1])
    trie = Trie()
    for word in sorted(t for t in good if not t.endswith("*")):
        stem = next((word[:n] for n in range(SHORTEST_STEM, len(word) + 1) if word[:n] in stems), None)
        if stem is None:
            trie.add(word, False)
        elif toxic[word] >= 0.8 * toxic[stem + "*"]:  # the beginning stands for this one word
            stems.discard(stem)
            trie.add(word, False)
    for stem in sorted(stems):
        trie.add(stem, True)
    return trie


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights with the intercept last, by Newton's method; the intercept is not penalised."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-9])
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - penalty @ weights
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, slope)
        weights = weights + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return weights


@dataclass
class Model:
    trie: Trie
    weights: np.ndarray


def fit(docs: DataFrame, labels: DataFrame, staging: Staging, fitting: Fitting = Fitting()) -> Model:
    """Learn from ``labels`` (doc_id, toxic), which the caller has cut down to the rows to learn from.

    The sample takes the first rows of each class by a hash of the id, up to the bounds of ``fitting``; rows without
    id or label are left out, and an id with several labels is toxic if one says so. With no toxic or no other row
    the model scores every text 0.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    totals = {row["toxic"]: row["n"] for row in known.groupBy(F.col("toxic") > 0).agg(F.count("*").alias("n")).toDF("toxic", "n").collect()}
    empty = Model(Trie(), np.array([0.0] * FEATURES + [-np.inf]))
    if not totals.get(True) or not totals.get(False):
        return empty
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    toxic = known.where("toxic > 0").orderBy(*by_hash).limit(fitting.toxic_rows)
    other = known.where("toxic <= 0").orderBy(*by_hash).limit(fitting.other_rows)
    chosen = staging.put(toxic.unionByName(other), "sample")
    # At most toxic_rows + other_rows pairs of numbers.
    sampled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = staging.put(one_of_copies(sampled), "sample-texts")
    n_toxic, n_other = sample.where("toxic > 0").count(), sample.where("toxic <= 0").count()
    if not n_toxic or not n_other:
        return empty
    frequent = term_counts(sample.where("toxic > 0")).where(F.col("n") >= fitting.least_rows)
    top = {row["term"]: row["n"] for row in frequent.orderBy(F.desc("n"), "term").limit(fitting.candidates).collect()}
    also = {row["term"]: row["n"] for row in term_counts(sample.where("toxic <= 0"), frozenset(top)).collect()}
    trie = choose_terms(top, also, n_toxic, n_other, fitting)
    seen = featured(sample, trie, ["toxic"]).toArrow()  # FEATURES numbers for each row of the sample
    x = np.stack(seen["features"].to_pylist())
    y = (seen["toxic"].to_numpy() > 0).astype(float)
    weights = fit_logistic(x, y)
    # The sample has more toxic rows than the labels; the intercept goes back to the labels' share.
    weights[-1] += np.log(totals[True] / totals[False]) - np.log(n_toxic / n_other)
    return Model(trie, weights)


def featured(docs: DataFrame, trie: Trie, carry: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(trie)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matches = Matches(shared.value)
        for batch in batches:
            found = [features(text, matches) for text in batch.column("text").to_pylist()]
            columns = [batch.column(name) for name in carry]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.float64()))], names=[*carry, "features"])

    kept = docs.select(*carry, "text")
    fields = ", ".join(f"`{name}` {kept.schema[name].dataType.simpleString()}" for name in carry)
    return kept.mapInArrow(rows, f"{fields}, features array<double>")


def score(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """The ``carry`` columns, the ``features`` and the ``score``; null and empty texts have no hits."""
    terms = [F.get("features", F.lit(at)) * float(weight) for at, weight in enumerate(model.weights[:-1])]
    total = F.lit(float(max(model.weights[-1], -700.0)))
    for term in terms:
        total = total + term
    return featured(docs, model.trie, carry).withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-total)))
