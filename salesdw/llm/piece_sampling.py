"""Distinct sampled segmentations of texts into SentencePiece pieces, and decoding.

All ways to cut a text into pieces form a lattice; a piece of rank r weighs 1 / (r + 10), and a segmentation's
probability is the product of its weights over the sum of all products. Characters that no piece covers are spelled
in byte pieces. Between two characters that stand together in no piece every segmentation has a cut, so the lattice
falls into short parts there, and each distinct part is prepared once: backward sums turn the weights into the
probability of each next piece.

The k segmentations with the largest Gumbel-perturbed log probabilities are a sample without replacement. They are
found by search over sets of segmentations that share a beginning: the largest perturbed value of a set is drawn
from a Gumbel distribution at the set's log mass, cut off at the value of the set it is split from. The set with the
largest value is taken from the queue, a segmentation is drawn down to its end, and the sets left aside on the way
are queued. As these values are what the sets really hold, the first k ends are the k largest. The largest value left
in the queue is the threshold of the inclusion probabilities.

Random numbers are a hash of the row's key and a counter, so a row gets the same result wherever it is computed.
"""

from __future__ import annotations

import array
import functools
import heapq
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*")  # no piece has a space sign after another character
SHIFT = 10.0
SCHEMA = "sample int, n_pieces int, log_prob double, perturbed double, inclusion double, ids binary"


def uniforms(seeds: np.ndarray, counters: np.ndarray) -> np.ndarray:
    """Numbers between 0 and 1, both excluded, by mixing seed and counter."""
    with np.errstate(over="ignore"):
        x = seeds + counters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def chunks_of(text: str) -> list[str]:
    return CHUNK.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _among(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted number stands in the sorted keys, and whether it is there."""
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


class Lattices:
    """Prepared parts. State s has the arcs first[s] to first[s + 1]; ``bound`` is s plus the summed probabilities.

    The pieces are a trie with numbered nodes, 0 being its root: the child of a node by a character is looked up among
    the sorted keys node * characters + character, for many places of the texts at once.
    """

    def __init__(self, path: str, arcs: int = 6_000_000):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.limit = arcs
        self.piece: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, tuple[int, float]] = {}
        size = model.get_piece_size()
        for number in range(size):
            text = model.id_to_piece(number)
            if model.is_byte(number):
                self.bytes[int(text[3:5], 16)] = number, -math.log(size + SHIFT)
            elif not (model.is_control(number) or model.is_unknown(number) or model.is_unused(number)):
                self.piece[text] = number, -math.log(min(-model.get_score(number), size) + SHIFT)
        self.byte_ids = np.array([self.bytes[byte][0] for byte in range(256)], np.uint32)
        self.byte_weight = self.bytes[0][1]
        alphabet = sorted({ord(letter) for text in self.piece for letter in text})
        # Characters by code point; all that no piece has are the last one.
        self.width = len(alphabet) + 1
        self.letter = np.full(0x110000, len(alphabet), np.int32)
        self.letter[alphabet] = np.arange(len(alphabet))
        child: dict[int, int] = {}
        ends: dict[int, tuple[int, float]] = {}
        for text, piece in self.piece.items():
            node = 0
            for letter in self.letter[[ord(one) for one in text]].tolist():
                node = child.setdefault(node * self.width + letter, len(child) + 1)
            ends[node] = piece
        self.keys = np.array(sorted(child), np.int64)
        self.child = np.array([child[key] for key in self.keys.tolist()], np.int64)
        # By character, the root's children; 0, which is no child, where there is none.
        self.root = np.array([child.get(letter, 0) for letter in range(self.width)], np.int64)
        self.number = np.full(len(child) + 1, -1, np.int64)
        self.number[list(ends)] = [number for number, _ in ends.values()]
        self.weight = np.zeros(len(child) + 1)
        self.weight[list(ends)] = [weight for _, weight in ends.values()]
        # Whether two characters are neighbours in some piece, at left * characters + right.
        places = [self.letter[[ord(one) for one in text]].astype(np.int64) for text in self.piece if len(text) > 1]
        self.inner = np.zeros(self.width**2, bool)
        for at in places:
            self.inner[at[:-1] * self.width + at[1:]] = True
        self.clear()

    def clear(self) -> None:
        # By chunk, its number. Per chunk: its first part. Per part: the state where it begins.
        self.starts: dict[str, int] = {}
        self.part_at, self.parts = array.array("q", [0]), array.array("q")
        # Per state: its first arc. Per arc: the bound, the next state (-1: the end), the log probability, its ids.
        self.first, self.bound = array.array("q", [0]), array.array("d")
        self.to, self.logp = array.array("q"), array.array("d")
        self.id_at, self.ids = array.array("q", [0]), array.array("I")
        # Of the states that are not weighted yet: characters up to the part's end.
        self.fresh = array.array("q")

    def prepare(self, texts: list[list[str]]) -> None:
        """Note the parts of all chunks that are not known yet; ``weigh`` makes probabilities of their weights."""
        new = [chunk for chunk in dict.fromkeys(itertools.chain.from_iterable(texts)) if chunk not in self.starts]
        if not new:
            return
        codes = np.frombuffer("".join(new).encode("utf-32-le"), "<u4")
        letters = self.letter[codes].astype(np.int64)
        chunk_ends = np.cumsum([len(chunk) for chunk in new])
        begins = np.ones(len(codes), bool)
        begins[1:] = ~self.inner[letters[:-1] * self.width + letters[1:]]
        begins[chunk_ends[:-1]] = True
        begin = np.flatnonzero(begins)
        sizes = np.diff(np.append(begin, len(codes)))
        end = np.repeat(begin + sizes, sizes)
        state = len(self.first) - 1
        self._arcs(codes, letters, end, state)
        self.fresh.frombytes((end - np.arange(len(codes))).tobytes())
        self.part_at.frombytes((np.searchsorted(begin, chunk_ends) + len(self.parts)).tobytes())
        self.parts.frombytes((begin + state).tobytes())
        self.starts.update(zip(new, range(len(self.starts), len(self.starts) + len(new))))

    def _arcs(self, codes: np.ndarray, letters: np.ndarray, end: np.ndarray, state: int) -> None:
        """The arcs of every place in order: by length, bytes last."""
        count = np.zeros(len(codes), np.int64)
        steps: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]] = []  # places, their rank there, nodes, length
        node, length = self.root[letters], 1
        active = np.flatnonzero(node)
        node = node[active]
        while len(active):
            whole = self.number[node] >= 0
            steps.append((active[whole], count[active[whole]], node[whole], length))
            count[active[whole]] += 1
            going = active + length < end[active]
            active, node = active[going], node[going]
            at, found = _among(self.keys, node * self.width + letters[active + length])
            active, node, length = active[found], self.child[at[found]], length + 1
        spelled = np.flatnonzero(self.number[self.root[letters]] < 0)
        rank = count[spelled]
        count[spelled] += 1
        edges = np.cumsum(count)
        first = edges - count
        total = int(edges[-1])
        to, logp, wide = np.zeros(total, np.int64), np.zeros(total), np.ones(total, np.int64)
        piece = np.zeros(total, np.int64)
        for places, ranks, nodes, length in steps:
            arc = first[places] + ranks
            to[arc] = np.where(places + length < end[places], places + length + state, -1)
            logp[arc], piece[arc] = self.weight[nodes], self.number[nodes]
        arc = first[spelled] + rank
        own = codes[spelled]
        n_bytes = 1 + (own >= 0x80).astype(np.int64) + (own >= 0x800) + (own >= 0x10000)
        to[arc] = np.where(spelled + 1 < end[spelled], spelled + 1 + state, -1)
        logp[arc], wide[arc] = n_bytes * self.byte_weight, n_bytes
        id_ends = np.cumsum(wide)
        ids = np.repeat(piece, wide).astype(np.uint32)
        if len(spelled):
            place = np.repeat(id_ends[arc] - wide[arc] - (np.cumsum(n_bytes) - n_bytes), n_bytes) + np.arange(int(n_bytes.sum()))
            ids[place] = self.byte_ids[np.frombuffer(own.tobytes().decode("utf-32-le").encode(), np.uint8)]
        self.first.frombytes((edges + self.first[-1]).tobytes())
        self.id_at.frombytes((id_ends + self.id_at[-1]).tobytes())
        self.to.frombytes(to.tobytes())
        self.logp.frombytes(logp.tobytes())
        self.ids.frombytes(ids.tobytes())

    def weigh(self) -> None:
        """Backward sums of all new states at once, those nearest to their part's end first."""
        left = np.array(self.fresh, np.int64)
        if not len(left):
            return
        state = len(self.first) - 1 - len(left)
        first = np.array(self.first[state:], np.int64)
        base = int(first[0])
        first -= base
        to, weight = np.array(self.to[base:], np.int64), np.array(self.logp[base:])
        after = np.zeros(len(left) + 1)  # the last place stands for the end
        inside = np.where(to < 0, len(left), to - state)
        order = np.argsort(left, kind="stable")
        sizes = np.diff(first)
        log_p = np.zeros(len(to))
        for group in np.split(order, np.flatnonzero(np.diff(left[order])) + 1):
            size = sizes[group]
            edges = np.cumsum(size) - size
            arcs = np.repeat(first[group] - edges, size) + np.arange(int(size.sum()))
            value = weight[arcs] + after[inside[arcs]]
            top = np.maximum.reduceat(value, edges)
            after[group] = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, size)), edges))
            log_p[arcs] = np.minimum(value - np.repeat(after[group], size), 0.0)
        share = np.cumsum(np.exp(log_p))
        before = np.concatenate([[0.0], share])[first[:-1]]
        inner = np.minimum(share - np.repeat(before, sizes), 1.0)
        inner[first[1:] - 1] = 1.0
        np.frombuffer(self.logp, np.float64)[base:] = log_p
        self.bound.frombytes((np.repeat(np.arange(state, state + len(left)), sizes) + inner).tobytes())
        self.fresh = array.array("q")

    def of_texts(self, texts: list[list[str]]) -> list[np.ndarray]:
        """For each text the states where its parts begin, in order."""
        sizes = [len(chunks) for chunks in texts]
        chunk = np.fromiter(map(self.starts.__getitem__, itertools.chain.from_iterable(texts)), np.int64, sum(sizes))
        first = np.frombuffer(self.part_at, np.int64)
        begin, size = first[chunk], first[chunk + 1] - first[chunk]
        ends = np.cumsum(size)
        states = np.frombuffer(self.parts, np.int64)[np.repeat(begin - (ends - size), size) + np.arange(int(size.sum()))]
        edges = np.concatenate([[0], ends])[np.cumsum(sizes)[:-1]]
        return np.split(states, edges)


class View:
    """The prepared arcs as arrays, for as long as none are added."""

    def __init__(self, lattices: Lattices):
        self.first = np.frombuffer(lattices.first, np.int64)
        self.bound = np.frombuffer(lattices.bound, np.float64)
        self.to = np.frombuffer(lattices.to, np.int64)
        self.logp = np.frombuffer(lattices.logp, np.float64)
        self.id_at = np.frombuffer(lattices.id_at, np.int64)
        self.ids = np.frombuffer(lattices.ids, np.uint32)

    def walk(self, starts: np.ndarray, seeds: np.ndarray, counters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draw one path from each start to its part's end: all arcs in order, and how many each start has."""
        active, state, steps, step = np.arange(len(starts)), starts, [], 0
        count = np.zeros(len(starts), np.int64)
        while len(active):
            drawn = uniforms(seeds[active], counters[active] + np.uint64(step << 28))
            target, arc = state + drawn, self.first[state]
            behind = np.flatnonzero(self.bound[arc] < target)
            while len(behind):  # states have few arcs; the last one's bound is state + 1
                arc[behind] += 1
                behind = behind[self.bound[arc[behind]] < target[behind]]
            steps.append((active, arc))
            count[active] += 1
            state = self.to[arc]
            going = state >= 0
            active, state, step = active[going], state[going], step + 1
        offset = np.cumsum(count) - count
        path = np.zeros(int(count.sum()), np.int64)
        for number, (who, arc) in enumerate(steps):
            path[offset[who] + number] = arc
        return path, count

    def ids_of(self, path: np.ndarray) -> np.ndarray:
        low, high = self.id_at[path], self.id_at[path + 1]
        width = high - low
        place = np.repeat(low - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        return self.ids[place]


@functools.lru_cache(maxsize=1)
def shared_lattices(path: str) -> Lattices:
    """One for all tasks of a Python worker, so that common words are prepared once."""
    return Lattices(path)


def _below(location: np.ndarray, bound: float, uniform: np.ndarray) -> np.ndarray:
    """Gumbel values at ``location`` that are at most ``bound``."""
    with np.errstate(divide="ignore"):
        return -np.logaddexp(-bound, np.log(-np.log(uniform)) - location)


class Search:
    """The queue of one row. An entry: minus the set's value, a number, its beginning and the arcs left out there."""

    def __init__(self, seed: np.uint64, parts: np.ndarray, k: int):
        self.seed, self.parts, self.k = seed, parts, k
        self.queue: list = []
        self.entries, self.draws = 0, 0
        self.found: list[tuple[np.ndarray, float, float]] = []
        value = -math.log(-math.log(self.uniform()[0]))
        # Path so far, its log probability, the part it is in, and the state there; no arcs left out.
        self.push(value, np.zeros(0, np.int64), 0.0, 0, None, ())

    def uniform(self, n: int = 1) -> np.ndarray:
        """Its counters have the top bit set, so they never meet those of the walks."""
        counters = np.arange(self.draws, self.draws + n, dtype=np.uint64) | np.uint64(1 << 62)
        self.draws += n
        return uniforms(np.full(n, self.seed), counters)

    def push(self, value: float, path: np.ndarray, log_p: float, part: int, state: int | None, without: tuple) -> None:
        self.entries += 1
        heapq.heappush(self.queue, (-value, self.entries, path, log_p, part, state, without))

    def open(self, view: View) -> np.ndarray | None:
        """Take the best set and choose its first piece; the states to walk from, or None when there is no more."""
        if len(self.found) >= self.k or not self.queue:
            return None
        minus, _, path, log_p, part, state, without = heapq.heappop(self.queue)
        self.value, self.base = -minus, len(path)
        if state is not None:
            low, high = int(view.first[state]), int(view.first[state + 1])
            arcs = np.array([arc for arc in range(low, high) if arc not in without])
            share = np.exp(view.logp[arcs])
            place = min(int(np.searchsorted(np.cumsum(share), self.uniform()[0] * share.sum())), len(arcs) - 1)
            chosen = int(arcs[place])
            rest = float(share.sum() - share[place])
            if len(arcs) > 1 and rest > 0:
                left = _below(np.array([log_p + math.log(rest)]), self.value, self.uniform())
                self.push(float(left[0]), path, log_p, part, state, (*without, chosen))
            path, log_p = np.append(path, chosen), log_p + float(view.logp[chosen])
            state = int(view.to[chosen])
        self.path, self.log_p, self.part = path, log_p, part
        self.inside = state is not None and state >= 0
        following = part + (state is not None)
        return np.append(state, self.parts[following:]) if self.inside else self.parts[following:]

    def close(self, view: View, walked: np.ndarray, counts: np.ndarray) -> None:
        """The drawn end, and the sets left aside on the way to it; only the k best of those can matter."""
        logs = view.logp[walked]
        before = self.log_p + np.concatenate([[0.0], np.cumsum(logs)])
        total = float(before[-1])
        whole = np.concatenate([self.path, walked])
        self.found.append((whole, total, self.value))
        if len(walked):
            aside = self.asides(before, logs)
            values = _below(aside, self.value, self.uniform(len(aside)))
            best = np.arange(len(values))
            if len(values) > self.k + 1:
                best = np.sort(np.argpartition(-values, self.k)[: self.k + 1])
            best = best[np.argsort(-values[best], kind="stable")]
            owner = np.repeat(np.arange(len(counts)), counts)
            start = self.part + (0 if self.inside else (1 if len(self.path) else 0))
            for at in best.tolist():
                if values[at] > -np.inf:
                    arc = int(walked[at])
                    state = int(np.searchsorted(view.first, arc, "right")) - 1
                    self.push(float(values[at]), whole[: len(self.path) + at], float(before[at]), start + int(owner[at]), state, (arc,))

    def asides(self, before: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """Log masses of the sets left aside, as far down as one of them can be among the k + 1 best.

        A value is its set's log mass plus between -4 and 37, as the uniform numbers have 52 bits, and the masses are
        at most those of the beginnings, which only fall.
        """
        with np.errstate(divide="ignore"):
            near = before[:64][: len(logs)] + np.log(-np.expm1(logs[:64]))
            if len(near) <= self.k:
                return near
            least = np.partition(near, -self.k - 1)[-self.k - 1] - 41.0
            reach = int(np.searchsorted(-before[:-1], -least, "right"))
            return near[:reach] if reach <= len(near) else before[:reach] + np.log(-np.expm1(logs[:reach]))

    def threshold(self) -> float:
        return -self.queue[0][0] if self.queue else -math.inf


def sample_texts(lattices: Lattices, texts: list[str], seeds: np.ndarray, k: int) -> list[list[tuple]]:
    """For each text its samples: (number, ids, log probability, perturbed value, inclusion probability)."""
    chunks = [chunks_of(text) for text in texts]
    lattices.prepare(chunks)
    lattices.weigh()
    parts = lattices.of_texts(chunks)
    view = View(lattices)
    searches = [Search(seed, own, k) for seed, own in zip(seeds, parts)]
    for number in range(k):
        opened = [(search, states) for search in searches if (states := search.open(view)) is not None]
        if not opened:
            break
        sizes = [len(states) for _, states in opened]
        starts = np.concatenate([states for _, states in opened])
        owners = np.repeat(np.array([search.seed for search, _ in opened], np.uint64), sizes)
        ends = np.cumsum(sizes)
        counters = np.concatenate([np.arange(n) for n in sizes]).astype(np.uint64) + np.uint64(number << 56)
        path, count = view.walk(starts, owners, counters)
        edge = np.concatenate([[0], np.cumsum(count)])
        for (search, _), size, end in zip(opened, sizes, ends.tolist()):
            search.close(view, path[edge[end - size] : edge[end]], count[end - size : end])
    results = []
    for search in searches:
        least = search.threshold()
        rows = []
        for number, (path, total, value) in enumerate(search.found):
            inclusion = 1.0 if least == -math.inf else -math.expm1(-math.exp(min(total - least, 700.0)))
            rows.append((number + 1, view.ids_of(path), total, value, inclusion))
        results.append(rows)
    return results


class Spelling:
    """The bytes of every piece, laid end to end; decoding copies them piece by piece."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        texts = []
        for number in range(model.get_piece_size()):
            if model.is_byte(number):
                texts.append(bytes([int(model.id_to_piece(number)[3:5], 16)]))
            elif model.is_control(number):
                texts.append(b"")
            elif model.is_unknown(number):
                texts.append(model.decode([number]).encode())
            else:
                texts.append(model.id_to_piece(number).replace(SPACE, " ").encode())
        self.width = np.array([len(text) for text in texts])
        self.at = np.cumsum(self.width) - self.width
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)

    def text(self, ids: np.ndarray) -> str:
        width = self.width[ids]
        place = np.repeat(self.at[ids] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        spelled = self.bytes[place].tobytes().decode("utf-8", "replace")
        return spelled[1:] if spelled[:1] == " " else spelled


@functools.lru_cache(maxsize=1)
def shared_spelling(path: str) -> Spelling:
    return Spelling(path)


def text_slices(batch: pa.RecordBatch, rows: int, letters: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most so many rows, and of at most so many letters if they have several rows."""
    sizes = pc.utf8_length(batch.column("_text")).to_pylist()
    at = held = 0
    for place, size in enumerate(sizes):
        if place > at and (place - at >= rows or held + size > letters):
            yield batch.slice(at, place - at)
            at, held = place, 0
        held += size
    if sizes:
        yield batch.slice(at)


def sample_segmentations(
    docs: DataFrame, path: str, carry: list[str], k: int = 2, texts_at_once: int = 64, letters_at_once: int = 250_000, spelled: bool = False
) -> DataFrame:
    """Up to ``k`` rows per row of ``docs``: the ``carry`` columns, sample (from 1, by perturbed value), n_pieces,
    log_prob, perturbed, inclusion and ids (little-endian unsigned 32-bit). With ``spelled`` also ``decoded``, what
    ``decode`` makes of the ids, without a second Python worker.

    The row's key is its first ``carry`` column and its text, so repeated rows get the same samples. A null or empty
    text has one segmentation, of no pieces. A text with fewer than ``k`` segmentations has one row for each. Texts
    are worked on in groups of ``texts_at_once``, or fewer beyond ``letters_at_once``; groups change no result.
    """
    seeded = docs.select(*carry, F.coalesce(F.col("text"), F.lit("")).alias("_text"), F.xxhash64(carry[0], F.coalesce(F.col("text"), F.lit(""))).alias("_seed"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = shared_lattices(path)
        for batch in batches:
            for part in text_slices(batch, texts_at_once, letters_at_once):
                seeds = part.column("_seed").to_numpy(zero_copy_only=False).view(np.uint64)
                found = sample_texts(lattices, part.column("_text").to_pylist(), seeds, k)
                if len(lattices.bound) > lattices.limit:
                    lattices.clear()
                owner = pa.array(np.repeat(np.arange(len(found)), [len(one) for one in found]))
                flat = [row for one in found for row in one]
                columns = [part.column(name).take(owner) for name in carry]
                texts = [pa.array([shared_spelling(path).text(row[1]) for row in flat], pa.string())] if spelled else []
                yield pa.RecordBatch.from_arrays(
                    [
                        *columns,
                        pa.array([row[0] for row in flat], pa.int32()),
                        pa.array([len(row[1]) for row in flat], pa.int32()),
                        *(pa.array([row[n] for row in flat], pa.float64()) for n in (2, 3, 4)),
                        pa.array([row[1].astype("<u4").tobytes() for row in flat], pa.binary()),
                        *texts,
                    ],
                    names=[*carry, "sample", "n_pieces", "log_prob", "perturbed", "inclusion", "ids", *(["decoded"] if spelled else [])],
                )

    fields = ", ".join(f"`{name}` {seeded.schema[name].dataType.simpleString()}" for name in carry)
    return seeded.mapInArrow(rows, f"{fields}, {SCHEMA}" + (", decoded string" if spelled else ""))


def decode(samples: DataFrame, path: str, carry: list[str]) -> DataFrame:
    """The ``carry`` columns and the ``text`` that ``ids`` stand for; the space put before a text is taken off."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = shared_spelling(path)
        for batch in batches:
            texts = [spelling.text(np.frombuffer(ids or b"", "<u4")) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in carry), pa.array(texts, pa.string())], names=[*carry, "text"]
            )

    kept = samples.select(*carry, "ids")
    fields = ", ".join(f"`{name}` {kept.schema[name].dataType.simpleString()}" for name in carry)
    return kept.mapInArrow(rows, f"{fields}, text string")
