"""Helpers shared by the text operators."""

from __future__ import annotations

import array
import functools
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# The white space that parts words, as characters and as a regular expression.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

# Letters of the Latin script, and how byte-level vocabularies spell bytes: printable ones as themselves,
# the others as the characters from 256 on, in order.
LATIN = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+")
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
SPELLED_BYTES = {byte: 256 + place for place, byte in enumerate(byte for byte in range(256) if byte not in PRINTABLE)}

# Letters that stay letters when lower-cased, and signs without an apostrophe after them: two words of the word pattern.
SIGNS_AFTER_LETTERS = re.compile("([A-Za-z\u00E0-\u00F6\u00F8-\u00FE]+)([!-&(-/:-@[-`{-~]+)")

WORD_TOKENIZER = "word_bpe_49k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary files are installed; every executor has the same package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as bytes; null counts as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batch in parts of few rows, so that only one part at a time is held as Python objects."""
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def in_split(remainder: int, modulus: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id never does."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


class ChunkIds(dict):
    """The tokenizer's ids of one blank-free chunk, as little-endian unsigned 32-bit bytes.

    The vocabulary's normaliser and word pattern never join characters across a blank or a line end, so a text's
    ids are the ids of its chunks in order; each distinct chunk is given to the library once. A comma or full stop
    after letters that the normaliser leaves letters is a word of its own, and plain A-Z letters are lower-cased anyway, so such chunks reuse entries.
    """

    def __init__(self, path: str, entries: int = 550_000, longest: int = 64):
        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.merges = self.library.model
        self.normal = self.library.normalizer.normalize_str
        self.entries, self.longest = entries, longest
        self.older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) > self.longest:
            return self.encode(chunk)
        found = self.older.get(chunk)
        if found is not None:
            pass
        elif chunk.isalpha():
            plain = chunk.lower()
            if plain != chunk and plain.isascii() and chunk.isascii():
                found = self[plain]
            elif plain.isascii() and chunk.isascii():
                # One word for the word pattern; the library's merges need no more than its lower case.
                found = self.merge(chunk)
            elif LATIN.fullmatch(chunk) and plain.isalpha():
                # One word as well, whose letters no normal form changes; the merges work on its bytes, each spelled as
                # one character.
                found = self.merge(plain.encode().decode("latin-1").translate(SPELLED_BYTES))
            else:
                found = self.encode(chunk)
        elif chunk[-1:] in (",", ".") and chunk[:-1].isalpha() and (chunk.isascii() or self.normal(chunk[:-1]).isalpha()):
            found = self[chunk[:-1]] + self[chunk[-1]]
        elif (word := SIGNS_AFTER_LETTERS.fullmatch(chunk)) is not None:
            found = self[word[1]] + self[word[2]]
        else:
            found = self.encode(chunk)
        if len(self) >= self.entries:  # what is not asked for until the next change is forgotten
            self.older = dict(self)
            self.clear()
        self[chunk] = found
        return found

    def merge(self, word: str) -> bytes:
        return array.array("I", [piece.id for piece in self.merges.tokenize(word)]).tobytes()

    def encode(self, chunk: str) -> bytes:
        return array.array("I", self.library.encode(chunk, add_special_tokens=False).ids).tobytes()

    def of_text(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" "))) if text else b""

    def of_texts(self, texts: pa.Array, at_once: int = 1 << 23) -> Iterator[bytes]:
        """``of_text`` of each text. Some ``at_once`` bytes of texts are cut together, so that a chunk is looked up once
        for all its places there; these take its ids from one column.
        """
        texts = texts.cast(pa.large_string()).fill_null("")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes) - sizes) // at_once
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        for low, high in itertools.pairwise(edges):
            cut = pc.split_pattern(pc.replace_substring(texts.slice(low, high - low), "\n", " "), " ")
            first = np.cumsum([0, *pc.list_value_length(cut).to_pylist()])
            chunks = cut.flatten().dictionary_encode()
            known = pa.array(list(map(self.__getitem__, chunks.dictionary.to_numpy(zero_copy_only=False))), pa.large_binary())
            placed = known.take(chunks.indices)
            ends = np.concatenate([[0], np.cumsum(pc.binary_length(placed).to_numpy(zero_copy_only=False))])[first]
            ids = memoryview(placed.buffers()[2] or b"")
            yield from (ids[a:b].tobytes() for a, b in itertools.pairwise(ends.tolist()))


@functools.lru_cache(maxsize=1)
def shared_chunk_ids(path: str, entries: int = 550_000) -> ChunkIds:
    """One for all tasks of a Python worker, so that common chunks are encoded once; it holds up to twice the entries."""
    return ChunkIds(path, entries)
