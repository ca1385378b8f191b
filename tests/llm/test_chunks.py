"""Words that skip the tokenizer's word pattern have the library's ids."""

import random

import pyarrow as pa

from salesdw.llm.common import WORD_TOKENIZER, ChunkIds, tokenizer_path


def test_latin_words_have_the_ids_of_the_library():
    known, rng = ChunkIds(tokenizer_path(WORD_TOKENIZER)), random.Random(1)
    letters = [chr(number) for number in range(0xC0, 0x250)]
    words = letters + ["".join(rng.choices([*letters, *"abcXYZ"], k=rng.randint(1, 12))) for _ in range(2000)]
    assert [word for word in words if known[word] != known.encode(word)] == []


def test_random_chunks_have_the_ids_of_the_library():
    """Letters with marks, letters that decompose or change their number when lower-cased, digits, signs, other scripts."""
    known, rng = ChunkIds(tokenizer_path(WORD_TOKENIZER)), random.Random(2)
    signs = [*"abXYZ19.,;'!?-#", *"İıßſŉǰΐﬁ①½ª", "\u0301", "\u0307", "\u0327", "é", "日", "ก", "ั", "👩", "\u200d", "’s", "'s"]
    chunks = ["İ,", "bİ.", "ŉ,", "ﬁ.", "e\u0301,"] + ["".join(rng.choices(signs, k=rng.randint(1, 7))) for _ in range(5000)]
    assert [chunk for chunk in chunks if known[chunk] != known.encode(chunk)] == []


def test_texts_cut_together_have_the_ids_of_each():
    """Nulls, empty texts, runs of blanks and slices of a column, in groups of a few bytes and in one."""
    known, rng = ChunkIds(tokenizer_path(WORD_TOKENIZER)), random.Random(3)
    words = ["", "a", "Été,", "x\ty", "İ,", "signs***", "don't", "\n", "日本", "END.", "<|endoftext|>", "H̱", "x!'s"]
    texts = [None, "", " ", *(" ".join(rng.choices(words, k=rng.randint(1, 9))) for _ in range(200)), None]
    column = pa.array(texts, pa.string())
    for at_once in (1, 40, 1 << 23):
        assert list(known.of_texts(column, at_once)) == [known.of_text(text) for text in texts]
    assert list(known.of_texts(column.slice(5, 20))) == [known.of_text(text) for text in texts[5:25]]
    assert list(known.of_texts(column.slice(0, 0))) == []
    library = [known.encode(text) if text else b"" for text in texts]
    assert [known.of_text(text) for text in texts] == library


def test_chunks_of_several_texts_are_looked_up_once():
    known, asked = ChunkIds(tokenizer_path(WORD_TOKENIZER), entries=1), []
    known.encode = lambda chunk: asked.append(chunk) or ChunkIds.encode(known, chunk)
    list(known.of_texts(pa.array(["7up x7 7up", "7up\nx7"] * 50)))
    assert sorted(asked) == ["7up", "x7"]


def test_signs_after_letters_are_words_of_their_own():
    known, asked = ChunkIds(tokenizer_path(WORD_TOKENIZER)), []
    known.encode = lambda chunk: asked.append(chunk) or ChunkIds.encode(known, chunk)
    chunks = ["one***", "Two***", "é***", "three!?", "a.***"]
    found = [known[chunk] for chunk in chunks]
    assert asked == ["***", "!?", ".***"]
    assert found == [ChunkIds.encode(known, chunk) for chunk in chunks]
