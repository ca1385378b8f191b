"""Text operators against brute force on small fixtures, with odd rows in every table."""

import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SMALL
from salesdw.checks.compare import connect, differences
from salesdw.llm import common, host_rules, id_store, katz, kmeans_tree, line_dedup, packing, piece_sampling, simhash, substring, toxicity
from salesdw.llm.common import PIECE_TOKENIZER, WORD_TOKENIZER, tokenizer_path
from salesdw.llm.oracle import llm_sql
from salesdw.llm.queries import llm_queries
from salesdw.staging import FILE_CLEANUP

PLAIN = Tokenizer.from_file(tokenizer_path(WORD_TOKENIZER))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, fingerprint int"
LONG = "The quick brown fox jumps over the lazy dog near the old river bank today.\nA second line stands here, well apart."
TEXTS = [
    (1, LONG),
    (2, LONG),
    (2, LONG),
    (3, LONG.replace("lazy", "lazi")),
    (4, None),
    (5, ""),
    (None, "no id but words enough to be a line of its own"),
    (6, "\n\n  \t\n"),
    (7, "word, " * 3000 + "é́ <|endoftext|> x\x1c.\x1dy"),
    (8, "Héllo  wörld ▁ \x00 日本語テキスト 👩‍👩‍👧 it's"),
    (9, "a" * 5000),
]


def table(spark, rows=TEXTS):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, "s", len(t or ""), "x", 0) for i, t in rows], SCHEMA)


def ids(text, end):
    return [*(PLAIN.encode(text, add_special_tokens=False).ids if text else []), end]


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


def check_packing(rows, texts, capacity):
    expected = Counter()
    for doc_id, text in texts:
        whole = ids(text, 0)
        for piece, start in enumerate(range(0, len(whole), capacity)):
            part = whole[start : start + capacity]
            expected[doc_id, piece, start, len(part), crc(part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [offset for offset, _ in parts] == list(np.cumsum([0, *(n for _, n in parts[:-1])]))
        assert sum(n for _, n in parts) <= capacity
    return len(sequences)


def test_packing(spark, staging):
    cut = packing.cut_documents(table(spark), tokenizer_path(WORD_TOKENIZER), 64)
    facts = staging.put(cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "facts")
    packed, certificates = packing.pack(facts, staging, 64, per_group=20)
    made = check_packing(packed.collect(), TEXTS, 64)
    sizes = np.array([r.length for r in facts.collect()])
    assert packing.lower_bound(sizes, 64) <= made <= packing.lower_bound(sizes, 64) + 3
    assert all(r.bound <= r.sequences for r in certificates.collect())
    assert all(0 < r.group_bound <= r.group_sequences for r in packed.collect())


def test_packing_goes_on_until_no_round_saves_a_sequence(spark, staging):
    rng = np.random.default_rng(3)
    pieces = spark.createDataFrame([(n, int(size), "x") for n, size in enumerate(rng.integers(200, 700, 600))], "doc_id long, length long, offset string")
    packed, certificates = packing.pack(pieces, staging, 1000, per_group=30)
    rounds = Counter()
    for r in certificates.collect():
        rounds[r.round] += r.sequences
    assert packed.count() == 600 and max(rounds) >= 2
    rows = packed.collect()
    made = {r.sequence_id: r for r in rows}
    loads = Counter()
    for r in rows:
        loads[r.sequence_id] += r.length
    assert max(loads.values()) <= 1000 and len(made) >= packing.lower_bound(np.array([r.length for r in rows]), 1000)


def test_packing_with_few_chunks_kept(spark, staging):
    path = tokenizer_path(WORD_TOKENIZER)
    known = common.shared_chunk_ids(path, 50)
    texts = [" ".join(f"{word}{number}" for number in range(start, start + 90)) for start in (0, 40, 300) for word in ("ab", "Übung")]
    assert [known.of_text(text) for text in texts] == [common.ChunkIds(path).of_text(text) for text in texts]
    assert len(known) <= 50 and len(known.older) <= 50
    docs = table(spark, [(number, text) for number, text in enumerate(texts)])
    few = packing.cut_documents(docs, path, 128, chunks=50).collect()
    assert sorted(few) == sorted(packing.cut_documents(docs, path, 128).collect())
    assert corpus_pipeline.KEPT_CHUNKS <= 100_000


def test_packing_of_nothing(spark, staging):
    packed, _ = packing.pack(spark.createDataFrame([], "doc_id long, length long"), staging, 64)
    assert packed.collect() == []


def test_lower_bound_is_never_above_the_best():
    rng = np.random.default_rng(1)
    for _ in range(200):
        capacity = int(rng.integers(4, 60))
        sizes = rng.integers(1, capacity + 1, int(rng.integers(1, 40)))
        bins, offsets = packing.best_fit_decreasing(sizes, capacity)
        loads = np.bincount(bins, weights=sizes)
        assert loads.max() <= capacity and packing.lower_bound(sizes, capacity) <= len(loads)


def test_packing_query(spark):
    rows = llm_queries()["op1_best_fit_packing"](spark, SMALL).collect()
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    made = check_packing(rows, texts, 2048)
    assert made <= 1.02 * packing.lower_bound(np.array([r.length for r in rows]), 2048) + 1


def test_id_store(spark, staging):
    shards = staging.put(id_store.encode_shards(table(spark), tokenizer_path(WORD_TOKENIZER), shard_tokens=300, least=2), "shards")
    got = id_store.decode_shards(shards).join(id_store.shard_starts(shards), ["part", "shard"]).collect()
    got.sort(key=lambda r: r.before + r.shard_start)
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    known = defaultdict(list)
    for doc_id, text in TEXTS:
        known[doc_id].append(ids(text, 1))
    at = 0
    for r in got:
        assert r.before + r.shard_start == at
        own = np.frombuffer(r.ids, "<u4").tolist()
        known[r.doc_id].remove(own)
        at += r.n_tokens
    shard = max((r.asDict() for r in shards.collect()), key=lambda r: r["n_tokens"])
    whole = id_store.expand(np.frombuffer(shard["symbols"], "<u4"), np.frombuffer(shard["rules"], "<u4").reshape(-1, 2), shard["first_symbol"])
    assert len(shard["symbols"]) < 4 * shard["n_tokens"] * 0.6
    for start, length in ((0, 1), (7, 100), (shard["n_tokens"] - 1, 1), (3, shard["n_tokens"] - 3)):
        (read,) = id_store.ShardReader(shard).read(np.array([start]), np.array([length]))
        assert read.tolist() == whole[start : start + length].tolist()
    # No pair of unlike symbols is left that stands often enough, and the row says what that is.
    left = Counter(zip(symbols := np.frombuffer(shard["symbols"], "<u4").tolist(), symbols[1:]))
    assert shard["least"] == 2 and all(times < 2 for (a, b), times in left.items() if a != b)


def test_id_store_query(spark):
    docs = sorted(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id)
    expected, at = [], 0
    for r in docs:
        own = ids(r.text, 1)
        expected.append((r.doc_id, at, len(own), crc(own)))
        at += len(own)
    assert sorted(map(tuple, llm_queries()["op9_repair_id_store"](spark, SMALL).collect())) == expected


def plain_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, names):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, name in enumerate(names):
        if name is not None:
            least[find(i)] = min(least.get(find(i), name), name)
    return [least.get(find(i)) for i in range(len(prints))]


def test_simhash_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    prints = [plain_fingerprint(r.text) for r in docs]
    groups = plain_components(prints, [r.doc_id for r in docs])
    expected = sorted((r.doc_id, f"{p:016x}", g) for r, p, g in zip(docs, prints, groups))
    assert sorted(map(tuple, llm_queries()["op3_simhash_near_dedup"](spark, SMALL).collect())) == expected


@pytest.mark.parametrize("largest_run", [100_000, 20, 1])
def test_linked_fingerprints(spark, staging, largest_run):
    """A dense cloud of fingerprints, also with its keys counted as oversized."""
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    prints = []
    for centre in centres[:6].tolist():
        for _ in range(40):
            flips = rng.choice(64, int(rng.integers(0, 5)), replace=False)
            prints.append(centre ^ sum(1 << int(bit) for bit in flips))
    prints += centres.tolist()
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    marks = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    found = {r.fingerprint: r.root for r in simhash.near_components(marks, staging, largest_run=largest_run).collect()}
    groups = plain_components(prints, signed)
    mine = [found.get(p, p) for p in signed]
    assert len(set(zip(groups, mine))) == len(set(groups)) == len(set(mine))


def test_simhash_odd_rows(spark, staging):
    rows = simhash.near_duplicates(table(spark), staging).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        text = next(t for i, t in TEXTS if i == r.doc_id)
        assert r.fingerprint % (1 << 64) == plain_fingerprint(text)
    assert {r.component for r in rows if r.doc_id in (4, 5, 6)} == {4}


def test_quality_query(spark):
    query = llm_queries()["op4_host_quality_rules"]
    assert differences(query(spark, SMALL), connect(SMALL), llm_sql()["op4_host_quality_rules"]) == []


def test_quality_odd_rows(spark, staging):
    judged = host_rules.judge(table(spark), staging)
    rows = {r.row.doc_id: r for r in judged.collect()}
    assert judged.count() == len(TEXTS)
    assert {r.row.text_hash for r in judged.collect()} == {"x"}
    assert [rows[i].n_words for i in (1, 4, 5, 6, 9)] == [22, 0, 0, 0, 1]
    assert rows[7].n_repeat_words == 3000 and rows[7].base_failed and not rows[1].base_failed
    # Their one host fails too often, so all of it goes; by itself the first one stays.
    assert not any(r.kept for r in rows.values())
    assert host_rules.judge(table(spark, TEXTS[:3]), staging).where("kept").count() == 3
    assert host_rules.judge(table(spark, []), staging).collect() == []


def test_host_verdicts(spark, staging):
    """A bad host loses all its documents, one with many symbols those; a small unlucky host loses only its bad one."""
    good = " ".join(f"word{n} stands here" for n in range(12))
    symbols = good + " #" * 12
    rows = [(good, "fine")] * 400 + [("too short", "fine")] * 8 + [(good, "other")] * 300 + [(symbols, "other")] * 9
    rows += [(good, "bad")] * 20 + [("too short", "bad")] * 80 + [(good, "symbols")] * 60 + [(symbols, "symbols")] * 40
    rows += [(good, None)] * 50 + [("short", "unlucky")] + [(good, "unlucky")]
    docs = spark.createDataFrame([(n, t, s, "k", "h") for n, (t, s) in enumerate(rows)], "doc_id long, text string, source string, kept string, host string")
    judged = host_rules.judge(docs.repartition(4), staging).collect()
    kept = Counter((r.row.source, r.row.text == symbols, r.base_failed) for r in judged if r.kept)
    assert kept == {
        ("fine", False, False): 400,
        ("other", False, False): 300,
        ("other", True, False): 9,
        ("symbols", False, False): 60,
        (None, False, False): 50,
        ("unlucky", False, False): 1,
    }
    assert len(judged) == len(rows) and {r.row.kept for r in judged} == {"k"}


def test_hosts_of_the_given_tables_differ_by_chance_only(spark, staging):
    """Why no verdict changes a row there: all rates are far below the bounds."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    verdicts = host_rules.host_verdicts(host_rules.measure(docs, ["doc_id"]), host_rules.HostPolicy()).collect()
    assert len(verdicts) == 20 and not any(any(row[1:]) for row in verdicts)


def plain_lines(texts):
    """(rank of the document, its id, start, line) of every line, in rank order; equal rows are one document."""
    for doc_id, text in sorted(set(texts), key=lambda one: plain_rank(*one)):
        at = 0
        for line in (text or "").split("\n"):
            yield plain_rank(doc_id, text), doc_id, at, line
            at += len(line) + 1


def plain_rank(doc_id, text):
    own = xxhash.xxh64_intdigest((text or "").encode(), 42)
    return doc_id is None, doc_id or 0, own - (1 << 64) if own >> 63 else own


def words_of(text):
    return tuple(re.findall(r"[^\W_]+", text.lower()))


def plain_line_units(texts):
    """(doc_id, start, length, words) of lines and of their sentences of six words or more, in rank order."""
    for _, doc_id, at, line in plain_lines(texts):
        if not words_of(line):
            continue
        yield doc_id, at, len(line), words_of(line)
        for found in re.finditer(r"(?:[^.!?]|[.!?](?![.!?]*[ \t\x0b-\r]))+[.!?]*", line):
            sentence = found.group()
            begin = found.start() + len(sentence) - len(sentence.lstrip(" \t\x0b\x0c\r"))
            if len(words_of(sentence)) >= 6 and words_of(sentence) != words_of(line):
                yield doc_id, at + begin, len(sentence.strip(" \t\x0b\x0c\r")), words_of(sentence)


SUBSTRINGS = TEXTS + [
    (20, "Yes.\nThe passage of seven words stands here. And more of it follows after that one! Yes."),
    (21, "Before it, something. The passage of SEVEN words, stands here. Behind it, another thing altogether.\nYes"),
    (22, "the passage of seven words stands here\n\n...\n..."),
]


def test_substring(spark, staging):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + SUBSTRINGS
    seen, expected = {}, set()
    for doc_id, start, length, words in plain_line_units(texts):
        if words in seen:
            expected.add((doc_id, start, length, seen[words]))
        seen.setdefault(words, doc_id)
    rows = substring.repeated(staging.put(substring.units(table(spark, texts)), "units")).collect()
    assert {(r.doc_id, r.start, r.length, r.kept_doc_id) for r in rows} == expected
    left = substring.remove_repeats(table(spark, texts), staging).collect()
    assert len(left) == len(texts) and left[0].__fields__ == table(spark).columns
    kept = {r.doc_id: r.text for r in left}
    assert kept[1] == LONG and kept[2].strip() == "" and kept[4] is None and kept[22] == "\n...\n..."
    assert kept[21] == "Before it, something. Behind it, another thing altogether."


def test_substring_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    seen, expected = {}, set()
    for doc_id, start, length, words in plain_line_units(texts):
        if words in seen:
            expected.add((doc_id, start, length, seen[words]))
        seen.setdefault(words, doc_id)
    rows = llm_queries()["op2_substring_dedup"](spark, SMALL).collect()
    assert {(r.doc_id, r.start, r.length, r.kept_doc_id) for r in rows} == expected


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def test_line_dedup(spark, staging):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    line = "this line is long enough to be compared"
    odd = [line, line + "s", line[1:], line[:9] + "X" + line[10:], line[:9] + "Y" + line[10:], line[:5] + line[6:], line + "st"]
    texts += [(1000 + at, one + "\n" + one.upper()) for at, one in enumerate(odd)] + TEXTS
    texts += [(2000, "a\nab\nb\n \nba\nabc"), (2001, "xyz\nx\n日本")]
    # By rank: what went before, by its normal form and by the forms with one character less, to find all partners.
    before, expected = [], {}
    for _, doc_id, at, line in plain_lines(texts):
        plain = " ".join(line.lower().split())
        if not plain:
            continue
        equal = next((kept for other, kept in before if other == plain), None)
        near = next((kept for other, kept in before if within_one(plain, other)), None)
        if equal or near:
            expected[doc_id, at, len(line)] = (*(equal or near), 0 if equal else 1)
        before.append((plain, (doc_id,)))
    rows = line_dedup.matching_lines(table(spark, texts), staging).collect()
    assert {(r.doc_id, r.start, r.length): (r.kept_doc_id, r.edits) for r in rows} == expected
    assert {r.edits for r in rows} == {0, 1}
    assert line_dedup.matching_lines(table(spark, []), staging).collect() == []


def plain_katz(train, text, level_words, level_pairs, counts, pairs, histories):
    """Probability by recursion over dictionaries, with the module's discounts."""

    def p_word(word):
        return float(katz.unigram(np.array([counts.get(word, 0)]), level_words)[0])

    def p(word, context):
        if pairs.get((context, word)):
            return float(level_pairs.kept(np.array([pairs[context, word]]))[0]) / histories[context]
        if not histories.get(context):
            return p_word(word)
        followers = {w for c, w in pairs if c == context}
        left = 1 - sum(float(level_pairs.kept(np.array([pairs[context, w]]))[0]) / histories[context] for w in followers)
        return max(left, 1e-12) / max(1 - sum(map(p_word, followers)), 1e-12) * p_word(word)

    words = [*text.lower().split(), "\n"]
    return sum(np.log10(p(w, c)) for c, w in zip(["", *words], words)), p, p_word


def test_katz(spark, staging):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{n}" for n in range(40)]
    texts = [" ".join(rng.choice(vocabulary, 30, p=1 / np.arange(1, 41) / sum(1 / np.arange(1, 41)))) for _ in range(80)]
    texts[5] = texts[5] + " never seen"
    docs = spark.createDataFrame([(n, t, n % 10 == 5) for n, t in enumerate(texts)] + [(99, None, False)], "doc_id long, text string, held_out boolean")
    scored, total = katz.score(docs.repartition(3), staging, buckets=5)
    rows = {r.doc_id: r for r in scored.collect()}
    counts, pairs, histories = Counter(), Counter(), Counter()
    train = [t for n, t in enumerate(texts) if n % 10 != 5] + [""]
    for text in train:
        words = [*text.lower().split(), "\n"]
        counts.update(words)
        for context, word in zip(["", *words], words):
            pairs[context, word] += 1
            histories[context] += 1
    histories["\n"] = 0
    level = lambda c: katz.Level(sum(c.values()), len(c), [sum(v == r for v in c.values()) for r in range(1, 7)])
    words, both = level(counts), level(pairs)
    assert total == words.tokens and len(rows) == 81
    for n, text in [*enumerate(texts), (99, "")]:
        expected, p, p_word = plain_katz(train, text, words, both, counts, pairs, histories)
        assert rows[n].score == pytest.approx(expected, abs=1e-9)
        own = [*text.lower().split(), "\n"]
        v = len(counts)
        base = sum(np.log10((counts[w] + 0.1) / (total + 0.1 * (v + 1))) for w in own)
        assert rows[n].base_score == pytest.approx(base, abs=1e-9)
        assert (rows[n].n_tokens, rows[n].n_known) == (len(own), sum(counts[w] > 0 for w in own))
    # All words after a context, with the words that were never seen, have probability 1 together.
    unseen = max(1, sum(v == 1 for v in counts.values())) * p_word("never")
    share = sum(map(p_word, counts))
    assert share + unseen == pytest.approx(1)
    weight = p("never", "w0") / p_word("never")
    assert sum(p(w, "w0") for w in counts) + weight * unseen == pytest.approx(1)


def test_katz_spread_contexts(spark, staging):
    """The begin of documents and a word of more than 1,000 tokens are spread: their weights need the sums of all buckets."""
    texts = [f"a{n % 31} the b{n % 47} the c{n % 13}" for n in range(700)]
    held = {700: "never the never", 701: "the a1", 702: "c1 never"}
    rows = [(n, t, False) for n, t in enumerate(texts)] + [(n, t, True) for n, t in held.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    scored = {r.doc_id: r.score for r in katz.score(docs.repartition(1), staging, buckets=7)[0].collect()}
    counts, pairs, histories = Counter(), Counter(), Counter()
    for text in texts:
        words = [*text.split(), "\n"]
        counts.update(words)
        pairs.update(zip(["", *words], words))
        histories.update(["", *words[:-1]])
    level = lambda c: katz.Level(sum(c.values()), len(c), [sum(v == r for v in c.values()) for r in range(1, 7)])
    for n, text in held.items():
        assert scored[n] == pytest.approx(plain_katz(texts, text, level(counts), level(pairs), counts, pairs, histories)[0], abs=1e-9)


def test_katz_block_holds_few_arrays_of_its_tokens():
    rng = np.random.default_rng(5)
    tokens, lengths = rng.integers(0, 5000, 400_000), np.full(1000, 400)
    row = {"lengths": katz.squeezed(lengths), "words": np.arange(5000, dtype=np.uint64).tobytes(), "tokens": katz.squeezed(tokens)}
    row["held_out"] = (np.arange(1000) % 10 == 0).tolist()
    tracemalloc.start()
    joined, place, counts = katz.Block(row).pairs()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    context = np.concatenate([[5000], tokens[:-1]])
    context[::400] = 5000
    expected, where = np.unique(context << 32 | tokens, return_inverse=True)
    assert (joined == expected).all() and (place == where).all()
    assert (counts == np.bincount(where, weights=np.repeat(np.arange(1000) % 10 != 0, 400))).all()
    assert peak < 48 * len(tokens)


def test_tidy_write_removes_its_shuffle_files(spark, staging):
    seen = []

    class Write:
        def parquet(self, path, compression=None):
            seen.append(spark.conf.get(FILE_CLEANUP))
            spark.range(1).write.parquet(path)

    class Frame:
        schema, write = "id bigint", Write()

    before = spark.conf.get(FILE_CLEANUP)
    assert staging.put(Frame(), "tidy", tidy=True).count() == staging.put(Frame(), "plain").count() == 1
    assert seen == ["true", before] and spark.conf.get(FILE_CLEANUP) == before


def test_katz_of_nothing(spark, staging):
    empty = spark.createDataFrame([], "doc_id long, text string, held_out boolean")
    assert katz.score(empty, staging)[0].collect() == []
    only_held_out = spark.createDataFrame([(1, "a b", True)], empty.schema)
    assert [r.score for r in katz.score(only_held_out, staging)[0].collect()] == [0.0]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    result = [i]
    for j, y in enumerate(b, 1):
        result.append(min(row[j - 1] + (x != y), row[j] + 1, result[-1] + 1))
    return result


def test_automaton_finds_what_edit_distance_finds():
    terms = ["idiot", "worthless", "scum", "disgusting", "moron"]
    trie = toxicity.Trie()
    for term in terms:
        trie.add(term, False)
    trie.add("lowe", True)
    matches = toxicity.Matches(trie)
    words = ["idiot", "idjot", "idot", "idioot", "scumm", "scum", "worthles", "wrthlss", "morn", "maron", "loweiab", "low", "gisdusting", "x"]
    for word in words:
        near = sorted((edits(word, t), t) for t in terms if edits(word, t) <= toxicity.edit_bound(len(t)))
        expected = ("lowe", 0) if word.startswith("lowe") else (near[0][1], near[0][0]) if near and len(word) >= 3 else None
        assert matches[word] == expected, word


def test_quoted_hits_count_apart():
    trie = toxicity.Trie()
    trie.add("moron", False)
    matches = toxicity.Matches(trie)
    abuse, quoted = toxicity.features("you are such a moron", matches), toxicity.features('he said "moron" once', matches)
    assert abuse[0] > 0 == abuse[1] and quoted[1] > 0 == quoted[0] and toxicity.features(None, matches) == [0.0] * toxicity.FEATURES


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = llm_queries()["op6_lexicon_toxicity"](spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    hit = sum(r.predicted and labels[r.doc_id] for r in held)
    assert hit >= 0.6 * sum(labels[r.doc_id] for r in held) and hit >= 0.8 * sum(r.predicted for r in held)


def test_copies_are_thinned_in_any_order(spark):
    rows = [(1, "you are a fool", 0), (2, "you are a fool", 1), (3, "you are a fool", 1), (4, "another text", 0), (5, None, 0), (5, None, 0)]
    results = set()
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        for parts in (1, 3):
            texts = spark.createDataFrame(order, "doc_id long, text string, toxic int").repartition(parts)
            results.add(frozenset((r.doc_id, r.text, r.toxic) for r in toxicity.one_of_copies(texts).collect()))
    (kept,) = results
    assert len(kept) == 3 and {(4, "another text", 0), (5, None, 0)} < kept and next(r for r in kept if r[0] in (1, 2, 3))[2] == 1


def test_toxicity_without_labels(spark, staging):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(table(spark), labels, staging)
    assert all(r.score < 1e-12 for r in toxicity.score(table(spark), model, ["doc_id"]).collect())


def all_segmentations(lattices, text):
    """Every path with its weight, by recursion."""
    spaced = "▁" + text.replace(" ", "▁")

    def ends(at):
        found = [(end, lattices.piece[spaced[at:end]]) for end in range(at + 1, len(spaced) + 1) if spaced[at:end] in lattices.piece]
        if not any(end == at + 1 for end, _ in found):
            found.append((at + 1, (-1, sum(lattices.bytes[b][1] for b in spaced[at].encode()))))
        return found

    def walk(at, weight):
        if at == len(spaced):
            yield weight
        for end, (_, own) in ends(at) if at < len(spaced) else []:
            yield from walk(end, weight + own)

    return list(walk(0, 0.0))


def test_sampled_segmentations(spark):
    path = tokenizer_path(PIECE_TOKENIZER)
    lattices = piece_sampling.Lattices(path)
    text = "the cat, é"
    weights = np.array(all_segmentations(lattices, text))
    total = np.logaddexp.reduce(weights)
    found = piece_sampling.sample_texts(lattices, [text] * 4000, np.arange(4000, dtype=np.uint64), 3)
    firsts = Counter()
    for samples in found:
        assert len({one[1].tobytes() for one in samples}) == 3  # distinct
        assert samples[0][3] >= samples[1][3] >= samples[2][3]
        for one in samples:
            assert np.isclose(weights - total, one[2], atol=1e-9).any() and 0 < one[4] <= 1
        firsts[round(samples[0][2], 9)] += 1
    # The first sample is drawn from the distribution itself.
    expected = Counter()
    for weight in weights:
        expected[round(weight - total, 9)] += np.exp(weight - total)
    for log_p, share in expected.items():
        assert abs(firsts[log_p] / 4000 - share) < 4 * np.sqrt(share * (1 - share) / 4000) + 1e-3
    # Without replacement, all segmentations come when there are fewer than asked for.
    few = piece_sampling.sample_texts(lattices, ["q"], np.zeros(1, np.uint64), 50)[0]
    assert len(few) == len(all_segmentations(lattices, "q")) and np.isclose(sum(np.exp(one[2]) for one in few), 1)
    assert [len(one[1]) for one in piece_sampling.sample_texts(lattices, [""], np.zeros(1, np.uint64), 2)[0]] == [0]


def test_sampling_decodes(spark):
    path = tokenizer_path(PIECE_TOKENIZER)
    samples = piece_sampling.sample_segmentations(table(spark), path, ["doc_id"], 2)
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in samples.collect():
        spelled = library.decode(np.frombuffer(r.ids, "<u4").tolist())
        texts = [(t or "").replace("▁", " ") for i, t in TEXTS if i == r.doc_id]
        assert spelled in texts
    decoded = piece_sampling.decode(samples, path, ["doc_id"]).collect()
    assert all(r.text in [(t or "").replace("▁", " ") for i, t in TEXTS if i == r.doc_id] for r in decoded)


def test_sampling_query(spark):
    rows = llm_queries()["op8_gumbel_piece_sampling"](spark, SMALL).collect()
    assert all(r.decodes for r in rows) and {r.sample for r in rows} == {1, 2}


def nearest(vectors, query_id, k=20):
    query = vectors[query_id]
    scored = sorted((-float((v * query).sum()), i) for i, v in vectors.items() if i != query_id)
    return [(i, -s) for s, i in scored[:k]]


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.1"])
def test_tree_search(spark, folder):
    vectors = {
        r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect() if r.embedding is not None
    }
    found = defaultdict(dict)
    for r in llm_queries()["op10_kmeans_tree"](spark, folder).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    queries = [i for i in vectors if i % 20 == 0]
    assert set(found) == set(queries)
    hits = total = 0
    for query_id in queries:
        truth = nearest(vectors, query_id)
        own = [found[query_id][rank] for rank in range(1, len(found[query_id]) + 1)]
        assert all(s == pytest.approx(float(vectors[i] @ vectors[query_id]), abs=1e-12) for i, s in own)
        assert own == sorted(own, key=lambda x: (-x[1], x[0])) and len(own) == len(truth)
        hits += len({i for i, _ in own} & {i for i, _ in truth})
        total += len(truth)
    assert hits / total >= 0.9


def test_tree_search_odd_vectors(spark, staging):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, [nan, 1.0]), (60, [inf, 1.0]), (80, None), (None, [1.0, 1.0]), (100, [None, 1.0])]
    rows += [(n, [2.0, 1.0]) for n in range(1, 8)]
    vectors = kmeans_tree.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = kmeans_tree.search(vectors, vectors.where("vec_id % 20 = 0"), staging, k=3).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 3, 2.0)]
    # Repeated ids, also with another vector, count once; the length that most vectors have is the one searched.
    again = [(0, [1.0, 0.0]), (0, [1.0, 1.0]), (3, [2.0, 1.0]), (8, [9.0]), (20, [1.0, 2.0, 3.0])]
    twice = kmeans_tree.usable(spark.createDataFrame(rows + again, "vec_id long, embedding array<float>"))
    got = kmeans_tree.search(twice, twice.where("vec_id % 20 = 0"), staging, k=3).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 3, 2.0)]
    empty = vectors.where("false")
    assert kmeans_tree.search(empty, empty, staging).collect() == []


def test_pipeline_stages(spark):
    docs = table(spark, TEXTS + [(50 + n, " ".join(f"w{n}x{m}" for m in range(40))) for n in range(4)])
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
        sizes.append(docs.count())
    assert docs.columns == table(spark).columns
    # Rules leave documents of 20 words and more; of the copies 1, 2, 2, 3 one stays.
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert {1, 50, 51, 52, 53} <= set(kept) and kept[1] == LONG and not {4, 5, 6, 9} & set(kept)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    check_packing(packed, list(kept.items()), 2048)


def test_pipeline_of_nothing(spark):
    docs = table(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.collect() == []


def test_shard_ranges_are_read_without_expanding_each(monkeypatch):
    """All ranges of a shard, empty ones and those at its end too, from one expansion of its rules."""
    ids = np.tile(np.array([5, 6, 7, 8, 5, 6], "<u4"), 200)
    symbols, rules = id_store.compress(ids, 10, 4, 2)
    shard = {
        "first_symbol": 10, "rules": rules.tobytes(), "symbols": symbols.tobytes(),
        "rule_tokens": id_store.expansion_lengths(rules, 10).astype("<u4").tobytes(),
    }
    calls, plain = [], id_store.expand
    monkeypatch.setattr(id_store, "expand", lambda *given: calls.append(1) or plain(*given))
    starts, lengths = np.array([0, 3, 700, 700, 1199, 1200, 0]), np.array([1, 50, 0, 500, 1, 0, 1200])
    read = id_store.ShardReader(shard).read(starts, lengths)
    assert [one.tolist() for one in read] == [ids[a : a + n].tolist() for a, n in zip(starts, lengths)]
    assert len(calls) == 1
