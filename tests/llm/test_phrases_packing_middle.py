"""Collocations, packing and fill-in-middle against plain Python, on tables with all the odd cases."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from sensorwarden.llm import collocations as phrases
from sensorwarden.llm import middle, packing
from sensorwarden.llm.queries import QUERIES

from . import brute

SCHEMA = "doc_id long, text string, lang string, w1 string, rank int, n long, length int, chunk string, output string"

WORDS = public_tokenizers.path("word_bpe_49k.json")


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def table(spark, rows):
    """(id, text, lang) with columns whose names clash with those inside the operators."""
    return spark.createDataFrame([(*r, "x", 1, 2, 3, "y", "z") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(3)
    words = ["the", "of", "New", "york", "city", "Élan", "naïve", "x", "数据", "data😀", "\x1c", "a\xa0b"]

    def prose(n):
        return "".join(rng.choice(words) + rng.choice(["  ", " ", " ", "\t", ", ", ".\n", " new york city "]) for _ in range(n))

    rows = [(i, prose(rng.randint(0, 80)), rng.choice(["en", "de", None, "und"])) for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, " \t\n", "fr"), (103, "one", "fr"), rows[0], (None, "of the data", "en")]
    rows += [(104, prose(20_000), "en"), (105, "é" * 70_000 + "数" * 50_000 + "a" * 70_000, "xx"), (106, "<P> x <M", "en")]
    rows += [(107, "the the the the the the the", "en"), (108, "\x0b.\x0c!", "en"), (109, "<|endoftext|> it's İstanbul ΑΣ Σ é", "en")]
    return rows


# --- collocations ------------------------------------------------------------------------------------------------------


def brute_collocations(rows, min_count, width, top, percent, factor):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, width + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        covered = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                covered |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * a >= percent * f[p[i : i + k]]}
        scored = []
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((factor * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


@pytest.mark.parametrize(("min_count", "width", "top", "chunk_bytes"), [(3, 4, 2000, 1 << 22), (1, 3, 40, 700), (20, 5, 7, 3000), (2, 2, 5, 1 << 22)])
def test_collocations(spark, documents, min_count, width, top, chunk_bytes):
    got = phrases.collocations(table(spark, documents), min_count, width, top, chunk_bytes=chunk_bytes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert order(got.collect()) == order(brute_collocations(documents, min_count, width, top, 80, 2_000_000))


def test_windows_are_counted_once_per_word(spark, documents):
    windows = phrases.window_counts(table(spark, documents), 3, 4)
    words = sum(len(re.findall(r"[^\x20\x09-\x0D.,;:!?]+", (t or ""))) for _, t, _ in documents)
    assert windows.groupBy().sum("n").first()[0] == words
    assert windows.groupBy("lang", "w1", "w2", "w3", "w4").count().filter("count > 1").isEmpty()


def test_scores_are_exact_beyond_64_bits(spark):
    frame = spark.createDataFrame([("en", "a", "b", 10**15), ("en", "a", None, 7), ("en", "b", None, 10**15)], "lang string, w1 string, w2 string, n long")
    counted, totals = phrases.phrase_counts(frame, 30, 2)
    assert {(r.phrase, r.f) for r in counted.collect()} == {("a b", 10**15), ("a", 10**15 + 7), ("b", 10**15)}
    assert totals.first().n == 2 * 10**15 + 7
    score = spark.range(1).selectExpr(f"cast((2000000 * cast({10**17} as decimal(20,0))) div (cast({2 * 10**17} as decimal(20,0)) + 1) as bigint)")
    assert score.first()[0] == 2_000_000 * 10**17 // (2 * 10**17 + 1)


def test_collocations_of_nothing(spark):
    assert phrases.collocations(table(spark, [])).collect() == []
    assert phrases.collocations(table(spark, [(1, None, None), (2, "", "en")])).collect() == []


# --- packing -----------------------------------------------------------------------------------------------------------


def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return tokenizer


def check_packed(rows, capacity, ids_of, near=1.05):
    """Every piece is there, sequences are gapless and full enough."""
    pieces, sequences, total = Counter(), defaultdict(list), 0
    for r in rows:
        pieces[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    expected = Counter()
    for doc, ids in ids_of:
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected[doc, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert pieces == expected
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= max(1, near * -(-total // capacity))


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(spark, documents, capacity):
    tokenizer = library()
    ids = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t, _ in documents]
    got = packing.pack_documents(table(spark, documents), WORDS, capacity)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check_packed(got.collect(), capacity, ids)


def test_packed_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    tokenizer = library()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    ids = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in docs]
    check_packed(QUERIES["op12_best_fit_packing"](spark, sf).collect(), 4096, ids, near=1.01)


def test_sequences_are_assembled(spark, documents):
    packed = packing.pack_documents(table(spark, documents), WORDS, 256, with_ids=True)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.assembled(packed).collect()}
    for r in packed.collect():
        part = whole[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and part.tobytes() == r.ids


def test_words_are_tokenised_like_whole_texts(documents):
    with open(WORDS, encoding="utf-8") as file:
        words = packing.WordTokenizer(file.read(), cache_bytes=2000)
    texts = [t or "" for _, t, _ in documents] + ["x́ ́y \x85   z's 'T don't 12 345"]
    texts += ["Word. word, WORD!? é. É! İ. aİ.. ne.w 'll. x1. 数. ΑΣ. a\u0301. .. . a\0b \0 \0\0 \0. \x85 " + "L" * 80 + "." + " !" * 3]
    expected = [np.array(e.ids, "<u4").tobytes() for e in library().encode_batch(texts, add_special_tokens=False)]
    assert list(packing.encoded_texts(words, [t.encode() for t in texts])) == expected
    long = " ".join(texts).encode() * 3
    assert b"".join(packing.segments(long, 1000)) == long and len(list(packing.segments(long, 1000))) > 100
    assert max(len(k) for k in words.known) <= packing.LONG_WORD


def test_new_words_are_tokenised_together():
    """Few texts go to the library, also with words that hold the mark, are spaces beyond ASCII or no letters at all."""
    with open(WORDS, encoding="utf-8") as file:
        words = packing.WordTokenizer(file.read())
    seen, real = [], words.library

    class Counted:
        def encode_batch_fast(self, texts, **more):
            seen.extend(texts)
            return real.encode_batch_fast(texts, **more)

    words.library = Counted()
    rng = random.Random(4)
    odd = ["|", "||", "a|b", "|a", "\uff5c", "\u2223", "\u0301x", "\u00a0", "\u3000a\u3000", "\x85", "'s", "'", "\u1100\u1161", "\u212b", "\U0001f600|"]
    made = odd + ["".join(rng.choice("abcdé'.,-1\u0301ß\u00a0数") for _ in range(rng.randint(1, 9))) for _ in range(4000)]
    rng.shuffle(made)
    text = " ".join(made)
    assert words.encode([text.encode()]) == [np.array(library().encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert len(seen) < 200


def test_packing_of_nothing(spark):
    assert packing.pack_documents(table(spark, []), WORDS).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 100, 1000, 4096])
    counts = {rng.randint(1, capacity): rng.choice([1, 2, 3, 50, 10**9]) for _ in range(rng.randint(1, 300))}
    plan = packing.packing_plan(counts, capacity)
    used = Counter()
    for pattern, times in plan:
        assert times > 0 and sum(length * n for length, n in pattern) <= capacity
        for length, n in pattern:
            used[length] += n * times
    assert used == Counter(counts) and len(plan) <= 4 * len(counts) + 4
    if sum(counts.values()) < 20_000:
        slots = packing.slots_of(plan)
        lengths = np.concatenate([np.full(n, length) for length, n in counts.items()])
        ranks = np.concatenate([np.arange(n) for n in counts.values()])
        shuffled = np.random.default_rng(seed).permutation(len(ranks))
        sequence, offset = packing.placed(slots, lengths[shuffled], ranks[shuffled])
        end = defaultdict(int)
        for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), lengths[shuffled].tolist(), strict=True)):
            assert end[s] == o
            end[s] += n
        assert len(end) == sum(times for _, times in plan)


def test_exact_complements_are_found():
    singles = packing.packing_plan({60: 10, 40: 10}, 100)
    assert sum(times for _, times in singles) == 10 and len(singles) == 1
    triples = packing.packing_plan({61: 5, 20: 5, 12: 5, 7: 5}, 100)  # only all four fill a sequence
    assert sorted(triples[0][0]) == [(7, 1), (12, 1), (20, 1), (61, 1)] and triples[0][1] == 5
    same = packing.packing_plan({50: 7}, 100)  # two of one length; the seventh stays alone
    assert sorted(times for _, times in same) == [1, 3]


def test_plan_of_many_lengths_is_quick():
    """Few pieces of nearly every length: most searches for three lengths that fill a gap are in vain."""
    rng, counts = random.Random(2), Counter()
    for _ in range(3000):
        counts[min(4096, max(1, int(rng.lognormvariate(6.5, 1))))] += 1
    began = time.process_time()
    plan = packing.packing_plan(counts, 4096)
    assert time.process_time() - began < 2
    used = Counter()
    for pattern, times in plan:
        used.update({length: n * times for length, n in pattern})
    assert used == counts


# --- fill in middle ----------------------------------------------------------------------------------------------------


def brute_middle(rows):
    out = []
    for doc, text, _ in rows:
        text = text or ""
        digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
        n = len(text)
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            out.append((doc, n, "plain", None, None, brute.sha(text), brute.sha(text)))
            continue
        pre, mid, suf = text[:a], text[a:b], text[b:]
        spm = h4 % 100 < 20
        done = f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}"
        out.append((doc, n, "spm" if spm else "psm", a, b - a, brute.sha(done), brute.sha(text)))
    return out


def test_fill_in_middle(spark, documents):
    got = middle.fill_in_middle(table(spark, documents))
    assert order(got.collect()) == order(brute_middle(documents))
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}
    assert middle.fill_in_middle(table(spark, [])).collect() == []


def test_outputs_give_the_text_back(spark, documents):
    texts = {(d, t or "") for d, t, _ in documents}
    got = middle.fill_in_middle(table(spark, documents), with_output=True).collect()
    assert {(r.doc_id, middle.restored(r.output.encode(), r.form).decode()) for r in got} == texts


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("a" * 200_000, middle.Runs),
        ("é" * 100_000, middle.Bitmap),
        ("x" + "数😀" * 30_000, middle.Bitmap),
        ("😀" * 3_000, middle.Array),
        ("".join(random.Random(1).choices("aé数😀", k=150_000)), middle.Bitmap),
        ("", None),
        ("a" * 65_535, None),
        ("a" * 65_536, None),
        ("a" * 65_535 + "é", None),
    ],
)
def test_boundaries(text, kind):
    data = text.encode()
    offsets = [0, *np.cumsum([len(c.encode()) for c in text]).tolist()]
    found = middle.BoundarySet(data)
    assert len(found) == len(offsets)
    for k in {0, len(text), *random.Random(2).sample(range(len(text) + 1), min(500, len(text) + 1))}:
        assert found.select(k) == offsets[k]
    assert kind is None or isinstance(found.containers[0], kind)
    with pytest.raises(IndexError):
        found.select(len(offsets))


def test_markers_are_checked():
    with pytest.raises(ValueError):
        middle.Infill(prefix="<S>")
    with pytest.raises(ValueError):
        middle.Infill(middle="abab")
