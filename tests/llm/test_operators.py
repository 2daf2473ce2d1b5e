"""Corpus operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import base64
import hashlib
import os
import random
import time
import weakref

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sensorwarden.llm import byte_bpe, chat, common, components, decontaminate, jaccard_join, quality, toxicity, warc
from sensorwarden.llm.chunks import squeezed
from sensorwarden.llm.exact_dedup import distinct_rows, exact_dedup
from sensorwarden.llm.line_dedup import keep_bitmaps, line_dedup
from sensorwarden.llm import exact_dedup as exact_dedup_module
from sensorwarden.llm import substring_dedup as substring_module
from sensorwarden.llm.substring_dedup import substring_dedup
from sensorwarden.llm.words import word_hashes

from . import brute

SCHEMA = "doc_id long, text string, id string, content string, chunk int, words array<string>, edge int"


def order(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def table(spark, documents):
    """documents with columns whose names clash with those inside the operators."""
    rows = [(doc, text, "x", "y", 1, ["z"], 2) for doc, text in documents]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def invented(seed=1):
    """Texts with copies, near copies, shared passages and lines, and all the odd cases."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(300)]

    def prose(n):
        words = [rng.choice(vocabulary) for _ in range(n)]
        return "".join(w + (" " if rng.random() < 0.9 else "\n") for w in words).strip()

    passage, line = prose(60), "A Line that Everybody has"
    texts = [prose(rng.randint(1, 120)) for _ in range(30)]
    base = prose(100)
    texts += [base, base, base.replace(" ", "  "), base.upper()]
    for _ in range(25):  # near copies with a few changed words
        words = base.split(" ")
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = "changed" + str(rng.random())
        texts.append(" ".join(words))
    texts += [prose(30) + "\n" + line + "\n" + passage + " " + prose(20) for _ in range(12)]
    texts += [f"  {line.upper()}\t\n" + prose(3) for _ in range(4)]
    texts += [None, "", " \n\t ", "one", "ONE", "one two three", "\n\n", prose(30000), "a" * 100000, "\x1c\x85 \xa0b"]
    documents = list(enumerate(texts))
    rng.shuffle(documents)
    return documents


@pytest.fixture(scope="module")
def documents():
    return invented()


def test_exact_dedup(spark, documents):
    rows = [*documents, documents[0], (None, "x y"), (None, "xy"), (7000, None), (7001, " ")]
    got = exact_dedup(table(spark, rows))
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert order(got.collect()) == order(brute.exact(rows))
    kept = distinct_rows(table(spark, rows))
    assert kept.columns == SCHEMA.replace(" array<string>", " a").replace(",", "").split()[::2]
    assert order(r["doc_id"] for r in map(lambda r: {"doc_id": (r[0],)}, kept.collect())) == order(
        (r[0],) for r in brute.exact(rows) if r[3]
    )


def test_exact_dedup_splits_a_hot_group(spark):
    rows = [(i, "same text") for i in range(3000)] + [(5000 + i, f"text {i}") for i in range(50)]
    got = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).filter("group_size = 3000")
    assert got.count() == 3000 and got.filter("kept").count() == 1
    assert {r[0] for r in got.select("keep_id").distinct().collect()} == {0}
    assert distinct_rows(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).count() == 51


@pytest.mark.parametrize("keep_first", [False, True])
def test_line_dedup(spark, documents, keep_first):
    rows = [*documents, (None, "one\nA line that everybody HAS")]
    got = line_dedup(table(spark, rows), min_docs=5, min_chars=2, keep_first=keep_first)
    assert order(got.collect()) == order(brute.without_lines(rows, 5, 2, keep_first))


def test_line_bitmaps_are_runs(spark):
    rows = [(i, "x\nx\nown%d\nx" % i) for i in range(3)]
    got = keep_bitmaps(spark.createDataFrame(rows, "doc_id long, text string"), min_docs=3)
    assert {tuple((r.start, r.end) for r in row.dropped) for row in got.collect()} == {((0, 2), (3, 4))}


def test_line_dedup_of_a_repeated_row(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (2, "a")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert order(line_dedup(frame, min_docs=2).select("doc_id", "n_lines", "n_dropped").collect()) == [(1, 2, 1), (1, 2, 1), (2, 1, 1)]
    assert line_dedup(frame, min_docs=3).filter("n_dropped > 0").isEmpty()  # an id counts once


def test_substring_dedup(spark, documents):
    rows = [*documents, (900, "w " * 80), (901, " ".join(map(str, range(70)))), (902, " ".join(map(str, range(20, 90))))]
    got = substring_dedup(table(spark, rows), window=35)
    assert order(got.drop("spans").collect()) == order(brute.without_repeats(rows, 35))
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in got.collect()}
    assert spans[900] == [(0, 80)] and spans[901] == [(20, 70)] and spans[902] == [(0, 50)]


def test_substring_dedup_survives_colliding_hashes(monkeypatch):
    def collide(words, seed=0):
        return word_hashes(words, seed) if seed else np.ones(len(words), np.uint64)

    monkeypatch.setattr(substring_module, "word_hashes", collide)
    texts = [" ".join(f"{side}{i}" for i in range(9)).encode() for side in "abca"]
    layout = substring_module.Layout([len(t) for t in texts], squeezed(b"".join(texts)))
    repeats = substring_module.Repeats(layout, np.ones(len(layout.hashes), bool), 6, 3, 4)
    rows = list(repeats.questions(0))
    answers = [{"bucket": r[0], "data": a} for r, a in zip(rows, substring_module.repeat_answer(rows), strict=True)]
    gone = repeats.covered(answers, 6, len(layout.hashes))
    assert gone.tolist() == [True] * 9 + [False] * 18 + [True] * 9  # only the text that is there twice


def test_substring_dedup_any_window(spark, documents):
    got = substring_dedup(table(spark, documents), window=6, with_text=True)
    assert order(got.drop("spans", "kept").collect()) == order(brute.without_repeats(documents, 6))
    assert all(brute.sha(r.kept) == r.kept_sha256 for r in got.collect())


@pytest.mark.parametrize("percent, words", [(85, 4), (80, 5), (60, 2)])
def test_jaccard_components(spark, documents, percent, words):
    got = jaccard_join.jaccard_components(table(spark, documents), percent, words)
    expected = brute.components(documents, percent, words)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == expected


def test_jaccard_components_of_stars(spark):
    """Many near copies in groups of equal prefixes, chains through members of stars."""
    rng = random.Random(5)
    rows = []
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(90)]
        for k in range(30):
            words = list(base)
            for _ in range(k % 6):
                words[rng.randrange(90)] = rng.choice("pqrs") + str(family)
            rows.append((100 * family + k, " ".join(words[: 90 - k % 4])))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 85, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.components(rows, 85, 4)


def test_jaccard_components_of_one_large_family(spark):
    """Near copies around the threshold: one component by leaders, few comparisons for what is left."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(250):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 80, 5)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.components(rows, 80, 5)


def test_jaccard_components_of_a_family_without_a_middle(spark, monkeypatch):
    """Near copies of which few are linked to any one leader: few turns, and postings within a component are left out."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for k in range(200):
        words = list(base)
        for at in rng.sample(range(100), 2):
            words[at] = f"x{at}{rng.randrange(3)}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(f"y{k // 2}z{i}" for i in range(30 - k % 2))) for k in range(60)]  # done after a turn
    turns, compared, written = [], [], jaccard_join.written

    def counted(frame, name, *more):
        table = written(frame, name, *more)
        if name in ("led", "pivots"):
            compared.append(table.count())
        if name == "postings":
            turns.append(table.count())
        return table

    monkeypatch.setattr(jaccard_join, "written", counted)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 85, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.components(rows, 85, 4)
    assert len(compared) <= 5 and turns[1] < turns[0]


def test_jaccard_comparisons_follow_the_components(spark, monkeypatch):
    """A family that one turn of leaders leaves in many components needs a few comparisons per text, not all its pairs."""
    rng = random.Random(17)
    base = [f"w{i}" for i in range(130)]
    rows = []
    for k in range(240):
        words = list(base)
        for at in rng.sample(range(130), 2):
            words[at] = f"x{at}y{rng.randrange(40)}"
        rows.append((k, " ".join(words)))
    compared, verified = [], jaccard_join.verified

    def counted(pairs, sets):
        compared.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(jaccard_join, "verified", counted)
    monkeypatch.setattr(jaccard_join, "WORTH_A_TURN", 10**9)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 80, 4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.components(rows, 80, 4)
    assert sum(compared) < 10 * len(rows), compared


def test_jaccard_tables_of_few_rows_are_few_files(spark, monkeypatch):
    """However many partitions a shuffle has, a small table is not a file of each."""
    rng = random.Random(23)
    rows = []
    for k in range(90):
        words = [f"w{k // 30}v{i}" for i in range(100)]
        for at in rng.sample(range(100), 2):
            words[at] = f"x{at}{rng.randrange(3)}"
        rows.append((k, " ".join(words)))
    files, written = {}, common.written

    def counted(frame, name, *more, **named):
        result = written(frame, name, *more, **named)
        files.setdefault(name, []).append(len(result.inputFiles()))
        return result

    monkeypatch.setattr(jaccard_join, "written", counted)
    monkeypatch.setattr(components, "written", counted)
    conf = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 85, 4)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.components(rows, 85, 4)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    for name in ("set-classes", "sets", "groups", "units", "postings", "led", "links", "labels", "placed", "pivots"):
        assert max(files[name]) <= 8, files


@pytest.fixture
def many_partitions(spark):
    """Shuffles of 48 partitions, none of them merged."""
    conf = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def counting(monkeypatch, module):
    """Files of each table that a module writes, by name."""
    files, written = {}, common.written

    def counted(frame, name, *more, **named):
        result = written(frame, name, *more, **named)
        files.setdefault(name, []).append(len(result.inputFiles()))
        return result

    monkeypatch.setattr(module, "written", counted)
    return files


def test_distinct_rows_of_few_documents_are_few_files(spark, monkeypatch, many_partitions):
    """Several ranges are one task then; a group that spreads over ranges is still one row."""
    rows = [(i, "same text") for i in range(3000)] + [(5000 + i, f"text {i}") for i in range(500)]
    rows += [(9000 + i, f" te xt{i}") for i in range(0, 500, 3)] + [(None, None), (4, "")]
    files = counting(monkeypatch, exact_dedup_module)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = order(distinct_rows(docs, rows=docs.count()).collect())
    assert max(files["exact-firsts"]) <= 4, files
    assert got == order(distinct_rows(docs).collect())
    texts = dict(rows[:-2]) | {4: ""}
    assert got == order((doc, texts[doc]) for doc, *_, kept, _ in brute.exact(rows) if kept)


def test_jaccard_candidates_of_few_rows_are_few_files(spark, many_partitions):
    """Pairs of a small table, whatever partitions they come from."""
    units = [(u, 10, 10, [7], [10] + [0] * (jaccard_join.CELLS - 1)) for u in range(60)]
    units = spark.createDataFrame(units, "u long, n long, shared long, prefix array<long>, outline array<smallint>")
    placed = units.select("u", "n", F.col("prefix")[0].alias("shingle"), F.col("shared").alias("rest"), F.col("u").alias("comp"))
    pairs = common.written(jaccard_join.component_pairs(placed, units, 80), "pairs-again")
    assert len(pairs.inputFiles()) <= 4
    assert order(pairs.select("a", "b").collect()) == order((a, b) for a in range(60) for b in range(a + 1, 60))


def test_tasks_without_a_table_let_go_of_the_one_before():
    class Table:
        pass

    table = common.worker_table("of an operator before", Table)
    table.own, gone = table, weakref.ref(table)
    del table
    assert list(exact_dedup_module._firsts(iter(()))) == []
    assert gone() is None


def test_jaccard_components_of_repeated_ids(spark):
    """Every text of a repeated id keeps its links, and so does a text without an id."""
    base = [f"w{i}" for i in range(60)]
    near, nearer = [*base[:59], "y"], [*base[:58], "z", "y"]
    rows = [(5, "some other text of five words"), (5, " ".join(base)), (9, " ".join(base)), (7, " ".join(near)), (None, " ".join(nearer)), (8, "alone")]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 85, 4)
    assert order(got.select("doc_id", "component_id").collect()) == order([(5, 5), (5, 5), (9, 5), (7, 5), (None, 5), (8, 8)])


def test_jaccard_components_of_odd_ids(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (3, "other words than those"), (None, "alone it is"), (4, None), (5, "")]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 85, 4)
    assert order(got.select("doc_id", "component_id").collect()) == order([(None, 3), (3, 3), (3, 3), (None, None), (4, 4), (5, 5)])


def test_contained_items(spark, documents, monkeypatch):
    long = next(t for _, t in documents if t and len(t.split()) > 20000).split()
    items = [(1, " ".join(long[500:540])), (2, " ".join(long[9:14]).encode().upper().decode()), (3, None), (4, "one"), (5, "not to be found anywhere at all")]
    items += [(6, " ".join(long[800:830] + ["new"] + long[830:840])), (7, ""), (8, " ".join(long[100:130]) + " x" * 40), (None, "one")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    expected = order(brute.contained(documents, items, 80, 5))
    got = decontaminate.contained_items(table(spark, documents), frame)
    assert order(got.collect()) == expected and {1, 2, 4, 6} <= {r.item_id for r in got.collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 20)  # more items than fit take several passes
    assert order(decontaminate.contained_items(table(spark, documents), frame).collect()) == expected
    clean = decontaminate.decontaminated(table(spark, documents), frame)
    assert clean.columns[:2] == ["doc_id", "text"] and len(clean.columns) == 7
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in documents} - {r[0] for r in brute.contained(documents, items, 80, 5)}


@pytest.fixture(scope="module")
def vocabulary():
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return file.read()


def test_byte_bpe_equals_tiktoken(spark, documents, vocabulary):
    import tiktoken

    ranks = byte_bpe.read_ranks(vocabulary)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    odd = ["日本語 🤣 ‍", "aaaa" * 50, "it's we'LL", "   \n\n x", "<|endoftext|>", "\x00\x7f", "é" * 300, "12345 ٣٤"]
    rows = [*documents, *((1000 + i, t) for i, t in enumerate(odd))]
    got = byte_bpe.encode_documents(
        table(spark, rows), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True
    )
    texts = dict(rows)
    for row in got.collect():
        ids = library.encode_ordinary(texts[row.doc_id] or "")
        packed = np.array(ids, "<u4").tobytes()
        assert bytes(row.ids) == packed and row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()
    assert got.count() == len(rows)


def test_transducer_within_small_bounds(vocabulary, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK", 7)
    import tiktoken

    ranks = byte_bpe.read_ranks(vocabulary)
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN, table_bytes=40_000)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choices("abtheing rst éü日 1.\n", k=rng.randint(0, 60)))
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
        assert "".join(byte_bpe.decode_stream(packed, encoder.transducer.tokens, 2)) == text


def test_one_long_piece_does_not_fill_the_tables(vocabulary):
    import tiktoken

    ranks = byte_bpe.read_ranks(vocabulary)
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN, table_bytes=4 << 20)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyz", k=30_000))
    assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)
    assert not encoder and encoder.transducer.bytes <= (2 << 20) + 10_000 and len(encoder.transducer.states) < 3000


def test_utf8_stream():
    data = "aé日🤣".encode() + b"\xff" + "é".encode()[:1]
    for n in (1, 2, 3, 50):
        stream = byte_bpe.Utf8Stream()
        parts = [stream.feed(data[i : i + n]) for i in range(0, len(data), n)]
        assert "".join(parts) + stream.close() == data.decode(errors="replace")


PARTS = chat.PART


def test_long_texts_take_linear_time(spark):
    """200,000 lines and a conversation of 50,000 turns end in seconds."""
    started = time.time()
    text = "\n".join(f"line {i}" if i % 2 else "common" for i in range(200_000))
    frame = spark.createDataFrame([(1, text), *((i, "common") for i in range(2, 12))], "doc_id long, text string")
    row = line_dedup(frame, min_docs=10).filter("doc_id = 1").first()
    kept = "\n".join(f"line {i}" for i in range(1, 200_000, 2))
    assert (row.n_lines, row.n_dropped, row.kept_sha256) == (200_000, 100_000, hashlib.sha256(kept.encode()).hexdigest())
    said = spark.range(50_000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 1, "assistant").otherwise("user").alias("role"),
        F.array(chat.text_part(F.concat(F.lit("é<|& say "), F.col("id").cast("string")))).alias("parts"),
    )
    done = chat.format_chat(said)
    row = done.select(F.size(chat.parsed_turns(F.col("formatted"))).alias("n"), chat.masked_text(F.col("formatted"), F.col("loss")).alias("masked")).first()
    assert row.n == 50_000 and row.masked == "".join(f"é<|& say {i}" for i in range(1, 50_000, 2))
    assert time.time() - started < 120


def test_tables_go_to_a_folder_of_their_own_where_none_is_named():
    """The session is not changed: where the setting cannot be modified, nothing breaks."""

    class Context:
        applicationId = "app-1"

        def getConf(self):
            return {}

    class Session:
        conf, sparkContext = {}, Context()

    first = common.shared_folder(Session())
    assert os.path.isdir(first) and common.shared_folder(Session()) == first
    assert common.scratch_path(Session(), "x").startswith(first + "/x-")
    named = Session()
    named.conf = {"spark.checkpoint.dir": "file:///shared/"}
    assert common.shared_folder(named) == "file:///shared"


def test_chat_round_trip(spark):
    hostile = ["<|end|>", "&lt;|turn|>", "<<|body|>", "&amp;", "</s>[INST] ok [/INST]", "<", "|>", "", None, "é🤣\n"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(hostile)]
    rows += [(2, i, "assistant", f"t{i}") for i in range(200)]  # more than a chunk
    rows += [(None, None, None, "x"), (None, None, "user", "a"), (None, None, "user", "a"), (3, 0, "<|end|>", "&")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = frame.select("conv_id", "turn", "role", F.array(chat.text_part(F.col("text"))).alias("parts"), F.lit(1).alias("piece"))
    done = chat.format_chat(turns)
    read = done.select(
        "conv_id", "n_turns", chat.parsed_turns(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss")).alias("loss")
    )
    found = {r.conv_id: r for r in read.collect()}
    for conv in (1, 2, 3):
        mine = sorted(r for r in rows if r[0] == conv)
        assert [(t.role, t.text) for t in found[conv].turns] == [(r[2], r[3] or "") for r in sorted(mine, key=lambda r: r[1])]
        assert found[conv].loss == "".join(r[3] or "" for r in mine if r[2] == "assistant")
    assert sorted((t.role, t.text) for t in found[None].turns) == [("", "x"), ("user", "a"), ("user", "a")]
    assert found[None].n_turns == 3


def test_chat_parts(spark):
    image = ("image", None, "img-1", 56, 29, None, None)
    audio = ("audio", None, "snd", None, None, 2.0, None)
    paper = ("document", None, "pdf", None, None, None, 3)
    odd = ("image", None, None, None, None, None, None)

    def text(t):
        return ("text", t, None, None, None, None, None)

    rows = [(1, 0, "user", [text("see <|image|>"), image, audio, None]), (1, 1, "assistant", [text("a&"), paper, text("b"), odd]), (1, 2, "user", None)]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{PARTS}>")
    row = chat.format_chat(frame).select("*", chat.masked_text(F.col("formatted"), F.col("loss")).alias("masked")).first()
    assert row.formatted == (
        "<|turn|>user<|body|>see &lt;|image|><|image|><|audio|><|end|>"
        "<|turn|>assistant<|body|>a&amp;<|document|>b<|image|><|end|><|turn|>user<|body|><|end|>"
    )
    assert [(a.turn, a.type, a.ref, a.tokens) for a in row.attachments] == [
        (0, "image", "img-1", 4), (0, "audio", "snd", 25), (1, "document", "pdf", 768), (1, "image", None, 1)
    ]
    assert row.attachment_tokens == 798 and row.masked == "a&b" and row.n_turns == 3


def test_warc(spark):
    html = ["<p>a</p>", "<p>a</p>", None, "", "x\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc", "é" * 1000, "<p>a</p>", "y" * 300000]
    pages = [(i, f"http://www.h{i % 3}.example/p?q={i}\r\nX: y", h, "n") for i, h in enumerate(html)]
    pages += [(None, None, "<p>a</p>", "n"), (9, "not a url [", "alone", "n"), (9, "u", "alone", "n")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, digest string")
    got = warc.archived_index(frame).collect()
    expected = []
    for page, _, h, _ in pages:
        data = (h or "").encode()
        top = max(p for p, _, o, _ in pages if (o or "") == (h or "") and p is not None)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page, len(data), digest, "response" if page == top else "revisit", None if page == top else top))
    assert order((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == order(expected)
    keys = [(r.urlkey, r.ts) for r in got]
    assert keys == sorted(keys)
    assert warc.archived_index(frame, min_bytes=9).filter("record_type = 'revisit'").isEmpty()


def test_loser_tree():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((str(rng.randrange(9)), "t", rng.randrange(9)) for _ in range(rng.randrange(6))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(row for run in runs for row in run)


def test_url_key():
    assert warc.url_key("HTTPS://www.Example.org:443/A?b=1#c") == "org,example)/a?b=1"
    assert warc.url_key("example.org") == "org,example)/"


CURSES = ["gruntle", "snarkle", "blifter"]


def toxic_rows(seed=4, hidden=False):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 8))) for _ in range(200)]
    swap = {"e": "3", "a": "@", "i": "1", "t": "7"}
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        for _ in range(3 * bad):
            curse = rng.choice(CURSES)
            if hidden:
                curse = rng.choice([" ".join(curse), "".join(swap.get(c, c) for c in curse), curse[:2] + curse[2] * 5 + curse[3:], ".".join(curse)])
            words.insert(rng.randrange(len(words)), curse)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_rows()
    documents = table(spark, [*rows, (None, None), (9999, "")])
    marks = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(documents, marks)
    hidden, truth = toxic_rows(seed=8, hidden=True)
    scored = toxicity.score_toxicity(table(spark, [*rows, *((1000 + i, t) for i, t in hidden), (None, None)]), model).collect()
    score = {r.doc_id: r.score for r in scored}
    assert all((score[i] >= 0.5) == bool(t) for i, _, t in labels)
    assert sum((score[1000 + i] >= 0.5) == bool(t) for i, _, t in truth) >= 0.97 * len(truth)
    assert len(scored) == len(rows) + len(hidden) + 1 and 0 <= score[None] < 0.5


def test_toxicity_of_doubled_substituted_and_spread_words(spark):
    curses = [*CURSES[:2], "goblet"]  # LEET can spell all of goblet
    rows, labels = toxic_rows()
    rows = [(i, text.replace(CURSES[2], curses[2])) for i, text in rows]
    documents = table(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(documents, marks)
    forms = [c[: k + 1] + c[k:] for c in curses for k in range(1, len(c) - 1)]  # one doubled letter
    forms += [gap.join(c) for c in curses for gap in ("  ", "\n", " \t ", "\r\n\r\n")]
    forms += ["608137", "(608137)", "608!37!", "grruntl3", "s n a a r k l e", "gob|e7", "goblet!"]
    clean = [text for i, text in rows if i % 4 > 0]
    clean += [f"{text} 2024 4,096 - + (1) 100% good tree x = 3 | 7" for text in clean[:40]]
    hidden = [(k, f"{clean[k % 40]} {form} {clean[-1 - k % 40]}") for k, form in enumerate(forms)]
    scored = toxicity.score_toxicity(table(spark, hidden + [(1000 + k, t) for k, t in enumerate(clean)]), model).collect()
    score = {r.doc_id: r.score for r in scored}
    assert [form for k, form in enumerate(forms) if score[k] < 0.5] == []
    assert sum(score[1000 + k] >= 0.5 for k in range(len(clean))) <= 0.01 * len(clean)


def test_toxicity_with_noisy_labels(spark):
    rows, labels = toxic_rows()
    noisy = [(i, quality, int(bad and i % 5 < 2)) for i, quality, bad in labels]  # a sixth of the clean labels is wrong
    documents = table(spark, rows)
    marks = spark.createDataFrame(noisy, "doc_id long, quality int, toxic int")
    assert not toxicity.fit_toxicity(documents, marks).weights
    model = toxicity.fit_toxicity(documents, marks, min_lift=2.0)
    score = {r.doc_id: r.score for r in toxicity.score_toxicity(documents, model).collect()}
    assert sum((score[i] >= 0.5) == bool(bad) for i, _, bad in labels) >= 0.97 * len(labels)


def test_toxicity_without_documents(spark):
    marks = spark.createDataFrame([(1, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    empty = table(spark, [(1, "a")]).filter("false")
    model = toxicity.fit_toxicity(empty, marks)
    assert not model.weights and toxicity.score_toxicity(empty, model).collect() == []
    assert 0 <= toxicity.score_toxicity(table(spark, [(1, "a b")]), model).first().score < 0.5


def test_toxicity_without_labels(spark):
    documents = table(spark, [(1, "a b c"), (2, None)])
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = {r.score for r in toxicity.score_toxicity(documents, toxicity.fit_toxicity(documents, marks)).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() < 0.5


def test_held_out(spark):
    from zlib import crc32

    rows = spark.range(50).select(toxicity.held_out(F.col("id")).alias("held"), "id").collect()
    assert all(r.held == (crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_quality(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("aeioulnrst", k=rng.randint(2, 8))) for _ in range(200)] + ["the", "of", "and"] * 40
    rows = []
    for i in range(300):
        text = [rng.choice(words) for _ in range(rng.randint(40, 200))]
        prose = " ".join(w + ("." if j % 9 == 8 else "") for j, w in enumerate(text)).capitalize()
        junk = [" ".join(w for w in text[:10] for _ in range(9)), " ".join(w + "%%%" for w in text), prose.upper().replace(" ", "!! "), " | ".join(text)]
        rows.append((i, junk[i % 4] if i % 5 == 0 else prose))
    scored = quality.score_quality(table(spark, [*rows, (None, None), (800, ""), (801, " \n")])).collect()
    keep = {r.doc_id: r.keep for r in scored}
    assert len(scored) == 303 and all(0 <= r.score <= 1 and 0 <= r.weak_label <= 1 for r in scored)
    assert sum(keep[i] == (i % 5 > 0) for i, _ in rows) >= 0.97 * len(rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    frames = [
        exact_dedup(empty), distinct_rows(empty), line_dedup(empty), substring_dedup(empty), jaccard_join.jaccard_components(empty),
        decontaminate.contained_items(empty, items), decontaminate.contained_items(empty, items.limit(0)),
        decontaminate.decontaminated(empty, items), byte_bpe.encode_documents(empty, ranks, public_tokenizers.PATTERN),
        quality.score_quality(empty),
        chat.format_chat(spark.createDataFrame([], f"conv_id long, turn long, role string, parts array<{PARTS}>")),
        warc.archived_index(spark.createDataFrame([], "page_id long, url string, html string")),
    ]
    assert all(frame.isEmpty() for frame in frames)
