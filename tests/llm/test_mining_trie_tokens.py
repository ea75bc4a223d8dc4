"""Hard negatives, the prefix trie and token counts against brute force, the library, and odd rows."""

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from martloom.llm import negatives, tokens, trie
from martloom.llm.queries import QUERIES
from martloom.session import scratch_path

BASE = "/root/testdata/sf0.001"


# hard negatives

VECTORS = "vec_id bigint, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 65, 40), (70, 129, 300), (256, 64, 500), (100, 0, 90)])
def test_strassen_is_exact(shape):
    n, d, m = shape
    made = np.random.default_rng(3)
    a, b = made.integers(-2 ** 27, 2 ** 27, (n, d)), made.integers(-2 ** 27, 2 ** 27, (d, m))
    assert (negatives.strassen(a, b) == (a.astype(object) @ b.astype(object) if d else np.zeros((n, m)))).all()


def test_heaps_merge():
    made = random.Random(5)
    entries = [(made.randrange(4), made.randrange(6), made.randrange(50)) for _ in range(200)]
    heaps = negatives.Heaps(5, 3)
    for at in range(0, 200, 7):
        heaps.push(*(np.array(column) for column in zip(*entries[at:at + 7])))
    held = sorted(zip(*(c.tolist() for c in heaps.entries())))
    best = [e for h in range(4) for e in sorted((e for e in entries if e[0] == h), key=lambda e: (-e[1], e[2]))[:3]]
    assert held == sorted(best)


def mined_by_hand(rows, anchor, positives=5, negative_count=10, low=30, high=90):
    """The definition on lists: every anchor against every row."""
    good = [(i, label, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, v in {i: (i, label, v) for i, label, v in sorted(good, reverse=True) if anchor(i)}.values():
        near = heapq.nsmallest(positives, ((-score(v, w), j) for j, other, w in good if other == label and j != i))
        for minus, j in near:
            fit = sorted((-score(v, w), k) for k, other, w in good
                         if other != label and -30 * minus <= 100 * score(v, w) <= -90 * minus)
            out += [(i, j, rank, k, -minus, -s) for rank, (s, k) in enumerate(fit[:negative_count], 1)]
    return sorted(out)


def mined(df, anchor):
    found = negatives.hard_negatives(df, anchor)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_negatives_brute_force_over_many_chunks(spark, monkeypatch):
    made = random.Random(11)
    rows = [(i, [round(made.gauss(0.4, 0.5), 1) for _ in range(5)], made.randrange(3)) for i in range(400)]
    rows += [(1000 + i, [0.5] * 5, 1 + i % 2) for i in range(200)]  # a third of all rows is one vector
    monkeypatch.setattr(negatives, "ANCHOR_CHUNK", 5 * 8 * 7)
    monkeypatch.setattr(negatives, "CANDIDATE_CHUNK", 5 * 8 * 90)
    monkeypatch.setattr(negatives, "TILE_ANCHORS", 3)
    monkeypatch.setattr(negatives, "TILE_CANDIDATES", 40)
    df = spark.createDataFrame(rows, VECTORS)
    assert mined(df, F.col("vec_id") % 20 == 0) == mined_by_hand(rows, lambda i: i % 20 == 0)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 2.0, 3.0], 1), (2, [], 1), (3, None, 1), (4, [1.0, None], 1), (5, [nan, 1.0], 2),
            (6, [1.0, inf], 2), (None, [9.0, 9.0], 1), (7, [0.5, 1.0], None), (8, [0.5, 1.0], 2), (8, [0.5, 1.0], 2), (9, [-1.0, -2.0], 2),
            (10, [0.5], 2), (20, [-1.0, 0.0], 3), (30, [1.5, 0.5], 2)]
    clashing = spark.createDataFrame(rows, VECTORS)
    for name in ("_id", "_label", "_vector", "_anchor", "_a", "_c", "rank", "positive_id"):
        clashing = clashing.withColumn(name, F.lit("x"))
    assert mined(clashing, F.col("vec_id") % 10 == 0) == mined_by_hand(rows, lambda i: i % 10 == 0) != []
    assert mined(clashing.limit(0), F.col("vec_id") % 10 == 0) == []
    assert mined(clashing, F.lit(False)) == []


def test_negatives_refuse_scores_beyond_64_bits(spark):
    with pytest.raises(ValueError, match="64 bits"):
        negatives.hard_negatives(spark.createDataFrame([(0, [3e38], 1)], VECTORS), F.lit(True))


# prefix trie

TURNS = "conv_id bigint, turn bigint, role string, text string"


def trie_by_hand(rows, splice=True):
    """Nodes as tuples of the result's columns, from lists of turns."""
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            said[conv].append((turn is not None, turn or 0, digest, (role, text)))
    own = {conv: [t for *_, t in sorted(turns)] for conv, turns in said.items()}
    rebuilt = own
    if splice:
        rebuilt = {}
        for conv, turns in own.items():
            h = zlib.crc32(str(conv).encode()) % 9
            base = conv - (conv % 5 if conv >= 0 else -(-conv % 5))
            rebuilt[conv] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for conv, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    saved, leaves, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, convs in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * (len(node[-1][1].encode()) if node else 0)
            leaves[node[:d]] += not children[node]
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(node))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_of(df, splice=True, **options):
    turns = trie.turns_of(df)
    nodes = trie.prefix_trie(trie.spliced(turns) if splice else turns, turns.filter("number = 1").select("conv"), **options)
    return sorted((tuple(r) for r in nodes.collect()), key=str)


def test_trie_brute_force_with_shards_crown_and_spills(spark):
    made = random.Random(2)
    rows = []
    for conv in range(-7, 90):
        for turn in range(made.choice([0, 1, 1, 2, 3, 4, 9, 30])):
            rows.append((conv, made.choice([turn, turn, None]), made.choice("ab"), made.choice(["x", "y", "x", "long ä"])))
    # a conversation with a third of all turns, its copy, and copies cut off at every length
    long = [(turn, "u", f"turn {turn // 3}") for turn in range(60)]
    for conv, turns in [(200, long), (205, long), *[(300 + 5 * n, long[:n]) for n in range(1, 50)]]:
        rows += [(conv, *t) for t in turns]
    made.shuffle(rows)
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    expected = trie_by_hand(rows)
    assert trie_of(df) == expected
    assert trie_of(df, bound=1, held=2) == expected
    assert trie_of(df, bound=10 ** 6, held=1) == expected
    assert trie_of(df, splice=False, bound=4) == trie_by_hand(rows, splice=False)


def test_conversation_that_crosses_partitions(spark):
    """All turns of one conversation, dealt over many range partitions, and one partition with several."""
    rows = [(7, turn, "u", f"{turn % 5}") for turn in range(250)] + [(conv, 0, "u", "a") for conv in (1, 2, 6, 8, 9)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert trie_of(spark.createDataFrame(rows, TURNS), splice=False) == trie_by_hand(rows, splice=False)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_trie_of_odd_rows(spark):
    rows = [(None, 0, "u", "gone"), (1, None, None, None), (1, None, None, None), (1, 0, "", ""), (5, 1, "u", "x"), (5, 1, "u", "x"), (5, 1, "s", "x"),
            (6, 3, None, "x" * 100_000), (11, 0, "u", "only own"), (2 ** 63 - 1, 0, "u", "x"), (-2 ** 63, 0, "u", "x")]
    df = spark.createDataFrame(rows, TURNS)
    for name in ("conv", "number", "digest", "n_bytes", "prefix", "depth", "_turn", "_row", "_to"):
        df = df.withColumn(name, F.lit("x"))
    assert trie_of(df) == trie_by_hand(rows)
    assert trie_of(df.limit(0)) == []


def test_spilling_queue():
    made = random.Random(9)
    queue, kept, out = trie.SpillingQueue(held=5, most_files=2), [], []
    for _ in range(3_000):
        if kept and made.random() < 0.4:
            assert queue.first() == kept[0]
            out.append((queue.pop(), heapq.heappop(kept)))
        else:
            item = made.randrange(100), made.randrange(100)
            queue.push(item)
            heapq.heappush(kept, item)
    while kept:
        out.append((queue.pop(), heapq.heappop(kept)))
    assert queue.first() is None and all(a == b for a, b in out)


# token counts


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.Tokenizer(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return lambda text: len(model.encode(text))


def test_counts_by_word_are_the_library_s(tokenizer, library):
    made = random.Random(4)
    signs = [*"ab  \t\n▁é<s>/0x\U0001f600　ﬁ\x00", "</s>", "<0x0A>", "   ", "<unk>", "word", "x" * 60]
    texts = ["".join(made.choices(signs, k=made.randint(0, 14))) for _ in range(20_000)] + ["long text " * 30_000, " " * 5_000]
    assert tokenizer.by_words
    assert tokenizer.counts(texts) == [library(t) for t in texts]


def test_forgotten_words_are_encoded_again(tokenizer, library, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_WORDS", 3)
    one = tokens.Tokenizer(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["a b c d e f", "f e d", "a a g" * 20]
    assert one.counts(texts) == [library(t) for t in texts]


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{BASE}/documents.parquet").collect()
    found = {tuple(r) for r in QUERIES["op13_token_counts"](spark, BASE).collect()}
    assert found == {(d.doc_id, len((d.text or "").encode()), library(d.text or ""), library(d.text or "") > 4096) for d in docs}


def test_only_distinct_misses_are_encoded(spark, tokenizer, library):
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (2, None), (3, ""), (4, "three"), (None, "one two")], "doc_id bigint, text string")
    for name in ("digest", "content", "_digest", "version", "n_bytes", "n_tokens"):
        docs = docs.withColumn(name, F.lit("x"))
    cache = scratch_path(spark, "cache")
    counted = tokens.count_tokens(docs, tokenizer, cache)
    assert counted.columns == ["doc_id", "text", "digest", "content", "_digest", "version", "n_bytes", "n_tokens"]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in counted.collect()) == sorted(
        (str(i), len(t), library(t)) for i, t in [(1, "one two"), (1, "one two"), (2, ""), (3, ""), (4, "three"), (None, "one two")])
    stored = spark.read.parquet(cache)
    assert stored.count() == 3
    # a second run encodes nothing, a third only what is new, in few as in many rows
    tokens.add_missing(docs, tokenizer, cache)
    assert spark.read.parquet(cache).count() == 3
    more = docs.unionByName(docs.limit(1).withColumn("text", F.lit("new words")))
    tokens.add_missing(more, tokenizer, cache)
    assert spark.read.parquet(cache).count() == 4
    many = more.unionByName(docs.limit(1).withColumn("text", F.lit("newer")))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(tokens, "is_bounded", lambda df: False)
        tokens.add_missing(many, tokenizer, cache)
    assert spark.read.parquet(cache).count() == 5
    # a stored count is taken as it is, also where two runs stored it
    spark.read.parquet(cache).limit(2).write.mode("append").parquet(f"{cache}-2")
    spark.read.parquet(f"{cache}-2").withColumn("n_tokens", F.lit(99).cast("bigint")).write.parquet(f"{cache}-3")
    known = {bytes(r.digest) for r in spark.read.parquet(f"{cache}-3").union(spark.read.parquet(f"{cache}-3")).collect()}
    for row in tokens.count_tokens(docs, tokenizer, f"{cache}-3").collect():
        assert (row.n_tokens == 99) == (hashlib.sha256((row.text or "").encode()).digest() in known)


def test_versions_do_not_mix(spark, tokenizer):
    other = tokens.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    docs, cache = spark.createDataFrame([(1, "text of <|endoftext|> two")], "doc_id bigint, text string"), scratch_path(spark, "cache")
    first = tokens.count_tokens(docs, tokenizer, cache).collect()
    second = tokens.count_tokens(docs, other, cache).collect()
    assert first[0].n_tokens == tokenizer.counts(["text of <|endoftext|> two"])[0]
    assert second[0].n_tokens == other.counts(["text of <|endoftext|> two"])[0] and not other.by_words
    assert spark.read.parquet(cache).select("version").distinct().count() == 2
    assert tokens.count_tokens(docs.limit(0), tokenizer, cache).collect() == []
    assert tokens.count_tokens(docs.limit(0), tokenizer, f"{cache}-new").collect() == []
