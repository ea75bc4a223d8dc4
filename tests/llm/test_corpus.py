"""Operators on documents: brute force, planted cases, and rows that are null, empty, long, repeated or oddly named."""

import hashlib
import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from check_oracle import compare, oracle_connection
from pyspark.sql import functions as F

import corpus_pipeline
from martloom.llm import decontaminate, language, lines, mixing, neardup, quality, toxicity
from martloom.llm.queries import ORACLES, QUERIES
from martloom.llm.texts import code_points, shingle_set, sieve, table

BASE = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + [word] if word else out


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def prose(seed, n):
    made = random.Random(seed)
    return " ".join("".join(made.choices("abcdefghijklmnopqrst", k=made.randint(2, 9))) for _ in range(n))


ODD = [
    (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \t\n ", "en", None, 4), (None, prose(1, 60), "en", "b", 1),
    (4, prose(2, 60), "de", "b", 1), (4, prose(2, 60), "de", "b", 1), (5, prose(2, 60), "de", "c", 1), (6, "one two", "en", "c", 7),
    (7, "One TWO", None, "c", 7), (8, prose(3, 30_000), "fr", "c", 9), (9, "ÄÖ ünï ½ — 日本語のテキスト\n" * 30, "de", "c", 1),
    (10, "x" * 200_000, "en", "a", 1), (11, "a\n\n\nb\n", "en", "a", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with further columns named like those the operators make."""
    docs = spark.createDataFrame(ODD, DOCS)
    for name in ("hash", "hashes", "keeper", "rep", "key", "kept", "size", "place", "shard", "words", "leak", "item_id", "coverage", "score",
                 "_good", "_hashes", "_rest", "_leaks", "_id", "n_lines", "n_dropped", "target", "before", "n", "label"):
        docs = docs.withColumn(name, F.lit(name))
    return docs


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, BASE, "documents")


@pytest.fixture(scope="module")
def benchmark(spark):
    return table(spark, BASE, "benchmark")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(BASE)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle(spark, oracle, key):
    assert compare(QUERIES[key](spark, BASE), oracle, ORACLES[key]) == ""


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in ORACLES and "op9" not in k))
def test_one_row_each(spark, key):
    name = "pages" if key.split("_")[0] in ("op4", "op5", "op7") else "documents"
    found, rows = QUERIES[key](spark, BASE), table(spark, BASE, name)
    column = rows.columns[0]
    assert sorted(r[0] for r in found.select(column).collect()) == sorted(r[0] for r in rows.select(column).collect())


# --- near-duplicates

def brute_groups(rows):
    """Components by comparing every two different sets."""
    sets = {}
    for doc_id, text in rows:
        w = words_of(ascii_lower(text or ""))
        size = min(5, len(w))
        sets[doc_id] = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_duplicates_brute_force(spark):
    made = random.Random(5)
    rows = [(i, prose(i, made.randint(1, 90))) for i in range(60)]
    for i in range(60, 150):  # chains of edits, copies, shared passages
        words = rows[made.randrange(len(rows))][1].split()
        for _ in range(made.randint(0, 3)):
            words[made.randrange(len(words))] = "changed" + str(made.randint(0, 3))
        rows.append((i, " ".join(words)))
    rows += [(i, prose(99, 40) + " " + prose(i, 40)) for i in range(150, 190)]
    found = neardup.duplicate_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute_groups(rows)


def test_near_duplicates_on_the_sample(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = QUERIES["op1_near_duplicates"](spark, BASE).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute_groups(rows)


def test_large_bucket_is_compared_in_blocks(spark, monkeypatch):
    """A small block size and division bound leave the groups as they are."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(neardup, "DIVIDE_ABOVE", 8)
    base, rows, made = prose(7, 120).split(), [], random.Random(3)
    for i in range(60):
        words = list(base)
        for _ in range(made.randint(0, 5)):
            words[made.randrange(len(words))] = f"w{made.randint(0, 9)}"
        rows.append((i, " ".join(words)))
    rows += [(i, " ".join(base[:70]) + " " + prose(i, 40)) for i in range(60, 110)]
    found = neardup.duplicate_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found} == brute_groups(rows)


@pytest.mark.parametrize("above", [4, 2048])
def test_pair_that_shares_only_a_crowded_bucket_is_linked(spark, monkeypatch, above):
    """Whether the bucket counts as crowded or not, and whatever frequent shingles all its members share."""
    monkeypatch.setattr(neardup, "DIVIDE_ABOVE", above)
    frame = spark.createDataFrame
    hot, reps = list(range(1, 41)), range(20)
    own = lambda i: [1000 * (i + 1) + j for j in range(100)]
    whole = {i: hot + own(i) for i in reps} | {2: hot + own(1)[:95] + [5, 77777]}  # 1 and 2 are similar, the others are not
    sets = frame([(i, bytearray(np.unique(np.array(x, np.uint64)).tobytes())) for i, x in whole.items()], "rep bigint, shingles binary")
    members = frame([(7, i, 20, 0) for i in reps], "key bigint, rep bigint, n bigint, leader bigint")
    bands = frame([(i, [7, 100 + i]) for i in reps], "rep bigint, bands array<bigint>")
    marks = frame([(i, bytearray(neardup.COORDINATES)) for i in reps], "rep bigint, marks binary")
    found = neardup.remaining_links(members, frame([], "rep bigint, label bigint"), marks, bands, sets)
    assert [tuple(r) for r in found.select("a", "b").collect()] == [(1, 2)]


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 25])
def test_sieve_lets_all_wanted_rows_pass(spark, bits):
    rows = spark.createDataFrame([(i, i, "x") for i in range(2_000)] + [(None, 0, "x")], "doc_id bigint, _word bigint, _mask string")
    passed = {r[0] for r in sieve(rows, "doc_id", rows.filter("doc_id % 40 = 7").select("doc_id"), bits).collect()}
    assert passed >= set(range(7, 2_000, 40)) and sieve(rows, "doc_id", rows.select("doc_id").limit(0), bits).collect() == []
    if bits == 1 << 25:
        assert len(passed) <= 60
    assert sieve(rows, "doc_id", rows.select("doc_id"), bits).columns == rows.columns


def test_signature_estimates_similarity():
    a = np.arange(1, 1001, dtype=np.uint64)
    b = np.arange(201, 1201, dtype=np.uint64)
    agreeing = (neardup.signature(a) == neardup.signature(b)).mean()
    assert abs(agreeing - 800 / 1200) < 0.12
    pieces = np.minimum(neardup.signature(a[:300]), neardup.signature(a[300:]))
    assert (pieces == neardup.signature(a)).all()


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "a bigint, b bigint")
    assert {tuple(r) for r in neardup.components(links).collect()} == {(i, 0) for i in range(301)}


def test_near_duplicates_of_odd_rows(odd, none):
    found = sorted((tuple(r) for r in neardup.duplicate_groups(odd).collect()), key=str)
    by_id = {r[0]: r for r in found}
    assert len(found) == len(ODD)
    assert by_id[None][2:] == (None, True)
    assert [by_id[i][1:] for i in (1, 2, 3)] == [(0, 1, True), (0, 2, True), (0, 3, True)]
    assert by_id[4][2:] == (4, True) and by_id[5][2:] == (4, False) and by_id[7][2:] == (6, False)
    assert sum(r[0] == 4 for r in found) == 2
    assert neardup.duplicate_groups(none).count() == 0
    kept = neardup.keep_one_each(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, *_ in ODD if i not in (5, 7))


# --- quality

def brute_facts(text):
    text = text or ""
    words = words_of(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    marked = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(marked),
            len(words) < 10 or 100 * len(marked) > 20 * len(words))


def test_quality_facts_brute_force(spark, docs, odd):
    for rows in (docs, odd):
        expected = Counter((r.doc_id, *brute_facts(r.text)) for r in rows.collect())
        assert Counter(tuple(r)[:7] for r in quality.judge(rows).collect()) == expected


def test_order_of_rules_does_not_change_the_verdict(docs):
    verdict = [r[0] for r in docs.select(quality.quality_facts(quality.RULES)("text").alias("f")).select("f.kept").collect()]
    for rules in (quality.RULES[::-1], quality.cascade_order(docs)):
        assert [r[0] for r in docs.select(quality.quality_facts(rules)("text").alias("f")).select("f.kept").collect()] == verdict
    assert 0.5 < sum(verdict) / len(verdict) < 1


def test_rules_are_ordered_by_rejections_per_second(monkeypatch, docs):
    cost = {"a": (10, 1, 1.0), "b": (10, 5, 1.0), "c": (10, 5, 0.1), "d": (10, 0, 0.1)}
    monkeypatch.setattr(quality, "measure_rules", lambda *_: cost)
    rules = tuple(quality.Rule(name, lambda f: True) for name in "abcd")
    assert [r.name for r in quality.cascade_order(docs, rules)] == ["c", "b", "a", "d"]


def test_quality_finds_labelled_junk(spark):
    base = "/root/testdata/sf0.01"
    judged = quality.judge(table(spark, base, "documents")).join(table(spark, base, "labels"), "doc_id").filter("n_words >= 20")
    share = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.97 and share[0] < 0.05


def test_quality_stage(odd, none):
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} <= {None, 4, 5, 8, 9, 10, 11}
    assert quality.keep_good(none).count() == 0 and quality.judge(none).count() == 0


# --- lines

def test_lines_of_odd_rows(spark, odd, none):
    rows = [(1, "Shared line 1 \nown"), (2, "  SHARED line 1\nshort\nshort"), (3, "short\nshared LINE 1\r"), (None, "shared line 1"),
            (5, "äääääääää\nääääääääää"), (6, "äääääääää\nääääääääää"), (5, "another row"), (7, "twice in one\ntwice in one")]
    cut = lines.drop_shared_lines(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in cut) == Counter([
        (1, "Shared line 1 \nown", 2, 0), (2, "short\nshort", 3, 1), (3, "short", 2, 1), (None, "shared line 1", 1, 0),
        (5, "äääääääää\nääääääääää", 2, 0), (6, "äääääääää", 2, 1), (5, "another row", 1, 0), (7, "twice in one\ntwice in one", 2, 0)])
    assert lines.drop_shared_lines(odd).count() == len(ODD)
    assert lines.drop_shared_lines(none).count() == 0


def test_key_of_a_line():
    assert lines.line_hash(b"  A bcdefghij\t", 10) == lines.line_hash(b"a BCDEFGHIJ", 10)
    assert lines.line_hash("É bcdefghij".encode(), 10) != lines.line_hash("é bcdefghij".encode(), 10)
    assert lines.line_hash("日本語日本語日本語".encode(), 10) is None and lines.line_hash(b"123456789", 10) is None
    assert code_points("日本é".encode()) == 3


# --- benchmark

def brute_tiles(item, text, least):
    """Greedy tiling by definition: again and again the longest common run of unmarked tokens."""
    free_i, free_t, covered = [True] * len(item), [True] * len(text), 0
    while True:
        best = (0, 0, 0)
        for i, t in itertools.product(range(len(item)), range(len(text))):
            n = 0
            while i + n < len(item) and t + n < len(text) and free_i[i + n] and free_t[t + n] and item[i + n] == text[t + n]:
                n += 1
            best = max(best, (n, -i, -t))
        n, i, t = best[0], -best[1], -best[2]
        if n < least:
            return covered
        free_i[i:i + n], free_t[t:t + n], covered = [False] * n, [False] * n, covered + n


def test_tiles_brute_force():
    made = random.Random(11)
    for _ in range(150):
        item = [made.randint(1, 4) for _ in range(made.randint(2, 25))]
        text = [made.randint(1, 4) for _ in range(made.randint(0, 40))]
        for _ in range(2):  # passages of the item in another order
            at = made.randrange(len(item))
            text += item[at:at + made.randint(2, 9)]
        tiles = decontaminate.greedy_tiles(item, text, bytearray(len(text)), 2)
        assert all(item[i:i + n] == text[t:t + n] and n >= 2 for n, i, t in tiles)
        assert len({i + k for n, i, _ in tiles for k in range(n)}) == len({t + k for n, _, t in tiles for k in range(n)}) == sum(t[0] for t in tiles)
        # ties between equally long runs may be broken differently, so only nearly the same cover is asked for
        assert abs(sum(t[0] for t in tiles) - brute_tiles(item, text, 2)) <= 4


def test_leaks_on_the_sample(spark, docs, benchmark):
    items = {r.item_id: words_of(ascii_lower(r.text)) for r in benchmark.collect()}
    seeds = defaultdict(set)
    for i, w in items.items():
        for k in range(len(w) - 4):
            seeds[tuple(w[k:k + 5])].add((i, k))
    expected = {}
    for r in docs.collect():
        w, hit = words_of(ascii_lower(r.text or "")), defaultdict(set)
        for k in range(len(w) - 4):
            for i, at in seeds.get(tuple(w[k:k + 5]), ()):
                hit[i].update(range(at, at + 5))
        expected |= {(r.doc_id, i): len(s) for i, s in hit.items() if len(s) >= 0.6 * len(items[i])}
    found = {(r.doc_id, r.item_id): r.covered_words for r in QUERIES["op9_decontamination"](spark, BASE).collect()}
    assert found == expected and found


def test_moved_passages_and_blocks(spark, benchmark, odd, none):
    item = prose(77, 40).split()
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "too short"), (3, None), (4, prose(78, 30)), (4, prose(78, 30))], "item_id bigint, text string")
    moved = " ".join(item[20:] + ["between"] + item[:20])
    texts = [(1, moved), (2, " ".join(item[:18])), (3, None), (4, "too short"), (None, prose(78, 30).upper()), (5, " ".join(item[::-1]))]
    rows = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = decontaminate.find_leaks(rows, bench)
    assert Counter((r.doc_id, r.item_id, r.n_tiles) for r in found.collect()) == Counter([(1, 1, 2), (None, 4, 1), (None, 4, 1)])
    small = [decontaminate.item_blocks(bench, block_words=20), decontaminate.item_blocks(bench)]
    assert len(small[0]) > 1 and sum(len(b.items) for b in small[0]) == len(small[1][0].items) == 3
    assert decontaminate.drop_leaked(odd, bench).count() == len(ODD)
    assert decontaminate.drop_leaked(rows, bench).count() == 4
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.find_leaks(rows, bench.limit(0)).count() == 0


# --- mixing

def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = [s for s in order if s not in fixed]
        level = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in left))
        over = [s for s in left if weight[s] * level > 3 * sizes[s]]
        if not over:
            return {s: fixed.get(s, weight[s] * level) for s in order}
        fixed |= {s: 3 * sizes[s] for s in over}


def test_mix_meets_its_targets(docs, odd):
    for rows in (docs, odd):
        out = mixing.mix_sources(rows).collect()
        sizes, taken = Counter(), Counter()
        for r in out:
            sizes[r.source] += r.size
            taken[r.source] += r.taken
            assert 0 <= r.taken <= 3 * r.size
        targets = brute_targets({s: sizes[s] for s in {r.source for r in out}})
        for r in out:
            assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6 * max(1, r.target)
        assert all(abs(taken[s] - t) <= max(0.02 * t, 100) for s, t in targets.items())
        assert sorted(map(str, out)) == sorted(map(str, mixing.mix_sources(rows).collect()))
        assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in rows.select("doc_id").collect())


def brute_seats(votes, seats):
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = min(votes, key=lambda s: (-votes[s] / (2 * won[s] + 1), s))
        won[best] += 1
    return won


def test_quotas_are_highest_quotients(spark):
    made, rows = random.Random(2), []
    for shard in range(40):
        n = made.randint(1, 9)
        rows += [(shard, f"s{i}", made.choice([0, 3, 800, made.randint(1, 400_000)])) for i in range(n)]
    out = mixing.quotas(spark.createDataFrame(rows, "shard bigint, source string, votes bigint"), block_words=8).collect()
    found = {(r.shard, r.source): r.blocks for r in out}
    assert len(found) == len(rows)
    for shard in range(40):
        votes = {s: v for k, s, v in rows if k == shard}
        seats = int(sum(votes.values()) / 8000 + 0.5)
        expected = brute_seats({s: v for s, v in votes.items() if v}, seats) if any(votes.values()) else {}
        assert {s: found[shard, s] for s in votes} == {s: expected.get(s, 0) for s in votes}


def test_mix_without_tokens(spark, none):
    assert mixing.mix_sources(none).count() == 0
    out = mixing.mix_sources(spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id bigint, text string, source string")).collect()
    assert {(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in out} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


# --- language

def test_language_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    rows = QUERIES["op10_language_id"](spark, base).join(table(spark, base, "documents").select("doc_id", "lang"), "doc_id").filter("held_out")
    right, n = rows.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right >= 0.97 * n


def slow_bits(counts, order, raw):
    """Code length by definition, one byte and one context at a time."""
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    for code, n in counts.items():
        window = code.to_bytes(order + 1, "big")
        for k in range(order + 1):
            seen[k][window[order - k:order]][window[order]] += n
    padded, bits = bytes(order) + raw, 0.0
    for at in range(order, len(padded)):
        for k in range(order, -1, -1):
            follow = seen[k].get(padded[at - k:at])
            if follow is None:
                continue
            total = sum(follow.values()) + len(follow)
            if follow[padded[at]]:
                bits -= np.log2(follow[padded[at]] / total)
                break
            bits -= np.log2(len(follow) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact():
    texts = {"x": b"abracadabra abracadabra", "y": "größer als größe".encode()}
    counts = {}
    for name, raw in texts.items():
        codes, n = language.context_codes(raw)
        counts[name] = dict(zip(codes.tolist(), n.tolist()))
    trees = language.ContextTrees(counts)
    for raw in (b"abra", "große cadabra ~~ ab".encode(), b"\x00\xff", b"a"):
        assert trees.code_lengths(raw) == pytest.approx([slow_bits(counts[name], 3, raw) for name in ("x", "y")])


def test_languages_without_training_bytes(spark):
    rows = [(0, "", "en"), (1, "plain words", None), (2, None, "de")]
    docs = spark.createDataFrame([(i, text, lang, "s", 0) for i, text, lang in rows], DOCS)
    trees = language.learn(docs)
    assert trees.languages == [] and {r.lang_pred for r in language.predict(docs, trees).collect()} == {"und"}
    # one id in most rows, and a language with empty texts only, do not keep the others from being learned
    many = spark.range(6_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("the same words").alias("text"), F.lit("en").alias("lang"),
                                     F.lit("s").alias("source"), F.lit(0).cast("bigint").alias("n_chars"))
    trees = language.learn(many.unionByName(docs))
    assert trees.languages == ["en"] and {r.lang_pred for r in language.predict(docs, trees).collect()} == {"und", "en"}


def test_language_of_odd_rows(odd, none):
    trees = language.learn(odd)
    assert trees.languages == ["de", "en", "fr"]
    found = {r.doc_id: r for r in language.predict(odd, trees).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and found[8].lang_pred == "fr"
    assert all(0 <= r.score <= 1 for r in found.values())
    empty = language.learn(none)
    assert {r.lang_pred for r in language.predict(odd, empty).collect()} == {"und"} and language.predict(none, trees).count() == 0
    assert not language.has_letter("12 ½ ² —".encode()) and language.has_letter("日".encode())


# --- toxicity

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_fuzzy_trie_brute_force():
    made = random.Random(4)
    terms = sorted({"".join(made.choices("abc", k=made.randint(3, 11))) for _ in range(40)})
    trie = toxicity.FuzzyTrie(terms)
    for _ in range(600):
        word = "".join(made.choices("abcd", k=made.randint(1, 12)))
        if made.random() < 0.5:
            word = made.choice(terms)[:-1] + made.choice("abcd ")
        near = [(distance(word, t), i) for i, t in enumerate(terms) if distance(word, t) <= toxicity.errors_allowed(t)]
        best = min(near, default=None)
        assert trie.match(word) == (best and (best[1], best[0]))


def test_common_misspellings_are_found():
    """Each term with one letter left out, two neighbours swapped, or one letter masked, alone and next to other words."""
    terms = "trash pathetic idiot worthless disgusting stupid clown scum loser moron".split()
    lexicon = toxicity.Lexicon(terms, [(5.0, 4.0, 3.0)] * len(terms))
    forms = {t: (t, 0) for t in terms}
    for t in terms:
        forms |= {t[:i] + t[i + 1:]: (t, 1) for i in range(len(t))}
        forms |= {t[:i] + t[i + 1] + t[i] + t[i + 2:]: (t, 1) for i in range(len(t) - 1) if t[i] != t[i + 1]}
        forms |= {t[:i] + sign + t[i + 1:]: (t, 1) for i in range(1, len(t) - 1) for sign in "!*@$"}
    for form, (term, errors) in forms.items():
        text = f"you {form}, said they"
        assert lexicon._hits(form) == [(0, len(form), terms.index(term), errors)]
        assert lexicon.features(text)[0] == (4.0 if errors else 5.0)
    # signs between whole words: the words themselves count, at their own place
    assert lexicon._hits("stop!idiot") == [(5, 10, terms.index("idiot"), 0)]
    assert [h[2] for h in lexicon._hits("scum*loser@x")] == [terms.index("scum"), terms.index("loser")]
    assert lexicon.features("sum of cows, a lose end")[2] > 0 and lexicon.features("user@host and 3*4")[2] == 0
    assert toxicity.Lexicon(terms, lexicon.weights, frozenset(["crown"])).features("crown, crow")[2] == 0
    assert toxicity.words_of("St*pid a!b x") == ["a", "a!b", "b", "pid", "st", "st*pid", "x"]


def test_quotation_is_told_from_abuse():
    text = 'he said "you idiot" and left, idiot\n> idiot\nan "odd" idiot "case"'
    spans = [i for i in range(len(text)) if text.startswith("idiot", i)]
    assert [toxicity.is_quoted(text, i, i + 5) for i in spans] == [True, False, True, False]
    model = toxicity.ToxicityModel(toxicity.Lexicon(["idiot"], [(5.0, 3.0, 0.0)]), [1.0, 0.0, 0.0, 0.0], -4.0)
    assert model.score("you idiot") > model.score("you idjot") > model.score('he said "idiot"') > model.score("you")


def test_toxicity_held_out(spark):
    base = "/root/testdata/sf0.1"
    rows = QUERIES["op8_toxicity"](spark, base).join(table(spark, base, "labels"), "doc_id").filter("held_out AND toxic IS NOT NULL").collect()
    toxic, clean = [[r.score for r in rows if r.toxic == t] for t in (1, 0)]
    assert len(toxic) > 50 and np.mean([s >= 0.5 for s in toxic]) > 0.9 and np.mean([s >= 0.5 for s in clean]) < 0.01
    assert np.mean([np.mean([t > c for c in clean]) for t in toxic]) > 0.95


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 0), (4, 1), (5, 0), (None, 1), (6, None), (8, 0)], "doc_id bigint, toxic int")
    model = toxicity.learn(odd, labels)
    assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(odd, model).collect())
    nothing = toxicity.learn(none, labels)
    assert {r.score for r in toxicity.score_toxicity(odd, nothing).collect()} == {0.0} or nothing.score("x") < 1e-9
    assert toxicity.score_toxicity(none, model).count() == 0


# --- pipeline

def test_stages_keep_the_columns(spark, odd, none):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (odd, none):
            out = stage(spark, rows, BASE)
            assert set(out.columns) >= set(DOCS.replace(" bigint", "").replace(" string", "").split(", "))
            assert out.count() <= rows.count()
    assert corpus_pipeline.mixing(spark, none, BASE).count() == 0


def test_pipeline_against_the_stages_by_brute_force(spark, docs, benchmark):
    final = {r.doc_id: r.taken for r in corpus_pipeline.run(spark, BASE).collect()}
    kept = {r.doc_id: r.text for r in quality.keep_good(docs).collect()}
    holders = defaultdict(list)
    for i, text in kept.items():
        for line in text.split("\n"):
            holders[ascii_lower(line.strip(SPACE))].append(i)
    drop = {k: min(v) for k, v in holders.items() if len(k) >= 10 and len(set(v)) > 1}
    cut = {i: "\n".join(x for x in text.split("\n") if drop.get(ascii_lower(x.strip(SPACE)), i) == i) for i, text in kept.items()}
    groups = brute_groups(cut.items())
    items = [shingle_set(r.text.encode()) for r in benchmark.collect()]
    left = {i for i in cut if groups[i][2]}
    clean = {i for i in left if not any(len(np.intersect1d(shingle_set(cut[i].encode()), s)) >= 0.55 * len(s) for s in items)}
    assert set(final) == clean
    assert sum(final.values()) == pytest.approx(sum(len(words_of(cut[i])) for i in clean), rel=0.01)


def test_hash_of_the_kept_text(spark):
    found = {r.doc_id: r for r in QUERIES["op3_line_dedup"](spark, BASE).collect()}
    texts = {r.doc_id: r.text for r in lines.drop_shared_lines(table(spark, BASE, "documents")).collect()}
    assert all(found[i].kept_sha256 == hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items())
