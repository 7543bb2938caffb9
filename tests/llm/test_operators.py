"""The training-data operators against brute force, and on awkward rows."""

import collections
import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from penstock.llm import (
    common,
    covertree,
    kneser_ney,
    licences,
    mixing,
    packing,
    quality,
    queries,
    sharding,
    simhash,
    spans,
    toxicity,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row string, place int, n int"
LONG = " ".join(f"w{i % 977} x{i}." for i in range(6000))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls anywhere, empty, blank and very long texts, copies, repeated rows, clashing names."""
    body = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen.\nFourteen fifteen."
    rows = [
        (1, body, "en", "a", len(body), True, "r", 1, 1),
        (2, body, None, None, None, None, None, None, None),
        (2, body, None, None, None, None, None, None, None),
        (None, body, "en", "a", 3, False, "", 0, 0),
        (3, None, "en", "b", None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None),
        (4, "", "en", "b", 0, True, "x", 5, 5),
        (5, " \n\t ", "en", "b", 4, True, "x", 5, 5),
        (6, LONG, "en", "c", len(LONG), True, "x", 5, 5),
        (7, "hi there", "en", "c", 8, True, "x", 5, 5),
        (7, "another text under the same id", "en", "c", 8, True, "x", 5, 5),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return [(r["doc_id"], r["text"]) for r in common.documents(spark, sf_dir).collect()]


def plain_words(text):
    return (text or "").encode().lower().split()


# 1: mixing


def test_exponent_meets_its_target():
    sizes = [1000, 100, 10, 0]
    a = mixing.bisect(sizes, max_repeats=4)
    used = [w / n for w, n in zip(mixing.tempered(sizes, a), sizes) if n]
    assert max(used) / min(used) == pytest.approx(4)
    b = mixing.bisect(sizes, target_entropy=0.8)
    assert mixing.entropy(mixing.tempered(sizes, b)) == pytest.approx(0.8)
    assert sum(mixing.budgets([0.5, 0.3, 0.2], 101)) == 101
    assert mixing.bisect([5, 5], max_repeats=1) == 0.0 and mixing.bisect([], max_repeats=1) == 0.0


@pytest.mark.parametrize("budget", [None, 20_000])
def test_mix_fills_each_budget_with_a_prefix(spark, sf_dir, budget):
    table = common.documents(spark, sf_dir).withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "big").otherwise(F.col("source"))
    )
    taken = collections.defaultdict(list)
    got = mixing.mix(table, budget=budget, max_repeats=2.5, block_rows=10)
    for r in got.select("row.source", "row.doc_id", "epoch", "place", "n_tokens").collect():
        taken[r["source"], r["epoch"]].append((r["place"], r["n_tokens"], r["doc_id"]))
    every = mixing._marked(table)
    for s in mixing.plan(mixing.source_sizes(table), budget, 2.5):
        mine = every.where(F.col("source") == s.source)
        for epoch in range(s.epochs + 1):
            order = sorted(
                (r["p"], r["n"], r["doc_id"])
                for r in mine.select("row.doc_id", "n", mixing._placed(F.lit(epoch)).alias("p")).collect()
            )
            if epoch < s.epochs:
                wanted = order
            else:
                sums = itertools.accumulate(n for _, n, _ in order)
                wanted = [x for x, total in zip(order, sums) if total <= s.rest]
            assert sorted(taken[s.source, epoch]) == wanted


def test_mix_awkward(awkward, empty):
    got = mixing.mixed(awkward, max_repeats=2.0)
    assert got.columns == awkward.columns
    assert awkward.exceptAll(got).count() == 0
    assert mixing.mixed(empty, max_repeats=2.0).count() == 0


# 2: sentence spans


def cut_plainly(text):
    """Sentences as normalised words, written down anew from the rule in the module's docstring."""
    ends, raw = [], (text or "").encode()
    for i, c in enumerate(raw):
        if c == 10 and not (i and raw[i - 1] in b".!?"):
            ends.append(i + 1)
        elif c in b" \t\r\n" and i and raw[i - 1] in b".!?":
            ends.append(i + 1)
    out = []
    for a, b in zip([0, *ends], [*ends, len(raw)]):
        words = raw[a:b].lower().split()
        if len(words) <= 16:
            out.append(words)
            continue
        rank = [zlib.crc32(words[i + 1]) ^ (zlib.crc32(words[i], 1) >> 1) for i in range(len(words) - 1)]
        edges = [0]
        for i in range(5, len(words) - 4):
            if all(rank[i] < rank[j] for j in range(i - 4, i)) and all(
                rank[i] <= rank[j] for j in range(i + 1, min(i + 5, len(rank)))
            ):
                edges.append(i)
        edges.append(len(words))
        for x, y in zip(edges, edges[1:]):
            k = math.ceil((y - x) / 32)
            out += [words[x + (y - x) * j // k : x + (y - x) * (j + 1) // k] for j in range(k)]
    return [b" ".join(w) for w in out if w]


def test_spans_against_brute_force(spark, sf_dir, docs):
    first, texts = {}, {}
    for id_, text in sorted(docs):
        texts[id_] = said = cut_plainly(text)
        for i in range(max(len(said) - 1, min(len(said), 1))):
            first.setdefault(tuple(said[i : i + 2]), (id_, i))
    for r in queries.op2_substring_dedup(spark, sf_dir).collect():
        said = texts[r["doc_id"]]
        gone = {
            k
            for i in range(max(len(said) - 1, min(len(said), 1)))
            if first[tuple(said[i : i + 2])] != (r["doc_id"], i)
            for k in range(i, min(i + 2, len(said)))
        }
        assert r["n_sentences"] == len(said) and r["removed"] == sorted(gone)


def test_texts_of_one_sentence_and_rows_without_id(spark):
    two = "One two three. Four five six."
    rows = [
        (1, "just this"), (2, "Just  THIS"), (3, "just this. And more"), (4, "and more"),
        (None, two + " Seven."), (None, two + " Eight."), (None, two + " Eight."), (9, two),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in spans.cut(frame).select("row.doc_id", "row.text", "removed").collect()]
    assert {(d, tuple(r)) for d, _, r in got if d} == {(1, ()), (2, (0,)), (3, ()), (4, ()), (9, ())}
    assert len(got) == 8 and all(r == [0, 1] for d, _, r in got if d is None)
    # Without the row that has an id, the text whose hash is least comes first.
    got = spans.cut(frame.where("doc_id is null")).select("row.text", "removed").collect()
    assert len({r["text"] for r in got if not r["removed"]}) == 1 and any(r["removed"] == [0, 1] for r in got)


def test_spans_awkward(awkward, empty):
    assert b"".join(spans.pieces(LONG.encode())) == LONG.encode()
    rows = spans.cut(awkward).select("row.doc_id", "row.text", "removed", "cleaned").collect()
    assert len(rows) == 11
    for r in rows:
        if not r["removed"]:
            assert r["cleaned"] == (r["text"] or "")
    assert {r["doc_id"] for r in rows if r["removed"]} == {2, None}
    kept = spans.deduplicated(awkward)
    assert kept.columns == awkward.columns and kept.where("doc_id = 2").count() == 0
    assert spans.deduplicated(empty).count() == 0


def test_repeated_long_sentences_go(spark):
    rng = random.Random(12)

    def said(n):
        return [f"{rng.choice('abcdefgh')}{rng.randint(0, 3000)}" for _ in range(n)]

    rows, own = [], {}
    for i in range(0, 160, 4):
        # Alone, inside a sentence of other words, at the end of a text, and a text of its own.
        passage = " ".join(said(60))
        rows.append((i, f"{' '.join(said(9))}. {passage}. {' '.join(said(9))}."))
        rows.append((i + 1, f"{' '.join(said(9))}. {passage}. {' '.join(said(9))}."))
        rows.append((i + 2, f"{' '.join(said(9))}. {' '.join(said(20))} {passage} {' '.join(said(20))}. {' '.join(said(9))}."))
        rows.append((i + 3, f"{' '.join(said(30))} {passage}"))
        own |= {i: 78, i + 1: 18, i + 2: 58, i + 3: 30}
    alone = said(300)
    rows += [(1000, " ".join(alone)), (1001, " ".join(alone).upper()), (1002, "a " * 100), (1003, "a " * 100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["doc_id"]: len(r["cleaned"].split()) for r in spans.cut(frame).select("row.doc_id", "cleaned").collect()}
    assert left[1000] == 300 and left[1001] == left[1003] == 0
    assert all(left[i] == n for i, n in own.items() if i % 4 < 2)
    for at in (2, 3):
        over = [left[i] - n for i, n in own.items() if i % 4 == at]
        # Of a passage with other words around it the outer parts stay.
        assert min(over) >= 0 and sum(x < 60 for x in over) >= 39 and sum(over) < 30 * 40


def test_few_texts_at_once_are_in_a_worker(spark, monkeypatch):
    """Of batches of all sizes the executor and the worker hold several copies outside the heap."""
    known, removed, most = spans._run_batches, spans._removed, common.TEXTS

    def few(batches, span):
        def each():
            for batch in batches:
                assert batch.num_rows <= most
                yield batch

        return known(each(), span)

    cuts = spark.sparkContext.accumulator(0)

    def counted(raw, n, covered, span):
        assert raw is None or covered
        cuts.add(int(raw is not None))
        return removed(raw, n, covered, span)

    monkeypatch.setattr(spans, "_run_batches", few)
    monkeypatch.setattr(spans, "_removed", counted)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    n = 3 * most
    rows = [(i, f"w{i} a. x{i} b. y{i} c. Said before. Said again. z{i} d.") for i in range(n)]
    rows = [(i, text if i % 10 == 0 else text.replace("Said", f"s{i}")) for i, text in rows] + [(n, "Said before. Said again.")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = dict(map(tuple, spans.deduplicated(frame).collect()))
    assert got == {
        i: text.replace("Said before. Said again. ", "") if i and i % 10 == 0 else text for i, text in rows if i < n
    }
    assert cuts.value == n // 10 and spark.conf.get(key) == before


def test_parts_are_the_sentence():
    rng = random.Random(13)
    for n in (1, 16, 17, 40, 500):
        for words in (["a"] * n, [rng.choice(["a", "B", "c1", "é"]) for _ in range(n)]):
            text = "  ".join(words).encode() + b". "
            cut = spans.parts(text)
            assert b"".join(cut) == text and all(len(x.split()) <= 32 for x in cut)
            assert (len(cut) == 1) if n <= 16 else (len(cut) > 1 or n <= 32)


# 3: packing


def test_packing_round_trip(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for d, t in docs}
    rows = queries.op3_packing(spark, sf_dir).collect()
    parts, places = collections.defaultdict(dict), collections.defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(own) == r["length"] and zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
        parts[r["doc_id"]][r["piece"]] = (r["start"], r["length"])
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, own in ids.items():
        cuts = [parts[d][i] for i in range(len(parts[d]))]
        assert [s for s, _ in cuts] == [0, *itertools.accumulate(n for _, n in cuts)][:-1]
        assert sum(n for _, n in cuts) == len(own) and all(n == 1024 for _, n in cuts[1:])
        assert len(cuts) == -(-len(own) // 1024)
    for placed in places.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= 1024
    assert len(places) <= 1.02 * sum(map(len, ids.values())) / 1024 + 1


def test_plans_use_each_piece_once():
    rng = random.Random(1)
    for _ in range(300):
        counts = {rng.randint(1, 64): rng.randint(1, 40) for _ in range(rng.randint(0, 30))}
        rows, used, filled = packing.plan(counts, 64), collections.Counter(), collections.Counter()
        for n, low, high, first, _ in rows:
            used[n] += high - low + 1
            for i in range(high - low + 1):
                filled[first + i] += n
        assert used == collections.Counter(counts) and all(v <= 64 for v in filled.values())
        usual = sum(times for _, times in packing.best_fit_groups(counts, 64))
        assert len(filled) <= usual


def test_odd_blanks_and_awkward_rows(awkward, empty):
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    files = (file, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)
    encode, tokenizer = packing.encoder(*files), Tokenizer.from_file(file)
    assert np.frombuffer(encode("a <|endoftext|> b"), "<u4").tolist()[2] == 50256
    rng = random.Random(2)
    for _ in range(500):
        chosen = ["a", "Bé", " ", " ", "\n", "\t", "1", "'s", ".", "\u00a0", "\x1c", "<|endoftext|>"]
        text = "".join(rng.choice(chosen) for _ in range(12))
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    def parts(df):
        return packing.pieces(df, *files)

    placed = packing.packed(parts(awkward))
    assert placed.where("start = 0").count() == 11
    whole = packing.sequences(placed).collect()
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in whole)
    assert packing.packed(parts(empty)).count() == 0


def test_packing_holds_few_texts_and_no_words(spark, monkeypatch):
    """What a worker holds follows neither the number of texts nor that of different words."""
    known, most = packing._piece_batches, common.TEXTS

    def few(batches, **options):
        def each():
            for batch in batches:
                assert batch.num_rows <= most
                yield batch

        return known(each(), **options)

    monkeypatch.setattr(packing, "_piece_batches", few)
    files = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)
    frame = spark.createDataFrame([(i, f"w{i} x{i}") for i in range(3 * most)], "doc_id long, text string").coalesce(1)
    rows = packing.packed(packing.pieces(frame, *files, with_ids=False)).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(3 * most))

    encode = packing.encoder(*files)
    encode("some words first")
    tracemalloc.start()
    for i in range(300):
        encode(" ".join(f"w{i}x{j}" for j in range(200)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 1_000_000


# 4: licences


def test_licences(spark, awkward, empty):
    known = licences.known_licences(spark)
    mit = "  Copyright (c) 2020 Someone\n\n" + licences.KNOWN["MIT"].upper().replace("SUBLICENSE", "sub-licence")
    frame = spark.createDataFrame([(1, mit), (2, licences.KNOWN["MIT"] + " more"), (3, "licensed under CC-BY-NC 4.0")], "doc_id long, text string")
    got = {r["doc_id"]: r["licence"] for r in licences.scan(frame, known).select("row.doc_id", "licence").collect()}
    assert got == {1: "MIT", 2: None, 3: "CC-BY-NC-4.0 notice"}
    assert licences.scan(awkward, known).where("licence is null").count() == 11
    assert licences.scan(empty, known).count() == 0


# 5: SimHash


def test_masks_cover_the_radius():
    rng = random.Random(3)
    masks = simhash.covering_masks(3)
    assert len(masks) == 15
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        assert any(not diff & m for m in masks)


def connected(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= radius:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(values))]


def test_long_runs_are_split_exactly(monkeypatch):
    monkeypatch.setattr(simhash, "DIRECT", 16)
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(12)]
    values = [rng.choice(base) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(300)]
    a, b = simhash._forest(np.array(values, dtype=np.uint64), 3)
    assert all((values[i] ^ values[j]).bit_count() <= 3 for i, j in zip(a, b))
    root = list(range(300))
    for _ in range(300):
        for i, j in zip(a, b):
            root[i] = root[j] = min(root[i], root[j])
    assert root == connected(values, 3)


def brute_print(text):
    words = plain_words(text)
    said = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in said]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_classes_against_brute_force(spark, sf_dir, docs):
    docs = sorted(docs)
    prints = [brute_print(t) for _, t in docs]
    roots = connected(prints, 3)
    wanted = {d: (f"{p:016x}", docs[r][0]) for (d, _), p, r in zip(docs, prints, roots)}
    rows = queries.op5_simhash(spark, sf_dir).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == wanted


def test_links_over_many_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(5)
        values = sorted({7 ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(200)})
        signed = [v - (1 << 64) if v >> 63 else v for v in values]
        frame = spark.createDataFrame([(i, [v]) for i, v in enumerate(signed)], "node long, prints array<long>")
        rooted = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame)).collect()}
        assert [rooted.get(i, i) for i in range(len(values))] == connected(values, 3)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_trees_and_links_across_labels(spark, monkeypatch):
    rng = random.Random(9)
    values = [7 ^ sum(1 << b for b in rng.sample(range(64), 2)) for _ in range(60)]
    a, b = simhash._tree(np.array(values, dtype=np.uint64), 3)
    assert len(a) == len(values) - len(set(connected(values, 3)))
    assert all((values[i] ^ values[j]).bit_count() <= 3 for i, j in zip(a, b))

    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    rows = [(i, [v], i % 2) for i, v in enumerate(signed)]
    frame = spark.createDataFrame(rows, "node long, prints array<long>, label long")
    wanted = {
        (j, i)
        for i, j in itertools.combinations(range(60), 2)
        if i % 2 != j % 2 and (values[i] ^ values[j]).bit_count() <= 3
    }
    found = {tuple(r) for r in simhash.links(frame).collect()}
    assert found <= wanted and found
    monkeypatch.setattr(simhash, "SHORT", 60)
    a, b = simhash._across(np.array(values, dtype=np.uint64), np.arange(60) % 2, 3)
    assert {(max(p), min(p)) for p in zip(a.tolist(), b.tolist())} == wanted


def test_simhash_awkward(awkward, empty):
    rows = simhash.classes(awkward).collect()
    assert len(rows) == 11
    assert {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16} == {3}
    kept = simhash.deduplicated(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 6, 7, 7]
    assert simhash.classes(empty).count() == 0 and simhash.deduplicated(empty).count() == 0


def test_near_copies_go(spark):
    rng = random.Random(6)
    rows = []
    for i in range(40):
        words = [f"{rng.choice('abcdefgh')}{rng.randint(0, 3000)}" for _ in range(300)]
        rows.append((2 * i, " ".join(words)))
        for at in rng.sample(range(300), 5):
            words[at] = "changed"
        rows.append((2 * i + 1, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["doc_id"] for r in simhash.deduplicated(frame).collect()}
    assert {2 * i for i in range(40)} <= left and len(left) <= 42


def shingle_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copies_of_each_length_against_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for length in (5, 10, 15, 20, 50, 100, 300):
        for _ in range(30):
            words = [f"{rng.choice('abcdefgh')}{rng.randint(0, 3000)}" for _ in range(length)]
            rows.append(words)
            for changes in (1, 1, 2, 3, max(1, length // 60)):
                other = list(words)
                for _ in range(changes):
                    other[rng.choice((0, -1, rng.randrange(length)))] = f"n{rng.randint(0, 9999)}"
                rows.append(other)
    # One text with many copies that are no near copies of each other, and a passage of most texts.
    base = [f"b{i}" for i in range(120)]
    for i in range(60):
        rows.append([*base[:-12], *(f"c{i}x{j}" for j in range(12))] if i else base)
    rows = [[*w, *(f"usual{j}" for j in range(9))] if i % 3 == 0 else w for i, w in enumerate(rows)]
    rng.shuffle(rows)
    texts = [" ".join(w) for w in rows]
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        shared = len(sets[i] & sets[j])
        if 5 * shared >= 4 * (len(sets[i]) + len(sets[j]) - shared):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    wanted = {i for i in range(len(texts)) if find(i) == i}
    lost = {len(w) for i, w in enumerate(rows) if i not in wanted}
    assert min(lost) < 20 and max(lost) >= 300
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash.deduplicated(frame).collect()} == wanted


def test_near_copies_come_from_fingerprints(spark, monkeypatch):
    rng = random.Random(12)
    rows = []
    for _ in range(20):
        words = [f"w{rng.randint(0, 3000)}" for _ in range(200)]
        rows += [words, list(reversed(words)), [*words, "more"], [*words, "more"], ["other", *words[1:]]]
    rows += [["a", "b", "c"] * 30, ["a", "b", "c"] * 40, ["a", "b", "c"] * 30 + rows[0][:40]]
    texts = [" ".join(w) for w in rows]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scratch = common.Scratch(spark, "near")
    found = simhash.alike(frame.withColumnRenamed("doc_id", "node"), 3, scratch).collect()
    prints = [simhash.majority(simhash.shingle_hashes(t.encode(), 3)) for t in texts]
    assert all(u > v and (prints[u] ^ prints[v]).bit_count() <= 3 for u, v in found)
    root = {r["doc_id"]: r["component_id"] for r in simhash.classes(frame).collect()}
    reached = list(range(len(texts)))
    for u, v in sorted(found, key=lambda r: (r.v, r.u)):
        a, b = reached[u], reached[v]
        reached = [min(a, b) if x in (a, b) else x for x in reached]
    assert dict(enumerate(reached)) == root and len(set(reached)) < len(texts)
    # Links of fingerprints are candidates: texts that only share frequent shingles stay apart.
    calls = []
    monkeypatch.setattr(simhash, "alike", lambda *a, _real=simhash.alike: calls.append(a) or _real(*a))
    left = {r["doc_id"] for r in simhash.deduplicated(frame).collect()}
    assert len(calls) == 1 and len(texts) - 1 in left and len(texts) - 2 not in left


# 6: sharding


def test_running_starts(spark):
    rng = random.Random(8)
    rows = [(k, i, rng.randint(0, 9)) for k in (1, 2) for i in rng.sample(range(100), 40)]
    frame = spark.createDataFrame(rows, "k int, at long, n long")
    found = {(r["k"], r["at"]): r["before"] for r in common.starts(frame, ["k"], "at", span=8).collect()}
    assert found == {(k, i): sum(n for q, j, n in rows if q == k and j < i) for k, i, _ in rows}
    assert common.starts(frame.where("k = 1"), [], "at", span=8).count() == 40



def test_shards(spark, sf_dir, docs):
    rows = queries.op6_sharding(spark, sf_dir).collect()
    text = dict(docs)
    assert sorted(r["doc_id"] for r in rows) == sorted(text)
    by = collections.defaultdict(list)
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(40))
    sizes = [len(by[s]) for s in range(40)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_in_many_buckets(awkward, empty, spark):
    many = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"))
    rows = sharding.sharded(many, 7, bucket_bytes=500).select("row.doc_id", "shard", "slot").collect()
    assert len({r["doc_id"] for r in rows}) == 1000 and len({(r["shard"], r["slot"]) for r in rows}) == 1000
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert abs(np.corrcoef(order, range(1000))[0, 1]) < 0.15
    assert sharding.sharded(awkward, 40).select("shard", "slot").distinct().count() == 11
    assert sharding.sharded(empty, 40).count() == 0


# 7: quality


def brute_numbers(text):
    words = (text or "").encode().split()
    said = [w.decode() for w in words]
    at = collections.defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i : i + 5])].append(i)
    hit = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words),
        sum(map(len, said)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(hit),
    )


def test_quality_against_brute_force(spark, sf_dir, docs):
    rows = {r["doc_id"]: r for r in queries.op7_quality(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for d, text in docs:
        r = rows[d]
        want = brute_numbers(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"])
        if labels.get(d) == 1 and not r["base_failed"]:
            assert r["kept"]
    assert not any(rows[d]["kept"] for d, q in labels.items() if q == 0)


def test_rule_rates_are_recovered():
    rng, patterns = random.Random(7), collections.Counter()
    for _ in range(4000):
        good = rng.random() < 0.8
        patterns[tuple(None if rng.random() < (0.98 if good else 0.6) else 0 for _ in range(6))] += 1
    model = quality.estimate(sorted(patterns.items(), key=str), list("abcdef"))
    assert model.prior == pytest.approx(0.8, abs=0.06)
    assert all(bad[0] == pytest.approx(0.4, abs=0.08) for bad, _ in model.rates.values())


def test_quality_awkward(awkward, empty):
    assert quality.filtered(awkward).columns == awkward.columns
    assert quality.judge(awkward, awkward.columns).count() == 11
    assert quality.filtered(empty).count() == 0


# 8: language model


def test_language_model_against_brute_force(spark, sf_dir, docs):
    train = [t for d, t in docs if zlib.crc32(str(d).encode()) % 10]

    def said(text):
        return [*plain_words(text), b"\n"]

    one = collections.Counter(w for t in train for w in said(t))
    two = collections.Counter(p for t in train for p in zip([b""] + said(t)[:-1], said(t)))
    n, v = sum(one.values()), len(one)
    ends = collections.Counter(w for _, w in two)
    begins, sizes = collections.defaultdict(lambda: [0, 0, 0]), collections.Counter()
    for (a, _), k in two.items():
        begins[a][min(k, 3) - 1] += 1
        sizes[a] += k

    def of(counter):
        kinds = collections.Counter(counter.values())
        return kneser_ney.discounts(*[kinds[k] for k in (1, 2, 3, 4)])

    d, e = of(two), of(ends)

    def less(k, by):
        return k - (by[min(k, 3) - 1] if k else 0)

    spare = sum(e[min(k, 3) - 1] for k in ends.values()) / len(two)

    def p(a, w):
        lower = less(ends[w], e) / len(two) + spare / (v + 1)
        if not sizes[a]:
            return lower
        return (less(two[a, w], d) + sum(x * y for x, y in zip(d, begins[a])) * lower) / sizes[a]

    for a in (b"", b"the", b"unseen-word"):
        assert sum(p(a, w) for w in one) + p(a, b"never seen") == pytest.approx(1)
    rows = {r["doc_id"]: r for r in queries.op8_language_model(spark, sf_dir).collect()}
    for id_, text in docs:
        r, words = rows[id_], said(text)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(one[w] > 0 for w in words), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((one[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words))
        assert r["score"] == pytest.approx(sum(math.log10(p(a, w)) for a, w in zip([b""] + words[:-1], words)))


def test_language_model_parts_and_hot_words(awkward, empty, monkeypatch):
    usual = {r["doc_id"]: r["score"] for r in kneser_ney.score(awkward, kneser_ney.fit(awkward)).where("doc_id != 7").collect()}
    monkeypatch.setattr(kneser_ney, "PART_WORDS", 500)
    model = kneser_ney.fit(awkward)
    assert len(model.vocabulary.firsts) > 1
    split = {r["doc_id"]: r["score"] for r in kneser_ney.score(awkward, model).where("doc_id != 7").collect()}
    assert split == pytest.approx(usual)
    nothing = kneser_ney.fit(empty)
    assert kneser_ney.score(awkward, nothing).where("score <= 0").count() == 11
    assert kneser_ney.score(empty, model).count() == 0


def test_language_model_counts_around_what_a_byte_holds(spark):
    texts = [f"x{k} y{k} " * n for k, n in enumerate((1, 2, 254, 255, 256, 257, 300, 255, 255, 700))]
    model = kneser_ney.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for text in texts:
        words = plain_words(text)
        pairs = list(zip([b"", *words], [*words, b"\n"]))
        counted = collections.Counter(pairs)
        found = kneser_ney.tokens(text.encode(), kneser_ney._Hashes())
        first, second, n_first, _ = kneser_ney._numbered(found, np.array([0]), model.vocabulary)
        assert model.pair_counts(first, second, n_first).tolist() == [counted[pair] for pair in pairs]


# 9: toxicity


def test_marginals_against_brute_force():
    rng = np.random.default_rng(8)
    moves = np.array([[0.4, -1.0], [0.2, 0.7]])
    lengths = np.array([1, 0, 5, 9])
    odds = rng.normal(size=15)
    found, changes = toxicity.marginals(odds, lengths, moves, expected=True)
    want, counted, at = [], np.zeros((2, 2)), 0
    for n in lengths:
        weights = {}
        for path in itertools.product((0, 1), repeat=int(n)):
            steps = list(zip((0, *path[:-1]), path))
            weights[path] = math.exp(sum(moves[a, b] + b * odds[at + i] for i, (a, b) in enumerate(steps)))
        whole = sum(weights.values())
        want += [sum(w for p, w in weights.items() if p[i]) / whole for i in range(n)]
        for path, w in weights.items():
            for a, b in zip((0, *path[:-1]), path):
                counted[a, b] += w / whole
        at += n
    assert found == pytest.approx(np.array(want)) and changes == pytest.approx(counted)


def test_blocks_do_not_change_marginals(monkeypatch):
    rng = np.random.default_rng(9)
    odds, lengths, moves = rng.normal(size=700), np.array([600, 3, 97]), rng.normal(size=(2, 2))
    whole = toxicity.marginals(odds, lengths, moves)
    monkeypatch.setattr(toxicity, "BLOCK", 7)
    assert toxicity.marginals(odds, lengths, moves) == pytest.approx(whole)


def test_toxic_documents_are_found(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.op9_toxicity(spark, sf).where("held_out").join(labels, "doc_id").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) >= 0.6 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def test_toxic_spans(spark, awkward, empty):
    rows = [(i, ("you utter moron, go " if i % 4 == 0 else "you dear friend, go ") + f"to{i} bed{i % 7}") for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = table.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(table, labels)
    got = {r["doc_id"]: r for r in toxicity.score(table, model).collect()}
    assert all((got[i]["score"] >= 0.5) == (i % 4 == 0) for i in range(200))
    span = got[0]["spans"][0]
    assert "moron" in rows[0][1][span["start"] : span["end"]]
    assert toxicity.score(awkward, model).where("score between 0 and 1").count() == 11
    assert toxicity.score(empty, toxicity.fit(empty, labels)).count() == 0


# 10: top k


def test_cover_tree_against_brute_force(spark, monkeypatch):
    rng = random.Random(10)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(900)]
    rows += [(900 + i, rows[50][1]) for i in range(300)]
    rows += [(None, [1.0] * 6), (2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 6), (2150, []), (2200, [0.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = covertree.search(covertree.vectors(frame), F.col("vec_id") % 50 == 0, 5, block_rows=60, group_rows=4)
    found = collections.defaultdict(list)
    for r in got.collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    vecs = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    for q in (i for i in vecs if i % 50 == 0):
        scored = sorted((-sum(a * b for a, b in zip(vecs[q], v)), i) for i, v in vecs.items() if i != q)[:5]
        assert sorted(found[q]) == [(k, i, -s) for k, (s, i) in enumerate(scored, 1)]
    assert covertree.search(covertree.vectors(frame.limit(0)), F.lit(True)).count() == 0


# the pipeline


def test_pipeline(spark, sf_dir, docs):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows and {r["doc_id"] for r in rows} <= {d for d, _ in docs}
    table = common.documents(spark, sf_dir)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = common.stored(stage(spark, table, sf_dir), name)
        assert after.columns == table.columns
        table = after
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in table.collect()}


def test_pipeline_stages_awkward(spark, awkward, empty, sf_dir):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, awkward, sf_dir).collect()
        assert stage(spark, empty, sf_dir).count() == 0
