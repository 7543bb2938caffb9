"""Filter audit, suffix-sorted removal of repeats and periodic runs against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from penstock.llm import audit, periods, queries, suffixes
from tests.llm.test_operators import LONG, awkward, empty  # noqa: F401

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# Filter audit


def audit_by_hand(rows, labels):
    """Every order applied to the documents one by one. rows: (doc_id, text, lang)."""
    smallest = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            smallest[text or ""] = min(doc_id, smallest.get(text or "", doc_id))
    docs = []
    for doc_id, text, lang in rows:
        t = text or ""
        words = WORDS.findall(t)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": doc_id is not None and smallest[t] < doc_id,
        }
        docs.append((lang or "", {k for k, v in fails.items() if v}, *labels.get(doc_id, (0, 0))))
    found, shapley = {}, collections.Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            left = [d for d in docs if d[0] == part]
            for step, name in enumerate(order, 1):
                hit = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                every = [d for d in docs if d[0] == part and name in d[1]]
                shapley[part, name] += len(hit)
                found[part, order, step] = [
                    len(left), len(hit), len(every) - len(hit), sum(len(d[1]) == 1 for d in every),
                    sum(d[2] for d in hit), sum(d[3] for d in hit),
                ]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def audit_rows(found):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in found.collect()}


def test_shares_are_the_average_over_all_orders():
    pick = random.Random(3)
    value = [0] + [pick.randrange(100) for _ in range(31)]
    for i, row in enumerate(audit.shares()):
        gains = []
        for order in itertools.permutations(range(5)):
            before = sum(2**j for j in order[: order.index(i)])
            gains.append(value[before + 2**i] - value[before])
        assert sum(c * v for c, v in zip(row, value)) == Fraction(sum(gains), 120)


def test_audit(spark):
    pick = random.Random(11)
    vocabulary = [f"w{i}" for i in range(300)] + ["BIG", "#", "100%"]
    texts = [" ".join(pick.choices(vocabulary, k=pick.choice([5, 99, 100, 140]))) for _ in range(30)]
    rows = [(pick.choice([*range(40), None]), pick.choice(texts), pick.choice(["a", "b", None])) for _ in range(120)]
    rows += [(3, None, "a"), (4, "", "a"), (5, "", ""), (5, "", "")]
    labels = {i: (pick.randrange(2), pick.randrange(2)) for i in range(0, 40, 2)}
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = [(i, q, t) for i, (q, t) in labels.items()] + [(None, 1, 1), (0, 0, 0)]
    marked = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    assert audit_rows(audit.audit(docs, marked)) == audit_by_hand(rows, labels)


def test_audit_awkward(spark, awkward, empty):  # noqa: F811
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = awkward.withColumns({c: F.lit("x") for c in ("part", "fails", "digest", "n", "spread", "good")})
    rows = [(r.doc_id, r.text, r.lang) for r in awkward.collect()]
    assert audit_rows(audit.audit(docs, labels)) == audit_by_hand(rows, {})
    assert audit.audit(empty, labels).count() == 0


# Suffix sorting


def test_deep_shallow_sorting():
    pick = random.Random(5)
    for _ in range(60):
        letters = pick.choice([b"ab", b"abc", bytes(range(256)), b"a\0"])
        stems = [bytes(pick.choices(letters, k=pick.randrange(100))) for _ in range(3)]
        strings = [
            pick.choice(stems) + pick.choice(stems)[: pick.randrange(80)] + bytes(pick.choices(letters, k=pick.randrange(5)))
            for _ in range(pick.randrange(1, 60))
        ]
        groups = np.sort(np.array([pick.randrange(4) for _ in strings]))
        order, lcp = suffixes.deep_shallow(strings, groups)
        expected = sorted(range(len(strings)), key=lambda i: (groups[i], strings[i]))
        assert [(groups[i], strings[i]) for i in order] == [(groups[i], strings[i]) for i in expected]
        for k, i in enumerate(order):
            if not k or groups[i] != groups[order[k - 1]]:
                assert lcp[k] == -1
                continue
            a, b = strings[order[k - 1]], strings[i]
            same = next((j for j, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[k] == same


def removed_by_hand(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    found = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        found.append((len(d), spans, bytes(np.frombuffer(d, np.uint8)[~gone])))
    return found


@pytest.mark.parametrize("limit", [1, 1024])
def test_suffix_removal(spark, limit):
    """Passages of lengths around the bound at many places, periodic texts, copies; with limit 1
    every gram with two stretches takes the counted way."""
    pick = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzäß "

    def noise(n):
        return "".join(pick.choices(letters, k=n))

    passages = [noise(n) for n in (190, 199, 200, 201, 230, 420)]
    texts = [noise(pick.randrange(300)) + pick.choice(passages) + noise(pick.randrange(300)) for _ in range(40)]
    common_one = noise(260)
    texts += [noise(pick.randrange(60)) + common_one + noise(pick.randrange(60)) for _ in range(60)]
    texts += ["ab" * 300, "x" * 500, noise(30) * 20, texts[0], texts[0], passages[0], passages[2], "", None, "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.row.doc_id: r for r in suffixes.deduplicated(docs, limit=limit).collect()}
    for i, (size, spans, kept) in enumerate(removed_by_hand(texts, 200)):
        assert (found[i].n_bytes, len(found[i].spans or []), bytes(found[i].kept)) == (size, spans, kept), i


def test_suffix_awkward(spark, awkward, empty):  # noqa: F811
    docs = awkward.withColumns({c: F.lit(1) for c in ("d1", "d2", "found", "spans", "gram")})
    extra = docs.where("doc_id = 6")
    rows = suffixes.deduplicated(docs.union(extra)).collect()
    assert len(rows) == 12
    for r in rows:
        text = (r.row.text or "").encode()
        assert r.n_bytes == len(text)
        if r.row.doc_id == 6:  # the very long text occurs twice
            assert bytes(r.kept) == b"" and [tuple(s) for s in r.spans] == [(0, len(text))]
        elif len(text) < 200:
            assert bytes(r.kept) == text and not r.spans
    assert suffixes.deduplicated(empty).count() == 0


def test_suffixes_of_long_texts_meet_over_parts(monkeypatch):
    """Parts of one text share their windows at the border, so none is lost or counted twice."""
    data = bytes(random.Random(1).choices(b"abcdefgh", k=3000))
    whole = suffixes.anchors(data)
    seen = []
    for base in range(0, len(data) - 200 + 1, 700):
        _, first, last, _ = suffixes.anchors(data[base : base + 899])
        seen += [w + base for f, t in zip(first.tolist(), last.tolist()) for w in range(f, t + 1)]
    assert seen == list(range(len(data) - 199))
    assert whole[1][0] == 0 and whole[2][-1] == len(data) - 200


# Periodic runs


def runs_by_hand(x):
    found, seen = [], set()
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            start = i
            while i + q < len(x) and x[i] == x[i + q]:
                i += 1
            if i + q - start >= 4 * q and (start, i + q) not in seen:
                seen.add((start, i + q))
                found.append((start, i + q, q))
            i = max(i, start + 1)
    return found


def test_runs():
    pick = random.Random(4)
    for _ in range(300):
        docs = []
        for _ in range(pick.randint(1, 5)):
            n, k, x = pick.choice([0, 1, 5, 60, 400]), pick.choice([1, 2, 3, 50]), []
            while len(x) < n:
                x += [pick.randrange(k) for _ in range(pick.randint(1, 30))]
                block = pick.choice([x[pick.randrange(len(x)) :][:50], [pick.randrange(k) for _ in range(pick.randint(1, 70))]])
                x += (block * pick.randint(1, 7))[pick.randint(0, 3) :]
            docs.append(x[:n])
        parts = [np.array(d + [-1 - i], np.int64) for i, d in enumerate(docs)]
        expected, begin = set(), 0
        for d in docs:
            expected |= {(s + begin, e + begin, q) for s, e, q in runs_by_hand(d)}
            begin += len(d) + 1
        assert set(periods.runs(np.concatenate(parts), np.array([len(d) for d in docs]))) == expected


def periodic_by_hand(doc_id, text):
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = sorted((s, q, e - s) for s, e, q in runs_by_hand(words) if e - s >= 6)
    dropped = {i for s, q, size in runs for i in range(s + q, s + size)}
    top = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    best = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
    listed = "".join(f"{s},{size},{q}\n" for s, q, size in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (len(runs), *best, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def test_periodic_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    found = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    short = [r for r in docs if len(r.text or "") < 15_000]
    assert len(short) > len(docs) * 0.9
    for r in short:
        assert found[r.doc_id] == periodic_by_hand(r.doc_id, r.text), r.doc_id
    assert sum(row[0] > 0 for row in found.values()) > 5


def test_periodic_awkward(spark, awkward, empty):  # noqa: F811
    docs = awkward.withColumns({c: F.lit("x") for c in ("start", "length", "crc", "period")})
    for plant in (False, True):
        rows = periods.found_runs(docs, plant).collect()
        assert len(rows) == 11
        if plant:
            expected = sorted(str((r.doc_id, *periodic_by_hand(r.doc_id, r.text))) for r in awkward.where("doc_id <> 6 or doc_id is null").collect())
            assert sorted(str(tuple(r)) for r in rows if r.doc_id != 6) == expected
    assert periods.found_runs(empty).count() == 0


def test_a_text_longer_than_a_block(spark, monkeypatch):
    """Alone in its block, whole, and with a period of a third of a block."""
    block = [f"w{i}" for i in range(30_000)]
    text = " ".join(["before"] + block * 5 + ["after"])
    docs = spark.createDataFrame([(1, text), (2, "a b " * 3), (3, "c " * 7)], "doc_id long, text string")
    found = {r.doc_id: tuple(r)[1:5] for r in periods.found_runs(docs).collect()}
    assert found == {1: (1, 1, 150_000, 30_000), 2: (0, None, None, None), 3: (1, 0, 7, 1)}
    assert LONG
