"""Substring dedup and suffix-array dedup against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from pairforge.llm import spans, substring_dedup, suffix_dedup
from pairforge.llm.bwt import repeated_starts
from pairforge.llm.spans import window_runs


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    shared = [" ".join(rng.choices(words, k=k)) for k in (12, 30, 55)]
    docs = []
    for i in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randint(0, 30)))]
        parts += rng.sample(shared, rng.randint(0, 3))
        parts += [" ".join(rng.choices(words, k=rng.randint(0, 20)))]
        docs.append((i, " ".join(parts)))
    docs += [(n, docs[3][1]), (n + 1, docs[5][1] + " tail"), (n + 2, "yes " * 70), (n + 3, "yes " * 90), (n + 4, "")]
    return docs


def brute_words(docs, k):
    first = {}
    for i, t in docs:
        w = (t or "").encode().split()
        for p in range(len(w) - k + 1):
            key = tuple(w[p : p + k])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in docs:
        w = (t or "").encode().split()
        gone = set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p : p + k])] < i:
                gone.update(range(p, p + k))
        out[i] = (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode())
    return out


@pytest.mark.parametrize("k", [6, 20])
def test_substring_dedup_equals_brute_force(spark, k):
    docs = corpus(k)
    got = substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), window=k).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == brute_words(docs, k)


def test_long_documents_are_worked_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spans, "LONG_BYTES", 100)
    monkeypatch.setattr(spans, "CHUNK", 100)
    docs = corpus(1, 30)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = substring_dedup.remove_repeats(df, window=6).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == brute_words(docs, 6)
    for most in (256, 1):
        got = suffix_dedup.remove_repeats(df, least=25, most_runs=most, short=14).collect()
        assert digests(got) == brute_bytes(docs, 25, 14)


def test_parts_of_long_documents_end_after_separators_only(monkeypatch):
    import numpy as np

    data = np.frombuffer(b"one two\x01three fo\x1cur\x00five\tsix \x0bse\x08ven" * 3, np.uint8)
    want = spans.word_units(data, np.array([0, len(data)]))
    for most in range(1, 40):
        monkeypatch.setattr(spans, "LONG_BYTES", most)
        got = spans.word_units(data, np.array([0, len(data)]))
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist(), most


def test_substring_dedup_odd_rows(spark, odd, none):
    got = substring_dedup.remove_repeats(odd, window=50).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_words, r.n_removed))
    assert by[1] == [(120, 0), (120, 0)] and by[2] == [(120, 120)] and by[3] == [(0, 0)]
    assert sorted(by[None]) == [(0, 0), (120, 0)]  # a null id takes nothing
    assert got[0].label == "clash"
    assert substring_dedup.remove_repeats(none).count() == 0


def digests(rows):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest(), r.n_repeated) for r in rows), key=str)


def repeated_bytes(rows, k):
    count = Counter(t[p : p + k] for _, t in rows for p in range(len(t) - k + 1))
    for i, t in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - k + 1):
            if count[t[p : p + k]] > 1:
                gone[p : p + k] = b"\x01" * k
        yield i, t, gone


def brute_bytes(docs, k, short):
    rows = [(i, (t or "").encode()) for i, t in docs]
    out = []
    for (i, t, gone), (_, _, brief) in zip(repeated_bytes(rows, k), repeated_bytes(rows, short), strict=True):
        runs = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest(), sum(brief)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("k", "most", "short"), [(25, 256, 25), (60, 256, 20), (60, 1, 35), (70, 256, 69)])
def test_suffix_dedup_equals_brute_force(spark, k, most, short):
    docs = [*corpus(k, 40), (90, "é" * 50 + "a"), (91, "b" + "é" * 50), (92, None)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), least=k, most_runs=most, short=short).collect()
    assert digests(got) == brute_bytes(docs, k, short)


def test_five_thousand_runs_under_one_minimiser(spark):
    """Different texts around one common sentence: one minimiser, more runs than a collection holds."""
    rng = random.Random(3)
    common = "this sentence is in every one of the documents, word by word and always the same"
    docs = [(i, f"{rng.random()} {rng.random()} {common} {rng.random()} {i % 4000}") for i in range(5000)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), least=100, short=70).collect()
    assert digests(got) == brute_bytes(docs, 100, 70)


def test_suffix_dedup_odd_rows(odd, none):
    got = suffix_dedup.remove_repeats(odd, least=100).select("doc_id", "n_bytes", "n_removed").collect()
    assert len(got) == odd.count()
    assert {(r.n_bytes, r.n_removed) for r in got if r.doc_id in (1, 2, None) and r.n_bytes} == {(240, 240)}
    assert [(r.n_bytes, r.n_removed) for r in got if r.doc_id == 6] == [(5000, 5000)]
    assert suffix_dedup.remove_repeats(none).count() == 0


def test_interval_expansion_equals_counting():
    rng = random.Random(5)
    for _ in range(200):
        k, least = rng.choice([2, 3, 5]), rng.choice([1, 2, 3, 6])
        strings = [bytes(rng.choice(b"abcde"[:k]) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 6))]
        count = Counter(s[i : i + least] for s in strings for i in range(len(s) - least + 1))
        want = [[i for i in range(len(s) - least + 1) if count[s[i : i + least]] > 1] for s in strings]
        early = rng.randint(1, least)
        count2 = Counter(s[i : i + early] for s in strings for i in range(len(s) - early + 1))
        want2 = [[i for i in range(len(s) - early + 1) if count2[s[i : i + early]] > 1] for s in strings]
        got = repeated_starts(strings, early, least) if early < least else [want2, *repeated_starts(strings, least)]
        assert [list(x) for x in got[0]] == want2 and [x.tolist() for x in got[1]] == want


def test_runs_cover_every_window_once():
    import numpy as np

    values = np.random.default_rng(1).integers(0, 5, 300).astype(np.uint64)
    off = np.array([0, 0, 90, 95, 300])
    r = window_runs(values, off, 20, 4)
    covered = sorted((int(i), int(x) + j) for i, x, k in zip(r.row, r.s, r.n, strict=True) for j in range(k))
    every = [(i, p) for i in range(4) for p in range(off[i + 1] - off[i] - 20 + 1)]
    assert covered == every
    assert sorted((int(r.row[b]), int(r.s[b]) + j) for b, k in zip(r.begin, r.covers, strict=True) for j in range(k)) == every


def test_chains_of_a_passage_are_the_same_in_any_text():
    import numpy as np

    rng = np.random.default_rng(2)
    passage = rng.integers(0, 1 << 40, 3000).astype(np.uint64)
    values = np.concatenate((passage, rng.integers(0, 1 << 40, 500).astype(np.uint64), passage))
    r = window_runs(values, np.array([0, 3000, 6500]), 50, 8)
    held = [{int(u) for u, b in zip(r.chain_u, r.begin, strict=True) if r.row[b] == i} for i in (0, 1)]
    assert len(held[0] & held[1]) >= len(held[0]) - 2 >= 3


def test_shared_passages_leave_runs_only_where_copies_depart_from_their_source(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    docs = []
    for i in range(40):
        words = list(base)
        words[rng.randrange(3000)] = f"edit{i}"
        docs.append((i, " ".join(words)))
    df = spans.keyed(spark.createDataFrame(docs, "doc_id long, text string"))
    gone, shared, _ = spans.RepeatedSpans(spans.word_units, 50, 8, True).shared_runs(df)
    every = spans.chains(df, spans.word_units, 50, 8)
    runs = every.selectExpr("sum(size(runs))").first()[0]
    assert gone.count() <= every.count() and shared.count() < runs / 3
    got = substring_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == brute_words(docs, 50)
