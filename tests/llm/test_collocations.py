"""Collocations against brute force with whole dictionaries."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lernspur.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, most=3, threshold=10, top=2000):
    total, f = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            own = f.setdefault(lang, Counter())
            for m in range(1, most + 1):
                for i in range(len(words) - m + 1):
                    own[tuple(words[i:i + m])] += 1
    out = []
    for lang, own in f.items():
        kept = []
        phrases = {p: a for p, a in own.items() if len(p) > 1 and a >= threshold}
        around = Counter()
        for q, b in phrases.items():
            for size in range(2, len(q)):
                for i in range(len(q) - size + 1):
                    around[q[i:i + size]] = max(around[q[i:i + size]], b)
        for p, a in phrases.items():
            if 100 * around[p] >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def check(df, **options):
    got = sorted(tuple(r) for r in collocations.collocations(df, **options).collect())
    names = {"most_words": "most", "threshold": "threshold", "top": "top"}
    want = brute([(r.lang, r.text) for r in df.select("lang", "text").collect()],
                 **{names[k]: v for k, v in options.items()})
    assert got == want
    return got


def texts(rng, n, words):
    vocabulary = [*(f"w{i}" for i in range(6)), "É", "été", "a b", "New", "york", "City"]
    for _ in range(n):
        out = []
        for w in rng.choice(vocabulary, words):
            out.append("new York city" if w == "New" and rng.random() < 0.8 else w)
        yield "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "!"]) for w in out)


def test_random(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(str(rng.choice(["en", "de"])), t) for t in texts(rng, 60, 90)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert len(check(df)) > 20
    check(df, top=5)
    check(df, threshold=3)
    check(df, most_words=2)


def test_cuts_of_texts_and_chunks(spark, monkeypatch):
    """Phrases over the ends of slices, chunks and hash partitions are counted once."""
    monkeypatch.setattr(collocations, "SLICE", 50)
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 7)
    monkeypatch.setattr(collocations, "HELD", 20)
    rng = np.random.default_rng(2)
    rows = [("en", t) for t in texts(rng, 20, 60)] + [(None, "long" * 40 + " tail " + "x" * 130)]
    batches = spark.createDataFrame(rows, "lang string, text string").toArrow().to_batches()
    for most in (2, 3):
        names, found = {}, Counter()
        for now in collocations._chunks(batches, names, most):
            coded = collocations._Coded(now, names)
            for m, starts, _ in coded.grams(most):
                for s in starts:
                    found[tuple(coded.words[coded.ids[s + k]] for k in range(m))] += 1
        want = Counter()
        for _, text in rows:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER)):
                own = re.findall(r"[^\x20\x09]+", piece)
                for m in range(1, most + 1):
                    want.update(tuple(own[i:i + m]) for i in range(len(own) - m + 1))
        assert found == want


def test_bounds(spark, monkeypatch):
    """Partitions, and how much a task holds, do not change the result."""
    for name, value in (("BLOCK_BYTES", 4000), ("HELD", 50), ("ID_BITS", 7)):
        monkeypatch.setattr(collocations, name, value)
    rng = np.random.default_rng(3)
    rows = [("en", t) for t in texts(rng, 50, 80)]
    check(spark.createDataFrame(rows, "lang string, text string").repartition(7))


def test_odd(spark, odd, clashing, empty):
    check(odd, threshold=2)
    extra = clashing.select("*", *[F.lit(7).alias(c) for c in ("f", "phrase", "words", "_p", "_w", "block", "a", "rank", "_at", "_part")])
    assert collocations.collocations(extra, threshold=2).collect() == collocations.collocations(odd, threshold=2).collect()
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [(None, "a b, a b. A B")] * 5 + [("und", "a b")] * 5 + [("", "a b c")] * 10 + [("en", None), ("en", "")]
    assert len(check(spark.createDataFrame(rows, "lang string, text string"))) == 2


def test_scores_beyond_64_bits(spark):
    counts = [("en", 0, "", 9), ("en", 1, "a", 3_000_000_000_000), ("en", 1, "b", 2_999_999_999_999),
              ("en", 2, "a b", 2_999_999_999_998)]
    df = spark.createDataFrame(counts, "lang string, words int, phrase string, f long")
    parts = {1: df.where("words = 1").select("lang", F.col("phrase").alias("_p"), "f")}
    (row,) = collocations._scored(df, 2, parts).collect()
    assert row.score == 1_000_000 * counts[3][3] ** 2 // (counts[1][3] * counts[2][3])


@pytest.mark.parametrize("seed", range(4))
def test_summaries_lose_nothing_frequent(seed):
    """Any order of merges keeps every key that occurs threshold times, in mass / threshold counters."""
    rng = np.random.default_rng(seed)
    threshold = 10
    stream = np.concatenate((rng.integers(0, 5000, 4000), np.repeat(np.arange(40), rng.integers(1, 30, 40)))).astype(np.uint32)
    rng.shuffle(stream)
    capacity = len(stream) // threshold
    kept, n, lost = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
    for part in np.array_split(stream, 13):
        own, n_own, cut = collocations.merged(part, np.ones(len(part), np.int64), capacity)
        lost += cut
        kept, n, cut = collocations.merged(np.concatenate((kept, own)), np.concatenate((n, n_own)), capacity)
        lost += cut
        assert len(kept) <= capacity
    held = dict(zip(kept.tolist(), n.tolist()))
    assert lost < threshold
    for key, times in zip(*np.unique(stream, return_counts=True)):
        assert held.get(int(key), 0) <= times <= held.get(int(key), 0) + lost
        assert times < threshold or int(key) in held


@pytest.mark.parametrize("numbers", [[], [0], [5], [0, 0, 65535, 131070], [1, 70_000, (1 << 24) - 1]])
def test_packed_numbers(numbers):
    assert collocations._unpacked(collocations._packed(np.array(numbers, np.uint32))).tolist() == numbers
