"""SimHash near copies against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lernspur.llm import queries, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius=2):
    values = np.array(fps, np.uint64)
    root = list(range(len(fps)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= radius):
            root[find(i)] = find(int(j))
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(fps))]


def check(df, got=None):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    want = [(d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, brute_components([d for d, _ in rows], fps))]
    got = [tuple(r) for r in (got or simhash.near_copies(df)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query(spark, data, corpus):
    check(corpus, queries.QUERIES["op13_simhash_bitslices"](spark, data))


def test_odd(odd, clashing, empty):
    check(odd)
    names = ["fp", "least", "comp", "choice", "key", "finer", "x", "y", "rest", "fingerprint", "component_id"]
    check(odd, simhash.near_copies(clashing.select("*", *[F.lit(7).alias(c) for c in names])))
    assert simhash.near_copies(empty).count() == 0
    assert simhash.near_copies(empty).columns == ["doc_id", "fingerprint", "component_id"]


def test_slices(monkeypatch):
    """Words, also very long ones, are the same wherever slices of a text end."""
    monkeypatch.setattr(simhash, "SLICE", 7)
    rng = np.random.default_rng(2)
    for text in ("", "   ", "Word", " A bb\tCCC\n", "x" * 40 + " y", *["".join(rng.choice(list("aB \n"), 50)) for _ in range(60)]):
        assert simhash.fingerprint(np.frombuffer(text.encode(), np.uint8)) == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_pairs_of_blocks(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = rng.choice(base, 700)
    for _ in range(3):
        values = values ^ (np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64)) * rng.integers(0, 2, 700).astype(np.uint64)
    block = np.sort(rng.integers(0, 9, 700))
    block[block > 6] = np.arange((block > 6).sum()) + 100
    want = {(i, j) for i in range(700) for j in range(i + 1, 700)
            if block[i] == block[j] and int(values[i] ^ values[j]).bit_count() <= radius}
    got = [(i, j) for a, b in simhash.close_pairs(values, block, radius) for i, j in zip(a.tolist(), b.tolist())]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 9


def linked(spark, values, radius=2):
    df = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long").repartition(6)
    links = [(r.x, r.y) for r in simhash.close_links(df, radius).collect()]
    found = brute_components(list(range(len(values))), values, radius)
    root = {v: i for i, v in enumerate(df_values(values))}
    up = list(range(len(values)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for x, y in links:
        up[max(find(root[x]), find(root[y]))] = min(find(root[x]), find(root[y]))
    assert [find(i) for i in range(len(values))] == found
    return len(links)


def df_values(values):
    return [v - (1 << 64) if v >> 63 else v for v in values]


@pytest.mark.parametrize("large", [4096, 5])
def test_links(spark, monkeypatch, large):
    """Families around the radius, by blocks in one go and dealt out twice."""
    monkeypatch.setattr(simhash, "LARGE", large)
    rng = np.random.default_rng(9)
    values = {0, (1 << 64) - 1, 1 << 63}
    for base in rng.integers(0, 1 << 63, 25, dtype=np.uint64).tolist():
        value = base
        for _ in range(30):
            for b in rng.choice(64, int(rng.integers(1, 4)), replace=False).tolist():
                value ^= 1 << b
            values.add(value)
            value = base if rng.random() < 0.5 else value
    linked(spark, sorted(values))
    linked(spark, sorted(values), radius=1)


def test_one_large_block(spark, monkeypatch):
    """Many fingerprints alike in half of their bits."""
    monkeypatch.setattr(simhash, "LARGE", 50)
    rng = np.random.default_rng(10)
    values = sorted({int(v) for v in rng.integers(0, 1 << 11, 1500)})
    assert linked(spark, values) < 6 * 36 * len(values)
