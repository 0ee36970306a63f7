"""Operators against brute force on a small corpus, and on awkward rows."""

import hashlib
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lernspur.llm import (
    decontam, fingerprints, langid, lattice, mixing, ngramjoin, quality, sharding, tokencount, tokenfile, warc,
)

WORD = r"[^\x20\x09-\x0D]+"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(WORD, text or "")


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- n-gram join

def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    seen = defaultdict(list)
    for i, own in enumerate(sets):
        shared = Counter(j for g in own for j in seen[g])
        for g in own:
            seen[g].append(i)
        for j, k in shared.items():
            if 100 * k >= 80 * (len(own) + len(sets[j]) - k):
                root[find(i)] = find(j)
    least = defaultdict(lambda: None)
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None and (least[r] is None or d < least[r]):
            least[r] = d
    return [(d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def check_join(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    assert plain(ngramjoin.ngram_components(df)) == sorted(brute_components(rows), key=repr)


def test_join_corpus(corpus):
    check_join(corpus)


def test_join_odd(odd, clashing, empty):
    check_join(odd)
    assert plain(ngramjoin.ngram_components(clashing)) == plain(ngramjoin.ngram_components(odd))
    assert ngramjoin.ngram_components(empty).count() == 0
    assert ngramjoin.one_of_each(odd).columns == odd.columns


def test_join_family(spark, monkeypatch):
    """A family of edited copies around the threshold, and a passage that unlike documents share."""
    monkeypatch.setattr(ngramjoin, "HOT", 8)
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]
    base = list(rng.choice(vocabulary, 120))
    passage = list(rng.choice(vocabulary, 55))
    rows = []
    for i in range(90):
        own = list(base)
        for _ in range(i % 7):
            at = int(rng.integers(0, len(own)))
            own[at] = str(rng.choice(vocabulary[:40]))
        if i % 5 == 0:
            del own[:int(rng.integers(0, 20))]
        rows.append((i, " ".join(own)))
    rows += [(100 + i, " ".join([*passage, *rng.choice(vocabulary, 60)])) for i in range(40)]
    check_join(spark.createDataFrame(rows, "doc_id long, text string"))


def test_rows_that_face_a_large_component(spark, monkeypatch):
    """Rows beside a family that link with its original only, which does not lead: few pairs are checked for them."""
    rng = np.random.default_rng(8)
    base = [f"b{i}" for i in range(150)]

    def edited(text, places):
        return [f"e{rng.integers(1 << 40)}" if i in places else w for i, w in enumerate(text)]

    hub = edited(base, {2})
    family = [edited(hub, {0, *(1 + rng.choice(2, 1)), 140 + int(rng.integers(9)), 100 + int(rng.integers(20))}) for _ in range(160)]
    beside = [edited(base, {40 + 10 * i for i in rng.choice(9, 3, replace=False)}) for _ in range(60)]
    texts = [*[hub] * 12, base, base, *family, *beside]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    checked, plain_verified = [], ngramjoin.verified
    monkeypatch.setattr(ngramjoin, "verified", lambda *a: checked.append(a[1].count()) or plain_verified(*a))
    check_join(df)
    assert max(checked) < 1_000


def test_components_of_few_and_many(spark):
    """A chain, a ring, stars, loops and repeated edges, in one partition and by shuffles."""
    chain = [(i, i + 1) for i in range(-40, 40)]
    ring = [(100 + i, 100 + (i + 1) % 9) for i in range(9)]
    edges = [*chain, *ring, *[(300, 300 + i) for i in range(1, 30)], (400, 400), (500, 501), (501, 500), (500, 501)]
    df = spark.createDataFrame(edges, "x long, y long").repartition(5)
    want = {i: -40 for i in range(-40, 41)} | {100 + i: 100 for i in range(9)} | {300 + i: 300 for i in range(30)}
    want |= {500: 500, 501: 500}
    for rows, few in ((len(edges), 1_000), (len(edges), 10), (None, 1_000)):
        got = [tuple(r) for r in ngramjoin.components(df, rows, few).collect()]
        assert len(got) == len(want) and dict(got) == want


def test_few_edges_take_one_job(spark, monkeypatch):
    """A long path within the bound is contracted without rounds of stored tables."""
    stored, plain = [], ngramjoin.materialize
    monkeypatch.setattr(ngramjoin, "materialize", lambda df: stored.append(df) or plain(df))
    df = spark.createDataFrame([(i + 1, i) for i in range(-2_000, 2_000)], "x long, y long").repartition(4)
    got = ngramjoin.components(df, 4_000).collect()
    assert len(got) == 4_001 and {r.comp for r in got} == {-2_000} and not stored


def test_bitmaps_reach_the_driver_compressed(spark, monkeypatch):
    """What the driver collects for bitmaps follows the columns counted, not the bitmaps' fixed size."""
    sent, plain = [], ngramjoin.zlib.decompress
    monkeypatch.setattr(ngramjoin.zlib, "decompress", lambda x: sent.append(len(x)) or plain(x))
    rows = spark.createDataFrame([(1, f"{'a b c d e f g ' * 3}{i % 3}") for i in range(9)], "doc_id long, text string")
    assert ngramjoin.incidence(rows)[1].count() and 0 < sum(sent) < 1 << 18


# ---- token file

def test_token_file(spark, corpus, odd):
    from tokenizers import Tokenizer

    path = tokenfile.default_tokenizer()
    tokenizer = Tokenizer.from_file(path)
    for df in (corpus, odd.where("doc_id <> 10")):
        rows = sorted([(r.doc_id, r.text or "") for r in df.collect() if r.doc_id is not None])
        want, start = [], 0
        for d, t in rows:
            ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
            want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        got = [tuple(r) for r in tokenfile.token_table(df, path, parts=3).collect() if r.doc_id is not None]
        assert sorted(got) == sorted(want)
    blocks, dictionaries = tokenfile.write_blocks(corpus, path)
    some = {r.doc_id: r.text for r in corpus.limit(3).collect()}
    for r in tokenfile.fetch(blocks, dictionaries, list(some)).collect():
        assert r.ids == tokenizer.encode(some[r.doc_id], add_special_tokens=False).ids + [2]


def test_segments_are_exact():
    segments = tokenfile._Segments(tokenfile.default_tokenizer())
    rng = np.random.default_rng(2)
    parts = [" ", "  ", "\n", "\t", "a", "b", "é", "1", ".", ",", "'s", "!", "\x1f", "ll", "'", "<|endoftext|>", " "]
    texts = ["".join(rng.choice(parts, rng.integers(0, 10))) for _ in range(3_000)]
    for t, ids in zip(texts, segments.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == segments.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_segments_of_even_texts_are_exact(monkeypatch):
    """Ids of words that are encoded together, with any cache; words are encoded fifty at a time, not one by one."""
    segments = tokenfile._Segments(tokenfile.default_tokenizer())
    rng = np.random.default_rng(3)
    parts = ["a", "b", "é", "1", ".", ",", "'s", "!", "ll", "'", "<|endoftext|>", "漢", "Ġ", "Ċ", "Ab", "x1.", "y,"]
    words = ["".join(rng.choice(parts, rng.integers(1, 6))) for _ in range(20_000)]
    cut = np.cumsum(rng.integers(1, 40, 600))
    texts = [words[a][0] + "".join(rng.choice([" ", "\n"]) + w for w in words[a:b]) for a, b in zip(cut, cut[1:])]
    taken, plain = [], segments._ids
    monkeypatch.setattr(segments, "_ids", lambda own: taken.append(len(own)) or plain(own))
    for limit in (100_000, 0):
        monkeypatch.setattr(tokenfile, "CACHE_SEGMENTS", limit)
        for t, ids in zip(texts, segments.encode(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == segments.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)
    assert sum(taken) < 3_000 and not segments.encode([])


def test_token_file_empty(empty):
    assert tokenfile.token_table(empty, tokenfile.default_tokenizer()).count() == 0


# ---- archives

def test_archives(spark):
    big, small = "<p>" + "x" * 200, "short"
    rows = [(5, "http://a/\r\nX: y", big), (3, None, big), (9, "http://b", big), (1, "u", small), (2, "u", small),
            (4, None, None), (None, "n", big), (6, "é", "ä" * 60), (7, "é", "ä" * 60), (3, "again", big)]
    got = plain(warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
    want = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = min((p for p, _, h in rows if h == html and p is not None), default=None)
        again = len(raw) >= 100 and page != first
        want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=repr)
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archive_payloads(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i % 3}" + "y" * 150) for i in range(9)]
    files = warc.write_archives(warc.revisits(spark.createDataFrame(rows, "page_id long, url string, html string")),
                                warc.new_folder(spark, "warc"))
    back = {r.page_id: r for r in warc.read_archives(files, payloads=True).collect()}
    assert {p: back[p if back[p].refers_to is None else back[p].refers_to].html for p in back} == {p: h for p, _, h in rows}
    assert {p: r.url for p, r in back.items()} == {p: u for p, u, _ in rows}


# ---- shards

def test_table_by_turns(spark):
    names, size = ["c", "a", "b"], 101

    def number(text):
        return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)

    owner, order = [None] * size, sorted(names)
    at = [0] * 3
    for turn in range(size):
        k = turn % 3
        start, step = number("offset:" + order[k]) % size, number("step:" + order[k]) % (size - 1) + 1
        while owner[(start + at[k] * step) % size] is not None:
            at[k] += 1
        owner[(start + at[k] * step) % size] = order[k]
        at[k] += 1
    assert [r.shard for r in sharding.shard_table(spark, names, size).orderBy("slot").collect()] == owner
    with pytest.raises(ValueError):
        sharding.shard_table(spark, names, 100)


def test_place(spark, odd):
    table = sharding.shard_table(spark, ["a", "b"], 101)
    got = sharding.place(odd, F.col("doc_id"), table, 101)
    assert got.count() == odd.count() and got.where("shard IS NULL").count() == 0


# ---- decontamination

def test_leaks(spark):
    item = "Once John bought 12 apples for 30 usd and gave Mary exactly 5 of the fresh apples before John left town."
    other = "A short one, with only six."
    rows = [
        (1, "Some text. " + item + " More text here."), (2, item.replace("12", "77").replace("John", "Peter").replace("Mary", "Anna")),
        (3, item.replace("before John", "before Henry")), (4, "nothing to see in this plain document at all, really nothing"),
        (5, None), (6, ""), (7, "intro words " + other.lower()), (None, item),
    ]
    found = {(r.doc_id, r.item_id): r.changed for r in decontam.leaks(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame([(1, item), (2, other), (3, None), (4, "")], "item_id long, text string")).collect()}
    assert set(found) == {(1, 1), (2, 1), (None, 1), (7, 2)}
    assert found[1, 1] == 0 and found[2, 1] == 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontam.without_leaks(docs, bench).collect()) == [3, 4, 5, 6, 7]


def test_leaks_corpus(spark, data, corpus, odd, empty):
    bench = spark.read.parquet(f"{data}/benchmark.parquet")

    def norm(t):
        return re.findall(r"\S+", re.sub(r"[!-/:-@\[-`{-~]", "", t.translate(LOWER)))

    want = set()
    items = {r.item_id: norm(r.text) for r in bench.collect()}
    for r in corpus.collect():
        own = norm(r.text)
        for i, w in items.items():
            n = min(8, len(w))
            have = {tuple(own[k:k + n]) for k in range(len(own) - n + 1)}
            hits = sum(tuple(w[k:k + n]) in have for k in range(len(w) - n + 1))
            if hits and 2 * hits >= len(w) - n + 1:
                want.add((r.doc_id, i))
    assert {(r.doc_id, r.item_id) for r in decontam.leaks(corpus, bench).collect()} == want
    assert decontam.leaks(odd, bench).count() == 0 and decontam.leaks(empty, bench).count() == 0


def leaks_of(spark, item, *texts):
    """Numbers of the texts that hold the item."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id for r in decontam.leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}


def test_texts_are_cut_a_piece_at_a_time():
    """Memory follows the piece and not the batch; the tokens are those of the whole batch."""
    texts = ["Anna walks 3 km, then Bob takes 12 apples.  " * (i % 90) for i in range(1_000)]
    column = pa.array(texts)
    whole = decontam.Tokens(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0, *map(len, texts)]))
    tracemalloc.start()
    cut = [(i + t.of, t.value, t.begin) for i, t in decontam._pieces(column)]
    kept, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    for got, want in zip(map(np.concatenate, zip(*cut)), (whole.of, whole.value, whole.begin)):
        assert got.tolist() == want.tolist()
    assert most - kept < 32 << 20


def test_leaks_with_other_lengths(spark):
    item = ("one day the old farmer called Bob went to the market of the small town with 12 fresh eggs and sold half of them "
            "to the baker before he came home again in the dark")
    assert leaks_of(
        spark, item, item.replace("and sold", "and then sold"), item.replace("Bob", "Mary Ann"), item.replace("fresh ", ""),
        item.replace("and sold", "and on this very fine and warm day sold"), "before he came home again in the dark he slept",
    ) == {0, 1, 2, 3}


def test_leaks_with_names_anywhere(spark):
    short = "Tom has 3 apples. Tom eats 2 of the apples. Tom buys 9 more apples. How many apples are left?"
    assert leaks_of(spark, short, short.replace("Tom", "Anna").replace("3", "8"), "so we ask, " + short,
                    "Henry reads a long book about apples. It is left in the house.") == {0, 1}
    item = "the train was late when Tom and his friend Mary reached the station at 9 in the cold rain of the night"
    assert leaks_of(spark, item, item.lower().replace("9", "7"), item.upper(), item.replace(" ", "\n")) == {0, 1, 2}


def test_leaks_of_numbers(spark):
    item = "Compute 12 + 7 * 3 - 4"
    assert leaks_of(spark, item, "First " + item.lower() + " and then rest.", "Compute 12 and 7 and 3", "12 7 3 4") == {0}
    item = "3 kg 17 km 5 11 19 23 Bob 14 Mary 6 8 cm 99 41 52 63"
    assert leaks_of(spark, item, "here it is, " + item, "3 kg 17 km 5 12 19 24 Bob 14 Mary 7 8 cm 98 41 53 63") == {0}


def test_leaks_with_redrawn_fillers(spark):
    item = "At first Tom and Mary had 3 red apples and 5 green pears in the basket and later Tom gave 3 of them to the old teacher"
    docs = [item.replace("3", "4").replace("5", "4"), item.replace("gave 3", "gave 8"), item.replace("Mary", "Tom"),
            item.replace("later Tom", "later Henry")]
    assert leaks_of(spark, item, *docs) == {0, 1, 2}
    same = [(None, item), (None, item.replace("Tom", "Peter"))]
    found = decontam.leaks(spark.createDataFrame(same, "doc_id long, text string"),
                           spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.changed) for r in found] == [(None, 1, 0)]


# ---- fingerprints

def test_fingerprints(corpus, odd):
    for df in (corpus, odd.where("doc_id <> 10 AND doc_id <> 1")):
        rows = sorted((r.doc_id, r.text or "") for r in df.where("doc_id IS NOT NULL").collect())
        got = {r.doc_id: r for r in fingerprints.edited_fingerprints(df.where("doc_id IS NOT NULL"), parts=3).collect()}
        assert len(got) == len(rows)
        for (d, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
            half = len(text) // 2
            edited = text[:len(text) - half] + after[:half]
            assert got[d].n_chars == len(text)
            assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert 0 <= got[d].near_next <= 1 and (got[d].near_edited == 1) == (
                Counter(text.split("\n")) == Counter(edited.split("\n")))
        marks = {tuple(sorted(t.split("\n"))): got[d].fingerprint for d, t in rows}
        assert len(set(marks.values())) == len(marks)
        assert all(got[d].fingerprint == marks[tuple(sorted(t.split("\n")))] for d, t in rows)


def test_lines_of_both_texts_are_hashed_once(spark, monkeypatch):
    rows = [(k, "\n".join(f"{k} line {i:03}" for i in range(100))) for k in range(4)] + [(4, "\nab"), (5, "a\n\nbc\n")]
    df, taken = spark.createDataFrame(rows, "doc_id long, text string"), []
    plain = fingerprints.fingerprints
    monkeypatch.setattr(fingerprints, "fingerprints", lambda d, text, by: taken.append((d, text)) or plain(d, text, by))
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(df, parts=1).collect()}
    pieces, name = taken[0]
    assert pieces.where("NOT _guest").select(F.explode(F.split(name, "\n"))).count() < 4 * 155 + 20
    texts = [(d, t[:len(t) - len(t) // 2] + after[:len(t) // 2]) for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1])]
    for column, of in (("fingerprint", rows), ("edited_fingerprint", texts)):
        whole = plain(spark.createDataFrame(of, "k long, t string"), "t", ["k"])
        for r in whole.select("k", fingerprints.as_text(F.col("lanes")).alias("mark")).collect():
            assert got[r.k][column] == r.mark


def test_fingerprint_arithmetic(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, "c"), (3, "b\na\nc"), (4, "a\nb")], "k long, t string")
    lanes = {r.k: r.lanes for r in fingerprints.fingerprints(df, "t", ["k"]).collect()}
    one = spark.createDataFrame([(lanes[1], lanes[2], lanes[3])], "a array<bigint>, b array<bigint>, c array<bigint>")
    got = one.select(fingerprints.combined(F.col("a"), F.col("b")).alias("sum"),
                     fingerprints.combined(F.col("c"), F.col("b"), -1).alias("rest")).first()
    assert got["sum"] == lanes[3] and got["rest"] == lanes[1] == lanes[4]


def test_likeness_of_any_size(spark):
    """near_* against the exact multiset overlap; what is not shared is estimated within a factor of two and a half."""
    rows, exact = [], {}
    for n in (10, 100, 400, 2_000, 5_000, 20_000):
        for percent in (0, 50, 80):
            k = len(exact)
            a = [f"{k} line {i}" for i in range(n)]
            b = [*a[:n * percent // 100], *[f"{k} other {i}" for i in range(n - n * percent // 100)]]
            rows.append((k, "\n".join(a), "\n".join(b)))
            exact[k] = 2 * sum((Counter(a) & Counter(b)).values()) / (2 * n)
    df = spark.createDataFrame(rows, "k long, a string, b string")
    a, b = (fingerprints.fingerprints(df, c, ["k"]).withColumnRenamed("lanes", c) for c in "ab")
    got = a.join(b, "k").select("k", fingerprints.likeness(F.col("a"), F.col("b")).alias("near")).collect()
    for r in got:
        assert 1 - 2.5 * (1 - exact[r.k]) <= r.near <= 1 - (1 - exact[r.k]) / 2.5, (r, exact[r.k])
    assert len(got) == len(exact) and np.mean([abs(r.near - exact[r.k]) for r in got]) < 0.2


def test_lanes_are_compared_once(spark):
    """The lanes of a pair are not compared again for every step of the estimate, as in a lambda over the steps."""
    df = spark.createDataFrame([([0] * (fingerprints.DENSE + fingerprints.SPARSE) + [1],) * 2], "a array<bigint>, b array<bigint>")
    plan = df.select(fingerprints.likeness(F.col("a"), F.col("b")).alias("near"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("zip_with(") == 1 and "filter(" not in plan
    grid = fingerprints._grid()
    assert fingerprints._guesses() == [
        grid[sum((x + y) / 2 < n for (x, _), (y, _) in zip(grid, grid[1:]))][1] for n in range(fingerprints.SPARSE + 1)]


# ---- quality

def test_quality(spark, data, corpus, odd, empty):
    labels = spark.read.parquet(f"{data}/labels.parquet")
    got = {r.doc_id: r.accepted for r in quality.quality_scores(corpus, labels).collect()}
    marks = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in got}
    assert np.mean([got[d] for d, q in marks.items() if q == 1]) > 0.95
    assert np.mean([not got[d] for d, q in marks.items() if q == 0]) > 0.95
    assert {r.doc_id for r in quality.keep_good(corpus, labels).collect()} == {d for d, a in got.items() if a}
    assert quality.quality_scores(odd, labels).count() == odd.count()
    assert quality.keep_good(odd.withColumn("size", F.lit(1)), labels.limit(0)).columns == [*odd.columns, "size"]
    assert quality.quality_scores(empty, labels).count() == 0


def test_kth_largest(spark):
    values = [3.5, 3.5, -1.0, 8.25, 8.25, 8.25, 0.0, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in range(1, len(values) + 1):
        assert quality.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]


# ---- token counts and languages

def segmentations(text, known):
    if not text:
        yield []
    for n in range(1, len(text) + 1):
        if text[:n] in known:
            for rest in segmentations(text[n:], known):
                yield [text[:n], *rest]


def test_forward_and_best_over_all_segmentations():
    names = [b" ", b"a", b"b", b"ab", b" a", b"ba", b"abb"]
    pieces = lattice.Pieces(names)
    score = -np.array([3.0, 2.5, 2.25, 1.5, 4.0, 1.75, 5.0])
    weights = np.exp(score)[:, None]
    scaled = weights * langid._SCALE ** np.array([len(x) for x in names])[:, None]
    data = np.frombuffer(b"abba ab a bb abab babab", np.uint8)
    starts = np.array([0, 5, 8, 10, 13, 18])
    ends = np.array([4, 7, 9, 12, 17, 23])
    trie = lattice.Trie(data, starts, ends)
    forward = langid.trie_forward(trie, pieces, scaled)[:, 0]
    counts = tokencount.trie_counts(trie, pieces, score, -100.0)
    for i, (a, b) in enumerate(zip(starts, ends)):
        word = data[a:b].tobytes()
        every = list(segmentations(b" " + word, pieces.number))
        totals = [sum(score[pieces.number[p]] for p in s) for s in every]
        assert forward[i] == pytest.approx(np.log(np.exp(totals).sum()))
        assert langid.forward_one(word, pieces, scaled)[0] == pytest.approx(forward[i])
        assert counts[i] == min(len(s) for s, t in zip(every, totals) if t >= max(totals) - 1e-12)
        assert tokencount.count_one(word, pieces, score, -100.0) == counts[i]


def test_token_counts(corpus, odd, empty):
    path = lattice.default_vocabulary()
    pieces, score, byte = tokencount._load(path)
    for df in (corpus.limit(40), odd):
        want = []
        for r in df.collect():
            own = words(r.text)
            want.append((r.doc_id, len(own), sum(tokencount.count_one(w.encode(), pieces, score, byte) for w in own)))
        assert plain(tokencount.token_counts(df, path)) == sorted(want, key=repr)
    assert tokencount.token_counts(empty, path).count() == 0


def test_languages(corpus, odd, empty):
    path = lattice.default_vocabulary()
    true = {r.doc_id: r.lang for r in corpus.collect()}
    held = [r for r in langid.identify(corpus, path).collect() if r.held_out]
    assert {r.doc_id for r in held} == {d for d in true if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([true[r.doc_id] == r.lang_pred for r in held]) > 0.97
    got = langid.identify(odd, path).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.lang_pred == "und" for r in got if r.doc_id in (3, 4, 5, 9))
    assert langid.identify(empty, path).count() == 0


# ---- mixing

def test_mix(corpus, odd, empty):
    for df in (corpus, odd):
        got = mixing.mix(df, block=16).collect()
        assert len(got) == df.count()
        totals = defaultdict(int)
        for r in got:
            totals[r.source] += r.taken
            assert 0 <= r.taken <= 2 * r["size"] and sum(r.passes) == r.taken
        for r in got:
            assert totals[r.source] == int(r.target)
    assert mixing.mix(empty).count() == 0


def test_targets():
    got = mixing.targets([(None, 100), ("b", 10), ("a", 1000)])
    assert [g[0] for g in got] == ["a", "b", None]
    assert sum(g[2] for g in got) == pytest.approx(1.5 * 1110)
    assert all(t <= 2 * n for _, n, t in got)


def test_schedule_is_even(spark):
    needs = [500, 200, 1, 300]
    rows = mixing.schedule(spark, needs).orderBy("slot").collect()
    assert Counter(r.src for r in rows) == dict(enumerate(needs))
    assert all(len({r["rank"] for r in rows if r.src == s}) == n for s, n in enumerate(needs))
    seen = Counter()
    for k, r in enumerate(rows[:900], 1):
        seen[r.src] += 1
        assert abs(seen[0] - k * 0.5) < 25


def test_schedule_of_many_slots(spark):
    """The second source's share is one that the golden-ratio row serves late: 10 slots behind."""
    needs = [3_335_202, 6_024_195, 640_579]
    assert {r.src: r["count"] for r in mixing.schedule(spark, needs).groupBy("src").count().collect()} == dict(enumerate(needs))


def test_schedule_tells_of_missing_slots(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLACK", -40)
    with pytest.raises(ValueError):
        mixing.schedule(spark, [500, 200, 100])


def test_mixed_documents(corpus, odd):
    taken = {(r.doc_id): r.taken for r in mixing.mix(corpus).collect()}
    own = defaultdict(int)
    for r in mixing.mixed_documents(corpus).collect():
        own[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text)
    assert own == {d: n for d, n in taken.items() if n}
    assert mixing.mixed_documents(odd).columns == odd.columns
