"""Token ids as compressed documents with an offset index.

Documents are tokenised in place, each id array is compressed by itself with a zstandard
dictionary that all share, and the small results are dealt into ranges of ascending doc_id. A range
is stored as blocks of some megabytes:

    block   binary   the documents' zstandard frames, one after the other
    offsets binary   little-endian uint64, one more than documents: where each frame lies in block
    counts  binary   little-endian uint32: ids of each document
    ids     array    doc_id of each document
    dict_hash string SHA-256 of the dictionary that the frames need

so one short document is read by its block's index alone. Ids are little-endian uint32.
Blocks are rows of a Parquet table: retries of tasks leave no half-written files, and any file
system that Spark writes to will do.
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from lernspur.runtime import materialize

from .ordering import default_parts, order_key, range_bounds, range_number
from .text import release

END_ID = 2
DICT_BYTES = 64 << 10
SAMPLE_DOCS = 1_000
SAMPLE_IDS = 4_096
BLOCK_BYTES = 4 << 20
LEVEL = 3
CACHE_SEGMENTS = 100_000  # of texts with uneven white space, and twice as many of the others, in a task

# Between non-spaces, a space starts a pre-token and a line feed is one; text may be cut there.
_CUT = re.compile(r"(?<=[^\s])(?= [^\s])|(?<=[^\s])(?=\n[^\s])|(?<=[^\s]\n)(?=[^\s])")

_tokenizers: dict[str, tuple] = {}


def _even(text: str) -> bool:
    """Whether the only white space of a text is single spaces and line feeds between other characters."""
    if text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return False
    return text.replace("\n", "").isprintable()  # other white space is not printable


class _Segments:
    """Ids of text segments, remembered up to a fixed number."""

    def __init__(self, path: str):
        # A task has one core; a thread for each core of the machine in every worker takes time and memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        # Ids that begin with a space or hold a line feed; in an even text these stand where a segment does.
        self.mark = {" ": np.zeros(size, bool), "\n": np.zeros(size, bool)}
        for token, i in self.tokenizer.get_vocab().items():
            self.mark[" "][i], self.mark["\n"][i] = token[0] == "\u0120", "\u010a" in token
        self.known: dict[bytes, bytes] = {}  # segments of even texts, with the space or line feed before them
        self.parts: dict[str, bytes] = {}  # segments of other texts
        self.line, *stops = self._ids(["\n", ".", ","])
        self.stops = dict(zip(".,", stops))

    def _ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 20_000):
            done = self.tokenizer.encode_batch_fast(texts[i:i + 20_000], add_special_tokens=False)
            out += [array("I", e.ids).tobytes() for e in done]
        return out

    def _joined(self, segments: list[str], n: int = 50) -> list[bytes]:
        """Ids of segments that each begin with the same space or line feed, ``n`` of them as one text."""
        mark, out = self.mark[segments[0][0]] if segments else None, []
        for i in range(0, len(segments), 400 * n):
            some = segments[i:i + 400 * n]
            for at, raw in zip(range(0, len(some), n), self._ids(["".join(some[k:k + n]) for k in range(0, len(some), n)])):
                cuts = (4 * np.flatnonzero(mark[np.frombuffer(raw, "<u4")])).tolist()
                own = some[at:at + n]
                # Each begins with a mark and has no other; should that ever not hold, they are encoded one by one.
                right = len(cuts) == len(own) and cuts[0] == 0
                out += [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)])] if right else self._ids(own)
        return out

    def _learn(self, segments: list[bytes]) -> None:
        """Add the ids of segments of even texts."""
        ends, cores = [], set()
        for raw in segments:
            s = raw.decode()
            # A full stop or comma after a letter is a pre-token of its own.
            if len(s) > 2 and s[-1] in ".," and s[-2].isalpha():
                ends.append(raw)
                if raw[:-1] not in self.known:
                    cores.add(s[:-1])
            else:
                cores.add(s)
        after, lines = ([s for s in cores if s[0] == lead] for lead in " \n")
        first = [s for s in cores if s[0] not in " \n"]
        for own, ids in ((after, self._joined(after)), (lines, self._joined(lines)), (first, self._ids(first))):
            self.known.update(zip(map(str.encode, own), ids))
        for raw in ends:
            self.known[raw] = self.known[raw[:-1]] + self.stops[chr(raw[-1])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian uint32, without an end id."""
        gc.disable()  # millions of strings, no cycles
        try:
            even = [bool(t) and _even(t) for t in texts]
            found = iter(self._encode_even([t for t, e in zip(texts, even) if e]))
            rest = iter(self._encode_parts([t for t, e in zip(texts, even) if not e]))
            return [next(found if e else rest) for e in even]
        finally:
            gc.enable()

    def _encode_even(self, texts: list[str]) -> list[bytes]:
        """Of texts cut before each space and line feed; equal segments are looked up once."""
        if not texts:
            return []
        raw = [t.encode() for t in texts]
        first = np.cumsum([0, *map(len, raw)])[:-1]
        data = b"".join(raw)
        flat = np.frombuffer(data, np.uint8)
        cuts = (flat == 0x20) | (flat == 0x0A)
        cuts[first] = True
        starts = np.flatnonzero(cuts)
        ends = np.append(starts, len(flat)).astype(np.int64)
        cut = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]).dictionary_encode()
        segments, at = cut.dictionary.to_numpy(zero_copy_only=False).tolist(), cut.indices.to_numpy()
        before = len(self.known)
        fresh = [s for s in segments if s not in self.known]
        self._learn(fresh)
        ids = [self.known[s] for s in segments]
        if len(self.known) > 2 * CACHE_SEGMENTS:
            for s in list(self.known)[before:]:
                del self.known[s]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        offsets = (np.cumsum(sizes) - sizes)[at]
        sizes = sizes[at]
        upto = np.cumsum(sizes)
        places = np.repeat(offsets - upto + sizes, sizes)
        places += np.arange(upto[-1])
        found = np.frombuffer(b"".join(ids), "<u4")[places].tobytes()
        cuts = [*(4 * (upto - sizes)[np.searchsorted(starts, first)]).tolist(), len(found)]
        return [found[a:b] for a, b in zip(cuts, cuts[1:])]

    def _encode_parts(self, texts: list[str]) -> list[bytes]:
        cut = [_CUT.split(t) if t else [] for t in texts]
        fresh = list({p for parts in cut for p in parts if p not in self.parts})
        self.parts.update(zip(fresh, self._ids(fresh)))
        out = [b"".join(map(self.parts.__getitem__, parts)) for parts in cut]
        if len(self.parts) > CACHE_SEGMENTS:
            for p in fresh:
                del self.parts[p]
        return out


def _segments(path: str) -> _Segments:
    if path not in _tokenizers:
        _tokenizers[path] = _Segments(path)
    return _tokenizers[path]


def _forget(path: str) -> None:
    """Let go of a tokenizer and its segments, as a task does at its end."""
    _tokenizers.pop(path, None)
    release()


def _groups(texts: list[str], size: int = 2 << 20):
    """Runs of texts of about ``size`` characters."""
    i, held = 0, 0
    for j, t in enumerate(texts):
        held += len(t)
        if held > size:
            yield i, j + 1
            i, held = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def train_dictionary(documents: DataFrame, tokenizer: str, docs: int = SAMPLE_DOCS,
                     ids: int = SAMPLE_IDS, size: int = DICT_BYTES) -> bytes:
    """A shared dictionary from about ``docs`` documents, chosen by a hash of id and text.

    The sample is bounded by twice ``docs`` and by the first ``ids`` ids of each; it has no effect on what
    is stored, only on how small it gets. Empty where the sample is too small to learn from.
    """
    count = documents.count()
    chosen = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) <= F.lit(min(1 << 40, (docs << 40) // max(count, 1)))
    sample = documents.where("text IS NOT NULL").where(chosen).limit(2 * docs).select(
        F.substring("text", 1, 8 * ids).alias("text"))

    def train(batches):
        arrays = []
        for batch in batches:
            arrays += [x[:4 * ids] for x in _segments(tokenizer).encode(batch.column("text").to_pylist())]
        found = b""
        if sum(map(len, arrays)) > 16 * size:
            try:
                found = zstandard.train_dictionary(size, [a for a in arrays if a]).as_bytes()
            except zstandard.ZstdError:
                found = b""
        _forget(tokenizer)
        yield pa.RecordBatch.from_pydict({"dictionary": [found]}, pa.schema([("dictionary", pa.binary())]))

    rows = sample.coalesce(1).mapInArrow(train, "dictionary binary").collect()
    return max((bytes(r.dictionary) for r in rows), key=len, default=b"")


def encode(documents: DataFrame, tokenizer: str, dictionary: bytes, end_id: int = END_ID) -> DataFrame:
    """(doc_id, n, frame): the number of ids with the end id, and the compressed ids."""
    end = np.array([end_id], "<u4").tobytes()

    def compress(batches):
        trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        tool = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
        segments = _segments(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for i, j in _groups(texts):
                raw = [x + end for x in segments.encode(texts[i:j])]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").slice(i, j - i), "n": [len(x) // 4 for x in raw],
                    "frame": [tool.compress(x) for x in raw],
                }, pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("frame", pa.binary())]))
        _forget(tokenizer)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(compress, "doc_id long, n long, frame binary")


_BLOCKS = pa.schema([
    ("part", pa.int32()), ("number", pa.int64()), ("docs", pa.int64()), ("tokens", pa.int64()),
    ("first_id", pa.int64()), ("last_id", pa.int64()), ("ids", pa.list_(pa.int64())),
    ("counts", pa.binary()), ("offsets", pa.binary()), ("block", pa.binary()), ("dict_hash", pa.string())])
_BLOCKS_SQL = ("part int, number long, docs long, tokens long, first_id long, last_id long, ids array<bigint>, "
               "counts binary, offsets binary, block binary, dict_hash string")


def write_blocks(documents: DataFrame, tokenizer: str, end_id: int = END_ID,
                 parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Store all documents in ascending doc_id order; returns the blocks and the dictionary table.

    Null texts are empty documents of the end id alone. Null doc_ids come last; documents with
    equal ids are ordered by their frames, so reruns agree.
    """
    spark = documents.sparkSession
    dictionary = train_dictionary(documents, tokenizer)
    digest = hashlib.sha256(dictionary).hexdigest()
    bounds = range_bounds(documents, order_key(), parts or default_parts(documents) // 4)
    frames = encode(documents, tokenizer, dictionary, end_id).withColumn("_at", order_key())
    frames = frames.withColumn("part", range_number(F.col("_at"), bounds))
    dealt = frames.repartition("part").sortWithinPartitions("part", "_at", "frame").drop("_at")

    def pack(batches):
        held, size, part, number = [], 0, None, 0
        def block():
            sizes = [len(r[2]) for r in held]
            known = [r[0] for r in held if r[0] is not None]
            return pa.RecordBatch.from_pylist([{
                "part": part, "number": number, "docs": len(held), "tokens": sum(r[1] for r in held),
                "first_id": min(known, default=None), "last_id": max(known, default=None),
                "ids": [r[0] for r in held], "counts": np.array([r[1] for r in held], "<u4").tobytes(),
                "offsets": np.cumsum([0, *sizes]).astype("<u8").tobytes(),
                "block": b"".join(r[2] for r in held), "dict_hash": digest}], _BLOCKS)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "n", "frame", "part")]
            for doc_id, n, frame, of in zip(*columns):
                if held and (of != part or size + len(frame) > BLOCK_BYTES):
                    yield block()
                    held, size, number = [], 0, number + 1 if of == part else 0
                part = of
                held.append((doc_id, n, frame))
                size += len(frame)
        if held:
            yield block()

    blocks = materialize(dealt.select("doc_id", "n", "frame", "part").mapInArrow(pack, _BLOCKS_SQL))
    table = spark.createDataFrame([(digest, bytearray(dictionary))], "dict_hash string, dictionary binary")
    return blocks, materialize(table)


def read_blocks(blocks: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """Documents of stored blocks: doc_id, start, n_tokens, ids_crc32, from the files alone.

    ``start`` is the number of ids of all documents before it.
    """
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range here; there are as many ranges as partitions, whatever the data.
    ranges = blocks.groupBy("part").agg(F.sum("tokens").alias("t")).select(
        "part", F.coalesce(F.sum("t").over(order), F.lit(0)).alias("_range"))
    starts = blocks.select("part", "number", F.coalesce(F.sum("tokens").over(inner), F.lit(0)).alias("_inner")) \
        .join(F.broadcast(ranges), "part").select("part", "number", (F.col("_range") + F.col("_inner")).alias("start"))
    found = {r.dict_hash: bytes(r.dictionary) for r in dictionaries.collect()}

    def read(batches):
        tools = {}
        for batch in batches:
            for row in batch.to_pylist():
                key = row["dict_hash"]
                if key not in tools:
                    trained = zstandard.ZstdCompressionDict(found[key]) if found[key] else None
                    tools[key] = zstandard.ZstdDecompressor(dict_data=trained)
                ends = np.frombuffer(row["offsets"], "<u8").tolist()
                view, counts, crcs = memoryview(row["block"]), [], []
                for a, b in zip(ends, ends[1:]):
                    raw = tools[key].decompress(view[a:b])
                    counts.append(len(raw) // 4)
                    crcs.append(zlib.crc32(raw))
                before = row["start"] + np.cumsum([0, *counts[:-1]])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": row["ids"], "start": before, "n_tokens": counts, "ids_crc32": crcs,
                }, pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")]))

    rows = blocks.select("part", "number", "ids", "offsets", "block", "dict_hash").join(starts, ["part", "number"])
    return rows.drop("part", "number").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch(blocks: DataFrame, dictionaries: DataFrame, doc_ids: list[int]) -> DataFrame:
    """Ids of a few documents (doc_id, ids array<bigint>): reads only blocks that can hold them."""
    found = {r.dict_hash: bytes(r.dictionary) for r in dictionaries.collect()}
    wanted = set(doc_ids)
    near = F.lit(False)
    for d in sorted(wanted):
        near = near | ((F.col("first_id") <= d) & (F.col("last_id") >= d))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.frombuffer(row["offsets"], "<u8").tolist()
                trained = zstandard.ZstdCompressionDict(found[row["dict_hash"]]) if found[row["dict_hash"]] else None
                tool = zstandard.ZstdDecompressor(dict_data=trained)
                hits = [i for i, d in enumerate(row["ids"]) if d in wanted]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": [row["ids"][i] for i in hits],
                    "ids": [np.frombuffer(tool.decompress(row["block"][ends[i]:ends[i + 1]]), "<u4").astype("i8")
                            for i in hits]},
                    pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))]))

    return blocks.where(near).select("ids", "offsets", "block", "dict_hash").mapInArrow(
        read, "doc_id long, ids array<bigint>")


def token_table(documents: DataFrame, tokenizer: str, end_id: int = END_ID, parts: int | None = None) -> DataFrame:
    """Write all documents and read them back; see :func:`read_blocks`. An empty table gives no rows."""
    return read_blocks(*write_blocks(documents, tokenizer, end_id, parts))


def default_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
