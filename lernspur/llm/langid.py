"""Language identification by unigram pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. The probability of a
word is the sum over all its segmentations of the product of their pieces, found by a forward
pass; words are read as a trie, so the pass runs once per shared prefix and for all languages at
once. The language with the largest sum of logarithms over a text's words is predicted.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .lattice import DEPTH, Pieces, Trie, distinct_words, sentence_pieces, word_runs

SAMPLE_DOCS = 2_000  # documents per language to learn from, about
SMOOTH = 0.05
MOST_WORDS = 200_000
UNKNOWN = "und"
_SCALE = 32.0  # per byte, so that products stay within floating point

_pieces: dict[str, Pieces] = {}
_letters = re.compile(r"[^\W\d_]")


def _vocabulary(path: str) -> Pieces:
    if path not in _pieces:
        names, _ = sentence_pieces(path)
        single = {bytes([b]) for b in range(256) if b != 0x20}
        # Every byte is a piece, so each word has a segmentation.
        _pieces[path] = Pieces(names + sorted(single - set(names)))
    return _pieces[path]


def learn(documents: DataFrame, vocabulary: str, per_lang: int = SAMPLE_DOCS):
    """(languages, piece probabilities by piece and language) from text and non-null lang.

    Learns from about ``per_lang`` documents of each language, chosen by a hash of the text; the
    pieces are those of the vocabulary's own segmentation. Null texts teach nothing.
    """
    known = documents.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes, key=str.encode)
    if not langs:
        return [], None
    cut = F.create_map(*[x for s in langs for x in (
        F.lit(s), F.lit(min(1 << 20, max(1, -(-(per_lang << 20) // sizes[s])))))])
    sample = known.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.element_at(cut, F.col("lang")))

    def pieces_of(batches):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        own = _vocabulary(vocabulary).number
        rows = {}
        for batch in batches:
            texts = [t.lower() for t in batch.column("text").to_pylist()]
            for lang, ids in zip(batch.column("lang").to_pylist(), model.encode(texts, num_threads=1)):
                into = rows.setdefault(lang, np.zeros(model.get_piece_size(), np.int64))
                np.add.at(into, np.array(ids, np.int64), 1)
        out = {"lang": [], "piece": [], "n": []}
        for lang, counts in rows.items():
            for i in np.flatnonzero(counts).tolist():
                name = (bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
                        else model.id_to_piece(i).replace("▁", " ").encode())
                if name in own:
                    out["lang"].append(lang)
                    out["piece"].append(own[name])
                    out["n"].append(int(counts[i]))
        yield pa.RecordBatch.from_pydict(out, pa.schema(
            [("lang", pa.string()), ("piece", pa.int64()), ("n", pa.int64())]))

    pieces = _vocabulary(vocabulary)
    counts = np.zeros((len(pieces.pieces), len(langs)))
    column = {s: k for k, s in enumerate(langs)}
    for r in sample.mapInArrow(pieces_of, "lang string, piece long, n long") \
            .groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect():
        counts[r.piece, column[r.lang]] = r.n
    return langs, (counts + SMOOTH) / (counts + SMOOTH).sum(axis=0)


def trie_forward(trie: Trie, pieces: Pieces, weights: np.ndarray) -> np.ndarray:
    """ln P(word | language) of each word of the trie; ``weights`` are scaled probabilities."""
    alpha = [np.ones((1, weights.shape[1]))]
    alpha += [np.zeros((len(level.parent), weights.shape[1])) for level in trie.levels[1:]]
    for d, n, node, up, which in trie.matches(pieces):
        alpha[d][node] += alpha[d - n][up] * weights[which]
    out = np.zeros((len(trie.depth), weights.shape[1]))
    for d in range(1, len(trie.levels)):
        own = trie.depth == d
        out[own] = np.log(alpha[d][trie.node[own]]) - d * np.log(_SCALE)
    return out


def forward_one(word: bytes, pieces: Pieces, weights: np.ndarray) -> np.ndarray:
    """The same for a single word of any length."""
    text, shift = b" " + word, np.zeros(weights.shape[1])
    window = [np.ones(weights.shape[1])]  # the last positions, newest last
    for d in range(1, len(text) + 1):
        total = np.zeros(weights.shape[1])
        for n in range(1, min(d, pieces.longest) + 1):
            which = pieces.number.get(text[d - n:d])
            if which is not None:
                total = total + window[-n] * weights[which]
        window.append(total)
        if d % DEPTH == 0:
            top = np.max(window[-pieces.longest:], axis=0)
            window = [w / top for w in window[-pieces.longest:]]
            shift += np.log(top)
        elif len(window) > 4 * pieces.longest:
            window = window[-pieces.longest:]
    return np.log(window[-1]) + shift - len(text) * np.log(_SCALE)


def predict(documents: DataFrame, langs: list[str], probabilities, vocabulary: str) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; ``score`` is the posterior probability.

    ``und`` with score 0 for null texts, texts without letters, or where no language was learned.
    Ties go to the language first in code point order. One row per input row, in place.
    """
    def guess(batches):
        pieces = _vocabulary(vocabulary)
        if langs:
            lengths = np.array([len(p) for p in pieces.pieces])
            weights = probabilities * _SCALE ** lengths[:, None]
        for batch in batches:
            column = batch.column("text")
            total = np.zeros((batch.num_rows, max(1, len(langs))))
            lettered = np.array([t is not None and _letters.search(t) is not None for t in column.to_pylist()], bool)
            for i, j, data, starts, ends, of in word_runs(column, lower=True) if langs else ():
                if not len(starts):
                    continue
                first, kind, long = distinct_words(data, starts, ends)
                per = np.zeros((len(first), len(langs)))
                short = np.setdiff1d(np.arange(len(first)), long)
                for k in range(0, len(short), MOST_WORDS):
                    part = short[k:k + MOST_WORDS]
                    at = first[part]
                    per[part] = trie_forward(Trie(data, starts[at], ends[at]), pieces, weights)
                for k in long:
                    w = data[starts[first[k]]:ends[first[k]]].tobytes()
                    per[k] = forward_one(w, pieces, weights)
                for c in range(len(langs)):
                    total[i:j, c] = np.bincount(of, weights=per[kind, c], minlength=j - i)
            best = total.argmax(axis=1)
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            score = odds[np.arange(len(best)), best] / odds.sum(axis=1)
            known = lettered & bool(langs)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "lang_pred": [langs[b] if k else UNKNOWN for b, k in zip(best, known)],
                "score": np.where(known, score, 0.0)},
                pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]))

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(guess, "doc_id long, lang_pred string, score double")


def identify(documents: DataFrame, vocabulary: str, per_lang: int = SAMPLE_DOCS) -> DataFrame:
    """Learn from three of four folds and predict all: doc_id, held_out, lang_pred, score.

    The fold is crc32 of doc_id as text modulo 4; 2 is held out. A null doc_id counts as empty text.
    """
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4
    langs, probabilities = learn(documents.where(fold != 2), vocabulary, per_lang)
    return predict(documents, langs, probabilities, vocabulary).select(
        "doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")
