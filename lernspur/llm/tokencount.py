"""Token counts under a unigram vocabulary, once per shared prefix.

The pre-tokens of a slice of texts are made distinct and read as a trie. Per node, the best score of
any segmentation of its prefix and that segmentation's number of tokens follow from the nodes
above it; the counts at the words' last nodes are stored and summed per document.

The vocabulary is a public file. It ranks its pieces, and a piece of rank r has the Zipf score
-ln(r + 3). A byte that no piece covers is a token of its own, ``BYTE_COST`` below the last rank.
Of equally good segmentations the one with fewer tokens counts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .lattice import Pieces, Trie, distinct_words, sentence_pieces, word_runs

BYTE_COST = 2.0
MOST_WORDS = 200_000  # distinct words in one trie

_loaded: dict[str, tuple] = {}


def scores(ranks: list[int]) -> tuple[np.ndarray, float]:
    values = -np.log(np.array(ranks, float) + 3)
    return values, float(-np.log(len(ranks) + 3) - BYTE_COST)


def _load(path: str):
    if path not in _loaded:
        names, ranks = sentence_pieces(path)
        _loaded[path] = Pieces(names), *scores(ranks)
    return _loaded[path]


def trie_counts(trie: Trie, pieces: Pieces, score: np.ndarray, byte_score: float) -> np.ndarray:
    """Tokens of each word of the trie."""
    best, count = [np.zeros(1)], [np.zeros(1, np.int64)]
    done = 0

    def open_level(d):
        above = trie.levels[d].parent
        best.append(best[d - 1][above] + byte_score)
        count.append(count[d - 1][above] + 1)

    for d, n, node, up, which in trie.matches(pieces):
        while done < d:
            done += 1
            open_level(done)
        total, tokens = best[d - n][up] + score[which], count[d - n][up] + 1
        better = (total > best[d][node]) | ((total == best[d][node]) & (tokens < count[d][node]))
        best[d][node[better]] = total[better]
        count[d][node[better]] = tokens[better]
    while done < len(trie.levels) - 1:
        done += 1
        open_level(done)
    out = np.zeros(len(trie.depth), np.int64)
    for d in range(1, len(trie.levels)):
        own = trie.depth == d
        out[own] = count[d][trie.node[own]]
    return out


def count_one(word: bytes, pieces: Pieces, score, byte_score: float) -> int:
    """The same for a single word of any length."""
    text, best, count = b" " + word, [0.0], [0]
    for d in range(1, len(text) + 1):
        top, tokens = best[d - 1] + byte_score, count[d - 1] + 1
        for n in range(1, min(d, pieces.longest) + 1):
            which = pieces.number.get(text[d - n:d])
            if which is not None:
                total, more = best[d - n] + float(score[which]), count[d - n] + 1
                if total > top or (total == top and more < tokens):
                    top, tokens = total, more
        best.append(top)
        count.append(tokens)
        if d > pieces.longest:
            best[d - pieces.longest - 1] = None  # never looked at again
    return count[-1]


def token_counts(documents: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of every whole text; null and empty texts have none.

    One row per input row, in place: nothing is shuffled.
    """

    def count(batches):
        pieces, score, byte_score = _load(vocabulary)
        for batch in batches:
            words = np.zeros(batch.num_rows, np.int64)
            tokens = np.zeros(batch.num_rows, np.int64)
            for i, j, data, starts, ends, of in word_runs(batch.column("text"), lower=False):
                if not len(starts):
                    continue
                first, kind, long = distinct_words(data, starts, ends)
                per = np.zeros(len(first), np.int64)
                short = np.setdiff1d(np.arange(len(first)), long)
                for k in range(0, len(short), MOST_WORDS):
                    part = short[k:k + MOST_WORDS]
                    at = first[part]
                    per[part] = trie_counts(Trie(data, starts[at], ends[at]), pieces, score, byte_score)
                for k in long:
                    w = data[starts[first[k]]:ends[first[k]]].tobytes()
                    per[k] = count_one(w, pieces, score, byte_score)
                words[i:j] = np.bincount(of, minlength=j - i)
                tokens[i:j] = np.bincount(of, weights=per[kind], minlength=j - i)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "n_pretokens": words, "n_tokens": tokens},
                pa.schema([(n, pa.int64()) for n in ("doc_id", "n_pretokens", "n_tokens")]))

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id long, n_pretokens long, n_tokens long")
