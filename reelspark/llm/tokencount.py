"""Token counts of a unigram tokenizer by count-only Viterbi.

An Aho-Corasick automaton over the vocabulary enumerates the pieces that end at each place of a word;
dynamic programming carries the best score and its number of pieces, never the pieces themselves. Ties
fall as in the tokenizer: of equal scores the earlier start stays. A word's count does not depend on its
neighbours, so a bounded cache per task keeps counts of frequent words.

Vocabulary and scores come from a public piece model; unknown characters count one token per UTF-8 byte
(byte fallback). Blanks become word marks, one before every word, as the usual splitter does.

Defined cases: a null or empty text has 0 tokens; keys may be null or repeat; other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The word mark, and how far below the lowest score an unknown character lies.
MARK, UNKNOWN_PENALTY = "▁", 10.0
#: Words that a task's cache may hold before it is emptied.
CACHE_WORDS = 1_000_000


def vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a piece model, in the order of their ids."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]], unknown_id: int = 0):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for i, (piece, score) in enumerate(pieces):
            if piece:
                self.automaton.add_word(piece, (len(piece), score, i != unknown_id))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.cache: dict[str, int] = {}

    def word(self, word: str) -> int:
        ends: list[list[tuple[int, float, bool]]] = [[] for _ in word]
        for at, match in self.automaton.iter(word):
            ends[at].append(match)
        best, count, run = [0.0], [0], [-1]      # run: where the unknown stretch that ends here began, or -1
        for at, matches in enumerate(ends):
            top, chosen, single = None, None, False
            for length, score, known in sorted(matches, reverse=True):          # earlier starts first
                single |= length == 1
                start = at + 1 - length
                value = score + best[start]
                if top is None or value > top:
                    top, chosen = value, (start, known)
            if not single:
                value = self.unknown + best[at]
                if top is None or value > top:
                    top, chosen = value, (at, False)
            start, known = chosen
            best.append(top)
            if known:
                count.append(self._closed(word, start, count, run) + 1)
                run.append(-1)
            else:
                count.append(count[start])
                run.append(run[start] if run[start] >= 0 else start)
        return self._closed(word, len(word), count, run)

    def _closed(self, word: str, at: int, count: list[int], run: list[int]) -> int:
        """Tokens up to a place; neighbouring unknowns fuse and are one piece or else their bytes."""
        if run[at] < 0:
            return count[at]
        fused = word[run[at]:at]
        return count[at] + (1 if fused in self.automaton else len(fused.encode("utf-8", "surrogatepass")))

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        marked = marked if marked[0] == MARK else MARK + marked
        total, cache = 0, self.cache
        for rest in marked.split(MARK)[1:]:
            n = cache.get(rest)
            if n is None:
                n = self.word(MARK + rest)
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                if len(rest) <= 64:
                    cache[rest] = n
            total += n
        return total


def count(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens long) of every row."""
    pieces = vocabulary(model_path)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pieces)
        for batch in batches:
            counts = [counter.text(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["key", "n_tokens"])

    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind}, n_tokens long").withColumnRenamed("key", key))
