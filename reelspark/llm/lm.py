"""LM scoring by an interpolated bigram model in Elias-Fano tries.

Every block of rows lists its distinct words with their training counts; the words' shards add them up
and give every word a number. Then every block lists its distinct word pairs; the shard of a pair's first
word builds a trie from the training counts of all blocks, memory-mapped in the task's own temporary
folder, and answers each block by successor search in the context's range. So neither the vocabulary nor
the tries are ever in one place, both cover the whole training fold, and a hot word or pair costs one
entry per block.

p(w | v) = max(c(v w) - D, 0) / c(v) + D * (followers of v) / c(v) * p(w), or p(w) after an unseen v;
p(w) = (c(w) + 1) / (N + V + 1). Shares and left mass are stored as 16-bit codes, p(w) is exact.

Defined cases: a null or empty text is its end token alone; an empty training fold gives N = V = 0 and every
token p = 1; a null key belongs to the training fold and is not held out; repeated rows count as often as they
stand; other columns are not read.
"""
from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, deal, fold, in_blocks, pack, partitions, unpack
from .trie import Trie, numbers

DISCOUNT = 0.75
#: Number of the context before a text's first token; words count from 2.
START = 1


class _Block:
    """Tokens of a block: codes of its distinct words, rows, and the words dealt to shards."""

    def __init__(self, table: pa.Table, shards: int):
        flat: list[bytes] = []
        lengths = []
        for text in column(table, "text").to_pylist():
            own = text.encode("utf-8", "surrogatepass").lower().split() if text else []
            flat += own
            flat.append(b"")                                                 # the end token
            lengths.append(len(own) + 1)
        coded = pa.array(flat, pa.binary()).dictionary_encode()
        del flat
        self.codes, self.words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        self.row = np.repeat(np.arange(len(lengths)), lengths)
        self.starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        self.train = column(table, "train").to_numpy(zero_copy_only=False).astype(bool)[self.row]
        self.dealt = deal(self.words, shards)
        listed = pa.chunked_array([x for x in self.dealt if len(x)], pa.binary()).combine_chunks()
        self.place = pc.index_in(self.words, value_set=listed).to_numpy()    # of each code in the shards' order

    def counts(self) -> list[np.ndarray]:
        n = np.zeros(len(self.words), np.int64)
        n[self.place] = np.bincount(self.codes[self.train], minlength=len(self.words))
        return np.split(n, np.cumsum([len(x) for x in self.dealt])[:-1])

    def learn(self, answers: dict[int, dict]) -> None:
        """Numbers and counts of the words, in the order of codes."""
        self.ids = np.concatenate([answers[s]["id"].to_numpy() for s in sorted(answers)])[self.place]
        self.count = np.concatenate([answers[s]["n"].to_numpy() for s in sorted(answers)])[self.place]

    def pairs(self, shards: int) -> None:
        """Distinct (context, token) pairs by shard, context and token number; the pair of every token."""
        before = np.concatenate([[-1], self.codes[:-1]])
        before[self.starts] = -1
        size = len(self.words)
        distinct, self.pair = np.unique((before + 1) * size + self.codes, return_inverse=True)
        head, token = distinct // size - 1, distinct % size
        head_id = np.where(head < 0, START, self.ids[np.maximum(head, 0)])
        at = _shard(head_id, shards)
        order = np.lexsort((self.ids[token], head_id, at))
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        self.pair = back[self.pair]
        self.head, self.next = head_id[order], self.ids[token][order]
        self.seen = np.bincount(self.pair[self.train], minlength=len(order))
        self.cuts = np.searchsorted(at[order], np.arange(shards + 1))


def _shard(ids: np.ndarray, shards: int) -> np.ndarray:
    x = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _whole(values: np.ndarray) -> pa.Array:
    """Whole numbers in 32 bits where they fit."""
    return pa.array(values.astype(np.int32) if not len(values) or np.abs(values).max() < 1 << 31 else values)


def _heads(head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.append(True, head[1:] != head[:-1])) if len(head) else np.zeros(0, np.int64)
    return head[first], np.diff(np.append(first, len(head)))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, held_out: int = 2) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    shards = partitions(docs.sparkSession)
    out = F.coalesce(fold("key", folds) == held_out, F.lit(False))
    rows = in_blocks(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("train", ~out))
    answer = "blk int, shard int, kind int, data binary, tokens long, words long"

    def reply(blk: list[int], shard: list[int], kind: int, data: list[bytes], tokens: int = 0, words: int = 0) -> pa.Table:
        n = len(blk)
        return pa.table({"blk": pa.array(blk, pa.int32()), "shard": pa.array(shard, pa.int32()), "kind": pa.array([kind] * n, pa.int32()),
                         "data": pa.array(data, pa.binary()), "tokens": pa.array([tokens] * n, pa.int64()),
                         "words": pa.array([words] * n, pa.int64())})

    def by_kind(table: pa.Table, kind: int) -> dict[int, dict]:
        return {s: unpack(d) for s, k, d in zip(*(table.column(c).to_pylist() for c in ("shard", "kind", "data"))) if k == kind}

    def list_words(table: pa.Table) -> pa.Table:
        block = _Block(table, shards)
        data = [pack(words=w, n=_whole(n)) for w, n in zip(block.dealt, block.counts())]
        blk = table.column("blk")[0].as_py()
        return pa.table({"shard": pa.array(range(shards), pa.int32()), "blk": pa.array([blk] * shards, pa.int32()),
                         "data": pa.array(data, pa.binary())})

    def number_words(table: pa.Table) -> pa.Table:
        shard, asked = table.column("shard")[0].as_py(), [unpack(x) for x in table.column("data").to_pylist()]
        every = pc.unique(pa.chunked_array([x["words"] for x in asked], pa.binary()))
        every = every.take(pc.sort_indices(every))
        places = [pc.index_in(x["words"], value_set=every).to_numpy() if len(every) else np.zeros(0, np.int64) for x in asked]
        total = np.zeros(len(every), np.int64)
        for at, x in zip(places, asked):
            total[at] += x["n"].to_numpy()
        data = [pack(id=_whole(START + 1 + shard + shards * at.astype(np.int64)), n=_whole(total[at])) for at in places]
        return reply(table.column("blk").to_pylist(), [shard] * len(asked), 0, data, int(total.sum()), int((total > 0).sum()))

    def list_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(left, shards)
        block.learn(by_kind(right, 0))
        block.pairs(shards)
        where, data = [], []
        for s, (a, b) in enumerate(zip(block.cuts[:-1], block.cuts[1:])):
            if a < b:
                head, length = _heads(block.head[a:b])
                where.append(s)
                data.append(pack(head=_whole(np.diff(head, prepend=0)), length=_whole(length),
                                 next=_whole(np.diff(block.next[a:b], prepend=0)), n=_whole(block.seen[a:b])))
        return pa.table({"shard": pa.array(where, pa.int32()), "blk": pa.array([left.column("blk")[0].as_py()] * len(where), pa.int32()),
                         "data": pa.array(data, pa.binary())})

    def answer_pairs(table: pa.Table) -> pa.Table:
        shard, asked = table.column("shard")[0].as_py(), []
        for x in table.column("data").to_pylist():
            got = unpack(x)
            asked.append((np.cumsum(got["head"].to_numpy(), dtype=np.int64), got["length"].to_numpy(),
                          np.cumsum(got["next"].to_numpy(), dtype=np.int64), got["n"].to_numpy().astype(np.int64)))
        head = np.concatenate([np.repeat(h, n)[c > 0] for h, n, _, c in asked])
        token = np.concatenate([t[c > 0] for _, _, t, c in asked])
        count = np.concatenate([c[c > 0] for _, _, _, c in asked])
        order = np.lexsort((token, head))
        head, token, count = head[order], token[order], count[order]
        first = np.flatnonzero(np.append(True, (head[1:] != head[:-1]) | (token[1:] != token[:-1]))) if len(head) else np.zeros(0, np.int64)
        count = np.add.reduceat(count, first) if len(first) else count
        with tempfile.TemporaryDirectory() as folder:
            trie, data = Trie(folder, head[first], token[first], count, DISCOUNT), []
            for h, length, t, _ in asked:
                share, left = trie.query(h, length, t)
                data.append(pack(share=pa.array(share), left=pa.array(left), scale=pa.array([*trie.share_scale, *trie.left_scale])))
            del trie
        return reply(table.column("blk").to_pylist(), [shard] * len(asked), 1, data)

    def sum_up(left: pa.Table, right: pa.Table) -> pa.Table:
        block = _Block(left, shards)
        block.learn(by_kind(right, 0))
        block.pairs(shards)
        answers = by_kind(right, 1)
        total_tokens = total_words = 0
        for k, n, v in zip(*(right.column(c).to_pylist() for c in ("kind", "tokens", "words"))):
            if k == 0:
                total_tokens, total_words = total_tokens + n, total_words + v
        share, left_mass = np.zeros(len(block.head)), np.ones(len(block.head))
        for s, (a, b) in enumerate(zip(block.cuts[:-1], block.cuts[1:])):
            if a < b:
                got = answers[s]
                scale = got["scale"].to_numpy()
                share[a:b] = numbers(got["share"].to_numpy(), *scale[:2])
                mass = got["left"].to_numpy()
                left_mass[a:b] = np.repeat(np.where(mass > 0, numbers(mass, *scale[2:]), 1.0), _heads(block.head[a:b])[1])
        alone = (block.count[block.codes] + 1) / (total_tokens + total_words + 1)
        together = share[block.pair] + left_mass[block.pair] * alone
        n = len(left)

        def per_row(values: np.ndarray) -> np.ndarray:
            return np.bincount(block.row, weights=values, minlength=n)
        return pa.table({"key": left.column("key"), "held_out": pc.invert(column(left, "train")),
                         "n_tokens": pa.array(np.bincount(block.row, minlength=n)),
                         "n_known": pa.array(per_row(block.count[block.codes] > 0).astype(np.int64)),
                         "train_tokens": pa.array([total_tokens] * n, pa.int64()),
                         "base_score": pa.array(per_row(np.log10(alone))), "score": pa.array(per_row(np.log10(together)))})

    kind = rows.schema["key"].dataType.simpleString()
    numbered = (rows.groupBy("blk").applyInArrow(list_words, "shard int, blk int, data binary")
                .groupBy("shard").applyInArrow(number_words, answer))
    asked = rows.groupBy("blk").cogroup(numbered.groupBy("blk")).applyInArrow(list_pairs, "shard int, blk int, data binary")
    scored = asked.groupBy("shard").applyInArrow(answer_pairs, answer)
    return (rows.groupBy("blk").cogroup(numbered.unionByName(scored).groupBy("blk")).applyInArrow(
        sum_up, f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
        .withColumnRenamed("key", key))
