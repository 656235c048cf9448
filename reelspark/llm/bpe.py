"""BPE encoding and decoding with a table of distinct words.

Texts are split into the tokenizer's words in Spark. A task turns blocks of rows into word numbers and
lists each block's distinct words. Every distinct word of the corpus is encoded once, in the shard that
its hash names, and its ids are joined back to the words' positions. Decoding joins ids to pieces.

Numbers and lists go through one exchange, by the block or the shard that they are for; both readers use it, so texts
are split once. A block is named by its content; so the input should give the same rows in the same order when
read again, as tables and checkpoints do (a lost task of another input would find no answers and fail rather than
give wrong ids).

Defined cases: a null or empty text has no ids and decodes to the empty text; keys may be null or
repeat, each row gives one row; other columns are not read. Special tokens inside a text are matched as
the tokenizer does. An unknown id has no piece and decodes to nothing; a null id as well.
"""
from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import deal, pack, partitions, plain_values, release, unpack

#: Fixed value: how byte-level tokenizers of this family split a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Words of a block of rows, at least (a row is never split).
BLOCK_WORDS = 1_500_000
#: Ids that are decoded at a time.
DECODE_IDS = 500_000


def _definition(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _tokenizer(definition: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    made = Tokenizer.from_str(definition)
    made.no_truncation()
    made.no_padding()
    return made


def _specials(definition: str) -> list[str]:
    return [x["content"] for x in json.loads(definition)["added_tokens"]]


def words(text: Column, specials: list[str]) -> Column:
    """The tokenizer's words of a text in order; special tokens are words of their own."""
    def split(part: Column) -> Column:
        return F.regexp_extract_all(part, F.lit("(?U)" + SPLIT), F.lit(0))
    if len(specials) != 1:
        raise ValueError("one special token is supported")
    mark = specials[0]
    quoted = "".join("\\" + c if not c.isalnum() else c for c in mark)
    parts = F.transform(F.split(text, quoted), lambda part, i: F.when(i > 0, F.concat(F.array(F.lit(mark)), split(part)))
                        .otherwise(split(part)))
    return F.when(F.instr(text, mark) > 0, F.flatten(parts)).otherwise(split(text))


def encode(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every row, as the tokenizer without added special tokens."""
    definition = _definition(tokenizer_path)
    specials = _specials(definition)
    shards = partitions(docs.sparkSession)
    text_of = F.coalesce(F.col("text"), F.lit(""))
    # The JVM splits; where it may not know a character's class yet, the tokenizer's own splitter does.
    odd = text_of.rlike(r"\p{Cn}")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).select(
        "key", F.when(odd, text_of).alias("text"), F.when(~odd, words(text_of, specials)).alias("words"))

    def split(batch: pa.RecordBatch) -> pa.ListArray:
        raw, listed = batch.column(1), batch.column(2)
        if raw.null_count == len(raw):
            return listed
        tok, out = _tokenizer(definition), listed.to_pylist()
        for i, x in enumerate(raw.to_pylist()):
            if x is not None:
                out[i] = []
                for n, part in enumerate(x.split(specials[0])):
                    out[i] += [specials[0]] * (n > 0)
                    out[i] += [part[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(part)]
        return pa.array(out, pa.list_(pa.string()))

    def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per block of rows: its keys and word numbers under shard -1, and its distinct words by shard; to: whom it is for."""
        for batch in batches:
            every = split(batch)
            ends = np.concatenate([[0], np.cumsum(every.value_lengths().fill_null(0).to_numpy())])
            cuts = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(0, ends[-1], BLOCK_WORDS)), [len(every)]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                part = every.slice(a, b - a)
                coded = part.flatten().cast(pa.binary()).dictionary_encode()
                dealt = deal(coded.dictionary, shards)
                place = pc.index_in(coded.dictionary, value_set=pa.chunked_array(dealt, pa.binary()).combine_chunks())
                whole = pack(keys=batch.column(0).slice(a, b - a), n=part.value_lengths().fill_null(0),
                             places=place.take(coded.indices))
                data = [whole, *(pack(words=x) for x in dealt if len(x))]
                blk = hashlib.blake2b(b"".join(hashlib.blake2b(x).digest() for x in data), digest_size=16).digest()
                asked = [i for i, x in enumerate(dealt) if len(x)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([blk.hex(), *map(str, asked)], pa.string()), pa.array([-1, *asked], pa.int32()),
                    pa.array([blk] * len(data), pa.binary()), pa.array(data, pa.binary())], names=["to", "shard", "blk", "data"])
            del every
            release()

    def encode_words(table: pa.Table) -> pa.Table:
        """Answers of a shard to the blocks that ask it; none to what is for a block."""
        if table.column("shard")[0].as_py() < 0:
            return pa.table({"to": pa.array([], pa.string()), "shard": pa.array([], pa.int32()), "data": pa.array([], pa.binary())})
        tok = _tokenizer(definition)
        asked = [unpack(x)["words"] for x in table.column("data").to_pylist()]
        every = pc.unique(pa.chunked_array(asked, pa.binary()))
        coded = []
        for at in range(0, len(every), 10_000):
            batch = tok.encode_batch(plain_values(every.slice(at, 10_000).cast(pa.string())), add_special_tokens=False)
            coded.append(pa.array([x.ids for x in batch], pa.list_(pa.int32())))
        ids = pa.chunked_array(coded, pa.list_(pa.int32())).combine_chunks()
        answers = []
        for x in asked:
            own = ids.take(pc.index_in(x, value_set=every))
            answers.append(pack(n=own.value_lengths(), ids=own.flatten()))
        del tok, coded, ids, every
        release()
        return pa.table({"to": pa.array([x.hex() for x in table.column("blk").to_pylist()], pa.string()),
                         "shard": table.column("shard"), "data": pa.array(answers, pa.binary())})

    def join_ids(left: pa.Table, right: pa.Table) -> pa.Table:
        """Ids of a block's rows; none for what is for a shard."""
        if left.column("shard")[0].as_py() >= 0:
            return pa.table({"key": pa.array([], key_type), "ids": pa.array([], pa.list_(pa.int32()))})
        answers = [unpack(d) for _, d in sorted(dict(zip(right.column("shard").to_pylist(), right.column("data").to_pylist())).items())]
        length = np.concatenate([a["n"].to_numpy() for a in answers]) if answers else np.zeros(0, np.int64)
        flat = pa.chunked_array([a["ids"] for a in answers], pa.int32()).combine_chunks()
        per_word = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), flat)
        out = []
        for data in left.column("data").to_pylist():                         # equal blocks share a name
            whole = unpack(data)
            places = whole["places"].to_numpy()
            bounds = np.concatenate([[0], np.cumsum(length[places], dtype=np.int64)])
            at = bounds[np.concatenate([[0], np.cumsum(whole["n"].to_numpy(), dtype=np.int64)])]
            ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), per_word.take(whole["places"]).flatten())
            out.append(pa.table({"key": whole["keys"], "ids": ids}))
        release()
        return pa.concat_tables(out)

    listed = rows.mapInArrow(list_words, "to string, shard int, blk binary, data binary")
    table = listed.groupBy("to").applyInArrow(encode_words, "to string, shard int, data binary")
    kind, key_type = rows.schema["key"].dataType.simpleString(), rows.select("key").limit(0).toArrow().schema.field("key").type
    return (listed.groupBy("to").cogroup(table.groupBy("to"))
            .applyInArrow(join_ids, f"key {kind}, ids array<int>").withColumnRenamed("key", key))


def pieces(definition: str) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary; its size bounds the table."""
    spare, plain = 0, {}
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            plain[chr(b)] = b
        else:
            plain[chr(256 + spare)] = b
            spare += 1
    read = json.loads(definition)
    table = {i: bytes(plain[c] for c in s) for s, i in read["model"]["vocab"].items()}
    table |= {x["id"]: x["content"].encode() for x in read["added_tokens"]}
    return [table.get(i, b"") for i in range(max(table) + 1)]


def decode(coded: DataFrame, tokenizer_path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the decoded text to every row: ids joined to the pieces, bytes that are no UTF-8 replaced."""
    definition = _definition(tokenizer_path)
    schema = T.StructType([*coded.schema.fields, T.StructField(to, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.chunked_array([pieces(definition), [b""]], pa.binary()).combine_chunks()
        for whole in batches:
            at = whole.schema.get_field_index(ids)
            ends = np.cumsum(whole.column(at).value_lengths().fill_null(0).to_numpy(), dtype=np.int64)
            cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] + DECODE_IDS, DECODE_IDS))) if len(ends) else []
            for a, b in zip([0, *cuts], [*cuts, len(ends)]):
                batch = whole.slice(a, b - a)
                lists = batch.column(at)
                known = lists.flatten().cast(pa.int64()).fill_null(-1).to_numpy()
                place = np.where((known >= 0) & (known < len(table) - 1), known, len(table) - 1)
                bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), table.take(pa.array(place))), b"")
                out = pa.array([x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, to])
            release()

    return coded.mapInArrow(run, schema)
