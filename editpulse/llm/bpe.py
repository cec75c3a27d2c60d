"""Byte-level BPE encoding and decoding by a global distinct-word shuffle
(operator 5).

A text splits before blanks and line ends that follow a visible character;
no match of the split pattern crosses such a place, so each of the *words*
between them has the same ids wherever it stands.  A chunk of texts becomes
its distinct words and, for every text, the numbers of its words in order
(their positions).  The words are shuffled once by hash, each distinct word of the
corpus is encoded once, and its ids go back to the chunks that hold it, where
the texts are put together by position.  Decoding joins every id of a text, in
order, with the token-byte table (one row an id, so of fixed size), which is
broadcast; ``decode`` is the same join for any table with arrays of ids.

Only distinct words travel, not every occurrence: positions stay beside their
chunk in a bucketed table.  A chunk's words are numbered by falling frequency;
the positions also say which bucket each number went to, so that neither the
words nor their ids carry numbers.

Defined results: null text: empty, no ids; null and repeated ``doc_id``: a row
for each row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import uuid

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import public_tokenizers
from editpulse.llm import common as C
from editpulse.session import scratch_dir

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Text bytes whose distinct words are gathered into one chunk.
CHUNK_BYTES = 24 << 20
#: Words of texts that are put together at once.
TEXT_WORDS = 1 << 19
#: Zstandard's level for what is stored or travels.
LEVEL = 9


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def ranks_of_json(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level vocabulary in a tokenizer's JSON,
    which writes each byte as a visible character: itself if it is one, else
    the next unused one from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(other)}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {t["content"] for t in model.get("added_tokens", ())}
    return {bytes(map(byte_of.__getitem__, t)): i for t, i in model["model"]["vocab"].items() if t not in special}


@functools.cache
def added_tokens(path: str) -> dict[str, int]:
    """Tokens that a JSON vocabulary reads as one id wherever they stand in a text."""
    if not path.endswith(".json"):
        return {}
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f).get("added_tokens", ())}


@functools.cache
def encoder(path: str, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    ranks = ranks_of_json(path) if path.endswith(".json") else read_ranks(path)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """Words of concatenated texts and the index of each text's first one.

    A cut lies before a blank or line end that follows ``!`` to ``~`` or a
    longer character, unless that may be white space itself (those begin with
    C2, E1, E2 or E3)."""
    before = np.concatenate([np.zeros(3, np.uint8), data])
    last, second, third = before[2:-1], before[1:-2], before[:-3]
    cut = ((data == 32) | (data == 10)) & (last >= 0x21) & (last != 0x7F)
    cut &= (last < 0x80) | ((second != 0xC2) & ((third < 0xE1) | (third > 0xE3)))
    cut[offsets[offsets < len(data)]] = True
    edges = np.append(np.flatnonzero(cut), len(data)) if len(data) else np.zeros(1, np.int64)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return found, np.searchsorted(edges, offsets)


def encoded(enc: tiktoken.Encoding, distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after another, and how many each has."""
    encode = enc.encode_ordinary
    ids = [encode(w.decode(errors="replace")) for w in distinct]
    counts = np.fromiter(map(len, ids), np.int32, len(ids))
    return np.fromiter((i for x in ids for i in x), np.int32, int(counts.sum())), counts


def _planes(numbers: np.ndarray) -> np.ndarray:
    """The first bytes of all numbers, then the second ones, and so on: the upper
    ones, nearly all alike, compress to little."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).ravel()


def _small(*arrays: np.ndarray) -> bytes:
    return zstandard.compress(C.pack(*arrays), LEVEL)


def _arrays(blob: bytes) -> list[np.ndarray]:
    return C.unpack(zstandard.decompress(blob))


def _split(n_buckets: int, chunk_bytes: int):
    """Chunks: the positions (bucket -1) and the distinct words by bucket."""
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("blob", pa.binary())])

    def chunk_rows(number, ids, data, offsets):
        found, first = words(data, offsets)
        coded = found.dictionary_encode()
        which, distinct = coded.indices.to_numpy(), coded.dictionary
        common = np.argsort(-np.bincount(which, minlength=len(distinct)), kind="stable")
        rank = np.empty(len(common), np.int64)
        rank[common] = np.arange(len(common))
        distinct = distinct.take(pa.array(common))
        data, offsets = C.buffers(distinct)
        bucket = (C.word_hashes(data, offsets[:-1], offsets[1:]) % C.U(n_buckets)).astype(np.int32) if len(distinct) else np.zeros(0, np.int32)
        yield number, -1, _small(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), np.diff(first).astype(np.int32),
                                 _planes(rank[which]), C.narrow(bucket))
        order, edges = _by_bucket(bucket, n_buckets)
        moved = distinct.take(pa.array(order))
        for b in np.flatnonzero(np.diff(edges)):
            own, off = C.buffers(moved.slice(edges[b], edges[b + 1] - edges[b]))
            yield number, int(b), _small(C.narrow(np.diff(off)), own)

    def split(batches):
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = C.buffers(batch["text"])
            for i, j in C.slices(offsets, chunk_bytes):
                own = chunk_rows((task << 32) + number, batch["doc_id"].slice(i, j - i), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                yield C.table(schema, *zip(*own))
                number += 1

    return split


def _by_bucket(bucket: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of words ordered by bucket, and where each bucket begins."""
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(n_buckets + 1))


def _encode_distinct(path: str, pattern: str):
    """Each distinct word of a bucket once; its ids for every chunk that has it."""
    schema = pa.schema([("chunk", pa.int64()), ("blob", pa.binary())])

    def encode(batches):
        enc = encoder(path, pattern)
        for bucket, rows in C.by_key(batches):
            parts = [_arrays(r["blob"]) for r in rows]
            lengths = np.concatenate([p[0].astype(np.int64) for p in parts])
            offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            data = np.concatenate([p[1] for p in parts])
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
            ids, counts = encoded(enc, coded.dictionary.to_pylist())
            first = np.cumsum(counts, dtype=np.int64) - counts
            which, at = coded.indices.to_numpy(), 0
            for r, (sizes, _) in zip(rows, parts):
                own = which[at:at + len(sizes)]
                at += len(sizes)
                yield C.table(schema, [r["chunk"]], [_small(np.array([bucket], np.int32), C.narrow(counts[own]), C.narrow(ids[C.ranges(first[own], counts[own])]))])

    return encode


def token_table(path: str) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """The token-byte table in the order of its ids: ids, bytes."""
    ranks = ranks_of_json(path) if path.endswith(".json") else read_ranks(path)
    rows = sorted((i, b) for b, i in ranks.items())
    return np.array([i for i, _ in rows], np.int64), pa.array([b for _, b in rows], pa.large_binary())


def _assemble(tokens, n_buckets: int, with_ids: bool):
    """Texts put together by position; their ids join ``tokens``, the broadcast
    token-byte table, which also gives each id's decimal digits."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
                       + [("ids", pa.list_(pa.int32())), ("decoded", pa.binary())] * with_ids)

    def assemble(batches):
        token_ids, token_bytes = tokens.value
        digits = pa.array([b"%d," % i for i in token_ids.tolist()], pa.large_binary())
        for batch in batches:
            for positions, answers in zip(batch["blob"], batch["answers"]):
                doc_ids, null, lens, planes, bucket = _arrays(positions.as_py())
                which = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()
                counts, rows, ids = _ids_by_number(bucket, n_buckets, [_arrays(a) for a in answers.as_py() or ()])
                row = np.searchsorted(token_ids, ids)
                if len(ids) and (row.max() == len(token_ids) or (token_ids[row] != ids).any()):
                    raise ValueError("an id is not in the token-byte table")
                first = np.concatenate([[0], np.cumsum(lens, dtype=np.int64)])
                for i, j in C.slices(first, TEXT_WORDS):
                    own = which[first[i]:first[j]]
                    at = C.ranges(rows[own], counts[own])
                    size = np.concatenate([[0], np.cumsum(counts[own], dtype=np.int64)])[first[i:j + 1] - first[i]]
                    taken = pa.array(row[at])
                    text, text_end = _bytes_of(digits, taken, size)
                    decoded, end = _bytes_of(token_bytes, taken, size)
                    columns = [pa.array(doc_ids[i:j], pa.int64(), mask=null[i:j]), np.diff(size),
                               [hashlib.sha256(text[a:max(a, b - 1)]).hexdigest() for a, b in zip(text_end, text_end[1:])],
                               [hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(end, end[1:])]]
                    if with_ids:
                        columns += [pa.ListArray.from_arrays(pa.array(size, pa.int32()), pa.array(ids[at], pa.int32())),
                                    [bytes(decoded[a:b]) for a, b in zip(end, end[1:])]]
                    yield C.table(schema, *columns)

    return assemble


def _ids_by_number(bucket: np.ndarray, n_buckets: int, answers: list[list[np.ndarray]]):
    """How many ids each of a chunk's words has, where they begin, and all ids."""
    order, edges = _by_bucket(bucket, n_buckets)
    counts, begin = np.zeros(len(bucket), np.int64), np.zeros(len(bucket), np.int64)
    all_ids, at = [np.zeros(0, np.int64)], 0
    for (b,), count, ids in answers:
        own = order[edges[b]:edges[b + 1]]
        counts[own] = count
        begin[own] = at + np.cumsum(count, dtype=np.int64) - count
        all_ids.append(ids.astype(np.int64))
        at += len(ids)
    return counts, begin, np.concatenate(all_ids)


def _bytes_of(table: pa.LargeBinaryArray, rows: pa.Array, size: np.ndarray) -> tuple[memoryview, list[int]]:
    """Bytes of the table's rows, one after another, and where each text begins in them."""
    data, offsets = C.buffers(table.take(rows))
    return memoryview(data), offsets[size].tolist()


def encode_documents(docs: DataFrame, ranks_path: str | None = None, pattern: str = public_tokenizers.PATTERN,
                     with_ids: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document ``doc_id, n_tokens, ids_sha256`` (of decimal ids joined by
    commas), ``decoded_sha256`` (of the bytes decoded from them) and, with
    ``with_ids``, ``ids`` and ``decoded`` themselves."""
    spark, path = docs.sparkSession, ranks_path or public_tokenizers.path(RANKS)
    n = C.partitions(spark)
    chunks = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _split(n, chunk_bytes), "chunk bigint, bucket int, blob binary")
    name, place = f"bpe_chunks_{uuid.uuid4().hex}", scratch_dir(spark, "bpe-chunks")
    (chunks.withColumn("is_words", F.col("bucket") >= 0).write.partitionBy("is_words").bucketBy(n, "chunk")
     .option("compression", "zstd").option("path", place).saveAsTable(name))
    table = spark.table(name)
    tokens = spark.sparkContext.broadcast(token_table(path))
    answers = table.where("is_words").select("chunk", "bucket", "blob").repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _encode_distinct(path, pattern), "chunk bigint, blob binary")
    answers = answers.groupBy("chunk").agg(F.collect_list("blob").alias("answers"))
    both = table.where("not is_words").select("chunk", "blob").join(answers, "chunk", "left").select("blob", "answers")
    return both.mapInArrow(_assemble(tokens, n, with_ids), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
                           + ", ids array<int>, decoded binary" * with_ids)


def token_bytes(spark, ranks_path: str | None = None) -> DataFrame:
    """The token-byte table: ``token_id, bytes``."""
    ids, data = token_table(ranks_path or public_tokenizers.path(RANKS))
    return spark.createDataFrame(list(zip(ids.tolist(), data.to_pylist())), "token_id int, bytes binary")


def decode(rows: DataFrame, key: str, ids: str = "ids", ranks_path: str | None = None) -> DataFrame:
    """``key, decoded`` (binary) of every row's array of ids: the ids, exploded
    with their positions, join the token-byte table (broadcast: one row an id
    of the vocabulary), and are put together by position.  A null array or one
    with an unknown id gives null, an empty one no bytes."""
    table = F.broadcast(token_bytes(rows.sparkSession, ranks_path))
    exploded = rows.select(F.col(key), F.monotonically_increasing_id().alias("row"), F.col(ids).alias("ids"))
    exploded = exploded.select(key, "row", F.posexplode_outer("ids").alias("pos", "token_id"), F.size("ids").alias("n"))
    parts = exploded.join(table, "token_id", "left").groupBy("row").agg(
        F.first(key).alias(key), F.first("n").alias("n"), F.count("bytes").alias("known"),
        F.array_sort(F.collect_list(F.when(F.col("bytes").isNotNull(), F.struct("pos", F.hex("bytes").alias("x"))))).alias("parts"))
    whole = F.unhex(F.array_join(F.transform("parts", lambda p: p["x"]), ""))
    return parts.select(key, F.when((F.col("n") >= 0) & (F.col("known") == F.col("n")), whole).alias("decoded"))


def op5_bpe(spark, sf_dir: str) -> DataFrame:
    return encode_documents(C.read(spark, sf_dir, "documents"), with_ids=False)
