"""Byte-level BPE encoding and decoding by ranked merges over distinct words.

Documents are encoded where they are read: a task splits its texts into words (matches of the splitting pattern), folds the ranked
merges over the bytes of each word it has not met, and joins the ids of the words by position. The table of ranks is broadcast;
its size is that of a tokenizer's vocabulary, whatever the corpus. No text or word is shuffled. Decoding concatenates the tokens' bytes.

Words met before are remembered by the Python worker, up to `REMEMBERED` of them; then it starts anew. That bounds memory and
changes no result.

Defined cases: null and empty texts have no ids; special tokens do not exist, their strings are ordinary text; a byte that is no
token is refused when the ranks are read; rows may repeat; further columns are ignored; empty input gives no rows.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices

REMEMBERED = 1 << 19
SHORT = 64  # bytes up to which looking at every pair is cheaper than a heap
_remembered: dict[str, dict[str, tuple[str, int, bytes]]] = {}


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token ranks of a file with one base64 token and its rank per line, read on the driver and broadcast by its callers."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lacking = [b for b in range(256) if bytes([b]) not in ranks]
    if lacking:
        raise ValueError(f"ranks lack the bytes {lacking[:5]}")
    return ranks


def encode_word(ranks: dict[bytes, int], word: bytes) -> list[int]:
    """Ids of one word: the leftmost pair of least rank is joined until no pair of neighbours is a token."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > SHORT:
        return encode_long_word(ranks, word)
    none = 1 << 62
    parts = [word[i:i + 1] for i in range(len(word))]
    pair = [ranks.get(word[i:i + 2], none) for i in range(len(word) - 1)]
    while pair:
        least = min(pair)
        if least == none:
            break
        at = pair.index(least)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del pair[at]
        if at:
            pair[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
        if at < len(pair):
            pair[at] = ranks.get(parts[at] + parts[at + 1], none)
    return [ranks[p] for p in parts]


def encode_long_word(ranks: dict[bytes, int], word: bytes) -> list[int]:
    """The same with a heap of pairs; time grows as n log n with the bytes of a word."""
    n = len(word)
    stop = list(range(1, n + 1))  # where the part that starts here ends; 0 once it has joined the part before it
    before = list(range(-1, n))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)

    def offer(start: int) -> None:
        middle = stop[start]
        if middle < n and (rank := ranks.get(word[start:stop[middle]])) is not None:
            heapq.heappush(heap, (rank, start, stop[middle]))

    while heap:
        _, start, end = heapq.heappop(heap)
        middle = stop[start]
        # an entry counts only while both of its parts are as they were
        if not middle or middle >= n or stop[middle] != end:
            continue
        stop[start], stop[middle] = end, 0
        before[end] = start
        offer(start)
        if start:
            offer(before[start])
    out, at = [], 0
    while at < n:
        out.append(ranks[word[at:stop[at]]])
        at = stop[at]
    return out


def coder(ranks, pattern: str, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (doc_id, text) as (doc_id, ids, n_tokens, decoded); `ranks` is a broadcast table, `key` names it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        tokens = {rank: token for token, rank in table.items()}
        find = regex.compile(pattern).findall
        known = _remembered.setdefault(key, {})

        def coded(word: str) -> tuple[str, int, bytes]:
            if len(known) >= REMEMBERED:
                known.clear()
            ids = encode_word(table, word.encode())
            known[word] = out = ",".join(map(str, ids)), len(ids), b"".join([tokens[i] for i in ids])
            return out

        for batch in batches:
            for part in slices(batch, "text"):
                ids, counts, decoded = [], [], []
                for text in part.column("text").to_pylist():
                    words = [known.get(w) or coded(w) for w in find(text or "")]
                    ids.append(",".join([w[0] for w in words]))
                    counts.append(sum([w[1] for w in words]))
                    decoded.append(b"".join([w[2] for w in words]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(ids, pa.string()), pa.array(counts, pa.int64()), pa.array(decoded, pa.binary())],
                    ["doc_id", "ids", "n_tokens", "decoded"])

    return run


def encode_documents(spark: SparkSession, docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, ids as decimal text joined by commas, n_tokens, and the bytes the ids decode to."""
    ranks = spark.sparkContext.broadcast(read_ranks(spark, path))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        coder(ranks, pattern, f"{path}\n{pattern}"), "doc_id long, ids string, n_tokens long, decoded binary")


def token_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.col("n_tokens").cast("long"), F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded bytes of every document by the ranks of a public tokenizer."""
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return token_digests(encode_documents(
        spark, docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN))
