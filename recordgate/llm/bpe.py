"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Blocks of documents are cut into pre-tokens; each block keeps its documents as positions into its
own word list, so a word crosses the network once per block and not once per occurrence. A block
deals its words by hash into packets, which are shuffled; the partition that gets all packets of a
word encodes it once. The ids go back to their block, which puts each document together by
position. Decoding joins the token-byte table (of fixed size: one row per rank) to the ids. Packets
and positions travel compressed.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordgate.llm.common import materialise_by, public_path, small_batches, table, tidy

DEFAULT_RANKS = "byte_bpe_multi_50k.tiktoken"
#: Letters of the Latin blocks, where Python's ``re`` and the Unicode classes of the pattern agree.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile("[\t-\r\x20-\x7eÀ-ɏ]*")
_FAST = re.compile(rf" ?[{_LATIN}]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+")


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all bytes, and start and length of each token."""
    ranks = load_ranks(path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    size = np.array([len(t) for t in tokens], np.int64)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the neighbours of least rank, leftmost first, until none can be merged."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    if n > 64:
        return _encode_long(word, ranks)
    parts = [word[i : i + 1] for i in range(n)]
    get = ranks.get
    pairs = [get(word[i : i + 2], 1 << 30) for i in range(n - 1)]
    while pairs:
        least = min(pairs)
        if least == 1 << 30:
            break
        i = pairs.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], 1 << 30)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], 1 << 30)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges with a heap and linked neighbours: n log n for very long words."""
    n = len(word)
    end, before, after, alive = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    heap = []

    def push(i: int) -> None:
        j = after[i]
        if j < n and (r := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[i], end[j]))

    for i in range(n):
        push(i)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        if not alive[i] or end[i] != mid or after[i] >= n or end[after[i]] != stop:
            continue
        j = after[i]
        alive[j] = False
        end[i], after[i] = stop, after[j]
        if after[i] < n:
            before[after[i]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


# --- packets ------------------------------------------------------------------------------------


def _shrink(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _grow(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)


def _planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers by byte plane, so that small values cost little."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _integers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def _pack_lists(sizes: list[int], payload: bytes) -> bytes:
    """Length-prefixed lists: their number, their sizes, then ``payload``."""
    return _shrink(len(sizes).to_bytes(4, "little") + _planes(np.array(sizes, np.uint32)) + payload)


def _unpack_lists(packed: bytes) -> tuple[np.ndarray, bytes]:
    data = _grow(packed)
    n = int.from_bytes(data[:4], "little")
    return _integers(data[4 : 4 + 4 * n]).astype(np.int64), data[4 + 4 * n :]


def _gather(values: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The lists ``which`` (each at ``start``, of ``size``) one after the other."""
    count = size[which]
    stop = np.cumsum(count)
    if not len(stop):
        return values[:0]
    return values[np.arange(stop[-1]) + np.repeat(start[which] - (stop - count), count)]


def _blocks(pattern: str, block_bytes: int, targets: int):
    import public_tokenizers

    # the fast pattern equals the public one on plain Latin texts, and no other
    common = pattern == public_tokenizers.PATTERN

    def cut(batches):
        slow, seq, part = regex.compile(pattern), 0, TaskContext.get().partitionId()
        for batch in batches:
            lo, texts, ids = 0, batch.column(1), batch.column(0)
            while lo < batch.num_rows:
                hi, size, codes, lengths = lo, 0, [], []
                vocabulary: dict[str, int] = defaultdict()
                vocabulary.default_factory = vocabulary.__len__
                look = vocabulary.__getitem__
                while hi < batch.num_rows and size < block_bytes:
                    text = texts[hi].as_py() or ""
                    plain = common and _PLAIN.fullmatch(text)
                    row = np.fromiter(map(look, _FAST.findall(text) if plain else (m[0] for m in slow.finditer(text))), np.int32)
                    codes.append(row)
                    lengths.append(len(row))
                    size += len(text)
                    hi += 1
                words = [w.encode() for w in vocabulary]
                vocabulary.clear()
                code = np.concatenate(codes)
                # frequent words get small numbers
                order = np.argsort(-np.bincount(code, minlength=len(words)), kind="stable")
                rank = np.empty(len(words), np.uint32)
                rank[order] = np.arange(len(words), dtype=np.uint32)
                words = [words[i] for i in order]
                dealt = np.fromiter((zlib.crc32(w) % targets for w in words), np.uint32, len(words))
                packets = []
                for t in range(targets):
                    mine = [words[i] for i in np.flatnonzero(dealt == t)]
                    packets.append(_pack_lists([len(w) for w in mine], b"".join(mine)) if mine else b"")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([(part << 32) + seq], pa.int64()),
                        pa.array([ids.slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                        pa.array([lengths], pa.list_(pa.int32())),
                        pa.array([_shrink(_planes(rank[code]))], pa.binary()),
                        pa.array([_shrink(_planes(dealt))], pa.binary()),
                        pa.array([packets], pa.list_(pa.binary())),
                    ],
                    ["block", "ids", "lengths", "codes", "dealt", "packets"],
                )
                seq += 1
                lo = hi

    return cut


def _encode(path: str):
    def run(batches):
        ranks, memo = load_ranks(path), {}
        for batch in batches:
            out = []
            for packet in batch.column(2).to_pylist():
                size, data = _unpack_lists(packet)
                stop, counts, ids = np.cumsum(size).tolist(), [], []
                at = 0
                for end in stop:
                    word, at = data[at:end], end
                    if (got := memo.get(word)) is None:
                        if len(memo) >= 200_000:  # forgetting costs a second encoding, never a wrong one
                            memo.clear()
                        got = memo[word] = encode_word(word, ranks)
                    counts.append(len(got))
                    ids += got
                out.append(_pack_lists(counts, _planes(np.array(ids, np.uint32))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["block", "target", "token_ids"])

    return run


def _reassemble(path: str):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        data, data_start, data_size = token_bytes(path)
        packets = dict(zip(right.column("target").to_pylist(), right.column("token_ids").to_pylist(), strict=True))
        docs, ids, decoded = [], [], []
        for block in range(left.num_rows):
            dealt = _integers(_grow(left.column("dealt")[block].as_py()))
            size, start, flat, total = np.zeros(len(dealt), np.int64), np.zeros(len(dealt), np.int64), [np.zeros(0, np.uint32)], 0
            for target, packet in packets.items():
                counts, planes = _unpack_lists(packet)
                mine = np.flatnonzero(dealt == target)
                size[mine] = counts
                start[mine] = total + np.cumsum(counts) - counts
                total += int(counts.sum())
                flat.append(_integers(planes))
            tokens = np.concatenate(flat)
            codes = _integers(_grow(left.column("codes")[block].as_py()))
            stop = 0
            for doc, n in zip(left.column("ids")[block].as_py(), left.column("lengths")[block].as_py(), strict=True):
                mine = _gather(tokens, start, size, codes[stop : stop + n])
                stop += n
                docs.append(doc)
                ids.append(mine.astype("<u4").tobytes())
                decoded.append(_gather(data, data_start, data_size, mine).tobytes())
        return pa.table({"doc_id": pa.array(docs, pa.int64()), "token_ids": pa.array(ids, pa.binary()), "decoded": pa.array(decoded, pa.binary())})

    return run


def bpe_round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str | None = None, pattern: str | None = None, block_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, token_ids (little-endian unsigned 32-bit integers, see ``ids_array``) and decoded (bytes).

    A null or empty text gives no ids and no bytes. Rows with the same id stay separate rows. An
    empty table gives an empty result. Other columns of ``docs`` are not read. Very long texts form
    a block of their own.
    """
    import public_tokenizers

    small_batches(docs.sparkSession)
    path = ranks_path or public_path(DEFAULT_RANKS)
    pattern = pattern or public_tokenizers.PATTERN
    targets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = source.mapInArrow(tidy(_blocks(pattern, block_bytes, targets)), "block long, ids array<long>, lengths array<int>, codes binary, dealt binary, packets array<binary>")
    blocks = materialise_by(cut, "block", targets)
    packets = blocks.select("block", F.posexplode("packets").alias("target", "words")).filter("octet_length(words) > 0")
    encoded = packets.repartitionById(targets, "target").mapInArrow(tidy(_encode(path)), "block long, target int, token_ids binary")
    return (
        blocks.select("block", "ids", "lengths", "codes", "dealt")
        .groupBy("block")
        .cogroup(encoded.groupBy("block"))
        .applyInArrow(_reassemble(path), "doc_id long, token_ids binary, decoded binary")
    )


def ids_array(token_ids: bytes) -> list[int]:
    return np.frombuffer(token_ids, "<u4").tolist()


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded bytes of every document."""
    return bpe_digests(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    return bpe_round_trip(docs).select(
        "doc_id",
        F.expr("cast(octet_length(token_ids) div 4 as long)").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
