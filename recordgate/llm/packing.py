"""Packing of token sequences by shortest-pack-first over the histogram of lengths.

A document is cut into whole sequences and a remainder. The remainders' histogram (one row for each
length below the sequence size, however many documents) is packed on the driver: lengths are placed
longest first, each in the shortest pack that is open, and what is kept are patterns of lengths with
their counts. A pattern's place belongs to a run of ranks among the documents of one length, so the
patterns join back to documents by length and rank; ranks are counted in buckets of rows, so a
frequent length is never one task. Packs that stay short of full are given up: their documents are
laid end to end and cut at every full sequence, the last one at powers of two, which need no padding.

Tokens are those of a byte-level BPE file of the ``tokenizers`` library; a special token's name in a
text is ordinary text. Texts are cut into the
pattern's pieces by byte classes in whole buffers, and every distinct piece is encoded once per chunk.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordgate.llm.bpe import _gather
from recordgate.llm.common import join_by_size, materialise, public_path, small_batches, table, text_chunks, tidy, word_hashes

VOCABULARY = "byte_bpe_50k.json"
#: Length of a sequence, and the padding that a pack may keep (under one hundredth).
SIZE, SLACK = 2048, 16
#: The token that ends a document.
END = 1
CHUNK = 2 << 20
#: Pieces that a worker remembers (some 60 MB); what is forgotten is encoded again.
MEMORY = 300_000

# --- tokens -------------------------------------------------------------------------------------

_OTHER, _LETTER, _DIGIT, _SPACE = range(4)
_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = _LETTER
_CLASS[48:58] = _DIGIT
_CLASS[[*range(9, 14), 28, 29, 30, 31, 32]] = _SPACE
#: Bytes that begin characters whose class the first byte does not tell; their documents are cut by the pattern itself.
_UNCLEAR = np.zeros(256, bool)
_UNCLEAR[[*range(28, 32), 0xC2, *range(0xCA, 256)]] = True
_CONTINUED = np.arange(256) >> 6 == 2


def _byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in such a file: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):
    """Encoder of single pieces: merges are ordered as the file lists them, which is the order of their ids."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte = _byte_characters()
    tokens = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if all(c in byte for c in token)}
    merged = [tokens[b"".join(bytes(byte[c] for c in part) for part in (m.split(" ") if isinstance(m, str) else m))] for m in model["merges"]]
    if merged != sorted(merged):
        raise ValueError(f"{path}: merges are not in the order of their ids")
    made = set(merged)
    ranks = {t: i for t, i in tokens.items() if len(t) == 1 or i in made}
    return tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece, {}


def pieces(buf: np.ndarray, offsets: np.ndarray, pattern) -> np.ndarray:
    """Where the pattern's pieces begin; pieces tile every text.

    Runs of letters, digits, other signs and white space; one blank joins the run that follows it,
    and an apostrophe that begins a piece takes the letters of an English contraction with it.
    """
    n = len(buf)
    kind = _CLASS[buf]
    follows = _CONTINUED[buf]
    # bytes after the first of a character have its class (all clear ones have two bytes)
    kind[1:][follows[1:]] = kind[:-1][follows[1:]]
    new_doc = np.zeros(n + 1, bool)
    new_doc[offsets] = True
    run = np.ones(n, bool)
    run[1:] = kind[1:] != kind[:-1]
    run |= new_doc[:-1]
    space = kind == _SPACE
    # the last of a white space run stands alone, or, if a blank, begins the piece that follows
    last = space.copy()
    last[:-1] &= ~space[1:] & ~new_doc[1:-1]
    last[-1:] = False
    begin = run | last
    joined = np.zeros(n, bool)
    joined[1:] = last[:-1] & (buf[:-1] == 0x20)
    begin &= ~joined | new_doc[:-1]
    quote = np.flatnonzero((buf == 0x27) & begin)
    for at in quote.tolist():
        tail = buf[at + 1 : min(at + 3, int(offsets[np.searchsorted(offsets, at, "right")]))].tobytes()
        length = 2 if tail[:1] in (b"s", b"d", b"m", b"t") else 3 if tail in (b"ll", b"ve", b"re") else 0
        if length:
            begin[at + 1 : at + length] = False
            # what is left of the letters is a piece of its own
            if at + length < n and not new_doc[at + length]:
                begin[at + length] |= kind[at + length] == _LETTER
    strange = _UNCLEAR[buf] | (np.append(buf[1:], 0) == 0x97) & (buf == 0xC3) | (np.append(buf[1:], 0) == 0xB7) & (buf == 0xC3)
    for d in np.unique(np.searchsorted(offsets, np.flatnonzero(strange), "right") - 1).tolist():
        lo, hi = int(offsets[d]), int(offsets[d + 1])
        text = buf[lo:hi].tobytes().decode()
        begin[lo:hi] = False
        begin[lo + np.append(0, np.cumsum([len(m[0].encode()) for m in pattern.finditer(text)]))[:-1]] = True
    return np.flatnonzero(begin)


def _distinct(buf: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct pieces, and which of them each piece is; hashes only propose, bytes decide."""
    _, first, which = np.unique(word_hashes(buf, starts, stops), return_index=True, return_inverse=True)
    size, data = stops - starts, np.append(buf, np.zeros(8, np.uint8))
    like = starts[first][which]
    same = size == size[first][which]
    if same.all():
        wide = np.lib.stride_tricks.as_strided(data, (len(buf) + 1, 8), (1, 1))
        left, at = size.copy(), 0
        open_ = np.arange(len(starts))
        while len(open_):
            a, b = (np.ascontiguousarray(wide[x[open_] + at]).view("<u8")[:, 0] for x in (starts, like))
            mask = np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - np.minimum(left[open_] - at, 8)).astype(np.uint64) << np.uint64(3))
            if ((a ^ b) & mask).any():
                same[0] = False
                break
            at += 8
            open_ = open_[left[open_] > at]
    if same.all():
        return [buf[a:b].tobytes() for a, b in zip(starts[first].tolist(), stops[first].tolist(), strict=True)], which
    number: dict[bytes, int] = {}
    which = np.array([number.setdefault(buf[a:b].tobytes(), len(number)) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], np.int64)
    return list(number), which


def token_chunks(batches, path: str, pattern: str, end: int | None = END):
    """(row places, ids as unsigned 32-bit, first id of each row) of chunks of a text column; ``end`` closes every row."""
    encode, known = _encoder(path, pattern)
    slow = regex.compile(pattern)
    for row, buf, offsets in text_chunks(batches, "row", "text", CHUNK):
        starts = pieces(buf, offsets, slow) if len(buf) else np.zeros(0, np.int64)
        words, which = _distinct(buf, starts, np.append(starts[1:], len(buf))) if len(starts) else ([], starts)
        if len(known) > MEMORY:
            known.clear()
        ids = []
        for w in words:
            if (got := known.get(w)) is None:
                got = encode(w)
                if len(w) <= 32:
                    known[w] = got
            ids.append(got)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for got in ids for i in got), np.uint32, int(size.sum()))
        tokens = _gather(flat, np.cumsum(size) - size, size, which)
        edge = np.append(0, np.cumsum(size[which])) if len(which) else np.zeros(1, np.int64)
        first = edge[np.searchsorted(starts, offsets)]
        if end is not None:
            closed = np.full(len(tokens) + len(row), end, "<u4")
            inner = np.ones(len(closed), bool)
            first = first + np.arange(len(first))
            inner[first[1:] - 1] = False
            closed[inner] = tokens
            tokens = closed
        yield row, tokens.astype("<u4"), first


def _tokenise(path: str, pattern: str, end: int | None):
    def run(batches):
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(1)], ["row", "text"])
            for row, tokens, first in token_chunks([rows], path, pattern, end):
                ids = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer((first * 4).astype(np.int32).tobytes()), pa.py_buffer(tokens.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(at + row), batch.column(0).take(pa.array(row)), pa.array(np.diff(first)), ids], ["row", "doc_id", "n", "ids"])
            at += batch.num_rows

    return run


# --- the plan -----------------------------------------------------------------------------------


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(count, [(length, copies), ...]) of each pattern of packs of at most ``size``.

    Lengths are placed longest first, each into the shortest open pack; a pack is opened where it fits
    into none. All documents of a length are placed at once, as many packs of a pattern at a time.
    """
    open_: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            total = min(open_, default=size)
            if total + length > size:
                many = size // length
                packs, rest = divmod(left, many)
                if packs:
                    open_.setdefault(many * length, []).append((packs, [(length, many)]))
                if rest:
                    open_.setdefault(rest * length, []).append((1, [(length, rest)]))
                break
            count, pack = open_[total].pop()
            if not open_[total]:
                del open_[total]
            taken = min(count, left)
            if taken < count:
                open_.setdefault(total, []).append((count - taken, pack))
            tail = [(length, pack[-1][1] + 1)] if pack[-1][0] == length else [pack[-1], (length, 1)]
            open_.setdefault(total + length, []).append((taken, [*pack[:-1], *tail]))
            left -= taken
    return [x for packs in open_.values() for x in packs]


def powers_of_two(total: int) -> list[int]:
    """The powers of two that make up ``total``, largest first."""
    return [1 << i for i in reversed(range(total.bit_length())) if total >> i & 1]


def plan(histogram: dict[int, int], size: int, slack: int) -> tuple[list[tuple[int, list[tuple[int, int, int]], int, int]], list[int], int, int]:
    """(rows, cuts, first loose sequence, number of sequences).

    rows: length, places (first rank, first sequence, offset) of kept packs, how many documents they
    hold, and where the others begin in the loose stream; cuts: where the loose stream's last, unfilled
    sequence is cut, its begin first.
    """
    places: dict[int, list[tuple[int, int, int]]] = {n: [] for n in histogram}
    used, sequence = dict.fromkeys(histogram, 0), 0
    for count, pack in shortest_pack_first(histogram, size):
        total = sum(n * copies for n, copies in pack)
        if size - total > slack and total & (total - 1):
            continue
        at = 0
        for n, copies in pack:
            for _ in range(copies):
                places[n].append((used[n], sequence, at))
                used[n] += count
                at += n
        sequence += count
    rows, stream = [], 0
    for n in sorted(histogram):
        rows.append((n, places[n], used[n], stream))
        stream += n * (histogram[n] - used[n])
    whole, tail = divmod(stream, size)
    parts = powers_of_two(tail) if size - tail > slack else [tail]
    cuts = (whole * size + np.append(0, np.cumsum(parts))).tolist() if tail else [stream]
    return rows, cuts, sequence, sequence + whole + len(cuts) - 1


def _loose(position: Column, length: Column, size: int, cuts: list[int], sequence: int) -> Column:
    """The parts (from, length, sequence_id, offset) of a document at a position of the loose stream."""
    marks, tail = F.array(*[F.lit(c) for c in cuts]), F.lit(cuts[0])
    stop = position + length
    regular = F.filter(F.array((F.expr("0L") + F.floor(position / size) + 1) * size), lambda x: x < tail)
    inner = F.filter(F.concat(regular, marks), lambda x: (x > position) & (x < stop))
    edges = F.array_sort(F.concat(F.array(position, stop), inner))

    def part(at: Column, i: Column) -> Column:
        before = F.filter(marks, lambda c: c <= at)
        of, begin = F.when(at < tail, F.floor(at / size)).otherwise(F.lit(cuts[0] // size) + F.size(before) - 1), F.when(at < tail, F.floor(at / size) * size).otherwise(F.element_at(before, -1))
        return F.struct((at - position).alias("from"), (F.get(edges, i + 1) - at).alias("length"), (of + sequence).cast("long").alias("sequence_id"), (at - begin).cast("long").alias("offset"))

    return F.transform(F.slice(edges, F.lit(1), F.size(edges) - 1), part)


_PLACES = "length int, places array<struct<first:long,sequence:long,at:long>>, kept long, stream long"


def pack(tokens: DataFrame, size: int = SIZE, slack: int = SLACK) -> DataFrame:
    """row, pieces (start, length, sequence_id, offset) of each row of ``tokens`` (row: a key of its own, n: its number of ids).

    Each id of a row lies in one piece. Sequences hold ``size`` ids, a power of two of them, or at
    most ``slack`` fewer than ``size``. A row without ids has no piece.
    """
    spark = tokens.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = tokens.select("row", F.expr(f"n div {size}").alias("whole"), F.expr(f"cast(n % {size} as int)").alias("rest"), F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int").alias("bucket"))
    counted = materialise(rows.groupBy("bucket", "rest").agg(F.count("*").alias("n"), F.sum("whole").alias("whole")))
    histogram = {r["rest"]: r["n"] for r in counted.filter("rest > 0").groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # fewer rows than ``size``
    places, cuts, loose, sequences = plan(histogram, size, slack)
    before, whole = [], 0
    for b, n in sorted(counted.groupBy("bucket").agg(F.sum("whole")).collect()):  # one row a bucket
        before.append((b, sequences + whole))
        whole += n
    ranks = counted.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranks = materialise(ranks.select((F.col("bucket").cast("long") * size + F.col("rest")).alias("of"), "base"))
    # both windows and the joins are by bucket or by what lies within one
    spread = rows.repartition("bucket").withColumn("rank", F.row_number().over(Window.partitionBy("bucket", "rest").orderBy("row")) - 1)
    earlier = Window.partitionBy("bucket").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    spread = spread.withColumn("earlier", F.coalesce(F.sum("whole").over(earlier), F.lit(0))).withColumn("of", F.col("bucket").cast("long") * size + F.col("rest"))
    spread = join_by_size(spread, ranks, "of").withColumn("rank", F.col("rank") + F.col("base"))
    spread = spread.join(F.broadcast(spark.createDataFrame(before, "bucket int, first long")), "bucket")
    spread = spread.join(F.broadcast(spark.createDataFrame(places, _PLACES).withColumnRenamed("length", "rest")), "rest", "left")
    piece = lambda start, length, sequence, at: F.struct(start.cast("long").alias("start"), length.cast("long").alias("length"), sequence.cast("long").alias("sequence_id"), at.cast("long").alias("offset"))
    full = F.when(F.col("whole") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1), lambda i: piece(i * size, F.lit(size), F.col("first") + F.col("earlier") + i, F.lit(0))))
    mine = F.element_at(F.filter("places", lambda p: p["first"] <= F.col("rank")), -1)
    begin = F.col("whole") * size
    kept = F.array(piece(begin, F.col("rest"), mine["sequence"] + F.col("rank") - mine["first"], mine["at"]))
    parts = F.transform(_loose(F.col("stream") + (F.col("rank") - F.col("kept")) * F.col("rest"), F.col("rest").cast("long"), size, cuts, loose), lambda p: piece(begin + p["from"], p["length"], p["sequence_id"], p["offset"]))
    rest = F.when(F.col("rest") > 0, F.when(F.col("rank") < F.col("kept"), kept).otherwise(parts))
    none = F.array().cast("array<struct<start:long,length:long,sequence_id:long,offset:long>>")
    return spread.select("row", F.concat(F.coalesce(full, none), F.coalesce(rest, none)).alias("pieces"))


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, slack: int = SLACK, path: str | None = None, pattern: str | None = None, end: int | None = END) -> DataFrame:
    """doc_id, start, length, doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit) of every piece.

    A null text is an empty one: its only id is ``end``. Ids of documents are carried as they are, null
    and repeated ones too: each row is a document. An empty table gives no piece. Other columns are not read.
    """
    import public_tokenizers

    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cut = source.mapInArrow(tidy(_tokenise(path or public_path(VOCABULARY), pattern or public_tokenizers.PATTERN, end)), "row long, doc_id long, n long, ids binary")
    tokens = materialise(cut)
    found = tokens.join(pack(tokens.select("row", "n"), size, slack), "row")
    with_ids = F.transform("pieces", lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"), F.col("n").alias("doc_tokens"), p["sequence_id"].alias("sequence_id"), p["offset"].alias("offset"), F.substring("ids", (4 * p["start"] + 1).cast("int"), (4 * p["length"]).cast("int")).alias("ids")))
    return found.select("doc_id", F.inline(with_ids))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document, in sequences of 2048 ids, with a checksum of their ids."""
    found = packed_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
