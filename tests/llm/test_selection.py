"""Hard negatives, packing and lexical ranking against brute force, with the edge cases that their docstrings state."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordgate.llm import hard_negatives, lexical_scan, mtree, packing
from recordgate.llm.common import public_path

# --- hard negatives -----------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, score string, asked string"


def mined(rows, positives=5, negatives=5):
    """Brute force over (vec_id, vector, label)."""
    ok = sorted({(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, label in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = set()
    for i, label, v in ok:
        if i % 100:
            continue
        others = sorted((-dot(v, w), j, m) for j, m, w in ok if j != i)
        for s, j, _ in [x for x in others if x[2] == label][:positives]:
            near = [(-t, n) for t, n, m in others if m != label and 80 * -s <= 100 * -t <= 100 * -s][:negatives]
            out |= {(i, j, rank, n, -s, t) for rank, (t, n) in enumerate(near, 1)}
    return out


@pytest.mark.parametrize("block", [4096, 2])
def test_hard_negatives_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(hard_negatives, "FIRST", 3)
    rng = random.Random(block)
    centre = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    rows = [(i, [c + rng.gauss(0, 0.6) for c in centre[i % 3]], rng.randint(0, 2)) for i in range(0, 900, 4)]
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(12)]  # ties
    rows += [(2000, None, 1), (2001, [1.0, None, 1, 1, 1, 1], 1), (2002, [math.nan] * 6, 1), (2003, [1.0] * 6, None), (2100, [math.inf] * 6, 0), (None, [1.0] * 6, 1)]
    rows += [(2200, [0.0] * 6, 1), (2300, [2.0], 1), (2301, [2.0, 1.0], 0), (2302, [], 2), (2400, [-3.0] * 6, 2), (2500, [3e5, 1, 2, 3, 4, 5.0], 0), (2501, [-3e5, 1, 2, 3, 4, 5.0], 1), (2502, [2.9e5, 1, 2, 3, 4, 5.0], 1), (2503, [3e5, 1, 2, 3, 4, 5.0], 0)]
    rows += rows[:5]  # repeated rows
    df = spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], label, "x", "y") for i, v, label in rows], VECTORS).repartition(3)
    got = {tuple(r) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, block=block).collect()}
    assert got == mined(rows)
    assert len(got) > 100


def test_hard_negatives_of_nothing_and_of_huge_vectors(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(none, F.col("vec_id") % 100 == 0).count() == 0
    huge = spark.createDataFrame([(100, [3e38], 1, "", ""), (1, [1e30], 1, "", ""), (2, [1.0], 0, "", ""), (200, [1.0], 1, "", "")], VECTORS)
    assert hard_negatives.hard_negatives(huge, F.col("vec_id") % 100 == 0).count() == 0


def test_products_beyond_doubles_are_exact():
    x, a = np.array([[2**30, 3], [2**40, 1], [-(2**40), 0]], np.int64), np.array([[2**30 - 1, 5], [2**20, 7]], np.int64)
    got = hard_negatives.products(x, a, hard_negatives._norms(x), hard_negatives._norms(a))
    want = [[2**30 * (2**30 - 1) + 15, 2**50 + 21], [(1 << 63) - 1, 2**60 + 7], [-(1 << 63), -(2**60)]]
    assert got.tolist() == want


def test_top_k_of_large_short_and_repeated_vectors(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) * 10 ** rng.choice([0, 3, 7]) for _ in range(rng.choice([4, 4, 4, 2]))]) for i in range(300)]
    rows += [(400 + i, rows[1][1]) for i in range(9)] + [(500, [3e8, 1, 2, 3]), (501, [3e8, 1, 2, 4]), (502, [-3e8, 1, 2, 4]), (503, [0, 0, 0, 0]), (520, []), (540, None), (560, [math.nan, 1]), (580, [1e30, 1]), (None, [1.0])]
    df = spark.createDataFrame([(i, v and [float(x) for x in v], 1, "s") for i, v in rows], "vec_id long, embedding array<double>, score int, rank string").repartition(3)
    ok = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if v and i is not None and i not in (560, 580)]
    want = set()
    for i, v in ok:
        if i % 20 == 0:
            best = sorted((-min((1 << 63) - 1, max(-(1 << 63), sum(x * y for x, y in zip(v, w, strict=False)))), j) for j, w in ok if j != i)[:5]
            want |= {(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)}
    assert {tuple(r) for r in mtree.top_k(df, df.filter("vec_id % 20 = 0"), 5, shard=40).collect()} == want
    assert mtree.top_k(df.filter("false"), df, 5).count() == 0


# --- packing ------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, length string, n string"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_path("byte_bpe_50k.json"))


def packed_right(rows, truth: Counter, size: int, slack: int) -> float:
    """Checks pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids); the share of padding."""
    at, spent = defaultdict(int), Counter()
    by_doc = defaultdict(list)
    for r in rows:
        at[r.sequence_id] += r.length
        by_doc[r.doc_id].append(r)
        assert len(r.ids) == 4 * r.length and r.length > 0
    for found in by_doc.values():
        # documents of one id are told apart by their pieces' tiling
        while found:
            ids, want = b"", None
            while want is None or len(ids) < 4 * want:
                r = next(x for x in found if x.start * 4 == len(ids) and (want is None or x.doc_tokens == want))
                found.remove(r)
                ids, want = ids + bytes(r.ids), r.doc_tokens
            spent[r.doc_id, ids] += 1
    assert spent == truth
    for s, used in at.items():
        assert used <= size and (size - used <= slack or not used & (used - 1)), (s, used)
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        stop = 0
        for offset, length in sorted(places):
            assert offset == stop
            stop += length
    return sum(size - used for used in at.values() if used & (used - 1)) / max(1, sum(at.values()))


@pytest.mark.parametrize(("size", "slack"), [(64, 0), (64, 4), (100, 3)])
def test_packing_tiles_documents_and_fills_sequences(spark, tokenizer, size, slack):
    rng = random.Random(size)
    rows = [(i, " ".join(rng.choice(["the", "word", "straße", "x", "123", "don't"]) for _ in range(rng.randint(0, 120)))) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(90)]  # a third has one length
    rows += [(7, "again"), (7, "again"), (None, "lost"), (None, None), (2000, None), (2001, ""), (2002, "long " * 3000)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], DOCS).repartition(5)
    got = packing.packed_documents(df, size=size, slack=slack).collect()
    truth = Counter((i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes()) for i, t in rows)
    share = packed_right([type("P", (), r.asDict()) for r in got], truth, size, slack)
    assert share <= slack / (size - slack)


def test_packing_of_nothing_and_of_one(spark):
    assert packing.packed_documents(spark.createDataFrame([], DOCS)).count() == 0
    one = packing.packed_documents(spark.createDataFrame([(5, None, "", "")], DOCS)).collect()
    assert [(r.doc_id, r.start, r.length, r.doc_tokens, r.offset, bytes(r.ids)) for r in one] == [(5, 0, 1, 1, 0, b"\1\0\0\0")]


def test_shortest_pack_first_places_each_length_as_one_by_one():
    rng = random.Random(5)
    for _ in range(40):
        size = rng.choice([10, 16, 31])
        histogram = {n: rng.randint(1, 9) for n in rng.sample(range(1, size), rng.randint(1, 7))}
        packs: list[list[int]] = []
        for n in sorted(histogram, reverse=True):
            for _ in range(histogram[n]):
                shortest = min(packs, key=sum, default=None)
                if shortest is not None and sum(shortest) + n <= size:
                    shortest.append(n)
                else:
                    packs.append([n])
        found = packing.shortest_pack_first(histogram, size)
        assert sorted(sum(n * c for n, c in p) for count, p in found for _ in range(count)) == sorted(map(sum, packs))
        spent = Counter()
        for count, p in found:
            for n, c in p:
                spent[n] += count * c
        assert spent == histogram


def test_pieces_equal_the_tokenizer(tokenizer):
    import public_tokenizers

    rng = random.Random(1)
    signs = [*"abst rev dlm'  \n\t.,!?0123éüßñ×÷  東京😀\x1c\x00 ªµ", "'s", "'ll", "'re", " '", "''", "  "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["", None, "x" * 5000, " " * 300, "é" * 300, "don't we're 'store ''s ('s it's\n's \t's", " 's", "a 's", "a's", "'sx", "'", "'l", "'ll", "'lla", " ", "  ", "a  ", "\n\n a", "<|endoftext"]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts))), pa.array(texts)], ["row", "text"])
    got = [tokens[a:b].tolist() for _, tokens, first in packing.token_chunks([batch], public_path("byte_bpe_50k.json"), public_tokenizers.PATTERN) for a, b in zip(first, first[1:], strict=False)]
    assert got == [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def test_checksum_is_of_little_endian_ids(spark):
    ids = np.array([1, 70000, 2**32 - 1], "<u4").tobytes()
    assert spark.createDataFrame([(ids,)], "ids binary").select(F.crc32("ids")).first()[0] == zlib.crc32(ids)


# --- lexical ranking ----------------------------------------------------------------------------

TEXTS = "doc_id long, text string, n string, terms string"


def ranked(docs, items, k):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(i, words(t)) for i, t in docs]
    bags = [(i, Counter(w), len(w)) for i, w in bags if w]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    wanted = defaultdict(set)
    for i, t in items:
        if i is not None:
            wanted[i] |= set(words(t))
    out = []
    for item, terms in wanted.items():
        scores = []
        for i, bag, n in bags:
            m = 50 + (50 * n * n_docs) // n_terms
            total = 0
            for t in terms & set(bag):
                df = sum(t in b for _, b, _ in bags)
                total += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
            if total > 0 and i is not None:
                scores.append((-total, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [50_000, 6])
def test_ranking_equals_brute_force(spark, block):
    rng = random.Random(4)
    vocabulary = ["The", "the", "THE", "cat", "caT's", "été", "ÉTÉ", "42", "a", "ab", "abc", "東京", "x_y", "\U0001f600", "don't"]
    docs = [(i, rng.choice(["", " ", "\t"]).join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n"]) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    docs += [(500, docs[2][1]), (2, docs[2][1]), (None, "the cat"), (501, None), (502, ""), (503, "..."), (504, "cat " * 20000), (505, "the")]
    items = [(1, "the cat"), (2, "The THE the abc"), (3, "no such terms"), (4, None), (5, ""), (None, "cat"), (6, "東京 \U0001f600 x_y don't"), (7, "42"), (7, "ab"), (8, " ".join(vocabulary))]
    got = lexical_scan.rank_documents(spark.createDataFrame([(i, t, "x", "y") for i, t in docs], TEXTS).repartition(3), spark.createDataFrame([(i, t) for i, t in items], "item_id long, text string"), k=7, block_terms=block)
    assert sorted(map(tuple, got.collect())) == ranked(docs, items, 7)


def test_ranking_of_nothing(spark):
    none, items = spark.createDataFrame([], TEXTS), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_scan.rank_documents(none, items).count() == 0
    assert lexical_scan.rank_documents(spark.createDataFrame([(1, "a", "", "")], TEXTS), items.limit(0)).count() == 0
