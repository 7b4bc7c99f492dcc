"""Each stage of the corpus pipeline, and the whole, against plain Python on small tables."""

import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from recordgate.llm import toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id long, row int, _text_key string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None, "x", 1, 2, None) for i, t in rows], SCHEMA)


def words(rng, n, kind="w"):
    return " ".join(f"{kind}{rng.randrange(4000)}" for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    rng = random.Random(9)
    item = words(rng, 12, "b")
    toxic = [(1000 + i, words(rng, 30) + (" horrigrump" if i % 6 == 0 else "")) for i in range(240)]
    base = words(rng, 60)
    rows = [
        *toxic,
        (1, base), (2, base + " more"), (None, base), (None, base), (3, words(rng, 40)), (3, words(rng, 40)), (4, "one"), (4, "one"),
        (None, None), (None, None), (5, None), (6, ""), (7, f"{words(rng, 20)} {item.upper()} {words(rng, 5)}"), (None, f"x {item}"), (8, words(rng, 20000)), (9, "mail me@x.org now"),
    ]
    docs(spark, rows).coalesce(2).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    labels = [(i, int("horrigrump" in t)) for i, t in toxic]
    spark.createDataFrame([*labels, (None, 1), (1, None)], "doc_id long, toxic int").write.parquet(f"{at}/labels.parquet")
    return at, rows


def test_drop_toxic(spark, tables):
    at, rows = tables
    got = corpus_pipeline.drop_toxic(spark, docs(spark, rows), at)
    assert got.columns == docs(spark, []).columns
    left = sorted(map(repr, [(r.doc_id, r.text) for r in got.collect()]))
    assert left == sorted(map(repr, [x for x in rows if "horrigrump" not in (x[1] or "")]))


def _shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_keep_one_of_each_group(spark, tables):
    at, rows = tables
    got = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_each_group(spark, docs(spark, rows), at).collect()]
    distinct = list(dict.fromkeys(rows))
    sets = [_shingles(t) for _, t in distinct]
    parent = list(range(len(distinct)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent = [min(parent[i], parent[j]) if p in (parent[i], parent[j]) else p for p in parent]
    assert len(got) == len(set(got)) == len(set(parent))
    assert {parent[distinct.index(x)] for x in got} == set(parent)
    assert (1, rows[240][1]) in got and (None, rows[240][1]) not in got


def test_drop_contaminated(spark, tables):
    at, rows = tables
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_contaminated(spark, docs(spark, rows), at).collect()]
    item = _shingles(spark.read.parquet(f"{at}/benchmark.parquet").filter("item_id = 1").first().text)
    want = [x for x in rows if 100 * len(_shingles(x[1]) & item) < 80 * len(item)]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(want) == len(rows) - 2


def test_sanitise_texts(spark, tables):
    at, rows = tables
    got = corpus_pipeline.sanitise_texts(spark, docs(spark, rows), at)
    assert got.columns == docs(spark, []).columns
    texts = {(r.doc_id, r.text, r.n_chars) for r in got.collect() if r.doc_id in (4, 5, 6, 9)}
    assert texts == {(4, "one", 3), (5, "", 0), (6, "", 0), (9, "mail [EMAIL] now", 16)}


def test_stages_on_empty_tables(spark, tables):
    at, _ = tables
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs(spark, []), at).count() == 0


def test_run(spark, tables):
    at, rows = tables
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers

    from recordgate.llm import bpe
    from recordgate.llm.common import public_path, remove_staged

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_path(bpe.DEFAULT_RANKS)), special_tokens={})
    got = {(r.doc_id, r.decoded_sha256): (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, at).collect()}
    assert remove_staged(spark) > 0
    stayed = docs(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        stayed = stage(spark, stayed, at)
    want = {}
    for r in stayed.collect():
        ids = enc.encode_ordinary(r.text or "")
        want[r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
    assert got == want and len(got) < len(rows)


def test_model_of_the_stage_knows_no_held_out_label(spark, tables):
    at, rows = tables
    sample = toxicity.training_sample(docs(spark, rows), spark.read.parquet(f"{at}/labels.parquet"))
    assert 150 < sample.count() < 230


def test_groups_of_rows_with_columns_that_cannot_be_hashed(spark, tables):
    at, _ = tables
    rows = [(1, "a b c d e f", {"k": 1}), (1, "a b c d e f", {"k": 2}), (2, "x y z u v w", None)]
    found = corpus_pipeline.keep_one_of_each_group(spark, spark.createDataFrame(rows, "doc_id long, text string, extra map<string,int>"), at)
    assert sorted(r.doc_id for r in found.collect()) == [1, 2]
