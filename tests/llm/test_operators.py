"""Edge cases and brute-force comparisons of the corpus operators."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from recordgate.llm import archives, bpe, common, decontaminate, html_extract, jaccard_join, mtree, pii, substring_bytes, substring_words, toxicity
from recordgate.llm.common import public_path

DOC = "doc_id long, text string, extra string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], DOC)


EDGE = [(-1, None), (-2, ""), (7, "one two"), (7, "one two"), (None, "lost"), (8, "é" * 300)]


def test_empty_tables(spark):
    none = docs(spark, [])
    assert substring_words.remove_repeated_windows(none).count() == 0
    assert substring_bytes.remove_repeated_strings(none).count() == 0
    assert jaccard_join.jaccard_components(none).count() == 0
    assert bpe.bpe_round_trip(none).count() == 0
    assert pii.sanitise(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(none, items).count() == 0


def test_word_windows(spark):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [*EDGE, (1, long), (2, "a " + long), (3, "b " + long[10:])]
    got = {r.doc_id: r for r in substring_words.remove_repeated_windows(docs(spark, rows)).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[2].kept) == (0, 80, "a")
    assert got[3].n_removed == len(long[10:].split()) - (0 if long[10] == "w" else 1)
    assert (got[-1].n_words, got[None].kept, got[7].n_removed) == (0, "lost", 0)


@pytest.mark.parametrize("hot", [4096, 2])
def test_byte_strings(spark, hot):
    rng = random.Random(3)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(260))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 150))) + shared[rng.randint(0, 80) : rng.randint(150, 260)] + str(i) * 5) for i in range(25)]
    rows += [(40, "x" * 330), (41, None)]
    seen, want = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(b[k : k + 100])
        want[i] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(x for x, g in zip(b, gone, strict=True) if not g))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in substring_bytes.remove_repeated_strings(docs(spark, [*rows, rows[0]]), hot=hot).collect()}
    assert got == want


@pytest.mark.parametrize("leaf", [4096, 10])
def test_jaccard_components(spark, leaf):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        w = [f"w{k}" for k in range(60)]
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(60)] = f"z{rng.randrange(500)}"
        rows.append((i, " ".join(w[: rng.randint(50, 60)])))
    rows += [(100 + i, " ".join(f"q{rng.randrange(3)}" for _ in range(rng.randint(0, 14)))) for i in range(60)]
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs(spark, rows), leaf=leaf).collect()}
    assert got == {i: (len(s), root(i)) for i, s in sets.items()}


def _near_equidistant(n, share, size=200, seed=4):
    """``n`` unlinked sets, each pair of similarity about ``share``."""
    rng = np.random.default_rng(seed)
    base, keep = rng.integers(1, 2**62, size, dtype=np.uint64), int(size * 2 * share / (1 + share))
    return [np.sort(np.concatenate([base[:keep], rng.integers(1, 2**62, size - keep, dtype=np.uint64)])).tobytes() for _ in range(n)]


@pytest.mark.parametrize("share", [0.4, 0.55, 0.7])
@pytest.mark.parametrize("n", [20, 46, 90, 300, 1000])
def test_metric_join_never_compares_more_than_all_pairs(n, share):
    label, compared = jaccard_join.join_region(_near_equidistant(n, share))
    assert (label == np.arange(n)).all()
    assert compared <= n * (n - 1) // 2 + 2 * jaccard_join.PIVOTS * n
    label, compared = jaccard_join.join_region(_near_equidistant(n, share), leaf=8)
    assert (label == np.arange(n)).all()
    assert compared <= n * (n - 1) // 2 + 2 * jaccard_join.PIVOTS * n


@pytest.mark.parametrize("leaf", [2, 8, 128])
def test_metric_join_equals_brute_force(leaf):
    rng = np.random.default_rng(8)
    sets = []
    for _ in range(8):
        base = rng.integers(1, 2**62, 60, dtype=np.uint64)
        for _ in range(40):
            own = np.concatenate([base[rng.random(60) < rng.choice([0.8, 0.93, 1.0])], rng.integers(1, 2**62, int(rng.integers(0, 12)), dtype=np.uint64)])
            sets.append(np.unique(own))
    label = jaccard_join.metric_components([s.tobytes() for s in sets], leaf=leaf)
    parent = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((parent[i], parent[j]))
                parent = [a if x == b else x for x in parent]
    assert label.tolist() == parent


def _thue_morse(n=10):
    word = "a"
    for _ in range(n):
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_thue_morse_words_are_unlike(spark):
    """Two words that collide under any polynomial hash modulo 2**64."""
    one, other = _thue_morse()
    tail = " ".join(f"t{i}" for i in range(59))
    rows = [(1, f"{one} {tail}"), (2, f"{other} {tail}"), (3, " ".join([one] * 8)), (4, " ".join([other] * 8))]
    got = {r.doc_id: r.n_removed for r in substring_words.remove_repeated_windows(docs(spark, rows)).collect()}
    assert got == {1: 0, 2: 59, 3: 0, 4: 0}
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs(spark, rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    words = np.frombuffer(f"{one} {other}".encode(), np.uint8)
    starts, stops, _ = common.words(words, np.array([0, len(words)]))
    assert len(set(common.word_hashes(words, starts, stops).tolist())) == 2


def test_contamination(spark):
    items = spark.createDataFrame([(1, "A b c d e f g"), (2, None), (3, "x y")], "item_id long, text string")
    got = decontaminate.contaminated(docs(spark, [*EDGE, (9, "zz a B c d e f g zz"), (10, "a b c d e q f g")]), items).collect()
    assert [(r.doc_id, r.item_id, r.containment) for r in got] == [(9, 1, 1.0)]


def test_bpe(spark):
    tiktoken = pytest.importorskip("tiktoken")
    import public_tokenizers

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(public_path(bpe.DEFAULT_RANKS)), special_tokens={})
    rows = [*EDGE, (11, "don't ½ x² 日本語  \t\n end " + "a" * 500), (12, "\x1c\x85 odd _ spaces here")]
    got = {(r.doc_id, bytes(r.decoded)): bpe.ids_array(r.token_ids) for r in bpe.bpe_round_trip(docs(spark, rows)).collect()}
    assert got == {(i, (t or "").encode()): enc.encode_ordinary(t or "") for i, t in rows}


def test_pii(spark):
    rows = [(1, "note for boss@corp.com about zulutango matters"), (2, "We met zulutango who is boss@corp.com today"), (3, "the zulutango of old"), (4, "1.2.3.4.5.6.7.8 and 300.1.1.1 +1 (23) 456-78-90"), (None, "a@b.c_x@y.z"), (-1, None)]
    got = {r.doc_id: r for r in pii.sanitise(docs(spark, rows)).collect()}
    assert got[3].sanitised == "the [GENERAL] of old"
    assert [(s.kind, s.start, s.stop) for s in got[4].base] == [("ip", 0, 7), ("ip", 8, 15), ("phone", 30, 47)]
    assert [(s.start, s.stop) for s in got[None].base] == [(0, 5), (5, 11)]
    assert got[-1].sanitised == ""


@pytest.mark.parametrize("sep", [" ", "-"])
def test_pii_card_with_every_digit_separated(spark, sep):
    card = sep.join("4" + "1" * 15)
    rows = [(1, f"pay with {card} today"), (2, "at 1.2.3.4"), (3, "one 1 only")]
    got = {r.doc_id: r for r in pii.sanitise(docs(spark, rows)).collect()}
    assert [(s.kind, s.start, s.stop) for s in got[1].base] == [("card", 9, 9 + len(card))]
    assert got[1].sanitised == "pay with [CARD] today"
    assert (got[2].sanitised, got[3].sanitised) == ("at [IP]", "one 1 only")


def _labelled(n, seed=1, share=8, insults=("gromblax", "pitifulon", "zwurqe", "мерзкун")):
    rng = random.Random(seed)
    parts = ["al", "pha", "ri", "ver", "sto", "ne", "un", "der", "li", "ght", "pa", "per", "gre", "en", "ta", "ble", "hou", "se", "clo", "ud", "сло", "во"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    texts, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randint(5, 80))]
        labels.append(int(i % share == 0))
        for _ in range(rng.randint(1, 3) if labels[-1] else 0):
            w.insert(rng.randrange(len(w)), rng.choice(insults))
        texts.append(" ".join(x + ("." if rng.random() < 0.1 else "") for x in w))
    return texts, labels


def _scores(model, texts):
    return model.scores(model.describe(*toxicity._join(texts)))


def test_toxicity_learns_and_tolerates_insertions():
    model = toxicity.train(*_labelled(600))
    texts, labels = _labelled(200, seed=2)
    right = (_scores(model, texts) >= 0.5) == np.array(labels, bool)
    assert right[np.array(labels) == 1].mean() > 0.9 and right[np.array(labels) == 0].mean() > 0.97
    plain = "river paper green table house cloud under light. "
    gapped = [plain + x for x in ("grom-blax here", "pit.ifu.lon it is", "a gromxblax", "PITIFULLON", "м-е-р-з-к-у-н")]
    assert (_scores(model, gapped) > 0.5).all(), _scores(model, gapped)
    none = _scores(model, ["", " ", plain, "x" * 100_000, "paper " * 20_000])
    assert ((none >= 0) & (none < 0.5)).all()


def test_toxicity_without_both_labels():
    for texts, labels in (([], []), (["a b", "c"], [0, 0]), (["a b"], [1]), (["", " "], [0, 1])):
        s = _scores(toxicity.train(texts, labels), ["a b", ""])
        assert ((s >= 0) & (s <= 1)).all()


def test_toxicity_fit_and_score(spark):
    """Copies and size move held-out figures little; nulls, repeats, clashing columns and empty tables are no trouble."""
    schema = "doc_id long, text string, extra string, score string, row int"
    texts, y = _labelled(1500, seed=5)
    rows = [(i, t, "x", "y", 1) for i, t in enumerate(texts)]
    marks = spark.createDataFrame([*[(i, k, "x") for i, k in enumerate(y)], (None, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string")
    edge = [(None, "paper", None, None, None), (-1, None, None, None, None), (-2, "", "x", "y", 1), rows[0], rows[0]]

    def caught(rows, marks, most=toxicity.SAMPLE_ROWS):
        docs_ = spark.createDataFrame(rows, schema)
        model = toxicity.fit(docs_, marks, rows=most)
        got = toxicity.with_score(docs_, model, score_col="own").collect()
        assert len(got) == len(rows)
        held = [(r.own >= 0.5, y[r.doc_id]) for r in got if r.doc_id is not None and r.doc_id >= 0 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
        return [np.mean([a == bool(b) for a, b in held if b == k]) for k in (0, 1)]

    plain = caught(rows + edge, marks)
    assert plain[0] > 0.97 and plain[1] > 0.9
    four = caught(rows * 4 + [(i, t + f" number{c} of it", "x", "y", 1) for c in range(2) for i, t in enumerate(texts)], marks)
    assert abs(four[0] - plain[0]) <= 0.03 and abs(four[1] - plain[1]) <= 0.03
    part = caught(rows, marks, most=300)
    assert plain[0] >= part[0] - 0.01 and plain[1] >= part[1] - 0.01
    empty = toxicity.fit(spark.createDataFrame([], schema), marks)
    assert not empty.learned and 0 <= toxicity.score(spark.createDataFrame(edge, schema), empty).first().score <= 1
    assert toxicity.score(spark.createDataFrame([], schema), empty).count() == 0
    one = toxicity.fit(spark.createDataFrame(rows, schema), marks.filter("toxic = 0"))
    assert not one.learned


def test_top_k(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(300, 8)).round(2)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(400 + i, [float(x) for x in v[20]]) for i in range(60)] + [(900, None), (901, [None] * 8)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = [(i, np.floor(np.array(e) * 64)) for i, e in rows if e and e[0] is not None]
    want = set()
    for i, q in good:
        if i % 20 == 0:
            order = sorted((-int(q @ x), j) for j, x in good if j != i)[:5]
            want |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(order)}
    got = mtree.top_k(data, data.filter("vec_id % 20 = 0"), 5, shard=50)
    assert {tuple(r) for r in got.collect()} == want


def test_archives(spark):
    rows = [(1, "http://a b", None), (2, "u", "é" * 600), (3, "u", "é" * 600), (4, "u", "WARC/1.1\r\n\r\n1 2 3 4 5\n" * 60), (5, None, "é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archives.convert_pages(pages).collect()}
    data = {i: (h or "").encode() for i, _, h in rows}
    assert got == {i: (len(b), hashlib.sha1(b).hexdigest(), "revisit" if i == 2 else "response", 3 if i == 2 else None) for i, b in data.items()}


def test_archives_keep_rows_without_page_id(spark):
    rows = [(None, "u", "é" * 600), (2, "u", "é" * 600), (3, "u", "é" * 600), (None, "v", "é" * 600), (None, None, None)]
    got = archives.convert_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = [(None, "u", 1200, "response", None), (None, "v", 1200, "response", None), (None, "about:blank", 0, "response", None), (2, "u", 1200, "revisit", 3), (3, "u", 1200, "response", None)]
    assert sorted(map(str, [(r.page_id, r.url, r.payload_bytes, r.record_type, r.refers_to) for r in got])) == sorted(map(str, want))
    assert len({r.record_id for r in got}) == 5 and all(r.record_id for r in got)


def test_malformed_archives(spark, tmp_path):
    good = b"http://a 1.2.3.4 20240101000000 text/html 5\nhello\n"
    files = {
        "a.arc": b"filedesc://x 0.0.0.0 20240101000000 text/plain 8\nx 0 own\n\n" + good + b"no header at all\n" + good + b"http://b\xff 1.2.3.4 20240101000000 text/html 99\ncut",
        "b.arc": b"", "c.arc": b"\r\n\r\n",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    rows = archives.read_arc(spark, str(tmp_path)).collect()
    assert [(r.url, bytes(r.payload), r.status, r.page_id) for r in rows] == [("http://a", b"hello", 0, None)] * 2
    assert sorted(r.reason for r in archives.archive_rejects(spark, str(tmp_path)).collect()) == ["CUT_OFF", "NO_HEADER_LINE"]
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    found = [n.get("error", n.get("warc-type")) for n, _ in archives.parse_warc(head + b"WARC/1.1\r\nX: y\r\n\r\n\r\n" + head + b"junk")]
    assert found == ["response", "NO_LENGTH", "response", "NO_RECORD_HEAD"]
    assert archives.convert_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_base_spans_equal_a_plain_search(spark):
    """The native spans against Python's regular expressions, match by match."""
    rng = random.Random(12)
    bits = ["a@b.c", "x.y@z-1.org.", "@", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "4 1 1 1", "+1 (23) 456-78-90", "+12345", "+1-2-3-4-5-6-7-8-9", "é日", " ", "-", ".", "word", "12", "0"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(300)]

    def luhn(d):
        return sum(int(x) if k % 2 == 0 else sum(divmod(2 * int(x), 10)) for k, x in enumerate(reversed(d))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    want = {i: [(k, m.start(), m.end()) for k, p, ok in kinds for m in re.finditer(p, t) if ok(m[0])] for i, t in rows}
    got = {r.doc_id: [(s.kind, s.start, s.stop) for s in r.base] for r in pii.sanitise(docs(spark, rows)).collect()}
    assert got == want


def test_repeated_rows_disclose_as_one_document(spark):
    rows = [(1, "note for boss@corp.com about zulutango matters"), (2, "We met zulutango who is boss@corp.com today"), *[(3, "the zulutango of old")] * 9]
    got = {r.doc_id: r.sanitised for r in pii.sanitise(docs(spark, rows)).collect()}
    assert got[3] == "the [GENERAL] of old"


def test_html_tables(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, "u", ""), (3, None, "<p>x"), (3, None, "<p>x"), (None, "u", "plain " * 30)], "page_id long, url string, html string")
    got = html_extract.extract(pages).collect()
    assert len(got) == 5 and all(r.text is not None for r in got if r.page_id in (1, 2))
    assert html_extract.extract(pages.filter("false")).count() == 0


def test_html():
    page = '<html><head><title>T</title></head><body><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies on this site for the good of all.</div><article><h1>Head &amp; more</h1><p>The first of\n the lines is here for you to read and it is long enough.<p>Short.</article><div id="comments"><p>I liked it.</p></div><footer>c</footer>'
    assert html_extract.main_text(page) == "Head & more\nThe first of the lines is here for you to read and it is long enough.\nShort."
    assert html_extract.main_text("") == ""
