"""The gapped kernel against slow enumeration, and insults that are spelled out, drawn out or filled."""

import itertools
import random

import numpy as np
import pytest

from recordgate.llm import toxicity
from tests.llm.test_operators import _labelled, _scores


def code(symbols):
    """Number of the feature of four symbols."""
    flat = np.zeros(toxicity.SPAN + 4, np.uint8)
    flat[:4] = symbols
    index, live = next(toxicity.features(flat))
    assert live[0]
    return int(index[0])


def slow_word(word, decision, commonness):
    """Sum over all subsequences of four symbols within a span of six, the word's edges being symbols."""
    symbols = [toxicity._EDGE, *[int(x) for x in toxicity.symbols(np.frombuffer(word.encode(), np.uint8)) if x], toxicity._EDGE]
    value = length = 0.0
    for at in itertools.combinations(range(len(symbols)), toxicity.LENGTH):
        if at[-1] - at[0] < 6:
            weight = toxicity.DECAY ** (at[-1] - at[0] + 1 - toxicity.LENGTH)
            i = code([symbols[k] for k in at])
            value += weight * decision[i]
            length += (weight * commonness[i]) ** 2
    return value, length


def test_kernel_sums_equal_slow_enumeration():
    rng, random_ = np.random.default_rng(3), random.Random(3)
    decision, commonness = rng.normal(size=1 << toxicity.BITS).astype(np.float32), rng.random(1 << toxicity.BITS).astype(np.float32)
    words = ["".join(random_.choice("abcdeghiéмд") for _ in range(random_.randint(3, 9))) for _ in range(60)]
    words = [w for w in words if not any(a == b == c for a, b, c in zip(w, w[1:], w[2:], strict=False)) and not any(a == b == c for a, b, c in zip(w, w[2:], w[4:], strict=False))]
    corpus = toxicity.Corpus(*toxicity._join([". ".join(words)]))
    value, length = toxicity.word_sums(corpus, decision, commonness)
    order = corpus.word  # of each word in order of the text
    assert len(order) == len(words)
    for i, w in enumerate(words):
        want = slow_word(w, decision, commonness)
        assert (value[order[i]], length[order[i]]) == pytest.approx(want, rel=1e-3, abs=1e-3), w
    margin = toxicity.Model(decision, commonness, 0.25).margins(corpus)
    by_sentence = [slow_word(w, decision, commonness) for w in words]
    assert margin == pytest.approx([v / (n + 1e-3) ** 0.5 + 0.25 for v, n in by_sentence], rel=1e-3, abs=1e-3)


def symbols_of(text):
    corpus = toxicity.Corpus(*toxicity._join([text]))
    return {tuple(int(x) for x in itertools.takewhile(lambda x: x != toxicity._EDGE, corpus.flat[b + 1 :])) for b in corpus.begin}


def test_pieces_repeats_and_fillers_are_gaps():
    plain = symbols_of("gromblax")
    for form in ("g r o m b l a x", "gr om bl ax", "g-r-o-m-b-l-a-x", "grooooomblax", "x".join("gromblax"), "q" + "q".join("gromblax"), "g1r1o1m1b1l1a1x", "G R O M B L A X"):
        assert symbols_of(form) == plain, form
    # two pieces alone, a line end or longer words between them are no spelling
    assert len(symbols_of("ab cd")) == 2 and len(symbols_of("a b\nc d")) == 4 and len(symbols_of("abc def ghi")) == 3
    assert symbols_of("aabb") == {(1, 1, 2, 2)}
    assert symbols_of("") == set()


def test_disguised_insults_are_found_and_clean_texts_left_alone():
    model = toxicity.train(*_labelled(600))
    texts, labels = _labelled(300, seed=21)
    clean = [t for t, y in zip(texts, labels, strict=True) if not y]
    assert max(_scores(model, clean)) < 0.5
    rng = random.Random(5)
    forms = {"spelled": " ".join, "in pairs": lambda w: " ".join(w[i : i + 2] for i in range(0, len(w), 2)), "filled": "x".join, "marked": "*".join, "drawn out": lambda w: w[:3] + w[2] * 4 + w[3:]}
    for name, form in forms.items():
        found = 0
        for text in clean[:30]:
            words = text.split()
            words.insert(len(words) // 2, form(rng.choice(["gromblax", "pitifulon", "zwurqe", "мерзкун"])))
            found += _scores(model, [" ".join(words)])[0] >= 0.5
        assert found >= 27, name


def test_training_holds_little_more_than_its_sample():
    import tracemalloc

    draw = random.Random(5)
    names = ["".join(draw.choice("abcdefghij") for _ in range(draw.randrange(3, 9))) for _ in range(2000)]
    texts = [" ".join(draw.choice(names) for _ in range(250)) + "." for _ in range(2000)]
    size, peak = sum(map(len, texts)), {}
    for name, run in (("copies", lambda: toxicity.without_copies(texts)), ("corpus", lambda: toxicity._spelled(buf, *found))):
        buf, offsets = toxicity._join(texts)
        found = toxicity.words(buf, offsets)
        tracemalloc.start()
        out = run()
        peak[name] = tracemalloc.get_traced_memory()[1] / size
        tracemalloc.stop()
        assert name != "copies" or out.tolist() == list(range(len(texts)))
    assert peak["copies"] < 12 and peak["corpus"] < 20
