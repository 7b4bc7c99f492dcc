"""Disclosure thresholds, spans and replaced texts against slow versions, and time on texts of many spans."""

import math
import random
import re
import time
from collections import defaultdict

from pyspark.sql import functions as F

from recordgate.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+){3}", "card": r"[0-9](?:[ -]?[0-9])+", "phone": r"\+[0-9][ ().0-9-]+[0-9]"}
WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((kind, m.start(), m.end(), m[0]))
    return out


def flagged(docs):
    """Terms and the least nats that they leave undisclosed."""
    n_ct, contexts, n_t = defaultdict(set), defaultdict(set), defaultdict(set)
    for i, text in docs.items():
        for t in {w.lower() for w in WORD.findall(text)}:
            n_t[t].add(i)
        for kind, start, stop, value in base(text):
            before, after = text[max(0, start - pii.CONTEXT) : start], text[stop : stop + pii.CONTEXT]
            before = re.sub(r"^\S+", "", before) if start > pii.CONTEXT else before
            after = re.sub(r"\S+$", "", after) if len(text) > stop + pii.CONTEXT else after
            for t in {w.lower() for w in WORD.findall(before + " " + after)}:
                if len(t) >= 3:
                    n_ct[kind, value.lower(), t].add(i)
                    contexts[kind, value.lower(), t].add(before + " " + after)
    left = {}
    for (kind, value, t), where in n_ct.items():
        nats = -math.log(min(1.0, len(where) / len(n_t[t])))
        if len(where) >= 2 and len(contexts[kind, value, t]) >= 2 and nats <= pii.GENERALISE:
            left[t] = min(left.get(t, 9.0), nats)
    return left


def replaced(text, spans):
    at, out = 0, []
    for kind, start, stop in sorted(spans, key=lambda s: (s[1], s[2], s[0])):
        if start < at:
            at = max(at, stop)
            continue
        out.append(text[at:start] + ("" if kind == "term" else f"[{kind.upper()}]"))
        at = stop
    return "".join(out) + text[at:]


def test_disclosure_spans_and_texts_equal_slow_versions(spark):
    rng = random.Random(12)
    common = [*"the and of river stone house day night green paper under light über niño".split(), "don't"]
    people = {f"p{k}@corp{k % 2}.com": [f"secret{chr(97 + k)}", f"Alias{chr(97 + k)}"] for k in range(6)}
    docs = {}
    for i in range(160):
        words = [rng.choice(common) for _ in range(rng.randint(0, 60))]
        for mail, names in people.items():
            if rng.random() < 0.12:
                at = rng.randrange(len(words) + 1)
                words[at:at] = [mail, *rng.sample(names, rng.randint(0, 2))]
            if rng.random() < 0.02:
                words.append(names[0].upper())
        words += rng.choice([[], ["1.2.3.4"], ["4111", "1111", "1111", "1111"], ["+1 (23) 456-78-90", "300.1.1.1"]])
        docs[i] = rng.choice([" ", ", ", "  "]).join(words)
    docs[200], docs[201] = docs[3], ""
    want = flagged(docs)
    assert {"term", "general"} == {"term" if x <= pii.REMOVE else "general" for x in want.values()}
    rows = spark.createDataFrame([(i, t, "x", "y") for i, t in docs.items()], "doc_id long, text string, base string, spans string").repartition(3)
    for r in pii.sanitise(rows).collect():
        text = docs[r.doc_id]
        spans = [(k, s, e) for k, s, e, _ in base(text)]
        spans += [("term" if want[m[0].lower()] <= pii.REMOVE else "general", m.start(), m.end()) for m in WORD.finditer(text) if m[0].lower() in want]
        assert [(s.kind, s.start, s.stop) for s in r.spans] == spans
        assert r.sanitised == replaced(text, spans)


def test_texts_of_many_spans_take_linear_time(spark):
    took = []
    for n in (300, 6000, 24000):
        text = " é ".join(f"user{i}@corp.com" for i in range(n))
        rows = spark.createDataFrame([(1, text)], "doc_id long, text string").repartition(1)
        began = time.time()
        spans = pii.base_spans(F.col("text"))
        r = rows.select(F.size(spans).alias("n"), pii._sanitised(F.col("text"), spans).alias("s")).first()
        took.append(time.time() - began)
        assert r.n == n and r.s == " é ".join(["[EMAIL]"] * n)
    assert took[2] < 10 * took[1] + 5
