"""Information-theoretic sanitisation, in DataFrame functions only.

Base spans (email, ip, card, phone) are the protected entities. For each entity c and each term t
that stands near it, corpus counts give PMI(c, t) = ln(N n_ct / (n_c n_t)) and the entity's own
information IC(c) = ln(N / n_c). What t leaves undisclosed of c is IC - PMI = -ln(n_ct / n_t) nats. Terms
that leave less than the lower threshold are removed, less than the upper one generalised, wherever
they stand. Evidence needs two different contexts, so copies of one passage prove nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordgate.llm.common import join_by_size, materialise, semi_join_by_size, table

# Fixed patterns of the base kinds, with possessive quantifiers where giving back cannot help; the
# look-behinds skip starts inside a run whose first start has failed.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?+[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = (("email", EMAIL, 1), ("ip", IP, 2), ("card", CARD, 3), ("phone", PHONE, 4))
TERM = r"\p{L}++(?:['’-]\p{L}++)*+"

#: Code points on each side of an entity that are its context.
CONTEXT = 120
#: Nats left undisclosed below which a term is generalised, and removed.
GENERALISE, REMOVE = math.log(2), math.log(1 / 0.9)
SPAN = "struct<rank:int,kind:string,start:int,stop:int,value:string>"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = _digits(m)
    n = F.length(d)

    def step(total: Column, i: Column) -> Column:
        digit = F.substring(d, n - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(_digits(m)).between(13, 19) & _luhn(m)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


#: Steps that one fold takes: folds copy what they have, so a text of many matches is folded in blocks.
BLOCK = 256


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _folded(items: Column, first: Column, block: Callable[[Column, Column], Column]) -> Column:
    """Array of what ``block`` (of the field ``at`` that the last one gave, and of at most BLOCK items) gives for each block in turn."""
    blocks = F.ceil(F.size(items) / BLOCK).cast("int")

    def step(done: Column, i: Column) -> Column:
        at = F.coalesce(F.get(done, F.size(done) - 1)["at"], F.lit(0))
        return F.concat(done, F.array(block(at, F.slice(items, i * BLOCK + 1, F.lit(BLOCK)))))

    return F.when(blocks > 0, F.aggregate(F.sequence(F.lit(0), F.greatest(blocks - 1, F.lit(0))), first, step)).otherwise(first)


def _matches(text: Column, pattern: str, keep: Callable[[Column], Column]) -> Column:
    """Array of (value, start): the matches that ``keep`` accepts, with starts from the lengths of what lies between.

    Texts between and matches are zipped before the folds, so each is made once and not once per match.
    """
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(between, matches, lambda b, m: F.struct(F.length(b).alias("skip"), m.alias("value")))
    none = F.array().cast("array<struct<value:string,start:int>>")

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + s["skip"]
        found = F.concat(acc["out"], F.array(F.struct(s["value"].alias("value"), start.alias("start"))))
        return F.struct((start + F.coalesce(F.length(s["value"]), F.lit(0))).alias("at"), F.when(s["value"].isNotNull() & keep(s["value"]), found).otherwise(acc["out"]).alias("out"))

    block = lambda at, items: F.aggregate(items, F.struct(at.alias("at"), none.alias("out")), step)
    start = F.array().cast("array<struct<at:int,out:array<struct<value:string,start:int>>>>")
    return _once(steps, lambda all_: F.flatten(F.transform(_folded(all_, start, block), lambda x: x["out"])))


def _spans(text: Column, kind: str, pattern: str, rank: int) -> Column:
    kept = _matches(text, pattern, lambda m: _valid(kind, m))
    return F.transform(kept, lambda m: F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["start"].alias("start"), (m["start"] + F.length(m["value"])).alias("stop"), m["value"].alias("value")))


def base_spans(text: Column) -> Column:
    """Array of SPAN, by kind, then start."""
    none = F.array().cast(f"array<{SPAN}>")
    needs = {"email": text.contains("@"), "ip": text.rlike("[0-9][.]"), "card": text.rlike(r"[0-9][\x20-]?[0-9]"), "phone": text.contains("+")}
    return F.concat(*[F.when(needs[kind], _spans(text, kind, pattern, rank)).otherwise(none) for kind, pattern, rank in KINDS])


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda t: F.lower(t)))


def disclosing_terms(found: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, left: nats left undisclosed, at least one entity's) and (doc_id, term) of where candidates stand.

    ``found``: doc_id, text, base of the documents that hold an entity; ``documents``: doc_id, text.
    """
    entity = found.select("doc_id", "text", F.explode("base").alias("s"))
    before = F.substring(F.col("text"), F.greatest(F.col("s.start") - CONTEXT, F.lit(0)) + 1, F.least(F.col("s.start"), F.lit(CONTEXT)))
    after = F.substring(F.col("text"), F.col("s.stop") + 1, F.lit(CONTEXT))
    # a word cut by the window's end is left out
    before = F.when(F.col("s.start") > CONTEXT, F.regexp_replace(before, r"^\S+", "")).otherwise(before)
    after = F.when(F.length("text") > F.col("s.stop") + CONTEXT, F.regexp_replace(after, r"\S+$", "")).otherwise(after)
    near = entity.select("doc_id", F.concat_ws(":", "s.kind", F.lower("s.value")).alias("entity"), F.concat(before, F.lit(" "), after).alias("context"))
    near = near.select("doc_id", "entity", F.xxhash64("context").alias("context_hash"), F.explode(F.filter(_terms(F.col("context")), lambda t: F.length(t) >= 3)).alias("term"))
    near = materialise(near)
    pair = near.groupBy("entity", "term").agg(F.count_distinct("doc_id").alias("n_ct"), F.count_distinct("context_hash").alias("contexts"))
    # a term stands in at least the documents in which it stands near any entity
    at_least = near.select("term", "doc_id").distinct().groupBy("term").agg(F.count("*").alias("at_least"))
    possible = pair.filter("contexts >= 2 and n_ct >= 2").join(at_least, "term").filter(F.col("n_ct") >= F.col("at_least") * math.exp(-GENERALISE))
    possible = materialise(possible.select("entity", "term", "n_ct"))
    candidates = materialise(possible.select("term").distinct())
    everywhere = documents.select("doc_id", F.explode(_terms(F.col("text"))).alias("term"))
    places = materialise(semi_join_by_size(everywhere, candidates, "term").select("doc_id", "term"))
    n_t = places.groupBy("term").agg(F.count_distinct("doc_id").alias("n_t"))
    left = possible.join(n_t, "term").withColumn("left", -F.log(F.least(F.col("n_ct") / F.col("n_t"), F.lit(1.0))))
    flagged = left.groupBy("term").agg(F.min("left").alias("left")).filter(F.col("left") <= GENERALISE)
    return flagged, places


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, row (all columns given), base and spans (arrays of SPAN), sanitised: one row per row of ``docs``.

    Null text: empty, without spans. Null id: base spans only, and no part in the counts. Repeated
    rows count as one document. An empty table gives an empty result. Other columns are not read.
    In ``sanitised``, spans become [KIND]; terms below the lower threshold vanish.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.struct("*").alias("row"))
    found = materialise(source.filter("doc_id is not null").select("doc_id", "text", base_spans(F.col("text")).alias("base")).filter("size(base) > 0"))
    flagged, places = disclosing_terms(found, source.filter("doc_id is not null").select("doc_id", "text"))
    per_doc = join_by_size(places, materialise(flagged), "term").groupBy("doc_id").agg(F.map_from_entries(F.collect_set(F.struct("term", "left"))).alias("terms"))
    marked = source.select("doc_id", "text", "row", base_spans(F.col("text")).alias("base")).join(per_doc, "doc_id", "left")

    def to_span(m: Column) -> Column:
        kind = F.when(F.element_at("terms", F.lower(m["value"])) <= REMOVE, "term").otherwise("general")
        return F.struct(F.lit(5).alias("rank"), kind.alias("kind"), m["start"].alias("start"), (m["start"] + F.length(m["value"])).alias("stop"), m["value"].alias("value"))

    hits = _matches(F.col("text"), TERM, lambda m: F.map_contains_key("terms", F.lower(m)))
    extra = F.when(F.col("terms").isNotNull(), F.transform(hits, to_span)).otherwise(F.array().cast(f"array<{SPAN}>"))
    marked = marked.select("doc_id", "text", "row", "base", F.concat("base", extra).alias("spans"))
    return marked.withColumn("sanitised", _sanitised(F.col("text"), F.col("spans")))


def _sanitised(text: Column, spans: Column) -> Column:
    """The text with its spans replaced, in order of place; a block of spans reads its own part of the text."""
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    none = F.array().cast("array<string>")

    def block(begin: Column, items: Column) -> Column:
        def step(part: Column) -> Callable[[Column, Column], Column]:
            def one(acc: Column, s: Column) -> Column:
                label = F.when(s["kind"] == "term", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
                piece = F.substring(part, acc["at"] - begin + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
                # a span inside what is already replaced adds no label
                inside = F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out"))
                return F.when(s["start"] < acc["at"], inside).otherwise(F.struct(s["stop"].alias("at"), F.concat(acc["out"], F.array(F.concat(piece, label))).alias("out")))

            return one

        end = F.array_max(F.transform(items, lambda s: s["stop"]))
        part = F.substring(text, begin + 1, F.greatest(end - begin, F.lit(0)))
        return _once(part, lambda p: F.aggregate(items, F.struct(begin.alias("at"), none.alias("out")), step(p)))

    start = F.array().cast("array<struct<at:int,out:array<string>>>")

    def whole(done: Column) -> Column:
        at = F.get(done, F.size(done) - 1)["at"]
        rest = F.substring(text, at + 1, F.greatest(F.length(text) - at, F.lit(0)))
        return F.concat(F.array_join(F.flatten(F.transform(done, lambda x: x["out"])), ""), rest)

    return F.when(F.size(spans) == 0, text).otherwise(_once(by_place, lambda all_: _once(_folded(all_, start, block), whole)))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sanitise(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[count(k) for k, _, _ in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_terms"))
