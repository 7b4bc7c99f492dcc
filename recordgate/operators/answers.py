"""Nested answers: merged scopes, the short answer with its status and error trees, the detail answer.

A message's objects and its results meet once, in its row or by seq; trees are then built inside the row: what
an answer keeps of a message becomes a list of nodes in document order, whose order is that of the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordgate.functions.text import iso_utc, local_name, nullif_blank, quoted, rule_key, strip
from recordgate.operators import flatten
from recordgate.operators.policy import Policy
from recordgate.operators.validate import evaluate, judged_rows, severity, status_name

UNKNOWN_DATASET = "UNKNOWN_DATASET"


def results(long: DataFrame) -> DataFrame:
    """One row per message: seq, all_result, process_status, r (per scope and field: statuses by sorted rule, worst status, distinct error texts)."""
    ordered = F.sort_array(F.collect_list(F.struct("rule_name", "status", "error_text")))
    per = long.groupBy("seq", "scope", "scope_order", "scope_dataset", "field").agg(ordered.alias("rules"), F.max(severity(F.col("status"))).alias("rank"), F.bool_or("raised").alias("raised"))
    texts = F.array_distinct(F.filter(F.transform("rules", lambda x: x["error_text"]), lambda t: t.isNotNull()))
    rules = F.transform("rules", lambda x: F.struct(rule_key(x["rule_name"]).alias("rule"), x["status"].alias("status")))
    row = F.struct("scope_order", "field", "scope_dataset", "scope", status_name(F.col("rank")).alias("status"), rules.alias("rules"), texts.alias("errors"))
    out = per.groupBy("seq").agg(F.max("rank").alias("rank"), F.bool_or("raised").alias("raised"), F.sort_array(F.collect_list(row)).alias("r"))
    return out.select("seq", status_name(F.col("rank")).alias("all_result"), F.when(F.col("raised"), "RULE_EXCEPTION").otherwise("OK").alias("process_status"), "r")


def with_results(messages: DataFrame, policy: Policy, predicates: dict[str, str]) -> DataFrame:
    """``messages`` (nodes and their other columns) with r, all_result, process_status as of ``results``.

    A policy without excluded blocks has one scope a message, which is judged inside the row: no message is walked again,
    shuffled or sorted. Else the results of its scopes are grouped and joined by seq.
    """
    if not policy.exclusion.isEmpty():
        return messages.join(results(evaluate(messages, policy, predicates)), "seq", "left")
    own = messages.columns
    rows = judged_rows(messages, policy, predicates, keep=tuple(c for c in own if c not in ("seq", *policy.by)))
    return rows.select(*own, status_name(F.col("rank")).alias("all_result"), F.when(F.col("raised"), "RULE_EXCEPTION").otherwise("OK").alias("process_status"), "r")


def _of_last(r: Column, same: str) -> Column:
    """Of results that agree in ``same`` those of the last scope; where there is but one scope nothing is compared."""
    return F.when(F.exists(r, lambda x: x["scope_order"] > 0), F.filter(r, lambda x: ~F.exists(r, lambda y: (y[same] == x[same]) & (y["scope_order"] > x["scope_order"])))).otherwise(r)


def merged(r: Column) -> Column:
    """Results by field: the last scope wins."""
    return _of_last(r, "field")


def of_datasets(r: Column) -> Column:
    """Results by dataset code: of scopes with one code the last is kept whole."""
    return _of_last(r, "scope_dataset")


def merged_errors(r: Column) -> Column:
    """Map of field to its distinct error texts over all scopes, in their order."""
    failing = F.filter(r, lambda x: F.size(x["errors"]) > 0)
    names = F.array_distinct(F.transform(failing, lambda x: x["field"]))
    return F.map_from_entries(F.transform(names, lambda f: F.struct(f.alias("k"), F.array_distinct(F.flatten(F.transform(F.filter(failing, lambda x: x["field"] == f), lambda x: x["errors"]))).alias("v"))))


def objects(messages: DataFrame, max_depth: int = flatten.MAX_DEPTH) -> DataFrame:
    """``messages`` with nodes: every object and array below ``data`` with its mapped fields of a local name, in document order."""
    rows = messages if "nodes" in messages.columns else flatten.message_nodes(messages, max_depth)
    inner = F.filter("nodes", lambda n: F.size(n["path"]) > 0)
    blank = F.exists("nodes", lambda n: F.exists(n["fields"], lambda f: f["local"] == ""))
    return rows.withColumn("nodes", F.when(blank, F.transform(inner, lambda n: n.withField("fields", F.filter(n["fields"], lambda f: f["local"] != "")))).otherwise(inner))


def _starts(path: Column, head: Column) -> Column:
    return F.slice(path, F.lit(1), F.size(head)) == head


def _holding(nodes: str, has: Callable[[Column], Column]) -> Column:
    """Place and path of the nodes that hold something."""
    return F.filter(F.transform(nodes, lambda n, i: F.when(has(n), F.struct(i.alias("i"), n["path"].alias("path")))), lambda w: w.isNotNull())


def _shown(nodes: str, has: Callable[[Column], Column]) -> Column:
    """Of nodes in document order those that hold something (``_with``) and all above these: of what follows a node and holds something the first lies below it."""
    below = lambda n, i: F.coalesce(_starts(F.get(F.filter("_with", lambda w: w["i"] > i), F.lit(0))["path"], n["path"]), F.lit(False))
    return F.filter(nodes, lambda n, i: has(n) | below(n, i))


def _piece(n: Column, head: Column, tail: Column) -> Column:
    """A node as ``rendered`` takes it: what its text holds before its children, and after them."""
    opens = F.when(n["type"] == "OBJECT", "{").otherwise("[")
    return F.struct((F.size(n["path"]) - 1).alias("depth"), F.nullif(n["name"], F.lit("")).alias("name"), opens.alias("opens"), head.alias("head"), tail.alias("tail"))


def rendered(pieces: Column) -> Column:
    """Inner JSON text of nodes in document order; no name: an item of an array. A node without a head has children."""
    zero = F.struct(F.lit("").alias("out"), F.array().cast("array<string>").alias("open"), F.lit(True).alias("bare"))
    closed = lambda texts: F.array_join(F.reverse(texts), "")

    def step(acc: Column, t: Column) -> Column:
        closers = F.when(F.size(acc["open"]) > t["depth"], closed(F.slice(acc["open"], t["depth"] + 1, F.size(acc["open"])))).otherwise("")
        comma = F.when(acc["bare"] & (F.size(acc["open"]) <= t["depth"]), "").otherwise(",")
        name = F.when(t["name"].isNull(), "").otherwise(F.concat(quoted(t["name"]), F.lit(":")))
        closer = F.concat(t["tail"], F.when(t["opens"] == "{", "}").otherwise("]"))
        return F.struct(F.concat(acc["out"], closers, comma, name, t["opens"], t["head"]).alias("out"), F.concat(F.slice(acc["open"], F.lit(1), t["depth"]), F.array(closer)).alias("open"), (t["head"] == "").alias("bare"))

    return F.aggregate(pieces, zero, step, lambda acc: F.concat(acc["out"], closed(acc["open"])))


def _once(rows: DataFrame, **named: Column) -> DataFrame:
    """``rows`` with columns that are made once a row: exploded, so that no fold over a list makes another list again for each item."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in named.items()]))))


def status_tree(rows: DataFrame) -> DataFrame:
    """``rows`` (nodes, r) with ``tree``: inner JSON of block, local field and status; nested objects and arrays kept, empty ones dropped.

    A field's results are those of its block's dataset, else of all; by its logical name, its local
    name, its key, each also with commas for dots.
    """
    comma = lambda k: F.replace(k, F.lit("."), F.lit(","))
    status_of = lambda found: F.map_from_entries(F.transform(found, lambda x: F.struct(x["field"].alias("k"), x["status"].alias("v"))))
    tops = F.transform(F.filter("nodes", lambda n: (F.size(n["path"]) == 1) & (n["type"] == "OBJECT")), lambda n: F.get(n["path"], F.lit(0)))
    odd = F.transform(F.filter("nodes", lambda n: (n["type"] == "ARRAY") & (n["name"] == "")), lambda n: n["path"])
    # of each dataset code that results have, one map
    codes = F.array_distinct(F.transform("r", lambda x: x["scope_dataset"]))
    rows = _once(rows, _tops=tops, _odd=odd, _several=F.exists("r", lambda x: x["scope_order"] > 0), _general=status_of(merged(F.col("r"))), _sets=of_datasets(F.col("r")), _codes=codes)
    # nodes below top-level objects, without arrays that are items of arrays and what lies in them; where all are such nothing is compared
    odd_ones = F.exists("nodes", lambda n: (n["type"] != "OBJECT") & ((F.size(n["path"]) == 1) | (n["name"] == "")))
    below = F.when(~odd_ones, F.col("nodes")).otherwise(F.filter("nodes", lambda n: F.array_contains("_tops", F.get(n["path"], F.lit(0))) & ~F.exists("_odd", lambda t: _starts(n["path"], t))))
    maps = F.transform("_codes", lambda d: F.struct(d.alias("d"), status_of(F.filter("_sets", lambda x: x["scope_dataset"].eqNullSafe(d))).alias("m")))
    rows = _once(rows, _n=below, _maps=maps).drop("_tops", "_odd", "_sets", "_codes")

    def status(f: Column, mine: Column) -> Column:
        # a name without dots has no form of its own with commas
        tries = lambda m: F.coalesce(*[c for k in (f["logical"], f["local"], f["key"]) for c in (F.try_element_at(m, k), F.when(F.contains(k, F.lit(".")), F.try_element_at(m, comma(k))))])
        # a single scope's results of its dataset are all there are
        return F.coalesce(F.when(mine.isNotNull(), tries(mine)), F.when(F.col("_several") | mine.isNull(), tries(F.col("_general"))))

    def with_status(n: Column) -> Column:
        found = lambda mine: F.filter(F.transform(n["fields"], lambda f: F.struct(f["local"].alias("local"), status(f, mine).alias("status"))), lambda f: f["status"].isNotNull())
        mine = F.transform(F.filter("_maps", lambda x: x["d"].eqNullSafe(n["dataset_code"])), lambda x: x["m"])
        # a list of one, so that the map is looked up once a node
        st = F.get(F.transform(F.when(F.size(mine) > 0, mine).otherwise(F.array(F.lit(None).cast("map<string,string>"))), found), F.lit(0))
        return F.when(F.size(n["fields"]) > 0, st).otherwise(F.array().cast("array<struct<local:string,status:string>>"))

    node = lambda n, *more: F.struct(*[n[c].alias(c) for c in ("path", "name", "type", "dataset_code", "elem_id")], *more)
    rows = _once(rows, _j=F.transform("_n", lambda n: node(n, with_status(n).alias("st")))).drop("_n", "_maps", "_general", "_several")
    has = lambda n: F.size(n["st"]) > 0
    rows = _once(rows, _with=_holding("_j", has))
    rows = _once(rows, _open=_shown("_j", has)).drop("_j", "_with")
    # only where a child has the name of a field do fields give way
    locals_ = F.concat(F.flatten(F.transform("_open", lambda n: F.transform(n["st"], lambda f: f["local"]))), F.array(F.lit("elemId")))
    rows = _once(rows, _alike=F.arrays_overlap(F.transform("_open", lambda n: n["name"]), locals_))

    def of_node(n: Column) -> Column:
        kids = F.when(F.col("_alike"), F.transform(F.filter("_open", lambda o: (F.size(o["path"]) == F.size(n["path"]) + 1) & _starts(o["path"], n["path"])), lambda o: o["name"])).otherwise(F.array().cast("array<string>"))

        def inside(names: Column) -> Column:
            fields = F.transform(F.filter(n["st"], lambda f: ~F.array_contains(names, f["local"])), lambda f: F.concat(quoted(f["local"]), F.lit(':"'), f["status"], F.lit('"')))
            code = F.when((n["type"] == "OBJECT") & n["dataset_code"].isNotNull(), F.concat(F.lit('"dataset_code":'), quoted(n["dataset_code"])))
            own = F.array_join(F.when(code.isNull(), fields).otherwise(F.concat(F.array(code), fields)), ",")
            elem = (n["name"] == "") & n["elem_id"].isNotNull() & ~F.exists(n["st"], lambda f: f["local"] == "elemId") & ~F.array_contains(names, F.lit("elemId"))
            # a node that is shown has a status or children before this one
            return _piece(n, own, F.when(elem, F.concat(F.lit(',"elemId":'), quoted(n["elem_id"]))).otherwise(""))

        return F.get(F.transform(F.array(kids), inside), F.lit(0))

    return rows.withColumn("tree", rendered(F.transform("_open", of_node))).drop("_open", "_alike")


def error_tree(rows: DataFrame) -> DataFrame:
    """``rows`` (nodes, r) with ``error_tree``: inner JSON of block, local field and its error texts; card items of documents as an array."""
    json = lambda texts: F.concat(F.lit("["), F.array_join(F.transform(texts, quoted), ","), F.lit("]"))
    docs = F.transform(F.filter("nodes", lambda n: (F.size(n["path"]) == 1) & (n["name"] == "documents") & (n["type"] == "OBJECT")), lambda n: F.get(n["path"], F.lit(0)))
    cards = F.filter("nodes", lambda n: (F.size(n["path"]) == 2) & (n["name"] == "clientIdCard") & (n["type"] == "ARRAY") & F.array_contains(docs, F.get(n["path"], F.lit(0))))
    rows = _once(rows, _failing=F.filter("r", lambda x: F.size(x["errors"]) > 0), _cards=F.transform(cards, lambda n: n["path"]))
    rows = _once(rows, _e=F.transform_values(merged_errors(F.col("_failing")), lambda k, v: json(v)))
    texts = lambda f: F.coalesce(F.try_element_at("_e", f["logical"]), F.when(F.contains(f["logical"], F.lit(".")), F.try_element_at("_e", F.replace(f["logical"], F.lit("."), F.lit(",")))))
    known = lambda f: ~F.lower(F.coalesce(strip(f["logical"]), F.lit(""))).isin("", "none")
    shown = lambda f: F.concat(quoted(f["local"]), F.lit(":"), texts(f))
    failing = lambda n: F.array_join(F.transform(n["fields"], lambda f: F.when(texts(f).isNotNull(), F.when(known(f), shown(f)))), ",")
    in_cards = lambda n: (F.size(n["path"]) == 3) & F.array_contains("_cards", F.slice(n["path"], 1, 2))
    is_list = lambda n: (F.size(n["path"]) == 2) & F.array_contains("_cards", n["path"])
    chosen = F.filter("nodes", lambda n: F.when(n["type"] == "OBJECT", (F.size(n["path"]) == 1) | in_cards(n)).otherwise(is_list(n)))
    piece = lambda n: F.struct(n["path"].alias("path"), _piece(n, F.when(n["type"] == "OBJECT", failing(n)).otherwise(""), F.lit("")).alias("p"))
    rows = _once(rows, _f=F.when(F.size("_e") > 0, F.transform(chosen, piece)))
    has = lambda n: n["p"]["head"] != ""
    rows = _once(rows, _with=_holding("_f", has))
    full = F.transform(_shown("_f", has), lambda n: n["p"])
    return rows.withColumn("error_tree", F.coalesce(rendered(full), F.lit(""))).drop("_failing", "_e", "_cards", "_f", "_with")


def _pairs(*pairs: tuple[str, Column]) -> Column:
    """A JSON object of the pairs whose text is not null."""
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in pairs]), F.lit("}"))


def _envelope(kind: str, now: Column) -> list[tuple[str, Column]]:
    """Fields of the message's envelope, then the answer's own; times that are unknown stay as null."""
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    copied = [(c, F.col("envelope")[c]) for c in flatten.ENVELOPE]
    own = [("dfw_action_type", F.lit(f'"{kind}"')), ("dfw_created_dttm", number("created_dttm")), ("dfw_readed_dttm", number("readed_dttm")), ("dfw_action_dttm", quoted(iso_utc(now)))]
    return [("dfw_query_id", quoted(F.col("query_id"))), *copied, *own]


def _bucket(found: Column) -> Column:
    """JSON of sorted field, sorted rule and status, then ALL_RESULT."""
    sorted_ = F.sort_array(F.transform(found, lambda x: F.struct(x["field"].alias("field"), x["rules"].alias("rules"))))
    shown = F.filter(sorted_, lambda x: nullif_blank(x["field"]).isNotNull() & (F.size(x["rules"]) > 0))
    fields = F.transform(shown, lambda x: F.concat(quoted(x["field"]), F.lit(":{"), F.array_join(F.transform(x["rules"], lambda y: F.concat(quoted(y["rule"]), F.lit(":"), quoted(y["status"]))), ","), F.lit("}")))
    rank = F.coalesce(F.array_max(F.flatten(F.transform(found, lambda x: F.transform(x["rules"], lambda y: severity(y["status"]))))), F.lit(0))
    return F.concat(F.lit("{"), F.array_join(F.concat(fields, F.array(F.concat(F.lit('"ALL_RESULT":'), quoted(status_name(rank))))), ","), F.lit("}"))


def _detail_results(rows: DataFrame) -> DataFrame:
    """``rows`` with ``detail_results``: a bucket for each excluded dataset, and the main one without the fields of other datasets."""
    codes = F.transform(F.filter("nodes", lambda n: (F.size(n["path"]) == 1) & (n["type"] == "OBJECT") & F.array_contains("excluded", n["name"]) & nullif_blank(n["dataset_code"]).isNotNull()), lambda n: F.struct(F.array_position("excluded", n["name"]).alias("p"), n["dataset_code"].alias("c")))
    rows = rows.select("*", F.explode(F.array(F.struct(F.array_distinct(F.transform(F.sort_array(codes), lambda x: x["c"])).alias("codes"), merged(F.col("r")).alias("general"), of_datasets(F.col("r")).alias("sets")))).alias("_d"))
    main = F.coalesce(F.get_json_object(F.concat(F.lit('{"a":'), F.col("envelope.dfw_dataset_code"), F.lit("}")), "$.a"), F.lit(UNKNOWN_DATASET))
    other = F.filter("_d.sets", lambda x: F.array_contains("_d.codes", x["scope_dataset"]) | (x["scope_dataset"] != main))
    gone = F.transform(other, lambda x: x["field"])
    again = F.filter("_d.sets", lambda x: ~F.array_contains("_d.codes", x["scope_dataset"]))
    # each list is exploded: a fold over one list would make the other again for each item
    rows = rows.select("*", F.explode(F.array(F.struct(gone.alias("gone"), again.alias("again"), quoted(main).alias("main")))).alias("_g"))
    # what a dataset puts back replaces what is left of all, and a later scope an earlier one
    rows = rows.select("*", F.explode(F.array(merged(F.col("_g.again")))).alias("_last"))
    left = F.filter("_d.general", lambda x: ~F.array_contains("_g.gone", x["field"]) & ~F.exists("_last", lambda y: y["field"] == x["field"]))
    each = F.transform("_d.codes", lambda c: F.struct(quoted(c).alias("c"), F.filter("_d.sets", lambda x: x["scope_dataset"] == c).alias("found")))
    # an excluded dataset that is the main one too has the main bucket
    each = F.concat(F.filter(each, lambda b: b["c"] != F.col("_g.main")), F.array(F.struct(F.col("_g.main").alias("c"), F.concat(left, "_last").alias("found"))))
    rows = rows.select("*", F.explode(F.array(each)).alias("_each"))
    every = F.transform("_each", lambda b: F.concat(b["c"], F.lit(":"), _bucket(b["found"])))
    return rows.withColumn("detail_results", F.concat(F.lit("{"), F.array_join(every, ","), F.lit("}"))).drop("_d", "_g", "_last", "_each")


#: What ``build`` makes beside the statuses.
PARTS = ("answer", "errors", "detail_answer")


def build(messages: DataFrame, long: DataFrame | None, policy: Policy, now: Column, keep: tuple[str, ...] = (), parts: tuple[str, ...] = PARTS) -> DataFrame:
    """seq, event_id, answer, errors, detail_answer (those of ``parts``), all_result, process_status: one row per accepted message.

    ``long``: the results; none where the messages have theirs (``with_results``). ``messages``: resolved messages; created_dttm and readed_dttm (milliseconds) are used where
    they are columns. A message without any result succeeds. A message whose answer cannot be built
    has a null ``answer`` and is refused; a null ``detail_answer`` alone stops nothing. Columns of ``keep`` follow.
    The optimizer keeps the lists that an unused text is made of, so a text that nobody reads is better left out of ``parts``.
    """
    for c in ("created_dttm", "readed_dttm"):
        if c not in messages.columns:
            messages = messages.withColumn(c, F.lit(None).cast("long"))
    good = messages.filter("reason is null")
    found = objects(good)
    if long is not None:
        found = found.join(results(long), "seq", "left")
    kinds = found.schema["r"].dataType, found.schema["nodes"].dataType
    own = dict.fromkeys(["seq", "event_id", "query_id", "envelope", "control_area", "created_dttm", "readed_dttm", "nodes", "r", "all_result", "process_status", *policy.by, *keep])
    rows = found.select(*own).withColumn("r", F.coalesce("r", F.array().cast(kinds[0]))).withColumn("nodes", F.coalesce("nodes", F.array().cast(kinds[1])))
    if "detail_answer" in parts:
        excluded = policy.exclusion.groupBy(*policy.by, "control_area").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "block"))), lambda x: x["block"]).alias("excluded"))
        rows = rows.join(policy.small(excluded), [*policy.by, "control_area"], "left").withColumn("excluded", F.coalesce("excluded", F.array().cast("array<string>")))
    rows = rows.withColumn("all_result", F.coalesce("all_result", F.lit("SUCCESS"))).withColumn("process_status", F.coalesce("process_status", F.lit("OK")))
    made = {}
    if {"answer", "errors"} & set(parts):
        rows = error_tree(rows)
        made["errors"] = F.concat(F.lit("{"), "error_tree", F.lit("}"))
    if "answer" in parts:
        rows = status_tree(rows)
        details = F.concat(F.lit('{"ALL_RESULT":'), quoted(F.col("all_result")), F.when(F.col("tree") != "", F.concat(F.lit(","), "tree")).otherwise(""), F.lit(',"errors":'), made["errors"], F.lit("}"))
        made["answer"] = F.concat(F.lit('{"data":'), _pairs(*_envelope("ANSWER", now), ("PROCESS_STATUS", quoted(F.col("process_status"))), ("details", details)), F.lit("}"))
    if "detail_answer" in parts:
        rows = _detail_results(rows)
        made["detail_answer"] = _pairs(("detail_results", F.col("detail_results")), *_envelope("ANSWER_DETAIL", now))
    return rows.select("seq", "event_id", *[made[c].alias(c) for c in PARTS if c in parts], "all_result", "process_status", *keep)
