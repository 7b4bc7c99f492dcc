"""Rule evaluation and roll-up: scopes, effective fields, statuses, errors and reject reasons."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordgate.functions.text import nullif_blank, rule_key, strip
from recordgate.operators import flatten
from recordgate.operators.policy import Policy
from recordgate.operators.rulebook import RuleSet, bodies_of, isolated, isolated_text
from recordgate.sources.messages import GENDER_FIELD

# Code tables of the two mapped fields.
GENDER_CODES = {"MALE": "M", "FEMALE": "F"}
DOCUMENT_FIELD = "ДУЛ.Паспорт РФ.Тип ДУЛ"
DOCUMENT_CODES = {
    "BIRTH_CERTIFICATE": "27",
    "PASSPORT_RU": "21",
    "VISA": "3",
    "OVERSEAS_PASSPORT_RU": "22",
    "DIPLOMATIC_PASSPORT_RU": "22",
    "TEMPORARY_CERTIFICATE": "26",
    "MILITARY_TICKET": "25",
    "OFFICER_CERTIFICATE": "24",
    "OFFICE_PASSPORT_RU": "0",
    "PASSPORT_FOREIGNER": "31",
    "RESIDENCY": "33",
    "MIGRATION_CARD": "39",
    "TEMPORARY_RESIDENCE": "34",
    "PATENT": "49",
}
SEVERITY = {"SUCCESS": 0, "WARNING": 1, "ERROR": 2}


def _codes(table: dict[str, str], value: Column) -> Column:
    codes = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(codes, strip(value)), F.try_element_at(codes, F.upper(strip(value))), value)


def code_mapped(field: Column, value: Column) -> Column:
    """The value that the rules of this field see: codes for gender and document type, else unchanged."""
    return F.when(field == GENDER_FIELD, _codes(GENDER_CODES, value)).when(field == DOCUMENT_FIELD, _codes(DOCUMENT_CODES, value)).otherwise(value)


def severity(status: Column) -> Column:
    return F.when(status == "ERROR", 2).when(status == "WARNING", 1).otherwise(0)


def status_name(rank: Column) -> Column:
    return F.when(rank == 2, "ERROR").when(rank == 1, "WARNING").otherwise("SUCCESS")


def resolved(decoded: DataFrame, policy: Policy) -> DataFrame:
    """Decoded messages with dataset_code, control_area and the final reason of refusal."""
    # a code stands in an object; only where a string may look like one are types asked for, once a message
    disguised = F.when(F.col("reason").isNull() & ~flatten.plain(F.col("data")), F.from_json("data", "map<string,variant>"))
    decoded = decoded.select("*", F.explode(F.array(disguised)).alias("_types"))
    entries = F.filter(F.map_entries(F.from_json("data", "map<string,string>")), lambda e: e["value"].startswith("{") & e["value"].contains("dataset_code"))
    real = lambda e: F.col("_types").isNull() | F.schema_of_variant(F.col("_types")[e["key"]]).startswith("OBJECT")
    # blocks after the first code are not opened
    first = F.when(F.col("reason").isNull(), F.aggregate(entries, F.lit(None).cast("string"), lambda found, e: F.coalesce(found, F.when(real(e), nullif_blank(F.from_json(e["value"], "map<string,string>")["dataset_code"])))))
    known = decoded.select("*", F.explode(F.array(first)).alias("dataset_code")).drop("_types")
    with_code = known.join(policy.small(policy.area), [*policy.by, "dataset_code"], "left")
    has_rules = policy.small(policy.rules.select(*policy.by, "control_area").distinct().withColumn("has_rules", F.lit(True)))
    found = with_code.join(has_rules, [*policy.by, "control_area"], "left")
    reason = F.coalesce("reason", F.when(F.col("dataset_code").isNull(), "NO_DATASET_CODE").when(F.col("control_area").isNull(), "NO_CONTROL_AREA").when(F.col("has_rules").isNull(), "NO_RULES"))
    return found.withColumn("reason", reason).drop("has_rules")


def scopes(messages: DataFrame, policy: Policy, max_depth: int = flatten.MAX_DEPTH, keep: tuple[str, ...] = ()) -> DataFrame:
    """seq, control_area, scope ('' or an excluded block), scope_order, scope_dataset, flag, m (folded values), logical (names of an
    excluded block), lost (names that the main scope lost to excluded blocks): one row per message and scope.

    An excluded block has all names mapped in it at any depth; the main scope loses each of them, even
    where another block shares it. An excluded block is judged by the message's rules for its own names; its own
    area gives the flag. ``max_depth`` is the one that ``decode`` was given; messages that are
    TOO_DEEP have no scope. The columns that tell the policy's versions apart, and those of ``keep``, are carried along.
    """
    own = list(dict.fromkeys(["seq", "control_area", *policy.by, *keep]))
    per = messages if "nodes" in messages.columns else flatten.message_nodes(messages, max_depth)
    objects = F.filter("nodes", lambda n: n["type"] == "OBJECT")
    named = lambda n: F.filter(n["fields"], lambda f: ~F.lower(strip(F.coalesce(f["logical"], F.lit("")))).isin("", "none"))
    values = F.flatten(F.transform(objects, lambda n: F.transform(named(n), lambda f: F.struct(F.get(n["path"], F.lit(0)).alias("place"), (F.size(n["path"]) == 1).alias("top"), f["logical"].alias("field"), f["value"].alias("value")))))
    excluded = policy.exclusion.groupBy(*policy.by, "control_area").agg(F.collect_list(F.struct("pos", "block")).alias("excluded"))
    per = per.join(policy.small(excluded), [*policy.by, "control_area"], "left")
    # of excluded blocks only those that the message has, in the policy's order
    blocks = F.transform(F.filter(objects, lambda n: F.size(n["path"]) == 1), lambda n: F.struct(F.get(n["path"], F.lit(0)).alias("place"), n["name"].alias("block"), nullif_blank(n["dataset_code"]).alias("dataset_code")))
    order = lambda b: F.get(F.filter("excluded", lambda x: x["block"] == b["block"]), F.lit(0))["pos"]
    found = F.filter(blocks, lambda b: F.exists("excluded", lambda x: x["block"] == b["block"]))
    out = F.sort_array(F.transform(found, lambda b: F.struct((order(b) + 1).alias("scope_order"), b["block"].alias("scope"), b["place"].alias("place"), F.coalesce(b["dataset_code"], b["block"]).alias("scope_dataset"))))
    out = F.coalesce(F.when(F.size("excluded") > 0, out), F.array().cast("array<struct<scope_order:int,scope:string,place:int,scope_dataset:string>>"))
    per = per.select(*own, *[c for c in ["dataset_code"] if c not in own], F.explode(F.array(F.struct(values.alias("v"), out.alias("out")))).alias("x"))
    per = per.select(*per.columns[:-1], "x.*")
    # what is only for excluded blocks is not made where there are none
    inside = lambda x, o: x["place"] == o["place"]
    none = F.array().cast("array<string>")
    lost = F.when(F.size("out") > 0, F.array_distinct(F.transform(F.filter("v", lambda x: F.exists("out", lambda o: inside(x, o))), lambda x: x["field"]))).otherwise(none)
    per = per.select("*", F.explode(F.array(lost)).alias("lost"))
    main = F.struct(F.lit(0).alias("scope_order"), F.lit("").alias("scope"), F.lit(-1).alias("place"), F.col("dataset_code").alias("scope_dataset"), F.when(F.size("lost") > 0, F.filter("v", lambda x: ~F.array_contains("lost", x["field"]))).otherwise(F.col("v")).alias("mine"))
    blocks = F.transform("out", lambda o: F.struct(o["scope_order"].alias("scope_order"), o["scope"].alias("scope"), o["place"].alias("place"), o["scope_dataset"].alias("scope_dataset"), F.filter("v", lambda x: inside(x, o)).alias("mine")))
    rows = per.select(*own, "lost", F.explode(F.concat(F.array(main), blocks)).alias("s")).select(*own, "s.*", F.when(F.col("s.scope") == "", F.col("lost")).otherwise(none).alias("lost"))
    rows = rows.select("*", F.explode(F.array(F.array_distinct(F.transform("mine", lambda x: x["field"])))).alias("names"))
    fold = lambda values: F.when(F.size(values) == 1, F.get(values, F.lit(0))).otherwise(flatten.fold(values))
    of_name = lambda f: F.get(F.transform(F.array(F.transform(F.filter("mine", lambda x: x["field"] == f), lambda x: x["value"])), fold), F.lit(0))
    folded = F.map_from_arrays("names", F.transform("names", of_name))
    logical = F.when(F.col("scope") == "", none).otherwise(F.array_distinct(F.concat("names", F.transform(F.filter("mine", lambda x: x["top"]), lambda x: strip(x["field"])))))
    rows = rows.select(*own, "scope", "scope_order", "scope_dataset", "lost", F.explode(F.array(folded)).alias("m"), logical.alias("logical"))
    # the flag of the block's own area, else of the message's
    own_area = policy.small(policy.area.select(*policy.by, F.col("dataset_code").alias("scope_dataset"), F.col("control_area").alias("own_area")))
    rows = rows.join(own_area, [*policy.by, "scope_dataset"], "left").withColumn("flag_area", F.when(F.col("scope") == "", F.col("control_area")).otherwise(F.coalesce("own_area", "control_area")))
    rows = rows.join(policy.small(policy.flags.withColumnRenamed("control_area", "flag_area")), [*policy.by, "flag_area"], "left")
    return rows.select(*own, "scope", "scope_order", "scope_dataset", F.coalesce("filter_flag", F.lit(False)).alias("flag"), "m", "logical", "lost")


def evaluate(messages: DataFrame, policy: Policy, predicates: dict[str, str] | RuleSet, python_rules: dict[str, Callable] | None = None, scoped: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The long result: seq, scope, scope_order, scope_dataset, field, rule_name, status, raised, error_text, and the columns of ``keep``.

    ``predicates``: rule name to a boolean SQL expression over ``m`` (field to text), or a rule set of one or
    several versions; true is a defect, null or an SQL error counts as raised and not as a defect.
    ``python_rules``: rule name to a function of such a map; what it raises marks the
    record. The named rules of a missing body succeed. No row is shuffled but for the walk's group.
    """
    rule_set = predicates if isinstance(predicates, RuleSet) else None
    names = [] if rule_set else [*predicates, *(python_rules or {})]
    versions = tuple(dict.fromkeys([*policy.by, *(rule_set.by if rule_set else ())]))
    rows = scopes(messages, policy, keep=(*versions, *keep)) if scoped is None else scoped
    rules = _named_bodies(policy, names).groupBy(*policy.by, "control_area").agg(F.collect_list(F.struct("field", "rule_name", "body")).alias("rules"), F.sort_array(F.collect_set("field")).alias("fields"))
    more, keep = keep, ["seq", *dict.fromkeys([*versions, *keep]), "scope", "scope_order", "scope_dataset"]
    rows = _seen_by_rules(rows.join(policy.small(rules), [*policy.by, "control_area"]), keep)
    rows = rows.select(*keep, "e", F.explode("rules").alias("r")).select(*keep, "e", "r.*")
    if rule_set:
        rows = rows.drop("body").join(policy.small(bodies_of(policy.rules, rule_set)).withColumnRenamed("predicate", "body"), [*rule_set.by, "rule_name"], "left")
    coded = F.col("field").isin(GENDER_FIELD, DOCUMENT_FIELD) & F.map_contains_key("e", F.col("field"))
    seen = F.when(coded, F.map_concat(F.map_filter("e", lambda k, v: k != F.col("field")), F.create_map(F.col("field"), code_mapped(F.col("field"), F.try_element_at("e", F.col("field")))))).otherwise(F.col("e"))
    rows = rows.select(*keep, "field", "rule_name", "body", F.explode(F.array(seen)).alias("m"))
    # the first branch is no predicate: see isolated()
    outcome = F.when(F.col("body").isNull(), F.lit(False))
    for name, predicate in {p: p for p in rule_set.predicates}.items() if rule_set else predicates.items():
        outcome = outcome.when(F.col("body") == name, isolated(predicate))
    judged = rows.withColumn("outcome", outcome)
    if python_rules:
        # one Arrow pass over the rows of Python rules; the others go without a map
        python = F.col("body").isin(*python_rules)
        judged = judged.withColumn("outcome", F.when(python, _arrow(python_rules)(F.when(python, F.col("body")), F.when(python, F.col("m")))).otherwise(F.col("outcome")))
    judged = judged.select(*keep, "field", "rule_name", F.coalesce("outcome", F.lit(False)).alias("triggered"), F.col("outcome").isNull().alias("raised"))
    return _with_errors(judged, policy, more)


def _named_bodies(policy: Policy, names: list[str]) -> DataFrame:
    """The policy's rules with the body that each of them names."""
    return policy.rules.join(policy.small(_bodies(policy, names)), "rule_name", "left").distinct()


def _seen_by_rules(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, e (what the rules of a scope see) and rules (those whose field is judged) of scopes with ``rules`` and ``fields`` of their area."""
    comma = lambda f: F.replace(f, F.lit("."), F.lit(","))
    mine = lambda f: F.when(F.col("scope") == "", ~F.array_contains("lost", f)).otherwise(F.array_contains("logical", f))
    # exploded, so that no fold over the fields makes these lists again for each of them
    rows = rows.select("*", F.explode(F.array(F.filter("fields", mine))).alias("wanted"), F.map_keys("m").alias("names"))
    rows = rows.select("*", F.explode(F.array(F.transform("wanted", comma))).alias("commas"))
    # flag: every policy field of the scope is present, a comma name under its dotted form; what the scope holds is looked up before its names are searched
    value = lambda f: F.coalesce(F.try_element_at("m", f), F.when(~F.array_contains("names", f), F.try_element_at("m", comma(f))))
    lifted = F.map_from_arrays("wanted", F.transform("wanted", value))
    rest = F.map_filter("m", lambda k, v: ~F.array_contains("wanted", k) & ~F.array_contains("commas", k))
    judged_fields = F.filter("rules", lambda r: F.array_contains("wanted", r["field"]) & (F.col("flag") | F.array_contains("names", r["field"]) | F.array_contains("names", comma(r["field"]))))
    judged_fields = F.when(F.col("flag") & (F.size("wanted") == F.size("fields")), F.col("rules")).otherwise(judged_fields)
    return rows.select(*keep, F.explode(F.array(F.when(F.col("flag"), F.map_concat(lifted, rest)).otherwise(F.col("m")))).alias("e"), judged_fields.alias("rules"))


def judged_rows(messages: DataFrame, policy: Policy, predicates: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """seq, the columns of ``keep``, scope, rank (of the worst status), raised, and r as in ``answers.results``: one row per message and scope.

    What ``evaluate`` and ``answers.results`` make together, inside the row: nothing is exploded by rule and grouped again.
    """
    found = _named_bodies(policy, list(predicates))
    info = policy.small(_error_info(policy))
    inform = F.upper(strip(F.coalesce("classification", F.lit("")))) == "INFORM"
    text = F.coalesce(nullif_blank(F.col("error_description")), F.concat(F.lit("No error text for rule "), F.col("rule_name")))
    place = F.array_position(F.array(*[F.lit(n) for n in predicates]).cast("array<string>"), F.col("body"))
    rule = F.struct("rule_name", rule_key(F.col("rule_name")).alias("rule"), place.cast("int").alias("at"), F.when(inform, "WARNING").otherwise("ERROR").alias("status"), text.alias("text"))
    by_field = found.join(info, [*policy.by, "rule_name"], "left").groupBy(*policy.by, "control_area", "field").agg(F.sort_array(F.collect_list(rule)).alias("rules"))
    rules = by_field.groupBy(*policy.by, "control_area").agg(F.sort_array(F.collect_list(F.struct("field", "rules"))).alias("rules"), F.sort_array(F.collect_set("field")).alias("fields"))
    rows = scopes(messages, policy, keep=keep)
    keep = ["seq", *dict.fromkeys([*policy.by, *keep]), "scope", "scope_order", "scope_dataset"]
    rows = _seen_by_rules(rows.join(policy.small(rules), [*policy.by, "control_area"], "left"), keep)
    # rules of a coded field see its code, all others what the message says
    coded = F.transform(F.filter("rules", lambda g: g["field"].isin(GENDER_FIELD, DOCUMENT_FIELD) & F.map_contains_key("e", g["field"])), lambda g: g["field"])
    rows = rows.select("*", F.explode(F.array(F.coalesce(coded, F.array().cast("array<string>")))).alias("_coded"))
    code = lambda f: F.map_concat(F.map_filter("e", lambda k, v: k != f), F.create_map(f, code_mapped(f, F.try_element_at("e", f))))
    rows = rows.select("*", F.explode(F.array(F.when(F.size("_coded") == 0, F.array("e")).otherwise(F.concat(F.array("e"), F.transform("_coded", code))))).alias("_seen"))
    # a predicate's map is the variable of the fold; at 0 stands the outcome of a rule without a body
    outcomes = ", ".join(["false", *[isolated_text(p) for p in predicates.values()]])
    rows = rows.select(*keep, "rules", "_coded", F.explode(F.array(F.expr(f"transform(_seen, m -> array({outcomes}))"))).alias("_out"))
    outcome = lambda g, x: F.get(F.get("_out", F.array_position("_coded", g["field"]).cast("int")), F.coalesce(x["at"], F.lit(0)))
    hit = lambda x, o: F.struct(x["rule"].alias("rule"), F.when(o, x["status"]).otherwise("SUCCESS").alias("status"), F.when(o, x["text"]).alias("text"), o.isNull().alias("raised"))
    marks = F.transform("rules", lambda g: F.struct(g["field"].alias("field"), F.transform(g["rules"], lambda x: hit(x, outcome(g, x))).alias("marks")))
    rows = rows.select(*keep, F.explode(F.array(F.coalesce(marks, F.array().cast("array<struct<field:string,marks:array<struct<rule:string,status:string,text:string,raised:boolean>>>>")))).alias("_marks"))
    # of one rule nothing is compared
    worst = lambda marks: F.when(F.size(marks) == 1, F.get(marks, F.lit(0))["status"]).otherwise(status_name(F.array_max(F.transform(marks, lambda y: severity(y["status"])))))
    errors = lambda marks: F.array_distinct(F.filter(F.transform(marks, lambda y: y["text"]), lambda t: t.isNotNull()))
    row = lambda g: F.struct(F.col("scope_order"), g["field"].alias("field"), F.col("scope_dataset"), F.col("scope"), worst(g["marks"]).alias("status"), F.transform(g["marks"], lambda y: F.struct(y["rule"].alias("rule"), y["status"].alias("status"))).alias("rules"), errors(g["marks"]).alias("errors"))
    raised = F.exists("_marks", lambda g: F.exists(g["marks"], lambda y: y["raised"]))
    rows = rows.select(*keep, F.explode(F.array(F.struct(F.transform("_marks", row).alias("r"), raised.alias("raised")))).alias("_o"))
    rank = F.when(F.array_contains("_o.r.status", "ERROR"), 2).when(F.array_contains("_o.r.status", "WARNING"), 1).otherwise(0)
    return rows.select(*keep[:-2], "_o.r", "_o.raised", rank.alias("rank"))


def _bodies(policy: Policy, names: list[str]) -> DataFrame:
    """rule_name to the body it names: exact, then with the prefix 'Rule', then without it."""
    known = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    bare = F.regexp_replace("rule_name", "^Rule", "")
    pick = F.when(F.array_contains(known, F.col("rule_name")), F.col("rule_name")).when(F.array_contains(known, F.concat(F.lit("Rule"), "rule_name")), F.concat(F.lit("Rule"), "rule_name")).when(F.array_contains(known, bare), bare)
    return policy.rules.select("rule_name").distinct().withColumn("body", pick)


def _arrow(rules: dict[str, Callable]):
    @F.pandas_udf("boolean")
    def run(body: pd.Series, m: pd.Series) -> pd.Series:
        def one(name, x):
            try:
                return None if name is None else bool(rules[name](dict(x)))
            except Exception:
                return None  # raised: not triggered, and the record is marked

        return pd.Series([one(n, x) for n, x in zip(body, m, strict=True)], index=m.index, dtype="object")

    return run


def _error_info(policy: Policy) -> DataFrame:
    """rule_name, error_description, classification: by the exact rule name, then with the prefix 'Rule', then without it; info without text and class is skipped."""
    errors = policy.errors.filter(nullif_blank(F.col("error_description")).isNotNull() | F.col("classification").isNotNull())
    info = errors.groupBy(*policy.by, "rule_name").agg(F.min(F.struct("error_description", "classification")).alias("i")).select(*policy.by, F.col("rule_name").alias("known"), "i")
    names = policy.rules.select(*policy.by, "rule_name").distinct()
    tries = F.array("rule_name", F.concat(F.lit("Rule"), "rule_name"), F.regexp_replace("rule_name", "^Rule", ""))
    each = names.select(*policy.by, "rule_name", F.posexplode(tries).alias("at", "known")).join(policy.small(info), [*policy.by, "known"])
    return each.groupBy(*policy.by, "rule_name").agg(F.min_by("i", "at").alias("i")).select(*policy.by, "rule_name", "i.*")


def _with_errors(judged: DataFrame, policy: Policy, keep: tuple[str, ...] = ()) -> DataFrame:
    rows = judged.join(policy.small(_error_info(policy)), [*policy.by, "rule_name"], "left")
    inform = F.upper(strip(F.coalesce("classification", F.lit("")))) == "INFORM"
    status = F.when(~F.col("triggered"), "SUCCESS").when(inform, "WARNING").otherwise("ERROR")
    text = F.when(F.col("triggered"), F.coalesce(nullif_blank(F.col("error_description")), F.concat(F.lit("No error text for rule "), F.col("rule_name"))))
    return rows.select("seq", "scope", "scope_order", "scope_dataset", "field", "rule_name", status.alias("status"), "raised", text.alias("error_text"), *keep)


def field_status(long: DataFrame) -> DataFrame:
    """Per field the worst status, the rules with their statuses, and the distinct error texts in rule order."""
    ordered = F.sort_array(F.collect_list(F.struct(rule_key(F.col("rule_name")).alias("rule"), "status", "error_text")))
    out = long.groupBy("seq", "scope", "field").agg(F.max(severity(F.col("status"))).alias("rank"), ordered.alias("rules"))
    texts = F.array_distinct(F.filter(F.transform("rules", lambda r: r["error_text"]), lambda t: t.isNotNull()))
    return out.select("seq", "scope", "field", status_name(F.col("rank")).alias("status"), F.array_join(F.transform("rules", lambda r: F.concat_ws("=", r["rule"], r["status"])), ",").alias("rules"), F.array_join(texts, "|").alias("errors"))


def record_status(long: DataFrame) -> DataFrame:
    out = long.groupBy("seq").agg(F.max(severity(F.col("status"))).alias("rank"), F.bool_or("raised").alias("raised"))
    return out.select("seq", status_name(F.col("rank")).alias("all_result"), F.when(F.col("raised"), "RULE_EXCEPTION").otherwise("OK").alias("process_status"))


def detail_buckets(long: DataFrame) -> DataFrame:
    """seq, scope, bucket: sorted 'field: rule=status' text of each scope."""
    rows = field_status(long)
    return rows.groupBy("seq", "scope").agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws(": ", "field", "rules"))), "; ").alias("bucket"))
