"""Queries over versions, control events, rule sets and delivery, with their SQL over the relational tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordgate.functions import text
from recordgate.operators import answers, delivery, flatten, policy, rulebook, validate
from recordgate.plans.registry import _BASE, _CONTROL, NOW, _control, _decoded
from recordgate.sources import messages as src
from recordgate.sources.messages import GENDER_FIELD

#: Code pages of ``charset_decode``, by customer.
PAGES = (1251, 1252, 866, 850, 819, 1140)


# --- control events and versions ----------------------------------------------------------------


def _catalogue(spark, sf):
    """What can be loaded, derived from the events: of every fifth version only from seq 600 on."""
    e = _control(spark, sf).filter("version >= 0").select("version").distinct()
    caches = F.explode(F.array(F.lit("politics"), F.lit("compiled_rules"))).alias("cache")
    return e.select(caches, "version", F.when(F.col("version") % 5 == 4, F.lit(600)).cast("long").alias("since"))


def _bounds(spark, sf) -> list:
    return policy.ranges(src.control_events(spark, sf).select("seq"))


def _outcomes(spark, sf):
    return policy.control_outcomes(_control(spark, sf), _catalogue(spark, sf), bounds=_bounds(spark, sf)).select("seq", "cache", "version", "outcome")


def _loads(spark, sf, **names: str) -> list[DataFrame]:
    """Of each cache in ``names`` the seq and version (named as given) of its loads, each version above the last: few rows, made once of all events."""
    events = _control(spark, sf).filter(F.col("cache").isin(*names))
    loaded = policy.control_outcomes(events, _catalogue(spark, sf), bounds=_bounds(spark, sf)).filter("outcome = 'LOADED'")
    loaded = policy.kept(loaded.select("cache", "seq", "version"))
    return [loaded.filter(F.col("cache") == cache).select("seq", F.col("version").alias(name)) for cache, name in names.items()]


def _with_none(spark, loads: DataFrame, name: str) -> DataFrame:
    """The versions of ``loads`` and -1, which is in force before the first."""
    return loads.select(name).unionByName(spark.range(1).select(F.lit(-1).cast("long").alias(name)))


def _policies(spark, loads: DataFrame) -> policy.Policy:
    """The policies of all versions."""
    v, p = F.col("policy_version"), _with_none(spark, loads, "policy_version")
    return policy.Policy(
        "all",
        p.select("policy_version", F.explode(F.create_map(F.lit("D.Base.A"), F.lit("AREA"), F.when(v % 2 == 0, F.lit("D.Base.B")).otherwise(F.lit("D.Other")), F.lit("AREA"))).alias("dataset_code", "control_area")),
        p.select("policy_version", F.lit("AREA").alias("control_area"), F.explode(F.create_map(F.lit("BASE.Balance"), F.lit("Rule1"), F.when(v % 3 == 0, F.lit("BASE.Name")).otherwise(F.lit("BASE.Other")), F.lit("2"))).alias("field", "rule_name")),
        p.select("policy_version", F.lit("Rule1").alias("rule_name"), F.concat(F.lit("low in "), v.cast("string")).alias("error_description"), F.when(v % 4 == 0, F.lit("inform")).alias("classification")),
        p.filter("false").select("policy_version", F.lit("").alias("control_area"), F.lit(0).alias("pos"), F.lit("").alias("block")),
        p.select("policy_version", F.lit("AREA").alias("control_area"), F.lit(False).alias("filter_flag")),
        by=("policy_version",),
    )


def _rule_bodies(spark, loads: DataFrame) -> rulebook.RuleSet:
    """The rule sets of all versions."""
    r = _with_none(spark, loads, "rules_version")
    low = F.when(F.col("rules_version") % 5 == 0, F.lit("cast(m['BASE.Balance'] as int) < 0")).otherwise(F.concat(F.lit("try_cast(m['BASE.Balance'] as double) < 1000 * "), F.pmod("rules_version", F.lit(7)).cast("string")))
    bodies = r.select("rules_version", F.explode(F.create_map(F.lit("Rule1"), low, F.lit("Rule2"), F.lit("m['BASE.Name'] is null"))).alias("rule_name", "predicate"))
    return rulebook.RuleSet(bodies, [x["predicate"] for x in bodies.select("predicate").distinct().collect()], ("rules_version",))


def _asof_eval(spark, sf):
    """Every accepted message under the versions in force at its seq, in one plan."""
    keep = ("policy_version", "rules_version")
    politics, compiled = _loads(spark, sf, politics=keep[0], compiled_rules=keep[1])
    rows = policy.as_of_few(src.derived_messages(spark, sf), politics, keep[0], -1)
    rows = policy.as_of_few(rows, compiled, keep[1], -1)
    held, rules = _policies(spark, politics), _rule_bodies(spark, compiled)
    good = validate.resolved(flatten.decode(rows, keep=keep), held)
    found = validate.evaluate(good.filter("reason is null"), held, rules, keep=keep)
    return found.select("seq", *keep, "field", "rule_name", "status", "raised", "error_text")


def _asof_reasons(spark, sf):
    (politics,) = _loads(spark, sf, politics="policy_version")
    rows = policy.as_of_few(src.derived_messages(spark, sf), politics, "policy_version", -1)
    return validate.resolved(flatten.decode(rows, keep=("policy_version",)), _policies(spark, politics)).select("seq", "policy_version", "reason")


# --- rule sets ----------------------------------------------------------------------------------


def _rule_sets(spark, sf):
    """Fifty rules a version; one row in 97 is faulty, in one of five ways."""
    k = F.col("p_partkey")
    fault = F.when(k % 97 == 5, k % 5)
    predicate = F.when(fault == 3, F.lit("m['BASE.Balance'] <")).when(fault == 4, F.lit("m['BASE.Name']")).otherwise(F.concat(F.lit("coalesce(try_cast(m['BASE.Balance'] as double) < "), F.col("p_size").cast("string"), F.lit(", false)")))
    body = F.when(fault == 1, F.lit(" ")).when(fault == 2, F.lit("%%%")).otherwise(F.base64(F.encode(predicate, "UTF-8")))
    return src.read_table(spark, sf, "part").select(F.expr("p_partkey div 50").alias("version"), F.when(fault == 0, F.lit(" ")).otherwise(F.concat(F.lit("Rule"), k.cast("string"))).alias("rule_name"), body.alias("body"))


def _rule_set_check(spark, sf):
    good, refused = rulebook.checked(_rule_sets(spark, sf), "version")
    kept = good.groupBy("version").agg(F.count("*").alias("n_rules")).select("version", "n_rules", F.lit(None).cast("string").alias("rule_name"), F.lit(None).cast("string").alias("reason"))
    return kept.unionByName(refused.select("version", F.lit(0).cast("long").alias("n_rules"), "rule_name", "reason"))


def _one_area(spark, rules: dict[str, str], codes: list[str], flag: bool = True) -> policy.Policy:
    """One area for all codes, one rule a field (field to rule name), which all say what they are."""
    table = spark.createDataFrame
    return policy.Policy(
        "1", table([(c, "AREA") for c in codes], "dataset_code string, control_area string"), table([("AREA", f, r) for f, r in rules.items()], "control_area string, field string, rule_name string"),
        table([(r, f"{r} fails", None) for r in rules.values()], "rule_name string, error_description string, classification string"), table([], "control_area string, pos int, block string"), table([("AREA", flag)], "control_area string, filter_flag boolean"),
    )


def _rule_errors(spark, sf):
    """Predicates that raise for some messages: a cast below coalesce, a division, an element beyond the last."""
    predicates = {"R1": "coalesce(cast(m['BASE.Name'] as int) > 0, false)", "R2": "100 div cast(cast(m['BASE.Balance'] as double) as bigint) > 5", "R3": "element_at(split(m['BASE.Segment'], 'U'), 3) = 'RE'"}
    held = _one_area(spark, {"BASE.Name": "R1", "BASE.Balance": "R2", "BASE.Segment": "R3"}, ["D.Base.A", "D.Base.B"])
    good = validate.resolved(flatten.decode(src.derived_messages(spark, sf)), held).filter("reason is null")
    return validate.evaluate(good, held, predicates).select("seq", "rule_name", "status", "raised")


# --- delivery -----------------------------------------------------------------------------------


def _charsets(spark, sf):
    k = F.col("c_custkey")
    page = F.element_at(F.array(*[F.lit(p) for p in PAGES]), (k % len(PAGES) + 1).cast("int"))
    rows = src.read_table(spark, sf, "customer").select(k.alias("seq"), F.unhex(F.lpad(F.hex(F.expr(f"c_custkey div {len(PAGES)} % 255 + 1")), 2, "0")).alias("body"), page.alias("ccsid"))
    return rows.select("seq", text.decode_body(F.col("body"), F.col("ccsid")).alias("payload"))


def _deliveries(spark, sf):
    """The events as messages: the user is the id that a redelivery repeats; some have none."""
    user = F.when(F.col("user_id") % 7 != 0, F.col("user_id").cast("string"))
    rows = src.read_table(spark, sf, "events").select(F.col("event_id").alias("seq"), F.lit(None).cast("binary").alias("msg_id"), user.alias("jms_id"), F.col("event_type").alias("payload"))
    return delivery.first_deliveries(rows).select("seq", "jms_id", "payload")


# --- answers ------------------------------------------------------------------------------------


def _array_messages(spark, sf):
    """One message per order: its lines are the items of an array, and the policy names fields in every way that a result is looked up by."""
    lines = src.read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    card = F.concat(F.lit('{"elemId":"E'), F.col("l_linenumber").cast("string"), F.lit('","number":"'), F.col("l_quantity").cast("int").cast("string"), F.lit('","mapping.number":"DOC.Number"}'))
    # an order has few lines, and the largest part of the data is not one order's
    cards = lines.groupBy("l_orderkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", card.alias("c")))), lambda x: x["c"]), ",").alias("cards"))
    k, word = F.col("o_orderkey"), lambda n: F.when(F.col("o_orderkey") % n == 0, "bad").otherwise("ok")
    rows = src.read_table(spark, sf, "orders").join(cards, k == F.col("l_orderkey"), "left")
    main = F.concat(F.lit('{"dataset_code":"D","a":"'), F.col("o_orderstatus"), F.lit('","b":"'), word(3), F.lit('","c":"'), word(4), F.lit('","d":"'), word(5), F.lit('","e":"x","mapping.a":"L.A","mapping.b":"L.B","mapping.c":"L.C","mapping.d":"L.D","mapping.e":"L.E"}'))
    payload = F.concat(F.lit('{"dfw_query_id":"q","data":{"main":'), main, F.lit(',"documents":{"clientIdCard":['), F.coalesce("cards", F.lit("")), F.lit("]}}}"))
    out = rows.select(F.lit(None).cast("binary").alias("msg_id"), k.cast("string").alias("jms_id"), payload.alias("payload"), k.cast("long").alias("seq"))
    return out.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "seq")


def _array_answers(spark, sf):
    """Details of the answers: array items with their statuses; results found by logical, comma, local and full-key names."""
    held = _one_area(spark, {"L.A": "R1", "L,B": "R2", "c": "R3", "mapping.d": "R4", "DOC.Number": "R5"}, ["D"])
    predicates = {"R1": "m['L.A'] = 'F'", "R2": "m['L.B'] = 'bad'", "R3": "m['L.C'] = 'bad'", "R4": "m['L.D'] = 'bad'", "R5": "coalesce(m['DOC.Number'] like '%;%', false)"}
    good = flatten.message_nodes(validate.resolved(flatten.decode(_array_messages(spark, sf)), held).filter("reason is null"))
    built = answers.build(answers.with_results(good, held, predicates), None, held, F.lit(NOW).cast("timestamp"), parts=("answer",))
    return built.select("seq", F.get_json_object("answer", "$.data.details").alias("details"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "control_outcomes": _outcomes,
        "policy_asof_eval": _asof_eval,
        "policy_asof_reasons": _asof_reasons,
        "rule_set_check": _rule_set_check,
        "rule_errors": _rule_errors,
        "charset_decode": _charsets,
        "first_deliveries": _deliveries,
        "array_answers": _array_answers,
        "profile_texts": lambda s, d: flatten.profile_texts(_decoded(s, d)),
    }


_OUTCOMES = f"""{_CONTROL},
  co as (select seq, case when broken then '' else cache end cache, case when broken then -1 else version end version, coalesce(handler, 'flink') handler, valid from ctl),
  ref as (select *, case when not valid then 'INVALID_EVENT' when cache = 'handler' and handler = 'other' then 'UNKNOWN_HANDLER' when cache = 'other_cache' then 'UNKNOWN_CACHE' end refused from co),
  able as (select *, case when refused is null and cache in ('politics', 'compiled_rules') and (version % 5 <> 4 or seq >= 600) then version end good, case when refused is null and cache = 'handler' then handler end named from ref),
  force as (select *, max(good) over before in_force, last_value(named ignore nulls) over before held from able window before as (partition by cache order by seq rows between unbounded preceding and 1 preceding)),
  out as (select seq, cache, version, coalesce(refused, case when cache = 'handler' then case when named = coalesce(held, 'flink') then 'SAME_HANDLER' else 'SWITCHED' end
    when version <= in_force then 'STALE' when good is null then 'LOAD_FAILED' else 'LOADED' end) outcome from force)"""

_VERSIONS = f"""{_BASE}, {_OUTCOMES},
  ver as (select c.*, coalesce((select max_by(version, out.seq) from out where outcome = 'LOADED' and cache = 'politics' and out.seq <= k), -1) pv,
    coalesce((select max_by(version, out.seq) from out where outcome = 'LOADED' and cache = 'compiled_rules' and out.seq <= k), -1) rv from c),
  why as (select *, case when k % 31 = 15 then 'EMPTY_PAYLOAD' when k % 17 = 8 then 'BAD_JSON' when k % 19 = 9 then 'NO_DATASET_CODE' when k % 23 = 11 or k % 2 = 1 and pv % 2 <> 0 then 'NO_CONTROL_AREA' end reason from ver)"""


def oracle_sql() -> dict[str, str]:
    pages = ", ".join(f"[{', '.join(str(ord(c)) for c in bytes(range(256)).decode('latin-1' if p == 819 else f'cp{p:03d}', 'replace'))}]" for p in PAGES)
    return {
        "control_outcomes": f"with {_OUTCOMES} select seq, cache, version, outcome from out",
        "policy_asof_eval": f"""with {_VERSIONS}, hit as (
            select seq, pv, rv, 'BASE.Balance' field, 'Rule1' rule_name, case when rv % 5 = 0 then false else c_acctbal < 1000 * ((rv % 7 + 7) % 7) end hit, rv % 5 = 0 and cast(c_acctbal as double)::varchar like '%.%' raised, pv % 4 = 0 inform, 'low in ' || pv txt from why where reason is null
            union all select seq, pv, rv, 'BASE.Name', '2', k % 11 = 5, false, false, 'No error text for rule 2' from why where reason is null and pv % 3 = 0)
            select seq, pv policy_version, rv rules_version, field, rule_name, case when not hit then 'SUCCESS' when inform then 'WARNING' else 'ERROR' end status, raised, case when hit then txt end error_text from hit""",
        "policy_asof_reasons": f"with {_VERSIONS} select seq, pv policy_version, reason from why",
        "rule_set_check": """with f as (select p_partkey // 50 "version", case when p_partkey % 97 = 5 and p_partkey % 5 = 0 then ' ' else 'Rule' || p_partkey end rule_name,
              case when p_partkey % 97 = 5 then case p_partkey % 5 when 0 then 'BLANK_NAME' when 1 then 'EMPTY_BODY' when 2 then 'UNDECODABLE_BODY' when 3 then 'PARSE_SYNTAX_ERROR' else 'DATATYPE_MISMATCH' end end reason from part),
            v as (select "version", count(*) n, min_by(rule_name, rule_name) filter (reason is not null) rule_name, min_by(reason, rule_name) filter (reason is not null) reason from f group by "version")
            select "version", case when reason is null then n else 0 end n_rules, rule_name, reason from v""",
        "rule_errors": f"""with {_BASE}, g as (select * from ok where k % 19 <> 9 and k % 23 <> 11),
            r as (select seq, 'R1' rule_name, false hit, k % 11 <> 5 raised from g
              union all select seq, 'R2', trunc(c_acctbal) between 1 and 16, trunc(c_acctbal) = 0 from g
              union all select seq, 'R3', c_mktsegment = 'FURNITURE' and k % 13 <> 6, c_mktsegment <> 'FURNITURE' or k % 13 = 6 from g)
            select seq, rule_name, case when hit then 'ERROR' else 'SUCCESS' end status, raised from r""",
        "charset_decode": f"select c_custkey seq, chr([{pages}][c_custkey % {len(PAGES)} + 1][c_custkey // {len(PAGES)} % 255 + 2]) payload from customer",
        "first_deliveries": "select event_id seq, case when user_id % 7 <> 0 then cast(user_id as varchar) end jms_id, event_type payload from (select *, row_number() over (partition by user_id order by event_id) r from events) where r = 1 or user_id % 7 = 0",
        "profile_texts": f"""with {_BASE}, f as (
            select seq, 'BASE.Name' field, case when k % 11 <> 5 then c_name end "value" from ok
            union all select seq, 'BASE,Segment', c_mktsegment from ok where k % 13 <> 6
            union all select seq, 'BASE.Balance', regexp_replace(cast(cast(c_acctbal as decimal(12, 2)) as varchar), '\\.?0+$', '') from ok
            union all select seq, 'BASE.Note', case when k % 7 <> 3 then 'x' end from ok
            union all select seq, '{GENDER_FIELD}', case k % 3 when 0 then 'MALE' when 1 then 'female' else 'other' end from ok
            union all select seq, 'DOC.Number', cast(o_orderkey as varchar) from ok join top on o_custkey = k and r = 1 where k % 29 <> 14
            union all select seq, 'ADDR.City', n_name from ok) select seq, field, "value" from f""",
        "array_answers": """with card as (select l_orderkey, count(*) n, string_agg('{"number":"' || case when n > 1 then 'ERROR' else 'SUCCESS' end || '","elemId":"E' || l_linenumber || '"}', ',' order by l_linenumber) cards, string_agg('{"number":["R5 fails"]}', ',') errors
              from (select *, count(*) over (partition by l_orderkey) n from lineitem) group by l_orderkey),
            o as (select *, o_orderstatus = 'F' r1, o_orderkey % 3 = 0 r2, o_orderkey % 4 = 0 r3, o_orderkey % 5 = 0 r4, coalesce(n, 0) > 1 r5 from orders left join card on l_orderkey = o_orderkey)
            select o_orderkey seq, '{"ALL_RESULT":"' || case when r1 or r2 or r3 or r4 or r5 then 'ERROR' else 'SUCCESS' end || '","main":{"dataset_code":"D","a":"' || case when r1 then 'ERROR' else 'SUCCESS' end || '","b":"' || case when r2 then 'ERROR' else 'SUCCESS' end
              || '","c":"' || case when r3 then 'ERROR' else 'SUCCESS' end || '","d":"' || case when r4 then 'ERROR' else 'SUCCESS' end || '"}' || case when n is null then '' else ',"documents":{"clientIdCard":[' || cards || ']}' end
              || ',"errors":{' || concat_ws(',', nullif('"main":{' || concat_ws(',', case when r1 then '"a":["R1 fails"]' end, case when r2 then '"b":["R2 fails"]' end) || '}', '"main":{}'), case when r5 then '"documents":{"clientIdCard":[' || errors || ']}' end) || '}}' details from o""",
    }
