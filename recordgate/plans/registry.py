"""Registered record-validation queries and their SQL over the relational tables, which never parses JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordgate.functions import text
from recordgate.operators import answers, delivery, flatten, job_events, policy, validate
from recordgate.sources import messages as src
from recordgate.sources.messages import GENDER_FIELD

BUNDLE = {
    "version": "7",
    "dataset2ControlArea": {"D.Base.A": "AREA_A", "D.Base.B": "AREA_B", "D.Reg": "AREA_R"},
    "controlAreaRules": {
        area: {"BASE.Name": ["Rule1001", "Rule1999"], "BASE.Balance": ["1002"], "BASE.Segment": ["Rule1003", "Rule1006"], "BASE.Note": ["Rule1004"], "ADDR.City": ["Rule1005"], GENDER_FIELD: ["Rule1007"]}
        for area in ("AREA_A", "AREA_B")
    },
    "errorMessages": {
        "Rule1001": {"errorDescription": "name is missing", "classification": "ERROR"},
        "Rule1002": {"errorDescription": "balance is negative"},
        "Rule1004": {"errorDescription": "note is missing", "classification": " inform "},
        "Rule1005": {"errorDescription": "more than one city"},
        "Rule1007": {"errorDescription": "unknown gender"},
    },
    "datasetExclusion": {"AREA_B": ["registrationAddress"]},
    "filterFlag": {"AREA_B": True, "AREA_R": False},
}
PREDICATES = {
    "Rule1001": "m['BASE.Name'] is null",
    "Rule1002": "coalesce(try_cast(m['BASE.Balance'] as double) < 0, false)",
    "Rule1003": "coalesce(m['BASE.Segment'] = 'FURNITURE', false)",
    "Rule1004": "m['BASE.Note'] is null",
    "Rule1005": "coalesce(m['ADDR.City'] like '%;%', false)",
    "Rule1006": "case when m['BASE.Segment'] = 'MACHINERY' then null else false end",
    "Rule1007": f"coalesce(m['{GENDER_FIELD}'] not in ('M', 'F'), true)",
}


def load_policy(spark: SparkSession) -> policy.Policy:
    import json

    doc = spark.range(1).select(F.from_json(F.lit(json.dumps(BUNDLE)), policy.BUNDLE_SCHEMA).alias("b")).select("b.*")
    return policy.from_bundle(doc)


def _decoded(spark, sf):
    return flatten.decode(src.derived_messages(spark, sf))


def _long_map(spark, sf):
    return flatten.mappings(flatten.walk(_decoded(spark, sf)))


def _resolved(spark, sf):
    return validate.resolved(_decoded(spark, sf), load_policy(spark))


def _evaluated(spark, sf, arrow: bool = False):
    good = _resolved(spark, sf).filter("reason is null")
    predicates = dict(PREDICATES)
    python = {}
    if arrow:
        del predicates["Rule1005"]
        python = {"Rule1005": lambda m: ";" in (m.get("ADDR.City") or "")}
    return validate.evaluate(good, load_policy(spark), predicates, python)


def _control(spark, sf):
    return src.decode_control(src.control_events(spark, sf))


def _config(spark, sf):
    e = src.read_table(spark, sf, "events").select(F.col("user_id").alias("job"), F.col("event_id").alias("run"), F.col("event_type"), F.floor("value").cast("long").alias("v"))
    pairs = F.array(F.struct(F.lit("mode").alias("key"), F.col("event_type").alias("value")), F.struct(F.lit("db.password").alias("key"), F.col("v").cast("string").alias("value")))
    return e.select("job", "run", F.explode(pairs).alias("p")).select("job", "run", "p.key", "p.value")


def _handler_asof(spark, sf):
    records = src.derived_messages(spark, sf).select("seq")
    return policy.as_of(records, policy.handler_changes(_control(spark, sf)), "handler", "flink")


def _policy_asof(spark, sf):
    records = src.derived_messages(spark, sf).select("seq")
    changes = policy.accepted_versions(_control(spark, sf)).filter("cache = 'politics'").select("seq", "version")
    return policy.as_of(records, changes, "version", -1).select("seq", F.col("version").alias("policy_version"))


def _cef(spark, sf):
    e = src.read_table(spark, sf, "events")
    return job_events.cef_lines(e.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"), "event_type", F.col("event_type").alias("status"), F.concat(F.lit("u="), F.col("user_id").cast("string")).alias("user")), "ORG")


def _masked(spark, sf):
    return src.derived_messages(spark, sf).filter("seq % 17 <> 8 and seq % 31 <> 15").select("seq", F.regexp_extract(text.mask_json(F.col("payload"), ["fullname", "balance"]), r'"fullName":("[^"]*"|null),"segment":"[^"]*","balance":"?([^,"]*)', 0).alias("masked"))


def _masked_whole(spark, sf):
    """The whole masked payload of every message, cut-off and blank ones too."""
    return src.derived_messages(spark, sf).select("seq", text.mask_json(F.col("payload"), ["fullname", "balance"]).alias("masked"))


NOW = "2024-01-01 00:00:00"


def _built(spark, sf, *parts: str, keep: tuple[str, ...] = ()):
    good, rules = flatten.message_nodes(_resolved(spark, sf).filter("reason is null")), load_policy(spark)
    return answers.build(good, validate.evaluate(good, rules, PREDICATES), rules, F.lit(NOW).cast("timestamp"), keep, parts)


def _replies(spark, sf):
    return _built(spark, sf, keep=("query_id",)).select("event_id", "query_id", "process_status", "all_result")


def _reply_out(spark, sf):
    sent, _ = delivery.replies(_built(spark, sf, "answer"), src.derived_messages(spark, sf), F.lit(NOW).cast("timestamp"), "gate", "s1")
    return sent.select("seq", "correlation_id", "body", F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("headers"))


def _audit(spark, sf):
    return delivery.audit_lines(_built(spark, sf, "answer", "detail_answer"), src.derived_messages(spark, sf), F.lit(NOW).cast("timestamp"))


def _routed(spark, sf, which: int):
    parts = delivery.routed(src.derived_messages(spark, sf), policy.handler_changes(_control(spark, sf)))
    return parts[which].select("seq", *(["payload"] if which else []))


def _external(spark, sf):
    k = F.col("c_custkey")
    detail = F.when(k % 3 == 0, ',"detail_answer":null').when(k % 3 == 1, F.concat(F.lit(',"detail_answer":{"n":'), k.cast("string"), F.lit("}"))).otherwise("")
    body = F.when(k % 7 == 0, " ").when(k % 7 == 1, '{"answer":').when(k % 7 == 2, '{"other":1}').when(k % 7 == 3, '{"answer":null}').otherwise(F.concat(F.lit('{"answer":{"k":'), k.cast("string"), F.lit("}"), detail, F.lit("}")))
    return delivery.external_answers(src.read_table(spark, sf, "customer").select(k.alias("event_id"), body.alias("body")))


def _external_answers(spark, sf):
    good, bad = _external(spark, sf)
    none = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    return good.select("event_id", "answer", "detail_answer", *none("reason")).unionByName(bad.select("event_id", *none("answer", "detail_answer"), "reason"))


def _landing(spark, sf):
    k = F.col("c_custkey")
    name = F.concat(F.col("c_name"), F.lit(" é"))
    page = F.element_at(F.array(*[F.lit(x) for x in (1208, 1200, 819, 0, 1251, 77)]), (k % 6 + 1).cast("int"))
    body = F.when(k % 6 == 1, F.encode(name, "UTF-16")).when(k % 6 == 2, F.encode(name, "ISO-8859-1")).otherwise(F.encode(name, "UTF-8"))
    rows = src.read_table(spark, sf, "customer").select(
        k.alias("seq"), F.lit(None).cast("binary").alias("msg_id"), F.lit("j").alias("jms_id"), F.when(k % 10 == 0, F.col("c_name")).alias("text"), F.when(k % 10 > 1, body).alias("body"), F.when(k % 10 != 0, page).alias("ccsid"), (k % 4 - 1).alias("put_ms"), k.alias("read_ms")
    )
    good, bad = delivery.requests(rows, code_pages=False)
    return good.select("seq", "payload", "created_dttm", "readed_dttm", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("seq", F.lit(None).cast("string").alias("payload"), F.lit(None).cast("long").alias("created_dttm"), F.lit(None).cast("long").alias("readed_dttm"), "reason"))


def _spaced(spark, sf):
    """The derived messages with blanks around colons and after commas."""
    spaced = F.replace(F.replace(F.col("payload"), F.lit('":'), F.lit('" : ')), F.lit(',"'), F.lit(' ,\n "'))
    return src.derived_messages(spark, sf).withColumn("payload", spaced)


def _rules_table(spark, sf):
    k = F.col("p_partkey")
    return src.read_table(spark, sf, "part").select(F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit("Rule"), k.cast("string"))).alias("rule_name"), F.when(k % 7 == 0, " ").when(k % 13 == 0, "%%%").otherwise(F.base64(F.encode("p_name", "UTF-8"))).alias("body"))


HOST = job_events.Host(vendor="ORG", app="recordgate", version="1", domain="DOM", ip="10.0.0.1", mac="aa:bb", name="node-1", port=8081, user="svc", cluster="c1", job="gate", kafka_protocol="SASL_SSL")


def _job_events(spark, sf):
    e = F.col("event_id")
    kind = F.when(F.col("event_type") == "click", "JOB_PROPERTIES_CHANGED").when(F.col("event_type") == "view", "KAFKA_SOURCE_CONNECTED").when(F.col("event_type") == "purchase", "IBM_MQ_SINK_CONNECTING").when(F.col("event_type") == "signup", "ARTEMIS_SOURCE_CONNECTED").otherwise("JOB_FAILED")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    payload = (
        F.when(e % 5 == 0, F.create_map(F.lit("brokerUrl"), text("ssl://u@mq", e, ".x:61617?a=b,tcp://other:1"), F.lit("user"), text("us=er", e)))
        .when(e % 5 == 1, F.create_map(F.lit("bootstrap"), text(" [::", e % 9, "]:9093,h2:1"), F.lit("topic"), F.lit("in|out")))
        .when(e % 5 == 2, F.create_map(F.lit("host"), F.lit("10.0.0.1"), F.lit("port"), F.lit("-3"), F.lit("tlsEnabled"), F.lit("TRUE")))
        .when(e % 5 == 3, F.create_map(F.lit("bootstrap"), text("h", e, ":bad"), F.lit("protocol"), F.lit("<empty>"), F.lit("errorMessage"), F.lit("a\nb")))
        .otherwise(F.create_map(F.lit("queue"), F.lit("Q1")))
    )
    return src.read_table(spark, sf, "events").select(
        e, F.col("ts").alias("event_time"), kind.alias("event_type"), F.when(F.col("event_type") == "error", "failed").when(e % 2 == 0, "SUCCESS").alias("status"), F.lit("gate").alias("job_name"), F.lit("1").alias("job_version"),
        F.when(e % 3 == 0, "c2").alias("cluster_id"), F.lit("node-1").alias("hostname"), F.when(e % 4 == 0, e % 8).cast("int").alias("subtask"), F.lit(None).cast("int").alias("parallelism"), payload.alias("payload"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "event_id_hex": lambda s, d: _decoded(s, d).select("seq", "event_id"),
        "json_blocks": lambda s, d: flatten.blocks(_decoded(s, d)).select("seq", "pos", "block", "dataset_code"),
        "first_dataset_code": lambda s, d: flatten.first_dataset_code(flatten.blocks(_decoded(s, d))),
        "normalized_map": lambda s, d: flatten.normalized(_long_map(s, d)),
        "flat_profile": lambda s, d: flatten.flat_profile(_long_map(s, d)),
        "multi_value_join": lambda s, d: flatten.normalized(_long_map(s, d)).filter("field = 'DOC.Number'").select("seq", "value"),
        "reject_reasons": lambda s, d: _resolved(s, d).select("seq", "reason"),
        "control_area_lookup": lambda s, d: _resolved(s, d).filter("control_area is not null").select("seq", "control_area"),
        "field_rules": lambda s, d: _evaluated(s, d).groupBy("scope", "field", "rule_name").agg(F.count("*").alias("n")),
        "rule_eval": lambda s, d: _evaluated(s, d).select("seq", "scope", text.rule_key(F.col("rule_name")).alias("rule"), "status", "raised"),
        "rule_eval_arrow": lambda s, d: _evaluated(s, d, arrow=True).select("seq", "scope", text.rule_key(F.col("rule_name")).alias("rule"), "status", "raised"),
        "error_texts": lambda s, d: _evaluated(s, d).filter("error_text is not null").select("seq", "scope", "field", "error_text"),
        "field_status": lambda s, d: validate.field_status(_evaluated(s, d)).select("seq", "scope", "field", "status"),
        "record_status": lambda s, d: validate.record_status(_evaluated(s, d)).select("seq", "all_result"),
        "process_status": lambda s, d: validate.record_status(_evaluated(s, d)).select("seq", "process_status"),
        "detail_bucket": lambda s, d: validate.detail_buckets(_evaluated(s, d)),
        "replies": _replies,
        "mask_json": _masked,
        "mask_json_whole": _masked_whole,
        "version_acceptance": lambda s, d: policy.accepted_versions(_control(s, d)),
        "handler_changes": lambda s, d: policy.handler_changes(_control(s, d)),
        "handler_asof": _handler_asof,
        "policy_asof": _policy_asof,
        "control_rejects": lambda s, d: policy.control_rejects(_control(s, d)),
        "config_hash": lambda s, d: job_events.config_hashes(_config(s, d)),
        "config_change": lambda s, d: job_events.config_changes(job_events.config_hashes(_config(s, d))),
        "cef_lines": _cef,
        "short_answer": lambda s, d: _built(s, d, "answer").select("seq", "answer"),
        "short_errors": lambda s, d: _built(s, d, "errors").select("seq", "errors"),
        "detail_answer": lambda s, d: _built(s, d, "detail_answer").select("seq", "detail_answer"),
        "reply_out": _reply_out,
        "audit_lines": _audit,
        "shadow_copies": lambda s, d: _routed(s, d, 1),
        "judged_here": lambda s, d: _routed(s, d, 0),
        "external_answers": _external_answers,
        "request_landing": _landing,
        "normalized_map_spaced": lambda s, d: flatten.normalized(flatten.mappings(flatten.walk(flatten.decode(_spaced(s, d))))),
        "mask_spaced": lambda s, d: _spaced(s, d).select("seq", F.regexp_count(text.mask_json(F.col("payload"), ["fullname", "balance", "clientIdCard"]), F.lit(r'"(fullName|balance|clientIdCard)":"\*\*\*"')).alias("masked")),
        "mask_fields": lambda s, d: flatten.normalized(_long_map(s, d)).groupBy("seq").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("m")).select("seq", F.explode(text.mask_map(F.col("m"))).alias("field", "value")),
        "flat_lines": lambda s, d: flatten.profile_lines(_decoded(s, d)),
        "rule_payloads": lambda s, d: policy.rule_payloads(_rules_table(s, d)),
        "payload_stats": lambda s, d: policy.payload_stats(_rules_table(s, d)),
        "event_lines": lambda s, d: job_events.event_lines(job_events.numbered(_job_events(s, d)), HOST),
        "event_documents": lambda s, d: job_events.event_documents(_job_events(s, d)),
    }


# --- SQL ----------------------------------------------------------------------------------------

_BASE = """
  c as (select c_custkey k, c_custkey seq, c.*, n_name, r_name from customer c join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
  ok as (select * from c where k % 31 <> 15 and k % 17 <> 8),
  good as (select *, case when k % 2 = 0 then 'A' else 'B' end area from ok where k % 19 <> 9 and k % 23 <> 11),
  top as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_orderkey) r from orders)"""

_VALUES = f"""{_BASE},
  lng as (
    select seq, 'BASE.Name' field, case when k % 11 <> 5 then c_name end "value", 0 p from ok
    union all select seq, 'BASE,Segment', c_mktsegment, 0 from ok where k % 13 <> 6
    union all select seq, 'BASE.Balance', cast(cast(cast(c_acctbal as decimal(12, 2)) as double) as varchar), 0 from ok
    union all select seq, 'BASE.Note', case when k % 7 <> 3 then 'x' end, 0 from ok
    union all select seq, '{GENDER_FIELD}', case k % 3 when 0 then 'MALE' when 1 then 'female' else 'other' end, 0 from ok
    union all select seq, 'DOC.Number', cast(o_orderkey as varchar), r from ok join top on o_custkey = k and r <= 3 where k % 29 <> 14
    union all select seq, 'ADDR.City', n_name, 0 from ok union all select seq, 'ADDR.City', r_name, 1 from ok)"""

_MASKED = f"""{_BASE},
  card as (select o_custkey, string_agg('{{"elemId":"ID","number":"' || o_orderkey || '","primary":true,"mapping.number":"DOC.Number"}}', ',' order by r) cards from top where r <= 3 group by o_custkey),
  part as (select seq, k, '{{"dfw_query_id":"q' || k || '","data":{{"baseInfo":{{' || case when k % 19 = 9 then '' else '"dataset_code":"' || case when k % 23 = 11 then 'D.Unknown' when k % 2 = 0 then 'D.Base.A' else 'D.Base.B' end || '",' end || '"fullName":' before,
      case when k % 11 = 5 then '"none"' else '"' || c_name || '"' end secret1, ',"segment":"' || c_mktsegment || '","balance":' between_, cast(cast(c_acctbal as decimal(12, 2)) as varchar) secret2,
      ',"note":' || case when k % 7 = 3 then '"  "' else '"x"' end || ',"gender":' || case k % 3 when 0 then '"MALE"' when 1 then '"female"' else '"other"' end
        || ',"mapping.fullName":"BASE.Name","mapping.segment":' || case when k % 13 = 6 then 'null' else '"BASE,Segment"' end || ',"mapping.balance":"BASE.Balance","mapping.note":"BASE.Note","mapping.gender":"{GENDER_FIELD}"}}'
        || case when k % 29 = 14 then '' else ',"documents":{{"clientIdCard":[' || coalesce(cards, '') || ']}}' end
        || ',"homeAddress":{{' || case when k % 19 = 9 then '' else '"dataset_code":"D.Home",' end || '"city":"' || n_name || '","mapping.city":"ADDR.City"}}'
        || ',"registrationAddress":{{' || case when k % 19 = 9 then '' else '"dataset_code":"D.Reg",' end || '"city":"' || r_name || '","mapping.city":"ADDR.City"}}}}}}' after_
    from c left join card on o_custkey = k),
  cut as (select *, length(before || secret1 || between_ || secret2) shown, length(before || secret1 || between_ || secret2 || after_) // 2 half from part)"""

_RULES = f"""{_BASE},
  rule as (
    select seq, '' scope, 'BASE.Name' field, 'Rule1001' rule_name, k % 11 = 5 hit, false raised, 'name is missing' txt from good
    union all select seq, '', 'BASE.Name', 'Rule1999', false, false, null from good
    union all select seq, '', 'BASE.Balance', '1002', c_acctbal < 0, false, 'balance is negative' from good
    union all select seq, '', 'BASE.Segment', 'Rule1003', area = 'B' and c_mktsegment = 'FURNITURE' and k % 13 <> 6, false, 'No error text for rule Rule1003' from good where area = 'B' or k % 13 <> 6
    union all select seq, '', 'BASE.Segment', 'Rule1006', false, area = 'B' and c_mktsegment = 'MACHINERY' and k % 13 <> 6, null from good where area = 'B' or k % 13 <> 6
    union all select seq, '', 'BASE.Note', 'Rule1004', k % 7 = 3, false, 'note is missing' from good
    union all select seq, '', 'ADDR.City', 'Rule1005', true, false, 'more than one city' from good where area = 'A'
    union all select seq, 'registrationAddress', 'ADDR.City', 'Rule1005', false, false, null from good where area = 'B'
    union all select seq, '', '{GENDER_FIELD}', 'Rule1007', k % 3 = 2, false, 'unknown gender' from good),
  res as (select seq, scope, field, rule_name, case when not hit then 'SUCCESS' when rule_name = 'Rule1004' then 'WARNING' else 'ERROR' end status, raised, case when hit then txt end error_text,
    replace(rule_name, 'Rule', '') rule_, case when not hit then 0 when rule_name = 'Rule1004' then 1 else 2 end rank_ from rule),
  rec as (select seq, case max(rank_) when 2 then 'ERROR' when 1 then 'WARNING' else 'SUCCESS' end all_result, case when bool_or(raised) then 'RULE_EXCEPTION' else 'OK' end process_status from res group by seq)"""

_ANSWERS = f"""{_RULES},
  st as (select g.*, case when k % 11 = 5 then 'ERROR' else 'SUCCESS' end s_name, case when c_acctbal < 0 then 'ERROR' else 'SUCCESS' end s_balance, case when k % 7 = 3 then 'WARNING' else 'SUCCESS' end s_note,
    case when k % 3 = 2 then 'ERROR' else 'SUCCESS' end s_gender, case when area = 'A' then 'ERROR' else 'SUCCESS' end s_city, all_result, process_status from good g join rec using (seq)),
  er as (select seq, '{{' || concat_ws(',', nullif('"baseInfo":{{' || concat_ws(',', case when s_name = 'ERROR' then '"fullName":["name is missing"]' end, case when s_balance = 'ERROR' then '"balance":["balance is negative"]' end,
      case when s_note = 'WARNING' then '"note":["note is missing"]' end, case when s_gender = 'ERROR' then '"gender":["unknown gender"]' end) || '}}', '"baseInfo":{{}}'),
      case when area = 'A' then '"homeAddress":{{"city":["more than one city"]}},"registrationAddress":{{"city":["more than one city"]}}' end) || '}}' errors from st),
  env as (select seq, '"dfw_query_id":"q' || seq || '",' q, '"dfw_created_dttm":null,"dfw_readed_dttm":null,"dfw_action_dttm":"2024-01-01T00:00:00.000Z"' t from st),
  sa as (select seq, '{{"data":{{' || q || '"dfw_action_type":"ANSWER",' || t || ',"PROCESS_STATUS":"' || process_status || '","details":{{"ALL_RESULT":"' || all_result || '","baseInfo":{{"dataset_code":"D.Base.' || area
      || '","fullName":"' || s_name || '","balance":"' || s_balance || '","note":"' || s_note || '","gender":"' || s_gender || '"}},"homeAddress":{{"dataset_code":"D.Home","city":"' || s_city || '"}},"registrationAddress":{{"dataset_code":"D.Reg","city":"' || s_city
      || '"}},"errors":' || errors || '}}}}}}' answer from st join er using (seq) join env using (seq)),
  fl as (select seq, scope, field, max(rank_) r, '"' || field || '":{{' || string_agg('"' || rule_ || '":"' || status || '"', ',' order by rule_name) || '}}' j from res group by seq, scope, field),
  bu as (select seq, scope, '{{' || string_agg(j, ',' order by field) || ',"ALL_RESULT":"' || case max(r) when 2 then 'ERROR' when 1 then 'WARNING' else 'SUCCESS' end || '"}}' b from fl group by seq, scope),
  da as (select seq, '{{"detail_results":{{' || coalesce('"D.Reg":' || o.b || ',', '') || '"UNKNOWN_DATASET":' || m.b || '}},' || q || '"dfw_action_type":"ANSWER_DETAIL",' || t || '}}' detail_answer
    from env join (select * from bu where scope = '') m using (seq) left join (select * from bu where scope <> '') o using (seq))"""

_WHOLE = f"""{_MASKED},
  payload as (select seq, case when k % 31 = 15 then ' ' || chr(9) || ' ' when k % 17 = 8 then substr(before || secret1 || between_ || secret2 || after_, 1, half) else before || secret1 || between_ || secret2 || after_ end payload from cut join c using (seq, k))"""

_EVENTS = """
  e as (select *, row_number() over (order by ts, event_id) n, case event_type when 'click' then 'JOB_PROPERTIES_CHANGED' when 'view' then 'KAFKA_SOURCE_CONNECTED' when 'purchase' then 'IBM_MQ_SINK_CONNECTING' when 'signup' then 'ARTEMIS_SOURCE_CONNECTED' else 'JOB_FAILED' end kind,
      case event_type when 'click' then 'JOB_PROPERTIES' when 'view' then 'KAFKA' when 'purchase' then 'IBM_MQ_SINK' when 'signup' then 'ARTEMIS_SOURCE' else 'JOB' end class,
      case event_type when 'click' then 'Job Properties Changed' when 'view' then 'Kafka Source Connected' when 'purchase' then 'IBM MQ Sink Connecting' when 'signup' then 'Artemis Source Connected' else 'Job Failed' end title,
      case when event_type = 'error' then 'failed' when event_id % 2 = 0 then 'SUCCESS' end st, event_id % 5 v from events),
  x as (select *, case v when 0 then 'mq' || event_id || '.x' when 1 then '::' || event_id % 9 when 2 then '10.0.0.1' when 3 then 'h' || event_id else '10.0.0.1' end dst, case v when 0 then 61617 when 1 then 9093 else 8081 end dpt,
      case when v = 0 then 'us\\=er' || event_id else 'svc' end usr, case when v = 0 then 'SSL' when kind like 'KAFKA%' then 'SASL_SSL' when v = 2 then 'TLS' else 'TCP' end proto from e)"""

_CONTROL = """
  ev as (select event_id seq, case event_type when 'click' then 'compiled_rules' when 'view' then 'politics' when 'purchase' then 'handler' when 'signup' then 'other_cache' else '' end cache,
      case when event_id % 53 = 0 then -1 else event_id % 97 end version, case when event_type = 'purchase' then case event_id % 4 when 1 then 'dotnet' when 3 then 'other' else 'flink' end end handler,
      event_id % 71 = 0 broken from events),
  ctl as (select *, not broken and version >= 0 and cache <> '' valid from ev),
  acc as (select * from (select seq, cache, version, max(version) over (partition by cache order by seq rows between unbounded preceding and 1 preceding) b from ctl where valid and cache in ('compiled_rules', 'politics')) where b is null or version > b),
  hc as (select seq, handler from (select seq, handler, lag(handler, 1, 'flink') over (order by seq) b from ctl where valid and cache = 'handler' and handler in ('flink', 'dotnet')) where handler <> b)"""

_CONFIG = """
  h as (select user_id job, event_id run, sha256('db.password=***' || chr(10) || 'mode=' || event_type) hash from events)"""


def oracle_sql() -> dict[str, str]:
    fold = "string_agg(\"value\", ';' order by p)"
    return {
        "event_id_hex": f"with {_BASE} select seq, lpad(upper(to_hex(k)), 16, '0') || repeat('0', 32) event_id from c",
        "json_blocks": f"""with {_BASE}, b as (select seq, k, 0 o, 'baseInfo' block, case when k % 23 = 11 then 'D.Unknown' when k % 2 = 0 then 'D.Base.A' else 'D.Base.B' end ds from ok
            union all select seq, k, 1, 'documents', null from ok where k % 29 <> 14 union all select seq, k, 2, 'homeAddress', 'D.Home' from ok union all select seq, k, 3, 'registrationAddress', 'D.Reg' from ok)
            select seq, cast(row_number() over (partition by seq order by o) - 1 as int) pos, block, case when k % 19 <> 9 then ds end dataset_code from b""",
        "first_dataset_code": f"with {_BASE} select seq, case when k % 23 = 11 then 'D.Unknown' when k % 2 = 0 then 'D.Base.A' else 'D.Base.B' end dataset_code from ok where k % 19 <> 9",
        "normalized_map": f'with {_VALUES} select seq, field, {fold} "value" from lng group by seq, field',
        "flat_profile": f'with {_VALUES} select seq, field, min_by("value", p) "value" from lng group by seq, field',
        "multi_value_join": f"with {_VALUES} select seq, {fold} \"value\" from lng where field = 'DOC.Number' group by seq",
        "reject_reasons": f"with {_BASE} select seq, case when k % 31 = 15 then 'EMPTY_PAYLOAD' when k % 17 = 8 then 'BAD_JSON' when k % 19 = 9 then 'NO_DATASET_CODE' when k % 23 = 11 then 'NO_CONTROL_AREA' end reason from c",
        "control_area_lookup": f"with {_BASE} select seq, 'AREA_' || area control_area from good",
        "field_rules": f"with {_RULES} select scope, field, rule_name, count(*) n from res group by all",
        "rule_eval": f"with {_RULES} select seq, scope, rule_ as rule, status, raised from res",
        "rule_eval_arrow": f"with {_RULES} select seq, scope, rule_ as rule, status, raised from res",
        "error_texts": f"with {_RULES} select seq, scope, field, error_text from res where error_text is not null",
        "field_status": f"with {_RULES} select seq, scope, field, case max(rank_) when 2 then 'ERROR' when 1 then 'WARNING' else 'SUCCESS' end status from res group by seq, scope, field",
        "record_status": f"with {_RULES} select seq, all_result from rec",
        "process_status": f"with {_RULES} select seq, process_status from rec",
        "detail_bucket": f"with {_RULES}, f as (select seq, scope, field, string_agg(rule_ || '=' || status, ',' order by rule_) rules from res group by seq, scope, field) select seq, scope, string_agg(field || ': ' || rules, '; ' order by field) bucket from f group by seq, scope",
        "replies": f"with {_RULES} select lpad(upper(to_hex(seq)), 16, '0') || repeat('0', 32) event_id, 'q' || seq query_id, process_status, all_result from rec",
        "mask_json": f"""with {_BASE} select seq, '"fullName":"***","segment":"' || c_mktsegment || '","balance":"***' masked from ok""",
        "mask_json_whole": f"""with {_MASKED} select seq, case when k % 31 = 15 then ' ' || chr(9) || ' ' else before || '"***"' || between_ || '"***"'
            || case when k % 17 <> 8 then after_ when half >= shown then substr(after_, 1, half - shown) end end masked from cut""",
        "version_acceptance": f"with {_CONTROL} select seq, cache, version from acc",
        "handler_changes": f"with {_CONTROL} select seq, handler from hc",
        "handler_asof": f"with {_CONTROL} select c_custkey seq, coalesce((select max_by(handler, hc.seq) from hc where hc.seq <= c_custkey), 'flink') handler from customer",
        "policy_asof": f"with {_CONTROL} select c_custkey seq, coalesce((select max_by(version, acc.seq) from acc where cache = 'politics' and acc.seq <= c_custkey), -1) policy_version from customer",
        "control_rejects": f"""with {_CONTROL}, r as (select seq, case when not valid then 'INVALID_EVENT' when cache = 'handler' and handler = 'other' then 'UNKNOWN_HANDLER' when cache = 'other_cache' then 'UNKNOWN_CACHE' end reason from ctl)
            select seq, reason from r where reason is not null""",
        "config_hash": f"with {_CONFIG} select job, run, hash from h",
        "config_change": f"with {_CONFIG} select job, run, hash from (select *, lag(hash) over (partition by job order by run) b from h) where b is not null and b <> hash",
        "cef_lines": """select event_id, 'CEF:0|ORG|recordgate|1|' || event_type || '|' || upper(event_type[1]) || event_type[2:] || '|1|externalId=' || event_id || ' rt=' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' outcome=' || case when event_type = 'error' then 'failure' else 'success' end || ' suser=u\\=' || user_id line from events""",
        "short_answer": f"with {_ANSWERS} select seq, answer from sa",
        "short_errors": f"with {_ANSWERS} select seq, errors from er",
        "detail_answer": f"with {_ANSWERS} select seq, detail_answer from da",
        "reply_out": f"with {_ANSWERS} select seq, lpad(upper(to_hex(seq)), 16, '0') || repeat('0', 32) correlation_id, answer body, 'X_CreateDateTime=2024-01-01T00:00:00.000Z;X_From=gate;X_ServiceID=s1' headers from sa",
        "audit_lines": f"""with {_ANSWERS}, p as (with {_WHOLE} select * from payload) select lpad(upper(to_hex(seq)), 16, '0') || repeat('0', 32) event_id, '{{"eventId":"' || lpad(upper(to_hex(seq)), 16, '0') || repeat('0', 32)
            || '","requestJson":' || payload || ',"shortAnswerJson":' || answer || ',"detailAnswerJson":' || detail_answer || ',"actionDttm":"2024-01-01T00:00:00.000Z","status":"PROCESSED"}}' line from sa join da using (seq) join p using (seq)""",
        "shadow_copies": f"""with {_WHOLE}, {_CONTROL} select seq, payload from payload where trim(payload, ' ' || chr(9)) <> '' and (select max_by(handler, hc.seq) from hc where hc.seq <= payload.seq) = 'dotnet'""",
        "judged_here": f"with {_CONTROL} select c_custkey seq from customer where coalesce((select max_by(handler, hc.seq) from hc where hc.seq <= c_custkey), 'flink') <> 'dotnet'",
        "external_answers": """select c_custkey event_id, case when c_custkey % 7 > 3 then '{"k":' || c_custkey || '}' end answer, case when c_custkey % 7 > 3 and c_custkey % 3 = 1 then '{"n":' || c_custkey || '}' end detail_answer,
            case when c_custkey % 7 <= 3 then 'NO_EXTERNAL_ANSWER' end reason from customer where c_custkey % 7 <> 0""",
        "request_landing": """with r as (select c_custkey seq, c_custkey k, c_name, case when c_custkey % 10 = 1 then 'UNSUPPORTED_BODY' when c_custkey % 10 > 1 and c_custkey % 6 = 4 then 'UNSUPPORTED_CODE_PAGE' end reason from customer)
            select seq, case when reason is null then c_name || case when k % 10 = 0 then '' else ' é' end end payload, case when reason is null and k % 4 - 1 > 0 then k % 4 - 1 end created_dttm, case when reason is null and k > 0 then k end readed_dttm, reason from r""",
        "normalized_map_spaced": f'with {_VALUES} select seq, field, {fold} "value" from lng group by seq, field',
        "mask_spaced": f"""with {_MASKED}, x as (select seq, k, replace(replace(before || secret1 || between_ || secret2 || after_, '":', '" : '), ',"', ' ,' || chr(10) || ' "') spaced, before || secret1 || between_ || secret2 || after_ whole, half from cut),
            y as (select seq, k, replace(replace(case when k % 17 = 8 then substr(whole, 1, half) else whole end, '":', '" : '), ',"', ' ,' || chr(10) || ' "') t from x)
            select seq, cast(case when k % 31 = 15 then 0 else len(regexp_extract_all(t, '"(fullName|balance|clientIdCard)" : ["\\[0-9-]')) end as int) masked from y""",
        "mask_fields": f"""with {_VALUES} select seq, field, case when field = 'DOC.Number' then '***' else {fold} end "value" from lng group by seq, field""",
        "flat_lines": f"""with {_BASE} select seq, '{{"BASE.Name":' || case when k % 11 = 5 then 'null' else '"' || c_name || '"' end || case when k % 13 = 6 then '' else ',"BASE,Segment":"' || c_mktsegment || '"' end
            || ',"BASE.Balance":' || regexp_replace(cast(cast(c_acctbal as decimal(12, 2)) as varchar), '\\.?0+$', '') || ',"BASE.Note":' || case when k % 7 = 3 then 'null' else '"x"' end || ',"{GENDER_FIELD}":"' || case k % 3 when 0 then 'MALE' when 1 then 'female' else 'other' end || '"'
            || coalesce(case when k % 29 <> 14 then ',"DOC.Number":"' || (select min(o_orderkey) from orders where o_custkey = k) || '"' end, '') || ',"ADDR.City":"' || n_name || '"}}' line from ok""",
        "rule_payloads": "select 'Rule' || p_partkey rule_name, case when p_partkey % 13 <> 0 then p_name end predicate, case when p_partkey % 13 <> 0 then cast(strlen(p_name) as bigint) end n_bytes from part where p_partkey % 11 <> 0 and p_partkey % 7 <> 0",
        "payload_stats": "select count(*) n_rules, cast(coalesce(sum(strlen(p_name)), 0) as bigint) n_bytes from part where p_partkey % 11 <> 0 and p_partkey % 7 <> 0 and p_partkey % 13 <> 0",
        "event_lines": f"""with {_EVENTS} select event_id, 'CEF:0|ORG|recordgate|1|' || class || '|' || title || '|1|externalId=' || n || ' suser=' || usr || ' sntdom=DOM src=10.0.0.1 smac=aa:bb shost=node-1 duser=' || usr || ' dntdom=DOM dst=' || dst
            || ' dmac=' || case when v in (2, 4) then 'aa:bb' else '' end || ' dhost=' || case when v = 4 then 'node-1' else '' end || ' spt=8081 dpt=' || dpt || ' app=' || proto || ' start=' || epoch_us(ts) // 1000 || ' end= msg=' || title || '; eventId\\=' || event_id
            || '; clusterId\\=' || case when event_id % 3 = 0 then 'c2' else 'c1' end || '; jobName\\=gate; status\\=' || coalesce(st, 'SUCCESS') || case when event_id % 4 = 0 then '; subtaskIndex\\=' || event_id % 8 else '' end
            || case v when 1 then '; topic\\=in|out' when 3 then '; errorMessage\\=a\\nb' when 4 then '; queue\\=Q1' else '' end || '; dst\\=' || dst || ':' || dpt || ' deviceProcessName=recordgate-1 outcome=' || case when st = 'failed' then 'failure' else 'success' end line from x""",
        "event_documents": f"""with {_EVENTS} select event_id, '{{"eventId":"' || event_id || '","eventTime":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z","eventType":"' || kind || '","eventClass":"' || class || '","eventName":"' || title || '","status":' || coalesce('"' || st || '"', 'null')
            || ',"jobName":"gate","jobVersion":"1","clusterId":' || case when event_id % 3 = 0 then '"c2"' else 'null' end || ',"hostname":"node-1","subtaskIndex":' || case when event_id % 4 = 0 then cast(event_id % 8 as varchar) else 'null' end || ',"parallelism":null,"payload":'
            || case v when 0 then '{{"brokerUrl":"ssl://u@mq' || event_id || '.x:61617?a=b,tcp://other:1","user":"us=er' || event_id || '"}}' when 1 then '{{"bootstrap":" [::' || event_id % 9 || ']:9093,h2:1","topic":"in|out"}}' when 2 then '{{"host":"10.0.0.1","port":"-3","tlsEnabled":"TRUE"}}'
              when 3 then '{{"bootstrap":"h' || event_id || ':bad","protocol":"<empty>","errorMessage":"a\\nb"}}' else '{{"queue":"Q1"}}' end || '}}' document from x""",
    }
