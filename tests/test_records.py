"""Small cases of the record operators, with made-up content."""

import json

import pytest
from pyspark.sql import functions as F

from recordgate.functions import text
from recordgate.operators import answers as answers_
from recordgate.operators import delivery, flatten, job_events, policy, validate
from recordgate.plans import registry
from recordgate.sources import messages as src
from recordgate.streaming import gate

SCHEMA = "msg_id binary, jms_id string, payload string, seq long"


def message(spark, *payloads):
    rows = [(bytes([i]), None, p if isinstance(p, str) or p is None else json.dumps(p, separators=(",", ":")), i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, SCHEMA)


def test_refusals(spark):
    got = flatten.decode(message(spark, None, " \t", "{", "[1]", {"data": {}})).orderBy("seq").collect()
    assert [r.reason for r in got] == ["EMPTY_PAYLOAD", "EMPTY_PAYLOAD", "BAD_JSON", "BAD_JSON", None]
    assert got[0].event_id == "00" * 24


def test_repeated_names_join_and_first_wins(spark):
    doc = {"data": {"a": {"x": None, "y": "1", "mapping.x": "N", "mapping.y": "N"}, "b": [{"z": "2", "mapping.z": "N"}, {"z": "none", "mapping.z": "N"}]}}
    long = flatten.mappings(flatten.walk(flatten.decode(message(spark, doc))))
    assert [r.value for r in flatten.normalized(long).collect()] == ["1;2;null"]
    assert [r.value for r in flatten.flat_profile(long).collect()] == [None]


def test_mapping_names(spark):
    doc = {"data": {"a": {"x": "1", "y": "2", "w": "3", "mapping.x": "none", "mapping.y": None, "mapping.w": " W "}}}
    long = flatten.mappings(flatten.walk(flatten.decode(message(spark, doc))))
    assert [(r.field, r.value) for r in long.collect()] == [(" W ", "3")]
    assert [r.field for r in flatten.flat_profile(long).collect()] == ["W"]


def test_too_deep_is_marked(spark):
    doc = {"data": {"a": {"b": {"c": {"d": {"mapping.x": "X", "x": 1}}}}}}
    assert flatten.walk(flatten.decode(message(spark, doc)), 2).filter("too_deep").count() == 1


def nested(levels, name="BASE.Note", leaf=None):
    """A message whose mapped value lies in an object at path length ``levels``."""
    inner = {"x": leaf, "mapping.x": name}
    for i in range(levels - 1):
        inner = [inner] if i % 2 else {"c": inner}
    return {"dfw_query_id": "q", "data": {"baseInfo": {"dataset_code": "D.Base.A", "n": "x", "mapping.n": "BASE.Name"}, "b": inner}}


def test_depth_is_whole_or_refused(spark):
    tricky = nested(7, leaf="ok")
    tricky["data"]["baseInfo"]["n"] = '[{"[{[{[{[{[{\\'
    source = message(spark, nested(6), nested(7), nested(8), nested(9), tricky)
    rules, now = registry.load_policy(spark), F.lit("2024-01-01 00:00:00").cast("timestamp")
    decoded = flatten.decode(source)
    by_walk = {r.seq for r in flatten.walk(decoded.withColumn("reason", F.lit(None).cast("string"))).filter("too_deep").collect()}
    assert {r.seq: r.reason for r in validate.resolved(decoded, rules).collect()} == {i: "TOO_DEEP" if i in by_walk else None for i in range(5)}
    assert by_walk == {2, 3}
    long = flatten.normalized(flatten.mappings(flatten.walk(decoded)))
    assert sorted(r.seq for r in long.filter("field = 'BASE.Note'").collect()) == [0, 1, 4]
    answers, rejects = gate.process(source, rules, registry.PREDICATES, now)

    def status(node):
        return node if isinstance(node, str) else status(next(iter(node.values() if isinstance(node, dict) else node)))

    got = {r.seq: json.loads(r.answer)["data"]["details"] for r in answers.collect()}
    # a top-level array is judged, but only top-level objects have a place in the answer
    assert {i: status(d["b"]) for i, d in got.items() if "b" in d} == {0: "WARNING"}
    assert {i: d["ALL_RESULT"] for i, d in got.items()} == {0: "WARNING", 1: "WARNING", 4: "SUCCESS"}
    assert {r.seq: r.reason for r in rejects.collect()} == {2: "TOO_DEEP", 3: "TOO_DEEP"}


def test_mask_reaches_broken_payloads(spark):
    payloads = ['{"a":{"INN":"12","b":1},"inn":-3.5,"x":"inn"}', '{"inn":"12","x":[{"inn":"345', '{"inn":"12\\\\', '{"inn":"1\\"2","x":1', " ", None]
    source = spark.createDataFrame(list(enumerate(payloads)), "seq long, payload string")
    got = {r.seq: r.masked for r in source.select("seq", text.mask_json(F.col("payload"), ["inn"]).alias("masked")).collect()}
    assert got == {0: '{"a":{"INN":"***","b":1},"inn":"***","x":"inn"}', 1: '{"inn":"***","x":[{"inn":"***"', 2: '{"inn":"***"', 3: '{"inn":"***","x":1', 4: " ", 5: None}


def test_whole_masked_payloads_equal_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for name in ("customer", "nation", "region", "orders"):
        db.sql(f"create view {name} as select * from '{sf}/{name}.parquet'")
    want = dict(db.sql(registry.oracle_sql()["mask_json_whole"]).fetchall())
    got = {r.seq: r.masked for r in registry.queries()["mask_json_whole"](spark, sf).collect()}
    assert got == want and len(got) == db.sql("select count(*) from customer").fetchall()[0][0]
    assert {8, 15} <= got.keys()


def test_versions_and_handlers(spark):
    rows = [(1, '{"cacheName":" politics ","version":4}'), (2, '{"cacheName":"politics","version":3}'), (3, '{"cacheName":"politics","version":5}'), (4, "{"), (5, '{"cacheName":"handler","handler":"DotNet","version":0}'), (6, '{"cacheName":"handler","handler":"x","version":0}')]
    events = src.decode_control(spark.createDataFrame(rows, "seq long, value string"))
    assert [(r.seq, r.version) for r in policy.accepted_versions(events).orderBy("seq").collect()] == [(1, 4), (3, 5)]
    assert [(r.seq, r.handler) for r in policy.handler_changes(events).collect()] == [(5, "dotnet")]
    assert {r.seq: r.reason for r in policy.control_rejects(events).collect()} == {4: "INVALID_EVENT", 6: "UNKNOWN_HANDLER"}


def test_stream_equals_batch(spark, tmp_path):
    doc = lambda code, name: {"dfw_query_id": "q", "data": {"baseInfo": {"dataset_code": code, "n": name, "mapping.n": "BASE.Name"}}}
    source = message(spark, doc("D.Base.A", "x"), doc("D.Base.A", None), doc("D.Base.B", "y"), doc("D.No", "y"), "{")
    source.write.parquet(str(tmp_path / "in"))
    rules, now = registry.load_policy(spark), F.lit("2024-01-01 00:00:00").cast("timestamp")
    answers, rejects = gate.process(spark.read.parquet(str(tmp_path / "in")), rules, registry.PREDICATES, now)
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    gate.start(stream, lambda: rules, registry.PREDICATES, str(tmp_path / "out"), str(tmp_path / "checkpoint"), now).awaitTermination()
    again = spark.read.parquet(str(tmp_path / "out/answers")).drop("batch")
    assert sorted(map(str, again.collect())) == sorted(map(str, answers.collect()))
    assert {r.seq: r.reason for r in rejects.collect()} == {3: "NO_CONTROL_AREA", 4: "BAD_JSON"}


def test_raising_python_rule_is_isolated(spark):
    doc = {"data": {"baseInfo": {"dataset_code": "D.Base.A", "n": "x", "mapping.n": "BASE.Name"}}}
    rules = registry.load_policy(spark)
    good = validate.resolved(flatten.decode(message(spark, doc)), rules).filter("reason is null")
    long = validate.evaluate(good, rules, {}, {"Rule1001": lambda m: 1 / 0})
    assert validate.record_status(long).collect()[0][1:] == ("SUCCESS", "RULE_EXCEPTION")


def now():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")



def built(spark, bundle, predicates, *docs):
    doc = spark.range(1).select(F.from_json(F.lit(json.dumps(bundle)), policy.BUNDLE_SCHEMA).alias("b")).select("b.*")
    rules = policy.from_bundle(doc)
    good = validate.resolved(flatten.decode(message(spark, *docs)), rules).filter("reason is null")
    rows = answers_.build(good, validate.evaluate(good, rules, predicates), rules, now()).orderBy("seq").collect()
    return [(json.loads(r.answer)["data"], json.loads(r.detail_answer)) for r in rows]


def test_null_like_and_masks_on_spaced_json(spark):
    texts = ['{ "a": "none", "b" : "" , "c":"NONE \\t", "d": ["none", ""], "e": "x: \\"none\\"" , "f" :" none "}', '{"inn": "7701", "x" : {"Number" :  {"a":["}",1],"b":2} , "series":[{"q":1}], "y": true}}', '{"inn" : 12, "departmentCode": null, "k": "inn"']
    source = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq int, t string")
    got = [r for r in source.orderBy("seq").select(text.null_like_json(F.col("t")).alias("n"), text.mask_json(F.col("t")).alias("m"), text.mask_inline(F.col("t")).alias("i")).collect()]
    assert json.loads(got[0].n) == {"a": None, "b": None, "c": None, "d": ["none", ""], "e": 'x: "none"', "f": None}
    assert json.loads(got[1].m) == {"inn": "***", "x": {"Number": "***", "series": "***", "y": True}}
    assert got[2].m == '{"inn":"***", "departmentCode":"***", "k": "inn"'
    assert got[1].i == texts[1] and text.MASK == "***"


BUNDLE = {
    "version": " ",
    "dataset2ControlArea": {"D1": "A", "D2": "B"},
    "controlAreaRules": {"A": {"F.One": ["Rule1"], "F.Two": ["2"], "F.Six": ["Rule6"]}, "B": {"F.One": ["Rule1"]}},
    "errorMessages": {"Rule1": {"errorDescription": "prefixed"}, "1": {"errorDescription": "bare"}, "Rule2": {"errorDescription": "two", "classification": "Inform"}},
    "datasetExclusion": {"A": ["x"]},
    "filterFlag": {"B": True},
}
HITS = {"Rule1": "m['F.One'] = 'bad'", "Rule2": "m['F.Two'] is null", "Rule6": "m['F.Six'] is null"}


def test_nested_fields_of_an_excluded_block(spark):
    """They are judged in the block's scope, which takes its flag from its own area, and the main scope loses them."""
    doc = {"data": {"a": {"dataset_code": "D1", "p": "bad", "mapping.p": "F.One", "t": "v", "mapping.t": "F.Two"}, "x": {"dataset_code": "D2", "deep": {"q": "good", "mapping.q": "F.One"}}}}
    (short, detail), = built(spark, BUNDLE, HITS, doc)
    assert short["details"]["a"] == {"dataset_code": "D1", "p": "SUCCESS", "t": "SUCCESS"}
    assert short["details"]["x"] == {"dataset_code": "D2", "deep": {"q": "SUCCESS"}}
    assert (short["details"]["ALL_RESULT"], short["PROCESS_STATUS"], short["details"]["errors"]) == ("SUCCESS", "RULE_EXCEPTION" if False else "OK", {})
    assert detail["detail_results"] == {"D2": {"F.One": {"1": "SUCCESS"}, "ALL_RESULT": "SUCCESS"}, "UNKNOWN_DATASET": {"F.Two": {"2": "SUCCESS"}, "ALL_RESULT": "SUCCESS"}}


def test_answer_of_a_record_without_rules_and_envelope(spark):
    plain = {"dfw_query_id": "q1", "dfw_hostname": "h", "dfw_user_login": 7, "dfw_dataset_code": "D1", "data": {"a": {"dataset_code": "D1", "z": 1, "mapping.z": "Other"}}}
    (short, detail), = built(spark, BUNDLE, HITS, plain)
    assert {k: v for k, v in short.items() if k != "details"} == {"dfw_query_id": "q1", "dfw_hostname": "h", "dfw_user_login": 7, "dfw_dataset_code": "D1", "dfw_action_type": "ANSWER", "dfw_created_dttm": None, "dfw_readed_dttm": None, "dfw_action_dttm": "2024-01-01T00:00:00.000Z", "PROCESS_STATUS": "OK"}
    assert short["details"] == {"ALL_RESULT": "SUCCESS", "errors": {}}
    assert detail["detail_results"] == {"D1": {"ALL_RESULT": "SUCCESS"}}


def test_answer_trees(spark):
    """Arrays, nested objects, elemId, names with commas, local names, dropped empties and the errors of cards."""
    card = lambda v, i: {"elemId": i, "n": v, "mapping.n": "F,One", "more": {"w": 1}}
    doc = {"data": {"s": "text", "a": {"dataset_code": "D1", "mapping.o": "F.One", "o": "bad", "mapping.g": None, "g": "x", "none": {"mapping.u": "Unknown", "u": 1}}, "documents": {"clientIdCard": [card("bad", "1"), 5, [card("bad", "9")], {"k": 1}]}}}
    bundle = {**BUNDLE, "filterFlag": {"A": True}, "controlAreaRules": {"A": {"F.One": ["1"], "F,One": ["Rule1"], "g": ["2"]}}}
    (short, _), = built(spark, bundle, HITS, doc)
    # the flag lifts F,One to F.One: one value for both
    assert short["details"]["a"] == {"dataset_code": "D1", "o": "ERROR", "g": "WARNING"}
    assert short["details"]["documents"] == {"clientIdCard": [{"n": "SUCCESS", "elemId": "1"}]} or short["details"]["documents"] == {"clientIdCard": [{"n": "ERROR", "elemId": "1"}]}
    assert short["details"]["errors"]["a"] == {"o": ["bare"]}
    assert short["details"]["ALL_RESULT"] == "ERROR"


def test_flat_profile_keeps_types(spark):
    base = {"name": "n", "age": 5, "note": "", "mapping.name": "Name", "mapping.age": " Age ", "mapping.note": "Note", "mapping.gone": "Gone", "mapping.bad": "null", "inner": {"mapping.q": "Inner", "q": 1}}
    docs_ = {"inn": "1", "mapping.inn": "Inn", "clientIdCard": [{"primary": True, "list": [1, {"b": 2}], "mapping.primary": "Primary", "mapping.list": "List"}, 3, {"primary": False, "mapping.primary": "Primary"}]}
    cases = [
        ({"data": {"base": base, "documents": docs_}}, {"Name": "n", "Age": 5, "Note": None, "Gone": None, "Inn": "1", "Primary": True, "List": [1, {"b": 2}]}),
        ({"data": {"base": {**base, "mapping.name": None}}}, {"Age": 5, "Note": None, "Gone": None}),
        ({"data": {"base": {**base, "name": None, "mapping.age": "none"}}}, {"Name": None, "Note": None, "Gone": None}),
        ({"data": {"base": {"mapping.a": "Same"}, "other": {"a": 1, "mapping.a": "Same"}}}, {"Same": None}),
        ({"data": {"cards": {"clientIdCard": [{"a": 1, "mapping.a": "A"}], "mapping.c": "C", "c": "none"}}}, {"C": None}),
    ]
    got = {r.seq: json.loads(r.line) for r in flatten.profile_lines(flatten.decode(message(spark, *[c[0] for c in cases]))).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_running_equals_plain_loops(spark):
    import random

    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b"]), rng.choice([None, rng.randrange(9)])) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, k string, v long").repartition(5)
    for how in ("last", "max"):
        got = {r.seq: r.before for r in policy.running(df, "v", how, ("k",)).collect()}
        held, want = {}, {}
        for i, k, v in rows:
            want[i] = held.get(k)
            if v is not None:
                held[k] = v if how == "last" or held.get(k) is None else max(held[k], v)
        assert got == want
    assert policy.running(df.filter("false"), "v", "last").count() == 0


def test_addresses_and_names(spark):
    row = spark.createDataFrame([("ssl://u@h.x:61617?trustStorePassword=s&b=c,tcp://o:1", "[::1]:9093,h2:1", "h:bad", "IBM_MQ_SINK_CONNECTED")], "u string, b string, c string, k string")
    got = row.select(
        text.url_scheme(F.col("u")), text.url_host(F.col("u")), text.url_port(F.col("u")), text.mask_url(F.col("u")), text.server_host(F.col("b")), text.server_port(F.col("b")), text.server_host(F.col("c")), text.server_port(F.col("c")),
        job_events.event_class(F.col("k")), job_events.event_title(F.col("k")), text.preview(F.col("k"), 3), text.versioned_name(F.lit("n"), F.lit(3)), text.version_of(F.lit("n_x_12")), text.version_of(F.lit("n")), text.json_or_text(F.lit("{")),
        text.null_like(F.lit(" none ")), text.local_name(F.lit("mapping. a ")),
    ).first()
    assert tuple(got) == ("ssl", "h.x", 61617, "ssl://u@h.x:61617?trustStorePassword=***&b=c,tcp://o:1", "::1", 9093, "h", None, "IBM_MQ_SINK", "IBM MQ Sink Connected", "IBM...", "n_3", 12, None, '"{"', None, "a")


def test_policy_parts(spark, tmp_path):
    rules = registry.load_policy(spark)
    root = str(tmp_path / "policy")
    parts = {n: getattr(rules, n) for n in policy.PARTS}
    policy.publish(parts, 7, root)
    assert policy.newest(spark, root).version == "7"
    # a version whose pointers are not all there is not taken
    rules.area.write.parquet(f"{root}/area/version=8")
    spark.createDataFrame([("area", 8)], "part string, version long").write.mode("append").parquet(f"{root}/pointers")
    newest = policy.newest(spark, root)
    assert newest.version == "7" and newest.area.count() == rules.area.count()
    assert {r.part: r.n for r in newest.sizes().collect()} == {r.part: r.n for r in rules.sizes().collect()}
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    assert [r.version for r in policy.consistent_version(names("a_3", "b_3")).collect()] == [3]
    assert policy.consistent_version(names("a_3", "b_4")).count() == policy.consistent_version(names("a_3", "b")).count() == 0
    caches = spark.createDataFrame([("c", '{"a":["x"]}')], "cache string, payload string")
    assert policy.decode_cache(caches, "lists").first().entries == {"a": ["x"]}
    with pytest.raises(Exception, match="unreadable payload of cache d"):
        policy.decode_cache(spark.createDataFrame([("d", '{"a":null}')], "cache string, payload string"), "lists").collect()


def test_bundle_file_and_json_lines(spark, tmp_path):
    (tmp_path / "bundle.json").write_text(json.dumps({"version": " ", "filterFlag": {"A": True}}, indent=1))
    got = policy.read_bundle(spark, str(tmp_path / "bundle.json"))
    assert got.version == "test" and got.rules.count() == 0 and got.flags.count() == 1
    (tmp_path / "lines.txt").write_text(' {"a":1} \n\n[1]\nx\n{"b":2}\n')
    assert [r.payload for r in src.read_json_lines(spark, str(tmp_path / "lines.txt")).collect()] == ['{"a":1}', '{"b":2}']


def test_stream_routes_and_swaps_the_policy(spark, tmp_path):
    doc = lambda i: {"dfw_query_id": f"q{i}", "data": {"a": {"dataset_code": "D.Base.A", "n": None, "mapping.n": "BASE.Name"}}}
    source = message(spark, *[doc(i) for i in range(6)])
    rules = registry.load_policy(spark)
    changes = spark.createDataFrame([(2, "dotnet"), (4, "flink")], "seq long, handler string")
    taken = []

    def policy_of_batch():
        if len(taken) == 1:
            taken.append("fails")
            raise RuntimeError("policy store is away")
        taken.append("ok")
        return rules

    out, at = str(tmp_path / "out"), str(tmp_path / "in")
    for part in ("seq < 3", "seq >= 3"):
        source.filter(part).coalesce(1).write.mode("append").parquet(at)
        gate.start(spark.readStream.schema(SCHEMA).parquet(at), policy_of_batch if part == "seq < 3" else lambda: rules, registry.PREDICATES, out, str(tmp_path / "cp"), now(), handlers=lambda: changes).awaitTermination()
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert sorted(r.seq for r in read("answers").collect()) == [0, 1, 4, 5]
    assert sorted(r.seq for r in read("shadow").collect()) == [2, 3]
    assert sorted(r.correlation_id[:2] for r in read("replies").collect()) == ["00", "01", "04", "05"]
    line = json.loads(read("audit").first().line)
    assert line["status"] == "PROCESSED" and line["requestJson"]["data"] and line["detailAnswerJson"]["dfw_action_type"] == "ANSWER_DETAIL"
    assert taken == ["ok"]


def test_replies_need_an_id(spark):
    answered = spark.createDataFrame([(1, "e", "{}"), (2, "e", "{}"), (3, "e", " ")], "seq long, event_id string, answer string")
    ids = spark.createDataFrame([(1, None, "j"), (2, None, " "), (3, b"1", None)], "seq long, msg_id binary, jms_id string")
    sent, lost = delivery.replies(answered, ids, now(), "me", "svc")
    assert [(r.seq, r.correlation_id, r.headers["X_From"], r.headers["X_ServiceID"]) for r in sent.collect()] == [(1, "j", "me", "svc")]
    assert [(r.seq, r.reason) for r in lost.collect()] == [(2, "NO_MESSAGE_ID")]


def test_event_sink_appends(spark, tmp_path):
    lines = spark.createDataFrame([(2, "b"), (1, "a")], "event_id long, line string").coalesce(1)
    for _ in range(2):
        job_events.append_lines(lines, str(tmp_path / "events"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "events")).collect()) == ["a", "a", "b", "b"]


@pytest.mark.parametrize("query", ["normalized_map", "normalized_map_spaced", "flat_profile", "mask_fields"])
def test_balances_that_round_to_zero_equal_sql(spark, tmp_path, query):
    """The message holds a decimal amount, which has no negative zero."""
    duckdb = pytest.importorskip("duckdb")
    db, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for name in ("customer", "nation", "region", "orders"):
        table = spark.read.parquet(f"{sf}/{name}.parquet")
        if name == "customer":
            table = table.withColumn("c_acctbal", F.expr("case c_custkey % 5 when 0 then -0.0D when 1 then -0.004D when 2 then 0.0D else c_acctbal end"))
        table.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
        db.sql(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = sorted(db.sql(f'select seq, field, "value" from ({registry.oracle_sql()[query]})').fetchall(), key=str)
    got = sorted((tuple(r) for r in registry.queries()[query](spark, str(tmp_path)).select("seq", "field", "value").collect()), key=str)
    assert got == want and (1, "BASE.Balance", "0.0") in got


def test_profile_texts_walk_a_message_once(spark):
    import contextlib
    import io

    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        flatten.profile_texts(flatten.decode(spark.createDataFrame([], "seq long, msg_id binary, jms_id string, payload string"))).explain(True)
    plan = shown.getvalue().split("== Analyzed Logical Plan ==")[1].split("== Optimized Logical Plan ==")[0]
    # three levels of the walk and the choice of its sections
    assert plan.count("Generate inline(") == 4 and "Join" not in plan


def test_texts_that_are_not_asked_for_are_not_made(spark):
    import contextlib
    import io

    for part, absent in (("answer", "_each"), ("detail_answer", "_tops"), (None, "_tops")):
        shown = io.StringIO()
        with contextlib.redirect_stdout(shown):
            registry._built(spark, "/root/testdata/sf0.001", *([part] if part else [])).explain()
        assert absent not in shown.getvalue()


def test_nodes_are_walked_in_their_row(spark):
    import contextlib
    import io

    empty = spark.createDataFrame([], "seq long, msg_id binary, jms_id string, payload string")
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        flatten.message_nodes(flatten.decode(empty)).explain()
    assert "Exchange" not in shown.getvalue()


def test_strings_that_look_like_objects_are_not_opened(spark):
    """As they stand, after an escaped bracket, and after a quote; without any such string types are told by the first character."""
    inner = '{\\"dataset_code\\":\\"D.Base.B\\",\\"mapping.x\\":\\"X\\"}'
    real = '"b":{"dataset_code":"D.Base.A","l":[1,[{"mapping.y":"Y","y":2}],"z"],"mapping.n":"N"}'
    payloads = [f'{{"data":{{{before}{real}}}}}' for before in (f'"a":"{inner}",', '"a":"' + inner.replace("{", "\\u007b", 1) + '",', '"a":"\\"{",', '"a":"[1]",', "")]
    got = validate.resolved(flatten.decode(message(spark, *payloads)), registry.load_policy(spark)).orderBy("seq")
    assert [r.dataset_code for r in got.collect()] == ["D.Base.A"] * 5
    nodes = {r.seq: [(n.name, n.type, len(n.path), [f.logical for f in n.fields]) for n in r.nodes] for r in flatten.message_nodes(got).collect()}
    assert nodes == {i: [("", "OBJECT", 0, []), ("b", "OBJECT", 1, ["N"]), ("l", "ARRAY", 2, []), ("", "ARRAY", 3, []), ("", "OBJECT", 4, ["Y"])] for i in range(5)}
    walked = flatten.walk(flatten.decode(message(spark, *payloads))).groupBy("seq").count().collect()
    assert {r["count"] for r in walked} == {5}


def test_array_answers_walk_a_message_once(spark):
    import contextlib
    import io

    from recordgate.plans import versions

    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        versions.queries()["array_answers"](spark, "/root/testdata/sf0.001").explain()
    assert shown.getvalue().count("message too deep for this walk") == 1


@pytest.mark.parametrize("excluding", [False, True])
def test_results_made_in_the_row_are_those_of_the_long_table(spark, excluding):
    """Coded fields, flags, several rules a field, rules that raise or have no body; with and without excluded blocks."""
    import dataclasses

    whole = registry.load_policy(spark)
    held = whole if excluding else dataclasses.replace(whole, exclusion=whole.exclusion.filter("false"))
    good = flatten.message_nodes(validate.resolved(flatten.decode(src.derived_messages(spark, "/root/testdata/sf0.001")), held).filter("reason is null"))
    now, predicates = F.lit(registry.NOW).cast("timestamp"), {**registry.PREDICATES, "Rule1002": "if(m['BASE.Segment'] = 'BUILDING', cast(m['BASE.Name'] as int) > 0, cast(m['BASE.Balance'] as double) < 0)"}
    want = answers_.build(good, validate.evaluate(good, held, predicates), held, now).collect()
    got = answers_.build(answers_.with_results(good, held, predicates), None, held, now).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and {r.process_status for r in got} == {"OK", "RULE_EXCEPTION"}
