"""Control events, versions, rule sets as data, redelivery and commits, in batch and stream."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from recordgate.functions import text
from recordgate.operators import delivery, flatten, job_events, policy, rulebook, validate
from recordgate.plans import versions
from recordgate.sources import messages as src
from recordgate.streaming import gate

MESSAGES = "seq long, msg_id binary, jms_id string, payload string, created_dttm long, readed_dttm long"
def now():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")



def body(predicate):
    return None if predicate is None else base64.b64encode(predicate.encode()).decode()


def rules(spark, **predicates):
    return spark.createDataFrame([(n, body(p)) for n, p in predicates.items()], "rule_name string, body string")


def name_policy(spark, rule, area="AREA"):
    """A policy that judges the field Name of dataset D by one rule."""
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    return policy.Policy(
        "1", table([("D", area)], "dataset_code string, control_area string"), table([(area, "Name", rule)], "control_area string, field string, rule_name string"), table([(rule, f"failed {rule}", "ERROR")], "rule_name string, error_description string, classification string"),
        table([], "control_area string, pos int, block string"), table([(area, True)], "control_area string, filter_flag boolean"),
    )


def publish_policy(spark, rule, version, store):
    one = name_policy(spark, rule)
    policy.publish({p: getattr(one, p) for p in policy.PARTS}, version, f"{store}/politics")


def message(i, name, seq="same", msg_id="own"):
    data = {"dfw_query_id": f"q{i}", "data": {"b": {"dataset_code": "D", "n": name, "mapping.n": "Name"}}}
    return (i if seq == "same" else seq, bytes([i]) if msg_id == "own" else msg_id, None, json.dumps(data), None, i)


def status(answers):
    return sorted((r.event_id[:2], json.loads(r.answer)["data"]["details"]["ALL_RESULT"]) for r in answers)


# --- publishes ----------------------------------------------------------------------------------


def test_a_failing_republish_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    assert policy.newest(spark, f"{root}/politics") is None
    publish_policy(spark, "1", 3, root)
    broken = {p: getattr(name_policy(spark, "2"), p) for p in policy.PARTS}
    broken["flags"] = broken["flags"].withColumn("filter_flag", F.raise_error(F.lit("store is away")).cast("boolean"))
    with pytest.raises(Exception, match="store is away"):
        policy.publish(broken, 3, f"{root}/politics")
    assert policy.newest(spark, f"{root}/politics").rules.first().rule_name == "1"
    publish_policy(spark, "2", 3, root)
    assert policy.newest(spark, f"{root}/politics").rules.first().rule_name == "2"
    # three attempts lie there, readers go by the pointers to whole ones
    assert policy.read_versioned(spark, f"{root}/politics/rules", 3).count() == 3
    with pytest.raises(ValueError, match="has no version 9"):
        policy.read_versioned(spark, f"{root}/politics/rules", 9)
    with pytest.raises(ValueError, match="has no version 9"):
        policy.of_versions(spark, f"{root}/politics", [3, 9])


def test_caches_of_one_version(spark):
    payload = {"politics_dataset2control_area": {"D": "A"}, "politics_control_area_rules": {"A": {"Name": ["1"]}}, "politics_error_messages": {"1": {"errorDescription": "e"}}, "politics_dataset_exclusion": {"A": ["b"]}, "politics_filter_flag": {"A": True}}
    rows = [(f"{n}_7", json.dumps(p)) for n, p in payload.items()]
    table = lambda r: spark.createDataFrame(r, "name string, payload string")
    got = policy.from_caches(table(rows))
    assert (got.version, got.rules.first().rule_name, got.errors.first().error_description, got.flags.first().filter_flag) == ("7", "1", "e", True)
    sizes = {r.part: (r.n, r.n_bytes > 0) for r in got.sizes(rules(spark, a="true")).collect()}
    assert sizes == dict.fromkeys([*policy.PARTS, "bodies"], (1, True))
    for bad in (rows[:4], [*rows[:4], ("politics_filter_flag_8", "{}")], [*rows[:4], ("politics_filter_flag", "{}")], [*rows, rows[0]]):
        with pytest.raises(ValueError, match="not those of one policy version"):
            policy.from_caches(table(bad))


# --- rule sets ----------------------------------------------------------------------------------


def test_rule_sets_are_refused_whole(spark, tmp_path):
    cases = {
        1: ([("a", body("m['x'] is null")), ("b", body("m['y'] = '1' -- why"))], None),
        2: ([("a", body("true")), (" ", body("true"))], (" ", "BLANK_NAME")),
        3: ([("a", body("true")), ("b", " ")], ("b", "EMPTY_BODY")),
        4: ([("a", "%%%"), ("b", "")], ("a", "UNDECODABLE_BODY")),
        5: ([("a", body("m['x'] ="))], ("a", "PARSE_SYNTAX_ERROR")),
        6: ([("a", body("other is null"))], ("a", "UNRESOLVED_COLUMN")),
        7: ([("a", body("m['x']"))], ("a", "DATATYPE_MISMATCH")),
        8: ([("a", body("exists (SELECT 1)"))], ("a", "SUBQUERY")),
        9: ([("a", body("count(*) > 0"))], ("a", "INVALID_WHERE_CONDITION")),
        10: ([("a", body("true")), ("a", body("false"))], ("a", "REPEATED_NAME")),
        11: ([("a", base64.b64encode(b"\xff\xfe").decode())], ("a", "UNDECODABLE_BODY")),
        12: ([("a", body("m['x'] = 'select'"))], None),
    }
    table = spark.createDataFrame([(v, n, b) for v, (rows, _) in cases.items() for n, b in rows], "version long, rule_name string, body string")
    good, refused = rulebook.checked(table, "version")
    got = {r.version: (r.rule_name, r.reason) for r in refused.collect()}
    assert got == {v: want for v, (_, want) in cases.items() if want}
    assert sorted((r.version, r.rule_name, r.predicate) for r in good.collect()) == [(1, "a", "m['x'] is null"), (1, "b", "m['y'] = '1' -- why"), (12, "a", "m['x'] = 'select'")]
    with pytest.raises(rulebook.RulesRefused, match="EMPTY_BODY in rule 'b'"):
        rulebook.publish_rules(rules(spark, a="true", b=None), 1, str(tmp_path))
    assert policy.published(spark, str(tmp_path), rulebook.PARTS).count() == 0
    assert rulebook.checked(table.drop("version").filter("false"))[1].count() == 0


def test_sql_errors_stay_in_their_row(spark):
    raising = ["1/0 > 1", "coalesce(1/0 > 1, false)", "cast(m['Name'] as int) > 1", "coalesce(cast(m['Name'] as int) > 1, false)", "element_at(array(1, 2), 5) = 1", "array(1)[3] = 1", "exists(array(m['Name']), x -> cast(x as int) = 1)", "raise_error('no') is null"]
    predicates = {f"Rule{i}": p for i, p in enumerate(raising)} | {"RuleGood": "m['Name'] = 'x'", "RuleNull": "null"}
    one = name_policy(spark, "RuleGood")
    one.rules = spark.createDataFrame([("AREA", "Name", n) for n in predicates], one.rules.schema)
    rows = spark.createDataFrame([message(1, "x"), message(2, "7")], MESSAGES)
    good = validate.resolved(flatten.decode(rows), one)
    for given in (predicates, rulebook.fixed(spark, predicates)):
        got = {(r.seq, r.rule_name): (r.status, r.raised) for r in validate.evaluate(good, one, given).collect()}
        assert {n for (s, n), (_, raised) in got.items() if s == 1 and raised} == {*predicates} - {"RuleGood"}
        assert got[1, "RuleGood"] == ("ERROR", False) and got[1, "Rule2"] == ("SUCCESS", True)
        assert got[2, "Rule2"] == ("ERROR", False) and got[2, "Rule3"] == ("ERROR", False) and got[2, "Rule6"] == ("SUCCESS", False)


# --- control events -----------------------------------------------------------------------------


def test_control_outcomes_equal_a_loop(spark):
    import random

    rng = random.Random(2)
    rows = []
    for i in range(300):
        cache = rng.choice(["politics", "compiled_rules", "Handler", "HANDLER", "other"])
        rows.append((i * (1 << 50) + 1, json.dumps({"cacheName": cache, "version": rng.choice([str, int])(rng.randrange(40)), "handler": rng.choice(["flink", "DotNet", "what", None])})))
    there = {(c, v): rng.choice([None, rng.randrange(300) * (1 << 50)]) for c in ("politics", "compiled_rules") for v in range(40) if rng.random() < 0.6}
    catalogue = spark.createDataFrame([(c, v, s) for (c, v), s in there.items()], "cache string, version long, since long")
    held = spark.createDataFrame([("politics", 3, None), ("handler", None, "dotnet")], "cache string, version long, handler string")
    events = src.decode_control(spark.createDataFrame(rows, "seq long, value string").repartition(5))
    got = {r.seq: r.outcome for r in policy.control_outcomes(events, catalogue, held).collect()}
    mark, handler, want = {"politics": 3, "compiled_rules": -1}, "dotnet", {}
    for seq, value in rows:
        e = json.loads(value)
        cache, version, name = e["cacheName"], int(e["version"]), (e["handler"] or "flink").lower()
        if cache.lower() == "handler":
            want[seq] = "UNKNOWN_HANDLER" if name == "what" else "SAME_HANDLER" if name == handler else "SWITCHED"
            handler = handler if name == "what" else name
        elif cache == "other":
            want[seq] = "UNKNOWN_CACHE"
        elif version <= mark[cache]:
            want[seq] = "STALE"
        elif (cache, version) in there and (there[cache, version] is None or there[cache, version] <= seq):
            want[seq], mark[cache] = "LOADED", version
        else:
            want[seq] = "LOAD_FAILED"
    assert got == want and {"LOADED", "LOAD_FAILED", "STALE", "SWITCHED", "SAME_HANDLER"} <= set(got.values())


def test_as_of_keeps_large_ids_and_equal_rows(spark):
    big = 1 << 53
    records = spark.createDataFrame([(big + 1, "a"), (big + 3, "b"), (big + 3, "b"), ((1 << 63) - 1, "c"), (None, "d"), (5, "e")], "seq long, x string")
    changes = spark.createDataFrame([(6, 1), (big + 2, 2), (big + 3, 3)], "seq long, v int")
    got = sorted((r.x, r.seq, r.v) for r in policy.as_of(records, changes, "v", 0).collect())
    assert got == [("a", big + 1, 1), ("b", big + 3, 3), ("b", big + 3, 3), ("c", (1 << 63) - 1, 3), ("d", None, 0), ("e", 5, 0)]


def test_few_changes_give_what_many_give(spark, monkeypatch):
    records = spark.createDataFrame([(i // 2, str(i)) for i in range(60)] + [(None, "n"), (7, "7"), ((1 << 63) - 1, "big")], "seq long, x string")
    changes = spark.createDataFrame([(5, 1), (9, None), (12, 2), (13, 3), (None, 9), (1 << 53, 4)], "seq long, v int")
    want = sorted((r.x, r.seq or -1, r.v) for r in policy.as_of(records, changes, "v", 0).collect())
    few = policy.as_of_few(records, changes, "v", 0)
    assert few.columns == ["seq", "x", "v"] and sorted((r.x, r.seq or -1, r.v) for r in few.collect()) == want
    assert "Exchange hash" not in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(policy, "FEW_CHANGES", 3)
    assert sorted((r.x, r.seq or -1, r.v) for r in policy.as_of_few(records, changes, "v", 0).collect()) == want
    assert {r.v for r in policy.as_of_few(records, changes.filter("false"), "v", 0).collect()} == {0}


def test_several_running_values_equal_one_each(spark):
    import random

    rng = random.Random(5)
    rows = [(i, rng.choice("ab"), rng.choice([None, None, rng.randrange(9)]), rng.choice([None, None, rng.choice("xyz")])) for i in range(300)]
    df = spark.createDataFrame(rows, "seq long, k string, v long, w string").repartition(5)
    got = {r.seq: (r.top, r.held) for r in policy.running_values(df, {"top": ("v", "max"), "held": ("w", "last")}, policy.ranges(df), ("k",)).collect()}
    top = {r.seq: r.before for r in policy.running(df, "v", "max", ("k",)).collect()}
    held = {r.seq: r.before for r in policy.running(df, "w", "last", ("k",)).collect()}
    assert got == {i: (top[i], held[i]) for i in top} and len(got) == 300


def test_asof_reasons_read_messages_and_events_once(spark, monkeypatch):
    messages, sf = src.derived_messages, "/root/testdata/sf0.001"
    # whatever runs over the messages while the plan is made would raise
    monkeypatch.setattr(versions.src, "derived_messages", lambda s, d: messages(s, d).filter(F.raise_error(F.lit("messages were read")).isNull()))
    versions._asof_reasons(spark, sf)
    monkeypatch.undo()
    plan = versions._asof_reasons(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [c_custkey") == 1 and "event_type" not in plan


def test_records_are_judged_by_their_own_version(spark, tmp_path):
    store = str(tmp_path)
    publish_policy(spark, "Rule1", 1, store)
    publish_policy(spark, "2", 2, store)
    rulebook.publish_rules(rules(spark, Rule1="m['Name'] = 'x'", Rule2="m['Name'] = 'y'"), 1, f"{store}/compiled_rules")
    rulebook.publish_rules(rules(spark, Rule2="m['Name'] = 'x'"), 2, f"{store}/compiled_rules")
    held, sets = policy.of_versions(spark, f"{store}/politics", [1, 2]), rulebook.of_versions(spark, f"{store}/compiled_rules", [1, 2])
    pairs = [(name, p, r) for name in "xy" for p in (1, 2) for r in (1, 2)]
    rows = spark.createDataFrame([(*message(i, n), p, r) for i, (n, p, r) in enumerate(pairs)], MESSAGES + ", policy_version long, rules_version long")
    answered, rejects = gate.process(rows, held, sets, now())
    got = {r.seq: json.loads(r.answer)["data"]["details"]["ALL_RESULT"] for r in answered.collect()}
    # version 1 of the policy names Rule1, version 2 names 2; a body that a rule set lacks succeeds
    bodies = {(1, 1): "x", (1, 2): None, (2, 1): "y", (2, 2): "x"}
    assert got == {i: "ERROR" if bodies[p, r] == n else "SUCCESS" for i, (n, p, r) in enumerate(pairs)}
    assert rejects.count() == 0 and {"policy_version", "rules_version"} <= set(answered.columns)


def test_control_stream_reloads_fails_and_restarts(spark, tmp_path):
    store, at, out, cp = (str(tmp_path / n) for n in ("store", "in", "out", "cp"))
    publish_policy(spark, "Rule1", 1, store)
    rulebook.publish_rules(rules(spark, Rule1="m['Name'] = 'x'", Rule2="m['Name'] = 'y'"), 1, f"{store}/compiled_rules")
    event = lambda seq, cache, version=0, handler=None: (seq, json.dumps({"cacheName": cache, "version": version, "handler": handler}))

    def land(part, messages, control):
        spark.createDataFrame(messages, MESSAGES).coalesce(1).write.parquet(f"{at}/messages/part={part}")
        spark.createDataFrame(control, "seq long, value string").coalesce(1).write.parquet(f"{at}/control/part={part}")

    def go(where=out, checkpoint=cp, whole=at):
        read = lambda name, schema: spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{whole}/{name}")
        rows = gate.merged(read("messages", MESSAGES), read("control", "seq long, value string"))
        gate.run(rows, store, where, checkpoint, now()).awaitTermination()

    # version 2 is not there when it is asked for: version 1 stays
    land(1, [message(1, "x"), message(2, "y"), message(5, "x")], [event(3, "politics", 2), event(4, "nothing", 1), event(6, "Handler", 1, "dotnet")])
    go()
    assert status(gate.committed(spark, out, "answers").collect()) == [("01", "ERROR"), ("02", "SUCCESS"), ("05", "ERROR")]
    # now it is, and the next event of the same version takes it
    publish_policy(spark, "Rule2", 2, store)
    land(2, [message(7, "x"), message(9, "x"), message(11, "y"), message(12, "x"), message(13, "y", msg_id=None), message(10, "x")], [event(8, "handler", 0, "flink"), event(10, "politics", "2"), event(14, "politics", 1)])
    go()
    got = status(gate.committed(spark, out, "answers").collect())
    assert got == [("01", "ERROR"), ("02", "SUCCESS"), ("05", "ERROR"), ("09", "ERROR"), ("0A", "SUCCESS"), ("0B", "ERROR"), ("0C", "SUCCESS")]
    assert [r.seq for r in gate.committed(spark, out, "shadow").collect()] == [7]
    assert sorted((r.seq, r.reason) for r in gate.committed(spark, out, "rejects").collect()) == [(13, "NO_MESSAGE_ID")]
    outcomes = {(r.batch, r.seq): r.outcome for r in spark.read.parquet(f"{out}/control").filter("seq is not null").collect()}
    assert outcomes == {(0, 3): "LOAD_FAILED", (0, 4): "UNKNOWN_CACHE", (0, 6): "SWITCHED", (1, 8): "SWITCHED", (1, 10): "LOADED", (1, 14): "STALE"}
    # a rule set swap; a refused one is never published, so its event fails and the former rules stay
    rulebook.publish_rules(rules(spark, Rule2="1/0 > 0 or m['Name'] = 'x'"), 2, f"{store}/compiled_rules")
    with pytest.raises(rulebook.RulesRefused):
        rulebook.publish_rules(rules(spark, Rule2="nonsense("), 3, f"{store}/compiled_rules")
    land(3, [message(20, "x"), message(22, "x"), message(24, "x")], [event(21, "compiled_rules", 2), event(23, "compiled_rules", 3)])
    go()
    last = gate.committed(spark, out, "answers").filter("batch = 2").collect()
    assert sorted((r.seq, r.policy_version, r.rules_version, json.loads(r.answer)["data"]["PROCESS_STATUS"]) for r in last) == [(20, 2, 1, "OK"), (22, 2, 2, "RULE_EXCEPTION"), (24, 2, 2, "RULE_EXCEPTION")]


def test_a_batch_that_broke_off_is_written_once(spark, tmp_path, monkeypatch):
    store, at, out, cp = (str(tmp_path / n) for n in ("store", "in", "out", "cp"))
    publish_policy(spark, "Rule1", 1, store)
    rulebook.publish_rules(rules(spark, Rule1="m['Name'] = 'x'"), 1, f"{store}/compiled_rules")
    spark.createDataFrame([message(1, "x"), message(2, "y")], MESSAGES).coalesce(1).write.parquet(f"{at}/messages")
    spark.createDataFrame([(3, "{}")], "seq long, value string").coalesce(1).write.parquet(f"{at}/control")
    go = lambda: gate.run(gate.merged(spark.readStream.schema(MESSAGES).parquet(f"{at}/messages"), spark.readStream.schema("seq long, value string").parquet(f"{at}/control")), store, out, cp, now()).awaitTermination()
    real = gate.commit

    def cut(sinks, out, number):
        # killed between two sinks
        first = next(iter(sinks))
        sinks[first].write.mode("overwrite").parquet(f"{out}/{first}/batch={number}")
        raise RuntimeError("killed")

    monkeypatch.setattr(gate, "commit", cut)
    with pytest.raises(Exception, match="killed"):
        go()
    assert spark.read.parquet(f"{out}/answers").count() == 2
    # a version that is published meanwhile is newer than the one that the first try began with: no reply was out yet
    monkeypatch.setattr(gate, "commit", real)
    go()
    for name in ("answers", "replies", "audit"):
        assert gate.committed(spark, out, name).count() == 2
    go()
    assert gate.committed(spark, out, "replies").count() == 2


def test_messages_without_a_policy_are_refused(spark, tmp_path):
    spark.createDataFrame([message(1, "x")], MESSAGES).write.parquet(str(tmp_path / "m"))
    spark.createDataFrame([(3, "{}")], "seq long, value string").write.parquet(str(tmp_path / "c"))
    rows = gate.merged(spark.readStream.schema(MESSAGES).parquet(str(tmp_path / "m")), spark.readStream.schema("seq long, value string").parquet(str(tmp_path / "c")))
    gate.run(rows, str(tmp_path / "none"), str(tmp_path / "out"), str(tmp_path / "cp"), now()).awaitTermination()
    assert [(r.seq, r.reason) for r in gate.committed(spark, str(tmp_path / "out"), "rejects").collect()] == [(1, "NO_POLICY")]


def test_a_failing_policy_store_leaves_the_last_policy(spark, tmp_path):
    at, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([message(1, "x")], MESSAGES).coalesce(1).write.parquet(f"{at}/1")
    spark.createDataFrame([message(2, "x")], MESSAGES).coalesce(1).write.parquet(f"{at}/2")
    first, taken = name_policy(spark, "Rule1"), []

    def policy_of_batch():
        taken.append(len(taken))
        if len(taken) > 1:
            raise RuntimeError("policy store is away")
        return first

    rows = spark.readStream.schema(MESSAGES).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(at)
    gate.start(rows, policy_of_batch, {"Rule1": "m['Name'] = 'x'"}, out, str(tmp_path / "cp"), now()).awaitTermination()
    assert taken == [0, 1]
    assert status(gate.committed(spark, out, "answers").collect()) == [("01", "ERROR"), ("02", "ERROR")]


# --- delivery -----------------------------------------------------------------------------------


def test_redelivered_messages_are_answered_once(spark, tmp_path):
    at, out, store = (str(tmp_path / n) for n in ("in", "out", "store"))
    publish_policy(spark, "Rule1", 1, store)
    rulebook.publish_rules(rules(spark, Rule1="m['Name'] = 'x'"), 1, f"{store}/compiled_rules")
    twice = [message(1, "x"), message(1, "x"), message(2, "x"), message(3, "x", msg_id=None), message(4, "y", msg_id=None)]
    spark.createDataFrame(twice, MESSAGES).coalesce(1).write.parquet(f"{at}/m/1")
    spark.createDataFrame([message(2, "x", seq=9), message(5, "x")], MESSAGES).coalesce(1).write.parquet(f"{at}/m/2")
    spark.createDataFrame([(3, "{}")], "seq long, value string").coalesce(1).write.parquet(f"{at}/c")
    read = lambda name, schema: spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{at}/{name}")
    gate.run(gate.merged(read("m", MESSAGES), read("c", "seq long, value string"), "10 minutes"), store, out, str(tmp_path / "cp"), now()).awaitTermination()
    assert sorted(r.event_id[:2] for r in gate.committed(spark, out, "answers").collect()) == ["01", "02", "05"]
    every = spark.createDataFrame([*twice, message(2, "x", seq=9), message(5, "x")], MESSAGES)
    kept = delivery.first_deliveries(every).collect()
    assert sorted((r.seq, r.msg_id) for r in kept if r.msg_id) == [(1, b"\1"), (2, b"\2"), (5, b"\5")]
    assert sorted(r.seq for r in kept if not r.msg_id) == [3, 4]


def test_messages_of_one_seq_and_of_none_are_judged_apart(spark):
    rows = spark.createDataFrame([message(1, "x"), message(2, "y", seq=1), message(1, "x"), message(3, "x", seq=None), message(4, "y", seq=None)], MESSAGES)
    one = name_policy(spark, "Rule1")
    answered, rejects = gate.process(rows, one, {"Rule1": "m['Name'] = 'x'"}, now())
    got = answered.collect()
    assert status(got) == [("01", "ERROR"), ("02", "SUCCESS"), ("03", "ERROR"), ("04", "SUCCESS")]
    assert sorted(map(str, (r.seq for r in got))) == ["1", "1", "None", "None"] and rejects.count() == 0
    changes = spark.createDataFrame([(1, "dotnet")], "seq long, handler string")
    here, shadow = delivery.routed(rows, changes)
    assert (here.count(), shadow.count()) == (2, 3)


def test_an_answer_that_cannot_be_built_is_refused(spark, monkeypatch):
    real = gate.answers_.build
    monkeypatch.setattr(gate.answers_, "build", lambda *a: real(*a).withColumn("answer", F.when(F.col("event_id") != "01" + "0" * 46, F.col("answer"))))
    answered, rejects = gate.process(spark.createDataFrame([message(1, "x"), message(2, "x")], MESSAGES), name_policy(spark, "Rule1"), {"Rule1": "false"}, now())
    assert [r.seq for r in answered.collect()] == [2]
    assert [(r.seq, r.reason) for r in rejects.collect()] == [(1, "NO_ANSWER")]


def test_start_at_the_latest_message(spark, tmp_path):
    at, mark = str(tmp_path / "in"), str(tmp_path / "mark")
    land = lambda *seq: spark.createDataFrame([(i,) for i in seq], "seq long").coalesce(1).write.mode("append").parquet(at)
    seen = []

    def go():
        rows = gate.from_latest(spark, spark.readStream.schema("seq long").parquet(at), spark.read.parquet(at), mark)
        rows.writeStream.foreachBatch(lambda b, n: seen.extend(r.seq for r in b.collect())).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()

    land(1, 2)
    go()
    land(3)
    go()
    land(4, 5)
    go()
    assert sorted(seen) == [3, 4, 5]


# --- text ---------------------------------------------------------------------------------------


def test_instants_in_a_zone_with_summer_time(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        given = ["2024-03-31T02:30:00Z", "2024-10-27T00:30:00.123Z", "2024-10-27T01:30:00Z", "1960-01-01T00:00:00.500Z", "0001-01-01T00:00:00Z"]
        got = [spark.sql(f"select timestamp '{x}' t").select(text.iso_utc(F.col("t")).alias("x")).first().x for x in given]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2024-03-31T02:30:00.000Z", "2024-10-27T00:30:00.123Z", "2024-10-27T01:30:00.000Z", "1960-01-01T00:00:00.500Z", "0001-01-01T00:00:00.000Z"]


def test_masks_at_any_depth(spark):
    deep = '{"a":1,"snils":' + "[" * 20 + '"secret",{"x":"}"}' + "]" * 20 + ',"b":{"INN" : 12, "number":"77\\"7","c":[{"snils":{"q":[1]}}]}}'
    cut = '{"a":1,"snils":' + "[" * 20 + '"secret'
    other = '{"deep":' + "[" * 20 + '{"inn":1.5e3}' + "]" * 20 + ',"series":true,"z":"snils","y":["inn"],"k":{"number":' + "[" * 12 + "]" * 12 + "}}"
    want = ['{"a":1,"snils":"***","b":{"INN":"***", "number":"***","c":[{"snils":"***"}]}}', '{"a":1,"snils":"***"', '{"deep":' + "[" * 20 + '{"inn":"***"}' + "]" * 20 + ',"series":"***","z":"snils","y":["inn"],"k":{"number":"***"}}', "", None]
    rows = spark.createDataFrame([(deep,), (cut,), (other,), ("",), (None,)], "p string")
    got = rows.select(text.mask_json(F.col("p")).alias("m"), text._mask_tokens(F.col("p"), text.SECRET_KEYS).alias("n")).collect()
    assert [r.m for r in got] == [r.n for r in got] == want
    shown = spark.createDataFrame([('{"inn":1,"x":2}',), ('oops "snils" : "1"',), ('{"number":"12',)], "p string").select(text.mask_payload(F.col("p")).alias("m")).collect()
    assert [r.m for r in shown] == ['{"inn":"***","x":2}', 'oops "snils":"***"', '{"number":"***"']


def test_code_pages_byte_by_byte(spark):
    rows = spark.range(256).select("id", F.expr("unhex(lpad(hex(id), 2, '0'))").alias("b"))
    for page in (*text.CODE_PAGES, 819):
        name = "latin-1" if page == 819 else f"cp{page:03d}"
        got = {r.id: r.t for r in rows.select("id", text.decode_body(F.col("b"), F.lit(page)).alias("t")).collect()}
        assert got == {i: bytes([i]).decode(name, "replace") for i in range(256)}, page


def test_versions_of_control_events(spark):
    given = ['{"version":"7","cacheName":" Handler "}', '{"version":7.9,"cacheName":"p"}', '{"version":"x","cacheName":"p"}', '{"cacheName":"p"}', '{"version":9007199254740993,"cacheName":"p"}', "{", '{"version":" 8 ","cacheName":"p"}', '{"version":-1,"cacheName":"p"}']
    got = src.decode_control(spark.createDataFrame(list(enumerate(given)), "seq long, value string")).orderBy("seq").collect()
    assert [(r.cache, r.version, r.valid) for r in got] == [("Handler", 7, True), ("p", 7, True), ("p", -1, False), ("p", -1, False), ("p", 9007199254740993, True), ("", -1, False), ("p", 8, True), ("p", -1, False)]
    names = spark.createDataFrame([("a_b_ 12 ",), ("x_v1",)], "n string").select(text.version_text(F.col("n")).alias("v")).collect()
    assert [r.v for r in names] == ["12", "v1"]
    with pytest.raises(Exception, match="no version in cache name x"):
        spark.createDataFrame([("x",)], "n string").select(text.version_text(F.col("n"))).collect()


def test_profile_texts_take_sections_only(spark):
    data = {"data": {"mapping.r": "Root", "r": "1", "b": {"n": 7, "t": True, "none": "none", "mapping.n": "N", "mapping.t": "T", "mapping.none": "E", "deep": {"x": "1", "mapping.x": "Deep"}}, "documents": {"clientIdCard": [{"y": "2", "mapping.y": "Card"}], "other": [{"z": "3", "mapping.z": "Other"}]}}}
    rows = spark.createDataFrame([(1, b"\1", None, json.dumps(data))], "seq long, msg_id binary, jms_id string, payload string")
    got = {r.field: r.value for r in flatten.profile_texts(flatten.decode(rows)).collect()}
    assert got == {"N": "7", "T": "true", "E": None, "Card": "2"}


def test_event_lines_of_a_batch_are_written_once(spark, tmp_path):
    lines = spark.createDataFrame([(2, "b"), (1, "a")], "event_id long, line string").coalesce(1)
    for batch in (1, 2, 2):
        job_events.write_lines(lines, str(tmp_path / "events"), batch)
    assert [r.value for r in spark.read.text(str(tmp_path / "events")).orderBy("batch", "value").collect()] == ["a", "b", "a", "b"]


def test_events_are_numbered_without_a_join(spark):
    """A join of the ranges with their own sizes failed on millions of events."""
    events = spark.range(300).selectExpr("id event_id", "case when id % 50 <> 7 then timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, (id * 7919 % 40)) end event_time")
    numbered = job_events.numbered(events)
    assert "Join" not in numbered._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted(numbered.collect(), key=lambda r: (str(r.event_time or ""), r.event_id))
    assert [r.external_id for r in rows] == list(range(1, 301))
    assert job_events.numbered(events.filter("false")).collect() == []


def test_places_among_bounds(spark):
    for bounds in ([], [5], [1, 3, 5, 7, 9, 11, 13], list(range(0, 40, 2))):
        got = spark.range(-2, 45).select("id", job_events._place(F.col("id"), bounds).alias("p")).collect()
        assert [r.p for r in got] == [sum(b < r.id for b in bounds) for r in got]
