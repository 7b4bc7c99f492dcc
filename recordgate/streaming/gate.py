"""The validation job on Structured Streaming: the batch functions inside ``foreachBatch``."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from recordgate.operators import answers as answers_
from recordgate.operators import delivery, flatten, policy, rulebook, validate
from recordgate.operators.policy import Policy
from recordgate.operators.rulebook import RuleSet
from recordgate.sources.messages import decode_control

_LOG = logging.getLogger(__name__)
#: Columns of messages that the sinks need again.
_IDS = ("msg_id", "jms_id", "payload")
_OUTCOME = "seq long, cache string, version long, handler string, outcome string, batch int"


def process(messages: DataFrame, policy: Policy, predicates: dict[str, str] | RuleSet, now: Column) -> tuple[DataFrame, DataFrame]:
    """(answers, rejects) of a batch of messages."""
    answered, rejects = judged(messages, policy, predicates, now)
    return answered.drop(*_IDS), rejects


def judged(messages: DataFrame, policy: Policy, predicates: dict[str, str] | RuleSet, now: Column, staged=lambda name, df: df) -> tuple[DataFrame, DataFrame]:
    """As ``process``; answers carry the messages' ids and payload. ``staged`` may write what is used more than once, and read it back.

    A message is known by its seq, ids and payload together: messages of one seq are judged apart, equal
    ones are one message, and a message without seq is judged like others.
    """
    times = tuple(c for c in ("created_dttm", "readed_dttm") if c in messages.columns)
    versions = tuple(dict.fromkeys([*policy.by, *(predicates.by if isinstance(predicates, RuleSet) else ())]))
    whole = messages.select(F.struct(F.col("seq").alias("seq"), F.xxhash64(*_IDS).alias("at")).alias("seq"), *_IDS, *times, *versions).dropDuplicates(["seq", *_IDS])
    decoded = staged("decoded", validate.resolved(flatten.decode(whole, keep=(*_IDS, *times, *versions)), policy))
    good = staged("nodes", flatten.message_nodes(decoded.filter("reason is null")))
    built = staged("built", answers_.build(good, validate.evaluate(good, policy, predicates), policy, now, (*_IDS, *versions)))
    # a message without an answer is refused, the others go on
    failed = built.filter("answer is null").select("seq", "event_id", F.lit("NO_ANSWER").alias("reason"))
    rejects = decoded.filter("reason is not null").select("seq", "event_id", "reason").unionByName(failed)
    answered = built.filter("answer is not null").drop("errors")
    if not policy.by:
        answered = answered.withColumn("policy_version", F.lit(policy.version))
    return answered.withColumn("seq", F.col("seq.seq")), rejects.withColumn("seq", F.col("seq.seq"))


# --- sinks --------------------------------------------------------------------------------------


def commit(sinks: dict[str, DataFrame], out: str, number: int) -> None:
    """Writes every sink's folder of a batch, then the batch's mark. Folders without a mark are not read, and a replay overwrites them."""
    for name, df in sinks.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
    spark = next(iter(sinks.values())).sparkSession
    spark.createDataFrame([(n,) for n in sinks], "sink string").coalesce(1).write.mode("overwrite").parquet(f"{out}/commits/batch={number}")


def committed(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Rows of a sink from batches that were written whole, each once, with their ``batch``."""
    marks = spark.read.parquet(f"{out}/commits").filter(F.col("sink") == name).select("batch").distinct()
    return spark.read.parquet(f"{out}/{name}").join(marks, "batch", "left_semi")


def _staging(out: str):
    """Tables of the batch in hand, below ``out``: written once instead of computed for each use; the next batch overwrites them."""

    def staged(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{out}/work/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{out}/work/{name}")

    return staged


def _sinks(mine: DataFrame, shadow: DataFrame | None, held: Policy, predicates: dict[str, str] | RuleSet, at: Column, out: str) -> dict[str, DataFrame]:
    answered, rejects = judged(mine, held, predicates, at, _staging(out))
    sent, lost = delivery.replies(answered, None, at)
    # what nothing can match is neither answered nor audited
    known = answered.filter(delivery.correlation(F.col("msg_id"), F.col("jms_id")).isNotNull())
    sinks = {"answers": known.drop(*_IDS), "rejects": rejects.unionByName(lost), "replies": sent, "audit": delivery.audit_lines(known, None, at)}
    if shadow is not None:
        sinks["shadow"] = shadow
    return sinks


def start(messages: DataFrame, policy_of_batch, predicates: dict[str, str] | RuleSet, out: str, checkpoint: str, now: Column | None = None, handlers=None, every: str | None = None) -> StreamingQuery:
    """Answers, rejects, replies, audit lines and shadow copies of an unbounded ``messages``; ``committed`` reads each once.

    ``policy_of_batch``: called once a batch, gives the newest complete policy; where it fails or gives
    none, the last one stays. ``handlers``: called once a batch, gives the changes (seq, handler) known so far;
    messages of the handler ``external`` are not judged here, their payloads go to ``shadow``.
    ``every``: interval of batches, such as '5 seconds'; without it, all that is there is taken once.
    """
    held: dict[str, Policy] = {}

    def handle(batch: DataFrame, number: int) -> None:
        try:
            policy = policy_of_batch()
        except Exception as failed:
            if not held:
                raise
            _LOG.warning("policy of batch %s cannot be loaded, the last one stays: %s", number, failed)
            policy = None
        if policy is None and not held:
            raise RuntimeError("no policy was published before the first batch")
        held["policy"] = policy = policy or held["policy"]
        batch = batch.persist()
        mine, shadow = (batch, None) if handlers is None else delivery.routed(batch, handlers())
        commit(_sinks(mine, shadow, policy, predicates, now if now is not None else F.current_timestamp(), out), out, number)
        batch.unpersist()

    return _started(messages, handle, checkpoint, every)


def _started(rows: DataFrame, handle, checkpoint: str, every: str | None) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


# --- messages and control events in one stream --------------------------------------------------


def merged(messages: DataFrame, control: DataFrame, redelivered_within: str | None = None) -> DataFrame:
    """One stream of messages (seq, msg_id, jms_id, payload, times) and control events (seq, value).

    ``redelivered_within``: messages of one correlation that are read within so long are one message, in one
    batch or in several; the time is that of reading where it is known.
    """
    times = [F.col(c).cast("long").alias(c) if c in messages.columns else F.lit(None).cast("long").alias(c) for c in ("created_dttm", "readed_dttm")]
    left = messages.select(F.lit("message").alias("kind"), "seq", *_IDS, *times, F.lit(None).cast("string").alias("value"))
    none = [F.lit(None).cast(k).alias(c) for c, k in (("msg_id", "binary"), ("jms_id", "string"), ("payload", "string"), ("created_dttm", "long"), ("readed_dttm", "long"))]
    rows = left.unionByName(control.select(F.lit("control").alias("kind"), "seq", *none, "value"))
    if redelivered_within is None:
        return rows
    apart = F.concat_ws("|", "kind", F.coalesce(delivery.correlation(F.col("msg_id"), F.col("jms_id")), F.concat_ws(":", F.lit("seq"), F.col("seq").cast("string"), F.xxhash64("payload", "value"))))
    timed = rows.withColumn("_read", F.coalesce(F.timestamp_millis("readed_dttm"), F.current_timestamp())).withColumn("_key", apart)
    return timed.withWatermark("_read", redelivered_within).dropDuplicatesWithinWatermark(["_key"]).drop("_read", "_key")


def from_latest(spark: SparkSession, rows: DataFrame, landed: DataFrame, mark: str) -> DataFrame:
    """``rows`` of a stream beyond what has ``landed`` when it is started for the first time.

    The greatest seq of that time is kept at ``mark``, so a restart goes on where it stopped.
    """
    try:
        last = spark.read.schema("seq long").parquet(mark).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        landed.agg(F.max("seq").alias("seq")).coalesce(1).write.parquet(mark)
        last = spark.read.parquet(mark).first()[0]
    return rows if last is None else rows.filter(F.col("seq") > last)


def catalogue(spark: SparkSession, store: str) -> DataFrame:
    """cache, version, since (null) of what is published below ``store``: politics and compiled_rules."""
    out = None
    for cache, parts in (("politics", policy.PARTS), ("compiled_rules", rulebook.PARTS)):
        one = policy.published(spark, f"{store}/{cache}", parts).select(F.lit(cache).alias("cache"), "version", F.lit(None).cast("long").alias("since"))
        out = one if out is None else out.unionByName(one)
    return out


def _applied(spark: SparkSession, out: str, before: int) -> DataFrame:
    """Outcomes of batches before ``before`` that changed what is in force."""
    try:
        log = spark.read.schema(_OUTCOME).parquet(f"{out}/control")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], _OUTCOME)
    return log.filter((F.col("batch") < before) & F.col("outcome").isin("START", "LOADED", "SWITCHED"))


def _in_force(applied: DataFrame) -> DataFrame:
    """cache, version, handler in force after ``applied``."""
    last = applied.groupBy("cache").agg(F.max_by(F.struct("version", "handler"), F.struct(F.coalesce("seq", F.lit(-(1 << 62))), "batch")).alias("x"))
    return last.select("cache", "x.version", "x.handler")


def run(rows: DataFrame, store: str, out: str, checkpoint: str, now: Column | None = None, default: str = "flink", every: str | None = None) -> StreamingQuery:
    """The job on one stream of messages and control events (``merged``): each message is judged by the versions in force at its seq.

    Control events of a batch come first. A version is taken if it is above the one in force and published
    below ``store``; one that is not leaves the former in force, and the next event tries again. What
    the events did is a sink, ``control``; it is the state that a restart and a replayed batch read, so they
    give the same answers. The first batch starts with the newest published versions. Messages without
    a published policy or rule set are refused as NO_POLICY.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark, at = batch.sparkSession, now if now is not None else F.current_timestamp()
        batch = batch.persist()
        there, earlier = catalogue(spark, store).persist(), _applied(spark, out, number).persist()
        begin = earlier
        if earlier.isEmpty():
            begin = there.groupBy("cache").agg(F.max("version").alias("version")).select(F.lit(None).cast("long").alias("seq"), "cache", "version", F.lit(None).cast("string").alias("handler"), F.lit("START").alias("outcome"), F.lit(number).alias("batch"))
        events = decode_control(batch.filter("kind = 'control'"))
        outcomes = policy.control_outcomes(events, there, _in_force(begin), default)
        if begin is not earlier:
            outcomes = begin.drop("batch").unionByName(outcomes)
        outcomes.write.mode("overwrite").parquet(f"{out}/control/batch={number}")
        applied = _applied(spark, out, number + 1).persist()
        known = lambda cache, value: applied.filter(F.col("cache") == cache).select(F.coalesce("seq", F.lit(-(1 << 62))).alias("seq"), value)
        asked = batch.filter("kind = 'message'").drop("kind", "value")
        asked = policy.as_of(asked, known("politics", F.col("version").alias("policy_version")), "policy_version", F.lit(None))
        asked = policy.as_of(asked, known("compiled_rules", F.col("version").alias("rules_version")), "rules_version", F.lit(None))
        asked = _staging(out)("asked", policy.as_of(asked, known("handler", "handler"), "handler", default))
        mine, shadow = delivery.by_handler(asked)
        unruled = F.col("policy_version").isNull() | F.col("rules_version").isNull()
        versions = mine.filter(~unruled).select("policy_version", "rules_version").distinct().collect()  # versions in force within a batch
        no_policy = mine.filter(unruled).select("seq", flatten.event_id(F.col("msg_id"), F.col("jms_id")).alias("event_id"), F.lit("NO_POLICY").alias("reason"))
        if versions:
            politics = policy.of_versions(spark, f"{store}/politics", sorted({r["policy_version"] for r in versions}))
            rules = rulebook.of_versions(spark, f"{store}/compiled_rules", sorted({r["rules_version"] for r in versions}))
            sinks = _sinks(mine.filter(~unruled), shadow, politics, rules, at, out)
            commit(sinks | {"rejects": sinks["rejects"].unionByName(no_policy)}, out, number)
        else:
            commit({"rejects": no_policy, "shadow": shadow}, out, number)
        for df in (applied, earlier, there, batch):
            df.unpersist()

    return _started(rows, handle, checkpoint, every)
