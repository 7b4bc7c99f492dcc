"""From landing rows to messages, and from answers to what leaves the job: replies, audit lines, shadow copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordgate.functions.text import decode_body, iso_utc, json_or_text, message_body, nullif_blank, positive_or_null, quoted
from recordgate.operators.policy import as_of

EXTERNAL = "dotnet"


def requests(landing: DataFrame, code_pages: bool = True) -> tuple[DataFrame, DataFrame]:
    """(messages, rejects) of landing rows: seq, msg_id binary, jms_id, text, body binary, ccsid, put_ms, read_ms.

    Text stays as it is, bytes are read by their code page; a row with neither, or (``code_pages`` false) of a
    single-byte page other than Latin-1, is refused. Rows that are equal in seq, ids and payload are one message.
    """
    payload = F.when(F.col("text").isNotNull() | F.col("ccsid").isNull(), message_body(F.col("text"), F.col("body"))).otherwise(decode_body(F.col("body"), F.col("ccsid"), code_pages))
    rows = landing.select("seq", "msg_id", "jms_id", payload.alias("payload"), positive_or_null(F.col("put_ms")).alias("created_dttm"), positive_or_null(F.col("read_ms")).alias("readed_dttm"), (F.col("text").isNull() & F.col("body").isNull()).alias("no_body"))
    refused = F.when(F.col("no_body"), "UNSUPPORTED_BODY").when(F.col("payload").isNull(), "UNSUPPORTED_CODE_PAGE")
    rows = rows.withColumn("reason", refused)
    return rows.filter("reason is null").drop("no_body", "reason"), rows.filter("reason is not null").select("seq", "reason")


def correlation(msg_id: Column, jms_id: Column) -> Column:
    """What a reply is matched by: the id's 24 bytes (padded or cut) as hex, else the text id; null where there is neither."""
    return F.coalesce(F.hex(F.substring(F.concat(msg_id, F.lit(b"\0" * 24)), 1, 24)), nullif_blank(jms_id))


def first_deliveries(messages: DataFrame, order: str = "seq") -> DataFrame:
    """``messages`` without redelivered ones: of equal correlations the first in ``order`` stays; those that nothing tells apart by stay all."""
    key = correlation(F.col("msg_id"), F.col("jms_id"))
    # of each correlation one row meets the others: its least place and content
    content = F.struct(F.col(order), *[F.col(c) for c in messages.columns if c != order])
    named = messages.select(key.alias("_key"), content.alias("_row"))
    first = named.filter("_key is not null").groupBy("_key").agg(F.min_by("_row", F.struct(F.col(f"_row.{order}"), F.xxhash64("_row"))).alias("_row"))
    return first.unionByName(named.filter("_key is null")).select("_row.*").select(messages.columns)


def _with_ids(answered: DataFrame, messages: DataFrame | None, *names: str) -> DataFrame:
    """``answered`` with columns of its messages: its own where it carries them, else joined by seq."""
    if messages is None:
        return answered
    return answered.drop(*names).join(messages.select("seq", *names), "seq")


def replies(answered: DataFrame, messages: DataFrame | None, now: Column, sender: str = "recordgate", service: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(seq, correlation_id, body, headers) of answers to send, and rejects (seq, event_id, reason) of those that nothing can match.

    Blank answers are not sent. Without ``messages``, ``answered`` carries msg_id and jms_id itself.
    """
    rows = _with_ids(answered, messages, "msg_id", "jms_id").select("seq", "event_id", "answer", correlation(F.col("msg_id"), F.col("jms_id")).alias("correlation_id"))
    rows = rows.filter(nullif_blank(F.col("answer")).isNotNull())
    pairs = [F.lit("X_From"), F.lit(sender), F.lit("X_CreateDateTime"), iso_utc(now)]
    if service is not None:
        pairs += [F.lit("X_ServiceID"), F.lit(service)]
    sent = rows.filter("correlation_id is not null").select("seq", "correlation_id", F.col("answer").alias("body"), F.create_map(*pairs).alias("headers"))
    return sent, rows.filter("correlation_id is null").select("seq", "event_id", F.lit("NO_MESSAGE_ID").alias("reason"))


def audit_lines(answered: DataFrame, messages: DataFrame | None, now: Column) -> DataFrame:
    """event_id, line: JSON of the event, its request, both answers, the time and the status PROCESSED; what is no JSON stands as text.

    Without ``messages``, ``answered`` carries the payload itself.
    """
    rows = _with_ids(answered, messages, "payload")
    parts = [("eventId", quoted(F.col("event_id"))), ("requestJson", json_or_text(F.col("payload"))), ("shortAnswerJson", json_or_text(F.col("answer"))), ("detailAnswerJson", json_or_text(F.col("detail_answer"))), ("actionDttm", quoted(iso_utc(now))), ("status", F.lit('"PROCESSED"'))]
    return rows.select("event_id", F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), v) for k, v in parts]), F.lit("}")).alias("line"))


def by_handler(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows judged here, shadow: seq and raw payload of those that the external handler has) of messages with their ``handler``."""
    return rows.filter(F.col("handler") != EXTERNAL).drop("handler"), rows.filter((F.col("handler") == EXTERNAL) & nullif_blank(F.col("payload")).isNotNull()).select("seq", "payload")


def routed(messages: DataFrame, changes: DataFrame, default: str = "flink") -> tuple[DataFrame, DataFrame]:
    """(messages judged here, shadow), by the handler as of each message."""
    return by_handler(as_of(messages, changes, "handler", default))


def external_answers(bodies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(event_id, answer, detail_answer) of external bodies (event_id, body), and rejects (event_id, reason).

    A blank body is dropped. A body that is no JSON or has no ``answer`` is refused; ``detail_answer`` may be missing.
    """
    envelope = F.from_json("body", "map<string,variant>")
    rows = bodies.filter(nullif_blank(F.col("body")).isNotNull()).select("event_id", F.explode(F.array(envelope)).alias("e"))
    part = lambda k: F.when(~F.is_variant_null(F.col("e")[k]), F.to_json(F.col("e")[k]))
    rows = rows.select("event_id", part("answer").alias("answer"), part("detail_answer").alias("detail_answer"))
    return rows.filter("answer is not null"), rows.filter("answer is null").select("event_id", F.lit("NO_EXTERNAL_ANSWER").alias("reason"))
