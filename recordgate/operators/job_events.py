"""Job audit: configuration hashes and their changes, event lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordgate.functions.text import cef_header, cef_value, first_positive, first_text, iso_utc, mask_config, nullif_blank, server_host, server_port, strip, url_host, url_port, url_scheme


def config_hashes(config: DataFrame) -> DataFrame:
    """job, run, hash: SHA-256 of the sorted, masked key=value lines of each run."""
    line = F.concat(F.col("key"), F.lit("="), mask_config(F.col("key"), F.col("value")))
    return config.groupBy("job", "run").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), "\n"), 256).alias("hash"))


def config_changes(hashes: DataFrame) -> DataFrame:
    before = F.lag("hash").over(Window.partitionBy("job").orderBy("run"))
    return hashes.withColumn("before", before).filter("before is not null and before <> hash").select("job", "run", "hash")


def cef_lines(events: DataFrame, vendor: str, app: str = "recordgate", version: str = "1") -> DataFrame:
    """event_id, line of each job event (event_id, event_time text, event_type, status, user): the short form, four pairs."""
    title = F.initcap(F.replace(F.lower("event_type"), F.lit("_"), F.lit(" ")))
    head = F.concat_ws("|", F.lit("CEF:0"), F.lit(vendor), F.lit(app), F.lit(version), cef_header(F.col("event_type")), cef_header(title), F.lit("1"))
    outcome = F.when(F.lower("status").isin("error", "failed", "failure"), "failure").otherwise("success")
    pairs = F.concat_ws(" ", F.concat(F.lit("externalId="), F.col("event_id").cast("string")), F.concat(F.lit("rt="), cef_value(F.col("event_time"))), F.concat(F.lit("outcome="), outcome), F.concat(F.lit("suser="), cef_value(F.col("user"))))
    return events.select("event_id", F.concat(head, F.lit("|"), pairs).alias("line"))


# Classes of event types by prefix, spellings of title words.
CLASSES = ("JOB_PROPERTIES", "JOB", "KAFKA", "ARTEMIS_SOURCE", "ARTEMIS_SINK", "IBM_MQ_SOURCE", "IBM_MQ_SINK")
SPELLINGS = {"mq": "MQ", "ibm": "IBM"}
#: Payload values that a message text repeats, in this order.
SHOWN = ("component", "connectionName", "topic", "queue", "qmgr", "channel", "propertiesHash", "oldPropertiesHash", "newPropertiesHash", "durationMs", "errorClass", "errorMessage")


@dataclass(frozen=True)
class Host:
    """Where the job runs, and what its event lines are signed with."""

    vendor: str
    app: str
    version: str
    domain: str
    ip: str = ""
    mac: str = ""
    name: str = ""
    port: int = -1
    user: str = ""
    cluster: str = ""
    job: str = ""
    kafka_protocol: str = "TCP"


def event_class(kind: Column) -> Column:
    out = F.when(kind.isNull(), "UNKNOWN")
    for c in CLASSES:
        out = out.when(F.startswith(kind, F.lit(c if c.count("_") else f"{c}_")), c)
    return out.otherwise(kind)


def event_title(kind: Column) -> Column:
    words = F.filter(F.split(F.lower(kind), "_"), lambda w: strip(w) != "")
    spelled = lambda w: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in SPELLINGS.items() for x in kv]), w), F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, F.lit(2), F.length(w))))
    return F.coalesce(F.array_join(F.transform(words, spelled), " "), F.lit("Unknown Event"))


def endpoints(events: DataFrame, host: Host) -> DataFrame:
    """``events`` with dst (ip, dns name, mac, port), user and protocol chosen from the payload, else from ``host``."""
    p = lambda k: F.try_element_at("payload", F.lit(k))
    number = lambda k: p(k).try_cast("int")
    # each choice is exploded, so that the optimizer does not copy it into each of its uses
    stage = lambda rows, **named: rows.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in named.items()]))))
    rows = stage(events, _broker=p("brokerUrl"), _bootstrap=strip(F.split_part(p("bootstrap"), F.lit(","), F.lit(1))))
    rows = stage(rows, _host=url_host(F.col("_broker")), _scheme=url_scheme(F.col("_broker")), _server=server_host(F.col("_bootstrap")))
    rows = stage(rows, _name=first_text(p("dst"), p("host"), F.col("_host"), F.col("_server")), _port=first_positive(number("dpt"), number("port"), url_port(F.col("_broker")), server_port(F.col("_bootstrap"))))
    name, port, scheme = F.col("_name"), F.col("_port"), F.col("_scheme")
    own = name.isNull()
    by_scheme = F.when(F.lower(scheme) == "ssl", "SSL").when(F.lower(scheme) == "tcp", "TCP").otherwise(F.upper(scheme))
    protocol = F.coalesce(first_text(p("protocol"), p("securityProtocol")), by_scheme, F.when(F.startswith(F.col("event_type"), F.lit("KAFKA_")), host.kafka_protocol), F.when(F.lower(p("tlsEnabled")) == "true", "TLS"), F.lit("TCP"))
    chosen = F.struct(
        F.when(own, host.ip).otherwise(name).alias("dst"), F.when(own, host.name).otherwise("").alias("dhost"), F.when(own | (name == host.ip), host.mac).otherwise("").alias("dmac"),
        F.when(own, host.port).otherwise(F.coalesce(port, F.lit(host.port))).alias("dpt"), F.coalesce(first_text(p("suser"), p("duser"), p("connectionUser"), p("user")), F.lit(host.user)).alias("user"), protocol.alias("protocol"),
    )
    return rows.select(*events.columns, F.inline(F.array(chosen)))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def numbered(events: DataFrame) -> DataFrame:
    """``events`` with external_id: 1, 2, ... by time and id. Each range of times is numbered on its own, after the sizes of those before it."""
    n = 4 * int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(events.agg(F.percentile_approx(_micros(F.col("event_time")), [i / n for i in range(1, n)], 10 * n)).first()[0] or []))
    ranged = events.withColumn("_range", _place(_micros(F.col("event_time")), bounds))
    # at most ``n`` sizes; they come as values, because a join of the ranges with a table of themselves does not run above some MB
    sizes = dict(ranged.groupBy("_range").agg(F.count("*")).collect())
    before = [0]
    for i in range(len(bounds)):
        before.append(before[-1] + sizes.get(i, 0))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("event_time", "event_id"))
    return ranged.withColumn("external_id", F.get(F.lit(before).cast("array<long>"), F.col("_range")) + place).drop("_range")


def _place(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` lie below ``value`` (null: none), by blocks of bounds and then within one."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    array = lambda x: F.lit(x).cast("array<long>")
    below = lambda x: F.size(F.filter(x, lambda b: F.coalesce(b < value, F.lit(False))))
    first = below(array(bounds[step - 1 :: step])) * step
    return first + below(F.slice(array(bounds), first + 1, F.lit(step)))


def event_lines(events: DataFrame, host: Host) -> DataFrame:
    """event_id, line: the whole event line with its 19 pairs.

    ``events``: event_id, event_time, event_type, status, job_name, job_version, cluster_id, subtask, parallelism,
    payload (text to text), external_id.
    """
    rows = endpoints(events, host)
    either = lambda c, d: F.coalesce(F.when(nullif_blank(c).isNotNull(), c), d)
    app = F.lit(host.app) if host.app.strip() else F.col("job_name")
    version = F.lit(host.version) if host.version.strip() else F.col("job_version")
    title = event_title(F.col("event_type"))
    said = lambda label, value: F.when(nullif_blank(value).isNotNull(), F.concat(F.lit(f"; {label}="), value)).otherwise("")
    some = lambda label, value: F.when(value.isNotNull(), F.concat(F.lit(f"; {label}="), value.cast("string"))).otherwise("")
    message = F.concat(
        F.when(F.col("event_type").isNull(), "Audit event").otherwise(title), F.lit("; eventId="), F.col("event_id").cast("string"), F.lit("; clusterId="), either(F.col("cluster_id"), F.lit(host.cluster)),
        F.lit("; jobName="), either(F.col("job_name"), F.lit(host.job)), F.lit("; status="), either(F.col("status"), F.lit("SUCCESS")), some("subtaskIndex", F.col("subtask")), some("parallelism", F.col("parallelism")),
        *[said(k, F.try_element_at("payload", F.lit(k))) for k in SHOWN], F.lit("; dst="), F.col("dst"), F.when(F.col("dpt") > 0, F.concat(F.lit(":"), F.col("dpt").cast("string"))).otherwise(""),
    )
    pairs = [
        ("externalId", F.col("external_id").cast("string")), ("suser", F.col("user")), ("sntdom", F.lit(host.domain)), ("src", F.lit(host.ip)), ("smac", F.lit(host.mac)), ("shost", F.lit(host.name)),
        ("duser", F.col("user")), ("dntdom", F.lit(host.domain)), ("dst", F.col("dst")), ("dmac", F.col("dmac")), ("dhost", F.col("dhost")), ("spt", F.lit(str(host.port))), ("dpt", F.col("dpt").cast("string")),
        ("app", F.col("protocol")), ("start", F.unix_millis(F.col("event_time").cast("timestamp")).cast("string")), ("end", F.lit("")), ("msg", message), ("deviceProcessName", F.concat(app, F.lit("-"), version)),
        ("outcome", F.when(F.upper("status").isin("FAILED", "ERROR"), "failure").otherwise("success")),
    ]
    head = F.concat_ws("|", F.lit("CEF:0"), F.lit(host.vendor), *[cef_header(F.coalesce(x, F.lit(""))) for x in (app, version, event_class(F.col("event_type")), title)], F.lit("1"))
    tail = F.concat_ws(" ", *[F.concat(F.lit(f"{k}="), cef_value(F.coalesce(v, F.lit("")))) for k, v in pairs])
    return rows.select("event_id", F.concat(head, F.lit("|"), tail).alias("line"))


def event_documents(events: DataFrame) -> DataFrame:
    """event_id, document: the event as JSON, nulls kept."""
    kind = F.col("event_type")
    fields = F.struct(
        F.col("event_id").cast("string").alias("eventId"), iso_utc(F.col("event_time").cast("timestamp")).alias("eventTime"), kind.alias("eventType"), F.when(kind.isNotNull(), event_class(kind)).alias("eventClass"),
        F.when(kind.isNotNull(), event_title(kind)).alias("eventName"), "status", F.col("job_name").alias("jobName"), F.col("job_version").alias("jobVersion"), F.col("cluster_id").alias("clusterId"), "hostname", F.col("subtask").alias("subtaskIndex"), "parallelism", "payload",
    )
    return events.select("event_id", F.to_json(fields, {"ignoreNullFields": "false"}).alias("document"))


def append_lines(lines: DataFrame, path: str) -> None:
    """Adds lines (event_id, line) to text files, in order of id within each."""
    lines.sortWithinPartitions("event_id").select("line").write.mode("append").text(path)


def write_lines(lines: DataFrame, path: str, batch: int) -> None:
    """The lines of a batch as text files of its own, in order of id: a batch that is written again replaces what it wrote."""
    lines.sortWithinPartitions("event_id").select("line").write.mode("overwrite").text(f"{path}/batch={batch}")
