"""Versioned policy tables, their lookups, and the acceptance of control events."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordgate.functions.text import nullif_blank, version_of

BUNDLE_SCHEMA = "version string, dataset2ControlArea map<string,string>, controlAreaRules map<string,map<string,array<string>>>, errorMessages map<string,map<string,string>>, datasetExclusion map<string,array<string>>, filterFlag map<string,boolean>"
#: Parts of a published policy, in the order of the fields of ``Policy``.
PARTS = ("area", "rules", "errors", "exclusion", "flags")
#: Cache payloads by shape: text to text, text lists by name, rules by field and area, error infos, flags.
CACHE_SHAPES = {"text": "map<string,string>", "lists": "map<string,array<string>>", "rules": "map<string,map<string,array<string>>>", "errors": "map<string,map<string,string>>", "flags": "map<string,boolean>"}
#: The caches of a policy by the part that they hold, and the shape of each.
POLITICS = {"area": ("politics_dataset2control_area", "text"), "rules": ("politics_control_area_rules", "rules"), "errors": ("politics_error_messages", "errors"), "exclusion": ("politics_dataset_exclusion", "lists"), "flags": ("politics_filter_flag", "flags")}
#: Bytes of text of a policy up to which its tables are broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 64 << 20
#: Changes up to which each record is compared with all of them in place of a sort.
FEW_CHANGES = 1000
#: Row of a pointer: what one publish of a version has written, all of it or nothing.
POINTER = "part string, version long, attempt string, published long"


@dataclass
class Policy:
    """One version: area (dataset_code, control_area), rules (control_area, field, rule_name), errors
    (rule_name, error_description, classification), exclusion (control_area, block, pos), flags (control_area, filter_flag)."""

    version: str
    area: DataFrame
    rules: DataFrame
    errors: DataFrame
    exclusion: DataFrame
    flags: DataFrame
    n_bytes: int | None = None
    #: Columns that tell versions apart, in every table and in the messages that are judged; none: one version.
    by: tuple[str, ...] = ()

    def small(self, part: DataFrame) -> DataFrame:
        """``part`` of this policy (no larger than its tables together), marked for broadcast if its size allows."""
        if self.n_bytes is None:
            self.n_bytes = int(self.sizes().agg(F.sum("n_bytes")).first()[0])
        return F.broadcast(part) if self.n_bytes <= BROADCAST_BYTES else part

    def sizes(self, bodies: DataFrame | None = None) -> DataFrame:
        """part, n (rows), n_bytes (of their values) of each part, and of rule ``bodies`` where they are given."""
        out = None
        for name, df in [*((n, getattr(self, n)) for n in PARTS), *([("bodies", bodies)] if bodies is not None else [])]:
            width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(16))
            one = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).cast("long").alias("n_bytes")).select(F.lit(name).alias("part"), "n", "n_bytes")
            out = one if out is None else out.unionByName(one)
        return out


def read_bundle(spark: SparkSession, path: str) -> Policy:
    """A policy bundle file; null maps are empty, a blank version is 'test'."""
    return from_bundle(spark.read.schema(BUNDLE_SCHEMA).json(path, multiLine=True))


def from_bundle(doc: DataFrame) -> Policy:
    version = doc.select(F.coalesce(nullif_blank(F.col("version")), F.lit("test"))).first()[0]
    area = doc.select(F.explode("dataset2ControlArea").alias("dataset_code", "control_area"))
    by_area = doc.select(F.explode("controlAreaRules").alias("control_area", "m")).select("control_area", F.explode("m").alias("field", "r"))
    return Policy(
        version,
        area,
        by_area.select("control_area", "field", F.explode("r").alias("rule_name")),
        doc.select(F.explode("errorMessages").alias("rule_name", "m")).select("rule_name", F.col("m")["errorDescription"].alias("error_description"), F.col("m")["classification"].alias("classification")),
        doc.select(F.explode("datasetExclusion").alias("control_area", "b")).select("control_area", F.posexplode("b").alias("pos", "block")),
        doc.select(F.explode("filterFlag").alias("control_area", "filter_flag")),
    )


def read_versioned(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A policy table partitioned by ``version``: the given one, or the newest; a version that is not there is an error."""
    df = spark.read.parquet(path)
    wanted = version if version is not None else df.agg(F.max("version")).first()[0]
    found = df.filter(F.col("version") == wanted)
    if version is not None and found.isEmpty():
        raise ValueError(f"{path} has no version {version}")
    return found


def complete_versions(pointers: DataFrame, parts: int = 5) -> DataFrame:
    """Versions (part, version) for which every part was published."""
    return pointers.groupBy("version").agg(F.count_distinct("part").alias("n")).filter(F.col("n") == parts).select("version")


def publish(tables: dict[str, DataFrame], version: int, root: str) -> None:
    """Writes the parts of a version to a new folder each, then points to them in one file.

    Nothing that readers see is overwritten: until the pointer is there they find what was published
    before, a former publish of the same version too, and a publish that fails leaves nothing to be read.
    """
    attempt, spark = uuid.uuid4().hex, next(iter(tables.values())).sparkSession
    for part, df in tables.items():
        df.write.parquet(f"{root}/{part}/version={version}/attempt={attempt}")
    spark.createDataFrame([(part, version, attempt, time.time_ns()) for part in tables], POINTER).coalesce(1).write.mode("append").parquet(f"{root}/pointers")


def published(spark: SparkSession, root: str, parts: tuple[str, ...] = PARTS) -> DataFrame:
    """version, attempt: the last complete publish of each version below ``root``; no row where nothing was published."""
    try:
        pointers = spark.read.schema(POINTER).parquet(f"{root}/pointers")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "version long, attempt string")
    whole = pointers.filter(F.col("part").isin(*parts) & F.col("attempt").isNotNull()).groupBy("version", "attempt").agg(F.count_distinct("part").alias("n"), F.max("published").alias("at")).filter(F.col("n") == len(parts))
    return whole.groupBy("version").agg(F.max_by("attempt", F.struct("at", "attempt")).alias("attempt"))


def newest(spark: SparkSession, root: str, parts: tuple[str, ...] = PARTS) -> Policy | None:
    """The newest complete policy below ``root``; None before the first one."""
    row = published(spark, root, parts).orderBy(F.desc("version")).first()
    return None if row is None else Policy(str(row["version"]), *[spark.read.parquet(f"{root}/{part}/version={row['version']}/attempt={row['attempt']}") for part in parts])


def read_versions(spark: SparkSession, root: str, versions: list[int], parts: tuple[str, ...] = PARTS, by: str = "policy_version") -> list[DataFrame]:
    """Each part with the rows of all given versions, told apart by ``by``; a version that was not published is an error."""
    known = {r["version"]: r["attempt"] for r in published(spark, root, parts).filter(F.col("version").isin(versions)).collect()}
    if missing := sorted(set(versions) - set(known)):
        raise ValueError(f"{root} has no version {missing[0]}")
    paths = lambda part: [f"{root}/{part}/version={v}/attempt={known[v]}" for v in versions]
    return [spark.read.option("basePath", f"{root}/{part}").parquet(*paths(part)).withColumn(by, F.col("version").cast("long")).drop("version", "attempt") for part in parts]


def of_versions(spark: SparkSession, root: str, versions: list[int]) -> Policy:
    """Several published versions in one policy: every message is judged by its own ``policy_version``."""
    return Policy(",".join(map(str, sorted(versions))), *read_versions(spark, root, versions), by=("policy_version",))


def from_caches(caches: DataFrame) -> Policy:
    """The policy in five versioned caches (name, payload JSON); caches that are missing, or of several versions, are an error."""
    names = caches.select("name").collect()
    found = consistent_version(caches.select("name")).first()
    known = {r["name"].rpartition("_")[0] for r in names if r["name"]}
    if found is None or known != {cache for cache, _ in POLITICS.values()} or len(names) != len(POLITICS):
        raise ValueError(f"caches are not those of one policy version: {sorted(str(r['name']) for r in names)}")
    entries = {}
    for part, (cache, shape) in POLITICS.items():
        one = caches.filter(F.col("name") == f"{cache}_{found['version']}").select(F.col("name").alias("cache"), "payload")
        entries[part] = decode_cache(one, shape).select("entries")
    text = entries["rules"].select(F.explode("entries").alias("control_area", "m")).select("control_area", F.explode("m").alias("field", "r"))
    return Policy(
        str(found["version"]),
        entries["area"].select(F.explode("entries").alias("dataset_code", "control_area")),
        text.select("control_area", "field", F.explode("r").alias("rule_name")),
        entries["errors"].select(F.explode("entries").alias("rule_name", "m")).select("rule_name", F.col("m")["errorDescription"].alias("error_description"), F.col("m")["classification"].alias("classification")),
        entries["exclusion"].select(F.explode("entries").alias("control_area", "b")).select("control_area", F.posexplode("b").alias("pos", "block")),
        entries["flags"].select(F.explode("entries").alias("control_area", "filter_flag")),
    )


def decode_cache(payloads: DataFrame, shape: str) -> DataFrame:
    """cache, and the typed map of each payload (cache, payload JSON); a null or unreadable payload, key or value fails with the cache's name."""
    m = F.from_json("payload", CACHE_SHAPES[shape])
    bad = m.isNull() | F.exists(F.map_values(m), lambda v: v.isNull())
    return payloads.select("cache", F.when(bad, F.raise_error(F.concat(F.lit("unreadable payload of cache "), F.coalesce("cache", F.lit("?")))).cast(CACHE_SHAPES[shape])).otherwise(m).alias("entries"))


def rule_payloads(rules: DataFrame) -> DataFrame:
    """rule_name, predicate, n_bytes: base64 bodies decoded, in order of name; blank names and bodies are left out, undecodable ones null (``rulebook.checked`` refuses them)."""
    body = F.try_to_binary("body", F.lit("base64"))
    kept = rules.filter(nullif_blank(F.col("rule_name")).isNotNull() & nullif_blank(F.col("body")).isNotNull())
    return kept.select("rule_name", F.decode(body, "UTF-8").alias("predicate"), F.octet_length(body).cast("long").alias("n_bytes")).orderBy("rule_name")


def payload_stats(rules: DataFrame) -> DataFrame:
    """n_rules, n_bytes of the decoded rules."""
    return rule_payloads(rules).agg(F.count("predicate").alias("n_rules"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"))


def consistent_version(names: DataFrame) -> DataFrame:
    """version: the one version that all versioned table names (name) carry; no row where they differ or one has none."""
    v = names.select(version_of(F.col("name")).alias("version"))
    return v.agg(F.count_distinct("version").alias("n"), F.max("version").alias("version"), F.bool_or(F.col("version").isNull()).alias("missing")).filter("n = 1 and not missing").select("version")


def ranges(df: DataFrame, order: str = "seq") -> list:
    """Bounds that cut the rows in ranges of ``order`` of about equal numbers; empty where there is no row."""
    n = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.agg(F.percentile_approx(order, [i / n for i in range(1, n)], 10 * n)).first()[0] or []


def running(df: DataFrame, value: str, how: str, by: tuple[str, ...] = (), order: str = "seq", then: str | None = None) -> DataFrame:
    """``df`` with ``before``: the last (``how`` = 'last', nulls skipped) or greatest ('max') ``value`` of earlier rows of the same ``by``.

    Rows are cut in ranges of ``order``; each range hands on one value per ``by``, so no task sees
    more than a range, whatever the number of rows. ``then`` orders rows of one ``order``.
    """
    return running_values(df, {"before": (value, how)}, ranges(df, order), by, order, then)


def running_values(df: DataFrame, asked: dict[str, tuple[str, str]], bounds: list, by: tuple[str, ...] = (), order: str = "seq", then: str | None = None) -> DataFrame:
    """As ``running``, for several values in one pass: ``asked`` is the name of each result, its value and how; ``bounds`` are those of ``ranges``."""
    place = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col(order))) if bounds else F.lit(0)
    ranged = df.withColumn("_range", place)
    at = F.struct(order, then) if then else F.col(order)
    total = lambda value, how: F.max(value) if how == "max" else F.max_by(value, F.when(F.col(value).isNotNull(), at))
    some = reduce(or_, [F.col(value).isNotNull() for value, _ in asked.values()])
    last = ranged.filter(some).groupBy(*by, "_range").agg(*[total(*v).alias(f"_carry_{name}") for name, v in asked.items()])
    # a carried value stands for all ranges up to the next one that has its own
    until = Window.partitionBy(*by).orderBy("_range")
    so_far = until.rowsBetween(Window.unboundedPreceding, 0)
    carried = [(F.max(f"_carry_{name}") if how == "max" else F.last(f"_carry_{name}", True)).over(so_far).alias(f"_carry_{name}") for name, (_, how) in asked.items()]
    runs = last.select(*by, F.col("_range").alias("_from"), F.lead("_range").over(until).alias("_until"), *carried)
    steps = runs.select(*by, F.explode(F.expr(f"sequence(_from + 1, coalesce(_until, {len(bounds) + 1}))")).alias("_range"), *[f"_carry_{name}" for name in asked]).filter(f"_range <= {len(bounds)}")
    inside = Window.partitionBy(*by, "_range").orderBy(order, *([then] if then else [])).rowsBetween(Window.unboundedPreceding, -1)
    # at most one row for each range and value of ``by``
    out = ranged.join(steps, [*by, "_range"], "left")
    mine = lambda name, value, how: F.greatest(F.max(value).over(inside), f"_carry_{name}") if how == "max" else F.coalesce(F.last(value, True).over(inside), f"_carry_{name}")
    return out.select(*df.columns, *[mine(name, *v).alias(name) for name, v in asked.items()])


def accepted_versions(events: DataFrame) -> DataFrame:
    """Decoded control events whose version is above all earlier ones of their cache."""
    known = events.filter("valid").filter(F.col("cache").isin("compiled_rules", "politics")).select("seq", "cache", "version")
    return running(known, "version", "max", ("cache",)).filter("before is null or version > before").select("seq", "cache", "version")


def handler_changes(events: DataFrame, default: str = "flink") -> DataFrame:
    """seq, handler of each event that changes the current handler; unknown names are refused."""
    name = F.lower(F.coalesce(nullif_blank(F.col("handler")), F.lit(default)))
    known = events.filter("valid and lower(cache) = 'handler'").select("seq", name.alias("handler")).filter(F.col("handler").isin("flink", "dotnet"))
    return running(known, "handler", "last").filter(F.col("handler") != F.coalesce("before", F.lit(default))).select("seq", "handler")


def _refusal() -> Column:
    """Why a decoded control event is unusable; null if it is not."""
    name = F.lower(F.coalesce(nullif_blank(F.col("handler")), F.lit("flink")))
    return F.when(~F.col("valid"), "INVALID_EVENT").when((F.lower("cache") == "handler") & ~name.isin("flink", "dotnet"), "UNKNOWN_HANDLER").when(~F.col("cache").isin("compiled_rules", "politics") & (F.lower("cache") != "handler"), "UNKNOWN_CACHE")


def control_rejects(events: DataFrame) -> DataFrame:
    """seq, reason of the control events that change nothing because they are unusable."""
    return events.select("seq", _refusal().alias("reason")).filter("reason is not null")


def as_of(records: DataFrame, changes: DataFrame, value: str, default) -> DataFrame:
    """``records`` (seq, ...) with ``value``: that of the last change (seq, value) at or before each; no row is joined back.

    Equal rows stay as many as they are; a record without seq comes before all changes.
    """
    kind = changes.schema[value].dataType
    own = F.struct(*[F.col(c) for c in records.columns])
    marked = records.select("seq", F.lit(None).cast(kind).alias(value), F.lit(True).alias("is_record"), own.alias("record"))
    known = changes.filter("seq is not null").select("seq", value, F.lit(False).alias("is_record"), F.lit(None).cast(marked.schema["record"].dataType).alias("record"))
    found = running(marked.unionByName(known), value, "last", then="is_record").filter("is_record")
    return found.select("record.*", F.coalesce("before", F.lit(default)).alias(value))


def as_of_few(records: DataFrame, changes: DataFrame, value: str, default) -> DataFrame:
    """As ``as_of``, for ``changes`` that are at hand (``kept``), because they are counted first.

    Up to ``FEW_CHANGES`` are broadcast with the span that each is in force for, so no record is sorted or shuffled; more go by ranges.
    """
    known = changes.filter(F.col("seq").isNotNull() & F.col(value).isNotNull()).select("seq", value)
    if known.limit(FEW_CHANGES + 1).count() > FEW_CHANGES:
        return as_of(records, known, value, default)
    spans = known.select(F.col("seq").alias("_from"), F.lead("seq").over(Window.orderBy("seq")).alias("_until"), F.col(value).alias("_value"))
    found = records.join(F.broadcast(spans), (F.col("seq") >= F.col("_from")) & (F.col("_until").isNull() | (F.col("seq") < F.col("_until"))), "left")
    return found.select(*records.columns, F.coalesce("_value", F.lit(default)).alias(value))


def kept(df: DataFrame) -> DataFrame:
    """A small table that many parts of a plan read, made once: below ``spark.checkpoint.dir``, or in the executors where that is unset."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.localCheckpoint()


def control_outcomes(events: DataFrame, catalogue: DataFrame, held: DataFrame | None = None, default: str = "flink", bounds: list | None = None) -> DataFrame:
    """seq, cache, version, handler, outcome of each decoded control event.

    ``catalogue`` (cache, version, since): what can be loaded, from which seq on (null: always). ``held``
    (cache, version, handler): what is in force before the first event. An event whose version is above
    the one in force is LOADED, or LOAD_FAILED: then the former version stays in force and the next event
    tries again. Others are STALE, SWITCHED, SAME_HANDLER, or refused as INVALID_EVENT, UNKNOWN_CACHE, UNKNOWN_HANDLER.
    ``bounds``: the ``ranges`` of the events, where they can be had without decoding them.
    """
    rows = events.withColumn("refused", _refusal()).withColumn("cache", F.when(F.lower("cache") == "handler", "handler").otherwise(F.col("cache")))
    rows = rows.join(catalogue.select("cache", "version", "since", F.lit(True).alias("is_there")), ["cache", "version"], "left")
    loadable = F.col("refused").isNull() & F.col("cache").isin("compiled_rules", "politics") & F.col("is_there").isNotNull() & (F.col("since").isNull() | (F.col("since") <= F.col("seq")))
    name = F.lower(F.coalesce(nullif_blank(F.col("handler")), F.lit(default)))
    rows = rows.select("seq", "cache", "version", "refused", F.when(loadable, F.col("version")).alias("good"), F.when(F.col("refused").isNull() & (F.col("cache") == "handler"), name).alias("handler"))
    if held is not None:
        first = held.select(F.lit(None).cast("long").alias("seq"), "cache", "version", F.lit("HELD").alias("refused"), F.when(F.col("cache") != "handler", F.col("version")).alias("good"), "handler")
        rows = rows.unionByName(first)
    # a version in force is the greatest that could be loaded: failed events leave no mark
    rows = running_values(rows, {"in_force": ("good", "max"), "before": ("handler", "last")}, ranges(events) if bounds is None else bounds, ("cache",)).filter("refused is null or refused <> 'HELD'")
    switched = F.when(F.col("handler") == F.coalesce("before", F.lit(default)), "SAME_HANDLER").otherwise("SWITCHED")
    loaded = F.when(F.col("version") <= F.col("in_force"), "STALE").when(F.col("good").isNull(), "LOAD_FAILED").otherwise("LOADED")
    return rows.select("seq", "cache", "version", "handler", F.coalesce("refused", F.when(F.col("cache") == "handler", switched).otherwise(loaded)).alias("outcome"))
