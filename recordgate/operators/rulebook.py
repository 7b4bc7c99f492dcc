"""Rule bodies as data: sets of SQL predicates by version, checked whole before they are used, and errors kept in their row."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordgate.functions.text import nullif_blank
from recordgate.operators import policy

#: The part that a published rule set has.
PARTS = ("bodies",)
_LITERAL = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`")


class RulesRefused(ValueError):
    """A rule set with a body that cannot be used; no rule of it is."""


@dataclass
class RuleSet:
    """bodies ([by], rule_name, predicate): each named rule's SQL; predicates: the distinct ones. ``by`` as in ``Policy``."""

    bodies: DataFrame
    predicates: list[str]
    by: tuple[str, ...] = ()


def isolated(predicate: str) -> Column:
    """A predicate's boolean; null where it is null or raises, whatever it raises and wherever in it.

    ``try_to_binary`` gives null for any error below it. It must stand in a branch of a CASE whose first
    branch has nothing in common with it: what every row evaluates may be shared, and then raise outside.
    """
    text = F.try_to_binary(F.expr(f"cast(({predicate}\n) as string)"), F.lit("utf-8"))
    return F.when(text.isNotNull(), text == F.lit(b"true"))


def isolated_text(predicate: str) -> str:
    """The same as SQL, for the body of a fold, of which nothing is shared."""
    return f"try_to_binary(cast(({predicate}\n) as string), 'utf-8') = X'74727565'"


@lru_cache(maxsize=100_000)
def _error_of(predicate: str, session: SparkSession) -> str | None:
    if re.search(r"(?i)\bselect\b", _LITERAL.sub("''", predicate)):
        return "SUBQUERY"
    probe = session.range(0).select(F.create_map().cast("map<string,string>").alias("m"))
    try:
        kind = probe.filter(F.expr(f"({predicate}\n)")).select(F.expr(f"({predicate}\n)").alias("p")).schema["p"].dataType.simpleString()
    except PySparkException as error:
        return (error.getCondition() or type(error).__name__).split(".")[0]
    return None if kind == "boolean" else "NOT_BOOLEAN"


def predicate_error(spark: SparkSession, predicate: str) -> str | None:
    """Why a predicate over ``m`` (field to text) cannot be used; None if it can."""
    return _error_of(predicate, spark)


def checked(rules: DataFrame, *by: str) -> tuple[DataFrame, DataFrame]:
    """(good: [by], rule_name, predicate; refused: [by], rule_name, reason) of rule rows ([by], rule_name, body in base64).

    A set is refused whole, with the least of its faulty names: BLANK_NAME, REPEATED_NAME, EMPTY_BODY,
    UNDECODABLE_BODY, or the condition that stops a predicate (a syntax error, an unknown column or function,
    a result that is no boolean, a subquery). Distinct predicates are parsed on the driver, once each.
    """
    spark = rules.sparkSession
    body = F.try_to_binary("body", F.lit("base64"))
    text = F.when(F.is_valid_utf8(body.cast("string")), body.cast("string"))
    rows = rules.select(*by, "rule_name", "body", text.alias("predicate"))
    often = rules.groupBy(*by, "rule_name").agg(F.count("*").alias("often"))
    distinct = [r["predicate"] for r in rows.select("predicate").filter("predicate is not null").distinct().collect()]
    errors = spark.createDataFrame([(p, e) for p in distinct if (e := predicate_error(spark, p))], "predicate string, error string")
    rows = rows.join(often, [*by, "rule_name"], "left").join(errors, "predicate", "left")
    reason = F.when(nullif_blank(F.col("rule_name")).isNull(), "BLANK_NAME").when(F.col("often") > 1, "REPEATED_NAME").when(nullif_blank(F.col("body")).isNull(), "EMPTY_BODY")
    rows = rows.withColumn("reason", reason.when(F.col("predicate").isNull(), "UNDECODABLE_BODY").otherwise(F.col("error")))
    faulty = rows.filter("reason is not null").select(*by, F.struct(F.coalesce("rule_name", F.lit("")).alias("rule_name"), "reason").alias("f"))
    refused = faulty.groupBy(*by).agg(F.min("f").alias("f")) if by else faulty.agg(F.min("f").alias("f")).filter("f is not null")
    good = rows.select(*by, "rule_name", "predicate")
    good = good.join(refused.select(*by), [*by], "left_anti") if by else good.join(refused.select(F.lit(1)).limit(1), how="left_anti")
    return good, refused.select(*by, "f.rule_name", "f.reason")


def publish_rules(rules: DataFrame, version: int, root: str) -> None:
    """Publishes a rule set (rule_name, body) as a version, or refuses it whole."""
    good, refused = checked(rules.select("rule_name", "body").withColumn("version", F.lit(version)), "version")
    if (bad := refused.first()) is not None:
        raise RulesRefused(f"version {version}: {bad['reason']} in rule {bad['rule_name']!r}")
    policy.publish({"bodies": good.select("rule_name", "predicate")}, version, root)


def of_versions(spark: SparkSession, root: str, versions: list[int]) -> RuleSet:
    """Several published rule sets: every message is judged by its own ``rules_version``."""
    (bodies,) = policy.read_versions(spark, root, versions, PARTS, "rules_version")
    return RuleSet(bodies, [r["predicate"] for r in bodies.select("predicate").distinct().collect()], ("rules_version",))


def fixed(spark: SparkSession, predicates: dict[str, str]) -> RuleSet:
    """One rule set from names and predicates."""
    return RuleSet(spark.createDataFrame(list(predicates.items()), "rule_name string, predicate string"), sorted(set(predicates.values())))


def bodies_of(policy_rules: DataFrame, rules: RuleSet) -> DataFrame:
    """[by], rule_name, predicate of the names in a policy: the body of the exact name, then with the prefix 'Rule', then without it."""
    tries = F.array("rule_name", F.concat(F.lit("Rule"), "rule_name"), F.regexp_replace("rule_name", "^Rule", ""))
    named = policy_rules.select("rule_name").distinct().select("rule_name", F.posexplode(tries).alias("at", "known"))
    found = named.join(rules.bodies.withColumnRenamed("rule_name", "known"), "known")
    return found.groupBy(*rules.by, "rule_name").agg(F.min_by("predicate", "at").alias("predicate"))
