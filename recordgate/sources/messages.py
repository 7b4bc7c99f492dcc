"""Message and control tables: landing formats, and messages derived from relational tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GENDER_FIELD = "ОСНОВНЫЕ СВЕДЕНИЯ.Пол"
CONTROL_SCHEMA = "version string, cacheName string, handler string"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines that hold a JSON object."""
    lines = spark.read.text(path).select(F.regexp_replace("value", r"^\s+|\s+$", "").alias("payload")).filter("payload <> ''")
    return lines.filter(F.from_json("payload", "map<string,string>").isNotNull())


def _json(value: Column) -> Column:
    """A JSON string."""
    return F.concat(F.lit('"'), F.regexp_replace(value, r'(["\\])', r"\\$1"), F.lit('"'))


def derived_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """msg_id binary, jms_id, payload, seq: one message per customer, with its three least orders as documents."""
    # three orders of each customer in each salt, then three of each: no customer's orders meet in one task
    salted = Window.partitionBy("o_custkey", F.pmod(F.xxhash64("o_orderkey"), F.lit(16))).orderBy("o_orderkey")
    few = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey").withColumn("r", F.row_number().over(salted)).filter("r <= 3")
    orders = few.groupBy("o_custkey").agg(F.slice(F.array_sort(F.collect_list("o_orderkey")), 1, 3).alias("least_orders"))
    nation = read_table(spark, sf_dir, "nation").join(read_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("c_custkey")
    rows = read_table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(orders, k == F.col("o_custkey"), "left")
    base_code = F.when(k % 23 == 11, "D.Unknown").when(k % 2 == 0, "D.Base.A").otherwise("D.Base.B")
    code = lambda c: F.when(k % 19 == 9, F.lit("")).otherwise(F.concat(F.lit('"dataset_code":'), _json(c), F.lit(",")))
    base = F.concat(
        F.lit('"baseInfo":{'), code(base_code),
        F.lit('"fullName":'), F.when(k % 11 == 5, '"none"').otherwise(_json(F.col("c_name"))),
        F.lit(',"segment":'), _json(F.col("c_mktsegment")), F.lit(',"balance":'), F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
        F.lit(',"note":'), F.when(k % 7 == 3, '"  "').otherwise('"x"'),
        F.lit(',"gender":'), F.when(k % 3 == 0, '"MALE"').when(k % 3 == 1, '"female"').otherwise('"other"'),
        F.lit(',"mapping.fullName":"BASE.Name","mapping.segment":'), F.when(k % 13 == 6, "null").otherwise('"BASE,Segment"'),
        F.lit(f',"mapping.balance":"BASE.Balance","mapping.note":"BASE.Note","mapping.gender":"{GENDER_FIELD}"}}'),
    )
    cards = F.array_join(F.transform(F.coalesce("least_orders", F.array().cast("array<long>")), lambda o: F.concat(F.lit('{"elemId":"ID","number":"'), o.cast("string"), F.lit('","primary":true,"mapping.number":"DOC.Number"}'))), ",")
    documents = F.when(k % 29 == 14, F.lit("")).otherwise(F.concat(F.lit(',"documents":{"clientIdCard":['), cards, F.lit("]}")))
    city = lambda block, col, ds: F.concat(F.lit(f',"{block}":{{'), code(F.lit(ds)), F.lit('"city":'), _json(F.col(col)), F.lit(',"mapping.city":"ADDR.City"}'))
    whole = F.concat(F.lit('{"dfw_query_id":"q'), k.cast("string"), F.lit('","data":{'), base, documents, city("homeAddress", "n_name", "D.Home"), city("registrationAddress", "r_name", "D.Reg"), F.lit("}}"))
    payload = F.when(k % 31 == 15, F.lit(" \t ")).when(k % 17 == 8, F.substring(whole, F.lit(1), (F.length(whole) / 2).cast("int"))).otherwise(whole)
    out = rows.select(F.to_binary(F.lpad(F.hex(k), 16, "0"), F.lit("hex")).alias("msg_id"), F.concat(F.lit("jms-"), k.cast("string")).alias("jms_id"), payload.alias("payload"), k.cast("long").alias("seq"))
    # parsing is the dear part: it gets as many tasks as there are shuffle partitions, however few bytes come in; all later groups are by seq
    return out.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "seq")


def control_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, value (JSON): control events derived from the event table; some broken, stale or unnamed."""
    e = F.col("event_id")
    name = F.when(F.col("event_type") == "click", "compiled_rules").when(F.col("event_type") == "view", "politics").when(F.col("event_type") == "purchase", "handler").when(F.col("event_type") == "signup", "other_cache").otherwise(" ")
    handler = F.when(e % 4 == 0, "flink").when(e % 4 == 1, "dotnet").when(e % 4 == 2, " ").otherwise("other")
    text = F.concat(F.lit('{"cacheName":"'), name, F.lit('"'), F.when(e % 53 == 0, "").otherwise(F.concat(F.lit(',"version":'), (e % 97).cast("string"))), F.when(F.col("event_type") == "purchase", F.concat(F.lit(',"handler":"'), handler, F.lit('"'))).otherwise(""), F.lit("}"))
    return read_table(spark, sf_dir, "events").select(e.alias("seq"), F.when(e % 71 == 0, F.lit('{"cacheName":')).otherwise(text).alias("value"))


def decode_control(events: DataFrame) -> DataFrame:
    """seq, cache, version (default -1; a number or the text of one, fractions cut off), handler text, valid."""
    # exploded, so that the optimizer does not copy the parse into each filter and column that reads it
    j = F.explode(F.array(F.from_json("value", CONTROL_SCHEMA)))
    number = F.trim(F.col("j.version"))
    version = F.coalesce(number.try_cast("long"), F.when(number.rlike(r"^[-+]?\d"), number.try_cast("double").try_cast("long")), F.lit(-1).cast("long"))
    out = events.select("seq", j.alias("j")).select("seq", F.regexp_replace(F.coalesce("j.cacheName", F.lit("")), r"^\s+|\s+$", "").alias("cache"), version.alias("version"), F.col("j.handler").alias("handler"))
    return out.withColumn("valid", (F.col("version") >= 0) & (F.col("cache") != ""))
