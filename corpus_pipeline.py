"""Corpus pipeline: toxicity, near-duplicate groups, contamination, sanitisation, byte-level BPE.

Each stage reads what its predecessor has written. The filtering stages keep every row but those
they reject. A row is known by its doc_id; a row whose doc_id is null or held by several rows by a
hash of doc_id and text as well, so each is judged by its own text, and rows equal in both are one
document. Nulls in any column, empty texts and empty tables pass through; columns beyond those of
documents are kept, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from recordgate.llm import toxicity
from recordgate.llm.bpe import bpe_digests
from recordgate.llm.common import anti_join_by_size, left_join_by_size, materialise, shared_dir, table
from recordgate.llm.decontaminate import contaminated
from recordgate.llm.jaccard_join import jaccard_components
from recordgate.llm.pii import sanitise


def _own_name() -> str:
    """A column name that no table has."""
    return f"_own_{uuid.uuid4().hex}"


def _with_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a long key of its documents: doc_id where one row has it, else a hash beyond the ids in use."""
    key, many = _own_name(), _own_name()
    repeated = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias(many)).filter(F.col(many) > 1).select("doc_id")
    marked = left_join_by_size(docs, materialise(repeated).withColumn(many, F.lit(True)), "doc_id")
    beyond = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    own = F.col("doc_id").isNull() | F.col(many).isNotNull()
    return marked.select(*docs.columns, F.when(own, beyond).otherwise(F.col("doc_id")).alias(key)), key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model fitted on the labels. Without labels of both kinds all stay."""
    model, column = toxicity.fit(docs, table(spark, sf_dir, "labels")), _own_name()
    scored = toxicity.with_score(docs, model, score_col=column)
    return scored.filter(F.col(column) < 0.5).select(docs.columns) if model.learned else docs


def _hashed(docs: DataFrame, column: str):
    """A column that rows can be ordered by: what Spark does not hash is taken as JSON."""
    kind = docs.schema[column].dataType.simpleString()
    return F.to_json(F.struct(F.col(f"`{column}`"))) if "map<" in kind or "variant" in kind else F.col(f"`{column}`")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least key of each group of near duplicates; of rows of one key that stay, one."""
    keyed, key = _with_key(docs)
    others = jaccard_components(keyed, id_col=key).filter("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct()
    kept = anti_join_by_size(keyed, materialise(others), key)
    alone, alike = kept.filter(F.col(key) < 1 << 62), kept.filter(F.col(key) >= 1 << 62)
    place = _own_name()
    first = alike.withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*[_hashed(docs, c) for c in docs.columns])))).filter(F.col(place) == 1)
    return alone.unionByName(first.drop(place)).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    keyed, key = _with_key(docs)
    leaked = contaminated(keyed, table(spark, sf_dir, "benchmark"), id_col=key).select(F.col("doc_id").alias(key)).distinct()
    return anti_join_by_size(keyed, materialise(leaked), key).select(docs.columns)


def sanitise_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced; n_chars follows the new text."""
    out = sanitise(docs)
    columns = {"text": F.col("sanitised"), "n_chars": F.length("sanitised").cast("long")}
    return out.select(*[(columns[c] if c in columns else F.col("row")[c]).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of each document left."""
    return bpe_digests(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", keep_one_of_each_group),
    ("decontaminate", drop_contaminated),
    ("pii", sanitise_texts),
    ("byte_bpe", encode),
]

#: A trained score, a metric join and byte merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
