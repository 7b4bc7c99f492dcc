"""Queries over the corpus tables, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordgate.llm.archives import op2_archives
from recordgate.llm.bpe import op6_byte_bpe
from recordgate.llm.decontaminate import op9_decontaminate
from recordgate.llm.hard_negatives import op11_hard_negatives
from recordgate.llm.html_extract import op7_html_extract
from recordgate.llm.jaccard_join import op8_jaccard_join
from recordgate.llm.lexical_scan import LOWER_CASE as _LOWER
from recordgate.llm.lexical_scan import TERM as _TERM
from recordgate.llm.lexical_scan import UPPER_CASE as _UPPER
from recordgate.llm.lexical_scan import op13_lexical_rank
from recordgate.llm.mtree import op3_top_k
from recordgate.llm.packing import op12_packing
from recordgate.llm.pii import op1_pii
from recordgate.llm.substring_bytes import op10_suffix_dedup
from recordgate.llm.substring_words import op5_substring_dedup
from recordgate.llm.toxicity import op4_toxicity

_WORDS = r"[^\x20\x09-\x0D]+"


def _shingles(table: str, key: str) -> str:
    return f"""select distinct {key}, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end) g
      from (select {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') w from {table})"""


ORACLES = {
    "op2_archives": """
      with p as (select page_id, sha1(coalesce(html, '')) payload_digest, cast(strlen(coalesce(html, '')) as bigint) payload_bytes from pages where page_id is not null),
      a as (select payload_digest, max(page_id) answer from p where payload_bytes >= 1000 group by payload_digest)
      select page_id, payload_bytes, payload_digest, case when answer > page_id then 'revisit' else 'response' end record_type,
        case when answer > page_id then answer end refers_to
      from p left join a using (payload_digest)""",
    "op3_top_k": """
      with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) v from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
      s as (select q.vec_id query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) score
        from v q, v c where q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
      select query_id, cast(rank as int) "rank", vec_id, score
      from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s) where rank <= 20""",
    "op5_substring_dedup": rf"""
      with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') w from documents),
      win as (select doc_id, i, array_to_string(w[i:i+49], ' ') g from (select doc_id, w, unnest(range(1, len(w) - 48)) i from d where len(w) >= 50)),
      least as (select g, min(doc_id) first_doc from win group by g),
      gone as (select distinct doc_id, unnest(range(i, i + 50)) p from win join least using (g) where first_doc < doc_id),
      per as (select doc_id, list(p) ps from gone group by doc_id)
      select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(len(ps), 0) as bigint) n_removed,
        sha256(array_to_string(case when ps is null then w else list_transform(list_filter(range(1, len(w) + 1), lambda p: not list_contains(ps, p)), lambda p: w[p]) end, ' ')) kept_sha256
      from d left join per using (doc_id)""",
    "op8_jaccard_join": f"""
      with recursive s as ({_shingles("documents", "doc_id")}),
      n as (select doc_id, count(*) n from s group by doc_id),
      both_in as (select a.doc_id x, b.doc_id y, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
      link as (select x, y from both_in join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 80 * (nx.n + ny.n - c)),
      edge as (select x, y from link union all select y, x from link),
      reach as (select doc_id x, doc_id y from documents union select reach.x, edge.y from reach join edge on reach.y = edge.x)
      select reach.x doc_id, coalesce(max(n.n), 0) n_shingles, min(reach.y) component_id from reach left join n on n.doc_id = reach.x group by reach.x""",
    "op9_decontaminate": f"""
      with s as ({_shingles("documents", "doc_id")}), b as ({_shingles("benchmark", "item_id")}),
      size as (select item_id, count(*) n_item from b group by item_id),
      shared as (select doc_id, item_id, count(*) n_shared from s join b using (g) group by doc_id, item_id)
      select doc_id, item_id, n_item, n_shared, n_shared / n_item containment from shared join size using (item_id) where 100 * n_shared >= 80 * n_item""",
    "op11_hard_negatives": """
      with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v from embeddings
        where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
      s as (select a.vec_id anchor_id, a.label anchor_label, c.vec_id, c.label, cast(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) as bigint) score
        from v a, v c where a.vec_id % 100 = 0 and c.vec_id <> a.vec_id),
      p as (select anchor_id, vec_id positive_id, score positive_score from s where label = anchor_label qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
      n as (select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) rank, vec_id negative_id, positive_score, score negative_score
        from p join s using (anchor_id) where label <> anchor_label and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
      select anchor_id, positive_id, cast(rank as int) "rank", negative_id, positive_score, negative_score from n where rank <= 5""",
    "op13_lexical_rank": f"""
      with d as (select row_number() over () r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') w from documents),
      n as (select r, doc_id, cast(len(w) as bigint) n from d where len(w) > 0),
      st as (select count(*) n_docs, cast(sum(n) as bigint) n_terms from n),
      q as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}')) term from benchmark where item_id is not null),
      tf as (select r, term, count(*) tf from (select r, unnest(w) term from d) where term in (select term from q) group by all),
      w as (select term, cast(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) as bigint) w from tf, st group by term),
      s as (select item_id, doc_id, r, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) as bigint) score
        from q join tf using (term) join w using (term) join n using (r), st where doc_id is not null group by all)
      select item_id, cast(rank as int) "rank", doc_id, score
      from (select *, row_number() over (partition by item_id order by score desc, doc_id) rank from s where score > 0) where rank <= 50""",
}


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": _pipeline,
        "op1_pii": op1_pii,
        "op2_archives": op2_archives,
        "op3_top_k": op3_top_k,
        "op4_toxicity": op4_toxicity,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_byte_bpe": op6_byte_bpe,
        "op7_html_extract": op7_html_extract,
        "op8_jaccard_join": op8_jaccard_join,
        "op9_decontaminate": op9_decontaminate,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_packing": op12_packing,
        "op13_lexical_rank": op13_lexical_rank,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
