"""Registered queries of this subpackage and their SQL, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op6_bpe
from .decontamination import op13_decontamination
from .html_text import op9_html_text
from .language_id import op7_language_id
from .near_dedup import op10_near_dedup
from .packing import op4_packing
from .quality_rules import op1_quality_rules
from .ranked_search import op11_ranked_search
from .substring_dedup import op2_substring_dedup
from .syncmers import op8_syncmers
from .token_files import op3_token_files
from .toxicity import op5_toxicity
from .whitening import op12_embedding_whitening


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline.py`` at the repository top."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_files": op3_token_files,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_bpe": op6_bpe,
    "op7_language_id": op7_language_id,
    "op8_syncmers": op8_syncmers,
    "op9_html_text": op9_html_text,
    "op10_near_dedup": op10_near_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_decontamination": op13_decontamination,
    "pipeline": pipeline,
}

# words as the contract defines them; window n of a document is words n to n+12
SUBSTRING_SQL = """
with split as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
  from documents),
windows as (
  select doc_id, i, array_to_string(w[i:i + 12], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from split where len(w) >= 13)),
firsts as (select g, min(doc_id) as first_id from windows group by g),
gone as (
  select doc_id, list(distinct p) as ps
  from (select v.doc_id, unnest(range(v.i, v.i + 13)) as p
        from windows v join firsts f on v.g = f.g where f.first_id < v.doc_id)
  group by doc_id)
select s.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(ps), 0) as bigint) as n_removed,
       sha256(coalesce(array_to_string(
         case when ps is null then w
              else list_transform(list_filter(range(1, len(w) + 1), lambda p: not list_contains(ps, p)), lambda p: w[p]) end,
         ' '), '')) as kept_sha256
from split s left join gone on s.doc_id = gone.doc_id"""

A_TO_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
TERMS = f"regexp_extract_all(translate(text, {A_TO_Z}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
WORDS = f"regexp_extract_all(translate(text, {A_TO_Z}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

RANKED_SQL = f"""
with term as (select r, doc_id, unnest(t) as t from (
    select row_number() over () as r, doc_id, {TERMS} as t from documents) d),
tf as (select r, any_value(doc_id) as doc_id, t, count(*) as tf from term group by r, t),
doc as (select r, cast(sum(tf) as bigint) as n from tf group by r),
total as (select count(*) as docs, cast(sum(n) as bigint) as total from doc),
item as (select distinct item_id, unnest({TERMS}) as t from benchmark),
weight as (select tf.t, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as w
  from tf, total where tf.t in (select t from item) group by tf.t),
score as (
  select item_id, tf.r, any_value(doc_id) as doc_id,
         cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total)))) as bigint) as score
  from item join tf on item.t = tf.t join weight on weight.t = tf.t join doc on doc.r = tf.r, total
  group by item_id, tf.r)
select item_id, rank, doc_id, score from (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
  from score where score > 0) s where rank <= 50"""

LEAK_SQL = f"""
with item as (select item_id, w, least(10, len(w)) as size from (
    select item_id, {WORDS} as w from benchmark) b where len(w) > 0),
item_window as (select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as g from (
    select *, unnest(range(1, len(w) - size + 2)) as i from item) s),
doc as (select row_number() over () as r, doc_id, coalesce({WORDS}, []) as w from documents),
doc_window as (select r, i, size, array_to_string(w[i:i + size - 1], ' ') as g from (
    select r, w, size, unnest(range(1, len(w) - size + 2)) as i
    from doc, (select distinct size from item) z where len(w) >= size) s),
found as (select r, i, d.size, item_id from doc_window d join item_window b on d.size = b.size and d.g = b.g),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + size)) as p from found) f group by r),
leaked as (select r, count(distinct item_id) as n_items,
    array_to_string(list_sort(list(distinct cast(item_id as varchar))), ',') as ids from found group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc left join hit on doc.r = hit.r left join leaked on doc.r = leaked.r"""

ORACLE_SQL: dict[str, str] = {"op2_substring_dedup": SUBSTRING_SQL, "op11_ranked_search": RANKED_SQL,
                              "op13_decontamination": LEAK_SQL}
