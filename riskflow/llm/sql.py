"""SQL (DuckDB) of the llm queries that SQL can express, written independently of the Spark code."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Sets of three-word shingles; links by their Jaccard similarity; components by reachability.
NGRAM_JOIN = f"""
with recursive worded as (select doc_id, {_words('text', _SPACED)} as w from documents where doc_id is not null),
shingled as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [hash(array_to_string(w, ' '))]
    else list_transform(range(1, len(w) - 1), lambda i : hash(w[i], w[i + 1], w[i + 2])) end) as s
  from worded
),
members as (select doc_id, unnest(s) as m from shingled),
often as (select doc_id, m from members where m in (select m from members group by m having count(*) > 1)),
met as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from often a join often b on a.m = b.m and a.doc_id < b.doc_id group by 1, 2
),
links as (
  select a, b, common = len(x.s) and common = len(y.s) as same
  from met join shingled x on x.doc_id = a join shingled y on y.doc_id = b
  where 100 * common >= 90 * (len(x.s) + len(y.s) - common)
),
edges as (select a, b from links union select b, a from links),
reach as (select a, b from edges union select r.a, e.b from reach r join edges e on e.a = r.b),
roots as (select a as doc_id, min(b) as root from reach group by a),
classes as (select b as doc_id, min(a) as twin from links where same group by b)
select doc_id, cast(len(s) as bigint) as n_shingles, least(doc_id, coalesce(root, doc_id)) as component_id,
       least(doc_id, coalesce(twin, doc_id)) as class_id
from shingled left join roots using (doc_id) left join classes using (doc_id)
"""

#: Windows of ten item words (or all of a shorter item) wherever they occur in a document.
DECONTAMINATION = f"""
with items as (select item_id, {_words('text', _ALNUM)} as w from benchmark),
windows as (
  select distinct item_id, least(10, len(w)) as size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as body
  from items, lateral (select unnest(range(1, greatest(1, len(w) - 9) + 1)) as i) where len(w) > 0
),
sizes as (select distinct size from windows),
worded as (select doc_id, {_words('text', _ALNUM)} as w from documents),
places as (
  select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as body
  from worded, sizes, lateral (select unnest(range(1, greatest(0, len(w) - size + 1) + 1)) as i)
),
found as (select doc_id, item_id, size, i from places join windows using (size, body)),
hits as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as place from found) group by doc_id
),
owners as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from worded left join hits using (doc_id) left join owners using (doc_id)
"""


def all_sql() -> dict[str, str]:
    return {"op1_ngram_join": NGRAM_JOIN, "op2_decontamination": DECONTAMINATION}
