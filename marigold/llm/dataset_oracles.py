"""SQL that the queries over whole data sets must equal, where SQL can say it."""

from __future__ import annotations

from marigold.llm.oracles import WORDS

def _field(value: str) -> str:
    return f"coalesce(cast(octet_length(encode(cast({value} as varchar))) as varchar) || ':' || cast({value} as varchar), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# Every run of eight nodes to one, round by round, in each tree that has more than one left.
_ROUND = """select {keys}, level + 1 as level, i // 8 as i, sha256(string_agg(h, '' order by i)) as h
    from (select *, count(*) over (partition by {keys}) as n from {table}) where n > 1 group by {keys}, level, i // 8"""
_SIBLINGS = """select *, count(*) over (partition by {keys}, level) as width,
    coalesce(string_agg(h, '' order by i) over (partition by {keys}, level, i // 8 order by i rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(h, '' order by i) over (partition by {keys}, level, i // 8 order by i rows between 1 following and unbounded following), '') as after
  from {table}"""

MERKLE = rf"""
with recursive crc as (
  select list(list_reduce([b] || range(0, 8), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) order by b) as t
  from (select unnest(range(0, 256)) as b)),
row_of as (
  select row_number() over () as r, doc_id, lang, {_leaf("text")} as leaf,
         case when xor(list_reduce([4294967295] || list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint)),
                                   lambda c, b: xor(crc.t[xor(c, b) % 256 + 1], c >> 8)), 4294967295) % 3 = 0
              then {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as claim
  from documents, crc),
placed as (
  select *, coalesce('=' || lang, '') as part, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i from row_of),
part_node as (
  select part, 0 as level, i, leaf as h from placed
  union all ({_ROUND.format(keys="part", table="part_node")})),
part_way as ({_SIBLINGS.format(keys="part", table="part_node")}),
subroot as (select part, h, level, row_number() over (order by encode(part)) - 1 as i from part_way where width = 1),
root_node as (
  select 0 as t, 0 as level, i, h from subroot
  union all ({_ROUND.format(keys="t", table="root_node")})),
root_way as ({_SIBLINGS.format(keys="t", table="root_node")}),
walk as (
  select p.r, p.part, 0 as step, p.i, coalesce(claim, leaf) as h, '' as proof from placed p
  union all
  select w.r, w.part, step + 1, w.i // 8, sha256(before || w.h || after), proof || before || after
  from walk w join part_way n on n.part = w.part and n.level = w.step and n.i = w.i where width > 1),
at_subroot as (select w.* from walk w join subroot s on s.part = w.part and s.level = w.step),
climb as (
  select a.r, 0 as step, s.i, a.h, proof from at_subroot a join subroot s on s.part = a.part
  union all
  select c.r, step + 1, c.i // 8, sha256(before || c.h || after), proof || before || after
  from climb c join root_way n on n.level = c.step and n.i = c.i where width > 1),
done as (select c.* from climb c join root_way n on n.width = 1 and n.level = c.step)
select p.doc_id, p.leaf, s.h as subroot, (select h from root_way where width = 1) as root, sha256(proof) as proof_sha256,
       d.h as folded_root, d.h = (select h from root_way where width = 1) as verified
from done d join placed p using (r) join subroot s on s.part = p.part
"""

FILTER_AUDIT = rf"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, {WORDS} as w from documents),
said as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
judged as (
  select part, doc_id,
         case when len(w) < 200 then 'A' else '' end || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
         || case when 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) then 'C' else '' end
         || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
         || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as fails
  from d),
cells as (
  select part, fails, count(*) as n, sum(coalesce(good, 0)) as n_good, sum(coalesce(toxic, 0)) as n_toxic
  from judged left join said using (doc_id) group by part, fails),
letter as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letter a join letter b on b.x <> a.x join letter c on c.x not in (a.x, b.x) join letter d on d.x not in (a.x, b.x, c.x)
  join letter e on e.x not in (a.x, b.x, c.x, d.x)),
steps as (
  select filter_order, step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as before
  from (select filter_order, unnest(range(1, 6)) as step from orders)),
met as (
  select part, filter_order, step, own, n, n_good, n_toxic, contains(fails, own) as failing,
         length(translate(fails, before, '')) < length(fails) as gone, length(fails) as n_fails
  from cells cross join steps),
counted as (
  select part, filter_order, step, own,
         coalesce(sum(n) filter (not gone and not failing), 0) as kept, coalesce(sum(n) filter (not gone and failing), 0) as removed,
         coalesce(sum(n) filter (gone and failing), 0) as redundant, coalesce(sum(n) filter (failing and n_fails = 1), 0) as unique_fails,
         coalesce(sum(n_good) filter (not gone and failing), 0) as good_lost, coalesce(sum(n_toxic) filter (not gone and failing), 0) as toxic_lost
  from met group by part, filter_order, step, own)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
       cast(toxic_lost as bigint) as toxic_lost, cast(sum(removed) over (partition by part, own) as bigint) as shapley
from counted
"""

ORACLES = {
    "op11_merkle_manifest": MERKLE,
    "op12_filter_audit": FILTER_AUDIT,
}
