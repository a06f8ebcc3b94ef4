"""SQL that the queries must equal, where SQL can say it."""

from __future__ import annotations

from marigold.llm import line_dedup, mixing, quality_rules as rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_RULES = rf"""
with d as (select doc_id, coalesce(text, '') as text, {WORDS} as w, string_split(coalesce(text, ''), chr(10)) as lines,
                  row_number() over () as r from documents),
windows as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as x
            from (select r, w, unnest(range(1, len(w) - 1)) as i from d)),
twins as (select r, i from windows qualify count(*) over (partition by r, x) > 1),
places as (select r, count(distinct p) as n from (select r, unnest([i, i + 1, i + 2]) as p from twins) group by r),
line as (select r, i, lines[i] as l, regexp_matches(lines[i], '[^\x20\x09-\x0D]') as spoken
         from (select r, lines, unnest(range(1, len(lines) + 1)) as i from d)),
judged as (
  select r, l, spoken, spoken and (
      not regexp_matches(l, '{rules.SENTENCE_MARK}')
      or (not regexp_matches(l, '\p{{Ll}}') and regexp_matches(l, '\p{{Lu}}.*\p{{Lu}}.*\p{{Lu}}'))
      or len(regexp_extract_all(l, '{rules.SYMBOLS}')) > {rules.MAX_SYMBOL_SHARE} * length(l)
      or len(regexp_extract_all(l, '{rules.SEPARATORS}')) >= greatest({rules.MIN_SEPARATORS}, length(l) / 40)
      or regexp_matches(l, '{rules.BOILERPLATE}')) as fails
  from line),
by_line as (
  select r, count(*) filter (spoken) - count(distinct l) filter (spoken) as n_dup_lines,
         coalesce(sum(length(regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g'))) filter (not fails), 0) as clean_chars
  from judged group by r),
base as (
  select doc_id, len(w) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
         len(regexp_extract_all(text, '{rules.SYMBOLS}')) as n_symbols, n_dup_lines, coalesce(n, 0) as n_repeat_words,
         cast(clean_chars as bigint) as clean_chars
  from d join by_line using (r) left join places using (r)),
failed as (
  select *, n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEAT_PCT} * n_words as base_failed from base)
select *, not base_failed and clean_chars >= {1 - rules.MAX_LOST} * word_chars as kept from failed
"""

MIX = rf"""
with d as (
  select doc_id, source, len({WORDS}) as size, row_number() over () as r,
         (cast('0x' || substr(md5('17|' || coalesce(cast(doc_id as varchar), '') || '|' || md5(coalesce(text, ''))), 1, 13) as bigint) + 0.5)
           / 4503599627370496.0::double as u
  from documents),
names as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as place from d group by source),
weighed as (select *, [{", ".join(map(str, mixing.WEIGHTS))}][place % {len(mixing.WEIGHTS)} + 1] as weight, {mixing.CAP}::double * source_size as most from names),
levels as (
  select *, most / weight as ratio,
         ({mixing.BUDGET}::double * (select sum(source_size) from names)
          - coalesce(sum(most) over (order by most / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
         / sum(weight) over (order by most / weight, source nulls last rows between current row and unbounded following) as level
  from weighed),
level as (select level as l from levels where level <= ratio order by ratio, source nulls last limit 1),
targets as (select source, source_size, case when level > ratio then most else least(most, weight * (select l from level)) end as target from levels),
whole as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as copies from targets),
rests as (select *, target - copies * source_size as rest from whole),
sizes as (select source, size, count(*) as n from d where size > 0 group by source, size),
sums as (
  select *, cast(sum(n * size * size) over (partition by source order by size) as double) as squares,
         cast(coalesce(sum(n * size) over (partition by source order by size rows between 1 following and unbounded following), 0) as double) as larger
  from sizes),
slopes as (
  select s.source, arg_max((rest - larger) / squares, size) as slope
  from sums s join rests r on s.source is not distinct from r.source where (rest - larger) / squares * size <= 1 group by s.source),
ranked as (
  select d.*, source_size, target, copies, rest, coalesce(slope, 0) * size as odds
  from d join rests r on d.source is not distinct from r.source left join slopes s on d.source is not distinct from s.source),
ordered as (
  select *, case when odds >= 1 then 0 when odds > 0 then (u / (1 - u)) / (odds / (1 - odds)) end as rank from ranked),
summed as (
  select *, case when rank is not null then sum(size) over (partition by source, rank is null order by rank, r) end as upto from ordered),
chosen as (select *, coalesce(upto <= rest, false) and rest > 0 as once from summed),
missing as (select source, any_value(rest) - coalesce(sum(size) filter (once), 0) as m from chosen group by source),
extra as (
  select c.source, arg_min(r, row(abs(size - m), rank, r)) as extra
  from chosen c join missing using (source) where rank is not null and not once and abs(size - m) < m group by c.source
  union all
  select null, arg_min(r, row(abs(size - m), rank, r)) from chosen c join missing x on c.source is null and x.source is null
  where rank is not null and not once and abs(size - m) < m),
final as (
  select c.*, copies + case when once or coalesce(r = extra, false) then 1 else 0 end as times
  from chosen c left join extra e on c.source is not distinct from e.source)
select doc_id, size, source_size, target, times as copies, times * size as taken from final
"""

EMBEDDING_DEDUP = """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))) and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
link as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.9),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join link l on r.b = l.a),
least as (select a, min(b) as component_id from reach group by a),
n as (select a, count(*) as n from link group by a)
select e.vec_id, coalesce(n.n, 0) as n_links, component_id, e.vec_id = component_id as kept
from embeddings e join least on least.a = e.vec_id left join n on n.a = e.vec_id
"""

BLANKS = "chr(32) || chr(9) || chr(13) || chr(11) || chr(12)"

LINE_DEDUP = rf"""
with d as (select doc_id, coalesce(source, chr(0)) as site, text, string_split(text, chr(10)) as lines from documents),
line as (select doc_id, site, i, lines[i] as l from (select doc_id, site, lines, unnest(range(1, len(lines) + 1)) as i from d)),
judged as (
  select doc_id, site, i, trim(l, {BLANKS}) as l from line
  where regexp_matches(l, '(?:[^ 	-
]+[ 	-
]+){{{line_dedup.MIN_WORDS - 1}}}[^ 	-
]')),
shared as (select l, min(row(doc_id, i)) as first from judged group by l having count(distinct site) >= {line_dedup.MIN_SITES}),
gone as (select doc_id, list(i) as gone from judged join shared using (l) where row(doc_id, i) <> first group by doc_id)
select doc_id, case when length(text) > 0 then len(lines) else 0 end as n_lines, coalesce(len(gone), 0) as n_removed,
       md5(case when gone is null then text
                else array_to_string(list_filter(lines, lambda x, i: not list_contains(gone, i)), chr(10)) end) as text_md5
from d left join gone using (doc_id)
"""

ORACLES = {
    "op9_line_dedup": LINE_DEDUP,
    "op1_embedding_dedup": EMBEDDING_DEDUP,
    "op6_mix_sources": MIX,
    "op10_quality_rules": QUALITY_RULES,
}
