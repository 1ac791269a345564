"""SQL that gives the rows of the registered queries, for DuckDB."""

from __future__ import annotations

from nickmap.functions.scalars import SITE_COLOURS
from nickmap.plans.format_sql import ORACLE_SQL as FORMATS
from nickmap.plans.inputs import SQL as INPUTS

_OCC = "list_filter(range(1, length(text) + 1), lambda i: substr(text, i, {k}) = '{m}')"


def _hits(m: str) -> str:
    return f"select doc_id, length(text) as n, unnest({_OCC.format(k=len(m), m=m)}) - 1 as place from documents"


_NICKS3 = f"""
hits as (
  select doc_id as seq_id, place as pos, 1 as strand, 0 as step from ({_hits('rei')}) where place + 3 < n
  union all select doc_id, place + 3, -1, 1 from ({_hits('are')}) where place + 3 < n),
nicked as (select seq_id, pos, cast(arg_max(strand, step) as int) as strand from hits group by seq_id, pos)
"""
_DIGEST = f"""
found as (
  select doc_id as cmap_id, n as contig_length, place + 1 as position, 1 as channel, 0 as step from ({_hits('rei')})
  union all select doc_id, n, place + 1, 1, 1 from ({_hits('are')})
  union all select doc_id, n, place + 1, 2, 2 from ({_hits('tion')})),
places as (select cmap_id, contig_length, position, channel, min(step) as step from found group by all),
digest as (
  select cmap_id, contig_length, count(*) over (partition by cmap_id) as num_sites, cast(row_number() over (partition by cmap_id order by position, step) as int) as site_id,
         channel, position from places)
"""
_PAIR = "ref_id, pair_no, first_id, second_id, distance"

_MERGE = """
junctions as (
  select *, r2s - r1e + 1 as pad, case when ld <= -2 and r2s - r1e + 1 < 0 then abs(ld) else 0 end as cut,
         case when ld = 1 then abs(missed_label - r1e) + 1 end as offs from {plan}),
members as (
  select ref_id, first_id as group_id, 1 as member, first_id as map_id, o1 as o, 0 as head, case when c1 >= c2 then cut else 0 end as tail, offs, pad from junctions
  union all select ref_id, first_id, 2, second_id, o2, case when c1 >= c2 then 0 else cut end, 0, null, pad from junctions),
lengths as (select distinct map_id, map_length, num_sites from map_labels),
ids as (select ref_id, group_id, (select max(map_id) from map_labels) + row_number() over (order by ref_id, group_id) as new_id from (select distinct ref_id, group_id from members)),
sized as (
  select m.*, new_id, l.map_length, l.num_sites, sum(l.map_length) over (partition by ref_id, group_id) + pad as new_length,
         case member when 1 then 0 else sum(l.map_length) over (partition by ref_id, group_id) - l.map_length + pad end as shift
  from members m join lengths l using (map_id) join ids using (ref_id, group_id)),
turned as (
  select s.*, t.site_id as old_site, case o when '+' then t.site_id else s.num_sites - t.site_id + 1 end as site,
         shift + case o when '+' then t.pos else s.map_length - t.pos end as p
  from sized s join map_labels t using (map_id)),
merged_rows as (
  select new_id, new_length, member, 0 as late, site, p, map_id as old_id, old_site from turned where site > head and site <= num_sites - tail
  union all select new_id, new_length, member, 1, 0, max(p) + any_value(offs) + 1, null, null from turned where offs is not null group by new_id, new_length, member),
merged as (
  select cast(new_id as bigint) as map_id, count(*) over (partition by new_id) as num_sites,
         cast(row_number() over (partition by new_id order by member, late, site) as int) as site_id, cast(p as bigint) as pos, cast(new_length as bigint) as map_length, old_id, old_site
  from merged_rows)
"""

# A chain of members has running shifts; the rest is as for pairs.
_CHAIN = """
numbered as (select *, pair_no - row_number() over (partition by ref_id order by pair_no) as run0 from windowed),
spots as (select *, row_number() over (partition by ref_id, run0 order by pair_no) - 1 as nth from numbered),
inside as (select *, nth // 64 as g from spots where (nth + 1) // 64 = nth // 64),
junctions as (
  select *, first_value(first_id) over w as group_id, row_number() over w as junction, r2s - r1e + 1 as pad,
         case when ld <= -2 and r2s - r1e + 1 < 0 then abs(ld) else 0 end as cut, case when ld = 1 then abs(missed_label - r1e) + 1 end as offs
  from inside window w as (partition by ref_id, run0, g order by pair_no)),
members0 as (
  select ref_id, group_id, 1 as member, first_id as map_id, o1 as o, 0 as pad_before, 0 as head from junctions where junction = 1
  union all select ref_id, group_id, junction + 1, second_id, o2, pad, case when c1 >= c2 then 0 else cut end from junctions),
lengths as (select distinct map_id, map_length, num_sites from map_labels),
ids as (select ref_id, group_id, (select max(map_id) from map_labels) + row_number() over (order by ref_id, group_id) as new_id from (select distinct ref_id, group_id from members0)),
sized as (
  select m.*, coalesce(case when j.c1 >= j.c2 then j.cut else 0 end, 0) as tail, j.offs, l.map_length, l.num_sites,
         sum(l.map_length + pad_before) over (partition by m.ref_id, m.group_id) as new_length, new_id,
         sum(l.map_length + pad_before) over (partition by m.ref_id, m.group_id order by m.member) - l.map_length as shift
  from members0 m join lengths l using (map_id) join ids i on i.ref_id = m.ref_id and i.group_id = m.group_id
  left join junctions j on j.ref_id = m.ref_id and j.group_id = m.group_id and j.junction = m.member),
turned as (
  select s.*, t.site_id as old_site, case o when '+' then t.site_id else s.num_sites - t.site_id + 1 end as site,
         shift + case o when '+' then t.pos else s.map_length - t.pos end as p
  from sized s join map_labels t using (map_id)),
merged_rows as (
  select new_id, new_length, member, 0 as late, site, p, map_id as old_id, old_site from turned where site > head and site <= num_sites - tail
  union all select new_id, new_length, member, 1, 0, max(p) + any_value(offs) + 1, null, null from turned where offs is not null group by all),
merged as (
  select cast(new_id as bigint) as map_id, count(*) over (partition by new_id) as num_sites,
         cast(row_number() over (partition by new_id order by member, late, site) as int) as site_id, cast(p as bigint) as pos, cast(new_length as bigint) as map_length, old_id, old_site
  from merged_rows)
"""

_FLANKED = """
ended as (
  select s.*, (select min(site_id) from ref_labels l where l.ref_id = s.ref_id and l.pos >= s.end_pos - 10) as e,
         (select max(site_id) from ref_labels l where l.ref_id = s.ref_id and l.pos <= s.start_pos + 10) as b from keyed_sites s),
flanked as (select * exclude (e, b), coalesce(case when e is null then b else least(b, e) end, 0) as start_label, coalesce(e, 0) as end_label from ended)
"""
_COVERED = f"""{_FLANKED},
held as (
  select site_key, map_id, entry, max(s) as map_start, max(e) as map_end from (
    select f.site_key, p.map_id, p.entry, p.map_site as s, null as e from flanked f join map_pairs p on p.ref_id = f.ref_id and p.ref_site = f.start_label
    union all select f.site_key, p.map_id, p.entry, null, p.map_site from flanked f join map_pairs p on p.ref_id = f.ref_id and p.ref_site = f.end_label)
  group by site_key, map_id, entry),
best as (
  select * from (select *, row_number() over (partition by site_key order by case when map_start is not null and map_end is not null then 0 else 1 end, entry, map_id) as k from held) where k = 1),
covered as (
  select f.site_key, coalesce(b.map_id, 0) as map_id, coalesce(map_start, 0) as map_start, coalesce(map_end, 0) as map_end from flanked f left join best b using (site_key)),
positioned as (
  select c.*, coalesce(a.pos, 0) as map_start_pos, coalesce(z.pos, 0) as map_end_pos from covered c
  left join map_labels a on a.map_id = c.map_id and a.site_id = c.map_start left join map_labels z on z.map_id = c.map_id and z.site_id = c.map_end)
"""
_SUPPORT = f"""
last_labels as (select ref_id, max(site_id) as l from ref_labels group by ref_id),
mol_labels as (select mol_id, map_id, list_sort(list(map_site)) as labels, min(map_site) as m0, max(map_site) as m1 from mol_pairs group by mol_id, map_id),
asked as (
  select f.site_key, f.ref_id, least(start_label, end_label) as s, greatest(start_label, end_label) as e, l,
         case when 1 < least(start_label, end_label) - 25 then least(start_label, end_label) - 25 else 0 end as lo,
         case when l > greatest(start_label, end_label) + 25 then greatest(start_label, end_label) + 25 else l + 1 end as hi
  from flanked f join last_labels using (ref_id) where start_label > 0 and end_label > 0),
spanning as (
  select site_key, mol_id, list_filter(labels, lambda x: x between lo and s) as i, list_filter(labels, lambda x: x between e and hi) as j,
         least(len(list_filter(labels, lambda x: x <= s)), len(list_filter(labels, lambda x: x >= e and x > s)), 10) as confidence
  from asked join mol_labels on map_id = ref_id and m0 < s and m1 > e),
support as (
  select site_key, mol_id, cast(confidence as int) as confidence from spanning
  where len(i) > 0 and len(j) > 0 and (len(i) > 1 or len(j) > 1 or i[1] <> j[1]) and confidence >= 2)
"""
_SCORES = f"""{_SUPPORT},
site_reads as (
  select s.site_key, count(distinct read_id) as reads from keyed_sites s join reads r on r.ref_id = s.ref_id and mapq >= 30
   and read_start < s.start_pos // 86400000000 - 3 and read_end > s.end_pos // 86400000000 + 3 group by s.site_key),
supported as (select site_key, sum(confidence) as confidence, count(*) as molecules from support group by site_key),
totals as (
  select k.site_key, coalesce(molecules, 0) as molecules, coalesce(reads, 0) as reads, cast(coalesce(confidence, 0) + 10 * coalesce(reads, 0) as bigint) as total
  from keyed_sites k left join supported using (site_key) left join site_reads using (site_key)),
scores as (
  select *, round(total / 10.0, 2)::double as score, case when total > 0 and molecules + reads > 0 then total::double / (molecules + reads) else 0 end as mean_per_hit from totals)
"""
_COLOUR = "case site_type " + " ".join(f"when '{k}' then '{v}'" for k, v in SITE_COLOURS.items()) + " else '0,0,0,255' end"
_STATISTICS = f"""
coverages as (select site_key, coalesce(cast(sum(cast(p.coverage as decimal(18,4))) filter (p.map_site < least(map_start, map_end) or p.map_site > greatest(map_start, map_end)) as double)
         / nullif(count(*) filter (p.map_site < least(map_start, map_end) or p.map_site > greatest(map_start, map_end)), 0), 0) as mean_coverage
  from covered c left join map_pairs p on p.map_id = c.map_id and map_start > 0 and map_end > 0 group by site_key),
molecule_lists as (select site_key, string_agg(mol_id, ' ' order by mol_id) as molecule_ids from support group by site_key),
read_lists as (
  select site_key, string_agg(read_id, ' ' order by read_id) as read_ids from (
    select distinct s.site_key, read_id from keyed_sites s join reads r on r.ref_id = s.ref_id and mapq >= 30
     and read_start < s.start_pos // 86400000000 - 3 and read_end > s.end_pos // 86400000000 + 3) group by site_key),
statistics as (
  select row_number() over (order by f.ref_id, f.start_pos, f.end_pos, site_key) as line, f.site_type, f.end_pos - f.start_pos as size, f.ref_id, f.start_pos, f.end_pos, start_label, end_label,
         p.map_id, map_start_pos, map_end_pos, map_start, map_end, mean_coverage, molecules + reads as hits, molecules, reads, total, mean_per_hit, mean_per_hit as mean_per_molecule, score, total as alt_score,
         coalesce(molecule_ids, '') as molecule_ids, coalesce(read_ids, '') as read_ids
  from flanked f join positioned p using (site_key) join coverages using (site_key) join scores using (site_key) left join molecule_lists using (site_key) left join read_lists using (site_key))
"""
_BREAKS = f"""{_COVERED}, {_SCORES},
points as (
  select map_id, unnest(case when map_start_pos = map_end_pos or map_end_pos = 0 then [map_start_pos] when map_start_pos = 0 then [map_end_pos] else [map_start_pos, map_end_pos] end) as breakpoint
  from positioned join scores using (site_key) where map_id <> 0 and (score < 1 or (molecules = 0 and reads > 0)))
"""
_VALID = """
wide as (select site_key, ref_id, greatest(start_pos - 3, 1) as w0, end_pos + 3 as w1 from intervals),
by_read as (select distinct site_key from wide w join reads r on r.ref_id = w.ref_id and mapq >= 30 and read_start < w0 and read_end > w1),
by_alignment as (select distinct site_key from wide w join reads r on r.ref_id = w.ref_id and mapq = 20 and read_start <= w0 and read_end >= least(w1, 2600)),
validated as (
  select i.*, case when a.site_key is not null then 'read' when b.site_key is not null then 'alignment' end as evidence
  from intervals i left join by_read a using (site_key) left join by_alignment b using (site_key))
"""


def _sql(select: str, *parts: str) -> str:
    return INPUTS + "".join(f",{p}" for p in parts) + select


ORACLE_SQL: dict[str, str] = {
    "site_prediction": """
with pairs as (
  select user_id as ref_id, pos, strand, lead(pos) over w as pos2, lead(strand) over w as strand2 from (
    select user_id, epoch_us(ts) - epoch_us(timestamp '2024-01-01') as pos, case event_type when 'click' then 1 else -1 end as strand
    from events where event_type in ('click', 'view')) window w as (partition by user_id order by pos))
select ref_id, pos as start_pos, pos2 as end_pos, case strand when 1 then 'TypeI' else 'TypeII' end as site_type
from pairs where strand = -strand2 and pos2 - pos <= 21600000000""",
    "site_prediction_aggressive": _sql("select * from sites"),
    "site_type_rollup": _sql("select ref_id, site_type, count(*) as sites from sites group by rollup (ref_id, site_type)"),
    "site_stats": _sql("select site_type, count(*) as sites, round(avg((end_pos - start_pos) / 3600000000.0::double), 2) as mean_score, round(coalesce(stddev_samp((end_pos - start_pos) / 3600000000.0::double), 0), 2) as sd_score from sites group by site_type"),
    "motif_scan": f"with {_NICKS3} select * from nicked",
    "motif_scan_four_way": f"""
with hits as (
  select doc_id as seq_id, place as pos, 1 as strand from ({_hits('rei')}) where place + 3 < n
  union all select doc_id, place + 3, 2 from ({_hits('ier')}) where place + 3 < n
  union all select doc_id, place + 3, -1 from ({_hits('are')}) where place + 3 < n
  union all select doc_id, place, -2 from ({_hits('era')}) where place + 3 < n)
select seq_id, pos, cast(case when count(*) > 1 then 3 else max(strand) end as int) as strand from hits group by seq_id, pos""",
    "digest_labels": f"with {_DIGEST} select * from digest",
    "digest_cmap": f"""with {_DIGEST}
select *, 1.0::double as stddev, 1.0::double as coverage, 1.0::double as occurrence from digest
union all select doc_id, length(text), count(d.cmap_id), cast(count(d.cmap_id) + 1 as int), 0, length(text), 0.0, 1.0, 0.0 from documents left join digest d on d.cmap_id = doc_id group by doc_id, text""",
    "digest_filtered": f"""with {_DIGEST}
select doc_id as cmap_id, length(text) as contig_length, count(distinct position) as labelled_positions from documents left join digest on cmap_id = doc_id
group by doc_id, text having count(distinct position) >= 3 and length(text) >= 500""",
    "label_density": f"""with {_DIGEST}
select cmap_id, channel, count(*) as labels, round(count(*) * 100000 / cast(any_value(contig_length) as double), 3) as per_100kb from digest group by cmap_id, channel
union all select null, channel, count(*), round(count(*) * 100000 / (select cast(sum(length(text)) as double) from documents), 3) from digest group by channel""",
    "base_composition": """
with letters as (
  select doc_id as seq_id, """ + ", ".join(f"length(text) - length(replace(upper(text), '{x.upper()}', '')) as {x}" for x in "acgtn") + """
  from (select doc_id, upper(text) as text from documents)),
sums as (select seq_id, """ + ", ".join(f"cast(sum({x}) as bigint) as {x}" for x in "acgtn") + """ from letters group by rollup (seq_id))
select *, round(case when a + c + g + t <> 0 then 100.0::double * (g + c) / (a + c + g + t) else 0 end, 2) as gc_percent,
       round(case when a + c + g + t + n <> 0 then 100.0::double * n / (a + c + g + t + n) else 0 end, 2) as n_percent from sums""",
    "site_flank_sequence": f"""with {_NICKS3},
near as (select seq_id, pos, strand, lead(pos) over w as pos2, lead(strand) over w as strand2 from nicked window w as (partition by seq_id order by pos)),
typed as (select seq_id as ref_id, pos as start_pos, pos2 as end_pos, case strand when 1 then 'TypeI' else 'TypeII' end as site_type from near where strand = -strand2 and pos2 - pos <= 200),
stretched as (select t.*, greatest(start_pos - 50, 1) as flank_start, case when end_pos + 50 > length(text) then length(text) - 1 else end_pos + 50 end as flank_end, text from typed t join documents on doc_id = ref_id)
select * exclude (text), substr(text, flank_start, flank_end - flank_start + 1) as sequence from stretched""",
    "alignment_pairs": _sql(f"select {_PAIR}, o1 as first_orientation, o2 as second_orientation, c1 as first_confidence, c2 as second_confidence from pairs"),
    "overlap_filter": _sql(f"select {_PAIR} from overlapping"),
    "distance_filter": _sql(f"select {_PAIR} from near"),
    "terminal_label_filter": _sql(f"select {_PAIR} from terminal"),
    "label_distance_filter": _sql(f"select {_PAIR}, ld as label_distance from candidates"),
    "missed_labels": _sql("select ref_id, pair_no, missed_label from windowed where ld = 1"),
    "site_window_search": _sql("select ref_id, pair_no, thick_start, thick_end, site_start, site_end, site_type from sited"),
    "observed_fallback": _sql("select e.ref_id, e.pair_no, e.first_ratio, e.second_ratio from eligible e where site_type = 'Observed'"),
    "stitch_plan": _sql(f"select {_PAIR}, ld as label_distance, thick_start, thick_end, missed_label, site_type from plan"),
    "stitch_plan_no_sites": _sql(f"""
select {_PAIR} from (
  select *, row_number() over (partition by ref_id, run order by pair_no) as n from (
    select *, pair_no - row_number() over (partition by ref_id order by pair_no) as run from candidates)) where n % 2 = 1"""),
    "stitch_positions": _sql("select ref_id, case when r2s - r1e + 1 >= 0 then r1e - 1 else r2s - 1 end as start_pos, case when r2s - r1e + 1 >= 0 then r2s + 1 else r1e + 1 end as end_pos, site_type from plan"),
    "ratio_propagation": _sql("select (select max(map_id) from map_labels) + row_number() over (order by ref_id, first_id) as map_id, outer_start as start_ratio, outer_end as end_ratio from plan"),
    "merged_labels": _sql("select * from merged", _MERGE.format(plan="plan")),
    "merged_two_references": _sql("select * from merged", "both_plans as (select * from plan union all select * replace (ref_id + 1000000 as ref_id) from plan where second_id % 2 = 0)", _MERGE.format(plan="both_plans")),
    "map_lineage": _sql("""
select ref_id, group_id, new_id, group_id + 100000 as name, member, map_id, o as orientation, head as trim_head, tail as trim_tail, offs as missed_offset, cast(shift as bigint) as shift, cast(new_length as bigint) as new_length
from sized""", _MERGE.format(plan="plan")),
    "map_identity": _sql("""
select 2 * count(*) as maps, 2 * count(*) as ids, cast(0 as bigint) as shared, cast(0 as bigint) as taken from (select distinct ref_id, group_id from junctions)""", _CHAIN),
    "lifted_pairs": _sql("""
select p.ref_id, p.ref_site, m.map_id, m.site_id as map_site from map_pairs p join merged m on m.old_id = p.map_id and m.old_site = p.map_site
union all select ref_id, ref_site, map_id, map_site from map_pairs where map_id not in (select map_id from sized)""", _MERGE.format(plan="plan")),
    "joined_molecules": _sql("""
select mol_id, map_id, cast(count(distinct site) as int) as n, array_to_string(list_sort(list(distinct site)), ',') as labels from (
  select p.mol_id, m.map_id, m.site_id as site from mol_map_pairs p join merged m on m.old_id = p.map_id and m.old_site = p.map_site
  union all select mol_id, map_id, map_site from mol_map_pairs where map_id not in (select map_id from sized)) group by mol_id, map_id""", _CHAIN, "mol_map_pairs as (select m.mol_id, p.map_id, p.map_site from mol_pairs m join map_pairs p on p.ref_id = m.map_id and p.ref_site = m.map_site)"),
    "merged_maps": _sql("select map_id, num_sites, site_id, pos, map_length from merged union all select * from map_labels where map_id not in (select first_id from plan union all select second_id from plan)", _MERGE.format(plan="plan")),
    "merged_groups": _sql("select * from merged", _CHAIN),
    "lifted_alignments": _sql("""
select a.new_id as qry_id, j.ref_id, '+' as orientation, c1 + c2 as confidence, r1s as ref_start, r2e as ref_end,
       case o1 when '+' then q1s else a.map_length - q1s end as qry_start, cast(b.shift + case o2 when '+' then q2e else b.map_length - q2e end as bigint) as qry_end
from junctions j join sized a on a.ref_id = j.ref_id and a.group_id = j.first_id and a.member = 1 join sized b on b.ref_id = j.ref_id and b.group_id = j.first_id and b.member = 2
union all select qry_id, ref_id, orientation, confidence, ref_start, ref_end, qry_start, qry_end from alignments where qry_id not in (select first_id from plan union all select second_id from plan)""", _MERGE.format(plan="plan")),
    "molecule_end_ratios": _sql("""
select l.ref_id as map_id, case when o1 >= 10 then starts / o1::double else 0 end as start_ratio, case when o2 >= 10 then ends / o2::double else 0 end as end_ratio from (
  select n.ref_id, count(*) filter (map_site = 1) as o1, count(*) filter (map_site = l) as o2,
         count(*) filter (map_site = 1 and (mol_site = 1 or mol_site = lab1 - lab0 + 1)) as starts, count(*) filter (map_site = l and (mol_site = 1 or mol_site = lab1 - lab0 + 1)) as ends
  from (select ref_id, max(site_id) as l from ref_labels group by ref_id) n left join (select p.*, lab0, lab1 from mol_pairs p join molecules using (mol_id)) p on p.map_id = n.ref_id
  group by n.ref_id, l) l"""),
    "flanking_labels": _sql("select site_key, start_label, end_label from flanked", _FLANKED),
    "covering_map": _sql("select * from positioned", _COVERED),
    "mean_coverage_outside": _sql("""
select site_key, coalesce(cast(sum(cast(p.coverage as decimal(18,4))) filter (p.map_site < least(map_start, map_end) or p.map_site > greatest(map_start, map_end)) as double)
       / nullif(count(*) filter (p.map_site < least(map_start, map_end) or p.map_site > greatest(map_start, map_end)), 0), 0) as mean_coverage
from covered c left join map_pairs p on p.map_id = c.map_id and map_start > 0 and map_end > 0 group by site_key""", _COVERED),
    "molecule_support": _sql("select * from support", _FLANKED, _SUPPORT),
    "site_scores": _sql("select * from scores", _FLANKED, _SCORES),
    "scored_sites": _sql("select site_key, ref_id, start_pos, end_pos, site_type, score from keyed_sites join scores using (site_key)", _FLANKED, _SCORES),
    "score_statistics": _sql("select * from statistics", _COVERED, _SCORES, _STATISTICS),
    "scores_written_and_read": _sql("""
select line, site_type, map_id, cast(map_start_pos as double) as map_start_pos, cast(map_end_pos as double) as map_end_pos, molecules, reads, score from statistics""", _COVERED, _SCORES, _STATISTICS),
    "maps_written_and_read": _sql("""
select map_id as cmap_id, cast(map_length as double) as contig_length, num_sites, site_id, 1 as channel, cast(pos as double) as position from map_labels
union all select distinct map_id, cast(map_length as double), num_sites, num_sites + 1, 0, cast(map_length as double) from map_labels"""),
    "sites_written_and_read": _sql(f"select *, {_COLOUR} as item_rgba from sites"),
    "ratios_written_and_read": _sql("select * from end_ratios"),
    "run_counts": _sql("""
select 'alignments' as "table", count(*) as records from alignments union all select 'map_labels', count(*) from map_labels union all select 'maps', count(distinct map_id) from map_labels
union all select 'reference_labels', count(*) from ref_labels union all select 'references', count(distinct ref_id) from ref_labels union all select 'sites', count(*) from sites union all select 'pairs', count(*) from pairs"""),
    "read_support": _sql("select site_key, count(distinct read_id) as reads from intervals i join reads r on r.ref_id = i.ref_id and mapq >= 30 and read_start < start_pos - 3 and read_end > end_pos + 3 group by site_key"),
    "validated_sites": _sql("select * from validated where evidence is not null", _VALID),
    "unvalidated_sites": _sql("select site_key, ref_id, start_pos, end_pos from validated where evidence is null", _VALID),
    "evidence_counts": _sql("select evidence, count(*) as sites from validated group by evidence", _VALID),
    "threshold_split": _sql("select site_key, score, (score < 1 or (molecules = 0 and reads > 0)) as broken from scores", _FLANKED, _SCORES),
    "breakpoints": _sql("select map_id, breakpoint from points", _BREAKS),
    "breakpoints_per_map": _sql("select map_id, array_to_string(list_sort(list(distinct breakpoint)), ',') as breakpoints from points group by map_id", _BREAKS),
    "broken_maps": _sql("""
select cast(case piece when 0 then map_id else (select max(map_id) from map_labels) + rank end as bigint) as map_id, num_sites, site_id, pos, map_length, map_id as of_map, cast(piece as int) as piece
from kept left join (select map_id, piece, row_number() over (order by map_id, piece) as rank from (select distinct map_id, piece from kept where piece > 0)) using (map_id, piece)""", _BREAKS, """
cuts as (select distinct map_id, breakpoint from points),
placed as (
  select l.map_id, l.pos, (select count(*) from cuts c where c.map_id = l.map_id and c.breakpoint < l.pos) as piece,
         coalesce((select max(breakpoint) from cuts c where c.map_id = l.map_id and c.breakpoint < l.pos), 0) as from_pos,
         coalesce((select min(breakpoint) from cuts c where c.map_id = l.map_id and c.breakpoint >= l.pos), l.map_length) as to_pos
  from map_labels l),
kept as (
  select map_id, piece, count(*) over w as num_sites, cast(row_number() over (partition by map_id, piece order by pos) as int) as site_id, pos - from_pos as pos, to_pos - from_pos as map_length
  from placed window w as (partition by map_id, piece) qualify count(*) over w >= 2 and to_pos - from_pos >= 10800000000)
"""),
    "unaligned_maps": _sql("select map_id from maps where confidence < 50"),
    "merged_map_sets": _sql("select * from map_labels"),
    "labels_by_reference": _sql("select ref_id, map_id, map_site as site_id, map_pos as pos from map_pairs"),
    "reduced_resolution": _sql("""
select ref_id, cast(run as bigint) as site_id, cast(round(avg(pos)) as bigint) as pos, count(*) as labels from (
  select *, sum(new) over (partition by ref_id order by pos) as run from (
    select *, case when pos - lag(pos) over (partition by ref_id order by pos) < 10800000000 then 0 else 1 end as new from ref_labels))
group by ref_id, run"""),
    "map_summary": _sql("""
select count(*) as maps, cast(sum(length) as bigint) as total_length, round(avg(length), 1) as mean_length, min(length) as min_length, max(length) as max_length,
       round(sum(labels) * 86400000000.0::double / sum(length), 3) as labels_per_unit,
       (select max(length) from (select length, sum(length) over (order by length desc) as running, sum(length) over () as total from lens) where 2 * running >= total) as n50
from lens""", "lens as (select map_id, any_value(map_length) as length, count(*) as labels from map_labels group by map_id)"),
    "alignment_summary": _sql("""
select ref_id, count(distinct qry_id) as maps, cast(sum(ref_end - ref_start) as bigint) as aligned_length, round(cast(sum(cast(confidence as decimal(18,4))) as double) / count(confidence), 2) as mean_confidence, cast(sum(fresh) as bigint) as covered from (
  select *, greatest(0, ref_end - greatest(ref_start, coalesce(max(ref_end) over (partition by ref_id order by ref_start, ref_end rows between unbounded preceding and 1 preceding), ref_start))) as fresh from alignments)
group by ref_id"""),
} | FORMATS
