"""SQL that gives the rows of the queries in ``formats``, for DuckDB."""

from __future__ import annotations

from nickmap.functions.scalars import ENZYMES, IUPAC, IUPAC_COMPLEMENT
from nickmap.plans.inputs import SQL as INPUTS

_LETTERS, _BASES = "abcdefghijklmnopqrstuvwxyz", "ACGT" * 6 + "AC"
_SEQUENCES = f"sequences as (select doc_id as seq_id, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), '{_LETTERS}', '{_BASES}') as bases from documents)"
_HITS = "select seq_id, bases, length(bases) as n, unnest(list_filter(range(1, length(bases) + 1), lambda i: substr(bases, i, {k}) = '{m}')) - 1 as place from sequences"
_FROM, _TO = IUPAC + IUPAC.lower(), IUPAC_COMPLEMENT + IUPAC_COMPLEMENT.lower()
_TURN = lambda x: f"reverse(translate({x}, 'ACGT', 'TGCA'))"


def _sql(select: str, *parts: str) -> str:
    return INPUTS + "".join(f",{p}" for p in parts) + select


def _enzyme(k: int, motif: str) -> str:
    turned = motif.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    return " union all ".join(f"select seq_id, {k} as enzyme, place from ({_HITS.format(k=len(m), m=m)})" for m in (motif, turned))


ORACLE_SQL: dict[str, str] = {
    "alignments_written_and_read": _sql("""
select a.qry_id as entry_id, a.qry_id, a.ref_id, a.orientation, a.confidence, cast(qry_start as double) as qry_start, cast(qry_end as double) as qry_end, cast(ref_start as double) as ref_start,
       cast(ref_end as double) as ref_end, cast(p.map_length as double) as qry_len, n_pairs, first_ref, first_qry, alignment
from alignments a join (
  select map_id, any_value(map_length) as map_length, cast(count(*) as int) as n_pairs, cast(min(ref_site) as int) as first_ref, cast(arg_min(map_site, ref_site) as int) as first_qry,
         string_agg('(' || ref_site || ',' || map_site || ')', '' order by ref_site) as alignment from map_pairs group by map_id) p on p.map_id = a.qry_id"""),
    "sequences_written_and_read": f"with {_SEQUENCES} select 'seq ' || seq_id as name, cast(length(bases) as bigint) as length, (length(bases) + 999) // 1000 as chunks, md5(bases) as digest from sequences",
    "keys_written_and_read": f"with {_SEQUENCES} select seq_id as ref_id, 'seq ' || seq_id as name, cast(length(bases) as bigint) as length from sequences",
    "reads_from_sam": _sql("select 'ref' || ref_id as seq_name, read_start, case when read_end - read_start + 1 > 9 then read_end else read_end end as read_end, read_id, cast(mapq as int) as mapq from reads where mapq <> 70"),
    "reads_by_region": _sql("select site_key, count(distinct read_id) as reads from intervals i join reads r on r.ref_id = i.ref_id and mapq >= 30 and read_start < start_pos - 3 and read_end > end_pos + 3 group by site_key"),
    "noise_read": """
select l_linenumber as Iteration, cast(round(avg(cast(l_discount as decimal(18,4))), 4) as double) as "FN(rate)", cast(round(avg(cast(l_tax as decimal(18,4))), 4) as double) as sf,
       cast(round(avg(cast(l_quantity as decimal(18,4))), 4) as double) as sd, cast(round(avg(cast(l_extendedprice as decimal(18,4))), 4) as double) as sr
from lineitem where l_linenumber = (select max(l_linenumber) from lineitem) group by l_linenumber""",
    "sites_from_many_files": _sql("select *, start_pos as thick_start, end_pos as thick_end from sites"),
    "labels_written_by_reference": _sql("select ref_id, map_id, map_site as site_id, map_pos as pos from map_pairs"),
    "labels_written_by_map": _sql("select map_id, num_sites, site_id, pos from map_labels"),
    "site_sequences_written_and_read": f"""
with {_SEQUENCES},
hits as (
  select seq_id, place as pos, 1 as strand, 0 as step from ({_HITS.format(k=3, m='GCA')}) where place + 3 < n
  union all select seq_id, place + 3, -1, 1 from ({_HITS.format(k=3, m='TGC')}) where place + 3 < n),
nicked as (select seq_id, pos, arg_max(strand, step) as strand from hits group by seq_id, pos),
near as (select *, lead(pos) over w as pos2, lead(strand) over w as strand2 from nicked window w as (partition by seq_id order by pos)),
typed as (select seq_id, pos, pos2, case strand when 1 then 'TypeI' else 'TypeII' end as site_type from near where strand = -strand2 and pos2 - pos <= 200),
stretched as (select t.*, greatest(pos - 50, 1) as a, case when pos2 + 50 > length(bases) then length(bases) - 1 else pos2 + 50 end as z, bases from typed t join sequences using (seq_id))
select concat_ws('_', seq_id, pos, pos2, site_type) as name, cast(z - a + 1 as bigint) as length, substr(bases, a, z - a + 1) as bases from stretched""",
    "padded_fields_read": _sql("select * from end_ratios"),
    "complements": f"""
select seq_id, md5(translate(bases, '{_FROM}', '{_TO}')) as complement, md5(reverse(translate(bases, '{_FROM}', '{_TO}'))) as reverse_complement
from (select doc_id as seq_id, regexp_replace(text, '[^A-Za-z]', '', 'g') as bases from documents)""",
    "enzyme_sites": f"with {_SEQUENCES} select seq_id, enzyme, count(distinct place) as sites from ({' union all '.join(_enzyme(k, ENZYMES[name]) for k, name in enumerate(sorted(ENZYMES)))}) group by seq_id, enzyme",
    "motif_null_model": f"""
with {_SEQUENCES},
motifs as (select i as motif_id, translate(substr(md5('42:' || i), 1, 6), '0123456789abcdef', '{'ACGT' * 4}') as motif from range(1000) t(i)),
runs as (select distinct motif_id, motif, unnest([motif, {_TURN('motif')}]) as run from motifs),
counts as (select run, count(*) as n from (select unnest(list_transform(range(1, length(bases) - 4), lambda i: substr(bases, i, 6))) as run from sequences where length(bases) >= 6) group by run),
letters as (select sum(length(bases)) as total, {', '.join(f"sum(length(bases) - length(replace(bases, '{x}', ''))) as {x}" for x in 'ACGT')} from sequences),
places as (select sum(greatest(length(bases) - 5, 0)) as places from sequences),
chances as (
  select motif_id, motif, run, coalesce(n, 0) as n, ({' * '.join(f"(case substr(run, {i}, 1) when 'A' then A when 'C' then C when 'G' then G else T end / total::double)" for i in range(1, 7))}) as chance
  from runs left join counts using (run), letters)
select motif_id, motif, cast(sum(n) as bigint) as observed, round(sum(chance) * any_value(places), 3) as expected from chances, places group by motif_id, motif""",
    "log_coverage": _sql("select ref_id, site_id, case when floor(coverage / 10) <> 0 then round(log10(floor(coverage / 10)), 6) else 0.0 end as log_coverage from ref_labels"),
    "named_references": """
with names as (
  select distinct 'contig_' || lower(n_name) || '_' || (s_suppkey % 7) as seq_name from supplier join nation on s_nationkey = n_nationkey
  union select substr(n_name, 2, 4) from nation),
held as (
  select seq_name, n_nationkey as ref_id, length(n_name) as size from names, nation
  where seq_name <> '' and n_name <> '' and (contains(lower(seq_name), lower(n_name)) or contains(lower(n_name), lower(seq_name))))
select seq_name, cast(arg_min(ref_id, (-size, ref_id)) as bigint) as ref_id from held group by seq_name""",
    "nothing_to_merge": _sql("select l.*, confidence from map_labels l left join alignments a on a.qry_id = l.map_id"),
}
