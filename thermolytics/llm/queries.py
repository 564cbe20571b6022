"""Registered queries of the operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import collocations, graph_dedup, hard_negatives, langid, lines, mixing, packing, postings, quality, secret_scan, substrings, superminhash, token_tree
from .common import table


def op1_language_id(spark, sf_dir):
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    # Lines inside blocks are counted by documents as well, as in the pipeline; the SQL below has the count by neighbour lines only.
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark, sf_dir):
    out = substrings.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_nearest_neighbours(spark, sf_dir):
    return postings.nearest(table(spark, sf_dir, "embeddings"))


def op10_near_dedup(spark, sf_dir):
    return superminhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op6_embedding_dedup(spark, sf_dir):
    return graph_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark, sf_dir):
    return token_tree.recount(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label=label)


def op13_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_source_mixing": op8_source_mixing,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_near_dedup": op10_near_dedup,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_secret_scan": op13_secret_scan,
}

ORACLE_SQL = {
    "op8_source_mixing": r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         substr(md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')), 1, 9) as hash
  from documents),
sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as i
  from sized group by source),
capped as (
  select *, list_extract([3.0, 1.0, 2.0]::double[], (i % 3 + 1)::int) as w, source_size * 2.0::double as cap from sources),
levels as (
  select *, cap / w as ratio,
         (1.5::double * sum(source_size) over ()
            - coalesce(sum(cap) over (order by cap / w, i rows between unbounded preceding and 1 preceding), 0))
         / (sum(w) over () - coalesce(sum(w) over (order by cap / w, i rows between unbounded preceding and 1 preceding), 0))
         as lvl
  from capped),
targets as (
  select source, source_size,
         coalesce(least(cap, w * (select arg_min(lvl, ratio) from levels where lvl <= ratio)), cap) as target
  from levels),
budgets as (
  select source, source_size, target, epoch,
         least(greatest(target - (epoch - 1) * source_size, 0.0), source_size::double) as budget
  from targets, (values (1), (2)) e(epoch)),
hist as (
  select source, hash, sum(size) as n from sized group by source, hash),
running as (
  select source, hash, n, sum(n) over (partition by source order by hash) as upto from hist),
cuts as (
  select b.source, b.epoch, arg_max(r.hash, r.hash) as edge, arg_max(r.upto, r.hash) as upto,
         arg_max(r.upto - r.n, r.hash) as before, any_value(b.budget) as budget
  from budgets b join running r on b.source is not distinct from r.source and r.upto - r.n <= b.budget
  group by b.source, b.epoch),
taken as (
  select s.doc_id, s.source, s.size, s.hash,
         count(*) filter (where s.hash < c.edge or (s.hash = c.edge and c.upto - c.budget < c.budget - c.before)) as times
  from sized s join cuts c on s.source is not distinct from c.source
  group by s.doc_id, s.source, s.size, s.hash)
select t.doc_id, t.size, g.source_size, g.target, (t.size * t.times)::bigint as taken
from taken t join targets g on t.source is not distinct from g.source
""",
    "op5_line_dedup": r"""
with split as (
  select doc_id, string_split(text, chr(10)) as lines from documents where text is not null),
masks as (
  select doc_id, list_transform(lines, lambda l: regexp_replace(array_to_string(
           regexp_extract_all(l, '[^\x20\x09-\x0D]+'), ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g')) as masks
  from split),
numbered as (
  select doc_id, masks, unnest(generate_series(1, len(masks))) as n from masks),
lined as (
  select doc_id, n - 1 as n, masks[n] as masked, case when n = 1 then '-' else masks[n - 1] end as prev,
         coalesce(masks[n + 1], '-') as next
  from numbered where masks[n] <> ''),
placed as (
  select doc_id, n, masked, prev, next,
         len(string_split(masked, ' ')) as n_words,
         len(string_split(masked, ' '))::varchar || ' ' || array_to_string(string_split(masked, ' ')[1:3], ' ') as leaf
  from lined),
firsts as (
  select masked, leaf, n_words, prev, next, min(doc_id) as first from placed where n_words >= 3 group by all),
support as (
  select masked, leaf, n_words, count(distinct first) as support from firsts group by all),
busy as (
  select * from support where leaf in (select leaf from support group by leaf having sum(support) >= 20)),
words as (
  select masked, leaf, support, n_words, unnest(generate_series(1, n_words)) as p, unnest(string_split(masked, ' ')) as word
  from busy),
constant as (
  select leaf, p, word from words where word <> '<*>' group by leaf, p, word having sum(support) >= 20),
templates as (
  select w.masked, w.leaf, any_value(w.support) as support, any_value(w.n_words) as n_words, count(*) as n_const,
         any_value(w.n_words)::varchar || ' ' || string_agg(w.p::varchar || '=' || w.word, ' ' order by w.p) as template
  from words w join constant c on w.leaf = c.leaf and w.p = c.p and w.word = c.word
  group by w.masked, w.leaf),
fitting as (
  select * from templates
  where n_const >= 2 and n_const >= 0.7 * (n_words - (length(masked) - length(replace(masked, '<*>', ''))) / 3)),
recurring as (
  select masked from fitting
    where template in (select template from fitting group by template having sum(support) >= 20)),
dropped as (
  select doc_id, n from placed where masked in (select masked from recurring)),
kept as (
  select s.doc_id, count(*) as n_lines, count(d.n) as n_dropped,
         string_agg(s.line, chr(10) order by s.n) filter (where d.n is null) as text
  from (select doc_id, unnest(lines) as line, unnest(generate_series(0, len(lines) - 1)) as n from split) s
  left join dropped d on s.doc_id = d.doc_id and s.n = d.n
  group by s.doc_id)
select d.doc_id, coalesce(k.n_lines, 0)::int as n_lines, coalesce(k.n_dropped, 0)::int as n_dropped,
       sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join kept k on d.doc_id = k.doc_id
""",
    "op11_collocations": r"""
with pieces as (
  select lang, list_filter(regexp_extract_all(piece, '[^\x20\x09]+'), lambda w: w <> '') as w
  from (select coalesce(lang, 'und') as lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[.,;:!?\x0A-\x0D]')) as piece
        from documents)),
one as (
  select lang, w, count(*) as f from (select lang, unnest(w) as w from pieces) group by lang, w),
two as (
  select lang, g[1] as w1, g[2] as w2, count(*) as f
  from (select lang, unnest(list_zip(w[:-2], w[2:])) as g from pieces where len(w) >= 2) group by all having count(*) >= 10),
three as (
  select lang, g[1] as w1, g[2] as w2, g[3] as w3, count(*) as f
  from (select lang, unnest(list_zip(w[:-3], w[2:-2], w[3:])) as g from pieces where len(w) >= 3) group by all having count(*) >= 10),
covers as (
  select lang, w1, w2, max(f) as most
  from (select lang, w1, w2, f from three union all select lang, w2, w3, f from three) group by all),
cuts as (
  select t.lang, t.w1 || ' ' || t.w2 as phrase, t.f as a, x.f as l, y.f as r, 1 as k
  from two t join one x on x.lang = t.lang and x.w = t.w1 join one y on y.lang = t.lang and y.w = t.w2
    left join covers c on c.lang = t.lang and c.w1 = t.w1 and c.w2 = t.w2
  where c.most is null or 100 * c.most < 50 * t.f
  union all
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 1
  from three t join one x on x.lang = t.lang and x.w = t.w1 join two y on y.lang = t.lang and y.w1 = t.w2 and y.w2 = t.w3
  union all
  select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, x.f, y.f, 2
  from three t join two x on x.lang = t.lang and x.w1 = t.w1 and x.w2 = t.w2 join one y on y.lang = t.lang and y.w = t.w3),
scored as (
  select *, ((1000000::hugeint * a * a) // (l::hugeint * r))::bigint as score from cuts),
best as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
placed as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select p.lang, p.rank, p.phrase, p.a, p.l, p.r, t.n, p.score
from placed p join (select lang, sum(f)::bigint as n from one group by lang) t on p.lang = t.lang
where p.rank <= 2000
""",
    "op12_hard_negatives": """
with rows as (
  select distinct vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.id as anchor_id, b.id as id, a.label = b.label as same,
         coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1]::hugeint * z[2])), 0)::bigint as score
  from rows a join rows b on a.id % 50 = 0 and a.id <> b.id and len(a.v) = len(b.v)),
positives as (
  select anchor_id, id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.positive_id, n.id as negative_id, p.positive_score, n.score as negative_score,
       row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.id)::int as rank
from positives p join pairs n on p.anchor_id = n.anchor_id and not n.same
  and 50 * p.positive_score <= 100 * n.score and 100 * n.score <= 95 * p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.id) <= 3
""",
    "op13_secret_scan": r"""
with texts as (
  select doc_id, source, row_number() over () as d,
         replace(replace(coalesce(text, ''), chr(1), chr(3)), chr(2), chr(3)) as t
  from documents),
patterns(rank, pattern) as (values
  (0, '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'AKIA[A-Z0-9]+'),
  (2, '[0-9a-f]+')),
parts as (
  select d, rank, string_split(regexp_replace(t, pattern, chr(1) || '\0' || chr(1), 'g'), chr(1)) as p
  from texts, patterns),
placed as (
  select d, rank, i, part, coalesce(sum(length(part)) over (partition by d, rank order by i
           rows between unbounded preceding and 1 preceding), 0)::bigint as start
  from (select d, rank, unnest(p) as part, unnest(generate_series(1, len(p))) as i from parts)),
base as (
  select d, rank, start, (start + length(part))::bigint as stop, value
  from (select *, case when rank = 0 then regexp_extract(part, '["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1) else part end as value
        from placed where i % 2 = 0)
  where length(value) >= case rank when 0 then 6 when 1 then 20 else 24 end),
pieces as (     -- the text without its base spans: what lies between their union
  select d, start, stop from (
    select d, stop as start, coalesce(lead(start) over (partition by d order by start), length(t))::bigint as stop
    from (select b.d, t, min(b.start) as start, max(b.stop) as stop
          from (select *, sum(fresh) over (partition by d order by start, stop desc, rank rows unbounded preceding) as run
                from (select *, case when start < max(stop) over (partition by d order by start, stop desc, rank
                                  rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh
                      from (select d, rank, start, stop from base union all select d, -1, 0, 0 from texts)))
               b join texts x on b.d = x.d group by b.d, t, run))
  where stop > start),
gaps as (
  select p.d, p.start, p.start > 0 as cut_before, p.stop < length(x.t) as cut_after,
         string_split(regexp_replace(substring(x.t, p.start + 1, p.stop - p.start), '[0-9A-Za-z]{20,}', chr(1) || '\0' || chr(1), 'g'), chr(1)) as p
  from pieces p join texts x on p.d = x.d),
runs as (
  select d, cut_before, cut_after, i, n, part, start + coalesce(sum(length(part)) over (partition by d, start order by i
           rows between unbounded preceding and 1 preceding), 0)::bigint as begins,
         lag(part) over (partition by d, start order by i) as left_part, lead(part) over (partition by d, start order by i) as right_part
  from (select d, start, cut_before, cut_after, len(p) as n, unnest(p) as part, unnest(generate_series(1, len(p))) as i from gaps)),
owned as (
  select d, 3 as rank, begins as start, (begins + length(part))::bigint as stop, part as value
  from runs where i % 2 = 0
    and not (i = 2 and left_part = '' and cut_before) and not (i = n - 1 and right_part = '' and cut_after)
    and len(list_distinct(string_split(part, ''))) >= 10
    and length(regexp_replace(part, '[^0-9]', '', 'g')) >= 3 and length(regexp_replace(part, '[0-9]', '', 'g')) >= 3),
spans as (select * from base union all select * from owned),
held as (
  select value, count(distinct coalesce('s' || source, '-')) as owners,
         count(distinct (doc_id is null, doc_id, t)) as repositories
  from spans s join texts x on s.d = x.d group by value),
judged as (
  select s.*, h.owners >= 3 or (h.owners >= 2 and h.repositories >= 20) as copied
  from spans s join held h on s.value = h.value),
told as (
  select d, rank, start, copied, list_extract(['assign', 'access', 'hex', 'owned'], rank::int + 1) || ':' || start || ':' || stop as shown
  from judged where rank < 3 or not copied)
select x.doc_id, count(*) filter (where rank = 0) as n_assign, count(*) filter (where rank = 1) as n_access,
       count(*) filter (where rank = 2) as n_hex, count(*) filter (where rank = 3) as n_owned,
       count(*) filter (where copied) as n_copied,
       sha256(coalesce(string_agg(shown, ',' order by start, rank) filter (where rank < 3), '')) as base_sha256,
       coalesce(string_agg(shown, ',' order by start, rank), '') as spans
from texts x left join told on x.d = told.d
group by x.d, x.doc_id
""",
}
