"""DuckDB SQL for the contract queries that SQL can express.

Each states its contract directly: no automaton, filter, bucket or sample appears here.
Op 4 adds a classifier's spans and ops 5 and 8 a network's and a sketch's results, which SQL can't
express; they are tested against brute-force versions and held-out accuracy.
"""

from __future__ import annotations

from civicflow.llm.mixing import MAX_EPOCHS, SEED
from civicflow.llm.sharding import SHARDS, SLOTS, walk
from civicflow.llm.url_filter import RULES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(pattern: str, text: str) -> str:
    return f"coalesce(regexp_extract_all({text}, '{pattern}'), [])"


OP1 = f"""
with items as (
  select coalesce(cast(item_id as varchar), '') as item, w, len(w) as n
  from (select item_id, {_words(_ALNUM, _LOWER.format('text'))} as w from benchmark) t where len(w) > 0),
windows as (
  select distinct item, array_to_string(w[i:i + least(n, 10) - 1], ' ') as win, least(n, 10) as size
  from (select *, unnest(range(1, n - least(n, 10) + 2)) as i from items) t),
docs as (
  select row_number() over () as r, doc_id, {_words(_ALNUM, _LOWER.format('text'))} as w from documents),
sizes as (select distinct size from windows),
places as (
  select r, i, size, array_to_string(w[i:i + size - 1], ' ') as win
  from (select r, w, size, unnest(range(1, len(w) - size + 2)) as i from docs, sizes) t),
found as (select r, i, p.size, item from places p join windows using (win, size)),
hit as (
  select r, count(*) as n_hit from (
    select distinct r, unnest(range(i, i + size)) as at from (select distinct r, i, size from found) f) h group by r),
named as (select r, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct r, item from found) f group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (r) left join named using (r)"""

OP2 = f"""
with docs as (
  select doc_id, source, cast(len({_words(_SPACED, 'text')}) as bigint) as size,
    md5('{SEED}:' || coalesce(cast(doc_id as varchar), '')) as turn from documents),
sources as (
  select source, cast(sum(size) as bigint) as s, {MAX_EPOCHS} * cast(sum(size) as bigint) as cap,
    cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as bigint) as w from docs group by source),
-- The clamped sources are the first ones by cap per weight, as far as each is below the level of what is left.
levels as (
  select *, sum(cap) over before as capped_before, sum(w) over from_here as weights_here, (select sum(s) from sources) as pool
  from sources window before as (order by cast(cap as double) / w, source nulls last rows between unbounded preceding and 1 preceding),
    from_here as (order by cast(cap as double) / w, source nulls last rows between current row and unbounded following)),
clamped as (select *, cap * weights_here < w * (pool - coalesce(capped_before, 0)) as clamp from levels),
rest as (select (select any_value(pool) from clamped) - coalesce(sum(cap) filter (where clamp), 0) as left_over, sum(w) filter (where not clamp) as weights from clamped),
targets as (
  select source, s, case when clamp then cast(cap as double) else cast(left_over as double) * w / cast(weights as double) end as target
  from clamped, rest),
goals as (select *, cast(round(target) as bigint) as goal, if(s > 0, cast(round(target) as bigint) // s, 0) as epochs from targets),
placed as (
  select d.*, s, target, epochs, goal - epochs * s as extra,
    coalesce(sum(size) over (partition by d.source order by turn, doc_id nulls first, size rows between unbounded preceding and 1 preceding), 0) as before
  from docs d join goals g on d.source is not distinct from g.source)
select doc_id, size, s as source_size, target, cast(epochs * size + greatest(0, least(size, extra - before)) as bigint) as taken from placed"""


def _op3() -> str:
    """One turn a step: the shard whose turn it is claims the first free slot of its walk."""
    walks = ", ".join(f"({i}, '{s}', {walk(s, SLOTS)[0]}, {walk(s, SLOTS)[1]})" for i, s in enumerate(SHARDS))
    n = len(SHARDS)
    return f"""
with recursive walks(i, shard, first, skip) as (values {walks}),
-- owner: the shard number of each slot, -1 for a free one; steps: how far each shard has walked
fill(turn, owner, steps) as (
  select 0, list_transform(range({SLOTS}), lambda x: -1), list_transform(range({n}), lambda x: 0)
  union all
  select turn + 1, list_concat(list_concat(owner[1:slot], [i]), owner[slot + 2:]), list_concat(list_concat(steps[1:i], [k + 1]), steps[i + 2:])
  from (select *, (first + k * skip) % {SLOTS} as slot from (
    select f.turn, f.owner, f.steps, w.i, w.first, w.skip,
      list_filter(range(f.steps[w.i + 1], {SLOTS}), lambda k: f.owner[(w.first + k * w.skip) % {SLOTS} + 1] = -1)[1] as k
    from fill f join walks w on w.i = f.turn % {n} where f.turn < {SLOTS}) t) s),
slots as (select unnest(range({SLOTS})) as slot, unnest(owner) as i from fill where turn = {SLOTS}),
docs as (
  select doc_id, cast(('0x' || left(md5(coalesce(cast(doc_id as varchar), '')), 8))::bigint % {SLOTS} as integer) as slot from documents)
select doc_id, docs.slot, shard from docs join slots using (slot) join walks using (i)"""


OP6 = f"""
with recursive docs as (
  select row_number() over () as r, doc_id, {_words(_SPACED, _LOWER.format('text'))} as w from documents),
grams as (
  select distinct r, array_to_string(w[i:i + 4], ' ') as g
  from (select r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from docs where len(w) > 0) t),
sizes as (select r, count(*) as n from grams group by r),
links as (
  select a.r as x, b.r as y from grams a join grams b on a.g = b.g and a.r < b.r
  join sizes sa on sa.r = a.r join sizes sb on sb.r = b.r
  group by a.r, b.r, sa.n, sb.n having 100 * count(*) >= 75 * (sa.n + sb.n - count(*))),
edges as (select x, y from links union select y, x from links),
reach as (select r as x, r as y from docs union select reach.x, edges.y from reach join edges on edges.x = reach.y),
least_id as (select reach.x as r, min(doc_id) as component_id from reach join docs on docs.r = reach.y group by reach.x)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id
from docs join least_id using (r) left join sizes using (r)"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP7 = f"""
with pages_ as (
  select page_id, coalesce(html, '') as body from pages),
digests as (
  select page_id, body, strlen(body) as payload_bytes, sha1(body) as hex from pages_),
bits as (
  select *, array_to_string(list_transform(range(1, 41), lambda k: right('000' || bin(instr('0123456789abcdef', hex[k]) - 1), 4)), '') as b
  from digests),
firsts as (select body, min(page_id) as first from pages_ group by body)
select page_id, cast(payload_bytes as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: '{_BASE32}'[cast(('0b' || substr(b, 5 * k + 1, 5)) as integer) + 1]), '') as payload_digest,
  if(first is null or page_id is not distinct from first, 'response', 'revisit') as record_type,
  if(page_id is not distinct from first, null, first) as refers_to
from bits join firsts using (body)"""


def _op9() -> str:
    host = f"coalesce({_LOWER.format('regexp_extract(url, ' + chr(39) + '(?s)^.*?://([^/?#]*)' + chr(39) + ', 1)')}, '')"
    path = "coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
with parts as (select row_number() over () as r, page_id, {host} as host, {path} as path from pages),
named as (
  select *, regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '(/|\\.html)$', '') as key from parts),
fits as (
  select r, arg_max(h || p, length(h || p)) as rule, arg_max(v, length(h || p)) as ruled
  from parts join (values {rules}) as t(h, p, v) on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by r),
listed as (select distinct key from named where page_id % 100 = 0 and key <> '')
select page_id, host, path, rule, coalesce(ruled, if(l.key is null, 'allow', 'block')) as verdict, l.key is not null as listed
from named left join fits using (r) left join listed l on l.key = named.key"""


OP10 = f"""
with docs as (select doc_id, {_words(_SPACED, 'text')} as w from documents),
windows as (
  select doc_id, i, array_to_string(w[i:i + 19], ' ') as win
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from docs where len(w) >= 20) t),
later as (
  select doc_id, i from (select *, row_number() over (partition by win order by doc_id, i) as nth from windows) t where nth > 1),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as place from later),
marks as (select doc_id, list(place) as places, count(*) as n from gone group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed,
  sha256(if(n is null, array_to_string(w, ' '),
    coalesce(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: not list_contains(places, i)), lambda i: w[i]), ' '), ''))) as kept_sha256
from docs d left join marks m using (doc_id)"""


def _op11() -> str:
    """Matches and the pieces between them give the positions; access keys and hexadecimal runs are maximal, so a
    shorter match can be left out by the pattern or by its length alike."""
    either = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    keyword = "|".join(map(either, ("password", "passwd", "secret", "token", "api_?key")))
    assign = f"({keyword})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
    rules = [("assign", assign, f"length(regexp_extract(m, '{assign}', 2)) >= 12"), ("access", "AKIA[A-Z0-9]+", "length(m) >= 18"),
             ("hex", "[0-9a-f]+", "length(m) >= 16"), ("github", "gh[oprsu]_[A-Za-z0-9]{36,}", "true"),
             ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "true"), ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "true"),
             ("login", r"[a-z][a-z0-9+.-]*://[A-Za-z0-9._~%-]+:[^\x00-\x20\"''/@]{3,}@", "true")]
    found = " union all ".join(f"""
  select r, {k} as rank, '{kind}' as kind, start, start + length(m) as end_, {check} as good from (
    select r, m[i] as m, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as start
    from (select *, unnest(range(1, len(m) + 1)) as i from (
      select r, regexp_extract_all(text, '{pattern}') as m, string_split_regex(text, '{pattern}') as p from docs) t) u) v"""
                             for k, (kind, pattern, check) in enumerate(rules))
    spelled = lambda where: f"coalesce(string_agg(kind || ':' || start || ':' || end_, ',' order by start, rank) filter (where {where}), '')"
    return f"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
found as ({found}),
per as (
  select r, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
    count(*) filter (where kind = 'hex') as n_hex, {spelled("rank < 3")} as base, {spelled("true")} as spans
  from found where good group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from docs left join per using (r)"""


def _op12() -> str:
    """Forward dynamic programme, a step per row: for each state the cheapest and of equals the ASCII-least edits so far."""
    blank, cut = r"^[\x20\x09-\x0D]*$", r"[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$"
    inserts = """
      select conv_id, i, 0 as k, q, cost, audit, body from {0}
      union all select conv_id, i, 1, [2, 2, 3, 2][q + 1], cost + 3, audit || 'I', body || [['user:', 'user:', 'assistant:', 'user:'][q + 1]] from {0}
      union all select conv_id, i, 2, [3, 3, 2, 3][q + 1], cost + 6, audit || 'II',
        body || [['user:', 'user:', 'assistant:', 'user:'][q + 1], ['assistant:', 'assistant:', 'user:', 'assistant:'][q + 1]] from {0}"""
    return f"""
with recursive hurt as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key
  from conversations),
bits as materialized (select k, list_reduce(list_prepend(k, range(8)), lambda c, x: if(c & 1 = 1, xor(3988292384, c >> 1), c >> 1)) as v from (select unnest(range(256)) as k) t),
crcs as (select list(v order by k) as t from bits),
faults as (
  select h.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: cast(ascii(key[i]) as bigint))),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 as fault from hurt h, crcs),
rows_ as (
  select conv_id, turn, if(fault = 4, 'user', role) as role, case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text, copy
  from (select *, unnest(if(fault = 3, [0, 1], [0])) as copy from faults where fault <> 0) t),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i, role[1] as init,
    if(regexp_matches(text, '{blank}'), 'b', '') as blank, regexp_matches(text, '{cut}') as cut from rows_),
judged as (
  select *, case when blank = 'b' then 'b' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd' when cut then 't' else '' end as f,
    lag(init) over (partition by conv_id order by i) || init as pair from placed),
counts as (
  select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (where f = 'b') as blank, count(*) filter (where f = 'd') as duplicate,
    count(*) filter (where f = 't') as truncated, count(*) filter (where i > 1 and pair not in ('su', 'ua', 'au')) as illegal, max(i) as n from judged group by conv_id),
best as (
  select conv_id, cast(0 as bigint) as i, 0 as q, 0 as cost, '' as audit, cast([] as varchar[]) as body from counts
  union all
  select conv_id, i + 1, q, min(cost), arg_min(audit, (cost, audit)), arg_min(body, (cost, audit)) from (
    select b.conv_id, b.i, e.q, b.cost + e.c as cost, b.audit || e.name as audit, if(e.name = 'D', body, body || [e.said]) as body
    from ({inserts.format('best')}) b join judged j on j.conv_id is not distinct from b.conv_id and j.i = b.i + 1,
    lateral (
      select 'D' as name, 4 as c, b.q as q, '' as said
      union all select 'K', if(j.f = 't', 3, 0), case j.init when 's' then 1 when 'u' then 2 else 3 end, j.role || ':' || j.text
        where j.f not in ('b', 'd') and ((b.q = 0 and j.init in ('s', 'u')) or (b.q in (1, 3) and j.init = 'u') or (b.q = 2 and j.init = 'a'))
      union all select 'R', if(j.f = 't', 6, 3), [2, 2, 3, 2][b.q + 1], ['user:', 'user:', 'assistant:', 'user:'][b.q + 1] || j.text where j.f not in ('b', 'd')) e) s
  group by conv_id, i, q),
ends as (
  select conv_id, cost, audit, body from ({inserts.format('(select b.* from best b join counts c on c.conv_id is not distinct from b.conv_id and c.n = b.i) z')}) w where q in (0, 3)),
answer as (select conv_id, min(cost) as cost, arg_min(audit, (cost, audit)) as audit, arg_min(body, (cost, audit)) as body from ends group by conv_id)
select o.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, cast(coalesce(cost, 0) as bigint) as cost, coalesce(audit, '') as audit, sha256(coalesce(array_to_string(body, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id
left join answer a on a.conv_id is not distinct from o.conv_id"""


OP13 = r"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
terms as (select r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
kept as (select lang, term from terms group by lang, term having count(distinct r) >= 10),
counts as (select lang, source, term, count(*) as n from terms join kept using (lang, term) group by lang, source, term),
vs as (select lang, count(*) as v from kept group by lang),
groups as (
  select g.lang, g.source, coalesce(v, 0) as v, coalesce(sum(n), 0) as total
  from (select distinct lang, source from docs) g left join vs using (lang) left join counts c on c.lang = g.lang and c.source = g.source group by all),
shares as (
  select g.lang, g.source, k.term, coalesce(n, 0) as n, cast(1 + cast(1000000000 as hugeint) * (coalesce(n, 0) + 2) // (cast(total as hugeint) + 2 * v) as bigint) as p
  from groups g join kept k on k.lang = g.lang left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
langs as (
  select lang, term, cast(1 + cast(1000000000 as hugeint) * (sum(n) + 2) // (cast(any_value(total) as hugeint) + 2 * any_value(v)) as bigint) as q
  from counts join (select lang, sum(total) as total, any_value(v) as v from groups group by lang) t using (lang) group by lang, term),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join shares x on x.lang = a.lang and x.source = a.source left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by a.lang, a.source, b.source),
singles as (
  select s.lang, source, 'term' as part, s.term as item, (p - q) * (p - q) // (p + q) as value
  from shares s join langs l on l.lang = s.lang and l.term = s.term where n > 0 and p > q),
ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (select * from pairs union all select * from singles) t)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked where part = 'pair' or rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1, "op2_mixing": OP2, "op3_sharding": _op3(), "op6_ngram_join": OP6, "op7_warc": OP7, "op9_url_filter": _op9(),
            "op10_substring_dedup": OP10, "op11_secret_ledger": _op11(), "op12_turn_repair": _op12(), "op13_source_divergence": OP13}
