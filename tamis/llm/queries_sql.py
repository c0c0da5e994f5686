"""What the queries must return, as SQL for the check engine, by the plainest way."""

MIX_SQL = r"""
with rows as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
        (('0x' || substr(md5('17|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))), 1, 13))::bigint
            + 0.5::double) / 4503599627370496::double as u
    from documents),
sizes as (
    select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as k
    from rows group by source),
weighted as (
    select *, source_size * 2.0::double as cap,
        (case k % 3 when 0 then 5 when 1 then 2 else 1 end)::double as weight from sizes),
levels as (
    select *, cap / weight as ratio, (sum(source_size) over ())::double * 1.5::double as budget,
        coalesce(sum(cap) over before, 0) as capped,
        sum(weight) over () - coalesce(sum(weight) over before, 0) as remaining
    from weighted
    window before as (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding)),
level as (select max((budget - capped) / remaining) as level from levels),
goals as (select source, source_size, least(cap, level * weight) as target from levels, level),
expected as (
    select r.*, source_size, target,
        case when source_size > 0 then target / source_size else 0 end as expected
    from rows r join goals g on r.source is not distinct from g.source),
split as (
    select *, floor(expected)::bigint as certain, expected - floor(expected) as p,
        target - floor(expected) * source_size as rest from expected),
odds as (
    select *, case when p > 0 then (u / (1 - u)) / (p / (1 - p)) end as odds from split),
running as (
    select *, coalesce(sum(size) over (partition by source order by odds nulls last, doc_id, size
        rows between unbounded preceding and 1 preceding), 0) as so_far from odds),
drawn as (
    select *, certain + (odds is not null and so_far + size / 2.0::double <= rest)::bigint as copies from running)
select doc_id, size, source_size, target, copies * size as taken, source, copies from drawn
"""

_LEVEL = r"""
{name}_joined as (
    select c.*, p.mean as prior from {children} c join {parents} p on c.{key} = p.{key}),
{name}_moments as (
    select sum(pow(bad - n * prior, 2) / (prior * (1 - prior)) - n) as over_, sum(n * (n - 1))::double as pairs
    from {name}_joined),
{name}_strength as (
    select 1 / least(greatest(case when pairs > 0 then over_ / pairs else 0 end, 1.0::double / 1001), 0.5::double) - 1 as s
    from {name}_moments),
{name} as (
    select * exclude (prior, s), (bad + s * prior) / (n + s) as mean, n + s as precision_
    from {name}_joined, {name}_strength)"""

URL_SQL = r"""
with parts as (
    select page_id,
        translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
    from pages),
known as (
    select host, count(*) as n, sum((quality = 0 or toxic = 1)::bigint) as bad
    from parts join labels on page_id = doc_id group by host),
labelled as (
    select host, coalesce(n, 0) as n, coalesce(bad, 0)::bigint as bad, string_split(host, '.') as labels
    from (select distinct host from parts) left join known using (host)),
cut as (
    select *, case when len(labels) > 2 and array_to_string(labels[-2:], '.') in (
        'co.uk', 'org.uk', 'ac.uk', 'gov.uk', 'com.au', 'net.au', 'org.au', 'co.jp', 'or.jp', 'ne.jp', 'com.br',
        'com.cn', 'co.in', 'co.kr', 'co.nz', 'co.za', 'com.mx', 'com.tr', 'com.tw') then 2 else 1 end as k
    from labelled),
host_counts as (
    select host, n, bad, array_to_string(labels[greatest(len(labels) - k + 1, 1):], '.') as suffix,
        array_to_string(labels[greatest(len(labels) - k, 1):], '.') as domain from cut),
domain_counts as (select domain, suffix, sum(n) as n, sum(bad) as bad from host_counts group by all),
suffix_counts as (select suffix, sum(n) as n, sum(bad) as bad from domain_counts group by all),
overall as (
    select suffix, (select (coalesce(sum(bad), 0) + 1.0::double) / (coalesce(sum(n), 0) + 2.0::double) from suffix_counts) as mean
    from suffix_counts),""" + ",".join((
    _LEVEL.format(name="suffixes", children="suffix_counts", parents="overall", key="suffix"),
    _LEVEL.format(name="domains", children="domain_counts", parents="suffixes", key="suffix"),
    _LEVEL.format(name="hosts", children="host_counts", parents="domains", key="domain"))) + r""",
scored as (
    select *, mean - 1.645::double * sqrt(mean * (1 - mean) / (precision_ + 1)) as bound from hosts),
rules(rule_host, rule_path, rule_verdict) as (values
    ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits as (
    select page_id, host, path, max_by(rule_host || rule_path, length(rule_host || rule_path)) as rule,
        max_by(rule_verdict, length(rule_host || rule_path)) as rule_verdict
    from (select distinct page_id, host, path from parts) join rules
        on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
    group by all)
select p.page_id, p.host, p.path, f.rule,
    coalesce(f.rule_verdict, case when bound > 0.5 then 'block' else 'allow' end) as verdict,
    s.n::bigint as n_labelled, s.bad::bigint as n_bad, round(s.mean, 6) as bad_share, round(s.bound, 6) as bound
from parts p join scored s using (host)
left join fits f on f.page_id is not distinct from p.page_id and f.host = p.host and f.path = p.path
"""

MATCH_SQL = r"""
with lowered as (
    select 'd' as kind, doc_id as id, text from documents union all select 'b', item_id, text from benchmark),
words as (
    select kind, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from lowered),
items as (select id, w, least(10, len(w)) as size from words where kind = 'b' and len(w) > 0),
windows as (
    select distinct id as item_id, size, array_to_string(w[i:i + size - 1], ' ') as gram
    from (select *, unnest(range(1, len(w) - size + 2)) as i from items)),
grams as (
    select id as doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as gram
    from (select words.id, w, size, unnest(range(1, len(w) - size + 2)) as i
        from words, (select distinct size from items) where kind = 'd' and len(w) >= size)),
met as (select doc_id, item_id, i, size from grams join windows using (size, gram)),
hit as (select doc_id, count(distinct p) as n_hit
    from (select doc_id, unnest(range(i, i + size)) as p from (select distinct doc_id, i, size from met)) group by doc_id),
named as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
    from (select distinct doc_id, item_id::varchar as item_id from met) group by doc_id)
select id as doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit on hit.doc_id = id left join named on named.doc_id = id where kind = 'd'
"""

# DuckDB gives SHA-1 as hex digits; base 32 takes them in groups of five bits.
WARC_SQL = r"""
with payloads as (
    select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as hex from pages),
bits as (
    select page_id, payload_bytes, hex, array_to_string([
        lpad(bin(('0x' || substr(hex, i, 5))::int), 20, '0') for i in range(1, 41, 5)], '') as b from payloads),
named as (
    select page_id, payload_bytes, array_to_string([
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum([
            substr(b, i * 5 + j, 1)::int << (5 - j) for j in range(1, 6)])::int, 1) for i in range(0, 32)], '') as payload_digest
    from bits),
leaders as (select payload_digest, payload_bytes, max(page_id) as leader from named group by all)
select page_id, payload_bytes, payload_digest,
    case when page_id = leader then 'response' else 'revisit' end as record_type,
    case when page_id <> leader then leader end as refers_to
from named join leaders using (payload_digest, payload_bytes)
"""

# Pieces end behind a line end, or behind punctuation that white space follows; chr(1) marks the ends.
LINE_SQL = r"""
with marked as (
    select doc_id, text, string_split(regexp_replace(regexp_replace(coalesce(text, ''),
        '([.!?]+)([ \t\x0b\x0c\r])', '\1' || chr(1) || '\2', 'g'), '\n', chr(10) || chr(1), 'g'), chr(1)) as parts
    from documents),
pieces as (
    select doc_id, k, parts[k] as raw, len(regexp_extract_all(parts[k], '[^\x20\x09-\x0D]+')) as words
    from (select *, unnest(range(1, len(parts) + 1)) as k from marked) where parts[k] <> ''),
-- A piece closes a unit if it is long or ends its line, unless the unit has no words yet.
closing as (
    select *, words >= 3 or (ends_with(raw, chr(10)) and (words > 0 or glued > 0)) as closes
    from (select *, case when k > 1 and not lag_closes then 1 else 0 end as glued
        from (select *, lag(words >= 3 or ends_with(raw, chr(10))) over w as lag_closes from pieces
            window w as (partition by doc_id order by k)))),
numbered as (
    select *, coalesce(sum(closes::int) over (partition by doc_id order by k
        rows between unbounded preceding and 1 preceding), 0)::bigint as unit from closing),
units as (
    select doc_id, unit, string_agg(raw, '' order by k) as raw, sum(words)::bigint as words from numbered group by all),
hashed as (
    select *, sum(length(raw)) over (partition by doc_id order by unit) - length(raw) as start,
        case when words > 0 then translate(array_to_string(regexp_extract_all(raw, '[^\x20\x09-\x0D]+'), ' '),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end as norm from units),
ranked as (
    select *, norm is not null and row_number() over (partition by norm order by doc_id, unit) > 1 as later from hashed),
runs as (
    select *, unit - row_number() over (partition by doc_id, later order by unit) as run from ranked),
removed as (
    select doc_id, run, min(start) as start, sum(length(raw)) as size from runs where later group by all),
spans as (
    select doc_id, string_agg(start::bigint || '+' || size::bigint, ',' order by start) as spans,
        sum(size)::bigint as removed_chars from removed group by doc_id),
kept as (
    select doc_id, string_agg(raw, '' order by unit) filter (where not later) as kept_text,
        count(*) filter (where words > 0) as n_units from ranked group by doc_id)
select d.doc_id, coalesce(n_units, 0)::bigint as n_units, coalesce(removed_chars, 0)::bigint as removed_chars,
    coalesce(spans, '') as spans, case when d.text is not null then coalesce(kept_text, '') end as kept_text
from documents d left join kept using (doc_id) left join spans using (doc_id)
"""
