"""SQL of the operators that SQL can express, for another engine over the same tables.

Written anew from the contracts: windows and shingles are compared as text, links are followed
by recursion. The rest (automata, trained models, tokenizers, packing, shards) is tested
against brute force or the libraries instead.
"""

SPACE = r"[\x20\x09-\x0D]+"
WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE}'), lambda w: w <> '')"
LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

# Fixed values of the quality rules, as text.
PHRASES = [
    "all rights reserved", "accept cookies", "cookie policy", "cookie settings",
    "creative commons", "general public license", "lorem ipsum", "licensed under",
    "privacy policy", "released under the", "sign in to", "subscribe to our",
    "terms of service", "terms of use", "this site uses cookies", "use of cookies",
    "enable javascript",
]
_PHRASE = "|".join(PHRASES)

QUALITY = f"""
with docs as (select doc_id, coalesce(text, '') as text, {WORDS} as words from documents),
lines as (select doc_id, unnest(str_split(text, chr(10))) as line,
                 unnest(range(1, len(str_split(text, chr(10))) + 1)) as nr from docs),
judged as (
  select doc_id, line, regexp_matches(line, '[^\\x20\\x09-\\x0D]') as has_word,
    len(list_filter(regexp_split_to_array(line, '{SPACE}'), lambda w: w <> '')) as n,
    length(regexp_replace(line, '{SPACE}', '', 'g')) as chars,
    len(regexp_extract_all(line, '[!?]{{2,}}')) as doubled,
    len(regexp_extract_all(line, '[|»›•]')) as separators,
    len(regexp_extract_all(line, '[#*$%&|<>]')) as symbols
  from lines),
lost as (
  select doc_id, sum(chars) as word_chars,
    count(*) filter (where has_word) - count(distinct line) filter (where has_word) as n_dup_lines,
    coalesce(sum(chars) filter (where has_word and (
      not regexp_matches(line, '[.!?…。！？][\\x20\\x09-\\x0D"''»”’)\\]]*$')
      or doubled * 4 > n or separators >= 3 or symbols * 2 > n
      or regexp_matches(lower(line), '{_PHRASE}'))), 0) as lost_chars
  from judged group by doc_id),
places as (select doc_id, unnest(range(1, len(words) - 1)) as pos, words from docs),
grams as (select doc_id, pos, words[pos:pos + 2] as gram from places),
repeated as (select doc_id, pos from (
  select doc_id, pos, count(*) over (partition by doc_id, gram) as n from grams) where n > 1),
covered as (select doc_id, count(distinct word) as n from (
  select doc_id, unnest([pos, pos + 1, pos + 2]) as word from repeated) group by doc_id),
counts as (
  select docs.doc_id, len(words)::bigint as n_words, word_chars::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
    n_dup_lines::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words,
    lost_chars::bigint as lost_chars
  from docs join lost using (doc_id) left join covered using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
    and 100 * lost_chars <= 30 * word_chars as kept, lost_chars
from counts"""

NEAR_DUPLICATES = f"""
with recursive docs as (
  select doc_id, list_filter(regexp_split_to_array({LOWER}, '{SPACE}'), lambda w: w <> '') as words
  from documents),
shingles as (
  select distinct doc_id, unnest(case when len(words) = 0 then [] when len(words) < 3 then [words]
    else list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2]) end) as shingle from docs),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by all),
links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reached as (
  select doc_id, doc_id as node from documents
  union select reached.doc_id, links.b from reached join links on links.a = reached.node),
components as (select doc_id, min(node) as component_id from reached group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, component_id = doc_id as kept
from components left join sizes using (doc_id)"""

SUBSTRINGS = f"""
with docs as (select doc_id, {WORDS} as words from documents),
windows as (
  select doc_id, pos, array_to_string(words[pos:pos + 49], ' ') as content
  from (select doc_id, words, unnest(range(1, len(words) - 48)) as pos from docs)),
firsts as (select content, min(doc_id) as first from windows group by content),
repeated as (select doc_id, pos from windows join firsts using (content) where doc_id > first),
gone as (select distinct doc_id, unnest(range(pos, pos + 50)) as pos from repeated),
placed as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from docs),
kept as (
  select doc_id, string_agg(word, ' ' order by pos) as words, count(*) as n
  from placed anti join gone using (doc_id, pos) group by doc_id)
select docs.doc_id, len(docs.words)::bigint as n_words,
  (len(docs.words) - coalesce(kept.n, 0))::bigint as n_removed,
  sha256(coalesce(kept.words, '')) as kept_sha256
from docs left join kept using (doc_id)"""

DIVERGENCE = r"""
with docs as (
  select row_number() over () as nr, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
occurring as (select nr, lang, source, unnest(terms) as term from docs),
kept as (select lang, term from occurring group by lang, term having count(distinct nr) >= 30),
found as (select lang, source, term, count(*) as n from occurring join kept using (lang, term) group by all),
sizes as (select lang, count(*) as v from kept group by lang),
groups as (
  select lang, source, coalesce(v, 0) as v, coalesce(total, 0) as total
  from (select distinct lang, source from docs) left join sizes using (lang)
  left join (select lang, source, sum(n) as total from found group by all) using (lang, source)),
wholes as (
  select lang, term, sum(n) as n, sum(sum(n)) over (partition by lang) as total from found group by lang, term),
priced as (
  select lang, source, term, coalesce(found.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(found.n, 0) + 5)) // (groups.total + 5 * v) as p,
    1 + (1000000000::hugeint * (wholes.n + 5)) // (wholes.total + 5 * v) as q
  from groups join wholes using (lang) left join found using (lang, source, term)),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum(value), 0)::bigint as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source as s, y.source as t, abs(x.p - y.p) as value from priced x
             join priced y on x.lang = y.lang and x.term = y.term and x.source <> y.source)
d
    on d.lang = a.lang and d.s = a.source and d.t = b.source
  group by all),
terms as (
  select lang, source, 'term' as part, term as item, (p - q)::bigint as value from priced where n > 0 and p > q)
select * from (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
  from (select * from pairs union all select * from terms))
where part = 'pair' or rank <= 50"""

MIXING = r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    coalesce(doc_id::varchar, '-' || md5(coalesce(text, ''))) as key
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
    ([1, 2, 3])[((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::hugeint as weight
  from docs group by source),
levels as (
  select a.source, any_value(a.source_size) as source_size, any_value(a.weight) as weight,
    sum(least(3 * b.source_size::hugeint * a.weight, 3 * a.source_size::hugeint * b.weight))
      < any_value(a.weight) * sum(b.source_size) as stops
  from sources a cross join sources b group by a.source),
rest as (
  select sum(source_size)::hugeint - coalesce(sum(3 * source_size) filter (where stops), 0)::hugeint as words,
    sum(weight) filter (where not stops)::hugeint as weight from levels),
shares as (
  select source, source_size, case when stops then 3 * source_size::hugeint else words * levels.weight end as share,
    case when stops then 1 else rest.weight end as parts from levels cross join rest),
rates as (
  select source, source_size, share::double / parts::double as target,
    case when source_size = 0 then 0 else share // (parts * source_size) end as copies,
    case when source_size = 0 then 0 else (share % (parts * source_size))::double / (parts * source_size)::double
      end as chance from shares),
seeds as (select unnest(range(16)) as seed),
drawn as (
  select doc_id, docs.source, size, seed, source_size, target, copies,
    copies + (('0x' || substr(md5((seed // 4)::varchar || ':' || key), 1 + 8 * (seed % 4), 8))::bigint
              < chance * 4294967296.0)::int as own
  from docs join rates on docs.source is not distinct from rates.source cross join seeds),
chosen as (
  select source, seed from drawn group by source, seed
  qualify row_number() over (partition by source order by
    abs(any_value(copies) * any_value(source_size) + sum((own - copies) * size) - any_value(target)), seed) = 1)
select doc_id, size, source_size, target, (size * own)::bigint as taken
from drawn join chosen on drawn.source is not distinct from chosen.source and drawn.seed = chosen.seed"""

ORACLES = {"op3_minhash_near_duplicates": NEAR_DUPLICATES, "op4_quality_rules": QUALITY,
           "op9_substring_dedup": SUBSTRINGS,
           "op12_source_divergence": DIVERGENCE, "op13_source_mixing": MIXING}
