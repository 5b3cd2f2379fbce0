"""The SQL of each catalogued query, for an independent engine.

Written from the definitions, not from the Spark expressions: lines are split and
joined, first records come from windows, forward neighbours from forward frames.
"""

from html.entities import html5

from ..operators import boilerplate as B, langid as L, sampling as S
from ..schema import (HTML_LIKE_TYPES, INLINE_ELEMENTS, LETTER, PLAIN_TYPES, SPACE,
                      UNSUPPORTED_MAIN_TYPES, UNSUPPORTED_TYPES, WORD)
from .catalog import SAMPLE_RATIO, STOP_WORDS, SUBSTRINGS
from .tables import LATIN, WRITTEN

LANGUAGES = ["de", "en", "es", "fr"]


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_s(v) for v in values) + ")"


def _replace(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {_s(pattern)}, {by}, 'g')"


# --- records -----------------------------------------------------------------------------

def _urn(number: str) -> str:
    m = f"md5('p:' || {number})"
    parts = " || '-' || ".join(f"substr({m}, {a}, {n})"
                               for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('<urn:uuid:' || {parts} || '>')"


REC = f"""rec as (
  select page_id as seq, page_id % 16 as file_seq,
    'crawl-data/C/segments/' || (page_id % 4) || '/warc/f' || (page_id % 16) || '.warc.gz' as file,
    case when page_id % 10 = 0 then 'request' when page_id % 10 = 1 then 'conversion'
         else 'response' end as rec_type,
    {_urn('page_id')} as record_id,
    case when page_id % 10 = 1 then {_urn('(page_id - 1)')} end as refers_to,
    url as target_uri,
    '2021-01-15T00:00:' || lpad(cast(page_id % 60 as varchar), 2, '0') || 'Z' as record_date,
    case page_id % 14 when 0 then 'text/plain' when 1 then 'application/pdf'
      when 2 then 'application/xhtml+xml' when 3 then 'text/html; charset=utf-8'
      when 4 then null when 5 then 'image/png' when 6 then 'text/css'
      when 7 then 'application/xml-dtd' when 8 then 'text/plain; charset=utf-8'
      when 9 then 'application/json; charset=utf-8' else 'text/html' end as payload_type,
    case when page_id % 10 = 1 then 'text/plain'
         else 'application/http; msgtype=response' end as content_type,
    coalesce(payload_type, content_type) as mime,
    case when page_id % 17 = 0 then '' when page_id % 13 = 0 then html || chr(1)
         else html end as content
  from pages)"""

_PLAIN = f"mime in {_list(PLAIN_TYPES)}"
_HTML = "(" + " or ".join(f"starts_with(mime, {_s(t)})" for t in HTML_LIKE_TYPES) + ")"
_UNSUPPORTED = f"""(case when mime in {_list(PLAIN_TYPES + HTML_LIKE_TYPES)} then false
  when mime in {_list(UNSUPPORTED_TYPES)} then true
  when {' or '.join(f"starts_with(mime, {_s(t + ';')})" for t in PLAIN_TYPES + HTML_LIKE_TYPES)} then false
  else {' or '.join(f"starts_with(mime, {_s(t + '/')})" for t in UNSUPPORTED_MAIN_TYPES)} end)"""


# --- text --------------------------------------------------------------------------------

def _normal_space(text: str) -> str:
    line = f"trim({_replace('l', f'[{SPACE}]+', chr(39) + ' ' + chr(39))})"
    return (f"array_to_string(list_filter(list_transform(string_split({text}, chr(10)), "
            f"lambda l: {line}), lambda l: l <> ''), chr(10))")


def _letters(text: str) -> str:
    return f"array_to_string(regexp_extract_all({text}, '[{LETTER}]+'), ' ')"


_REFERENCE = "&(?:[a-zA-Z][-.a-zA-Z0-9]*|#[0-9]+|#[xX][0-9a-fA-F]+);?"
_NAMES = "map {" + ", ".join(f"{_s(k[:-1])}: {_s(v)}" for k, v in sorted(html5.items())
                             if k.endswith(";")) + "}"


def _unescaped(text: str) -> str:
    """Named references; the tables hold no numeric ones."""
    name = "regexp_replace(p[2], '^&|;$', '', 'g')"
    return (f"(select array_to_string(list_transform(list_zip("
            f"regexp_split_to_array(u.t, {_s(_REFERENCE)}), "
            f"regexp_extract_all(u.t, {_s(_REFERENCE)})), lambda p: p[1] || case "
            f"when p[2] is null then '' else coalesce(names.m[{name}], '&' || {name}) end), '') "
            f"from (select {text} as t) u, (select {_NAMES} as m) names)")


def _without(text: str, *elements: str, by="''") -> str:
    for e in elements:
        text = _replace(text, rf"(?is)<{e}(?:\s[^>]*)?>.*?(?:</{e}\s*>|\z)", by)
    return text


_REST = r"""(?:(?:[^>"']|"[^"]*"|'[^']*')*>|[^>]*>)"""
_TAG = "</?[a-zA-Z]" + _REST
_REMARK = r"(?s)<!--.*?(?:-->|\z)|<![a-zA-Z\[][^>]*>|<\?[^>]*>"
_INLINE = rf"(?i)</?(?:{'|'.join(INLINE_ELEMENTS)})(?:/?>|[\s/]{_REST})"


def _tags(html: str) -> str:
    bare = _replace(_replace(_without(html, "script", "style", by="chr(10)"), _REMARK, "chr(10)"),
                    _TAG, "chr(10)")
    return _normal_space(_unescaped(bare))


def _blocks(html: str) -> str:
    kept = _replace(_without(html, "script", "style", "noscript"), _REMARK, "chr(10)")
    return _normal_space(_unescaped(_replace(_replace(kept, _INLINE, "''"), _TAG, "chr(10)")))


_CLEAN = _without("html", "script", "style")


def _gate(*tests: str) -> str:
    return "case " + " ".join(tests) + " end"


_BY_TYPE = "when rec_type not in ('response', 'conversion') then 'other'"
_RESPONSE = "when rec_type <> 'response' then 'other'"
_EMPTY = "when content = '' then 'empty'"
_REJECT = f"when {_UNSUPPORTED} then 'unsupported'"


def _draw(key: str, seed) -> str:
    return f"cast('0x' || substr(md5({seed} || ':' || {key}), 1, 8) as bigint) / 4294967296.0"


_SAMPLED = f"{_draw('record_id', S.FIRST_SEED)} <= {SAMPLE_RATIO}"


def _outcomes(gate: str, html_text: str, normalize=False, source="rec") -> str:
    text = f"case when {_PLAIN} then content else {html_text} end"
    if normalize:
        text = _letters(f"({text})")
    return f"""gated as materialized (select *, {gate} as gate from {source}),
  texts as materialized (select *, case when gate is null then {text} end as text from gated),
  outcomes as (select *, coalesce(gate, case when text = '' then 'empty' else 'ok' end) as outcome
               from texts)"""


_CONVERT = _outcomes(_gate(_BY_TYPE, _EMPTY, _REJECT), _blocks("content"))
_RESPONSES = _outcomes(_gate(_RESPONSE, _EMPTY, _REJECT), _blocks("content"))
_HASHED = _outcomes(_gate(_BY_TYPE, _EMPTY, _REJECT), _tags("content"), normalize=True)
_CONVERT_SAMPLED = _outcomes(_gate(f"when not ({_SAMPLED}) then 'skipped'", _BY_TYPE, _EMPTY,
                                   _REJECT), _blocks("content"))
_PICK = "cast('0x' || substr(md5(record_id), 1, 8) as bigint) % 2"
_CONVERT_RANDOM = _outcomes(
    _gate(_BY_TYPE, _EMPTY, _REJECT),
    f"case when {_PICK} = 0 then {_blocks('content')} else {_tags('content')} end")
_CONTAINS = "(" + " or ".join(f"contains(record_id, {_s(x)})" for x in SUBSTRINGS) + ")"
_EXTRACT = _outcomes(_gate(_RESPONSE, f"when not {_CONTAINS} then 'skipped'", _EMPTY, _REJECT,
                           f"when not {_HTML} then 'unsupported'"), _blocks("content"))

_COUNTERS = """count(*) as total, cast(count_if(outcome = 'skipped') as bigint) as skipped,
  cast(count_if(outcome <> 'skipped' and rec_type = 'response') as bigint) as responses,
  cast(count_if(outcome <> 'skipped' and rec_type = 'conversion') as bigint) as conversions,
  cast(count_if(outcome = 'empty') as bigint) as empties, cast(count_if(outcome = 'unsupported') as bigint) as unsupported,
  cast(count_if(outcome = 'error') as bigint) as errors, cast(count_if(outcome = 'ok') as bigint) as output"""
_NAMED = "seq as rec_seq, rec_type, record_id, md5(content) as content_md5"
_GOOD_IDS = f"(select {_urn('doc_id')} from labels where quality = 1)"
_CONVERSATION_IDS = f"select {_urn('conv_id')} as id from conversations"
_BARE = "substr(record_id, 2, length(record_id) - 2)"
_UUID = "substr(record_id, 11, length(record_id) - 11)"

# --- paths -------------------------------------------------------------------------------

_ARCHIVES = """archives as (select 'crawl-data/C/segments/' || (page_id % 100) || '/warc/f'
  || page_id || '.warc.gz' as path,
  'sampled/' || (page_id % 100) || '/f' || page_id || '.warc.gz' as out_path from pages),
  existing as (select 'sampled/' || (doc_id % 100) || '/f' || doc_id || '.warc.gz' as out_path
  from labels where toxic = 1),
  todo as (select * from archives where out_path not in (select out_path from existing))"""


def _common(column: str, source: str) -> str:
    return f"""ends as (select min({column}) as a, max({column}) as b from {source}),
  agreed as (select coalesce((select max(i) from ends, range(1, length(a) + 1) t(i)
             where substr(a, 1, i) = substr(b, 1, i)), 0) as n),
  shared as (select coalesce(substr(a, 1, n), '') as prefix from ends, agreed)"""


# --- language ----------------------------------------------------------------------------

def _lines(keys: str, source: str) -> str:
    strip = _replace("u.line", rf"^[{SPACE}]+|[{SPACE}]+\z", "''")
    return f"""select {keys}, u.n - 1 as pos, {strip} as line
    from {source}, unnest(string_split(text, chr(10))) with ordinality as u(line, n)"""


_WORDS = (f"len(list_filter(regexp_extract_all(line, '[{WORD}]+'), "
          f"lambda w: regexp_full_match(w, '[{LETTER}]{{2,}}')))")
_TOKENS = f"regexp_extract_all(lower(line), '[{LETTER}]+')"
_GRAMS = ("list_transform(range(1, length(word) + 1), "
          "lambda i: substr(' ' || word || ' ', i, 3))")


def _gram_rows(keys: str, lines: str) -> str:
    return f"""select {keys}, unnest({_GRAMS}) as gram
    from (select {keys}, unnest({_TOKENS}) as word from {lines})"""


_MODEL = f"""train_lines as ({_lines('doc_id, lang', 'documents')}),
  train_grams as ({_gram_rows('lang', "(select * from train_lines where line <> '')")}),
  counts as (select gram, {', '.join(f"count_if(lang = '{l}') as {l}" for l in LANGUAGES)}
             from train_grams group by gram),
  totals as (select count(*) as size, {', '.join(f"sum({l}) as {l}" for l in LANGUAGES)}
             from counts),
  model as materialized (select gram, {', '.join(
      f"cast(round(ln((c.{l} + 1) / (t.{l} + t.size)) * {L.SCALE}) as bigint) as {l}"
      for l in LANGUAGES)} from counts c, totals t)"""


def _scored(keys: str, source: str) -> str:
    """Lines of a relation with words and scores."""
    sums = ", ".join(f"cast(sum(m.{l}) as bigint) as {l}" for l in LANGUAGES)
    return f"""lines as materialized (select *, {_WORDS} as words from ({_lines(keys, source)})
    where line <> ''),
  scores as (select {keys}, pos, {sums} from ({_gram_rows(keys + ', pos',
      '(select * from lines where words >= 1)')}) g join model m using (gram)
    group by {keys}, pos)"""


def _posterior(target: str) -> str:
    odds = " + ".join(f"exp(({l} - {target}) / {float(L.SCALE)})" for l in LANGUAGES)
    return f"coalesce(1.0 / ({odds}), 0)"


def _kept(keys: str, target: str) -> str:
    return f"""sums as (select {keys},
    cast(sum(case when words >= 1 and {_posterior(target)} >= {L.THRESHOLD} then words
             else 0 end) as bigint) as target_words,
    cast(sum(words) as bigint) as total_words
    from lines left join scores using ({keys}, pos) group by {keys})
  select {keys}, target_words, total_words, case when total_words = 0 then false
    when target_words / total_words < {L.MIN_RATIO} then false
    when target_words >= {L.KEEP_WORDS} then true
    else target_words / total_words >= {L.KEEP_RATIO} end as keep from sums"""


# --- main text ---------------------------------------------------------------------------

_STOPS = f"""stops as (select lang, word from (
    select lang, word, row_number() over (partition by lang order by count(*) desc, word) as r
    from (select lang, unnest(regexp_extract_all(lower(text), '[{LETTER}]+')) as word
          from documents) group by lang, word) where r <= {STOP_WORDS})"""


#: A link's start up to its first ``href``, skipping over quoted values.
_ADDRESSED = (r"""(?i)<a(?:[^>"']|"[^"]*"|'[^']*')*?[\s/]href\s*=\s*"""
              r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>]*))""" + _REST)


def _named(names: str) -> str:
    return rf"(?i)<(?:{names})(?:/?>|[\s/]{_REST})"


def _marked(html: str) -> str:
    text = _replace(_replace(html, r"[\x0e-\x12]", "' '"),
                    "(?i)&#(?:0*1[4-8];|x0*(?:e|f|1[0-2]);)", "' '")
    text = _without(text, "script", "style", "noscript")
    for pattern, by in (
            (_REMARK, "chr(10)"),
            (_ADDRESSED, r"chr(15) || '\1\2\3' || chr(18)"),
            (_named("a"), "chr(15) || chr(18)"), (r"(?i)</a\s*>", "chr(14)"),
            (_named("h[1-6]"), "chr(10) || chr(16)"),
            (_named("select|option"), "chr(10) || chr(17)"),
            (_INLINE, "''"), (_TAG, "chr(10)")):
        text = _replace(text, pattern, by)
    return _normal_space(_unescaped(text))


def _unmarked(line: str) -> str:
    return f"trim({_replace(_replace(line, B.MARKS, chr(39) * 2), ' +', chr(39) + ' ' + chr(39))})"


_PARAGRAPHS = f"""marked as materialized (select page_id, {_marked('html')} as page from pages),
  pieces as (select page_id, u.n - 1 as pos, u.line from marked,
    unnest(string_split(page, chr(10))) with ordinality as u(line, n)),
  paragraphs as materialized (select page_id, pos,
    case when contains(line, chr(17)) then 'select' when contains(line, chr(16)) then 'head'
         else 'p' end as tag, {_unmarked('line')} as text, length(text) as n_chars,
    length({_unmarked(f"array_to_string(regexp_extract_all(line, {_s(B.LINKED)}, 1), '')")}) as link_chars,
    regexp_extract_all(line, {_s(B.ADDRESS)}, 1) as hrefs
    from pieces where {_unmarked('line')} <> '')"""


def _near(cls: str, kinds: str, ahead: bool) -> str:
    pick, frame = (("first", "1 following and unbounded following") if ahead
                   else ("last", "unbounded preceding and 1 preceding"))
    return (f"coalesce({pick}_value(case when {cls} in {kinds} then {cls} end ignore nulls) over "
            f"(partition by page_id order by pos rows between {frame}), 'bad')")


def _gap(cls: str) -> str:
    return (f"first_value(case when {cls} = 'good' then ends_at - n_chars end ignore nulls) over "
            "(partition by page_id order by pos rows between 1 following and unbounded following)"
            f" - ends_at <= {B.MAX_HEADING_DISTANCE}")


_SETTLED, _ANY = "('good', 'bad')", "('good', 'bad', 'neargood')"
_CLASSES = f"""{_STOPS}, {_PARAGRAPHS},
  features as (select *, len(string_split(lower(text), ' ')) as n_words,
    len(list_filter(string_split(lower(text), ' '),
        lambda w: list_contains(stoplist, w))) as n_stops
    from paragraphs, (select list(word) as stoplist from stops)),
  c0 as (select *, sum(n_chars) over (partition by page_id order by pos) as ends_at,
    case when link_chars / n_chars > {B.MAX_LINK_DENSITY} then 'bad'
      when contains(text, '©') or contains(text, '&copy') or tag = 'select' then 'bad'
      when n_chars < {B.LENGTH_LOW} then if(link_chars > 0, 'bad', 'short')
      when n_stops / n_words >= {B.STOPWORDS_HIGH} then if(n_chars > {B.LENGTH_HIGH}, 'good', 'neargood')
      when n_stops / n_words >= {B.STOPWORDS_LOW} then 'neargood' else 'bad' end as cf_class
    from features),
  c1 as (select *, case when tag = 'head' and cf_class = 'short' and {_gap('cf_class')}
    then 'neargood' else cf_class end as k1 from c0),
  n1 as (select *, {_near('k1', _SETTLED, False)} as p, {_near('k1', _SETTLED, True)} as n,
    {_near('k1', _ANY, False)} as pa, {_near('k1', _ANY, True)} as na from c1),
  c2 as (select * exclude (p, n, pa, na), case when k1 <> 'short' then k1 when p = n then p
    when (p = 'bad' and pa = 'neargood') or (n = 'bad' and na = 'neargood') then 'good'
    else 'bad' end as k2 from n1),
  n2 as (select *, {_near('k2', _SETTLED, False)} as p, {_near('k2', _SETTLED, True)} as n from c2),
  c3 as (select *, case when k2 <> 'neargood' then k2 when p = 'bad' and n = 'bad' then 'bad'
    else 'good' end as k3 from n2),
  classes as (select *, case when tag = 'head' and k3 = 'bad' and cf_class <> 'bad'
    and {_gap('k3')} then 'good' else k3 end as class from c3)"""

_MAIN = """select page_id, coalesce(string_agg(case when class = 'good' then text end,
                          chr(10) || chr(10) order by pos), '') as text from classes group by page_id"""
# the same over the payloads of records
_RECORD_CLASSES = _CLASSES.replace("from pages)", "from (select seq as page_id, content as html from rec))")

_FIRST = """first_value(doc_id) over (partition by text order by doc_id) as first_id"""

_ASCII = _replace("text", r"[^\x01-\x7f]", "''")

ORACLES = {
    "record_headers": f"""with {REC} select record_id, {_BARE} as bare_id, {_UUID} as uuid,
      refers_to, refers_to as chosen_id, {_UUID} as normal_id, target_uri, payload_type, mime,
      record_date, cast(strlen(content) as bigint) as source_length from rec""",
    "mime_profile": f"""with {REC} select mime, {_PLAIN} as plain, {_HTML} as html_like,
      {_UNSUPPORTED} as unsupported, count(*) as n from rec group by all""",
    "record_outcomes": f"""with {REC}, {_CONVERT}
      select rec_type, outcome, count(*) as n from outcomes group by all""",
    "outcomes_by_file": f"""with {REC}, {_CONVERT_SAMPLED}
      select file, {_COUNTERS} from outcomes group by file""",
    "hash_outcomes": f"with {REC}, {_HASHED} select {_COUNTERS} from outcomes",
    "extract_outcomes": f"""with {REC}, {_EXTRACT}
      select rec_type, outcome, count(*) as n from outcomes group by all""",
    "filter_by_ids": f"with {REC} select {_NAMED} from rec where record_id in {_GOOD_IDS}",
    "filter_by_refers_to": f"with {REC} select {_NAMED} from rec where refers_to in {_GOOD_IDS}",
    "filter_by_id_substring": f"""with {REC} select {_NAMED} from rec
      where rec_type = 'response' and {_CONTAINS}""",
    "id_list_duplicates": f"""select id, count(*) as n from ({_CONVERSATION_IDS})
      group by id having count(*) > 1""",
    "distinct_ids": f"select distinct id from ({_CONVERSATION_IDS})",
    "sample_records": f"with {REC} select {_NAMED} from rec where {_SAMPLED}",
    "sample_responses": f"""with {REC} select {_NAMED} from rec where rec_type = 'response'
      and not {_UNSUPPORTED}
      and {_draw('record_id', f'({S.FIRST_SEED} + {S.SEED_STEP} * file_seq)')} <= {SAMPLE_RATIO}""",
    "extractor_assignment": f"""with {REC} select seq as rec_seq,
      case when {_PICK} = 0 then 'blocks' else 'tags' end as extractor from rec""",
    "crawl_manifest": f"""with {_ARCHIVES} select path, out_path,
      {S.FIRST_SEED} + {S.SEED_STEP} * (row_number() over (order by path) - 1) as seed
      from todo""",
    "pending_outputs": f"with {_ARCHIVES} select path, out_path from todo",
    "output_dirs": "select distinct (page_id % 100) || '/warc' as rel_dir from pages",
    "output_names": f"""with {_ARCHIVES} select path,
      list_last(string_split(path, '/')) as base,
      array_to_string(list_slice(string_split(path, '/'), 1, -2), '/') as dir,
      replace(path, '.warc.gz', '.tsv') as tsv from archives""",
    "common_prefix": f"with {_common('url', 'pages')} select prefix from shared",
    "common_prefix_dir": f"""with {_ARCHIVES}, {_common('path', 'archives')}
      select regexp_extract(prefix, '^(.*)/[^/]*$', 1) as prefix from shared""",
    "normalize_space": f"select doc_id, {_normal_space('text')} as text from documents",
    "normalize_alpha": f"select doc_id, {_letters('text')} as text from documents",
    "text_digest": f"""select doc_id, to_base64(unhex(md5(text))) as digest,
      to_base64(unhex(md5({_letters('text')}))) as norm_digest,
      upper(md5(text)) as hex_digest from documents""",
    "html_text_tags": f"select page_id, {_tags('html')} as text from pages",
    "html_text_blocks": f"select page_id, {_blocks('html')} as text from pages",
    "html_text_parser": f"select page_id, {_blocks('html')} as text from pages",
    "clean_html": f"select page_id, {_CLEAN} as text from pages",
    "convert_documents": f"""with {REC}, {_CONVERT} select 'commoncrawl:' || {_BARE} as id, text,
      target_uri as uri, mime as source_type, record_date as download_date,
      cast(strlen(content) as bigint) as source_length from outcomes where outcome = 'ok'""",
    "convert_random_extractor": f"""with {REC}, {_CONVERT_RANDOM}
      select 'commoncrawl:' || {_BARE} as id, md5(text) as text_md5
      from outcomes where outcome = 'ok'""",
    "extract_documents": f"""with {REC}, {_RESPONSES} select record_id as id, target_uri, text
      from outcomes where outcome = 'ok'""",
    "declared_charsets": f"""with moved as (select doc_id, case {' '.join(
        f"when doc_id % {len(WRITTEN)} = {i} then translate({_ASCII}, {_s(LATIN)}, {_s(letters)})"
        for i, (letters, _, _) in enumerate(WRITTEN))} end as page from documents),
      texts as (select doc_id, {_normal_space('page')} as text from moved)
      select doc_id, case when text = '' then 'empty' else 'ok' end as outcome, md5(text) as text_md5 from texts""",
    "hash_records": f"""with {REC}, {_HASHED} select {_UUID} as id,
      to_base64(unhex(md5(text))) as digest from outcomes where outcome = 'ok'""",
    "duplicates": f"""select doc_id as id, first_id from (select doc_id, {_FIRST} from documents)
      where doc_id <> first_id""",
    "drop_duplicates": f"""select doc_id as id, upper(md5(text)) as digest
      from (select *, {_FIRST} from documents) where doc_id = first_id""",
    "duplicates_indexed": """with ranked as (select doc_id, source, first_value(doc_id) over (
        partition by text order by source is distinct from (select min(source) from documents), doc_id)
        as first_id from documents)
      select doc_id as id, first_id from ranked
      where source is distinct from (select min(source) from documents) and doc_id <> first_id""",
    "duplicates_stream": f"""select doc_id as id, first_id from (select doc_id, {_FIRST}
      from documents) where doc_id <> first_id""",
    "distinct_pages": f"""with {REC}, {_CONVERT},
      d as (select *, md5({_letters('text')}) as digest from outcomes where outcome = 'ok')
      select arg_min({_BARE}, (file_seq, seq)) as id, to_base64(unhex(digest)) as digest,
      count(*) as n_copies, min(length(text)) as n_chars from d group by digest""",
    "line_words": f"""select doc_id, pos, {_WORDS} as words
      from ({_lines('doc_id', 'documents')}) where line <> ''""",
    "line_words_custom": f"""select doc_id, pos, len(regexp_extract_all(line, '[a-z]+')) as words
      from ({_lines('doc_id', 'documents')}) where line <> ''""",
    "lang_model": f"with {_MODEL} select * from model",
    "lang_model_words": f"""with {_MODEL}, vocabulary as (
        select distinct unnest({_TOKENS}) as word from train_lines),
      cut as (select word, unnest({_GRAMS}) as gram from vocabulary)
      select word, {', '.join(f"cast(sum({l}) as bigint) as {l}" for l in LANGUAGES)}
      from cut join model using (gram) group by word""",
    "lang_line_scores": f"""with {_MODEL}, {_scored('doc_id', 'documents')},
      long as ({' union all '.join(f"select doc_id, pos, '{l}' as lang, {l} as score from scores" for l in LANGUAGES)}),
      ranks as (select *, row_number() over (partition by doc_id, pos order by score desc, lang)
                as rank from long)
      select doc_id, pos, rank, lang, score from ranks where rank <= 2""",
    "lang_keep": f"""with {_MODEL}, {REC}, {_CONVERT},
      found as (select {_BARE} as id, text from outcomes where outcome = 'ok'),
      {_scored('id', 'found')}, {_kept('id', 'fr')}""",
    "lang_keep_documents": f"""with {_MODEL}, {_scored('doc_id', 'documents')},
      {_kept('doc_id', 'de')}""",
    "lang_sample": f"""with {_MODEL}, {REC}, drawn as (select * from rec where {_SAMPLED}),
      {_outcomes(_gate(_RESPONSE, _EMPTY, _REJECT), _blocks('content'), source='drawn')},
      found as (select seq, record_id, text from outcomes where outcome = 'ok'),
      rows_ as ({_gram_rows('seq, record_id', f"({_lines('seq, record_id', 'found')})")}),
      scores as (select seq, record_id, {', '.join(f"sum(m.{l}) as {l}" for l in LANGUAGES)}
        from rows_ join model m using (gram) group by seq, record_id)
      select seq as rec_seq, record_id from scores where {_posterior('fr')} >= {L.DOCUMENT_PROB}""",
    "stop_words": f"with {_STOPS} select lang, word from stops",
    "boilerplate_paragraphs": f"""with {_CLASSES} select page_id, pos, tag, text, n_chars,
      link_chars, n_words, n_stops, cf_class, class from classes""",
    "main_text": f"with {_CLASSES} {_MAIN}",
    "main_text_outcomes": f"""with {REC}, {_RECORD_CLASSES}, main as ({_MAIN}),
      read as (select rec.*, coalesce(main.text, '') as main_text from rec left join main on page_id = seq),
      {_outcomes(_gate(_BY_TYPE, _EMPTY, _REJECT), 'main_text', source='read')}
      select rec_type, outcome, count(*) as n from outcomes group by all""",
    "page_links": f"with {_PARAGRAPHS} select page_id, pos, unnest(hrefs) as href from paragraphs",
    "archive_round_trip": f"""with {REC} select record_id, rec_type, mime, target_uri,
      md5(content) as content_md5 from rec""",
    "filter_by_member_index": f"""with {REC} select record_id, rec_type, md5(content) as content_md5
      from rec where record_id in {_GOOD_IDS}""",
    "archive_members": f"with {REC} select record_id, rec_type, refers_to, true as has_place from rec",
    "archive_check": f"with {REC} select 'OK' as status, count(*) as n_records from rec",
}
