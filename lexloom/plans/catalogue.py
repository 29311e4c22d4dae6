"""Query catalogue: names to callables, and SQL equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import native
from lexloom.functions import patterns as P
from lexloom.functions import wiki_patterns as W
from lexloom.operators import about, aliases, articles, cleaning, coverage, dedupe, forms, graph, layers, leaks, normalize, quality, semantic
from lexloom.runtime import Workspace, spread
from lexloom.sources import packs, rejects, wiki
from lexloom.sources.tables import table

# --- SQL fragments ----------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_fold(x: str, dashes: str) -> str:
    return f"translate({x}, {_q(dashes + native.KEY_BLANKS)}, {_q('-' * len(dashes) + ' ' * len(native.KEY_BLANKS))})"


def _sql_collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {_q(native.WS)}, ' ', 'g'), ' ')"


def _sql_casefold(x: str) -> str:
    return f"replace(lower({x}), 'ß', 'ss')"


def _sql_lookup(x: str) -> str:
    return f"translate({_sql_casefold(_sql_collapse(_sql_fold(f'nfc_normalize({x})', native.LOOKUP_DASHES)))}, 'ё', 'е')"


def _sql_key(x: str) -> str:
    return _sql_collapse(_sql_fold(f"nfc_normalize({x})", native.KEY_DASHES))


def _sql_valid(k: str) -> str:
    return (
        f"coalesce(length({k}) > 0 and length({k}) <= {native.MAX_KEY} and not regexp_matches({k}, {_q(chr(92) + 'x00|[' + chr(92) + 'r' + chr(92) + 'n]')})"
        f" and not starts_with({k}, '-') and not ends_with({k}, '-') and regexp_matches({k}, {_q(native.KEY_LETTER)}), false)"
    )


def _sql_script(t: str) -> str:
    c, la, g = (f"regexp_matches({t}, {_q(p)})" for p in (native.CYRILLIC, native.LATIN, native.GREEK))
    return (
        f"case when {c}::int + {la}::int + {g}::int > 1 then 'mixed' when {c} then 'cyrillic' when {la} then 'latin'"
        f" when {g} then 'greek' when regexp_matches({t}, '\\p{{L}}') then 'other-alphabet' else 'numeric' end"
    )


_T = f"""
tok as (
  select doc_id as doc, unnest(w) as token, generate_subscripts(w, 1) - 1 as pos
  from (select doc_id, regexp_extract_all(text, {_q(native.TOKEN)}) as w from documents where text is not null)
), tn as (select doc, pos, token, {_sql_lookup('token')} as normalized from tok)
"""
_K = f"""
rawkeys as (select key as k from links where key is not null union select word from pack_entries where word is not null),
keys as (select distinct {_sql_lookup('k')} as known from rawkeys where {_sql_lookup('k')} <> '')
"""
_C = f"""
with {_T}, {_K},
cnt as (select doc, normalized, count(*) as n from tn where regexp_matches(token, '\\p{{L}}') group by all),
gram as (
  select a.doc, a.normalized || ' ' || b.normalized as g from tn a join tn b on a.doc = b.doc and b.pos = a.pos + 1
  union all
  select a.doc, a.normalized || ' ' || b.normalized || ' ' || c.normalized from tn a
    join tn b on a.doc = b.doc and b.pos = a.pos + 1 join tn c on a.doc = c.doc and c.pos = a.pos + 2
  union all
  select a.doc, a.normalized || ' ' || b.normalized || ' ' || c.normalized || ' ' || d.normalized from tn a
    join tn b on a.doc = b.doc and b.pos = a.pos + 1 join tn c on a.doc = c.doc and c.pos = a.pos + 2
    join tn d on a.doc = d.doc and d.pos = a.pos + 3
),
part as (select doc, unnest(string_split(g, ' ')) as normalized from gram where g in (select known from keys where contains(known, ' '))),
cov as (select doc, normalized, count(*) as covered from part group by all),
counts as (
  select cnt.doc, cnt.normalized, n, (cnt.normalized in (select known from keys where not contains(known, ' '))) as single_known,
         coalesce(covered, 0) as covered
  from cnt left join cov on cnt.doc = cov.doc and cnt.normalized = cov.normalized
),
corpus as (
  select normalized, sum(n) as n, bool_or(single_known) as single_known, sum(covered) as covered from counts group by 1
),
unk as (
  select normalized, cast(case when single_known then 0 else greatest(n - covered, 0) end as bigint) as count from corpus
)
"""
_V = """
, surf as (
  select normalized, token, count(*) as n, min((doc, pos)) as first from tn where regexp_matches(token, '\\p{L}') group by 1, 2
), ranked as (select normalized, token, n, row_number() over (partition by normalized order by n desc, first) as rank from surf)
"""
_E = "edges as (select distinct key, lemma from links where key <> '' and lemma <> '')"
_D = "defined as (select distinct lemma from senses where lemma is not null and definition is not null)"


def _sql_like(x: str, p: str) -> str:
    return f"regexp_matches({x}, {_q('(?i)' + p)})"


def _sql_m(x: str, p: str) -> str:
    return f"regexp_matches({x}, {_q(p)})"


def _sql_count(x: str, c: str) -> str:
    return f"(length({x}) - length(replace({x}, {_q(c)}, '')))"


def _sql_word_end(words: str) -> str:
    return f"(?:^|[^\\p{{L}}\\p{{N}}_])(?:{words})"


def _sql_trim(x: str, chars: str = "") -> str:
    """Blanks (or the given characters) off both ends."""
    c = f"[{chars}]+" if chars else native.WS
    return f"regexp_replace({x}, {_q(f'^{c}|{c}$')}, '', 'g')"


def _sql_compact(x: str) -> str:
    t = _sql_trim(f"coalesce({x}, '')")
    return f"case when regexp_matches({t}, {_q('  |[' + chr(92) + 'n' + chr(92) + 'r' + chr(92) + 't]')}) then {_sql_collapse(t)} else {t} end"


def _sql_head(x: str) -> str:
    return _sql_trim(_sql_casefold(_sql_collapse(_sql_fold(f"coalesce({x}, '')", native.KEY_DASHES))), " .,:;—–-")


def _sql_plain_key(x: str) -> str:
    return _sql_collapse(_sql_fold(x, native.KEY_DASHES))


def _sql_years(x: str) -> str:
    """Years of prose: those of models are taken out, and single separators doubled, as RE2 cannot look around."""
    no_models = f"regexp_replace({x}, '(?i)((?:модел[ьи]|индекса?|типа?|серии)\\s+[a-zа-яё0-9./+-]*)(?:1[5-9]\\d\\d|20\\d\\d)', '\\1 ', 'g')"
    apart = f"regexp_replace({no_models}, '([^A-Za-zА-Яа-яЁё0-9/_+-])', '\\1\\1', 'g')"
    return f"regexp_extract_all({apart}, '(?:^|[^A-Za-zА-Яа-яЁё0-9/_-])(1[5-9]\\d\\d|20\\d\\d)(?:[^A-Za-zА-Яа-яЁё0-9/_+-]|$)', 1)"


#: Alias formulas of ``base(seq, lemma, src, text)`` as ``formulas(seq, kind, candidates, tail, body)``.
_SQL_FORMULAS = f"""
fa as (
  select seq, text, regexp_matches(text, {_q('(?i)' + P.ALIAS_PREFIX)}) as full_, regexp_matches(text, {_q('(?i)' + P.ALIAS_BARE)}) as bare_ from base
), fb as (
  select seq, case when full_ then {_sql_casefold(_sql_collapse(f"regexp_extract(text, {_q('(?i)' + P.ALIAS_PREFIX)}, 1)"))} else 'вариант' end as kind,
    not full_ as bare,
    {_sql_trim(_sql_collapse(f"case when full_ then regexp_extract(text, {_q('(?i)' + P.ALIAS_PREFIX)}, 2) else regexp_extract(text, {_q('(?i)' + P.ALIAS_BARE)}, 1) end"), " .;:—–-")} as body0
  from fa where full_ or bare_
), fc as (
  select seq, kind, bare, {_sql_trim(f"regexp_replace(body0, {_q('(?i)' + P.ALIAS_POS)}, '')")} as body
  from fb where body0 <> '' and not (starts_with(kind, 'вариант формы') and len(string_split(body0, ' ')) > 4)
), fd as (
  select *, case when regexp_matches(kind, '^вариант (названия|именования|написания|имени)') then {_sql_trim(f"regexp_extract(body, {_q(P.ALIAS_NAMED)}, 1)")} else '' end as named,
    {_sql_trim("split_part(body, ';', 1)")} as ls, {_sql_trim("substring(body, instr(body, ';') + 1)")} as rs,
    {_sql_trim("split_part(body, ',', 1)")} as lc, {_sql_trim("substring(body, instr(body, ',') + 1)")} as rc,
    split_part(body, ' ', 1) as lw, {_sql_trim("substring(body, length(split_part(body, ' ', 1)) + 2)")} as rw
  from fc where body <> ''
), fe as (
  select *, case when named <> '' then 'named'
    when contains(body, ';') then case when ls <> '' and rs <> '' then 'semicolon'
      when starts_with(kind, 'то же') and regexp_matches(rw, {_q(P.ALIAS_CLASS.replace('(?iu)', '(?i)'))}) and not contains(lw, ';') and {_sql_valid(_sql_plain_key('lw'))} then 'word' else '' end
    when contains(body, ',') and regexp_matches(rc, {_q(P.ALIAS_CLASS.replace('(?iu)', '(?i)'))}) then 'comma'
    when starts_with(kind, 'то же') and regexp_matches(rw, {_q(P.ALIAS_CLASS.replace('(?iu)', '(?i)'))}) and {_sql_valid(_sql_plain_key('lw'))} then 'word'
    else '' end as way from fd
), ff as (
  select seq, kind, bare, body,
    case way when 'named' then named when 'semicolon' then ls when 'comma' then lc when 'word' then lw else body end as target,
    case way when 'semicolon' then rs when 'comma' then rc when 'word' then rw else '' end as tail
  from fe
), fg as (
  select seq, kind, tail, body, case when bare then [target]
    when starts_with(kind, 'см') and regexp_matches(target, {_q(P.ALIAS_LIST.replace('(?iu)', '(?i)'))}) then regexp_split_to_array(target, '(?i)\\s*,\\s*|\\s+или\\s+|\\s+и\\s+')
    when regexp_matches(kind, '^(к|гипокор|уменьш|димин|см)') then regexp_split_to_array(target, '(?i)\\s*,\\s*|\\s+или\\s+')
    when starts_with(kind, 'то же') then string_split(target, ',') else [target] end as words
  from ff
), fh as (
  select seq, kind, tail, body, list_filter(list_transform(words, lambda w: {_sql_plain_key(_sql_trim(_sql_trim('w'), " .;:—–-"))}), lambda k: {_sql_valid('k')}) as candidates from fg
), formulas as (select seq, kind, candidates, tail, body from fh where len(candidates) > 0 or tail <> '')
"""


def _sql_flags() -> str:
    t = "text"
    edge = f"""(({_sql_count(t, '"')} % 2 = 1 and ({_sql_m(t, chr(40) + '?:^|[' + chr(92) + 's.,;:!?)' + chr(92) + ']}])"$')} or {_sql_m(t, '^"(?:$|[' + chr(92) + 'p{L}' + chr(92) + 's])')}))"""
    for a, b in (("«", "»"), ("„", "“"), ("“", "”"), ("‘", "’")):
        edge += f" or ({_sql_count(t, a)} > {_sql_count(t, b)} and starts_with({t}, {_q(a)}))"
        edge += f" or ({_sql_count(t, b)} > {_sql_count(t, a)} and ends_with({t}, {_q(b)}))"
    edge += ")"
    linked = "regexp_replace(text, '\\[\\[(?:[^\\]|]+\\|)?([^\\]]+)\\]\\]', '\\1', 'g')"
    hints = " or ".join(f"contains(low, {_q(h)})" for h in P.GRAMMAR_HINTS)
    modern = lambda x: f"translate({x}, 'ѣі', 'еи')"
    left = _sql_head(f"regexp_extract(text, {_q('(?i)' + P.OLD_EQUIVALENCE.replace('^.{1,120}?', '^(.{1,120}?)'))}, 1)")
    flags = {
        "very_short": "n < 8 and not onomastic and not concise",
        "very_long": "n > 520",
        "grammar_residue": f"({hints}) and (" + " or ".join(_sql_like(linked, p) for p in P.FORM_OF) + f" or {_sql_like(t, P.GRAMMAR)})",
        "markup_residue": f"contains(text, '{{{{') or contains(text, '[[') or (contains(text, '<') and contains(text, '>') and {_sql_like(t, P.MARKUP)})",
        "leading_parenthetical": "group_end > 0 and trim(substring(text, 2, group_end - 2)) <> '' and regexp_matches(substring(text, group_end + 1), '[^ ,;:—–-]')",
        "vague": _sql_like(t, P.VAGUE),
        "early_self_reference": "selfref and not concise and not onomastic",
        "example_residue": _sql_m(t, P.EXAMPLE),
        "placeholder_definition": "n <= 80 and meta",
        "fragment": "n <= 100 and frag",
        "old_equivalence_placeholder": f"{_sql_m('src', P.OLD_SOURCES)} and {_sql_like(t, P.OLD_EQUIVALENCE)} and {left} <> '' and head <> '' and {modern(left)} = {modern('head')}",
        "url_residue": _sql_like(t, P.URL),
        "redirect_residue": "redirect",
        "about_fragment": "n <= 100 and about",
        "bad_residue": f"{_sql_m(t, P.RESIDUE)} or {edge}",
    }
    any_flag = " or ".join(f"({v})" for v in flags.values())
    return f"""
base as (
  select seq, lemma, source, coalesce(source, '') as src, {_sql_compact("definition")} as text from senses
), {_SQL_FORMULAS}, p1 as (
  select base.*, length(text) as n, {_sql_casefold('text')} as low, {_sql_head('lemma')} as head,
         translate(regexp_replace(text, '[{native.STRESS}]', '', 'g'), {_q(native.STRESSED)}, {_q(native.UNSTRESSED)}) as plain,
         regexp_replace({_sql_casefold('text')}, '^это ', '') as lowp, formulas.seq is not null as redirect,
         {_sql_trim("regexp_replace(text, '" + chr(92) + "s*" + chr(92) + "([^()]{1,40}" + chr(92) + ")" + chr(92) + "s*[.!]?$', '')")} as probe0,
         coalesce(case when text[1] in ('(', '[') then list_position(list_transform(generate_series(1, length(text)),
           lambda i: length(replace(text[:i], if(text[1] = '(', ')', ']'), '')) - length(replace(text[:i], text[1], ''))), 0) end, 0) as group_end
  from base left join formulas using (seq)
), p2 as (
  select *, (n <= 140 and ({' or '.join(_sql_like('plain', p) for p in P.ONOMASTIC)})) as onomastic, if(probe0 = '', text, probe0) as probe,
         {_sql_m('low', P.ABOUT)} as about, {_sql_like(t, P.EMPTY_META)} as meta, {_sql_like(t, P.FRAGMENT)} as frag,
         (length(head) >= 4 and starts_with(lowp, head) and
           (substring(lowp, length(head) + 1, 1) in ('', '—', '–', ':', '-') or regexp_matches(substring(lowp, length(head) + 1, 1), '[\\s\\p{{Z}}]'))) as selfref
  from p1
), p3 as (
  select *, (not onomastic and n between 4 and 45 and not about and not redirect and not meta and not frag
         and {_sql_m('probe', P.CONCISE)} and length(regexp_replace(probe, '[^\\p{{L}}]', '', 'g')) >= 3) as concise
  from p2
), flagged as (
  select seq, lemma, source, text, n, case when n = 0 then ['empty'] else list_filter([
    case when onomastic then 'onomastic_stub' end,
    {', '.join(f"case when {v} then '{k}' end" for k, v in flags.items())},
    case when concise and not onomastic and not ({any_flag}) then 'concise_gloss' end,
    case when starts_with(src, 'ruwiki') and len(list_filter({_sql_years('text')}, lambda y: not list_contains({_sql_years("coalesce(lemma, '')")}, y))) > 0
      and ({_sql_like(t, P.WIKI_HISTORY)} or (n > 220 and {_sql_m('low', _sql_word_end(P.WIKI_HISTORY_WORDS))})) then 'encyclopedic_date' end,
    case when starts_with(src, 'ruwiki') and ({_sql_like(t, P.WIKI_TAIL)} or abs({_sql_count(t, '(')} - {_sql_count(t, ')')}) >= 2) then 'broken_fragment' end
  ], lambda f: f is not null) end as flags
  from p3
), scored as (
  select *, cast(case when n = 0 then 0 else greatest(0, least(100,
    case when list_contains(flags, 'onomastic_stub') then case when n >= 9 then 64 else 56 end
         when list_contains(flags, 'concise_gloss') then 64
         when n < 16 then 42 when n < 35 then 60 when n between 45 and 260 then 80 when n > 520 then 52 when n > 360 then 64 else 72 end
    - coalesce(list_sum(list_transform(flags, lambda f: coalesce(map {{{', '.join(f"'{k}': {v}" for k, v in P.PENALTIES.items())}}}[f], 0))), 0)
    + case when regexp_matches(text, '[.!?]$') then 3 else 0 end
    + case when n >= 55 and regexp_matches(text, '[;,—]') then 2 else 0 end)) end as int) as score
  from flagged
)
"""


_Q = "with " + _sql_flags()

_ARTICLES = f"""
with d as (
  select lemma, seq, {_sql_collapse('definition')} as d from senses where lemma is not null and seq is not null
), f as (
  select lemma, seq, d, row_number() over (partition by lemma,
    regexp_replace({_sql_collapse(_sql_casefold('d'))}, '^[ .;,:—-]+|[ .;,:—-]+$', '', 'g') order by seq) as rn
  from d where d <> ''
), a as (
  select lemma, list(d order by seq) as t from f where rn = 1 group by lemma
), art as (
  select lemma, case when len(t) = 1 then t[1]
    else array_to_string(list_transform(t, lambda x, i: i || '. ' || x), chr(10)) end as article from a
)
"""
_RANK = (
    "case when starts_with(s, 'wiktionary') then 0 when starts_with(s, 'wikidata') then 1 when s = 'dal' then 2"
    " when starts_with(s, 'extra:') then 4 when starts_with(s, 'ruwiki') then 5 else 3 end"
)


def _starts(x: str) -> str:
    return " or ".join(f"starts_with({x}, {_q(s)})" for s in P.CANDIDATE_STARTS)


SQL = {
    "normalize_key": f"with k as (select distinct key from links where key is not null) select key, {_sql_key('key')} as normalized, {_sql_valid(_sql_key('key'))} as valid from k",
    "normalize_lookup": f"with k as (select distinct key from links where key is not null) select key, {_sql_lookup('key')} as normalized from k",
    "alias_expand": f"""with k as (select distinct {_sql_key('key')} as k from links where key is not null),
      a as (select k, k as x from k union select k, {_sql_casefold('k')} from k),
      b as (select k, x from a union select k, translate(x, 'ёЁ', 'еЕ') from a),
      c as (select k, x from b union select k, translate(regexp_replace(x, '[{native.STRESS}]', '', 'g'), {_q(native.STRESSED)}, {_q(native.UNSTRESSED)}) from b)
      select k as key, x as alias from c where {_sql_valid('x')} and {_sql_valid('k')}""",
    "tokenize_counts": f"with {_T} select normalized, count(*) as n from tn group by 1",
    "script_distribution": f"with {_T} select {_sql_script('token')} as script, count(*) as n, count(distinct normalized) as n_distinct from tn group by 1",
    "ngram_lookup_candidates": f"""with t as (
        select item_id, list_transform(regexp_extract_all(text, {_q(native.TOKEN)}), lambda x: {_sql_lookup('x')}) as w from eval_items
      ), g as (select item_id, unnest(list_concat(w, flatten(list_transform([2, 3, 4], lambda n: list_transform(
        range(1, greatest(len(w) - n + 2, 1)), lambda i: array_to_string(w[i:i + n - 1], ' ')))))) as gram from t)
      select gram, count(*) as n, count(distinct item_id) as items from g group by 1""",
    "coverage_by_file": _C + "select doc, cast(sum(n) as bigint) as tokens_total, count(*) as unique_tokens, cast(sum(case when single_known then 0 else greatest(n - covered, 0) end) as bigint) as unknown_tokens from counts group by 1",
    "coverage_report": _C + """, tot as (select cast(sum(n) as bigint) as tokens_total, count(*) as unique_tokens,
        cast(sum(case when single_known then 0 else greatest(n - covered, 0) end) as bigint) as unknown_tokens from corpus)
      select tokens_total, unique_tokens, tokens_total - unknown_tokens as known_tokens, unknown_tokens,
        round((tokens_total - unknown_tokens) / tokens_total * 100, 3) as coverage_percent from tot""",
    "oov_topk": _C + "select normalized, count from unk where count > 0 order by count desc, normalized limit 200",
    "oov_by_script": _C + f"select {_sql_script('normalized')} as script, cast(sum(count) as bigint) as tokens, count(*) as forms from unk where count > 0 group by 1",
    "token_variants_top5": f"with {_T} {_V} select normalized, rank, token, n from ranked where rank <= 5",
    "insert_or_ignore_senses": "select lemma, definition, source, seq from (select *, row_number() over (partition by lemma, definition order by seq) as rn from senses where lemma is not null and definition is not null) where rn = 1",
    "insert_or_replace_overrides": "select user_id, event_type, value, event_id from (select *, row_number() over (partition by user_id order by event_id desc) as rn from events) where rn = 1",
    "layered_fallback": f"""with r as (select lemma, definition, source, seq, coalesce(source, '') as s from senses where lemma is not null),
      k as (select *, {_RANK} as rank from r), m as (select *, min(rank) over (partition by lemma) as first from k)
      select lemma, seq, source from m where rank = first or rank = 4""",
    "group_senses_article": _ARTICLES + "select lemma, article from art",
    "prefix_offsets": _ARTICLES + "select lemma, strlen(article) as size, cast(sum(strlen(article)) over (order by lemma) - strlen(article) as bigint) as offset from art",
    "ambiguous_keys": f"with {_E} select key, count(*) as n_lemmas, string_agg(lemma, '|' order by lemma) as lemmas from edges group by 1 having count(*) > 1",
    "override_merge": f"""with {_E}, o as (select key, max(target) as definition from form_hints where kind = 'passive' and target is not null group by 1)
      select key, 'links' as kind, string_agg(lemma, '|' order by lemma) as body from edges where key not in (select key from o) group by 1
      union all select key, 'override', definition from o""",
    "link_closure": f"""with recursive {_E}, {_D}, walk(key, lemma) as (
        select key, lemma from edges union
        select w.key, e.lemma from walk w join edges e on e.key = w.lemma where w.lemma not in (select lemma from defined))
      select key, lemma from walk where lemma in (select lemma from defined)""",
    "closure_counts": f"""with recursive {_E}, {_D}, walk(key, lemma) as (
        select key, lemma from edges union
        select w.key, e.lemma from walk w join edges e on e.key = w.lemma where w.lemma not in (select lemma from defined))
      select (select count(*) from walk where lemma in (select lemma from defined)) - (select count(*) from edges where lemma in (select lemma from defined)) as propagated,
             (select count(*) from edges where lemma not in (select lemma from defined)) as removed""",
    "prune_dangling": f"with {_E}, {_D} select key, lemma from edges where lemma in (select lemma from defined)",
    "resolved_lookup": f"""with {_E}, per as (select lemma, count(*) as n from senses where lemma is not null and definition is not null group by 1)
      select key, cast(sum(n) as bigint) as n_definitions from edges join per using (lemma) group by 1""",
    "alias_formula": f"with base as (select seq, lemma, coalesce(source, '') as src, {_sql_compact('definition')} as text from senses), {_SQL_FORMULAS}"
    " select seq, kind, array_to_string(candidates, '|') as candidates, tail, body from formulas",
    "quality_totals": _Q + """select count(*) as definitions, round(avg(score), 2) as average,
        count(*) filter (len(list_filter(flags, lambda f: f not in ('onomastic_stub', 'concise_gloss'))) > 0) as with_warnings,
        count(*) filter (len(flags) > 0 and len(list_filter(flags, lambda f: f not in ('onomastic_stub', 'concise_gloss'))) = 0) as informational_only from scored""",
    "informational_examples": _Q + ", e as (select unnest(flags) as flag, lemma, seq, text from scored where lemma is not null), r as (select *, row_number() over (partition by flag order by lemma, seq) as place from e where flag in ('onomastic_stub', 'concise_gloss')) select flag, lemma, seq, text, place from r where place <= 2000",
    "quality_flags": _Q + "select seq, array_to_string(flags, ',') as flags from scored",
    "quality_score": _Q + "select seq, score from scored",
    "quality_buckets": _Q + "select case when score < 50 then '0-49' when score < 70 then '50-69' when score < 85 then '70-84' else '85-100' end as bucket, count(*) as n, round(avg(score), 2) as average from scored group by 1",
    "quality_warning_counts": _Q + ", e as (select unnest(flags) as flag from scored) select flag, count(*) as n from e group by 1",
    "quality_by_source": _Q + "select source, count(*) as n, round(avg(score), 2) as average from scored group by 1",
    "flag_examples": _Q + ", e as (select unnest(flags) as flag, lemma, seq, score from scored where lemma is not null), r as (select *, row_number() over (partition by flag order by lemma, seq) as place from e) select flag, lemma, seq, score, place from r where place <= 80",
    "quality_review_topk": _Q + "select score, lemma, seq, source from scored where len(list_filter(flags, lambda f: f not in ('onomastic_stub', 'concise_gloss'))) > 0 order by score, lemma nulls first, seq limit 5000",
    "semantic_candidates": f"""select seq from senses where definition is not null and lemma is not null and (
        source = 'dal' or starts_with(source, 'ruwiki') or source in ('wiktionary:cu', 'wiktionary:orv', 'wiktionary:ru-old')
        or length(definition) <= 40 or length(definition) > 520
        or substring(ltrim(definition, ' '), 1, 1) in ('(', '[', '·', '•') or {_starts("ltrim(definition, ' ')")}
        or {' or '.join(f'contains(definition, {_q(s)})' for s in P.CANDIDATE_PARTS)}
        or {' or '.join(f"ends_with(rtrim(definition, ' '), {_q(s)})" for s in P.CANDIDATE_ENDS)}
        or contains(lower(definition), 'http://') or contains(lower(definition), 'https://')
        or {_sql_casefold('substring(definition, 1, length(lemma))')} = {_sql_casefold('lemma')})""",
    "extract_pack": """with d as (select word, definition, min(pack) as pack from pack_entries where word is not null and definition is not null group by 1, 2),
      r as (select *, row_number() over (partition by word order by definition) as place from d) select word, definition, place from r where place <= 3""",
    "stage_stats": """select count(*) as definitions, count(distinct lemma) as lemmas,
      (select count(*) from (select distinct key, lemma from links where key <> '' and lemma <> '')) as links,
      (select count(distinct key) from links where key <> '' and lemma <> '') as lookup_keys from senses where definition is not null""",
    "marked_headwords": f"""with l as (select distinct lemma from senses where source = 'dal' and lemma is not null),
        m as (select lemma as old, {_sql_trim("regexp_replace(" + _sql_plain_key('lemma') + ", '(?i)" + chr(92) + "s+(?:м|ж|ср|об|мн|ед)" + chr(92) + ".?" + chr(92) + "s*$', '')")} as new from l)
      select old, new, new in (select lemma from senses where lemma is not null) as conflict from m where old <> new and {_sql_valid('new')}""",
    "hint_targets": """with one as (select lemma, min(definition) as definition from senses where definition is not null and lemma is not null group by 1 having count(*) = 1)
      select key, target, definition from (select distinct key, target from form_hints where kind = 'passive' and key is not null and target is not null) join one on target = lemma
      where key not in (select lemma from senses where definition is not null and lemma is not null)""",
    "best_participles": f"""with f as (select lemma as verb, key, {_sql_casefold('key')} as low from links where key is not null and lemma is not null),
      g as (select * from f where regexp_matches(low, '(?:{'|'.join(P.PARTICIPLE_ENDINGS)})$') and not contains(key, ' ') and length(key) <= 70 and low <> {_sql_casefold('verb')}),
      r as (select *, row_number() over (partition by verb order by length(key), case when contains(low, 'ё') then 0 else 1 end, low, key) as place from g)
      select verb, key as participle from r where place = 1""",
    "oov_classify": _C + _V + f""", s0 as (select normalized, arg_min(token, rank) as token, bool_and(regexp_matches(token, '^[А-ЯЁ][а-яё-]+$')) as names from ranked where rank <= 5 group by 1),
      s1 as (select unk.normalized, count, token, names, {_sql_script('token')} as script, string_split(unk.normalized, '-') as parts, regexp_matches(token, '(?i)^[ivxlcdm]+$') as is_roman,
        list_transform(string_split(upper(token), ''), lambda c: coalesce(map {{'I': 1, 'V': 5, 'X': 10, 'L': 50, 'C': 100, 'D': 500, 'M': 1000}}[c], 0)) as v from unk join s0 using (normalized) where count > 0),
      s2 as (select *, case when is_roman then 1 when (length(normalized) >= 4 and replace(normalized, normalized[1], '') = '') or
            (len(parts) >= 3 and len(list_filter(parts, lambda p: length(p) = 1)) > 0 and len(list_filter(parts, lambda p: p = '')) = 0) then 2
          when regexp_matches(token, '^[A-ZА-ЯЁ]{{2,10}}$') then 3 when normalized in ({', '.join(_q(x) for x in coverage.ABBREVIATIONS)}) then 4
          when script in ('latin', 'greek', 'other-alphabet', 'mixed') then 5 when script = 'cyrillic' and names and length(normalized) >= 3 then 6 else 7 end as k,
        list_sum(list_transform(v, lambda x, i: case when x < coalesce(v[i + 1], 0) then -x else x end)) as roman from s1)
      select normalized, count, token, script, ['number', 'noise', 'abbreviation', 'abbreviation', 'foreign', 'name', 'word'][k] as category,
        ['ignore_numeric', 'ignore_typographic_variant', 'review_abbreviation_pack', 'review_abbreviation_pack', 'review_separate_language_layer', 'review_literary_name_layer', 'review_lexicographic_entry'][k] as action,
        k > 2 as candidate, ['roman_numeral', 'stylised_spelling', 'capitals', 'closed_list', 'script', 'capitalised_in_all_places', 'no_match'][k] as reason,
        ['high', 'high', 'high', 'medium', 'high', 'possible', 'possible'][k] as confidence, case when k = 1 then 'roman:' || cast(cast(roman as bigint) as varchar) else normalized end as candidate_key from s2""",
    "index_records": _ARTICLES.replace("with d as", f"with {_E}, d as") + """, g as (select key, list(lemma order by lemma) as ls from edges where lemma in (select lemma from art) group by key),
      j as (select ls, array_to_string(ls, chr(0)) as name, unnest(ls) as lemma from (select distinct ls from g where len(ls) > 1)),
      b as (select 0 as c, lemma as name, strlen(article) as size from art union all
        select 2, name, sum(strlen(article)) + count(*) - 1 from j join art using (lemma) group by name),
      o as (select *, sum(size) over (order by c, name) - size as off from b)
      select key, cast(off as bigint) as "offset", cast(size as bigint) as size from g join o on o.c = if(len(ls) > 1, 2, 0) and o.name = array_to_string(ls, chr(0)) where strlen(key) <= 255""",
    "leaked_meanings": _ARTICLES + f""", l as (select lemma, unnest(string_split(article, chr(10))) as line from art),
      m as (select lemma, {_sql_trim("regexp_replace(regexp_replace(line, chr(13) || '$', ''), '^" + chr(92) + "s*" + chr(92) + "d+" + chr(92) + "." + chr(92) + "s*', '')")} as line from l),
      x as (select lemma, line, list_filter([case when {_sql_like('line', leaks.RESIDUE)} then 'residue' end,
        case when regexp_matches(line, {_q('(?i)</(?:' + P.HTML_NAMES + ')' + chr(92) + 's*>|<(?:br|hr)(?:[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_<>][^<>]*)?>|<(?:' + P.HTML_NAMES + ')' + chr(92) + 's+[^<>]*>')}) then 'html' end,
        case when {_sql_like('line', leaks.LABEL)} then 'label' end, case when {_sql_like('line', leaks.CONTEXT)} then 'context' end,
        case when {_sql_like('line', P.EMPTY_META)} or {_sql_like('line', leaks.FRAGMENT)} then 'placeholder' end,
        case when {_sql_like('line', P.FORM_OF[0])} or {_sql_like('line', P.GRAMMAR)} then 'grammar' end], lambda f: f is not null) as fs from m where line <> '')
      select lemma, line, unnest(fs) as fault from x""",
    "page_filter": f"""with p as (select distinct title, categories, string_split(coalesce(categories, ''), chr(10)) as cs from candidates where title is not null)
      select title, length(title) > 140 or contains(title, ':') or regexp_matches(title, {_q('(?i)' + W.BAD_TITLE)}) or regexp_matches(title, {_q('(?i)' + W.BAD_QUALIFIER)}) as bad_title,
        len(list_filter(cs, lambda c: regexp_matches(c, {_q('(?i)' + W.DOMAIN)}))) > 0 as domain, len(list_filter(cs, lambda c: regexp_matches(c, {_q('(?i)' + W.NOISE)}))) > 0 as noise from p""",
    "lookup_probes": f"""with {_E}, {_D}, k as (select distinct key from form_hints where key is not null),
      n as (select key, {_sql_plain_key('key')} as p from k), f as (select key, p, {_sql_casefold('p')} as low,
        {_sql_casefold("translate(regexp_replace(p, '[" + native.STRESS + "]', '', 'g'), " + _q(native.STRESSED) + ", " + _q(native.UNSTRESSED) + ")")} as bare from n),
      g as (select distinct key from edges where lemma in (select lemma from defined))
      select key, p in (select key from g) or low in (select key from g) or replace(low, 'ё', 'е') in (select key from g) or bare in (select key from g) as defined from f""",
    "bundle_roundtrip": _ARTICLES.replace("with d as", f"with {_E}, d as") + """, e as (select key, a.lemma, article from edges a join art using (lemma) where strlen(key) <= 255)
      select key as word, string_agg(article, chr(10) order by lemma) as article from e group by key""",
    "star_lookup_totals": """select n_name, count(*) as lines, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue
      from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by 1""",
}

# --- Spark ------------------------------------------------------------------------------


def _links(s, d):
    return graph.clean_edges(table(s, d, "links"))


def _keys(s, d):
    k = table(s, d, "links").select(F.col("key").alias("k")).unionByName(table(s, d, "pack_entries").select(F.col("word").alias("k")))
    return coverage.known_keys(k.distinct(), "k")


def _counts(s, d, per_doc=False):
    return coverage.token_counts(table(s, d, "documents"), _keys(s, d), Workspace(s, "coverage"), per_doc)


def _distinct_keys(s, d):
    return table(s, d, "links").where("key is not null").select("key").distinct()


def _scored(s, d):
    return quality.score(quality.with_flags(table(s, d, "senses")))


def normalize_key(s, d):
    k = _distinct_keys(s, d).withColumn("normalized", native.normalize_key(F.col("key")))
    return k.withColumn("valid", native.is_lookup_key(F.col("normalized")))


def alias_expand(s, d):
    raw = spread(table(s, d, "links").where("key is not null").select("key")).distinct()
    k = raw.select(native.normalize_key(F.col("key")).alias("key")).distinct()
    return k.where(native.is_lookup_key(F.col("key"))).select("key", F.explode(native.alias_candidates(F.col("key"))).alias("alias"))


def _surfaces(s, d):
    """Tokens as written with their counts: whatever follows sees each surface once."""
    return coverage.token_rows(table(s, d, "documents")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def tokenize_counts(s, d):
    return _surfaces(s, d).groupBy(coverage.folded(F.col("token")).alias("normalized")).agg(F.sum("n").alias("n"))


def script_distribution(s, d):
    t = _surfaces(s, d).select(native.script_of(F.col("token")).alias("script"), coverage.folded(F.col("token")).alias("w"), "n")
    per = t.groupBy("script", "w").agg(F.sum("n").alias("n"))
    return per.groupBy("script").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_distinct"))


def ngram_lookup_candidates(s, d):
    w = F.transform(native.tokens(F.col("text")), lambda x: native.normalize_lookup(x, composed=True))
    g = table(s, d, "eval_items").select("item_id", F.explode(native.ngrams(w)).alias("gram"))
    return g.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("item_id").alias("items"))


def oov_by_script(s, d):
    u = coverage.unknown_tokens(_counts(s, d))
    return u.groupBy(native.script_of(F.col("normalized")).alias("script")).agg(
        F.sum("count").alias("tokens"), F.count(F.lit(1)).alias("forms")
    )


def oov_classify(s, d):
    docs = table(s, d, "documents")
    return coverage.classify(coverage.unknown_tokens(_counts(s, d)), coverage.variants(docs))


def oov_groups(s, d):
    docs, keys, ws = table(s, d, "documents"), _keys(s, d), Workspace(s, "oov")
    per_doc = ws.keep(coverage.unknown_tokens(coverage.token_counts(docs, keys, ws, True)), "per_doc")
    whole = coverage.unknown_tokens(coverage.token_counts(docs, keys, ws, per_doc=False))
    classified = ws.keep(coverage.classify(whole, coverage.variants(docs)), "classified")
    return coverage.oov_groups(classified, per_doc)


def link_closure(s, d):
    return graph.resolve_aliases(_links(s, d), graph.defined_lemmas(table(s, d, "senses")), Workspace(s, "closure"))


def closure_counts(s, d):
    edges, defined = _links(s, d), graph.defined_lemmas(table(s, d, "senses"))
    return graph.resolution_counts(edges, defined, graph.resolve_aliases(edges, defined, Workspace(s, "closure")))


def override_merge(s, d):
    hints = table(s, d, "form_hints").where("kind = 'passive' and target is not null")
    return graph.merge_overrides(_links(s, d), hints.groupBy("key").agg(F.max("target").alias("definition")))


def prefix_offsets(s, d):
    a = articles.build_articles(table(s, d, "senses"))
    return articles.with_offsets(a, "lemma", F.octet_length("article").cast("long")).select("lemma", "size", "offset")


def extract_pack(s, d):
    from pyspark.sql import Window

    e = table(s, d, "pack_entries").where("word is not null and definition is not null").select("word", "definition").distinct()
    place = F.row_number().over(Window.partitionBy("word").orderBy("definition"))
    return e.withColumn("place", place).where("place <= 3")


def stage_stats(s, d):
    senses = table(s, d, "senses").where("definition is not null").agg(
        F.count(F.lit(1)).alias("definitions"), F.countDistinct("lemma").alias("lemmas")
    )
    links = _links(s, d).agg(F.count(F.lit(1)).alias("links"), F.countDistinct("key").alias("lookup_keys"))
    one = F.lit(1)
    return senses.withColumn("_j", one).join(links.withColumn("_j", one), "_j").drop("_j")  # one row each


def star_lookup_totals(s, d):
    li, o, c, n = (table(s, d, x) for x in ("lineitem", "orders", "customer", "nation"))
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy("n_name").agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue")
    )


def alias_formula(s, d):
    t = spread(table(s, d, "senses").select("seq", "definition")).select("seq", quality.compact(F.col("definition")).alias("text"))
    f = t.select("seq", aliases.formula(F.col("text")).alias("f"))
    f = native.keep_rows(f, F.col("f").isNotNull())
    return f.select("seq", "f.kind", F.array_join("f.candidates", "|").alias("candidates"), "f.tail", "f.body")


def clean_definitions(s, d):
    t = spread(table(s, d, "senses").where("definition is not null").select("seq", "definition"))
    return cleaning.with_clean(t, "definition", "clean").select("seq", "clean")


def _pages(s, d):
    """Prepared pages, one row per title: of repeated deliveries the one with the greatest lead."""
    p = table(s, d, "candidates").where("title is not null")
    best = F.max_by(F.struct("categories", "lead_z"), F.struct("lead_z", "categories")).alias("r")
    return p.groupBy("title").agg(best).select("title", "r.categories", "r.lead_z")


def wiki_leads(s, d):
    pages = _pages(s, d)
    return wiki.lead_definitions(pages.select("title", wiki.inflate(F.col("lead_z")).alias("lead")))


def passive_overrides(s, d):
    return forms.derive_overrides(table(s, d, "form_hints"), table(s, d, "senses"), table(s, d, "links"))


def index_records(s, d):
    from lexloom.sinks.stardict import index_records as build

    senses, links = table(s, d, "senses"), table(s, d, "links")
    return build(senses, links, None, Workspace(s, "index"))[1]


def _store(s, d):
    return semantic.Store(table(s, d, "senses").select("lemma", "definition", "source", "seq"), _links(s, d))


def normalized_definitions(s, d):
    """Text and changes of every definition that normalisation looks at."""
    rows = spread(quality.semantic_candidates(table(s, d, "senses")).select("seq", "lemma", "definition", "source"))
    return normalize.normalize(rows).select("seq", "text", F.array_join("changes", ",").alias("changes"))


def semantic_outcomes(s, d):
    return semantic.pass_statistics(semantic.semantic_pass(_store(s, d), Workspace(s, "semantic")))


def semantic_senses(s, d):
    return semantic.semantic_pass(_store(s, d), Workspace(s, "semantic")).store.senses.select("seq", "lemma", "definition", "source")


def rescued_senses(s, d):
    ws = Workspace(s, "rescue")
    done = semantic.semantic_pass(_store(s, d), ws)
    pages = _pages(s, d).select("title", "categories", wiki.inflate(F.col("lead_z")).alias("lead"))
    out = semantic.rescue(done.store, done.rescue, layers.page_definitions(pages, need_domain=False), ws)
    return out.senses.where("source in ('ruwiki-quality', 'ruwiki-rescue')").select("lemma", "definition", "source")


def marked_headwords(s, d):
    return semantic.migrate_headwords(_store(s, d))[1]


def page_filter(s, d):
    pages = table(s, d, "candidates").where("title is not null").select("title", "categories").distinct()
    return pages.select("title", *[F.coalesce(v, F.lit(False)).alias(k) for k, v in layers.page_tests(F.col("title"), F.col("categories")).items()])


def lookup_probes(s, d):
    """Key spellings of form hints that lead to a defined lemma."""
    k = table(s, d, "form_hints").where("key is not null").select("key").distinct()
    return layers.is_defined(k, _store(s, d), "key").select("key", "defined")


def pack_union(s, d):
    """Layered insert of pack entries after the senses: rows that are newly inserted."""
    p = table(s, d, "pack_entries").where("word is not null and definition is not null")
    rows = p.select(F.col("word").alias("lemma"), "definition", F.concat(F.lit("extra:"), F.col("pack")).alias("source"), F.struct("pack", "definition").alias("place"))
    _, fresh = layers.add_senses(_store(s, d), rows)
    return fresh.select("lemma", "definition")


def leaked_meanings(s, d):
    """Lines of articles that are no meaning, with what gives them away."""
    art = articles.build_articles(table(s, d, "senses"))
    return leaks.leaked_lines(Workspace(s, "leaks").keep(art, "articles"))


def about_phrases(s, d):
    """Definitions ``О X`` that the link graph can rewrite."""
    t = table(s, d, "senses").where("lemma is not null and definition is not null")
    return about.rewrite(t.select("seq", F.col("definition").alias("text")), _links(s, d), t.select("lemma").distinct())


def bundle_roundtrip(s, d):
    """Keys and articles of a bundle that was written from the store and read back."""
    from lexloom.sinks import stardict
    from lexloom.sources.stardict import read_index, resolve

    ws = Workspace(s, "bundle")
    bodies, index = stardict.index_records(table(s, d, "senses"), table(s, d, "links"), None, ws)
    base = ws.path("dictionary")
    stardict.write_bundle(bodies, index, base, "t")
    return resolve(s, base, read_index(s, base).select("word", "offset", "size"), "raw").select("word", "article")


def queries():
    return {
        "p5_found": rejects.p5_found,
        "p5_entries": rejects.p5_entries,
        "normalize_key": normalize_key,
        "normalize_lookup": lambda s, d: _distinct_keys(s, d).withColumn("normalized", native.normalize_lookup(F.col("key"))),
        "alias_expand": alias_expand,
        "tokenize_counts": tokenize_counts,
        "script_distribution": script_distribution,
        "ngram_lookup_candidates": ngram_lookup_candidates,
        "coverage_by_file": lambda s, d: coverage.coverage_by_file(_counts(s, d, True)),
        "coverage_report": lambda s, d: coverage.coverage_report(_counts(s, d)),
        "oov_topk": lambda s, d: coverage.unknown_tokens(_counts(s, d)).orderBy(F.desc("count"), "normalized").limit(200),
        "oov_by_script": oov_by_script,
        "oov_classify": oov_classify,
        "oov_groups": oov_groups,
        "oov_categories": lambda s, d: coverage.category_summary(oov_classify(s, d)),
        "token_variants_top5": lambda s, d: coverage.variants(table(s, d, "documents")),
        "insert_or_ignore_senses": lambda s, d: dedupe.insert_or_ignore(
            table(s, d, "senses").where("lemma is not null and definition is not null").select("lemma", "definition", "source", "seq"), ["lemma", "definition"], ["seq"]
        ),
        "insert_or_replace_overrides": lambda s, d: dedupe.insert_or_replace(
            table(s, d, "events").select("user_id", "event_type", "value", "event_id"), ["user_id"], ["event_id"]
        ),
        "layered_fallback": lambda s, d: dedupe.layer_fallback(table(s, d, "senses")).select("lemma", "seq", "source"),
        "group_senses_article": lambda s, d: articles.build_articles(table(s, d, "senses")),
        "prefix_offsets": prefix_offsets,
        "ambiguous_keys": lambda s, d: graph.ambiguous_keys(_links(s, d)),
        "override_merge": override_merge,
        "link_closure": link_closure,
        "closure_counts": closure_counts,
        "prune_dangling": lambda s, d: graph.prune_dangling(_links(s, d), graph.defined_lemmas(table(s, d, "senses"))),
        "resolved_lookup": lambda s, d: graph.resolve_keys(_links(s, d), table(s, d, "senses")),
        "alias_formula": alias_formula,
        "quality_totals": lambda s, d: quality.totals(_scored(s, d)),
        "informational_examples": lambda s, d: quality.informational_examples(_scored(s, d)),
        "quality_flags": lambda s, d: quality.with_flags(table(s, d, "senses")).select("seq", F.array_join("flags", ",").alias("flags")),
        "quality_score": lambda s, d: _scored(s, d).select("seq", "score"),
        "quality_buckets": lambda s, d: quality.score_buckets(_scored(s, d)),
        "quality_warning_counts": lambda s, d: quality.warning_counts(_scored(s, d)),
        "quality_by_source": lambda s, d: _scored(s, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 2).alias("average")),
        "flag_examples": lambda s, d: quality.flag_examples(_scored(s, d)),
        "quality_review_topk": lambda s, d: quality.review_queue(_scored(s, d)),
        "semantic_candidates": lambda s, d: quality.semantic_candidates(table(s, d, "senses")).select("seq"),
        "extract_pack": extract_pack,
        "stage_stats": stage_stats,
        "clean_definitions": clean_definitions,
        "normalized_definitions": normalized_definitions,
        "semantic_outcomes": semantic_outcomes,
        "semantic_senses": semantic_senses,
        "rescued_senses": rescued_senses,
        "marked_headwords": marked_headwords,
        "page_filter": page_filter,
        "lookup_probes": lookup_probes,
        "pack_union": pack_union,
        "bundle_roundtrip": bundle_roundtrip,
        "leaked_meanings": leaked_meanings,
        "about_phrases": about_phrases,
        "wiki_leads": wiki_leads,
        "passive_overrides": passive_overrides,
        "hint_targets": lambda s, d: forms.eligible_hints(table(s, d, "form_hints"), table(s, d, "senses")),
        "best_participles": lambda s, d: forms.best_participles(table(s, d, "links")),
        "pack_variants": lambda s, d: packs.with_variants(table(s, d, "pack_entries").where("word is not null")).select("word", "definition", "aliases"),
        "index_records": index_records,
        "star_lookup_totals": star_lookup_totals,
    }


def oracle_sql():
    found = {**rejects.SQL, **SQL}
    inner = SQL["oov_classify"]
    found["oov_categories"] = f"with c as ({inner}) select category, count(*) as forms, cast(sum(count) as bigint) as tokens from c group by 1"
    found["oov_groups"] = f"""with c as ({inner}), pd as ({_C} select doc, normalized, cast(greatest(n - covered, 0) as bigint) as u from counts where not single_known and n > covered),
      w as (select sum(count) as whole from c),
      g as (select category, action, candidate_key, sum(count) as t, string_agg(normalized || ':' || count, ' ' order by count desc, normalized) as forms from c group by all),
      f as (select category, action, candidate_key, doc, sum(u) as n from pd join c using (normalized) group by all),
      fs as (select category, action, candidate_key, string_agg(doc || ':' || n, ' ' order by n desc, doc) as files from f group by all)
      select category, action, candidate_key, cast(t as bigint) as total, forms, round(100 * t / whole, 4) as share_percent, files,
        row_number() over (order by t desc, candidate_key, category, action) as rank from g left join fs using (category, action, candidate_key), w"""
    return found
