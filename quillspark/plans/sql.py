"""Pieces of DuckDB SQL that say what the text functions say."""

from __future__ import annotations

from quillspark.functions import patterns as P


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(P.EDGES)}, '', 'g')"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {lit(P.WS + '+')}), lambda w: w <> '')"


def word_count(x: str) -> str:
    return f"len({words(x)})"


def unwrap(x: str) -> str:
    return f"trim(regexp_replace({x}, {lit(P.WS + '+')}, ' ', 'g'))"


def normalize(x: str) -> str:
    return unwrap(f"regexp_replace({x}, '-{{2,}}|—', ' ', 'g')")


def heading(x: str) -> str:
    return f"regexp_matches({strip(x)}, {lit(P.HEADING)})"


def kind(x: str) -> str:
    return f"case when regexp_matches({strip(x)}, {lit(P.BACK)}) then 'back' when regexp_matches({strip(x)}, {lit(P.FRONT)}) then 'front' else 'body' end"


def contents_line(x: str) -> str:
    return f"(regexp_matches({strip(x)}, {lit(P.CONTENTS_LINE)}) or {heading(x)} or regexp_matches({x}, {lit(P.CONTENTS_NUMERAL)}))"


def count_of(x: str, ch: str) -> str:
    return f"(length({x}) - length(replace({x}, {lit(ch)}, '')))"


def style(x: str) -> str:
    return f"case when {count_of(x, '“')} >= 2 then 'curly' when {count_of(x, chr(34))} >= 2 then 'straight' when {count_of(x, '‘')} >= 2 then 'single' end"


def paragraphs(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex({strip(x)}, '\\n\\n+'), lambda p: {unwrap('p')}), lambda p: p <> '')"


def sentences(x: str) -> str:
    """Sentences of narration; x is used once."""
    token = f"lower(regexp_replace(regexp_extract(p, {lit(P.LAST_TOKEN)}, 1), {lit('^[“‘' + chr(34) + chr(39) + '(\\[]+|[.!?…”’' + chr(34) + chr(39) + ')\\]]+$')}, '', 'g'))"
    words_ = ", ".join(lit(a) for a in P.ABBREVIATIONS)
    veto = f"(regexp_extract(p, {lit(P.LAST_TOKEN)}, 2) = '.' and ({token} in ({words_}) or regexp_matches({token}, '^\\p{{L}}$'))) or regexp_matches(coalesce(ps[i + 1], ''), '^\\p{{Ll}}')"
    parts = f"string_split(regexp_replace({x}, {lit(P.SENTENCE_END)}, '\\1\\2' || chr(1), 'g'), chr(1))"
    return f"(list_transform([{parts}], lambda ps: list_filter(list_transform(string_split(array_to_string(list_transform(ps, lambda p, i: p || case when {veto} then '' else chr(2) end), ''), chr(2)), lambda s: {strip('s')}), lambda s: s <> '')))[1]"


def tag_sentences(x: str) -> str:
    held = f"regexp_replace({strip(x)}, {lit(P.TITLE_PERIOD)}, '\\1' || chr(1) || '\\2', 'g')"
    return f"list_filter(list_transform(string_split(regexp_replace({held}, {lit('([.!?])' + P.WS + '+')}, '\\1' || chr(2), 'g'), chr(2)), lambda s: replace(s, chr(1), '')), lambda s: s <> '')"


def leads(x: str) -> str:
    return f"(regexp_matches(array_to_string({words(x)}[1:6], ' '), {lit(P.SPEECH_VERB)}) and not regexp_matches({x}, {lit(P.REPORTED_THAT)}))"


def is_tag(kind_: str, x: str) -> str:
    return f"({kind_} = 'narration' and {word_count(x)} <= 20 and len(list_filter({tag_sentences(x)}, lambda z: {leads('z')})) > 0)"


def quoted(x: str) -> str:
    return f"regexp_replace({x}, '([\\\\.\\[\\]{{}}()*+?^$|\\-])', '\\\\\\1', 'g')"


def mentions(text: str, alias: str) -> str:
    left = f"case when regexp_matches({alias}, {lit('^' + P.W)}) then {lit('(^|' + P.NOT_W + ')')} else {lit(P.W)} end"
    right = f"case when regexp_matches({alias}, {lit(P.W + '$')}) then {lit('($|' + P.NOT_W + ')')} else {lit(P.W)} end"
    return f"regexp_matches(lower({text}), {left} || {quoted(alias)} || {right})"


def name_tokens(x: str) -> str:
    return f"list_distinct(list_transform({words(x)}, lambda t: lower(regexp_replace(t, '^\\.+|\\.+$', '', 'g'))))"


SEGS = "segs as (select distinct segment_id, book_id, chapter_number, seg_idx, para, seg_type, text, nullif(speaker, '') as speaker, notes from segments)"
ROSTER = "people as (select distinct character_id, book_id, ord, name, coalesce(aliases, []) as aliases from roster)"
CHAPTERS = "chaps as (select distinct book_id, chapter_number, title, start_line, end_line, word_count, start_marker, kind from chapters)"
ALIASES = f"""{ROSTER},
spelled as (select book_id, ord, -1 as k, lower(name) as alias, name as canonical from people union all select book_id, ord, (unnest(range(len(aliases))))::int, lower(unnest(aliases)), name from people),
amap as (select book_id, alias, arg_max(canonical, (ord, k)) as canonical, min(ord) as ord from spelled where alias is not null and canonical is not null group by book_id, alias)"""
_GUARD = "regexp_replace(regexp_replace(p, '(\\p{L})’(\\p{L})', '\\1' || chr(3) || '\\2', 'g'), '(\\p{L})’(\\p{L})', '\\1' || chr(3) || '\\2', 'g')"
SPANS = f"""
styled as (select doc_id, {style('text')} as style, {paragraphs('text')} as paras from documents where text is not null),
pars as (select doc_id, style, (unnest(range(len(paras))))::int as para, unnest(paras) as p from styled),
toks as (select doc_id, style, para, case style when 'curly' then regexp_extract_all(p, '(“[^”]*(?:”|$)|[^“]+)', 1) when 'straight' then regexp_extract_all(p, '("[^"]*(?:"|$)|[^"]+)', 1)
  when 'single' then regexp_extract_all({_GUARD}, '(‘[^’]*(?:’|$)|[^‘]+)', 1) else [p] end as ts from pars),
spans as (select doc_id, style, para, (unnest(range(len(ts))))::int as k, unnest(ts) as t from toks),
typed as (select doc_id, para, k, {strip("replace(t, chr(3), '’')")} as text,
  case when style is not null and starts_with(t, case style when 'curly' then '“' when 'straight' then '"' else '‘' end) then 'dialogue' else 'narration' end as seg_type,
  case when style is not null and starts_with(t, case style when 'curly' then '“' when 'straight' then '"' else '‘' end) and (not ends_with(t, case style when 'curly' then '”' when 'straight' then '"' else '’' end) or length(t) = 1) then 'quote-continues' end as notes
  from spans)
"""
