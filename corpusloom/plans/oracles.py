"""SQL that says the same as the core queries, for DuckDB.

Its regular expressions know white space and digits of ASCII only, so Unicode
classes are spelled out by ``_re``. Text steps that SQL cannot say exactly
(normalisation, state machines, cascading replacement, generators) have none
and are tested against plain versions instead.
"""

from __future__ import annotations

from corpusloom.functions import clean, prompts
from corpusloom.operators import quality

_SPACE = r"\t-\r \x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_JP = "[ぁ-んァ-ヴー一-龠々〆〤]"
_NL = "chr(10)"


def _re(pattern: str) -> str:
    """A pattern with Unicode white space and digits, quoted for SQL."""
    return "'" + pattern.replace(r"\s", f"[{_SPACE}]").replace(r"\d", r"\p{Nd}").replace("'", "''") + "'"


def _sub(text: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({text}, {_re(pattern)}, {replacement}, 'g')"


def _strip(text: str) -> str:
    return _sub(_sub(text, r"^\s+", "''"), r"\s+$", "''")


def _lines(text: str, keep: str) -> str:
    return f"array_to_string(list_filter(string_split({text}, {_NL}), lambda l: {keep}), {_NL})"


def _any(line: str, patterns: list[str]) -> str:
    return f"regexp_matches({line}, {_re('(?i)^(?:' + '|'.join(f'(?:{p})' for p in patterns) + ')')})"


def _q(text: str) -> str:
    """A string literal; line ends as they are."""
    return "'" + text.replace("'", "''") + "'"


def _complete(n: int) -> str:
    count = lambda chars: "(length(t) - length(translate(t, " + _q(chars) + ", '')))"
    ends = "|".join(clean.OPEN_ENDINGS)
    return f"""(length(t) >= {n} and (length(t) <= 100 or {count(clean.SENTENCE_ENDS)} > 0) and abs({count(clean.OPENING)} - {count(clean.CLOSING)}) <= 2
      and not regexp_matches({_sub('t', r'\s+$', "''")}, '(?:{ends})$'))"""


_WHITE = _strip(f"regexp_replace(regexp_replace(regexp_replace(x, '\\n{{3,}}', {_NL} || {_NL}, 'g'), ' +\\n', {_NL}, 'g'), ' {{2,}}', ' ', 'g')")
_NUMBERS = _sub(_sub("x", r"(\d)\s+(\d{3})", r"'\1\2'"), r"(\d)\s*/\s*(\d)", r"'\1/\2'")
_LAYOUT = _sub(_sub(f"regexp_replace(x, ' *\\n *', {_NL}, 'g')", f" +({_JP})", r"'\1'"), f"({_JP}) +", r"'\1'")


def _chunk(expression: str) -> str:
    return f"select line_no, {expression} as text from (select line_no, text as x from chunks)"


def _border(pattern: str) -> str:
    """A pattern between characters that are no letters, digits or underscores of any script."""
    return r"(?:^|[^\p{L}\p{M}\p{Nd}\p{Pc}])(?:" + pattern + r")(?:$|[^\p{L}\p{M}\p{Nd}\p{Pc}])"


_SAFE = " and ".join(f"not regexp_matches(text, {_re(_border(p.removeprefix(chr(92) + 'b').removesuffix(chr(92) + 'b')))})" for p in (quality.PHONE, quality.EMAIL, quality.CARD, quality.PERSONAL_NUMBER))
_HEAD = {
    "major": " ".join(f"when regexp_matches(l, {_re('^' + p)}) then regexp_replace(l, {_re('^' + p)}, {_q(r)})" for p, r in clean.MAJOR_HEADINGS),
    "minor": " ".join(f"when regexp_matches(m, {_re('^' + p)}) then regexp_replace(m, {_re('^' + p)}, {_q(r)})" for p, r in clean.MINOR_HEADINGS),
}
_TERMS = "(select *, coalesce(confidence, 1.0) as conf from terms)"
_SURFACES = f"""
with forms as (select t.*, unnest(list_concat([headword], coalesce(synonyms, []))) as surface, unnest(range(0, 1 + coalesce(len(synonyms), 0))) as k from {_TERMS} t where coalesce(headword, '') <> ''),
named as (select * from forms where coalesce(surface, '') <> ''),
surf as (select surface, min((pos::bigint, k)) as ord, arg_max(pos, (pos::bigint, k)) as entry_pos from named group by surface),
full_surf as (select s.surface, s.ord, e.* from surf s join {_TERMS} e on e.pos = s.entry_pos)"""
_FOUND = f"""{_SURFACES},
hits as (select c.line_no, s.*, row_number() over (partition by c.line_no order by length(s.surface) desc, s.ord) as o from chunks c join full_surf s on contains(c.text, s.surface)),
firsts as (select *, row_number() over (partition by line_no, headword order by o) as n from hits),
found as (select *, row_number() over (partition by line_no order by o) - 1 as rank from firsts where n = 1)"""
_DEFINED = f"""
with firsts as (select *, row_number() over (partition by headword order by pos) as n, coalesce(brief_definition, '') as b, coalesce(definition, '') as f from {_TERMS} where coalesce(headword, '') <> ''),
said as (select pos, headword as h, {_strip("case when b <> '' and f <> '' then b || '。' || f else b || f end")} as d from firsts where n = 1 and (b <> '' or f <> ''))"""
_EDGES = """
select source, type, target, min(pos) as pos from graph_edges
where type <> 'MENTIONS' and not regexp_matches(source, '^[0-9a-f]{64}$') and not regexp_matches(target, '^[0-9a-f]{64}$')
group by source, type, target"""
_NODES = f"""
with e as ({_EDGES}),
t as (select source, type, min(pos) as pos, string_agg(target, ', ' order by pos) as targets, count(*) as n from e group by source, type)
select source as node, min(pos) as pos, string_agg('- ' || type || ': ' || targets, chr(10) order by pos) as relations, sum(n)::int as relation_count from t group by source"""
_PACKED = """
with r as (select meta.source_file as f, line_no, text, length(text) * 3 // 2 as t from chunks where coalesce(text, '') <> ''),
g as (select f, list(t order by line_no) as ts, list(length(text) order by line_no) as cs from r group by f),
p as (select f, ts, cs, list_reduce(ts, lambda a, t: case
    when t > 2048 then {'c': -1::bigint, 'n': a.n + 1, 'o': list_append(a.o, a.n + 1)}
    when a.c >= 0 and a.c + 3 + t <= 2048 then {'c': a.c + 3 + t, 'n': a.n, 'o': list_append(a.o, a.n)}
    else {'c': t, 'n': a.n + 1, 'o': list_append(a.o, a.n + 1)} end, {'c': -1::bigint, 'n': 0::bigint, 'o': []::bigint[]}) as z from g),
u as (select f, unnest(z.o) as pack, unnest(ts) as t, unnest(cs) as c from p)
select f as source_file, pack, count(*) as n, sum(t) + 3 * (count(*) - 1) as tokens, sum(c) + 2 * (count(*) - 1) as chars from u group by f, pack"""


def _render(name: str, **values: str) -> str:
    from string import Formatter

    parts = []
    for literal, field, _, _ in Formatter().parse(prompts.USER[name]):
        if literal:
            parts.append(_q(literal))
        if field is not None:
            parts.append(values[field])
    return " || ".join(parts)


def _measured(prompt: str, system: str = "") -> str:
    """The answer of the generator that SQL can form."""
    return f"(length({prompt}) || ' {len(system)} ' || right({prompt}, 40))"


def _rewritten(name: str, **values: str) -> str:
    return f"""select line_no, {_strip(_measured('p'))} as text, '{name}' as source from (select line_no, {_render(name, text='text', context='text', **{k: _q(v) for k, v in values.items()})} as p from chunks where {_strip('text')} <> '')"""


_ASKED = f"from chunks where {_strip('text')} <> ''"
_PAIR = lambda q, a, gap="chr(10)": f"'質問: ' || {q} || {gap} || '回答: ' || {a}"
_JOINED = _sub(_sub("text", f"({_JP})\\n+({_JP})", r"'\1\2'"), f"({_JP})\\n+\\s*({_JP})", r"'\1\2'")
_CHAT = "'<|begin_of_text|>' || '<|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || " + _q(prompts.SYSTEM["llama3_assistant"]) + " || '<|eot_id|>'"
_TURN = lambda role, said: f" || '<|start_header_id|>{role}<|end_header_id|>' || chr(10) || chr(10) || {said} || '<|eot_id|>'"
_PATTERNS = f"""
with t as (select pos, headword as h, definition as d, coalesce(brief_definition, '') as b, coalesce(synonyms, []) as s from {_TERMS} where coalesce(headword, '') <> '' and coalesce(definition, '') <> ''),
l as (select pos, list_filter([h || 'とは、' || d, '質問: ' || h || 'とは何ですか？' || chr(10) || '回答: ' || d, h || 'について説明します。' || d,
  case when b <> '' then h || 'は' || b || 'です。' end, case when b <> '' then '質問: ' || h || 'を簡潔に説明してください。' || chr(10) || '回答: ' || b end,
  case when len(s) > 0 then h || 'は' || array_to_string(s, '、') || 'とも呼ばれます。' || d end], lambda x: x is not null) as ts from t)
select pos, unnest(range(0, len(ts)))::int as n, unnest(ts) as text from l"""

SQL: dict[str, str] = {
    "flagship": f"""
with c as (select doc_id, lang, {_WHITE.replace("(x,", "(" + _NUMBERS.replace("(x,", "(text,") + ",")} as text from documents),
s as (select *, row_number() over (partition by text order by doc_id) as n from c where {_SAFE})
select lang, count(*) as docs, sum(length(text)) as chars, sum(length(text) * 3 // 2) as est_tokens from s where n = 1 group by lang""",
    "latest_chunks": "select id, line_no, text from (select *, row_number() over (partition by id order by loaded_at desc, line_no desc) as n from chunks) where n = 1 or id is null",
    "c2_page_number_lines": f"select line_no, {_lines('text', 'not ' + _any('l', clean.PAGE_NUMBER_LINES))} as text, {_lines('text', _any('l', clean.PAGE_NUMBER_LINES))} as removed from chunks",
    "c3_header_footer_lines": f"select line_no, {_lines('text', 'not ' + _any('l', clean.HEADER_FOOTER_LINES))} as text from chunks",
    "c4_frequent_edges": f"""
with r as (select meta.source_file as d, line_no as p, string_split(coalesce(text, ''), {_NL}) as ls from chunks),
b as (select *, list_filter(list_transform(ls, lambda l: {_strip('l')}), lambda l: l <> '') as bare from r),
e as (select d, p, ls, bare[1] as f, bare[-1] as z from b),
n as (select d, count(*) as total from e group by d),
f as (select d, f as line, count(*) as c from e where f is not null group by all), z as (select d, z as line, count(*) as c from e where z is not null group by all),
hf as (select f.d, list(line) as ls from f join n on n.d is not distinct from f.d where total >= 3 and c >= total * 0.5 group by f.d), hz as (select z.d, list(line) as ls from z join n on n.d is not distinct from z.d where total >= 3 and c >= total * 0.5 group by z.d)
select e.d as source_file, e.p as line_no, array_to_string(list_filter(e.ls, lambda l, i: not ((i = 1 and coalesce(list_contains(hf.ls, {_strip('l')}), false)) or (i = len(e.ls) and coalesce(list_contains(hz.ls, {_strip('l')}), false)))), {_NL}) as text
from e left join hf on hf.d = e.d left join hz on hz.d = e.d""",
    "c7_numbers": _chunk(_NUMBERS),
    "c8_whitespace": _chunk(_WHITE),
    "c10_japanese": _chunk(_sub(_LAYOUT.replace("(x,", f"(replace(x, '  ' || {_NL}, ' '),"), f"({_JP})\\n+({_JP})", r"'\1\2'")),
    "c11_layout_spaces": _chunk(_LAYOUT),
    "c6_line_repair": f"""
with j as (select line_no, {_JOINED} as x from chunks),
m as (select line_no, array_to_string(list_transform(string_split(x, {_NL}), lambda r: case when {_strip('r')} = '' or starts_with({_strip('r')}, '#') then chr(57346) || r || chr(57347) else chr(57344) || {_strip('r')} || chr(57345) end), {_NL}) as x from j)
select line_no, translate(regexp_replace(x, '([^。．？！)）」』])' || chr(57345) || {_NL} || chr(57344), '\\1', 'g'), chr(57344) || chr(57345) || chr(57346) || chr(57347), '') as text from m""",
    "c12_markdown": _chunk(_strip(f"regexp_replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(x, '(?s)```(.*?)```', '\\1', 'g'), '`([^`]+)`', '\\1', 'g'), '\\n{{2,}}', chr(57344), 'g'), {_NL}, ' '), chr(57344), {_NL} || {_NL}), '(#+) (.*?) (#+)', '\\1 \\2' || {_NL} || '\\3', 'g')")),
    "c19_figures": f"select line_no, regexp_replace(text, '(?s)<figure[^>]*>.*?</figure>', {_NL} || {_NL} || '【図】図' || {_NL} || '説明' || {_NL} || {_NL}) as text from chunks",
    "c20_html_tables": f"select line_no, text from chunks where not regexp_matches(text, '(?is)<table[^>]*>.*?</table>') or text is null union all select line_no, array_to_string(list_transform(range(0, 2 * len(t) + 1), lambda i: case when i % 2 = 0 then k[i // 2 + 1] else {_NL} || {_NL} || (length(t[i // 2 + 1]) + {len(prompts.TABLE.format(table=''))}) || ' 0 ' || right(t[i // 2 + 1] || {_q(prompts.TABLE.rpartition('{table}')[2])}, 40) || {_NL} || {_NL} end), '') from (select line_no, regexp_extract_all(text, '(?is)<table[^>]*>.*?</table>') as t, regexp_split_to_array(text, '(?is)<table[^>]*>.*?</table>') as k from chunks where regexp_matches(text, '(?is)<table[^>]*>.*?</table>'))",
    "c22_tables": f"select line_no, case when contains(text, '[Table 1-1]') then replace(text, '[Table 1-1]', '| a |') else replace(text, '<!-- Page 1 -->', '<!-- Page 1 -->' || {_NL} || {_NL} || '### 表 1-1' || {_NL} || '| a |' || {_NL}) end as text from chunks",
    "c25_combined": f"""
with c as (select source_file, title, list_transform([title, short_title, pub_year::varchar, n_pages::varchar], lambda v: {_strip(f"replace(coalesce(v, ''), {_NL}, ' ')")}) as v from source_files),
e as (select source_file, array_to_string(list_filter([case when {_strip('title')} <> '' then title end, {_NL} || {_NL} || '| ' || v[1] || ' | ' || v[2] || ' |' || {_NL} || '| --- | --- |' || {_NL} || '| ' || v[3] || ' | ' || v[4] || ' |' || {_NL} || {_NL}], lambda p: p is not null), {_NL} || {_NL}) as x from c)
select source_file, {_LAYOUT} as text from e""",
    "s8_pages_joined": f"select line_no, array_to_string(list_filter(list_transform(string_split(text, {_NL} || {_NL}), lambda p, i: case when {_strip('p')} <> '' then '<!-- Page ' || i || ' -->' || {_NL} || p end), lambda p: p is not null), {_NL} || {_NL}) as text from chunks",
    "c13_blank_before_headings": _chunk(f"regexp_replace(x, '\\n(#+)', {_NL} || {_NL} || '\\1', 'g')"),
    "c14_headings": f"""select line_no, array_to_string(list_transform(string_split(text, {_NL}), lambda r: list_transform(list_transform([{_strip('r')}], lambda l: case {_HEAD['major']} else l end), lambda m: case {_HEAD['minor']} else m end)[1]), {_NL}) as text from chunks""",
    "c15_complete_sentence": f"select line_no, {_complete(20)} as complete, {_complete(50)} as no_fragment from (select line_no, coalesce(text, '') as t from chunks)",
    "c18_pages": "select line_no, try_cast(p[1] as int) as page_start, try_cast(p[-1] as int) as page_end from (select line_no, regexp_extract_all(text, '<!-- Page (\\d+) -->', 1) as p from chunks)",
    "c24_grid": """
with m as (select l_orderkey, max(l_linenumber)::int as n from lineitem group by l_orderkey),
r as (select l_orderkey, unnest(range(1, n + 1)) as i from m),
c as (select l_orderkey, l_linenumber as i, max((l_returnflag, l_linestatus)) as x from lineitem group by all),
l as (select l_orderkey, r.i, coalesce('| ' || x[1] || ' | ' || x[1] || ' | ' || x[2] || ' |', '|  |  |  |') as line from r left join c using (l_orderkey, i))
select l_orderkey, max(line) filter (i = 1) || chr(10) || '| --- | --- | --- |' || chr(10) || coalesce(string_agg(line, chr(10) order by i) filter (i > 1), '') as markdown from l group by l_orderkey""",
    "c26_two_columns": """
with b as (select user_id % 50 as page, ((value * 7 % 500) + (value * 7 % 500 + 60)) / 2 as c from events),
n as (select page, count(*) filter (c < 280 * 0.9) as l, count(*) filter (c > 280 * 1.1) as r from b group by page)
select page, l > 5 and r > 5 and abs(l - r) < 10 as two_column from n""",
    "q1_safe": f"select doc_id from documents where text is null or ({_SAFE})",
    "q2_near_pairs": f"""
with w as (select doc_id, list_sort(list_distinct(list_filter(regexp_split_to_array(text, {_re(chr(92) + 's+')}), lambda x: x <> ''))) as ws from documents where text is not null),
c as (select ws, min(doc_id) as id from w where len(ws) > 0 group by ws),
e as (select id, len(ws) as n, unnest(ws) as t from c),
k as (select a.id as a, b.id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as c from e a join e b on a.t = b.t and a.id < b.id group by a.id, b.id)
select a, b from k where c / (na + nb - c) > 0.85""",
    "q3_exact_first": "select min(doc_id) as doc_id from documents group by text",
    "d1_definitions_all": _DEFINED + " select pos, h || ': ' || d || chr(10) || chr(10) || h || 'とは、' || d || chr(10) || chr(10) || 'Q: ' || h || 'とは何ですか？' || chr(10) || 'A: ' || d as text from said",
    "d1_definitions_qa": _DEFINED + " select pos, 'Q: ' || h || 'とは何ですか？' || chr(10) || 'A: ' || d as text from said",
    "d2_surfaces": _SURFACES + " select surface, ord[1] as first_pos, pos as entry_pos, headword from full_surf",
    "d5_keywords": _FOUND + " select line_no, count(*)::int as keyword_count, string_agg(headword, '|' order by conf desc, rank) as terms from found group by line_no",
    "d6_keyword_texts": _FOUND + """,
parts as (select line_no, conf, rank, array_to_string(list_filter(['### ' || headword || case when len(coalesce(synonyms, [])) > 0 then '（別名: ' || array_to_string(synonyms, ', ') || '）' else '' end || chr(10),
  case when coalesce(domain, '') <> '' then '- **分野**: ' || domain || chr(10) end, case when coalesce(brief_definition, '') <> '' then '- **概要**: ' || brief_definition || chr(10) end,
  case when coalesce(definition, '') <> '' then '- **詳細**: ' || definition || chr(10) end, ''], lambda x: x is not null), chr(10)) as p from found)
select line_no, '## 専門用語解説' || chr(10) || chr(10) || string_agg(p, chr(10) order by conf desc, rank) as text from parts group by line_no""",
    "d7_found_terms": _FOUND + " select line_no, headword, rank::int as rank from found",
    "d8_patterns": _PATTERNS,
    "g2_edges": _EDGES,
    "g4_nodes": _NODES,
    "g6_first_nodes": f"select node, pos from ({_NODES}) order by pos limit 20",
    "d1_definitions_simple": _DEFINED + " select pos, h || ': ' || d as text from said",
    "d1_definitions_definition": _DEFINED + " select pos, h || 'とは、' || d as text from said",
    "d9_augmented": "select answer as text, 'elaboration' as augmentation_type, line_no as log, coalesce(source_id, '') as source_id from qa_pairs",
    "f3_conversations": f"select line_no, '<|begin_of_text|>' || '<|start_header_id|>system<|end_header_id|>' || chr(10) || chr(10) || {_q(prompts.SYSTEM['llama3_assistant'])} || '<|eot_id|>' || case when question is not null then '<|start_header_id|>user<|end_header_id|>' || chr(10) || chr(10) || question || '<|eot_id|>' else '' end || case when answer is not null then '<|start_header_id|>assistant<|end_header_id|>' || chr(10) || chr(10) || answer || '<|eot_id|>' else '' end as text from qa_pairs where question is not null or answer is not null",
    "g7_relation_texts": f"select node, {_strip(_measured('p', prompts.SYSTEM['graph_relations']))} as text, 'graph_relations' as source, relation_count from (select node, relation_count, {_render('graph_relations', node='node', relations_formatted='relations', max_chars=_q('100'))} as p from ({_NODES}))",
    "l1_paraphrased": _rewritten("paraphrase"),
    "l2_question_answers": f"select line_no, q as question, a as answer, {_PAIR('q', 'a')} as text, 'qa' as source from (select line_no, 'Q0 ' || length(p) as q, 'A0 0 ' || (length(p) % 7) as a from (select line_no, {_render('qa', context='text')} as p {_ASKED}))",
    "l3_summaries": _rewritten("summary", max_length="150"),
    "l4_keywords": f"select line_no, 'K' || n || ': D' || (n % 7) || chr(10) || 'M: 0' as text, 'keywords' as source from (select line_no, length({_render('keywords', text='text')}) as n {_ASKED})",
    "l5_elaborations": _rewritten("elaboration"),
    "l6_translations": _rewritten("translation", lang="英語"),
    "l7_focused": " union all ".join(f"select line_no, '{focus}' as focus, {_PAIR("'Q0 ' || n", "'A0 0 ' || (n % 7)")} as text from (select line_no, length({_render('specialized_qa', context='text', type_desc=_q(said))}) as n {_ASKED})" for focus, said in prompts.QA_FOCUS.items()),
    "l8_discussions": _rewritten("discussion", turns="3"),
    "l9_difficult": _FOUND + f""",
tops as (select line_no, string_agg('- ' || headword || ': ' || coalesce(brief_definition, ''), chr(10) order by rank) as shown from found where rank < 10 group by line_no),
asked as (select t.line_no, length({_render('qa_difficult', text='substr(c.text, 1, 2000)', terms_info='t.shown')}) as n from tops t join chunks c using (line_no)),
said as (select line_no, 'Q' || i || ' ' || n as question, 'A' || i || ' {len(prompts.SYSTEM['qa_difficult'])} ' || (n % 7) as answer from asked, (values (0), (1)) as v(i))
select line_no, question, answer, {_PAIR('question', 'answer', 'chr(10) || chr(10)')} as text, 'qa_difficult' as augmentation_type from said""",
    "l10_english": f"select line_no, coalesce({_measured('text', prompts.SYSTEM['english_translation'])}, text) as text, 'english' as source from chunks",
    "l14_descriptions": f"""
with s as (select line_no, case when line_no % 3 = 0 then 'TEXT_ONLY: ' || text else 'これは図表ではありません。' || text || {_NL} || {_NL} || {_NL} || {_NL} || '図表ではありません。' end as x from chunks),
r as (select line_no, x, replace(replace(replace(x, 'この画像は図表ではありません。', ''), 'これは図表ではありません。', ''), '図表ではありません。', '') as y from s)
select line_no, case when starts_with({_strip('x')}, 'TEXT_ONLY:') then {_strip('x')} else {_strip(f"regexp_replace(y, '\\n{{3,}}', {_NL} || {_NL}, 'g')")} end as text from r""",
    "l2_qa_texts": "select line_no, '質問: ' || question || chr(10) || '回答: ' || answer as text from qa_pairs",
    "l12_rendered": f"select line_no, {_render('summary', text='text', max_length=_q('150'))} as summary, {_render('specialized_qa', context='text', type_desc=_q(prompts.QA_FOCUS['numbers']))} as focus from chunks where text is not null",
    "l13_json_answers": "select line_no, question, answer from qa_pairs",
    "pk1_token_estimates": "select doc_id, length(text) * 3 // 2 as pack_tokens, length(text) // 2 as merge_tokens from documents",
    "pk3_packed": _PACKED,
    "pk4_pack_stats": f"with p as ({_PACKED}) select (select count(*) from chunks where coalesce(text, '') <> '') as texts, count(*) as packs, avg(tokens) as mean_tokens, (select count(*) from chunks where coalesce(text, '') <> '') / count(*) as ratio from p",
    "pk5_shuffled": "select doc_id, lang from documents",
    "f1_chat": f"select line_no, {_CHAT}{_TURN('user', f'''(case when {_strip("coalesce(array_to_string(related_terms, '、'), '')")} <> '' then question || chr(10) || chr(10) || '背景情報:' || chr(10) || array_to_string(related_terms, '、') else question end)''')}{_TURN('assistant', 'answer')} as text from qa_pairs",
    "f4_split": "select doc_id, case when row_number() over (order by md5(doc_id::varchar || ':42'), doc_id) <= ceil(0.1 * (select count(*) from documents)) then 'eval' else 'train' end as split from documents",
    "m1_merged": f"""
select step_rank, source, count(*) as n, sum(length(text)) as chars from (
  select 0 as step_rank, coalesce(source, 'extract') as source, text from documents union all select 1, 'dictionary', text from ({_PATTERNS}) union all select 2, 'extract', text from chunks) group by step_rank, source""",
    "m2_merge_stats": "select count(*) as records, sum(length(text)) as chars, sum(length(text)) // 2 as est_tokens from chunks",
    "m3_histogram": "select coalesce(source, 'unknown') as source, count(*) as n from documents group by 1",
    "v1_type": "select line_no, pair_id from qa_pairs where augmentation_type = 'qa_difficult'",
    "v2_search": "select line_no from qa_pairs where contains(lower(concat_ws(' ', question, answer, augmentation_type)), 'bearing')",
    "v3_metrics": "select count(*) as n_rows, count(distinct augmentation_type) as n_types, avg(length(answer)) as mean_chars from qa_pairs",
    "v4_head": "select line_no, pair_id from qa_pairs order by line_no limit 100",
    "v5_record": "select line_no, pair_id from qa_pairs order by line_no limit 1 offset 41",
    "v6_types": "select augmentation_type, min(line_no) as first from qa_pairs where augmentation_type is not null group by augmentation_type",
}
