"""The SQL of each core query for DuckDB, over the same Parquet tables."""

from __future__ import annotations

import re

from ..dictionaries import BOOK_ALIASES, CITED_BOOKS, CONTENTS_LABELS, CRITICAL_SECTIONS, LESSON_SECTIONS, MARKER_LABELS, NESTED_FIELDS, NUMBER_WORDS, PENALTIES, PROFILES, PUNCTUATION, REQUIRED_SECTIONS, ROOT_FIELDS, SECTION_LABELS, STANDALONE, STOP_LABELS
from ..functions.text import CITATION_ONLY, DATE, LINE_END, SPACE, WORD

ORACLES: dict[str, str] = {}
WS = f"[{SPACE}]"


def strip(x: str) -> str:
    return f"trim({x}, '{SPACE}')"


def rstrip(x: str) -> str:
    return f"rtrim({x}, '{SPACE}')"


def bare(x: str) -> str:
    return f"regexp_replace(strip_accents({x}), '\\p{{Mn}}', '', 'g')"


def fold(x: str) -> str:
    return strip(f"lower({bare(x)})")


def fold_label(x: str) -> str:
    return f"rtrim({strip(f"regexp_replace(lower({bare(x)}), '{WS}+', ' ', 'g')")}, ':')"


def slug(x: str) -> str:
    return f"translate(lower({x}), 'áéíóúüñ', 'aeiouun')"


def lines(x: str) -> str:
    parts = f"string_split_regex({x}, '{LINE_END}')"
    return f"(case when {x} is null or {x} = '' then []::varchar[] when {parts}[-1] = '' then {parts}[:-2] else {parts} end)"


def filled(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex({x}, '{LINE_END}'), lambda z: {strip('z')}), lambda z: z <> '')"


def any_start(x: str, labels) -> str:
    return "(" + " or ".join(f"starts_with({x}, '{v}')" for v in labels) + ")"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# A sign behind every character that is no word's part, so that a match can look behind without lookbehind.
MARK = "⟦"
_cited = "|".join(b.replace(" ", f"[ ]{MARK}") for b in CITED_BOOKS)
_w = f"(?:{WS}{MARK})"
MALFORMED = f"{MARK}(?:[1-3]{_w}*)?(?:{_cited}){_w}+\\d{{1,3}}{_w}*(?:[;.{SPACE}]{MARK}|:{MARK}[lIoO]){_w}*[lIoO0-9]{{1,3}}(?:{_w}*-{MARK}{_w}*[lIoO0-9]{{1,3}})?(?:[^\\p{{L}}\\p{{N}}_]|$)"
VALID = re.sub(r"([\[\]\-&\\^])", r"\\\1", PUNCTUATION).replace("'", "''")
WORD_ = WORD.replace("'", "''")

GATE = f"""
m as (select page_id, publication_id, page_number, source, ocr_confidence, text, {strip("coalesce(text, '')")} t from page_quality),
f as (select *, {filled("t")} fl from m),
g0 as (select *, len(regexp_extract_all(t, '{WORD_}'))::int words, length(t)::int n_chars,
  length(regexp_replace(t, '[^\\p{{L}}\\p{{N}}{VALID}{SPACE}]+', '', 'g'))::int n_valid, len(fl)::int n_lines,
  len(list_filter(fl, lambda z: length(z) > 160))::int n_long, (length(t) - length(replace(t, '�', '')))::int n_replacement,
  len(regexp_extract_all('{MARK}' || regexp_replace(t, '([^\\p{{L}}\\p{{N}}_])', '\\1{MARK}', 'g'), '{MALFORMED}', 0, 'i'))::int n_malformed,
  lower(source) not in ('pymupdf', 'embedded') is_ocr from f),
g1 as (select *, case when n_chars > 0 then n_valid / n_chars else 0.0 end vr, case when n_lines > 0 then n_long / n_lines else 0.0 end lr from g0),
g2 as (select *, list_filter([case when n_chars = 0 then 'zero_text' end, case when words < 25 then 'low_word_count' end,
  case when n_chars > 0 and vr < 0.85 then 'low_valid_char_ratio' end, case when n_replacement >= 1 then 'malformed_characters' end,
  case when lr > 0.25 then 'merged_lines' end, case when n_malformed > 0 then 'malformed_scripture_reference' end,
  case when ocr_confidence < 70 then 'low_ocr_confidence' end], lambda z: z is not null) issues,
  case when n_chars = 0 or words < 10 or vr < 0.85 or n_replacement >= 5 then case when is_ocr then 'NEEDS_HUMAN_REVIEW' else 'NEEDS_OCR' end
   when not is_ocr and lr > 0.5 then 'NEEDS_OCR' when n_malformed >= 3 then 'NEEDS_HUMAN_REVIEW'
   when is_ocr and ocr_confidence < 70 then 'NEEDS_HUMAN_REVIEW' when is_ocr and ocr_confidence < 85 then 'WARNING'
   when words < 25 or lr > 0.25 or n_malformed > 0 or n_replacement > 0 then 'WARNING' else 'PASS' end status from g1),
g as (select *, greatest(0, least(100, coalesce(round_even(ocr_confidence, 0)::int, 100) - {" - ".join(f"case when list_contains(issues, '{k}') then {v} else 0 end" for k, v in PENALTIES.items())},
  case status when 'NEEDS_OCR' then 49 when 'NEEDS_HUMAN_REVIEW' then 59 when 'WARNING' then 89 else 100 end))::int score from g2)
"""

ORACLES["page_metrics"] = f"with {GATE} select page_id, words, n_chars, n_valid, n_lines, n_long, n_replacement, n_malformed from g"
ORACLES["page_quality_gate"] = f"with {GATE} select page_id, array_to_string(issues, ',') issues, status, score, status = 'NEEDS_OCR' ocr_needed, case when status in ('PASS', 'WARNING') then source end selected_source from g"
ORACLES["stale_figures"] = f"with {GATE} select g.page_id, words::bigint words, n_malformed::bigint n_malformed, p.word_count::bigint stored_words, p.malformed_scripture_count::bigint stored_malformed from g join page_quality p on p.page_id = g.page_id where words is distinct from p.word_count or n_malformed is distinct from p.malformed_scripture_count"
ORACLES["page_log"] = f"""with {GATE} select page_id, publication_id, page_number, status quality_status, array_to_string(issues, ',') quality_issues, score confidence_score,
 round_even(vr, 4) valid_char_ratio, round_even(lr, 4) long_line_ratio, case when status in ('PASS', 'WARNING') then source end selected_source from g"""

_num = "regexp_replace(regexp_replace({0}, '(^|[^\\p{{L}}\\p{{N}}_])\\p{{Nd}}+([^\\p{{L}}\\p{{N}}_]|$)', '\\1#\\2', 'g'), '(^|[^\\p{{L}}\\p{{N}}_])\\p{{Nd}}+([^\\p{{L}}\\p{{N}}_]|$)', '\\1#\\2', 'g')"
EDGES = f"""
e0 as (select page_id, publication_id, page_number, {filled("text")} fl from page_quality where text is not null),
e1 as (select page_id, publication_id, page_number, unnest(case when len(fl) <= 6 then fl else list_concat(fl[1:3], fl[-3:]) end) line from e0),
e2 as (select distinct page_id, publication_id, page_number, {_num.format(f"regexp_replace(lower({strip('line')}), '{WS}+', ' ', 'g')")} as key from e1),
e as (select * from e2 where length(key) >= 5),
r as (select publication_id, key, count(distinct page_number) n_pages from e group by all having count(distinct page_number) >= 3)
"""
ORACLES["repeated_edge_lines"] = f"with {EDGES} select publication_id, key, n_pages from r"
ORACLES["gate_with_edges"] = f"""with {GATE}, {EDGES}, h as (select distinct page_id from e semi join r on e.publication_id = r.publication_id and e.key = r.key)
select g.page_id, array_to_string(case when h.page_id is null then issues else list_concat(issues, ['repeated_header_footer']) end, ',') issues,
 case when h.page_id is not null and status = 'PASS' then 'WARNING' else status end status, case when h.page_id is null then score else greatest(0, score - 10) end score from g left join h on g.page_id = h.page_id"""
ORACLES["best_source_selection"] = f"""with {GATE}, k as (select publication_id, page_number, is_ocr, max(page_id) page_id from g group by all),
a as (select g.* from g join k on g.page_id = k.page_id where not g.is_ocr), b as (select g.* from g join k on g.page_id = k.page_id where g.is_ocr),
j as (select a.publication_id, a.page_number, a.source sa, a.status ta, a.score ca, a.issues ia, a.words wa, b.source sb, b.status tb, b.score cb, b.issues ib, b.words wb,
 a.status in ('PASS', 'WARNING') oa, coalesce(b.status in ('PASS', 'WARNING'), false) ob from a left join b on a.publication_id = b.publication_id and a.page_number = b.page_number),
p as (select *, case when sb is null then 'a' when ob and (not oa or cb - ca > 5) then 'b' when oa then 'a' else 'n' end pick from j)
select publication_id, page_number, case pick when 'a' then sa when 'b' then sb else 'none' end source, case pick when 'a' then ta when 'b' then tb else 'NEEDS_HUMAN_REVIEW' end status,
 case pick when 'a' then ca when 'b' then cb else greatest(ca, cb) end score, case pick when 'a' then wa when 'b' then wb else greatest(wa, wb) end words,
 array_to_string(case pick when 'a' then ia when 'b' then ib else list_concat(ia, list_filter(ib, lambda z: not list_contains(ia, z))) end, ',') issues from p"""
ORACLES["issue_counts"] = f"with {GATE} select publication_id, issue, count(*) n from (select publication_id, unnest(issues) issue from g) group by all"
ORACLES["status_counts"] = f"select publication_id, case when {strip('status')} <> '' then status else 'UNKNOWN' end status, count(*) n from page_quality group by all"
ORACLES["waived_pages"] = "with x as (select page_id, publication_id, page_number, unnest(issues) issue from page_quality) select * from x where exists (select 1 from waivers w where w.publication_id = x.publication_id and w.pdf_page = x.page_number and w.issue_code = x.issue)"
ORACLES["unwaived_zero_text"] = f"with {GATE}, x as (select page_id, publication_id, page_number, 'zero_text' issue from g where list_contains(issues, 'zero_text')) select * from x where not exists (select 1 from waivers w where w.publication_id = x.publication_id and w.pdf_page = x.page_number and w.issue_code = x.issue)"


def _list(c: str) -> str:
    return f"coalesce(array_to_string(list_sort(list(distinct page_number) filter (where {c})), ','), '')"


ORACLES["publication_quality_report"] = f"""with {GATE}, w as (select distinct publication_id, pdf_page from waivers where issue_code = 'zero_text'),
p as (select g.*, w.pdf_page is not null waived from g left join w on g.publication_id = w.publication_id and g.page_number = w.pdf_page)
select publication_id, count(*) page_count, case when bool_or(status in ('NEEDS_HUMAN_REVIEW', 'NEEDS_OCR') or words = 0 and not waived) then 'BLOCKED' when bool_or(status = 'WARNING') then 'WARNING' else 'PASS' end status,
 count(*) filter (where status = 'PASS') n_pass, count(*) filter (where status = 'WARNING') n_warning, count(*) filter (where status = 'NEEDS_OCR') n_needs_ocr, count(*) filter (where status = 'NEEDS_HUMAN_REVIEW') n_review,
 count(*) filter (where words = 0) n_zero_text, count(*) filter (where words = 0 and waived) n_waived_zero_text, {_list("words = 0")} zero_text_pages, {_list("words > 0 and words < 25")} low_word_pages,
 {_list("status = 'NEEDS_OCR'")} needs_ocr_pages, {_list("status = 'NEEDS_HUMAN_REVIEW'")} review_pages, {_list("is_ocr")} ocr_pages from p group by publication_id"""
_weak, _review = "(not is_ocr and status = 'NEEDS_OCR')", "(status = 'NEEDS_HUMAN_REVIEW')"
ORACLES["extraction_summary"] = f"""with {GATE} select publication_id, {_list(_weak)} weak_direct_text_pages, {_list("is_ocr")} ocr_fallback_pages, count(distinct page_number) filter (where is_ocr) ocr_fallback_page_count,
 {_list(_review)} human_review_pages, count(distinct page_number) filter (where {_review}) human_review_page_count, bool_or({_weak} or {_review}) manual_review_required from g group by all"""
ORACLES["ocr_audit"] = f"""with {ORACLES["publication_quality_report"].removeprefix("with ").replace("select publication_id, count(*) page_count", ", rep as (select publication_id, count(*) page_count", 1)}),
ic as (select publication_id, array_to_string(list_sort(list(issue || '=' || n)), ',') issue_counts from (select publication_id, issue, count(*) n from (select publication_id, unnest(issues) issue from g) group by all) group by 1)
select rep.publication_id source, status, page_count, coalesce(issue_counts, '') issue_counts from rep left join ic on ic.publication_id = rep.publication_id"""

ORACLES["fold_text"] = f"select segment_id, {fold('expected_title')} folded, {fold_label('expected_title')} as label, {slug('expected_title')} slug from lesson_segments where expected_title is not null"
TIDY = f"array_to_string(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), '\r\n?', '\n', 'g'), '([\\p{{L}}\\p{{N}}_])-\n([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g'), '[ \t]+', ' ', 'g'), '\n'), lambda z: {rstrip('z')}), '\n')"
ORACLES["tidy_text"] = f"select page_id, md5({TIDY}) digest, length({TIDY})::int n_chars from page_quality where text is not null"

PAGES = f"""
lp as (select publication_id, page_number, arg_max(coalesce(text, '\x01'), page_id) text from page_quality group by all),
pl0 as (select publication_id, page_number, list_concat(['===== PDF_PAGE ' || page_number || ' ====='], {lines("nullif(text, '\x01')")}) ls from lp),
pl1 as (select publication_id, ls, coalesce(sum(len(ls)) over (partition by publication_id order by page_number rows between unbounded preceding and 1 preceding), 0) before from pl0),
ln as (select publication_id, (before + i)::int line_number, ls[i] line from (select publication_id, before, ls, unnest(range(1, len(ls) + 1)) i from pl1))
"""
MARKER = "^===== PDF_PAGE (\\d+) =====$"
_struct = [MARKER, "(?i)^LECCI[OÓ]N\\s+\\d+([^\\p{L}\\p{N}_]|$)", "(?i)^[IVXLCDM]+\\.\\s+", "^[A-Z]\\.\\s+", "^\\d{1,3}\\.\\s+", DATE, "^\\d{1,4}$", "^¿", "(?i)^(?:Expositor|Guía del Maestro|TRIMESTRE)([^\\p{L}\\p{N}_]|$)"]


def citation_only(s: str) -> str:
    return f"(length({s}) <= 80 and regexp_matches({s}, '{CITATION_ONLY}'))"


def is_label(s: str) -> str:
    return any_start(f"rtrim({fold(s)}, ':')", SECTION_LABELS)


def structural(s: str) -> str:
    return "(" + " or ".join([f"{s} = ''", *[f"regexp_matches({s}, '{p}')" for p in _struct], is_label(s), f"{fold(s)} in ({quoted(STANDALONE)})", citation_only(s)]) + ")"


ORACLES["structural_line_flags"] = f"with {PAGES}, s as (select *, {strip('line')} s from ln) select publication_id, line_number, {structural('s')} structural, {citation_only('s')} citation_only, {is_label('line')} as label from s"


def reflowed(split: str, source: str) -> str:
    """CTEs up to `pp` (page_id, paragraph, first_line, text) of the texts of a source (page_id, text) split into lines."""
    return f"""ra as (select page_id, {split} ls from {source}), rb as (select page_id, i::int line_number, {strip('ls[i]')} s from (select page_id, ls, unnest(range(1, len(ls) + 1)) i from ra)),
rc as (select *, {structural('s')} stands from rb), rd_ as (select *, case when stands or coalesce(lag(stands) over w, true) then 1 else 0 end br from rc window w as (partition by page_id order by line_number)),
re_ as (select *, sum(br) over (partition by page_id order by line_number)::bigint paragraph from rd_),
pp as (select page_id, paragraph, min(line_number) first_line, string_agg(case when stands then s else regexp_replace(s, '{WS}+', ' ', 'g') end, ' ' order by line_number) as text from re_ group by page_id, paragraph)"""


ORACLES["reflow_paragraphs"] = f"with t as (select page_id, text from page_quality where text is not null), {reflowed(lines('text'), 't')} select page_id, paragraph, first_line, text from pp where text <> ''"
LATEST = "lx as (select p.* from page_quality p join (select publication_id, page_number, max(page_id) page_id from page_quality group by all) k on p.page_id = k.page_id)"
NORMAL = f"{LATEST}, t as (select page_id, text from lx where text is not null), {reflowed(f"string_split({TIDY}, chr(10))", 't')}, nt0 as (select page_id, {strip("string_agg(text, chr(10) order by paragraph)")} as text from pp group by 1), nt as (select page_id, case when text = '' then '' else text || chr(10) end as text from nt0)"
ORACLES["normalized_text"] = f"with {NORMAL} select page_id, md5(text) digest, length(text)::int n_chars from nt"
ORACLES["output_sizes"] = f"with {NORMAL} select 'raw_text' part, count(*) n, coalesce(sum(strlen(text)), 0)::bigint bytes from lx union all select 'normalized_text', (select count(*) from lx), coalesce(sum(strlen(text)), 0)::bigint from nt union all select 'documents', count(*), coalesce(sum(strlen(text)), 0)::bigint from documents"

_b, _e = "(?:^|[^\\p{L}\\p{N}_])", "(?:[^\\p{L}\\p{N}_]|$)"


def _vol(p: str) -> str:
    return f"nullif(regexp_extract(t, '{_b}{p}{_e}', 1), '')"


ORACLES["rename_proposals"] = f"""with {LATEST}, a0 as (select publication_id, string_agg(coalesce(text, ''), chr(10) order by page_number) as text from lx where page_number <= 5 group by 1),
a as (select distinct p.publication_id, a0.text from page_quality p left join a0 on a0.publication_id = p.publication_id),
b as (select publication_id stem, {slug("concat_ws(chr(10), publication_id, text)")} t from a),
c as (select *, coalesce({_vol('vol(?:umen)?\\.?\\s*(?:no\\.?\\s*)?(\\d{1,3})')}::int, {_vol('volume\\s*(?:no\\.?\\s*)?(\\d{1,3})')}::int, {_vol('lecc(?:ion|iones)?\\s*(\\d{1,3})')}::int, {_vol('lecc(\\d{1,3})')}::int,
 case regexp_extract(t, '{_b}vol(?:umen)?\\s+([a-z]+){_e}', 1) {" ".join(f"when '{k}' then {v}" for k, v in NUMBER_WORDS.items())} end) volume from b),
d as (select stem, volume, case when volume is null then 'expositor-guia-maestro-' || stem || '.pdf' else format('expositor-guia-maestro-volumen-{{:02d}}.pdf', volume) end target,
 case when t like '%expositor%' and t like '%maestro%' then 'matched publication and family' when t like '%maestro%' then 'matched family; used default' else 'used default' end || case when volume is null then '; volume number not found' else '; volume ' || volume || ' found' end reason from c)
select *, count(*) over (partition by target) n_same_target from d"""


def family(x: str) -> str:
    return f"(case when lower({x}) like '%maestro%' then 'maestro' when lower({x}) like '%alumno%' then 'alumno' else 'unclassified' end)"


VERSION = f"(case {family('publication_id')} {' '.join(f"when '{k}' then '{v['version']}'" for k, v in PROFILES.items())} end)"
ORACLES["classify_publications"] = f"select distinct publication_id, {family('publication_id')} classification, {family('publication_id')} profile_id, {VERSION} profile_version from page_quality"
ORACLES["normalized_by_family"] = f"with {PAGES} select {family('publication_id')} family, count(*) n_texts, coalesce(sum(length(nullif(text, '\x01'))), 0)::bigint n_chars from lp group by 1"

ACTIVE = "select *, last_value(nullif(regexp_extract(" + strip("line") + f", '{MARKER}', 1), '')::int ignore nulls) over (partition by publication_id order by line_number) active_page, nullif(regexp_extract(" + strip("line") + f", '{MARKER}', 1), '') is not null is_marker from "
ORACLES["active_page"] = f"with {PAGES}, x as ({ACTIVE} ln) select publication_id, active_page, min(line_number) first_line, count(*) n_lines from x group by all"
HEADER = "^\\s*LECCI[OÓ]N\\s+(\\d+)(?:[^\\p{L}\\p{N}_]|$)"


def marks(src: str) -> str:
    return f"""(select publication_id, line_number, marker_type, {strip('line')} as text from (select *, case when active_page is not null and active_page is distinct from lag(active_page) over (partition by publication_id order by line_number) then 'page_marker'
 when regexp_matches(line, '{HEADER}', 'i') then 'lesson_header' when {any_start(fold('line'), MARKER_LABELS)} then 'section_label' end marker_type from ({ACTIVE} {src})) where marker_type is not null)"""


ORACLES["structure_markers"] = f"with {PAGES} select * from {marks('ln')}"

LESSONS = """
s0 as (select publication_id, lesson_number, max(segment_id) segment_id from lesson_segments group by all),
s1 as (select s.publication_id, s.lesson_number, s.expected_title, s.page_start, s.lesson_date from lesson_segments s join s0 on s.segment_id = s0.segment_id),
r0 as (select publication_id, lesson_number, max(reading_id) filter (where reference_display is not null) reading_id, max(reading_id) last_id from biblical_readings group by all),
r1 as (select r0.publication_id, r0.lesson_number, b.reference_display from r0 left join biblical_readings b on b.reading_id = r0.reading_id),
le as (select s1.*, r1.reference_display from s1 left join r1 on s1.publication_id = r1.publication_id and s1.lesson_number = r1.lesson_number)
"""
SOURCE = f"""{LESSONS},
src0 as (select distinct publication_id, 0 block, 0 lesson_number, ['===== PDF_PAGE 1 =====', 'CONTENIDO'] ls from le
 union all select publication_id, 1, lesson_number, [lesson_date, lesson_number || '. ' || coalesce(expected_title, 'Sin título'), '..... ' || coalesce(page_start::varchar, '7')] from le
 union all select publication_id, 2, lesson_number, ['===== PDF_PAGE ' || (lesson_number * 4) || ' =====', 'LECCIÓN ' || lesson_number, coalesce(expected_title, 'Sin título'), 'Lectura Bíblica: ' || reference_display, 'Bosquejo de la lección',
  'I. ' || coalesce(expected_title, 'Sin título'), 'A. primer punto', '(' || reference_display || ')', 'sigue el punto', '12', 'Notas para el maestro: lea con la clase', 'el pasaje de hoy.', '¿' || coalesce(expected_title, 'Sin título') || '?', 'Maestro',
  'repase la lección anterior', 'y ore.', 'Resumen y aplicación práctica: viva', 'lo aprendido.', 'Lecturas diarias'] from le),
src1 as (select publication_id, block, lesson_number, i, ls[i] line from (select *, unnest(range(1, len(ls) + 1)) i from src0) where ls[i] is not null),
src as (select publication_id, row_number() over (partition by publication_id order by block, lesson_number, i)::int line_number, line from src1)
"""
ENTRY = "^(\\d{1,3})\\.\\s*(.+)$"
CAND = f"""
ac as ({ACTIVE} src),
cd0 as (select publication_id, active_page page, bool_or({fold('line')} in ({quoted(CONTENTS_LABELS)})) labelled, sum(case when {strip('line')} <> '' and (regexp_matches({strip('line')}, '{DATE}') or regexp_matches({strip('line')}, '{ENTRY}')) then 1 else 0 end)::bigint signals
 from ac where active_page is not null and not is_marker group by all),
cd as (select publication_id, page, signals, row_number() over (partition by publication_id order by signals desc, page) rank from cd0 where labelled)
"""
ORACLES["composed_contents_candidates"] = f"with {SOURCE}, {CAND} select publication_id, page, signals, rank from cd"
ORACLES["contents_candidates"] = f"with {PAGES}, src as (select * from ln), {CAND} select publication_id, page, signals, rank from cd"
_clean = f"trim(regexp_replace(regexp_replace(regexp_extract(said, '^(.*?)(\\d{{1,4}})\\s*$', 1), '\\.{{2,}}', ' ', 'g'), '{WS}+', ' ', 'g'), ' .')"
CONTENTS = f"""{SOURCE}, {CAND},
c0 as (select ac.publication_id, active_page, rank, line_number, {strip('line')} s from ac join cd on ac.publication_id = cd.publication_id and active_page = page where not is_marker),
c1 as (select *, regexp_matches(s, '{DATE}') is_date, not regexp_matches(s, '{DATE}') and regexp_matches(s, '{ENTRY}') is_start from c0 where s <> '' and {fold('s')} not in ({quoted(CONTENTS_LABELS)})),
c2 as (select *, sum(is_start::int) over (partition by publication_id, active_page order by line_number) entry from c1),
c3 as (select *, string_agg(case when is_start then regexp_extract(s, '{ENTRY}', 2) when not is_date then s end, ' ') over (partition by publication_id, active_page, entry order by line_number rows between unbounded preceding and current row) said,
 max(case when is_start then regexp_extract(s, '{ENTRY}', 1) end) over (partition by publication_id, active_page, entry) number from c2),
c4 as (select *, {_clean} title, entry > 0 and not is_date and regexp_matches(said, '^(.*?)(\\d{{1,4}})\\s*$') and {_clean} <> '' done from c3),
c5 as (select *, done and line_number = min(case when done then line_number end) over (partition by publication_id, active_page, entry) completes from c4),
c6 as (select *, max(case when is_date then line_number end) over (partition by publication_id, active_page order by line_number) dl, max(case when completes then line_number end) over (partition by publication_id, active_page order by line_number rows between unbounded preceding and 1 preceding) pl from c5),
c7 as (select a.*, case when a.pl is null or a.dl > a.pl then b.s end lesson_date from c6 a left join c6 b on a.publication_id = b.publication_id and a.active_page = b.active_page and b.line_number = a.dl where a.completes),
co as (select publication_id, active_page contents_page, line_number, number::int lesson_number, title, regexp_extract(said, '^(.*?)(\\d{{1,4}})\\s*$', 2)::int page_start, lesson_date from c7 qualify rank = min(rank) over (partition by publication_id))
"""
ORACLES["composed_contents_entries"] = f"with {CONTENTS} select * from co"


def cut(src: str) -> str:
    """CTEs up to `sg`, the segments, from contents (`co`) and the lines of `src`."""
    return f"""mk as {marks(src)},
pg as (select publication_id, regexp_extract(text, 'PDF_PAGE\\s+(\\d+)', 1)::int page, max(line_number) line_number from mk where marker_type = 'page_marker' group by all),
tt as (select a.publication_id, a.total_lines, b.total_pages from (select publication_id, max(line_number) total_lines from {src} group by 1) a left join (select publication_id, max(page) total_pages from pg group by 1) b on a.publication_id = b.publication_id),
sg0 as (select co.*, lead(page_start) over (partition by publication_id order by line_number) nxt from co),
sg1 as (select sg0.*, tt.total_lines, case when nxt is not null then greatest(page_start, nxt - 1) else tt.total_pages end page_end from sg0 left join tt on sg0.publication_id = tt.publication_id),
sg as (select x.publication_id, lesson_number, coalesce(a.line_number, 0) start_line, 'Contenido' marker, case when b.line_number is not null then greatest(0, b.line_number - 1) else total_lines end end_line, page_start, page_end, title expected_title, page_start expected_page_start, lesson_date
 from sg1 x left join pg a on a.publication_id = x.publication_id and a.page = x.page_start left join pg b on b.publication_id = x.publication_id and b.page = x.page_end + 1
 union all select publication_id, regexp_extract(text, '(\\d+)', 1)::int, line_number, text, null, null, null, null, null, null from mk where marker_type = 'lesson_header' and publication_id not in (select publication_id from co))
"""


REAL = f"{PAGES}, {LESSONS}, co as (select publication_id, null::int contents_page, lesson_number line_number, lesson_number, expected_title title, page_start, lesson_date from s1 where page_start is not null), {cut('ln')}"
ORACLES["composed_lesson_segments"] = f"with {CONTENTS}, {cut('src')} select * from sg"
ORACLES["lesson_segments"] = f"with {REAL} select * from sg"
HEADERS = f"{PAGES}, hm as {marks('ln')}, hd as (select publication_id, try_cast(regexp_extract(text, '(\\d+)', 1) as int) lesson_number, line_number start_line, text marker from hm where marker_type = 'lesson_header' and try_cast(regexp_extract(text, '(\\d+)', 1) as int) is not null), ob as (select publication_id, lesson_number, array_to_string(list_sort(list(start_line)), ',') header_lines, count(*) n from hd group by 1, 2)"
ORACLES["header_fallback_segments"] = f"with {HEADERS} select * from hd"
ORACLES["duplicate_headers"] = f"with {HEADERS} select * from ob where n > 1"
_nums = "array_to_string(list_sort(list(distinct lesson_number)), ',') lesson_numbers"
_observed = "hd as (select publication_id, try_cast(regexp_extract(text, '(\\d+)', 1) as int) lesson_number, line_number start_line, text marker from mk where marker_type = 'lesson_header' and try_cast(regexp_extract(text, '(\\d+)', 1) as int) is not null), ob as (select publication_id, lesson_number, array_to_string(list_sort(list(start_line)), ',') header_lines, count(*) n from hd group by 1, 2)"
MESSAGES = f"""{REAL}, {_observed}, pubs as (select distinct publication_id from page_quality), ms as (
select publication_id, 'warning' severity, 'CONTENT_INDEX_MISSING' code, '' lesson_numbers from pubs where publication_id not in (select publication_id from co)
union all select publication_id, 'warning', 'LESSON_HEADERS_MISSING_FOR_CONTENT_INDEX', {_nums} from (select distinct publication_id, lesson_number from sg) x where not exists (select 1 from ob where ob.publication_id = x.publication_id and ob.lesson_number = x.lesson_number) group by 1
union all select publication_id, 'warning', 'UNEXPECTED_LESSON_HEADERS', {_nums} from ob x where not exists (select 1 from sg where sg.publication_id = x.publication_id and sg.lesson_number = x.lesson_number) group by 1
union all select publication_id, 'warning', 'DUPLICATE_OBSERVED_LESSON_HEADERS', {_nums} from ob where n > 1 group by 1
union all select publication_id, 'error', 'DUPLICATE_CONTENT_INDEX_LESSON_NUMBERS', {_nums} from (select publication_id, lesson_number from co group by all having count(*) > 1) group by 1
union all select publication_id, 'error', 'DUPLICATE_SEGMENT_LESSON_NUMBERS', {_nums} from (select publication_id, lesson_number from sg group by all having count(*) > 1) group by 1
union all select publication_id, 'error', 'NO_LESSON_SEGMENTS_CREATED', '' from pubs where publication_id not in (select publication_id from sg))"""
ORACLES["segment_validation"] = f"with {MESSAGES} select * from ms"
ORACLES["segment_status"] = f"""with {MESSAGES}, c as (select p.publication_id, count(*) filter (where severity = 'error') n_errors, count(*) filter (where severity = 'warning') n_warnings from pubs p left join ms on ms.publication_id = p.publication_id group by 1)
select *, case when n_errors > 0 then 'error' when n_warnings > 0 then 'warning' else 'pass' end status from c"""

PROFILE_SECTIONS = "(values " + ", ".join(f"('{k}', '{s}', [{quoted(a)}])" for k, v in PROFILES.items() for s, a in v["sections"].items()) + ") ps(profile_id, section, aliases)"


def labelled(src: str) -> str:
    """CTEs up to `af`, the lines of each segment (`hs`) with each section it has a label of."""
    return f"""
bd as (select a.publication_id, lesson_number, start_line, line_number, line, active_page, {strip('line')} s, {fold_label('line')} folded from ({ACTIVE} {src}) a join hs on hs.publication_id = a.publication_id and line_number between greatest(start_line, 1) and coalesce(end_line, 2147483647)),
lb as (select publication_id, lesson_number, start_line, section, min(line_number) label_line from bd join {PROFILE_SECTIONS} on ps.profile_id = {family('publication_id')} where len(list_filter(aliases, lambda z: contains(folded, z))) > 0 group by all),
af as (select bd.*, lb.section, lb.label_line from bd join lb on bd.publication_id = lb.publication_id and bd.lesson_number = lb.lesson_number and bd.start_line = lb.start_line)
"""


_reading = strip("regexp_extract(s, '(?i)(?:^|.*?[^\\p{L}\\p{N}_])Lectura\\s+B[ií]blica:\\s*(.+)', 1)")
READINGS = f"br as (select publication_id, lesson_number, start_line, line_number, {_reading} reference_display from af where section = 'biblical_reading' and line_number = label_line and {_reading} <> '')"
_isstop = f"({any_start('folded', STOP_LABELS)} or contains(folded, 'vocabulario') or contains(folded, 'aplicacion del maestro'))"
_sum = "(?:iv\\.\\s*)?resumen(?: y aplicaci[oó]n pr[aá]ctica)?:?"
BLOCKS = f"""
k0 as (select *, {_isstop} and not regexp_matches(s, '{MARKER}') stop from af where section not in ('biblical_reading', 'lesson_outline')),
k1 as (select publication_id, lesson_number, start_line, section, label_line, line_number, active_page, {strip(f"case when section = 'summary_application' then string_split_regex(s, '(?i){_sum}')[2] when contains(s, ':') then s[strpos(s, ':') + 1:] end")} as text from k0 where line_number = label_line),
k2 as (select *, min(case when stop and line_number > label_line then line_number end) over (partition by publication_id, lesson_number, start_line, section) stop_line from k0),
bk as (select * from k1 where text <> '' union all select publication_id, lesson_number, start_line, section, label_line, line_number, active_page, s from k2 where line_number > label_line and s <> '' and (stop_line is null or line_number < stop_line)
 and not regexp_matches(s, '{MARKER}') and not regexp_matches(s, '^\\d{{1,4}}$') and folded not in ('maestro', 'alumno'))
"""
_out = "(?i)^(?:[IVXLCDM]+\\.|[A-Z]\\.)\\s+"
_part = "partition by publication_id, lesson_number, start_line, section order by line_number"
OUTLINES = f"""
o0 as (select *, regexp_matches(s, '{MARKER}') is_m, regexp_matches(s, '^\\d{{1,4}}$') or folded in ('maestro', 'alumno') skip, contains(folded, 'resumen') and contains(folded, 'aplicacion') or {any_start('folded', [x for x in STOP_LABELS if x != 'resumen y aplicacion practica'])} hard from af where section = 'lesson_outline' and line_number > label_line and s <> ''),
o1 as (select *, not is_m and not hard and not skip and regexp_matches(s, '{_out}') item from o0),
o2 as (select *, coalesce(bool_or(item) over ({_part} rows between unbounded preceding and 1 preceding), false) seen, coalesce(bool_or(item and {any_start('lower(s)', ('iv. resumen', 'resumen y aplicacion'))}) over ({_part} rows between unbounded preceding and 1 preceding), false) closed from o1),
o3 as (select *, bool_or(hard and not is_m or seen and is_m or seen and not item and not skip and length(s) >= 120) over ({_part}) ended from o2),
ol as (select publication_id, lesson_number, start_line, section, label_line, line_number, active_page, s as text from o3 where not ended and not closed and not is_m and not skip and (item or seen))
"""
MERGED = f"""p0 as (select *, regexp_matches(text, '{_out}') or regexp_matches(text, '^\\(.+\\)$') or {fold_label('text')} in ('maestro', 'alumno') st from bk),
p1 as (select *, lag(text) over w pt, lag(st) over w pst from p0 window w as ({_part})),
p2 as (select *, case when pt is not null and not regexp_matches(pt, '[.?!:;)\\]]$') and not pst and not st and regexp_matches(text, '^\\p{{Ll}}') then 0 else 1 end starts from p1),
p3 as (select *, sum(starts) over ({_part})::bigint item_no from p2), mp as (select publication_id, lesson_number, start_line, section, item_no, string_agg(text, ' ' order by line_number) as text from p3 group by all)"""
TRACES = "tr as (select publication_id, lesson_number, start_line, section, min(label_line) line_start, max(line_number) line_end, arg_min(active_page, line_number) page_start, arg_max(active_page, line_number) page_end from (select * from bk union all select * from ol) group by all)"
COMPOSED_SECTIONS = f"{SOURCE}, mk as {marks('src')}, hs as (select publication_id, regexp_extract(text, '(\\d+)', 1)::int lesson_number, line_number start_line, line_number + 17 end_line from mk where marker_type = 'lesson_header'), {labelled('src')}"
REAL_SECTIONS = f"{REAL}, hs as (select * from sg), {labelled('ln')}"
for _prefix, _base in (("", REAL_SECTIONS), ("composed_", COMPOSED_SECTIONS)):
    ORACLES[f"{_prefix}section_labels"] = f"with {_base} select * from lb"
    ORACLES[f"{_prefix}biblical_reading"] = f"with {_base}, {READINGS} select * from br"
    ORACLES[f"{_prefix}section_blocks"] = f"with {_base}, {BLOCKS} select publication_id, lesson_number, start_line, section, line_number, text from bk"
    ORACLES[f"{_prefix}outline_blocks"] = f"with {_base}, {OUTLINES} select publication_id, lesson_number, start_line, section, line_number, text from ol"
    ORACLES[f"{_prefix}merged_prose"] = f"with {_base}, {BLOCKS}, {MERGED} select * from mp"
    ORACLES[f"{_prefix}section_traces"] = f"with {_base}, {BLOCKS}, {OUTLINES}, {TRACES} select * from tr"
ALL_SECTIONS = f"{REAL_SECTIONS}, {READINGS}, {BLOCKS}, {OUTLINES}, {MERGED}, {TRACES}"

_name = "[A-Za-zÁÉÍÓÚÜÑáéíóúüñ]+"
_verses = "\\d+(?:-\\d+)?(?:\\s*,\\s*\\d+(?:-\\d+)?)*"
_cit = f"((?:(?:[123]|I{{1,3}})\\s*)?{_name}(?:\\s+{_name})*)\\s+(\\d+):({_verses})"
_con = f"(\\d+):({_verses})"
PARTS = f"""
bo0 as (select {strip(f"regexp_replace(lower({bare('book_name')}), '{WS}+', ' ', 'g')")} alias, testament, book_standardized from bible_books),
bo as (select * from bo0 {" ".join(f"union all select '{a}', testament, book_standardized from bo0 where alias = '{b}'" for a, b in BOOK_ALIASES.items())}),
q0 as (select reading_id, i - 1 part_no, {strip(f"trim({strip('ps[i]')}, '.')")} part from (select reading_id, ps, unnest(range(1, len(ps) + 1)) i from (select reading_id, string_split(reference_display, ';') ps from biblical_readings where reference_display is not null))),
q1 as (select *, nullif(regexp_extract(part, '{_cit}', 1), '') book, {strip(f"regexp_replace(lower({bare(f"regexp_extract(part, '{_cit}', 1)")}), '{WS}+', ' ', 'g')")} al from q0 where part <> ''),
q2 as (select *, regexp_replace(regexp_replace(regexp_replace(al, '^iii( |$)', '3\\1'), '^ii( |$)', '2\\1'), '^i( |$)', '1\\1') alias from q1),
q3 as (select q2.*, case when book is not null then coalesce(bo.book_standardized, '?') end said, case when book is not null then coalesce(bo.testament, '?') end tst from q2 left join bo on bo.alias = q2.alias),
q as (select reading_id, part_no, part, last_value(said ignore nulls) over w cur, last_value(tst ignore nulls) over w testament, case when book is not null then regexp_extract(part, '{_cit}', 2) else regexp_extract(part, '{_con}', 1) end chapter,
 case when book is not null then regexp_extract(part, '{_cit}', 3) else regexp_extract(part, '{_con}', 2) end verses from q3 window w as (partition by reading_id order by part_no))
"""
RANGES = "v as (select *, i - 1 pos, trim(string_split(vs[i], '-')[1])::int verse_start, trim(string_split(vs[i], '-')[-1])::int verse_end from (select *, unnest(range(1, len(vs) + 1)) i from (select *, string_split_regex(verses, '\\s*,\\s*') vs from q where verses <> '')))"
ORACLES["parsed_references"] = f"with {PARTS}, {RANGES} select reading_id, row_number() over (partition by reading_id order by part_no, pos) ref_no, testament, cur book_standardized, chapter::int chapter, verse_start, verse_end from v where cur is not null and cur <> '?'"
ORACLES["unresolved_references"] = f"with {PARTS} select reading_id, part_no, part from q where chapter = '' or cur is null or cur = '?'"
ORACLES["verse_ranges"] = f"with {PARTS}, {RANGES} select reading_id, part_no, pos, verse_start, verse_end from v"

_tbd = "[{'testament': 'TBD', 'book_standardized': 'TBD', 'chapter': 0, 'verse_start': 0, 'verse_end': 0}]"
DRAFTS = f"""{LESSONS},
rd as (select r0.publication_id, r0.lesson_number, b.reference_display, b.canonical_references from r0 join biblical_readings b on b.reading_id = r0.last_id),
yr as (select publication_id, case when bool_or(coalesce(ends_with(lesson_date, '/24'), false)) then 2024 else 2024 end as year from s1 group by 1),
d0 as (select s1.*, rd.reference_display, rd.canonical_references, yr.year, lead(page_start) over (partition by s1.publication_id order by s1.lesson_number) nxt from s1 left join rd on rd.publication_id = s1.publication_id and rd.lesson_number = s1.lesson_number join yr on yr.publication_id = s1.publication_id),
d1 as (select *, coalesce(nullif(page_start, 0), 0) ps, coalesce(expected_title, '') et from d0),
dr as (select publication_id, lesson_number, format('LES-{{}}-C1-{{:03d}}', year, lesson_number) lesson_id, year, coalesce(nullif(expected_title, ''), 'Lesson ' || lesson_number) title, ps page_start, greatest(ps, coalesce(nxt, ps + 1) - 1) page_end,
 coalesce(nullif({strip('reference_display')}, ''), 'TBD') reference_display, case when len(canonical_references) > 0 then canonical_references else {_tbd} end refs,
 ['I. ' || et, 'A. punto', '(Juan 3:16)'] outline_, list_filter([{strip('et')}, '¿' || et || '?'], lambda z: z <> '') notes, ['TBD'] summary, coalesce(lesson_date, 'TBD') lesson_date, page_start trace_page from d1)
"""
NO_FILE = "pending-source-file-verification"
ORACLES["composed_draft_lessons"] = f"with {DRAFTS} select publication_id, lesson_number, lesson_id, year, title, page_start, page_end, reference_display, len(refs)::int n_references, array_to_string(notes, '|') teacher_notes, md5('TBD') summary_digest, 1 summary_items, null::int summary_line, null::int summary_end, 'automated_unreviewed' review_status, '{NO_FILE}' sha256 from dr"
REAL_DRAFTS = f"""{ALL_SECTIONS},
it_ as (select publication_id, lesson_number, section, item_no, text from mp union all select publication_id, lesson_number, section, row_number() over ({_part}), text from ol),
li as (select publication_id, lesson_number, section, list(text order by item_no) items from it_ group by 1, 2, 3),
rl as (select r0.publication_id, r0.lesson_number, b.reference_display, b.canonical_references from r0 join biblical_readings b on b.reading_id = r0.last_id),
x0 as (select sg.*, rl.reference_display, rl.canonical_references, coalesce(nullif(page_start, 0), nullif(expected_page_start, 0), 0) ps, lead(expected_page_start) over (partition by sg.publication_id order by sg.lesson_number, start_line) nxt from sg left join rl on rl.publication_id = sg.publication_id and rl.lesson_number = sg.lesson_number),
x1 as (select x0.*, o.items oi, n.items ni, u.items ui, t.line_start tl, t.line_end te from x0 left join li o on o.publication_id = x0.publication_id and o.lesson_number = x0.lesson_number and o.section = 'lesson_outline'
 left join li n on n.publication_id = x0.publication_id and n.lesson_number = x0.lesson_number and n.section = 'teacher_notes' left join li u on u.publication_id = x0.publication_id and u.lesson_number = x0.lesson_number and u.section = 'summary_application'
 left join tr t on t.publication_id = x0.publication_id and t.lesson_number = x0.lesson_number and t.section = 'summary_application'),
rdr as (select publication_id, lesson_number, format('LES-2024-C1-{{:03d}}', lesson_number) lesson_id, 2024 as year, coalesce(nullif(expected_title, ''), 'Lesson ' || lesson_number) title, ps page_start, coalesce(nullif(page_end, 0), greatest(ps, coalesce(nxt, ps + 1) - 1)) page_end,
 coalesce(nullif({strip('reference_display')}, ''), 'TBD') reference_display, case when len(canonical_references) > 0 then canonical_references else {_tbd} end refs, coalesce(oi, ['TBD']) outline_, coalesce(ni, ['TBD']) notes, coalesce(ui, ['TBD']) summary, tl, te,
 case when reference_display is not null or oi is not null or ni is not null or ui is not null then 'automated_unreviewed' else 'pending' end review_status from x1)
"""
ORACLES["draft_lessons"] = f"with {REAL_DRAFTS} select publication_id, lesson_number, lesson_id, year, title, page_start, page_end, reference_display, len(refs)::int n_references, array_to_string(notes, '|') teacher_notes, md5(array_to_string(summary, '|')) summary_digest, len(summary)::int summary_items, tl summary_line, te summary_end, review_status, '{NO_FILE}' sha256 from rdr"
_paths = [("root", f) for f in ROOT_FIELDS] + [("nested", f"{p}.{f}") for p, fs in NESTED_FIELDS.items() for f in fs] + [("section", f"lesson_sections.{n}.{f}") for n, fs in LESSON_SECTIONS.items() for f in fs]
DELIVERED = f"{LESSONS}, rl as (select r0.publication_id, r0.lesson_number, b.reference_display, b.canonical_references refs from r0 join biblical_readings b on b.reading_id = r0.last_id), dl as (select s1.publication_id, s1.lesson_number, expected_title, lesson_date, rl.reference_display, rl.refs from s1 left join rl on rl.publication_id = s1.publication_id and rl.lesson_number = s1.lesson_number)"
_blank = lambda c: f"({c} is null or {strip(c)} = '')"
_broken = {"title": _blank("expected_title"), "lesson_sections.title.text": _blank("expected_title"), "lesson_sections.biblical_reading.reference_display": _blank("reference_display"), "lesson_sections.biblical_reading.canonical_references": "(refs is null or len(refs) = 0)"}
MISSING = " union all ".join(f"select publication_id, lesson_number, {i} as pos, '{r}' as rule, '{p}' as path from dl where {_broken[p]}" for i, (r, p) in enumerate(_paths) if p in _broken)
ORACLES["missing_fields"] = f"with {DELIVERED}, mf as ({MISSING}) select publication_id, lesson_number, rule, path from mf"
READ_ERRORS = """select publication_id, lesson_number, 3 as position, 'canonical_references' as error from dl where refs is null or len(refs) = 0
 union all select publication_id, lesson_number, 4, 'reference_fields' from dl where len(list_filter(refs, lambda z: z.testament is null or trim(z.testament) = '' or z.book_standardized is null or trim(z.book_standardized) = '')) > 0
 union all select publication_id, lesson_number, 5, 'positive_integers' from dl where len(list_filter(refs, lambda z: coalesce(z.chapter, 0) <= 0)) > 0
 union all select publication_id, lesson_number, 6, 'positive_integers' from dl where len(list_filter(refs, lambda z: coalesce(z.verse_start, 0) <= 0 or coalesce(z.verse_end, 0) <= 0)) > 0"""
ORACLES["reading_policy_errors"] = f"with {DELIVERED}, re as ({READ_ERRORS}) select * from re"
ORACLES["index_gate"] = f"with {DELIVERED} select count(*) n_lessons, count(*) n_invalid, false may_index from dl"
_fixed = {
    "processing_audit.ocr_engine_version": "'pending-version-capture'", "processing_audit.extraction_confidence": "'automated-unreviewed'", "processing_audit.reviewed_by": "'pending-human-review'", "processing_audit.review_status": "'automated_unreviewed'",
    "source_integrity.sha256": f"'{NO_FILE}'", "source_integrity.source_scan_quality": "'pending-human-review'", "semantic_metadata.doctrinal_categories": "'TBD'", "semantic_metadata.theological_themes": "'TBD'",
    "title": "title", "lesson_sections.title.text": "title", "lesson_sections.lesson_header.lesson_date": "lesson_date", "lesson_sections.biblical_reading.reference_display": "reference_display",
    "lesson_sections.biblical_reading.canonical_references.testament": "unnest(list_transform(refs, lambda z: z.testament))", "lesson_sections.biblical_reading.canonical_references.book_standardized": "unnest(list_transform(refs, lambda z: z.book_standardized))",
    "lesson_sections.lesson_outline.items": "unnest(outline_)", "lesson_sections.teacher_notes.items": "unnest(notes)", "lesson_sections.summary_application.items": "unnest(summary)",
}
LEAVES = " union all ".join(f"select publication_id, lesson_number, '{p}' as path, {v} as value from dr" for p, v in _fixed.items())
_hold = "value in ('TBD', 'pending', 'automated_unreviewed', 'automated-unreviewed') or lower(value) like 'pending-%' or lower(value) like 'placeholder-%'"
ORACLES["placeholder_leaves"] = f"with {DRAFTS}, lv as ({LEAVES}) select * from lv where {_hold}"
ORACLES["first_error"] = f"""with {DELIVERED}, mf as ({MISSING}), re as ({READ_ERRORS}), u as (select publication_id, lesson_number, pos, 'missing ' || path error from mf union all select publication_id, lesson_number, position + 10000, 'reading ' || error from re union all select publication_id, lesson_number, 20000, 'placeholder value' from dl)
select publication_id, lesson_number, arg_min(error, pos) error from u group by all"""
ORACLES["duplicate_draft_paths"] = f"with {DRAFTS} select 'all/' || year || '/C1/' || lesson_id || '.yaml' as path, count(*) n from dr group by 1 having count(*) > 1"
ORACLES["draft_paths"] = f"with {DRAFTS} select publication_id, lesson_number, publication_id || '/' || year || '/C1/' || lesson_id || '.yaml' as path from dr"

KIND = f"""case when upper(text) = 'TBD' then 'placeholder' when regexp_matches(text, '(?i)^[IVXLCDM]+\\.\\s+') then 'roman_heading' when regexp_matches(text, '^[A-Z]\\.\\s+') then 'letter_subpoint'
 when starts_with(text, '(') and ends_with(text, ')') then 'scripture_reference' when starts_with(text, '¿') or ends_with(text, '?') then 'question' else 'paragraph' end"""


def items(of: str, name: str) -> str:
    """CTE `name`: every section item of the drafts `of`."""
    parts = " union all ".join(f"select publication_id, lesson_id, lesson_number, '{s}' section, i item_order, {strip(f'{c}[i]')} as text from (select *, unnest(range(1, len({c}) + 1)) i from {of})" for s, c in (("lesson_outline", "outline_"), ("teacher_notes", "notes"), ("summary_application", "summary")))
    return f"{name}0 as ({parts}), {name} as (select *, format('{{}}-{{}}-{{:03d}}', lesson_id, replace(section, '_', '-'), item_order) item_id, {KIND} kind from {name}0 where text <> '')"


COMPOSED_OUTLINE = "['I. ' || et, 'A. punto', ' ', '(Juan 3:16)']"
ITEMS = f"{DRAFTS}, {items('dr', 'it')}"
ORACLES["index_items"] = f"with {ITEMS} select * from it"
ORACLES["index_header"] = f"with {DRAFTS} select '1.0.0' schema_version, 'provisional_unreviewed' index_scope, 'compact_lessons' index_view, array_to_string(list_sort(list(distinct {family('publication_id')} || ' ' || {VERSION})), ',') profiles, null::varchar source_archive, 'Index built from unreviewed lessons; not official.' warning from dr"
COMPACT = f"select publication_id, lesson_number, lesson_id, 'adult' collection_type, year, 'C1' cycle, title, reference_display, 'api.bible' replacement_provider, {family('publication_id')} classification, {family('publication_id')} profile_id, {VERSION} profile_version from dr"
ORACLES["compact_index"] = f"with {DRAFTS} {COMPACT}"
_said = "coalesce(string_agg(item_id || '|' || item_order || '|' || kind || '|' || it.text || '|' || {ref}, '¶' order by item_order), '')"
_secs = ("lesson_outline", "teacher_notes", "summary_application")
ORACLES["lessons_index"] = f"with {ITEMS}, c as ({COMPACT}), " + ", ".join(f"{x}_ as (select publication_id, lesson_number, count(*)::int n, {_said.format(ref=repr(x if x == 'lesson_outline' else ''))} t from it where section = '{x}' group by 1, 2)" for x in _secs) + " select c.*, 'replace_by_canonical_reference' replacement_strategy, " + ", ".join(f"coalesce({x}_.n, 0) {x}_count, coalesce({x}_.t, '') {x}_items, {'c.lesson_number * 10' if x == 'lesson_outline' else 'null::int'} {x}_line" for x in _secs) + " from c " + " ".join(f"left join {x}_ on {x}_.publication_id = c.publication_id and {x}_.lesson_number = c.lesson_number" for x in _secs)
ORACLES["section_outline_index"] = f"""with {REAL_DRAFTS}, {items('rdr', 'it')}, dd as (select d.publication_id, d.lesson_number, d.lesson_id, s.section, t.line_start, t.page_end, case when t.line_start is not null then s.section else '' end ref from rdr d cross join (values ('lesson_outline'), ('teacher_notes'), ('summary_application')) s(section)
 left join tr t on t.publication_id = d.publication_id and t.lesson_number = d.lesson_number and t.section = s.section)
select dd.publication_id, dd.lesson_number, dd.lesson_id, dd.section, {family('dd.publication_id')} profile_id, {VERSION.replace('publication_id', 'dd.publication_id')} profile_version, count(it.text)::int item_count, md5({_said.format(ref='dd.ref')}) items_digest, dd.line_start, dd.page_end
 from dd left join it on it.publication_id = dd.publication_id and it.lesson_number = dd.lesson_number and it.section = dd.section group by all"""
ORACLES["translation_alignment_index"] = f"with {ITEMS} select publication_id, item_id, section, item_order, kind, text source_text, 'es' source_language, 'pending' target_language, null::varchar target_text from it"
ORACLES["scripture_index"] = f"with {DRAFTS} select publication_id, lesson_number, lesson_id, reference_display, i ref_no, refs[i].testament testament, refs[i].book_standardized book_standardized, refs[i].chapter chapter, refs[i].verse_start verse_start, refs[i].verse_end verse_end from (select *, unnest(range(1, len(refs) + 1)) i from dr)"
ORACLES["family_counts"] = f"with {DRAFTS} select {family('publication_id')} classification, count(*) n_lessons from dr group by 1"
ORACLES["family_views"] = f"with {DRAFTS} select {family('publication_id')} classification, count(*) n_lessons, count(distinct publication_id) n_publications from dr group by 1"
ORACLES["listing_sync"] = """with a as (select publication_id || '.pdf' as name, max(page_number)::bigint as size from page_quality group by 1), s as (select publication_id || '.pdf' as name, max(page_end)::bigint as size from lesson_segments group by 1),
b as (select coalesce(s.name, d.name) as name, coalesce(s.size, 0) as size from s full outer join (select distinct publication_id || '.pdf' as name from documents where publication_id is not null) d on d.name = s.name)
select coalesce(a.name, b.name) as name, a.size local_size, b.size remote_size, case when a.name is null then 'missing_local' when b.name is null then 'missing_remote' when a.size <> b.size then 'size_mismatch' else 'match' end outcome from a full outer join b on a.name = b.name"""
GONE = f"""{ALL_SECTIONS}, pr as (select publication_id, lesson_number, 'biblical_reading' section from br union select publication_id, lesson_number, section from bk union select publication_id, lesson_number, section from ol),
le_ as (select publication_id, lesson_number, min(page_start) page_start, max(page_end) page_end from sg group by 1, 2), ms as (select le_.publication_id, le_.lesson_number, s.section, le_.page_start, le_.page_end, s.section in ({quoted(CRITICAL_SECTIONS)}) critical from le_ cross join (values {", ".join(f"('{s}')" for s in REQUIRED_SECTIONS)}) s(section)
 where not exists (select 1 from pr where pr.publication_id = le_.publication_id and pr.lesson_number = le_.lesson_number and pr.section = s.section))"""
ORACLES["missing_sections"] = f"with {GONE} select * from ms"
ORACLES["missing_totals"] = f"with {GONE} select count(*) total_missing, count(*) filter (where critical) critical_missing, coalesce(bool_or(critical), false) has_critical from ms"
_titles = f"select publication_id, lesson_number, count(distinct {fold_label('expected_title')}) n_titles from lesson_segments where expected_title is not null group by 1, 2 having count(distinct {fold_label('expected_title')}) > 1"
ORACLES["title_inconsistencies"] = _titles
ORACLES["content_audits"] = f"with {GONE}, {PARTS}, ti as ({_titles}) select (select count(*) from ms) total_missing, (select count(*) from ms where critical) critical_missing, (select count(*) from ti) inconsistent_titles, (select count(distinct reading_id) from q where chapter = '' or cur is null or cur = '?') low_confidence_scripture, (select count(*) from ms where critical) > 0 has_critical"
_expect = ", ".join(f"('{k}', '{s}')" for k, v in PROFILES.items() for s in v["sections"] if s != "biblical_reading")
ORACLES["profile_completeness"] = f"""with {DRAFTS} select {family('publication_id')} classification, section, count(*) n_missing from dr join (values {_expect}) x(profile_id, section) on profile_id = {family('publication_id')} where section not in ('lesson_outline', 'teacher_notes') group by all"""
_known = quoted(["maestro", "alumno", "joven", "adolescente", "nino", "parvulo", "unclassified"])
ORACLES["normalized_audit"] = f"""with p as (select concat_ws('/', section_key, publication_id || '.txt') as path from documents where publication_id is not null), x as (select path, string_split(path, '/')[1] family, contains(path, '/') below from p), f as (select family, count(*) n from x group by 1)
select 'txt_file_count' part, '' as name, count(*) n from x union all select 'by_family', family, n from f union all select 'root_level_file', path, 1 from x where not below union all select 'unknown_family', family, 1 from f where family not in ({_known})
 union all select 'warning', 'text at the root level', 1 where exists (select 1 from x where not below) union all select 'warning', 'unknown family folder: ' || family, 1 from f where family not in ({_known})"""
ORACLES["yaml_audit"] = f"""with {DRAFTS} select 'draft_count' part, '' as name, count(*) n from dr union all select 'canonical_count', '', 0 union all select 'review_status', 'automated_unreviewed', count(*) from dr union all select 'profile', {family('publication_id')}, count(*) from dr group by 2
 union all select 'missing_section', section, count(*) from dr join (values {_expect}) x(profile_id, section) on profile_id = {family('publication_id')} where section not in ('lesson_outline', 'teacher_notes', 'summary_application') group by 2 union all select 'warning', 'no reviewed lesson exists', 1 union all select 'warning', 'drafts remain unreviewed', 1 from (select 1 from dr limit 1)"""
ORACLES["indexing_audit"] = f"""with {DRAFTS} select 'view' part, 'detailed_lessons' as name, count(*) n from dr union all select 'view', 'compact_lessons', count(*) from dr union all select 'view', 'section_outline', 3 * count(*) from dr union all select 'view', 'scripture', sum(len(refs))::bigint from dr
 union all select distinct 'family_folder', {family('publication_id')}, 1 from dr union all select 'warning', 'the scope is not that of unreviewed drafts', 1 union all select 'warning', 'translation_alignment is missing', 1"""
ORACLES["publication_paths"] = f"select distinct publication_id, '/archive/raw/' || publication_id || '.txt' raw_path, '/archive/logs/' || publication_id || '.json' log_path, 'raw/' || publication_id || '.txt' relative, 'external:' || publication_id || '.txt' runtime, {family('publication_id')} || '/' || publication_id || '.txt' classified from page_quality"
ORACLES["id_audit"] = """select 'reading' kind, format('-C1-{:03d}', lesson_number) by_path, lesson_id by_content from biblical_readings where lesson_id is not null and not contains(lesson_id, format('-C1-{:03d}', lesson_number))
 union all select 'document', publication_id, source from documents where publication_id is not null and source is not null and publication_id <> source"""
ORACLES["review_statuses"] = f"with {DRAFTS} select 'automated_unreviewed' review_status, count(*) n from dr group by 1"
ORACLES["id_consistency"] = "with x as (select reading_id, lesson_id, format('-C1-{:03d}', lesson_number) as tail from biblical_readings) select * from x where not coalesce(contains(lesson_id, tail), false)"
ORACLES["pipeline_summary"] = f"with {ITEMS} select 'lessons' as view, count(*) n from dr union all select 'section_outline', 3 * count(*) from dr union all select 'items', count(*) from it union all select 'scripture', sum(len(refs))::bigint from dr"
