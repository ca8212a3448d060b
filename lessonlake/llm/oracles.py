"""SQL for DuckDB of the llm queries that SQL can express."""

from __future__ import annotations

from ..functions.text import SPACE
from ..plans.oracles import GATE, WORD_, quoted
from .page_kinds import COMMON_WORDS

_words = f"regexp_extract_all(lower(t), '{WORD_}')"
ORACLES = {
    "p4_figures": f"""with {GATE}, x as (select *, {_words} ws from g)
select page_id, len(ws)::int word_count, case when len(ws) > 0 then list_sum(list_transform(ws, lambda w: length(w))) / len(ws) else 0.0 end mean_word_length,
 case when length(t) > 0 then length(regexp_replace(t, '[\\p{{L}}\\p{{N}}{SPACE}]+', '', 'g')) / length(t) else 0.0 end symbol_ratio,
 case when n_lines > 0 then len(list_filter(fl, lambda z: regexp_matches(z, '[.!?…:;,]$'))) / n_lines else 0.0 end punctuated_lines,
 case when len(ws) > 0 then len(list_filter(ws, lambda w: w in ({quoted(COMMON_WORDS)}))) / len(ws) else 0.0 end common_words,
 case when n_chars > 0 then n_valid / n_chars else 0.0 end valid_char_ratio, case when n_lines > 0 then n_long / n_lines else 0.0 end long_line_ratio, n_malformed malformed_scripture_count from x""",
    "p7_checks": "select capacity_id, capacity_tokens, (select count(*) from documents where text <> '') n_items, 0::bigint n_over, 0::bigint n_cut, 0::bigint n_incomplete from pack_capacity",
    "p8_checks": "select w.source, max_repeats, coalesce(n, 0) n_available, 0::bigint n_too_often, 0::bigint n_outside from source_weights w left join (select source, count(*) n from documents where text <> '' group by 1) d on d.source = w.source",
}
