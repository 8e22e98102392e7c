"""The same results as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from revtide.llm import quality_rules as rules

_WORDS = r"len(regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+'))"

_CONTROL = r"([\[<])(/?INST\]|/?s>|</?(?:SYS|ROLE)>>|</TURN>>|<SEP>>)"
_ESCAPED = rf"regexp_replace(replace({{}}, '\', '\\'), '{_CONTROL}', '\1\\\2', 'g')"

OP8 = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), n as (
  select *,
    length({_ESCAPED.format("text")}) as chars,
    lag(role) over w as before, lead(role) over w as after,
    length(case role when 'system' then '<<SYS>>' when 'user' then '[INST]' when 'assistant' then '<s>'
      else '<<ROLE>>' || {_ESCAPED.format("role")} || '<</ROLE>>' end) as opening,
    length(case role when 'system' then '<</SYS>>' when 'user' then '[/INST]' when 'assistant' then '</s>' else '<</TURN>>' end) as closing
  from t window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
  cast(sum(chars + case when before = role then length('<<SEP>>') else opening end + case when after = role then 0 else closing end) as bigint) as formatted_chars
from n group by conv_id
"""


def mixed_sql(docs: str = "documents") -> str:
    """A row a document, with its key and how it is taken."""
    return f"""
sized as (
  select *, {_WORDS.format("text")} as size, md5('mix|' || coalesce(cast(doc_id as varchar), 'null')) as mix_key from {docs}
), src as (
  select source, cast(sum(size) as bigint) as source_size,
    row_number() over (order by source is null, encode(source)) - 1 as place
  from sized group by source
), weighed as (
  select *, cast([5, 2, 1][place % 3 + 1] as bigint) as weight, 2 * source_size as most from src
), filled as (
  select *, (1.5::double * sum(source_size) over () - coalesce(sum(most) over before, 0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level,
    row_number() over (order by most::double / weight, place) as nth
  from weighed
  window before as (order by most::double / weight, place rows between unbounded preceding and 1 preceding)
), lowest as (
  select min_by(level, nth) as level from filled where most > weight * level
), aimed as (
  select source, source_size, least(most::double, coalesce(weight * lowest.level, most::double)) as target
  from filled left join lowest on true
), plan as (
  select *, case when source_size = 0 then 0 else cast(floor(round(target) / source_size) as bigint) end as whole,
    cast(round(target) - case when source_size = 0 then 0 else floor(round(target) / source_size) * source_size end as bigint) as rest
  from aimed
), ordered as (
  select d.*, p.source_size, p.target, p.whole, p.rest,
    sum(size) over (partition by d.source order by mix_key range between unbounded preceding and current row) as upto,
    sum(size) over (partition by d.source, mix_key) as tied, count(*) over (partition by d.source, mix_key) as sharing
  from sized d join plan p on d.source is not distinct from p.source
), taken as (
  select *, cast(case when rest <= 0 then 0 when upto <= rest then size
    when upto - tied < rest then least(size, floor((rest - upto + tied) / sharing)) else 0 end as bigint) as once
  from ordered
)"""


OP10 = f"""
with {mixed_sql()}
select doc_id, cast(size as bigint) as size, source_size, target, cast(whole * size + once as bigint) as taken from taken
"""

def _rules_sql() -> str:
    """Figures by lists and joins, votes by the same rules, and the rounds written out."""
    names = rules.NAMES
    start = ", ".join(f"('{kind}', '{name}', {v}, {x}::double)" for (kind, name, v), x in rules._start().items())
    shares = ", ".join(f"('{kind}', {x}::double)" for kind, x in rules.start_shares().items())
    rounds = [
        f"start as (select * from (values {start}) t(kind, name, vote, rate))",
        "r0 as (select * from start)",
        f"s0 as (select * from (values {shares}) t(kind, share))",
    ]
    for k in range(rules.ROUNDS + 1):
        rounds.append(
            f"e{k} as materialized (select *, exp(l) / sum(exp(l)) over (partition by pattern) as p from (select v.pattern, r.kind, any_value(v.n) as n, "
            f"ln(any_value(s.share)) + sum(ln(r.rate)) as l from cast_votes v join r{k} r on v.name = r.name and v.vote = r.vote join s{k} s on r.kind = s.kind group by 1, 2))"
        )
        rounds.append(f"t{k} as materialized (select kind, sum(n * p) as total from e{k} group by kind)")
        rounds.append(
            f"s{k + 1} as materialized (select kind, (total + {rules.PRIOR / len(rules.KINDS)}) / (sum(total) over () + {rules.PRIOR}) as share from t{k})"
        )
        rounds.append(
            f"r{k + 1} as materialized (select kind, name, vote, (coalesce(c.x, 0) + {rules.PRIOR} * rate) / (total + {rules.PRIOR}) as rate from start join t{k} using (kind) "
            f"left join (select kind, name, vote, sum(e.n * p) as x from e{k} e join cast_votes v on e.pattern = v.pattern group by all) c using (kind, name, vote))"
        )
    pattern = " || ' ' || ".join(names)
    votes = ", ".join(f"{x} as {n}" for n, x in rules.votes().items())
    return f"""
with rows as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents
), split as (
  select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from rows
), windows as (
  select rid, unnest(range(1, len(words) - 1)) as i, words from split where len(words) >= 3
), twice as (
  select rid, i from (select rid, i, count(*) over (partition by rid, words[i], words[i + 1], words[i + 2]) as n from windows) where n > 1
), covered as (
  select rid, count(distinct place) as n from (select rid, unnest([i, i + 1, i + 2]) as place from twice) group by rid
), figures as (
  select s.rid, doc_id, len(words) as n_words, cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(c.n, 0) as n_repeat_words, len(regexp_extract_all(text, '[A-Z]')) as n_capitals, len(regexp_extract_all(text, '[.!?]')) as n_stops,
    len(lines) as n_lines, len(list_distinct(words)) as n_distinct_words
  from split s left join covered c on s.rid = c.rid
), voted as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, {votes} from figures
), patterns as materialized (
  select {pattern} as pattern, {", ".join(names)}, count(*) as n from voted where not base_failed group by all
), cast_votes as materialized (
  select pattern, n, unnest([{", ".join(f"'{x}'" for x in names)}]) as name, unnest([{", ".join(names)}]) as vote from patterns
), {", ".join(rounds)}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(not base_failed and p >= 0.5, false) as kept
from voted v left join e{rules.ROUNDS} e on {pattern} = e.pattern and e.kind = 'good'
"""


OP11 = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents
), w as (
  select r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d
), k as (
  select lang, term, count(*) as of_lang from w group by all having count(distinct r) >= 30
), c as (
  select lang, source, term, count(*) as n from w semi join k using (lang, term) group by all
), g as (
  select lang, source, coalesce(sum(n), 0) as n from (select distinct lang, source from d) left join c using (lang, source) group by all
), l as (
  select lang, count(*) as v, sum(of_lang) as n from k group by lang
), dense as (
  select lang, source, term, coalesce(c.n, 0) as n,
    1 + cast(1000000000 as hugeint) * (coalesce(c.n, 0) + 5) // cast(g.n + 5 * l.v as hugeint) as p,
    1 + cast(1000000000 as hugeint) * (k.of_lang + 5) // cast(l.n + 5 * l.v as hugeint) as q
  from g join l using (lang) join k using (lang) left join c using (lang, source, term)
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(sum(abs(x.p - y.p)), 0) as bigint) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join dense x on x.lang = a.lang and x.source = a.source
  left join dense y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all
  union all
  select lang, source, 'term', term, cast(p - q as bigint) from dense where n > 0 and p > q
)
select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
from found qualify part = 'pair' or rank <= 50
"""


def clusters_sql(rounds: int = 3) -> str:
    """Every vector against every centroid, in each round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} as (
  select r, any_value(vec_id) as vec_id, any_value(p) as p, min(d * 16 + c) as m from (
    select kept.*, c, list_sum(list_transform(list_zip(kept.p, s{k}.p), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d from kept, s{k}
  ) group by r
)""")
        if k < rounds:
            steps.append(f"""s{k + 1} as (
  select c, coalesce(moved.p, s{k}.p) as p from s{k} left join (
    select c, list(cast((total - ((total % n) + n) % n) // n as bigint) order by i) as p from (
      select m % 16 as c, i, sum(x) as total, count(*) as n from (select m, unnest(range(64)) as i, unnest(p) as x from a{k}) group by all
    ) group by c
  ) moved using (c)
)""")
    return f"""
with kept as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as p
  from embeddings where len(list_filter(embedding, lambda x: isfinite(x))) = 64 and len(embedding) = 64
), s0 as (
  select row_number() over (order by h, p) - 1 as c, p from (
    select sha256('1:' || vec_id) as h, p from kept where vec_id is not null order by h, p limit 16
  )
), {", ".join(steps)}
select vec_id, cast(m % 16 as integer) as cluster, cast(m // 16 as bigint) as distance,
  cast(sum(m // 16) over (partition by m % 16) as bigint) as cluster_inertia, cast(sum(m // 16) over () as bigint) as inertia,
  sha256(array_to_string(s{rounds}.p, ',')) as centroid_sha256
from a{rounds} join s{rounds} on c = m % 16
"""


ORACLE_SQL = {
    "op5_quality_rules": _rules_sql(),
    "op8_chat_formatting": OP8,
    "op10_mixing": OP10,
    "op11_source_divergence": OP11,
    "op12_centroid_clusters": clusters_sql(),
}
