"""DuckDB SQL for the corpus queries that SQL can express, written without the operators' shortcuts."""

from __future__ import annotations

from . import chat_format, license_scan, mixing, quality, secret_scan

_Q = "'"
_UP, _LOW = license_scan.UPPER, license_scan.LOWER
SPACE = r"[\x20\x09-\x0D]+"


def _s(x: str) -> str:
    return "'" + x.replace(_Q, _Q * 2) + "'"


def _licenses() -> str:
    templates = ", ".join(f"({k}, {_s(label)}, [{', '.join(map(_s, ws))}], {half})" for k, (label, ws, half) in enumerate(license_scan.template_words(license_scan.TEMPLATES)))
    tests = " UNION ALL ".join(
        f"SELECT row_no, i, {_s(label)} AS label FROM w, unnest(range(len(w))) u(i) WHERE " + " AND ".join(f"w[i+{k + 1}]={_s(x)}" for k, x in enumerate(phrase.split()))
        for phrase, label in license_scan.PHRASES.items())
    split = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, translate(coalesce(text,''),'{_UP}','{_LOW}') AS t FROM documents),
w AS (SELECT row_no, list_filter(string_split_regex(t, {split}), lambda x: x<>'') AS w FROM d),
p AS ({tests}), b AS (SELECT row_no, count(*) AS n, min(i) AS f, max(i) AS l, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM p GROUP BY 1),
tpl(no, label, words, half) AS (VALUES {templates}),
blocks AS (SELECT row_no, NULL AS half, list_distinct(list_filter(string_split_regex(l, {split}), lambda x: x<>'')) AS ws FROM (SELECT row_no, unnest(string_split(t, chr(10))) AS l FROM d)
 UNION ALL SELECT row_no, h, list_distinct(w[k*h+1:k*h+2*h]) FROM (SELECT row_no, w, h, unnest(range((len(w)+h-1)//h)) AS k FROM w, (SELECT DISTINCT half AS h FROM tpl))),
m AS (SELECT row_no, label, len(list_intersect(words, ws)) / len(words) AS score FROM blocks b, tpl WHERE coalesce(b.half,tpl.half)=tpl.half AND len(list_intersect(words, ws)) >= ceil(0.9*len(words)-1e-9)),
a AS (SELECT row_no, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT row_no, label FROM p UNION SELECT row_no, label FROM m) GROUP BY 1), s AS (SELECT row_no, max(score) AS score FROM m GROUP BY 1)
SELECT doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(b.n,0) AS n_base, CAST(b.f AS BIGINT) AS first_word, CAST(b.l AS BIGINT) AS last_word, coalesce(b.labels,'') AS base_labels, coalesce(a.labels,'') AS labels,
 CASE WHEN b.n IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(s.score,0)::DOUBLE END AS score
FROM d JOIN w USING (row_no) LEFT JOIN b USING (row_no) LEFT JOIN a USING (row_no) LEFT JOIN s USING (row_no)"""


def _chat() -> str:
    esc = lambda x: rf"regexp_replace({x}, '([<\[]{chat_format.MARK}*)(\||/?s>|</?SYS>>|/?INST\])', '\1{chat_format.MARK}\2', 'g')"
    text = len(chat_format.TEXT)
    fixed = len(chat_format.TURN + chat_format.END)
    marks = " ".join(f"WHEN {k} THEN {len(x)}" for k, x in enumerate(chat_format.PLACEHOLDERS.values(), 1))
    control = "'</s>[INST] ok [/INST]'"
    return f"""WITH c AS (SELECT conv_id, turn, coalesce(role,'') AS role, coalesce(text,'') AS text FROM conversations UNION ALL VALUES (-1, 0, 'user', {control}), (-1, 1, 'assistant', {control})),
p AS (SELECT *, length(text)//2 AS half, ((conv_id+turn)%16+16)%16 AS att, (conv_id%5+5)%5 AS few FROM c),
w AS (SELECT *, CASE WHEN length(text)>64 THEN {2 * text}+length({esc('substr(text,1,half)')})+length({esc('substr(text,half+1)')}) ELSE {text}+length({esc('text')}) END + CASE att {marks} ELSE 0 END AS n,
 CASE att WHEN 1 THEN (few+1)*2 WHEN 2 THEN CAST(ceil((few+0.5)*{chat_format.PER_SECOND}) AS BIGINT) WHEN 3 THEN few*{chat_format.PER_PAGE} END AS tokens FROM p)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role||chr(10)||text||chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 CAST(coalesce(sum(length(text)) FILTER (role='assistant'),0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role='assistant'),'')) AS loss_sha256,
 CAST(sum({fixed}+length({esc('role')})+n) AS BIGINT) AS formatted_chars, count(tokens) AS n_attachments, CAST(coalesce(sum(tokens),0) AS BIGINT) AS attachment_tokens FROM w GROUP BY 1"""


def _secrets() -> str:
    found = " UNION ALL ".join(
        f"""SELECT row_no, {no} AS kind_no, {_s(rule.kind)} AS kind, unnest(range(1, len(m)+1)) AS i, p, m, g FROM (SELECT row_no, string_split_regex(t, {_s(rule.pattern)}) AS p, regexp_extract_all(t, {_s(rule.pattern)}) AS m,
 regexp_extract_all(t, {_s(rule.pattern)}, {rule.group}) AS g FROM d WHERE regexp_matches(t, {_s(rule.pattern)}))""" for no, rule in enumerate(secret_scan.RULES))
    least = " ".join(f"WHEN {no} THEN {rule.least}" for no, rule in enumerate(secret_scan.RULES))
    joined = lambda x: f"coalesce(string_agg(kind||':'||(e-length(m[i]))||':'||e, ',' ORDER BY e-length(m[i]), kind_no) {x},'')"
    return f"""WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text,'') AS t FROM documents), f AS ({found}),
s AS (SELECT *, length(array_to_string(p[1:i],''))+length(array_to_string(m[1:i],'')) AS e FROM f WHERE length(g[i]) >= CASE kind_no {least} END),
r AS (SELECT row_no, count(*) FILTER (kind_no=0) AS a, count(*) FILTER (kind_no=1) AS b, count(*) FILTER (kind_no=2) AS h, {joined('FILTER (kind_no<3)')} AS base, {joined('')} AS spans FROM s GROUP BY 1)
SELECT doc_id, coalesce(a,0) AS n_assign, coalesce(b,0) AS n_access, coalesce(h,0) AS n_hex, sha256(coalesce(base,'')) AS base_sha256, coalesce(spans,'') AS spans FROM d LEFT JOIN r USING (row_no)"""


def _quality(alpha: float = 0.005, delta: float = 0.05) -> str:
    cuts = ", ".join(f"({_s(rule)}, {at}, {cut}::DOUBLE)" for rule, (_, values) in quality.RULES.items() for at, cut in enumerate(values))
    numbers = " UNION ALL ".join(f"SELECT row_no, {_s(rule)} AS rule, CAST({number.replace('/', '/ ')} AS DOUBLE) AS x FROM b WHERE NOT base_failed" for rule, (number, _) in quality.RULES.items())
    return f"""WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, lang, coalesce(text,'') AS t, list_filter(string_split_regex(coalesce(text,''), '{SPACE}'), lambda x: x<>'') AS w FROM documents),
g AS (SELECT row_no, unnest(range(1, len(w)-1)) AS i, w FROM d WHERE len(w)>=3), g3 AS (SELECT row_no, i, count(*) OVER (PARTITION BY row_no, w[i], w[i+1], w[i+2]) AS n FROM g),
rep AS (SELECT row_no, count(DISTINCT j) AS n FROM (SELECT row_no, unnest([i, i+1, i+2]) AS j FROM g3 WHERE n>1) GROUP BY 1),
l AS (SELECT row_no, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
b0 AS (SELECT d.row_no, doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w,'')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t,'[^#*$%&|<>]+','','g')) AS BIGINT) AS n_symbols,
 CAST(length(regexp_replace(t,'[^\\p{{Lu}}]+','','g')) AS BIGINT) AS n_upper, CAST(length(regexp_replace(t,'[^!?]+','','g')) AS BIGINT) AS n_shouts, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l)-len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(rep.n,0) AS n_repeat_words
 FROM d JOIN l USING (row_no) LEFT JOIN rep USING (row_no)), b AS (SELECT *, n_words<50 OR 100*n_repeat_words>50*n_words AS base_failed FROM b0),
x AS ({numbers}), cut(rule, pos, cutoff) AS (VALUES {cuts}), good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY 1 HAVING min(quality)=1),
h AS (SELECT lang, cut.rule, pos, cutoff, count(*) AS n, count(*) FILTER (x.x>cutoff) AS k FROM x JOIN b USING (row_no) JOIN cut ON cut.rule=x.rule WHERE doc_id IN (SELECT doc_id FROM good) GROUP BY 1,2,3,4),
p AS (SELECT *, CASE WHEN k<=n*{alpha} THEN list_sum(list_transform(range(k+1), lambda i: exp(lgamma(n+1)-lgamma(i+1)-lgamma(n-i+1)+i*ln({alpha})+(n-i)*ln(1-{alpha})))) ELSE 1 END AS p, (SELECT count(DISTINCT coalesce('='||lang,'')) FROM h) AS strata FROM h),
ok AS (SELECT *, bool_and(p<={delta}/(strata*{len(quality.RULES)})) OVER (PARTITION BY lang, rule ORDER BY pos) AS ok FROM p), c AS (SELECT lang, rule, arg_max(cutoff, pos) AS cutoff FROM ok WHERE ok GROUP BY 1,2),
bad AS (SELECT DISTINCT x.row_no FROM x JOIN b USING (row_no) JOIN c ON c.rule=x.rule AND c.lang IS NOT DISTINCT FROM b.lang WHERE x.x>c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND row_no NOT IN (SELECT row_no FROM bad) AS kept FROM b"""


def _mixing() -> str:
    weights = "[" + ",".join(map(str, mixing.WEIGHTS)) + "]"
    return f"""WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text,''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size, md5('7:'||coalesce(CAST(doc_id AS VARCHAR),'')||':'||coalesce(text,'')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY 1), r AS (SELECT *, CAST({weights}[1+(row_number() OVER (ORDER BY source NULLS LAST)-1)%{len(mixing.WEIGHTS)}] AS DOUBLE) AS weight FROM s),
-- each round fills up the sources that the level would take beyond twice their size
fill(round, level, n) AS (SELECT 0, 1.5*sum(size)/sum(weight), CAST(0 AS BIGINT) FROM r
 UNION ALL SELECT round+1, (SELECT (1.5*(SELECT sum(size) FROM r)-coalesce(sum(2.0*size) FILTER (2.0*size<=level*weight),0))/nullif(sum(weight) FILTER (2.0*size>level*weight),0) FROM r), (SELECT count(*) FROM r WHERE 2.0*size<=level*weight) FROM fill WHERE round<(SELECT count(*) FROM r)),
lvl AS (SELECT max(level) AS level FROM fill), t AS (SELECT source, size AS source_size, least(2.0*size, coalesce(level*weight, 2.0*size)) AS target FROM r, lvl),
q AS (SELECT *, CAST(round(target) AS BIGINT) AS quota FROM t), e AS (SELECT *, CASE WHEN source_size>0 THEN quota//source_size ELSE 0 END AS epochs FROM q),
g AS (SELECT source, h, count(*) AS n, sum(size) AS words FROM d GROUP BY 1,2), c AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h)-words AS before FROM g)
SELECT d.doc_id, d.size, e.source_size, e.target, CAST(e.epochs*d.size+CASE WHEN e.source_size>0 THEN CASE WHEN 2*(e.quota-e.epochs*e.source_size-c.before)>=c.words THEN d.size ELSE 0 END ELSE 0 END AS BIGINT) AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.h=c.h"""


def _collocations() -> str:
    words = "array_to_string(string_split({}, ' ')[{}], ' ')"
    return f"""WITH t AS (SELECT coalesce(lang,'und') AS lang, translate(coalesce(text,''),'{_UP}','{_LOW}') AS t FROM documents),
p AS (SELECT row_number() OVER () AS no, lang, piece FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t) WHERE regexp_matches(piece, '[^\\x20\\x09]')),
w AS (SELECT no, lang, unnest(x) AS w, generate_subscripts(x, 1) AS i FROM (SELECT no, lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x<>'') AS x FROM p)),
v AS (SELECT lang, w AS a, lead(w,1) OVER o AS b, lead(w,2) OVER o AS c, lead(w,3) OVER o AS d, lead(w,4) OVER o AS e FROM w WINDOW o AS (PARTITION BY no ORDER BY i)),
g AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, 1 AS k, a AS phrase FROM v UNION ALL SELECT lang, 2, a||' '||b FROM v WHERE b IS NOT NULL UNION ALL SELECT lang, 3, a||' '||b||' '||c FROM v WHERE c IS NOT NULL
 UNION ALL SELECT lang, 4, a||' '||b||' '||c||' '||d FROM v WHERE d IS NOT NULL UNION ALL SELECT lang, 5, a||' '||b||' '||c||' '||d||' '||e FROM v WHERE e IS NOT NULL) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k=1 GROUP BY 1),
m AS MATERIALIZED (SELECT * FROM g WHERE f>=100),
c AS (SELECT * FROM m WHERE k>1),
h AS (SELECT c.*, j, {words.format('phrase', '1:j')} AS first, {words.format('phrase', 'j+1:k')} AS rest FROM c, unnest(range(1,k)) u(j)),
s AS (SELECT h.lang, h.phrase, h.k, h.f AS a, a.f AS l, b.f AS r, n.n, j, (1000::HUGEINT*h.f*n.n)//(a.f::HUGEINT*b.f) AS score
 FROM h JOIN m a ON a.lang=h.lang AND a.phrase=h.first JOIN m b ON b.lang=h.lang AND b.phrase=h.rest JOIN n ON n.lang=h.lang),
o AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j)=1),
q AS (SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.lang=o.lang AND c.k>o.k AND contains(' '||c.phrase||' ', ' '||o.phrase||' ') AND 100*c.f>=100*o.a))
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM q WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY rank<=2000"""


ORACLES = {"op1_license_scan": _licenses(), "op2_chat_format": _chat(), "op4_secret_scan": _secrets(), "op7_quality_rules": _quality(), "op9_mixing": _mixing(), "op11_collocations": _collocations()}
