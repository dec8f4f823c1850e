"""The SQL that queries of the corpus operators are held against, where SQL can express them."""

from __future__ import annotations

LIMIT = 1_500

# Characters in tables of the statement's own: what goes, what becomes a blank or a hyphen, and what looks like what.
_gone = "[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0]"
_blanks = "\t\v\f\r\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_hyphens = "\u058a\u1806\u2010\u2011\u2012\u2043\ufe63\uff0d"
_wide = "！＂＃＄％＆＇（）＊＋，．／０１２３４５６７８９：；＜＝＞？＠ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ［＼］＾＿｀ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ｛｜｝～￠￡￢￤￥￦"
_narrow = "!\"#$%&'()*+,./0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[\\]^_`abcdefghijklmnopqrstuvwxyz{|}~¢£¬¦¥₩"
_like = {
    "a": "а", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡ", "h": "һ", "i": "і", "j": "јϳ", "o": "оοօ", "p": "р", "q": "ԛ", "s": "ѕ", "v": "ѵν", "w": "ԝ", "x": "х", "y": "у",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "G": "Ԍ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟՕ", "P": "РΡ", "Q": "Ԛ", "S": "Ѕ", "T": "ТΤ", "W": "Ԝ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ",
}
_FROM = _wide + _blanks + _hyphens + "µ∆" + "".join(_like.values())
_TO = _narrow + " " * len(_blanks) + "-" * len(_hyphens) + "μΔ" + "".join(k * len(v) for k, v in _like.items())
_quoted = lambda x: x.replace("'", "''")
_form = f"translate(regexp_replace(x, '{_gone}', '', 'g'), '{_quoted(_FROM)}', '{_quoted(_TO)}')"
for _code, _plain in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "ſt"), ("ﬆ", "st"), ("Ĳ", "IJ"), ("ĳ", "ij")):
    _form = f"replace({_form}, '{_code}', '{_plain}')"

P1 = f"""with t as (select 'control_description' as field_name, row_id as id, control_description as x from control_row union select 'accepted', para_id, accepted from paragraph),
f as (select field_name, id, x, nfc_normalize({_form}) as form from t where length(x) > 0)
select distinct a.field_name, least(a.id, b.id) as id_1, greatest(a.id, b.id) as id_2 from f a join f b on a.field_name = b.field_name and a.form = b.form and a.id < b.id and a.x <> b.x"""

P2 = f"""with t as (select 'control_description' as field_name, row_id as id, control_description as x from control_row union select 'supplemental_guidance', row_id, supplemental_guidance from control_row),
w as (select field_name, id, regexp_extract_all(lower(nfc_normalize({_form})), '[\\p{{L}}\\p{{N}}]+') as w from t where length(x) > 0), k as (select * from w where len(w) >= 8),
s as (select distinct field_name, id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as g from k), z as (select field_name, id, count(*) as n from s group by 1, 2),
c as (select a.field_name, a.id as i, b.id as j, count(*) as common from s a join s b on a.field_name = b.field_name and a.g = b.g and a.id < b.id group by 1, 2, 3)
select c.field_name, i as row_id_1, j as row_id_2 from c join z x on x.field_name = c.field_name and x.id = i join z y on y.field_name = c.field_name and y.id = j where common >= 0.6::double * (x.n + y.n - common) - 1e-9"""

P2_GROUPS = f"""with recursive p as ({P2}), e as (select field_name, row_id_1 as a, row_id_2 as b from p union all select field_name, row_id_2, row_id_1 from p),
r as (select distinct field_name, a, a as n from e union select r.field_name, r.a, e.b from r join e on e.field_name = r.field_name and e.a = r.n), g as (select field_name, a, min(n) as group_id from r group by 1, 2), d as (select field_name, a, count(*) as links from e group by 1, 2)
select g.field_name, g.a as row_id, group_id, links from g join d on g.field_name = d.field_name and g.a = d.a"""

P6 = """with r as (select distinct entry_id, document, acronym, occurrences from acronym_per_document),
v as (select document, upper(regexp_replace(acronym, '^[\\s/-]+|[\\s/-]+$', '', 'g')) as acronym, occurrences from r),
c as (select acronym, sum(occurrences)::bigint as occurrences, count(distinct document) as documents from v where acronym <> '' and occurrences > 0 group by 1),
b as (select *, case when documents <= 2 then 'rare' when documents * 5 > (select count(distinct document) from acronym_per_document) then 'common' else 'kept' end as band from c)"""

_longest = lambda parts: f"list_max(list_transform({parts}, lambda x: length(x)))"
P4 = f"""with ln as (select doc_id, unnest(l) as text, generate_subscripts(l, 1) - 1 as seq from (select doc_id, string_split(text, chr(10)) as l from documents where length(text) > {LIMIT})),
hd as (select doc_id, start_para_index as s, min(coalesce(heading_level, 2)) as level from section_info group by 1, 2), el as (select ln.*, hd.level from ln left join hd on ln.doc_id = hd.doc_id and ln.seq = hd.s),
g as (select doc_id, seq, text, {", ".join(f"count(case when level <= {k} and seq > 0 then 1 end) over (partition by doc_id order by seq) as g{k}" for k in (1, 2, 3, 4))} from el),
{", ".join(f"m{k} as (select doc_id, max(n) as n from (select doc_id, g{k}, sum(length(text)) + count(*) - 1 as n from g group by 1, 2) group by 1)" for k in (1, 2, 3, 4))},
t as (select doc_id, {_longest("string_split(text, chr(10))")} as p, {_longest("string_split(regexp_replace(text, '([.!?]) ', chr(92) || '1' || chr(10), 'g'), chr(10))")} as s, {_longest("string_split(replace(text, ' ', chr(10)), chr(10))")} as w from documents where length(text) > {LIMIT})
select t.doc_id, case {" ".join(f"when m{k}.n <= {LIMIT} then 'heading_{k}'" for k in (1, 2, 3, 4))} when p <= {LIMIT} then 'paragraph' when s <= {LIMIT} then 'sentence' when w <= {LIMIT} then 'word' else 'none' end as boundary
from t join m1 on t.doc_id = m1.doc_id join m2 on t.doc_id = m2.doc_id join m3 on t.doc_id = m3.doc_id join m4 on t.doc_id = m4.doc_id"""

SQL: dict[str, str] = {
    "p1_found": P1,
    "p2_found": P2,
    "p2_groups": P2_GROUPS,
    "p4_found": P4,
    "p6_found": P6 + " select acronym, band from b where band <> 'kept'",
    "p6_counts": P6 + " select acronym, occurrences, documents, band from b",
}
