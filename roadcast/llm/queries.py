"""One query per operator, over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadcast.llm import (
    chat,
    collocations,
    credentials,
    decontaminate,
    exact_dedup,
    language,
    line_dedup,
    near_dedup,
    packing,
    periodic,
    private,
    quality,
    warc,
)
from roadcast.llm.registry import ORACLES, QUERIES, query
from roadcast.llm.tables import read

__all__ = ["ORACLES", "QUERIES"]


@query(
    "op5_exact_dedup",
    r"""
    with t as (
      select doc_id, coalesce(text, '') as txt,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
      from documents
    ), g as (
      select *, first_value(doc_id) over (
               partition by norm order by length(txt) desc, doc_id) as keep_id,
             count(*) over (partition by norm) as group_size
      from t
    )
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256
    from g
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents"))


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SAID = "\\### Assistant: </turn> ok"


def with_escape_case(rows: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts look like the template."""
    spark = rows.sparkSession
    extra = spark.createDataFrame(
        [(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)],
        "conv_id long, turn long, role string, text string",
    )
    return rows.select("conv_id", "turn", "role", "text").unionByName(extra)


@query(
    "op4_reply_trees",
    r"""
    with t as (
      select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as txt
      from conversations
      union all select -7, 0, 'user', '\### Assistant: </turn> ok'
      union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
    )
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || txt || chr(10), '' order by turn nulls first, role, txt))
             as turns_sha256,
           coalesce(sum(length(txt)) filter (role = 'assistant'), 0)::bigint as loss_chars,
           sha256(coalesce(string_agg(txt, '' order by turn nulls first, role, txt)
                           filter (role = 'assistant'), '')) as loss_sha256,
           sum(length('### ' || regexp_replace(role, '([\\#<:])', '\\\1', 'g') || ': '
                      || regexp_replace(txt, '([\\#<])', '\\\1', 'g') || '</turn>') + 1)::bigint
             as formatted_chars
    from t group by conv_id
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_escape_case(read(spark, sf_dir, "conversations"))
    messages = chat.chains(rows, "conv_id", "turn", "role", "text")
    return chat.digests(chat.conversations(messages))


@query("op6_language_profiles")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.classify(docs.drop("lang"), language.learn(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@query(
    "op8_decontamination",
    r"""
    with d as (
      select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
      from documents
    ), b as (
      select item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
      from benchmark
    ), bw as (
      select distinct item_id, k, array_to_string(ws[i : i + k - 1], ' ') as gram
      from (select item_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) as i
            from (select item_id, ws, least(len(ws), 13) as k from b where len(ws) > 0))
    ), dw as (
      select doc_id, k, i, array_to_string(ws[i : i + k - 1], ' ') as gram
      from (select doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) as i
            from d, (select distinct k from bw) where len(ws) >= k)
    ), m as (
      select doc_id, i, dw.k, item_id from dw join bw on dw.k = bw.k and dw.gram = bw.gram
    ), h as (
      select doc_id, count(distinct p) as n_hit
      from (select doc_id, unnest(generate_series(i, i + k - 1)) as p from m) group by doc_id
    ), n as (
      select doc_id, count(distinct item_id) as n_items,
             sha256(string_agg(distinct item_id::varchar, ',' order by item_id::varchar)) as ids
      from m group by doc_id
    )
    select d.doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0) as n_hit,
           coalesce(n_items, 0) as n_items, coalesce(ids, sha256('')) as items_sha256,
           coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
    from d left join h using (doc_id) left join n using (doc_id)
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("print")


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read(spark, sf_dir, "documents"), TOKENIZER))


@query(
    "op10_warc",
    """
    with p as (
      select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as n
      from pages
    ), g as (
      select *, case when n >= 1000 then max(page_id) over (partition by html) end as best from p
    )
    select page_id, n::bigint as payload_bytes, sha1(html) as payload_digest,
           case when best <> page_id then 'revisit' else 'response' end as record_type,
           case when best <> page_id then best end as refers_to
    from g
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    manifest = warc.write_archives(pages, warc.archive_folder(spark))
    return warc.read_archives(manifest).select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


@query(
    "op1_near_dedup",
    r"""
    with recursive d as (
      select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as ws
      from documents
    ), s as materialized (
      select distinct doc_id, array_to_string(ws[i : i + k - 1], ' ') as shingle
      from (select doc_id, ws, least(len(ws), 3) as k,
                   unnest(generate_series(1, len(ws) - least(len(ws), 3) + 1)) as i
            from d where len(ws) > 0)
    ), n as (
      select doc_id, count(*) as n from s group by doc_id
    ), l as materialized (
      select a, b
      from (select x.doc_id as a, y.doc_id as b, count(*) as c
            from s x join s y on x.shingle = y.shingle and x.doc_id <> y.doc_id group by all)
      join n p on p.doc_id = a join n q on q.doc_id = b
      where 100 * c >= 85 * (p.n + q.n - c)
    ), r as (
      select doc_id, doc_id as other from d
      union
      select r.doc_id, l.b from r join l on r.other = l.a
    ), c as (
      select doc_id, min(other) as component_id from r group by doc_id
    )
    select d.doc_id, coalesce(n.n, 0) as n_shingles, component_id,
           d.doc_id = component_id as kept
    from d join c using (doc_id) left join n using (doc_id)
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read(spark, sf_dir, "documents"), size=3, percent=85)


def _placed(name: str, source: str, text: str, pattern: str, carried: str) -> str:
    """CTEs that give a text's matches with their places, from 0, the end exclusive."""
    return f"""
    {name}_lists as (
      select {carried}, regexp_extract_all({text}, '{pattern}') as ms, string_split_regex({text}, '{pattern}') as gs
      from {source}
    ), {name}_rows as (
      select {carried}, unnest(ms) as m, unnest(gs[1 : len(ms)]) as gap, generate_subscripts(ms, 1) as i
      from {name}_lists where len(ms) > 0
    ), {name} as (
      select *, (sum(length(gap) + length(m)) over w - length(m))::bigint as s,
             (sum(length(gap) + length(m)) over w)::bigint as e
      from {name}_rows window w as (partition by {carried} order by i)
    )"""


_ALNUM = r"[\p{L}\p{N}]+"
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(generate_series(1, length({_DIGITS})), lambda k:
  case when k % 2 = 1 then substr(reverse({_DIGITS}), k, 1)::int
       else (2 * substr(reverse({_DIGITS}), k, 1)::int) // 10 + (2 * substr(reverse({_DIGITS}), k, 1)::int) % 10 end)) % 10 = 0"""
_PRIVATE_SQL = (
    "with d as (select doc_id, coalesce(text, '') as txt from documents), "
    + ",".join(
        _placed(name, "d", "txt", pattern, "doc_id, txt")
        for name, pattern in (
            ("emails", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
            ("ips", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
            ("cards", r"[0-9](?:[\x20-]?[0-9])+"),
            ("phones", r"\+[0-9][\x20().0-9-]+[0-9]"),
        )
    )
    + f"""
    , found as (
      select doc_id, txt, 1 as rank, 'email' as kind, m, s, e, 'email:' || lower(m) as entity from emails
      union all
      select doc_id, txt, 2, 'ip', m, s, e, 'ip:' || m from ips
      where len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 or
        (ltrim(p, '0') <> '' and length(ltrim(p, '0')) <= 3 and ltrim(p, '0')::int > 255))) = 0
      union all
      select doc_id, txt, 3, 'card', m, s, e, 'card:' || {_DIGITS} from cards
      where length({_DIGITS}) between 13 and 19 and {_LUHN}
      union all
      select doc_id, txt, 4, 'phone', m, s, e, 'phone:' || {_DIGITS} from phones
      where length({_DIGITS}) between 9 and 15
    ), bare as (
      select doc_id, txt, list_distinct(list_transform(list_filter(regexp_extract_all(regexp_replace(
        txt, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+', ' ', 'g'), '[\\p{{L}}\\p{{N}}]+'),
        lambda w: regexp_full_match(w, '\\p{{L}}{{2,}}')), lambda w: lower(w))) as terms
      from d
    ), texts as (
      select txt, any_value(terms) as terms from bare group by txt
    ), total as (
      select count(*)::double as n from texts
    ), pairs_in as (
      select distinct txt, entity from found
    ), entities as (
      select entity, count(*) as n_entity from pairs_in group by entity having count(*) > 1
    ), in_text as (
      select txt, unnest(terms) as term from texts
    ), term_counts as (
      select term, count(*) as n_term from in_text group by term having count(*) > 1
    ), told as (
      select entity, term from (
        select entity, term, n_entity, n_term, count(*) as n_both
        from pairs_in join entities using (entity) join in_text using (txt) join term_counts using (term) group by all), total
      where n > n_entity and n_both > 1 and n_both * ln(n / n_entity) >= -ln(1e-6)
        and ln(n_both * n / (n_entity * n_term)) >= 0.9 * ln(n / n_entity)
    ), asked as (
      select distinct doc_id, txt, term from (select distinct doc_id, txt, entity from found) join told using (entity)
    ), asking as (select distinct doc_id, txt from asked
    ), """
    + _placed("runs", "asking", "txt", _ALNUM, "doc_id, txt")
    + r"""
    , held as (
      select distinct doc_id, s, e from runs
      where exists (select 1 from asked a where a.doc_id = runs.doc_id and a.term = lower(m))
        and not exists (select 1 from found f where f.doc_id = runs.doc_id and f.s < runs.e and runs.s < f.e)
    ), base as (
      select doc_id, count(*) filter (rank = 1) as n_email, count(*) filter (rank = 2) as n_ip,
             count(*) filter (rank = 3) as n_card, count(*) filter (rank = 4) as n_phone,
             string_agg(kind || ':' || s || ':' || e, ',' order by rank, s) as spans
      from found group by doc_id
    ), more as (
      select doc_id, string_agg('term:' || s || ':' || e, ',' order by s, e) as spans from held group by doc_id
    )
    select d.doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip,
           coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone,
           sha256(coalesce(base.spans, '')) as base_sha256,
           concat_ws(',', base.spans, more.spans) as spans
    from d left join base using (doc_id) left join more using (doc_id)
    """
)


@query("op2_private_data", _PRIVATE_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.report(private.protected(read(spark, sf_dir, "documents")))


_SECRET_SQL = (
    "with d as (select doc_id, coalesce(text, '') as txt from documents), "
    + ",".join(
        _placed(name, "d", "txt", pattern, "doc_id, txt")
        for name, pattern in (
            (
                "assigns",
                r"""[Pp][Aa][Ss][Ss](?:[Ww][Oo][Rr][Dd]|[Ww][Dd])["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
                r"""|(?:[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
                r"""["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+""",
            ),
            ("keys", "AKIA[A-Z0-9]+"),
            ("hexes", "[0-9a-f]+"),
            ("strings", "[A-Za-z0-9+/=_-]+"),
        )
    )
    + r"""
    , parts as (
      select doc_id, s, e, part, generate_subscripts(ps, 1) as k
      from (select doc_id, s, e, ps, unnest(ps) as part from (
        select doc_id, s, e, string_split_regex(m,
          '(?i)example|sample|dummy|placeholder|changeme|x{6,}|0{8,}|12345678|abcdefgh') as ps
        from strings where length(m) >= 20))
    ), windows as (
      select doc_id, s, e, k, pos, substr(part, pos, 20) as w
      from (select *, unnest(generate_series(1, length(part) - 19)) as pos from parts where length(part) >= 20)
    ), chars as (
      select doc_id, s, e, k, pos, w, c, count(*) as n
      from (select *, unnest(string_split(w, '')) as c from windows) group by all
    ), entropies as (
      select doc_id, s, e, w, -sum(n / 20 * log2(n / 20)) as h from chars group by doc_id, s, e, k, pos, w
    ), random as (
      select distinct doc_id, s, e from entropies
      where round(h, 9) >= case
          when regexp_matches(w, '[+/=_-]') then 3.75
          when regexp_full_match(w, '[0-9]+') then 2.6
          when regexp_matches(w, '[a-z]') and regexp_matches(w, '[A-Z]')
            then case when regexp_matches(w, '[0-9]') then 3.75 else 3.6 end
          when regexp_full_match(w, '[0-9a-f]+|[0-9A-F]+') then 3.0
          when not regexp_matches(w, '[0-9]') then 3.25
          when regexp_full_match(w, '[A-Z2-7]+') then 3.44 else 3.5 end
        and (regexp_matches(w, '[0-9]') or length(regexp_replace(w, '[^aeiouAEIOU]', '', 'g')) <= 6)
    ), found as (
      select doc_id, 1 as rank, 'assign' as kind, s, e from assigns
      where length(regexp_extract(m, '[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6
      union all select doc_id, 2, 'access', s, e from keys where length(m) >= 20
      union all select doc_id, 3, 'hex', s, e from hexes where length(m) >= 24
      union all select doc_id, 4, 'entropy', s, e from random
    ), lists as (
      select doc_id, count(*) filter (rank = 1) as n_assign, count(*) filter (rank = 2) as n_access,
             count(*) filter (rank = 3) as n_hex,
             string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (rank < 4) as base,
             string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans
      from found group by doc_id
    )
    select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
           coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
           coalesce(spans, '') as spans
    from d left join lists using (doc_id)
    """
)


@query("op3_secret_scan", _SECRET_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.report(credentials.secrets(read(spark, sf_dir, "documents")))


@query(
    "op11_line_dedup",
    """
    with d as (
      select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents
    ), l as (
      select doc_id, i, ls[i] as line,
             translate(trim(ls[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
      from (select doc_id, ls, unnest(generate_series(1, len(ls))) as i from d)
    ), r as (
      select key, max(doc_id) as last from l
      where length(key) >= 20 group by key having count(distinct doc_id) >= 3
    )
    select doc_id, count(*) as n_lines, count(*) filter (last is not null and doc_id <> last) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by i) filter (last is null or doc_id = last), ''))
             as kept_sha256
    from l left join r using (key) group by doc_id
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read(spark, sf_dir, "documents"))


@query(
    "op13_collocations",
    r"""
    with p as (
      select coalesce(lang, 'und') as lang, row_number() over () as piece, regexp_extract_all(
        translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09]+') as ws
      from (select lang, unnest(string_split_regex(coalesce(text, ''), '[.,;:!?\x0A-\x0D]')) as part from documents)
    ), totals as (
      select lang, sum(len(ws))::bigint as n from p group by lang
    ), grams as (
      select lang, size, array_to_string(ws[i : i + size - 1], ' ') as phrase
      from (select lang, ws, size, unnest(generate_series(1, len(ws) - size + 1)) as i
            from p, (select unnest([1, 2, 3, 4, 5]) as size) where len(ws) >= size)
    ), f as materialized (
      select lang, size, phrase, count(*) as f from grams group by all having count(*) >= 100
    ), cuts as (
      select lang, phrase, f as a, k, array_to_string(ws[:k], ' ') as first, array_to_string(ws[k + 1 :], ' ') as rest
      from (select *, string_split(phrase, ' ') as ws, unnest(generate_series(1, size - 1)) as k from f where size > 1)
    ), scored as (
      select c.lang, c.phrase, a, x.f as l, y.f as r, n,
             (1000::hugeint * a * n // (x.f::hugeint * y.f))::bigint as score, k
      from cuts c join f x on x.lang = c.lang and x.phrase = c.first
      join f y on y.lang = c.lang and y.phrase = c.rest join totals t on t.lang = c.lang
    ), best as (
      select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
    ), kept as (
      select * from best b
      where not exists (select 1 from f g where g.lang = b.lang and g.f >= b.a and g.phrase <> b.phrase
                        and contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' '))
    )
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
           phrase, a, l, r, n, score
    from kept qualify rank <= 2000
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return periodic.report(periodic.periodic_runs(docs, rewrite=periodic.planted))
