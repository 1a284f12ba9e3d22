"""DuckDB SQL that computes, by other means, what the registered queries return."""

from __future__ import annotations

LINES = r"""
lines as (
  select doc_id, unnest(string_split_regex(text, '\r\n|\r|\n')) as line from documents
)"""

GRAMS = LINES + r""",
line_words as (
  select doc_id, regexp_extract_all(line, '[a-zA-Z]+') as t from lines
),
starts as (
  select doc_id, t, unnest(generate_series(1, len(t))) as i from line_words where len(t) > 0
),
spans as (
  select doc_id, t, i, unnest(generate_series(1, least(5, len(t) - i + 1))) as size from starts
),
grams as (
  select doc_id, size, lower(array_to_string(t[i:i + size - 1], ' ')) as phrase from spans
)"""

COUNTS = GRAMS + """,
counts as materialized (select phrase, count(*) as cnt from grams group by phrase)"""

MODEL = COUNTS + r""",
frequent as (select phrase, cnt from counts where cnt > 2),
continuations as (
  select regexp_extract(phrase, '^(.*) ([^ ]*)$', 1) as prefix,
         regexp_extract(phrase, '^(.*) ([^ ]*)$', 2) as word, cnt
  from frequent where phrase like '% %'
),
ranked as (
  select prefix, word, cnt, row_number() over (partition by prefix order by cnt desc, word) as rank
  from continuations
),
model as materialized (
  select r.prefix, cast(r.rank as integer) as rank, r.word, r.cnt, r.cnt / f.cnt as prob
  from ranked r left join frequent f on f.phrase = r.prefix
  where r.rank <= 5
)"""

TERMS = r"""
benchmark_words as (select item_id, string_split(text, ' ') as w from benchmark),
asked_words as (
  select regexp_extract_all(line, '[a-zA-Z]+') as t
  from (select unnest(string_split_regex(text, '\r\n|\r|\n')) as line from benchmark)
),
asked_starts as (select t, unnest(generate_series(1, len(t))) as i from asked_words where len(t) > 0),
asked_spans as (select t, i, unnest(generate_series(1, least(4, len(t) - i + 1))) as size from asked_starts),
terms as (
  select lower(array_to_string(t[i:i + size - 1], ' ')) as term from asked_spans
  union select ' ' || chr(9) || upper(w[1]) || ' ' from benchmark_words
  union select 'qzx ' || item_id from benchmark_words
)"""

SUGGEST = (
    "with " + MODEL + "," + TERMS + r"""
select term, rank, word as label, prob as probability
from terms join model on model.prefix = lower(trim(term, ' ' || chr(9)))"""
)

# markup, a written-out line break and other characters replaced one after another
TOKENS = r"""
bare as (
  select cast(doc_id as varchar) as title,
         lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
           text, '<[^>]*>', ' ', 'g'), '\\n', ' ', 'g'), '[^a-zA-Z ]', ' ', 'g'), ' +', ' ', 'g'))) as body
  from documents
),
tokens as (select title, unnest(string_split(body, ' ')) as word from bare),
tf as materialized (select word, title, count(*) as tf from tokens group by all),
df as (select word, count(*) as df from tf group by word)"""


def _tfidf(total: str, where: str = "") -> str:
    return (
        "with " + TOKENS + f""",
total as (select {total} as n from tf)
select word, title, tf, df, floor(tf * ln(n / df) * 1e6 + 0.5) / 1e6 as score
from tf join df using (word), total {where}"""
    )


def _tfidf_term(term: str) -> str:
    return f"select title, score from ({_tfidf('sum(tf)')}) where word = '{term}'"


ARCS = """
steps as (
  select l_partkey as src,
         lead(l_partkey) over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey) as dst
  from lineitem
),
arcs as materialized (select distinct src, dst from steps where dst is not null),
nodes as (select p_partkey as id, p_name as title from part)"""


def _pagerank(steps: int, standard: bool) -> str:
    parts = [
        ARCS,
        """
degrees as materialized (select src, count(*) as degree from arcs group by src),
everyone as materialized (select id from nodes union select src from arcs),
size as (select count(*) as n from nodes),
r0 as (select id, cast(1 as double) as rank from everyone)""",
    ]
    for step in range(1, steps + 1):
        before = f"r{step - 1}"
        zeros = " union all select id, 0 from everyone" if standard else ""
        parts.append(
            f"""
d{step} as materialized (
  select coalesce(sum(rank), 0) as mass from {before} where id not in (select src from degrees)
),
r{step} as materialized (
  select id, 0.15 + (sum(share) + any_value(mass) / any_value(n)) * 0.85 as rank
  from (select dst as id, rank / degree as share
        from arcs join degrees using (src) join {before} r on r.id = src{zeros}), d{step}, size
  group by id
)"""
        )
    return "with " + ",".join(parts)


def _paths(seeds: int) -> str:
    return (
        "with recursive " + ARCS + f""",
seeds as (
  select dst as seed from arcs group by dst order by count(*) desc, dst limit {seeds}
),
reached(seed, id, len, parent, path) using key (seed, id) as (
  select seed, seed, 1, cast(null as bigint), cast(seed as varchar) from seeds
  union
  select r.seed, a.src, min(r.len) + 1, min(r.id), cast(a.src as varchar) || ' ' || arg_min(r.path, r.id)
  from reached r join arcs a on a.dst = r.id
  where not exists (select 1 from recurring.reached v where v.seed = r.seed and v.id = a.src)
  group by r.seed, a.src
)
select seed, id, cast(len as integer) as len, parent, path from reached"""
    )


USERS = """
users as (select c_custkey as userid, c_mktsegment as password, c_name as name from customer),
requests as (
  select c_custkey as userid, case when c_custkey % 3 = 0 then 'guess' else c_mktsegment end as password
  from customer
  union select c_custkey + 10000000000, 'x' from customer
  union select case when c_custkey % 2 = 0 then c_custkey end, case when c_custkey % 2 = 1 then c_mktsegment end
  from customer
),
answers as (
  select r.userid, r.password,
         case when r.userid is null or r.password is null then null else coalesce(u.name, 'Unauthorized') end as name,
         case when r.userid is null or r.password is null then 'bad request' end as err
  from requests r left join users u on u.userid = r.userid and u.password = r.password
)"""

FRIENDS = """
ids as (select count(*) + 10 as ids from customer),
friends as (
  select o_custkey as userid, cast(o_orderkey % ids as varchar) as friend from orders, ids
  union
  select o_custkey, cast((o_orderkey + o_custkey * 7) % ids as varchar) from orders, ids
)"""

PHOTOS = """
photos as (
  select o_custkey as userid, strftime(max(o_orderdate), '%Y-%m-%d') as time, cast(max(o_orderkey) as varchar) as url
  from orders group by o_custkey
)"""

PHOTO_LOOKUP = (
    "with " + USERS + "," + PHOTOS + """
select distinct r.userid, case when r.userid is not null then coalesce(time, '') end as time,
       case when r.userid is not null then coalesce(url, '') end as url,
       case when r.userid is null then 'bad request' end as err
from requests r left join photos p on p.userid = r.userid"""
)

TIMELINE = """,
entries as (
  select f.userid, f.friend, coalesce(u.name, 'Unauthorized') as name,
         coalesce(p.time, '') as time, coalesce(p.url, '') as url
  from (select distinct userid from answers where err is null and name <> 'Unauthorized') a
  join friends f on f.userid = a.userid
  left join users u on cast(u.userid as varchar) = f.friend
  left join photos p on cast(p.userid as varchar) = f.friend
),
entries_once as (
  select userid, time, name, url from (
    select *, row_number() over (partition by userid, time, name order by friend) as nth from entries
  ) where nth = 1
)"""

OPERATIONS = """
operations as (
  select event_id as op_id, ts, user_id as key, event_type in ('purchase', 'signup') as is_put,
         value, cast(event_id % 3 + 1 as integer) as loc
  from events
)"""

LATEST = (
    "with " + OPERATIONS + """
select key, arg_max(value, row(ts, op_id)) as value from operations where is_put group by key"""
)


# requests of workload.request_lines, as they are meant
ASKED = """
asked as (
  select '/step' || route || '?' || case kind
           when 0 then 'id=' || c_custkey when 1 then 'id=' || c_custkey || '&id=' || c_custkey when 2 then 'x=2'
           when 3 then 'id=' when 4 then '%69d=' || regexp_replace(cast(c_custkey as varchar), '([0-9])', '%3\\1', 'g')
           when 5 then 'id=%zz' || c_custkey when 6 then '&&x=1&id=' || c_custkey || '&=3&id2=7' else 'id' end
         || '&pwd=' || case when kind = 4 then '%' || hex(tried[1]) || tried[2:] else tried end
         || case when c_custkey % 11 = 0 then '&pwd=' else '' end || case when kind = 6 then '#id=5' else '' end as request,
         cast(route as varchar) as route,
         case when kind in (0, 4, 6) then cast(c_custkey as varchar) when kind in (3, 7) then '' end as userid,
         case when c_custkey % 11 <> 0 and kind <> 5 then tried end as password
  from (
    select *, (c_custkey + route) % 8 as kind, case when c_custkey % 3 = 0 then 'guess' else c_mktsegment end as tried
    from customer, generate_series(1, 4) t(route)
  )
)"""

ANSWERS = (
    "with " + USERS + "," + FRIENDS + "," + PHOTOS + """,
people as (select cast(userid as varchar) as userid, password, name from users),
photo_of as (select cast(userid as varchar) as userid, time, url from photos),
lists as (
  select cast(userid as varchar) as userid, string_agg(friend, ',' order by friend) as friends from friends group by userid
),
entries as (
  select f.userid, f.friend, coalesce(u.name, 'Unauthorized') as name, coalesce(p.time, '') as time, coalesce(p.url, '') as url
  from friends f left join people u on u.userid = f.friend left join photo_of p on p.userid = f.friend
),
shown as (
  select cast(userid as varchar) as userid, string_agg(time || '|' || name || '|' || url, ';' order by time, name) as photos from (
    select *, row_number() over (partition by userid, time, name order by friend) as nth from entries
  ) where nth = 1 group by userid
),""" + ASKED + """,
judged as (
  select distinct a.*, a.userid is null or (a.password is null and route in ('1', '4')) as bad, coalesce(u.name, 'Unauthorized') as said
  from asked a left join people u on u.userid = a.userid and u.password = a.password
)
select request, case when bad then 'bad request' end as err,
       case when not bad and route in ('1', '4') then said end as name,
       case when not bad and route = '2' then coalesce(friends, '') end as friends,
       case when not bad and route = '3' then coalesce(time, '') end as time,
       case when not bad and route = '3' then coalesce(url, '') end as url,
       case when not bad and route = '4' and said <> 'Unauthorized' then coalesce(photos, '') end as photos
from judged j left join lists l on l.userid = j.userid left join photo_of p on p.userid = j.userid
left join shown s on s.userid = j.userid"""
)

ADJACENCY = """
select distinct l_orderkey as src, l_partkey as dst
from lineitem where l_orderkey % 7 <> 0 and l_orderkey % 11 <> 0"""


AS_OF = (
    "with " + OPERATIONS + """,
gets as (select * from operations where not is_put),
puts as (select * from operations where is_put)
select g.op_id, g.key, g.ts, g.loc, arg_max(p.value, row(p.ts, p.op_id)) as value
from gets g left join puts p on p.key = g.key and (p.ts < g.ts or (p.ts = g.ts and p.op_id < g.op_id))
group by all"""
)


def oracle_sql() -> dict[str, str]:
    return {
        "ngrams": "with " + GRAMS + " select doc_id, phrase, count(*) as cnt from grams group by doc_id, phrase",
        "ngram_counts": "with " + COUNTS + " select phrase, cnt from counts",
        "language_model": "with " + MODEL + " select prefix, rank, word, cnt, prob from model",
        "language_model_levels": "with " + MODEL + " select prefix, rank, word, cnt, prob from model",
        "suggest": SUGGEST,
        "suggest_stream": SUGGEST,
        "suggest_lookup": SUGGEST,
        "language_model_kept": "with " + MODEL + " select prefix, rank, word, cnt, prob from model",
        "suggest_response": f"""
select term, cast(rank - 1 as integer) as place, label, probability from ({SUGGEST})""",
        "parse_pages": """
select cast(doc_id as varchar) as page_id, source as title, lang as date, chr(9) || text as body
from documents where doc_id % 7 <> 0
union all
select cast(doc_id as varchar), source, lang, text
from documents where doc_id % 7 = 0 and contains(text, chr(9))""",
        "page_tokens": "with " + TOKENS + " select title, word from tokens",
        "term_frequency": "with " + TOKENS + " select word, title, tf from tf",
        "document_frequency": "with " + TOKENS + " select word, df from df",
        "tfidf": _tfidf("sum(tf)"),
        "tfidf_documents": _tfidf("count(distinct title)"),
        "tfidf_term": _tfidf_term("the"),
        "pagerank": _pagerank(10, False) + " select id, floor(rank * 1e6 + 0.5) / 1e6 as rank from r10",
        "pagerank_standard": _pagerank(10, True) + " select id, floor(rank * 1e6 + 0.5) / 1e6 as rank from r10",
        "pagerank_top": _pagerank(10, False) + """
select title, floor(rank * 1e6 + 0.5) / 1e6 as rank from r10 join nodes using (id) order by 2 desc, id limit 100""",
        "shortest_paths_to": _paths(2),
        "shortest_paths_many": _paths(64),
        "parse_adjacency": ADJACENCY,
        "parse_requests": "with " + ASKED + " select request, route, userid, password from asked",
        "answer_requests": ANSWERS,
        "login": "with " + USERS + " select userid, password, name, err from answers",
        "friend_list": "with " + FRIENDS + " select userid, friend from friends",
        "login_response": "with " + USERS + " select userid, password, name, err from answers",
        "friends_response": "with " + USERS + "," + FRIENDS + """,
sorted as (
  select userid, friend, cast(row_number() over (partition by userid order by friend) - 1 as integer) as place
  from friends
)
select r.userid, case when r.userid is null then 'bad request' end as err, place, friend
from (select distinct userid from requests) r left join sorted s on s.userid = r.userid""",
        "photo_response": PHOTO_LOOKUP,
        "timeline_response": "with " + USERS + "," + FRIENDS + "," + PHOTOS + TIMELINE + """,
sorted as (
  select *, cast(row_number() over (partition by userid order by time, name) - 1 as integer) as place
  from entries_once
)
select a.userid, a.password, a.err, a.name as user, place, url, time, s.name
from answers a left join sorted s on s.userid = a.userid and a.name <> 'Unauthorized' and a.err is null""",
        "photo_lookup": PHOTO_LOOKUP,
        "timeline": "with " + USERS + "," + FRIENDS + "," + PHOTOS + TIMELINE + " select userid, time, name, url from entries_once",
        "photo_export": """
select cast(o_custkey as varchar) as userid,
       'url' || chr(3) || '{"s":"' || o_orderkey || '"}' || chr(2) ||
       'userid' || chr(3) || '{"n":"' || o_custkey || '"}' || chr(2) ||
       'time' || chr(3) || '{"s":"' || strftime(o_orderdate, '%Y-%m-%d') || '"}' as item
from orders where o_orderkey % 10 not in (0, 2)""",
        "kv_read_asof": AS_OF,
        # the watermark counts milliseconds
        "kv_read_asof_stream": f"select * from ({AS_OF}) where ts <= (select date_trunc('milliseconds', max(ts)) from events)",
        "kv_latest": LATEST,
        "kv_latest_stream": LATEST,
    }
