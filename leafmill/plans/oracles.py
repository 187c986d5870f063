"""The sample queries as DuckDB SQL over the same tables, written apart from the operators."""

# White space as Unicode has it; RE2's own class is ASCII only.
SPACE = (r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}"
         r"\x{3000}")
WORD = f"[^{SPACE}]+"


def words(text):
    return f"regexp_extract_all({text}, '{WORD}')"


def tokens(text):
    return rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"


LINES = """
    select cast(doc_id as varchar) as document_name, cast(pos - 1 as bigint) as pos,
        case when pos = 1 then 'title' else 'text' end as label, line as text,
        cast((pos - 1) // 10 + 1 as bigint) as page_no
    from (select doc_id, unnest(string_split(text, chr(10))) as line,
            generate_subscripts(string_split(text, chr(10)), 1) as pos from documents)
"""
TURNS = """
    select cast(conv_id as varchar) as document_name, cast(turn as bigint) as pos,
        case when role in ('system', 'user') then 'section_header' else 'text' end as label,
        text, cast(turn + 1 as bigint) as page_no
    from conversations
"""
BLOCK_TAGS = "title h1 h2 h3 h4 h5 h6 p li pre table".split()
BLOCK_PATTERN = "(?is)" + "|".join(rf"<{t}(?:\s[^>]*)?>.*?</{t}\s*>" for t in BLOCK_TAGS) + r"|<img(?:\s[^>]*)?>"
PAGES = rf"""
    select document_name, pos,
        case tag when 'title' then 'title' when 'p' then 'text' when 'li' then 'list_item' when 'pre' then 'code'
            when 'table' then 'table' when 'img' then 'picture' else 'section_header' end as label,
        case tag when 'img' then regexp_extract(block, '(?i)\salt\s*=\s*"([^"]*)"', 1)
            else regexp_replace(block, '<[^>]+>', '', 'g') end as text,
        cast(null as bigint) as page_no
    from (select *, lower(regexp_extract(block, '^<(\w+)', 1)) as tag from (
        select cast(page_id as varchar) as document_name, unnest(blocks) as block,
            cast(generate_subscripts(blocks, 1) - 1 as bigint) as pos
        from (select page_id, regexp_extract_all(html, '{BLOCK_PATTERN}') as blocks from pages)))
"""


def chunks(elements, size, overlap):
    """A list_reduce per document; the inner list_transform only gives a step a name."""
    closed = "list_append(b.done, {'held': b.held, 'page': b.page, 'section': b.section})"
    tail = f"""{{'t': case when len({words('x.t')}) > {overlap}
                then array_to_string({words('x.t')}[-{max(overlap, 1)}:], ' ') else x.t end,
            'n': least(x.n, {overlap}), 'label': x.label}}"""
    kept = f"[{tail}]" if overlap > 0 else "cast([] as struct(t varchar, n bigint, label varchar)[])"
    return f"""
    with elements as ({elements}),
    lists as (
        select document_name, list({{'t': text, 'n': cast(len({words('text')}) as bigint),
            'label': label, 'h': label in ('title', 'section_header'), 'page': page_no}} order by pos) as els
        from elements where regexp_matches(text, '{WORD}') group by 1),
    folded as (
        select document_name, list_reduce(els, lambda a, x: list_transform([{{
            'done': case when x.h and len(a.held) > 0 then list_append(
                a.done, {{'held': a.held, 'page': a.page, 'section': a.section}}) else a.done end,
            'held': list_append(case when x.h then a.held[:0] else a.held end,
                {{'t': x.t, 'n': x.n, 'label': x.label}}),
            'page': coalesce(x.page, a.page),
            'section': case when x.h then x.t else a.section end}}],
            lambda b: case when list_sum(list_transform(b.held, lambda e: e.n)) >= {size}
                then {{'done': {closed}, 'held': {kept}, 'page': b.page, 'section': b.section}}
                else b end)[1],
            {{'done': cast([] as struct(held struct(t varchar, n bigint, label varchar)[], page bigint, section varchar)[]),
              'held': cast([] as struct(t varchar, n bigint, label varchar)[]),
              'page': cast(1 as bigint), 'section': cast(null as varchar)}}) as state
        from lists),
    finished as (
        select document_name, case when len(state.held) > 0 then list_append(state.done,
            {{'held': state.held, 'page': state.page, 'section': state.section}})
            else state.done end as done from folded),
    parts as (
        select document_name, unnest(done) as c, generate_subscripts(done, 1) - 1 as i from finished),
    texts as (
        select document_name, cast(i as bigint) as chunk_index, c.page as page_number,
            coalesce(nullif(c.section, ''), 'Unknown') as section_title,
            array_to_string(list_transform(c.held, lambda e: e.t), ' ') as chunk_text,
            list_sort(list_distinct(list_transform(c.held, lambda e: e.label))) as types
        from parts)
    select printf('%s_chunk_%04d', document_name, chunk_index) as chunk_id, document_name,
        chunk_index, page_number, section_title, chunk_text,
        cast(len({words('chunk_text')}) as bigint) as word_count,
        cast(length(chunk_text) as bigint) as char_count,
        list_contains(types, 'table') as has_table,
        list_contains(types, 'picture') or list_contains(types, 'figure') as has_image,
        list_contains(types, 'code') as has_code,
        array_to_string(types, ',') as element_types
    from texts"""


LINE_CHUNKS = chunks(LINES, 64, 8)
TURN_CHUNKS = chunks(TURNS, 40, 5)


def chunk_statistics(source, by=""):
    return f"""select {by}count(*) as total_chunks, round(avg(length(chunk_text)), 4) as avg_length,
        min(cast(length(chunk_text) as bigint)) as min_length,
        max(cast(length(chunk_text) as bigint)) as max_length,
        cast(sum(length(chunk_text)) as bigint) as total_characters
    from ({source}) {'group by document_name' if by else ''}"""


NOTES = r"""
    select o_orderkey as doc_id, concat('Order ', o_orderkey, ' placed by ',
        upper(substr(c_mktsegment,1,1)), lower(substr(c_mktsegment,2)), ' Trading Corp. in ',
        upper(substr(r_name,1,1)), lower(substr(r_name,2)), ' on ', strftime(o_orderdate,'%m/%d/%Y'),
        ' for $', format('{:,.2f}', o_totalprice), ', ', cast(o_orderkey % 17 as varchar),
        '.5% off.') as text
    from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey
"""


def _tags():
    # The notes are ASCII, so RE2's ASCII word boundary is the right one.
    patterns = {
        "ORGANIZATION": (r"\b([A-Z][A-Za-z&]*(?:\s+[A-Z][A-Za-z&]*)*\s+(?:Inc|Corp|Corporation|Ltd|LLC|GmbH|PLC)\.?)\b", 1),
        "LOCATION": (r"\b(?:in|at|from|to|near)\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,2})\b", 1),
        "DATE": (r"(?i)\b(?:\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{4}[-/]\d{1,2}[-/]\d{1,2}|(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*\s+\d{1,2},?\s+\d{4})\b", 0),
        "MONEY": (r"(?i)\$\s*\d+(?:,\d{3})*(?:\.\d{2})?|\d+(?:,\d{3})*(?:\.\d{2})?\s*(?:USD|EUR|GBP|dollars?|euros?)", 0),
        "PERCENT": (r"(?i)\d+(?:\.\d+)?%|\d+(?:\.\d+)?\s*percent", 0),
    }
    found = " union all ".join(
        f"select doc_id, '{kind}' as entity_type, regexp_extract_all(text, '{p}', {g}) as hits from notes"
        for kind, (p, g) in patterns.items())
    stop = ("'Spark','Spark Engine','Docling','OpenSearch','Ingestion Solutions','Overview','Note',"
            "'It','The','This','That','These','Those','Apache Spark'")
    return f"""
    with notes as ({NOTES}), found as ({found}),
    spread as (
        select doc_id, entity_type, unnest(hits) as value, generate_subscripts(hits, 1) as place from found),
    firsts as (select doc_id, entity_type, value, min(place) as place from spread group by all),
    kept as (select * from firsts where entity_type <> 'LOCATION'
        or (value not in ({stop}) and length(value) > 2)),
    placed as (
        select *, row_number() over (partition by doc_id, entity_type order by place) - 1 as pos from kept),
    tags as (select doc_id, entity_type, cast(pos as bigint) as pos, value from placed where pos < 20)
    """


TAGS = _tags()


def vector(text):
    """Unit vector of token counts per bucket, as single-precision numbers."""
    found = f"case when len({tokens(text)}) > 0 then {tokens(text)} else [{text}] end"
    return f"""
        select id, bucket, cast(n / sqrt(sum(n * n) over (partition by id)) as float) as weight
        from (select id, cast(('0x' || substr(md5(token), 1, 8)) as bigint) % 64 as bucket,
                cast(count(*) as double) as n
            from (select id, unnest({found}) as token from texts) group by 1, 2)"""


def hashed(table, key, column="text"):
    return f"with texts as (select {key} as id, {column} as t from {table}) {vector('t')}"


def bm25(index, condition="true"):
    """``shares``: one row per (query, row, term). ``index`` gives id, text and lang."""
    return f"""
    rows as ({index}),
    asked as (select item_id as query_id, term, count(*) as times
        from (select item_id, unnest({tokens('text')}) as term from benchmark) group by 1, 2),
    lengths as (select id, len({tokens('text')}) as n from rows),
    corpus as (select count(*) as total, avg(n) as average from lengths),
    listed as (select id, term, count(*) as tf
        from (select id, unnest({tokens('text')}) as term from rows) group by 1, 2),
    holders as (select term, count(*) as df from listed group by 1),
    shares as (
        select a.query_id, l.id, a.times * ln(1 + (c.total - h.df + 0.5::double) / (h.df + 0.5::double))
            * l.tf / (l.tf + 1.2::double * (0.25::double + 0.75::double * n.n / c.average)) as share
        from asked a join listed l using (term) join holders h using (term)
        join lengths n on n.id = l.id join rows r on r.id = l.id cross join corpus c where {condition})"""


def ranked(source, k):
    return f"""
    select cast(query_id as bigint) as query_id, chunk_id, round(score, 6) as score, rank
    from (select query_id, chunk_id, score, row_number() over (
            partition by query_id order by score desc, chunk_id) as rank
        from ({source})) where rank <= {k}"""


DOCUMENTS = "select doc_id as id, text, lang from documents"
SUMMED = "select query_id, id as chunk_id, round(sum(share), 9) as score from shares group by 1, 2"

CENTROIDS = """
    with cells as (
        select label, generate_subscripts(embedding, 1) as place, unnest(embedding) as x from embeddings),
    means as (select label, place, avg(cast(x as double)) as mean from cells group by 1, 2),
    queries as (select label as query_id, list(mean order by place) as q from means group by 1)
"""


def nearest(condition="true", least=None, k=10):
    scored = f"""
        select query_id, vec_id as chunk_id,
            round((1 + list_cosine_similarity(cast(embedding as double[]), q)) / 2, 9) as score
        from embeddings, queries where {condition}"""
    if least is not None:
        scored = f"select * from ({scored}) where score >= {least}"
    return ranked(scored, k)


PLANES = """
    planes as (select bit, list(case when (('0x' || substr(md5(bit || ':' || place), 1, 1))::int) % 2 = 1
            then 1.0::double else -1.0::double end order by place) as plane
        from range(6) b(bit), range(64) p(place) group by bit)
"""

SOURCE_LINES = """
    select source as document_name, pos, case
            when n = 0 and doc_id % 10 = 0 then 'section_header' when contains(line, ' | ') then 'table'
            when contains(line, '%%%') then 'code' when contains(line, '***') then 'picture' else 'text' end as label,
        line as text, cast(pos // 10 + 1 as bigint) as page_no
    from (select *, cast(row_number() over (partition by source order by doc_id, n) - 1 as bigint) as pos
        from (select source, doc_id, unnest(string_split(text, chr(10))) as line,
            generate_subscripts(string_split(text, chr(10)), 1) - 1 as n from documents))
"""

TURN_ROWS = """
    select conv_id, role, printf('%d_chunk_%04d', conv_id, turn) as chunk_id, cast(conv_id as varchar) as document_name,
        text as chunk_text, cast(turn as bigint) as chunk_index,
        max(case when role = 'system' then 1 else 0 end) over (partition by conv_id) as led,
        count(*) over (partition by conv_id) as turns
    from conversations
"""

FOLDED_DOCUMENTS = f"with {bm25(DOCUMENTS)}"

ORACLES = {
    "chunk_lines": LINE_CHUNKS,
    "chunk_turns": TURN_CHUNKS,
    "chunk_pages": chunks(PAGES, 30, 0),
    "page_elements": f"select * from ({PAGES}) where regexp_matches(text, '{WORD}')",
    "turn_elements": TURNS,
    "parser_hook": LINES,
    "document_types": r"""
        with named as (
            select url as name from pages union all
            select source || '/' || lang || '/' || doc_id || (['.pdf', '.DOCX', '.doc', '.txt', '.md',
                '.html', '.HTM', '.tar.gz', ''])[doc_id % 9 + 1] from documents),
        split as (select name, regexp_extract(regexp_replace(name, '/+$', ''), '[^/]*$') as base from named)
        select name, case lower(regexp_extract(base, '.(\.[^.]+)$', 1))
                when '.pdf' then 'pdf' when '.docx' then 'word' when '.doc' then 'word'
                when '.txt' then 'text' when '.md' then 'markdown' when '.html' then 'html'
                when '.htm' then 'html' else 'unknown' end as document_type,
            regexp_replace(base, '(.)\.[^.]+$', '\1') as stem
        from split""",
    "sanitize": rf"""
        with dirty as (select doc_id, concat(chr(7), ' ', chr(9), replace(text, 'e', chr(1) || 'e' || chr(31)),
            chr(12), chr(10), chr(11), ' ') as t from documents)
        select doc_id, regexp_replace(regexp_replace(t, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'),
            '^[{SPACE}]+|[{SPACE}]+$', '', 'g') as clean, cast(length(t) as bigint) as before from dirty""",
    "file_size": """
        with sizes as (select o_orderkey, cast(round(o_totalprice * 100) as bigint)
            * (cast(1 as bigint) << cast(o_orderkey % 4 * 10 as int)) as bytes from orders)
        select o_orderkey, bytes, case
            when bytes < 1024 then printf('%.2f B', bytes / 1.0::double)
            when bytes < 1048576 then printf('%.2f KB', bytes / 1024.0::double)
            when bytes < 1073741824 then printf('%.2f MB', bytes / 1048576.0::double)
            when bytes < 1099511627776 then printf('%.2f GB', bytes / 1073741824.0::double)
            when bytes < 1125899906842624 then printf('%.2f TB', bytes / 1099511627776.0::double)
            else printf('%.2f PB', bytes / 1125899906842624.0::double) end as shown from sizes""",
    "stem_id": """
        select doc_id, lang || '.' || doc_id as stem,
            printf('%s_chunk_%04d', lang || '.' || doc_id, doc_id) as chunk_id,
            md5(source || '/' || lang || '.' || doc_id || '.txt|' || (doc_id % 7) || '|' || doc_id || '|'
                || substr(text, 1, 80)) as hash_id
        from documents""",
    "normalize_missing": """
        with given as (select text, coalesce(nullif(source, 'src0'), 'unknown') as name,
            coalesce(nullif(doc_id % 3, 0), 1) as page from documents),
        placed as (select *, row_number() over (partition by name order by page, text) - 1 as place from given)
        select md5(name || '|' || page || '|' || place || '|' || substr(text, 1, 80)) as chunk_id,
            text as chunk_text, name as document_name, cast(page as bigint) as page_number,
            'Unknown' as section_title, cast(place as bigint) as chunk_index from placed""",
    "entities_long": f"{TAGS} select * from tags",
    "entity_counts": f"""{TAGS} select entity_type, count(*) as found,
        count(distinct value) as different from tags group by 1""",
    "entity_totals": f"""{TAGS} select entity_count, count(*) as notes from (
        select n.doc_id, count(t.value) as entity_count from notes n left join tags t using (doc_id)
        group by 1) group by 1""",
    "chunk_stats": chunk_statistics(LINE_CHUNKS, "document_name, "),
    "chunk_stats_total": chunk_statistics(TURN_CHUNKS),
    "hash_embed": f"""select id as doc_id, bucket, round(cast(weight as double), 4) as weight
        from ({hashed('documents', 'doc_id')})""",
    "provider_embed": """select doc_id, cast(length(text) as bigint) as length,
        cast(length(text) - length(replace(text, chr(10), '')) as bigint) as breaks from documents""",
    "dim_check": """select label, bool_and(len(embedding) = 64) as agree,
        bool_and(len(embedding) = 65) as agree_65,
        count(*) filter (len(list_filter(embedding, lambda x: x <> 0)) > 0) as nonzero
        from embeddings group by 1""",
    "attach_vectors": """select doc_id, lang, round(list_sum(cast(embedding as double[])), 5) as total
        from documents join embeddings on doc_id % (select count(*) from embeddings) = vec_id""",
    "postings": f"""select term, count(distinct doc_id) as documents, count(*) as occurrences
        from (select doc_id, unnest({tokens('text')}) as term from documents) group by 1""",
    "bm25_topk": f"{FOLDED_DOCUMENTS} {ranked(SUMMED, 10)}",
    "bm25_filtered": "with " + bm25(DOCUMENTS, "r.lang = 'en'") + ranked(SUMMED, 10),
    "knn_topk": CENTROIDS + nearest(),
    "knn_filtered": CENTROIDS + nearest("label = 3"),
    "knn_min_score": CENTROIDS + nearest(least=0.7),
    "knn_many": "with queries as (select vec_id as query_id, cast(embedding as double[]) as q from embeddings)" + nearest(k=3),
    "zero_vectors": """select label, count(*) filter (label <> 3) as nonzero, count(*) filter (label <> 3) as valid,
        count(*) as vectors from embeddings group by 1""",
    "chunk_long": chunks(SOURCE_LINES, 64, 8),
    "store_upsert_replace": f"""select chunk_id, document_name,
            case when led = 1 then chunk_text || ' again' else chunk_text end as chunk_text, chunk_index
        from ({TURN_ROWS}) where (led = 0 and turns > 1) or (led = 1 and role <> 'user')""",
    "store_delete": f"select chunk_id, document_name, chunk_text, chunk_index from ({TURN_ROWS}) where led = 0",
    "store_counts": f"""select 'before' as state, cast(0 as bigint) as document_count
        union all select 'filled', count(*) from conversations
        union all select 'deleted', count(*) from ({TURN_ROWS}) where led = 0""",
    "run_manifest": f"""select 'only' as batch_id, document_name, 'success' as status, count(*) as n_chunks
        from ({TURN_CHUNKS}) group by document_name""",
    "knn_approximate": CENTROIDS + f""", {PLANES},
        homes as (select vec_id, sum(case when list_dot_product(cast(embedding as double[]), plane) >= 0
            then 1 << bit else 0 end)::int as cell from embeddings, planes group by 1),
        probes as (select distinct query_id, xor(cell, flip) as cell from
            (select query_id, sum(case when list_dot_product(q, plane) >= 0 then 1 << bit else 0 end)::int
                as cell from queries, planes group by 1),
            (select 0 as flip union all select (1 << b)::int from range(6) r(b)))
        """ + nearest("(query_id, vec_id) in (select query_id, vec_id from homes join probes using (cell))"),
    "hybrid_topk": f"""
        with {bm25(DOCUMENTS)},
        dv as (select id, list({{'b': bucket, 'w': weight}}) as v from ({hashed('documents', 'doc_id')}) group by 1),
        de as ({hashed('documents', 'doc_id')}), qe as ({hashed('benchmark', 'item_id')}),
        dn as (select id, sqrt(sum(cast(weight as double) * weight::double)) as norm from de group by 1),
        qn as (select id, sqrt(sum(cast(weight as double) * weight::double)) as norm from qe group by 1),
        dots as (select q.id as query_id, d.id as id, sum(q.weight::double * d.weight::double) as dot
            from qe q join de d using (bucket) group by 1, 2),
        sims as (select query_id, dots.id, round((1 + dot / dn.norm / qn.norm) / 2, 9) as score
            from dots join dn on dn.id = dots.id join qn on qn.id = query_id),
        near as (select * from (select *, row_number() over (
            partition by query_id order by score desc, id) as r from sims) where r <= 10),
        both_shares as (select query_id, id, 0.4::double * share as share from shares
            union all select query_id, id, 0.6::double * score from near)
        {ranked("select query_id, id as chunk_id, round(sum(share), 9) as score from both_shares group by 1, 2", 10)}""",
    "search_with_source": f"""
        with chunked as ({TURN_CHUNKS}),
        {bm25("select chunk_id as id, chunk_text as text, '' as lang from chunked")}
        select h.query_id, h.chunk_id, score, rank, document_name, section_title
        from ({ranked(SUMMED, 3)}) h join chunked using (chunk_id)""",
    "upsert_latest": """
        with old as (select *, row_number() over (
                partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r
            from orders where o_orderstatus in ('F', 'O')),
        new as (select *, row_number() over (
                partition by o_custkey order by o_orderdate desc, o_orderkey desc) as r
            from orders where o_orderstatus in ('O', 'P'))
        select cast(o_custkey as varchar) as chunk_id, o_orderkey, o_orderdate, o_orderstatus, o_totalprice
        from new where r = 1
        union all
        select cast(o_custkey as varchar), o_orderkey, o_orderdate, o_orderstatus, o_totalprice
        from old where r = 1 and o_custkey not in (select o_custkey from new)""",
    "delete_document": f"""select document_name, count(*) as chunks from ({LINE_CHUNKS})
        where document_name not in (select cast(doc_id as varchar) from labels where toxic = 1)
        group by 1""",
    "resume_skip": """select cast(doc_id as varchar) as document_name, lang, n_chars from documents
        where doc_id not in (select doc_id from labels where quality = 1)""",
    "merge_metadata": """
        with base as (
            select event_id, 'kind' as key, event_type as value from events union all
            select event_id, 'user', cast(user_id as varchar) from events union all
            select event_id, 'props', props from events),
        extra as (
            select event_id, 'kind' as key, nullif(upper(event_type), 'ERROR') as value from events union all
            select event_id, case when user_id % 2 = 0 then 'user' else 'user_id' end, 'changed' from events)
        select event_id, key, value from extra union all
        select event_id, key, value from base b
        where not exists (select 1 from extra e where e.event_id = b.event_id and e.key = b.key)""",
    "batch_ids": """select doc_id, source, cast((row_number() over (
        partition by source order by doc_id) - 1) // 7 as bigint) as batch_id from documents""",
    "batch_sizes": """select batch_id, count(*) as rows, min(o_orderkey) as first, max(o_orderkey) as last
        from (select o_orderkey, cast((row_number() over (order by o_orderkey) - 1) // 500 as bigint)
            as batch_id from orders) group by 1""",
    "ingest_conversations": TURN_CHUNKS,
    "index_stats": f"select 'index' as index_name, count(*) as document_count from ({TURN_CHUNKS})",
    "json_roundtrip": TURN_CHUNKS,
}
