"""SQL for the registered queries, written for DuckDB over the same tables."""

from catalog.inputs import BLACKLIST

WS = r"\pZ\x{09}-\x{0D}\x{1C}-\x{1F}\x{85}"
# First name of x[1] that is not in acc; for slugs well under the length limit.
FREE_NAME = """list_filter(list_transform(range(0, len(acc) + 1), lambda n: CASE n WHEN 0 THEN x[1] ELSE x[1] || '-' || n END),
        lambda c: NOT list_contains(acc, c))[1]"""
URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def strip(x):
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def slug(base, headline):
    kept = rf"regexp_replace(lower({base}), '[^\pL\pN_{WS}-]', '', 'g')"
    cut = f"left(trim(regexp_replace({kept}, '[-{WS}]+', '-', 'g'), '-'), 100)"
    return f"coalesce(nullif({cut}, ''), {hash_slug(headline)})"


def hash_slug(headline):
    return f"'article-' || left(sha1({headline}), 8)"


def headline_slug(x):
    kept = f"regexp_replace(lower({x}), '[^a-z0-9{WS}-]', '', 'g')"
    return f"trim(regexp_replace({kept}, '[-{WS}]+', '-', 'g'), '-')"


def numbered(base, k):
    """k-th name of a slug, k from 0."""
    n = f"({k} - (length({base}) = 99)::INT)"
    tail = f"('~' || left(sha1({base}), 16) || '-' || {n})"
    return f"""CASE WHEN {k} = 0 THEN {base}
        WHEN length({base}) = 99 AND {k} = 1 THEN {base} || '-'
        WHEN length({base} || '-' || {n}) <= 100 THEN {base} || '-' || {n}
        ELSE left({base}, 100 - length({tail})) || {tail} END"""


def parts(x):
    """Select items: scheme, u_netloc, ..., params (par), path without them (path0), bad."""
    return f"""regexp_extract({x}, '{URL}', ['scheme', 'netloc', 'path', 'query', 'fragment']) AS u,
        lower((u)['scheme']) AS scheme, (u)['netloc'] AS u_netloc, (u)['path'] AS u_path,
        (u)['query'] AS u_query, (u)['fragment'] AS u_fragment,
        regexp_extract(u_path, '[^/]*$') AS lastseg,
        CASE WHEN scheme IN ('', 'http', 'https', 'ftp') AND contains(lastseg, ';')
             THEN lastseg[strpos(lastseg, ';') + 1:] END AS par,
        CASE WHEN par IS NULL THEN u_path ELSE left(u_path, length(u_path) - length(par) - 1) END AS path0,
        contains(u_netloc, '[') <> contains(u_netloc, ']') AS bad"""


def join_url(path, query, fragment):
    return f"""{path} || coalesce(';' || nullif(par, ''), '') AS rel,
        coalesce(nullif(scheme, '') || ':', '')
        || CASE WHEN u_netloc <> '' THEN '//' || u_netloc || CASE WHEN rel <> '' AND NOT starts_with(rel, '/') THEN '/' ELSE '' END || rel
                WHEN starts_with(rel, '//') THEN '//' || rel
                WHEN scheme IN ('http', 'https', 'ftp') AND (rel = '' OR starts_with(rel, '/')) THEN '//' || rel
                ELSE rel END
        || coalesce('?' || nullif({query}, ''), '') || coalesce('#' || nullif({fragment}, ''), '') AS joined"""


def clean_local(x):
    """Select items ending in `clean`."""
    return f"""regexp_replace(trim(regexp_replace({x}, '[^ -~]', '', 'g'), ' '), ' +', '-', 'g') AS tidy,
        {parts('tidy')},
        replace(url_encode(path0), '%2F', '/') AS pathx,
        replace(replace(url_encode(u_query), '%3D', '='), '%26', '&') AS queryx,
        {join_url('pathx', 'queryx', 'u_fragment')},
        CASE WHEN {x} = '' OR {x} IS NULL THEN {x} WHEN bad THEN tidy ELSE joined END AS clean"""


def clean_ci(x):
    pair = f"CASE WHEN contains(p, '=') THEN {strip('p[1:strpos(p, chr(61)) - 1]')} || '=' || {strip('p[strpos(p, chr(61)) + 1:]')} ELSE p END"
    return rf"""{strip(rf"regexp_replace({x}, '\pC', '', 'g')")} AS tidy,
        {parts('tidy')},
        list_filter(list_transform(string_split(path0, '/'), lambda s: {strip('s')}), lambda s: s <> '') AS segs,
        CASE WHEN len(segs) > 0 THEN '/' || array_to_string(segs, '/') ELSE '' END AS pathx,
        list_filter(list_transform(string_split(u_query, '&'), lambda s: {strip('s')}), lambda s: s <> '') AS pairs,
        array_to_string(list_transform(pairs, lambda p: {pair}), '&') AS queryx,
        {join_url('pathx', 'queryx', strip('u_fragment'))},
        CASE WHEN {x} = '' OR {x} IS NULL THEN {x} WHEN bad THEN NULL ELSE joined END AS clean"""


def resolve(href, base):
    return f"""CASE WHEN starts_with({href}, 'http://') OR starts_with({href}, 'https://') THEN {href}
        WHEN starts_with({href}, '//') THEN lower(regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || ':' || {href}
        ELSE rtrim({base}, '/') || '/' || ltrim({href}, '/') END"""


PREFIXES = "prefixes AS (SELECT * FROM (VALUES " + ", ".join(f"('{u}')" for u in BLACKLIST) + ") AS t(prefix))"


def listed(x):
    return f"EXISTS (SELECT 1 FROM prefixes WHERE starts_with({x}, prefix))"


HOST_PREFIXES = r"""prefixes AS (SELECT DISTINCT regexp_extract(url, '^(https?://[^/]+/de/)', 1) AS prefix FROM pages
    WHERE regexp_matches(url, '^https?://[^/]+/de/'))"""

REGISTRY = """registry AS (SELECT s_suppkey AS id, 'src' || s_suppkey AS name,
        CASE WHEN s_suppkey = 4 THEN 'http://[broken' ELSE 'http://www.src' || s_suppkey || '.example.com' END AS host,
        CASE WHEN s_suppkey <> 5 THEN host || '/' END AS base, s_acctbal >= 1000 AS execute FROM supplier)"""

HREFS = """hrefs AS (SELECT page_id, page_url, unnest(l) AS href, generate_subscripts(l, 1) - 1 AS pos
    FROM (SELECT page_id, url AS page_url, list_concat([url], regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS l FROM pages))"""

LINES = """lines AS (SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos,
    unnest(string_split(text, chr(10))) AS headline FROM documents)"""
WORD_PREFIXES = r"""prefixes AS (SELECT DISTINCT 'https://cdn.example.net/a/' || word AS prefix FROM (
    SELECT unnest(regexp_extract_all(text, '([^ \n.]+)[.]', 1)) AS word FROM documents))"""
KNOWN = f"""known AS (WITH {LINES} SELECT DISTINCT 'http://www.' || source || '.example.com/../' || split_part(headline, ' ', 1) || '%2520x' AS url FROM lines)"""


def outcome(url_mode="local", quarantine=False, max_items=None, prefixes=PREFIXES):
    """CTEs down to `outcome`, the cleaned items and rejects of all responses."""
    clean = clean_local("built") if url_mode == "local" else clean_ci("built")
    limit = f"AND pos < {max_items}" if max_items else ""
    # With a limit, the odd first item counts as well; without quarantine such
    # batches fail anyway.
    odd = "text LIKE '%|'"
    lost = f"WHEN {odd} THEN 'bad_batch'" if not quarantine else ""
    return rf"""{REGISTRY}, {prefixes},
    docs AS (
        SELECT d.doc_id AS response_id, d.source, d.text, r.base AS base_url,
            CASE WHEN r.name IS NULL THEN 'unknown_source' WHEN NOT r.execute THEN 'source_disabled'
                 WHEN doc_id % 41 = 7 THEN 'empty_response' WHEN doc_id % 41 = 8 THEN 'parse_error'
                 WHEN {odd} AND lang NOT IN ('en', 'fr', 'de') AND NOT contains(text, chr(10)) THEN 'parse_error'
                 {lost} END AS failure
        FROM documents d LEFT JOIN registry r ON r.name = d.source),
    parts AS (
        SELECT response_id, source, base_url, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n, n + ({odd})::INT AS pos
        FROM docs WHERE failure IS NULL),
    raw AS (
        SELECT response_id, source, base_url, n, pos, split_part(line, ' ', 1) AS word, n % 5 AS kind,
            CASE WHEN contains(line, ' ') THEN {strip('line')} ELSE '' END AS headline,
            CASE WHEN length(line) < 20 THEN ''
                 WHEN kind = 0 THEN '/news/' || word || ' ' || n
                 WHEN kind = 1 THEN 'https://cdn.example.net/a/' || word || ';b,c?q=' || word || ' x&n=' || n || '#s ' || n
                 WHEN kind = 2 THEN '//m.example.org/' || word || '//' || n || '/'
                 WHEN kind = 3 THEN 'story/' || n || '.html;v=1'
                 ELSE '../' || word || '%20x' END AS href,
            CASE WHEN kind = 3 THEN 'ID ' || word ELSE '' END AS given,
            CASE WHEN starts_with(lower(word), 'th') THEN 'http://spam-farm.example.org/' || n ELSE '' END AS supplied,
            '2024-01-' || lpad((1 + n % 28)::VARCHAR, 2, '0') AS published_at,
            CASE WHEN headline = '' THEN 'missing_headline' WHEN href = '' THEN 'missing_href' END AS reason0
        FROM parts WHERE TRUE {limit}),
    based AS (SELECT *, {slug("coalesce(nullif(given, ''), headline)", 'headline')} AS base FROM raw WHERE reason0 IS NULL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY response_id, base ORDER BY pos) - 1 AS k,
            {resolve('href', 'base_url')} AS built FROM based),
    cleaned AS (SELECT *, {numbered('base', 'k')} AS id, {clean} FROM ranked),
    outcome AS (
        SELECT response_id, pos, id, source, headline, href, clean AS url, published_at, FALSE AS "isProcessed",
            CASE WHEN base_url IS NULL AND NOT starts_with(href, 'http') THEN 'url_error'
                 WHEN starts_with(href, '//') AND contains(base_url, '[') THEN 'url_error'
                 {"WHEN bad THEN 'url_error'" if url_mode == "ci" else ""}
                 WHEN {listed('supplied')} THEN 'blacklisted_supplied'
                 WHEN {listed('clean')} THEN 'blacklisted_built' END AS reason
        FROM cleaned
        UNION ALL
        SELECT response_id, pos, NULL, source, headline, href, NULL, published_at, FALSE, reason0 FROM raw WHERE reason0 IS NOT NULL
        {f"UNION ALL SELECT response_id, 0, NULL, source, '', '', NULL, '', FALSE, 'bad_item' FROM docs WHERE failure IS NULL AND {odd}" if quarantine else ""}
        UNION ALL
        SELECT response_id, NULL, NULL, source, NULL, NULL, NULL, NULL, FALSE, failure FROM docs WHERE failure IS NOT NULL)"""


ITEM = 'response_id, pos, id, source, headline, href, url, published_at, "isProcessed"'
ACCEPTED = f"SELECT {ITEM} FROM outcome WHERE reason IS NULL"
ARTICLE = 'id AS "uniqueName", source, headline, href, url, published_at AS "publishedAt", FALSE AS "isProcessed"'
RESOLVED = """resolved AS (SELECT o.*, r.id AS source_id FROM outcome o LEFT JOIN registry r ON upper(r.name) = upper(o.source)
    WHERE o.reason IS NULL)"""
STORED = 'id AS "uniqueName", source_id AS source, headline, href, url, published_at AS "publishedAt", FALSE AS "isProcessed"'

NATION_IDS = """ids AS (SELECT upper(name) AS source_key, max(id) AS source_id FROM (
        SELECT n_nationkey AS id, n_name AS name FROM nation
        UNION ALL SELECT n_nationkey + 100, lower(n_name) FROM nation WHERE n_regionkey = 1) GROUP BY 1)"""
CUSTOMERS = """found AS (SELECT c_name AS id, source, source_id FROM (
        SELECT c_name, 'nation_' || (c_nationkey + CASE WHEN c_acctbal < 0 THEN 50 ELSE 0 END) AS source FROM customer)
    LEFT JOIN ids ON source_key = upper(source))"""


def visible(x):
    text = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    for entity, char in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&#39;", "chr(39)"), ("&apos;", "chr(39)"),
                         ("&nbsp;", "chr(160)"), ("&middot;", "chr(183)"), ("&copy;", "chr(169)"), ("&amp;", "'&'")):
        text = f"replace({text}, '{entity}', {char})"
    return strip(f"regexp_replace({text}, '[{WS}]+', ' ', 'g')")


PAGE_ITEMS = rf"""found AS (SELECT page_id, url, {visible("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1[^>]*>', 1)")} AS headline,
        replace(regexp_extract(url, '://([^/?#]*)', 1), 'www.', '') AS source, {headline_slug('headline')} AS id
    FROM pages WHERE headline <> '')"""

PER_REASON = "SELECT source, reason, count(*) AS n_rows, count(url) AS n_urls, max(url) AS last_url FROM outcome GROUP BY 1, 2"

ORACLES = {
    "articles_per_site": f"""WITH {PREFIXES}, {PAGE_ITEMS}, cleaned AS (SELECT source, id, {clean_local('found.url')} FROM found)
        SELECT source, count(*) AS n_items, count(DISTINCT id) AS n_slugs FROM cleaned WHERE NOT {listed('clean')} GROUP BY source""",
    "sources_enabled": f"""WITH {REGISTRY} SELECT name, host || '/latest' AS url, base AS base_url, execute,
        FALSE AS primary_source FROM registry WHERE execute""",
    "team_sources": """SELECT c_custkey AS id, '2023-01-01T00:00:00Z' AS created_at, 'http://team' || c_custkey || '.example.com/news' AS url,
        'http://team' || c_custkey || '.example.com' AS base_url, c_name AS team, TRUE AS execute
        FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "source_ids": f"WITH {NATION_IDS} SELECT * FROM ids",
    "blacklist_scan": f"WITH {HOST_PREFIXES} SELECT prefix AS url FROM prefixes",
    "blacklist_file": f"WITH {HOST_PREFIXES} SELECT prefix AS url FROM prefixes",
    "raw_decoded": "SELECT doc_id AS response_id, text || chr(65533) || ' ' || chr(65533) AS content FROM documents",
    "existing_topk": f"""WITH {outcome()} SELECT {ARTICLE} FROM outcome WHERE reason IS NULL
        ORDER BY id, url, source, headline, href, published_at LIMIT 50""",
    "control_chars": r"SELECT doc_id, regexp_replace(text, '\pC', '', 'g') AS text FROM documents",
    "strip_text": f"SELECT doc_id, {strip('text')} AS text FROM documents",
    "slug_item": f"""WITH {LINES} SELECT doc_id, pos, {slug("CASE WHEN source = 'src3' THEN 'No. ' || headline ELSE headline END", 'headline')} AS slug FROM lines""",
    "slug_headline": f"WITH {LINES} SELECT doc_id, pos, {headline_slug('headline')} AS slug FROM lines",
    "slug_hash": f"WITH {LINES} SELECT doc_id, pos, {hash_slug('headline')} AS slug FROM lines",
    "slug_unique": f"""WITH {LINES}, based AS (SELECT doc_id, source, pos, {slug('headline', 'headline')} AS slug FROM lines),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY source, pos, slug ORDER BY doc_id) - 1 AS k FROM based)
        SELECT doc_id, source, pos, slug, {numbered('slug', 'k')} AS unique_slug FROM ranked""",
    "slug_unique_numbered": f"""WITH slugged AS (SELECT CASE WHEN user_id % 7 <> 3 THEN user_id END AS user_id, event_id,
            CASE WHEN value < 10 THEN event_type || '-' || (props::JSON ->> '$.k') ELSE event_type END AS slug FROM events),
        batches AS (SELECT user_id, list(event_id ORDER BY event_id) AS ids, list(slug ORDER BY event_id) AS slugs FROM slugged GROUP BY user_id),
        named AS (SELECT *, list_reduce(list_transform(slugs, lambda s: [s]), lambda acc, x: list_concat(acc, [{FREE_NAME}]), []::VARCHAR[]) AS names FROM batches)
        SELECT user_id, unnest(ids) AS event_id, unnest(slugs) AS slug, unnest(names) AS unique_slug FROM named""",
    "slug_unique_in_row": f"""WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
        slugged AS (SELECT doc_id, list_transform(lines, lambda l: CASE WHEN contains(l, ' ') THEN left({slug('l', 'l')}, 90)
            ELSE left(lower(l), 1) || CASE WHEN length(l) % 3 > 0 THEN '-' || (length(l) % 9) ELSE '' END END) AS slugs FROM lines),
        named AS (SELECT *, list_reduce(list_transform(slugs, lambda s: [s]), lambda acc, x: list_concat(acc, [{FREE_NAME}]), []::VARCHAR[]) AS names FROM slugged)
        SELECT doc_id, generate_subscripts(names, 1) - 1 AS pos, unnest(names) AS unique_slug FROM named""",
    "url_parts": f"""WITH {HREFS}, split AS (SELECT *, {parts('href')} FROM hrefs)
        SELECT page_id, pos, href, scheme, u_netloc AS netloc, path0 AS path, coalesce(par, '') AS params,
        u_query AS query, u_fragment AS fragment FROM split""",
    "url_valid": f"WITH {HREFS}, split AS (SELECT *, {parts('href')} FROM hrefs) SELECT page_id, pos, scheme <> '' AND u_netloc <> '' AND NOT bad AS valid FROM split",
    "url_domain": f"WITH {HREFS}, split AS (SELECT *, {parts('href')} FROM hrefs) SELECT page_id, pos, replace(u_netloc, 'www.', '') AS domain FROM split",
    "url_path": f"WITH {HREFS}, split AS (SELECT *, {parts('href')} FROM hrefs) SELECT page_id, pos, path0 AS path FROM split",
    **{
        f"url_clean_{mode}": f"""WITH {HREFS}, odd AS (SELECT page_id, pos,
            CASE WHEN pos > 3 THEN href || ' ;p= 1?a = b &&c#f ' ELSE href END AS odd_href FROM hrefs),
            cleaned AS (SELECT *, {clean('odd_href')} FROM odd) SELECT page_id, pos, clean FROM cleaned"""
        for mode, clean in (("local", clean_local), ("ci", clean_ci))
    },
    "url_error": f"""WITH {HREFS}, odd AS (SELECT page_id, pos, replace(href, '//www.', '//[') AS odd_href FROM hrefs),
        cleaned AS (SELECT *, {clean_local('odd_href')} FROM odd) SELECT page_id, pos, clean, bad AS url_bad FROM cleaned""",
    "href_resolve": f"WITH {HREFS} SELECT page_id, pos, {resolve('href', 'page_url')} AS url FROM hrefs",
    "blacklist_nlj": f"WITH {PREFIXES} SELECT page_id, url FROM pages WHERE NOT {listed('url')}",
    "blacklist_prefix_hash": f"WITH {HOST_PREFIXES} SELECT page_id, url FROM pages WHERE NOT {listed('url')}",
    "source_id_lookup": f"WITH {NATION_IDS}, {CUSTOMERS} SELECT id, source_id FROM found WHERE source_id <> 0",
    "source_id_rejects": f"""WITH {NATION_IDS}, {CUSTOMERS} SELECT id, source, 'no_source_id' AS reason FROM found
        WHERE source_id IS NULL OR source_id = 0""",
    "source_attached": f"""WITH {REGISTRY} SELECT source AS source_name, doc_id, base AS base_url,
        CASE WHEN name IS NULL THEN 'unknown_source' END AS source_failure
        FROM documents LEFT JOIN (SELECT * FROM registry WHERE execute) ON name = source""",
    "page_items": f"""WITH {PAGE_ITEMS} SELECT page_id, id, source, headline, url AS href, url, '' AS published_at FROM found""",
    "page_anchors": rf"""WITH bodies AS (SELECT page_id, url AS page_url,
            regexp_replace(html, '(?is)<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>', ' ', 'g') AS body FROM pages),
        lists AS (SELECT page_id, page_url, regexp_extract_all(body, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a\s*>', 1) AS h,
            regexp_extract_all(body, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a\s*>', 2) AS t FROM bodies),
        anchors AS (SELECT page_id, page_url, unnest(h) AS href, unnest(t) AS label, generate_subscripts(h, 1) - 1 AS pos FROM lists),
        found AS (SELECT *, {visible('label')} AS headline, regexp_extract(page_url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS base FROM anchors)
        SELECT page_id, pos, {headline_slug('headline')} AS id, replace(regexp_extract(page_url, '://([^/?#]*)', 1), 'www.', '') AS source,
            headline, href, {resolve('href', 'base')} AS url, '' AS published_at FROM found WHERE headline <> ''""",
    "page_anchors_named": rf"""WITH {PAGE_ITEMS} SELECT page_id, 0 AS pos, id, source, headline, '/story?a=1' AS href,
        regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/story?a=1' AS url, '' AS published_at
        FROM found WHERE len(list_filter(string_split(headline, ' '), lambda w: w <> '')) >= 2""",
    "page_candidates": rf"""WITH {PAGE_ITEMS.replace("SELECT page_id, url,", "SELECT page_id, url, html, length(html) % 6 AS kind,")},
        varied AS (SELECT *, CASE kind WHEN 0 THEN '/story/1?a=b' WHEN 1 THEN '/x' WHEN 2 THEN '/y' WHEN 4 THEN url ELSE url END AS href,
            CASE kind WHEN 3 THEN {visible("regexp_extract(html, '(?is)<h1>(.*?)</article>', 1)")} WHEN 4 THEN NULL ELSE headline END AS head FROM found)
        SELECT page_id, CASE WHEN kind <> 4 THEN 0 END AS pos, CASE WHEN kind <> 4 THEN {headline_slug('head')} END AS id, source, head AS headline,
            href, {resolve('href', "regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)")} AS url, '' AS published_at,
            CASE kind WHEN 0 THEN 'h2' WHEN 1 THEN '.article' WHEN 2 THEN 'a[data-qa*=''headline'']' WHEN 4 THEN NULL ELSE 'article' END AS selector,
            CASE WHEN kind = 4 THEN 'no_candidate' WHEN len(string_split(head, ' ')) < 2 THEN 'short_headline' END AS reason FROM varied""",
    "union_all_sources": f"""WITH {outcome()}, {PAGE_ITEMS} SELECT source, headline, url FROM outcome WHERE reason IS NULL
        UNION ALL SELECT source, headline, url FROM found""",
    "json_locate": """SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN '[' || props || ']' ELSE props END AS json_text FROM events""",
    "json_items": """SELECT event_id, CASE event_type WHEN 'view' THEN 2 WHEN 'click' THEN 2 WHEN 'error' THEN -1 ELSE 1 END AS n_items,
        CASE WHEN event_type = 'click' THEN 5 WHEN event_type <> 'error' THEN (props::JSON ->> '$.k')::BIGINT END AS k FROM events""",
    "json_items_torn": """SELECT event_id, 4 AS n_items, 1 AS n_bad, (event_type = 'click')::INT AS n_large, (props::JSON ->> '$.k')::BIGINT AS k FROM events""",
    "clean_batch": f"WITH {outcome()} {ACCEPTED}",
    "clean_batch_ci": f"WITH {outcome('ci')} {ACCEPTED}",
    "clean_batch_quarantine": f"WITH {outcome(quarantine=True)} {ACCEPTED}",
    "clean_batch_first_items": f"WITH {outcome(max_items=10)} {ACCEPTED}",
    "clean_batch_long_blacklist": f"WITH {outcome(prefixes=WORD_PREFIXES)} {PER_REASON}",
    "response_accounting": f"""WITH {outcome()} SELECT response_id, count(*) FILTER (reason IS NULL) AS n_items,
        count(reason) AS n_rejects FROM outcome GROUP BY response_id""",
    "batch_rejects": f"WITH {outcome()} SELECT response_id, pos, id, source, reason FROM outcome WHERE reason IS NOT NULL",
    "ordered_items": f"""WITH {outcome()} SELECT o.* EXCLUDE (reason) FROM outcome o LEFT JOIN registry r ON r.name = o.source
        WHERE reason IS NULL ORDER BY r.id, response_id, pos""",
    "require_fields": f"""WITH {LINES} SELECT doc_id, pos, CASE WHEN NOT contains(headline, ' ') THEN 'missing_headline'
        WHEN length(headline) <= 20 THEN 'missing_href' END AS reason FROM lines""",
    "finalize_items": f"""WITH {outcome()} SELECT id, source, headline, href, url, '' AS published_at, FALSE AS "isProcessed"
        FROM outcome WHERE reason IS NULL""",
    "format_articles": f"WITH {outcome()} SELECT {ARTICLE} FROM outcome WHERE reason IS NULL",
    "prepare_insert": f"WITH {outcome()}, {RESOLVED} SELECT {STORED} FROM resolved WHERE source_id <> 0",
    "append_read_back": f"WITH {outcome()}, {RESOLVED} SELECT {STORED} FROM resolved WHERE source_id <> 0",
    "outcome_read_back": f"""WITH {outcome()} SELECT CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, source, count(*) AS n_rows FROM outcome GROUP BY 1, 2""",
    "load_read_back": f"""WITH {outcome()}, {RESOLVED} SELECT id AS name, url, CASE WHEN length(source) < 5 AND source_id <> 0 THEN source_id END AS source_id,
        CASE WHEN length(source) >= 5 OR source_id = 0 THEN 'no_source_id' END AS reason FROM resolved""",
    "stream_load": f"""WITH {outcome()}, {KNOWN}, resolved AS (SELECT o.response_id, o.pos, o.id AS name, o.source, o.url, r.id AS source_id,
            coalesce(o.reason, CASE WHEN coalesce(r.id, 0) = 0 OR length(o.source) >= 5 THEN 'no_source_id' WHEN o.url IN (SELECT url FROM known) THEN 'known_url' END) AS why
            FROM outcome o LEFT JOIN registry r ON upper(r.name) = upper(o.source))
        SELECT 'stored' AS side, NULL::BIGINT AS response_id, NULL::INT AS pos, name, source_id::VARCHAR AS source, url, NULL AS reason FROM resolved WHERE why IS NULL
        UNION ALL SELECT 'rejects', response_id, pos, name, source, url, why FROM resolved WHERE why IS NOT NULL""",
    "run_report": f"""WITH {outcome()}, {KNOWN}, resolved AS (SELECT coalesce(o.reason, CASE WHEN coalesce(r.id, 0) = 0 OR length(o.source) >= 5 THEN 'no_source_id'
            WHEN o.url IN (SELECT url FROM known) THEN 'known_url' END) AS why FROM outcome o LEFT JOIN registry r ON upper(r.name) = upper(o.source))
        SELECT 'fetched' AS count_of, count(*) AS n FROM resolved WHERE why IS NULL OR why IN ('no_source_id', 'known_url')
        UNION ALL SELECT coalesce(why, 'stored'), count(*) FROM resolved GROUP BY why""",
    "load_rejects": f"""WITH {outcome()}, {RESOLVED} SELECT id AS "uniqueName", source, url, 'no_source_id' AS reason FROM resolved
        WHERE source_id IS NULL OR source_id = 0""",
    "skip_known": f"""WITH {outcome()}, {RESOLVED}, {KNOWN} SELECT {STORED} FROM resolved WHERE source_id <> 0
        AND (url IS NULL OR url NOT IN (SELECT url FROM known))""",
    "items_per_source": f"""WITH {outcome()} SELECT name, count(o.source) AS n_items FROM registry
        LEFT JOIN (SELECT source FROM outcome WHERE reason IS NULL) o ON o.source = name WHERE execute GROUP BY name""",
    "rejects_by_reason": f"""WITH {outcome()}, {KNOWN} SELECT source, coalesce(reason, CASE WHEN length(source) >= 5 OR source = 'src0' THEN 'no_source_id'
            WHEN url IN (SELECT url FROM known) THEN 'known_url' END) AS reason, count(*) AS n_rejected FROM outcome GROUP BY 1, 2 HAVING reason IS NOT NULL""",
    "run_summary": f"""WITH {outcome()}, {RESOLVED} SELECT count(*) AS n_fetched, count(*) FILTER (source_id <> 0) AS n_stored,
        CASE WHEN NOT EXISTS (SELECT 1 FROM registry WHERE execute) THEN 'no_sources' WHEN count(*) = 0 THEN 'no_items' ELSE 'ok' END AS outcome
        FROM resolved""",
    "stored_count": f"WITH {outcome()}, {RESOLVED} SELECT count(*) FILTER (source_id <> 0) AS n_stored FROM resolved",
    "recent_items": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS published_at FROM orders
        WHERE o_orderdate::DATE BETWEEN DATE '1998-07-02' AND DATE '1998-08-01'""",
    "topic_items": rf"""WITH {LINES} SELECT * FROM lines
        WHERE len(list_filter(string_split_regex(headline, '[{WS}]+'), lambda w: w <> '')) >= 4
        AND (contains(lower(headline), 'the') OR contains(lower(headline), 'le '))""",
    "topic_items_listed": rf"""WITH {LINES}, terms AS (SELECT DISTINCT lower(term) AS term FROM (
            SELECT unnest(regexp_extract_all(text, '([^ \n.]+ [^ \n.]+)[!]', 1)) AS term FROM documents))
        SELECT * FROM lines WHERE len(list_filter(string_split_regex(headline, '[{WS}]+'), lambda w: w <> '')) >= 4
        AND EXISTS (SELECT 1 FROM terms WHERE contains(lower(headline), term))""",
    "limit_per_source": f"""WITH {LINES} SELECT doc_id, source, pos, headline FROM lines
        QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id, pos) <= 10""",
    "stream_ingest": f"WITH {outcome()} {ACCEPTED}",
    "stream_ingest_long_blacklist": f"WITH {outcome(prefixes=WORD_PREFIXES)} {PER_REASON}",
}
