"""DuckDB oracle SQL for the payload keys.

The oracle reads the stand-in rows directly (no XML/JSON round trip), so a
match also shows the payload build → parse path is lossless.
"""

from __future__ import annotations

from .oracle_views import with_views
from .payloads import LINK_PARAMS, PAY_PARAMS, SEARCH_PARAMS

ITEMS = """, items AS (SELECT CAST(pay_year AS INTEGER) AS pay_year, org_name,
       TRY_CAST(split_part(replace(avg_pay_text, ',', ''), '.', 1) AS BIGINT) AS amount
  FROM pay_by_year WHERE org_name IS NOT NULL AND org_name <> '' AND avg_pay_text IS NOT NULL
  AND avg_pay_text <> '')
"""


def _p10k(expr: str) -> str:
    return f"CAST(trunc(CAST({expr} AS DOUBLE) / 10) AS BIGINT)"


def _clean(x: str) -> str:
    s = f"regexp_replace({x}, '<[^\\n]*?>', '', 'g')"
    for a, b in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        s = f"replace({s}, '{a}', '{b}')"
    return s


def _resolve(h: str, u: str) -> str:
    origin = f"regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"
    scheme = f"regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"
    folder = f"regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)', 1)"
    return (f"CASE WHEN regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {h} "
            f"WHEN starts_with({h}, '//') THEN {scheme} || ':' || {h} "
            f"WHEN starts_with({h}, '/') THEN {origin} || {h} "
            f"ELSE (CASE WHEN {folder} = '' THEN {origin} || '/' ELSE {folder} END) || {h} END")


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    n = PAY_PARAMS["top_n"]
    q["pay_api_topk"] = with_views("pay_by_year") + ITEMS + (
        f"SELECT CAST(row_number() OVER (ORDER BY amount DESC, org_name) AS INTEGER) AS rank, org_name, "
        f"amount AS avg_pay_thousand, {_p10k('amount')} AS avg_pay_10k FROM ("
        f"SELECT * FROM items WHERE pay_year = {PAY_PARAMS['year']} AND amount IS NOT NULL "
        f"ORDER BY amount DESC, org_name LIMIT {n}) t")
    q["pay_growth_topk"] = with_views("pay_by_year") + ITEMS + (
        f", j AS (SELECT a.org_name, a.amount AS pay_from, b.amount AS pay_to, b.amount - a.amount AS rise "
        f"FROM items a JOIN items b ON a.org_name = b.org_name "
        f"WHERE a.pay_year = {PAY_PARAMS['growth_from']} AND b.pay_year = {PAY_PARAMS['growth_to']} "
        f"AND a.amount IS NOT NULL AND b.amount IS NOT NULL)\n"
        f"SELECT CAST(row_number() OVER (ORDER BY rise DESC, org_name) AS INTEGER) AS rank, org_name, "
        f"{_p10k('pay_to')} AS pay_to_10k, {_p10k('rise')} AS rise_10k FROM ("
        f"SELECT * FROM j ORDER BY rise DESC, org_name LIMIT {n}) t")
    ps = PAY_PARAMS["page_size"]
    q["api_status_gate"] = with_views("pay_by_year") + (
        f", py AS (SELECT org_name, CAST(pay_year AS INTEGER) AS pay_year FROM pay_by_year), "
        f"yr AS (SELECT pay_year, count(*) AS n_year FROM py GROUP BY pay_year), "
        f"pg AS (SELECT p.pay_year, (('0x' || substr(md5(p.org_name), 1, 8))::BIGINT "
        f"% CAST(greatest(ceil(n_year / {ps}.0), 1) AS BIGINT)) + 1 AS page_no FROM py p JOIN yr USING (pay_year))\n"
        f"SELECT pay_year, page_no, '00' AS result_code, 'NORMAL SERVICE.' AS result_msg, true AS accepted, "
        f"CAST(count(*) AS INTEGER) AS n_items FROM pg GROUP BY pay_year, page_no "
        f"UNION ALL SELECT CAST(max(pay_year) + 1 AS INTEGER), CAST(1 AS BIGINT), '03', 'NODATA_ERROR', false, 0 FROM yr")
    title = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
    at = "(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id * 5407))"
    date = (f"CASE WHEN page_id % 10 = 7 THEN NULL WHEN page_id % 10 = 9 THEN 'yesterday' WHEN page_id % 2 = 0 "
            f"THEN strftime({at} + INTERVAL 9 HOUR, '%a, %d %b %Y %H:%M:%S') || ' +0900' ELSE strftime({at}, '%a, %d %b %Y %H:%M:%S') || ' GMT' END")
    q["news_rss"] = f"SELECT {title} AS title, url AS link, {date} AS published FROM pages"
    q["news_dates"] = " UNION ALL ".join(f"SELECT '{feed}' AS feed, url AS link, {date} AS published, "
                                         f"CASE WHEN page_id % 10 NOT IN (7, 9) THEN 1704067200 + page_id * 5407 END AS published_unix FROM pages" for feed in ("rss", "json"))
    q["news_json"] = (f"SELECT {title} AS title, url AS link, html AS description, "
                      f"{date} AS pub_date FROM pages")
    q["news_clean"] = (f"SELECT {_clean(title)} AS title, url AS link, {_clean('html')} AS description, "
                       f"{date} AS pub_date FROM pages")
    kw = _clean(title)
    q["news_search_urls"] = (
        f"SELECT page_id, {kw} AS keyword, '{SEARCH_PARAMS['base']}' || replace(url_encode({kw}), '%2F', '/') "
        f"|| '{SEARCH_PARAMS['suffix']}' AS request_url, "
        f"'{SEARCH_PARAMS['file_prefix']}' || replace({kw}, ' ', '') AS file_stem FROM pages")
    pat = '<a [^>]*?href="([^"]*)"'
    q["page_links_topn"] = (
        f"WITH h AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{pat}', 1)) AS href, "
        f"unnest(generate_series(1, len(regexp_extract_all(html, '{pat}', 1)))) AS pos FROM pages), "
        f"a AS (SELECT page_id, pos, {_resolve('href', 'url')} AS u FROM h), "
        f"f AS (SELECT page_id, u, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM a "
        f"WHERE starts_with(u, '{LINK_PARAMS['scheme']}'))\n"
        f"SELECT page_id, CAST(rn AS INTEGER) AS item_no, '{LINK_PARAMS['prefix']}' || rn || '{LINK_PARAMS['suffix']}' "
        f"AS file_name, u AS link_url FROM f WHERE rn <= {LINK_PARAMS['max_items']}")
    return q
