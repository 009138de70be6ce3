"""Payload analyses: public pay API top-k and growth, news feeds, page links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import clean_html, feed_timestamp, remove_spaces, trunc_to_long, url_quote
from ..functions.pay import THOUSAND_PER_10K
from ..operators.topk import top_k
from ..sources import payloads as pl
from ..sources.tables import pay_by_year, read_table

# Stand-in parameters: years mapped to the test data (reference: the 2024 list,
# growth 2023 → 2024).  Fixed values: top 20, 500 rows per API page, 30 items per
# news search, the SH<n>.jpg naming and the 20-image cap of the link collector.
PAY_PARAMS = {"year": 2000, "growth_from": 1999, "growth_to": 2000, "top_n": 20, "page_size": 500}
NEWS_PARAMS = {"rss_items_per_feed": 100, "json_display": 30}
SEARCH_PARAMS = {"base": "https://news.example.com/rss/search?q=", "suffix": "&hl=ko", "file_prefix": "News_"}
LINK_PARAMS = {"max_items": 20, "prefix": "SH", "suffix": ".jpg", "scheme": "http"}


def pay_items(spark, sf_dir) -> DataFrame:
    """Parsed pay API items (pay_year, org_name, amount in thousand won)."""
    return pl.parse_pay_payloads(pl.pay_api_payloads(pay_by_year(spark, sf_dir), PAY_PARAMS["page_size"]))


def _to_10k(c: Column) -> Column:
    return trunc_to_long(c / F.lit(THOUSAND_PER_10K))


def pay_api_topk(spark, sf_dir):
    """The year's top-n organisations by pay, in 10k won."""
    items = pay_items(spark, sf_dir).where(F.col("pay_year") == PAY_PARAMS["year"])
    out = top_k(items, PAY_PARAMS["top_n"], [F.col("amount").desc(), "org_name"])
    return out.select("rank", "org_name", F.col("amount").alias("avg_pay_thousand"),
                      _to_10k(F.col("amount")).alias("avg_pay_10k"))


def pay_growth_topk(spark, sf_dir):
    """Organisations present in both years, top-n by pay rise.

    J1: inner join on the name.  The API lists an organisation once per year,
    so the join is one-to-one; AQE's skew rule splits oversized partitions.
    """
    items = pay_items(spark, sf_dir)
    a = items.where(F.col("pay_year") == PAY_PARAMS["growth_from"]).select("org_name", F.col("amount").alias("pay_from"))
    b = items.where(F.col("pay_year") == PAY_PARAMS["growth_to"]).select("org_name", F.col("amount").alias("pay_to"))
    j = a.join(b, "org_name", "inner").withColumn("rise", F.col("pay_to") - F.col("pay_from"))
    out = top_k(j, PAY_PARAMS["top_n"], [F.col("rise").desc(), "org_name"])
    return out.select("rank", "org_name", _to_10k(F.col("pay_to")).alias("pay_to_10k"),
                      _to_10k(F.col("rise")).alias("rise_10k"))


def api_status_gate(spark, sf_dir):
    """Every response page with its result code and whether it is used."""
    p = pl.api_status(pl.pay_api_payloads(pay_by_year(spark, sf_dir), PAY_PARAMS["page_size"]))
    n = F.coalesce(F.size(F.col("x.body.items.item")), F.lit(0))
    return p.select("pay_year", "page_no", "result_code", "result_msg", "accepted",
                    F.greatest(n, F.lit(0)).alias("n_items"))


def _pages(spark, sf_dir):
    return read_table(spark, sf_dir, "pages").select("page_id", "url", "html")


def news_rss(spark, sf_dir):
    """News feed: entries (title, link, published)."""
    return pl.parse_rss(pl.rss_payloads(_pages(spark, sf_dir), NEWS_PARAMS["rss_items_per_feed"]))


def news_json(spark, sf_dir):
    """News search: response items as rows."""
    return pl.parse_news_json(pl.news_json_payloads(_pages(spark, sf_dir), NEWS_PARAMS["json_display"])) \
             .select("title", "link", "description", F.col("pubDate").alias("pub_date"))


def news_dates(spark, sf_dir):
    """Publication dates of both feeds as points in time (D19), with the text they were read from."""
    rss = news_rss(spark, sf_dir).select(F.lit("rss").alias("feed"), "link", "published")
    search = news_json(spark, sf_dir).select(F.lit("json").alias("feed"), "link", F.col("pub_date").alias("published"))
    return rss.unionByName(search).select("feed", "link", "published", F.unix_timestamp(feed_timestamp("published")).alias("published_unix"))


def news_clean(spark, sf_dir):
    """News search: title and description with tags stripped and entities decoded."""
    rows = news_json(spark, sf_dir)
    return rows.select(clean_html("title").alias("title"), "link",
                       clean_html("description").alias("description"), "pub_date")


def news_search_urls(spark, sf_dir):
    """News feed: request URL and output file stem for a keyword.

    Keywords are the cleaned page titles (one request per page); the keyword is
    percent-encoded like ``urllib.parse.quote`` and stripped of spaces for the
    file name.
    """
    kw = clean_html(pl.page_title(F.col("html")))
    p = _pages(spark, sf_dir).select("page_id", kw.alias("keyword"))
    return p.select("page_id", "keyword",
                    F.concat(F.lit(SEARCH_PARAMS["base"]), url_quote("keyword"), F.lit(SEARCH_PARAMS["suffix"]))
                     .alias("request_url"),
                    F.concat(F.lit(SEARCH_PARAMS["file_prefix"]), remove_spaces("keyword")).alias("file_stem"))


# page links (G3 / O8) -----------------------------------------------------------
HREF_PATTERN = '<a [^>]*?href="([^"]*)"'
#: ``src`` of an image element in any case, quoted either way or not at all.
IMAGE_PATTERN = """(?i)<img\\b[^>]*?\\ssrc\\s*=\\s*(?:"([^"]*)"|'([^']*)'|([^\\s"'>]+))"""


def url_parts(base: Column) -> dict[str, Column]:
    """Origin, scheme and folder of a page URL (computed once per page)."""
    return {"origin": F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1),
            "scheme": F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1),
            "folder": F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)", 1)}


def absolute_url(href: Column, origin: Column, scheme: Column, folder: Column) -> Column:
    """Resolve a link against its page URL parts (what a browser reports as ``src``)."""
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
             .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
             .when(href.startswith("/"), F.concat(origin, href))
             .otherwise(F.concat(F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder), href)))


def page_links_topn(spark, sf_dir):
    """Image links: first n http(s) links of each page, numbered SH1..SHn.

    Array functions per row — no shuffle, no window.
    """
    return links_topn(_pages(spark, sf_dir), F.regexp_extract_all("html", F.lit(HREF_PATTERN), 1))


def image_sources(html: str = "html") -> Column:
    """``src`` of every image element of the page, in order; empty ones are none."""
    groups = [F.regexp_extract_all(html, F.lit(IMAGE_PATTERN), k) for k in (1, 2, 3)]  # one of the three is not empty
    sources = F.transform(F.arrays_zip(*[g.alias(f"g{k}") for k, g in enumerate(groups)]),
                          lambda x: F.trim(F.concat(x["g0"], x["g1"], x["g2"])))
    return F.filter(sources, lambda u: u != "")


def page_images_topn(pages: DataFrame) -> DataFrame:
    """The first n http(s) images of each page (page_id, url, html), numbered like the links."""
    return links_topn(pages, image_sources())


def links_topn(pages: DataFrame, found: Column) -> DataFrame:
    """page_id, item_no, file_name, link_url: the first n of the ``found`` links of each page, made absolute."""
    # the page URL's parts are columns, so the per-link lambda reads them instead
    # of running three regexes for every link
    p = pages.select("page_id", found.alias("__found"), *[c.alias(f"__{k}") for k, c in url_parts(F.col("url")).items()])
    links = F.transform("__found",
                        lambda h: absolute_url(h, F.col("__origin"), F.col("__scheme"), F.col("__folder")))
    keep = F.slice(F.filter(links, lambda u: u.startswith(LINK_PARAMS["scheme"])), 1, LINK_PARAMS["max_items"])
    return (p.select("page_id", F.posexplode(keep).alias("pos", "link_url"))
             .select("page_id", (F.col("pos") + 1).alias("item_no"),
                     F.concat(F.lit(LINK_PARAMS["prefix"]), (F.col("pos") + 1).cast("string"),
                              F.lit(LINK_PARAMS["suffix"])).alias("file_name"),
                     "link_url"))
