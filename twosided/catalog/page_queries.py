"""Fields of the pages table."""

from pyspark.sql import functions as F

from twosided.functions.html import Field, Step, page_fields, page_records
from twosided.functions.text import first_number
from twosided.plans.contest_view import table


def page_links(spark, sf_dir):
    fields = {"name": Field(), "href": Field(attribute="href")}
    return page_records(table(spark, sf_dir, "pages"), ["page_id"], fields, Step("a"), [Step("nav")])


def page_texts(spark, sf_dir):
    fields = {
        "title": Field([Step("title")]),
        "heading": Field([Step("article"), Step("h1")]),
        "ad": Field([Step("div", "ad")]),
        "second_ad": Field([Step("div", "ad", 1)]),
        "byline": Field([Step("div", "byline")]),
        "language": Field([Step("html")], attribute="lang"),
        "rows": Field([Step("tr", nth=1), Step("td")], default="0"),
    }
    return page_fields(table(spark, sf_dir, "pages"), ["page_id"], fields)


def labelled_text(spark, sf_dir):
    fields = {"following": Field(label=Step("a"), label_text="the"), "absent": Field(label=Step("a"), label_text="-")}
    return page_fields(table(spark, sf_dir, "pages"), ["page_id"], fields)


def title_number(spark, sf_dir):
    titles = page_fields(table(spark, sf_dir, "pages"), ["page_id"], {"title": Field([Step("title")])})
    return titles.select("page_id", first_number("title").alias("number"))


def link_parts(spark, sf_dir):
    """The same links without Python: a pattern suffices where the markup is regular."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    pattern = F.lit('<li><a href="([^"]*)">([^<]*)</a>')
    both = F.arrays_zip(
        F.regexp_extract_all("html", pattern, F.lit(1)).alias("href"),
        F.regexp_extract_all("html", pattern, F.lit(2)).alias("name"),
    )
    return pages.select("page_id", F.posexplode(both).alias("place", "link")).select("page_id", "place", "link.*")


QUERIES = {
    "page_links": page_links,
    "page_texts": page_texts,
    "labelled_text": labelled_text,
    "title_number": title_number,
    "link_parts": link_parts,
}


def _text(pattern):
    """The matched markup with its character references resolved, as the parser gives it."""
    found = f"trim(regexp_extract(html, '{pattern}', 1))"
    return f"regexp_replace(regexp_replace({found}, '&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"


LINK = '<li><a href="([^"]*)">([^<]*)</a>'
LINKS = f"""SELECT page_id, CAST(place - 1 AS INTEGER) AS place, hrefs[place] AS href, names[place] AS name FROM (
    SELECT page_id, hrefs, names, unnest(range(1, len(hrefs) + 1)) AS place FROM (
      SELECT page_id, regexp_extract_all(html, '{LINK}', 1) AS hrefs, regexp_extract_all(html, '{LINK}', 2) AS names
      FROM pages))"""

ORACLE = {
    "page_links": LINKS,
    "link_parts": LINKS,
    "page_texts": f"""SELECT page_id, {_text("<title>([^<]*)</title>")} AS title,
        {_text("<h1>([^<]*)</h1>")} AS heading, {_text('<div class="ad">([^<]*)</div>')} AS ad,
        'N/A' AS second_ad, 'N/A' AS byline, regexp_extract(html, '<html lang="([^"]*)"', 1) AS language,
        '0' AS "rows" FROM pages""",
    "labelled_text": """SELECT page_id, CASE WHEN html LIKE '%>the</a></li><li><a %'
        THEN regexp_extract(html, '>the</a></li><li><a href="[^"]*">([^<]*)<', 1)
        WHEN html LIKE '%>the</a></li></ul>%' THEN regexp_extract(html, '<div class="ad">([^<]*)</div>', 1)
        ELSE 'N/A' END AS following, 'N/A' AS absent FROM pages""",
    "title_number": f"""SELECT page_id, TRY_CAST(nullif(regexp_extract(
        {_text("<title>([^<]*)</title>")}, '(?:^|\\s)(\\d+)(?:\\s|$)', 1), '') AS BIGINT) AS number
        FROM pages""",
}
