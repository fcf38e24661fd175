"""Work lists, listings and link harvesting.

Listing pages and year x quarter x type work lists are usually handled in
Python loops on one machine; here each is a small distributed relation:
``sequence``/``explode`` generates the grid per row of a driving table, and
"already done" is an anti-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import COMPANY_ZIP_PATTERN, DEBT_TYPES, ESTABLISHMENT_ZIP_PATTERN, REGIME_KEYWORDS
from ..functions.paths import debt_file_name, debt_path
from ..functions.text import base_name, contains_any


def work_grid(years: DataFrame, year_col: str = "ano", types=DEBT_TYPES) -> DataFrame:
    """Year x quarter x type, expanded per year row with ``explode`` (no join)."""
    return (years.select(F.col(year_col).cast("int").alias("ano"),
                         F.explode(F.sequence(F.lit(1), F.lit(4))).alias("trimestre"))
            .select("ano", "trimestre", F.explode(F.array(*[F.lit(t) for t in types])).alias("tipo"))
            .withColumn("caminho", debt_path("ano", "trimestre", "tipo"))
            .withColumn("arquivo", debt_file_name("ano", "trimestre", "tipo")))


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work items without a matching done marker (left anti-join)."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def period_range(periods: DataFrame, col: str, start: str | None = None, end: str | None = None,
                 months: list[int] | None = None) -> DataFrame:
    """``start <= period <= end`` on 'yyyy-MM' strings and an optional month ``IN`` list."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(col) >= F.lit(start))
    if end is not None:
        cond = cond & (F.col(col) <= F.lit(end))
    if months:
        cond = cond & F.substring(F.col(col), 6, 2).cast("int").isin(months)
    return periods.where(cond)


#: What a reader of HTML skips: comments and the text of scripts, styles and text boxes.
_SKIPPED = r"(?is)<!--.*?(?:-->|$)|<(script|style|textarea|title)\b[^>]*>.*?(?:</\1\s*>|$)"
#: The attributes of an <a> tag (quoted values may hold >), and the name and value of each.
_ANCHOR = r"""(?is)<a([\s/](?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_ATTRIBUTE = r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
_NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\u00a0"}


def _unescaped(text: Column) -> Column:
    """Entities as characters: the common names, then numbers, and the ampersand last."""
    for name, sign in _NAMED.items():
        text = F.replace(text, F.lit(name), F.lit(sign))

    def sign_of(entity: Column) -> Column:
        body = F.regexp_extract(entity, "^&#([0-9]{1,7});$", 1)
        code = F.when(body != "", F.conv(body, 10, 16)).otherwise(F.regexp_extract(entity, "^&#[xX]([0-9a-fA-F]{1,6});$", 1))
        return F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")

    numbers = F.array_distinct(F.regexp_extract_all(text, F.lit("(&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});)"), 1))
    text = F.aggregate(numbers, text, lambda done, entity: F.replace(done, entity, sign_of(entity)))
    return F.replace(text, F.lit("&amp;"), F.lit("&"))


def links(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The ``href`` of every ``<a>`` tag of each page, in page order, one row per link.

    Tags are read as HTML has them: any case, attributes in any order, values in double, single or no quotes,
    entities; not in comments, scripts or other attributes' values.  Of two ``href`` the first counts.
    """
    text = F.regexp_replace(F.col(html), _SKIPPED, "")

    def href(tag: Column) -> Column:
        names = F.transform(F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), 1), F.lower)
        values = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), 2)
        value = F.try_element_at(values, F.nullif(F.array_position(names, "href"), F.lit(0)).cast("int"))
        return _unescaped(F.regexp_replace(value, r"""^["']|["']$""", ""))

    found = F.array_compact(F.transform(F.regexp_extract_all(text, F.lit(_ANCHOR), 1), href))
    return pages.select(*(keep or []), F.posexplode(found).alias("pos", "link"))


def classify_links(df: DataFrame, link: str = "link") -> DataFrame:
    """File name of a link and which landed-file family it belongs to."""
    name = base_name(link)
    return df.withColumns({
        "arquivo": name,
        "is_estabelecimentos": name.rlike(ESTABLISHMENT_ZIP_PATTERN),
        "is_empresas": name.rlike(COMPANY_ZIP_PATTERN),
        "is_regime": F.lower(name).endswith(".zip") & contains_any(F.lower(name), REGIME_KEYWORDS),
    })
