"""Fetched pages to article records and fertilizer price rows.

One Arrow pass turns the HTML of a page into a few plain texts. All rules (dates, trends, prices,
regions, fallbacks) are column expressions over these texts, and a page never meets another page,
so the jobs need no shuffle until rows are numbered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from seriesmill import fixed
from seriesmill.functions import articles, dates, prices
from seriesmill.functions.page_text import page_texts_udf
from seriesmill.session import settle

def page_texts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Replace the HTML column by the texts found in it."""
    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, page_texts_udf(F.col(html)).alias("t")).select(*kept, "t.*")


def _first_text(*options: Column) -> Column:
    return F.coalesce(*[F.when(o != "", o) for o in options])


def title_and_text() -> tuple[Column, Column]:
    """Title, and the text that is searched for movements."""
    title = F.coalesce(_first_text(F.col("detail_title"), F.col("any_title")), F.lit(""))
    body = F.coalesce(_first_text(F.col("detail_body"), F.col("any_body")), F.lit(""))
    return title, F.concat(title, F.lit(". "), F.col("summary"), F.lit(" "), body)


def with_index_move(
    df: DataFrame, title: str, full_text: Column, trend: str = "trend", amount: str = "amount"
) -> DataFrame:
    """Add trend and value of price-index texts; the long text is searched once."""
    searched = df.withColumn("__hit", articles.index_hit(full_text))
    word, value = articles.trend_and_amount(F.col("__hit"), F.col(title))
    return searched.withColumns({trend: word, amount: value}).drop("__hit")


def index_articles(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Article records of price-index pages; pages without HTML give no record.

    Unknown dates and values are null.
    """
    texts = page_texts(pages.where(F.col(html).isNotNull()), html)
    title, full = title_and_text()
    rows = with_index_move(
        texts.withColumn("tieu_de", title), "tieu_de", full, "xu_huong_bien_dong", "muc_tang_giam"
    )
    day = articles.article_day(F.col("meta_date"), F.col("shown_date"), F.col("has_meta"))
    return rows.withColumns({"ngay_thang": day, "don_vi": F.lit("%")}).select(
        *[F.col(url).alias("url") if c == "url" else F.col(c) for c in fixed.ARTICLE_FIELDS]
    )


def with_text_prices(
    df: DataFrame, text: str, items: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Add a price column per item (column name to aliases); each alias searches the text once.

    A later alias wins over an earlier one. Hits and numbers are plain columns on the way, so the
    optimizer keeps them apart and no search is repeated.
    """
    aliases = [(f"__{i}_{j}", a) for i, names in enumerate(items.values()) for j, a in enumerate(names)]
    hits = {f"{at}h": prices.price_hit(a, F.col(text)) for at, a in aliases}
    numbers = {}
    for at, a in aliases:
        numbers[f"{at}a"], numbers[f"{at}b"] = prices.hit_numbers(a, F.col(f"{at}h"))
    found = {}
    for i, (name, names) in enumerate(items.items()):
        options = [
            prices.price_of_hit(*[F.col(f"__{i}_{j}{part}") for part in "hab"], F.col(text))
            for j in range(len(names))
        ]
        found[name] = F.coalesce(*reversed(options))
    return df.withColumns(hits).withColumns(numbers).withColumns(found).drop(*hits, *numbers)


def mentions_region(text: Column, names: Sequence[str] = fixed.DELTA_REGIONS) -> Column:
    out = F.lit(False)
    for name in names:
        out = out | F.contains(text, F.lit(name))
    return out


def table_price(tables: Column, aliases: Sequence[str]) -> Column:
    """Price of an item in the last regional table that shows one."""
    regional = F.filter(tables, lambda t: mentions_region(t))

    def searched(t: Column) -> Column:
        return F.struct(t.alias("text"), F.array(*[prices.price_hit(a, t) for a in aliases]).alias("hits"))

    def priced(s: Column) -> Column:
        options = [
            prices.price_of_hit(s["hits"][j], *prices.hit_numbers(a, s["hits"][j]), s["text"])
            for j, a in enumerate(aliases)
        ]
        return F.coalesce(*reversed(options))

    shown = F.transform(F.transform(regional, lambda t: searched(t)), lambda s: priced(s))
    return F.try_element_at(F.filter(shown, lambda p: p.isNotNull()), F.lit(-1))


def item_prices(
    texts: DataFrame, aliases: Mapping[str, Sequence[str]] = fixed.FERT_ALIASES
) -> DataFrame:
    """A map of item prices per page.

    Regional tables come first; the whole page counts only where no table gave any price. Each
    long text is searched once per alias.
    """
    items = list(aliases.items())
    found = texts.withColumns(
        {f"__t{i}": table_price(F.col("tables"), names) for i, (_, names) in enumerate(items)}
    )
    in_table = F.coalesce(*[F.col(f"__t{i}") for i in range(len(items))]).isNotNull()
    page = F.when(~in_table, F.col("page_text"))
    whole = {f"__w{i}": names for i, (_, names) in enumerate(items)}
    searched = with_text_prices(found.withColumn("__page", page), "__page", whole)
    entries = []
    for i, (item, _) in enumerate(items):
        entries += [F.lit(item), F.coalesce(F.col(f"__t{i}"), F.col(f"__w{i}"))]
    keep = [c for c in texts.columns if c not in ("tables", "page_text")]
    return searched.select(*keep, F.create_map(*entries).alias("data"))


def fertilizer_articles(
    pages: DataFrame, date: str = "ngay_dang", url: str = "url", html: str = "html"
) -> DataFrame:
    """Numbered fertilizer rows: id, day, address and the price map.

    A row whose address is no web link, or whose page is missing, keeps empty prices.
    """
    linked = F.when(F.contains(F.col(url), F.lit("http")), F.col(html))
    texts = page_texts(pages.select(date, url, linked.alias(html)), html)
    rows = item_prices(texts).select(
        dates.day_first(F.col(date)).alias("ngay_dang"), F.trim(F.col(url)).alias("url"), "data"
    )
    return with_position(rows, ["ngay_dang", "url"], "id").select("id", "ngay_dang", "url", "data")


def with_position(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Position 1..n in the given order, without moving all rows to one task.

    The sorted rows are written to the shared folder with their partition and offset, so a retry
    cannot change them; the per-partition row counts then turn offsets into positions. Rows that
    are equal in the order columns may be spread over several partitions of the sort. The rows
    are written before the sort too, because the sort reads its input twice, once for sampling.
    """
    spread = settle(df, "unsorted").withColumn("__tie", F.monotonically_increasing_id())
    sorted_rows = spread.orderBy(*order, "__tie").withColumn("__id", F.monotonically_increasing_id())
    placed = settle(sorted_rows.drop("__tie"), "sorted")
    part, offset = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition of the sort, so at most spark.sql.shuffle.partitions rows
    earlier = Window.partitionBy(F.lit(1)).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__p", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__s"))
    return (
        placed.withColumn("__p", part)
        .join(F.broadcast(starts), "__p")
        .withColumn(name, F.col("__s") + offset + 1)
        .drop("__p", "__s", "__id")
    )


def clean_dates(rows: DataFrame, url: str = "URL", day: str = "Ngaydang") -> DataFrame:
    """Day from the address, else the given day; newest first, unreadable days last."""
    found = dates.url_date(F.col(url), F.col(day).try_cast("date"))
    text = F.coalesce(F.date_format(found, "yyyy-MM-dd"), F.col(day).cast("string"))
    return (
        rows.select(text.alias("Ngay_Chuan"), F.col(url).alias("URL"), found.alias("__d"))
        .orderBy(F.col("__d").desc_nulls_last(), "URL")
        .drop("__d")
    )
