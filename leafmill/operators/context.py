"""Page context: neighbours, prompt routing, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill.functions import text as T

#: Characters of the previous, current and next page by mode; 0 is no limit.
MODES = {"minimal": (100, 300, 100), "standard": (500, 0, 500), "full": (2000, 0, 2000)}


def neighbours(pages: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """``pages`` with prev_text and next_text: the pages numbered exactly one less and one more."""
    order = Window.partitionBy(key).orderBy(page)
    return pages.withColumns({"prev_text": F.max(text).over(order.rangeBetween(-1, -1)), "next_text": F.max(text).over(order.rangeBetween(1, 1))})


def context_window(pages: DataFrame, mode: str, text: str = "text") -> DataFrame:
    """prev_context, current_context and next_context of rows with neighbours; missing text is ``N/A``."""
    limits = dict(zip(("prev", "current", "next"), MODES[mode]))
    columns = {"prev": F.col("prev_text"), "current": F.col(text), "next": F.col("next_text")}
    given = lambda c: F.when(F.coalesce(F.length(c), F.lit(0)) == 0, T.MISSING)
    return pages.withColumns({f"{k}_context": given(c).otherwise(T.truncate_with_references(c, limits[k])) for k, c in columns.items()})


def prompt_mode(text: Column, prev: Column, following: Column) -> Column:
    """``simple`` if neither the page nor a neighbour announces a chart."""
    found = T.has_indicators(text) | T.has_indicators(prev) | T.has_indicators(following)
    return F.when(found, "enhanced").otherwise("simple")


#: What the enhanced prompt asks for, one line each.
TASKS = (
    "Name what kind of image the page holds and what stands on its axes.",
    "Read off the values of every series, with units.",
    "Give tables as Markdown, formulas as LaTeX, footnotes in order.",
    "Say for each figure how sure you are: high, medium or low.",
    "Keep the language of the page.",
)


def enhanced_prompt(page: Column, prev: Column, following: Column) -> Column:
    """The prompt for a page with a chart: its tasks and the neighbours' text, the page itself being an image."""
    shown = lambda c: F.coalesce(c, F.lit(T.MISSING))
    tasks = "\n".join(f"{i}. {t}" for i, t in enumerate(TASKS, 1))
    return F.concat(F.lit("Page "), page.cast("string"), F.lit("\nBefore: "), shown(prev), F.lit("\nAfter: "), shown(following), F.lit("\n" + tasks + "\nAnswer with JSON."))


def prompt(mode: Column, page: Column, text: Column, prev: Column, following: Column) -> Column:
    return F.when(mode == "enhanced", enhanced_prompt(page, prev, following)).otherwise(simple_prompt(page, text, prev, following))


def simple_prompt(page: Column, text: Column, prev: Column, following: Column) -> Column:
    cut = lambda c, n: F.substring(F.coalesce(c, F.lit(T.MISSING)), 1, n)
    return F.concat(F.lit("Page "), page.cast("string"), F.lit("\nBefore: "), cut(prev, 100), F.lit("\nText: "), cut(text, 300), F.lit("\nAfter: "), cut(following, 100), F.lit("\nAnswer with JSON."))
