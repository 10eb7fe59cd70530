"""Column expressions for document text. All are built-in Spark expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from doctables.functions import fixed
from doctables.functions.cells import unify_lines


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _escape_pattern() -> str:
    return "([" + "".join(re.escape(c) for c in fixed.MARKDOWN_SPECIALS) + "])"


def md_escape(s: Column | str) -> Column:
    """Backslash before every character Markdown could read as a mark."""
    return F.regexp_replace(_col(s), _escape_pattern(), r"\\$1")


# --- paragraphs ---------------------------------------------------------------------


def norm_style(style_id: Column | str) -> Column:
    """Style name in any known language as H1.., NORMAL, TITLE, LIST, QUOTE, CAPTION or FOOTNOTE.

    The upper-cased name must match a pattern as a whole; unknown names give null.
    """
    name = F.upper(_col(style_id))
    words = "|".join(fixed.HEADING_WORDS)
    number = F.regexp_extract(name, rf"^(?:{words})\s*(\d+)\z", words.count("(") + 1)
    out = F.when(number != "", F.concat(F.lit("H"), number))
    for generic, patterns in fixed.STYLE_PATTERNS.items():
        out = out.when(name.rlike("^(?:" + "|".join(patterns) + r")\z"), generic)
    return out


def block_prefix(style: Column | str) -> Column:
    """Mark before a paragraph of a normalised style."""
    style = _col(style)
    level = style.substr(2, 10).try_cast("int")
    heading = (level >= 1) & (level <= 9) & (style == F.concat(F.lit("H"), level.cast("string")))
    return (
        F.when(style == "TITLE", "# ")
        .when(heading, F.concat(F.repeat(F.lit("#"), level + 1), F.lit(" ")))
        .when(style == "QUOTE", "> ")
        .otherwise("")
    )


def is_code_font(*fonts: Column | str) -> Column:
    """True if any of the font slots names a monospace font."""
    test = F.lit(False)
    for f in fonts:
        test = test | F.coalesce(F.upper(_col(f)).isin(fixed.MONOSPACE_FONTS), F.lit(False))
    return test


def fence(md: Column | str) -> Column:
    return F.concat(F.lit("```\n"), _col(md), F.lit("\n```"))


def norm_align(jc: Column | str) -> Column:
    """Justification name as left, center, right or justified; unknown is left."""
    jc = _col(jc)
    return (
        F.when(jc == "center", "center")
        .when(jc.isin("right", "end"), "right")
        .when(jc.isin("both", "distribute"), "justified")
        .otherwise("left")
    )


def _around_lines(md: Column, before: str, after: str) -> Column:
    lines = F.replace(unify_lines(md), F.lit("\n"), F.lit(f"{after}\n{before}"))
    return F.concat(F.lit(before), lines, F.lit(after))


def mark_align(md: Column | str, align: Column | str) -> Column:
    """Alignment marks on every line of a paragraph outside tables."""
    md, align = _col(md), _col(align)
    return (
        F.when(align == "right", _around_lines(md, "", ">>"))
        .when(align == "center", _around_lines(md, ">>", "<<"))
        .when(align == "justified", _around_lines(md, "<<", ">>"))
        .otherwise(md)
    )


def rule_after(border: Column | str) -> Column:
    """Rule below a paragraph with a bottom border."""
    return F.when(_col(border), "-" * 80 + "\n\n").otherwise("")


def section_line(columns: Column | str) -> Column:
    """Bars that open a section of so many columns."""
    n = _col(columns)
    bar = F.repeat(F.lit("="), F.greatest(F.lit(5), F.floor(F.lit(80) / n).cast("int")))
    return F.array_join(F.array_repeat(bar, n), " ")


def indent_lines(md: Column | str, depth: Column | str) -> Column:
    """Tabs before every line."""
    tabs = F.repeat(F.lit("\t"), _col(depth))
    return F.concat(tabs, F.replace(unify_lines(md), F.lit("\n"), F.concat(F.lit("\n"), tabs)))


# --- runs -----------------------------------------------------------------------------


def _on(flag: Column | str) -> Column:
    return F.coalesce(_col(flag), F.lit(False))


def wrap_run(content: Column, has_text: Column, flags: dict[str, Column]) -> Column:
    """Format marks around the content of a run, opened in file order and closed in reverse.

    A space right after a mark becomes ``&nbsp;`` (not after super-, subscript or
    code alone); a run without text gets two spaces before each closing mark.
    """
    under = flags["underline"]
    heavy = F.coalesce(under.isin(fixed.HEAVY_UNDERLINES), F.lit(False))
    light = F.coalesce(under.isNotNull() & (under != "none"), F.lit(False)) & ~heavy
    ins, deleted = _on(flags["ins"]), _on(flags["del"])
    vert = F.coalesce(flags["vert"], F.lit(""))
    marks = [
        (ins, "__", "__", True),
        (deleted, "~~", "~~", True),
        (_on(flags["mono"]), "`", "`", False),
        (_on(flags["bold"]), "**", "**", True),
        (_on(flags["italic"]), "*", "*", True),
        (_on(flags["strike"]), "~", "~", True),
        (_on(flags["dstrike"]) & ~deleted, "~~", "~~", True),
        (heavy & ~ins, "__", "__", True),
        (light, "_", "_", True),
        (vert == "superscript", "^[", "]", False),
        (vert == "subscript", "[", "]", False),
    ]
    spaced = F.lit(False)
    for test, _, _, guards in marks:
        if guards:
            spaced = spaced | test
    pad = F.when(has_text, "").otherwise("  ")
    opened = F.concat(*[F.when(test, a).otherwise("") for test, a, _, _ in marks])
    closed = F.concat(*[F.when(test, F.concat(pad, F.lit(b))).otherwise("") for test, _, b, _ in reversed(marks)])
    guarded = F.when(
        spaced & has_text & content.startswith(" "), F.concat(F.lit("&nbsp;"), F.substring(content, 2, 2147483647))
    ).otherwise(content)
    return F.concat(opened, guarded, closed)


def run_content(text: Column | str, deleted: Column | str) -> Column:
    """Escaped text of a run; the text of a deletion is not shown."""
    return F.when(_on(deleted), "").otherwise(md_escape(F.coalesce(_col(text), F.lit(""))))


RUN_FLAGS = ("ins", "del", "mono", "bold", "italic", "strike", "dstrike", "underline", "vert")


def render_break(kind: Column | str) -> Column:
    """Markdown of a break, tab or separator mark; null for anything else."""
    kind = _col(kind)
    return (
        F.when(kind == "br", "  \n")
        .when(kind == "tab", "\t")
        .when(kind.isin("separator", "continuationSeparator"), "*" * 16 + "\n\n")
    )


# --- lists ------------------------------------------------------------------------------


def list_kind(fmt: Column | str) -> Column:
    """Kind of list a number format makes; null without a format."""
    fmt = _col(fmt)
    return (
        F.when(fmt.isin(fixed.COUNTED_FORMATS), "OrderedList")
        .when(fmt == "none", "Continuation")
        .when(fmt.isNotNull(), "BulletList")
    )


def bullet_mark(ilvl: Column | str) -> Column:
    """Tabs for the level, then the bullet of the level and a tab."""
    ilvl = F.coalesce(_col(ilvl), F.lit(0))
    bullet = F.when(ilvl % 3 == 0, "*").when(ilvl % 3 == 1, "-").otherwise("+")
    return F.concat(F.repeat(F.lit("\t"), ilvl), bullet, F.lit("\t"))


# --- images, notes ------------------------------------------------------------------------


def image_uri(content_type: Column | str, content: Column | str) -> Column:
    """Image bytes as a data URI."""
    return F.concat(
        F.lit("data:"), _col(content_type), F.lit(";base64,"),
        F.regexp_replace(F.base64(_col(content)), r"[\r\n]", ""),
    )


def note_block(label: Column, md: Column | str) -> Column:
    """A note at the end of a document: its label, then its lines after tabs."""
    body = F.replace(unify_lines(md), F.lit("\n"), F.lit("\n\t"))
    return F.concat(F.lit("\n[^"), label, F.lit("]:\t"), body, F.lit("\n"))


def trim_end(s: Column | str) -> Column:
    return F.regexp_replace(_col(s), r"\s+\z", "")
