"""Elements of documents, in native expressions: web pages and plain text."""

from __future__ import annotations

import json
from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from paperledger.functions.text import strip
from paperledger.operators.registry import NO_OUTPUT
from paperledger.schema import COMPLETED, FAILED

# Fixed values -------------------------------------------------------------
NOT_CONTENT = (
    r"!--.*?(?:-->|\z)", r"script\b.*?(?:</script\s*>|\z)", r"style\b.*?(?:</style\s*>|\z)", r"head\b.*?</head\s*>",
)
ADVERTS = (r'div class="ad">.*?</div\s*>',)
LINE_BREAK = r"(?i)<br\s*/?>"
BLOCK_TAGS = (
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre",
    "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
)
# Everything that starts like a tag; a `<` before anything else is text.
TAG = r"(?s)<(?:/?[a-zA-Z]|!)[^>]*>"
ELEMENT_TYPES = {"h1": "text", "p": "text", "li": "list", "footer": "footer"}
DISCARDED = "discarded"
REFERENCE = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
NO_CHARACTER = "\ufffd"  # what a number that is no character stands for
# ---------------------------------------------------------------------------


# Marks that texts cannot hold: in front of a block tag's name, behind it, and at both ends of a menu.
_START, _NAME_END, _MENU = "\x01", "\x02", "\x03"


# Names as the language's own table has them, the common ones first, as lookups go from the front; numbers of control
# characters mean those of the Windows code page.
_COMMON = ["amp;", "lt;", "gt;", "quot;", "nbsp;"]
_NAMED = json.dumps({name[:-1]: html5[name] for name in [*_COMMON, *html5] if name.endswith(";")})
_WINDOWS = json.dumps({str(i): bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(128, 160)})


def _character(code: Column) -> Column:
    known = F.try_element_at(F.from_json(F.lit(_WINDOWS), "map<string,string>"), code.cast("string"))
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(~F.coalesce(valid, F.lit(False)), NO_CHARACTER).when(code.between(128, 159), known).otherwise(char)


def unescaped(text: Column) -> Column:
    """Text with its character references decoded once, by name, number or hexadecimal number.

    References end in `;`; unknown names stay as written. Each is what stands between an `&` and that, so the text is cut at `&`.
    """
    def named_part(part: Column, i: Column) -> Column:
        return F.struct(part.alias("part"), F.when(i > 0, F.regexp_extract(part, REFERENCE, 1)).alias("name"))

    def decoded(x: Column) -> Column:
        part, name = x["part"], x["name"]
        hexadecimal = name.rlike("^#[xX]")
        digits = F.regexp_replace(name, "^#[xX]?0*", "")
        # More digits than a character can have are no character.
        number = F.when(F.length(digits).between(1, 7), F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("long"))
        named = F.try_element_at(F.from_json(F.lit(_NAMED), "map<string,string>"), name)
        char = F.when(name.startswith("#"), _character(number)).when(name != "", named)
        rest = F.substr(part, F.length(name) + 2)
        return F.when(name.isNull(), part).when(char.isNull(), F.concat(F.lit("&"), part)).otherwise(F.concat(char, rest))

    return F.when(text.contains("&"), F.array_join(F.transform(F.transform(F.split(text, "&"), named_part), decoded), "")).otherwise(text)


def _segments(html: Column | str, dropped: Sequence[str] = ADVERTS) -> Column:
    """The page cut at block tags: array of (tag, text, discarded), blank ones left out.

    Inline and unknown tags go, so that a text runs to the next block tag; this also ends paragraphs
    that are never closed. Text behind a closing tag belongs to whatever is around. What is inside
    `nav` is discarded; a `nav` that is never closed is a block like others. Scripts, styles and comments that are never
    closed go on to the page's end. `dropped` are patterns of what else goes, from behind its `<` on.
    """
    body = F.col(html) if isinstance(html, str) else html
    body = F.regexp_replace(body, f"[{_START}{_NAME_END}{_MENU}]", " ")
    body = F.regexp_replace(F.regexp_replace(body, f"(?is)<(?:{'|'.join((*NOT_CONTENT, *dropped))})", " "), LINE_BREAK, "\n")
    body = F.regexp_replace(F.regexp_replace(body, r"(?i)</nav\s*>", f"</nav>{_MENU}"), r"(?i)<nav\b", f"{_MENU}<nav")
    parts = F.split(body, _MENU)

    def cut(part: Column) -> Column:
        discarded = F.substring(part, 1, 5).rlike(r"^<nav\b") & part.endswith("</nav>")
        marked = F.regexp_replace(part, rf"(?i)<(/?(?:{'|'.join(BLOCK_TAGS)}))(?:[\s/][^>]*)?>", f"{_START}$1{_NAME_END}")
        texts = F.split(F.regexp_replace(marked, TAG, ""), _START)
        pieces = F.transform(texts, lambda t: F.struct(
            F.when(t.contains(_NAME_END), F.lower(F.substring_index(t, _NAME_END, 1))).otherwise("").alias("tag"),
            strip(unescaped(F.substring_index(t, _NAME_END, -1))).alias("text"), discarded.alias("discarded"),
        ))
        return F.filter(pieces, lambda x: x["text"] != "")

    return F.flatten(F.transform(parts, cut))


def html_elements(html: Column | str, dropped: Sequence[str] = ADVERTS) -> Column:
    """Array of elements of a page in reading order; those inside `nav` are kept as discarded."""

    def element(x: Column) -> Column:
        kind = F.lit("text")
        for tag, name in ELEMENT_TYPES.items():
            kind = F.when(x["tag"] == tag, name).otherwise(kind)
        return F.struct(
            F.when(x["discarded"], DISCARDED).otherwise(kind).alias("type"),
            x["text"].alias("text"),
            F.when((x["tag"] == "h1") & ~x["discarded"], F.lit(1)).alias("text_level"),
            F.lit(0).alias("page_idx"),
        )

    return F.transform(_segments(html, dropped), element)


def page_elements(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", dropped: Sequence[str] = ADVERTS
) -> DataFrame:
    """Elements of web pages as `{id}, seq, type, text, text_level, page_idx`."""
    return pages.select(id_col, F.posexplode(html_elements(html_col, dropped)).alias("seq", "element")).select(
        id_col, F.col("seq").cast("long").alias("seq"), "element.*"
    )


def page_content(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", dropped: Sequence[str] = ADVERTS
) -> DataFrame:
    """Content list of each page as one JSON array: `{id}, content`."""
    return pages.select(id_col, F.to_json(html_elements(html_col, dropped)).alias("content"))


def page_outcomes(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", dropped: Sequence[str] = ADVERTS
) -> DataFrame:
    """Outcome per page: completed if any element came out that is not discarded, else failed."""
    n = F.coalesce(F.size(F.filter(_segments(html_col, dropped), lambda x: ~x["discarded"])), F.lit(0))
    return pages.select(id_col, n.alias("n_elements")).select(
        id_col,
        F.when(F.col("n_elements") > 0, F.lit(COMPLETED)).otherwise(F.lit(FAILED)).alias("status"),
        F.when(F.col("n_elements") == 0, F.lit(NO_OUTPUT)).alias("error_msg"),
        F.col("n_elements").cast("long").alias("n_elements"),
    )


def text_elements(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Non-blank lines of plain text as elements; `seq` counts all lines."""
    return (
        documents.select(id_col, F.posexplode(F.split(text_col, "\n")).alias("seq", "text"))
        .select(
            id_col, F.col("seq").cast("long").alias("seq"), F.lit("text").alias("type"), strip("text").alias("text"),
            F.lit(0).alias("page_idx"),
        )
        .filter("text <> ''")
    )
