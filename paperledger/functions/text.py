"""Scalar text and number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values -------------------------------------------------------------
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ID_PATTERN = r"(?i)(\d{6,10})\.pdf$"
NODE_PATTERN = r"^(cn\d{2})"
INTEGER_PATTERN = r"^[0-9]+$"
NOT_A_NUMBER = r"[dDxXpP]|[0-9.][fF]\s*$"
OUTPUT_SUFFIX = "_content_list"
PREFIX_LENGTH = 3
MEGABYTE = 1048576
SIZE_BANDS = [("<1MB", 1 * MEGABYTE), ("1-5MB", 5 * MEGABYTE), ("5-10MB", 10 * MEGABYTE)]
TOP_SIZE_BAND = ">10MB"
GLYPHS = {"✓": "completed", "✗": "failed"}
STDERR_CHARS, EXCEPTION_CHARS, REPORT_CHARS = 500, 200, 60
GPU_NAME_CHARS = 24
LATEX_FONTS = ["mathbb", "mathbf", "mathtt", "mathrm"]
LATEX_TEXT = ["text", "textrm", "textbf", "textit", "texttt", "mbox", "hbox"]
# ---------------------------------------------------------------------------

# A text in pieces: maths between `$$`, `$`, `\\(` and `\\)`, `\\[` and `\\]`, then escaped characters, runs of others, and what is left.
# Possessive repeats need no stack, so formulas may be of any length; a delimiter that is never closed is one piece by itself.
_PIECES = (
    r"(?s)\$\$(?:[^\\$]|\\.|\$(?:[^\\$]|\\.))*+\$\$|\$(?:[^\\$]|\\.)++\$"
    r"|\\\((?:[^\\]|\\[^()])*+\\\)|\\\[(?:[^\\]|\\[^\[\]])*+\\\]|\\.|[^\\$]+|."
)
# Maths in pieces: macros with their star, escaped characters, braces, white space, runs of others.
_TOKENS = r"(?s)\\[A-Za-z]+\*?|\\.|[{}]|[ \t-\r]+|[^\\{} \t-\r]+|."


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim every kind of whitespace, not only the space that `trim` knows."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def safe_double(c: Column | str) -> Column:
    """Number or NULL. The pattern keeps out what Java reads but a CSV number is not, as `1.5d`."""
    s = _col(c).cast("string")
    return F.when(~s.rlike(NOT_A_NUMBER), s.try_cast("double"))


def local_time(c: Column | str) -> Column:
    """ISO time without a zone, as the attempts carry it; NULL for anything else."""
    return strip(c).try_cast("timestamp_ntz")


def id_prefix(c: Column | str) -> Column:
    return F.substring(strip(c), 1, PREFIX_LENGTH)


def file_name(c: Column | str) -> Column:
    """Last part of a path."""
    return F.substring_index(F.regexp_replace(_col(c), "/+$", ""), "/", -1)


def stem(c: Column | str) -> Column:
    """File name without its last extension; a dotfile is its own stem."""
    return F.regexp_extract(file_name(c), r"(?s)^(.+?)(?:\.[^.]+)?$", 1)


def id_from_name(c: Column | str, pattern: str = ID_PATTERN) -> Column:
    """Id found in a file name, NULL where there is none."""
    return F.nullif(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def strip_suffix(c: Column | str, suffix: str = OUTPUT_SUFFIX) -> Column:
    """Remove every occurrence of the output suffix."""
    return F.replace(_col(c), F.lit(suffix), F.lit(""))


def truncated(c: Column | str, chars: int) -> Column:
    return F.substring(_col(c), 1, chars)


def size_band(c: Column | str) -> Column:
    """Band of a size in bytes, NULL for an unknown size. The top band starts at exactly 10 MB."""
    size = _col(c)
    band = F.when(size.isNull(), F.lit(None).cast("string"))
    for label, upper in SIZE_BANDS:
        band = band.when(size < upper, F.lit(label))
    return band.otherwise(F.lit(TOP_SIZE_BAND))


def mb_to_bytes(mb: float) -> int:
    return int(mb * MEGABYTE)


def chunk_id(c: Column | str) -> Column:
    return F.format_string("chunk_%05d", _col(c).cast("long"))


def status_from_glyph(c: Column | str) -> Column:
    c = _col(c)
    out = F.lit(None).cast("string")
    for glyph, status in GLYPHS.items():
        out = F.when(c == glyph, F.lit(status)).otherwise(out)
    return out


def node_prefix(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(c), NODE_PATTERN, 1), F.lit(""))


def memory_label(used: Column | str, total: Column | str) -> Column:
    return F.concat(strip(used), F.lit("/"), strip(total), F.lit("MB"))


def short_gpu_name(c: Column | str) -> Column:
    return truncated(strip(c), GPU_NAME_CHARS)


def _folded(maths: Column) -> Column:
    """Maths with its fonts folded and its spaces dropped, token by token.

    The state holds what is written so far, how many braces deep the machine is in a text, and what came last: a font, a
    text macro, any other macro, or none of these; and whether white space has come since.
    """
    fonts, texts = ([f"\\{name}" for name in names] for names in (LATEX_FONTS, LATEX_TEXT))

    def step(state: Column, token: Column) -> Column:
        def to(out: Column, deep: Column | int, last: Column | str, spaced: bool) -> Column:
            # A plain number or text here is a literal.
            return F.struct(out.alias("out"), (deep if isinstance(deep, Column) else F.lit(deep)).alias("deep"),
                            (last if isinstance(last, Column) else F.lit(last)).alias("last"), F.lit(spaced).alias("spaced"))

        out, deep, last = state["out"], state["deep"], state["last"]
        inside = to(F.concat(out, token), deep + F.when(token == "{", 1).when(token == "}", -1).otherwise(0), "", False)
        space = F.struct(out.alias("out"), deep.alias("deep"), last.alias("last"), F.lit(True).alias("spaced"))
        written = (
            F.when(token.isin(fonts), "\\mathrm")
            # Without braces a font holds for one character.
            .when((last == "font") & token.rlike("^[A-Za-z0-9]"), F.concat(F.lit("{"), F.left(token, F.lit(1)), F.lit("}"), F.substr(token, F.lit(2))))
            # A macro and a letter behind it would become another macro.
            .when(last.isin("macro", "text") & state["spaced"] & token.rlike("^[A-Za-z]"), F.concat(F.lit(" "), token))
            .otherwise(token)
        )
        kind = F.when(token.isin(fonts), "font").when(token.isin(texts), "text").when(token.rlike(r"^\\[A-Za-z]"), "macro").otherwise("")
        outside = to(F.concat(out, written), F.when((token == "{") & (last == "text"), 1).otherwise(0), kind, False)
        return F.when(deep > 0, inside).when(token.rlike(r"^[ \t-\r]"), space).otherwise(outside)

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("deep"), F.lit("").alias("last"), F.lit(False).alias("spaced"))
    return F.aggregate(F.regexp_extract_all(maths, F.lit(_TOKENS), F.lit(0)), start, step, lambda state: state["out"])


def canonical_latex(c: Column | str) -> Column:
    """Text with the font macros folded and spaces dropped in its maths; the rest is untouched.

    Maths stands between `$`, `$$`, `\\(` and `\\)`, or `\\[` and `\\]`; an escaped `\\$` and a delimiter without its mate open none. A
    font macro without braces holds for the next letter or digit, which gets braces. Within the braces of `\\text` and its like
    nothing changes; one space stays where a macro would grow into the letter behind it. Dollar signs in such braces are
    known inside `$$` and brackets, not inside `$`. The time of a formula grows with the square of its length.
    """
    text = _col(c)

    def fold(piece: Column) -> Column:
        n = F.length(piece)
        wide = (n >= 4) & (piece.startswith("$$") | piece.startswith("\\(") | piece.startswith("\\["))
        edge = F.when(wide, 2).when((n >= 3) & piece.startswith("$"), 1)
        return F.when(edge.isNull(), piece).otherwise(
            F.concat(F.left(piece, edge), _folded(F.substr(piece, edge + 1, n - 2 * edge)), F.right(piece, edge)))

    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0))
    return F.when(text.rlike(r"\$|\\[(\[]"), F.array_join(F.transform(pieces, fold), "")).otherwise(text)


def markdown_lines(c: Column | str) -> Column:
    """Lines of a text, one more than its newlines."""
    c = _col(c)
    return F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit(""))) + 1
