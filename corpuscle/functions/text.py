"""Text cleaning as column expressions.

Everything here stays in the JVM: no UDF, one pass over the text. The rules
follow Python's notion of lines and blanks, which is wider than Java's default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuscle.functions.expressions import let

# Results depend on them.
HEADER_FIELDS = (
    "from", "subject", "organization", "lines", "nntp-posting-host",
    "message-id", "references", "date", "distribution", "reply-to",
    "newsgroups", "x-newsreader", "x-mailer", "path", "summary",
    "keywords", "mime-version", "content-type", "article-i.d.",
    "sender", "approved", "followup-to", "expires", "supersedes",
    "archive-name", "version", "x-posted-to", "return-path",
)
SIGNATURE_LINES = ("--", "-" * 10, "-" * 74)
QUOTE_MARK = ">"
MIN_TOKENS = 50
FINGERPRINT_CHARS = 200

# Line ends and blanks as Python's str.splitlines / str.strip see them.
LINE_BREAK = r"\R|[\x1C\x1D\x1E]"
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_BLANK_CLASS = r"[\s\x1C-\x1F]"
_NON_BLANK_RUN = r"(?U)[^\s\x1C-\x1F]+"
_FIELD_LIKE = r"(?U)^[A-Za-z0-9-]+" + _BLANK_CLASS + "*:"


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def split_lines(text: Column) -> Column:
    """Lines of ``text``; a line break at the very end opens no extra line."""
    return let(
        F.split(text, LINE_BREAK, -1),
        lambda pieces: F.when(
            F.element_at(pieces, -1) == "", F.slice(pieces, 1, F.size(pieces) - 1)
        ).otherwise(pieces),
    )


def _is_header_line(line: Column) -> Column:
    name = F.lower(strip_blanks(F.substring_index(line, ":", 1)))
    return line.rlike(_FIELD_LIKE) | name.isin(*HEADER_FIELDS)


def _drop_header_lines(lines: Column) -> Column:
    # A fold that counts header lines; once a line ends the block the count is
    # stored as -(count + 1) and no later line is tested again.
    def step(state: Column, line: Column) -> Column:
        return (
            F.when(state < 0, state)
            .when(_is_header_line(line), state + 1)
            .otherwise(-state - 1)
        )

    def with_state(lines: Column) -> Column:
        return F.struct(lines.alias("lines"), F.aggregate(lines, F.lit(0), step).alias("state"))

    def body(found: Column) -> Column:
        lines, state = found["lines"], found["state"]
        ended_by = -state  # 1-based position of the line that ended the block
        blank = strip_blanks(F.get(lines, ended_by - 1)) == ""
        start = ended_by + F.when(blank, 1).otherwise(0)
        return F.when(state < 0, F.slice(lines, start, F.size(lines))).otherwise(
            F.slice(lines, 1, 0)
        )

    return let(let(lines, with_state), body)


def _cut_signature(lines: Column) -> Column:
    def with_mark(lines: Column) -> Column:
        marks = F.transform(lines, lambda line: strip_blanks(line).isin(*SIGNATURE_LINES))
        at = F.array_position(marks, True).cast("int")
        return F.struct(lines.alias("lines"), at.alias("at"))

    def before_mark(found: Column) -> Column:
        lines, at = found["lines"], found["at"]
        return F.when(at > 0, F.slice(lines, 1, at - 1)).otherwise(lines)

    return let(let(lines, with_mark), before_mark)


def _drop_quotes(lines: Column) -> Column:
    return F.filter(
        lines, lambda line: ~F.ltrim(line, F.lit(BLANKS)).startswith(QUOTE_MARK)
    )


def strip_headers(text: Column) -> Column:
    """Remove the header block at the top of an article."""
    return F.array_join(_drop_header_lines(split_lines(text)), "\n")


def strip_quotes_and_signature(text: Column) -> Column:
    """Drop quoted lines and everything from the first signature line on."""
    return F.array_join(_drop_quotes(_cut_signature(split_lines(text))), "\n")


def normalize_whitespace(text: Column) -> Column:
    """Collapse three or more line feeds to two, then trim."""
    return strip_blanks(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def clean_article(text: Column) -> Column:
    """Header strip, signature cut, quote strip and whitespace in one projection."""
    body = _drop_quotes(_cut_signature(_drop_header_lines(split_lines(text))))
    return normalize_whitespace(F.array_join(body, "\n"))


def token_count(text: Column) -> Column:
    """Number of runs of non-blank characters."""
    return F.regexp_count(text, F.lit(_NON_BLANK_RUN))


def fingerprint(text: Column, chars: int | None = None) -> Column:
    """MD5 of the text, or of its first ``chars`` characters; the key that marks copies."""
    return F.md5((text if chars is None else F.substring(text, 1, chars)).cast("binary"))


def decode_article(content: Column) -> Column:
    """Raw bytes to text; every byte is one character."""
    return F.decode(content, "ISO-8859-1")
