"""Text expressions over string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in the sense of the feeds' own scripts: Unicode spaces and the byte order mark too.
SPACE = r"[\t\n\x0B\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]"
#: The same, one by one.
SPACES = "\t\n\x0b\f\r \u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"

#: Where a word of ASCII letters, digits and underscores begins and ends. Not `\b`: on some versions of Java that counts other letters as well.
WORD_START, WORD_END = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"

# Named character references and what a quote cell reads them as.
NAMED = {
    "lt": "<",
    "gt": ">",
    "quot": '"',
    "apos": "'",
    "nbsp": " ",
    "ndash": "-",
    "mdash": "-",
    "minus": "-",
    "cent": "c",
    "deg": " ",
}
_LAST_POINT = 0x10FFFF


def _references(text: Column, pattern: str, base: int) -> Column:
    """Numeric references of one base, each distinct one replaced; points beyond Unicode stay."""

    def put(done: Column, digits: Column) -> Column:
        point = F.conv(digits, base, 10).cast("decimal(20,0)")
        char = F.decode(F.unhex(F.lpad(F.hex(point.cast("long")), 8, "0")), "UTF-32")
        return F.when((F.length(digits) <= 8) & (point <= _LAST_POINT), F.replace(done, F.concat(F.lit("&#" if base == 10 else "&#x"), digits, F.lit(";")), char)).otherwise(done)

    digits = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), 1))
    return F.aggregate(digits, text, put)


def decode_entities(text: Column) -> Column:
    """Hexadecimal, then decimal, then named references; `&amp;` last, so nothing is decoded twice."""
    lower_x = F.regexp_replace(text, "&#X([0-9a-fA-F]+;)", "&#x$1")
    out = _references(lower_x, "&#x([0-9a-fA-F]+);", 16)
    out = _references(out, "&#([0-9]+);", 10)
    for name, value in NAMED.items():
        out = F.regexp_replace(out, f"(?i)&{name};", value)
    return F.regexp_replace(out, "(?i)&amp;", "&")


def squeeze(text: Column) -> Column:
    """Runs of white space become one space; both ends are trimmed."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def strip_tags(html: Column) -> Column:
    out = F.regexp_replace(html, rf"(?is)<script{WORD_END}[^>]*>.*?</script>", " ")
    out = F.regexp_replace(out, rf"(?is)<style{WORD_END}[^>]*>.*?</style>", " ")
    out = F.regexp_replace(out, r"<[^>]+>", " ")
    return squeeze(decode_entities(out))


def clean(text: Column, limit: int = 120) -> Column:
    return F.substring(squeeze(F.coalesce(text, F.lit(""))), 1, limit)


def title_case(text: Column) -> Column:
    """Lower case with the first ASCII letter of every run of word characters in upper case."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"([A-Za-z0-9_]+|[^A-Za-z0-9_]+)"), 1)
    raised = F.transform(runs, lambda w: F.when(w.rlike("^[a-z]"), F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))).otherwise(w))
    return F.array_join(raised, "")


def slug(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9.]+"), lambda w: w != "")


def escape_html(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def path(url: Column) -> Column:
    """Path with its query, as a page's signature reads it; empty for what is no URL."""
    query = F.try_parse_url(url, F.lit("QUERY"))
    whole = F.concat(F.coalesce(F.nullif(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.lit("/")), F.coalesce(F.concat(F.lit("?"), query), F.lit("")))
    return F.when(host(url).isNull(), F.lit("")).otherwise(whole)


def url_twins(url: Column, others: Column | None = None) -> Column:
    """A page's own URL, its alternatives and the twin with or without `www.`, distinct in order."""
    bare = F.regexp_extract(url, r"^(https?://)(?:www\.)?(.*)$", 1), F.regexp_extract(url, r"^(https?://)(?:www\.)?(.*)$", 2)
    twin = F.when(url.rlike(r"^https?://www\."), F.concat(*bare)).when(url.rlike("^https?://"), F.concat(bare[0], F.lit("www."), bare[1]))
    return F.array_distinct(F.array_compact(F.concat(F.array(url), F.coalesce(others, F.array().cast("array<string>")) if others is not None else F.array().cast("array<string>"), F.array(twin))))


def redact_url(url: Column) -> Column:
    return F.regexp_replace(url, r"(?i)([?&](?:[^=&#]*_)?(?:apikey|api_key|key|token|secret|sig)=)[^&#]*", "$1<redacted>")


def redact_body(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    out = F.regexp_replace(out, r'(?i)("(?:api_?key|key|token|secret|sig|password|bearer)"\s*:\s*")[^"]*(")', "$1<redacted>$2")
    return F.regexp_replace(out, rf"""(?i){WORD_START}((?:api_?key|token|secret|sig)=)[^&"'\s]+""", "$1<redacted>")


def peek(body: Column, limit: int = 1400) -> Column:
    """A redacted, squeezed head of a body that says how much it leaves out."""
    flat = redact_body(F.nullif(squeeze(body), F.lit("")))
    more = F.length(flat) - limit
    cut = F.concat(F.substring(flat, 1, limit), F.lit("… [+"), more.cast("string"), F.lit(" more]"))
    return F.when(squeeze(body) == "", F.lit(None)).when(more > 0, cut).when(body.isNotNull(), flat)


def split_postal(cell: Column, digits: str = "5") -> Column:
    """struct(town, state, zip) of `Town, ST 12345`; state and zip only where they are written. `digits`, as a regex counts, is how many of a number are the zip."""
    raw = F.trim(F.coalesce(cell, F.lit("")))
    rest = F.trim(F.coalesce(F.get(F.split(raw, ","), F.lit(1)), F.lit("")))
    shape = "^([A-Za-z]{2})" + WORD_END + rf"\s*([0-9]{{{digits}}})?"
    return F.struct(
        F.trim(F.get(F.split(raw, ","), F.lit(0))).alias("town"),
        F.nullif(F.upper(F.regexp_extract(rest, shape, 1)), F.lit("")).alias("state"),
        F.nullif(F.regexp_extract(rest, shape, 2), F.lit("")).alias("zip"),
    )
