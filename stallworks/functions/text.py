"""Text, URL and attachment cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .values import ColumnLike, as_col, first_match

#: Suffixes of images and of videos, the registered types among them.
IMAGE_SUFFIXES = (
    "avif", "bmp", "gif", "heic", "heif", "ico", "ief", "jpe", "jpeg", "jpg", "pbm", "pgm", "png", "pnm",
    "ppm", "ras", "rgb", "svg", "tif", "tiff", "webp", "xbm", "xpm", "xwd",
)
VIDEO_SUFFIXES = ("avi", "m1v", "m4v", "mkv", "mov", "movie", "mp4", "mpa", "mpe", "mpeg", "mpg", "qt", "webm")
#: Words that tick a checkbox, and the domain a checkbox may hold.
TRUTHY_WORDS = ("true", "1", "yes", "是")
CHECKBOX_DOMAIN = ("true", "false", "True", "False", "1", "0", "yes", "no", "是", "否")
#: Fixed pattern: cells that look like a link or a path.
LINK_PATTERN = r"^(https?://|//|/|\./|\.\./|~)"
_HTTP_PATTERN = r"(?i)^https?://[^/?#]+"


def canonical_name(c: ColumnLike, rules: Sequence[tuple[str, str]]) -> Column:
    """Spelling variants to one name: first rule whose fragment occurs wins."""
    col = as_col(c)
    return first_match([(F.contains(col, F.lit(part)), name) for part, name in rules], col)


def matches_any(c: ColumnLike, fragments: Sequence[str]) -> Column:
    """Regex alternation over literal fragments."""
    pattern = "|".join(f"\\Q{f}\\E" for f in fragments)
    return as_col(c).rlike(pattern)


def has(c: ColumnLike, fragment: str) -> Column:
    return F.instr(as_col(c), fragment) > 0


def strip_digits(c: ColumnLike) -> Column:
    return F.regexp_replace(as_col(c), r"\d", "")


def strip_brackets(c: ColumnLike) -> Column:
    return F.regexp_replace(as_col(c), r"\[|\]", "")


def strip_query(c: ColumnLike, marker: str = "watermark") -> Column:
    """Drop a ``?marker…`` tail up to the closing quote."""
    return F.regexp_replace(as_col(c), rf'\?{marker}[^"]*', "")


def first_part(c: ColumnLike, separator: str = "-") -> Column:
    return F.split(as_col(c), f"\\Q{separator}\\E")[0]


def quoted_list(c: ColumnLike, host: str = "") -> Column:
    """Bracketed comma list to an array of quoted items, each below ``host``."""
    items = F.split(strip_brackets(c), ",")
    return F.transform(
        items,
        lambda x: F.concat(F.lit('"' + host), F.regexp_replace(x, '"', ""), F.lit('"')),
    )


def is_truthy(c: ColumnLike) -> Column:
    return F.lower(as_col(c).cast("string")).isin(*TRUTHY_WORDS)


def looks_like_link(c: ColumnLike) -> Column:
    return F.lower(F.trim(as_col(c).cast("string"))).rlike(LINK_PATTERN)


def _bracketed(text: Column) -> Column:
    return text.startswith("[") & text.endswith("]")


def _parsed_list(text: Column) -> Column:
    # Spark's JSON reader takes single quotes too, so Python-style lists parse as well.
    return F.from_json(text, "array<string>")


def attachment_urls(c: ColumnLike) -> Column:
    """Attachment cell to its http(s) links, as an array.

    Takes one link or the text of a list; items without scheme and host are dropped
    and a malformed list is empty.
    """
    text = F.trim(as_col(c).cast("string"))
    items = F.when(_bracketed(text), _parsed_list(text)).otherwise(F.array(text))
    cleaned = F.transform(items, lambda x: F.regexp_replace(x, r"""^[\s"').]+|[\s"').]+$""", ""))
    kept = F.filter(cleaned, lambda x: x.rlike(_HTTP_PATTERN))
    return F.coalesce(kept, F.array().cast("array<string>"))


def split_multi(c: ColumnLike, separator: str = ",") -> Column:
    """Multi-value cell to a trimmed array: JSON list, separated text or one value."""
    text = F.trim(as_col(c).cast("string"))
    parsed = F.when(_bracketed(text), _parsed_list(text))
    items = F.coalesce(parsed, F.split(text, f"\\Q{separator}\\E"))
    trimmed = F.transform(items, lambda x: F.trim(x))
    kept = F.filter(trimmed, lambda x: F.length(x) > 0)
    return F.coalesce(kept, F.array().cast("array<string>"))


def with_url_prefix(items: Column, prefixes: dict[str, str]) -> Column:
    """Rewrite leading prefixes of every item; a bare ``//`` becomes https."""

    def rewrite(x: Column) -> Column:
        pairs = [
            (x.startswith(k), F.concat(F.lit(v), F.substr(x, F.lit(len(k) + 1))))
            for k, v in prefixes.items()
            if k
        ]
        pairs.append((x.startswith("//"), F.concat(F.lit("https:"), x)))
        return first_match(pairs, x)

    return F.transform(items, rewrite)


def url_path(c: ColumnLike) -> Column:
    return F.regexp_extract(as_col(c), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def url_suffix(c: ColumnLike) -> Column:
    """Lower-case suffix of the last path segment, '' when there is none."""
    return F.lower(F.regexp_extract(url_path(c), r"[^/]\.([A-Za-z0-9]+)/?$", 1))


def media_type(c: ColumnLike) -> Column:
    """image, video or unknown, by the link's suffix."""
    suffix = url_suffix(c)
    return first_match([(suffix.isin(*IMAGE_SUFFIXES), "image"), (suffix.isin(*VIDEO_SUFFIXES), "video")], "unknown")


def attachment_name(c: ColumnLike) -> Column:
    """Stable file name of a link: a short digest plus the media suffix."""
    digest = F.substring(F.sha1(as_col(c).cast("binary")), 1, 12)
    suffix = F.regexp_extract(url_path(c), r"[^/](\.[A-Za-z0-9]+)/?$", 1)
    kind = media_type(c)
    tail = first_match([(kind == "unknown", ".bin")], suffix)
    return F.concat(F.lit("attachment_"), digest, tail)
