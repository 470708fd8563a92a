"""Scalar functions of the document pipeline as JVM column expressions.

Null in gives null out unless a docstring names a default. None of them leaves whole-stage code generation for Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that a file name must not hold.
FORBIDDEN = r"[<>:\"/\\|?* \x00-\x1f]"

# Icon class by file extension.
ICONS = {
    "excel": ["xls", "xlsx", "xlsm", "csv"], "ppt": ["ppt", "pptx", "pptm"], "word": ["doc", "docx", "docm", "rtf"], "pdf": ["pdf"],
    "zip": ["zip", "rar", "7z", "tar", "gz"], "image": ["jpg", "jpeg", "png", "gif", "bmp"],
}

# Endings of a file stem that look like a copy's.
COPYLIKE = r"(?is)^(?:.*[_\-\s]\d+|.*\(\d+\)|.*copy|.*コピー)\z"


def _bare(name: Column) -> Column:
    """Forbidden characters as underscores, edges trimmed, runs of underscores as one."""
    marked = F.regexp_replace(name, FORBIDDEN, "_")
    trimmed = F.regexp_replace(marked, r"^[ ._]+|[ ._]+\z", "")
    return F.regexp_replace(F.regexp_replace(trimmed, "_+", "_"), r"^_|_\z", "")


def safe_name(name: Column) -> Column:
    """A name for a folder: at most 50 characters. Null or empty: ``NoName``; nothing left: ``_sanitized_``."""
    cut = F.substring(_bare(name), 1, 50)
    return F.when(F.coalesce(name, F.lit("")) == "", "NoName").when(cut == "", "_sanitized_").otherwise(cut)


def stem(name: Column) -> Column:
    """The name without its ending: up to the last dot that is neither first nor last."""
    return F.regexp_replace(name, r"(?s)(?<=[^.])\.[^.]+\z", "")


def suffix(name: Column) -> Column:
    """The ending that ``stem`` takes off."""
    return F.regexp_extract(name, r"(?s)[^.](\.[^.]+)\z", 1)


def sanitize_filename(name: Column, most: int = 200) -> Column:
    """A file name of at most ``most`` characters that keeps its ending. Null or empty: ``_no_name_``."""
    bare = _bare(name)
    end = suffix(bare)
    room = F.lit(most) - F.length(end)
    kept = F.regexp_replace(F.substring(stem(bare), F.lit(1), F.greatest(room, F.lit(0))), r"_+\z", "")
    long = F.when(room < 1, F.substring(bare, 1, most)).otherwise(F.concat(kept, end))
    return F.when(F.coalesce(name, F.lit("")) == "", "_no_name_").when(bare == "", "_sanitized_").when(F.length(bare) > most, long).otherwise(bare)


def strip_sequence(name: Column) -> Column:
    """Without ``.NNN`` counters right before the ending, unless nothing would be left of the stem."""
    bare = F.regexp_replace(stem(name), r"(?:\.\d{3})+\z", "")
    return F.when((bare == "") | (bare == stem(name)), name).otherwise(F.concat(bare, suffix(name)))


def icon_class(name: Column) -> Column:
    """Class of the icon for a file; ``default`` where the ending is unknown or there is none."""
    end = F.lower(F.regexp_extract(name, r"\.([^.]*)\z", 1))
    out = F.lit("default")
    for kind, ends in ICONS.items():
        out = F.when(end.isin(ends), kind).otherwise(out)
    return out


def copylike(name: Column) -> Column:
    """Whether the stem of a file name looks like that of a copy."""
    return stem(name).rlike(COPYLIKE)


def human_size(size: Column) -> Column:
    """Bytes in the unit that keeps the number below 1,024, rounded half to even."""
    units = ["B", "KB", "MB", "GB", "TB"]
    out = F.concat(F.bround(size / 1024.0**4, 0).cast("long").cast("string"), F.lit(" TB"))
    for k in (3, 2, 1, 0):
        out = F.when(size < 1024.0 ** (k + 1), F.concat(F.bround(size / 1024.0**k, 0).cast("long").cast("string"), F.lit(f" {units[k]}"))).otherwise(out)
    return F.when(size.isNotNull(), out)


def percent_encode(text: Column) -> Column:
    """Everything but unreserved characters as %XX of UTF-8."""
    return F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def notes_url(server: Column, replica: Column, unid: Column, view: Column | None = None, domain: str = "") -> Column:
    """``Notes://host/replica[/view]/unid``; null unless server, replica and unid are all given."""
    host = F.regexp_replace(F.regexp_extract(server, r"(?i)^(?:CN=)?([^/]+)", 1), r"^\z", "")
    if domain:
        host = F.when(host.contains("."), host).otherwise(F.concat(host, F.lit("." + domain.lstrip("."))))
    has = lambda c: F.coalesce(c, F.lit("")) != ""
    parts = [F.concat(F.lit("Notes://"), host), replica, *([F.when(has(view), view)] if view is not None else []), unid]
    return F.when(has(server) & has(replica) & has(unid), F.concat_ws("/", *parts))


def redirect_url(url: Column, base: str = "") -> Column:
    """The link behind a redirecting page, or the link itself where there is none."""
    if not base:
        return url
    base = base.rstrip("&")
    lead = base if base.endswith("NotesURL=") else base + ("&" if "?" in base else "?") + "NotesURL="
    return F.concat(F.lit(lead), percent_encode(url))


def link_query(label: Column) -> Column:
    """Text to search for: the document named in a link's label, else the whole label; empty for null."""
    named = F.regexp_extract(label, r"Document\s+'([^']+)'", 1)
    return F.coalesce(F.when(named != "", named), label, F.lit(""))


def search_url(label: Column, base: str) -> Column:
    """Search link for a label."""
    lead = base if "query=" in base else base + ("&" if "?" in base else "?") + "query="
    return F.concat(F.lit(lead), percent_encode(link_query(label)))


def indent_class(margin: Column) -> Column:
    """Indent class of a left margin in inches or points; empty below 0.75 inches or where unreadable."""
    number = F.regexp_extract(margin, r"^\s*([0-9.]+)\s*(?:in|pt)?\s*\z", 1).try_cast("double")
    inches = F.when(F.endswith(margin, F.lit("in")), number).when(F.endswith(margin, F.lit("pt")), number / 72.0).otherwise(F.lit(0.0))
    return F.when(inches >= 1.75, "indent-3").when(inches >= 1.25, "indent-2").when(inches >= 0.75, "indent-1").otherwise("")


def paragraph_css(align: Column, space_after: Column) -> Column:
    """Inline style of a paragraph; empty where nothing applies."""
    known = F.when(align.isin("left", "center", "right", "justify"), align).when(align == "full", "justify")
    space = space_after.try_cast("double")
    margin = F.when(space.isNotNull() & (space != 0), F.concat(F.lit("margin-bottom: "), F.round(F.greatest(space - 1, F.lit(0.0)) * 0.8, 4).cast("string"), F.lit("em;")))
    return F.concat_ws(" ", F.concat(F.lit("text-align: "), known, F.lit(";")), margin)


def ordered_type(kind: Column) -> Column:
    """``type`` of an ordered list; null for other lists."""
    out = F.lit(None).cast("string")
    # Numbering of list kinds.
    for name, mark in {"number": "1", "alphaupper": "A", "alphalower": "a", "romanupper": "I", "romanlower": "i"}.items():
        out = F.when(kind == name, mark).otherwise(out)
    return out


def span_attributes(colspan: Column, rowspan: Column, bgcolor: Column) -> Column:
    """Attributes of a table cell as text; spans of one are left out."""
    part = lambda n, c: F.when(c.try_cast("int") > 1, F.concat(F.lit(f'{n}="'), c.try_cast("int").cast("string"), F.lit('"')))
    return F.concat_ws(" ", part("colspan", colspan), part("rowspan", rowspan), F.when(bgcolor != "", F.concat(F.lit('style="background-color: '), bgcolor, F.lit(';"'))))


def squash_html(html: Column) -> Column:
    """Blanks between tags, line ends and empty spans and paragraphs out of markup without pre or code blocks."""
    out = F.regexp_replace(html, r">\s+<", "><")
    out = F.regexp_replace(F.regexp_replace(out, r"[ \t\f\x0b\r]+\n", "\n"), r"\n{2,}", "\n")
    out = F.regexp_replace(F.regexp_replace(out, r"(?i)<span(?:\s+[^>]*)?>\s*</span>", ""), r"(?i)<p(?:\s+[^>]*)?>\s*</p>", "")
    return F.regexp_replace(out, r"^\s+|\s+\z", "")


def escape_html(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def markdown_link(label: Column, href: Column) -> Column:
    """``[label](href)`` with brackets and blanks escaped; the address stands for a missing label."""
    name = F.replace(F.replace(F.coalesce(label, href, F.lit("")), F.lit("["), F.lit("\\[")), F.lit("]"), F.lit("\\]"))
    to = F.coalesce(href, F.lit("#"))
    for a, b in (("(", "\\("), (")", "\\)"), (" ", "%20")):
        to = F.replace(to, F.lit(a), F.lit(b))
    return F.concat(F.lit("["), name, F.lit("]("), to, F.lit(")"))


def markdown_cell(text: Column) -> Column:
    """Text of a table cell with bars, backticks and line breaks escaped."""
    for a, b in (("|", "\\|"), ("`", "\\`"), ("\n", "<br>")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def backticks(text: Column) -> Column:
    """Length of the longest run of backticks, 0 if there is none."""
    runs = F.transform(F.regexp_extract_all(text, F.lit("(`+)"), F.lit(1)), F.length)
    return F.coalesce(F.array_max(runs), F.lit(0))


def markdown_code(text: Column) -> Column:
    """Text as a code span whose fence is longer than any run of backticks in it."""
    fence = F.repeat(F.lit("`"), backticks(text) + 1)
    edge = F.when(text.startswith("`") | text.endswith("`"), " ").otherwise("")
    return F.concat(fence, edge, text, edge, fence)


def decorate(text: Column, styles: Column, script: Column | None = None) -> Column:
    """Text in Markdown: script innermost, then code, strike, italic, bold."""
    out = text
    if script is not None:
        out = F.when(script == "super", F.concat(F.lit("<sup>"), out, F.lit("</sup>"))).when(script == "sub", F.concat(F.lit("<sub>"), out, F.lit("</sub>"))).otherwise(out)
    has = lambda k: F.array_contains(styles, k)
    out = F.when(has("mono"), markdown_code(out)).otherwise(out)
    for keys, mark in ((("s", "strike"), "~~"), (("i",), "*"), (("b",), "**")):
        on = has(keys[0]) if len(keys) == 1 else has(keys[0]) | has(keys[1])
        out = F.when(on, F.concat(F.lit(mark), out, F.lit(mark))).otherwise(out)
    return out


def run_tags(styles: Column, script: Column) -> Column:
    """Tags around a run, outermost first."""
    has = lambda *ks: F.exists(styles, lambda x: x.isin(*ks))
    tags = F.array(F.when(has("b"), "strong"), F.when(has("i"), "em"), F.when(has("u"), "u"), F.when(has("s", "strike"), "s"), F.when(script == "super", "sup").when(script == "sub", "sub"))
    return F.array_compact(tags)


def run_css(color: Column, bgcolor: Column, size: Column) -> Column:
    """Inline style of a run."""
    part = lambda n, c: F.when(c != "", F.concat(F.lit(f"{n}: "), c, F.lit(";")))
    return F.concat_ws(" ", part("color", color), part("background-color", bgcolor), part("font-size", size))


def merge_styles(first: Column, second: Column) -> Column:
    """Ordered distinct union of two style lists, sorted; null lists count as empty."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(first, empty), F.coalesce(second, empty)))


def rgb(color: Column) -> Column:
    """Red, green and blue of ``#rrggbb``; null if it is none."""
    hex_ = F.when(color.rlike(r"^#[0-9A-Fa-f]{6}\z"), color)
    return F.when(hex_.isNotNull(), F.array(*[F.conv(F.substring(hex_, k, 2), 16, 10).cast("int") for k in (2, 4, 6)]))


def points(size: Column) -> Column:
    """A length in points (``pt`` or ``in``), null if unreadable."""
    number = F.regexp_extract(size, r"^\s*(-?[0-9.]+)\s*(?:pt|in)\s*\z", 1).try_cast("double")
    return F.when(F.endswith(size, F.lit("in")), number * 72).otherwise(number)


def trim_lead(text: Column) -> Column:
    """Without blanks, no-break and ideographic spaces at the start."""
    return F.regexp_replace(text, "^[  　]+", "")


def xml_text(text: Column) -> Column:
    """Without the control characters that XML 1.0 forbids."""
    return F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "")


def iso_day(stamp: Column) -> Column:
    """``yyyyMMdd`` of the wall clock of an ISO stamp; ``NODATE`` if missing, ``INVALIDDATE`` if it is none."""
    pattern = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,6})?)?(?:Z|[+-]\d{2}:?\d{2})?)?\z"
    day = F.substring(stamp, 1, 10).try_cast("date")
    clock = F.regexp_extract(stamp, r"[T ](\d{2}):(\d{2})(?::(\d{2}))?", 0)
    part = lambda k: F.coalesce(F.regexp_extract(stamp, r"[T ](\d{2}):(\d{2})(?::(\d{2}))?", k).try_cast("int"), F.lit(0))
    good = stamp.rlike(pattern) & day.isNotNull() & ((clock == "") | ((part(1) <= 23) & (part(2) <= 59) & (part(3) <= 59)))
    return F.when(F.coalesce(stamp, F.lit("")) == "", "NODATE").when(good, F.date_format(day, "yyyyMMdd")).otherwise("INVALIDDATE")


def domino_stamp(stamp: Column) -> Column:
    """``yyyyMMddTHHmmss,ff+zz[mm]`` as ISO with its offset (+00:00 if none is written); a bare date as a date; else unchanged."""
    part = lambda k: F.regexp_extract(stamp, r"^\s*(\d{8})T(\d{6})(?:,(\d{1,6}))?(?:([+-])(\d{2})(\d{2})?)?\s*\z", k)
    d, t = part(1), part(2)
    day = F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2))
    clock = F.concat_ws(":", F.substring(t, 1, 2), F.substring(t, 3, 2), F.substring(t, 5, 2))
    fraction = F.when(part(3).rlike("[1-9]"), F.concat(F.lit("."), F.rpad(part(3), 6, "0"))).otherwise("")
    offset = F.when(part(4) != "", F.concat(part(4), part(5), F.lit(":"), F.when(part(6) != "", part(6)).otherwise("00"))).otherwise("+00:00")
    good = day.try_cast("date").isNotNull() & (F.substring(t, 1, 2).try_cast("int") <= 23) & (F.substring(t, 3, 2).try_cast("int") <= 59) & (F.substring(t, 5, 2).try_cast("int") <= 59)
    bare = F.regexp_extract(stamp, r"^\s*(\d{8})\s*\z", 1)
    bare_day = F.concat_ws("-", F.substring(bare, 1, 4), F.substring(bare, 5, 2), F.substring(bare, 7, 2))
    return F.when((d != "") & good, F.concat(day, F.lit("T"), clock, fraction, offset)).when((bare != "") & bare_day.try_cast("date").isNotNull(), bare_day).otherwise(stamp)


def title(value: Column, values: Column, unid: Column) -> Column:
    """A title from a text or a list of texts; blank or missing: ``NoTitle_`` and the unid."""
    joined = F.array_join(F.filter(values, lambda x: F.trim(x) != ""), " ")
    text = F.coalesce(value, joined)
    return F.when(F.coalesce(F.regexp_replace(text, r"\s", ""), F.lit("")) == "", F.concat(F.lit("NoTitle_"), F.coalesce(unid, F.lit("None")))).otherwise(text)


def categories(value: Column, values: Column) -> Column:
    """Categories as a list: the list as it is, or a text cut at semicolons; never null."""
    cut = F.filter(F.transform(F.split(value, ";"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+\z", "")), lambda x: x != "")
    return F.coalesce(values, cut, F.array().cast("array<string>"))


def out_path(db: Column, form: Column, cats: Column, day: Column, name: Column) -> Column:
    """Output folder of a document: database, form, two categories at most, and the document's own."""
    folders = F.transform(F.slice(cats, 1, 2), safe_name)
    doc = F.concat(F.lit("Doc_"), day, F.lit("_"), safe_name(F.when(name != "", name).otherwise("NoTitle")))
    head = F.array(safe_name(db), safe_name(F.when(form != "", form).otherwise("NoForm")))
    return F.array_join(F.concat(head, folders, F.array(doc)), "/")


def legacy_path(db: Column, form: Column, cats: Column, day: Column, name: Column) -> Column:
    """The older layout, in which slashes in a title made folders of their own."""
    parts = F.split(F.when(name != "", name).otherwise("NoTitle"), r"[\\/]+")
    folders = F.transform(F.slice(cats, 1, 2), safe_name)
    doc = F.concat(F.lit("Doc_"), day, F.lit("_"), safe_name(F.element_at(parts, 1)))
    tails = F.transform(F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x != ""), safe_name)
    head = F.array(safe_name(db), safe_name(F.when(form != "", form).otherwise("NoForm")))
    return F.array_join(F.concat(head, folders, F.array(doc), tails), "/")


def preview(value: Column, values: Column, most: int = 200, items: int = 5) -> Column:
    """Text of a value for an appendix: the first items of a list, cut to ``most`` characters."""
    listed = F.concat(F.array_join(F.slice(values, 1, items), ", "), F.when(F.size(values) > items, " …").otherwise(""))
    text = F.coalesce(listed, value, F.lit(""))
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit(" …"))).otherwise(text)
