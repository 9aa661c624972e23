"""Native expressions over raw HTML text."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every named reference of HTML that ends in a semicolon, from Python's table of them.
NAMED_REFERENCES = {f"&{name}": text for name, text in html5.items() if name.endswith(";")}
# Comments, and elements whose content is no text of the page.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\z)"
_ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*"""


def hrefs(html: Column) -> Column:
    """Every double-quoted ``href`` value, in order, as an array."""
    return F.regexp_extract_all(html, F.lit(r'href="([^"\n]*)"'), F.lit(1))


def element_texts(html: Column, tag: str, class_: str | None = None) -> Column:
    """The stripped text of every ``tag`` element, as an array.

    For tags that do not hold themselves (headings, list items of a flat list,
    paragraphs); nested layouts need ``operators.html.select_cards``. Tags and attribute
    names are matched whatever their case, values with either quote or none. With
    ``class_`` only elements with that class among theirs are taken. Comments, scripts
    and styles count as nothing, tags inside are removed and references are decoded.
    """
    attrs = rf"(?=[\s/>]){_ATTRIBUTES}"
    if class_ is not None:
        one = rf"(?-i:\Q{class_}\E)"
        value = rf"""(?:"(?:[^"]*\s)?{one}(?:\s[^"]*)?"|'(?:[^']*\s)?{one}(?:\s[^']*)?'|{one}(?=[\s>]))"""
        attrs = rf"""(?=\s(?:[^>"']|"[^"]*"|'[^']*')*?(?<=\s|"|')class\s*=\s*{value}){_ATTRIBUTES}"""
    visible = F.regexp_replace(html, _HIDDEN, "")
    inner = F.regexp_extract_all(visible, F.lit(rf"(?is)<{tag}{attrs}>(.*?)</{tag}\s*>"), F.lit(1))
    return F.transform(inner, _plain_text)


def _plain_text(fragment: Column) -> Column:
    text = decoded(F.regexp_replace(fragment, rf"<[a-zA-Z/!?]{_ATTRIBUTES}>", ""))
    return F.regexp_replace(text, r"^[\s\x{a0}]+|[\s\x{a0}]+\z", "")


def decoded(text: Column) -> Column:
    """``text`` with its character references decoded: all named ones that end in a
    semicolon, decimal and hexadecimal ones. Others stay as they are, and so do numbers
    of no character."""
    parts = F.regexp_extract_all(text, F.lit(r"(?s)(&#?[0-9A-Za-z]+;|[^&]+|&)"), F.lit(1))
    names = F.create_map(*[F.lit(x) for pair in NAMED_REFERENCES.items() for x in pair])

    def character(part: Column) -> Column:
        decimal = F.regexp_extract(part, r"^&#0*([0-9]{1,7});$", 1)
        hexadecimal = F.regexp_extract(part, r"^&#[xX]0*([0-9A-Fa-f]{1,6});$", 1)
        number = F.when(decimal != "", decimal.cast("int")).when(hexadecimal != "", F.conv(hexadecimal, 16, 10).cast("int"))
        real = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        units = F.unhex(F.lpad(F.hex(number.cast("long")), 8, "0"))
        return (
            F.when(~part.startswith("&"), part)
            .when(real, F.decode(units, "UTF-32"))
            .otherwise(F.coalesce(F.element_at(names, part), part))
        )

    return F.when(text.contains("&"), F.array_join(F.transform(parts, character), "")).otherwise(text)
