"""Text of web pages by built-in regular expressions, over the whole page."""

from __future__ import annotations

import json
import re
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements that never hold article text.
DROPPED_ELEMENTS = ("script", "style", "noscript", "nav", "header", "footer", "aside", "form")

# Elements that end a line of text.
LINE_ELEMENTS = "p|br|div|li|h1|h2|h3|h4|h5|h6|tr|section|article"

# Elements that are never shown; and those that begin or end a block of text.
HIDDEN_ELEMENTS = ("head", "script", "style", "noscript", "template", "select", "textarea", "svg", "iframe")
BLOCK_ELEMENTS = (
    "address|article|aside|blockquote|body|caption|center|dd|details|dialog|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    "h[1-6]|header|hr|html|legend|li|main|nav|ol|p|pre|section|summary|table|tbody|td|tfoot|th|thead|tr|ul"
)

# Thresholds of the published decision tree on words and link density of a block and its neighbours
# (Kohlschuetter, Fankhauser, Nejdl: Boilerplate Detection using Shallow Text Features, 2010).
LINKS_HERE, LINKS_BEFORE = 0.333333, 0.555556
WORDS_HERE, WORDS_BEFORE, WORDS_AFTER = 16, 4, 15
WORDS_HERE_AFTER_LINKS, WORDS_AFTER_AFTER_LINKS = 40, 17
# A text without blanks counts as a word for so many characters.
WORD_LENGTH = 10

# Named character references, from the table that Python's standard library has of them.
ENTITIES = {name[:-1]: text for name, text in html5.items() if name.endswith(";")} | {"nbsp": " "}


def decode_entities(c: Column) -> Column:
    """Character references, named and numeric, as the characters they stand for; unknown ones stay."""

    def decoded(part: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        digits = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 8))
        code = F.when(name.startswith("#"), digits.cast("int"))
        real = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        character = F.when(code == 160, " ").when(real, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        known = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")
        text = F.coalesce(character, F.when(name != "", F.try_element_at(known, name)))
        return F.when(text.isNotNull(), F.concat(text, F.substr(part, F.length(name) + 2))).otherwise(F.concat(F.lit("&"), part))

    parts = F.split(c, "&")
    joined = F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), decoded), ""))
    return F.when(F.contains(c, F.lit("&")), joined).otherwise(c)


def squeeze(c: Column) -> Column:
    """Runs of blanks to one blank, runs of line ends (with blanks around) to one line end."""
    blanks = F.regexp_replace(c, r"[ \t\r\f]+", " ")
    lines = F.regexp_replace(blanks, r" ?\n[ \n]*", "\n")
    return F.regexp_replace(lines, r"^[ \n]+|[ \n]+$", "")


def strip_markup(c: Column) -> Column:
    """Visible text of a piece of HTML."""
    text = F.regexp_replace(c, r"(?s)<!--.*?-->", " ")
    for name in DROPPED_ELEMENTS:
        text = F.regexp_replace(text, rf"(?is)<{name}\b[^>]*>.*?</{name}>", " ")
    text = F.regexp_replace(text, rf"(?i)</?({LINE_ELEMENTS})\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", "")
    return squeeze(decode_entities(text))


def page_title(html: Column) -> Column:
    return squeeze(decode_entities(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))


def article_text(html: Column) -> Column:
    """Text of the article element, or of the whole body when the page has none."""
    article = F.regexp_extract(html, r"(?is)<article\b[^>]*>(.*)</article>", 1)
    body = F.regexp_extract(html, r"(?is)<body\b[^>]*>(.*)</body>", 1)
    part = F.when(article != "", article).when(body != "", body).otherwise(html)
    return strip_markup(part)


def let(value: Column, use) -> Column:
    """`use` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _marked(html: Column) -> Column:
    """The text of a page with \\x01 and \\x02 around links and \\x03 between blocks."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    for name in HIDDEN_ELEMENTS:
        text = F.regexp_replace(text, rf"(?is)<{name}\b[^>]*>.*?</{name}>", " ")
    text = F.regexp_replace(text, "[\x01-\x03]", " ")
    text = F.regexp_replace(text, "(?i)&#(0*[1-3]|x0*[1-3]);", " ")
    text = F.regexp_replace(text, r"(?i)<br\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"(?i)<a\b[^>]*>", "\x01")
    text = F.regexp_replace(text, r"(?i)</a\b[^>]*>", "\x02")
    text = F.regexp_replace(text, rf"(?i)</?({BLOCK_ELEMENTS})\b[^>]*>", "\x03")
    return decode_entities(F.regexp_replace(text, r"(?s)<[^>]*>", ""))


def _linked(part: Column) -> Column:
    """What follows the start of a link: a link over several blocks becomes one in each, an unclosed one ends with its block."""
    inside = F.when(F.contains(part, F.lit("\x02")), F.substring_index(part, "\x02", 1)).otherwise(F.substring_index(part, "\x03", 1))
    after = F.translate(F.substr(part, F.length(inside) + 1), "\x02", "")
    return F.concat(F.lit("\x01"), F.replace(inside, F.lit("\x03"), F.lit("\x02\x03\x01")), F.lit("\x02"), after)


def _words(text: Column) -> Column:
    counted = F.greatest(F.size(F.split(text, "[ \n]+")), F.floor(F.length(text) / WORD_LENGTH).cast("int"))
    return F.when(text == "", 0).otherwise(counted)


def text_blocks(html: Column) -> Column:
    """The blocks of a page that hold text, in order: text, words, and links, the share of the words that are links."""
    parts = let(
        F.split(_marked(html), "\x01"),
        lambda p: F.concat(F.translate(F.get(p, 0), "\x02", ""), F.array_join(F.transform(F.slice(p, 2, F.size(p)), _linked), "")),
    )

    def block(b: Column) -> Column:
        links = F.array_join(F.regexp_extract_all(b, F.lit("\x01([^\x02]*)\x02"), F.lit(1)), " ")
        return F.struct(squeeze(F.translate(b, "\x01\x02", "")).alias("text"), squeeze(links).alias("links"))

    shown = F.filter(F.transform(F.split(parts, "\x03"), block), lambda b: b["text"] != "")
    return F.transform(
        shown,
        lambda b: F.struct(b["text"].alias("text"), _words(b["text"]).alias("words"), (_words(b["links"]) / _words(b["text"])).alias("links")),
    )


def main_text(html: Column) -> Column:
    """The body of an article: the blocks of running text of a page, without menus, lists of links and short notes around.

    A block counts by its words and its share of links, and by those of its neighbours.
    """

    def running(b: Column, before: Column, after: Column) -> Column:
        words_after = F.coalesce(after["words"], F.lit(0))
        plain = (
            (b["words"] > WORDS_HERE) | (words_after > WORDS_AFTER) | (F.coalesce(before["words"], F.lit(0)) > WORDS_BEFORE)
        )
        after_links = (b["words"] > WORDS_HERE_AFTER_LINKS) | (words_after > WORDS_AFTER_AFTER_LINKS)
        behind = F.coalesce(before["links"], F.lit(0.0)) <= LINKS_BEFORE
        return (b["links"] <= LINKS_HERE) & ((behind & plain) | (~behind & after_links))

    kept = let(text_blocks(html), lambda all_: F.filter(all_, lambda b, i: running(b, F.get(all_, i - 1), F.get(all_, i + 1))))
    return F.array_join(F.transform(kept, lambda b: b["text"]), "\n")


def element_content(html: Column, selector: str) -> Column:
    """What the first element that matches holds, down to its own end; `selector` is a name, or name.class."""
    name, _, wanted = selector.partition(".")
    holds = rf"""(?=[^>]*\bclass\s*=\s*["']?[^"'>]*(?<![\w-]){re.escape(wanted)}(?![\w-]))""" if wanted else ""
    rest = F.regexp_extract(html, rf"(?is)<{name}\b{holds}[^>]*>(.*)", 1)
    # Pieces that begin with a start or an end of an element of that name: the content ends where the ends prevail.
    pieces = F.split(rest, rf"(?i)(?=</?{name}\b)")
    start = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))

    def advance(acc: Column, piece: Column) -> Column:
        turn = F.when(piece.rlike(rf"(?i)^</{name}\b"), -1).when(piece.rlike(rf"(?i)^<{name}\b"), 1).otherwise(0)
        depth = F.when(acc["depth"] > 0, acc["depth"] + turn).otherwise(0)
        return F.struct(depth.alias("depth"), F.when(depth > 0, F.concat(acc["text"], piece)).otherwise(acc["text"]).alias("text"))

    return F.aggregate(pieces, start, advance, lambda acc: acc["text"])


def anchor_texts(html: Column, container: str) -> Column:
    """Texts of the links at any depth below list items of the first `container`, in page order."""
    items = F.regexp_extract_all(element_content(html, container), F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), 1)
    anchors = F.flatten(F.transform(items, lambda i: F.regexp_extract_all(i, F.lit(r"(?is)<a\b[^>]*>(.*?)</a>"), F.lit(1))))
    return F.transform(anchors, lambda a: squeeze(decode_entities(F.regexp_replace(a, r"(?s)<[^>]*>", ""))))
