"""Column expressions on HTML: text, paragraphs, links."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.functions.text import absolute_url, strip

# Elements whose content is no text of the page.
DROPPED_ELEMENTS = ("script", "style", "applet", "button", "frameset", "noframes", "select", "textarea")

#: Of these the content is no markup either; never closed, they go on to the end of the page.
_RAW = ("script", "style", "textarea")
# Elements without content, and boxes beside a page's content.
VOID_ELEMENTS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
BOXES = ("div", "section", "aside", "nav", "table")

# The grammar of a page. A value is quoted or bare: a quote opens a value only right behind an equals sign, and one that never closes is a letter like others.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_ATTRIBUTES = rf"(?:[^>=]++|=\s*+{_VALUE})*+"
_END = r"(?:>|\z)"
_COMMENT = r"<!--(?:-?>|.*?(?:--!?>|\z))"
_RAW_ELEMENT = rf"<({'|'.join(_RAW)})(?=[\s/>]){_ATTRIBUTES}{_END}(?:.*?</\1(?=[\s/>])[^>]*+{_END}|.*+)"
_OTHER_DROPPED = rf"<({'|'.join(x for x in DROPPED_ELEMENTS if x not in _RAW)})(?=[\s/>]){_ATTRIBUTES}>.*?</\2\s*+>"
_TAG = rf"</?+[a-z][^\s/>]*+{_ATTRIBUTES}{_END}"
_DECLARATION = rf"<[!?/][^>]*+{_END}"
_MARKUP = rf"(?is){_COMMENT}|{_RAW_ELEMENT}|{_OTHER_DROPPED}|{_TAG}|{_DECLARATION}"
_TOKEN = rf"{_MARKUP}|[^<]++|<"


def tokens(html: Column) -> Column:
    """The page as ``array<struct<name, token>>``, in order and without a gap.

    ``name`` is that of a tag in lower case, with a slash in front for an end tag; ``!`` for comments, declarations and dropped elements, with all their content;
    empty for text.
    """
    def named(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"^<(/?[a-zA-Z][^\s/>]*)", 1))
        markup = t.startswith("<") & (t != "<")
        return F.struct(F.when(~markup, "").when((name == "") | name.isin(*DROPPED_ELEMENTS), "!").otherwise(name).alias("name"), t.alias("token"))

    return F.transform(F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0)), named)


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, character references decoded; the first one counts. Empty when there is none."""
    other = rf"(?:[\s/]*+(?!{name}\s*+=)[^\s/=>]++(?:\s*+=\s*+{_VALUE})?+)*+"
    value = F.regexp_extract(tag, rf"(?is)^<[a-z][^\s/>]*+{other}[\s/]*+{name}\s*+=\s*+({_VALUE})", 1)
    return decode_entities(F.regexp_replace(value, r"""(?s)^"(.*)"$|^'(.*)'$""", "$1$2"), in_attribute=True)


def _entity_map() -> Column:
    names = {**name2codepoint, "apos": ord("'")}
    names |= {n.upper(): names[n] for n in ("amp", "lt", "gt", "quot", "copy", "reg")}
    pairs = [F.lit(x) for name, code in names.items() for x in (name, chr(code))]
    return F.create_map(*pairs)


#: All names, and those that are read without a semicolon as well: those of the first 256 characters. The longest one that fits counts.
_LONG = "|".join(sorted(name2codepoint, key=lambda n: (-len(n), n)) + ["apos", "AMP", "LT", "GT", "QUOT", "COPY", "REG"])
_SHORT = "|".join(sorted([n for n, code in name2codepoint.items() if code < 256] + ["AMP", "LT", "GT", "QUOT", "COPY", "REG"], key=lambda n: (-len(n), n)))


def decode_entities(c: Column, in_attribute: bool = False) -> Column:
    """Replace named and numeric character references, each exactly once.

    The text is split at its ampersands, and each piece looks for one reference at its start. Some may lack the semicolon, but not
    in an attribute before a letter, a digit or an equals sign, where it is likely a parameter of an address.
    """

    def character(ref: Column) -> Column:
        digits = F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, 3, 6), 16, 10)).when(
            ref.startswith("#"), F.substring(ref, 2, 7))
        valid = F.filter(F.array(digits.cast("int")), lambda n: n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF))
        chars = F.transform(valid, lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        return F.coalesce(F.try_element_at(_entity_map(), ref), F.get(chars, F.lit(0)))

    def decode_piece(s: Column) -> Column:
        behind = F.length(s["ref"]) + 1
        behind = behind + F.substring(s["piece"], behind, F.lit(1)).eqNullSafe(";").cast("int")
        return F.coalesce(F.concat(s["char"], F.substring(s["piece"], behind, F.length(s["piece"]))), F.concat(F.lit("&"), s["piece"]))

    until = "(?![=A-Za-z0-9])" if in_attribute else ""
    reference = rf"^((?:#[0-9]{{1,7}}+|#[xX][0-9a-fA-F]{{1,6}}+)(?:(?=;)|(?![0-9a-fA-F]){until})|(?:{_LONG})(?=;)|(?:{_SHORT}){until})"
    pieces = F.split(c, "&", -1)
    parts = F.transform(pieces, lambda p, i: F.struct(
        p.alias("piece"), i.alias("i"), F.regexp_extract(p, reference, 1).alias("ref")))
    parts = F.transform(parts, lambda s: F.struct(
        s["piece"].alias("piece"), s["i"].alias("i"), s["ref"].alias("ref"),
        F.when((s["i"] > 0) & (s["ref"] != ""), character(s["ref"])).alias("char")))
    return F.array_join(F.transform(parts, lambda s: F.when(s["i"] == 0, s["piece"]).otherwise(decode_piece(s))), "")


def strip_markup(html: Column) -> Column:
    """Drop comments, scripts, styles and tags, keep everything else as it stands."""
    return decode_entities(F.regexp_replace(html, _MARKUP, ""))


def _between(parts: Column, element_id: str) -> Column:
    """Tokens in the element with this id; null when there is none. An element never closed goes on to the end."""

    def step(acc: Column, t: Column) -> Column:
        opens = acc["start"].isNull() & ~t["name"].startswith("/") & t["token"].contains(element_id) & (t["name"] != "") & (t["name"] != "!")
        here = F.when(opens, attribute(t["token"], "id") == element_id).otherwise(False)
        depth = F.when(here, F.when(t["name"].isin(*VOID_ELEMENTS), 0).otherwise(1)).when(acc["start"].isNull() | acc["end"].isNotNull(), acc["depth"]).otherwise(
            acc["depth"] + (t["name"] == acc["name"]).cast("int") - (t["name"] == F.concat(F.lit("/"), acc["name"])).cast("int"))
        start = F.when(here, acc["i"] + 1).otherwise(acc["start"])
        return F.struct((acc["i"] + 1).alias("i"), F.when(here, t["name"]).otherwise(acc["name"]).alias("name"), depth.alias("depth"), start.alias("start"),
                        F.when(acc["end"].isNull() & start.isNotNull() & (depth == 0), F.when(here, acc["i"] + 1).otherwise(acc["i"])).otherwise(acc["end"]).alias("end"))

    nothing = F.lit(None).cast("int")
    begin = F.struct(F.lit(0).alias("i"), F.lit(None).cast("string").alias("name"), F.lit(0).alias("depth"), nothing.alias("start"), nothing.alias("end"))
    found = F.aggregate(parts, begin, step)
    # Through an array of one, so that what is found is worked out once.
    cut = F.transform(F.array(found), lambda f: F.when(f["start"].isNotNull(), F.slice(parts, f["start"] + 1, F.coalesce(f["end"], F.size(parts)) - f["start"])))
    return F.get(cut, F.lit(0))


def inside(html: Column, element_id: str | None) -> Column:
    """The markup in the element with this id; null when there is none."""
    if element_id is None:
        return html
    return F.array_join(F.transform(_between(tokens(html), element_id), lambda t: t["token"]), "")


def _boxed(depth: Column, name: Column, boxes: tuple[str, ...]) -> Column:
    """How many boxes are open behind this token."""
    opens, closes = name.isin(*boxes), name.isin(*[f"/{b}" for b in boxes])
    return F.greatest(F.lit(0), depth + opens.cast("int") - closes.cast("int"))


def _raw_paragraphs(html: Column, within: str | None = None) -> Column:
    """Text of each paragraph outside tables as it stands. A new paragraph ends an open one."""
    parts, boxes = (tokens(html), ("table",)) if within is None else (_between(tokens(html), within), BOXES)

    def step(acc: Column, t: Column) -> Column:
        depth, name = _boxed(acc["depth"], t["name"], boxes), t["name"]
        own = depth == 0
        starts = own & (name == "p")
        ends = own & name.isin("p", "/p")
        done = F.when(ends & acc["text"].isNotNull(), F.concat(acc["done"], F.array(acc["text"]))).otherwise(acc["done"])
        text = F.when(starts, "").when(ends, F.lit(None)).when(own & (name == ""), F.concat(acc["text"], t["token"])).otherwise(acc["text"])
        return F.struct(depth.alias("depth"), text.alias("text"), done.alias("done"))

    begin = F.struct(F.lit(0).alias("depth"), F.lit(None).cast("string").alias("text"), F.array().cast("array<string>").alias("done"))
    return F.aggregate(parts, begin, step, lambda acc: F.when(acc["text"].isNull(), acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["text"]))))


def _paragraph_text(raw: Column) -> Column:
    return strip(decode_entities(raw))


def paragraphs(html: Column, within: str | None = None) -> Column:
    """Texts of all paragraphs outside tables.

    ``within`` is the id of the element that holds the content proper; paragraphs of boxes in it don't count.
    """
    return F.transform(_raw_paragraphs(html, within), _paragraph_text)


def first_paragraph(html: Column, within: str | None = None) -> Column:
    return _paragraph_text(F.get(_raw_paragraphs(html, within), F.lit(0)))


def first_long_paragraph(html: Column, longer_than: int = 30, within: str | None = None) -> Column:
    """First paragraph of more than ``longer_than`` characters, null when there is none.

    Paragraphs behind the one found are not cleaned.
    """

    def if_long(raw: Column) -> Column:
        return F.get(F.filter(F.array(_paragraph_text(raw)), lambda t: F.char_length(t) > longer_than), F.lit(0))

    return F.aggregate(_raw_paragraphs(html, within), F.lit(None).cast("string"), lambda found, p: F.coalesce(found, if_long(p)))


def list_links(html: Column, base: str, within: str | None = None) -> Column:
    """Anchors of the first list on the page as ``array<struct<name, url>>``, in page order.

    Only anchors that stand directly in an entry of that list count, not those of nested lists
    or inside other elements; an entry that ends closes what is open in it. With ``within``, the id of the element that holds the content, the list has to stand
    directly in it, not in a box such as a table of contents.
    """
    parts, boxes = (tokens(html), ()) if within is None else (_between(tokens(html), within), BOXES)
    # What the fold needs: text and tags, without elements that hold nothing.
    parts = F.filter(parts, lambda t: ~t["name"].isin("!", *VOID_ELEMENTS))

    def step(acc: Column, t: Column) -> Column:
        name, before = t["name"], acc["depth"]
        box = _boxed(acc["box"], name, boxes) if boxes else F.lit(0)
        own = (box == 0) & ~acc["done"]
        opens = own & ((name == "ul") | ((before > 0) & (name == "ol")))
        closes = own & (before > 0) & name.isin("/ul", "/ol")
        depth = before + opens.cast("int") - closes.cast("int")
        entry = own & (before == 1) & (depth == 1)
        edge, anchor, leaves = name.isin("li", "/li"), name == "a", name == "/a"
        other = entry & ~edge & ~anchor & ~leaves & (name != "") & acc["href"].isNull()
        inner = F.when(entry & edge, 0).when(opens | closes, 0).when(other & name.startswith("/"), F.greatest(acc["inner"] - 1, F.lit(0))).when(other, acc["inner"] + 1).otherwise(acc["inner"])
        stops = acc["href"].isNotNull() & ((entry & (edge | anchor | leaves)) | opens | closes)
        links = F.when(stops & (acc["href"] != ""), F.concat(acc["links"], F.array(F.struct(acc["text"].alias("text"), acc["href"].alias("href"))))).otherwise(acc["links"])
        starts = entry & anchor & (acc["inner"] == 0)
        href = F.when(starts, attribute(t["token"], "href")).when(stops, F.lit(None)).otherwise(acc["href"])
        text = F.when(starts, "").when(entry & (name == "") & acc["href"].isNotNull(), F.concat(acc["text"], t["token"])).otherwise(acc["text"])
        return F.struct(box.alias("box"), depth.alias("depth"), (acc["done"] | (closes & (depth == 0))).alias("done"), inner.alias("inner"), href.alias("href"), text.alias("text"),
                        links.alias("links"))

    begin = F.struct(F.lit(0).alias("box"), F.lit(0).alias("depth"), F.lit(False).alias("done"), F.lit(0).alias("inner"), F.lit(None).cast("string").alias("href"),
                     F.lit("").alias("text"), F.array().cast("array<struct<text:string,href:string>>").alias("links"))
    links = F.aggregate(parts, begin, step, lambda acc: acc["links"])
    return F.transform(links, lambda x: F.struct(strip(decode_entities(x["text"])).alias("name"), absolute_url(x["href"], base).alias("url")))
