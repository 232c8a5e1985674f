"""Search index build from HTML (T5): one pass over a page's tags.

A page is split at its tags once; a fold over the tags keeps a small state
(open articles, open navigation or footers, the title heading, an open section
heading) and says for the text behind each tag whether it stays and what
stands before it. Elements may nest, attributes may hold ``>``, and comments,
scripts and styles are one token. All steps are native and linear in the
length of a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scan import bind, scan
from sitelens.functions.text import slugify
from sitelens.session import spread

# Marks of a section's start, the end of its heading tag and the
# end of its heading; tokens and elements of the markup; decoded entities.
SECTION_START = "\u0001"
ATTRIBUTES_END = "\u0003"
HEADING_END = "\u0002"
QUOTED = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>"""
TOKEN = (r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b" + QUOTED + r".*?(?:</\1\s*>|\z)"
         r"|</?[a-z]" + QUOTED + r"|<[^>]*+>")
TAG_NAME = r"^</?([a-zA-Z][a-zA-Z0-9]*)"
LINE_ENDS = ("p", "div", "li", "tr", "ul", "ol", "table", "section", "header", "blockquote", "pre")
SKIPPED = ("nav", "footer")
HEADINGS = ("h2", "h3", "h4", "h5", "h6")
HEADING_ID = r"(?i)\sid\s*=\s*[\"']?([^\"'\s>]+)"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]
NUMERIC_ENTITY = r"&#([0-9]+|[xX][0-9a-fA-F]+);"
REPLACEMENT = 0xFFFD        # for code points that no text may hold

# kinds of tags, and what stands before the text behind a tag
OTHER, LINE, ARTICLE, ARTICLE_END, SKIP, SKIP_END, TITLE, TITLE_END, HEADING, HEADING_CLOSED, BODY = range(11)
NOTHING, BREAK, START, END, END_START = range(5)


def _utf8_hex(n: Column) -> Column:
    """Hex of the UTF-8 bytes of code point ``n``."""
    def byte(v):
        return F.lpad(F.hex(v), 2, "0")

    def cont(shift):
        return byte(F.lit(0x80) + F.shiftright(n, shift) % 64)
    return (F.when(n < 0x80, byte(n))
            .when(n < 0x800, F.concat(byte(F.lit(0xC0) + F.shiftright(n, 6)), cont(0)))
            .when(n < 0x10000, F.concat(byte(F.lit(0xE0) + F.shiftright(n, 12)), cont(6), cont(0)))
            .otherwise(F.concat(byte(F.lit(0xF0) + F.shiftright(n, 18)), cont(12), cont(6), cont(0))))


def decode_numeric_entities(c: Column) -> Column:
    """``&#233;`` / ``&#xE9;`` -> the character, natively: the text is split
    at the entities, each code point is encoded as UTF-8 bytes and decoded,
    and the pieces are joined again. ``<``, ``>`` and ``&`` come out as their
    named entities and the section marks U+0001 to U+0003 as nothing; numbers
    that are no code point of a text (0, surrogates, above 10FFFF) as U+FFFD."""
    def char(code):
        hexed = F.lower(F.substring(code, 1, 1)) == "x"
        return bind(F.struct(hexed.alias("hexed"), F.regexp_replace(code, "^[xX]?0*", "").alias("digits")), number)

    def number(x):
        digits = x["digits"]
        n = F.when(F.length(digits) > 8, REPLACEMENT).when(x["hexed"], F.conv(digits, 16, 10).cast("bigint")).otherwise(
            F.try_to_number(digits, F.lit("99999999")).cast("bigint"))
        return bind(F.coalesce(n, F.lit(0)), valid)

    def valid(n):
        return bind(F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), REPLACEMENT).otherwise(n).cast("int"), spelt)

    def spelt(cp):
        return (F.when(cp == 60, F.lit("&lt;")).when(cp == 62, F.lit("&gt;"))
                .when(cp == 38, F.lit("&amp;")).when(cp.isin(1, 2, 3), F.lit(""))
                .otherwise(F.decode(F.unhex(_utf8_hex(cp)), "UTF-8")))

    def joined(x):
        chars = F.transform(F.regexp_extract_all(x, F.lit(NUMERIC_ENTITY), 1), char)
        pairs = F.arrays_zip(F.split(x, NUMERIC_ENTITY, -1).alias("piece"), chars.alias("char"))
        return F.array_join(F.transform(pairs, lambda p: F.concat(p["piece"], F.coalesce(p["char"], F.lit("")))), "")

    return bind(c, lambda x: F.when(F.instr(x, "&#") > 0, joined(x)).otherwise(x))


def clean_text(c: Column) -> Column:
    """Text between tags: a fixed set of named entities decoded (``&amp;``
    last, so nothing is decoded twice), blank runs collapsed, trimmed."""
    x = c
    for ent, ch in ENTITIES:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    x = F.regexp_replace(x, r"[ \t\f\r\x0B]{2,}|[\t\f\r\x0B]", " ")
    return F.array_join(F.filter(F.transform(F.split(x, "\n", -1), lambda line: F.trim(line)), lambda line: line != ""), "\n")


def tag_kind(tag: Column) -> Column:
    """What a tag means for the index."""
    def of(name: Column) -> Column:
        closing = F.startswith(tag, F.lit("</"))
        return (F.when(name == "br", LINE)
                .when(name == "article", F.when(closing, ARTICLE_END).otherwise(ARTICLE))
                .when(name.isin(*SKIPPED), F.when(closing, SKIP_END).otherwise(SKIP))
                .when(name == "h1", F.when(closing, TITLE_END).otherwise(TITLE))
                .when(name.isin(*HEADINGS), F.when(closing, HEADING_CLOSED).otherwise(HEADING))
                .when((name == "body") & ~closing, BODY)
                .when(name.isin(*LINE_ENDS) & closing, LINE)
                .otherwise(OTHER))

    return bind(F.lower(F.regexp_extract(tag, TAG_NAME, 1)), of)


def main_text(kinds: Column) -> Column:
    """For every tag ``2 * mark + (1 if the text behind it stays)``."""
    def folded(k_all: Column) -> Column:
        # without articles the body counts as one, without a body the page
        opens = F.when(F.array_contains(k_all, ARTICLE), ARTICLE).when(F.array_contains(k_all, BODY), BODY).otherwise(-1)

        def step(s: Column, k: Column) -> Column:
            shown = (s["depth"] > 0) & (s["skip"] == 0)
            seen = F.struct(shown.alias("shown"), ((k == HEADING) & shown).alias("starts"),
                            (s["head"] & (s["skip"] == 0) & k.isin(HEADING, HEADING_CLOSED, ARTICLE_END)).alias("ends"))
            return bind(seen, lambda x: after_tag(s, k, x["shown"], x["starts"], x["ends"]))

        def after_tag(s: Column, k: Column, shown: Column, starts: Column, ends: Column) -> Column:
            depth = F.when(k == s["opens"], s["depth"] + 1).when(
                (k == ARTICLE_END) & (s["opens"] == ARTICLE), F.greatest(s["depth"] - 1, F.lit(0))).otherwise(s["depth"])
            skip = F.when(k == SKIP, s["skip"] + 1).when(k == SKIP_END, F.greatest(s["skip"] - 1, F.lit(0))).otherwise(s["skip"])
            title = F.when(k == TITLE, True).when(k.isin(TITLE_END, HEADING, HEADING_CLOSED, ARTICLE_END), False).otherwise(s["title"])
            mark = (F.when(starts & ends, END_START).when(starts, START).when(ends, END)
                    .when(k.isin(LINE, ARTICLE_END) & shown & ~s["title"], BREAK).otherwise(NOTHING))
            head = F.when(starts, True).when(ends, False).otherwise(s["head"])
            new = F.struct(s["opens"].alias("opens"), depth.alias("depth"), skip.alias("skip"), title.alias("title"), head.alias("head"), mark.alias("out"))
            return bind(new, lambda n: F.struct(*[n[f].alias(f) for f in ("opens", "depth", "skip", "title", "head")], (
                n["out"] * 2 + ((n["depth"] > 0) & (n["skip"] == 0) & ~n["title"]).cast("int")).alias("out")))

        zero = F.struct(opens.alias("opens"), F.when(opens < 0, 1).otherwise(0).alias("depth"), F.lit(0).alias("skip"),
                        F.lit(False).alias("title"), F.lit(False).alias("head"), F.lit(0).alias("out"))
        return scan(k_all, zero, step, "int")

    return bind(kinds, folded)


def marked_text(h: Column) -> Column:
    """The main text of a page with marks at sections, without any tag."""
    def joined(x: Column) -> Column:
        tags, texts = F.regexp_extract_all(x, F.lit(TOKEN), 0), F.split(x, TOKEN, -1)
        return bind(F.struct(tags.alias("tags"), texts.alias("texts")), of_tokens)

    def of_tokens(t: Column) -> Column:
        def of_kinds(kinds: Column) -> Column:
            behind = F.slice(t["texts"], F.lit(2), F.size(t["texts"]))
            first = F.when(F.array_contains(kinds, ARTICLE) | F.array_contains(kinds, BODY), "").otherwise(F.get(t["texts"], F.lit(0)))
            rows = F.arrays_zip(t["tags"].alias("tag"), behind.alias("text"), main_text(kinds).alias("out"))
            return F.concat(first, F.array_join(F.transform(rows, piece), ""))

        return bind(F.transform(t["tags"], tag_kind), of_kinds)

    def piece(z: Column) -> Column:
        mark = F.shiftright(z["out"], 1)
        before = (F.when(mark == BREAK, "\n").when(mark == END, HEADING_END)
                  .when(mark == START, F.concat(F.lit(SECTION_START), z["tag"], F.lit(ATTRIBUTES_END)))
                  .when(mark == END_START, F.concat(F.lit(HEADING_END + SECTION_START), z["tag"], F.lit(ATTRIBUTES_END)))
                  .otherwise(""))
        return F.concat(before, F.when(z["out"] % 2 == 1, z["text"]).otherwise(""))

    return bind(h, joined)


def unique_anchors(bases: Column) -> Column:
    """Anchors in order, each one that is taken already followed by the first
    free number.

    Numbering equal bases by their order (sorted, so equal ones are
    neighbours) gives just that, unless a numbered one meets another base;
    only then they are numbered one after the other."""
    def numbered(all_: Column) -> Column:
        at = F.array_sort(F.transform(all_, lambda b, i: F.struct(b.alias("base"), i.alias("at"))))
        zero = F.struct(F.lit(None).cast("string").alias("base"), F.lit(0).alias("out"))
        nth = scan(F.transform(at, lambda x: x["base"]), zero,
                   lambda s, b: F.struct(b.alias("base"), F.when(s["base"] == b, s["out"] + 1).otherwise(0).alias("out")), "int")
        back = F.array_sort(F.transform(F.arrays_zip(at.alias("x"), nth.alias("n")), lambda z: F.struct(
            z["x"]["at"].alias("at"), F.when(z["n"] == 0, z["x"]["base"]).otherwise(
                F.concat(z["x"]["base"], F.lit("-"), z["n"].cast("string"))).alias("name"))))
        return F.transform(back, lambda x: x["name"])

    def one_by_one(all_: Column) -> Column:
        def add(used: Column, base: Column) -> Column:
            numbers = F.transform(F.sequence(F.lit(1), F.size(used) + 1), lambda n: F.concat(base, F.lit("-"), n.cast("string")))
            free = F.get(F.array_except(numbers, used), F.lit(0))
            return F.concat(used, F.array(F.when(F.array_contains(used, base), free).otherwise(base)))

        return F.aggregate(all_, F.array().cast("array<string>"), add)

    def of(all_: Column) -> Column:
        return bind(numbered(all_), lambda names: F.when(F.size(F.array_distinct(names)) == F.size(all_), names).otherwise(one_by_one(all_)))

    return bind(bases, of)


def page_sections(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                  html: str = "html") -> DataFrame:
    """T5: one record for the page (empty ``section``; text = the part before
    the first heading, or the first section's when that is empty) and one
    record per section (``h2``-``h6``), ``href = url#anchor``. The anchor is
    the heading's ``id`` or else its slug, numbered where a page repeats it.
    The first section has an empty ``section`` and its text lacks the heading,
    as in the published index. (``page_id``, ``position``) names a record.

    The main text is that of all ``<article>`` elements, else of ``<body>``,
    else of the page, without navigation, footers and the ``<h1>`` title. Each
    page is parsed in its own row, without a shuffle.
    """
    h = F.translate(F.col(html), SECTION_START + HEADING_END + ATTRIBUTES_END, "")
    title = lambda x: F.regexp_replace(F.regexp_extract(x, r"(?is)<title[^>]*>(.*?)</title>", 1), TOKEN, "")
    # every value that a lambda function reads is bound: the optimizer may
    # merge projections, and would compute it anew at every call
    text = decode_numeric_entities(bind(h, lambda x: F.concat(title(x), F.lit(SECTION_START), marked_text(x))))
    after = lambda p, mark: F.when(F.instr(p, mark) > 0, F.substr(p, F.instr(p, mark) + 1)).otherwise("")

    def part(p: Column) -> Column:
        """Of the title, the intro or a section: id, heading and text."""
        head = F.when(F.instr(p, HEADING_END) > 0, F.substring_index(p, HEADING_END, 1)).otherwise(p)
        section = F.array(after(head, ATTRIBUTES_END), after(p, HEADING_END))
        texts = F.transform(F.when(F.instr(p, ATTRIBUTES_END) > 0, section).otherwise(F.array(F.lit(""), p)), clean_text)
        tag = F.substring_index(p, ATTRIBUTES_END, 1)
        return bind(texts, lambda t: F.struct(F.regexp_extract(tag, HEADING_ID, 1).alias("id"), F.get(t, F.lit(0)).alias("head"), F.get(t, F.lit(1)).alias("body")))

    def records(x: Column) -> Column:
        secs, intro = x["secs"], F.get(x["parts"], F.lit(1))["body"]
        doc = F.struct(F.lit("").alias("anchor"), F.lit("").alias("section"),
                       F.when(intro != "", intro).otherwise(F.coalesce(F.get(secs, F.lit(0))["body"], F.lit(""))).alias("text"),
                       F.lit(0).alias("position"))
        names = unique_anchors(F.transform(secs, lambda s: F.when(s["id"] != "", s["id"]).otherwise(slugify(s["head"]))))
        rows = F.transform(F.arrays_zip(secs.alias("s"), names.alias("anchor")), lambda z, i: F.struct(
            F.concat(F.lit("#"), z["anchor"]).alias("anchor"),
            F.when(i == 0, "").otherwise(z["s"]["head"]).alias("section"),
            F.when(i == 0, z["s"]["body"]).otherwise(F.concat(z["s"]["head"], F.lit("\n"), z["s"]["body"])).alias("text"),
            (i + 1).alias("position")))
        return F.struct(F.get(x["parts"], F.lit(0))["body"].alias("title"), F.concat(F.array(doc), rows).alias("rows"))

    def of(parts: Column) -> Column:
        return bind(F.struct(parts.alias("parts"), F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))).alias("secs")), records)

    parts = F.transform(F.split(text, SECTION_START, -1), part)
    out = spread(pages.select(page_id, url, html)).select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), bind(parts, of).alias("r"))
    out = out.select("page_id", "url", F.col("r.title").alias("title"), F.inline("r.rows"))
    return out.select("page_id", F.concat("url", "anchor").alias("href"), "title", "section", "text", "position")
