"""HTML as a stream of tags folded over a stack of open elements.

A page becomes an array of tokens in one regular expression; ``F.aggregate``
carries the open elements over them, so a page is read once, inside the JVM and
within its own row.  The rules are those of a lenient parser:

* an end tag closes the innermost open element of its name and all that were
  opened inside it; without one it is ignored;
* void and self-closed elements have no content, ``script`` and ``style`` hold
  raw text, and what is still open at the end is closed there;
* the string of an element is its text if it has one child that is a text (or
  comment), the string of that child if it is an element, and null otherwise;
* character references in texts are decoded, unknown names stay as they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of HTML.
# ---------------------------------------------------------------------------

#: Elements without content.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")

#: Names of the characters 160 to 255, in order.
LATIN1 = ("nbsp iexcl cent pound curren yen brvbar sect uml copy ordf laquo not shy reg macr deg plusmn sup2 sup3 acute "
          "micro para middot cedil sup1 ordm raquo frac14 frac12 frac34 iquest Agrave Aacute Acirc Atilde Auml Aring AElig "
          "Ccedil Egrave Eacute Ecirc Euml Igrave Iacute Icirc Iuml ETH Ntilde Ograve Oacute Ocirc Otilde Ouml times Oslash "
          "Ugrave Uacute Ucirc Uuml Yacute THORN szlig agrave aacute acirc atilde auml aring aelig ccedil egrave eacute "
          "ecirc euml igrave iacute icirc iuml eth ntilde ograve oacute ocirc otilde ouml divide oslash ugrave uacute ucirc "
          "uuml yacute thorn yuml").split()

NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "ndash": "–", "mdash": "—", "lsquo": "‘", "rsquo": "’",
         "sbquo": "‚", "ldquo": "“", "rdquo": "”", "bdquo": "„", "hellip": "…", "bull": "•", "euro": "€", "trade": "™"}

#: What the numbers 128 to 159 stand for (Windows-1252; 129, 141, 143, 144 and 157 stand for themselves).
C1 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"

_RAW = "".join(rf"<(?i:{n})\b[^>]*>.*?</(?i:{n})\s*>|" for n in ("script", "style"))
TOKEN = (r"(?s)<!--.*?-->|" + _RAW + r"<[!?][^>]*>|</[a-zA-Z][^>]*>|"
         r"""<[a-zA-Z](?:[^'">]++|"[^"]*+"|'[^']*+')*+>|[^<]+|<""")
REFERENCE = r"&#?[0-9A-Za-z]+;?|[^&]+|&"


def decode_references(text: Column) -> Column:
    """Named, decimal and hexadecimal character references as characters."""
    table = NAMED | {name: chr(160 + i) for i, name in enumerate(LATIN1)}
    names = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])

    def char(code: Column) -> Column:
        hexed = F.lpad(F.hex(code), 8, "0")
        return (F.when((code >= 128) & (code < 160), F.substring(F.lit(C1), code.cast("int") - 127, F.lit(1)))
                 .when((code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF),
                       F.decode(F.unhex(hexed), "UTF-32"))
                 .otherwise(F.lit("�")))

    def one(piece: Column) -> Column:
        name = F.rtrim(F.substring(piece, 2, 40), F.lit(";"))
        digits = F.regexp_extract(piece, r"^&#([0-9]{1,9});?$", 1)
        hexes = F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]{1,7});?$", 1)
        return (F.when(~piece.startswith("&") | (F.length(piece) < 2), piece)
                 .when(digits != "", char(digits.cast("bigint")))
                 .when(hexes != "", char(F.conv(hexes, 16, 10).cast("bigint")))
                 .otherwise(F.coalesce(F.try_element_at(names, name), piece)))

    pieces = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)), one)
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def tokens(html: Column) -> Column:
    """array<struct<kind, name, s>>: kind is o (start tag), v (element without
    content), c (end tag), t (text), r (comment, declaration or raw element,
    with its text) or e (the end of the page)."""
    none = F.lit(None).cast("string")

    def token(kind: str, name: Column = none, s: Column = none) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"), s.alias("s"))

    def one(x: Column) -> Column:
        name = F.lower(F.regexp_extract(x, r"^</?([a-zA-Z][^\s/>]*)", 1))
        text = token("t", none, decode_references(x))
        return (F.when(~x.startswith("<") | (F.length(x) < 2), text)
                 .when(x.startswith("<!--"), token("r", none, F.regexp_extract(x, r"(?s)^<!--(.*)-->$", 1)))
                 .when(x.startswith("<!") | x.startswith("<?"), token("r", none, F.regexp_extract(x, r"(?s)^<.(.*)>$", 1)))
                 .when(x.startswith("</"), token("c", name))
                 .when(x.rlike(r"(?is)^<(script|style)\b[^>]*>.*</"),
                       token("r", none, F.regexp_extract(x, r"(?s)^<[^>]*>(.*)</[^>]*>$", 1)))
                 .when(name.isin(*VOID) | x.endswith("/>"), token("v", name))
                 .otherwise(token("o", name)))

    return F.concat(F.transform(F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)), one), F.array(token("e")))


ELEMENT = "struct<name:string,at:int,n:int,s:string>"
FOUND = "array<struct<at:int,s:string>>"


def fold_block(html: Column, heading: str, container: str, line: str) -> Column:
    """Struct over a page: ``head_at`` and ``head``, place and string of the first
    ``heading`` element; ``box`` and ``box_end``, where the ``container`` that
    encloses it most closely begins and ends; ``lines``, place and string of
    every ``line`` element."""
    no = F.lit(None).cast("int")
    root = F.array(F.struct(F.lit("").alias("name"), F.lit(-1).alias("at"), F.lit(0).alias("n"),
                            F.lit(None).cast("string").alias("s")))
    start = F.struct(F.lit(0).alias("i"), root.cast(f"array<{ELEMENT}>").alias("stack"), F.lit(False).alias("text"),
                     F.array().cast(FOUND).alias("lines"), no.alias("head_at"), F.lit(None).cast("string").alias("head"),
                     no.alias("box"), no.alias("box_end"))

    def state(acc: Column, **new: Column) -> Column:
        fields = ("i", "stack", "text", "lines", "head_at", "head", "box", "box_end")
        new = {"i": acc["i"] + 1, "text": F.lit(False)} | new
        return F.struct(*[new.get(f, acc[f]).alias(f) for f in fields])

    def child_added(stack: Column, s: Column, more: Column | int = 1) -> Column:
        top = F.element_at(stack, -1)
        changed = F.struct(top["name"].alias("name"), top["at"].alias("at"), (top["n"] + more).alias("n"), s.alias("s"))
        return F.concat(F.slice(stack, F.lit(1), F.size(stack) - 1), F.array(changed))

    def close(acc: Column, m: Column) -> Column:
        """The ``m`` innermost elements are closed, from the inside out."""
        def one(f: Column, e: Column) -> Column:
            n = e["n"] + F.when(f["has"], 1).otherwise(0)
            own = F.when(n == 1, F.when(f["has"], f["s"]).otherwise(e["s"]))
            mine = F.array(F.struct(e["at"].alias("at"), own.alias("s")))
            return F.struct(F.lit(True).alias("has"), own.alias("s"),
                            F.when(e["name"] == line, F.concat(f["lines"], mine)).otherwise(f["lines"]).alias("lines"),
                            F.when(e["at"] == acc["head_at"], own).otherwise(f["head"]).alias("head"),
                            F.when(e["at"] == acc["box"], acc["i"]).otherwise(f["box_end"]).alias("box_end"))

        begin = F.struct(F.lit(False).alias("has"), F.lit(None).cast("string").alias("s"), acc["lines"].alias("lines"),
                         acc["head"].alias("head"), acc["box_end"].alias("box_end"))
        closed = F.aggregate(F.reverse(F.slice(acc["stack"], -m, m)), begin, one)
        outer = F.slice(acc["stack"], F.lit(1), F.size(acc["stack"]) - m)
        done = F.transform(F.array(closed), lambda f: state(
            acc, stack=child_added(outer, f["s"]), lines=f["lines"], head=f["head"], box_end=f["box_end"]))
        return F.when(m > 0, done[0]).otherwise(state(acc))

    def open_(acc: Column, name: Column) -> Column:
        here = F.array(F.struct(name.alias("name"), acc["i"].alias("at"), F.lit(0).alias("n"),
                                F.lit(None).cast("string").alias("s")))
        first = acc["head_at"].isNull() & (name == heading)
        boxes = F.filter(acc["stack"], lambda e: e["name"] == container)
        return state(acc, stack=F.concat(acc["stack"], here), head_at=F.when(first, acc["i"]).otherwise(acc["head_at"]),
                     box=F.when(first, F.try_element_at(boxes, F.lit(-1))["at"]).otherwise(acc["box"]))

    def step(acc: Column, x: Column) -> Column:
        stack = acc["stack"]
        kind = x["kind"]
        s = F.element_at(stack, -1)["s"]
        names = F.reverse(F.transform(stack, lambda e: e["name"]))
        return (F.when(kind == "t", state(acc, text=F.lit(True), stack=F.when(
                    acc["text"], child_added(stack, F.concat(s, x["s"]), 0)).otherwise(child_added(stack, x["s"]))))
                 .when(kind == "r", state(acc, stack=child_added(stack, x["s"])))
                 .when(kind == "v", F.transform(F.array(open_(acc, x["name"])), lambda o: close(o, F.lit(1)))[0])
                 .when(kind == "o", open_(acc, x["name"]))
                 .when(kind == "c", close(acc, F.array_position(names, x["name"]).cast("int")))
                 .otherwise(close(acc, F.size(stack) - 1)))

    return F.aggregate(tokens(html), start, step)
