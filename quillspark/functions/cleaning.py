"""Cleaning rules as Column -> Column functions, and the ordered pipeline of them.

Every rule is a built-in expression, so a whole pipeline is one projection over
the scan and no row leaves the JVM. Patterns are written for Java's engine:
(?U) for Unicode classes, (?d) for \\n as the only line end, (?u) with (?i).
Patterns are tried at every character, and there Unicode classes, word bounds
and classes of several ranges are dear; so patterns first look at something
plain that most characters are not.
"""

from __future__ import annotations

import re
from functools import reduce
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.functions import rules

NBSP, NNBSP, DASH, QUOTE = "\u00a0", "\u202f", "\u2014", "\u2019"
OPEN, CLOSE = "\u00ab", "\u00bb"

#: The characters of (?U)\\s.
WHITE = "\t\n\x0b\f\r \u0085\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def sub(text: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(by))


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(text, F.lit(WHITE))


# ---- step 1: encoding ----


#: Characters beyond Latin-1 that windows-1252 has.
_BEYOND_LATIN = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def _mojibake() -> dict[str, str]:
    """UTF-8 of windows-1252's characters read as windows-1252, and the characters meant; longer ones first."""
    pairs = {}
    for letter in [*_BEYOND_LATIN, *map(chr, range(0xA1, 0x100))]:
        try:
            pairs[letter.encode().decode("cp1252")] = letter
        except UnicodeDecodeError:
            continue
    return pairs


def repair_mojibake(text: Column) -> Column:
    """Characters whose UTF-8 bytes were read as windows-1252; only texts that show the signs are touched."""
    repaired = reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), _mojibake().items(), text)
    return F.when(text.rlike("[ÃÂâÅÆË]."), repaired).otherwise(text)


def entities() -> dict[str, str]:
    """Named HTML entities of single characters, from Python's table of HTML 4."""
    return {f"&{name};": chr(code) for name, code in name2codepoint.items()}


def decode_entities(text: Column) -> Column:
    """Named entities of single characters as these, once, in texts without markup."""
    table = F.create_map(*(F.lit(x) for pair in entities().items() for x in pair))
    pieces = F.regexp_extract_all(text, F.lit(r"(?s)&[A-Za-z][A-Za-z0-9]*;|&?[^&]*"), F.lit(0))
    decoded = F.array_join(F.transform(pieces, lambda p: F.coalesce(F.try_element_at(table, p), p)), "")
    return F.when(text.rlike("&[A-Za-z][A-Za-z0-9]*;") & ~text.contains("<"), decoded).otherwise(text)


def narrow(text: Column) -> Column:
    """Full-width letters, digits and marks as plain ones."""
    plain = F.translate(text, "".join(map(chr, range(0xFF01, 0xFF5F))) + "\u3000", "".join(map(chr, range(0x21, 0x7F))) + " ")
    return F.when(text.rlike("[\uff01-\uff5e\u3000]"), plain).otherwise(text)


def plain_line_ends(text: Column) -> Column:
    """Every kind of line end as \\n."""
    return sub(text, r"[\r\x{85}\x{2028}\x{2029}](?:(?<=\r)\n)?", "\n")


def drop_controls(text: Column) -> Column:
    """Control characters other than tabs and line ends; for texts that no whitelist has passed."""
    return sub(text, r"(?![\x20-\x7E])[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")


def composed(text: Column) -> Column:
    """Canonical composition, by the Unicode library that Spark brings for its collations, where texts hold anything beyond Latin letters."""
    made = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))
    return F.when(text.rlike("[^\\x00-\u02ff]"), made).otherwise(text)


def drop_stray_a(text: Column) -> Column:
    return sub(F.replace(text, F.lit("Â" + NBSP), F.lit(NBSP)), r"(?U)Â(?=\s)", "")


def straighten_quotes(text: Column) -> Column:
    return F.translate(text, "\u2019\u2018\u201c\u201d\u2013\u2014", "''\"\"--")


def drop_unreadable(text: Column) -> Column:
    """Replacement marks and the private use area."""
    return sub(text, "[\ufffd\ue000-\uf8ff]", "")


def whitelist(text: Column) -> Column:
    """Printable ASCII, Latin letters, line breaks and tabs alone."""
    passed = "\\x20-\\x7E\u00a0-\u024f\u1e00-\u1eff\\n\\t"
    return F.when(text.rlike(rf"\A[{passed}]*+\z"), text).otherwise(sub(text, rf"(?![\x20-\x7E])[^{passed}]++", ""))


def unify_newlines(text: Column) -> Column:
    return sub(sub(text, r"\r\n?", "\n"), r"\n{4,}", "\n\n\n")


# ---- step 2: Unicode look-alikes ----


def fix_unicode(text: Column) -> Column:
    """Look-alike characters and bidirectional marks, in one translation."""
    gone = [c for c, to in rules.LOOKALIKES.items() if not to]
    one = {c: to for c, to in rules.LOOKALIKES.items() if len(to) == 1}
    marks = [chr(c) for c in (0x200E, 0x200F, *range(0x202A, 0x202F), *range(0x2066, 0x206A))]
    text = F.translate(text, "".join([*one, *gone, *marks]), "".join(one.values()))
    for c, to in rules.LOOKALIKES.items():
        if len(to) > 1:
            text = F.replace(text, F.lit(c), F.lit(to))
    return text


# ---- step 3: OCR ----


def repair_articles(text: Column) -> Column:
    """I read for l in elided and plain articles."""
    text = sub(text, r"(?U)I(?<=\bI)(?=['’][a-zà-ÿ])", "l")
    return sub(text, r"(?U)I(?<=\bI)(a|es?)\b", "l$1")


def join_hyphenated(text: Column) -> Column:
    return sub(text, r"(?U)([a-zà-ÿ])-\s*\n\s*([a-zà-ÿ])", "$1$2")


def repair_rn(text: Column) -> Column:
    """rn read for m in legal words."""
    words = F.regexp_extract_all(text, F.lit(r"(?U)\w+|\W+"), F.lit(0))

    def repaired(word: Column) -> Column:
        right = F.replace(word, F.lit("rn"), F.lit("m"))
        known = F.lower(right).isin(*rules.WORDS_WITH_M) & ~F.lower(word).isin(*rules.WORDS_WITH_RN)
        return F.when(word.contains("rn") & known, right).otherwise(word)

    return F.when(text.contains("rn"), F.array_join(F.transform(words, repaired), "")).otherwise(text)


def single_spaces(text: Column) -> Column:
    return sub(text, r"(?U)(?<=\S)[ \t]{2,}(?=\S)", " ")


# ---- step 4: typography ----

_CAPITAL = "[A-ZÀ-ÖØ-Ý]"
_LETTER = "A-Za-zÀ-ſ"


def _before(mark: str) -> str:
    """Looks whether a character is followed by a mark or by what may be a blank."""
    return rf"(?s)(?=.[\s{mark}\x{{80}}-\x{{ffff}}])"


#: Ordered typographic rules: name, pattern, replacement.
TYPOGRAPHY = (
    ("spaced_capitals", rf"(?U)(?=[ ])(?:(?<=\b{_CAPITAL})[ ]+(?={_CAPITAL}\s+{_CAPITAL}\b)|(?<=\b{_CAPITAL}\s{{1,8}}{_CAPITAL})[ ]+(?={_CAPITAL}\b))", ""),
    ("quotes", r'"([^"]*?)"', f"{OPEN}{NBSP}$1{NBSP}{CLOSE}"),
    ("open_quote", rf"(?U){OPEN}\s*(\S)", f"{OPEN}{NBSP}$1"),
    ("close_quote", rf"{_before(CLOSE)}(?U)(\S)\s*+{CLOSE}", f"$1{NBSP}{CLOSE}"),
    ("high_marks", rf"{_before(';?!')}(?U)(\S)\s*+([;?!])", f"$1{NNBSP}$2"),
    ("colon", rf"{_before(':')}(?Ud)(\S)\s*+:(?=[\s{OPEN}]|\n?\z)", f"$1{NBSP}:"),
    ("space_after", rf"([.,;:!?])(?=[{_LETTER}{OPEN}])", "$1 "),
    ("dashes", r"(?U)(?=-|[^!-~])(?:(?<!\s)\s++)?---?\s*+", f" {DASH} "),
    ("apostrophes", rf"([{_LETTER}])'([{_LETTER}])", f"$1{QUOTE}$2"),
    ("leaders", r"\.{4,}", "..."),
    ("code_articles", r"(?U)([LRDA])(?<=\b.)\.(?=\d)", "$1. "),
    ("numbers", r"(?U)([nN])°\s*(\d)", f"$1°{NBSP}$2"),
    ("space_before", r"(?U)(?=[^!-~])(?<!\s)\s++([.,])", "$1"),
    ("double_spaces", r"[ ]{2,}", " "),
)


def fix_typography(text: Column) -> Column:
    """The rules in order; the first one, which looks behind at every blank, only where capitals stand apart."""
    (_, pattern, by), *others = TYPOGRAPHY
    apart = text.rlike(rf"{_CAPITAL}[ ]+{_CAPITAL}\s|{_CAPITAL}\s+{_CAPITAL}[ ]+{_CAPITAL}")
    return reduce(lambda c, rule: sub(c, rule[1], rule[2]), others, F.when(apart, sub(text, pattern, by)).otherwise(text))


# ---- step 5: structure ----

PAGE_LINE = (
    r"(?Umd)^\s*(?:=+\s*(?:PAGE|Page|page)\s*\d+\s*=+|(?:PAGE|Page|page)\s*\d+(?:\s*/\s*\d+)?(?:\s+sur\s+\d+)?"
    r"|(?:P\.?|p\.?)\s*\d+|\d+\s*/\s*\d+|[-—–]\s*\d+\s*[-—–]|\d+)(?:\s*)$"
)


def strip_page_numbers(text: Column) -> Column:
    text = sub(sub(text, PAGE_LINE, ""), r"(?U)[Pp](?<=\b.)age\s*\d+\b", "")
    text = sub(text, r"(?Umd)^=+\s*=+$", "")
    return strip(sub(text, r"\n{3,}", "\n\n"))


def normalize_act_words(text: Column) -> Column:
    """The verb of an act, alone on its line, in capitals with its accents."""
    alone = r"(?iumUd)^(\s*){}(\s*)$"
    text = sub(text, alone.format("ARR[ÊE]TE"), "$1ARRÊTE$2")
    text = sub(text, alone.format("ARR[ÊE]TÉ"), "$1ARRÊTÉ$2")
    return sub(sub(text, alone.format("D[ÉE]CIDE"), "$1DÉCIDE$2"), alone.format("ORDONNE"), "$1ORDONNE$2")


def article_heading() -> str:
    """An article's heading: groups 2 to 4 hold its number as a word, in digits, or ``unique``."""
    words = "|".join(sorted(rules.ORDINALS, key=len, reverse=True))
    number = rf"(?:({words})|0*(\d+)\s*(?:er|[eè]re|[eè]me|e)?|(UNIQUE))"
    return rf"(?iumUd)^(\s*+)(?:ARTICLE|ART\.?\s*)\s*{number}\s*[:.—–-]?\s*"


def normalize_articles(text: Column) -> Column:
    """Article headings as ``Article n — `` on a new line; ordinal words first, then digits, then unique.

    One pass puts a heading's number between marks; ordinal words between them
    are looked up piece by piece.
    """
    mark, end = "\u0001", "\u0002"
    pieces = F.split(sub(text, article_heading(), f"$1\n{mark}$2$3$4{end} {DASH} "), mark, -1)
    numbers = F.create_map(*(F.lit(x) for word, n in rules.ORDINALS.items() for x in (word, str(n))))

    def one(piece: Column, at: Column) -> Column:
        said = F.lower(F.substring_index(piece, end, 1))
        rest = F.substring(piece, F.length(said) + 2, F.length(piece))
        return F.when(at == 0, piece).otherwise(F.concat(F.lit("Article "), F.coalesce(F.try_element_at(numbers, said), said), rest))

    return F.when(text.rlike(r"(?imU)^\s*+ART"), F.array_join(F.transform(pieces, one), "")).otherwise(text)


def normalize_keywords(text: Column) -> Column:
    text = sub(text, r"(?mUd)^(\s*)(?:VU|vu)\b", "$1Vu")
    text = sub(text, r"(?mUd)^(\s*)(?:CONSID[ÉE]RANT|Consid[ée]rant|consid[ée]rant)\b", "$1Considérant")
    return sub(text, r"(?mUd)^(\s*)(?:ATTENDU|attendu)\b", "$1Attendu")


def fix_structure(text: Column) -> Column:
    return normalize_keywords(normalize_articles(normalize_act_words(strip_page_numbers(text))))


# ---- step 6: casing ----


def _titles() -> dict[str, str]:
    """Titles as they are written in capitals, without accents and with single spaces, and their plain form."""
    plain = {}
    for pattern, title in rules.TITLES:
        written = re.sub(r"\[(.)(.)\]", r"\2", pattern).replace(r"\s+", " ")
        for form in {written.replace("?", ""), re.sub(".[?]", "", written)}:
            plain.setdefault(form, title)
    return plain


def lower_titles(text: Column) -> Column:
    """Titles in capitals to lower case, or to an initial capital at the start of a sentence.

    One pass puts marks around titles; each is then looked up with what stands before it.
    """
    mark, end, blank = "\u0001", "\u0002", "[ \\t\u00a0\u202f]*"
    first = "".join(sorted({p[0] for p, _ in rules.TITLES}))
    pattern = rf"(?U)(?=[{first}])\b(?:{'|'.join(p for p, _ in rules.TITLES)})\b"
    pieces = F.split(sub(text, f"({pattern})", f"{mark}$1{end}"), mark, -1)
    before = F.concat(F.array(F.lit("")), F.slice(pieces, F.lit(1), F.size(pieces) - 1))
    plain = F.create_map(*(F.lit(x) for pair in _titles().items() for x in pair))

    def one(pair: Column, at: Column) -> Column:
        piece, previous = pair["piece"], pair["before"]
        title = F.substring_index(piece, end, 1)
        small = F.try_element_at(plain, F.translate(sub(title, r"(?U)\s+", " "), "ÉÈ", "EE"))
        gap = F.when(at == 1, previous).otherwise(F.substring_index(previous, end, -1))
        opens = gap.rlike(rf"[\n.!—]{blank}\z") | ((at == 1) & gap.rlike(rf"^{blank}\z"))
        shown = F.when(opens, F.concat(F.upper(F.substring(small, 1, 1)), F.substring(small, 2, 1 << 30))).otherwise(small)
        return F.when(at == 0, piece).otherwise(F.concat(shown, F.substring(piece, F.length(title) + 2, F.length(piece))))

    both = F.arrays_zip(pieces.alias("piece"), before.alias("before"))
    return F.when(text.rlike(pattern), F.array_join(F.transform(both, one), "")).otherwise(text)


def is_title_line(line: Column) -> Column:
    letters = F.regexp_count(line, F.lit(r"\p{L}"))
    return (letters >= 3) & (F.regexp_count(line, F.lit(r"\p{Lu}")) >= 0.7 * letters)


def lower_capitals(text: Column) -> Column:
    """Long or accented words in capitals to lower case, outside title lines.

    A line is cut into capital words and what stands between; a word starts a
    sentence when what stands before it is blank to the line's start or to a
    full stop, an exclamation mark or a dash.
    """
    capital = r"(?U)(?=[A-ZÀ-Ü])\b[A-ZÀ-Ü]{3,}\b"
    piece = rf"{capital}|(?s)(?:(?!{capital}).)+"
    protected = sorted({*rules.ACRONYMS, *rules.ACT_WORDS})

    def lowered(line: Column) -> Column:
        parts = F.regexp_extract_all(line, F.lit(piece), F.lit(0))

        def one(word: Column, at: Column) -> Column:
            small = F.lower(word)
            before = F.when(at > 0, F.get(parts, at - 1)).otherwise(F.lit(""))
            opens = before.rlike(r"(?:^|[.!—])[ \t\u00a0\u202f]*$") & ((at == 0) | ~before.rlike(r"^[ \t\u00a0\u202f]*$") | (at == 1))
            kept = word.isin(*protected) | ((F.length(word) <= 10) & word.rlike(r"^[A-Z]+$"))
            made = F.when(opens, F.concat(F.upper(F.substring(small, 1, 1)), F.substring(small, 2, 1 << 30))).otherwise(small)
            return F.when(word.rlike(rf"^{capital}$") & ~kept, made).otherwise(word)

        return F.when(line.rlike(capital) & ~is_title_line(line), F.array_join(F.transform(parts, one), "")).otherwise(line)

    return F.when(text.rlike(capital), F.array_join(F.transform(F.split(text, "\n", -1), lowered), "\n")).otherwise(text)


# ---- step 7: final touches ----


def fix_final(text: Column) -> Column:
    text = sub(sub(text, r"(?md)[ \t]+$", ""), r"\n{4,}", "\n\n\n")
    text = F.when((text != "") & ~text.endswith("\n"), F.concat(text, F.lit("\n"))).otherwise(text)

    def indented(line: Column) -> Column:
        n = F.length(F.regexp_extract(line, "^([\\u00a0\\u202f]*)", 1))
        return F.when(n > 0, F.concat(F.repeat(F.lit(" "), n), F.substring(line, n + F.lit(1), F.length(line)))).otherwise(line)

    return F.when(text.rlike("(?m)^[\\u00a0\\u202f]"), F.array_join(F.transform(F.split(text, "\n", -1), indented), "\n")).otherwise(text)


def typography_audit(rows: DataFrame, column: str) -> DataFrame:
    """The rows with corrections, array<struct<type, count>>: how often each typographic rule fires.

    Each rule counts on the text that the rules before it left; of capitals that stand apart, whole runs count.
    """
    rows = rows.withColumn("__text", F.col(column)).withColumn("__n", F.array().cast("array<int>"))
    own = [c for c in rows.columns if not c.startswith("__")]
    for name, pattern, by in TYPOGRAPHY:
        first = rf"(?U){_CAPITAL}(?<=\b.)(?<!\b{_CAPITAL}\s{{1,8}}{_CAPITAL})(?=\s+{_CAPITAL}\s+{_CAPITAL}\b)"  # of a run
        fires = first if name == "spaced_capitals" else pattern
        counted = F.array_append("__n", F.regexp_count("__text", F.lit(fires)))
        rows = rows.select(*own, counted.alias("__n"), sub(F.col("__text"), pattern, by).alias("__text"))
    names = F.array(*(F.lit(name) for name, _, _ in TYPOGRAPHY))
    found = F.transform(F.arrays_zip(names.alias("type"), F.col("__n").alias("count")), lambda r: F.struct(r["type"].alias("type"), r["count"].alias("count")))
    return rows.select(*own, F.filter(found, lambda r: r["count"] > 0).alias("corrections"))


def char_differences(a: Column, b: Column) -> Column:
    """Places at which two texts differ, the longer one's rest included."""
    one, two = (F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "")) for t in (a, b))
    apart = F.size(F.filter(F.zip_with(one, two, lambda p, q: ~p.eqNullSafe(q)), lambda differs: differs))
    return F.when(a == b, F.lit(0)).otherwise(apart)
