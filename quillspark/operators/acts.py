"""Sections and acts of a gazette."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import extract
from quillspark.functions.cleaning import strip, sub

_ACT = r"(?iuU)^\s*(?:ARR[ÊE]T[ÉE]|ARRETE)\b"
#: The end of a line before one that may mean something; too many of them do no harm.
_STRETCH = r"(?iuU)\n(?=[^\S\n]*+(?:SOMM|VU|ARTICLE|CONSID|ARR|ATTENDU|D[ÉE]CID|ANNEX)|[^\n]*?SIGN)"
#: How an act begins, at a line's start.
HEADER = r"(?iumUd)^\s*ARR[ÊE]T[ÉE](?:\s+N[°º]?\s*\S+|\s+DU\s+\d|\s+PORTANT\b|\s+RELATIF\b|\s+FIXANT\b|\s*$)"


def sections(text: Column) -> Column:
    """array<struct<label, content>>: a fold over stretches of lines, with the label so far as its state.

    A stretch is a line that may mean something and the plain ones below it.
    Until a line that opens a body (summary, visa, article, recital, act) every
    line relabels the section as the cover; after a summary an act's title no
    longer opens a section; within articles nothing but a visa, recital or act does.
    """
    empty = F.array().cast("array<string>")
    start = F.struct(
        F.lit(False).alias("covered"), F.lit(False).alias("listed"), F.lit("ENTETE").alias("label"), empty.alias("held"),
        F.array().cast("array<struct<label:string,content:string>>").alias("done"),
    )

    def step(state: Column, at: Column) -> Column:
        covered = state["covered"] | at["body"]
        label = F.when(covered, state["label"]).otherwise("ENTETE_GLOBAL")
        summary = ~state["listed"] & at["summary"]
        named = (
            F.when(summary, "SOMMAIRE")
            .when(at["act"] & state["listed"], label)
            .when(at["act"], "ARRETE_TITRE")
            .when(at["visa"], "VISAS")
            .when(at["recital"], "CONSIDERANTS")
            .when(at["decided"], "DISPOSITIF")
            .when((label == "ARTICLES") | at["article"], "ARTICLES")
            .when(at["signed"], "SIGNATURE")
            .when(at["annex"], "ANNEXES")
            .otherwise(label)
        )
        opens = F.when(named == "DISPOSITIF", at["decided"]).when(named == "SIGNATURE", at["signed"]).otherwise(at["annex"])
        always = summary | (at["act"] & ~state["listed"]) | named.isin("DISPOSITIF", "SIGNATURE", "ANNEXES") & ~at["act"] & opens
        cut = (always | (named != label)) & (F.size(state["held"]) > 0)
        flushed = F.array_append(state["done"], F.struct(label.alias("label"), strip(F.array_join(state["held"], "\n")).alias("content")))
        return F.struct(
            covered.alias("covered"), (state["listed"] | summary).alias("listed"),
            F.when(covered | ~at["goes_on"], named).otherwise("ENTETE_GLOBAL").alias("label"),
            F.when(cut, F.array(at["text"])).otherwise(F.array_append(state["held"], at["text"])).alias("held"),
            F.when(cut, flushed).otherwise(state["done"]).alias("done"),
        )

    def finish(state: Column) -> Column:
        last = F.struct(state["label"].alias("label"), strip(F.array_join(state["held"], "\n")).alias("content"))
        return F.when(F.size(state["held"]) > 0, F.array_append(state["done"], last)).otherwise(state["done"])

    firsts = F.transform(F.split(text, _STRETCH, -1), lambda t: F.struct(t.alias("text"), F.substring_index(t, "\n", 1).alias("line")))
    return F.aggregate(F.transform(firsts, lambda t: _meaning(t["text"], t["line"])), start, step, finish)


def _meaning(text: Column, line: Column) -> Column:
    """struct<text, goes_on, ...>: what the first line of a stretch is."""
    signs = {
        "body": r"(?iuU)^\s*(?:SOMMAIRE|VU|ARTICLE|CONSID|ARR[ÊE]T[ÉE])", "summary": r"(?iuU)^\s*SOMMAIRE\b", "act": _ACT,
        "visa": r"(?U)^\s*(?:VU|Vu|vu)\b", "recital": r"(?iuU)^\s*(?:CONSID[ÉE]RANT|ATTENDU)", "decided": r"(?iuU)^\s*D[ÉE]CIDE\s*$",
        "article": r"(?iuU)^\s*ARTICLE\s+\d+", "signed": r"(?iuU)(?=S)\b(?:SIGN[ÉE]|SIGNE|SIGNÉE)\b", "annex": r"(?iuU)^\s*ANNEXE",
    }
    return F.struct(text.alias("text"), text.contains("\n").alias("goes_on"), *(line.rlike(sign).alias(name) for name, sign in signs.items()))


def missing_labels(found: Column) -> Column:
    """The labels that a whole act has and these sections lack."""
    wanted = F.array(*map(F.lit, ("VISAS", "DISPOSITIF", "ARTICLES", "SIGNATURE")))
    return F.array_except(wanted, F.transform(found, lambda s: s["label"]))


def with_section_marks(text: Column) -> Column:
    """The sections one after the other, each non-empty one under its mark."""
    full = F.filter(sections(text), lambda s: s["content"] != "")
    return F.array_join(F.transform(full, lambda s: F.concat(F.lit("\n=== "), s["label"], F.lit(" ===\n"), s["content"])), "\n")


def _compatible() -> dict[str, str]:
    """The characters that cleaned texts may hold whose compatibility form is another one, and that form."""
    held = map(chr, (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), 0x202F))
    return {c: form for c in held if (form := unicodedata.normalize("NFKC", c)) != c}


def normalized(text: Column) -> Column:
    """Compatibility characters, spaces and blank lines made uniform before acts are split."""
    forms = _compatible()
    one = {c: form for c, form in forms.items() if len(form) == 1}
    several = {c: form for c, form in forms.items() if len(form) > 1}
    longer = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(several[c])), several, text)
    text = F.when(text.rlike(rf"(?=[^\x00-\x7f])[{''.join(several)}]"), longer).otherwise(text)
    text = F.translate(text, "".join(one), "".join(one.values()))
    return strip(sub(sub(sub(text, r"\r\n?", "\n"), r"[ \t]{2,}|\t", " "), r"\n{3,}", "\n\n"))


def act_pieces(text: Column) -> Column:
    """Stretches that begin at an act's header each."""
    return F.slice(F.split(sub(text, rf"(?={HEADER})", "\u0001"), "\u0001", -1), 2, 1 << 30)


def header(text: Column) -> Column:
    """What comes before the summary, else before the first act."""
    listed = r"(?isuU)^(.*?)\bSOMMAIRE\b"
    act = rf"(?s)^(.*?)(?={HEADER})"
    return strip(F.when(text.rlike(listed), F.regexp_extract(text, listed, 1)).when(text.rlike(HEADER), F.regexp_extract(text, act, 1)).otherwise(""))


def summary(text: Column) -> Column:
    """From the word SOMMAIRE to the next act's header or the end."""
    tail = F.regexp_extract(text, r"(?isuU)\bSOMMAIRE\b.*\z", 0)
    return strip(F.get(F.split(sub(tail, rf"(?={HEADER})", "\u0001"), "\u0001", -1), F.lit(0)))


def split_acts(docs: DataFrame, key: str, text: str, least_length: int = 300, least_score: int = 2) -> DataFrame:
    """key, index, titre, contenu, score: the acts of each document that are long enough and look like acts."""
    pieces = docs.select(F.col(key).alias("source"), F.posexplode_outer(act_pieces(normalized(F.col(text)))).alias("at", "piece"))
    acts = pieces.select("source", "at", strip(F.col("piece")).alias("contenu"))
    # The window below keeps the stripped text as a column; score and length are taken from it once.
    scored = acts.withColumn("score", extract.score(F.col("contenu"))).where((F.length("contenu") >= least_length) & (F.col("score") >= least_score))
    order = Window.partitionBy("source").orderBy("at")
    return scored.select("source", F.row_number().over(order).alias("index"), extract.title(F.col("contenu")).alias("titre"), "contenu", "score")


def act_file(head: Column, listed: Column, act: Column) -> Column:
    """An act's file: header, summary and act, parted by blank lines."""
    return F.concat_ws("\n\n", head, listed, act)
