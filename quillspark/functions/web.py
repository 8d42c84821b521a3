"""URLs and labels of an archive's pages as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions import rules
from quillspark.functions.cleaning import strip
from quillspark.functions.extract import month_number, without_diacritics

_MONTH = "Janvier|Fevrier|Février|Mars|Avril|Mai|Juin|Juillet|Aout|Août|Septembre|Octobre|Novembre|Decembre|Décembre"
_YEAR = r"(?:19|20)\d{2}"
_FORM = rf"(?:Annee-|Les-recueils-des-actes-administratifs-annee-|Raa-[^/]+?-)"
#: A path segment that names a year.
_SEGMENT = rf"(?:Annee-{_YEAR}|Les-recueils-des-actes-administratifs-annee-{_YEAR}|Raa-[^/]+?-{_YEAR})"
#: Word boundaries of ASCII letters, digits and underscores.
_LEFT, _RIGHT = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"


def decoded(url: Column) -> Column:
    """Percent escapes decoded, a plus left as it is; the text itself where they are broken."""
    return F.coalesce(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), url)


def strip_suffix(url: Column) -> Column:
    """Without query and fragment."""
    return F.regexp_replace(url, r"[?#].*$", "")


def path_of(url: Column) -> Column:
    return decoded(F.regexp_extract(strip_suffix(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(/.*)$", 1))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def origin_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1))


def absolute(href: Column, base: Column) -> Column:
    """A link resolved against its page's URL, dot segments included; null for an empty one."""
    origin, scheme = origin_of(base), F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    folder = F.concat(origin, F.regexp_extract(strip_suffix(base), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*(/(?:.*/)?)?", 1))
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    joined = (
        F.when(href.startswith("/"), F.concat(origin, href)).when(href.rlike("^[?#]"), F.concat(strip_suffix(base), href)).otherwise(F.concat(folder, href))
    )
    return (
        F.when(href.isNull() | (F.trim(href) == ""), F.lit(None).cast("string"))
        .when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .otherwise(without_dots(joined))
    )


def without_dots(url: Column) -> Column:
    """The URL with ``.`` and ``..`` segments of its path worked out."""
    path = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)?", 1)
    segments = F.slice(F.split(path, "/", -1), 2, 1 << 30)
    up = lambda kept: F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", up(kept)).when(s == ".", kept).otherwise(F.array_append(kept, s)),
    )
    tail = F.when(path.rlike(r"/\.{1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    made = F.concat(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1), F.lit("/"), F.array_join(kept, "/"), tail, F.regexp_extract(url, r"([?#].*)$", 1))
    return F.when(path.rlike(r"/\.{1,2}(?:/|$)"), made).otherwise(url)


def is_pdf(url: Column) -> Column:
    return url.rlike(r"(?i)\.pdf(?:$|[?#])") | url.rlike(r"(?i)/(?:i?re)?contenu/telechargement/")


def is_year_link(url: Column, label: Column, base: Column) -> Column:
    by_path = path_of(url).rlike(rf"(?i)/(?:Annee-{_YEAR}|Les-recueils-des-actes-administratifs-annee-{_YEAR}|Raa-[^/]+?-{_YEAR})/?$")
    return (strip_suffix(url) != strip_suffix(base)) & (by_path | label.rlike(rf"(?iu)ann[ée]e\s+{_YEAR}"))


def is_month_link(url: Column, label: Column) -> Column:
    return ~is_pdf(strip_suffix(url)) & (
        path_of(url).rlike(rf"(?iu)(?:{_MONTH})(?:-\d{{4}})?/?$") | label.rlike(rf"(?iu){_LEFT}(?:{_MONTH}){_RIGHT}")
    )


def page_kind(url: Column) -> Column:
    """month, year or root, by the URL alone: what goes on behind a year's segment is a month, whatever it is."""
    path = path_of(url)
    segment = rf"(?:Annee-{_YEAR}|Raa-[^/]+?-{_YEAR})"
    return (
        F.when(path.rlike(rf"(?i)/{segment}/(?!\z)"), "month")
        .when(path.rlike(rf"(?i)/{_SEGMENT}/?\z"), "year")
        .when(path.rlike(rf"(?iu)/(?:{_MONTH})(?:-{_YEAR})?/?\z"), "month")
        .when(path.rlike(rf"(?i)(?:^|/)Annee-{_YEAR}(?:/|\z)|Raa-[^/]+?-{_YEAR}"), "year")
        .otherwise("root")
    )


def link_kind(url: Column) -> Column:
    """pdf for links to documents, else the kind of the page."""
    return F.when(is_pdf(url), "pdf").otherwise(page_kind(url))


def looks_official(url: Column) -> Column:
    """Whether a path hints at a gazette's pages."""
    return F.lower(path_of(url)).rlike(
        rf"recueil-des-actes-administratifs|{_LEFT}raa{_RIGHT}|documents-publications|documents\+et\+publications"
    )


def start_url(url: Column, default: str) -> Column:
    """The page itself where its path hints at a gazette, without one last slash, else a default."""
    return F.when(looks_official(url), without_slash(url)).otherwise(F.lit(default))


def without_slash(url: Column) -> Column:
    return F.regexp_replace(F.trim(url), "/$", "")


def first_year(text: Column) -> Column:
    """The first year of a text, else 0."""
    return F.coalesce(F.regexp_extract(text, r"(19\d{2}|20\d{2})", 1).try_cast("int"), F.lit(0))


def year_in_path(url: Column) -> Column:
    """The last year from 2000 on in a path, else null."""
    return _last(path_of(url), r"(20\d{2})(?!\d)", 1)


def year_label(url: Column, year: Column) -> Column:
    """``Année`` and the year, with the department where a path names it."""
    pattern = r"(?i)Raa-du-departement-de-([^/]+?)-\d{4}"
    plain = F.concat(F.lit("Année "), year.cast("string"))
    named = F.concat(plain, F.lit(" · "), F.replace(F.regexp_extract(decoded(url), pattern, 1), F.lit("-"), F.lit(" ")))
    return F.when(decoded(url).rlike(pattern), named).otherwise(plain)


def year_context(url: Column) -> Column:
    """The path segment that names a year, in lower case; empty without one."""
    return F.lower(F.regexp_extract(path_of(url), rf"(?i)/({_SEGMENT})(?:/|\z)", 1))


def in_branch(url: Column, label: Column, base: Column, year: Column) -> Column:
    """Whether a link belongs to a year's page: below its path, else in its year's segment, else of its year."""
    under = F.startswith(F.concat(_bare(url), F.lit("/")), F.concat(_bare(base), F.lit("/")))
    context = year_context(base)
    return under | F.when(context != "", year_context(url) == context).otherwise((year == 0) | (year_of(strip_suffix(url), label) == year))


def _bare(url: Column) -> Column:
    return F.regexp_replace(path_of(url), "/+$", "")


def _last(text: Column, pattern: str, group: int) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(-1)).cast("int")


def year_of(url: Column, label: Column) -> Column:
    """The last year of a path segment, else of the label, else of either, else 0."""
    return F.coalesce(
        _last(path_of(url), rf"(?i)(?:^|/){_FORM}({_YEAR})(?=/|$)", 1),
        _last(label, rf"({_YEAR})", 1),
        _last(F.concat_ws(" ", decoded(url), label), rf"(?:^|[^\d])({_YEAR})(?!\d)", 1),
        F.lit(0),
    )


def month_of(url: Column, label: Column) -> Column:
    return month_number(F.concat_ws(" ", decoded(url), label))


def month_label(month: Column, year: Column, fallback: Column | None = None) -> Column:
    """``Mois YYYY``; without month or year the fallback, or the month's number."""
    name = F.get(F.array(*map(F.lit, rules.MONTH_NAMES)), month - 1)
    number = F.concat(F.lit("Mois "), month.cast("string"))
    said = number if fallback is None else F.coalesce(F.nullif(spaced(fallback), F.lit("")), number)
    return F.when((month > 0) & (year > 0), F.concat_ws(" ", name, year.cast("string"))).otherwise(said)


def month_key(month: Column, year: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def selection_key(url: Column, year: Column, month_key: Column) -> Column:
    """A month's URL without query, else its year and key."""
    return F.coalesce(F.nullif(strip_suffix(url), F.lit("")), F.concat_ws("-", year.cast("string"), month_key))


def spaced(text: Column) -> Column:
    """White space runs as single spaces, none at the ends."""
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def safe_name(name: Column, longest: int) -> Column:
    """Characters that file systems refuse as underscores, single spaces, so many characters at most."""
    safe = F.regexp_replace(strip(name), r'[\\/:*?"<>|]', "_")
    return F.substring(F.regexp_replace(safe, r"(?U)\s+", " "), 1, longest)


def folder_name(name: Column) -> Column:
    return safe_name(F.coalesce(F.nullif(name, F.lit("")), F.lit("document")), 120)


def file_name(url: Column, fallback: Column | None = None) -> Column:
    """The last path segment as a file name that ends in .pdf."""
    fallback = F.lit("document.pdf") if fallback is None else fallback
    last = F.try_element_at(F.filter(F.split(path_of(url), "/"), lambda p: p != ""), F.lit(-1))
    safe = safe_name(F.coalesce(last, fallback), 1 << 30)
    return F.substring(F.when(safe.rlike(r"(?i)\.pdf$"), safe).otherwise(F.concat(safe, F.lit(".pdf"))), 1, 180)


def document_date(text: Column) -> Column:
    """The first dd/mm/yyyy of the text around a link, else null."""
    return F.nullif(F.regexp_extract(text, rf"{_LEFT}(\d{{2}}/\d{{2}}/\d{{4}}){_RIGHT}", 1), F.lit(""))


def document_size(text: Column) -> Column:
    """The first size in Ko, Mo or Go of the text around a link, else null."""
    pattern = rf"(?i){_LEFT}(\d+[.,]?\d*)\s*(Ko|Mo|Go){_RIGHT}"
    return F.when(text.rlike(pattern), F.concat_ws(" ", F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)))


def compact(*parts: Column) -> Column:
    """The parts that are not empty, with bullets between."""
    return F.concat_ws(" • ", *(F.nullif(p, F.lit("")) for p in parts))


def site_folder(url: Column) -> Column:
    known = ("Loir-et-Cher", "Ile-de-France", "Haute-Garonne", "Val-de-Marne")
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    stem = F.replace(F.regexp_replace(host, r"\.[^.]*$", ""), F.lit("."), F.lit("-"))
    return F.coalesce(*(F.when(F.lower(url).contains(k.lower()), F.lit(k)) for k in known), stem)


def download_path(url: Column, year: Column, month: Column) -> Column:
    plain = without_diacritics(F.get(F.array(*map(F.lit, rules.MONTH_NAMES)), month - 1))
    folder = F.concat_ws("-", F.lpad(month.cast("string"), 2, "0"), plain)
    return F.concat_ws("/", F.lit("RAA"), site_folder(url), year.cast("string"), folder, file_name(url))


def escaped(text: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def escaped_attribute(text: Column) -> Column:
    return F.replace(escaped(text), F.lit("`"), F.lit("&#96;"))
