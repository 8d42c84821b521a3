"""Fixed values of the document rules: word lists, character maps and patterns of the domain."""

from __future__ import annotations

# ---- Fixed values: they define the expected results. ----

#: Look-alike characters and what they stand for.
LOOKALIKES = {
    "\u2000": " ", "\u2001": " ", "\u2002": " ", "\u2003": " ", "\u2004": " ", "\u2005": " ", "\u2006": " ",
    "\u2007": " ", "\u2008": " ", "\u2009": "\u202f", "\u200a": "\u202f", "\u205f": " ", "\u3000": " ",
    "\u200b": "", "\u200c": "", "\u200d": "", "\ufeff": "",
    "\u2010": "-", "\u2011": "-", "\u2012": "\u2013", "\u2015": "\u2014", "\ufe58": "\u2014", "\ufe63": "-", "\uff0d": "-",
    "\u2018": "\u2019", "\u201b": "\u2019", "\uff07": "\u2019", "\u02bc": "\u2019", "\u02bb": "\u2019",
    "\u201c": "\u00ab", "\u201d": "\u00bb", "\u201e": "\u00ab", "\uff02": "\u00bb",
    "\u0430": "a", "\u0435": "e", "\u043e": "o", "\u0440": "p", "\u0441": "c", "\u0443": "y", "\u0445": "x", "\u0456": "i",
    "\u0410": "A", "\u0412": "B", "\u0415": "E", "\u041a": "K", "\u041c": "M", "\u041d": "H", "\u041e": "O", "\u0420": "P",
    "\u0421": "C", "\u0422": "T", "\u0425": "X",
    **{chr(0xFF10 + d): str(d) for d in range(10)},
    "\u2026": "...", "\u00ad": "",
}

#: Legal words in which OCR reads m as rn.
WORDS_WITH_M = (
    "ministre", "maire", "commissaire", "modification", "département", "départements", "commune", "communes",
    "intercommunal", "administration", "administratif", "administrative", "préambule",
)
#: Words in which rn is right.
WORDS_WITH_RN = (
    "journal", "journaux", "ourne", "tourner", "retourner", "fournir", "fourniture", "gouvernement", "gouverneur",
    "borne", "bornes", "cornet", "corner", "corne", "interne", "inernes", "externe", "externes", "alterne", "discerne",
    "concerne", "orne", "ornement", "urne", "urnes", "herne", "verne", "berne", "terne", "moderne", "modernes",
    "caserne", "caverne", "citerne", "lanterne",
)

#: Ordinal words of article headings.
ORDINALS = {
    "premier": 1, "première": 1, "premiere": 1, "un": 1, "une": 1,
    "deux": 2, "deuxième": 2, "deuxieme": 2, "second": 2, "seconde": 2,
    "trois": 3, "troisième": 3, "troisieme": 3, "quatre": 4, "quatrième": 4, "quatrieme": 4,
    "cinq": 5, "cinquième": 5, "cinquieme": 5, "six": 6, "sixième": 6, "sixieme": 6,
    "sept": 7, "septième": 7, "septieme": 7, "huit": 8, "huitième": 8, "huitieme": 8,
    "neuf": 9, "neuvième": 9, "neuvieme": 9, "dix": 10, "dixième": 10, "dixieme": 10,
    "onze": 11, "douze": 12, "treize": 13, "quatorze": 14, "quinze": 15, "seize": 16,
}

#: Titles written in capitals and their form in running text, longer ones first.
TITLES = (
    (r"SOUS-PR[ÉE]F[ÈE]TE", "sous-préfète"), (r"SOUS-PR[ÉE]FET", "sous-préfet"),
    (r"PR[ÉE]F[ÈE]TE", "préfète"), (r"PR[ÉE]FET", "préfet"),
    (r"SECR[ÉE]TAIRE\s+G[ÉE]N[ÉE]RALE?", "secrétaire général"), (r"DIRECTEUR\s+G[ÉE]N[ÉE]RALE?", "directeur général"),
    (r"DIRECTRICE\s+G[ÉE]N[ÉE]RALE", "directrice générale"), (r"DIRECTEUR", "directeur"), (r"DIRECTRICE", "directrice"),
    (r"MAIRE", "maire"), (r"MINISTRE", "ministre"), (r"PR[ÉE]SIDENTE?", "président"), (r"COMMISSAIRE", "commissaire"),
    (r"INSPECTEUR", "inspecteur"), (r"INSPECTRICE", "inspectrice"),
)

#: Capital words that stay as they are.
ACRONYMS = (
    "CGCT", "DGCL", "DILA", "DREAL", "DREETS", "DDT", "DDTM", "DDPP", "DDCS", "DDETS", "ARS", "DIRECCTE", "DRIEETS",
    "INSEE", "SIRENE", "SIRET", "SIREN", "DDFIPSAS", "SARL", "SA", "SCI", "SNC", "EURL", "EI", "ICPE", "PLU", "POS",
    "SCOT", "ZAC", "ZAD", "PDF", "RAA", "RCS", "TVA", "HT", "TTC", "CE", "TA", "CAA", "EU", "UE",
)
ACT_WORDS = ("ARRÊTE", "ARRETE", "DÉCIDE", "DECIDE", "ORDONNE", "TITRE", "CHAPITRE", "SECTION", "ANNEXE")

#: Months in order, without diacritics.
MONTHS = (
    "janvier", "fevrier", "mars", "avril", "mai", "juin", "juillet", "aout", "septembre", "octobre", "novembre", "decembre",
)
MONTH_NAMES = (
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
)

#: First match of each of these, group 1, is the field's value.
FIELDS = {
    "fonction_auteur": r"(?iUdu)sign[ée]\s*:\s*(.+?)(?=\s*:)",
    "date_acte": r"(?Ud)(?:du|en date du|signé le)\s+(\d{1,2}\s+\w+\s+\d{4}|\d{1,2}[/\-]\d{1,2}[/\-]\d{4})",
    "base_legale": r"(?Uds)[Vv]u\s+(.+?)(?=\n\s*\n|\n[A-Z]|\z)",
    "objet_large": r"(?Ud)[Aa]rr[eê]t[eé]\s+n[°o]?\s*[\w\-]+\s+du\s+[^\n]+?portant\s+(.*)",
    "prefecture": r"(?Ud)((?:SOUS[- ]?)?PREFECTURE\s+D(?:E|U|['’])\s+[A-Z\- ]+?)(?=\.{3}|\n|\z)",
    "numero_acte": r"(?Ud)\b(?:n°\s*)?(\d{4}[/\-]\d{2,4}(?:[/\-]\d{2,4})?|\d{2}[/\-]\d{4}[/\-]\d{3})\b",
}

#: Patterns that each give an act one point.
SCORE_MARKS = (
    r"(?iumUd)Article\s+1", r"(?iumUd)^\s*Vu\b", r"(?iumUd)Considérant", r"(?iumUd)Préfet", r"(?iumUd)Maire",
    r"(?iumUd)^\s*ARR[ÊE]T[ÉE]\s*$", r"(?iumUd)Fait\s+[àa]\b",
)

#: Compliments before a name, and the shapes of given names and surnames.
CIVILITY = r"(Monsieur|Madame|M\.|Mme)"
UPPER, LOWER = "A-ZÉÈÀÙÂÊÎÔÛÄËÏÖÜÇ", "a-zéèàùâêîôûäëïöüç'’-"
GIVEN = rf"[{UPPER}][{LOWER}]+(?:-[{UPPER}][{LOWER}]+)*"
SURNAME = rf"[{UPPER}]{{2,}}(?:[-'][{UPPER}]{{2,}})*"

DEFAULT_OBJECT = "objet non renseigné"
DEFAULT_CELL = "Non renseigné"
