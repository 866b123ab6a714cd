"""Text, identifier and category cleaning as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .steps import Step, Steps

# Every character that counts as white space at the ends of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Words that mean "missing" in client data (compared in lower case).
MISSING_WORDS = (
    "", "nan", "none", "null", "n/a", "na",
    "non renseigne", "non renseigné", "non renseignee", "non renseignée",
    "-", "--", "?", "inconnu", "inconnue",
)

# Spellings of the two genders.
MALE_WORDS = ("MASCULIN", "HOMME", "MALE", "M")
FEMALE_WORDS = ("FEMININ", "FÉMININ", "FEMME", "FEMALE", "F")

# Claim status keys (lower case, accents off, blanks as underscores) and their labels.
CLAIM_STATUS = {
    "refuse": "Refusé",
    "refusee": "Refusé",
    "rejet": "Refusé",
    "rejetee": "Refusé",
    "clos": "Clos",
    "cloture": "Clos",
    "cloture_": "Clos",
    "clos_avec_indemnisation": "Clos_avec_indemnisation",
    "clos_avec_indemnisation_": "Clos_avec_indemnisation",
    "clos_avec_indemnisation.": "Clos_avec_indemnisation",
    "clos_avec_indemnisation__": "Clos_avec_indemnisation",
    "clos_sans_indemnisation": "Clos_sans_indemnisation",
    "clos_sans_indemnisation_": "Clos_sans_indemnisation",
    "ouvert": "Ouvert",
    "en_cours": "En_cours",
    "en_cours_dexpertise": "En_cours_d_expertise",
    "en_cours_expertise": "En_cours_d_expertise",
    "en_cours_d_expertise": "En_cours_d_expertise",
}
ACTIVE_STATUSES = ("Ouvert", "En_cours", "En_cours_d_expertise")


NULL_WORDS = ("nan", "None", "")


def strip(c: Column) -> Column:
    """Drop white space at both ends, tabs and no-break spaces included.

    Most values start and end with a visible ASCII character and pass untouched, which
    costs a fraction of the trim against the whole set.
    """
    visible = F.substring(c, 1, 1).between("!", "~") & F.substring(c, -1, 1).between("!", "~")
    return F.when(visible, c).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def stripped(dtype: str = "string") -> Step:
    """Text of a column without outer blanks; whole numbers in a floating column lose their ``.0``."""
    def run(c: Column) -> Column:
        if dtype in ("double", "float"):
            whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
            return F.when(whole, c.cast("bigint").cast("string")).when(~F.isnan(c), c.cast("string"))
        return strip(c) if dtype == "string" else c.cast("string")

    return run


def without(*words: str) -> Step:
    """Null for the listed words."""
    return lambda c: F.when(~c.isin(*words), c)


def without_missing(c: Column) -> Column:
    """Null for every missing word, in any case."""
    return F.when(~F.lower(c).isin(*MISSING_WORDS), c)


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` only starts a word after a blank, so a marked blank is put between a
    non-letter and the letter behind it, and taken out again afterwards.
    """
    mark = "\u0001 "
    spaced = F.regexp_replace(F.lower(c), r"([^\p{L} ])(?=\p{L})", "$1" + mark)
    return F.replace(F.initcap(spaced), F.lit(mark), F.lit(""))


CASES: dict[str, Steps] = {"title": (title_case,), "upper": (F.upper,), "lower": (F.lower,), "none": ()}


def normalized_id(dtype: str = "string") -> Steps:
    """Trimmed upper-case identifier; ``nan``, ``none`` and blank become null."""
    return (lambda c: F.upper(stripped(dtype)(c)), without("NAN", "NONE", ""))


def missing_to_null(dtype: str = "string") -> Steps:
    """Trimmed text with every missing word turned into null."""
    return (stripped(dtype), without_missing)


def clean_text(dtype: str = "string", mode: str = "title") -> Steps:
    """Trim, drop the empty and null words, then apply a case: title, upper, lower or none."""
    return (stripped(dtype), without(*NULL_WORDS), *CASES[mode])


def name_text(dtype: str = "string") -> Steps:
    """Title-cased text without missing words."""
    return (*missing_to_null(dtype), title_case)


def collapsed_text(dtype: str = "string") -> Steps:
    """One blank for each run of white space, none at the ends; null words become null."""
    return (lambda c: F.regexp_replace(c.cast("string"), r"\s+", " "), strip, without(*NULL_WORDS))


def plate(dtype: str = "string") -> Steps:
    """Registration plate: upper case without blanks."""
    return (*clean_text(dtype, "upper"), lambda c: F.replace(c, F.lit(" "), F.lit("")))


def gender(dtype: str = "string") -> Steps:
    """M, F or null; the missing words are in neither list."""
    return (
        lambda c: F.upper(stripped(dtype)(c)),
        lambda c: F.when(c.isin(*MALE_WORDS), "M").when(c.isin(*FEMALE_WORDS), "F"),
    )


def driving_behavior(dtype: str = "string") -> Steps:
    """Prudent, Normal, Aggressif or null; the missing words are in neither list."""
    return (
        lambda c: title_case(stripped(dtype)(c)),
        lambda c: F.when(c.isin("Aggressive", "Agressif", "Aggressif"), "Aggressif").when(c.isin("Prudent", "Normal"), c),
    )


def _status_label(c: Column) -> Column:
    key = F.regexp_replace(F.lower(c), r"\s+", "_")
    for accented, plain in zip("éèêàç", "eeeac"):  # searches bytes, where translate takes every character by itself
        key = F.replace(key, F.lit(accented), F.lit(plain))
    labels = F.create_map(*[F.lit(x) for pair in CLAIM_STATUS.items() for x in pair])
    return F.coalesce(labels[key], title_case(c))


def claim_status(dtype: str = "string") -> Steps:
    """Canonical status label, or the title-cased original where the key is unknown."""
    return (stripped(dtype), without(*NULL_WORDS), _status_label)
