"""Scalar text expressions.  Each takes and returns columns and stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of the folds, and the marks that reading noise leaves at a token's edges.
DIGITS, LETTERS = "01345689", "oleasgbg"
EDGE_NOISE = " .:;|_-[](){}<>*=+~^`\"'"
IMAGE_TYPES = r"\.(jpe?g|png|bmp|tiff?|webp)$"
#: Space as Unicode knows it.
SPACE = r"(?U)\s+"


def _trim(column: Column, chars: str) -> Column:
    return F.btrim(column, F.lit(chars))


def squeeze(column: Column) -> Column:
    """Runs of white space to one blank, none at the ends."""
    return F.trim(F.regexp_replace(column, SPACE, " "))


def name_key(name: Column) -> Column:
    """The form in which names are compared: words of a-z, 0-9, colons and hyphens."""
    s = F.lower(squeeze(F.coalesce(name, F.lit(""))))
    s = F.regexp_replace(F.replace(s, F.lit("&"), F.lit(" and ")), "[_/]+", " ")
    s = F.regexp_replace(s, r"[^a-z0-9&\s:-]+", " ")
    return _trim(F.regexp_replace(s, r"\s+", " "), " -:")


def term_key(name: Column) -> Column:
    """The taxonomy's own key: like ``name_key``, but marks stay and colons stand apart."""
    s = F.lower(squeeze(name))
    s = F.regexp_replace(F.replace(s, F.lit("&"), F.lit(" and ")), "[_/]+", " ")
    s = F.regexp_replace(s, r"(?U)\s*:\s*", " : ")
    return squeeze(s)


def singular(token: Column) -> Column:
    """A plain plural fold."""
    n = F.length(token)
    cut = lambda k: F.substring(token, F.lit(1), n - k)
    return (
        F.when((n > 3) & token.endswith("ies"), F.concat(cut(3), F.lit("y")))
        .when((n > 4) & token.rlike("[shxz]es$"), cut(2))
        .when((n > 3) & token.endswith("s") & ~token.endswith("ss"), cut(1))
        .otherwise(token)
    )


def stem_tokens(key: Column) -> Column:
    """Singular tokens of a ``name_key``; none of an empty one."""
    return F.transform(F.filter(F.split(key, " "), lambda t: t != ""), singular)


def stem_key(key: Column) -> Column:
    return F.array_join(stem_tokens(key), " ")


def digit_fold(key: Column) -> Column:
    """Digits that reading takes for letters, as those letters."""
    return F.translate(key, DIGITS, LETTERS)


def clean_token(text: Column) -> Column:
    return F.trim(_trim(squeeze(text), EDGE_NOISE))


def letters(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\p{L}"))


def is_word(text: Column, least: int = 2) -> Column:
    return letters(text) >= least


def keep_token(text: Column, confidence: Column, least_confidence: float = 0.30, least_letters: int = 2) -> Column:
    """Whether a read token counts: not blank, confident and a word; null counts as not."""
    return F.coalesce((F.length(text) > 0) & (confidence >= least_confidence) & is_word(text, least_letters), F.lit(False))


def keep_raw_word(text: Column, confidence: Column) -> Column:
    """Whether a raw word counts before words are grouped: confidence known, a letter in it."""
    return F.coalesce((F.length(squeeze(text)) > 0) & (confidence >= 0) & (letters(text) > 0), F.lit(False))


def compare_key(text: Column) -> Column:
    return F.lower(squeeze(text))


def is_truncation(partial: Column, full: Column) -> Column:
    """Whether ``partial`` is the end of ``full`` and has fewer letters."""
    a, b = compare_key(partial), compare_key(full)
    return (F.length(a) > 0) & (F.length(b) > 0) & (a != b) & (letters(b) > letters(a)) & F.endswith(b, a)


def safe_name(name: Column) -> Column:
    """A file name: letters, digits and ``-_.()``; ``unnamed`` if nothing is left."""
    s = F.trim(F.regexp_replace(name, r"[^\p{L}\p{N}\-_.() ]", "_"))
    return F.coalesce(F.nullif(F.replace(s, F.lit(" "), F.lit("_")), F.lit("")), F.lit("unnamed"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem_of(name: Column) -> Column:
    """Without the last extension; a leading dot begins a name, not an extension."""
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def path_key(path: Column) -> Column:
    """Letters and digits of a file's stem, lower-cased."""
    return F.regexp_replace(F.lower(stem_of(base_name(path))), r"[^\p{L}\p{N}]", "")


def source_name(crop: Column) -> Column:
    """The image that a crop was cut from, by the crop's file name."""
    stem = stem_of(crop)
    name = F.regexp_replace(F.regexp_replace(stem, r"\s*\(\d+\)$", ""), r"_\d+$", "")
    return F.coalesce(F.nullif(name, F.lit("")), stem)


EXPORT = r"_([A-Za-z0-9]+)\.rf\.[A-Za-z0-9]+\.([A-Za-z0-9]+)$"


def clean_export_name(name: Column) -> Column:
    """``a b_jpg.rf.HASH.png`` -> ``a_b.png``; other names only lose blanks before the extension."""
    export = F.concat(F.replace(F.regexp_replace(name, EXPORT, ""), F.lit(" "), F.lit("_")), F.lit("."), F.regexp_extract(name, EXPORT, 2))
    stem, end = F.regexp_replace(name, r"\.[^.]*$", ""), F.regexp_extract(name, r"\.([^.]*)$", 1)
    plain = F.concat(F.replace(stem, F.lit(" "), F.lit("_")), F.when(end != "", F.concat(F.lit("."), end)).otherwise(""))
    return F.when(name.rlike(EXPORT), export).otherwise(plain)


def initial_bucket(name: Column) -> Column:
    """A-H, I-P, Q-Z by the first letter anywhere in the name, else Other."""
    c = F.lower(F.regexp_extract(name, r"\p{L}", 0))
    between = lambda a, b: (c >= a) & (c <= b)
    return F.when(between("a", "h"), "A-H").when(between("i", "p"), "I-P").when(between("q", "z"), "Q-Z").otherwise("Other")


def tree_key(path: Column, by: str = "path", ignore_type: bool = False) -> Column:
    """Key under which files of two trees are the same: ``by`` their path or their name."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    p = base_name(p) if by == "name" else p
    return F.lower(F.regexp_replace(p, r"(?<=[^./])\.[^./]*$", "") if ignore_type else p)


def pick_label(policy: str, legend: Column, known: Column, canonical: Column | None = None) -> Column:
    """The wording that wins where two sources agree: ``legend``, ``db`` or ``canonical``."""
    real = lambda c: F.nullif(F.trim(c), F.lit(""))
    order = {"legend": [legend, known], "db": [known, legend], "canonical": [known, legend]}[policy]
    first = [canonical] if policy == "canonical" and canonical is not None else []
    return F.coalesce(*first, *[real(c) for c in order])


def method_colour(method: Column, renamed: Column) -> Column:
    """Colour of a drawn box by how its class was found."""
    return (
        F.when(~F.coalesce(renamed, F.lit(False)) | method.isNull(), "orange")
        .when(method == "phash_db", "blue")
        .when(method.isin("phash_db+same", "phash_db+related", "synonym_agree"), "magenta")
        .otherwise("green")
    )
