"""Text, list and code expressions. Lists are comma strings at the edge, as in the exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
LIST_SEPARATOR = ", "
SENTINEL = 999.0
SPELLING = {
    "Cladribin": "Cladribine",
    "Fludarabin": "Fludurabine",
    "Fludarabine": "Fludurabine",
    "Ifosfamid": "Ifosfamide",
    "Ibrutinib/Placebo": "Ibrutinib / Placebo",
    "Interferon alpha": "Interferone-alpha",
    "Interferon-alpha": "Interferone-alpha",
    "Interferon": "Interferone",
    "Interleukin 2": "Interleukin-2",
    "Mitoxantron": "Mitoxantrone",
    "Oxiplatin": "Oxaliplatin",
    "Pixantron": "Pixantrone",
    "Procarbazin": "Procarbazine",
    "Thiothepa": "Thiotepa",
    "Vincristin": "Vincristine",
    "R-BENDAMUSTIN": "R-BENDAMUSTINE",
    "OBI-BENDAMUSTIN": "OBI-BENDAMUSTINE",
    "R-LENALIDOMID": "R-LENALIDOMIDE",
    "lenalidomid": "Lenalidomide",
    "Lenalidomid": "Lenalidomide",
    "Methotrexat": "Methotrexate",
    "Pixatrone": "Pixantrone",
}
OTHER_TOKENS = ["other, ", "Other, ", ", other", ", Other "]
REGIMEN_SYNONYMS = {
    "non-pegylated liposomalem": "non-pegylated liposomal",
    "pola-r-cmp": "pola-r-chp",
    "obi-bendamustin": "obinutuzumab, bendamustine",
    "revlimid": "lenalidomide",
}
BRAND_PATTERN = "myocet|Myocet"
BRAND_GENERIC = "Non-pegylated liposomalem Doxorubicin"
SITE_NAMES = {
    "Cns": "Central nervous system",
    "Marrow": "Bone marrow",
    "Git": "GIT",
    "Paranasal": "Paranasal-sinus",
    "Colon": "Colon/large intestines",
    "Intestine": "Small intestine",
    "Soft": "Soft tissue",
}
# ----------------------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_numeric(x: Column | str) -> Column:
    """Decimal comma to double; text that is no number gives null."""
    return F.regexp_replace(_col(x).cast("string"), ",", ".").try_cast("double")


def drop_sentinel(x: Column | str, value: float = SENTINEL) -> Column:
    return F.nullif(_col(x), F.lit(value))


def clean_markers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text lab markers to double with the missing code removed, in one projection."""
    return df.withColumns({c: drop_sentinel(to_numeric(c)) for c in columns})


def split_list(x: Column | str) -> Column:
    """List items; a trailing separator adds no empty item."""
    return F.split(F.regexp_replace(_col(x), r",\s*$", ""), r",\s*")


def capitalize_words(x: Column | str) -> Column:
    """First letter of each list item in upper case, the rest as it is."""
    return F.array_join(
        F.transform(split_list(x), lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))),
        LIST_SEPARATOR,
    )


def sort_unique_values(x: Column | str) -> Column:
    """Distinct trimmed list items in binary order."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(split_list(x), lambda w: F.trim(w)))), LIST_SEPARATOR)


def unite(columns: Sequence[str | Column], sep: str = LIST_SEPARATOR) -> Column:
    """Non-null values joined; all null gives the empty string."""
    return F.concat_ws(sep, *[_col(c) for c in columns])


def _literal(word: str) -> str:
    return "".join("\\" + ch if ch in r"\.[]{}()*+?^$|/-" else ch for ch in word)


def fix_spelling(x: Column | str, corrections: Mapping[str, str] = SPELLING) -> Column:
    """Whole-word replacements, applied in the given order."""
    out = _col(x)
    for wrong, right in corrections.items():
        out = F.regexp_replace(out, rf"\b{_literal(wrong)}\b", right)
    return out


def drop_parenthesis(x: Column | str) -> Column:
    """Everything from the first ``(`` on removed, with the blanks before it."""
    return F.regexp_replace(_col(x), r"(?s)\s*\(.*$", "")


def drop_other(x: Column | str) -> Column:
    """The bare "other" entries taken out of a list."""
    out = _col(x)
    for token in OTHER_TOKENS:
        out = F.replace(out, F.lit(token), F.lit(""))
    return out


def replace_first(x: Column | str, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(_col(x), f"^(?s)(.*?)(?:{pattern})", f"$1{replacement}")


def empty_to_null(x: Column | str) -> Column:
    return F.nullif(_col(x), F.lit(""))


def squish(x: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(x), r"\s+", " "))


def normalise_regimen(x: Column | str) -> Column:
    """Synonyms to their standard name, ignoring case, then blanks squeezed."""
    out = _col(x)
    for wrong, right in REGIMEN_SYNONYMS.items():
        out = F.regexp_replace(out, f"(?i){_literal(wrong)}", right)
    return squish(out)


def checkbox_text(x: Column | str, label: str) -> Column:
    return F.when(_col(x) == 1, F.lit(label))


def two_site_label(cns: Column | str, periphery: Column | str) -> Column:
    cns, periphery = _col(cns) == 1, _col(periphery) == 1
    return F.when(cns & periphery, "CNS, Periphery").when(cns, "CNS").when(periphery, "Periphery")


def grade_label(x: Column | str) -> Column:
    """``Grade n`` for 0 to 4, else null."""
    t = _col(x).cast("string")
    return F.when(t.rlike("^[0-4]$"), F.concat(F.lit("Grade "), t))


def onehot_label(column: str, names: Mapping[str, str] = SITE_NAMES) -> Column:
    """``prefix___name`` = 1 becomes the title-cased name (or its long form)."""
    title = column.split("___")[1].title()
    return F.when(F.col(column) == 1, F.lit(names.get(title, title)))


def other_with_text(x: Column | str, free_text: Column | str) -> Column:
    """``Other - text``; plain ``Other`` when no text was given."""
    x, free_text = _col(x), _col(free_text)
    return F.when((x == "Other") & free_text.isNotNull(), F.concat_ws(" - ", x, free_text)).otherwise(x)


def prefixed(x: Column | str, prefix: str) -> Column:
    x = _col(x)
    return F.when(x.isNotNull(), F.concat(F.lit(prefix), x))


def recode(x: Column | str, mapping: Mapping[str, str | None], keep_rest: bool = False) -> Column:
    """A chain of equality tests; unlisted values become null unless kept."""
    x = _col(x)
    out = None
    for code, label in mapping.items():
        test = x == F.lit(code)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(x) if keep_rest else out


def factor(x: Column | str, levels: Sequence, labels: Sequence[str] | None = None) -> Column:
    """Code to label; codes outside the levels become null. The first level is the reference."""
    x = _col(x)
    out = None
    for level, label in zip(levels, labels or levels):
        test = x == F.lit(level)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out


def level_index(x: Column | str, levels: Sequence[str]) -> Column:
    """Place of a value in the level list, for ordering output."""
    return F.array_position(F.array(*[F.lit(v) for v in levels]), _col(x))


def estimate_text(m: Column, lo: Column, hi: Column, digits: int = 2, missing: str = "not reached") -> Column:
    """``m (lo–hi)`` for report tables; half-even rounding."""
    def show(v: Column) -> Column:
        return F.bround(v, digits).cast("string")

    return (
        F.when(m.isNull() | F.isnan(m), F.lit(missing))
        .when(lo.isNull() | hi.isNull(), show(m))
        .otherwise(F.concat(show(m), F.lit(" ("), show(lo), F.lit("–"), show(hi), F.lit(")")))
    )
