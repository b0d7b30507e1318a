"""String functions as Column expressions: record splitting, term normalization, tokenizers and small text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers that may open a term, and words that keep a comma where it is.
LEFT_PARENTHETICALS = ("X", "V", "D", "M", "EDTA", "SO", "Q")
LINKING_WORDS = ("of", "in", "to", "for", "with", "by", "on", "at", "from", "and", "or", "the")
CONCEPT_PLACEHOLDER = "C......."


def parse_record(line: Column, delimiter: str = "|") -> Column:
    """Fields of a delimited line; a delimiter at the end makes no empty field after it."""
    parts = F.split(line, f"[{delimiter}]", -1)
    return F.when(F.endswith(line, F.lit(delimiter)), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def strip_left_parentheticals(s: Column) -> Column:
    return F.regexp_replace(s, r"^(?:\[(?:" + "|".join(LEFT_PARENTHETICALS) + r")\][ \t]*)+", "")


def strip_nos(s: Column) -> Column:
    """Without a closing `, NOS` or ` NOS`."""
    return F.regexp_replace(s, r",? NOS$", "")


def uninvert(s: Column) -> Column:
    """`Cancer, Lung` as `Lung Cancer`: comma-separated segments in reverse, unless a segment holds a linking word or is empty."""
    linking = F.lower(s).rlike(r"(^|[^a-z])(" + "|".join(LINKING_WORDS) + r")([^a-z]|$)")
    plain = s.rlike(r"^ *+[^, ][^,]*+(?:, [^, ][^,]*+)++$")  # possessive: one pass over long texts, too
    return F.when(plain & ~linking, F.array_join(F.reverse(F.split(s, ", ")), " ")).otherwise(s)


def strip_hyphens(s: Column) -> Column:
    return F.regexp_replace(F.replace(s, F.lit("-"), F.lit(" ")), " {2,}", " ")


def strip_possessives(s: Column) -> Column:
    """word's and words' without the ending, before an end, blank or sign; in one pass, so nothing is stripped twice."""
    return F.when(F.contains(s, F.lit("'")), F.regexp_replace(s, r"([A-Za-z0-9]+)'s([^A-Za-z0-9]|$)|([A-Za-z0-9]*s)'([^A-Za-z0-9]|$)", "$1$2$3$4")).otherwise(s)


def normalize(s: Column) -> Column:
    """struct(norm string, types array<string>): the normalized term and which steps changed it, in their fixed order."""
    steps = (("nos", strip_nos), ("uninv", uninvert), ("parenth", strip_left_parentheticals), ("case", F.lower), ("hyphen", strip_hyphens), ("poss", strip_possessives))

    def apply(state: Column, name: str, step) -> Column:
        # One-element arrays bind a step's value to a name, so that each step is computed once.
        return F.transform(F.transform(state, lambda x: F.struct(x["norm"].alias("was"), step(x["norm"]).alias("norm"), x["types"].alias("types"))), lambda x: F.struct(x["norm"].alias("norm"), F.when(x["norm"] != x["was"], F.concat(x["types"], F.array(F.lit(name)))).otherwise(x["types"]).alias("types")))

    state = F.array(F.struct(s.alias("norm"), F.array().cast("array<string>").alias("types")))
    for name, step in steps:
        state = apply(state, name, step)
    done = F.transform(state, lambda x: F.struct(F.trim(x["norm"]).alias("norm"), x["types"].alias("types")))
    # Blanks that a step leaves side by side are an error, as terms are compared by what is left.
    bad = lambda x: F.raise_error(F.concat(F.lit("extra blank in the normalized term: "), x["norm"])).cast("string")
    return F.transform(done, lambda x: F.struct(F.when(F.contains(x["norm"], F.lit("  ")), bad(x)).otherwise(x["norm"]).alias("norm"), x["types"].alias("types")))[0]


def normal_form(s: Column) -> Column:
    """normalize()'s norm alone; runs of a-z and 0-9 between single blanks, which no step changes, are not taken through the steps."""
    return F.when(s.rlike(r"^[a-z0-9]++(?: [a-z0-9]++)*+\z"), s).otherwise(normalize(s)["norm"])


def print_cui(ts: Column, stt: Column, cui: Column) -> Column:
    """The placeholder for the preferred name of a concept, else the concept itself."""
    return F.when((ts == "P") & (stt == "PF"), F.lit(CONCEPT_PLACEHOLDER)).otherwise(cui)


def restore_status(line: Column) -> Column:
    """The first `|p|` of a line as `|P|`."""
    at = F.locate("|p|", line)
    return F.when(at > 0, F.concat(F.substring(line, F.lit(1), at - 1), F.lit("|P|"), F.substring(line, at + 3, F.length(line)))).otherwise(line)


def words(s: Column) -> Column:
    """Maximal runs of ASCII letters and digits of a lower-cased string."""
    return F.regexp_extract_all(s, F.lit("([a-z0-9]+)"))


def delimited_terms(s: Column) -> Column:
    """What remains between ASCII signs and white space."""
    return F.filter(F.split(s, r"[!-/:-@\[-`{-~ \t\n\r\f]+"), lambda x: x != "")


def reader_tokens(s: Column) -> Column:
    """Letter and digit runs, an apostrophe with what follows it, and the signs that stand alone; lower-cased."""
    return F.regexp_extract_all(F.lower(s), F.lit(r"([a-z]+|[0-9]+|'[a-z0-9]*|[,;:?!.&@\[\]()%/\"-])"))


def split_keep_empty(s: Column, delimiters: str) -> Column:
    """Fields between single delimiters; empty ones stay, save a leading one; an empty string has none."""
    parts = F.split(s, "[" + "".join("\\" + c for c in delimiters) + "]", -1)
    return F.when(s == "", F.array().cast("array<string>")).when(parts[0] == "", F.slice(parts, 2, F.size(parts))).otherwise(parts)


def get_token(s: Column, delimiters: str, position: int) -> Column:
    return F.coalesce(F.get(split_keep_empty(s, delimiters), F.lit(position)), F.lit(""))


def brace_list(items: Column) -> Column:
    """`{a {b c} {}}`: braces around items that are empty or hold a blank."""
    return F.concat(F.lit("{"), F.array_join(F.transform(items, lambda x: F.when((x == "") | x.contains(" "), F.concat(F.lit("{"), x, F.lit("}"))).otherwise(x)), " "), F.lit("}"))


def clean(s: Column) -> Column:
    return F.regexp_replace(F.trim(s), r"[ \t\n\r\f]+", " ")


def is_lowercase(s: Column) -> Column:
    """Has a-z and no A-Z; a null has no capitals and counts as lower case."""
    return F.coalesce(s.rlike("[a-z]") & ~s.rlike("[A-Z]"), F.lit(True))


def specific_types(types: Column, general: tuple[str, ...] = ("qlco", "fndg")) -> Column:
    """A list of several types without the general ones, unless none would be left."""
    kept = F.array_except(types, F.array(*[F.lit(g) for g in general]))
    return F.when((F.size(types) > 1) & (F.size(kept) > 0), F.filter(types, lambda t: ~t.isin(*general))).otherwise(types)


def simplify_categories(cats: Column) -> Column:
    """`none`, the only category, or a bracketed list."""
    return F.when(F.size(cats) == 0, F.lit("none")).when(F.size(cats) == 1, cats[0]).otherwise(F.concat(F.lit("["), F.array_join(cats, ","), F.lit("]")))


def ascii_upper(s: Column) -> Column:
    return F.translate(s, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def has_alnum(s: Column) -> Column:
    return s.rlike("[A-Za-z0-9]")


def join(items: Column, separator: str) -> Column:
    return F.array_join(items, separator)


def have_common(a: Column, b: Column) -> Column:
    """Whether two lists share an element."""
    return F.arrays_overlap(a, b)
