"""Column expressions over text: tokens, names, cleaning, windows and sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-case alphanumeric tokens; CamelCase is split first."""
    spaced = F.regexp_replace(text, "([a-z])([A-Z])", "$1 $2")
    return F.filter(F.split(F.lower(spaced), "[^a-z0-9]+"), lambda x: x != "")


def token_set(text: Column) -> Column:
    return F.array_distinct(tokens(text))


def flat_name(name: Column) -> Column:
    """A name for comparison: lower-case letters and digits only."""
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "")


def spaced_camel(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, "([A-Z]+)([A-Z][a-z])", "$1 $2"), "([a-z0-9])([A-Z])", "$1 $2")


def keywords(text: Column, stop: list[str], cap: int = 24, least: int = 2) -> Column:
    """Distinct tokens in order without stop words, the first ``cap``."""
    kept = F.filter(tokens(text), lambda x: (F.length(x) >= least) & ~x.isin(*stop))
    return F.slice(F.array_distinct(kept), 1, cap)


def section_depth(number: Column) -> Column:
    """Levels of a leading section number such as 4.2.1; 0 without one."""
    lead = F.regexp_extract(number, r"^\s*([0-9]+(\.[0-9]+)*)", 1)
    return F.when(lead == "", 0).otherwise(F.regexp_count(lead, F.lit(r"\.")) + 1)


def drop_lines(text: Column, pattern: str) -> Column:
    """Lines that match ``pattern`` anywhere go."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda line: ~line.rlike(pattern)), "\n")


def drop_ends(text: Column, first: int = 0, last: int = 0) -> Column:
    lines = F.split(text, "\n", -1)
    return F.array_join(F.slice(lines, first + 1, F.greatest(F.size(lines) - first - last, F.lit(0))), "\n")


def drop_block(text: Column, start: str, end: str) -> Column:
    """Lines from one that contains ``start`` up to one that contains ``end``, both included; an open block goes to the end."""
    s, e, line = _exactly(start), _exactly(end), r"[^\n]*"
    block = rf"\n(?:{line}{e}{line}{s}{line}|{line}{s}{line}{e}{line}|{line}{s}(?s:.*?)(?:{e}{line}|\z))"
    return F.substring(F.regexp_replace(F.concat(F.lit("\n"), text), block, ""), 2, 2**31 - 1)


def _exactly(text: str) -> str:
    """A pattern for the text itself, in any regex flavour."""
    return "".join(c if c.isalnum() or c in " _" else f"\\{c}" for c in text)


def squeeze(text: Column) -> Column:
    return F.regexp_replace(text, "\n{3,}", "\n\n")


def ignore(text: Column, pattern: str, match: str = "contains", scope: str = "line", case_sensitive: bool = True) -> Column:
    """Drop lines, paragraphs or the whole text by a rule: contains, startswith, exact or regex."""
    if match not in ("contains", "startswith", "exact", "regex"):
        raise ValueError(f"unknown match {match!r}")
    if scope not in ("line", "paragraph", "block"):
        raise ValueError(f"unknown scope {scope!r}")

    def hit(part: Column) -> Column:
        own, p = (part, pattern) if case_sensitive or match == "regex" else (F.lower(part), pattern.lower())
        if match == "contains":
            return own.contains(p)
        if match == "startswith":
            return F.ltrim(own).startswith(p)
        if match == "exact":
            return F.trim(own) == p
        return own.rlike(p if case_sensitive else f"(?i){p}")

    if scope == "block":
        return F.when(hit(text), "").otherwise(text)
    cut, glue = ("\n", "\n") if scope == "line" else ("\n{2,}", "\n\n")
    return squeeze(F.array_join(F.filter(F.split(text, cut, -1), lambda x: ~hit(x)), glue))


def char_windows(text: Column, size: int = 1000, overlap: int = 200) -> Column:
    """Array of (start, chunk); the last may lie wholly in the overlap.  Empty text: no windows."""
    t = F.trim(text)
    starts = F.sequence(F.lit(0), F.length(t) - 1, F.lit(size - overlap))
    each = F.transform(starts, lambda s: F.struct(s.alias("start"), F.substring(t, s + 1, F.lit(size)).alias("chunk")))
    return F.when(F.length(t) > 0, each).otherwise(F.array().cast("array<struct<start:int,chunk:string>>"))


def sentences(text: Column) -> Column:
    """Cut after . ! ? before white space and an ASCII capital, and at line ends."""
    marked = F.regexp_replace(text, r"([.!?])[ \t\n]+([A-Z])", "$1\u0001$2")
    return F.filter(F.transform(F.split(marked, "[\u0001\n]"), lambda x: F.trim(x)), lambda s: s != "")


def first_sentence(text: Column, cap: int = 800) -> Column:
    """Up to the first full stop that doesn't stand in a number."""
    one = F.regexp_extract(text, r"(?s)^(.*?[^0-9][.!?])(\s|$)", 1)
    return F.substring(F.when(one == "", text).otherwise(one), 1, cap)


def prose(columns: list[str], glue: str = " | ") -> Column:
    """``name: value`` of the cells that aren't empty."""
    cells = F.array(*[F.when(F.trim(F.col(c).cast("string")) != "", F.concat(F.lit(f"{c}: "), F.col(c).cast("string"))) for c in columns])
    return F.array_join(F.filter(cells, lambda x: x.isNotNull()), glue)


def noisy(text: Column, marks: str = r"[{}#;:]", share: float = 0.10, least: int = 20) -> Column:
    """Style-sheet remains: marks take more than ``share`` of a text of some length."""
    return (F.length(text) >= least) & (F.regexp_count(text, F.lit(marks)) / F.length(text) > share)


def dice(a: Column, b: Column) -> Column:
    return F.when(F.size(a) + F.size(b) == 0, 0.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b)))


def without_word(name: Column, word: str = "cluster") -> Column:
    """A name without a word, wherever it stands."""
    return F.trim(F.regexp_replace(F.regexp_replace(name, rf"(?i)\b{word}\b", " "), r"\s+", " "))


def without_suffix(name: Column, suffix: str = "cluster") -> Column:
    return F.trim(F.regexp_replace(name, rf"(?i)\s*\b{suffix}\s*$", ""))


def camel_key(name: Column) -> Column:
    """Words put together, each with a capital: one spelling of a name."""
    words = F.filter(F.split(F.regexp_replace(name, r"([a-z])([A-Z])", "$1 $2"), "[^A-Za-z0-9]+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substring(w, 2, 2**31 - 1))), "")


def initials(name: Column, overrides: dict[str, str] | None = None) -> Column:
    """A prefix for a name: a given one, else the capitals of its words, the first four letters of a single word."""
    words = F.filter(F.split(F.regexp_replace(name, r"([a-z])([A-Z])", "$1 $2"), "[^A-Za-z0-9]+"), lambda w: w != "")
    own = F.when(F.size(words) == 1, F.upper(F.left(words[0], F.lit(4)))).otherwise(F.upper(F.array_join(F.transform(words, lambda w: F.left(w, F.lit(1))), "")))
    if not overrides:
        return own
    pairs = [F.lit(x) for k, v in overrides.items() for x in (k.lower(), v)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(name)), own)


def encoded(metadata: Column, lists: list[str]) -> Column:
    """A struct as a map of strings, its lists as JSON, for stores that hold no lists."""
    return F.from_json(F.to_json(metadata), "map<string,string>") if lists else metadata


def decoded(value: Column) -> Column:
    """A list from its JSON; null where it is none."""
    return F.from_json(value, "array<string>")


def front_loaded(text: Column, most: int = 30, context: int = 4000) -> Column:
    """A change's marks first, ``most`` at most, then the beginning of its text."""
    marks = F.slice(F.regexp_extract_all(text, F.lit(r"(\[(?:ADDED|REMOVED|CHANGED): [^\]]*\])"), F.lit(1)), 1, most)
    return F.when(F.size(marks) > 0, F.concat(F.array_join(marks, "\n"), F.lit("\n\n"), F.left(text, F.lit(context)))).otherwise(F.left(text, F.lit(context)))
