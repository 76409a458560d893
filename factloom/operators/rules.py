"""Rule tables: an evaluator for rules that are data.

A rule is (label, needs, unless): it holds where each field in `needs` has a match of its pattern and no field in `unless` has. Fields are named columns; a field that is null
matches nothing. decide() takes the first rule that holds, exclusive() the only one, every() all of them. Vocabularies belong to the caller: they come from a rule
file (sources.external.rules_from_yaml) or are passed as lists, and this module holds none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = tuple[str | tuple, dict[str, str], dict[str, str]]
AMBIGUOUS = "AMBIGUOUS"


def words(*alternatives: str) -> str:
    """A pattern of whole words in any case. Word borders are those of letters and digits of all scripts."""
    return r"(?i)(?:^|[^\p{L}\p{N}])(?:" + "|".join(alternatives) + r")(?:[^\p{L}\p{N}]|\z)"


def on(field: str, table: list[tuple[str, str]]) -> list[Rule]:
    """Rules of one field from (label, pattern) pairs."""
    return [(label, {field: pattern}, {}) for label, pattern in table]


def holds(fields: dict[str, Column], rule: Rule) -> Column:
    """Whether a rule holds; never null."""
    _, needs, unless = rule
    if lacking := (needs.keys() | unless.keys()) - fields.keys():
        raise KeyError(f"no such fields: {sorted(lacking)}")
    found = lambda f, p: F.coalesce(fields[f].rlike(p), F.lit(False))
    return combined(*[found(f, p) for f, p in needs.items()], *[~found(f, p) for f, p in unless.items()])


def _label(label: str | tuple, names: list[str] | None) -> Column:
    if names is None:
        return F.lit(label)
    return F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, label, strict=True)])


def decide(fields: dict[str, Column], rules: list[Rule], default: str | tuple | None = None, names: list[str] | None = None) -> Column:
    """Label of the first rule that holds, else `default`. With names, labels are tuples and the result is a struct."""
    out = _label(default, names) if default is not None or names is None else F.lit(None)
    for rule in reversed(rules):
        out = F.when(holds(fields, rule), _label(rule[0], names)).otherwise(out)
    return out


def every(fields: dict[str, Column], rules: list[Rule]) -> Column:
    """Labels of all rules that hold, in the rules' order, each once."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(holds(fields, r), F.lit(r[0])) for r in rules])))


def exclusive(fields: dict[str, Column], rules: list[Rule], several: str = AMBIGUOUS, none: str | None = None) -> Column:
    """The label that all rules that hold share; `several` where they differ, `none` where no rule holds."""
    found = every(fields, rules)
    return F.when(F.size(found) > 1, several).otherwise(F.coalesce(F.get(found, F.lit(0)), F.lit(none)))


def stated(value: Column, said: str, denied: str) -> Column:
    """True where it is said, false where it is denied (a denial outweighs what it denies), null where it isn't named."""
    return F.when(value.rlike(denied), False).when(value.rlike(said), True)


def combined(*flags: Column) -> Column:
    """Whether all flags hold; unknown ones don't."""
    return reduce(lambda a, b: a & b, [F.coalesce(f, F.lit(False)) for f in flags], F.lit(True))


def features(value: Column, table: dict[str, str], counts: dict[str, tuple[Column, int]]) -> list[Column]:
    """A boolean for each pattern of a text, and for each count whether it reaches its least value; null counts don't."""
    return [*[F.coalesce(value.rlike(p), F.lit(False)).alias(n) for n, p in table.items()], *[F.coalesce(c >= least, F.lit(False)).alias(n) for n, (c, least) in counts.items()]]


def against(value: Column, low: Column, high: Column) -> Column:
    """LOW or HIGH beyond a known end, NORMAL between two known ends, else UNKNOWN."""
    return F.when(value < low, "LOW").when(value > high, "HIGH").when(value.isNotNull() & low.isNotNull() & high.isNotNull(), "NORMAL").otherwise("UNKNOWN")


# --- lines of a text --------------------------------------------------------------------------------------------------------------

#: The space separators of Unicode (class Zs): what counts as blank at the ends of a line, tabs and carriage returns don't.
SPACES = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def bare(line: Column) -> Column:
    """A line without the space separators of any kind at its ends."""
    return F.trim(line, F.lit(SPACES))


def leading_line(body: Column) -> Column:
    """The first line that isn't blank; null without one."""
    return F.get(F.filter(F.split(body, "\n"), lambda x: bare(x) != ""), F.lit(0))


def routed(heading: Column, body: Column, rules: list[Rule], longest: int = 160) -> Column:
    """Labels of the rules on the field `heading` that hold for a heading, or for the leading line where that is null or empty; what is longer than `longest` is no heading."""
    evidence = F.coalesce(F.nullif(heading, F.lit("")), leading_line(body), F.lit(""))
    return F.when(F.length(evidence) <= longest, every({"heading": evidence}, rules)).otherwise(F.array().cast("array<string>"))


def page_line(line: Column, patterns: list[tuple[str, str]]) -> Column:
    """struct(pattern, page_number) of the first pattern that a whole line matches; its first group is the number of the page. Dashes and blanks are made alike."""
    own = F.trim(F.regexp_replace(F.regexp_replace(line, "[‐‑‒–—−]", "-"), r"\s+", " "))
    out = F.lit(None).cast("struct<pattern:string,page_number:int>")
    for name, p in reversed(patterns):
        number = F.regexp_extract(own, f"(?i)^{p}$", 1).try_cast("int") if "(" in p.replace("(?:", "") else F.lit(None).cast("int")
        out = F.when(own.rlike(f"(?i)^{p}$"), F.struct(F.lit(name).alias("pattern"), number.alias("page_number"))).otherwise(out)
    return out


def joined_headings(lines: Column, headings: list[str], most: int = 3) -> Column:
    """The longest of the known headings that up to `most` lines from each line on spell together, blanks aside; null elsewhere. One value for each line."""
    squeezed = lambda x: F.regexp_replace(F.upper(x), r"[\s:]", "")
    known = {h.upper().replace(" ", "").replace(":", ""): h for h in sorted(headings, key=len)}
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    joined = lambda i, k: F.when(i + k <= F.size(lines), squeezed(F.array_join(F.slice(lines, i + 1, F.lit(k)), "")))
    pick = lambda _, i: F.coalesce(*[F.try_element_at(table, joined(i, k)) for k in range(most, 0, -1)])
    return F.transform(lines, pick)


def without_part(body: Column, opens: str, closes: str) -> Column:
    """The lines of a text without the parts that an opening line begins and a closing line ends (the closing line stays)."""

    def step(s: Column, line: Column) -> Column:
        off = F.when(line.rlike(closes), False).when(line.rlike(opens), True).otherwise(s["off"])
        return F.struct(off.alias("off"), F.when(off, s["kept"]).otherwise(F.concat(s["kept"], F.array(line))).alias("kept"))

    start = F.struct(F.lit(False).alias("off"), F.array().cast("array<string>").alias("kept"))
    return F.array_join(F.aggregate(F.split(body, "\n"), start, step, lambda s: s["kept"]), "\n")


def all_lines(body: Column, pattern: str) -> Column:
    """Whether a text has lines that aren't blank and each of them has a match."""
    rows = F.filter(F.transform(F.split(body, "\n"), bare), lambda x: x != "")
    return F.coalesce((F.size(rows) > 0) & F.forall(rows, lambda x: x.rlike(pattern)), F.lit(False))


def dimensions(passage: Column, volume: str = "volume") -> list[Column]:
    """d1, d2, d3 (mm), longest, volume_ml of sizes such as `12 x 2.5 x 7 mm` or cm, and of a stated volume in ml that follows the word; no volume is derived."""
    number = r"([0-9]+(?:[.,][0-9]+)?)"
    size = rf"(?i){number}\s*[x×]\s*{number}(?:\s*[x×]\s*{number})?\s*(mm|cm)(?![\p{{L}}\p{{N}}])"
    value = lambda pattern, g: F.replace(F.regexp_extract(passage, pattern, g), F.lit(","), F.lit(".")).try_cast("double")
    scale = F.when(F.lower(F.regexp_extract(passage, size, 4)) == "cm", 10.0).otherwise(1.0)
    d = [value(size, g) * scale for g in (1, 2, 3)]
    stated_volume = value(rf"(?i){volume}[^0-9.;\n]*{number}\s*(?:ml|cm3|cm³)", 1)
    return [*[c.alias(f"d{i}") for i, c in enumerate(d, 1)], F.array_max(F.array(*d)).alias("longest"), stated_volume.alias("volume_ml")]
