"""Numbers and units as people write them (N1-N16). All give null where nothing parses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind, normalize_text

#: A number in a title: digits in groups of any separator.
NUMBER = r"[0-9]+(?:[.,'’][0-9]+)*(?:[.,][0-9]+)?"
MAX_MW = 1000


def _after_last(text: Column, sign: str) -> Column:
    return F.length(F.substring_index(text, sign, -1))


def _without(text: Column, sign: str) -> Column:
    return F.replace(text, F.lit(sign), F.lit(""))


def _comma_decimal(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("."))


def resolve_separators(text: Column, both: str = "last", many_dots: str = "invalid") -> Column:
    """A double from digits, dots and commas.

    both: which sign is the decimal one if both occur, the last or always the comma.
    many_dots: of several dots, none, or the last is decimal.
    """
    return bind(text, lambda x: _resolved(x, both, many_dots))


def _resolved(text: Column, both: str, many_dots: str) -> Column:
    has_comma, has_dot = F.contains(text, F.lit(",")), F.contains(text, F.lit("."))
    comma_last = _comma_decimal(_without(text, "."))
    dot_last = _without(text, ",")
    mixed = comma_last if both == "comma" else F.when(_after_last(text, ",") < _after_last(text, "."), comma_last).otherwise(dot_last)
    only_dots = text
    if many_dots == "last":
        pieces = F.split(text, r"\.")
        joined = F.concat(F.array_join(F.slice(pieces, 1, F.size(pieces) - 1), ""), F.lit("."), F.element_at(pieces, -1))
        only_dots = F.when(F.size(pieces) > 2, joined).otherwise(text)
    plain = F.when(has_comma & has_dot, mixed).when(has_comma, _comma_decimal(text)).when(has_dot, only_dots).otherwise(text)
    return F.when(text != "", plain.try_cast("double"))


def italian_number(c: Column) -> Column:
    """37.688,4 is 37688.4; a dot alone is decimal."""
    return resolve_separators(F.replace(F.trim(c), F.lit(" "), F.lit("")))


def number_in(c: Column) -> Column:
    """The first number of a text; apostrophes group thousands, of several dots the last is decimal."""
    text = F.regexp_replace(F.regexp_replace(c.cast("string"), r"[\x{00A0} ]", ""), "[’`]", "'")
    found = F.regexp_extract(text, r"[-+]?[0-9]+(?:[.,'][0-9]+)*(?:[.,][0-9]+)?", 0)
    return resolve_separators(_without(found, "'"), many_dots="last")


def power_in_text(c: Column, max_mw: float = MAX_MW) -> Column:
    """Megawatts named in a text.

    Numbers after "potenza" count before others, and those with the unit in
    front only if there are no others; megawatts count before kilowatts. Not
    above 0, or above max_mw, is null.
    """
    return bind(F.lower(normalize_text(c)), lambda x: _power_in(x, max_mw))


def _power_in(text: Column, max_mw: float) -> Column:
    for written in ("mw p", "mwp"):
        text = F.replace(text, F.lit(written), F.lit("mw"))
    for written in ("kw p", "kwp"):
        text = F.replace(text, F.lit(written), F.lit("kw"))
    number = "([0-9]+(?:[.,][0-9]+)*)"
    shapes = [
        (rf"potenza(?:\s+\w+){{0,8}}?\s*(?:pari\s+a|di|da)?\s*{number}\s*(mw|kw)\b", 1, 2),
        (rf"{number}\s*(mw|kw)\b", 1, 2),
        (rf"\b(mw|kw)\b\s*[:=]?\s*{number}", 2, 1),
    ]

    def candidates(pattern: str, n: int, u: int) -> Column:
        numbers, units = (F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (n, u))
        both = F.arrays_zip(F.transform(numbers, italian_number).alias("n"), units.alias("u"))
        return F.filter(both, lambda x: x["n"].isNotNull())

    found = None
    for shape in reversed(shapes):
        own = candidates(*shape)
        found = own if found is None else F.when(F.size(own) > 0, own).otherwise(found)

    def chosen(all_found: Column) -> Column:
        mw = F.filter(all_found, lambda x: x["u"] == "mw")
        return F.coalesce(F.get(mw, F.lit(0)), F.get(all_found, F.lit(0)))

    value = bind(bind(found, chosen), lambda x: F.when(x["u"] == "kw", x["n"] / 1000).otherwise(x["n"]))
    return bind(value, lambda x: F.when((x > 0) & (x <= max_mw), x))


def title_power(number: Column, unit: Column) -> Column:
    """Megawatts from a number of a title and its unit.

    Kilowatts with one dot are ambiguous: 980.20 kWp is 0.9802 MW, 4.495 kWp
    and 130.000 kWp are 4.495 and 130 MW.
    """
    raw = F.regexp_replace(F.regexp_replace(number, r"[\x{00A0} ]", ""), "[’`]", "'")
    return bind(F.struct(raw.alias("raw"), number_in(raw).alias("n"), unit.alias("unit")), lambda x: _title_power(x["raw"], x["n"], x["unit"]))


def _title_power(raw: Column, n: Column, unit: Column) -> Column:
    pieces = F.split(raw, r"\.")
    decimals = F.length(F.element_at(pieces, -1))
    thousandth = n / 1000
    one_dot = F.when((decimals == 2) & (n >= 100), thousandth).when((decimals >= 3) & (n < 1000), n).when(n >= 1000, thousandth).otherwise(n)
    many_dots = F.when(n >= 1000, thousandth).otherwise(n)
    dotted = F.contains(raw, F.lit(".")) & ~F.contains(raw, F.lit(",")) & ~F.contains(raw, F.lit("'"))
    kilo = F.when(dotted & (F.size(pieces) == 2), one_dot).when(dotted, many_dots).otherwise(thousandth)
    return F.when(F.startswith(F.lower(unit), F.lit("kw")), kilo).otherwise(n)


def title_powers(title: Column) -> Column:
    """All megawatts that a title names, in order, those equal to six decimals once."""

    return bind(title, _title_powers)


def _title_powers(title: Column) -> Column:
    def found(pattern: str) -> Column:
        numbers, units = (F.regexp_extract_all(title, F.lit(pattern), F.lit(g)) for g in (1, 2))
        return F.transform(F.arrays_zip(numbers.alias("n"), units.alias("u")), lambda x: title_power(x["n"], x["u"]))

    plain = rf"(?i)({NUMBER})\s*(mwp|mw|kwp|kw)\b"
    named = rf"(?i)potenza[^0-9]{{0,60}}({NUMBER})\s*(mwp|mw|kwp|kw)\b"
    every = F.filter(F.concat(found(plain), found(named)), lambda x: x.isNotNull())

    def first_of_each(xs: Column) -> Column:
        return bind(F.transform(xs, lambda x: F.round(x, 6)), lambda rounded: F.filter(xs, lambda x, i: F.array_position(rounded, F.get(rounded, i)) == i + 1))

    return F.coalesce(bind(every, first_of_each), F.array().cast("array<double>"))


def parse_power(c: Column) -> Column:
    """The first power of a text in megawatts, rounded to six decimals.

    An apostrophe groups thousands. Kilowatts with one dot: three decimals
    after up to three digits are thousands, four are thousands and a decimal.
    """
    value = r"([0-9]{1,3}(?:[.\s'’][0-9]{3})+(?:[,.][0-9]+)?|[0-9]+[.,][0-9]+|[0-9]+)"
    unit = "(mwp|mw|kwp|kw)"
    first, second = rf"(?i)(?<![0-9.,'’]){value}\s*{unit}\b", rf"(?i)\b{unit}\b\s*[:=]?\s*{value}(?![0-9.,'?])"
    in_front = ~F.rlike(c, F.lit(first))
    number = F.when(in_front, F.regexp_extract(c, second, 2)).otherwise(F.regexp_extract(c, first, 1))
    name = F.lower(F.when(in_front, F.regexp_extract(c, second, 1)).otherwise(F.regexp_extract(c, first, 2)))
    s = F.replace(F.regexp_replace(number, r"\s", ""), F.lit("’"), F.lit("'"))
    return bind(F.struct(s.alias("s"), name.alias("unit")), lambda x: F.when(x["s"] != "", _parsed_power(x["s"], x["unit"])))


def _parsed_power(s: Column, name: Column) -> Column:
    kilo = F.startswith(name, F.lit("kw"))
    shape = F.regexp_extract(s, r"\A([0-9]{1,3})\.([0-9]+)\z", 2)
    four = F.concat(F.replace(F.left(s, F.length(s) - 1), F.lit("."), F.lit("")), F.lit("."), F.right(s, F.lit(1)))
    plain = (
        F.when(F.contains(s, F.lit("'")), _comma_decimal(_without(s, "'")))
        .when(F.contains(s, F.lit(".")) & F.contains(s, F.lit(",")), _comma_decimal(_without(s, ".")))
        .when(F.contains(s, F.lit(",")), _comma_decimal(s))
        .when(kilo & (F.length(shape) == 4), four)
        .when(kilo & (F.length(shape) == 3), _without(s, "."))
        .otherwise(s)
    )
    parsed = plain.try_cast("double")
    return F.round(F.when(kilo, parsed / 1000).otherwise(parsed), 6)


def dashboard_number(c: Column) -> Column:
    """With both signs the comma is decimal; units and other signs are dropped."""
    text = F.replace(F.regexp_replace(F.trim(c.cast("string")), "MW|Mw|mw", ""), F.lit(" "), F.lit(""))
    mixed = F.when(F.contains(text, F.lit(",")) & F.contains(text, F.lit(".")), _comma_decimal(_without(text, "."))).otherwise(_comma_decimal(text))
    return F.nullif(F.regexp_replace(mixed, r"[^0-9.\-]", ""), F.lit("")).try_cast("double")


def dashboard_integer(c: Column) -> Column:
    """The digits of a text."""
    return F.nullif(F.regexp_replace(c.cast("string"), r"[^0-9\-]", ""), F.lit("")).try_cast("int")


def diff_number(c: Column) -> Column:
    """Other signs are dropped, the last separator is decimal."""
    return resolve_separators(F.regexp_replace(c.cast("string"), r"[^0-9,.\-]", ""))


def export_power(c: Column) -> Column:
    """As diff_number, kilowatts by a thousand, 0 where nothing parses."""
    raw = F.trim(c.cast("string"))
    kilo = F.rlike(raw, F.lit(r"(?i)\bkwp?\b")) & ~F.rlike(raw, F.lit(r"(?i)\bmwp?\b"))
    n = diff_number(raw)
    return F.coalesce(F.when(kilo, n / 1000).otherwise(n), F.lit(0.0))


def italian_format(c: Column, decimals: int = 3, trim_zeros: bool = False) -> Column:
    """1.234,567."""
    text = F.translate(F.format_number(c, decimals), ",.", ".,")
    return F.regexp_replace(text, r",?0+\z", "") if trim_zeros and decimals else text


def _relative_gap(a: Column, b: Column) -> Column:
    return F.abs(a - b) / F.greatest(F.abs(a), F.abs(b), F.lit(1.0))


def power_close(a: Column, b: Column, tolerance: float = 0.025) -> Column:
    """Close, or one of them unknown."""
    return F.coalesce(_relative_gap(a, b) <= tolerance, F.lit(True))


def power_conflict(a: Column, b: Column, tolerance: float = 0.035) -> Column:
    """Both known and apart."""
    return F.coalesce(_relative_gap(a, b) > tolerance, F.lit(False))


def title_agrees(powers: Column, field: Column, tolerance: float = 0.05) -> Column:
    """A power of the title is close to the field, or there is nothing to compare."""
    return field.isNull() | (F.size(powers) == 0) | F.exists(powers, lambda x: _relative_gap(x, field) <= tolerance)


def under_scaled(field: Column, title: Column) -> Column:
    """The field is so small beside the title that it was divided once too often."""
    small = ((field < 1) & (title >= 3)) | ((field < 0.5) & (title >= 2))
    return F.when(title.isNull(), F.lit(False)).when(field.isNull() | (field <= 0), title > 0).otherwise(small)


def best_title_power(powers: Column, field: Column) -> Column:
    """Of the powers that would repair the field, the one whose ratio to it is nearest to a whole number."""
    ratio = lambda x: x / F.greatest(field, F.lit(1e-9))
    fits = F.filter(powers, lambda x: under_scaled(field, x))
    ranked = F.transform(fits, lambda x, i: F.struct(F.abs(ratio(x) - F.bround(ratio(x))).alias("off"), i.alias("i"), x.alias("x")))
    first = F.get(powers, F.lit(0))
    return F.when(field.isNull() | (field == 0), first).otherwise(F.coalesce(F.array_min(ranked)["x"], first))


def safe_ratio(value: Column, most: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(value.cast("double"), most.cast("double")), F.lit(0.0))


def power_matches(actual: Column, expected: Column) -> Column:
    """Within a thousandth or 0.05 percent; anything matches an unknown expectation."""
    near = F.abs(actual - expected) <= F.greatest(F.lit(0.001), F.abs(expected) * 0.0005)
    return expected.isNull() | F.coalesce(near, F.lit(False))


def completeness(logical: list[Column], every: list[Column]) -> Column:
    """Three points for each logical field, and one for each column, that is present."""
    from .text import is_blank

    points = [F.when(~is_blank(c), n).otherwise(0) for cs, n in ((logical, 3), (every, 1)) for c in cs]
    return sum(points[1:], points[0])
