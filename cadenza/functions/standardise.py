"""Standardisers (SCL-01 … SCL-28) as native Column expressions.

Raw tables are read with every column as text.  A standardiser maps text to
text and *keeps* input it cannot parse (the typed conversion of SCL-20 turns
what is left into NULL), so several standardisers can be chained in rule
order exactly like the source application's per-value functions -- but here they are
one JVM projection with no Python per row.  Parsers that bind a value by a
lambda (``_let``) are interpreted, the others are compiled.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace the source application strips (Python str.strip): ASCII + Unicode spaces.
_WS = r"[\s\p{Z}\x{FEFF}]"

# Truthy / falsy words of toBoolean; the survey variant adds oui / non.
TRUE_WORDS = ["true", "1", "yes", "y"]
FALSE_WORDS = ["false", "0", "no", "n"]
SURVEY_TRUE_WORDS = TRUE_WORDS + ["oui"]
SURVEY_FALSE_WORDS = FALSE_WORDS + ["non"]

# Date formats tried in order (month-first before day-first).
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd",
                "M/d/yyyy hh:mm:ss a", "M/d/yyyy", "M-d-yyyy", "d/M/yyyy", "d-M-yyyy",
                "yyyyMMdd", "yyyy"]
SURVEY_DATE_FORMAT = "dd/MM/yyyy HH:mm:ss"

# Emoji / pictograph / joiner ranges removed by trimEmoji.
EMOJI_CLASS = (r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
               r"\x{2700}-\x{27BF}\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}\x{2600}-\x{26FF}"
               r"\x{2300}-\x{23FF}\x{FE0F}\x{200D}]+")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """SCL-01 core: strip leading/trailing whitespace (Python ``str.strip``)."""
    return F.regexp_replace(_c(c), rf"^{_WS}+|{_WS}+$", "")


def _arraywise(fn: Callable[[Column], Column]) -> Callable:
    def apply(c, is_array: bool = False) -> Column:
        col = _c(c)
        return F.transform(col, fn) if is_array else fn(col)
    return apply


trim_spaces = _arraywise(strip_ws)                     # SCL-01
to_lower = _arraywise(F.lower)                         # SCL-02
to_upper = _arraywise(F.upper)                         # SCL-02


def to_string(c) -> Column:
    """SCL-03: ``str(x).strip()``."""
    return strip_ws(_c(c).cast("string"))


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times in ``body`` (a lambda).

    Column expressions are trees: reusing a Python variable copies the
    sub-tree, and chained parsers grow exponentially.  A one-element
    ``transform`` evaluates ``value`` once per row instead.
    """
    return F.transform(F.array(value), body).getItem(0)


def _int_text(d: Column) -> Column:
    """Integer text of an integral finite double, else NULL."""
    return _let(d, lambda x: F.when(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(9.2e18)) & (x == F.floor(x)),
                                    x.cast("long").cast("string")))


def to_int(c) -> Column:
    """SCL-04: integer text; ``1 234`` / ``1,234`` / ``2,0`` / ``3.0`` accepted.

    Returns the canonical integer as text, or the input unchanged.
    """
    raw = _c(c)

    def with_t(t):
        sign = F.when(t.rlike(r"^[+-]"), F.substring(t, 1, 1)).otherwise(F.lit(""))
        body = F.regexp_replace(F.regexp_replace(t, r"^[+-]", ""), r"[\x{202F} _]", "")
        return _let(F.struct(sign.alias("s"), body.alias("b")), lambda sb: _int_case(raw, t, sb["s"], sb["b"]))
    fast = raw.try_cast("long")            # plain integer text: canonical form, no parsing rules
    return (F.when(raw.isNull(), raw)
            .when(raw.rlike(r"^[+-]?[0-9]{1,18}$") & fast.isNotNull(), fast.cast("string"))
            .otherwise(_let(strip_ws(raw), with_t)))


def _int_case(raw: Column, t: Column, sign: Column, body: Column) -> Column:
    signed = F.concat(sign, body)
    return (F.when((t == "") | (body == ""), raw)
            .when(F.instr(body, ".") > 0, F.coalesce(_int_text(signed.try_cast("double")), raw))
            .when(F.instr(body, ",") > 0,
                  F.when(body.rlike(r"^[0-9]+(,[0-9]{3})+$"),
                         F.coalesce(F.regexp_replace(signed, ",", "").try_cast("long").cast("string"), raw))
                  .when(body.rlike(r"^[0-9]+,[0-9]+$"),
                        F.coalesce(_int_text(F.concat(sign, F.regexp_replace(body, ",", ".")).try_cast("double")), raw))
                  .otherwise(raw))
            .when(body.rlike(r"^[0-9]+$"), F.coalesce(signed.try_cast("long").cast("string"), raw))
            .otherwise(raw))


def to_float(c) -> Column:
    """SCL-05: decimal text; both ``,`` and ``.`` ⇒ comma is thousands, only ``,`` ⇒ decimal."""
    raw = _c(c)

    def with_t(t):
        norm = F.when(F.instr(t, ".") > 0, F.replace(t, F.lit(","), F.lit(""))).otherwise(
            F.replace(t, F.lit(","), F.lit(".")))
        return F.when(t == "", raw).otherwise(F.coalesce(norm.try_cast("double").cast("string"), raw))
    # Fast path: text that already casts (no comma to reinterpret) gives the
    # same canonical number as the full path, without any regex.
    fast = raw.try_cast("double")
    # Full path: strip the ends, drop spaces / underscores / U+202F; the
    # result is bound once for the comma rules.
    stripped = F.regexp_replace(strip_ws(raw), r"[\x{202F} _]", "")
    return (F.when(raw.isNull(), raw)
            .when((F.instr(raw, ",") == 0) & fast.isNotNull(), fast.cast("string"))   # comma test first:
            .otherwise(_let(stripped, with_t)))                                         # a failed cast is costly


to_double = to_float


def to_boolean(c, true_words: Sequence[str] = TRUE_WORDS, false_words: Sequence[str] = FALSE_WORDS) -> Column:
    """SCL-06: ``true``/``false`` text for known words, else unchanged."""
    raw = _c(c)
    k = F.lower(strip_ws(raw))
    return F.when(k.isin(list(true_words)), F.lit("true")).when(k.isin(list(false_words)), F.lit("false")).otherwise(raw)


def survey_to_boolean(c) -> Column:
    """SCL-07: first comma-separated part, with oui / non added."""
    raw = _c(c)
    first = F.lower(strip_ws(F.split(raw, ",").getItem(0)))
    return (F.when(first.isin(SURVEY_TRUE_WORDS), F.lit("true"))
            .when(first.isin(SURVEY_FALSE_WORDS), F.lit("false")).otherwise(raw))


# Cheap shape test per date format: a format is only tried on text of its
# shape, so a row never pays for the parse failures of the other formats.
_FORMAT_SHAPES = {
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$",
    "yyyy-MM-dd'T'HH:mm:ss": r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$",
    "yyyy-MM-dd": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "yyyy/MM/dd": r"^\d{4}/\d{1,2}/\d{1,2}$",
    "M/d/yyyy hh:mm:ss a": r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2} [AaPp][Mm]$",
    "M/d/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "M-d-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    "d/M/yyyy": r"^\d{1,2}/\d{1,2}/\d{4}$",
    "d-M-yyyy": r"^\d{1,2}-\d{1,2}-\d{4}$",
    "yyyyMMdd": r"^\d{8}$",
    "yyyy": r"^\d{4}$",
    "dd/MM/yyyy HH:mm:ss": r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$",
}


def _parse_with(t: Column, fmt: str) -> Column:
    shape = _FORMAT_SHAPES.get(fmt)
    parsed = F.try_to_timestamp(t, F.lit(fmt))
    return F.when(t.rlike(shape), parsed) if shape else parsed


def parse_date_col(c, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """SCL-08 (typed): first matching format → DATE, else NULL."""
    return _let(strip_ws(_c(c)), lambda t: F.coalesce(*[_parse_with(t, f) for f in formats]).cast("date"))


def parse_date(c, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """SCL-08: ISO date text, or the input unchanged."""
    return F.coalesce(F.date_format(parse_date_col(c, formats), "yyyy-MM-dd"), _c(c))


def survey_parse_date(c) -> Column:
    """SCL-09: ``dd/MM/yyyy HH:mm:ss`` only, time dropped."""
    return F.coalesce(F.date_format(_parse_with(strip_ws(_c(c)), SURVEY_DATE_FORMAT), "yyyy-MM-dd"), _c(c))


def normalize_duration(c) -> Column:
    """SCL-10: ``H:M:S`` / ``M:S`` (minutes, seconds < 60) → seconds; else
    ``int(float(x))``; else unchanged."""
    raw = _c(c)

    def with_t(t):
        parts = F.split(t, ":")
        return _let(F.struct(F.size(parts).alias("n"), F.get(parts, 0).try_cast("long").alias("a"),
                             F.get(parts, 1).try_cast("long").alias("b"), F.get(parts, 2).try_cast("long").alias("c"),
                             t.try_cast("double").alias("d")), lambda p: _duration_case(p))
    return F.when(raw.isNull(), raw).otherwise(F.coalesce(_let(strip_ws(raw), with_t), raw))


def _duration_case(p: Column) -> Column:
    a, b, c, d = p["a"], p["b"], p["c"], p["d"]
    hms = F.when(a.isNotNull() & b.isNotNull() & c.isNotNull() & (b < 60) & (c < 60), a * 3600 + b * 60 + c)
    ms = F.when(a.isNotNull() & b.isNotNull() & (b < 60), a * 60 + b)
    num = F.when(d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(9.2e18)), d.cast("long"))
    return F.when(p["n"] == 3, hms).when(p["n"] == 2, ms).otherwise(num).cast("string")


def _bare(word: str) -> str:
    """Pattern of ``word`` outside quotes: each match goes on where the last ended and steps over whole quoted items."""
    first, rest = word[0], word[1:]
    return (rf"\G((?:[^'\"{first}]++|(?<=\w){first}|{first}(?!{rest}\b)|'(?:[^'\\]|\\.)*+'|\"(?:[^\"\\]|\\.)*+\")*+){word}")


def _py_literal_to_json(c: Column) -> Column:
    """Bounded rewrite of a Python list/tuple literal into JSON-ish text."""
    t = strip_ws(c)
    t = F.regexp_replace(t, r"^\((.*)\)$", "[$1]")
    for word, value in (("None", "null"), ("True", "true"), ("False", "false")):
        t = F.regexp_replace(t, _bare(word), f"$1{value}")
    return t


def parse_py_list(c) -> Column:
    """SCL-14: Python list literal → array<string> (items as text, dicts as
    JSON text); blank → empty; not a list → NULL."""
    raw = _c(c)
    t = strip_ws(raw)
    parsed = F.from_json(_py_literal_to_json(raw), "array<string>", {"allowSingleQuotes": "true"})
    return F.when(t == "", F.array().cast("array<string>")).otherwise(parsed)


def _dict_field(item: Column, fields: Sequence[str]) -> Column:
    return F.coalesce(*[F.get_json_object(item, f"$.{f}") for f in fields])


def extract_genre_ids(c) -> Column:
    """SCL-11: list of dicts (``genre_id``) / strings / ints → array<bigint>;
    unparseable ⇒ empty; non-integer items skipped."""
    items = F.coalesce(parse_py_list(c), F.array().cast("array<string>"))
    as_num = F.transform(items, lambda x: F.coalesce(
        F.when(x.startswith("{"), _dict_field(x, ["genre_id"])), x))
    ids = F.transform(as_num, lambda x: _int_text(strip_ws(x).try_cast("double")).cast("long"))
    return F.filter(ids, lambda x: x.isNotNull())


def normalize_tags(c) -> Column:
    """SCL-12: list of scalars or dicts (``name``/``tag``/``value``) → trimmed
    non-empty strings; unparseable ⇒ empty."""
    items = F.coalesce(parse_py_list(c), F.array().cast("array<string>"))
    vals = F.transform(items, lambda x: strip_ws(F.when(x.startswith("{"), _dict_field(x, ["name", "tag", "value"]))
                                                   .otherwise(x)))
    return F.filter(vals, lambda x: x.isNotNull() & (x != ""))


def to_array(c) -> Column:
    """SCL-13: any list-like → array<string>; a scalar → one-element list;
    integral floats folded to ints; blanks dropped."""
    raw = _c(c)
    items = parse_py_list(raw)
    t = strip_ws(raw)

    def norm(x):
        s = strip_ws(x)
        d = s.try_cast("double")
        folded = F.when(s.rlike(r"^[+-]?[0-9]+\.0*$") & d.isNotNull(), _int_text(d))
        return F.coalesce(folded, s)
    listed = F.filter(F.transform(items, norm), lambda x: x.isNotNull() & (x != ""))
    scalar = F.when(t == "", F.array().cast("array<string>")).otherwise(F.array(t))
    return F.when(raw.isNull(), F.lit(None).cast("array<string>")).when(items.isNotNull(), listed).otherwise(scalar)


def survey_to_array(c, pattern: str = r"[,/]") -> Column:
    """SCL-15: split on ``,`` and ``/``, trim, drop blanks."""
    return F.filter(F.transform(F.split(_c(c), pattern), strip_ws), lambda x: x != "")


def trim_emoji(c) -> Column:
    """SCL-16: delete emoji / pictograph / joiner characters."""
    return F.regexp_replace(_c(c), EMOJI_CLASS, "")


def to_quantitative(c, mapping: dict[str, float]) -> Column:
    """SCL-17: label → number through a literal map (case-insensitive,
    trimmed); unknown ⇒ NULL.  ``mapping`` is driver-side config."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k.lower().strip()), F.lit(float(v)))])
    return F.try_element_at(m, F.lower(strip_ws(_c(c)))) if mapping else F.lit(None).cast("double")


def parse_python_list(c) -> Column:
    """SCL-18 / UDF-03: the warehouse helper ``parse_python_list(text) → text[]``.

    null / '' / ``[]`` ⇒ empty; JSON after quote rewriting; else strip the
    brackets and quotes and split on commas.
    """
    raw = _c(c)
    t = strip_ws(raw)
    js = F.from_json(_py_literal_to_json(raw), "array<string>", {"allowSingleQuotes": "true"})
    inner = F.regexp_replace(F.regexp_replace(t, r"^\[|\]$", ""), "[\"']", "")
    fallback = F.filter(F.transform(F.split(inner, ","), strip_ws), lambda x: x != "")
    empty = F.array().cast("array<string>")
    return (F.when(raw.isNull() | (t == "") | (t == "[]"), empty)
            .otherwise(F.coalesce(js, fallback)))


def parse_track_genres(c) -> Column:
    """SCL-19: literal list, scalar or ``a,b`` fallback → array<bigint>, non-ints skipped."""
    raw = _c(c)
    t = strip_ws(raw)
    items = F.coalesce(parse_py_list(raw),
                       F.when(t.rlike(r"^[^\[\](),]+$"), F.array(t)),
                       F.split(t, ","))
    ids = F.transform(items, lambda x: _int_text(strip_ws(x).try_cast("double")).cast("long"))
    return F.when(raw.isNull() | (t == ""), F.array().cast("array<bigint>")).otherwise(
        F.filter(ids, lambda x: x.isNotNull()))


def ensure_int(c) -> Column:
    """SCL-21: null-safe 64-bit key cast; bad text ⇒ NULL."""
    return F.when(_c(c).try_cast("double") == F.floor(_c(c).try_cast("double")),
                  _c(c).try_cast("double").cast("long"))


def json_list_text(c) -> Column:
    """SCL-22: ``json.dumps(list)`` style text: ``[21, 103]`` (space after comma)."""
    return F.concat(F.lit("["), F.array_join(_c(c).cast("array<string>"), ", "), F.lit("]"))


def json_dumps_list(c) -> Column:
    """SCL-13 sink form: Python ``json.dumps`` of a list -- numbers bare,
    strings quoted, ``", "`` between items."""
    def item(x):
        quoted = F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(x, r"\\", r"\\\\"), '"', '\\\\"'),
                          F.lit('"'))
        return F.when(x.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), x).otherwise(quoted)
    return F.concat(F.lit("["), F.array_join(F.transform(_c(c).cast("array<string>"), item), ", "), F.lit("]"))


def row_json(cols: Sequence[str], keep_nulls: bool = True) -> Column:
    """SCL-24: ``json_build_object`` / ``to_jsonb(row) - key``."""
    return F.to_json(F.struct(*[F.col(x) for x in cols]),
                     {"ignoreNullFields": "false" if keep_nulls else "true"})


def age_years(c, as_of=None) -> Column:
    """SCL-25: age in years (days / 365.25) against ``as_of`` (default now)."""
    ref = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    ts = _c(c).try_cast("timestamp")
    return (F.unix_timestamp(ref) - F.unix_timestamp(ts)) / 86400.0 / 365.25


def finite_or_null(c) -> Column:
    """SCL-26: inf / NaN → NULL."""
    x = _c(c).try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def to_numeric(c) -> Column:
    """SCL-28: ``to_numeric(errors='coerce')``."""
    return _c(c).try_cast("double")


# Token pattern of the text vectoriser (unicode ``\\w\\w+``).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokenize(c, stop_words: Sequence[str] | None = None) -> Column:
    """SCL-27: null → '', lower, unicode word tokens of length ≥ 2, optional stop words."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(_c(c), F.lit(""))), F.lit(TOKEN_PATTERN), 0)
    if stop_words:
        stop = list(stop_words)
        toks = F.filter(toks, lambda t: ~t.isin(stop))            # repeated tokens stay: their count is the term frequency
    return toks


#: Rules that read their input once: chained, they copy no sub-tree.
READS_ONCE = ("trimSpaces", "toLowerCase", "toUpperCase", "toString", "trimEmoji")


def apply_rules(c, rules: Sequence[str], registry) -> Column:
    """The rules one after the other; one that reads its input more than once gets it bound."""
    for i, rule in enumerate(rules):
        c = registry[rule](c) if i == 0 or rule in READS_ONCE else _let(c, registry[rule])
    return c


# UDF-01: registry of standardisers by rule name (open: users may add entries).
STANDARDISERS: dict[str, Callable[[Column], Column]] = {
    "trimSpaces": trim_spaces,
    "toLowerCase": to_lower,
    "toUpperCase": to_upper,
    "toString": to_string,
    "toInt": to_int,
    "toFloat": to_float,
    "toDouble": to_double,
    "toBoolean": to_boolean,
    "normalizeBoolean": to_boolean,
    "parseDate": parse_date,
    "normalizeDuration": normalize_duration,
    "extractGenreIds": lambda c: json_list_text(extract_genre_ids(c)),
    "normalizeTags": lambda c: F.to_json(normalize_tags(c)),
    "toArray": lambda c: json_dumps_list(to_array(c)),
}

# Survey tree variants.
SURVEY_STANDARDISERS: dict[str, Callable] = dict(STANDARDISERS)
SURVEY_STANDARDISERS.update({
    "toBoolean": survey_to_boolean,
    "normalizeBoolean": survey_to_boolean,
    "parseDate": survey_parse_date,
    "toArray": lambda c: json_dumps_list(survey_to_array(c)),
    "trimEmoji": trim_emoji,
})
