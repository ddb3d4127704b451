"""Scalar column functions (JVM-side, codegen friendly).

Each helper returns a ``Column``; none of them calls Python per row.
Where the semantics of pandas/NumPy differ from SQL (null handling in
``clip``, ``ln(0)``, half-even rounding) the helper spells out the rule.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "hash_int", "hash_int_sql", "clip_lower", "log_target", "inverse_log",
    "log1p_target", "expm1_target", "coerce_numeric", "safe_name",
    "format_money", "input_hash", "json_text", "direction_arrow", "fmt_fixed", "rnd",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hash_int(key, salt: str) -> Column:
    """Deterministic pseudo-random integer in [0, 2^32): first 8 hex digits of
    md5('<key>:<salt>').  The same value comes out of ``hash_int_sql`` in DuckDB,
    so seeded choices (folds, permutations, fixtures) can be checked in SQL."""
    s = F.concat(_c(key).cast("string"), F.lit(":" + salt))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def hash_int_sql(key_sql: str, salt: str) -> str:
    """DuckDB twin of :func:`hash_int`."""
    return f"('0x' || substr(md5(CAST({key_sql} AS VARCHAR) || ':{salt}'), 1, 8))::BIGINT"


def clip_lower(x, lo) -> Column:
    """pandas ``clip(lower=lo)``: null stays null (``greatest`` would give lo)."""
    x = _c(x)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(lo)))


def log_target(x) -> Column:
    """Natural log of a price; non-positive prices give null instead of -inf."""
    x = _c(x)
    return F.when(x > 0, F.log(x))


def inverse_log(x, floor: float = 1.0) -> Column:
    """exp of a log prediction floored at ``floor`` (null stays null)."""
    return clip_lower(F.exp(_c(x)), floor)


def log1p_target(x) -> Column:
    x = _c(x)
    return F.when(x > -1, F.log1p(x))


def expm1_target(x) -> Column:
    return F.expm1(_c(x))


def coerce_numeric(x) -> Column:
    """``pd.to_numeric(errors='coerce')``: text that is not a number → null.
    ANSI mode is on in Spark 4, so a plain cast would raise."""
    t = F.trim(_c(x).cast("string"))
    # a cast would take Java's type suffixes ('1d', '2f') for numbers
    return F.when(~t.rlike(r"(?i)^[+-]?[0-9.]+(e[+-]?[0-9]+)?[df]$"), t.try_cast("double"))


def safe_name(x) -> Column:
    """Model name → file-name stem: lower case, blanks → underscores."""
    return F.replace(F.lower(_c(x)), F.lit(" "), F.lit("_"))


def format_money(amount, jurisdiction) -> Column:
    """Currency text with thousands separators and no decimals; rupee for
    jurisdictions whose lower-cased name starts with 'ind', else euro."""
    sym = F.when(F.startswith(F.lower(_c(jurisdiction)), F.lit("ind")), F.lit("₹")) \
        .otherwise(F.lit("€"))
    return F.concat(sym, F.lit(" "), F.format_number(_c(amount), 0))


_PLAIN_JSON = r"[\x20\x21\x23-\x5B\x5D-\x7E]+"
_SHORT_JSON = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def json_text(x) -> Column:
    """Text as a JSON string in the layout of Python's ``json.dumps``: quotes,
    backslashes and controls escaped, all but ASCII as UTF-16 ``\\uXXXX``. Null → ``null``."""
    t = _c(x).cast("string")
    short = F.create_map(*[F.lit(v) for pair in _SHORT_JSON.items() for v in pair])

    def piece(p: Column) -> Column:
        units = F.regexp_replace(F.lower(F.hex(F.encode(p, "UTF-16BE"))), "(.{4})", r"\\u$1")
        return F.when(p.rlike(_PLAIN_JSON), p).otherwise(F.coalesce(short[p], units))

    escaped = F.array_join(F.transform(F.regexp_extract_all(t, F.lit(f"(?s){_PLAIN_JSON}|."), F.lit(0)), piece), "")
    body = F.when(t.rlike(f"^(?:{_PLAIN_JSON})?\\z"), t).otherwise(escaped)
    return F.coalesce(F.concat(F.lit('"'), body, F.lit('"')), F.lit("null"))


def input_hash(fields: dict[str, Column]) -> Column:
    """16 hex chars of SHA-256 over the key-sorted JSON text of a record, in
    the layout of Python's ``json.dumps(sort_keys=True)`` (", " and ": ").
    Values are rendered as JSON numbers or quoted strings; nulls as null."""
    parts = []
    for name in sorted(fields):
        v = fields[name]
        parts.append(F.concat(F.lit(f'"{name}": '), v))
    body = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    return F.substring(F.sha2(body, 256), 1, 16)


def direction_arrow(x) -> Column:
    return F.when(_c(x) >= 0, F.lit("↑")).otherwise(F.lit("↓"))


def fmt_fixed(x, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", _c(x))


def rnd(x, digits: int = 6) -> Column:
    return F.round(_c(x).cast("double"), digits)
