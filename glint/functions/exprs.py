"""Column expressions shared by the operators.

Everything here returns a `pyspark.sql.Column` built from Spark's own
functions, so it stays inside whole-stage codegen; there is no Python UDF.
Timestamps are TIMESTAMP_NTZ and durations BIGINT microseconds; the
conversions below use `timestampdiff` / `timestampadd`, which do not
depend on the session time zone.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PID_SEGMENT, STUDIES

ColumnOrName = Column | str

_EPOCH = "1970-01-01 00:00:00"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ntz() -> Column:
    return F.lit(_EPOCH).cast("timestamp_ntz")


# --- F8, F9, F11, F12: clocks -------------------------------------------------


def micros(ts: ColumnOrName) -> Column:
    """Microseconds since the Unix epoch of a TIMESTAMP_NTZ (wall clock)."""
    return F.timestamp_diff("MICROSECOND", epoch_ntz(), _col(ts))


def from_micros(us: ColumnOrName) -> Column:
    """TIMESTAMP_NTZ from epoch microseconds."""
    return F.timestamp_add("MICROSECOND", _col(us).cast("bigint"), epoch_ntz())


def from_millis(ms: ColumnOrName) -> Column:
    """TIMESTAMP_NTZ from epoch milliseconds; fractions are cut."""
    return from_micros(_col(ms).cast("bigint") * F.lit(1000))


def diff_us(end: ColumnOrName, start: ColumnOrName) -> Column:
    """`end - start` in microseconds."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end))


def diff_ms(end: ColumnOrName, start: ColumnOrName) -> Column:
    """Whole milliseconds of `end - start`, cut toward zero."""
    return F.timestamp_diff("MILLISECOND", _col(start), _col(end))


def add_us(ts: ColumnOrName, us: ColumnOrName) -> Column:
    """Timestamp shifted by a duration in microseconds."""
    return F.timestamp_add("MICROSECOND", _col(us).cast("bigint"), _col(ts))


def ms_to_us(ms: ColumnOrName) -> Column:
    """A float millisecond count cut to whole ms, as microseconds."""
    return _col(ms).cast("bigint") * F.lit(1000)


# --- F1-F7, F14, F22: text ------------------------------------------------------


def split_part(c: ColumnOrName, sep: str, index: int) -> Column:
    """Item `index` of `c` split on a literal separator; null when short (F1)."""
    return F.get(F.split(_col(c), _escape(sep)), index)


def _escape(sep: str) -> str:
    return "".join("\\" + ch if ch in ".[]{}()\\*+?^$|" else ch for ch in sep)


def strip_affixes(c: ColumnOrName, prefix: str, suffix: str) -> Column:
    """Remove one leading `prefix` and one trailing `suffix`."""
    return F.regexp_replace(_col(c), f"^{_escape(prefix)}|{_escape(suffix)}$", "")


def pid_from_name(path: ColumnOrName, strict: bool = True) -> Column:
    """Participant number (S2) from the last path segment that starts with
    `P_` and digits, however many; folders above it, such as `/EXP_2018/`,
    don't count."""
    names = F.filter(F.split(_col(path), "/"), lambda s: s.rlike(PID_SEGMENT))
    name = F.when(F.size(names) > 0, F.element_at(names, -1))
    pid = F.regexp_extract(name, PID_SEGMENT, 1).try_cast("int")
    if strict:
        return F.when(pid.isNotNull(), pid).otherwise(
            F.raise_error(F.concat(F.lit("no participant in path: "), F.coalesce(_col(path), F.lit(""))))
        )
    return pid


def hms_to_us(c: ColumnOrName) -> Column:
    """`H:M:S` text to microseconds."""
    parts = F.split(_col(c), ":")
    h, m, s = (F.get(parts, i).cast("bigint") for i in range(3))
    return (h * 3600 + m * 60 + s) * F.lit(1_000_000)


def minute_of_day(c: ColumnOrName) -> Column:
    """`HH:mm` text to minutes after midnight (F7, time of day)."""
    t = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), _col(c)), F.lit("yyyy-MM-dd HH:mm"))
    return F.hour(t) * 60 + F.minute(t)


def padded(fmt: str, *cols: ColumnOrName) -> Column:
    """`format_string` over columns, e.g. `P_%02d`."""
    return F.format_string(fmt, *[_col(c) for c in cols])


# --- F13: duration text ------------------------------------------------------------

# Units of the duration language in microseconds.
_UNIT_US = {
    "w": 7 * 86_400_000_000,
    "d": 86_400_000_000,
    "h": 3_600_000_000,
    "m": 60_000_000,
    "s": 1_000_000,
    "ms": 1_000,
    "us": 1,
}
def duration_text_us(c: ColumnOrName, strict: bool = False) -> Column:
    """Parse text such as `1w2d3h4m5s6ms7us` or `2m 34s 29ms` to microseconds.

    Units may come in any order, numbers may have decimals, white space and
    case are ignored, a repeated unit keeps its last value. Text that is empty
    or not fully made of `<number><unit>` tokens gives null, or an error when
    `strict`."""
    text = F.lower(F.regexp_replace(_col(c), r"\s", ""))
    # a token ends where a letter is followed by a digit
    tokens = F.split(text, "(?<=[a-z])(?=[0-9.])")
    unit = lambda t: F.ltrim(t, F.lit("0123456789."))
    number = lambda t: F.rtrim(t, F.lit("".join(sorted(set("".join(_UNIT_US))))))

    def good(t):
        n = number(t)
        return (
            unit(t).isin(list(_UNIT_US)) & F.concat(n, unit(t)).eqNullSafe(t)
            & ~n.startswith(".") & ~n.endswith(".") & n.try_cast("double").isNotNull()
        )

    valid = text.isNotNull() & F.forall(tokens, good)
    total = F.lit(0.0)
    of = lambda name: F.filter(tokens, lambda t: unit(t) == name)
    for name, factor in _UNIT_US.items():
        of_unit = of(name)
        value = F.when(F.size(of_unit) > 0, number(F.element_at(of_unit, -1)).try_cast("double"))
        total = total + F.coalesce(value, F.lit(0.0)) * F.lit(float(factor))
    parsed = F.when(valid, F.round(total).cast("bigint"))
    if strict:
        return F.when(valid, parsed).otherwise(
            F.raise_error(F.concat(F.lit("not a duration: "), F.coalesce(_col(c), F.lit(""))))
        )
    return parsed


# --- F15-F21: values ---------------------------------------------------------------


def to_struct(arr: ColumnOrName, names: Sequence[str], cast: str | None = None) -> Column:
    """Fixed-width array to a named struct; null array gives null."""
    a = _col(arr)
    fields = []
    for i, n in enumerate(names):
        v = F.get(a, i)
        fields.append((v.cast(cast) if cast else v).alias(n))
    return F.when(a.isNotNull(), F.struct(*fields))


def value_map(c: ColumnOrName, mapping: Mapping[str, object], default: object = ...) -> Column:
    """Replace values by a literal map. Without `default` unmatched values pass
    through unchanged (null stays null); with it they take the default (P15)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    hit = F.element_at(m, _col(c))
    if default is ...:
        return F.coalesce(hit, _col(c))
    return F.coalesce(hit, F.lit(default))


def rgb(color: Iterable[int]) -> Column:
    """Colour literal as ARRAY<INT> of three channels."""
    return F.array(*[F.lit(int(v)) for v in color])


def study_ord(c: ColumnOrName) -> Column:
    """Index of a study in the declared order; null for unknown."""
    pos = F.array_position(F.array(*[F.lit(s) for s in STUDIES]), _col(c))
    return F.when(pos > 0, (pos - 1).cast("int"))


def checked(c: ColumnOrName, allowed: Sequence[str], what: str, strict: bool = True) -> Column:
    """Closed value set: in strict mode a value outside it raises, like an
    enum cast; otherwise it becomes null. Null passes (D19, P17)."""
    col = _col(c)
    ok = col.isNull() | col.isin(list(allowed))
    if strict:
        return F.when(ok, col).otherwise(
            F.raise_error(F.concat(F.lit(f"value outside {what}: "), col.cast("string")))
        )
    return F.when(ok, col)
