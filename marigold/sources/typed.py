"""Text columns to typed ones, with an account of every value that did not fit, and types read off the text itself.

A CSV reader that is given types turns what does not fit into nulls, or rounds it, and says nothing. Here a file is read
once as text; each declared column is converted beside a flag (fits, rounded, failed), flags become counts that the
write observes, and the rows behind them can go to a quarantine with their text as it was.

What counts as what, for a text without the blanks around it:

- blank or null is a missing value and no fault;
- ``rounded``: the value lies within the type but has more decimal digits than it, and is rounded half up (``10.505`` as
  a decimal with two digits, ``3.7`` as an integer; ``3.0`` is the integer 3, nothing is lost);
- ``failed``: the text is no value of the type, or beyond its range, and the value is null (``x``, ``1e20`` as a
  decimal(18,2), ``1e400`` as a double, a day in another format).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from marigold.functions.calendar import instant_of
from marigold.sources.sinks import Written, write_parquet
from marigold.sources.tables import read_csv

FITS, ROUNDED, FAILED = 0, 1, 2
BYTES = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}
_FLAG, _TEXT = "__flag_", "__text_"
_BARE, _VALUE, _ROW = "__bare_", "__value_", "__row"


def _lost_digits(text: Column, value: Column, scale: int) -> Column:
    """Whether a number has decimal digits beyond ``scale`` that are not zero. Exponents are compared as doubles."""
    point = F.instr(text, ".")
    long = (point > 0) & (F.length(text) - point > scale)
    digits = F.length(F.rtrim(F.substr(text, point + 1), F.lit("0"))) > scale
    powers = F.contains(F.lower(text), F.lit("e"))
    return F.when(powers, value.cast("double") != text.try_cast("double")).otherwise(long & digits)


def _scale(kind: T.DataType) -> int:
    return kind.scale if isinstance(kind, T.DecimalType) else 0


def _bare(text: Column) -> Column:
    return F.trim(text, F.lit(" \t\r\n"))


def _candidate(bare: Column, kind: T.DataType, fmt: str | None, zone: str) -> Column:
    """What a text without blanks around it is read as; ``_value`` decides what of it counts."""
    if isinstance(kind, T.DateType) and fmt:
        return F.try_to_date(bare, fmt)
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(bare, F.lit(fmt)) if fmt else instant_of(bare, zone)
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return bare.try_cast(T.DecimalType(38, _scale(kind)))
    return bare.try_cast(kind)


def _value(bare: Column, candidate: Column, kind: T.DataType) -> Column:
    value = candidate
    # Compared first: a cast beyond the range costs an exception, also where it is tried only.
    if isinstance(kind, T.IntegralType):
        most = 1 << (8 * BYTES[type(kind)] - 1)
        value = F.when(candidate.between(F.lit(Decimal(-most)), F.lit(Decimal(most - 1))), candidate.cast(kind))
    elif isinstance(kind, T.DecimalType):
        if kind.precision < 38:
            value = F.when(F.abs(candidate) < F.lit(Decimal(10 ** (kind.precision - kind.scale))), candidate.cast(kind))
    elif isinstance(kind, T.FractionalType):
        # Java reads "1d" and "1f" as numbers; and a number beyond the range as infinity.
        suffix = reduce(or_, [F.endswith(bare, F.lit(c)) for c in "dDfF"]) & bare.rlike("[0-9.][dDfF]$")
        beyond = F.abs(candidate) == float("inf")
        value = F.when(~suffix & ~(beyond & bare.rlike("[0-9]")), candidate)
    return F.when(bare != "", value)


def _flag(bare: Column, value: Column, kind: T.DataType) -> Column:
    flag = F.when(value.isNull(), FAILED)
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        flag = flag.when(_lost_digits(bare, value, _scale(kind)), ROUNDED)
    return F.when(bare != "", flag.otherwise(FITS)).otherwise(FITS)


def _steps(kind: T.DataType, fmt: str | None, zone: str) -> tuple[Callable[[Column], Column], Callable[[Column, Column], Column], Callable[[Column, Column], Column]]:
    """What a bare text is read as, its value, and whether it fits, was rounded or failed."""
    return (lambda bare: _candidate(bare, kind, fmt, zone)), (lambda bare, read: _value(bare, read, kind)), (lambda bare, value: _flag(bare, value, kind))


@dataclass(frozen=True)
class Typed:
    """Typed rows with two hidden columns for each checked one: its flag, and its text as it was read."""

    rows: DataFrame
    checked: tuple[str, ...]

    @property
    def hidden(self) -> list[str]:
        return [f"{mark}{c}" for c in self.checked for mark in (_FLAG, _TEXT)]

    @property
    def visible(self) -> DataFrame:
        return self.rows.drop(*self.hidden)

    def then(self, plan: Callable[[DataFrame], DataFrame]) -> Typed:
        """The rows after a plan that goes row by row and carries unknown columns along."""
        return Typed(plan(self.rows), self.checked)

    def checking(self, column: str, plan: Callable[[DataFrame], DataFrame], result: str | None = None) -> Typed:
        """The rows after a plan that parses a text ``column`` (to ``result``): text that becomes null is a fault."""
        text, result = f"{_TEXT}{column}", result or column
        parsed = plan(self.rows.withColumn(text, F.col(f"`{column}`").cast("string")))
        failed = (F.trim(F.col(f"`{text}`")) != "") & F.col(f"`{result}`").isNull()
        return Typed(parsed.withColumn(f"{_FLAG}{column}", F.when(failed, FAILED).otherwise(FITS)), (*self.checked, column))

    def conditions(self) -> dict[str, Column]:
        """Per checked column: which rows failed and which were rounded."""
        return {f"{name} {c}": F.col(f"`{_FLAG}{c}`") == flag for c in self.checked for name, flag in (("failed", FAILED), ("rounded", ROUNDED))}

    def counts(self) -> dict[str, Column]:
        """The conditions as aggregates."""
        return {name: F.count_if(condition) for name, condition in self.conditions().items()}

    def faults(self, among: Sequence[str] | None = None) -> DataFrame:
        """Rows with a fault: the typed columns, and ``faults``, an array of (column, text, fault).

        ``among`` names the columns that have any, where that is known. If they are few, rows are filtered before
        the other columns are converted.
        """
        judged = self.checked if among is None else [c for c in self.checked if c in among]
        kind = "array<struct<column:string,text:string,fault:string>>"
        entries = []
        for c in self.checked:
            flag = F.col(f"`{_FLAG}{c}`")
            told = F.struct(F.lit(c).alias("column"), F.col(f"`{_TEXT}{c}`").alias("text"), F.when(flag == FAILED, "failed").otherwise("rounded").alias("fault"))
            entries.append(F.when(flag > FITS, told))
        found = F.filter(F.array(*entries).cast(kind), lambda entry: entry.isNotNull())
        bad = reduce(or_, [F.col(f"`{_FLAG}{c}`") > FITS for c in judged], F.lit(False))
        if 2 * len(judged) <= len(self.checked):
            return self.rows.filter(bad).withColumn("faults", found).drop(*self.hidden)
        # A number of the row keeps the filter above the conversion: pushed below, it would convert every text a second time.
        numbered = self.rows.withColumn(_ROW, F.monotonically_increasing_id())
        return numbered.filter(bad & (F.col(_ROW) >= 0)).withColumn("faults", found).drop(_ROW, *self.hidden)


def typed(
    raw: DataFrame, schema: T.StructType | Mapping[str, T.DataType], strict: bool = False, formats: Mapping[str, str] | None = None, zone: str = "UTC"
) -> Typed:
    """Convert the columns that ``schema`` names; others stay text. ``strict`` makes the first fault an error.

    Columns of one type go as one array through each step (text without blanks, value, flag). What a later step uses more
    than once is so computed once, and the generated code does not grow with the columns: beyond 8,000 bytes a method is
    never compiled.
    """
    declared = {f.name: f.dataType for f in schema} if isinstance(schema, T.StructType) else dict(schema)
    kinds = {name: declared[name] for name in raw.columns if not isinstance(declared.get(name, T.StringType()), T.StringType)}
    groups: dict[tuple, list[str]] = {}
    for name, kind in kinds.items():
        groups.setdefault((kind, (formats or {}).get(name)), []).append(name)
    texts, rows = {name: F.col(f"`{name}`") for name in raw.columns}, raw
    marks = [(F.col(f"{_BARE}{i}"), F.col(f"{_VALUE}{i}"), F.col(f"{_FLAG}{i}")) for i in range(len(groups))]
    steps = [_steps(kind, fmt, zone) for kind, fmt in groups]
    rows = rows.withColumns({f"{_BARE}{i}": F.transform(F.array(*[texts[c].cast("string") for c in names]), _bare) for i, names in enumerate(groups.values())})
    rows = rows.withColumns({f"{_VALUE}{i}": F.zip_with(marks[i][0], F.transform(marks[i][0], read), value) for i, (read, value, _) in enumerate(steps)})
    rows = rows.withColumns({f"{_FLAG}{i}": F.zip_with(marks[i][0], marks[i][1], flag) for i, (_, _, flag) in enumerate(steps)})
    found = {name: (marks[i][1][at], marks[i][2][at]) for i, names in enumerate(groups.values()) for at, name in enumerate(names)}
    shown, hidden = [], []
    for name, text in texts.items():
        if name not in found:
            shown.append(text)
            continue
        value, flag = found[name]
        if strict:
            told = F.raise_error(F.concat(F.lit(f"{name}: no {kinds[name].simpleString()}: "), text))
            value = F.when(flag > FITS, told.cast(kinds[name])).otherwise(value)
        shown.append(value.alias(name))
        hidden += [flag.alias(f"{_FLAG}{name}"), text.alias(f"{_TEXT}{name}")]
    return Typed(rows.select(*shown, *hidden), tuple(kinds))


def read_typed_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, strict: bool = False, formats: Mapping[str, str] | None = None, **options: str) -> Typed:
    """CSV files by the names in their header, one scan as text, converted as ``typed`` does."""
    header = read_csv(spark, path, **options).columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return typed(read_csv(spark, path, text, **options), schema, strict, formats)


def fault_account(metrics: Mapping[str, int]) -> dict[str, dict[str, int]]:
    """Observed counts as ``{column: {"failed": n, "rounded": m}}``, columns and faults without a case left out."""
    account: dict[str, dict[str, int]] = {}
    for name, n in metrics.items():
        fault, _, column = name.partition(" ")
        if fault in ("failed", "rounded") and column and n:
            account.setdefault(column, {})[fault] = n
    return account


@dataclass(frozen=True)
class TypedWrite:
    """What a typed write did: the table, the account of faults, and the quarantine if there was any fault."""

    written: Written
    faults: dict[str, dict[str, int]] = field(default_factory=dict)
    quarantine: Written | None = None


def write_typed(scan: Typed, path: str, quarantine: str | None = None, partition_by: Sequence[str] = (), metrics: Mapping[str, Column] | None = None) -> TypedWrite:
    """Write the typed rows and count faults in the same action.

    Rows with faults are written to ``quarantine``, their text beside the typed values. That is a second pass over the
    text, which only runs if the first one met a fault.
    """
    written = write_parquet(scan.rows, path, partition_by, metrics={**scan.counts(), **(metrics or {})}, hidden=scan.hidden)
    account = fault_account(written.metrics)
    kept = write_parquet(scan.faults(account), quarantine) if account and quarantine else None
    return TypedWrite(written, account, kept)


# --- types read off the text -------------------------------------------------------------------------

# What a text can be at the least, as bits, so that the kinds of many values are one bit_or.
INT, LONG, DECIMAL, DOUBLE, DAY, TIME, FLAG, TEXT = (1 << i for i in range(8))
NUMBERS = INT | LONG | DECIMAL | DOUBLE


def least_kind(text: Column) -> Column:
    """The bit of the narrowest kind that a text is a value of; null for a missing value.

    A number with zeros before it (``007``) is text: as a number it would lose them.
    """
    t = F.trim(text)
    lead = F.ascii(t)
    numeric = lead.between(ord("+"), ord("9")) | lead.isin(ord("N"), ord("I"))  # how anything but flags and text begins
    number = ~F.contains(t, F.lit(".")) & t.rlike(r"^[+-]?(0|[1-9]\d*)$")
    long = t.try_cast("bigint")  # no cast is tried that will fail on common values: that costs an exception each
    digit = (F.length(t) > 4) | t.rlike(r"\d")  # a sign, a point and a line end are no number
    short = (F.length(t) <= 38) | (F.length(F.regexp_replace(t, r"[+\-.]", "")) <= 38)
    decimal = F.when(short, DECIMAL).otherwise(DOUBLE)
    return (
        F.when(t.isNull() | (t == ""), F.lit(None))
        .when(~numeric, F.when(F.lower(t).isin("true", "false"), FLAG).otherwise(TEXT))
        .when(number, F.when(F.length(t) <= 9, INT).when(long.between(-(1 << 31), (1 << 31) - 1), INT).when(long.isNotNull(), LONG).otherwise(decimal))
        .when(t.rlike(r"^[+-]?(0|[1-9]\d*)?(\.\d*)?$") & digit, decimal)
        .when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)[eE][+-]?\d+$|^[+-]?(NaN|Infinity|Inf)$"), DOUBLE)
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}$") & t.try_cast("date").isNotNull(), DAY)
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}") & t.try_cast("timestamp").isNotNull(), TIME)
        .otherwise(TEXT)
    )


def _digits(t: Column, kind: Column) -> tuple[Column, Column]:
    """Digits before and behind the point of a trimmed text that is a plain number; null for others."""
    plain = kind.isin(INT, LONG, DECIMAL)
    whole = F.length(F.ltrim(F.substring_index(t, ".", 1), F.lit("+-0")))
    behind = F.when(F.instr(t, ".") > 0, F.length(F.substring_index(t, ".", -1))).otherwise(0)
    return F.when(plain, whole), F.when(plain, behind)


def lattice_state(columns: list[str]) -> list[Column]:
    """Mergeable aggregates per column: the kinds met, and the most digits before and behind the point."""
    state = []
    for i, name in enumerate(columns):
        text = F.col(f"`{name}`")
        kind = least_kind(text)
        whole, behind = _digits(F.trim(text), kind)
        state += [F.bit_or(kind).alias(f"kinds{i}"), F.max(whole).alias(f"whole{i}"), F.max(behind).alias(f"behind{i}")]
    return state


def joined_kind(kinds: int | None, whole: int | None, behind: int | None, decimals: bool = False) -> T.DataType:
    """The least type that takes all kinds met: null < int < bigint < decimal < double < text; days < times < text."""
    met = kinds or 0
    if not met or met & TEXT:
        return T.StringType()
    if not met & ~NUMBERS:
        if met & DOUBLE or (met & DECIMAL and not decimals):
            return T.DoubleType()
        if met & DECIMAL:
            digits = max(1, whole or 0) + (behind or 0)
            return T.DecimalType(max(digits, 1), behind or 0) if digits <= 38 else T.DoubleType()
        return T.LongType() if met & LONG else T.IntegerType()
    if not met & ~(DAY | TIME):
        return T.TimestampType() if met & TIME else T.DateType()
    return T.BooleanType() if met == FLAG else T.StringType()


def _schema(columns: list[str], state: Mapping[str, int], decimals: bool) -> T.StructType:
    kinds = [joined_kind(state.get(f"kinds{i}"), state.get(f"whole{i}"), state.get(f"behind{i}"), decimals) for i in range(len(columns))]
    return T.StructType([T.StructField(name, kind) for name, kind in zip(columns, kinds)])


def lattice_rows(raw: DataFrame) -> DataFrame:
    """The lattice state with a row per column. Values are laid out one to a row: generated code is that of one column."""
    values = raw.select(F.posexplode(F.array(*[F.col(f"`{name}`").cast("string") for name in raw.columns])).alias("at", "text"))
    kinds = values.select("at", F.trim("text").alias("text"), least_kind(F.col("text")).alias("kind"))
    whole, behind = _digits(F.col("text"), F.col("kind"))
    return kinds.groupBy("at").agg(F.bit_or("kind").alias("kinds"), F.max(whole).alias("whole"), F.max(behind).alias("behind"))


def infer_schema(raw: DataFrame, decimals: bool = False) -> T.StructType:
    """Types of a table of text columns: one scan, a partial state per task and column, one row per column to the driver.

    ``decimals`` gives numbers with a point a decimal with the digits met; otherwise they are doubles.
    """
    found = lattice_rows(raw).collect()
    return _schema(raw.columns, {f"{name}{row['at']}": row[name] for row in found for name in ("kinds", "whole", "behind")}, decimals)


def infer_on_the_way(raw: DataFrame, write: Callable[[DataFrame], DataFrame], decimals: bool = False) -> tuple[DataFrame, T.StructType]:
    """Pass the text through ``write`` (which stages it as a table) and infer its types in the same action.

    The CSV is parsed once; conversion then reads the staged columns.
    """
    seen = Observation()
    staged = write(raw.observe(seen, *lattice_state(raw.columns)))
    return staged, _schema(raw.columns, seen.get, decimals)
