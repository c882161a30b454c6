"""Instrument metadata: header matching, category levels, plan flags, cleaning, checks.

Everything here is narrow (row-local expressions, no shuffle) except the
counts of ``validate_metadata``, which is one aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundspark.functions.dates import parse_day_first
from fundspark.functions.numeric import parse_double
from fundspark.functions.text import blank_to_null, clean_header, contains_any, null_tokens, strip

# ---------------------------------------------------------------------------
# Fixed values (must equal the source's for the same results).
# Raw header -> column, in this order; the first entry that matches wins.
HEADER_MAP = [
    ("AMC", "amc_name"),
    ("Code", "scheme_code"),
    ("Scheme Name", "scheme_name"),
    ("Scheme Type", "scheme_type"),
    ("Scheme Category", "scheme_category"),
    ("Scheme NAV Name", "scheme_nav_name"),
    ("Scheme Minimum Amount", "minimum_amount"),
    ("Launch Date", "launch_date"),
    ("Closure Date", "closure_date"),
    ("ISIN Div Payout/ ISIN Growth", "isin_growth"),
    ("ISIN Div Reinvestment", "isin_dividend"),
]
# Plan-name substrings (matched on the lower-cased NAV name).
DIRECT_LITERALS = ["direct", "dir ", " dir", "-dir-", "-direct-", "(dir)", "(direct)", "drct"]
GROWTH_LITERALS = ["growth", "grwth", "gr ", " gr", "gr)", "(gr)", "growt", "accum", "accumulation"]
NON_GROWTH_LITERALS = [
    "idcw", "dividend", "income", "monthly", "quarterly", "weekly", "daily",
    "annual", "payout", "distribution", "div ", " div", "div)", "(div)",
]
# Level-1 category: first keyword found in the text before the separator.
LEVEL1_RULES = [
    ("equity", "Equity Scheme"),
    ("debt", "Debt Scheme"),
    ("hybrid", "Hybrid Scheme"),
    ("other", "Other Scheme"),
]
LEVEL1_DEFAULT = "Others"
LEVEL2_EMPTY_TOKENS = ["", "error", "null", "na"]
CATEGORY_SEPARATOR = " - "
REQUIRED_COLUMNS = ["scheme_code", "scheme_name", "amc_name"]
TEXT_COLUMNS = ["amc_name", "scheme_name", "scheme_type", "scheme_category", "scheme_nav_name"]
# ---------------------------------------------------------------------------


def header_mapping(columns: Sequence[str], mapping=HEADER_MAP) -> dict[str, str]:
    """Raw header -> column name by case-insensitive substring match in either direction.

    Raises when two raw headers would get the same name.
    """
    out: dict[str, str] = {}
    for old in columns:
        lo = old.lower()
        for expected, new in mapping:
            e = expected.lower()
            if e in lo or lo in e:
                out[old] = new
                break
    targets = list(out.values())
    clash = sorted({t for t in targets if targets.count(t) > 1})
    if clash:
        raise ValueError(f"several headers map to {clash}: {[k for k, v in out.items() if v in clash]}")
    return out


def rename_by_substring(df: DataFrame, mapping=HEADER_MAP) -> DataFrame:
    return df.withColumnsRenamed(header_mapping(df.columns, mapping))


def normalise_headers(df: DataFrame) -> DataFrame:
    """Trim, lower-case, blanks and dots to '_', parentheses dropped."""
    return df.toDF(*[clean_header(c) for c in df.columns])


def category_level_columns(
    col: str = "scheme_category",
    rules: Sequence[tuple[str, str]] = LEVEL1_RULES,
    default: str = LEVEL1_DEFAULT,
    sep: str = CATEGORY_SEPARATOR,
    empty_tokens: Iterable[str] = LEVEL2_EMPTY_TOKENS,
) -> dict[str, Column]:
    """The two category-level expressions (see ``category_levels``)."""
    cat = F.col(col)
    text = F.coalesce(cat, F.lit(""))
    has_sep = F.contains(text, F.lit(sep))
    parts = F.split(text, "\\Q" + sep + "\\E", 2)
    head = F.lower(strip(F.element_at(parts, 1)))
    tail = strip(F.try_element_at(parts, F.lit(2)))
    level1 = F.lit(default)
    for keyword, label in reversed(list(rules)):
        level1 = F.when(F.contains(head, F.lit(keyword)), F.lit(label)).otherwise(level1)
    level2 = F.when(has_sep, F.coalesce(null_tokens(tail, empty_tokens), level1)).otherwise(F.coalesce(cat, F.lit(default)))
    return {"scheme_category_level1": level1, "scheme_category_level2": level2}


def category_levels(
    df: DataFrame,
    col: str = "scheme_category",
    rules: Sequence[tuple[str, str]] = LEVEL1_RULES,
    default: str = LEVEL1_DEFAULT,
    sep: str = CATEGORY_SEPARATOR,
    empty_tokens: Iterable[str] = LEVEL2_EMPTY_TOKENS,
) -> DataFrame:
    """Add ``scheme_category_level1`` and ``scheme_category_level2``.

    Level 1 maps the text before the first separator by keyword (first
    rule wins, else ``default``). Level 2 is the stripped text after the
    separator, falling back to level 1 when empty or a null token; without
    a separator it is the whole category (NULL -> ``default``).
    """
    return df.withColumns(category_level_columns(col, rules, default, sep, empty_tokens))


def plan_flag_columns(
    col: str = "scheme_nav_name",
    direct: Sequence[str] = DIRECT_LITERALS,
    growth: Sequence[str] = GROWTH_LITERALS,
    non_growth: Sequence[str] = NON_GROWTH_LITERALS,
) -> dict[str, Column]:
    """The two plan-flag expressions (see ``plan_flags``)."""
    name = F.lower(F.coalesce(F.col(col), F.lit("")))
    return {
        "is_direct": contains_any(name, direct),
        "is_growth_plan": contains_any(name, growth) & ~contains_any(name, non_growth),
    }


def plan_flags(
    df: DataFrame,
    col: str = "scheme_nav_name",
    direct: Sequence[str] = DIRECT_LITERALS,
    growth: Sequence[str] = GROWTH_LITERALS,
    non_growth: Sequence[str] = NON_GROWTH_LITERALS,
) -> DataFrame:
    """Add ``is_direct`` (any direct literal) and ``is_growth_plan`` (a growth literal and no non-growth one)."""
    return df.withColumns(plan_flag_columns(col, direct, growth, non_growth))


def clean_scheme_metadata(
    raw: DataFrame,
    mapping=HEADER_MAP,
    level1_rules: Sequence[tuple[str, str]] = LEVEL1_RULES,
    direct: Sequence[str] = DIRECT_LITERALS,
    growth: Sequence[str] = GROWTH_LITERALS,
    non_growth: Sequence[str] = NON_GROWTH_LITERALS,
) -> DataFrame:
    """Raw metadata (all strings) -> typed, categorised, flagged table.

    Headers are matched by substring; text is stripped with '' -> NULL
    (the code is stripped only); dates are day-first in any of four
    formats; the amount is a plain number or NULL; missing columns become
    NULL columns of the right type.
    """
    df = rename_by_substring(raw, mapping)
    present = set(df.columns)

    def text(c):
        return F.col(c).cast("string") if c in present else F.lit(None).cast("string")

    cols = {
        "scheme_code": strip(text("scheme_code")),
        **{c: blank_to_null(text(c)) for c in TEXT_COLUMNS},
        "launch_date": parse_day_first(text("launch_date")),
        "closure_date": parse_day_first(text("closure_date")),
        "minimum_amount": parse_double(text("minimum_amount")),
    }
    df = df.withColumns(cols)
    # The source also drops all-NULL rows; the two flags are never NULL, so
    # no row can be all-NULL and that step (a filter repeating every
    # expression above) is left out.
    return df.withColumns(
        {
            **category_level_columns(rules=level1_rules),
            **plan_flag_columns(direct=direct, growth=growth, non_growth=non_growth),
        }
    )


def validate_metadata(df: DataFrame, key: str = "scheme_code", amc: str = "amc_name") -> DataFrame:
    """Counts and a verdict in one row: rows, distinct codes and AMCs, NULL and repeated codes.

    ``valid`` is false when the table is empty or a required column is missing.
    Repeated codes = rows after the first per code, NULL counted as a code.
    """
    missing = [c for c in REQUIRED_COLUMNS if c not in df.columns]
    k = F.col(key) if key in df.columns else F.lit(None).cast("string")
    a = F.col(amc) if amc in df.columns else F.lit(None).cast("string")
    out = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(k).alias("distinct_codes"),
        F.countDistinct(a).alias("distinct_amcs"),
        F.count_if(k.isNull()).alias("null_codes"),
    )
    distinct_with_null = F.col("distinct_codes") + F.when(F.col("null_codes") > 0, 1).otherwise(0)
    return out.select(
        "*",
        (F.col("rows") - distinct_with_null).alias("duplicate_codes"),
        F.lit(",".join(missing)).alias("missing_columns"),
        ((F.col("rows") > 0) & F.lit(not missing)).alias("valid"),
    )
