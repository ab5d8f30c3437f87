"""salary range from free text, as one native expression.

The original behaviour is the default, quirks included (dots are thousands
separators, a bare numeric range counts as a salary, the min alone decides the
million-scaling, an unscaled 1.2x estimate for "up to"/"from").  Rules:

* text = lower(title + ' ' + description); the first pattern (in order) that
  matches anywhere wins, at its leftmost match;
* value = digits with the dots removed, read as a double and truncated;
* scale by 1,000,000 when the matched text contains ``tr`` or else when the min
  is below 1,000,000; the max is scaled with it when it was captured;
* "up to N"/"from N" give max = 1.2 x the unscaled N; a single value gives
  max = 1.2 x the scaled value; currency is 'vnd' on a match, else 'VND'.

``strict=True`` gives a corrected reading: commas and dots both read as
thousands separators unless followed by 1-2 digits (decimals), "up to"/"from"
maxima scaled like the min, and bare ranges only next to a currency unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import WS, _let

NUM = r"[0-9][0-9\.]*"
UNIT = r"(?:triệu|tr|vnd|vnđ)"
RANGE_SEP = r"(?:-|đến|tới)"
S = WS + "*"

# FIXED VALUES: (pattern, number of numeric groups, max rule); the order is the priority order.
#   rule "pair": max from group 2;  "est_raw": 1.2 x unscaled min;  "est": 1.2 x scaled min
PATTERNS: list[tuple[str, int, str]] = [
    (f"({NUM}){S}{RANGE_SEP}{S}({NUM}){S}{UNIT}", 2, "pair"),
    (f"({NUM}){S}{RANGE_SEP}{S}({NUM})", 2, "pair"),
    (f"up to{S}({NUM}){S}{UNIT}", 1, "est_raw"),
    (f"from{S}({NUM}){S}{UNIT}", 1, "est_raw"),
    (f"({NUM}){S}{UNIT}{S}-{S}({NUM}){S}{UNIT}", 2, "pair"),
    (f"({NUM}){S}{UNIT}", 1, "est"),
]

MILLION = 1_000_000
LONG_MAX = 9223372036854775807


def _read_number(digits: Column) -> tuple[Column, Column]:
    """int(float(s)) -> (value or null, overflow flag)."""
    d = digits.try_cast("double")
    finite = d.isNotNull() & (F.abs(d) < F.lit(float(LONG_MAX)))
    value = F.when(finite, d.cast("long"))
    return value, d.isNotNull() & ~finite


def _eager(pattern: str) -> str:
    """The same matches without backtracking: nothing that follows a number or blanks begins with their characters,
    and a match that begins inside a run of digits would begin at the run's first one.  The SQL's engine has no such signs."""
    p = pattern.replace(NUM, NUM + "+").replace(S, S + "+")
    # the look back stands behind the first digit, so that other characters are passed over by one test
    return p.replace("([0-9]", "([0-9](?<![0-9][0-9])", 1) if p.startswith(f"({NUM}") else p


def _tag(text: Column, patterns: list[tuple[str, int, str]]) -> Column:
    """Index of the first pattern with a match, prefixed to that match.

    Coalesce evaluates lazily, so later patterns only run when earlier ones miss.
    The lambdas run each pattern once and, like the one of ``extract_skills``, keep this projection
    out of whole-stage codegen: with it, the stage's method was too big for the JIT.
    """
    def tagged(i: int):
        return lambda m: F.when(m != "", F.concat(F.lit(str(i)), m))

    def extracted(t: Column, i: int, p: str) -> Column:
        found = _let(F.regexp_extract(t, p if strict else _eager(p), 0), tagged(i))
        # a pattern is run only on texts that hold the words it asks for
        for word in ("up to", "from"):
            if p.startswith(word):
                found = F.when(F.contains(t, F.lit(word)), found)
        if p.endswith(UNIT):
            found = F.when(F.contains(t, F.lit("tr")) | F.contains(t, F.lit("vn")), found)
        return found

    def cascade(t: Column) -> Column:
        return F.coalesce(*[extracted(t, i, p) for i, (p, _, _) in enumerate(patterns)])
    strict = patterns is not PATTERNS
    # every pattern needs a digit: texts without one skip the cascade
    return F.when(text.rlike("[0-9]"), _let(text, cascade))


def _group(idx: Column, matched: Column, patterns, g: int) -> Column:
    """Group ``g`` of the winning pattern, re-run on its own (short) match."""
    expr = None
    for i, (p, n, _) in enumerate(patterns):
        if n >= g:
            e = F.regexp_extract(matched, p, g)
            expr = F.when(idx == i, e) if expr is None else expr.when(idx == i, e)
    return expr


def _rule(idx: Column, patterns) -> Column:
    expr = None
    for i, (_, _, r) in enumerate(patterns):
        expr = F.when(idx == i, F.lit(r)) if expr is None else expr.when(idx == i, F.lit(r))
    return expr


SALARY_COLUMNS = ["salary_min", "salary_max", "salary_currency", "salary_overflow"]


def with_salary(df: DataFrame, text: str, strict: bool = False, keep_pattern: bool = False) -> DataFrame:
    """Add salary_min/max/currency/overflow computed from the lower-cased ``text``
    column.  The work is split over four projections so that every regex runs
    once per row and each generated method stays small."""
    pats = STRICT_PATTERNS if strict else PATTERNS
    base_cols = df.columns
    d = df.select("*", _tag(F.col(text), pats).alias("_sal_tag"))
    idx = F.substring("_sal_tag", 1, 1).cast("int")
    matched = F.substring("_sal_tag", 2, 1 << 30)
    d = d.select("*", idx.alias("_sal_idx"), matched.alias("_sal_m"))
    d = d.select("*",
                 _group(F.col("_sal_idx"), F.col("_sal_m"), pats, 1).alias("_sal_g1"),
                 _group(F.col("_sal_idx"), F.col("_sal_m"), pats, 2).alias("_sal_g2"),
                 _rule(F.col("_sal_idx"), pats).alias("_sal_rule"))
    if strict:
        d = d.select("*", _strict_number(F.col("_sal_g1")).alias("_sal_lo_d"),
                     _strict_number(F.col("_sal_g2")).alias("_sal_hi_d"))
        scale = (F.instr(F.col("_sal_m"), "tr") > 0) | (F.col("_sal_lo_d") < MILLION)
        d = d.select("*", scale.alias("_sal_scale"))
        lo = F.when(F.col("_sal_scale"), F.col("_sal_lo_d") * MILLION).otherwise(F.col("_sal_lo_d"))
        hi = F.when(F.col("_sal_scale"), F.col("_sal_hi_d") * MILLION).otherwise(F.col("_sal_hi_d"))
        d = d.select("*", lo.alias("_sal_lo"), hi.alias("_sal_hi"))
        ok = F.col("_sal_tag").isNotNull() & (F.abs(F.col("_sal_lo")) < F.lit(float(LONG_MAX)))
        hi_final = F.when(F.col("_sal_rule") == "pair", F.col("_sal_hi")).otherwise(F.col("_sal_lo") * F.lit(1.2))
        d = d.select("*", ok.alias("_sal_ok"))
        out = d.select(*base_cols,
                       F.when(F.col("_sal_ok"), F.col("_sal_lo").cast("long")).alias("salary_min"),
                       F.when(F.col("_sal_ok"), hi_final).alias("salary_max"),
                       F.when(F.col("_sal_tag").isNotNull(), F.lit("vnd")).otherwise(F.lit("VND")).alias("salary_currency"),
                       (F.col("_sal_tag").isNotNull() & ~F.col("_sal_ok")).alias("salary_overflow"),
                       *([F.col("_sal_idx").alias("salary_pattern")] if keep_pattern else []))
        return out
    g1d = F.replace(F.col("_sal_g1"), F.lit("."), F.lit("")).try_cast("double")
    g2d = F.replace(F.col("_sal_g2"), F.lit("."), F.lit("")).try_cast("double")
    d = d.select("*", g1d.alias("_sal_min_d"), g2d.alias("_sal_max_d"))
    fits = lambda c: F.col(c).isNotNull() & (F.abs(F.col(c)) < F.lit(float(LONG_MAX)))
    d = d.select("*",
                 F.when(fits("_sal_min_d"), F.col("_sal_min_d").cast("long")).alias("_sal_min_raw"),
                 F.when(fits("_sal_max_d"), F.col("_sal_max_d").cast("long")).alias("_sal_max_raw"),
                 (F.col("_sal_min_d").isNotNull() & ~fits("_sal_min_d")).alias("_sal_min_over"),
                 (F.col("_sal_max_d").isNotNull() & ~fits("_sal_max_d")).alias("_sal_max_over"))
    scale = (F.instr(F.col("_sal_m"), "tr") > 0) | (F.col("_sal_min_raw") < MILLION)
    d = d.select("*", scale.alias("_sal_scale"))
    min_s = F.when(F.col("_sal_scale"), F.try_multiply(F.col("_sal_min_raw"), F.lit(MILLION))) \
             .otherwise(F.col("_sal_min_raw"))
    max_p = F.when(F.col("_sal_scale"), F.try_multiply(F.col("_sal_max_raw"), F.lit(MILLION))) \
             .otherwise(F.col("_sal_max_raw"))
    d = d.select("*", min_s.alias("_sal_min_s"), max_p.alias("_sal_max_p"))
    rule = F.col("_sal_rule")
    max_val = (F.when(rule == "pair", F.col("_sal_max_p").cast("double"))
               .when(rule == "est_raw", F.col("_sal_min_raw").cast("double") * F.lit(1.2))
               .when(rule == "est", F.col("_sal_min_s").cast("double") * F.lit(1.2)))
    overflow = (F.col("_sal_min_over")
                | (F.col("_sal_min_raw").isNotNull() & F.col("_sal_min_s").isNull())
                | ((rule == "pair") & (F.col("_sal_max_over")
                                       | (F.col("_sal_max_raw").isNotNull() & F.col("_sal_max_p").isNull()))))
    found = F.col("_sal_tag").isNotNull()
    d = d.select("*", (found & F.coalesce(overflow, F.lit(False))).alias("_sal_over"))
    ok = found & ~F.col("_sal_over")
    return d.select(
        *base_cols,
        F.when(ok, F.col("_sal_min_s")).alias("salary_min"),
        F.when(ok, max_val).alias("salary_max"),
        F.when(found, F.lit("vnd")).otherwise(F.lit("VND")).alias("salary_currency"),
        F.col("_sal_over").alias("salary_overflow"),
        *([F.col("_sal_idx").alias("salary_pattern")] if keep_pattern else []),
    )


# --- strict variant --------------------------------------------------------
SNUM = r"[0-9]+(?:[\.,][0-9]{3})*(?:[\.,][0-9]{1,2})?"
STRICT_PATTERNS: list[tuple[str, int, str]] = [
    (f"({SNUM}){S}{RANGE_SEP}{S}({SNUM}){S}{UNIT}", 2, "pair"),
    (f"up to{S}({SNUM}){S}{UNIT}", 1, "est"),
    (f"from{S}({SNUM}){S}{UNIT}", 1, "est"),
    (f"({SNUM}){S}{UNIT}{S}(?:-|đến|tới){S}({SNUM}){S}{UNIT}", 2, "pair"),
    (f"({SNUM}){S}{UNIT}", 1, "est"),
]


def _strict_number(g: Column) -> Column:
    # thousands separators are [.,] followed by exactly three digits
    no_thousands = F.regexp_replace(g, r"[\.,](?=[0-9]{3}(?:[\.,]|$))", "")
    return F.replace(no_thousands, F.lit(","), F.lit(".")).try_cast("double")
